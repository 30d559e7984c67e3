from __future__ import annotations

import random

import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import functions as F

from renalis.operators import model
from renalis.sources.matrix import KEYS, load_matrix, save_matrix

SETTING = {"site": "01", "year": 2015, "stg": "s1", "fs": "f", "oversample": "no"}


def matrix(spark, n=300, seed=1):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        x, flag = rng.random(), rng.random() < 0.5
        label = int(x + 0.3 * flag + 0.2 * rng.random() > 0.9)
        rows.append((f"r{i}", x, rng.randrange(50), flag, label))
    return spark.createDataFrame(rows, "row_id string, x double, n int, flag boolean, label int")


def brute_auc(pairs):
    pos = [s for s, y in pairs if y == 1]
    neg = [s for s, y in pairs if y == 0]
    if not pos or not neg:
        return None
    wins = sum((p > q) + 0.5 * (p == q) for p in pos for q in neg)
    return wins / len(pos) / len(neg)


@pytest.mark.parametrize("digits, slots", [(1, 4), (2, 16), (6, 64)])
def test_auc_equals_brute_force(spark, work, digits, slots):
    rng = random.Random(digits)
    pairs = [(round(rng.random() ** 3, digits), int(rng.random() < 0.3)) for _ in range(500)]
    df = spark.createDataFrame(pairs, "score double, label int")
    got = model.roc_auc(df, "score", work, slots=slots).first()["auc"]
    assert got == pytest.approx(brute_auc(pairs), abs=1e-12)
    vectors = df.withColumn("label", F.col("label").cast("double"))
    ready = BinaryClassificationEvaluator(rawPredictionCol="score", numBins=0).evaluate(vectors)
    assert got == pytest.approx(ready, abs=1e-9)


@pytest.mark.parametrize("label", [0, 1])
def test_auc_of_one_class_is_null(spark, work, label):
    df = spark.createDataFrame([(0.1, label), (0.2, label)], "score double, label int")
    assert model.roc_auc(df, "score", work).first()["auc"] is None


def test_class_weight_and_booleans(spark):
    df = spark.createDataFrame(
        [(0, True), (0, False), (0, True), (1, True)], "label int, flag boolean"
    )
    assert tuple(model.class_weight(df).first()) == (3, 1, 3.0)
    weights = model.with_weight(df, 3.0).groupBy("label").agg(F.sum("weight")).collect()
    assert {r[0]: r[1] for r in weights} == {0: 3.0, 1: 3.0}
    assert model.boolean_features(df) == ["flag"]
    only = df.filter("label = 0")
    assert model.class_weight(only).first()["positive_weight"] is None


def test_folds_are_stratified_and_equal_to_one_sort(spark):
    import hashlib

    df = matrix(spark, 700)
    rows = df.select("row_id", "label").collect()
    got = {r.row_id: r.fold for r in model.stratified_folds(df, "row_id", k=5, seed=3).collect()}
    for label in (0, 1):
        names = [r.row_id for r in rows if r.label == label]
        names.sort(key=lambda n: hashlib.sha256(f"3:{n}".encode()).hexdigest())
        assert [got[n] for n in names] == [i % 5 for i in range(len(names))]


def test_halving_schedule():
    # 216 candidates, 100 to 2000 trees, factor 3.
    assert model.halving_schedule(216, 100, 2000) == [
        (100, 216), (100, 72), (100, 24), (300, 8), (900, 3),
    ]
    assert model.halving_schedule(4, 2, 4, 2) == [(2, 4), (2, 2), (4, 1)]
    assert len(model.expand_grid(model.HALVING_GRID)) == 216
    assert len(model.expand_grid(model.RANDOM_GRID)) == 162


def test_samples_stay_in_range():
    drawn = model.sample_ranges(200, seed=4)
    for name, (low, high, _) in model.RANGES.items():
        assert all(low <= c[name] <= high for c in drawn)
    assert drawn == model.sample_ranges(200, seed=4)


def test_search_and_fit(spark, work):
    train = matrix(spark)
    training = model.prepare(train, "row_id", work, k=2)
    assert training.count == 300
    grid = {"max_depth": [1, 3], "learning_rate": [0.3], "gamma": [0.5], "colsample": [1.0],
            "subsample": [1.0], "min_child_weight": [1]}
    best = model.grid_search_halving(training, grid, (1, 2), factor=2, k=2)[0]
    assert best["n_estimators"] == 2 and best["score"] > 0.7
    fitted = model.fit_early_stop(training, {**best, "n_estimators": 4})
    scored = model.score(fitted, training, matrix(spark, 100, seed=9))
    auc = model.roc_auc(scored, "probability", work).first()["auc"]
    assert auc > 0.8


def test_stored_matrices_and_settings(spark, work):
    root = f"{work.path}/matrices"
    both = matrix(spark)
    for key, value in SETTING.items():
        both = both.withColumn(key, F.lit(value))
    other = both.withColumn("site", F.lit("02")).limit(3)
    save_matrix(both.unionByName(other), root, "train")
    save_matrix(both.limit(50), root, "test")
    train, test = load_matrix(spark, root, *SETTING.values())
    assert (train.count(), test.count()) == (300, 50) and not set(KEYS) & set(train.columns)
    plan = train._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "PartitionFilters: []" not in plan
    result = model.run_stored_setting(
        root, SETTING, "catr", "row_id", work, k=2, model_path=f"{work.path}/model",
        search={"candidates": [{"max_depth": 2, "n_estimators": 2, "learning_rate": 0.5}]},
    ).first()
    assert result.site == "01" and result.model_type == "catr" and 0.5 < result.auc <= 1
    with pytest.raises(ValueError):
        model.run_stored_setting(root, SETTING, "other", "row_id", work, k=2)


def test_stopping_round():
    falling = [1 / (i + 1) for i in range(200)]
    assert model.stopping_round(falling, 50) == 200
    assert model.stopping_round([3, 2, 1, 2, 2, 0.5], 3) == 6
    assert model.stopping_round([3, 2, 1, 2, 2, 2, 0.5], 3) == 3
    assert model.stopping_round([1.0], 50) == 1


def test_early_stop_goes_on_while_the_loss_falls(spark, work):
    training = model.prepare(matrix(spark), "row_id", work, k=3)
    settings = {"n_estimators": 120, "max_depth": 1, "learning_rate": 0.01}
    fitted = model.fit_early_stop(training, settings, patience=20)
    assert fitted.getNumTrees > 100
    # The last fit is that of all rows.
    again = model.booster(maxIter=fitted.getNumTrees, maxDepth=1, stepSize=0.01).fit(training.rows)
    assert again.toDebugString.split("\n", 1)[1] == fitted.toDebugString.split("\n", 1)[1]


def test_default_fit_stops_by_the_held_out_fold(spark, work, monkeypatch):
    training = model.prepare(matrix(spark), "row_id", work, k=3)
    fitted = model.default_fit(training, patience=2)
    assert fitted.getMaxDepth() == 6
    trial = model.booster(maxIter=fitted.getNumTrees + 2, maxDepth=6)
    trial = trial.fit(training.rows.filter("fold != 0"))
    losses = trial.evaluateEachIteration(training.rows.filter("fold = 0"))
    assert model.stopping_round(losses, 2) == fitted.getNumTrees
    asked = []
    monkeypatch.setattr(model, "fit_early_stop", lambda *given: asked.append(given[1:]))
    model.default_fit(training)
    assert asked == [({"n_estimators": 1000, "max_depth": 6}, 50, 0)]


def test_auc_of_nothing(spark, work):
    none = spark.createDataFrame([], "label int, score double")
    assert model.roc_auc(none, "score", work).first()["auc"] is None


def test_two_results_on_one_workspace(spark, work):
    rows = [(0, 0.1), (1, 0.9), (0, 0.4), (1, 0.3)]
    df = spark.createDataFrame(rows, "label int, score double")
    first = model.roc_auc(df, "score", work)
    second = model.roc_auc(df.withColumn("score", -F.col("score")), "score", work)
    assert (first.first()["auc"], second.first()["auc"]) == (0.75, 0.25)


GRID = {"max_depth": [1, 2], "learning_rate": [0.1, 0.3], "gamma": [0.5], "colsample": [1.0],
        "subsample": [1.0], "min_child_weight": [1]}


def test_a_search_goes_on_where_it_was(spark, work, monkeypatch):
    training = model.prepare(matrix(spark), "row_id", work, k=2)
    path = f"{work.path}/trials"
    first = model.Trials(spark, path)
    # Four candidates, then two of them with as many trees, then one with twice as many.
    assert model.halving_schedule(4, 2, 4, 2) == [(2, 4), (2, 2), (4, 1)]
    best = model.grid_search_halving(training, GRID, (2, 4), 2, k=2, trials=first)
    assert first.fitted == 2 * (4 + 1)  # nothing for the second rung
    assert spark.read.parquet(path).count() == first.fitted

    again = model.Trials(spark, path)
    assert model.grid_search_halving(training, GRID, (2, 4), 2, k=2, trials=again) == best
    assert again.fitted == 0

    # A run that was lost after some fits: the rest is fitted, and the result is the same.
    lost = f"{work.path}/lost"
    spark.read.parquet(path).limit(4).coalesce(1).write.parquet(lost)
    rest = model.Trials(spark, lost)
    assert model.grid_search_halving(training, GRID, (2, 4), 2, k=2, trials=rest) == best
    assert rest.fitted == first.fitted - 4

    # Other rows, folds or metrics are other trials.
    other = model.prepare(matrix(spark, seed=2), "row_id", work, k=2)
    more = model.Trials(spark, path)
    model.random_search(other, [{"max_depth": 1, "n_estimators": 2}], k=2, trials=more)
    assert more.fitted == 2


def test_scores_are_those_of_the_cross_validator(spark, work):
    from pyspark.ml.evaluation import MulticlassClassificationEvaluator
    from pyspark.ml.tuning import CrossValidator

    training = model.prepare(matrix(spark), "row_id", work, k=3)
    candidates = [{"max_depth": d, "n_estimators": 3, "learning_rate": 0.2} for d in (1, 3)]
    for metric, sign in (("accuracy", 1), ("logLoss", -1)):
        found = model._cross_validate(candidates, training, 3, 0, 2, metric)
        estimator = model.booster(0)
        ready = CrossValidator(
            estimator=estimator, numFolds=3, foldCol="fold",
            estimatorParamMaps=model.param_maps(estimator, candidates, training.count),
            evaluator=MulticlassClassificationEvaluator(labelCol="label", metricName=metric),
        ).fit(training.rows)
        assert found == pytest.approx([sign * v for v in ready.avgMetrics])


def test_settings_are_run_once_each(spark, work, monkeypatch):
    root, results = f"{work.path}/matrices", f"{work.path}/results"
    rows = matrix(spark, 240)
    for key, value in {**SETTING, "site": "01"}.items():
        rows = rows.withColumn(key, F.lit(str(value)))
    both = rows.unionByName(rows.withColumn("year", F.lit("2016")).limit(200))
    save_matrix(both, root, "train")
    save_matrix(both, root, "test")
    options = {"k": 2, "search": {"candidates": [{"max_depth": 2, "n_estimators": 2}]}}
    kept = {"trials_root": f"{work.path}/trials", "models_root": f"{work.path}/models"}
    lost = model.run_setting

    def fails_for_one(train, test, setting, *rest, **more):
        if setting["year"] == "2016":
            raise RuntimeError("lost")
        return lost(train, test, setting, *rest, **more)

    monkeypatch.setattr(model, "run_setting", fails_for_one)
    with pytest.raises(RuntimeError):
        model.run_settings(root, ["catr"], "row_id", results, work, 1, **kept, **options)
    assert [r.year for r in model.finished(spark, results).collect()] == ["2015"]

    ran = []
    monkeypatch.setattr(model, "run_setting", lambda *a, **k: ran.append(a[2]["year"]) or lost(*a, **k))
    found = model.run_settings(root, ["catr"], "row_id", results, work, **kept, **options)
    assert ran == ["2016"]
    assert sorted((r.site, r.year, r.model_type, r.train_rows, r.test_rows) for r in found.collect()) == [
        ("01", "2015", "catr", 240, 240), ("01", "2016", "catr", 200, 200)
    ]
    assert all(0.5 <= r.auc_probability <= 1 for r in found.collect())
    again = model.run_settings(root, ["catr"], "row_id", results, work, **kept, **options)
    assert ran == ["2016"] and again.count() == 2


def stays(spark, times=1):
    """Rows of few distinct values but for one feature; each comes `times` times."""
    rng = random.Random(5)
    rows = []
    for i in range(400):
        days, age, flag, x = rng.choice([2, 3, 4, 5, 1300]), rng.randrange(30), rng.random() < 0.5, rng.random()
        label = int(days / 10 + age / 30 + flag + x > 1.6)
        rows += [(f"r{i}-{j}", days, age, flag, label, x) for j in range(times)]
    return spark.createDataFrame(
        rows, "row_id string, days int, age int, flag boolean, label int, x double"
    )


def test_cells_hold_the_weight_of_all_rows(spark, work):
    training = model.prepare(stays(spark, 3).drop("x"), "row_id", work, k=3)
    found = model.cells(training)
    weights = F.sum("weight").alias("weight")
    sides = F.least("fold", F.lit(1)).alias("fold")
    before = training.rows.groupBy("features", "label", sides).agg(weights)
    assert found.rows.count() == before.count() < training.count == 1200
    joined = before.alias("b").join(found.rows.alias("c"), ["features", "label", "fold"]).collect()
    assert len(joined) == before.count()
    assert all(r[3] == pytest.approx(r[4], rel=1e-12) for r in joined)


def test_a_fit_of_cells_is_the_fit_of_the_rows(spark, work):
    train = stays(spark, 2)
    training = model.prepare(train, "row_id", work, k=3)
    found = model.cells(training)
    booster = model.booster(maxIter=12, maxDepth=4)
    scores = [
        {tuple(r.features): r.rawPrediction[1] for r in booster.fit(rows).transform(training.rows).collect()}
        for rows in (training.rows, found.rows)
    ]
    assert len(scores[0]) > 300 and scores[1] == pytest.approx(scores[0], rel=1e-9)


def test_features_keep_few_values(spark, work):
    train = matrix(spark, 2000).withColumn("days", F.expr("if(n < 49, n % 10, 1300)"))
    training = model.prepare(train.withColumn("same", F.lit(1.5)), "row_id", work)
    values = list(zip(*[r.features for r in training.rows.select("features").collect()]))
    x, n, days, same, flag = [sorted(set(v)) for v in values]
    assert len(x) == 32 and 20 < len(n) <= 32
    assert days == [*range(10), 1300] and same == [1.5] and flag == [0, 1]  # few values stay
    # Ten times the rows, and no more cells than values allow.
    only = training.pipeline.stages[0].getInputCols()
    assert only == ["x", "n", "days", "same", "flag"]
    assert model.cells(training).rows.count() <= 32 * 32 * 11 * 2 * 2 * 2


def test_a_value_goes_to_the_nearest(spark):
    df = spark.createDataFrame([(v,) for v in (-9.0, 1.0, 1.5, 1.6, 3.0, 3.1, 99.0)], "x double")
    got = [r.x for r in model.nearest(df, "x", [1.0, 2.0, 4.0]).collect()]
    assert got == [1.0, 1.0, 1.0, 2.0, 2.0, 4.0, 4.0]
    assert {r.x for r in model.nearest(df, "x", [7.0]).collect()} == {7.0}


def test_default_fit_takes_cells_and_repeats_no_batches(spark, work, monkeypatch):
    training = model.prepare(stays(spark, 4).drop("x"), "row_id", work, k=3)
    plain, fits = model.GBTClassifier._fit, []

    def fit(self, rows):
        fits.append((self.getMaxIter(), rows.count()))
        return plain(self, rows)

    monkeypatch.setattr(model.GBTClassifier, "_fit", fit)
    # The loss falls to the end: a batch, then all trees once on the other folds and once on all rows.
    fitted = model.default_fit(training, 16, patience=3)
    assert fitted.getNumTrees == 16 and [n for n, _ in sorted(fits)] == [6, 16, 16]
    assert all(n < training.count / 2 for _, n in fits)
    # The model on all rows is the one of a plain fit.
    again = model.booster(maxIter=16, maxDepth=6).fit(model.cells(training).rows)
    assert again.treeWeights == fitted.treeWeights and again.totalNumNodes == fitted.totalNumNodes
