"""Training and scoring of boosted trees on a feature matrix, with Spark ML."""

from __future__ import annotations

import itertools
import json
import math
import random
import threading
import time
from collections.abc import Callable
from dataclasses import dataclass, replace
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml import Model, Pipeline
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import Bucketizer, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.tuning import ParamGridBuilder
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from renalis.session import Workspace, folder_exists, scratch_root
from renalis.sources.matrix import KEYS, load_matrix, stored_settings

LABEL, WEIGHT, FOLD, FEATURES = "label", "weight", "fold", "features"

# The search spaces.
HALVING_GRID = {
    "subsample": [0.5, 1.0],
    "min_child_weight": [1, 5, 10],
    "gamma": [0.5, 1.0],
    "colsample": [0.6, 0.8, 1.0],
    "max_depth": [5, 10],
    "learning_rate": [0.01, 0.1, 0.5],
}
HALVING_TREES = (100, 2000)
RANDOM_GRID = {
    "subsample": [0.6, 0.8, 1.0],
    "colsample": [0.1, 0.5, 1.0],
    "max_depth": [5, 7, 16],
    "learning_rate": [0.1, 0.5],
    "n_estimators": [50, 200, 1000],
}
# Ranges of the continuous search: (low, high, scale).
RANGES = {
    "learning_rate": (0.01, 1.0, "log"),
    "min_child_weight": (1, 10, "int"),
    "max_depth": (1, 30, "int"),  # 30 is Spark's limit
    "subsample": (0.01, 1.0, "linear"),
    "colsample": (0.01, 1.0, "linear"),
    "gamma": (1e-9, 1.0, "log"),
    "n_estimators": (50, 1000, "int"),
}

Settings = dict[str, float]


def class_weight(train: DataFrame, label: str = LABEL) -> DataFrame:
    """One row: negatives, positives, and the weight of a positive, their quotient."""
    positive = F.sum((F.col(label) == 1).cast("long"))
    negative = F.sum((F.col(label) == 0).cast("long"))
    return train.agg(negative.alias("negatives"), positive.alias("positives")).withColumn(
        "positive_weight", F.when(F.col("positives") > 0, F.col("negatives") / F.col("positives"))
    )


def with_weight(df: DataFrame, positive_weight: float, label: str = LABEL) -> DataFrame:
    return df.withColumn(
        WEIGHT, F.when(F.col(label) == 1, F.lit(float(positive_weight))).otherwise(F.lit(1.0))
    )


def boolean_features(df: DataFrame) -> list[str]:
    """Names of the boolean columns, the categorical features."""
    return [name for name, kind in df.dtypes if kind == "boolean"]


def numeric_features(df: DataFrame, label: str = LABEL) -> list[str]:
    numeric = ("double", "float", "int", "bigint", "smallint", "tinyint", "decimal")
    skip = {label, WEIGHT, FOLD, *KEYS}
    return [n for n, kind in df.dtypes if kind.split("(")[0] in numeric and n not in skip]


def assembler(df: DataFrame, label: str = LABEL) -> VectorAssembler:
    """Numeric and boolean columns as one vector; a boolean becomes a 0/1 attribute."""
    columns = numeric_features(df, label) + boolean_features(df)
    return VectorAssembler(inputCols=columns, outputCol=FEATURES)


def fold_order(row_id: str, seed: int) -> Column:
    return F.sha2(F.concat(F.lit(f"{seed}:"), F.col(row_id).cast("string")), 256)


def stratified_folds(
    df: DataFrame, row_id: str, label: str = LABEL, k: int = 5, seed: int = 0
) -> DataFrame:
    """Deal the rows of each class to k folds in a seeded random order, so that folds differ by one.

    A class may be most of the table, so its order is not built by one sort: rows fall into 4096
    slots by the first three digits of their hash, are numbered within the slot, and the slots'
    running counts (at most 4096 per class, hence the broadcast) give the position in the class.
    """
    ordered = df.withColumn("order", fold_order(row_id, seed))
    ordered = ordered.withColumn("slot", F.substring("order", 1, 3))
    before = (
        Window.partitionBy(label)
        .orderBy("slot")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    counts = ordered.groupBy(label, "slot").agg(F.count("*").alias("n"))
    offsets = counts.select(
        label, "slot", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset")
    )
    in_slot = F.row_number().over(Window.partitionBy(label, "slot").orderBy("order", row_id))
    return (
        ordered.withColumn("position", in_slot)
        .join(F.broadcast(offsets), [label, "slot"])
        .withColumn(FOLD, ((F.col("offset") + F.col("position") - 1) % k).cast("int"))
        .select(*df.columns, FOLD)
    )


def roc_auc(
    scored: DataFrame, score: str, work: Workspace, label: str = LABEL, slots: int = 1024
) -> DataFrame:
    """Area under the ROC curve, exactly, ties counted half; NULL if a class is missing.

    Rows are first reduced to one per distinct score. Each score needs the negatives below it: the
    running count within its slot of the score range plus the totals of the lower slots. The slots'
    bounds are quantiles of the distinct scores, so none holds much more than its share.
    """
    hit = (F.col(label) == 1).cast("long")
    per_score = work.cut(
        scored.groupBy(F.col(score).cast("double").alias("score")).agg(
            F.sum(hit).alias("pos"), F.sum(1 - hit).alias("neg")
        ),
        "per_score",
    )
    bounds = per_score.approxQuantile("score", [i / slots for i in range(1, slots)], 0.25 / slots)
    splits = [-math.inf, *(sorted(set(bounds)) or [0.0]), math.inf]  # no scores, no bounds
    slotted = Bucketizer(splits=splits, inputCol="score", outputCol="slot").transform(per_score)
    lower = Window.orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    totals = slotted.groupBy("slot").agg(F.sum("neg").alias("neg"))
    offsets = totals.select("slot", F.coalesce(F.sum("neg").over(lower), F.lit(0)).alias("offset"))
    inside = (
        Window.partitionBy("slot").orderBy("score").rowsBetween(Window.unboundedPreceding, -1)
    )
    below = F.col("offset") + F.coalesce(F.sum("neg").over(inside), F.lit(0))
    whole = "decimal(19,0)"
    pairs = F.col("pos").cast(whole) * (below * 2 + F.col("neg")).cast(whole)
    possible = F.col("positives").cast("double") * F.col("negatives").cast("double")
    return (
        slotted.join(F.broadcast(offsets), "slot")
        .withColumn("pairs", pairs)
        .agg(
            F.sum("pairs").cast("double").alias("pairs"),
            F.sum("pos").alias("positives"),
            F.sum("neg").alias("negatives"),
        )
        .select(F.when(possible > 0, F.col("pairs") / 2 / possible).alias("auc"))
    )


def param_maps(estimator: GBTClassifier, candidates: list[Settings], rows: int) -> list[dict]:
    """Candidates in the names of the search spaces as parameter maps of the estimator.

    gamma is a gain summed over rows, Spark's minimum gain is per row: hence the division.
    """
    maps = []
    for c in candidates:
        grid = ParamGridBuilder()
        if "subsample" in c:
            grid.baseOn((estimator.subsamplingRate, float(c["subsample"])))
        if "colsample" in c:
            grid.baseOn((estimator.featureSubsetStrategy, str(float(c["colsample"]))))
        if "max_depth" in c:
            grid.baseOn((estimator.maxDepth, int(c["max_depth"])))
        if "learning_rate" in c:
            grid.baseOn((estimator.stepSize, float(c["learning_rate"])))
        if "n_estimators" in c:
            grid.baseOn((estimator.maxIter, int(c["n_estimators"])))
        if "min_child_weight" in c:
            grid.baseOn((estimator.minInstancesPerNode, int(c["min_child_weight"])))
        if "gamma" in c:
            grid.baseOn((estimator.minInfoGain, float(c["gamma"]) / max(rows, 1)))
        maps += grid.build()
    return maps


def expand_grid(grid: dict[str, list]) -> list[Settings]:
    return [dict(zip(grid, values)) for values in itertools.product(*grid.values())]


def sample_ranges(n: int, seed: int, ranges: dict = RANGES) -> list[Settings]:
    rng = random.Random(seed)
    drawn = []
    for _ in range(n):
        candidate = {}
        for name, (low, high, scale) in ranges.items():
            if scale == "int":
                candidate[name] = rng.randint(low, high)
            elif scale == "log":
                candidate[name] = math.exp(rng.uniform(math.log(low), math.log(high)))
            else:
                candidate[name] = rng.uniform(low, high)
        drawn.append(candidate)
    return drawn


def halving_schedule(
    candidates: int, least: int, most: int, factor: int = 3
) -> list[tuple[int, int]]:
    """(trees, candidates) per rung: rungs repeat the fewest trees until the candidates left can
    grow to the most trees by the factor."""
    needed = 1 + int(math.log(candidates, factor) + 1e-9)
    possible = 1 + int(math.log(most // least, factor) + 1e-9)
    rungs = []
    for i in range(max(needed, possible)):
        power = max(0, i - needed + possible)
        rungs.append((min(least * factor**power, most), candidates))
        candidates = math.ceil(candidates / factor)
    return rungs


def halving_plan(
    folds: DataFrame,
    spark: SparkSession,
    grid: dict[str, list] = HALVING_GRID,
    trees: tuple[int, int] = HALVING_TREES,
    factor: int = 3,
) -> DataFrame:
    """One row per rung and fold of a halving search: trees, candidates, rows fitted and held out."""
    rungs = [
        (i, n, keep)
        for i, (n, keep) in enumerate(halving_schedule(len(expand_grid(grid)), *trees, factor))
    ]
    plan = spark.createDataFrame(rungs, "rung int, n_estimators int, candidates int")
    counts = folds.groupBy(FOLD).agg(F.count("*").alias("held_rows"))
    total = F.sum("held_rows").over(Window.partitionBy(F.lit(1)))  # a row for each fold
    counts = counts.withColumn("fit_rows", total - F.col("held_rows"))
    every = plan.select(F.collect_list(F.struct(*plan.columns)).alias("rungs")).scalar()
    counts = counts.withColumn("rungs", every)
    return counts.select(FOLD, "fit_rows", "held_rows", F.inline("rungs"))


def grid_table(
    rows: int, spark: SparkSession, grid: dict[str, list] = HALVING_GRID
) -> DataFrame:
    """The candidates of a grid in the booster's parameters, as param_maps() sets them."""
    estimator = booster()
    names = {
        "subsample": estimator.subsamplingRate,
        "colsample": estimator.featureSubsetStrategy,
        "max_depth": estimator.maxDepth,
        "learning_rate": estimator.stepSize,
        "min_child_weight": estimator.minInstancesPerNode,
        "gamma": estimator.minInfoGain,
    }
    maps = param_maps(estimator, expand_grid(grid), rows)
    values = [tuple(float(m[names[n]]) for n in names) for m in maps]
    return spark.createDataFrame(values, ", ".join(f"{n} double" for n in names))


@dataclass(frozen=True)
class Training:
    """Training rows, prepared once for all the fits of a search."""

    rows: DataFrame
    count: int
    pipeline: Model
    work: Workspace
    key: str = ""  # tells training rows apart whose trials are kept in one table
    small: bool = False  # the jobs of a fit, and not its rows, take the time

    def transform(self, df: DataFrame) -> DataFrame:
        return self.pipeline.transform(df)


def stand_ins(
    train: DataFrame, names: list[str], label: str, bins: int
) -> dict[str, list[float]]:
    """The values that stand for all others of a column, for each column of more values than bins.

    They are quantiles, half of them of either class, as the weights make the classes equal.
    """
    columns = train.select(label, *[F.col(name).cast("double").alias(name) for name in names])
    each = columns.select(F.posexplode(F.array(*names)).alias("place", "value")).distinct()
    order = Window.partitionBy("place").orderBy("value")
    least = each.withColumn("n", F.row_number().over(order)).filter(F.col("n") <= bins + 1)
    counts = least.groupBy("place").count().collect()  # a row for each column
    wide = [names[r["place"]] for r in counts if r["count"] > bins]
    found: dict[str, set[float]] = {name: set() for name in wide}
    half = bins // 2
    for value, offset in ((0, 0.25), (1, 0.75)):  # quantiles of like classes alternate
        at = [(i + offset) / half for i in range(half)]
        rows = columns.filter(F.col(label) == value)
        for name, quantiles in zip(wide, rows.approxQuantile(wide, at, 1 / (32 * bins))):
            found[name].update(q for q in quantiles if math.isfinite(q))
    return {name: sorted(quantiles) or [0.0] for name, quantiles in found.items()}


def nearest(df: DataFrame, name: str, values: list[float]) -> DataFrame:
    """A column's values replaced by the nearest of the given ones, in ascending order.

    What lies half-way goes to the lower one, as the booster has it, which splits half-way between two values.
    """
    kept, cuts = values[:1], []
    for value in values[1:]:
        cut = math.nextafter(kept[-1] / 2 + value / 2, math.inf)
        if not cuts or cut > cuts[-1]:
            kept.append(value)
            cuts.append(cut)
    splits = [-math.inf, *(cuts or [kept[0]]), math.inf]
    kept = kept if cuts else kept * 2
    binned = df.withColumn(name, F.col(name).cast("double"))
    binned = Bucketizer(splits=splits, inputCol=name, outputCol="bin").transform(binned)
    value = F.get(F.array(*map(F.lit, kept)), F.col("bin").cast("int"))
    return binned.withColumn(name, value).drop("bin")


def prepare(
    train: DataFrame, row_id: str, work: Workspace, label: str = LABEL, k: int = 5, seed: int = 0
) -> Training:
    """Weight, folds and feature vector, written once: a search reads them many times.

    A booster tells only so many values of a feature apart (maxBins). Where there are more, the rows hold
    the nearest of so many quantiles. The model splits half-way between them, so it takes any values.
    """
    weights = class_weight(train, label).first()
    if weights["positive_weight"] is None:
        raise ValueError("the training rows hold no positive")
    folded = stratified_folds(train, row_id, label, k, seed)
    pipeline = Pipeline(stages=[assembler(train.drop(row_id), label)]).fit(train)
    numeric = numeric_features(train.drop(row_id), label)
    for name, values in stand_ins(train, numeric, label, booster().getMaxBins()).items():
        folded = nearest(folded, name, values)
    rows = pipeline.transform(with_weight(folded, weights["positive_weight"], label)).select(
        FEATURES, F.col(label).cast("double").alias(LABEL), WEIGHT, FOLD
    )
    rows = work.cut(rows, "training")
    checkpointed(work.spark)
    # Folds and features of all rows, in whatever order, and the seed that dealt the folds.
    key = rows.agg(F.sum(F.xxhash64(FOLD, LABEL, vector_to_array(FEATURES)) % (1 << 32))).first()[0]
    count = weights["negatives"] + weights["positives"]
    return Training(rows, count, pipeline, work, f"{seed}:{key}")


# Up to here a fit waits for its jobs most of the time, so that two fits side by side take little more.
SMALL_ROWS = 1_000_000


def cells(training: Training) -> Training:
    """The training rows as cells: one row, with the joint weight, for all rows that are alike to a booster.

    Rows of the same features, label and side of the held-out fold are one cell. As prepare() leaves a
    feature no more values than the booster tells apart, cells are at most the product of these numbers,
    however many rows there are. Sums over cells are those over rows. Fits that draw rows or count them
    (subsample, min_child_weight) need the rows themselves.
    """
    side = F.when(F.col(FOLD) == 0, 0).otherwise(1).alias(FOLD)
    values = F.transform(vector_to_array(FEATURES), lambda v: v + 0.0).alias("values")  # no -0.0
    grouped = training.rows.groupBy(values, LABEL, WEIGHT, side).agg(F.count("*").alias("n"))
    weight = (F.col(WEIGHT) * F.col("n")).alias(WEIGHT)
    alike = grouped.select(array_to_vector("values").alias(FEATURES), LABEL, weight, FOLD)
    found = training.work.cut(alike, "cells")
    return replace(training, rows=found, small=found.count() <= SMALL_ROWS)


def checkpointed(spark: SparkSession) -> None:
    """Boosting cuts its lineage every ten trees, which needs a folder that all executors share."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(scratch_root(spark))


def booster(seed: int = 0, **params) -> GBTClassifier:
    return GBTClassifier(
        featuresCol=FEATURES, labelCol=LABEL, weightCol=WEIGHT, seed=seed, **params
    )


class Trials:
    """Scores of fits that are done, kept in a table, so that a search that ended goes on where it was.

    A trial is a fit of one candidate without one fold. Its key names all that its score depends on: the
    candidate's settings, fold, seed, metric and training rows. Each score is appended when it is known.
    Without a path they last as long as the object.
    """

    SCHEMA = "trial string, score double, seconds double"

    def __init__(self, spark: SparkSession, path: str | None = None):
        self.spark, self.path, self.lock = spark, path, threading.Lock()
        self.known: dict[str, float] = {}
        self.fitted = 0
        if path is not None and folder_exists(spark, path):
            stored = spark.read.schema(self.SCHEMA).parquet(path)
            self.known = {r["trial"]: r["score"] for r in stored.collect()}  # a row for each fit

    def score(self, trial: str, fit: Callable[[], float]) -> float:
        """The stored score, or that of the fit, which is stored."""
        with self.lock:
            if trial in self.known:
                return self.known[trial]
        started = time.perf_counter()
        value = fit()
        with self.lock:  # writers of one folder must not commit at the same time
            if self.path is not None:
                row = [(trial, value, time.perf_counter() - started)]
                self.spark.createDataFrame(row, self.SCHEMA).coalesce(1).write.mode("append").parquet(
                    self.path
                )
            self.known[trial] = value
            self.fitted += 1
        return value


def _cross_validate(
    candidates: list[Settings],
    training: Training,
    k: int,
    seed: int,
    parallelism: int,
    metric: str,
    trials: Trials | None = None,
) -> list[float]:
    """Mean of the metric over the folds, for each candidate; larger is better.

    Fits run side by side, each in a scheduler pool of its own; what the trials know is not fitted.
    """
    spark = training.rows.sparkSession
    trials = trials or Trials(spark)
    evaluator = MulticlassClassificationEvaluator(labelCol=LABEL, metricName=metric)
    sign = 1 if evaluator.isLargerBetter() else -1
    estimator = booster(seed)
    maps = param_maps(estimator, candidates, training.count)

    def fold_score(task: tuple[int, int]) -> float:
        i, fold = task
        settings = {n: v for n, v in candidates[i].items() if n != "score"}
        known = {**settings, "fold": fold, "folds": k, "seed": seed, "metric": metric,
                 "rows": training.count, "key": training.key}

        def fit() -> float:
            spark.sparkContext.setLocalProperty("spark.scheduler.pool", f"fold-{i}-{fold}")
            fitting = training.rows.filter(F.col(FOLD) != fold)
            fitted = estimator.copy(maps[i]).fit(fitting)
            held = fitted.transform(training.rows.filter(F.col(FOLD) == fold))
            return sign * evaluator.evaluate(held)

        return trials.score(json.dumps(known, sort_keys=True), fit)

    tasks = [(i, fold) for i in range(len(candidates)) for fold in range(k)]
    with ThreadPool(max(1, min(parallelism, len(tasks)))) as pool:
        scores = pool.map(inheritable_thread_target(spark)(fold_score), tasks, chunksize=1)
    return [sum(scores[i * k : (i + 1) * k]) / k for i in range(len(candidates))]


def _best_first(candidates: list[Settings], scores: list[float]) -> list[int]:
    return sorted(range(len(candidates)), key=lambda i: -scores[i])


def grid_search_halving(
    training: Training,
    grid: dict[str, list] = HALVING_GRID,
    trees: tuple[int, int] = HALVING_TREES,
    factor: int = 3,
    k: int = 5,
    seed: int = 0,
    parallelism: int = 4,
    metric: str = "accuracy",
    trials: Trials | None = None,
) -> list[Settings]:
    """Successive halving on the number of trees; the candidates of the last rung, best first.

    Rungs that repeat the number of trees ask for scores that are known and fit nothing.
    """
    alive = expand_grid(grid)
    trials = trials or Trials(training.rows.sparkSession)
    for n_trees, keep in halving_schedule(len(alive), *trees, factor):
        alive = [{**c, "n_estimators": n_trees} for c in alive[:keep]]
        scores = _cross_validate(alive, training, k, seed, parallelism, metric, trials)
        alive = [{**alive[i], "score": scores[i]} for i in _best_first(alive, scores)]
    return alive


def random_search(
    training: Training,
    candidates: list[Settings] | None = None,
    n_iter: int = 20,
    k: int = 5,
    seed: int = 0,
    parallelism: int = 4,
    metric: str = "logLoss",
    trials: Trials | None = None,
) -> list[Settings]:
    """Cross-validate a seeded sample of the candidates; all of it, best first.

    Log loss, and not accuracy, which favours the majority class where positives are rare.
    """
    pool = expand_grid(RANDOM_GRID) if candidates is None else candidates
    drawn = random.Random(seed).sample(pool, min(n_iter, len(pool)))
    scores = _cross_validate(drawn, training, k, seed, parallelism, metric, trials)
    return [{**drawn[i], "score": scores[i]} for i in _best_first(drawn, scores)]


def stopping_round(losses: list[float], patience: int) -> int:
    """Trees to keep: those up to the least loss that no loss of the next `patience` trees beats."""
    best = 0
    for i, loss in enumerate(losses):
        if loss < losses[best]:
            best = i
        elif i - best >= patience:
            break
    return best + 1


def fit_early_stop(
    training: Training, settings: Settings, patience: int = 50, seed: int = 0
) -> Model:
    """Fit on all rows, with as many trees as lower the loss on a held-out fold.

    Trees are fitted on the other folds until `patience` of them in a row bring no gain on the first
    fold. The number of trees up to the best one is then fitted on all rows. Stopping on the training
    rows themselves would not notice overfitting. A fit with fewer trees is the beginning of one with
    more: a batch is fitted first, then twice as many trees; all of them at once if the loss falls to the
    end of the batch. With that last trial, all trees are fitted on all rows too, if they are small.
    """
    chosen = {n: v for n, v in settings.items() if n != "score"}
    estimator = booster(seed)
    estimator = estimator.copy(param_maps(estimator, [chosen], training.count)[0])
    most = estimator.getMaxIter()
    fitting, held = training.rows.filter(F.col(FOLD) != 0), training.rows.filter(F.col(FOLD) == 0)

    def fit(task: tuple[int, DataFrame]) -> Model:
        n, rows = task
        return estimator.copy({estimator.maxIter: n}).fit(rows)

    n = min(most, 2 * patience)
    while True:
        tasks = [(n, fitting)]
        if n == most and training.small:
            tasks.append((most, training.rows))
        with ThreadPool(len(tasks)) as pool:
            trial, *whole = pool.map(
                inheritable_thread_target(training.rows.sparkSession)(fit), tasks, chunksize=1
            )
        losses = trial.evaluateEachIteration(held)
        keep = stopping_round(losses, patience)
        if keep + patience <= n or n == most:
            return whole[0] if whole and keep == most else fit((keep, training.rows))
        n = most if keep >= n - patience // 5 else min(most, 2 * n)


def default_fit(
    training: Training, n_trees: int = 1000, seed: int = 0, patience: int = 50
) -> Model:
    """Default booster with class weights: up to n_trees of depth 6, as the held-out fold has it.

    It draws no rows and counts none, so it is fitted on cells.
    """
    settings = {"n_estimators": n_trees, "max_depth": 6}
    return fit_early_stop(cells(training), settings, patience, seed)


def score(model: Model, training: Training, test: DataFrame, label: str = LABEL) -> DataFrame:
    """Test rows with the hard prediction and the probability of a positive."""
    scored = model.transform(training.transform(test))
    return scored.select(
        F.col(label).alias(LABEL),
        "prediction",
        vector_to_array("probability")[1].alias("probability"),
    )


def run_setting(
    train: DataFrame,
    test: DataFrame,
    setting: dict,
    model_type: str,
    row_id: str,
    work: Workspace,
    label: str = LABEL,
    model_path: str | None = None,
    k: int = 5,
    seed: int = 0,
    search: dict | None = None,
    trials_path: str | None = None,
) -> DataFrame:
    """Search, fit and score one setting; one result row.

    model_type: xgbhgs (halving grid), xgbbs (random draws from the continuous ranges), catd
    (defaults), catr (random grid). ``search`` overrides arguments of the search. With trials_path the
    scores of a search are kept there, and a run that ended goes on with what it lacks.
    """
    started = time.perf_counter()
    options = {**(search or {}), "trials": Trials(work.spark, trials_path)}
    training = prepare(train, row_id, work, label, k, seed)
    if model_type == "xgbhgs":
        best = grid_search_halving(training, k=k, seed=seed, **options)[0]
    elif model_type == "xgbbs":
        drawn = sample_ranges(options.get("n_iter", 50), seed, options.get("ranges", RANGES))
        best = random_search(training, drawn, len(drawn), k, seed, trials=options["trials"])[0]
    elif model_type == "catr":
        best = random_search(training, k=k, seed=seed, **options)[0]
    elif model_type != "catd":
        raise ValueError(f"unknown model type {model_type}")
    if model_type == "catd":
        model = default_fit(training, options.get("n_estimators", 1000), seed)
    else:
        model = fit_early_stop(training, best, seed=seed)
    if model_path:
        model.write().overwrite().save(model_path)
    scored = work.cut(score(model, training, test, label), "scored")
    auc_label = roc_auc(scored, "prediction", work).first()["auc"]
    auc_score = roc_auc(scored, "probability", work).first()["auc"]
    row = [
        *[str(setting[key]) for key in KEYS],
        model_type,
        auc_label,
        auc_score,
        time.perf_counter() - started,
    ]
    columns = ", ".join(f"{key} string" for key in KEYS)
    return work.spark.createDataFrame(
        [row], f"{columns}, model_type string, auc double, auc_probability double, seconds double"
    )


def run_stored_setting(
    root: str, setting: dict, model_type: str, row_id: str, work: Workspace, **options
) -> DataFrame:
    """run_setting on the stored matrices of a setting."""
    train, test = load_matrix(work.spark, root, *[setting[key] for key in KEYS])
    return run_setting(train, test, setting, model_type, row_id, work, **options)


RESULT_KEYS = [*KEYS, "model_type"]
RESULT = (
    ", ".join(f"{key} string" for key in KEYS)
    + ", train_rows long, test_rows long, auc double, auc_probability double, seconds double"
    + ", model_type string"
)


def finished(spark: SparkSession, results: str) -> DataFrame:
    """Result rows so far: one for each setting and model type that is done."""
    if not folder_exists(spark, results):
        return spark.createDataFrame([], RESULT)
    return spark.read.schema(RESULT).parquet(results)


def run_settings(
    root: str,
    model_types: list[str],
    row_id: str,
    results: str,
    work: Workspace,
    parallelism: int = 2,
    trials_root: str | None = None,
    models_root: str | None = None,
    **options,
) -> DataFrame:
    """Every stored setting with every model type; the table of results.

    Jobs are the partitions of the stored matrices. Each runs in a scheduler pool of its own and
    overwrites its own partition of the results when it is done, so that one that was lost half-way
    leaves nothing, and the next run fits only what has no result yet. trials_root and models_root get
    a folder for each job. The other options are those of run_setting().
    """
    spark = work.spark
    done = {tuple(r) for r in finished(spark, results).select(*RESULT_KEYS).collect()}
    jobs = [
        (setting, kind)
        for setting in stored_settings(spark, root)
        for kind in model_types
        if (*(setting[key] for key in KEYS), kind) not in done
    ]
    writing = threading.Lock()

    def run(job: tuple[dict, str]) -> None:
        setting, kind = job
        name = "/".join([*(f"{key}={setting[key]}" for key in KEYS), f"model_type={kind}"])
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", name)
        train, test = load_matrix(spark, root, *[setting[key] for key in KEYS])
        row = run_setting(
            train, test, setting, kind, row_id, work,
            trials_path=f"{trials_root}/{name}" if trials_root else None,
            model_path=f"{models_root}/{name}" if models_root else None,
            **options,
        ).withColumns({"train_rows": F.lit(train.count()), "test_rows": F.lit(test.count())})
        columns = [name.split(" ")[0] for name in RESULT.split(", ")]
        with writing:
            row.select(*columns).coalesce(1).write.mode("overwrite").option(
                "partitionOverwriteMode", "dynamic"
            ).partitionBy(*RESULT_KEYS).parquet(results)

    with ThreadPool(max(1, min(parallelism, len(jobs) or 1))) as pool:
        pool.map(inheritable_thread_target(spark)(run), jobs, chunksize=1)
    return finished(spark, results)
