"""A small feature matrix over the test tables, to exercise the model operators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from renalis.operators import model
from renalis.plans.pipeline import Extraction
from renalis.sources.matrix import save_matrix

SETTING = {"site": "S1", "year": 1998, "stg": "stg01", "fs": "all", "oversample": "raw"}

# The check SQL's version of the same rows.
MATRIX_SQL = """
    select o.ENCOUNTERID as row_id, o.base_scr, c.age_at_admit as age, c.los,
           d.SEX = 'F' as female, d.RACE = '03' as black, o.label
    from (select ENCOUNTERID, min(SERUM_CREAT_BASE) as base_scr,
                 max(case when coalesce(AKI1_ONSET, AKI2_ONSET, AKI3_ONSET) is not null
                          then 1 else 0 end) as label
          from aki_onsets group by ENCOUNTERID) o
    join initial_cohort c on c.ENCOUNTERID = o.ENCOUNTERID
    join DEMOGRAPHIC d on d.PATID = c.PATID"""

FOLDS_SEED = 7
FOLDS_SQL = f"""
    select row_id, label, cast((row_number() over (partition by label
               order by sha256('{FOLDS_SEED}:' || row_id), row_id) - 1) % 5 as integer) as fold
    from matrix"""
WEIGHT_SQL = """
    select count(*) filter (label = 0) as negatives, count(*) filter (label = 1) as positives,
           count(*) filter (label = 0) / count(*) filter (label = 1) as positive_weight
    from matrix"""
AUC_SQL = """
    select (sum(place) filter (label = 1) - p * (p + 1) / 2) / (p * n) as auc
    from (select label, rank() over (order by base_scr)
                        + (count(*) over (partition by base_scr) - 1) / 2 as place
          from matrix),
         (select count(*) filter (label = 1) as p, count(*) filter (label = 0) as n from matrix)
    group by p, n"""


# One row per feature and kind, with what the matrix holds of it.
KINDS_SQL = """
    select 'female' as feature, true as is_boolean, count(female) as n from matrix
    union all select 'black', true, count(black) from matrix
    union all select 'base_scr', false, count(base_scr) from matrix
    union all select 'age', false, count(age) from matrix
    union all select 'los', false, count(los) from matrix"""
RUNGS_SQL = """
    select r.rung, r.n_estimators, r.candidates, f.fold, f.held_rows,
           cast(sum(f.held_rows) over (partition by r.rung) as bigint) - f.held_rows as fit_rows
    from (values (0, 100, 216), (1, 100, 72), (2, 100, 24), (3, 300, 8), (4, 900, 3))
             r (rung, n_estimators, candidates)
    cross join (select fold, count(*) as held_rows from stratified_folds group by fold) f"""
GRID_SQL = """
    select s.subsample, c.colsample, d.max_depth, l.learning_rate, w.min_child_weight,
           g.gamma / (select count(*) from matrix) as gamma
    from (values (0.5e0), (1.0e0)) s (subsample)
    cross join (values (0.6e0), (0.8e0), (1.0e0)) c (colsample)
    cross join (values (5e0), (10e0)) d (max_depth)
    cross join (values (0.01e0), (0.1e0), (0.5e0)) l (learning_rate)
    cross join (values (1e0), (5e0), (10e0)) w (min_child_weight)
    cross join (values (0.5e0), (1.0e0)) g (gamma)"""


# The stored matrices of two settings, by the length of the stay; one fold is the test split.
STORED_SQL = """
    select m.*, case when m.los < 5 then '1998' else '1999' end as year,
           case when f.fold = 0 then 'test' else 'train' end as split
    from matrix m join stratified_folds f on f.row_id = m.row_id"""
SETTINGS_SQL = """
    select 'S1' as site, year, 'stg01' as stg, 'all' as fs, 'raw' as oversample,
           'catd' as model_type, count(*) filter (split = 'train') as train_rows,
           count(*) filter (split = 'test') as test_rows, true as scored
    from stored_matrix group by year"""


def store(rows: DataFrame, root: str) -> None:
    """Writes the matrices of two settings under root; rows have a fold."""
    year = F.when(F.col("los") < 5, "1998").otherwise("1999")
    keyed = rows.withColumns(
        {"year": year, **{k: F.lit(SETTING[k]) for k in ("site", "stg", "fs", "oversample")}}
    )
    for name, part in (("train", F.col(model.FOLD) != 0), ("test", F.col(model.FOLD) == 0)):
        save_matrix(keyed.filter(part).drop(model.FOLD), root, name)


def feature_kinds(x: Extraction) -> DataFrame:
    """The features by kind, as the assembler takes them, with the number of values of each."""
    rows = feature_matrix(x)
    kinds = [(n, False) for n in model.numeric_features(rows)]
    kinds += [(n, True) for n in model.boolean_features(rows)]
    each = [
        F.struct(F.lit(n).alias("feature"), F.lit(b).alias("is_boolean"), F.count(n).alias("n"))
        for n, b in kinds
    ]
    return rows.agg(F.array(*each).alias("found")).select(F.inline("found"))


def feature_matrix(x: Extraction) -> DataFrame:
    """One row per stay of the onset table; label: any injury."""
    injured = F.coalesce("AKI1_ONSET", "AKI2_ONSET", "AKI3_ONSET").isNotNull()
    stays = x.onsets.groupBy("ENCOUNTERID").agg(
        F.min("SERUM_CREAT_BASE").alias("base_scr"),
        F.max(injured.cast("int")).alias("label"),
    )
    return stays.join(x.stays, "ENCOUNTERID").select(
        F.col("ENCOUNTERID").alias("row_id"),
        "base_scr",
        F.col("age_at_admit").alias("age"),
        "los",
        (F.col("SEX") == "F").alias("female"),
        (F.col("RACE") == "03").alias("black"),
        "label",
    )


def split(matrix: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Train and test rows, four to one, by a hash of the row's name."""
    part = F.pmod(F.xxhash64("row_id"), F.lit(5))
    return matrix.filter(part != 0), matrix.filter(part == 0)
