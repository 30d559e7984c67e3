"""The registered queries: one per operator, over whole test tables seen through the views."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import date
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from renalis import preset, session
from renalis.config import CohortConfig
from renalis.operators import attrition, cohort, collect, deid, exclusions, model, staging
from renalis.plans.pipeline import CohortResult, Extraction, collect_one, extract_slices
from renalis.sources import cdm, sinks
from renalis.sources.matrix import SPLITS, load_matrix, stored_settings
from verification import matrix, oracle
from verification.views import load_views

# Study window of the test tables.
WINDOW = {
    "window_start": date(1995, 1, 1),
    "window_end": date(2001, 12, 31),
    "split_date": date(1998, 6, 30),
}
SALT = oracle.SALT


def config(name: str) -> CohortConfig:
    return preset(name, **WINDOW)


def extraction(spark: SparkSession, sf_dir: str, preset_name: str = "oracle") -> Extraction:
    session.tune(spark)
    views = load_views(spark, sf_dir)
    return Extraction(spark, views, config(preset_name), session.Workspace(spark))


Build = Callable[[Extraction], DataFrame]


@dataclass(frozen=True)
class Query:
    build: Build
    step: str | None  # step of the check SQL; None: rows only
    preset: str = "oracle"

    def run(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        return self.build(extraction(spark, sf_dir, self.preset))

    def sql(self) -> str | None:
        return oracle.statement(config(self.preset), self.step) if self.step else None


_FLAGGED = {
    "excl_low_egfr": lambda x: exclusions.excl_low_egfr(x.first_scr, x.cfg),
    "excl_pre_esrd": lambda x: exclusions.excl_pre_esrd(x.init, x.cdm["DIAGNOSIS"]),
    "excl_pre_rrt_dx": lambda x: exclusions.excl_pre_rrt_dx(x.init, x.cdm["DIAGNOSIS"]),
    "excl_pre_rrt_px": lambda x: exclusions.excl_pre_rrt_px(x.init, x.cdm["PROCEDURES"], x.cfg),
    "excl_pre_rrt": lambda x: exclusions.excl_pre_rrt(
        x.init, x.cdm["DIAGNOSIS"], x.cdm["PROCEDURES"], x.cfg
    ),
    "excl_rrt_48h": lambda x: exclusions.excl_rrt_48h(x.first_scr, x.cdm["PROCEDURES"], x.cfg),
    "excl_burn": lambda x: exclusions.excl_burn(x.init, x.cdm["DIAGNOSIS"]),
}

_SCR_COLUMNS = [
    "PATID", "ENCOUNTERID", "SERUM_CREAT", "EGFR", "LAB_ORDER_DATE", "SPECIMEN_DATE_TIME",
    "RESULT_DATE_TIME", "ADMIT_DATE_TIME", "rn",
]

_COHORT: dict[str, Build] = {
    "initial_cohort": lambda x: x.initial_cohort,
    "scr_mean": lambda x: cohort.scr_mean(x.cdm["LAB_RESULT_CM"], x.initial_cohort, x.cfg),
    "all_scr_egfr": lambda x: cohort.all_scr_egfr(
        x.cdm["LAB_RESULT_CM"],
        cohort.cohort_patients(x.cdm["DEMOGRAPHIC"], x.initial_cohort),
        x.cfg,
    ),
    "matched": lambda x: x.matched,
    "aki_scr_egfr": lambda x: x.scr_egfr.select(*_SCR_COLUMNS),
    "init": lambda x: x.init,
    "exclude_all": lambda x: x.exclude_all.select("ENCOUNTERID", "EXCLUD_TYPE"),
    "eligible": lambda x: x.eligible,
    "stage_events": lambda x: x.stage_events,
    "rank_stages": lambda x: x.rank_stages,
    "worst_per_day": lambda x: x.worst_per_day,
    "stages_daily": lambda x: x.stages_daily,
    "pivot_onsets": lambda x: staging.pivot_onsets(staging.onset_events(x.stages_daily)),
    "raw_onset": lambda x: staging.raw_onset(x.stages_daily),
    "aki_onsets": lambda x: x.aki_onsets,
    "rolling_48h_pairs": lambda x: staging.rolling_48h_pairs(x.eligible_unranked, x.cfg),
    "ratio_stage": lambda x: staging.ratio_stage(x.eligible_unranked, x.cfg),
    "rrt_stage3": lambda x: staging.rrt_stage3(
        cohort.eligible_baseline(x.baseline, x.exclude_all), x.cdm["PROCEDURES"], x.cfg
    ),
}

_COLLECTED = {
    "collect_obs_clin": "AKI_VITAL",
    "collect_vital": "AKI_VITAL_OLD",
    "collect_procedures": "AKI_PX",
    "collect_dx_history": "AKI_DX",
    "collect_dx_current": "AKI_DX_CURRENT",
    "collect_dx_current_by_admit": "AKI_DX_CURRENT_ADMIT_DATE",
    "collect_labs": "AKI_LAB",
    "collect_scr_history": "AKI_LAB_SCR",
    "collect_prescribing": "AKI_PMED",
    "collect_dispensing": "AKI_DMED",
    "collect_med_admin": "AKI_AMED",
}


def _collect(output: str) -> Build:
    return lambda x: collect_one(output, x.onsets, x.cdm, x.cfg, x.days)


def _collect_demographics(x: Extraction) -> DataFrame:
    return collect.collect_demographics(x.onsets, x.cdm["DEMOGRAPHIC"], x.cdm["DEATH"], x.cfg)


def _exported(x: Extraction, table: str) -> DataFrame:
    if table == "AKI_ONSETS":
        return x.aki_onsets
    if table == "AKI_DEMO_DEATH":
        return collect.collect_death(x.onsets, x.cdm["DEATH"])
    if table == "AKI_DEMO":
        return _collect_demographics(x)
    return collect_one(table, x.onsets, x.cdm, x.cfg, x.days)


def _shift(table: str) -> Build:
    return lambda x: deid.shift_table(
        table, _exported(x, table), deid.patient_shift(SALT, x.cfg), x.cfg
    )


def _attrition(era: str) -> dict[str, Build]:
    suffix = era.lower()
    return {
        f"attrition_initial_{suffix}": lambda x: attrition.attrition_initial(
            x.initial_cohort, era, x.cfg
        ),
        f"attrition_scr_{suffix}": lambda x: attrition.attrition_scr(x.init, era, x.cfg),
        f"attrition_exclusions_{suffix}": lambda x: attrition.attrition_exclusions(
            x.exclude_all, era, x.cfg
        ),
        f"attrition_outcomes_{suffix}": lambda x: attrition.attrition_outcomes(x.aki_onsets, era),
        f"consort_{suffix}": lambda x: x.consort(era),
    }


def _shift_by_table(x: Extraction) -> DataFrame:
    """The same shift through a stored table, as a site with its own shifts would."""
    labs = collect_one("AKI_LAB", x.onsets, x.cdm, x.cfg, x.days)
    return deid.shift_table("AKI_LAB", labs, deid.date_shift_table(x.onsets, SALT, x.cfg), x.cfg)


def _audit(rule: str, **options: bool) -> Build:
    def build(x: Extraction) -> DataFrame:
        rows = x.cdm[exclusions.AUDITED[rule].table]
        excluded = _FLAGGED[f"excl_{rule}"](x)
        return exclusions.exclusion_audit(rule, excluded, x.init, rows, **options)

    return build


# Tables that the round trip through files writes; the other optional ones are absent there.
STORED = ["ENCOUNTER", "DEMOGRAPHIC", "LAB_RESULT_CM", "DIAGNOSIS", "PROCEDURES", "DEATH", "VITAL"]


def _load_cdm(x: Extraction) -> DataFrame:
    """Rows and patients of each table of a site that was written to files and loaded from there."""
    root = x.work.folder("site")
    for name in STORED:
        x.cdm[name].write.parquet(f"{root}/{name.lower()}.parquet")
    counts = [
        df.agg(
            F.lit(name).alias("table_name"),
            F.count("*").alias("n_rows"),
            F.countDistinct("PATID").alias("n_patients"),
        )
        for name, df in cdm.load_cdm(x.spark, root).items()
    ]
    return reduce(DataFrame.unionByName, counts)


def _export_csv(x: Extraction) -> DataFrame:
    """Deaths, exported and read back as text."""
    folder = x.work.folder("csv")
    deaths = collect.collect_death(x.onsets, x.cdm["DEATH"])
    sinks.export_all({"AKI_DEMO_DEATH": deaths}, folder, sinks.RAW_EXPORTS)
    return x.spark.read.option("header", True).csv(f"{folder}/AKI_DEMO_DEATH")


def _export_manifest(x: Extraction) -> DataFrame:
    """What the manifest says of exported deaths, and whether the files agree."""
    folder = x.work.folder("csv")
    deaths = collect.collect_death(x.onsets, x.cdm["DEATH"])
    sinks.export_all({"AKI_DEMO_DEATH": deaths}, folder, sinks.RAW_EXPORTS)
    return sinks.verify_export(x.spark, folder).select("TABLE", "N_ROWS", "CHECKSUM", "INTACT")


SLICE_MONTHS = 24


def _sliced(x: Extraction) -> CohortResult:
    return extract_slices(x.spark, x.cdm, x.cfg, x.work, x.work.folder("slices"), SLICE_MONTHS)


def _sliced_consort(x: Extraction) -> DataFrame:
    result = _sliced(x)
    eras = {attrition.BEFORE: result.consort_bc, attrition.AFTER: result.consort_ad}
    frames = [counts.withColumn("ERA", F.lit(era)) for era, counts in eras.items()]
    return reduce(DataFrame.unionByName, frames)


def _baseline(x: Extraction) -> DataFrame:
    return x.baseline.drop("FIRST_TIME", "FIRST_EGFR")


def _match_all_scr(x: Extraction) -> DataFrame:
    """The default preset by separate steps, where the pipeline fuses them."""
    patients = cohort.cohort_patients(x.cdm["DEMOGRAPHIC"], x.initial_cohort)
    scr = cohort.all_scr_egfr(x.cdm["LAB_RESULT_CM"], patients, x.cfg, x.cfg.window_start)
    return cohort.match_labs_to_encounter(scr, x.initial_cohort, x.cfg)


def _matrix(x: Extraction) -> DataFrame:
    return x.work.cut(matrix.feature_matrix(x), "matrix")


def _halving_rungs(x: Extraction) -> DataFrame:
    """What each fit of the halving search works on: trees, candidates, and rows by fold."""
    folds = model.stratified_folds(
        _matrix(x).select("row_id", "label"), "row_id", seed=matrix.FOLDS_SEED
    )
    return model.halving_plan(folds, x.spark)


def _grid_parameters(x: Extraction) -> DataFrame:
    """The halving grid as parameters of the booster, for the training rows at hand."""
    return model.grid_table(_matrix(x).count(), x.spark)


def _default_fit(x: Extraction) -> DataFrame:
    train, test = matrix.split(_matrix(x))
    training = model.prepare(train, "row_id", x.work)
    return model.score(model.default_fit(training), training, test)


def _stored(x: Extraction) -> str:
    """Folder with the matrices of two settings."""
    root = x.work.folder("matrices")
    rows = _matrix(x)
    folds = model.stratified_folds(rows.select("row_id", "label"), "row_id", seed=matrix.FOLDS_SEED)
    matrix.store(rows.join(folds.drop("label"), "row_id"), root)
    return root


def _stored_matrix(x: Extraction) -> DataFrame:
    """All matrices as they come back from the store, with their year and split."""
    root, frames = _stored(x), []
    for setting in stored_settings(x.spark, root):
        for split, rows in zip(SPLITS, load_matrix(x.spark, root, **setting)):
            year = F.lit(setting["year"]).alias("year")
            frames.append(rows.select("*", year, F.lit(split).alias("split")))
    return reduce(DataFrame.unionByName, frames)


def _run_settings(x: Extraction) -> DataFrame:
    """Default fits of all stored settings: their rows, and whether both areas are in range."""
    root, results = _stored(x), x.work.folder("results")
    found = model.run_settings(root, ["catd"], "row_id", results, x.work)
    scored = F.col("auc").between(0, 1) & F.col("auc_probability").between(0.5, 1)
    return found.select(*model.RESULT_KEYS, "train_rows", "test_rows", scored.alias("scored"))


_MODEL: dict[str, tuple[Build, str | None]] = {
    "matrix": (matrix.feature_matrix, "matrix"),
    "class_weight": (lambda x: model.class_weight(matrix.feature_matrix(x)), "class_weight"),
    "stratified_folds": (
        lambda x: model.stratified_folds(
            x.work.cut(matrix.feature_matrix(x).select("row_id", "label"), "matrix"),
            "row_id",
            seed=matrix.FOLDS_SEED,
        ),
        "stratified_folds",
    ),
    "roc_auc": (
        lambda x: model.roc_auc(matrix.feature_matrix(x), "base_scr", x.work),
        "roc_auc",
    ),
    "boolean_features": (matrix.feature_kinds, "boolean_features"),
    "halving_rungs": (_halving_rungs, "halving_rungs"),
    "grid_parameters": (_grid_parameters, "grid_parameters"),
    "default_fit": (_default_fit, None),
    "stored_matrix": (_stored_matrix, "stored_matrix"),
    "run_settings": (_run_settings, "run_settings"),
}


def registry() -> dict[str, Query]:
    found: dict[str, Query] = {}
    for name, build in {**_COHORT, **_FLAGGED}.items():
        found[name] = Query(build, name)
    found["baseline_first"] = Query(_baseline, "baseline_first")
    found["baseline_prior_2d"] = Query(_baseline, "baseline_prior_2d", "tsql")
    found["match_labs_to_encounter"] = Query(_match_all_scr, "matched")
    found["excl_few_scr"] = Query(
        lambda x: exclusions.excl_few_scr(x.matched, x.cfg), "excl_few_scr", "tsql"
    )
    for rule in exclusions.AUDITED:
        found[f"audit_{rule}"] = Query(_audit(rule), f"audit_{rule}")
    found["audit_pre_esrd_every_code"] = Query(
        _audit("pre_esrd", every_code=True), "audit_pre_esrd_every_code"
    )
    for era in (attrition.BEFORE, attrition.AFTER):
        for name, build in _attrition(era).items():
            found[name] = Query(build, name)
    found["observation_window"] = Query(
        lambda x: collect.observation_window(x.aki_onsets)
        .select("ENCOUNTERID", "PATID", "ADMIT_DATE", "win_end")
        .distinct(),
        "observation_window",
    )
    found["collect_death"] = Query(
        lambda x: collect.collect_death(x.onsets, x.cdm["DEATH"]), "collect_death"
    )
    found["collect_demographics"] = Query(_collect_demographics, "collect_demographics")
    for name, output in _COLLECTED.items():
        found[name] = Query(_collect(output), name)
    found["date_shift_table"] = Query(
        lambda x: deid.date_shift_table(x.aki_onsets, SALT, x.cfg), "date_shift_table"
    )
    for table, (name, _) in oracle.SHIFT_SOURCES.items():
        found[name] = Query(_shift(table), name)
    found["shift_lab_by_table"] = Query(_shift_by_table, "shift_lab")

    found["load_cdm"] = Query(_load_cdm, "load_cdm")
    found["export_csv"] = Query(_export_csv, "export_csv")
    found["export_manifest"] = Query(_export_manifest, "export_manifest")
    found["consort"] = Query(lambda x: x.counts, "consort")
    found["aki_onsets_sliced"] = Query(lambda x: _sliced(x).onsets, "aki_onsets")
    found["consort_sliced"] = Query(_sliced_consort, "consort")
    found["aki_onsets_sliced_tsql"] = Query(lambda x: _sliced(x).onsets, "aki_onsets", "tsql")
    for name, (build, step) in _MODEL.items():
        found[name] = Query(build, step)

    # The rule variants of the other presets.
    variants = [
        "initial_cohort", "all_scr_egfr", "matched", "aki_scr_egfr", "exclude_all", "eligible",
        "rolling_48h_pairs", "ratio_stage", "rank_stages", "worst_per_day", "aki_onsets",
    ]
    for other in ("postgres", "tsql"):
        for name in variants:
            found[f"{name}_{other}"] = Query(_COHORT[name], name, other)
        for era in (attrition.BEFORE, attrition.AFTER):
            suffix = era.lower()
            found[f"consort_{suffix}_{other}"] = Query(
                _attrition(era)[f"consort_{suffix}"], f"consort_{suffix}", other
            )
        found[f"collect_prescribing_{other}"] = Query(
            _collect("AKI_PMED"), "collect_prescribing", other
        )
        found[f"collect_demographics_{other}"] = Query(
            _collect_demographics, "collect_demographics", other
        )
    found["rrt_stage3_tsql"] = Query(_COHORT["rrt_stage3"], "rrt_stage3", "tsql")
    found["shift_onsets_postgres"] = Query(_shift("AKI_ONSETS"), "shift_onsets", "postgres")
    return found


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: query.run for name, query in registry().items()}


def oracle_sql() -> dict[str, str]:
    return {name: q.sql() for name, q in registry().items() if q.step}
