"""End-to-end jobs (L1, L2).

``preprocess_job`` goes from the raw monthly files to the feature table in two
plans: schema alignment, month filter, missing-value policy and range filter
are written, then id fixes, zone and calendar joins and features, written once,
partitioned by month; the split sampler then reads that table (it scans its
input once per pass, so the expensive plan is not recomputed), the splits
are written, and the feature pipeline is fitted on the training rows.

``training_job`` runs one of the modelling modes on the written splits.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from farelane.constants import DEFAULT_SEED, EARLY_STOPPING_ROUNDS, FILE_MONTH, MONTH_FILE_GLOB, SAMPLE_ROWS_PER_MONTH, TRAINING_MODES
from farelane.functions.calendar import holiday_calendar
from farelane.ml import models as M
from farelane.ml import preprocess as P
from farelane.operators import clean, features, sampling, schema
from farelane.sources import sinks
from farelane.sources.monthly import parse_year_month


def list_month_files(spark: SparkSession, src_dir: str, pattern: str = MONTH_FILE_GLOB) -> list[str]:
    """Paths of the monthly files in ``src_dir``, ordered by name (A1); FileNotFoundError where there are none."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    where = hadoop.Path(f"{src_dir.rstrip('/')}/{pattern}")
    matches = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(where)
    paths = sorted(m.getPath().toString() for m in matches or ())
    if paths:
        return paths
    raise FileNotFoundError(f"nothing in {src_dir} matches {pattern}")


def read_raw_months(spark: SparkSession, files: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Schema drift report (B1) and the column-normalised union of all months (B2).

    Each file is read with its own footer schema, aligned on the first file's
    kept columns and tagged with the month from its name; the result is a
    plain UNION ALL of scans (no shuffle).
    """
    drift = schema.schema_drift(schema.column_table(spark, files))
    frames = [spark.read.parquet(f) for f in files]
    months = []
    for f in files:
        y, m = parse_year_month(f)
        months.append(f"{y:04d}-{m:02d}")
    return drift, schema.normalize_columns(frames, tags={FILE_MONTH: months})


def clean_and_build(
    trips: DataFrame,
    lookup: DataFrame,
    zones: DataFrame | None,
    holidays: DataFrame,
    policy: Mapping[int, str] | None = None,
) -> DataFrame:
    """C1 -> C6 -> C7, written, -> E10 as a lazy plan (in one stage the generated method is too long for the JVM to compile)."""
    mf = clean.month_filter(trips)
    mh = clean.missing_policy(mf) if policy is None else clean.missing_policy(mf, policy)
    return features.build_features(sinks.materialize(clean.range_filter(mh), "cleaned"), holidays, lookup, zones)


def preprocess_job(
    spark: SparkSession,
    out_dir: str,
    lookup: DataFrame,
    zones: DataFrame | None,
    raw_dir: str | None = None,
    trips: DataFrame | None = None,
    holidays: DataFrame | None = None,
    sample_rows: Mapping[str, int] = SAMPLE_ROWS_PER_MONTH,
    seed: int = DEFAULT_SEED,
    key: str = "trip_id",
    fit: bool = True,
) -> dict[str, str]:
    """The eight preparation stages (L1); returns the written paths.

    Input is either ``raw_dir`` (monthly files) or an already-read ``trips``
    frame with ``file_month``.  Trips need a unique ``key`` for sampling; raw
    files without one get a deterministic id from (month, row hash).
    """
    holidays = holiday_calendar(spark) if holidays is None else holidays
    paths: dict[str, str] = {}
    if trips is None:
        if raw_dir is None:
            raise ValueError("give raw_dir or trips")
        files = list_month_files(spark, raw_dir)
        drift, trips = read_raw_months(spark, files)
        paths["schema_drift"] = f"{out_dir}/schema_drift"
        drift.coalesce(1).write.mode("overwrite").parquet(paths["schema_drift"])
    if key not in trips.columns:
        trips = trips.withColumn(key, F.xxhash64(*[F.col(c) for c in trips.columns]))
    feats = clean_and_build(trips, lookup, zones, holidays)
    paths["features"] = f"{out_dir}/features_built"
    sinks.write_months(feats, paths["features"])
    built = spark.read.parquet(paths["features"])
    splits = sampling.build_splits(built, sample_rows, key, seed)
    paths["splits"] = f"{out_dir}/splits"
    sinks.write_splits(splits, paths["splits"])
    if fit:
        train = spark.read.parquet(paths["splits"]).where(F.col("split") == "train")
        model = P.fit_preprocess(P.build_preprocess(), train)
        paths["preprocess"] = P.save_preprocess(model, f"{out_dir}/artifacts/preprocess")
    return paths


def model_registry(train: DataFrame, seed: int = DEFAULT_SEED, max_iter: int | None = None) -> dict[str, Callable[[], M.Contender]]:
    """The models that ``training_job`` can evaluate, by the name a caller gives; ``max_iter`` replaces the presets' tree counts."""
    more = {} if max_iter is None else {"max_iter": max_iter}
    known = {
        "linear_reg": lambda: M.Contender("LinearRegression", M.linear_regression()),
        "ridge": lambda: M.Contender("Ridge", M.ridge(train)),
    }
    for preset in M.BOOSTED_PRESETS:
        known[preset] = lambda p=preset: M.Contender(f"GBT-{p}", M.boosted_trees(p, seed=seed, **more))
    return known


def evaluate(spark, train, val, artifact_dir: str, models: Sequence[str], seed: int, max_iter: int | None) -> DataFrame:
    known = model_registry(train, seed, max_iter)
    unknown = sorted(set(models) - set(known))
    if unknown:
        raise ValueError(f"no such models: {unknown}; there are {sorted(known)}")
    board = M.leaderboard(spark, [known[name]() for name in models], train, val)
    return spark.read.schema(M.LEADERBOARD_SCHEMA).json(sinks.write_metrics(board, f"{artifact_dir}/model_experiments") + "/json").orderBy("RMSE")


def optimize(spark, train, val, artifact_dir: str, n_trials: int, timeout, seed: int, early_stopping_rounds, space: Mapping, search: Mapping) -> DataFrame:
    _, params, trials = M.param_search(train, val, n_trials, timeout, seed, early_stopping_rounds, space, **search)
    log = M.trial_log(spark, trials)
    flat = log.withColumns({c: F.to_json(c) for c in ("params", "user_attrs")})
    sinks.write_metrics(flat, f"{artifact_dir}/optimize/trials")
    sinks.write_json_text(spark, params, f"{artifact_dir}/optimize/best_params")
    return log


def training_job(
    spark: SparkSession,
    mode: str,
    splits_dir: str,
    preprocess_dir: str,
    artifact_dir: str,
    models: Sequence[str] = ("ridge", "xgboost", "lightgbm", "catboost"),
    opt_model: str = "lightgbm",
    n_trials: int = 50,
    timeout: float | None = None,
    early_stopping_rounds: int | None = EARLY_STOPPING_ROUNDS,
    seed: int = DEFAULT_SEED,
    max_iter: int | None = None,
    space: Mapping = M.SEARCH_SPACE,
    search: Mapping | None = None,
) -> DataFrame:
    """evaluate / optimize / test on the written splits (L2).

    Other modes, models to optimise other than lightgbm and unknown model
    names are errors, the first two before anything is read.  The transformed
    splits are written once and read by every fit.  ``search`` holds further
    settings of the parameter search (pruning, trials side by side).
    """
    if mode not in TRAINING_MODES:
        raise ValueError(f"mode must be one of {TRAINING_MODES}, not {mode!r}")
    if mode == "optimize" and opt_model.lower() != "lightgbm":
        raise ValueError(f"the search is defined for lightgbm, not for {opt_model!r}")
    parts = P.transform_splits(spark.read.parquet(splits_dir), P.load_preprocess(preprocess_dir))
    train, val, test = (sinks.materialize(parts[s], f"transformed_{s}") for s in ("train", "val", "test"))
    if mode == "evaluate":
        return evaluate(spark, train, val, artifact_dir, models, seed, max_iter)
    if mode == "optimize":
        return optimize(spark, train, val, artifact_dir, n_trials, timeout, seed, early_stopping_rounds, space, search or {})
    params = sinks.read_json_text(spark, f"{artifact_dir}/optimize/best_params")
    result, model = M.final_compare(spark, params, train, val, test, seed)
    model.write().overwrite().save(f"{artifact_dir}/final/model")
    sinks.write_metrics(result, f"{artifact_dir}/final/metrics")
    return result
