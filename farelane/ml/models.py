"""Regression models, metrics, model bake-off and parameter search.

All fitting is distributed Spark ML; metrics are SQL aggregates over
``(label, prediction)``.  Only small result tables (one row per model or
trial) are built on the driver.
"""

from __future__ import annotations

import random
import time
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from datetime import datetime, timezone

from pyspark.ml.regression import GBTRegressor, LinearRegression
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from farelane.constants import BOOSTED_PRESETS, DEFAULT_SEED, EARLY_STOPPING_ROUNDS, N_TRIALS, RIDGE_ALPHA
from farelane.ml.boosting import BLOCK_TREES, BoostingRun, fit_until_stalled, has_stalled, stalled_at
from farelane.sources import sinks

BASELINE = "MeanBaseline"
LEADERBOARD_SCHEMA = "Model string, MAE double, RMSE double, R2 double, Fit_s double, Pred_s double"


# ---------------------------------------------------------------- J6
def regression_metrics(
    pred: DataFrame, label: str = "label", prediction: str = "prediction", groups: Sequence[str] = ()
) -> DataFrame:
    """``(MAE, RMSE, R2)`` per group (one row without groups).

    One pass: R2 uses the population variance times the count as the total sum
    of squares; constant labels give 1 when predicted exactly, else 0.
    """
    err = F.col(label) - F.col(prediction)
    agg = pred.groupBy(*groups).agg(
        F.avg(F.abs(err)).alias("MAE"),
        F.avg(err * err).alias("_mse"),
        F.sum(err * err).alias("_sse"),
        (F.var_pop(label) * F.count(label)).alias("_sst"),
    )
    r2 = (
        F.when(F.col("_sst") > 0, F.lit(1.0) - F.col("_sse") / F.col("_sst"))
        .when(F.col("_sse") == 0, F.lit(1.0))
        .otherwise(F.lit(0.0))
    )
    return agg.select(*groups, "MAE", F.sqrt("_mse").alias("RMSE"), r2.alias("R2"))


def metrics_dict(pred: DataFrame, label: str = "label", prediction: str = "prediction") -> dict:
    return regression_metrics(pred, label, prediction).first().asDict()


# ---------------------------------------------------------------- J1
def mean_baseline(train: DataFrame, val: DataFrame, label: str = "label") -> DataFrame:
    """Predict the training mean for every validation row."""
    return MeanPredictor().fit(train, label).transform(val.select(label))


# ---------------------------------------------------------------- J2 / J3 / J4 / J5
def linear_regression(features: str = "features", label: str = "label") -> LinearRegression:
    return LinearRegression(featuresCol=features, labelCol=label, solver="normal", regParam=0.0, elasticNetParam=0.0)


def ridge(train: DataFrame, alpha: float = RIDGE_ALPHA, features: str = "features", label: str = "label") -> LinearRegression:
    """Closed-form ridge ``||y - Xw||^2 + alpha ||w||^2`` with an unpenalised intercept.

    Spark scales the L2 term by the label's spread and averages the loss over
    rows, so the equivalent ``regParam`` is ``alpha * stddev_pop(label) / n``
    (normal-equation solver, no feature standardisation).
    """
    row = train.agg(F.stddev_pop(label).alias("s"), F.count(label).alias("n")).first()
    s, n = (row["s"] or 0.0), max(row["n"], 1)
    reg = alpha * s / n if s > 0 else alpha / n
    return LinearRegression(
        featuresCol=features, labelCol=label, solver="normal", regParam=reg, elasticNetParam=0.0, standardization=False
    )


def boosted_trees(preset: str = "lightgbm", seed: int = DEFAULT_SEED, **overrides) -> GBTRegressor:
    """Gradient-boosted trees with one of the three presets; ``overrides`` replace single settings, such as ``max_iter``."""
    p = BOOSTED_PRESETS[preset] | overrides
    frac = p["feature_fraction"]
    return GBTRegressor(
        maxIter=int(p["max_iter"]),
        maxDepth=int(p["max_depth"]),
        stepSize=float(p["step_size"]),
        subsamplingRate=float(p["subsampling_rate"]),
        featureSubsetStrategy="all" if frac >= 1.0 else str(frac),
        minInstancesPerNode=int(p.get("min_instances", 1)),
        minInfoGain=float(p.get("min_info_gain", 0.0)),
        seed=seed,
    )


def fit_with_validation(gbt: GBTRegressor, train: DataFrame, val: DataFrame, rounds: int = EARLY_STOPPING_ROUNDS, block: int = BLOCK_TREES, path: str | None = None):
    """Fit with early stopping after ``rounds`` stalled trees.

    Trees are fitted in blocks, and none after the block in which validation
    has stalled.  With a ``path`` an interrupted fit goes on where it stopped.
    """
    path = path or sinks.shared_dir(train.sparkSession, "boosting")
    return fit_until_stalled(BoostingRun(gbt, train, val, path), rounds, block)


# ---------------------------------------------------------------- J7 / J8
class MeanPredictor:
    """The mean baseline with the interface of an estimator."""

    def fit(self, train: DataFrame, label: str = "label") -> MeanPredictor:
        self.mean = train.agg(F.avg(label)).first()[0]
        return self

    def transform(self, rows: DataFrame) -> DataFrame:
        return rows.withColumn("prediction", F.lit(self.mean).cast("double"))


@dataclass(frozen=True)
class Contender:
    """A model of the bake-off; the mean baseline is the one without an estimator."""

    name: str
    estimator: object | None = None

    def __post_init__(self):
        if not self.name or (self.estimator is None) != (self.name == BASELINE):
            raise ValueError(f"only {BASELINE} goes without an estimator, and every model needs a name: {self.name!r}")


def leaderboard(spark: SparkSession, models: Sequence[Contender], train: DataFrame, val: DataFrame, parallel: int = 4) -> DataFrame:
    """Fit each model and the mean baseline, score on validation, sort by RMSE.

    ``parallel`` models are fitted side by side, as most of a tree's time is waiting for small jobs; the seconds are
    those that pass meanwhile.
    """
    if len(models) != len({m.name for m in models}):
        raise ValueError("models need different names")
    predictors = {BASELINE: MeanPredictor()} | {m.name: m.estimator or MeanPredictor() for m in models}

    def judged(name: str) -> tuple:
        predictor, clock = predictors[name], [time.perf_counter()]
        fitted = predictor.fit(train)
        clock.append(time.perf_counter())
        errors = metrics_dict(fitted.transform(val))  # predicts and scores in one job
        clock.append(time.perf_counter())
        return name, errors["MAE"], errors["RMSE"], errors["R2"], clock[1] - clock[0], clock[2] - clock[1]

    with ThreadPoolExecutor(max_workers=max(1, parallel)) as pool:
        rows = list(pool.map(judged, predictors))
    return spark.createDataFrame(rows, LEADERBOARD_SCHEMA).orderBy("RMSE")


def best_model(board: DataFrame) -> DataFrame:
    """Top row by RMSE, skipping the baseline unless it is alone."""
    return board.orderBy((F.col("Model") == BASELINE).cast("int"), "RMSE").limit(1)


# ---------------------------------------------------------------- J9 / J10
# --- fixed values: search ranges (low, high, step or "log") -------------------
SEARCH_SPACE = {
    "n_estimators": ("int", 500, 3000, 250),
    "learning_rate": ("float", 0.005, 0.2, "log"),
    "max_depth": ("int", 4, 16, 1),
    "min_child_samples": ("int", 10, 200, 1),
    "subsample": ("float", 0.6, 1.0, None),
    "colsample_bytree": ("float", 0.6, 1.0, None),
    "min_split_gain": ("float", 0.0, 1.0, None),
}


def draw_params(rng: random.Random, space: Mapping = SEARCH_SPACE) -> dict:
    import math

    out = {}
    for name, (kind, lo, hi, step) in space.items():
        if kind == "int":
            k = (hi - lo) // step
            out[name] = lo + step * rng.randint(0, k)
        elif step == "log":
            out[name] = math.exp(rng.uniform(math.log(lo), math.log(hi)))
        else:
            out[name] = rng.uniform(lo, hi)
    return out


def gbt_from_params(params: Mapping, seed: int = DEFAULT_SEED) -> GBTRegressor:
    """The boosted trees of a set of searched parameters, as they are drawn and logged."""
    return boosted_trees(
        "lightgbm",
        seed=seed,
        max_iter=int(params["n_estimators"]),
        max_depth=int(params["max_depth"]),
        step_size=float(params["learning_rate"]),
        subsampling_rate=float(params["subsample"]),
        feature_fraction=float(params["colsample_bytree"]),
        min_instances=int(params["min_child_samples"]),
        min_info_gain=float(params["min_split_gain"]),
    )


@dataclass
class Trial:
    number: int
    value: float | None
    state: str
    params: dict
    user_attrs: dict = field(default_factory=dict)
    duration: float | None = None
    datetime_start: str | None = None
    datetime_complete: str | None = None
    error: str | None = None


RUNNING, COMPLETE, PRUNED, FAIL = (f"TrialState.{x}" for x in ("RUNNING", "COMPLETE", "PRUNED", "FAIL"))


class _Attempt:
    """A trial and its boosting run, which is carried from rung to rung."""

    def __init__(self, number: int, params: dict, gbt: Callable[[], GBTRegressor], train: DataFrame, val: DataFrame, path: str, rounds: int | None):
        self.trial = Trial(number, None, RUNNING, params)
        self.make = lambda: BoostingRun(gbt(), train, val, path)
        self.run: BoostingRun | None = None
        self.rounds, self.rungs = rounds, 0

    @property
    def kept(self) -> int:
        losses = self.run.losses
        return stalled_at(losses, self.rounds) if self.rounds else len(losses)

    def best(self) -> float:
        return min(self.run.losses[: self.kept])

    def climb(self, to: int, block: int, deadline: float | None) -> None:
        """Fit up to ``to`` trees; an error or the time limit ends this trial only."""
        t = self.trial
        t.datetime_start = t.datetime_start or datetime.now(timezone.utc).isoformat()
        begun = time.time()
        try:
            self.run = self.run or self.make()
            wanted = min(to, self.run.gbt.getMaxIter())
            while self.run.n_trees < wanted and not (self.rounds and has_stalled(self.run.losses, self.rounds)):
                self.run.advance(min(wanted, self.run.n_trees + block), block, deadline)
            self.rungs += 1
            if self.run.n_trees >= self.run.gbt.getMaxIter() or (self.rounds and has_stalled(self.run.losses, self.rounds)):
                self.end(COMPLETE)
        except TimeoutError as ex:
            self.end(PRUNED if self.run and self.run.losses else FAIL, str(ex))
        except Exception as ex:  # noqa: BLE001 - whatever a trial's settings bring about, the search goes on
            self.end(FAIL, f"{type(ex).__name__}: {ex}"[:500])
        t.duration = (t.duration or 0.0) + time.time() - begun

    def end(self, state: str, error: str | None = None) -> None:
        t = self.trial
        t.state, t.error, t.datetime_complete = state, error, datetime.now(timezone.utc).isoformat()
        if state != FAIL:
            t.value = (self.run.losses[self.kept - 1] if state == COMPLETE else self.best()) ** 0.5
            t.user_attrs = {"valid_rmse": t.value, "n_trees": self.kept, "rungs": self.rungs}


def param_search(
    train: DataFrame,
    val: DataFrame,
    n_trials: int = N_TRIALS,
    timeout: float | None = None,
    seed: int = DEFAULT_SEED,
    early_stopping_rounds: int | None = EARLY_STOPPING_ROUNDS,
    space: Mapping = SEARCH_SPACE,
    eta: int | None = 3,
    first_rung: int = BLOCK_TREES,
    parallel: int = 4,
    path: str | None = None,
) -> tuple[float, dict, list[Trial]]:
    """Seeded random search over ``space`` minimising validation RMSE by successive halving.

    All trials fit ``first_rung`` trees; the best ``1/eta`` by validation loss
    go on to ``eta`` times as many, and so on, each from where it stopped; the
    rest are PRUNED with the loss they reached.  A trial is COMPLETE with all its
    trees or after ``early_stopping_rounds`` stalled ones (None: never).
    ``parallel`` trials run side by side; each is a distributed fit.  A trial
    that fails is logged as FAIL.  ``timeout`` (seconds) ends running trials
    between two trees.  ``eta=None`` prunes nothing.  States, values and parameters
    follow from the seed alone.
    """
    rng = random.Random(seed)
    path = path or sinks.shared_dir(train.sparkSession, "search")
    deadline = None if timeout is None else time.time() + timeout
    field_ = []
    for i in range(n_trials):
        params = draw_params(rng, space)
        field_.append(_Attempt(i, params, lambda p=params: gbt_from_params(p, seed), train, val, f"{path}/trial-{i:05d}", early_stopping_rounds))
    rung = first_rung if eta else max((int(a.trial.params["n_estimators"]) for a in field_), default=1)
    with ThreadPoolExecutor(max_workers=max(1, parallel)) as pool:
        alive = field_
        while alive:
            block = max(1, min(BLOCK_TREES, rung))
            list(pool.map(lambda a, to=rung, size=block: a.climb(to, size, deadline), alive))
            here = sorted((a for a in alive if a.trial.state in (RUNNING, COMPLETE)), key=lambda a: (a.best(), a.trial.number))
            if eta:
                for a in here[-(-len(here) // eta) :]:
                    if a.trial.state == RUNNING:
                        a.end(PRUNED)
            alive = [a for a in alive if a.trial.state == RUNNING]
            rung *= eta or 1
    trials = [a.trial for a in field_]
    done = [t for t in trials if t.state == COMPLETE]
    if not done:
        raise RuntimeError("no trial finished")
    best = min(done, key=lambda t: (t.value, t.number))
    return best.value, best.params, trials


def trial_log(spark: SparkSession, trials: Sequence[Trial]) -> DataFrame:
    """Trial table (J10): params as a map of numbers, attributes as a map."""
    rows = [
        (t.number, t.value, t.state, {k: float(v) for k, v in t.params.items()}, {k: float(v) for k, v in t.user_attrs.items()},
         t.duration, t.datetime_start, t.datetime_complete, t.error)
        for t in trials
    ]
    return spark.createDataFrame(
        rows,
        "number int, value double, state string, params map<string,double>, user_attrs map<string,double>, "
        "duration double, datetime_start string, datetime_complete string, error string",
    )


# ---------------------------------------------------------------- J11
def final_compare(
    spark: SparkSession,
    best_params: Mapping,
    train: DataFrame,
    val: DataFrame,
    test: DataFrame,
    seed: int = DEFAULT_SEED,
):
    """Fit the best parameters on train and on train+val, side by side, and score both on test.

    Returns ``(metrics DataFrame, train+val model)``; ``better`` prefers
    train+val on ties, as the reference does.
    """
    est = gbt_from_params(best_params, seed)

    def judged(rows: DataFrame) -> tuple:
        model = est.copy().fit(rows)
        return model, metrics_dict(model.transform(test))

    with ThreadPoolExecutor(max_workers=2) as pool:
        (_, r_train), (m_all, r_all) = pool.map(judged, [train, train.unionByName(val)])
    better = "TRAIN+VAL" if r_all["RMSE"] <= r_train["RMSE"] else "TRAIN only"
    rows = [
        ("train_only", "TEST", r_train["RMSE"], r_train["MAE"], r_train["R2"], better),
        ("train_val", "TEST", r_all["RMSE"], r_all["MAE"], r_all["R2"], better),
    ]
    df = spark.createDataFrame(rows, "mode string, split string, rmse double, mae double, r2 double, better string")
    return df, m_all
