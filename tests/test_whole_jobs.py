"""The model queries hand whole presets and search ranges to their operators (nothing is fitted here)."""

import inspect
import random

import pytest
from pyspark.ml.feature import VectorAssembler

from farelane.constants import BOOSTED_PRESETS, EARLY_STOPPING_ROUNDS, N_TRIALS
from farelane.ml import models as M
from farelane.plans import jobs
from farelane.plans import ml_catalog as C

SF = "/nowhere"


class Reached(Exception):
    pass


def given(monkeypatch, module, name):
    """The arguments of the call that the query makes, defaults included."""
    signature, seen = inspect.signature(getattr(module, name)), {}

    def stop(*args, **kw):
        bound = signature.bind(*args, **kw)
        bound.apply_defaults()
        seen.update(bound.arguments)
        raise Reached

    monkeypatch.setattr(module, name, stop)
    return seen


@pytest.fixture
def rows(spark, monkeypatch):
    df = spark.createDataFrame([(float(i), float(i)) for i in range(4)], "a double, label double")
    df = VectorAssembler(inputCols=["a"], outputCol="features").transform(df)
    monkeypatch.setattr(C, "_xy", lambda *_: dict.fromkeys(("train", "val", "test"), df))


def test_final_compare_fits_parameters_of_the_full_ranges(spark, rows, monkeypatch):
    seen = given(monkeypatch, M, "final_compare")
    with pytest.raises(Reached):
        C.q_final_compare(spark, SF)
    assert seen["best_params"] == M.draw_params(random.Random(42)) and seen["best_params"]["n_estimators"] >= 500


@pytest.mark.parametrize("query", [C.q_leaderboard, C.q_best_model])
def test_leaderboard_fits_full_presets(spark, rows, monkeypatch, query):
    seen = given(monkeypatch, M, "leaderboard")
    with pytest.raises(Reached):
        query(spark, SF)
    boosted = {m.name: m.estimator for m in seen["models"] if m.name.startswith("GBT-")}
    assert {n: (e.getMaxIter(), e.getMaxDepth()) for n, e in boosted.items()} == {f"GBT-{n}": (p["max_iter"], p["max_depth"]) for n, p in BOOSTED_PRESETS.items()}


def whole_search(seen):
    return seen["n_trials"] == N_TRIALS and seen["space"] == M.SEARCH_SPACE and seen["early_stopping_rounds"] == EARLY_STOPPING_ROUNDS


def test_trial_log_searches_the_full_ranges(spark, rows, monkeypatch):
    seen = given(monkeypatch, M, "param_search")
    with pytest.raises(Reached):
        C.q_trial_log(spark, SF)
    usual = {"eta": 3, "first_rung": M.BLOCK_TREES}
    assert whole_search(seen) and {k: seen[k] for k in usual} == usual


def test_training_job_modes_searches_the_full_ranges(spark, monkeypatch):
    monkeypatch.setattr(C, "_raw_trips", lambda *_: None)
    monkeypatch.setattr(jobs, "preprocess_job", lambda *_, **__: {"splits": SF, "preprocess": SF})
    seen = given(monkeypatch, jobs, "training_job")
    with pytest.raises(Reached):
        C.q_training_job_modes(spark, SF)
    assert seen["mode"] == "optimize" and whole_search(seen) and not seen["search"]


def test_models_of_a_leaderboard_keep_their_own_scores_side_by_side(spark):
    df = spark.createDataFrame([(float(i), float(3 * i)) for i in range(40)], "a double, label double")
    df = VectorAssembler(inputCols=["a"], outputCol="features").transform(df)
    models = [M.Contender("LinearRegression", M.linear_regression()), M.Contender("Ridge", M.ridge(df, 1000.0))]
    one, many = ({r["Model"]: r["RMSE"] for r in M.leaderboard(spark, models, df, df, parallel=p).collect()} for p in (1, 3))
    assert one == many and one["LinearRegression"] < one["Ridge"] < one[M.BASELINE]
