"""Parameter search by successive halving: same log for a seed, pruning, failing trials, limits."""

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler

from farelane.ml import models as M

SPACE = M.SEARCH_SPACE | {"n_estimators": ("int", 6, 9, 1), "max_depth": ("int", 2, 3, 1)}


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(500, 2))
    y = 4 * np.sin(x[:, 0]) + x[:, 1] + rng.normal(scale=0.5, size=500)
    df = spark.createDataFrame([(*map(float, r), float(t), i < 350) for i, (r, t) in enumerate(zip(x, y))], "a double, b double, label double, train boolean")
    df = VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(df).persist()
    return df.filter("train"), df.filter("not train")


def facts(trials):
    return [(t.number, t.state, t.value, t.params, t.user_attrs) for t in trials]


def test_halving_prunes_and_is_the_same_for_a_seed(spark, data, tmp_path):
    train, val = data
    runs = [M.param_search(train, val, n_trials=6, seed=7, early_stopping_rounds=None, space=SPACE, eta=3, first_rung=2, parallel=p, path=str(tmp_path / f"p{p}")) for p in (1, 4)]
    assert facts(runs[0][2]) == facts(runs[1][2])
    value, params, trials = runs[0]
    states = [t.state for t in trials]
    assert states.count(M.PRUNED) >= 4 and states.count(M.COMPLETE) >= 1 and len(states) == 6
    done = [t for t in trials if t.state == M.COMPLETE]
    assert value == min(t.value for t in done) and params in [t.params for t in done]
    # the winner's value is the validation error of an ordinary fit with its parameters
    best = next(t for t in done if t.value == value)
    if params["subsample"] >= 1.0:
        fitted = M.gbt_from_params(params, 7).fit(train)
        assert M.metrics_dict(fitted.transform(val))["RMSE"] == pytest.approx(value)
    assert best.user_attrs["n_trees"] == params["n_estimators"]
    # at the first rung the trials that went on were not worse than those that did not
    log = M.trial_log(spark, trials)
    assert log.count() == 6 and log.filter("state = 'TrialState.PRUNED' and value is null").count() == 0


def test_a_failing_trial_does_not_end_the_search(data, tmp_path, monkeypatch):
    train, val = data
    real = M.gbt_from_params
    bad = []

    def sometimes(params, seed):
        if not bad or params is bad[0]:
            bad.append(params)
            raise ValueError("broken settings")
        return real(params, seed)

    monkeypatch.setattr(M, "gbt_from_params", sometimes)
    _, _, trials = M.param_search(train, val, n_trials=3, seed=1, early_stopping_rounds=None, space=SPACE, eta=None, parallel=1, path=str(tmp_path / "s"))
    assert [t.state for t in trials] == [M.FAIL, M.COMPLETE, M.COMPLETE]
    assert trials[0].value is None and "broken settings" in trials[0].error


def test_real_ranges_with_early_stopping(data, tmp_path):
    """The search space as it is: thousands of trees, of which validation lets few be fitted."""
    train, val = data
    small = M.SEARCH_SPACE | {"learning_rate": ("float", 0.15, 0.2, "log")}  # stalls soon
    _, params, trials = M.param_search(train, val, n_trials=3, seed=3, early_stopping_rounds=2, space=small, eta=3, first_rung=3, path=str(tmp_path / "s"))
    assert 500 <= params["n_estimators"] <= 3000 and {t.state for t in trials} <= {M.COMPLETE, M.PRUNED}
    best = min((t for t in trials if t.state == M.COMPLETE), key=lambda t: t.value)
    assert best.user_attrs["n_trees"] < 500


def test_time_limit_ends_running_trials(data, tmp_path):
    train, val = data
    big = SPACE | {"n_estimators": ("int", 100_000, 100_000, 1)}
    with pytest.raises(RuntimeError, match="no trial finished"):
        M.param_search(train, val, n_trials=2, timeout=4, seed=1, early_stopping_rounds=None, space=big, eta=None, path=str(tmp_path / "s"))


def test_search_goes_on_where_it_stopped(data, tmp_path):
    train, val = data
    path = str(tmp_path / "s")
    first = M.param_search(train, val, n_trials=2, seed=5, early_stopping_rounds=None, space=SPACE, eta=None, path=path)
    again = M.param_search(train, val, n_trials=2, seed=5, early_stopping_rounds=None, space=SPACE, eta=None, path=path)
    assert facts(first[2]) == facts(again[2])
    assert max(t.duration for t in again[2]) < max(t.duration for t in first[2])
