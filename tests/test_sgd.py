"""Stochastic gradient machines against plain steps over single units, and large groups against small ones."""

import numpy as np
import pytest
from test_requests import _text

from waferlens.operators import sgd
from waferlens.plans import pipelines
from waferlens.plans.request import RequestError, parse


def _slope(loss, p, y):
    if loss == "hinge":
        return -y if p * y < 1 else 0.0
    if loss == "perceptron":
        return -y if p * y <= 0 else 0.0
    if loss == "log_loss":
        return -y / (1 + np.exp(p * y))
    return max(-sgd.EPSILON, min(sgd.EPSILON, p - y))


def _plain(x, y, batch, loss, penalty, alpha, epochs):
    w = np.zeros(x.shape[1])
    for t in range(epochs * sgd.BATCHES):
        own = [i for i in range(len(y)) if batch[i] == t % sgd.BATCHES]
        rate = sgd.RATE / (1 + t / sgd.BATCHES) ** 0.5
        g = sum((_slope(loss, float(x[i] @ w), y[i]) * x[i] for i in own), np.zeros(x.shape[1])) / max(len(own), 1)
        l1 = {"l1": 1.0, "elasticnet": sgd.ELASTIC}.get(penalty, 0.0) * alpha
        l2 = {"l2": 1.0, "elasticnet": 1 - sgd.ELASTIC}.get(penalty, 0.0) * alpha
        w = w - rate * (g + l2 * w)
        w = np.array([np.sign(v) * max(abs(v) - rate * l1, 0.0) for v in w])
    return w


def _data(n=120, seed=0):
    rng = np.random.default_rng(seed)
    y = np.where(rng.random(n) < 0.45, 1.0, -1.0)
    return rng.normal(y[:, None] * [1.2, 0.0, -0.5], 1), y, rng.integers(0, sgd.BATCHES, n), rng.integers(0, sgd.FOLDS, n)


def test_every_grid_point_takes_plain_steps():
    x, y, batch, fold = _data()
    grid = sgd.Grid()
    fits = sgd._Fits.of(grid)
    w = np.zeros((len(fits.loss), 3))
    for t in range(3 * sgd.BATCHES):
        own = batch == t % sgd.BATCHES
        w = sgd.stepped(w, *sgd.gradient(w, x[own], y[own], fold[own], fits), t, fits)
    for k, (loss, penalty, alpha) in enumerate(grid.points()):
        for f in range(sgd.FOLDS + 1):
            used = fold != f
            assert w[k * (sgd.FOLDS + 1) + f] == pytest.approx(_plain(x[used], y[used], batch[used], loss, penalty, alpha, 3), abs=1e-9), (loss, penalty, alpha, f)


def test_area_under_the_curve():
    rng = np.random.default_rng(1)
    s, y = rng.integers(0, 6, 80).astype(float), np.where(rng.random(80) < 0.3, 1.0, -1.0)
    pairs = [(a > b) + (a == b) / 2 for a in s[y > 0] for b in s[y < 0]]
    assert sgd.auc(s, y) == pytest.approx(np.mean(pairs)) and np.isnan(sgd.auc(s, np.ones(80)))


def _rows(spark, groups):
    rows = [(g, f"w{i:03d}", int(y[i] > 0), f"p{j}", float(x[i, j])) for g, (x, y, *_) in groups.items() for i in range(len(y)) for j in range(3)]
    rows += [("one class", f"w{i}", 0, p, float(i)) for i in range(4) for p in ("p0", "p1")] + [("one feature", f"w{i}", i % 2, "p0", float(i)) for i in range(6)]
    return spark.createDataFrame(rows, "G string, WAFER_ID string, label int, PARAMETRIC_NAME string, RESULT double")


def test_large_groups_take_the_same_steps(spark):
    df, grid = _rows(spark, {"a": _data(seed=2), "b": _data(90, seed=3)}), sgd.Grid(losses=("hinge", "huber"), penalties=("l2",), alphas=(0.01,))

    def found(**options):
        return {(r.G, r.PARAMETRIC_NAME): r for r in sgd.importances(df, ["G"], grid, epochs=1, **options).collect()}

    whole, parts = found(), found(block_units=100)
    assert whole.keys() == parts.keys() and len(whole) == 9
    for k, r in whole.items():
        assert (parts[k].MODEL, parts[k].IMPORTANCE, parts[k].AUC) == (r.MODEL, pytest.approx(r.IMPORTANCE, abs=1e-9), pytest.approx(r.AUC, abs=1e-9)), k
    assert whole["a", "p0"].IMPORTANCE > whole["a", "p1"].IMPORTANCE and whole["a", "p0"].AUC > 0.8
    assert {r.IMPORTANCE for k, r in whole.items() if k[0].startswith("one")} == {0.0}


@pytest.mark.parametrize("model", ["sgd", *(f"sgd:{loss}" for loss in sgd.LOSSES)])
def test_requests_reach_every_loss(spark, model):
    assert parse(_text(model=model)).model == model
    found = {r.PARAMETRIC_NAME: r.WEIGHT for r in pipelines.score_groups(_rows(spark, {"a": _data(seed=4)}), ["G"], "r", model=model).collect() if r.G == "a"}
    assert found["p0"] == max(found.values()) > 0


def test_unknown_losses_are_errors():
    with pytest.raises(RequestError):
        parse(_text(model="sgd:squared"))


def test_ranges_of_scores_count_every_pair_and_features_may_stand_side_by_side(spark, monkeypatch):
    """Many equal scores, blocks of a few units, and more ranges than scores: areas are those of one block."""
    rng = np.random.default_rng(11)
    y = rng.random(150) < 0.4
    rows = [("g", f"w{i:03d}", int(y[i]), float(rng.integers(0, 3) + y[i]), float(rng.integers(0, 2))) for i in range(150)]
    wide = spark.createDataFrame(rows, "G string, WAFER_ID string, label int, a double, b double")
    long = wide.selectExpr("G", "WAFER_ID", "label", "stack(2, 'a', a, 'b', b) as (PARAMETRIC_NAME, RESULT)")
    grid = sgd.Grid(losses=("hinge", "log_loss"), penalties=(None,), alphas=(0.01,))
    monkeypatch.setattr(sgd, "HELD_BLOCKS", 2)
    found = [{r.PARAMETRIC_NAME: r for r in sgd.importances(df, ["G"], grid, epochs=1, **more).collect()} for df, more in ((long, {}), (wide, {"features": ["a", "b"], "block_units": 40}))]
    for k, r in found[0].items():
        assert (found[1][k].MODEL, found[1][k].IMPORTANCE, found[1][k].AUC) == (r.MODEL, pytest.approx(r.IMPORTANCE, abs=1e-9), pytest.approx(r.AUC, abs=1e-9)), k
    assert set(found[1]) == {"a", "b"}
