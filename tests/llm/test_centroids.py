import numpy as np
from compare import same

from waferlens.llm import centroids, registry


def _plain(x, c, rounds):
    for _ in range(rounds):
        d = ((x[:, None] - c[None]) ** 2).sum(-1)
        own = d.argmin(1)
        c = np.array([x[own == k].sum(0) // max((own == k).sum(), 1) if (own == k).any() else c[k] for k in range(len(c))])
    d = ((x[:, None] - c[None]) ** 2).sum(-1)
    return d.argmin(1), d.min(1), c


def test_query_equals_sql(spark, data, duck):
    same(registry.op11_centroids(spark, data).toPandas(), duck.execute(centroids.oracle()).df())


def _bounded(x, c, rounds, kept):
    """The rounds of the operator on one batch, with every bound checked against all distances."""
    b, looked = centroids.Bounds(x, c, kept), []
    for _ in range(rounds):
        after = np.array([x[b.cluster == k].sum(0) // max((b.cluster == k).sum(), 1) if (b.cluster == k).any() else c[k] for k in range(len(c))])
        shifts = np.sqrt(((after - c) ** 2).sum(1).astype(float)) * (1 + 1e-9)
        c = after
        b.move(c, shifts, b.kept)
        d = np.sqrt(((x[:, None] - c[None]) ** 2).sum(-1).astype(float))
        every = np.arange(len(x))
        assert (b.upper >= d[every, b.cluster]).all()
        listed = np.take_along_axis(d, b.near, 1)
        assert (b.lower <= listed + 1e-9).all()
        others = d.copy()
        others[every, b.cluster] = np.inf
        np.put_along_axis(others, b.near, np.inf, 1)
        assert (b.rest <= others.min(1) + 1e-9).all()
        looked.append(int(np.minimum(b.needed + 1, len(c)).sum()))
    return b.cluster, looked


def test_bounds_hold_and_give_plain_rounds():
    rng = np.random.default_rng(0)
    for n, k, dims, spread, kept in ((500, 8, 64, 300, 4), (800, 20, 3, 20, 5), (300, 12, 2, 2, 3), (50, 8, 4, 1, 7), (400, 40, 8, 500, 10)):
        x = rng.integers(-spread, spread + 1, (n, dims))
        start = x[rng.choice(n, k, replace=False)]
        found, looked = _bounded(x, start, 8, kept)
        assert (found == _plain(x, start, 8)[0]).all()
        if spread >= 300:
            assert looked[-1] < n * k


def test_separate_clusters_are_not_measured_again():
    rng = np.random.default_rng(1)
    x = np.concatenate([rng.integers(-5, 6, (100, 8)) + 1000 * k for k in range(10)])
    b = centroids.Bounds(x, x[::100].copy(), 4)
    b.move(x[::100] + 1, np.full(10, np.sqrt(8.0) * (1 + 1e-9)), 4)
    assert (b.needed == 0).all()


def test_wide_components_stay_exact():
    x = np.array([[1 << 26, -(1 << 26)] * 32, [(1 << 26) - 1, 5] * 32], np.int64)
    assert centroids.squared(x, x).tolist() == [[sum((int(a) - int(b)) ** 2 for a, b in zip(p, q, strict=True)) for q in x] for p in x]


def test_hard_rows(spark):
    rng = np.random.default_rng(2)
    good = [(i, rng.normal(size=64).tolist()) for i in range(20)]
    rows = good + good[:3] + [(None, [0.5] * 64), (30, None), (31, [1.0] * 63), (32, [float("nan")] + [1.0] * 63), (33, [None] + [1.0] * 63), (34, [float("inf")] * 64), (35, [0.0] * 64), (36, [])]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "vec_id long, embedding array<double>, cluster string, v int")
    found = centroids.cluster(df).collect()
    assert sorted((-1 if r.vec_id is None else r.vec_id) for r in found) == sorted([*range(20), 0, 1, 2, -1, 35])
    assert sum(r.distance for r in found) == found[0].inertia
    assert centroids.cluster(df.limit(0)).collect() == [] and centroids.cluster(df.filter("vec_id = 31")).collect() == []
    few = centroids.cluster(spark.createDataFrame(good[:3], "vec_id long, embedding array<double>")).collect()
    assert sorted(r.cluster for r in few) == [0, 1, 2] and {r.distance for r in few} == {0}
    same_rows = centroids.cluster(spark.createDataFrame([(k, [1.5] * 64) for k in range(12)], "vec_id long, embedding array<double>")).collect()
    assert {(r.cluster, r.distance, r.inertia) for r in same_rows} == {(0, 0, 0)}


def test_rounds_leave_one_table(spark, data):
    from pathlib import Path

    from waferlens.llm.common import _folder

    def tables():
        return {p.name for p in Path(_folder(spark)).glob("*") if p.name.startswith(("bounds-", "vectors-", "clusters-"))}

    before = tables()
    registry.op11_centroids(spark, data).count()
    assert [n.split("-")[0] for n in tables() - before] == ["clusters"]
