"""Analysis of variance, relations and weights against plain numpy."""

import numpy as np
import pandas as pd
import pytest

from waferlens.operators import balance, counts, models, relation, scores, shape, weights


def _facts(seed=1, wafers=30):
    r = np.random.default_rng(seed)
    rows = []
    for g in ("a", "b"):
        for w in range(wafers):
            label = int(r.random() < 0.4)
            for p in ("p1", "p2", "p3", "flat"):
                if r.random() < 0.15:
                    continue
                for _ in range(int(r.integers(1, 3))):
                    rows.append((g, f"{g}{w}", label, p, 1.0 if p == "flat" else float(r.normal(label * (p == "p1"), 1))))
    return pd.DataFrame(rows, columns=["G", "WAFER_ID", "label", "PARAMETRIC_NAME", "RESULT"])


def _anova(df):
    out = {}
    for g, own in df.groupby("G"):
        m = own.pivot_table(index=["WAFER_ID", "label"], columns="PARAMETRIC_NAME", values="RESULT")
        m = m.loc[:, m.nunique() > 1]
        y = m.index.get_level_values("label").to_numpy()
        m = m.groupby(level="label").transform(lambda x: x.fillna(x.mean()))
        f = {}
        for c in m:
            x = m[c].to_numpy()
            a, b = x[y == 0], x[y == 1]
            between = len(a) * (a.mean() - x.mean()) ** 2 + len(b) * (b.mean() - x.mean()) ** 2
            within = ((a - a.mean()) ** 2).sum() + ((b - b.mean()) ** 2).sum()
            f[c] = between / (within / (len(x) - 2))
        out |= {(g, c): (v, v / sum(f.values())) for c, v in f.items()}
    return out


def test_anova_equals_matrix(spark):
    df = _facts()
    got = {(r["G"], r["PARAMETRIC_NAME"]): (r["F"], r["IMPORTANCE"]) for r in scores.anova(spark.createDataFrame(df), ["G"]).collect()}
    want = _anova(df)
    assert got.keys() == want.keys()
    for k, v in want.items():
        assert got[k] == pytest.approx(v, rel=1e-9)


def test_anova_edges(spark):
    schema = "G string, WAFER_ID string, label int, PARAMETRIC_NAME string, RESULT double"
    assert scores.anova(spark.createDataFrame([], schema), ["G"]).count() == 0
    one_class = [("a", f"w{i}", 0, p, float(i)) for i in range(4) for p in ("x", "y")]
    got = scores.anova(spark.createDataFrame(one_class, schema), ["G"]).collect()
    assert {r["IMPORTANCE"] for r in got} == {0.0} and not any(r["SATISFIED"] for r in got)
    exact = [("a", f"w{i}", i % 2, p, float(i % 2) if p == "x" else float(i)) for i in range(6) for p in ("x", "y")]
    got = {r["PARAMETRIC_NAME"]: r for r in scores.anova(spark.createDataFrame(exact, schema), ["G"]).collect()}
    assert got["x"]["F"] is None and got["x"]["IMPORTANCE"] == 0.0


def _r2(y, p):
    sst = ((y - y.mean()) ** 2).sum()
    sse = ((y - p) ** 2).sum()
    return 1 - sse / sst if sst else float(sse == 0)


def _relation(x, y):
    if len(x) < 3 or len(set(x)) == 1 or len(set(y)) == 1:
        return 0.0
    k = 1 if len(x) == 3 else 2 if len(x) <= 5 else 3 if len(x) <= 21 else 5
    folds = [np.array([1, 2])] if k == 1 else np.array_split(np.arange(len(x)), k)
    best = 0.0
    root = np.sqrt(np.maximum(y, 0))
    # Features, target, whether allowed, whether an intercept is fitted by centring.
    for design, target, ok, centred in (
        (lambda v: v[:, None], y, True, True), (lambda v: v[:, None], y, True, False),
        (lambda v: np.stack([np.ones_like(v), v, v * v], 1), y, True, True), (lambda v: np.stack([np.ones_like(v), v, v * v], 1), y, True, False),
        (lambda v: v[:, None], root, y.min() >= 0, True), (lambda v: v[:, None], root, y.min() >= 0, False),
    ):
        if not ok:
            continue
        found = []
        for t in folds:
            train = np.array([0]) if k == 1 else np.setdiff1d(np.arange(len(x)), t)
            a, b = design(x[train]), target[train]
            ma, mb = (a.mean(0), b.mean()) if centred else (0, 0)
            w = np.linalg.lstsq(a - ma, b - mb, rcond=None)[0]
            found.append(_r2(target[t], (design(x[t]) - ma) @ w + mb))
        best = max(best, np.mean(found))
    return best if best <= 1 else 0.0


def test_relation_equals_least_squares(spark):
    r = np.random.default_rng(5)
    rows, want = [], {}
    for g, n in enumerate((1, 2, 3, 4, 5, 9, 21, 22, 60)):
        for kind in range(4):
            x = r.uniform(1, 9, n)
            y = (2 * x + 1, x * x - 3 * x, (0.5 * x + 1) ** 2, r.normal(5, 1, n))[kind] + r.normal(0, 0.3, n)
            key = f"{g}-{kind}"
            rows += [(key, f"w{i:03}", float(a), float(b)) for i, (a, b) in enumerate(zip(x, y, strict=True))]
            want[key] = (n, _relation(x, y))
    rows += [("const", f"w{i}", float(i), 70.0) for i in range(21)] + [("null", "w1", None, 1.0)]
    want["const"] = (21, 0.0)
    df = spark.createDataFrame(rows, "G string, W string, X double, Y double")
    got = {q["G"]: (q["PAIRS"], q["WEIGHT"]) for q in relation.relation(df.orderBy("Y"), ["G"], "X", "Y", ["W"]).collect()}
    assert got.keys() == want.keys()
    for k, (n, w) in want.items():
        assert got[k][0] == n
        assert got[k][1] == pytest.approx(w, abs=1e-7), k


def test_weights_sum_to_one_and_ranks_are_consecutive(spark):
    df = spark.createDataFrame(_facts(2))
    rows = scores.anova(df, ["G"]).withColumn("AUC", scores.F.lit(1.0)).withColumn("BAD_NUM", scores.F.col("N1"))
    out = weights.decorated(weights.weights_by_bad_and_auc(rows, ["G"], counts.bad_total(df)), "r").toPandas()
    assert out["WEIGHT"].sum() == pytest.approx(1)
    assert sorted(out["INDEX_NO"]) == list(range(1, len(out) + 1))


def test_pca_features_equal_svd(spark):
    r = np.random.default_rng(3)
    x = r.normal(size=(40, 6)) * [5, 3, 2, 1, 0.5, 0.2] @ np.linalg.qr(r.normal(size=(6, 6)))[0]
    rows = [("g", f"u{i}", f"f{j}", float(v)) for i, row in enumerate(x) for j, v in enumerate(row)]
    got = models.pca_features(spark.createDataFrame(rows, "G string, UNIT string, FEATURE string, RESULT double"), ["G"], normalise=False).collect()
    axes = np.linalg.svd(x - x.mean(0), full_matrices=False)[2][:4]
    want = sorted((f"f{np.argmax(np.abs(a))}", round(float(np.abs(a).max()), 6)) for a in axes)
    assert sorted((q["FEATURE"], round(q["IMPORTANCE"], 6)) for q in got) == want


def _harmonic(n):
    return sum(1 / i for i in range(1, int(n))) - np.euler_gamma


def _information(x, y, k=3):
    """The estimate by all distances."""
    kept = np.array([(y == c).sum() > 1 for c in y])
    x, y = x[kept], y[kept]
    if not len(x):
        return 0.0
    parts = []
    for i in range(len(x)):
        same = np.sort(np.abs(x[y == y[i]] - x[i]))
        own = min(k, len(same) - 1)
        parts.append(_harmonic(own) - _harmonic(len(same)) - _harmonic(max(1, (np.abs(x - x[i]) <= same[own] * (1 - 1e-10)).sum())))
    return max(0.0, _harmonic(len(x)) + np.mean(parts))


def test_information_equals_all_distances(spark):
    """Ties, repeated values, classes of one, two and none, and a copy of the class."""
    r = np.random.default_rng(0)
    y = r.integers(0, 2, 300)
    groups = {
        "copy": (y + r.normal(0, 0.05, 300), y), "noise": (r.normal(size=300), y), "tied": (r.integers(0, 6, 60).astype(float), y[:60]), "same": (np.ones(12), y[:12]),
        "one": (np.arange(6.0), np.array([0] * 5 + [1])), "two": (np.array([1.0, 2, 5, 7, 8]), np.array([0, 1, 0, 1, 1])), "single": (np.array([1.0]), np.array([1])), "pair": (np.array([1.0, 2]), np.array([0, 1])),
    }
    rows = [("g", f"w{i}", int(c), p, float(v)) for p, (x, ys) in groups.items() for i, (v, c) in enumerate(zip(x, ys, strict=True))]
    df = spark.createDataFrame([*rows, ("g", "w", 0, "copy", None), ("g", "w", None, "copy", 1.0)], "G string, WAFER_ID string, label int, PARAMETRIC_NAME string, RESULT double")
    got = {q.PARAMETRIC_NAME: q.MI for q in models.mutual_information(df, ["G"]).collect()}
    assert set(got) == set(groups)
    for p, (x, ys) in groups.items():
        assert got[p] == pytest.approx(_information(x, ys), abs=1e-9), p
    assert got["copy"] > 0.6 and got["noise"] < 0.08


def test_latest_run_drops_null_keys(spark):
    df = spark.createDataFrame([("w", "o", "c", 1, 1.0), ("w", "o", "c", 2, 2.0), ("w", "o", "c", 2, 2.0), ("w", None, "c", 3, 3.0)], "WAFER_ID string, OPE_NO string, CHAMBER_ID string, RUN_ID long, RESULT double")
    assert [r["RESULT"] for r in shape.latest_run(df).collect()] == [2.0]


def test_top_share(spark):
    df = spark.createDataFrame([("a", f"p{i}", float(i)) for i in range(5)] + [("b", "p", 1.0), ("c", "p1", 1.0), ("c", "p2", 2.0)], "G string, PARAMETRIC_NAME string, IMPORTANCE double")
    assert {r["G"]: r["count"] for r in weights.top_share(df, ["G"]).groupBy("G").count().collect()} == {"a": 3, "b": 1, "c": 1}


def test_undersample_balances(spark):
    r = np.random.default_rng(1)
    rows = [("g", f"u{i}", int(i < 5), f, float(r.normal())) for i in range(60) for f in ("a", "b")]
    vectors, _ = balance.class_vectors(scores.feature_means(spark.createDataFrame(rows, "G string, WAFER_ID string, label int, PARAMETRIC_NAME string, RESULT double"), ["G"]), ["G"])
    assert {q["label"]: q["count"] for q in balance.balanced_rows(vectors, ["G"]).groupBy("label").count().collect()} == {0: 5, 1: 5}


def test_centroid_scores_of_balanced_groups_are_plain_scores(spark):
    df = spark.createDataFrame(_facts(4))
    plain = {(r["G"], r["PARAMETRIC_NAME"]): r["IMPORTANCE"] for r in scores.anova(df, ["G"]).collect()}
    got = {(r["G"], r["PARAMETRIC_NAME"]): r["IMPORTANCE"] for r in balance.balanced_scores(df, ["G"]).collect()}
    assert got.keys() == plain.keys() and all(got[k] == pytest.approx(v, rel=1e-9) for k, v in plain.items())


def test_larger_class_shrinks_to_centroids():
    r = np.random.default_rng(0)
    x = np.concatenate([r.normal([0, 0], 0.1, (30, 2)), r.normal([9, 0], 0.1, (30, 2))])
    centres = balance.solve(x, r.random((60, balance.SEED_ROUNDS)), 2)
    assert sorted(np.round(centres[:, 0]).tolist()) == [0.0, 9.0]


def test_plain_relations_equal_polynomial_fits(spark):
    """R2 of the line, the quadratic and the line through squared y, by least squares of numpy."""
    rng = np.random.default_rng(5)
    x = rng.normal(40, 3, 60)
    groups = {
        "line": (x, 2 * x + rng.normal(0, 1, 60)), "curve": (x, (x - 40) ** 2 + rng.normal(0, 1, 60)), "root": (x, np.sqrt(10 * x - 100) + rng.normal(0, 0.01, 60)), "noise": (x, rng.normal(0, 1, 60)),
        "flat": (x, np.full(60, 2.0)), "same": (np.full(60, 3.0), x), "zero": (x, np.zeros(60)), "two": (np.array([1.0, 2.0] * 5), rng.normal(0, 1, 10)), "one": (np.array([1.0]), np.array([2.0])), None: (x, -x),
    }
    rows = [(g, float(a), float(b)) for g, (xs, ys) in groups.items() for a, b in zip(xs, ys, strict=True)]
    df = spark.createDataFrame([*rows, ("line", None, 1.0), ("line", 1.0, float("nan"))], "G string, A double, B double")
    got = {r.G: r for r in relation.relation_plain(df, ["G"], "A", "B").collect()}
    fitted = {r.G: r for r in relation.fitted_correlations(df, ["G"], "A", "B").collect()}
    assert set(got) == set(groups) == set(fitted)
    for g, (xs, ys) in groups.items():
        want = 0.0
        if len(xs) > 1 and np.ptp(xs) and np.ptp(ys):
            fits = [(1, ys), (1 if len(set(xs)) < 3 else 2, ys), (1, ys**2)]
            curves = [np.polyval(np.polyfit(xs, z, n), xs) for n, z in fits]
            want = max(1 - ((z - c) ** 2).sum() / ((z - z.mean()) ** 2).sum() for (_, z), c in zip(fits, curves, strict=True))
            r = [np.corrcoef(c, ys)[0, 1] for c in curves]
            assert [fitted[g].LINEAR, fitted[g].QUADRATIC, fitted[g].SQRT] == pytest.approx(r, abs=1e-6)
        assert got[g].WEIGHT == pytest.approx(want, abs=1e-8) and got[g].PAIRS == len(xs)
    assert {r.G: r.WEIGHT for r in relation.relation_plain(df, ["G"], "A", "B", threshold=0.9).collect()}["noise"] == 0


def test_missing_share_rule(spark):
    """Statistics with too many gaps in a group's rows go, other gaps take its mean; features that too few units have go."""
    rows = [("a", "x", 1.0), ("a", "x", None), ("a", "x", 5.0), ("a", "y", None), ("a", "y", None), ("a", "y", None), ("a", "y", 2.0), ("b", "y", None), ("b", "y", 4.0)]
    got = shape.fill_statistics(spark.createDataFrame(rows, "G string, STATS string, RESULT double"), ["G"]).collect()
    assert sorted(map(tuple, got)) == [("a", "x", 1.0), ("a", "x", 3.0), ("a", "x", 5.0), ("b", "y", 4.0), ("b", "y", 4.0)]
    cells = [("g", f"u{u}", f, float(u * k)) for k, (f, n) in enumerate([("often", 10), ("seldom", 3), ("rare", 2)], 1) for u in range(n)]
    df = spark.createDataFrame(cells, "G string, UNIT string, FEATURE string, RESULT double")
    assert {r.FEATURE for r in models.filled_matrix(df, ["G"], missing=0.7).collect()} == {"often", "seldom"}
    assert {r.FEATURE for r in models.filled_matrix(df, ["G"]).collect()} == {"often", "seldom", "rare"}
