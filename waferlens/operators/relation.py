"""How well one variable explains another: the best cross-validated R2 of a family of models.

Linear, quadratic and square-root models with and without intercept, each
scored over unshuffled contiguous folds.  Everything follows from sums per
fold, so a group is aggregated and never gathered.  Values that are related to
the same variable stay side by side, and rows move once, to their place.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
from pyarrow import dataset, fs
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.tables import deleted, qualified, scratch_path
from . import numbering

#: Sums per fold: x and y are shifted (and x scaled) by the group for models with intercept; X_, Y_ are raw; s is sqrt(Y_), t the shifted s.
SUMS = {
    "n": "1.0D", "x": "x", "x2": "x*x", "x3": "x*x*x", "x4": "x*x*x*x", "y": "y", "yy": "y*y", "xy": "x*y", "x2y": "x*x*y",
    "t": "t", "tt": "t*t", "xt": "x*t", "rx": "X_", "rxx": "X_*X_", "rx3": "X_*X_*X_", "rx4": "X_*X_*X_*X_", "rxy": "X_*Y_", "rx2y": "X_*X_*Y_", "ryy": "Y_*Y_", "ry": "Y_", "rxs": "X_*s", "rss": "s*s", "rs": "s",
}
#: Steps from the training sums (b_*) to coefficients; each uses what earlier steps name.
STEPS = (
    {
        "vx": "b_n * b_x2 - b_x * b_x",
        "det": "b_n * (b_x2 * b_x4 - b_x3 * b_x3) - b_x * (b_x * b_x4 - b_x3 * b_x2) + b_x2 * (b_x * b_x3 - b_x2 * b_x2)",
        # Raw moments for a quadratic that training leaves open: least-norm solutions, as least squares gives them.
        "c11": "b_rxx - b_rx * b_rx / nullif(b_n, 0.0D)", "c22": "b_rx4 - b_rxx * b_rxx / nullif(b_n, 0.0D)",
        "c1y": "b_rxy - b_rx * b_ry / nullif(b_n, 0.0D)", "c2y": "b_rx2y - b_rxx * b_ry / nullif(b_n, 0.0D)",
        "tr": "b_n + b_rxx + b_rx4",
        "m2": "(b_n * b_rxx - b_rx * b_rx) + (b_n * b_rx4 - b_rxx * b_rxx) + (b_rxx * b_rx4 - b_rx3 * b_rx3)",
    },
    {
        "two": "vx > 1e-9 * b_n * b_n", "whole": "det > 1e-9 * b_n * b_n * b_n",
        "k_y": "CASE WHEN vx > 1e-12 * b_n * b_n THEN (b_n * b_xy - b_x * b_y) / vx ELSE 0.0D END", "k_t": "CASE WHEN vx > 1e-12 * b_n * b_n THEN (b_n * b_xt - b_x * b_t) / vx ELSE 0.0D END",
        "o_y": "CASE WHEN b_rxx > 0 THEN b_rxy / b_rxx ELSE 0.0D END", "o_s": "CASE WHEN b_rxx > 0 THEN b_rxs / b_rxx ELSE 0.0D END",
        "h0": "tr * b_ry - (b_n * b_ry + b_rx * b_rxy + b_rxx * b_rx2y)", "h1": "tr * b_rxy - (b_rx * b_ry + b_rxx * b_rxy + b_rx3 * b_rx2y)", "h2": "tr * b_rx2y - (b_rxx * b_ry + b_rx3 * b_rxy + b_rx4 * b_rx2y)",
    },
    {
        "i_y": "(b_y - k_y * b_x) / nullif(b_n, 0.0D)", "i_t": "(b_t - k_t * b_x) / nullif(b_n, 0.0D)",
        "q0": "CASE WHEN whole THEN (b_y * (b_x2 * b_x4 - b_x3 * b_x3) - b_x * (b_xy * b_x4 - b_x3 * b_x2y) + b_x2 * (b_xy * b_x3 - b_x2 * b_x2y)) / det END",
        "q1": "CASE WHEN whole THEN (b_n * (b_xy * b_x4 - b_x3 * b_x2y) - b_y * (b_x * b_x4 - b_x3 * b_x2) + b_x2 * (b_x * b_x2y - b_xy * b_x2)) / det END",
        "q2": "CASE WHEN whole THEN (b_n * (b_x2 * b_x2y - b_xy * b_x3) - b_x * (b_x * b_x2y - b_xy * b_x2) + b_y * (b_x * b_x3 - b_x2 * b_x2)) / det END",
        "w1": "CASE WHEN two THEN c1y / (c11 + c22) ELSE 0.0D END", "w2": "CASE WHEN two THEN c2y / (c11 + c22) ELSE 0.0D END",
        "g0": "CASE WHEN two THEN h0 / m2 ELSE b_ry / nullif(tr, 0.0D) END", "g1": "CASE WHEN two THEN h1 / m2 ELSE b_rxy / nullif(tr, 0.0D) END", "g2": "CASE WHEN two THEN h2 / m2 ELSE b_rx2y / nullif(tr, 0.0D) END",
    },
    {"w0": "(b_ry - w1 * b_rx - w2 * b_rxx) / nullif(b_n, 0.0D)"},
)


def _r2(sse: str, sst: str) -> str:
    return f"CASE WHEN {sst} > 1e-12 * a_scale THEN 1 - ({sse}) / ({sst}) WHEN ({sse}) <= 1e-12 * a_scale THEN 1.0D ELSE 0.0D END"


def model_sql() -> dict[str, str]:
    """R2 on a fold (sums a_*) of models whose coefficients STEPS names, as SQL."""

    def line(v: str) -> str:
        k, i = f"k_{v}", f"i_{v}"
        return _r2(f"a_{v}{v} - 2 * {i} * a_{v} - 2 * {k} * a_x{v} + {i} * {i} * a_n + 2 * {i} * {k} * a_x + {k} * {k} * a_x2", f"(a_{v}{v} - a_{v} * a_{v} / a_n)")

    def origin(k: str, xy: str, yy: str, y: str) -> str:
        return _r2(f"a_{yy} - 2 * {k} * a_{xy} + {k} * {k} * a_rxx", f"(a_{yy} - a_{y} * a_{y} / a_n)")

    def curve(c: str, x: tuple[str, str, str, str], y: tuple[str, str, str, str]) -> str:
        (x1, x2, x3, x4), (y0, yy, xy, x2y) = [f"a_{v}" for v in x], [f"a_{v}" for v in y]
        a, b, d = f"{c}0", f"{c}1", f"{c}2"
        sse = f"{yy} - 2 * {a} * {y0} - 2 * {b} * {xy} - 2 * {d} * {x2y} + {a} * {a} * a_n + {b} * {b} * {x2} + {d} * {d} * {x4} + 2 * {a} * {b} * {x1} + 2 * {a} * {d} * {x2} + 2 * {b} * {d} * {x3}"
        return _r2(sse, f"({yy} - {y0} * {y0} / a_n)")

    shifted = curve("q", ("x", "x2", "x3", "x4"), ("y", "yy", "xy", "x2y"))
    raw = ("rx", "rxx", "rx3", "rx4"), ("ry", "ryy", "rxy", "rx2y")
    return {
        "linear": line("y"),
        "linear_no_intercept": origin("o_y", "rxy", "ryy", "ry"),
        "quadratic": f"CASE WHEN whole THEN {shifted} ELSE {curve('w', *raw)} END",
        "quadratic_no_intercept": f"CASE WHEN whole THEN {shifted} ELSE {curve('g', *raw)} END",
        "sqrt": f"CASE WHEN y_min < 0 THEN 0.0D ELSE {line('t')} END",
        "sqrt_no_intercept": f"CASE WHEN y_min < 0 THEN 0.0D ELSE {origin('o_s', 'rxs', 'rss', 'rs')} END",
    }


def relation(df: DataFrame, keys: Sequence[str], x: str, y: str, order: Sequence[str], threshold: float = 0.0, folds: bool = True) -> DataFrame:
    """``keys``, PAIRS (rows with both values) and WEIGHT (the best mean R2, 0 where it is not in 0..1 or below the threshold).

    Fewer than three pairs, or a constant variable, give 0.  Folds by size:
    3 pairs: fit on the first, score on the rest; 4-5: two; to 21: three;
    else five.  ``order`` fixes which rows a fold has.  Without ``folds`` the
    models are scored on what they were fitted to.
    """
    return relations(df, keys, {"x": x}, y, order, "_value", threshold, folds).drop("_value")


def _known(value: str) -> Column:
    return F.nanvl(F.col(f"`{value}`").cast("double"), F.lit(None))


def _parts(rows: DataFrame, keys: Sequence[str], values: Sequence[str]) -> DataFrame:
    """Per value ``i``, group and task of placed rows: where the group begins there (``_row``), how far its places are from those in the group (``_shift``), and size, means and extremes of the whole group's pairs."""
    each = {"_n": lambda x, y: F.count(x), "_mx": lambda x, y: F.avg(x), "_xx": lambda x, y: F.var_pop(x) * F.count(x), "_y": lambda x, y: F.sum(y), "_s": lambda x, y: F.sum(F.when(y >= 0, F.sqrt(y)).when(y.isNotNull(), 0.0)),
            "_x0": lambda x, y: F.min(x), "_x1": lambda x, y: F.max(x), "_y0": lambda x, y: F.min(y), "_y1": lambda x, y: F.max(y)}
    found = rows.groupBy(F.struct(F.lit(0), *keys).alias("_g"), "_part").agg(
        F.min("_at").alias("_row"), *[f(F.col(f"_x{i}"), F.when(F.col(f"_x{i}").isNotNull(), F.col("_y"))).alias(f"{n}_{i}") for i in range(len(values)) for n, f in each.items()], *[F.min(F.col("_at") - F.col(f"_gap{i}")).alias(f"_first_{i}") for i in range(len(values))],
    )
    apart = [F.struct(F.lit(i).alias("i"), *[F.col(f"{n}_{i}").alias(n) for n in (*each, "_first")]) for i in range(len(values))]
    parts = found.select("_g", "_part", "_row", F.inline(F.array(*apart))).filter("_n > 0").withColumn("_k", F.struct("_g", "i"))
    # From sums per group and task, so that no task takes a whole group.
    group = Window.partitionBy("_k")
    earlier = group.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.withColumns({"c": F.sum("_n").over(group), "_shift": F.coalesce(F.sum("_n").over(earlier), F.lit(0)) - F.col("_first")}).withColumn("mx", F.sum(F.col("_n") * F.col("_mx")).over(group) / F.col("c"))
    return parts.select(
        "_part", "i", "_row", "_shift", "c", "mx", F.sqrt(F.sum(F.col("_xx") + F.col("_n") * (F.col("_mx") - F.col("mx")) * (F.col("_mx") - F.col("mx"))).over(group) / F.col("c")).alias("dx"),
        (F.sum("_y").over(group) / F.col("c")).alias("my"), (F.sum("_s").over(group) / F.col("c")).alias("ms"), F.min("_y0").over(group).alias("y_min"),
        (F.max("_x1").over(group) > F.min("_x0").over(group)).alias("x_varies"), (F.max("_y1").over(group) > F.min("_y0").over(group)).alias("y_varies"),
    )


def _fold(i: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Fold of the pair at place ``i`` of ``c``."""
    k = np.where(c <= 5, 2, np.where(c <= 21, 3, 5))
    small, more = c // k, c % k
    cut = more * (small + 1)
    return np.where(c == 3, np.minimum(i, 1), np.where(i < cut, i // (small + 1), more + (i - cut) // np.maximum(small, 1)))


def _fold_sums(rows: DataFrame, parts: str, keys: Sequence[str], names: Sequence[str], name: str, folds: bool) -> DataFrame:
    """``SUMS`` per group, value, fold and task.  Rows lie in order of their groups, so a task reads what it must know of them by its own number and nothing is shuffled or joined."""
    keys = list(keys)
    kinds = ", ".join(f"`{k}` {rows.schema[k].dataType.simpleString()}" for k in keys)
    same = {"c": "bigint", "y_min": "double", "x_varies": "boolean", "y_varies": "boolean"}

    def sums(batch: pa.RecordBatch, known: pa.Table) -> Iterator[pa.RecordBatch]:
        at, y = batch.column("_at").to_numpy(), batch.column("_y").to_numpy()
        of = known.column("i").to_numpy()
        for i, value in enumerate(names):
            own = known.filter(pa.array(of == i)).sort_by("_row")
            x = batch.column(f"_x{i}").to_numpy(zero_copy_only=False)
            has = np.flatnonzero(~np.isnan(x))
            if not len(has):
                continue
            g = np.searchsorted(own.column("_row").to_numpy(), at[has], "right") - 1

            def per(c: str, own: pa.Table = own, g: np.ndarray = g) -> np.ndarray:
                return own.column(c).to_numpy()[g]

            place = per("_shift") + at[has] - batch.column(f"_gap{i}").to_numpy()[has]
            fold = _fold(place, per("c")) if folds else np.zeros(len(has), np.int64)
            v = {"X_": x[has], "Y_": y[has], "s": np.sqrt(np.maximum(y[has], 0.0)), "1.0D": np.ones(len(has))}
            dx = per("dx")
            v |= {"x": np.where(dx > 0, (v["X_"] - per("mx")) / np.where(dx > 0, dx, 1.0), 0.0), "y": v["Y_"] - per("my"), "t": v["s"] - per("ms")}
            starts = np.flatnonzero(np.r_[True, (np.diff(g) != 0) | (np.diff(fold) != 0)])
            first = pa.array(has[starts])
            found = [np.add.reduceat(reduce(np.multiply, [v[p] for p in e.split("*")]), starts) for e in SUMS.values()]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(k).take(first) for k in keys], pa.array([value] * len(starts)), pa.array(fold[starts], pa.int32()), *[pa.array(per(c)[starts]) for c in same], *map(pa.array, found)],
                names=[*keys, name, "fold", *same, *[f"a_{n}" for n in SUMS]],
            )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, folder = fs.FileSystem.from_uri(where)
        read: tuple[int, pa.Table] | None = None
        for batch in batches:
            task = batch.column("_part").to_numpy()
            for own in np.split(np.arange(len(task)), np.flatnonzero(np.diff(task)) + 1) if len(task) else ():
                part = int(task[own[0]])
                if read is None or read[0] != part:
                    read = part, dataset.dataset(f"{folder}/_part={part}", filesystem=store, format="parquet").to_table()
                yield from sums(batch.slice(int(own[0]), len(own)), read[1])

    where = qualified(rows.sparkSession, parts)
    return rows.mapInArrow(run, f"{kinds}, `{name}` string, fold int, " + ", ".join(f"{c} {t}" for c, t in same.items()) + ", " + ", ".join(f"a_{n} double" for n in SUMS))


def relations(df: DataFrame, keys: Sequence[str], xs: Mapping[str, str], y: str, order: Sequence[str], name: str, threshold: float = 0.0, folds: bool = True) -> DataFrame:
    """``relation`` of each column of ``xs`` (name: column) with ``y``, side by side in one pass: a row per group and value, named in the column ``name``."""
    keys, names = [*keys, name], list(xs)
    own = keys[:-1]
    whole = Window.partitionBy(*keys)
    pairs = df.select(*own, *[c for c in order if c not in own], *[_known(x).alias(f"_x{i}") for i, x in enumerate(xs.values())], _known(y).alias("_y"))
    pairs = pairs.filter(F.col("_y").isNotNull() & F.coalesce(*[F.col(f"_x{i}") for i in range(len(xs))]).isNotNull())
    # Written first: dealing by ranges looks at its rows before it moves them, and would make the facts twice.
    path = scratch_path(df.sparkSession, "pairs")
    pairs.write.parquet(path)
    rows = numbering.placed_values(df.sparkSession.read.schema(pairs.schema).parquet(path), [*own, *order], [f"_x{i}" for i in range(len(xs))], [*own, "_y"])
    deleted(df.sparkSession, path)
    path = scratch_path(df.sparkSession, "parts")
    _parts(rows, own, names).write.partitionBy("_part").parquet(path)
    rows = _fold_sums(rows, path, own, names, name, folds)
    same = [F.first(c).alias(c) for c in ("c", "y_min", "x_varies", "y_varies")]
    parts = rows.groupBy(*keys, "fold").agg(*same, *[F.sum(f"a_{n}").alias(f"a_{n}") for n in SUMS])
    # Fit on all other folds; on the scored one itself without folds; for three pairs on the first alone.
    rest = {f"b_{n}": (F.sum(f"a_{n}").over(whole) - (F.col(f"a_{n}") if folds else F.lit(0.0))) for n in SUMS}
    parts = parts.withColumns(rest).withColumn("a_scale", F.col("a_ryy") + F.lit(1e-300)).filter((F.col("c") != 3) | (F.col("fold") == (1 if folds else 0)))
    for step in STEPS:
        parts = parts.withColumns({c: F.expr(e) for c, e in step.items()})
    fold_scores = parts.select(*keys, "c", "x_varies", "y_varies", *[F.expr(e).alias(m) for m, e in model_sql().items()])
    means = fold_scores.groupBy(*keys).agg(F.first("c").alias("PAIRS"), F.first("x_varies").alias("xv"), F.first("y_varies").alias("yv"), *[F.avg(m).alias(m) for m in model_sql()])
    best = F.greatest(*[F.col(m) for m in model_sql()], F.lit(0.0))
    weight = F.when((F.col("PAIRS") >= 3) & F.col("xv") & F.col("yv") & (best <= 1) & (best >= threshold), best).otherwise(0.0)
    return means.select(*keys, F.col("PAIRS"), weight.alias("WEIGHT"))


def _plain_moments(df: DataFrame, keys: Sequence[str], x: str, y: str) -> DataFrame:
    """Variances and covariances per group of u (x, standardised), v (u squared), y and z (y squared); ``line``, ``curve`` and ``square`` are the R2 of y by u, of y by u and v, and of z by u, null for a constant."""
    key = F.struct(*keys).alias("_k")  # a struct, so that null keys meet too
    pairs = df.select(key, F.col(x).cast("double").alias("X_"), F.col(y).cast("double").alias("Y_"))
    pairs = pairs.filter("X_ is not null and Y_ is not null and not isnan(X_) and not isnan(Y_)")
    centre = pairs.groupBy("_k").agg(F.avg("X_").alias("mx"), F.stddev_pop("X_").alias("dx"))
    rows = pairs.join(centre, "_k").withColumn("u", F.coalesce(F.try_divide(F.col("X_") - F.col("mx"), F.col("dx")), F.lit(0.0)))
    rows = rows.withColumns({"v": F.col("u") * F.col("u"), "z": F.col("Y_") * F.col("Y_")})
    got = rows.groupBy("_k").agg(
        F.count("*").alias("PAIRS"), F.sum(F.abs("X_")).alias("ax"), F.sum(F.abs("Y_")).alias("ay"), *[F.var_pop(c).alias(n) for c, n in (("u", "uu"), ("v", "vv"), ("Y_", "yy"), ("z", "zz"))],
        *[F.covar_pop(a, b).alias(n) for a, b, n in (("u", "v", "uv"), ("u", "Y_", "uy"), ("v", "Y_", "vy"), ("u", "z", "uz"))],
    )
    c, det = F.col, F.col("uu") * F.col("vv") - F.col("uv") * F.col("uv")
    line = F.try_divide(c("uy") * c("uy"), c("uu") * c("yy"))
    both = F.try_divide(c("uy") * c("uy") * c("vv") - 2 * c("uy") * c("vy") * c("uv") + c("vy") * c("vy") * c("uu"), det * c("yy"))
    # Two distinct values of x leave a quadratic open; the line goes through the same means.
    curve = F.when(det > 1e-9 * c("uu") * c("vv"), both).otherwise(line)
    square = F.try_divide(c("uz") * c("uz"), c("uu") * c("zz"))
    return got.select("_k.*", "PAIRS", "ax", "ay", "uu", "yy", "uy", "uz", line.alias("line"), curve.alias("curve"), square.alias("square"))


def relation_plain(df: DataFrame, keys: Sequence[str], x: str, y: str, threshold: float = 0.0) -> DataFrame:
    """Earlier form without folds: the best R2 of the line, the quadratic and the line through squared y.

    A variable of zeros, a constant, fewer than two pairs or a best R2 below
    the threshold give 0.
    """
    got = _plain_moments(df, keys, x, y)
    best = F.least(F.greatest(*[F.coalesce(c, F.lit(0.0)) for c in ("line", "curve", "square")], F.lit(0.0)), F.lit(1.0))
    fine = (F.col("PAIRS") > 1) & (F.col("ax") > 0) & (F.col("ay") > 0) & (best >= threshold)
    return got.select(*keys, "PAIRS", F.when(fine, best).otherwise(0.0).alias("WEIGHT"))


def fitted_correlations(df: DataFrame, keys: Sequence[str], x: str, y: str) -> DataFrame:
    """The correlation of y with what each model fits: LINEAR, QUADRATIC and SQRT (the line through squared y); null for constants."""
    got = _plain_moments(df, keys, x, y)
    r = F.try_divide(F.col("uy"), F.sqrt(F.col("uu") * F.col("yy")))
    up = F.when(F.col("uz") != 0, F.signum("uz"))
    return got.select(*keys, "PAIRS", F.abs(r).alias("LINEAR"), F.sqrt(F.greatest("curve", F.lit(0.0))).alias("QUADRATIC"), (up * r).alias("SQRT"))
