"""Scores that need more than one parameter at a time, or estimators of their own.

Principal components come from sums of products, so only parameter by
parameter matrices meet in one task.  Trees, linear machines and k-means are
those of pyspark.ml.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type


def filled_matrix(rows: DataFrame, keys: Sequence[str], missing: float | None = None) -> DataFrame:
    """Long means per UNIT and FEATURE without constant features: ``keys, UNIT, FEATURE, X, MEAN``; gaps stay out, since a mean fill adds nothing to centred products.  Features that more than ``missing`` of a group's units lack go."""
    means = rows.na.drop(subset=[*keys, "UNIT", "FEATURE", "RESULT"]).groupBy(*keys, "UNIT", "FEATURE").agg(F.avg("RESULT").alias("X"))
    # A row per feature of a group; a window would sort all units of a feature in one task.
    stats = means.groupBy(*keys, "FEATURE").agg(F.avg("X").alias("MEAN"), F.min("X").alias("_lo"), F.max("X").alias("_hi"), F.count("*").alias("_n"))
    if missing is not None:
        units = means.groupBy(*keys).agg(F.count_distinct("UNIT").alias("_units"))
        stats = stats.join(units, list(keys)).filter(1 - F.col("_n") / F.col("_units") <= missing)
    stats = stats.filter("_lo < _hi").select(*keys, "FEATURE", "MEAN")
    return means.join(F.broadcast(stats), [*keys, "FEATURE"]).select(*keys, "UNIT", "FEATURE", "X", "MEAN")


def pca_features(rows: DataFrame, keys: Sequence[str], most: int = 20, normalise: bool = True, doubled: bool = False, variance: float | None = None, missing: float | None = None) -> DataFrame:
    """Per component of each group the feature of largest loading: ``keys, FEATURE, IMPORTANCE`` (|loading|, or its share).

    min(units, features) - 2 components, ``most`` at most; groups with 2 or
    less of either give nothing (``doubled`` counts units twice).  With
    ``variance`` the fewest components that reach this share are taken, with
    ``missing`` features that more than this share of the units lack go first.
    """
    keys = list(keys)
    cells = filled_matrix(rows, keys, missing)
    centred = cells.select(*keys, "UNIT", "FEATURE", (F.col("X") - F.col("MEAN")).alias("C"))
    # A unit's features meet in one array; products of pairs are summed per group, partially before the shuffle.
    units = centred.groupBy(*keys, "UNIT").agg(F.array_sort(F.collect_list(F.struct("FEATURE", "C"))).alias("v"))
    # A pair without names counts the units in the same pass.
    products = F.expr("flatten(transform(v, a -> transform(filter(v, b -> a.FEATURE <= b.FEATURE), b -> struct(a.FEATURE as _f, b.FEATURE as _g, a.C * b.C as _p))))")
    one = F.array(F.struct(F.lit(None).cast("string").alias("_f"), F.lit(None).cast("string").alias("_g"), F.lit(1.0).alias("_p")))
    pairs = units.select(*keys, F.explode(F.concat(products, one)).alias("x"))
    gram = pairs.groupBy(*keys, F.col("x._f").alias("_f"), F.col("x._g").alias("_g")).agg(F.sum("x._p").alias("_p"))
    fields = [rows.schema[k] for k in keys]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields) + ", FEATURE string, IMPORTANCE double"

    def components(group: pd.DataFrame) -> pd.DataFrame:
        counted = group["_f"].isna()
        n, group = int(group.loc[counted, "_p"].iloc[0]), group[~counted]
        names = sorted({*group["_f"], *group["_g"]})
        at = {n: i for i, n in enumerate(names)}
        m = np.zeros((len(names), len(names)))
        i, j = group["_f"].map(at).to_numpy(), group["_g"].map(at).to_numpy()
        m[i, j] = m[j, i] = group["_p"]
        out = _loadings(m, names, n, most, normalise, doubled, variance)
        for k in keys:
            out[k] = group[k].iloc[0] if len(group) else None
        return out[[*keys, "FEATURE", "IMPORTANCE"]]

    return gram.groupBy(*keys).applyInPandas(components, schema)


def _loadings(m: np.ndarray, names: Sequence[str], n: int, most: int, normalise: bool, doubled: bool, variance: float | None) -> pd.DataFrame:
    """FEATURE and IMPORTANCE of a group of ``n`` units from its features' centred products."""
    count = min(min(n * (2 if doubled else 1), len(names)) - 2, most)
    found = []
    if count > 0:
        values, vectors = np.linalg.eigh(m)
        if variance is not None:
            shares = np.cumsum(values[::-1]) / max(values.sum(), 1e-300)
            count = min(count, int(np.searchsorted(shares, variance)) + 1)
        for c in range(count):
            loading = np.abs(vectors[:, -1 - c])
            best = int(np.argmax(np.round(loading, 12)))
            found.append((names[best], float(loading[best])))
    found = list(dict.fromkeys(found))
    total = sum(x for _, x in found) if normalise else 1.0
    return pd.DataFrame({"FEATURE": [f for f, _ in found], "IMPORTANCE": [x / total for _, x in found]})


#: Groups whose sums a task holds before it hands them on.
HELD_GROUPS = 512


class _Products:
    """Sums of a group's rows around a shift, its first rows' mean: of pairs of features the products (p), the first's values where both are (a) and how often both are (n); and how many rows have which features."""

    def __init__(self, x: np.ndarray) -> None:
        known = ~np.isnan(x)
        self.shift = np.where(known, x, 0.0).sum(0) / np.maximum(known.sum(0), 1)
        self.p, self.a, self.n = (np.zeros((x.shape[1], x.shape[1])) for _ in range(3))
        self.low, self.high = np.full(x.shape[1], np.inf), np.full(x.shape[1], -np.inf)
        self.having: dict[bytes, int] = {}
        self.add(x)

    def add(self, x: np.ndarray) -> None:
        known = ~np.isnan(x)
        z, one = np.where(known, x - self.shift, 0.0), known.astype(float)
        self.p += z.T @ z
        self.a += z.T @ one
        self.n += one.T @ one
        self.low, self.high = np.minimum(self.low, np.where(known, x, np.inf).min(0)), np.maximum(self.high, np.where(known, x, -np.inf).max(0))
        rows, counts = np.unique(np.packbits(known, axis=1), axis=0, return_counts=True)
        for r, c in zip(rows, counts.tolist(), strict=True):
            self.having[r.tobytes()] = self.having.get(r.tobytes(), 0) + c


def pca_wide(means: DataFrame, keys: Sequence[str], features: Sequence[str], most: int = 20, normalise: bool = True, doubled: bool = False, variance: float | None = None, missing: float | None = None) -> DataFrame:
    """``pca_features`` of unit means with ``features`` side by side, a row per group and unit.

    A task multiplies its rows of a group as matrices and hands on one row of
    sums per group; these sums, around each task's own shift, are put together
    around the group's means.
    """
    keys, names = list(keys), sorted(features)
    rows = means.na.drop(subset=keys).select(*keys, *[F.col(f"`{f}`").cast("double").alias(f) for f in names])
    kinds = ", ".join(f"`{k}` {rows.schema[k].dataType.simpleString()}" for k in keys)
    own_kinds = [to_arrow_type(rows.schema[k].dataType) for k in keys]
    parts = ("shift", "p", "a", "n", "low", "high")

    def handed(held: dict[tuple, _Products]) -> pa.RecordBatch:
        columns = [pa.array([g[i] for g in held], k) for i, k in enumerate(own_kinds)]
        sums = [pa.array([getattr(s, c).ravel() for s in held.values()], pa.list_(pa.float64())) for c in parts]
        having = [pa.array([list(s.having) for s in held.values()], pa.list_(pa.binary())), pa.array([list(s.having.values()) for s in held.values()], pa.list_(pa.int64()))]
        return pa.RecordBatch.from_arrays([*columns, *sums, *having], names=[*keys, *parts, "having", "units"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, _Products] = {}
        for batch in batches:
            x = np.stack([c.to_numpy(zero_copy_only=False) for c in batch.columns[len(keys) :]], 1).astype(float)
            code = np.zeros(batch.num_rows, np.int64)
            for c in batch.columns[: len(keys)]:
                at = c.dictionary_encode()
                code = np.unique(code * len(at.dictionary) + at.indices.to_numpy(), return_inverse=True)[1]
            order = np.argsort(code, kind="stable")
            starts = np.flatnonzero(np.diff(code[order], prepend=-1))
            for part in np.split(order, starts[1:]) if len(order) else ():
                group, values = tuple(c[int(part[0])].as_py() for c in batch.columns[: len(keys)]), x[part]
                values = values[~np.isnan(values).all(1)]
                if not len(values):
                    continue
                if group in held:
                    held[group].add(values)
                else:
                    held[group] = _Products(values)
                if len(held) >= HELD_GROUPS:
                    yield handed(held)
                    held = {}
        if held:
            yield handed(held)

    def components(group: pd.DataFrame) -> pd.DataFrame:
        shift, low, high = (np.stack(group[c].to_numpy()) for c in ("shift", "low", "high"))
        p, a, n = (np.stack(group[c].to_numpy()).reshape(len(group), len(names), len(names)) for c in ("p", "a", "n"))
        many = n.sum(0).diagonal()
        # How far each task's shift is from the group's mean: the means first around one of the shifts, so that large values keep their digits.
        off = np.where(n.diagonal(axis1=1, axis2=2) > 0, shift - shift[0], 0.0)
        delta = off - ((off * n.diagonal(axis1=1, axis2=2) + a.diagonal(axis1=1, axis2=2)).sum(0) / np.maximum(many, 1))
        m = (p + delta[:, None, :] * a + (delta[:, None, :] * a).transpose(0, 2, 1) + delta[:, :, None] * delta[:, None, :] * n).sum(0)
        bits = [np.unpackbits(np.frombuffer(b, np.uint8), count=len(names)).astype(bool) for own in group["having"] for b in own]
        having, units = np.stack(bits), np.concatenate(group["units"].to_numpy())
        kept = low.min(0) < high.max(0)
        if missing is not None:
            kept &= 1 - many / units.sum() <= missing
        out = _loadings(m[np.ix_(kept, kept)], [x for x, k in zip(names, kept, strict=True) if k], int(units[(having & kept).any(1)].sum()), most, normalise, doubled, variance)
        for k in keys:
            out[k] = group[k].iloc[0]
        return out[[*keys, "FEATURE", "IMPORTANCE"]]

    sums = rows.mapInArrow(run, f"{kinds}, " + ", ".join(f"{c} array<double>" for c in parts) + ", having array<binary>, units array<bigint>")
    return sums.groupBy(*keys).applyInPandas(components, f"{kinds}, FEATURE string, IMPORTANCE double")


def feature_table(rows: DataFrame, features: Sequence[str]) -> DataFrame:
    """Wide: a row per UNIT and label with a column per feature, gaps filled by the class mean, as a vector."""
    from pyspark.ml.feature import VectorAssembler

    wide = rows.groupBy("UNIT", "label").pivot("FEATURE", list(features)).agg(F.avg("RESULT"))
    # A row per class; a window would sort a class in one task.
    means = wide.groupBy("label").agg(*[F.avg(f"`{f}`").alias(f"_m{i}") for i, f in enumerate(features)]).withColumnRenamed("label", "_label")
    known = wide.join(F.broadcast(means), F.col("label").eqNullSafe(F.col("_label")))
    filled = known.select("UNIT", F.col("label").cast("double").alias("label"), *[F.coalesce(F.col(f"`{f}`"), F.col(f"_m{i}"), F.lit(0.0)).alias(f"f{i}") for i, f in enumerate(features)])
    return VectorAssembler(inputCols=[f"f{i}" for i in range(len(features))], outputCol="features").transform(filled)


def unit_features(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Means per group, UNIT, label and FEATURE, written: every group's fit reads them, none the facts."""
    from ..sources.tables import written

    return written(rows.groupBy(*keys, "UNIT", "label", "FEATURE").agg(F.avg("RESULT").alias("RESULT")), "unit_features")


def estimators(seed: int = 1024) -> dict:
    """Classifier and parameter grid by name."""
    from pyspark.ml.classification import DecisionTreeClassifier, LinearSVC, LogisticRegression, RandomForestClassifier
    from pyspark.ml.tuning import ParamGridBuilder

    rf, tree = RandomForestClassifier(seed=seed), DecisionTreeClassifier(seed=seed)
    svc, logit = LinearSVC(fitIntercept=False, maxIter=20), LogisticRegression(fitIntercept=False)
    return {
        "rf": (rf, ParamGridBuilder().addGrid(rf.numTrees, [10, 30]).addGrid(rf.maxDepth, [3, 5]).build()),
        "decisionTree": (tree, ParamGridBuilder().addGrid(tree.maxDepth, [2, 4, 6]).build()),
        "svc": (svc, ParamGridBuilder().addGrid(svc.regParam, [0.01, 0.1]).build()),
        "logistic": (logit, ParamGridBuilder().addGrid(logit.elasticNetParam, [0.0, 1.0]).addGrid(logit.regParam, [0.01, 0.1]).build()),
    }


def group_importances(rows: DataFrame, keys: Sequence[str], groups: Sequence[Row], model: str = "rf", folds: int = 3, seed: int = 1024) -> DataFrame:
    """Importances and cross-validated AUC of each named group: a distributed fit per group, for the few groups under study."""
    from pyspark.ml.evaluation import BinaryClassificationEvaluator
    from pyspark.ml.tuning import CrossValidator

    spark = rows.sparkSession
    estimator, grid = estimators(seed)[model]
    out: list[tuple] = []
    for g in groups:
        own = rows
        for k in keys:
            own = own.filter(F.col(k).eqNullSafe(F.lit(g[k])))
        features = [r["FEATURE"] for r in own.select("FEATURE").distinct().sort("FEATURE").collect()]
        # In order, so that folds do not depend on how rows arrived.
        table = feature_table(own, features).orderBy("UNIT", "label").cache()
        if table.select("label").distinct().count() == 2 and len(features) > 1:
            fitted = CrossValidator(estimator=estimator, estimatorParamMaps=grid, evaluator=BinaryClassificationEvaluator(), numFolds=folds, seed=seed, parallelism=4).fit(table)
            best = fitted.bestModel
            values = best.featureImportances.toArray() if hasattr(best, "featureImportances") else np.abs(best.coefficients.toArray())
            out += [(*[g[k] for k in keys], f, float(v), float(max(fitted.avgMetrics))) for f, v in zip(features, values, strict=True)]
        else:
            out += [(*[g[k] for k in keys], f, 0.0, 0.0) for f in features]
        table.unpersist()
    kinds = ", ".join(f"`{k}` {rows.schema[k].dataType.simpleString()}" for k in keys)
    return spark.createDataFrame(out, f"{kinds}, FEATURE string, IMPORTANCE double, AUC double")


def digamma(n: Column) -> Column:
    """Of whole numbers from 1: ten steps of the recurrence, then the asymptotic series (to about 1e-11)."""
    z = n + 10.0
    series = F.log(z) - 1 / (2 * z) - 1 / (12 * z * z) + 1 / (120 * z * z * z * z) - 1 / (252 * z * z * z * z * z * z)
    return reduce(lambda found, i: found - 1 / (n + float(i)), range(10), series)


def mutual_information(rows: DataFrame, keys: Sequence[str], neighbours: int = 3) -> DataFrame:
    """Nearest-neighbour estimate between a parameter and the class, per group and parameter: ``keys, PARAMETRIC_NAME, MI``.

    psi(n) + <psi(k)> - <psi(n_class)> - <psi(m)>, m the units of any class
    strictly within each unit's distance to its k-th neighbour of its own
    class.  Neighbours on a line stand beside each other in sorted order, and
    m is the difference of two running counts, so a group's parameter is
    sorted (and may spill) but never held.  Classes of one unit are left out.
    """
    from .scores import feature_means

    group = [*keys, "PARAMETRIC_NAME"]
    own = Window.partitionBy(*group, "label")
    around = own.orderBy("X").rowsBetween(-neighbours, neighbours)
    near = feature_means(rows, list(keys)).withColumn("_n", F.count("*").over(own).cast("double")).withColumn("_v", F.collect_list("X").over(around))
    near = near.withColumn("_k", F.least(F.lit(float(neighbours)), F.col("_n") - 1))
    apart = F.array_sort(F.transform("_v", lambda v: F.abs(v - F.col("X"))))
    near = near.withColumn("_r", F.get(apart, F.col("_k").cast("int")) * (1 - 1e-10))

    def event(at: Column, kind: int) -> Column:
        return F.struct(at.alias("at"), F.lit(kind).alias("kind"))

    # At equal places lower ends come before units, upper ends after them; units of a class of one are not counted.
    x, r = F.col("X"), F.col("_r")
    events = F.when(F.col("_n") > 1, F.array(event(x - r, 0), event(x, 1), event(x + r, 2))).otherwise(F.array(event(x, 3)))
    spread = near.select(*group, "WAFER_ID", "label", "_n", "_k", F.explode(events).alias("e")).select("*", "e.*").drop("e")
    running = Window.partitionBy(*group).orderBy("at", "kind").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    counted = spread.withColumn("_c", F.count(F.when(F.col("kind") == 1, 1)).over(running)).filter("kind <> 1")
    units = counted.groupBy(*group, "WAFER_ID", "label", "_n", "_k").agg((F.max(F.when(F.col("kind") == 2, F.col("_c"))) - F.max(F.when(F.col("kind") == 0, F.col("_c")))).cast("double").alias("_m"))
    of = F.col("_m").isNotNull()
    sums = units.groupBy(*group).agg(F.count("_m").cast("double").alias("_all"), F.avg(F.when(of, digamma(F.col("_k")) - digamma(F.col("_n")) - digamma(F.greatest("_m", F.lit(1.0))))).alias("_mean"))
    return sums.select(*group, F.when(F.col("_all") > 0, F.greatest(F.lit(0.0), digamma(F.col("_all")) + F.col("_mean"))).otherwise(0.0).alias("MI"))


def two_sample_tests(rows: DataFrame, keys: Sequence[str], value: str, by_mean: bool = False) -> DataFrame:
    """The test ladder per group: ``keys, TEST, STATISTIC, IMPORTANCE`` (1 - p); groups without both classes have no row.

    Samples below three are filled with zeros, or with their mean.  Order
    statistics, ranks and moments are windows and sums of a group in sorted
    order; only one row of sums per group goes to the tests.
    """
    from ..functions import hypothesis_tests as ht

    keys = list(keys)
    known = rows.filter(F.col(value).isNotNull() & ~F.isnan(F.col(value).cast("double")) & F.col("label").isin(0, 1)).select(*keys, F.col("label").cast("int").alias("label"), F.col(value).cast("double").alias("_v"))
    sizes = known.groupBy(*keys).agg(*[F.count(F.when(F.col("label") == c, 1)).alias(f"_n{c}") for c in (0, 1)], *[F.avg(F.when(F.col("label") == c, F.col("_v"))).alias(f"_mean{c}") for c in (0, 1)])
    each = F.explode(F.array(*[F.struct(F.lit(c).alias("label"), F.col(f"_n{c}").alias("n"), (F.col(f"_mean{c}") if by_mean else F.lit(0.0)).alias("_v")) for c in (0, 1)]))
    short = sizes.filter("_n0 > 0 and _n1 > 0").select(*keys, each.alias("s")).filter("s.n < 3")
    fill = short.select(*keys, "s.label", "s._v", F.explode(F.sequence(F.col("s.n") + 1, F.lit(3).cast("long"))).alias("_i")).drop("_i")

    whole = Window.partitionBy(*keys)
    order = whole.orderBy("_v", "label")
    rank = whole.orderBy("_v")
    mine = F.col("label") == 1
    cells = known.unionByName(fill).withColumns({f"_n{c}": F.count(F.when(F.col("label") == c, 1)).over(whole) for c in (0, 1)}).filter("_n0 > 0 and _n1 > 0")
    cells = cells.withColumns({
        "_x": F.col("_v") - F.avg("_v").over(whole), "_n": F.when(mine, F.col("_n1")).otherwise(F.col("_n0")),
        "_ties": F.count("*").over(rank.rangeBetween(Window.currentRow, Window.currentRow)), "_rank": F.rank().over(rank),
        "_i": F.count(F.when(mine, 1)).over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)), "_j": F.row_number().over(order),
    }).withColumn("_i", F.when(mine, F.col("_i")).otherwise(F.col("_j") - F.col("_i")))
    middle = (F.col("_i") == F.floor((F.col("_n") + 1) / 2)) | (F.col("_i") == F.floor(F.col("_n") / 2) + 1)
    cells = cells.withColumns({f"_median{c}": F.avg(F.when(middle & (F.col("label") == c), F.col("_x"))).over(whole) for c in (0, 1)})
    cells = cells.withColumn("_normal", ht.normal_order(F.col("_i"), F.col("_n"))).withColumn("_off", F.abs(F.col("_x") - F.when(mine, F.col("_median1")).otherwise(F.col("_median0"))))

    def sums(c: int) -> list[Column]:
        def of(v: str | Column, where: Column | bool = True) -> Column:
            return F.when((F.col("label") == c) & where, F.col(v) if isinstance(v, str) else v)

        i, n = F.col("_i"), F.col("_n")
        return [x.alias(f"{name}{c}") for name, x in {
            "n": F.count(of("_x")), "mean": F.avg(of("_x")), "var": F.var_samp(of("_x")), "first": F.max(of("_x", i == 1)), "second": F.max(of("_x", i == 2)), "previous": F.max(of("_x", i == n - 1)), "last": F.max(of("_x", i == n)),
            "squares": F.sum(of(F.col("_normal") * F.col("_normal"))), "products": F.sum(of(F.col("_normal") * F.col("_x"))), "off": F.avg(of("_off")), "off_var": F.var_samp(of("_off")),
            "ranks": F.sum(of(F.col("_rank") + (F.col("_ties") - 1) / 2)), "ties": F.sum(of(F.col("_ties") * F.col("_ties") - 1)),
        }.items()]

    found = cells.groupBy(*keys).agg(*sums(0), *sums(1))
    columns = [c for c in found.columns if c not in keys]
    tested = found.select(*keys, ht.ladder(F.struct(*columns)).alias("t"))
    return tested.select(*keys, F.col("t.test").alias("TEST"), F.col("t.statistic").alias("STATISTIC"), (1 - F.col("t.p")).alias("IMPORTANCE"))
