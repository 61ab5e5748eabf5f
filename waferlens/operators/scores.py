"""Univariate scores of parameters, without a matrix.

Groups are never gathered: class counts, means and squared deviations are
plain aggregates, and filling gaps by the class mean changes only class sizes.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def feature_means(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Mean per unit, class, group and parameter over rows without a null."""
    used = ["WAFER_ID", "label", *keys, "PARAMETRIC_NAME"]
    return df.na.drop(subset=[*used, "RESULT"]).groupBy(*used).agg(F.avg("RESULT").alias("X"))


def wide_means(df: DataFrame, keys: Sequence[str], features: Sequence[str]) -> DataFrame:
    """``feature_means`` of features side by side: a row per unit, class and group that has any; NaN counts as none."""
    used = ["WAFER_ID", "label", *keys]
    known = df.na.drop(subset=used).select(*used, *[F.nanvl(F.col(f"`{f}`").cast("double"), F.lit(None)).alias(f) for f in features])
    return known.groupBy(*used).agg(*[F.avg(f"`{f}`").alias(f) for f in features]).filter(F.coalesce(*[F.col(f"`{f}`") for f in features]).isNotNull())


def _class_sizes(means: DataFrame, keys: Sequence[str]) -> DataFrame:
    units = means.select(*keys, "WAFER_ID", "label").distinct()
    return units.groupBy(*keys).agg(F.count(F.when(F.col("label") == 0, 1)).cast("double").alias("N0"), F.count(F.when(F.col("label") == 1, 1)).cast("double").alias("N1"))


def anova(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """F of each parameter between the classes and its share of the group's sum.

    A parameter with one value, or none in a class that the group has, is
    left out.  Shares need both classes and two parameters; otherwise, and
    where F is infinite, IMPORTANCE is 0.  Also the group's N0 and N1.
    """
    means = feature_means(df, keys)
    x = F.col("X")
    per = means.groupBy(*keys, "PARAMETRIC_NAME", "label").agg(F.count(x).alias("n"), F.avg(x).alias("m"), F.coalesce(F.var_samp(x) * (F.count(x) - 1), F.lit(0.0)).alias("s"), F.min(x).alias("lo"), F.max(x).alias("hi"))

    def of(c: str, label: int):
        return F.max(F.when(F.col("label") == label, F.col(c)))

    wide = per.groupBy(*keys, "PARAMETRIC_NAME").agg(of("m", 0).alias("M0"), of("m", 1).alias("M1"), F.sum("s").alias("SSW"), F.min("lo").alias("lo"), F.max("hi").alias("hi"))
    rows = _f_shares(wide.join(_class_sizes(means, keys), list(keys)), keys)
    return rows.select(*keys, "PARAMETRIC_NAME", "N0", "N1", "F", "IMPORTANCE", "SATISFIED")


def _f_shares(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """F and its share of the group's sum from class sizes N0, N1, class means M0, M1, squared deviations SSW and the least and greatest value."""
    rows = rows.filter((F.col("lo") < F.col("hi")) & (F.col("M0").isNotNull() | (F.col("N0") == 0)) & (F.col("M1").isNotNull() | (F.col("N1") == 0)))
    n = F.col("N0") + F.col("N1")
    grand = (F.col("N0") * F.col("M0") + F.col("N1") * F.col("M1")) / n
    between = F.col("N0") * F.pow(F.col("M0") - grand, 2) + F.col("N1") * F.pow(F.col("M1") - grand, 2)
    rows = rows.withColumn("F", F.when((F.col("SSW") > 0) & (n > 2), between / (F.col("SSW") / (n - 2))))
    whole = Window.partitionBy(*keys)
    fine = (F.count("*").over(whole) > 1) & (F.col("N0") > 0) & (F.col("N1") > 0)
    share = F.try_divide(F.col("F"), F.sum("F").over(whole))
    return rows.withColumn("SATISFIED", fine).withColumn("IMPORTANCE", F.when(fine, F.coalesce(share, F.lit(0.0))).otherwise(F.lit(0.0)))


def anova_moments(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``anova`` from class sizes N0, N1 and the columns of ``moments_apart``."""
    return _f_shares(rows, keys)


def stat_means(df: DataFrame, keys: Sequence[str], stats: Sequence[str]) -> DataFrame:
    """Means of several statistics side by side, a row per unit, class, group and parameter that has any."""
    used = ["WAFER_ID", "label", *keys, "PARAMETRIC_NAME"]
    some = df.na.drop(subset=used).na.drop("all", subset=list(stats))
    return some.groupBy(*used).agg(*[F.avg(s).alias(s) for s in stats])


def stat_moments(means: DataFrame, keys: Sequence[str], stats: Sequence[str]) -> DataFrame:
    """Per group, parameter and statistic: units of each class (GOOD_NUM, BAD_NUM), class means M0, M1, squared deviations SSW, least and greatest value.

    All statistics of a parameter are aggregated in one pass over ``means``;
    only the result, a row per parameter, becomes one per statistic.
    """
    ids = [*keys, "PARAMETRIC_NAME"]
    return moments_apart(means.groupBy(*ids).agg(*moment_parts(stats)), ids, stats)


def moment_parts(stats: Sequence[str]) -> list[Column]:
    """Aggregates of unit means with a label, side by side, for ``moments_apart``."""
    def parts(s: str) -> list:
        own = [F.when(F.col("label") == c, F.col(s)) for c in (0, 1)]
        return [x for c, v in enumerate(own) for x in (F.count(v).alias(f"{s}_n{c}"), F.avg(v).alias(f"{s}_m{c}"), F.var_samp(v).alias(f"{s}_v{c}"))] + [F.min(s).alias(f"{s}_lo"), F.max(s).alias(f"{s}_hi")]

    return [x for s in stats for x in parts(s)]


def moments_apart(per: DataFrame, ids: Sequence[str], stats: Sequence[str]) -> DataFrame:
    """A row per statistic from ``moment_parts``."""
    def packed(s: str):
        squares = [F.coalesce(F.col(f"{s}_v{c}") * (F.col(f"{s}_n{c}") - 1), F.lit(0.0)) for c in (0, 1)]
        return F.struct(
            F.lit(s).alias("STATS"), F.col(f"{s}_n0").alias("GOOD_NUM"), F.col(f"{s}_n1").alias("BAD_NUM"), F.col(f"{s}_m0").alias("M0"), F.col(f"{s}_m1").alias("M1"),
            (squares[0] + squares[1]).alias("SSW"), F.col(f"{s}_lo").cast("double").alias("lo"), F.col(f"{s}_hi").cast("double").alias("hi"),
        )

    return per.select(*ids, F.inline(F.array(*map(packed, stats)))).filter("GOOD_NUM + BAD_NUM > 0")


def moments_named(per: DataFrame, keys: Sequence[str], parameters: Mapping[str, str]) -> DataFrame:
    """``moments_apart`` of parameters side by side: a row per parameter, by its name."""
    names = F.create_map(*[F.lit(x) for n, c in parameters.items() for x in (c, n)])
    rows = moments_apart(per, keys, list(parameters.values()))
    return rows.withColumn("PARAMETRIC_NAME", F.element_at(names, F.col("STATS"))).drop("STATS")


def anova_stats(moments: DataFrame, sizes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``anova`` of every statistic of every parameter from ``stat_moments``; ``sizes``: GOOD_NUM and BAD_NUM per group."""
    sizes = sizes.select(*keys, F.col("GOOD_NUM").cast("double").alias("N0"), F.col("BAD_NUM").cast("double").alias("N1"))
    rows = _f_shares(moments.drop("GOOD_NUM", "BAD_NUM").join(sizes, list(keys)), keys)
    return rows.select(*keys, "PARAMETRIC_NAME", "STATS", "N0", "N1", "F", "IMPORTANCE", "SATISFIED")


def chi2(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Chi-square of each parameter, scaled to 0..1 over the group after gaps are filled by the class mean."""
    means = feature_means(df, keys)
    per = means.groupBy(*keys, "PARAMETRIC_NAME").agg(
        F.min("X").alias("lo"), F.max("X").alias("hi"), *[F.avg(F.when(F.col("label") == c, F.col("X"))).alias(f"M{c}") for c in (0, 1)]
    )
    return chi2_moments(per.join(_class_sizes(means, keys), list(keys)), keys)


def chi2_moments(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``chi2`` from class sizes N0, N1, class means M0, M1 and the least and greatest value."""
    rows = rows.filter("lo < hi and M0 is not null and M1 is not null and N0 > 0 and N1 > 0")
    # Filling by the class mean keeps class means, so a class's sum is its size times its mean.
    observed = [F.col(f"N{c}") * (F.col(f"M{c}") - F.col("lo")) / (F.col("hi") - F.col("lo")) for c in (0, 1)]
    total = observed[0] + observed[1]
    terms = [F.pow(observed[c] - total * F.col(f"N{c}") / (F.col("N0") + F.col("N1")), 2) / (total * F.col(f"N{c}") / (F.col("N0") + F.col("N1"))) for c in (0, 1)]
    return rows.select(*keys, "PARAMETRIC_NAME", (terms[0] + terms[1]).alias("CHI2"))


def centroid_distance(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Euclidean distance between the classes' mean vectors over parameters that both have; -1 where there is none."""
    means = feature_means(df, keys)
    per = means.groupBy(*keys, "PARAMETRIC_NAME").agg(*[F.avg(F.when(F.col("label") == c, F.col("X"))).alias(f"M{c}") for c in (0, 1)])
    return per.groupBy(*keys).agg(F.coalesce(F.sqrt(F.sum(F.pow(F.col("M1") - F.col("M0"), 2))), F.lit(-1.0)).alias("DISTANCE"))
