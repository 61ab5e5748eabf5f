"""Whole analyses: from a cleaned fact to ranked weights.

Tiers are a column, not control flow, and nothing is collected between the
fact and the result.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import columns as fc
from ..functions import predicates as fp
from ..operators import counts, models, relation, scores, sgd, shape, weights
from ..operators.balance import balanced_scores
from ..sources.tables import written
from .request import Request, RequestError

#: The fixed shape of correlation results.
CORRELATION_SCHEMA = {
    "REQUEST_ID": "string", "INDEX_NO": "bigint", "ANALYSIS_NAME": "string", "PRODG1": "string", "PRODUCT_ID": "string", "OPE_NO": "string", "EQP_NAME": "string", "CHAMBER_NAME": "string",
    "PARAMETRIC_NAME": "string", "STATS": "string", "COUNT": "bigint", "WEIGHT": "double", "MARK": "string",
}
EXCLUDED = {"wafer": ("CXS", "CYS", "FDS"), "site": ("CXS", "CYS"), "zone": ("CXS", "CYS", "FDS")}


def selected(facts: DataFrame, request: Request, time: str = "START_TIME", closed: bool = False) -> DataFrame:
    """Rows that the request's time ranges and keywords allow, with its merge rules applied."""
    where = [fp.any_of(fp.time_range(time, *r, closed) for r in request.ranges)] if time in facts.columns else []
    where += [fp.keyword(c, v) for c, v in request.filters.items() if c in facts.columns]
    return fc.merge_columns(facts.filter(fp.all_of(where)), request.merges)


def labelled(facts: DataFrame, conf: DataFrame, upload_id: str | None) -> DataFrame:
    """Facts of configured units with their label; units are few beside facts, and looked up by a table of hashes, so that facts are not sorted for it."""
    if not upload_id:
        raise RequestError("uploadId is missing")
    own = conf.filter(F.col("UPLOAD_ID") == upload_id).select(F.col("NAME").alias("_unit"), fp.label_from_config("LABEL").alias("label")).distinct()
    return facts.join(own.hint("shuffle_hash"), F.col("WAFER_ID") == F.col("_unit")).drop("_unit")


def _univariate(rows: DataFrame, keys: Sequence[str], model: str) -> DataFrame:
    """``keys, PARAMETRIC_NAME, IMPORTANCE, SATISFIED`` by one parameter at a time."""
    if model == "anova":
        return scores.anova(rows, keys).select(*keys, "PARAMETRIC_NAME", "IMPORTANCE", "SATISFIED")
    return _shares(scores.chi2(rows, keys), keys, "CHI2") if model == "chi2" else _shares(models.mutual_information(rows, keys), keys, "MI")


def _shares(found: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """A score's share of its group's sum."""
    whole = Window.partitionBy(*keys)
    fine = F.count("*").over(whole) > 1
    share = F.coalesce(F.try_divide(F.col(name), F.sum(name).over(whole)), F.lit(0.0))
    return found.select(*keys, "PARAMETRIC_NAME", F.when(fine, share).otherwise(0.0).alias("IMPORTANCE"), fine.alias("SATISFIED"))


def _uneven(groups: DataFrame, keys: Sequence[str], balance: float) -> DataFrame:
    """Keys of groups whose class shares differ by more than ``balance``; a list of groups is broadcast, so that units are not dealt by group to find theirs."""
    return F.broadcast(groups.filter(F.abs(F.col("GOOD_NUM") - F.col("BAD_NUM")) / (F.col("GOOD_NUM") + F.col("BAD_NUM")) > balance).select(*keys))


def scored_groups(rows: DataFrame, keys: Sequence[str], groups: DataFrame, model: str, balance: float) -> DataFrame:
    """``keys, PARAMETRIC_NAME, IMPORTANCE, AUC`` of the groups whose TIER is big or small.

    Univariate scores serve both tiers.  Estimators are fitted on big groups,
    stochastic gradient machines for all of them at once, others one distributed
    fit after another; small ones take the analysis of
    variance.  Where class shares differ by more than ``balance`` the larger
    class shrinks to centroids first (mutual information takes all units).
    """
    keys = list(keys)
    single = model if model in ("anova", "chi2", "mutual_info") else "anova"
    both = groups.filter("TIER <> 'none'")
    uneven = _uneven(both, keys, balance)
    found = _univariate(rows, keys, single)
    if single != "mutual_info":
        shrunk = balanced_scores(rows.join(uneven, keys, "left_semi"), keys, single)
        found = found.join(uneven, keys, "left_anti").unionByName(shrunk)
    found = found.join(both.select(*keys, "TIER"), keys).withColumn("AUC", F.when(F.col("SATISFIED"), 1.0).otherwise(0.0))
    if model == single:
        return found.select(*keys, "PARAMETRIC_NAME", "IMPORTANCE", "AUC")
    big = both.filter("TIER = 'big'").select(*keys)
    if model.startswith("sgd"):
        # "sgd" searches all losses; "sgd:hinge" and the like one of them.
        grid = sgd.Grid(losses=(model.removeprefix("sgd:"),)) if ":" in model else sgd.Grid()
        fitted = sgd.importances(rows.join(big, keys, "left_semi"), keys, grid)
        small = found.filter("TIER = 'small'").select(*keys, "PARAMETRIC_NAME", "IMPORTANCE", "AUC")
        return small.unionByName(fitted.select(*keys, "PARAMETRIC_NAME", "IMPORTANCE", "AUC"))
    units = rows.withColumn("UNIT", F.concat_ws("/", "WAFER_ID", F.col("label").cast("string"))).withColumnRenamed("PARAMETRIC_NAME", "FEATURE")
    fitted = models.group_importances(units, keys, big.sort(*keys).collect(), model).withColumnRenamed("FEATURE", "PARAMETRIC_NAME")
    small = found.filter("TIER = 'small'").select(*keys, "PARAMETRIC_NAME", "IMPORTANCE", "AUC")
    return small.unionByName(fitted.select(*keys, "PARAMETRIC_NAME", "IMPORTANCE", "AUC"))


def scored_moments(moments: DataFrame, groups: DataFrame, keys: Sequence[str], model: str, balance: float, units: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``scored_groups`` by the analysis of variance or chi-square from moments that are aggregated already, with BAD_NUM.

    ``moments`` and ``groups`` are small written tables; ``units`` gives the
    long unit means of the groups named, and is called only where some are
    uneven.
    """
    keys = list(keys)
    both = groups.filter("TIER <> 'none'")
    uneven = _uneven(both, keys, balance)
    rows = moments.filter("PARAMETRIC_NAME is not null").drop("GOOD_NUM", "BAD_NUM").join(both.select(*keys, "BAD_NUM", F.col("GOOD_NUM").cast("double").alias("N0"), F.col("BAD_NUM").cast("double").alias("N1")), keys)
    found = scores.anova_moments(rows, keys) if model == "anova" else _shares(scores.chi2_moments(rows, keys), keys, "CHI2")
    found = found.select(*keys, "PARAMETRIC_NAME", "IMPORTANCE", "SATISFIED")
    if not uneven.isEmpty():
        found = found.join(uneven, keys, "left_anti").unionByName(balanced_scores(units(uneven), keys, model))
    return found.join(both.select(*keys, "BAD_NUM"), keys).withColumn("AUC", F.when(F.col("SATISFIED"), 1.0).otherwise(0.0)).drop("SATISFIED")


def score_groups(rows: DataFrame, keys: Sequence[str], request_id: str, balance: float = 0.7, model: str = "anova") -> DataFrame:
    """Weights of all parameters of all groups.

    Groups with both classes are scored by ``model``.  The other groups'
    parameters, constants and parameters without a value in a class have
    weight 0.  Raises if no group has both classes.
    """
    # Every consumer below needs a unit's mean of a parameter only; the facts are read once.
    rows = written(rows.groupBy("WAFER_ID", "label", *keys, "PARAMETRIC_NAME").agg(F.avg("RESULT").alias("RESULT")), "unit_means")
    groups = counts.tiers(counts.commonality(rows, keys))
    if groups.filter("TIER <> 'none'").isEmpty():
        raise RequestError("no group has both good and bad units")
    scored = scored_groups(rows, keys, groups, model, balance).join(groups.select(*keys, "BAD_NUM"), list(keys))
    weighed = weights.weights_by_bad_and_auc(scored, keys, counts.bad_total(rows))
    return weights.decorated(shape.missing_rows(counts.universe(rows, keys), weighed, [*keys, "PARAMETRIC_NAME"]), request_id)


def score_wide(rows: DataFrame, keys: Sequence[str], request_id: str, parameters: Mapping[str, str], balance: float = 0.7, model: str = "anova") -> DataFrame:
    """``score_groups`` for ``shape.distinct_sums`` of parameters side by side: a unit has one row in a group, so that sizes and moments take one pass."""
    keys, values = list(keys), list(parameters.values())
    means = written(shape.summed_means(rows, [*keys, "WAFER_ID", "label"], values), "unit_means")
    sums = written(means.groupBy(*keys).agg(*counts.sizes(), *scores.moment_parts(values)), "moments")
    groups = counts.tiers(sums.select(*keys, "GOOD_NUM", "BAD_NUM"))
    if groups.filter("TIER <> 'none'").isEmpty():
        raise RequestError("no group has both good and bad units")
    moments = scores.moments_named(sums, keys, parameters)
    long = lambda some: shape.parameters_apart(some, parameters).filter("RESULT is not null")
    if model in ("anova", "chi2"):
        scored = scored_moments(moments, groups, keys, model, balance, lambda uneven: long(means.join(uneven, keys, "left_semi")))
    else:
        scored = scored_groups(long(means), keys, groups, model, balance).join(groups.select(*keys, "BAD_NUM"), keys)
    weighed = weights.weights_by_bad_and_auc(scored, keys, counts.bad_total(means))
    names = [*keys, "PARAMETRIC_NAME"]
    return weights.decorated(shape.missing_rows(moments.select(*names, "GOOD_NUM", "BAD_NUM"), weighed, names), request_id)


def _fails(groups: DataFrame, tier: str = "none") -> DataFrame:
    """One row, which fails the query if no group has both classes."""
    some = groups.agg(F.coalesce(F.bool_or(F.col("TIER") != tier), F.lit(False)).alias("_some"))
    return some.select(F.when(F.col("_some"), 1).otherwise(F.raise_error(F.lit("no group has both good and bad units"))).alias("_fine"))


def score_stats(rows: DataFrame, keys: Sequence[str], statistics: Sequence[str], request: Request, legacy: str | None = None, balance: float = 0.7) -> DataFrame:
    """As ``score_groups`` for wide rows: each statistic of a parameter is scored on its own, all of them aggregated side by side.

    ``legacy`` chooses the earlier tiers (no small groups where any is big):
    "fdc" keeps the 60 % most important of each group and weighs by bad share
    and AUC, "auc" weighs by AUC alone.
    """
    keys = list(keys)
    means = written(scores.stat_means(rows, keys, statistics), "unit_means")
    moments = scores.stat_moments(means, keys, statistics)
    sizes = counts.commonality(means, keys)
    groups = counts.tiers_strict(sizes) if legacy else counts.tiers(sizes)
    both = groups.filter("TIER <> 'none'")
    names = ["PARAMETRIC_NAME", "STATS"]
    if request.model == "anova":
        uneven = _uneven(both, keys, balance)
        even = scores.anova_stats(moments, sizes, keys).join(uneven, keys, "left_anti").select(*keys, *names, "IMPORTANCE", "SATISFIED")
        shrunk = balanced_scores(_long(means.join(uneven, keys, "left_semi"), keys, statistics), keys)
        scored = even.unionByName(_apart(shrunk, keys).select(*keys, *names, "IMPORTANCE", "SATISFIED")).withColumn("AUC", F.when(F.col("SATISFIED"), 1.0).otherwise(0.0))
        scored = scored.join(both.select(*keys, "BAD_NUM"), keys)
    else:
        scored = _apart(scored_groups(_long(means, keys, statistics), keys, groups, request.model, balance), keys).join(both.select(*keys, "BAD_NUM"), keys)
    bad = counts.bad_total(means)
    if legacy == "fdc":
        weighed = weights.weights_fdc(weights.top_share(scored, keys, tie=names), keys, bad)
    elif legacy:
        weighed = weights.weights_auc_ratio(scored, keys)
    else:
        weighed = weights.weights_by_bad_and_auc(scored, keys, bad)
    everything = moments.select(*keys, *names, "GOOD_NUM", "BAD_NUM").crossJoin(F.broadcast(_fails(groups))).filter("_fine = 1").drop("_fine")
    return weights.decorated(shape.missing_rows(everything, weighed, [*keys, *names]), request.request_id)


def _long(means: DataFrame, keys: Sequence[str], statistics: Sequence[str]) -> DataFrame:
    """A row per statistic, named with its parameter."""
    rows = shape.unpivot_stats(means, [*keys, "WAFER_ID", "label", "PARAMETRIC_NAME"], statistics)
    return rows.withColumn("PARAMETRIC_NAME", F.concat_ws("\x1f", "PARAMETRIC_NAME", "STATS"))


def _apart(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    parts = F.split("PARAMETRIC_NAME", "\x1f")
    return rows.withColumn("STATS", F.get(parts, F.lit(1))).withColumn("PARAMETRIC_NAME", F.get(parts, F.lit(0)))


def uva(facts: DataFrame, conf: DataFrame, request: Request, least_bad: int = 0, parameters: Mapping[str, str] | None = None) -> DataFrame:
    """Sensor statistics of each unit's last run; ``least_bad`` refuses requests with fewer bad units (the early form wanted two).

    ``facts`` have a row per parameter (PARAMETRIC_NAME, RESULT), or
    ``parameters`` names each parameter's column; they stay side by side
    then, unless the request chooses or merges some.
    """
    if parameters and "PARAMETRIC_NAME" in {*request.filters, *request.merges}:
        facts, parameters = shape.parameters_apart(facts, parameters), None
    values = list(parameters.values()) if parameters else ["RESULT"]
    rows = selected(facts.filter(F.col("STATUS") != "ERROR"), request)
    rows = shape.last_runs(labelled(rows.filter(F.coalesce(*[F.col(v) for v in values]).isNotNull()), conf, request.upload_id))
    if least_bad:
        rows = counts.enough_bad(rows, least_bad)
    if parameters:
        return score_wide(shape.distinct_sums(rows, values), request.keys, request.request_id, parameters, model=request.model)
    rows = rows.distinct()
    return score_groups(rows, request.keys, request.request_id, model=request.model)


def inline_by_wafer(facts: DataFrame, conf: DataFrame, request: Request, statistics: Sequence[str] = ("AVERAGE", "MAX_VAL", "MEDIAN", "MIN_VAL", "STD_DEV", "PERCENTILE_25", "PERCENTILE_75")) -> DataFrame:
    """In-line and acceptance statistics: each statistic of a parameter is scored on its own."""
    rows = selected(facts.filter(fp.excludes("PARAMETRIC_NAME", EXCLUDED["wafer"])), request, "MEASURE_TIME")
    rows = labelled(rows.withColumns({s: fc.number(s) for s in statistics}), conf, request.upload_id)
    return score_stats(rows, request.keys, statistics, request)


def wat_by_wafer(facts: DataFrame, conf: DataFrame, request: Request, mapping: DataFrame | None = None, statistics: Sequence[str] = ("AVERAGE", "MAX_VAL", "MEDIAN", "MIN_VAL", "STD_DEV", "SITE_COUNT")) -> DataFrame:
    """Acceptance statistics.  Item types 1 and 2 keep the parameters that ``mapping`` has under them, any other type those that it does not have; without group keys all rows are one group."""
    rows = selected(facts, request, "MEASURE_TIME")
    if request.item_type is not None:
        if mapping is None:
            raise RequestError("an item type needs the table of items")
        rows = fp.with_mapping(rows, mapping, "PARAMETRIC_NAME", [request.item_type]) if request.item_type in (1, 2) else rows.join(F.broadcast(mapping.select("PARAMETRIC_NAME").distinct()), "PARAMETRIC_NAME", "left_anti")
    rows = labelled(rows.withColumns({s: fc.number(s) for s in statistics}), conf, request.upload_id)
    keys = list(request.keys)
    if not keys:
        rows, keys = rows.withColumn("OPE_NO", F.lit("FAKE_OPE_NO")), ["OPE_NO"]
    return score_stats(rows, keys, statistics, request, legacy="auc")


def by_site(facts: DataFrame, request: Request) -> DataFrame:
    """Good against bad sites of the same units: principal parameters by loading."""
    rows = selected(facts.filter(fp.excludes("PARAMETRIC_NAME", EXCLUDED["site"])), request, "MEASURE_TIME")
    long = shape.site_features(rows, [*request.keys, "WAFER_ID", "PARAMETRIC_NAME"], request.good_sites, request.bad_sites, gaps=True)
    return _by_loading(long, request)


def by_zone(facts: DataFrame, request: Request) -> DataFrame:
    rows = selected(facts.filter(fp.excludes("PARAMETRIC_NAME", EXCLUDED["zone"])), request, "MEASURE_TIME")
    wide = shape.zone_features(rows, [*request.keys, "WAFER_ID", "PARAMETRIC_NAME"], request.zones)
    stats = [c for c in wide.columns if c not in (*request.keys, "WAFER_ID", "PARAMETRIC_NAME", "LABEL", "ZONE")]
    long = shape.unpivot_stats(wide.withColumnRenamed("LABEL", "label"), [*request.keys, "WAFER_ID", "PARAMETRIC_NAME", "label"], stats, gaps=True)
    return _by_loading(long, request)


def _by_loading(long: DataFrame, request: Request, missing: float = 0.7) -> DataFrame:
    """``missing`` bounds the share of gaps twice: of a statistic among a group's rows, then of a parameter's statistic among its units."""
    keys = list(request.keys)
    everything = counts.universe(long, keys, stats=True, labelled=False)
    filled = shape.fill_statistics(long, keys, missing)
    unit = filled.withColumn("UNIT", F.concat_ws("/", "WAFER_ID", F.col("label").cast("string"))).withColumn("FEATURE", F.concat_ws("\x1f", "PARAMETRIC_NAME", "STATS"))
    top = models.pca_features(unit, keys, normalise=False, missing=missing)
    parts = F.split("FEATURE", "\x1f")
    scored = top.groupBy(*keys, F.get(parts, F.lit(0)).alias("PARAMETRIC_NAME"), F.get(parts, F.lit(1)).alias("STATS")).agg(F.sum("IMPORTANCE").alias("IMPORTANCE"))
    return weights.decorated(shape.missing_rows(everything, weights.weights_small(scored), [*keys, "PARAMETRIC_NAME", "STATS"]), request.request_id)


def defect(facts: DataFrame, conf: DataFrame, request: Request, parameters: Sequence[str] = ("RANDOM_DEFECTS", "DEFECTS", "ADDER_DEFECTS", "CLUSTERS", "ADDER_RANDOM_DEFECTS", "ADDER_CLUSTERS")) -> DataFrame:
    """The last inspection of each unit; each count is a parameter."""
    rows = labelled(selected(facts, request, "INSPECTION_TIME"), conf, request.upload_id)
    order = [F.desc("INSPECTION_TIME"), *[F.desc(p) for p in parameters]]
    rows = shape.latest_by(rows, ["WAFER_ID", "label", *request.keys], order)
    long = rows.select(*request.keys, "WAFER_ID", "label", *[F.col(p).cast("double").alias(p) for p in parameters])
    long = long.unpivot([*request.keys, "WAFER_ID", "label"], list(parameters), "PARAMETRIC_NAME", "RESULT")
    keys = list(request.keys)
    groups = counts.tiers_strict(counts.commonality(long, keys))
    # A group needs more than six units, whatever their classes.
    groups = groups.withColumn("TIER", F.when(F.col("GOOD_NUM") + F.col("BAD_NUM") > 6, F.col("TIER")).otherwise("none"))
    weighed = weights.weights_auc_ratio(scored_groups(long, keys, groups, request.model, 0.7), keys)
    everything = counts.fixed_universe(rows, keys, parameters).crossJoin(F.broadcast(_fails(groups))).filter("_fine = 1").drop("_fine")
    return weights.decorated(shape.missing_rows(everything, weighed, [*keys, "PARAMETRIC_NAME"]), request.request_id)


def fdc(facts: DataFrame, conf: DataFrame, request: Request, statistics: Sequence[str] = ("AVERAGE", "STD_VAL", "MIN_VAL", "PERCENTILE_25", "MEDIAN", "PERCENTILE_75", "MAX_VAL", "RANGE1")) -> DataFrame:
    """Run-data statistics of each unit's last run."""
    rows = labelled(selected(facts, request), conf, request.upload_id)
    last = shape.latest_run(rows)
    return score_stats(last, request.keys, statistics, request, legacy="fdc")


# --- correlation with an anomaly vector -----------------------------------------------------------------------------
def _with_base(rows: DataFrame, base: DataFrame) -> DataFrame:
    return rows.join(base.select(F.col("NAME").alias("_unit"), F.col("VAL").cast("double").alias("VAL")).hint("shuffle_hash"), F.col("WAFER_ID") == F.col("_unit")).drop("_unit")


def correlation_rows(source: str, facts: DataFrame, part: Request, units: DataFrame | None = None, by_site: bool = False) -> DataFrame:
    """What a source contributes: the request's filters, the units of its upload, and of in-line and acceptance rows those of range 0, each unit's last measurement.

    Columns of a filter that the facts do not have are skipped; ``by_site``
    keeps in-line rows of level Site.
    """
    measured = source in ("inline", "wat")
    rows = selected(facts, part, "MEASURE_TIME" if measured else "START_TIME", closed=True)
    if part.filter_upload_id:
        if units is None:
            raise RequestError("a filter by upload needs the table of its units")
        rows = rows.join(units.filter(F.col("UPLOAD_ID") == part.filter_upload_id).select(F.col("NAME").alias("WAFER_ID")).hint("shuffle_hash"), "WAFER_ID", "left_semi")
    if not measured:
        return rows
    if source == "inline":
        rows = rows.filter(fp.excludes("PARAMETRIC_NAME", ("CXS", "CYS")))
        if by_site and "DATA_LEVEL" in rows.columns:
            rows = rows.filter(F.col("DATA_LEVEL") == "Site")
    if "RANGE_INDEX" in rows.columns:
        rows = rows.filter("RANGE_INDEX = 0")
    if "MEASURE_TIME" not in rows.columns:
        return rows
    keys = [k for k in ("PH_FAB_ID_LABEL", "PRODG1", "WAFER_ID", "OPE_NO", "PARAMETRIC_NAME") if k in rows.columns]
    ties = [c for c in rows.columns if c not in (*keys, "MEASURE_TIME")]
    return shape.latest_by(rows, keys, [F.desc("MEASURE_TIME"), *ties])


def correlate(source: str, facts: DataFrame, base: DataFrame, part: Request, units: DataFrame | None = None, statistics: Sequence[str] = ("AVERAGE", "MAX_VAL", "MEDIAN", "MIN_VAL", "STD_DEV")) -> DataFrame:
    """One source's parameters against the anomaly: keys, PARAMETRIC_NAME, STATS, COUNT, WEIGHT."""
    rows = correlation_rows(source, facts, part, units)
    keys, order = list(part.keys), ["WAFER_ID"]
    if source == "uva":
        rows = shape.latest_run(rows.filter("RESULT is not null"))
        keys += ["PARAMETRIC_NAME"]
        means = rows.groupBy(*keys, "WAFER_ID").agg(F.avg("RESULT").alias("X"))
    elif source in ("inline", "wat"):
        rows = rows.withColumns({s: fc.number(s) for s in statistics})
        # Statistics are averaged, meet the anomaly and are related side by side.
        wide = rows.groupBy(*part.keys, "PARAMETRIC_NAME", "WAFER_ID").agg(*[F.avg(s).alias(s) for s in statistics])
        return relation.relations(_with_base(wide, base), [*keys, "PARAMETRIC_NAME"], {s: s for s in statistics}, "VAL", order, "STATS").withColumnRenamed("PAIRS", "COUNT")
    elif source == "process":
        keys = [k for k in keys if k != "OPE_NO"]
        means = rows.groupBy(*keys, "WAFER_ID").agg(F.count("*").cast("double").alias("X"))
    elif source == "qtime":
        means, order = rows.select(*keys, "WAFER_ID", fc.minutes("DIFF_TIME").alias("X")), ["WAFER_ID", "X"]
    else:
        raise RequestError(f"unknown source: {source}")
    means = means if "VAL" in means.columns else _with_base(means, base)
    found = relation.relation(means, keys, "X", "VAL", order).withColumnRenamed("PAIRS", "COUNT")
    return found.withColumn("STATS", F.lit("GO_THROUGH_TIME")) if source == "process" else found


def correlate_vectors(facts: DataFrame, base: DataFrame, part: Request, places: Sequence[str] | Mapping[str, Sequence[str]], source: str = "inline", units: DataFrame | None = None) -> DataFrame:
    """By site or by zone: a group's mean vector over places against the anomaly's (NAME, VAL); fewer than three common places give 0.  COUNT is the group's rows that name a unit."""
    keys = [*part.keys, "PARAMETRIC_NAME"]
    rows = correlation_rows(source, facts, part, units, by_site=not isinstance(places, Mapping))
    names = list(places)
    if isinstance(places, Mapping):
        rows = shape.zone_means(rows, [*keys, "WAFER_ID"], places)
    # All places of a group in one aggregate; its one row then becomes a row a place.
    usable = [F.when(~F.isnan(p), F.col(p)) for p in names]
    means = rows.groupBy(*keys).agg(F.count("WAFER_ID").alias("COUNT"), *[F.avg(v).alias(p) for p, v in zip(names, usable, strict=True)])
    long = means.unpivot([*keys, "COUNT"], names, "PLACE", "V").filter("V is not null")
    own = base.select(F.col("NAME").alias("PLACE"), F.col("VAL").cast("double").alias("VAL"))
    found = relation.relation(long.join(own, "PLACE"), keys, "VAL", "V", ["PLACE"]).drop("PAIRS")
    return found.join(means.select(*keys, "COUNT"), keys)


def merge_sources(results: Mapping[str, DataFrame], request_id: str) -> DataFrame:
    """All sources in the fixed schema, ranked together."""
    if not results:
        raise RequestError("no source gave a result")
    rows = None
    for name, r in results.items():
        part = fc.conform(r.withColumns({"REQUEST_ID": F.lit(request_id), "ANALYSIS_NAME": F.lit(name)}), CORRELATION_SCHEMA)
        rows = part if rows is None else rows.unionByName(part)
    ties = [c for c in CORRELATION_SCHEMA if c not in ("WEIGHT", "COUNT", "INDEX_NO")]
    return weights.ranked(rows.drop("INDEX_NO"), [F.desc("WEIGHT"), F.desc("COUNT"), *ties]).select(*CORRELATION_SCHEMA)


def _boosted(results: DataFrame, outside: DataFrame | None, target: str) -> DataFrame:
    """Multiplied by outside scores and ranked anew; not normalised again."""
    if outside is None:
        return results
    rows = weights.boost(results.drop("INDEX_NO"), outside, target)
    ties = [c for c in rows.columns if c != target]
    return weights.ranked(rows, [F.desc(target), *ties]).select(*results.columns)


def run(request: Request, tables: Mapping[str, DataFrame], parameters: Mapping[str, str] | None = None) -> DataFrame:
    """Answer a request from named tables: facts by source, ``conf_wafer``, ``anomaly`` and, if there are any, ``scores``.  ``parameters``: of sensor facts with a column for each parameter, their columns by name."""
    if request.source == "correlation":
        base = tables["anomaly"]
        if "REQUEST_ID" in base.columns:
            base = base.filter(F.col("REQUEST_ID") == request.request_id)
        if request.granularity == "wafer":
            found = {s: correlate(s, tables[s], base, p, tables.get("correlation_wafer")) for s, p in request.parts.items()}
        else:
            facts = {s: p for s, p in request.parts.items() if s in ("inline", "wat")}
            places = [c for s in facts for c in tables[s].columns if c.startswith("SITE") and c.endswith("_VAL")]
            zones = {z: s for own in request.zones.values() for z, s in own.items()}
            found = {s: correlate_vectors(tables[s], base, p, zones if request.granularity == "zone" else places, s, tables.get("correlation_wafer")) for s, p in facts.items()}
        out = merge_sources(found, request.request_id)
        return _boosted(out, tables.get("scores"), "WEIGHT")
    facts, conf = tables[request.source], tables.get("conf_wafer")
    if request.source == "uva":
        return _boosted(uva(facts, conf, request, parameters=parameters), tables.get("scores"), "WEIGHT_PERCENT")
    if request.source == "defect":
        return defect(facts, conf, request)
    if request.source == "fdc_advanced":
        return fdc(facts, conf, request)
    if request.source == "wat" and request.granularity == "wafer":
        return wat_by_wafer(facts, conf, request, tables.get("wat_items"))
    return {"wafer": lambda: inline_by_wafer(facts, conf, request), "site": lambda: by_site(facts, request), "zone": lambda: by_zone(facts, request)}[request.granularity]()


def run_all(requests: Sequence[Request], tables: Mapping[str, DataFrame]) -> DataFrame:
    """Several requests in one table, each numbered by itself."""
    if not requests:
        raise RequestError("no request")
    out = run(requests[0], tables)
    for r in requests[1:]:
        out = out.unionByName(run(r, tables), allowMissingColumns=True)
    return out
