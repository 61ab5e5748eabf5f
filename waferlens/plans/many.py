"""Any number of sensor requests in one plan: requests are a table that is joined to the facts, and the request leads every key.

Requests are bits: 64 of an upload make a chunk, and a fact costs a row for
each chunk in which some request wants it.  Which requests want it is found
by lookup: each day, cut where ranges begin and end, and each value of a
column with keywords is compared with the requests once.  Last runs follow
from the bits of later runs, and only units' sums become a row per request.
Requests with merge rules or another model than the analysis of variance are
refused here, with the reason; ``pipelines.run`` answers them.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from ..functions import predicates as fp
from ..operators import counts, numbering, scores, shape, weights
from ..sources.tables import written
from . import pipelines
from .request import DEFAULT_KEYS, FILTERS, MERGES

KEYS = list(DEFAULT_KEYS)
#: Stands for a key that a request does not group by; null would not meet null.
_ALL = "\0"
#: Requests that a fact's row stands for, one bit of a long each.
CHUNK = 64
_UNDATED = "date'0001-01-01'"  # the day of facts without a time


def _texts(field: str) -> Column:
    """A text, comma lists in it apart, or a list of such; nothing gives an empty list."""
    raw = F.col(field)
    listed = F.when(raw.startswith("["), F.from_json(raw, "array<string>"))
    each = F.flatten(F.transform(F.coalesce(listed, F.array(raw)), lambda x: F.split(x, ",")))
    return F.coalesce(F.filter(each, lambda x: x != ""), F.array().cast("array<string>"))


def _pattern(value: Column) -> Column:
    """A value with wild cards, for LIKE."""
    for mark in ("\\", "%", "_"):
        value = F.replace(value, F.lit(mark), F.lit("\\" + mark))
    return F.replace(value, F.lit("*"), F.lit("%"))


def request_table(texts: DataFrame, column: str = "text") -> DataFrame:
    """Requests parsed by one projection: REQUEST_ID, UPLOAD_ID, KEYS, RANGES, a list of exact and of wild keywords per restricted column, and REFUSED (null, or why not)."""
    lists = sorted({*FILTERS, *MERGES, "uploadId", "groupByList", "dateRange", "model", "flagMergeAllProdg1", "flagMergeAllProductId", "flagMergeAllChamber"})
    schema = f"requestId string, algorithm string, requestParam struct<{', '.join(f'{n}: string' for n in lists)}>"
    rows = texts.select(F.from_json(column, schema).alias("r")).select("r.requestId", "r.algorithm", "r.requestParam.*")
    span = "struct<start: string, end: string>"
    ranges = F.coalesce(F.when(F.col("dateRange").startswith("["), F.from_json("dateRange", f"array<{span}>")), F.array(F.from_json("dateRange", span)))
    faulty = F.exists(ranges, lambda x: ((x["start"] != "") & x["start"].try_cast("timestamp").isNull()) | ((x["end"] != "") & x["end"].try_cast("timestamp").isNull()))
    ranges = F.transform(ranges, lambda x: F.struct(x["start"].try_cast("timestamp").alias("start"), x["end"].try_cast("timestamp").alias("end")))
    everything = F.array(F.struct(F.lit(None).cast("timestamp").alias("start"), F.lit(None).cast("timestamp").alias("end")))
    gone = F.when(F.col("flagMergeAllProdg1") == "1", F.array(F.lit("PRODG1"), F.lit("PRODUCT_ID"))).when(F.col("flagMergeAllProductId") == "1", F.array(F.lit("PRODUCT_ID"))).otherwise(F.array().cast("array<string>"))
    gone = F.concat(gone, F.when(F.col("flagMergeAllChamber") == "1", F.array(F.lit("CHAMBER_NAME"))).otherwise(F.array().cast("array<string>")))
    keys = F.coalesce(F.from_json("groupByList", "array<string>"), F.array_except(F.array(*map(F.lit, KEYS)), gone))
    words: dict[str, Column] = {}
    for name, c in FILTERS.items():  # of two fields for one column the later counts
        own = _texts(name)
        words[c] = F.when(F.size(own) > 0, own).otherwise(words[c]) if c in words else own
    merging = [F.coalesce(F.size(F.from_json(f, "array<string>")) > 0, F.lit(False)) for f in MERGES]
    refused = (
        F.when(F.coalesce(F.col("uploadId"), F.lit("")) == "", "uploadId is missing").when(F.coalesce(F.col("algorithm") != "uva", F.lit(True)), "another algorithm")
        .when(F.coalesce(F.col("model"), F.lit("anova")) != "anova", "another model").when(F.array_contains(F.array(*merging), True), "merge rules").when(F.size(F.array_except(keys, F.array(*map(F.lit, KEYS)))) > 0, "unknown group key")
        .when(F.coalesce(faulty, F.lit(False)), "malformed date")
    )
    exact = {f"_is_{c}": F.filter(w, lambda x: ~F.contains(x, F.lit("*"))) for c, w in words.items()}
    wild = {f"_like_{c}": F.transform(F.filter(w, lambda x: F.contains(x, F.lit("*"))), _pattern) for c, w in words.items()}
    return rows.select(F.col("requestId").alias("REQUEST_ID"), F.col("uploadId").alias("UPLOAD_ID"), keys.alias("KEYS"), F.when(F.size(ranges) > 0, F.coalesce(F.filter(ranges, lambda x: x.isNotNull()), everything)).otherwise(everything).alias("RANGES"), *[c.alias(n) for n, c in {**exact, **wild}.items()], refused.alias("REFUSED"))


def _wanted(column: str) -> Column:
    """No keywords for the column, or one of them is or matches its value."""
    exact, wild = F.col(f"_is_{column}"), F.col(f"_like_{column}")
    return ((F.size(exact) == 0) & (F.size(wild) == 0)) | F.array_contains(exact, F.col(column)) | F.exists(wild, lambda p: F.like(F.col(column), p))


def _numbered(requests: DataFrame) -> DataFrame:
    """Requests that are not refused, written, each a bit (``_bit``) of one of its upload's chunks (``_chunk``)."""
    asked = requests.filter("REFUSED is null").dropDuplicates(["REQUEST_ID"]).drop("REFUSED")
    rows = numbering.numbered_within(asked, ["UPLOAD_ID"], ["REQUEST_ID"], "_no", 0)
    return written(rows.select("*", F.floor(F.col("_no") / CHUNK).alias("_chunk"), (F.col("_no") % CHUNK).cast("int").alias("_bit")).drop("_no"), "requests")


def _set(wanted: Column) -> Column:
    """The requests of a chunk that want something, as bits."""
    return F.coalesce(F.bit_or(F.when(wanted, F.expr("shiftleft(1L, _bit)"))), F.lit(0).cast("long"))


def _restricted(asked: DataFrame, columns: Iterable[str]) -> list[str]:
    """The columns that a request has keywords for."""
    names = sorted(columns)
    row = asked.agg(*[F.bool_or(F.size(f"_is_{c}") + F.size(f"_like_{c}") > 0).alias(c) for c in names]).first()
    return [c for c in names if row[c]]


def _pieces(days: DataFrame, asked: DataFrame) -> DataFrame:
    """``UPLOAD_ID, _chunk, _day, _from, _to, _timely``: days, cut where a range begins or ends, so that a request wants a piece as a whole or not at all."""
    start, end = F.col("_day").cast("timestamp"), F.date_add("_day", 1).cast("timestamp")
    dated = F.col("_day") != F.expr(_UNDATED)
    within = lambda low, high: F.exists("RANGES", lambda x: (x["start"].isNull() | (x["start"] < high)) & (x["end"].isNull() | (x["end"] > low)))
    always = F.exists("RANGES", lambda x: x["start"].isNull() & x["end"].isNull())
    met = days.crossJoin(F.broadcast(asked)).filter(F.when(dated, within(start, end)).otherwise(always))
    ends = F.filter(F.flatten(F.transform("RANGES", lambda x: F.array(x["start"], x["end"]))), lambda t: (t > start) & (t < end))
    cut = met.groupBy("UPLOAD_ID", "_chunk", "_day").agg(F.flatten(F.collect_set(F.when(dated, ends))).alias("_ends"))
    cut = cut.withColumn("_ends", F.array_sort(F.array_distinct(F.concat(F.array(start), "_ends"))))
    each = cut.select("UPLOAD_ID", "_chunk", "_day", "_ends", F.posexplode("_ends").alias("_n", "_from"))
    each = each.withColumn("_to", F.get("_ends", F.col("_n") + 1)).drop("_ends", "_n")
    own = each.join(asked.select("UPLOAD_ID", "_chunk", "_bit", "RANGES"), ["UPLOAD_ID", "_chunk"])
    wanted = F.when(dated, F.exists("RANGES", lambda x: (x["start"].isNull() | (x["start"] <= F.col("_from"))) & (x["end"].isNull() | (x["end"] > F.col("_from"))))).otherwise(always)
    return own.groupBy("UPLOAD_ID", "_chunk", "_day", "_from", "_to").agg(_set(wanted).alias("_timely")).filter("_timely <> 0")


def wanted(facts: DataFrame, asked: DataFrame, time: str = "START_TIME") -> DataFrame:
    """Facts with an UPLOAD_ID, a copy of each for every chunk of requests in which some want it, with ``_chunk`` and their bits, ``_set``.

    Times and keywords are compared once for each different value.
    """
    columns = _restricted(asked, set(FILTERS.values()) & set(facts.columns))
    day = F.coalesce(F.to_date(time), F.expr(_UNDATED))
    named = [F.struct(F.lit(n).alias("_column"), v.cast("string").alias("_value")) for n, v in [("_day", day), *((c, F.col(c)) for c in columns)]]
    values = written(facts.select(F.inline(F.array(*named))).distinct(), "values")
    pieces = written(_pieces(values.filter("_column = '_day'").select(F.col("_value").cast("date").alias("_day")), asked), "pieces")
    t = F.col(time)
    timely = (F.col("_day") == F.expr(_UNDATED)) | ((t >= F.col("_from")) & (F.col("_to").isNull() | (t < F.col("_to"))))
    rows = facts.withColumn("_day", day).join(pieces, ["UPLOAD_ID", "_day"]).filter(timely).withColumn("_set", F.col("_timely"))
    for c in columns:
        own = values.filter(F.col("_column") == c).select(F.col("_value").alias(c)).crossJoin(F.broadcast(asked))
        own = written(own.groupBy("UPLOAD_ID", "_chunk", F.col(c).alias("_value")).agg(_set(_wanted(c)).alias("_own")).filter("_own <> 0"), "keywords")
        own = own.select(F.col("UPLOAD_ID").alias("_u"), F.col("_chunk").alias("_c"), "_value", "_own")
        met = (F.col("UPLOAD_ID") == F.col("_u")) & (F.col("_chunk") == F.col("_c")) & F.col(c).cast("string").eqNullSafe(F.col("_value"))
        rows = rows.join(own, met).withColumn("_set", F.col("_set").bitwiseAND(F.col("_own"))).drop("_u", "_c", "_value", "_own").filter("_set <> 0")
    return rows.select(*facts.columns, "_chunk", "_set")


def last_wanted(rows: DataFrame) -> DataFrame:
    """Of the bits of ``_set`` those whose request wants no later run of the unit's step and chamber; ``_new`` has the bits that a unit has for the first time."""
    cell = ["UPLOAD_ID", "_chunk", "WAFER_ID", "label", "OPE_NO", "CHAMBER_ID"]
    known = rows.na.drop(subset=["WAFER_ID", "OPE_NO", "CHAMBER_ID", "RUN_ID"])
    if not isinstance(rows.schema["RUN_ID"].dataType, IntegralType):
        known = known.withColumn("_run", -F.dense_rank().over(Window.partitionBy(*cell).orderBy(F.desc("RUN_ID"))))
    run = "_run" if "_run" in known.columns else "RUN_ID"
    later = F.bit_or("_set").over(Window.partitionBy(*cell).orderBy(F.desc(run)).rangeBetween(Window.unboundedPreceding, -1))
    found = known.withColumn("_set", F.col("_set").bitwiseAND(F.bitwise_not(F.coalesce(later, F.lit(0))))).filter("_set <> 0")
    # The same order as above, so rows are not sorted again.
    before = F.bit_or("_set").over(Window.partitionBy(*cell[:4]).orderBy(*cell[4:], F.desc(run)).rowsBetween(Window.unboundedPreceding, -1))
    return found.withColumn("_new", F.col("_set").bitwiseAND(F.bitwise_not(F.coalesce(before, F.lit(0))))).drop("_run")


def uva(facts: DataFrame, conf: DataFrame, requests: DataFrame, parameters: Mapping[str, str] | None = None) -> DataFrame:
    """Answers to all requests that are not refused, each normalised and numbered by itself; keys that a request does not use are null.

    ``facts`` have a row per parameter (PARAMETRIC_NAME, RESULT), or
    ``parameters`` names each parameter's column.  A request none of whose
    groups has both classes has no rows.
    """
    asked = _numbered(requests)
    facts = facts.filter(F.col("STATUS") != "ERROR")
    if parameters and _restricted(asked, ["PARAMETRIC_NAME"]):
        facts, parameters = shape.parameters_apart(facts, parameters), None
    values = list(parameters.values()) if parameters else ["RESULT"]
    own = conf.select(F.col("UPLOAD_ID"), F.col("NAME").alias("_unit"), fp.label_from_config("LABEL").alias("label")).distinct()
    facts = facts.filter(F.coalesce(*[F.col(v) for v in values]).isNotNull())
    labelled = facts.drop("UPLOAD_ID").join(own.hint("shuffle_hash"), F.col("WAFER_ID") == F.col("_unit")).drop("_unit")
    # Equal facts count once for every request; what follows needs sums only.
    rows = last_wanted(shape.distinct_sums(wanted(labelled, asked), values))
    rows = rows.join(asked.select("UPLOAD_ID", "_chunk", "_bit", "REQUEST_ID", "KEYS"), ["UPLOAD_ID", "_chunk"]).filter(F.bit_get("_set", F.col("_bit")) == 1)
    rows = rows.withColumns({k: F.when(F.array_contains("KEYS", k), F.col(k)).otherwise(_ALL) for k in KEYS})
    keys, per = ["REQUEST_ID", *KEYS], ["REQUEST_ID"]
    ids = keys if parameters else [*keys, "PARAMETRIC_NAME"]
    units = shape.summed_means(rows, [*ids, "WAFER_ID", "label"], values, F.max(F.bit_get("_new", F.col("_bit"))).alias("_new"))
    bad = F.sum(F.when(F.col("label") == 1, F.col("_new"))).alias("BAD_TOTAL")
    if parameters:
        # A unit has one row in a group: sizes and moments take one pass, and units are not written.
        sums = written(units.groupBy(*keys).agg(*counts.sizes(), bad, *scores.moment_parts(values)), "moments")
        moments = scores.moments_named(sums, keys, parameters)
        sizes = sums.select(*keys, "GOOD_NUM", "BAD_NUM")
        apart = lambda some: shape.parameters_apart(some, parameters).filter("RESULT is not null")
    else:
        units = written(units, "units")
        sums = units.groupBy(*per).agg(bad)
        moments = written(scores.stat_moments(units, keys, values), "moments")
        sizes, apart = written(counts.commonality(units, keys), "groups"), lambda some: some
    groups = counts.tiers(sizes)
    total = sums.groupBy(*per).agg(F.sum("BAD_TOTAL").alias("BAD_TOTAL")).filter("BAD_TOTAL > 0")
    uneven_units = lambda uneven: apart(units.join(uneven, keys, "left_semi").select(*ids, "WAFER_ID", "label", *values))
    scored = pipelines.scored_moments(moments, groups, keys, "anova", 0.7, uneven_units)
    weighed = weights.weights_by_bad_and_auc(scored, keys, total, per)
    names = [*keys, "PARAMETRIC_NAME"]
    out = shape.missing_rows(moments.select(*names, "GOOD_NUM", "BAD_NUM"), weighed, names).join(groups.filter("TIER <> 'none'").select(*per).distinct(), per, "left_semi")
    out = out.withColumns({k: F.nullif(F.col(k), F.lit(_ALL)) for k in KEYS}).withColumn("WEIGHT_PERCENT", F.col("WEIGHT") * 100)
    return numbering.numbered_within(out, per, [F.desc("WEIGHT"), *KEYS, "PARAMETRIC_NAME"], "INDEX_NO")
