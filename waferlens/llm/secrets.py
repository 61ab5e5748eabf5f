"""Multipart credential linking.

Access identifiers, assigned secrets and long hexadecimal runs are reported
wherever they stand.  Bare key-like runs and endpoints are weak: they are
reported only when a complementary part lies within ``scope`` code points.
The parts of a text are joined by interval with sorted windows over (text,
start): each part sees the nearest complementary part before and after it, so
no pairs are made, and is linked to those within the scope.  Built-in functions
only.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut

# The patterns of the result contract.  A pattern with a least
# length equals "match, then drop short ones", since its runs are maximal.
_KEYWORDS = ("password", "passwd", "secret", "token", "api_?key")
ASSIGN = "(" + "|".join("".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in k) for k in _KEYWORDS) + r""")["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = "AKIA[A-Z0-9]{16,}"
HEX = "[0-9a-f]{24,}"
# The method's own weak kinds.
KEY = "[A-Za-z0-9/+]{40,}={0,2}"
ENDPOINT = r"https?://[A-Za-z0-9.-]+(?::[0-9]+)?"
#: kind, pattern, group whose length counts, least length
KINDS = (("assign", ASSIGN, 2, 6), ("access", ACCESS, 0, 20), ("hex", HEX, 0, 24), ("key", KEY, 0, 40), ("endpoint", ENDPOINT, 0, 0))
BASE = ("assign", "access", "hex")
SCOPE = 200


def _part(number: int, least: int) -> Callable[[Column, Column], Column]:
    def of(x: Column, i: Column) -> Column:
        return F.struct(F.lit(number).alias("kind"), i.alias("i"), F.length(x["g"]).alias("gap"), F.length(x["m"]).alias("len"), (F.length(x["v"]) >= least).alias("ok"))

    return of


def _of_kind(number: int) -> Callable[[Column], Column]:
    return lambda s: s["kind"] == number


def _parts(text: Column) -> Column:
    """All matches of all kinds: kind number, place in its kind, code points since the match before, length, and whether it is long enough."""
    arrays = []
    for number, (_, pattern, group, least) in enumerate(KINDS):
        gaps, found = F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
        value = F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
        zipped = F.arrays_zip(found.alias("m"), value.alias("v"), F.slice(gaps, 1, F.size(found)).alias("g"))
        each = F.transform(zipped, _part(number, least))
        arrays.append(F.when(text.rlike(pattern), each).otherwise(F.array().cast("array<struct<kind:int,i:int,gap:int,len:int,ok:boolean>>")))
    return F.flatten(F.array(*arrays))


def _name(kind: Column) -> Column:
    return F.element_at(F.array(*[F.lit(k) for k, *_ in KINDS]), kind + 1)


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", scope: int = SCOPE) -> DataFrame:
    """One row per distinct (id, text): ``id, text_key, text_size, copies, spans``.

    ``spans`` is an array of (start, kind number, end, kind, free, links) in
    order, start inclusive and end exclusive in code points; ``free`` is where
    the spans before it have ended.  ``links`` names the nearest complementary
    parts (start, kind number, end) before and after within ``scope``: access
    identifiers of assigned secrets and bare keys, access identifiers and
    assigned secrets of endpoints.  ``text_key`` and ``text_size`` are the
    text's xxhash64 and bytes.  Null texts are empty.
    """
    slim = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("body"))
    rows = slim.select("id", F.xxhash64("body").alias("text_key"), F.octet_length("body").alias("text_size"), _parts(F.col("body")).alias("parts"))
    doc = ("id", "text_key", "text_size")
    rows = rows.groupBy(*doc).agg(F.count("*").alias("copies"), F.first("parts").alias("parts"))
    each = rows.select(*doc, "copies", F.explode_outer("parts").alias("p")).select(*doc, "copies", "p.*")
    run = Window.partitionBy(*doc, "kind").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    end = F.sum(F.col("gap") + F.col("len")).over(run)
    # A match that is too short counts for places only; its row stays, since it may be its text's only one.
    each = each.withColumn("end", end).withColumn("start", F.col("end") - F.col("len")).withColumn("kind", F.when(F.col("ok"), F.col("kind")))
    order = Window.partitionBy(*doc).orderBy("start", "kind", "end")
    before, after = order.rowsBetween(Window.unboundedPreceding, 0), order.rowsBetween(0, Window.unboundedFollowing)
    is_kind = {k: F.col("kind") == n for n, (k, *_) in enumerate(KINDS)}

    def nearest(*kinds: str) -> list[Column]:
        """The nearest parts of these kinds before and after, null beyond the scope."""
        of = F.lit(False)
        for k in kinds:
            of = of | is_kind[k]
        part = [F.col(c).alias(c) for c in ("start", "kind", "end")]
        prior = F.max(F.when(of, F.struct(F.col("end").alias("at"), F.struct(*part).alias("part")))).over(before)
        later = F.min(F.when(of, F.struct(F.col("start").alias("at"), F.struct(*part).alias("part")))).over(after)
        return [F.when(F.col("start") - prior["at"] <= scope, prior["part"]), F.when(later["at"] - F.col("end") <= scope, later["part"])]

    strong = is_kind["assign"] | is_kind["access"] | is_kind["hex"]
    covered = F.coalesce(F.max(F.when(strong, F.col("end"))).over(before) >= F.col("end"), F.lit(False))
    sides = [*zip(("access_before", "access_after"), nearest("access"), strict=True), *zip(("secret_before", "secret_after"), nearest("assign", "access"), strict=True)]
    each = each.select(*doc, "copies", "start", "end", "kind", strong.alias("strong"), *[c.alias(n) for n, c in sides], covered.alias("covered"))
    by_access = F.array_compact(F.array_distinct(F.array("access_before", "access_after")))
    by_secret = F.array_compact(F.array_distinct(F.array("secret_before", "secret_after")))
    links = F.when(F.col("kind").isin(0, 3), by_access).when(F.col("kind") == 4, by_secret).otherwise(F.slice(by_access, 1, 0))
    each = each.select(*doc, "copies", "start", "end", "kind", "strong", "covered", links.alias("links"))
    weak = (F.size("links") > 0) & ((F.col("kind") == 4) | ((F.col("kind") == 3) & ~F.col("covered")))
    each = each.withColumn("reported", F.coalesce(F.col("strong") | weak, F.lit(False)))
    free = F.coalesce(F.max(F.when(F.col("reported"), F.col("end"))).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    span = F.when(F.col("reported"), F.struct("start", "kind", "end", _name(F.col("kind")).alias("name"), free.alias("free"), "links"))
    each = each.select(*doc, "copies", span.alias("span"))
    return each.groupBy(*doc).agg(F.first("copies").alias("copies"), F.sort_array(F.collect_list("span")).alias("spans"))


def _text(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["name"], s["start"], s["end"])), ",")


def _linked(spans: Column) -> Column:
    def of_span(s: Column) -> Column:
        return F.transform(s["links"], lambda p: F.concat(F.concat_ws(":", s["name"], s["start"], s["end"]), F.lit(">"), F.concat_ws(":", _name(p["kind"]), p["start"], p["end"])))

    return F.array_join(F.flatten(F.transform(spans, of_span)), ",")


def scan(docs: DataFrame, scope: int = SCOPE) -> DataFrame:
    """``doc_id``, counts, digest, spans and links of every row.

    ``links`` lists ``span>part`` for each reported span and each part that it
    is linked to, in order.  Null and empty texts have no spans; repeated rows are repeated; null ids
    keep their row; an empty table gives an empty one; other columns are
    ignored whatever their names.
    """
    base = F.filter("spans", lambda s: s["kind"] < len(BASE))
    found = find(docs, scope=scope).withColumn("base", base)
    counts = [F.size(F.filter("base", _of_kind(n))).cast("long").alias(f"n_{k}") for n, k in enumerate(BASE)]
    return found.select(
        F.col("id").alias("doc_id"), *counts, F.sha2(_text(F.col("base")), 256).alias("base_sha256"), _text(F.col("spans")).alias("spans"), _linked(F.col("spans")).alias("links"), F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy")
    ).drop("copy")


def redact(docs: DataFrame, mark: str = "[redacted]", id_col: str = "doc_id", text_col: str = "text", scope: int = SCOPE) -> DataFrame:
    """The same rows and columns, each reported span of the text replaced by ``mark``, overlapping ones by one mark; texts without spans, nulls too, stay as they are."""
    found = find(docs, id_col, text_col, scope).filter(F.size("spans") > 0)
    # Written, so that its size is known and the planner decides whether it may be broadcast.
    hits = cut(found.select("id", "text_key", "text_size", F.transform("spans", lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["free"].alias("free"))).alias("spans")), "spans")
    rows = docs.select(F.struct(*docs.columns).alias("row"))  # as one column, so that no name clashes
    text = F.col("row")[text_col]
    body = F.coalesce(text, F.lit(""))
    same = F.col("row")[id_col].eqNullSafe(F.col("id")) & (F.xxhash64(body) == F.col("text_key")) & (F.octet_length(body) == F.col("text_size"))
    joined = rows.join(hits, same, "left")

    def before(s: Column) -> Column:
        """What lies between the spans before and this one, and its mark."""
        return F.concat(text.substr(s["free"].cast("int") + 1, (s["start"] - s["free"]).cast("int")), F.lit(mark))

    pieces = F.transform(F.filter("spans", lambda s: s["start"] >= s["free"]), before)
    rest = text.substr(F.array_max(F.transform("spans", lambda s: s["end"])).cast("int") + 1, F.length(text))
    cleaned = F.concat(F.array_join(pieces, ""), rest)
    return joined.select(*[F.when(F.col("text_key").isNotNull(), cleaned).otherwise(text).alias(c) if c == text_col else F.col("row")[c].alias(c) for c in docs.columns])


def oracle() -> str:
    """The scan over ``documents`` in DuckDB SQL."""

    def lit(s: str) -> str:
        return "'" + s.replace("'", "''") + "'"

    kinds = " UNION ALL ".join(
        f"SELECT r, {n} AS kind, unnest(range(1, len(m) + 1)) AS i, unnest(m) AS m, unnest(v) AS v, unnest(g[1:len(m)]) AS g "
        f"FROM (SELECT r, regexp_extract_all(body, {lit(p)}, 0) AS m, regexp_extract_all(body, {lit(p)}, {group}) AS v, regexp_split_to_array(body, {lit(p)}) AS g FROM d)"
        for n, (_, p, group, _) in enumerate(KINDS)
    )
    least = " ".join(f"WHEN {n} THEN {x}" for n, (*_, x) in enumerate(KINDS))
    names = "[" + ", ".join(lit(k) for k, *_ in KINDS) + "]"
    order = "OVER (PARTITION BY r ORDER BY s, kind, e ROWS BETWEEN"
    part, past, ahead = "{'s': s, 'kind': kind, 'e': e}", f"{order} UNBOUNDED PRECEDING AND CURRENT ROW)", f"{order} CURRENT ROW AND UNBOUNDED FOLLOWING)"
    frames = {"strong": f"max(CASE WHEN kind IN (0, 1, 2) THEN e END) {past}"}
    for what, ks in (("access", "1"), ("secret", "0, 1")):
        frames[f"b_{what}"] = f"max(CASE WHEN kind IN ({ks}) THEN {{'at': e, 'p': {part}}} END) {past}"
        frames[f"a_{what}"] = f"min(CASE WHEN kind IN ({ks}) THEN {{'at': s, 'p': {part}}} END) {ahead}"
    near = {w: (f"CASE WHEN s - b_{w}.at <= {SCOPE} THEN b_{w}.p END", f"CASE WHEN a_{w}.at - e <= {SCOPE} THEN a_{w}.p END") for w in ("access", "secret")}
    sides = {w: f"[x FOR x IN CASE WHEN ({b}) IS NOT DISTINCT FROM ({a}) THEN [{b}] ELSE [{b}, {a}] END IF x IS NOT NULL]" for w, (b, a) in near.items()}
    joined = f"string_agg(({names})[kind + 1] || ':' || s || ':' || e, ',' ORDER BY s, kind, e)"
    linked = f"string_agg(array_to_string([({names})[kind + 1] || ':' || s || ':' || e || '>' || ({names})[p.kind + 1] || ':' || p.s || ':' || p.e FOR p IN links], ','), ',' ORDER BY s, kind, e) FILTER (len(links) > 0)"
    return f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS body FROM documents),
m AS ({kinds}),
p AS (SELECT r, kind, sum(length(g) + length(m)) OVER (PARTITION BY r, kind ORDER BY i) AS e, length(m) AS n, length(v) >= CASE kind {least} END AS ok FROM m),
q AS (SELECT r, kind, CAST(e - n AS BIGINT) AS s, CAST(e AS BIGINT) AS e FROM p WHERE ok),
w AS (SELECT *, {', '.join(f'{x} AS {k}' for k, x in frames.items())} FROM q),
l AS (SELECT r, kind, s, e, strong, CASE WHEN kind IN (0, 3) THEN {sides['access']} WHEN kind = 4 THEN {sides['secret']} ELSE [] END AS links FROM w),
k AS (SELECT * FROM l WHERE kind < 3 OR (len(links) > 0 AND (kind = 4 OR NOT coalesce(strong >= e, false)))),
a AS (SELECT r, count(*) FILTER (kind = 0) AS n0, count(*) FILTER (kind = 1) AS n1, count(*) FILTER (kind = 2) AS n2,
 {joined} FILTER (kind < 3) AS base, {joined} AS spans, {linked} AS links FROM k GROUP BY r)
SELECT doc_id, coalesce(n0, 0) AS n_assign, coalesce(n1, 0) AS n_access, coalesce(n2, 0) AS n_hex, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans, coalesce(links, '') AS links
FROM d LEFT JOIN a USING (r)
"""
