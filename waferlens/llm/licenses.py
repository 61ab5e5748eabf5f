"""License detection by ordered signature rules.

Texts become sequences of words.  A rule is a regular expression over wrapped
words (each word has a space on both sides), a keyword without which it is not
tried, a label and a priority.  Signatures of license bodies and notices are
written by hand (``signatures``); names are found by four forms of mention.  Of overlapping detections, one that lies
within another of the same or a better priority is suppressed, by running
maxima over sorted intervals.  Built-in functions only.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import lru_cache

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .signatures import signatures

WORD = r"[0-9A-Za-z\x{80}-\x{10FFFF}]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: The contract's phrases: keyword, words, label.  They are never suppressed.
BASE = (("cc", "cc by", "cc-by"), ("general", "general public license", "gpl"), ("reserved", "all rights reserved", "reserved"))
#: label: (keywords, names).  Names are words; a bar separates forms, and keywords where no word is in all forms: each form has rules under the first that it contains.
FAMILIES = {
    "afl": ("academic", "academic free"), "agpl": ("affero", "gnu affero general public|affero general public|affero gpl"), "agpl-short": ("agpl|agplv3", "agpl|agplv3"),
    "apache": ("apache", "apache|apache software"), "apple-psl": ("apple", "apple public source"), "artistic": ("artistic", "artistic"), "beerware": ("beerware|beer", "beerware|beer ware"),
    "bittorrent": ("bittorrent", "bittorrent open source"), "boost": ("boost", "boost software"), "bsd": ("bsd", "bsd|new bsd|simplified bsd|modified bsd|bsd 2 clause|bsd 3 clause|bsd 4 clause"),
    "cc": ("creative", "creative commons|creative commons attribution"), "cc-by-nc": ("nc", "cc by nc|cc by nc sa|cc by nc nd"), "cc-by-nd": ("nd", "cc by nd"), "cc-by-sa": ("sa", "cc by sa"),
    "cc0": ("cc0", "cc0"), "cddl": ("cddl", "cddl"), "cddl-long": ("distribution", "common development and distribution"), "cecill": ("cecill", "cecill"), "cpl": ("common", "common public"),
    "ecl": ("educational", "educational community"), "ecos": ("ecos", "ecos"), "eiffel": ("eiffel", "eiffel forum"), "epl": ("eclipse", "eclipse public|eclipse distribution"), "epl-short": ("epl", "epl"),
    "eupl": ("eupl", "eupl"), "eupl-long": ("european", "european union public"), "fdl": ("fdl|gfdl", "gfdl|gnu fdl"), "fdl-long": ("documentation", "gnu free documentation|free documentation"),
    "gpl": ("general", "gnu general public|general public"), "gpl-short": ("gpl", "gpl|gnu gpl"), "gplv2": ("gplv2", "gplv2"), "gplv3": ("gplv3", "gplv3"), "hpnd": ("historical", "historical permission notice and disclaimer"),
    "ibm": ("ibm", "ibm public"), "icu": ("icu", "icu"), "ijg": ("jpeg", "independent jpeg group"), "intel": ("intel", "intel open source"), "isc": ("isc", "isc"), "lgpl": ("lesser", "gnu lesser general public|lesser general public"),
    "lgpl-library": ("library", "gnu library general public|library general public"), "lgpl-short": ("lgpl", "lgpl|gnu lgpl"), "lppl": ("latex", "latex project public"), "mit": ("mit", "mit|mit x11"),
    "mpl": ("mozilla", "mozilla public"), "mpl-short": ("mpl", "mpl"), "ms-pl": ("microsoft", "microsoft public|microsoft reciprocal"), "mulan": ("mulan", "mulan permissive software|mulan psl"), "ncsa": ("ncsa", "ncsa|university of illinois ncsa"),
    "odbl": ("odbl", "odbl"), "ofl": ("ofl", "ofl|sil ofl"), "ofl-long": ("font", "sil open font|open font"), "openssl": ("openssl", "openssl"), "osl": ("osl", "osl"), "osl-long": ("open", "open software"), "php": ("php", "php"),
    "postgresql": ("postgresql", "postgresql"), "psf": ("python", "python software foundation|python"), "public-domain": ("domain", "public domain"), "qpl": ("qt", "qt public"), "ruby": ("ruby", "ruby"), "sissl": ("sun", "sun industry standards source"),
    "sleepycat": ("sleepycat", "sleepycat"), "unlicense": ("unlicense", "unlicense"), "upl": ("universal", "universal permissive"), "vim": ("vim", "vim"), "w3c": ("w3c", "w3c|w3c software"), "wtfpl": ("wtfpl", "wtfpl"),
    "x11": ("x11", "x11"), "zlib": ("zlib", "zlib|zlib libpng"), "zpl": ("zope", "zope public"),
}
#: Names that say enough without the word "license".
BARE = ("agpl-short", "cc", "cc-by-nc", "cc-by-nd", "cc-by-sa", "cc0", "cddl", "cddl-long", "eupl", "fdl", "gpl-short", "gplv2", "gplv3", "lgpl-short", "public-domain", "unlicense", "wtfpl")
WEIGHTS = (0.5, 1.0, 0.8, 0.5)  # by priority; 0 is a base phrase


def _wrapped(words: str) -> str:
    return "".join(f" {w} " for w in words.split())


def _families() -> list[tuple[str, str, list[str]]]:
    """(label, keyword, forms) such that every form contains its keyword."""
    found = []
    for label, (keywords, names) in FAMILIES.items():
        left = names.split("|")
        for k in keywords.split("|"):
            found.append((label, k, [f for f in left if k in f.split()]))
            left = [f for f in left if k not in f.split()]
        if left:
            raise ValueError(f"{label}: no keyword in {left}")
    return found


@lru_cache
def rules() -> tuple[tuple[str, str, str, int], ...]:
    """(keyword, pattern, label, priority), base phrases first, else in order of priority."""
    version = "(?: version )?(?: v?[0-9]+ ){0,2}"
    lead = "(?:" + "|".join(map(_wrapped, ("licensed under", "released under", "distributed under", "available under", "under the terms of", "subject to the terms of", "governed by"))) + ")"
    found = [(k, _wrapped(p), label, 0) for k, p, label in BASE]
    found += [(k, p, label, 1) for label, k, p in signatures()]
    for priority in (1, 2, 3):
        for label, keyword, forms in _families():
            name = "(?:" + "|".join(_wrapped(f) for f in sorted(forms, key=lambda f: -len(f))) + ")"
            if priority == 1:
                found += [(keyword, f"{lead}(?: the | a | an )?{name}(?: licen[cs]e )?{version}", label, 1), (keyword, f" spdx  licen[cs]e  identifier {name}{version}", label, 1)]
            elif priority == 2:
                found += [(keyword, f"{name}(?: licen[cs]e ){version}", label, 2), (keyword, f" licen[cs]e (?: is | type | the )?{name}{version}", label, 2)]
            elif label in BARE:
                found.append((keyword, f"{name}{version}", label, 3))
    return tuple(found)


def _hits(wrapped: Column, keywords: Column) -> Column:
    """For every rule whose keyword is there: rule number, place, words since its last match, words of the match."""
    table = F.array(*[F.struct(F.lit(n).alias("rule"), F.lit(k).alias("k"), F.lit(p).alias("p")) for n, (k, p, *_) in enumerate(rules())])

    def words(s: Column) -> Column:
        return ((F.length(s) - F.length(F.replace(s, F.lit(" "), F.lit("")))) / 2).cast("int")

    def matches(r: Column) -> Column:
        found = F.regexp_extract_all(wrapped, r["p"], F.lit(0))
        zipped = F.arrays_zip(found.alias("m"), F.slice(F.split(wrapped, r["p"], -1), 1, F.size(found)).alias("g"))
        return F.transform(zipped, lambda x, i: F.struct(r["rule"].alias("rule"), i.alias("i"), words(x["g"]).alias("gap"), words(x["m"]).alias("len")))

    tried = F.filter(table, lambda r: F.array_contains(keywords, r["k"]) & F.regexp_like(wrapped, r["p"]))
    return F.flatten(F.transform(tried, matches))


def _field(rule: Column, at: int) -> Column:
    return F.element_at(F.array(*[F.lit(r[at]) for r in rules()]), rule + 1)


def _of_priority(kind: int) -> Callable[[Column], Column]:
    return lambda h: h["priority"] == kind


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per distinct (id, text): ``id, text_key, copies, n_words, hits``; a hit is (start, end, rule, priority, label) in words, end exclusive, suppressed ones left out."""
    keywords = sorted({r[0] for r in rules()})
    slim = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("body"))
    # Lower case here only opens the gate and counts words, both the same for A-Z alone; the rules see A-Z lowered and nothing else.
    words = slim.select("id", "body", F.regexp_extract_all(F.lower("body"), F.lit(WORD), F.lit(0)).alias("words"))
    gated = words.select("id", "body", F.size("words").cast("long").alias("n_words"), F.array_intersect("words", F.array(*map(F.lit, keywords))).alias("found"))
    folded = F.regexp_extract_all(F.translate("body", _UPPER, _LOWER), F.lit(WORD), F.lit(0))
    wrapped = F.when(F.size("found") > 0, F.concat(F.lit(" "), F.array_join(folded, "  "), F.lit(" ")))
    rows = gated.select("id", F.xxhash64("body").alias("text_key"), "n_words", "found", wrapped.alias("wrapped"))
    none = F.array().cast("array<struct<rule:int,i:int,gap:int,len:int>>")
    rows = rows.select("id", "text_key", "n_words", F.when(F.size("found") > 0, _hits(F.col("wrapped"), F.col("found"))).otherwise(none).alias("parts"))
    doc = ("id", "text_key")
    rows = rows.groupBy(*doc).agg(F.count("*").alias("copies"), F.first("n_words").alias("n_words"), F.first("parts").alias("parts"))
    each = rows.select(*doc, "copies", "n_words", F.explode_outer("parts").alias("p")).select(*doc, "copies", "n_words", "p.*")
    run = Window.partitionBy(*doc, "rule").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    each = each.withColumn("end", F.sum(F.col("gap") + F.col("len")).over(run)).withColumn("start", F.col("end") - F.col("len")).withColumn("priority", _field(F.col("rule"), 3))
    order = Window.partitionBy(*doc).orderBy("start", F.desc("end"), "priority", "rule").rowsBetween(Window.unboundedPreceding, -1)
    each = each.select("*", *[F.max(F.when(F.col("priority").between(1, n), F.col("end"))).over(order).alias(f"reach{n}") for n in (1, 2, 3)])
    within = F.lit(False)
    for n in (1, 2, 3):
        within = within | ((F.col("priority") >= n) & F.coalesce(F.col(f"reach{n}") >= F.col("end"), F.lit(False)))
    hit = F.when(F.col("rule").isNotNull() & ((F.col("priority") == 0) | ~within), F.struct("start", "end", "rule", "priority", _field(F.col("rule"), 2).alias("label")))
    return each.groupBy(*doc).agg(F.first("copies").alias("copies"), F.first("n_words").alias("n_words"), F.sort_array(F.collect_list(hit)).alias("hits"))


def scan(docs: DataFrame) -> DataFrame:
    """``doc_id, n_words``, places and labels of the base phrases, all labels and a score of every row.

    Null and empty texts have no words; very long ones are scanned whole;
    repeated rows are repeated; null ids keep their row; of equal detections
    the rule listed first counts; an empty table gives an empty one; other
    columns are ignored whatever their names.
    """
    base = F.filter("hits", _of_priority(0))

    def labels(hits: Column) -> Column:
        return F.array_join(F.array_sort(F.array_distinct(F.transform(hits, lambda h: h["label"]))), ",")

    best = F.transform("hits", lambda h: F.element_at(F.array(*map(F.lit, WEIGHTS)), h["priority"] + 1))
    return find(docs).select(
        F.col("id").alias("doc_id"), "n_words", F.size(base).cast("long").alias("n_base"),
        F.array_min(F.transform(base, lambda h: h["start"])).cast("long").alias("first_word"), F.array_max(F.transform(base, lambda h: h["start"])).cast("long").alias("last_word"),
        labels(base).alias("base_labels"), labels(F.col("hits")).alias("labels"), F.coalesce(F.array_max(best), F.lit(0.0)).alias("score"),
        F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy"),
    ).drop("copy")


def oracle() -> str:
    """The scan over ``documents`` in DuckDB SQL."""
    values = ", ".join(f"({n}, '{k}', '{p}', '{label}', {q})" for n, (k, p, label, q) in enumerate(rules()))
    reach = ", ".join(
        f"max(CASE WHEN priority BETWEEN 1 AND {n} THEN e END) OVER (PARTITION BY r ORDER BY s, e DESC, priority, rule ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach{n}" for n in (1, 2, 3)
    )
    within = " OR ".join(f"(priority >= {n} AND coalesce(reach{n} >= e, false))" for n in (1, 2, 3))
    weight = " ".join(f"WHEN {n} THEN CAST({w} AS DOUBLE)" for n, w in enumerate(WEIGHTS))
    return f"""
WITH rules(rule, k, p, label, priority) AS (VALUES {values}),
d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '{WORD}') AS words FROM documents),
t AS (SELECT r, ' ' || array_to_string(words, '  ') || ' ' AS w, words FROM d WHERE len(words) > 0),
c AS (SELECT r, rule, label, priority, p, w FROM t, rules WHERE list_contains(words, k)),
m AS (SELECT r, rule, label, priority, unnest(range(1, len(x) + 1)) AS i, unnest(x) AS m, unnest(g[1:len(x)]) AS g FROM (SELECT r, rule, label, priority, regexp_extract_all(w, p) AS x, regexp_split_to_array(w, p) AS g FROM c)),
n AS (SELECT r, rule, label, priority, i, (length(m) - length(replace(m, ' ', ''))) // 2 AS n, (length(g) - length(replace(g, ' ', ''))) // 2 AS gap FROM m),
p AS (SELECT *, CAST(sum(gap + n) OVER (PARTITION BY r, rule ORDER BY i) AS BIGINT) AS e FROM n),
q AS (SELECT r, rule, label, priority, e - n AS s, e FROM p),
x AS (SELECT *, {reach} FROM q),
h AS (SELECT r, label, priority, s, CASE priority {weight} END AS score FROM x WHERE priority = 0 OR NOT ({within})),
a AS (SELECT r, count(*) FILTER (priority = 0) AS n_base, min(s) FILTER (priority = 0) AS first_word, max(s) FILTER (priority = 0) AS last_word,
 array_to_string(list_sort(list_distinct(list(label) FILTER (priority = 0))), ',') AS base_labels, array_to_string(list_sort(list_distinct(list(label))), ',') AS labels, max(score) AS score FROM h GROUP BY r)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word, coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, coalesce(score, 0.0) AS score
FROM d LEFT JOIN a USING (r)
"""
