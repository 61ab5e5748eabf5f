"""Quality rules: a table of thresholds compiled into one Spark projection.

Each rule bounds a ratio of two counts of a text (lengths, symbols, stop
words, lines, repeated words).  Counts and rules are built-in functions over
one row: there is no shuffle, no explode and no user function.  A text's
five-word windows are compared by hashes first; where two are equal, the
windows themselves are sorted, so that a long repetitive text takes time
by its length and nothing rests on a hash.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORD = r"[^\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"
NO_LETTERS = r"[\x00-\x40\x5B-\x60\x7B-\x7F]+"
WINDOW = 5
#: Frequent words of four languages; each counts once, in lower case or with a capital.
STOP_WORDS = (
    "the", "of", "and", "to", "a", "in", "is", "that", "it", "for", "with", "was",
    "der", "die", "und", "den", "von", "zu", "das", "mit", "ist", "nicht", "ein",
    "de", "la", "que", "el", "en", "y", "los", "se", "un", "las", "por", "con",
    "le", "et", "les", "des", "une", "du", "est", "pour", "qui", "dans",
)


class Rule(NamedTuple):
    """Fails where ``top`` / ``bottom`` is under ``least`` or over ``most`` percent; texts of fewer than ``from_words`` words are not tried."""

    name: str
    top: str
    bottom: str
    least: int | None
    most: int | None
    from_words: int = 0


#: The contract's own rules, then the method's.  Percentages are integers, so that no rounding decides.
BASE_RULES = (Rule("few_words", "n_words", "one", 1000, None), Rule("repeated_words", "n_repeat_words", "n_words", None, 20))
RULES = (
    Rule("short_words", "word_chars", "n_words", 200, None),
    Rule("long_words", "word_chars", "n_words", None, 2000),
    Rule("symbols", "n_symbols", "n_words", None, 25),
    Rule("shouting", "n_marks", "n_words", None, 60),
    Rule("capitals", "n_capitals", "word_chars", None, 60),
    Rule("letters", "n_letters", "word_chars", 60, None),
    Rule("stop_words", "n_stop_words", "one", 100, None, 60),
    Rule("duplicate_lines", "n_dup_lines", "n_lines", None, 30),
    Rule("list_lines", "n_list_lines", "n_lines", None, 90),
    Rule("cut_lines", "n_cut_lines", "n_lines", None, 30),
)
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_list_lines", "n_cut_lines", "n_stop_words", "n_marks", "n_capitals", "n_letters")


def _removed(text: Column, pattern: str) -> Column:
    """Code points in matches of a class."""
    return F.length(text) - F.length(F.regexp_replace(text, pattern, ""))


def _bound(value: Column, then) -> Column:
    """``then`` of a value that is computed once, however often it is used."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


def repeated_words(words: Column) -> Column:
    """Words of an array that stand in a five-word window that occurs twice or more."""

    def starts_of(w: Column) -> Column:
        return F.sequence(F.lit(0), F.size(w) - WINDOW)

    def hashed(w: Column) -> Column:
        return F.transform(starts_of(w), lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(WINDOW)]))

    def covered(w: Column) -> Column:
        placed = F.sort_array(F.transform(starts_of(w), lambda i: F.struct(F.array_join(F.slice(w, i + 1, WINDOW), " ").alias("w"), i.alias("i"))))

        def again(s: Column) -> Column:
            def equal(x: Column, j: Column) -> Column:
                before = F.when(j > 0, F.get(s, j - 1)["w"])
                return F.when(before.eqNullSafe(x["w"]) | F.get(s, j + 1)["w"].eqNullSafe(x["w"]), x["i"])

            return F.sort_array(F.array_compact(F.transform(s, equal)))

        def added(p: Column) -> Column:
            steps = F.transform(p, lambda x, j: F.least(F.lit(WINDOW), F.coalesce(F.get(p, j + 1) - x, F.lit(WINDOW))))
            return F.aggregate(steps, F.lit(0), lambda a, x: a + x)

        return _bound(placed, lambda s: _bound(again(s), added))

    some = _bound(hashed(words), lambda h: F.size(F.array_distinct(h)) < F.size(h))
    return F.when(F.size(words) <= WINDOW, 0).when(some, covered(words)).otherwise(0)


def _counts(text: Column, words: Column, lines: Column) -> dict[str, Column]:
    both = [f for w in STOP_WORDS for f in (w, w.capitalize())]
    return {
        "n_words": F.size(words), "word_chars": F.length(F.array_join(words, "")), "n_symbols": _removed(text, f"[{SYMBOLS}]"),
        "n_dup_lines": F.size(lines) - F.size(F.array_distinct(lines)), "n_repeat_words": repeated_words(words), "n_lines": F.size(lines),
        "n_list_lines": F.size(F.filter(lines, lambda x: F.ltrim(x).rlike("^[-*•]"))), "n_cut_lines": F.size(F.filter(lines, lambda x: x.rlike(r"(\.\.\.|…)[\x20\x09-\x0D]*$"))),
        "n_stop_words": F.size(F.array_intersect(words, F.array(*map(F.lit, dict.fromkeys(both))))), "n_marks": _removed(text, "[!?]"), "n_capitals": _removed(text, "[A-Z]"), "n_letters": F.length(F.regexp_replace(text, NO_LETTERS, "")),
    }


def _breaks(rule: Rule) -> str:
    """A condition that Spark and DuckDB read alike; a ratio over nothing breaks no rule."""
    sides = [f"100 * {rule.top} {sign} {limit} * {rule.bottom}" for sign, limit in (("<", rule.least), (">", rule.most)) if limit is not None]
    tried = f"n_words >= {rule.from_words} AND {rule.bottom} > 0"
    return f"({tried} AND ({' OR '.join(sides)}))".replace("one", "1")


def measure(docs: DataFrame, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns ``keep`` and all counts of every row."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    slim = docs.select(*keep, text.alias("_text"), F.regexp_extract_all(text, F.lit(WORD), F.lit(0)).alias("_words"), F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")).alias("_lines"))
    return slim.select(*keep, *[c.cast("long").alias(name) for name, c in _counts(F.col("_text"), F.col("_words"), F.col("_lines")).items()])


def judge(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``doc_id``, counts, ``base_failed``, ``kept`` and ``failed`` (names of the broken rules, comma-joined) of every row.

    Null and empty texts have no words and fail; very long texts are measured
    whole; repeated rows, ties and null ids keep their rows; an empty table
    gives an empty one; other columns are ignored whatever their names.
    """
    held = measure(docs)
    base = F.expr(" OR ".join(map(_breaks, BASE_RULES)))
    failed = F.array_join(F.array_compact(F.array(*[F.expr(f"CASE WHEN {_breaks(r)} THEN '{r.name}' END") for r in (*BASE_RULES, *rules)])), ",")
    return held.select("doc_id", *COUNTS, base.alias("base_failed"), failed.alias("failed")).select("doc_id", *COUNTS, "base_failed", (F.col("failed") == "").alias("kept"), "failed")


def oracle() -> str:
    """The same over ``documents`` in DuckDB SQL."""

    def removed(pattern: str) -> str:
        return f"length(t) - length(regexp_replace(t, '{pattern}', '', 'g'))"

    stop = ", ".join(f"'{f}'" for f in dict.fromkeys(f for w in STOP_WORDS for f in (w, w.capitalize())))
    failed = " || ".join(f"CASE WHEN {_breaks(r)} THEN ',{r.name}' ELSE '' END" for r in (*BASE_RULES, *RULES))
    return rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, regexp_extract_all(t, '{WORD}') AS words, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM d),
g AS (SELECT r, p, array_to_string(words[p + 1:p + {WINDOW}], ' ') AS g FROM (SELECT r, words, unnest(range(0, len(words) - {WINDOW - 1})) AS p FROM w)),
a AS (SELECT r, p FROM g QUALIFY count(*) OVER (PARTITION BY r, g) > 1),
n AS (SELECT r, count(DISTINCT p + o) AS n FROM a, range(0, {WINDOW}) AS s(o) GROUP BY r),
c AS (SELECT doc_id, len(words) AS n_words, {removed(WORD)} AS word_chars, {removed(f"[{SYMBOLS}]")} AS n_symbols, len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(n.n, 0) AS n_repeat_words, len(lines) AS n_lines,
 len(list_filter(lines, lambda x: regexp_matches(ltrim(x), '^[-*•]'))) AS n_list_lines, len(list_filter(lines, lambda x: regexp_matches(x, '(\.\.\.|…)[\x20\x09-\x0D]*$'))) AS n_cut_lines,
 len(list_distinct(list_filter(words, lambda x: x IN ({stop})))) AS n_stop_words, {removed("[!?]")} AS n_marks, {removed("[A-Z]")} AS n_capitals, length(regexp_replace(t, '{NO_LETTERS}', '', 'g')) AS n_letters
 FROM w LEFT JOIN n USING (r))
SELECT doc_id, {", ".join(f"CAST({c} AS BIGINT) AS {c}" for c in COUNTS)}, {" OR ".join(map(_breaks, BASE_RULES))} AS base_failed, failed = '' AS kept, ltrim(failed, ',') AS failed
FROM (SELECT *, {failed} AS failed FROM c)
"""
