"""Spelling variants by merging an errata trie.

The words of a corpus form a trie.  At every node the child with most words is
the heavy one; the others are light, and a word passes at most log2(words)
light edges.  Each light subtree is merged into what stands beside it with one
character wrong: its words with the light character replaced meet the words of
the heavy child and of the other light children, its words with that character
skipped meet those of the node itself, and with the heavy character put before
it those below the heavy child.  Where two terminals coincide, two words are
one edit apart.  An insertion into a run of equal characters counts at the
run's end alone, so every pair is found once and none is made twice.

A node is a prefix and a merged subtree a set of rows keyed by it, so tries,
sizes, merges and terminals are Spark aggregates and joins over words; no
subtree is held in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, join_hot

LEAST_LENGTH, LEAST_COUNT, FACTOR = 7, 2, 10
#: One in so many runs loses a character, as the contract says.
DAMAGED = 31
RUN = r"[A-Za-z\x{C0}-\x{FF}]"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Stands for a replaced character; no word holds it.
_ANY = "\u0000"


def vocabulary(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT, damaged: int | None = DAMAGED) -> DataFrame:
    """``word, n``: runs of letters in lower case (A-Z only), one in ``damaged`` without one character; those of the least length and count."""
    runs = docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("_id"), F.explode(F.regexp_extract_all(F.coalesce(F.col(text_col), F.lit("")), F.lit(f"{RUN}{{{least_length},}}"), F.lit(0))).alias("_run"))
    runs = runs.select("_id", F.translate("_run", _UPPER, _LOWER).alias("_run"))
    word = F.col("_run")
    if damaged:
        runs = runs.withColumn("_h", F.crc32(F.concat("_id", F.lit(":"), "_run")))
        at = (F.col("_h") % F.length("_run")).cast("int")
        cut_run = F.concat(F.substring("_run", F.lit(1), at), F.substring("_run", at + 2, F.length("_run")))
        word = F.when(F.col("_h") % damaged == 0, cut_run).otherwise(F.col("_run"))
    counted = runs.select(word.alias("word")).filter(F.length("word") >= least_length).groupBy("word").agg(F.count("*").alias("n"))
    return counted.filter(F.col("n") >= least_count)


def _upto(word: Column | str, d: Column) -> Column:
    return F.substring(word, F.lit(1), d)


def _after(word: Column | str, d: Column) -> Column:
    return F.substring(word, d + 1, F.length(word))


def heavy_paths(words: DataFrame) -> DataFrame:
    """``node, child, size, heavy``: every edge of the words' trie with the words below it and the node's heavy child."""
    below = words.select(F.explode(F.transform(F.sequence(F.lit(1), F.length("word")), lambda d: _upto("word", d))).alias("child")).groupBy("child").agg(F.count("*").alias("size"))
    edges = cut(below.select(_upto("child", F.length("child") - 1).alias("node"), "child", "size"), "edges_of_trie")
    # A node has at most as many children as there are letters; of equal sizes the first is heavy.
    heaviest = edges.groupBy("node").agg(F.min(F.struct(-F.col("size"), "child"))["child"].alias("heavy"))
    return edges.join(heaviest, "node")


def merged(words: DataFrame, edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Variants of light words: (``word, n, target``), words to be looked up, and (``word, n, key``), words of light siblings that differ in the replaced character."""
    light = edges.filter("child <> heavy").select("child", "size", F.substring("heavy", F.length("heavy"), F.lit(1)).alias("h"))
    passed = words.select("word", "n", F.explode(F.sequence(F.lit(1), F.length("word"))).alias("d")).select("word", "n", "d", _upto("word", F.col("d")).alias("child"))
    at = join_hot(passed, light, "child", "size", ["word"])
    d = F.col("d")
    at = cut(at.select("word", "n", "h", _upto("word", d - 1).alias("p"), F.substring("word", d, F.lit(1)).alias("a"), _after("word", d).alias("x")), "light")
    skipped = F.when(F.substring("x", 1, 1) != F.col("a"), F.concat("p", "x"))
    targets = at.select("word", "n", F.explode(F.array_compact(F.array(F.concat("p", "h", "x"), skipped, F.concat("p", "h", "a", "x")))).alias("target"))
    # A word that ends at a node is light there, too.
    own = words.join(edges.filter("child = heavy").select(F.col("node").alias("word"), F.col("child").alias("target")), "word").select("word", "n", "target")
    return targets.unionByName(own), at.select("word", "n", F.concat("p", F.lit(_ANY), "x").alias("key"))


def near_words(words: DataFrame) -> DataFrame:
    """``word, n_near, best``: how many words are one edit away, and of them (minus its count, word) of the most frequent; words without any are left out."""
    targets, siblings = merged(words, heavy_paths(words))
    found = targets.join(words.select(F.col("word").alias("target"), F.col("n").alias("target_n")), "target")
    found = found.select(F.explode(F.array(
        F.struct(F.col("word").alias("word"), F.lit(1).cast("long").alias("near"), F.struct((-F.col("target_n")).alias("m"), F.col("target").alias("w")).alias("best")),
        F.struct(F.col("target").alias("word"), F.lit(1).cast("long").alias("near"), F.struct((-F.col("n")).alias("m"), F.col("word").alias("w")).alias("best")),
    )).alias("e")).select("e.*")
    # Siblings have a letter each: a key has at most as many words as there are letters.
    alike = siblings.groupBy("key").agg(F.sort_array(F.collect_list(F.struct((-F.col("n")).alias("m"), F.col("word").alias("w")))).alias("all")).filter(F.size("all") > 1)
    others = F.transform("all", lambda x, i: F.struct(x["w"].alias("word"), (F.size("all") - 1).cast("long").alias("near"), F.when(i == 0, F.get("all", F.lit(1))).otherwise(F.get("all", F.lit(0))).alias("best")))
    return found.unionByName(alike.select(F.explode(others).alias("e")).select("e.*")).groupBy("word").agg(F.sum("near").alias("n_near"), F.min("best").alias("best"))


def roots(forms: DataFrame) -> DataFrame:
    """``word, root`` of (``word, form``) without cycles: forms are followed twice as far in every round, until none moves."""
    reached = cut(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        on = reached.select(F.col("word").alias("root"), F.col("root").alias("next"))
        further = cut(reached.join(on, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        reached = further.select("word", "root")
        # A form is ten times as frequent as its word: a path is as long as the largest count has digits, and rounds end.
        if further.filter("moved").isEmpty():
            return reached


def variants(docs: DataFrame, factor: int = FACTOR, **how) -> DataFrame:
    """``word, n, n_near, form, form_n, root`` of every word of (``doc_id, text``).

    A word's form is its near word of the largest count (of equal ones the
    first in code-point order) if that is at least ``factor`` times its own;
    the root is where forms end.  Null and empty texts have no words, very
    long ones are read whole; a null id counts as an empty one; repeated rows
    count as often as they occur; an empty table, or one without words, gives
    an empty one; other columns are ignored whatever their names.
    """
    words = cut(vocabulary(docs, **how), "vocabulary")
    near = words.join(near_words(words), "word", "left")
    form = F.when(-F.col("best.m") >= factor * F.col("n"), F.col("best.w"))
    held = cut(near.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), form.alias("form"), F.when(form.isNotNull(), -F.col("best.m")).alias("form_n")), "forms")
    return held.join(roots(held.filter("form is not null")), "word", "left").select("word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root"))
