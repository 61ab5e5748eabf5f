"""Mixing sources to target weights by Sainte-Lague apportionment.

Sizes are words.  Targets share all words by weight, no source above
``most`` times its own size.  Blocks of equal size are apportioned to sources
by the highest quotients target / (2 k + 1), then each source's blocks to groups
of its shards and each group's to its shards by the same rule.  Inside a shard the documents stand in a seeded
order on a ring; the shard takes its quota of blocks from a seeded block on,
round and round.  Built-in functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut

WORDS = r"[^\x20\x09-\x0D]+"
BLOCK_WORDS = 16
SHARD_ROWS = 1024
#: Shards that share a group's blocks, so that no window holds all shards of a source.
GROUP_SHARDS = 1024
MOST = 3
SEED = "mix"


def _number(text: Column) -> Column:
    """The first 28 bits of a text's md5."""
    return F.conv(F.substring(F.md5(text), 1, 7), 16, 10).cast("long")


def targets(sources: DataFrame, most: int = MOST) -> DataFrame:
    """Adds ``target`` to one row per source (``source, source_size``; a dimension, not the documents).

    Weights 1, 2, 3 repeat over the sources by code point, null last.  With
    caps c and weights w the shares are min(c, t w) for the one t that uses
    all words; sources reach their cap in the order of c / w.
    """
    ordered = Window.orderBy(F.col("source").isNull(), "source")
    named = sources.withColumn("rank", F.row_number().over(ordered)).withColumn("weight", ((F.col("rank") - 1) % 3 + 1).cast("double"))
    named = named.withColumn("cap", F.col("source_size").cast("double") * most)
    by_ratio = Window.orderBy(F.col("cap") / F.col("weight"), "rank")
    upto = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    from_here = by_ratio.rowsBetween(0, Window.unboundedFollowing)
    total = F.sum("source_size").over(Window.partitionBy())
    level = named.withColumn("level", (total.cast("double") - F.coalesce(F.sum("cap").over(upto), F.lit(0.0))) / F.sum("weight").over(from_here))
    # The first source in this order that its level does not fill decides.
    open_ = level.withColumn("is_open", F.col("level") <= F.col("cap") / F.col("weight"))
    share = F.min(F.when(F.col("is_open"), F.struct(F.col("cap") / F.col("weight"), "rank", "level"))).over(Window.partitionBy())["level"]
    return open_.withColumn("target", F.coalesce(F.least("cap", share * F.col("weight")), F.col("cap"))).select("source", "rank", "source_size", "n_docs", "target")


def apportion(claims: DataFrame, group: list[str], key: str, claim: str, seats: str) -> DataFrame:
    """Adds ``quota``: of a group's ``seats`` each row gets those with the highest quotients claim / (2 k + 1); ties by ``key``.

    Quotas of the method differ from claim / d by a half at most, for a
    divisor d that their sum bounds; only quotients inside these bounds are
    listed and ranked, about three a row.
    """
    whole = Window.partitionBy(*group)
    n, total = F.count("*").over(whole), F.sum(claim).over(whole)
    bounded = claims.withColumn("_n", n.cast("double")).withColumn("_total", total.cast("double"))
    low = F.when(F.col(seats) > F.col("_n") / 2, F.floor(F.col(claim) * (F.col(seats) - F.col("_n") / 2) / F.col("_total") - 0.5)).otherwise(F.lit(0))
    high = F.ceil(F.col(claim) * (F.col(seats) + F.col("_n") / 2) / F.col("_total") + 0.5)
    some = (F.col("_total") > 0) & (F.col(claim) > 0) & (F.col(seats) > 0)
    bounded = bounded.withColumn("_low", F.when(some, F.greatest(low, F.lit(0))).otherwise(F.lit(0)).cast("long")).withColumn("_high", F.when(some, high).otherwise(F.lit(0)).cast("long"))
    rest = bounded.withColumn("_rest", F.col(seats) - F.sum("_low").over(whole))
    listed = rest.filter(F.col("_high") > F.col("_low")).select(*group, key, "_rest", F.explode(F.sequence("_low", F.col("_high") - 1)).alias("_k"), (F.col(claim).cast("double")).alias("_claim"))
    ranked = listed.withColumn("_at", F.row_number().over(Window.partitionBy(*group).orderBy(F.desc(F.col("_claim") / (2 * F.col("_k") + 1)), key)))
    won = ranked.filter(F.col("_at") <= F.col("_rest")).groupBy(*group, key).agg(F.count("*").alias("_won"))
    on = rest.alias("a").join(won.alias("b"), [F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in (*group, key)], "left")
    return on.select(*[F.col(f"a.{c}").alias(c) for c in claims.columns], (F.col("a._low") + F.coalesce("b._won", F.lit(0))).alias("quota"))


def mix(docs: DataFrame, keep: tuple[str, ...] = (), block_words: int = BLOCK_WORDS, shard_rows: int = SHARD_ROWS, most: int = MOST, seed: str = SEED) -> DataFrame:
    """``doc_id, size, source_size, target, taken`` of every row, with how it is taken, and the columns ``keep`` (as one struct, ``kept``).

    ``passes``: times the whole text is taken; ``head`` words from its start
    and ``tail_from`` to its end are taken once more.  Null texts have size 0
    and are not taken; a very long text is one document of its ring; a null
    source is a source; repeated rows stand and are taken one by one (equal
    rows, also in id and text, share a shard); ties of quotients go to the
    lesser key; an empty table gives an empty one.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    base = docs.select(
        F.col("doc_id").alias("doc_id"), F.col("source").alias("source"), F.regexp_count(text, F.lit(WORDS)).cast("long").alias("size"),
        # By id and text, so that rows of one id, null ids too, are dealt over shards.
        F.md5(F.concat_ws(":", F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.md5(text))).alias("order1"), F.md5(text).alias("order2"),
        *([F.struct(*keep).alias("kept")] if keep else []),
    )
    slim = base.select("doc_id", "source", "size", "order1", "order2") if keep else cut(base, "sizes")
    base = base if keep else slim
    sources = cut(targets(slim.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n_docs")), most), "targets")
    blocks = F.floor(F.sum("source_size").over(Window.partitionBy()) / block_words).cast("long")
    quotas = apportion(sources.withColumn("_one", F.lit(1)).withColumn("seats", blocks), ["_one"], "rank", "target", "seats")
    quotas = cut(quotas.select("source", "rank", "source_size", "target", F.col("quota").alias("source_quota"), (F.floor(F.col("n_docs") / shard_rows) + 1).cast("long").alias("shards")), "quotas")

    def sharded(rows: DataFrame) -> DataFrame:
        of = rows.withColumnRenamed("source", "_src").join(quotas, F.col("_src").eqNullSafe(F.col("source"))).drop("_src")
        return of.withColumn("shard", F.conv(F.substring("order1", 1, 7), 16, 10).cast("long") % F.col("shards"))

    shards = sharded(slim.select("source", "size", "order1")).groupBy("rank", "shard").agg(F.sum("size").alias("words"), F.first("source_quota").alias("source_quota"))
    shards = shards.withColumn("grp", F.floor(F.col("shard") / GROUP_SHARDS))
    groups = shards.groupBy("rank", "grp").agg(F.sum("words").alias("words"), F.first("source_quota").alias("source_quota"))
    groups = apportion(groups, ["rank"], "grp", "words", "source_quota").select("rank", "grp", F.col("quota").alias("group_quota"))
    dealt = apportion(shards.join(groups, ["rank", "grp"]), ["rank", "grp"], "shard", "words", "group_quota")
    dealt = cut(dealt.select(F.col("rank").alias("_rank"), F.col("shard").alias("_shard"), "words", F.least(F.col("quota"), F.floor(F.col("words") * most / block_words)).alias("quota")), "shards")
    rows = sharded(base)
    rows = rows.join(dealt, (F.col("rank") == F.col("_rank")) & (F.col("shard") == F.col("_shard")))
    ring = Window.partitionBy("rank", "shard").orderBy("order1", "order2", "size").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("b", F.sum("size").over(ring)).withColumn("a", F.col("b") - F.col("size"))
    take = F.col("quota") * block_words
    some = F.greatest("words", F.lit(1))
    first = (_number(F.concat_ws(":", F.lit(seed), "rank", "shard")) % F.ceil(some / block_words)) * block_words
    rows = rows.withColumn("passes", F.floor(take / some).cast("long")).withColumn("more", take % some).withColumn("at", first)
    past = F.least(F.col("at") + F.col("more"), F.col("words"))
    rows = rows.withColumn("over", F.col("at") + F.col("more") - past)  # goes on from the ring's start

    def overlap(lo: Column, hi: Column) -> tuple[Column, Column]:
        return F.greatest(F.col("a"), lo) - F.col("a"), F.greatest(F.least(F.col("b"), hi) - F.greatest(F.col("a"), lo), F.lit(0))

    tail_from, tail = overlap(F.col("at"), past)
    _, head = overlap(F.lit(0), F.col("over"))
    rows = rows.select("*", head.alias("head"), tail_from.alias("tail_from"), tail.alias("tail"))
    taken = (F.col("passes") * F.col("size") + F.col("head") + F.col("tail")).alias("taken")
    return rows.select("doc_id", "size", "source_size", "target", taken, "passes", "head", "tail_from", "tail", *(["kept"] if keep else []))


def mix_sizes(docs: DataFrame) -> DataFrame:
    return mix(docs).select("doc_id", "size", "source_size", "target", "taken")


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The mix as documents, in the columns of ``docs``: a row for each whole pass and one for the words taken once more, space-joined; ``n_chars`` follows the text."""
    columns = docs.columns
    rows = mix(docs, keep=tuple(columns), **options)
    words = F.regexp_extract_all(F.col("kept.text"), F.lit(WORDS), F.lit(0))
    head = F.slice(words, 1, F.col("head").cast("int"))
    tail = F.slice(words, F.col("tail_from").cast("int") + 1, F.col("tail").cast("int"))
    # Where the ring's end falls inside a document both parts are taken, in text order.
    part = F.when(F.col("head") + F.col("tail") > 0, F.when(F.col("head") + F.col("tail") == F.col("size"), F.col("kept.text")).otherwise(F.array_join(F.concat(head, tail), " ")))
    texts = F.concat(F.when(F.col("passes") > 0, F.array_repeat("kept.text", F.col("passes").cast("int"))).otherwise(F.array().cast("array<string>")), F.when(part.isNotNull(), F.array(part)).otherwise(F.array().cast("array<string>")))
    each = rows.filter("taken > 0").select("kept", F.explode(texts).alias("mixed"))
    return each.select(*[F.col("mixed").alias(c) if c == "text" else F.length("mixed").cast(docs.schema[c].dataType).alias(c) if c == "n_chars" else F.col("kept")[c].alias(c) for c in columns])


def oracle() -> str:
    """``mix_sizes`` over ``documents`` in DuckDB SQL."""

    def seats(source: str, group: str, key: str, claim: str, total: str) -> str:
        return f"""
{source}_b AS (SELECT *, count(*) OVER w * 1.0::DOUBLE AS n_, CAST(sum({claim}) OVER w AS DOUBLE) AS t_ FROM {source} WINDOW w AS (PARTITION BY {group})),
{source}_c AS (SELECT *, CASE WHEN t_ > 0 AND {claim} > 0 AND {total} > 0 THEN greatest(0, CASE WHEN {total} > n_ / 2 THEN floor({claim} * ({total} - n_ / 2) / t_ - 0.5) ELSE 0 END) ELSE 0 END::BIGINT AS lo_,
 CASE WHEN t_ > 0 AND {claim} > 0 AND {total} > 0 THEN ceil({claim} * ({total} + n_ / 2) / t_ + 0.5) ELSE 0 END::BIGINT AS hi_ FROM {source}_b),
{source}_d AS (SELECT *, {total} - sum(lo_) OVER (PARTITION BY {group}) AS rest_ FROM {source}_c),
{source}_e AS (SELECT {group}, {key}, rest_, {claim}::DOUBLE AS claim_, unnest(range(lo_, hi_)) AS k_ FROM {source}_d WHERE hi_ > lo_),
{source}_f AS (SELECT *, row_number() OVER (PARTITION BY {group} ORDER BY claim_ / (2 * k_ + 1) DESC, {key}) AS at_ FROM {source}_e),
{source}_q AS (SELECT d.*, d.lo_ + coalesce(f.won_, 0) AS quota FROM {source}_d d LEFT JOIN (SELECT {group} AS g_, {key} AS y_, count(*) AS won_ FROM {source}_f WHERE at_ <= rest_ GROUP BY 1, 2) f ON d.{group} = f.g_ AND d.{key} = f.y_)"""

    return f"""
WITH d AS (SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '{WORDS}')) AS BIGINT) AS size, md5('{SEED}:' || coalesce(CAST(doc_id AS VARCHAR), '') || ':' || md5(coalesce(text, ''))) AS order1, md5(coalesce(text, '')) AS order2 FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size, count(*) AS n_docs FROM d GROUP BY source),
r AS (SELECT *, row_number() OVER (ORDER BY source IS NULL, source COLLATE "C") AS rank FROM s),
c AS (SELECT *, ((rank - 1) % 3 + 1)::DOUBLE AS weight, source_size::DOUBLE * {MOST} AS cap FROM r),
l AS (SELECT *, (CAST(sum(source_size) OVER () AS DOUBLE) - coalesce(sum(cap) OVER (ORDER BY cap / weight, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) / sum(weight) OVER (ORDER BY cap / weight, rank ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM c),
u AS (SELECT *, first_value(CASE WHEN level <= cap / weight THEN level END IGNORE NULLS) OVER (ORDER BY cap / weight, rank ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS share FROM l),
src AS (SELECT 1 AS one, source, rank, source_size, n_docs, coalesce(least(cap, share * weight), cap) AS target, CAST(floor(sum(source_size) OVER () / {BLOCK_WORDS}) AS BIGINT) AS seats FROM u),
{seats('src', 'one', 'rank', 'target', 'seats').strip()},
e AS (SELECT d.*, q.rank, q.source_size, q.target, q.quota AS source_quota, CAST('0x' || substr(order1, 1, 7) AS BIGINT) % (n_docs // {SHARD_ROWS} + 1) AS shard FROM d JOIN src_q q ON d.source IS NOT DISTINCT FROM q.source),
sh AS (SELECT rank, shard, rank * 1048576 + shard // {GROUP_SHARDS} AS gid, CAST(sum(size) AS BIGINT) AS words, first(source_quota) AS source_quota FROM e GROUP BY rank, shard),
gr AS (SELECT rank, gid, CAST(sum(words) AS BIGINT) AS words, first(source_quota) AS source_quota FROM sh GROUP BY rank, gid),
{seats('gr', 'rank', 'gid', 'words', 'source_quota').strip()},
sg AS (SELECT sh.rank, sh.shard, sh.gid, sh.words, gr_q.quota AS group_quota FROM sh JOIN gr_q ON sh.gid = gr_q.gid),
{seats('sg', 'gid', 'shard', 'words', 'group_quota').strip()},
f AS (SELECT e.*, q.words, least(q.quota, q.words * {MOST} // {BLOCK_WORDS}) * {BLOCK_WORDS} AS take, greatest(q.words, 1) AS whole_ FROM e JOIN sg_q q ON e.rank = q.rank AND e.shard = q.shard),
g AS (SELECT *, CAST(sum(size) OVER (PARTITION BY rank, shard ORDER BY order1, order2, size ROWS UNBOUNDED PRECEDING) AS BIGINT) AS b, take // whole_ AS passes, take % whole_ AS more,
 (CAST('0x' || substr(md5('{SEED}:' || rank || ':' || shard), 1, 7) AS BIGINT) % CAST(ceil(whole_ / {BLOCK_WORDS}) AS BIGINT)) * {BLOCK_WORDS} AS at_ FROM f),
h AS (SELECT *, b - size AS a, least(at_ + more, words) AS past FROM g)
SELECT doc_id, size, source_size, target, CAST(passes * size + greatest(0, least(b, past) - greatest(a, at_)) + greatest(0, least(b, at_ + more - past) - a) AS BIGINT) AS taken FROM h
"""
