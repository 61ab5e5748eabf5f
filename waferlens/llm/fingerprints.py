"""Canonical exact digests.

A text is normalised (Unicode NFC), case-folded, normalised again and its
white space folded; its fingerprint is a 128-bit xxhash of that canonical
form.  Documents are grouped by fingerprint and, inside groups of more than
one, compared byte by byte; should two canonical texts ever share a
fingerprint, a digest of the bytes is added to both.  Built-in functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, join_hot

#: 500,000 fingerprints of 32 characters take about 40 MB.
BROADCAST_ROWS = 500_000
_SPACES = r"[\x09-\x0D\x20\x85\xA0\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]+"


def canonical(text: Column) -> Column:
    """NFC, full case folding, NFC again, white space folded to single spaces and trimmed; ASCII texts, which need no normaliser, are only lower-cased."""

    def composed(c: Column) -> Column:
        return F.reflect(F.lit("com.ibm.icu.text.Normalizer"), F.lit("compose"), c, F.lit(False))

    folded = composed(F.reflect(F.lit("com.ibm.icu.lang.UCharacter"), F.lit("foldCase"), composed(text), F.lit(True)))
    plain = F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(folded)
    return F.trim(F.regexp_replace(plain, _SPACES, " "))


def digest(canon: Column) -> Column:
    """32 lowercase hex digits: two 64-bit xxhash values of differing seeds."""

    def word(h: Column) -> Column:
        return F.lpad(F.hex(h), 16, "0")

    return F.lower(F.concat(word(F.xxhash64(canon)), word(F.xxhash64(F.lit("wide"), canon))))


def clashes(docs: DataFrame, digests: DataFrame, text_col: str = "text", broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Fingerprints (``clash``, written) that more than one canonical text has.

    ``digests`` is a written table of ``fp`` and ``text_key`` (the text's
    xxhash64), one row per row of ``docs``.  Only texts of fingerprints that
    occur more than once are fetched and made canonical again; least and
    greatest of them, combined before the shuffle, are equal just when all
    are.  Their list is counted: up to ``broadcast_rows`` it is broadcast and
    texts are picked where they are read, beyond that both sides are shuffled.
    """
    # Copies of a text become one row before the join, so a large group of them is no frequent key.
    keyed = digests.groupBy("fp", "text_key").agg(F.count("*").alias("n"))
    repeated = keyed.groupBy("fp").agg(F.count("*").alias("rows"), F.sum("n").alias("n")).filter("n > 1").drop("n")
    wanted = cut(join_hot(keyed, repeated, "fp", "rows", ["text_key"], "left_semi").select("text_key").distinct(), "repeated")
    if wanted.limit(broadcast_rows + 1).count() <= broadcast_rows:
        wanted = F.broadcast(wanted)
    texts = docs.select(F.coalesce(F.col(text_col), F.lit("")).alias("body")).withColumn("text_key", F.xxhash64("body")).join(wanted, "text_key", "left_semi")
    texts = texts.select(canonical(F.col("body")).alias("canon")).select("canon", digest(F.col("canon")).alias("clash"))
    return cut(texts.groupBy("clash").agg(F.min("canon").alias("lo"), F.max("canon").alias("hi")).filter("lo <> hi").select("clash"), "clashes")


def told_apart(rows: DataFrame, clash: DataFrame, names: dict[str, str]) -> DataFrame:
    """``rows`` with a digest of the canonical text (column by fingerprint column in ``names``) added to fingerprints that clash.  Of 128-bit values next to none do, so their list is broadcast."""
    for fp, canon in names.items():
        rows = rows.join(F.broadcast(clash), F.col(fp) == F.col("clash"), "left")
        rows = rows.withColumn(fp, F.when(F.col("clash").isNotNull(), F.concat_ws("-", fp, F.sha2(canon, 256))).otherwise(F.col(fp))).drop("clash")
    return rows


def grouped(digests: DataFrame) -> DataFrame:
    """Adds ``group_id`` (smallest id of the fingerprint, null if it has none) and ``group_size`` to (``id``, ``fp``, ...)."""
    groups = digests.groupBy("fp").agg(F.min("id").alias("group_id"), F.count("*").alias("group_size"), F.count("*").alias("rows"))
    return join_hot(digests, groups, "fp", "rows", ["id", "text_key"])


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, fingerprint, group_id, group_size`` of every row; rows of one group have equal canonical bytes.

    Null texts are empty; very long ones are taken whole; null ids count for a
    group only if it has no other; repeated rows stay repeated; an empty table
    gives an empty one.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    slim = docs.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("text_key"), canonical(text).alias("canon")).withColumn("fp", digest(F.col("canon")))
    digests = cut(slim.select("id", "text_key", "fp"), "digests")
    clash = clashes(docs, digests, text_col)
    if not clash.isEmpty():
        digests = cut(told_apart(slim, clash, {"fp": "canon"}).select("id", "text_key", "fp"), "digests")
    return grouped(digests).select(F.col("id").alias(id_col), F.col("fp").alias("fingerprint"), "group_id", "group_size")


def with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, text_key, body, fp, next_body, next_fp``: every row with the text of the row after it by id (equal ids in the order of their texts' hashes), after the last the first.

    Ids are cut into as many ranges as there are shuffle partitions times
    four; whole texts move once, to their range, and the first row of a range
    goes to the range before it too.  An id that is as frequent as a whole
    range, null ids too, is cut further by its texts' hashes, so only equal
    rows must stay together.
    """
    spark = docs.sparkSession
    slim = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("body"))
    slim = slim.select("id", F.xxhash64("body").alias("h"), "body")
    parts = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    ids = docs.select(F.col(id_col).cast("long").alias("id"))
    # Nulls come first: they are cut as their own ranges.
    found = ids.agg(F.percentile_approx("id", [i / parts for i in range(1, parts)], 10_000), F.count("*"), F.count("id")).first()
    edges = [int(x) for x in found[0] or []]
    bounds = sorted(set(edges))
    step = max(1, int(len(bounds) ** 0.5))
    rows_of = [bounds[i : i + step] for i in range(0, len(bounds), step)]
    # How many further cuts an id has: as often as it is an edge, less one; nulls by their share.
    again = {b: edges.count(b) for b in bounds if edges.count(b) > 1} if len(bounds) < len(edges) else {}
    nulls = max(1, -(-(found[1] - found[2]) * parts // max(1, found[1])))

    def below(values: list[int] | Column) -> Column:
        array = F.array(*map(F.lit, values)) if isinstance(values, list) else values
        return F.size(F.filter(array, lambda b: b <= F.col("id")))

    if bounds:
        # Two short searches: first among each row's least bound, then in that row.
        table = F.array(*[F.array(*map(F.lit, r)) for r in rows_of])
        row = below([r[0] for r in rows_of])
        place = F.when(F.col("id").isNull(), F.lit(-1)).when(row == 0, F.lit(0)).otherwise((row - 1) * step + below(F.element_at(table, F.greatest(row, F.lit(1)))))
    else:
        place = F.when(F.col("id").isNull(), F.lit(-1)).otherwise(F.lit(0))
    pieces = F.when(F.col("id").isNull(), F.lit(nulls))
    if again:
        pieces = pieces.when(F.col("id").isin(*again), F.element_at(F.create_map(*[F.lit(x) for pair in again.items() for x in pair]), F.col("id")))
    # The hash as a fraction of its range, so that pieces are in its order; rows behind a repeated id stay behind its last piece.
    share = F.floor((F.col("h") / F.lit(2.0**64) + 0.5) * F.coalesce(pieces, F.lit(1))).cast("int")
    behind = F.lit(parts + 1) if not again else F.when(F.col("id").isin(*again), 0).otherwise(parts + 1)
    nth = F.when(pieces.isNotNull(), F.least(share, pieces - 1)).otherwise(behind)
    slim = slim.withColumn("bucket", F.struct(place.cast("int").alias("place"), nth.cast("int").alias("nth")))
    order = F.struct(F.col("id").isNotNull().alias("known"), "id", "h")
    firsts = slim.groupBy("bucket").agg(F.min(order).alias("f"))
    prior = F.coalesce(F.lag("bucket").over(Window.orderBy("bucket")), F.max("bucket").over(Window.partitionBy()))
    # One row a range, about as many as there are shuffle partitions times eight: the bound of the broadcast.
    firsts = F.broadcast(cut(firsts.select("bucket", F.col("f.id").alias("first_id"), F.col("f.h").alias("first_h"), prior.alias("prior")), "ranges"))
    own = F.struct(F.col("bucket").alias("range"), F.lit(0).alias("is_copy"))
    is_first = F.col("id").eqNullSafe(F.col("first_id")) & (F.col("h") == F.col("first_h"))
    places = F.when(is_first, F.array(own, F.struct(F.col("prior").alias("range"), F.lit(1).alias("is_copy")))).otherwise(F.array(own))
    slim = slim.join(firsts, "bucket")
    dealt = slim.select("id", "h", "body", F.explode(places).alias("place")).select("id", "h", "body", "place.range", "place.is_copy").repartition("range")
    dealt = dealt.withColumn("fp", digest(canonical(F.col("body"))))
    after = Window.partitionBy("range").orderBy("is_copy", F.col("id").asc_nulls_first(), "h")
    rows = dealt.select("id", F.col("h").alias("text_key"), "body", "fp", "is_copy", F.lead("body").over(after).alias("next_body"), F.lead("fp").over(after).alias("next_fp"))
    return rows.filter("is_copy = 0").select("id", "text_key", "body", "fp", F.coalesce("next_body", "body").alias("next_body"), F.coalesce("next_fp", "fp").alias("next_fp"))


def edited_fingerprints(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text and of its edited text, with likenesses: 1 where canonical bytes agree, else 0.

    The edited text ends, for its last quarter, with the start of the next
    document.  Null texts are empty; very long ones are taken whole; equal ids
    follow each other by their texts' hashes; repeated rows stay; one row
    alone is its own next; an empty table gives an empty one; other columns
    are ignored.
    """
    texts = with_next(docs)
    n = F.length("body")
    cut_at = (n - F.floor(n / 4)).cast("int")
    edited = F.concat(F.col("body").substr(F.lit(1), cut_at), F.col("next_body").substr(F.lit(1), n - cut_at))
    rows = texts.select("id", "text_key", "body", "fp", "next_body", "next_fp", n.cast("long").alias("n_chars"), edited.alias("edited"))
    rows = rows.select("*", canonical(F.col("edited")).alias("c_edited"))
    rows = rows.select("*", digest(F.col("c_edited")).alias("edited_fp"))

    def likeness(a: str, b: str, x: Column, y: Column) -> Column:
        """Bytes are compared only where fingerprints agree."""
        return F.when(F.col(a) == F.col(b), (x == y).cast("double")).otherwise(F.lit(0.0))

    body = canonical(F.col("body"))
    near = [likeness("fp", "edited_fp", body, F.col("c_edited")).alias("near_edited"), likeness("fp", "next_fp", body, canonical(F.col("next_body"))).alias("near_next")]
    slim = cut(rows.select("id", "text_key", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), "fp", "edited_fp", *near), "edited")
    clash = clashes(docs, slim)
    if not clash.isEmpty():
        again = told_apart(rows.withColumn("c", body), clash, {"fp": "c", "edited_fp": "c_edited"})
        slim = cut(again.select("id", "text_key", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), "fp", "edited_fp", *near), "edited")
    return grouped(slim).select(
        F.col("id").alias("doc_id"), "n_chars", "edited_sha256", F.col("fp").alias("fingerprint"), F.col("edited_fp").alias("edited_fingerprint"), "near_edited", "near_next", "group_id", "group_size"
    )
