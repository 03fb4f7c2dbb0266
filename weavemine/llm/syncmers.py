"""Operator 1: document fingerprints of closed syncmers.

The text is read as words (runs without ASCII white space, cut after 16 code
points so that unspaced text is read too). A k-mer of five words is chosen if
the least of its inner two-word substrings, in the order of their MD5, is its
first or its last. The choice depends on the k-mer alone, so equal passages
yield equal anchors wherever they stand; about two of four k-mers are chosen,
and any window of six words holds one. The fingerprint lists the anchors in
text order, eight hex digits each; likeness is the Jaccard similarity of two
fingerprints' anchor sets.

Only DataFrame functions are used. Pairing a document with the next one takes
one shuffle of the texts, by blocks of 64 consecutive ids; only the last row of
a block looks beyond it, through a list of blocks that is linked up by a range
partitioning of the block numbers. No order is taken over all rows in one task.

Defined results: null text is the empty text, which has no anchors and an empty
fingerprint; a text of fewer than five words is one k-mer; likeness is 1 if
both sets are empty and 0 if one is; rows with equal ids stand in the order of
a hash of their text; null ids come after all others (in one block); a single
row is its own next; an empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from weavemine.session import materialize, table

NAME = "op1_closed_syncmers"
K, S = 5, 2
WORD = r"[^\x20\x09-\x0D]{1,16}"
BLOCK = 64


def words(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(WORD), F.lit(0))


def _tail(c: Column, drop: int, less: int) -> Column:
    """The array without its first ``drop`` elements and ``less`` shorter in all."""
    return F.slice(c, F.lit(drop + 1), F.greatest(F.size(c) - less, F.lit(0)))


def with_anchors(df: DataFrame, text: str, out: str) -> DataFrame:
    """``df`` with the anchors of a text column: array of (pos, hash), in text order.

    The steps are columns of their own, so that none is evaluated once per element of the next.
    """
    t, h, p = f"_{out}_t", f"_{out}_h", f"_{out}_p"
    df = df.withColumn(t, words(F.col(text)))
    df = df.withColumn(h, F.zip_with(_tail(F.col(t), 0, 1), _tail(F.col(t), 1, 1), lambda a, b: F.md5(F.concat_ws(" ", a, b))))
    df = df.withColumn(p, F.zip_with(_tail(F.col(h), 0, 1), _tail(F.col(h), 1, 1), lambda a, b: F.least(a, b)))
    least = F.zip_with(_tail(F.col(p), 0, 2), _tail(F.col(p), 2, 2), lambda a, b: F.least(a, b))  # over the four inner substrings of a k-mer

    def anchor(m: Column, i: Column) -> Column:
        at = [F.get(F.col(t), i + j) for j in range(K)]
        edge = (m == F.get(F.col(h), i)) | (m == F.get(F.col(h), i + (K - S)))
        return F.when(edge, F.struct(i.alias("pos"), F.substring(F.md5(F.concat_ws(" ", *at)), 1, 8).alias("hash")))

    chosen = F.filter(F.transform(least, anchor), lambda x: x.isNotNull())
    whole = F.array(F.struct(F.lit(0).alias("pos"), F.substring(F.md5(F.array_join(F.col(t), " ")), 1, 8).alias("hash")))
    empty = F.slice(whole, 1, 0)
    df = df.withColumn(out, F.when(F.size(t) >= K, chosen).when(F.size(t) > 0, whole).otherwise(empty))
    return df.drop(t, h, p)


def fingerprint(anchors: Column) -> Column:
    return F.array_join(anchors["hash"], "")


def likeness(a: Column, b: Column) -> Column:
    """Jaccard similarity of two arrays of distinct hashes."""
    both = F.size(F.array_intersect(a, b))
    either = F.size(a) + F.size(b) - both
    return F.when(either == 0, 1.0).otherwise(both / F.greatest(either, F.lit(1)))


def edited_text(text: Column, following: Column) -> Column:
    n = F.char_length(text)
    cut = F.floor(n / 3).cast("int")
    return F.concat(F.substring(text, F.lit(1), n - cut), F.substring(following, F.lit(1), cut))


def next_blocks(blocks: DataFrame) -> DataFrame:
    """(block, next): each block's follower in descending order, null last; the last is followed by the first."""
    ranged = blocks.distinct().repartitionByRange(F.col("block").desc_nulls_last())
    placed = materialize(ranged.select("block", F.spark_partition_id().alias("part")), "syncmer-blocks")
    inside = Window.partitionBy("part").orderBy(F.col("block").desc_nulls_last())
    follower = F.struct("block")
    linked = placed.withColumn("next", F.lead(follower).over(inside))
    firsts = placed.groupBy("part").agg(F.min(F.struct(F.col("block").isNull().alias("none"), (-F.col("block")).alias("back"))).alias("x"))  # one row for each partition
    firsts = firsts.select("part", F.struct((-F.col("x.back")).alias("block")).alias("first"))
    ring = Window.orderBy("part")
    wrap = F.first("first").over(ring.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    after = firsts.select("part", F.coalesce(F.lead("first").over(ring), wrap).alias("after"))
    return linked.join(after, "part").select("block", F.coalesce("next", "after")["block"].alias("next"))


def with_next(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Two frames that together hold each row once with its follower (text and hash set): inside blocks, and across their ends.

    Columns: doc_id, text, anchors, set (distinct hashes), next_text, next_set.
    """
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("block", F.floor(F.col("doc_id") / BLOCK).cast("long"))
    links = materialize(next_blocks(rows.select("block")), "syncmer-links")
    order = Window.partitionBy("block").orderBy(F.col("doc_id").desc_nulls_last(), F.xxhash64("text"), "text")
    placed = rows.withColumn("first", F.row_number().over(order) == 1).withColumn("last", F.lead(F.lit(1)).over(order).isNull())

    def fingerprinted(df: DataFrame) -> DataFrame:
        return with_anchors(df, "text", "anchors").withColumn("set", F.array_distinct(F.col("anchors")["hash"]))

    inside = fingerprinted(placed)
    inside = inside.withColumn("next_text", F.lead("text").over(order)).withColumn("next_set", F.lead("set").over(order)).where("NOT last")
    first = fingerprinted(placed.where("first").select("block", "text")).select(F.col("block").alias("_b"), F.col("text").alias("next_text"), F.col("set").alias("next_set"))
    ends = placed.where("last").select("doc_id", "text", "block")
    ends = ends.join(links.withColumnRenamed("block", "_k"), F.col("block").eqNullSafe(F.col("_k")))
    ends = fingerprinted(ends.join(first, F.col("next").eqNullSafe(F.col("_b"))))
    names = ["doc_id", "text", "anchors", "set", "next_text", "next_set"]
    return inside.select(names), ends.select(names)


def compare_edits(pairs: DataFrame) -> DataFrame:
    edited = pairs.withColumn("edited", edited_text(F.col("text"), F.col("next_text")))
    both = with_anchors(edited, "edited", "edited_anchors").withColumn("edited_set", F.array_distinct(F.col("edited_anchors")["hash"]))
    return both.select(
        "doc_id",
        F.char_length("text").cast("long").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"),
        fingerprint(F.col("anchors")).alias("fingerprint"),
        fingerprint(F.col("edited_anchors")).alias("edited_fingerprint"),
        likeness(F.col("set"), F.col("edited_set")).alias("near_edited"),
        likeness(F.col("set"), F.col("next_set")).alias("near_next"),
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    inside, ends = with_next(table(spark, sf_dir, "documents"))
    return compare_edits(inside).unionByName(compare_edits(ends))


def _sql_anchors(text: str) -> str:
    return f"""(SELECT CASE WHEN len(t) >= 5 THEN list_transform(list_filter(range(1, len(t) - 3),
        lambda i: least(h[i], h[i+1], h[i+2], h[i+3]) = h[i] OR least(h[i], h[i+1], h[i+2], h[i+3]) = h[i+3]),
        lambda i: md5(t[i] || ' ' || t[i+1] || ' ' || t[i+2] || ' ' || t[i+3] || ' ' || t[i+4])[1:8])
      WHEN len(t) > 0 THEN [md5(array_to_string(t, ' '))[1:8]] ELSE [] END
      FROM (SELECT t, list_transform(range(1, len(t)), lambda i: md5(t[i] || ' ' || t[i+1])) AS h
            FROM (SELECT regexp_extract_all({text}, '[^\\x20\\x09-\\x0D]{{1,16}}') AS t)))"""


_NEAR = """CASE WHEN len({0}) = 0 AND len({1}) = 0 THEN 1.0::DOUBLE ELSE len(list_intersect(list_distinct({0}), list_distinct({1})))::DOUBLE
  / greatest(1, len(list_distinct({0})) + len(list_distinct({1})) - len(list_intersect(list_distinct({0}), list_distinct({1})))) END"""

SQL = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
n AS (SELECT *, coalesce(lead(text) OVER (ORDER BY doc_id DESC), first_value(text) OVER (ORDER BY doc_id DESC)) AS following FROM d),
e AS (SELECT *, text[1:length(text) - length(text) // 3] || CASE WHEN length(text) // 3 > 0 THEN following[1:length(text) // 3] ELSE '' END AS edited FROM n),
f AS (SELECT doc_id, text, edited, following, {_sql_anchors('e.text')} AS a, {_sql_anchors('e.edited')} AS b, {_sql_anchors('e.following')} AS c FROM e)
SELECT doc_id, CAST(length(text) AS BIGINT) AS n_chars, sha256(edited) AS edited_sha256, array_to_string(a, '') AS fingerprint,
  array_to_string(b, '') AS edited_fingerprint, {_NEAR.format('a', 'b')} AS near_edited, {_NEAR.format('a', 'c')} AS near_next
FROM f
"""
