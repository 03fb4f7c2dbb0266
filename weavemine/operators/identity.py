"""What collections share: identifier indexes, copies, overlaps, versions and lineage."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weavemine.operators.tiles import shared_counts
from weavemine.session import materialize


def identifier_index(postings: DataFrame, term: str, *place: str) -> DataFrame:
    """(term, places): terms found at two places or more."""
    found = postings.groupBy(term).agg(F.countDistinct(*place).alias("places"))
    return found.where("places >= 2")


def shared_items(items: DataFrame) -> DataFrame:
    """(token_a, key_a, token_b, key_b, by) of copies in different models; ``items`` has (token, key, rid, kind_name).

    An element key that is equal comes before a requirement id that is unique in
    both models, and that before a kind and name that is unique in both; each
    unordered pair of items is reported once, by the first that holds.
    """

    def by(column: str, label: str, unique: bool) -> DataFrame:
        rows = items.where(F.col(column).isNotNull()).select("token", "key", column)
        if unique:
            n = F.count("*").over(Window.partitionBy("token", column))
            rows = rows.withColumn("_n", n).where("_n = 1").drop("_n")
        a = rows.toDF("token_a", "key_a", column)
        b = rows.toDF("token_b", "key_b", column)
        return a.join(b, column).where("token_a < token_b").select("token_a", "key_a", "token_b", "key_b", F.lit(label).alias("by"))

    ways = [by("key", "1 element", False), by("rid", "2 requirement", True), by("kind_name", "3 name", True)]
    every = ways[0].unionByName(ways[1]).unionByName(ways[2])
    return every.groupBy("token_a", "key_a", "token_b", "key_b").agg(F.min("by").alias("by"))


def overlaps(ids: DataFrame, model: str, id_: str) -> DataFrame:
    """(a, b, shared, cover, jaccard) of models with an id in common, counted in tiles; disjoint pairs never meet."""
    sized = shared_counts(ids, model, id_)
    return sized.select(
        "a", "b", "shared",
        (F.col("shared") / F.least("na", "nb")).alias("cover"),
        (F.col("shared") / (F.col("na") + F.col("nb") - F.col("shared"))).alias("jaccard"),
    )


def version_class(shared: Column, cover: Column, jaccard: Column) -> Column:
    version = (jaccard >= 0.5) | ((cover >= 0.8) & (shared >= 50))
    return F.when(version, "version").when((cover >= 0.2) & (shared >= 20), "related").otherwise("none")


def tfidf_pairs(docs: DataFrame) -> DataFrame:
    """(a, b, sim) of documents of different families by TF-IDF cosine through an inverted index; ``docs`` has (id, family, word), a row a token.

    Words held by more than half of the documents or by one family only are left out.
    """
    tf = docs.groupBy("id", "family", "word").agg(F.count("*").alias("tf"))
    n = docs.select("id").distinct().agg(F.count("*").alias("n"))
    df = tf.groupBy("word").agg(F.count("*").alias("df"), F.countDistinct("family").alias("families")).crossJoin(n)
    df = df.where("df <= n / 2 AND families > 1")
    w = tf.join(df, "word").select("id", "family", "word", ((1 + F.log("tf")) * F.log(F.col("n") / F.col("df"))).alias("w"))
    norm = w.groupBy("id").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
    unit = w.join(norm, "id").select("id", "family", "word", (F.col("w") / F.col("norm")).alias("w"))
    a, b = unit.toDF("a", "fa", "word", "wa"), unit.toDF("b", "fb", "word", "wb")
    return a.join(b, "word").where("a < b AND fa <> fb").groupBy("a", "b").agg(F.sum(F.col("wa") * F.col("wb")).alias("sim"))


def nearest(pairs: DataFrame, k: int = 5) -> DataFrame:
    """(a, b, sim) kept where either end has the other among its k nearest (similarity, then id)."""
    both = pairs.select("a", "b", "sim").unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b"), "sim"))
    order = Window.partitionBy("a").orderBy(F.col("sim").desc(), "b")
    near = both.withColumn("r", F.row_number().over(order)).where(F.col("r") <= k)
    return near.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), "sim").distinct()


def distinctive_words(tokens: DataFrame, group: str, n: int) -> DataFrame:
    """(group, word, score, rank): words by their rate inside the group less that outside; used twice inside at least."""
    inside = tokens.groupBy(group, "word").agg(F.count("*").alias("c"))
    sizes = tokens.groupBy(group).agg(F.count("*").alias("size"))
    total = tokens.groupBy("word").agg(F.count("*").alias("total"))
    everything = tokens.agg(F.count("*").alias("all"))
    rows = inside.join(sizes, group).join(total, "word").crossJoin(everything).where("c > 1")
    outside = F.when(F.col("all") > F.col("size"), (F.col("total") - F.col("c")) / F.nullif(F.col("all") - F.col("size"), F.lit(0))).otherwise(0.0)
    scored = rows.withColumn("score", F.round(F.col("c") / F.col("size") - outside, 9))
    order = Window.partitionBy(group).orderBy(F.col("score").desc(), "word")
    return scored.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n).select(group, "word", "score", "rank")


def snapshot_diff(before: DataFrame, after: DataFrame, key: Sequence[str], digest: str) -> DataFrame:
    """(key, change): added, removed, changed or same between two snapshots."""
    a = before.select(*key, F.col(digest).alias("_a"), F.lit(1).alias("_in_a"))
    b = after.select(*key, F.col(digest).alias("_b"), F.lit(1).alias("_in_b"))
    change = F.when(F.col("_in_a").isNull(), "added").when(F.col("_in_b").isNull(), "removed").when(F.col("_a").eqNullSafe(F.col("_b")), "same").otherwise("changed")
    return a.join(b, list(key), "full_outer").select(*key, change.alias("change"))


def majority(votes: DataFrame, voter: str, choice: str) -> DataFrame:
    """(voter, choice, votes): the most frequent choice, the lowest among equals."""
    n = votes.groupBy(voter, choice).agg(F.count("*").alias("votes"))
    order = Window.partitionBy(voter).orderBy(F.col("votes").desc(), choice)
    return n.withColumn("_r", F.row_number().over(order)).where("_r = 1").drop("_r")


#: A side is hardly changed with so many ids of its own, or so large a share; it has work of its own with at
#: least so many and so large a share.
UNCHANGED, WORKED = (2, 0.001), (20, 0.03)
#: Shares of a side's own ids that make it new (later than nearly all shared ones), by the other's makers (of a
#: branch, of a later version) or by makers that can be told at all; how alike a version is; and which shared day is late.
NEW, BRANCHED, CONTINUED, TOLD, ALIKE, LATE = 0.6, 0.6, 0.15, 0.3, 0.5, 0.95


class _Side:
    """What can be said of one model of a pair, by its columns' suffix."""

    def __init__(self, k: str):
        own, ids = F.col(f"own_{k}"), F.col(f"ids_{k}")
        self.k = k
        self.unchanged = own <= F.greatest(F.lit(UNCHANGED[0]), UNCHANGED[1] * ids)
        self.worked = (own >= WORKED[0]) & (own >= WORKED[1] * ids)
        self.new = F.col(f"after_{k}") >= NEW
        self.told = F.col(f"parsed_{k}") >= TOLD

    def shares(self, least: float) -> Column:
        """Whether the other side's makers made so much of it."""
        return F.col(f"same_{self.k}") >= least


def lineage(marks: DataFrame, saved: DataFrame, cover: float = 0.2, least: int = 20) -> DataFrame:
    """How related models came about: (older, newer, shared, own, parsed, same and after by side, kind).

    ``marks`` has (model, id, day, maker), an id once a model; ``saved`` (model,
    saved). The older model is the one saved first. Each side's own ids are
    compared with the late quantile of the shared ids' days and with the other
    side's makers.
    """
    s = saved.select(F.col("model").alias("m"), F.coalesce(F.col("saved").cast("string"), F.lit("")).alias("s"))
    pairs = overlaps(marks, "model", "id").where((F.col("cover") >= cover) & (F.col("shared") >= least))
    pairs = pairs.join(s.toDF("a", "sa"), "a").join(s.toDF("b", "sb"), "b")
    first = F.struct("sa", "a") <= F.struct("sb", "b")
    pairs = pairs.select(F.when(first, F.col("a")).otherwise(F.col("b")).alias("older"), F.when(first, F.col("b")).otherwise(F.col("a")).alias("newer"), "shared", "cover", "jaccard")
    pairs = materialize(pairs, "related")  # read three times below, and counted once
    ends = pairs.select("older", "newer", F.explode(F.array(F.struct(F.lit(0).alias("side"), F.col("older").alias("model"), F.col("newer").alias("other")), F.struct(F.lit(1).alias("side"), F.col("newer").alias("model"), F.col("older").alias("other")))).alias("x"))
    ends = ends.select("older", "newer", "x.*")
    marks = materialize(marks.join(ends.select("model").distinct(), "model", "left_semi"), "marks")
    held = ends.join(marks, "model").join(marks.select(F.col("model").alias("other"), "id", F.lit(True).alias("both")), ["other", "id"], "left")
    days = held.where("both AND side = 0 AND day IS NOT NULL").withColumn("r", F.row_number().over(Window.partitionBy("older", "newer").orderBy("day"))).withColumn("n", F.count("*").over(Window.partitionBy("older", "newer")))
    latest = days.where(F.col("r") == F.least("n", F.floor(F.lit(LATE) * F.col("n")) + 1)).select("older", "newer", F.col("day").alias("latest"))
    makers = marks.where("maker IS NOT NULL").select(F.col("model").alias("other"), "maker", F.lit(True).alias("known")).distinct()
    own = held.where("both IS NULL").join(makers, ["other", "maker"], "left").join(latest, ["older", "newer"], "left")
    rate = lambda c, k, none: F.coalesce(F.round(F.avg(F.when(F.col("side") == k, c.cast("int"))), 3), F.lit(none))
    aggs = []
    for k, side in enumerate("ab"):
        aggs += [
            F.count_if(F.col("side") == k).alias(f"own_{side}"),
            rate(F.col("maker").isNotNull(), k, 1.0).alias(f"parsed_{side}"),
            rate(F.when(F.col("maker").isNotNull(), F.col("known").isNotNull()), k, 0.0).alias(f"same_{side}"),
            rate(F.when(F.col("day").isNotNull(), F.coalesce(F.col("day") > F.col("latest"), F.lit(False))), k, 0.0).alias(f"after_{side}"),
        ]
    out = pairs.join(own.groupBy("older", "newer").agg(*aggs), ["older", "newer"], "left").fillna(0, ["own_a", "own_b"]).fillna(1.0, ["parsed_a", "parsed_b"]).fillna(0.0, ["same_a", "same_b", "after_a", "after_b"])
    sizes = marks.groupBy("model").agg(F.count("*").alias("ids"))
    out = out.join(sizes.toDF("older", "ids_a"), "older").join(sizes.toDF("newer", "ids_b"), "newer")
    older, newer = (_Side(k) for k in "ab")
    apart = older.worked & newer.worked & older.new & newer.new
    #: In order; the first that holds decides.
    rules = [
        ("copy", older.unchanged & newer.unchanged),
        ("version", newer.unchanged & (F.col("jaccard") >= ALIKE)),
        ("unknown", ~newer.told),
        ("unknown", apart & ~older.told),
        ("branches", apart & older.shares(BRANCHED) & newer.shares(BRANCHED)),
        ("root", apart),
        ("version", newer.new & ~older.new & newer.shares(CONTINUED)),
        ("derived", newer.new & ~older.new),
    ]
    kind = F.coalesce(*(F.when(holds, F.lit(name)) for name, holds in rules), F.lit("related"))
    return out.withColumn("kind", kind)
