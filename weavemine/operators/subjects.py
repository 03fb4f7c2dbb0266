"""Subjects of a collection: how many groups, what joins them, how groups are described and measured, and what changes them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weavemine.operators.identity import nearest, tfidf_pairs
from weavemine.operators.ranges import running
from weavemine.operators.tiles import shared_counts


def target_groups(n: Column) -> Column:
    """About the square root of half as many groups as things, 2 to 15; halves go to the even."""
    return F.greatest(F.lit(2), F.least(F.lit(15), F.bround(F.sqrt(n / 2)))).cast("int")


def placed_answers(answers: DataFrame, groups: int) -> DataFrame:
    """(key, group): answers that number a group from 1 as groups from 0, all others null, unsorted."""
    g = F.expr("try_cast(answer AS int)") - 1
    return answers.select("key", F.when((g >= 0) & (g < groups), g).alias("group"))


def shared_elements(shows: DataFrame) -> DataFrame:
    """(a, b, shared): of subjects of different families, the elements both show over the fewer that either shows; ``shows`` has (id, family, element)."""
    return shared_counts(shows, "id", "element", "family").select("a", "b", (F.col("shared") / F.least("na", "nb")).alias("shared"))


def subject_graph(words: DataFrame, shows: DataFrame, near: int = 5, weight: float = 1.0) -> DataFrame:
    """(a, b, weight): each subject's nearest by words, and all it shares elements with; weights are both together."""
    sim = tfidf_pairs(words)
    links = shared_elements(shows)
    keep = nearest(sim, near).select("a", "b").unionByName(links.select("a", "b")).distinct()
    out = keep.join(sim, ["a", "b"], "left").join(links, ["a", "b"], "left")
    return out.select("a", "b", (F.coalesce("sim", F.lit(0.0)) + weight * F.coalesce("shared", F.lit(0.0))).alias("weight")).where("weight > 0")


def diagram_graph(shows: DataFrame, context: DataFrame, related: DataFrame) -> DataFrame:
    """(a, b, weight): diagrams joined by elements they share, rarer ones more, by half by the owners of these, and by relations between what they show.

    ``shows`` and ``context`` have (diagram, feature), ``related`` (source, target).
    """
    n = shows.select("diagram").union(context.select("diagram")).distinct().agg(F.count("*").alias("n"))

    def rarity(df: DataFrame) -> DataFrame:
        return df.distinct().groupBy("feature").agg(F.count("*").alias("k")).crossJoin(n).select("feature", F.log(F.col("n") / F.col("k")).alias("idf"))

    def pairs(df: DataFrame, scale: float) -> DataFrame:
        f = df.distinct().join(rarity(df).where("idf > 0"), "feature")
        return f.toDF("feature", "a", "idf").join(f.select("feature", F.col("diagram").alias("b")), "feature").where("a < b").select("a", "b", (scale * F.col("idf")).alias("w"))

    s = shows.distinct().join(rarity(shows), "feature")
    left = related.join(s.select(F.col("feature").alias("source"), F.col("diagram").alias("x"), F.col("idf").alias("i")), "source")
    both = left.join(s.select(F.col("feature").alias("target"), F.col("diagram").alias("y"), F.col("idf").alias("j")), "target").where("x <> y")
    tied = both.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"), (0.5 * F.least("i", "j")).alias("w"))
    every = pairs(shows, 1.0).unionByName(pairs(context, 0.5)).unionByName(tied)
    return every.groupBy("a", "b").agg(F.sum("w").alias("weight")).where("weight > 0")


def random_split(items: DataFrame, key: str, k: int, seed: int = 1) -> DataFrame:
    """(key, group): the baseline, items dealt to k groups in an order that a seed gives."""
    dealt = running(items.withColumn("_drawn", F.xxhash64(F.lit(seed), F.col(key))), ["_drawn", key], before="_k")
    return dealt.select(key, (F.col("_k") % k).cast("int").alias("group"))


def common_package(items: DataFrame, group: str, package: str = "package") -> DataFrame:
    """(group, label): the last two levels of the package path that all of a group share."""
    from weavemine.functions.text import shared_levels

    ends = items.groupBy(group).agg(F.min(F.split(package, "::")).alias("a"), F.max(F.split(package, "::")).alias("b"))
    lead = F.slice("a", F.lit(1), shared_levels(F.array_join("a", "::"), F.array_join("b", "::")))
    label = F.array_join(F.slice(lead, F.greatest(F.size(lead) - 1, F.lit(1)), 2), "::")
    return ends.select(group, F.when(label == "", "(the model's root)").otherwise(label).alias("label"))


def view_groups(split: DataFrame) -> DataFrame:
    """(group, pos, size, members): a view's groups, the largest first."""
    g = split.groupBy("group").agg(F.count("*").alias("size"), F.array_sort(F.collect_list("key")).alias("members"))
    return g.withColumn("pos", F.row_number().over(Window.orderBy(F.desc("size"), "group"))).select("group", "pos", "size", "members")


def topic_measures(members: DataFrame) -> DataFrame:
    """(topics, largest, across, families_per_topic) of (topic, subject, family)."""
    t = members.groupBy("topic").agg(F.countDistinct("subject").alias("n"), F.countDistinct("family").alias("f"))
    total = F.sum("n")
    return t.agg(F.count("*").alias("topics"), F.round(F.max("n") / total, 6).alias("largest"), F.round(F.sum(F.when(F.col("f") > 1, F.col("n")).otherwise(0)) / total, 6).alias("across"), F.round(F.avg("f"), 6).alias("families_per_topic"))


def standing_of(found: Column, complete: Column, asked: Column) -> Column:
    return F.when(found & complete, "found").when(found, "incomplete").when(asked, "failed").otherwise("not asked")


def default_view(views: DataFrame, limit: float = 0.05) -> DataFrame:
    """(family, view): a family's suggested view: the first in order with few unsorted, else the shared one; packages for small families. ``views`` has (family, items, view, pos, unsorted)."""
    few = F.min(F.when((F.col("unsorted") / F.col("items")) <= limit, F.struct("pos", "view")))
    return views.groupBy("family").agg(F.max("items").alias("n"), few.alias("best")).select("family", F.when(F.col("n") < 8, "packages").otherwise(F.coalesce("best.view", F.lit("shared"))).alias("view"))


def signature(rows: DataFrame, group: str, *parts: str) -> DataFrame:
    """(group, signature): 16 hex digits of a group's rows in order; it changes when any of them does."""
    line = F.concat_ws("\0", *[F.coalesce(F.col(p).cast("string"), F.lit("")) for p in parts])
    return rows.groupBy(group).agg(F.substring(F.sha2(F.array_join(F.array_sort(F.collect_list(line)), "\1"), 256), 1, 16).alias("signature"))


def carried_forward(now: DataFrame, before: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Of (family, signature): the records before (family, signature, record) that still hold, and the families to work out again."""
    return before.join(now, ["family", "signature"], "left_semi"), now.join(before.select("family", "signature"), ["family", "signature"], "left_anti")


# --- trials -------------------------------------------------------------------------------------


def paired_difference(trials: DataFrame) -> DataFrame:
    """(n, difference, se) of (id, first, later): the mean change and its standard error."""
    d = F.col("later") - F.col("first")
    return trials.agg(F.count(d).alias("n"), F.avg(d).alias("difference"), (F.coalesce(F.stddev_samp(d), F.lit(0.0)) / F.sqrt(F.count(d))).alias("se"))


def clearly_better(difference: Column, se: Column, gain: float = 0.05) -> Column:
    return F.coalesce((difference >= gain) & (difference > 2 * se), F.lit(False))


def thin_groups(results: DataFrame, *group: str) -> DataFrame:
    """Groups that lost more than half of their cards unanswered."""
    return results.groupBy(*group).agg(F.count_if(F.col("asked")).alias("asked"), F.count("*").alias("n")).where("asked * 2 < n")


def rates(results: DataFrame, stratum: str) -> DataFrame:
    """(stratum, n, names, found, invented): shares by stratum, and of all where it is null; null where there is nothing to share."""
    share = lambda a, b: F.round(F.try_divide(F.sum(a), F.sum(b)), 6)
    return results.groupingSets([[F.col(stratum)], []], F.col(stratum)).agg(F.count("*").alias("n"), share("read", "words").alias("names"), share("found", "links").alias("found"), share("invented", "given").alias("invented"))


def reading_threshold(points: DataFrame, group: str, passing: float = 0.9) -> DataFrame:
    """(group, threshold): the size at which a non-decreasing fit of shares reaches ``passing``, between the sizes on both sides; null where it never does.

    ``points`` has (group, size, share), one row a size. The fit is the largest, over
    beginnings up to a size, of the least mean up to an end from it on.
    """
    p = points.select(group, "size", "share")
    w = Window.partitionBy(group).orderBy("size")
    p = p.withColumn("k", F.row_number().over(w)).withColumn("sum", F.sum("share").over(w))
    a = p.select(group, F.col("k").alias("ka"), (F.col("sum") - F.col("share")).alias("sa"))
    b = p.select(group, F.col("k").alias("kb"), F.col("sum").alias("sb"))
    means = a.join(b, group).where("ka <= kb").withColumn("mean", (F.col("sb") - F.col("sa")) / (F.col("kb") - F.col("ka") + 1))  # levels of one group, few by nature
    fit = p.join(means, group).where("ka <= k AND kb >= k").groupBy(group, "k", "size", "ka").agg(F.min("mean").alias("low")).groupBy(group, "k", "size").agg(F.max("low").alias("fit"))
    o = Window.partitionBy(group).orderBy("k")
    f = fit.withColumns({"s0": F.lag("size").over(o), "f0": F.lag("fit").over(o)}).where(F.round(F.col("fit"), 12) >= passing)
    first = f.groupBy(group).agg(F.min_by(F.struct("size", "fit", "s0", "f0"), "k").alias("x"))
    between = F.col("x.s0") + (passing - F.col("x.f0")) / (F.col("x.fit") - F.col("x.f0")) * (F.col("x.size") - F.col("x.s0"))
    at = first.select(group, F.when(F.col("x.s0").isNull(), F.col("x.size").cast("double")).otherwise(F.round(between, 2)).alias("threshold"))
    return points.select(group).distinct().join(at, group, "left")
