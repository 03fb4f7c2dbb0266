"""Communities of a weighted graph: modularity moves in rounds, contraction, and groups brought within bounds.

``louvain`` is the two-phase scheme as rounds over tables. In a round every
community is, by a seeded draw, a giver or a receiver; each node of a giver looks
at the receivers among its neighbours' communities for the largest gain. Which of
these moves happen at once is settled by sums, not by an order over rows: nodes
of a community fall into slots of doubling size, and a node moves if its gain
would outweigh all that could have joined its target or left its community
before it. So modularity rises with every round by what is added up, a hub's
community is never one task, and the same seed gives the same groups on any
cluster. Once no node would gain by any move, communities become nodes.

Weights are whole numbers and gains are compared exactly, as decimals.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weavemine.operators.ranges import running
from weavemine.session import materialize, release

WHOLE = "decimal(38,0)"
SLOTS = 40


def _drawn(seed: int, level: int, turn: int, x: Column) -> Column:
    return F.xxhash64(*(F.lit(v).cast("long") for v in (seed, level, turn)), x)


def _symmetric(edges: DataFrame, parted: bool) -> DataFrame:
    """(u, v, w, part): both directions, loops once, repeated edges added up; edges without an end or weight dropped."""
    part = F.col("part") if parted else F.lit(0)
    e = edges.where("src IS NOT NULL AND dst IS NOT NULL AND weight > 0").select(F.least("src", "dst").alias("u"), F.greatest("src", "dst").alias("v"), F.col("weight").cast("long").alias("w"), part.alias("part"))
    e = e.groupBy("u", "v", "part").agg(F.sum("w").alias("w"))
    return e.where("w > 0").select("u", "v", "w", "part").unionByName(e.where("w > 0 AND u <> v").select(F.col("v").alias("u"), F.col("u").alias("v"), "w", "part"))


def _linked(adj: DataFrame, state: DataFrame) -> DataFrame:
    """(u, to, w): how strongly each node is joined to each community, itself left out."""
    at = state.select(F.col("node").alias("v"), F.col("group").alias("to"))
    return adj.where("u <> v").join(at, "v").groupBy("u", "to").agg(F.sum("w").alias("w"))


def _proposals(adj: DataFrame, state: DataFrame) -> DataFrame:
    """(node, k, a, b, score) of every move that would raise modularity; score is the gain times half the square of the graph's degree."""
    links = _linked(adj, state)
    sigma = state.groupBy("group").agg(F.sum("k").alias("sum"))
    own = state.join(links.select(F.col("u").alias("node"), F.col("to").alias("group"), F.col("w").alias("w_a")), ["node", "group"], "left")
    own = own.join(sigma.withColumnRenamed("sum", "s_a"), "group").select("node", "k", F.col("group").alias("a"), "m2", F.coalesce("w_a", F.lit(0)).alias("w_a"), "s_a")
    x = links.withColumnRenamed("u", "node").join(own, "node").where("to <> a").join(sigma.select(F.col("group").alias("to"), F.col("sum").alias("s_b")), "to")
    d = lambda c: F.col(c).cast("decimal(19,0)")
    score = (d("m2") * (d("w") - d("w_a"))).cast(WHOLE) - (d("k") * (d("s_b") - d("s_a") + d("k"))).cast(WHOLE)
    return x.select("node", "k", "a", F.col("to").alias("b"), score.cast(WHOLE).alias("score")).where("score > 0")


def _queue(moves: DataFrame, side: str) -> DataFrame:
    """Per community on that side its best move, and the degrees that its slots hold."""
    slots = moves.groupBy(side, "slot").agg(F.sum("k").alias("sum"), F.max("rank").alias("rank"))
    return slots.groupBy(side).agg(F.collect_list(F.struct("slot", "sum")).alias(f"slots_{side}"), F.max("rank").alias(f"best_{side}"))


def _ahead(side: str) -> Column:
    """What may move before a node on that side: its slot and the rarer ones, itself left out, and the best move."""
    best = F.col(f"best_{side}")
    held = F.aggregate(F.filter(f"slots_{side}", lambda s: s["slot"] <= F.col("slot")), F.lit(0).cast("long"), lambda acc, s: acc + s["sum"])
    return held - F.col("k") + F.when(best["slot"] > F.col("slot"), best["k"]).otherwise(F.lit(0))


def _accepted(moves: DataFrame, seed: int, level: int, turn: int) -> DataFrame:
    """(node, b) of the moves of one round."""
    receives = lambda c: F.pmod(_drawn(seed, level, turn, F.col(c)), F.lit(2)) == 1
    m = moves.where(receives("b") & ~receives("a")).groupBy("node").agg(F.max_by(F.struct("k", "a", "b", "score"), F.struct("score", F.xxhash64("b"))).alias("x")).select("node", "x.*")
    h = _drawn(seed, level, turn, F.col("node"))
    zeros = F.bit_count(h.bitwiseAND(-h) - 1)  # at the end
    m = m.withColumn("slot", SLOTS - F.least(zeros, F.lit(SLOTS))).withColumn("rank", F.struct("score", "node", "slot", "k"))
    x = m.join(_queue(m, "b"), "b").join(_queue(m, "a"), "a")
    first = (F.col("best_a.node") == F.col("node")) & (F.col("best_b.node") == F.col("node"))
    room = F.col("score") > (F.col("k").cast("decimal(19,0)") * (_ahead("a") + _ahead("b")).cast("decimal(19,0)")).cast(WHOLE)
    return x.where(first | room).select("node", "b")


def louvain(nodes: DataFrame, edges: DataFrame, seed: int = 1) -> DataFrame:
    """(node, community) of ``nodes`` (node) and ``edges`` (src, dst, weight): groups of locally largest modularity.

    A community goes by its least node. Edges may have a column ``part``: then
    each part, whose nodes no edge joins to another's, is a graph with a
    modularity of its own. Repeated nodes and edges are harmless; weights are
    rounded down to whole numbers and those below 1 dropped; a node without
    edges, or with a loop only, is alone; an edge to an unlisted node lists it.
    """
    adj = materialize(_symmetric(edges, "part" in edges.columns), "adj")
    degree = adj.groupBy(F.col("u").alias("node"), "part").agg(F.sum(F.when(F.col("u") == F.col("v"), 2 * F.col("w")).otherwise(F.col("w"))).alias("k"))
    whole = degree.groupBy("part").agg(F.sum("k").alias("m2"))
    state = materialize(degree.join(whole, "part").select("node", F.col("node").alias("group"), "k", "m2"), "state")
    members = materialize(state.select("node", "group"), "members")
    level = 0
    while True:
        turn = 0
        while True:
            moves = materialize(_proposals(adj, state), "proposals")
            if moves.isEmpty():
                release(moves)
                break
            new = materialize(state.join(_accepted(moves, seed, level, turn), "node", "left").select("node", F.coalesce("b", "group").alias("group"), "k", "m2"), "state")
            release(moves, state)
            state, turn = new, turn + 1
        if state.where("node <> group").isEmpty():
            break
        to = state.select("node", F.col("group").alias("to"))
        joined = materialize(members.join(to, members["group"] == to["node"]).select(members["node"], F.col("to").alias("group")), "members")
        a, b = to.toDF("u", "gu"), to.toDF("v", "gv")
        less = adj.join(a, "u").join(b, "v").where("gu <> gv").groupBy(F.col("gu").alias("u"), F.col("gv").alias("v"), "part").agg(F.sum("w").alias("w"))
        less = materialize(less, "adj")
        new = materialize(state.groupBy("group").agg(F.sum("k").alias("k"), F.first("m2").alias("m2")).select(F.col("group").alias("node"), "group", "k", "m2"), "state")
        release(adj, state, members)
        adj, state, members, level = less, new, joined, level + 1
    least = members.groupBy("group").agg(F.min("node").alias("community"))
    found = members.join(least, "group").select("node", "community")
    alone = nodes.select("node").where("node IS NOT NULL").distinct().join(found, "node", "left_anti")
    return found.unionByName(alone.select("node", F.col("node").alias("community")))


def modularity(split: DataFrame, edges: DataFrame) -> DataFrame:
    """(modularity) of a split (node, community) of ``edges`` (src, dst, weight), as one graph; null without edges."""
    e = edges.where("src IS NOT NULL AND dst IS NOT NULL AND weight > 0").select("src", "dst", F.col("weight").cast("long").alias("w"))
    a, b = split.toDF("src", "ca"), split.toDF("dst", "cb")
    ends = e.join(a, "src").join(b, "dst")
    each = ends.select(F.explode(F.array(F.struct(F.col("ca").alias("c"), "w", F.when(F.col("ca") == F.col("cb"), F.col("w")).otherwise(0).alias("inner")), F.struct(F.col("cb").alias("c"), "w", F.when(F.col("ca") == F.col("cb"), F.col("w")).otherwise(0).alias("inner")))).alias("x")).select("x.*")
    by = each.groupBy("c").agg(F.sum("w").cast("double").alias("k"), F.sum("inner").cast("double").alias("inner"))
    return by.agg(F.sum("inner").alias("inner"), F.sum("k").alias("m2"), F.sum(F.col("k") * F.col("k")).alias("squares")).select((F.col("inner") / F.col("m2") - F.col("squares") / (F.col("m2") * F.col("m2"))).alias("modularity"))


def _group_links(split: DataFrame, edges: DataFrame) -> DataFrame:
    """(a, b, w): what joins two groups, both ways."""
    e = edges.where("weight > 0").join(split.toDF("src", "a"), "src").join(split.toDF("dst", "b"), "dst").where("a <> b")
    e = e.groupBy(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).agg(F.sum("weight").alias("w"))
    return e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b"), "w"))


def merged_down(split: DataFrame, edges: DataFrame, most: int | None = None, least: float = 1, largest: float | None = None, sizes: DataFrame | None = None) -> DataFrame:
    """(node, group): small groups joined to others until none is below ``least`` and, if given, at most ``most`` are left.

    ``split`` is (node, group), ``edges`` (src, dst, weight), ``sizes`` (node,
    size), 1 a node by default. In a round every group that is too small, or among
    the smallest too many, proposes to the group it is most joined to, of those
    with which it stays within ``largest`` where there is one; joined to none, to
    the smallest other group. Ties go to the least group. A group to which a
    smaller one proposes stays for this round, as do all that need not merge; the
    others join those that stay, smallest first and as many as ``largest`` lets in,
    one at least. The smallest group always moves. A merged group keeps the name of
    the one that stayed.
    """
    size = F.lit(1.0) if sizes is None else F.col("size").cast("double")
    n = split if sizes is None else split.join(sizes, "node")
    groups = materialize(n.groupBy("group").agg(F.sum(size).alias("size")), "groups")
    links = materialize(_group_links(split, edges), "links")
    names = materialize(groups.select("group", F.col("group").alias("to")), "names")
    while True:
        count = groups.count()
        over = max(0, count - most) if most is not None else 0
        if count < 2:
            break
        due = groups.where(F.col("size") < least)
        if over:
            due = due.unionByName(running(groups, ["size", "group"]).where(F.col("before") < over).drop("before")).distinct()
        if due.isEmpty():
            break
        small = [r.group for r in groups.orderBy("size", "group").limit(2).collect()]
        fits = (F.col("size") + F.col("other") <= largest) if largest is not None else F.lit(True)
        other = groups.toDF("b", "other")
        near = due.join(links.withColumnRenamed("a", "group"), "group").join(other, "b").withColumn("fits", fits)
        pick = near.groupBy("group").agg(F.min_by("b", F.struct(~F.col("fits"), -F.col("w"), "b")).alias("b"))
        asks = due.join(pick, "group", "left").select("group", "size", F.coalesce("b", F.when(F.col("group") == F.lit(small[0]), F.lit(small[1])).otherwise(F.lit(small[0]))).alias("b"))
        asks = asks.withColumn("turn", F.struct("size", "group")).join(other, "b")
        asks = materialize(asks, "asks")
        asked = asks.groupBy(F.col("b").alias("x")).agg(F.min("turn").alias("by"))
        moves = asks.join(asked, asks["group"] == asked["x"], "left").where("by IS NULL OR by >= turn").drop("x", "by")
        turns = asks.select(F.col("group").alias("x"), F.col("turn").alias("own"))
        stays = moves.join(turns, moves["b"] == turns["x"], "left").drop("x").join(asked, moves["b"] == asked["x"], "left").where("own IS NULL OR by < own")
        taken = stays.select("group", "size", "b", "other")
        if largest is not None:
            taken = running(taken, ["size", "group"], "size", ["b"]).where((F.col("before") == 0) | (F.col("other") + F.col("before") + F.col("size") <= largest))
        taken = materialize(taken.select("group", "b"), "taken")
        renamed = lambda df, c: df.join(taken.toDF(c, "_to"), c, "left").withColumn(c, F.coalesce("_to", c)).drop("_to")
        less = materialize(renamed(groups, "group").groupBy("group").agg(F.sum("size").alias("size")), "groups")
        fewer = materialize(renamed(renamed(links, "a"), "b").where("a <> b").groupBy("a", "b").agg(F.sum("w").alias("w")), "links")
        now = materialize(renamed(names, "to"), "names")
        release(groups, links, names, asks, taken)
        groups, links, names = less, fewer, now
    return split.join(names, "group").select("node", F.col("to").alias("group"))


def numbered(split: DataFrame) -> DataFrame:
    """(node, group): groups numbered from 0, the largest first, by least node on a tie."""
    g = split.groupBy("group").agg(F.count("*").alias("size"), F.min("node").alias("least"))
    g = running(g, [F.desc("size"), "least"], before="number")
    return split.join(g.select("group", "number"), "group").select("node", F.col("number").alias("group"))
