"""Recursion over owners: qualified names, nearest owners, depths."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weavemine.session import materialize, release


def ancestors(nodes: DataFrame) -> DataFrame:
    """(id, ancestor, depth): every node's owners, itself at depth 0; stops at a cycle.

    Pointer doubling over the owner column: the number of rounds is the
    logarithm of the longest chain, each one equi-join.
    """
    own = nodes.select("id", "owner").where("owner IS NOT NULL AND owner <> id").join(nodes.select(F.col("id").alias("owner")), "owner", "left_semi").select("id", "owner")
    paths = own.select("id", F.col("owner").alias("ancestor"), F.lit(1).alias("depth"))
    reach = 1
    while True:
        paths = materialize(paths, "ancestors")
        longest = paths.where(F.col("depth") == reach)
        if longest.isEmpty():
            break
        more = longest.select("id", F.col("ancestor").alias("via")).join(paths.select(F.col("id").alias("via"), "ancestor", "depth"), "via")
        more = more.select("id", "ancestor", (F.col("depth") + reach).alias("depth")).where("ancestor <> id")
        paths = paths.unionByName(more).groupBy("id", "ancestor").agg(F.min("depth").alias("depth"))
        reach *= 2
        if reach >= 1 << 30:  # depths are ints
            raise RuntimeError("a chain of owners is longer than depths can count")
    return nodes.select("id", F.col("id").alias("ancestor"), F.lit(0).alias("depth")).unionByName(paths)


def qualified_names(nodes: DataFrame, separator: str = "::") -> DataFrame:
    """(id, qualified): names of the owners from the root down, unnamed ones left out."""
    named = ancestors(nodes).join(nodes.select(F.col("id").alias("ancestor"), "name"), "ancestor").where("name IS NOT NULL AND name <> ''")
    parts = F.transform(F.array_sort(F.collect_list(F.struct((-F.col("depth")).alias("d"), "name"))), lambda x: x["name"])
    return named.groupBy("id").agg(F.array_join(parts, separator).alias("qualified"))


def nearest_ancestor(nodes: DataFrame, wanted: Column) -> DataFrame:
    """(id, ancestor, depth): the nearest owner, or the node itself, for which ``wanted`` (over nodes' columns) holds.

    Every node keeps one pointer, which jumps as far as the one it points at has
    come and rests at the first hit: a row a node, in rounds that grow with the
    logarithm of the way. Ways that end, or turn in a circle, without a hit give no row.
    """
    n = nodes.select("id", "owner", F.coalesce(wanted, F.lit(False)).alias("hit"))
    up = n.join(n.select(F.col("id").alias("owner"), F.col("hit").alias("up_hit")), "owner", "left")
    at = F.when(F.col("hit"), F.col("id")).when(F.col("up_hit").isNotNull() & (F.col("owner") != F.col("id")), F.col("owner"))
    state = materialize(up.select("id", at.alias("at"), F.when(F.col("hit"), 0).otherwise(1).alias("depth"), (F.col("hit") | F.coalesce("up_hit", F.lit(False))).alias("rests")).where("at IS NOT NULL"), "ways")
    longest = state.count()
    reach = 1
    while reach <= longest and not state.where("NOT rests").isEmpty():
        far = state.select(F.col("id").alias("at"), F.col("at").alias("on"), F.col("depth").alias("more"), F.col("rests").alias("there"))
        moved = state.where("NOT rests").join(far, "at").select("id", F.col("on").alias("at"), (F.col("depth") + F.col("more")).alias("depth"), F.col("there").alias("rests"))
        new = materialize(state.where("rests").unionByName(moved), "ways")
        release(state)
        state, reach = new, reach * 2
    return state.where("rests").select("id", F.col("at").alias("ancestor"), "depth")


def tree_depths(nodes: DataFrame) -> DataFrame:
    """(id, depth): how many owners each node of (id, owner) has; 0 for those without a known one, no row on a circle."""
    return nearest_ancestor(nodes.join(nodes.select(F.col("id").alias("owner"), F.lit(True).alias("_there")).distinct(), "owner", "left"), F.col("_there").isNull()).select("id", "depth")
