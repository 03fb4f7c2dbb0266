"""Placed things cut in halves along the longer side until every part is small enough, all parts of a level at once."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weavemine.operators.ranges import running
from weavemine.session import materialize, release


def median_cuts(items: DataFrame, limit: float, by: str | None = None) -> DataFrame:
    """``items`` (id, x, y, size) with their ``part``: a path of 0 (first half) and 1 from '' down.

    A part over ``limit`` in total with more than one item is cut across its longer
    side (across x on a tie), items in the order of that coordinate and id: the first
    half takes items as long as these hold half of the total at most, one at least.
    Running sums come from range partitions, so a part may be larger than a task.
    ``by`` names a column whose values are cut apart to begin with; null is one. Null
    coordinates count as 0, null sizes as 0; ids should differ.
    """
    zero = lambda c: F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c)
    own = F.lit(0).alias("_by") if by is None else F.col(by).alias("_by")
    state = materialize(items.select("id", own, zero("x"), zero("y"), zero("size"), F.lit("").alias("part"), F.lit(False).alias("_done")), "cuts")
    while True:
        todo = state.where("NOT _done")
        side = lambda c: F.max(c) - F.min(c)
        parts = todo.groupBy("_by", "part").agg(F.sum("size").alias("whole"), F.count("*").alias("n"), (side("x") >= side("y")).alias("across"), F.min(F.struct("x", "id")).alias("by_x"), F.min(F.struct("y", "id")).alias("by_y"))
        parts = materialize(parts.withColumn("_cut", (F.col("whole") > limit) & (F.col("n") > 1)), "parts")
        if parts.where("_cut").isEmpty():
            release(parts)
            break
        p = parts.withColumnRenamed("_by", "b").withColumnRenamed("part", "p")
        one = todo.join(p, todo["_by"].eqNullSafe(p["b"]) & (todo["part"] == p["p"])).drop("b", "p")
        one = one.withColumn("at", F.when(F.col("across"), F.col("x")).otherwise(F.col("y")))
        cut = running(one.where("_cut"), ["at", "id"], "size", ["_by", "part"])
        first = F.col("id") == F.when(F.col("across"), F.col("by_x.id")).otherwise(F.col("by_y.id"))
        half = F.when(first | (2 * (F.col("before") + F.col("size")) <= F.col("whole")), "0").otherwise("1")
        cut = cut.select("id", "_by", "x", "y", "size", F.concat("part", half).alias("part"), "_done")
        rest = one.where("NOT _cut").select("id", "_by", "x", "y", "size", "part", F.lit(True).alias("_done"))
        new = materialize(state.where("_done").unionByName(rest).unionByName(cut), "cuts")
        release(state, parts)
        state = new
    return state.select("id", "x", "y", "size", *([F.col("_by").alias(by)] if by else []), "part")
