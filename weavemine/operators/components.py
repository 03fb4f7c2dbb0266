"""Connected components by alternating star contraction.

Each round replaces the edge list by (large-star, then small-star): every node
is linked to the least node it can see. Rounds grow with the logarithm of the
longest path; each is a handful of hash aggregations and joins whose skewed
keys (star centres) adaptive execution may split, since both join sides are
read from written tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weavemine.session import materialize, release


def _fixed_point_mark(edges: DataFrame) -> tuple:
    h = F.xxhash64("u", "v")
    row = edges.agg(F.count("*"), F.sum(h % F.lit(1_000_003)), F.sum(F.shiftright(h, 32))).first()
    return tuple(row)


def _least_neighbour(sym: DataFrame) -> DataFrame:
    return sym.groupBy("u").agg(F.min("v").alias("m"))


def connected_components(edges: DataFrame, src: str = "src", dst: str = "dst", max_rounds: int = 60) -> DataFrame:
    """(node, component) for every node with an edge; component is the least node reachable.

    Self loops and repeated edges are harmless; null endpoints are ignored; no edge gives no row.
    """
    e = edges.select(F.greatest(src, dst).alias("u"), F.least(src, dst).alias("v")).where(
        F.col(src).isNotNull() & F.col(dst).isNotNull() & (F.col(src) != F.col(dst))
    )
    e = materialize(e.distinct(), "cc")
    mark = _fixed_point_mark(e)
    for _ in range(max_rounds):
        if not mark[0]:
            break
        sym = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        m = materialize(_least_neighbour(sym).select("u", F.least("u", "m").alias("m")), "cc-m")
        large = materialize(
            sym.join(m.hint("merge"), "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(), "cc-l"
        )
        m2 = materialize(_least_neighbour(large), "cc-m2")
        small = (
            large.join(m2.hint("merge"), "u")
            .where("v != m")
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionByName(m2.select("u", F.col("m").alias("v")))
            .distinct()
        )
        new = materialize(small, "cc")
        now = _fixed_point_mark(new)
        release(e, m, large, m2)
        e, was, mark = new, mark, now
        if now == was:
            break
    else:
        raise RuntimeError("components did not settle")
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )
