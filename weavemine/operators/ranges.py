"""Places and running sums in an order over a whole table, without one task that holds it.

Rows are range-partitioned by the order and written with the number of their
partition; sums of partitions, one row a partition and group, are added up
first, and only then the rows of one partition are put in order. Equal keys
share a partition, so an order should end with a column that tells rows apart.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weavemine.session import materialize


def running(df: DataFrame, order: list[str | Column], value: str | Column | None = None, group: list[str] | None = None, before: str = "before", total: str | None = None) -> DataFrame:
    """``df`` with the sum of ``value`` (or the count, as long) over all earlier rows of the group, and if named over all its rows.

    Null values count as 0; groups that are null are one group. An empty table stays empty.
    """
    group = group or []
    v = F.lit(1).cast("long") if value is None else F.coalesce(F.col(value) if isinstance(value, str) else value, F.lit(0))
    keys = [*map(F.col, group), *(F.col(o) if isinstance(o, str) else o for o in order)]
    laid = df.withColumn("_value", v).repartitionByRange(*keys).withColumn("_at", F.spark_partition_id())
    laid = materialize(laid, "ranges")  # the bounds are drawn once
    sums = laid.groupBy(*group, "_at").agg(F.sum("_value").alias("_sum"))
    parts = Window.partitionBy(*group).orderBy("_at")
    whole = Window.partitionBy(*group)
    sums = sums.select(*group, "_at", F.coalesce(F.sum("_sum").over(parts.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_offset"), F.sum("_sum").over(whole).alias("_total"))
    a, b = laid.alias("a"), sums.alias("b")
    same = F.col("a._at") == F.col("b._at")
    for g in group:
        same &= F.col(f"a.`{g}`").eqNullSafe(F.col(f"b.`{g}`"))
    joined = a.join(b, same).select("a.*", "b._offset", "b._total")
    inside = Window.partitionBy("_at", *group).orderBy(*keys[len(group) :]).rowsBetween(Window.unboundedPreceding, -1)
    out = joined.withColumn(before, F.col("_offset") + F.coalesce(F.sum("_value").over(inside), F.lit(0)))
    if total:
        out = out.withColumn(total, F.col("_total"))
    return out.drop("_value", "_at", "_offset", "_total")
