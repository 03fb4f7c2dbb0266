"""Incremental state: staleness, orphans and merges over written tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def stale(contents: DataFrame, done: DataFrame, key: str, fresh: Column, removed: DataFrame | None = None) -> DataFrame:
    """Contents not done, or done under other settings (``fresh`` false or null), less the removed ones."""
    out = contents.join(done, key, "left").where(~F.coalesce(fresh, F.lit(False))).select(contents.columns)
    return out if removed is None else out.join(removed.select(key).where(F.col(key).isNotNull()), key, "left_anti")


def merge(target: DataFrame, delta: DataFrame, key: Sequence[str], deleted: str) -> DataFrame:
    """Upsert: rows of ``delta`` replace those of ``target`` by key, rows it marks as deleted go, others are added."""
    names = [c for c in target.columns if c not in key]
    t = target.select(*key, F.struct(*names).alias("_t"))
    d = delta.select(*key, F.struct(*names).alias("_d"), F.col(deleted).alias("_gone"))
    out = t.join(d, list(key), "full_outer").where(~F.coalesce("_gone", F.lit(False)))
    return out.select(*key, *[F.when(F.col("_d").isNotNull(), F.col(f"_d.{c}")).otherwise(F.col(f"_t.{c}")).alias(c) for c in names])
