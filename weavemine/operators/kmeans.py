"""Spherical k-means over sparse TF-IDF rows, seeded by weighted draws.

Rows are (id, word, w) tables; a centre is such a row too. Likeness is a join on
the word, so neither a vector nor the words of all rows ever meet in one task,
and centres are as large as the words of their groups.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weavemine.session import materialize, release

#: Likeness is compared to so many digits; ties go to the least centre.
DIGITS = 9


def tfidf_rows(counts: DataFrame, n: int) -> DataFrame:
    """(id, word, w) of (id, word, n): (1 + ln n) ln(rows / rows with the word), each id's brought to length 1; zeros dropped."""
    df = counts.groupBy("word").agg(F.countDistinct("id").alias("df"))
    x = counts.join(df, "word").select("id", "word", ((1 + F.log("n")) * F.log(F.lit(n) / F.col("df"))).alias("w")).where("w > 0")
    return _unit(x, "id")


def _unit(x: DataFrame, key: str) -> DataFrame:
    norm = x.groupBy(key).agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
    return x.join(norm, key).select(key, "word", (F.col("w") / F.col("norm")).alias("w"))


def _uniform(seed: int, step: int, x: Column) -> Column:
    """A number in (0, 1] that the seed, the step and the value decide."""
    h = F.xxhash64(F.lit(seed).cast("long"), F.lit(step).cast("long"), x)
    return (F.pmod(h, F.lit(1 << 53)) + 1) / F.lit(float(1 << 53))


def seeds(rows: DataFrame, ids: DataFrame, k: int, seed: int = 1) -> list:
    """k ids, each drawn with a chance that grows with its distance to those before (at random where all are at none).

    A draw is a race: every id runs -ln(u) / distance, and the first one wins.
    """
    far = materialize(ids.select("id", F.lit(1.0).alias("far")), "far")
    out = []
    for step in range(k):
        u = _uniform(seed, step, F.col("id"))
        race = F.when(F.col("far") > 0, F.struct(F.lit(0), (-F.log(u) / F.col("far")))).otherwise(F.struct(F.lit(1), u))
        out.append(far.agg(F.min_by("id", F.struct(race, "id"))).first()[0])
        centre = rows.where(F.col("id") == F.lit(out[-1])).select("word", F.col("w").alias("c"))
        sim = rows.join(centre, "word").groupBy("id").agg(F.round(F.sum(F.col("w") * F.col("c")), DIGITS).alias("sim"))
        left = F.greatest(F.lit(0.0), F.least("far", F.round(1 - F.coalesce("sim", F.lit(0.0)), DIGITS)))
        new = materialize(far.join(sim, "id", "left").select("id", F.when(F.col("id") == F.lit(out[-1]), 0.0).otherwise(left).alias("far")), "far")
        release(far)
        far = new
    release(far)
    return out


def spherical_kmeans(rows: DataFrame, ids: DataFrame, k: int, seed: int = 1, rounds: int = 50) -> DataFrame:
    """(id, group) of ``ids`` (id): groups numbered from 0, in the order of their seeds, none empty.

    ``rows`` are (id, word, w) of length 1 each. At most ``rounds`` rounds are
    made, or until none changes. A row that is like no centre goes to the first.
    Nulls and repeats in ``ids`` are dropped; k is at most their number.
    """
    ids = materialize(ids.select("id").where("id IS NOT NULL").distinct(), "ids")
    k = min(k, ids.count())
    if not k:
        return ids.select("id", F.lit(None).cast("int").alias("group"))
    spark = rows.sparkSession
    first = spark.createDataFrame([*enumerate(seeds(rows, ids, k, seed))], ids.select(F.lit(0).alias("group"), "id").schema)
    centres = materialize(first.join(rows, "id").select("group", "word", F.col("w").alias("c")), "centres")
    labels = None
    for _ in range(rounds):
        sim = rows.join(centres, "word").groupBy("id", "group").agg(F.round(F.sum(F.col("w") * F.col("c")), DIGITS).alias("sim"))
        best = sim.where("sim > 0").groupBy("id").agg(F.min_by("group", F.struct(-F.col("sim"), "group")).alias("group"))
        new = materialize(ids.join(best, "id", "left").select("id", F.coalesce("group", F.lit(0)).alias("group")), "labels")
        if labels is not None:
            moved = not new.join(labels.withColumnRenamed("group", "was"), "id").where("group <> was").isEmpty()
            release(labels)
            if not moved:
                labels = new
                break
        labels = new
        sums = _unit(rows.join(labels, "id").groupBy("group", "word").agg(F.sum("w").alias("w")), "group").withColumnRenamed("w", "c")
        kept = centres.join(labels.select("group").distinct(), "group", "left_anti")  # a group that has lost all keeps its centre
        moved_to = materialize(sums.select("group", "word", "c").unionByName(kept), "centres")
        release(centres)
        centres = moved_to
    used = sorted(r.group for r in labels.select("group").distinct().collect())  # k at most
    return labels.select("id", (F.array_position(F.array(*map(F.lit, used)), F.col("group")) - 1).cast("int").alias("group"))
