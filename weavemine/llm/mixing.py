"""Operator 7: mixing sources to target weights along a time-varying curriculum.

Targets are a water-filling over sources; each source's documents are laid on
its own axis of cumulative tokens (in an order given by a hash of id and text),
the axis is repeated for a second pass where the target asks for one, and a copy
is due when its middle's share of the target is demanded. The training position
of every copy, of each pass, is where the integral of its source's weight
schedule reaches that share; a copy not due before training ends is not taken.
The mix is the copies range-sorted by that position, and what a document gives
to it is counted there.

Running sums never need a whole source in one task: rows are dealt by their hash
to 4096 buckets per source, bucket totals are summed first, and only then the
rows of one bucket are put in order. Since the text is part of the hash, null or
repeated ids are dealt out like all others.

Defined results: null text or no word: size 0, nothing is taken; null source:
a source of its own, after all others; null or repeated ids: each row counts as
its own document (rows alike in id, size and text are interchangeable); an
empty table gives an empty mix; very long texts are counted whole, and a source
misses its target by half a document at most. Other columns are carried along
unread, and may have any names.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from weavemine.session import materialize, table

NAME = "op7_curriculum_mix"
WEIGHTS = (5, 2, 1)
SHARE, CAP = 1.5, 2
#: (time, relative weight) knots by rank of the source modulo their number: rising, level, falling.
SCHEDULES = (((0.0, 0.5), (0.5, 1.0), (1.0, 1.5)), ((0.0, 1.0), (1.0, 1.0)), ((0.0, 1.5), (0.5, 1.0), (1.0, 0.5)))
WORD = r"[^\x20\x09-\x0D]+"


def inverse_schedule_sql(share: str, knots: Sequence[tuple[float, float]]) -> str:
    """SQL for the time at which the piecewise linear schedule has delivered ``share`` (0 to 1) of its whole."""
    d = lambda x: f"CAST({x!r} AS DOUBLE)"
    areas = [(b - a) * (v + w) / 2 for (a, v), (b, w) in zip(knots, knots[1:])]
    total, before, out = sum(areas), 0.0, ""
    for k, ((a, v), (b, w)) in enumerate(zip(knots, knots[1:])):
        slope = (w - v) / (b - a)
        y = f"({share} * {d(total)} - {d(before)})"
        root = f"sqrt(greatest({d(v * v)} + {d(2 * slope)} * {y}, {d(0.0)}))"
        t = f"{d(a)} + {d(2.0)} * {y} / greatest({d(v)} + {root}, {d(1e-12)})"
        before += areas[k]
        out += f"WHEN {share} * {d(total)} <= {d(before)} THEN {t} " if k + 2 < len(knots) else f"ELSE {t} END"
    return "CASE " + out if len(knots) > 2 else t


def position_sql(share: str, rank: str, schedules=SCHEDULES) -> str:
    n = len(schedules)
    return "CASE " + " ".join(f"WHEN {rank} % {n} = {k} THEN {inverse_schedule_sql(share, s)}" for k, s in enumerate(schedules)) + " END"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(
    totals: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = SHARE, cap: int = CAP
) -> DataFrame:
    """Per (source, source_size): rank, weight and target. One row per source, so its windows hold few rows.

    A source that would exceed ``cap`` times its size gets just that; sorting by
    cap over weight makes the capped sources a prefix, and the level of the rest follows.
    """
    order = Window.orderBy(F.col("source").isNull(), "source")
    t = totals.withColumn("rank", F.row_number().over(order) - 1)
    t = t.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), (F.col("rank") % len(weights) + 1).cast("int")))
    t = t.withColumn("cap", F.col("source_size") * cap).withColumn("ratio", F.col("cap") / F.col("weight"))
    filling = Window.orderBy("ratio", "rank")
    all_rows = Window.orderBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    t = t.withColumn("whole", F.lit(share) * F.sum("source_size").over(all_rows))
    capped = F.coalesce(F.sum("cap").over(filling.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    rest = F.sum("weight").over(filling.rowsBetween(0, Window.unboundedFollowing))
    t = t.withColumn("level", (F.col("whole") - capped) / rest)
    level = F.min(F.when(F.col("level") <= F.col("ratio"), F.struct("ratio", "rank", "level"))).over(all_rows)["level"]
    return t.withColumn("at", level).select(
        "source", "source_size", "rank", "weight",
        F.coalesce(F.least(F.col("cap").cast("double"), F.col("at") * F.col("weight")), F.col("cap").cast("double")).alias("target"),
    )


def order_key(doc_id: Column, text: Column) -> Column:
    """Where a document stands on its source's axis; its first three digits are its bucket."""
    return F.md5(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit("|"), F.coalesce(text, F.lit(""))))


def lay_out(sized: DataFrame, weights=WEIGHTS, share=SHARE, cap=CAP) -> DataFrame:
    """Adds source_size, target, source_rank and ``begins`` (words of the source before the row) to (source, size, order_key, ...).

    Bucket offsets are joined and the rows of a bucket summed up under one layout of the rows, so they move once.
    """
    deal = {"_none": F.col("source").isNull(), "_s": F.coalesce(F.col("source").cast("string"), F.lit("")), "_b": F.substring("order_key", 1, 3)}
    keys = list(deal)
    rows = sized.withColumns(deal)
    buckets = materialize(rows.groupBy("source", *keys).agg(F.sum("size").alias("_n")), "mix-buckets")
    targets = source_targets(buckets.groupBy("source").agg(F.sum("_n").alias("source_size")), weights, share, cap)
    running = Window.partitionBy("_none", "_s").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = buckets.select(*keys, F.coalesce(F.sum("_n").over(running), F.lit(0)).alias("_before"))
    named = targets.select(
        F.col("source").isNull().alias("_none"), F.coalesce(F.col("source").cast("string"), F.lit("")).alias("_s"), "source_size", "target", F.col("rank").alias("source_rank")
    )
    offsets = materialize(offsets.join(named, ["_none", "_s"]).select(*keys, "_before", "source_size", "target", "source_rank"), "mix-offsets")
    inside = Window.partitionBy(*keys).orderBy("order_key", "size").rowsBetween(Window.unboundedPreceding, -1)
    joined = rows.join(offsets, keys)
    return joined.withColumn("begins", F.col("_before") + F.coalesce(F.sum("size").over(inside), F.lit(0))).drop(*keys, "_before", "order_key")


def with_copies(laid: DataFrame, cap: int = CAP) -> DataFrame:
    """Adds ``positions``: where in training each copy of the document stands (0 to 1), in the order of its passes; and of these ``copies`` and ``position``, their number and the first (null if not taken).

    The share of the target demanded when a copy is due is put into the inverse of its source's integrated schedule, pass by
    pass; a copy whose share is not reached before training ends is not taken.
    """
    at = [F.try_divide(p * F.col("source_size") + F.col("begins") + F.col("size") / 2, F.col("target")) for p in range(cap)]
    out = laid.withColumns({f"_f{p}": f for p, f in enumerate(at)})
    due = F.array(*(F.when((F.col("size") > 0) & (F.col(f"_f{p}") < 1), F.expr(position_sql(f"_f{p}", "source_rank"))) for p in range(cap)))
    out = out.withColumn("positions", F.array_compact(due)).drop(*(f"_f{p}" for p in range(cap)))
    return out.withColumns({"copies": F.size("positions"), "position": F.get("positions", F.lit(0))})


def in_training_order(laid: DataFrame, cap: int = CAP) -> DataFrame:
    """A row for each copy taken, with its place ``_at`` in training, range-sorted by it: the mix."""
    placed = with_copies(laid, cap).withColumn("_at", F.explode("positions")).drop("positions")
    return placed.withColumn("_tie", F.xxhash64("doc_id")).repartitionByRange("_at", "_tie").sortWithinPartitions("_at", "_tie", "doc_id")


def mix(docs: DataFrame, weights=WEIGHTS, share: float = SHARE, cap: int = CAP) -> DataFrame:
    """The mix itself: the rows of ``docs``, once for each copy taken, range-sorted by training position.

    Texts move twice: to their bucket, and as often as they are taken to their place.
    """
    names = docs.columns
    packed = docs.select(
        "doc_id", "source", word_count(F.col("text")).alias("size"), order_key(docs["doc_id"], docs["text"]).alias("order_key"), F.struct(*[docs[c].alias(f"c{i}") for i, c in enumerate(names)]).alias("_row")
    )
    placed = in_training_order(lay_out(packed, weights, share, cap), cap)
    return placed.select(*[F.col(f"_row.c{i}").alias(c) for i, c in enumerate(names)])


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the mix, written in the order of training, took of each document."""
    docs = table(spark, sf_dir, "documents")
    key = order_key(F.col("doc_id"), F.col("text")).alias("order_key")
    sized = materialize(docs.select("doc_id", "source", word_count(F.col("text")).alias("size"), key), "mix-sized")
    laid = materialize(lay_out(sized), "mix-laid")
    place = ["source_rank", "begins"]  # of rows that have words, no two of a source begin at one place
    mixed = materialize(in_training_order(laid).select(*place, "size", "_at"), "mix")
    took = mixed.groupBy(*place).agg(F.sum("size").alias("taken"), F.count("*").cast("int").alias("copies"), F.min("_at").alias("position"))
    took = took.withColumnsRenamed({c: f"_{c}" for c in place})
    same = (F.col("source_rank") == F.col("_source_rank")) & (F.col("begins") == F.col("_begins")) & (F.col("size") > 0)
    return laid.join(took, same, "left").select(
        "doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).alias("taken"), F.coalesce("copies", F.lit(0)).alias("copies"),
        F.round("position", 6).alias("position"),
    )


SQL = f"""
WITH sized AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS BIGINT) AS size,
         md5(coalesce(CAST(doc_id AS VARCHAR), '') || '|' || coalesce(text, '')) AS h
  FROM documents),
totals AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source),
ranked AS (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS rank FROM totals),
weighed AS (SELECT *, CASE rank % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight FROM ranked),
ratios AS (SELECT *, 2 * source_size AS cap, CAST(2 * source_size AS DOUBLE) / weight AS ratio FROM weighed),
levels AS (SELECT *, (CAST(1.5 AS DOUBLE) * CAST((SELECT sum(source_size) FROM totals) AS DOUBLE)
    - CAST(coalesce(sum(cap) OVER (ORDER BY ratio, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS DOUBLE))
    / CAST(sum(weight) OVER (ORDER BY ratio, rank ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS DOUBLE) AS level FROM ratios),
chosen AS (SELECT level AS lv FROM levels WHERE level <= ratio ORDER BY ratio, rank LIMIT 1),
targets AS (SELECT source, source_size, rank, least(CAST(cap AS DOUBLE), (SELECT lv FROM chosen) * weight) AS target FROM levels),
laid AS (
  SELECT s.doc_id, s.size, t.source_size, t.target, t.rank,
         coalesce(sum(s.size) OVER (PARTITION BY s.source ORDER BY s.h, s.size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS begins
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source),
taken AS (
  SELECT *, (CASE WHEN size > 0 AND begins + size / CAST(2 AS DOUBLE) < target THEN 1 ELSE 0 END)
     + (CASE WHEN size > 0 AND begins + size / CAST(2 AS DOUBLE) + source_size < target THEN 1 ELSE 0 END) AS copies,
     (begins + size / CAST(2 AS DOUBLE)) / target AS f FROM laid)
SELECT doc_id, size, source_size, target, CAST(copies * size AS BIGINT) AS taken, CAST(copies AS INTEGER) AS copies,
  round(CASE WHEN copies > 0 THEN {position_sql('f', 'rank')} END, 6) AS position
FROM taken
"""
