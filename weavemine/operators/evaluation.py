"""Graded retrieval metrics, agreement and resampled intervals."""

from __future__ import annotations

import math
import random
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from weavemine.operators.tiles import Block, coded, in_blocks, tallies
from weavemine.session import materialize


def graded_metrics(ranked: DataFrame) -> DataFrame:
    """Per qid of (qid, doc, rank, grade 0..2): hits, reciprocal rank and nDCG at 10 with the ideal over all grades."""
    gain = F.pow(F.lit(2.0), F.col("grade")) - 1
    best = ranked.withColumn("k", F.row_number().over(Window.partitionBy("qid").orderBy(F.col("grade").desc())))
    ideal = best.where("k <= 10").groupBy("qid").agg(F.sum(gain / F.log2(F.col("k") + 1)).alias("best"))
    m = ranked.groupBy("qid").agg(
        F.min(F.when(F.col("grade") == 2, F.col("rank"))).alias("first"),
        F.sum(F.when(F.col("rank") <= 10, gain / F.log2(F.col("rank") + 1)).otherwise(0.0)).alias("dcg"),
    )
    first = F.coalesce("first", F.lit(1 << 30))
    return m.join(ideal, "qid").select(
        "qid",
        *[(first <= k).cast("int").alias(f"hit_{k}") for k in (1, 5, 10)],
        F.round(F.when(first <= 10, 1.0 / first).otherwise(0.0), 6).alias("mrr_10"),
        F.round(F.when(F.col("best") > 0, F.col("dcg") / F.col("best")).otherwise(0.0), 6).alias("ndcg_10"),
    )


def head_metrics(head: DataFrame, grades: DataFrame) -> DataFrame:
    """The same as ``graded_metrics`` from the ten best of each question (qid, doc, rank, grade) and its counts (qid, grade, n) of all that it ranks."""
    gain = F.pow(F.lit(2.0), F.col("grade")) - 1
    discounts = [0.0]
    for k in range(1, 11):
        discounts.append(discounts[-1] + 1 / math.log2(k + 1))
    upto = lambda n: F.element_at(F.array(*map(F.lit, discounts)), (F.least(n, F.lit(10)) + 1).cast("int"))
    down = Window.partitionBy("qid").orderBy(F.col("grade").desc())  # a row a grade
    g = grades.withColumn("upto", F.sum("n").over(down))
    ideal = g.groupBy("qid").agg(F.sum(gain * (upto(F.col("upto")) - upto(F.col("upto") - F.col("n")))).alias("best"))
    m = head.where("rank <= 10").groupBy("qid").agg(F.min(F.when(F.col("grade") == 2, F.col("rank"))).alias("first"), F.sum(gain / F.log2(F.col("rank") + 1)).alias("dcg"))
    first = F.coalesce("first", F.lit(1 << 30))
    ndcg = F.when(F.col("best") > 0, F.col("dcg") / F.col("best")).otherwise(0.0)
    return m.join(ideal, "qid").select("qid", *[(first <= k).cast("int").alias(f"hit_{k}") for k in (1, 5, 10)], F.round(F.when(first <= 10, 1.0 / first).otherwise(0.0), 6).alias("mrr_10"), F.round(ndcg, 6).alias("ndcg_10"))


def kappa(pairs: DataFrame, a: str, b: str) -> DataFrame:
    """(n, agreement, kappa) of two raters; 1 when chance agreement is 1, 0 without pairs."""
    joint = pairs.groupBy(F.col(a).alias("a"), F.col(b).alias("b")).agg(F.count("*").alias("n"))
    total = joint.agg(F.sum("n").alias("total"), F.sum(F.when(F.col("a") == F.col("b"), F.col("n")).otherwise(0)).alias("same"))
    left, right = joint.groupBy("a").agg(F.sum("n").alias("na")), joint.groupBy("b").agg(F.sum("n").alias("nb"))
    chance = left.join(right, F.col("a") == F.col("b")).agg(F.coalesce(F.sum(F.col("na").cast("double") * F.col("nb")), F.lit(0.0)).alias("chance"))
    po, pe = F.col("same") / F.col("total"), F.col("chance") / (F.col("total").cast("double") * F.col("total"))
    value = F.when(F.col("total").isNull(), 0.0).when(pe >= 1, 1.0).otherwise((po - pe) / F.nullif(1 - pe, F.lit(0.0)))
    return total.crossJoin(chance).select(F.coalesce("total", F.lit(0)).alias("n"), F.round(po, 6).alias("agreement"), F.round(value, 6).alias("kappa"))


def pairwise_kappa(pairs: DataFrame) -> DataFrame:
    """(a, b, n, agreement, kappa) of each pair of raters from their verdicts (a, b, va, vb) on common tasks; kappa as above, over tasks both judged."""
    joint = pairs.groupBy("a", "b", "va", "vb").agg(F.count("*").alias("n"))
    both = joint.where("va IS NOT NULL AND vb IS NOT NULL")
    sides = F.explode(F.array(F.struct(F.col("va").alias("v"), F.col("n").alias("na"), F.lit(0).cast("long").alias("nb")), F.struct(F.col("vb").alias("v"), F.lit(0).cast("long").alias("na"), F.col("n").alias("nb"))))
    sums = both.select("a", "b", sides.alias("x")).groupBy("a", "b", "x.v").agg(F.sum("x.na").cast("double").alias("na"), F.sum("x.nb").cast("double").alias("nb"))
    chance = sums.groupBy("a", "b").agg((F.sum(F.col("na") * F.col("nb")) / (F.sum("na") * F.sum("na"))).alias("pe"))
    same = F.sum(F.when(F.col("va") == F.col("vb"), F.col("n")).when(F.col("va") != F.col("vb"), 0)) / F.sum(F.when(F.col("va").isNotNull() & F.col("vb").isNotNull(), F.col("n")))
    rates = joint.groupBy("a", "b").agg(F.sum("n").alias("n"), same.alias("po")).join(chance, ["a", "b"], "left")
    return _kappa_rows(rates)


def _kappa_rows(rates: DataFrame) -> DataFrame:
    value = F.when(F.col("pe").isNull(), 0.0).when(F.col("pe") >= 1, 1.0).otherwise((F.col("po") - F.col("pe")) / F.nullif(1 - F.col("pe"), F.lit(0.0)))
    return rates.select("a", "b", "n", F.round("po", 6).alias("agreement"), F.round(value, 6).alias("kappa"))


#: Different values that a task of a bootstrap draws from. It bounds memory only.
DRAWN = 50_000
#: Pairs of verdicts that a task counts at once, and rows and pairs that a block of judges should have. They bound memory only.
STEP, TILE_ROWS, TILE_PAIRS = 2_000_000, 1_000_000, 8_000_000


def count_verdicts(left: pd.DataFrame, right: pd.DataFrame, same: bool) -> Iterator[pd.DataFrame]:
    """(a, b, n, both, alike, chance) of the pairs of a judge of ``left`` and one of ``right``, or of two of ``left`` if they are the same; rows are (judge, task, verdict).

    ``both`` are tasks on which both have a verdict, ``alike`` those with an equal one, ``chance`` sums the products of how often each gave a verdict on these.
    """
    left, right = left.sort_values("judge", kind="stable"), right.sort_values("task", kind="stable")
    (v, _), (who, names) = (pd.factorize(pd.concat([left[c], right[c]]), sort=c == "judge") for c in ("verdict", "judge"))  # null: -1
    v, other, w, many = v[len(left) :] + 1, who[len(left) :], v[: len(left)] + 1, len(names)
    kinds, who = int(max(v.max(initial=0), w.max(initial=0))) + 1, who[: len(left)]
    lo, hi = (np.searchsorted(right.task.to_numpy(), left.task.to_numpy(), side) for side in ("left", "right"))

    def key(i: np.ndarray, j: np.ndarray) -> np.ndarray:
        keep = who[i] < other[j] if same else slice(None)
        i, j = i[keep], j[keep]
        return ((np.minimum(who[i], other[j]).astype(np.int64) * many + np.maximum(who[i], other[j])) * kinds + w[i]) * kinds + v[j]

    for k, count in tallies(who, lo, hi, key, STEP):
        yield verdict_rows(k, count, names, kinds)


def verdict_rows(key: np.ndarray, count: np.ndarray, names: np.ndarray, kinds: int) -> pd.DataFrame:
    """The rows of ``count_verdicts`` from counts of keys ((a * judges + b) * kinds + verdict of a) * kinds + that of b, in order; 0 is no verdict."""
    pair, va, vb = key // (kinds * kinds), key // kinds % kinds, key % kinds
    heads, place = np.unique(pair, return_inverse=True)
    total = lambda w: np.bincount(place, w, len(heads))
    given = (va > 0) & (vb > 0)
    chance = sides_product(place[given], va[given], vb[given], count[given], len(heads), kinds)
    a, b = np.divmod(heads, max(len(names), 1))
    return pd.DataFrame({"a": names[a], "b": names[b], "n": total(count).astype(np.int64), "both": total(count * given), "alike": total(count * (given & (va == vb))), "chance": chance})


def sides_product(place: np.ndarray, va: np.ndarray, vb: np.ndarray, count: np.ndarray, pairs: int, kinds: int) -> np.ndarray:
    """For each pair, the sum over verdicts of the tasks where its first judge gave it times those where its second did."""
    sides = []
    for v in (va, vb):
        key, at = np.unique(place.astype(np.int64) * kinds + v, return_inverse=True)
        sides.append((key, np.bincount(at, count, len(key))))
    (ka, na), (kb, nb) = sides
    common, x, y = np.intersect1d(ka, kb, assume_unique=True, return_indices=True)
    return np.bincount(common // kinds, na[x] * nb[y], pairs)


def judges_kappa(verdicts: DataFrame) -> DataFrame:
    """The same as ``pairwise_kappa`` from (judge, task, verdict), a row a judge and task: no row is made for two verdicts.

    Judges are cut to blocks; a task's verdicts go to each block that some of its judges are in as packed numbers (``tiles``).
    """
    v = verdicts.toDF("judge", "at", "verdict").where("judge IS NOT NULL AND at IS NOT NULL")
    v = coded(coded(materialize(v, "verdicts"), "verdict", "v", True), "judge", "id")
    v = materialize(v.select("judge", "id", "at", F.coalesce(F.col("v") + 1, F.lit(0)).alias("v")), "verdicts")
    kind = v.schema["judge"].dataType.simpleString()

    def count(block: Block) -> Iterator[pd.DataFrame]:
        many, kinds, x, given = len(block.names), int(block.v.max(initial=0)) + 1, block.who, block.v
        if (many * kinds) ** 2 >= 1 << 63:
            raise OverflowError(f"{many} judges with {kinds} kinds of verdicts are more than a key can tell apart")

        def key(i: np.ndarray, j: np.ndarray) -> np.ndarray:
            return ((x[i].astype(np.int64) * many + x[j]) * kinds + given[i]) * kinds + given[j]

        for k, n in block.tallies(key, STEP):
            yield verdict_rows(k, n, block.names, kinds)

    sizes = v.groupBy("id", F.col("judge").alias("who")).agg(F.count("*").alias("n"))
    found = in_blocks(v, sizes, False, count, f"a {kind}, b {kind}, n bigint, both double, alike double, chance double", TILE_ROWS, TILE_PAIRS)
    po, pe = F.col("alike") / F.nullif("both", F.lit(0.0)), F.col("chance") / F.nullif(F.col("both") * F.col("both"), F.lit(0.0))
    return _kappa_rows(found.select("a", "b", "n", po.alias("po"), pe.alias("pe")))


def consensus(first: Column, second: Column, third: Column) -> Column:
    """Two raters' common grade, else the tie-breaker's, else the lower one; a single rater's own."""
    return F.when(first == second, first).when(first.isNull(), second).when(second.isNull(), first).otherwise(F.coalesce(third, F.least(first, second)))


def bootstrap_mean(values: DataFrame, group: str, value: str, rounds: int = 2000, seed: int = 1) -> DataFrame:
    """(group, mean, low, high): 95 % interval of the mean from resampling with as many draws as there are values; nulls are none.

    Equal values are counted, and different ones dealt to blocks. A round deals its draws to the blocks as often as these hold
    values, the same way in every task, and a block deals its own to its values, so a group need not be held by one task.
    """
    x = values.where(F.col(value).isNotNull()).select(F.col(group).alias("g"), F.col(value).cast("double").alias("x"))
    x = x.groupBy("g", "x").agg(F.count("*").alias("n"))
    kinds = x.groupBy("g").agg(F.ceil(F.count("*") / DRAWN).cast("int").alias("_n"))
    same = F.col("a.g").eqNullSafe(F.col("b.g"))
    x = x.alias("a").join(kinds.alias("b"), same).select("a.*", F.pmod(F.xxhash64("x"), F.col("_n")).cast("int").alias("_b"))
    held = x.groupBy("g", "_b").agg(F.sum("n").alias("h")).groupBy("g").agg(F.array_sort(F.collect_list(F.struct("_b", "h"))).alias("held"))
    x = x.alias("a").join(held.alias("b"), same).select("a.*", F.col("held._b").alias("bs"), F.col("held.h").alias("hs"))

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("x")
        block, sizes = pdf["_b"].iloc[0], np.array(pdf["hs"].iloc[0], np.int64)
        own = list(pdf["bs"].iloc[0]).index(block)
        mine = np.random.default_rng([seed, 0]).multinomial(sizes.sum(), sizes / sizes.sum(), rounds)[:, own]
        rng, x, share = np.random.default_rng([seed, 1, int(block)]), pdf["x"].to_numpy(), (pdf["n"] / pdf["n"].sum()).to_numpy()
        sums = [float(rng.multinomial(m, share) @ x) for m in mine]
        return pd.DataFrame({"g": [pdf["g"].iloc[0]] * rounds, "r": range(rounds), "s": sums, "whole": float(pdf["n"] @ pdf["x"]), "n": int(sizes.sum())})

    kind = values.schema[group].dataType.simpleString()
    drawn = x.groupBy("g", "_b").applyInPandas(run, f"g {kind}, r int, s double, whole double, n bigint")
    means = drawn.groupBy("g", "r").agg((F.sum("s") / F.max("n")).alias("m"), (F.sum("whole") / F.max("n")).alias("mean"))
    ranked = means.groupBy("g").agg(F.array_sort(F.collect_list("m")).alias("m"), F.first("mean").alias("mean"))  # a group has as many as there are rounds
    return ranked.select(F.col("g").alias(group), "mean", F.get("m", F.lit(int(0.025 * rounds))).alias("low"), F.get("m", F.lit(int(0.975 * rounds) - 1)).alias("high"))


def isotonic(points: DataFrame, x: str, y: str, w: str) -> DataFrame:
    """``points`` (one row for each x) with ``fit``: the non-decreasing least-squares fit, by pooling adjacent violators.

    One sequential pass over x in order; x are aggregated levels, few by nature.
    """
    shape = StructType([*points.schema.fields, StructField("fit", DoubleType())])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pdf = pd.concat(list(batches), ignore_index=True)
        pools: list[list[float]] = []
        for v, n in zip(pdf[y], pdf[w]):
            pools.append([v * n, n, 1])
            while len(pools) > 1 and pools[-2][0] / pools[-2][1] >= pools[-1][0] / pools[-1][1]:
                s, n_, k = pools.pop()
                pools[-1] = [pools[-1][0] + s, pools[-1][1] + n_, pools[-1][2] + k]
        pdf["fit"] = [s / n for s, n, k in pools for _ in range(k)]
        yield pdf

    return points.orderBy(x).coalesce(1).mapInPandas(run, shape)
