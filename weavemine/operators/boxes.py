"""Which rectangle lies in which: containment counted by sets of bits."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Boxes of a block, and outer boxes that one table of bits holds. Both bound memory only.
BLOCK, BITS = 32768, 2048


def _prefixes(order: np.ndarray) -> np.ndarray:
    """Row r: the bits of the first r places of ``order``."""
    bits = np.zeros((len(order) + 1, (len(order) + 63) // 64), np.uint64)
    bits[np.arange(1, len(order) + 1), order // 64] = np.uint64(1) << (order % 64).astype(np.uint64)
    return np.bitwise_or.accumulate(bits, axis=0)


def count_around(inner: pd.DataFrame, outer: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """For each of ``inner``, how many of ``outer`` (in the order of area and key) lie around it, and the place of the first, or -1.

    For each border, and for the area, the boxes beyond it are the first ones in its order, held as a set of bits; five sets are met.
    """
    depth, first = np.zeros(len(inner), np.int64), np.full(len(inner), -1)
    measures = lambda b: {c: v.to_numpy() for c, v in {"x": b.x, "y": b.y, "right": b.x + b.w, "bottom": b.y + b.h, "area": b.w * b.h}.items()}
    asked = measures(inner)
    for at in range(0, len(outer), BITS):
        met = []
        for c, v in measures(outer.iloc[at : at + BITS]).items():
            k, up = np.argsort(v, kind="stable"), c in ("x", "y")
            upto = np.searchsorted(v[k], asked[c], "left" if c in ("right", "bottom") else "right")
            met.append((_prefixes(k if up else k[::-1]), upto if up else len(v) - upto))
        for lo in range(0, len(inner), BITS):
            part = slice(lo, lo + BITS)
            around = None
            for sets, beyond in met:
                s = sets[beyond[part]]
                around = s if around is None else np.bitwise_and(around, s, out=around)
            depth[part] += np.bitwise_count(around).sum(axis=1, dtype=np.int64)
            word = (around != 0).argmax(axis=1)
            bits = around[np.arange(len(around)), word]
            lowest = np.bitwise_count((bits & (~bits + np.uint64(1))) - np.uint64(1)).astype(np.int64)
            first[part] = np.where((first[part] < 0) & (bits != 0), at + word * 64 + lowest, first[part])
    return depth, first


def enclosing(boxes: DataFrame, group: list[str], key: str = "id") -> DataFrame:
    """(group, key, parent, depth) of ``boxes`` (group, key, x, y, w, h): the smallest box around each, and how many there are.

    A box around another has a larger area and covers it, borders included; of
    several smallest ones the least key is taken. The boxes of a group are dealt
    to blocks, each pair of blocks is met in one task, and what the blocks say of
    a box is summed. Boxes with a null or negative side, or a null place, lie in
    none and hold none.
    """
    b = boxes.select(*[F.col(g).alias(f"_g{i}") for i, g in enumerate(group)], F.col(key).alias("_key"), *(F.col(c).cast("double").alias(c) for c in "xywh"))
    names = [f"_g{i}" for i in range(len(group))]
    ok = b.where("x IS NOT NULL AND y IS NOT NULL AND w >= 0 AND h >= 0").dropna(subset=names)
    blocks = ok.groupBy(*names).agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("_n"))
    dealt = ok.join(blocks, names).withColumn("_block", F.pmod(F.xxhash64("_key", *"xywh"), F.col("_n")).cast("int"))
    dealt = dealt.withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_n") - 1)))  # a box is met as an inner one with every block, and as an outer one by every block
    sides = F.explode(F.array(F.lit(True), F.lit(False))).alias("_inner")
    met = dealt.select("*", sides).withColumns({"_a": F.when(F.col("_inner"), F.col("_block")).otherwise(F.col("_other")), "_b": F.when(F.col("_inner"), F.col("_other")).otherwise(F.col("_block"))})

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        inner = pdf[pdf["_inner"]]
        outer = pdf[~pdf["_inner"]]
        outer = outer.assign(_area=outer.w * outer.h).sort_values(["_area", "_key"])
        depth, first = count_around(inner, outer)
        found = first >= 0
        out, best = inner[[*names, "_key"]][found].copy(), outer.iloc[first[found]]
        out["_area"], out["_parent"], out["_depth"] = best["_area"].to_numpy(), best["_key"].to_numpy(), depth[found]
        return out

    kinds = {f.name: f.dataType.simpleString() for f in b.schema.fields}
    shape = ", ".join([*(f"{n} {kinds[n]}" for n in (*names, "_key")), "_area double", f"_parent {kinds['_key']}", "_depth bigint"])
    found = met.select(*names, "_key", *"xywh", "_inner", "_a", "_b").groupBy(*names, "_a", "_b").applyInPandas(run, shape)
    up = found.groupBy(*names, "_key").agg(F.min_by("_parent", F.struct("_area", "_parent")).alias("parent"), F.sum("_depth").alias("depth")).toDF(*group, key, "parent", "depth")
    return boxes.select(*group, key).join(up, [*group, key], "left").withColumn("depth", F.coalesce("depth", F.lit(0)))
