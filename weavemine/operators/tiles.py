"""What two things of many have in common, counted without a row for each thing they have in common.

What holds the same ``at`` is a list in the order of things. Things are cut to ranges, the blocks, and a list goes to each block
that some of it is in, from its first one in the block on: there the block's own meet all after them. Lists are shipped as packed
numbers, the distance to the one before each, so that a number takes a byte or two in place of a row.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weavemine.operators.ranges import running
from weavemine.session import materialize

#: Pairs that a task counts at once, and the rows and pairs that a block should have. They bound memory only.
STEP, TILE_ROWS, TILE_PAIRS = 2_000_000, 1_000_000, 8_000_000
#: Rows that are packed at once (a list is not cut), numbers that go to blocks at once, and rows of a result in a batch. They bound memory only.
PACKED, SPREAD, BATCH = 500_000, 2_000_000, 100_000


def put(x: np.ndarray) -> bytes:
    """Whole numbers as bytes: how many, the least, and what they are above it in as few bytes as the largest needs, first bytes first."""
    x = x.astype(np.int64)
    least = x.min(initial=np.iinfo(np.int64).max) if len(x) else 0
    above = (x - least).view(np.uint64)  # may wrap, as the sum in ``take`` does then
    width = (int(above.max()).bit_length() + 7) // 8 if len(x) else 0
    return np.array([len(x), least, width], "<i8").tobytes() + above.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T.tobytes()


def take(data: bytes, many: int) -> list[np.ndarray]:
    """So many arrays that ``put`` wrote one after the other."""
    out, at = [], 0
    for _ in range(many):
        n, least, width = np.frombuffer(data, "<i8", 3, at).tolist()
        x = np.zeros((n, 8), np.uint8)
        x[:, :width] = np.frombuffer(data, np.uint8, n * width, at + 24).reshape(width, n).T
        out.append(x.view("<u8").reshape(n).astype(np.int64) + least)
        at += 24 + n * width
    return out


def spans(lo: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The numbers from each ``lo`` on, ``n`` of them, one span after the other."""
    return np.arange(n.sum()) + np.repeat(lo - np.cumsum(n) + n, n)


def put_lists(ids: np.ndarray, v: np.ndarray, n: np.ndarray, *more: np.ndarray) -> bytes:
    """Lists of ``n`` ids in order with their ``v``, and more numbers of each list."""
    first = np.cumsum(n) - n
    away = np.diff(ids, prepend=0)
    away[first] = 0
    return b"".join(map(put, (away, v, n, ids[first], *more)))


def take_lists(data: bytes, more: int = 0) -> tuple[np.ndarray, ...]:
    """(ids, v, n, *more) as ``put_lists`` had them."""
    away, v, n, heads, *rest = take(data, 4 + more)
    ids = np.cumsum(away)
    return ids + np.repeat(heads - ids[np.cumsum(n) - n], n), v, n, *rest


def _pack(once: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows (at, id, v) in this order to lists (data, rows, pairs); with ``once``, rows are taken once."""

    def packed(t: pa.Table, new: np.ndarray) -> pa.RecordBatch:
        ids, v = t["id"].to_numpy(), t["v"].to_numpy()
        if once:
            keep = new | np.append(True, (ids[1:] != ids[:-1]) | (v[1:] != v[:-1]))
            ids, v, new = ids[keep], v[keep], new[keep]
        n = np.diff(np.append(np.flatnonzero(new), len(new)))
        many = np.repeat(n > 1, n)
        ids, v, n = ids[many], v[many], n[n > 1]
        return pa.RecordBatch.from_pydict({"data": [put_lists(ids, v, n)], "rows": [len(ids)], "pairs": [float((n * (n - 1.0) / 2).sum())]})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows, enough = [], 0, PACKED
        for batch in batches:
            held.append(batch)
            rows += batch.num_rows
            if rows < enough:
                continue
            t = pa.Table.from_batches(held).combine_chunks()
            new = starts(t["at"])
            end = int(np.flatnonzero(new)[-1])
            if end:
                yield packed(t.slice(0, end), new[:end])
            held, rows = t.slice(end).to_batches(), rows - end
            enough = max(PACKED, 2 * rows)  # a list longer than that is looked through seldom
        if rows:
            t = pa.Table.from_batches(held).combine_chunks()
            yield packed(t, starts(t["at"]))

    def starts(at: pa.ChunkedArray) -> np.ndarray:
        return np.append(True, pc.not_equal(at.slice(1), at.slice(0, len(at) - 1)).to_numpy()).astype(bool)

    return run


def _spread(bounds: np.ndarray) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Lists to (block, data): each from its first id in the block on, with the number of its ids in it. ``bounds`` are the blocks' least ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for data in (x for batch in batches for x in batch["data"]):
            ids, v, n = take_lists(data.as_py())
            if not len(n):
                continue
            block = np.searchsorted(bounds, ids, "right") - 1
            ends = np.cumsum(n)
            new = np.append(True, block[1:] != block[:-1])
            new[ends[:-1]] = True
            lo = np.flatnonzero(new)
            mine, rest = np.diff(np.append(lo, len(ids))), np.repeat(ends, n)[lo] - lo
            lo, mine, rest = lo[rest > 1], mine[rest > 1], rest[rest > 1]
            order = np.argsort(block[lo], kind="stable")
            lo, mine, rest = lo[order], mine[order], rest[order]
            part = np.cumsum(rest) // SPREAD
            cut = np.flatnonzero(np.append(True, (block[lo][1:] != block[lo][:-1]) | (part[1:] != part[:-1])))
            for x, y in zip(cut, np.append(cut[1:], len(lo))):
                at = spans(lo[x:y], rest[x:y])
                yield pa.RecordBatch.from_arrays([pa.array([block[lo[x]]], pa.int32()), pa.array([put_lists(ids[at], v[at], rest[x:y], mine[x:y])], pa.binary())], ["block", "data"])

    return run


def tallies(who: np.ndarray, lo: np.ndarray, hi: np.ndarray, key: Callable[[np.ndarray, np.ndarray], np.ndarray], step: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(key, count) of all pairs (i, j) of a row i and a number j from its ``lo`` to its ``hi``; those of one ``who``, which is in order, come together."""
    upto = np.append(0, np.cumsum(hi - lo))
    ends = np.append(np.flatnonzero(who[1:] != who[:-1]) + 1, len(who))
    begin = 0
    while begin < len(who):
        full = np.searchsorted(upto[ends], upto[begin] + step, "right")
        end = ends[max(full - 1, np.searchsorted(ends, begin, "right"))]
        keys, counts, at = np.zeros(0, np.int64), np.zeros(0, np.int64), begin
        while at < end:  # more than one time only if one of ``who`` has more pairs than a step
            stop = min(end, max(at + 1, np.searchsorted(upto, upto[at] + step, "right") - 1))
            n = hi[at:stop] - lo[at:stop]
            k, c = np.unique(key(np.repeat(np.arange(at, stop), n), spans(lo[at:stop], n)), return_counts=True)
            if len(keys):
                k, same = np.unique(np.append(keys, k), return_inverse=True)
                c = np.bincount(same, np.append(counts, c), len(k)).astype(np.int64)
            keys, counts, at = k, c, stop
        yield keys, counts
        begin = end


class Block:
    """A block's lists: ``who`` and ``v`` of all, by place; the places of its own with the end of their lists, in order of who; ``names`` and row counts ``n`` by who."""

    def __init__(self, pieces: list[bytes], named: list[bytes]):
        known = sorted(((np.cumsum(take(d[8:], 1)[0]), d) for d in named), key=lambda x: x[0][0])
        ids = np.concatenate([x for x, _ in known])
        self.n = np.concatenate([take(d[8:], 2)[1] for _, d in known])
        tails = [d[8 + int.from_bytes(d[:8], "little") :] for _, d in known]
        self.names = np.concatenate([pa.ipc.open_stream(t).read_all()["who"].to_numpy() for t in tails]) if tails[0] else ids
        span = int(ids[-1]) - int(ids[0]) + 1
        place = None
        if span < 8 * len(ids) + 1_000_000:
            place = np.zeros(span, np.int32)
            place[ids - ids[0]] = np.arange(len(ids))
        who, vs, own, upto, at = [], [], [], [], 0
        while pieces:
            x, v, n, mine = take_lists(pieces.pop(), 1)
            who.append(place[x - ids[0]] if place is not None else np.searchsorted(ids, x).astype(np.int32))
            vs.append(v.astype(np.int32) if len(v) and -(1 << 31) <= v.min() and v.max() < 1 << 31 else v)
            ends = np.cumsum(n)
            own.append(at + spans(ends - n, mine))
            upto.append(at + np.repeat(ends, mine))
            at += len(x)
        self.who, self.v, own, upto = (np.concatenate(x) for x in (who, vs, own, upto))
        order = np.argsort(self.who[own], kind="stable")
        self.own, self.upto = own[order], upto[order]

    def tallies(self, key: Callable[[np.ndarray, np.ndarray], np.ndarray], step: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """The counts of ``key`` of the places of each two of a list of which the first is the block's own."""
        return tallies(self.who[self.own], self.own + 1, self.upto, lambda i, j: key(self.own[i], j), step)


def whole(kind: str) -> bool:
    return kind in ("tinyint", "smallint", "int", "bigint")


def coded(rows: DataFrame, column: str, to: str, dense: bool = False) -> DataFrame:
    """``rows`` with a column as long, in its order: whole numbers as they are, others, or all if ``dense``, by their place among all; null stays."""
    if not dense and whole(rows.schema[column].dataType.simpleString()):
        return rows.withColumn(to, F.col(column).cast("long"))
    kinds = running(rows.select(column).where(F.col(column).isNotNull()).distinct(), [column], before=to)
    return rows.join(kinds, column, "left")


def in_blocks(rows: DataFrame, sizes: DataFrame, once: bool, run: Callable[[Block], Iterator[pd.DataFrame]], schema: str, tile_rows: int, tile_pairs: int) -> DataFrame:
    """What ``run`` makes of each block of ``rows`` (id, at, v); ``sizes`` has (id, who, n) of every id."""
    if not whole(kind := rows.schema["at"].dataType.simpleString()) and kind != "string":
        rows = rows.withColumn("at", F.col("at").cast("string"))
    laid = rows.select("at", "id", "v").repartition("at").sortWithinPartitions("at", "id", "v")
    lists = materialize(laid.mapInArrow(_pack(once), "data binary, rows long, pairs double"), "lists", batch=10_000)
    sums = lists.agg(F.sum("rows").alias("rows"), F.sum("pairs").alias("pairs")).first()
    blocks = max(1, math.ceil((sums.rows or 0) / tile_rows), math.ceil((sums.pairs or 0) / tile_pairs))
    sizes = sizes.select("id", "who", F.col("n").cast("long").alias("n"))
    if blocks > 1:
        placed = running(sizes, ["id"], "n", before="_before", total="_whole")
        sizes = materialize(placed.select("id", "who", "n", F.floor(F.col("_before") * blocks / F.col("_whole")).cast("int").alias("block")), "sizes")
        bounds = np.array(sorted(r[0] for r in sizes.groupBy("block").agg(F.min("id")).select("min(id)").collect()), np.int64)
    else:
        sizes, bounds = sizes.withColumn("block", F.lit(0)), np.array([np.iinfo(np.int64).min])
    bare = whole(sizes.schema["who"].dataType.simpleString())

    def named(t: pa.Table) -> pa.Table:
        t = t.sort_by("id")
        ids = t["id"].to_numpy()
        data, names = put(np.diff(ids, prepend=0)) + put(t["n"].to_numpy()), pa.BufferOutputStream()
        if not bare:
            with pa.ipc.new_stream(names, t.select(["who"]).schema) as out:
                out.write_table(t.select(["who"]))
        data = len(data).to_bytes(8, "little") + data + (b"" if bare else names.getvalue().to_pybytes())
        return pa.table({"block": pa.array([np.searchsorted(bounds, ids[0], "right") - 1], pa.int32()), "data": pa.array([data], pa.binary())})

    def count(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pieces, names = [], []
        for part in parts:
            for data, name in zip(part["data"], part["name"]):
                (names if name else pieces).append(bytes(data))
        if pieces:
            for out in run(Block(pieces, names)):
                yield from (out[at : at + BATCH] for at in range(0, len(out), BATCH))

    count.__annotations__ = {"parts": Iterator[pd.DataFrame], "return": Iterator[pd.DataFrame]}
    names = sizes.select("block", "id", "who", "n").groupBy("block").applyInArrow(named, "block int, data binary")
    names = names.select(F.explode(F.sequence(F.lit(0), "block")).alias("block"), "data", F.lit(True).alias("name"))
    parts = lists.select("data").mapInArrow(_spread(bounds), "block int, data binary").withColumn("name", F.lit(False))
    return parts.unionByName(names).repartition(len(bounds), "block").groupBy("block").applyInPandas(count, schema)


def shared_counts(rows: DataFrame, who: str, at: str, apart: str | None = None) -> DataFrame:
    """(a, b, shared, na, nb) of each two of ``who`` with an ``at`` in common: how many, and how many rows either has; with ``apart``, of rows that differ in it.

    Rows are taken once.
    """
    kind = rows.schema[who].dataType.simpleString()
    rows = rows.select(F.col(who).alias("who"), F.col(at).alias("at"), *([F.col(apart).alias("f")] if apart else [])).where("who IS NOT NULL")
    sizes = materialize(rows.repartition("who").distinct().groupBy("who").agg(F.count("*").alias("n")), "sizes")
    sizes = coded(sizes, "who", "id")
    usable = rows.where("at IS NOT NULL")
    usable = coded(usable.where("f IS NOT NULL"), "f", "v") if apart else usable.withColumn("v", F.lit(0).cast("long"))
    usable = usable.withColumn("id", F.col("who").cast("long")) if whole(kind) else usable.join(sizes.select("who", "id"), "who")

    def count(block: Block) -> Iterator[pd.DataFrame]:
        many, x, v = len(block.names), block.who, block.v

        def key(i: np.ndarray, j: np.ndarray) -> np.ndarray:
            if apart:
                keep = (x[i] != x[j]) & (v[i] != v[j])
                i, j = i[keep], j[keep]
            return x[i].astype(np.int64) * many + x[j]

        for k, shared in block.tallies(key, STEP):
            a, b = np.divmod(k, many)
            yield pd.DataFrame({"a": block.names[a], "b": block.names[b], "shared": shared, "na": block.n[a], "nb": block.n[b]})

    return in_blocks(usable, sizes, True, count, f"a {kind}, b {kind}, shared bigint, na bigint, nb bigint", TILE_ROWS, TILE_PAIRS)
