"""Operator 10 for whole texts: near copies by five-word shingles with a Jaccard similarity of 0.8 or more.

A 64-bit SimHash of the shingles finds the closest copies, by the byte-position
index of ``simhash``; every pair it finds is verified by the Jaccard similarity
of the two sets. Texts that are 0.8 alike differ in up to some 16 of the 64 bits,
though, which no index of fingerprints guarantees to find. So the search is
completed exactly, by an index of shingles:

1. Shingles are put in one order for all texts: those that are frequent in some
   part of the corpus last, by count, all others before them, by hash. Two sets
   that similar share one of the first ``n - ceil(0.8 n) + 1`` of each, so only
   these are posted, with their places. Places and sizes bound what two sets
   can share; postings of sets that cannot reach 0.8 with any other are dropped.
2. In each posting the members of about equal size are verified against the one
   whose place is first, the likeliest centre of a group.
3. Members of a posting that are in different components then are verified
   pair by pair, where places, sizes and parity maps (a set's shingles counted
   modulo 2 in about as many cells; maps differ in no more cells than the sets do
   in members) leave it possible. Nothing is capped, and every pair that reaches
   the similarity is linked, so a group of near copies costs a few rows a member.

Words are split as in operator 10 (A-Z lowered, ASCII white space). Fewer words
than a shingle: the whole sequence is the one shingle; null and wordless texts
are copies of each other; equal sets are copies; shingles are 64-bit hashes.
Rows with equal ids stand in the order of a hash of their text, null ids after all
others; an empty table gives no rows; other columns are carried along unread,
whatever their names; a text of any length is read whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weavemine.llm import simhash
from weavemine.operators.components import connected_components
from weavemine.session import materialize, release

SHINGLE, SEED = 5, 42
#: The least similarity, as a fraction.
PART, WHOLE = 4, 5
#: Cells of a parity map, at least and at most.
CELLS, CELLS_MOST = 256, 1 << 15
#: Frequent shingles known to every task, at most; those a task reports, at most and at least so often.
LISTED, REPORTED, OFTEN = 1 << 16, 1 << 11, 8
_STEP = 0x9E3779B97F4A7C15


class _Words(dict):
    """Hashes of words; emptied when it has grown to its bound."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= 1 << 16:
            self.clear()
        h = self[word] = xxhash.xxh64_intdigest(word, SEED)
        return h


_HASH = _Words().__getitem__


def _mixed(h: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def shingle_set(text: str | None) -> np.ndarray:
    """The different shingles' hashes (uint64), sorted."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    w = np.fromiter(map(_HASH, words), np.uint64, len(words))
    size = min(SHINGLE, len(w))
    with np.errstate(over="ignore"):
        h = np.full(len(w) - size + 1, size, np.uint64)
        for k in range(size):
            h = h * np.uint64(_STEP) + w[k : len(w) - size + 1 + k]
    return np.unique(_mixed(h))


def node_of(shingles: np.ndarray) -> int:
    """The signed 64-bit digest of a set; texts with equal sets are one node."""
    return int(np.uint64(xxhash.xxh64_intdigest(shingles.tobytes(), SEED)).view(np.int64))


def fingerprint(shingles: np.ndarray) -> int:
    return simhash.over_half(simhash.set_bits(shingles), len(shingles)) if len(shingles) else 0


def parity(shingles: np.ndarray, cells: int | None = None) -> np.ndarray:
    """One bit a cell, as longs: which cells an odd number of the hashes fall into. A power of two of cells, about one a member.

    A map of half as many cells is the exclusive or of the halves of this one.
    """
    if cells is None:
        cells = min(CELLS_MOST, max(CELLS, 1 << max(0, len(shingles) - 1).bit_length()))
    odd = np.bincount((shingles & np.uint64(cells - 1)).astype(np.int64), minlength=cells) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


class _Frequent:
    """Shingles that many sets of a task hold, with their counts; memory is bounded, rare ones are let go."""

    def __init__(self):
        self.waiting, self.size = [], 0
        self.found: dict[int, int] = {}

    def add(self, shingles: np.ndarray) -> None:
        self.waiting.append(shingles)
        self.size += len(shingles)
        if self.size >= 1 << 18:
            self.settle()

    def settle(self) -> None:
        if self.waiting:
            s, n = np.unique(np.concatenate(self.waiting), return_counts=True)
            for x, k in zip(s[n > 1].tolist(), n[n > 1].tolist()):
                self.found[x] = self.found.get(x, 0) + k
            self.waiting, self.size = [], 0
        if len(self.found) > 1 << 16:
            self.found = dict(self.most(1 << 15))

    def most(self, k: int) -> list[tuple[int, int]]:
        return sorted(self.found.items(), key=lambda x: (-x[1], x[0]))[:k]


def prefix(shingles: np.ndarray, listed: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The shingles to post, in order: any set similar enough shares one of them, and posts it too."""
    n = len(shingles)
    if not n:
        return shingles
    most = n - -(-PART * n // WHOLE) + 1
    often = np.zeros(n, np.int64)
    if len(listed):
        at = np.minimum(np.searchsorted(listed, shingles), len(listed) - 1)
        often = np.where(listed[at] == shingles, counts[at], 0)
    rare = shingles[often == 0]
    if len(rare) >= most:
        return rare[:most]
    return shingles[np.argsort(often, kind="stable")[:most]]


_PARITY = [f"p{k}" for k in range(CELLS // 64)]


def _lists(arrays: list[np.ndarray]) -> pa.ListArray:
    ends = np.cumsum([0] + [len(x) for x in arrays]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(arrays).view(np.int64) if arrays else np.zeros(0, np.int64)))


def _read(docs: DataFrame) -> tuple[DataFrame, tuple[np.ndarray, np.ndarray]]:
    """(key, node, size, fp, parity) of every row, and the corpus's frequent shingles with their counts."""
    kind = docs.schema["key"].dataType.simpleString()
    longs = ["node", "size", "fp", *_PARITY, "s", "n"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent, key = _Frequent(), None
        for b in batches:
            rows, maps = [], []
            for t in b.column(1):
                s = shingle_set(t.as_py())
                frequent.add(s)
                rows.append((node_of(s), len(s), fingerprint(s), *parity(s, CELLS).tolist()))
                maps.append(parity(s))
            key = b.column(0).type
            found = [pa.array(c, pa.int64()) for c in zip(*rows)] if rows else [pa.array([], pa.int64())] * (3 + len(_PARITY))
            yield pa.RecordBatch.from_arrays([b.column(0), *found, *[pa.nulls(len(rows), pa.int64())] * 2, _lists(maps)], ["key", *longs, "map"])
        frequent.settle()
        if key is not None and (most := [x for x in frequent.most(REPORTED) if x[1] >= OFTEN]):
            s, n = np.array([x[0] for x in most], np.uint64).view(np.int64), [x[1] for x in most]
            none = [pa.nulls(len(n), pa.int64())] * (3 + len(_PARITY))
            yield pa.RecordBatch.from_arrays([pa.nulls(len(n), key), *none, pa.array(s), pa.array(n, pa.int64()), pa.nulls(len(n), pa.list_(pa.int64()))], ["key", *longs, "map"])

    read = materialize(docs.select("key", "text").mapInArrow(run, f"key {kind}, " + ", ".join(f"{c} long" for c in longs) + ", map array<long>"), "near-read")
    # at most LISTED rows, however large the corpus: only the order of shingles depends on them
    most = read.where("s IS NOT NULL").groupBy("s").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "s").limit(LISTED).collect()
    s = np.array([r.s for r in most], np.int64).view(np.uint64)
    order = np.argsort(s)
    return read.where("s IS NULL").drop("s", "n"), (s[order], np.array([r.n for r in most], np.int64)[order])


def _least(m: Column, n: Column) -> Column:
    """The least number of shared members that makes sets of m and n members similar."""
    return F.ceil(PART * (m + n) / F.lit(float(PART + WHOLE)) - 1e-6)


def _may(a: str, b: str) -> Column:
    """Whether the sizes and the places of one shingle leave two sets similar; columns pos and size with these suffixes."""
    m, n = F.col(f"size{a}"), F.col(f"size{b}")
    room = F.least(m - F.col(f"pos{a}"), n - F.col(f"pos{b}"))
    return (WHOLE * F.least(m, n) >= PART * F.greatest(m, n)) & (room >= _least(m, n))


def _postings(docs: DataFrame, frequent: tuple[np.ndarray, np.ndarray]) -> DataFrame:
    """(s, node, pos, size): posted shingles that may be the first in common of two similar sets."""
    listed, counts = frequent

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k in range(0, b.num_rows, 128):
                columns: list[list[np.ndarray]] = [[], [], [], []]
                for t in b.column(0).slice(k, 128):
                    s = shingle_set(t.as_py())
                    p = prefix(s, listed, counts)
                    for c, x in zip(columns, (p.view(np.int64), np.full(len(p), node_of(s)), np.arange(len(p), dtype=np.int32), np.full(len(p), len(s), np.int32))):
                        c.append(x)
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in columns], ["s", "node", "pos", "size"])

    posted = materialize(docs.select("text").mapInArrow(run, "s long, node long, pos int, size int"), "near-posted")
    sizes = posted.groupBy("s").agg(F.count("*").alias("k"), F.min("size").alias("least")).where("k > 1").drop("k")
    partner = F.greatest("least", F.ceil(F.col("size") * PART / F.lit(float(WHOLE)) - 1e-6))
    shared = posted.join(sizes, "s").where(F.col("size") - F.col("pos") >= _least(F.col("size"), partner))
    shared = materialize(shared.select("s", "node", "pos", "size").distinct(), "near-shared")
    release(posted)
    return shared


def _sets(docs: DataFrame, keys: DataFrame) -> DataFrame:
    """(node, shingles) of the rows with the given keys; equal rows give a node more than once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k in range(0, b.num_rows, 64):
                sets = [shingle_set(t.as_py()) for t in b.column(0).slice(k, 64)]
                yield pa.RecordBatch.from_arrays([pa.array([node_of(s) for s in sets], pa.int64()), _lists(sets)], ["node", "shingles"])

    flat = docs.select("key.*", "text").toDF("none", "id", "h", "text")
    wanted = keys.select("key.*").toDF("none", "id", "h")
    out = flat.join(wanted, ["none", "id", "h"], "left_semi").select("text").mapInArrow(run, "node long, shingles array<long>")
    return materialize(out, "near-sets")


def _verified(docs: DataFrame, pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """(src, dst): the pairs (a, b) whose similarity is at least PART / WHOLE. Only sets of pairs that sizes and parity maps leave open are fetched."""
    x, y = (nodes.select(F.col("node").alias(k), F.col("size").alias(f"size{k}"), F.col("map").alias(f"map{k}")) for k in "ab")
    sized = F.lit(WHOLE) * F.least("sizea", "sizeb") >= F.lit(PART) * F.greatest("sizea", "sizeb")
    half = lambda m, n: F.when(F.size(m) > n, F.zip_with(F.slice(m, F.lit(1), n), F.slice(m, n + 1, n), lambda p, q: p.bitwiseXOR(q))).otherwise(F.col(m))
    cells = F.least(F.size("mapa"), F.size("mapb"))
    apart = F.aggregate(F.zip_with(half("mapa", cells), half("mapb", cells), lambda p, q: F.bit_count(p.bitwiseXOR(q))), F.lit(0), lambda s, n: s + n)
    few = (PART + WHOLE) * apart <= (WHOLE - PART) * (F.col("sizea") + F.col("sizeb"))
    left = pairs.distinct().join(x, "a").join(y, "b").where(sized).where(few).select("a", "b")
    left = materialize(left, "near-pairs")
    wanted = left.select(F.col("a").alias("node")).union(left.select("b")).distinct()
    sets = _sets(docs, nodes.join(wanted, "node", "left_semi").select("least.key"))
    x, y = (sets.select(F.col("node").alias(k), F.col("shingles").alias(f"s{k}")) for k in "ab")
    both = F.size(F.array_intersect("sa", "sb"))
    alike = (PART + WHOLE) * both >= PART * (F.size("sa") + F.size("sb"))
    out = left.join(x, "a").join(y, "b").where(alike).select(F.col("a").alias("src"), F.col("b").alias("dst")).distinct()
    out = materialize(out, "near-links")
    release(left, sets)
    return out


def _few_odd(a: str, b: str) -> Column:
    """Whether the parity maps of CELLS cells leave two sets similar."""
    apart = sum((F.bit_count(F.col(f"{p}{a}").bitwiseXOR(F.col(f"{p}{b}"))) for p in _PARITY), F.lit(0))
    return (PART + WHOLE) * apart <= (WHOLE - PART) * (F.col(f"size{a}") + F.col(f"size{b}"))


def _by_fingerprint(nodes: DataFrame) -> DataFrame:
    """(a, b): nodes of one fingerprint, and of fingerprints that the byte-position index links."""
    fps = materialize(nodes.groupBy("fp").agg(F.min("node").alias("first")), "near-fingerprints")
    same = nodes.join(fps, "fp").where("node <> first").select(F.col("first").alias("a"), F.col("node").alias("b"))
    x, y = fps.toDF("src", "a"), fps.toDF("dst", "b")
    return same.unionByName(simhash.links(fps.select("fp")).join(x, "src").join(y, "dst").select("a", "b"))


def near_copies(docs: DataFrame) -> DataFrame:
    """(none, id, h, n) of the least key of each component of near copies, from (key, text); n counts the rows with that key."""
    keyed, frequent = _read(docs)
    facts = [F.first(c).alias(c) for c in ("size", "fp", "map", *_PARITY)]
    nodes = keyed.groupBy("key", "node").agg(F.count("*").alias("n"), *facts).groupBy("node").agg(F.min(F.struct("key", "n")).alias("least"), *facts)
    nodes = materialize(nodes, "near-nodes")
    shared = _postings(docs, frequent)
    group = F.floor(F.log(F.col("size").cast("double")) / F.log(F.lit(WHOLE / PART)))
    centres = shared.groupBy("s", group.alias("g")).agg(F.min(F.struct("pos", "node", "size")).alias("c"))
    centres = centres.select("s", "g", F.col("c.pos").alias("posa"), F.col("c.node").alias("a"), F.col("c.size").alias("sizea"))
    members = shared.select("s", group.alias("g"), F.col("node").alias("b"), F.col("pos").alias("posb"), F.col("size").alias("sizeb"))
    star = members.join(centres, ["s", "g"]).where((F.col("a") != F.col("b")) & _may("a", "b")).select("a", "b").distinct()
    near = _verified(docs, star.unionByName(_by_fingerprint(nodes)), nodes)
    found = materialize(connected_components(near), "near-found")
    named = materialize(shared.join(found, "node", "left").withColumn("c", F.coalesce("component", "node")).drop("component"), "near-named")
    split = named.groupBy("s").agg(F.min("c").alias("low"), F.max("c").alias("high")).where("low < high").select("s")
    open_ = named.join(split, "s", "left_semi").join(nodes.select("node", *_PARITY), "node")
    open_ = materialize(open_, "near-open")
    names = ["node", "s", "pos", "size", "c", *_PARITY]
    # Pairs of two components have a member outside the posting's largest one, so only such members are paired with all.
    largest = open_.groupBy("s", "c").agg(F.count("*").alias("k")).groupBy("s").agg(F.max_by("c", F.struct("k", "c")).alias("most"))
    largest = materialize(largest, "near-largest")
    left = open_.join(largest, "s").where("c <> most").select("s", "most", *[F.col(c).alias(f"{c}a") for c in names if c != "s"])
    right = open_.select("s", *[F.col(c).alias(f"{c}b") for c in names if c != "s"])
    once = (F.col("cb") == F.col("most")) | (F.col("nodea") < F.col("nodeb"))
    rest = left.join(right, "s").where(once & (F.col("ca") != F.col("cb")) & _may("a", "b") & _few_odd("a", "b"))
    more = _verified(docs, rest.select(F.col("nodea").alias("a"), F.col("nodeb").alias("b")), nodes)
    roots = materialize(connected_components(near.unionByName(more)), "near-components")
    rooted = nodes.join(roots, "node", "left").select(F.coalesce("component", "node").alias("root"), "least")
    stay = rooted.groupBy("root").agg(F.min("least").alias("x")).select("x.key.none", "x.key.id", "x.key.h", "x.n")
    stay = materialize(stay, "near-stay")
    release(nodes, shared, near, found, named, open_, largest, more, roots)
    return stay


def keep_one(docs: DataFrame, text: str = "text") -> DataFrame:
    """The rows of ``docs`` without near copies: of each component the row with the least id stays.

    Null ids come after all others, equal ids stand in the order of a hash of
    the text, and of rows alike in both one stays.
    """
    key = F.struct(F.col("doc_id").isNull().alias("none"), F.coalesce("doc_id", F.lit(0)).alias("id"), F.xxhash64(text).alias("h"))
    stay = near_copies(docs.select(key.alias("key"), F.col(text).alias("text"))).toDF("_none", "_id", "_h", "_n")
    names = docs.columns
    marked = docs.select(*[docs[c].alias(f"c{i}") for i, c in enumerate(names)], key.alias("_k")).select("*", "_k.*").drop("_k")
    joined = marked.join(stay.hint("merge"), (F.col("none") == F.col("_none")) & (F.col("id") == F.col("_id")) & (F.col("h") == F.col("_h")))
    once = joined.where("_n = 1").unionByName(joined.where("_n > 1").dropDuplicates(["none", "id", "h"]))
    return once.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(names)])
