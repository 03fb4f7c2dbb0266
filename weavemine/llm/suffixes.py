"""Operator 5: suffix-array removal of repeated byte strings.

Every byte covered by a ``SPAN``-byte string that also starts anywhere else is
removed. Which strings repeat is settled by suffix arrays, built by two-stage
sorting, over bounded pieces of text that can hold the same string:

1. Anchors. Each SPAN-byte string picks the least (leftmost) hash among its
   inner ``INNER``-byte strings. Equal strings pick the same, so strings can only
   repeat within a group of equal anchors. Consecutive starts with one anchor
   form a row: anchor hash, first and last start relative to the anchor, and a
   128-bit digest of the bytes they cover. There is about one row for 185 bytes.
2. Groups. Anchors that occur once are done. Rows with equal digests repeat each
   other over all their starts; one of each class stays in as a partner. The bytes
   of the classes that share an anchor with other ones are fetched.
3. Parts. The range of starts of each class is cut in four, and the parts are regrouped
   by the bytes that all starts of a part share (308 or more), so classes that are
   alike around the anchor only come apart. Equal parts settle, and one stays in.
4. Suffix arrays. Groups of up to ``GROUP`` parts are sorted together, in batches of
   bounded size. Only suffixes smaller than their successors are sorted directly;
   scanning the buckets induces the others; adjacent common prefixes of SPAN bytes or
   more are repeats.
5. Larger groups are not capped: they are cut again until they fit, and a range
   of one start is a group of equal strings.

Spans go back to documents by a join on a key of id and text, so texts are
shuffled twice and nothing else is as large as they are.

Defined results: null text is empty; texts below SPAN bytes lose nothing; texts of
any length are read whole, one at a time;
repeated rows (equal id and text) repeat each other; null ids are rows like
others; an empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weavemine.session import materialize, release, table

NAME = "op5_two_stage_suffixes"
SPAN, INNER, GROUP, BATCH = 400, 32, 64, 48 << 10


# --- suffix array -------------------------------------------------------------------------------


def two_stage_suffix_array(t: np.ndarray, depth: int = SPAN) -> list[int]:
    """Suffix array of bytes ``t`` (its last must be 0), in the order of the first ``depth`` bytes at least.

    Suffixes smaller than their successors are sorted directly. In a scan from
    the left every other suffix is met after its successor, and goes to the front
    of its first byte's bucket.
    """
    n = len(t)
    if not n:
        return []
    up = np.zeros(n, bool)  # smaller than the successor
    if n > 1:
        differ = np.append(t[:-1] != t[1:], True)
        at = np.where(differ, np.arange(n), n)
        at = np.minimum.accumulate(at[::-1])[::-1]  # the end of the run of equal bytes
        up[:-1] = (at < n - 1)[:-1] & (t[at[:-1]] < t[np.minimum(at[:-1] + 1, n - 1)])
    small = np.nonzero(up)[0]
    padded = np.concatenate([t, np.zeros(depth, np.uint8)])
    keys = np.lib.stride_tricks.as_strided(padded, (n, depth), (1, 1))[small].copy().view(f"S{depth}").ravel()
    small = small[np.argsort(keys, kind="stable")]
    counts = np.bincount(t, minlength=256)
    begins = np.concatenate([[0], np.cumsum(counts)])
    sa = np.full(n, -1, np.int64)
    bucket = t[small]
    ends_before = np.bincount(bucket, minlength=256)
    first = begins[1:] - ends_before  # directly sorted suffixes fill the back of their bucket
    order = np.arange(len(small)) - np.concatenate([[0], np.cumsum(ends_before)])[bucket]
    sa[first[bucket] + order] = small
    out, head, text, direct = sa.tolist(), begins[:-1].tolist(), t.tolist(), up.tolist()
    out[head[text[n - 1]]] = n - 1
    head[text[n - 1]] += 1
    for j in range(n):
        i = out[j] - 1
        if i >= 0 and not direct[i]:
            c = text[i]
            out[head[c]] = i
            head[c] += 1
    return out


def common_prefixes(data: bytes, sa: list[int] | np.ndarray, most: int = SPAN, wanted: np.ndarray | None = None) -> np.ndarray:
    """For each place of the suffix array, the common prefix with the place before, counted up to ``most`` bytes.

    All places advance together, eight bytes at a time; those that differ drop out. Where ``wanted`` is not set, it stays 0.
    """
    n = len(sa)
    out = np.zeros(n, np.int64)
    if n < 2:
        return out
    words = _words_at(data, most)
    order = np.asarray(sa)
    at = np.arange(1, n) if wanted is None else np.nonzero(wanted[1:])[0] + 1
    first = at
    a, b = order[at - 1], order[at]
    for k in range(0, most, 8):
        x = words[a + k] ^ words[b + k]
        differ = x != 0
        low = x[differ]
        out[at[differ]] = k + (np.bitwise_count((low & (~low + np.uint64(1))) - np.uint64(1)).astype(np.int64) >> 3)
        same = ~differ
        a, b, at = a[same], b[same], at[same]
        if not len(at):
            break
    out[at] = most
    room = n - np.maximum(order[first - 1], order[first])
    out[first] = np.minimum(out[first], np.minimum(room, most))
    return out


def _words_at(data: bytes, most: int) -> np.ndarray:
    """The eight bytes from each place of ``data`` (and ``most`` places more) as a number."""
    return np.ndarray((len(data) + most,), "<u8", data + bytes(most + 8), strides=(1,))


def repeated_starts(pieces: list[bytes], span: int = SPAN) -> list[np.ndarray]:
    """For each piece, which starts of ``span``-byte strings have an equal one at another place of any piece."""
    # UTF-8 has no bytes above 0xF4: one more leaves 0 for the ends of pieces
    arrays = [np.concatenate([np.frombuffer(p, np.uint8) + np.uint8(1), np.zeros(1, np.uint8)]) for p in pieces]
    t = np.concatenate(arrays)
    valid = np.concatenate([np.arange(len(a)) + span < len(a) for a in arrays])
    order, data = np.array(two_stage_suffix_array(t, span)), t.tobytes()
    ok = valid[order]
    may = np.zeros(len(order), bool)  # neighbours whose first and last bytes of the span agree; the others can't have it in common
    may[1:] = ok[1:] & ok[:-1]
    words = _words_at(data, span)
    for k in (0, max(0, span - 8)):
        x = words[order + k]
        may[1:] &= x[1:] == x[:-1]
    same = may & (common_prefixes(data, order, span, may) >= span)
    twice = same.copy()
    twice[:-1] |= same[1:]
    mark = np.zeros(len(t), bool)
    mark[order[twice]] = True
    out, at = [], 0
    for p, a in zip(pieces, arrays):
        out.append(mark[at : at + max(0, len(p) - span + 1)])
        at += len(a)
    return out


def runs(mark: np.ndarray) -> list[tuple[int, int]]:
    """First and last place of each run of set marks."""
    edge = np.diff(np.concatenate([[0], mark.astype(np.int8), [0]]))
    return list(zip(np.nonzero(edge == 1)[0].tolist(), (np.nonzero(edge == -1)[0] - 1).tolist()))


# --- anchors ------------------------------------------------------------------------------------


def _slide(x: np.ndarray, width: int, least) -> np.ndarray:
    """least(x[i : i + width]) for every i."""
    w = 1
    while w * 2 <= width:
        x, w = least(x[: len(x) - w], x[w:]), w * 2
    return x if w == width else least(x[: len(x) - (width - w)], x[width - w :])


def inner_hashes(b: np.ndarray, inner: int = INNER) -> np.ndarray:
    """Mixed polynomial hash of each ``inner``-byte string (a power of two)."""
    with np.errstate(over="ignore"):
        h, w, base = b.astype(np.uint64) + np.uint64(1), 1, 0x9E3779B97F4A7C15
        while w < inner:
            h = h[: len(h) - w] * np.uint64(base) + h[w:]
            base, w = base * base % (1 << 64), w * 2
        h ^= h >> np.uint64(31)
        h *= np.uint64(0xBF58476D1CE4E5B9)
        h ^= h >> np.uint64(29)
        h *= np.uint64(0x94D049BB133111EB)
        h ^= h >> np.uint64(32)
    return h


def anchors(data: bytes, span: int = SPAN, inner: int = INNER) -> Iterator[tuple[int, int, int, int]]:
    """(hash, place, first start, last start) with starts relative to the place: each start of a ``span``-byte string once."""
    if len(data) < span:
        return
    h = inner_hashes(np.frombuffer(data, np.uint8), inner)
    width = span - inner + 1
    low = _slide(h, width, np.minimum)
    high = _slide(np.concatenate([np.zeros(width - 1, np.uint64), low, np.zeros(width - 1, np.uint64)]), width, np.maximum)
    picked = np.nonzero(high[: len(h)] == h)[0]
    places: dict[int, list[int]] = defaultdict(list)
    for i, v in zip(picked.tolist(), h[picked].tolist()):
        places[v].append(i)
    change = np.nonzero(low[1:] != low[:-1])[0] + 1
    begins = np.concatenate([[0], change]).tolist()
    ends = np.concatenate([change - 1, [len(low) - 1]]).tolist()
    for p, end, v in zip(begins, ends, low[begins].tolist()):
        here = places[v]
        k = bisect_left(here, p)
        while p <= end:
            i = here[k]
            last = min(i, end)
            yield v, i, p - i, last - i
            p, k = last + 1, k + 1


def _digest(*parts: bytes) -> bytes:
    d = hashlib.blake2b(digest_size=16)
    for p in parts:
        d.update(p)
    return d.digest()


def _signature(lo: int, hi: int, covered: bytes) -> bytes:
    return _digest(lo.to_bytes(4, "little", signed=True), hi.to_bytes(4, "little", signed=True), covered)


_SIGNED = 1 << 63


_FOUND = pa.schema([("u1", pa.int64()), ("u2", pa.int64()), ("h", pa.int64()), ("at", pa.int64()), ("lo", pa.int32()), ("hi", pa.int32()), ("cls", pa.binary())])
_COVERED = pa.schema([("h", pa.int64()), ("cls", pa.binary()), ("lo", pa.int32()), ("hi", pa.int32()), ("covered", pa.binary())])
FLUSH = 20_000  # rows gathered before they are handed on


def _batch(columns: list[list], schema: pa.Schema) -> pa.RecordBatch:
    out = pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)
    for c in columns:
        c.clear()
    return out


def _find_anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    columns: list[list] = [[] for _ in _FOUND]
    u1s, u2s, hs, ats, los, his, classes = columns
    for b in batches:
        for u1, u2, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2)):
            data = (text.as_py() or "").encode()
            before = len(hs)
            for v, i, lo, hi in anchors(data):
                hs.append((v ^ _SIGNED) - _SIGNED)
                ats.append(i)
                los.append(lo)
                his.append(hi)
                classes.append(_signature(lo, hi, data[i + lo : i + hi + SPAN]))
            u1s += [u1] * (len(hs) - before)
            u2s += [u2] * (len(hs) - before)
            if len(hs) >= FLUSH:
                yield _batch(columns, _FOUND)
    yield _batch(columns, _FOUND)


def _fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bytes that a class covers, from the document of its first row."""
    columns: list[list] = [[] for _ in _COVERED]
    for b in batches:
        for text, wanted in zip(b.column(0), b.column(1)):
            data = (text.as_py() or "").encode()
            for x in wanted.as_py():
                row = (x["h"], x["cls"], x["lo"], x["hi"], data[x["at"] + x["lo"] : x["at"] + x["hi"] + SPAN])
                for c, v in zip(columns, row):
                    c.append(v)
                if len(columns[0]) >= FLUSH:
                    yield _batch(columns, _COVERED)
    yield _batch(columns, _COVERED)


def _cut(batches: Iterator[pa.RecordBatch], pieces: int = 4) -> Iterator[pa.RecordBatch]:
    """Rows over a part of the starts each, with the group of their shared bytes and the signature of what they cover."""
    columns: list[list] = [[] for _ in _SPLIT]
    for b in batches:
        for h, cls, lo, hi, covered, group, first, last in zip(*(b.column(k).to_pylist() for k in range(8))):
            marks = [first + (last - first + 1) * k // pieces for k in range(pieces + 1)]
            for a, after in zip(marks, marks[1:]):
                begin, end = max(a, lo), min(after - 1, hi)
                if begin > end:
                    continue
                shared = covered[after - 1 - lo : a - lo + SPAN]
                row = (h, cls, begin, end, _digest(group, a.to_bytes(4, "little", signed=True), shared), _signature(begin, end, covered[begin - lo : end - lo + SPAN]), a, after - 1)
                for c, x in zip(columns, row):
                    c.append(x)
        if len(columns[0]) >= FLUSH:
            yield _batch(columns, _SPLIT)
    yield _batch(columns, _SPLIT)


_SPLIT = pa.schema([("h", pa.int64()), ("cls", pa.binary()), ("lo", pa.int32()), ("hi", pa.int32()), ("group", pa.binary()), ("sig", pa.binary()), ("first", pa.int32()), ("last", pa.int32())])
_SPLIT_DDL = "h long, cls binary, lo int, hi int, group binary, sig binary, first int, last int"


def _sort_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Suffix arrays over whole groups (rows come sorted by group), several small ones together; repeated starts as ranges."""

    def settled(rows: list[tuple]) -> pa.RecordBatch:
        out: tuple[list, ...] = ([], [], [], [])
        for (h, cls, lo, covered), mark in zip(rows, repeated_starts([r[3] for r in rows])):
            for a, z in runs(mark):
                for c, x in zip(out, (h, cls, lo + a, lo + z)):
                    c.append(x)
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, (pa.int64(), pa.binary(), pa.int32(), pa.int32()))], ["h", "cls", "a", "z"])

    rows, size, group = [], 0, None
    for b in batches:
        for g, h, cls, lo, covered in zip(*(b.column(k).to_pylist() for k in range(5))):
            if g != group and size >= BATCH:
                yield settled(rows)
                rows, size = [], 0
            rows.append((h, cls, lo, covered))
            size, group = size + len(covered), g
    if rows:
        yield settled(rows)


# --- the operator -------------------------------------------------------------------------------


def _dealt(spark: SparkSession) -> int:
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)


def _by_suffix_arrays(groups: DataFrame) -> DataFrame:
    """(h, cls, a, z): repeated starts of groups of bounded size."""
    rows = groups.select("group", "h", "cls", "lo", "covered").repartition(_dealt(groups.sparkSession), "group").sortWithinPartitions("group")
    return rows.mapInArrow(_sort_groups, "h long, cls binary, a int, z int")


def repeats_among(classes: DataFrame, group_most: int = GROUP) -> tuple[DataFrame, list[DataFrame]]:
    """(h, cls, a, z): ranges of repeated starts among the classes (h, cls, lo, hi, covered) of each anchor hash; and the tables they are read from."""
    found, tables = [], []
    width = SPAN - INNER
    level = classes.withColumns({"group": F.unhex(F.hex("h")), "first": F.lit(-width), "last": F.lit(0)})
    whole = classes.select("h", "cls", F.col("lo").alias("_lo"), F.col("covered").alias("_all"))
    for _ in range(width.bit_length() + 2):
        split = materialize(level.select("h", "cls", "lo", "hi", "covered", "group", "first", "last").mapInArrow(_cut, _SPLIT_DDL), "suffix-split")
        facts = [F.first(c).alias(c) for c in ("lo", "hi", "first", "last")]  # equal for all rows of a signature
        alike = materialize(split.groupBy("group", "sig").agg(F.count("*").alias("n"), F.min(F.struct("h", "cls")).alias("rep"), *facts), "suffix-alike")
        sizes = materialize(alike.groupBy("group").agg(F.count("*").alias("k")).where("k > 1"), "suffix-sizes")
        same = split.join(alike.where("n > 1").select("group", "sig").hint("merge"), ["group", "sig"])
        found.append(same.select("h", "cls", F.col("lo").alias("a"), F.col("hi").alias("z")))
        # of each signature one stays; only these need their bytes
        reps = alike.select("group", "rep.h", "rep.cls", "lo", "hi", "first", "last").join(sizes.hint("merge"), "group")
        covered = F.substring("_all", F.col("lo") - F.col("_lo") + 1, F.col("hi") - F.col("lo") + SPAN).alias("covered")
        level = materialize(reps.join(whole.hint("merge"), ["h", "cls"]).select("h", "cls", "lo", "hi", covered, "group", "first", "last", "k"), "suffix-level")
        found.append(_by_suffix_arrays(level.where(F.col("k") <= group_most)))
        tables += [split, alike, sizes, level]
        level = level.where(F.col("k") > group_most)
        if level.isEmpty():
            break
    out = found[0]
    for f in found[1:]:
        out = out.unionByName(f)
    return out, tables


def repeated_spans(keyed: DataFrame) -> DataFrame:
    """(u1, u2, spans): per document key, the byte ranges (begin, end) to remove; ``keyed`` has (u1, u2, text)."""
    found = materialize(keyed.select("u1", "u2", "text").mapInArrow(_find_anchors, "u1 long, u2 long, h long, at long, lo int, hi int, cls binary"), "suffix-anchors")
    often = materialize(found.groupBy("h").agg(F.count("*").alias("n")).where("n > 1").select("h"), "suffix-often")
    rows = materialize(found.join(often.hint("merge"), "h"), "suffix-rows")
    release(found, often)
    classes = rows.groupBy("h", "cls").agg(F.count("*").alias("n"), F.min(F.struct("u1", "u2", "at", "lo", "hi")).alias("r"))
    classes = materialize(classes.select("h", "cls", "n", "r.*"), "suffix-classes")
    mixed = materialize(classes.groupBy("h").agg(F.count("*").alias("k")).where("k > 1").select("h"), "suffix-mixed")
    wanted = classes.join(mixed.hint("merge"), "h").groupBy("u1", "u2").agg(F.collect_list(F.struct("h", "cls", "at", "lo", "hi")).alias("wanted"))
    one_each = wanted.join(keyed.select(F.col("u1").alias("_1"), F.col("u2").alias("_2"), "text"), (F.col("u1") == F.col("_1")) & (F.col("u2") == F.col("_2")))
    # equal documents (same id and text) fetch their classes more than once: these are copies already
    covered = materialize(one_each.select("text", "wanted").mapInArrow(_fetch, "h long, cls binary, lo int, hi int, covered binary"), "suffix-covered")
    ranges, tables = repeats_among(covered)
    ranges = materialize(ranges, "suffix-ranges")
    release(mixed, covered, *tables)
    copies = classes.where("n > 1").select("h", "cls", F.col("lo").alias("a"), F.col("hi").alias("z"))
    repeats = materialize(ranges.unionByName(copies).distinct(), "suffix-repeats")
    spans = rows.join(repeats.hint("merge"), ["h", "cls"]).select("u1", "u2", (F.col("at") + F.col("a")).alias("begin"), (F.col("at") + F.col("z") + SPAN).alias("end"))
    spans = spans.groupBy("u1", "u2").agg(F.collect_set(F.struct("begin", "end")).alias("spans"))
    spans = materialize(spans, "suffix-spans")
    release(rows, classes, ranges, repeats)
    return spans


def with_key(docs: DataFrame) -> DataFrame:
    """``docs`` with (u1, u2), a 128-bit key of id and text."""
    return docs.withColumns({f"u{k}": F.xxhash64(F.lit(k), F.col("doc_id").isNull(), "doc_id", "text") for k in (1, 2)})


def kept_bytes(data: bytes, spans: list[tuple[int, int]]) -> tuple[list[tuple[int, int]], bytes]:
    """Maximal removed runs and what remains."""
    merged: list[list[int]] = []
    for a, z in sorted(spans):
        if merged and a <= merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], z)
        else:
            merged.append([a, z])
    at, out = 0, []
    for a, z in merged:
        out.append(data[at:a])
        at = z
    out.append(data[at:])
    return [(a, z) for a, z in merged], b"".join(out)


def remove_repeats(docs: DataFrame) -> DataFrame:
    """(doc_id, n_bytes, spans, kept) of every row: removed byte runs and the remaining bytes."""
    keyed = with_key(docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")))
    spans = repeated_spans(keyed).withColumnsRenamed({"u1": "_1", "u2": "_2"})
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n, removed, kept = [], [], []
            for text, s in zip(b.column(1), b.column(2)):
                data = text.as_py().encode()
                runs_, rest = kept_bytes(data, [(x["begin"], x["end"]) for x in s.as_py() or ()])
                n.append(len(data))
                removed.append([{"begin": a, "end": z} for a, z in runs_])
                kept.append(rest)
            span = pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64()), pa.array(removed, span), pa.array(kept, pa.binary())], ["doc_id", "n_bytes", "spans", "kept"])

    joined = keyed.join(spans, (F.col("u1") == F.col("_1")) & (F.col("u2") == F.col("_2")), "left").select("doc_id", "text", "spans")
    return joined.mapInArrow(run, f"doc_id {kind}, n_bytes long, spans array<struct<begin:long,end:long>>, kept binary")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = remove_repeats(table(spark, sf_dir, "documents"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda s, x: s + x["end"] - x["begin"])
    counted = out.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
    return counted.withColumn("repeats", F.col("n_removed") > 0)


SQL = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, hex(encode(coalesce(text, ''))) AS x FROM documents),
c AS (SELECT doc_id, s, substring(x, 2 * s + 1, 1310) AS part FROM (SELECT doc_id, unnest(range(0, greatest(len(x) // 2 - 399, 0), 256)) AS s, x FROM d)),
g AS (SELECT doc_id, s + q AS p, md5(substring(part, 2 * q + 1, 800)) AS g FROM (SELECT doc_id, s, part, unnest(range(0, least(256, len(part) // 2 - 399))) AS q FROM c)),
r AS (SELECT doc_id, p FROM g WHERE g IN (SELECT g FROM g GROUP BY g HAVING count(*) > 1)),
s AS (SELECT doc_id, p, CASE WHEN p <= lag(p) OVER o + 400 THEN 0 ELSE 1 END AS fresh FROM r WINDOW o AS (PARTITION BY doc_id ORDER BY p)),
n AS (SELECT doc_id, p, sum(fresh) OVER (PARTITION BY doc_id ORDER BY p) AS k FROM s),
spans AS (SELECT doc_id, k, min(p) AS a, max(p) + 400 AS z FROM n GROUP BY doc_id, k),
gaps AS (SELECT d.doc_id, coalesce(z, 0) AS a, coalesce(lead(s.a) OVER (PARTITION BY d.doc_id ORDER BY z), len(x) // 2) AS z, x
  FROM d JOIN (SELECT doc_id, a, z FROM spans UNION ALL SELECT doc_id, NULL, 0 FROM d) s USING (doc_id)),
kept AS (SELECT doc_id, string_agg(substring(x, 2 * a + 1, 2 * (z - a)), '' ORDER BY a) AS h FROM gaps GROUP BY doc_id),
m AS (SELECT doc_id, sum(z - a) AS n_removed, count(*) AS n_spans FROM spans GROUP BY doc_id)
SELECT d.doc_id, CAST(len(x) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans,
  sha256(unhex(h)) AS kept_sha256, coalesce(n_removed, 0) > 0 AS repeats
FROM d LEFT JOIN m USING (doc_id) JOIN kept USING (doc_id)
"""
