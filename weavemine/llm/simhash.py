"""Operator 10: SimHash near-duplicates over a byte-position inverted index with count filtering.

Fingerprints (64 bits, 8 bytes) at most 2 bits apart differ in at most 2 byte
positions, so they share at least 6 of the 8 positional bytes. Posting single
positional bytes would put a 256th of all fingerprints into every posting, so
the index posts fours of positional bytes: the 14 fours of positions whose
numbers cancel out (exclusive or), a design in which two fingerprints that share
6, 7 or 8 positions have 3, 7 or 14 fours in common, and any that share fewer at
most one. The postings a pair has in common are tallied, pairs that reach the
guaranteed minimum of ``MINIMUM`` are retained, and those are verified by counting
differing bits. The tally alone tells 6 shared bytes from 5: no fingerprint is
looked into before that.

A hot posting, of more than ``POSTING`` different fingerprints, is split instead
of paired up: its members go to the points one bit around them (two
fingerprints are within 2 bits exactly if their one-bit neighbourhoods meet)
and are linked to the least member at each point, 65 rows a fingerprint. That
finds every link of a pair that shares a hot posting, so no posting is dropped or
capped and work stays in proportion to the number of fingerprints.

Defined results: null or wordless text has the zero fingerprint and links like
any other; fewer words than a shingle: the whole sequence is the one shingle; a
bit set in exactly half of the shingles is 0;
repeated rows and null ids: each row is returned, null ids never name a
component that has another id; an empty table gives no rows; texts of any length are
hashed in blocks of shingles. Columns other than
the id and the text are neither read nor named.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from weavemine.operators.components import connected_components
from weavemine.session import materialize, table

NAME = "op10_simhash_components"
SHINGLE, SEED, BITS, POSTING = 3, 42, 2, 64
BLOCK = 1 << 16
#: Fours of byte positions: 6 shared positions hold 3 of them, 5 hold one at most.
FOURS = [f for f in combinations(range(8), 4) if f[0] ^ f[1] ^ f[2] ^ f[3] == 0]
MINIMUM = 3


def simhash(text: str | None, shingle: int = SHINGLE) -> int:
    """The signed 64-bit fingerprint of a text; shingles are hashed in blocks, so memory is bounded by the text itself."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: A-Z only, ASCII white space only
    if not words:
        return 0
    joined = b" ".join(words)
    n = max(1, len(words) - shingle + 1)
    span = min(shingle, len(words))
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = (ends - np.fromiter(map(len, words), np.int64, len(words)))[:n].tolist()
    stops = ends[span - 1 :].tolist()
    ones = np.zeros(64, np.int64)
    digest = xxhash.xxh64_intdigest
    for k in range(0, n, BLOCK):
        h = np.array([digest(joined[a:b], SEED) for a, b in zip(starts[k : k + BLOCK], stops[k : k + BLOCK])], np.uint64)
        ones += set_bits(h)
    return over_half(ones, n)


def set_bits(h: np.ndarray) -> np.ndarray:
    """How many of the hashes have each bit set."""
    return np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)


def over_half(ones: np.ndarray, n: int) -> int:
    """The signed fingerprint whose bits are set in over half of n hashes."""
    return int(np.packbits(ones * 2 > n, bitorder="little").view(np.int64)[0])


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, fp) for every row of ``docs``."""
    kind = docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = pa.array((simhash(t) for t in b.column(1).to_pylist()), pa.int64())
            yield pa.RecordBatch.from_arrays([b.column(0), fp], ["k", "fp"])

    return docs.select(docs[key].alias("k"), docs[text].alias("t")).mapInArrow(run, f"k {kind}, fp long").withColumnRenamed("k", key)


def _postings(fp: Column) -> Column:
    """One key for each four of positions: which, and the four bytes in their places."""
    keys = []
    for n, four in enumerate(FOURS):
        mask = sum(0xFF << (8 * p) for p in four)
        mask -= (mask >> 63) << 64
        keys.append(F.struct(F.lit(n).cast("byte").alias("which"), fp.bitwiseAND(F.lit(mask)).alias("bytes")))
    return F.explode(F.array(*keys))


def links(distinct_fps: DataFrame, bits: int = BITS, posting: int = POSTING) -> DataFrame:
    """(src, dst) whose components are those of "at most 2 bits apart" among the distinct ``fp``."""
    if bits != 2:
        raise ValueError("the postings guarantee two bits")
    posted = distinct_fps.select("fp", _postings(F.col("fp")).alias("p")).select("fp", "p.which", "p.bytes")
    sizes = posted.groupBy("which", "bytes").agg(F.count("*").alias("n")).where("n > 1")
    shared = materialize(posted.join(sizes, ["which", "bytes"]), "postings")
    cold = shared.where(F.col("n") <= posting).select("which", "bytes", "fp")
    pairs = cold.join(cold.withColumnRenamed("fp", "gp"), ["which", "bytes"]).where("fp < gp")
    tallied = pairs.groupBy("fp", "gp").agg(F.count("*").alias("hits")).where(F.col("hits") >= MINIMUM)
    near = tallied.where(F.bit_count(F.col("fp").bitwiseXOR(F.col("gp"))) <= bits).select(F.col("fp").alias("src"), F.col("gp").alias("dst"))
    flips = F.array(F.lit(0).cast("long"), *[F.lit((1 << k) - ((1 << 64) if k == 63 else 0)).cast("long") for k in range(64)])
    around = (
        shared.where(F.col("n") > posting).select("fp").distinct()
        .select("fp", F.explode(flips).alias("flip")).select("fp", F.col("fp").bitwiseXOR(F.col("flip")).alias("point"))
    )
    least = around.groupBy("point").agg(F.min("fp").alias("dst"), F.count("*").alias("n")).where("n > 1").drop("n")
    hubs = around.join(least, "point").where("fp != dst").select(F.col("fp").alias("src"), "dst").distinct()
    return near.unionByName(hubs).distinct()


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, fp, component): component is the least key among documents reachable by links of at most 2 bits."""
    fps = materialize(fingerprints(docs, key, text), "simhash")
    distinct = materialize(fps.groupBy("fp").agg(F.min(key).alias("least")), "simhash-distinct")
    found = materialize(connected_components(links(distinct)), "simhash-components")
    rooted = distinct.join(found, distinct["fp"] == found["node"], "left").select(
        "fp", "least", F.coalesce("component", "fp").alias("root")
    )
    least = rooted.groupBy("root").agg(F.min("least").alias("component"))
    named = materialize(rooted.select("fp", "root").join(least, "root").select(F.col("fp").alias("_fp"), "component"), "simhash-named")
    return fps.join(named, fps["fp"] == named["_fp"]).select(key, "fp", "component")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = near_duplicates(table(spark, sf_dir, "documents"))
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), F.col("component").alias("component_id"))
