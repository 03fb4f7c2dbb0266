"""Operator 3: embedding near-duplicates by randomised-rotation binary codes.

Every unit vector o is turned by a fixed random rotation and stored as the
signs of its coordinates, a code ō on the sphere, with the correction factor
f = <ō, o>; both are stored with the vector, once. For another vector q, <ō, q> / f estimates <o, q> without bias, and
since q cannot be nearer to o than the angle between q and ō less that between
ō and o, <o, q> is at most cos(angle(ō, q) - arccos f). This bound holds with
confidence 1 (on 64 coordinates it is as tight as one of three standard errors),
so pairs whose bound is below the threshold are settled by the code and all
others are recomputed exactly, in double precision.

Vectors are compared within a label only. Equal vectors of a label are one
class; classes of a label are dealt by hash to blocks of about ``BLOCK``, and
each pair of blocks is one bounded piece of work. A piece returns, for each of
its classes that has links, how many rows it links to and the least class it is
joined with there: never the pairs. Work inside one label is quadratic in its
classes (exact all-pairs comparison), spread evenly over the pieces.

Defined results: a vector that is null, empty, zero or holds a null or
non-finite component, or whose label is null, links with nothing; vectors of
different length do not link; equal rows link with each other and count each
other; null ids name a component only where it has no other id; an empty table
gives no rows. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, DoubleType, StructField, StructType

from weavemine.operators.components import connected_components
from weavemine.session import materialize, table

NAME = "op3_rotated_codes"
THRESHOLD, BLOCK, SEED = 0.93, 512, 20240517
SLACK = 1e-4  # of the single-precision estimate


def rotation(d: int, seed: int = SEED) -> np.ndarray:
    """A random rotation of d dimensions, the same in every process."""
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((d, d)))
    return q * np.sign(np.diag(r))


def encode(unit: np.ndarray, turn: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Sign codes (packed bits, a row each) of unit vectors after the rotation, and their correction factors."""
    turned = unit @ (rotation(unit.shape[1]) if turn is None else turn).T
    return np.packbits(turned >= 0, axis=1), np.abs(turned).sum(axis=1) / np.sqrt(unit.shape[1])


def units(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    norm = np.sqrt(np.einsum("ij,ij->i", v, v))
    return v / norm[:, None], norm


def estimates(bits: np.ndarray, factor: np.ndarray, turned: np.ndarray) -> np.ndarray:
    """Unbiased estimates of <o, q> for all codes of vectors o and rotated unit vectors q."""
    d = turned.shape[1]
    signs = np.unpackbits(bits, axis=1, count=d).astype(np.float32) * 2 - 1
    return (signs @ turned.astype(np.float32).T) / (np.float32(np.sqrt(d)) * factor[:, None].astype(np.float32))


def candidates(bits: np.ndarray, factor: np.ndarray, turned: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Pairs whose upper confidence bound reaches the threshold."""
    widest = np.minimum(np.pi, np.arccos(threshold) + np.arccos(np.clip(factor, -1, 1)))
    least = np.cos(widest) / factor  # the bound, solved for the estimate
    return np.nonzero(estimates(bits, factor, turned) >= (least - SLACK)[:, None])


def linked_pairs(a: np.ndarray, b: np.ndarray | None, threshold: float = THRESHOLD, codes: tuple[np.ndarray, np.ndarray] | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers (i, j) of the pairs with cosine of ``threshold`` or more; within ``a`` (i < j) if ``b`` is None.

    ``codes`` are the stored codes and factors of ``a``; only the vectors they are compared with are rotated here.
    """
    ua, na = units(a)
    bits, factor = encode(ua) if codes is None else codes
    ub, nb = (ua, na) if b is None else units(b)
    i, j = candidates(bits, factor, ub @ rotation(ub.shape[1]).T, threshold)
    if b is None:
        i, j = np.minimum(i, j), np.maximum(i, j)
        i, j = np.unique(np.stack([i[i < j], j[i < j]]), axis=1)
        b = a
    keep = []
    for k in range(0, len(i), 1 << 16):
        x, y = i[k : k + (1 << 16)], j[k : k + (1 << 16)]
        keep.append(np.einsum("ij,ij->i", a[x], b[y]) / (na[x] * nb[y]) >= threshold)
    ok = np.concatenate(keep) if keep else np.zeros(0, bool)
    return i[ok], j[ok]


def _matrix(column: pa.ChunkedArray | pa.Array, rows: int) -> np.ndarray:
    chunks = column.chunks if isinstance(column, pa.ChunkedArray) else [column]
    flat = [c.flatten().to_numpy(zero_copy_only=False).astype(np.float64) for c in chunks]
    return np.concatenate(flat).reshape(rows, -1)


def with_codes(classes: DataFrame) -> DataFrame:
    """``classes`` (with ``embedding``, of d components) and the stored ``code`` and ``factor`` of each."""
    shape = StructType([*classes.schema.fields, StructField("code", BinaryType()), StructField("factor", DoubleType())])
    place = classes.columns.index("embedding")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            codes: list[bytes] = []
            factors: list[float] = []
            sizes = b.column(place).value_lengths().to_numpy(zero_copy_only=False)
            ends = np.nonzero(np.diff(sizes))[0] + 1  # runs of equal length
            for begin, end in zip([0, *ends], [*ends, b.num_rows]):
                if end > begin:
                    bits, factor = encode(units(_matrix(b.column(place).slice(begin, end - begin), end - begin))[0])
                    codes += [x.tobytes() for x in bits]
                    factors += factor.tolist()
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(codes, pa.binary()), pa.array(factors, pa.float64())], [f.name for f in shape])

    return classes.mapInArrow(run, shape)


def _roots(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The least row each row is joined with."""
    label = np.arange(n)
    while True:
        was = label.copy()
        low = np.minimum(label[i], label[j])
        np.minimum.at(label, i, low)
        np.minimum.at(label, j, low)
        label = label[label]
        if (label == was).all():
            return label


def _piece(threshold: float):
    def run(t: pa.Table) -> pa.Table:
        t = t.sort_by("ckey")
        mine = t.column("block").to_numpy() == t.column("lo")[0].as_py()
        same = t.column("lo")[0].as_py() == t.column("hi")[0].as_py()
        v = _matrix(t.column("embedding"), t.num_rows)
        bits = np.array([np.frombuffer(x, np.uint8) for x in t.column("code").to_pylist()])
        factor, weight = t.column("factor").to_numpy(), t.column("n").to_numpy()
        if same:
            i, j = linked_pairs(v, None, threshold, (bits, factor))
        else:
            x, y = np.nonzero(mine)[0], np.nonzero(~mine)[0]
            i, j = linked_pairs(v[x], v[y], threshold, (bits[x], factor[x])) if len(x) and len(y) else (np.zeros(0, int), np.zeros(0, int))
            i, j = x[i], y[j]
        links = np.bincount(i, weight[j], t.num_rows) + np.bincount(j, weight[i], t.num_rows)
        root = _roots(t.num_rows, i, j)
        at = pa.array(np.nonzero(links > 0)[0])
        keys = t.column("ckey")
        return pa.table({"ckey": keys.take(at), "links": pa.array(links.astype(np.int64)).take(at), "root": keys.take(pa.array(root)).take(at)})

    return run


def classes_of(vectors: DataFrame) -> DataFrame:
    """``vectors`` (vec_id, embedding, label) with ``ckey``: equal for equal vectors of a label, null for those that cannot link."""
    e = F.col("embedding").cast("array<double>")
    finite = F.forall(e, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    usable = F.col("label").isNotNull() & (F.size(e) > 0) & finite & F.exists(e, lambda x: x != 0)
    text = F.concat_ws("|", F.col("label").cast("string"), F.array_join(F.transform(e, lambda x: x.cast("string")), ","))
    return vectors.select("vec_id", "label", "embedding", F.when(F.coalesce(usable, F.lit(False)), F.md5(text)).alias("ckey"))


def links(classes: DataFrame, threshold: float = THRESHOLD, block: int = BLOCK) -> DataFrame:
    """(ckey, links, root) from every piece of work; classes have (ckey, label, d, embedding, code, factor, n)."""
    sizes = materialize(classes.groupBy("label", "d").agg(F.count("*").alias("m")).where("m > 1"), "vector-sizes")
    spread = classes.join(sizes, ["label", "d"]).withColumn("blocks", F.ceil(F.col("m") / block).cast("int"))
    spread = spread.withColumn("block", F.pmod(F.xxhash64("ckey"), F.col("blocks")).cast("int"))
    dealt = spread.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = dealt.withColumns({"lo": F.least("block", "other"), "hi": F.greatest("block", "other")})
    pieces = dealt.select("label", "d", "lo", "hi", "block", "ckey", "n", "embedding", "code", "factor").groupBy("label", "d", "lo", "hi")
    return pieces.applyInArrow(_piece(threshold), "ckey string, links long, root string")


def near_duplicates(vectors: DataFrame, threshold: float = THRESHOLD, block: int = BLOCK) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row."""
    rows = classes_of(vectors)
    classes = rows.where("ckey IS NOT NULL").groupBy("ckey").agg(
        F.first("label").alias("label"), F.first("embedding").alias("embedding"), F.count("*").alias("n"), F.min("vec_id").alias("least")
    )
    classes = materialize(with_codes(classes.withColumn("d", F.size("embedding"))), "vector-classes")
    found = materialize(links(classes.drop("least"), threshold, block), "vector-links")
    cc = materialize(connected_components(found.select(F.col("ckey").alias("src"), F.col("root").alias("dst"))), "vector-components")
    counted = found.groupBy("ckey").agg(F.sum("links").alias("links"))
    rooted = classes.select("ckey", "n", "least").join(counted, "ckey", "left").join(cc.withColumnRenamed("node", "ckey"), "ckey", "left")
    rooted = materialize(rooted.select("ckey", "n", "least", F.coalesce("links", F.lit(0)).alias("links"), F.coalesce("component", "ckey").alias("root")), "vector-rooted")
    least = materialize(rooted.groupBy("root").agg(F.min("least").alias("component_id")), "vector-least")
    named = rooted.join(least.hint("merge"), "root").select("ckey", (F.col("links") + F.col("n") - 1).alias("n_links"), "component_id")
    named = materialize(named, "vector-named")
    lone = rows.where("ckey IS NULL").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    out = rows.where("ckey IS NOT NULL").select("vec_id", "ckey").join(named, "ckey").select("vec_id", "n_links", "component_id")
    return out.unionByName(lone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "embeddings"))


SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(CAST(embedding AS DOUBLE[]), lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(CAST(embedding AS DOUBLE[]), lambda x: x <> 0)) > 0),
l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
      WHERE list_cosine_similarity(a.e, b.e) >= 0.93),
reach AS (SELECT vec_id AS a, vec_id AS b FROM embeddings UNION SELECT r.a, l.b FROM reach r JOIN l ON l.a = r.b),
c AS (SELECT a AS vec_id, min(b) AS component_id FROM reach GROUP BY a)
SELECT c.vec_id, CAST((SELECT count(*) FROM l WHERE l.a = c.vec_id) AS BIGINT) AS n_links, component_id, c.vec_id = component_id AS kept FROM c
"""
