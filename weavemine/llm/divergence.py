"""Operator 12: how far the sources of a language stand apart, by term-block dense matrices.

Every (lang, source) group has a share of each kept term of its language, in
whole billionths and never zero. ``pair`` rows give the chi-square-like distance of
a group from each other source of its language, ``term`` rows the terms that a
group has more of than its language as a whole.

Terms are counted per batch of texts and summed. The kept terms of a language
are dealt by hash to blocks; a block is one dense int64 matrix, groups by terms,
of about ``CELLS`` cells, however many groups there are. A task turns counts to
shares, broadcasts all pairs of groups of its block a few rows at a time, and
gives out the block's pair matrix and, per group, a heap of its ``top`` terms.
Pair matrices are summed and heaps are merged by Spark, so no task sees a whole
language. All arithmetic is in integers.

Defined results: null text, lang and source are read as ''; a text without terms
still makes its group occur; a language without kept terms has distance 0
between all its sources; a source alone in its language has no pair rows;
repeated rows (and repeated or null ids, which are not read) count as documents
of their own; very long texts are counted in pieces cut between terms; an empty
table gives no rows; ties are in order of the item's UTF-8 bytes. Other columns
are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from weavemine.session import materialize, table

NAME = "op12_divergence_tiles"
SCALE = 10**9
LEAST, TOP = 3, 200
CELLS = 1 << 18
#: Counted terms that are held before they are given out, and bytes of text that are split at once.
HELD, PIECE = 200_000, 1 << 20
#: By byte: letters in lower case, other ASCII as a space; bytes of other code points stay.
FOLDED = bytes(b if b >= 128 else b | 32 if chr(b).isalpha() else 32 for b in range(256))


def _terms(text: str) -> Iterator[list[bytes]]:
    """The terms of a text, in lists."""
    raw = text.encode().translate(FOLDED)
    begin = 0
    while len(raw) - begin > PIECE and (end := raw.find(b" ", begin + PIECE)) >= 0:
        yield raw[begin:end].split(b" ")
        begin = end
    yield raw[begin:].split(b" ")



def term_counts(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """(lang, source, term, n, docs): occurrences and documents of each term in each group, and one row with a null term per group."""
    empty = F.lit("")
    narrow = docs.select(*(F.coalesce(docs[c].cast("string"), empty).alias(a) for c, a in ((lang, "lang"), (source, "source"), (text, "text"))))

    def given(counted: dict) -> pa.RecordBatch:
        keys, terms, n, seen = [], [], [], []
        for key, (all_n, all_seen) in counted.items():
            all_n.pop(b"", None)
            keys += [key] * (len(all_n) + 1)
            terms += [None, *all_n]
            n += [0, *all_n.values()]
            seen += [0, *map(all_seen.__getitem__, all_n)]
        langs, sources = [k[0] for k in keys], [k[1] for k in keys]
        columns = [pa.array(langs, pa.string()), pa.array(sources, pa.string()), pa.array(terms, pa.binary()).cast(pa.string()), pa.array(n, pa.int64()), pa.array(seen, pa.int64())]
        return pa.RecordBatch.from_arrays(columns, ["lang", "source", "term", "n", "docs"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from collections import Counter

        counted: dict[tuple[str, str], tuple[Counter, Counter]] = {}
        held = 0
        for b in batches:
            for *key, t in zip(*(b.column(k).to_pylist() for k in range(2)), b.column(2)):
                n, seen = counted.setdefault(tuple(key), (Counter(), Counter()))
                before, own = len(n), set()
                for terms in _terms(t.as_py()):
                    n.update(terms)
                    own.update(terms)
                seen.update(own)
                held += len(n) - before
                if held > HELD:
                    yield given(counted)
                    counted, held = {}, 0
        if counted:
            yield given(counted)

    rows = narrow.mapInArrow(run, "lang string, source string, term string, n long, docs long")
    return rows.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def shares(count: np.ndarray, whole: np.ndarray) -> np.ndarray:
    """1 + floor(SCALE * (count + 1) / whole), with no product over 1000 times ``whole``."""
    out, rest = np.divmod(count + 1, whole)
    for _ in range(3):
        more, rest = np.divmod(rest * 1000, whole)
        out = out * 1000 + more
    return out + 1


def excess(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    d = p - q
    return d * d // q


def _tile(rows: pa.Table, top: int) -> pa.Table:
    """Pair matrix and heaps of one block. Rows without a term are the groups: n their size; total the language's, terms its kept terms."""
    head = rows.filter(pc.is_null(rows["term"])).sort_by("source")
    body = rows.filter(pc.is_valid(rows["term"]))
    sources = head["source"].to_pylist()
    lang, s = head["lang"][0].as_py(), len(sources)
    size, whole, kept = head["n"].to_numpy(), head["total"][0].as_py(), head["terms"][0].as_py()
    terms = sorted(x.encode() for x in pc.unique(body["term"]).to_pylist())
    column = pc.index_in(body["term"].cast(pa.binary()), pa.array(terms, pa.binary())).to_numpy()
    line = pc.index_in(body["source"], head["source"].combine_chunks()).to_numpy()
    count, total = np.zeros((s, len(terms)), np.int64), np.zeros(len(terms), np.int64)
    count[line, column] = body["n"].to_numpy()
    total[column] = body["total"].to_numpy()
    apart = np.zeros((s, s), np.int64)
    picks: list[tuple[int, int, int]] = []
    if terms:
        p, q = shares(count, (size + kept)[:, None]), shares(total, np.int64(whole + kept))
        step = max(1, 4 * CELLS // p.size)
        for k in range(0, s, step):
            apart[k : k + step] = excess(p[k : k + step, None, :], p[None]).sum(axis=2)
        over = (count > 0) & (p > q)
        more = excess(p, q)
        for g in range(s):
            at = np.flatnonzero(over[g])
            for c in at[np.lexsort((at, -more[g, at]))[:top]]:
                picks.append((g, c, more[g, c]))
    a, b = np.nonzero(~np.eye(s, dtype=bool))
    source = [sources[k] for k in a] + [sources[g] for g, _, _ in picks]
    item = [sources[k] for k in b] + [terms[c].decode() for _, c, _ in picks]
    part = ["pair"] * len(a) + ["term"] * len(picks)
    value = [*apart[a, b].tolist(), *(int(v) for _, _, v in picks)]
    return pa.table([pa.array([lang] * len(source), pa.string()), pa.array(source, pa.string()), pa.array(part, pa.string()), pa.array(item, pa.string()), pa.array(value, pa.int64())], ["lang", "source", "part", "item", "value"])


def audit(docs: DataFrame, least: int = LEAST, top: int = TOP) -> DataFrame:
    """(lang, source, part, item, value, rank) of every group of ``docs`` (text, lang, source)."""
    counts = materialize(term_counts(docs), "terms")
    of_term = Window.partitionBy("lang", "term")
    kept = counts.where("term IS NOT NULL").withColumn("seen", F.sum("docs").over(of_term)).where(F.col("seen") >= least)
    kept = kept.select("lang", "source", "term", "n", F.sum("n").over(of_term).alias("total"), F.row_number().over(of_term.orderBy("source")).alias("at"))
    kept = materialize(kept, "kept-terms")
    sizes = kept.groupBy("lang", "source").agg(F.sum("n").alias("n"), F.sum((F.col("at") == 1).cast("long")).alias("terms"))
    groups = counts.where("term IS NULL").select("lang", "source").join(sizes, ["lang", "source"], "left").na.fill(0, ["n", "terms"])
    groups = materialize(groups, "groups")
    langs = groups.groupBy("lang").agg(F.sum("n").alias("whole"), F.sum("terms").alias("kept"), F.count("*").alias("width"))
    langs = langs.withColumn("blocks", F.greatest(F.lit(1), F.ceil(F.col("kept") * (F.col("width") + 1) / F.lit(CELLS))).cast("int"))
    langs = materialize(langs, "langs")
    head = groups.drop("terms").join(langs, "lang").withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    head = head.select("lang", "block", "source", F.lit(None).cast("string").alias("term"), "n", F.col("whole").alias("total"), F.col("kept").alias("terms"))
    body = kept.join(langs.select("lang", "blocks"), "lang").withColumn("block", F.pmod(F.xxhash64("term"), F.col("blocks")).cast("int"))
    body = body.select("lang", "block", "source", "term", "n", "total", F.lit(None).cast("long").alias("terms"))
    tiles = head.unionByName(body).groupBy("lang", "block").applyInArrow(lambda t: _tile(t, top), "lang string, source string, part string, item string, value long")
    tiles = materialize(tiles, "tiles")
    group = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    pairs = tiles.where("part = 'pair'").groupBy("lang", "source", "part", "item").agg(F.sum("value").alias("value"))
    best = tiles.where("part = 'term'").withColumn("rank", F.row_number().over(group)).where(F.col("rank") <= top)
    return pairs.withColumn("rank", F.row_number().over(group)).unionByName(best)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(table(spark, sf_dir, "documents"))


SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS k, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z\x{80}-\x{10FFFF}]+') AS words
  FROM documents),
t AS (SELECT k, lang, source, unnest(words) AS term FROM d),
kept AS (SELECT lang, term, count(*) AS total FROM t GROUP BY lang, term HAVING count(DISTINCT k) >= 3),
c AS (SELECT lang, source, term, count(*) AS n FROM t SEMI JOIN kept USING (lang, term) GROUP BY lang, source, term),
g AS (SELECT lang, source, coalesce(sum(n), 0)::BIGINT AS size FROM (SELECT DISTINCT lang, source FROM d) LEFT JOIN c USING (lang, source) GROUP BY lang, source),
l AS (SELECT lang, sum(total)::BIGINT AS whole, count(*) AS v FROM kept GROUP BY lang),
p AS (
  SELECT g.lang, g.source, kept.term, coalesce(c.n, 0) AS n,
    (1 + 1000000000::HUGEINT * (coalesce(c.n, 0) + 1) // (g.size + l.v)) AS p,
    (1 + 1000000000::HUGEINT * (kept.total + 1) // (l.whole + l.v)) AS q
  FROM g JOIN l USING (lang) JOIN kept USING (lang) LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = kept.term),
pairs AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p)::BIGINT AS value
  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
  UNION ALL
  SELECT a.lang, a.source, b.source, 0 FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source WHERE a.lang NOT IN (SELECT lang FROM l)),
terms AS (SELECT lang, source, term AS item, ((p - q) * (p - q) // q)::BIGINT AS value FROM p WHERE n > 0 AND p > q)
SELECT lang, source, 'pair' AS part, item, value, row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item)::INT AS rank FROM pairs
UNION ALL
SELECT lang, source, 'term', item, value, row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item)::INT AS r FROM terms QUALIFY r <= 200
"""
