"""Operator 13: spelling variants, by a trie self-join with active-node sets.

Runs of letters are counted to a vocabulary; the operator then joins the
vocabulary with itself on one edit, as the trie of its words does: below each
node only the nodes within one edit of it stay active.

The top of the trie is split in Spark. A node with more than ``leaf`` words
below it is a split node; there the nodes one edit away advance on equal symbols
only, so pairs that part at it are joined on (node, what follows the edit),
where a word stands whole or with its next symbol left out. A key holds a word
per symbol of the alphabet at most, however many words the node has. What is
below the split nodes are subtries of at most ``leaf`` words, joined in a task
each: nodes are ranges of the sorted words, and a node's active set is made of
its parent's. Two words meet in one place only, at their longest common prefix.

A word's form is its near word of largest count, where that is ``factor`` times
its own; forms lead to roots, which are found by pointer doubling.

Defined results: null text holds no words, a null id is read as ''; a run cut to
nothing is no word; repeated rows are counted each; equal counts go to the
smallest word in code-point order; very long texts and words are read whole (the
search for split nodes takes a job for every ``DEPTHS`` letters of the longest
prefix that more than ``leaf`` words share); an empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

import re
import zlib
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weavemine.session import materialize, release, table

NAME = "op13_trie_variants"
LETTERS, OUT_OF = 6, 199
LEAST, FACTOR = 5, 5
#: Words of a subtrie, and split nodes of one depth there may be: with more words in all, subtries are larger.
LEAF, SPLITS = 1000, 20_000
#: Depths that are counted at once.
DEPTHS = 6
#: Counted words that are held before they are given out.
HELD = 200_000


def word_counts(docs: DataFrame, key: str = "doc_id", text: str = "text", letters: int = LETTERS) -> DataFrame:
    """(word, n): runs of at least ``letters`` letters after the deletions that the id and the run decide."""
    runs = re.compile("[A-Za-z\\u00c0-\\u00ff]{%d,}" % letters)

    def given(counts: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([*counts], pa.string()), pa.array([*counts.values()], pa.int64())], ["word", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for b in batches:
            for k, t in zip(b.column(0).to_pylist(), b.column(1)):
                begin = zlib.crc32(f"{k}:".encode())
                own = Counter(runs.findall(t.as_py().encode().lower().decode()))  # bytes: A-Z only
                for w in [w for w in own if zlib.crc32(w.encode(), begin) % OUT_OF == 0]:
                    n = own.pop(w)
                    at = zlib.crc32(w.encode(), begin) % len(w)
                    if len(w) > letters:
                        counts[w[:at] + w[at + 1 :]] += n
                counts.update(own)
                if len(counts) > HELD:
                    yield given(counts)
                    counts = Counter()
        yield given(counts)

    narrow = docs.where(docs[text].isNotNull()).select(F.coalesce(docs[key].cast("string"), F.lit("")).alias("k"), docs[text].alias("t"))
    return narrow.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def split_nodes(words: DataFrame, leaf: int) -> list[str]:
    """The trie nodes with more than ``leaf`` words below. At one depth there are fewer than words / leaf of them."""
    found: list[str] = []
    depth, open_ = 0, None
    while True:
        cut = words if open_ is None else words.where(F.substring("word", 1, depth - 1).isin(open_))
        prefixes = F.transform(F.sequence(F.lit(depth), F.lit(depth + DEPTHS - 1)), lambda d: F.when(F.char_length("word") >= d, F.substring(F.col("word"), F.lit(1), d)))
        got = cut.select(F.explode(F.array_distinct(prefixes)).alias("p")).where("p IS NOT NULL").groupBy("p").count().where(F.col("count") > leaf)
        nodes = [r.p for r in got.select("p").collect()]
        found += nodes
        depth += DEPTHS
        open_ = [p for p in nodes if len(p) == depth - 1]
        if not open_:
            return found


class Subtrie:
    """The trie of sorted words from ``depth`` on. A node is (depth, low, high): the words of that range agree up to the depth."""

    def __init__(self, words: list[str], depth: int):
        self.words, self.index = words, {w: k for k, w in enumerate(words)}
        self.root = (depth, 0, len(words))

    def children(self, node: tuple[int, int, int]) -> list[tuple[str, tuple[int, int, int]]]:
        d, low, high = node
        words, out = self.words, []
        if len(words[low]) == d:
            low += 1
        while low < high:
            c = words[low][d]
            end = high if words[high - 1][d] == c else bisect_left(words, words[low][:d] + chr(ord(c) + 1), low, high)
            out.append((c, (d + 1, low, end)))
            low = end
        return out

    def child(self, node: tuple[int, int, int], c: str) -> tuple[int, int, int] | None:
        d, low, high = node
        words = self.words
        if high - low == 1:
            w = words[low]
            return (d + 1, low, high) if len(w) > d and w[d] == c else None
        begin = words[low][:d] + c
        at = bisect_left(words, begin, low, high)
        if at == high or not words[at].startswith(begin):
            return None
        return d + 1, at, bisect_left(words, words[low][:d] + chr(ord(c) + 1), at, high)

    def pairs(self) -> Iterator[tuple[int, int]]:
        """Indexes (a < b) of all words one edit apart."""
        words, index = self.words, self.index
        below = self.children(self.root)
        todo = [(self.root, below, {v for _, v in below})]
        while todo:
            node, below, active = todo.pop()
            d, low, _ = node
            if len(words[low]) == d:
                for v in active:
                    if v[1] > low and len(words[v[1]]) == v[0]:
                        yield low, v[1]
            for c, m in below:
                near = {v for v in (self.child(v, c) for v in active) if v}
                near.update(v for _, v in below)
                near.add(node)
                if m[2] - m[1] == 1:  # one word: active nodes advance by its rest
                    at, rest = m[1], words[m[1]][d + 1 :]
                    for v in near:
                        if v[2] - v[1] > 1 or v[1] != at:
                            b = index.get(words[v[1]][: v[0]] + rest)
                            if b is not None and b > at:
                                yield at, b
                    continue
                under = self.children(m)
                near.update(v for _, v in under)
                near.discard(m)
                todo.append((m, under, near))


def near_words(words: DataFrame, leaf: int = LEAF) -> DataFrame:
    """(a, n_a, b, n_b): all pairs of different words of (word, n) that are one edit apart, each in one row."""
    spark = words.sparkSession
    leaf = max(leaf, words.count() // SPLITS)
    splits = spark.sparkContext.broadcast(frozenset(split_nodes(words, leaf)))  # fewer than SPLITS for each depth

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hot = splits.value
        for batch in batches:
            rows: list[tuple[str, str, str, str, int]] = []
            for w, n in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                d = 0
                while d <= len(w) and w[:d] in hot:
                    rows.append((w[:d], w[d:], "", w, n))
                    if d < len(w):
                        rows.append((w[:d], w[d + 1 :], w[d], w, n))
                    d += 1
                if d <= len(w):
                    rows.append((w[:d], None, None, w, n))
            yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*rows) if rows else [()] * 5, [pa.string()] * 4 + [pa.int64()])], ["node", "rest", "symbol", "word", "n"])

    at = materialize(words.select("word", "n").mapInArrow(placed, "node string, rest string, symbol string, word string, n long"), "trie")
    parted = at.where("rest IS NOT NULL")
    a, b = parted.where("symbol <> ''").alias("a"), parted.alias("b")
    # left out in both: another symbol; left out in one: the whole word must go on otherwise
    differs = F.when(F.col("b.symbol") != "", F.col("a.symbol") < F.col("b.symbol")).otherwise(~F.col("b.rest").startswith(F.col("a.symbol")))
    top = a.join(b, (F.col("a.node") == F.col("b.node")) & (F.col("a.rest") == F.col("b.rest")) & differs)
    top = top.select(F.col("a.word").alias("a"), F.col("a.n").alias("n_a"), F.col("b.word").alias("b"), F.col("b.n").alias("n_b"))

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for node, words, counts in _subtries(batches):
            found = [*Subtrie(words, len(node)).pairs()]
            for k in range(0, len(found), 10_000):
                x, y = zip(*found[k : k + 10_000])
                yield pa.RecordBatch.from_arrays([pa.array([words[i] for i in x], pa.string()), pa.array([counts[i] for i in x], pa.int64()), pa.array([words[i] for i in y], pa.string()), pa.array([counts[i] for i in y], pa.int64())], ["a", "n_a", "b", "n_b"])

    subtries = at.where("rest IS NULL").select("node", "word", "n").repartition("node").sortWithinPartitions("node", "word")
    return top.unionByName(subtries.mapInArrow(joined, "a string, n_a long, b string, n_b long"))


def _subtries(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, list[str], list[int]]]:
    """(node, words, counts) of each run of equal nodes; UTF-8 order, as Spark sorts, is that of code points."""
    node, words, counts = None, [], []
    for b in batches:
        for k, w, n in zip(*(b.column(i).to_pylist() for i in range(3))):
            if k != node:
                if words:
                    yield node, words, counts
                node, words, counts = k, [], []
            words.append(w)
            counts.append(n)
    if words:
        yield node, words, counts


def variants(words: DataFrame, factor: int = FACTOR, leaf: int = LEAF) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of each row of ``words`` (word, n)."""
    near = near_words(words, leaf)
    both = near.select(F.explode(F.array(F.struct(F.col("a").alias("word"), F.col("n_a").alias("n"), F.col("b").alias("other"), F.col("n_b").alias("m")), F.struct(F.col("b").alias("word"), F.col("n_b").alias("n"), F.col("a").alias("other"), F.col("n_a").alias("m")))).alias("x")).select("x.*")
    best = both.groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("m")).alias("order"), F.col("other"))).alias("best"))
    out = words.join(best, "word", "left").select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(-F.col("best.order") >= factor * F.col("n"), F.col("best")).alias("f"))
    out = materialize(out.select("word", "n", "n_near", F.col("f.other").alias("form"), (-F.col("f.order")).alias("form_n")), "forms")
    step = materialize(out.where("form IS NOT NULL").select("word", F.col("form").alias("root")), "roots")
    while True:  # counts grow by the factor along a path, so a few doublings reach every end
        further = step.select(F.col("word").alias("root"), F.col("root").alias("next"))
        longer = materialize(step.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        moved = not longer.where("moved").isEmpty()
        release(step)
        step = longer.drop("moved")
        step._weavemine_path = longer._weavemine_path
        if not moved:
            break
    return out.join(step, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = word_counts(table(spark, sf_dir, "documents")).where(F.col("n") >= LEAST)
    return variants(materialize(counts, "words"))
