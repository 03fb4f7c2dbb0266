"""Operator 11: byte-level BPE over length-bucketed, padded numpy matrices.

The words of a batch of texts (matches of the splitting pattern) that are not
tokens themselves become rows of matrices: a row a word, padded to the power of
two that holds it, a matrix for every such width. In each round every row merges
its leftmost pair of minimum rank, all rows at once; ranks of pairs come from an
open-addressing hash table, and rows are compacted by a mask. A row in which the
same pair stands again merges these places in the same round, as long as no
token that begins or ends with the merged one has a lower rank; the order of
merges is then the same as one at a time. Words are cut before they become
rows wherever two bytes meet that no token holds side by side: no merge can
cross such a place. Only the pairs at a merged place are looked up anew.

What words encode to is kept in a memo of two generations of bounded size.
Decoding joins the bytes of the ids.

The splitting pattern must begin a match at every single space that stands
between other characters, as those of byte-level vocabularies do.

Defined results: null is read as the empty text; an empty text has no tokens;
a text of any length is split in pieces at single spaces between other
characters, where a match always begins, so that what stands in memory besides
the text and its ids is bounded. A word of any length is one row; one without
repeats takes a round a pair. Repeated rows are encoded each; an empty table
gives no rows; other columns are carried along unread, and those with the names
of results are replaced. The rank file is read by the driver and travels with
the job, so executors need no file.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import ArrayType, IntegerType

from weavemine.session import table

NAME = "op11_padded_bpe"
NONE = np.int32(2**31 - 1)
EMPTY = np.uint64(2**64 - 1)
MIX = np.uint64(0x9E3779B97F4A7C15)
PIECE = 1 << 20
CELLS = 1 << 21
TEXTS = 256
#: In rows wider than this a pair that stands several times is looked for.
REPEATS = 32
MEMO, MEMO_CHARS = 400_000, 48
CUT_AT = regex.compile(r"(?<=\S) (?=\S)")
LETTERS = r" ?\p{L}+"
RUN = regex.compile(r"\s{2,}")
#: A space next to white space: then what follows the space need not begin a match.
MEETING = [x for c in map(chr, range(0x3001)) if regex.match(r"\s", c) for x in (c + " ", " " + c)]


class PairTable:
    """Ranks of pairs of ids: keys and values in arrays of a power of two, linear probing, looked up for whole arrays."""

    def __init__(self, left: np.ndarray, right: np.ndarray, rank: np.ndarray):
        self.bits = max(4, int(2 * len(rank)).bit_length())
        self.mask = np.int64((1 << self.bits) - 1)
        self.keys = np.full(1 << self.bits, EMPTY)
        self.ranks = np.full(1 << self.bits, NONE, np.int32)
        key = self._key(left, right)
        slot, todo = self._slot(key), np.arange(len(key))
        while len(todo):
            at = slot[todo]
            free = self.keys[at] == EMPTY
            self.keys[at[free]] = key[todo[free]]  # of several for one slot the last stays
            won = self.keys[at] == key[todo]
            self.ranks[at[won]] = rank[todo[won]]
            todo = todo[~won]
            slot[todo] = (slot[todo] + 1) & self.mask

    @staticmethod
    def _key(left: np.ndarray, right: np.ndarray) -> np.ndarray:
        return (left.astype(np.uint64) << np.uint64(32)) | right.astype(np.uint64)

    def _slot(self, key: np.ndarray) -> np.ndarray:
        return ((key * MIX) >> np.uint64(64 - self.bits)).astype(np.int64)

    def get(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of each pair, NONE where no token joins it."""
        key = self._key(left, right)
        slot = self._slot(key)
        out = np.full(len(key), NONE, np.int32)
        todo = np.arange(len(key))
        while len(todo):
            found = self.keys[slot[todo]]
            hit = found == key[todo]
            out[todo[hit]] = self.ranks[slot[todo[hit]]]
            todo = todo[~hit & (found != EMPTY)]
            slot[todo] = (slot[todo] + 1) & self.mask
        return out


class ByteBPE:
    """Ranks of a byte-level vocabulary, where a token's id is its rank."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.pattern = regex.compile(pattern)
        self.ranks = ranks
        self.tokens = [b""] * (max(ranks.values()) + 1)
        for t, r in ranks.items():
            self.tokens[r] = t
        self.byte = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        pairs: list[tuple[int, int, int]] = []
        #: Whether a merge to this token never makes a pair of lower rank.
        self.settled = np.ones(len(self.tokens), bool)
        #: Whether some token holds the two bytes side by side.
        self.joined = np.zeros((256, 256), bool)
        get = ranks.get
        for t, r in ranks.items():
            for k in range(1, len(t)):
                a, b = get(t[:k]), get(t[k:])
                if a is not None and b is not None:
                    pairs.append((a, b, r))
                for x in (a, b):
                    if x is not None and x > r:
                        self.settled[x] = False
                self.joined[t[k - 1], t[k]] = True
        a, b, r = np.array(pairs or np.empty((0, 3)), np.int64).T
        self.pairs = PairTable(a, b, r.astype(np.int32))
        #: Words that are tokens.
        self.known = {t.decode(): np.uint32(r).tobytes() for t, r in ranks.items() if t.decode("utf-8", "ignore").encode() == t}
        before, letters, _ = pattern.partition(LETTERS)
        #: Whether a chunk can have several words. Letters that all tables know are one, if only marks are looked for before letters.
        self.splits = regex.compile(r"(?! ?[A-Za-z]+\Z)").match if letters and all(x[:1] == "'" for x in before.split("|")[:-1]) else bool
        self.memo: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def merged(self, sym: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows of symbols (padded) after all merges, with their lengths."""
        n, w = sym.shape
        out, out_size, rows = sym.copy(), size.copy(), np.arange(n)
        rank = np.full((n, w), NONE, np.int32)
        r, c = np.nonzero(np.arange(1, w) < size[:, None])
        rank[r, c] = self.pairs.get(sym[r, c], sym[r, c + 1])
        while len(rows):
            place = rank.argmin(axis=1)
            least = rank[np.arange(len(rows)), place]
            more = least < NONE
            if not more.all():
                at = rows[~more]
                out[at, : sym.shape[1]], out_size[at] = sym[~more], size[~more]
            rows, size, place, least = rows[more], size[more], place[more], least[more]
            if not len(rows):
                break
            if sym.shape[1] > REPEATS:
                sym, rank, size = self._all_places(sym[more], rank[more], size, place, least)
            else:
                sym, rank, size = self._one_place(sym, rank, size, place, least, np.flatnonzero(more))
        return out, out_size

    def _one_place(self, sym, rank, size, place, least, rows):
        """Each of these rows with the pair at its place merged and what follows moved to the left."""
        w = sym.shape[1]
        cols = np.arange(w - 1)
        cell = cols + (cols > place[:, None]) + (rows * w)[:, None]
        sym, rank, size = sym.ravel()[cell], rank.ravel()[cell], size - 1
        each = np.arange(len(rows))
        sym[each, place] = least
        rank[each, place] = NONE
        for r, c in ((each[place > 0], place[place > 0] - 1), (each[place + 1 < size], place[place + 1 < size])):
            rank[r, c] = self.pairs.get(sym[r, c], sym[r, c + 1])
        return sym, rank, size

    def _all_places(self, sym, rank, size, place, least):
        """The same, but with every place merged where the row has its minimum and the order of merges cannot matter."""
        cols = np.arange(sym.shape[1])
        here = rank == least[:, None]
        single = ~self.settled[least]
        here[single] = cols == place[single][:, None]
        if (here[:, 1:] & here[:, :-1]).any():  # places that overlap: every other one of a run, from its left
            first = here.copy()
            first[:, 1:] &= ~here[:, :-1]
            here &= (cols - np.maximum.accumulate(np.where(first, cols, 0), axis=1)) % 2 == 0
        sym = np.where(here, least[:, None], sym)
        stays = cols < size[:, None]
        stays[:, 1:] &= ~here[:, :-1]
        size = stays.sum(axis=1)
        kept = np.arange(int(size.max())) < size[:, None]
        sym, rank, here = _moved(sym, stays, kept, -1), _moved(rank, stays, kept, NONE), _moved(here, stays, kept, False)
        here[:, :-1] |= here[:, 1:]
        r, c = np.nonzero(here)
        rank[r, c] = NONE
        inside = c + 1 < size[r]
        r, c = r[inside], c[inside]
        rank[r, c] = self.pairs.get(sym[r, c], sym[r, c + 1])
        return sym, rank, size

    def encode_words(self, words: list[bytes]) -> list[bytes]:
        """Per word (none of them a token) its ids as unsigned 32-bit integers in this machine's byte order."""
        if not words:
            return []
        flat = np.frombuffer(b"".join(words), np.uint8)
        ends = np.cumsum([len(x) for x in words])
        cut = np.ones(len(flat), bool)  # where rows begin
        cut[1:] = ~self.joined[flat[:-1], flat[1:]]
        cut[ends[:-1]] = True
        begin = np.flatnonzero(cut)
        size = np.diff(np.append(begin, len(flat)))
        count = size.copy()
        ids: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        width = np.frexp(np.maximum(size - 1, 0).astype(np.float64))[1]  # its power of two holds the row
        for e in np.unique(width):
            own, w = np.flatnonzero(width == e), 1 << int(e)
            step = max(1, CELLS // w)
            for k in range(0, len(own), step):
                part = own[k : k + step]
                filled = np.arange(w) < size[part][:, None]
                sym = np.full((len(part), w), -1, np.int32)
                sym[filled] = self.byte[flat[(begin[part][:, None] + np.arange(w))[filled]]]
                sym, count[part] = self.merged(sym, size[part])
                kept = np.arange(w) < count[part][:, None]
                ids.append((part, kept, sym[kept]))
        starts = np.cumsum(count) - count
        out = np.empty(int(count.sum()), np.uint32)
        for part, kept, got in ids:
            out[(starts[part][:, None] + np.arange(kept.shape[1]))[kept]] = got
        first = starts[np.searchsorted(begin, np.append(0, ends[:-1]))]
        raw, bounds = out.tobytes(), (4 * np.append(first, len(out))).tolist()
        return [raw[a:b] for a, b in zip(bounds, bounds[1:])]

    @staticmethod
    def pieces(text: str) -> Iterator[str]:
        """The text in pieces of about PIECE characters, cut where a match begins."""
        begin = 0
        while len(text) - begin > PIECE and (m := CUT_AT.search(text, begin + PIECE)):
            yield text[begin : m.start()]
            begin = m.start()
        yield text[begin:] if begin else text

    @staticmethod
    def chunks(text: str) -> list[str]:
        """The text cut at every single space between other characters, where a match always begins.

        A chunk that begins with such a space is given without it, any other one with a space before it.
        """
        if not any(x in text for x in MEETING):
            out = text.split(" ")
            out[0] = " " + out[0]
            return out
        out, begin, inner = [], 0, 0
        for m in (*RUN.finditer(text), None):
            first, *rest = text[inner : m.start() if m else len(text)].split(" ")
            out.append(" " + text[begin:inner] + first)  # white space of two or more characters goes with what follows
            out += rest
            if m:
                begin, inner = m.span()
        return out

    def _learn(self, chunks: set[str]) -> None:
        """Put the ids of these chunks into the memo."""
        memo, older, known, find, splits = self.memo, self.older, self.known.get, self.pattern.findall, self.splits
        single, one, several, many, ends = [], [], [], [], []
        for c in chunks:
            if c in older:
                memo[c] = older[c]
                continue
            text = c[1:] if c[:1] == " " else " " + c
            if splits(text):
                several.append(c)
                many += find(text)
                ends.append(len(many))
            elif (ids := known(text)) is not None:
                memo[c] = ids
            else:
                single.append(c)
                one.append(text)
        distinct = {*many}
        words = {w: self.known[w] for w in distinct if w in self.known}
        new = [*distinct.difference(words)]
        ids = self.encode_words([w.encode() for w in one + new])
        memo.update(zip(single, ids))
        words.update(zip(new, ids[len(one) :]))
        every, begin = [*map(words.__getitem__, many)], 0
        for c, end in zip(several, ends):
            memo[c] = b"".join(every[begin:end])
            begin = end

    def encode_texts(self, texts: list[str | None]) -> list[bytes]:
        """The ids of each text, as of encode_words."""
        out: list[list[bytes]] = [[] for _ in texts]
        for block in self._blocks(texts):
            cut = [(k, self.chunks(piece)) for k, piece in block]
            chunks = set().union(*[x for _, x in cut])
            unknown = chunks.difference(self.memo)
            self._learn(unknown)
            ids = {c: self.memo[c] for c in chunks}  # a small table of the block's own
            for k, own in cut:
                out[k].append(b"".join(map(ids.__getitem__, own)))
            for c in unknown:
                if len(c) > MEMO_CHARS:
                    del self.memo[c]
            if len(self.memo) > MEMO:
                self.older, self.memo = self.memo, {}
        return [b"".join(x) for x in out]

    def _blocks(self, texts: list[str | None]) -> Iterator[list[tuple[int, str]]]:
        """(index of text, piece) in groups of about PIECE characters."""
        block, size = [], 0
        for k, text in enumerate(texts):
            for piece in self.pieces(text or ""):
                block.append((k, piece))
                size += len(piece)
                if size >= PIECE:
                    yield block
                    block, size = [], 0
        if block:
            yield block

    def decode_bytes(self, ids: bytes) -> bytes:
        tokens = self.tokens
        return b"".join([tokens[i] for i in np.frombuffer(ids, np.uint32).tolist()])


def _moved(x: np.ndarray, stays: np.ndarray, kept: np.ndarray, pad) -> np.ndarray:
    """Rows of ``x`` with the cells that stay moved to the left."""
    out = np.full(kept.shape, pad, x.dtype)
    out[kept] = x[stays]
    return out


def read_ranks(path: str) -> bytes:
    with open(path, "rb") as f:
        return f.read()


_LOADED: dict[str, ByteBPE] = {}


def loaded(ranks: bytes, pattern: str) -> ByteBPE:
    """The vocabulary with its tables, once for each worker process."""
    key = hashlib.sha256(ranks + pattern.encode()).hexdigest()
    if key not in _LOADED:
        lines = [line.split() for line in ranks.splitlines() if line.strip()]
        _LOADED[key] = ByteBPE({base64.b64decode(t): int(r) for t, r in lines}, pattern)
    return _LOADED[key]


def _by_slices(docs: DataFrame, ranks: bytes, pattern: str, text: int, shape, made: Callable[[ByteBPE, pa.RecordBatch, list[bytes]], list]) -> DataFrame:
    """``docs`` through ``made(bpe, batch, ids of its texts)``, a few hundred rows at a time."""
    sent = docs.sparkSession.sparkContext.broadcast(ranks)  # one rank file
    names = [f.name for f in shape]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = loaded(sent.value, pattern)
        for batch in batches:
            for k in range(0, batch.num_rows, TEXTS):
                b = batch.slice(k, TEXTS)
                yield pa.RecordBatch.from_arrays(made(bpe, b, bpe.encode_texts(b.column(text).to_pylist())), names)

    return docs.mapInArrow(run, shape)


def encode(docs: DataFrame, path: str, pattern: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """``docs`` with an array of token ids."""
    kept = [k for k, c in enumerate(docs.columns) if c != ids]
    shape = docs.select(*[docs.columns[k] for k in kept]).schema.add(ids, ArrayType(IntegerType()))

    def made(_: ByteBPE, b: pa.RecordBatch, raw: list[bytes]) -> list:
        ends = np.cumsum([0] + [len(r) // 4 for r in raw]).astype(np.int32)
        return [*(b.column(k) for k in kept), pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(raw), np.int32)))]

    return _by_slices(docs, read_ranks(path), pattern, docs.columns.index(text), shape, made)


def decode(docs: DataFrame, path: str, ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """``docs`` with the bytes that its token ids stand for; null ids give null."""
    sent = docs.sparkSession.sparkContext.broadcast(read_ranks(path))
    kept = [k for k, c in enumerate(docs.columns) if c != decoded]
    shape = docs.select(*[docs.columns[k] for k in kept]).schema.add(decoded, "binary")
    place = docs.columns.index(ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = loaded(sent.value, "")
        for b in batches:
            back = [None if x is None else bpe.decode_bytes(np.array(x, np.uint32).tobytes()) for x in b.column(place).to_pylist()]
            yield pa.RecordBatch.from_arrays([*(b.column(k) for k in kept), pa.array(back, pa.binary())], [f.name for f in shape])

    return docs.mapInArrow(run, shape)


def digests(docs: DataFrame, path: str, pattern: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_tokens, ids_sha256, decoded_sha256) of every row, without moving ids out of the worker."""
    kind = docs.schema[key].dataType.simpleString()
    narrow = docs.select(docs[key].alias("k"), docs[text].alias("t"))
    shape = docs.sparkSession.createDataFrame([], f"k {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string").schema

    def made(bpe: ByteBPE, b: pa.RecordBatch, raw: list[bytes]) -> list:
        ids = [hashlib.sha256(np.frombuffer(r, np.uint32).astype("<u4").tobytes()).hexdigest() for r in raw]
        back = [hashlib.sha256(bpe.decode_bytes(r)).hexdigest() for r in raw]
        return [b.column(0), pa.array([len(r) // 4 for r in raw], pa.int64()), pa.array(ids, pa.string()), pa.array(back, pa.string())]

    return _by_slices(narrow, read_ranks(path), pattern, 1, shape, made).withColumnRenamed("k", key)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return digests(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
