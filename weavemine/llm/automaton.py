"""Operator 8: BPE encoding and decoding with a compiled merge automaton.

Compilation starts from the automaton of single symbols (one state, an arc for
every symbol) and applies one merge gadget for each rule, in rank order. The
gadget of ``u + v -> w`` adds an arc labelled ``w`` with its own state and
closes every way to read ``v`` right after ``u`` whenever the rule would have
fired there. What remains is deterministic: a state is the last token read,
and the one path that spells a word in open arcs is its encoding. Whether a
gadget closed the arc ``v`` out of state ``u`` follows from the pieces that
stood at both edges while the rules ran (the edge chains kept by the gadgets),
so a transition is worked out the first time it is wanted and looked up in the
table afterwards: the full table over all pairs of tokens would be 2.4e9 cells.

Whatever is read of a word has an encoding of its own, so each place in it has
one state: exactly one of the labels that end there leaves the state of an
earlier place by an open arc. The states that the end of the word rests on are
looked up, each once, and none is ever changed; the arcs between them are the
encoding. A state rests on what was read before it only, so the paths to the
first ``NEAR`` places are tabulated by what they spell, for all words that begin
alike. What a word or an unspaced run of text encodes to is kept in a bounded
memo of two generations. Decoding emits the arc labels.

Defined results: null is read as the empty text; an empty text has no tokens;
texts of any length are read in pieces cut at white space, where no token ends
or begins a match; the vocabulary file is read by the driver and its rules
travel with the job, so executors need no file. Repeated rows are encoded each;
an empty table gives no rows; other columns are carried along unread.
"""

from __future__ import annotations

import hashlib
import json
import re
import string
import unicodedata
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import ArrayType, IntegerType

from weavemine.session import table

NAME = "op8_bpe_automaton"
START = -1
PIECE = 1 << 20
SHORT = (3, 2, 1)
MEMO, ARCS, PATHS, NEAR = 150_000, 200_000, 150_000, 32
CONTROLS = "\x1c\x1d\x1e\x1f"
#: Code points, first and last, that the regex module's Unicode tables have as letters or numbers and the
#: tokenizers library's, which are those of Unicode 16, do not.
NEWER = (
    (0x558, 0x558), (0x58B, 0x58C), (0x88F, 0x88F), (0xC5C, 0xC5C), (0xCDC, 0xCDC), (0x208F, 0x208F), (0x209D, 0x209F), (0xA7CE, 0xA7CF),
    (0xA7D2, 0xA7D2), (0xA7D4, 0xA7D4), (0xA7DD, 0xA7DD), (0xA7E2, 0xA7E2), (0xA7F1, 0xA7F1), (0xAB6C, 0xAB6D), (0x107BB, 0x107BF), (0x10940, 0x10959),
    (0x10EC5, 0x10EC7), (0x10ED9, 0x10EEE), (0x11B0A, 0x11B0A), (0x11DB0, 0x11DDB), (0x11DE0, 0x11DE9), (0x11DF1, 0x11DF1), (0x1246F, 0x1246F),
    (0x12475, 0x1247F), (0x12550, 0x12686), (0x16EA0, 0x16EB8), (0x16EBB, 0x16ED3), (0x16FF2, 0x16FF6), (0x187F8, 0x187FF), (0x18CD6, 0x18CDA),
    (0x18D09, 0x18D20), (0x18D80, 0x18DF2), (0x18E00, 0x19191), (0x191A0, 0x191D2), (0x1B123, 0x1B128), (0x1B168, 0x1B168), (0x1D6A6, 0x1D6A6),
    (0x1DF1F, 0x1DF24), (0x1DF2B, 0x1DF81), (0x1DF90, 0x1DF96), (0x1DFCD, 0x1DFFF), (0x1E6C0, 0x1E6DE), (0x1E6E0, 0x1E6E2), (0x1E6E4, 0x1E6E5),
    (0x1E6E7, 0x1E6ED), (0x1E6F0, 0x1E6F4), (0x1E6FE, 0x1E6FF), (0x2B73A, 0x2B73F), (0x2B81E, 0x2B81E), (0x2CEA2, 0x2CEAD), (0x323B0, 0x33479),
    (0x3D000, 0x3FC3F),
)
NEWER_AT = re.compile("[" + "".join(f"{chr(a)}-{chr(z)}" for a, z in NEWER) + "]")
OLDER = chr(NEWER[0][0])  # code points below it are all old
SYMBOL = "\u2603"  # neither letter, number nor white space
#: Lower case of the capitals that are new in Unicode 16 and 17, which Python's tables do not know.
LOWER_NEW = {0x1C89: 0x1C8A, 0xA7CB: 0x264, 0xA7CC: 0xA7CD, 0xA7CE: 0xA7CF, 0xA7D2: 0xA7D3, 0xA7D4: 0xA7D5, 0xA7DA: 0xA7DB, 0xA7DC: 0x19B}
LOWER_NEW |= {c: c + 0x20 for c in range(0x10D50, 0x10D66)} | {c: c + 0x1B for c in range(0x16EA0, 0x16EB9)}


def byte_symbols() -> list[str]:
    """The printable stand-in of each byte: itself where printable in Latin-1, else the next code point from 256."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = iter(range(256, 512))
    return [chr(b) if b in printable else chr(next(rest)) for b in range(256)]


class MergeAutomaton:
    """Deterministic automaton over tokens, built gadget by gadget."""

    def __init__(self, vocab: dict[str, int], merges: list[tuple[str, str]], suffix: str):
        self.suffix = suffix
        self.labels: list[str] = [""] * (max(vocab.values()) + 1)
        for s, i in vocab.items():
            self.labels[i] = s
        self.rule: dict[tuple[int, int], int] = {}
        never = len(merges)
        symbols = {i for i in vocab.values()}
        made: dict[int, int] = {}
        pairs = []
        for k, (a, b) in enumerate(merges):
            u, v, w = vocab[a], vocab[b], vocab[a + b]
            if w in made:
                raise ValueError(f"two rules make {a + b!r}")
            made[w] = k
            pairs.append((u, v, w))
        symbols -= made.keys()
        #: Per token, the pieces at its left (right) edge over time with the rank of the rule that used each up.
        self.left: dict[int, list[tuple[int, int]]] = {i: [(i, never)] for i in symbols}
        self.right: dict[int, list[tuple[int, int]]] = {i: [(i, never)] for i in symbols}
        self.open: dict[str, int] = {self.labels[i]: i for i in symbols}
        self.table: dict[int, bool] = {}
        self.paths: dict[str, tuple[int, ...]] = {}
        for k, (u, v, w) in enumerate(pairs):
            self._gadget(k, u, v, w, never)
        #: Labels that can stand inside a word, and at its end.
        self.inner = {s: t for s, t in self.open.items() if not suffix or not s.endswith(suffix)}
        self.final = {s.removesuffix(suffix): t for s, t in self.open.items() if s.endswith(suffix)} if suffix else self.inner
        #: By its last four symbols, how long labels can be that end so, longest first.
        lengths: dict[str, set[int]] = {}
        for label in (*self.inner, *self.final):
            if len(label) > 3:
                lengths.setdefault(label[-4:], set()).add(len(label))
        self.ends = {k: (*sorted(v, reverse=True), *SHORT) for k, v in lengths.items()}

    def _gadget(self, k: int, u: int, v: int, w: int, never: int) -> None:
        if u not in self.left or v not in self.left:
            raise ValueError("a rule joins what no earlier rule makes")
        reachable = self.labels[u] in self.open and self.labels[v] in self.open and not self._closed(u, v)
        self.rule[u, v] = k
        self.left[w] = [(w, never), (u, k), *self.left[u][1:]]
        self.right[w] = [(w, never), (v, k), *self.right[v][1:]]
        if reachable:  # else an earlier rule always fires first and no text is ever read as w
            self.open[self.labels[w]] = w

    def _closed(self, u: int, v: int) -> bool:
        """Whether some rule so far fires across the edge between the tokens u and v.

        It does if both its pieces stand at the edge when its turn comes. Equal
        turns go to the left: the left piece may be gone already, the right one is still there.
        """
        rule = self.rule
        for a, gone_a in self.right[u]:
            for b, gone_b in self.left[v]:
                k = rule.get((a, b))
                if k is not None and k < gone_a and k <= gone_b:
                    return True
        return False

    def step(self, state: int, token: int) -> bool:
        """Whether the arc ``token`` leaves ``state``; table lookup, filled on first use."""
        key = (state << 32) | token
        hit = self.table.get(key)
        if hit is None:
            if len(self.table) >= ARCS:
                self.table.clear()
            hit = self.table[key] = not self._closed(state, token)
        return hit

    def _path(self, part: str) -> tuple[int, ...]:
        """The inner labels that spell the beginning of a word; table lookup, filled on first use."""
        got = self.paths.get(part)
        if got is None:
            got = self._spell(part, self.inner)
            if len(self.paths) >= PATHS:
                self.paths.clear()
            self.paths[part] = got
        return got

    def _spell(self, part: str, label: dict[str, int]) -> tuple[int, ...]:
        """The path that spells ``part`` and ends by an arc of ``label``."""
        if (t := label.get(part)) is not None:
            return (t,)
        table, paths, n = self.table.get, self.paths.get, len(part)
        for k in self.ends.get(part[-4:], SHORT):
            if k < n and (t := label.get(part[n - k :])) is not None:
                begin = part[: n - k]
                before = paths(begin) or self._path(begin)
                leaves = table((before[-1] << 32) | t)
                if self.step(before[-1], t) if leaves is None else leaves:
                    return (*before, t)
        raise ValueError(f"no path spells {part!r}")

    def encode_word(self, word: str) -> list[int]:
        """Ids of one pre-split word, already in byte symbols."""
        if len(word) <= NEAR:
            return list(self._spell(word, self.final))
        if (t := self.final.get(word)) is not None:
            return [t]
        inner, ends, table, step = self.inner.get, self.ends.get, self.table.get, self.step
        states: dict[int, int] = {}  # by place: the token whose arc ends there
        came: dict[int, int] = {}  # the place where that arc begins
        asking: list[tuple] = []  # places whose state rests on one that is being looked up, with the label tried there
        j = n = len(word)
        label, sizes = self.final.get, iter(ends(word[-4:], SHORT))
        while True:
            for k in sizes:
                i = j - k
                if i < 0 or (t := label(word[i:j])) is None:
                    continue
                if not i:
                    break
                s = self._path(word[:i])[-1] if i <= NEAR else states.get(i)
                if s is None:
                    asking.append((j, sizes, t))
                    label, j, sizes = inner, i, iter(ends(word[i - 4 if i > 4 else 0 : i], SHORT))
                    i = -1
                    break
                leaves = table((s << 32) | t)
                if step(s, t) if leaves is None else leaves:
                    break
            else:
                raise ValueError(f"no path spells {word!r}")
            if i < 0:
                continue
            states[j], came[j] = t, i
            while asking:
                i, s = j, t
                j, sizes, t = asking.pop()
                leaves = table((s << 32) | t)
                if not (step(s, t) if leaves is None else leaves):
                    label = inner if j < n else self.final.get
                    break
                states[j], came[j] = t, i
            else:
                break
        path = []
        while n > NEAR:
            path.append(states[n])
            n = came[n]
        return [*(self._path(word[:n]) if n else ()), *path[::-1]]


class Tokenizer:
    """Normalization, pre-splitting and special tokens around the automaton, as the vocabulary file declares them."""

    def __init__(self, spec: dict):
        m = spec["model"]
        known = m["type"] == "BPE" and not (m.get("dropout") or m.get("unk_token") or m.get("continuing_subword_prefix") or m.get("byte_fallback") or m.get("ignore_merges"))
        if not known or spec.get("post_processor") or spec.get("decoder"):
            raise ValueError("this kind of tokenizer file is not supported")
        steps = [(x["type"], x) for x in spec["normalizer"]["normalizers"]]
        if [k for k, _ in steps] != ["NFC", "Replace", "Lowercase"]:
            raise ValueError("unsupported normalizer")
        split, byte_level = spec["pre_tokenizer"]["pretokenizers"]
        if (split["behavior"], split["invert"], byte_level["add_prefix_space"], byte_level["use_regex"]) != ("Removed", True, False, False):
            raise ValueError("unsupported pre-tokenizer")
        self.words = regex.compile(split["pattern"]["Regex"])
        self.special = {x["content"]: x["id"] for x in spec["added_tokens"]}
        self.special_at = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self.symbols = byte_symbols()
        self.automaton = MergeAutomaton(m["vocab"], [tuple(x) if not isinstance(x, str) else tuple(x.split(" ")) for x in m["merges"]], m.get("end_of_word_suffix") or "")
        self.memo: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.labels = list(self.automaton.labels)
        for s, i in self.special.items():
            self.labels += [""] * (i + 1 - len(self.labels))
            self.labels[i] = s

    @staticmethod
    def normal(text: str) -> str:
        text = unicodedata.normalize("NFC", text)
        return text.lower() if "Σ" not in text else "".join([c.lower() for c in text])  # the final sigma rule isn't applied

    @staticmethod
    def pieces(text: str) -> Iterator[str]:
        """The text cut at white space into pieces of about PIECE characters."""
        begin, n = 0, len(text)
        while n - begin > PIECE:
            end = min((x for c in " \n" if (x := text.find(c, begin + PIECE)) >= 0), default=n)
            yield text[begin:end]
            begin = end
        yield text[begin:] if begin else text

    def _chunk(self, chunk: str) -> bytes:
        """Ids of a run without white space: from the older memo, else by its words, else by the automaton."""
        ids = self.older.get(chunk)
        if ids is None:
            words = self._split(chunk)
            if words == [chunk]:
                plain = chunk.isascii() and chunk.isprintable()  # these bytes stand for themselves
                ids = array("I", self.automaton.encode_word(chunk if plain else "".join([self.symbols[b] for b in chunk.encode("utf-8")]))).tobytes()
            else:
                get = self.memo.get
                ids = b"".join([x if (x := get(w)) is not None else self._chunk(w) for w in words])
        if len(chunk) <= 64:
            if len(self.memo) >= MEMO:
                self.older = dict(self.memo)
                self.memo.clear()
            self.memo[chunk] = ids
        return ids

    def _split(self, chunk: str) -> list[str]:
        if chunk.isascii():
            word = chunk.rstrip(string.punctuation)
            if word.isalpha():  # letters, then no letter that a mark could go with
                return [word, chunk[len(word) :]] if len(word) < len(chunk) else [word]
            return self.words.findall(chunk)
        if max(chunk) < OLDER:
            return self.words.findall(chunk)
        chunk = chunk.translate(LOWER_NEW)
        if not NEWER_AT.search(chunk):
            return self.words.findall(chunk)
        known = NEWER_AT.sub(SYMBOL, chunk)
        return [chunk[m.start() : m.end()] for m in self.words.finditer(known)]

    def encode_bytes(self, text: str | None) -> bytes:
        """The ids as unsigned 32-bit integers in this machine's byte order."""
        out: list[bytes] = []
        get, chunk = self.memo.get, self._chunk
        for part in self.special_at.split(text or "") if self.special_at and "<" in (text or "") else [text or ""]:
            if part in self.special:
                out.append(array("I", [self.special[part]]).tobytes())
                continue
            for piece in self.pieces(part):
                piece = self.normal(piece)
                # split() also cuts at four control characters that aren't white space here
                runs = [piece] if any(c in piece for c in CONTROLS) else piece.split()
                ids = list(map(get, runs))
                out.append(b"".join([x if x is not None else chunk(w) for x, w in zip(ids, runs)] if None in ids else ids))
        return b"".join(out)

    def decode_bytes(self, ids: bytes) -> str:
        labels = self.labels
        return " ".join([labels[i] for i in np.frombuffer(ids, np.uint32).tolist()])


_LOADED: dict[str, Tokenizer] = {}


def loaded(spec_json: str) -> Tokenizer:
    """The compiled tokenizer, once for each worker process."""
    key = hashlib.sha256(spec_json.encode()).hexdigest()
    if key not in _LOADED:
        _LOADED[key] = Tokenizer(json.loads(spec_json))
    return _LOADED[key]


def read_spec(path: str) -> str:
    with open(path, encoding="utf-8") as f:
        return f.read()


def encode(docs: DataFrame, path: str, text: str = "text", ids: str = "ids", decoded: str | None = None) -> DataFrame:
    """``docs`` with an array of token ids (and, if named, the decoded text); columns of these names are replaced."""
    spec = docs.sparkSession.sparkContext.broadcast(read_spec(path))  # one tokenizer file
    kept = [c for c in docs.columns if c not in (ids, decoded)]
    shape = docs.select(kept).schema.add(ids, ArrayType(IntegerType()))
    if decoded:
        shape = shape.add(decoded, "string")
    place = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = loaded(spec.value)
        for batch in batches:
            for k in range(0, batch.num_rows, 256):
                b = batch.slice(k, 256)
                raw = [t.encode_bytes(x) for x in b.column(place).to_pylist()]
                ends = np.cumsum([0] + [len(r) // 4 for r in raw]).astype(np.int32)
                arrays = [b.column(b.schema.get_field_index(c)) for c in kept]
                arrays.append(pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(raw), np.int32))))
                if decoded:
                    arrays.append(pa.array([t.decode_bytes(r) for r in raw], pa.string()))
                yield pa.RecordBatch.from_arrays(arrays, [f.name for f in shape])

    return docs.mapInArrow(run, shape)


def digests(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_tokens, ids_sha256, decoded_sha256) of every row, without moving ids out of the worker."""
    spec = docs.sparkSession.sparkContext.broadcast(read_spec(path))
    kind = docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = loaded(spec.value)
        for b in batches:
            n, ids, back = [], [], []
            for x in b.column(1):
                raw = t.encode_bytes(x.as_py())
                n.append(len(raw) // 4)
                ids.append(hashlib.sha256(np.frombuffer(raw, np.uint32).astype("<u4").tobytes()).hexdigest())
                back.append(hashlib.sha256(t.decode_bytes(raw).encode()).hexdigest())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64()), pa.array(ids, pa.string()), pa.array(back, pa.string())], ["k", "n_tokens", "ids_sha256", "decoded_sha256"])

    out = docs.select(docs[key].alias("k"), docs[text].alias("t")).mapInArrow(run, f"k {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")
    return out.withColumnRenamed("k", key)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return digests(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
