"""Operator 6: personal data by patterns and a skip-chain conditional random field.

Fixed patterns find the base spans. Nodes of the field are the base spans and
other candidate spans (digit groups, address-like tokens, and other mentions of
a found address's name); its labels are none and the four kinds. Neighbouring
candidates share a transition potential, and candidates that repeat each other
(same digits, one's digits ending the other's, or the same address name),
however far apart, share a skip potential. Loopy sum-product messages pass
along both kinds of edges, so that what one mention shows in form decides about
its bare repetitions, while numbers that nothing ties to personal data stay.
Base spans keep their label; candidates are added where a kind is likelier than
``SURE``. Messages are passed until they settle, however many rounds a document
takes; if they never do, loops are cut open and the rest is solved exactly.
Neighbours more than ``NEAR`` code points apart do not share a transition.

The field's weights are trained here, by pseudo-likelihood on generated
documents (``TRAIN`` of them from a fixed seed, so training does not depend on
the corpus), once per process.

Documents without candidates are settled by the patterns; all others, with or
without a base span, are scored by the field. A candidate group has ``DIGITS``
digits; names of under ``NAME_LEAST`` letters, and names without a dot, underscore
or digit, are words like others and are not searched for.

Defined results: null text is empty; empty text has no spans; spans are code
points, end exclusive, and never overlap a base span unless both are base;
a kind as likely as ``SURE`` is added, and of kinds that are equally likely the
first in the order of ``LABELS``;
repeated rows give equal rows; an empty table gives no rows; other columns are
carried by ``redact`` and ignored by ``find``. Scans are linear in the text, and
its mentions are sorted, so very long texts take hardly more than their length.
"""

from __future__ import annotations

import hashlib
import random
import re
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weavemine.session import table

NAME = "op6_skip_chain_pii"
KINDS = ("email", "ip", "card", "phone")
LABELS = ("none", *KINDS)
TRAIN, SEED, SURE = 400, 7, 0.5
#: Messages are passed until none changes by more than this; where that takes more rounds, loops are left out (``_on_forest``).
SETTLED, ROUNDS = 1e-8, 4000
#: Code points between neighbours that still share a transition; digits of a candidate group, least and most; least length of a name.
NEAR, DIGITS, NAME_LEAST = 200, (7, 19), 4

# Possessive repeats and look-behinds change no match; they keep scans linear.
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_DOTTED = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++)++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_GROUPS = re.compile(r"(?<![\w.+])[(]?[0-9](?:[ ().\-/]{0,2}[0-9])++(?!\w)")
_AT = re.compile(r"(?<!\S)[A-Za-z0-9._%+-]++(?:@|\(at\)|\[at\])[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)*+")
_NAME = re.compile(r"(?<![\w.%+-])[A-Za-z0-9_%+-]++(?:\.[A-Za-z0-9_%+-]++)*+(?![\w@%+-])")


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) << (k & 1)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    done, at = 0, text.find("@")
    while at >= 0:
        m = _DOMAIN.match(text, at)
        begin = at
        if m:
            while begin > done and _LOCAL.match(text, begin - 1):
                begin -= 1
            if begin < at:
                yield begin, m.end()
                done = m.end()
        at = text.find("@", max(at + 1, done))


def _ips(text: str) -> Iterator[tuple[int, int]]:
    for m in _DOTTED.finditer(text):
        at, parts = m.start(), m[0].split(".")
        for k in range(0, len(parts) - 3, 4):
            four = parts[k : k + 4]
            end = at + sum(map(len, four)) + 3
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in four):
                yield at, end
            at = end + 1


def _digits(s: str) -> str:
    return "".join([c for c in s if "0" <= c <= "9"])


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of the fixed patterns, by start and then kind."""
    out = []
    if "@" in text:
        out += [("email", a, z) for a, z in _emails(text)]
    out += [("ip", a, z) for a, z in _ips(text)]
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 12 and 12 <= len(d := _digits(m[0])) <= 19 and luhn(d):
            out.append(("card", m.start(), m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= len(_digits(m[0])) <= 15:
                out.append(("phone", m.start(), m.end()))
    return sorted(out, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


@dataclass
class Node:
    start: int
    end: int
    text: str
    kind: str | None  # of a base span
    key: str  # repeated nodes share it: digits, or an address's name
    numeric: bool


def nodes_of(text: str, base: list[tuple[str, int, int]]) -> list[Node]:
    """Base spans and further candidates, in text order; candidates overlap nothing."""
    out = [Node(a, z, text[a:z], k, text[a:z].partition("@")[0].lower() if k == "email" else _digits(text[a:z]), k != "email") for k, a, z in base]
    taken = sorted((a, z) for _, a, z in base)
    found = [(m.start(), m.end(), True) for m in _GROUPS.finditer(text) if m.end() - m.start() >= DIGITS[0] and DIGITS[0] <= len(_digits(m[0])) <= DIGITS[1]]
    found += [(m.start(), m.end(), False) for m in _AT.finditer(text)] if "@" in text or "at)" in text or "at]" in text else []
    names = {n.key for n in out if n.kind == "email" and len(n.key) >= NAME_LEAST and re.search(r"[._0-9]", n.key)}
    if names:
        found += [(m.start(), m.end(), False) for m in _NAME.finditer(text) if m[0].lower() in names]
    k = 0
    last = 0
    for a, z, numeric in sorted(found, key=lambda f: (f[0], -f[1])):
        while k < len(taken) and taken[k][1] <= a:
            k += 1
        if a < last or (k < len(taken) and taken[k][0] < z):
            continue
        last = z
        s = text[a:z]
        out.append(Node(a, z, s, None, _digits(s) if numeric else re.split(r"@|\(at\)|\[at\]", s)[0].lower(), numeric))
    return sorted(out, key=lambda n: (n.start, n.end))


def unary(n: Node) -> list[int]:
    """Indices of the node's features."""
    d = len(_digits(n.text))
    f = [0, 1 + min(4, max(0, (d - 4) // 3))]
    for k, yes in enumerate((n.numeric, "(" in n.text, " " in n.text, "-" in n.text, "." in n.text, "@" in n.text, "at" in n.text, n.text[0] == "+", n.numeric and d >= 12 and luhn(_digits(n.text)))):
        if yes:
            f.append(6 + k)
    return [*f, 15 + (KINDS.index(n.kind) if n.kind else 4)]


FEATURES = 20


def edges_of(nodes: list[Node]) -> tuple[list[tuple[int, int]], list[tuple[int, int]]]:
    """Chain edges between neighbours, and skip edges between nodes that repeat each other, wherever they stand.

    Nodes with one key are linked as a path in text order, with every member tied
    to the first one that is a base span too. Digits that end other digits are
    linked by the keys: each key's first node to the first of the longest key that
    ends it, and of the longest base span with that ending. So there are at most
    four edges a node however often it recurs, any two nodes that repeat each other
    are connected, and sorting is all that takes more than linear time.
    """
    chain = [(i, i + 1) for i in range(len(nodes) - 1) if nodes[i + 1].start - nodes[i].end <= NEAR]
    runs: dict[tuple[bool, str], list[int]] = defaultdict(list)
    for i, n in enumerate(nodes):
        runs[n.numeric, n.key].append(i)
    skip: set[tuple[int, int]] = set()

    def tie(i: int, j: int) -> None:
        if i != j:
            skip.add((min(i, j), max(i, j)))

    for run in runs.values():
        for i, j in zip(run, run[1:]):
            tie(i, j)
        anchor = next((i for i in run if nodes[i].kind), None)
        if anchor is not None:
            for i in run:
                tie(i, anchor)
    # read backwards, an ending is a beginning: in sorted order the keys that end a key are on the stack when it comes
    stack: list[tuple[str, list[int]]] = []
    widest: dict[str, int] = {}
    for backward, run in sorted((key[::-1], run) for (numeric, key), run in runs.items() if numeric):
        while stack and not backward.startswith(stack[-1][0]):
            stack.pop()
        if stack:
            tie(run[0], stack[-1][1][0])
        stack.append((backward, run))
        anchor = next((i for i in run if nodes[i].kind), None)
        if anchor is not None:
            for ending, _ in stack[:-1]:
                if len(nodes[anchor].key) > len(nodes[widest[ending]].key if ending in widest else ""):
                    widest[ending] = anchor
    for (numeric, key), run in runs.items():
        if numeric and key[::-1] in widest:
            tie(run[0], widest[key[::-1]])
    return chain, sorted(skip)


@dataclass
class Field:
    w: np.ndarray  # FEATURES x labels
    chain: np.ndarray  # labels x labels, symmetric
    skip: np.ndarray  # labels x labels, symmetric

    def marginals(self, nodes: list[Node]) -> np.ndarray:
        """Label probabilities of each node by loopy sum-product, all messages at once."""
        score = np.array([self.w[unary(n)].sum(axis=0) for n in nodes])
        for i, n in enumerate(nodes):
            if n.kind:
                score[i] = -50.0
                score[i, LABELS.index(n.kind)] = 0.0
        chain, skip = edges_of(nodes)
        both = [(i, j, 0) for i, j in chain] + [(i, j, 1) for i, j in skip]
        if not both:
            return _softmax(score)
        e = np.array(both + [(j, i, k) for i, j, k in both])
        back = np.concatenate([np.arange(len(both)) + len(both), np.arange(len(both))])
        pot = np.where(e[:, 2, None, None] == 0, self.chain, self.skip)
        msg = np.zeros((len(e), len(LABELS)))  # log message along each directed edge
        kept, before = 0.0, np.inf
        for turn in range(ROUNDS):
            into = score.copy()
            np.add.at(into, e[:, 1], msg)
            new = _sent(into[e[:, 0]] - msg[back], pot)
            change = np.abs(new - msg).max()
            msg = kept * msg + (1 - kept) * new
            if change < SETTLED:
                break
            if turn % 50 == 49:  # messages that swing are damped, more and more
                kept, before = (min(0.9, kept + 0.3), change) if change > 0.5 * before else (kept, change)
        else:
            return self._on_forest(score, both)
        into = score.copy()
        np.add.at(into, e[:, 1], msg)
        return _softmax(into)

    def _on_forest(self, score: np.ndarray, both: list[tuple[int, int, int]]) -> np.ndarray:
        """Exact marginals with the edges that close a loop left out, skip edges first in.

        Nodes are taken in the order of a walk from each tree's root: messages go up
        against that order and down along it, each once.
        """
        n = len(score)
        tree: list[list[tuple[int, int]]] = [[] for _ in range(n)]
        root = list(range(n))

        def top(i: int) -> int:
            while root[i] != i:
                root[i] = root[root[i]]
                i = root[i]
            return i

        for i, j, k in sorted(both, key=lambda x: (-x[2], x[:2])):
            a, b = top(i), top(j)
            if a != b:
                root[a] = b
                tree[i].append((j, k))
                tree[j].append((i, k))
        above: list[tuple[int, int] | None] = [None] * n
        seen, order = [False] * n, []
        for start in range(n):
            todo = [] if seen[start] else [start]
            while todo:
                i = todo.pop()
                seen[i] = True
                order.append(i)
                for j, k in tree[i]:
                    if not seen[j]:
                        above[j] = (i, k)
                        todo.append(j)
        into, up = score.copy(), np.zeros_like(score)
        pots = (self.chain, self.skip)
        for i in reversed(order):
            if above[i]:
                up[i] = _sent(into[i][None], pots[above[i][1]][None])[0]
                into[above[i][0]] += up[i]
        for i in order:
            if above[i]:
                into[i] += _sent((into[above[i][0]] - up[i])[None], pots[above[i][1]][None])[0]
        return _softmax(into)


def _sent(out: np.ndarray, pot: np.ndarray) -> np.ndarray:
    """Log messages of senders with these scores over these potentials."""
    x = out[:, :, None] + pot
    top = x.max(axis=1)
    new = top + np.log(np.exp(x - top[:, None, :]).sum(axis=1))
    return new - new.max(axis=1, keepdims=True)


def _softmax(x: np.ndarray) -> np.ndarray:
    y = np.exp(x - x.max(axis=1, keepdims=True))
    return y / y.sum(axis=1, keepdims=True)


def generate(rnd: random.Random) -> tuple[str, list[tuple[str, int, int]]]:
    """A document with all its personal data marked: plain forms, bare repetitions of them, and unrelated numbers."""
    parts: list[tuple[str, str | None]] = []
    word = lambda: "".join(rnd.choice("abcdefghilmnorstu") for _ in range(rnd.randrange(2, 8)))
    filler = lambda: parts.append((" ".join(word() for _ in range(rnd.randrange(3, 30))) + " ", None))
    digits = lambda n: "".join(rnd.choice("0123456789") for _ in range(n))
    later: list[tuple[str, str]] = []
    for _ in range(rnd.randrange(1, 5)):
        filler()
        kind = rnd.choice(KINDS)
        if kind == "email":
            local = f"{word()}{rnd.choice('._')}{word()}"
            value, again = f"{local}@{word()}.example.com", [local, f"{local}[at]{word()}.example.com", f"{local}(at)mail"]
        elif kind == "ip":
            octets = [str(rnd.randrange(100, 256)) for _ in range(4)]
            value, again = ".".join(octets), ["-".join(octets), " ".join(octets)]
        elif kind == "phone":
            a, b, c = digits(3), digits(3), digits(4)
            value, again = f"+1 ({a}) {b}-{c}", [f"({a}) {b}-{c}", f"{a}-{b}-{c}", f"{a}{b}{c}", f"{b}-{c}"]
        else:
            d = digits(15)
            d += next(x for x in "0123456789" if luhn(d + x))
            value, again = d, [".".join(d[k : k + 4] for k in range(0, 16, 4)), "/".join(d[k : k + 4] for k in range(0, 16, 4))]
        parts.append((value, kind))
        parts.append((" ", None))
        if rnd.random() < 0.7:
            later += [(x, kind) for x in again if rnd.random() < 0.6]
    for _ in range(rnd.randrange(0, 4)):
        d = digits(16)
        plain = [f"{digits(3)}-{digits(4)}", f"({digits(3)}) {digits(3)}-{digits(4)}", digits(rnd.randrange(7, 12)), f"20{digits(2)}-{digits(2)}-{digits(2)}", ".".join(digits(4) for _ in range(4)), d if not luhn(d) else digits(7), f"{word()}@{word()}"]
        x = rnd.choice(plain)
        later += [(x, "none")] * rnd.choice([1, 1, 2])
    rnd.shuffle(later)
    for x, kind in later:
        filler()
        parts.append((x, kind))
        parts.append((" ", None))
    text, spans = "", []
    for s, kind in parts:
        if kind and kind != "none":
            spans.append((kind, len(text), len(text) + len(s)))
        text += s
    return text, spans


def train(documents: int = TRAIN, seed: int = SEED, steps: int = 300) -> Field:
    """Pseudo-likelihood: each node's label given its form and the true labels around it."""
    rnd = random.Random(seed)
    rows, chains, skips, labels = [], [], [], []
    for _ in range(documents):
        text, truth = generate(rnd)
        nodes = nodes_of(text, base_spans(text))
        gold = [LABELS.index(next((k for k, a, z in truth if a < n.end and n.start < z), "none")) for n in nodes]
        around: list[list[np.ndarray]] = [[np.zeros(5) for _ in nodes] for _ in range(2)]
        for which, edges in enumerate(edges_of(nodes)):
            for i, j in edges:
                around[which][i][gold[j]] += 1
                around[which][j][gold[i]] += 1
        for i, n in enumerate(nodes):
            x = np.zeros(FEATURES)
            x[unary(n)] = 1
            rows.append(x)
            chains.append(around[0][i])
            skips.append(around[1][i])
            labels.append(gold[i])
    x, c, s = np.array(rows), np.array(chains), np.array(skips)
    y = np.eye(5)[labels]
    w, t, k = np.zeros((FEATURES, 5)), np.zeros((5, 5)), np.zeros((5, 5))
    for _ in range(steps):
        g = (y - _softmax(x @ w + c @ t + s @ k)) / len(y)
        w += 2.0 * (x.T @ g) - 0.002 * w
        dt, dk = c.T @ g, s.T @ g
        t += dt + dt.T - 0.002 * t
        k += dk + dk.T - 0.002 * k
    return Field(w, t, k)


_TRAINED: list[Field] = []


def trained() -> Field:
    if not _TRAINED:
        _TRAINED.append(train())
    return _TRAINED[0]


def find_spans(text: str | None, model: Field) -> tuple[list[tuple[str, int, int]], list[tuple[str, int, int]]]:
    """(base spans, all spans), each by start, kind and end."""
    text = text or ""
    base = base_spans(text)
    nodes = nodes_of(text, base)
    if len(nodes) == len(base):
        return base, base
    p = model.marginals(nodes)
    added = [(LABELS[k], n.start, n.end) for n, row in zip(nodes, p) if n.kind is None and (k := int(row.argmax())) and row[k] >= SURE]
    return base, sorted(base + added, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def written(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{z}" for k, a, z in spans)


def find(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_email, n_ip, n_card, n_phone, base, spans) of every row; counts are of base spans."""
    model = trained()
    kind = docs.schema[key].dataType.simpleString()
    names = [f"n_{k}" for k in KINDS]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            counts: list[list[int]] = [[] for _ in KINDS]
            base, spans = [], []
            for t in b.column(1):
                first, all_ = find_spans(t.as_py(), model)
                for k, c in zip(KINDS, counts):
                    c.append(sum(s[0] == k for s in first))
                base.append(written(first))
                spans.append(written(all_))
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(c, pa.int64()) for c in counts), pa.array(base, pa.string()), pa.array(spans, pa.string())], ["k", *names, "base", "spans"])

    out = docs.select(docs[key].alias("k"), docs[text].alias("t")).mapInArrow(run, f"k {kind}, " + ", ".join(f"{n} long" for n in names) + ", base string, spans string")
    return out.withColumnRenamed("k", key)


def redacted(text: str | None, model: Field) -> str | None:
    """The text with each run of overlapping spans replaced by the first one's kind in angle brackets."""
    if text is None:
        return None
    out, at = [], 0
    for kind, a, z in find_spans(text, model)[1]:
        if a >= at:
            out += [text[at:a], f"<{kind}>"]
        at = max(at, z)
    return "".join(out) + text[at:] if out else text


def redact(docs: DataFrame, text: str = "text", n_chars: str = "n_chars") -> DataFrame:
    """``docs`` with personal data replaced, and its count of characters brought up to date where it has one."""
    model = trained()
    place = docs.columns.index(text)
    size = docs.columns.index(n_chars) if n_chars in docs.columns else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [redacted(t.as_py(), model) for t in b.column(place)]
            arrays = list(b.columns)
            arrays[place] = pa.array(texts, pa.string())
            if size is not None:
                arrays[size] = pa.array([None if t is None else len(t) for t in texts], pa.int64()).cast(b.schema.field(size).type)
            yield pa.RecordBatch.from_arrays(arrays, names=b.schema.names)

    return docs.mapInArrow(run, docs.schema)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = find(table(spark, sf_dir, "documents"))
    found = (F.col("spans") != "").alias("personal")
    return out.select("doc_id", *[f"n_{k}" for k in KINDS], F.sha2("base", 256).alias("base_sha256"), "spans", found)
