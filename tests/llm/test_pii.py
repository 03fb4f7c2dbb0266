import hashlib
import itertools
import random
import re
from collections import Counter

import numpy as np
import pytest

from weavemine.llm import pii as P


def plain_base(text):
    """The contract's patterns, as they are written."""
    out = []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        out.append(("email", *m.span()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m[0].split(".")):
            out.append(("ip", *m.span()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = re.sub("[^0-9]", "", m[0])
        alt = sum(sum(divmod(2 * int(c), 10)) if k % 2 else int(c) for k, c in enumerate(d[::-1]))
        if 12 <= len(d) <= 19 and alt % 10 == 0:
            out.append(("card", *m.span()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15:
            out.append(("phone", *m.span()))
    return sorted(out, key=lambda s: (s[1], P.KINDS.index(s[0])))


def test_base_spans_equal_the_patterns():
    rnd = random.Random(1)
    for k in range(6000):
        n = rnd.randrange(0, 60)
        text = "".join(rnd.choice("a.@-+ 0159()é%") if k % 2 else rnd.choice("012345678901234 -.+@a") for _ in range(n))
        assert P.base_spans(text) == plain_base(text), text
    for k in range(300):
        text = P.generate(random.Random(k))[0]
        assert P.base_spans(text) == plain_base(text)


def test_scans_are_linear():
    for text in ("a" * 300_000 + "@", "1" * 300_000, "1." * 150_000, "+1 " * 100_000, "a@b" * 100_000, "0.0.0.0 " * 20_000):
        P.find_spans(text, P.trained())


def test_links_of_many_mentions():
    """Any two mentions that repeat each other are connected, by few edges a mention."""
    for text in ("212-555-3729 and 415-555-3729 or 555-3729 then 212-555-3729 end " * 5000, "+1 (212) 555-3729 then " + "555-3729 or 1-212-555-3729 then " * 10000):
        nodes = P.nodes_of(text, P.base_spans(text))
        skip = P.edges_of(nodes)[1]
        assert len(nodes) >= 20_000 and len(skip) <= 4 * len(nodes)
    nodes = P.nodes_of(t := "212-555-3729 one 415-555-3729 two 555-3729 three 212-555-3729 four 999-1234", P.base_spans(t))
    skip = P.edges_of(nodes)[1]
    assert (0, 3) in skip and any(2 in e and (0 in e or 3 in e) for e in skip) and any(2 in e and 1 in e for e in skip)
    assert not any(4 in e for e in skip)


def test_messages_give_the_exact_marginals_of_a_tree():
    import itertools

    import numpy as np

    field = P.trained()
    for text in ("call 555-3729 or 212-555-3729", "x 555-3729 " + "word " * 60 + "212-555-3729 " + "word " * 60 + "999-1234", "12.12.12.12 555-3729"):
        nodes = P.nodes_of(text, P.base_spans(text))
        chain, skip = P.edges_of(nodes)
        chain = [e for e in chain if e not in skip]
        model = P.Field(field.w, field.chain, field.skip)
        was, P.edges_of = P.edges_of, lambda _, c=chain, s=skip: (c, s)
        try:
            got = model.marginals(nodes)
        finally:
            P.edges_of = was
        score = np.array([field.w[P.unary(n)].sum(axis=0) if not n.kind else np.where(np.arange(5) == P.LABELS.index(n.kind), 0.0, -50.0) for n in nodes])
        want = np.zeros((len(nodes), 5))
        for labels in itertools.product(range(5), repeat=len(nodes)):
            z = sum(score[i, k] for i, k in enumerate(labels))
            z += sum(field.chain[labels[i], labels[j]] for i, j in chain) + sum(field.skip[labels[i], labels[j]] for i, j in skip)
            for i, k in enumerate(labels):
                want[i, k] += np.exp(z)
        assert np.allclose(got, want / want.sum(axis=1, keepdims=True), atol=0.01)


def test_repeated_mentions_are_added_and_strangers_left():
    text = "Call +1 (799) 555-3729 now. " + "filler words " * 60 + "again 799-555-3729 or 555-3729, mail ann.lee@x.example.com; ann.lee knows 555-1234 and 20250101."
    base, spans = P.find_spans(text, P.trained())
    got = {text[a:z]: k for k, a, z in spans}
    assert set(base) <= set(spans)
    assert got["799-555-3729"] == "phone" and got["555-3729"] == "phone" and got["ann.lee"] == "email"
    assert "555-1234" not in got and "20250101" not in got
    assert P.redacted("to ann.b@c.de, ann.b", P.trained()) == "to <email>, <email>"


def test_mentions_are_scored_without_a_base_span():
    text = "write ann.lee[at]x.example.com or a.b(at)mail ok"
    base, spans = P.find_spans(text, P.trained())
    assert base == [] and [text[a:z] for _, a, z in spans] == ["ann.lee[at]x.example.com", "a.b(at)mail"]
    assert P.redacted(text, P.trained()) == "write <email> or <email> ok"
    assert P.find_spans("no data here", P.trained()) == ([], [])


def settled(field, nodes, score):
    """Marginals of a path by passing once along it and back."""
    chain, skip = P.edges_of(nodes)
    assert all(j == i + 1 for i, j in chain + skip)
    pots = [np.zeros((5, 5)) for _ in nodes[1:]]
    for edges, pot in ((chain, field.chain), (skip, field.skip)):
        for i, _ in edges:
            pots[i] = pots[i] + pot
    log = lambda m: np.log(np.exp(m - m.max(axis=0)).sum(axis=0)) + m.max(axis=0)
    ahead, behind = [np.zeros(5)], [np.zeros(5)]
    for i, pot in enumerate(pots):
        ahead.append(log((score[i] + ahead[-1])[:, None] + pot))
    for i, pot in reversed([*enumerate(pots)]):
        behind.append(log((score[i + 1] + behind[-1])[:, None] + pot.T))
    return P._softmax(score + np.array(ahead) + np.array(behind[::-1]))


@pytest.mark.parametrize("repeats", [3, 40, 400])
def test_messages_settle_on_long_runs_of_mentions(repeats):
    rnd = random.Random(repeats)
    field = P.trained()
    forms = ["555-3729-11", "(555)372911", "555 3729 11", "55537.2911"]
    text = (" " + "x" * 250 + " ").join(rnd.choice(forms) for _ in range(repeats))  # too far apart for transitions
    nodes = P.nodes_of(text, P.base_spans(text))
    assert len(nodes) == repeats
    score = np.array([field.w[P.unary(n)].sum(axis=0) for n in nodes])
    want = settled(field, nodes, score)
    assert np.abs(field.marginals(nodes) - want).max() < 1e-5
    chain, skip = P.edges_of(nodes)
    assert np.abs(field._on_forest(score, [(i, j, 0) for i, j in chain] + [(i, j, 1) for i, j in skip]) - want).max() < 1e-9


def test_messages_on_loops_settle_near_the_true_marginals():
    field = P.trained()
    text = "call +1 (555) 372-9118 or 555-372-9118, 5553729118 or 372-9118; mail a.b@c.de, a.b and a.b(at)x"
    nodes = P.nodes_of(text, P.base_spans(text))
    chain, skip = P.edges_of(nodes)
    assert 3 <= len(nodes) <= 8 and len(chain) + len(skip) >= len(nodes)
    score = np.array([field.w[P.unary(n)].sum(axis=0) for n in nodes])
    for i, n in enumerate(nodes):
        if n.kind:
            score[i] = -50.0
            score[i, P.LABELS.index(n.kind)] = 0.0
    total = np.zeros((len(nodes), 5))
    for labels in itertools.product(range(5), repeat=len(nodes)):
        x = sum(score[i, v] for i, v in enumerate(labels)) + sum(field.chain[labels[i], labels[j]] for i, j in chain) + sum(field.skip[labels[i], labels[j]] for i, j in skip)
        total[range(len(nodes)), labels] += np.exp(x)
    want = total / total.sum(axis=1, keepdims=True)
    got = field.marginals(nodes)
    assert (got.argmax(axis=1) == want.argmax(axis=1)).all() and np.abs(got - want).max() < 0.15


def test_held_out_accuracy():
    rnd, hit = random.Random(99), Counter()
    for _ in range(200):
        text, truth = P.generate(rnd)
        base, spans = P.find_spans(text, P.trained())
        for k, a, z in set(spans) - set(base):
            hit["good" if any(k == t and a < q and p < z for t, p, q in truth) else "bad"] += 1
        hit["missed"] += sum(not any(a < q and p < z for _, a, z in spans) for _, p, q in truth)
    assert hit["good"] > 100 and hit["bad"] <= 0.05 * hit["good"] and hit["missed"] <= 0.1 * hit["good"], hit


def test_query(spark, tmp_path):
    texts = [None, "", "x 4026083977531332 y é a@b.c", "1.2.3.4.5.6.7.8 256.1.1.1", "+1 (799) 555-3729 " * 2000, "same a@b.c", "same a@b.c"]
    rows = [(i if i else None, t, "x") for i, t in enumerate(texts)] + [(6, texts[6], "x")]
    spark.createDataFrame(rows, "doc_id long, text string, spans string").write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted((tuple(r) for r in P.query(spark, str(tmp_path)).collect()), key=str)
    want = []
    for d, t, _ in rows:
        base = plain_base(t or "")
        n = Counter(k for k, *_ in base)
        s = ",".join(f"{k}:{a}:{z}" for k, a, z in base)
        want.append((d, n["email"], n["ip"], n["card"], n["phone"], hashlib.sha256(s.encode()).hexdigest()))
    assert [g[:6] for g in got] == sorted(want, key=str)
    assert all(g[7] == (g[6] != "") for g in got)
    docs = spark.createDataFrame([(1, "a@b.c", 5, "k"), (2, None, None, None)], "doc_id long, text string, n_chars long, base string")
    assert [tuple(r) for r in P.redact(docs).orderBy("doc_id").collect()] == [(1, "<email>", 7, "k"), (2, None, None, None)]


def test_empty_table(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    assert P.query(spark, str(tmp_path)).count() == 0
