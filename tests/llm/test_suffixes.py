import hashlib
import random
from collections import Counter

import numpy as np

from weavemine.llm import suffixes as X


def brute(rows, span=400):
    data = [(t or "").encode() for _, t in rows]
    seen = Counter(d[i : i + span] for d in data for i in range(len(d) - span + 1))
    out = []
    for (k, _), d in zip(rows, data):
        cover = np.zeros(len(d) + 1, int)
        for i in range(len(d) - span + 1):
            if seen[d[i : i + span]] > 1:
                cover[i] += 1
                cover[i + span] -= 1
        gone = np.cumsum(cover)[: len(d)] > 0
        kept = bytes(b for b, g in zip(d, gone) if not g)
        out.append((k, len(d), int(gone.sum()), len(X.runs(gone)), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def words(rnd, n):
    return " ".join("".join(rnd.choice("aeioulné") for _ in range(rnd.randrange(1, 9))) for _ in range(n))


def corpus():
    rnd = random.Random(6)
    passage, short, exact = words(rnd, 150), words(rnd, 40), words(rnd, 300)[:390]
    rows = []
    for d in range(130):
        t = words(rnd, rnd.choice([5, 80, 300]))
        if d % 2:
            t = f"{t} {d}{passage}{d} {words(rnd, 20)}"  # a passage that many documents share, each in its own surroundings
        if d % 9 == 0:
            a = rnd.randrange(100)
            t += passage[a : a + rnd.randrange(380, 460)] + short
        if d % 10 == 0:
            t += exact + "tail" + str(d)
        rows.append((d, t))
    base = words(rnd, 500)
    for c in range(6):
        rows.append((500 + c, base[: 300 * c] + "EDIT" + base[300 * c :]))
    rows += [(600, base), (601, base), (602, None), (603, ""), (604, "ab" * 900), (605, "\x00" * 401), (606, base[:399]), (600, base), (None, base[100:900]), (607, "z" * 3000), (608, passage[:400] + "!" + passage[1:401])]
    return rows


def test_query_matches_brute_force(spark, tmp_path):
    df = spark.createDataFrame([(*r, "x") for r in corpus()], "doc_id long, text string, group string")
    df.repartition(5).write.parquet(f"{tmp_path}/documents.parquet")
    want = brute(corpus())
    got = X.query(spark, str(tmp_path)).collect()
    assert sorted((tuple(r)[:-1] for r in got), key=str) == want
    assert all(r.repeats == (r.n_removed > 0) for r in got)


def test_large_groups_are_halved_exactly(spark):
    rows = corpus()
    docs = X.with_key(spark.createDataFrame(rows, "doc_id long, text string").withColumn("text", X.F.coalesce("text", X.F.lit(""))))
    a = {(r.u1, r.u2): frozenset(X.kept_bytes(b"x" * 9000, [tuple(s) for s in r.spans])[0]) for r in X.repeated_spans(docs).collect()}
    was, X.GROUP = X.GROUP, 2
    X.repeats_among.__defaults__ = (2,)
    try:
        b = {(r.u1, r.u2): frozenset(X.kept_bytes(b"x" * 9000, [tuple(s) for s in r.spans])[0]) for r in X.repeated_spans(docs).collect()}
    finally:
        X.GROUP = was
        X.repeats_among.__defaults__ = (was,)
    assert a == b


def test_suffix_array_and_prefixes():
    rnd = random.Random(1)
    for _ in range(200):
        t = np.array([rnd.choice([1, 2, 3, 0]) for _ in range(rnd.randrange(0, 40))] + [0], np.uint8)
        sa = X.two_stage_suffix_array(t, depth=64)
        data = t.tobytes()
        pad = lambda i: data[i:] + b"\0" * (64 - len(data) + i)
        assert sorted(sa) == list(range(len(data)))
        assert [pad(i) for i in sa] == sorted(pad(i) for i in sa)
        for k, n in enumerate(X.common_prefixes(data, sa, 10)):
            if k:
                a, b = data[sa[k - 1] :][:10], data[sa[k] :][:10]
                assert n == next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))


def test_every_start_has_one_anchor():
    rnd = random.Random(2)
    for text in (words(rnd, 400), "a" * 1500, "ab" * 700, "x" * 400, words(rnd, 30) * 12):
        data = text.encode()
        starts = [i + o for _, i, lo, hi in X.anchors(data) for o in range(lo, hi + 1)]
        assert starts == list(range(len(data) - 399))


def test_empty_table(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    assert X.query(spark, str(tmp_path)).count() == 0
