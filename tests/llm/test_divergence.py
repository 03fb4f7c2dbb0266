import random
import re
from collections import Counter

import duckdb
import numpy as np

from weavemine.llm import divergence as D

SHAPE = "doc_id long, text string, lang string, source string, term string, rank int"


def brute(rows):
    docs = [(t or "", x or "", s or "") for _, t, x, s, *_ in rows]
    low = lambda t: "".join(c.lower() if "A" <= c <= "Z" else c for c in t)
    words = [re.findall("[^\x00-\x40\x5b-\x60\x7b-\x7f]+", low(t)) for t, _, _ in docs]
    out = []
    for lang in {x for _, x, _ in docs}:
        own = [(s, w) for (_, x, s), w in zip(docs, words) if x == lang]
        df = Counter(t for _, w in own for t in set(w))
        kept = sorted((t for t in df if df[t] >= 3), key=str.encode)
        v = len(kept)
        share = lambda c: {t: 1 + 10**9 * (c[t] + 1) // (sum(c[k] for k in kept) + v) for t in kept}
        q = share(Counter(t for _, w in own for t in w))
        counts = {s: Counter(t for x, w in own if x == s for t in w) for s in {s for s, _ in own}}
        p = {s: share(c) for s, c in counts.items()}
        f = lambda a, b: (a - b) ** 2 // b
        for s in p:
            pairs = sorted(((-sum(f(p[s][t], p[o][t]) for t in kept), o.encode()) for o in p if o != s))
            terms = sorted((-f(p[s][t], q[t]), t.encode()) for t in kept if counts[s][t] and p[s][t] > q[t])[:200]
            for part, found in (("pair", pairs), ("term", terms)):
                out += [(lang, s, part, i.decode(), -x, k) for k, (x, i) in enumerate(found, 1)]
    return sorted(out)


def made():
    rnd = random.Random(7)
    rows = [(1, None, None, None, "a", 1), (2, "", "en", "empty", "b", 2), (3, "one two", "xx", "s1", "c", 3), (4, "three", "xx", "s2", "d", 4), (5, "B b\x00B", "solo", "s", "e", 5)]
    vocab = ["Alpha", "alpha", "naïve", "漢字", "x1y", "b-c", "É", "é"] + [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(300)]
    for i in range(400):
        lang, source = rnd.choice(["en", "en", "en", "de", None]), rnd.choice(["a", "a", "b", "B", "", None, "é"])
        rows.append((None if i % 9 == 0 else i % 50, " ".join(rnd.choice(vocab[i % 7 :: 1 + i % 3]) for _ in range(rnd.randrange(60))), lang, source, "t", 0))
    return rows + rows[:20] * 2 + [(9, "alpha beta " * 200_000, "en", "a", "t", 0)]


def test_matches_brute_force(spark, monkeypatch):
    rows = made()
    df = spark.createDataFrame(rows, SHAPE)
    want = brute(rows)
    assert sorted(map(tuple, D.audit(df).collect())) == want
    for name, value in (("CELLS", 100), ("HELD", 10), ("PIECE", 64)):  # many blocks, small batches, cut texts
        monkeypatch.setattr(D, name, value)
    assert sorted(map(tuple, D.audit(df).collect())) == want


def test_empty_table(spark):
    assert D.audit(spark.createDataFrame([], SHAPE)).count() == 0


def test_shares_and_excess_are_exact_for_huge_counts():
    count, whole = np.array([0, 7, 8_999_999_999_999, 4 * 10**12]), np.int64(9 * 10**12)
    assert D.shares(count, whole).tolist() == [1 + 10**9 * (int(c) + 1) // int(whole) for c in count]
    p, q = np.array([10**9 + 1, 1, 5]), np.array([1, 10**9 + 1, 3])
    assert D.excess(p, q).tolist() == [(int(a) - int(b)) ** 2 // int(b) for a, b in zip(p, q)]


def test_query_matches_sql(spark, sf):
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{sf}/documents.parquet'")
    cur = con.execute(D.SQL)
    names = [d[0] for d in cur.description]
    got = D.query(spark, sf)
    assert sorted(got.columns) == sorted(names)
    assert sorted(map(tuple, got.select(*names).collect())) == sorted(cur.fetchall())
