"""Searches by every word of a query text, on hand-made tables."""

import re
from collections import Counter
from math import log

import pytest

from weavemine.plans import registry

TEXTS = {1: "a b c d e f g h", 2: "late late words", 3: "words", 4: "none of it", 5: "a late b"}
QUERY = "a b c d e f g h late words a"


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    d = tmp_path_factory.mktemp("search")
    spark.createDataFrame([(k, t, "s", "en") for k, t in TEXTS.items()], "doc_id long, text string, source string, lang string").write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame([(7, QUERY)], "item_id long, text string").write.parquet(f"{d}/benchmark.parquet")
    return str(d)


def test_bm25_takes_every_word_of_the_query(spark, folder):
    docs = {k: t.split() for k, t in TEXTS.items()}
    average = sum(map(len, docs.values())) / len(docs)
    want = {}
    for k, words in docs.items():
        for w in set(QUERY.split()) & set(words):
            df, tf = sum(w in x for x in docs.values()), Counter(words)[w]
            idf = log(1 + (len(docs) - df + 0.5) / (df + 0.5))
            want[k] = want.get(k, 0) + idf * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len(words) / average))
    got = {r.doc: r.score for r in registry.queries()["bm25_topk"](spark, folder).collect()}
    assert got == {k: pytest.approx(v, abs=2e-6) for k, v in want.items()} and set(got) == {1, 2, 3, 5}


def test_snippets_of_every_word(spark, folder):
    rows = [(r.item_id, r.doc_id, r.snippet) for r in registry.queries()["snippets"](spark, folder).collect()]
    assert sorted(rows) == sorted((7, k, t) for k, t in TEXTS.items() for w in set(QUERY.split()) & set(t.split()))


def test_repeated_ids_are_one_document_and_ties_go_by_id(spark):
    from weavemine.operators import search as S

    texts = [(1, "a a b"), (1, "a c d"), (1, "a x"), (2, None), (None, "b"), (3, "b"), (4, "b")]
    docs = spark.createDataFrame(texts, "doc long, text string")
    asked = spark.createDataFrame([(q, w) for q in (5, 6) for w in ("a", "b")] + [(7, "none")], "qid int, word string")
    counts = S.WordCounts.build(docs, asked)
    want = {(r.qid, r.doc): (round(r.score, 6), r.matched) for r in S.bm25(docs, asked).collect()}
    got = counts.best(10).collect()
    assert {(r.qid, r.doc): r.score for r in got} == {k: pytest.approx(v[0], abs=2e-6) for k, v in want.items()}
    assert {r.doc: r.rank for r in counts.best(3, "matched").collect() if r.qid == 5 and r.doc}[1] == 1
    plan = counts.best(10)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and plan.count("Exchange") == 1  # only the best of each task move
    n = counts.tally(spark.createDataFrame([(1, 2), (3, 2)], "doc long, grade int"))
    assert {(r.qid, r.grade): r.n for r in n.collect()} == {(q, g): 2 for q in (5, 6) for g in (0, 2)}


def test_dense_search_equals_all_pairs_in_any_blocks(spark, monkeypatch):
    import math
    import random

    from weavemine.operators import search as S

    rnd = random.Random(3)
    vectors = {i: [rnd.choice([-1.0, 0.5, 2.0]) for _ in range(3)] for i in range(90)}  # many ties
    df = spark.createDataFrame([*vectors.items(), (500, None)], "vec_id long, embedding array<float>")
    cos = lambda a, b: round(sum(x * y for x, y in zip(a, b)) / math.sqrt(sum(x * x for x in a)) / math.sqrt(sum(x * x for x in b)), 9)
    want = set()
    for q in range(0, 90, 7):
        best = sorted((-cos(vectors[q], v), i) for i, v in vectors.items() if i != q)[:5]
        want |= {(q, i, r + 1) for r, (_, i) in enumerate(best)}
    for asked, held in ((4096, 16384), (4, 11)):
        monkeypatch.setattr(S, "ASKED", asked)
        monkeypatch.setattr(S, "HELD", held)
        got = S.dense_top_k(df, df.where("vec_id % 7 = 0 AND vec_id < 90"), 5)
        assert {(r.qid, r.vec_id, r["rank"]) for r in got.collect()} == want
    assert "NestedLoop" not in got._jdf.queryExecution().executedPlan().toString()
    few = S.dense_top_k(df.where("vec_id IN (0, 1, 500)"), df.where("vec_id = 0"), 5).orderBy("rank").collect()
    assert [(r.vec_id, r.score is None) for r in few] == [(1, False), (500, True)]


def test_a_text_is_lower_cased_once_and_cut_once_a_word(spark, folder):
    plan = registry.queries()["snippets"](spark, folder)._jdf.queryExecution().optimizedPlan().toString()
    assert re.search(r"locate\(word#\d+, low#", plan) and not re.search(r"locate\(word#\d+, lower", plan)


def test_bootstrap_draws_in_blocks(spark, monkeypatch):
    from weavemine.operators import evaluation

    rows = [("a", float(i)) for i in range(300)] + [(None, 1.0)] * 5
    df = spark.createDataFrame(rows, "g string, v double")
    for size in (50_000, 40):
        monkeypatch.setattr(evaluation, "DRAWN", size)
        got = {r.g: r for r in evaluation.bootstrap_mean(df, "g", "v").collect()}
        half = 1.96 * (300**2 / 12 / 300) ** 0.5
        assert got["a"].mean == 149.5 and got["a"].low == pytest.approx(149.5 - half, abs=1) and got["a"].high == pytest.approx(149.5 + half, abs=1)
        assert tuple(got[None])[1:] == (1.0, 1.0, 1.0)
