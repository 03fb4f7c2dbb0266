import random

import numpy as np

from weavemine.llm import toxicity as T


def corpus(n, seed):
    rnd = random.Random(seed)
    vocab = ["".join(rnd.choice("aeioulnrst") for _ in range(5)) for _ in range(300)]
    out = []
    for d in range(n):
        words = [rnd.choice(vocab) for _ in range(rnd.randrange(20, 120))]
        toxic = rnd.random() < 0.25
        poor = rnd.random() < (0.7 if toxic else 0.2)
        if toxic:
            for _ in range(4):
                words[rnd.randrange(len(words))] = rnd.choice(["Vile!", "nasty", "hateful" + rnd.choice(vocab)])
        if poor:
            words += ["###", "buy", "now"] * 3
        out.append((d, " ".join(words), int(not poor), int(toxic)))
    return out


def test_query_on_held_out_documents(spark, tmp_path):
    rows = corpus(500, 1)
    docs = [(d, t, "x") for d, t, _, _ in rows] + [(None, None, "x"), (900, "", None), (901, "nasty vile hatefuls " * 20000, "x"), (0, rows[0][1], "x")]
    spark.createDataFrame(docs, "doc_id long, text string, toxic string").write.parquet(f"{tmp_path}/documents.parquet")
    labels = [(d, q, x) for d, _, q, x in rows[:300]] + [(901, None, 1), (None, 0, 1)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    out = T.query(spark, str(tmp_path)).collect()
    assert len(out) == len(docs)
    got = {r.doc_id: r for r in out}
    truth = {d: x for d, _, _, x in rows[300:]}
    assert np.mean([got[d].toxic == bool(x) for d, x in truth.items()]) > 0.95
    assert got[901].toxic and not got[900].toxic and not got[None].toxic and got[5].kept == (not got[5].toxic)
    docs_df = spark.read.parquet(f"{tmp_path}/documents.parquet")
    left = T.reject(docs_df, T.fit_chain(docs_df, spark.read.parquet(f"{tmp_path}/labels.parquet")))
    assert left.columns == docs_df.columns and left.count() == sum(r.kept for r in out)


def test_later_models_are_trained_on_out_of_fold_probabilities():
    rows = corpus(300, 2)
    poor = [1 - q for _, _, q, _ in rows]
    toxic = [x for *_, x in rows]
    chain = T.train(T.Hits.of([t for _, t, _, _ in rows]), dict(zip(T.CATEGORIES, (poor, toxic, [a & b for a, b in zip(poor, toxic)]))), [d % 5 for d, *_ in rows])
    assert [len(m.weights) - len(m.vocabulary) for m in chain.models] == [1, 2, 3]
    assert chain.models[2].weights[-1] > 0  # toxic documents make toxic_poor likelier


def test_features_are_chosen_inside_folds_and_from_both_classes():
    texts = ["vile a"] * 20 + ["kind a"] * 60 + ["secret a"] * 20
    y, use = np.array([1.0] * 20 + [0.0] * 60 + [1.0] * 20), np.array([True] * 80 + [False] * 20)
    hits = T.Hits.of(texts)
    chosen = set(hits.choose(y, use, 1500).tolist())
    assert set(T.slots("vile")) <= chosen and set(T.slots("kind")) <= chosen
    assert not chosen & set(T.slots("secret")) and not chosen & set(T.slots("a"))
    assert len(T.Hits.of(["once", "twice twice", "twice"]).f) == 0


def test_sample_is_bounded_where_ids_repeat(spark):
    docs = spark.createDataFrame([(1, f"text {k}") for k in range(50)] + [(2, "other")], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1, 0), (1, 0, 1), (2, 1, 1)], "doc_id long, quality int, toxic int")
    rows = T.sample_counts(docs, labels, 30).collect()
    assert len(rows) == 30 and "text" not in rows[0].asDict()
    assert T.sample_counts(docs, labels, 1000).count() == 101


def test_no_labels_one_class_and_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    p = T.score(docs, T.fit_chain(docs, none)).collect()
    assert all(r.p_toxic == 0.5 for r in p)
    clean = spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int")
    assert all(r.p_toxic < 0.5 for r in T.score(docs, T.fit_chain(docs, clean)).collect())
    assert T.score(docs.limit(0), T.fit_chain(docs, none)).count() == 0
