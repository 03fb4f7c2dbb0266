import hashlib
import random

import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline
from weavemine.llm import mixing, pii, toxicity

from .test_mixing import brute as mixed
from .test_simhash import plain


def corpus():
    rnd = random.Random(12)
    vocab = ["".join(rnd.choice("aeioulnrst") for _ in range(5)) for _ in range(200)]
    rows, labels = [], []
    for d in range(160):
        words = [rnd.choice(vocab) for _ in range(rnd.randrange(30, 90))]
        toxic = rnd.random() < 0.25
        if toxic:
            words[::9] = ["vile"] * len(words[::9])
        if d % 5 == 0:
            words += [f"ann.{d}@mail.example.com", "then", f"ann.{d}"]
        text = " ".join(words)
        rows.append((d, text, "en", f"s{d % 4}", len(text)))
        labels.append((d, int(rnd.random() < 0.8), int(toxic)))
        if d % 10 == 0:
            rows.append((1000 + d, text, "en", "s1", len(text)))
    rows += [(None, None, None, None, None), (2000, "", "fr", "s2", 0), rows[3], rows[3]]
    return rows, labels


def test_run_matches_brute_force(spark, tmp_path):
    rows, labels = corpus()
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    chain = toxicity.fit_chain(docs, spark.read.parquet(f"{tmp_path}/labels.parquet"))
    left = [r for r in rows if chain.probabilities(r[1])[1] < 0.5]
    assert 100 < len(left) < len(rows)
    kept, fps = [], []
    for r in sorted(left, key=lambda r: (r[0] is None, r[0] or 0)):
        fp = plain(r[1])
        near = [i for i, f in enumerate(fps) if any((x ^ fp).bit_count() <= 2 for x in f)]
        if near:
            merged = set().union(*(fps[i] for i in near)) | {fp}
            for i in reversed(near):
                del fps[i]
                if i != near[0]:
                    kept.pop(i)
            fps.insert(near[0], merged)
        else:
            fps.append({fp})
            kept.append(r)
    clean = [(d, pii.redacted(t, pii.trained()), s) for d, t, _, s, _ in kept]
    assert any("<email>" in (t or "") for _, t, _ in clean)
    lib = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    by_id = {d: t for d, t, _ in clean}
    want = []
    for d, size, _, _, taken in mixed(clean)[0]:
        want += [(d, lib.encode(by_id[d], add_special_tokens=False).ids)] * (taken // size if size else 0)
    got = [(r.doc_id, r.ids) for r in corpus_pipeline.run(spark, str(tmp_path)).collect()]
    assert sorted(got) == sorted(want)


def test_stages_keep_the_columns_and_take_empty_tables(spark, tmp_path):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame([], schema).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, str(tmp_path)).columns == docs.columns, name
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
