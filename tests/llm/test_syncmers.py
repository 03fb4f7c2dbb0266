import hashlib
import random
import re

from weavemine.llm import syncmers as S


def md5(s):
    return hashlib.md5(s.encode()).hexdigest()


def anchors(text):
    t = re.findall(r"[^\x20\x09-\x0D]{1,16}", text)
    if len(t) < 5:
        return [(0, md5(" ".join(t))[:8])] if t else []
    h = [md5(f"{a} {b}") for a, b in zip(t, t[1:])]
    return [(i, md5(" ".join(t[i : i + 5]))[:8]) for i in range(len(t) - 4) if min(h[i : i + 4]) in (h[i], h[i + 3])]


def near(a, b):
    a, b = {x for _, x in a}, {x for _, x in b}
    return len(a & b) / len(a | b) if a | b else 1.0


def brute(rows):
    rows = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0)))
    out = []
    for k, (d, t) in enumerate(rows):
        t, n = t or "", rows[(k + 1) % len(rows)][1] or ""
        cut = len(t) // 3
        e = t[: len(t) - cut] + n[:cut]
        fp = lambda x: "".join(h for _, h in anchors(x))
        out.append((d, len(t), hashlib.sha256(e.encode()).hexdigest(), fp(t), fp(e), near(anchors(t), anchors(e)), near(anchors(t), anchors(n))))
    return sorted(out, key=str)


def corpus(step):
    rnd = random.Random(8)
    vocab = ["añ", "b🙂c", "word", "thing", "über", "x" * 40, "de"]
    rows = [(d * step, rnd.choice([" ", "\n"]).join(rnd.choice(vocab) for _ in range(rnd.choice([0, 1, 3, 4, 5, 6, 60])))) for d in range(-40, 150)]
    return rows + [(151 * step, None), (152 * step, ""), (153 * step, rows[9][1]), (154 * step, rows[9][1]), (None, "no id"), (155 * step, "q w e r t y " * 20000)]


def check(spark, tmp_path, rows):
    df = spark.createDataFrame([(d, t, "x", 1) for d, t in rows], "doc_id long, text string, first string, block int")
    df.repartition(7).write.parquet(f"{tmp_path}/documents.parquet")
    assert sorted((tuple(r) for r in S.query(spark, str(tmp_path)).collect()), key=str) == brute(rows)


def test_dense_ids(spark, tmp_path):
    check(spark, tmp_path, corpus(1))


def test_sparse_ids(spark, tmp_path):
    check(spark, tmp_path, corpus(1_000_003))


def test_single_row_and_repeated_ids(spark, tmp_path):
    check(spark, tmp_path / "one", [(5, "a b c d e f g")])
    rows = [(1, "same text here and there")] * 3 + [(2, "other")]
    check(spark, tmp_path / "two", rows)


def test_empty_table(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    assert S.query(spark, str(tmp_path)).count() == 0


def test_anchors_are_context_free(spark):
    passage = " ".join(f"w{i}" for i in range(60))
    df = S.with_anchors(spark.createDataFrame([(f"a b c {passage} d",), (f"{passage} x y z",)], "text string"), "text", "a")
    a, b = ({(x.pos, x.hash) for x in r.a} for r in df.collect())
    assert len({(p - 3, h) for p, h in a} & b) > 20
