import random
import re
import zlib
from collections import Counter

import pytest

from weavemine.llm import spelling as S


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    k = next((i for i in range(len(a)) if a[i] != b[i]), len(a))
    return a[k + (len(a) == len(b)) :] == b[k + 1 :]


def brute_counts(rows):
    low = lambda t: "".join(c.lower() if "A" <= c <= "Z" else c for c in t)
    out = Counter()
    for d, t, *_ in rows:
        for w in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            w = low(w)
            h = zlib.crc32(f"{'' if d is None else d}:{w}".encode())
            if h % 199 == 0:
                w = w[: h % len(w)] + w[h % len(w) + 1 :]
            if len(w) >= 6:
                out[w] += 1
    return {w: n for w, n in out.items() if n >= 5}


def brute(words):
    near = {w: [x for x in words if one_edit(w, x)] for w in words}
    form = {}
    for w, n in words.items():
        best = min(near[w], key=lambda x: (-words[x], x), default=None)
        form[w] = best if best and words[best] >= 5 * n else None
    out = []
    for w, n in words.items():
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n, len(near[w]), words.get(form[w])))
    return sorted(out, key=str)


def word_sets():
    rnd = random.Random(2)
    few = {"".join(rnd.choice("abÿ") for _ in range(rnd.randrange(3, 9))) for _ in range(500)}
    deep = {"prefixprefix" + "".join(rnd.choice("ab") for _ in range(rnd.randrange(0, 7))) for _ in range(150)}
    chain = {"a" * k for k in range(6, 60)}
    wide = {"stem" + chr(c) + "end" for c in (*range(97, 123), *range(0xC0, 0x100))} | {"stemend", "stem"}
    return [few, deep, chain, wide, few | deep | chain | wide, {"single"}, set()]


@pytest.mark.parametrize("k", range(7))
def test_subtrie_finds_every_pair_once(k):
    words = sorted(word_sets()[k])
    got = [tuple(sorted((words[a], words[b]))) for a, b in (S.Subtrie(words, 0).pairs() if words else [])]
    assert sorted(got) == sorted((a, b) for i, a in enumerate(words) for b in words[i + 1 :] if one_edit(a, b))


def test_split_nodes_change_nothing(spark):
    rnd = random.Random(4)
    words = {w: 5 ** rnd.randrange(1, 7) + rnd.randrange(2) for w in word_sets()[4]}
    df = spark.createDataFrame([*words.items()], "word string, n long").repartition(3).cache()
    want = brute(words)
    for leaf in (10_000, 20, 3):
        assert sorted(map(tuple, S.variants(df, leaf=leaf).collect()), key=str) == want
    assert len(S.split_nodes(df, 3)) > len(S.split_nodes(df, 20)) > 3 and S.split_nodes(df, 10_000) == []


def test_query_on_clean_and_odd_texts(spark, tmp_path):
    rnd = random.Random(9)
    vocab = ["Spelling", "spelling", "speling", "VARIANT", "variant", "variânt", "réunion", "short", "tooth", "Âpresent", "âpresent"]
    rows = [(i if i % 11 else None, " ".join(rnd.choices(vocab, k=rnd.randrange(80))) + rnd.choice(["", "1", "\nß", "×÷÷÷÷÷÷"]), "x") for i in range(500)]
    rows += [(1, None, "x"), (2, "", "x"), (3, "longword " * 200_000, "x"), (4, "q" * 9000 + " " + "q" * 9001, "x")] * 5
    spark.createDataFrame(rows, "doc_id long, text string, word string").write.parquet(f"{tmp_path}/documents.parquet")
    words = brute_counts(rows)
    assert {"spellin", "variant"} & words.keys()
    assert sorted(map(tuple, S.query(spark, str(tmp_path)).collect()), key=str) == brute(words)


def test_query_matches_brute_force_on_the_tables(spark, sf):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    assert sorted(map(tuple, S.query(spark, sf).collect()), key=str) == brute(brute_counts(rows))


def test_empty_table(spark):
    assert S.variants(spark.createDataFrame([], "word string, n long")).count() == 0
    assert S.word_counts(spark.createDataFrame([], "doc_id long, text string")).count() == 0
