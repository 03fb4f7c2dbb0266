import random

from weavemine.llm import nearcopies as N


def shingles(text):
    words = (text or "").lower().split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def kept(rows):
    """Least ids of the components of Jaccard >= 0.8, every pair compared."""
    sets = [shingles(t) for _, t in rows]
    comp = list(range(len(rows)))

    def find(i):
        while comp[i] != i:
            i = comp[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if 5 * both >= 4 * (len(sets[i]) + len(sets[j]) - both):
                comp[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        least[find(i)] = min(least.get(find(i), d), d)
    return sorted(least.values())


def corpus():
    rnd = random.Random(8)
    vocab = [f"w{i}é" for i in range(300)]
    passage = [rnd.choice(vocab) for _ in range(25)]  # in every second text
    rows = []
    for d in range(90):
        words = [rnd.choice(vocab) for _ in range(rnd.choice([1, 3, 5, 30, 90, 200]))]
        words += passage if d % 2 else []
        rows.append((d * 10, " ".join(words)))
        for c in range(1, 6):
            w = list(words)
            for _ in range(min(rnd.randrange(1, 6), len(w) - 1)):
                k = rnd.randrange(len(w))
                w[k : k + 1] = rnd.choice([[], [f"edit{d}{c}"], [w[k], "more"]])
            rows.append((d * 10 + c, "\t".join(w).upper().replace("É", "é")))
    base = [rnd.choice(vocab) for _ in range(120)]
    for c in range(60):  # one large group of near copies
        w = list(base)
        w[rnd.randrange(120)] = f"x{c}"
        rows.append((5000 + c, " ".join(w)))
    return rows + [(7000, None), (7001, ""), (7002, " \n\x0b"), (7003, rows[3][1])]


def test_near_copies_equal_all_pairs(spark):
    rows = corpus()
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = kept(rows)
    got = sorted(r.doc_id for r in N.keep_one(df).collect())
    assert got == want
    assert len(want) < len(rows) - 200


def test_one_edit_is_a_near_copy_in_the_pipeline(spark, tmp_path):
    import corpus_pipeline

    words = [f"word{k}" for k in range(90)]
    edited = [*words[:40], "other", *words[41:]]  # 81 of 91 five-word shingles in common
    df = spark.createDataFrame([(1, " ".join(words), "en"), (2, " ".join(edited), "en"), (3, " ".join(words[:50]), "en")], "doc_id long, text string, lang string")
    stage = dict(corpus_pipeline.STAGES)["simhash"]
    assert sorted(r.doc_id for r in stage(spark, df, str(tmp_path)).collect()) == [1, 3]
