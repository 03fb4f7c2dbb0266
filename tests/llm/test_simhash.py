import random

import xxhash

from weavemine.llm import simhash as S


def plain(text):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").replace("\t", " ").replace("\n", " ").replace("\x0b", " ")
    words = [w for w in words.replace("\x0c", " ").replace("\r", " ").split(" ") if w]
    if not words:
        return 0
    grams = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hs = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << k for k in range(64) if 2 * sum(h >> k & 1 for h in hs) > len(hs))


def brute(rows):
    fps = [plain(t) for _, t in rows]
    comp = list(range(len(rows)))

    def find(i):
        while comp[i] != i:
            i = comp[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 2:
                comp[find(i)] = find(j)
    ids = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            ids[find(i)] = min(ids.get(find(i), d), d)
    return sorted(((d, f"{fps[i]:016x}", ids.get(find(i))) for i, (d, _) in enumerate(rows)), key=str)


def corpus():
    rnd = random.Random(3)
    vocab = [f"w{i}é" for i in range(400)]
    rows = []
    for d in range(120):
        words = [rnd.choice(vocab) for _ in range(rnd.choice([0, 1, 2, 3, 40, 200]))]
        rows.append((d, " ".join(words)))
        if d % 7 == 0 and words:
            for c in range(4):
                w = list(words)
                w[rnd.randrange(len(w))] = f"edit{c}"
                rows.append((1000 + d * 10 + c, "\t".join(w).upper().replace("É", "é")))
    return rows + [(5000, None), (5001, ""), (5002, " \n\x0b"), (None, "lone words here"), (7, rows[7][1]), (7, rows[7][1]), (6000, "b " * 70000)]


def test_query_matches_brute_force(spark, tmp_path):
    rows = corpus()
    spark.createDataFrame(rows, "doc_id long, text string").withColumn("fp", S.F.lit("clash")).withColumn("k", S.F.lit(1)).write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted(((r.doc_id, r.fingerprint, r.component_id) for r in S.query(spark, str(tmp_path)).collect()), key=str)
    assert got == brute(rows)


def test_hot_postings_link_exactly(spark):
    rnd = random.Random(9)
    fps = {0}
    base = rnd.getrandbits(62)
    while len(fps) < 300:
        x = base
        for _ in range(rnd.randrange(1, 7)):
            x ^= 1 << rnd.randrange(62)
        fps.add(x)
    fps = sorted(fps)
    df = spark.createDataFrame([(x,) for x in fps], "fp long")
    want = {}
    for x in fps:
        want[x] = x
    changed = True
    while changed:
        changed = False
        for a in fps:
            for b in fps:
                if (a ^ b).bit_count() <= 2 and want[a] > want[b]:
                    want[a] = want[b]
                    changed = True
    for posting in (64, 1, 10_000):
        cc = S.connected_components(S.links(df, posting=posting))
        got = {r.node: r.component for r in cc.collect()}
        assert {x: got.get(x, x) for x in fps} == want


def test_empty_table(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    assert S.query(spark, str(tmp_path)).count() == 0
