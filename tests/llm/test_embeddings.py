import numpy as np

from weavemine.llm import embeddings as E


def vectors(seed=2):
    rng = np.random.default_rng(seed)
    rows, n = [], 0
    for label in (1, 2, 3):
        for g in range(14):
            base = rng.standard_normal(64)
            for _ in range(rng.integers(1, 9)):
                v = base + rng.standard_normal(64) * rng.choice([0.0, 0.2, 0.38, 0.45])
                rows.append((n, [float(x) for x in v.astype(np.float32)], label))
                n += 1
    hot = [float(x) for x in np.ones(64)]
    rows += [(500 + k, hot, 2) for k in range(40)] + [(600, [2 * x for x in hot], 2), (601, hot, 3), (602, hot, None)]
    rows += [(700, None, 1), (701, [], 1), (702, [0.0] * 64, 1), (703, [float("nan")] * 64, 1), (704, [None] + [1.0] * 63, 1), (705, [float("inf")] + [1.0] * 63, 1), (706, [1.0] * 8, 2)]
    return rows + [(500, hot, 2), (None, hot, 2), (None, None, None)]


def brute(rows):
    ok = lambda v: bool(v) and all(x is not None and np.isfinite(x) for x in v) and any(v)
    n, links, comp = len(rows), [0] * len(rows), list(range(len(rows)))

    def find(i):
        while comp[i] != i:
            i = comp[i]
        return i

    for i in range(n):
        for j in range(i):
            (_, a, la), (_, b, lb) = rows[i], rows[j]
            if la is None or la != lb or not ok(a) or not ok(b) or len(a) != len(b):
                continue
            if np.dot(a, b) / (np.linalg.norm(a) * np.linalg.norm(b)) >= 0.93:
                links[i] += 1
                links[j] += 1
                comp[find(i)] = find(j)
    least = {}
    for i, (d, _, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(d, least.get(find(i), d))
    return sorted(((d, links[i], least.get(find(i)), d == least.get(find(i))) for i, (d, _, _) in enumerate(rows)), key=str)


def test_matches_brute_force(spark, tmp_path):
    df = spark.createDataFrame([(*r, 1) for r in vectors()], "vec_id long, embedding array<float>, label int, block int")
    df.repartition(5).write.parquet(f"{tmp_path}/embeddings.parquet")
    want = brute(vectors())
    assert any(w[1] > 3 for w in want)
    assert sorted((tuple(r) for r in E.query(spark, str(tmp_path)).collect()), key=str) == want
    small = E.near_duplicates(spark.read.parquet(f"{tmp_path}/embeddings.parquet"), block=7)
    assert sorted((tuple(r) for r in small.collect()), key=str) == want


def test_estimates_are_unbiased_and_bounds_hold():
    rng = np.random.default_rng(0)
    a, b = rng.standard_normal((300, 64)), rng.standard_normal((300, 64))
    b[:150] = a[:150] + 0.3 * rng.standard_normal((150, 64))
    a, b = (x / np.linalg.norm(x, axis=1, keepdims=True) for x in (a, b))
    true = a @ b.T
    errors = []
    for seed in range(20):
        turn = E.rotation(64, seed)
        bits, factor = E.encode(a, turn)
        errors.append((E.estimates(bits, factor, b @ turn.T) - true)[:150, :150].diagonal())
        i, j = E.candidates(bits, factor, b @ turn.T, 0.93)
        assert set(zip(*np.nonzero(true >= 0.93))) <= set(zip(i.tolist(), j.tolist()))
        assert len(i) < 0.02 * true.size
    assert abs(np.mean(errors)) < 0.01


def test_empty_table(spark, tmp_path):
    spark.createDataFrame([], "vec_id long, embedding array<float>, label int").write.parquet(f"{tmp_path}/embeddings.parquet")
    assert E.query(spark, str(tmp_path)).count() == 0
