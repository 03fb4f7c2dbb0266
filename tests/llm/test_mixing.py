import hashlib
import re

import pytest

from weavemine.llm import mixing as M


def rows():
    out = [(i, "word " * (1 + i * 37 % 90), f"s{i % 5}" if i % 11 else None) for i in range(400)]
    return out + [(None, "a b c", "s1"), (7, "x " * 9, "s0"), (7, "x " * 9, "s0"), (900, None, "s2"), (901, "", None), (902, "z " * 30000, "solo"), (903, " ", "void")]


def brute(rows):
    sized = [(d, len(re.findall(r"[^\x20\x09-\x0D]+", t or "")), s) for d, t, s in rows]
    place = [hashlib.md5(f"{'' if d is None else d}|{t or ''}".encode()).hexdigest() for d, t, _ in rows]
    total = {}
    for _, n, s in sized:
        total[s] = total.get(s, 0) + n
    order = sorted(total, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(order)}
    target, free, left = {}, set(order), 1.5 * sum(total.values())
    while free:
        w = sum(weight[s] for s in free)
        over = [s for s in free if left * weight[s] / w > 2 * total[s]]
        if not over:
            target |= {s: left * weight[s] / w for s in free}
            break
        for s in over:
            target[s] = 2.0 * total[s]
        free -= set(over)
        left -= sum(target[s] for s in over)
    out, at = [], {}
    for _, (d, n, s) in sorted(zip(place, sized), key=lambda r: (r[0], r[1][1])):
        c = at.get(s, 0)
        at[s] = c + n
        taken = sum(n for p in range(2) if n and c + n / 2 + p * total[s] < target[s])
        out.append((d, n, total[s], target[s], taken))
    return sorted(out, key=str), target


def test_query_matches_brute_force(spark, tmp_path):
    df = spark.createDataFrame(rows(), "doc_id long, text string, source string").withColumn("rank", M.F.lit(1)).withColumn("_h", M.F.lit("x"))
    df.write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted(((r.doc_id, r.size, r.source_size, r.target, r.taken) for r in M.query(spark, str(tmp_path)).collect()), key=str)
    want, _ = brute(rows())
    assert [g[:3] + g[4:] for g in got] == [w[:3] + w[4:] for w in want]
    assert [g[3] for g in got] == pytest.approx([w[3] for w in want])


def test_mix_is_ordered_whole_and_repeatable(spark):
    df = spark.createDataFrame(rows(), "doc_id long, text string, source string").withColumn("size", M.F.lit("clash")).withColumn("position", M.F.lit(0))
    a = [tuple(r) for r in M.mix(df).collect()]
    assert a == [tuple(r) for r in M.mix(df.repartition(3)).collect()]
    assert len(a[0]) == 5
    taken = sum(len((r[1] or "").split()) for r in a)
    want = sum(r[4] for r in brute(rows())[0])
    assert taken == want


def test_rising_sources_come_late(spark):
    df = spark.createDataFrame([(i, "w " * 10, "ab"[i % 2]) for i in range(2000)], "doc_id long, text string, source string")
    key = M.order_key(M.F.col("doc_id"), M.F.col("text")).alias("order_key")
    laid = M.with_copies(M.lay_out(df.select("doc_id", "source", M.word_count(M.F.col("text")).alias("size"), key))).where("copies > 0")
    mean = {r.source: r.m for r in laid.groupBy("source").agg(M.F.avg("position").alias("m")).collect()}
    assert mean["a"] > 0.25 and 0 <= mean["b"] <= 1


def test_schedule_inverse_integrates_back():
    knots = ((0.0, 0.5), (0.25, 2.0), (1.0, 0.0))
    import duckdb

    for k in range(101):
        f = k / 100
        t = duckdb.connect().execute(f"SELECT {M.inverse_schedule_sql(f'CAST({f} AS DOUBLE)', knots)}").fetchone()[0]
        area = lambda x: 0.5 * x + 3 * x * x if x <= 0.25 else 0.3125 + 2 * (x - 0.25) - (x - 0.25) ** 2 * 2 / 1.5
        assert area(t) / area(1.0) == pytest.approx(f, abs=1e-6)


def test_empty_table(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, text string, source string").write.parquet(f"{tmp_path}/documents.parquet")
    assert M.query(spark, str(tmp_path)).count() == 0


def test_every_pass_has_its_own_place(spark):
    df = spark.createDataFrame([(i, "w " * 10, "abc"[min(i % 12, 2)]) for i in range(1200)], "doc_id long, text string, source string")
    key = M.order_key(M.F.col("doc_id"), M.F.col("text")).alias("order_key")
    laid = M.lay_out(df.select("doc_id", "source", M.word_count(M.F.col("text")).alias("size"), key))
    rows = M.with_copies(laid).collect()
    assert max(r.copies for r in rows) == 2
    for r in rows:
        assert len(r.positions) == r.copies and r.position == (r.positions[0] if r.copies else None)
        at = [(p * r.source_size + r.begins + r.size / 2) / r.target for p in range(2)]
        at = [f for f in at if f < 1]
        for f, t in zip(at, r.positions, strict=True):
            knots = M.SCHEDULES[r.source_rank % 3]
            area = lambda x: sum((min(x, b) - a) * (v + v + (w - v) * (min(x, b) - a) / (b - a)) / 2 for (a, v), (b, w) in zip(knots, knots[1:]) if x > a)
            assert area(t) / area(1.0) == pytest.approx(f, abs=1e-6)
    placed = [r._at for r in M.in_training_order(laid).collect()]
    assert placed == sorted(placed) and len(placed) == sum(r.copies for r in rows)
