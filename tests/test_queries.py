"""Every registered query against its SQL on the smallest tables, and operators on hand-made cases."""

import duckdb
import pytest

from weavemine.functions import text as T
from weavemine.operators import chunking, evaluation, identity
from weavemine.plans import registry

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def same(rows):
    return sorted(tuple("%.9g" % v if isinstance(v, float) else str(v) for v in r) for r in rows)


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_query_matches_sql(spark, sf, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{sf}/{t}.parquet'")
    cur = con.execute(registry.oracle_sql()[name])
    names = [d[0] for d in cur.description]
    df = registry.queries()[name](spark, sf)
    assert sorted(df.columns) == sorted(names)
    assert same(df.select(*[f"`{n}`" for n in names]).collect()) == same(cur.fetchall())


def one(spark, column, value, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(column(T.F.col("x"))).first()[0]


def test_text_functions(spark):
    assert one(spark, T.identifiers, "see REQ-12 and UTF-8, A-B, xREQ-1, SYS-REQ-7.") == ["REQ-12", "SYS-REQ-7"]
    assert one(spark, T.one_line, " a  b\n c ") == "a b c"
    assert one(spark, lambda c: T.clip(c, 9), "some words here") == "some…"
    assert one(spark, lambda c: T.first_sentence(c, 90), "One v1.2 ends. Two.") == "One v1.2 ends."
    assert one(spark, lambda c: T.slug(c, 20), "..a b/c..") == "a_b_c"
    assert one(spark, T.token_estimate, "Battery 12, ok") == 6
    assert one(spark, T.strip_tags, "<head><title>t</title></head><p>a<b>b</b><script>x</script> c") == "a b c"
    rows = spark.createDataFrame([(x,) for x in ("REQ.1.10", "REQ.2", "REQ.1", "REQ.1.2")], "x string")
    assert [r.x for r in rows.orderBy(T.natural_key(T.F.col("x"))).collect()] == ["REQ.1", "REQ.1.2", "REQ.1.10", "REQ.2"]


def test_windows_and_packing(spark):
    df = spark.createDataFrame([("d", 25), ("e", 0), ("f", 10)], "doc string, n int")
    got = [(r.doc, r.begin, r.end) for r in chunking.token_windows(df, 12, 2, 3).orderBy("doc", "window").collect()]
    assert got == [("d", 0, 10), ("d", 7, 17), ("d", 14, 24), ("d", 21, 25), ("e", 0, 0), ("f", 0, 10)]
    rows = chunking.pack_lines(spark.createDataFrame([("d", "x" * 40 + "\n" + "y" * 40 + "\n" + "z" * 4), ("n", None)], "doc string, text string"), 22).collect()
    assert [(r.doc, r.part, r.first, r.last) for r in rows] == [("d", 0, 0, 1), ("d", 1, 2, 2), ("n", 0, 0, 0)]


def test_metrics_and_agreement(spark):
    ranked = spark.createDataFrame([(1, 5, 1, 0), (1, 3, 2, 2), (1, 7, 3, 1)], "qid int, doc int, rank int, grade int")
    r = evaluation.graded_metrics(ranked).first()
    assert (r.hit_1, r.hit_5, r.mrr_10) == (0, 1, 0.5)
    k = evaluation.kappa(spark.createDataFrame([(1, 1), (1, 1)], "a int, b int"), "a", "b").first()
    assert k.kappa == 1.0
    assert evaluation.kappa(spark.createDataFrame([], "a int, b int"), "a", "b").first().kappa == 0.0
    b = evaluation.bootstrap_mean(spark.createDataFrame([("g", x) for x in (0.0, 1.0, 1.0, 1.0)], "g string, v double"), "g", "v").first()
    assert b.mean == 0.75 and b.low <= 0.75 <= b.high


def test_pairwise_kappa_corrects_for_chance(spark):
    rows = [(1, 2, *v) for v in (["yy"] * 20 + ["yn"] * 5 + ["ny"] * 10 + ["nn"] * 15)] + [(1, 3, "y", "y")] * 2 + [(2, 3, "y", "n")] * 3
    got = [tuple(r) for r in evaluation.pairwise_kappa(spark.createDataFrame(rows, "a int, b int, va string, vb string")).orderBy("a", "b").collect()]
    assert got == [(1, 2, 50, 0.7, 0.4), (1, 3, 2, 1.0, 1.0), (2, 3, 3, 0.0, 0.0)]


def test_kappa_of_judges_equals_that_of_their_pairs(spark, monkeypatch):
    import random

    rnd = random.Random(2)
    rows = [(j, t, rnd.choice(["yes", "no", "so", None])) for j in range(40) for t in range(60) if rnd.random() < 0.5]
    v = spark.createDataFrame(rows, "judge int, task int, verdict string")
    want = evaluation.pairwise_kappa(v.toDF("a", "task", "va").join(v.toDF("b", "task", "vb"), "task").where("a < b"))
    for size in (1 << 20, 500):
        monkeypatch.setattr(evaluation, "TILE_PAIRS", size)
        got = evaluation.judges_kappa(v)
        assert same(got.collect()) == same(want.collect())
        assert "Join" not in got._jdf.queryExecution().executedPlan().toString()
    whole = v.toPandas()
    monkeypatch.setattr(evaluation, "STEP", 300)
    parts = list(evaluation.count_verdicts(whole, whole, True))
    assert len(parts) > 5 and sum(p.n.sum() for p in parts) == sum(k * (k - 1) // 2 for k in whole.groupby("task").size())


def test_kappa_of_many_judges_ships_a_few_bytes_a_verdict(spark, monkeypatch):
    import random

    from pyspark.sql import functions as F

    from tests.test_versions import shuffled

    rnd = random.Random(4)
    rows = sorted({(rnd.randrange(1500), t, rnd.choice(["yes", "no", "so", None])) for t in range(600) for _ in range(12)}, key=str)
    rows = list({r[:2]: r for r in rows}.values())
    v = spark.createDataFrame(rows, "judge long, task long, verdict string")
    want = evaluation.pairwise_kappa(v.toDF("a", "task", "va").join(v.toDF("b", "task", "vb"), "task").where("a < b"))
    monkeypatch.setattr(evaluation, "TILE_ROWS", 1000)
    got = evaluation.judges_kappa(v)
    assert same(got.collect()) == same(want.collect())
    assert shuffled(got) < 60 * len(rows)  # each went to all blocks as a row with its text
    named = evaluation.judges_kappa(v.withColumn("judge", F.format_string("j%05d", "judge")).withColumn("task", F.to_date(F.lit("2020-01-01")) + F.col("task").cast("int")))
    assert same(named.collect()) == same(want.withColumns({c: F.format_string("j%05d", c) for c in "ab"}).collect())


def test_lineage_kinds(spark):
    day = lambda n: n
    marks = [("base", i, day(10), "ann") for i in range(200)]
    marks += [("later", i, day(10), "ann") for i in range(200)] + [("later", 1000 + i, day(30), "ann") for i in range(60)]
    marks += [("forked", i, day(10), "ann") for i in range(200)] + [("forked", 2000 + i, day(30), "bob") for i in range(60)]
    marks += [("copied", i, day(10), "ann") for i in range(200)]
    df = spark.createDataFrame(marks, "model string, id int, day int, maker string")
    saved = spark.createDataFrame([("base", "1"), ("copied", "2"), ("later", "3"), ("forked", "4")], "model string, saved string")
    got = {(r.older, r.newer): r.kind for r in identity.lineage(df, saved).collect()}
    assert got["base", "copied"] == "copy" and got["base", "later"] == "version" and got["base", "forked"] == "derived" and got["later", "forked"] == "root"


def test_lineage_counts_its_pairs_once(spark):
    marks = spark.createDataFrame([(m, i, i, "ann") for m in ("x", "y", "z") for i in range(30)] + [("far", 99, 1, "bob")], "model string, id int, day int, maker string")
    got = identity.lineage(marks, spark.createDataFrame([("x", "1"), ("y", "2"), ("z", "3"), ("far", "4")], "model string, saved string"))
    assert {(r.older, r.newer, r.shared, r.own_a, r.own_b, r.kind) for r in got.collect()} == {(a, b, 30, 0, 0, "copy") for a, b in ("xy", "xz", "yz")}
    assert "FlatMapGroups" not in got._jdf.queryExecution().executedPlan().toString()
