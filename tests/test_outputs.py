import json

from pyspark.sql import functions as F

from weavemine import sinks as K
from weavemine.operators import subjects as U
from weavemine.sources import units as N


def rows(df, *order):
    return [tuple(r) for r in df.orderBy(*order).collect()]


def test_files_and_publishing(spark, tmp_path):
    df = spark.createDataFrame([(1, 'a "q"\nb', None), (2, "c", "d")], "k int, t string, n string")
    K.write_csv(df, f"{tmp_path}/csv")
    assert rows(N.read_csv(spark, f"{tmp_path}/csv").select("k", "t"), "k") == [("1", 'a "q"\nb'), ("2", "c")]
    K.write_jsonl(df, f"{tmp_path}/jsonl")
    assert rows(N.read_jsonl(spark, f"{tmp_path}/jsonl", "k int, t string, n string"), "k") == [(1, 'a "q"\nb', None), (2, "c", "d")]
    K.publish(spark, str(tmp_path / "tree"), {"x": df})
    K.publish(spark, str(tmp_path / "tree"), {"x": df.where("k = 2"), "y": df})
    assert K.published(spark, str(tmp_path / "tree"), "x").count() == 1 and K.published(spark, str(tmp_path / "tree"), "y").count() == 2
    s = K.sheet(df, ["k", "t"], ["k"], 4, most=1).collect()
    assert [tuple(r) for r in s] == [(1, 1, "a \"…")]


def test_chunk_files(spark):
    found = F.create_map(F.lit("b"), F.array(F.lit("1"), F.lit("2")), F.lit("a"), F.array(F.lit("x")))
    r = spark.range(1).select(K.chunk_text(F.lit("Head\n\ntext \n"), F.lit("9ffd7a2c99"), F.lit("14d101e0b1d2ff"), F.lit("sha256:9f#1"), found).alias("t"), K.chunk_text(F.lit("x"), F.lit("9ffd7a2c99"), F.lit("14d101e0b1d2ff"), F.lit("l"), found, "id").alias("i")).first()
    assert r.t == "Head\n\ntext\n\nSource: sha256:9f#1\nFound with: a=x; b=1, 2\n" and "Source: [9ffd7a2c:14d101e0b1d2]\n" in r.i
    chunks = spark.createDataFrame([("f", "1", "t", "element", "# Same\nx"), ("f", "2", "t", "element", "# Same\nx"), ("f", "3", "t", "element", "other")], "folder string, id string, title string, kind string, body string")
    files = {json.loads(r.meta)["chunk_id"]: json.loads(r.meta) for r in K.chunk_files(chunks).collect()}
    assert files["1"]["same_text_chunk_ids"] == ["2"] and files["1"]["title"] == "Same" and "same_text_chunk_ids" not in files["3"]
    w = spark.createDataFrame([("s", "n", "{}")], "content_sha256 string, name string, summary string")
    m = K.manifest(w, spark.createDataFrame([("s", "b", "2"), ("s", "a", "1")], "content_sha256 string, path string, sha256 string"), spark.createDataFrame([("z", "bad", "no")], "sha256 string, name string, error string"))
    got = {r.token: json.loads(r.record) for r in m.collect()}
    assert [f["path"] for f in got["sha256:s"]["files"]] == ["a", "b"] and got["sha256:z"]["error"] == "no"


def test_units(spark):
    c = spark.createDataFrame([("1", "t", "x", ("generated:summary", "register", "e", "p1")), ("2", "t", "y", ("element:details", None, None, "p2"))], N.CHUNK)
    u = N.chunk_units(c)
    assert rows(u, "id") == [("1", "x", "e", "generated:summary#register", "p1"), ("2", "y", None, "element:details", "p2")]
    assert [r.id for r in N.run_units(u, project="p", details=False, without=["generated:*#r?gister"]).collect()] == [] and N.run_units(u, without=["generated:*"]).count() == 1
    t = spark.createDataFrame([("/rag/text/A-1/f.txt", "body")], "path string, text string")
    m = spark.createDataFrame([("A-1", "f.txt", "c", "e", "k", "p")], "folder string, file string, chunk_id string, element_id string, kind string, project string")
    assert rows(N.file_units(t, m), "id") == [("c", "body", "e", "k", "p")]
    e = spark.createDataFrame([("p", "B", bytearray(b"\x89PNG" + b"0" * 80)), ("p", "C", bytearray(b"text" * 40))], "project string, entry string, content binary")
    assert [(r.entry, r.media_type) for r in N.embedded_images(e).collect()] == [("B", "image/png")]


def test_subjects(spark):
    n = spark.createDataFrame([(1,), (10,), (25,), (1000,)], "n int")
    assert [r.t for r in n.select(U.target_groups(F.col("n")).alias("t")).collect()] == [2, 2, 4, 15]
    a = spark.createDataFrame([("x", "2"), ("y", "9"), ("z", "no"), ("w", None)], "key string, answer string")
    assert rows(U.placed_answers(a, 3), "key") == [("w", None), ("x", 1), ("y", None), ("z", None)]
    shows = spark.createDataFrame([("a", "f", "1"), ("a", "f", "2"), ("b", "g", "1"), ("c", "f", "1")], "id string, family string, element string")
    assert rows(U.shared_elements(shows), "a") == [("a", "b", 1.0), ("b", "c", 1.0)]
    words = spark.createDataFrame([("a", "f", "pump"), ("b", "g", "pump"), ("c", "f", "x"), ("d", "g", "y")], "id string, family string, word string")
    g = {(r.a, r.b): round(r.weight, 6) for r in U.subject_graph(words, shows).collect()}
    assert g == {("a", "b"): 2.0, ("b", "c"): 1.0}
    import math

    d = spark.createDataFrame([("p", "e1"), ("q", "e1"), ("r", "e2"), ("s", "e3")], "diagram string, feature string")
    w = {(r.a, r.b): r.weight for r in U.diagram_graph(d, d.where("feature = 'none'"), spark.createDataFrame([("e1", "e2")], "source string, target string")).collect()}
    assert abs(w["p", "q"] - math.log(2)) < 1e-9 and abs(w["p", "r"] - 0.5 * math.log(2)) < 1e-9 and len(w) == 3
    items = spark.createDataFrame([("i", 1, "A::B::C::D"), ("j", 1, "A::B::C::E"), ("k", 2, "X")], "key string, group int, package string")
    assert rows(U.common_package(items, "group"), "group") == [(1, "B::C"), (2, "X")]
    assert [(r.group, r.pos, r.size) for r in U.view_groups(items.select("key", "group")).orderBy("pos").collect()] == [(1, 1, 2), (2, 2, 1)]
    assert {r.group for r in U.random_split(items, "key", 2).collect()} == {0, 1}
    t = U.topic_measures(spark.createDataFrame([(1, "a", "f"), (1, "b", "g"), (2, "c", "f")], "topic int, subject string, family string")).first()
    assert tuple(t) == (2, 0.666667, 0.666667, 1.5)
    v = spark.createDataFrame([("f", 20, "llm", 1, 5), ("f", 20, "shared", 2, 0), ("g", 5, "llm", 1, 0), ("h", 20, "llm", 1, 1)], "family string, items int, view string, pos int, unsorted int")
    assert rows(U.default_view(v), "family") == [("f", "shared"), ("g", "packages"), ("h", "llm")]
    s = U.signature(items, "group", "key", "package")
    kept, again = U.carried_forward(s.withColumnRenamed("group", "family"), s.select(F.col("group").alias("family"), F.when(F.col("group") == 1, F.col("signature")).otherwise("old").alias("signature"), F.lit("r").alias("record")))
    assert [r.family for r in kept.collect()] == [1] and [r.family for r in again.collect()] == [2]


def test_trials(spark):
    p = U.paired_difference(spark.createDataFrame([(1, 0.5, 0.7), (2, 0.5, 0.6)], "id int, first double, later double")).first()
    assert (p.n, round(p.difference, 6), round(p.se, 6)) == (2, 0.15, 0.05)
    assert spark.range(1).select(U.clearly_better(F.lit(0.15), F.lit(0.05))).first()[0] and not spark.range(1).select(U.clearly_better(F.lit(0.04), F.lit(0.0))).first()[0]
    r = spark.createDataFrame([("s", True, 1, 2, 1, 1, 0, 0), ("s", False, 1, 2, 0, 0, 0, 0), ("l", False, 0, 0, 0, 0, 0, 0)], "stratum string, asked boolean, read int, words int, found int, links int, invented int, given int")
    assert [x.stratum for x in U.thin_groups(r, "stratum").collect()] == ["l"]
    assert {(x.stratum, x.n, x.names, x.found, x.invented) for x in U.rates(r, "stratum").collect()} == {("s", 2, 0.5, 1.0, None), ("l", 1, None, None, None), (None, 3, 0.5, 1.0, None)}
    pts = [("a", 8, 0.2), ("a", 10, 0.8), ("a", 12, 0.6), ("a", 14, 1.0), ("b", 8, 0.95), ("c", 8, 0.1)]
    th = dict(rows(U.reading_threshold(spark.createDataFrame(pts, "area string, size int, share double"), "area"), "area"))
    assert th == {"a": 13.33, "b": 8.0, "c": None}
