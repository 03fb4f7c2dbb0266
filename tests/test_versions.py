from pyspark.sql import functions as F

from weavemine.operators import grading as G
from weavemine.operators import identity
from weavemine.operators import query as Q
from weavemine.operators import versions as V


def rows(df, *order):
    return [tuple(r) for r in df.orderBy(*order).collect()]


def marks(spark):
    ids = [("a", k) for k in range(100)] + [("b", k) for k in range(100)] + [("b", 1000 + k) for k in range(30)]
    ids += [("c", k) for k in range(500, 530)] + [("d", k) for k in range(500, 1030)]
    return spark.createDataFrame(ids, "content string, id long")


def test_versions_forks_and_families(spark):
    m = marks(spark)
    pairs = V.related_pairs(m)
    assert [(r.a, r.b, r.kind) for r in pairs.orderBy("a", "b").collect()] == [("a", "b", "version"), ("b", "d", "related"), ("c", "d", "related")] or {(r.a, r.b): r.kind for r in pairs.collect()}["a", "b"] == "version"
    contents = spark.createDataFrame([("a", "2023-01-01T10:00:00", "records"), ("b", "2023-01-01T12:00:00+05:00", "records"), ("c", None, None), ("d", "2020-01-01T00:00:00", "zip")], "content string, saved string, saved_from string")
    groups = V.version_groups(contents, m, pairs)
    assert rows(groups, "content") == [("a", "a", 0, 2, 1.0, 0.0, False), ("b", "a", 1, 2, 0.769, 0.231, True)]
    fams = V.families(contents.select("content"), groups)
    assert rows(fams, "content") == [("a", "a", 0, 2), ("b", "a", 1, 2), ("c", "c", 0, 1), ("d", "d", 0, 1)]
    assert rows(V.families(contents.where("content <> 'a'").select("content"), groups), "content")[0] == ("b", "b", 0, 1)
    kin = V.kin(spark.createDataFrame([("c", "d", "derived"), ("a", "b", "version"), ("a", "c", "related")], "older string, newer string, kind string"))
    assert rows(kin, "content", "other") == [("a", "c", "related"), ("c", "a", "related"), ("c", "d", "built-on"), ("d", "c", "derived")]
    labels = contents.select("content", F.upper("content").alias("label"))
    cells = {r.content: (r.versions_cell, r.lineage_cell) for r in V.lineage_notes(fams, kin, labels).collect()}
    assert cells["a"] == ("newest of 2", "shares a part with C") and cells["b"] == ("version 1 of 2; the newest: A", "") and cells["d"] == ("", "derived by others from C")
    assert ("a", "b") in rows(V.related_models(fams, kin), "a", "b")


def test_fingerprints_and_choosers(spark):
    ids = spark.createDataFrame([("x", "_19_0_3_8fe028d_1556123456789_12_3456"), ("x", "_19_0_3_8fe028d_1556123456789_12_3456"), ("x", "plain"), ("x", None)], "content string, xid string")
    f = V.fingerprint_ids(ids)
    assert sorted((r.maker or "", r.day or 0) for r in f.collect()) == [("", 0), ("8fe028d", 18010)]
    packed = V.packed(f)
    assert packed.first().elements == 2 and V.unpacked(packed).count() == 2
    paths = spark.createDataFrame([("p", "/a/b/x.zip", "P", "2021", "p"), ("q", "/a/b/c/y.zip!m", "Q", "2020", "p"), ("r", "/a/bc/z.zip", "R", "2022", "r")], "content string, path string, label string, saved string, fam string")
    assert V.common_folder(paths).first().folder == "/a"
    assert rows(V.chooser_by_folder(paths, "/a"), "title") == [("b", "p", 1), ("b/c", "q", 1), ("bc", "r", 1)]
    fams = paths.select("content", F.col("fam").alias("family"), (F.col("content") == "q").cast("int").alias("rank"))
    kin = spark.createDataFrame([("p", "r", "built-on")], "content string, other string, standing string")
    c = V.chooser_by_lineage(paths.drop("path"), fams, kin).orderBy("pos").collect()
    assert [(r.content, r.depth) for r in c] == [("p", 0), ("q", 1), ("r", 0)] and c[0].title == "P: 3 models built on one another"


COPY = "struct<name:string,rid:string,text:string,stereotypes:array<string>,tagged:map<string,string>,relations:array<struct<kind:string,direction:string,other:string,label:string,phrase:string>>,owns:array<string>,shows:array<struct<key:string,name:string>>,place:string>"


def test_differences_of_copies(spark):
    base = ("Pump", "R-1", "t", ["Block"], {"Block.x": "1"}, [("satisfy", "out", "r1", "Flow", "satisfies")], ["valve", "valve"], [("k", "n")], "A::B")
    same = spark.createDataFrame([(base, base)], f"a {COPY}, b {COPY}").select(V.differences().alias("d")).first().d
    other = ("Pumps", None, "u", ["Block", "Part"], {"Block.x": "2", "Block.y": "1"}, [("satisfy", "out", "r2", "Flow", "satisfies"), ("refine", "in", "c", "Case", "refined by")], ["valve"], [("j", "m")], "A::C")
    d = spark.createDataFrame([(base, other)], f"a {COPY}, b {COPY}").select(V.differences().alias("d")).first().d
    assert same == []
    assert d == [
        "name: Pump here, Pumps there", "requirement Id: R-1 here, none there", "text", "stereotypes (only there: Part)", "tagged values: Block.x, Block.y",
        "relationships (only there: refined by Case)", "members (only here: valve)", "shows (only here: n; only there: m)", "package: …::A::B here, …::A::C there".replace("…::A", "A"),
    ] or d[-1] == "package: A::B here, A::C there"
    items = spark.createDataFrame([("m", "1", [("n", "1", ["text"])]), ("m", "2", [("n", "2", [])]), ("m", "3", []), ("n", "1", [("m", "1", ["text"])]), ("n", "4", [])], "model string, key string, matches array<struct<model:string,key:string,differences:array<string>>>")
    assert rows(V.compared_models(items, "m", "n"), "key") == [("changed", "1"), ("same", "2"), ("only_a", "3"), ("only_b", "4")]


def test_shared_items_once_a_pair(spark):
    items = spark.createDataFrame([("a", "k", "R1", "n"), ("b", "k", "R1", "n"), ("c", "z", "R1", "n"), ("c", "y", None, "n")], "token string, key string, rid string, kind_name string")
    got = {(r.token_a, r.token_b, r.by) for r in identity.shared_items(items).collect()}
    assert got == {("a", "b", "1 element"), ("a", "c", "2 requirement"), ("b", "c", "2 requirement")}


def test_query_language(spark):
    assert Q.parse('pump* "Flow  rate" REQ-1.2') == ([("pump", True), ("req-1.2", False), ("flow", False), ("rate", False)], ["flow rate"])
    assert Q.parse(None) == ([], []) and Q.parse('""*') == ([], [])
    got = spark.createDataFrame([('a* "b c"',)], "q string").select(Q.parsed(F.col("q")).alias("p")).first().p
    assert [tuple(x) for x in got.groups] == [("a", True), ("b", False), ("c", False)] and got.phrases == ["b c"]
    items = spark.createDataFrame(
        [(0, "REQ-1", "Pump flow", "A", "the pump shall", None, None, "requirement", 1), (1, None, "Valve", "A::B", "a pump valve, flow rate", None, None, "element", 1), (2, None, "Pumping", "B", "own", "flow  rate of pumping", "Pump", "element", 2), (3, None, "x", None, None, None, None, "element", 2)],
        "doc int, id string, name string, place string, text string, chunks string, of string, type string, project int",
    )
    index = Q.Index.build(items)
    r = Q.search(index, items, {1: "pump flow", 2: '"flow rate"', 3: "pump*", 4: "nothing"}).orderBy("qid", "rank").collect()
    assert [(x.doc, x.matched, x.total, x.every) for x in r if x.qid == 1] == [(0, 2, 3, 3), (1, 2, 3, 3), (2, 2, 3, 3)] or [x.doc for x in r if x.qid == 1][0] == 0
    assert sorted(x.doc for x in r if x.qid == 2) == [1, 2] and sorted(x.doc for x in r if x.qid == 3) == [0, 1, 2] and not [x for x in r if x.qid == 4]
    assert [x.doc for x in Q.search(index, items, {1: "pump"}, project=F.col("project") == 2, kind="element", limit=1).collect()] == [2]
    t = F.array(F.lit("pump"), F.lit("pump flow"))
    m = spark.range(1).select(Q.marked(F.lit("A Pump flow pump"), t).alias("m"), Q.excerpt(F.lit("w " * 100 + "pump"), t, 10).alias("e"), Q.tag_pieces(F.lit("see [1] and [2]"), F.create_map(F.lit("2"), F.lit("k"))).alias("g")).first()
    assert [tuple(x) for x in m.m] == [("A ", False), ("Pump flow", True), (" ", False), ("pump", True)] and m.e == "…w w w w w pump"
    assert [tuple(x) for x in m.g] == [("see [1] and ", None), ("[2]", "k")]
    hits = spark.createDataFrame([(1, 1, "e", "k", True), (1, 2, "e", "k", True), (1, 3, "e", "j", False), (1, 4, "e", "j", False)], "qid int, rank int, type string, key string, shared boolean")
    assert rows(Q.collapse_shared(hits).select("rank", "copies"), "rank") == [(1, 2), (3, None), (4, None)]
    placed = spark.createDataFrame([("f", "e", "k", "Pumps")], "family string, type string, key string, group string")
    g = Q.grouped_hits(spark.createDataFrame([(1, 5, 1, "f", "e", "k"), (1, 6, 2, "f", "e", "k"), (1, 7, 3, "h", "e", "z")], "qid int, doc int, rank int, family string, type string, key string"), placed)
    assert rows(g, "rank") == [(1, "Pumps", 1, 5, 1, 2), (1, "model h", 2, 7, 3, 1)]


def test_grades_by_rule(spark):
    w = spark.createDataFrame([("c1#w0", "The **flow** rate is 5", "e1", "element"), ("c1#w1", "other", "e1", "element"), ("c2", "what derives from X: b", "e2", "trace"), ("c3", "Flow rate is 5", "p-9", "element"), ("c4", "flow rate is 5", None, "index:id"), ("c5", "n", "e3", "element")], "id string, text string, element_id string, kind string")
    none = {"answers": None, "related": None, "evidence": None, "by_element": None, "groups": None, "prefix": None, "quote": None, "sources": None, "source_element": None}
    qs = [
        {"id": "s", "question": "q", "rule": None, **none, "sources": ["c1"], "quote": "flow, rate"},
        {"id": "t", "question": "q", "rule": "source", **none, "sources": ["gone"], "source_element": "e2"},
        {"id": "p", "question": "q", "rule": None, **none, "groups": [[["derives from X", "b"]], [["flow rate"]]]},
        {"id": "f", "question": "q", "rule": None, **none, "prefix": "p-", "evidence": [["flow rate is 5"]], "related": ["e3"]},
        {"id": "e", "question": "q", "rule": None, **none, "answers": ["e2"], "related": ["e3"]},
        {"id": "bad", "question": "q", "rule": "fact", **none},
    ]
    q = spark.createDataFrame(qs, G.QUESTION)
    g = G.grades(q, w)
    want = {("s", "c1#w0", 2), ("s", "c1#w1", 1), ("t", "c2", 1), ("p", "c1#w0", 2), ("p", "c2", 2), ("p", "c3", 2), ("p", "c4", 2), ("f", "c3", 2), ("f", "c4", 2), ("f", "c5", 1), ("e", "c2", 2), ("e", "c5", 1)}
    assert {tuple(r) for r in g.collect()} == want
    judged = spark.createDataFrame([("e", "c2", 0), ("e", "c3", 1), ("e", "zz", 2)], "question string, window string, grade int")
    assert {tuple(r) for r in G.grades(q, w, judged).collect() if r.question == "e"} == {("e", "c3", 1), ("e", "c5", 1)}
    cov = G.covers(q, w, g)
    held = {(r.question, r.window): (r.parts, r.held) for r in cov.collect()}
    assert held["p", "c2"] == (2, [0]) and held["p", "c3"] == (2, [1]) and held["s", "c1#w0"] == (1, [0]) and held["s", "c1#w1"] == (1, [])
    ranked = spark.createDataFrame([("m", "p", "c5", 1), ("m", "p", "c2", 2), ("m", "e", "c5", 1)], "system string, question string, window string, rank int")
    c = {r.question: (r.coverage, r.complete) for r in G.coverage(ranked, cov).collect()}
    assert c == {"p": (0.5, 0.0), "e": (0.0, 0.0)}
    assert {r.id: r.problem for r in G.question_rows(q).collect()}["bad"] == "lacks what it grades by"


def test_tasks_and_windows(spark):
    members = spark.createDataFrame([("s", "g", f"i{k}") for k in range(6)] + [("s", "h", "z")], "split string, group string, item string")
    tasks = G.intruder_tasks(members).collect()
    assert len(tasks) == 3 and all(len(t.shown) == 6 and t.shown[t.answer - 1] == "z" for t in tasks)
    assert [t.shown for t in G.intruder_tasks(members).collect()] == [t.shown for t in tasks]
    subsets = G.subset_collections(["a", "b", "c", "d", "e"])
    assert len(subsets) == 10 and all(len(v) == 3 for k, v in subsets.items() if k != "all")
    from weavemine.functions.prose import word_offsets

    u = spark.createDataFrame([("u", "a b c d e", "k"), ("v", "a", "k")], "id string, text string, kind string")
    assert rows(G.windowed(u, word_offsets(F.col("text")), 5, 1), "id") == [("u#w0", "a b c", "k"), ("u#w1", "c d e", "k"), ("v", "a", "k")]
    alt = G.alternating(spark.createDataFrame([("p", 1), ("p", 2), ("q", 3)], "project string, k int"), "project", F.col("k"))
    assert [r.k for r in alt.orderBy("pos").collect()] == [1, 3, 2]


def test_list_differences_count_repeats(spark):
    rows = [(1, ["b", "a", "a", None], ["a", "c"]), (2, None, []), (3, ["x"] * 3000, ["x"] * 2998 + ["y"]), (None, ["q"], None)]
    df = spark.createDataFrame(rows, "k int, x array<string>, y array<string>")
    got = {r.k: (r.plus, r.minus) for r in V.list_differences(df, ["k"], "x", "y").collect()}
    assert got == {1: (["a", "b"], ["c"]), 2: ([], []), 3: (["x", "x"], ["y"]), None: (["q"], [])}


def test_shared_counts_equal_the_join_on_any_number_of_tiles(spark, monkeypatch):
    import random

    from weavemine.operators import tiles

    rnd = random.Random(5)
    rows = [(f"m{rnd.randrange(60)}", rnd.randrange(200), rnd.choice(["x", "y", None])) for _ in range(4000)] + [(None, 1, "x"), ("m1", None, "x")]
    df = spark.createDataFrame(rows, "m string, i int, f string")
    plain, apart = {}, {}
    for where, pairs in ((plain, {r[:2] for r in rows}), (apart, set(rows))):
        n = {}
        for r in pairs:
            n[r[0]] = n.get(r[0], 0) + 1
        for x in pairs:
            for y in pairs:
                if None not in (*x[:2], y[0]) and x[1] == y[1] and x[0] < y[0] and (where is plain or None not in (x[2], y[2]) and x[2] != y[2]):
                    where[x[0], y[0]] = (where.get((x[0], y[0]), (0,))[0] + 1, n[x[0]], n[y[0]])
    for size in (1 << 20, 2000):
        monkeypatch.setattr(tiles, "TILE_PAIRS", size)
        got = tiles.shared_counts(df, "m", "i")
        assert {(r.a, r.b): (r.shared, r.na, r.nb) for r in got.collect()} == plain
        assert {(r.a, r.b): (r.shared, r.na, r.nb) for r in tiles.shared_counts(df, "m", "i", "f").collect()} == apart
    assert "FlatMapGroupsInPandas" in got._jdf.queryExecution().executedPlan().toString()
    assert tiles.shared_counts(df.limit(0), "m", "i").count() == 0


def shuffled(df):
    """Bytes that the exchanges of a query that has run were given."""

    def of(plan):
        kind = plan.getClass().getSimpleName()
        if kind == "AdaptiveSparkPlanExec":
            return of(plan.executedPlan())
        if kind.endswith("QueryStageExec"):
            return of(plan.plan())
        size = plan.metrics().get("dataSize").get().value() if kind == "ShuffleExchangeExec" else 0
        return size + sum(of(plan.children().apply(i)) for i in range(plan.children().size()))

    return of(df._jdf.queryExecution().executedPlan())


def test_shared_counts_ship_a_few_bytes_a_number(spark, monkeypatch):
    import random

    from weavemine.operators import tiles

    monkeypatch.setattr(tiles, "TILE_ROWS", 1000)
    rnd = random.Random(3)
    rows = {(rnd.randrange(2000), at) for at in range(2000) for _ in range(8)}
    got = tiles.shared_counts(spark.createDataFrame(sorted(rows), "m long, i long"), "m", "i")
    pairs = {}
    for at in range(2000):
        held = sorted(m for m, i in rows if i == at)
        for k, a in enumerate(held):
            for b in held[k + 1 :]:
                pairs[a, b] = pairs.get((a, b), 0) + 1
    assert {(r.a, r.b): r.shared for r in got.collect()} == pairs
    assert shuffled(got) < 40 * len(rows)  # its rows went to seven tiles each


def test_packed_lists_are_read_back():
    import numpy as np

    from weavemine.operators import tiles

    top = np.iinfo(np.int64)
    ids, v, n = np.array([top.min, 0, top.max, 7, 9, -5]), np.array([1, -1, 300, 0, 0, 0]), np.array([3, 2, 1])
    for got, want in zip(tiles.take_lists(tiles.put_lists(ids, v, n, n - 1), 1), (ids, v, n, n - 1)):
        assert got.tolist() == want.tolist()
    assert [x.tolist() for x in tiles.take(tiles.put(ids) + tiles.put(ids[:0]), 2)] == [ids.tolist(), []]


def test_all_pairs_of_one_that_has_more_than_a_step_come_together():
    import numpy as np

    from weavemine.operators import tiles

    who, lo, hi = np.array([0, 0, 0, 1]), np.array([1, 2, 3, 4]), np.array([9, 9, 9, 9])
    got = list(tiles.tallies(who, lo, hi, lambda i, j: who[i] * 100 + j, 5))
    assert [k.tolist() for k, _ in got] == [[*range(1, 9)], [*range(104, 109)]]
    assert [c.tolist() for _, c in got] == [[1, 2, 3, 3, 3, 3, 3, 3], [1] * 5]


def test_overlaps_of_families_ship_a_few_bytes_a_number(spark, monkeypatch):
    import random

    from weavemine.operators import subjects, tiles

    monkeypatch.setattr(tiles, "TILE_ROWS", 1000)
    rnd = random.Random(6)
    rows = sorted({(s, s % 5, at) for at in range(1500) for s in rnd.choices(range(1500), k=8)})
    got = subjects.shared_elements(spark.createDataFrame(rows, "id long, family long, element long"))
    held, n, pairs = {}, {}, {}
    for s, f, at in rows:
        held.setdefault(at, []).append((s, f))
        n[s] = n.get(s, 0) + 1
    for one in held.values():
        for a, f in one:
            for b, g in one:
                if a < b and f != g:
                    pairs[a, b] = pairs.get((a, b), 0) + 1
    assert {(r.a, r.b): r.shared for r in got.collect()} == {(a, b): k / min(n[a], n[b]) for (a, b), k in pairs.items()}
    assert shuffled(got) < 50 * len(rows)
