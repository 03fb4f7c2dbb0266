"""Layout streams, containment, and the graph of a drawing."""

import random

from pyspark.sql import functions as F

from weavemine.operators import diagrams as D
from weavemine.operators import hierarchy
from weavemine.operators.boxes import enclosing
from weavemine.sources import layouts as L

NO = {"pos": 0, "view": None, "class": "Shape", "element": None, "parent": None, "text": None, "first": None, "second": None, "points": []}


def md(cls, vid, inner="", **kids):
    names = {"element": "elementID", "first": "linkFirstEndID", "second": "linkSecondEndID"}
    body = "".join(f"<geometry>{v}</geometry>" if k == "at" else f"<text>{v}</text>" if k == "text" else f'<{names[k]} xmi:idref="{v}"/>' for k, v in kids.items())
    return f'<mdElement elementClass="{cls}" xmi:id="{vid}">{body}{"<mdOwnedViews>" + inner + "</mdOwnedViews>" if inner else ""}</mdElement>'


def stream(*parts):
    return ("<mdOwnedViews>" + "".join(parts) + "</mdOwnedViews>").encode()


def test_streams_to_views(spark):
    inner = md("Pin", "p1", element="e2", at="1,2,3,4") + '<mdElement elementClass="Part" xmi:id="s2"><properties><mdElement elementClass="Part" xmi:id="never"/></properties><elementID href="used.mdzip#e9"/></mdElement>'
    one = stream(md("Class", "s1", inner, element="e1", at="10, 20, 300, -5.5", text="&lt;p&gt;a &lt;b&gt;b&lt;/b&gt;&lt;/p&gt;"), md("ColorProperty", "c1"), md("Flow", "f1", first="s1", second="s2", at="1,2; 3,4; x"), '<mdElement elementClass="Tree" xmi:id="t"><verticalBarX value="1"/><verticalBarY value="2"/><horizontalBarLeft value="3"/><horizontalBarRight value="4"/><horizontalBarY value="5.5"/><baseShape xmi:idref="s1"/></mdElement>')
    broken = stream(md("Class", "b1", element="e1")).replace(b"</mdOwnedViews>", b"<mdElement elementClass='Class' id='b2'><oops>")
    df = spark.createDataFrame([("P", "one", one), ("P", "broken", broken), ("P", "none", None), ("P", "empty", b"")], "project string, stream string, data binary")
    got = {(r.stream, r.view): r for r in L.views(df).collect()}
    assert {v for s, v in got if s == "one"} == {"s1", "p1", "s2", "f1", "t"} and {v for s, v in got if s == "broken"} == {"b1", "b2"}
    s1, f1, t = (got["one", v] for v in ("s1", "f1", "t"))
    assert (s1.pos, s1.element, s1.parent, s1.text, s1.x, s1.h) == (0, "e1", None, "a b", 10.0, -5.5)
    assert [tuple(p) for p in f1.points] == [(1.0, 2.0), (3.0, 4.0)] and (f1.first, f1.second, f1.x) == ("s1", "s2", None)
    assert t.bars == [1.0, 2.0, 3.0, 4.0, 5.5] and t.base == "s1" and got["one", "p1"].parent == "s1"
    elements = spark.createDataFrame([("P", e) for e in ("e1", "e2", "e9")], "project string, id string")
    own = {r.view: r.element for r in L.own_elements(L.views(df), elements).collect()}
    assert own["s2"] == "e9" and own["s1"] == "e1"
    shown = L.shown_elements(spark.createDataFrame([("P", "d", "one")], "project string, id string, stream string"), L.views(df), elements).first()
    assert shown.shown == ["e1", "e2", "e9"]


def test_long_streams_hold_only_what_is_open():
    data = stream(*(md("Class", f"v{k}", element=f"e{k}", at="1,1,2,2") for k in range(20_000)))
    assert len(L.read_views(data)) == 20_000
    deep = "".join(f'<mdElement elementClass="C" id="d{k}"><mdOwnedViews>' for k in range(5000)) + "</mdOwnedViews></mdElement>" * 5000
    rows = L.read_views(f"<mdOwnedViews>{deep}</mdOwnedViews>".encode())
    assert len(rows) == 5000 and rows[4999]["parent"] == "d4998"


def test_enclosing_boxes_equal_the_inequality_join(spark):
    rnd = random.Random(4)
    boxes = [(g, i, *(float(rnd.randrange(100) - 20) for _ in "xy"), float(rnd.choice([0, 1, 5, 30, 200])), float(rnd.choice([0, 2, 8, 64, 150]))) for i in range(300) for g in ("a", "b") if rnd.random() < 0.7]
    boxes += [("a", 900, None, 0.0, 1.0, 1.0), ("a", 901, 0.0, 0.0, -1.0, 5.0), ("a", 902, 0.0, 0.0, 64.0, 64.0), ("a", 903, 0.0, 0.0, 64.0, 64.0)]
    ok = [b for b in boxes if b[2] is not None and b[4] >= 0]
    want = {}
    for g, i, *_ in boxes:
        want[g, i] = (None, 0)
    for g, i, x, y, w, h in ok:
        around = [(v * u, j) for k, j, a, b, v, u in ok if k == g and a <= x and b <= y and a + v >= x + w and b + u >= y + h and v * u > w * h]
        want[g, i] = (min(around)[1] if around else None, len(around))
    df = spark.createDataFrame(boxes, "g string, id long, x double, y double, w double, h double")
    out = enclosing(df, ["g"])
    assert {(r.g, r.id): (r.parent, r.depth) for r in out.collect()} == want
    assert "NestedLoop" not in out._jdf.queryExecution().toString() and "Cartesian" not in out._jdf.queryExecution().toString()
    assert enclosing(df.limit(0), ["g"]).count() == 0


def test_enclosing_meets_every_pair_of_blocks_without_a_row_a_pair(spark, monkeypatch):
    from weavemine.operators import boxes as B

    n = 1500  # each lies in all larger ones: a million pairs
    df = spark.range(n).selectExpr("'g' AS g", "id", "double(-id) AS x", "double(-id) AS y", "double(2 * id + 1) AS w", "double(2 * id + 1) AS h")
    monkeypatch.setattr(B, "BLOCK", 400)
    monkeypatch.setattr(B, "BITS", 64)
    out = B.enclosing(df, ["g"])
    assert {(r.id, r.parent, r.depth) for r in out.collect()} == {(i, i + 1 if i + 1 < n else None, n - 1 - i) for i in range(n)}
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "FlatMapGroupsInPandas" in plan and "cx" not in plan


def drawing(spark):
    rows = [
        dict(view="s1", element="e1"), dict(view="s2", element="e2", parent="s1"), dict(view="pin", element="e3", parent="s2", **{"class": "Pin"}),
        dict(view="in pin", element="e4", parent="pin", **{"class": "Port"}), dict(view="frame", element="x", **{"class": "DiagramFrame"}),
        dict(view="s5", text="note", parent="frame"), dict(view="box", text="t", parent="s1", **{"class": "TextBox"}), dict(view="s6", element="e6", parent="box"),
        dict(view="loose", element="e7", **{"class": "Port"}), dict(view="c1", **{"class": "FlowConnector"}), dict(view="c2", **{"class": "FlowConnector"}),
        # a flow in two halves, stored target first; one with three halves; whole ones
        dict(view="h1", element="flow", first="c1", second="s1", **{"class": "ObjectFlow"}), dict(view="h2", element="flow", first="pin", second="c2", **{"class": "ObjectFlow"}),
        dict(view="k1", element="third", first="s1", second="c1", **{"class": "ControlFlow"}), dict(view="k2", element="third", first="c2", second="s2", **{"class": "ControlFlow"}), dict(view="k3", element="third", first="c2", second="s5", **{"class": "ControlFlow"}),
        dict(view="w1", element="dep", first="s1", second="s2", **{"class": "Dependency"}), dict(view="w2", element="con", first="s1", second="s5", **{"class": "Connector"}),
        dict(view="w3", element="dep2", first="s6", second="s5", **{"class": "Dependency"}),
    ]
    rows = [NO | r | {"pos": k, "project": "P", "stream": "d"} for k, r in enumerate(rows)]
    kind = "project string, stream string, pos int, view string, class string, element string, parent string, text string, first string, second string, points array<struct<x:double,y:double>>"
    return spark.createDataFrame([[r[c.split()[0]] for c in kind.replace("array<struct<x:double,y:double>>", "a").split(", ")] for r in rows], kind)


def test_shapes_pins_and_links(spark):
    v = drawing(spark)
    at = D.placed(v)
    assert {r.view: (r.role, r.on) for r in at.collect()} == {"s1": ("shape", None), "s2": ("shape", None), "pin": ("pin", "s2"), "in pin": ("shape", None), "s5": ("shape", None), "s6": ("shape", None), "loose": ("shape", None)}
    n = D.shapes(v, at)
    assert {r.view: (r.num, r.parent, r.depth) for r in n.collect()} == {"s1": (1, None, 0), "s2": (2, 1, 1), "in pin": (3, 2, 2), "s5": (4, None, 0), "s6": (5, 1, 1), "loose": (6, None, 0)}
    types = spark.createDataFrame([("P", "e1", "T1"), ("P", "e2", "T2")], "project string, id string, type string")
    ids = D.end_ids(v, at, types)
    assert {r.view: sorted(r.ids) for r in ids.collect()}["pin"] == ["T2", "e2", "e3"]
    none = spark.createDataFrame([], "project string, element string, kind string, `from` string, `to` string")
    rel = spark.createDataFrame([("P", "dep", "Dependency", "e1", "e2"), ("P", "flow", "ObjectFlow", "T2", "T1")], none.schema)
    plain = {r.view: (r.more, r.source, r.target, r.directed, r.at_first) for r in D.drawn_links(v, ids, none).collect()}
    assert plain["h2"] == ("h1", "s1", "pin", True, True) and "h1" not in plain and {"k1", "k2", "k3"} <= plain.keys()
    assert plain["w1"] == (None, "s2", "s1", True, True) and plain["w2"] == (None, "s1", "s5", False, False)
    links = D.drawn_links(v, ids, rel)
    known = {r.view: (r.more, r.source, r.target, r.directed, r.at_first) for r in links.collect()}
    assert known["h1"] == ("h2", "pin", "s1", True, False) and known["w1"] == (None, "s1", "s2", True, False) and len(known) == len(plain) == 7
    flows = spark.createDataFrame([("P", "con", 0, "note", "T1", "a"), ("P", "con", 1, None, "e1", "b"), ("P", "dep", 0, "e1", None, "c"), ("P", "dep2", 0, "q", "q", "d")], "project string, element string, pos int, source string, target string, names string")
    sent = {r.view: (r.source, r.target, r.at_first, [tuple(i) for i in r["items"]]) for r in D.conveyed(links, ids, flows).collect()}
    assert sent["w2"] == ("s5", "s1", True, [("a", "→"), ("b", "→")]) and sent["w1"] == ("s1", "s2", False, [("c", "→")]) and sent["w3"][3] == [("d", "")] and sent["h1"][3] == []
    assert D.trivial(n, links).count() == 0 and D.trivial(n.where("num < 3"), links.limit(0)).count() == 1
    used = spark.createDataFrame([("P", "d", e) for e in ("e1", "in", "deep", "far", "none")], "project string, stream string, element string")
    owners = spark.createDataFrame([("P", "in", "e2"), ("P", "deep", "in"), ("P", "far", "x3"), ("P", "x3", "x2"), ("P", "x2", "x1"), ("P", "x1", "e1")], "project string, id string, owner string")
    assert {r.element: r.holder for r in D.held_inside(used, v, owners).collect()} == {"in": "e2", "deep": "e2", "far": None, "none": None}


def test_nearest_owner_on_chains_and_circles(spark):
    chain = [(str(k), str(k - 1) if k else None, k % 1000 == 0) for k in range(3000)] + [("a", "b", False), ("b", "a", False), ("c", "a", False), ("self", "self", False), ("lost", "nowhere", False), ("d", "e", False), ("e", "d", True)]
    df = spark.createDataFrame(chain, "id string, owner string, good boolean")
    got = {r.id: (r.ancestor, r.depth) for r in hierarchy.nearest_ancestor(df, F.col("good")).collect()}
    assert got == {str(k): (str(k // 1000 * 1000), k % 1000) for k in range(3000)} | {"d": ("e", 1), "e": ("e", 0)}
    deep = {r.id: r.depth for r in hierarchy.tree_depths(df.select("id", "owner")).collect()}
    assert deep == {str(k): k for k in range(3000)} | {"lost": 0}
