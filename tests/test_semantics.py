from weavemine.operators import semantics as S

ELEMENT = "project string, id string, type string, role string, name string, owner string, pos int, attrs map<string,string>"


def rows(df, *order):
    return [tuple(r) for r in df.orderBy(*order).collect()]


def model(spark):
    e = [
        ("m", "Model", None, "Root", None, {}), ("p", "Package", "packagedElement", "Parts", "m", {}), ("q", "Package", "packagedElement", "Inner", "p", {}),
        ("b", "Class", "packagedElement", "Pump", "p", {}), ("c1", "Comment", "ownedComment", None, "b", {"body": "Moves water. Slowly."}), ("c2", "Comment", "ownedComment", None, "b", {"body": "of another"}),
        ("r1", "Class", "packagedElement", "Flow", "q", {}), ("r2", "Class", "packagedElement", None, "q", {}), ("act", "CallBehaviorAction", "node", None, "b", {}), ("d", "Diagram", "ownedDiagram", "View", "p", {}),
        ("v", "Expression", "defaultValue", None, "b", {"symbol": "max"}), ("v1", "LiteralInteger", "operand", None, "v", {"value": "3"}), ("v2", "Expression", "operand", None, "v", {}), ("v3", "LiteralString", "operand", None, "v2", {"value": "x"}), ("v4", "InstanceValue", "operand", None, "v2", {}),
        ("f", "InformationFlow", "packagedElement", None, "p", {}),
    ]
    elements = spark.createDataFrame([("x", i, f"uml:{t}", r, n, o, k, a) for k, (i, t, r, n, o, a) in enumerate(e)], ELEMENT)
    refs = [("c1", "annotatedElement", "b"), ("c2", "annotatedElement", "q"), ("act", "signal", "r1"), ("act", "behavior", "b"), ("v4", "instance", "b"), ("f", "conveyed", "b"), ("f", "informationSource", "r1"), ("f", "realizingConnector", "k1"), ("f", "realization", "k2")]
    refs = spark.createDataFrame([("x", s, r, t, k) for k, (s, r, t) in enumerate(refs)], "project string, src string, role string, target string, pos int")
    apps = spark.createDataFrame([("x", "b", "Block", 0), ("x", "b", "Part", 1), ("x", "d", "DiagramInfo", 2)], "project string, base string, stereotype string, pos int")
    required = spark.createDataFrame([("x", "r1", "Flow", "R-10", "shall flow"), ("x", "r2", None, "77", "[REQ-2-A] shall run")], "project string, id string, name string, rid string, text string")
    return elements, refs, apps, S.requirement_records(required)


def test_meaning_of_facts(spark):
    elements, refs, apps, records = model(spark)
    assert rows(records.drop("project"), "id") == [("r1", "R-10", None, "shall flow", "Flow (R-10)"), ("r2", "REQ-2-A", "77", "shall run", "REQ-2-A: shall run")]
    assert rows(S.documentation(elements, refs), "id") == [("x", "b", "Moves water. Slowly.")] and rows(S.notes(elements, refs), "id") == [("x", "q", "of another")]
    labels = S.labels(elements, refs, records)
    got = {r.id: r.label for r in labels.collect()}
    assert (got["b"], got["r2"], got["act"], got["f"]) == ("Pump", "REQ-2-A: shall run", "Pump", "(unnamed InformationFlow)")
    values = {r.id: r.value for r in S.value_texts(elements, refs, labels).collect()}
    assert values["v"] == "max(3, x Pump)" and values["v2"] == "x Pump"
    st = S.shown_stereotypes(apps)
    assert rows(st, "id") == [("x", "b", ["Block", "Part"])]
    words = {r.id: r.word for r in S.kind_words(elements, records, st).collect()}
    assert (words["r1"], words["b"], words["p"], words["d"]) == ("Requirement", "Block", "Package", "Diagram")
    assert rows(S.item_flows(elements, refs), "realizer") == [("x", "k1", "f", ["b"], "r1", None), ("x", "k2", "f", ["b"], "r1", None)]
    assert [r.id for r in S.children(elements, "operand").orderBy("pos").collect()] == ["v1", "v2", "v3", "v4"] and S.refs_of(refs, "signal").count() == 1


def test_ledger_and_threads(spark):
    elements, refs, apps, records = model(spark)
    sections = S.sections_of_packages(elements, records)
    assert rows(sections.drop("project"), "id") == [("p", "b", False), ("q", "r1", True), ("q", "r2", True)]
    counts = {r.package: (r.elements, r.requirements, r.diagrams, r.row) for r in S.package_counts(elements, sections).collect()}
    assert counts == {"m": (0, 0, 0, "- Root — 0 elements"), "p": (1, 0, 1, "- Parts — 1 element, 1 diagram"), "q": (0, 2, 0, "- Inner — 0 elements, 2 requirements")}
    labels = S.labels(elements, refs, records)
    line = {r.id: r.row for r in S.element_rows(elements, labels, S.shown_stereotypes(apps), S.documentation(elements, refs)).collect()}
    assert line["b"] == "- «Block» «Part» Pump — Moves water." and line["q"] == "- Package Inner"
    order = spark.createDataFrame([("x", "q", "a", "R-10", 0), ("x", "q", "b", "R-9", 1), ("x", "w", "c", None, 1), ("x", "w", "d", "R-1", 0)], "project string, package string, id string, rid string, pos int")
    assert [r.id for r in S.ledger_order(order).orderBy("package", "place").collect()] == ["b", "a", "d", "c"]
    edges = spark.createDataFrame([("x", "DeriveReqt", "r2", "r1"), ("x", "Satisfy", "b", "r2"), ("x", "verify", "act", "r2"), ("x", "Satisfy", "b", "d")], "project string, kind string, source string, target string")
    t = rows(S.requirement_threads(records, edges, labels), "pos")
    assert t == [("x", "r1", 0, 0, "r1", "- Flow (R-10)"), ("x", "r1", 1, 1, "r2", "- REQ-2-A: shall run; satisfied by Pump; verified by Pump")]
    kinds = {r.id: r.t for r in elements.select("id", S.catalog_type(elements["type"], elements["id"] == "d", elements["id"] == "r1").alias("t")).collect()}
    assert (kinds["d"], kinds["p"], kinds["r1"], kinds["b"], kinds["f"]) == ("diagram", "package", "requirement", "element", None)


def test_events_guards_and_what_describes(spark):
    from weavemine.operators import events as E

    e = [
        ("t", "Transition", "transition", None, "m", {}), ("t1", "Trigger", "trigger", None, "t", {}), ("t2", "Trigger", "trigger", "by hand", "t", {}), ("t3", "Trigger", "trigger", None, "t", {}),
        ("g", "Constraint", "guard", None, "t", {}), ("g1", "LiteralString", "specification", None, "g", {"value": "x > 1"}), ("ef", "OpaqueBehavior", "effect", None, "t", {"body": "stop()"}),
        ("e1", "SignalEvent", "packagedElement", None, "m", {}), ("e2", "TimeEvent", "packagedElement", None, "m", {"isRelative": "true"}), ("w", "TimeExpression", "when", None, "e2", {}), ("w1", "LiteralInteger", "expr", None, "w", {"value": "5"}),
        ("e3", "ChangeEvent", "packagedElement", None, "m", {}), ("c", "LiteralString", "changeExpression", None, "e3", {"value": "hot"}), ("e4", "AnyReceiveEvent", "packagedElement", None, "m", {}), ("e5", "CallEvent", "packagedElement", "named", "m", {}),
        ("s", "Signal", "packagedElement", "Alarm", "m", {}), ("cf", "ControlFlow", "edge", None, "m", {}), ("cg", "LiteralString", "guard", None, "cf", {"value": "else"}),
        ("lane", "ActivityPartition", "group", None, "m", {}), ("part", "Property", "ownedAttribute", "valve", "m", {}), ("cls", "Class", "packagedElement", "Valve", "m", {}),
        ("op", "OpaqueAction", "node", None, "m", {"body": "go " * 60}), ("acc", "AcceptEventAction", "node", None, "m", {}), ("a1", "Trigger", "trigger", None, "acc", {}), ("note", "Comment", "ownedComment", None, "m", {"body": " see below "}),
        ("val", "ValueSpecificationAction", "node", None, "m", {}), ("v", "LiteralInteger", "value", None, "val", {"value": "7"}), ("inv", "StateInvariant", "fragment", None, "m", {}), ("ic", "Constraint", "invariant", None, "inv", {}), ("is", "LiteralString", "specification", None, "ic", {"value": "ok"}),
        ("mute", "ForkNode", "node", None, "m", {}), ("line", "Lifeline", "lifeline", None, "m", {}),
    ]
    elements = spark.createDataFrame([("x", i, f"uml:{t}", r, n, o, k, a) for k, (i, t, r, n, o, a) in enumerate(e)], ELEMENT)
    refs = [("t1", "event", "e1"), ("e1", "signal", "s"), ("t3", "event", "e4"), ("a1", "event", "e2"), ("lane", "represents", "part"), ("part", "type", "cls"), ("line", "represents", "Lib.mdzip#_7")]
    refs = spark.createDataFrame([("x", s, r, t, k) for k, (s, r, t) in enumerate(refs)], "project string, src string, role string, target string, pos int")
    none = spark.createDataFrame([], "project string, id string, name string, rid string, text string")
    labels = S.labels(elements, refs, S.requirement_records(none))
    values = S.value_texts(elements, refs, labels)
    events = E.event_texts(elements, refs, labels, values).cache()
    assert {r.id: r.event for r in events.collect()} == {"e1": "Alarm", "e2": "after 5", "e3": "when hot", "e4": None, "e5": "named"}
    triggers = E.trigger_texts(elements, refs, events).cache()
    assert {r.id: r.trigger for r in triggers.collect()} == {"t1": "Alarm", "t2": "by hand", "t3": None, "a1": "after 5"}
    assert {r.id: r.flow for r in E.flow_labels(elements, values, triggers).collect()} == {"t": "Alarm, by hand [x > 1] / stop()", "cf": "[else]", "acc": "after 5"}
    told = E.described(elements, refs, labels, values, triggers).cache()
    got = {r.id: r.described for r in told.collect()}
    assert (got["lane"], got["acc"], got["note"], got["val"], got["inv"], got["line"]) == ("valve : Valve", "after 5", '"see below"', "7", "ok", "_7")
    assert got["op"].endswith("…") and len(got["op"]) <= 80 and "mute" not in got
    full = {r.id: r.label for r in E.full_labels(elements, labels, told).collect()}
    assert (full["lane"], full["mute"], full["cls"]) == ("valve : Valve", "(unnamed ForkNode)", "Valve")
