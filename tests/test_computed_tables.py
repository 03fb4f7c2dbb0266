"""Tables computed from a model: three kinds of columns and more, sorted as people read numbers."""

from weavemine.operators import computed_tables as C
from weavemine.operators import hierarchy
from weavemine.operators import model as M
from weavemine.operators import semantics as S

ELEMENT = "project string, id string, type string, role string, name string, owner string, pos int, attrs map<string,string>"


def test_tables_of_a_model(spark):
    e = [
        ("m", "Model", None, "Root", None, {}), ("r1", "Class", "packagedElement", "Flow", "m", {"isAbstract": "true"}), ("r2", "Class", "packagedElement", "Heat", "m", {}), ("r3", "Class", "packagedElement", "Cold", "m", {}),
        ("b", "Class", "packagedElement", "Pump", "m", {}), ("doc", "Comment", "ownedComment", None, "r1", {"body": "About flow."}), ("i", "InstanceSpecification", "packagedElement", "one", "m", {}),
        ("s", "Slot", "slot", None, "i", {}), ("sv", "LiteralInteger", "value", None, "s", {"value": "42"}), ("f", "Property", "ownedAttribute", "mass", "b", {}),
        ("d1", "Diagram", "ownedDiagram", "T1", "m", {}), ("d2", "Diagram", "ownedDiagram", "T2", "m", {}), ("d3", "Diagram", "ownedDiagram", "T3", "m", {}), ("d4", "Diagram", "ownedDiagram", "T4", "m", {}), ("d5", "Diagram", "ownedDiagram", "T5", "m", {}),
    ]
    elements = spark.createDataFrame([("x", i, f"uml:{t}", r, n, o, k, a) for k, (i, t, r, n, o, a) in enumerate(e)], ELEMENT)
    refs = spark.createDataFrame([("x", "s", "definingFeature", "f", 0), ("x", "f", "type", "b", 1), ("x", "r2", "classifier", "b", 2)], "project string, src string, role string, target string, pos int")
    req = lambda k, i, more=None: ("x", k, "Requirement", {"Id": [i], "Text": ["shall"], **(more or {})}, 0)
    apps = [
        req("r1", "R-10", {"risk": ["High", "Low"]}), req("r2", "R-9"), req("r3", "R-1"), ("x", "r1", "Risky", {"risk": ["High"]}, 1),
        ("x", "d1", "DiagramInfo", {"sort": ["ignored"]}, 0),
        ("x", "d1", "RequirementTable", {"columnIds": ["_NUMBER_", "QPROP:Element:Id", "QPROP:Element:name", "QPROP:stereotypeTags:<<SysML::Risky>>.risk", "QPROP:Element:satisfiedBy", "QPROP:Element:risk", "_EMPTY_", "hide me", "CUSTOM_COLUMN: Mine", "QPROP:Element:derivedThing", "QPROP:Element:isAbstract", "QPROP:Element:classifier", "documentation0"], "hideColumns": ["hide me"], "rowElements": ["r1", "gone", "r2"], "additionalElements": ["r3", "r1"], "sort": ["QPROP:Element:Id^Ascending"]}, 1),
        ("x", "d2", "InstanceTable", {"columnIds": ["QPROP:Element:name", "IColumn:f", "IColumn:zz"], "rowElements": ["i", "b"], "sort": ["QPROP:Element:name^Descending"]}, 0),
        ("x", "d4", "GenericTable", {"columnIds": ["QPROP:Element:name"], "scope": ["m"]}, 0),
    ]
    apps = spark.createDataFrame(apps, "project string, base string, stereotype string, tags map<string,array<string>>, pos int").cache()
    required = M.requirements(elements, apps)
    labels = S.labels(elements, refs, S.requirement_records(required)).cache()
    values = S.value_texts(elements, refs, labels)
    relations = spark.createDataFrame([("x", "Satisfy", "b", "r1"), ("x", "Satisfy", "Lib#_3", "r1")], "project string, kind string, source string, target string")
    named = hierarchy.qualified_names(elements).selectExpr("'x' AS project", "id", "qualified")
    props = C.properties(elements, refs, apps, relations, labels, values, S.documentation(elements, refs), S.shown_stereotypes(apps), named, M.multiplicities(elements), required).cache()
    config = C.configuration(apps).cache()
    cells = C.computed(config, elements, labels, props, required).collect()
    one = {}
    for r in cells:
        one.setdefault((r.table, r.row, r.id), {})[r.header] = r.text
    assert [k for k in sorted(one) if k[0] == "d1"] == [("d1", 1, "r3"), ("d1", 2, "r2"), ("d1", 3, "r1")]
    assert one["d1", 3, "r1"] == {"#": "3", "Id": "R-10", "Name": "Flow", "risk": "High", "Satisfied By": "_3; Pump", "Risk": "High; Low", "Is Abstract": "true", "Classifier": "", "Documentation": "About flow."}
    assert one["d1", 2, "r2"] == {"#": "2", "Id": "R-9", "Name": "Heat", "risk": "", "Satisfied By": "", "Risk": "", "Is Abstract": "", "Classifier": "Pump", "Documentation": ""}
    assert {k: v for k, v in one.items() if k[0] == "d2"} == {("d2", 1, "b"): {"Name": "Pump", "mass": "", "(attribute)": ""}, ("d2", 2, "i"): {"Name": "one", "mass": "42", "(attribute)": ""}}
    left = {(r.table, r.header) for r in C.not_computed(config, elements, labels, props, required).collect()}
    assert left == {("d1", "Mine"), ("d1", "Derived Thing")}
    diagrams = spark.createDataFrame([("x", "d1", "Requirement Table"), ("x", "d2", "Instance Table"), ("x", "d3", "Dependency Matrix"), ("x", "d4", "Generic Table"), ("x", "d5", "Relation Map Diagram"), ("x", "q", "Class Diagram")], "project string, id string, diagram_type string")
    assert {r.table: r.reason for r in C.reasons(diagrams, config, elements).collect()} == {"d3": "a matrix", "d4": "rows from scope", "d5": "a map"}
