import io
import zipfile

from weavemine.operators import hierarchy
from weavemine.operators import model as M
from weavemine.sources import archives as A
from weavemine.streaming.archives import watch_archives

MODEL = """<?xml version='1.0'?>
<xmi:XMI xmlns:xmi='http://www.omg.org/spec/XMI/20131001' xmlns:uml='http://www.omg.org/spec/UML/20131001' xmlns:sysml='http://www.omg.org/spec/SysML/20181001/SysML'>
 <uml:Model xmi:type='uml:Model' xmi:id='m' name='Root'>
  <packagedElement xmi:type='uml:Package' xmi:id='p' name='Parts'>
   <packagedElement xmi:type='uml:Class' xmi:id='c1' name='Pump'>
    <ownedAttribute xmi:type='uml:Property' xmi:id='a' name='valve' type='c2'>
     <lowerValue xmi:type='uml:LiteralInteger' xmi:id='lo' value='2'/><upperValue xmi:type='uml:LiteralUnlimitedNatural' xmi:id='hi' value='*'/>
    </ownedAttribute>
    <generalization xmi:type='uml:Generalization' xmi:id='g' general='c3'/>
    <xmi:Extension><ownedDiagram xmi:type='uml:Diagram' xmi:id='d' name='Overview'><DiagramRepresentationObject type='Block' umlType='Class'><binaryObject streamContentID='BINARY-7'/></DiagramRepresentationObject></ownedDiagram></xmi:Extension>
   </packagedElement>
   <packagedElement xmi:type='uml:Class' xmi:id='c2' name='c1'/>
   <packagedElement xmi:type='uml:Class' xmi:id='c3' name='Machine'/>
   <packagedElement xmi:type='uml:Class' xmi:id='r' name='Flow'/>
   <packagedElement xmi:type='uml:Abstraction' xmi:id='s' client='c1 c2' supplier='r'/>
   <packagedElement xmi:type='uml:Dependency' xmi:id='x' client='c1'><supplier href='Other.mdzip#_9'/></packagedElement>
  </packagedElement>
 </uml:Model>
 <sysml:Requirement xmi:id='t1' base_Class='r' Id='R-1' Text='shall pump'/>
 <sysml:Satisfy xmi:id='t2' base_Abstraction='s'/>
</xmi:XMI>"""


def archive(**entries):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for name, data in entries.items():
            z.writestr(name.replace("__", "."), data)
    return out.getvalue()


def write_inputs(folder):
    folder.mkdir()
    one = archive(com__nomagic__model=MODEL, BINARY="x" * 100)
    (folder / "one.mdzip").write_bytes(one)
    (folder / "outer.zip").write_bytes(archive(inner__mdzip=one, notes__txt="n" * 80))
    (folder / "bare.xmi").write_text(MODEL)
    (folder / "broken.xmi").write_text(MODEL[:900])
    (folder / "readme.md").write_text("not a model")
    (folder / "table.xml").write_text("<table>" + "x" * 100 + "</table>")


def test_archives_become_tables(spark, tmp_path):
    write_inputs(tmp_path / "in")
    parsed = A.read_archives(spark, str(tmp_path / "in")).cache()
    projects = parsed.where("kind = 'project'").collect()
    assert sorted(r.path.rpartition("/")[2] for r in projects) == ["bare.xmi", "one.mdzip", "outer.zip"]
    assert len({r.project for r in projects}) == 2
    assert [r.path.rpartition("/")[2] for r in parsed.where("kind = 'error'").collect()] == ["broken.xmi"]
    sha = next(r.project for r in projects if r.path.endswith("bare.xmi"))
    parsed = parsed.where(parsed.project == sha)
    elements, refs, apps = (A.facts(parsed, k) for k in ("element", "ref", "application"))
    rows = {r.id: r for r in elements.collect()}
    assert rows["c2"].name == "c1" and rows["a"].owner == "c1" and rows["d"].type == "uml:Diagram"
    assert {(r.src, r.role, r.target, r.external) for r in refs.where("src IN ('a', 'x')").collect()} == {("a", "type", "c2", False), ("x", "client", "c1", False), ("x", "supplier", "Other.mdzip#_9", True)}
    assert A.facts(parsed, "diagram").first().streams == ["BINARY-7"]
    req = M.requirements(elements, apps).collect()
    assert [(r.id, r.rid, r.text) for r in req] == [("r", "R-1", "shall pump")]
    edges = M.relationships(elements, refs, apps)
    assert {(r.kind, r.source, r.target) for r in edges.collect()} == {("Satisfy", "c1", "r"), ("Satisfy", "c2", "r"), ("Generalization", "c1", "c3"), ("Dependency", "c1", "Other.mdzip#_9")}
    said = {(r.element, r.verb, r.other) for r in M.worded_ends(edges).collect()}
    assert ("r", "satisfied by", "c2") in said and ("c1", "is a kind of", "c3") in said
    assert {r.id: r.multiplicity for r in M.multiplicities(elements).collect()} == {"a": "2..*"}
    names = {r.id: r.qualified for r in hierarchy.qualified_names(elements).collect()}
    assert names["a"] == "Root::Parts::Pump::valve" and names["m"] == "Root"


def test_zip_bombs_are_refused():
    info = zipfile.ZipInfo("x")
    info.file_size, info.compress_size = 1 << 30, 1000
    try:
        A.Budget().take(info)
        raise AssertionError
    except ValueError:
        pass


def test_stream_reads_each_file_once(spark, tmp_path):
    write_inputs(tmp_path / "in")
    stream = watch_archives(spark, str(tmp_path / "in"))
    go = lambda: stream.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start().awaitTermination()
    go()
    n = spark.read.parquet(str(tmp_path / "out")).count()
    go()
    assert n > 30 and spark.read.parquet(str(tmp_path / "out")).count() == n


def test_cycles_do_not_hang(spark):
    nodes = spark.createDataFrame([("a", "b", "A"), ("b", "a", "B"), ("c", "a", "C"), ("d", "gone", "D")], "id string, owner string, name string")
    got = {(r.id, r.ancestor) for r in hierarchy.ancestors(nodes).collect()}
    assert ("c", "b") in got and ("d", "d") in got


def test_chains_deeper_than_64_are_walked_to_the_root(spark):
    rows = [(k, k - 1 if k else None, f"n{k}") for k in range(150)]
    nodes = spark.createDataFrame(rows, "id int, owner int, name string")
    names = {r.id: r.qualified for r in hierarchy.qualified_names(nodes).collect()}
    assert names[149] == "::".join(f"n{k}" for k in range(150))
    nearest = {r.id: (r.ancestor, r.depth) for r in hierarchy.nearest_ancestor(nodes, nodes["owner"].isNull()).collect()}
    assert nearest == {k: (0, k) for k in range(150)}
