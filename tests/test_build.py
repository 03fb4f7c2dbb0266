"""Self-descriptions of files, and the build loop over them."""

import io
import zipfile

import pytest
from pyspark.sql import functions as F

from weavemine import sinks
from weavemine.operators import build as B
from weavemine.operators import versions as V
from weavemine.sources import describe as S

MODEL = '<xmi:XMI xmlns:xmi="http://www.omg.org/spec/XMI/20131001"><xmi:Documentation><xmi:exporter>Modeler</xmi:exporter><xmi:exporterVersion> 7 </xmi:exporterVersion></xmi:Documentation><uml:Model xmi:id="{}"><a xmi:id="_17_0_2abc_1556123456789_12_34" foo:bar="1"/><!-- xmi:id="no" --></uml:Model></xmi:XMI>'
STATE = {
    "inputs": "id long, path string, status string, metadata string, size long, mtime long, sha256 string, error string", "contents": "sha256 string, name string, kind string, size long, first_seen string",
    "sightings": "content_sha256 string, input_id long, input_sha256 string, chain string, seen string", "projects": "content_sha256 string, status string, tool string, options_hash string, summary string, error string, updated string",
    "gaps": "content_sha256 string, options_hash string, items int, builds int", "removed": "content_sha256 string, name string, removed string",
}


def zipped(model, **more):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        for name, (data, year) in {"com.nomagic.model": (MODEL.format(model), 2001), **more}.items():
            z.writestr(zipfile.ZipInfo(name, (year, 2, 3, 4, 5, 6)), data)
    return out.getvalue()


def files(spark, folder):
    return spark.read.format("binaryFile").load(str(folder)).withColumn("path", F.regexp_replace("path", "^file:", ""))


def test_files_describe_themselves(spark, tmp_path):
    (tmp_path / "a.mdzip").write_bytes(zipped("m1", **{"Records.properties": ("#c\n#Thu Nov 02 11:39:23 PDT 2023\n", 2020), "com.nomagic.ci.metamodel.project": ('<p id="PROJECT-77"/>', 2019)}))
    (tmp_path / "b.mdzip").write_bytes(zipped("m2", old=("x", 1980), late=("y", 2022)))
    (tmp_path / "c.xml").write_bytes(MODEL.format("m3").encode()[:-20])
    (tmp_path / "d.mdzip").write_bytes(zipped("m4")[:-9])
    (tmp_path / "e.txt").write_bytes(b"")
    d = S.self_descriptions(files(spark, tmp_path)).cache()
    got = {r.name: r for r in S.saved_times(d).collect()}
    a, b, c = (got[n] for n in ("a.mdzip", "b.mdzip", "c.xml"))
    assert (a.saved, a.saved_raw, a.saved_from, a.project_id, a.exporter) == ("2023-11-02T11:39:23-07:00", "Thu Nov 02 11:39:23 PDT 2023", "records", "PROJECT-77", "Modeler 7")
    assert (b.saved, b.saved_raw, b.saved_from, b.project_id) == ("2022-02-03T04:05:06", "2022-02-03 04:05:06", "zip", None) and (c.saved, c.saved_from) == (None, None)
    ids = S.project_ids(d)
    assert {r.xid for r in ids.where(F.col("content") == c.content).collect()} == {"m3", "_17_0_2abc_1556123456789_12_34"}
    marks = {(r.maker, r.day) for r in V.fingerprint_ids(ids).collect()}
    assert ("2abc", 1556123456789 // 86_400_000) in marks


def test_ids_of_long_entries_are_read_in_pieces():
    body = "".join(f'<a xmi:id="i{k}">{"x" * 50}</a>' for k in range(60_000))
    assert len([*S.entry_ids(io.BytesIO(f"<m>{body}</m>".encode()))]) == 60_000
    assert [*S.entry_ids(io.BytesIO(b"<m xmi:id='a'><b xmi:id='c'></m>"))] == ["a", "c"]


def outputs(p):
    if "bad" in p.name:
        yield "lost.txt", "never seen"
        raise ValueError("no good")
    yield "about.txt", p.name
    yield "size.txt", str(len(p.entries))


def test_build_loop(spark, tmp_path):
    tree, given = str(tmp_path / "tree"), tmp_path / "in"
    given.mkdir()
    for name in ("one.mdzip", "bad.mdzip"):
        (given / name).write_bytes(zipped(name))
    (given / "broken.mdzip").write_bytes(b"PK\x05\x06 no archive" + b"\0" * 40)
    names = sorted(f.name for f in given.iterdir())
    empty = {t: spark.createDataFrame([], s) for t, s in STATE.items()}
    empty["inputs"] = spark.createDataFrame([(k, f"{given}/{n}", "pending", None, None, None, None, None) for k, n in enumerate(names)] + [(9, f"{given}/gone", "done", None, 1, 1, "x", None)], STATE["inputs"])
    run = lambda state, make=outputs, options="o1": B.build(spark, files(spark, given), tree, state, make, "t", options, "now")
    assert run(empty) == {"written": 1, "failed": 1}
    said = lambda: sorted((r.path, r.record) for r in sinks.published(spark, tree, "outputs").collect())
    assert said() == [("about.txt", "one.mdzip"), ("size.txt", "1")]
    state = B.read_state(spark, tree)
    assert {r.path.rpartition("/")[2]: r.status for r in state["inputs"].collect()} == {"one.mdzip": "done", "bad.mdzip": "done", "broken.mdzip": "failed", "gone": "missing"}
    assert {(r.status, r.error) for r in state["projects"].collect()} == {("written", None), ("failed", "ValueError: no good")}
    # Nothing to do but what failed; a failure under other options leaves the old output readable.
    assert run(state) == {"failed": 1}

    def broken(p):
        raise RuntimeError("later")
        yield

    assert run(B.read_state(spark, tree), broken, "o2") == {"failed": 2} and said() == [("about.txt", "one.mdzip"), ("size.txt", "1")]
    assert run(B.read_state(spark, tree), options="o2") == {"written": 1, "failed": 1}
    # A changed file is another content: it is scanned and built, the old one's output stays until it is pruned.
    (given / "one.mdzip").write_bytes(zipped("other", more=("z", 2001)))
    assert run(B.read_state(spark, tree), options="o2") == {"written": 1, "failed": 1} and len(said()) == 4
    with B.writer_lock(spark, tree), pytest.raises(RuntimeError, match="another run"):
        run(B.read_state(spark, tree))
    assert run(B.read_state(spark, tree), options="o2") == {"failed": 1}


def test_inputs_that_change_meanwhile_wait_for_the_next_run(spark, tmp_path):
    (tmp_path / "a.mdzip").write_bytes(zipped("m"))
    work = spark.createDataFrame([(f"{tmp_path}/a.mdzip", [("a", "s1", "other")])], "path string, work array<struct<name:string,sha256:string,input_sha256:string>>")
    assert [tuple(r) for r in B.made(files(spark, tmp_path), work, outputs).collect()] == [("s1", "changed", None, None, None)]
