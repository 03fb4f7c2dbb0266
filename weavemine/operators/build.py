"""The build loop: which projects are out of date, read again from an input that still is what it was, made, and published with their state.

Each project is made by itself; one that fails leaves the others, and its own
old output, as they were. Outputs and state become visible together, by
``sinks.publish``; a lock keeps a second builder away.
"""

from __future__ import annotations

import contextlib
import time
import uuid
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weavemine import sinks
from weavemine.operators import tree_state as S
from weavemine.session import materialize
from weavemine.sources.archives import Project, discover

MADE = "content_sha256 string, status string, error string, path string, record string"
#: The state that a tree keeps, by table.
TABLES = ("inputs", "contents", "sightings", "projects", "gaps", "removed")


@contextlib.contextmanager
def writer_lock(spark: SparkSession, folder: str, stale_after: float = 24 * 3600.0) -> Iterator[str]:
    """Hold a tree for writing; raises where another writer holds it. A lock older than ``stale_after`` seconds is of a writer that died."""
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(f"{folder}/WRITER")
    fs = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if fs.exists(at) and time.time() - fs.getFileStatus(at).getModificationTime() / 1000 > stale_after:
        fs.delete(at, False)
    try:
        fs.create(at, False).close()  # fails where it is there: one writer wins
    except Exception as e:
        raise RuntimeError(f"{folder} is being written by another run") from e
    try:
        yield uuid.uuid4().hex
    finally:
        fs.delete(at, False)


def scanned(files: DataFrame, inputs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(inputs, found): pending inputs with what they hold now, and the projects found in them.

    ``files`` are (path, content, length, modificationTime). A pending input whose
    bytes are those that were read last is done at once; one that cannot be read
    has failed, with its error.
    """
    pending = inputs.where("status = 'pending'").select("path", F.col("id").alias("input_id"), F.col("sha256").alias("was"))
    x = files.join(pending, "path").select("path", "input_id", "was", "content", F.sha2("content", 256).alias("sha"), F.col("length").alias("_size"), F.unix_micros("modificationTime").alias("_mtime"))
    x = materialize(x, "pending")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for path, input_id, sha, content in zip(b["path"], b["input_id"], b["sha"], b["content"]):
                name = path.rpartition("/")[2]
                try:
                    rows = [(path, input_id, sha, p.sha256, p.name, "zip" if p.data[:2] == b"PK" else "xmi", len(p.data), "!".join((*p.chain, p.name)), None) for p in discover(bytes(content), name)]
                except Exception as e:  # one bad input must not stop the others
                    rows = [(path, input_id, sha, None, None, None, None, None, f"{type(e).__name__}: {e}")]
                yield pd.DataFrame(rows, columns=["path", "input_id", "input_sha256", "sha256", "name", "kind", "size", "chain", "error"])

    changed = x.where("was IS NULL OR was <> sha").select("path", "input_id", "sha", "content")
    found = materialize(changed.mapInPandas(run, "path string, input_id long, input_sha256 string, sha256 string, name string, kind string, size long, chain string, error string"), "found")
    faults = found.where("error IS NOT NULL").groupBy("path").agg(F.min("error").alias("_error"))
    read = x.select("path", "sha", "_size", "_mtime").join(faults, "path", "left")
    j = inputs.join(read, "path", "left")
    here = F.col("sha").isNotNull()
    new = {
        "status": F.when(F.col("_error").isNotNull(), "failed").when(here, "done").otherwise(F.col("status")),
        "error": F.when(here, F.col("_error")).otherwise(F.col("error")),
        **{c: F.when(here, F.col(a)).otherwise(F.col(c)) for c, a in (("sha256", "sha"), ("size", "_size"), ("mtime", "_mtime"))},
    }
    return j.withColumns(new).select(inputs.columns), found.where("error IS NULL")


def made(files: DataFrame, work: DataFrame, make: Callable[[Project], Iterator[tuple[str, str]]]) -> DataFrame:
    """(content_sha256, status, error, path, record) of the projects of ``work`` (path, work), as ``tree_state.work_list`` gives it.

    ``make`` gives (path, record) rows of a project. What it gives before it fails
    is dropped: a project is ``written`` with all its rows and one without a path
    that says so, or has one row with its error. An input that is no longer what
    was scanned makes its projects ``changed``, for the next run.
    """
    x = files.join(work, "path").select("path", F.sha2("content", 256).alias("sha"), "content", "work")

    def one(p: Project) -> list[tuple]:
        try:
            return [*((p.sha256, "written", None, path, record) for path, record in make(p)), (p.sha256, "written", None, None, None)]
        except Exception as e:
            return [(p.sha256, "failed", f"{type(e).__name__}: {e}", None, None)]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for path, sha, content, items in zip(b["path"], b["sha"], b["content"], b["work"]):
                wanted = {i["sha256"] for i in items}
                rows: list[tuple] = []
                if any(i["input_sha256"] != sha for i in items):
                    rows = [(s, "changed", None, None, None) for s in wanted]
                    wanted = set()
                try:
                    for p in discover(bytes(content), path.rpartition("/")[2]) if wanted else ():
                        if p.sha256 in wanted:
                            wanted.discard(p.sha256)
                            yield pd.DataFrame(one(p), columns=[c.split()[0] for c in MADE.split(", ")])
                    error = f"no longer found in {path.rpartition('/')[2]}"
                except Exception as e:
                    error = f"{type(e).__name__}: {e}"
                rows += [(s, "failed", error, None, None) for s in wanted]
                yield pd.DataFrame(rows, columns=[c.split()[0] for c in MADE.split(", ")])

    return x.mapInPandas(run, MADE)


def build(spark: SparkSession, files: DataFrame, folder: str, state: dict[str, DataFrame], make: Callable[[Project], Iterator[tuple[str, str]]], tool: str, options: str, now: str) -> dict[str, int]:
    """One run over a tree: scan what is pending, make what is stale, publish outputs and state at once. Returns projects by status.

    ``state`` has the tables of ``TABLES``; an earlier run's is read by ``read_state``.
    Outputs of projects that are not made again are taken over; those of a failed one stay as they were.
    """
    with writer_lock(spark, folder):
        listing = files.select("path", F.col("length").alias("size"), F.unix_micros("modificationTime").alias("mtime"))
        inputs, found = scanned(files, S.checked_inputs(state["inputs"], listing))
        inputs = materialize(inputs, "inputs")
        contents, sightings = (materialize(t, "seen") for t in S.record_sightings(state["contents"], state["sightings"], found, now))
        current = S.current_sightings(sightings, inputs, contents)
        done = state["projects"].where((F.col("status") == "written") & (F.col("tool") == tool) & (F.col("options_hash") == options)).select(F.col("content_sha256").alias("sha256"))
        gone = state["removed"].select(F.col("content_sha256").alias("sha256"))
        stale = contents.select("sha256", "name").join(done, "sha256", "left_anti").join(gone, "sha256", "left_anti")
        rows = materialize(made(files, S.work_list(stale, current), make), "made")
        told = rows.where("path IS NULL").groupBy("content_sha256").agg(F.max("status").alias("status"), F.max("error").alias("error"))
        late = told.where("status = 'changed'").select("content_sha256")
        again = current.join(late, "content_sha256", "left_semi").select("path").distinct().withColumn("_again", F.lit(True))
        inputs = inputs.join(again, "path", "left").withColumn("status", F.when(F.col("_again"), "pending").otherwise(F.col("status"))).select(state["inputs"].columns)
        upsert = told.where("status <> 'changed'").select("content_sha256", "status", F.lit(tool).alias("tool"), F.lit(options).alias("options_hash"), "error", F.lit(now).alias("updated"))
        projects = S.set_projects(state["projects"], upsert)
        written = rows.where("path IS NOT NULL").select("content_sha256", "path", "record")
        fresh = told.where("status = 'written'").select("content_sha256")
        if sinks.is_published(spark, folder):
            old = sinks.published(spark, folder, "outputs")
            written = written.unionByName(old.join(fresh, "content_sha256", "left_anti"))
        tables = {"inputs": inputs, "contents": contents, "sightings": sightings, "projects": projects, "gaps": state["gaps"], "removed": state["removed"], "outputs": written}
        counts = {r.status: r.n for r in told.groupBy("status").agg(F.count("*").alias("n")).collect()}
        sinks.publish(spark, folder, tables)
        return counts


def read_state(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    return {t: sinks.published(spark, folder, t) for t in TABLES}
