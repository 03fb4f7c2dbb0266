"""What model files say of themselves: when and by what they were saved, and the ids of all their elements.

Entries are read as a stream of start tags; no tree is built, and prefixes that
are used without being declared do no harm.
"""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Iterator
from xml.parsers import expat

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weavemine.functions.origins import java_date
from weavemine.sources.archives import Project, discover

#: Entries whose head carries the time of saving, and the one that names the project.
PROPERTIES = ("Records.properties", "Binaries.properties")
METAMODEL = "com.nomagic.ci.metamodel.project"
HEAD, CHUNK, FIRST_YEAR = 4096, 1 << 20, 1981
#: How the head of a model names its tool, and that entry its project.
TOOL = re.compile(rb"<xmi:exporter>([^<]*)</xmi:exporter>")
VERSION = re.compile(rb"<xmi:exporterVersion>([^<]*)</xmi:exporterVersion>")
PROJECT_ID = re.compile(rb'\bid="(PROJECT-[^"]+)"')
SHAPE = "path string, content string, kind string, name string, value string"


def entry_ids(stream: io.BufferedIOBase) -> Iterator[str]:
    """The ``xmi:id`` of every element of an entry, in order; an unreadable rest is left out."""
    found: list[str] = []
    prefixes = {"xmi"}

    def start(_: str, attrs: dict[str, str]) -> None:
        prefixes.update(k[6:] for k, v in attrs.items() if k.startswith("xmlns:") and "/spec/XMI" in v)
        found.extend(v for k, v in attrs.items() if k.endswith(":id") and k[:-3] in prefixes)

    parser = expat.ParserCreate()
    parser.StartElementHandler = start
    try:
        while piece := stream.read(CHUNK):
            parser.Parse(piece, False)
            yield from found
            found.clear()
        parser.Parse(b"", True)
    except expat.ExpatError:
        pass
    yield from found


def _described(p: Project) -> Iterator[tuple[str, str]]:
    """(what, value) of one project, besides its ids."""
    yield "name", p.name
    if zipfile.is_zipfile(io.BytesIO(p.data)):
        with zipfile.ZipFile(io.BytesIO(p.data)) as z:
            names = set(z.namelist())
            for entry in PROPERTIES:
                if entry in names:
                    with z.open(entry) as f:
                        yield "head", f.read(512).decode("latin-1")
            if METAMODEL in names:
                with z.open(METAMODEL) as f:
                    if m := PROJECT_ID.search(f.read(2048)):
                        yield "project_id", m[1].decode("ascii", "replace")
            times = [i.date_time for i in z.infolist() if i.date_time[0] >= FIRST_YEAR]
            if times:
                yield "entry_time", "{:04d}-{:02d}-{:02d}T{:02d}:{:02d}:{:02d}".format(*max(times))
    for _, data in p.entries:
        said = [m[1].decode("utf-8", "replace").strip() for m in (TOOL.search(data[:HEAD]), VERSION.search(data[:HEAD])) if m]
        if said:
            yield "exporter", " ".join(said)
            break


def self_descriptions(files: DataFrame) -> DataFrame:
    """(path, content, kind, name, value) of (path, content): rows of kind ``about`` name what a project says, those of kind ``id`` are its elements' ids.

    ``files`` are as ``binaryFile`` gives them; ``content`` of the result is the digest of each
    project in a file. A file that cannot be read has one row of kind ``error``; one without a model has none.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        columns = [c.split()[0] for c in SHAPE.split(", ")]
        for b in batches:
            for path, content in zip(b["path"], b["content"]):
                rows: list[tuple] = []
                try:
                    for p in discover(bytes(content), path.rpartition("/")[2]):
                        sha, heads = p.sha256, 0
                        for what, value in _described(p):
                            heads += what == "head"
                            rows.append((path, sha, "about", f"head{heads}" if what == "head" else what, value))
                        for _, data in p.entries:
                            for xid in entry_ids(io.BytesIO(data)):
                                rows.append((path, sha, "id", None, xid))
                                if len(rows) >= 10_000:
                                    yield pd.DataFrame(rows, columns=columns)
                                    rows = []
                except (ValueError, zipfile.BadZipFile, OSError) as e:
                    rows.append((path, None, "error", None, f"{type(e).__name__}: {e}"))
                yield pd.DataFrame(rows, columns=columns)

    return files.where("content IS NOT NULL").select("path", "content").mapInPandas(run, SHAPE)


def project_ids(described: DataFrame) -> DataFrame:
    """(content, xid): what ``versions.fingerprint_ids`` takes; a project found in several files counts once."""
    return described.where("kind = 'id'").select("content", F.col("value").alias("xid")).distinct()


def saved_times(described: DataFrame) -> DataFrame:
    """(content, name, saved, saved_raw, saved_from, project_id, exporter): a recorded time, else the latest date in the archive; null where neither tells."""
    about = described.where("kind = 'about'").groupBy("content").pivot("name", ["name", "head1", "head2", "entry_time", "project_id", "exporter"]).agg(F.min("value"))
    first, second = java_date(F.coalesce("head1", F.lit(""))), java_date(F.coalesce("head2", F.lit("")))
    x = about.withColumn("d", F.when(first["raw"].isNotNull(), first).otherwise(second))
    recorded = F.col("d.raw").isNotNull()
    return x.select(
        "content", "name", F.when(recorded, F.col("d.iso")).otherwise(F.col("entry_time")).alias("saved"),
        F.when(recorded, F.col("d.raw")).otherwise(F.replace("entry_time", F.lit("T"), F.lit(" "))).alias("saved_raw"),
        F.when(recorded, "records").when(F.col("entry_time").isNotNull(), "zip").alias("saved_from"), "project_id", "exporter",
    )
