"""Layout streams of diagrams: the shapes and paths drawn, as rows.

A stream is read as events by a parser that takes prefixes as part of names, so
one that is used but not declared does no harm; only the views that are open are
held. What is complete before a fault in the markup is kept.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from xml.parsers import expat

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weavemine.functions.prose import html_text

#: Kinds of drawn elements that carry settings only.
NON_VISUAL = frozenset(
    """BooleanProperty ChoiceProperty ColorProperty FontProperty NumberProperty ExtendableManager PropertyManagerByDiagram
    PropertyManagerByStereotype SimpleStyle ElementProperty StringProperty PropertyManager ElementListProperty IntegerProperty
    DiagramPropertiesShape""".split()
)
#: The parts of a tree of connections, in the order of ``bars``.
BARS = ("verticalBarX", "verticalBarY", "horizontalBarLeft", "horizontalBarRight", "horizontalBarY")
#: Children of a view that name another element, by column.
NAMING = {"elementID": "element", "linkFirstEndID": "first", "linkSecondEndID": "second", "treeID": "tree", "baseShape": "base"}
NUMBER = re.compile(r"-?\d+(?:\.\d+)?")
VIEW = "pos int, view string, class string, element string, parent string, text string, x double, y double, w double, h double, points array<struct<x:double,y:double>>, first string, second string, tree string, base string, bars array<double>"
COLUMNS = [c.split()[0] for c in VIEW.split(", ")]


def geometry(text: str) -> dict:
    """Columns of a geometry: corner points if parts are separated, else a rectangle of four numbers, else neither."""
    rows = [[float(n) for n in NUMBER.findall(part)] for part in text.split(";")]
    if len(rows) > 1:
        return {"points": [{"x": r[0], "y": r[1]} for r in rows if len(r) > 1]}
    return dict(zip("xywh", rows[0])) if len(rows[0]) > 3 else {}


class _Views:
    """Events of one stream to rows; ``open`` has a row for each view that is open, None inside settings."""

    def __init__(self) -> None:
        self.rows: list[dict] = []
        self.open: list[dict | None] = []
        self.tags: list[str] = []
        self.said: list[str] | None = None
        self.count = 0

    def start(self, tag: str, attrs: dict[str, str]) -> None:
        above = self.tags[-1] if self.tags else ""
        self.tags.append(tag)
        local = {k.rpartition(":")[2]: v for k, v in attrs.items()}
        if tag == "mdElement":
            drawn = (len(self.tags) == 2 or above == "mdOwnedViews") and (not self.open or self.open[-1] is not None)
            if not drawn or local.get("elementClass", "") in NON_VISUAL:
                self.open.append(None)
                return
            parent = self.open[-1]["view"] if self.open else None
            self.open.append({"pos": self.count, "view": local.get("id"), "class": local.get("elementClass", ""), "parent": parent, "points": [], "bars": {}})
            self.count += 1
        elif above == "mdElement" and self.open and (row := self.open[-1]) is not None:
            if tag in NAMING:
                row[NAMING[tag]] = local.get("idref") or local.get("href")
            elif tag in BARS:
                n = NUMBER.search(local.get("value", ""))
                row["bars"][tag] = float(n.group()) if n else None
            elif tag in ("geometry", "text"):
                self.said = []

    def data(self, text: str) -> None:
        if self.said is not None:
            self.said.append(text)

    def end(self, tag: str) -> None:
        self.tags.pop()
        if tag == "mdElement":
            self._close(self.open.pop())
        elif self.said is not None and self.tags and self.tags[-1] == "mdElement":
            text, self.said = "".join(self.said), None
            if text and tag == "geometry":
                self.open[-1].update(geometry(text.strip()))
            elif text:
                self.open[-1]["text"] = html_text(text)

    def _close(self, row: dict | None) -> None:
        if row is not None:
            bars = [row["bars"].get(b) for b in BARS]
            row["bars"] = bars if row["class"] == "Tree" and None not in bars else None
            self.rows.append(row)


def read_views(data: bytes) -> list[dict]:
    """The views of one stream, in their order."""
    v, parser = _Views(), expat.ParserCreate()
    parser.StartElementHandler, parser.EndElementHandler, parser.CharacterDataHandler = v.start, v.end, v.data
    parser.buffer_text = True
    try:
        parser.Parse(data, True)
    except expat.ExpatError:
        for row in v.open:
            v._close(row)
    return sorted(v.rows, key=lambda r: r["pos"])


def views(streams: DataFrame) -> DataFrame:
    """(project, stream, views' columns) of (project, stream, data); null data has no views. Streams are few megabytes each."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for project, stream, data in zip(b["project"], b["stream"], b["data"]):
                rows = read_views(bytes(data))
                if rows:
                    yield pd.DataFrame({"project": project, "stream": stream, **{c: pd.Series([r.get(c) for r in rows], dtype=object) for c in COLUMNS}})

    s = streams.where("data IS NOT NULL").select("project", "stream", F.col("data").cast("binary").alias("data"))
    return s.mapInPandas(run, f"project string, stream string, {VIEW}")


def own_elements(drawn: DataFrame, elements: DataFrame) -> DataFrame:
    """``drawn`` with references through the project's own file (file#id) as the plain ids of ``elements`` (project, id)."""
    known = elements.select("project", "id").distinct()
    v = drawn.withColumn("_own", F.substring_index("element", "#", -1))
    plain = known.select("project", F.col("id").alias("element"), F.lit(True).alias("_plain"))
    v = v.join(plain, ["project", "element"], "left").join(known.select("project", F.col("id").alias("_own"), F.lit(True).alias("_there")), ["project", "_own"], "left")
    to = F.when(F.col("_plain").isNull() & F.col("_there") & F.col("element").contains("#"), F.col("_own")).otherwise(F.col("element"))
    return v.withColumn("element", to).select(*drawn.columns)


def shown_elements(diagrams: DataFrame, drawn: DataFrame, elements: DataFrame) -> DataFrame:
    """(project, id, shown): what each diagram (project, id, stream) draws of the project's elements, in drawing order, each once."""
    v = own_elements(drawn, elements).join(elements.select("project", F.col("id").alias("element")).distinct(), ["project", "element"])
    first = diagrams.join(v, ["project", "stream"]).groupBy("project", "id", "element").agg(F.min("pos").alias("pos"))
    return first.groupBy("project", "id").agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "element"))), lambda x: x["element"]).alias("shown"))
