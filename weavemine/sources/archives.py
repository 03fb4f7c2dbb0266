"""Model archives as tables.

``binaryFile`` rows go in, one row for each parsed fact comes out: elements,
references, stereotype applications, tags and diagrams of every project found
in a file, nested archives included. An archive is one unit of work.
"""

from __future__ import annotations

import hashlib
import io
import json
import re
import zipfile
from collections.abc import Iterator
from dataclasses import dataclass, field
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

EXTENSIONS = ("mdzip", "mdzipx", "mdxml", "xmi", "xml", "uml", "zip", "rdzip")
DEPTH, TOTAL, MEMBER, RATIO = 4, 10 << 30, 64 << 20, 1000
SNIFF = 4096
#: Attributes that are text even where they look like ids.
PLAIN = {"name", "body", "value", "visibility", "aggregation", "Text", "Id"}
XMI = re.compile(r"\{[^}]*(?:XMI|xmi)[^}]*\}")


def first_tag(head: bytes) -> str | None:
    """Name of the first start tag after byte order mark, declarations and comments."""
    text = re.sub(r"<!--.*?-->|<\?.*?\?>|<!DOCTYPE[^>]*>", "", head.decode("utf-8", "replace").lstrip("﻿"), flags=re.S)
    m = re.match(r"\s*<([\w.:-]+)", text)
    return m[1] if m else None


def looks_like_model(head: bytes) -> bool:
    tag = first_tag(head[:SNIFF])
    return tag is not None and tag.rpartition(":")[2] in {"XMI", "Model", "Package"} and b"xmi" in head[:SNIFF]


@dataclass
class Budget:
    """Bytes that may still be unpacked for one input; an absurd ratio is refused at once."""

    left: int = TOTAL

    def take(self, info: zipfile.ZipInfo) -> None:
        if info.file_size > MEMBER and info.file_size > RATIO * max(1, info.compress_size):
            raise ValueError(f"{info.filename}: unpacks to more than {RATIO} times its size")
        self.left -= info.file_size
        if self.left < 0:
            raise ValueError("the archive unpacks to too much")


@dataclass
class Project:
    name: str
    chain: tuple[str, ...]
    data: bytes
    entries: list[tuple[str, bytes]] = field(default_factory=list)

    @property
    def sha256(self) -> str:
        return hashlib.sha256(self.data).hexdigest()


def discover(data: bytes, name: str, chain: tuple[str, ...] = (), budget: Budget | None = None) -> Iterator[Project]:
    """The projects in a file: a bare model, an archive with a model entry, or those of archives inside it."""
    budget = budget or Budget()
    if not zipfile.is_zipfile(io.BytesIO(data)):
        if looks_like_model(data):
            yield Project(name, chain, data, [(name, data)])
        return
    with zipfile.ZipFile(io.BytesIO(data)) as z:
        models, inner = [], []
        for info in sorted(z.infolist(), key=lambda i: (not i.filename.startswith("com.nomagic"), i.filename)):
            base = info.filename.rpartition("/")[2]
            if info.is_dir() or info.file_size < 64:
                continue
            if base.rpartition(".")[2].lower() in EXTENSIONS and info.filename != name:
                inner.append(info)
            elif not base.startswith(("BINARY-", "proxy.")):
                with z.open(info) as f:
                    if looks_like_model(f.read(SNIFF)):
                        models.append(info)
        read = lambda i: (budget.take(i), z.read(i))[1]
        if models:
            yield Project(name, chain, data, [(i.filename, read(i)) for i in models])
            return
        for i in inner if len(chain) < DEPTH else ():
            try:
                yield from discover(read(i), i.filename, (*chain, name), budget)
            except (zipfile.BadZipFile, OSError):
                continue


def _local(tag: str) -> str:
    return tag.rpartition("}")[2]


def _xmi(node: ElementTree.Element, name: str) -> str | None:
    return next((v for k, v in node.attrib.items() if _local(k) == name and XMI.match(k)), None)


class ModelReader:
    """Facts of one project, gathered over its entries and then typed by the ids that are known."""

    def __init__(self) -> None:
        self.elements: dict[str, dict] = {}
        self.apps: list[dict] = []
        self.diagrams: list[dict] = []
        self.prefixes: dict[str, str] = {}

    def read(self, data: bytes) -> None:
        for _, (prefix, uri) in ElementTree.iterparse(io.BytesIO(data), events=("start-ns",)):
            self.prefixes.setdefault(uri, prefix)
        root = ElementTree.fromstring(data)
        for node in [root] if _local(root.tag) != "XMI" else root:
            based = {_local(k): v for k, v in node.attrib.items() if _local(k).startswith("base_")}
            if based:
                self._application(node, next(iter(based.values())))
            elif _xmi(node, "id"):
                self._element(node, None)

    def _application(self, node: ElementTree.Element, base: str) -> None:
        uri, _, name = node.tag[1:].partition("}")
        tags: dict[str, list[str]] = {}
        for k, v in node.attrib.items():
            if not XMI.match(k) and not _local(k).startswith("base_"):
                tags.setdefault(_local(k), []).append(v)
        for child in node:
            value = _xmi(child, "idref") or child.get("href") or child.text or ""
            tags.setdefault(_local(child.tag), []).append(value.strip())
        self.apps.append({"id": _xmi(node, "id"), "stereotype": name, "prefix": self.prefixes.get(uri, ""), "profile_uri": uri, "base": base, "tags": tags})

    def _element(self, node: ElementTree.Element, owner: str | None) -> None:
        stack = [(node, owner)]
        while stack:
            node, owner = stack.pop()
            xid = _xmi(node, "id")
            e = {"id": xid, "type": _xmi(node, "type") or f"uml:{_local(node.tag)}", "role": _local(node.tag), "name": node.get("name"), "owner": owner, "pos": len(self.elements), "attrs": {}, "refs": []}
            self.elements[xid] = e
            e["attrs"].update({_local(k): v for k, v in node.attrib.items() if not XMI.match(k) and k != "name"})
            inner = []
            for child in node:
                self._child(e, child, inner)
            stack += [(c, xid) for c in reversed(inner)]

    def _child(self, e: dict, child: ElementTree.Element, inner: list[ElementTree.Element]) -> None:
        role = _local(child.tag)
        ref = _xmi(child, "idref") or child.get("href")
        if role == "Extension":
            for x in child.iter():
                if _local(x.tag) == "ownedDiagram" and _xmi(x, "id"):
                    self._diagram(x, e["id"])
        elif ref:
            e["refs"].append((role, ref.removeprefix("#")))
        elif _xmi(child, "id"):
            inner.append(child)
        else:
            value = child.get("value") or (child.text or "").strip()
            e["attrs"][role] = f"{e['attrs'][role]}\n{value}" if role in e["attrs"] else value

    def _diagram(self, node: ElementTree.Element, owner: str) -> None:
        shown = next((x for x in node.iter() if _local(x.tag) == "DiagramRepresentationObject"), None)
        streams = [v for x in node.iter() if _local(x.tag) == "binaryObject" if (v := x.get("streamContentID"))]
        xid = _xmi(node, "id")
        self.diagrams.append({"id": xid, "name": node.get("name"), "owner": owner, "diagram_type": shown.get("type") if shown is not None else None, "uml_type": shown.get("umlType") if shown is not None else None, "streams": streams})
        self.elements[xid] = {"id": xid, "type": "uml:Diagram", "role": "ownedDiagram", "name": node.get("name"), "owner": owner, "pos": len(self.elements), "attrs": {}, "refs": []}

    def facts(self) -> Iterator[tuple[str, dict]]:
        """Rows by table; attributes whose words are all known ids are references."""
        for e in self.elements.values():
            refs = list(e.pop("refs"))
            for k in list(e["attrs"]):
                ids = e["attrs"][k].split()
                if k not in PLAIN and ids and all(i in self.elements for i in ids):
                    refs += [(k, i) for i in ids]
                    del e["attrs"][k]
            yield "element", e
            for pos, (role, target) in enumerate(refs):
                yield "ref", {"src": e["id"], "role": role, "target": target, "external": target not in self.elements, "pos": pos}
        for pos, a in enumerate(self.apps):
            tags = {k: [i for v in values for i in v.split()] if k not in PLAIN and all(i in self.elements for v in values for i in v.split()) else values for k, values in a["tags"].items()}
            yield "application", a | {"tags": tags, "pos": pos}
        for d in self.diagrams:
            yield "diagram", d


SCHEMAS = {
    "element": "id string, type string, role string, name string, owner string, pos int, attrs map<string,string>",
    "ref": "src string, role string, target string, external boolean, pos int",
    "application": "id string, stereotype string, prefix string, profile_uri string, base string, tags map<string,array<string>>, pos int",
    "diagram": "id string, name string, owner string, diagram_type string, uml_type string, streams array<string>",
    "project": "name string, chain array<string>, entries array<string>",
    "error": "message string",
}


def _parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        for path, content in zip(pdf["path"], pdf["content"]):
            rows: list[tuple] = []
            try:
                for p in discover(content, path.rpartition("/")[2]):
                    sha = p.sha256
                    reader = ModelReader()
                    for _, data in p.entries:
                        reader.read(data)
                    rows.append((path, sha, "project", json.dumps({"name": p.name, "chain": p.chain, "entries": [n for n, _ in p.entries]})))
                    rows += [(path, sha, kind, json.dumps(x)) for kind, x in reader.facts()]
            except (ValueError, zipfile.BadZipFile, ElementTree.ParseError) as e:
                rows = [(path, hashlib.sha256(content).hexdigest(), "error", json.dumps({"message": str(e)[:500]}))]
            yield pd.DataFrame(rows, columns=["path", "project", "kind", "payload"])


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """(path, project, kind, payload) of every model file below ``path``; unreadable files become an ``error`` row."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path", "content")
    return facts_of(files)


def facts_of(files: DataFrame) -> DataFrame:
    named = files.where(F.lower(F.regexp_extract("path", r"\.([^./]*)$", 1)).isin(*EXTENSIONS))
    return named.mapInPandas(_parse, "path string, project string, kind string, payload string")


def facts(parsed: DataFrame, kind: str) -> DataFrame:
    """One table of the parsed facts, keyed by project."""
    rows = parsed.where(F.col("kind") == kind).select("project", F.from_json("payload", SCHEMAS[kind]).alias("x"))
    return rows.select("project", "x.*")
