"""Units of text from written outputs: chunk records, chunk files with their metadata, tables and JSON lines."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from weavemine.functions.text import classed_kind

CHUNK = "id string, title string, text string, metadata struct<kind:string,about_class:string,element_id:string,content:string>"


def read_jsonl(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """JSON lines; blank lines are no rows."""
    lines = spark.read.text(path).where(F.trim("value") != "")
    return lines.select(F.from_json("value", schema).alias("x")).select("x.*")


def read_csv(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("header", "true").option("multiLine", "true").option("escape", '"').csv(path)


def chunk_units(chunks: DataFrame) -> DataFrame:
    """(id, text, element_id, kind, project) of chunk records; the class of generated text is part of its kind."""
    m = lambda c: F.col(f"metadata.{c}")
    return chunks.select("id", "text", m("element_id").alias("element_id"), classed_kind(m("kind"), F.coalesce(m("about_class"), F.lit(""))).alias("kind"), m("content").alias("project"))


def file_units(texts: DataFrame, metas: DataFrame) -> DataFrame:
    """Units of chunk files (path, text) joined with their metadata (folder, file, chunk_id, element_id, kind, project)."""
    t = texts.select(F.regexp_extract("path", "([^/]+)/[^/]+$", 1).alias("folder"), F.regexp_extract("path", "([^/]+)$", 1).alias("file"), "text")
    return t.join(metas, ["folder", "file"]).select(F.col("chunk_id").alias("id"), "text", "element_id", "kind", "project")


def glob(column: Column, pattern: str) -> Column:
    """Whether a value matches a shell pattern, case and all."""
    out, special = "", {"*": ".*", "?": "."}
    for c in pattern:
        out += special.get(c) or ("\\" + c if not c.isalnum() and c not in "_" else c)
    return column.rlike(f"(?s)^{out}$")


def run_units(units: DataFrame, project: str | None = None, details: bool = True, without: Sequence[str] = ()) -> DataFrame:
    """The units of a run: of projects that begin so, with or without details, kinds that match a pattern left out."""
    out = units if project is None else units.where(F.col("project").startswith(project))
    out = out if details else out.where(~F.col("kind").endswith(":details"))
    for pattern in without:
        out = out.where(~glob(F.col("kind"), pattern))
    return out


def embedded_images(entries: DataFrame, least: int = 64) -> DataFrame:
    """(project, entry, media_type, content) of entries that are pictures by their first bytes."""
    from weavemine.functions.text import media_type

    return entries.where(F.length("content") >= least).withColumn("media_type", media_type(F.col("content"))).where("media_type IS NOT NULL").select("project", "entry", "media_type", "content")
