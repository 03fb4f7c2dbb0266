"""Outputs: tables, JSON lines, chunk files with their metadata, manifests, and publishing a set of tables at once.

Everything is written by Spark, so every path Spark can write to will do.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from weavemine.functions.origins import chunk_ref
from weavemine.functions.text import cell, markdown_to_plain


def write_csv(df: DataFrame, path: str) -> None:
    """CSV with a header; quotes are doubled, line ends stay in their cells."""
    df.write.mode("overwrite").option("header", "true").option("quote", '"').option("escape", '"').option("quoteAll", "true").csv(path)


def write_jsonl(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("ignoreNullFields", "true").json(path)


def model_tables(elements: DataFrame, refs: DataFrame, applications: DataFrame, diagrams: DataFrame, edges: DataFrame, required: DataFrame, names: DataFrame, multiplicities: DataFrame) -> dict[str, DataFrame]:
    """The six tables of a model's facts, with qualified names (project, id, qualified) looked up."""
    key = ["project", "id"]
    q = lambda c: names.select("project", F.col("id").alias(c), F.col("qualified").alias(f"{c}_name"))
    st = applications.groupBy("project", F.col("base").alias("id")).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "stereotype"))), lambda x: x["stereotype"]), ";").alias("stereotypes"))
    named = elements.join(names, key, "left").join(st, key, "left")
    typed = refs.where("role = 'type'").groupBy("project", F.col("src").alias("id")).agg(F.min_by("target", "pos").alias("type_id"))
    owned = elements.where(F.col("role").isin("ownedAttribute", "ownedPort", "ownedEnd")).join(typed, key, "left").join(multiplicities, key, "left")
    values = applications.select("project", F.col("base").alias("element_id"), "stereotype", F.explode("tags").alias("tag", "v")).select("project", "element_id", "stereotype", "tag", F.explode("v").alias("value"))
    return {
        "elements": named.select("project", "id", "type", "name", "qualified", "owner", "stereotypes"),
        "relationships": edges.join(q("source"), ["project", "source"], "left").join(q("target"), ["project", "target"], "left").select("project", "id", "kind", "metaclass", "name", "source", "source_name", "target", "target_name"),
        "requirements": required.join(names, key, "left").join(st, key, "left").select("project", "id", "rid", "name", "text", "qualified", "stereotypes"),
        "properties": owned.select("project", "id", "owner", "name", "type_id", "multiplicity", F.try_element_at("attrs", F.lit("aggregation")).alias("aggregation")),
        "tagged_values": values,
        "diagrams": diagrams.join(q("owner"), ["project", "owner"], "left").select("project", "id", "name", "diagram_type", "uml_type", "owner", "owner_name"),
    }


def write_tables(tables: Mapping[str, DataFrame], folder: str) -> None:
    for name, df in tables.items():
        write_csv(df, f"{folder}/tables/{name}.csv")


def chunk_text(text: Column, project: Column, chunk: Column, locator: Column, found_with: Column, form: str = "trace") -> Column:
    """A chunk as a file: its text, where it came from, and the metadata (key to values) of the inputs it was found in."""
    source = chunk_ref(project, chunk) if form == "id" else locator
    line = F.when(F.coalesce(source, F.lit("")) != "", F.concat(F.lit("Source: "), F.concat(F.lit("["), source, F.lit("]")) if form == "id" else source))
    entries = F.array_sort(F.map_entries(F.map_filter(found_with, lambda k, v: F.size(v) > 0)))
    found = F.array_join(F.transform(entries, lambda e: F.concat(e["key"], F.lit("="), F.array_join(e["value"], ", "))), "; ")
    lines = F.array_compact(F.array(F.regexp_replace(text, r"\s+$", ""), F.lit(""), line, F.when(F.coalesce(found, F.lit("")) != "", F.concat(F.lit("Found with: "), found))))
    return F.concat(F.array_join(lines, "\n"), F.lit("\n"))


def chunk_files(chunks: DataFrame) -> DataFrame:
    """(folder, file, text, meta): chunks (folder, id, title, kind, body) under the digest of their text; those with one text share a file, and its metadata lists them."""
    named = chunks.withColumn("file", F.concat(F.sha2("body", 256), F.lit(".txt")))
    order = F.array_sort(F.collect_list(F.struct("id", "title", "kind")))
    g = named.groupBy("folder", "file").agg(F.first("body").alias("text"), order.alias("all"))
    first = F.get("all", F.lit(0))
    others = F.nullif(F.transform(F.slice("all", 2, 1 << 30), lambda x: x["id"]), F.array().cast("array<string>"))
    meta = F.to_json(F.struct(F.col("file"), markdown_to_plain(F.regexp_replace(F.substring_index("text", "\n", 1), "^[# ]+", "")).alias("title"), first["id"].alias("chunk_id"), first["kind"].alias("kind"), others.alias("same_text_chunk_ids")))
    return g.select("folder", "file", "text", meta.alias("meta"))


def manifest(written: DataFrame, files: DataFrame, failed: DataFrame) -> DataFrame:
    """(section, token, record): a JSON record of each written project with its files' digests, and of each failed one."""
    listed = files.groupBy("content_sha256").agg(F.array_sort(F.collect_list(F.struct("path", "sha256"))).alias("files"))
    token = F.concat(F.lit("sha256:"), "content_sha256")
    done = written.join(listed, "content_sha256", "left").select(F.lit("projects").alias("section"), token.alias("token"), F.to_json(F.struct("name", "summary", "files")).alias("record"))
    bad = failed.select(F.lit("failed").alias("section"), F.concat(F.lit("sha256:"), "sha256").alias("token"), F.to_json(F.struct("name", "error")).alias("record"))
    return done.unionByName(bad)


def sheet(df: DataFrame, columns: Sequence[str], order: Sequence[str], cut: int, most: int = 1_048_575) -> DataFrame:
    """Rows as a sheet takes them: in order, as many as it holds (the limit is the format's), whole numbers as they are, other values cut."""
    kinds = dict(df.dtypes)
    shown = [F.col(c) if kinds[c] in ("int", "bigint", "smallint", "tinyint") else cell(F.col(c), cut).alias(c) for c in columns]
    r = df.withColumn("_row", F.row_number().over(Window.orderBy(*order)))
    return r.where(F.col("_row") <= most).select("_row", *shown).withColumnRenamed("_row", "row")


def _markers(spark: SparkSession, folder: str) -> list[str]:
    """Names of the published versions, oldest first: a number and the version."""
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(f"{folder}/published")
    fs = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return sorted(f.getPath().getName() for f in fs.listStatus(at)) if fs.exists(at) else []


def publish(spark: SparkSession, folder: str, tables: Mapping[str, DataFrame]) -> str:
    """Write all tables under a new version, then name it: readers see all of them or none. Returns the version.

    A version is named by one empty file whose name says all, so there is no
    moment without a version once there is one; the greatest name is the current
    one, and of two that are named at once either may be.
    """
    version = uuid.uuid4().hex
    for name, df in tables.items():
        df.write.parquet(f"{folder}/versions/{version}/{name}")
    before = _markers(spark, folder)
    number = int(before[-1].split("-")[0]) + 1 if before else 0
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{folder}/published/{number:012d}-{version}")
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(at, False).close()
    return version


def is_published(spark: SparkSession, folder: str) -> bool:
    return bool(_markers(spark, folder))


def published(spark: SparkSession, folder: str, name: str) -> DataFrame:
    markers = _markers(spark, folder)
    if not markers:
        raise FileNotFoundError(f"{folder}: nothing is published")
    return spark.read.parquet(f"{folder}/versions/{markers[-1].split('-')[1]}/{name}")
