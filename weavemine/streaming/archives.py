"""New model archives as a stream of parsed facts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from weavemine.sources.archives import facts_of


def watch_archives(spark: SparkSession, folder: str, per_trigger: int = 100) -> DataFrame:
    """The facts of files as they appear; each file is read once (the checkpoint remembers it)."""
    schema = "path string, modificationTime timestamp, length long, content binary"
    files = spark.readStream.format("binaryFile").schema(schema).option("maxFilesPerTrigger", per_trigger).option("recursiveFileLookup", "true").load(folder)
    return facts_of(files.select("path", "content"))
