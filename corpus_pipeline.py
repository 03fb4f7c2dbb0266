"""The training-corpus pipeline: reject, deduplicate, redact, mix, encode.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written
as Parquet and read again as the next one's ``docs``. All but the last return
the columns of ``documents``; further columns, whatever their names, are carried
along by all but the last.

Defined results: a null text is an empty one and stays null until it is encoded
to no tokens; empty texts are near copies of each other, so one of them stays,
and the mix, which counts words, takes no text without any. Null ids come after
all others where one of several is kept; rows that repeat each other are near
copies. Ties are settled by the least id, then by a hash of the text. Texts of
any length are read whole. An empty table gives no rows.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weavemine.llm import automaton, mixing, nearcopies, pii, toxicity
from weavemine.session import shared_dir, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the chain, fitted to the labelled ones among them, does not call toxic."""
    return toxicity.reject(docs, toxicity.fit_chain(docs, table(spark, sf_dir, "labels")))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near copies (five-word Jaccard of 0.8 or more), the one with the least id."""
    return nearcopies.keep_one(docs)


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pii.redact(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, in the order of training."""
    return mixing.mix(docs)


def encode_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, lang, source, n_tokens, ids), in the order of ``docs``."""
    ids = automaton.encode(docs.select("doc_id", "text", "lang", "source"), public_tokenizers.path("word_bpe_49k.json"))
    return ids.select("doc_id", "lang", "source", F.size("ids").cast("long").alias("n_tokens"), "ids")


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash", drop_near_copies),
    ("pii", redact_personal_data),
    ("mixing", mix_sources),
    ("bpe", encode_tokens),
]

#: Classifier, XXH64 shingles and the tokenizer are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    folder = f"{shared_dir(spark)}/weavemine-pipeline/{uuid.uuid4().hex}"
    for k, (name, stage) in enumerate(STAGES):
        out = stage(spark, docs, sf_dir)
        out.write.parquet(f"{folder}/{k}-{name}")
        docs = spark.read.parquet(f"{folder}/{k}-{name}")
    return docs
