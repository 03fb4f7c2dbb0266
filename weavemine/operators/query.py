"""A search index over two fields, and a query language over it: words, "phrases" and prefix* terms."""

from __future__ import annotations

import re
from functools import reduce
from operator import or_

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from weavemine.functions.text import WORDS, one_line, search_words
from weavemine.operators.search import K1, B
from weavemine.session import materialize

TITLE, LIMIT, PREFIX_MOST = 3.0, 200, 200
_WORD = re.compile(WORDS)


def parse(query: str | None) -> tuple[list[tuple[str, bool]], list[str]]:
    """(groups, phrases): tokens with whether they are prefixes, then the phrases' own; an item matches a group that it holds a token of."""
    text = query or ""
    phrases = [p for p in (re.sub(r"\s+", " ", m.strip().lower()) for m in re.findall(r'"([^"]*)"', text)) if p]
    groups: list[tuple[str, bool]] = []
    for part in re.sub(r'"[^"]*"', " ", text).split():
        found = _WORD.findall(part.removesuffix("*").lower())
        groups += [(t, part.endswith("*") and k == len(found) - 1) for k, t in enumerate(found)]
    return groups + [(t, False) for p in phrases for t in _WORD.findall(p)], phrases


def parsed(query: Column) -> Column:
    """struct(groups, phrases) of a column of queries."""

    @F.pandas_udf("struct<groups:array<struct<token:string,prefix:boolean>>,phrases:array<string>>")
    def run(q: pd.Series) -> pd.DataFrame:
        both = [parse(x) for x in q]
        return pd.DataFrame({"groups": [[{"token": t, "prefix": p} for t, p in g] for g, _ in both], "phrases": [p for _, p in both]})

    return run(query)


def indexed_text(items: DataFrame) -> DataFrame:
    """(doc, title, body) of items (doc, id, name, place, text, chunks, of): a title is id and name; the chunks' text stands for an item's own."""
    line = lambda *cs: F.array_join(F.filter(F.array(*[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in cs]), lambda x: x != ""), "\n")
    rows = items.withColumn("_body", F.when(F.coalesce("chunks", F.lit("")) != "", F.col("chunks")).otherwise(F.col("text")))
    return rows.select("doc", F.regexp_replace(line("id", "name"), "\n", " ").alias("title"), line("place", "_body", "of").alias("body"))


class Index:
    """Postings of both fields, laid out by word, with the fields' sizes; built once and searched many times."""

    def __init__(self, postings: DataFrame, sizes: DataFrame):
        self.postings, self.sizes = postings, sizes

    @classmethod
    def build(cls, items: DataFrame, queries: dict[int, str] | None = None) -> "Index":
        """Of all words, or only of those that some queries ask: then no other word leaves its text."""
        texts = indexed_text(items)
        fields = F.array(F.struct(F.lit("title").alias("field"), search_words(F.col("title")).alias("words")), F.struct(F.lit("body").alias("field"), search_words(F.col("body")).alias("words")))
        rows = texts.select("doc", F.explode(fields).alias("f")).select("doc", "f.field", "f.words", F.size("f.words").alias("len"))
        sizes = rows.groupBy("field").agg(F.count("*").alias("n"), F.avg("len").alias("avg_len"))
        if queries is not None:
            asked = {pair for text in queries.values() for pair in parse(text)[0]}
            exact, prefixes = sorted(t for t, p in asked if not p), sorted(t for t, p in asked if p)
            wanted = lambda w: reduce(or_, (F.startswith(w, F.lit(t)) for t in prefixes), w.isin(exact))
            rows = rows.withColumn("words", F.filter("words", wanted))
        posted = rows.select("doc", "field", "len", F.explode("words").alias("word")).groupBy("field", "word", "doc", "len").agg(F.count("*").alias("tf"))
        posted = materialize(posted, "asked") if queries is not None else posted
        df = posted.groupBy("field", "word").agg(F.count("*").alias("df"))
        posted = posted.join(df, ["field", "word"])
        return cls(materialize(posted.repartition(F.col("word")).sortWithinPartitions("word"), "search-postings"), materialize(sizes, "search-sizes"))

    @classmethod
    def read(cls, spark: SparkSession, folder: str) -> "Index":
        return cls(spark.read.parquet(f"{folder}/postings"), spark.read.parquet(f"{folder}/sizes"))

    def write(self, folder: str) -> None:
        """Files sorted by word, so that a search reads the row groups of its words only."""
        self.postings.repartition(F.col("word")).sortWithinPartitions("word").write.mode("overwrite").parquet(f"{folder}/postings")
        self.sizes.write.mode("overwrite").parquet(f"{folder}/sizes")

    def expand(self, prefixes: DataFrame, most: int = PREFIX_MOST) -> DataFrame:
        """(prefix, word): of each field's vocabulary the first ``most`` words that begin so, in order; the limit is the feature."""
        words = self.postings.select("field", "word").distinct()
        hit = words.join(F.broadcast(prefixes.select("prefix").distinct()), F.col("word").startswith(F.col("prefix")))  # the terms of the queries
        order = Window.partitionBy("prefix", "field").orderBy("word")
        return hit.withColumn("r", F.row_number().over(order)).where(F.col("r") <= most).select("prefix", "word").distinct()

    def scored(self, groups: DataFrame) -> DataFrame:
        """(qid, doc, score, matched) for groups (qid, group, word): matched counts groups, not words."""
        idf = F.log(1 + (F.col("n") - F.col("df") + 0.5) / (F.col("df") + 0.5))
        norm = K1 * (1 - B + B * F.col("len") / F.col("avg_len"))
        weight = F.when(F.col("field") == "title", TITLE).otherwise(1.0)
        rows = self.postings.join(groups.distinct(), "word").join(F.broadcast(self.sizes), "field")  # two rows
        return rows.groupBy("qid", "doc").agg(F.sum(weight * idf * F.col("tf") * (K1 + 1) / (F.col("tf") + norm)).alias("score"), F.countDistinct("group").alias("matched"))


def search(index: Index, items: DataFrame, queries: dict[int, str], project: Column | None = None, kind: str | None = None, limit: int = LIMIT) -> DataFrame:
    """(qid, doc, score, matched, rank, total, every): items that hold every group first, then by score; ``every`` counts those.

    ``project`` is a condition on the items' project, ``kind`` their type. All of a query's phrases must be in an item.
    """
    spark = items.sparkSession
    read = {q: parse(text) for q, text in queries.items()}
    rows = [(q, k, t, p) for q, (groups, _) in read.items() for k, (t, p) in enumerate(groups)]
    asked = spark.createDataFrame(rows, "qid int, group int, token string, prefix boolean")
    words = asked.where("NOT prefix").select("qid", "group", F.col("token").alias("word"))
    if any(p for *_, p in rows):
        longer = index.expand(asked.where("prefix").select(F.col("token").alias("prefix")))
        words = words.unionByName(asked.where("prefix").join(longer.withColumnRenamed("prefix", "token"), "token").select("qid", "group", "word"))
    hits = index.scored(words)
    hay = one_line(F.lower(F.concat_ws("\n", "name", "place", "text", "chunks")))
    kept = items if project is None else items.where(project)
    kept = kept if kind is None else kept.where(F.col("type") == kind)
    hits = hits.join(kept.select("doc", hay.alias("hay")), "doc")
    whole = spark.createDataFrame([(q, list(p), len(g)) for q, (g, p) in read.items()], "qid int, phrases array<string>, groups int")
    hits = hits.join(F.broadcast(whole), "qid").where(F.forall("phrases", lambda p: F.contains(F.col("hay"), p)))
    hits = materialize(hits.select("qid", "doc", "score", "matched", "groups"), "hits")  # ranked and counted, met with the texts once
    order = Window.partitionBy("qid").orderBy(F.col("matched").desc(), F.col("score").desc(), "doc")
    hits = hits.withColumn("score", F.round("score", 6)).withColumn("rank", F.row_number().over(order))
    total = hits.groupBy("qid").agg(F.count("*").alias("total"), F.count_if(F.col("matched") == F.col("groups")).alias("every"))
    return hits.where(F.col("rank") <= limit).join(total, "qid").select("qid", "doc", "score", "matched", "rank", "total", "every")


def excerpt(text: Column, terms: Column, width: int = 90) -> Column:
    """A short excerpt around the first term (array of lower-case terms), or the start."""
    line = one_line(F.coalesce(text, F.lit("")))
    at = F.array_min(F.filter(F.transform(terms, lambda t: F.instr(F.lower(line), t)), lambda p: p > 0))
    first = F.coalesce(at - 1, F.lit(0))
    start = F.greatest(first - width, F.lit(0))
    end = F.least(F.char_length(line), first + 2 * width)
    return F.concat(F.when(start > 0, "…").otherwise(""), F.substring(line, start + 1, end - start), F.when(end < F.char_length(line), "…").otherwise(""))


def marked(text: Column, terms: Column) -> Column:
    """A text in pieces, array of (text, mark): at each place the longest term that begins there is marked."""

    @F.pandas_udf("array<struct<text:string,mark:boolean>>")
    def run(texts: pd.Series, lists: pd.Series) -> pd.Series:
        out = []
        for t, ts in zip(texts, lists):
            t, at, pieces = t or "", 0, []
            words = sorted({x for x in ts if x}, key=len, reverse=True)
            for m in re.finditer("|".join(map(re.escape, words)), t.lower()) if words else ():
                pieces += [{"text": t[at : m.start()], "mark": False}] * (m.start() > at) + [{"text": t[m.start() : m.end()], "mark": True}]
                at = m.end()
            out.append(pieces + [{"text": t[at:], "mark": False}] * (at < len(t)))
        return pd.Series(out)

    return run(text, terms)


def tag_pieces(text: Column, tags: Column) -> Column:
    """A text in pieces, array of (text, tag): each "[n]" whose number the map knows leads to its element."""

    @F.pandas_udf("array<struct<text:string,tag:string>>")
    def run(texts: pd.Series, maps: pd.Series) -> pd.Series:
        out = []
        for t, known in zip(texts, maps):
            known, at, pieces = dict(known or {}), 0, []
            for m in re.finditer(r"\[(\d+)\]", t):
                if m[1] in known:
                    pieces += [{"text": t[at : m.start()], "tag": None}] * (m.start() > at) + [{"text": m[0], "tag": known[m[1]]}]
                    at = m.end()
            out.append(pieces + [{"text": t[at:], "tag": None}] * (at < len(t) or not pieces))
        return pd.Series(out)

    return run(text, tags)


def collapse_shared(hits: DataFrame) -> DataFrame:
    """Copies of one element in several models once, at the first hit, with ``copies``; hits have (qid, rank, type, key, shared)."""
    same = Window.partitionBy("qid", "type", "key", "shared")
    n = F.row_number().over(same.orderBy("rank"))
    return hits.withColumns({"_n": n, "copies": F.when(F.col("shared"), F.count("*").over(same))}).where(~F.col("shared") | (F.col("_n") == 1)).drop("_n")


def grouped_hits(hits: DataFrame, placed: DataFrame) -> DataFrame:
    """(qid, group, group_rank, doc, rank, versions): hits by where they are placed, groups in the order of their best hit.

    ``hits`` has (qid, doc, rank, family, type, key): an item of a family held by
    several versions counts once; ``placed`` (family, type, key, group) says where it is, else it is under its model.
    """
    same = Window.partitionBy("qid", "family", "type", "key")
    once = hits.withColumns({"_n": F.row_number().over(same.orderBy("rank")), "versions": F.count("*").over(same)}).where("_n = 1").drop("_n")
    g = once.join(placed, ["family", "type", "key"], "left").withColumn("group", F.coalesce("group", F.concat(F.lit("model "), F.col("family").cast("string"))))
    first = g.groupBy("qid", "group").agg(F.min("rank").alias("best"))
    ranked = first.withColumn("group_rank", F.row_number().over(Window.partitionBy("qid").orderBy("best"))).drop("best")
    return g.join(ranked, ["qid", "group"]).select("qid", "group", "group_rank", "doc", "rank", "versions")
