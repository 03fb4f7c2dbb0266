"""Registered queries over runs, copies, groups and changes."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from weavemine.functions import text as T
from weavemine.operators import evaluation, threads
from weavemine.operators import search as S
from weavemine.plans.registry import query
from weavemine.plans.search_queries import BM25_SQL, OVERLAP, RANKED, TOKENS, word_counts
from weavemine.session import table


@query(
    "coverage_complete",
    f"""WITH {BM25_SQL}, {RANKED}, h AS (SELECT r.qid, d.lang FROM ranked r JOIN documents d ON d.doc_id = r.doc WHERE rank <= 10)
SELECT qid, count(DISTINCT lang) AS parts, round(count(DISTINCT lang) / (SELECT count(DISTINCT lang) FROM documents), 6) AS coverage, CAST(count(DISTINCT lang) = (SELECT count(DISTINCT lang) FROM documents) AS INTEGER) AS complete FROM h GROUP BY qid""",
)
def coverage_complete(spark, d):
    docs = table(spark, d, "documents").select(F.col("doc_id").alias("doc"), "lang")
    every = docs.agg(F.countDistinct("lang").alias("every"))  # one row
    h = word_counts(spark, d).best(10).join(docs, "doc").groupBy("qid").agg(F.countDistinct("lang").alias("parts")).crossJoin(every)
    return h.select("qid", "parts", F.round(F.col("parts") / F.col("every"), 6).alias("coverage"), (F.col("parts") == F.col("every")).cast("int").alias("complete"))


@query(
    "paired_change",
    f"""WITH {BM25_SQL}, {RANKED}, {OVERLAP},
a AS (SELECT r.qid, coalesce(max(l.quality) FILTER (rank <= 10), 0) AS hit FROM ranked r LEFT JOIN labels l ON l.doc_id = r.doc GROUP BY r.qid),
b AS (SELECT r.qid, coalesce(max(l.quality) FILTER (rank <= 10), 0) AS hit FROM overlap r LEFT JOIN labels l ON l.doc_id = r.doc GROUP BY r.qid)
SELECT count(*) AS n, round(avg(b.hit - a.hit), 6) AS change, count(*) FILTER (b.hit > a.hit) AS gained, count(*) FILTER (b.hit < a.hit) AS lost FROM a JOIN b USING (qid)""",
)
def paired_change(spark, d):
    counts = word_counts(spark, d)
    labels = table(spark, d, "labels").select(F.col("doc_id").alias("doc"), "quality")

    def hits(score: str, name: str):
        top = counts.best(10, score).join(labels, "doc", "left")
        return top.groupBy("qid").agg(F.coalesce(F.max("quality"), F.lit(0)).alias(name))

    j = hits("score", "a").join(hits("matched", "b"), "qid")
    return j.agg(F.count("*").alias("n"), F.round(F.avg(F.col("b") - F.col("a")), 6).alias("change"), F.count_if(F.col("b") > F.col("a")).alias("gained"), F.count_if(F.col("b") < F.col("a")).alias("lost"))


@query("pairwise_kappa", """WITH v AS (SELECT user_id // 10 AS judge, event_id // 200 AS task, min(event_type) AS verdict FROM events GROUP BY ALL),
p AS (SELECT a.judge AS a, b.judge AS b, a.verdict AS va, b.verdict AS vb FROM v a JOIN v b ON a.task = b.task AND a.judge < b.judge),
t AS (SELECT a, b, count(*) AS n, avg(CAST(va = vb AS INTEGER)) AS po FROM p GROUP BY a, b),
l AS (SELECT a, b, va AS v, count(*) AS na FROM p GROUP BY ALL), r AS (SELECT a, b, vb AS v, count(*) AS nb FROM p GROUP BY ALL),
c AS (SELECT a, b, sum(na::DOUBLE * nb) AS both_ FROM l JOIN r USING (a, b, v) GROUP BY a, b),
e AS (SELECT a, b, n, po, coalesce(both_, 0) / (n::DOUBLE * n) AS pe FROM t LEFT JOIN c USING (a, b))
SELECT a, b, n, round(po, 6) AS agreement, round(CASE WHEN pe >= 1 THEN 1 ELSE (po - pe) / (1 - pe) END, 6) AS kappa FROM e""")
def pairwise_kappa(spark, d):
    v = table(spark, d, "events").groupBy(F.expr("user_id div 10").alias("judge"), F.expr("event_id div 200").alias("task")).agg(F.min("event_type").alias("verdict"))
    return evaluation.judges_kappa(v)


@query("split_measures", """WITH g AS (SELECT lang, source, count(*) AS n FROM documents GROUP BY lang, source), t AS (SELECT lang, sum(n) AS total FROM g GROUP BY lang)
SELECT lang, count(*) AS groups, round(max(n) / max(total), 6) AS largest, round(-sum(n / total * ln(n / total)) / nullif(ln(count(*)), 0), 6) AS balance, count(*) FILTER (n = 1) AS singletons FROM g JOIN t USING (lang) GROUP BY lang""")
def split_measures(spark, d):
    g = table(spark, d, "documents").groupBy("lang", "source").agg(F.count("*").alias("n"))
    t = g.groupBy("lang").agg(F.sum("n").alias("total"))
    p = F.col("n") / F.col("total")
    entropy = -F.sum(p * F.log(p)) / F.nullif(F.log(F.count("*").cast("double")), F.lit(0.0))
    return g.join(t, "lang").groupBy("lang").agg(F.count("*").alias("groups"), F.round(F.max(p), 6).alias("largest"), F.round(entropy, 6).alias("balance"), F.count_if(F.col("n") == 1).alias("singletons"))


@query("copy_differences", """WITH p AS (SELECT p_brand, p_name, min(p_partkey) AS a, max(p_partkey) AS b FROM part GROUP BY p_brand, p_name HAVING count(*) > 1)
SELECT p.a, p.b, concat_ws(',', CASE WHEN x.p_type <> y.p_type THEN 'type' END, CASE WHEN x.p_size <> y.p_size THEN 'size' END, CASE WHEN x.p_retailprice <> y.p_retailprice THEN 'price' END) AS changed FROM p JOIN part x ON x.p_partkey = p.a JOIN part y ON y.p_partkey = p.b""")
def copy_differences(spark, d):
    part = table(spark, d, "part")
    p = part.groupBy("p_brand", "p_name").agg(F.min("p_partkey").alias("a"), F.max("p_partkey").alias("b")).where("a < b")
    x = part.select(F.col("p_partkey").alias("a"), F.struct("p_type", "p_size", "p_retailprice").alias("x"))
    y = part.select(F.col("p_partkey").alias("b"), F.struct("p_type", "p_size", "p_retailprice").alias("y"))
    aspects = [F.when(~F.col(f"x.{c}").eqNullSafe(F.col(f"y.{c}")), name) for c, name in (("p_type", "type"), ("p_size", "size"), ("p_retailprice", "price"))]
    return p.join(x, "a").join(y, "b").select("a", "b", F.concat_ws(",", *aspects).alias("changed"))


@query("pack_prefix", """WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, unnest(range(0, len(string_split(text, chr(10))))) AS k FROM documents),
s AS (SELECT doc_id, k, sum(length(line) + 1) OVER (PARTITION BY doc_id ORDER BY k) AS used FROM l)
SELECT d.doc_id, CAST(count(s.k) AS BIGINT) AS lines, CAST(coalesce(max(used), 0) AS BIGINT) AS used FROM documents d LEFT JOIN s ON s.doc_id = d.doc_id AND used <= 1000 GROUP BY d.doc_id""")
def pack_prefix(spark, d):
    # as many whole lines as fit: a fold within the row, nothing is shuffled
    start = F.struct(F.lit(0).cast("long").alias("lines"), F.lit(0).cast("long").alias("used"), F.lit(True).alias("open"))

    def step(s, line):
        used = s["used"] + F.char_length(line) + 1
        fits = s["open"] & (used <= 1000)
        return F.struct((s["lines"] + F.when(fits, 1).otherwise(0)).cast("long").alias("lines"), F.when(fits, used).otherwise(s["used"]).cast("long").alias("used"), fits.alias("open"))

    packed = F.aggregate(F.split(F.col("text"), "\n"), start, step)
    return table(spark, d, "documents").select("doc_id", packed.alias("p")).select("doc_id", "p.lines", "p.used")


@query("change_detection", """WITH a AS (SELECT event_id // 2 AS k, value AS v FROM events WHERE event_id % 2 = 0), b AS (SELECT event_id // 2 AS k, value AS v FROM events WHERE event_id % 2 = 1)
SELECT status, count(*) AS n FROM (SELECT CASE WHEN b.k IS NULL THEN 'missing' WHEN a.k IS NULL THEN 'new' WHEN a.v < b.v THEN 'changed' ELSE 'kept' END AS status FROM a FULL JOIN b ON a.k = b.k) GROUP BY status""")
def change_detection(spark, d):
    e = table(spark, d, "events").select(F.expr("event_id div 2").alias("k"), (F.col("event_id") % 2).alias("side"), F.col("value").alias("v"))
    a, b = e.where("side = 0").select("k", F.struct("v").alias("a")), e.where("side = 1").select("k", F.struct("v").alias("b"))
    status = F.when(F.col("b").isNull(), "missing").when(F.col("a").isNull(), "new").when(F.col("a.v") < F.col("b.v"), "changed").otherwise("kept")
    return a.join(b, "k", "full_outer").groupBy(status.alias("status")).agg(F.count("*").alias("n"))


@query("unique_names", "SELECT p_partkey, CASE WHEN k = 1 THEN base ELSE base || '_' || k END AS file FROM (SELECT p_partkey, base, row_number() OVER (PARTITION BY lower(base) ORDER BY p_partkey) AS k FROM (SELECT p_partkey, regexp_replace(p_name, '[^A-Za-z0-9._-]+', '_', 'g') AS base FROM part))")
def unique_names(spark, d):
    base = T.slug(F.col("p_name"), 200)
    p = table(spark, d, "part").select("p_partkey", base.alias("base"))
    k = F.row_number().over(Window.partitionBy(F.lower("base")).orderBy("p_partkey"))
    return p.withColumn("k", k).select("p_partkey", F.when(F.col("k") == 1, F.col("base")).otherwise(F.concat_ws("_", "base", "k")).alias("file"))


@query("snippets", f"""WITH q AS (SELECT DISTINCT item_id, unnest({TOKENS}) AS word FROM benchmark), t AS (SELECT doc_id, text, {TOKENS} AS w FROM documents),
h AS (SELECT item_id, doc_id, word, position(word IN lower(text)) AS spot, text FROM t JOIN q ON list_contains(w, word))
SELECT item_id, doc_id, substring(text, greatest(spot - 90, 1), 180 + length(word) - greatest(91 - spot, 0)) AS snippet FROM h""")
def snippets(spark, d):
    q = S.different_words(table(spark, d, "benchmark"), "item_id", "text").withColumnRenamed("qid", "item_id")
    # a text is lower-cased once, and an excerpt cut once a word, before it goes to all who ask
    low = table(spark, d, "documents").select("doc_id", "text", F.lower("text").alias("low"), F.array_distinct(T.search_words(F.col("text"))).alias("words"))
    held = low.select("doc_id", "text", "low", F.explode("words").alias("word")).join(F.broadcast(q.select("word").distinct()), "word", "left_semi")
    held = held.withColumn("at", F.expr("locate(word, low)"))
    begin = F.greatest(F.col("at") - 90, F.lit(1))
    size = F.lit(180) + F.char_length("word") - F.greatest(F.lit(91) - F.col("at"), F.lit(0))
    cut = held.select("doc_id", "word", F.substring("text", begin, size).alias("snippet"))
    return cut.join(F.broadcast(q), "word").select("item_id", "doc_id", "snippet")


@query("containment_walk")
def containment_walk(spark, d):
    r, n, s = (table(spark, d, t) for t in ("region", "nation", "supplier"))
    edges = n.select(F.concat(F.lit("r"), "n_regionkey").alias("parent"), F.concat(F.lit("n"), "n_nationkey").alias("child"))
    edges = edges.unionByName(s.select(F.concat(F.lit("n"), "s_nationkey").alias("parent"), F.concat(F.lit("s"), "s_suppkey").alias("child")))
    names = r.select(F.concat(F.lit("r"), "r_regionkey").alias("id"), F.col("r_name").alias("name")).unionByName(n.select(F.concat(F.lit("n"), "n_nationkey"), "n_name").toDF("id", "name")).unionByName(s.select(F.concat(F.lit("s"), "s_suppkey"), "s_name").toDF("id", "name"))
    return threads.walk(edges, names)
