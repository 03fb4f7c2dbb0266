"""Registered queries over rankings, judgments and samples, made of the events."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from weavemine.operators import grading as G
from weavemine.operators import query as Q
from weavemine.operators import subjects as U
from weavemine.plans.registry import query
from weavemine.plans.search_queries import TOKENS
from weavemine.session import table

RANKED = """ranked AS (SELECT event_type AS system, user_id AS question, event_id AS "window", CAST(row_number() OVER (PARTITION BY event_type, user_id ORDER BY ts, event_id) AS INTEGER) AS rank FROM events),
graded AS (SELECT DISTINCT user_id AS question, event_id AS "window", CAST(event_id % 3 AS INTEGER) AS grade FROM events WHERE event_id % 3 > 0)"""
MEASURED = f"""{RANKED},
ideal AS (SELECT question, sum((2 ** grade - 1) / log2(k + 1)) AS best FROM (SELECT question, grade, row_number() OVER (PARTITION BY question ORDER BY grade DESC) AS k FROM graded) WHERE k <= 10 GROUP BY question),
r AS (SELECT r.*, coalesce(g.grade, 0) AS grade FROM ranked r LEFT JOIN graded g ON g.question = r.question AND g."window" = r."window"),
m AS (SELECT system, question, coalesce(min(rank) FILTER (grade = 2), 1073741824) AS first, coalesce(sum((2 ** grade - 1) / log2(rank + 1)) FILTER (rank <= 10), 0) AS dcg FROM r GROUP BY system, question),
measured AS (SELECT system, m.question, CAST(first <= 1 AS INTEGER) AS hit_1, CAST(first <= 5 AS INTEGER) AS hit_5, CAST(first <= 10 AS INTEGER) AS hit_10, CAST(first <= 20 AS INTEGER) AS hit_20,
  round(CASE WHEN first <= 10 THEN 1.0::DOUBLE / first ELSE 0 END, 6) AS mrr_10, round(coalesce(dcg / nullif(best, 0), 0), 6) AS ndcg_10 FROM m LEFT JOIN ideal ON ideal.question = m.question)"""


def _ranked(spark, d):
    order = Window.partitionBy("event_type", "user_id").orderBy("ts", "event_id")
    return table(spark, d, "events").select(F.col("event_type").alias("system"), F.col("user_id").alias("question"), F.col("event_id").alias("window"), F.row_number().over(order).alias("rank"))


def _graded(spark, d):
    e = table(spark, d, "events").where("event_id % 3 > 0")
    return e.select(F.col("user_id").alias("question"), F.col("event_id").alias("window"), (F.col("event_id") % 3).cast("int").alias("grade")).distinct()


@query("graded_measures", f"WITH {MEASURED} SELECT * FROM measured")
def graded_measures(spark, d):
    return G.measures(_ranked(spark, d), _graded(spark, d))


@query("rank_pools", f'WITH {RANKED} SELECT DISTINCT question, "window" FROM ranked WHERE rank <= 10')
def rank_pools(spark, d):
    return G.pools(_ranked(spark, d))


@query("missed_questions", f"WITH {MEASURED} SELECT question, string_agg(system, ',' ORDER BY system) AS systems FROM measured WHERE hit_10 = 0 GROUP BY question")
def missed_questions(spark, d):
    return G.missed(G.measures(_ranked(spark, d), _graded(spark, d))).select("question", F.array_join("systems", ",").alias("systems"))


@query("run_comparison", f"""WITH {MEASURED}, a AS (SELECT * FROM measured WHERE question % 5 <> 0), b AS (SELECT system, question, 1 - hit_10 AS hit_10, mrr_10 / 2 AS mrr_10 FROM measured WHERE question % 7 <> 0)
SELECT system, count(*) AS n, round(avg(b.hit_10 - a.hit_10), 6) AS change_hit_10, round(avg(b.mrr_10 - a.mrr_10), 6) AS change_mrr_10, coalesce(string_agg(CASE WHEN a.hit_10 = 1 AND b.hit_10 = 0 THEN question END, ',' ORDER BY question), '') AS lost
FROM a JOIN b USING (system, question) GROUP BY system""")
def run_comparison(spark, d):
    m = G.measures(_ranked(spark, d), _graded(spark, d))
    after = m.where("question % 7 <> 0").withColumns({"hit_10": 1 - F.col("hit_10"), "mrr_10": F.col("mrr_10") / 2})
    changes, found = G.run_comparison(m.where("question % 5 <> 0"), after, ["hit_10", "mrr_10"])
    return changes.join(found, "system").select("system", "n", "change_hit_10", "change_mrr_10", F.array_join("lost", ",").alias("lost"))


@query("one_sided_questions", """WITH a AS (SELECT DISTINCT user_id AS q FROM events WHERE user_id % 5 <> 0), b AS (SELECT DISTINCT user_id AS q FROM events WHERE user_id % 7 <> 0)
SELECT count(*) FILTER (b.q IS NULL) AS only_before, count(*) FILTER (a.q IS NULL) AS only_after, count(*) FILTER (a.q IS NOT NULL AND b.q IS NOT NULL) AS both FROM a FULL JOIN b ON a.q = b.q""")
def one_sided_questions(spark, d):
    e = table(spark, d, "events").select(F.col("user_id").alias("question"))
    return G.one_sided(e.where("question % 5 <> 0"), e.where("question % 7 <> 0"))


@query("judge_consensus", """WITH j AS (SELECT user_id % 7 AS question, event_id % 50 AS w, max(CAST(floor(value) AS INTEGER) % 3) FILTER (event_type = 'click') AS a, max(CAST(floor(value) AS INTEGER) % 3) FILTER (event_type = 'view') AS b, max(CAST(floor(value) AS INTEGER) % 3) FILTER (event_type = 'purchase') AS t FROM events GROUP BY ALL)
SELECT question, w AS "window", CASE WHEN a = b THEN a WHEN a IS NOT NULL AND b IS NOT NULL THEN coalesce(t, least(a, b)) ELSE coalesce(a, b) END AS grade FROM j WHERE a IS NOT NULL OR b IS NOT NULL""")
def judge_consensus(spark, d):
    j = table(spark, d, "events").select(F.lit(1).alias("set"), (F.col("user_id") % 7).alias("question"), (F.col("event_id") % 50).alias("window"), F.col("event_type").alias("judge"), (F.floor("value").cast("int") % 3).alias("grade"))
    return G.consensus_grades(j, "click", "view", "purchase").drop("set")


@query("preference_pairs", """WITH n AS (SELECT DISTINCT source AS c, lang AS x FROM documents), p AS (SELECT a.c, a.x, b.x AS y FROM n a JOIN n b ON a.c = b.c AND a.x < b.x)
SELECT c AS collection, x || '-' || y AS pair, x AS a, y AS b FROM p UNION ALL SELECT c, x || '-' || y, y, x FROM p""")
def preference_pairs(spark, d):
    return G.preference_tasks(table(spark, d, "documents").select("source", "lang").distinct())


@query("systematic_sample", "WITH r AS (SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS k, greatest(count(*) OVER () // 60, 1) AS step FROM documents) SELECT doc_id FROM r WHERE k % step = 0 AND k // step < 60")
def systematic_sample(spark, d):
    return G.systematic(table(spark, d, "documents").select("doc_id"), "doc_id", 60)


@query("spread_sizes", "WITH r AS (SELECT doc_id, row_number() OVER (ORDER BY n_chars DESC, doc_id) - 1 AS k, count(*) OVER () AS n FROM documents) SELECT doc_id FROM r WHERE k IN (SELECT floor(i * (SELECT count(*) FROM documents) / 40.0)::BIGINT FROM range(40) t(i))")
def spread_sizes(spark, d):
    return G.spread_pick(table(spark, d, "documents").select("doc_id", "n_chars"), "n_chars", "doc_id", 40).select("doc_id")


W = "lower(coalesce({}, ''))"
ASKED = {1: 'thonre then* "of the"', 2: "req-1 src1 the", 3: '"in the"'}


@query(
    "query_language",
    f"""WITH items AS (SELECT doc_id AS doc, source || ' ' || lang AS title, coalesce(text, '') AS body, lang FROM documents),
f AS (SELECT doc, 'title' AS field, 3.0::DOUBLE AS weight, {TOKENS.replace("coalesce(text, '')", 'title')} AS w FROM items UNION ALL SELECT doc, 'body', 1.0::DOUBLE, {TOKENS.replace("coalesce(text, '')", 'body')} FROM items),
sizes AS (SELECT field, count(*) AS n, avg(len(w)) AS avg_len FROM f GROUP BY field),
post AS (SELECT doc, field, weight, len, word, count(*) AS tf FROM (SELECT doc, field, weight, len(w) AS len, unnest(w) AS word FROM f) GROUP BY ALL),
df AS (SELECT field, word, count(*) AS df FROM post GROUP BY field, word),
ex AS (SELECT DISTINCT word FROM (SELECT word, row_number() OVER (PARTITION BY field ORDER BY word) AS r FROM df WHERE starts_with(word, 'then')) WHERE r <= 200),
asked AS (SELECT * FROM (VALUES (1, 0, 'thonre'), (1, 2, 'of'), (1, 3, 'the'), (2, 0, 'req-1'), (2, 1, 'src1'), (2, 2, 'the'), (3, 0, 'in'), (3, 1, 'the')) t(qid, g, word) UNION ALL SELECT 1, 1, word FROM ex),
phrases AS (SELECT * FROM (VALUES (1, 'of the', 4), (2, '', 3), (3, 'in the', 2)) t(qid, phrase, groups)),
s AS (SELECT qid, doc, round(sum(weight * ln(1 + (n - df + 0.5) / (df + 0.5)) * tf * 2.2::DOUBLE / (tf + 1.2::DOUBLE * (0.25::DOUBLE + 0.75::DOUBLE * len / avg_len))), 6) AS score, count(DISTINCT g) AS matched
  FROM post JOIN asked USING (word) JOIN df USING (field, word) JOIN sizes USING (field) GROUP BY qid, doc),
h AS (SELECT s.*, groups FROM s JOIN items USING (doc) JOIN phrases USING (qid) WHERE lang <> 'de' AND contains(trim(regexp_replace(lower(title || chr(10) || body), '[\\s\\x0B]+', ' ', 'g')), phrase)),
o AS (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY matched DESC, score DESC, doc) AS rank, count(*) OVER (PARTITION BY qid) AS total, sum(CAST(matched = groups AS INTEGER)) OVER (PARTITION BY qid) AS every FROM h)
SELECT qid, doc, score, matched, CAST(rank AS INTEGER) AS rank, total, CAST(every AS BIGINT) AS every FROM o WHERE rank <= 200""",
)
def query_language(spark, d):
    none = F.lit(None).cast("string")
    items = table(spark, d, "documents").select(F.col("doc_id").alias("doc"), none.alias("id"), F.concat_ws(" ", "source", "lang").alias("name"), none.alias("place"), "text", none.alias("chunks"), none.alias("of"), F.lit("document").alias("type"), F.col("lang").alias("project"))
    return Q.search(Q.Index.build(items, ASKED), items, ASKED, project=F.col("project") != "de", kind="document")


@query("subject_overlaps", """WITH s AS (SELECT DISTINCT l_suppkey AS id, l_suppkey % 5 AS family, l_partkey AS element FROM lineitem), n AS (SELECT id, count(*) AS n FROM s GROUP BY id)
SELECT a.id AS a, b.id AS b, round(count(*) / least(max(x.n), max(y.n)), 6) AS shared FROM s a JOIN s b ON a.element = b.element AND a.id < b.id AND a.family <> b.family JOIN n x ON x.id = a.id JOIN n y ON y.id = b.id GROUP BY a.id, b.id""")
def subject_overlaps(spark, d):
    s = table(spark, d, "lineitem").select(F.col("l_suppkey").alias("id"), (F.col("l_suppkey") % 5).alias("family"), F.col("l_partkey").alias("element"))
    return U.shared_elements(s).withColumn("shared", F.round("shared", 6))


@query("topic_sizes", """WITH t AS (SELECT lang, count(DISTINCT doc_id) AS n, count(DISTINCT source) AS f FROM documents GROUP BY lang)
SELECT count(*) AS topics, round(max(n) / sum(n), 6) AS largest, round(sum(CASE WHEN f > 1 THEN n ELSE 0 END) / sum(n), 6) AS across, round(avg(f), 6) AS families_per_topic FROM t""")
def topic_sizes(spark, d):
    return U.topic_measures(table(spark, d, "documents").select(F.col("lang").alias("topic"), F.col("doc_id").alias("subject"), F.col("source").alias("family")))


@query("stratum_rates", """SELECT event_type AS stratum, count(*) AS n, round(sum(event_id % 3) / nullif(sum(3), 0), 6) AS names, round(sum(event_id % 2) / nullif(sum(CASE WHEN event_type = 'click' THEN 0 ELSE 2 END), 0), 6) AS found, round(sum(user_id % 2) / nullif(sum(user_id % 4), 0), 6) AS invented
FROM events GROUP BY GROUPING SETS ((event_type), ())""")
def stratum_rates(spark, d):
    c = F.col
    e = table(spark, d, "events").select(c("event_type").alias("stratum"), (c("event_id") % 3).alias("read"), F.lit(3).alias("words"), (c("event_id") % 2).alias("found"), F.when(c("event_type") == "click", 0).otherwise(2).alias("links"), (c("user_id") % 2).alias("invented"), (c("user_id") % 4).alias("given"))
    return U.rates(e, "stratum")


@query("thin_strata", "SELECT user_id, count(*) FILTER (event_id % 3 = 0) AS asked, count(*) AS n FROM events GROUP BY user_id HAVING 2 * count(*) FILTER (event_id % 3 = 0) < count(*)")
def thin_strata(spark, d):
    return U.thin_groups(table(spark, d, "events").select("user_id", (F.col("event_id") % 3 == 0).alias("asked")), "user_id")


@query("trial_difference", "WITH t AS (SELECT event_id % 5 / 4.0::DOUBLE - event_id % 3 / 2.0::DOUBLE AS d FROM events) SELECT count(*) AS n, round(avg(d), 6) AS difference, round(stddev_samp(d) / sqrt(count(*)), 6) AS se FROM t")
def trial_difference(spark, d):
    t = U.paired_difference(table(spark, d, "events").select("event_id", (F.col("event_id") % 3 / 2.0).alias("first"), (F.col("event_id") % 5 / 4.0).alias("later")))
    return t.select("n", F.round("difference", 6).alias("difference"), F.round("se", 6).alias("se"))


@query("group_targets", "SELECT p_partkey, CAST(greatest(2, least(15, round_even(sqrt(p_partkey / 2.0::DOUBLE), 0))) AS INTEGER) AS groups FROM part")
def group_targets(spark, d):
    return table(spark, d, "part").select("p_partkey", U.target_groups(F.col("p_partkey")).alias("groups"))


@query("view_groups", """WITH g AS (SELECT source AS "group", count(*) AS size, string_agg(doc_id, ',' ORDER BY doc_id) AS members FROM documents GROUP BY source)
SELECT "group", CAST(row_number() OVER (ORDER BY size DESC, "group") AS INTEGER) AS pos, size, members FROM g""")
def view_groups(spark, d):
    g = U.view_groups(table(spark, d, "documents").select(F.col("source").alias("group"), F.col("doc_id").alias("key")))
    return g.withColumn("members", F.array_join(F.transform("members", lambda x: x.cast("string")), ","))
