"""Registered queries over state, identity, text and hierarchy."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from weavemine.functions import text as T
from weavemine.operators import chunking, evaluation, hierarchy, identity, state
from weavemine.operators.components import connected_components
from weavemine.plans.registry import query
from weavemine.plans.split_queries import LINES, packing_sql
from weavemine.session import materialize, table

W = T.WORDS
LINE = "trim(regexp_replace(text, '[\\s\\x0B]+', ' ', 'g'))"


@query("status_view", "SELECT c_custkey, c_name, coalesce(n, 0) AS n_orders, CASE WHEN n IS NULL THEN 'pending' WHEN open_ > 0 THEN 'working' ELSE 'written' END AS status FROM customer LEFT JOIN (SELECT o_custkey, count(*) AS n, count(*) FILTER (o_orderstatus = 'O') AS open_ FROM orders GROUP BY o_custkey) ON o_custkey = c_custkey")
def status_view(spark, d):
    n = table(spark, d, "orders").groupBy("o_custkey").agg(F.count("*").alias("n"), F.count_if(F.col("o_orderstatus") == "O").alias("open_"))
    status = F.when(F.col("n").isNull(), "pending").when(F.col("open_") > 0, "working").otherwise("written")
    return table(spark, d, "customer").join(n, F.col("o_custkey") == F.col("c_custkey"), "left").select("c_custkey", "c_name", F.coalesce("n", F.lit(0)).alias("n_orders"), status.alias("status"))


@query("orphans", "SELECT o_orderkey, o_totalprice FROM orders WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)")
def orphans(spark, d):
    return table(spark, d, "orders").join(table(spark, d, "lineitem"), F.col("l_orderkey") == F.col("o_orderkey"), "left_anti").select("o_orderkey", "o_totalprice")


@query("stale_items", "SELECT o_orderkey FROM orders LEFT JOIN (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY l_orderkey) ON l_orderkey = o_orderkey WHERE coalesce(n, 0) < 2 AND o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')")
def stale_items(spark, d):
    line = table(spark, d, "lineitem").withColumnRenamed("l_orderkey", "o_orderkey")
    done = line.groupBy("o_orderkey").agg(F.count("*").alias("n"))
    return state.stale(table(spark, d, "orders").select("o_orderkey"), done, "o_orderkey", F.col("n") >= 2, line.where("l_returnflag = 'R'").select("o_orderkey").distinct())


@query("not_in_or", "SELECT p_partkey FROM part WHERE p_partkey NOT IN (SELECT l_partkey FROM lineitem WHERE l_quantity > 45) OR p_partkey NOT IN (SELECT l_partkey FROM lineitem WHERE l_returnflag = 'A')")
def not_in_or(spark, d):
    line = table(spark, d, "lineitem")
    a = line.where("l_quantity > 45").select(F.col("l_partkey").alias("a")).distinct()
    b = line.where("l_returnflag = 'A'").select(F.col("l_partkey").alias("b")).distinct()
    p = table(spark, d, "part")
    return p.join(a, p.p_partkey == a.a, "left").join(b, p.p_partkey == b.b, "left").where("a IS NULL OR b IS NULL").select("p_partkey")


@query("incremental_merge", "SELECT o_orderkey, o_orderstatus, CASE WHEN o_orderpriority = '2-HIGH' THEN o_totalprice * 2 ELSE o_totalprice END AS o_totalprice FROM orders WHERE o_orderpriority <> '1-URGENT'")
def incremental_merge(spark, d):
    o = table(spark, d, "orders")
    target = o.select("o_orderkey", "o_orderstatus", "o_totalprice")
    delta = o.where("o_orderpriority IN ('1-URGENT', '2-HIGH')").select("o_orderkey", "o_orderstatus", (F.col("o_totalprice") * 2).alias("o_totalprice"), (F.col("o_orderpriority") == "1-URGENT").alias("gone"))
    return state.merge(target, delta, ["o_orderkey"], "gone")


@query("adjacency_both_ends", "SELECT node, direction, count(*) AS n, min(other) AS first FROM (SELECT 'c' || o_custkey AS node, 'out' AS direction, o_orderkey AS other FROM orders UNION ALL SELECT 'o' || o_orderkey, 'in', o_custkey FROM orders) GROUP BY node, direction")
def adjacency_both_ends(spark, d):
    o = table(spark, d, "orders")
    out = o.select(F.concat(F.lit("c"), "o_custkey").alias("node"), F.lit("out").alias("direction"), F.col("o_orderkey").alias("other"))
    into = o.select(F.concat(F.lit("o"), "o_orderkey").alias("node"), F.lit("in").alias("direction"), F.col("o_custkey").alias("other"))
    return out.unionByName(into).groupBy("node", "direction").agg(F.count("*").alias("n"), F.min("other").alias("first"))


@query("majority_vote", "SELECT user_id, event_type, votes FROM (SELECT user_id, event_type, count(*) AS votes, row_number() OVER (PARTITION BY user_id ORDER BY count(*) DESC, event_type) AS r FROM events GROUP BY user_id, event_type) WHERE r = 1")
def majority_vote(spark, d):
    return identity.majority(table(spark, d, "events"), "user_id", "event_type")


@query("metadata_merge", "SELECT event_type, 'k' AS key, string_agg(DISTINCT v, ',' ORDER BY v) AS found FROM (SELECT event_type, json_extract_string(props, '$.k') AS v FROM events) WHERE v IS NOT NULL GROUP BY event_type")
def metadata_merge(spark, d):
    e = table(spark, d, "events").select("event_type", F.explode(F.from_json("props", "map<string,string>")).alias("key", "v"))
    return e.groupBy("event_type", "key").agg(F.array_join(F.array_sort(F.collect_set("v")), ",").alias("found"))


@query("kappa_labels", "WITH p AS (SELECT quality AS a, 1 - toxic AS b FROM labels), t AS (SELECT count(*) AS n, count(*) FILTER (a = b) AS same FROM p), c AS (SELECT sum(x.n::DOUBLE * y.n) AS chance FROM (SELECT a, count(*) AS n FROM p GROUP BY a) x JOIN (SELECT b, count(*) AS n FROM p GROUP BY b) y ON x.a = y.b) SELECT n, round(same / n, 6) AS agreement, round((same / n - chance / (n::DOUBLE * n)) / (1 - chance / (n::DOUBLE * n)), 6) AS kappa FROM t CROSS JOIN c")
def kappa_labels(spark, d):
    return evaluation.kappa(table(spark, d, "labels").select("quality", (1 - F.col("toxic")).alias("clean")), "quality", "clean")


@query("panel_consensus", "SELECT doc_id, CASE WHEN quality = 1 - toxic THEN quality ELSE coalesce(CASE WHEN n_chars > 2000 THEN 1 WHEN n_chars < 500 THEN 0 END, least(quality, 1 - toxic)) END AS grade FROM labels JOIN documents USING (doc_id)")
def panel_consensus(spark, d):
    j = table(spark, d, "labels").join(table(spark, d, "documents").select("doc_id", "n_chars"), "doc_id")
    third = F.when(F.col("n_chars") > 2000, 1).when(F.col("n_chars") < 500, 0)
    return j.select("doc_id", evaluation.consensus(F.col("quality"), 1 - F.col("toxic"), third).alias("grade"))


@query("both_orders", "SELECT user_id, CASE WHEN count(*) >= 2 AND min(event_type) = max(event_type) THEN min(event_type) ELSE 'inconsistent' END AS verdict, count(*) AS n FROM events GROUP BY user_id")
def both_orders(spark, d):
    same = (F.count("*") >= 2) & (F.min("event_type") == F.max("event_type"))
    return table(spark, d, "events").groupBy("user_id").agg(F.when(same, F.min("event_type")).otherwise("inconsistent").alias("verdict"), F.count("*").alias("n"))


@query("isotonic_fit", """WITH p AS (SELECT p_size AS x, avg(p_retailprice) AS y, count(*) AS w FROM part GROUP BY p_size),
s AS (SELECT a.x AS lo, b.x AS hi, sum(c.y * c.w) / sum(c.w) AS m FROM p a JOIN p b ON a.x <= b.x JOIN p c ON c.x BETWEEN a.x AND b.x GROUP BY a.x, b.x)
SELECT x, w, round(y, 6) AS y, round((SELECT max(m) FROM (SELECT lo, min(m) AS m FROM s WHERE hi >= p.x AND lo <= p.x GROUP BY lo)), 6) AS fit FROM p""")
def isotonic_fit(spark, d):
    p = table(spark, d, "part").groupBy(F.col("p_size").alias("x")).agg(F.avg("p_retailprice").alias("y"), F.count("*").alias("w"))
    return evaluation.isotonic(p, "x", "y", "w").select("x", "w", F.round("y", 6).alias("y"), F.round("fit", 6).alias("fit"))


@query("bootstrap_means")
def bootstrap_means(spark, d):
    return evaluation.bootstrap_mean(table(spark, d, "labels").join(table(spark, d, "documents").select("doc_id", "lang"), "doc_id").withColumn("quality", F.col("quality").cast("double")), "lang", "quality")


@query("rollup_rates", "SELECT coalesce(lang, 'all') AS lang, count(*) AS n, round(avg(quality), 6) AS quality, round(avg(toxic), 6) AS toxic FROM labels JOIN documents USING (doc_id) GROUP BY GROUPING SETS ((lang), ())")
def rollup_rates(spark, d):
    j = table(spark, d, "labels").join(table(spark, d, "documents").select("doc_id", "lang"), "doc_id")
    return j.rollup("lang").agg(F.count("*").alias("n"), F.round(F.avg("quality"), 6).alias("quality"), F.round(F.avg("toxic"), 6).alias("toxic")).withColumn("lang", F.coalesce("lang", F.lit("all")))


@query("identifier_index", "SELECT word, count(DISTINCT doc_id) AS places FROM (SELECT doc_id, unnest(regexp_extract_all(lower(text), '[a-z][a-z0-9]+')) AS word FROM documents) GROUP BY word HAVING places >= 2")
def identifier_index(spark, d):
    posted = table(spark, d, "documents").select("doc_id", F.explode(T.discovery_tokens(F.col("text"))).alias("word"))
    return identity.identifier_index(posted, "word", "doc_id")


@query("shared_copies", f"""WITH i AS (SELECT source AS token, doc_id AS key, substring(sha256({LINE}), 1, 16) AS rid, lang || n_chars AS kind_name FROM documents),
r AS (SELECT token, key, rid FROM (SELECT *, count(*) OVER (PARTITION BY token, rid) AS n FROM i) WHERE n = 1),
k AS (SELECT token, key, kind_name FROM (SELECT *, count(*) OVER (PARTITION BY token, kind_name) AS n FROM i) WHERE n = 1),
w AS (SELECT a.token AS token_a, a.key AS key_a, b.token AS token_b, b.key AS key_b, '1 element' AS by_ FROM i a JOIN i b ON a.key = b.key AND a.token < b.token
 UNION ALL SELECT a.token, a.key, b.token, b.key, '2 requirement' FROM r a JOIN r b ON a.rid = b.rid AND a.token < b.token
 UNION ALL SELECT a.token, a.key, b.token, b.key, '3 name' FROM k a JOIN k b ON a.kind_name = b.kind_name AND a.token < b.token)
SELECT token_a, key_a, token_b, key_b, min(by_) AS "by" FROM w GROUP BY ALL""")
def shared_copies(spark, d):
    items = table(spark, d, "documents").select(F.col("source").alias("token"), F.col("doc_id").alias("key"), T.text_digest(F.col("text")).alias("rid"), F.concat("lang", F.col("n_chars").cast("string")).alias("kind_name"))
    return identity.shared_items(items)


OVERLAP = """WITH o AS (SELECT DISTINCT l_suppkey AS m, l_partkey AS i FROM lineitem), z AS (SELECT m, count(*) AS n FROM o GROUP BY m),
p AS (SELECT a.m AS a, b.m AS b, count(*) AS shared FROM o a JOIN o b ON a.i = b.i AND a.m < b.m GROUP BY a.m, b.m),
v AS (SELECT a, b, shared, shared / least(x.n, y.n) AS cover, shared / (x.n + y.n - shared) AS jaccard FROM p JOIN z x ON x.m = a JOIN z y ON y.m = b)"""


@query("version_pairs", OVERLAP + " SELECT a, b, shared, round(cover, 6) AS cover, round(jaccard, 6) AS jaccard, CASE WHEN jaccard >= 0.5 OR (cover >= 0.8 AND shared >= 50) THEN 'version' WHEN cover >= 0.2 AND shared >= 20 THEN 'related' ELSE 'none' END AS kind FROM v")
def version_pairs(spark, d):
    p = identity.overlaps(table(spark, d, "lineitem"), "l_suppkey", "l_partkey")
    kind = identity.version_class(F.col("shared"), F.col("cover"), F.col("jaccard"))
    return p.select("a", "b", "shared", F.round("cover", 6).alias("cover"), F.round("jaccard", 6).alias("jaccard"), kind.alias("kind"))


@query("components", """WITH RECURSIVE e AS (SELECT a.doc_id AS x, b.doc_id AS y FROM documents a JOIN documents b ON a.text = b.text AND a.doc_id <> b.doc_id),
r AS (SELECT x, y FROM e UNION SELECT r.x, e.y FROM r JOIN e ON e.x = r.y) SELECT x AS node, least(x, min(y)) AS component FROM r GROUP BY x""")
def components(spark, d):
    docs = table(spark, d, "documents").select("doc_id", F.sha2("text", 256).alias("h"))
    least = docs.groupBy("h").agg(F.min("doc_id").alias("dst"), F.count("*").alias("n")).where("n > 1")
    return connected_components(docs.join(least, "h").select(F.col("doc_id").alias("src"), "dst"))


TFIDF = """WITH t AS (SELECT source AS id, lang || substring(source, 4, 1) AS family, unnest(regexp_extract_all(lower(text), '[a-z][a-z0-9]+')) AS word FROM documents),
f AS (SELECT id, family, word, count(*) AS tf FROM t GROUP BY ALL), n AS (SELECT count(DISTINCT id) AS n FROM t),
df AS (SELECT word, count(*) AS df, count(DISTINCT family) AS families FROM f GROUP BY word),
w AS (SELECT id, family, word, (1 + ln(tf)) * ln(n::DOUBLE / df) AS w FROM f JOIN df USING (word) CROSS JOIN n WHERE df <= n / 2 AND families > 1),
u AS (SELECT id, family, word, w / sqrt(sum(w * w) OVER (PARTITION BY id)) AS w FROM w),
p AS (SELECT a.id AS a, b.id AS b, round(sum(a.w * b.w), 6) AS sim FROM u a JOIN u b ON a.word = b.word AND a.id < b.id AND a.family <> b.family GROUP BY a.id, b.id)"""


def _tfidf(spark, d):
    t = table(spark, d, "documents").select(F.col("source").alias("id"), F.concat("lang", F.substring("source", 4, 1)).alias("family"), F.explode(T.discovery_tokens(F.col("text"))).alias("word"))
    return identity.tfidf_pairs(t).withColumn("sim", F.round("sim", 6))


@query("tfidf_cross", TFIDF + " SELECT a, b, sim FROM p")
def tfidf_cross(spark, d):
    return _tfidf(spark, d)


@query("knn_graph", TFIDF + ", q AS (SELECT a, b, sim FROM p UNION ALL SELECT b, a, sim FROM p), k AS (SELECT *, row_number() OVER (PARTITION BY a ORDER BY sim DESC, b) AS r FROM q) SELECT DISTINCT least(a, b) AS a, greatest(a, b) AS b, sim FROM k WHERE r <= 5")
def knn_graph(spark, d):
    return identity.nearest(_tfidf(spark, d))


@query("distinctive_words", """WITH t AS (SELECT lang, unnest(regexp_extract_all(lower(text), '[a-z][a-z0-9]+')) AS word FROM documents),
i AS (SELECT lang, word, count(*) AS c FROM t GROUP BY ALL), z AS (SELECT lang, count(*) AS size FROM t GROUP BY lang), o AS (SELECT word, count(*) AS total FROM t GROUP BY word),
s AS (SELECT lang, word, round(c / size - (total - c) / ((SELECT count(*) FROM t) - size), 9) AS score FROM i JOIN z USING (lang) JOIN o USING (word) WHERE c > 1)
SELECT * FROM (SELECT lang, word, score, CAST(row_number() OVER (PARTITION BY lang ORDER BY score DESC, word) AS INTEGER) AS rank FROM s) WHERE rank <= 12""")
def distinctive_words(spark, d):
    t = table(spark, d, "documents").select("lang", F.explode(T.discovery_tokens(F.col("text"))).alias("word"))
    return identity.distinctive_words(t, "lang", 12)


@query("tree_diff", f"""WITH s AS (SELECT doc_id // 2 AS k, doc_id % 2 AS side, substring(sha256({LINE}), 1, 16) AS h FROM documents), a AS (SELECT * FROM s WHERE side = 0), b AS (SELECT * FROM s WHERE side = 1)
SELECT coalesce(a.k, b.k) AS k, CASE WHEN a.k IS NULL THEN 'added' WHEN b.k IS NULL THEN 'removed' WHEN a.h = b.h THEN 'same' ELSE 'changed' END AS change FROM a FULL OUTER JOIN b ON a.k = b.k""")
def tree_diff(spark, d):
    s = table(spark, d, "documents").select(F.expr("doc_id div 2").alias("k"), (F.col("doc_id") % 2).alias("side"), T.text_digest(F.col("text")).alias("h"))
    return identity.snapshot_diff(s.where("side = 0"), s.where("side = 1"), ["k"], "h")


@query("natural_order", "SELECT p_partkey, row_number() OVER (ORDER BY regexp_extract(lower(p_brand), '^\\D*'), CAST(regexp_extract(p_brand, '(\\d+)', 1) AS INTEGER), p_partkey) AS place FROM part")
def natural_order(spark, d):
    # places of a global order: rank the brands, then number parts within their brand
    p = table(spark, d, "part")
    brands = p.groupBy("p_brand").agg(F.count("*").alias("n")).withColumn("key", T.natural_key(F.col("p_brand")))
    before = F.coalesce(F.sum("n").over(Window.orderBy("key").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    inside = F.row_number().over(Window.partitionBy("p_brand").orderBy("p_partkey"))
    return p.join(brands.select("p_brand", before.alias("before")), "p_brand").select("p_partkey", (F.col("before") + inside).alias("place"))


@query("stratified_round_robin", "SELECT doc_id, CAST(row_number() OVER (PARTITION BY lang, source ORDER BY n_chars DESC, doc_id) AS INTEGER) AS turn FROM documents")
def stratified_round_robin(spark, d):
    turn = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.col("n_chars").desc(), "doc_id"))
    return table(spark, d, "documents").select("doc_id", turn.alias("turn"))


@query("token_windows", f"""WITH t AS (SELECT doc_id AS doc, len(regexp_extract_all(lower(coalesce(text, '')), '{W}')) AS n FROM documents),
s AS (SELECT doc, n, unnest(CASE WHEN n <= 510 THEN [0] ELSE range(0, CAST(ceil((n - 64) / 446) AS BIGINT)) END) AS window_ FROM t)
SELECT doc, CAST(window_ AS INTEGER) AS "window", CAST(window_ * 446 AS INTEGER) AS begin, CAST(least(window_ * 446 + 510, n) AS INTEGER) AS "end" FROM s""")
def token_windows(spark, d):
    return chunking.token_windows(table(spark, d, "documents").select(F.col("doc_id").alias("doc"), F.size(T.search_words(F.col("text"))).alias("n")))


@query("token_estimate", """WITH t AS (SELECT source, regexp_extract_all(text, '[A-Za-z]+') AS w, regexp_extract_all(text, '[0-9]+') AS d, len(regexp_extract_all(text, '[^\\s\\x0BA-Za-z0-9]')) AS m,
  len(regexp_extract_all(text, '\\p{L}')) - len(regexp_extract_all(text, '[A-Za-z]')) AS u FROM documents)
SELECT source, count(*) AS n, CAST(sum(CAST(ceil(round(1.2 * (1.07 * (len(w) + u) + 0.415 * coalesce(list_sum(list_transform(w, lambda x: greatest(length(x) - 6, 0))), 0) + 0.42 * len(d) + 0.375 * coalesce(list_sum(list_transform(d, lambda x: length(x))), 0) + 0.95 * (m - u)), 9)) AS BIGINT)) AS BIGINT) AS tokens FROM t GROUP BY source""")
def token_estimate(spark, d):
    return table(spark, d, "documents").groupBy("source").agg(F.count("*").alias("n"), F.sum(T.token_estimate(F.col("text"))).alias("tokens"))


_PACKED = packing_sql("(length(line) + 3) // 4 + 1", 200, 1 << 30, LINES) + """SELECT p.doc, CAST(p.part AS INTEGER) AS part, CAST(p.first AS INTEGER) AS first, CAST(p.last AS INTEGER) AS last, CAST(sum(u.cost) AS INTEGER) AS tokens
FROM p JOIN u ON u.doc = p.doc AND u.k BETWEEN p.first AND p.last GROUP BY p.doc, p.part, p.first, p.last"""


@query("greedy_parts", _PACKED)
def greedy_parts(spark, d):
    return chunking.pack_lines(table(spark, d, "documents").withColumnRenamed("doc_id", "doc"), 200)


@query("chunk_ids", "SELECT doc_id, substring(sha256(concat_ws('|', source, CAST(doc_id AS VARCHAR), text)), 1, 24) AS chunk_id FROM documents")
def chunk_ids(spark, d):
    return table(spark, d, "documents").select("doc_id", T.chunk_id(F.col("source"), F.col("doc_id").cast("string"), F.col("text")).alias("chunk_id"))


@query("dedup_text", "SELECT sha256(text) AS digest, min(doc_id) AS first_key, count(*) AS copies FROM documents GROUP BY text")
def dedup_text(spark, d):
    return chunking.dedup_text(table(spark, d, "documents"), "doc_id", "text")


_TITLE = "coalesce(regexp_extract(html, '(?is)<title>(.*?)</title>', 1), '')"


@query("html_title", f"SELECT page_id, {_TITLE} AS title, CAST(length({_TITLE}) AS INTEGER) AS n FROM pages")
def html_title(spark, d):
    title = F.coalesce(F.regexp_extract("html", r"(?is)<title>(.*?)</title>", 1), F.lit(""))
    return table(spark, d, "pages").select("page_id", title.alias("title"), F.char_length(title).alias("n"))


@query("package_split", """WITH s AS (SELECT page_id, string_split(regexp_extract(url, '://([^?#]*)', 1), '/') AS p FROM pages),
l AS (SELECT page_id, k, array_to_string(p[1:k], '/') AS path FROM (SELECT page_id, p, unnest(range(1, len(p) + 1)) AS k FROM s)),
g AS (SELECT k, count(DISTINCT path) AS groups FROM l GROUP BY k)
SELECT CAST(k AS INTEGER) AS depth, groups, CAST(row_number() OVER (ORDER BY abs(groups - 12), k) AS INTEGER) AS place FROM g""")
def package_split(spark, d):
    p = F.split(F.regexp_extract("url", r"://([^?#]*)", 1), "/")
    rows = table(spark, d, "pages").select(p.alias("p")).select("p", F.explode(F.sequence(F.lit(1), F.size("p"))).alias("depth"))
    g = rows.groupBy("depth").agg(F.countDistinct(F.array_join(F.slice("p", F.lit(1), F.col("depth")), "/")).alias("groups"))
    return g.withColumn("place", F.row_number().over(Window.orderBy(F.abs(F.col("groups") - 12), "depth")))


@query("qualified_name", "SELECT 'c' || c_custkey AS id, r_name || '::' || n_name || '::' || c_name AS qualified FROM customer JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey UNION ALL SELECT 'n' || n_nationkey, r_name || '::' || n_name FROM nation JOIN region ON r_regionkey = n_regionkey UNION ALL SELECT 'r' || r_regionkey, r_name FROM region")
def qualified_name(spark, d):
    r = table(spark, d, "region").select(F.concat(F.lit("r"), "r_regionkey").alias("id"), F.lit(None).cast("string").alias("owner"), F.col("r_name").alias("name"))
    n = table(spark, d, "nation").select(F.concat(F.lit("n"), "n_nationkey").alias("id"), F.concat(F.lit("r"), "n_regionkey").alias("owner"), F.col("n_name").alias("name"))
    c = table(spark, d, "customer").select(F.concat(F.lit("c"), "c_custkey").alias("id"), F.concat(F.lit("n"), "c_nationkey").alias("owner"), F.col("c_name").alias("name"))
    return hierarchy.qualified_names(r.unionByName(n).unionByName(c))


@query("nearest_owner", """WITH t AS (SELECT conv_id, turn, role FROM conversations)
SELECT a.conv_id || ':' || a.turn AS id, max(b.turn) AS owner_turn FROM t a JOIN t b ON a.conv_id = b.conv_id AND b.turn <= a.turn AND b.role = 'user'
WHERE NOT EXISTS (SELECT 1 FROM range(0, 100) g(x) WHERE x > b.turn AND x < a.turn AND NOT EXISTS (SELECT 1 FROM t c WHERE c.conv_id = a.conv_id AND c.turn = x)) GROUP BY a.conv_id, a.turn""")
def nearest_owner(spark, d):
    c = table(spark, d, "conversations").select("conv_id", "turn", "role").dropDuplicates(["conv_id", "turn"])
    nodes = c.select(F.concat_ws(":", "conv_id", "turn").alias("id"), F.concat_ws(":", "conv_id", F.col("turn") - 1).alias("owner"), "role", "turn")
    near = hierarchy.nearest_ancestor(nodes, F.col("role") == "user")
    return near.select("id", F.split_part("ancestor", F.lit(":"), F.lit(2)).cast("long").alias("owner_turn"))


LINEAGE = OVERLAP.replace("WITH o AS", """WITH f AS (SELECT l_suppkey AS m, l_partkey AS i, min(l_shipdate) AS day, min(l_returnflag) AS maker FROM lineitem GROUP BY l_suppkey, l_partkey),
o AS""") + """,
s AS (SELECT m, min(day) AS saved FROM f GROUP BY m),
k AS (SELECT v.*, CASE WHEN (x.saved, v.a) <= (y.saved, v.b) THEN v.a ELSE v.b END AS older, CASE WHEN (x.saved, v.a) <= (y.saved, v.b) THEN v.b ELSE v.a END AS newer
  FROM v JOIN s x ON x.m = v.a JOIN s y ON y.m = v.b WHERE cover >= 0.2 AND shared >= 20),
d AS (SELECT older, newer, day, row_number() OVER (PARTITION BY older, newer ORDER BY day) AS r, count(*) OVER (PARTITION BY older, newer) AS n
  FROM k JOIN f ON f.m = k.older WHERE EXISTS (SELECT 1 FROM f g WHERE g.m = k.newer AND g.i = f.i)),
l AS (SELECT older, newer, day AS latest FROM d WHERE r = least(n, CAST(floor(0.95 * n) AS BIGINT) + 1)),
own AS (SELECT k.older, k.newer, side, f.m, f.day > l.latest AS late, f.maker IN (SELECT maker FROM f h WHERE h.m = CASE WHEN side = 0 THEN k.newer ELSE k.older END) AS same
  FROM k JOIN l ON l.older = k.older AND l.newer = k.newer CROSS JOIN (SELECT unnest([0, 1]) AS side) JOIN f ON f.m = CASE WHEN side = 0 THEN k.older ELSE k.newer END
  WHERE NOT EXISTS (SELECT 1 FROM f g WHERE g.m = CASE WHEN side = 0 THEN k.newer ELSE k.older END AND g.i = f.i)),
st AS (SELECT older, newer, count(*) FILTER (side = 0) AS own_a, count(*) FILTER (side = 1) AS own_b, coalesce(round(avg(CAST(late AS INTEGER)) FILTER (side = 0), 3), 0) AS after_a, coalesce(round(avg(CAST(late AS INTEGER)) FILTER (side = 1), 3), 0) AS after_b,
  coalesce(round(avg(CAST(same AS INTEGER)) FILTER (side = 0), 3), 0) AS same_a, coalesce(round(avg(CAST(same AS INTEGER)) FILTER (side = 1), 3), 0) AS same_b FROM own GROUP BY older, newer)
SELECT older, newer, shared, own_a, own_b, after_a, after_b,
  CASE WHEN after_b >= 0.6 AND after_a < 0.6 THEN CASE WHEN same_b >= 0.15 THEN 'version' ELSE 'derived' END
       WHEN after_a >= 0.6 AND after_b >= 0.6 THEN CASE WHEN same_a >= 0.6 AND same_b >= 0.6 THEN 'branches' ELSE 'root' END ELSE 'related' END AS kind
FROM k JOIN st USING (older, newer)"""


@query("lineage_sides", LINEAGE)
def lineage_sides(spark, d):
    f = table(spark, d, "lineitem").groupBy(F.col("l_suppkey").alias("model"), F.col("l_partkey").alias("id")).agg(F.min("l_shipdate").alias("day"), F.min("l_returnflag").alias("maker"))
    f = materialize(f, "marks")
    saved = f.groupBy("model").agg(F.min("day").alias("saved"))
    return identity.lineage(f, saved).select("older", "newer", "shared", "own_a", "own_b", "after_a", "after_b", "kind")
