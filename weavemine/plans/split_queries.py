"""Registered queries that split things into groups or parts."""

from __future__ import annotations

from pyspark.sql import functions as F

from weavemine.functions import prose as P
from weavemine.functions import text as T
from weavemine.operators import kmeans as K
from weavemine.operators.boxes import enclosing
from weavemine.operators.cuts import median_cuts
from weavemine.plans.registry import query
from weavemine.session import materialize, table


@query("source_word_groups")
def source_word_groups(spark, d):
    """Sources of each language in 4 groups by the words of their documents."""
    docs = table(spark, d, "documents").select(F.concat_ws(" ", "lang", "source").alias("id"), F.explode(T.discovery_tokens(F.col("text"))).alias("word"))
    counts = materialize(docs.groupBy("id", "word").agg(F.count("*").alias("n")), "words")
    ids = counts.select("id").distinct()
    rows = materialize(K.tfidf_rows(counts, ids.count()), "rows")
    return K.spherical_kmeans(rows, ids, 4)


CUTS = """WITH RECURSIVE s AS (
  SELECT p_partkey AS id, p_size::DOUBLE AS x, p_retailprice::DOUBLE / 40 AS y, {size} AS size, p_brand AS m, '' AS part, 0 AS cut FROM part
  UNION ALL
  SELECT id, x, y, size, m, part || CASE WHEN k = 1 OR 2 * (upto) <= whole THEN '0' ELSE '1' END, 1 FROM (
    SELECT *, sum(size) OVER (PARTITION BY m, part ORDER BY pos, id ROWS UNBOUNDED PRECEDING) AS upto, row_number() OVER (PARTITION BY m, part ORDER BY pos, id) AS k FROM (
      SELECT *, CASE WHEN max(x) OVER p - min(x) OVER p >= max(y) OVER p - min(y) OVER p THEN x ELSE y END AS pos, sum(size) OVER p AS whole, count(*) OVER p AS n
      FROM s WINDOW p AS (PARTITION BY m, part)) WHERE whole > 400 AND n > 1)),
f AS (SELECT *, sum(size) OVER (PARTITION BY m, part) AS whole, count(*) OVER (PARTITION BY m, part) AS n FROM s)
SELECT id AS p_partkey, m AS p_brand, part FROM f WHERE whole <= 400 OR n = 1"""


@query("part_cuts", CUTS.format(size="p_size::DOUBLE"))
def part_cuts(spark, d):
    p = table(spark, d, "part").select(F.col("p_partkey").alias("id"), F.col("p_size").cast("double").alias("x"), (F.col("p_retailprice").cast("double") / 40).alias("y"), F.col("p_size").alias("size"), "p_brand")
    return median_cuts(p, 400, "p_brand").select(F.col("id").alias("p_partkey"), "p_brand", "part")


TOKENS_OF = """CAST(ceil(round(1.2 * (1.07 * len(regexp_extract_all({x}, '[A-Za-z]+')) + 0.415 * coalesce(list_sum(list_transform(regexp_extract_all({x}, '[A-Za-z]{{7,}}'), lambda w: length(w) - 6)), 0)
  + 0.42 * len(regexp_extract_all({x}, '[0-9]+')) + 0.375 * length(regexp_replace({x}, '[^0-9]', '', 'g'))
  + 1.07 * len(regexp_extract_all({x}, '[^\\P{{L}}A-Za-z]')) + 0.95 * len(regexp_extract_all({x}, '[^\\s\\p{{L}}0-9]'))), 9)) AS BIGINT)"""


def packing_sql(cost: str, room: int, most: int, lines: str) -> str:
    """Parts of lines by a search over running costs, one part of every text a step."""
    return f"""WITH RECURSIVE l AS ({lines}),
u AS (SELECT doc, k, {cost} AS cost, sum({cost}) OVER (PARTITION BY doc ORDER BY k) AS upto FROM l),
p AS (
  SELECT doc, 0 AS part, 0 AS first, max(CASE WHEN k = 0 OR (upto <= {room} AND k < {most}) THEN k ELSE 0 END) AS last, min(upto) AS base FROM u GROUP BY doc
  UNION ALL
  SELECT u.doc, any_value(p.part) + 1, min(u.k), max(CASE WHEN u.k = p.last + 1 OR (u.upto - e.upto <= {room} AND u.k - p.last <= {most}) THEN u.k ELSE 0 END), 0
  FROM p JOIN u ON u.doc = p.doc AND u.k > p.last JOIN u e ON e.doc = p.doc AND e.k = p.last GROUP BY u.doc)
"""


LINES = "SELECT doc_id AS doc, unnest(string_split(coalesce(text, ''), chr(10))) AS line, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) - 1 AS k FROM documents"


@query("row_packing", packing_sql(TOKENS_OF.format(x="line") + " + 1", 300 - 4 - 2, 4, LINES) + "SELECT u.doc AS doc_id, CAST(u.k AS INTEGER) AS row, CAST(p.part + 1 AS INTEGER) AS part FROM u JOIN p ON p.doc = u.doc AND u.k BETWEEN p.first AND p.last")
def row_packing(spark, d):
    rows = F.split(F.coalesce("text", F.lit("")), "\n")
    docs = table(spark, d, "documents").select("doc_id", P.row_parts(rows, F.lit("Rows"), 300, 4).alias("parts"))
    return docs.select("doc_id", F.posexplode("parts").alias("row", "part"))


BOXES = "SELECT p_brand, p_partkey, p_size::DOUBLE AS x, p_retailprice::DOUBLE / 25 AS y, length(p_name)::DOUBLE AS w, length(p_type)::DOUBLE * 2 AS h FROM part"


@query("enclosing_parts", f"""WITH b AS ({BOXES}),
f AS (SELECT b.p_brand, b.p_partkey, o.p_partkey AS k, o.w * o.h AS area FROM b JOIN b o ON o.p_brand = b.p_brand AND o.x <= b.x AND o.y <= b.y AND o.x + o.w >= b.x + b.w AND o.y + o.h >= b.y + b.h AND o.w * o.h > b.w * b.h),
p AS (SELECT p_brand, p_partkey, arg_min(k, (area, k)) AS parent, count(*) AS depth FROM f GROUP BY ALL)
SELECT b.p_brand, b.p_partkey, parent, coalesce(depth, 0) AS depth FROM b LEFT JOIN p USING (p_brand, p_partkey)""")
def enclosing_parts(spark, d):
    p = table(spark, d, "part").select("p_brand", "p_partkey", F.col("p_size").cast("double").alias("x"), (F.col("p_retailprice").cast("double") / 25).alias("y"), F.char_length("p_name").alias("w"), (2 * F.char_length("p_type")).alias("h"))
    return enclosing(p, ["p_brand"], "p_partkey")
