"""Registered queries over the state of a tree, made of the driver's tables in both engines alike."""

from __future__ import annotations

from pyspark.sql import functions as F

from weavemine.operators import tree_state as S
from weavemine.plans.registry import query
from weavemine.session import table

#: The state tables as SQL that both engines read.
VIEWS = {
    "inputs": "SELECT c_custkey AS id, concat('/in/', c_mktsegment, '/', c_custkey) AS path, CASE c_custkey % 7 WHEN 0 THEN 'missing' WHEN 1 THEN 'failed' WHEN 2 THEN 'pending' ELSE 'done' END AS status, concat('{\"segment\":\"', c_mktsegment, '\",\"nation\":\"', c_nationkey, '\"}') AS metadata, c_custkey * 10 AS size, c_custkey AS mtime, concat('v', c_custkey % 3) AS sha256, CAST(NULL AS STRING) AS error FROM customer",
    "contents": "SELECT concat('s', p_partkey) AS sha256, p_name AS name, 'zip' AS kind, CAST(p_size AS BIGINT) AS size, '2026' AS first_seen FROM part",
    "sightings": "SELECT DISTINCT concat('s', l_partkey) AS content_sha256, l_suppkey AS input_id, concat('v', l_linenumber % 3) AS input_sha256, '[\"m\"]' AS chain, '2026' AS seen FROM lineitem WHERE l_partkey % 3 <> 0",
    "projects": "SELECT concat('s', p_partkey) AS content_sha256, CASE p_partkey % 5 WHEN 0 THEN 'failed' WHEN 1 THEN 'working' ELSE 'written' END AS status, concat('t', p_size % 2) AS tool, concat('h', p_size % 3) AS options_hash, '{}' AS summary, CAST(NULL AS STRING) AS error, '2026' AS updated FROM part WHERE p_partkey % 4 <> 0",
    "gaps": "SELECT concat('s', p_partkey) AS content_sha256, concat('h', p_partkey % 3) AS options_hash, 2 AS items, CAST(p_partkey % 4 AS INT) AS builds FROM part WHERE p_partkey % 6 = 0",
    "removed": "SELECT concat('s', p_partkey) AS content_sha256, p_name AS name, '2026' AS removed FROM part WHERE p_partkey % 11 = 0",
    "fingerprints": "SELECT concat('s', p_partkey) AS content_sha256, '2026' AS saved, '2026' AS saved_raw, 'zip' AS saved_from, 'P' AS project_id, 'X' AS exporter, CAST(p_size AS BIGINT) AS elements FROM part WHERE p_partkey % 3 <> 0",
    "marks": "SELECT concat('s', p_partkey) AS content_sha256 FROM part WHERE p_partkey % 5 <> 0",
}
CTE = ",\n".join(f"{k} AS ({v.replace('AS STRING', 'AS VARCHAR')})" for k, v in VIEWS.items())
CURRENT = f"""WITH {CTE},
current AS (
  SELECT content_sha256, known.name, input_id, path, input_status, metadata, input_sha256, chain FROM sightings
  JOIN (SELECT id AS input_id, sha256 AS input_sha256, path, status AS input_status, metadata FROM inputs) USING (input_id, input_sha256)
  JOIN (SELECT sha256 AS content_sha256, any_value(name) AS name FROM contents GROUP BY ALL) known USING (content_sha256)),
seen AS (SELECT content_sha256 AS sha256, count(*) AS n FROM current GROUP BY ALL),
built AS (SELECT content_sha256 AS sha256, max(status) AS state, max(error) AS error, max(updated) AS updated FROM projects GROUP BY ALL),
status AS (
  SELECT sha256, name, if(EXISTS (FROM removed WHERE content_sha256 = contents.sha256), 'removed', ifnull(state, 'pending')) AS status, error, updated, ifnull(n, 0) AS sightings
  FROM contents LEFT JOIN built USING (sha256) LEFT JOIN seen USING (sha256))"""


def state(spark, d):
    """The state tables by name."""
    out = {}
    for name, sql in VIEWS.items():
        source = sql.partition(" FROM ")[2].split()[0]
        view = f"weavemine_{source}"
        table(spark, d, source).createOrReplaceTempView(view)
        out[name] = spark.sql(sql.replace(f" FROM {source}", f" FROM {view}", 1))
    return out


def _current(t):
    return S.current_sightings(t["sightings"], t["inputs"], t["contents"])


def _status(t):
    return S.project_status(t["contents"], t["projects"], t["removed"], _current(t))


@query("current_sightings", f"{CURRENT} SELECT * FROM current")
def current_sightings(spark, d):
    return _current(state(spark, d))


@query("project_status", f"{CURRENT} SELECT * FROM status")
def project_status(spark, d):
    return _status(state(spark, d))


@query("state_catalog", f"{CURRENT} SELECT s.*, f.saved, f.saved_raw, f.saved_from, f.project_id, f.exporter, f.elements FROM status s LEFT JOIN fingerprints f ON f.content_sha256 = s.sha256")
def state_catalog(spark, d):
    t = state(spark, d)
    return S.catalog(_status(t), t["fingerprints"])


@query("written_projects", f"{CURRENT} SELECT p.*, c.name, c.kind, c.size FROM projects p JOIN contents c ON c.sha256 = p.content_sha256 WHERE p.status = 'written'")
def written_projects(spark, d):
    t = state(spark, d)
    return S.written(t["projects"], t["contents"])


STALE = "(p.status IS NULL OR p.status <> 'written' OR p.tool <> 't1' OR p.options_hash <> 'h1'"


@query("stale_contents", f"{CURRENT} SELECT c.sha256, c.name FROM contents c LEFT JOIN projects p ON p.content_sha256 = c.sha256 WHERE {STALE} OR c.sha256 IN (SELECT content_sha256 FROM gaps WHERE options_hash = 'h1')) AND c.sha256 NOT IN (SELECT content_sha256 FROM removed)")
def stale_contents(spark, d):
    t = state(spark, d)
    return S.stale_contents(t["contents"], t["projects"], t["removed"], "t1", "h1", t["gaps"])


@query("work_list", f"""{CURRENT}, stale AS (SELECT c.sha256, c.name FROM contents c LEFT JOIN projects p ON p.content_sha256 = c.sha256 WHERE {STALE}) AND c.sha256 NOT IN (SELECT content_sha256 FROM removed)),
w AS (SELECT content_sha256 AS sha256, min(path) AS path FROM current WHERE input_status = 'done' GROUP BY content_sha256)
SELECT path, count(*) AS n, string_agg(sha256, ',' ORDER BY sha256) AS shas FROM stale JOIN w USING (sha256) GROUP BY path""")
def work_list(spark, d):
    t = state(spark, d)
    w = S.work_list(S.stale_contents(t["contents"], t["projects"], t["removed"], "t1", "h1"), _current(t))
    return w.select("path", F.size("work").cast("long").alias("n"), F.array_join(F.array_sort(F.transform("work", lambda x: x["sha256"])), ",").alias("shas"))


@query("state_orphans", f"{CURRENT} SELECT sha256, name FROM contents c WHERE NOT EXISTS (SELECT 1 FROM current v WHERE v.content_sha256 = c.sha256 AND v.input_status <> 'missing')")
def state_orphans(spark, d):
    t = state(spark, d)
    return S.orphans(t["contents"], _current(t))


@query("unfingerprinted", f"{CURRENT} SELECT sha256, name FROM contents WHERE sha256 NOT IN (SELECT content_sha256 FROM fingerprints) OR sha256 NOT IN (SELECT content_sha256 FROM marks)")
def unfingerprinted(spark, d):
    t = state(spark, d)
    return S.unfingerprinted(t["contents"], t["fingerprints"], t["marks"])


@query("gap_rows", f"{CURRENT} SELECT g.*, c.name FROM gaps g JOIN projects p ON p.content_sha256 = g.content_sha256 JOIN contents c ON c.sha256 = g.content_sha256 WHERE p.status = 'written' AND g.options_hash = p.options_hash")
def gap_rows(spark, d):
    t = state(spark, d)
    return S.gap_rows(t["gaps"], t["projects"], t["contents"])


@query("state_counts", f"""{CURRENT} SELECT 'inputs' AS section, status AS key, count(*) AS n FROM inputs GROUP BY status UNION ALL SELECT 'projects', status, count(*) FROM status GROUP BY status
UNION ALL SELECT 'gaps', 'projects', count(*) FROM gaps g JOIN projects p ON p.content_sha256 = g.content_sha256 WHERE p.status = 'written' AND g.options_hash = p.options_hash""")
def state_counts(spark, d):
    t = state(spark, d)
    return S.tree_status(t["inputs"], _status(t), S.gap_rows(t["gaps"], t["projects"], t["contents"]))


@query("project_tallies", f"""{CURRENT} SELECT (SELECT count(*) FROM projects WHERE status = 'written' AND tool = 't1' AND options_hash = 'h1') AS done,
(SELECT count(*) FROM gaps g JOIN projects p ON p.content_sha256 = g.content_sha256 WHERE p.status = 'written' AND g.options_hash = 'h1' AND g.options_hash = p.options_hash) AS gaps""")
def project_tallies(spark, d):
    t = state(spark, d)
    done = S.count_projects(t["projects"], "written", "t1", "h1").withColumnRenamed("n", "done")
    return done.crossJoin(S.with_gaps(t["gaps"], t["projects"], "h1").withColumnRenamed("n", "gaps"))  # one row each


@query("checked_inputs", f"""{CURRENT}, l AS (SELECT path, size, CASE WHEN id % 10 = 0 THEN mtime + 1 ELSE mtime END AS mtime FROM inputs WHERE id % 9 <> 0)
SELECT i.id, CASE WHEN l.path IS NULL THEN 'missing' WHEN i.status IN ('missing', 'failed') OR (i.status = 'done' AND (l.size <> i.size OR l.mtime <> i.mtime)) THEN 'pending' ELSE i.status END AS status FROM inputs i LEFT JOIN l ON l.path = i.path""")
def checked_inputs(spark, d):
    t = state(spark, d)
    listing = t["inputs"].where("id % 9 <> 0").select("path", "size", F.when(F.col("id") % 10 == 0, F.col("mtime") + 1).otherwise(F.col("mtime")).alias("mtime"))
    return S.checked_inputs(t["inputs"], listing).select("id", "status")


@query("added_inputs", f"""{CURRENT}, g AS (SELECT path, CASE WHEN id % 4 = 0 THEN '{{}}' ELSE metadata END AS metadata FROM inputs WHERE id % 2 = 0 UNION ALL SELECT concat('/new/', r_regionkey), '{{}}' FROM region)
SELECT i.path, CASE WHEN g.metadata <> i.metadata THEN 'pending' ELSE i.status END AS status, coalesce(g.metadata, i.metadata) AS metadata, i.id FROM inputs i LEFT JOIN g USING (path)
UNION ALL SELECT path, 'pending', metadata, (SELECT max(id) FROM inputs) + row_number() OVER (ORDER BY path) FROM g WHERE path NOT IN (SELECT path FROM inputs)""")
def added_inputs(spark, d):
    t = state(spark, d)
    known = t["inputs"].where("id % 2 = 0").select("path", F.when(F.col("id") % 4 == 0, "{}").otherwise(F.col("metadata")).alias("metadata"))
    new = table(spark, d, "region").select(F.concat(F.lit("/new/"), F.col("r_regionkey").cast("string")).alias("path"), F.lit("{}").alias("metadata"))
    return S.add_inputs(t["inputs"], known.unionByName(new)).select("path", "status", "metadata", "id")


@query("counted_gaps", f"""{CURRENT}, b AS (SELECT content_sha256, 'h1' AS options_hash, CAST(length(content_sha256) % 3 AS INT) AS items FROM projects)
SELECT coalesce(g.content_sha256, b.content_sha256) AS content_sha256, coalesce(b.options_hash, g.options_hash) AS options_hash, coalesce(b.items, g.items) AS items,
  CASE WHEN b.items IS NULL THEN g.builds WHEN g.options_hash = b.options_hash THEN g.builds + 1 ELSE 1 END AS builds FROM gaps g FULL JOIN b ON b.content_sha256 = g.content_sha256 WHERE b.items IS NULL OR b.items > 0""")
def counted_gaps(spark, d):
    t = state(spark, d)
    built = t["projects"].select("content_sha256", F.lit("h1").alias("options_hash"), (F.char_length("content_sha256") % 3).cast("int").alias("items"))
    return S.set_gaps(t["gaps"], built)


@query("upserted_projects", f"""{CURRENT}, r AS (SELECT sha256 AS content_sha256, 'working' AS status, 'now' AS updated FROM contents WHERE size % 2 = 0)
SELECT coalesce(p.content_sha256, r.content_sha256) AS content_sha256, coalesce(r.status, p.status) AS status, p.tool, coalesce(r.updated, p.updated) AS updated FROM projects p FULL JOIN r ON r.content_sha256 = p.content_sha256""")
def upserted_projects(spark, d):
    t = state(spark, d)
    rows = t["contents"].where("size % 2 = 0").select(F.col("sha256").alias("content_sha256"), F.lit("working").alias("status"), F.lit("now").alias("updated"))
    return S.set_projects(t["projects"], rows).select("content_sha256", "status", "tool", "updated")


@query("pruned_state", f"""{CURRENT}, gone AS (SELECT sha256 FROM contents c WHERE NOT EXISTS (SELECT 1 FROM current v WHERE v.content_sha256 = c.sha256 AND v.input_status <> 'missing'))
SELECT 'inputs' AS part, CAST(id AS VARCHAR) AS key FROM inputs WHERE status <> 'missing' UNION ALL SELECT 'contents', sha256 FROM contents WHERE sha256 NOT IN (SELECT sha256 FROM gone)
UNION ALL SELECT 'sightings', concat(content_sha256, '@', input_id, '@', input_sha256) FROM sightings s WHERE EXISTS (SELECT 1 FROM inputs i WHERE i.status <> 'missing' AND i.id = s.input_id AND i.sha256 = s.input_sha256) AND content_sha256 NOT IN (SELECT sha256 FROM gone)""")
def pruned_state(spark, d):
    t = state(spark, d)
    i, s, c = S.prune(t["inputs"], t["sightings"], t["contents"], _current(t))
    rows = [i.select(F.lit("inputs").alias("part"), F.col("id").cast("string").alias("key")), c.select(F.lit("contents").alias("part"), F.col("sha256").alias("key"))]
    rows.append(s.select(F.lit("sightings").alias("part"), F.concat("content_sha256", F.lit("@"), F.col("input_id").cast("string"), F.lit("@"), "input_sha256").alias("key")))
    return rows[0].unionByName(rows[1]).unionByName(rows[2])


@query("found_metadata", f"""{CURRENT}, kv AS (SELECT DISTINCT content_sha256, unnest(['segment', 'nation']) AS k, unnest([json_extract_string(metadata, '$.segment'), json_extract_string(metadata, '$.nation')]) AS v FROM current)
SELECT content_sha256, string_agg(CASE WHEN k = 'segment' THEN v END, ',' ORDER BY v) AS segments, string_agg(CASE WHEN k = 'nation' THEN v END, ',' ORDER BY v) AS nations, (SELECT count(*) FROM current c WHERE c.content_sha256 = kv.content_sha256) AS places FROM kv GROUP BY content_sha256""")
def found_metadata(spark, d):
    f = S.found_documents(_current(state(spark, d)))
    return f.select("content_sha256", F.array_join(F.col("metadata")["segment"], ",").alias("segments"), F.array_join(F.col("metadata")["nation"], ",").alias("nations"), F.size("sightings").cast("long").alias("places"))
