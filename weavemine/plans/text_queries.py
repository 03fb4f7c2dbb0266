"""Registered queries over texts, paths, dates and ids."""

from __future__ import annotations

from pyspark.sql import functions as F

from weavemine.functions import origins as O
from weavemine.functions import text as T
from weavemine.operators import versions as V
from weavemine.plans.registry import query
from weavemine.session import table

ONE = "trim(regexp_replace(coalesce(text, ''), '[\\s\\x0B]+', ' ', 'g'))"


def _clip(x: str, n: int) -> str:
    head = f"substring({x}, 1, {n - 1})"
    return f"CASE WHEN length({x}) <= {n} THEN {x} ELSE rtrim(CASE WHEN contains({head}, ' ') THEN regexp_replace({head}, ' [^ ]*$', '') ELSE {head} END) || '…' END"


@query(
    "text_forms",
    f"""WITH t AS (SELECT doc_id, source, n_chars, coalesce(text, '') AS text, {ONE} AS l FROM documents),
s AS (SELECT *, CASE WHEN regexp_extract(l, '^(.*?[.!?])\\s', 1) <> '' THEN regexp_extract(l, '^(.*?[.!?])\\s', 1) ELSE l END AS f FROM t)
SELECT doc_id, {_clip('l', 80)} AS clipped, {_clip('f', 60)} AS sentence,
  substring(CASE WHEN regexp_replace(regexp_replace(l, '[^A-Za-z0-9._-]+', '_', 'g'), '^[._]+|[._]+$', '', 'g') = '' THEN 'unnamed' ELSE regexp_replace(regexp_replace(l, '[^A-Za-z0-9._-]+', '_', 'g'), '^[._]+|[._]+$', '', 'g') END, 1, 40) AS slug,
  regexp_replace(regexp_replace(lower(coalesce(source, '')), '[^a-z0-9-]+', '-', 'g'), '^-+|-+$', '', 'g') AS anchor,
  format('{{:,}}', n_chars) || ' character' || CASE WHEN n_chars = 1 THEN '' ELSE 's' END AS size,
  md5(trim(regexp_replace(lower(text), '[^a-z0-9]+', ' ', 'g'))) AS letters,
  CASE WHEN length(text) <= 50 THEN text ELSE substring(text, 1, 49) || '…' END AS cell FROM s""",
)
def text_forms(spark, d):
    x = F.coalesce("text", F.lit(""))
    return table(spark, d, "documents").select(
        "doc_id", T.clip(x, 80).alias("clipped"), T.first_sentence(x, 60).alias("sentence"), T.slug(x, 40).alias("slug"), T.anchor(F.coalesce("source", F.lit(""))).alias("anchor"),
        T.plural(F.col("n_chars"), "character").alias("size"), F.md5(T.alphanumeric(x)).alias("letters"), T.cell(x, 50).alias("cell"),
    )


@query(
    "mention_snippets",
    f"""WITH t AS (SELECT doc_id, {ONE} AS l FROM documents), p AS (SELECT doc_id, l, position('tion' IN l) AS f FROM t),
q AS (SELECT *, greatest(f - 1, 0) AS i FROM p), r AS (SELECT *, greatest(i - 90, 0) AS a, least(length(l), i + 4 + CASE WHEN f > 0 THEN 90 ELSE 180 END) AS b FROM q),
u AS (SELECT *, substring(l, a + 1, i - a) AS before, substring(l, i + 5, greatest(b - i - 4, 0)) AS after FROM r),
v AS (SELECT *, a + CASE WHEN a > 0 THEN position(' ' IN before) ELSE 0 END AS a2, CASE WHEN b < length(l) AND position(' ' IN reverse(after)) > 0 THEN i + 4 + length(after) - position(' ' IN reverse(after)) ELSE b END AS z FROM u)
SELECT doc_id, CASE WHEN a2 > 0 THEN '…' ELSE '' END || trim(substring(l, a2 + 1, z - a2)) || CASE WHEN z < length(l) THEN '…' ELSE '' END AS snippet FROM v""",
)
def mention_snippets(spark, d):
    return table(spark, d, "documents").select("doc_id", T.mention_snippet(F.coalesce("text", F.lit("")), F.lit("tion")).alias("snippet"))


PATH = "string_split(trim(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '/'), '/')"


@query(
    "path_places",
    f"""WITH p AS (SELECT page_id, array_to_string({PATH}, '::') AS a, {PATH} AS xs FROM pages), q AS (SELECT p.page_id, p.a, p.xs, n.a AS b, n.xs AS ys FROM p JOIN p n ON n.page_id = p.page_id + 1),
r AS (SELECT *, CASE WHEN a = '' OR b = '' THEN 0 ELSE len(list_filter(range(1, least(len(xs), len(ys)) + 1), lambda i: xs[1:i] = ys[1:i])) END AS n FROM q)
SELECT page_id, CAST(n AS INTEGER) AS shared, CASE WHEN a = '' THEN '(the root)' ELSE CASE WHEN n > 1 THEN '…::' ELSE '' END || array_to_string(xs[greatest(n, 1):], '::') END AS here,
  CASE WHEN b = '' THEN '(the root)' ELSE CASE WHEN n > 1 THEN '…::' ELSE '' END || array_to_string(ys[greatest(n, 1):], '::') END AS there,
  CASE WHEN a <> '' THEN 'in ' || array_to_string(xs[greatest(len(xs) - 2, 1):], '::') || ' ' ELSE '' END || '(project p' || page_id || ')' AS location,
  CASE WHEN a <> '' THEN xs[1] END AS package_1, CASE WHEN a <> '' THEN xs[2] END AS package_2, CASE WHEN a <> '' THEN xs[3] END AS package_3 FROM r""",
)
def path_places(spark, d):
    path = F.regexp_replace(F.regexp_replace(F.regexp_extract("url", r"://[^/?#]*([^?#]*)", 1), "^/+|/+$", ""), "/", "::")
    p = table(spark, d, "pages").select("page_id", path.alias("a"))
    q = p.join(p.select((F.col("page_id") - 1).alias("page_id"), F.col("a").alias("b")), "page_id")
    parted = T.parted_paths(F.col("a"), F.col("b"))
    shared = F.when((F.col("a") == "") | (F.col("b") == ""), 0).otherwise(T.shared_levels(F.col("a"), F.col("b")))
    return q.select("page_id", shared.alias("shared"), parted["here"].alias("here"), parted["there"].alias("there"), T.location(F.col("a"), F.concat(F.lit("p"), F.col("page_id").cast("string"))).alias("location"), *T.package_levels(F.col("a")))


@query(
    "java_dates",
    """WITH e AS (SELECT event_id, ts, ['UTC', 'PST', 'IST', 'XYZ'][event_id % 4 + 1] AS z, ['+00:00', '-08:00', '+05:30', ''][event_id % 4 + 1] AS o, [0, -480, 330, 0][event_id % 4 + 1] AS m FROM events)
SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S') || o AS iso, strftime(ts, '%a %b %d %H:%M:%S ') || z || strftime(ts, ' %Y') AS raw,
  strftime(date_trunc('second', ts) - to_minutes(CAST(m AS BIGINT)), '%Y-%m-%dT%H:%M:%S') AS utc, CAST(CAST(ts AS DATE) AS VARCHAR) AS day FROM e""",
)
def java_dates(spark, d):
    zone = F.element_at(F.array(*map(F.lit, ("UTC", "PST", "IST", "XYZ"))), (F.col("event_id") % 4 + 1).cast("int"))
    head = F.concat(F.lit("# comment\n#"), F.date_format("ts", "EEE MMM dd HH:mm:ss "), zone, F.date_format("ts", " yyyy"), F.lit("\nkey=value"))
    e = table(spark, d, "events").select("event_id", O.java_date(head).alias("j"), F.unix_date(F.to_date("ts")).alias("n"))
    return e.select("event_id", "j.iso", "j.raw", O.utc_text(F.col("j.iso")).alias("utc"), O.iso_day(F.col("n")).alias("day"))


XID = "'_19_0_' || CASE WHEN event_id % 3 = 0 THEN '3_' ELSE '' END || substring(md5(CAST(user_id AS VARCHAR)), 1, 6) || '_' || (epoch_us(ts) // 1000) || '_' || event_id || '_' || user_id"


@query(
    "id_makers",
    f"""WITH e AS (SELECT event_id, CASE event_id % 5 WHEN 4 THEN 'eee_' || (epoch_us(ts) // 1000) || '_1_2' WHEN 3 THEN 'plain_' || event_id ELSE {XID} END AS x FROM events),
p AS (SELECT event_id, x, regexp_extract(x, '^_*(?:\\d+x?_)*([0-9a-f]{{4,8}})_(\\d{{12,13}})_\\d+_\\d+$', ['maker', 'ms']) AS m, regexp_extract(x, '^[^_]*_(\\d{{12,13}})_\\d+_\\d+$', 1) AS old FROM e)
SELECT event_id, nullif(m.maker, '') AS maker, CAST(coalesce(nullif(m.ms, ''), nullif(old, '')) AS BIGINT) AS ms, 'sha256:' || substring(md5(x), 1, 16) || '!model.xmi#' || x || '@L' || (event_id + 1) AS locator FROM p""",
)
def id_makers(spark, d):
    ms = F.expr("timestampdiff(MILLISECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', ts)").cast("string")
    key, user = F.col("event_id").cast("string"), F.col("user_id").cast("string")
    made = F.concat(F.lit("_19_0_"), F.when(F.col("event_id") % 3 == 0, "3_").otherwise(""), F.substring(F.md5(user), 1, 6), F.lit("_"), ms, F.lit("_"), key, F.lit("_"), user)
    x = F.when(F.col("event_id") % 5 == 4, F.concat(F.lit("eee_"), ms, F.lit("_1_2"))).when(F.col("event_id") % 5 == 3, F.concat(F.lit("plain_"), key)).otherwise(made)
    e = table(spark, d, "events").select("event_id", x.alias("x")).withColumn("m", O.id_marks(F.col("x")))
    return e.select("event_id", "m.maker", "m.ms", O.locator(F.md5("x"), F.lit("model.xmi"), F.col("x"), F.col("event_id") + 1).alias("locator"))


@query(
    "project_labels",
    """WITH p AS (SELECT p_partkey, regexp_replace(p_name || '-' || p_type || '.v' || p_size, '\\.(mdzip)$', '', 'i') AS stem, md5(p_name) AS sha FROM part), q AS (SELECT *, substring(stem, 1, 32) AS h FROM p),
r AS (SELECT *, length(regexp_extract(h, '^(.*)[ _.-]', 1)) AS lastsep, regexp_matches(h, '[ _.-]') AS sep FROM q)
SELECT p_partkey, CASE WHEN length(stem) > 32 THEN regexp_replace(CASE WHEN sep AND lastsep > 16 THEN substring(h, 1, lastsep) ELSE h END, '[ _.-]+$', '') || '…' ELSE stem END || ' [' || substring(sha, 1, 8) || ']' AS label,
  substring(sha, 1, 8) || ':' || substring(md5(CAST(p_partkey AS VARCHAR)), 1, 12) AS chunk_ref FROM r""",
)
def project_labels(spark, d):
    name = F.concat("p_name", F.lit("-"), "p_type", F.lit(".v"), F.col("p_size").cast("string"), F.lit(".mdzip"))
    sha = F.md5("p_name")
    return table(spark, d, "part").select("p_partkey", O.project_label(name, F.concat(F.lit("sha256:"), sha)).alias("label"), O.chunk_ref(sha, F.md5(F.col("p_partkey").cast("string"))).alias("chunk_ref"))


@query(
    "list_changes",
    """WITH w AS (SELECT conv_id, turn, role, string_split(lower(coalesce(text, '')), ' ') AS ws FROM conversations), p AS (SELECT a.conv_id, a.turn, a.ws AS x, b.ws AS y FROM w a JOIN w b ON b.conv_id = a.conv_id AND b.turn = a.turn + 1),
c AS (SELECT conv_id, turn, list_sort(list_distinct(x)) AS dx, list_sort(list_distinct(y)) AS dy, x, y FROM p)
SELECT conv_id, turn, array_to_string(flatten(list_transform(dx, lambda v: list_transform(range(0, greatest(len(list_filter(x, lambda u: u = v)) - len(list_filter(y, lambda u: u = v)), 0)), lambda k: v))), ',') AS plus,
  array_to_string(flatten(list_transform(dy, lambda v: list_transform(range(0, greatest(len(list_filter(y, lambda u: u = v)) - len(list_filter(x, lambda u: u = v)), 0)), lambda k: v))), ',') AS minus FROM c""",
)
def list_changes(spark, d):
    w = table(spark, d, "conversations").select("conv_id", "turn", F.split(F.lower(F.coalesce("text", F.lit(""))), " ").alias("x"))
    p = w.join(w.select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("x").alias("y")), ["conv_id", "turn"])
    c = V.list_differences(p, ["conv_id", "turn"], "x", "y")
    return c.select("conv_id", "turn", F.array_join("plus", ",").alias("plus"), F.array_join("minus", ",").alias("minus"))
