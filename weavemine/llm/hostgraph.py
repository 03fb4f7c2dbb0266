"""Operator 4: URL filters by rules and link-graph propagation.

A url is judged by the longest rule that fits it; where none fits, by its host.
Hosts are nodes; a link from a page of one host to another host is an edge, and
links within a host (or, for a host without links, the host itself) are a loop
that keeps its mass in place. A link without an authority (a path, a query, a
fragment) is within its page's host; one of a scheme without an authority, such
as ``mailto:``, ``javascript:`` or ``data:``, leads to no host. Trust starts at hosts in proportion to their
pages that a rule allows and follows links forward (personalised PageRank);
distrust starts where rules block pages and follows links backward, to those
who link there. A host is blocked if distrust is more than ``THRESHOLD`` of
distrust, trust and the share of its pages that no rule judged.

Everything is DataFrame functions: links are taken from the html by one regular
expression, pre-aggregated to host pairs before they are shuffled, and a round
of propagation is one join and one aggregation of host pairs. Rounds go on
until ``UNROLL`` of them together move less than ``TOLERANCE`` of all seeds; every
``UNROLL`` are written to the shared folder. Scores that do not settle are an
error.

Defined results: null url or one without ``://``: empty host and path; no rule
fits an empty host, and the empty host takes part as a host of its own; null
html has no links; null or repeated page ids are judged row by row; an empty
table gives no rows. Columns other than the three read are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from weavemine.session import materialize, release, table

NAME = "op4_url_trust"
#: (verdict, host, path)
RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)
DAMPING, THRESHOLD, TOLERANCE, ROUNDS, UNROLL = 0.85, 0.5, 1e-12, 1000, 5
LINK = r"""(?i)href\s*=\s*["']?\s*(?:[a-z][a-z0-9+.-]*:)?//([^/?#"'\s>]*)"""
#: A reference with neither a scheme nor an authority; possessive, so that the look-ahead stands at its first character.
LOCAL = r"""(?i)href\s*+=\s*+["']?+\s*+(?!//|[a-z][a-z0-9+.-]*:)"""
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    return F.coalesce(F.translate(F.regexp_extract(url, r"://([^/?#]*)", 1), UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"://[^/?#]*([^?#]*)", 1), F.lit(""))


def fitting_rule(host: Column, path: Column, rules: Sequence[tuple[str, str, str]] = RULES) -> Column:
    """struct(rule, verdict) of the longest rule that fits, else null; the first of equally long ones."""
    out = None
    for verdict, h, p in sorted(rules, key=lambda r: -len(r[1] + r[2])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        hit = F.struct(F.lit(h + p).alias("rule"), F.lit(verdict).alias("verdict"))
        out = F.when(fits, hit) if out is None else out.when(fits, hit)
    return out if out is not None else F.lit(None).cast("struct<rule:string,verdict:string>")


def host_edges(pages: DataFrame) -> DataFrame:
    """(src, dst, n): links between hosts; n counts links, loops included."""
    src = host_of(F.col("url"))
    far = F.transform(F.regexp_extract_all("html", F.lit(LINK), 1), lambda x: F.struct(F.translate(x, UPPER, LOWER).alias("dst"), F.lit(1).alias("n")))
    near = F.array(F.struct(src.alias("dst"), F.regexp_count("html", F.lit(LOCAL)).alias("n")))
    linked = pages.where("html IS NOT NULL").select(src.alias("src"), F.explode(F.concat(far, near)).alias("x"))
    return linked.where("x.n > 0").groupBy("src", "x.dst").agg(F.sum("x.n").alias("n"))


def host_seeds(judged: DataFrame) -> DataFrame:
    """(host, trust, distrust, open): shares of all pages that rules allow, block and leave open."""
    n = judged.groupBy("host").agg(
        F.count(F.when(F.col("hit.verdict") == "allow", 1)).alias("a"), F.count(F.when(F.col("hit.verdict") == "block", 1)).alias("b"), F.count("*").alias("n")
    )
    return n.select("host", F.col("a").alias("trust"), F.col("b").alias("distrust"), (F.col("n") - F.col("a") - F.col("b")).alias("open"))


def propagate(seeds: DataFrame, edges: DataFrame, damping: float = DAMPING) -> DataFrame:
    """(host, trust, distrust, open) after propagation. Scores count pages, so they compare with ``open``."""
    nodes = seeds.select("host").unionByName(edges.select(F.col("dst").alias("host"))).distinct()
    lone = nodes.join(edges.select(F.col("src").alias("host")).distinct(), "host", "left_anti")
    loops = lone.select(F.col("host").alias("src"), F.col("host").alias("dst"), F.lit(1).cast("long").alias("n"))
    e = materialize(edges.unionByName(loops), "host-edges")
    out, into = e.groupBy("src").agg(F.sum("n").alias("all")), e.groupBy("dst").agg(F.sum("n").alias("all"))
    forward = e.join(out, "src").select(F.col("src").alias("host"), F.col("dst").alias("to"), F.lit(0).alias("kind"), (F.col("n") / F.col("all")).alias("w"))
    backward = e.join(into, "dst").select(F.col("dst").alias("host"), F.col("src").alias("to"), F.lit(1).alias("kind"), (F.col("n") / F.col("all")).alias("w"))
    ways = materialize(forward.unionByName(backward), "host-ways")
    base = nodes.join(seeds, "host", "left").select(
        "host", F.explode(F.array(*[F.struct(F.lit(k).alias("kind"), F.coalesce(c, F.lit(0)).cast("double").alias("base")) for k, c in enumerate(("trust", "distrust"))])).alias("x")
    )
    base = materialize(base.select("host", "x.kind", "x.base"), "host-base")
    mass = base.agg(F.sum("base")).first()[0] or 0.0
    state = base.withColumn("score", F.col("base"))
    for _ in range(ROUNDS // UNROLL):
        was = state
        for _ in range(UNROLL):
            sent = ways.join(state.select("host", "kind", "score"), ["host", "kind"])
            got = sent.groupBy(F.col("to").alias("host"), "kind").agg(F.sum(F.col("w") * F.col("score")).alias("got"))
            state = base.join(got, ["host", "kind"], "left").select(
                "host", "kind", "base", ((1 - damping) * F.col("base") + damping * F.coalesce("got", F.lit(0.0))).alias("score")
            )
        state = materialize(state, "host-state")
        moved = state.alias("a").join(was.alias("b"), ["host", "kind"]).agg(F.sum(F.abs(F.col("a.score") - F.col("b.score")))).first()[0]
        release(was)
        if not moved or moved <= TOLERANCE * mass:
            break
    else:
        raise RuntimeError("host scores did not settle")
    wide = state.groupBy("host").agg(
        F.sum(F.when(F.col("kind") == 0, F.col("score"))).alias("trust"), F.sum(F.when(F.col("kind") == 1, F.col("score"))).alias("distrust")
    )
    return wide.join(seeds.select("host", "open"), "host", "left").withColumn("open", F.coalesce("open", F.lit(0)))


def host_verdicts(pages: DataFrame, rules=RULES, damping: float = DAMPING, threshold: float = THRESHOLD) -> DataFrame:
    """(host, trust, distrust, open, verdict) of every host seen."""
    host, path = host_of(F.col("url")), path_of(F.col("url"))
    seeds = materialize(host_seeds(pages.select(host.alias("host"), fitting_rule(host, path, rules).alias("hit"))), "host-seeds")
    scores = propagate(seeds, materialize(host_edges(pages), "host-links"), damping)
    all_ = F.col("distrust") + F.col("trust") + F.col("open")
    return scores.withColumn("verdict", F.when(F.round(F.col("distrust") - threshold * all_, 9) > 0, "block").otherwise("allow"))


def judge(pages: DataFrame, rules=RULES, damping: float = DAMPING, threshold: float = THRESHOLD) -> DataFrame:
    """(page_id, host, path, rule, verdict) for every row."""
    hosts = materialize(host_verdicts(pages, rules, damping, threshold).select(F.col("host").alias("_host"), F.col("verdict").alias("_verdict")), "host-verdicts")
    host, path = host_of(F.col("url")), path_of(F.col("url"))
    read = pages.select("page_id", host.alias("host"), path.alias("path")).withColumn("hit", fitting_rule(F.col("host"), F.col("path"), rules))
    ruled = read.where("hit IS NOT NULL").select("page_id", "host", "path", "hit.rule", "hit.verdict")
    rest = read.where("hit IS NULL").join(hosts, F.col("host") == F.col("_host"), "left")
    return ruled.unionByName(rest.select("page_id", "host", "path", F.col("hit.rule").alias("rule"), F.coalesce("_verdict", F.lit("allow")).alias("verdict")))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "pages"))


#: What is left unsettled after so many rounds is under 1e-8 of the seeds.
SQL_ROUNDS = 120


def _sql() -> str:
    fits = lambda h, p: f"((host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}'))"
    longest = sorted(RULES, key=lambda r: -len(r[1] + r[2]))
    rule = "CASE " + " ".join(f"WHEN {fits(h, p)} THEN '{h}{p}'" for _, h, p in longest) + " END"
    verdict = "CASE " + " ".join(f"WHEN {fits(h, p)} THEN '{v}'" for v, h, p in longest) + " END"
    lower = f"translate({{}}, '{UPPER}', '{LOWER}')"
    link = LINK.replace("'", "''")
    reference = r"""(?i)href\s*=\s*["']?\s*([^"'\s>]*)""".replace("'", "''")
    rounds = ""
    for k in range(1, SQL_ROUNDS + 1):
        rounds += f""",
r{k} AS MATERIALIZED (SELECT n.host, 0.15 * n.trust + 0.85 * coalesce(f.got, 0) AS t, 0.15 * n.distrust + 0.85 * coalesce(b.got, 0) AS d FROM nodes n
  LEFT JOIN (SELECT dst AS host, sum(w_out * t) AS got FROM w JOIN r{k - 1} r ON r.host = w.src GROUP BY dst) f ON f.host = n.host
  LEFT JOIN (SELECT src AS host, sum(w_in * d) AS got FROM w JOIN r{k - 1} r ON r.host = w.dst GROUP BY src) b ON b.host = n.host)"""
    return f"""
WITH u AS (SELECT page_id, html, coalesce({lower.format("regexp_extract(url, '://([^/?#]*)', 1)")}, '') AS host, coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') AS path FROM pages),
j AS (SELECT *, {rule} AS rule, {verdict} AS said FROM u),
seeds AS (SELECT host, count(*) FILTER (said = 'allow') AS trust, count(*) FILTER (said = 'block') AS distrust, count(*) FILTER (said IS NULL) AS open FROM j GROUP BY host),
links AS (SELECT host AS src, {lower.format("unnest(regexp_extract_all(html, '" + link + "', 1))")} AS dst FROM u),
local AS (SELECT host AS src, unnest(regexp_extract_all(html, '{reference}', 1)) AS x FROM u),
e0 AS (SELECT src, dst, count(*) AS n FROM (SELECT src, dst FROM links UNION ALL SELECT src, src FROM local WHERE NOT regexp_matches(x, '(?i)^(//|[a-z][a-z0-9+.-]*:)')) GROUP BY src, dst),
nodes AS (SELECT h.host, coalesce(trust, 0)::DOUBLE AS trust, coalesce(distrust, 0)::DOUBLE AS distrust, coalesce(open, 0)::DOUBLE AS open
  FROM (SELECT host FROM seeds UNION SELECT dst FROM e0) h LEFT JOIN seeds s ON s.host = h.host),
e AS (SELECT * FROM e0 UNION ALL SELECT host, host, 1 FROM nodes WHERE host NOT IN (SELECT src FROM e0)),
w AS (SELECT src, dst, n::DOUBLE / sum(n) OVER (PARTITION BY src) AS w_out, n::DOUBLE / sum(n) OVER (PARTITION BY dst) AS w_in FROM e),
r0 AS (SELECT host, trust AS t, distrust AS d FROM nodes){rounds},
hosts AS (SELECT r.host, CASE WHEN round(r.d - 0.5 * (r.d + r.t + n.open), 9) > 0 THEN 'block' ELSE 'allow' END AS v FROM r{SQL_ROUNDS} r JOIN nodes n ON n.host = r.host)
SELECT page_id, j.host, path, rule, coalesce(said, v) AS verdict FROM j LEFT JOIN hosts ON hosts.host = j.host
"""


SQL = _sql()
