import random
import re
from collections import Counter

from weavemine.llm import hostgraph as H


def parse(url):
    m = re.search(r"://([^/?#]*)([^?#]*)", url or "")
    low = lambda s: "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in s)
    return (low(m[1]), m[2]) if m else ("", "")


def rule_of(host, path):
    best = None
    for v, h, p in H.RULES:
        if (host == h or host.endswith("." + h)) and path.startswith(p) and (best is None or len(h + p) > len(best[0])):
            best = (h + p, v)
    return best or (None, None)


def brute(rows):
    read = [(i, *parse(u), *rule_of(*parse(u)), h) for i, u, h in rows]
    edges = Counter()
    for _, host, _, _, _, html in read:
        for x in re.findall(H.LINK, html or ""):
            edges[host, parse("x://" + x)[0]] += 1
    hosts = {r[1] for r in read} | {d for _, d in edges}
    for h in hosts - {s for s, _ in edges}:
        edges[h, h] = 1
    t0, d0, op = Counter(), Counter(), Counter()
    for _, host, _, _, v, _ in read:
        (t0 if v == "allow" else d0 if v == "block" else op)[host] += 1
    out, into = Counter(), Counter()
    for (s, d), n in edges.items():
        out[s] += n
        into[d] += n
    t, b = {h: t0[h] for h in hosts}, {h: d0[h] for h in hosts}
    for _ in range(300):
        nt, nb = {h: 0.15 * t0[h] for h in hosts}, {h: 0.15 * d0[h] for h in hosts}
        for (s, d), n in edges.items():
            nt[d] += 0.85 * t[s] * n / out[s]
            nb[s] += 0.85 * b[d] * n / into[d]
        t, b = nt, nb
    verdict = {h: "block" if b[h] - 0.5 * (b[h] + t[h] + op[h]) > 1e-9 else "allow" for h in hosts}
    return sorted(((i, h, p, r, v or verdict[h]) for i, h, p, r, v, _ in read), key=str)


def rows():
    rnd = random.Random(4)
    names = [f"{s}{k}.example.{t}" for k in range(8) for s in ("a", "m.b", "WWW.c") for t in ("net", "org", "com")]
    out = []
    for i in range(300):
        host = rnd.choice(names)
        links = "".join(f'<A HREF="{rnd.choice(["http://", "//", "HTTPS://"])}{rnd.choice(names)}/x">' for _ in range(rnd.randrange(4)))
        out.append((i, f"http://{host}/{rnd.choice(['en', 'es', 'fr', 'de'])}/{i}?q=://x/#f", links + '<a href="/self">'))
    bad = "http://spam.example.org"
    out += [(1000 + k, f"{bad}/p{k}", "<a href='http://a1.example.net/es/'>" * 5) for k in range(3)]
    out += [(2000 + k, f"http://only.example.net/es/{k}", None) for k in range(6)] + [(2010, "http://only.example.net/de/", "")]
    return out + [(None, None, None), (3000, "no scheme", "<a href=//lone.org>"), (3001, "x://", ""), (3002, "a://b://c/en/", ""), (3003, "http://COM", ""), (3004, "http://com/", ""), (5, out[5][1], out[5][2])]


def test_query_matches_brute_force(spark, tmp_path):
    df = spark.createDataFrame([(*r, "x") for r in rows()], "page_id long, url string, html string, host string")
    df.write.parquet(f"{tmp_path}/pages.parquet")
    want = brute(rows())
    assert sorted((tuple(r) for r in H.query(spark, str(tmp_path)).collect()), key=str) == want
    got = {w[0]: w for w in want}
    assert got[2010][3:] == (None, "block") and got[3003][3] is None and got[3004][3] == "com/"


def test_distrust_flows_back_along_links(spark):
    pages = [(k, f"http://bad.net/es/{k}", "") for k in range(20)] + [(100, "http://farm.org/", "<a href='http://bad.net/'>"), (101, "http://calm.org/", "")]
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    v = {r.host: r.verdict for r in H.host_verdicts(df).collect()}
    assert v == {"bad.net": "block", "farm.org": "block", "calm.org": "allow"}


def test_links_without_an_authority_stay_within_the_host(spark):
    near = """<a href="/x"><a HREF = '?p=2'><a href=a.html><a href="#top"><a href=" b:c/"><a href="mailto:a@b.c"><a href='javascript:x'><a href="data:,"><a href = " //far.org/"><a href="http://FAR.org">"""
    df = spark.createDataFrame([(1, "http://one.org/", near), (2, "http://one.org/", "<a href='/y'>"), (3, "http://two.org/", None)], "page_id long, url string, html string")
    assert sorted(tuple(r) for r in H.host_edges(df).collect()) == [("one.org", "far.org", 2), ("one.org", "one.org", 5)]


def test_a_host_of_inner_links_keeps_its_distrust_off_others(spark):
    inner = "<a href='/z'>" * 99
    pages = [(k, f"http://bad.net/es/{k}", inner) for k in range(20)] + [(100, "http://fan.org/", inner + "<a href='http://bad.net/'>")]
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    assert {r.host: r.verdict for r in H.host_verdicts(df).collect()} == {"bad.net": "block", "fan.org": "allow"}


def test_rounds_go_on_until_scores_settle(spark):
    seeds = spark.createDataFrame([("a.org", 1_000_000, 0, 0), ("b.org", 0, 0, 0)], "host string, trust long, distrust long, open long")
    edges = spark.createDataFrame([("a.org", "b.org", 1), ("b.org", "a.org", 1)], "src string, dst string, n long")
    trust = {r.host: r.trust for r in H.propagate(seeds, edges).collect()}
    a = 150_000 / (1 - 0.85**2)
    assert abs(trust["a.org"] - a) < 1e-4 and abs(trust["b.org"] - 0.85 * a) < 1e-4


def test_empty_table(spark, tmp_path):
    spark.createDataFrame([], "page_id long, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    assert H.query(spark, str(tmp_path)).count() == 0
