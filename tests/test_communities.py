"""Communities, groups within bounds and running sums against plain versions of the same rules."""

import random
import struct
from collections import defaultdict

import duckdb
import pytest
import xxhash

from weavemine.operators import communities as C
from weavemine.operators.ranges import running


def drawn(*xs):
    h = 42
    for x in xs:
        h = xxhash.xxh64_intdigest(struct.pack("<q", x), seed=h)
    return h - (1 << 64) if h >> 63 else h


def plain_louvain(edges, seed):
    w = defaultdict(int)
    for a, b, x in edges:
        w[min(a, b), max(a, b)] += x
    adj = defaultdict(dict)
    k = defaultdict(int)
    for (a, b), x in w.items():
        k[a] += x
        k[b] += x
        adj[a], adj[b]
        if a != b:
            adj[a][b] = adj[b][a] = x
    m2 = sum(k.values())
    home = {x: x for x in k}
    level = 0
    while True:
        group, turn = {x: x for x in k}, 0
        while True:
            sigma = defaultdict(int)
            for x in k:
                sigma[group[x]] += k[x]
            moves = []
            for x in k:
                to = defaultdict(int)
                for y, v in adj[x].items():
                    to[group[y]] += v
                a = group[x]
                for b, v in to.items():
                    score = m2 * (v - to.get(a, 0)) - k[x] * (sigma[b] - sigma[a] + k[x])
                    if b != a and score > 0:
                        moves.append((x, a, b, score))
            if not moves:
                break
            receives = lambda c: drawn(seed, level, turn, c) % 2 == 1  # noqa: B023, E731
            best = {}
            for x, a, b, score in moves:
                if receives(b) and not receives(a):
                    best[x] = max(best.get(x, (0,)), (score, drawn(b), a, b))
            ones = []
            for x, (score, _, a, b) in best.items():
                h = drawn(seed, level, turn, x)
                zeros = (h & -h).bit_length() - 1 if h else 64
                ones.append((score, x, 40 - min(zeros, 40), a, b))
            taken = {}
            for one in ones:
                score, x, slot, a, b = one
                sides = [[o for o in ones if o[j] == one[j]] for j in (3, 4)]
                ahead = sum(k[o[1]] for side in sides for o in side if o is not one and (o[2] <= slot or o is max(side)))
                if all(max(side) is one for side in sides) or score > k[x] * ahead:
                    taken[x] = b
            group.update(taken)
            turn += 1
        if all(x == g for x, g in group.items()):
            break
        home = {x: group[g] for x, g in home.items()}
        less, kk = defaultdict(lambda: defaultdict(int)), defaultdict(int)
        for x in k:
            kk[group[x]] += k[x]
            for y, v in adj[x].items():
                if group[x] != group[y]:
                    less[group[x]][group[y]] += v
        adj, k, level = defaultdict(dict, less), kk, level + 1
    least = defaultdict(list)
    for x, g in home.items():
        least[g].append(x)
    return {x: min(least[g]) for x, g in home.items()}


def quality(split, edges):
    m2 = 2 * sum(w for *_, w in edges)
    k = defaultdict(int)
    for a, b, w in edges:
        k[split[a]] += w
        k[split[b]] += w
    return sum(2 * w for a, b, w in edges if split[a] == split[b]) / m2 - sum(x * x for x in k.values()) / m2**2


def graphs():
    rnd = random.Random(6)
    cliques = [(8 * c + a, 8 * c + b, 3) for c in range(5) for a in range(6) for b in range(a)] + [(8 * c, 8 * ((c + 1) % 5), 1) for c in range(5)]
    noise = [(a, b, rnd.randrange(1, 9)) for a, b in ((rnd.randrange(30), rnd.randrange(30)) for _ in range(60))]
    return {"cliques": cliques, "noise": noise, "star": [(0, x, 1) for x in range(1, 40)] + [(40, x, 1) for x in range(41, 50)]}


@pytest.mark.parametrize("name", ["cliques", "noise", "star"])
def test_louvain_equals_the_plain_version(spark, name):
    edges = graphs()[name]
    df = spark.createDataFrame(edges, "src long, dst long, weight long")
    nodes = spark.createDataFrame([(x,) for x in range(62)] + [(None,), (3,)], "node long")
    got = dict(map(tuple, C.louvain(nodes, df, seed=3).collect()))
    want = plain_louvain(edges, 3)
    assert got == {x: want.get(x, x) for x in range(62)}
    q = quality(got, edges)
    assert q >= quality({x: x for x in range(62)}, edges) and abs(C.modularity(spark.createDataFrame([*got.items()], "node long, community long"), df).first()[0] - q) < 1e-12
    if name == "cliques":
        assert len({got[8 * c + a] for c in range(5) for a in range(6)}) == 5 and q > 0.7
    if name == "star":
        assert len({got[x] for x in range(50)}) == 2
    con = duckdb.connect()
    con.execute("create table e as select * from (values " + ",".join(map(str, edges)) + ") t(src, dst, w)")
    con.execute("create table s as select * from (values " + ",".join(map(str, got.items())) + ") t(node, c)")
    sql = """WITH j AS (SELECT a.c AS ca, b.c AS cb, w FROM e JOIN s a ON a.node = src JOIN s b ON b.node = dst),
    k AS (SELECT c, sum(w) AS k FROM (SELECT ca AS c, w FROM j UNION ALL SELECT cb, w FROM j) GROUP BY c)
    SELECT (SELECT sum(2 * w) FILTER (ca = cb) / sum(2 * w) FROM j) - sum(k * k) / (sum(k) * sum(k)) FROM k"""
    assert abs(con.execute(sql).fetchone()[0] - q) < 1e-9


def test_parts_are_graphs_of_their_own(spark):
    edges = graphs()["cliques"]
    df = spark.createDataFrame([(*e, 0) for e in edges] + [(a + 100, b + 100, w, 1) for a, b, w in edges], "src long, dst long, weight long, part int")
    got = dict(map(tuple, C.louvain(spark.createDataFrame([], "node long"), df, seed=3).collect()))
    assert {x: g for x, g in got.items() if x < 100} == plain_louvain(edges, 3)
    none = spark.createDataFrame([(1, None, 4), (2, 3, None), (5, 5, 2)], "src long, dst long, weight long")
    assert sorted(map(tuple, C.louvain(spark.createDataFrame([(1,), (2,)], "node long"), none).collect())) == [(1, 1), (2, 2), (5, 5)]


def plain_merge(split, edges, most, least, largest):
    split = dict(split)
    while True:
        size = defaultdict(int)
        for g in split.values():
            size[g] += 1
        order = sorted(size, key=lambda g: (size[g], g))
        over = max(0, len(size) - most) if most is not None else 0
        due = {g for g in size if size[g] < least} | set(order[:over])
        if len(size) < 2 or not due:
            return split
        w = defaultdict(lambda: defaultdict(int))
        for a, b, x in edges:
            a, b = split[a], split[b]
            if a != b:
                w[a][b] += x
                w[b][a] += x
        asks = {}
        for g in due:
            near = sorted(w[g], key=lambda b: (largest is not None and size[g] + size[b] > largest, -w[g][b], b))
            asks[g] = near[0] if near else next(b for b in order if b != g)
        turn = lambda g: (size[g], g)  # noqa: B023, E731
        stays = lambda g: g not in due or any(b == g and turn(a) < turn(g) for a, b in asks.items())  # noqa: B023, E731
        taken, room = {}, defaultdict(int)
        for g in sorted((g for g in due if not stays(g) and stays(asks[g])), key=turn):
            b = asks[g]
            if largest is None or not room[b] or size[b] + room[b] + size[g] <= largest:
                taken[g] = b
            room[b] += size[g]
        split = {x: taken.get(g, g) for x, g in split.items()}


@pytest.mark.parametrize("most,least,largest", [(4, 1, None), (None, 5, 12)])
def test_merged_down_equals_the_plain_version(spark, most, least, largest):
    edges = graphs()["noise"]
    split = {x: x // 2 if x < 20 else x for x in range(34)}
    df = spark.createDataFrame([*split.items()], "node long, group long")
    got = dict(map(tuple, C.merged_down(df, spark.createDataFrame(edges, "src long, dst long, weight long"), most, least, largest).collect()))
    assert got == plain_merge(split, edges, most, least, largest)
    sizes = [list(got.values()).count(g) for g in set(got.values())]
    assert (most is None or len(sizes) <= most) and min(sizes) >= least and len(got) == 34
    named = C.numbered(spark.createDataFrame([*got.items()], "node long, group long"))
    assert [list(dict(map(tuple, named.collect())).values()).count(k) for k in range(len(sizes))] == sorted(sizes, reverse=True)


def test_running_sums(spark):
    rnd = random.Random(1)
    rows = [(rnd.choice("ab") if i % 7 else None, rnd.randrange(9), i, rnd.choice([1, 2, None])) for i in range(400)]
    df = spark.createDataFrame(rows, "g string, o int, id int, v int")
    got = {r.id: (r.before, r.whole) for r in running(df, ["o", "id"], "v", ["g"], total="whole").collect()}
    for g, o, i, _ in rows:
        own = [x for x in rows if x[0] == g]
        assert got[i] == (sum(x[3] or 0 for x in own if x[1:3] < (o, i)), sum(x[3] or 0 for x in own))
    assert running(df.limit(0), ["o"]).count() == 0
