"""Which windows of text answer a question, by construction: grades by rule, parts covered, panels and tasks for judges."""

from __future__ import annotations

import random
from collections.abc import Mapping, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weavemine.functions import text as T
from weavemine.functions.prose import spans_text
from weavemine.operators.ranges import running

RULES = ("source", "parts", "fact", "element")
QUESTION = (
    "id string, question string, rule string, answers array<string>, related array<string>, evidence array<array<string>>, "
    "by_element map<string,array<array<string>>>, groups array<array<array<string>>>, prefix string, quote string, sources array<string>, source_element string"
)


def question_rows(questions: DataFrame) -> DataFrame:
    """Questions with their rule inferred from what they hold where none is stated, and a ``problem`` where they lack what it grades by."""
    has = lambda c: F.coalesce(F.size(F.col(c)), F.lit(0)) > 0
    empty = F.coalesce("prefix", F.lit("")) == ""
    inferred = F.when(has("sources"), "source").when(has("groups"), "parts").when(~empty, "fact").otherwise("element")
    q = questions.withColumn("rule", F.coalesce(F.nullif("rule", F.lit("")), inferred))
    lacks = (
        F.when(F.col("rule") == "source", ~has("sources"))
        .when(F.col("rule") == "parts", ~has("groups") | F.exists(F.coalesce("groups", F.array().cast("array<array<array<string>>>")), lambda g: F.size(g) == 0))
        .when(F.col("rule") == "fact", empty | ~(has("evidence") | (F.coalesce(F.size("by_element"), F.lit(0)) > 0)))
        .when(F.col("rule") == "element", ~has("answers"))
    )
    problem = F.when(~F.col("rule").isin(*RULES), "rule unknown").when(lacks, "lacks what it grades by")
    flat = lambda c: F.transform(F.col(c), lambda alt: F.transform(alt, T.flatten_for_phrases))
    q = q.withColumns({"problem": problem, "evidence": flat("evidence"), "quote": T.alphanumeric(F.coalesce("quote", F.lit("")))})
    q = q.withColumn("groups", F.transform("groups", lambda g: F.transform(g, lambda alt: F.transform(alt, T.flatten_for_phrases))))
    return q.withColumn("by_element", F.transform_values("by_element", lambda _, v: F.transform(v, lambda alt: F.transform(alt, T.flatten_for_phrases))))


def window_rows(windows: DataFrame) -> DataFrame:
    """Windows (id, text, element_id, kind) with their chunk and their text flattened once."""
    return windows.withColumns({"chunk": F.regexp_replace("id", "#w.*$", ""), "flat": T.flatten_for_phrases(F.col("text"))})


def grades(questions: DataFrame, windows: DataFrame, judged: DataFrame | None = None) -> DataFrame:
    """(question, window, grade): 2 answers, 1 relates; a panel's grades (question, window, grade) override, 0 removes.

    The questions are a stated set of bounded size, compared with all windows:
    those ruled by source or element by equi-joins, those ruled by phrases in one pass.
    """
    q, w = question_rows(questions).where("problem IS NULL"), window_rows(windows)
    none = F.array().cast("array<string>")
    # source: the source chunks' windows, or the source element's where the corpus has none of these chunks
    s = q.where("rule = 'source'").select(F.col("id").alias("question"), "quote", "source_element", F.explode(F.array_distinct("sources")).alias("chunk"))
    by_chunk = s.join(w, "chunk").select("question", "quote", F.col("id").alias("window"), "flat")
    lost = s.select("question", "quote", F.col("source_element").alias("element_id")).distinct().join(by_chunk.select("question").distinct(), "question", "left_anti")
    by_element = lost.join(w, "element_id").select("question", "quote", F.col("id").alias("window"), "flat")
    quoted = (F.col("quote") != "") & F.contains(T.alphanumeric(F.col("flat")), F.col("quote"))
    found = by_chunk.unionByName(by_element).select("question", "window", F.when(quoted, 2).otherwise(1).alias("grade"))
    # parts and facts: phrases
    p = q.where("rule IN ('parts', 'fact', 'element')").select(F.col("id").alias("question"), "rule", "answers", "related", "evidence", "by_element", "groups", "prefix")
    j = w.select(F.col("id").alias("window"), F.coalesce("element_id", F.lit("")).alias("e"), "kind", "flat").join(p, F.lit(True))  # the stated questions, broadcast where they are small
    own = (F.coalesce("prefix", F.lit("")) != "") & F.col("e").startswith(F.col("prefix"))
    held = lambda c: F.coalesce(T.holds(c, F.col("flat")), F.lit(False))
    said = held(F.col("evidence"))
    answers, related = (F.array_contains(F.coalesce(c, none), F.col("e")) for c in ("answers", "related"))
    fact = (own | (F.col("kind") == "index:id")) & (said | held(F.try_element_at("by_element", F.col("e"))))
    grade = (
        F.when((F.col("rule") == "parts") & F.coalesce(F.exists("groups", lambda g: T.holds(g, F.col("flat"))), F.lit(False)), 2)
        .when((F.col("rule") == "fact") & fact, 2)
        .when((F.col("rule") == "fact") & (answers | related), 1)
        .when((F.col("rule") == "element") & (answers | (own & said)), 2)
        .when((F.col("rule") == "element") & related, 1)
    )
    out = found.unionByName(j.select("question", "window", grade.alias("grade")).where("grade IS NOT NULL"))
    if judged is None:
        return out
    g = judged.select("question", "window", F.col("grade").alias("_g"))
    there = g.join(w.select(F.col("id").alias("window")), "window", "left_semi")
    return out.join(there, ["question", "window"], "full_outer").select("question", "window", F.coalesce("_g", "grade").alias("grade")).where("grade > 0")


def covers(questions: DataFrame, windows: DataFrame, graded: DataFrame) -> DataFrame:
    """(question, window, parts, held): how many parts an answer has, and which of them a graded window holds."""
    q = question_rows(questions).select(F.col("id").alias("question"), "rule", "groups")
    w = window_rows(windows).select(F.col("id").alias("window"), "flat")
    rows = graded.join(q, "question").join(w, "window")
    n = F.coalesce(F.size("groups"), F.lit(0))
    by_part = F.filter(F.sequence(F.lit(0), F.greatest(n - 1, F.lit(0))), lambda k: F.coalesce(T.holds(F.get(F.col("groups"), k), F.col("flat")), F.lit(False)))
    is_parts = F.col("rule") == "parts"
    held = F.when(is_parts, by_part).when(F.col("grade") == 2, F.array(F.lit(0))).otherwise(F.array().cast("array<int>"))
    return rows.select("question", "window", F.when(is_parts, n).otherwise(1).alias("parts"), held.alias("held"))


def coverage(ranked: DataFrame, covered: DataFrame, depth: int = 10) -> DataFrame:
    """(system, question, coverage, complete): the share of the parts that the top windows hold between them, and whether one holds all."""
    top = ranked.where(F.col("rank") <= depth).join(covered, ["question", "window"], "left")
    seen = F.size(F.array_distinct(F.flatten(F.collect_list(F.coalesce("held", F.array().cast("array<int>"))))))
    all_ = F.max(F.when(F.size("held") == F.col("parts"), 1.0).otherwise(0.0))
    parts = covered.groupBy("question").agg(F.max("parts").alias("n"))
    out = top.groupBy("system", "question").agg(seen.alias("seen"), all_.alias("complete")).join(parts, "question", "left")
    return out.select("system", "question", F.coalesce(F.col("seen") / F.nullif("n", F.lit(0)), F.lit(0.0)).alias("coverage"), "complete")


def measures(ranked: DataFrame, graded: DataFrame) -> DataFrame:
    """(system, question, hit_1, hit_5, hit_10, hit_20, mrr_10, ndcg_10); the ideal is over all grades of the question."""
    gain = lambda g: F.pow(F.lit(2.0), g) - 1
    order = Window.partitionBy("question").orderBy(F.desc("grade"))
    ideal = graded.withColumn("k", F.row_number().over(order)).where("k <= 10").groupBy("question").agg(F.sum(gain(F.col("grade")) / F.log2(F.col("k") + 1)).alias("best"))
    r = ranked.join(graded, ["question", "window"], "left").withColumn("grade", F.coalesce("grade", F.lit(0)))
    m = r.groupBy("system", "question").agg(F.min(F.when(F.col("grade") == 2, F.col("rank"))).alias("first"), F.sum(F.when(F.col("rank") <= 10, gain(F.col("grade")) / F.log2(F.col("rank") + 1)).otherwise(0.0)).alias("dcg"))
    first = F.coalesce("first", F.lit(1 << 30))
    hits = [(first <= k).cast("int").alias(f"hit_{k}") for k in (1, 5, 10, 20)]
    return m.join(ideal, "question", "left").select("system", "question", *hits, F.round(F.when(first <= 10, 1.0 / first).otherwise(0.0), 6).alias("mrr_10"), F.round(F.coalesce(F.col("dcg") / F.nullif("best", F.lit(0.0)), F.lit(0.0)), 6).alias("ndcg_10"))


def pools(ranked: DataFrame, depth: int = 10) -> DataFrame:
    """(question, window): what any system ranks among its first."""
    return ranked.where(F.col("rank") <= depth).select("question", "window").distinct()


def missed(measured: DataFrame) -> DataFrame:
    """(question, systems): those that do not have it in their top 10."""
    return measured.where("hit_10 = 0").groupBy("question").agg(F.array_sort(F.collect_list("system")).alias("systems"))


def run_comparison(before: DataFrame, after: DataFrame, names: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Two runs' rows (system, question, measures) paired by question for the systems both ran: mean changes, and what was lost and gained."""
    both = before.select("question").distinct().join(after.select("question").distinct(), "question")
    a = before.join(both, "question").select("system", "question", F.struct(*names).alias("a"))
    b = after.join(both, "question").select("system", "question", F.struct(*names).alias("b"))
    j = a.join(b, ["system", "question"])
    changes = j.groupBy("system").agg(F.count("*").alias("n"), *[F.round(F.avg(F.col(f"b.{m}") - F.col(f"a.{m}")), 6).alias(f"change_{m}") for m in names])
    listed = lambda c: F.array_sort(F.collect_list(F.when(c, F.col("question"))))
    found = j.groupBy("system").agg(listed((F.col("a.hit_10") == 1) & (F.col("b.hit_10") == 0)).alias("lost"), listed((F.col("a.hit_10") == 0) & (F.col("b.hit_10") == 1)).alias("gained"))
    return changes, found


def one_sided(before: DataFrame, after: DataFrame) -> DataFrame:
    """(only_before, only_after, both): how many questions were asked in one run only."""
    a, b = before.select("question", F.lit(1).alias("a")).distinct(), after.select("question", F.lit(1).alias("b")).distinct()
    j = a.join(b, "question", "full_outer")
    return j.agg(F.count_if(F.col("b").isNull()).alias("only_before"), F.count_if(F.col("a").isNull()).alias("only_after"), F.count_if(F.col("a").isNotNull() & F.col("b").isNotNull()).alias("both"))


def consensus_grades(judgments: DataFrame, first: str, second: str, tiebreak: str | None = None) -> DataFrame:
    """(set, question, window, grade): two main judges' grade where they agree, else the tie-breaker's, else the lower; one judge's alone counts."""
    said = lambda name: F.max(F.when(F.col("judge") == name, F.col("grade")))
    g = judgments.where("grade IS NOT NULL").groupBy("set", "question", "window").agg(said(first).alias("a"), said(second).alias("b"), (said(tiebreak) if tiebreak else F.lit(None).cast("int")).alias("t"))
    grade = F.when(F.col("a") == F.col("b"), F.col("a")).when(F.col("a").isNotNull() & F.col("b").isNotNull(), F.coalesce("t", F.least("a", "b"))).otherwise(F.coalesce("a", "b"))
    return g.select("set", "question", "window", grade.alias("grade")).where("grade IS NOT NULL")


def windowed(units: DataFrame, offsets: Column, size: int = 512, overlap: int = 64) -> DataFrame:
    """Units (id, text, ...) cut into overlapping windows; one that fits keeps its id, others get ``#w0``, ``#w1``, ..."""
    rows = units.withColumn("_w", spans_text(F.col("text"), offsets, size, overlap))
    rest = [c for c in units.columns if c not in ("id", "text")]
    named = F.when(F.size("_w") > 1, F.concat("id", F.lit("#w"), F.col("_k").cast("string"))).otherwise(F.col("id"))
    return rows.select("*", F.posexplode("_w").alias("_k", "_t")).select(named.alias("id"), F.col("_t").alias("text"), *rest)


# --- tasks for judges ---------------------------------------------------------------------------


def preference_tasks(names: DataFrame) -> DataFrame:
    """(collection, pair, a, b): every two ways of a collection, in both orders."""
    x, y = names.toDF("collection", "x"), names.toDF("collection", "y")
    pairs = x.join(y, "collection").where("x < y")
    both = F.explode(F.array(F.struct(F.col("x").alias("a"), F.col("y").alias("b")), F.struct(F.col("y").alias("a"), F.col("x").alias("b"))))
    return pairs.select("collection", F.concat_ws("-", "x", "y").alias("pair"), both.alias("t")).select("collection", "pair", "t.*")


def intruder_tasks(members: DataFrame, trials: int = 3, seed: int = 1) -> DataFrame:
    """(split, group, trial, shown, answer): five of a group and one of another, shuffled by a seed that names the split.

    ``members`` has (split, group, item); a split's items are one collection's, drawn from in order, so a split is one piece of work.
    """
    rows = members.groupBy("split").agg(F.array_sort(F.collect_list(F.struct("group", "item"))).alias("rows"))

    @F.pandas_udf("array<struct<group:string,trial:int,shown:array<string>,answer:int>>")
    def run(split: pd.Series, lists: pd.Series) -> pd.Series:
        out = []
        for name, listed in zip(split, lists):
            rnd, groups = random.Random(f"{seed}:{name}"), {}
            for r in listed:
                groups.setdefault(r["group"], []).append(r["item"])
            tasks = []
            for g in sorted(groups):
                inside, outside = sorted(groups[g]), sorted(x for h, xs in groups.items() if h != g for x in xs)
                for trial in range(trials if len(inside) >= 5 and outside else 0):
                    shown, odd = rnd.sample(inside, 5), rnd.choice(outside)
                    shown = [*shown, odd]
                    rnd.shuffle(shown)
                    tasks.append({"group": g, "trial": trial, "shown": shown, "answer": shown.index(odd) + 1})
            out.append(tasks)
        return pd.Series(out)

    tasks = rows.select("split", F.explode(run("split", F.transform("rows", lambda r: F.struct(r["group"].cast("string").alias("group"), r["item"].cast("string").alias("item"))))).alias("t"))
    return tasks.select("split", "t.*")


def subset_collections(families: Sequence[str], n: int = 9, share: float = 0.6, seed: int = 1) -> Mapping[str, list[str]]:
    """All families, then seeded random subsets of a share of them, by name."""
    names = sorted(set(families))
    out = {"all": names}
    for k in range(n):
        out[f"subset-{k + 1}"] = sorted(random.Random(f"{seed}:collection:{k}").sample(names, min(len(names), max(2, round(share * len(names))))))
    return out


def alternating(rows: DataFrame, stratum: str, within: Column) -> DataFrame:
    """``rows`` with ``turn`` and ``pos``: strata take turns, each in its own order."""
    r = running(rows, [within], group=[stratum], before="turn").withColumn("turn", (F.col("turn") + 1).cast("int"))
    return running(r, ["turn", stratum], before="pos").withColumn("pos", (F.col("pos") + 1).cast("int"))


def systematic(rows: DataFrame, order: str, most: int) -> DataFrame:
    """Every step-th row in order, ``most`` of them: the sample is the feature."""
    r = running(rows, [order], before="_k", total="_n")
    step = F.greatest(F.floor(F.col("_n") / most), F.lit(1))
    return r.where((F.col("_k") % step == 0) & (F.col("_k") / step < most)).drop("_k", "_n")


def spread_pick(rows: DataFrame, size: str, tie: str, n: int) -> DataFrame:
    """n rows spread over the sizes from the largest down: the sample is the feature."""
    r = running(rows, [F.desc(size), tie], before="_k", total="_n")
    chosen = F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda i: F.floor(i * F.col("_n") / n))
    return r.where((F.col("_n") <= n) | F.array_contains(chosen, F.col("_k").cast("long"))).drop("_k", "_n")
