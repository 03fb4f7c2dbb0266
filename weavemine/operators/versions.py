"""Fingerprints of models, versions of one model, and how copies of one item differ."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weavemine.functions import text as T
from weavemine.functions.origins import folder_of, id_hash, id_marks, utc_text
from weavemine.operators.components import connected_components
from weavemine.operators.identity import overlaps, version_class

#: Kinds of lineage that make one family, those that are kin, and the share of own ids that is flagged.
SAME_FAMILY, KIN, FORK = ("copy", "version"), ("derived", "root", "branches"), 0.10
#: How the older and the newer of a pair of kin stand to each other.
STANDING = {"derived": ("built-on", "derived"), "root": ("root", "root"), "branches": ("branches", "branches")}
HOW = {"derived": "derived by others from", "built-on": "built on by others in", "root": "shares a root with", "branches": "a branch beside"}


def fingerprint_ids(ids: DataFrame) -> DataFrame:
    """(content, id, maker, day): each different id of a content by its hash, with who made it and on which day since 1970."""
    one = ids.select("content", "xid").where("xid IS NOT NULL").distinct()
    marked = one.select("content", id_hash(F.col("xid")).alias("id"), id_marks(F.col("xid")).alias("m"))
    first = marked.groupBy("content", "id").agg(F.min("m").alias("m"))
    return first.select("content", "id", F.col("m.maker").alias("maker"), F.floor(F.col("m.ms") / 86_400_000).cast("int").alias("day"))


def packed(marks: DataFrame) -> DataFrame:
    """(content, elements, ids): sorted hashes of a content; equality is all that unsigned hashes are used for."""
    return marks.groupBy("content").agg(F.count("*").alias("elements"), F.array_sort(F.collect_list("id")).alias("ids"))


def unpacked(fingerprints: DataFrame) -> DataFrame:
    return fingerprints.select("content", F.explode("ids").alias("id"))


def newest_first(saved: Column, saved_from: Column) -> list[Column]:
    """Sort keys: a recorded time, then one of the archive's dates, then none; late before early."""
    known = F.when(F.coalesce(saved, F.lit("")) == "", 0).when(saved_from == "zip", 1).otherwise(2)
    return [known.desc(), F.coalesce(F.when(known > 0, utc_text(saved)), F.lit("")).desc()]


def related_pairs(marks: DataFrame, lineage: DataFrame | None = None) -> DataFrame:
    """(a, b, shared, cover, kind) of contents that share enough: by lineage where that tells, else by how much they share."""
    pairs = overlaps(marks, "content", "id").select("a", "b", "shared", "cover", version_class(F.col("shared"), F.col("cover"), F.col("jaccard")).alias("rule"))
    pairs = pairs.where("rule <> 'none'")
    if lineage is None:
        return pairs.withColumnRenamed("rule", "kind")
    told = lineage.where("kind <> 'unknown'").select(F.least("older", "newer").alias("a"), F.greatest("older", "newer").alias("b"), F.col("kind").alias("told"))
    return pairs.join(told, ["a", "b"], "left").select("a", "b", "shared", "cover", F.coalesce("told", "rule").alias("kind"))


def version_groups(contents: DataFrame, marks: DataFrame, pairs: DataFrame) -> DataFrame:
    """(content, family, rank, versions, shared, only_here, fork): versions of one model, newest first.

    ``contents`` has (content, saved, saved_from); a group is what pairs of one
    family link up, its name is its newest; the shares are of a member's ids
    that the newest has and lacks. Contents without versions are left out.
    """
    links = pairs.where(F.col("kind").isin(*SAME_FAMILY)).select(F.col("a").alias("src"), F.col("b").alias("dst"))
    groups = connected_components(links).toDF("content", "group")
    order = Window.partitionBy("group").orderBy(*newest_first(F.col("saved"), F.col("saved_from")), "content")
    ranked = groups.join(contents, "content").withColumn("rank", F.row_number().over(order) - 1)
    ranked = ranked.withColumn("versions", F.count("*").over(Window.partitionBy("group"))).withColumn("family", F.first("content").over(order))
    held = ranked.select("content", "family").join(marks.select("content", "id"), "content")
    newest = marks.select(F.col("content").alias("family"), "id", F.lit(1).alias("there"))
    share = held.join(newest, ["family", "id"], "left").groupBy("content").agg(F.avg(F.coalesce("there", F.lit(0))).alias("shared"))
    out = ranked.join(share, "content", "left").withColumn("only_here", 1 - F.col("shared"))
    return out.select("content", "family", "rank", "versions", F.round("shared", 3).alias("shared"), F.round("only_here", 3).alias("only_here"), ((F.col("rank") > 0) & (F.col("only_here") >= FORK)).alias("fork"))


def families(written: DataFrame, groups: DataFrame) -> DataFrame:
    """(content, family, rank, versions) of written contents: ranks and counts among those; one without versions is its own family."""
    j = written.select("content").join(groups.select("content", "family", "rank"), "content", "left")
    j = j.withColumns({"family": F.coalesce("family", "content"), "rank": F.coalesce("rank", F.lit(0))})
    order = Window.partitionBy("family").orderBy("rank")
    ranked = j.withColumns({"_f": F.first("content").over(order), "_r": F.row_number().over(order) - 1, "versions": F.count("*").over(Window.partitionBy("family"))})
    return ranked.select("content", F.col("_f").alias("family"), F.col("_r").alias("rank"), "versions")


def kin(pairs: DataFrame) -> DataFrame:
    """(content, other, standing): how a model stands to those it is built on or shares a part with; ``pairs`` has (older, newer, kind)."""
    stands = lambda side: F.coalesce(*[F.when(F.col("kind") == k, s[side]) for k, s in STANDING.items()], F.lit("related"))
    p = pairs.where(~F.col("kind").isin(*SAME_FAMILY, "unknown"))
    older = p.select(F.col("older").alias("content"), F.col("newer").alias("other"), stands(0).alias("standing"))
    return older.unionByName(p.select(F.col("newer").alias("content"), F.col("older").alias("other"), stands(1).alias("standing")))


def related_models(families_: DataFrame, kin_: DataFrame) -> DataFrame:
    """(a, b): models of one family, kin, or with a part in common, both ways."""
    f = families_.select("content", "family")
    same = f.toDF("a", "family").join(f.toDF("b", "family"), "family").where("a <> b").select("a", "b")
    return same.unionByName(kin_.select(F.col("content").alias("a"), F.col("other").alias("b"))).distinct()


def lineage_notes(families_: DataFrame, kin_: DataFrame, labels: DataFrame) -> DataFrame:
    """(content, versions_cell, lineage_cell): a model's rank among its versions, and its kin, in words."""
    name = labels.select(F.col("content").alias("other"), "label")
    phrase = F.coalesce(*[F.when(F.col("standing") == k, w) for k, w in HOW.items()], F.lit("shares a part with"))
    notes = kin_.join(name, "other", "left").select("content", (F.col("standing") == "related").alias("last"), F.concat(phrase, F.lit(" "), F.coalesce("label", F.substring("other", 1, 8))).alias("note"))
    notes = notes.groupBy("content").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("last", "note"))), lambda x: x["note"]), "; ").alias("lineage_cell"))
    f = families_.join(labels.select(F.col("content").alias("family"), "label"), "family", "left").join(notes, "content", "left")
    newest = F.concat(F.lit("newest of "), F.col("versions").cast("string"))
    older = F.concat(F.lit("version "), (F.col("versions") - F.col("rank")).cast("string"), F.lit(" of "), F.col("versions").cast("string"), F.lit("; the newest: "), F.col("label"))
    cell = F.when(F.col("versions") == 1, "").when(F.col("rank") == 0, newest).otherwise(older)
    return f.select("content", cell.alias("versions_cell"), F.coalesce("lineage_cell", F.lit("")).alias("lineage_cell"))


def standing(kin_standing: Column, here_family: Column, there_family: Column, here_rank: Column, there_rank: Column) -> Column:
    """How one model stands to another: as kin, else older or newer within a family, else null."""
    same = here_family == there_family
    return F.coalesce(kin_standing, F.when(same & (there_rank > here_rank), "older").when(same, "newer"))


def common_folder(paths: DataFrame) -> DataFrame:
    """(folder): the folder that all paths are under, empty for none; an aggregate of the shortest common lead."""
    parts = paths.select(F.split(folder_of(F.col("path")), "/").alias("p"))
    ends = parts.agg(F.min("p").alias("a"), F.max("p").alias("b"))  # in order, the first and the last differ soonest
    joined = lambda c: F.array_join(c, "/")
    return ends.select(joined(F.slice("a", F.lit(1), T.shared_levels(joined(F.col("a")), joined(F.col("b")), "/"))).alias("folder"))


def chooser_by_folder(projects: DataFrame, folder: str) -> DataFrame:
    """(title, content, pos): models by the folder below the common one, by name in each."""
    rest = F.regexp_replace(F.expr(f"substring(folder, {len(folder) + 1})"), "^/", "")
    p = projects.withColumn("folder", folder_of(F.col("path"))).withColumn("title", F.when(rest == "", "(the common folder)").otherwise(rest))
    return p.select("title", "content", F.row_number().over(Window.partitionBy("title").orderBy(F.lower("label"), "content")).alias("pos"))


def chooser_by_lineage(projects: DataFrame, families_: DataFrame, kin_: DataFrame) -> DataFrame:
    """(cluster, title, content, depth, pos): models joined by family and kin; in each cluster families by time, older versions indented."""
    own = families_.select(F.col("content").alias("src"), F.col("family").alias("dst"))
    related = kin_.where("standing <> 'related'").select(F.col("content").alias("src"), F.col("other").alias("dst"))
    clusters = connected_components(own.unionByName(related)).toDF("content", "cluster")
    p = projects.join(families_, "content").join(clusters, "content", "left").withColumn("cluster", F.coalesce("cluster", "content"))
    heads = p.where("rank = 0").select("family", F.col("saved").alias("_s"), F.lower("label").alias("_n"))
    p = p.join(heads, "family")
    order = Window.partitionBy("cluster").orderBy("_s", "_n", "family", "rank")
    p = p.withColumn("pos", F.row_number().over(order)).withColumn("size", F.count("*").over(Window.partitionBy("cluster"))).withColumn("first", F.first("label").over(order))
    p = p.join(related.select(F.col("src").alias("content")).distinct().withColumn("kin", F.lit(True)), "content", "left")
    built = F.max(F.coalesce("kin", F.lit(False))).over(Window.partitionBy("cluster"))
    title = F.when(F.col("size") > 1, F.concat("first", F.lit(": "), F.col("size").cast("string"), F.when(built, " models built on one another").otherwise(" versions")))
    return p.select("cluster", title.alias("title"), "content", (F.col("rank") > 0).cast("int").alias("depth"), "pos")


def differences(a: str = "a", b: str = "b") -> Column:
    """What one copy has that another differs in, as phrases; ``a`` and ``b`` are structs.

    Fields: name, rid, text (digest), stereotypes, tagged (map), relations
    (array of kind, direction, other, label, phrase), owns, shows (array of key, name), place.
    Relations are matched by the other end's id, what is left by its label.
    """
    x, y = (lambda f: F.col(f"{a}.{f}")), (lambda f: F.col(f"{b}.{f}"))
    changed = lambda f: ~x(f).eqNullSafe(y(f))
    told = lambda side, other: F.concat(F.lit(f"{other}: "), F.coalesce(x(side), F.lit("none")), F.lit(" here, "), F.coalesce(y(side), F.lit("none")), F.lit(" there"))

    def listed(word: str, here: Column, there: Column) -> Column:
        d = T.added_removed(here, there)
        return F.when((F.size(d["plus"]) > 0) | (F.size(d["minus"]) > 0), F.concat(F.lit(word), T.plus_minus(d["plus"], d["minus"])))

    keys = F.array_sort(F.array_union(F.map_keys(x("tagged")), F.map_keys(y("tagged"))))
    tags = F.filter(keys, lambda k: ~F.try_element_at(x("tagged"), k).eqNullSafe(F.try_element_at(y("tagged"), k)))
    end = lambda r: F.struct(r["kind"].alias("kind"), r["direction"].alias("direction"), r["other"].alias("other"))
    unmatched = lambda mine, others: F.transform(F.filter(mine, lambda r: ~F.array_contains(F.transform(others, end), end(r))), lambda r: F.concat(r["phrase"], F.lit(" "), r["label"]))
    unshown = lambda mine, others: F.transform(F.filter(mine, lambda s: ~F.array_contains(F.transform(others, lambda o: o["key"]), s["key"])), lambda s: s["name"])
    place = T.parted_paths(F.coalesce(x("place"), F.lit("")), F.coalesce(y("place"), F.lit("")))
    aspects = [
        F.when(changed("name"), told("name", "name")),
        F.when(changed("rid"), told("rid", "requirement Id")),
        F.when(changed("text"), "text"),
        listed("stereotypes", x("stereotypes"), y("stereotypes")),
        F.when(F.size(tags) > 0, F.concat(F.lit("tagged values: "), F.array_join(tags, ", "))),
        listed("relationships", unmatched(x("relations"), y("relations")), unmatched(y("relations"), x("relations"))),
        listed("members", x("owns"), y("owns")),
        listed("shows", unshown(x("shows"), y("shows")), unshown(y("shows"), x("shows"))),
        F.when(changed("place"), F.concat(F.lit("package: "), place["here"], F.lit(" here, "), place["there"], F.lit(" there"))),
    ]
    return F.array_compact(F.array(*aspects))


def compared_models(items: DataFrame, a: str, b: str) -> DataFrame:
    """(status, key): items of model ``a`` that are changed or the same in ``b`` or only there, and those only in ``b``.

    ``items`` has (model, key, matches): matches is an array of (model, key, differences).
    """
    mine = items.where(F.col("model") == a).select("key", F.get(F.filter("matches", lambda m: m["model"] == b), F.lit(0)).alias("m"))
    status = F.when(F.col("m").isNull(), "only_a").when(F.size("m.differences") > 0, "changed").otherwise("same")
    theirs = items.where(F.col("model") == b).where(~F.exists("matches", lambda m: m["model"] == a)).select("key")
    matched = mine.where("m IS NOT NULL").select(F.col("m.key").alias("key"))
    return mine.select(status.alias("status"), "key").unionByName(theirs.join(matched, "key", "left_anti").select(F.lit("only_b").alias("status"), "key"))


def also_in(differences_: Column, label: Column) -> Column:
    """One copy elsewhere as a cell says it."""
    return F.concat(label, F.lit(" ("), F.when(F.size(differences_) == 0, "the same").otherwise(F.array_join(differences_, ", ")), F.lit(")"))


def list_differences(rows: DataFrame, keys: list[str], here: str, there: str) -> DataFrame:
    """(keys, plus, minus): what two lists of each key hold more of than each other, repeats counted, sorted.

    Values are counted as rows of their own, so the work grows with the lists, not with their product.
    Rows with equal keys are read as one; null lists as empty, null values are dropped.
    """
    signed = lambda c, n: F.transform(F.coalesce(F.col(c), F.array().cast("array<string>")), lambda v: F.struct(v.alias("v"), F.lit(n).alias("n")))
    each = rows.select(*keys, F.explode_outer(F.concat(signed(here, 1), signed(there, -1))).alias("x"))
    n = each.groupBy(*keys, F.col("x.v").alias("v")).agg(F.sum("x.n").alias("n"))
    more = lambda s: F.array_sort(F.flatten(F.collect_list(F.when(F.col("v").isNotNull() & (s * F.col("n") > 0), F.array_repeat("v", (s * F.col("n")).cast("int"))))))
    return n.groupBy(*keys).agg(more(F.lit(1)).alias("plus"), more(F.lit(-1)).alias("minus"))
