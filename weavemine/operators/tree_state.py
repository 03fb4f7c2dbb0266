"""The state of a tree of outputs: inputs, contents, sightings, projects, gaps, fingerprints, removals, answers.

Tables go in and tables come out; nothing is changed in place. What an update
makes of a table is a new table, so a caller writes it as one commit (``sinks.publish``).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

INPUTS = "id long, path string, status string, metadata string, size long, mtime long, sha256 string, error string"
CONTENTS = "sha256 string, name string, kind string, size long, first_seen string"
SIGHTINGS = "content_sha256 string, input_id long, input_sha256 string, chain string, seen string"
PROJECTS = "content_sha256 string, status string, tool string, options_hash string, summary string, error string, updated string"
GAPS = "content_sha256 string, options_hash string, items int, builds int"
REMOVED = "content_sha256 string, name string, removed string"


# --- views --------------------------------------------------------------------------------------


def current_sightings(sightings: DataFrame, inputs: DataFrame, contents: DataFrame) -> DataFrame:
    """Sightings in the version of each input that was read last."""
    i = inputs.select(F.col("id").alias("input_id"), "path", F.col("status").alias("input_status"), "metadata", F.col("sha256").alias("input_sha256"))
    c = contents.select(F.col("sha256").alias("content_sha256"), "name")
    found = sightings.join(i, ["input_id", "input_sha256"]).join(c, "content_sha256")
    return found.select("content_sha256", "name", "input_id", "path", "input_status", "metadata", "input_sha256", "chain")


def project_status(contents: DataFrame, projects: DataFrame, removed: DataFrame, current: DataFrame) -> DataFrame:
    """Every content with the state of its output and how often it is seen now."""
    seen = current.groupBy("content_sha256").agg(F.count("*").alias("sightings"))
    p = projects.select("content_sha256", F.col("status").alias("_p"), "error", "updated")
    r = removed.select("content_sha256", F.lit(True).alias("_gone"))
    out = contents.select(F.col("sha256").alias("content_sha256"), "name")
    for other in (p, r, seen):
        out = out.join(other, "content_sha256", "left")
    status = F.when(F.col("_gone"), "removed").otherwise(F.coalesce("_p", F.lit("pending")))
    return out.select(F.col("content_sha256").alias("sha256"), "name", status.alias("status"), "error", "updated", F.coalesce("sightings", F.lit(0)).alias("sightings"))


def written(projects: DataFrame, contents: DataFrame) -> DataFrame:
    c = contents.select(F.col("sha256").alias("content_sha256"), "name", "kind", "size")
    return projects.where("status = 'written'").join(c, "content_sha256")


def catalog(status: DataFrame, fingerprints: DataFrame) -> DataFrame:
    """Every content with its status and its fingerprint, without the ids."""
    f = fingerprints.select(F.col("content_sha256").alias("sha256"), "saved", "saved_raw", "saved_from", "project_id", "exporter", "elements")
    return status.join(f, "sha256", "left")


# --- questions ----------------------------------------------------------------------------------


def with_status(rows: DataFrame, *statuses: str, order: Sequence[str] = ("id",)) -> DataFrame:
    return (rows.where(F.col("status").isin(*statuses)) if statuses else rows).orderBy(*order)


def counts(rows: DataFrame) -> DataFrame:
    return rows.groupBy("status").agg(F.count("*").alias("n"))


def count_projects(projects: DataFrame, status: str, tool: str, options: str) -> DataFrame:
    return projects.where((F.col("status") == status) & (F.col("tool") == tool) & (F.col("options_hash") == options)).agg(F.count("*").alias("n"))


def is_sighted(sightings: DataFrame, versions: DataFrame) -> DataFrame:
    """``versions`` (input_id, input_sha256) with whether that version was read for its projects."""
    seen = sightings.select("input_id", "input_sha256").distinct().withColumn("sighted", F.lit(True))
    return versions.join(seen, ["input_id", "input_sha256"], "left").withColumn("sighted", F.coalesce("sighted", F.lit(False)))


def stale_contents(contents: DataFrame, projects: DataFrame, removed: DataFrame, tool: str, options: str, gaps: DataFrame | None = None) -> DataFrame:
    """(sha256, name): contents without a written output of this tool and these options, or, with ``gaps``, with gaps under them; removed ones left out."""
    done = projects.where((F.col("status") == "written") & (F.col("tool") == tool) & (F.col("options_hash") == options)).select(F.col("content_sha256").alias("sha256"))
    if gaps is not None:
        open_ = gaps.where(F.col("options_hash") == options).select(F.col("content_sha256").alias("sha256"))
        done = done.join(open_, "sha256", "left_anti")
    left = contents.select("sha256", "name").join(done, "sha256", "left_anti")
    return left.join(removed.select(F.col("content_sha256").alias("sha256")), "sha256", "left_anti")


def gap_rows(gaps: DataFrame, projects: DataFrame, contents: DataFrame) -> DataFrame:
    """Written projects with gaps under the options they were made with."""
    p = projects.where("status = 'written'").select("content_sha256", "options_hash")
    c = contents.select(F.col("sha256").alias("content_sha256"), "name")
    return gaps.join(p, ["content_sha256", "options_hash"]).join(c, "content_sha256")


def with_gaps(gaps: DataFrame, projects: DataFrame, options: str) -> DataFrame:
    p = projects.where((F.col("status") == "written") & (F.col("options_hash") == options)).select("content_sha256")
    return gaps.where(F.col("options_hash") == options).join(p, "content_sha256", "left_semi").agg(F.count("*").alias("n"))


def orphans(contents: DataFrame, current: DataFrame) -> DataFrame:
    """Contents that no input which is still there holds."""
    there = current.where("input_status <> 'missing'").select(F.col("content_sha256").alias("sha256"))
    return contents.select("sha256", "name").join(there, "sha256", "left_anti")


def unfingerprinted(contents: DataFrame, fingerprints: DataFrame, marks: DataFrame) -> DataFrame:
    both = fingerprints.select(F.col("content_sha256").alias("sha256")).join(marks.select(F.col("content_sha256").alias("sha256")), "sha256", "left_semi")
    return contents.select("sha256", "name").join(both, "sha256", "left_anti")


def work_list(stale: DataFrame, current: DataFrame) -> DataFrame:
    """(path, work): stale contents by an input to read them from, the first in order that was read; contents of missing inputs have none."""
    done = current.where("input_status = 'done'").groupBy(F.col("content_sha256").alias("sha256"))
    where = done.agg(F.min(F.struct("path", "chain", "input_sha256")).alias("w")).select("sha256", "w.path", "w.input_sha256")
    return stale.join(where, "sha256").groupBy("path").agg(F.array_sort(F.collect_list(F.struct("name", "sha256", "input_sha256"))).alias("work"))


def refingerprint_list(missing: DataFrame, current: DataFrame) -> DataFrame:
    """(path, shas): contents still to be fingerprinted by an input that holds them."""
    where = current.where("input_status = 'done'").groupBy(F.col("content_sha256").alias("sha256")).agg(F.min(F.struct("path", "chain")).alias("w"))
    return missing.join(where, "sha256").groupBy(F.col("w.path").alias("path")).agg(F.array_sort(F.collect_list("sha256")).alias("shas"))


def tree_status(inputs: DataFrame, status: DataFrame, gaps: DataFrame) -> DataFrame:
    """(section, key, n): how many inputs and projects stand how, and how many have gaps."""
    rows = [df.groupBy(F.lit(name).alias("section"), F.col("status").alias("key")).agg(F.count("*").alias("n")) for name, df in (("inputs", inputs), ("projects", status))]
    rows.append(gaps.agg(F.lit("gaps").alias("section"), F.lit("projects").alias("key"), F.count("*").alias("n")))
    return rows[0].unionByName(rows[1]).unionByName(rows[2])


# --- updates ------------------------------------------------------------------------------------


def _put(table: DataFrame, rows: DataFrame, key: Sequence[str]) -> DataFrame:
    """``table`` with ``rows`` in place of those with the same key."""
    return table.join(rows.select(*key).distinct(), list(key), "left_anti").select(table.columns).unionByName(rows.select(table.columns))


def _add(table: DataFrame, rows: DataFrame, key: Sequence[str]) -> DataFrame:
    """``table`` with those ``rows`` whose key it does not have, one a key: of several the least in the order of the table's columns."""
    rest = [c for c in table.columns if c not in key]
    new = rows.join(table.select(*key), list(key), "left_anti")
    one = new.groupBy(*key).agg(F.min(F.struct(*rest)).alias("_r")).select(*key, "_r.*") if rest else new.select(*key).distinct()
    return table.unionByName(one.select(table.columns))


def checked_inputs(inputs: DataFrame, listing: DataFrame) -> DataFrame:
    """Inputs that are gone are missing; those that are back, failed or changed since they were read are pending."""
    there = listing.select("path", F.col("size").alias("_size"), F.col("mtime").alias("_mtime"), F.lit(True).alias("_there"))
    changed = ~(F.col("_size").eqNullSafe(F.col("size")) & F.col("_mtime").eqNullSafe(F.col("mtime")))
    again = F.col("status").isin("missing", "failed") | ((F.col("status") == "done") & changed)
    status = F.when(F.col("_there").isNull(), "missing").when(again, "pending").otherwise(F.col("status"))
    return inputs.join(there, "path", "left").withColumn("status", status).select(inputs.columns)


def add_inputs(inputs: DataFrame, given: DataFrame) -> DataFrame:
    """New paths are pending; known ones are pending again where their metadata changes. Ids go on from the largest."""
    g = given.select("path", F.col("metadata").alias("_new")).dropDuplicates(["path"])
    differ = F.col("_new").isNotNull() & ~F.col("_new").eqNullSafe(F.col("metadata"))
    known = inputs.join(g, "path", "left")
    known = known.withColumns({"status": F.when(differ, "pending").otherwise(F.col("status")), "metadata": F.coalesce("_new", "metadata")}).select(inputs.columns)
    fresh = g.join(inputs.select("path"), "path", "left_anti")
    from pyspark.sql import Window

    # the paths given at once on a command line, not a corpus: one order over them
    last = inputs.agg(F.coalesce(F.max("id"), F.lit(0)).alias("_last"))
    fresh = fresh.withColumn("_k", F.row_number().over(Window.orderBy("path"))).crossJoin(last)
    made = {"id": F.col("_last") + F.col("_k"), "status": F.lit("pending"), "metadata": F.col("_new")}
    rows = fresh.withColumns(made)
    return known.unionByName(rows.select(*[(F.col(c) if c in (*made, "path") else F.lit(None).cast(inputs.schema[c].dataType).alias(c)) for c in inputs.columns]))


def record_sightings(contents: DataFrame, sightings: DataFrame, found: DataFrame, now: str) -> tuple[DataFrame, DataFrame]:
    """Contents and sightings with what was found in inputs; known ones stay as they are."""
    c = found.select("sha256", "name", "kind", "size", F.lit(now).alias("first_seen"))
    s = found.select(F.col("sha256").alias("content_sha256"), "input_id", "input_sha256", "chain", F.lit(now).alias("seen"))
    return _add(contents, c, ["sha256"]), _add(sightings, s, ["content_sha256", "input_id", "input_sha256", "chain"])


def set_projects(projects: DataFrame, rows: DataFrame) -> DataFrame:
    """Upsert: given columns replace, the others of a known project stay."""
    given = [c for c in rows.columns if c != "content_sha256"]
    r = rows.select("content_sha256", F.struct(*given).alias("_r"))
    names = [c for c in projects.columns if c != "content_sha256"]
    p = projects.select("content_sha256", F.struct(*names).alias("_p"))
    j = p.join(r, "content_sha256", "full_outer")
    pick = lambda c: F.when(F.col("_r").isNotNull(), F.col(f"_r.{c}")).otherwise(F.col(f"_p.{c}")) if c in given else F.col(f"_p.{c}")
    return j.select("content_sha256", *[pick(c).alias(c) for c in names]).select(projects.columns)


def set_gaps(gaps: DataFrame, built: DataFrame) -> DataFrame:
    """After builds (content_sha256, options_hash, items): counted in a row under the same options, gone where nothing is missing."""
    b = built.select("content_sha256", F.struct("options_hash", "items").alias("_b"))
    g = gaps.select("content_sha256", F.struct("options_hash", "items", "builds").alias("_g"))
    j = g.join(b, "content_sha256", "full_outer").where("_b IS NULL OR _b.items > 0")
    again = F.when(F.col("_g.options_hash") == F.col("_b.options_hash"), F.col("_g.builds") + 1).otherwise(1)
    new = F.when(F.col("_b").isNotNull(), F.struct(F.col("_b.options_hash").alias("options_hash"), F.col("_b.items").alias("items"), again.alias("builds"))).otherwise(F.col("_g"))
    return j.select("content_sha256", new.alias("x")).select("content_sha256", "x.*")


def remove(projects: DataFrame, removed: DataFrame, items: DataFrame, now: str) -> tuple[DataFrame, DataFrame]:
    """Tombstones for contents (content_sha256, name); their output's record goes."""
    rows = items.select("content_sha256", "name", F.lit(now).alias("removed"))
    return projects.join(items.select("content_sha256"), "content_sha256", "left_anti"), _put(removed, rows, ["content_sha256"])


def restore(removed: DataFrame, shas: DataFrame) -> DataFrame:
    return removed.join(shas.select("content_sha256"), "content_sha256", "left_anti")


def prune(inputs: DataFrame, sightings: DataFrame, contents: DataFrame, current: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Without missing inputs, sightings of old versions, and contents that nothing holds any more."""
    kept = inputs.where("status <> 'missing'")
    versions = kept.select(F.col("id").alias("input_id"), F.col("sha256").alias("input_sha256"))
    gone = orphans(contents, current).select("sha256")
    left = contents.join(gone, "sha256", "left_anti")
    s = sightings.join(versions, ["input_id", "input_sha256"], "left_semi").join(left.select(F.col("sha256").alias("content_sha256")), "content_sha256", "left_semi")
    return kept, s.select(sightings.columns), left


def save_rows(table: DataFrame, rows: DataFrame, *key: str) -> DataFrame:
    """Fingerprints, marks, answers: the given rows in place of those with their key."""
    return _put(table, rows, key)


def replace_settings(settings: Mapping[str, str], like: DataFrame) -> DataFrame:
    """All settings at once: the old ones go."""
    return like.sparkSession.createDataFrame(sorted(settings.items()), "key string, value string")


def rebuilt(table: DataFrame, columns: Sequence[str], **constants: str) -> DataFrame:
    """A table in another shape: columns it lacks are constants, or null."""
    made = {c: F.lit(v) for c, v in constants.items()}
    return table.select(*[F.col(c) if c in table.columns else made.get(c, F.lit(None).cast("string")).alias(c) for c in columns])


def options_hash(options: Column) -> Column:
    """16 hex digits of the sorted JSON of a map of settings."""
    rows = F.array_sort(F.map_entries(options))
    return F.substring(F.sha2(F.to_json(F.map_from_entries(rows)), 256), 1, 16)


# --- stored answers -----------------------------------------------------------------------------


def request_key(messages: Column) -> Column:
    """What an answer is stored under: a digest of the messages as JSON."""
    return F.sha2(F.to_json(messages), 256)


def stored_answers(requests: DataFrame, answers: DataFrame, replay: bool = False) -> DataFrame:
    """``requests`` (endpoint, model, key, ...) with their stored ``text``; in a replay an answer of any endpoint will do, the first one stands."""
    if not replay:
        return requests.join(answers.select("endpoint", "model", "key", "text"), ["endpoint", "model", "key"], "left")
    any_ = answers.groupBy("model", "key").agg(F.min(F.struct("endpoint", "text")).alias("a")).select("model", "key", F.col("a.text").alias("text"))
    return requests.join(any_, ["model", "key"], "left")


def usable_answers(requests: DataFrame, answers: DataFrame) -> DataFrame:
    """Stored answers; one that was cut off is asked again once the limit has grown (limit of the request, cut_limit of the answer)."""
    a = answers.select("endpoint", "model", "key", "text", "cut_limit")
    j = requests.join(a, ["endpoint", "model", "key"], "left")
    usable = F.col("cut_limit").isNull() | (F.col("limit") <= F.col("cut_limit"))
    return j.withColumn("text", F.when(usable, F.col("text"))).drop("cut_limit")


def adopt_answers(answers: DataFrame, old: DataFrame) -> DataFrame:
    """An older store's answers added to ours, by the columns both have; ours win."""
    key = ["endpoint", "model", "key"]
    new = old.join(answers.select(*key), key, "left_anti").dropDuplicates(key)
    return answers.unionByName(rebuilt(new, answers.columns))


def found_documents(current: DataFrame) -> DataFrame:
    """(content_sha256, sightings, metadata): all places of each content, and its metadata merged, key to sorted different values."""
    meta = F.from_json("metadata", "map<string,string>")
    chain = F.from_json("chain", "array<string>")
    place = F.struct("path", F.col("chain").alias("order"), "input_sha256", chain.alias("chain"), meta.alias("metadata"), (F.col("input_status") == "missing").alias("missing"))
    seen = current.groupBy("content_sha256").agg(F.array_sort(F.collect_list(F.to_json(place))).alias("sightings"))
    pairs = current.select("content_sha256", F.explode(meta).alias("k", "v")).groupBy("content_sha256", "k").agg(F.array_sort(F.collect_set("v")).alias("v"))
    merged = pairs.groupBy("content_sha256").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("k", "v")))).alias("metadata"))
    return seen.join(merged, "content_sha256", "left")
