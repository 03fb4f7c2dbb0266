"""What events, triggers, guards and flows say, and what describes an element that has no name.

All take the facts of ``sources.archives`` and the tables of ``semantics``
(labels, values), keyed by (project, id); texts that are empty are null.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weavemine.functions import text as T
from weavemine.functions.origins import external_label
from weavemine.operators.model import kind

KEY = ["project", "id"]
CONSTRAINTS = ("Constraint", "InteractionConstraint")
#: The most characters of a text that stands for a name.
SHORT = 80


def _said(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def first_children(elements: DataFrame, role: str, out: str) -> DataFrame:
    """(project, id, out): each element's first child in a role."""
    c = elements.where(F.col("role") == role).where("owner IS NOT NULL")
    return c.groupBy("project", F.col("owner").alias("id")).agg(F.min_by(F.col("id"), "pos").alias(out))


def first_refs(refs: DataFrame, role: str, out: str) -> DataFrame:
    """(project, id, out): what each element refers to first in a role."""
    return refs.where(F.col("role") == role).groupBy("project", F.col("src").alias("id")).agg(F.min_by("target", "pos").alias(out))


def _looked_up(x: DataFrame, table: DataFrame, key: str, value: str, out: str) -> DataFrame:
    return x.join(table.select("project", F.col("id").alias(key), F.col(value).alias(out)), ["project", key], "left")


def _named(x: DataFrame, labels: DataFrame, key: str, out: str) -> DataFrame:
    """``x`` with the label of what ``key`` refers to; outside the project the reference's own."""
    y = _looked_up(x, labels, key, "label", "_label")
    return y.withColumn(out, F.when(F.col(key).isNotNull(), F.coalesce("_label", external_label(F.col(key))))).drop("_label")


def specified_values(elements: DataFrame, values: DataFrame, role: str, out: str) -> DataFrame:
    """(project, id, out): the value of the first child in a role, or, where that is a constraint, of what specifies it."""
    child = first_children(elements, role, "_c")
    kinds = elements.select("project", F.col("id").alias("_c"), kind(F.col("type")).isin(*CONSTRAINTS).alias("_bound"))
    inner = first_children(elements, "specification", "_s").withColumnRenamed("id", "_c")
    at = child.join(kinds, ["project", "_c"]).join(inner, ["project", "_c"], "left").withColumn("_v", F.when(F.col("_bound"), F.col("_s")).otherwise(F.col("_c")))
    return _looked_up(at, values, "_v", "value", out).select(*KEY, _said(F.col(out)).alias(out))


def event_texts(elements: DataFrame, refs: DataFrame, labels: DataFrame, values: DataFrame) -> DataFrame:
    """(project, id, event): an event's name, else the signal or operation it receives, the change it waits for, or its time; null where none tells."""
    e = elements.where(kind(F.col("type")).endswith("Event")).select(*KEY, "name", kind(F.col("type")).alias("kind"), F.try_element_at("attrs", F.lit("isRelative")).alias("relative"))
    for role in ("signal", "operation"):
        e = _named(e.join(first_refs(refs, role, "_t"), KEY, "left"), labels, "_t", role).drop("_t")
    e = e.join(specified_values(elements, values, "changeExpression", "change"), KEY, "left")
    when, expr = first_children(elements, "when", "_w"), first_children(elements, "expr", "_e").withColumnRenamed("id", "_w")
    time = _looked_up(_looked_up(when.join(expr, ["project", "_w"], "left"), values, "_e", "value", "by_expr"), values, "_w", "value", "by_when")
    e = e.join(time.select(*KEY, F.coalesce(_said(F.col("by_expr")), _said(F.col("by_when"))).alias("time")), KEY, "left")
    waits = F.when(F.col("kind") == "ChangeEvent", F.concat(F.lit("when "), "change")).when(F.col("kind") == "TimeEvent", F.concat(F.when(F.col("relative") == "true", "after ").otherwise("at "), "time"))
    return e.select(*KEY, F.coalesce(_said(F.col("name")), _said(F.col("signal")), _said(F.col("operation")), waits).alias("event"))


def trigger_texts(elements: DataFrame, refs: DataFrame, events: DataFrame) -> DataFrame:
    """(project, id, trigger) of elements in the role of a trigger: its event's text where it refers to one, else its name."""
    t = elements.where("role = 'trigger'").select(*KEY, "owner", "pos", "name").join(first_refs(refs, "event", "_e"), KEY, "left")
    t = _looked_up(t, events, "_e", "event", "event")
    return t.select(*KEY, "owner", "pos", F.when(F.col("_e").isNotNull(), F.col("event")).otherwise(_said(F.col("name"))).alias("trigger"))


def flow_labels(elements: DataFrame, values: DataFrame, triggers: DataFrame) -> DataFrame:
    """(project, id, flow): ``trigger, trigger [guard] / effect`` of elements that have any of them."""
    fired = triggers.where("trigger IS NOT NULL").groupBy("project", F.col("owner").alias("id")).agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "trigger"))), lambda x: x["trigger"]).alias("_t"))
    guard = specified_values(elements, values, "guard", "guard")
    effect = first_children(elements, "effect", "_x")
    names = elements.select("project", F.col("id").alias("_x"), "name")
    effect = _looked_up(effect.join(names, ["project", "_x"], "left"), values, "_x", "value", "_v").select(*KEY, F.coalesce(_said(F.col("name")), _said(F.col("_v"))).alias("effect"))
    x = fired.join(guard, KEY, "full").join(effect, KEY, "full")
    parts = F.array_compact(F.array(F.array_join("_t", ", "), F.concat(F.lit("["), "guard", F.lit("]")), F.concat(F.lit("/ "), "effect")))
    return x.select(*KEY, F.array_join(parts, " ").alias("flow")).where("flow <> ''")


def described(elements: DataFrame, refs: DataFrame, labels: DataFrame, values: DataFrame, triggers: DataFrame) -> DataFrame:
    """(project, id, described): what an element without a name says it is; no row where nothing does.

    In order: the part it represents (with its type), an opaque action's body, the
    first event it accepts, a comment's text in quotes, its value, its invariant.
    """
    x = elements.select(*KEY, kind(F.col("type")).alias("kind"), F.try_element_at("attrs", F.lit("body")).alias("body"))
    x = _named(x.join(first_refs(refs, "represents", "_p"), KEY, "left"), labels, "_p", "part")
    parts = elements.select("project", F.col("id").alias("_p"), _said(F.col("name")).alias("part_name"))
    typed = _named(first_refs(refs, "type", "_y"), labels, "_y", "part_type").select("project", F.col("id").alias("_p"), "part_type")
    x = x.join(parts, ["project", "_p"], "left").join(typed, ["project", "_p"], "left")
    stands = F.when(F.col("part_type").isNotNull(), F.concat_ws(" : ", "part_name", "part_type")).otherwise(F.col("part"))
    accepted = triggers.where("trigger IS NOT NULL").groupBy("project", F.col("owner").alias("id")).agg(F.min_by("trigger", "pos").alias("accepts"))
    x = x.join(accepted, KEY, "left")
    for role in ("value", "invariant"):
        x = x.join(specified_values(elements, values, role, role), KEY, "left")
    short = lambda c: T.clip(c, SHORT)
    quoted = F.concat(F.lit('"'), short(F.trim("body")), F.lit('"'))
    body = _said(F.col("body"))
    told = (
        F.when(F.col("_p").isNotNull(), stands).when(F.col("kind") == "OpaqueAction", F.coalesce(short(body), F.lit(""))).when(F.col("accepts").isNotNull(), F.col("accepts"))
        .when(F.col("kind") == "Comment", F.when(body.isNotNull(), quoted).otherwise("")).otherwise(short(F.coalesce("value", "invariant")))
    )
    return x.select(*KEY, told.alias("described")).where("described <> ''")


def full_labels(elements: DataFrame, labels: DataFrame, described_: DataFrame) -> DataFrame:
    """(project, id, label): ``labels``, with what describes an element in place of the words that it is unnamed."""
    unnamed = F.concat(F.lit("(unnamed "), kind(F.col("type")), F.lit(")"))
    x = elements.select(*KEY, unnamed.alias("_none")).join(labels, KEY).join(described_, KEY, "left")
    return x.select(*KEY, F.when(F.col("label") == F.col("_none"), F.coalesce("described", "label")).otherwise(F.col("label")).alias("label"))
