"""What the facts of a model mean: documentation, values, labels, requirement records, item flows, package contents, ledgers, threads."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weavemine.functions import text as T
from weavemine.functions.origins import external_label
from weavemine.operators import hierarchy, threads
from weavemine.operators.model import PACKAGE_KINDS, RELATIONSHIP_KINDS, WORDING, is_section, kind
from weavemine.session import materialize

KEY = ["project", "id"]
#: Kept on diagrams by the tool itself: never shown.
DIAGRAM_INFO = "DiagramInfo"
#: What an unnamed action invokes, by precedence.
INVOKED = ("behavior", "operation", "signal", "event", "structuralFeature")
#: Relationship kinds that a requirement's line tells of, by their other end.
ENDS = ("satisfy", "verify", "refine", "trace", "allocate")


def refs_of(refs: DataFrame, role: str) -> DataFrame:
    """(project, id, target, pos): an element's references in one role."""
    return refs.where(F.col("role") == role).select("project", F.col("src").alias("id"), "target", "pos")


def children(elements: DataFrame, role: str | None = None) -> DataFrame:
    """(project, owner, id, role, pos) of known children, in one role or all."""
    owned = elements.where("owner IS NOT NULL").join(elements.select("project", F.col("id").alias("owner")), ["project", "owner"], "left_semi")
    return (owned if role is None else owned.where(F.col("role") == role)).select("project", "owner", "id", "role", "pos")


def documentation(elements: DataFrame, refs: DataFrame) -> DataFrame:
    """(project, id, doc): bodies of owned comments that annotate their owner, or nothing, a blank line between."""
    body = T.tidy(F.coalesce(F.try_element_at("attrs", F.lit("body")), F.lit("")))
    c = elements.where("role = 'ownedComment'").select("project", "id", "owner", "pos", body.alias("body")).where("body <> ''")
    said = refs_of(refs, "annotatedElement").groupBy("project", "id").agg(F.collect_set("target").alias("about"))
    c = c.join(said, KEY, "left").where("about IS NULL OR array_contains(about, owner)")
    texts = F.transform(F.array_sort(F.collect_list(F.struct("pos", "body"))), lambda x: x["body"])
    return c.groupBy("project", F.col("owner").alias("id")).agg(F.array_join(texts, "\n\n").alias("doc"))


def notes(elements: DataFrame, refs: DataFrame) -> DataFrame:
    """(project, id, note): comments owned elsewhere, by what they annotate."""
    c = elements.where(kind(F.col("type")) == "Comment").select("project", "id", "owner", F.try_element_at("attrs", F.lit("body")).alias("note")).where("note <> ''")
    return c.join(refs_of(refs, "annotatedElement"), KEY).where("owner IS NULL OR target <> owner").select("project", F.col("target").alias("id"), "note")


def value_texts(elements: DataFrame, refs: DataFrame, names: DataFrame) -> DataFrame:
    """(project, id, value) of value specifications; an expression's operands are read inside out, as deep as they go."""
    k, attr = kind(F.col("type")), lambda a: F.try_element_at("attrs", F.lit(a))
    named = names.select("project", F.col("id").alias("target"), "label")
    pointed = refs.where("role IN ('instance', 'element')").join(named, ["project", "target"], "left")
    pointed = pointed.groupBy("project", F.col("src").alias("id")).agg(F.min_by(F.coalesce("label", external_label(F.col("target"))), "pos").alias("points"))
    value = (
        F.when(k == "LiteralNull", "null").when(k.isin("LiteralInteger", "LiteralReal", "LiteralUnlimitedNatural"), F.coalesce(attr("value"), F.lit("0")))
        .when(k == "LiteralBoolean", F.coalesce(attr("value"), F.lit("false"))).when(k == "LiteralString", F.coalesce(attr("value"), F.lit("")))
        .when(k.isin("OpaqueExpression", "OpaqueBehavior"), attr("body")).when(k.isin("InstanceValue", "ElementValue"), F.col("points"))
        .when(k != "Expression", F.coalesce(attr("value"), attr("body"), F.col("name")))
    )
    rows = elements.join(pointed, KEY, "left").select("project", "id", "owner", "role", "pos", k.alias("kind"), value.alias("value"), F.coalesce(attr("symbol"), F.lit("")).alias("symbol"))
    rows = materialize(rows, "values")
    done, open_ = rows.where("kind <> 'Expression'").select("project", "id", "value"), rows.where("kind = 'Expression'").select("project", "id", "symbol")
    operands = rows.where("role = 'operand'").select("project", F.col("owner").alias("whole"), "id", "pos")
    while not open_.isEmpty():
        known = operands.join(done, KEY, "left").join(open_.select("project", "id", F.lit(True).alias("waits")), KEY, "left")
        ready = known.groupBy("project", F.col("whole").alias("id")).agg(F.max(F.coalesce("waits", F.lit(False))).alias("waits"), F.transform(F.array_sort(F.collect_list(F.struct("pos", F.coalesce("value", F.lit("")).alias("v")))), lambda x: x["v"]).alias("vs"))
        now = materialize(open_.join(ready, KEY, "left").where("waits IS NULL OR NOT waits"), "level")
        if now.isEmpty():  # operands that hold each other
            break
        vs = F.coalesce("vs", F.array().cast("array<string>"))
        told = F.when(F.col("symbol") != "", F.concat("symbol", F.lit("("), F.array_join(vs, ", "), F.lit(")"))).otherwise(F.array_join(vs, " "))
        done = done.unionByName(now.select("project", "id", told.alias("value")))
        open_ = materialize(open_.join(now.select(*KEY), KEY, "left_anti"), "open")
    return done.where("value IS NOT NULL")


def requirement_records(required: DataFrame) -> DataFrame:
    """(project, id, rid, db_id, text, title): an id that starts the text comes before the tag, which is then a database number where it differs."""
    inner = F.regexp_extract(F.coalesce("text", F.lit("")), T.LEADING_ID, 1)
    tag = F.nullif(F.trim(F.coalesce("rid", F.lit(""))), F.lit(""))
    rid = F.when(inner != "", inner).otherwise(tag)
    body = T.tidy(F.when(inner != "", F.regexp_replace("text", T.LEADING_ID, "")).otherwise(F.coalesce("text", F.lit(""))))
    return required.select("project", "id", rid.alias("rid"), F.when((inner != "") & (tag != rid), tag).alias("db_id"), body.alias("text"), T.requirement_title(F.col("name"), tag, F.col("text")).alias("title"))


def labels(elements: DataFrame, refs: DataFrame, records: DataFrame) -> DataFrame:
    """(project, id, label): a requirement's title, the name, what an unnamed action invokes, else what kind is unnamed."""
    base = elements.join(records.select("project", "id", "title"), KEY, "left")
    own = F.coalesce("title", F.nullif("name", F.lit("")))
    turn = F.array_position(F.array(*map(F.lit, INVOKED)), F.col("role"))
    target = base.select("project", F.col("id").alias("target"), F.coalesce(own, F.concat(F.lit("(unnamed "), kind(F.col("type")), F.lit(")"))).alias("there"))
    told = refs.where(F.col("role").isin(*INVOKED)).join(target, ["project", "target"], "left")
    told = told.groupBy("project", F.col("src").alias("id")).agg(F.min_by(F.coalesce("there", external_label(F.col("target"))), F.struct(turn, "pos")).alias("invokes"))
    named = base.join(told, KEY, "left")
    return named.select("project", "id", F.coalesce(own, "invokes", F.concat(F.lit("(unnamed "), kind(F.col("type")), F.lit(")"))).alias("label"))


def shown_stereotypes(applications: DataFrame) -> DataFrame:
    """(project, id, stereotypes) in order, without what the tool keeps for itself."""
    order = F.transform(F.array_sort(F.collect_list(F.struct("pos", "stereotype"))), lambda x: x["stereotype"])
    return applications.where(F.col("stereotype") != DIAGRAM_INFO).groupBy("project", F.col("base").alias("id")).agg(order.alias("stereotypes"))


def kind_words(elements: DataFrame, records: DataFrame, stereotypes: DataFrame) -> DataFrame:
    """(project, id, word): Requirement, the first shown stereotype, or the metaclass."""
    e = elements.join(records.select(*KEY, F.lit("Requirement").alias("r")), KEY, "left").join(stereotypes, KEY, "left")
    return e.select(*KEY, F.coalesce("r", F.get("stereotypes", F.lit(0)), kind(F.col("type"))).alias("word"))


def item_flows(elements: DataFrame, refs: DataFrame) -> DataFrame:
    """(project, realizer, flow, items, source, target): what connectors and associations carry; one flow may have many realizers."""
    flows = elements.where(kind(F.col("type")) == "InformationFlow").select(*KEY)
    listed = refs_of(refs, "conveyed").groupBy(*KEY).agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "target"))), lambda x: x["target"]).alias("items"))
    ends = [refs_of(refs, r).groupBy(*KEY).agg(F.min_by("target", "pos").alias(c)) for r, c in (("informationSource", "source"), ("informationTarget", "target"))]
    by = refs.where("role IN ('realizingConnector', 'realization')").select("project", F.col("src").alias("id"), F.col("target").alias("realizer"))
    out = flows.join(by, KEY).join(listed, KEY, "left")
    for e in ends:
        out = out.join(e, KEY, "left")
    return out.select("project", "realizer", F.col("id").alias("flow"), "items", "source", "target")


def _one(elements: DataFrame) -> DataFrame:
    """Elements under an id that is one across projects."""
    whole = lambda c: F.when(F.col(c).isNotNull(), F.concat_ws("|", "project", c))
    return elements.withColumns({"_id": F.col("id"), "owner": whole("owner")}).withColumn("id", whole("id"))


def sections_of_packages(elements: DataFrame, records: DataFrame) -> DataFrame:
    """(project, package, id, requirement): sections by the package they are in, none inside a nested package or a diagram."""
    e = _one(elements.join(records.select(*KEY, F.lit(True).alias("req")), KEY, "left").withColumn("req", F.coalesce("req", F.lit(False))))
    holds = kind(F.col("type")).isin(*PACKAGE_KINDS, "Diagram")
    near = hierarchy.nearest_ancestor(e.select("id", "owner", "type"), holds).select(F.col("id").alias("owner"), F.col("ancestor").alias("package"))
    inside = e.where(~holds).where(is_section(F.col("type"), F.col("role"), F.col("req"))).join(near, "owner")
    boxes = e.where(kind(F.col("type")).isin(*PACKAGE_KINDS)).select(F.col("id").alias("package"), F.col("_id").alias("_package"))
    return inside.join(boxes, "package").select("project", F.col("_package").alias("package"), F.col("_id").alias("id"), F.col("req").alias("requirement"))


def package_counts(elements: DataFrame, sections: DataFrame) -> DataFrame:
    """(project, package, elements, requirements, diagrams, row): what a package holds, and its line in a ledger."""
    held = sections.groupBy("project", "package").agg(F.count_if(~F.col("requirement")).alias("elements"), F.count_if(F.col("requirement")).alias("requirements"))
    drawn = elements.where(kind(F.col("type")) == "Diagram").groupBy("project", F.col("owner").alias("package")).agg(F.count("*").alias("diagrams"))
    p = elements.where(kind(F.col("type")).isin(*PACKAGE_KINDS)).select("project", F.col("id").alias("package"), "name")
    p = p.join(held, ["project", "package"], "left").join(drawn, ["project", "package"], "left").fillna(0, ["elements", "requirements", "diagrams"])
    some = lambda c, noun: F.when(F.col(c) > 0, T.plural(F.col(c), noun))
    parts = F.array_compact(F.array(T.plural(F.col("elements"), "element"), some("requirements", "requirement"), some("diagrams", "diagram")))
    return p.select("project", "package", "elements", "requirements", "diagrams", F.concat(F.lit("- "), F.coalesce("name", F.lit("")), F.lit(" — "), F.array_join(parts, ", ")).alias("row"))


def element_rows(elements: DataFrame, labels_: DataFrame, stereotypes: DataFrame, docs: DataFrame, n: int = 120) -> DataFrame:
    """(project, id, row): an element's line in a ledger, with the first sentence of its documentation."""
    e = elements.join(labels_, KEY).join(stereotypes, KEY, "left").join(docs, KEY, "left")
    what = F.coalesce(F.nullif(F.array_join(F.transform("stereotypes", lambda s: F.concat(F.lit("«"), s, F.lit("»"))), " "), F.lit("")), kind(F.col("type")))
    doc = F.when(F.col("doc").isNotNull(), F.concat(F.lit(" — "), T.first_sentence(F.col("doc"), n))).otherwise("")
    return e.select(*KEY, F.concat(F.lit("- "), what, F.lit(" "), F.col("label"), doc).alias("row"))


def ledger_order(rows: DataFrame) -> DataFrame:
    """``rows`` (project, package, id, rid, pos) with ``place``: by natural id where all requirements of a package have one, else as in the model."""
    w = Window.partitionBy("project", "package")
    all_ = F.min(F.coalesce("rid", F.lit("")) != "").over(w)
    keyed = rows.withColumn("_k", F.when(all_, T.natural_key(F.col("rid"))))
    return keyed.withColumn("place", F.row_number().over(w.orderBy("_k", "pos"))).drop("_k")


def requirement_threads(records: DataFrame, edges: DataFrame, labels_: DataFrame, depth: int = 4) -> DataFrame:
    """(project, root, pos, level, id, text): derivation trees of requirements, each line with what satisfies, verifies, refines it."""
    whole = lambda c: F.concat_ws("|", "project", c)
    r = records.select("project", F.col("id").alias("req"), "title", F.col("text").alias("body"))
    both = edges.where("lower(kind) = 'derivereqt'").join(r.select("project", F.col("req").alias("source")), ["project", "source"], "left_semi").join(r.select("project", F.col("req").alias("target")), ["project", "target"], "left_semi")
    walked = threads.walk(both.select(whole("target").alias("parent"), whole("source").alias("child")), r.select(whole("req").alias("id"), F.col("title").alias("name")), depth)
    verb = F.coalesce(*[F.when(F.lower("kind") == w, inverse) for w, _, inverse in WORDING if w in ENDS])
    told = edges.where(F.lower("kind").isin(*ENDS)).join(r.select("project", F.col("req").alias("target")), ["project", "target"], "left_semi")
    told = told.join(labels_.select("project", F.col("id").alias("source"), T.one_line(F.col("label")).alias("label")), ["project", "source"])
    told = told.groupBy("project", F.col("target").alias("req"), verb.alias("verb")).agg(F.array_join(F.array_sort(F.collect_list("label")), ", ").alias("ls"))
    ends = told.groupBy("project", "req").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("verb", "ls"))), lambda x: F.concat(x["verb"], F.lit(" "), x["ls"])), "; ").alias("ends"))
    lines = r.join(ends, ["project", "req"], "left").select(whole("req").alias("node"), "project", F.col("req").alias("id"), F.concat(F.lit("- "), "title", F.coalesce(F.concat(F.lit("; "), "ends"), F.lit(""))).alias("text"))
    out = walked.join(lines, "node")
    return out.select("project", F.expr("substring_index(root, '|', -1)").alias("root"), "pos", "level", "id", "text")


def catalog_type(type_: Column, is_diagram: Column, required: Column) -> Column:
    """What an element is in a catalog; null for relationships."""
    k = kind(type_)
    return F.when(k.isin(*RELATIONSHIP_KINDS), None).when(is_diagram, "diagram").when(k.isin(*PACKAGE_KINDS), "package").when(required, "requirement").otherwise("element")
