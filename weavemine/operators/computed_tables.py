"""Tables that a tool computes when it shows them: rows and columns named by a diagram's configuration, cells read from the model.

Column names are not interpreted one table at a time. They are parsed to a
(family, key) each, everything that can be read of an element is one long table
of properties by (family, key), and all cells of all tables are one join of rows
and columns with it. A column that reads nothing known is told of, not guessed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weavemine.functions import text as T
from weavemine.functions.origins import external_label
from weavemine.operators.model import kind
from weavemine.operators.semantics import DIAGRAM_INFO

AT = ["project", "table"]
#: The running number's column, an empty one, other names of two properties, and what a tool computes.
NUMBER, EMPTY = "_NUMBER_", "_EMPTY_"
ALIASES = {"name0": "name", "documentation0": "documentation"}
COMPUTED = ("Table", "Matrix", "Map")
#: Properties that stand for a relation, its kind, and whether the row is at its source.
RELATIONS = (
    ("satisfies", "satisfy", True), ("satisfiedby", "satisfy", False), ("refines", "refine", True), ("refinedby", "refine", False), ("verifies", "verify", True), ("verifiedby", "verify", False),
    ("tracedto", "trace", True), ("tracedfrom", "trace", False), ("derivedfrom", "derivereqt", True), ("derived", "derivereqt", False), ("derivedto", "derivereqt", False),
    ("allocatedto", "allocate", True), ("allocatedfrom", "allocate", False), ("master", "copy", True), ("copies", "copy", False),
)
#: Properties read of every element, before any other of their name.
SIMPLE = ("name", "documentation", "owner", "appliedStereotype", "metaclass", "qualifiedName", "multiplicity", "specification")
PROPERTY = ["project", "id", "family", "key", "n", "text", "target"]


def configuration(applications: DataFrame) -> DataFrame:
    """(project, table, tag, values): a diagram's tags; of several applications with one tag the first counts."""
    a = applications.where(F.col("stereotype") != DIAGRAM_INFO).select("project", F.col("base").alias("table"), "pos", F.explode("tags").alias("tag", "values"))
    return a.groupBy(*AT, "tag").agg(F.min_by("values", "pos").alias("values"))


def _tag(config: DataFrame, tag: str, out: str) -> DataFrame:
    """(project, table, n, out) of one tag's values in order."""
    return config.where(F.col("tag") == tag).select(*AT, F.posexplode("values").alias("n", out))


def table_rows(config: DataFrame, elements: DataFrame) -> DataFrame:
    """(project, table, id, n): the elements listed, those added by hand after the others, each once."""
    listed = _tag(config, "rowElements", "id").withColumn("part", F.lit(0)).unionByName(_tag(config, "additionalElements", "id").withColumn("part", F.lit(1)))
    first = listed.groupBy(*AT, "id").agg(F.min(F.struct("part", "n")).alias("at"))
    known = first.join(elements.select("project", "id"), ["project", "id"])
    return known.select(*AT, "id", (F.row_number().over(Window.partitionBy(*AT).orderBy("at")) - 1).alias("n"))  # one table's rows


def table_columns(config: DataFrame) -> DataFrame:
    """(project, table, col, cid) of the columns that are shown."""
    hidden = _tag(config, "hideColumns", "cid").select(*AT, "cid").distinct()
    return _tag(config, "columnIds", "cid").where(F.col("cid") != EMPTY).join(hidden, [*AT, "cid"], "left_anti").select(*AT, F.col("n").alias("col"), "cid")


def spaced(name: Column) -> Column:
    """A property's name as a header."""
    words = F.regexp_replace(name, "(?<=[a-z])(?=[A-Z])", " ")
    return F.concat(F.upper(F.substring(words, 1, 1)), F.substring(words, F.lit(2), F.char_length(words)))


def parsed_columns(columns: DataFrame, labels: DataFrame) -> DataFrame:
    """``columns`` with ``header``, ``family`` and ``key``: number, custom (never computed), slot, tag (of one stereotype), or prop, whose family its tables settle."""
    cid = F.col("cid")
    after = F.trim(F.regexp_replace(cid, "^[^:]*:", ""))
    tag = r"^QPROP:stereotypeTags:<<(?:[^>]*::)?([^>]+)>>\.(.+)$"
    alias = F.coalesce(*[F.when(cid == k, F.lit(v)) for k, v in ALIASES.items()], F.regexp_extract(cid, r"^QPROP:Element:(.*)$", 1))
    family = F.when(cid == NUMBER, "number").when(cid.startswith("CUSTOM_COLUMN:"), "custom").when(cid.startswith("IColumn:"), "slot").when(cid.rlike(tag), "tag").when(alias != "", "prop").otherwise("custom")
    key = F.when(family == "slot", after).when(family == "tag", F.concat(F.regexp_extract(cid, tag, 1), F.lit("."), F.regexp_extract(cid, tag, 2))).when(family == "prop", alias)
    x = columns.withColumns({"family": family, "key": key})
    x = x.join(labels.select("project", F.col("id").alias("key"), F.col("label").alias("_feature"), F.lit("slot").alias("family")), ["project", "family", "key"], "left")
    header = (
        F.when(F.col("family") == "number", "#").when(F.col("family") == "slot", F.coalesce("_feature", F.lit("(attribute)"))).when(F.col("family") == "tag", F.regexp_extract("cid", tag, 2))
        .when(F.col("family") == "prop", spaced(F.col("key"))).when(F.col("cid").startswith("CUSTOM_COLUMN:"), after).otherwise(F.col("cid"))
    )
    return x.select(*[c for c in columns.columns], "family", "key", header.alias("header"))


def _valued(x: DataFrame, labels: DataFrame) -> DataFrame:
    """Rows (project, id, family, key, n, value) with ``text`` and ``target``: an element by its label, other text as pages show it."""
    y = x.join(labels.select("project", F.col("id").alias("value"), "label"), ["project", "value"], "left")
    return y.select("project", "id", "family", "key", "n", F.coalesce("label", T.shown_value(F.col("value"))).alias("text"), F.when(F.col("label").isNotNull(), F.col("value")).alias("target"))


def properties(elements: DataFrame, refs: DataFrame, applications: DataFrame, relations: DataFrame, labels: DataFrame, values: DataFrame, documentation: DataFrame, stereotypes: DataFrame, qualified: DataFrame, multiplicities: DataFrame, requirements: DataFrame) -> DataFrame:
    """(project, id, family, key, n, text, target): all that a cell can read, one row a value in order.

    The other tables are those of ``model`` and ``semantics``: relations (project,
    kind, source, target), labels (label), values (value), documentation (doc),
    stereotypes (array), qualified names, multiplicities, requirements (rid, text).
    """
    base = elements.select("project", "id", "type", "name", "owner", "attrs", "pos")
    none = F.lit(None).cast("string")
    made = lambda df, key, text, target=none, n=F.lit(0), family="simple": df.select("project", "id", F.lit(family).alias("family"), F.lit(key).alias("key"), n.alias("n"), text.alias("text"), target.alias("target"))  # noqa: E731, B008
    named = base.join(labels, ["project", "id"])
    owners = base.where("owner IS NOT NULL").join(labels.select("project", F.col("id").alias("owner"), "label"), ["project", "owner"])
    specified = elements.where("role = 'specification'").select("project", F.col("owner").alias("_o"), F.col("id"), "pos").join(values, ["project", "id"]).select("project", F.col("_o").alias("id"), "pos", "value")
    out = [
        made(named, "name", F.coalesce(F.nullif("name", F.lit("")), F.col("label")), F.col("id")), made(documentation, "documentation", F.col("doc")), made(owners, "owner", F.col("label"), F.col("owner")),
        made(base, "metaclass", kind(F.col("type"))), made(qualified, "qualifiedName", F.col("qualified")), made(multiplicities, "multiplicity", F.col("multiplicity")),
        made(specified, "specification", F.col("value"), n=F.col("pos")), made(requirements, "Id", F.col("rid"), family="requirement"), made(requirements, "Text", F.col("text"), family="requirement"),
    ]
    st = stereotypes.select("project", "id", F.posexplode("stereotypes").alias("n", "s"))
    out.append(made(st, "appliedStereotype", F.col("s"), n=F.col("n")))
    spark = elements.sparkSession
    known = spark.createDataFrame(RELATIONS, "key string, kind string, out boolean")
    ends = relations.select("project", F.lower("kind").alias("kind"), F.explode(F.array(F.struct(F.lit(True).alias("out"), F.col("source").alias("id"), F.col("target").alias("value")), F.struct(F.lit(False).alias("out"), F.col("target").alias("id"), F.col("source").alias("value")))).alias("x")).select("project", "kind", "x.*")
    related = ends.join(known, ["kind", "out"]).join(labels.select("project", F.col("id").alias("value"), "label"), ["project", "value"], "left")
    related = related.withColumn("n", F.row_number().over(Window.partitionBy("project", "id", "key").orderBy("value")))  # what one element is related to
    out.append(related.select("project", "id", F.lit("relation").alias("family"), "key", "n", F.coalesce("label", external_label(F.col("value"))).alias("text"), "value"))
    tags = applications.select("project", F.col("base").alias("id"), "stereotype", (F.col("pos") * 1000).alias("pos"), F.explode("tags").alias("tag", "vs")).select("project", "id", "stereotype", "tag", "pos", F.posexplode("vs").alias("k", "value"))
    tags = tags.withColumn("n", F.col("pos") + F.col("k"))
    # two stereotypes can carry a tag of one name and value: each value once
    once = lambda df: df.groupBy("project", "id", "family", "key", "value").agg(F.min("n").alias("n"))
    long = [once(tags.select("project", "id", F.lit("tag").alias("family"), F.concat("stereotype", F.lit("."), "tag").alias("key"), "n", "value")), once(tags.select("project", "id", F.lit("anytag").alias("family"), F.col("tag").alias("key"), "n", "value"))]
    attrs = base.select("project", "id", F.explode("attrs").alias("key", "value")).select("project", "id", F.lit("attr").alias("family"), "key", F.lit(0).alias("n"), "value")
    pointed = refs.select("project", F.col("src").alias("id"), F.lit("ref").alias("family"), F.col("role").alias("key"), F.col("pos").alias("n"), F.col("target").alias("value"))
    out += [_valued(x, labels) for x in (*long, attrs, pointed)]
    slots = elements.where(kind(F.col("type")) == "Slot").select("project", F.col("id").alias("slot"), F.col("owner").alias("id"), F.col("pos").alias("at"))
    slots = slots.join(refs.where("role = 'definingFeature'").select("project", F.col("src").alias("slot"), F.col("target").alias("key")), ["project", "slot"])
    held = elements.select("project", F.col("owner").alias("slot"), F.col("id").alias("v"), F.col("pos").alias("n")).join(values.select("project", F.col("id").alias("v"), F.col("value").alias("text")), ["project", "v"])
    inst = refs.where("role = 'instance'").groupBy("project", F.col("src").alias("v")).agg(F.min_by("target", "pos").alias("target"))
    held = slots.join(held, ["project", "slot"]).join(inst, ["project", "v"], "left")
    out.append(held.select("project", "id", F.lit("slot").alias("family"), "key", "n", "text", "target"))
    every = out[0]
    for x in out[1:]:
        every = every.union(x.select(*[F.col(c) for c in x.columns]))
    return every.where("text IS NOT NULL")


def settled_columns(parsed: DataFrame, rows: DataFrame, props: DataFrame, requirements: DataFrame) -> DataFrame:
    """``parsed`` with the family of every ``prop`` column: simple, a requirement's, a relation, a tag of any element, an attribute or a reference that some row has; null where none."""
    c = F.col("key")
    squeezed = F.lower(F.replace(c, F.lit(" "), F.lit("")))
    tables = rows.join(requirements.select("project", "id"), ["project", "id"], "left_semi").select(*AT).distinct().withColumn("_req", F.lit(True))
    anywhere = props.where("family = 'anytag'").select("project", "key").distinct().withColumn("_tag", F.lit(True))
    keyed = parsed.where("family = 'prop'").select(*AT, "key").distinct()
    of_rows = rows.join(keyed, AT).join(props.where("family IN ('attr', 'ref')").select("project", "id", "family", "key").distinct().withColumnRenamed("family", "_has"), ["project", "id", "key"])
    of_rows = of_rows.groupBy(*AT, "key").agg(F.min("_has").alias("_has"))  # attributes come before references
    x = parsed.join(tables, AT, "left").join(anywhere, ["project", "key"], "left").join(of_rows, [*AT, "key"], "left")
    family = (
        F.when(F.col("family") != "prop", F.nullif("family", F.lit("custom"))).when(c.isin(*SIMPLE), "simple").when(c.isin("Id", "Text") & F.col("_req"), "requirement")
        .when(squeezed.isin(*[k for k, *_ in RELATIONS]), "relation").when(F.col("_tag"), "anytag").otherwise(F.col("_has"))
    )
    key = F.when((F.col("family") == "prop") & (family == "relation"), squeezed).otherwise(c)
    return x.select(*AT, "col", "cid", "header", family.alias("family"), key.alias("key"))


def computed(config: DataFrame, elements: DataFrame, labels: DataFrame, props: DataFrame, requirements: DataFrame) -> DataFrame:
    """(project, table, row, id, col, header, text): all cells of all tables; a cell's values are joined by semicolons, one without a value is ''.

    Rows come in the order of the column a table is sorted by, as people read
    numbers in text, else as listed. Columns that cannot be read are left out
    (``not_computed`` has them); a table without rows or columns has no cells.
    """
    rows = table_rows(config, elements)
    known = labels.select("project", "id", "label")
    sort = _tag(config, "sort", "spec").where("n = 0 AND spec <> ''").select(*AT, F.lit(-1).alias("col"), F.substring_index("spec", "^", 1).alias("cid"), F.lower(F.regexp_extract("spec", r"\^(.*)$", 1)).startswith("desc").alias("down"))
    columns = table_columns(config)
    parsed = parsed_columns(columns.unionByName(sort.select(*AT, "col", "cid")), known)
    cols = settled_columns(parsed, rows, props, requirements).where("family IS NOT NULL")
    there = columns.select(*AT).distinct()
    grid = rows.join(there, AT, "left_semi").join(cols, AT)
    said = props.select("project", "id", "family", "key", F.struct("n", "text").alias("v"))
    cells = grid.join(said, ["project", "id", "family", "key"], "left").groupBy(*AT, "id", "n", "col", "header", "family").agg(F.array_join(F.transform(F.filter(F.array_sort(F.collect_list("v")), lambda v: v["text"] != ""), lambda v: v["text"]), "; ").alias("text"))
    keys = cells.where("col = -1 AND family <> 'number'").join(sort.select(*AT, "down"), AT).select(*AT, "id", F.col("text").alias("_by"), "down")
    placed = rows.join(there, AT, "left_semi").join(keys, [*AT, "id"], "left").withColumn("_k", T.natural_key(F.col("_by")))
    order = Window.partitionBy(*AT)
    up, down = F.row_number().over(order.orderBy("_k", "n")), F.row_number().over(order.orderBy(F.desc("_k"), "n"))
    placed = placed.select(*AT, "id", F.when(F.coalesce("down", F.lit(False)), down).otherwise(up).alias("row"))
    out = cells.where("col >= 0").join(placed, [*AT, "id"])
    return out.select(*AT, "row", "id", "col", "header", F.when(F.col("family") == "number", F.col("row").cast("string")).otherwise(F.col("text")).alias("text"))


def not_computed(config: DataFrame, elements: DataFrame, labels: DataFrame, props: DataFrame, requirements: DataFrame) -> DataFrame:
    """(project, table, col, header) of columns that only the tool can compute."""
    parsed = parsed_columns(table_columns(config), labels.select("project", "id", "label"))
    return settled_columns(parsed, table_rows(config, elements), props, requirements).where("family IS NULL").select(*AT, "col", "header")


def reasons(diagrams: DataFrame, config: DataFrame, elements: DataFrame) -> DataFrame:
    """(project, table, reason) of tables, matrices and maps (project, id, diagram_type) that have no cells: a matrix, a map, no columns, rows from scope, no rows."""
    d = diagrams.select("project", F.col("id").alias("table"), F.coalesce("diagram_type", F.lit("")).alias("t"))
    d = d.where(F.greatest(*[F.col("t").contains(w) for w in COMPUTED]))
    mark = lambda df, name: df.select(*AT).distinct().withColumn(name, F.lit(True))
    scope = _tag(config, "scope", "id").join(elements.select("project", "id"), ["project", "id"])
    d = d.join(mark(_tag(config, "columnIds", "cid"), "_cols"), AT, "left").join(mark(table_rows(config, elements), "_rows"), AT, "left").join(mark(scope, "_scope"), AT, "left")
    why = (
        F.when(~F.col("t").contains("Table"), F.when(F.col("t").contains("Matrix"), "a matrix").otherwise("a map")).when(F.col("_cols").isNull(), "no columns")
        .when(F.col("_rows").isNotNull(), None).when(F.col("_scope").isNotNull(), "rows from scope").otherwise("no rows")
    )
    return d.select(*AT, why.alias("reason")).where("reason IS NOT NULL")
