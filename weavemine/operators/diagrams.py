"""A diagram's drawing as a graph: numbered shapes, what sits on them, and the connections between them.

All diagrams of all projects are one table of views (``sources.layouts``); each
operator is a few joins on (project, stream).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weavemine.operators.hierarchy import nearest_ancestor, tree_depths
from weavemine.session import materialize

AT = ["project", "stream"]
#: Views that only decorate others, those on the border of their owner, and kinds of connections that have a direction.
DECORATION = ("TextBox", "TextBoxWithIcon", "ConnectorEnd", "Role", "NoteAnchor", "DiagramShape", "FlowConnector", "AssociationTextBox", "MessageSignature", "DiagramFrame")
ATTACHED = ("Pin", "Port", "ParameterNode", "ObjectNode")
DIRECTED = (
    "ControlFlow", "ObjectFlow", "Dependency", "Abstraction", "Realization", "Usage", "Include", "Extend", "Generalization",
    "InformationFlow", "Transition", "FlowConnector", "Message", "InterfaceRealization", "Containment",
)
CIRCLE = "FlowConnector"


def is_path() -> Column:
    return (F.coalesce(F.size("points"), F.lit(0)) > 0) | F.col("first").isNotNull()


def _node_key(view: str = "view") -> Column:
    return F.concat_ws("\0", "project", "stream", view)


def placed(views: DataFrame) -> DataFrame:
    """(project, stream, view, pos, role, on): what views stand for: a ``shape``, or a ``pin`` on the shape ``on``.

    Shapes show an element or a text and are no paths, decorations or frames. One
    of an attached kind whose owner is a shape is a pin on it; an owner that is
    itself a pin holds shapes again.
    """
    v = views.where("view IS NOT NULL")
    shown = v.where(~is_path() & ~F.col("class").isin(*DECORATION) & ((F.coalesce("element", F.lit("")) != "") | (F.coalesce("text", F.lit("")) != "")))
    shown = materialize(shown.select(*AT, "view", "pos", "parent", F.col("class").isin(*ATTACHED).alias("loose")), "shown")
    owners = shown.select(*AT, F.col("view").alias("parent"), F.col("loose").alias("on_loose"))
    x = shown.join(owners, [*AT, "parent"], "left")
    # Along a run of attached kinds pins and shapes take turns, from the first one down.
    key, up = _node_key(), F.when(F.col("loose") & F.col("on_loose"), _node_key("parent"))
    turns = tree_depths(x.where("loose").select(key.alias("id"), up.alias("owner"))).select(F.col("id").alias("_key"), F.col("depth").alias("turn"))
    x = x.withColumn("_key", key).join(turns, "_key", "left").drop("_key")
    heads = x.where("loose").select(_node_key().alias("id"), F.when(F.col("on_loose"), _node_key("parent")).alias("owner"), F.col("on_loose").isNotNull().alias("held"))
    top = nearest_ancestor(heads.withColumn("head", F.col("owner").isNull()), F.col("head")).select(F.col("id").alias("_key"), F.col("ancestor").alias("_head"))
    held = heads.select(F.col("id").alias("_head"), "held")
    x = x.withColumn("_key", _node_key()).join(top.join(held, "_head").drop("_head"), "_key", "left").drop("_key")
    first = F.when(F.col("held"), F.lit(0)).otherwise(F.lit(1))  # a head on no shape is one itself
    pin = F.col("loose") & ((F.col("turn") + first) % 2 == 0)
    return x.select(*AT, "view", "pos", F.when(F.coalesce(pin, F.lit(False)), "pin").otherwise("shape").alias("role"), F.when(pin, F.col("parent")).alias("on"))


def shapes(views: DataFrame, at: DataFrame | None = None) -> DataFrame:
    """(project, stream, view, num, parent, depth): shapes numbered in the layout's order, the number of the one each is nested in, and how deep."""
    at = placed(views) if at is None else at
    at = materialize(at, "placed")
    num = Window.partitionBy(*AT).orderBy("pos", "view")
    n = materialize(at.where("role = 'shape'").withColumn("num", F.row_number().over(num)), "numbered")
    own = at.select(*AT, "view", F.coalesce("on", "view").alias("stands"))
    tree = views.where("view IS NOT NULL").select(*AT, "view", "parent").join(own, [*AT, "view"], "left")
    # Above a shape: its nearest owner that is a shape or a pin, and then the shape this stands for.
    up = nearest_ancestor(tree.select(_node_key().alias("id"), _node_key("parent").alias("owner"), F.col("stands").isNotNull().alias("good")), F.col("good"))
    above = tree.select(*AT, "view", "parent").join(up.select(F.col("id").alias("_p"), F.col("ancestor").alias("_a")), F.concat_ws("\0", "project", "stream", "parent") == F.col("_p"))
    above = above.join(own.select(F.concat_ws("\0", "project", "stream", "view").alias("_a"), "stands"), "_a").select(*AT, "view", "stands")
    numbers = n.select(*AT, F.col("view").alias("stands"), F.col("num").alias("parent"))
    x = n.select(*AT, "view", "num").join(above.join(numbers, [*AT, "stands"]).drop("stands"), [*AT, "view"], "left")
    x = materialize(x, "nested")
    key = lambda c: F.concat_ws("\0", "project", "stream", F.col(c).cast("string"))
    depth = tree_depths(x.select(key("num").alias("id"), F.when(F.col("parent").isNotNull(), key("parent")).alias("owner")))
    return x.withColumn("_k", key("num")).join(depth.select(F.col("id").alias("_k"), "depth"), "_k", "left").select(*AT, "view", "num", "parent", "depth")


def end_ids(views: DataFrame, at: DataFrame, types: DataFrame) -> DataFrame:
    """(project, stream, view, ids): elements that an end at this view may be named by: its own, that of the shape it sits on, and their types (project, id, type)."""
    e = views.select(*AT, "view", "element")
    both = at.select(*AT, "view", F.explode(F.array_distinct(F.array_compact(F.array("view", "on")))).alias("of")).join(e.select(*AT, F.col("view").alias("of"), "element").where("element IS NOT NULL"), [*AT, "of"])
    typed = both.join(types.select("project", F.col("id").alias("element"), "type"), ["project", "element"], "left")
    return typed.groupBy(*AT, "view").agg(F.array_distinct(F.flatten(F.collect_list(F.array_compact(F.array("element", "type"))))).alias("ids"))


def _with_ids(x: DataFrame, ids: DataFrame, view: str, out: str) -> DataFrame:
    none = F.array().cast("array<string>")
    return x.join(ids.select(*AT, F.col("view").alias(view), F.col("ids").alias(out)), [*AT, view], "left").withColumn(out, F.coalesce(out, none))


def _has(ids: str, value: Column) -> Column:
    return F.coalesce(F.array_contains(F.col(ids), value), F.lit(False))


def drawn_links(views: DataFrame, ids: DataFrame, relations: DataFrame) -> DataFrame:
    """(project, stream, pos, element, view, more, source, target, directed, at_first): the connections drawn, each once.

    A path runs from its first to its second view. A directed one is stored the
    other way round, target first, unless the model's relation (project, element,
    kind, from, to) has its ends in that order. A flow drawn in two halves, each
    ending at a connector circle, is one connection: ``view`` is the half that
    reaches the target and ``more`` the other. The relation says which end is the
    target; without one it is the end of the half that begins at a shape, if one
    only does, else of the later half. ``at_first``: the target is at the first point.
    A flow in any other number of halves stays as it is drawn.
    """
    paths = views.where(is_path() & (F.col("first").isNotNull() | F.col("second").isNotNull())).select(*AT, "pos", "view", "class", "element", "first", "second")
    circles = views.where(F.col("class") == CIRCLE).select(*AT, "view", F.lit(True).alias("circle"))
    mark = lambda c: circles.select(*AT, F.col("view").alias(c), F.col("circle").alias(f"{c}_circle"))
    p = paths.join(mark("first"), [*AT, "first"], "left").join(mark("second"), [*AT, "second"], "left").na.fill(False, ["first_circle", "second_circle"])
    p = materialize(p, "paths")
    half = p.where("coalesce(element, '') <> '' AND (first_circle OR second_circle)")
    half = half.withColumn("half", F.struct("pos", "view", "class", F.when(F.col("first_circle"), F.col("second")).otherwise(F.col("first")).alias("end"), (~F.col("first_circle")).alias("begins")))
    pairs = half.groupBy(*AT, "element").agg(F.array_sort(F.collect_list("half")).alias("x")).where("size(x) = 2").select(*AT, "element", F.col("x")[0].alias("a"), F.col("x")[1].alias("b"))
    pairs = materialize(pairs, "pairs")
    rel = relations.select("project", "element", F.col("kind").alias("r_kind"), F.col("from").alias("r_from"), F.col("to").alias("r_to"))
    x = pairs.withColumn("end_a", F.col("a.end")).withColumn("end_b", F.col("b.end")).join(rel, ["project", "element"], "left")
    x = _with_ids(_with_ids(x, ids, "end_a", "ids_a"), ids, "end_b", "ids_b")
    to_a = _has("ids_a", F.col("r_to")) & _has("ids_b", F.col("r_from"))
    to_b = _has("ids_b", F.col("r_to")) & _has("ids_a", F.col("r_from"))
    last = F.when(to_a, F.col("a")).when(to_b, F.col("b")).when(F.col("a.begins") & ~F.col("b.begins"), F.col("a")).otherwise(F.col("b"))
    x = x.withColumn("last", last).withColumn("rest", F.when(F.col("last.pos") == F.col("a.pos"), F.col("b")).otherwise(F.col("a")))
    joined = x.select(*AT, F.col("a.pos").alias("pos"), "element", F.col("last.view").alias("view"), F.col("rest.view").alias("more"), F.col("rest.end").alias("source"), F.col("last.end").alias("target"), (F.col("last.class").isin(*DIRECTED) | F.coalesce(F.col("r_kind").isin(*DIRECTED), F.lit(False))).alias("directed"), F.col("last.begins").alias("at_first"))
    whole = p.join(pairs.select(*AT, "element", F.lit(True).alias("_paired")), [*AT, "element"], "left").where("_paired IS NULL OR NOT (first_circle OR second_circle)").join(rel, ["project", "element"], "left")
    shows = views.where("view IS NOT NULL").select(*AT, "view", F.col("element").alias("shown"))
    whole = whole.join(shows.toDF(*AT, "first", "first_shows"), [*AT, "first"], "left").join(shows.toDF(*AT, "second", "second_shows"), [*AT, "second"], "left")
    directed = F.col("class").isin(*DIRECTED) | F.coalesce(F.col("r_kind").isin(*DIRECTED), F.lit(False))
    in_order = F.coalesce((F.col("first_shows") == F.col("r_from")) & (F.col("second_shows") == F.col("r_to")), F.lit(False))
    turned = directed & ~in_order
    end = lambda a, b: F.when(turned, F.col(b)).otherwise(F.col(a))
    whole = whole.select(*AT, "pos", "element", "view", F.lit(None).cast("string").alias("more"), end("first", "second").alias("source"), end("second", "first").alias("target"), directed.alias("directed"), turned.alias("at_first"))
    return joined.unionByName(whole)


def conveyed(links: DataFrame, ids: DataFrame, flows: DataFrame) -> DataFrame:
    """``links`` with ``items``, an array of (names, way): what item flows (project, element, pos, source, target, names) convey over each, and which way.

    A flow runs forward if its source is named at the connection's source or its
    target at the target, back if crosswise, else no way is known. A connection
    without a direction over which all that is conveyed runs back is turned round.
    """
    x = links.join(flows.select("project", "element", F.col("pos").alias("_n"), F.col("source").alias("f_from"), F.col("target").alias("f_to"), "names"), ["project", "element"])
    x = _with_ids(_with_ids(x, ids, "source", "ids_s"), ids, "target", "ids_t")
    forward = _has("ids_s", F.col("f_from")) | _has("ids_t", F.col("f_to"))
    back = _has("ids_t", F.col("f_from")) | _has("ids_s", F.col("f_to"))
    x = x.withColumn("item", F.struct("_n", "names", F.when(forward, "→").when(back, "←").otherwise("").alias("way")))
    g = x.groupBy(*AT, "view").agg(F.array_sort(F.collect_list("item")).alias("_items"), F.bool_and(F.col("item.way") == "←").alias("_back"))
    y = links.join(g, [*AT, "view"], "left").withColumn("_turn", ~F.col("directed") & F.coalesce("_back", F.lit(False)))
    way = lambda i: F.when(F.col("_turn"), "→").otherwise(i["way"])
    items = F.coalesce(F.transform("_items", lambda i: F.struct(i["names"].alias("names"), way(i).alias("way"))), F.array().cast("array<struct<names:string,way:string>>"))
    swap = lambda a, b: F.when(F.col("_turn"), F.col(b)).otherwise(F.col(a))
    y = y.select("*", items.alias("items"), swap("source", "target").alias("_s"), swap("target", "source").alias("_t"))
    return y.withColumns({"source": F.col("_s"), "target": F.col("_t"), "at_first": F.col("at_first") != F.col("_turn")}).drop("_items", "_back", "_turn", "_s", "_t")


def trivial(numbered: DataFrame, links: DataFrame) -> DataFrame:
    """(project, stream) of diagrams with shapes, too little to describe: fewer than 3 shapes, unless 2 that have a connection."""
    n = numbered.groupBy(*AT).agg(F.count("*").alias("n"))
    joined = links.select(*AT).distinct().withColumn("joined", F.lit(True))
    return n.join(joined, AT, "left").where("n < 3 AND NOT (n = 2 AND joined IS NOT NULL)").select(*AT)


def drawing_order(numbered: DataFrame, views: DataFrame) -> DataFrame:
    """(project, stream, view, num, place): shapes with a rectangle, from 1, outer before inner and large before small, then by number."""
    r = numbered.join(views.where("x IS NOT NULL").select(*AT, "view", (F.col("w") * F.col("h")).alias("area")), [*AT, "view"])
    return r.withColumn("place", F.row_number().over(Window.partitionBy(*AT).orderBy("depth", F.desc("area"), "num"))).select(*AT, "view", "num", "place")


def held_inside(used: DataFrame, views: DataFrame, elements: DataFrame, levels: int = 3) -> DataFrame:
    """(project, stream, element, holder): what a diagram uses (project, stream, element) but does not draw, by the drawn element that owns it.

    Owners are followed up to ``levels`` of ``elements`` (project, id, owner); ``holder`` is null where none is drawn.
    """
    drawn = views.where("element IS NOT NULL").select(*AT, F.col("element")).distinct()
    own = elements.select("project", F.col("id").alias("up"), "owner")
    x = used.select(*AT, "element").distinct().join(drawn, [*AT, "element"], "left_anti").withColumn("up", F.col("element")).withColumn("holder", F.lit(None).cast("string"))
    hit = drawn.select(*AT, F.col("element").alias("up"), F.lit(True).alias("hit"))
    for _ in range(levels):
        x = x.join(own, ["project", "up"], "left").drop("up").withColumnRenamed("owner", "up").join(hit, [*AT, "up"], "left")
        x = x.withColumn("holder", F.coalesce("holder", F.when(F.col("hit"), F.col("up")))).drop("hit")
    return x.select(*AT, "element", "holder")
