"""What the tables of a model say: requirements, relationships, adjacency, uses."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Fixed values of the metamodel: section roles, package kinds, end roles by precedence, relationship kinds.
SECTION_ROLES = ("packagedElement", "ownedBehavior", "nestedClassifier", "ownedUseCase", "ownedDiagram", "nestedPackage", "ownedStereotype", "classifierBehavior")
PACKAGE_KINDS = ("Model", "Package", "Profile")
END_ROLES = (("client", "supplier"), ("source", "target"), ("informationSource", "informationTarget"), ("includingCase", "addition"), ("extension", "extendedCase"), ("specific", "general"), ("sendEvent", "receiveEvent"))
OWNER_TO = {"Generalization": ("general",), "Include": ("addition",), "Extend": ("extendedCase",), "InterfaceRealization": ("contract", "supplier"), "PackageImport": ("importedPackage", "supplier"), "ElementImport": ("importedElement", "supplier"), "ProfileApplication": ("appliedProfile", "supplier")}
RELATIONSHIP_KINDS = ("Dependency", "Abstraction", "Realization", "Usage", "Generalization", "InterfaceRealization", "Association", "AssociationClass", "Connector", "ControlFlow", "ObjectFlow", "Transition", "Include", "Extend", "InformationFlow", "Message", "PackageImport", "ElementImport", "Substitution", "ComponentRealization", "TemplateBinding", "ProfileApplication")
WORDING = (("derivereqt", "is derived from", "derived into"), ("satisfy", "satisfies", "satisfied by"), ("verify", "verifies", "verified by"), ("refine", "refines", "refined by"), ("trace", "traces to", "traced from"), ("allocate", "is allocated to", "allocated from"), ("copy", "is a copy of", "copied by"), ("generalization", "is a kind of", "specialized by"), ("include", "includes", "included by"), ("extend", "extends", "extended by"), ("realization", "realizes", "realized by"), ("interfacerealization", "realizes", "realized by"), ("usage", "uses", "used by"), ("dependency", "depends on", "depended on by"), ("abstraction", "depends on", "depended on by"))


def kind(type_: Column) -> Column:
    return F.regexp_extract(type_, r"([^:]*)$", 1)


def requirements(elements: DataFrame, applications: DataFrame) -> DataFrame:
    """(project, id, name, rid, text): classes under a stereotype named so, or tagged with Id and Text; the first application's values win."""
    tagged = F.map_contains_key("tags", "Id") & F.map_contains_key("tags", "Text")
    mine = applications.where(F.lower("stereotype").endswith("requirement") | tagged)
    first = Window.partitionBy("project", "base").orderBy("pos")
    mine = mine.withColumn("_r", F.row_number().over(first)).where("_r = 1")
    value = lambda k: F.array_join(F.try_element_at("tags", F.lit(k)), "\n")
    mine = mine.select("project", F.col("base").alias("id"), value("Id").alias("rid"), value("Text").alias("text"))
    return elements.where(kind(F.col("type")).isin("Class", "Requirement")).select("project", "id", "name").join(mine, ["project", "id"])


def is_section(type_: Column, role: Column, required: Column) -> Column:
    k = kind(type_)
    return F.when(k.isin(*RELATIONSHIP_KINDS), False).otherwise(k.isin(*PACKAGE_KINDS, "Diagram") | role.isin(*SECTION_ROLES) | required)


def relationships(elements: DataFrame, refs: DataFrame, applications: DataFrame) -> DataFrame:
    """(project, id, kind, metaclass, source, target, name): directed edges, ends by the metaclass's roles.

    The kind is the first stereotype's name, else the metaclass; of the pairs of
    end roles the first that has both ends is used.
    """
    named = Window.partitionBy("project", "base").orderBy("pos")
    st = applications.withColumn("_r", F.row_number().over(named)).where("_r = 1").select("project", F.col("base").alias("id"), "stereotype")
    e = elements.withColumn("metaclass", kind(F.col("type"))).where(F.col("metaclass").isin(*RELATIONSHIP_KINDS))
    e = e.join(st, ["project", "id"], "left").select("project", "id", "name", "owner", "metaclass", F.coalesce("stereotype", "metaclass").alias("kind"))
    r = refs.select("project", F.col("src").alias("id"), "role", "target", "pos")
    precedence = lambda pairs: F.create_map(*[F.lit(x) for i, p in enumerate(pairs) for x in (p, i)])
    owner_roles = sorted({(k, t, i) for k, ts in OWNER_TO.items() for i, t in enumerate(ts)})
    spark = elements.sparkSession
    roles = spark.createDataFrame(owner_roles, "metaclass string, role string, turn int")
    by_owner = e.join(roles, "metaclass").join(r, ["project", "id", "role"]).withColumn("source", F.col("owner"))
    ends = spark.createDataFrame([(s, t, i) for i, (s, t) in enumerate(END_ROLES)], "s_role string, t_role string, turn int")
    plain = e.where(~F.col("metaclass").isin(*OWNER_TO, "Association", "AssociationClass", "Connector"))
    left = r.select("project", "id", F.col("role").alias("s_role"), F.col("target").alias("source"))
    right = r.select("project", "id", F.col("role").alias("t_role"), "target")
    by_ends = plain.join(left, ["project", "id"]).join(ends, "s_role").join(right, ["project", "id", "t_role"])
    keep = ["project", "id", "kind", "metaclass", "source", "target", "name", "turn"]
    both = by_owner.select(keep).unionByName(by_ends.select(keep))
    both = both.withColumn("_first", F.min("turn").over(Window.partitionBy("project", "id"))).where("turn = _first").drop("turn", "_first")
    # associations: types of the two member ends; connectors: roles of the two ends they own
    typed = r.where("role = 'type'").groupBy("project", F.col("id").alias("end")).agg(F.min_by("target", "pos").alias("type"))
    member = e.where(F.col("metaclass").isin("Association", "AssociationClass")).join(r.where("role = 'memberEnd'").select("project", "id", F.col("target").alias("end"), "pos"), ["project", "id"])
    member = member.join(typed, ["project", "end"], "left").withColumn("at", F.coalesce("type", "end"))
    owned = elements.where("role = 'end'").select("project", F.col("owner").alias("id"), F.col("id").alias("end"), F.col("pos"))
    role = r.where("role = 'role'").groupBy("project", F.col("id").alias("end")).agg(F.min_by("target", "pos").alias("at"))
    connected = e.where("metaclass = 'Connector'").join(owned, ["project", "id"]).join(role, ["project", "end"], "left")
    cols = ["project", "id", "kind", "metaclass", "name", "pos", "at"]
    two = member.select(cols).unionByName(connected.select(cols)).groupBy("project", "id", "kind", "metaclass", "name").agg(F.array_sort(F.collect_list(F.struct("pos", "at"))).alias("ends"))
    two = two.where("size(ends) = 2").select("project", "id", "kind", "metaclass", F.col("ends")[0]["at"].alias("source"), F.col("ends")[1]["at"].alias("target"), "name")
    return both.unionByName(two).where("source IS NOT NULL AND source <> '' AND target IS NOT NULL AND target <> ''")


def worded_ends(edges: DataFrame) -> DataFrame:
    """(project, element, verb, other): each relationship from both of its ends, in words; by stereotype, else by metaclass."""
    words = edges.sparkSession.createDataFrame(WORDING, "word string, forward string, inverse string")
    by_kind = edges.join(words.withColumnRenamed("word", "_k"), F.lower("kind") == F.col("_k"), "left").drop("_k")
    by_kind = by_kind.join(words.toDF("_m", "_f", "_i"), F.lower("metaclass") == F.col("_m"), "left")
    out = by_kind.select("project", F.col("source").alias("element"), F.coalesce("forward", "_f", F.lower("kind")).alias("verb"), F.col("target").alias("other"))
    into = by_kind.select("project", F.col("target").alias("element"), F.coalesce("inverse", "_i", F.lower("kind")).alias("verb"), F.col("source").alias("other"))
    return out.unionByName(into)


def multiplicities(elements: DataFrame) -> DataFrame:
    """(project, id, multiplicity): lo..hi, a missing bound is 1, -1 is *, one number where both are equal."""
    bounds = elements.where(F.col("role").isin("lowerValue", "upperValue"))
    value = F.coalesce(F.try_element_at("attrs", F.lit("value")), F.when(F.col("role") == "lowerValue", "0").otherwise("1"))
    b = bounds.groupBy("project", F.col("owner").alias("id")).pivot("role", ["lowerValue", "upperValue"]).agg(F.first(value))
    lo = F.coalesce("lowerValue", F.lit("1"))
    hi = F.when(F.coalesce("upperValue", F.lit("1")).isin("-1", "*"), "*").otherwise(F.coalesce("upperValue", F.lit("1")))
    return b.select("project", "id", F.when(lo == hi, lo).otherwise(F.concat(lo, F.lit(".."), hi)).alias("multiplicity"))
