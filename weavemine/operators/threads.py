"""Trees over edges: requirement threads and type hierarchies.

A component of the edges (no larger than what its roots reach) is walked as
one piece of work, because which path reaches a node first is decided by the
whole walk before it.
"""

from __future__ import annotations

from collections import defaultdict

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weavemine.operators.components import connected_components


def walk(edges: DataFrame, names: DataFrame, depth: int = 4, least: int = 2) -> DataFrame:
    """(root, node, parent, level, pos): depth-first trees from nodes without parents, children by name, each node once a tree.

    ``edges`` has (parent, child), ``names`` (id, name). Trees of fewer than ``least`` nodes are left out.
    """
    e = edges.select("parent", "child").where("parent <> child").distinct()
    part = connected_components(e, "parent", "child").toDF("parent", "component")
    rows = e.join(part, "parent").join(names.select(F.col("id").alias("child"), F.col("name").alias("child_name")), "child", "left")
    rows = rows.join(names.select(F.col("id").alias("parent"), F.col("name").alias("parent_name")), "parent", "left")
    kind = edges.schema["parent"].dataType.simpleString()

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        below, name, inner = defaultdict(list), {}, set(pdf["child"])
        for p, c, cn, pn in zip(pdf["parent"], pdf["child"], pdf["child_name"], pdf["parent_name"]):
            below[p].append(c)
            name[c], name[p] = cn or "", pn or ""
        key = lambda x: (name[x], str(x))
        out = []
        for root in sorted((p for p in list(below) if p not in inner), key=key):
            seen, tree, stack = {root}, [], [(root, None, 0)]
            while stack:
                node, parent, level = stack.pop()
                if parent is not None and node in seen:
                    continue
                seen.add(node)
                tree.append((root, node, parent, level, len(tree)))
                if level < depth:
                    stack += [(c, node, level + 1) for c in sorted(below.get(node, ()), key=key, reverse=True)]
            if len(tree) >= least:
                out += tree
        return pd.DataFrame(out, columns=["root", "node", "parent", "level", "pos"]).astype({"level": "int32", "pos": "int32"})

    return rows.groupBy("component").applyInPandas(run, f"root {kind}, node {kind}, parent {kind}, level int, pos int")
