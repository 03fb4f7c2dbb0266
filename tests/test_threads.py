from weavemine.operators.threads import walk


def test_each_node_once_by_name_and_depth(spark):
    edges = [("r", "b"), ("r", "a"), ("a", "x"), ("b", "x"), ("x", "y"), ("y", "z"), ("z", "deep"), ("other", "o1"), ("k1", "k2"), ("k2", "k1")]
    names = [(n, n.upper()) for n in "r a b x y z deep other o1 k1 k2".split()]
    got = walk(spark.createDataFrame(edges, "parent string, child string"), spark.createDataFrame(names, "id string, name string")).collect()
    tree = [(r.node, r.parent, r.level) for r in sorted(got, key=lambda r: r.pos) if r.root == "r"]
    assert tree == [("r", None, 0), ("a", "r", 1), ("x", "a", 2), ("y", "x", 3), ("z", "y", 4), ("b", "r", 1)]
    assert [(r.node, r.level) for r in sorted(got, key=lambda r: r.pos) if r.root == "other"] == [("other", 0), ("o1", 1)]
    assert not [r for r in got if r.root.startswith("k")]
