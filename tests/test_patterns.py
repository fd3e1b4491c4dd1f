"""Frequent patterns of graphs with hubs, whose sets of edges are too many to list."""

import json
from itertools import permutations

from pyspark.sql import functions as F

from lodegraph.operators import flowgraph as fg


def test_patterns_of_a_hub(spark):
    """A node with 3,000 successors holds 4.5e9 sets of three edges, but three patterns."""
    n = 3000
    e = spark.range(1, 2 * n + 1).select((F.col("id") % 2).alias("graph_id"), F.lit("hub").alias("src"), F.concat(F.lit("n"), "id").alias("dst"), F.lit("h").alias("src_label"), F.lit("x").alias("dst_label"))
    rows = {(r.pattern, r.n_edges, r.support) for r in fg.frequent_patterns(e, 2, 3).collect()}
    assert rows == {('["h", "x"] 0>1', 1, 2), ('["h", "x", "x"] 0>1 0>2', 2, 2), ('["h", "x", "x", "x"] 0>1 0>2 0>3', 3, 2)}


def test_patterns_of_four_edges(spark):
    """Beyond three edges: a path of five edges holds one pattern of each size, its reverse counts as another graph."""
    es = [("g", f"n{i}", f"n{i + 1}") for i in range(5)] + [("r", f"n{i + 1}", f"n{i}") for i in range(5)]
    e = spark.createDataFrame([(g, s, d, "a", "a") for g, s, d in es], "graph_id string, src string, dst string, src_label string, dst_label string")
    got = sorted((r.n_edges, r.support, json.loads(r.pattern[: r.pattern.rindex("]") + 1])) for r in fg.frequent_patterns(e, 2, 5).collect())
    assert got == [(n, 2, ["a"] * (n + 1)) for n in range(1, 6)]


def test_canonical_text_is_the_least_of_all_orders():
    for nodes in (("b", "a", "b", "a"), ("a", "a", "a", "a"), ("c", "b", "a", "b"), ("a",)):
        edges = tuple((i, (i + 1) % len(nodes)) for i in range(min(3, len(nodes))))
        labels, least = min((tuple(nodes[i] for i in p), sorted((p.index(a), p.index(b)) for a, b in edges)) for p in permutations(range(len(nodes))))
        assert fg._canonical(nodes, edges) == json.dumps(labels) + "".join(f" {a}>{b}" for a, b in least)
