"""Flow graphs of more edges than were accepted before (200,000)."""

import random
import time

import pytest
from pyspark.sql import functions as F

from lodegraph.operators import flowgraph as fg

N = 200_001


@pytest.fixture(scope="module")
def chain(spark):
    """0 > 1 > ... > N, and back from N to N - 1."""
    name = lambda i: F.lpad(i.cast("string"), 7, "0")
    e = spark.range(N).select(F.lit("P").alias("graph_id"), name(F.col("id")).alias("src"), name(F.col("id") + 1).alias("dst"))
    back = spark.range(1).select(F.lit("P").alias("graph_id"), name(F.lit(N)).alias("src"), name(F.lit(N - 1)).alias("dst"))
    return e.unionByName(back).withColumn("root", name(F.lit(0)))


def test_dominators_of_a_large_graph(chain):
    rows = fg.dominator_table(chain).collect()
    assert len(rows) == N + 1 and all(r.idom == (f"{int(r.id) - 1:07}" if int(r.id) else None) for r in rows)


def test_edge_kinds_of_a_large_graph(chain):
    got = {r.kind: r["count"] for r in fg.classify_edges(chain, fg.dfs_table(chain)).groupBy("kind").count().collect()}
    assert got == {"tree": N, "back": 1}


def test_limit_of_a_large_graph(chain):
    assert [tuple(r) for r in fg.reducibility(chain).collect()] == [("P", 1, True)]


def test_intervals_of_a_large_graph(chain):
    rows = fg.dfs_table(chain).collect()
    assert len(rows) == N + 1 and all(r.depth == r.discovered == r.preorder == int(r.id) for r in rows)


def test_dj_edges_of_a_large_graph(chain):
    assert {r.kind: r["count"] for r in fg.join_edges(chain).groupBy("kind").count().collect()} == {"D": N, "BJ": 1}


def test_loops_of_a_large_graph(chain):
    assert [tuple(r) for r in fg.loops(chain).collect()] == [("P", f"{N - 1:07}", 1, 2)]


def test_edge_kinds_from_one_search(spark, sf):
    from lodegraph.plans import flowgraphs

    got = flowgraphs.edge_classification(spark, sf)
    assert got._jdf.queryExecution().executedPlan().toString().count("FlatMapGroupsInPandas") == 1
    e = flowgraphs.program_graphs(spark, sf)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, fg.classify_edges(e, fg.dfs_table(e)).collect()))


def nested(n):
    """0 > 1 > ... > n, and from n back to each: n + 1 loops, one within the other."""
    name = [f"{i:06}" for i in range(n + 1)]
    return {x: [name[i + 1]] if i < n else name for i, x in enumerate(name)}, name


def quick(f, *args):
    """f's result; time that grows with the square of the loops would be over 10 seconds."""
    began = time.process_time()
    out = f(*args)
    assert time.process_time() - began < 10
    return out


def graphs(n=400):
    rnd = random.Random(9)
    for _ in range(n):
        names = [f"n{i:02}" for i in range(rnd.randint(1, 9))]
        yield {x: sorted(rnd.sample(names, min(len(names), rnd.choice([0, 1, 1, 2, 2, 3])))) for x in names}, names[0]


def test_limit_of_nested_loops():
    g, name = nested(20_000)
    assert quick(fg.limit_graph, g, name[0]) == 1


def test_dominators_of_nested_loops():
    g, name = nested(40_000)
    assert quick(fg.dominators, g, name[0]) == {x: name[i - 1] if i else None for i, x in enumerate(name)}


def test_dominators_by_what_is_cut_off():
    """A node dominates what the root does not reach without it; the nearest has all others above it."""
    for g, root in graphs():
        live = set(fg.depth_first(g, root))
        lost = {d: live - set(fg.depth_first({k: [x for x in v if x != d] for k, v in g.items() if k != d}, root)) - {d} if d != root else live - {root} for d in live}
        want = {n: max((d for d in live if n in lost[d]), key=lambda d: sum(d in x for x in lost.values()), default=None) for n in live}
        assert fg.dominators(g, root) == want


def test_sizes_of_nested_loops():
    g, name = nested(20_000)
    assert quick(fg.loop_sizes, g, name[0]) == {x: (1, len(name) - i) for i, x in enumerate(name)}


def test_sizes_of_loops_are_those_of_their_bodies():
    for g, root in graphs():
        assert fg.loop_sizes(g, root) == {h: (len(ts), len(body)) for h, (ts, body) in fg.natural_loops(g, root).items()}
