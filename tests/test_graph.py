import itertools
import random

from pyspark.sql import functions as F

from lodegraph.operators import flowgraph as fg
from lodegraph.operators import graph

E = "src string, dst string, edge_type string"


def df(spark, pairs, kind="E"):
    return spark.createDataFrame([(a, b, kind) for a, b in pairs], E)


def test_reach_on_cycle(spark):
    e = df(spark, ["ab", "bc", "ca", "cd", "xx"])
    roots = spark.createDataFrame([("r", "a")], "root string, id string")
    assert {(r.id, r.depth) for r in graph.reach(e, roots).collect()} == {("a", 0), ("b", 1), ("c", 2), ("d", 3)}
    assert graph.reach(e.filter("false"), roots).count() == 1


def test_components_on_a_long_path(spark):
    e = df(spark, [(f"n{i:03}", f"n{i + 1:03}") for i in range(60)] + [("z1", "z2"), ("q", "q")])
    c = {r.id: r.component for r in graph.components(e).collect()}
    assert {c[f"n{i:03}"] for i in range(61)} == {"n000"} and c["z2"] == "z1" and c["q"] == "q"


def test_strict_extract_raises(spark):
    import pytest

    nodes = spark.createDataFrame([("a", "MOVE")], "id string, flow_type string")
    _, e = graph.extract(nodes, df(spark, ["ab"]), F.lit(True), F.lit(True), strict=True)
    with pytest.raises(Exception, match="edge end is missing"):
        e.collect()


def test_paths_are_simple(spark):
    e = df(spark, ["ab", "ba", "bc"])
    p = graph.paths(e, spark.createDataFrame([("a",)], "id string"), 5)
    assert {tuple(r.path) for r in p.collect()} == {("a",), ("a", "b"), ("a", "b", "c")}


def test_depth_first_golden():
    d = fg.depth_first({"A": ["B", "C"], "B": [], "C": []}, "A")
    assert [n for n, v in sorted(d.items(), key=lambda x: x[1][4])] == ["A", "B", "C"]
    assert max(v[1] for v in d.values()) == 5 and [d[n][2] for n in "ABC"] == [0, 1, 1]


def brute_dominators(g, root):
    def reach(without):
        seen, stack = set(), [root] if root != without else []
        while stack:
            n = stack.pop()
            if n not in seen:
                seen.add(n)
                stack += [d for d in g[n] if d != without]
        return seen

    full = reach(None)
    doms = {n: {d for d in full if d == n or n not in reach(d)} for n in full}
    return {n: max((d for d in doms[n] if d != n), key=lambda d: len(doms[d]), default=None) for n in full}


def test_flow_graphs_against_brute_force():
    rnd = random.Random(7)
    for _ in range(60):
        names = "abcdefg"[: rnd.randint(2, 7)]
        g = {n: sorted({rnd.choice(names) for _ in range(rnd.randint(0, 3))}) for n in names}
        assert fg.dominators(g, "a") == brute_dominators(g, "a")
        d, idom = fg.depth_first(g, "a"), fg.dominators(g, "a")
        back = [(s, t) for s in d for t in g[s] if d[t][0] <= d[s][0] and d[s][1] <= d[t][1]]
        assert (fg.limit_graph(g, "a") == 1) == all(fg._tree_intervals(idom)(t, s) for s, t in back)


def test_irreducible_pair():
    g = {"r": ["a", "b"], "a": ["b"], "b": ["a"]}
    assert fg.limit_graph(g, "r") == 3
    assert fg.strong_components(g) == {"r": "r", "a": "a", "b": "a"}


def test_graph_tables(spark):
    e = spark.createDataFrame([(1, "r", "a", "r"), (1, "a", "b", "r"), (1, "b", "a", "r"), (1, "r", "b", "r"), (2, "x", "y", "x")], "graph_id long, src string, dst string, root string")
    kinds = {(r.src, r.dst): r.kind for r in fg.classify_edges(e, fg.dfs_table(e)).collect()}
    assert kinds == {("r", "a"): "tree", ("a", "b"): "tree", ("b", "a"): "back", ("r", "b"): "forward", ("x", "y"): "tree"}
    assert {r.graph_id: r.is_reducible for r in fg.reducibility(e).collect()} == {1: False, 2: True}
    assert [(r.component, r.n_entries) for r in fg.improper_components(e, fg.components(e)).collect()] == [("a", 2)]
    assert fg.dfs_table(e.filter("false")).count() == 0


def test_tree_distance():
    a = [(0, "g"), (1, "x"), (1, "y")]
    assert fg.edit_distance(a, a) == 0
    assert fg.edit_distance(a, [(0, "g"), (1, "x"), (1, "z")]) == 1
    assert fg.edit_distance(a, [(0, "g"), (1, "x")]) == 5
    assert fg.edit_distance([], a) == 15
    assert fg.edit_distance([(0, "g"), (1, "x"), (2, "y")], a) == 2 * 5 - 0


def test_linkage_joins_near_points_first():
    steps = fg.ward_linkage([("a", [1, 0]), ("b", [1, 0.01]), ("c", [0, 1])])
    assert steps[0][1:3] == ("a", "b") and steps[1][4] == 3


def test_range_overlap(spark):
    r = [("p", "a", 1, 10), ("p", "b", 2, 5), ("p", "c", 4, 8), ("q", "a", 1, 2), ("p", "d", 20, 30)]
    got = {(x.program, x.name): x.is_clean for x in fg.overlapping_ranges(spark.createDataFrame(r, "program string, name string, first int, last int")).collect()}
    want = {(p, n): not any(p2 == p and (f2 < f <= l2 < la or f < f2 <= la < l2) for p2, n2, f2, l2 in r if n2 != n) for p, n, f, la in r}
    assert got == want
    assert list(itertools.islice(got, 1))


def test_trees_of_any_depth_and_cycles(spark):
    """A chain of 200 rows, a cycle with a tail, a parent that is no row: nothing is cut off, nothing runs on."""
    chain = [(f"c{i:03}", f"c{i - 1:03}" if i else None, "f") for i in range(200)]
    ring = [("r0", "r2", "x"), ("r1", "r0", "x"), ("r2", "r1", "x"), ("t", "r0", "x"), ("o", "gone", "x")]
    rows = spark.createDataFrame(chain + ring, "id string, parent string, name string")
    paths = {r.id: r for r in graph.tree_paths(rows, "id", "parent", "name").collect()}
    assert len(paths) == 201 and paths["c199"].depth == 199 and paths["c199"].root == "c000" and paths["c199"].chain == "/".join("f" * 200) and paths["o"].depth == 0
    got = {(r.id, r.ancestor): r.n for r in graph.ancestor_closure(rows, "id", "parent").collect()}
    want = {(f"c{i:03}", f"c{j:03}"): i - j for i in range(200) for j in range(i + 1)}
    want |= {("r0", "r0"): 0, ("r0", "r2"): 1, ("r0", "r1"): 2, ("r1", "r1"): 0, ("r1", "r0"): 1, ("r1", "r2"): 2, ("r2", "r2"): 0, ("r2", "r1"): 1, ("r2", "r0"): 2}
    want |= {("t", "t"): 0, ("t", "r0"): 1, ("t", "r2"): 2, ("t", "r1"): 3, ("o", "o"): 0, ("o", "gone"): 1}
    assert got == want
    near = {r.id: (r.target, r.depth) for r in graph.nearest_ancestor(rows, "id", "parent", F.col("id").isin("c000", "c150", "r1")).collect()}
    assert near["c199"] == ("c150", 49) and near["c149"] == ("c000", 149) and near["r0"] == ("r1", 2) and near["t"] == ("r1", 3) and "o" not in near
    e = rows.filter("parent is not null").select(F.col("parent").alias("src"), F.col("id").alias("dst"))
    up = {r.id: (r.target, r.depth) for r in graph.closest_above(e, rows.filter("id in ('c199', 'c010', 't', 'o')").select("id"), rows.filter("id in ('c000', 'c150', 'r1')")).collect()}
    assert up == {"c199": ("c150", 49), "c010": ("c000", 10), "t": ("r1", 3)}
    none = rows.limit(0)
    assert graph.tree_paths(none, "id", "parent", "name").count() == graph.ancestor_closure(none, "id", "parent").count() == graph.nearest_ancestor(none, "id", "parent", F.lit(True)).count() == 0


def test_loops_and_conditions_of_small_graphs(spark):
    """A natural loop of two tails, an irreducible pair, shared conditions that grow with the edges only."""
    loop = [("r", "h"), ("h", "x"), ("x", "y"), ("y", "h"), ("x", "h"), ("y", "z")]
    pair = [("r", "a"), ("r", "b"), ("a", "b"), ("b", "a"), ("b", "z")]
    e = spark.createDataFrame([(g, s, d, "r") for g, es in (("1", loop), ("2", pair)) for s, d in es], "graph_id string, src string, dst string, root string")
    assert {(r.graph_id, r.header, r.n_tails, r.n_nodes) for r in fg.loops(e).collect()} == {("1", "h", 2, 3)}
    nodes = {(r.graph_id, r.header, r.kind, r.id) for r in fg.loop_nodes(e).collect()}
    assert nodes == {("1", "h", "reducible", x) for x in "hxy"} | {("2", "a", "irreducible", x) for x in "ab"}
    dj = {(r.src, r.dst, r.kind) for r in fg.join_edges(e).filter("graph_id = '1'").collect()}
    assert dj == {("r", "h", "D"), ("h", "x", "D"), ("x", "y", "D"), ("y", "z", "D"), ("y", "h", "BJ"), ("x", "h", "BJ")}
    diamonds = [(f"n{i:02}", f"{side}{i:02}", f"{side}{i}") for i in range(40) for side in "ab"] + [(f"{side}{i:02}", f"n{i + 1:02}", None) for i in range(40) for side in "ab"]
    c = spark.createDataFrame([("g", s, d, "n00", k) for s, d, k in diamonds], "graph_id string, src string, dst string, root string, condition string")
    got = {r.id: r.condition for r in fg.reaching_conditions(c).collect()}
    assert len(got) == 121 and got["n00"] == "true" and got["a00"] == "a0" and got["n01"] == "or(a0, b0)" and got["a01"] == "and($n01, a1)" and max(map(len, got.values())) < 40


def test_closed_cycles_have_their_least_node_as_leader(spark):
    e = spark.createDataFrame([("g", "r", "a"), ("g", "a", "b"), ("g", "p", "q"), ("g", "q", "s"), ("g", "s", "p")], "graph_id string, src string, dst string")
    assert {r.id: r.leader for r in fg.basic_blocks(e).collect()} == {"r": "r", "a": "r", "b": "r", "p": "p", "q": "p", "s": "p"}


def test_weighted_paths(spark):
    e = spark.createDataFrame([("r", "a", 5), ("r", "b", 1), ("b", "a", 1), ("a", "c", 1), ("c", "r", 1), ("b", "c", 2), ("x", "y", 1)], "src string, dst string, weight int")
    roots = spark.createDataFrame([("r", "r"), ("x", "x")], "root string, id string")
    got = {(r.root, r.id): (r.distance, r.n_edges, r.before) for r in graph.shortest_paths(e, roots).collect()}
    assert got == {("r", "r"): (0, 0, None), ("r", "b"): (1, 1, "r"), ("r", "a"): (2, 2, "b"), ("r", "c"): (3, 2, "b"), ("x", "x"): (0, 0, None), ("x", "y"): (1, 1, "x")}
    assert graph.shortest_paths(e, roots.limit(0)).count() == 0


def test_graph_edit_distance_against_all_mappings():
    def brute(a, b):
        def graph_of(t):
            above, es = [], set()
            for i, (d, _) in enumerate(t):
                del above[d:]
                es |= {(above[-1], i)} if above else set()
                above.append(i)
            return es

        ea, eb, n, m = graph_of(a), graph_of(b), len(a), len(b)
        best = 99
        for at in itertools.product([None, *range(m)], repeat=n):
            used = [j for j in at if j is not None]
            if len(used) == len(set(used)):
                kept = sum(1 for x, y in ea if at[x] is not None and at[y] is not None and (at[x], at[y]) in eb)
                best = min(best, sum(j is None or a[i][1] != b[j][1] for i, j in enumerate(at)) + m - len(used) + len(ea) + len(eb) - 2 * kept)
        return best

    rnd = random.Random(4)

    def tree(n):
        out = [(0, "g")]
        for _ in range(n - 1):
            out.append((rnd.randint(1, out[-1][0] + 1), rnd.choice("xyz")))
        return out

    for _ in range(60):
        a, b = tree(rnd.randint(1, 5)), tree(rnd.randint(1, 5))
        assert fg.graph_edit_distance(a, b) == (brute(a, b), True)
    a, b = tree(14), tree(12)
    d, exact = fg.graph_edit_distance(a, b)
    assert not exact and d >= 2 and fg.graph_edit_distance(a, a) == (0, False)
