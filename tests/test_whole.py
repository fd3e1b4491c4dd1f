"""Queries that do the whole job, against brute force."""

import json
import random
from collections import Counter, defaultdict
from itertools import combinations, permutations

from pyspark.sql import functions as F

import __spark_entry__ as entry
from lodegraph.operators import flowgraph as fg
from lodegraph.plans.base import data_nodes, edges
from lodegraph.plans.flowgraphs import transitions
from lodegraph.session import table

SF = "/root/testdata/sf0.01"


def test_ranges_of_all_rows(spark):
    at = defaultdict(list)
    for r in table(spark, SF, "chunk").filter("program is not null and paragraph is not null").select("program", "paragraph", "row_id").collect():
        at[r.program, r.paragraph].append(r.row_id)
    ranges = [(p, n, min(x), max(x)) for (p, n), x in at.items()]
    want = {(p, n): not any(p2 == p and n2 != n and (f2 < f <= l2 < la or f < f2 <= la < l2) for p2, n2, f2, l2 in ranges) for p, n, f, la in ranges}
    got = {(r.program, r.name): r.is_clean for r in entry.queries()["procedure_ranges"](spark, SF).collect()}
    assert got == want


def test_distances_in_every_component(spark):
    near = defaultdict(set)
    for r in edges(spark, SF).filter("edge_type = 'CONTAINS_CODE'").select("src", "dst").collect():
        near[r.src].add(r.dst)
        near[r.dst].add(r.src)
    want = {}
    for root in sorted(near):
        if root in want:
            continue
        want[root], front, depth = (root, 0), [root], 0
        while front:
            depth += 1
            front = sorted({y for x in front for y in near[x] if y not in want})
            want |= {y: (root, depth) for y in front}
    rows = entry.queries()["shortest_undirected_path"](spark, SF).collect()
    assert {r.id: (r.root, r.depth) for r in rows} == want and len(rows) == len(want)


def test_tree_distances_of_all_levels_and_pairs(spark):
    rows = sorted(data_nodes(spark, SF).select("row_id", "id", "parent_id", "program", "levelnumber", "datatype").collect())
    kids = defaultdict(list)
    for r in rows:
        kids[r.parent_id].append(r)

    def below(i, depth):
        return [x for r in kids[i] for x in [(depth, r.datatype or ""), *below(r.id, depth + 1)]]

    roots = [(r.program, r.id, [(0, "GROUP"), *below(r.id, 1)]) for r in rows if r.levelnumber == 1 and r.program is not None]
    assert max(d for _, _, t in roots for d, _ in t) > 1
    of = {r.id: r.row_id for r in rows}
    shape = {}
    for _, i, t in sorted(roots, key=lambda x: of[x[1]]):
        shape.setdefault(tuple(t), of[i])
    want = {(p, shape[tuple(x)], shape[tuple(y)]): fg.edit_distance(x, y) for p, a, x in roots if of[a] % 20 == 0 for q, b, y in roots if p == q and x != y}
    got = entry.queries()["tree_edit_distance"](spark, SF).collect()
    assert {(r.program, r.a, r.b): r.distance for r in got} == want and len(got) == len(want)
    named = entry.queries()["tree_shapes"](spark, SF).collect()
    assert {(r.program, r.root): r["shape"] for r in named} == {(p, i): shape[tuple(t)] for p, i, t in roots}


def test_expansion_of_all_steps(spark, sf):
    want = Counter()
    for r in table(spark, sf, "lineitem").collect():
        j, n, call = r.l_orderkey, r.l_linenumber, r.l_orderkey % 2 == 0
        want.update([(j, n, f"P{n}", m, f"PGM{m}", "call" if call else "default") for m in (1, 2)] if n <= 2 else [(j, n, f"P{n}", None, None, "call" if call else None)])
    got = Counter((r.job, r.n, r.proc, r.m, r.program, r.env) for r in entry.queries()["procedure_expansion"](spark, sf).collect())
    assert got == want


def test_long_runs_of_moves_reach_their_call(spark, sf, tmp_path):
    def write(name, rows):
        schema = table(spark, sf, name).schema
        spark.createDataFrame([tuple(r.get(f.name) for f in schema) for r in rows], schema).write.parquet(f"{tmp_path}/{name}.parquet")

    names = [f"m{i}" for i in range(7)]
    write("code_node", [{"row_id": i, "id": n, "flow_type": "MOVE"} for i, n in enumerate(names)] + [{"row_id": 7, "id": "c", "flow_type": "CALL"}])
    hops = [*zip(names, [*names[1:], "c"]), ("m6", "m0")]
    write("code_edge", [{"row_id": i, "fromnodeid": a, "tonodeid": b, "edgetype": "FOLLOWED_BY"} for i, (a, b) in enumerate(hops)])
    got = {(r.start, r.call_id, r.n_edges, r.path) for r in entry.queries()["variable_length_move_call"](spark, str(tmp_path)).collect()}
    assert got == {(n, "c", 7 - i, ">".join([*names[i:], "c"])) for i, n in enumerate(names)}


def graphs_of(spark):
    out = defaultdict(set)
    for r in transitions(spark, SF).collect():
        out[r.graph_id].add((r.src, r.dst))
    return out


def connected(es):
    seen, rest = set(es[0]), list(es[1:])
    while more := [e for e in rest if seen & set(e)]:
        seen |= {x for e in more for x in e}
        rest = [e for e in rest if e not in more]
    return not rest


def test_patterns_of_any_shape(spark):
    """All connected sets of up to three edges of small random graphs, told apart by isomorphism."""
    rnd = random.Random(5)
    graphs = {g: {(rnd.choice("abcde"), rnd.choice("abcde")) for _ in range(6)} for g in range(8)}
    label = lambda x: "x" if x in "ab" else "y"

    def shape(c):
        names = sorted({x for e in c for x in e})
        return min((tuple(label(x) for x in p), tuple(sorted((p.index(s), p.index(d)) for s, d in c))) for p in permutations(names))

    want = Counter()
    for es in graphs.values():
        want.update({shape(c) for n in (1, 2, 3) for c in combinations(sorted(es), n) if connected(c)})
    e = spark.createDataFrame([(g, s, d, label(s), label(d)) for g, es in graphs.items() for s, d in es], "graph_id long, src string, dst string, src_label string, dst_label string")
    got = {}
    for r in fg.frequent_patterns(e, 3, 3).collect():
        end = r.pattern.rindex("]") + 1
        key = tuple(json.loads(r.pattern[:end])), tuple(sorted(tuple(map(int, x.split(">"))) for x in r.pattern[end:].split()))
        assert key not in got and len(key[1]) == r.n_edges
        got[key] = r.support
    assert got == {k: n for k, n in want.items() if n >= 3} and len(got) > 10


def test_isomorphic_patterns_are_one(spark):
    rows = [(g, a, b, a[0], b[0]) for g, es in ((1, ["a1b1", "a1b2"]), (2, ["a7b9", "a7b8"]), (3, ["a1b1", "a2b1"])) for a, b in ((e[:2], e[2:]) for e in es)]
    e = spark.createDataFrame(rows, "graph_id long, src string, dst string, src_label string, dst_label string")
    assert {(r.pattern, r.n_edges, r.support) for r in fg.frequent_patterns(e, 1, 3).collect()} == {('["a", "b"] 0>1', 1, 3), ('["a", "b", "b"] 0>1 0>2', 2, 2), ('["a", "a", "b"] 0>2 1>2', 2, 1)}


def test_maximal_cliques(spark):
    want = set()
    for g, es in graphs_of(spark).items():
        nodes = sorted({x for e in es for x in e})
        full = [set(c) for n in range(1, len(nodes) + 1) for c in combinations(nodes, n) if all((a, b) in es or (b, a) in es for a, b in combinations(c, 2))]
        want |= {(g, len(c), ",".join(sorted(c))) for c in full if not any(c < d for d in full)}
    rows = entry.queries()["maximal_cliques"](spark, SF).collect()
    assert {(r.graph_id, r.size, r.members) for r in rows} == want and len(rows) == len(want)


def test_every_vector_is_linked(spark, sf):
    rows = sorted(entry.queries()["agglomerative_linkage"](spark, sf).collect(), key=lambda r: r.step)
    names = {str(r.vec_id) for r in table(spark, sf, "embeddings").collect()}
    assert len(rows) == len(names) - 1 and rows[-1]["size"] == len(names)
    assert {x for r in rows for x in (r.a, r.b)} == names


def test_linkage_against_a_plain_search():
    rnd = random.Random(3)
    points = [(f"{i:02}", [rnd.gauss(0, 1) for _ in range(4)]) for i in range(40)]
    unit = {n: [x / sum(y * y for y in v) ** 0.5 for x in v] for n, v in points}
    d = {(a, b): 1 - sum(x * y for x, y in zip(unit[a], unit[b])) for a in unit for b in unit if a < b}
    at, size, want = lambda a, b: d[min(a, b), max(a, b)], dict.fromkeys(unit, 1), []
    while len(size) > 1:
        a, b = min(((x, y) for x in size for y in size if x < y), key=lambda p: d[p])
        h, n, m = d[a, b], size[a], size.pop(b)
        want.append((a, b, round(h, 9), n + m))
        for k in size:
            if k != a:
                d[min(a, k), max(a, k)] = (((n + size[k]) * at(a, k) ** 2 + (m + size[k]) * at(b, k) ** 2 - size[k] * h**2) / (n + m + size[k])) ** 0.5
        size[a] = n + m
    assert [(a, b, round(h, 9), n) for _, a, b, h, n in fg.ward_linkage(points)] == want
