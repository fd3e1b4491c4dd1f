"""Flow-graph algorithms that are sequential within one graph: one Arrow group per graph.

Graphs come as (graph_id, src, dst) with a root per graph: the flow graph of one program, or one actor's
transitions. Edges are made distinct before they are grouped. A graph of any size is worked on whole, in one
task, whose memory grows with the graph's edges. Basic blocks have no such task.
"""

from __future__ import annotations

import json
from collections import Counter, defaultdict
from collections.abc import Callable
from functools import lru_cache
from itertools import groupby, permutations, product

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodegraph.session import cut, release, spread

Graph = dict[str, list[str]]


def _per_graph(edges: DataFrame, run: Callable[[Graph, str], list[tuple]], columns: str) -> DataFrame:
    """Rows of `run` for every graph, with the graph's id in front."""
    names = ["graph_id", *(c.split()[0] for c in columns.split(", "))]

    def rows(pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame([(pdf["graph_id"].iloc[0], *row) for row in run(*_read(pdf))], columns=names)

    return distinct_edges(edges).groupBy("graph_id").applyInPandas(rows, f"graph_id {dict(edges.dtypes)['graph_id']}, {columns}")


def distinct_edges(edges: DataFrame) -> DataFrame:
    return edges.select("graph_id", "src", "dst", "root").distinct()


def _read(pdf: pd.DataFrame) -> tuple[Graph, str]:
    """Successors of every node in order of name, and the root."""
    n = len(pdf)
    codes, names = pd.factorize(pd.concat([pdf["src"], pdf["dst"]], ignore_index=True), sort=True)
    src, dst = codes[:n], codes[n:]
    order = np.lexsort((dst, src))
    ends = np.searchsorted(src[order], np.arange(len(names) + 1)).tolist()
    to = names.to_numpy()[dst[order]].tolist()
    return {x: to[ends[i] : ends[i + 1]] for i, x in enumerate(names)}, pdf["root"].iloc[0]


def depth_first(g: Graph, root: str) -> dict[str, tuple[int, int, int, str | None, int, int]]:
    """node -> (discovered, finished, depth, parent, preorder, postorder); successors in order of name."""
    out: dict[str, list] = {root: [0, 0, 0, None, 0, 0]}
    clock, pre, post = 1, 1, 0
    stack = [(root, iter(g.get(root, ())))]
    while stack:
        node, it = stack[-1]
        for nxt in it:
            if nxt not in out:
                out[nxt] = [clock, 0, out[node][2] + 1, node, pre, 0]
                clock, pre = clock + 1, pre + 1
                stack.append((nxt, iter(g.get(nxt, ()))))
                break
        else:
            out[node][1], out[node][5] = clock, post
            clock, post = clock + 1, post + 1
            stack.pop()
    return {k: tuple(v) for k, v in out.items()}


def dominators(g: Graph, root: str) -> dict[str, str | None]:
    """Immediate dominators of the nodes that the root reaches, by semidominators with path compression
    (Lengauer and Tarjan), so that time grows with the edges however deep loops are nested."""
    order = depth_first(g, root)
    nodes = list(order)  # in preorder
    at = {n: i for i, n in enumerate(nodes)}
    parent = [0, *(at[order[n][3]] for n in nodes[1:])]
    preds: list[list[int]] = [[] for _ in nodes]
    for i, n in enumerate(nodes):
        for d in g.get(n, ()):
            preds[at[d]].append(i)
    semi, label = list(range(len(nodes))), list(range(len(nodes)))
    above, idom, bucket = [-1] * len(nodes), [0] * len(nodes), defaultdict(list)

    def least(v: int) -> int:
        """The node of least semidominator on the linked path above v."""
        if above[v] < 0:
            return v
        path, u = [], v
        while above[above[u]] >= 0:
            path.append(u)
            u = above[u]
        for x in reversed(path):
            y = above[x]
            if semi[label[y]] < semi[label[x]]:
                label[x] = label[y]
            above[x] = above[y]
        return label[v]

    for w in range(len(nodes) - 1, 0, -1):
        semi[w] = min([semi[least(v)] for v in preds[w]])
        bucket[semi[w]].append(w)
        above[w] = p = parent[w]
        for v in bucket.pop(p, ()):
            u = least(v)
            idom[v] = u if semi[u] < semi[v] else p
    for w in range(1, len(nodes)):
        if idom[w] != semi[w]:
            idom[w] = idom[idom[w]]
    return {root: None} | {n: nodes[idom[i]] for i, n in enumerate(nodes) if i}


def strong_components(g: Graph) -> dict[str, str]:
    """node -> least node of its strongly connected component (two passes of depth-first search)."""
    seen: set[str] = set()
    finish: list[str] = []
    for start in sorted(g):
        if start in seen:
            continue
        seen.add(start)
        stack = [(start, iter(g[start]))]
        while stack:
            node, it = stack[-1]
            nxt = next((x for x in it if x not in seen), None)
            if nxt is None:
                finish.append(node)
                stack.pop()
            else:
                seen.add(nxt)
                stack.append((nxt, iter(g.get(nxt, ()))))
    back: Graph = defaultdict(list)
    for s, ds in g.items():
        for d in ds:
            back[d].append(s)
    label: dict[str, str] = {}
    for start in reversed(finish):
        if start in label:
            continue
        members, stack2 = [], [start]
        label[start] = ""
        while stack2:
            n = stack2.pop()
            members.append(n)
            for p in back[n]:
                if p not in label:
                    label[p] = ""
                    stack2.append(p)
        for n in members:
            label[n] = min(members)
    return label


def limit_graph(g: Graph, root: str) -> int:
    """Nodes of the limit graph of T1 (drop self loops) and T2 (merge a node into its only predecessor);
    1 means reducible."""
    reach = set(depth_first(g, root))
    succ = {n: {d for d in g[n] if d in reach and d != n} for n in reach}
    pred: dict[str, set[str]] = defaultdict(set)
    for s, ds in succ.items():
        for d in ds:
            pred[d].add(s)
    work = sorted(n for n in reach if n != root and len(pred[n]) == 1)
    while work:
        n = work.pop()
        if n not in succ or n == root or len(pred[n]) != 1:
            continue
        (p,) = pred[n]
        keep, gone = (p, n) if len(succ[n]) <= len(succ[p]) + len(pred[p]) else (n, p)  # the one of fewer edges moves
        succ[p].discard(n)
        pred[n].discard(p)
        for d in succ.pop(gone):
            pred[d].discard(gone)
            if d != keep:
                pred[d].add(keep)
                succ[keep].add(d)
            if d != root and len(pred[d]) == 1:
                work.append(d)
        for q in pred.pop(gone, ()):
            succ[q].discard(gone)
            if q != keep:
                succ[q].add(keep)
                pred[keep].add(q)
        root = keep if gone == root else root
        if keep != root and len(pred[keep]) == 1:
            work.append(keep)
    return len(succ)


def dfs_table(edges: DataFrame) -> DataFrame:
    """(graph_id, id, discovered, finished, depth, parent, preorder, postorder) of the reachable nodes."""
    return _per_graph(edges, lambda g, root: [(n, *v) for n, v in depth_first(g, root).items()], "id string, discovered int, finished int, depth int, parent string, preorder int, postorder int")


def classify_edges(edges: DataFrame, dfs: DataFrame) -> DataFrame:
    """(graph_id, src, dst, kind): tree, back, forward, cross; edges out of reach are left out.

    Ancestry is an interval test on the clock, so classification is a join without any search."""
    side = lambda p: dfs.select("graph_id", F.col("id").alias(p), F.col("discovered").alias(f"{p}_d"), F.col("finished").alias(f"{p}_f"), F.col("parent").alias(f"{p}_p"))
    j = edges.select("graph_id", "src", "dst").distinct().join(side("src"), ["graph_id", "src"]).join(side("dst"), ["graph_id", "dst"])
    inside = lambda a, b: (F.col(f"{a}_d") <= F.col(f"{b}_d")) & (F.col(f"{b}_f") <= F.col(f"{a}_f"))
    kind = F.when(inside("dst", "src"), "back").when(F.col("dst_p") == F.col("src"), "tree").when(inside("src", "dst"), "forward").otherwise("cross")
    return j.select("graph_id", "src", "dst", kind.alias("kind"))


def edge_kinds(edges: DataFrame) -> DataFrame:
    """The rows of `classify_edges` from one search of every graph, without a join."""

    def run(g: Graph, root: str) -> list[tuple]:
        seen = depth_first(g, root)
        inside = lambda a, b: a[0] <= b[0] and b[1] <= a[1]
        kind = lambda s, d: "back" if inside(seen[d], seen[s]) else "tree" if seen[d][3] == s else "forward" if inside(seen[s], seen[d]) else "cross"
        return [(s, d, kind(s, d)) for s in seen for d in g[s]]

    return _per_graph(edges, run, "src string, dst string, kind string")


def dominator_table(edges: DataFrame) -> DataFrame:
    """(graph_id, id, idom) of the reachable nodes; the root has none."""
    return _per_graph(edges, lambda g, root: list(dominators(g, root).items()), "id string, idom string")


def join_edges(edges: DataFrame) -> DataFrame:
    """(graph_id, src, dst, kind): the DJ graph. D edges lead from immediate dominators, J edges are the
    other edges between reachable nodes; BJ those of them whose target dominates their source, else CJ."""

    def run(g: Graph, root: str) -> list[tuple]:
        idom = dominators(g, root)
        inside = _tree_intervals(idom)
        out = [(d, n, "D") for n, d in idom.items() if d is not None]
        return out + [(s, t, "BJ" if inside(t, s) else "CJ") for s in idom for t in g[s] if idom[t] != s]

    return _per_graph(edges, run, "src string, dst string, kind string")


def _tree_intervals(parent: dict[str, str | None]) -> Callable[[str, str], bool]:
    """Whether a is b or an ancestor of it, in constant time."""
    kids: Graph = defaultdict(list)
    for n, p in parent.items():
        if p is not None:
            kids[p].append(n)
    at: dict[str, tuple[int, int]] = {}
    for root in (n for n, p in parent.items() if p is None):
        order = depth_first({n: kids.get(n, []) for n in parent}, root)
        at |= {n: (v[0], v[1]) for n, v in order.items()}
    return lambda a, b: at[a][0] <= at[b][0] and at[b][1] <= at[a][1]


def natural_loops(g: Graph, root: str) -> dict[str, tuple[set[str], set[str]]]:
    """header -> (tails, body) of the natural loops: a back edge's target dominates its source. Loops of
    one header are one; what reaches a tail without passing the header is walked once."""
    idom = dominators(g, root)
    inside = _tree_intervals(idom)
    preds: Graph = defaultdict(list)
    tails: dict[str, set[str]] = defaultdict(set)
    for s in idom:
        for t in g[s]:
            preds[t].append(s)
            if inside(t, s):
                tails[t].add(s)
    out = {}
    for h, ts in tails.items():
        body, stack = {h} | ts, [t for t in ts if t != h]
        while stack:
            for p in preds[stack.pop()]:
                if p not in body:
                    body.add(p)
                    stack.append(p)
        out[h] = (ts, body)
    return out


def loop_sizes(g: Graph, root: str) -> dict[str, tuple[int, int]]:
    """header -> (tails, nodes) of the natural loops. Bodies of two headers are nested or have no node in
    common, so a loop that was counted stands as one node for the loops around it and no body is kept."""
    idom = dominators(g, root)
    inside = _tree_intervals(idom)
    preds: Graph = defaultdict(list)
    tails: Graph = defaultdict(list)
    for s in idom:
        for t in g[s]:
            preds[t].append(s)
            if inside(t, s):
                tails[t].append(s)
    within: dict[str, str] = {}
    size: dict[str, int] = {}

    def outer(n: str) -> str:
        top = n
        while top in within:
            top = within[top]
        while n != top:
            within[n], n = top, within[n]
        return top

    out = {}
    for h in reversed(list(idom)):  # in preorder what dominates a node comes before it
        if h not in tails:
            continue
        n, seen, stack = 1, {h}, [outer(t) for t in tails[h]]
        while stack:
            x = stack.pop()
            if x not in seen:
                seen.add(x)
                n += size.get(x, 1)
                within[x] = h
                stack += [outer(p) for p in preds[x]]
        out[h], size[h] = (len(tails[h]), n), n
    return out


def loops(edges: DataFrame) -> DataFrame:
    """(graph_id, header, n_tails, n_nodes) of the natural loops, those of one header taken together."""
    return _per_graph(edges, lambda g, root: [(h, *n) for h, n in loop_sizes(g, root).items()], "header string, n_tails int, n_nodes int")


def loop_nodes(edges: DataFrame) -> DataFrame:
    """(graph_id, header, kind, id): the nodes of every loop body, one row each.

    reducible: natural loops under their header. irreducible: the strong components that control enters
    at more than one node, under their least node."""

    def run(g: Graph, root: str) -> list[tuple]:
        seen = depth_first(g, root)
        live = {n: g[n] for n in seen}
        comp = strong_components(live)
        entries: dict[str, set[str]] = defaultdict(set)
        for s in live:
            for t in live[s]:
                if comp[s] != comp[t]:
                    entries[comp[t]].add(t)
        out = [(h, "reducible", n) for h, (_, body) in natural_loops(g, root).items() for n in body]
        return out + [(c, "irreducible", n) for n, c in comp.items() if len(entries[c]) > 1]

    return _per_graph(edges, run, "header string, kind string, id string")


def reducibility(edges: DataFrame) -> DataFrame:
    """(graph_id, n_limit, is_reducible) by T1-T2 interval analysis."""

    def run(g: Graph, root: str) -> list[tuple]:
        n = limit_graph(g, root)
        return [(n, n == 1)]

    return _per_graph(edges, run, "n_limit int, is_reducible boolean")


def components(edges: DataFrame) -> DataFrame:
    """(graph_id, id, component) of strongly connected components, named after their least node."""
    return _per_graph(edges, lambda g, root: list(strong_components(g).items()), "id string, component string")


def improper_components(edges: DataFrame, comp: DataFrame) -> DataFrame:
    """(graph_id, component, n_entries) of components of several nodes that are entered at more than one."""
    size = comp.groupBy("graph_id", "component").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    at = lambda p: comp.select("graph_id", F.col("id").alias(p), F.col("component").alias(f"{p}_c"))
    crossing = edges.select("graph_id", "src", "dst").distinct().join(at("src"), ["graph_id", "src"]).join(at("dst"), ["graph_id", "dst"]).filter("src_c <> dst_c")
    return crossing.groupBy("graph_id", F.col("dst_c").alias("component")).agg(F.count_distinct("dst").alias("n_entries")).join(size, ["graph_id", "component"]).filter("n_entries > 1").select("graph_id", "component", "n_entries")


def basic_blocks(edges: DataFrame) -> DataFrame:
    """(graph_id, id, leader): a node leads a block unless its only predecessor has it as only successor.

    Chains are followed by doubling the pointers to the predecessor, so rounds grow with the logarithm of
    the longest block."""
    e = edges.select("graph_id", "src", "dst").distinct()
    ids = e.select("graph_id", F.explode(F.array("src", "dst")).alias("id")).distinct()
    outs = e.groupBy("graph_id", "src").agg(F.count(F.lit(1)).alias("n_out"))
    one = e.groupBy("graph_id", F.col("dst").alias("id")).agg(F.count(F.lit(1)).alias("n_in"), F.min("src").alias("src")).filter("n_in = 1").join(outs, ["graph_id", "src"]).filter("n_out = 1 and src <> id")
    up = ids.join(one.select("graph_id", "id", "src"), ["graph_id", "id"], "left").select("graph_id", "id", F.coalesce("src", "id").alias("leader"))
    up = cut(up)
    left = -1
    while True:
        nxt = up.alias("a").join(up.select("graph_id", F.col("id").alias("leader"), F.col("leader").alias("top")), ["graph_id", "leader"]).select("graph_id", "id", F.col("top").alias("leader"), (F.col("top") != F.col("leader")).alias("_moved"))
        nxt = cut(nxt)
        moved = nxt.filter("_moved").count()
        release(up)
        if not moved:
            return nxt.drop("_moved")
        if moved == left:
            break  # nobody came to a leader: what is left goes round closed cycles
        up, left = cut(nxt.drop("_moved")), moved
        release(nxt)
    from lodegraph.operators.graph import components as weak

    ring = one.select(F.concat_ws("\0", F.col("graph_id").cast("string"), "id").alias("src"), F.concat_ws("\0", F.col("graph_id").cast("string"), "src").alias("dst"))
    named = weak(ring).select(F.col("id").alias("_k"), F.substring_index("component", "\0", -1).alias("_least"))
    keyed = nxt.withColumn("_k", F.concat_ws("\0", F.col("graph_id").cast("string"), "id"))
    return keyed.join(named, "_k", "left").select("graph_id", "id", F.when(F.col("_moved"), F.col("_least")).otherwise(F.col("leader")).alias("leader"))


def reaching_conditions(edges: DataFrame) -> DataFrame:
    """(graph_id, id, condition) on the acyclic part (tree, forward and cross edges) of each graph.

    edges: with `condition` per edge, null for none. A node's condition is the disjunction over its
    incoming edges of the source's condition and the edge's. Conditions that are no single term are
    shared: another node's stands as `$id`, so that the text grows with the edges only."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        g, root = _read(pdf)
        on = {(s, d): c for s, d, c in zip(pdf["src"], pdf["dst"], pdf["condition"]) if isinstance(c, str)}
        d = depth_first(g, root)
        order = sorted(d, key=lambda n: -d[n][5])
        terms: dict[str, set[str]] = {n: set() for n in order}
        said, short = {root: "true"}, {root: "true"}
        for n in order:
            if n != root:
                ts = terms[n]
                said[n] = "true" if "true" in ts else next(iter(ts)) if len(ts) == 1 else f"or({', '.join(sorted(ts))})"
                short[n] = f"${n}" if said[n].startswith(("or(", "and(")) else said[n]
            for t in g[n]:
                if d[t][0] <= d[n][0] and d[n][1] <= d[t][1]:
                    continue  # back edge
                c = on.get((n, t))
                terms[t].add(short[n] if c is None else c if short[n] == "true" else f"and({short[n]}, {c})")
        return pd.DataFrame([(pdf["graph_id"].iloc[0], n, c) for n, c in said.items()], columns=["graph_id", "id", "condition"])

    conditions = edges.groupBy("graph_id", "src", "dst").agg(F.min("condition").alias("condition"))
    return distinct_edges(edges).join(conditions, ["graph_id", "src", "dst"]).groupBy("graph_id").applyInPandas(run, f"graph_id {dict(edges.dtypes)['graph_id']}, id string, condition string")


def overlapping_ranges(ranges: DataFrame) -> DataFrame:
    """(program, name, is_clean): a procedure range is clean if no other range of its program crosses it.

    Ranges [first, last] nest or are apart unless one starts inside another and ends behind it. A range is
    clean iff the ranges that start within it are the ranges that end within it; the two sets are compared
    by the exclusive or of their hashes, which running totals give, so ranges are never paired."""
    r = ranges.withColumn("h", F.xxhash64("name", "first", "last"))
    own = Window.partitionBy("program").orderBy("first", F.desc("last")).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    r = r.withColumn("started", F.bit_xor("h").over(own))
    event = lambda pos, rank, start, end, ask: F.struct(F.col(pos).cast("long").alias("pos"), F.lit(rank).alias("rank"), (F.col("h") if start else F.lit(0).cast("long")).alias("s"), (F.col("h") if end else F.lit(0).cast("long")).alias("e"), F.lit(ask).alias("ask"))
    # At one position: starts count before the question at a range's end, ends after both questions.
    events = F.array(event("first", 0, True, False, None), event("first", 1, False, False, "first"), event("last", 1, False, False, "last"), event("last", 2, False, True, None))
    line = Window.partitionBy("program").orderBy("pos", "rank").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    e = r.select("program", "name", "first", "last", "started", F.inline(events)).withColumns({"xs": F.bit_xor("s").over(line), "xe": F.bit_xor("e").over(line)}).filter("ask is not null")
    at = lambda c, which: F.max(F.when(F.col("ask") == which, F.col(c)))
    g = e.groupBy("program", "name", "first", "last", "started").agg(at("xs", "last").alias("s2"), at("xe", "last").alias("e2"), at("xe", "first").alias("e1"))
    starts, ends = F.col("s2").bitwiseXOR(F.col("started")), F.col("e2").bitwiseXOR(F.col("e1"))
    return g.select("program", "name", (starts == ends).alias("is_clean"))


def edit_distance(a: list[tuple[int, str]], b: list[tuple[int, str]], edit: int = 5, relabel: int = 1) -> int:
    """Tree edit distance of two ordered trees given in preorder as (depth, label).

    Insertions and deletions cost `edit`, a different label `relabel`."""

    def post(t: list[tuple[int, str]]) -> tuple[list[str], list[int]]:
        labels, left, stack = [], [], []

        def close(to: int) -> None:
            while stack and stack[-1][0] >= to:
                _, label, first = stack.pop()
                labels.append(label)
                left.append(len(labels) - 1 if first is None else first)
                if stack and stack[-1][2] is None:
                    stack[-1][2] = left[-1]

        for depth, label in t:
            close(depth)
            stack.append([depth, label, None])
        close(-1)
        return labels, left

    (la, lefta), (lb, leftb) = post(a), post(b)
    keys = lambda left: sorted({x: i for i, x in enumerate(left)}.values())
    d = [[0] * len(lb) for _ in la]
    for i in keys(lefta):
        for j in keys(leftb):
            li, lj = lefta[i], leftb[j]
            f = [[0] * (j - lj + 2) for _ in range(i - li + 2)]
            for x in range(1, i - li + 2):
                f[x][0] = f[x - 1][0] + edit
            for y in range(1, j - lj + 2):
                f[0][y] = f[0][y - 1] + edit
            for x in range(1, i - li + 2):
                for y in range(1, j - lj + 2):
                    p, q = li + x - 1, lj + y - 1
                    if lefta[p] == li and leftb[q] == lj:
                        f[x][y] = min(f[x - 1][y] + edit, f[x][y - 1] + edit, f[x - 1][y - 1] + (0 if la[p] == lb[q] else relabel))
                        d[p][q] = f[x][y]
                    else:
                        f[x][y] = min(f[x - 1][y] + edit, f[x][y - 1] + edit, f[lefta[p] - li][leftb[q] - lj] + d[p][q])
    return d[-1][-1] if la and lb else edit * (len(la) + len(lb))


#: Nodes of the larger graph up to which the graph edit distance is searched exactly.
EXACT_NODES = 9


def graph_edit_distance(a: list[tuple[int, str]], b: list[tuple[int, str]], exact_nodes: int = EXACT_NODES) -> tuple[float, bool]:
    """(distance, is_exact) of two trees given in preorder as (depth, label), taken as graphs without order.

    Every node and edge that is inserted or deleted costs one, as does a node with another label. Nodes are
    mapped one by one by branch and bound; beyond `exact_nodes` nodes the mapping in order of label and
    depth stands, whose cost is an upper bound."""
    (la, ua), (lb, ub) = _parents(a), _parents(b)
    n, m = len(la), len(lb)
    edges = n + m - ua.count(-1) - ub.count(-1)
    if max(n, m) <= exact_nodes:
        gain = _best_mapping(la, ua, lb, ub) if n <= m else _best_mapping(lb, ub, la, ua)
        return float(max(n, m) + edges - gain), True

    def cost(at: list[int | None]) -> int:
        """Of a whole mapping: position in b of every node of a, None for deleted ones."""
        kept = sum(1 for y, x in enumerate(ua) if x >= 0 and at[x] is not None and at[y] is not None and ub[at[y]] == at[x])
        used = sum(j is not None for j in at)
        return sum(j is None or la[i] != lb[j] for i, j in enumerate(at)) + (m - used) + edges - 2 * kept

    order_a = sorted(range(n), key=lambda i: (a[i][1], a[i][0], i))
    order_b = sorted(range(m), key=lambda j: (b[j][1], b[j][0], j))
    greedy: list[int | None] = [None] * n
    free = list(order_b)
    for i in order_a:
        pick = next((j for j in free if lb[j] == la[i] and a[i][0] == b[j][0]), None)
        if pick is not None:
            greedy[i] = pick
            free.remove(pick)
    for i in order_a:
        if greedy[i] is None and free:
            greedy[i] = free.pop(0)
    return float(min(cost(greedy), cost([None] * n))), False


def _parents(t: list[tuple[int, str]]) -> tuple[list[str], list[int]]:
    """Labels and positions of the parents of a tree in preorder, -1 for none."""
    above: list[int] = []
    up = []
    for i, (depth, _) in enumerate(t):
        del above[depth:]
        up.append(above[-1] if above else -1)
        above.append(i)
    return [label for _, label in t], up


def _best_mapping(la: list[str], ua: list[int], lb: list[str], ub: list[int]) -> int:
    """The most that a one-to-one mapping of all nodes of a into b gains: 1 for an equal label, 2 for a kept edge.

    a: no more nodes than b. To leave a node of a out never costs less than to map it to a free node of b.
    Equal subtrees of b under one parent that are free as a whole stand for each other, as do neighbouring
    equal leaves of a; a state that was met with as much gain is not searched again."""
    n, m = len(la), len(lb)
    kids_b, below, form = [0] * m, [1 << j for j in range(m)], [""] * m
    for j in reversed(range(m)):
        form[j] = f"({lb[j]!r}{''.join(sorted(form[k] for k in range(m) if ub[k] == j))})"
        if ub[j] >= 0:
            kids_b[ub[j]] |= 1 << j
            below[ub[j]] |= below[j]
    twins = [[k for k in range(j) if ub[k] == ub[j] and form[k] == form[j]] for j in range(m)]
    open_at = [[(x, sum(ua[y] == x for y in range(i, n))) for x in range(i) if x in ua[i:]] for i in range(n)]
    later = [sum(x >= i for x in ua[i:]) for i in range(n)]
    label_mask = {x: sum(1 << j for j in range(m) if lb[j] == x) for x in set(la)}
    left = [[(label_mask[x], k) for x, k in Counter(la[i:]).items()] for i in range(n)]
    leaf = [i not in ua for i in range(n)]
    twin_a = [i > 0 and leaf[i] and leaf[i - 1] and ua[i] == ua[i - 1] and la[i] == la[i - 1] for i in range(n)]
    best, at = -1, [0] * n
    met: dict[tuple, int] = {}

    def search(i: int, free: int, got: int) -> None:
        nonlocal best
        if i == n:
            best = max(best, got)
            return
        most = got + 2 * later[i]
        for mask, k in left[i]:
            most += min(k, (free & mask).bit_count())
        for x, k in open_at[i]:
            most += 2 * min(k, (free & kids_b[at[x]]).bit_count())
        if most <= best:
            return
        state = (i, free, at[i - 1] if twin_a[i] else -1, *[at[x] for x, _ in open_at[i]])
        if met.get(state, -1) >= got:
            return
        met[state] = got
        under = kids_b[at[ua[i]]] if ua[i] >= 0 else 0
        steps = []
        for j in range(at[i - 1] + 1 if twin_a[i] else 0, m):
            if free >> j & 1 and not (below[j] & ~free == 0 and any(below[k] & ~free == 0 for k in twins[j])):
                steps.append((-((la[i] == lb[j]) + 2 * (under >> j & 1)), j))
        for gain, j in sorted(steps):
            at[i] = j
            search(i + 1, free & ~(1 << j), got - gain)

    search(0, (1 << m) - 1, 0)
    return best


def tree_distances(pairs: DataFrame) -> DataFrame:
    """(a, b, distance, graph_distance, is_exact) of pairs with their trees as arrays of struct<depth,label> in preorder."""
    import pyarrow as pa

    def run(batches):
        for batch in batches:
            trees = [[[(n["depth"], n["label"]) for n in t] for t in batch.column(c).to_pylist()] for c in ("tree_a", "tree_b")]
            as_graphs = [graph_edit_distance(x, y) for x, y in zip(*trees)]
            found = [pa.array([edit_distance(x, y) for x, y in zip(*trees)], pa.int32()), pa.array([d for d, _ in as_graphs], pa.float64()), pa.array([e for _, e in as_graphs], pa.bool_())]
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), *found], names=["a", "b", "distance", "graph_distance", "is_exact"])

    s = pairs.schema
    return pairs.mapInArrow(run, f"a {s['a'].dataType.simpleString()}, b {s['b'].dataType.simpleString()}, distance int, graph_distance double, is_exact boolean")


def preorder_trees(roots: DataFrame, rows: DataFrame) -> DataFrame:
    """(root, tree): all levels below each root as an array of struct<depth,label> in preorder.

    roots: id, row_id; rows: id, parent_id, row_id, label. Siblings stand in order of row_id; the root's
    label is GROUP. Levels are joined one at a time until one is empty; a path does not return to its own rows."""
    at = F.struct("row_id", "id")
    level = out = cut(roots.select(F.col("id").alias("root"), "id", F.array(at).alias("path"), F.lit("GROUP").alias("label")))
    while not level.isEmpty():
        above = level.select("root", F.col("id").alias("parent_id"), "path")
        level = cut(rows.join(above, "parent_id").filter(~F.array_contains("path", at)).select("root", "id", F.array_append("path", at).alias("path"), "label"))
        out = out.unionByName(level)
    tree = F.transform(F.array_sort(F.collect_list(F.struct("path", "label"))), lambda x: F.struct((F.size(x["path"]) - 1).alias("depth"), x["label"].alias("label")))
    return out.groupBy("root").agg(tree.alias("tree"))


def tree_shapes(trees: DataFrame) -> DataFrame:
    """(program, root, row_id, shape): equal trees are one shape, named after its least row id."""
    shapes = trees.groupBy("tree").agg(F.min("row_id").alias("shape"))
    return trees.join(shapes, "tree").select("program", "root", "row_id", "shape")


def shape_distances(trees: DataFrame, queries: Column, salts: int = 16) -> DataFrame:
    """(program, a, b, distance, graph_distance, is_exact): shapes of the trees that meet `queries` against all shapes of their program.

    trees: program, root, row_id, tree. Classes of equal trees stand for their members (`tree_shapes`), and
    the distance of a pair of shapes is computed once, whatever the programs that hold it."""
    shapes = cut(trees.groupBy("tree").agg(F.min("row_id").alias("shape")))
    named = trees.join(shapes, "tree").select("program", "row_id", "shape")
    a = named.filter(queries).select("program", F.col("shape").alias("a")).distinct().withColumn("_salt", F.pmod("a", F.lit(salts)))
    b = named.select("program", F.col("shape").alias("b")).distinct().withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    pairs = cut(a.join(b, ["program", "_salt"]).filter("a <> b").select("program", "a", "b"))
    of = lambda key, tree: shapes.select(F.col("shape").alias(key), F.col("tree").alias(tree))
    least, most = F.least("a", "b"), F.greatest("a", "b")
    met = spread(pairs.select(least.alias("_s"), most.alias("_t")).distinct().join(of("_s", "tree_a"), "_s").join(of("_t", "tree_b"), "_t"))
    said = tree_distances(met.select(F.col("_s").alias("a"), F.col("_t").alias("b"), "tree_a", "tree_b")).withColumnsRenamed({"a": "_s", "b": "_t"})
    return pairs.withColumns({"_s": least, "_t": most}).join(said, ["_s", "_t"]).select("program", "a", "b", "distance", "graph_distance", "is_exact")


@lru_cache(maxsize=200_000)
def _canonical(nodes: tuple[str, ...], edges: tuple[tuple[int, int], ...]) -> str:
    """Text that isomorphic patterns have in common: sorted labels, then the least edges over all orders."""
    alike = [list(ids) for _, ids in groupby(sorted(range(len(nodes)), key=nodes.__getitem__), key=nodes.__getitem__)]
    orders = (sum(p, ()) for p in product(*(permutations(ids) for ids in alike)))  # others than nodes of one label keep their order
    best = min(sorted((p.index(a), p.index(b)) for a, b in edges) for p in orders)
    return json.dumps(sorted(nodes), ensure_ascii=False) + "".join(f" {a}>{b}" for a, b in best)


#: Edges of a pattern beside its middle edge: self loops of the middle edge's ends, the edge against it, none.
LOOP_0, LOOP_1, AGAINST, NONE = -1, -2, -3, -4


def _local_patterns(es: set[tuple[int, int]], label: list[int], max_edges: int) -> set[tuple[int, int, int, int, bool]]:
    """Connected patterns of one to three edges that a graph holds, as (label, label, edge, edge, joined).

    Of three connected edges one touches both others. So every edge is taken as the middle one, with the
    labels of its ends (the second -1 for a self loop), and what touches it is told apart by end, direction
    and label of the far node only: time and memory grow with the edges and their kinds, not with the sets
    of edges. An edge to a far node is label * 4 + (2 if it leads in) + (1 at the second end); joined: both
    edges have one far node."""
    near: dict[int, dict[int, list[int]]] = defaultdict(dict)
    for b, c in es:
        if b != c:
            near[b].setdefault(label[c] * 4, []).append(c)
            near[c].setdefault(label[b] * 4 + 2, []).append(b)
    both: dict[int, list[int]] = defaultdict(list)
    for b, c in es:
        if b != c and (c, b) in es:
            both[b].append(c)
    twice = {b: Counter(label[c] for c in cs) for b, cs in both.items()}
    degree = {b: sum(map(len, g.values())) for b, g in near.items()}
    out: set[tuple[int, int, int, int, bool]] = set()
    for b, c in es:
        lb, lc = label[b], label[c] if b != c else -1
        out.add((lb, lc, NONE, NONE, False))
        if max_edges < 2:
            continue
        back = b != c and (c, b) in es
        far = []
        for end, x, y, there, here in ((0, b, c, lc * 4, lc * 4 + 2), (1, c, b, lb * 4 + 2, lb * 4)):
            if end and b == c:
                break
            for kind, ws in near[x].items() if x in near else ():
                n = len(ws) - (b != c and (kind == there or (back and kind == here)))
                if n:
                    far.append((kind + end, n, ws))
        inner = [k for k, e in ((LOOP_0, (b, b)), (LOOP_1, (c, c)), (AGAINST, (c, b))) if b != c and e in es]
        for k in inner:
            out.add((lb, lc, k, NONE, False))
        for t, _, _ in far:
            out.add((lb, lc, t, NONE, False))
        if max_edges < 3:
            continue
        for i, k in enumerate(inner):
            out.update((lb, lc, k, o, False) for o in inner[i + 1 :])
            out.update((lb, lc, t, k, False) for t, _, _ in far)
        for i, (t, n, ws) in enumerate(far):
            if n > 1:
                out.add((lb, lc, t, t, False))
            for u, k, vs in far[i + 1 :]:
                if t >> 2 != u >> 2 or n > 1 or k > 1 or next(w for w in ws if w != b and w != c) != next(v for v in vs if v != b and v != c):
                    out.add((lb, lc, t, u, False) if t < u else (lb, lc, u, t, False))
        for end, x, y in ((0, b, c), (1, c, b)):
            if x in twice and not (end and b == c):
                for w, n in twice[x].items():
                    if n > (back and w == label[y]):
                        out.add((lb, lc, w * 4 + end, w * 4 + 2 + end, True))
        if b != c:
            less, more, end = (b, c, 0) if degree[b] <= degree[c] else (c, b, 1)
            for t, ws in near[less].items():
                for w in ws:
                    for u, e in ((0, (more, w)), (2, (w, more))):
                        if w != more and e in es:
                            t1, t2 = t + end, (t & ~3) + u + 1 - end
                            out.add((lb, lc, min(t1, t2), max(t1, t2), True))
    return out


def _spelled(names: list[str], lb: int, lc: int, x: int, y: int, joined: bool) -> tuple[str, int]:
    """(pattern, n_edges) of what `_local_patterns` gives."""
    nodes = [names[lb]] if lc < 0 else [names[lb], names[lc]]
    shape = [(0, 0 if lc < 0 else 1)]
    for k in (x, y):
        if k >= 0:
            if k == x or not joined:
                nodes.append(names[k >> 2])
            end, far = k & 1, len(nodes) - 1
            shape.append((far, end) if k & 2 else (end, far))
        elif k != NONE:
            shape.append({LOOP_0: (0, 0), LOOP_1: (1, 1), AGAINST: (1, 0)}[k])
    return _canonical(tuple(nodes), tuple(shape)), len(shape)


def frequent_patterns(edges: DataFrame, min_support: int, max_edges: int, most: int = 200_000) -> DataFrame:
    """(pattern, n_edges, support): connected patterns of any shape that at least `min_support` graphs hold.

    edges: graph_id, src, dst, src_label, dst_label; a node has one label. Up to three edges the kinds of
    edges around every edge are read (`_local_patterns`); beyond that, sets of edges of a graph grow by any
    edge that touches them. A worker counts the patterns of its graphs and hands the counts on at `most` of
    them, so what is shuffled depends on the labels, not on the graphs."""
    import pyarrow as pa

    def graphs(batches):
        """(edges, labels) of every graph, whose rows follow each other."""
        known: dict[str, int] = {}
        for _, rows in groupby((r for batch in batches for r in zip(*(c.to_pylist() for c in batch.columns))), key=lambda r: r[0]):
            at: dict[str, int] = {}
            label: list[int] = []
            es = set()
            for _, s, d, sl, dl in rows:
                for x, text in ((s, sl), (d, dl)):
                    if x not in at:
                        at[x] = len(label)
                        label.append(known.setdefault(text, len(known)))
                es.add((at[s], at[d]))
            yield es, label, list(known)

    def grown(es, label, names):
        """Patterns of more than three edges."""
        touch = defaultdict(set)
        for e in es:
            touch[e[0]].add(e)
            touch[e[1]].add(e)
        level = {frozenset((e,)) for e in es}
        for n in range(2, max_edges + 1):
            level = {ids | {j} for ids in level for j in set().union(*(touch[x] for e in ids for x in e)) - ids}
            if n > 3:
                for ids in level:
                    nodes = sorted({x for e in ids for x in e})
                    yield _canonical(tuple(names[label[x]] for x in nodes), tuple((nodes.index(s), nodes.index(d)) for s, d in ids)), n

    def run(batches):
        known: dict[tuple, tuple[str, int]] = {}
        count: Counter = Counter()

        def out():
            rows = [(*k, n) for k, n in count.items()]
            count.clear()
            known.clear()
            return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.string(), pa.int32(), pa.int64()))], names=["pattern", "n_edges", "n"])

        for es, label, names in graphs(batches):
            held = set()
            for k in _local_patterns(es, label, max_edges):
                if k not in known:
                    known[k] = _spelled(names, *k)
                held.add(known[k])
            if max_edges > 3:
                held.update(grown(es, label, names))
            count.update(held)
            if len(count) > most or len(known) > most:
                yield out()
        yield out()

    e = edges.select("graph_id", "src", "dst", "src_label", "dst_label").repartition("graph_id").sortWithinPartitions("graph_id")
    return e.mapInArrow(run, "pattern string, n_edges int, n bigint").groupBy("pattern", "n_edges").agg(F.sum("n").alias("support")).filter(F.col("support") >= min_support)


def cliques(g: Graph) -> list[list[str]]:
    """Maximal cliques of the undirected graph without self loops (Bron and Kerbosch with a pivot)."""
    near: dict[str, set[str]] = {n: set() for n in g}
    for s, ds in g.items():
        for d in ds:
            if s != d:
                near[s].add(d)
                near[d].add(s)
    out, stack = [], [(frozenset(), set(near), set())]
    while stack:
        r, p, x = stack.pop()
        if not p and not x:
            out.append(sorted(r))
            continue
        pivot = max(p | x, key=lambda n: len(near[n] & p))
        for n in p - near[pivot]:
            stack.append((r | {n}, p & near[n], x & near[n]))
            p = p - {n}
            x = x | {n}
    return out


def maximal_cliques(edges: DataFrame) -> DataFrame:
    """(graph_id, size, members): every maximal clique once; members = sorted ids joined by commas.

    Edges count in both directions; a node whose only edge is a self loop is a clique of one."""
    return _per_graph(edges, lambda g, root: [(len(c), ",".join(c)) for c in cliques(g)], "size int, members string")


#: Points that one dendrogram may have: their distances fill 8 bytes a pair in one task.
MAX_POINTS = 10_000


def ward_linkage(points: list[tuple[str, list[float]]]) -> list[tuple[int, str, str, float, int]]:
    """(step, a, b, distance, size): agglomerative clustering by Ward's method over cosine distances.

    Each row's nearest other is kept, so a step reads the rows that a merge concerns and no others."""
    if len(points) > MAX_POINTS:
        raise ValueError(f"too many points for one dendrogram: {len(points)}")
    if len(points) < 2:
        return []
    names = [n for n, _ in points]
    x = np.array([v for _, v in points], dtype=float)
    x /= np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)
    d = x @ x.T
    np.subtract(1, d, out=d)
    np.fill_diagonal(d, np.inf)
    size, live = np.ones(len(names)), np.ones(len(names), dtype=bool)
    near = d.argmin(axis=1)
    least = d[np.arange(len(names)), near]
    out = []
    for step in range(len(names) - 1):
        i = int(least.argmin())
        i, j = sorted((i, int(near[i])))
        h = d[i, j]
        out.append((step, names[i], names[j], float(h), int(size[i] + size[j])))
        live[i] = live[j] = False
        k = np.flatnonzero(live)
        v = ((size[i] + size[k]) * d[i, k] ** 2 + (size[j] + size[k]) * d[j, k] ** 2 - size[k] * h**2) / (size[i] + size[j] + size[k])
        new = np.maximum(v, 0.0) ** 0.5
        d[i, :] = d[:, i] = d[j, :] = d[:, j] = np.inf
        d[i, k] = d[k, i] = new
        live[i], size[i] = True, size[i] + size[j]
        least[j] = np.inf
        lost = k[(near[k] == i) | (near[k] == j)]
        for r in [i, *lost]:
            near[r] = d[r].argmin()
            least[r] = d[r, near[r]]
        closer = k[(new < least[k]) | ((new == least[k]) & (i < near[k]))]
        near[closer], least[closer] = i, d[closer, i]
    return out
