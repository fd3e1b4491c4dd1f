"""Graph operators over node and edge tables; edges are (src, dst, edge_type)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodegraph.session import cut, release

#: Edge types of the projections of a unified model.
AST_EDGES = ("CONTAINS_CODE",)
CFG_EDGES = ("STARTS_WITH", "FOLLOWED_BY")
DATA_EDGES = ("CONTAINS_DATA", "FLOWS_INTO", "REDEFINES")
#: Parts of equal rank that a traversal keeps before it merges them, so that a row is rewritten a few times only.
MERGE_AT = 4


class Visited:
    """What a traversal has visited: cut parts, merged by rank like those of a log-structured store."""

    def __init__(self, first: DataFrame):
        self.parts = [(0, first)]

    def all(self) -> DataFrame:
        out = self.parts[0][1]
        for _, p in self.parts[1:]:
            out = out.unionByName(p)
        return out

    def add(self, part: DataFrame) -> list[DataFrame]:
        """Parts that are merged away now: `part` itself may be among them, so release them when it is not read again."""
        self.parts.append((0, part))
        old: list[DataFrame] = []
        while len(self.parts) >= MERGE_AT and len({rank for rank, _ in self.parts[-MERGE_AT:]}) == 1:
            tail = self.parts[-MERGE_AT:]
            merged = tail[0][1]
            for _, p in tail[1:]:
                merged = merged.unionByName(p)
            self.parts[-MERGE_AT:] = [(tail[0][0] + 1, cut(merged))]
            old += [p for _, p in tail]
        return old


def project(edges: DataFrame, *edge_types: str) -> DataFrame:
    """The edges of the given types."""
    return edges.filter(F.col("edge_type").isin(*edge_types))


def extract(nodes: DataFrame, edges: DataFrame, node_is: Column, edge_is: Column, strict: bool = False) -> tuple[DataFrame, DataFrame]:
    """Sub-graph of the nodes and edges that meet the predicates; edges keep only if both ends do.

    strict: an edge that meets its predicate but has an end outside raises when the result is read."""
    kept = nodes.filter(node_is)
    ids = kept.select("id").distinct()
    e = edges.filter(edge_is)
    if strict:
        ends = ids.withColumn("there", F.lit(True))
        for end in ("src", "dst"):
            e = e.join(ends.withColumnRenamed("id", end), end, "left").withColumn(end, F.when(F.col("there"), F.col(end)).otherwise(F.raise_error(F.concat(F.lit("edge end is missing: "), F.col(end))))).drop("there")
        return kept, e
    return kept, e.join(ids.withColumnRenamed("id", "src"), "src", "left_semi").join(ids.withColumnRenamed("id", "dst"), "dst", "left_semi")


def degrees(edges: DataFrame) -> DataFrame:
    """(id, n_out, n_in) of every end of an edge."""
    ends = F.inline(F.array(F.struct(F.col("src").alias("id"), F.lit(1).alias("o"), F.lit(0).alias("i")), F.struct(F.col("dst").alias("id"), F.lit(0).alias("o"), F.lit(1).alias("i"))))
    return edges.select(ends).groupBy("id").agg(F.sum("o").alias("n_out"), F.sum("i").alias("n_in"))


def reach(edges: DataFrame, roots: DataFrame, max_depth: int | None = None, closed: DataFrame | None = None) -> DataFrame:
    """(root, id, depth): least number of edges from each root; roots at depth 0.

    Rounds of frontier joins: only nodes new in a round go on, and what is visited lies in a few cut parts.
    roots: root, id. Ends when a round finds nothing new, so cycles need no guard. closed: (root, id) that
    a root neither reaches nor goes through."""
    hops = cut(edges.select("src", "dst").filter("src <> dst").distinct())
    front = cut(roots.select("root", "id").distinct().withColumn("depth", F.lit(0)))
    seen, depth, old = Visited(front), 0, []
    while max_depth is None or depth < max_depth:
        depth += 1
        nxt = front.join(hops, front.id == hops.src).select("root", F.col("dst").alias("id")).distinct().join(seen.all(), ["root", "id"], "left_anti")
        nxt = cut((nxt if closed is None else nxt.join(closed, ["root", "id"], "left_anti")).withColumn("depth", F.lit(depth)))
        release(*old)
        if nxt.isEmpty():
            break
        old, front = seen.add(nxt), nxt
    release(hops)
    return seen.all()


def paragraph_bodies(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(paragraph, id): the nodes of every paragraph, itself included: what it starts with, and what follows
    that without coming to another paragraph. nodes: id, flow_type; edges: src, dst, edge_type."""
    heads = nodes.filter("flow_type = 'PARAGRAPH'").select("id").distinct()
    starts = project(edges, "STARTS_WITH").select("src", "dst").distinct()
    follows = project(edges, "FOLLOWED_BY").select("src", "dst").distinct().join(heads.select(F.col("id").alias("dst")), "dst", "left_anti").select("src", "dst")
    own = heads.select(F.col("id").alias("root"), "id")
    first = starts.join(heads.select(F.col("id").alias("src")), "src").filter("src <> dst").select(F.col("src").alias("root"), F.col("dst").alias("id"))
    return reach(starts.unionByName(follows), first, closed=own).select(F.col("root").alias("paragraph"), "id").unionByName(own.select(F.col("root").alias("paragraph"), "id"))


def paragraph_types(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(paragraph, flow_type, n): nodes of every body of `paragraph_bodies` by type, null for nodes that are no rows.

    nodes: id, flow_type, one row each; edges: src, dst, edge_type, program. Bodies overlap, so that their rows
    may be paragraphs x nodes of a program; here they are counted without being listed (`closure.body_counts`),
    per program, or per programs that have a node in common."""
    heads = nodes.filter("flow_type = 'PARAGRAPH'").select("id").distinct()
    starts = project(edges, "STARTS_WITH").select("src", "dst", "program").withColumn("is_start", F.lit(True))
    follows = project(edges, "FOLLOWED_BY").select("src", "dst", "program").join(heads.select(F.col("id").alias("dst")), "dst", "left_anti").select("src", "dst", "program", F.lit(False).alias("is_start"))
    arcs = cut(starts.unionByName(follows).withColumn("program", F.concat(F.lit("="), F.coalesce("program", F.lit("")))).distinct())
    at = arcs.select(F.explode(F.array("src", "dst")).alias("id"), "program").distinct()
    homes = cut(at.groupBy("id").agg(F.min("program").alias("home"), F.max("program").alias("last")))
    shared = at.join(homes.filter("home <> last"), "id").filter("home <> program").select(F.col("home").alias("src"), F.col("program").alias("dst")).distinct()
    group = components(shared).select(F.col("id").alias("program"), F.col("component").alias("_g"))
    grouped = lambda df: df.join(group, "program", "left").withColumn("_g", F.coalesce("_g", "program"))
    typed = homes.select("id", F.col("home").alias("program")).join(nodes.select("id", F.col("flow_type").alias("type")), "id", "left")
    rows = grouped(arcs).select("_g", "src", "dst", "is_start", F.lit(None).cast("string").alias("type"))
    rows = rows.unionByName(grouped(typed).select("_g", F.col("id").alias("src"), F.lit(None).cast("string").alias("dst"), F.lit(None).cast("boolean").alias("is_start"), "type"))

    def run(t):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        from lodegraph.operators.closure import body_counts

        v, e = t.filter(pc.is_null(t.column("dst"))), t.filter(pc.is_valid(t.column("dst")))
        ids = v.column("src").combine_chunks()
        types = v.column("type").combine_chunks().dictionary_encode()
        names = [None, *types.dictionary.to_pylist()]
        kind = np.asarray(types.indices.fill_null(-1)) + 1
        is_head = np.asarray([x == "PARAGRAPH" for x in names])[kind]
        place = lambda c: np.asarray(pc.index_in(e.column(c), value_set=ids).combine_chunks()).astype(np.int64)
        found, counts = body_counts(place("src"), place("dst"), e.column("is_start").to_numpy().astype(bool), is_head, kind.astype(np.int64), len(names))
        head, what = np.nonzero(counts)
        return pa.table({"paragraph": ids.take(pa.array(found[head])), "flow_type": pa.array([names[i] for i in what.tolist()], pa.string()), "n": pa.array(counts[head, what], pa.int64())})

    counted = rows.groupBy("_g").applyInArrow(run, "paragraph string, flow_type string, n bigint")
    alone = heads.join(homes.select("id"), "id", "left_anti").select(F.col("id").alias("paragraph"), F.lit("PARAGRAPH").alias("flow_type"), F.lit(1).cast("bigint").alias("n"))
    return counted.unionByName(alone)


def shortest_paths(edges: DataFrame, roots: DataFrame) -> DataFrame:
    """(root, id, distance, n_edges, before): least sum of weights from each root, fewest edges among equals.

    edges: src, dst, weight, which is not negative. Rounds of relaxation: only nodes whose distance fell in a
    round go on, so a round reads the frontier, not the graph. before: the node ahead of it on the path, the
    least of equals. Ends when nothing falls, so cycles need no guard."""
    hops = cut(edges.filter("src <> dst").groupBy("src", "dst").agg(F.min("weight").alias("weight")))
    best = front = cut(roots.select("root", "id").distinct().select("root", "id", F.lit(0).cast("double").alias("distance"), F.lit(0).alias("n_edges"), F.lit(None).cast("string").alias("before")))
    while not front.isEmpty():
        tried = front.join(hops, front.id == hops.src).select("root", F.col("dst").alias("id"), (F.col("distance") + F.col("weight")).alias("distance"), (F.col("n_edges") + 1).alias("n_edges"), F.col("src").alias("before"))
        least = tried.groupBy("root", "id").agg(F.min(F.struct("distance", "n_edges", "before")).alias("new"))
        both = best.select("root", "id", F.struct("distance", "n_edges", "before").alias("old")).join(least, ["root", "id"], "full_outer")
        fell = F.col("new").isNotNull() & (F.col("old").isNull() | (F.col("new.distance") < F.col("old.distance")) | ((F.col("new.distance") == F.col("old.distance")) & (F.col("new.n_edges") < F.col("old.n_edges"))))
        merged = cut(both.select("root", "id", F.when(fell, F.col("new")).otherwise(F.col("old")).alias("b"), fell.alias("fell")))
        nxt = merged.select("root", "id", "b.*", "fell")
        front = nxt.filter("fell").drop("fell")
        best = nxt.drop("fell")
    release(hops)
    return best


def _mark(pairs: DataFrame) -> tuple:
    """Fingerprint of a set of rows (count and two sums of 64 bits), from one scan without a shuffle of rows."""
    h = F.xxhash64("u", "v")
    return tuple(pairs.agg(F.count(F.lit(1)), F.sum(h.cast("decimal(38,0)")), F.bit_xor(F.xxhash64("v", "u"))).first())


def components(edges: DataFrame) -> DataFrame:
    """(id, component): weakly connected components, named after their least id.

    Large-star, small-star label contraction: each round at least squares the distance that labels have
    travelled, so the rounds grow with the logarithm of the longest path."""
    pairs = cut(edges.select(F.greatest("src", "dst").alias("u"), F.least("src", "dst").alias("v")).filter("u <> v").distinct())
    last = _mark(pairs)
    while True:
        both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("v0")).select("u", F.least("u", "v0").alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
        down = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(down, "u").select(F.explode(F.array(F.struct(F.col("u").alias("u"), F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e")).select("e.*").filter("u <> v").distinct()
        new = cut(small)
        mark = _mark(new)
        release(pairs)
        pairs = new
        if mark == last:
            break
        last = mark
    labels = pairs.select(F.col("u").alias("id"), F.col("v").alias("component"))
    return labels.unionByName(edges.select(F.explode(F.array("src", "dst")).alias("id")).distinct().join(labels, "id", "left_anti").select("id", F.col("id").alias("component")))


def paths(edges: DataFrame, starts: DataFrame, max_edges: int | None = None, stop: Column | None = None) -> DataFrame:
    """(start, id, n_edges, path): every simple path of at most `max_edges` edges, as an array of ids.

    None: paths of any length; each round's are cut from their lineage, until a round finds none.
    stop: predicate over (id) of nodes that a path ends at and does not go beyond."""
    hops = edges.select("src", "dst").distinct()
    if max_edges is None:
        hops = cut(hops)
    front = starts.select(F.col("id").alias("start"), "id", F.lit(0).alias("n_edges"), F.array("id").alias("path"))
    out, n = front, 0
    while max_edges is None or n < max_edges:
        n += 1
        going = front if stop is None else front.filter((F.col("n_edges") == 0) | ~stop)
        front = going.join(hops, going.id == hops.src).filter(~F.array_contains("path", F.col("dst"))).select("start", F.col("dst").alias("id"), F.lit(n).alias("n_edges"), F.array_append("path", F.col("dst")).alias("path"))
        if max_edges is None:
            front = cut(front)
            if front.isEmpty():
                break
        out = out.unionByName(front)
    return out


def closest_above(edges: DataFrame, starts: DataFrame, is_target: DataFrame, max_depth: int | None = None) -> DataFrame:
    """(id, target, depth): the nearest target upstream of each start, least id among equals.

    is_target: id of the targets. A start that is a target is its own. A walk ends where it finds one."""
    up = cut(edges.select(F.col("dst").alias("below"), F.col("src").alias("above")).filter("below <> above").distinct())
    marks = cut(is_target.select(F.col("id").alias("at")).distinct().withColumn("hit", F.lit(True)))
    front = cut(starts.select("id", F.col("id").alias("at")).distinct().join(marks, "at", "left"))
    seen, found, depth, old = Visited(front), [], 0, []
    while not front.isEmpty():
        found.append(front.filter("hit").groupBy("id").agg(F.min("at").alias("target")).withColumn("depth", F.lit(depth)))
        if depth == max_depth:
            break
        depth += 1
        going = front.join(front.filter("hit").select("id"), "id", "left_anti")
        nxt = going.join(up, going["at"] == up["below"]).select("id", F.col("above").alias("at")).distinct().join(seen.all(), ["id", "at"], "left_anti").join(marks, "at", "left")
        front = cut(nxt.select("at", "id", "hit"))
        old += seen.add(front)
        if depth % 8 == 0:
            found = [cut(_union(found))]
    out = cut(_union(found)) if found else starts.limit(0).select("id", F.col("id").alias("target"), F.lit(0).alias("depth"))
    release(up, *old, *[p for _, p in seen.parts])
    return out


def _union(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def _tree(rows: DataFrame, key: str, parent: str, *more: str) -> DataFrame:
    """One row per key with its parent, null where that is null or absent; the least of several parents."""
    t = rows.groupBy(key).agg(F.min(parent).alias("_up"), *[F.min_by(m, F.coalesce(parent, F.lit(""))).alias(m) for m in more])
    ids = t.select(F.col(key).alias("_p"))
    return t.join(ids, F.col("_up") == F.col("_p"), "left").select(F.col(key).alias("id"), F.col("_p").alias("parent"), *more)


def tree_paths(rows: DataFrame, key: str, parent: str, name: str) -> DataFrame:
    """(key, root, depth, chain): place of every row of a tree, chain = names from the root, joined by /.

    A row whose parent is null or absent is a root; rows on or below a cycle have no root and no row here.
    Pointers to the ancestors are doubled, so rounds grow with the logarithm of the depth, which is not
    limited. Rows of one key count once, under the least of their parents."""
    t = _tree(rows, key, parent, name)
    said = F.coalesce(name, F.lit(""))
    state = cut(t.select("id", F.coalesce("parent", "id").alias("at"), F.when(F.col("parent").isNull(), 0).otherwise(1).alias("depth"), F.when(F.col("parent").isNull(), "").otherwise(F.concat(F.lit("/"), said)).alias("below"), F.col("parent").isNull().alias("done"), F.when(F.col("parent").isNull(), said).alias("top")))
    left = state.filter("not done").count()
    while left:
        above = state.select(F.col("id").alias("at"), F.col("at").alias("_at"), F.col("depth").alias("_n"), F.col("below").alias("_below"), F.col("done").alias("_done"), F.col("top").alias("_top"))
        moved = state.filter("not done").join(above, "at").select("id", F.col("_at").alias("at"), (F.col("depth") + F.col("_n")).alias("depth"), F.concat("_below", "below").alias("below"), F.col("_done").alias("done"), F.col("_top").alias("top"))
        new = cut(state.filter("done").unionByName(moved))
        release(state)
        now = new.filter("not done").count()
        state = new
        if now == left:  # nobody came to a root in this round, so nobody will
            break
        left = now
    return state.filter("done").select(F.col("id").alias(key), F.col("at").alias("root"), "depth", F.concat("top", "below").alias("chain"))


def nearest_ancestor(rows: DataFrame, key: str, parent: str, target: Column) -> DataFrame:
    """(id, target, depth): the nearest of a row and its ancestors that meets the predicate, by pointer doubling.

    Rows without one have no row here."""
    t = _tree(rows.withColumn("_hit", F.coalesce(target, F.lit(False)).cast("int")), key, parent, "_hit")
    hit = F.col("_hit") == 1
    state = cut(t.select("id", F.when(hit, F.col("id")).otherwise(F.col("parent")).alias("at"), F.when(hit, 0).otherwise(1).alias("depth"), hit.alias("done")).filter("at is not null"))
    left = state.filter("not done").count()
    while left:
        above = state.select(F.col("id").alias("at"), F.col("at").alias("_at"), F.col("depth").alias("_n"), F.col("done").alias("_done"))
        moved = state.filter("not done").join(above, "at").select("id", F.col("_at").alias("at"), (F.col("depth") + F.col("_n")).alias("depth"), F.col("_done").alias("done"))
        new = cut(state.filter("done").unionByName(moved))
        release(state)
        now = new.filter("not done").count()
        state = new
        if now == left:
            # A round in which nobody ended: what is left goes round a cycle without a target.
            break
        left = now
    return state.filter("done").select("id", F.col("at").alias("target"), "depth")


def lowest_common_ancestors(pairs: DataFrame, up: DataFrame) -> DataFrame:
    """(a, b, ancestor, distance) with the least total distance; up: (id, ancestor, n) closure with n = 0."""
    a = up.select(F.col("id").alias("a"), "ancestor", F.col("n").alias("na"))
    b = up.select(F.col("id").alias("b"), "ancestor", F.col("n").alias("nb"))
    met = pairs.join(a, "a").join(b, ["b", "ancestor"])
    return met.groupBy("a", "b").agg(F.min(F.struct((F.col("na") + F.col("nb")).alias("distance"), "ancestor")).alias("m")).select("a", "b", "m.ancestor", "m.distance")


def ancestor_closure(rows: DataFrame, key: str, parent: str) -> DataFrame:
    """(id, ancestor, n): every ancestor of every row, itself at n = 0; depth is not limited.

    Jumps of 1, 2, 4, ... levels are joined with the pairs found so far, so rounds grow with the logarithm
    of the depth and no pair is made twice. On a cycle every ancestor counts once, at its least distance;
    a parent that is no row is an ancestor too. Of several parents of a key the least counts."""
    t = rows.groupBy(F.col(key).alias("id")).agg(F.min(parent).alias("up"))
    jump = cut(t.filter("up is not null").select("id", F.col("up").alias("mid")))
    pairs = Visited(cut(t.select("id", F.col("id").alias("ancestor"), F.lit(0).alias("n")).unionByName(jump.select(F.col("mid").alias("id")).distinct().join(t.select("id"), "id", "left_anti").select("id", F.col("id").alias("ancestor"), F.lit(0).alias("n")))))
    step, left, cyclic, size = 1, jump.count(), False, 0
    while left:
        known = pairs.all()
        far = jump.join(known.select(F.col("id").alias("mid"), "ancestor", "n"), "mid").select("id", "ancestor", (F.col("n") + F.lit(step)).alias("n"))
        nxt = cut(jump.join(jump.select(F.col("id").alias("mid"), F.col("mid").alias("top")), "mid").select("id", F.col("top").alias("mid")))
        if cyclic:
            least = cut(known.unionByName(far).groupBy("id", "ancestor").agg(F.min("n").alias("n")))
            release(*[p for _, p in pairs.parts])
            pairs = Visited(least)
            grown = least.count()
            if grown == size:
                break
            size = grown
        else:
            release(*pairs.add(cut(far)))
        release(jump)
        jump, step, now = nxt, step * 2, nxt.count()
        # No jumper fell off a top in this round: only rows on or below cycles are left.
        cyclic, left = cyclic or now == left, now
    there = rows.select(F.col(key).alias("id")).distinct()
    return pairs.all().join(there, "id", "left_semi")


def topmost(closure: DataFrame, matched: DataFrame) -> DataFrame:
    """Matched ids that have no matched ancestor: a search that does not descend into its matches."""
    m = matched.select("id").distinct()
    inside = closure.filter("n > 0").join(m, "id", "left_semi").join(m.withColumnRenamed("id", "ancestor"), "ancestor", "left_semi").select("id").distinct()
    return m.join(inside, "id", "left_anti")


def pattern3(nodes: DataFrame, edges: DataFrame, types: tuple[str, str, str], edge_types: tuple[str, str]) -> DataFrame:
    """(a, b, c): paths of three distinct nodes of the given types over edges of the given types."""
    n = nodes.select("id", "flow_type")
    pick = lambda name, t: n.filter(F.col("flow_type") == t).select(F.col("id").alias(name))
    e = lambda x, y, t: edges.filter(F.col("edge_type") == t).select(F.col("src").alias(x), F.col("dst").alias(y)).distinct()
    ab = e("a", "b", edge_types[0]).join(pick("a", types[0]), "a").join(pick("b", types[1]), "b")
    bc = e("b", "c", edge_types[1]).join(pick("c", types[2]), "c")
    return ab.join(bc, "b").filter("a <> b and b <> c and a <> c").select("a", "b", "c")


def induced3(found: DataFrame, edges: DataFrame) -> DataFrame:
    """Matches of `pattern3` without any edge besides the pattern's among their nodes."""
    e = edges.select("src", "dst").distinct()
    for x, y in (("a", "c"), ("c", "a"), ("b", "a"), ("c", "b")):
        found = found.join(e.select(F.col("src").alias(x), F.col("dst").alias(y)), [x, y], "left_anti")
    return found


def dataset_flow(flows: DataFrame) -> DataFrame:
    """(dataset, n_producers, n_consumers, flow_type) of (dataset, actor, is_write) rows."""
    g = flows.groupBy("dataset").agg(F.count_distinct(F.when(F.col("is_write"), F.col("actor"))).alias("n_producers"), F.count_distinct(F.when(~F.col("is_write"), F.col("actor"))).alias("n_consumers"))
    return g.withColumn("flow_type", F.when((F.col("n_producers") > 0) & (F.col("n_consumers") > 0), "inter_step").when(F.col("n_consumers") > 0, "external_input").when(F.col("n_producers") > 0, "final_output").otherwise("unused"))


def call_graph(calls: DataFrame, programs: DataFrame) -> DataFrame:
    """(program, n_calls, n_called_by, entry_type, in_corpus) of every end of a call (source, target, kind).

    kind CALLS comes from programs, EXECUTES from jobs. entry_type: both, jcl_only, call_only, none."""
    out = calls.filter("kind = 'CALLS'").groupBy(F.col("source").alias("program")).agg(F.count_distinct("target").alias("n_calls"))
    into = calls.groupBy(F.col("target").alias("program")).agg(F.count_distinct("source", "kind").alias("n_called_by"), F.bool_or(F.col("kind") == "CALLS").alias("c"), F.bool_or(F.col("kind") == "EXECUTES").alias("x"))
    known = programs.select("program").distinct().withColumn("in_corpus", F.lit(True))
    every = known.select("program").unionByName(into.select("program")).unionByName(out.select("program")).distinct()
    kind = F.when(F.col("c") & F.col("x"), "both").when(F.col("x"), "jcl_only").when(F.col("c"), "call_only").otherwise("none")
    return every.join(out, "program", "left").join(into, "program", "left").join(known, "program", "left").select("program", F.coalesce("n_calls", F.lit(0)).alias("n_calls"), F.coalesce("n_called_by", F.lit(0)).alias("n_called_by"), kind.alias("entry_type"), F.coalesce("in_corpus", F.lit(False)).alias("in_corpus"))


def branch_ordinals(edges: DataFrame, condition: Column) -> DataFrame:
    """Outgoing edges numbered in order of their row; the first bears the condition, the second its
    negation, further ones none."""
    w = Window.partitionBy("src").orderBy("row_id")
    o = F.row_number().over(w)
    return edges.withColumn("ordinal", o).withColumn("branch", F.when(F.col("ordinal") == 1, condition).when(F.col("ordinal") == 2, F.concat(F.lit("NOT ("), condition, F.lit(")"))))
