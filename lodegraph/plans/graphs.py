"""Graph queries: projections, reachability, trees, patterns, call graphs, lineage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodegraph.operators import graph
from lodegraph.plans.base import WITH, WITH_RECURSIVE, data_nodes, edges, nodes
from lodegraph.session import table

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


@query(WITH + "SELECT edge_type, count(*) AS n_edges, count(DISTINCT src) AS n_src, count(DISTINCT dst) AS n_dst FROM edges GROUP BY edge_type")
def edge_type_inventory(spark: SparkSession, sf: str) -> DataFrame:
    return edges(spark, sf).groupBy("edge_type").agg(F.count(F.lit(1)).alias("n_edges"), F.count_distinct("src").alias("n_src"), F.count_distinct("dst").alias("n_dst"))


@query(WITH + "SELECT src, dst, edge_type FROM edges WHERE edge_type IN ('STARTS_WITH', 'FOLLOWED_BY')")
def edge_label_projection(spark: SparkSession, sf: str) -> DataFrame:
    return graph.project(edges(spark, sf), *graph.CFG_EDGES).select("src", "dst", "edge_type")


@query(WITH + "SELECT src, dst FROM edges WHERE edge_type = 'CONTAINS_CODE'")
def ast_projection(spark: SparkSession, sf: str) -> DataFrame:
    return graph.project(edges(spark, sf), *graph.AST_EDGES).select("src", "dst")


@query(WITH + "SELECT e.src, e.dst, e.edge_type FROM edges e JOIN nodes a ON a.id = e.src JOIN nodes b ON b.id = e.dst WHERE e.edge_type = 'JUMPS_TO' AND a.flow_type <> 'DIALECT' AND b.flow_type <> 'DIALECT'")
def subgraph_extract(spark: SparkSession, sf: str) -> DataFrame:
    _, e = graph.extract(nodes(spark, sf), edges(spark, sf), F.col("flow_type") != "DIALECT", F.col("edge_type") == "JUMPS_TO")
    return e.select("src", "dst", "edge_type")


@query(WITH + "SELECT id, sum(o) AS n_out, sum(i) AS n_in FROM (SELECT src AS id, 1 AS o, 0 AS i FROM edges UNION ALL SELECT dst, 0, 1 FROM edges) GROUP BY id")
def in_out_degree(spark: SparkSession, sf: str) -> DataFrame:
    return graph.degrees(edges(spark, sf))


@query(WITH + ", d AS (SELECT id, sum(o) AS o, sum(i) AS i FROM (SELECT src AS id, 1 AS o, 0 AS i FROM edges WHERE edge_type = 'FOLLOWED_BY' UNION ALL SELECT dst, 0, 1 FROM edges WHERE edge_type = 'FOLLOWED_BY') GROUP BY id) SELECT id, CASE WHEN i = 0 THEN 'root' ELSE 'sink' END AS role FROM d WHERE i = 0 OR o = 0")
def roots_and_sinks(spark: SparkSession, sf: str) -> DataFrame:
    d = graph.degrees(graph.project(edges(spark, sf), "FOLLOWED_BY"))
    return d.filter("n_in = 0 or n_out = 0").select("id", F.when(F.col("n_in") == 0, "root").otherwise("sink").alias("role"))


_REACH = WITH_RECURSIVE + """, cfg AS (SELECT DISTINCT src, dst FROM edges WHERE edge_type IN ('STARTS_WITH', 'JUMPS_TO') AND src <> dst),
ends AS (SELECT src AS id FROM cfg UNION SELECT dst FROM cfg),
roots AS (SELECT id FROM ends WHERE id NOT IN (SELECT dst FROM cfg)),
r AS (SELECT id, 0 AS depth, [id] AS seen FROM roots UNION SELECT cfg.dst, r.depth + 1, list_append(seen, cfg.dst) FROM r JOIN cfg ON cfg.src = r.id WHERE NOT list_contains(r.seen, cfg.dst))
"""


def _cfg(spark: SparkSession, sf: str) -> DataFrame:
    return graph.project(edges(spark, sf), "STARTS_WITH", "JUMPS_TO").filter("src <> dst").select("src", "dst").distinct()


def _reached(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    e = _cfg(spark, sf)
    roots = graph.degrees(e).filter("n_in = 0").select("id").withColumn("root", F.lit(0))
    return e, graph.reach(e, roots.select("root", "id"))


@query(_REACH + "SELECT id, min(depth) AS depth FROM r GROUP BY id")
def link_reachability(spark: SparkSession, sf: str) -> DataFrame:
    return _reached(spark, sf)[1].select("id", "depth")


@query(_REACH + "SELECT id FROM ends EXCEPT SELECT id FROM r")
def dead_nodes(spark: SparkSession, sf: str) -> DataFrame:
    e, r = _reached(spark, sf)
    return graph.degrees(e).select("id").join(r.select("id"), "id", "left_anti")


@query(_REACH + "SELECT id, depth FROM (SELECT id, min(depth) AS depth FROM r GROUP BY id) WHERE id IN (SELECT src FROM cfg) AND depth > 0")
def pruned_unreachable(spark: SparkSession, sf: str) -> DataFrame:
    e, r = _reached(spark, sf)
    return r.filter("depth > 0").join(e.select(F.col("src").alias("id")).distinct(), "id", "left_semi").select("id", "depth")


_CALLS = """calls AS (SELECT DISTINCT upper(program) AS source, json_extract_string(metadata, '$.call_target') AS target FROM nodes WHERE flow_type = 'CALL' AND json_extract_string(metadata, '$.call_target') IS NOT NULL AND program IS NOT NULL)"""


def _calls(spark: SparkSession, sf: str) -> DataFrame:
    n = nodes(spark, sf).filter("flow_type = 'CALL' and program is not null")
    return n.select(F.upper("program").alias("source"), F.get_json_object("metadata", "$.call_target").alias("target")).filter("target is not null").distinct()


@query(WITH + f", {_CALLS} SELECT target AS program, source AS caller FROM calls")
def called_by_index(spark: SparkSession, sf: str) -> DataFrame:
    """Reverse index of calls, a row per caller: a program that all others call fills no row."""
    return _calls(spark, sf).select(F.col("target").alias("program"), F.col("source").alias("caller"))


@query(WITH + f", {_CALLS} SELECT DISTINCT target FROM calls WHERE target NOT IN (SELECT DISTINCT upper(program) FROM nodes WHERE program IS NOT NULL)")
def external_targets(spark: SparkSession, sf: str) -> DataFrame:
    here = nodes(spark, sf).filter("program is not null").select(F.upper("program").alias("target")).distinct()
    return _calls(spark, sf).select("target").distinct().join(here, "target", "left_anti")


@query(
    WITH
    + f""", {_CALLS}, jobs AS (SELECT DISTINCT 'J' || (row_id % 7) AS source, target FROM (SELECT row_id, json_extract_string(metadata, '$.call_target') AS target FROM nodes WHERE flow_type = 'CALL' AND row_id % 3 = 0) WHERE target IS NOT NULL),
every AS (SELECT source, target, 'CALLS' AS kind FROM calls UNION ALL SELECT source, target, 'EXECUTES' FROM jobs), known AS (SELECT DISTINCT upper(program) AS program FROM nodes WHERE program IS NOT NULL),
names AS (SELECT program FROM known UNION SELECT target FROM every UNION SELECT source FROM calls)
SELECT n.program, (SELECT count(DISTINCT target) FROM calls c WHERE c.source = n.program) AS n_calls, (SELECT count(DISTINCT (source, kind)) FROM every e WHERE e.target = n.program) AS n_called_by,
CASE WHEN bool_or(e.kind = 'CALLS') AND bool_or(e.kind = 'EXECUTES') THEN 'both' WHEN bool_or(e.kind = 'EXECUTES') THEN 'jcl_only' WHEN bool_or(e.kind = 'CALLS') THEN 'call_only' ELSE 'none' END AS entry_type, n.program IN (SELECT program FROM known) AS in_corpus
FROM names n LEFT JOIN every e ON e.target = n.program GROUP BY n.program"""
)
def entry_type_classification(spark: SparkSession, sf: str) -> DataFrame:
    c = _calls(spark, sf).withColumn("kind", F.lit("CALLS"))
    n = nodes(spark, sf)
    jobs = n.filter("flow_type = 'CALL' and row_id % 3 = 0").select(F.concat(F.lit("J"), (F.col("row_id") % 7).cast("string")).alias("source"), F.get_json_object("metadata", "$.call_target").alias("target"), F.lit("EXECUTES").alias("kind")).filter("target is not null").distinct()
    return graph.call_graph(c.unionByName(jobs), n.filter("program is not null").select(F.upper("program").alias("program")))


_GEO = """g AS (SELECT 'C:' || c_custkey AS src, 'N:' || c_nationkey AS dst FROM customer UNION ALL SELECT 'S:' || s_suppkey, 'N:' || s_nationkey FROM supplier UNION ALL SELECT 'N:' || n_nationkey, 'R:' || n_regionkey FROM nation)"""


def _geo(spark: SparkSession, sf: str) -> DataFrame:
    name = lambda p, c: F.concat(F.lit(p), F.col(c).cast("string"))
    return (
        table(spark, sf, "customer").select(name("C:", "c_custkey").alias("src"), name("N:", "c_nationkey").alias("dst"))
        .unionByName(table(spark, sf, "supplier").select(name("S:", "s_suppkey").alias("src"), name("N:", "s_nationkey").alias("dst")))
        .unionByName(table(spark, sf, "nation").select(name("N:", "n_nationkey").alias("src"), name("R:", "n_regionkey").alias("dst")))
    )


@query(f"WITH {_GEO} SELECT a.src AS root, a.src AS id, 0 AS depth FROM g a WHERE a.src LIKE 'S:%' UNION ALL SELECT src, dst, 1 FROM g WHERE src LIKE 'S:%' UNION ALL SELECT a.src, b.dst, 2 FROM g a JOIN g b ON b.src = a.dst WHERE a.src LIKE 'S:%'")
def call_hops(spark: SparkSession, sf: str) -> DataFrame:
    e = _geo(spark, sf)
    return graph.reach(e, e.filter("src like 'S:%'").select(F.col("src").alias("root"), F.col("src").alias("id")))


@query(
    WITH_RECURSIVE
    + ", j AS (SELECT DISTINCT src, dst FROM edges WHERE edge_type = 'JUMPS_TO'), p AS (SELECT src AS start, src AS id, 0 AS n_edges, [src] AS path FROM (SELECT DISTINCT src FROM j) UNION ALL SELECT p.start, j.dst, p.n_edges + 1, list_append(p.path, j.dst) FROM p JOIN j ON j.src = p.id WHERE p.n_edges < 5 AND NOT list_contains(p.path, j.dst)) SELECT start, id, n_edges, array_to_string(path, '>') AS path FROM p"
)
def transitive_paths_depth5(spark: SparkSession, sf: str) -> DataFrame:
    e = graph.project(edges(spark, sf), "JUMPS_TO")
    p = graph.paths(e, e.select(F.col("src").alias("id")).distinct(), 5)
    return p.select("start", "id", "n_edges", F.array_join("path", ">").alias("path"))


_TREE = WITH_RECURSIVE + """, t AS (SELECT id, CASE WHEN parent_id IN (SELECT id FROM data) THEN parent_id END AS parent, fieldname, levelnumber FROM data),
up AS (SELECT id, id AS ancestor, 0 AS n FROM t UNION ALL SELECT up.id, t.parent, up.n + 1 FROM up JOIN t ON t.id = up.ancestor WHERE t.parent IS NOT NULL)"""


def _tree(spark: SparkSession, sf: str) -> DataFrame:
    d = data_nodes(spark, sf).select("id", "parent_id", "fieldname", "levelnumber")
    return d.join(d.select(F.col("id").alias("p")), F.col("parent_id") == F.col("p"), "left").select("id", F.col("p").alias("parent"), "fieldname", "levelnumber")


@query(_TREE + "SELECT * FROM up")
def ancestor_closure(spark: SparkSession, sf: str) -> DataFrame:
    return graph.ancestor_closure(_tree(spark, sf), "id", "parent")


@query(_TREE + "SELECT ancestor AS id, count(*) - 1 AS n_below, max(n) AS height FROM up GROUP BY ancestor")
def subtree_counts(spark: SparkSession, sf: str) -> DataFrame:
    return graph.ancestor_closure(_tree(spark, sf), "id", "parent").groupBy(F.col("ancestor").alias("id")).agg((F.count(F.lit(1)) - 1).alias("n_below"), F.max("n").alias("height"))


@query(_TREE + ", w AS (SELECT t.id, t.parent, t.id AS root, 0 AS depth, coalesce(fieldname, '') AS chain FROM t WHERE parent IS NULL UNION ALL SELECT t.id, t.parent, w.root, w.depth + 1, w.chain || '/' || coalesce(t.fieldname, '') FROM w JOIN t ON t.parent = w.id) SELECT id, root, depth, chain FROM w")
def data_tree_paths(spark: SparkSession, sf: str) -> DataFrame:
    return graph.tree_paths(_tree(spark, sf), "id", "parent", "fieldname")


@query(_TREE + ", m AS (SELECT id FROM t WHERE fieldname LIKE '%-T%') SELECT id FROM m WHERE id NOT IN (SELECT up.id FROM up WHERE n > 0 AND ancestor IN (SELECT id FROM m))")
def topmost_matches(spark: SparkSession, sf: str) -> DataFrame:
    t = _tree(spark, sf)
    return graph.topmost(graph.ancestor_closure(t, "id", "parent"), t.filter("fieldname like '%-T%'"))


@query(_TREE + ", leaf AS (SELECT id, parent FROM t WHERE id NOT IN (SELECT parent FROM t WHERE parent IS NOT NULL)), root AS (SELECT id, arg_max(ancestor, n) AS top FROM up GROUP BY id), f AS (SELECT r.top, l.id, min(l.id) OVER (PARTITION BY r.top) AS first FROM leaf l JOIN root r ON r.id = l.id), s AS (SELECT f.first AS a, f.id AS b, x.ancestor, x.n + y.n AS distance FROM f JOIN up x ON x.id = f.first JOIN up y ON y.id = f.id AND y.ancestor = x.ancestor WHERE f.id <> f.first) SELECT a, b, arg_min(ancestor, (distance, ancestor)) AS ancestor, min(distance) AS distance FROM s GROUP BY a, b")
def lowest_common_ancestor(spark: SparkSession, sf: str) -> DataFrame:
    """Where the first elementary field of every record meets each of the record's others."""
    t, up = _tree(spark, sf), graph.ancestor_closure(_tree(spark, sf), "id", "parent")
    leaves = t.select("id").join(t.select(F.col("parent").alias("id")).filter("id is not null"), "id", "left_anti")
    top = up.groupBy("id").agg(F.max_by("ancestor", "n").alias("top")).join(leaves, "id")
    pairs = top.join(top.groupBy("top").agg(F.min("id").alias("a")), "top").filter("id <> a").select("a", F.col("id").alias("b"))
    return graph.lowest_common_ancestors(pairs, up)


@query(_TREE + "SELECT x.id, arg_min(x.ancestor, (x.n, x.ancestor)) AS target, min(x.n) AS depth FROM up x JOIN t ON t.id = x.ancestor WHERE t.levelnumber = 1 GROUP BY x.id")
def section_lookup_up(spark: SparkSession, sf: str) -> DataFrame:
    """The nearest record (level 1) at or above every field."""
    return graph.nearest_ancestor(_tree(spark, sf), "id", "parent", F.col("levelnumber") == 1)


@query(_TREE + ", acc AS (SELECT DISTINCT dst AS id FROM edges WHERE edge_type IN ('ACCESSES', 'MODIFIES')) SELECT ancestor AS id, count(*) AS n_fields FROM up WHERE ancestor IN (SELECT id FROM t WHERE parent IS NULL) GROUP BY ancestor HAVING NOT bool_or(up.id IN (SELECT id FROM acc))")
def unused_variable_trees(spark: SparkSession, sf: str) -> DataFrame:
    t = _tree(spark, sf)
    used = edges(spark, sf).filter("edge_type in ('ACCESSES', 'MODIFIES')").select(F.col("dst").alias("id")).distinct().withColumn("used", F.lit(True))
    c = graph.ancestor_closure(t, "id", "parent").join(t.filter("parent is null").select(F.col("id").alias("ancestor")), "ancestor", "left_semi").join(used, "id", "left")
    return c.groupBy(F.col("ancestor").alias("id")).agg(F.count(F.lit(1)).alias("n_fields"), F.bool_or(F.coalesce("used", F.lit(False))).alias("u")).filter("not u").drop("u")


@query(WITH + ", d AS (SELECT src, dst, edge_type, row_id FROM edges WHERE edge_type IN ('JUMPS_TO', 'FOLLOWED_BY')) SELECT src, dst, edge_type FROM d WHERE dst NOT IN (SELECT id FROM nodes)")
def dangling_refs(spark: SparkSession, sf: str) -> DataFrame:
    return graph.project(edges(spark, sf), "JUMPS_TO", "FOLLOWED_BY").join(nodes(spark, sf).select(F.col("id").alias("dst")), "dst", "left_anti").select("src", "dst", "edge_type")


_PATTERN = WITH + """, f AS (SELECT DISTINCT src, dst FROM edges WHERE edge_type = 'FOLLOWED_BY'),
m AS (SELECT x.src AS a, x.dst AS b, y.dst AS c FROM f x JOIN f y ON y.src = x.dst JOIN nodes n1 ON n1.id = x.src JOIN nodes n2 ON n2.id = x.dst JOIN nodes n3 ON n3.id = y.dst
WHERE n1.flow_type = 'MOVE' AND n2.flow_type = 'MOVE' AND n3.flow_type = 'CALL' AND x.src <> x.dst AND x.dst <> y.dst AND x.src <> y.dst)"""


@query(_PATTERN + " SELECT a, b, c FROM m")
def path_pattern_move_call(spark: SparkSession, sf: str) -> DataFrame:
    return graph.pattern3(nodes(spark, sf), edges(spark, sf), ("MOVE", "MOVE", "CALL"), ("FOLLOWED_BY", "FOLLOWED_BY"))


@query(_PATTERN + ", e AS (SELECT DISTINCT src, dst FROM edges) SELECT a, b, c FROM m WHERE NOT EXISTS (SELECT 1 FROM e WHERE (src = a AND dst = c) OR (src = c AND dst = a) OR (src = b AND dst = a) OR (src = c AND dst = b))")
def subgraph_pattern_join(spark: SparkSession, sf: str) -> DataFrame:
    e = edges(spark, sf)
    return graph.induced3(graph.pattern3(nodes(spark, sf), e, ("MOVE", "MOVE", "CALL"), ("FOLLOWED_BY", "FOLLOWED_BY")), e)


@query(WITH + "SELECT a.flow_type AS from_type, e.edge_type, b.flow_type AS to_type, count(DISTINCT e.program) AS support FROM edges e JOIN nodes a ON a.id = e.src JOIN nodes b ON b.id = e.dst GROUP BY 1, 2, 3 HAVING count(DISTINCT e.program) >= 5")
def frequent_edges_support(spark: SparkSession, sf: str) -> DataFrame:
    n = nodes(spark, sf)
    e = edges(spark, sf).join(n.select(F.col("id").alias("src"), F.col("flow_type").alias("from_type")), "src").join(n.select(F.col("id").alias("dst"), F.col("flow_type").alias("to_type")), "dst")
    return e.groupBy("from_type", "edge_type", "to_type").agg(F.count_distinct("program").alias("support")).filter("support >= 5")


@query(WITH + "SELECT e.dst AS dataset, count(DISTINCT CASE WHEN edge_type = 'MODIFIES' THEN program END) AS n_producers, count(DISTINCT CASE WHEN edge_type = 'ACCESSES' THEN program END) AS n_consumers, CASE WHEN count(DISTINCT CASE WHEN edge_type = 'MODIFIES' THEN program END) > 0 AND count(DISTINCT CASE WHEN edge_type = 'ACCESSES' THEN program END) > 0 THEN 'inter_step' WHEN count(DISTINCT CASE WHEN edge_type = 'ACCESSES' THEN program END) > 0 THEN 'external_input' WHEN count(DISTINCT CASE WHEN edge_type = 'MODIFIES' THEN program END) > 0 THEN 'final_output' ELSE 'unused' END AS flow_type FROM edges e WHERE edge_type IN ('MODIFIES', 'ACCESSES') GROUP BY e.dst")
def dataset_flow_type(spark: SparkSession, sf: str) -> DataFrame:
    e = graph.project(edges(spark, sf), "MODIFIES", "ACCESSES")
    return graph.dataset_flow(e.select(F.col("dst").alias("dataset"), F.col("program").alias("actor"), (F.col("edge_type") == "MODIFIES").alias("is_write")))


@query(WITH + "SELECT src, dst, row_number() OVER (PARTITION BY src ORDER BY e.row_id) AS ordinal, CASE row_number() OVER (PARTITION BY src ORDER BY e.row_id) WHEN 1 THEN n.originaltext WHEN 2 THEN 'NOT (' || n.originaltext || ')' END AS branch FROM edges e JOIN nodes n ON n.id = e.src AND n.flow_type = 'IF_BRANCH' WHERE e.edge_type = 'FOLLOWED_BY'")
def branch_ordinals(spark: SparkSession, sf: str) -> DataFrame:
    n = nodes(spark, sf).filter("flow_type = 'IF_BRANCH'").select(F.col("id").alias("src"), "originaltext")
    e = graph.project(edges(spark, sf), "FOLLOWED_BY").join(n, "src")
    return graph.branch_ordinals(e, F.col("originaltext")).select("src", "dst", "ordinal", "branch")


@query(WITH_RECURSIVE + ", u AS (SELECT src AS a, dst AS b FROM edges WHERE edge_type = 'CONTAINS_CODE' UNION SELECT dst, src FROM edges WHERE edge_type = 'CONTAINS_CODE'), c AS (SELECT a AS id, a AS l FROM u UNION SELECT u.b, c.l FROM c JOIN u ON u.a = c.id) SELECT id, min(l) AS component FROM c GROUP BY id")
def weak_components(spark: SparkSession, sf: str) -> DataFrame:
    return graph.components(graph.project(edges(spark, sf), "CONTAINS_CODE"))


@query(
    WITH_RECURSIVE
    + """, h AS (SELECT src, dst, min(1 + abs(coalesce(sourceline, 0)) % 7) AS w FROM edges WHERE edge_type IN ('STARTS_WITH', 'JUMPS_TO') AND src <> dst GROUP BY ALL),
    r AS (SELECT DISTINCT src AS id FROM h WHERE src NOT IN (SELECT dst FROM h)),
    p AS (SELECT id AS root, id, 0 AS d, 0 AS k, [id] AS seen FROM r UNION ALL SELECT p.root, h.dst, p.d + h.w, p.k + 1, list_append(p.seen, h.dst) FROM p JOIN h ON h.src = p.id WHERE NOT list_contains(p.seen, h.dst))
    SELECT root, id, min(d)::DOUBLE AS distance, arg_min(k, (d, k)) AS n_edges FROM p GROUP BY root, id"""
)
def weighted_shortest_paths(spark: SparkSession, sf: str) -> DataFrame:
    """Least sum of weights from every root of the flow to the nodes that it reaches; a weight is a small number of lines."""
    e = graph.project(edges(spark, sf), "STARTS_WITH", "JUMPS_TO").select("src", "dst", (1 + F.abs(F.coalesce("sourceline", F.lit(0))) % 7).alias("weight")).filter("src <> dst")
    roots = graph.degrees(e).filter("n_in = 0").select(F.col("id").alias("root"), "id")
    return graph.shortest_paths(e, roots).select("root", "id", "distance", "n_edges")


@query(WITH + "SELECT n.program, n.id AS node_id, d.id AS data_id, e.edge_type FROM edges e JOIN nodes n ON n.id = e.src JOIN data d ON d.id = e.dst WHERE e.edge_type IN ('ACCESSES', 'MODIFIES')")
def code_data_pairs(spark: SparkSession, sf: str) -> DataFrame:
    e = graph.project(edges(spark, sf), "ACCESSES", "MODIFIES").select("src", "dst", "edge_type")
    return e.join(nodes(spark, sf).select(F.col("id").alias("src"), "program"), "src").join(data_nodes(spark, sf).select(F.col("id").alias("dst")), "dst").select("program", F.col("src").alias("node_id"), F.col("dst").alias("data_id"), "edge_type")


@query(WITH + "SELECT program, r.v AS from_var, m.v AS to_var, id FROM (SELECT program, id, unnest(variablesread) AS v FROM nodes) r JOIN (SELECT id, unnest(variablesmodified) AS v FROM nodes) m USING (id)")
def flows_into_pairs(spark: SparkSession, sf: str) -> DataFrame:
    n = nodes(spark, sf)
    return n.select("program", "id", F.explode("variablesread").alias("from_var"), "variablesmodified").select("program", "id", "from_var", F.explode("variablesmodified").alias("to_var"))


@query("SELECT CASE WHEN c_acctbal < 0 THEN 'C:' || c_custkey ELSE 'N:' || c_nationkey END AS src, CASE WHEN c_acctbal < 0 THEN 'N:' || c_nationkey ELSE 'C:' || c_custkey END AS dst FROM customer")
def system_edge_direction(spark: SparkSession, sf: str) -> DataFrame:
    c = table(spark, sf, "customer").select(F.concat(F.lit("C:"), F.col("c_custkey").cast("string")).alias("a"), F.concat(F.lit("N:"), F.col("c_nationkey").cast("string")).alias("b"), (F.col("c_acctbal") < 0).alias("is_out"))
    return c.select(F.when(F.col("is_out"), F.col("a")).otherwise(F.col("b")).alias("src"), F.when(F.col("is_out"), F.col("b")).otherwise(F.col("a")).alias("dst"))


@query(_REACH + ", back AS (SELECT id FROM ends WHERE id NOT IN (SELECT src FROM cfg) UNION SELECT cfg.src FROM back JOIN cfg ON cfg.dst = back.id) SELECT DISTINCT r.id FROM r JOIN back ON back.id = r.id")
def graph_slice(spark: SparkSession, sf: str) -> DataFrame:
    """Nodes on a path from a root to a sink."""
    e, r = _reached(spark, sf)
    sinks = graph.degrees(e).filter("n_out = 0").select(F.lit(0).alias("root"), "id")
    back = graph.reach(e.select(F.col("dst").alias("src"), F.col("src").alias("dst")), sinks)
    return r.select("id").join(back.select("id"), "id", "left_semi").distinct()
