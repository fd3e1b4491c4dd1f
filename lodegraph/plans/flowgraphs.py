"""Flow-graph queries over the programs' flow graphs, and over users' transitions between event types."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lodegraph.operators import flowgraph as fg
from lodegraph.operators import graph
from lodegraph.plans.base import WITH_RECURSIVE, data_nodes, edges, nodes
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


#: A user's transitions are taken within spans of so many days, so that graphs differ in shape.
_E = """WITH RECURSIVE ev AS (SELECT user_id * 10000 + date_diff('day', TIMESTAMP '1970-01-01', ts) // 30 AS graph_id, event_type, ts, event_id FROM events),
st AS (SELECT graph_id, event_type AS src, lead(event_type) OVER (PARTITION BY graph_id ORDER BY ts, event_id) AS dst, first_value(event_type) OVER (PARTITION BY graph_id ORDER BY ts, event_id) AS root FROM ev),
e AS (SELECT DISTINCT graph_id, src, dst, root FROM st WHERE dst IS NOT NULL)
"""


def transitions(spark: SparkSession, sf: str) -> DataFrame:
    day = F.floor(F.unix_timestamp("ts") / 86400).cast("long")
    ev = table(spark, sf, "events").select((F.col("user_id") * 10000 + F.floor(day / 30)).cast("long").alias("graph_id"), "event_type", "ts", "event_id")
    w = Window.partitionBy("graph_id").orderBy("ts", "event_id")
    st = ev.select("graph_id", F.col("event_type").alias("src"), F.lead("event_type").over(w).alias("dst"), F.first("event_type").over(w).alias("root"))
    return st.filter("dst is not null").distinct()


@query(_E + "SELECT graph_id, src, dst FROM e")
def followed_by_edges(spark: SparkSession, sf: str) -> DataFrame:
    return transitions(spark, sf).select("graph_id", "src", "dst")


#: Flow edges of a program, and an entry that leads to every node without an edge into it; to the least node
#: where a program has none such.
ENTRY = "ENTRY"
_P = WITH_RECURSIVE + """, f AS (SELECT DISTINCT program AS graph_id, src, dst FROM edges WHERE edge_type IN ('FOLLOWED_BY', 'STARTS_WITH', 'JUMPS_TO') AND program IS NOT NULL),
ids AS (SELECT graph_id, src AS id FROM f UNION SELECT graph_id, dst FROM f),
top AS (SELECT graph_id, id FROM ids i WHERE NOT EXISTS (SELECT 1 FROM f WHERE f.graph_id = i.graph_id AND f.dst = i.id AND f.src <> f.dst)),
e AS (SELECT graph_id, src, dst FROM f UNION SELECT graph_id, 'ENTRY', id FROM top UNION SELECT graph_id, 'ENTRY', min(id) FROM ids WHERE graph_id NOT IN (SELECT graph_id FROM top) GROUP BY graph_id),
live AS (SELECT DISTINCT graph_id, 'ENTRY' AS id FROM e UNION SELECT e.graph_id, e.dst FROM live JOIN e ON e.graph_id = live.graph_id AND e.src = live.id),
le AS (SELECT e.* FROM e JOIN live l ON l.graph_id = e.graph_id AND l.id = e.src)
"""
_DOM = _P + """, w AS (SELECT graph_id, id AS cut, 'ENTRY' AS at FROM live WHERE id <> 'ENTRY' UNION SELECT w.graph_id, w.cut, le.dst FROM w JOIN le ON le.graph_id = w.graph_id AND le.src = w.at WHERE le.dst <> w.cut),
dom AS (SELECT x.graph_id, x.id AS d, y.id AS n FROM live x JOIN live y ON y.graph_id = x.graph_id AND y.id <> x.id WHERE x.id = 'ENTRY' OR NOT EXISTS (SELECT 1 FROM w WHERE w.graph_id = x.graph_id AND w.cut = x.id AND w.at = y.id)),
k AS (SELECT graph_id, n AS d, count(*) AS k FROM dom GROUP BY ALL), idom AS (SELECT l.graph_id, l.id, arg_max(dom.d, coalesce(k.k, 0)) AS idom FROM live l LEFT JOIN dom ON dom.graph_id = l.graph_id AND dom.n = l.id LEFT JOIN k ON k.graph_id = dom.graph_id AND k.d = dom.d GROUP BY ALL),
back AS (SELECT graph_id, src, dst FROM le WHERE src = dst OR (graph_id, dst, src) IN (SELECT (graph_id, d, n) FROM dom)),
body AS (SELECT graph_id, dst AS header, dst AS id FROM back UNION SELECT graph_id, dst, src FROM back UNION SELECT b.graph_id, b.header, le.src FROM body b JOIN le ON le.graph_id = b.graph_id AND le.dst = b.id WHERE b.id <> b.header)
"""
_SCC = _P + """, cl AS (SELECT graph_id, src AS a, dst AS b FROM le UNION SELECT cl.graph_id, cl.a, le.dst FROM cl JOIN le ON le.graph_id = cl.graph_id AND le.src = cl.b),
scc AS (SELECT l.graph_id, l.id, least(l.id, coalesce(min(x.b), l.id)) AS component FROM live l LEFT JOIN (SELECT x.* FROM cl x JOIN cl y ON y.graph_id = x.graph_id AND y.a = x.b AND y.b = x.a) x ON x.graph_id = l.graph_id AND x.a = l.id GROUP BY l.graph_id, l.id),
entered AS (SELECT b.graph_id, b.component, count(DISTINCT le.dst) AS n_entries FROM le JOIN scc a ON a.graph_id = le.graph_id AND a.id = le.src JOIN scc b ON b.graph_id = le.graph_id AND b.id = le.dst WHERE a.component <> b.component GROUP BY ALL HAVING count(DISTINCT le.dst) > 1)
"""


def program_graphs(spark: SparkSession, sf: str) -> DataFrame:
    """(graph_id, src, dst, root): the flow graph of every program, entered at ENTRY."""
    e = graph.project(edges(spark, sf), "FOLLOWED_BY", "STARTS_WITH", "JUMPS_TO").filter("program is not null").select(F.col("program").alias("graph_id"), "src", "dst").distinct()
    ends = F.inline(F.array(F.struct(F.col("src").alias("id"), F.lit(0).alias("into")), F.struct(F.col("dst").alias("id"), (F.col("src") != F.col("dst")).cast("int").alias("into"))))
    ids = e.select("graph_id", ends).groupBy("graph_id", "id").agg(F.sum("into").alias("n_in"))
    least = ids.groupBy("graph_id").agg(F.min("id").alias("least"), F.min("n_in").alias("fewest"))
    tops = ids.join(least, "graph_id").filter("n_in = 0 or (fewest > 0 and id = least)").select("graph_id", F.lit(ENTRY).alias("src"), F.col("id").alias("dst"))
    return e.unionByName(tops).withColumn("root", F.lit(ENTRY))


def live_graphs(spark: SparkSession, sf: str) -> DataFrame:
    """The parts of the flow graphs that the entry reaches."""
    g = program_graphs(spark, sf)
    at = lambda i: F.concat_ws("\0", "graph_id", i)
    roots = g.select(F.lit(0).alias("root"), at(F.lit(ENTRY)).alias("id")).distinct()
    seen = graph.reach(g.select(at("src").alias("src"), at("dst").alias("dst")), roots).select(F.col("id").alias("_at"))
    return g.withColumn("_at", at("src")).join(seen, "_at", "left_semi").drop("_at")


@query(_P + "SELECT * FROM e")
def program_flow_edges(spark: SparkSession, sf: str) -> DataFrame:
    return program_graphs(spark, sf).select("graph_id", "src", "dst")


@query()
def dfs_intervals(spark: SparkSession, sf: str) -> DataFrame:
    return fg.dfs_table(program_graphs(spark, sf))


@query()
def edge_classification(spark: SparkSession, sf: str) -> DataFrame:
    return fg.edge_kinds(program_graphs(spark, sf))


@query(_DOM + "SELECT * FROM idom")
def dominators(spark: SparkSession, sf: str) -> DataFrame:
    return fg.dominator_table(program_graphs(spark, sf))


@query(_DOM + "SELECT graph_id, idom AS src, id AS dst, 'D' AS kind FROM idom WHERE idom IS NOT NULL UNION ALL SELECT le.graph_id, le.src, le.dst, CASE WHEN b.src IS NULL THEN 'CJ' ELSE 'BJ' END FROM le JOIN idom i ON i.graph_id = le.graph_id AND i.id = le.dst LEFT JOIN back b ON b.graph_id = le.graph_id AND b.src = le.src AND b.dst = le.dst WHERE i.idom IS DISTINCT FROM le.src")
def dj_graph(spark: SparkSession, sf: str) -> DataFrame:
    return fg.join_edges(program_graphs(spark, sf))


@query(_DOM + "SELECT graph_id, header, (SELECT count(*) FROM back b WHERE b.graph_id = body.graph_id AND b.dst = header) AS n_tails, count(*) AS n_nodes FROM body GROUP BY graph_id, header")
def natural_loops(spark: SparkSession, sf: str) -> DataFrame:
    return fg.loops(program_graphs(spark, sf))


@query(_DOM + "," + _SCC[len(_P) + 1 :] + "SELECT graph_id, header, 'reducible' AS kind, id FROM body UNION ALL SELECT s.graph_id, s.component, 'irreducible', s.id FROM scc s JOIN entered USING (graph_id, component)")
def loop_bodies(spark: SparkSession, sf: str) -> DataFrame:
    return fg.loop_nodes(program_graphs(spark, sf))


@query(_DOM + ", fw AS (SELECT * FROM le WHERE (graph_id, src, dst) NOT IN (SELECT (graph_id, src, dst) FROM back)), ac AS (SELECT graph_id, src AS a, dst AS b FROM fw UNION SELECT ac.graph_id, ac.a, fw.dst FROM ac JOIN fw ON fw.graph_id = ac.graph_id AND fw.src = ac.b) SELECT graph_id, NOT bool_or(a = b) AS is_reducible FROM ac GROUP BY graph_id")
def reducibility(spark: SparkSession, sf: str) -> DataFrame:
    """By T1-T2; the SQL asks whether the graph without its natural back edges has no cycle."""
    return fg.reducibility(program_graphs(spark, sf)).select("graph_id", "is_reducible")


@query()
def limit_graphs(spark: SparkSession, sf: str) -> DataFrame:
    """Nodes that T1-T2 leaves of every program's graph."""
    return fg.reducibility(program_graphs(spark, sf))


@query(_SCC + "SELECT * FROM scc")
def scc_components(spark: SparkSession, sf: str) -> DataFrame:
    return fg.components(live_graphs(spark, sf))


@query(_SCC + "SELECT * FROM entered")
def improper_components(spark: SparkSession, sf: str) -> DataFrame:
    e = live_graphs(spark, sf)
    return fg.improper_components(e, fg.components(e))


@query(
    _P
    + """, o AS (SELECT graph_id, src, count(*) AS n FROM le GROUP BY ALL), i AS (SELECT graph_id, dst AS id, count(*) AS n, min(src) AS src FROM le GROUP BY ALL),
up AS (SELECT i.graph_id, i.id, i.src FROM i JOIN o ON o.graph_id = i.graph_id AND o.src = i.src WHERE i.n = 1 AND o.n = 1 AND i.id <> i.src),
walk AS (SELECT graph_id, id, id AS top, 0 AS k FROM live UNION ALL SELECT w.graph_id, w.id, up.src, w.k + 1 FROM walk w JOIN up ON up.graph_id = w.graph_id AND up.id = w.top)
SELECT graph_id, id, arg_max(top, k) AS leader FROM walk GROUP BY graph_id, id"""
)
def basic_blocks(spark: SparkSession, sf: str) -> DataFrame:
    return fg.basic_blocks(live_graphs(spark, sf))


@query()
def reaching_conditions(spark: SparkSession, sf: str) -> DataFrame:
    """Conditions of every node; an edge out of a branch holds under the branch's text, further ones under its negation."""
    n = nodes(spark, sf).filter("flow_type in ('IF_BRANCH', 'EVALUATE_BRANCH')").select(F.col("id").alias("src"), F.col("originaltext").alias("_text")).distinct()
    first = F.min("dst").over(Window.partitionBy("graph_id", "src")) == F.col("dst")
    e = program_graphs(spark, sf).join(n, "src", "left").withColumn("_first", first)
    said = F.coalesce(F.trim("_text"), F.col("src"))
    return fg.reaching_conditions(e.withColumn("condition", F.when(F.col("_text").isNotNull(), F.when(F.col("_first"), said).otherwise(F.concat(F.lit("not("), said, F.lit(")"))))))


@query("""WITH r AS (SELECT program, paragraph AS name, min(row_id) AS first, max(row_id) AS last FROM chunk WHERE program IS NOT NULL AND paragraph IS NOT NULL GROUP BY ALL)
SELECT a.program, a.name, NOT EXISTS (SELECT 1 FROM r b WHERE b.program = a.program AND b.name <> a.name AND ((b.first < a.first AND b.last >= a.first AND b.last < a.last) OR (b.first > a.first AND b.first <= a.last AND b.last > a.last))) AS is_clean FROM r a""")
def procedure_ranges(spark: SparkSession, sf: str) -> DataFrame:
    c = table(spark, sf, "chunk").filter("program is not null and paragraph is not null")
    return fg.overlapping_ranges(c.groupBy("program", F.col("paragraph").alias("name")).agg(F.min("row_id").alias("first"), F.max("row_id").alias("last")))


def _record_trees(spark: SparkSession, sf: str) -> DataFrame:
    d = data_nodes(spark, sf)
    roots = d.filter("levelnumber = 1 and program is not null").select("program", F.col("id").alias("root"), "row_id")
    trees = fg.preorder_trees(roots.select(F.col("root").alias("id"), "row_id"), d.select("id", "parent_id", "row_id", F.coalesce("datatype", F.lit("")).alias("label")))
    return roots.join(trees, "root")


@query()
def tree_shapes(spark: SparkSession, sf: str) -> DataFrame:
    """The shape of every record: the least row id of the records whose whole trees are equal."""
    return fg.tree_shapes(_record_trees(spark, sf))


@query()
def tree_edit_distance(spark: SparkSession, sf: str) -> DataFrame:
    """Distances of the shapes of records whose row id is divisible by 20 to all shapes of their program."""
    return fg.shape_distances(_record_trees(spark, sf), F.col("row_id") % 20 == 0)


@query()
def frequent_subgraphs(spark: SparkSession, sf: str) -> DataFrame:
    """Connected patterns of one to three flow edges of any shape that at least five programs hold."""
    kind = nodes(spark, sf).select("id", F.coalesce("flow_type", F.lit("")).alias("flow_type"))
    e = program_graphs(spark, sf).filter(F.col("src") != ENTRY).select("graph_id", "src", "dst")
    e = e.join(kind.select(F.col("id").alias("src"), F.col("flow_type").alias("src_label")), "src").join(kind.select(F.col("id").alias("dst"), F.col("flow_type").alias("dst_label")), "dst")
    return fg.frequent_patterns(e, 5, 3)


@query()
def agglomerative_linkage(spark: SparkSession, sf: str) -> DataFrame:
    """One dendrogram of all vectors, which bear their ids; a cluster bears that of its first vector."""
    v = table(spark, sf, "embeddings").filter("embedding is not null").select(F.col("vec_id").cast("string").alias("name"), F.col("embedding").alias("v"))

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame(fg.ward_linkage(sorted((n, list(x)) for n, x in zip(pdf["name"], pdf["v"]))), columns=["step", "a", "b", "distance", "size"])

    return v.withColumn("one", F.lit(1)).groupBy("one").applyInPandas(run, "step int, a string, b string, distance double, size int")


@query(
    _E
    + """, u AS (SELECT graph_id, src AS a, dst AS b FROM e WHERE src <> dst UNION SELECT graph_id, dst, src FROM e WHERE src <> dst), n AS (SELECT graph_id, src AS id FROM e UNION SELECT graph_id, dst FROM e),
adj AS (SELECT n.graph_id, n.id, coalesce(list(u.b) FILTER (WHERE u.b IS NOT NULL), []) AS near FROM n LEFT JOIN u ON u.graph_id = n.graph_id AND u.a = n.id GROUP BY ALL),
c AS (SELECT graph_id, [id] AS m FROM adj UNION ALL SELECT c.graph_id, list_append(c.m, adj.id) FROM c JOIN adj ON adj.graph_id = c.graph_id AND adj.id > c.m[-1] AND list_has_all(adj.near, c.m))
SELECT c.graph_id, len(m) AS size, array_to_string(m, ',') AS members FROM c WHERE NOT EXISTS (SELECT 1 FROM adj WHERE adj.graph_id = c.graph_id AND list_has_all(adj.near, c.m))"""
)
def maximal_cliques(spark: SparkSession, sf: str) -> DataFrame:
    return fg.maximal_cliques(transitions(spark, sf))
