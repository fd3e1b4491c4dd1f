"""Queries of derived facts and generated documents."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodegraph.functions import text
from lodegraph.operators import corpus, derive, graph
from lodegraph.plans.base import WITH, WITH_RECURSIVE, chunks, data_nodes, edges, nodes
from lodegraph.plans.graphs import _TREE, _tree
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


_ORD = WITH + ", o AS (SELECT id, program, levelnumber AS l, row_number() OVER (PARTITION BY program ORDER BY row_id) AS n FROM data)"


@query(_ORD + " SELECT a.id, a.l AS levelnumber, CASE WHEN a.l BETWEEN 2 AND 49 THEN (SELECT arg_max(b.id, b.n) FROM o b WHERE b.program IS NOT DISTINCT FROM a.program AND b.n < a.n AND b.l BETWEEN 1 AND 48 AND b.l < a.l) WHEN a.l = 88 THEN (SELECT arg_max(b.id, b.n) FROM o b WHERE b.program IS NOT DISTINCT FROM a.program AND b.n < a.n AND b.l NOT IN (66, 88)) END AS parent FROM o a")
def level_number_tree(spark: SparkSession, sf: str) -> DataFrame:
    return derive.level_tree(data_nodes(spark, sf), "program", F.col("row_id"), "levelnumber", "id").select("id", "levelnumber", "parent")


@query(WITH + "SELECT program, arg_min(id, (sourceline, row_id)) AS id FROM nodes WHERE flow_type = 'CALL' AND program IS NOT NULL AND sourceline IS NOT NULL GROUP BY program")
def find_first_call(spark: SparkSession, sf: str) -> DataFrame:
    n = nodes(spark, sf).filter("program is not null and sourceline is not null")
    return derive.find_first(n, "program", F.struct("sourceline", "row_id"), F.col("flow_type") == "CALL", "id")


@query(_TREE + ", ok AS (SELECT id, coalesce(fieldname <> 'WS-RATE-CD' AND levelnumber < 88, false) AS ok FROM t), c AS (SELECT up.id, bool_and(ok.ok) AS ok, arg_max(up.ancestor, up.n) AS root, max(up.n) AS depth FROM up JOIN ok ON ok.id = up.ancestor GROUP BY up.id) SELECT root, arg_min(id, (-depth, id)) AS id, max(depth) AS depth FROM c WHERE ok GROUP BY root")
def find_narrowest(spark: SparkSession, sf: str) -> DataFrame:
    t = _tree(spark, sf)
    return derive.find_narrowest(graph.ancestor_closure(t, "id", "parent"), t, (F.col("fieldname") != "WS-RATE-CD") & (F.col("levelnumber") < 88))


@query(_TREE + "SELECT id FROM t WHERE levelnumber <= 10 AND id IN (SELECT u.ancestor FROM up u JOIN t x ON x.id = u.id WHERE u.n = 1 AND x.levelnumber = 10) AND id IN (SELECT u.ancestor FROM up u JOIN t x ON x.id = u.id WHERE u.n > 0 AND x.fieldname LIKE '%-CD')")
def find_where_paths(spark: SparkSession, sf: str) -> DataFrame:
    t = _tree(spark, sf)
    return derive.find_where(graph.ancestor_closure(t, "id", "parent"), t, F.col("levelnumber") <= 10, F.col("levelnumber") == 10, F.col("fieldname").like("%-CD")).select("id")


@query(
    WITH_RECURSIVE
    + ", f AS (SELECT DISTINCT src, dst FROM edges WHERE edge_type = 'FOLLOWED_BY'), p AS (SELECT id AS start, id, 0 AS n, [id] AS path FROM nodes WHERE flow_type = 'MOVE' UNION ALL SELECT p.start, f.dst, p.n + 1, list_append(p.path, f.dst) FROM p JOIN nodes m ON m.id = p.id AND m.flow_type = 'MOVE' JOIN f ON f.src = p.id WHERE NOT list_contains(p.path, f.dst)) SELECT p.start, p.id AS call_id, p.n AS n_edges, array_to_string(path, '>') AS path FROM p JOIN nodes c ON c.id = p.id AND c.flow_type = 'CALL'"
)
def variable_length_move_call(spark: SparkSession, sf: str) -> DataFrame:
    """Paths of any length over MOVE nodes that end at a CALL."""
    n = nodes(spark, sf)
    moves = n.filter("flow_type = 'MOVE'").select("id")
    f = graph.project(edges(spark, sf), "FOLLOWED_BY").join(moves.select(F.col("id").alias("src")), "src", "left_semi")
    p = graph.paths(f, moves).filter("n_edges > 0")
    return p.join(n.filter("flow_type = 'CALL'").select("id"), "id", "left_semi").select("start", F.col("id").alias("call_id"), "n_edges", F.array_join("path", ">").alias("path"))


@query(WITH + "SELECT id, v AS variable, flow_type IN ('IF_BRANCH', 'EVALUATE', 'EVALUATE_BRANCH', 'SEARCH', 'GOTO') AND contains(originaltext, v) AS is_control FROM (SELECT id, flow_type, originaltext, unnest(variablesread) AS v FROM nodes) WHERE v IS NOT NULL")
def control_use(spark: SparkSession, sf: str) -> DataFrame:
    n = nodes(spark, sf).select("id", "flow_type", "originaltext", F.explode("variablesread").alias("variable")).filter("variable is not null")
    return n.select("id", "variable", (F.col("flow_type").isin("IF_BRANCH", "EVALUATE", "EVALUATE_BRANCH", "SEARCH", "GOTO") & F.contains("originaltext", "variable")).alias("is_control"))


@query(WITH + "SELECT id, json_extract_string(metadata, '$.call_target') AS target, CASE WHEN json_extract_string(metadata, '$.dynamic') = 'true' THEN 'dynamic' ELSE 'static' END AS kind FROM nodes WHERE flow_type = 'CALL'")
def static_dynamic_calls(spark: SparkSession, sf: str) -> DataFrame:
    m = lambda p: F.get_json_object("metadata", p)
    return nodes(spark, sf).filter("flow_type = 'CALL'").select("id", m("$.call_target").alias("target"), F.when(m("$.dynamic") == "true", "dynamic").otherwise("static").alias("kind"))


_WANT = "files AS (SELECT program || CASE WHEN length(program) % 2 = 0 THEN '.cbl' ELSE '.CPY' END AS file FROM program_catalog UNION SELECT lower(program) FROM program_catalog WHERE source_kind = 'jcl'), want AS (SELECT DISTINCT program AS name FROM program_catalog UNION SELECT 'NOT-THERE' UNION SELECT lower(program) FROM program_catalog UNION SELECT substr(program, 2, 4) FROM program_catalog)"


@query(f"WITH {_WANT}, k AS (SELECT file, file AS k, 0 AS rank, 'exact' AS how FROM files UNION ALL SELECT file, upper(file), 1, 'case' FROM files UNION ALL SELECT file, regexp_replace(upper(file), '\\.[A-Z0-9]+$', ''), 2, 'extension' FROM files), c AS (SELECT * FROM k UNION ALL SELECT DISTINCT file, w.name, 3, 'contains' FROM files, (SELECT DISTINCT upper(name) AS name FROM want) w WHERE length(w.name) >= 3 AND contains(regexp_replace(upper(file), '\\.[A-Z0-9]+$', ''), w.name)), m AS (SELECT name, arg_min((file, how), (rank, file)) AS r FROM want JOIN c k ON k.k = name OR k.k = upper(name) GROUP BY name) SELECT want.name, r[1] AS file, r[2] AS how FROM want LEFT JOIN m ON m.name = want.name")
def copybook_resolver(spark: SparkSession, sf: str) -> DataFrame:
    p = table(spark, sf, "program_catalog")
    files = p.select(F.concat("program", F.when(F.length("program") % 2 == 0, ".cbl").otherwise(".CPY")).alias("file")).union(p.filter("source_kind = 'jcl'").select(F.lower("program")))
    want = p.select(F.col("program").alias("name")).union(p.select(F.lower("program"))).union(spark.createDataFrame([("NOT-THERE",)], "name string")).union(p.select(F.substring("program", 2, 4)))
    return derive.resolve_names(want, files, "name", "file")


@query(r"WITH l AS (SELECT row_id, unnest(regexp_split_to_array(text, '\r?\n')) AS line FROM chunk WHERE lower(trim(chunk_type, ' ')) = 'step_detail' AND text IS NOT NULL), s AS (SELECT DISTINCT row_id, regexp_extract(line, '^//\S*\s+EXEC\s+PGM=([A-Z0-9]+)', 1) AS program FROM l WHERE regexp_matches(line, '^//\S*\s+EXEC\s+PGM=')) SELECT row_id, program, program IN ('IEFBR14', 'ICEMAN', 'IDCAMS', 'IEBGENER', 'SORT', 'PARM2SK') AS is_utility, program IN (SELECT program FROM program_catalog) AS in_corpus FROM s")
def step_program_enrichment(spark: SparkSession, sf: str) -> DataFrame:
    c = table(spark, sf, "chunk").filter("lower(trim(chunk_type)) = 'step_detail' and text is not null")
    steps = c.select("row_id", F.explode(F.regexp_extract_all("text", F.lit(r"(?m)^//\S*[ ]+EXEC[ ]+PGM=([A-Z0-9]+)"), F.lit(1))).alias("program")).distinct()
    return derive.step_programs(steps, table(spark, sf, "program_catalog")).select("row_id", "program", "is_utility", "in_corpus")


@query(WITH + ", own AS (SELECT program, parent_id AS copybook, fieldname FROM data WHERE parent_id IS NOT NULL AND fieldname IS NOT NULL AND program IS NOT NULL), used AS (SELECT DISTINCT program, v FROM (SELECT program, unnest(list_concat(coalesce(variablesread, []), coalesce(variablesmodified, []))) AS v FROM nodes) WHERE v IS NOT NULL) SELECT copybook, count(DISTINCT fieldname) AS n_fields, count(DISTINCT CASE WHEN u.v IS NOT NULL THEN fieldname END) AS n_used, count(u.v) = 0 AS is_candidate FROM own LEFT JOIN used u ON u.program = own.program AND u.v = own.fieldname GROUP BY copybook")
def unused_copybook_analysis(spark: SparkSession, sf: str) -> DataFrame:
    own = data_nodes(spark, sf).filter("parent_id is not null and fieldname is not null and program is not null").select("program", F.col("parent_id").alias("copybook"), "fieldname")
    none = F.array().cast("array<string>")
    used = nodes(spark, sf).select("program", F.explode(F.concat(F.coalesce("variablesread", none), F.coalesce("variablesmodified", none))).alias("fieldname")).filter("fieldname is not null").distinct().withColumn("u", F.lit(1))
    g = own.join(used, ["program", "fieldname"], "left").groupBy("copybook")
    return g.agg(F.count_distinct("fieldname").alias("n_fields"), F.count_distinct(F.when(F.col("u") == 1, F.col("fieldname"))).alias("n_used"), (F.count("u") == 0).alias("is_candidate"))


@query(WITH + ", a AS (SELECT program, fieldname AS variable, min(id) AS origin, 0 AS rank FROM data WHERE fieldname IS NOT NULL AND program IS NOT NULL GROUP BY ALL), b AS (SELECT program, v AS variable, min(id) AS origin, 1 AS rank FROM (SELECT program, id, unnest(variablesmodified) AS v FROM nodes) WHERE v IS NOT NULL AND program IS NOT NULL GROUP BY ALL), u AS (SELECT * FROM a UNION ALL SELECT * FROM b) SELECT program, variable, arg_min(origin, rank) AS origin, string_agg(rank::VARCHAR, ',' ORDER BY rank) AS sources FROM u GROUP BY program, variable")
def provenance_merge(spark: SparkSession, sf: str) -> DataFrame:
    a = data_nodes(spark, sf).filter("fieldname is not null and program is not null").groupBy("program", F.col("fieldname").alias("variable")).agg(F.min("id").alias("origin"))
    b = nodes(spark, sf).filter("program is not null").select("program", "id", F.explode("variablesmodified").alias("variable")).filter("variable is not null").groupBy("program", "variable").agg(F.min("id").alias("origin"))
    return derive.merge_provenance([a, b], ["program", "variable"])


@query(WITH + "SELECT v AS variable, string_agg(DISTINCT flow_type, ',' ORDER BY flow_type) AS assigned_by FROM (SELECT flow_type, unnest(variablesmodified) AS v FROM nodes) WHERE v IS NOT NULL AND flow_type IS NOT NULL GROUP BY v")
def static_assignment_sets(spark: SparkSession, sf: str) -> DataFrame:
    a = nodes(spark, sf).filter("flow_type is not null").select("flow_type", F.explode("variablesmodified").alias("variable")).filter("variable is not null")
    return a.groupBy("variable").agg(F.array_join(F.sort_array(F.collect_set("flow_type")), ",").alias("assigned_by"))


@query(_TREE + "SELECT up.ancestor AS id, sum(length(coalesce(t.fieldname, ''))) AS size_below, count(*) AS n FROM up JOIN t ON t.id = up.id GROUP BY up.ancestor")
def bottom_up_fold(spark: SparkSession, sf: str) -> DataFrame:
    """Sizes summed from the leaves up: each row's total holds those of all rows below it."""
    t = _tree(spark, sf)
    c = graph.ancestor_closure(t, "id", "parent").join(t.select("id", F.length(F.coalesce("fieldname", F.lit(""))).alias("s")), "id")
    return c.groupBy(F.col("ancestor").alias("id")).agg(F.sum("s").alias("size_below"), F.count(F.lit(1)).alias("n"))


@query(WITH + "SELECT program, count(DISTINCT target) AS n_callees, count(*) AS n_nodes FROM (SELECT program, json_extract_string(metadata, '$.call_target') AS target FROM nodes WHERE flow_type IN ('CALL', 'PERFORM')) GROUP BY program HAVING count(DISTINCT target) >= 1 AND count(*) >= 2")
def workflow_detection(spark: SparkSession, sf: str) -> DataFrame:
    n = nodes(spark, sf).filter("flow_type in ('CALL', 'PERFORM')").select("program", F.get_json_object("metadata", "$.call_target").alias("target"))
    return n.groupBy("program").agg(F.count_distinct("target").alias("n_callees"), F.count(F.lit(1)).alias("n_nodes")).filter("n_callees >= 1 and n_nodes >= 2")


@query(
    WITH_RECURSIVE
    + """, u AS (SELECT src AS a, dst AS b FROM edges WHERE edge_type = 'CONTAINS_CODE' UNION SELECT dst, src FROM edges WHERE edge_type = 'CONTAINS_CODE'), c AS (SELECT a AS id, a AS l FROM u UNION SELECT u.b, c.l FROM c JOIN u ON u.a = c.id),
    root AS (SELECT id, min(l) AS root FROM c GROUP BY id), d AS (SELECT id, root, 0 AS depth, [id] AS seen FROM root WHERE id = root UNION SELECT u.b, d.root, d.depth + 1, list_append(d.seen, u.b) FROM d JOIN u ON u.a = d.id WHERE NOT list_contains(d.seen, u.b))
    SELECT root, id, min(depth) AS depth FROM d GROUP BY ALL"""
)
def shortest_undirected_path(spark: SparkSession, sf: str) -> DataFrame:
    """Least number of edges from the least node of each weak component to all of its nodes."""
    e = graph.project(edges(spark, sf), "CONTAINS_CODE").select("src", "dst")
    roots = graph.components(e).select(F.col("component").alias("root"), F.col("component").alias("id")).distinct()
    return graph.reach(e.union(e.select("dst", "src")), roots)


@query(
    """WITH l AS (SELECT o.o_orderkey AS job, l.l_linenumber AS n, CASE WHEN o.o_orderkey % 2 = 0 THEN 'call' END AS env FROM orders o JOIN lineitem l ON l.l_orderkey = o.o_orderkey)
    SELECT job, n, 'P' || n AS proc, m, 'PGM' || m AS program, coalesce(env, 'default') AS env FROM l, range(1, 3) r(m) WHERE n <= 2 UNION ALL SELECT job, n, 'P' || n, NULL, NULL, env FROM l WHERE n > 2"""
)
def procedure_expansion(spark: SparkSession, sf: str) -> DataFrame:
    """All steps: those of P1 and P2 expanded, those whose procedure is unknown kept without m and program."""
    l = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber").join(table(spark, sf, "orders").select("o_orderkey"), F.col("l_orderkey") == F.col("o_orderkey"))
    env = F.when(F.col("o_orderkey") % 2 == 0, F.create_map(F.lit("ENV"), F.lit("call"))).otherwise(F.create_map().cast("map<string,string>"))
    steps = l.select(F.col("o_orderkey").alias("job"), F.col("l_linenumber").alias("n"), F.concat(F.lit("P"), F.col("l_linenumber").cast("string")).alias("proc"), env.alias("symbols"))
    procs = spark.createDataFrame([(f"P{p}", m, f"PGM{m}", {"ENV": "default"}) for p in (1, 2) for m in (1, 2)], "proc string, m int, program string, defaults map<string,string>")
    return derive.expand_procedures(steps, procs).select("job", "n", "proc", "m", "program", F.col("symbols")["ENV"].alias("env"))


@query(
    r"""WITH RECURSIVE l AS (SELECT row_id, i, x[i] AS line, len(list_filter(regexp_split_to_array(x[i], '\s+'), lambda t: t <> '')) AS w, len(x) AS m FROM (SELECT row_id, regexp_split_to_array(text, '\r?\n') AS x FROM chunk WHERE text IS NOT NULL AND lower(trim(chunk_type, ' ')) = 'variable_group'), LATERAL (SELECT unnest(range(1, len(x) + 1)) AS i)),
    p AS (SELECT row_id, i, m, 0 AS part, w AS n, line AS now, w AS own FROM l WHERE i = 1
    UNION ALL SELECT l.row_id, l.i, l.m, CASE WHEN p.n > 0 AND p.n + l.w > 120 THEN p.part + 1 ELSE p.part END, CASE WHEN p.n > 0 AND p.n + l.w > 120 THEN l.w ELSE p.n + l.w END,
    CASE WHEN p.n > 0 AND p.n + l.w > 120 THEN 'Variables (continued):' || chr(10) || l.line WHEN p.n = 0 THEN l.line ELSE p.now || chr(10) || l.line END, l.w FROM p JOIN l ON l.row_id = p.row_id AND l.i = p.i + 1)
    SELECT row_id, part, arg_max(now, i) AS text FROM p GROUP BY row_id, part"""
)
def packed_lines(spark: SparkSession, sf: str) -> DataFrame:
    c = table(spark, sf, "chunk").filter("text is not null and lower(trim(chunk_type)) = 'variable_group'")
    return c.select("row_id", F.posexplode(derive.pack_lines(F.col("text"), "Variables", 120)).alias("part", "text"))


@query("SELECT program, count(*) FILTER (WHERE parse_quality = 'full') AS full_, count(*) FILTER (WHERE parse_quality = 'partial') AS partial_, count(*) FILTER (WHERE parse_quality = 'degraded') AS degraded FROM chunk GROUP BY program")
def quality_counts(spark: SparkSession, sf: str) -> DataFrame:
    q = F.col("parse_quality")
    return table(spark, sf, "chunk").groupBy("program").agg(F.count_if(q == "full").alias("full_"), F.count_if(q == "partial").alias("partial_"), F.count_if(q == "degraded").alias("degraded"))


@query(WITH + ", f AS (SELECT c.program, EXISTS (SELECT 1 FROM nodes n WHERE upper(n.program) = c.program) AS g, EXISTS (SELECT 1 FROM chunks k WHERE k.program = c.program) AS k, EXISTS (SELECT 1 FROM unified_model u WHERE u.program = c.program) AS u FROM program_catalog c) SELECT program, CASE WHEN g AND k AND u THEN 'complete' WHEN g OR k OR u THEN 'partial' ELSE 'missing' END AS health FROM f")
def program_health(spark: SparkSession, sf: str) -> DataFrame:
    has = lambda df, name: df.select(F.upper("program").alias("program")).filter("program is not null").distinct().withColumn(name, F.lit(True))
    p = table(spark, sf, "program_catalog").select("program").join(has(nodes(spark, sf), "g"), "program", "left").join(has(chunks(spark, sf), "k"), "program", "left").join(has(table(spark, sf, "unified_model"), "u"), "program", "left")
    return p.select("program", F.when(F.col("g") & F.col("k") & F.col("u"), "complete").when(F.coalesce("g", "k", "u").isNotNull(), "partial").otherwise("missing").alias("health"))


@query("SELECT row_id, upper(op) AS command FROM (SELECT row_id, unnest(regexp_extract_all(text, 'EXEC CICS (\\w+)', 1)) AS op FROM chunk WHERE text IS NOT NULL)")
def cics_operations(spark: SparkSession, sf: str) -> DataFrame:
    c = table(spark, sf, "chunk").filter("text is not null").select("row_id", F.explode(F.regexp_extract_all("text", F.lit(r"EXEC CICS \w+"), F.lit(0))).alias("s"))
    return c.select("row_id", text.cics_command("s").alias("command"))


_GEN = WITH + """, v AS (SELECT program, v AS variable, count(*) FILTER (WHERE r) AS nr, count(*) FILTER (WHERE NOT r) AS nw FROM (SELECT program, unnest(variablesread) AS v, true AS r FROM nodes UNION ALL SELECT program, unnest(variablesmodified), false FROM nodes) WHERE v IS NOT NULL AND program IS NOT NULL GROUP BY ALL),
calls AS (SELECT program, list_sort(list_distinct(list(json_extract_string(metadata, '$.call_target')) FILTER (WHERE json_extract_string(metadata, '$.call_target') IS NOT NULL))) AS t FROM nodes WHERE flow_type = 'CALL' AND program IS NOT NULL GROUP BY program),
dead AS (SELECT program, count(*) AS n FROM nodes WHERE reachable IS FALSE AND program IS NOT NULL GROUP BY program),
sql AS (SELECT program, list_sort(list_distinct(list(json_extract_string(metadata, '$.sql_operation')) FILTER (WHERE json_extract_string(metadata, '$.sql_operation') IS NOT NULL))) AS t FROM nodes WHERE flow_type = 'EXEC_SQL' AND program IS NOT NULL GROUP BY program),
prog AS (SELECT program, count(*) AS n, count(*) FILTER (WHERE flow_type = 'PARAGRAPH') AS p FROM nodes WHERE program IS NOT NULL GROUP BY program)
SELECT program || ':dataflow.variable:' || variable AS chunk_id, 'dataflow.variable' AS chunk_type, program, 'Variable ' || variable || ' is read ' || nr || ' times and written ' || nw || ' times.' AS text FROM v
UNION ALL SELECT program || ':external_program_calls:ALL', 'external_program_calls', program, 'Program ' || program || ' calls ' || array_to_string(t[1:10], ', ') || CASE WHEN len(t) > 10 THEN ' … and ' || (len(t) - 10) || ' more' ELSE '' END || '.' FROM calls WHERE len(t) > 0
UNION ALL SELECT program || ':dead_code:ALL', 'dead_code', program, n || ' statements of ' || program || ' are never reached.' FROM dead
UNION ALL SELECT program || ':sql_operation:ALL', 'sql_operation', program, 'SQL in ' || program || ': ' || array_to_string(t, ', ') || '.' FROM sql WHERE len(t) > 0
UNION ALL SELECT program || ':program_summary:ALL', 'program_summary', program, 'Program ' || program || ' has ' || n || ' statements in ' || p || ' paragraphs.' FROM prog"""


@query(_GEN)
def generated_chunks(spark: SparkSession, sf: str) -> DataFrame:
    """Documents generated from facts: variables, calls, dead code, SQL and program summaries."""
    n = nodes(spark, sf).filter("program is not null")
    s = lambda c: F.col(c).cast("string")
    say = lambda *parts: F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])
    use = lambda c, r: n.select("program", F.explode(c).alias("variable"), F.lit(r).alias("r"))
    v = use("variablesread", True).unionByName(use("variablesmodified", False)).filter("variable is not null").groupBy("program", "variable").agg(F.count_if("r").alias("nr"), F.count_if(~F.col("r")).alias("nw"))
    found = lambda kind, path: n.filter(F.col("flow_type") == kind).groupBy("program").agg(F.sort_array(F.collect_set(F.get_json_object("metadata", path))).alias("t")).filter("size(t) > 0")
    dead = n.filter("reachable = false").groupBy("program").agg(F.count(F.lit(1)).alias("n"))
    prog = n.groupBy("program").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("flow_type") == "PARAGRAPH").alias("p"))
    p, every = F.col("program"), F.lit("ALL")
    out = [
        derive.generated("dataflow.variable", v, "program", F.col("variable"), say("Variable ", F.col("variable"), " is read ", s("nr"), " times and written ", s("nw"), " times.")),
        derive.generated("external_program_calls", found("CALL", "$.call_target"), "program", every, say("Program ", p, " calls ", derive.listing(F.col("t"), 10), ".")),
        derive.generated("dead_code", dead, "program", every, say(s("n"), " statements of ", p, " are never reached.")),
        derive.generated("sql_operation", found("EXEC_SQL", "$.sql_operation"), "program", every, say("SQL in ", p, ": ", F.array_join("t", ", "), ".")),
        derive.generated("program_summary", prog, "program", every, say("Program ", p, " has ", s("n"), " statements in ", s("p"), " paragraphs.")),
    ]
    return reduce(DataFrame.unionByName, out)


@query("SELECT chunk_id, count(*) AS n, sum(total_tokens) AS tokens, string_agg(DISTINCT t, ',' ORDER BY t) AS terms FROM (SELECT chunk_id, total_tokens, unnest(structured_terms) AS t FROM bm25_entry WHERE chunk_id IS NOT NULL) GROUP BY chunk_id")
def structured_terms(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "bm25_entry").filter("chunk_id is not null").select("chunk_id", "total_tokens", F.explode("structured_terms").alias("t"))
    return e.groupBy("chunk_id").agg(F.count(F.lit(1)).alias("n"), F.sum("total_tokens").alias("tokens"), F.array_join(F.sort_array(F.collect_set("t")), ",").alias("terms"))


@query(f"SELECT lower(trim(chunk_type, ' ')) AS chunk_type, percentile_rank, q FROM (SELECT chunk_type, unnest([0.1, 0.5, 0.9]) AS percentile_rank, round(unnest(quantile_cont(n, [0.1, 0.5, 0.9])), 2) AS q FROM (SELECT lower(trim(chunk_type, ' ')) AS chunk_type, length(text) AS n FROM chunk WHERE text IS NOT NULL) GROUP BY chunk_type)")
def text_length_percentiles(spark: SparkSession, sf: str) -> DataFrame:
    c = table(spark, sf, "chunk").filter("text is not null").groupBy(F.lower(F.trim("chunk_type")).alias("chunk_type")).agg(*[corpus.percentile(F.length("text"), p).alias(str(p)) for p in (0.1, 0.5, 0.9)])
    return c.select("chunk_type", F.inline(F.array(*[F.struct(F.lit(p).alias("percentile_rank"), F.col(f"`{p}`").alias("q")) for p in (0.1, 0.5, 0.9)])))
