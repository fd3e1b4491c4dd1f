"""Generated documents: one query per chunk type, fact tables of CICS statements, JCL statements, knowledge-base files."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lodegraph.functions import cics, jcl, text
from lodegraph.operators import cobol, derive, graph
from lodegraph.plans.base import WITH, chunks, data_nodes, edges, nodes
from lodegraph.plans.source import _source
from lodegraph.session import table

QUERIES: dict = {}
ORACLES: dict[str, str] = {}

#: Items that a document lists before it says how many more there are.
LISTED = 10


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def _say(*parts: str | Column) -> Column:
    """Text of literals and columns; a null column says nothing."""
    return F.concat(*[F.lit(p) if isinstance(p, str) else F.coalesce(p.cast("string"), F.lit("")) for p in parts])


def _doc(kind: str, rows: DataFrame, name: str | Column, said: Column) -> DataFrame:
    return derive.generated(kind, rows, "program", F.lit(name) if isinstance(name, str) else name, said)


def _sql_doc(kind: str, name: str, said: str, source: str) -> str:
    return f"SELECT program || ':{kind}:' || {name} AS chunk_id, '{kind}' AS chunk_type, program, {said} AS text {source}"


def _sql_listed(items: str) -> str:
    """SQL of `derive.listed` over a list of distinct sorted items."""
    return f"array_to_string({items}[1:{LISTED}], ', ') || CASE WHEN len({items}) > {LISTED} THEN ' and ' || (len({items}) - {LISTED}) || ' more' ELSE '' END"


ALL = "ALL"


# facts of CICS statements


def _node_statements(spark: SparkSession, sf: str) -> DataFrame:
    """Statements at CICS nodes, put together from the command and the target that the nodes name."""
    m = lambda p: F.get_json_object("metadata", p)
    n = nodes(spark, sf).select("row_id", "id", F.upper("program").alias("program"), F.col("sourceline").alias("line"), m("$.cics_command").alias("c"), m("$.cics_target_program").alias("t")).filter("c is not null and t is not null")
    is_map, word = F.contains("c", F.lit("MAP")), F.substring_index("c", " ", 1)
    said = F.when(is_map, F.concat(F.lit(" MAP ("), "t", F.lit(")"))).when(word.isin("LINK", "XCTL", "RETURN"), F.concat(F.lit(" PROGRAM('"), "t", F.lit("')"))).otherwise(F.concat(F.lit(" FILE ( '"), "t", F.lit("' )")))
    return n.select("row_id", "id", "program", "line", F.concat(F.lit("EXEC CICS "), word, said).alias("statement"))


def cics_statements(spark: SparkSession, sf: str) -> DataFrame:
    """Every EXEC CICS statement of a chunk, where those in comments are inactive, and of a node; origin tells them apart."""
    c = table(spark, sf, "chunk").filter("text is not null").select(F.lit("chunk").alias("origin"), "row_id", F.trim(F.upper("program")).alias("program"), F.inline(cics.statements(F.col("text"))))
    n = _node_statements(spark, sf).select(F.lit("node").alias("origin"), "row_id", "program", "line", F.lit(True).alias("active"), "statement")
    return c.withColumnRenamed("text", "statement").unionByName(n).withColumn("command", cics.command(F.col("statement")))


@query()
def cics_facts(spark: SparkSession, sf: str) -> DataFrame:
    """Operations: what a statement does, and on what."""
    s, t = cics_statements(spark, sf), cics.target(F.col("statement"))
    group = F.when(F.col("t.kind").isin("FILE", "DATASET"), cics.file_group(F.col("command")))
    return s.withColumn("t", t).select("origin", "row_id", "line", "active", "command", cics.operation_type(F.col("command")).alias("type"), F.col("t.kind").alias("target_kind"), F.col("t.value").alias("target"), F.col("t.source").alias("target_source"), group.alias("file_group"), F.size(cics.arguments(F.col("statement"))).alias("n_arguments"))


@query()
def cics_resources(spark: SparkSession, sf: str) -> DataFrame:
    return cics_statements(spark, sf).filter("active").select("origin", "row_id", "line", "command", F.inline(cics.resources(F.col("statement")))).distinct()


@query()
def cics_handlers(spark: SparkSession, sf: str) -> DataFrame:
    return cics_statements(spark, sf).select("origin", "row_id", "line", "active", F.inline(cics.handlers(F.col("statement")))).distinct()


@query(
    WITH
    + """, s AS (SELECT id, program, json_extract_string(metadata, '$.cics_command') AS c, json_extract_string(metadata, '$.cics_target_program') AS t FROM nodes WHERE json_extract_string(metadata, '$.cics_command') IS NOT NULL AND json_extract_string(metadata, '$.cics_target_program') IS NOT NULL),
    w AS (SELECT *, split_part(c, ' ', 1) AS w, contains(c, 'MAP') AS m FROM s)
    SELECT id, w AS command, CASE WHEN w IN ('LINK', 'XCTL', 'RETURN') THEN 'program_transfer' WHEN w = 'START' THEN 'transaction_start' WHEN w = 'READ' THEN 'file_read' WHEN w IN ('WRITE', 'REWRITE') THEN 'file_write' WHEN w = 'DELETE' THEN 'file_delete' WHEN w = 'READQ' THEN 'queue_read' WHEN w = 'WRITEQ' THEN 'queue_write' WHEN w IN ('STARTBR', 'READNEXT', 'READPREV', 'ENDBR', 'RESETBR') THEN 'browse' ELSE 'other' END AS type,
    CASE WHEN m THEN 'MAP' WHEN w IN ('LINK', 'XCTL', 'RETURN') THEN 'PROGRAM' ELSE 'FILE' END AS target_kind, t AS target, CASE WHEN m THEN 'identifier' ELSE 'literal' END AS target_source, CASE WHEN m OR w NOT IN ('LINK', 'XCTL', 'RETURN') THEN 1 ELSE 0 END AS n_resources, 2 AS n_captured FROM w"""
)
def cics_node_facts(spark: SparkSession, sf: str) -> DataFrame:
    """Operations of the statements at CICS nodes, read from source lines over which they go on."""
    n = _node_statements(spark, sf)
    source = F.concat(F.lit("000100     "), "statement", F.lit("\n000200       RESP(WS-RESP) RESP2(WS-RESP2) END-EXEC."))
    s = n.select("id", F.inline(cics.statements(source))).withColumnRenamed("text", "s").withColumns({"command": cics.command(F.col("s")), "t": cics.target(F.col("s"))})
    return s.select("id", "command", cics.operation_type(F.col("command")).alias("type"), F.col("t.kind").alias("target_kind"), F.col("t.value").alias("target"), F.col("t.source").alias("target_source"), F.size(cics.resources(F.col("s"))).alias("n_resources"), F.size(cics.handlers(F.col("s"))).alias("n_captured"))


# JCL


# The same statements in SQL: lines of 72 columns, operands on one line.
_JCL = r"""WITH l AS (SELECT row_id, generate_subscripts(x, 1) AS line_no, rtrim(substr(unnest(x), 1, 72)) AS line FROM (SELECT row_id, regexp_split_to_array(text, '\r?\n') AS x FROM chunk WHERE text IS NOT NULL AND lower(trim(chunk_type, ' ')) IN ('step_detail', 'job_flow'))),
st AS (SELECT row_id, line_no, nullif(regexp_extract(line, '^//(\S*)\s+(\S+)\s*(.*)$', 1), '') AS name, regexp_extract(line, '^//(\S*)\s+(\S+)\s*(.*)$', 2) AS op, regexp_extract(line, '^//(\S*)\s+(\S+)\s*(.*)$', 3) AS operand FROM l WHERE line LIKE '//%' AND line NOT LIKE '//*%'),
dd AS (SELECT *, nullif(regexp_extract(operand, '(?:^|,)DSN(?:AME)?=''?([^,(]+)', 1), '') AS dsn, nullif(regexp_extract(operand, '(?:^|,)DISP=\(?([A-Z]*)', 1), '') AS disp FROM st WHERE op IN ('EXEC', 'DD')),
placed AS (SELECT *, max(CASE WHEN op = 'EXEC' THEN line_no END) OVER (PARTITION BY row_id ORDER BY line_no) AS step_no, CASE disp WHEN 'SHR' THEN 'read' WHEN 'OLD' THEN 'read' WHEN 'NEW' THEN 'write' WHEN 'MOD' THEN 'append' WHEN 'PASS' THEN 'pass' ELSE CASE WHEN operand LIKE '%DISP=%' THEN 'special' END END AS access FROM dd),
ex AS (SELECT row_id, line_no AS step_no, name AS step, coalesce(nullif(regexp_extract(operand, 'PGM=([A-Z0-9@#$&*.]+)', 1), ''), regexp_extract(operand, '^(?:PROC=)?([A-Z0-9@#$]+)', 1)) AS program FROM st WHERE op = 'EXEC'),
s AS (SELECT placed.row_id, placed.step_no, ex.step, ex.program, CASE WHEN op = 'DD' THEN dsn END AS dataset, CASE WHEN op = 'DD' THEN access END AS access FROM placed JOIN ex ON ex.row_id = placed.row_id AND ex.step_no = placed.step_no)
"""
_UTILITIES = ", ".join(f"'{u}'" for u in derive.SYSTEM_UTILITIES)
_RELATIONS = _JCL + f""", n AS (SELECT upper(program) AS program, count(*) AS n_nodes, count(*) FILTER (WHERE flow_type = 'IF_BRANCH') AS n_decisions FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY ingested_at DESC, row_id DESC) AS rn FROM code_node) WHERE rn = 1 AND deleted_at IS NULL AND program IS NOT NULL GROUP BY 1),
rel AS (SELECT row_id, step_no, step, s.program, s.program IN ({_UTILITIES}) AS is_utility, s.program IN (SELECT upper(program) FROM program_catalog) AS in_corpus, count(DISTINCT dataset) FILTER (WHERE access = 'read') AS n_read, count(DISTINCT dataset) FILTER (WHERE access IN ('write', 'append')) AS n_written, coalesce(any_value(n_nodes), 0) AS n_nodes, coalesce(any_value(n_decisions), 0) AS n_decisions FROM s LEFT JOIN n ON n.program = s.program GROUP BY row_id, step_no, step, s.program)
"""


def _jcl(spark: SparkSession, sf: str) -> DataFrame:
    c = table(spark, sf, "chunk").filter("lower(trim(chunk_type)) in ('step_detail', 'job_flow')")
    return jcl.statements(c, "row_id", "text").filter("kind = 'statement'")


@query(_JCL + """SELECT row_id, line_no, name, CASE upper(name) WHEN 'JOBLIB' THEN 'library_override' WHEN 'STEPLIB' THEN 'library_override' WHEN 'SYSIN' THEN 'program_input' WHEN 'SYSPRINT' THEN 'system_print' WHEN 'SYSOUT' THEN 'system_output' WHEN 'SYSERR' THEN 'system_error' WHEN 'SYSUDUMP' THEN 'diagnostic_dump' WHEN 'SYSABEND' THEN 'diagnostic_dump' END AS role,
    CASE WHEN dsn IS NULL THEN NULL WHEN dsn = 'NULLFILE' THEN 'nullfile' WHEN dsn LIKE '&&%' THEN 'temporary' ELSE 'plain' END AS dsn_kind, dsn, disp AS status, CASE disp WHEN 'SHR' THEN 'read' WHEN 'OLD' THEN 'read' WHEN 'NEW' THEN 'write' WHEN 'MOD' THEN 'append' WHEN 'PASS' THEN 'pass' ELSE CASE WHEN operand LIKE '%DISP=%' THEN 'special' END END AS access,
    nullif(regexp_extract(operand, 'LRECL=(\\d+)', 1), '') AS lrecl, nullif(regexp_extract(operand, 'SPACE=\\(?([A-Z0-9]+)', 1), '') AS space_unit, nullif(regexp_extract(operand, 'VOL=SER=([A-Z0-9]+)', 1), '') AS volumes, regexp_extract(operand, 'OUTPUT=\\(?\\*\\.([A-Z0-9]+)', 1) AS outputs FROM dd WHERE op = 'DD'""")
def jcl_dd_fields(spark: SparkSession, sf: str) -> DataFrame:
    """Operands of every DD statement."""
    d = _jcl(spark, sf).filter("operation = 'DD'").select("row_id", "line_no", "name", jcl.dd_fields(F.col("name"), F.col("operand")).alias("f"))
    f = lambda p: F.col(f"f.{p}")
    return d.select("row_id", "line_no", "name", f("role").alias("role"), f("dsn.kind").alias("dsn_kind"), f("dsn.base").alias("dsn"), f("disp.status").alias("status"), f("disp.access").alias("access"), f("dcb.parameters")["lrecl"].alias("lrecl"), f("space.unit").alias("space_unit"), F.array_join(f("vol.ser"), ",").alias("volumes"), F.array_join(f("outputs"), ",").alias("outputs"))


@query(
    "SELECT l_orderkey, l_linenumber, 'CYL' AS unit, l_quantity::INT::VARCHAR AS \"primary\", CASE WHEN l_linenumber % 2 = 0 THEN l_linenumber::VARCHAR END AS secondary, l_linenumber % 3 = 0 AS rlse, false AS contig, "
    "'V' || l_linenumber || CASE WHEN l_linenumber > 2 THEN ',V0' ELSE '' END AS volumes, (80 + l_linenumber)::VARCHAR AS lrecl FROM lineitem"
)
def jcl_allocation(spark: SparkSession, sf: str) -> DataFrame:
    """SPACE, VOL and DCB operands, one of each per line of an order."""
    n, q = F.col("l_linenumber").cast("string"), F.col("l_quantity").cast("int").cast("string")
    sp = F.concat(F.lit("(CYL,"), F.when(F.col("l_linenumber") % 2 == 0, F.concat(F.lit("("), q, F.lit(","), n, F.lit(")"))).otherwise(q), F.when(F.col("l_linenumber") % 3 == 0, ",RLSE").otherwise(""), F.lit(")"))
    vo = F.when(F.col("l_linenumber") > 2, F.concat(F.lit("SER=(V"), n, F.lit(",V0)"))).otherwise(F.concat(F.lit("SER=V"), n))
    dc = F.concat(F.lit("(RECFM=FB,LRECL="), (80 + F.col("l_linenumber")).cast("string"), F.lit(")"))
    d = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", jcl.space(sp).alias("s"), jcl.vol(vo).alias("v"), jcl.dcb(dc).alias("d"))
    return d.select("l_orderkey", "l_linenumber", "s.unit", "s.primary", "s.secondary", "s.rlse", "s.contig", F.array_join("v.ser", ",").alias("volumes"), F.col("d.parameters")["lrecl"].alias("lrecl"))


def _steps(spark: SparkSession, sf: str) -> DataFrame:
    """Steps of every JCL text with what they run and the data sets they read and write."""
    s = _jcl(spark, sf).filter("operation in ('EXEC', 'DD')")
    at = Window.partitionBy("row_id").orderBy("line_no").rowsBetween(Window.unboundedPreceding, 0)
    step = F.last(F.when(F.col("operation") == "EXEC", F.struct(F.col("line_no").alias("no"), F.col("name").alias("step"), F.coalesce(F.nullif(F.regexp_extract("operand", r"PGM=([A-Z0-9@#$&*.]+)", 1), F.lit("")), F.regexp_extract("operand", r"^(?:PROC=)?([A-Z0-9@#$]+)", 1)).alias("program"))), ignorenulls=True).over(at)
    dd = jcl.dd_fields(F.col("name"), F.col("operand"))
    return s.withColumn("st", step).filter("st is not null").select("row_id", F.col("st.no").alias("step_no"), "st.step", "st.program", F.when(F.col("operation") == "DD", dd["dsn"]["base"]).alias("dataset"), F.when(F.col("operation") == "DD", dd["disp"]["access"]).alias("access"))


@query(_RELATIONS + "SELECT * FROM rel")
def jcl_program_steps(spark: SparkSession, sf: str) -> DataFrame:
    """Relation of every job step to the corpus: the program, whether it is a utility or known, its health and data sets."""
    p = table(spark, sf, "program_catalog").select(F.upper("program").alias("program"), F.lit(True).alias("in_corpus"))
    g = _steps(spark, sf).groupBy("row_id", "step_no", "step", "program").agg(F.count_distinct(F.when(F.col("access") == "read", F.col("dataset"))).alias("n_read"), F.count_distinct(F.when(F.col("access").isin("write", "append"), F.col("dataset"))).alias("n_written"))
    size = nodes(spark, sf).filter("program is not null").groupBy(F.upper("program").alias("program")).agg(F.count(F.lit(1)).alias("n_nodes"), F.count_if(F.col("flow_type") == "IF_BRANCH").alias("n_decisions"))
    j = g.join(p, "program", "left").join(size, "program", "left")
    return j.select("row_id", "step_no", "step", "program", F.col("program").isin(*derive.SYSTEM_UTILITIES).alias("is_utility"), F.coalesce("in_corpus", F.lit(False)).alias("in_corpus"), "n_read", "n_written", F.coalesce("n_nodes", F.lit(0)).alias("n_nodes"), F.coalesce("n_decisions", F.lit(0)).alias("n_decisions"))


@query(_JCL + """, g AS (SELECT row_id, dataset, min(step_no) FILTER (WHERE access IN ('write', 'append')) AS producer, min(step_no) FILTER (WHERE access = 'read') AS consumer FROM s WHERE dataset IS NOT NULL GROUP BY ALL)
    SELECT *, CASE WHEN producer IS NOT NULL AND consumer IS NOT NULL THEN 'inter_step' WHEN consumer IS NOT NULL THEN 'external_input' WHEN producer IS NOT NULL THEN 'final_output' ELSE 'unused' END AS flow_type FROM g""")
def jcl_dataset_flows(spark: SparkSession, sf: str) -> DataFrame:
    """Which step's data sets another step of the same text reads: inter_step, external_input, final_output."""
    d = _steps(spark, sf).filter("dataset is not null").select("row_id", "step_no", "dataset", "access")
    g = d.groupBy("row_id", "dataset").agg(F.min(F.when(F.col("access").isin("write", "append"), F.col("step_no"))).alias("producer"), F.min(F.when(F.col("access") == "read", F.col("step_no"))).alias("consumer"))
    kind = F.when(F.col("producer").isNotNull() & F.col("consumer").isNotNull(), "inter_step").when(F.col("consumer").isNotNull(), "external_input").when(F.col("producer").isNotNull(), "final_output").otherwise("unused")
    return g.select("row_id", "dataset", "producer", "consumer", kind.alias("flow_type"))


@query(_RELATIONS + """, g AS (SELECT row_id, string_agg('| ' || coalesce(step, '') || ' | ' || program || ' | ' || CASE WHEN is_utility THEN 'utility' WHEN in_corpus THEN 'analysed' ELSE 'missing' END || ' | ' || n_read || ' | ' || n_written || ' |', chr(10) ORDER BY step_no) AS t, count(*) FILTER (WHERE NOT is_utility) AS u, count(*) FILTER (WHERE NOT is_utility AND in_corpus) AS k FROM rel GROUP BY row_id),
    h AS (SELECT *, CASE WHEN u > 0 THEN round(k / u * 100)::INT ELSE 0 END AS c FROM g)
    SELECT row_id, c AS coverage_pct, '# Job steps' || chr(10) || chr(10) || 'Coverage: ' || c || ' %' || chr(10) || chr(10) || '| Step | Program | State | Read | Written |' || chr(10) || '|---|---|---|---|---|' || chr(10) || t || chr(10) AS markdown FROM h""")
def jcl_report(spark: SparkSession, sf: str) -> DataFrame:
    """A Markdown report per JCL text: steps, their programs, coverage of the corpus."""
    s = jcl_program_steps(spark, sf)
    line = _say("| ", F.col("step"), " | ", F.col("program"), " | ", F.when(F.col("is_utility"), "utility").when(F.col("in_corpus"), "analysed").otherwise("missing"), " | ", F.col("n_read"), " | ", F.col("n_written"), " |")
    g = s.groupBy("row_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("step_no", line.alias("l")))), lambda x: x["l"]).alias("lines"), F.count_if(~F.col("is_utility")).alias("n_user"), F.count_if(~F.col("is_utility") & F.col("in_corpus")).alias("n_known"))
    share = F.when(F.col("n_user") > 0, F.round(F.col("n_known") / F.col("n_user") * 100)).otherwise(0).cast("int")
    return g.select("row_id", share.alias("coverage_pct"), _say("# Job steps\n\nCoverage: ", share, " %\n\n| Step | Program | State | Read | Written |\n|---|---|---|---|---|\n", F.array_join("lines", "\n"), "\n").alias("markdown"))


@query(_JCL + """, o AS (SELECT row_id, step_no, lead(step_no) OVER (PARTITION BY row_id ORDER BY step_no) AS nxt FROM (SELECT DISTINCT row_id, step_no, program FROM s)), d AS (SELECT DISTINCT row_id, step_no, regexp_replace(dataset, '[^A-Za-z0-9_]', '_', 'g') AS x, access FROM s WHERE dataset IS NOT NULL)
    SELECT DISTINCT row_id, 'S' || step_no || ' --> S' || nxt AS line FROM o WHERE nxt IS NOT NULL UNION SELECT row_id, CASE WHEN access = 'read' THEN x || ' --> S' || step_no ELSE 'S' || step_no || ' --> ' || x END FROM d""")
def jcl_diagram(spark: SparkSession, sf: str) -> DataFrame:
    """Edges of the Mermaid diagram of every JCL text, a row per line: steps in order, data sets into and out of them."""
    s = _steps(spark, sf)
    order = s.select("row_id", "step_no", "program").distinct().withColumn("next", F.lead("step_no").over(Window.partitionBy("row_id").orderBy("step_no"))).filter("next is not null")
    chain = order.select("row_id", _say("S", F.col("step_no"), " --> S", F.col("next")).alias("line"))
    ds = s.filter("dataset is not null").select("row_id", "step_no", "dataset", "access").distinct()
    flow = ds.select("row_id", F.when(F.col("access") == "read", _say(text.diagram_id("dataset"), " --> S", F.col("step_no"))).otherwise(_say("S", F.col("step_no"), " --> ", text.diagram_id("dataset"))).alias("line"))
    return chain.unionByName(flow).distinct()


# documents per chunk type


def _calls(n: DataFrame) -> DataFrame:
    return n.filter("flow_type = 'CALL'").select("program", "id", "originaltext", "sourceline", F.get_json_object("metadata", "$.call_target").alias("target"), F.get_json_object("metadata", "$.dynamic").alias("dynamic"))


def _known(spark: SparkSession, sf: str) -> DataFrame:
    return nodes(spark, sf).filter("program is not null")


_N = WITH + ", n AS (SELECT *, json_extract_string(metadata, '$.call_target') AS target, json_extract_string(metadata, '$.sql_operation') AS sql_op, json_extract_string(metadata, '$.cics_command') AS command, json_extract_string(metadata, '$.cics_target_program') AS to_program FROM nodes WHERE program IS NOT NULL)"


@query(_N + ", g AS (SELECT program, list_sort(list_distinct(list(target) FILTER (WHERE flow_type = 'CALL' AND target IS NOT NULL))) AS c, list_sort(list_distinct(list(command) FILTER (WHERE command IS NOT NULL))) AS k, count(*) FILTER (WHERE flow_type = 'EXEC_SQL') AS q FROM n GROUP BY program) " + _sql_doc("dependencies", "'ALL'", f"'Program ' || program || ' depends on programs: ' || CASE WHEN len(coalesce(c, [])) = 0 THEN 'none' ELSE {_sql_listed('c')} END || '; CICS commands: ' || CASE WHEN len(coalesce(k, [])) = 0 THEN 'none' ELSE {_sql_listed('k')} END || '; SQL statements: ' || q || '.'", "FROM g"))
def doc_dependencies(spark: SparkSession, sf: str) -> DataFrame:
    n = _known(spark, sf)
    named = lambda df, c, alias: derive.top_listing(df, ["program"], c, LISTED).select("program", derive.listed(F.col("n"), F.col("items")).alias(alias))
    c = named(_calls(n), "target", "c")
    k = named(n.select("program", F.get_json_object("metadata", "$.cics_command").alias("command")), "command", "k")
    q = n.groupBy("program").agg(F.count_if(F.col("flow_type") == "EXEC_SQL").alias("q"))
    j = q.join(c, "program", "left").join(k, "program", "left")
    return _doc("dependencies", j, ALL, _say("Program ", F.col("program"), " depends on programs: ", F.coalesce("c", F.lit("none")), "; CICS commands: ", F.coalesce("k", F.lit("none")), "; SQL statements: ", F.col("q"), "."))


@query(_N + ", g AS (SELECT program, target, count(*) AS k, count(*) FILTER (WHERE json_extract_string(metadata, '$.dynamic') = 'true') AS d, min(sourceline) AS l FROM n WHERE flow_type = 'CALL' AND target IS NOT NULL GROUP BY ALL) " + _sql_doc("call_contract", "target", "'Program ' || program || ' calls ' || target || ' ' || k || ' times, ' || d || ' of them dynamic; first at line ' || coalesce(l::VARCHAR, 'unknown') || '.'", "FROM g"))
def doc_call_contract(spark: SparkSession, sf: str) -> DataFrame:
    g = _calls(_known(spark, sf)).filter("target is not null").groupBy("program", "target").agg(F.count(F.lit(1)).alias("k"), F.count_if(F.col("dynamic") == "true").alias("d"), F.min("sourceline").alias("l"))
    return _doc("call_contract", g, F.col("target"), _say("Program ", F.col("program"), " calls ", F.col("target"), " ", F.col("k"), " times, ", F.col("d"), " of them dynamic; first at line ", F.coalesce(F.col("l").cast("string"), F.lit("unknown")), "."))


@query(_N + r""", c AS (SELECT program, id, list_filter(regexp_split_to_array(regexp_extract(originaltext, '\bCALL\s+\S+\s+USING\s+([^.\r\n]*)', 1), '[\s,]+'), lambda x: x NOT IN ('', 'BY', 'REFERENCE', 'CONTENT', 'VALUE')) AS p FROM n WHERE flow_type = 'CALL' AND originaltext IS NOT NULL) SELECT program, id, generate_subscripts(p, 1) - 1 AS position, unnest(p) AS parameter FROM c""")
def call_parameters(spark: SparkSession, sf: str) -> DataFrame:
    """Parameters of every CALL in order, with the node that the call stands at."""
    n = _known(spark, sf).filter("flow_type = 'CALL' and originaltext is not null")
    return n.select("program", "id", F.posexplode(text.call_using("originaltext")).alias("position", "parameter"))


@query(_N + ", e AS (SELECT program, count(*) AS ne FROM edges WHERE edge_type IN ('STARTS_WITH', 'FOLLOWED_BY', 'JUMPS_TO') AND program IS NOT NULL GROUP BY program), g AS (SELECT program, count(*) AS nn, count(*) FILTER (WHERE flow_type = 'IF_BRANCH') AS d, count(*) FILTER (WHERE flow_type = 'PARAGRAPH') AS p FROM n GROUP BY program) " + _sql_doc("controlflow.cfg", "'ALL'", "'Control flow of ' || g.program || ': ' || nn || ' nodes, ' || coalesce(ne, 0) || ' edges, ' || d || ' decisions in ' || p || ' paragraphs; complexity ' || greatest(1, coalesce(ne, 0) - nn + 2) || '.'", "FROM g LEFT JOIN e USING (program)"))
def doc_controlflow(spark: SparkSession, sf: str) -> DataFrame:
    e = graph.project(edges(spark, sf), "STARTS_WITH", "FOLLOWED_BY", "JUMPS_TO").filter("program is not null").groupBy("program").agg(F.count(F.lit(1)).alias("ne"))
    g = _known(spark, sf).groupBy("program").agg(F.count(F.lit(1)).alias("nn"), F.count_if(F.col("flow_type") == "IF_BRANCH").alias("d"), F.count_if(F.col("flow_type") == "PARAGRAPH").alias("p"))
    j = g.join(e, "program", "left").withColumn("ne", F.coalesce("ne", F.lit(0)))
    return _doc("controlflow.cfg", j, ALL, _say("Control flow of ", F.col("program"), ": ", F.col("nn"), " nodes, ", F.col("ne"), " edges, ", F.col("d"), " decisions in ", F.col("p"), " paragraphs; complexity ", F.greatest(F.lit(1), F.col("ne") - F.col("nn") + 2), "."))


@query(_N + ", g AS (SELECT program, list_sort(list_distinct(list(sql_op) FILTER (WHERE sql_op IS NOT NULL))) AS q, list_sort(list_distinct(list(v) FILTER (WHERE v IS NOT NULL))) AS f FROM (SELECT program, sql_op, CASE WHEN flow_type = 'READ' THEN unnest(CASE WHEN len(coalesce(variablesread, [])) = 0 THEN [NULL] ELSE variablesread END) END AS v FROM n WHERE flow_type IN ('READ', 'EXEC_SQL')) GROUP BY program) " + _sql_doc("datasets_tables_resources", "'ALL'", f"'Resources of ' || program || ': SQL ' || CASE WHEN len(coalesce(q, [])) = 0 THEN 'none' ELSE {_sql_listed('q')} END || '; read by files ' || CASE WHEN len(coalesce(f, [])) = 0 THEN 'none' ELSE {_sql_listed('f')} END || '.'", "FROM g"))
def doc_resources(spark: SparkSession, sf: str) -> DataFrame:
    n = _known(spark, sf).filter("flow_type in ('READ', 'EXEC_SQL')")
    named = lambda df, c, alias: derive.top_listing(df, ["program"], c, LISTED).select("program", derive.listed(F.col("n"), F.col("items")).alias(alias))
    q = named(n.select("program", F.get_json_object("metadata", "$.sql_operation").alias("op")), "op", "q")
    f = named(n.filter("flow_type = 'READ'").select("program", F.explode("variablesread").alias("v")), "v", "f")
    j = n.select("program").distinct().join(q, "program", "left").join(f, "program", "left")
    return _doc("datasets_tables_resources", j, ALL, _say("Resources of ", F.col("program"), ": SQL ", F.coalesce("q", F.lit("none")), "; read by files ", F.coalesce("f", F.lit("none")), "."))


@query(_N + _sql_doc("cics.program_transfer", "id", "'Statement ' || id || ' of ' || program || ' passes control to ' || to_program || ' by ' || command || '.'", " FROM n WHERE command IN ('LINK', 'XCTL', 'RETURN', 'START') AND to_program IS NOT NULL"))
def doc_program_transfer(spark: SparkSession, sf: str) -> DataFrame:
    m = lambda p: F.get_json_object("metadata", p)
    n = _known(spark, sf).select("program", "id", m("$.cics_command").alias("command"), m("$.cics_target_program").alias("to")).filter("command in ('LINK', 'XCTL', 'RETURN', 'START') and to is not null")
    return _doc("cics.program_transfer", n, F.col("id"), _say("Statement ", F.col("id"), " of ", F.col("program"), " passes control to ", F.col("to"), " by ", F.col("command"), "."))


@query(_N + ", g AS (SELECT program, command, count(*) AS k FROM n WHERE command IS NOT NULL GROUP BY ALL) " + _sql_doc("cics_operations", "command", "'Program ' || program || ' issues ' || command || ' ' || k || ' times.'", "FROM g"))
def doc_cics_operations(spark: SparkSession, sf: str) -> DataFrame:
    g = _known(spark, sf).select("program", F.get_json_object("metadata", "$.cics_command").alias("command")).filter("command is not null").groupBy("program", "command").agg(F.count(F.lit(1)).alias("k"))
    return _doc("cics_operations", g, F.col("command"), _say("Program ", F.col("program"), " issues ", F.col("command"), " ", F.col("k"), " times."))


def _by_fact(kind: str, rows: DataFrame, name: list[str], said: Column) -> DataFrame:
    return _doc(kind, rows.filter("program is not null").distinct(), F.concat_ws(".", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in name]), said)


@query()
def doc_cics_operation(spark: SparkSession, sf: str) -> DataFrame:
    s = cics_statements(spark, sf).filter("active").withColumn("t", cics.target(F.col("statement")))
    return _by_fact("cics.operation", s.select("program", "origin", "row_id", "line", "command", "t.kind", "t.value"), ["origin", "row_id", "line", "command"], _say("Line ", F.col("line"), ": ", F.col("command"), F.when(F.col("kind").isNotNull(), _say(" on ", F.lower("kind"), " ", F.col("value"))).otherwise(""), "."))


@query()
def doc_cics_resource(spark: SparkSession, sf: str) -> DataFrame:
    s = cics_statements(spark, sf).filter("active").select("program", "command", F.inline(cics.resources(F.col("statement"))))
    g = s.groupBy("program", "kind", "target").agg(F.count(F.lit(1)).alias("n"), F.min("source").alias("source"))
    return _by_fact("cics.resource", g, ["kind", "target"], _say(F.initcap("kind"), " ", F.col("target"), " (", F.col("source"), ") is used ", F.col("n"), " times by ", F.col("program"), "."))


@query()
def doc_cics_error_handler(spark: SparkSession, sf: str) -> DataFrame:
    s = cics_statements(spark, sf).select("program", "origin", "row_id", "line", "active", F.inline(cics.handlers(F.col("statement"))))
    return _by_fact("cics.error_handler", s, ["origin", "row_id", "line", "key"], _say(F.col("kind"), " ", F.col("key"), " at line ", F.col("line"), F.when(F.col("target").isNotNull(), _say(" leads to ", F.col("target"))).otherwise(""), F.when(F.col("active"), ".").otherwise(" in a comment.")))


@query()
def doc_screen(spark: SparkSession, sf: str) -> DataFrame:
    """What a program shows and reads: its maps with the commands on them."""
    s = cics_statements(spark, sf).filter("active and command in ('SEND', 'RECEIVE')").withColumn("m", cics.argument(F.col("statement"), "MAP"))
    g = s.filter("m is not null").groupBy("program", F.col("m.value").alias("map")).agg(F.count_if(F.col("command") == "SEND").alias("sent"), F.count_if(F.col("command") == "RECEIVE").alias("received"))
    return _by_fact("screen", g, ["map"], _say("Map ", F.col("map"), " of ", F.col("program"), " is sent ", F.col("sent"), " times and received ", F.col("received"), " times."))


@query()
def doc_error_path(spark: SparkSession, sf: str) -> DataFrame:
    """Labels that an error leads to, with what leads there."""
    s = cics_statements(spark, sf).filter("active").select("program", F.inline(cics.handlers(F.col("statement")))).filter("action = 'set' and target is not null")
    t = derive.top_listing(s, ["program", "target"], "key", LISTED)
    return _by_fact("error_path", t.withColumn("keys", derive.listed(F.col("n"), F.col("items"))), ["target"], _say("Errors ", F.col("keys"), " lead to ", F.col("target"), "."))


@query(WITH + ", g AS (SELECT program, upper(m[1]) AS name, count(*) AS k FROM (SELECT program, unnest(regexp_extract_all(text, '(?i)\\bCOPY\\s+[A-Z0-9@#$-]+')) AS c FROM chunk WHERE program IS NOT NULL AND text IS NOT NULL), LATERAL (SELECT regexp_extract_all(c, '(?i)COPY\\s+([A-Z0-9@#$-]+)', 1) AS m) GROUP BY ALL) " + _sql_doc("copybook_mentions", "name", "'Copybook ' || name || ' is mentioned ' || k || ' times in ' || program || '.'", "FROM g"))
def doc_copybook_mentions(spark: SparkSession, sf: str) -> DataFrame:
    c = table(spark, sf, "chunk").filter("program is not null and text is not null").select("program", F.explode(F.regexp_extract_all("text", F.lit(r"(?i)\bCOPY\s+([A-Z0-9@#$-]+)"), F.lit(1))).alias("c"))
    g = c.groupBy("program", F.upper("c").alias("name")).agg(F.count(F.lit(1)).alias("k"))
    return _doc("copybook_mentions", g, F.col("name"), _say("Copybook ", F.col("name"), " is mentioned ", F.col("k"), " times in ", F.col("program"), "."))


_D = WITH + ", k AS (SELECT program, parent_id AS record, list_sort(list_distinct(list(fieldname))) AS f FROM data WHERE program IS NOT NULL AND parent_id IS NOT NULL AND fieldname IS NOT NULL GROUP BY ALL) "


@query(_D + _sql_doc("variable_group", "record", f"'Group ' || record || ' of ' || program || ' holds ' || {_sql_listed('f')} || '.'", "FROM k"))
def doc_variable_group(spark: SparkSession, sf: str) -> DataFrame:
    d = data_nodes(spark, sf).filter("program is not null and parent_id is not null").select("program", F.col("parent_id").alias("record"), "fieldname")
    t = derive.top_listing(d, ["program", "record"], "fieldname", LISTED)
    return _doc("variable_group", t, F.col("record"), _say("Group ", F.col("record"), " of ", F.col("program"), " holds ", derive.listed(F.col("n"), F.col("items")), "."))


@query(WITH + _sql_doc("copybook_fields", "id", "fieldname || ' level ' || levelnumber || CASE WHEN p <> '' THEN ' picture ' || p ELSE '' END || CASE WHEN isredefinition THEN ' redefines' ELSE '' END || '.'", " FROM (SELECT *, regexp_extract(upper(rawtext), '\\bPIC(?:TURE)?\\s+(?:IS\\s+)?(\\S+?)\\.?(?:\\s|$)', 1) AS p FROM data) WHERE program IS NOT NULL AND fieldname IS NOT NULL AND levelnumber IS NOT NULL"))
def doc_copybook_fields(spark: SparkSession, sf: str) -> DataFrame:
    d = data_nodes(spark, sf).filter("program is not null and fieldname is not null and levelnumber is not null").withColumn("p", text.picture("rawtext"))
    return _doc("copybook_fields", d, F.col("id"), _say(F.col("fieldname"), " level ", F.col("levelnumber"), F.when(F.col("p").isNotNull(), F.concat(F.lit(" picture "), "p")).otherwise(""), F.when(F.col("isredefinition"), " redefines").otherwise(""), "."))


@query()
def doc_comments(spark: SparkSession, sf: str) -> DataFrame:
    """Comment blocks as documents: prose as comments, deactivated source as commented_out_code."""
    source = F.concat("text", F.lit("\n       NEXT-PARAGRAPH.\n"))
    b = table(spark, sf, "chunk").filter("text is not null and program is not null").select("program", "row_id", F.inline(text.comment_blocks(source)))
    b = b.withColumn("is_code", text.is_commented_out(F.col("lines")))
    at = F.concat_ws(".", F.col("row_id").cast("string"), F.col("line_start").cast("string"))
    said = _say("Before ", F.col("target"), ":\n", F.array_join("lines", "\n"))
    return _doc("comments", b.filter("not is_code"), at, said).unionByName(_doc("commented_out_code", b.filter("is_code"), at, said))


@query()
def doc_paragraph_logic(spark: SparkSession, sf: str) -> DataFrame:
    """What every paragraph of the source does, statement by statement."""
    trees = cobol.rows_of(_source(spark, sf), "row_id", "text", _paragraphs, "paragraph string, line_start int, n_statements int, said string")
    p = table(spark, sf, "chunk").select("row_id", F.upper(F.trim("program")).alias("program")).filter("program <> ''")
    return _doc("paragraph_logic", trees.join(p, "row_id"), F.concat_ws(".", F.col("row_id").cast("string"), "paragraph", F.col("line_start").cast("string")), _say("Paragraph ", F.col("paragraph"), " has ", F.col("n_statements"), " statements:\n", F.col("said")))


#: Words that open the sentence of a statement.
_SAID = {"MOVE": "sets", "IF_BRANCH": "decides on", "PERFORM": "performs", "GOTO": "goes to", "CALL": "calls", "DISPLAY": "shows", "COMPUTE": "computes", "READ": "reads", "WRITE": "writes", "EVALUATE": "selects by", "STOP_RUN": "ends the run"}


def _paragraphs(source: str) -> list[tuple[str, int, int, str]]:
    out = []
    stack = [cobol.parse(source)]
    while stack:
        n = stack.pop()
        if n.type == "PARAGRAPH":
            lines, count = [], 0
            for _, _, depth, s in cobol.walk(n):
                if s.head and s.type not in ("PARAGRAPH", "EVALUATE_BRANCH", "SEARCH_WHEN", "AT_END", "PHRASE"):
                    count += 1
                    lines.append("  " * max(depth - 2, 0) + f"- {_SAID.get(s.type, s.type.lower())} {' '.join(t.text for t in s.head[1:])}".rstrip())
            out.append((n.name, n.line_start, count, "\n".join(lines)))
        else:
            stack += reversed([c for c in n.children if c.type in ("DIVISION", "SECTION", "PARAGRAPH")])
    return out


@query()
def doc_static_values(spark: SparkSession, sf: str) -> DataFrame:
    """Literals that the source moves into a variable, or declares for it."""
    v = cobol.rows_of(_source(spark, sf), "row_id", "text", _literals, "variable string, value string, line int")
    p = table(spark, sf, "chunk").select("row_id", F.upper(F.trim("program")).alias("program")).filter("program <> ''")
    t = derive.top_listing(v.join(p, "row_id"), ["program", "variable"], "value", LISTED)
    return _doc("static_values", t, F.col("variable"), _say("Variable ", F.col("variable"), " of ", F.col("program"), " takes ", F.col("n"), " values: ", derive.listed(F.col("n"), F.col("items")), "."))


def _literals(source: str) -> list[tuple[str, str, int]]:
    out = []
    for _, _, _, n in cobol.walk(cobol.parse(source)):
        w = [t.text for t in n.head]
        up = n.words()
        if n.type == "MOVE" and len(w) > 3 and w[1][0] in "'\"0123456789+-" and up[2] == "TO":
            out += [(x, w[1], n.line_start) for x in up[3:] if x[0].isalpha()]
        elif n.type == "DATA" and "VALUE" in up[:-1]:
            out.append((n.name, w[up.index("VALUE") + 1], n.line_start))
    return out


@query(WITH + f", g AS (SELECT program, section_name, count(*) AS n, sum(token_count) AS t, list_sort(list_distinct(list(paragraph) FILTER (WHERE paragraph IS NOT NULL))) AS p FROM chunks WHERE program IS NOT NULL AND section_name IS NOT NULL GROUP BY ALL) " + _sql_doc("section_summary", "section_name", f"'Section ' || section_name || ' of ' || program || ' has ' || n || ' chunks of ' || coalesce(t::VARCHAR, '') || ' tokens' || CASE WHEN len(coalesce(p, [])) > 0 THEN '; paragraphs ' || {_sql_listed('p')} ELSE '' END || '.'", "FROM g"))
def doc_section_summary(spark: SparkSession, sf: str) -> DataFrame:
    """Sections that the chunks name: their paragraphs and their size."""
    c = chunks(spark, sf).filter("program is not null and section_name is not null")
    t = derive.top_listing(c, ["program", "section_name"], "paragraph", LISTED)
    g = c.groupBy("program", "section_name").agg(F.count(F.lit(1)).alias("n_chunks"), F.sum("token_count").alias("tokens")).join(t, ["program", "section_name"], "left")
    return _doc("section_summary", g, F.col("section_name"), _say("Section ", F.col("section_name"), " of ", F.col("program"), " has ", F.col("n_chunks"), " chunks of ", F.col("tokens"), " tokens", F.when(F.col("n").isNotNull(), _say("; paragraphs ", derive.listed(F.col("n"), F.col("items")))).otherwise(""), "."))


@query(_N + ", g AS (SELECT program, count(*) AS k, count(*) FILTER (WHERE reachable IS FALSE) AS d, count(*) FILTER (WHERE originaltext IS NULL) AS t FROM n GROUP BY program) " + _sql_doc("cobol_analysis_health", "'ALL'", "'Analysis of ' || program || ': ' || k || ' nodes, ' || d || ' unreachable, ' || t || ' without text; ' || CASE WHEN d * 10 > k THEN 'degraded' WHEN t > 0 THEN 'partial' ELSE 'full' END || '.'", "FROM g"))
def doc_analysis_health(spark: SparkSession, sf: str) -> DataFrame:
    g = _known(spark, sf).groupBy("program").agg(F.count(F.lit(1)).alias("k"), F.count_if(F.col("reachable") == F.lit(False)).alias("d"), F.count_if(F.col("originaltext").isNull()).alias("t"))
    return _doc("cobol_analysis_health", g, ALL, _say("Analysis of ", F.col("program"), ": ", F.col("k"), " nodes, ", F.col("d"), " unreachable, ", F.col("t"), " without text; ", F.when(F.col("d") * 10 > F.col("k"), "degraded").when(F.col("t") > 0, "partial").otherwise("full"), "."))


@query(_JCL + ", g AS (SELECT row_id, count(*) AS n, string_agg(coalesce(step, '') || ' runs ' || program, '; ' ORDER BY step_no) AS t FROM ex GROUP BY row_id) SELECT concat_ws(':', coalesce(p, ''), 'job_flow', g.row_id::VARCHAR) AS chunk_id, 'job_flow' AS chunk_type, p AS program, 'Job of ' || n || ' steps: ' || t || '.' AS text FROM g JOIN (SELECT row_id, upper(trim(program, ' ')) AS p FROM chunk) USING (row_id)")
def doc_job_flow(spark: SparkSession, sf: str) -> DataFrame:
    """Steps of every JCL text in order, as one document; a text has no more steps than lines."""
    s = _steps(spark, sf).select("row_id", "step_no", "step", "program").distinct()
    g = s.groupBy("row_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("step_no", _say(F.col("step"), " runs ", F.col("program")).alias("l")))), lambda x: x["l"]).alias("l"))
    p = table(spark, sf, "chunk").select("row_id", F.upper(F.trim("program")).alias("program"))
    return _doc("job_flow", g.join(p, "row_id"), F.col("row_id").cast("string"), _say("Job of ", F.size("l"), " steps: ", F.array_join("l", "; "), "."))


# knowledge base


@query(_N + r""", e AS (SELECT program, count(*) AS ne FROM edges WHERE edge_type IN ('STARTS_WITH', 'FOLLOWED_BY', 'JUMPS_TO') AND program IS NOT NULL GROUP BY program), k AS (SELECT program, coalesce(flow_type, 'UNKNOWN') AS t, flow_type, count(*) AS k FROM n GROUP BY ALL),
    top AS (SELECT program, string_agg('| ' || CASE WHEN t = 'DIALECT' THEN 'CICS/SQL block' ELSE t END || ' | ' || k || ' |', chr(10) ORDER BY r) AS rows FROM (SELECT *, row_number() OVER (PARTITION BY program ORDER BY k DESC, flow_type) AS r FROM k) WHERE r <= 10 GROUP BY program),
    m AS (SELECT program, count(*) AS nn FROM n GROUP BY program), v AS (SELECT program, count(*) AS nv FROM data WHERE program IS NOT NULL GROUP BY program),
    x AS (SELECT m.program, nn, coalesce(ne, 0) AS ne, coalesce(nv, 0) AS nv, rows, greatest(1, coalesce(ne, 0) - nn + 2) AS c FROM m JOIN top USING (program) LEFT JOIN e USING (program) LEFT JOIN v USING (program))
    SELECT program, '00_Executive_Summary.md' AS file, '' AS section, '# Executive Summary: ' || program || chr(10) || chr(10) || '| Metric | Value |' || chr(10) || '|---|---|' || chr(10) || '| Total CFG Nodes | ' || nn || ' |' || chr(10) || '| Total Edges | ' || ne || ' |' || chr(10) || '| Variables Defined | ' || nv || ' |' || chr(10) || '| Complexity Score | ' || CASE WHEN c <= 5 THEN 'Low' WHEN c <= 15 THEN 'Medium' ELSE 'High' END || ' (' || c || ') |' || chr(10) || chr(10) || '| Type | Count |' || chr(10) || '|---|---|' || chr(10) || rows || chr(10) AS text FROM x
    UNION ALL SELECT program, '02_Data_Dictionary.md', id, '| ' || lpad(coalesce(levelnumber, 0)::VARCHAR, 2, '0') || ' | ' || fieldname || ' | ' || coalesce(nullif(regexp_extract(upper(rawtext), '\bPIC(?:TURE)?\s+(?:IS\s+)?(\S+?)\.?(?:\s|$)', 1), ''), '') || ' | ' || coalesce(datatype, '') || ' | ' || coalesce(sourcesection, '') || ' |' FROM data WHERE program IS NOT NULL AND fieldname IS NOT NULL
    UNION ALL SELECT program, '03_Dependencies.yaml', target, '- target: ' || target || chr(10) || '  kind: ' || min(CASE WHEN json_extract_string(metadata, '$.dynamic') = 'true' THEN 'dynamic' ELSE 'static' END) || chr(10) || '  sites: ' || count(*) FROM n WHERE flow_type = 'CALL' AND target IS NOT NULL GROUP BY program, target""")
def knowledge_base_files(spark: SparkSession, sf: str) -> DataFrame:
    """(program, file, section, text): sections of a program's files, a row each, as Markdown or YAML.

    00 the executive summary with measures and node types, 02 the data dictionary, a row per field, 03 the
    dependencies in YAML, a row per call. The logic narrative (01) is `doc_paragraph_logic`."""
    n = _known(spark, sf)
    kinds = n.groupBy("program", "flow_type").agg(F.count(F.lit(1)).alias("k"))
    shown = F.when(F.col("flow_type") == "DIALECT", "CICS/SQL block").otherwise(F.coalesce("flow_type", F.lit("UNKNOWN")))
    top = kinds.withColumn("r", F.row_number().over(Window.partitionBy("program").orderBy(F.desc("k"), "flow_type"))).filter("r <= 10")
    table_ = top.groupBy("program").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("r", _say("| ", shown, " | ", F.col("k"), " |").alias("l")))), lambda x: x["l"]), "\n").alias("rows"))
    e = graph.project(edges(spark, sf), "STARTS_WITH", "FOLLOWED_BY", "JUMPS_TO").filter("program is not null").groupBy("program").agg(F.count(F.lit(1)).alias("ne"))
    v = data_nodes(spark, sf).filter("program is not null")
    m = n.groupBy("program").agg(F.count(F.lit(1)).alias("nn")).join(e, "program", "left").join(v.groupBy("program").agg(F.count(F.lit(1)).alias("nv")), "program", "left").join(table_, "program")
    ne = F.coalesce("ne", F.lit(0))
    complexity = F.greatest(F.lit(1), ne - F.col("nn") + 2)
    level = F.when(complexity <= 5, "Low").when(complexity <= 15, "Medium").otherwise("High")
    summary = m.select("program", F.lit("00_Executive_Summary.md").alias("file"), F.lit("").alias("section"), _say("# Executive Summary: ", F.col("program"), "\n\n| Metric | Value |\n|---|---|\n| Total CFG Nodes | ", F.col("nn"), " |\n| Total Edges | ", ne, " |\n| Variables Defined | ", F.coalesce("nv", F.lit(0)), " |\n| Complexity Score | ", level, " (", complexity, ") |\n\n| Type | Count |\n|---|---|\n", F.col("rows"), "\n").alias("text"))
    words = v.filter("fieldname is not null").select("program", F.lit("02_Data_Dictionary.md").alias("file"), F.col("id").alias("section"), _say("| ", F.lpad(F.coalesce("levelnumber", F.lit(0)).cast("string"), 2, "0"), " | ", F.col("fieldname"), " | ", text.picture("rawtext"), " | ", F.col("datatype"), " | ", F.col("sourcesection"), " |").alias("text"))
    calls = _calls(n).filter("target is not null").groupBy("program", "target").agg(F.min(F.when(F.col("dynamic") == "true", "dynamic").otherwise("static")).alias("kind"), F.count(F.lit(1)).alias("k"))
    deps = calls.select("program", F.lit("03_Dependencies.yaml").alias("file"), F.col("target").alias("section"), _say("- target: ", F.col("target"), "\n  kind: ", F.col("kind"), "\n  sites: ", F.col("k")).alias("text"))
    return reduce(DataFrame.unionByName, [summary, words, deps])


@query(WITH + ", m AS (SELECT DISTINCT upper(regexp_extract(c, '(?i)COPY\\s+([A-Z0-9@#$-]+)', 1)) AS copybook FROM (SELECT unnest(regexp_extract_all(text, '(?i)\\bCOPY\\s+[A-Z0-9@#$-]+')) AS c FROM chunk WHERE text IS NOT NULL)) SELECT copybook, 'stub' AS state FROM m WHERE copybook NOT IN (SELECT upper(program) FROM program_catalog)")
def copybook_stubs(spark: SparkSession, sf: str) -> DataFrame:
    """Copybooks that the source needs and the corpus lacks: those a run would have to stub."""
    c = table(spark, sf, "chunk").filter("text is not null").select(F.explode(F.regexp_extract_all(F.upper("text"), F.lit(r"\bCOPY\s+([A-Z0-9@#$-]+)"), F.lit(1))).alias("copybook")).distinct()
    return c.join(table(spark, sf, "program_catalog").select(F.upper("program").alias("copybook")), "copybook", "left_anti").select("copybook", F.lit("stub").alias("state"))


@query(WITH + ", g AS (SELECT program, count(*) AS n, count(*) FILTER (WHERE parse_quality = 'full') AS f, count(*) FILTER (WHERE parse_quality = 'degraded') AS d, count(*) FILTER (WHERE text IS NULL) AS t FROM chunks WHERE program IS NOT NULL GROUP BY program) SELECT program, n AS n_chunks, CASE WHEN t = n THEN 'failed' WHEN d > 0 OR t > 0 THEN 'partial' ELSE 'success' END AS status, f > 0 AND t < n AS counts_as_success FROM g")
def partial_success(spark: SparkSession, sf: str) -> DataFrame:
    """Status of every program's chunks; a partial one counts as success if any chunk is whole."""
    g = chunks(spark, sf).filter("program is not null").groupBy("program").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("parse_quality") == "full").alias("f"), F.count_if(F.col("parse_quality") == "degraded").alias("d"), F.count_if(F.col("text").isNull()).alias("t"))
    return g.select("program", F.col("n").alias("n_chunks"), F.when(F.col("t") == F.col("n"), "failed").when((F.col("d") > 0) | (F.col("t") > 0), "partial").otherwise("success").alias("status"), ((F.col("f") > 0) & (F.col("t") < F.col("n"))).alias("counts_as_success"))


@query("SELECT schema_version AS step, pipeline_version AS version, count(*) AS n_runs, min(ingested_at) AS began, max(ingested_at) AS ended, count(*) FILTER (WHERE text IS NULL) AS n_failed FROM chunk WHERE schema_version IS NOT NULL AND pipeline_version IS NOT NULL GROUP BY ALL")
def pipeline_report(spark: SparkSession, sf: str) -> DataFrame:
    """Runs of every step and version: how many, from when to when, how many gave nothing."""
    c = table(spark, sf, "chunk").filter("schema_version is not null and pipeline_version is not null")
    return c.groupBy(F.col("schema_version").alias("step"), F.col("pipeline_version").alias("version")).agg(F.count(F.lit(1)).alias("n_runs"), F.min("ingested_at").alias("began"), F.max("ingested_at").alias("ended"), F.count_if(F.col("text").isNull()).alias("n_failed"))
