"""Queries of the scalar libraries: text, JCL operands, records and statement effects."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodegraph.functions import jcl, records, text
from lodegraph.functions import statements as st
from lodegraph.plans.base import WITH, data_nodes, nodes
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


@query(r"SELECT row_id, upper(regexp_replace(trim(program || CASE row_id % 3 WHEN 0 THEN '.cbl' WHEN 1 THEN '.COB' ELSE '' END, ' '), '\.(cbl|cob)$', '', 'i')) AS name FROM chunk WHERE program IS NOT NULL")
def program_name_normalise(spark: SparkSession, sf: str) -> DataFrame:
    ext = F.when(F.col("row_id") % 3 == 0, ".cbl").when(F.col("row_id") % 3 == 1, ".COB").otherwise("")
    return table(spark, sf, "chunk").filter("program is not null").select("row_id", text.program_name(F.concat("program", ext)).alias("name"))


@query(r"SELECT row_id, coalesce(length(v) >= 2 AND v NOT IN ('SPACE', 'SPACES', 'ZERO', 'ZEROS', 'ZEROES', 'QUOTE', 'QUOTES', 'NULL', 'LOW-VALUE', 'LOW-VALUES', 'HIGH-VALUE', 'HIGH-VALUES') AND NOT regexp_full_match(v, '\d+') AND regexp_full_match(v, '[A-Z][A-Z0-9_-]*'), false) AS is_target FROM (SELECT row_id, upper(trim(tolabel, ' ')) AS v FROM code_edge)")
def valid_target_filter(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "code_edge").select("row_id", text.is_program_target("tolabel").alias("is_target"))


@query(r"SELECT row_id, regexp_replace(trim(fromlabel || CASE WHEN row_id % 2 = 0 THEN ' THRU X-EXIT' ELSE '' END, ' '), '\s+THR(U|OUGH)\s+.*$', '', 'i') AS target FROM code_edge WHERE fromlabel IS NOT NULL")
def call_target_normalise(spark: SparkSession, sf: str) -> DataFrame:
    c = F.concat("fromlabel", F.when(F.col("row_id") % 2 == 0, " THRU X-EXIT").otherwise(""))
    return table(spark, sf, "code_edge").filter("fromlabel is not null").select("row_id", text.call_target(c).alias("target"))


@query("WITH v AS (SELECT unnest(['SPACE', 'zeros', 'QUOTE', 'LOW-VALUE', 'HIGH-VALUES', 'WS-A']) AS name) SELECT name, CASE upper(name) WHEN 'SPACE' THEN ' ' WHEN 'ZEROS' THEN '0' WHEN 'QUOTE' THEN '\"' WHEN 'LOW-VALUE' THEN '0' WHEN 'HIGH-VALUES' THEN '100' ELSE name END AS value FROM v")
def figurative_map(spark: SparkSession, sf: str) -> DataFrame:
    v = spark.createDataFrame([(x,) for x in ("SPACE", "zeros", "QUOTE", "LOW-VALUE", "HIGH-VALUES", "WS-A")], "name string")
    return v.select("name", text.figurative("name").alias("value"))


@query(f"SELECT row_id, count(*) AS n_lines, count(*) FILTER (WHERE regexp_matches(l, '{text.NOISE_PATTERN}')) AS n_noise, count(*) FILTER (WHERE regexp_matches(l, '{text.CODE_PATTERN}')) AS n_code FROM (SELECT row_id, unnest(list_transform(regexp_split_to_array(text, '\\r?\\n'), lambda x: substr(x, 8))) AS l FROM chunk WHERE text IS NOT NULL) GROUP BY row_id")
def noise_line_filter(spark: SparkSession, sf: str) -> DataFrame:
    """Lines of every text, those that are noise, and those that look like statements."""
    ls = F.transform(text.lines("text"), lambda x: F.substring(x, 8, 2**30))
    return table(spark, sf, "chunk").filter("text is not null").select("row_id", F.size(ls).alias("n_lines"), F.size(F.filter(ls, text.is_noise_line)).alias("n_noise"), F.size(F.filter(ls, text.is_code_like)).alias("n_code"))


@query(
    f"""WITH b AS (SELECT row_id, list_filter(list_transform(list_filter(regexp_split_to_array(text, '\\r?\\n'), lambda l: regexp_matches(l, '^......[*]')), lambda l: substr(l, 8)), lambda l: regexp_matches(l, '\\S')) AS ls FROM chunk WHERE text IS NOT NULL),
    c AS (SELECT row_id, len(ls) AS m, len(list_filter(ls, lambda l: regexp_matches(l, '{text.CODE_PATTERN}'))) AS n, len(list_filter(ls, lambda l: regexp_matches(l, '{text.EXEC_PATTERN}'))) > 0 AS x, len(list_filter(ls, lambda l: regexp_matches(l, '{text.LABEL_PATTERN}'))) > 0 AS p FROM b)
    SELECT row_id, n >= 3 OR (x AND (n >= 2 OR p)) OR (n >= 2 AND n * 2 >= m) AS is_code FROM c WHERE m > 0"""
)
def code_like_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Whether the comment lines of a text, taken as one block, are deactivated source."""
    ls = F.transform(F.filter(text.lines("text"), lambda x: x.rlike("^.{6}[*]")), lambda x: F.substring(x, 8, 2**30))
    b = table(spark, sf, "chunk").filter("text is not null").select("row_id", F.filter(ls, lambda x: x.rlike(r"\S")).alias("ls")).filter("size(ls) > 0")
    return b.select("row_id", text.is_commented_out(F.col("ls")).alias("is_code"))


@query()
def comment_blocks(spark: SparkSession, sf: str) -> DataFrame:
    """Comments before each paragraph, prose apart from deactivated code. A chunk ends where the next
    paragraph begins, so its last comments belong to that one."""
    source = F.concat("text", F.lit("\n       NEXT-PARAGRAPH.\n"))
    b = table(spark, sf, "chunk").filter("text is not null").select("row_id", F.inline(text.comment_blocks(source)))
    return b.select("row_id", "target", "line_start", "line_end", F.size("lines").alias("line_count"), text.is_commented_out(F.col("lines")).alias("is_code"), F.array_join("lines", "\n").alias("text"))


@query(
    """WITH l AS (SELECT l_orderkey, l_linenumber, 'I' || l_linenumber AS v, l_quantity::INT::VARCHAR AS q FROM lineitem)
    SELECT l_orderkey, l_linenumber, 0 AS nesting, v AS var, '1' AS "from", '2' AS "by", v || ' > ' || q AS until FROM l
    UNION ALL SELECT l_orderkey, l_linenumber, 1, 'J', v, '1', 'J = ' || q FROM l WHERE l_linenumber > 1 UNION ALL SELECT l_orderkey, l_linenumber, 2, 'K', '0', '5', 'K > J' FROM l WHERE l_linenumber > 2"""
)
def perform_loops(spark: SparkSession, sf: str) -> DataFrame:
    """Loop variables of PERFORM VARYING, outermost first, those of AFTER within; a statement per line of an order."""
    v, q = F.concat(F.lit("I"), F.col("l_linenumber").cast("string")), F.col("l_quantity").cast("int").cast("string")
    more = F.when(F.col("l_linenumber") > 2, F.concat(F.lit("\n AFTER J FROM "), v, F.lit(" BY 1 UNTIL J = "), q, F.lit("\n AFTER K FROM 0 BY 5 UNTIL K > J"))).when(F.col("l_linenumber") > 1, F.concat(F.lit(" AFTER J FROM "), v, F.lit(" BY 1 UNTIL J = "), q)).otherwise("")
    said = F.concat(F.lit("PERFORM 100-LOAD THRU 100-EXIT VARYING "), v, F.lit(" FROM 1 BY 2 UNTIL "), v, F.lit(" > "), q, more, F.lit("."))
    return table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", F.posexplode(text.perform_varying(said)).alias("nesting", "l")).select("l_orderkey", "l_linenumber", "nesting", "l.*")


@query(r"SELECT doc_id, len(list_filter(list_transform(regexp_split_to_array(text, '[.!?]+\s+|\r?\n'), lambda s: trim(s, ' ')), lambda s: s <> '')) AS n_sentences FROM documents WHERE text IS NOT NULL")
def sentence_split(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").filter("text is not null").select("doc_id", F.size(text.sentences("text")).alias("n_sentences"))


@query(r"SELECT row_id, array_to_string(list_sort(list_distinct(regexp_extract_all(upper(text), '\b(?:FROM|JOIN|UPDATE|INTO)\s+([A-Z][A-Z0-9_.]*)', 1))), ',') AS tables FROM chunk WHERE lower(trim(chunk_type, ' ')) = 'sql_operation' AND text IS NOT NULL")
def sql_table_extract(spark: SparkSession, sf: str) -> DataFrame:
    c = table(spark, sf, "chunk").filter("lower(trim(chunk_type)) = 'sql_operation' and text is not null")
    return c.select("row_id", F.array_join(text.sql_tables("text"), ",").alias("tables"))


@query(r"SELECT row_id, nullif(upper(regexp_extract(text, 'EXEC\s+SQL\s+(\w+)', 1, 'i')), '') AS op, regexp_matches(upper(text), '\b(PREPARE|EXECUTE\s+IMMEDIATE)\b') AS is_dynamic FROM chunk WHERE text IS NOT NULL")
def sql_operation_kind(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "chunk").filter("text is not null").select("row_id", text.sql_operation("text").alias("op"), text.is_dynamic_sql("text").alias("is_dynamic"))


@query("""SELECT row_id, array_to_string(list_sort(list_distinct(regexp_extract_all(text, '\\bCALL\\s+[''"]([A-Z0-9_-]+)[''"]', 1))), ',') AS targets, nullif(regexp_extract(text, '\\bGO\\s+TO\\s+([A-Z0-9-]+)', 1), '') AS go_to FROM chunk WHERE text IS NOT NULL""")
def call_literal_extract(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "chunk").filter("text is not null").select("row_id", F.array_join(text.call_literals("text"), ",").alias("targets"), text.go_to_target("text").alias("go_to"))


@query(WITH + r"SELECT id, nullif(regexp_extract(upper(rawtext), '\bPIC(?:TURE)?\s+(?:IS\s+)?(\S+?)\.?(?:\s|$)', 1), '') AS pic FROM data WHERE rawtext IS NOT NULL")
def picture_extract(spark: SparkSession, sf: str) -> DataFrame:
    return data_nodes(spark, sf).filter("rawtext is not null").select("id", text.picture("rawtext").alias("pic"))


@query(r"SELECT doc_id, regexp_replace(source, '[^A-Za-z0-9_-]', '_', 'g') AS safe, CASE WHEN regexp_matches(regexp_replace(source || doc_id, '[^A-Za-z0-9_]', '_', 'g'), '^[0-9]') THEN 'n_' ELSE '' END || regexp_replace(source || doc_id, '[^A-Za-z0-9_]', '_', 'g') AS diagram FROM documents WHERE source IS NOT NULL")
def safe_names(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").filter("source is not null").select("doc_id", text.safe_name("source").alias("safe"), text.diagram_id(F.concat("source", F.col("doc_id").cast("string"))).alias("diagram"))


@query(f"SELECT row_id, CASE WHEN regexp_matches(text, '{text.IDMS_PATTERN}') THEN 'IDMS' ELSE 'COBOL' END AS dialect FROM chunk WHERE text IS NOT NULL")
def dialect_detection(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "chunk").filter("text is not null").select("row_id", text.dialect(F.col("text")).alias("dialect"))


@query("SELECT c_custkey, regexp_full_match(c_mktsegment, '[A-Za-z ]*') AS is_alpha, regexp_full_match(c_mktsegment, '[A-Z ]*') AS is_upper, regexp_full_match(c_mktsegment, '[a-z ]*') AS is_lower, try_cast(trim(c_name, ' ') AS DOUBLE) IS NOT NULL AS is_number, c_acctbal >= 0 AS is_positive, c_acctbal < 0 AS is_negative, c_acctbal = 0 AS is_zero FROM customer")
def class_conditions(spark: SparkSession, sf: str) -> DataFrame:
    b, m = F.col("c_acctbal"), F.col("c_mktsegment")
    return table(spark, sf, "customer").select("c_custkey", text.is_alphabetic(m).alias("is_alpha"), text.is_upper(m).alias("is_upper"), text.is_lower(m).alias("is_lower"), text.is_numeric(F.col("c_name")).alias("is_number"), (b >= 0).alias("is_positive"), (b < 0).alias("is_negative"), (b == 0).alias("is_zero"))


@query("SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN 'generation' WHEN 1 THEN 'member' WHEN 2 THEN 'temporary' ELSE 'plain' END AS kind, CASE p_partkey % 4 WHEN 2 THEN '&&' || upper(replace(p_brand, '#', '')) ELSE upper(replace(p_brand, '#', '')) || '.DATA' END AS base, CASE p_partkey % 4 WHEN 0 THEN '-' || p_size WHEN 1 THEN 'M' || p_size END AS member FROM part")
def dsn_parse(spark: SparkSession, sf: str) -> DataFrame:
    p = table(spark, sf, "part")
    brand, k, n = F.upper(F.regexp_replace("p_brand", "#", "")), F.col("p_partkey") % 4, F.col("p_size").cast("string")
    plain = F.concat(brand, F.lit(".DATA"))
    d = F.when(k == 0, F.concat(plain, F.lit("(-"), n, F.lit(")"))).when(k == 1, F.concat(plain, F.lit("(M"), n, F.lit(")"))).when(k == 2, F.concat(F.lit("&&"), brand)).otherwise(plain)
    return p.select("p_partkey", jcl.dsn(d).alias("d")).select("p_partkey", "d.kind", "d.base", "d.member")


@query("SELECT o_orderkey, CASE o_orderstatus WHEN 'O' THEN 'SHR' WHEN 'F' THEN 'NEW' ELSE 'MOD' END AS status, 'CATLG' AS normal, CASE WHEN o_orderkey % 2 = 0 THEN 'DELETE' END AS abnormal, CASE o_orderstatus WHEN 'O' THEN 'read' WHEN 'F' THEN 'write' ELSE 'append' END AS access FROM orders")
def disp_access(spark: SparkSession, sf: str) -> DataFrame:
    s = F.when(F.col("o_orderstatus") == "O", "SHR").when(F.col("o_orderstatus") == "F", "NEW").otherwise("MOD")
    d = F.concat(F.lit("("), s, F.lit(",CATLG"), F.when(F.col("o_orderkey") % 2 == 0, ",DELETE").otherwise(""), F.lit(")"))
    return table(spark, sf, "orders").select("o_orderkey", jcl.disp(d).alias("d")).select("o_orderkey", "d.*")


@query("WITH o AS (SELECT unnest(['LT', 'LE', 'GT', 'GE', 'EQ', 'NE']) AS op, unnest(['>=', '>', '<=', '<', '!=', '=']) AS said) SELECT p_partkey, 'runs only if RC' || CASE WHEN p_partkey % 2 = 0 THEN ' of STEP1' ELSE '' END || ' ' || said || ' ' || p_size AS cond FROM part, o WHERE op = ['LT', 'LE', 'GT', 'GE', 'EQ', 'NE'][p_partkey % 6 + 1]")
def cond_interpret(spark: SparkSession, sf: str) -> DataFrame:
    op = F.element_at(F.array(*[F.lit(x) for x in ("LT", "LE", "GT", "GE", "EQ", "NE")]), (F.col("p_partkey") % 6 + 1).cast("int"))
    c = F.concat(F.lit("("), F.col("p_size").cast("string"), F.lit(","), op, F.when(F.col("p_partkey") % 2 == 0, ",STEP1").otherwise(""), F.lit(")"))
    return table(spark, sf, "part").select("p_partkey", jcl.cond_text(c).alias("cond"))


@query("SELECT p_partkey, 'PRD.' || p_partkey || '.LIB.&REST' AS value, 'REST' AS unresolved FROM part")
def symbol_substitution(spark: SparkSession, sf: str) -> DataFrame:
    c = jcl.substitute(F.concat(F.lit("&ENV.."), F.col("p_partkey").cast("string"), F.lit(".&TYP..&REST")), {"ENV": "PRD", "TYP": "LIB"})
    return table(spark, sf, "part").select("p_partkey", c.alias("value"), F.array_join(jcl.unresolved(c), ",").alias("unresolved"))


@query("SELECT p_partkey, 'A' || p_size AS dsn, '(NEW,CATLG)' AS disp, 'x,(y)' AS parm, 3 AS n_parts FROM part")
def operand_split(spark: SparkSession, sf: str) -> DataFrame:
    o = F.concat(F.lit("DSN=A"), F.col("p_size").cast("string"), F.lit(",DISP=(NEW,CATLG),PARM='x,(y)'"))
    m = jcl.operands(o)
    return table(spark, sf, "part").select("p_partkey", m["DSN"].alias("dsn"), m["DISP"].alias("disp"), F.regexp_replace(m["PARM"], "'", "").alias("parm"), F.size(jcl.split_operand(o)).alias("n_parts"))


@query(r"WITH l AS (SELECT row_id, unnest(range(1, len(x) + 1)) AS n, unnest(x) AS line FROM (SELECT row_id, regexp_split_to_array(text, '\r?\n') AS x FROM chunk WHERE lower(trim(chunk_type, ' ')) = 'step_detail' AND text IS NOT NULL)) SELECT row_id, regexp_extract(line, '^//(\S*)\s+EXEC\s+PGM=([A-Z0-9]+)', 1) AS step_name, regexp_extract(line, '^//(\S*)\s+EXEC\s+PGM=([A-Z0-9]+)', 2) AS program, n AS line_no FROM l WHERE regexp_matches(line, '^//\S*\s+EXEC\s+PGM=[A-Z0-9]+')")
def jcl_steps(spark: SparkSession, sf: str) -> DataFrame:
    j = jcl.statements(table(spark, sf, "chunk").filter("lower(trim(chunk_type)) = 'step_detail'"), "row_id", "text")
    return j.filter("operation = 'EXEC' and operand like 'PGM=%'").select("row_id", F.coalesce("name", F.lit("")).alias("step_name"), F.regexp_extract("operand", "^PGM=([A-Z0-9]+)", 1).alias("program"), "line_no").filter("program <> ''")


@query(r"WITH l AS (SELECT row_id, unnest(regexp_split_to_array(text, '\r?\n')) AS line FROM chunk WHERE lower(trim(chunk_type, ' ')) = 'step_detail' AND text IS NOT NULL) SELECT regexp_extract(line, 'DSN=([A-Z0-9.]+),DISP=([A-Z]+)', 1) AS dsn, count(DISTINCT row_id) AS n_jobs, bool_or(regexp_matches(line, 'DISP=(SHR|OLD)')) AS is_read FROM l WHERE regexp_matches(line, '^//\S+\s+DD\s+DSN=[A-Z0-9.]+,DISP=') GROUP BY 1")
def dataset_index(spark: SparkSession, sf: str) -> DataFrame:
    j = jcl.statements(table(spark, sf, "chunk").filter("lower(trim(chunk_type)) = 'step_detail'"), "row_id", "text").filter("operation = 'DD' and operand like 'DSN=%,DISP=%'")
    m = j.select("row_id", F.regexp_extract("operand", "DSN=([A-Z0-9.]+)", 1).alias("dsn"), jcl.disp(F.regexp_extract("operand", r"DISP=(\([^)]*\)|\w+)", 1))["access"].alias("access"))
    return m.groupBy("dsn").agg(F.count_distinct("row_id").alias("n_jobs"), F.bool_or(F.col("access") == "read").alias("is_read"))


_ACCT = records.parse_picture("S9(7)V99")
_PACK = records.parse_picture("S9(7)V99", "COMP-3")


@query("SELECT c_custkey, c_acctbal AS zoned, c_acctbal AS packed, 18 AS n_zoned, 10 AS n_packed FROM customer")
def zoned_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    t = records.plain(F.round("c_acctbal", 2), 2)
    z, p = records.encode_zoned(t, _ACCT), records.encode_packed(t, _PACK)
    return table(spark, sf, "customer").select("c_custkey", records.decode_zoned(z, _ACCT).alias("zoned"), records.decode_packed(p, _PACK).alias("packed"), F.length(z).alias("n_zoned"), F.length(p).alias("n_packed"))


@query("SELECT l_orderkey, l_linenumber, lpad(CAST(CAST(round(l_quantity * 100) AS BIGINT) AS VARCHAR), 7, '0') || 'C' AS packed FROM lineitem")
def comp3_encode(spark: SparkSession, sf: str) -> DataFrame:
    p = records.parse_picture("S9(5)V99", "COMP-3")
    return table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", records.encode_packed(records.plain(F.round("l_quantity", 2), 2), p).alias("packed"))


@query("SELECT l_orderkey, l_linenumber, right('00' || CAST(floor(l_extendedprice) AS BIGINT), 2) || substr(CAST(CAST(l_extendedprice AS DECIMAL(38, 2)) AS VARCHAR), -2) AS digits FROM lineitem")
def decimal_align(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", records.align_decimal(records.plain(F.col("l_extendedprice"), 2), 2, 2).alias("digits"))


@query("SELECT c_custkey, c_name AS name FROM customer")
def ebcdic_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "customer").select("c_custkey", records.from_ebcdic(records.to_ebcdic(F.col("c_name"))).alias("name"))


@query("SELECT c_custkey, rpad(left(c_name, 12), 12, ' ') AS adjusted FROM customer")
def adjust_text(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "customer").select("c_custkey", records.adjust_text(F.col("c_name"), 12).alias("adjusted"))


@query("SELECT c_custkey, lpad(CAST(c_custkey AS VARCHAR), 9, '0') AS whole, substr(lpad(CAST(c_custkey AS VARCHAR), 9, '0'), 1, 4) AS region, substr(lpad(CAST(c_custkey AS VARCHAR), 9, '0'), 7, 3) AS tail FROM customer")
def redefines_views(spark: SparkSession, sf: str) -> DataFrame:
    rec = records.to_ebcdic(F.lpad(F.col("c_custkey").cast("string"), 9, "0"))
    v = lambda o, n: records.from_ebcdic(records.view(rec, o, n))
    return table(spark, sf, "customer").select("c_custkey", v(0, 9).alias("whole"), v(0, 4).alias("region"), v(6, 3).alias("tail"))


@query("SELECT c_custkey, substr(lpad(CAST(c_custkey AS VARCHAR), 9, '0'), CAST(c_nationkey % 3 AS INT) * 3 + 1, 3) AS item, CAST(NULL AS VARCHAR) AS outside FROM customer")
def occurs_index(spark: SparkSession, sf: str) -> DataFrame:
    items = records.occurs(records.to_ebcdic(F.lpad(F.col("c_custkey").cast("string"), 9, "0")), 0, 3, 3)
    at = lambda i: records.from_ebcdic(records.occurrence(items, i))
    return table(spark, sf, "customer").select("c_custkey", at(F.col("c_nationkey") % 3 + 1).alias("item"), at(F.lit(7)).alias("outside"))


@query("SELECT o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN 1.0 WHEN '2-HIGH' THEN 1.0 WHEN '5-LOW' THEN 3.0 ELSE 2.0 END AS lane FROM orders")
def evaluate_when(spark: SparkSession, sf: str) -> DataFrame:
    put = lambda v: [st.compute("lane", lambda s: F.lit(v))]
    fields = {"priority": F.col("o_orderpriority"), "lane": F.lit(0.0)}
    return st.apply(table(spark, sf, "orders"), fields, [st.evaluate("priority", [(["1-URGENT", "2-HIGH"], put(1.0)), (["5-LOW"], put(3.0))], put(2.0))], ["o_orderkey"]).select("o_orderkey", "lane")


@query("SELECT l_orderkey, l_linenumber, l_quantity + l_tax + l_discount AS b, l_quantity + l_tax + l_discount AS c, CASE WHEN l_discount > 0.05 THEN l_extendedprice - l_tax ELSE l_extendedprice * 2 END AS d, l_extendedprice / nullif(l_discount, 0) AS e FROM lineitem")
def arithmetic_giving(spark: SparkSession, sf: str) -> DataFrame:
    fields = {"a": F.col("l_quantity"), "b": F.col("l_tax"), "c": F.col("l_discount"), "d": F.col("l_extendedprice"), "e": F.col("l_extendedprice"), "t": F.col("l_tax"), "k": F.col("l_discount"), "two": F.lit(2.0)}
    body = [st.add(["a"], ["b", "c"]), st.when(lambda s: s["k"] > 0.05, [st.subtract(["t"], ["d"])], [st.multiply("two", ["d"])]), st.divide("k", ["e"])]
    return st.apply(table(spark, sf, "lineitem"), fields, body, ["l_orderkey", "l_linenumber"]).select("l_orderkey", "l_linenumber", "b", "c", "d", "e")


@query("SELECT l_orderkey, l_linenumber, CASE WHEN l_quantity > 10 THEN 1 ELSE 0 END + CASE WHEN l_quantity > 30 THEN 10 ELSE 0 END AS hits, l_quantity > 40 OR l_quantity = 20 OR l_quantity < 3 AS is_special FROM lineitem")
def search_all_true(spark: SparkSession, sf: str) -> DataFrame:
    inc = lambda n: [st.compute("hits", lambda s: s["hits"] + n)]
    fields = {"q": F.col("l_quantity"), "hits": F.lit(0)}
    out = st.search([(lambda s: s["q"] > 10, inc(1)), (lambda s: s["q"] > 30, inc(10))])(fields)
    special = st.abbreviated(F.col("l_quantity"), (">", F.lit(40)), [("OR", "=", F.lit(20)), ("OR", "<", F.lit(3))])
    return table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", out["hits"].alias("hits"), special.alias("is_special"))


@query(WITH + "SELECT id, coalesce(flow_type, '') || ' in ' || coalesce(program, 'unknown') || CASE WHEN len(variablesmodified) > 3 THEN ' changes ' || array_to_string(list_sort(variablesmodified)[1:3], ', ') || ' … and ' || (len(variablesmodified) - 3) || ' more' WHEN len(variablesmodified) > 0 THEN ' changes ' || array_to_string(list_sort(variablesmodified), ', ') ELSE '' END AS narrative FROM nodes")
def statement_narratives(spark: SparkSession, sf: str) -> DataFrame:
    v = F.array_sort("variablesmodified")
    more = F.when(F.size(v) > 3, F.concat(F.lit(" changes "), F.array_join(F.slice(v, 1, 3), ", "), F.lit(" … and "), (F.size(v) - 3).cast("string"), F.lit(" more"))).when(F.size(v) > 0, F.concat(F.lit(" changes "), F.array_join(v, ", "))).otherwise("")
    return nodes(spark, sf).select("id", F.concat(F.coalesce("flow_type", F.lit("")), F.lit(" in "), F.coalesce("program", F.lit("unknown")), more).alias("narrative"))
