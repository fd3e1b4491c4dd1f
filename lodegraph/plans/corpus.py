"""Corpus queries: aggregates, windows, joins, differences and validation over the chunk tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lodegraph.functions import text
from lodegraph.operators import corpus, derive, graph
from lodegraph.plans.base import WITH, WITH_RECURSIVE, chunks, data_nodes, edges, nodes
from lodegraph.session import table

QUERIES: dict = {}
ORACLES: dict[str, str] = {}

WORDS = r"len(list_filter(regexp_split_to_array(text, '\s+'), lambda x: x <> ''))"


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


@query(f"SELECT row_id, coalesce({WORDS}, 0) AS n_tokens, substr(sha256(text), 1, 16) AS hash FROM chunk")
def content_hash(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "chunk").select("row_id", corpus.token_count("text").alias("n_tokens"), corpus.content_hash("text").alias("hash"))


@query("SELECT count(*) AS n_keys, sum(n - 1) AS n_surplus FROM (SELECT text, count(*) AS n FROM chunk WHERE text IS NOT NULL GROUP BY text HAVING count(*) > 1)")
def duplicate_hashes(spark: SparkSession, sf: str) -> DataFrame:
    return corpus.duplicates(table(spark, sf, "chunk"), F.sha2("text", 256))


@query(WITH + "SELECT program, count(*) AS n_keys, sum(n - 1) AS n_surplus FROM (SELECT program, text, count(*) AS n FROM chunks WHERE text IS NOT NULL GROUP BY program, text HAVING count(*) > 1) GROUP BY program")
def duplicate_hashes_by_program(spark: SparkSession, sf: str) -> DataFrame:
    return corpus.duplicates(chunks(spark, sf), F.sha2("text", 256), "program")


@query(WITH + "SELECT chunk_type, count(*) AS n_chunks, sum(token_count) AS n_tokens FROM chunks GROUP BY chunk_type")
def manifest_type_counts(spark: SparkSession, sf: str) -> DataFrame:
    return chunks(spark, sf).groupBy("chunk_type").agg(F.count(F.lit(1)).alias("n_chunks"), F.sum("token_count").alias("n_tokens"))


_LACK = " OR ".join(f"{f} IS NULL OR trim({f}, ' ') = ''" for f in corpus.REQUIRED_FIELDS)


@query(WITH + f"SELECT program, count(*) AS n_chunks, min(token_count) AS min_tokens, round(quantile_cont(token_count, 0.5), 2) AS median_tokens, round(quantile_cont(token_count, 0.9), 2) AS p90_tokens, max(token_count) AS max_tokens, count(*) FILTER (WHERE token_count > 0 AND token_count < 20) AS n_thin, count(*) FILTER (WHERE token_count > 512) AS n_oversized, count(*) FILTER (WHERE {_LACK}) AS n_lacking FROM chunks GROUP BY program")
def chunk_quality(spark: SparkSession, sf: str) -> DataFrame:
    return corpus.quality(chunks(spark, sf), "token_count", "program")


_ALWAYS, _NEGATIVE = (", ".join(f"'{t}'" for t in ts) for ts in (corpus.ALWAYS_INDEXABLE, corpus.NEGATIVE_EVIDENCE))


@query(f"SELECT row_id, t < 20 AND ct NOT IN ({_ALWAYS}) AS is_thin, CASE WHEN ct IN ({_ALWAYS}) THEN true WHEN t < 20 THEN ct IN ({_NEGATIVE}) ELSE coalesce(indexable, true) END AS is_indexable FROM (SELECT row_id, indexable, coalesce({WORDS}, 0) AS t, coalesce(lower(trim(chunk_type, ' ')), '') AS ct FROM chunk)")
def indexability_flags(spark: SparkSession, sf: str) -> DataFrame:
    i = corpus.indexability(F.lower(F.trim("chunk_type")), corpus.token_count("text"), F.col("indexable"))
    return table(spark, sf, "chunk").select("row_id", i.alias("i")).select("row_id", F.col("i.thin").alias("is_thin"), F.col("i.indexable").alias("is_indexable"))


@query("SELECT lower(trim(chunk_type, ' ')) AS chunk_type, count(*) FILTER (WHERE token_count > 0 AND token_count < 20) AS n_thin, count(*) FILTER (WHERE token_count > 512) AS n_oversized FROM chunk GROUP BY 1")
def thin_oversized_counts(spark: SparkSession, sf: str) -> DataFrame:
    thin = (F.col("token_count") > 0) & (F.col("token_count") < corpus.THIN_TOKENS)
    return table(spark, sf, "chunk").groupBy(F.lower(F.trim("chunk_type")).alias("chunk_type")).agg(F.count_if(thin).alias("n_thin"), F.count_if(F.col("token_count") > corpus.MAX_TOKENS).alias("n_oversized"))


@query(
    WITH_RECURSIVE
    + f""", c AS (SELECT program, chunk_id, CASE WHEN length(chunk_id) % 5 = 0 THEN regexp_replace(paragraph, '-[^-]*$', '') || '-EXIT' ELSE regexp_replace(paragraph, '-[^-]*$', '') END AS name, coalesce({WORDS}, 0) % 40 AS n FROM chunks WHERE chunk_type = 'paragraph_logic' AND paragraph IS NOT NULL AND program IS NOT NULL),
    h AS (SELECT program, name, min(chunk_id) AS home FROM c WHERE name NOT LIKE '%-EXIT' GROUP BY ALL),
    k AS (SELECT c.*, CASE WHEN c.name LIKE '%-EXIT' THEN coalesce(h.home, c.chunk_id) ELSE c.chunk_id END AS key FROM c LEFT JOIN h ON h.program = c.program AND h.name = regexp_replace(c.name, '-EXIT$', '')),
    u AS (SELECT program, key, min(CASE WHEN key = chunk_id THEN name END) AS name, sum(n) AS n, count(*) AS k FROM k GROUP BY ALL),
    o AS (SELECT *, row_number() OVER (PARTITION BY program ORDER BY name, key) AS i FROM u),
    w AS (SELECT program, i, key, n, k, 1 AS g, n AS total, n < 20 AS small FROM o WHERE i = 1 UNION ALL
      SELECT o.program, o.i, o.key, o.n, o.k, CASE WHEN w.small AND w.total < 20 AND o.n < 20 THEN w.g ELSE w.g + 1 END, CASE WHEN w.small AND w.total < 20 AND o.n < 20 THEN w.total + o.n ELSE o.n END, o.n < 20 FROM w JOIN o ON o.program = w.program AND o.i = w.i + 1),
    g AS (SELECT program, g, arg_min(key, i) AS key, sum(n) AS n, sum(k) AS k FROM w GROUP BY ALL),
    m AS (SELECT *, max(CASE WHEN g = 1 OR n >= 20 THEN g END) OVER (PARTITION BY program ORDER BY g) AS kept FROM g),
    f AS (SELECT program, kept, arg_min(key, g) AS first_key, sum(k)::BIGINT AS n_chunks, sum(n)::BIGINT AS n_tokens FROM m GROUP BY ALL)
    SELECT program, row_number() OVER (PARTITION BY program ORDER BY kept) AS group_no, first_key, n_chunks, n_tokens, CASE WHEN n_tokens > 60 THEN ceil((n_tokens - 10) / 50)::INT ELSE 1 END AS n_parts FROM f"""
)
def size_guard(spark: SparkSession, sf: str) -> DataFrame:
    """Paragraph chunks merged and split to size; sizes and names are folded so that every rule is met often."""
    c = chunks(spark, sf).filter("chunk_type = 'paragraph_logic' and paragraph is not null and program is not null")
    name = F.regexp_replace("paragraph", "-[^-]*$", "")
    c = c.select("program", "chunk_id", F.when(F.length("chunk_id") % 5 == 0, F.concat(name, F.lit("-EXIT"))).otherwise(name).alias("name"), (corpus.token_count("text") % 40).alias("n"))
    return corpus.size_guard(c, "program", "chunk_id", "name", "n", 20, 60, 10)


@query(
    f"""WITH c AS (SELECT *, lower(trim(chunk_type, ' ')) AS t, coalesce({WORDS}, 0) AS n FROM chunk)
    SELECT row_id, problem FROM (SELECT row_id, unnest(list_filter([{', '.join(f"CASE WHEN {f} IS NULL OR trim({f}, ' ') = '' THEN 'lacks {f}' END" for f in corpus.REQUIRED_FIELDS)},
    CASE WHEN substr(sha256(text), 1, 16) <> content_hash THEN 'stale hash' END, CASE WHEN n > 512 THEN 'too long' END,
    CASE WHEN trim(chunk_type, ' ') <> '' AND t NOT IN (SELECT chunk_type FROM chunk_type_ref) THEN 'unknown type' END,
    CASE WHEN trim(schema_version, ' ') <> '' AND schema_version NOT IN ('1.3', '1.4', '1.5') THEN 'unsupported version' END], lambda x: x IS NOT NULL)) AS problem FROM c)"""
)
def chunk_validation(spark: SparkSession, sf: str) -> DataFrame:
    return corpus.validate(table(spark, sf, "chunk"), table(spark, sf, "chunk_type_ref"), corpus.token_count("text"))


@query("SELECT coalesce(i.chunk_id, c.chunk_id) AS chunk_id, CASE WHEN c.chunk_id IS NULL THEN 'no_document' ELSE 'no_entry' END AS problem FROM (SELECT DISTINCT chunk_id FROM bm25_entry WHERE chunk_id IS NOT NULL) i FULL JOIN (SELECT DISTINCT chunk_id FROM chunk WHERE chunk_id IS NOT NULL) c ON c.chunk_id = i.chunk_id WHERE i.chunk_id IS NULL OR c.chunk_id IS NULL")
def index_consistency_full_outer(spark: SparkSession, sf: str) -> DataFrame:
    has = lambda t: table(spark, sf, t).filter("chunk_id is not null")
    return corpus.consistency(has("bm25_entry"), has("chunk"), "chunk_id")


@query("SELECT row_id, parent_program_chunk FROM chunk WHERE parent_program_chunk IS NOT NULL AND parent_program_chunk NOT IN (SELECT chunk_id FROM chunk WHERE chunk_id IS NOT NULL UNION SELECT split_from FROM chunk WHERE split_from IS NOT NULL)")
def cross_reference_validation(spark: SparkSession, sf: str) -> DataFrame:
    c = table(spark, sf, "chunk")
    ids = c.select(F.explode(F.array("chunk_id", "split_from")).alias("parent_program_chunk")).filter("parent_program_chunk is not null").distinct()
    return c.filter("parent_program_chunk is not null").join(ids, "parent_program_chunk", "left_anti").select("row_id", "parent_program_chunk")


@query("""WITH a AS (SELECT o_custkey AS key, count(*) AS n, sum(o_totalprice) AS total FROM orders WHERE o_orderdate < TIMESTAMP '1996-01-01' GROUP BY 1), b AS (SELECT o_custkey AS key, count(*) AS n, sum(o_totalprice) AS total FROM orders WHERE o_orderdate >= TIMESTAMP '1996-01-01' GROUP BY 1)
SELECT coalesce(a.key, b.key) AS key, CASE WHEN a.key IS NULL THEN 'added' WHEN b.key IS NULL THEN 'removed' WHEN abs(a.n - b.n) > 0.01 OR abs(a.total - b.total) > 0.01 THEN 'changed' ELSE 'same' END AS status,
CASE WHEN a.key IS NULL OR b.key IS NULL THEN '' ELSE concat_ws(',', CASE WHEN abs(a.n - b.n) > 0.01 THEN 'n' END, CASE WHEN abs(a.total - b.total) > 0.01 THEN 'total' END) END AS changed FROM a FULL JOIN b ON a.key = b.key""")
def baseline_diff(spark: SparkSession, sf: str) -> DataFrame:
    o = table(spark, sf, "orders")
    agg = lambda df: df.groupBy(F.col("o_custkey").alias("key")).agg(F.count(F.lit(1)).alias("n"), F.sum("o_totalprice").alias("total"))
    early = F.col("o_orderdate") < F.lit("1996-01-01").cast("timestamp")
    return corpus.baseline_diff(agg(o.filter(early)), agg(o.filter(~early)), "key", ["n", "total"])


@query(WITH + """, m AS (SELECT program, chunk_type, count(*) FILTER (WHERE indexable) AS numerator, count(*) FILTER (WHERE thin_chunk IS FALSE) AS denominator FROM chunks GROUP BY ALL)
SELECT chunk_type, sum(numerator) FILTER (WHERE denominator > 0) AS numerator, sum(denominator) FILTER (WHERE denominator > 0) AS denominator, sum(numerator) FILTER (WHERE denominator > 0) / sum(denominator) FILTER (WHERE denominator > 0) AS ratio,
round(avg(numerator / denominator * 100) FILTER (WHERE denominator > 0), 6) AS mean_pct, round(quantile_cont(numerator / denominator * 100, 0.1) FILTER (WHERE denominator > 0), 6) AS p10_pct, round(quantile_cont(numerator / denominator * 100, 0.5) FILTER (WHERE denominator > 0), 6) AS p50_pct,
round(quantile_cont(numerator / denominator * 100, 0.9) FILTER (WHERE denominator > 0), 6) AS p90_pct, count(*) FILTER (WHERE denominator <= 0) AS n_na FROM m GROUP BY chunk_type""")
def metric_rollup_percentiles(spark: SparkSession, sf: str) -> DataFrame:
    m = chunks(spark, sf).groupBy("program", "chunk_type").agg(F.count_if("indexable").alias("numerator"), F.count_if(~F.col("thin_chunk")).alias("denominator"))
    return corpus.rollup_metrics(m, "chunk_type")


@query(WITH + "SELECT n.program, count(DISTINCT n.v) AS denominator, count(DISTINCT CASE WHEN d.fieldname IS NOT NULL THEN n.v END) AS numerator FROM (SELECT program, unnest(variablesread) AS v FROM nodes) n LEFT JOIN (SELECT DISTINCT program, fieldname FROM data) d ON d.program = n.program AND d.fieldname = n.v WHERE n.v IS NOT NULL AND n.program IS NOT NULL GROUP BY n.program")
def stage_coverage(spark: SparkSession, sf: str) -> DataFrame:
    used = nodes(spark, sf).filter("program is not null").select("program", F.explode("variablesread").alias("v")).filter("v is not null")
    declared = data_nodes(spark, sf).select("program", F.col("fieldname").alias("v"))
    return corpus.coverage(used, declared, "v", "program")


_PARTS = WITH + """, p AS (SELECT program, avg(CASE WHEN reachable IS NOT NULL THEN reachable::INT END) AS reach, avg(CASE WHEN len(variablesread) > 0 THEN 1.0 WHEN variablesread IS NULL THEN NULL ELSE 0.0 END) AS reads, avg(CASE WHEN flow_type = 'CALL' THEN (json_extract_string(metadata, '$.call_target') IS NOT NULL)::INT END) AS calls FROM nodes GROUP BY program)"""


def _parts(spark: SparkSession, sf: str) -> DataFrame:
    reads = F.when(F.size("variablesread") > 0, 1.0).when(F.col("variablesread").isNull(), None).otherwise(0.0)
    calls = F.when(F.col("flow_type") == "CALL", F.get_json_object("metadata", "$.call_target").isNotNull().cast("int"))
    return nodes(spark, sf).groupBy("program").agg(F.avg(F.col("reachable").cast("int")).alias("reach"), F.avg(reads).alias("reads"), F.avg(calls).alias("calls"))


@query(_PARTS + "SELECT program, (coalesce(reach * 0.5, 0) + coalesce(reads * 0.4, 0) + coalesce(calls * 0.1, 0)) / nullif(CASE WHEN reach IS NOT NULL THEN 0.5 ELSE 0 END + CASE WHEN reads IS NOT NULL THEN 0.4 ELSE 0 END + CASE WHEN calls IS NOT NULL THEN 0.1 ELSE 0 END, 0) AS score FROM p")
def weighted_composite_skip_null(spark: SparkSession, sf: str) -> DataFrame:
    return _parts(spark, sf).select("program", corpus.weighted_mean({"reach": 0.5, "reads": 0.4, "calls": 0.1}).alias("score"))


@query(
    WITH
    + r""", q AS (SELECT upper(trim(program, ' ')) AS program, CASE WHEN bool_or(parse_quality = 'degraded') THEN 'degraded' WHEN bool_or(parse_quality = 'partial') THEN 'partial' WHEN bool_or(parse_quality = 'full') THEN 'full' END AS quality, coalesce(bool_or(regexp_matches(upper(text), '\b(PREPARE|EXECUTE\s+IMMEDIATE)\b')), false) AS dynamic_sql,
      count(DISTINCT paragraph) AS paragraphs, count(DISTINCT CASE WHEN regexp_matches(text, '(?m)^.{6}[*]') THEN paragraph END) AS commented FROM chunk WHERE trim(program, ' ') <> '' GROUP BY 1),
    m AS (SELECT program, count(*) AS copybooks, count(*) FILTER (WHERE c IN (SELECT upper(program) FROM program_catalog)) AS resolved FROM (SELECT DISTINCT upper(trim(program, ' ')) AS program, unnest(regexp_extract_all(upper(text), '\bCOPY\s+([A-Z0-9@#$-]+)', 1)) AS c FROM chunk WHERE trim(program, ' ') <> '' AND text IS NOT NULL) GROUP BY program),
    d AS (SELECT upper(program) AS program, count(*) AS fields, count(*) FILTER (WHERE datatype IS NOT NULL AND datatype <> 'OBJECT') AS typed FROM data WHERE program IS NOT NULL AND fieldname IS NOT NULL AND fieldname NOT IN ('FILLER', '[ROOT]') AND levelnumber > 0 GROUP BY 1),
    u AS (SELECT upper(program) AS program, count(*) AS unknown FROM nodes WHERE program IS NOT NULL AND flow_type = 'CALL' AND json_extract_string(metadata, '$.dynamic') = 'true' GROUP BY 1),
    p AS (SELECT q.program, CASE quality WHEN 'full' THEN 1.0 WHEN 'partial' THEN 0.6 WHEN 'degraded' THEN 0.2 ELSE 0.8 END::DOUBLE AS parse, CASE WHEN coalesce(copybooks, 0) > 0 THEN resolved / copybooks ELSE 1.0 END::DOUBLE AS copybooks, CASE WHEN fields IS NULL THEN 0.8 WHEN fields > 0 THEN typed / fields ELSE 1.0 END::DOUBLE AS data,
      greatest(0.0, 1.0 - CASE WHEN dynamic_sql THEN 0.2 ELSE 0.0 END - 0.15 * least(coalesce(unknown, 0), 2))::DOUBLE AS dependencies, CASE WHEN paragraphs > 0 THEN commented / paragraphs ELSE 0.5 END::DOUBLE AS narrative FROM q LEFT JOIN m USING (program) LEFT JOIN d USING (program) LEFT JOIN u USING (program)),
    s AS (SELECT *, round(0.3 * parse + 0.25 * copybooks + 0.2 * data + 0.15 * dependencies + 0.1 * narrative, 3) AS score FROM p)
    SELECT program, score, CASE WHEN score >= 0.85 THEN 'high' WHEN score >= 0.65 THEN 'medium' ELSE 'low' END AS label, round(parse, 3) AS parse, round(copybooks, 3) AS copybooks, round(data, 3) AS data, round(dependencies, 3) AS dependencies, round(narrative, 3) AS narrative FROM s"""
)
def confidence_score(spark: SparkSession, sf: str) -> DataFrame:
    """Confidence in every program's analysis, from its chunks, copybooks, data fields and calls."""
    name = F.upper(F.trim("program"))
    c = table(spark, sf, "chunk").withColumn("program", name).filter("program <> ''")
    is_ = lambda q: F.bool_or(F.col("parse_quality") == q)
    quality = F.when(is_("degraded"), "degraded").when(is_("partial"), "partial").when(is_("full"), "full")
    q = c.groupBy("program").agg(quality.alias("quality"), F.coalesce(F.bool_or(text.is_dynamic_sql("text")), F.lit(False)).alias("dynamic_sql"), F.count_distinct("paragraph").alias("paragraphs"), F.count_distinct(F.when(F.col("text").rlike("(?m)^.{6}[*]"), F.col("paragraph"))).alias("commented"))
    named = c.filter("text is not null").select("program", F.explode(F.regexp_extract_all(F.upper("text"), F.lit(r"\bCOPY\s+([A-Z0-9@#$-]+)"), F.lit(1))).alias("c")).distinct()
    known = table(spark, sf, "program_catalog").select(F.upper("program").alias("c"), F.lit(1).alias("here")).distinct()
    m = named.join(known, "c", "left").groupBy("program").agg(F.count(F.lit(1)).alias("copybooks"), F.count("here").alias("resolved"))
    d = data_nodes(spark, sf).filter("program is not null and fieldname not in ('FILLER', '[ROOT]') and levelnumber > 0").groupBy(F.upper("program").alias("program")).agg(F.count(F.lit(1)).alias("fields"), F.count_if(F.col("datatype") != "OBJECT").alias("typed"))
    u = nodes(spark, sf).filter("program is not null and flow_type = 'CALL'").filter(F.get_json_object("metadata", "$.dynamic") == "true").groupBy(F.upper("program").alias("program")).agg(F.count(F.lit(1)).alias("unknown"))
    j = q.join(m, "program", "left").join(d, "program", "left").join(u, "program", "left").na.fill(0, ["copybooks", "resolved", "unknown"])
    k = corpus.confidence(*[F.col(x) for x in ("quality", "resolved", "copybooks", "typed", "fields", "dynamic_sql", "unknown", "commented", "paragraphs")])
    return j.select("program", k.alias("k")).select("program", "k.*")


@query(WITH + ", s AS (SELECT program, count(*) FILTER (WHERE flow_type = 'SENTENCE') * 100.0 / count(*) AS generic, count(*) FILTER (WHERE flow_type = 'DIALECT') AS hazards, count(*) FILTER (WHERE reachable IS FALSE) AS skipped FROM nodes GROUP BY program) SELECT program, score, CASE WHEN score >= 85 THEN 'high' WHEN score >= 65 THEN 'medium' WHEN score >= 35 THEN 'low' ELSE 'none' END AS label FROM (SELECT program, greatest(0.0, floor(100.5 - (least(35.0, generic) + 5 * hazards + 2 * skipped + CASE WHEN hazards > 8 THEN 30 ELSE 0 END)))::INT AS score FROM s)")
def self_eval_score(spark: SparkSession, sf: str) -> DataFrame:
    s = nodes(spark, sf).groupBy("program").agg((F.count_if(F.col("flow_type") == "SENTENCE") * 100.0 / F.count(F.lit(1))).alias("generic"), F.count_if(F.col("flow_type") == "DIALECT").alias("hazards"), F.count_if(~F.col("reachable")).alias("skipped"))
    return s.select("program", corpus.self_evaluation(F.col("generic"), F.col("hazards"), F.col("skipped"), F.col("hazards") > 8, F.lit(0), F.lit(0)).alias("e")).select("program", "e.*")


@query(WITH + ", n AS (SELECT program, count(*) AS nn FROM nodes GROUP BY 1), e AS (SELECT program, count(*) AS ne FROM edges WHERE edge_type = 'FOLLOWED_BY' GROUP BY 1), c AS (SELECT n.program, greatest(coalesce(ne, 0) - nn + 2, 1) AS complexity FROM n LEFT JOIN e ON e.program = n.program) SELECT program, complexity, CASE WHEN complexity <= 5 THEN 'Low' WHEN complexity <= 15 THEN 'Medium' ELSE 'High' END AS bucket FROM c")
def cyclomatic_bucket(spark: SparkSession, sf: str) -> DataFrame:
    n = nodes(spark, sf).groupBy("program").agg(F.count(F.lit(1)).alias("nn"))
    e = edges(spark, sf).filter("edge_type = 'FOLLOWED_BY'").groupBy("program").agg(F.count(F.lit(1)).alias("ne"))
    c, b = corpus.complexity(F.coalesce("ne", F.lit(0)), F.col("nn"))
    return n.join(e, n.program.eqNullSafe(e.program), "left").select(n.program, c.alias("complexity"), b.alias("bucket"))


@query(
    WITH_RECURSIVE
    + """, h AS (SELECT DISTINCT id FROM nodes WHERE flow_type = 'PARAGRAPH'), sw AS (SELECT DISTINCT src, dst FROM edges WHERE edge_type = 'STARTS_WITH'), go AS (SELECT src, dst FROM sw UNION SELECT src, dst FROM edges WHERE edge_type = 'FOLLOWED_BY' AND dst NOT IN (SELECT id FROM h)),
    r AS (SELECT src AS root, dst AS id FROM sw WHERE src IN (SELECT id FROM h) AND src <> dst UNION SELECT r.root, go.dst FROM r JOIN go ON go.src = r.id WHERE go.dst <> r.root),
    b AS (SELECT root, id FROM r UNION SELECT id, id FROM h), t AS (SELECT b.root, b.id, n.flow_type AS t FROM b LEFT JOIN nodes n ON n.id = b.id),
    g AS (SELECT root, count(*) AS total, count(*) FILTER (WHERE t = 'EXEC_SQL') AS q, count(*) FILTER (WHERE t = 'EXEC_CICS') AS c, count(*) FILTER (WHERE t IN ('IF_BRANCH', 'EVALUATE')) AS d, count(*) FILTER (WHERE t = 'PERFORM') AS p, count(*) FILTER (WHERE t = 'MOVE') AS m, count(*) FILTER (WHERE t NOT IN ('MOVE', 'PARAGRAPH', 'PARAGRAPH_NAME')) AS o, count(*) FILTER (WHERE t IN ('READ', 'WRITE')) AS f, count(*) FILTER (WHERE t IN ('GOBACK', 'STOP_RUN')) AS e FROM t GROUP BY root)
    SELECT root AS paragraph, total AS total_statements, concat_ws('; ', CASE WHEN q > 0 THEN 'DB2 access (' || q || ' SQL)' END, CASE WHEN c > 0 THEN 'CICS operations (' || c || ' commands)' END, CASE WHEN d > 3 THEN 'decision logic (' || d || ' branches)' END, CASE WHEN p > 0 THEN 'orchestrates ' || p || ' sub-procedures' END,
    CASE WHEN m > 5 AND o < 5 THEN 'data initialization (' || m || ' MOVEs)' END, CASE WHEN f > 0 THEN 'file I/O' END, CASE WHEN e > 0 THEN 'terminates execution' END) AS patterns FROM g"""
)
def paragraph_profile_patterns(spark: SparkSession, sf: str) -> DataFrame:
    """What every paragraph does, by the types of the nodes of its body."""
    n = nodes(spark, sf).select("id", "flow_type")
    t = F.col("flow_type")
    kinds = ("EXEC_SQL", "EXEC_CICS", "IF_BRANCH", "EVALUATE", "PERFORM", "MOVE", "READ", "WRITE", "GOBACK", "STOP_RUN")
    number = lambda of: F.coalesce(F.sum(F.when(of, F.col("n"))), F.lit(0))
    g = graph.paragraph_types(n, edges(spark, sf)).groupBy("paragraph").agg(number(F.lit(True)).alias("total_statements"), *[number(t == k).alias(k) for k in kinds], number(~t.isin("MOVE", "PARAGRAPH", "PARAGRAPH_NAME")).alias("others"))
    return g.select("paragraph", "total_statements", F.array_join(corpus.paragraph_patterns({k: F.col(k) for k in kinds}, F.col("others")), "; ").alias("patterns"))


@query("SELECT field, avg(present) * 100 AS present_pct FROM (SELECT unnest(['paragraph', 'section_name', 'split_from', 'parse_quality', 'text']) AS field, unnest([(paragraph IS NOT NULL)::INT, (section_name IS NOT NULL)::INT, (split_from IS NOT NULL)::INT, (parse_quality IS NOT NULL)::INT, (text IS NOT NULL)::INT]) AS present FROM chunk) GROUP BY field")
def artifact_inventory(spark: SparkSession, sf: str) -> DataFrame:
    fields = ["paragraph", "section_name", "split_from", "parse_quality", "text"]
    c = table(spark, sf, "chunk").agg(*[(F.avg(F.col(f).isNotNull().cast("int")) * 100).alias(f) for f in fields])
    return c.unpivot([], fields, "field", "present_pct")


@query(WITH + ", s AS (SELECT program, count(*) AS n, avg(coalesce(indexable, false)::INT) * 100 AS pct, count(*) FILTER (WHERE indexable IS NOT TRUE) AS lost FROM chunks WHERE program IS NOT NULL GROUP BY program) SELECT program, lost, pct, lost * (100 - pct) AS impact FROM s ORDER BY impact DESC, program LIMIT 30")
def top_defects(spark: SparkSession, sf: str) -> DataFrame:
    ok = F.coalesce("indexable", F.lit(False))
    s = chunks(spark, sf).filter("program is not null").groupBy("program").agg((F.avg(ok.cast("int")) * 100).alias("pct"), F.count_if(~ok).alias("lost"))
    return s.select("program", "lost", "pct", (F.col("lost") * (100 - F.col("pct"))).alias("impact")).orderBy(F.desc("impact"), "program").limit(30)


@query("SELECT row_id, program, chunk_type, paragraph FROM (SELECT *, row_number() OVER (PARTITION BY program, chunk_type, paragraph ORDER BY ingested_at, row_id) AS n FROM chunk) WHERE n = 1")
def first_occurrence_dedupe(spark: SparkSession, sf: str) -> DataFrame:
    return corpus.first_occurrence(table(spark, sf, "chunk"), ["program", "chunk_type", "paragraph"], [F.col("ingested_at"), F.col("row_id")]).select("row_id", "program", "chunk_type", "paragraph")


_LINES = WITH + """, l AS (SELECT program, id, sourceline, flow_type, originaltext, row_id, variablesmodified FROM nodes WHERE sourceline IS NOT NULL AND program IS NOT NULL)"""


def _lines(spark: SparkSession, sf: str) -> DataFrame:
    return nodes(spark, sf).filter("sourceline is not null and program is not null").select("program", "id", "sourceline", "flow_type", "originaltext", "row_id", "variablesmodified")


@query(_LINES + "SELECT id, last_value(CASE WHEN flow_type = 'PARAGRAPH' THEN originaltext END IGNORE NULLS) OVER (PARTITION BY program ORDER BY sourceline, row_id ROWS UNBOUNDED PRECEDING) AS section FROM l")
def running_section_carry(spark: SparkSession, sf: str) -> DataFrame:
    return corpus.carry_forward(_lines(spark, sf), ["program"], [F.col("sourceline"), F.col("row_id")], F.when(F.col("flow_type") == "PARAGRAPH", F.col("originaltext")), "section").select("id", "section")


@query(_LINES + "SELECT id, first_value(CASE WHEN flow_type = 'CALL' THEN id END IGNORE NULLS) OVER (PARTITION BY program ORDER BY sourceline, row_id ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS next_call FROM l")
def as_of_next_node(spark: SparkSession, sf: str) -> DataFrame:
    return corpus.carry_backward(_lines(spark, sf), ["program"], [F.col("sourceline"), F.col("row_id")], F.when(F.col("flow_type") == "CALL", F.col("id")), "next_call").select("id", "next_call")


@query(_LINES + ", a AS (SELECT program, sourceline, row_id, id, unnest(variablesmodified) AS var FROM l WHERE flow_type IN ('MOVE', 'COMPUTE')) SELECT var, id, lag(id) OVER (PARTITION BY program, var ORDER BY sourceline, row_id) AS assigned_before FROM a WHERE var IS NOT NULL")
def as_of_last_literal(spark: SparkSession, sf: str) -> DataFrame:
    a = _lines(spark, sf).filter("flow_type in ('MOVE', 'COMPUTE')").select("program", "sourceline", "row_id", "id", F.explode("variablesmodified").alias("var")).filter("var is not null")
    return a.select("var", "id", F.lag("id").over(Window.partitionBy("program", "var").orderBy("sourceline", "row_id")).alias("assigned_before"))


@query(_LINES + ", r AS (SELECT *, row_number() OVER (PARTITION BY program ORDER BY sourceline, row_id) - row_number() OVER (PARTITION BY program, flow_type ORDER BY sourceline, row_id) AS g FROM l) SELECT program, min(sourceline) AS first_line, max(sourceline) AS last_line, count(*) AS n_moves FROM r WHERE flow_type = 'MOVE' GROUP BY program, g")
def move_runs_gaps_islands(spark: SparkSession, sf: str) -> DataFrame:
    r = corpus.islands(_lines(spark, sf), ["program"], [F.col("sourceline"), F.col("row_id")], F.coalesce(F.col("flow_type") == "MOVE", F.lit(False)))
    return r.groupBy("program", "run").agg(F.min("sourceline").alias("first_line"), F.max("sourceline").alias("last_line"), F.count(F.lit(1)).alias("n_moves")).drop("run")


@query(f"SELECT row_id, s AS start_word, least(s + 512, n) AS end_word FROM (SELECT row_id, n, unnest(list_filter(range(0, greatest(n, 1), 462), lambda x: x = 0 OR x < n - 50)) AS s FROM (SELECT row_id, {WORDS} AS n FROM chunk WHERE text IS NOT NULL) WHERE n > 0)")
def chunk_windows_512_50(spark: SparkSession, sf: str) -> DataFrame:
    c = table(spark, sf, "chunk").filter("text is not null").select("row_id", corpus.token_count("text").alias("n"))
    return c.select("row_id", F.inline(corpus.windows(F.col("n"), 512, 50))).withColumnsRenamed({"start": "start_word", "end": "end_word"})


@query(WITH + ", o AS (SELECT chunk_id, program, token_count, paragraph, CASE WHEN token_count >= 60 OR lag(token_count) OVER w IS NULL THEN 1 ELSE 0 END AS s FROM chunks WHERE token_count IS NOT NULL WINDOW w AS (PARTITION BY program ORDER BY chunk_id)), g AS (SELECT *, sum(s) OVER (PARTITION BY program ORDER BY chunk_id) AS group_no FROM o) SELECT program, group_no, count(*) AS n_chunks, sum(token_count) AS n_tokens FROM g GROUP BY program, group_no")
def adjacent_small_merge(spark: SparkSession, sf: str) -> DataFrame:
    m = corpus.merge_small(chunks(spark, sf).filter("token_count is not null"), ["program"], [F.col("chunk_id")], "token_count", 60)
    return m.groupBy("program", "group_no").agg(F.count(F.lit(1)).alias("n_chunks"), F.sum("token_count").alias("n_tokens"))


_NAMES = "names AS (SELECT DISTINCT substr(program, 1, 5) AS name FROM program_catalog UNION SELECT program FROM program_catalog UNION SELECT 'ZZZ'), cat AS (SELECT program AS right_key, upper(program) AS k FROM program_catalog)"


@query(f"WITH {_NAMES} SELECT name, (SELECT arg_min(right_key, (k <> upper(name), right_key)) FROM cat WHERE starts_with(k, upper(name))) AS right_key, CASE WHEN EXISTS (SELECT 1 FROM cat WHERE k = upper(name)) THEN 'exact' WHEN EXISTS (SELECT 1 FROM cat WHERE starts_with(k, upper(name))) THEN 'prefix' ELSE 'none' END AS match FROM names")
def prefix_join_first(spark: SparkSession, sf: str) -> DataFrame:
    p = table(spark, sf, "program_catalog").select("program")
    names = p.select(F.substring("program", 1, 5).alias("name")).union(p).union(spark.createDataFrame([("ZZZ",)], "name string")).distinct()
    return corpus.prefix_join(names, p, "name", "program")


@query("SELECT doc_id, arg_max(program, (length(program), program)) AS program FROM (SELECT DISTINCT doc_id, unnest(regexp_extract_all(text, '[A-Z][A-Z0-9]{3,7}')) AS program FROM documents) WHERE program IN (SELECT program FROM program_catalog) GROUP BY doc_id")
def longest_name_match(spark: SparkSession, sf: str) -> DataFrame:
    found = table(spark, sf, "documents").select("doc_id", F.explode(F.regexp_extract_all("text", F.lit("[A-Z][A-Z0-9]{3,7}"), F.lit(0))).alias("program"))
    hit = found.join(table(spark, sf, "program_catalog").select("program"), "program", "left_semi")
    return hit.groupBy("doc_id").agg(F.max(F.struct(F.length("program"), "program")).alias("m")).select("doc_id", "m.program")


@query(WITH + "SELECT v AS variable, count(*) FILTER (WHERE is_read) AS n_reads, count(*) FILTER (WHERE NOT is_read) AS n_writes, count(DISTINCT program) AS n_programs, bool_or(is_read AND flow_type = 'IF_BRANCH') AS controls_flow, array_to_string(list_sort(list_distinct(list(CASE WHEN NOT is_read THEN id END) FILTER (WHERE NOT is_read)))[1:10], ',') AS write_sites FROM (SELECT program, id, flow_type, unnest(variablesread) AS v, true AS is_read FROM nodes UNION ALL SELECT program, id, flow_type, unnest(variablesmodified), false FROM nodes) WHERE v IS NOT NULL GROUP BY v")
def dataflow_read_write_sites(spark: SparkSession, sf: str) -> DataFrame:
    n = nodes(spark, sf)
    use = lambda c, r: n.select("program", "id", "flow_type", F.explode(c).alias("variable"), F.lit(r).alias("is_read"))
    u = use("variablesread", True).unionByName(use("variablesmodified", False)).filter("variable is not null")
    sites = derive.top_listing(u.filter("not is_read"), ["variable"], "id", 10).select("variable", F.array_join("items", ",").alias("write_sites"))
    g = u.groupBy("variable").agg(F.count_if("is_read").alias("n_reads"), F.count_if(~F.col("is_read")).alias("n_writes"), F.count_distinct("program").alias("n_programs"), F.bool_or(F.col("is_read") & (F.col("flow_type") == "IF_BRANCH")).alias("controls_flow"))
    return g.join(sites, "variable", "left")


@query(WITH + "SELECT json_extract_string(metadata, '$.sql_operation') AS op, upper(program) AS program, count(*) AS n FROM nodes WHERE flow_type = 'EXEC_SQL' AND program IS NOT NULL AND json_extract_string(metadata, '$.sql_operation') IS NOT NULL GROUP BY ALL")
def inverted_table_index(spark: SparkSession, sf: str) -> DataFrame:
    """Inverted index, a row per operation and program."""
    t = nodes(spark, sf).filter("flow_type = 'EXEC_SQL' and program is not null").select(F.upper("program").alias("program"), F.get_json_object("metadata", "$.sql_operation").alias("op")).filter("op is not null")
    return t.groupBy("op", "program").agg(F.count(F.lit(1)).alias("n"))


@query(WITH + "SELECT d.program, d.fieldname, d.id FROM data d WHERE d.fieldname IS NOT NULL AND d.id NOT IN (SELECT dst FROM edges WHERE edge_type IN ('ACCESSES', 'MODIFIES')) AND d.id NOT IN (SELECT parent_id FROM data WHERE parent_id IS NOT NULL)")
def unreferenced_variables(spark: SparkSession, sf: str) -> DataFrame:
    d = data_nodes(spark, sf).filter("fieldname is not null")
    used = edges(spark, sf).filter("edge_type in ('ACCESSES', 'MODIFIES')").select(F.col("dst").alias("id"))
    groups = data_nodes(spark, sf).select(F.col("parent_id").alias("id"))
    return d.join(used.union(groups).filter("id is not null").distinct(), "id", "left_anti").select("program", "fieldname", "id")


@query(WITH + ", s AS (SELECT id, program, fieldname, isredefinition, lag(id) OVER (PARTITION BY program, parent_id, levelnumber ORDER BY row_id) AS redefined FROM data) SELECT id, redefined FROM s WHERE isredefinition")
def redefinition_pairs(spark: SparkSession, sf: str) -> DataFrame:
    w = Window.partitionBy("program", "parent_id", "levelnumber").orderBy("row_id")
    return data_nodes(spark, sf).withColumn("redefined", F.lag("id").over(w)).filter("isredefinition").select("id", "redefined")


@query(WITH + "SELECT c.chunk_id, c.program, p.app_domain, s.n_siblings, u.n_writes FROM chunks c LEFT JOIN program_catalog p ON p.program = c.program LEFT JOIN (SELECT program, chunk_type, count(*) AS n_siblings FROM chunks GROUP BY ALL) s ON s.program = c.program AND s.chunk_type = c.chunk_type LEFT JOIN (SELECT program, count(*) AS n_writes FROM nodes WHERE len(variablesmodified) > 0 GROUP BY program) u ON u.program = c.program WHERE c.chunk_type = 'paragraph_logic'")
def enrich_paragraph_chunks(spark: SparkSession, sf: str) -> DataFrame:
    c = chunks(spark, sf)
    s = c.groupBy("program", "chunk_type").agg(F.count(F.lit(1)).alias("n_siblings"))
    u = nodes(spark, sf).filter("size(variablesmodified) > 0").groupBy("program").agg(F.count(F.lit(1)).alias("n_writes"))
    p = table(spark, sf, "program_catalog").select("program", "app_domain")
    return c.filter("chunk_type = 'paragraph_logic'").join(p, "program", "left").join(s, ["program", "chunk_type"], "left").join(u, "program", "left").select("chunk_id", "program", "app_domain", "n_siblings", "n_writes")


@query(WITH + "SELECT s.chunk_id AS summary, c.chunk_type, c.chunk_id FROM chunks c JOIN (SELECT program, min(chunk_id) AS chunk_id FROM chunks WHERE chunk_type = 'program_summary' GROUP BY program) s ON s.program = c.program WHERE c.chunk_type IN ('section_summary', 'variable_group', 'paragraph_logic')")
def program_summary_links(spark: SparkSession, sf: str) -> DataFrame:
    """Links of a program's summary to its chunks of each kind, a row per link."""
    c = chunks(spark, sf).filter("program is not null")
    s = c.filter("chunk_type = 'program_summary'").groupBy("program").agg(F.min("chunk_id").alias("summary"))
    return c.filter("chunk_type in ('section_summary', 'variable_group', 'paragraph_logic')").join(s, "program").select("summary", "chunk_type", "chunk_id")


@query("SELECT n_name, count(DISTINCT c_custkey) AS n_customers, count(DISTINCT s_suppkey) AS n_suppliers, string_agg(DISTINCT c_mktsegment, ',' ORDER BY c_mktsegment) AS segments FROM nation LEFT JOIN customer ON c_nationkey = n_nationkey LEFT JOIN supplier ON s_nationkey = n_nationkey GROUP BY n_name")
def project_entities_left_joins(spark: SparkSession, sf: str) -> DataFrame:
    """Left joins of several child tables, each aggregated before the join so that they do not multiply."""
    c = table(spark, sf, "customer").groupBy("c_nationkey").agg(F.count_distinct("c_custkey").alias("n_customers"), F.array_join(F.sort_array(F.collect_set("c_mktsegment")), ",").alias("segments"))
    s = table(spark, sf, "supplier").groupBy("s_nationkey").agg(F.count_distinct("s_suppkey").alias("n_suppliers"))
    n = table(spark, sf, "nation").join(c, F.col("n_nationkey") == F.col("c_nationkey"), "left").join(s, F.col("n_nationkey") == F.col("s_nationkey"), "left")
    return n.select("n_name", F.coalesce("n_customers", F.lit(0)).alias("n_customers"), F.coalesce("n_suppliers", F.lit(0)).alias("n_suppliers"), "segments")


@query("SELECT schema_version, count(*) AS n, count(*) FILTER (WHERE schema_version NOT IN ('1.3', '1.4', '1.5')) AS n_stale, concat_ws(',', CASE WHEN bool_or(pipeline_version IS DISTINCT FROM schema_version) THEN 'pipeline differs' END, CASE WHEN bool_or(content_hash IS NULL) THEN 'hash missing' END) AS reasons FROM chunk GROUP BY schema_version")
def regeneration_audit(spark: SparkSession, sf: str) -> DataFrame:
    reasons = F.array_compact(F.array(F.when(F.bool_or(~F.col("pipeline_version").eqNullSafe(F.col("schema_version"))), "pipeline differs"), F.when(F.bool_or(F.col("content_hash").isNull()), "hash missing")))
    stale = ~F.col("schema_version").isin(*corpus.SUPPORTED_SCHEMA_VERSIONS)
    return table(spark, sf, "chunk").groupBy("schema_version").agg(F.count(F.lit(1)).alias("n"), F.count_if(stale).alias("n_stale"), F.array_join(reasons, ",").alias("reasons"))


@query("SELECT doc_kind, sum(n_chars) AS chars, sum(n_chars) / nullif(count(*) FILTER (WHERE n_chars = 0), 0) AS per_empty FROM documents GROUP BY doc_kind")
def performance_report(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").groupBy("doc_kind").agg(F.sum("n_chars").alias("chars"), F.try_divide(F.sum("n_chars").cast("double"), F.count_if(F.col("n_chars") == 0)).alias("per_empty"))


@query("SELECT program FROM program_catalog WHERE source_kind = 'cobol' EXCEPT SELECT upper(trim(program, ' ')) FROM chunk WHERE deleted_at IS NOT NULL")
def set_difference_programs(spark: SparkSession, sf: str) -> DataFrame:
    gone = table(spark, sf, "chunk").filter("deleted_at is not null").select(F.upper(F.trim("program")).alias("program"))
    return table(spark, sf, "program_catalog").filter("source_kind = 'cobol'").select("program").subtract(gone)


@query("SELECT upper(trim(program, ' ')) AS program FROM chunk WHERE program IS NOT NULL INTERSECT SELECT program FROM documents WHERE program IS NOT NULL")
def stage_intersection(spark: SparkSession, sf: str) -> DataFrame:
    c = table(spark, sf, "chunk").filter("program is not null").select(F.upper(F.trim("program")).alias("program"))
    return c.intersect(table(spark, sf, "documents").filter("program is not null").select("program"))


@query("SELECT row_id, concat_ws(',', CASE WHEN paragraph IS NULL THEN 'paragraph' END, CASE WHEN section_name IS NULL THEN 'section_name' END, CASE WHEN parse_quality IS NULL THEN 'parse_quality' END) AS lacking FROM chunk")
def required_field_subset(spark: SparkSession, sf: str) -> DataFrame:
    fields = ["paragraph", "section_name", "parse_quality"]
    have = F.array_compact(F.array(*[F.when(F.col(f).isNotNull(), f) for f in fields]))
    return table(spark, sf, "chunk").select("row_id", F.array_join(F.array_except(F.array(*[F.lit(f) for f in fields]), have), ",").alias("lacking"))
