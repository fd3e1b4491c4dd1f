"""Queries of enrichments and job summaries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodegraph.functions import jcl
from lodegraph.operators import corpus, enrich
from lodegraph.plans.base import WITH, chunks, data_nodes, edges, nodes
from lodegraph.plans.graphs import _CALLS, _calls
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


@query(WITH + f", {_CALLS}, s AS (SELECT chunk_id, unnest([program, 'SUB' || (length(chunk_id) % 90)]) AS program FROM chunks WHERE chunk_type = 'program_summary') SELECT DISTINCT s.chunk_id, c.source AS caller FROM s JOIN calls c ON c.target = s.program")
def enrich_called_by(spark: SparkSession, sf: str) -> DataFrame:
    """Summaries with the programs that call them, under their own name or the name of their module; a row per caller."""
    c = chunks(spark, sf).filter("chunk_type = 'program_summary'").select("chunk_id", F.explode(F.array("program", F.concat(F.lit("SUB"), (F.length("chunk_id") % 90).cast("string")))).alias("target"))
    return c.join(_calls(spark, sf), "target").select("chunk_id", F.col("source").alias("caller")).distinct()


@query(WITH + f", {_CALLS}, s AS (SELECT 'SUB' || (length(chunk_id) % 90) AS program, min(chunk_id) AS id FROM chunks WHERE chunk_type = 'program_summary' GROUP BY 1) SELECT source, target, coalesce(s.id, target) AS resolved FROM calls LEFT JOIN s ON s.program = calls.target")
def enrich_call_targets(spark: SparkSession, sf: str) -> DataFrame:
    """Calls with the summary of their target, or its raw name; a row per call."""
    s = chunks(spark, sf).filter("chunk_type = 'program_summary'").select(F.concat(F.lit("SUB"), (F.length("chunk_id") % 90).cast("string")).alias("program"), "chunk_id")
    return enrich.resolve_targets(_calls(spark, sf), s)


@query(WITH + ", m AS (SELECT program, parent_id AS group_id, fieldname AS variable FROM data WHERE parent_id IS NOT NULL AND fieldname IS NOT NULL AND program IS NOT NULL), u AS (SELECT m.group_id, n.id AS usr, count(*) AS n FROM m JOIN (SELECT program, id, unnest(variablesread) AS v FROM nodes) n ON n.program = m.program AND n.v = m.variable GROUP BY ALL), r AS (SELECT *, row_number() OVER (PARTITION BY group_id ORDER BY n DESC, usr) AS r FROM u) SELECT group_id, count(*) AS n_users, string_agg(CASE WHEN r <= 10 THEN usr END, ',' ORDER BY r) AS users FROM r GROUP BY group_id")
def variable_group_usage(spark: SparkSession, sf: str) -> DataFrame:
    m = data_nodes(spark, sf).filter("parent_id is not null and fieldname is not null and program is not null").select("program", F.col("parent_id").alias("group_id"), F.col("fieldname").alias("variable"))
    u = nodes(spark, sf).select("program", F.col("id").alias("user"), F.explode("variablesread").alias("variable"))
    return enrich.group_usage(m, u)


@query(r"SELECT c.row_id, 'part ' || s || ' of text' AS t, c.row_id || ':part:' || (s + 1) AS part_id, n AS total_parts FROM (SELECT row_id, len(regexp_extract_all(text, 'EXEC SQL')) AS n FROM chunk WHERE text IS NOT NULL) c, range(0, 200) r(s) WHERE s < n")
def split_part_metadata(spark: SparkSession, sf: str) -> DataFrame:
    c = table(spark, sf, "chunk").filter("text is not null").select("row_id", F.posexplode(F.regexp_extract_all("text", F.lit("EXEC SQL"), F.lit(0))).alias("i", "x"))
    p = enrich.parts(c.select("row_id", "i", F.concat(F.lit("part "), F.col("i").cast("string"), F.lit(" of text")).alias("t")), "row_id", "i", "t", F.lit("context"))
    return p.select("row_id", F.regexp_replace("t", "^context\n", "").alias("t"), "part_id", "total_parts")


@query("SELECT program, CASE WHEN source_lines > 0 THEN greatest(source_lines - (source_lines % 50) - 3 * (source_lines % 4), 0) / source_lines END AS coverage, 'corpus:' || program AS qualified FROM program_catalog")
def parse_coverage(spark: SparkSession, sf: str) -> DataFrame:
    n = F.col("source_lines")
    return table(spark, sf, "program_catalog").select("program", enrich.parse_coverage(n, n % 50, n % 4).alias("coverage"), enrich.qualify(F.lit("corpus"), F.col("program")).alias("qualified"))


@query("SELECT event_id, regexp_extract(props, '(\\d+)', 1) AS flat FROM events")
def metadata_flat_text(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").select("event_id", enrich.flat_text(F.col("props")).alias("flat"))


@query(r"WITH l AS (SELECT row_id, unnest(regexp_split_to_array(text, '\r?\n')) AS line FROM chunk WHERE lower(trim(chunk_type, ' ')) = 'step_detail' AND text IS NOT NULL), s AS (SELECT row_id, regexp_extract(line, '^//\S*\s+EXEC\s+PGM=([A-Z0-9]+)', 1) AS pgm, regexp_extract(line, '^//\S+\s+DD\s+DSN=([A-Z0-9.]+),DISP=(SHR|OLD)', 1) AS rd, regexp_matches(line, '^//\S*\s+DD\s') AS dd FROM l) SELECT row_id, count(*) FILTER (WHERE pgm <> '') AS n_steps, coalesce(string_agg(DISTINCT pgm, ',' ORDER BY pgm) FILTER (WHERE pgm <> ''), '') AS programs, count(DISTINCT rd) FILTER (WHERE rd <> '') AS n_read, count(*) FILTER (WHERE dd) AS n_dd FROM s GROUP BY row_id HAVING count(*) FILTER (WHERE pgm <> '' OR dd) > 0")
def job_summary(spark: SparkSession, sf: str) -> DataFrame:
    j = jcl.statements(table(spark, sf, "chunk").filter("lower(trim(chunk_type)) = 'step_detail'"), "row_id", "text").filter("operation in ('EXEC', 'DD')")
    pgm = F.nullif(F.regexp_extract("operand", "^PGM=([A-Z0-9]+)", 1), F.lit(""))
    reads = F.when(jcl.disp(F.regexp_extract("operand", r"DISP=(\([^)]*\)|\w+)", 1))["access"] == "read", F.nullif(F.regexp_extract("operand", "^DSN=([A-Z0-9.]+)", 1), F.lit("")))
    g = j.select("row_id", "operation", F.when(F.col("operation") == "EXEC", pgm).alias("pgm"), F.when(F.col("operation") == "DD", reads).alias("rd")).groupBy("row_id")
    return g.agg(F.count("pgm").alias("n_steps"), F.array_join(F.sort_array(F.collect_set("pgm")), ",").alias("programs"), F.count_distinct("rd").alias("n_read"), F.count_if(F.col("operation") == "DD").alias("n_dd")).filter("n_steps > 0 or n_dd > 0")


@query(WITH + "SELECT count(DISTINCT program) AS n_programs, count(*) AS n_chunks, sum(token_count) AS n_tokens, count(*) FILTER (WHERE indexable) AS n_indexable, bool_or(parse_quality = 'degraded') AS any_degraded, count(*) FILTER (WHERE text IS NULL) / count(*) AS share_without_text FROM chunks")
def corpus_baseline(spark: SparkSession, sf: str) -> DataFrame:
    return chunks(spark, sf).agg(F.count_distinct("program").alias("n_programs"), F.count(F.lit(1)).alias("n_chunks"), F.sum("token_count").alias("n_tokens"), F.count_if("indexable").alias("n_indexable"), F.bool_or(F.col("parse_quality") == "degraded").alias("any_degraded"), (F.count_if(F.col("text").isNull()) / F.count(F.lit(1))).alias("share_without_text"))


@query(WITH + ", b AS (SELECT program, chunk_type, chunk_id FROM chunks WHERE indexable AND parse_quality = 'full') SELECT program, chunk_type, count(*) AS n, min(chunk_id) AS first_id FROM b GROUP BY ALL")
def retrieval_bundle(spark: SparkSession, sf: str) -> DataFrame:
    b = chunks(spark, sf).filter("indexable and parse_quality = 'full'")
    return b.groupBy("program", "chunk_type").agg(F.count(F.lit(1)).alias("n"), F.min("chunk_id").alias("first_id"))


@query()
def spanning_tree_clusters(spark: SparkSession, sf: str) -> DataFrame:
    e = edges(spark, sf).filter("edge_type = 'JUMPS_TO'").select(F.col("src").alias("a"), F.col("dst").alias("b"), F.coalesce("sourceline", F.lit(0)).alias("weight"))
    return enrich.tree_clusters(enrich.spanning_forest(e), 50)


@query(WITH + "SELECT chunk_type, count(*) AS n_rows, count(DISTINCT substr(sha256(text), 1, 16)) AS n_hashes, count(*) FILTER (WHERE substr(sha256(text), 1, 16) = content_hash) AS n_fresh FROM chunks GROUP BY chunk_type")
def response_cache_hits(spark: SparkSession, sf: str) -> DataFrame:
    """How many rows a cache by content hash would answer."""
    h = corpus.content_hash("text")
    return chunks(spark, sf).groupBy("chunk_type").agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct(h).alias("n_hashes"), F.count_if(h == F.col("content_hash")).alias("n_fresh"))
