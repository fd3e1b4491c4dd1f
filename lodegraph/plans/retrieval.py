"""Retrieval queries over documents; queries are notes of the corpus itself."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodegraph.operators import retrieval as r
from lodegraph.plans.base import documents, nodes
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


# A query is a program with its domain and kind: what a reader would look for.
_Q = "q AS (SELECT program AS qid, program || ' ' || coalesce(app_domain, '') || ' summary batch' AS qtext FROM program_catalog)"
_POST = f"""WITH {_Q}, docs AS (SELECT doc_id, text, program FROM documents WHERE text IS NOT NULL),
tok AS (SELECT doc_id, upper(unnest(regexp_extract_all(text, '[A-Za-z][A-Za-z0-9_-]{{1,}}'))) AS term FROM docs),
post AS (SELECT doc_id, term, count(*) AS tf FROM tok GROUP BY ALL),
len AS (SELECT doc_id, sum(tf) AS n_terms FROM post GROUP BY doc_id),
df AS (SELECT term, count(*) AS df, sum(tf) AS cf FROM post GROUP BY term),
qt AS (SELECT DISTINCT qid, upper(unnest(regexp_extract_all(qtext, '[A-Za-z][A-Za-z0-9_-]{{1,}}'))) AS term FROM q),
n AS (SELECT greatest(count(*), 1) AS n_docs, (SELECT avg(coalesce(n_terms, 0)) FROM docs LEFT JOIN len USING (doc_id)) AS avg_len FROM docs),
tfidf AS (SELECT qid, doc_id, sum(tf * (ln((1 + n_docs) / (1 + df)) + 1)) AS score FROM qt JOIN df USING (term) JOIN post USING (term), n GROUP BY ALL),
bm AS (SELECT qid, doc_id, sum(ln(1 + (n_docs - df + 0.5) / (df + 0.5)) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * n_terms / avg_len))) AS score FROM qt JOIN df USING (term) JOIN post USING (term) JOIN len USING (doc_id), n GROUP BY ALL),
ranked AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY round(score, 9) DESC, doc_id) AS rank FROM tfidf) WHERE rank <= 5)
"""


def _queries(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "program_catalog").select(F.col("program").alias("qid"), F.concat("program", F.lit(" "), F.coalesce("app_domain", F.lit("")), F.lit(" summary batch")).alias("qtext"))


def _ranked(spark: SparkSession, sf: str) -> DataFrame:
    docs, q = documents(spark, sf), _queries(spark, sf)
    post = r.postings(docs, "doc_id", "text", only=r.query_terms(q, "qid", "qtext"))
    return r.best(r.tf_idf(post, "doc_id", docs), q, "qid", "qtext", "doc_id", 5)


@query(_POST + "SELECT term, df, cf FROM df")
def term_document_frequency(spark: SparkSession, sf: str) -> DataFrame:
    return r.document_frequency(r.postings(documents(spark, sf), "doc_id", "text"))


@query("SELECT count(*) AS total_chunks, round(avg(len(regexp_extract_all(upper(text), '[A-Za-z][A-Za-z0-9_-]{2,}'))), 1) AS avg_doc_length FROM documents WHERE text IS NOT NULL")
def bm25_index_statistics(spark: SparkSession, sf: str) -> DataFrame:
    return r.index_statistics(documents(spark, sf), "text")


@query(_POST + "SELECT qid, doc_id, round(score, 6) AS score, rank FROM ranked")
def tfidf_top5(spark: SparkSession, sf: str) -> DataFrame:
    return _ranked(spark, sf).select("qid", "doc_id", F.round("score", 6).alias("score"), "rank")


@query(_POST + ", rb AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY round(score, 9) DESC, doc_id) AS rank FROM bm) WHERE rank <= 5) SELECT qid, doc_id, round(score, 6) AS score, rank FROM rb")
def bm25_top5(spark: SparkSession, sf: str) -> DataFrame:
    docs, q = documents(spark, sf), _queries(spark, sf)
    length = docs.select(F.size(r.terms("text")).alias("n")).agg(F.avg("n").alias("avg_len"))
    weighted = r.bm25(r.postings(docs, "doc_id", "text", only=r.query_terms(q, "qid", "qtext")), "doc_id", docs, length)
    return r.best(weighted, q, "qid", "qtext", "doc_id", 5).select("qid", "doc_id", F.round("score", 6).alias("score"), "rank")


_JUDGED = _POST + ", judged AS (SELECT q.qid, coalesce(min(rank) = 1, false) AS hit_1, coalesce(min(rank) <= 5, false) AS hit_5, coalesce(1.0 / min(rank), 0) AS reciprocal_rank FROM q LEFT JOIN (SELECT ranked.* FROM ranked JOIN docs ON docs.doc_id = ranked.doc_id AND docs.program = ranked.qid) x ON x.qid = q.qid GROUP BY q.qid) "


def _judged(spark: SparkSession, sf: str) -> DataFrame:
    hits = documents(spark, sf).select(F.col("program").alias("qid"), "doc_id")
    return r.judge(_ranked(spark, sf), hits, _queries(spark, sf), "qid", "doc_id")


@query(_JUDGED + "SELECT * FROM judged")
def retrieval_judged(spark: SparkSession, sf: str) -> DataFrame:
    return _judged(spark, sf)


@query(_JUDGED + "SELECT p.source_kind, count(*) AS n_queries, avg(hit_1::INT) AS recall_1, avg(hit_5::INT) AS recall_5, round(avg(reciprocal_rank), 4) AS mrr FROM judged JOIN program_catalog p ON p.program = judged.qid GROUP BY p.source_kind")
def retrieval_recall_mrr(spark: SparkSession, sf: str) -> DataFrame:
    kind = table(spark, sf, "program_catalog").select(F.col("program").alias("qid"), "source_kind")
    return r.summary(_judged(spark, sf).join(kind, "qid"), "source_kind")


@query(
    _POST
    + """, calls AS (SELECT DISTINCT upper(program) AS source, json_extract_string(metadata, '$.cics_target_program') AS target FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY ingested_at DESC, row_id DESC) AS rn FROM code_node) WHERE rn = 1 AND deleted_at IS NULL AND program IS NOT NULL AND json_extract_string(metadata, '$.cics_target_program') IS NOT NULL)
SELECT x.qid, x.doc_id, round(score * CASE WHEN d.program = x.qid THEN 2.0 WHEN EXISTS (SELECT 1 FROM calls WHERE source = d.program AND target = x.qid) THEN 1.3 WHEN EXISTS (SELECT 1 FROM calls WHERE source = x.qid AND target = d.program) THEN 1.2 ELSE 1.0 END, 6) AS adjusted FROM ranked x JOIN docs d ON d.doc_id = x.doc_id"""
)
def rerank_proximity(spark: SparkSession, sf: str) -> DataFrame:
    calls = nodes(spark, sf).select(F.upper("program").alias("source"), F.get_json_object("metadata", "$.cics_target_program").alias("target")).filter("source is not null and target is not null").distinct()
    ranked = _ranked(spark, sf).join(documents(spark, sf).select("doc_id", "program"), "doc_id")
    target = _queries(spark, sf).select("qid", F.col("qid").alias("target"))
    return r.rerank(ranked, target, calls, "qid", "doc_id").select("qid", "doc_id", F.round("adjusted", 6).alias("adjusted"))


@query("SELECT d.doc_id, regexp_matches(upper(d.text), '(^|[^A-Z0-9_-])' || d.program || '($|[^A-Z0-9_-])') AS holds FROM documents d WHERE d.text IS NOT NULL AND d.program IS NOT NULL")
def fact_containment(spark: SparkSession, sf: str) -> DataFrame:
    d = documents(spark, sf).filter("program is not null")
    return d.select("doc_id", r.contains_fact(F.col("text"), F.col("program")).alias("holds"))


@query("WITH latest AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY ingested_at DESC, row_id DESC) AS rn FROM code_node) WHERE rn = 1 AND deleted_at IS NULL) SELECT 'CALL:' || json_extract_string(metadata, '$.call_target') AS fact, 'call' AS family, count(DISTINCT program) AS n_programs FROM latest WHERE flow_type = 'CALL' AND json_extract_string(metadata, '$.call_target') IS NOT NULL GROUP BY 1 UNION ALL SELECT 'SQL:' || json_extract_string(metadata, '$.sql_operation'), 'sql', count(DISTINCT program) FROM latest WHERE json_extract_string(metadata, '$.sql_operation') IS NOT NULL GROUP BY 1")
def fact_families(spark: SparkSession, sf: str) -> DataFrame:
    """Facts of every family from one scan of the nodes."""
    pair = lambda prefix, family, value: F.when(value.isNotNull(), F.struct(F.concat(F.lit(prefix), value).alias("fact"), F.lit(family).alias("family")))
    call = F.when(F.col("flow_type") == "CALL", F.get_json_object("metadata", "$.call_target"))
    facts = F.array_compact(F.array(pair("CALL:", "call", call), pair("SQL:", "sql", F.get_json_object("metadata", "$.sql_operation"))))
    return nodes(spark, sf).select("program", F.inline(facts)).groupBy("fact", "family").agg(F.count_distinct("program").alias("n_programs"))


_MARKS = ", ".join(f"('{t}', '{m}')" for t, ms in r.TYPE_MARKERS.items() for m in ms)


@query(
    f"""WITH n AS (SELECT upper(program) AS program, upper(trim(regexp_replace(label, '\\s+', ' ', 'g'), ' ')) AS name, flow_type AS type FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY ingested_at DESC, row_id DESC) AS rn FROM code_node) WHERE rn = 1 AND deleted_at IS NULL AND program IS NOT NULL),
    d AS (SELECT program, text, upper(text) AS said FROM documents WHERE text IS NOT NULL AND program IS NOT NULL), k(type, mark) AS (VALUES {_MARKS}),
    h AS (SELECT DISTINCT program, unnest(regexp_extract_all(said, '{r.HEADING}', 1)) AS name FROM d), t AS (SELECT DISTINCT d.program, k.type FROM d JOIN k ON contains(d.said, k.mark)), m AS (SELECT program, sum(len(regexp_extract_all(text, '{r.BRANCH_MARKER}'))) AS marks FROM d GROUP BY program),
    p AS (SELECT x.program, round(count(h.name) / count(*) * 100, 2) AS headings FROM (SELECT DISTINCT program, name FROM n WHERE type = 'PARAGRAPH') x LEFT JOIN h ON h.program = x.program AND h.name = x.name GROUP BY 1),
    s AS (SELECT x.program, round(count(t.type) / count(*) * 100, 2) AS statements FROM (SELECT DISTINCT program, type FROM n WHERE type IN (SELECT type FROM k)) x LEFT JOIN t ON t.program = x.program AND t.type = x.type GROUP BY 1),
    b AS (SELECT x.program, round(least(x.n, coalesce(marks, 0)) / x.n * 100, 2) AS branches FROM (SELECT program, count(*) AS n FROM n WHERE type IN ('IF', 'IF_BRANCH', 'EVALUATE', 'EVALUATE_BRANCH', 'SEARCH') GROUP BY 1) x LEFT JOIN m ON m.program = x.program)
    SELECT program, headings, statements, branches, round(coalesce((coalesce(headings * 0.5, 0) + coalesce(statements * 0.4, 0) + coalesce(branches * 0.1, 0)) / nullif(CASE WHEN headings IS NULL THEN 0 ELSE 0.5 END + CASE WHEN statements IS NULL THEN 0 ELSE 0.4 END + CASE WHEN branches IS NULL THEN 0 ELSE 0.1 END, 0), 0), 2) AS composite
    FROM (SELECT DISTINCT program FROM n) LEFT JOIN p USING (program) LEFT JOIN s USING (program) LEFT JOIN b USING (program)"""
)
def narrative_coverage(spark: SparkSession, sf: str) -> DataFrame:
    """What the documents of a program tell of its paragraphs, statement types and branches."""
    n = nodes(spark, sf).filter("program is not null").select(F.upper("program").alias("program"), F.col("label").alias("name"), F.col("flow_type").alias("type"))
    return r.narrative_coverage(n, documents(spark, sf).filter("program is not null").select("program", "text"))
