"""Queries of sinks and streaming operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodegraph.plans.base import WITH, chunks, edges, nodes
from lodegraph.sinks import writers
from lodegraph.streaming import windows
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


@query(WITH + "SELECT 1 AS part, id AS key, '<node id=\"' || id || '\"><data key=\"type\">' || coalesce(flow_type, '') || '</data></node>' AS line FROM nodes UNION ALL SELECT 2, src || '|' || dst || '|' || edge_type, '<edge source=\"' || src || '\" target=\"' || dst || '\"><data key=\"type\">' || edge_type || '</data></edge>' FROM edges UNION ALL SELECT 0, '', '<graphml xmlns=\"http://graphml.graphdrawing.org/xmlns\"><graph edgedefault=\"directed\">' UNION ALL SELECT 3, '', '</graph></graphml>'")
def graphml_export(spark: SparkSession, sf: str) -> DataFrame:
    return writers.graphml(nodes(spark, sf), edges(spark, sf))


@query(WITH + "SELECT program, concat_ws('|', src, dst, edge_type) AS key, '  ' || CASE WHEN regexp_matches(src, '^[0-9]') THEN 'n_' ELSE '' END || regexp_replace(src, '[^A-Za-z0-9_]', '_', 'g') || ' -->|' || edge_type || '| ' || CASE WHEN regexp_matches(dst, '^[0-9]') THEN 'n_' ELSE '' END || regexp_replace(dst, '[^A-Za-z0-9_]', '_', 'g') AS line FROM edges WHERE edge_type = 'JUMPS_TO'")
def mermaid_text(spark: SparkSession, sf: str) -> DataFrame:
    return writers.mermaid(edges(spark, sf).filter("edge_type = 'JUMPS_TO'"))


@query(WITH + "SELECT program, concat_ws('|', src, dst, edge_type) AS key, '  \"' || src || '\" -> \"' || dst || '\" [label=\"' || edge_type || '\"];' AS line FROM edges WHERE edge_type = 'JUMPS_TO'")
def graphviz_text(spark: SparkSession, sf: str) -> DataFrame:
    return writers.graphviz(edges(spark, sf).filter("edge_type = 'JUMPS_TO'"))


@query(WITH + "SELECT program, concat_ws('|', src, dst, edge_type) AS key, src || ' ' || lower(replace(edge_type, '_', ' ')) || ' ' || dst || '.' AS line FROM edges WHERE edge_type = 'JUMPS_TO'")
def plain_edges(spark: SparkSession, sf: str) -> DataFrame:
    return writers.plain_text(edges(spark, sf).filter("edge_type = 'JUMPS_TO'"))


@query(
    WITH
    + """SELECT 1 AS part, id AS key, '<li id="' || replace(replace(replace(replace(id, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '"', '&quot;') || '">' || replace(replace(replace(replace(coalesce(flow_type, ''), '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '"', '&quot;') || ' ' || replace(replace(replace(replace(coalesce(originaltext, ''), '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '"', '&quot;') || '</li>' AS line FROM nodes
    UNION ALL SELECT 3, concat_ws('|', src, dst, edge_type), '<li><a href="#' || replace(replace(replace(replace(src, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '"', '&quot;') || '">' || replace(replace(replace(replace(src, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '"', '&quot;') || '</a> ' || replace(replace(replace(replace(edge_type, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '"', '&quot;') || ' <a href="#' || replace(replace(replace(replace(dst, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '"', '&quot;') || '">' || replace(replace(replace(replace(dst, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '"', '&quot;') || '</a></li>' FROM edges
    UNION ALL SELECT 0, '', '<!DOCTYPE html><html><head><meta charset="utf-8"><title>Program graph</title></head><body><h1>Program graph</h1><h2>Nodes</h2><ul>' UNION ALL SELECT 2, '', '</ul><h2>Edges</h2><ul>' UNION ALL SELECT 4, '', '</ul></body></html>'"""
)
def html_page(spark: SparkSession, sf: str) -> DataFrame:
    return writers.html(nodes(spark, sf), edges(spark, sf))


@query(WITH + r"SELECT chunk_id, substr(sha256(text), 1, 16) AS content_hash, coalesce(len(list_filter(regexp_split_to_array(text, '\s+'), lambda x: x <> '')), 0) AS token_count, coalesce(source_id, chunk_id) AS source_id, '1.5' AS schema_version FROM chunks")
def stamped_chunks(spark: SparkSession, sf: str) -> DataFrame:
    return writers.stamp(chunks(spark, sf), "1.5").select("chunk_id", "content_hash", "token_count", "source_id", "schema_version")


@query(WITH + "SELECT '{\"type_counts\":{' || (SELECT string_agg('\"' || t || '\":' || n, ',' ORDER BY t) FROM (SELECT coalesce(chunk_type, '') AS t, count(*) AS n FROM chunks GROUP BY 1)) || '},\"duplicate_content_hashes\":' || (SELECT coalesce(sum(n - 1), 0) FROM (SELECT count(*) AS n FROM chunks WHERE content_hash IS NOT NULL GROUP BY content_hash)) || '}' AS json")
def manifest_json(spark: SparkSession, sf: str) -> DataFrame:
    return writers.manifest(chunks(spark, sf))


@query("SELECT time_bucket(INTERVAL 1 HOUR, ts) AS start, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY ALL")
def windowed_events(spark: SparkSession, sf: str) -> DataFrame:
    """The streaming window operator over the whole table as one batch."""
    return windows.windowed(table(spark, sf, "events")).withColumn("total", F.round("total", 4))


@query("WITH g AS (SELECT user_id, ts, CASE WHEN ts > lag(ts) OVER (PARTITION BY user_id ORDER BY ts) + INTERVAL 30 MINUTE OR lag(ts) OVER (PARTITION BY user_id ORDER BY ts) IS NULL THEN 1 ELSE 0 END AS s FROM events), h AS (SELECT user_id, ts, sum(s) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS k FROM g) SELECT user_id, min(ts) AS start, max(ts) + INTERVAL 30 MINUTE AS \"end\", count(*) AS n FROM h GROUP BY user_id, k")
def event_sessions(spark: SparkSession, sf: str) -> DataFrame:
    return windows.sessions(table(spark, sf, "events"))
