"""Queries p2: references of chunks, index entries and edges to records that do not exist."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession

from lodegraph.operators import orphans
from lodegraph.session import table


def _sides(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """References and the records they may mean. Chunks and graph nodes are separate key spaces."""
    from pyspark.sql import functions as F

    chunk, entry, edge = (table(spark, sf, t) for t in ("chunk", "bm25_entry", "code_edge"))
    space = lambda df, s: df.withColumn("key", F.concat(F.lit(s), "key"))
    parents = [
        space(orphans.parent_rows(chunk, ["chunk_id", "split_from"], "ingested_at", "deleted_at"), "c:"),
        space(orphans.parent_rows(table(spark, sf, "code_node"), ["id"], "ingested_at", "deleted_at"), "n:"),
        space(orphans.parent_rows(table(spark, sf, "data_node"), ["id"], "ingested_at", "deleted_at"), "n:"),
    ]
    refs = [
        space(orphans.references(chunk, "chunk", "row_id", "parent_program_chunk", "ingested_at"), "c:"),
        space(orphans.references(entry, "bm25_entry", "row_id", "chunk_id", "indexed_at"), "c:"),
        space(orphans.references(edge, "code_edge", "row_id", "tonodeid", "ingested_at"), "n:"),
    ]
    return reduce(DataFrame.unionByName, refs), reduce(DataFrame.unionByName, parents)


def p2_found(spark: SparkSession, sf: str) -> DataFrame:
    return orphans.orphan_references(*_sides(spark, sf)).select("ref_table", "row_id", "reason", "period").distinct()


def p2_orphan_counts(spark: SparkSession, sf: str) -> DataFrame:
    return orphans.orphan_counts(orphans.orphan_references(*_sides(spark, sf)))


def p2_pending(spark: SparkSession, sf: str) -> DataFrame:
    return orphans.pending_by_month(*_sides(spark, sf))


QUERIES = {"p2_found": p2_found, "p2_orphan_counts": p2_orphan_counts, "p2_pending": p2_pending}

_FOUND = """
WITH parents AS (
  SELECT DISTINCT 'c' AS sp, k AS key, ingested_at AS arrived, deleted_at AS gone FROM (
    SELECT lower(trim(chunk_id, ' ')) AS k, ingested_at, deleted_at FROM chunk
    UNION ALL SELECT lower(trim(split_from, ' ')), ingested_at, deleted_at FROM chunk) WHERE k <> ''
  UNION SELECT DISTINCT 'n', lower(trim(id, ' ')), ingested_at, deleted_at FROM code_node WHERE trim(id, ' ') <> ''
  UNION SELECT DISTINCT 'n', lower(trim(id, ' ')), ingested_at, deleted_at FROM data_node WHERE trim(id, ' ') <> ''),
refs AS (
  SELECT 'chunk' AS ref_table, row_id, 'c' AS sp, lower(trim(parent_program_chunk, ' ')) AS key, ingested_at AS at_ts FROM chunk WHERE trim(parent_program_chunk, ' ') <> ''
  UNION ALL SELECT 'bm25_entry', row_id, 'c', lower(trim(chunk_id, ' ')), indexed_at FROM bm25_entry WHERE trim(chunk_id, ' ') <> ''
  UNION ALL SELECT 'code_edge', row_id, 'n', lower(trim(tonodeid, ' ')), ingested_at FROM code_edge WHERE trim(tonodeid, ' ') <> ''),
probed AS (
  SELECT ref_table, row_id, any_value(at_ts) AS at_ts, count(p.key) AS known,
         count(*) FILTER (WHERE p.arrived <= r.at_ts) AS arrived,
         count(*) FILTER (WHERE p.arrived <= r.at_ts AND (p.gone IS NULL OR p.gone > r.at_ts)) AS live
  FROM refs r LEFT JOIN parents p ON p.sp = r.sp AND p.key = r.key GROUP BY ref_table, row_id),
found AS (
  SELECT ref_table, row_id, CASE WHEN known = 0 THEN 'missing' WHEN arrived = 0 THEN 'late' ELSE 'deleted' END AS reason,
         strftime(at_ts, '%Y-%m') AS period FROM probed WHERE live = 0)
"""

ORACLES = {
    "p2_found": _FOUND + "SELECT DISTINCT ref_table, row_id, reason, period FROM found",
    "p2_orphan_counts": _FOUND + "SELECT ref_table, period, reason, count(*) AS n_orphans FROM found GROUP BY ALL",
    "p2_pending": _FOUND
    + """, moves AS (SELECT sp, key, ts, sum(d) AS d FROM (SELECT sp, key, arrived AS ts, 1 AS d FROM parents WHERE arrived IS NOT NULL UNION ALL SELECT sp, key, greatest(arrived, gone), -1 FROM parents WHERE arrived IS NOT NULL AND gone IS NOT NULL) GROUP BY ALL),
state AS (SELECT *, sum(d) OVER (PARTITION BY sp, key ORDER BY ts) AS live FROM moves),
flips AS (SELECT * FROM (SELECT sp, key, ts, live > 0 AS lives, coalesce(lag(live) OVER (PARTITION BY sp, key ORDER BY ts), 0) > 0 AS was FROM state) WHERE lives <> was),
turned AS (SELECT r.ref_table, strftime(f.ts, '%Y-%m') AS period, count(*) FILTER (WHERE f.lives AND r.at_ts < f.ts) AS resolved, count(*) FILTER (WHERE NOT f.lives AND r.at_ts < f.ts) AS reopened FROM flips f JOIN refs r ON r.sp = f.sp AND r.key = f.key GROUP BY ALL),
opened AS (SELECT ref_table, period, count(*) AS opened FROM found GROUP BY ALL),
per AS (SELECT ref_table, period, coalesce(opened, 0) AS opened, coalesce(resolved, 0) AS resolved, coalesce(reopened, 0) AS reopened FROM opened FULL JOIN turned USING (ref_table, period))
SELECT *, sum(opened - resolved + reopened) OVER (PARTITION BY ref_table ORDER BY period) AS pending FROM per""",
}
