"""Graph and document views over the stored tables, for queries and, as CTEs, for their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lodegraph.session import table


def _latest(df: DataFrame) -> DataFrame:
    """The last export of every id, without those deleted."""
    w = Window.partitionBy("id").orderBy(F.desc("ingested_at"), F.desc("row_id"))
    return df.withColumn("rn", F.row_number().over(w)).filter("rn = 1 and deleted_at is null").drop("rn")


def nodes(spark: SparkSession, sf: str) -> DataFrame:
    return _latest(table(spark, sf, "code_node"))


def data_nodes(spark: SparkSession, sf: str) -> DataFrame:
    return _latest(table(spark, sf, "data_node"))


def edges(spark: SparkSession, sf: str) -> DataFrame:
    """Distinct (src, dst, edge_type) with the least row id; ids without outer blanks, in lower case."""
    e = table(spark, sf, "code_edge").select(F.lower(F.trim("fromnodeid")).alias("src"), F.lower(F.trim("tonodeid")).alias("dst"), F.col("edgetype").alias("edge_type"), "program", "row_id", "sourceline")
    return e.filter("src <> '' and dst <> '' and edge_type is not null").groupBy("src", "dst", "edge_type").agg(F.min_by(F.struct("program", "sourceline"), "row_id").alias("m"), F.min("row_id").alias("row_id")).select("src", "dst", "edge_type", "m.program", "m.sourceline", "row_id")


def documents(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").filter("text is not null")


def chunks(spark: SparkSession, sf: str) -> DataFrame:
    """One row per chunk id: the last one that is not deleted, with chunk type and program cleaned."""
    c = table(spark, sf, "chunk").filter("chunk_id is not null and deleted_at is null")
    w = Window.partitionBy("chunk_id").orderBy(F.desc("ingested_at"), F.desc("row_id"))
    return c.withColumn("rn", F.row_number().over(w)).filter("rn = 1").drop("rn").withColumns({"chunk_type": F.lower(F.trim("chunk_type")), "program": F.upper(F.trim("program"))})


CTE = """
nodes AS (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY ingested_at DESC, row_id DESC) AS rn FROM code_node) WHERE rn = 1 AND deleted_at IS NULL),
data AS (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY ingested_at DESC, row_id DESC) AS rn FROM data_node) WHERE rn = 1 AND deleted_at IS NULL),
edges AS (SELECT src, dst, edge_type, arg_min(program, row_id) AS program, arg_min(sourceline, row_id) AS sourceline, min(row_id) AS row_id
          FROM (SELECT lower(trim(fromnodeid, ' ')) AS src, lower(trim(tonodeid, ' ')) AS dst, edgetype AS edge_type, program, row_id, sourceline FROM code_edge)
          WHERE src <> '' AND dst <> '' AND edge_type IS NOT NULL GROUP BY src, dst, edge_type),
chunks AS (SELECT * EXCLUDE (rn) REPLACE (lower(trim(chunk_type, ' ')) AS chunk_type, upper(trim(program, ' ')) AS program)
           FROM (SELECT *, row_number() OVER (PARTITION BY chunk_id ORDER BY ingested_at DESC, row_id DESC) AS rn FROM chunk WHERE chunk_id IS NOT NULL AND deleted_at IS NULL) WHERE rn = 1)
"""
WITH = f"WITH {CTE}"
WITH_RECURSIVE = f"WITH RECURSIVE {CTE}"
