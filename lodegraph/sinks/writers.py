"""Sinks: stamped documents, manifests, GraphML, Mermaid and Graphviz, relational appends, metrics.

Writers produce their text as rows, so a graph of any size is written by many tasks; folders are replaced
by Spark's committer, partitions of a table one by one."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodegraph.functions.text import diagram_id
from lodegraph.operators.corpus import content_hash, indexability, token_count
from lodegraph.session import cut


def stamp(chunks: DataFrame, schema_version: str, quality: str = "full", tokens: Column | None = None) -> DataFrame:
    """Chunks with hash, token count, source id, versions, quality, and flags thin and indexable.

    tokens: count of a tokenizer where there is one, as `p3_chunk_tokens` gives it; words without it."""
    n = token_count("text") if tokens is None else tokens
    flags = indexability(F.lower(F.trim("chunk_type")), n)
    return chunks.withColumns(
        {
            "content_hash": content_hash("text"),
            "token_count": n,
            "source_id": F.coalesce("source_id", "chunk_id") if "source_id" in chunks.columns else F.col("chunk_id"),
            "schema_version": F.lit(schema_version),
            "parse_quality": F.lit(quality),
            "thin_chunk": flags["thin"],
            "indexable": flags["indexable"],
            "analysis_timestamp": F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss'Z'"),
        }
    )


def write_chunks(chunks: DataFrame, path: str) -> None:
    """Replace the partitions (program, chunk_type) that `chunks` holds; others stay."""
    chunks.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("program", "chunk_type").parquet(path)


def manifest(chunks: DataFrame) -> DataFrame:
    """One JSON row: type counts and surplus equal hashes."""
    types = chunks.groupBy("chunk_type").agg(F.count(F.lit(1)).alias("n")).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct(F.coalesce("chunk_type", F.lit("")), "n")))).alias("type_counts"))
    dup = chunks.filter("content_hash is not null").groupBy("content_hash").agg(F.count(F.lit(1)).alias("n")).agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)))
    return types.withColumn("duplicate_content_hashes", dup.scalar()).select(F.to_json(F.struct("type_counts", "duplicate_content_hashes")).alias("json"))


def _xml(c: Column) -> Column:
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        c = F.regexp_replace(c, a, b)
    return c


def graphml(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(part, key, line): lines of a GraphML document in order of part and key."""
    head = nodes.sparkSession.createDataFrame([(0, "", '<graphml xmlns="http://graphml.graphdrawing.org/xmlns"><graph edgedefault="directed">'), (3, "", "</graph></graphml>")], "part int, key string, line string")
    n = nodes.select(F.lit(1).alias("part"), F.col("id").alias("key"), F.concat(F.lit('<node id="'), _xml(F.col("id")), F.lit('"><data key="type">'), _xml(F.coalesce("flow_type", F.lit(""))), F.lit("</data></node>")).alias("line"))
    e = edges.select(F.lit(2).alias("part"), F.concat_ws("|", "src", "dst", "edge_type").alias("key"), F.concat(F.lit('<edge source="'), _xml(F.col("src")), F.lit('" target="'), _xml(F.col("dst")), F.lit('"><data key="type">'), _xml(F.col("edge_type")), F.lit("</data></edge>")).alias("line"))
    return head.unionByName(n).unionByName(e)


def mermaid(edges: DataFrame) -> DataFrame:
    """(program, key, line): a Mermaid flowchart per program, lines in order of their key below the header."""
    return edges.select("program", F.concat_ws("|", "src", "dst", "edge_type").alias("key"), F.concat(F.lit("  "), diagram_id("src"), F.lit(" -->|"), F.col("edge_type"), F.lit("| "), diagram_id("dst")).alias("line"))


def graphviz(edges: DataFrame) -> DataFrame:
    return edges.select("program", F.concat_ws("|", "src", "dst", "edge_type").alias("key"), F.concat(F.lit('  "'), F.col("src"), F.lit('" -> "'), F.col("dst"), F.lit('" [label="'), F.col("edge_type"), F.lit('"];')).alias("line"))


def plain_text(edges: DataFrame) -> DataFrame:
    """(program, key, line): edges as sentences, for readers that take no diagrams."""
    return edges.select("program", F.concat_ws("|", "src", "dst", "edge_type").alias("key"), F.concat("src", F.lit(" "), F.lower(F.regexp_replace("edge_type", "_", " ")), F.lit(" "), "dst", F.lit(".")).alias("line"))


def html(nodes: DataFrame, edges: DataFrame, title: str = "Program graph") -> DataFrame:
    """(part, key, line): lines of a static HTML page that lists nodes and edges, in order of part and key."""
    ends = [(0, "", f"<!DOCTYPE html><html><head><meta charset=\"utf-8\"><title>{title}</title></head><body><h1>{title}</h1><h2>Nodes</h2><ul>"), (2, "", "</ul><h2>Edges</h2><ul>"), (4, "", "</ul></body></html>")]
    head = nodes.sparkSession.createDataFrame(ends, "part int, key string, line string")
    n = nodes.select(F.lit(1).alias("part"), F.col("id").alias("key"), F.concat(F.lit('<li id="'), _xml(F.col("id")), F.lit('">'), _xml(F.coalesce("flow_type", F.lit(""))), F.lit(" "), _xml(F.coalesce("originaltext", F.lit(""))), F.lit("</li>")).alias("line"))
    e = edges.select(F.lit(3).alias("part"), F.concat_ws("|", "src", "dst", "edge_type").alias("key"), F.concat(F.lit('<li><a href="#'), _xml(F.col("src")), F.lit('">'), _xml(F.col("src")), F.lit("</a> "), _xml(F.col("edge_type")), F.lit(' <a href="#'), _xml(F.col("dst")), F.lit('">'), _xml(F.col("dst")), F.lit("</a></li>")).alias("line"))
    return head.unionByName(n).unionByName(e)


def write_bundle(chunks: DataFrame, path: str) -> None:
    """The chunks that retrieval reads: indexable ones, as JSON lines per program."""
    chunks.filter("indexable").write.mode("overwrite").partitionBy("program").json(path)


def write_markdown(metrics: DataFrame, path: str) -> None:
    """A table of measures as Markdown. Measures are few; their rows keep their order within a file."""
    cells = F.concat(F.lit("| "), F.concat_ws(" | ", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in metrics.columns]), F.lit(" |"))
    head = metrics.sparkSession.createDataFrame([(0, f"| {' | '.join(metrics.columns)} |"), (1, "|" + "---|" * len(metrics.columns))], "n long, line string")
    body = metrics.select((F.monotonically_increasing_id() + 2).alias("n"), cells.alias("line"))
    head.unionByName(body).repartitionByRange("n").sortWithinPartitions("n").select("line").write.mode("overwrite").text(path)


def append_returning(rows: DataFrame, path: str, key: str = "id") -> DataFrame:
    """Append rows under new whole numbers, larger than all there are; returns the rows with their ids.

    The append becomes visible as a whole or not at all. One writer at a time, as with any sequence."""
    spark = rows.sparkSession
    try:
        last = spark.read.parquet(path).agg(F.max(key)).first()[0]
    except AnalysisException:
        last = None
    new = cut(rows.withColumn(key, F.monotonically_increasing_id() + F.lit((-1 if last is None else last) + 1)))
    new.write.mode("append").parquet(path)
    return new


def write_text(lines: DataFrame, path: str, *order: str) -> None:
    """Lines in order as text files whose names keep the order."""
    lines.repartitionByRange(*order).sortWithinPartitions(*order).select("line").write.mode("overwrite").text(path)


def append_rows(rows: DataFrame, path: str, key: str = "id") -> None:
    """Append rows with ids that are unique within the append; a whole append becomes visible or none."""
    rows.withColumn(key, F.expr("uuid()")).write.mode("append").parquet(path)


def write_metrics(metrics: DataFrame, path: str) -> None:
    metrics.write.mode("overwrite").option("header", True).csv(path)
