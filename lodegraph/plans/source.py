"""Queries over source text: statement trees, edges, symbols, defects, runs, and the same programs without GO TO."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodegraph.operators import cobol, interpret
from lodegraph.session import spread, table

QUERIES: dict = {}
ORACLES: dict[str, str] = {}

#: Steps after which a run of one chunk is stopped; its trace then ends with a row 'limit'.
RUN_STEPS = 2_000


def query(f):
    QUERIES[f.__name__] = f
    return f


def _source(spark: SparkSession, sf: str) -> DataFrame:
    """Texts of the chunk types that hold source lines, JCL left out; files are few, so rows are spread."""
    ref = table(spark, sf, "chunk_type_ref").filter("holds_source and lower(family) <> 'jcl'").select(F.lower(F.trim("chunk_type")).alias("_type")).distinct()
    c = table(spark, sf, "chunk").filter("text is not null").withColumn("_type", F.lower(F.trim("chunk_type")))
    return spread(c.join(F.broadcast(ref), "_type").select("row_id", "text"))


@query
def source_trees(spark: SparkSession, sf: str) -> DataFrame:
    """Nodes of the statement tree of every source text, with their spans of lines."""
    return cobol.rows_of(_source(spark, sf), "row_id", "text", cobol.tree_rows, "id string, parent_id string, ordinal int, depth int, type string, name string, text string, line_start int, line_end int")


@query
def source_edges(spark: SparkSession, sf: str) -> DataFrame:
    return cobol.rows_of(_source(spark, sf), "row_id", "text", cobol.flow_edges, "src string, dst string, edge_type string")


@query
def source_symbols(spark: SparkSession, sf: str) -> DataFrame:
    return cobol.rows_of(_source(spark, sf), "row_id", "text", cobol.symbols, "name string, kind string, line int, node_id string")


@query
def source_defects(spark: SparkSession, sf: str) -> DataFrame:
    """What a validation reports: labels and names that the text does not hold, literals and statements left open."""
    return cobol.rows_of(_source(spark, sf), "row_id", "text", cobol.defects, "line int, kind string, name string")


@query
def source_ir(spark: SparkSession, sf: str) -> DataFrame:
    return cobol.rows_of(_source(spark, sf), "row_id", "text", interpret.ir_rows, "id string, parent_id string, kind string, text string")


@query
def source_runs(spark: SparkSession, sf: str) -> DataFrame:
    """Traces of the interpreter, a row per step."""
    return cobol.rows_of(_source(spark, sf), "row_id", "text", lambda t: interpret.traced(t, RUN_STEPS), "step int, node_id string, type string, detail string")


@query
def source_without_gotos(spark: SparkSession, sf: str) -> DataFrame:
    return cobol.rows_of(_source(spark, sf), "row_id", "text", interpret.restructured, "id string, parent_id string, depth int, type string, name string, text string")
