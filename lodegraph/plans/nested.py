"""Queries p6: flat tables of the unified models."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lodegraph.operators import nested
from lodegraph.session import table

COLUMNS = {"codevertices": "codeVertices", "datavertices": "dataVertices", "edges": "edges"}


def _nodes(spark: SparkSession, sf: str) -> DataFrame:
    return nested.nested_nodes(table(spark, sf, "unified_model"), "model_id", COLUMNS)


def p6_found(spark: SparkSession, sf: str) -> DataFrame:
    return _nodes(spark, sf).select("model_id", "path", "parent_path", "node_id").distinct()


#: Flat tables: the members whose entries are rows, and their typed columns.
TABLES = {
    "p6_code_vertices": (("codeVertices",), {"type": "string", "name": "string", "sourceLine": "int"}),
    "p6_data_vertices": (("dataVertices", "children"), {"name": "string", "levelNumber": "int", "pictureClause": "string", "dataType": "string", "occursCount": "int"}),
    "p6_edges": (("edges",), {"fromNodeID": "string", "toNodeID": "string", "edgeType": "string", "condition": "string"}),
    "p6_facts": (("declarationFacts", "args", "handler_bindings"), {"fact": "string", "line": "int", "k": "string", "v": "string", "target": "string"}),
}


def _flat_table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    members, fields = TABLES[name]
    return nested.flat_table(_nodes(spark, sf), "model_id", list(members), fields)


def p6_code_vertices(spark: SparkSession, sf: str) -> DataFrame:
    return _flat_table(spark, sf, "p6_code_vertices")


def p6_data_vertices(spark: SparkSession, sf: str) -> DataFrame:
    return _flat_table(spark, sf, "p6_data_vertices")


def p6_edges(spark: SparkSession, sf: str) -> DataFrame:
    return _flat_table(spark, sf, "p6_edges")


def p6_facts(spark: SparkSession, sf: str) -> DataFrame:
    return _flat_table(spark, sf, "p6_facts")


def p6_rejects(spark: SparkSession, sf: str) -> DataFrame:
    """Column texts that are no JSON, or JSON without entries."""
    return nested.rejected(table(spark, sf, "unified_model"), "model_id", COLUMNS)


QUERIES = {f.__name__: f for f in (p6_found, p6_code_vertices, p6_data_vertices, p6_edges, p6_facts, p6_rejects)}
_NAMES = ", ".join(f"'{m}'" for m in nested.ENTRY_MEMBERS)

# JSON that is a string holds its JSON in that string.
_WALK = f"""
WITH RECURSIVE texts AS (
  SELECT DISTINCT model_id, c.name, c.j FROM unified_model, LATERAL (VALUES ('codeVertices', codevertices), ('dataVertices', datavertices), ('edges', edges)) AS c(name, j)
  WHERE c.j IS NOT NULL AND json_valid(c.j)
  UNION SELECT model_id, name, j::JSON ->> '$' FROM texts WHERE json_type(j) = 'VARCHAR' AND json_valid(j::JSON ->> '$')),
roots AS (SELECT DISTINCT model_id, name, j FROM texts WHERE json_type(j) IN ('OBJECT', 'ARRAY')),
w AS (
  SELECT model_id, CASE json_type(j) WHEN 'OBJECT' THEN name || '.0' ELSE name END AS path, '' AS owner, name AS member, json_type(j) AS kind, json_type(j) = 'OBJECT' AS is_row, j::JSON AS j FROM roots
  UNION ALL
  SELECT w.model_id,
         w.path || '.' || e.key || CASE WHEN w.kind = 'OBJECT' AND e.type = 'OBJECT' AND e.key IN ({_NAMES}) THEN '.0' ELSE '' END,
         CASE WHEN w.is_row THEN w.path ELSE w.owner END, CASE WHEN w.kind = 'OBJECT' THEN e.key WHEN e.type = 'OBJECT' THEN w.member ELSE '' END, e.type,
         e.type = 'OBJECT' AND CASE w.kind WHEN 'ARRAY' THEN w.member ELSE e.key END IN ({_NAMES}), e.value
  FROM w, json_each(w.j) AS e WHERE e.type IN ('OBJECT', 'ARRAY'))
"""


def _flat(members: tuple[str, ...], fields: dict[str, str]) -> str:
    """SQL of a flat table; a number that does not fit its type, or text of another kind, is null."""
    said = lambda f, t: f"json_extract_string(j, '$.{f}')" if t == "string" else f"try_cast(json_extract_string(j, '$.{f}') AS INT)"
    cols = ", ".join(f"{said(f, t)} AS {f.lower()}" for f, t in fields.items())
    return _WALK + f"SELECT DISTINCT model_id, path, owner AS parent_path, coalesce(json_extract_string(j, '$.id'), '') AS node_id, {cols} FROM w WHERE is_row AND member IN ({', '.join(repr(m) for m in members)})"


ORACLES = {
    "p6_found": _WALK + "SELECT DISTINCT model_id, path, owner AS parent_path, coalesce(json_extract_string(j, '$.id'), '') AS node_id FROM w WHERE is_row",
    "p6_rejects": _WALK + "SELECT model_id, c.name AS member, length(c.j)::INT AS n_chars, CASE WHEN json_valid(c.j) THEN 'scalar' ELSE 'malformed' END AS reason FROM (SELECT DISTINCT model_id, c.name, c.j FROM unified_model, LATERAL (VALUES ('codeVertices', codevertices), ('dataVertices', datavertices), ('edges', edges)) AS c(name, j)) c WHERE c.j IS NOT NULL AND trim(c.j, ' ') <> '' AND (NOT json_valid(c.j) OR json_type(c.j) NOT IN ('OBJECT', 'ARRAY', 'NULL')) AND (model_id, c.name) NOT IN (SELECT (model_id, name) FROM roots)",
    **{name: _flat(members, fields) for name, (members, fields) in TABLES.items()},
}
