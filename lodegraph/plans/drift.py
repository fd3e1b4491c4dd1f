"""Queries p5: records written under drifting schemas."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lodegraph.operators import drift
from lodegraph.session import table


def p5_found(spark: SparkSession, sf: str) -> DataFrame:
    return drift.layout_changes(table(spark, sf, "chunk_export"), "series", "file_seq", "payload").distinct()


def p5_records(spark: SparkSession, sf: str) -> DataFrame:
    """All records in one table; a renamed field has one column, that of the name it has now."""
    exports = table(spark, sf, "chunk_export")
    names = drift.renamings(drift.layout_changes(exports, "series", "file_seq", "payload"))
    return drift.one_table(exports, ["record_id", "series", "file_seq", "file_name"], "payload", names)


def p5_rejects(spark: SparkSession, sf: str) -> DataFrame:
    return drift.rejected(table(spark, sf, "chunk_export"), ["record_id", "series", "file_seq"], "payload")


QUERIES = {"p5_found": p5_found, "p5_records": p5_records, "p5_rejects": p5_rejects}

_FIELDS = """
WITH RECURSIVE w AS (
  SELECT record_id, series, file_seq, '' AS path, payload::JSON AS j, 'OBJECT' AS t FROM chunk_export WHERE json_valid(payload) AND json_type(payload) = 'OBJECT'
  UNION ALL
  SELECT w.record_id, w.series, w.file_seq, CASE WHEN w.path = '' THEN e.key ELSE w.path || '.' || e.key END, e.value, e.type FROM w, json_each(w.j) AS e WHERE w.t = 'OBJECT'),
f AS (
  SELECT record_id, series, file_seq, path,
         CASE WHEN t = 'VARCHAR' THEN 'string' WHEN t = 'BOOLEAN' THEN 'boolean' WHEN t = 'OBJECT' THEN 'object' WHEN t = 'ARRAY' THEN 'array' WHEN t = 'DOUBLE' THEN 'decimal' WHEN t <> 'NULL' THEN 'integer' END AS tag,
         CASE WHEN t = 'VARCHAR' THEN j ->> '$' WHEN t <> 'NULL' THEN j::VARCHAR END AS v
  FROM w WHERE path <> '')
"""

_CHANGES = _FIELDS + """,
per AS (SELECT series, file_seq, path, list_sort(list(DISTINCT tag) FILTER (WHERE tag IS NOT NULL)) AS tags FROM f GROUP BY ALL),
own AS (SELECT *, CASE WHEN len(coalesce(tags, [])) = 0 THEN NULL WHEN len(tags) = 1 THEN tags[1] WHEN tags = ['decimal', 'integer'] THEN 'decimal' ELSE 'string' END AS own FROM per),
files AS (SELECT series, file_seq, row_number() OVER (PARTITION BY series ORDER BY file_seq) AS no, count(*) OVER (PARTITION BY series) AS n FROM (SELECT DISTINCT series, file_seq FROM per)),
runs AS (SELECT own.*, no, n, no - row_number() OVER (PARTITION BY own.series, path ORDER BY no) AS run FROM own JOIN files USING (series, file_seq)),
typed AS (SELECT *, last_value(own IGNORE NULLS) OVER (PARTITION BY series, path, run ORDER BY no) AS type, lag(no) OVER (PARTITION BY series, path ORDER BY no) AS prev, lead(no) OVER (PARTITION BY series, path ORDER BY no) AS next FROM runs),
lay AS (SELECT *, CASE WHEN prev = no - 1 THEN lag(type) OVER (PARTITION BY series, path ORDER BY no) END AS had, no > 1 AND prev IS DISTINCT FROM no - 1 AS is_new, no < n AND next IS DISTINCT FROM no + 1 AS is_last FROM typed),
new AS (SELECT series, file_seq, no, path, type FROM lay WHERE is_new),
lost AS (SELECT series, file_seq AS seq_before, no + 1 AS no, path, type FROM lay WHERE is_last),
vals AS (SELECT DISTINCT f.series, f.file_seq, k.v AS key, f.path, f.v FROM f JOIN (SELECT DISTINCT record_id, v FROM f WHERE path = 'chunk_id' AND v IS NOT NULL) k USING (record_id) WHERE f.v IS NOT NULL),
a AS (SELECT l.series, l.no, l.path, x.key, x.v FROM lost l JOIN vals x ON x.series = l.series AND x.file_seq = l.seq_before AND x.path = l.path),
b AS (SELECT m.series, m.no, m.path, x.key, x.v FROM new m JOIN vals x ON x.series = m.series AND x.file_seq = m.file_seq AND x.path = m.path),
fits AS (SELECT a.series, a.no, a.path AS old, b.path AS new FROM a JOIN b ON b.series = a.series AND b.no = a.no AND b.key = a.key GROUP BY ALL HAVING bool_and(a.v = b.v) AND count(DISTINCT a.key) >= 2),
tries AS (SELECT *, row_number() OVER (PARTITION BY series, no ORDER BY old, new) AS i FROM fits),
taken AS (
  SELECT series, no, 1::BIGINT AS i, [old] AS olds, [new] AS news FROM tries WHERE i = 1
  UNION ALL
  SELECT t.series, t.no, t.i, CASE WHEN list_contains(olds, t.old) OR list_contains(news, t.new) THEN olds ELSE list_append(olds, t.old) END, CASE WHEN list_contains(olds, t.old) OR list_contains(news, t.new) THEN news ELSE list_append(news, t.new) END
  FROM taken k JOIN tries t ON t.series = k.series AND t.no = k.no AND t.i = k.i + 1),
renamed AS (SELECT series, no, unnest(olds) AS old, unnest(news) AS new FROM (SELECT series, no, arg_max(olds, i) AS olds, arg_max(news, i) AS news FROM taken GROUP BY series, no)),
changes AS (
  SELECT series, no, new AS field, 'renamed' AS change_kind, old AS old_field FROM renamed
  UNION ALL SELECT series, no, path, 'added', '' FROM new WHERE (series, no, path) NOT IN (SELECT (series, no, new) FROM renamed)
  UNION ALL SELECT series, no, path, 'removed', '' FROM lost WHERE (series, no, path) NOT IN (SELECT (series, no, old) FROM renamed)
  UNION ALL SELECT series, no, path, 'retyped', '' FROM lay WHERE NOT is_new AND no > 1 AND type <> had
  UNION ALL SELECT r.series, r.no, r.new, 'retyped', '' FROM renamed r JOIN new m ON m.series = r.series AND m.no = r.no AND m.path = r.new JOIN lost l ON l.series = r.series AND l.no = r.no AND l.path = r.old WHERE m.type <> l.type)
SELECT DISTINCT c.series, f.file_seq, c.field, c.change_kind, c.old_field FROM changes c JOIN files f ON f.series = c.series AND f.no = c.no
"""

ORACLES: dict[str, str] = {
    "p5_found": _CHANGES,
    "p5_rejects": "SELECT record_id, series, file_seq, length(payload)::INT AS n_chars FROM chunk_export WHERE payload IS NULL OR NOT json_valid(payload) OR json_type(payload) <> 'OBJECT'",
}
