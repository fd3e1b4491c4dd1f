"""Sources: JSON and YAML artifacts, report folders, source lines, graph texts, CSV, diagrams, parser output."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def json_artifacts(spark: SparkSession, path: str, schema: str, strict: bool = False) -> DataFrame:
    """One row per JSON file. Permissive: malformed files keep their text in _corrupt_record."""
    r = spark.read.schema(schema if strict else f"{schema}, _corrupt_record string").option("multiLine", True).option("recursiveFileLookup", True)
    r = r.option("mode", "FAILFAST") if strict else r.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt_record")
    return r.json(path).withColumn("file", F.col("_metadata.file_path"))


def flow_graph(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(nodes, edges) of control-flow JSON files; of several files in a folder the first by name."""
    schema = "nodes array<struct<id:string,type:string,name:string,originalText:string,metadata:string>>, edges array<struct<fromNodeID:string,toNodeID:string,edgeType:string>>"
    docs = json_artifacts(spark, path, schema).filter("_corrupt_record is null").withColumn("folder", F.regexp_replace("file", "/[^/]*$", ""))
    first = docs.groupBy("folder").agg(F.min_by(F.struct("nodes", "edges"), "file").alias("g"))
    return first.select("folder", F.inline("g.nodes")), first.select("folder", F.inline("g.edges"))


def yaml_artifacts(spark: SparkSession, path: str) -> DataFrame:
    """(file, json): YAML files as JSON text, null where a file is malformed. Needs PyYAML on the workers."""

    def parse(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import json

        import yaml

        for batch in batches:
            out = []
            for text in batch.column("value").to_pylist():
                try:
                    out.append(json.dumps(yaml.safe_load(text), default=str, sort_keys=True))
                except yaml.YAMLError:
                    out.append(None)
            yield pa.RecordBatch.from_arrays([batch.column("file"), pa.array(out, pa.string())], names=["file", "json"])

    texts = spark.read.option("recursiveFileLookup", True).text(path, wholetext=True).select(F.col("_metadata.file_path").alias("file"), "value")
    return texts.mapInArrow(parse, "file string, json string")


def reports(spark: SparkSession, *folders: str, marker: str = "jcl_summary.json") -> DataFrame:
    """(report, is_jcl, n_files): report folders below the given ones, each once."""
    files = None
    for f in folders:
        b = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(f).select("path")
        files = b if files is None else files.union(b)
    found = files.distinct().select(F.regexp_extract("path", r"^(.*?/[^/]+\.report)/", 1).alias("report"), F.regexp_extract("path", "[^/]*$", 0).alias("name")).filter("report <> ''")
    return found.groupBy("report").agg(F.bool_or(F.col("name") == marker).alias("is_jcl"), F.count(F.lit(1)).alias("n_files"))


def source_lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, line_no, line) of source files in UTF-8, or in Latin-1 where a file is no UTF-8."""
    b = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select(F.col("path").alias("file"), "content")
    text = F.coalesce(F.try_validate_utf8(F.col("content").cast("string")), F.decode("content", "ISO-8859-1"))
    return b.select("file", F.posexplode(F.split(text, r"\r?\n")).alias("line_no", "line")).withColumn("line_no", F.col("line_no") + 1)


def structure(lines: DataFrame, key: str = "file") -> DataFrame:
    """Lines with the division and section that hold them, and (kind, name, first, last) of those."""
    up = F.upper(F.substring("line", 8, 65))
    div = F.nullif(F.regexp_extract(up, r"^\s*([A-Z-]+)\s+DIVISION\b", 1), F.lit(""))
    sec = F.nullif(F.regexp_extract(up, r"^\s*([A-Z0-9-]+)\s+SECTION\b", 1), F.lit(""))
    w = Window.partitionBy(key).orderBy("line_no").rowsBetween(Window.unboundedPreceding, 0)
    return lines.withColumns({"division": F.last(div, ignorenulls=True).over(w), "section": F.last(sec, ignorenulls=True).over(w)})


def graph_texts(spark: SparkSession, path: str, max_graphs: int | None = None) -> tuple[DataFrame, DataFrame]:
    """(vertices, edges) of text files with lines `t # id`, `v id label`, `e from to label`, `t # -1`.

    A graph's lines follow its `t` line within one file; its number is a running sum over that file."""
    lines = source_lines(spark, path).filter("trim(line) <> ''")
    w = Window.partitionBy("file").orderBy("line_no").rowsBetween(Window.unboundedPreceding, 0)
    p = F.split(F.trim("line"), r"\s+")
    lines = lines.withColumn("p", p).withColumn("gid", F.last(F.when(F.col("p")[0] == "t", F.col("p")[2].cast("int")), ignorenulls=True).over(w)).filter("gid >= 0")
    if max_graphs is not None:
        lines = lines.withColumn("n", F.sum(F.when(F.col("p")[0] == "t", 1).otherwise(0)).over(w)).filter(F.col("n") <= max_graphs)
    v = lines.filter(F.col("p")[0] == "v").select("file", "gid", F.col("p")[1].cast("int").alias("vid"), F.col("p")[2].alias("label"))
    e = lines.filter(F.col("p")[0] == "e").select("file", "gid", F.col("p")[1].cast("int").alias("src"), F.col("p")[2].cast("int").alias("dst"), F.col("p")[3].alias("label"))
    return v, e


def system_entries(spark: SparkSession, path: str) -> DataFrame:
    """Connections of systems from CSV with a header; direction OUT points away from the system itself."""
    schema = "adjacent_system string, direction string, system_type string, connection_nature string, latency string, usage_pattern string"
    return spark.read.schema(schema).option("header", True).option("ignoreLeadingWhiteSpace", True).option("ignoreTrailingWhiteSpace", True).option("quote", '"').option("escape", '"').csv(path)


def dot_edges(spark: SparkSession, path: str) -> DataFrame:
    """(file, src, dst, label) of the edges in Graphviz or Mermaid files."""
    t = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("file"), "value")
    edge = r'"?([A-Za-z0-9_.:-]+)"?\s*(?:->|-->)\s*(?:\|([^|]*)\|\s*)?"?([A-Za-z0-9_.:-]+)"?(?:\s*\[label="([^"]*)"\])?'
    g = lambda n: F.regexp_extract_all("value", F.lit(edge), F.lit(n))
    return t.select("file", F.inline(F.arrays_zip(g(1).alias("src"), g(3).alias("dst"), g(2).alias("a"), g(4).alias("b")))).select("file", "src", "dst", F.nullif(F.concat("a", "b"), F.lit("")).alias("label"))


def parser_errors(lines: DataFrame, text: str) -> DataFrame:
    """(severity, line, message) of parser output, equal messages once."""
    pat = r"(?i)(error|warning)[^\n]*?line\s+(\d+)[:,]?\s*([^\n]*)"
    g = lambda n: F.regexp_extract_all(text, F.lit(pat), F.lit(n))
    rows = lines.select(F.inline(F.arrays_zip(F.transform(g(1), lambda x: F.lower(x)).alias("severity"), g(2).alias("line"), g(3).alias("message"))))
    return rows.select("severity", F.col("line").cast("int").alias("line"), F.trim("message").alias("message")).dropDuplicates(["message"])


def jdbc_rows(spark: SparkSession, url: str, tbl: str, key: str, value: int, driver: str | None = None) -> DataFrame:
    """Rows of a relational table by id; the filter runs in the database. Needs the database's driver."""
    r = spark.read.format("jdbc").option("url", url).option("dbtable", tbl)
    return (r.option("driver", driver) if driver else r).load().filter(F.col(key) == value)


def copy_closure(copies: DataFrame, available: DataFrame) -> DataFrame:
    """(program, copybook, depth, found): copybooks that programs take in, also through other copybooks.

    copies: member, copybook. available: copybook. Names are compared in upper case; cycles end."""
    from lodegraph.operators.graph import reach

    c = copies.select(F.upper("member").alias("src"), F.upper("copybook").alias("dst")).distinct()
    here = available.select(F.upper("copybook").alias("id")).distinct().withColumn("found", F.lit(True))
    starts = c.join(c.select(F.col("dst").alias("src")).distinct(), "src", "left_anti").select(F.col("src").alias("root"), F.col("src").alias("id")).distinct()
    return reach(c, starts).filter("depth > 0").join(here, "id", "left").select(F.col("root").alias("program"), F.col("id").alias("copybook"), "depth", F.coalesce("found", F.lit(False)).alias("found"))


def svg_edges(spark: SparkSession, path: str) -> DataFrame:
    """(path, src, dst) of drawn graphs: an edge's title names its ends; a node without any has dst null."""
    t = spark.read.text(path, wholetext=True).select(F.input_file_name().alias("path"), "value")
    titles = lambda kind: F.regexp_extract_all("value", F.lit(rf'(?s)<g[^>]*class="{kind}"[^>]*>\s*<title>(.*?)</title>'), F.lit(1))
    plain = lambda c: F.regexp_replace(F.regexp_replace(F.regexp_replace(c, "&#45;", "-"), "&gt;", ">"), "&amp;", "&")
    e = F.transform(titles("edge"), lambda x: F.struct(F.trim(F.split(plain(x), "->")[0]).alias("src"), F.trim(F.split(plain(x), "->")[1]).alias("dst")))
    ends = F.concat(F.transform(e, lambda x: x["src"]), F.transform(e, lambda x: x["dst"]))
    alone = F.transform(F.array_except(F.transform(titles("node"), plain), ends), lambda n: F.struct(n.alias("src"), F.lit(None).cast("string").alias("dst")))
    return t.select("path", F.inline(F.concat(e, alone)))
