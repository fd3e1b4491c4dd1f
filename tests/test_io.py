import json
import os

from pyspark.sql import functions as F

from lodegraph.sinks import writers
from lodegraph.sources import readers
from lodegraph.streaming import windows


def put(path, text, mode="w"):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, mode) as f:
        f.write(text)


def test_flow_graph_takes_the_first_file(spark, tmp_path):
    for name, node in (("b", "2"), ("a", "1")):
        put(f"{tmp_path}/x.report/cfg/cfg-{name}.json", json.dumps({"nodes": [{"id": node, "type": "MOVE", "metadata": {"k": [1]}}], "edges": [{"fromNodeID": "1", "toNodeID": "1", "edgeType": "E"}]}))
    put(f"{tmp_path}/x.report/cfg/zz.json", "{broken")
    n, e = readers.flow_graph(spark, str(tmp_path))
    assert [(r.id, json.loads(r.metadata)) for r in n.collect()] == [("1", {"k": [1]})] and e.count() == 1
    r = readers.reports(spark, str(tmp_path), f"{tmp_path}/x.report").collect()
    assert len(r) == 1 and not r[0].is_jcl and r[0].n_files == 3


def test_lines_and_structure(spark, tmp_path):
    put(f"{tmp_path}/p.cbl", "000100 PROCEDURE DIVISION.\n000200 MAIN SECTION.\n000300     CALL 'É'.".encode("latin-1"), "wb")
    lines = readers.source_lines(spark, str(tmp_path))
    last = readers.structure(lines).orderBy("line_no").collect()[-1]
    assert (last.division, last.section) == ("PROCEDURE", "MAIN") and "É" in last.line


def test_graph_texts(spark, tmp_path):
    put(f"{tmp_path}/g.txt", "t # 0\nv 0 A\nv 1 B\ne 0 1 x\nt # 1\nv 0 C\nt # -1\n")
    v, e = readers.graph_texts(spark, f"{tmp_path}/g.txt")
    assert {(r.gid, r.vid, r.label) for r in v.collect()} == {(0, 0, "A"), (0, 1, "B"), (1, 0, "C")} and e.count() == 1
    assert readers.graph_texts(spark, f"{tmp_path}/g.txt", 1)[0].count() == 2


def test_diagrams_csv_errors_yaml(spark, tmp_path):
    put(f"{tmp_path}/d/a.dot", 'digraph {\n "a" -> "b" [label="x"];\n c -> d;\n}')
    assert {(r.src, r.dst, r.label) for r in readers.dot_edges(spark, f"{tmp_path}/d").collect()} == {("a", "b", "x"), ("c", "d", None)}
    put(f"{tmp_path}/s.csv", 'h1,h2,h3,h4,h5,h6\n A , OUT,"x, y",n,l,u\n')
    assert tuple(readers.system_entries(spark, f"{tmp_path}/s.csv").first())[:3] == ("A", "OUT", "x, y")
    log = spark.createDataFrame([("Error at line 3: bad\nwarning line 4, odd\nerror line 9: bad",)], "t string")
    assert {(r.severity, r.message) for r in readers.parser_errors(log, "t").collect()} == {("error", "bad"), ("warning", "odd")}
    try:
        import yaml  # noqa: F401
    except ImportError:
        return
    put(f"{tmp_path}/y/a.yaml", "program: P\ncalls:\n - target: Q\n")
    assert json.loads(readers.yaml_artifacts(spark, f"{tmp_path}/y").first().json)["calls"][0]["target"] == "Q"


def test_copy_closure(spark):
    c = spark.createDataFrame([("P", "a"), ("a", "B"), ("b", "A")], "member string, copybook string")
    got = {(r.program, r.copybook, r.found) for r in readers.copy_closure(c, spark.createDataFrame([("A",)], "copybook string")).collect()}
    assert got == {("P", "A", True), ("P", "B", False)}


def test_partitions_are_replaced_one_by_one(spark, tmp_path):
    d = spark.createDataFrame([("P", "t", "x", "one two"), ("Q", "t", "y", "three")], "program string, chunk_type string, chunk_id string, text string")
    writers.write_chunks(writers.stamp(d, "1.5"), f"{tmp_path}/c")
    writers.write_chunks(writers.stamp(d.filter("program = 'P'").withColumn("text", F.lit("new")), "1.5"), f"{tmp_path}/c")
    got = {(r.program, r.text) for r in spark.read.parquet(f"{tmp_path}/c").collect()}
    assert got == {("P", "new"), ("Q", "three")}


def test_exports(spark, tmp_path):
    import xml.etree.ElementTree as ET

    n = spark.createDataFrame([("a<", "MOVE"), ("b", None)], "id string, flow_type string")
    e = spark.createDataFrame([("a<", "b", "E", "P")], "src string, dst string, edge_type string, program string")
    lines = [r.line for r in writers.graphml(n, e).orderBy("part", "key").collect()]
    assert len(list(ET.fromstring("\n".join(lines)).iter())) == 8
    writers.write_text(writers.mermaid(e), f"{tmp_path}/m", "program", "key")
    assert [r.value for r in spark.read.text(f"{tmp_path}/m").collect()] == ["  a_ -->|E| b"]
    writers.append_rows(n, f"{tmp_path}/r", "key")
    writers.append_rows(n, f"{tmp_path}/r", "key")
    assert spark.read.parquet(f"{tmp_path}/r").select("key").distinct().count() == 4


def test_pending_orphans_stream(spark, tmp_path):
    """Changes of a batch count in order of their time, whatever their order in it; old references expire."""
    schema = "key string, kind string, ref_id long, ts timestamp"
    os.makedirs(f"{tmp_path}/in")
    q = windows.pending_orphans(spark.readStream.schema(schema).json(f"{tmp_path}/in"), shards=3, horizon="5 days").writeStream.format("memory").queryName("orphans").outputMode("append").option("checkpointLocation", f"{tmp_path}/ck").start()
    at = lambda d, h=0: f"2024-01-{d:02} {h:02}:00:00"
    batches = [
        [("a", "refer", 1, at(1)), ("a", "refer", 7, at(1))],
        [("a", "refer", 2, at(2, 2)), ("a", "arrive", None, at(2, 1))],
        [("a", "delete", None, at(3, 2)), ("a", "refer", 3, at(3, 1)), ("b", "delete", None, at(3)), ("b", "arrive", None, at(3)), ("b", "refer", 4, at(3))],
        [("c", "arrive", None, at(20))],
        [("c", "delete", None, at(21))],
    ]
    seen = []
    try:
        for i, rows in enumerate(batches):
            put(f"{tmp_path}/in/{i}.json", "\n".join(json.dumps(dict(zip(("key", "kind", "ref_id", "ts"), r))) for r in rows))
            q.processAllAvailable()
            seen.append(sorted((r.key, r.ref_id, r.status) for r in spark.sql("select * from orphans").collect()))
    finally:
        q.stop()
    first = [("a", 1, "opened"), ("a", 7, "opened")]
    second = [("a", 1, "resolved"), ("a", 7, "resolved")]
    third = [("a", i, "reopened") for i in (1, 2, 3, 7)] + [("b", 4, "reopened")]
    assert seen[0] == first and seen[1] == sorted(first + second) and seen[2] == sorted(first + second + third)
    assert seen[-1] == sorted(first + second + third + [("a", i, "expired") for i in (1, 2, 3, 7)] + [("b", 4, "expired")])


def test_drawn_graphs(spark, tmp_path):
    put(f"{tmp_path}/g.svg", '<svg><g id="n1" class="node"><title>A&#45;1</title></g><g class="node">\n<title>B</title></g><g class="node"><title>C</title></g><g id="e" class="edge">\n<title>A&#45;1&#45;&gt;B</title></g></svg>')
    assert {(r.src, r.dst) for r in readers.svg_edges(spark, f"{tmp_path}/g.svg").collect()} == {("A-1", "B"), ("C", None)}


def test_appended_rows_have_rising_ids(spark, tmp_path):
    rows = spark.range(5).select(F.col("id").alias("v"))
    a = {r.id for r in writers.append_returning(rows, f"{tmp_path}/t").collect()}
    b = {r.id for r in writers.append_returning(rows, f"{tmp_path}/t").collect()}
    assert len(a) == len(b) == 5 and max(a) < min(b) and {r.id for r in spark.read.parquet(f"{tmp_path}/t").collect()} == a | b
    writers.write_markdown(spark.createDataFrame([("x", 1)], "name string, n int"), f"{tmp_path}/m")
    assert [r.value for r in spark.read.text(f"{tmp_path}/m").collect() if r.value.startswith("| x")] == ["| x | 1 |"]


def test_answers_are_asked_once(spark):
    from lodegraph.operators import enrich

    prompts = spark.createDataFrame([(1, "a"), (2, "a"), (3, "b"), (4, None)], "key int, prompt string")
    cache = prompts.filter("key = 3").select(F.substring(F.sha2("prompt", 256), 1, 16).alias("hash"), F.lit("known").alias("answer"))
    got = {r.key: (r.answer, r.from_cache) for r in enrich.answered(prompts, cache, lambda ps: [f"re {p}" for p in ps]).collect()}
    assert got == {1: ("re a", False), 2: ("re a", False), 3: ("known", True), 4: (None, False)}
