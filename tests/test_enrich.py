import random

from pyspark.sql import functions as F

from lodegraph.operators import corpus, derive, enrich, retrieval


def kruskal(edges):
    parent, out = {}, set()

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for w, a, b in sorted((w, min(a, b), max(a, b)) for a, b, w in edges):
        if find(a) != find(b):
            parent[find(a)] = find(b)
            out.add((a, b, w))
    return out


def test_spanning_forest(spark):
    rnd = random.Random(6)
    e = [(f"n{rnd.randint(0, 14)}", f"n{rnd.randint(0, 14)}", rnd.randint(1, 6)) for _ in range(30)] + [("x", "y", 9), ("q", "q", 1)]
    df = spark.createDataFrame(e, "a string, b string, weight int")
    got = {tuple(r) for r in enrich.spanning_forest(df).collect()}
    assert got == {t for t in kruskal(e)}
    c = {r.id: r.cluster for r in enrich.tree_clusters(enrich.spanning_forest(df), 2).collect()}
    assert c["x"] != c["y"]
    assert enrich.spanning_forest(df.filter("false")).count() == 0


def test_level_tree(spark):
    rows = [(1, 1, "a"), (2, 5, "b"), (3, 10, "c"), (4, 88, "d"), (5, 5, "e"), (6, 77, "f"), (7, 66, "g"), (8, 1, "h"), (9, 3, "i"), (10, None, "j")]
    t = derive.level_tree(spark.createDataFrame([("P", *r) for r in rows], "p string, o int, l int, id string"), "p", F.col("o"), "l", "id")
    assert {r.id: r.parent for r in t.collect()} == {"a": None, "b": "a", "c": "b", "d": "c", "e": "a", "f": None, "g": None, "h": None, "i": "h", "j": None}


def test_pack_lines(spark):
    text = "a b\nc d\ne\n\nf g h i j k"
    parts = spark.createDataFrame([(text,)], "t string").select(derive.pack_lines(F.col("t"), "T", 4).alias("p")).first().p
    assert parts == ["a b\nc d", "T (continued):\ne\n", "T (continued):\nf g h i j k"]


def test_windows_like_a_loop(spark):
    for size, overlap in ((512, 50), (10, 3), (4, 9), (1, 0)):
        ov = min(overlap, size - 1)
        df = spark.range(0, 130).select(F.col("id").cast("int").alias("n"), corpus.windows(F.col("id").cast("int"), size, overlap).alias("w"))
        for r in df.collect():
            want, at = [], 0
            while at < r.n:
                want.append((at, min(at + size, r.n)))
                if at + size >= r.n:
                    break
                at += size - ov
            assert [(x.start, x.end) for x in r.w] == want


def test_weighted_mean_skips_null(spark):
    d = spark.createDataFrame([(1.0, None), (None, None), (1.0, 0.0)], "a double, b double")
    assert [r.x for r in d.select(corpus.weighted_mean({"a": 0.5, "b": 0.5}).alias("x")).collect()] == [1.0, None, 0.5]


def test_flat_text_and_facts(spark):
    d = spark.createDataFrame([('{"k": ["a b", {"z": 12, "y": true}]}', "CALL PAY-1.", "PAY")], "j string, t string, f string")
    r = d.select(enrich.flat_text(F.col("j")).alias("x"), retrieval.contains_fact(F.col("t"), F.col("f")).alias("y"), retrieval.contains_fact(F.col("t"), F.lit("PAY-1")).alias("z")).first()
    assert (r.x, r.y, r.z) == ("A B 12 TRUE", False, True)


def test_merge_provenance_and_resolution(spark):
    a = spark.createDataFrame([("x", 1)], "k string, v int")
    b = spark.createDataFrame([("x", 2), ("y", 3)], "k string, v int")
    assert {tuple(r) for r in derive.merge_provenance([a, b], ["k"]).collect()} == {("x", 1, "0,1"), ("y", 3, "1")}
    files = spark.createDataFrame([("abc.cpy",), ("ABC.CBL",), ("Q",)], "file string")
    names = spark.createDataFrame([("ABC",), ("q",), ("Q",), ("none",)], "name string")
    assert {tuple(r) for r in derive.resolve_names(names, files, "name", "file").collect()} == {("ABC", "ABC.CBL", "extension"), ("q", "Q", "exact"), ("Q", "Q", "exact"), ("none", None, None)}


def test_baseline_diff_nulls(spark):
    a = spark.createDataFrame([(1, 1.0), (2, None), (3, 1.0)], "k int, m double")
    b = spark.createDataFrame([(1, 1.005), (2, 5.0), (4, 1.0)], "k int, m double")
    assert {tuple(r) for r in corpus.baseline_diff(a, b, "k", ["m"]).collect()} == {(1, "same", ""), (2, "changed", "m"), (3, "removed", ""), (4, "added", "")}


def test_what_a_narrative_tells(spark):
    from lodegraph.operators import retrieval

    nodes = spark.createDataFrame([("P", "main  para", "PARAGRAPH"), ("P", "B", "PARAGRAPH"), ("P", "x", "IF_BRANCH"), ("P", "y", "if_branch"), ("P", "z", "READ"), ("Q", "a", "MOVE"), ("R", "A", "PARAGRAPH")], "program string, name string, type string")
    texts = [("P", "# TITLE\n## Main Para \n### Decision Point: x\n  - **WHEN** y\n"), ("P", "nothing"), ("P", None), ("R", "## b")]
    got = {r.program: (r.headings, r.statements, r.branches, r.composite) for r in retrieval.narrative_coverage(nodes, spark.createDataFrame(texts, "program string, text string")).collect()}
    assert got == {"P": (50.0, 50.0, 100.0, 55.0), "Q": (None, None, None, 0.0), "R": (0.0, None, None, 0.0)}


def test_bodies_of_paragraphs(spark):
    from lodegraph.operators import graph

    nodes = spark.createDataFrame([(i, "PARAGRAPH" if i in "PQR" else "MOVE") for i in "PQRabcd"], "id string, flow_type string")
    e = [("P", "a", "STARTS_WITH"), ("a", "b", "FOLLOWED_BY"), ("b", "Q", "FOLLOWED_BY"), ("b", "P", "STARTS_WITH"), ("P", "d", "FOLLOWED_BY"), ("Q", "R", "STARTS_WITH"), ("R", "c", "FOLLOWED_BY"), ("x", "y", "STARTS_WITH")]
    rows = graph.paragraph_bodies(nodes, spark.createDataFrame(e, "src string, dst string, edge_type string")).collect()
    got = {p: {r.id for r in rows if r.paragraph == p} for p in "PQR"}
    assert got == {"P": {"P", "a", "b"}, "Q": {"Q", "R", "c"}, "R": {"R"}} and len(rows) == 7


def test_size_guard_rules(spark):
    from lodegraph.operators import corpus

    rows = [("P", "1", "A", 5), ("P", "2", "A-EXIT", 3), ("P", "3", "B", 30), ("P", "4", "C", 4), ("P", "5", "D", 9), ("P", "6", "D-EXIT", 8), ("P", "7", "E", 100), ("P", "8", "F", 2), ("Q", "9", "X-EXIT", 1), ("R", "0", "Z", 0)]
    df = spark.createDataFrame(rows, "program string, id string, name string, n int")
    got = sorted(tuple(r) for r in corpus.size_guard(df, "program", "id", "name", "n", 20, 60, 10).collect())
    assert got == [("P", 1, "1", 2, 8, 1), ("P", 2, "3", 1, 30, 1), ("P", 3, "4", 3, 21, 1), ("P", 4, "7", 2, 102, 2), ("Q", 1, "9", 1, 1, 1), ("R", 1, "0", 1, 0, 1)]
    assert corpus.size_guard(df.limit(0), "program", "id", "name", "n").count() == 0


def test_indexability_of_thin_chunks(spark):
    from lodegraph.operators import corpus

    rows = [("workflow", 19, None), ("workflow", 20, None), ("workflow", 20, False), ("static_values", 1, False), ("dependencies", 1, None), (None, 1, True)]
    df = spark.createDataFrame(rows, "t string, n int, g boolean")
    got = [(r.i.thin, r.i.indexable) for r in df.select(corpus.indexability(F.col("t"), F.col("n"), F.col("g")).alias("i")).collect()]
    assert got == [(True, False), (False, True), (False, False), (False, True), (True, True), (True, False)]
