import json
from collections import Counter
from decimal import Decimal

from pyspark.sql import functions as F

from lodegraph.operators import drift, nested

COLUMNS = {"codevertices": "codeVertices", "datavertices": "dataVertices", "edges": "edges"}
SCHEMA = "model_id long, codevertices string, datavertices string, edges string, path string, v string"


def flatten(models):
    names, out = set(nested.ENTRY_MEMBERS), set()

    def walk(m, x, path, owner):
        if isinstance(x, dict):
            for k, v in x.items():
                if k in names:
                    for i, y in enumerate(v if isinstance(v, list) else [v] if isinstance(v, dict) else []):
                        p = [*path, k, str(i)]
                        if isinstance(y, dict):
                            out.add((m, ".".join(p), owner, "" if y.get("id") is None else str(y["id"])))
                        walk(m, y, p, ".".join(p) if isinstance(y, dict) else owner)
                else:
                    walk(m, v, [*path, k], owner)
        elif isinstance(x, list):
            for i, y in enumerate(x):
                walk(m, y, [*path, str(i)], owner)

    for m, *cols, _, _ in models:
        root = {}
        for name, c in zip(COLUMNS.values(), cols):
            try:
                root[name] = json.loads(c) if c else None
            except ValueError:
                pass
        walk(m, root, [], "")
    return out


def test_nested_shapes(spark):
    deep = {"id": "d0"}
    for i in range(1, 14):
        deep = {"id": f"d{i}", "children": [None, deep, {"name": "no id"}], "declarationFacts": {"fact": "X {[", "args": [{"k": '"}'}, 3]}}
    models = [
        (1, json.dumps([{"id": 7, "metadata": {"handler_bindings": [{"target": "A"}, None]}}, None, "text"]), json.dumps([deep]), "[]", "p", "v"),
        (1, json.dumps([{"id": 7, "metadata": {"handler_bindings": [{"target": "A"}, None]}}, None, "text"]), json.dumps([deep]), "[]", "p", "v"),
        (2, json.dumps({"id": "o", "x": {"y": [{"args": [{"id": None}]}]}}, indent=1), None, "", "p", "v"),
        (3, "null", '"text"', "{broken", "p", "v"),
        (4, json.dumps([[{"id": "inner", "children": [{"id": "c"}]}]]), "17", json.dumps([{"id": f"e{i}"} for i in range(300)]), "p", "v"),
    ]
    df = spark.createDataFrame(models, SCHEMA)
    got = {tuple(r) for r in nested.nested_nodes(df, "model_id", COLUMNS).select("model_id", "path", "parent_path", "node_id").collect()}
    assert got == flatten(models)
    assert nested.nested_nodes(df.filter("false"), "model_id", COLUMNS).count() == 0
    t = nested.flat_table(nested.nested_nodes(df, "model_id", COLUMNS), "model_id", "codeVertices", {"id": "int"}).filter("model_id = 1").collect()
    assert [(r.path, r.id) for r in t] == [("codeVertices.0", 7)]


EXPORT = "series string, file_seq int, payload string, path string, key string, file_no int"


def rows(files):
    return [(s, q, json.dumps(p, indent=q % 2), "x", "y", 1) for s, q, p in files]


def test_layout_changes(spark):
    f = [
        ("s", 1, {"chunk_id": "a", "n": 1, "old": "v1", "o": {"p": True}, "z": None}),
        ("s", 1, {"chunk_id": "b", "n": 2, "old": "v2", "gone": 1}),
        ("s", 1, {"chunk_id": "b", "n": 2, "old": "v2", "gone": 1}),
        ("s", 4, {"n": 1.5, "chunk_id": "a", "new": "v1", "o": {"p": "t"}, "z": 1, "more": [1]}),
        ("s", 4, {"n": 2, "chunk_id": "b", "new": "v2"}),
        ("s", 5, {"chunk_id": "a", "n": None, "new": None}),
        ("t", 1, {"chunk_id": "a", "k": 1, "m": 1}),
        ("t", 1, {"chunk_id": "b", "k": 2, "m": 2}),
        ("t", 2, {"chunk_id": "a", "x": "1", "y": "1"}),
        ("t", 2, {"chunk_id": "b", "x": "2", "y": "2"}),
    ]
    df = spark.createDataFrame([*rows(f), ("s", 9, None, "x", "y", 1), ("u", 1, "[]", "x", "y", 1)], EXPORT)
    got = {tuple(r) for r in drift.layout_changes(df, "series", "file_seq", "payload").collect()}
    assert got == {
        ("s", 4, "new", "renamed", "old"), ("s", 4, "n", "retyped", ""), ("s", 4, "o.p", "retyped", ""), ("s", 4, "more", "added", ""), ("s", 4, "gone", "removed", ""),
        ("s", 5, "more", "removed", ""), ("s", 5, "o", "removed", ""), ("s", 5, "o.p", "removed", ""), ("s", 5, "z", "removed", ""),
        ("t", 2, "x", "renamed", "k"), ("t", 2, "y", "renamed", "m"), ("t", 2, "x", "retyped", ""), ("t", 2, "y", "retyped", ""),
    }
    assert drift.layout_changes(df.filter("false"), "series", "file_seq", "payload").count() == 0


def test_one_table_keeps_alternatives(spark):
    f = [("s", 1, {"a": 1, "series": "inner"}), ("s", 2, {"a": 2.5}), ("s", 3, {"a": "x", "b": {"c": 1}}), ("s", 4, {"a": None})]
    df = spark.createDataFrame([*rows(f), ("s", 5, "no json", "x", "y", 1)], EXPORT)
    out = drift.one_table(df, ["series", "file_seq"], "payload").orderBy("file_seq").collect()
    assert [r.a for r in out] == ["1", "2.5", "x", None, None]
    assert [(r.a__integer, r.a__decimal, r.a__string) for r in out] == [(1, None, None), (None, Decimal("2.5"), None), (None, None, "x"), (None, None, None), (None, None, None)]
    assert out[0].field_series == "inner" and out[2].b_c == 1 and [r.payload_problem for r in out] == [None] * 4 + ["no object"]
    assert drift.one_table(df.filter("false"), ["series"], "payload").columns == ["series", "payload_problem"]
    assert [r.n_chars for r in drift.rejected(df, ["series"], "payload").collect()] == [7]


def test_one_table_loses_no_value(spark):
    texts = ['{"i": 12345678901234567890123, "d": 0.1234567890123456789, "r": 1, "r": 2}', '{"i": 7, "d": 1.5, "x": NaN, "t": "a\tb"}', '{"old": 1, "huge": 1234567890123456789012345678901234567890123}', '{"new": 2}', '{"old": 3, "new": 4}']
    df = spark.createDataFrame(list(enumerate(texts)), "id int, payload string")
    out = drift.one_table(df, ["id"], "payload", {"old": "new"}).orderBy("id").collect()
    assert [r.i for r in out][:2] == [Decimal("12345678901234567890123"), Decimal(7)] and [r.d for r in out][:2] == [Decimal("0.1234567890123456789"), Decimal("1.5")]
    assert out[0].r == 2 and out[1].t == "a\tb" and out[1].x == "NaN" and out[2].huge == "1234567890123456789012345678901234567890123"
    assert [(r.new, r.old__old) for r in out[2:]] == [(1, None), (2, None), (4, 3)]


def test_both_readers_agree(spark):
    """Fields found in the JVM equal those found over Arrow batches."""
    texts = [json.dumps(x) for x in ({}, {"a": {"b": {"c": {"d": [1, {"e": "f"}]}}}, "x": 1.5, "y": -3, "z": None, "s": "ü\n", "t": True}, {"o": {"n": 2.25, "m": 10, "k": []}}, [1], 3)]
    df = spark.createDataFrame([(t,) for t in texts], "p string")
    for r in df.select("p", F.try_parse_json("p").alias("v")).select("p", drift.tagged_fields(F.col("v"), F.col("p")).alias("f")).collect():
        assert sorted((x.path, x.tag or "", x["value"] or "") for x in r.f) == sorted((a, b or "", c or "") for a, b, c in drift.tagged_text(r.p) or [])


def test_names_over_chains_of_renamings(spark):
    made = [("a", "b"), ("b", "c"), ("x", "y"), ("y", "x")]
    changes = spark.createDataFrame([("renamed", o, n) for o, n in made] + [("added", "", "q")], "change_kind string, old_field string, field string")
    assert drift.renamings(changes) == {"a": "c", "b": "c", "y": "x"}


def test_tags_of_numbers(spark):
    df = spark.createDataFrame([('{"i": 12345678901234567890, "d": 1.0, "e": 1e3, "b": false, "s": "1", "u": "\\u00e9", "n": null}',)], "p string")
    found = df.select(F.inline(drift.tagged_fields(F.try_parse_json("p"), F.col("p")))).collect()
    assert {r.path: r.tag for r in found} == {"i": "integer", "d": "decimal", "e": "decimal", "b": "boolean", "s": "string", "u": "string", "n": None}
    assert {r.path: r["value"] for r in found} == {"i": "12345678901234567890", "d": "1.0", "e": "1000.0", "b": "false", "s": "1", "u": "é", "n": None}


def test_nested_text_in_every_form(spark):
    """Deep nesting, repeated members, NaN, raw tabs, JSON within JSON strings; what is no JSON is reported."""
    chain = lambda k: '{"id":1,"children":[' * k + '{"id":2}' + "]}" * k
    wrapped = json.dumps(json.dumps(json.dumps([{"id": 8, "children": {"id": None}}])))
    texts = [f"[{chain(519)}]", f"[{chain(1500)}]", '[{"id":1,"x":3,"id":5}]', '[{"id":1,"a":NaN}]', '﻿[{"id":1}]', '[{"id":"a\tb"}]', wrapped, "oops", '"plain"', "null", " ", None]
    df = spark.createDataFrame(list(enumerate(texts)), "model_id long, dv string")
    rows = nested.nested_nodes(df, "model_id", {"dv": "dataVertices"}).select("model_id", "path", "parent_path", "node_id").collect()
    count = Counter(r.model_id for r in rows)
    assert count == {0: 520, 1: 1501, 2: 1, 3: 1, 4: 1, 5: 1, 6: 2}
    for i in count:
        assert {(r.path, r.parent_path, r.node_id) for r in rows if r.model_id == i} == {(p, o, n) for p, o, _, n, _ in nested.walked_text(texts[i], "dataVertices")}
    assert {r.node_id for r in rows if r.model_id == 2} == {"5"}
    assert {(r.model_id, r.reason) for r in nested.rejected(df, "model_id", {"dv": "dataVertices"}).collect()} == {(7, "malformed"), (8, "scalar")}
