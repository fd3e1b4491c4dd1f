"""Flat tables from deeply nested records of any shape.

A record's JSON is read as a variant and split once into the entries of its top-level arrays, so that a
very large record becomes many rows. Within an entry a higher-order fold walks down one object level a
step: nested transforms attach path, parent path and member name, flatten joins the arrays of a level and
the fold keeps all levels. One inline per target table then emits its rows. Nothing is limited: the fold
takes as many steps as the entry's own text has nested objects. Text that the JVM's parser refuses is
walked over Arrow batches instead; what is no JSON at all is reported by `rejected`.
"""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodegraph.functions.json import items, let, members, nesting, unquoted
from lodegraph.functions.jsontext import read, write

#: Members whose object entries are rows of the flat tables.
ENTRY_MEMBERS = ("codeVertices", "dataVertices", "edges", "children", "declarationFacts", "args", "handler_bindings")

_NODE = "struct<path:string,parent_path:string,owner:string,member:string,is_row:boolean,of:map<string,variant>,list:array<variant>>"
#: Levels walked before an entry's depth is measured; deeper entries take as many further steps as they need.
FIRST_LEVELS = 4


def _node(path: Column, parent: Column, member: Column, is_row: Column, of: Column, list_: Column) -> Column:
    """owner: the path that children of this node name as their parent. of, list: the node's members or entries."""
    return F.struct(path.alias("path"), parent.alias("parent_path"), F.when(is_row, path).otherwise(parent).alias("owner"), member.alias("member"), is_row.alias("is_row"), of.alias("of"), list_.alias("list"))


def _containers(values: Column, node: Callable[[Column, Column, Column], Column]) -> Column:
    """node(members, entries, position) of the objects and arrays among `values`; each is opened once."""
    opened = F.transform(values, lambda x, i: F.struct(members(x).alias("of"), items(x).alias("list"), i.alias("i")))
    return F.transform(F.filter(opened, lambda o: o["of"].isNotNull() | o["list"].isNotNull()), lambda o: node(o["of"], o["list"], o["i"]))


def _level(n: Column, names: tuple[str, ...]) -> Column:
    """The containers one object level below node `n`."""
    none = F.lit(None)
    empty = F.array().cast(f"array<{_NODE}>")

    def below(e: Column) -> Column:
        at = F.concat_ws(".", n["path"], e["key"])
        listed = _containers(e["list"], lambda of, lst, i: _node(F.concat_ws(".", at, i.cast("string")), n["owner"], e["key"], e["key"].isin(*names) & of.isNotNull(), of, lst))
        alone = let(e["key"].isin(*names), lambda row: _node(F.when(row, F.concat_ws(".", at, F.lit("0"))).otherwise(at), n["owner"], e["key"], row, e["of"], none.cast("array<variant>")))
        return F.when(e["of"].isNotNull(), F.array(alone)).when(e["list"].isNotNull(), listed).otherwise(empty)

    opened = F.transform(F.map_entries(n["of"]), lambda e: F.struct(e["key"].alias("key"), members(e["value"]).alias("of"), items(e["value"]).alias("list")))
    of_object = F.flatten(F.transform(F.filter(opened, lambda e: e["of"].isNotNull() | e["list"].isNotNull()), below))
    # An array right within an array: its entries lie on the path, but belong to no member.
    of_array = _containers(n["list"], lambda of, lst, i: _node(F.concat_ws(".", n["path"], i.cast("string")), n["owner"], n["member"], F.lit(False), of, lst))
    return F.when(n["of"].isNotNull(), of_object).otherwise(of_array)


def _walked(entry: Column, start: Column, names: tuple[str, ...]) -> Column:
    """Rows of an entry: a few levels at once, then as many more as its text is deep, where any are left."""

    def step(s: Column, _: Column) -> Column:
        return F.when(F.size(s["now"]) == 0, s).otherwise(let(F.flatten(F.transform(s["now"], lambda n: _level(n, names))), lambda nxt: F.struct(nxt.alias("now"), F.concat(s["all"], _rows(nxt)).alias("all"))))

    first = F.aggregate(F.sequence(F.lit(1), F.lit(FIRST_LEVELS)), F.struct(F.array(start).alias("now"), _rows(F.array(start)).alias("all")), step)
    rest = lambda s: F.aggregate(F.sequence(F.lit(1), F.greatest(nesting(F.to_json(entry)), F.lit(1))), s, step)
    return let(first, lambda s: F.when(F.size(s["now"]) == 0, s).otherwise(rest(s)))["all"]


def _rows(nodes: Column) -> Column:
    return F.transform(F.filter(nodes, lambda n: n["is_row"]), lambda n: F.struct(n["path"].alias("path"), n["parent_path"].alias("parent_path"), n["member"].alias("member"), n["of"].alias("of")))


def nested_nodes(df: DataFrame, key: str, columns: dict[str, str], names: tuple[str, ...] = ENTRY_MEMBERS) -> DataFrame:
    """(key, path, parent_path, member, node_id, of) of every object that is an entry of `names`.

    columns: JSON column -> its member name at the root. A JSON string that holds the JSON is
    read as what it holds. Null, empty and malformed columns, and columns that hold no array or object, give no rows; null entries keep their position but are no rows. Exact
    copies of a record are read once. node_id is '' where the id is missing or null."""
    texts = _texts(df, key, columns)
    roots = texts.filter("v is not null")
    entries = F.coalesce(items(F.col("v")), F.when(members(F.col("v")).isNotNull(), F.array("v")), F.array().cast("array<variant>"))
    top = roots.select("_key", "member", F.posexplode(entries).alias("pos", "v"))
    # A few records hold most entries: spread the entries, not the records.
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    top = top.filter(F.left(F.schema_of_variant("v"), F.lit(5)).isin("OBJEC", "ARRAY")).repartition(n, F.xxhash64("_key", "member", "pos"))
    path = F.concat_ws(".", "member", F.col("pos").cast("string"))
    start = let(members(F.col("v")), lambda of: _node(path, F.lit(""), F.col("member"), F.col("member").isin(*names) & of.isNotNull(), of, F.when(of.isNull(), items(F.col("v")))))
    walked = _walked(F.col("v"), start, names)
    node_id = F.coalesce(F.try_variant_get(F.col("of")["id"], "$", "string"), F.lit(""))
    found = top.select("_key", F.inline(walked)).select("_key", "path", "parent_path", "member", node_id.alias("node_id"), "of")
    return found.unionByName(_refused(texts, names)).dropDuplicates(["_key", "path", "parent_path", "node_id"]).withColumnRenamed("_key", key)


def _texts(df: DataFrame, key: str, columns: dict[str, str]) -> DataFrame:
    """(_key, member, json, v) of every distinct column text that is not blank; v is null where the JVM's parser refuses it."""
    rows = df.select(F.col(key).alias("_key"), F.explode(F.array(*[F.struct(F.lit(m).alias("member"), F.col(c).alias("json")) for c, m in columns.items()])).alias("_c"))
    texts = rows.select("_key", "_c.*").filter("json is not null and trim(json) <> ''").dropDuplicates(["_key", "member", "json"])
    return texts.withColumn("v", F.try_parse_json(unquoted(F.col("json"))))


def _refused(texts: DataFrame, names: tuple[str, ...]) -> DataFrame:
    """The rows of the texts that the JVM's parser refuses (more than 1,000 levels, repeated members, NaN,
    raw control characters), walked over Arrow batches; `of` holds a row's plain members only."""
    n = int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rest = texts.filter("v is null").select("_key", "member", "json").repartition(n)
    kind = dict(rest.dtypes)["_key"]

    def walk(batches):
        for batch in batches:
            keys, members_, texts_ = (batch.column(i).to_pylist() for i in range(3))
            rows = [(k, *row) for k, m, t in zip(keys, members_, texts_) for row in walked_text(t, m, names)]
            cols = list(zip(*rows)) if rows else [()] * 6
            yield pa.RecordBatch.from_arrays([pa.array(cols[0], batch.schema.field(0).type), *[pa.array(c, pa.string()) for c in cols[1:]]], ["_key", "path", "parent_path", "member", "node_id", "plain"])

    out = rest.mapInArrow(walk, f"_key {kind}, path string, parent_path string, member string, node_id string, plain string")
    return out.withColumn("of", members(F.try_parse_json("plain"))).drop("plain")


def walked_text(text: str, member: str, names: tuple[str, ...] = ENTRY_MEMBERS) -> list[tuple[str, str, str, str, str]]:
    """(path, parent_path, member, node_id, plain members as JSON) of one text; none where it is no JSON."""
    try:
        root = read(text)
    except ValueError:
        return []
    tops = root if isinstance(root, list) else [root] if isinstance(root, dict) else []
    todo = [(f"{member}.{i}", "", member, member in names and isinstance(x, dict), x) for i, x in enumerate(tops) if isinstance(x, (dict, list))]
    out = []
    while todo:
        path, parent, name, is_row, v = todo.pop()
        if isinstance(v, list):
            todo += [(f"{path}.{i}", parent, name, False, x) for i, x in enumerate(v) if isinstance(x, (dict, list))]
            continue
        owner = path if is_row else parent
        if is_row:
            i = v.get("id")
            node_id = "" if i is None else str(i) if isinstance(i, str) else write(i)
            out.append((path, parent, name, node_id, write({k: x for k, x in v.items() if not isinstance(x, (dict, list)) and x not in ("NaN", "Infinity", "-Infinity")})))
        for k, e in v.items():
            if isinstance(e, dict):
                todo.append((f"{path}.{k}.0", owner, k, True, e) if k in names else (f"{path}.{k}", owner, k, False, e))
            elif isinstance(e, list):
                todo += [(f"{path}.{k}.{i}", owner, k, k in names and isinstance(x, dict), x) for i, x in enumerate(e) if isinstance(x, (dict, list))]
    return out


def rejected(df: DataFrame, key: str, columns: dict[str, str]) -> DataFrame:
    """(key, member, n_chars, reason) of column texts that give no rows because they are no JSON ('malformed')
    or JSON of another shape than an array or object ('scalar'; JSON null is no reject)."""
    texts = _texts(df, key, columns)
    odd = texts.filter("v is null or (not is_variant_null(v) and try_variant_get(v, '$', 'map<string,variant>') is null and try_variant_get(v, '$', 'array<variant>') is null)")
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rest = odd.select("_key", "member", "json", F.lit("").alias("reason")).repartition(n)

    def judge(batches):
        for batch in batches:
            reasons = [reason(t) for t in batch.column(2).to_pylist()]
            marked = batch.set_column(3, "reason", pa.array(reasons, pa.string()))
            yield marked.filter(pa.array([r is not None for r in reasons], pa.bool_()))

    return rest.mapInArrow(judge, rest.schema).select(F.col("_key").alias(key), "member", F.length("json").alias("n_chars"), "reason")


def reason(text: str) -> str | None:
    """Why a text gives no rows: 'malformed', 'scalar', or None where it is an array, an object or null."""
    try:
        value = read(text)
    except ValueError:
        return "malformed"
    return None if value is None or isinstance(value, (dict, list)) else "scalar"


def flat_table(nodes: DataFrame, key: str, member: str | list[str], fields: dict[str, str]) -> DataFrame:
    """One flat table: the entries of `member` with the named fields as typed columns.

    A value that does not fit its type is null."""
    ms = [member] if isinstance(member, str) else member
    return nodes.filter(F.col("member").isin(*ms)).select(key, "path", "parent_path", "node_id", *[F.try_variant_get(F.col("of")[f], "$", t).alias(f.lower()) for f, t in fields.items()])
