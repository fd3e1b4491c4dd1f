"""Schemas that drift between files: tagged-union inference over JSON records.

Every record becomes tagged fields (path, tag, value), found in the JVM by a fold over the object levels
of its variant; records that the JVM's parser refuses are read over Arrow batches. The tags of a field are
fused per file, keeping the alternatives side by side, and the fused layouts of consecutive files of a
series are compared. Reading everything into one table gives a column per path: where alternatives of a
path disagree, a typed branch for each and one canonical column; names that a field had before it was
renamed share its column.
"""

from __future__ import annotations

from decimal import Decimal

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodegraph.functions.json import let, members, nesting, unquoted
from lodegraph.functions.jsontext import Number, read, write
from lodegraph.session import cut

_FIELD = "struct<path:string,tag:string,value:string>"
#: Levels opened before a record's depth is measured; deeper records take as many more steps as they need.
FIRST_LEVELS = 2
#: Characters up to which a value is compared as it is; of longer ones a digest is kept.
PLAIN_VALUE = 64


def tagged_fields(v: Column, text: Column) -> Column:
    """array<struct<path,tag,value>> of a JSON object's members, those of objects in it dotted.

    v: the record as a variant, text: its JSON. Tags: string, boolean, integer (no fraction or exponent),
    decimal, array, object; null for JSON null. Strings come as they are, objects and arrays as JSON with
    sorted members, decimals with at least one digit behind the point. Anything but an object has no
    fields. Arrays are not entered."""
    numbers = lambda kind: F.contains(kind, F.lit("DECIMAL")) | F.contains(kind, F.lit("DOUBLE"))

    def opened(n: Column) -> Column:
        entries = F.transform(F.map_entries(n["of"]), lambda e: F.struct(e["key"].alias("key"), e["value"].alias("v"), F.schema_of_variant(e["value"]).alias("kind")))
        # Whether a number has a fraction or exponent is seen in the text only; it is read where there are such numbers.
        return let(entries, lambda es: let(F.when(F.exists(es, lambda e: numbers(e["kind"])), F.from_json(n["raw"], "map<string,string>")), lambda raw: F.transform(es, lambda e: fielded(n, e, F.when(numbers(e["kind"]), raw[e["key"]])))))

    def fielded(n: Column, e: Column, raw: Column) -> Column:
        kind, at = e["kind"], F.when(n["path"] == "", e["key"]).otherwise(F.concat_ws(".", n["path"], e["key"]))
        said = F.try_variant_get(e["v"], "$", "string")
        is_object, is_array = F.startswith(kind, F.lit("OBJECT")), F.startswith(kind, F.lit("ARRAY"))
        number = F.when(raw.rlike("[.eE]"), F.when(said.rlike("[.eE]"), said).otherwise(F.concat(said, F.lit(".0")))).otherwise(raw)
        tag = F.when(kind == "STRING", "string").when(kind == "BIGINT", "integer").when(kind == "BOOLEAN", "boolean").when(kind == "VOID", None).when(is_object, "object").when(is_array, "array").when(raw.rlike("[.eE]"), "decimal").otherwise("integer")
        value = F.when(is_object | is_array, F.to_json(e["v"])).when(kind == "VOID", None).when(kind.isin("STRING", "BIGINT", "BOOLEAN"), said).otherwise(number)
        return F.struct(F.struct(at.alias("path"), tag.alias("tag"), value.alias("value")).alias("field"), F.when(is_object, F.struct(at.alias("path"), members(e["v"]).alias("of"), raw.alias("raw"))).alias("node"))

    def step(s: Column, _: Column) -> Column:
        return F.when(F.size(s["now"]) == 0, s).otherwise(
            let(F.flatten(F.transform(s["now"], opened)), lambda found: F.struct(F.filter(F.transform(found, lambda f: f["node"]), lambda n: n.isNotNull()).alias("now"), F.concat(s["all"], F.transform(found, lambda f: f["field"])).alias("all")))
        )

    root = let(members(v), lambda of: F.filter(F.array(F.struct(F.lit("").alias("path"), of.alias("of"), text.alias("raw"))), lambda n: n["of"].isNotNull()))
    first = F.aggregate(F.sequence(F.lit(1), F.lit(FIRST_LEVELS)), F.struct(root.alias("now"), F.array().cast(f"array<{_FIELD}>").alias("all")), step)
    return let(first, lambda s: F.when(F.size(s["now"]) == 0, s).otherwise(F.aggregate(F.sequence(F.lit(1), F.greatest(nesting(text), F.lit(1))), s, step)))["all"]


def tagged_text(text: str) -> list[tuple[str, str | None, str | None]] | None:
    """The fields of one record's text as `tagged_fields` gives them; None where it is no JSON object."""
    try:
        root = read(text)
    except ValueError:
        return None
    if not isinstance(root, dict):
        return None
    out, todo = [], [("", root)]
    while todo:
        path, of = todo.pop()
        for k, x in of.items():
            at = f"{path}.{k}" if path else k
            if isinstance(x, (dict, list)):
                out.append((at, "object" if isinstance(x, dict) else "array", write(x)))
                if isinstance(x, dict):
                    todo.append((at, x))
            elif x is None or isinstance(x, bool):
                out.append((at, None if x is None else "boolean", None if x is None else str(x).lower()))
            elif not isinstance(x, Number) or not x[-1].isdigit():  # NaN and infinities are kept as text
                out.append((at, "string", str(x)))
            elif any(c in x for c in ".eE"):
                exact = f"{Decimal(x).normalize():f}" if "e" not in x.lower() else str(float(x))
                out.append((at, "decimal", exact if any(c in exact for c in ".en") else f"{exact}.0"))
            else:
                out.append((at, "integer", str(int(x))))
    return out


def read_records(records: DataFrame, payload: str, keep: list[Column]) -> DataFrame:
    """`keep` and fields: the tagged fields of every record; null where its payload is no JSON object.

    The JVM reads all it can. Repeated members (the last counts), NaN, raw control characters and nesting
    beyond its parser's limit are read over Arrow batches."""
    parsed = records.select(*keep, F.col(payload).alias("_text")).withColumn("_v", F.try_parse_json(unquoted(F.col("_text"))))
    names = [c for c in parsed.columns if c not in ("_text", "_v")]
    ours = parsed.filter("_v is not null or _text is null").select(*names, F.when(members(F.col("_v")).isNotNull(), tagged_fields(F.col("_v"), unquoted(F.col("_text")))).alias("fields"))
    n = int(records.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rest = parsed.filter("_v is null and _text is not null").select(*names, "_text").repartition(n)
    kind = pa.list_(pa.struct([("path", pa.string()), ("tag", pa.string()), ("value", pa.string())]))

    def run(batches):
        for batch in batches:
            fields = [tagged_text(t) for t in batch.column(len(names)).to_pylist()]
            rows = [None if f is None else [dict(zip(("path", "tag", "value"), x)) for x in f] for f in fields]
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(len(names))), pa.array(rows, kind)], [*names, "fields"])

    schema = ", ".join(f"`{c}` {t}" for c, t in rest.dtypes if c != "_text")
    return ours.unionByName(rest.mapInArrow(run, f"{schema}, fields array<{_FIELD}>"))


#: The alternatives of a field, a bit each in this order.
TAGS = ("array", "boolean", "decimal", "integer", "object", "string")


def fused(tags: Column) -> Column:
    """One type of a set of tags: integer and decimal are decimal, any other mixture is string."""
    return F.when(F.size(tags) == 0, F.lit(None)).when(F.size(tags) == 1, tags[0]).when(F.size(F.array_except(tags, F.array(F.lit("integer"), F.lit("decimal")))) == 0, "decimal").otherwise("string")


def layouts(fields: DataFrame) -> DataFrame:
    """(series, file_seq, file_no, path, tags, type): the fused layout of every file.

    fields: series, file_seq, path, tag. file_no numbers a series' files without gaps. A field that is
    only null in a file keeps the type it had in the file before. Alternatives are fused as bits, by
    partial aggregates before the shuffle."""
    bit = F.lit(0)
    for i, t in enumerate(TAGS):
        bit = F.when(F.col("tag") == t, 1 << i).otherwise(bit)
    tags = F.filter(F.array(*[F.when(F.col("_bits").bitwiseAND(1 << i) > 0, t) for i, t in enumerate(TAGS)]), lambda t: t.isNotNull())
    per = fields.groupBy("series", "file_seq", "path").agg(F.bit_or(bit).alias("_bits")).withColumn("tags", tags).drop("_bits").withColumn("own", fused(F.col("tags")))
    files = per.select("series", "file_seq").distinct()
    files = files.withColumns({"file_no": F.row_number().over(Window.partitionBy("series").orderBy("file_seq")), "n_files": F.count(F.lit(1)).over(Window.partitionBy("series"))})
    line = Window.partitionBy("series", "path").orderBy("file_no")
    run = Window.partitionBy("series", "path", "run").orderBy("file_no").rowsBetween(Window.unboundedPreceding, 0)
    return (
        per.join(files, ["series", "file_seq"])
        .withColumn("run", F.col("file_no") - F.row_number().over(line))
        .withColumn("type", F.last("own", ignorenulls=True).over(run))
        .withColumns({"is_new": (F.col("file_no") > 1) & (F.coalesce(F.lag("file_no").over(line), F.lit(0)) < F.col("file_no") - 1), "is_last": (F.col("file_no") < F.col("n_files")) & (F.coalesce(F.lead("file_no").over(line), F.lit(0)) != F.col("file_no") + 1), "had": F.when(F.lag("file_no").over(line) == F.col("file_no") - 1, F.lag("type").over(line))})
        .select("series", "file_seq", "file_no", "path", "tags", "type", "had", "is_new", "is_last")
    )


def layout_changes(records: DataFrame, series: str, file_seq: str, payload: str, key: str = "chunk_id") -> DataFrame:
    """(series, file_seq, field, change_kind, old_field) between consecutive files of a series.

    renamed: a lost and a new field whose values agree for all keys in both files where neither is null,
    at least two; lost fields in alphabetical order take the first free one. Then added and removed, and
    retyped where both types are known and differ. Records whose payload is no object count for nothing
    (`rejected` lists them); repeated records change nothing. The values of a key are paired only between the lost and the new
    fields of one change of files, which is bounded by the number of fields."""
    short = lambda x: F.when(F.length(x) <= PLAIN_VALUE, x).otherwise(F.concat(F.lit("sha2:"), F.sha2(x, 256)))
    read_ = read_records(records, payload, [F.col(series).alias("series"), F.col(file_seq).alias("file_seq")])
    # Every record is parsed once: what is kept of it is read for the layouts and for the values.
    kept = cut(read_.select("series", "file_seq", F.filter("fields", lambda f: f["path"] == key)[0]["value"].alias("key"), F.transform("fields", lambda f: F.struct(f["path"].alias("path"), f["tag"].alias("tag"), short(f["value"]).alias("value"))).alias("fields")))
    lay = cut(layouts(kept.select("series", "file_seq", F.inline(F.transform("fields", lambda f: F.struct(f["path"].alias("path"), f["tag"].alias("tag")))))))
    files = lay.select("series", "file_no", "file_seq").distinct()
    new = lay.filter("is_new").select("series", "file_seq", "file_no", "path", "type")
    lost = lay.filter("is_last").select("series", F.col("file_seq").alias("seq_before"), (F.col("file_no") + 1).alias("file_no"), "path", "type")
    marks = new.select("series", "file_seq", "file_no", "path", F.lit("new").alias("side")).unionByName(lost.select("series", F.col("seq_before").alias("file_seq"), "file_no", "path", F.lit("lost").alias("side")))
    # Only a change with both lost and new fields can be a renaming; a file takes part in two changes at most.
    both = marks.groupBy("series", "file_no").agg(F.count_distinct("side").alias("n")).filter("n = 2").select("series", "file_no")
    wanted = marks.join(both, ["series", "file_no"], "left_semi").groupBy("series", "file_seq").agg(F.collect_list(F.struct("file_no", "path", "side")).alias("marks"))
    side = lambda name: F.collect_set(F.when(F.col("side") == name, F.struct("path", "value")))
    pair = lambda x, y: F.struct(x["path"].alias("old_field"), y["path"].alias("field"), (x["value"] == y["value"]).alias("same"))
    named = F.filter("fields", lambda f: f["value"].isNotNull() & F.exists("marks", lambda m: m["path"] == f["path"]))
    sided = lambda f: F.transform(F.filter("marks", lambda m: m["path"] == f["path"]), lambda m: F.struct(m["file_no"].alias("file_no"), m["side"].alias("side"), f["path"].alias("path"), f["value"].alias("value")))
    fits = (
        kept.filter("key is not null")
        .join(wanted, ["series", "file_seq"])
        .select("series", "key", F.inline(F.flatten(F.transform(named, sided))))
        .groupBy("series", "file_no", "key")
        .agg(side("lost").alias("a"), side("new").alias("b"))
        .select("series", "file_no", "key", F.inline(F.flatten(F.transform("a", lambda x: F.transform("b", lambda y: pair(x, y))))))
        .groupBy("series", "file_no", "old_field", "field")
        .agg(F.bool_and("same").alias("same"), F.count_distinct("key").alias("n"))
        .filter("same and n >= 2")
    )
    pairs = F.sort_array(F.collect_list(F.struct("old_field", "field")))
    taken = F.aggregate(
        pairs,
        F.array().cast("array<struct<old_field:string,field:string>>"),
        lambda s, p: F.when(F.exists(s, lambda t: (t["old_field"] == p["old_field"]) | (t["field"] == p["field"])), s).otherwise(F.concat(s, F.array(p))),
    )
    renamed = cut(fits.groupBy("series", "file_no").agg(taken.alias("p")).select("series", "file_no", F.inline("p")))
    added = new.join(renamed, [new.series == renamed.series, new.file_no == renamed.file_no, new.path == renamed.field], "left_anti")
    removed = lost.join(renamed, [lost.series == renamed.series, lost.file_no == renamed.file_no, lost.path == renamed.old_field], "left_anti")
    change = lambda df, kind, field="path", old=F.lit(""): df.select("series", "file_no", F.col(field).alias("field"), F.lit(kind).alias("change_kind"), old.alias("old_field"))
    moved = (
        renamed.join(new.select("series", "file_no", F.col("path").alias("field"), "type"), ["series", "file_no", "field"])
        .join(lost.select("series", "file_no", F.col("path").alias("old_field"), F.col("type").alias("had")), ["series", "file_no", "old_field"])
        .select("series", "file_no", F.col("field").alias("path"), "type", "had")
    )
    stayed = lay.filter("not is_new and file_no > 1").select("series", "file_no", "path", "type", "had")
    retyped = stayed.unionByName(moved).filter("type <> had")
    out = change(renamed, "renamed", "field", F.col("old_field")).unionByName(change(added, "added")).unionByName(change(removed, "removed")).unionByName(change(retyped, "retyped"))
    return out.join(files, ["series", "file_no"]).select("series", "file_seq", "field", "change_kind", "old_field")


def rejected(records: DataFrame, keep: list[str], payload: str) -> DataFrame:
    """`keep` and n_chars of the records whose payload is no JSON object; a null payload counts too."""
    return read_records(records, payload, [*[F.col(k) for k in keep], F.length(payload).alias("n_chars")]).filter("fields is null").drop("fields")


def union_schema(fields: DataFrame) -> list[tuple[str, list[str], int, int]]:
    """(path, tags, digits, scale) of all records, fused in parallel; as large as the set of field names.

    digits before and scale behind the point that hold every number of the path exactly.
    fields: path, tag, value of every record."""
    number = F.col("tag").isin("integer", "decimal")
    part = lambda pattern: F.when(number, F.length(F.regexp_extract("value", pattern, 1))).otherwise(0)
    power = F.when(number, F.coalesce(F.regexp_extract("value", r"[eE]([+-]?\d+)", 1).try_cast("int"), F.lit(0))).otherwise(0)
    sized = fields.select("path", "tag", F.greatest(part(r"^-?(\d+)") + power, F.lit(1)).alias("digits"), F.greatest(part(r"\.(\d+)") - power, F.lit(0)).alias("scale"))
    found = sized.groupBy("path").agg(F.sort_array(F.collect_set("tag")).alias("tags"), F.max("digits").alias("digits"), F.max("scale").alias("scale"))
    return sorted((r.path, list(r.tags), r.digits, r.scale) for r in found.collect())


def renamings(changes: DataFrame) -> dict[str, str]:
    """Old field name -> name it has now, over chains of renamings; as large as the set of field names.

    Of names that stand for one another the one that is no old name anywhere is kept, the first of several."""
    pairs = [(r.old_field, r.field) for r in changes.filter("change_kind = 'renamed'").select("old_field", "field").distinct().collect()]
    head: dict[str, str] = {}

    def find(x: str) -> str:
        while head.get(x, x) != x:
            x = head[x]
        return x

    for a, b in sorted(pairs):
        head[find(a)] = find(b)
    groups: dict[str, list[str]] = {}
    for x in sorted({x for p in pairs for x in p}):
        groups.setdefault(find(x), []).append(x)
    old = {a for a, _ in pairs}
    keep = {root: min((x for x in names if x not in old), default=min(names)) for root, names in groups.items()}
    return {x: keep[root] for root, names in groups.items() for x in names if x != keep[root]}


def _type(tag: str, digits: int, scale: int) -> str:
    """A type that holds every value of the tag exactly."""
    if tag == "integer":
        return "bigint" if digits <= 18 else f"decimal({digits},0)" if digits <= 38 else "string"
    if tag == "decimal":
        return f"decimal({min(38, max(digits + scale, 18))},{scale})" if digits + scale <= 38 else "string"
    return "boolean" if tag == "boolean" else "string"


def one_table(records: DataFrame, keep: list[str], payload: str, synonyms: dict[str, str] | None = None) -> DataFrame:
    """All records under one set of columns and types, no value lost.

    A path of one type is one column. A path with several has a canonical column (decimal for integer and
    decimal, else string) and a typed branch `path__tag` for each alternative, filled only where a record
    has that type. Numbers have a type that holds all of them exactly, else they are text. synonyms: old
    names whose values stand in the column of the name they have now; a record that has both keeps the old
    one's value in `old__path`. `payload_problem` is 'no object' for records without fields, which stay
    rows. Columns of `keep` come first; a field of the same name gets the prefix `field_`."""
    synonyms = synonyms or {}
    read_ = cut(read_records(records, payload, [F.col(k) for k in keep]))
    alias = F.create_map(*[F.lit(x) for kv in synonyms.items() for x in kv]) if synonyms else None

    def path_of(p: Column) -> Column:
        return p if alias is None else F.coalesce(F.try_element_at(alias, p), p)

    names_in = F.transform("fields", lambda f: f["path"])
    clash = lambda f: (path_of(f["path"]) != f["path"]) & F.array_contains(names_in, path_of(f["path"]))
    renamed = F.transform("fields", lambda f: F.struct(F.when(clash(f), F.concat(F.lit("old__"), f["path"])).otherwise(path_of(f["path"])).alias("path"), f["tag"].alias("tag"), f["value"].alias("value")))
    base = read_ if alias is None else read_.withColumn("fields", renamed)
    schema = union_schema(base.select(F.inline("fields")))
    names = {k.lower() for k in keep} | {"payload_problem"}
    # Two old names of one field in one record: the first stands for both.
    firsts = F.transform(F.array_distinct(F.transform("fields", lambda f: f["path"])), lambda p: F.filter("fields", lambda f: f["path"] == p)[0])
    fields = "fields" if alias is None else firsts
    m = F.map_from_entries(F.transform(fields, lambda f: F.struct(f["path"], F.struct(f["tag"].alias("tag"), f["value"].alias("value")))))
    base = base.withColumn("_m", m)
    cols: list[Column] = []
    for path, tags, digits, scale in schema:
        x = F.col("_m")[path]
        name = path.replace(".", "_")
        while name.lower() in names:
            name = "field_" + name
        names.add(name.lower())
        kind = (tags[0] if len(tags) == 1 else "decimal" if set(tags) <= {"integer", "decimal"} else "string") if tags else "string"
        cols.append(x["value"].try_cast(_type(kind, digits, scale)).alias(name))
        if len(tags) > 1:
            cols += [F.when(x["tag"] == t, x["value"]).try_cast(_type(t, digits, scale)).alias(f"{name}__{t}") for t in tags]
    return base.select(*keep, F.when(F.col("fields").isNull(), "no object").alias("payload_problem"), *cols)
