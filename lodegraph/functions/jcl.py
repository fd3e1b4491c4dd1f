"""JCL: logical statements of a job and parsers of their operands, as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: What a disposition says about the access.
ACCESS = {"SHR": "read", "OLD": "read", "NEW": "write", "MOD": "append", "PASS": "pass"}
#: Comparison a COND operator is rendered with (the test as written, not negated).
OPERATORS = {"LT": ">=", "LE": ">", "GT": "<=", "GE": "<", "EQ": "!=", "NE": "="}


def statements(df: DataFrame, key: str, text: str) -> DataFrame:
    """(key, line_no, kind, name, operation, operand): logical records of JCL text.

    kind: comment, statement, data, delimiter. Columns 73 on are dropped; a statement whose operand ends
    with a comma takes in the operands of the lines that go on. Lines are numbered within their text, so
    continuation is a running sum over the lines of one text."""
    lines = df.filter(F.col(text).isNotNull()).select(key, F.posexplode(F.split(text, r"\r?\n")).alias("line_no", "line"))
    cut = F.regexp_replace(F.substring("line", 1, 72), r"\s+$", "")
    kind = F.when(F.startswith(cut, F.lit("//*")), "comment").when(F.startswith(cut, F.lit("/*")), "delimiter").when(F.startswith(cut, F.lit("//")), "statement").otherwise("data")
    lines = lines.select(key, (F.col("line_no") + 1).alias("line_no"), cut.alias("line"), kind.alias("kind")).filter("line <> ''")
    w = Window.partitionBy(key, "kind").orderBy("line_no")
    goes_on = (F.col("kind") == "statement") & F.col("line").rlike(r"^//\s{1,}\S") & F.coalesce(F.lag("line").over(w).rlike(r",$"), F.lit(False))
    lines = lines.withColumn("_goes", goes_on)
    lines = lines.withColumn("_no", F.max(F.when(~F.col("_goes"), F.col("line_no"))).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    joined = lines.groupBy(key, "kind", "_no").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("line_no", "line", "_goes"))), lambda x: F.when(x["_goes"], F.trim(F.substring(x["line"], 3, 70))).otherwise(x["line"])), "").alias("line"))
    part = lambda g: F.nullif(F.regexp_extract("line", r"^//(\S*)\s+(\S+)\s*(.*)$", g), F.lit(""))
    is_st = F.col("kind") == "statement"
    return joined.select(key, F.col("_no").alias("line_no"), "kind", F.when(is_st, part(1)).alias("name"), F.when(is_st, part(2)).alias("operation"), F.when(is_st, part(3)).otherwise(F.col("line")).alias("operand"))


def split_operand(c: Column) -> Column:
    """array<string> of an operand's parts: commas within parentheses or quotes do not split."""
    step = lambda s, ch: F.struct(
        F.when((ch == ",") & (s["depth"] == 0) & ~s["quoted"], F.concat(s["done"], F.array(s["now"]))).otherwise(s["done"]).alias("done"),
        F.when((ch == ",") & (s["depth"] == 0) & ~s["quoted"], F.lit("")).otherwise(F.concat(s["now"], ch)).alias("now"),
        (s["depth"] + F.when(~s["quoted"] & (ch == "("), 1).when(~s["quoted"] & (ch == ")"), -1).otherwise(0)).alias("depth"),
        F.when(ch == "'", ~s["quoted"]).otherwise(s["quoted"]).alias("quoted"),
    )
    start = F.struct(F.array().cast("array<string>").alias("done"), F.lit("").alias("now"), F.lit(0).alias("depth"), F.lit(False).alias("quoted"))
    return F.when(F.length(c) > 0, F.aggregate(F.filter(F.split(c, ""), lambda x: x != ""), start, step, lambda s: F.concat(s["done"], F.array(s["now"]))))


def operands(c: Column) -> Column:
    """map<string,string> of keyword operands; positional ones under their number from 1."""
    parts = split_operand(c)
    entry = lambda p, i: F.when(p.rlike(r"^[A-Z0-9@#$.]+="), F.struct(F.substring_index(p, "=", 1).alias("k"), F.regexp_replace(p, r"^[^=]*=", "").alias("v"))).otherwise(F.struct((i + 1).cast("string").alias("k"), p.alias("v")))
    pairs = F.transform(parts, entry)
    return F.map_from_arrays(F.transform(pairs, lambda x: x["k"]), F.transform(pairs, lambda x: x["v"]))


def dsn(c: Column) -> Column:
    """struct<kind,base,member>: nullfile, temporary, generation, member, plain."""
    inner = F.regexp_extract(c, r"\(([^)]*)\)$", 1)
    kind = F.when(F.upper(c) == "NULLFILE", "nullfile").when(F.startswith(c, F.lit("&&")), "temporary").when(inner.rlike(r"^[+-]?\d+$"), "generation").when(inner != "", "member").otherwise("plain")
    return F.struct(kind.alias("kind"), F.regexp_replace(c, r"\([^)]*\)$", "").alias("base"), F.nullif(inner, F.lit("")).alias("member"))


def disp(c: Column) -> Column:
    """struct<status,normal,abnormal,access>; parts that are left out are null, access is special without a status."""
    p = F.split(F.regexp_replace(F.trim(c), r"[()]", ""), ",")
    part = lambda n: F.nullif(F.upper(F.trim(F.try_element_at(p, F.lit(n)))), F.lit(""))
    access = F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for kv in ACCESS.items() for x in kv]), part(1)), F.lit("special"))
    return F.struct(part(1).alias("status"), part(2).alias("normal"), part(3).alias("abnormal"), access.alias("access"))


def _inner(c: Column) -> Column:
    """An operand without the parentheses around all of it."""
    return F.regexp_replace(F.trim(c), r"^\((.*)\)$", "$1")


def dcb(c: Column) -> Column:
    """struct<backreference,parameters>: *.NAME, or a map of sub-parameters in lower case; one without = is under '1'."""
    back = F.nullif(F.regexp_extract(F.trim(c), r"^\(?\*\.([A-Za-z0-9.]+)\)?$", 1), F.lit(""))
    keyed = operands(_inner(c))
    lower = F.transform_keys(keyed, lambda k, v: F.lower(k))
    return F.struct(back.alias("backreference"), F.when(back.isNull(), lower).alias("parameters"))


def vol(c: Column) -> Column:
    """struct<ser,ref,is_private,is_retained>: serial numbers of volumes, or the DD whose volumes are meant."""
    t = F.trim(c)
    ref = F.nullif(F.regexp_extract(t, r"(?i)^\(?(?:.*,)?REF=\*\.([^,)]+)", 1), F.lit(""))
    one = F.regexp_extract(t, r"(?i)SER=(\([^)]*\)|[^,)]+)", 1)
    ser = F.when(one != "", F.transform(F.split(_inner(one), ","), lambda x: F.trim(x)))
    word = lambda w: F.array_contains(F.transform(F.split(_inner(F.upper(t)), ","), lambda x: F.trim(x)), w)
    return F.struct(ser.alias("ser"), ref.alias("ref"), word("PRIVATE").alias("is_private"), word("RETAIN").alias("is_retained"))


def space(c: Column) -> Column:
    """struct<unit,primary,secondary,rlse,contig,round>."""
    parts = split_operand(_inner(c))
    amounts = F.split(_inner(F.try_element_at(parts, F.lit(2))), ",")
    amount = lambda n: F.nullif(F.trim(F.try_element_at(amounts, F.lit(n))), F.lit(""))
    flag = lambda w: F.coalesce(F.array_contains(F.transform(F.slice(parts, 3, 9), lambda x: F.upper(F.trim(x))), w), F.lit(False))
    return F.struct(F.try_element_at(parts, F.lit(1)).alias("unit"), amount(1).alias("primary"), amount(2).alias("secondary"), flag("RLSE").alias("rlse"), flag("CONTIG").alias("contig"), flag("ROUND").alias("round"))


def cond(c: Column) -> Column:
    """struct<value,modifier>: EVEN or ONLY apart from the tests."""
    t = F.trim(c)
    modifier = F.nullif(F.upper(F.regexp_extract(t, r"(?i)(?:^|,)(EVEN|ONLY)\)?$", 1)), F.lit(""))
    return F.struct(F.nullif(F.regexp_replace(t, r"(?i)(?:^|,)(EVEN|ONLY)(?=\)?$)", ""), F.lit("")).alias("value"), modifier.alias("modifier"))


def output_references(c: Column) -> Column:
    """array<string> of the OUTPUT statements that a DD refers to."""
    return F.transform(F.regexp_extract_all(c, F.lit(r"\*\.([A-Za-z0-9.@#$]+)"), F.lit(1)), lambda x: F.upper(x))


#: What the DD names of the system stand for.
DD_ROLES = {
    "JOBLIB": "library_override", "STEPLIB": "library_override", "SYSIN": "program_input", "SYSPRINT": "system_print", "SYSOUT": "system_output",
    "SYSERR": "system_error", "SYSUDUMP": "diagnostic_dump", "SYSABEND": "diagnostic_dump",
}


def dd_fields(name: Column, operand: Column) -> Column:
    """struct of a DD statement: role, dsn, disp, dcb, vol, space, sysout, outputs."""
    o = operands(operand)
    at = lambda k: F.try_element_at(o, F.lit(k))
    role = F.try_element_at(F.create_map(*[F.lit(x) for kv in DD_ROLES.items() for x in kv]), F.upper(name))
    has = lambda k, f: F.when(at(k).isNotNull(), f(at(k)))
    data_set = F.coalesce(at("DSN"), at("DSNAME"))
    return F.struct(
        role.alias("role"), F.when(data_set.isNotNull(), dsn(F.regexp_replace(data_set, "'", ""))).alias("dsn"), has("DISP", disp).alias("disp"), has("DCB", dcb).alias("dcb"),
        F.when(F.coalesce(at("VOL"), at("VOLUME")).isNotNull(), vol(F.coalesce(at("VOL"), at("VOLUME")))).alias("vol"), has("SPACE", space).alias("space"), at("SYSOUT").alias("sysout"), F.coalesce(has("OUTPUT", output_references), F.array().cast("array<string>")).alias("outputs"),
    )


def cond_text(c: Column) -> Column:
    """What a COND operand says in words; the operator is rendered as it stands, code against return code."""
    one = r"\(?(\d+),([A-Z]{2})(?:,([A-Z0-9.]+))?\)?"
    ops = F.create_map(*[F.lit(x) for kv in OPERATORS.items() for x in kv])
    code, op, step = (F.regexp_extract(c, one, g) for g in (1, 2, 3))
    said = F.concat(F.lit("runs only if "), F.when(step == "", "RC").otherwise(F.concat(F.lit("RC of "), step)), F.lit(" "), F.try_element_at(ops, op), F.lit(" "), code)
    return F.when(F.upper(c) == "EVEN", "runs even after an abend").when(F.upper(c) == "ONLY", "runs only after an abend").otherwise(said)


def substitute(c: Column, symbols: dict[str, str]) -> Column:
    """Symbols &NAME. and &NAME replaced, longer names first; others stay."""
    out = c
    for k in sorted(symbols, key=len, reverse=True):
        out = F.regexp_replace(out, rf"&{k}\.?(?![A-Z0-9])|&{k}\.", symbols[k])
    return out


def unresolved(c: Column) -> Column:
    return F.array_sort(F.array_distinct(F.regexp_extract_all(c, F.lit(r"(?<!&)&([A-Z][A-Z0-9]*)"), F.lit(1))))
