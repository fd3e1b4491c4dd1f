"""EXEC CICS statements in source text: arguments, operations, resources and error handlers, as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: What kind of resource an argument names, and what an operation does.
RESOURCES = {"FILE": "FILE", "DATASET": "DATASET", "QUEUE": "QUEUE", "QNAME": "QUEUE", "MAP": "MAP", "MAPSET": "MAPSET", "TRANSID": "TRANSID"}
OPERATIONS = {
    "LINK": "program_transfer", "XCTL": "program_transfer", "RETURN": "program_transfer", "START": "transaction_start", "READ": "file_read", "READQ": "queue_read",
    "STARTBR": "browse", "READNEXT": "browse", "READPREV": "browse", "ENDBR": "browse", "RESETBR": "browse", "WRITE": "file_write", "REWRITE": "file_write",
    "WRITEQ": "queue_write", "DELETE": "file_delete", "DELETEQ": "queue_delete",
}
FILES_WRITTEN, FILES_BROWSED = ("WRITE", "REWRITE", "DELETE"), ("STARTBR", "READNEXT", "READPREV", "ENDBR")

_ARGUMENT = r"(?i)\b([A-Z][A-Z0-9-]*)\s*\(([^)]*)\)"


def _of(names: dict[str, str], c: Column) -> Column:
    return F.try_element_at(F.create_map(*[F.lit(x) for kv in names.items() for x in kv]), c)


def statements(text: Column) -> Column:
    """array<struct<line,active,text>> of the statements of a source text; those in comments are inactive.

    A statement ends with END-EXEC, with the next one, and in comments with a line that ends in a point.
    Its white space is collapsed. Null text has none."""
    lines = F.transform(F.split(text, r"\r?\n"), lambda l, i: F.struct((i + 1).alias("no"), l.alias("line"), F.coalesce(l.rlike(r"^.{6}[*/]|^\s*\*>"), F.lit(False)).alias("is_comment")))

    def found(active: bool) -> Column:
        body = lambda x: F.when(x["is_comment"] != F.lit(active), F.regexp_replace(x["line"], r"^(.{6}[*/]|\d{6}|\s*\*>)", " ")).otherwise("")
        marked = F.transform(lines, lambda x: F.regexp_replace(body(x), F.lit(r"(?i)\bEXEC\s+CICS\b"), F.concat(F.lit("\u0001"), x["no"].cast("string"), F.lit("\u0002"))))
        joined = F.array_join(marked, "\n")
        pattern = F.lit("(?is)\u0001(\\d+)\u0002(.*?)(?:\\bEND-EXEC\\b|(?=\u0001)|$)" if active else "(?is)\u0001(\\d+)\u0002(.*?)(?:\\bEND-EXEC\\b|(?=\u0001)|\\.\\s*(?:\n|$)|$)")
        clean = lambda s: F.trim(F.regexp_replace(s, r"\s+", " "))
        return F.zip_with(F.regexp_extract_all(joined, pattern, F.lit(1)), F.regexp_extract_all(joined, pattern, F.lit(2)), lambda n, s: F.struct(n.cast("int").alias("line"), F.lit(active).alias("active"), F.concat(F.lit("EXEC CICS "), clean(s)).alias("text")))

    return F.when(text.isNotNull(), F.concat(found(True), found(False)))


def command(statement: Column) -> Column:
    return F.nullif(F.upper(F.regexp_extract(statement, r"(?i)EXEC\s+CICS\s+([A-Z0-9-]+)", 1)), F.lit(""))


def arguments(statement: Column) -> Column:
    """array<struct<name,value,source>>: names and values in upper case, without quotes; source literal or identifier."""
    one = lambda n, v: F.struct(F.upper(n).alias("name"), F.upper(F.regexp_replace(F.trim(v), "^['\"]|['\"]$", "")).alias("value"), F.when(F.trim(v).rlike("^(?:'.*'|\".*\")$"), "literal").otherwise("identifier").alias("source"))
    return F.zip_with(F.regexp_extract_all(statement, F.lit(_ARGUMENT), F.lit(1)), F.regexp_extract_all(statement, F.lit(_ARGUMENT), F.lit(2)), one)


def argument(statement: Column, name: str) -> Column:
    """struct<name,value,source> of the first argument of that name, null without one."""
    return F.try_element_at(F.filter(arguments(statement), lambda a: a["name"] == name), F.lit(1))


def operation_type(command_: Column) -> Column:
    return F.coalesce(_of(OPERATIONS, command_), F.lit("other"))


def file_group(command_: Column) -> Column:
    return F.when(command_.isin(*FILES_WRITTEN), "cics_files_written").when(command_.isin(*FILES_BROWSED), "cics_files_browsed").otherwise("cics_files_read")


def target(statement: Column) -> Column:
    """struct<kind,value,source> of what a statement works on: its program, else its first resource."""
    found = F.filter(F.transform(arguments(statement), lambda a: F.struct(F.when(a["name"] == "PROGRAM", "PROGRAM").otherwise(_of(RESOURCES, a["name"])).alias("kind"), a["value"].alias("value"), a["source"].alias("source"))), lambda t: t["kind"].isNotNull() & (t["value"] != ""))
    return F.coalesce(F.try_element_at(F.filter(found, lambda t: t["kind"] == "PROGRAM"), F.lit(1)), F.try_element_at(found, F.lit(1)))


def resources(statement: Column) -> Column:
    """array<struct<kind,target,source>> of the files, queues, maps and transactions that a statement names."""
    return F.filter(F.transform(arguments(statement), lambda a: F.struct(_of(RESOURCES, a["name"]).alias("kind"), a["value"].alias("target"), a["source"].alias("source"))), lambda r: r["kind"].isNotNull() & (r["target"] != ""))


def handlers(statement: Column) -> Column:
    """array<struct<kind,key,target,action>>: bindings of HANDLE, conditions ignored, and response captures."""
    row = lambda kind, key, target_, action: F.struct(kind.alias("kind"), key.alias("key"), target_.alias("target"), action.alias("action"))
    none = F.lit(None).cast("string")
    empty = F.array().cast("array<struct<kind:string,key:string,target:string,action:string>>")
    which = F.upper(F.regexp_extract(statement, r"(?i)\bHANDLE\s+(CONDITION|AID|ABEND)\b", 1))
    tail = F.regexp_replace(statement, r"(?is)^.*\bHANDLE\s+(?:CONDITION|AID)\b", "")
    pattern = F.lit(r"(?i)([A-Z0-9-]+)\s*(?:\(([^)]*)\))?")
    bound = F.zip_with(F.regexp_extract_all(tail, pattern, F.lit(1)), F.regexp_extract_all(tail, pattern, F.lit(2)), lambda n, t: row(which, F.upper(n), F.nullif(F.upper(F.trim(t)), F.lit("")), F.when(F.trim(t) == "", "reset").otherwise("set")))
    abend = F.when(statement.rlike(r"(?i)\sRESET\b"), F.array(row(which, F.lit("RESET"), none, F.lit("reset")))).when(statement.rlike(r"(?i)\sCANCEL\b"), F.array(row(which, F.lit("CANCEL"), none, F.lit("cancel")))).otherwise(
        F.transform(F.filter(arguments(statement), lambda a: a["name"].isin("LABEL", "PROGRAM")), lambda a: row(which, a["name"], a["value"], F.lit("set")))
    )
    ignored = F.filter(F.split(F.upper(F.regexp_extract(statement, r"(?i)\bIGNORE\s+CONDITION\s+([A-Z0-9 -]+)", 1)), " "), lambda x: x != "")
    captured = F.transform(F.filter(arguments(statement), lambda a: a["name"].isin("RESP", "RESP2")), lambda a: row(F.lit("RESPONSE_CAPTURE"), a["name"], a["value"], F.lit("capture")))
    return F.concat(F.when(which == "ABEND", abend).when(which != "", bound).otherwise(empty), F.transform(ignored, lambda k: row(F.lit("IGNORE CONDITION"), k, none, F.lit("ignore"))), captured)
