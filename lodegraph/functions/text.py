"""Scalar functions over source text, names and statements; all are Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Names that stand for a constant.
FIGURATIVE = {"SPACE": " ", "SPACES": " ", "ZERO": "0", "ZEROS": "0", "ZEROES": "0", "QUOTE": '"', "QUOTES": '"', "NULL": "", "LOW-VALUE": "0", "LOW-VALUES": "0", "HIGH-VALUE": "100", "HIGH-VALUES": "100"}


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def program_name(c: str | Column) -> Column:
    """Upper case without the file extension .cbl or .cob; idempotent."""
    return F.upper(F.regexp_replace(F.trim(col(c)), r"(?i)\.(cbl|cob)$", ""))


def call_target(c: str | Column, program: Column | None = None) -> Column:
    """Target of a PERFORM or CALL: without the program's prefix and what follows THRU or THROUGH."""
    t = F.regexp_replace(F.trim(col(c)), r"(?i)\s+THR(U|OUGH)\s+.*$", "")
    if program is not None:
        t = F.when(F.startswith(t, F.concat(program, F.lit("."))), F.substring(t, F.length(program) + 2, F.length(t))).otherwise(t)
    return t


def is_program_target(c: str | Column) -> Column:
    """A name of at least two characters that is no constant, no number, and has no blanks."""
    v = F.upper(F.trim(col(c)))
    return F.coalesce((F.length(v) >= 2) & ~v.isin(*FIGURATIVE, "NULLS") & ~v.rlike(r"^\d+$") & v.rlike(r"^[A-Z][A-Z0-9_-]*$"), F.lit(False))


def figurative(c: str | Column) -> Column:
    """Value of a figurative constant, any other text as it is."""
    names = F.create_map(*[F.lit(x) for kv in FIGURATIVE.items() for x in kv])
    return F.coalesce(F.try_element_at(names, F.upper(F.trim(col(c)))), col(c))


def compact(c: str | Column, limit: int | None = None) -> Column:
    t = F.trim(F.regexp_replace(col(c), r"\s+", " "))
    return t if limit is None else F.when(F.length(t) > limit, F.concat(F.left(t, F.lit(limit - 3)), F.lit("..."))).otherwise(t)


def strip_noise(c: str | Column) -> Column:
    """Without zero-width characters and byte order marks."""
    return F.regexp_replace(col(c), "[\\u200b\\u200c\\u200d\\u2060\\ufeff]", "")


def safe_name(c: str | Column) -> Column:
    return F.regexp_replace(col(c), r"[^A-Za-z0-9_-]", "_")


def sentences(c: str | Column) -> Column:
    return F.filter(F.transform(F.split(col(c), r"[.!?]+\s+|\r?\n"), lambda x: F.trim(x)), lambda s: s != "")


def lines(c: str | Column) -> Column:
    return F.split(col(c), r"\r?\n")


#: What a deactivated line of source starts with, and directives that only move the listing.
CODE_VERBS = (
    "MOVE", "PERFORM", "GO TO", "GOBACK", "STOP RUN", "EXIT", "IF", "THEN", "ELSE", "END-IF", "EVALUATE", "WHEN", "READ", "READNEXT", "READPREV", "WRITE", "REWRITE",
    "DELETE", "START", "STARTBR", "ENDBR", "RESETBR", "CALL", "COPY", "ADD", "SUBTRACT", "COMPUTE", "INITIALIZE", "SET",
)
EXEC_LANGUAGES = ("CICS", "SQL", "DLI", "IMS")
LISTING_DIRECTIVES = ("EJECT", "SKIP")
#: Words in the first area of a line that name no paragraph.
NO_PARAGRAPH = (
    "PROCEDURE", "WORKING-STORAGE", "DATA", "IDENTIFICATION", "ENVIRONMENT", "FILE", "LINKAGE", "CONFIGURATION", "INPUT-OUTPUT", "FILE-CONTROL", "DIVISION", "SECTION",
    "FD", "SD", "01", "77", "COPY", "REPLACE", "EXEC", "PROGRAM-ID", "AUTHOR", "DATE-WRITTEN", "DATE-COMPILED",
)

#: Patterns that Java's and RE2's regular expressions read alike, so that SQL can state them too.
EXEC_PATTERN = rf"(?i)\bEXEC\s+({'|'.join(EXEC_LANGUAGES)})\b"
LABEL_PATTERN = r"(?i)^\s*[A-Z0-9][A-Z0-9_-]+\.\s*$"
NOISE_PATTERN = rf"(?i)^\s*(({'|'.join(LISTING_DIRECTIVES)})|[-=*_/\s]*$)"
CODE_PATTERN = (
    rf"(?i)^\s*(EXEC\s+({'|'.join(EXEC_LANGUAGES)})\b|({'|'.join(v.replace(' ', chr(92) + 's+') for v in CODE_VERBS)})\b"
    r"|[A-Z0-9][A-Z0-9_-]+\.\s*$|(INPUT|OUTPUT)\s*:\s*$|[0-9]{2}\s+[A-Z0-9_-]+\b)"
)


def is_noise_line(line: Column) -> Column:
    """A comment without content: blank, a rule of decoration, or a directive of the listing."""
    return line.rlike(NOISE_PATTERN)


def is_code_like(line: Column) -> Column:
    """A comment line that looks like a deactivated statement, label or data entry, in any letter case."""
    return line.rlike(CODE_PATTERN)


def is_commented_out(block: Column) -> Column:
    """An array of comment lines that is code: at least three code lines, two that are half of the lines
    that are not blank, or an EXEC beside another code line or a label."""
    some = F.filter(block, lambda x: x.rlike(r"\S"))
    n = F.size(F.filter(some, is_code_like))
    has_exec, has_label = F.exists(some, lambda x: x.rlike(EXEC_PATTERN)), F.exists(some, lambda x: x.rlike(LABEL_PATTERN))
    return (n >= 3) | (has_exec & ((n >= 2) | has_label)) | ((n >= 2) & (n * 2 >= F.size(some)))


def comment_blocks(source: Column) -> Column:
    """array<struct<target,line_start,line_end,lines>>: the comments of fixed-form source before each
    paragraph or section, and before the procedure division as `_PROGRAM_SUMMARY`.

    Noise lines count for nothing and trailing asterisks are dropped; a statement or a division between
    the comments and the name clears them. One fold over the lines; null text has no blocks."""
    held = "array<struct<no:int,text:string>>"
    none = F.array().cast(held)

    def step(s: Column, line: Column) -> Column:
        no, mark, rest = s["no"] + 1, F.substring(line, 7, 1), F.substring(line, 8, 2**30)
        said = F.trim(F.regexp_replace(rest, r"^\s+|\s*\**\s*$", ""))
        name = F.upper(F.regexp_extract(line, r"^.{6}\s([A-Za-z0-9][A-Za-z0-9_-]+)(?:\s+(?i:SECTION))?\.?\s*$", 1))
        body = F.regexp_extract(F.substring(line, 8, 65), r"\S", 0)
        is_comment, is_division = mark == "*", line.rlike(r"(?i)PROCEDURE\s+DIVISION")
        skipped = (F.length(line) < 7) | F.lower(mark).isin("-", "/", "d")
        is_name = name != ""
        counts = ~name.isin(*NO_PARAGRAPH) & ~name.rlike("^[0-9]")
        target = F.when(is_division, "_PROGRAM_SUMMARY").when(is_name & counts, name)
        clears = is_division | F.when(is_name, counts | name.isin(*NO_PARAGRAPH)).otherwise((mark == " ") & ~body.isin("", "*"))
        done = F.when(target.isNotNull() & (F.size(s["held"]) > 0), F.concat(s["done"], F.array(F.struct(target.alias("target"), s["held"][0]["no"].alias("line_start"), F.element_at(s["held"], -1)["no"].alias("line_end"), F.transform(s["held"], lambda h: h["text"]).alias("lines"))))).otherwise(s["done"])
        keep = is_comment & ~is_noise_line(rest) & (said != "")
        plain = ~skipped & ~is_comment
        return F.struct(
            no.alias("no"),
            F.when(keep & (F.length(line) >= 7), F.concat(s["held"], F.array(F.struct(no.alias("no"), said.alias("text"))))).when(plain & clears, none).otherwise(s["held"]).alias("held"),
            F.when(plain, done).otherwise(s["done"]).alias("done"),
        )

    start = F.struct(F.lit(0).alias("no"), none.alias("held"), F.array().cast("array<struct<target:string,line_start:int,line_end:int,lines:array<string>>>").alias("done"))
    return F.when(source.isNotNull(), F.aggregate(lines(source), start, step, lambda s: s["done"]))


def sql_tables(c: str | Column) -> Column:
    """Distinct tables that follow FROM, JOIN, UPDATE or INTO; host variables and CTE names left out."""
    t = F.upper(col(c))
    named = F.regexp_extract_all(t, F.lit(r"\b(?:FROM|JOIN|UPDATE|INTO)\s+([A-Z][A-Z0-9_.]*)"), F.lit(1))
    ctes = F.regexp_extract_all(t, F.lit(r"\b(?:WITH|,)\s*([A-Z][A-Z0-9_]*)\s+AS\s*\("), F.lit(1))
    return F.array_sort(F.array_except(F.array_distinct(named), ctes))


def sql_operation(c: str | Column) -> Column:
    return F.nullif(F.upper(F.regexp_extract(col(c), r"(?i)EXEC\s+SQL\s+(\w+)", 1)), F.lit(""))


def is_dynamic_sql(c: str | Column) -> Column:
    return F.upper(col(c)).rlike(r"\b(PREPARE|EXECUTE\s+IMMEDIATE)\b")


def call_literals(c: str | Column) -> Column:
    return F.array_sort(F.array_distinct(F.regexp_extract_all(col(c), F.lit(r"""\bCALL\s+['"]([A-Z0-9_-]+)['"]"""), F.lit(1))))


def call_using(c: str | Column) -> Column:
    return F.filter(F.split(F.regexp_extract(col(c), r"\bCALL\s+\S+\s+USING\s+([^.\r\n]*)", 1), r"[\s,]+"), lambda x: ~x.isin("", "BY", "REFERENCE", "CONTENT", "VALUE"))


def go_to_target(c: str | Column) -> Column:
    return F.nullif(F.regexp_extract(col(c), r"\bGO\s+TO\s+([A-Z0-9-]+)", 1), F.lit(""))


def if_condition(c: str | Column) -> Column:
    return F.nullif(compact(F.regexp_extract(col(c), r"\bIF\s+(.+?)(?:\s+THEN\b|\r?\n|$)", 1)), F.lit(""))


def picture(c: str | Column) -> Column:
    """The PIC clause of a data entry without the closing period."""
    return F.nullif(F.regexp_extract(F.upper(col(c)), r"\bPIC(?:TURE)?\s+(?:IS\s+)?(\S+?)\.?(?:\s|$)", 1), F.lit(""))


def cics_command(c: str | Column) -> Column:
    """Command of an EXEC CICS, SEND with its object."""
    t = F.upper(F.regexp_extract(col(c), r"(?i)EXEC\s+CICS\s+(SEND\s+MAP|SEND\s+TEXT|\w+)", 1))
    return F.nullif(F.regexp_replace(t, r"\s+", " "), F.lit(""))


def perform_varying(c: str | Column) -> Column:
    """array<struct<var,from,by,until>> of a PERFORM VARYING, outermost first: its own variable, then that of every AFTER."""
    t = F.upper(col(c))
    whole = F.regexp_extract(t, r"(?s)\bPERFORM\b(?:\s+[A-Z0-9-]+){0,3}?\s+(?:WITH\s+TEST\s+(?:BEFORE|AFTER)\s+)?VARYING\s+([^.]*)", 1)
    parts = F.split(whole, r"\s+AFTER\s+")
    grab = lambda x, g: F.nullif(F.regexp_extract(x, r"(?s)^\s*(\S+)\s+FROM\s+(\S+)\s+BY\s+(\S+)\s+UNTIL\s+([^\r\n]+)", g), F.lit(""))
    loops = F.transform(parts, lambda x: F.struct(grab(x, 1).alias("var"), grab(x, 2).alias("from"), grab(x, 3).alias("by"), F.trim(grab(x, 4)).alias("until")))
    return F.filter(loops, lambda x: x["var"].isNotNull())


def markdown_complexity(c: str | Column) -> Column:
    return F.regexp_extract(col(c), r"(?i)\|\s*complexity\s*\|\s*(\d+)", 1).try_cast("int")


def json_in_text(c: str | Column) -> Column:
    """The first {...} of noisy text, to its last closing brace, as JSON text; null where it is none."""
    found = F.regexp_extract(col(c), r"(?s)(\{.*\})", 1)
    return F.when(F.try_parse_json(found).isNotNull(), F.to_json(F.try_parse_json(found)))


def diagram_id(c: str | Column) -> Column:
    """Identifier for diagrams: letters, digits and _, not starting with a digit."""
    s = F.regexp_replace(col(c), r"[^A-Za-z0-9_]", "_")
    return F.when(s.rlike("^[0-9]"), F.concat(F.lit("n_"), s)).otherwise(s)


def is_alphabetic(c: Column) -> Column:
    return c.rlike(r"^[\p{L} ]*$")


def is_lower(c: Column) -> Column:
    return c.rlike(r"^[\p{Ll} ]*$")


def is_upper(c: Column) -> Column:
    return c.rlike(r"^[\p{Lu} ]*$")


def is_numeric(c: Column) -> Column:
    return F.coalesce(F.trim(c).try_cast("double").isNotNull(), F.lit(False))


#: What only programs of the network database hold.
IDMS_PATTERN = r"(?i)\bBIND\s+RUN-UNIT\b|\bIDMS-\w+|\bOBTAIN\s+(CALC|FIRST|NEXT|OWNER|PRIOR)\b|\bREADY\s+USAGE-MODE\b"


def dialect(c: Column) -> Column:
    """IDMS where the whole text has one of its markers, else COBOL."""
    return F.when(c.rlike(IDMS_PATTERN), "IDMS").otherwise("COBOL")


def percent(numerator: Column, denominator: Column) -> Column:
    """Share in percent; null where the denominator is not positive."""
    return F.when(denominator > 0, numerator / denominator * 100)


def integer(c: Column) -> Column:
    """Whole number written with thousands separators."""
    return F.regexp_replace(F.trim(c), ",", "").try_cast("bigint")
