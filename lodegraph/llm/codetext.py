"""Natural language in the comments and string literals of COBOL and JCL source.

The spans are what the languages say: fixed and free form COBOL with embedded SQL, JCL statements with
their operands and comments. A span's language is the one whose zstandard dictionary, built from labelled
text, encodes it shortest; a span that the dictionary of code encodes about as short is no natural
language.
"""

from __future__ import annotations

import hashlib
import math
import pickle
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lodegraph.llm import langid

LANGUAGES = ("en", "de", "fr", "es", "it", "pt", "nl")
#: Least words of natural language in a case.
LEAST_WORDS = 4
#: Bounds of the labelled text: documents of each language, bytes of each dictionary; chunks for code.
SAMPLE_DOCUMENTS, DICTIONARY_BYTES, SAMPLE_CHUNKS = 400, 60_000, 400
#: Columns of source text in a fixed-form line.
FIXED_COLUMNS = 72

_FREE = re.compile(r"^(?:[ 0-9]{6})?\s*(?:>>\s*SOURCE\s+(?:FORMAT\s+)?(?:IS\s+)?(FREE|FIXED)|\$\s*SET\s+SOURCEFORMAT\s*\(?\s*[\"']?\s*(FREE|FIXED))", re.I)
_TOKEN = re.compile(r"\*>|--|/\*|'|\"|\bEXEC\s+SQL\b|\bEND-EXEC\b", re.I)


class Span(NamedTuple):
    start_line: int
    kind: str
    lines: tuple[str, ...]


def _blocks(found: list[tuple[int, str, bool]]) -> Iterator[Span]:
    """Comment blocks of (line, text, whole line?) comments."""
    run: list[tuple[int, str]] = []
    for line, text, whole in found:
        if run and not (whole and line == run[-1][0] + 1):
            yield Span(run[0][0], "comment", tuple(t for _, t in run))
            run = []
        if whole:
            run.append((line, text))
        else:
            yield Span(line, "comment", (text,))
    if run:
        yield Span(run[0][0], "comment", tuple(t for _, t in run))


def cobol_spans(text: str) -> list[Span]:
    """Comment blocks and literals of COBOL source, fixed form until a directive says free."""
    comments: list[tuple[int, str, bool]] = []
    literals: list[Span] = []
    free = False
    # Text that begins within embedded SQL shows an END-EXEC before any EXEC.
    ends = re.search(r"\bEND-EXEC\b", text, re.I)
    sql = bool(ends) and not re.search(r"\bEXEC\s+(?:SQL|CICS)\b", text[: ends.start()], re.I)
    literal: list[str] | None = None
    quote, opened, in_comment = "", 0, False
    for no, line in enumerate(text.split("\n"), 1):
        line = line.rstrip("\r")
        if not free and line[6:7] in ("*", "/"):
            comments.append((no, line[7:FIXED_COLUMNS], True))
            continue
        if literal is None and not in_comment and not ("'" in line or '"' in line or "*>" in line or "EXEC" in line or "--" in line or ">>" in line or "$" in line or "xec" in line or "/*" in line):
            continue
        if (">>" in line or "$" in line) and (directive := _FREE.match(line)):
            free = (directive[1] or directive[2]).upper() == "FREE"
            continue
        if free:
            body = line
        else:
            line = line[:FIXED_COLUMNS]
            mark, body = line[6:7], line[7:]
        if not body.strip():
            continue
        if not free:
            if literal is not None:
                lead = body.lstrip()
                if mark == "-" and lead[:1] == quote:
                    body = lead[1:]
                else:  # never closed: it ended with its line
                    literals.append(Span(opened, "literal", ("".join(literal).rstrip(),)))
                    literal = None
        start = body.lstrip()
        if literal is None and not in_comment and (start.startswith("*>") or (sql and start.startswith("--"))):
            comments.append((no, start[2:], True))
            continue
        at, n = 0, len(body)
        while at < n:
            if in_comment:
                end = body.find("*/", at)
                comments.append((no, body[at : n if end < 0 else end], False))
                in_comment, at = end < 0, n if end < 0 else end + 2
                continue
            if literal is not None:
                end = body.find(quote, at)
                if end < 0:
                    # Without a closing quote a fixed-form literal runs to the last column.
                    literal.append(body[at:] if free else body[at:].ljust(FIXED_COLUMNS - 7 - at) if len(literal) == 0 or at else body[at:])
                    at = n
                elif body[end + 1 : end + 2] == quote:
                    literal.append(body[at : end + 1])
                    at = end + 2
                else:
                    literal.append(body[at:end])
                    literals.append(Span(opened, "literal", ("".join(literal),)))
                    literal, at = None, end + 1
                continue
            token = _TOKEN.search(body, at)
            if not token:
                break
            word = token[0]
            at = token.end()
            if word == "*>" or (word == "--" and sql):
                comments.append((no, body[at:], False))
                break
            if word == "/*":
                in_comment = sql
            elif word in "'\"":
                literal, quote, opened = [], word, no
            elif word[0] in "eE":
                sql = word[1] in "xX"
        if literal is not None and free:  # free form has no literals over several lines
            literals.append(Span(opened, "literal", ("".join(literal),)))
            literal = None
    if literal is not None:
        literals.append(Span(opened, "literal", ("".join(literal).rstrip(),)))
    return [*_blocks(comments), *literals]


_JCL = re.compile(r"//([^\s*]\S*)?\s+(\S+)(?:\s+|$)")


def jcl_spans(text: str) -> list[Span]:
    """Comment blocks and literals of JCL; lines that are no statements are data."""
    comments: list[tuple[int, str, bool]] = []
    literals: list[Span] = []
    literal: list[str] | None = None
    opened, operands_go_on = 0, False
    for no, line in enumerate(text.split("\n"), 1):
        line = line.rstrip("\r")
        if line.startswith("//*"):
            comments.append((no, line[3:FIXED_COLUMNS], True))
            continue
        # A quote that opens before column 73 and closes behind it shows that the line has no number there.
        if len(line) > FIXED_COLUMNS and not (line[:FIXED_COLUMNS].count("'") % 2 and line.count("'") % 2 == 0):
            line = line[:FIXED_COLUMNS]
        if not line.startswith("//"):
            literal, operands_go_on = None, False
            continue
        if literal is not None or operands_go_on:
            rest = line[2:].lstrip()
        else:
            head = _JCL.match(line)
            if not head:
                continue
            rest = line[head.end() :]
        at, n, operands_go_on = 0, len(rest), False
        while at < n:
            if literal is not None:
                end = rest.find("'", at)
                if end < 0:
                    literal.append(rest[at:])
                    at = n
                elif rest[end + 1 : end + 2] == "'":
                    literal.append(rest[at : end + 1])
                    at = end + 2
                else:
                    literal.append(rest[at:end])
                    literals.append(Span(opened, "literal", ("".join(literal),)))
                    literal, at = None, end + 1
                continue
            c = rest[at]
            if c == "'":
                literal, opened = [], no
            elif c == " ":
                operands_go_on = rest[at - 1 : at] == ","
                if rest[at:].strip():
                    comments.append((no, rest[at:], False))
                break
            at += 1
        else:
            operands_go_on = literal is None and rest.endswith(",")
    return [*_blocks(comments), *literals]


#: Deactivated statements and entries, change marks, queries: each makes a line no natural language.
_STATEMENT = re.compile(
    r"^\s*(?:(?:MOVE|PERFORM|ADD|SUBTRACT|MULTIPLY|DIVIDE|COMPUTE|CALL|STRING|UNSTRING|INITIALIZE|INSPECT|EVALUATE|DISPLAY|ACCEPT|SET|READ|WRITE|REWRITE|DELETE|OPEN|CLOSE|GO\s+TO)\s+(?:\S+\s+){0,3}?\S*(?:[A-Z0-9]-[A-Z0-9]|'|\").*"
    r"|(?:IF|WHEN|UNTIL|AND|OR)\s+\S+\s*(?:[<>=]|NOT\b|IS\b|EQUAL\b|GREATER\b|LESS\b).*"
    r"|(?:ELSE|CONTINUE|EXIT|GOBACK|STOP\s+RUN|END-[A-Z]+|NEXT\s+SENTENCE)\s*\.?"
    r"|EXEC\s+(?:SQL|CICS|DLI)\b.*|(?:\d\d)\s+[A-Z0-9-]+\s+(?:PIC|VALUE|REDEFINES|OCCURS|COMP)\b.*"
    r"|[A-Z0-9]+(?:-[A-Z0-9]+)+\s*\.|//.*|\S+\s*=\s*:?\S+(?:\s+(?:AND|OR)\b.*)?)\s*$",
    re.I,
)
_QUERY = re.compile(r"^\s*(?:SELECT\b.*\bFROM|INSERT\s+INTO|UPDATE\s+\S+\s+SET|DELETE\s+FROM|DECLARE\s+\S+\s+CURSOR|FETCH\s+\S+\s+INTO|CREATE\s+(?:TABLE|INDEX)|WITH\s+\S+\s+AS\s*\()\b", re.I)
_MARK = re.compile(r"^\s*(?:[A-Z]{2,4}-?\d{2,}\b|\d{1,2}[./-]\d{1,2}[./-]\d{2,4}\b|\d{4}-\d\d-\d\d\b)[\s\d./:-]*(?:[A-Z]{2,4}\b)?[\s.]*$")
_FIRST_WORD = frozenset(
    "MOVE PERFORM ADD SUBTRACT MULTIPLY DIVIDE COMPUTE CALL STRING UNSTRING INITIALIZE INSPECT EVALUATE DISPLAY ACCEPT SET READ WRITE REWRITE DELETE OPEN CLOSE GO IF WHEN UNTIL AND OR ELSE CONTINUE EXIT GOBACK STOP NEXT EXEC".split()
)
_LETTERS = re.compile(r"[^\W\d_]+")
#: Tokens that name something in the program: with digits, operators, or capitals joined by - _ or a point.
_IDENTIFIER = re.compile(r"\d|[=|<>:%#@$&]|[A-Z0-9][-_.][A-Z0-9]")
_PARTS: dict[str, tuple[str, ...]] = {}


def _is_statement(line: str) -> bool:
    head = line.split(None, 1)
    if not head:
        return False
    first = head[0]
    if first.upper().rstrip(".") in _FIRST_WORD or first[0].isdigit() or "-" in first or "=" in line or first.startswith("//"):
        return _STATEMENT.match(line) is not None
    return False


def natural_lines(span: Span) -> list[str]:
    """Lines of a span that may be natural language: no rules, change marks, statements and queries."""
    out = []
    for t in span.lines:
        t = t.strip()
        if t and (t[:2] not in ("--", "==", "**", "- ") or _LETTERS.search(t)) and not (_is_statement(t) or _MARK.match(t) or _QUERY.match(t)):
            out.append(t)
    return out


def folded_words(text: str) -> list[str]:
    """Folded words of a text, identifiers left out."""
    out: list[str] = []
    for token in text.split():
        parts = _PARTS.get(token)
        if parts is None:
            if len(_PARTS) > 300_000:
                _PARTS.clear()
            hyphen_word = re.fullmatch(r"[(\"']*[^\W\d_]+-[^\W\d_]+[.,;:)\"']*", token) and not token.isupper()
            name = _IDENTIFIER.search(token.strip(".,;:()\"'!?")) and not hyphen_word
            parts = _PARTS[token] = () if name else tuple(langid.fold(w) for w in _LETTERS.findall(token))
        out += parts
    return out


#: Bytes by which the dictionary of code has to be worse than the best language.
MARGIN = 1
#: Weight of how much more often than usual a string stands in programs of a house language.
HOUSE_WEIGHT = 3.0
#: Bytes of labelled text in one string of the sample.
SAMPLE_STRING = 1_000


class Dictionaries:
    """A zstandard dictionary per language and one of code."""

    def __init__(self, texts: dict[str, bytes], code: bytes):
        self.names = sorted(texts)
        self.encoders = {name: self._encoder(texts[name]) for name in self.names}
        self.code = self._encoder(code)

    @staticmethod
    def _encoder(text: bytes) -> zstandard.ZstdCompressor:
        how = zstandard.ZstdCompressionParameters.from_level(1, write_content_size=0, write_checksum=0, write_dict_id=0, format=zstandard.FORMAT_ZSTD1_MAGICLESS)
        held = zstandard.ZstdCompressionDict(text or b" " * 8, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        held.precompute_compress(compression_params=how)
        return zstandard.ZstdCompressor(dict_data=held, compression_params=how)

    def language(self, words: bytes) -> str | None:
        """Language of the shortest encoding of folded words, None if code encodes them as short."""
        size, name = min((len(self.encoders[n].compress(words)), n) for n in self.names)
        return name if size + MARGIN <= len(self.code.compress(words)) else None


def spans(text: str, is_jcl: bool) -> list[Span]:
    return jcl_spans(text) if is_jcl else cobol_spans(text)


def _source_rows(chunks: DataFrame, types: DataFrame) -> DataFrame:
    """Rows whose type holds source, with is_jcl. The reference table has a fixed number of rows."""
    ref = types.filter("holds_source").select(F.lower(F.trim("chunk_type")).alias("_type"), (F.lower("family") == "jcl").alias("is_jcl")).distinct()
    rows = chunks.select("row_id", "chunk_type", "program", "text").filter("text is not null")
    return rows.withColumn("_type", F.lower(F.trim("chunk_type"))).join(F.broadcast(ref), "_type")


def _document_strings(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = Counter((lang, " ".join(folded_words(s))[:SAMPLE_STRING], "sentence") for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()) for s in langid.sentences(text) if langid.natural_words(s))
        yield _labelled_batch(found)


def _span_strings(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found: Counter = Counter()
        for lang, text, is_jcl in zip(*(batch.column(c).to_pylist() for c in ("lang", "text", "is_jcl"))):
            for span in spans(text, is_jcl):
                words = folded_words(" ".join(natural_lines(span)))
                if len(words) >= LEAST_WORDS:
                    found[lang, " ".join(words)[:SAMPLE_STRING], span.kind] += 1
                elif span.kind == "literal":
                    found[lang, " ".join(words)[:SAMPLE_STRING], "code"] += 1
            for line in text.splitlines():
                # Lines without any comment or literal are code.
                if not (line[6:7] in ("*", "/", "-") or line.startswith("//*") or any(mark in line for mark in ("'", '"', "*>", "--", "/*"))):
                    found[lang, " ".join(folded_words(line[6:FIXED_COLUMNS]))[:SAMPLE_STRING], "code"] += 1
        yield _labelled_batch(found)


def _labelled_batch(found: Counter) -> pa.RecordBatch:
    rows = [(*k, n) for k, n in found.items() if k[1]]
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], pa.int64() if i == 3 else pa.string()) for i in range(4)], names=["lang", "words", "kind", "n"])


def labelled_strings(docs: DataFrame, chunks: DataFrame, types: DataFrame, catalog: DataFrame, documents: int = SAMPLE_DOCUMENTS, n_chunks: int = SAMPLE_CHUNKS) -> list[tuple[str, str, str, int]]:
    """(language, folded words, kind, count) of a bounded sample of labelled text.

    Labels are the language label of a document and the house language of a chunk's program. The sample
    holds `documents` documents and `n_chunks` source chunks of each language, those of the least hashes,
    and of their strings at most the 4,000 most frequent of each language and kind."""
    by_hash = lambda k: Window.partitionBy("lang").orderBy(F.xxhash64(k), k)
    d = docs.select(F.col("doc_id").alias("k"), langid.label_language("lang").alias("lang")).filter(F.col("lang").isin(*LANGUAGES)).withColumn("r", F.row_number().over(by_hash("k"))).filter(F.col("r") <= documents)
    sentences = docs.select(F.col("doc_id").alias("k"), "text").filter("text is not null").join(F.broadcast(d.select("k", "lang")), "k").select("lang", "text").mapInArrow(_document_strings, "lang string, words string, kind string, n bigint")
    house = catalog.select(F.upper(F.trim("program")).alias("_program"), langid.label_language("house_lang").alias("lang")).filter(F.col("lang").isin(*LANGUAGES)).dropDuplicates(["_program"])
    source = _source_rows(chunks, types)
    c = source.select(F.col("row_id").alias("k"), F.upper(F.trim("program")).alias("_program")).join(house, "_program").withColumn("r", F.row_number().over(by_hash("k"))).filter(F.col("r") <= n_chunks)
    found = source.select(F.col("row_id").alias("k"), "text", "is_jcl").join(F.broadcast(c.select("k", "lang")), "k").select("lang", "text", "is_jcl").mapInArrow(_span_strings, "lang string, words string, kind string, n bigint")
    top = Window.partitionBy("lang", "kind").orderBy(F.desc("n"), F.xxhash64("words"))
    strings = sentences.unionByName(found).groupBy("lang", "kind", "words").agg(F.sum("n").alias("n"))
    return [(r.lang, r.words, r.kind, r.n) for r in strings.withColumn("r", F.row_number().over(top)).filter("r <= 4000").select("lang", "words", "kind", "n").collect()]


def fitted(strings: list[tuple[str, str, str, int]]) -> tuple[dict[str, bytes], bytes]:
    """(dictionary per language, dictionary of code) of labelled strings.

    Labels may be wrong. A word model of the documents' sentences scores each string; for spans of source
    the house languages they occur under count too, as far as they differ from one another. Strings of no
    clear language are left out."""
    counts: dict[tuple[str, str], int] = {}
    houses: dict[tuple[str, str], dict[str, int]] = {}
    for lang, words, kind, n in strings:
        if kind == "sentence":
            for w in words.split():
                counts[lang, w] = counts.get((lang, w), 0) + 1
        else:
            by = houses.setdefault((words, kind), {})
            by[lang] = by.get(lang, 0) + n
    model = langid.Model(((lang, w, n) for (lang, w), n in counts.items()), LANGUAGES)
    usual: dict[str, float] = {}
    for by in houses.values():
        for lang, n in by.items():
            usual[lang] = usual.get(lang, 0.0) + n
    usual = {lang: n / sum(usual.values()) for lang, n in usual.items()}
    held: dict[tuple[str, str], dict[str, int]] = {}
    for lang, words, kind, n in strings:
        if kind == "code":
            bucket = held.setdefault(("", kind), {})
        else:
            score = sum(model.score(w) for w in words.split())
            if kind != "sentence":
                votes = houses[words, kind]
                total = sum(votes.values())
                often = [votes.get(x, 0) / total / usual.get(x, 1.0) for x in LANGUAGES]
                score = score + [HOUSE_WEIGHT * min(total / 4, 1.0) * math.log(e + 0.1) for e in often]
            order = sorted(score)
            if order[-1] - order[-2] < 1.0:
                continue
            bucket = held.setdefault((LANGUAGES[int(score.argmax())], kind), {})
        bucket[words] = bucket.get(words, 0) + n

    def content(lang: str, kind: str, size: int) -> bytes:
        # Frequent strings stand last, where they are cheapest to refer to.
        out = sorted(held.get((lang, kind), {}).items(), key=lambda x: (x[1], hashlib.md5(x[0].encode()).digest()))
        return " . ".join(w for w, _ in out).encode()[-size:]

    third = DICTIONARY_BYTES // 3
    return {lang: b" . ".join(content(lang, k, third) for k in ("sentence", "comment", "literal")) for lang in LANGUAGES}, content("", "code", DICTIONARY_BYTES)


_LOADED: dict[str, Dictionaries] = {}


def natural_language(chunks: DataFrame, types: DataFrame, dictionaries: tuple[dict[str, bytes], bytes]) -> DataFrame:
    """(row_id, start_line, kind, lang, n_words, n_chars, chunk_chars) of every case.

    A case is a comment block or a literal with at least four words of natural language. Rows with null
    text or a type that holds no source have no cases. n_chars: characters of the span's natural lines."""
    packed = pickle.dumps(dictionaries)
    shared, name = chunks.sparkSession.sparkContext.broadcast(packed), hashlib.sha1(packed).hexdigest()

    def find(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if name not in _LOADED:
            _LOADED.clear()
            _LOADED[name] = Dictionaries(*pickle.loads(shared.value))
        encoders = _LOADED[name]
        known: dict[str, str | None] = {}
        for batch in batches:
            rows: list[tuple] = []
            for i, (text, is_jcl) in enumerate(zip(batch.column("text").to_pylist(), batch.column("is_jcl").to_pylist())):
                for span in spans(text, is_jcl):
                    lines = natural_lines(span)
                    if not lines:
                        continue
                    words = folded_words(" ".join(lines))
                    if len(words) < LEAST_WORDS:
                        continue
                    key = " ".join(words)
                    if key not in known:
                        if len(known) > 100_000:
                            known.clear()
                        known[key] = encoders.language(key.encode())
                    lang = known[key]
                    if lang is not None:
                        rows.append((i, span.start_line, span.kind, lang, len(words), sum(map(len, lines)), len(text)))
            cols = list(zip(*rows)) if rows else [()] * 7
            kinds = (pa.int32(), pa.string(), pa.string(), pa.int32(), pa.int32(), pa.int32())
            out = [batch.column("row_id").take(pa.array(cols[0], pa.int64()))] + [pa.array(c, t) for c, t in zip(cols[1:], kinds)]
            yield pa.RecordBatch.from_arrays(out, names=["row_id", "start_line", "kind", "lang", "n_words", "n_chars", "chunk_chars"])

    source = _source_rows(chunks, types).select("row_id", "is_jcl", "text")
    return source.mapInArrow(find, "row_id bigint, start_line int, kind string, lang string, n_words int, n_chars int, chunk_chars int")


def shares(cases: DataFrame) -> DataFrame:
    """(row_id, lang, n_spans, n_chars, share): what of a chunk's characters each language makes up."""
    return cases.groupBy("row_id", "lang").agg(F.count(F.lit(1)).alias("n_spans"), F.sum("n_chars").alias("n_chars"), F.round(F.sum("n_chars") / F.max("chunk_chars"), 6).alias("share"))
