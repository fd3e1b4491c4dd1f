"""Structure of COBOL source: tokens, a statement tree with text spans, its edges, symbols and defects.

The parser knows divisions, sections, paragraphs, sentences and the statements that nest (IF, EVALUATE,
PERFORM, SEARCH and the phrases that hold statements); it is no full grammar: operands stay tokens. Text
without a division header is procedure text, or data entries where its first line opens with a level
number. Programs are parsed one by one over Arrow batches, so rows never meet and nothing is collected.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Words that open a statement.
VERBS = frozenset(
    """ACCEPT ADD ALTER CALL CANCEL CLOSE COMPUTE CONTINUE DELETE DISPLAY DIVIDE ENTRY EVALUATE EXEC EXIT GO GOBACK IF INITIALIZE INSPECT MERGE MOVE
    MULTIPLY NEXT OPEN PERFORM READ RELEASE RETURN REWRITE SEARCH SET SORT START STOP STRING SUBTRACT UNSTRING WRITE""".split()
)
#: The node type of a verb where it is not the verb itself.
TYPES = {"GO": "GOTO", "IF": "IF_BRANCH", "STOP": "STOP_RUN", "NEXT": "NEXT_SENTENCE"}
#: Words before which the statements of a phrase begin, as in AT END, INVALID KEY, ON SIZE ERROR.
PHRASE_ENDS = {"END": "AT", "KEY": "INVALID", "ERROR": "SIZE", "OVERFLOW": "ON", "EXCEPTION": "ON", "END-OF-PAGE": "AT"}
PHRASE_VERBS = frozenset("ADD CALL COMPUTE DELETE DIVIDE MULTIPLY READ RETURN REWRITE START STRING SUBTRACT UNSTRING WRITE".split())
LOOP_WORDS = ("VARYING", "UNTIL", "WITH", "TEST")
DIVISIONS = ("IDENTIFICATION", "ID", "ENVIRONMENT", "DATA", "PROCEDURE")

_WORDS = re.compile(r"'(?:[^']|'')*'?|\"(?:[^\"]|\"\")*\"?|[+-]?\d+(?:\.\d+)?(?![\w-])|[A-Za-z0-9_](?:[A-Za-z0-9_-]*[A-Za-z0-9_])?|<=|>=|<>|\*\*|[().=<>+*/:,;-]")


@dataclass
class Token:
    text: str
    line: int
    upper: str = ""

    def __post_init__(self) -> None:
        self.upper = self.text if self.text[0] in "'\"" else self.text.upper()


@dataclass
class Node:
    """A node of the statement tree; head: the tokens of the statement itself, without those of its children."""

    type: str
    name: str = ""
    head: list[Token] = field(default_factory=list)
    children: list[Node] = field(default_factory=list)
    line_start: int = 0
    line_end: int = 0

    @property
    def text(self) -> str:
        return " ".join(t.text for t in self.head)

    def words(self) -> list[str]:
        return [t.upper for t in self.head]


_FORM = re.compile(r"\s*(?:\d{6})?\s*(?:>>\s*SOURCE\s+(?:FORMAT\s+)?(?:IS\s+)?|\$\s*SET\s+SOURCEFORMAT\s*\(?\s*[\"']?)(FREE|FIXED)", re.I)


def tokens(source: str) -> list[Token]:
    """Tokens of source, fixed form until a directive says free.

    Comments, directives and debugging lines are left out, also comments of embedded SQL. In fixed form
    text ends at column 72 and a literal goes on over lines that say so."""
    out: list[Token] = []
    free = embedded = False
    for no, line in enumerate(re.split(r"\r?\n", source), 1):
        if form := _FORM.match(line):
            free = form[1].upper() == "FREE"
            continue
        mark, body = (" ", line) if free else (line[6:7], line[7:72])
        if mark in ("*", "/", "D", "d") or not body.strip() or line.lstrip().startswith(("*>", ">>")) or (embedded and body.lstrip().startswith("--")):
            continue
        found = []
        for m in _WORDS.finditer(body):
            if m[0] == "*" and body[m.end() : m.end() + 1] == ">" or (embedded and m[0] == "-" and body[m.end() : m.end() + 1] == "-"):
                break  # a comment up to the end of the line
            found.append(m[0])
            if m[0].upper() in ("EXEC", "END-EXEC"):
                embedded = m[0].upper() == "EXEC"
        if mark == "-" and out and found:
            last = out[-1].text
            if last[0] in "'\"" and (len(last) == 1 or last[-1] != last[0]) and found[0][0] == last[0]:
                out[-1] = Token(last + found.pop(0)[1:], out[-1].line)
            elif last[0] not in "'\"":
                out[-1] = Token(last + found.pop(0), out[-1].line)
        out += [Token(t, no) for t in found]
    return out


class Parser:
    """Statement tree of the tokens of one program."""

    def __init__(self, source: str):
        self.t, self.i = tokens(source), 0

    def peek(self, k: int = 0) -> str:
        return self.t[self.i + k].upper if self.i + k < len(self.t) else ""

    def program(self) -> Node:
        root = Node("PROGRAM", line_start=1, line_end=self.t[-1].line if self.t else 1)
        if self.peek(1) != "DIVISION":
            part = self.data if re.fullmatch(r"\d\d?", self.peek()) else self.procedure
            root.children = part()
            return root
        while self.i < len(self.t):
            name = self.peek()
            division = Node("DIVISION", name, line_start=self.t[self.i].line)
            while self.i < len(self.t) and self.peek() != ".":
                division.head.append(self.t[self.i])
                self.i += 1
            self.i += 1
            if name == "PROCEDURE":
                division.children = self.procedure()
            elif name == "DATA":
                division.children = self.data()
            else:
                while self.i < len(self.t) and not self.at_division():
                    if self.peek() == "PROGRAM-ID":
                        root.name = self.peek(2) if self.peek(1) == "." else self.peek(1)
                    self.i += 1
            division.line_end = self.t[min(self.i, len(self.t)) - 1].line
            root.children.append(division)
        return root

    def at_division(self) -> bool:
        return self.peek() in DIVISIONS and self.peek(1) == "DIVISION"

    def data(self) -> list[Node]:
        """Data entries as a tree by their level numbers; 77 and 01 stand alone, 88 names values of the entry before."""
        out: list[Node] = []
        stack: list[tuple[int, Node]] = []
        section = ""
        while self.i < len(self.t) and not self.at_division():
            entry = []
            while self.i < len(self.t) and not (self.peek() == "." and (self.i + 1 >= len(self.t) or self.t[self.i + 1].line > self.t[self.i].line or not self.peek(1).isdigit())):
                entry.append(self.t[self.i])
                self.i += 1
            self.i += 1
            if len(entry) > 1 and entry[1].upper == "SECTION":
                section, stack = entry[0].upper, []
                continue
            if len(entry) > 1 and entry[0].upper in ("FD", "SD"):
                out.append(Node("FILE", entry[1].upper, entry, [], entry[0].line, entry[-1].line))
            if not entry or not re.fullmatch(r"\d\d?", entry[0].upper):
                continue
            level = int(entry[0].upper)
            name = entry[1].upper if len(entry) > 1 and entry[1].upper not in ("PIC", "PICTURE", "VALUE", "REDEFINES") else "FILLER"
            n = Node("DATA_88" if level == 88 else "DATA", name, entry, [], entry[0].line, entry[-1].line)
            while stack and level != 88 and (level in (1, 66, 77) or stack[-1][0] >= level):
                stack.pop()
            (stack[-1][1].children if stack else out).append(n)
            n.section = section  # type: ignore[attr-defined]
            if level != 88:
                stack.append((level, n))
        return out

    def procedure(self) -> list[Node]:
        out: list[Node] = []
        section: Node | None = None
        paragraph: Node | None = None
        while self.i < len(self.t) and not self.at_division():
            word, nxt = self.peek(), self.peek(1)
            if word not in VERBS and word != "." and nxt == "SECTION":
                section, paragraph = Node("SECTION", word, self.t[self.i : self.i + 2], [], self.t[self.i].line, self.t[self.i].line), None
                out.append(section)
                self.i += 3 if self.peek(2) == "." else 2
            elif word not in VERBS and re.match(r"[A-Z0-9]", word) and nxt == ".":
                paragraph = Node("PARAGRAPH", word, [self.t[self.i]], [], self.t[self.i].line, self.t[self.i].line)
                (section.children if section else out).append(paragraph)
                self.i += 2
            else:
                start = self.i
                sentence = Node("SENTENCE", "", [], [], self.t[self.i].line)
                sentence.children = self.statements(())
                if self.peek() == ".":
                    self.i += 1
                elif self.i == start or self.peek():
                    self.i += 1  # a word that opens nothing
                if sentence.children:
                    sentence.line_end = self.t[min(self.i, len(self.t)) - 1].line
                    home = paragraph or section
                    (home.children if home else out).append(sentence)
                    if home:
                        home.line_end = sentence.line_end
                    if section:
                        section.line_end = sentence.line_end
        return out

    def statements(self, ends: tuple[str, ...]) -> list[Node]:
        out = []
        while self.i < len(self.t) and self.peek() != "." and self.peek() not in ends and not self.at_division():
            if self.peek() not in VERBS:
                if ends and (self.peek().startswith("END-") or self.peek() in ("ELSE", "WHEN")):
                    break  # closes a statement further out
                self.i += 1
                continue
            out.append(self.statement())
        return out

    def take(self, stop: Callable[[], bool]) -> list[Token]:
        out = []
        while self.i < len(self.t) and self.peek() != "." and not stop():
            out.append(self.t[self.i])
            self.i += 1
        return out

    def branch(self, kind: str, head: list[Token], ends: tuple[str, ...]) -> Node:
        line = self.t[min(self.i, len(self.t) - 1)].line
        n = Node(kind, "", head, [], head[0].line if head else line)
        n.children = self.statements(ends)
        n.line_end = self.t[self.i - 1].line
        return n

    def statement(self) -> Node:
        verb = self.peek()
        n = Node(TYPES.get(verb, verb), "", [self.t[self.i]], [], self.t[self.i].line)
        self.i += 1
        opens = lambda: self.peek() in VERBS or self.peek().startswith("END-") or self.peek() in ("ELSE", "WHEN")
        if verb == "EXEC":
            n.type = f"EXEC_{self.peek()}"
            n.head += self.take(lambda: self.peek() == "END-EXEC")
            while self.peek() == ".":  # a period within embedded text
                n.head.append(self.t[self.i])
                self.i += 1
                n.head += self.take(lambda: self.peek() == "END-EXEC")
        elif verb == "IF":
            n.head += self.take(lambda: self.peek() == "THEN" or opens())
            self.i += self.peek() == "THEN"
            n.children.append(self.branch("THEN", [], ("ELSE", "END-IF")))
            if self.peek() == "ELSE":
                self.i += 1
                n.children.append(self.branch("ELSE", [], ("END-IF",)))
        elif verb in ("EVALUATE", "SEARCH"):
            n.head += self.take(lambda: self.peek() == "WHEN" or opens() or (self.peek() == "AT" and self.peek(1) == "END"))
            ends = ("WHEN", f"END-{verb}")
            while self.peek() in ("WHEN", "AT"):
                head = [self.t[self.i]]
                self.i += 1
                head += self.take(lambda: self.peek() in VERBS or self.peek() in ("WHEN", f"END-{verb}"))
                n.children.append(self.branch("AT_END" if head[0].upper == "AT" else "EVALUATE_BRANCH" if verb == "EVALUATE" else "SEARCH_WHEN", head, ends))
        elif verb == "PERFORM":
            inline = self.peek() in LOOP_WORDS or self.peek(1) == "TIMES" or self.peek() in VERBS
            n.head += self.take(lambda: opens())
            if inline:
                n.type = "PERFORM_INLINE"
                n.children = self.statements(("END-PERFORM",))
        else:
            n.head += self.take(lambda: opens() or (self.peek() == "NOT" and self.peek(1) in ("AT", "ON", "INVALID")))
            if verb == "NEXT" and n.words()[1:2] == ["SENTENCE"]:
                n.type = "NEXT_SENTENCE"
            while verb in PHRASE_VERBS and PHRASE_ENDS.get(n.head[-1].upper) in [t.upper for t in n.head[-3:]] and self.peek() in VERBS:
                n.children.append(self.branch("PHRASE", n.head[-3:], (f"END-{verb}", "NOT", "AT", "ON", "INVALID")))
                more = self.take(lambda: opens())
                n.head += more
                if not more:
                    break
        if self.peek() == f"END-{verb}":
            self.i += 1
        n.line_end = self.t[self.i - 1].line
        if n.type in ("GOTO", "CALL", "PERFORM"):
            n.name = target(n)
        return n


def target(n: Node) -> str:
    """Name that a GO TO, PERFORM or CALL leads to; '' where a variable or nothing names it."""
    words = [w for w in n.words()[1:] if w != "TO"]
    if not words:
        return ""
    return words[0].strip("'\"") if n.type != "CALL" or words[0][0] in "'\"" else ""


def parse(source: str) -> Node:
    return Parser(source).program()


def walk(root: Node) -> Iterator[tuple[str, str, int, Node]]:
    """(id, parent id, depth, node) in preorder; an id is the path of child positions."""
    todo = [("0", "", 0, root)]
    while todo:
        at = todo.pop()
        yield at
        i, _, depth, n = at
        todo += [(f"{i}.{k}", i, depth + 1, c) for k, c in reversed(list(enumerate(n.children)))]


def tree_rows(source: str) -> list[tuple[str, str, int, int, str, str, str, int, int]]:
    """(id, parent_id, ordinal, depth, type, name, text, line_start, line_end) of every node of one text."""
    return [(i, p, int(i.rsplit(".", 1)[-1]), d, n.type, n.name, n.text, n.line_start, n.line_end) for i, p, d, n in walk(parse(source))]


def flow_edges(source: str) -> list[tuple[str, str, str]]:
    """(src, dst, edge_type) between ids: CONTAINS_CODE, STARTS_WITH, FOLLOWED_BY among siblings, JUMPS_TO labels."""
    nodes = {i: n for i, _, _, n in walk(parse(source))}
    labels: dict[str, str] = {}
    for i, n in nodes.items():
        if n.type in ("PARAGRAPH", "SECTION"):
            labels.setdefault(n.name, i)
    out = []
    for i, n in nodes.items():
        kids = [f"{i}.{k}" for k in range(len(n.children))]
        code = [k for k in kids if not nodes[k].type.startswith("DATA")]
        out += [(i, k, "CONTAINS_CODE" if k in code else "CONTAINS_DATA") for k in kids]
        if code:
            out.append((i, code[0], "STARTS_WITH"))
        if n.type not in ("IF_BRANCH", "EVALUATE", "SEARCH"):  # branches are alternatives, not a sequence
            out += [(a, b, "FOLLOWED_BY") for a, b in zip(code, code[1:])]
        if n.type in ("GOTO", "PERFORM") and n.name in labels:
            out.append((i, labels[n.name], "JUMPS_TO"))
    return out


_OPERAND = re.compile(r"[A-Z][A-Z0-9-]*$")
#: Words of statements that are no data names.
RESERVED = frozenset(
    """ACCEPT ADD ADDRESS ADVANCING AFTER ALL ALPHABETIC ALPHABETIC-LOWER ALPHABETIC-UPPER ALSO AND ANY ARE ASCENDING AT BEFORE BY CALL CHARACTERS CLOSE COMPUTE CONTENT
    CONTINUE CONVERTING CORRESPONDING CORR COUNT DATE DAY DELETE DELIMITED DELIMITER DEPENDING DESCENDING DISPLAY DIVIDE DOWN END EQUAL ERROR EVALUATE EXCEPTION EXIT EXTEND FALSE FIRST FOR FROM
    FUNCTION GIVING GO GOBACK GREATER HIGH-VALUE HIGH-VALUES I-O IF IN INITIAL INITIALIZE INPUT INSPECT INTO INVALID IS KEY LEADING LENGTH LESS LINE LOW-VALUE LOW-VALUES MOVE MULTIPLY NEGATIVE
    NEXT NO NOT NULL NULLS NUMERIC OF OFF ON OPEN OR OTHER OUTPUT OVERFLOW PAGE PERFORM POINTER POSITIVE PROCEED QUOTE QUOTES READ RECORD REFERENCE REMAINDER REPLACING RETURN REVERSED
    REWRITE ROUNDED RUN SEARCH SENTENCE SET SIZE SPACE SPACES START STATUS STOP STRING SUBTRACT TALLYING TEST THAN THEN THROUGH THRU TIME TIMES TO TRAILING TRUE UNSTRING UNTIL UP UPON USING
    VALUE VARYING WHEN WITH WRITE ZERO ZEROES ZEROS PROGRAM""".split()
)


def symbols(source: str) -> list[tuple[str, str, int, str]]:
    """(name, kind, line, node id): data and condition names, paragraphs and sections of one text, and what
    its statements refer to (kind ref_data, ref_label), in order of place."""
    out = []
    for i, _, _, n in walk(parse(source)):
        if n.type in ("DATA", "DATA_88", "FILE"):
            out.append((n.name, {"DATA": "data", "DATA_88": "condition", "FILE": "file"}[n.type], n.line_start, i))
            words = n.words()
            out += [(words[k + 1], "ref_data", n.line_start, i) for k, w in enumerate(words[:-1]) if w in ("REDEFINES",)]
        elif n.type in ("PARAGRAPH", "SECTION"):
            out.append((n.name, n.type.lower(), n.line_start, i))
        elif n.type in ("GOTO", "PERFORM"):
            words = n.words()
            jump = [w for w in words[1:] if w != "TO"]
            upto = next((k for k, w in enumerate(jump) if w in ("VARYING", "UNTIL", "WITH", "TIMES", "DEPENDING")), len(jump))
            if upto < len(jump) and jump[upto] == "TIMES":
                upto -= 1
            out += [(w, "ref_label", n.line_start, i) for w in jump[:upto] if w not in ("THRU", "THROUGH", ",")]
            out += [(w, "ref_data", n.line_start, i) for w in jump[upto:] if _OPERAND.match(w) and w not in RESERVED]
        elif n.head and not n.type.startswith("EXEC_") and n.type not in ("DIVISION", "PROGRAM"):
            skip = 2 if n.type == "CALL" and n.name else 1
            out += [(t.upper, "ref_data", t.line, i) for t in n.head[skip:] if _OPERAND.match(t.upper) and t.upper not in RESERVED]
    return out


def defects(source: str) -> list[tuple[int, str, str]]:
    """(line, kind, name) of references to labels and, where the text declares data, to names it does not hold;
    of literals without an end, and of statements that were never closed."""
    found = symbols(source)
    labels = {n for n, k, _, _ in found if k in ("paragraph", "section")}
    data = {n for n, k, _, _ in found if k in ("data", "condition", "file")}
    out = [(line, "unresolved label", n) for n, k, line, _ in found if k == "ref_label" and n not in labels]
    if data:
        out += [(line, "unresolved data", n) for n, k, line, _ in found if k == "ref_data" and n not in data]
    ts = tokens(source)
    out += [(t.line, "open literal", t.text[:20]) for t in ts if t.text[0] in "'\"" and (len(t.text) == 1 or t.text[-1] != t.text[0])]
    for verb in ("IF", "EVALUATE", "PERFORM", "EXEC"):
        ends = [t for t in ts if t.upper == f"END-{verb}"]
        starts = [t for t in ts if t.upper == verb]
        if len(ends) > len(starts):
            out.append((ends[-1].line, "end without start", f"END-{verb}"))
    return sorted(set(out))


def rows_of(df: DataFrame, key: str, text: str, make: Callable[[str], Iterable[tuple]], columns: str) -> DataFrame:
    """Rows of `make` for every text that is not null, with the key in front, over Arrow batches.

    columns: names and types (string, int) of the rows."""
    kinds = [(c.split()[0], {"string": pa.string(), "int": pa.int32(), "double": pa.float64(), "boolean": pa.bool_()}[c.split()[1]]) for c in columns.split(", ")]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            owner, rows = [], []
            for i, t in enumerate(batch.column(1).to_pylist()):
                found = list(make(t))
                owner += [i] * len(found)
                rows += found
            cols = list(zip(*rows)) if rows else [()] * len(kinds)
            out = [batch.column(0).take(pa.array(owner, pa.int64())), *[pa.array(c, t) for c, (_, t) in zip(cols, kinds)]]
            yield pa.RecordBatch.from_arrays(out, names=["_key", *[n for n, _ in kinds]])

    texts = df.filter(F.col(text).isNotNull()).select(F.col(key).alias("_key"), F.col(text).alias("_text"))
    return texts.mapInArrow(run, f"_key {dict(texts.dtypes)['_key']}, {columns}").withColumnRenamed("_key", key)
