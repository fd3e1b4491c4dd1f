"""Running statement trees: expressions, an interpreter with a trace, an intermediate form, trees without GO TO.

A program is run within one row of an Arrow batch; runs end after a number of steps that is a parameter, and
say so in their trace. PERFORM loops as the language says, CALL, EXEC and input statements pass through."""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from fractions import Fraction

from lodegraph.functions.text import FIGURATIVE
from lodegraph.operators.cobol import Node, Token, parse, walk

#: Steps after which a run is stopped; its last trace row then is 'limit'.
MAX_STEPS = 10_000
#: Deepest nesting of PERFORMs.
MAX_FRAMES = 200

_RELATIONS = {"=": "eq", "EQUAL": "eq", "EQUALS": "eq", ">": "gt", "GREATER": "gt", "<": "lt", "LESS": "lt", ">=": "ge", "<=": "le", "<>": "ne"}
_CLASSES = {"NUMERIC", "ALPHABETIC", "ALPHABETIC-LOWER", "ALPHABETIC-UPPER", "POSITIVE", "NEGATIVE", "ZERO"}
_NEGATED = {"eq": "ne", "ne": "eq", "gt": "le", "le": "gt", "lt": "ge", "ge": "lt"}
_NUMBER = re.compile(r"[+-]?\d+(\.\d+)?$")


class Reader:
    """Expressions of a statement's words, as nested tuples (operation, operands...)."""

    def __init__(self, words: list[str]):
        self.w, self.i = words, 0

    def at(self, k: int = 0) -> str:
        return self.w[self.i + k] if self.i + k < len(self.w) else ""

    def next(self) -> str:
        self.i += 1
        return self.w[self.i - 1] if self.i <= len(self.w) else ""

    def condition(self) -> tuple:
        """OR of ANDs; a relation without its subject or operator takes those of the relation before."""
        last: dict = {}
        out = self._and(last)
        while self.at() == "OR":
            self.next()
            out = ("or", out, self._and(last))
        return out

    def _and(self, last: dict) -> tuple:
        out = self._not(last)
        while self.at() == "AND":
            self.next()
            out = ("and", out, self._not(last))
        return out

    def _not(self, last: dict) -> tuple:
        if self.at() == "NOT" and self.at(1) not in _RELATIONS:
            self.next()
            return ("not", self._not(last))
        if self.at() == "(":
            mark = self.i
            self.next()
            inner = self.condition()
            if self.at() == ")":
                self.next()
                if self.at() not in _RELATIONS and self.at() not in ("IS", "NOT", "+", "-", "*", "/", "**"):
                    return inner
            self.i = mark
        return self._relation(last)

    def _operator(self) -> str | None:
        mark = self.i
        if self.at() in ("IS", "ARE"):
            self.next()
        negated = self.at() == "NOT"
        if negated:
            self.next()
        op = _RELATIONS.get(self.at())
        if op is None:
            self.i = mark
            return None
        self.next()
        if op in ("gt", "lt") and self.at() == "OR" and self.at(1) == "EQUAL":
            self.i += 2
            op = {"gt": "ge", "lt": "le"}[op]
        if self.at() in ("THAN", "TO"):
            self.next()
        if op in ("gt", "lt") and self.at() == "OR" and self.at(1) == "EQUAL":
            self.i += 2
            op = {"gt": "ge", "lt": "le"}[op]
            if self.at() == "TO":
                self.next()
        return _NEGATED[op] if negated else op

    def _relation(self, last: dict) -> tuple:
        op = self._operator() if last else None
        if op is not None:  # A > 1 AND < 9
            last["op"] = op
            return (op, last["subject"], self.expression())
        left = self.expression()
        if self.at() in ("IS", "NOT") or self.at() in _CLASSES:
            mark, negated = self.i, False
            while self.at() in ("IS", "NOT"):
                negated ^= self.next() == "NOT"
            if self.at() in _CLASSES:
                test = ("is", left, self.next())
                return ("not", test) if negated else test
            self.i = mark
        op = self._operator()
        if op is not None:
            last |= {"subject": left, "op": op}
            return (op, left, self.expression())
        if last and left[0] == "value":  # A > 10 OR 20
            return (last["op"], last["subject"], left)
        return ("name", left)

    def expression(self) -> tuple:
        out = self._product()
        while self.at() in ("+", "-"):
            out = ("add" if self.next() == "+" else "subtract", out, self._product())
        return out

    def _product(self) -> tuple:
        out = self._power()
        while self.at() in ("*", "/"):
            out = ("multiply" if self.next() == "*" else "divide", out, self._power())
        return out

    def _power(self) -> tuple:
        out = self._unit()
        if self.at() == "**":
            self.next()
            out = ("power", out, self._power())
        return out

    def _unit(self) -> tuple:
        w = self.next()
        if w == "(":
            out = self.expression()
            if self.at() == ")":
                self.next()
            return out
        if w in ("-", "+"):
            unit = self._unit()
            return ("subtract", ("value", "0"), unit) if w == "-" else unit
        if w == "FUNCTION":  # intrinsic functions stand for a constant
            self.next()
            self._arguments()
            return ("value", "1")
        if not w or w[0] in "'\"" or _NUMBER.match(w) or w in FIGURATIVE:
            return ("value", w or "0")
        while self.at() in ("OF", "IN"):
            self.i += 2
        return ("ref", w, *self._arguments())

    def _arguments(self) -> list[tuple]:
        out = []
        if self.at() == "(":
            self.next()
            while self.at() and self.at() != ")":
                if self.at() in (",", ":"):
                    self.next()
                    continue
                out.append(self.expression())
            self.next()
        return out


def said(e: tuple) -> str:
    """An expression as text: and(eq(ref('A'), primitive(1)), ...)."""
    if e[0] == "value":
        return f"primitive({e[1]})"
    if e[0] == "ref":
        return f"ref('{e[1]}'{''.join(', ' + said(x) for x in e[2:])})"
    return f"{e[0]}({', '.join(said(x) if isinstance(x, tuple) else x for x in e[1:])})"


class Stop(Exception):
    pass


class Jump(Exception):
    def __init__(self, label: str):
        self.label = label


class NextSentence(Exception):
    pass


class Leave(Exception):
    """EXIT PARAGRAPH, SECTION or PERFORM."""

    def __init__(self, what: str):
        self.what = what


@dataclass
class Machine:
    """Runs one program; trace rows are (step, node id, type, detail)."""

    root: Node
    max_steps: int = MAX_STEPS
    breakpoints: frozenset[str] = frozenset()
    values: dict[str, str | Fraction] = field(default_factory=dict)
    trace: list[tuple[int, str, str, str]] = field(default_factory=list)
    frames: int = 0

    def __post_init__(self) -> None:
        self.ids = {id(n): i for i, _, _, n in walk(self.root)}
        self.conditions: dict[str, tuple[str, list[str]]] = {}
        self.numeric: set[str] = set()
        self.blocks: list[Node] = []
        self.sections: dict[str, tuple[int, int]] = {}
        self.dispatch: dict[str, Node] = {}
        owner = ""
        loose: list[Node] = []
        for _, _, _, n in walk(self.root):
            words = n.words()
            if n.type == "DATA":
                owner = n.name
                if any(w in ("PIC", "PICTURE") and re.match(r"[S9V]", words[k + 1]) for k, w in enumerate(words[:-1])):
                    self.numeric.add(n.name)
                if "VALUE" in words[:-1]:
                    self.store(n.name, self.plain(words[words.index("VALUE") + 1 + (words[words.index("VALUE") + 1] == "IS")]))
            elif n.type == "DATA_88":
                at = next((k for k, w in enumerate(words) if w in ("VALUE", "VALUES")), len(words))
                self.conditions[n.name] = (owner, [w for w in words[at + 1 :] if w not in ("IS", "ARE", ",")])
            elif n.type == "DISPATCH":
                self.dispatch[n.name] = n
        homes = [d for d in self.root.children if d.name == "PROCEDURE"] or [self.root]
        for n in homes[0].children:
            if n.type == "SECTION":
                start = len(self.blocks)
                kids = [k for k in n.children if k.type != "PARAGRAPH"]
                if kids:
                    self.blocks.append(Node("PARAGRAPH", n.name, [], kids))
                self.blocks += [k for k in n.children if k.type == "PARAGRAPH"]
                self.sections[n.name] = (start, len(self.blocks) - 1)
            elif n.type == "PARAGRAPH":
                self.blocks.append(n)
            elif n.type == "SENTENCE":
                if not self.blocks:
                    self.blocks.append(Node("PARAGRAPH", "", [], loose))
                loose.append(n)
        self.at = {}
        for k, b in enumerate(self.blocks):
            self.at.setdefault(b.name, k)

    # values

    def plain(self, w: str) -> str | Fraction:
        if w in FIGURATIVE:
            w = FIGURATIVE[w]
            return Fraction(w) if _NUMBER.match(w) else w
        if w[:1] in ("'", '"'):
            return w.strip(w[0]).replace(w[0] * 2, w[0])
        return Fraction(w) if _NUMBER.match(w) else w

    def store(self, name: str, value: str | Fraction) -> None:
        if name in self.numeric and not isinstance(value, Fraction):
            value = Fraction(value.strip()) if _NUMBER.match(value.strip() or "x") else Fraction(0)
        self.values[name] = value

    def value(self, e: tuple) -> str | Fraction:
        if e[0] == "value":
            return self.plain(e[1])
        if e[0] == "ref":
            key = e[1] if len(e) == 2 else f"{e[1]}({','.join(shown(self.value(x)) for x in e[2:])})"
            return self.values.get(key, self.values.get(e[1], Fraction(0) if e[1] in self.numeric else ""))
        a, b = (self.number(x) for x in e[1:])
        if e[0] == "divide":
            return a / b if b else Fraction(0)
        if e[0] == "power":
            return a ** int(b) if a or b >= 0 else Fraction(0)
        return {"add": a + b, "subtract": a - b, "multiply": a * b}[e[0]]

    def number(self, e: tuple) -> Fraction:
        v = self.value(e)
        return v if isinstance(v, Fraction) else Fraction(v.strip()) if _NUMBER.match(v.strip() or "x") else Fraction(0)

    def holds(self, e: tuple) -> bool:
        op = e[0]
        if op in ("and", "or"):
            return (self.holds(e[1]) and self.holds(e[2])) if op == "and" else (self.holds(e[1]) or self.holds(e[2]))
        if op == "not":
            return not self.holds(e[1])
        if op == "name":
            return self.named(e[1])
        if op == "is":
            v = self.value(e[1])
            if e[2] in ("POSITIVE", "NEGATIVE", "ZERO"):
                n = self.number(e[1])
                return n > 0 if e[2] == "POSITIVE" else n < 0 if e[2] == "NEGATIVE" else n == 0
            s = shown(v)
            return bool(_NUMBER.match(s.strip() or "x")) if e[2] == "NUMERIC" else bool(re.fullmatch({"ALPHABETIC": "[A-Za-z ]*", "ALPHABETIC-LOWER": "[a-z ]*", "ALPHABETIC-UPPER": "[A-Z ]*"}[e[2]], s))
        return compared(op, self.value(e[1]), self.value(e[2]))

    def named(self, e: tuple) -> bool:
        if e[0] == "ref" and e[1] in self.conditions:
            owner, values = self.conditions[e[1]]
            v = self.values.get(owner, Fraction(0) if owner in self.numeric else "")
            k = 0
            while k < len(values):
                if k + 2 < len(values) and values[k + 1] in ("THRU", "THROUGH"):
                    if compared("ge", v, self.plain(values[k])) and compared("le", v, self.plain(values[k + 2])):
                        return True
                    k += 3
                    continue
                if compared("eq", v, self.plain(values[k])):
                    return True
                k += 1
            return False
        v = self.value(e)
        return v in ("TRUE", "true") or (isinstance(v, Fraction) and v != 0)

    # control

    def note(self, n: Node, detail: str = "") -> None:
        if len(self.trace) >= self.max_steps:
            self.trace.append((len(self.trace), self.ids.get(id(n), ""), "limit", ""))
            raise Stop
        self.trace.append((len(self.trace), self.ids.get(id(n), ""), n.type, detail))
        if n.name and n.name in self.breakpoints or self.ids.get(id(n), "") in self.breakpoints:
            self.trace.append((len(self.trace), self.ids.get(id(n), ""), "break", ", ".join(f"{k}={shown(v)}" for k, v in sorted(self.values.items()))))

    def run(self) -> Machine:
        try:
            if "" in self.dispatch:
                self.dispatched(self.dispatch[""])
            elif self.blocks:
                self.range(0, len(self.blocks) - 1)
        except (Stop, Leave):
            pass
        except Jump as j:
            self.trace.append((len(self.trace), "", "lost", j.label))
        return self

    def range(self, first: int, last: int) -> None:
        k = first
        while k <= last:
            try:
                self.block(self.blocks[k])
                k += 1
            except Jump as j:
                to = self.at.get(j.label, self.sections.get(j.label, (None,))[0])
                if to is None or not first <= to <= last:
                    raise
                k = to

    def block(self, b: Node) -> None:
        self.note(b, b.name)
        for s in b.children:
            try:
                self.body(s.children if s.type == "SENTENCE" else [s])
            except NextSentence:
                continue
            except Leave as e:
                if e.what not in ("PARAGRAPH", "SECTION"):
                    raise
                return

    def body(self, statements: list[Node]) -> None:
        for n in statements:
            self.statement(n)

    def limits(self, n: Node) -> tuple[int, int] | None:
        words = [w for w in n.words()[1:] if w != ","]
        last = words[2] if len(words) > 2 and words[1] in ("THRU", "THROUGH") else words[0] if words else ""
        a, b = (self.sections.get(x, (self.at.get(x), self.at.get(x))) for x in (words[0] if words else "", last))
        return None if a[0] is None or b[1] is None else (a[0], b[1])

    def loop(self, n: Node, once) -> None:
        words = n.words()
        if "TIMES" in words:
            for _ in range(int(self.number(Reader(words[words.index("TIMES") - 1 :]).expression()))):
                once()
            return
        if "UNTIL" not in words:
            once()
            return
        after = "AFTER" in words and words[words.index("AFTER") - 1] == "TEST"
        loops = []
        start = words.index("VARYING") if "VARYING" in words else None
        if start is None:
            loops.append((None, None, None, Reader(words[words.index("UNTIL") + 1 :]).condition()))
        else:
            r = Reader(words[start:])
            while r.at() in ("VARYING", "AFTER"):
                r.next()
                var = r.expression()
                r.next()
                low = r.expression()
                r.next()
                by = r.expression()
                r.next()
                loops.append((var[1], low, by, r.condition()))

        def turn(k: int) -> None:
            if k == len(loops):
                once()
                return
            var, low, by, until = loops[k]
            if var is not None:
                self.store(var, self.value(low))
            while after or not self.holds(until):
                turn(k + 1)
                if after and self.holds(until):
                    break
                if var is not None:
                    self.store(var, self.number(("ref", var)) + self.number(by))
                if len(self.trace) > self.max_steps:
                    raise Stop
                if k == len(loops) - 1 and not n.children and not n.name:
                    self.note(n, "empty")

        turn(0)

    def statement(self, n: Node) -> None:
        words = n.words()
        detail = ""
        if n.type == "DISPLAY":
            parts, r = [], Reader([w for w in words[1:] if w not in (",",)])
            while r.at() and r.at() not in ("UPON", "WITH", "NO"):
                parts.append(shown(self.value(r.expression())))
            detail = "".join(parts)
        self.note(n, detail)
        act = getattr(self, f"_{n.type.lower().replace('-', '_')}", None)
        if act:
            act(n, words)

    def _move(self, n: Node, words: list[str]) -> None:
        r = Reader([w for w in words[1:] if w not in ("CORRESPONDING", "CORR", ",")])
        v = self.value(r.expression())
        self.targets(r, "TO", lambda name: v)

    def targets(self, r: Reader, lead: str, new) -> None:
        if r.at() == lead:
            r.next()
        while r.at():
            if r.at() in ("ROUNDED", ","):
                r.next()
                continue
            e = r.expression()
            if e[0] != "ref":
                return
            name = e[1] if len(e) == 2 else f"{e[1]}({','.join(shown(self.value(x)) for x in e[2:])})"
            v = new(e)
            self.store(name, v)

    def _set(self, n: Node, words: list[str]) -> None:
        names = words[1 : words.index("TO")] if "TO" in words else []
        to = words[words.index("TO") + 1 :] if "TO" in words else []
        for name in names:
            if name in self.conditions and to[:1] == ["TRUE"]:
                self.store(self.conditions[name][0], self.plain(self.conditions[name][1][0]))
            elif to:
                self.store(name, self.value(Reader(to).expression()))

    def _compute(self, n: Node, words: list[str]) -> None:
        if "=" in words:
            at = words.index("=")
            v = self.value(Reader(words[at + 1 :]).expression())
            for w in words[1:at]:
                if w not in ("ROUNDED", ","):
                    self.store(w, v)

    def arithmetic(self, words: list[str], lead: tuple[str, ...], fold) -> None:
        r = Reader([w for w in words[1:] if w not in (",", "ROUNDED")])
        left = []
        while r.at() and r.at() not in (*lead, "GIVING"):
            left.append(self.number(r.expression()))
        olds, names = [], []
        if r.at() in lead:
            r.next()
            while r.at() and r.at() not in ("GIVING", "REMAINDER", "ON", "SIZE"):
                e = r.expression()
                names.append(e)
                olds.append(self.number(e))
        if r.at() == "GIVING":
            r.next()
            v = fold(left, olds[0] if olds else None)
            while r.at() and r.at() not in ("REMAINDER", "ON", "SIZE"):
                e = r.expression()
                if e[0] == "ref":
                    self.store(e[1], v)
        else:
            for e, old in zip(names, olds):
                if e[0] == "ref":
                    self.store(e[1], fold(left, old))

    def _add(self, n: Node, words: list[str]) -> None:
        self.arithmetic(words, ("TO",), lambda left, old: sum(left, Fraction(0)) + (old or 0))

    def _subtract(self, n: Node, words: list[str]) -> None:
        self.arithmetic(words, ("FROM",), lambda left, old: (old or 0) - sum(left, Fraction(0)))

    def _multiply(self, n: Node, words: list[str]) -> None:
        self.arithmetic(words, ("BY",), lambda left, old: left[0] * (old if old is not None else 1))

    def _divide(self, n: Node, words: list[str]) -> None:
        into = "INTO" in words
        self.arithmetic(words, ("INTO", "BY"), lambda left, old: Fraction(0) if not (left[0] if into else old) else old / left[0] if into else left[0] / old)

    def _if_branch(self, n: Node, words: list[str]) -> None:
        yes = self.holds(Reader(words[1:]).condition())
        for b in n.children:
            if (b.type == "THEN") == yes:
                self.body(b.children)

    def _evaluate(self, n: Node, words: list[str]) -> None:
        subjects = split(words[1:])
        whens = [c for c in n.children if c.type == "EVALUATE_BRANCH"]
        for k, c in enumerate(whens):
            objects = split([w for w in c.words()[1:]])
            if all(self.matches(s, o) for s, o in zip(subjects, objects)):
                while not c.children and k + 1 < len(whens):  # WHEN 1 WHEN 2 share a body
                    k += 1
                    c = whens[k]
                self.body(c.children)
                return

    def matches(self, subject: list[str], wanted: list[str]) -> bool:
        if wanted[:1] in (["OTHER"], ["ANY"]):
            return True
        if subject in (["TRUE"], ["FALSE"]):
            return self.holds(Reader(wanted).condition()) == (subject == ["TRUE"])
        negated = wanted[:1] == ["NOT"]
        wanted = wanted[negated:]
        v = self.value(Reader(subject).expression())
        for mark in ("THRU", "THROUGH"):
            if mark in wanted:
                k = wanted.index(mark)
                low, high = (self.value(Reader(x).expression()) for x in (wanted[:k], wanted[k + 1 :]))
                return (compared("ge", v, low) and compared("le", v, high)) != negated
        return compared("eq", v, self.value(Reader(wanted).expression())) != negated

    def _search(self, n: Node, words: list[str]) -> None:
        hit = False
        for c in n.children:
            if c.type == "SEARCH_WHEN" and self.holds(Reader(c.words()[1:]).condition()):
                hit = True
                self.body(c.children)
        if not hit:
            for c in n.children:
                if c.type == "AT_END":
                    self.body(c.children)

    def _perform(self, n: Node, words: list[str]) -> None:
        if self.dispatch:
            to = self.dispatch.get(span(n))
            self.framed(n, lambda: to and self.dispatched(to))
            return
        limits = self.limits(n)
        if limits:
            self.framed(n, lambda: self.range(*limits))

    def framed(self, n: Node, once) -> None:
        if self.frames >= MAX_FRAMES:
            raise Stop
        self.frames += 1
        try:
            self.loop(n, once)
        finally:
            self.frames -= 1

    def _perform_inline(self, n: Node, words: list[str]) -> None:
        try:
            self.loop(n, lambda: self.body(n.children))
        except Leave as e:
            if e.what != "PERFORM":
                raise

    def _goto(self, n: Node, words: list[str]) -> None:
        if "DEPENDING" in words:
            at = words.index("DEPENDING")
            labels = [w for w in words[1:at] if w not in ("TO", ",")]
            k = int(self.number(Reader([w for w in words[at + 1 :] if w != "ON"]).expression()))
            if 1 <= k <= len(labels):
                raise Jump(labels[k - 1])
            return
        raise Jump(n.name)

    def _next_sentence(self, n: Node, words: list[str]) -> None:
        raise NextSentence

    def _exit(self, n: Node, words: list[str]) -> None:
        if words[1:2] == ["PROGRAM"]:
            raise Stop
        if words[1:2] and words[1] in ("PARAGRAPH", "SECTION", "PERFORM"):
            raise Leave(words[1])

    def _stop_run(self, n: Node, words: list[str]) -> None:
        raise Stop

    def _goback(self, n: Node, words: list[str]) -> None:
        raise Stop

    # trees without GO TO

    def dispatched(self, d: Node) -> None:
        cases = {c.name: k for k, c in enumerate(d.children)}
        self.values[LABEL] = d.children[0].name if d.children else ""
        while (at := cases.get(str(self.values.get(LABEL, "")))) is not None:
            case = d.children[at]
            self.note(case, case.name)
            self.values[JUMPED] = Fraction(0)
            try:
                self.body(case.children)
            except Leave as e:
                if e.what not in ("PARAGRAPH", "SECTION"):
                    raise
            if not self.values[JUMPED]:
                self.values[LABEL] = d.children[at + 1].name if at + 1 < len(d.children) else ""

    def _set_label(self, n: Node, words: list[str]) -> None:
        if words:  # GO TO ... DEPENDING ON
            try:
                self._goto(n, words)
                return
            except Jump as j:
                self.values[LABEL] = j.label
        else:
            self.values[LABEL] = n.name
        self.values[JUMPED] = Fraction(1)

    def _guard(self, n: Node, words: list[str]) -> None:
        if not self.values.get(JUMPED):
            self.body(n.children)


#: Variables of trees without GO TO: the label to go on at, and whether a jump is under way.
LABEL, JUMPED = "NEXT-LABEL", "JUMPED"


def split(words: list[str]) -> list[list[str]]:
    out: list[list[str]] = [[]]
    for w in words:
        if w == "ALSO":
            out.append([])
        else:
            out[-1].append(w)
    return out


def shown(v: str | Fraction) -> str:
    if isinstance(v, Fraction):
        return str(v.numerator) if v.denominator == 1 else f"{float(v):.10g}"
    return v


def compared(op: str, a: str | Fraction, b: str | Fraction) -> bool:
    if isinstance(a, Fraction) != isinstance(b, Fraction):
        text, number = (a, b) if isinstance(b, Fraction) else (b, a)
        if _NUMBER.match(text.strip() or "x"):
            a, b = (Fraction(x.strip()) if isinstance(x, str) else x for x in (a, b))
        else:
            a, b = (x if isinstance(x, str) else shown(x) for x in (a, b))
    if isinstance(a, str):
        a, b = a.rstrip(), b.rstrip()
    return {"eq": a == b, "ne": a != b, "lt": a < b, "le": a <= b, "gt": a > b, "ge": a >= b}[op]


def traced(source: str, max_steps: int = MAX_STEPS) -> list[tuple[int, str, str, str]]:
    """(step, node_id, type, detail) of a run of one text; detail: what DISPLAY shows, the name of a paragraph."""
    return Machine(parse(source), max_steps).run().trace


def span(n: Node) -> str:
    words = [w for w in n.words()[1:] if w != ","]
    return f"{words[0]}..{words[2]}" if len(words) > 2 and words[1] in ("THRU", "THROUGH") else f"{words[0]}..{words[0]}" if words else ""


def without_gotos(root: Node) -> Node:
    """The program as one dispatch loop per range that runs: the whole, and every range that is performed.

    A jump sets the label to go on at and skips, by guards, the rest of what encloses it; a range whose
    label is not among its own ends, and the range around it goes on there. The result has no GO TO,
    whatever the shape of the flow, and grows with the source only: a paragraph comes once per range."""
    m = Machine(root)
    ranges = {"": (0, len(m.blocks) - 1)} if m.blocks else {}
    for _, _, _, n in walk(root):
        if n.type == "PERFORM" and (limits := m.limits(n)):
            ranges[span(n)] = limits

    def plain(statements: list[Node]) -> tuple[list[Node], bool]:
        out: list[Node] = []
        for k, n in enumerate(statements):
            copy, jumps = rewritten(n)
            out.append(copy)
            if jumps and k + 1 < len(statements):
                rest, _ = plain(statements[k + 1 :])
                out.append(Node("GUARD", "", [], rest, statements[k + 1].line_start, statements[-1].line_end))
                return out, True
            if jumps:
                return out, True
        return out, False

    def rewritten(n: Node) -> tuple[Node, bool]:
        if n.type == "GOTO":
            return Node("SET_LABEL", n.name, n.head if "DEPENDING" in n.words() else [], [], n.line_start, n.line_end), True
        if n.type == "NEXT_SENTENCE":
            return n, False
        copy = Node(n.type, n.name, list(n.head), [], n.line_start, n.line_end)
        jumps = n.type == "PERFORM"  # a performed range may leave through a jump
        if n.type in ("IF_BRANCH", "EVALUATE", "SEARCH") or any(c.type in ("THEN", "PHRASE") for c in n.children):
            for c in n.children:
                body, j = plain(c.children)
                copy.children.append(Node(c.type, c.name, list(c.head), body, c.line_start, c.line_end))
                jumps |= j
        else:
            copy.children, j = plain(n.children)
            jumps |= j
            if n.type in ("PERFORM_INLINE",) and j:  # the loop ends once a jump is under way
                at = next((k for k, t in enumerate(copy.head) if t.upper == "UNTIL"), None)
                if at is not None:
                    line = n.line_start
                    more = [Token(w, line) for w in (JUMPED, "=", "1", "OR")]
                    copy.head = copy.head[: at + 1] + more + copy.head[at + 1 :]
                else:
                    copy.children = [Node("GUARD", "", [], copy.children, n.line_start, n.line_end)]
        if n.type == "PERFORM" and "UNTIL" in copy.words():
            at = next(k for k, t in enumerate(copy.head) if t.upper == "UNTIL")
            copy.head = copy.head[: at + 1] + [Token(w, n.line_start) for w in (JUMPED, "=", "1", "OR")] + copy.head[at + 1 :]
        return copy, jumps

    out = Node("PROGRAM", root.name, [], [d for d in root.children if d.name == "DATA" or d.type == "DATA"], root.line_start, root.line_end)
    for name, (a, b) in ranges.items():
        cases = []
        for k in range(a, b + 1):
            block = m.blocks[k]
            flat = [s for x in block.children for s in ([x] if x.type != "SENTENCE" else [Node("SENTENCE", "", [], x.children, x.line_start, x.line_end)])]
            body, _ = sentences(flat, plain)
            cases.append(Node("CASE", block.name or f"#{k}", [], body, block.line_start, block.line_end))
        out.children.append(Node("DISPATCH", name, [], cases, root.line_start, root.line_end))
    return out


def sentences(flat: list[Node], plain) -> tuple[list[Node], bool]:
    """Sentences one after another: behind one that may jump, the others are guarded."""
    out: list[Node] = []
    for k, s in enumerate(flat):
        body, jumps = plain(s.children)
        out.append(Node("SENTENCE", "", [], body, s.line_start, s.line_end))
        if jumps and k + 1 < len(flat):
            rest, _ = sentences(flat[k + 1 :], plain)
            out.append(Node("GUARD", "", [], rest, flat[k + 1].line_start, flat[-1].line_end))
            return out, True
        if jumps:
            return out, True
    return out, False


def _sentence(self: Machine, n: Node, words: list[str]) -> None:
    try:
        self.body(n.children)
    except NextSentence:
        pass


Machine._sentence = _sentence  # type: ignore[attr-defined]


def restructured(source: str) -> list[tuple[str, str, int, str, str, str]]:
    """(id, parent_id, depth, type, name, text) of the program without GO TO."""
    return [(i, p, d, n.type, n.name, n.text) for i, p, d, n in walk(without_gotos(parse(source)))]


def ir_rows(source: str) -> list[tuple[str, str, str, str]]:
    """(id, parent_id, kind, text): the intermediate form of every statement, expressions in function notation."""
    out = []
    for i, p, _, n in walk(parse(source)):
        w = n.words()
        if n.type in ("PROGRAM", "DIVISION", "DATA", "DATA_88", "FILE"):
            continue
        if n.type in ("SECTION", "PARAGRAPH", "SENTENCE", "THEN", "ELSE", "PHRASE"):
            kind, text = ("labelled_block", n.name) if n.name else ("block", n.type.lower())
        elif n.type == "IF_BRANCH":
            kind, text = "if", said(Reader(w[1:]).condition())
        elif n.type == "EVALUATE":
            kind, text = "select", " also ".join(said(Reader(s).expression()) for s in split(w[1:]))
        elif n.type in ("EVALUATE_BRANCH", "SEARCH_WHEN", "AT_END"):
            kind, text = "when", " ".join(w[1:])
        elif n.type == "GOTO":
            kind, text = "jump", f"jump(loc({n.name}))" if n.name and "DEPENDING" not in w else " ".join(w)
        elif n.type == "PERFORM":
            kind, text = "jump", f"call(loc({span(n)}))" + (f" until {said(Reader(w[w.index('UNTIL') + 1 :]).condition())}" if "UNTIL" in w else "")
        elif n.type == "PERFORM_INLINE":
            kind, text = "loop", said(Reader(w[w.index("UNTIL") + 1 :]).condition()) if "UNTIL" in w else " ".join(w[1:])
        elif n.type == "MOVE" and "TO" in w:
            at = w.index("TO")
            kind, text = "set", "; ".join(f"set(ref('{x}'), {said(Reader(w[1:at]).expression())})" for x in w[at + 1 :] if re.match("[A-Z]", x))
        elif n.type == "COMPUTE" and "=" in w:
            at = w.index("=")
            kind, text = "set", "; ".join(f"set(ref('{x}'), {said(Reader(w[at + 1 :]).expression())})" for x in w[1:at] if re.match("[A-Z]", x) and x != "ROUNDED")
        elif n.type == "DISPLAY":
            kind, text = "print", f"print({' '.join(w[1:])})"
        elif n.type in ("STOP_RUN", "GOBACK"):
            kind, text = "exit", "exit()"
        elif n.type in ("CONTINUE", "EXIT", "NEXT_SENTENCE"):
            kind, text = "jump" if n.type == "NEXT_SENTENCE" else "noop", n.type.lower()
        else:
            kind, text = "statement", n.text
        out.append((i, p, kind, text))
    return out
