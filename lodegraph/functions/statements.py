"""Effects of statements on named values, as projections of a row of values.

Values are double columns. Each statement maps a dictionary of columns to a new one, so a sequence of
statements is one projection that Catalyst can optimise; nothing is interpreted row by row.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

State = dict[str, Column]
Statement = Callable[[State], State]


def number(c: Column) -> Column:
    """Number of text as a statement sees it: a comma is a point, blank is 0."""
    t = F.trim(F.regexp_replace(c.cast("string"), ",", "."))
    return F.when(t == "", 0.0).otherwise(t.try_cast("double"))


def move(source: str, *targets: str) -> Statement:
    return lambda s: s | {t: s[source] for t in targets}


def _sum(s: State, names: list[str]) -> Column:
    return reduce(lambda a, b: a + b, [s[n] for n in names])


def add(sources: list[str], targets: list[str], giving: list[str] | None = None) -> Statement:
    """ADD sums all operands, sources and targets, and writes that one sum to every target or GIVING field."""
    return lambda s: s | {t: _sum(s, [*sources, *targets]) for t in (giving or targets)}


def subtract(sources: list[str], targets: list[str]) -> Statement:
    return lambda s: s | {t: s[t] - _sum(s, sources) for t in targets}


def multiply(source: str, targets: list[str]) -> Statement:
    return lambda s: s | {t: s[t] * s[source] for t in targets}


def divide(source: str, targets: list[str]) -> Statement:
    """Division by zero gives null."""
    return lambda s: s | {t: F.try_divide(s[t], s[source]) for t in targets}


def compute(target: str, expression: Callable[[State], Column]) -> Statement:
    return lambda s: s | {target: expression(s)}


def when(condition: Callable[[State], Column], then: list[Statement], otherwise: list[Statement] = ()) -> Statement:
    """IF: every field takes the value of the branch that runs; a null condition runs the second."""

    def run(s: State) -> State:
        a, b, c = sequence(then)(s), sequence(otherwise)(s), F.coalesce(condition(s), F.lit(False))
        return {k: F.when(c, a[k]).otherwise(b[k]) if a[k] is not b[k] else a[k] for k in s}

    return run


def search(cases: list[tuple[Callable[[State], Column], list[Statement]]]) -> Statement:
    """SEARCH: every WHEN that is true runs, in order."""
    return sequence([when(c, body) for c, body in cases])


def evaluate(subject: str, cases: list[tuple[list, list[Statement]]], other: list[Statement] = ()) -> Statement:
    """EVALUATE: the first case whose values hold the subject runs, as a chain of conditions."""
    out: list[Statement] = list(other)
    for values, body in reversed(cases):
        out = [when(lambda s, v=values: s[subject].isin(*v), body, out)]
    return sequence(out)


def sequence(statements: list[Statement]) -> Statement:
    return lambda s: reduce(lambda state, f: f(state), statements, s)


def abbreviated(subject: Column, first: tuple[str, Column], rest: list[tuple[str, str | None, Column]]) -> Column:
    """Abbreviated relation: A > 10 OR 20 repeats the subject and, unless given, the operator."""
    compare = {">": lambda a, b: a > b, "<": lambda a, b: a < b, "=": lambda a, b: a == b, "<>": lambda a, b: a != b, ">=": lambda a, b: a >= b, "<=": lambda a, b: a <= b}
    op, value = first
    out = compare[op](subject, value)
    for link, new_op, v in rest:
        op = new_op or op
        nxt = compare[op](subject, v)
        out = out & nxt if link == "AND" else out | nxt
    return out


def apply(df, fields: dict[str, Column], statements: list[Statement], keep: list[str]):
    """`keep` and the fields' values after the statements."""
    after = sequence(statements)(fields)
    return df.select(*keep, *[after[k].alias(k) for k in fields])
