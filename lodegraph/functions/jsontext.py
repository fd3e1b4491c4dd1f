"""Reading of JSON text that the JVM's parser refuses: any depth, repeated members, NaN, raw control characters.

The reader keeps a stack of its own, so nesting is not limited. Numbers stay as they are written."""

from __future__ import annotations

import json
import re

_TOKEN = re.compile(r'[\s\ufeff]*+(?:([{}\[\],:])|"((?:[^"\\]++|\\.)*+)"|(-?(?:Infinity|\d+(?:\.\d+)?(?:[eE][+-]?\d+)?)|NaN|true|false|null))', re.S)
_CONSTANTS = {"true": True, "false": False, "null": None}


class Number(str):
    """A number as written."""


def _unescaped(body: str) -> str:
    return json.loads(f'"{body}"', strict=False) if "\\" in body else body


def read(text: str):
    """The value of JSON text; of repeated members the last counts. ValueError where text is no JSON.

    A text that is a JSON string holding JSON is read once more, as often as it is so."""
    value = _read(text)
    while isinstance(value, str) and not isinstance(value, Number):
        inner = value.strip()
        if inner[:1] not in ("{", "[", '"'):
            break
        value = _read(inner)
    return value


def _read(text: str):
    root: list = []
    stack: list = [root]
    names: list = [None]
    want, at, end = "value", 0, len(text.rstrip())
    while at < end:
        m = _TOKEN.match(text, at)
        if m is None:
            raise ValueError(f"no JSON at {at}")
        at = m.end()
        mark, body, word = m.groups()
        top = stack[-1]
        if mark in ("}", "]"):
            if len(stack) == 1 or isinstance(top, dict) != (mark == "}") or want not in ("next", "first"):
                raise ValueError(f"unexpected {mark}")
            stack.pop()
            names.pop()
            want = "next"
        elif mark == ",":
            if want != "next" or len(stack) == 1:
                raise ValueError("unexpected ,")
            want = "name" if isinstance(top, dict) else "value"
        elif mark == ":":
            if want != "colon":
                raise ValueError("unexpected :")
            want = "value"
        elif isinstance(top, dict) and want in ("name", "first"):
            if body is None:
                raise ValueError("a name is missing")
            names[-1] = _unescaped(body)
            want = "colon"
        else:
            if want not in ("value", "first"):
                raise ValueError("unexpected value")
            value = {} if mark == "{" else [] if mark == "[" else _unescaped(body) if body is not None else _CONSTANTS[word] if word in _CONSTANTS else Number(word)
            if isinstance(top, dict):
                top[names[-1]] = value
            else:
                top.append(value)
            want = "next"
            if mark:
                stack.append(value)
                names.append(None)
                want = "first"
    if len(stack) != 1 or len(root) != 1:
        raise ValueError("text ends early")
    return root[0]


def write(value) -> str:
    """Compact JSON with sorted members, numbers as they were read; without recursion."""
    out: list[str] = []
    todo: list = [value]
    while todo:
        x = todo.pop()
        if isinstance(x, _Text):
            out.append(x)
        elif isinstance(x, dict):
            todo.append(_Text("}"))
            members = sorted(x.items(), reverse=True)
            for i, (k, v) in enumerate(members):
                todo += [v, _Text(("," if i < len(members) - 1 else "") + json.dumps(k, ensure_ascii=False) + ":")]
            out.append("{")
        elif isinstance(x, list):
            todo.append(_Text("]"))
            for i in range(len(x) - 1, -1, -1):
                todo.append(x[i])
                if i:
                    todo.append(_Text(","))
            out.append("[")
        else:
            out.append(x if isinstance(x, Number) else json.dumps(x, ensure_ascii=False))
    return "".join(out)


class _Text(str):
    """Text that `write` has made already."""
