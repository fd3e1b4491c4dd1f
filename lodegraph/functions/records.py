"""Fixed-layout records: PIC clauses, zoned and packed decimals, EBCDIC, overlapping and repeating fields.

Encoders and decoders are Column expressions over hexadecimal text and binaries, so records are read and
written in the JVM.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Picture:
    """A PIC clause: text, zoned or packed; digits left and right of the point; size in bytes."""

    kind: str
    left: int
    right: int
    signed: bool

    @property
    def size(self) -> int:
        return (self.left + self.right) // 2 + 1 if self.kind == "packed" else self.left + self.right


def parse_picture(pic: str, usage: str = "") -> Picture:
    """Picture of a clause like X(5), S9(7)V99 with usage '' or COMP-3. Raises ValueError on others."""
    text = re.sub(r"(.)\((\d+)\)", lambda m: m[1] * int(m[2]), pic.upper().rstrip("."))
    if re.fullmatch(r"[XA]+", text):
        return Picture("text", len(text), 0, False)
    m = re.fullmatch(r"(S?)(9*)(?:V(9*))?", text)
    if not m or not (m[2] or m[3]):
        raise ValueError(f"unknown picture: {pic}")
    if usage.upper() in ("COMP-1", "COMP-2"):
        raise ValueError("floating point fields have no picture")
    return Picture("packed" if usage.upper() in ("COMP-3", "PACKED-DECIMAL") else "zoned", len(m[2]), len(m[3] or ""), bool(m[1]))


def align_decimal(c: Column, left: int, right: int) -> Column:
    """Digits of a decimal number aligned at its point: integer digits cut and padded on the left, fraction
    digits on the right, nothing rounded. A sign is left out."""
    t = F.regexp_replace(c, r"^[+-]", "")
    whole, frac = F.regexp_extract(t, r"^(\d*)", 1), F.regexp_extract(t, r"\.(\d*)$", 1)
    parts = []
    if left:
        parts.append(F.right(F.concat(F.lit("0" * left), whole), F.lit(left)))
    if right:
        parts.append(F.left(F.concat(frac, F.lit("0" * right)), F.lit(right)))
    return F.concat(*parts)


def adjust_text(c: Column, size: int) -> Column:
    """Text of exactly `size` characters: cut or padded on the right."""
    return F.rpad(F.left(c, F.lit(size)), size, " ")


def plain(c: Column, scale: int) -> Column:
    """A number as plain decimal text with enough digits."""
    return c.cast(f"decimal(38,{scale})").cast("string")


def encode_zoned(c: Column, p: Picture) -> Column:
    """Hexadecimal zoned decimal of decimal text: F0..F9, the last zone C or D for a signed field."""
    digits = align_decimal(c, p.left, p.right)
    n = p.left + p.right
    zone = F.when(F.startswith(c, F.lit("-")), "D").otherwise("C") if p.signed else F.lit("F")
    head = F.regexp_replace(F.left(digits, F.lit(n - 1)), r"(\d)", "F$1") if n > 1 else F.lit("")
    return F.concat(head, zone, F.right(digits, F.lit(1)))


def decode_zoned(h: Column, p: Picture) -> Column:
    """Number of a hexadecimal zoned decimal. A digit nibble above 9 carries over into the next place."""
    n = p.left + p.right
    value = F.lit(0).cast("decimal(38,0)")
    for i in range(n):
        nibble = F.conv(F.substring(h, 2 * i + 2, 1), 16, 10).cast("decimal(38,0)")
        value = value + nibble * F.lit(10 ** (n - 1 - i)).cast("decimal(38,0)")
    sign = F.when(F.substring(h, 2 * n - 1, 1) == "D", -1).otherwise(1)
    return (value * sign).cast("double") / 10**p.right


def overflow_digits(c: Column, n: int) -> Column:
    """Value of zoned digits written 0-9 and A-F, where a letter counts nine and its place in the alphabet
    in units of its position."""
    total = F.lit(0)
    for i in range(n):
        ch = F.upper(F.substring(c, i + 1, 1))
        unit = F.lit(10 ** (n - 1 - i))
        total = total + F.when(ch.rlike("[A-F]"), (9 + F.ascii(ch) - 64) * unit).otherwise(F.coalesce(ch.try_cast("int"), F.lit(0)) * unit)
    return total


def encode_packed(c: Column, p: Picture) -> Column:
    """Hexadecimal packed decimal: digits, then the sign nibble C, D or F, padded to whole bytes."""
    sign = F.when(F.startswith(c, F.lit("-")), "D").otherwise("C") if p.signed else F.lit("F")
    body = F.concat(align_decimal(c, p.left, p.right), sign)
    return F.lpad(body, 2 * p.size, "0")


def decode_packed(h: Column, p: Picture) -> Column:
    """Number of a packed decimal, exact for even and odd numbers of digits."""
    n = 2 * p.size
    digits = F.substring(h, 1, n - 1).cast("decimal(38,0)")
    return (digits * F.when(F.substring(h, n, 1) == "D", -1).otherwise(1)).cast("double") / 10**p.right


#: Built from the code page's rule in Python's codecs: the 256 characters of EBCDIC code page 037.
_EBCDIC = bytes(range(256)).decode("cp037")
_LATIN = bytes(range(256)).decode("latin-1")


def to_ebcdic(c: Column) -> Column:
    """Hexadecimal EBCDIC (code page 037) of text in Latin-1."""
    shifted = F.translate(c, _EBCDIC, _LATIN)
    return F.hex(F.encode(shifted, "ISO-8859-1"))


def from_ebcdic(h: Column) -> Column:
    return F.translate(F.decode(F.unhex(h), "ISO-8859-1"), _LATIN, _EBCDIC)


def view(record: Column, offset: int, size: int) -> Column:
    """Hexadecimal bytes of a field in a hexadecimal record; overlapping views redefine one another."""
    return F.substring(record, 2 * offset + 1, 2 * size)


def occurs(record: Column, offset: int, size: int, times: int) -> Column:
    """array of the views of a repeating field."""
    return F.array(*[view(record, offset + i * size, size) for i in range(times)])


def occurrence(items: Column, index: Column) -> Column:
    """Item at a 1-based subscript; null outside the table's bounds."""
    return F.try_element_at(items, index)
