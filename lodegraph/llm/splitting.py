"""Splitting oversized texts at natural boundaries by pointer doubling.

A cut lies behind a word. Every possible cut is joined to its farthest legal successor: the last natural
boundary that the next piece, which starts `overlap` words before the cut, can reach within the limit.
The table of successors is then squared until no cut moves, and with each squaring the cuts known so far
are joined to it, which doubles them. All texts of an Arrow batch share one table, so the number of rounds
is the logarithm of the longest chain of pieces, and no round walks a text.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LIMIT, OVERLAP = 512, 50
#: What separates words.
BLANKS = " \t\r\n"
#: Types whose text is COBOL source, JCL, or a list with an item per line; others are prose.
COBOL_TYPES = ("paragraph_logic", "static_values", "sql_operation", "commented_out_code", "dead_code")
JCL_TYPES = ("step_detail",)
LIST_TYPES = ("variable_group", "copybook_fields", "job_flow", "workflow")
#: Kinds of cuts, stronger ones first.
STATEMENT, LINE, HARD, END = 3, 2, 1, 0
KINDS = {STATEMENT: "statement", LINE: "line", HARD: "word", END: "end"}


def word_count(text: str | Column) -> Column:
    """Longest runs of characters other than space, tab, CR and LF; 0 for null."""
    return F.coalesce(F.regexp_count(F.col(text) if isinstance(text, str) else text, F.lit(r"[^ \t\r\n]+")), F.lit(0))


def word_spans(text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(characters, first, end) of a text's words."""
    chars = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    solid = ~np.isin(chars, [ord(c) for c in BLANKS])
    edge = np.diff(np.concatenate([[0], solid.astype(np.int8), [0]]))
    return chars, np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def boundaries(chars: np.ndarray, first: np.ndarray, end: np.ndarray, kind: str) -> np.ndarray:
    """Strength of a cut behind each word: STATEMENT, LINE or 0 where no natural boundary is.

    COBOL: a line end is a boundary unless the next line continues a literal (indicator '-'); a line that
    ends a sentence is a strong one. JCL: a line end behind which a new statement or comment starts; strong
    if no operands follow. Lists: line ends. Prose: sentence ends and line ends, blank lines strong."""
    n = len(first)
    out = np.zeros(n, dtype=np.int8)
    if n < 2:
        return out
    breaks = np.cumsum(np.concatenate([[0], (chars == 10).astype(np.int64)]))
    lines = breaks[first[1:]] - breaks[end[:-1]]
    last = chars[end[:-1] - 1]
    if kind in JCL_TYPES:
        slash, blank = (chars[first[1:]] == 47), (end[1:] - first[1:] == 2)
        out[:-1] = np.where(lines > 0, np.where(slash & blank, 0, STATEMENT), 0)
    elif kind in COBOL_TYPES:
        # A continuation line has its indicator in column 7 and nothing but a number before it.
        start = np.flatnonzero(chars == 10)
        at7 = start + 7
        cont = np.zeros(len(start), dtype=bool)
        inside = at7 < len(chars)
        cont[inside] = chars[at7[inside]] == 45
        line_of_next = breaks[first[1:]]
        goes_on = np.concatenate([[False], cont])[line_of_next]
        out[:-1] = np.where((lines > 0) & ~goes_on, np.where(last == 46, STATEMENT, LINE), 0)
    elif kind in LIST_TYPES:
        out[:-1] = np.where(lines > 0, LINE, 0)
    else:
        ends = np.isin(last, [ord(c) for c in ".!?。！？"])
        out[:-1] = np.where(ends | (lines > 1), STATEMENT, np.where(lines > 0, LINE, 0))
    return out


def cuts(strengths: list[np.ndarray], limit: int = LIMIT, overlap: int = OVERLAP) -> list[tuple[np.ndarray, np.ndarray]]:
    """(positions, kinds) of each text's cuts; a position is the number of words before the cut.

    strengths: of the cut behind each word. A piece ends at the farthest strong boundary in the farther
    half of its reach, else at the farthest natural one, else behind its limit-th word."""
    reach = limit - overlap
    tables, bases, base = [], [], 0
    for s in strengths:
        n = len(s)
        natural = np.flatnonzero(s) + 1
        natural = natural[natural < n]
        # The root stands at `overlap`, as if the first piece had an overlap too.
        stops = np.concatenate([[overlap], natural[natural > overlap], [n]])
        hard = [np.arange(p + reach, q, reach) for p, q in zip(stops[:-1], stops[1:]) if q - p > reach]
        pos = np.unique(np.concatenate([stops, *hard])).astype(np.int64)
        succ = None
        for level in (STATEMENT, LINE):  # then any natural boundary
            own = np.concatenate([natural[s[natural - 1] >= level], [n]])
            far = own[np.maximum(np.searchsorted(own, pos + reach, side="right") - 1, 0)]
            # A strong boundary has to leave the piece at least half full of new words.
            good = (far > pos + (reach // 2 if level == STATEMENT else 0)) & (far <= pos + reach)
            pick = np.where(good, far, -1)
            succ = pick if succ is None else np.where(succ >= 0, succ, pick)
        succ = np.where(pos + reach >= n, n, succ)
        succ = np.where(succ < 0, np.minimum(pos + reach, n), succ)
        succ[pos == n] = n
        tables.append((pos, np.searchsorted(pos, succ) + base))
        bases.append(base)
        base += len(pos)
    if not tables:
        return []
    jump = np.concatenate([t[1] for t in tables])
    known = np.zeros(base, dtype=bool)
    known[bases] = True
    while True:
        # The cuts known so far are joined to the jumps; then the jumps are squared.
        grown = known.copy()
        grown[jump[known]] = True
        if (grown == known).all():
            break
        known, jump = grown, jump[jump]
    out = []
    for s, (pos, _), b in zip(strengths, tables, bases):
        at = pos[known[b : b + len(pos)]][1:]
        out.append((at, np.where(at == len(s), END, np.where(s[at - 1] > 0, s[at - 1], HARD))))
    return out


def pieces(df: DataFrame, key: str, text: str, kind: str, limit: int = LIMIT, overlap: int = OVERLAP) -> DataFrame:
    """The pieces of every text of more than `limit` words, in order.

    Columns: key, piece_no from 0, n_pieces, start_word, end_word (exclusive), new_from (the first word
    that the piece before lacks), cut_kind, text. Each piece has at most `limit` words, starts `overlap`
    words before the end of the one before, and runs to the next piece's first new word, blanks included,
    so the new parts joined give the text back. Texts within the limit, null and blank ones have no rows."""
    if not 0 <= overlap < limit:
        raise ValueError("overlap must be at least 0 and less than limit")
    over = df.filter(word_count(text) > limit).select(F.col(key).alias("k"), F.lower(F.trim(F.col(kind))).alias("kind"), F.col(text).alias("t"))
    names = ["k", "piece_no", "n_pieces", "start_word", "end_word", "new_from", "cut_kind", "t"]

    def split(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, kinds, keys = batch.column("t").to_pylist(), batch.column("kind").to_pylist(), batch.column("k")
            spans = [word_spans(t) for t in texts]
            found = cuts([boundaries(c, a, b, k or "") for (c, a, b), k in zip(spans, kinds)], limit, overlap)
            rows: list[list] = [[] for _ in names]
            owner: list[int] = []
            for i, ((at, how), (chars, first, _)) in enumerate(zip(found, spans)):
                start = np.concatenate([[0], at[:-1] - overlap])
                new = np.concatenate([[0], at[:-1]])
                stop = np.append(first, len(chars))[at]
                stop[-1] = len(chars)
                begin = np.where(start == 0, 0, first[start])
                owner += [i] * len(at)
                rows[1] += range(len(at))
                rows[2] += [len(at)] * len(at)
                rows[3] += start.tolist()
                rows[4] += at.tolist()
                rows[5] += new.tolist()
                rows[6] += [KINDS[h] for h in how.tolist()]
                rows[7] += [texts[i][a:b] for a, b in zip(begin.tolist(), stop.tolist())]
            kinds_of = [keys.type, pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.string(), pa.string()]
            columns = [keys.take(pa.array(owner, pa.int64()))] + [pa.array(c, t) for c, t in zip(rows[1:], kinds_of[1:])]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    kt = over.schema["k"].dataType.simpleString()
    out = over.mapInArrow(split, f"k {kt}, piece_no int, n_pieces int, start_word int, end_word int, new_from int, cut_kind string, t string")
    return out.withColumnsRenamed({"k": key, "t": text})
