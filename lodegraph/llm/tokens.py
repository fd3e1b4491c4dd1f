"""Token ids and counts of texts under a public byte-level BPE vocabulary.

Texts are cut into pre-tokens in the JVM. In Python only the distinct pre-tokens of an Arrow batch are
encoded; ids and counts of the rows are gathered from them with array operations, so no Python code runs
per word of the corpus.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import os
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Fixed value: the pre-token pattern of the byte-level vocabularies.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Folder of the vocabulary files; pass another path where they lie elsewhere.
TOKENIZER_DIR = os.environ.get("TOKENIZER_DIR", "/opt/tokenizers")
VOCABULARY = "byte_bpe_50k.tiktoken"
#: Distinct pre-tokens whose ids a Python worker remembers; more are encoded again, never dropped.
REMEMBERED = 400_000


def vocabulary_bytes(path: str | None = None) -> bytes:
    with open(path or os.path.join(TOKENIZER_DIR, VOCABULARY), "rb") as f:
        return f.read()


def pretokens(text: str | Column) -> Column:
    """array<string> of a text's pre-tokens; empty for empty and null texts."""
    text = F.col(text) if isinstance(text, str) else text
    return F.coalesce(F.regexp_extract_all(text, F.lit("(?U)" + PATTERN), F.lit(0)), F.array().cast("array<string>"))


class RankQueue:
    """Priority queue over merge ranks: a bucket of positions per rank, found over bitmaps of bitmaps.

    A set bit in a level's word says that the word below is not empty; the next rank is found by taking
    the first set bit of each level from the top. Entries are never removed early: who pops an entry
    checks whether it is stale."""

    def __init__(self, size: int):
        self.levels: list[list[int]] = []
        n = size
        while True:
            n = (n + 63) >> 6
            self.levels.append([0] * n)
            if n == 1:
                break
        self.buckets: dict[int, list[int]] = {}

    def push(self, rank: int, position: int) -> None:
        bucket = self.buckets.get(rank)
        if bucket:
            heapq.heappush(bucket, position)
            return
        self.buckets[rank] = [position]
        at = rank
        for level in self.levels:
            word, bit = at >> 6, 1 << (at & 63)
            old = level[word]
            level[word] = old | bit
            if old:
                break
            at = word

    def pop(self) -> tuple[int, int] | None:
        """(rank, leftmost position) of the least rank."""
        if not self.levels[-1][0]:
            return None
        rank = 0
        for level in reversed(self.levels):
            word = level[rank]
            rank = (rank << 6) + (word & -word).bit_length() - 1
        bucket = self.buckets[rank]
        position = heapq.heappop(bucket)
        if not bucket:
            at = rank
            for level in self.levels:
                level[at >> 6] &= ~(1 << (at & 63))
                if level[at >> 6]:
                    break
                at >>= 6
        return rank, position


class Bpe:
    """Encoder of pre-tokens; `count` and `encode` agree with the public tokenizer."""

    def __init__(self, raw: bytes):
        self.ranks = {base64.b64decode(t): int(r) for t, r in (line.split() for line in raw.splitlines() if line)}
        self.size = max(self.ranks.values()) + 1
        self.text = {r: t for t, r in self.ranks.items()}
        self.known: dict[str, tuple[int, ...]] = {}
        self.counted: dict[str, int] = {}
        self._trie: LongestMatch | None = None
        self._queue = RankQueue(self.size)

    def encode_bytes(self, piece: bytes) -> tuple[int, ...]:
        """Ids of a pre-token: merge the pair of least rank, the leftmost of equals, until none is left."""
        ranks = self.ranks
        if piece in ranks:
            return (ranks[piece],)
        n = len(piece)
        parts: list[bytes | None] = [piece[i : i + 1] for i in range(n)]
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        queue = self._queue
        for i in range(n - 1):
            r = ranks.get(piece[i : i + 2])
            if r is not None:
                queue.push(r, i)
        while (least := queue.pop()) is not None:
            rank, i = least
            left = parts[i]
            j = after[i]
            if left is None or j >= n or ranks.get(left + parts[j]) != rank:
                continue  # stale: one of the two has been merged meanwhile
            parts[i], parts[j] = left + parts[j], None
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                r = ranks.get(parts[i] + parts[k])
                if r is not None:
                    queue.push(r, i)
            h = before[i]
            if h >= 0:
                r = ranks.get(parts[h] + parts[i])
                if r is not None:
                    queue.push(r, h)
        return tuple(ranks[p] for p in parts if p is not None)

    def encode(self, piece: str) -> tuple[int, ...]:
        ids = self.known.get(piece)
        if ids is None:
            if len(self.known) >= REMEMBERED:
                self.known.clear()
            ids = self.known[piece] = self.encode_bytes(piece.encode())
        return ids

    def count(self, piece: str) -> int:
        """Number of ids of a pre-token, by longest match where that is the merge result, else by merging."""
        n = self.counted.get(piece)
        if n is None:
            if len(self.counted) >= REMEMBERED:
                self.counted.clear()
            if self._trie is None:
                self._trie = LongestMatch(self)
            n = self.counted[piece] = self._trie.count(piece.encode())
        return n


class LongestMatch:
    """Trie of the vocabulary with failure links and precomputed emissions.

    At a node where the text leaves the trie, the emission holds the tokens that longest match has
    settled, and the failure link leads to the node of what is left; each byte is read once. Longest match
    equals merging exactly if each neighbouring pair of its tokens is what merging makes of their text;
    pairs are judged once and remembered. Where a pair isn't, the pre-token is counted by merging."""

    def __init__(self, bpe: Bpe):
        self.bpe = bpe
        self.pairs: dict[tuple[int, int], bool] = {}
        go: dict[int, int] = {}
        token: list[int | None] = [None]
        for text, rank in bpe.ranks.items():
            node = 0
            for b in text:
                nxt = go.get(node << 8 | b)
                if nxt is None:
                    nxt = go[node << 8 | b] = len(token)
                    token.append(None)
                node = nxt
            token[node] = rank
        fail: list[int] = [0] * len(token)
        emit: list[tuple[int, ...]] = [()] * len(token)
        below: list[list[tuple[int, int]]] = [[] for _ in token]
        for key, child in go.items():
            below[key >> 8].append((key & 255, child))
        level = [0]
        while level:
            nxt_level = []
            for node in level:
                for b, child in below[node]:
                    nxt_level.append(child)
                    if token[child] is not None:
                        emit[child] = (token[child],)
                        continue
                    out, at = emit[node], fail[node]
                    while (to := go.get(at << 8 | b)) is None:
                        out, at = out + emit[at], fail[at]
                    emit[child], fail[child] = out, to
            level = nxt_level
        self.go, self.fail, self.emit = go, fail, emit

    def match(self, piece: bytes) -> list[int]:
        go, fail, emit, node, out = self.go, self.fail, self.emit, 0, []
        for b in piece:
            while (to := go.get(node << 8 | b)) is None:
                out += emit[node]
                node = fail[node]
            node = to
        while node:
            out += emit[node]
            node = fail[node]
        return out

    def count(self, piece: bytes) -> int:
        out = self.match(piece)
        for pair in zip(out, out[1:]):
            good = self.pairs.get(pair)
            if good is None:
                if len(self.pairs) >= REMEMBERED:
                    self.pairs.clear()
                good = self.pairs[pair] = self.bpe.encode_bytes(self.bpe.text[pair[0]] + self.bpe.text[pair[1]]) == pair
            if not good:
                return len(self.bpe.encode_bytes(piece))
        return len(out)


_LOADED: dict[str, Bpe] = {}


def load(raw: bytes) -> Bpe:
    """The encoder of a vocabulary file's bytes, once per Python worker."""
    key = hashlib.sha1(raw).hexdigest()
    if key not in _LOADED:
        _LOADED[key] = Bpe(raw)
    return _LOADED[key]


def distinct_words(column: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
    """(distinct words, index of each word, offsets of the rows) of an Arrow list<string> column."""
    offsets = np.asarray(column.offsets, dtype=np.int64)
    words = column.flatten().dictionary_encode()
    return words.dictionary.to_pylist(), np.asarray(words.indices, dtype=np.int64), offsets - offsets[0]


def row_sums(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sums of `values` over the rows that `offsets` delimits."""
    total = np.concatenate([np.zeros((1, *values.shape[1:]), dtype=values.dtype), np.cumsum(values, axis=0)])
    return total[offsets[1:]] - total[offsets[:-1]]


def single_array(column: pa.ChunkedArray | pa.Array) -> pa.Array:
    return column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column


def with_ids(df: DataFrame, text: str, keep: list[str], path: str | None = None) -> DataFrame:
    """`keep` and ids: array<int>, the ids of a text without special tokens.

    Strings of special tokens in a text are ordinary text. Empty and null texts have no ids: []."""
    raw = df.sparkSession.sparkContext.broadcast(vocabulary_bytes(path))

    def encode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(raw.value)
        for batch in batches:
            words, index, offsets = distinct_words(batch.column("_words"))
            ids = [bpe.encode(w) for w in words]
            lengths = np.fromiter(map(len, ids), dtype=np.int64, count=len(ids))
            flat = np.fromiter((i for t in ids for i in t), dtype=np.int32, count=int(lengths.sum()))
            starts = np.cumsum(lengths) - lengths
            out_len = lengths[index]
            ends = np.cumsum(out_len)
            total = int(ends[-1]) if len(ends) else 0
            take = np.repeat(starts[index] - (ends - out_len), out_len) + np.arange(total)
            row_ends = np.concatenate([[0], ends])[offsets]
            lists = pa.ListArray.from_arrays(pa.array(row_ends, pa.int32()), pa.array(flat[take], pa.int32()))
            yield pa.RecordBatch.from_arrays([batch.column(i) for i in range(len(keep))] + [lists], names=[*keep, "ids"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.select(*keep).schema)
    return df.select(*keep, pretokens(text).alias("_words")).mapInArrow(encode, f"{schema}, ids array<int>")


def with_counts(df: DataFrame, text: str, keep: list[str], path: str | None = None) -> DataFrame:
    """`keep` and n_tokens: bigint, exact; 0 for empty and null texts."""
    raw = df.sparkSession.sparkContext.broadcast(vocabulary_bytes(path))

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(raw.value)
        for batch in batches:
            words, index, offsets = distinct_words(batch.column("_words"))
            n = np.fromiter(map(bpe.count, words), dtype=np.int64, count=len(words))
            sums = row_sums(n[index], offsets)
            yield pa.RecordBatch.from_arrays([batch.column(i) for i in range(len(keep))] + [pa.array(sums, pa.int64())], names=[*keep, "n_tokens"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.select(*keep).schema)
    return df.select(*keep, pretokens(text).alias("_words")).mapInArrow(count, f"{schema}, n_tokens bigint")


