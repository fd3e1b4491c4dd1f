"""Filling containers of fixed capacity with whole texts, neighbours in content together.

A text's hashed word vector is projected to three dimensions and placed on a Hilbert curve. The texts are
range-sorted along the curve and each range is packed in curve order. Only ids, sizes and curve keys are
shuffled, never texts.
"""

from __future__ import annotations

import bisect
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodegraph.llm import tokens
from lodegraph.session import cut

CAPACITY = 2048
#: Dimensions of the projection and bits of each on the curve.
DIMENSIONS, BITS = 3, 10
#: Buckets of the hashed word vectors.
BUCKETS = 256
#: Neighbours on the curve that are packed together, largest first.
BLOCK = 512
#: Blocks along the curve for which a container stays open, so that only neighbours share one.
OPEN_BLOCKS = 4
#: Texts of one range of the curve.
RANGE_ROWS = 50_000


def projection() -> np.ndarray:
    """Fixed signs that map a bucket of the hashed vector to the few dimensions."""
    return np.array([[1.0 if xxhash.xxh32_intdigest(f"{b}:{d}") & 1 else -1.0 for d in range(DIMENSIONS)] for b in range(BUCKETS)])


def hilbert_key(x: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Position on the Hilbert curve of integer points (rows), by rotating and reflecting bit planes."""
    x = x.astype(np.int64).T.copy()
    n = len(x)
    q = 1 << (bits - 1)
    while q > 1:
        p = q - 1
        for i in range(n):
            high = (x[i] & q) != 0
            swap = np.where(high, 0, (x[0] ^ x[i]) & p)
            x[0] = np.where(high, x[0] ^ p, x[0] ^ swap)
            x[i] ^= swap
        q >>= 1
    for i in range(1, n):
        x[i] ^= x[i - 1]
    t = np.zeros_like(x[0])
    q = 1 << (bits - 1)
    while q > 1:
        t = np.where((x[n - 1] & q) != 0, t ^ (q - 1), t)
        q >>= 1
    x ^= t
    key = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(n):
            key = key << 1 | (x[i] >> b & 1)
    return key


def sized_on_curve(df: DataFrame, key: str, text: str, path: str | None = None) -> DataFrame:
    """(item, n_tokens, curve) of every row."""
    raw = df.sparkSession.sparkContext.broadcast(tokens.vocabulary_bytes(path))

    def measure(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, signs, vectors = tokens.load(raw.value), projection(), {}
        for batch in batches:
            words, index, offsets = tokens.distinct_words(batch.column("_words"))
            n = np.fromiter(map(bpe.count, words), dtype=np.int64, count=len(words))
            if len(vectors) > tokens.REMEMBERED:
                vectors.clear()
            for w in words:
                if w not in vectors:
                    h = xxhash.xxh32_intdigest(w.strip().lower())
                    vectors[w] = signs[h % BUCKETS] * (1 if h >> 31 else -1)
            v = np.array([vectors[w] for w in words]).reshape(-1, DIMENSIONS)
            size = np.maximum(np.diff(offsets), 1)
            mean = tokens.row_sums(v[index], offsets) / size[:, None]
            grid = np.clip(((mean + 0.5) * (1 << BITS)).astype(np.int64), 0, (1 << BITS) - 1)
            yield pa.RecordBatch.from_arrays([batch.column("item"), pa.array(tokens.row_sums(n[index], offsets), pa.int64()), pa.array(hilbert_key(grid), pa.int64())], names=["item", "n_tokens", "curve"])

    kind = df.schema[key].dataType.simpleString()
    return df.select(F.col(key).alias("item"), tokens.pretokens(text).alias("_words")).mapInArrow(measure, f"item {kind}, n_tokens bigint, curve bigint")


def pack_range(rows: Iterable[tuple], capacity: int = CAPACITY, block: int = BLOCK, open_blocks: int = OPEN_BLOCKS) -> Iterator[tuple]:
    """(item, piece_no, start_token, n_tokens, container_id) of (item, size) rows in curve order.

    Blocks of neighbours go largest first into the fullest container that has room and was opened within
    the last `open_blocks` blocks, so that a container holds neighbours only. An item is cut only if
    it exceeds the capacity: into full containers and a rest that is packed like an item. A container is
    named after its first piece. An item without tokens takes no room, but has its container."""
    open_bins: list[tuple[int, str]] = []  # (room, container), ascending
    opened: dict[str, int] = {}  # block in which an open container began
    blocks = 0

    def flush(items: list[tuple]) -> Iterator[tuple]:
        nonlocal open_bins, opened, blocks
        blocks += 1
        open_bins = [b for b in open_bins if blocks - opened[b[1]] < open_blocks]
        opened = {name: opened[name] for _, name in open_bins}
        for item, piece, start, size in sorted(items, key=lambda t: -t[3]):
            at = bisect.bisect_left(open_bins, (size, ""))
            if at < len(open_bins):
                room, name = open_bins.pop(at)
            else:
                room, name = capacity, f"{item}.{piece}"
                opened[name] = blocks
            yield item, piece, start, size, name
            if room > size or (size == 0 and room > 0):
                bisect.insort(open_bins, (room - size, name))

    held: list[tuple] = []
    for item, size in rows:
        piece = start = 0
        while size > capacity:
            yield item, piece, start, capacity, f"{item}.{piece}"
            piece, start, size = piece + 1, start + capacity, size - capacity
        held.append((item, piece, start, size))
        if len(held) >= block:
            yield from flush(held)
            held = []
    yield from flush(held)


def containers(df: DataFrame, key: str, text: str, capacity: int = CAPACITY, path: str | None = None) -> DataFrame:
    """(key, piece_no, start_token, n_tokens, container_id): every text in a container of `capacity` tokens.

    Null and empty texts have 0 tokens and lie in a container without taking room. Rows with the same key
    are items of their own only if the key is unique; it has to be. Equal texts share a place on the curve
    and are told apart by their key, so no range of the curve grows with the number of copies."""
    items = cut(sized_on_curve(df, key, text, path))
    n = max(1, items.count() // RANGE_ROWS)
    kind = items.schema["item"].dataType.simpleString()

    def pack(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (r for b in batches for r in zip(b.column(0).to_pylist(), b.column(1).to_pylist()))
        out: list[tuple] = []
        names = ["item", "piece_no", "start_token", "n_tokens", "container_id"]
        as_batch = lambda out: pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names=names)
        for r in pack_range(rows, capacity):
            out.append(r)
            if len(out) == 10_000:
                yield as_batch(out)
                out = []
        if out:
            yield as_batch(out)

    types = [pa.string() if kind == "string" else pa.int32() if kind == "int" else pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.string()]
    along = items.repartitionByRange(n, "curve", "item").sortWithinPartitions("curve", "item").select("item", "n_tokens")
    packed = along.mapInArrow(pack, f"item {kind}, piece_no int, start_token bigint, n_tokens bigint, container_id string")
    return packed.withColumnRenamed("item", key)


def fill(packed: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Containers, tokens, the least number of containers that could hold them, and the share in use."""
    per = packed.groupBy("container_id").agg(F.sum("n_tokens").alias("used"))
    return per.agg(
        F.count(F.lit(1)).alias("n_containers"),
        F.sum("used").alias("n_tokens"),
        F.max("used").alias("fullest"),
        F.ceil(F.sum("used") / capacity).alias("least_containers"),
        F.round(F.sum("used") / (F.count(F.lit(1)) * capacity), 4).alias("share_used"),
    )
