import base64
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from lodegraph.llm import budget, packing, tokens

TEXTS = [None, "", " ", "a", "Hello world, it's 2024!", "x" * 3000, "ab1=" * 2000, "日本語のテキスト、です。\r\n\r\n  end ", "<|endoftext|> special", " \x1c tab\t 　é", "MOVE WS-A TO WS-B." * 50, "👩‍💻 ok", "a" * 70 + " " * 500 + "b"]


@pytest.fixture(scope="module")
def public():
    tiktoken = pytest.importorskip("tiktoken")
    raw = tokens.vocabulary_bytes()
    ranks = {base64.b64decode(a): int(b) for a, b in (x.split() for x in raw.splitlines())}
    return tiktoken.Encoding("own", pat_str=tokens.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(i, t, "x", 1) for i, t in enumerate(TEXTS)], "doc_id long, text string, ids string, n_tokens int")


def test_ids_match_the_public_tokenizer(docs, public):
    got = {r.doc_id: list(r.ids) for r in tokens.with_ids(docs, "text", ["doc_id"]).collect()}
    assert got == {i: public.encode_ordinary(t or "") for i, t in enumerate(TEXTS)}
    assert tokens.with_ids(docs.filter("false"), "text", ["doc_id"]).count() == 0


def test_counts_match_the_ids(docs, public):
    got = {r.doc_id: r.n_tokens for r in tokens.with_counts(docs, "text", ["doc_id"]).collect()}
    assert got == {i: len(public.encode_ordinary(t or "")) for i, t in enumerate(TEXTS)}


def test_random_bytes_and_longest_match(public):
    bpe, rnd = tokens.load(tokens.vocabulary_bytes()), random.Random(3)
    for _ in range(400):
        s = "".join(rnd.choice("aeiounrst-=. öé日x1") for _ in range(rnd.randint(1, 60)))
        assert list(bpe.encode_bytes(s.encode())) == public._core_bpe.encode_single_piece(s.encode())
        assert bpe.count(s) == len(bpe.encode_bytes(s.encode()))
    match = bpe._trie.match(b"unbelievable")
    assert b"".join(bpe.text[t] for t in match) == b"unbelievable"


def test_rank_queue_orders_like_sorting():
    q, rnd, pushed = tokens.RankQueue(50_000), random.Random(1), []
    for _ in range(300):
        x = (rnd.randint(0, 49_999), rnd.randint(0, 99))
        pushed.append(x)
        q.push(*x)
    assert [q.pop() for _ in pushed] == sorted(pushed) and q.pop() is None


def test_budget_counts_every_chunk_once(spark):
    rows = [(1, " p1 ", "Comments", "one two"), (2, "P1", "comments ", None), (3, None, "odd", "x"), (4, "NOPE", None, ""), (4, "NOPE", None, "")]
    chunks = spark.createDataFrame([(*r, "a", "b") for r in rows], "row_id long, program string, chunk_type string, text string, language string, n_chunks string")
    catalog = spark.createDataFrame([("P1", "EN", None), ("P2", None, "x")], "program string, house_lang string, app_domain string")
    types = spark.createDataFrame([("comments",)], "chunk_type string")
    got = {(r.program, r.language, r.app_domain, r.chunk_type): (r.n_chunks, r.n_null_texts, r.n_tokens) for r in budget.token_budget(chunks, catalog, types).collect()}
    assert got == {("P1", "en", "unknown", "comments"): (2, 1, 2), ("unknown", "unknown", "unknown", "unknown"): (3, 0, 1)}
    assert budget.token_budget(chunks.filter("false"), catalog, types).count() == 0


def check_packing(rows, sizes, capacity):
    used, parts = {}, {}
    for item, piece, start, n, c in rows:
        used[c] = used.get(c, 0) + n
        parts.setdefault(item, []).append((piece, start, n))
    assert max(used.values(), default=0) <= capacity
    for item, size in sizes.items():
        p = sorted(parts[item])
        assert [x[0] for x in p] == list(range(len(p))) and sum(x[2] for x in p) == size
        assert len(p) == max(1, -(-size // capacity)) and all(x[1] == i * capacity for i, x in enumerate(p))
    return used


def test_packing_is_tight_and_whole():
    rnd = random.Random(5)
    sizes = {i: rnd.choice([0, 1, 30, 100, 400, 2048, 2049, 5000, 700]) for i in range(3000)}
    used = check_packing(list(packing.pack_range(sizes.items(), 2048, 256)), sizes, 2048)
    assert sum(used.values()) / (2048 * len(used)) > 0.97


def test_containers(docs, public, spark):
    rows = [tuple(r) for r in packing.containers(docs, "doc_id", "text", 64).collect()]
    check_packing(rows, {i: len(public.encode_ordinary(t or "")) for i, t in enumerate(TEXTS)}, 64)
    assert packing.containers(docs.filter("false"), "doc_id", "text").count() == 0
    same = spark.range(500).select(F.col("id").alias("doc_id"), F.lit("the same text again").alias("text"))
    f = packing.fill(packing.containers(same, "doc_id", "text", 64), 64).first()
    assert f.n_containers == f.least_containers


def test_hilbert_neighbours_are_close():
    side = 8
    pts = np.array([(x, y, z) for x in range(side) for y in range(side) for z in range(side)])
    key = packing.hilbert_key(pts, 3)
    assert sorted(key.tolist()) == list(range(side**3))
    walk = pts[np.argsort(key)]
    assert (np.abs(np.diff(walk, axis=0)).sum(axis=1) == 1).all()


def test_containers_hold_neighbours_only():
    from lodegraph.llm import packing

    rnd = random.Random(8)
    rows = [(i, min(int(rnd.expovariate(1 / 360)), 2048)) for i in range(6000)]
    held = {}
    for item, _, _, size, name in packing.pack_range(iter(rows), 2048, 256, 3):
        held.setdefault(name, []).append((item, size))
    assert sorted(i for v in held.values() for i, _ in v) == list(range(6000)) and all(sum(s for _, s in v) <= 2048 for v in held.values())
    assert max(max(i for i, _ in v) - min(i for i, _ in v) for v in held.values()) < 3 * 256
    assert sum(s for _, s in rows) / len(held) / 2048 > 0.99
