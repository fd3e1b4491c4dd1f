"""Counts over reachable sets and over pairs, against plain walks."""

import random
from collections import Counter

import numpy as np

from lodegraph.operators import closure, graph


def body(h, es):
    seen, out = {h}, [h]
    for v in out:
        for s, d, first in es:
            if s == v and d not in seen and (first or v != h):
                seen.add(d)
                out.append(d)
    return out


def test_body_counts_against_walks(monkeypatch):
    monkeypatch.setattr(closure, "HUB", 2)
    for seed in range(300):
        r = random.Random(seed)
        n = r.randint(1, 20)
        es = [(r.randrange(n), r.randrange(n), r.random() < 0.3) for _ in range(r.randint(0, 45))]
        is_head, kind = np.array([r.random() < 0.4 for _ in range(n)]), np.array([r.randrange(3) for _ in range(n)])
        found, counts = closure.body_counts(*[np.array([e[i] for e in es], dtype=t) for i, t in enumerate((np.int64, np.int64, bool))], is_head, kind, 3)
        assert found.tolist() == np.flatnonzero(is_head).tolist()
        for h, row in zip(found.tolist(), counts.tolist()):
            assert Counter({k: x for k, x in enumerate(row) if x}) == Counter(int(kind[x]) for x in body(h, es))


def test_paragraph_types_over_long_cycles_and_programs(spark):
    n, heads = 3000, [f"p{i}" for i in range(400)]
    es = [(f"n{i}", f"n{(i + 1) % n}", "FOLLOWED_BY", "A" if i % 2 else "B") for i in range(n)] + [(h, f"n{i}", "STARTS_WITH", None) for i, h in enumerate(heads)]
    nodes = spark.createDataFrame([(h, "PARAGRAPH") for h in [*heads, "alone"]] + [(f"n{i}", "MOVE") for i in range(1, n)], "id string, flow_type string")
    got = {(r.paragraph, r.flow_type): r.n for r in graph.paragraph_types(nodes, spark.createDataFrame(es, "src string, dst string, edge_type string, program string")).collect()}
    assert got == {(h, t): x for h in heads for t, x in (("PARAGRAPH", 1), ("MOVE", n - 1), (None, 1))} | {("alone", "PARAGRAPH"): 1}
