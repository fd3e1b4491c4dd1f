"""Graph edit distances of trees of nine nodes, which took 1.6 s a pair before and are many at size."""

import random
import time

from lodegraph.operators import flowgraph as fg


def test_exact_distances_of_nine_nodes():
    rnd = random.Random(9)

    def tree():
        out = [(0, "g")]
        for _ in range(8):
            out.append((rnd.randint(1, out[-1][0] + 1), rnd.choice("wxyz")))
        return out

    pairs = [(tree(), tree()) for _ in range(20)]
    began = time.process_time()
    got = [fg.graph_edit_distance(a, b) for a, b in pairs]
    assert time.process_time() - began < 5
    assert got == [(d, True) for d in (10, 8, 9, 10, 7, 11, 7, 10, 7, 9, 13, 5, 9, 9, 9, 10, 10, 10, 11, 10)]
    assert got == [fg.graph_edit_distance(b, a) for a, b in pairs]
