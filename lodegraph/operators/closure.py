"""Counts over reachable sets without listing them: strong components first, then sums over what they reach.

Node by node a closure has up to nodes x roots rows. Here a root adds up what its component reaches: all roots
that reach a large component share the sum of what that one reaches, and walk only what lies outside.
"""

from __future__ import annotations

from collections.abc import Collection

import numpy as np

#: Nodes of a component from which its reach is summed once for all that reach it.
HUB = 32


def rows_of(n: int, src: np.ndarray, dst: np.ndarray) -> list[list[int]]:
    """Successors of every node."""
    order = np.argsort(src, kind="stable")
    at = np.searchsorted(src[order], np.arange(n + 1)).tolist()
    to = dst[order].tolist()
    return [to[at[i] : at[i + 1]] for i in range(n)]


def strong(succ: list[list[int]]) -> list[int]:
    """Component of every node (Tarjan); a component has a higher number than those that it reaches."""
    n = len(succ)
    index, low, comp, open_, clock, found = [-1] * n, [0] * n, [-1] * n, [], 0, 0
    for root in range(n):
        if index[root] >= 0:
            continue
        work = [(root, iter(succ[root]))]
        index[root] = low[root] = clock
        clock += 1
        open_.append(root)
        while work:
            v, it = work[-1]
            for w in it:
                if index[w] < 0:
                    index[w] = low[w] = clock
                    clock += 1
                    open_.append(w)
                    work.append((w, iter(succ[w])))
                    break
                if comp[w] < 0 and index[w] < low[v]:
                    low[v] = index[w]
            else:
                work.pop()
                if work and low[v] < low[work[-1][0]]:
                    low[work[-1][0]] = low[v]
                if low[v] == index[v]:
                    while True:
                        w = open_.pop()
                        comp[w] = found
                        if w == v:
                            break
                    found += 1
    return comp


def _walk(succ: list[list[int]], start: int, skip: Collection[int] = ()) -> list[int]:
    """The start and the nodes that it reaches, without those to skip, which hold all that they reach."""
    seen = {start}
    out = [start]
    for v in out:
        for w in succ[v]:
            if w not in seen and w not in skip:
                seen.add(w)
                out.append(w)
    return out


def reach_sums(succ: list[list[int]], labels: list[int], weights: np.ndarray, roots: list[int]) -> np.ndarray:
    """Row by row the sum of the weights of all nodes that a root reaches, itself included. labels: of `strong`."""
    comp = np.array(labels, dtype=np.int64)
    n = int(comp.max()) + 1 if len(comp) else 0
    w = np.zeros((n, weights.shape[1]), dtype=np.int64)
    np.add.at(w, comp, weights)
    size = np.bincount(comp, minlength=n)
    src = np.repeat(comp, [len(x) for x in succ])
    dst = comp[np.fromiter((y for x in succ for y in x), dtype=np.int64, count=len(src))]
    pairs = np.unique(np.stack([src[src != dst], dst[src != dst]]), axis=1)
    down, up = rows_of(n, pairs[0], pairs[1]), rows_of(n, pairs[1], pairs[0])
    # What the hub of the largest reach below a component reaches is added at once, the rest is walked.
    below = {hub: set(_walk(down, hub)) for hub in np.flatnonzero(size >= HUB).tolist()}
    total = {hub: w[list(b)].sum(axis=0) for hub, b in below.items()}
    hub_of: dict[int, int] = {}
    for hub in sorted(below, key=lambda c: (-len(below[c]), c)):
        if hub not in hub_of:
            for c in _walk(up, hub, hub_of.keys()):
                hub_of[c] = hub
    out = np.empty((len(roots), w.shape[1]), dtype=np.int64)
    for i, c in enumerate(comp[roots].tolist()):
        hub = hub_of.get(c)
        if hub is None:
            out[i] = w[_walk(down, c)].sum(axis=0)
        elif hub == c:
            out[i] = total[c]
        else:
            out[i] = total[hub] + w[_walk(down, c, below[hub])].sum(axis=0)
    return out


def body_counts(src: np.ndarray, dst: np.ndarray, is_start: np.ndarray, is_head: np.ndarray, kind: np.ndarray, n_kinds: int) -> tuple[np.ndarray, np.ndarray]:
    """(heads, counts): nodes by kind of the body of every head.

    A body is its head and what its starting edges lead to, along all edges, without going through the head."""
    n = len(kind)
    first = is_start & (src != dst) & is_head[src]
    heads = np.flatnonzero(is_head)
    place = np.full(n, -1, dtype=np.int64)
    place[heads] = n + np.arange(len(heads))
    succ = rows_of(n + len(heads), np.concatenate([src, place[src[first]]]), np.concatenate([dst, dst[first]]))
    weights = np.zeros((n + len(heads), n_kinds), dtype=np.int64)
    weights[np.arange(n), kind] = 1
    comp = strong(succ)
    counts = reach_sums(succ, comp, weights, list(range(n, n + len(heads))))
    for i, h in enumerate(heads.tolist()):
        begin = succ[n + i]
        if not any(comp[s] == comp[h] for s in begin):
            counts[i, kind[h]] += 1  # the body does not come back to its head
        elif not set(succ[h]) <= {h, *begin}:  # it does, and the head has other edges, which the body does not take
            seen = {h, *begin}
            out = [x for x in seen if x != h]
            for v in out:
                for t in succ[v]:
                    if t not in seen:
                        seen.add(t)
                        out.append(t)
            counts[i] = np.bincount(kind[[h, *out]], minlength=n_kinds)
    return heads, counts
