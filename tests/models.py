"""Brute-force models of the sequential operators for small inputs, written
from their definitions (not from the operators' way of computing them)."""

from __future__ import annotations

import numpy as np


def cos(a, b):
    length = np.linalg.norm(a) * np.linalg.norm(b)
    return float(np.dot(a, b) / length) if length else float("nan")


def greedy_groups(ids, vecs, t):
    """A row belongs to the smallest earlier leader it is similar to; without one it leads."""
    leader, sim = {}, {}
    for i, v in sorted(zip(ids, vecs), key=lambda x: x[0]):
        near = {l: cos(vecs[ids.index(l)], v) for l in sorted(set(leader.values()))}
        found = next((l for l, s in near.items() if round(s, 12) >= t), None)
        leader[i] = i if found is None else found
        if found is not None:
            sim[i] = near[found]
    return leader, sim


def peel(ids, vecs):
    """The order in which rows leave, by the matrix of all cosines."""
    at = {i: k for k, i in enumerate(ids)}
    c = np.array([[cos(a, b) for b in vecs] for a in vecs])

    def worth(i, left):
        others = [at[j] for j in left if j != i]
        return 0.0 if len(others) < 2 else round(float(c[at[i], others].mean()), 12)

    left, out = set(ids), []
    while left:
        undefined = any(not np.linalg.norm(vecs[at[i]]) for i in left)
        out.append(min(left, key=lambda i: (0.0 if undefined else -worth(i, left), i)))
        left.remove(out[-1])
    return out


def balance(sources, n):
    """Every row holds a place ``(part, number)``; the list is the rows by place."""
    most = max(n // 5, 3)
    place = {row: (0, row) for row in range(len(sources))}

    def by_source():
        rows = {}
        for at, row in enumerate(sorted(place, key=place.get)):
            rows.setdefault(sources[row], []).append((at, row))
        return rows

    for step in range(1, n + 1):
        rows = by_source()
        inside = {s: sum(at < n for at, _ in r) for s, r in rows.items()}
        crowded = [r[0] for s, r in rows.items() if inside[s] > most]
        if not crowded:
            break
        place[min(crowded)[1]] = (1, step)
        after = by_source()
        absent = [(-len(r), after[s][0][0], s) for s, r in rows.items() if not inside[s] and len(r) > 1]
        fewest = [(inside[s], r[0][0], s) for s, r in rows.items() if inside[s]]
        at, row = after[min(absent or fewest)[2]][0]
        if at >= n:
            place[row] = (-1, -step)
    return sorted(place, key=place.get)
