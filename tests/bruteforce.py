"""Plain-Python reference for the neighbour model, used on small fixtures only.

Loops over every pair of users directly (no blocking unless asked, no
Spark), so the Spark jobs can be checked against an independent statement of
the same rules.
"""

from __future__ import annotations

import math
from collections import defaultdict


def pearson(xs, ys):
    n = len(xs)
    sx, sy = sum(xs), sum(ys)
    sxy = sum(a * b for a, b in zip(xs, ys))
    sxx, syy = sum(a * a for a in xs), sum(b * b for b in ys)
    vx, vy = n * sxx - sx * sx, n * syy - sy * sy
    if vx <= 0 or vy <= 0:
        return None
    return (n * sxy - sx * sy) / (math.sqrt(vx) * math.sqrt(vy))


def neighbors(rows, k=50, min_support=10, min_corr=0.3, n_blocks=1, block_of=None):
    """``block_of``: optional {user: block}; default user % n_blocks."""
    by_user = defaultdict(dict)
    for u, i, r in rows:
        by_user[u][i] = r
    users = sorted(by_user)
    edges = defaultdict(list)
    for a_pos, a in enumerate(users):
        for b in users[a_pos + 1:]:
            if block_of is not None:
                if block_of[a] != block_of[b]:
                    continue
            elif a % n_blocks != b % n_blocks:
                continue
            common = sorted(set(by_user[a]) & set(by_user[b]))
            if len(common) < min_support:
                continue
            r = pearson([by_user[a][i] for i in common], [by_user[b][i] for i in common])
            if r is None:
                continue
            r = round(r, 9)
            if r > min_corr:
                edges[a].append((b, r))
                edges[b].append((a, r))
    out = {}
    for u, lst in edges.items():
        lst.sort(key=lambda t: (-t[1], t[0]))
        out[u] = lst[:k]
    return out


def recommend(rows, edges, penalty=5.0, lo=1.0, hi=5.0, drop_rated=True):
    by_user = defaultdict(dict)
    for u, i, r in rows:
        by_user[u][i] = r
    result = {}
    for u, nbrs in edges.items():
        acc = defaultdict(lambda: [0.0, 0.0, 0])
        for v, c in nbrs:
            for i, r in by_user[v].items():
                a = acc[i]
                a[0] += r * c
                a[1] += c
                a[2] += 1
        raw = {i: s / cs for i, (s, cs, n) in acc.items()}
        if not raw:
            continue
        mean = sum(raw.values()) / len(raw)
        preds = {}
        for i, (s, cs, n) in acc.items():
            p = mean + (raw[i] - mean) * (n / (n + penalty))
            p = max(lo, min(hi, p))
            if drop_rated and i in by_user[u]:
                continue
            preds[i] = p
        result[u] = preds
    return result
