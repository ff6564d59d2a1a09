"""Straightforward single-machine answers to compare with, for small graphs only."""

from collections import deque
from itertools import combinations


def reach(start, out):
    seen, queue = {start: 0}, deque([start])
    while queue:
        n = queue.popleft()
        for m in out.get(n, ()):
            if m not in seen:
                seen[m] = seen[n] + 1
                queue.append(m)
    return seen


def neighbours(edges, directed):
    out = {}
    for s, d in edges:
        out.setdefault(s, set()).add(d)
        if not directed:
            out.setdefault(d, set()).add(s)
    return out


def weak(edges):
    out = neighbours(edges, directed=False)
    return {n: min(reach(n, out)) for n in out}


def strong(edges):
    ahead = neighbours(edges, directed=True)
    nodes = {n for e in edges for n in e}
    far = {n: set(reach(n, ahead)) for n in nodes}
    return {n: min(m for m in far[n] if n in far[m]) for n in nodes}


def bfs(edges, source, directed=True, limit=None):
    seen = reach(source, neighbours(edges, directed))
    kept = [(d, n) for n, d in seen.items() if limit is None or d <= limit]
    return [n for _, n in sorted(kept)]


def triangles(edges):
    out = {n: m - {n} for n, m in neighbours(edges, directed=False).items()}
    return sum(1 for a in out for b, c in combinations(sorted(out[a]), 2) if a < b and c in out[b])


def pagerank(edges, directed, damping, rounds):
    out = neighbours(edges, directed)
    nodes = sorted({n for e in edges for n in e})
    rank = {n: 1.0 / len(nodes) for n in nodes}
    for _ in range(rounds):
        lost = sum(rank[n] for n in nodes if not out.get(n))
        new = {n: (1 - damping) / len(nodes) + damping * lost / len(nodes) for n in nodes}
        for n in nodes:
            for m in out.get(n, ()):
                new[m] += damping * rank[n] / len(out[n])
        rank = new
    return rank


def modularity(edges, labels):
    """``edges`` as (src, dst, weight), each undirected edge once."""
    m = sum(w for _, _, w in edges)
    inside, degree = {}, {}
    for s, d, w in edges:
        a, b = labels[s], labels[d]
        inside[a] = inside.get(a, 0.0) + (w if a == b else 0.0)
        degree[a] = degree.get(a, 0.0) + w
        degree[b] = degree.get(b, 0.0) + w
    return sum(inside.get(c, 0.0) / m - (degree[c] / (2 * m)) ** 2 for c in degree)


def betweenness(edges, directed, sources):
    out = neighbours(edges, directed)
    score = {n: 0.0 for e in edges for n in e}
    for root in sources:
        far, paths, order, before = {root: 0}, {root: 1.0}, [root], {}
        for n in order:
            for m in out.get(n, ()):
                if m not in far:
                    far[m] = far[n] + 1
                    order.append(m)
                if far[m] == far[n] + 1:
                    paths[m] = paths.get(m, 0.0) + paths[n]
                    before.setdefault(m, []).append(n)
        share = {n: 0.0 for n in order}
        for m in reversed(order):
            for n in before.get(m, ()):
                share[n] += paths[n] / paths[m] * (1 + share[m])
            if m != root:
                score[m] += share[m]
    return score
