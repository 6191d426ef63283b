"""Small plain-Python versions of the graph measures, to check the Spark jobs against."""

from collections import defaultdict, deque
from heapq import heappop, heappush


def neighbours(edges):
    adj = defaultdict(dict)
    for a, b, w in edges:
        adj[a][b] = w
        adj[b][a] = w
    return adj


def label_propagation(edges, rounds):
    links = defaultdict(list)
    for a, b, _ in edges:
        links[a].append(b)
        links[b].append(a)
    labels = {v: v for v in links}
    for _ in range(rounds):
        new = {}
        for v, near in links.items():
            votes = defaultdict(int)
            for u in near:
                votes[labels[u]] += 1
            new[v] = min(votes, key=lambda label: (-votes[label], label))
        labels = new
    return labels


def pagerank(edges, rounds, reset=0.15):
    nodes = {v for a, b, _ in edges for v in (a, b)}
    out = defaultdict(int)
    for a, _, _ in edges:
        out[a] += 1
    rank = dict.fromkeys(nodes, 1.0)
    for _ in range(rounds):
        got = defaultdict(float)
        for a, b, _ in edges:
            got[b] += rank[a] / out[a]
        rank = {v: reset + (1 - reset) * got[v] for v in nodes}
    total = sum(rank.values())
    return {v: r * len(nodes) / total for v, r in rank.items()}


def pagerank_weighted(edges, lonely=(), alpha=0.85, tol=1e-6):
    adj = neighbours(edges)
    nodes = list(adj) + list(lonely)
    n = len(nodes)
    rank = dict.fromkeys(nodes, 1 / n)
    for _ in range(100):
        idle = sum(rank[v] for v in lonely)
        new = {v: (alpha * idle + 1 - alpha) / n for v in nodes}
        for v in adj:
            total = sum(adj[v].values())
            for u, w in adj[v].items():
                new[u] += alpha * rank[v] * w / total
        moved = sum(abs(new[v] - rank[v]) for v in nodes)
        rank = new
        if moved < n * tol:
            break
    return rank


def hops(adj, source):
    dist, queue = {source: 0}, deque([source])
    while queue:
        v = queue.popleft()
        for u in adj[v]:
            if u not in dist:
                dist[u] = dist[v] + 1
                queue.append(u)
    return dist


def components(edges):
    adj = neighbours(edges)
    return {v: min(hops(adj, v)) for v in adj}


def clustering(edges):
    adj = neighbours(edges)
    top = max(w for _, _, w in edges)
    out = {}
    for v in adj:
        near = sorted(set(adj[v]) - {v})
        k = len(near)
        total = sum(
            (adj[v][a] * adj[v][b] * adj[a][b] / top**3) ** (1 / 3)
            for i, a in enumerate(near) for b in near[i + 1:] if b in adj[a]
        )
        out[v] = 2 * total / (k * (k - 1)) if k > 1 else 0.0
    return out


def modularity(edges, label):
    m = sum(w for _, _, w in edges)
    inside, degree = defaultdict(float), defaultdict(float)
    for a, b, w in edges:
        degree[label[a]] += w
        degree[label[b]] += w
        if label[a] == label[b]:
            inside[label[a]] += w
    return sum(inside[c] / m - (degree[c] / (2 * m)) ** 2 for c in degree)


def betweenness(edges, sources):
    adj = neighbours(edges)
    n = len(adj)
    score = dict.fromkeys(adj, 0.0)
    for s in sources:
        dist, sigma, before, order = {}, defaultdict(float), defaultdict(list), []
        sigma[s] = 1.0
        seen, heap = {s: 0.0}, [(0.0, s, s)]
        while heap:
            d, pred, v = heappop(heap)
            if v in dist:
                continue
            sigma[v] += sigma[pred] if v != s else 0.0
            order.append(v)
            dist[v] = d
            for u, w in adj[v].items():
                du = d + w
                if u not in dist and (u not in seen or du < seen[u]):
                    seen[u] = du
                    heappush(heap, (du, v, u))
                    sigma[u], before[u] = 0.0, [v]
                elif du == seen.get(u):
                    sigma[u] += sigma[v]
                    before[u].append(v)
        delta = defaultdict(float)
        for v in reversed(order):
            for p in before[v]:
                delta[p] += sigma[p] / sigma[v] * (1 + delta[v])
            if v != s:
                score[v] += delta[v]
    scale = n / len(sources) / ((n - 1) * (n - 2))
    return {v: x * scale for v, x in score.items()}
