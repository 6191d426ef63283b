"""Plain versions that the operators are compared with."""

from __future__ import annotations

import re
from collections import defaultdict


def fold(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def white_words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def shingles(text, n):
    words = white_words(fold(text))
    if not words:
        return frozenset()
    if len(words) < n:
        return frozenset([tuple(words)])
    return frozenset(tuple(words[i:i + n]) for i in range(len(words) - n + 1))


def jaccard_components(rows, n=4, percent=85):
    """[(doc_id, text)] -> [(doc_id, set size, smallest id reachable)] by comparing all pairs that share a shingle."""
    sets = [shingles(t, n) for _, t in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    index = defaultdict(list)
    for i, s in enumerate(sets):
        count = defaultdict(int)
        for x in s:
            for j in index[x]:
                count[j] += 1
            index[x].append(i)
        for j, c in count.items():
            if 100 * c >= percent * (len(s) + len(sets[j]) - c):
                parent[root(i)] = root(j)
    low = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            low[root(i)] = min(d, low.get(root(i), d))
    return [(d, len(sets[i]), low.get(root(i), d)) for i, (d, _) in enumerate(rows)]


def repeated_bytes(rows, match=200, keep="none"):
    """[(doc_id, text)] -> [(doc_id, bytes, kept bytes, removed spans)] from a table of all strings of ``match`` bytes."""
    data = [(t or "").encode() for _, t in rows]
    where = defaultdict(list)
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, rows[i][0] or 0))
    for i in order:
        for p in range(len(data[i]) - match + 1):
            where[data[i][p:p + match]].append((i, p))
    gone = [bytearray(len(d)) for d in data]
    for places in where.values():
        if len(places) > 1:
            for i, p in places[keep == "first":]:
                gone[i][p:p + match] = b"\1" * match
    out = []
    for (d, _), b, g in zip(rows, data, gone):
        spans = sum(x == 1 and (k == 0 or g[k - 1] == 0) for k, x in enumerate(g))
        out.append((d, len(b), bytes(x for x, y in zip(b, g) if not y), spans))
    return out


FOLDED_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def contamination(rows, items, window=13):
    """[(doc_id, text)] and [(item_id, text)] -> [(doc_id, words, hit words, sorted ids of items found)]."""
    known = defaultdict(set)
    for i, t in items:
        w = FOLDED_WORD.findall(fold(t))
        n = min(len(w), window)
        for k in range(len(w) - n + 1 if w else 0):
            known[tuple(w[k:k + n])].add(i)
    widths = {len(k) for k in known}
    out = []
    for d, t in rows:
        w = FOLDED_WORD.findall(fold(t))
        hit, found = set(), set()
        for n in widths:
            for k in range(len(w) - n + 1):
                ids = known.get(tuple(w[k:k + n]))
                if ids:
                    hit.update(range(k, k + n))
                    found |= ids
        out.append((d, len(w), len(hit), sorted(str(i) for i in found if i is not None)))
    return out


def text_rules(text):
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words)."""
    text = text or ""
    w = white_words(text)
    lines = [x for x in text.split("\n") if white_words(x)]
    where = defaultdict(list)
    for k in range(len(w) - 2):
        where[tuple(w[k:k + 3])].append(k)
    repeated = {p for ks in where.values() if len(ks) > 1 for k in ks for p in range(k, k + 3)}
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(repeated)
