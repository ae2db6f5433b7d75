"""Brute-force versions shared by the tests."""

import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


def lower(text):
    return (text or "").translate({c: c + 32 for c in range(65, 91)})


def shingles(text):
    w = words(lower(text))
    if not w:
        return set()
    return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))}


def near_components(rows, threshold=85):
    """{doc_id: smallest reachable doc_id} over all pairs that share a shingle."""
    sets = {i: shingles(t) for i, t in rows}
    by = {}
    for i, s in sets.items():
        for x in s:
            by.setdefault(x, []).append(i)
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    seen = set()
    for ids in by.values():
        for n, a in enumerate(ids):
            for b in ids[n + 1:]:
                if (a, b) in seen:
                    continue
                seen.add((a, b))
                common = len(sets[a] & sets[b])
                if 100 * common >= threshold * len(sets[a] | sets[b]):
                    x, y = sorted((find(a), find(b)))
                    root[y] = x
    return {i: find(i) for i in sets}


def without_repeats(texts, size=35):
    """Per text: (words, kept words)."""
    from collections import Counter
    all_words = [words(t) for t in texts]
    count = Counter(tuple(w[i:i + size]) for w in all_words for i in range(len(w) - size + 1))
    out = []
    for w in all_words:
        gone = set()
        for i in range(len(w) - size + 1):
            if count[tuple(w[i:i + size])] > 1:
                gone.update(range(i, i + size))
        out.append((w, [x for i, x in enumerate(w) if i not in gone]))
    return out
