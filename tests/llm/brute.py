"""Plain Python versions of what the operators compute."""

from collections import Counter, defaultdict


def make(spark, rows, columns="doc_id long, text string"):
    return spark.createDataFrame(rows, columns)


LOWER = {c: c + 32 for c in range(65, 91)}


def words(text):
    return (text or "").translate(LOWER).encode().split()


def shingles(text):
    w = words(text)
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def components(rows):
    """doc_id -> smallest id reachable; rows: (doc_id, text)."""
    sets = {i: shingles(t) for i, t in rows}
    parent = {i: i for i in sets}

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    holders = defaultdict(list)
    for i in sorted(sets):
        shared = Counter(j for s in sets[i] for j in holders[s])
        for j, n in shared.items():
            if 100 * n >= 75 * (len(sets[i]) + len(sets[j]) - n):
                a, b = sorted((top(i), top(j)))
                parent[b] = a
        for s in sets[i]:
            holders[s].append(i)
    return {i: top(i) for i in sets}, {i: len(s) for i, s in sets.items()}


def repeats(rows, length=50):
    """doc_id -> (bytes, removed, runs, kept); rows: (doc_id, text) with different ids."""
    seen, out = set(), {}
    for i, text in sorted(rows):
        raw = (text or "").encode()
        gone = bytearray(len(raw))
        own = [raw[p : p + length] for p in range(len(raw) - length + 1)]
        for p, s in enumerate(own):
            if s in seen:
                gone[p : p + length] = b"\1" * length
        seen.update(own)
        runs = sum(1 for p in range(len(raw)) if gone[p] and (p == 0 or not gone[p - 1]))
        out[i] = (len(raw), sum(gone), runs, bytes(b for b, g in zip(raw, gone) if not g))
    return out


def repeated_words(text):
    w = (text or "").encode().split()
    count = Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
    hit = {j for i in range(len(w) - 4) if count[tuple(w[i : i + 5])] > 1 for j in range(i, i + 5)}
    return len(hit)
