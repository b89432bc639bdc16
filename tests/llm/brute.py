"""Plain versions of the text operators, for small inputs."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
ITEM_WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(text):
    return re.sub("[A-Z]", lambda m: chr(ord(m[0]) + 32), text or "")


def sha(data):
    return hashlib.sha256(data if isinstance(data, bytes) else data.encode()).hexdigest()


def windows_removed(sequences, k):
    """Per id whether each position is covered by a window that a smaller id has."""
    first, out = {}, {}
    for i in sorted(sequences):
        s = sequences[i]
        for p in range(len(s) - k + 1):
            first.setdefault(s[p:p + k], i)
    for i, s in sequences.items():
        gone = [False] * len(s)
        for p in range(len(s) - k + 1):
            if first[s[p:p + k]] < i:
                gone[p:p + k] = [True] * k
        out[i] = gone
    return out


def substring(rows, k=13):
    words = {i: tuple(WORDS.findall(t or "")) for i, t in rows}
    gone = windows_removed(words, k)
    return {i: (len(w), sum(gone[i]), sha(" ".join(x for x, g in zip(w, gone[i]) if not g))) for i, w in words.items()}


def byte_strings(rows, k=50):
    texts = {i: (t or "").encode() for i, t in rows}
    gone = windows_removed(texts, k)
    return {i: (len(t), sum(gone[i]), sum(g and not (p and gone[i][p - 1]) for p, g in enumerate(gone[i])),
                sha(bytes(b for b, g in zip(t, gone[i]) if not g))) for i, t in texts.items()}


def near(rows, k=4, percent=80):
    sets = {}
    for i, t in rows:
        w = WORDS.findall(lower(t))
        sets[i] = {tuple(w[p:p + k]) for p in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())
    holders, parent = defaultdict(list), {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in sorted(sets):
        common = Counter(j for x in sets[i] for j in holders[x])
        for x in sets[i]:
            holders[x].append(i)
        for j, n in common.items():
            if 100 * n >= percent * (len(sets[i]) + len(sets[j]) - n):
                a, b = root(i), root(j)
                parent[max(a, b)] = min(a, b)
    return {i: (len(sets[i]), root(i), root(i) == i) for i in sets}


def benchmark(rows, items, k=10):
    known = defaultdict(set)
    for i, t in items:
        w = ITEM_WORDS.findall(lower(t))
        n = min(k, len(w))
        for p in range(len(w) - n + 1 if w else 0):
            known[tuple(w[p:p + n])].add(str(i))
    out = {}
    for i, t in rows:
        w = ITEM_WORDS.findall(lower(t))
        hit, found = set(), set()
        for n in {len(x) for x in known}:
            for p in range(len(w) - n + 1):
                if tuple(w[p:p + n]) in known:
                    hit.update(range(p, p + n))
                    found |= known[tuple(w[p:p + n])]
        out[i] = (len(w), len(hit), len(found), sha(",".join(sorted(found))), bool(hit))
    return out


def unigrams(rows):
    words = {i: WORDS.findall(lower(t)) + ["\n"] for i, t in rows}
    held = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i in words}
    c = Counter(w for i in words if not held[i] for w in words[i])
    n, v = sum(c.values()), len(c)
    return {i: (held[i], len(w), sum(c[x] > 0 for x in w), n, sum(math.log10((c[x] + 1) / (n + v + 1)) for x in w))
            for i, w in words.items()}


def fingerprint(text):
    import xxhash
    votes, total = [0] * 64, 0
    for word in re.split(r"[ \t\n\x0B\f\r]+", text):
        h, weight = xxhash.xxh64_intdigest(word.encode(), seed=42), min(len(word), 8)
        total += weight
        for j in range(64):
            votes[j] += weight * (h >> j & 1)
    return sum(1 << j for j in range(64) if 2 * votes[j] > total)


def edited(rows, step=50):
    rows = sorted((i, t or "") for i, t in rows)
    prints = {i: fingerprint(t) for i, t in rows}
    out = {}
    for k, (i, t) in enumerate(rows):
        j, u = rows[(k + 1) % len(rows)]
        e = t[:len(t) - len(t) // 2] + u[:len(t) // 2]
        own, other = prints[i], fingerprint(e)
        out[i] = (len(t), sha(e), f"{own:016x}", f"{other:016x}", 1 - (own ^ other).bit_count() / 64,
                  1 - (own ^ prints[j]).bit_count() / 64,
                  sum((own ^ x).bit_count() <= 3 for x in prints.values()) - 1 if i % step == 0 else None)
    return out


def print_components(rows, size=3, radius=2):
    import xxhash
    prints = {}
    for i, t in rows:
        w = WORDS.findall(lower(t))
        shingles = [" ".join(w[p:p + size]) for p in range(len(w) - size + 1)] or ([" ".join(w)] if w else [])
        hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
        prints[i] = sum(1 << j for j in range(64) if 2 * sum(h >> j & 1 for h in hashes) > len(hashes))
    parent = {i: i for i in prints}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in prints:
        for b in prints:
            if a < b and (prints[a] ^ prints[b]).bit_count() <= radius:
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    return {i: (f"{p:016x}", root(i)) for i, p in prints.items()}


def ranked(rows, items, k=10):
    """(item, rank, doc, score) of every item; rows and items are lists of (id, text)."""
    term = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
    held = [(i, Counter(term.findall(lower(t)))) for i, t in rows]
    held = [(i, c, sum(c.values())) for i, c in held if c]
    total, df = sum(n for _, _, n in held), Counter(t for _, c, _ in held for t in c)
    out = []
    for item, text in items:
        asked, scores = Counter(term.findall(lower(text))), []
        for i, c, n in held:
            m = 25 + (75 * n * len(held)) // total
            s = sum(times * math.floor(1000 * math.log((2 * len(held) + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 8 * m))
                    for t, times in asked.items() if t in c)
            if s > 0:
                scores.append((-s, 2**63 if i is None else i, i))
        out += [(item, r, i, -s) for r, (s, _, i) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out, key=str)


def hard_negatives(rows, positives=5, negatives=10):
    """(anchor, positive, rank, negative, positive score, negative score); rows are (vec_id, vector, label)."""
    good = []
    for i, v, label in rows:
        if v is not None and label is not None and all(x is not None and math.isfinite(x) for x in v):
            good.append((i, [math.floor(256 * x) for x in v], int(math.fmod(label + 1, 10)) if i is not None and i % 7 == 0 else label))
    out = []
    for a, (i, v, label) in enumerate(good):
        if i is None or i % 100:
            continue
        scored = sorted((-sum(x * y for x, y in zip(v, w)), 2**63 - 1 if j is None else j, m == label) for b, (j, w, m) in enumerate(good) if b != a)
        for s, p, _ in [x for x in scored if x[2]][:positives]:
            inside = [x for x in scored if not x[2] and 30 * -s <= 100 * -x[0] <= 90 * -s][:negatives]
            out += [(i, None if p == 2**63 - 1 else p, r, None if n == 2**63 - 1 else n, -s, -t) for r, (t, n, _) in enumerate(inside, 1)]
    return sorted(out, key=str)
