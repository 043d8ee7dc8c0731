"""Plain single-process versions of the text operators, to compare with on small inputs."""

import hashlib
import re
from collections import Counter, defaultdict

import numpy as np
import xxhash

WORD = re.compile(rb"[^\x20\x09-\x0d]+")


def shingles(text, size):
    words = WORD.findall((text or "").encode().translate(bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))))
    if len(words) < size:
        return [b" ".join(words)] if words else []
    return [b" ".join(words[i : i + size]) for i in range(len(words) - size + 1)]


def fingerprint(text, size=3):
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles(text, size)]
    return sum(1 << k for k in range(64) if 2 * sum(h >> k & 1 for h in hashes) > len(hashes))


def groups(ids, linked):
    """Smallest id reachable for each id; linked(a, b) on positions."""
    parent = list(range(len(ids)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(ids)):
        for b in range(a):
            if linked(a, b):
                parent[find(a)] = find(b)
    least = {}
    for k, i in enumerate(ids):
        least[find(k)] = min(least.get(find(k), i), i)
    return [least[find(k)] for k in range(len(ids))]


def simhash_classes(rows):
    prints = [fingerprint(t) for _, t in rows]
    component = groups([i for i, _ in rows], lambda a, b: (prints[a] ^ prints[b]).bit_count() <= 2)
    return sorted((i, f"{p:016x}", c) for (i, _), p, c in zip(rows, prints, component))


def similar_groups(rows, size=5, similarity=0.8):
    sets = [set(shingles(t, size)) for _, t in rows]

    def linked(a, b):
        both = len(sets[a] & sets[b])
        return rows[a][1] == rows[b][1] or both > 0 and both >= similarity * (len(sets[a]) + len(sets[b]) - both)

    return groups([i for i, _ in rows], linked)


def removed(rows, length, keep_first=False):
    """For each row (id, text) its bytes and the set of removed places."""
    data = [(t or "").encode() for _, t in rows]
    starts = defaultdict(list)
    for k, d in enumerate(data):
        for p in range(len(d) - length + 1):
            starts[d[p : p + length]].append((rows[k][0], k, p))
    gone = [set() for _ in rows]
    for found in starts.values():
        found.sort()
        for _, k, p in found[1:] if keep_first else found if len(found) > 1 else []:
            gone[k].update(range(p, p + length))
    return data, gone


def repeat_digests(rows, length):
    out = []
    data, gone = removed(rows, length)
    for (i, _), d, g in zip(rows, data, gone):
        spans = sum(1 for x in g if x - 1 not in g)
        out.append((i, len(d), len(g), spans, hashlib.sha256(bytes(x for p, x in enumerate(d) if p not in g)).hexdigest()))
    return sorted(out)


def quality_counts(text):
    words = re.findall(r"[^\x20\x09-\x0d]+", text or "")
    windows = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    inside = set()
    for i in range(len(words) - 4):
        if windows[tuple(words[i : i + 5])] > 1:
            inside.update(range(i, i + 5))
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0d]", x)]
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(inside)


def text_words(text):
    """Words of the mixing classifier, and the number of tokens."""
    text = re.sub(r"[\x20\x09-\x0d]+", " ", text or "").strip(" ")
    n = len(text.split(" ")) if text else 0
    words = set(re.sub(r"[.,;:!?]+(?= |\Z)", "", text.lower()).split(" "))
    level = lambda x, *bounds: sum(x >= b for b in bounds)
    shape = {"symbols": level(len(re.findall(r"[#*$%&|<>]", text)) / max(n, 1), 0.1, 0.5), "capitals": level(len(re.findall("[A-Z]", text)) / max(len(text), 1), 0.1, 0.3), "marks": level(len(re.findall("[!?]", text)) / max(n, 1), 0.1, 0.5), "variety": level(len(words) / max(n, 1), 0.3, 0.5), "words": level(n, 10)}
    return [*words, *(f"# {k}{v}" for k, v in shape.items())], n


def memberships(rows, labels, buckets=1 << 18, marked=4.0, evidence=10.0):
    """Tokens and the posteriors of clean, toxic and junk of each id; ids don't repeat."""
    kind = {}
    for i, quality, toxic in labels:
        k = 1 if toxic == 1 else {1: 0, 0: 2}.get(quality)
        if i is not None and k is not None:
            kind[i] = max(kind.get(i, 0), k)
    words = {i: text_words(t) for i, t in rows}
    hits = {i: Counter(xxhash.xxh64_intdigest(w.encode(), 42) % buckets for w in ws) for i, (ws, _) in words.items()}
    n, c = np.zeros(3), defaultdict(lambda: np.zeros(3))
    for i in hits:
        if i in kind:
            n[kind[i]] += 1
            for b, times in hits[i].items():
                c[b][kind[i]] += times
    has, lacks = {}, {}
    for b, x in c.items():
        e = x.sum() * n / n.sum()
        if ((x - e) / np.sqrt(e + 1) >= marked).any():
            has[b], lacks[b] = np.log((x + 1) / (e + 1)), np.log((np.maximum(n - x, 0) + 1) / (np.maximum(n - e, 0) + 1))
    scale = evidence / max(len(has), evidence)
    prior = np.log((n + 1) / (n.sum() + 3)) + scale * sum(lacks.values(), np.zeros(3))
    out = {}
    for i, found in hits.items():
        own = {b: t for b, t in found.items() if b in has}
        score = prior + sum((t * (has[b] - scale * lacks[b]) for b, t in own.items()), np.zeros(3)) * evidence / max(sum(own.values()), evidence)
        power = np.exp(score - score.max())
        out[i] = power / power.sum()
    return {i: n for i, (_, n) in words.items()}, out


def nearest_rates(share, p, targets):
    """Of all nonnegative rates with sum(share * rate * p) = targets those nearest to one, distances weighted by share: Dykstra's projections."""
    rate, held = np.ones(len(share)), np.zeros(len(share))
    gram = np.linalg.pinv((p * share[:, None]).T @ p)
    for _ in range(20000):
        rate = rate + p @ gram @ (targets - p.T @ (share * rate))
        other = np.maximum(rate + held, 0)
        rate, held = other, rate + held - other
    return rate
