"""Plain Python versions of the operators' contracts, for small tables."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import xxhash

SHA = lambda s: hashlib.sha256(s.encode("utf-8")).hexdigest()
ASSIGN = re.compile(
    r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
ACCESS, HEX = re.compile(r"AKIA[A-Z0-9]+"), re.compile(r"[0-9a-f]+")
SPACE_WORD = re.compile(r"[^\x20\x09-\x0D]+")
BENCH_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def secrets(text):
    text = text or ""
    found = [(m.start(), 0, "assign", m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    found += [(m.start(), 1, "access", m.end()) for m in ACCESS.finditer(text) if len(m[0]) >= 16]
    found += [(m.start(), 2, "hex", m.end()) for m in HEX.finditer(text) if len(m[0]) >= 32]
    spans = ",".join(f"{k}:{a}:{b}" for a, _, k, b in sorted(found))
    n = Counter(k for _, _, k, _ in found)
    return n["assign"], n["access"], n["hex"], SHA(spans), spans


def contamination(docs, items, window=13):
    """[(doc_id, text)], [(item_id, text)] -> rows of the contract."""
    words = lambda t: BENCH_WORD.findall((t or "").translate(LOWER))
    windows = defaultdict(set)
    for item, text in items:
        w = words(text)
        if w:
            size = min(window, len(w))
            for i in range(len(w) - size + 1):
                windows[tuple(w[i : i + size])].add("" if item is None else str(item))
    sizes = {len(w) for w in windows}
    out = []
    for doc_id, text in docs:
        w, hit, found = words(text), set(), set()
        for size in sizes:
            for i in range(len(w) - size + 1):
                got = windows.get(tuple(w[i : i + size]))
                if got:
                    found |= got
                    hit.update(range(i, i + size))
        out.append(
            (doc_id, len(w), len(hit), len(found), SHA(",".join(sorted(found))),
             len(hit) > 0 and 20 * len(hit) >= len(w))
        )
    return out


def fingerprint(text, width=3):
    w = SPACE_WORD.findall((text or "").translate(LOWER))
    if not w:
        return 0
    width = min(width, len(w))
    h = [xxhash.xxh64_intdigest(" ".join(w[i : i + width]).encode(), 42) for i in range(len(w) - width + 1)]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def simhash_groups(docs, distance=2):
    fps = [(d, fingerprint(t)) for d, t in docs]
    distinct = sorted({f for _, f in fps})
    root = {f: f for f in distinct}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(distinct):
        for b in distinct[:i]:
            if (a ^ b).bit_count() <= distance:
                root[find(a)] = find(b)
    least = {}
    for d, f in fps:
        if d is not None:
            r = find(f)
            least[r] = min(d, least.get(r, d))
    return [(d, f"{f:016x}", least.get(find(f))) for d, f in fps]


def removed_windows(docs, window=35):
    words = [SPACE_WORD.findall(t or "") for _, t in docs]
    counts = Counter(tuple(w[i : i + window]) for w in words for i in range(len(w) - window + 1))
    out = []
    for (doc_id, _), w in zip(docs, words):
        gone = set()
        for i in range(len(w) - window + 1):
            if counts[tuple(w[i : i + window])] > 1:
                gone.update(range(i, i + window))
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((doc_id, len(w), len(gone), SHA(kept)))
    return out


def rule_measures(text):
    text = text or ""
    w = SPACE_WORD.findall(text)
    grams = Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
    hit = {j for i in range(len(w) - 4) if grams[tuple(w[i : i + 5])] > 1 for j in range(i, i + 5)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if SPACE_WORD.search(line):
            dup += line in seen
            seen.add(line)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(hit)


def token_digest(docs, tokenizer, end_id=2):
    """Rows in ascending doc_id order, nulls first; equal ids must have equal texts."""
    out, start = [], 0
    for doc_id, text in sorted(docs, key=lambda d: (d[0] is not None, d[0] or 0)):
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, end_id]
        raw = b"".join(i.to_bytes(4, "little") for i in ids)
        out.append((doc_id, start, len(ids), zlib.crc32(raw)))
        start += len(ids)
    return out


def merkle(rows):
    """[(doc_id, source, lang, n_chars, text)] -> rows of the contract."""
    field = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    trees = defaultdict(list)
    for d, s, g, n, t in rows:
        leaf = SHA("".join(map(field, (d, s, g, n, t))))
        hit = d is not None and n is not None and zlib.crc32(str(d).encode()) % 7 == 0
        given = SHA("".join(map(field, (d, s, g, n + 1, t)))) if hit else leaf
        trees[g].append((d is not None, d or 0, leaf, given))

    def grow(level):
        levels = [level]
        while len(level) > 1:
            level = [SHA("".join(level[i : i + 2])) for i in range(0, len(level), 2)]
            levels.append(level)
        return levels

    def path(levels, i):
        for level in levels[:-1]:
            yield level[i ^ 1] if (i ^ 1) < len(level) else "", i % 2
            i //= 2

    order = sorted(trees, key=lambda g: (g is not None, (g or "").encode()))
    grown = {g: grow([x[2] for x in sorted(trees[g])]) for g in order}
    top = grow([grown[g][-1][0] for g in order])
    out = []
    for k, g in enumerate(order):
        for i, (named, d, leaf, given) in enumerate(sorted(trees[g])):
            steps = [*path(grown[g], i), *path(top, k)]
            got = given
            for sibling, ahead in steps:
                got = SHA(sibling + got if ahead else got + sibling)
            proof = SHA("".join(s for s, _ in steps))
            out.append((d if named else None, leaf, grown[g][-1][0], top[-1][0], proof, got, got == top[-1][0]))
    return out


def minhash_groups(docs, width=5):
    """[(doc_id, text)] -> rows of the contract, by all pairs of different sets."""
    sets = []
    for _, text in docs:
        w = SPACE_WORD.findall((text or "").translate(LOWER))
        k = min(width, len(w))
        sets.append(frozenset(tuple(w[i : i + k]) for i in range(len(w) - k + 1)) if w else frozenset())
    distinct = [s for s in dict.fromkeys(sets) if s]
    root = {s: s for s in distinct}

    def find(x):
        while root[x] is not x:
            x = root[x]
        return x

    for i, a in enumerate(distinct):
        for b in distinct[:i]:
            if 100 * len(a & b) >= 85 * len(a | b):
                root[find(a)] = find(b)
    least = {}
    for (d, _), s in zip(docs, sets):
        if s and d is not None:
            r = find(s)
            least[r] = min(d, least.get(r, d))
    out = []
    for (d, _), s in zip(docs, sets):
        c = least.get(find(s)) if s else d
        out.append((d, len(s), c, d is not None and d == c))
    return out


def hard_negatives(rows, n_positives=5, n_negatives=3):
    """[(vec_id, embedding, label)] -> rows of the contract; a row is no candidate of itself only."""
    from math import floor, isfinite

    vs = []
    for vec_id, v, label in rows:
        if label is None or v is None or any(x is None or not isfinite(x) for x in v):
            continue
        if vec_id is not None and vec_id % 7 == 0:
            label = (label + 1) % 10
        vs.append((vec_id, label, [floor(256.0 * x) for x in v]))
    order = lambda x: (-x[0], x[1] is None, x[1])
    out = []
    for i, (anchor, label, a) in enumerate(vs):
        if anchor is None or anchor % 50:
            continue
        alike, unlike = [], []
        for j, (vec_id, other, b) in enumerate(vs):
            if i != j:
                (alike if other == label else unlike).append((sum(x * y for x, y in zip(a, b)), vec_id))
        for p, pid in sorted(alike, key=order)[:n_positives]:
            fit = sorted((x for x in unlike if 50 * p <= 100 * x[0] <= 95 * p), key=order)[:n_negatives]
            out += [(anchor, pid, k, nid, p, s) for k, (s, nid) in enumerate(fit, 1)]
    return out


def rule_verdicts(docs):
    """[(doc_id, text)] -> (doc_id, n_words, word_chars, posterior, kept)."""
    from math import exp, log

    rows = []
    for d, text in docs:
        text = text or ""
        w = SPACE_WORD.findall(text)
        n, chars, symbols, dup, repeated = rule_measures(text)
        lines = sum(1 for line in text.split("\n") if SPACE_WORD.search(line))
        letters = sum(c.isalpha() for c in text)
        capitals = sum(c.isupper() for c in text)
        one, a_line = max(n, 1), max(lines, 1)
        length, different = chars / one, len(set(w)) / one
        varied = dup / a_line <= 0.05 and repeated / one <= 0.05 and different >= 0.3
        share = letters / max(chars, 1)
        votes = [
            1 if n >= 10 and 3 <= length <= 10 and symbols / one <= 0.02 and varied else 0,
            -1 if n >= 20 and share < 0.88 else 1 if share >= 0.93 else 0,
            -1 if symbols / one > 0.1 else 0,
            -1 if dup / a_line > 0.3 or repeated / one > 0.2 or (n >= 50 and different < 0.15) else 0,
            -1 if n < 10 else 0,
            -1 if n > 0 and (length < 2 or length > 15) else 0,
            -1 if letters >= 20 and capitals / max(letters, 1) > 0.4 else 0,
        ]
        rows.append((d, n, chars, votes, n < 10 or 100 * repeated > 20 * n))
    good, accuracy = 0.5, [0.9] * 7

    def quality(votes):
        return 1 / (1 + exp(-(log(good / (1 - good)) + sum(v * log(a / (1 - a)) for v, a in zip(votes, accuracy)))))

    for _ in range(100):
        post = [quality(r[3]) for r in rows]
        fresh = []
        for j in range(7):
            right = sum(p if r[3][j] > 0 else 1 - p for p, r in zip(post, rows) if r[3][j])
            cast = sum(1 for r in rows if r[3][j])
            fresh.append(min(0.99, max(0.55, (right + 1.8) / (cast + 2))))
        good, accuracy = (sum(post) + 1) / (len(rows) + 2), fresh
    return [(d, n, chars, quality(v), not failed and quality(v) >= 0.5) for d, n, chars, v, failed in rows]


def indicators(text, bits=18, runs=4):
    """Set indicators of the classifier; runs and the bias have the numbers after the grams."""
    raw, last = text.encode(), 1 << bits
    found = {(((raw[i] << 16 | raw[i + 1] << 8 | raw[i + 2]) * 0x9E3779B1) & 0xFFFFFFFF) >> (32 - bits) for i in range(len(raw) - 2)}
    words, longest, run = text.split(), 0, 0
    for a, b in zip(words, words[1:]):
        run = run + 1 if a == b else 0
        longest = max(longest, run)
    return sorted(found) + [last + k for k in range(min(longest, runs))] + [last + runs]


def classifier_weights(train, bits=18, runs=4, epochs=20, seed=7):
    """[(text, label)] -> function from an indicator to its ratio, and the weights as a dict.

    Naive Bayes ratios with counts from one on, hinge loss by dual coordinate descent with
    costs against the classes' shares.
    """
    from math import log, sqrt

    import numpy as np

    bias = (1 << bits) + runs
    rows = [(indicators(t), y) for t, y in train]
    width = (1 << bits) + runs + 1
    counts = {0: Counter(), 1: Counter()}
    for x, y in rows:
        counts[y].update(x)
    total = {c: width + sum(counts[c].values()) for c in counts}
    ratio = lambda f: 1.0 if f == bias else log((1 + counts[1][f]) / total[1]) - log((1 + counts[0][f]) / total[0])
    vectors = []
    for x, y in rows:
        v = {f: ratio(f) for f in x}
        size = sqrt(sum(a * a for a in v.values()))
        vectors.append(({f: a / size for f, a in v.items()}, 2 * y - 1))
    share = sum(y for _, y in rows) / len(rows)
    cost = [0.5 / share if y == 1 else 0.5 / (1 - share) for _, y in rows]
    w, alpha, order = defaultdict(float), [0.0] * len(rows), np.random.default_rng(seed)
    for _ in range(epochs):
        for i in order.permutation(len(rows)).tolist():
            v, y = vectors[i]
            new = min(max(alpha[i] - (y * sum(w[f] * a for f, a in v.items()) - 1), 0.0), cost[i])
            for f, a in v.items():
                w[f] += (new - alpha[i]) * y * a
            alpha[i] = new
    return ratio, w


def classifier_score(text, ratio, w, blend=0.25):
    """Score by weights (a dict without zeros) that are blended with their mean."""
    from math import exp, sqrt

    mean = sum(map(abs, w.values())) / len(w)
    x = indicators(text)
    r = [ratio(f) for f in x]
    blended = [(1 - blend) * mean * (1 if w[f] > 0 else -1) + blend * w[f] if f in w else 0.0 for f in x]
    return 1 / (1 + exp(-sum(b * a for b, a in zip(blended, r)) / sqrt(sum(a * a for a in r))))
