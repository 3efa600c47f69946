"""Plain Python versions of the operators, for small inputs."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate({i: i + 32 for i in range(65, 91)}))


def repeats(rows, length=100):
    """{id: (bytes, removed, spans, sha256)} of (id, text)."""
    seen, out = set(), {}
    for d, t in sorted(rows, key=lambda r: r[0]):
        b = (t or "").encode()
        gone = bytearray(len(b))
        for i in range(len(b) - length + 1):
            w = b[i:i + length]
            if w in seen:
                gone[i:i + length] = b"\1" * length
            else:
                seen.add(w)
        spans = sum(g and not p for g, p in zip(gone, b"\0" + bytes(gone), strict=False))
        out[d] = (len(b), sum(gone), spans, hashlib.sha256(bytes(c for c, g in zip(b, gone, strict=True) if not g)).hexdigest())
    return out


def shingle_set(text, n=5):
    w = words(text)
    if not w:
        return frozenset()
    return frozenset(tuple(w[i:i + n]) for i in range(len(w) - n + 1)) if len(w) >= n else frozenset([tuple(w)])


def components(rows):
    """{id: (size, component)} under Jaccard >= 0.75."""
    sets = {d: shingle_set(t) for d, t in rows}
    owners = defaultdict(list)
    for d in sorted(sets):
        for s in sets[d]:
            owners[s].append(d)
    parent = {d: d for d in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for d in sorted(sets):
        shared = Counter(e for s in sets[d] for e in owners[s] if e < d)
        for e, o in shared.items():
            if 100 * o >= 75 * (len(sets[d]) + len(sets[e]) - o):
                a, b = root(d), root(e)
                parent[max(a, b)] = min(a, b)
    return {d: (len(sets[d]), root(d)) for d in sets}


def language_model(rows, mu):
    """{id: (held, tokens, known, N, base, score)} of (id, text)."""
    uni, pair, context, total = Counter(), Counter(), Counter(), 0

    def held(d):
        return zlib.crc32(str(d if d is not None else "").encode()) % 10 == 0

    for d, t in rows:
        if not held(d):
            w = [*words(t), None]
            total += len(w)
            uni.update(w)
            before = ["", *w[:-1]]
            pair.update(zip(before, w, strict=True))
            context.update(before)
    den = total + 0.1 * (len(uni) + 1)
    out = {}
    for d, t in rows:
        w = [*words(t), None]
        before = ["", *w[:-1]]
        out[d] = (held(d), len(w), sum(uni[x] > 0 for x in w), total, sum(math.log10((uni[x] + 0.1) / den) for x in w),
                  sum(math.log10((pair[u, x] + mu * (uni[x] + 0.1) / den) / (context[u] + mu)) for u, x in zip(before, w, strict=True)))
    return out


def weighted(seq):
    """Weighted multiset of 5-word shingles (weight: bytes of the words); fewer words: one shingle of all."""
    n = min(5, len(seq))
    c = Counter(tuple(seq[i:i + n]) for i in range(len(seq) - n + 1)) if seq else Counter()
    return {s: k * sum(len(x.encode()) for x in s) for s, k in c.items()}


def contaminated(rows, items, threshold=0.75):
    """{(id, item): best similarity over item-sized windows}."""
    out = {}
    bench = [(i, words(t)) for i, t in items]
    for d, t in rows:
        w = words(t)
        have = shingle_set(t)
        for i, b in bench:
            if not b or (len(b) >= 5 and not have & shingle_set(" ".join(b))):
                continue
            target = weighted(b)
            best = 0.0
            if len(b) < 5:
                best = float(any(w[k:k + len(b)] == b for k in range(len(w))))
            else:
                for k in range(max(1, len(w) - len(b) + 1)):
                    own = weighted(w[k:k + len(b)])
                    inter = sum(min(v, target.get(s, 0)) for s, v in own.items())
                    best = max(best, inter / (sum(own.values()) + sum(target.values()) - inter))
            if best >= threshold:
                out[d, i] = best
    return out


# ---------------------------------------------------------------- language ID

def _letters(text):
    return [b if 0x61 <= b <= 0x7A or b >= 0x80 else 32 for b in (text or "").lower().encode()]


def _grams(data, buckets):
    out = []
    for p, c, n in zip([32, *data[:-1]], data, [*data[1:], 32], strict=True):
        x = (p * 0x9E3779B1 + c * 0x85EBCA77 + n * 0xC2B2AE3D) % (1 << 32)
        x = (x ^ x >> 15) * 0x2C1B3C6D % (1 << 32)
        out.append((x >> 16) % buckets)
    return out


def language_labels(train, rows, script_of, penalty=8.0, buckets=1 << 16):
    """{id: (language, score)}: one text, one word, one byte at a time; ``script_of``: bits of every byte value."""
    import numpy as np

    counts, scripts = defaultdict(Counter), defaultdict(Counter)
    for text, lang in train:
        if text is not None and lang is not None:
            data = _letters(text)
            for b, g in zip(data, _grams(data, buckets), strict=True):
                if b != 32:
                    counts[lang][g] += 1
                    for k in range(16):
                        if int(script_of[b]) >> k & 1:
                            scripts[lang][k] += 1
    langs = sorted(counts)
    logp = np.zeros((len(langs), buckets), np.float32)
    allowed = []
    for i, lang in enumerate(langs):
        c = np.zeros(buckets)
        for g, n in counts[lang].items():
            c[g] = n
        logp[i] = np.log((c + 0.5) / (c.sum() + 0.5 * buckets))
        total = max(1, sum(scripts[lang].values()))
        allowed.append(sum(1 << k for k, n in scripts[lang].items() if n >= 0.001 * total))
    logp -= logp.mean(axis=0)
    out = {}
    for d, text in rows:
        data = _letters(text)
        words, at = [], 0
        grams = _grams(data, buckets) if data else []
        while at < len(data):
            end = at
            while end < len(data) and data[end] != 32:
                end += 1
            if end > at:
                bits = 0
                for b in data[at:end]:
                    bits |= int(script_of[b])
                scores = [np.float32(sum(float(logp[i][g]) for g in grams[at:end])) for i in range(len(langs))]
                fits = [bool(a & bits) or not bits for a in allowed]
                scores = [np.float32(0)] * len(langs) if not any(fits) else [s if f else np.float32(-100) for s, f in zip(scores, fits, strict=True)]
                words.append((scores, end - at))
            at = end + 1
        value, back = None, []
        for scores, _ in words:
            if value is None:
                value = list(scores)
                continue
            best = max(range(len(langs)), key=lambda i: (value[i], -i))
            switch = np.float32(value[best] - np.float32(penalty))
            back.append([i if value[i] >= switch else best for i in range(len(langs))])
            value = [np.float32(max(v, switch) + s) for v, s in zip(value, scores, strict=True)]
        mass = [0] * len(langs)
        if value is not None:
            label = max(range(len(langs)), key=lambda i: (value[i], -i))
            for k in range(len(words) - 1, -1, -1):
                mass[label] += words[k][1]
                if k:
                    label = back[k - 1][label]
        told = sum(mass) > 0 and any(ch.isalpha() for ch in text or "")
        top = max(range(len(langs)), key=lambda i: (mass[i], -i)) if langs else 0
        out[d] = (langs[top], mass[top] / sum(mass)) if told else ("und", 0.0)
    return out


# ---------------------------------------------------------------- quality labellers and their label model

def quality_votes(text):
    """Votes of the seven labellers: 0 abstains, 1 is bad, 2 is good."""
    import numpy as np

    f = np.float32
    w, raw = words(text), (text or "").encode()
    n, size = max(1, len(w)), max(1, len(raw))
    capitals = sum(65 <= b <= 90 for b in raw)
    alpha = max(1, capitals + sum(97 <= b <= 122 for b in raw))
    lines = [tuple(sorted(x)) for x in (words(line) for line in (text or "").split("\n")) if x]
    symbols = f(sum(chr(b) in "#$%&*|!@~^{}<>=_+" for b in raw) / size)
    capital, bars = f(capitals / alpha), f(raw.count(b"|") / n)
    repeated, echo = f(1 - len(set(w)) / n), f(sum(a == b for a, b in zip(w, w[1:], strict=False)) / n)
    doubled = f(1 - len(set(lines)) / max(1, len(lines)))

    def vote(good, bad):
        return 1 if bad else 2 if good else 0

    return (vote(symbols < 0.01, symbols > 0.04), vote(capital < 0.15, capital > 0.4), vote(bars < 0.05, bars > 0.2),
            vote(len(w) >= 20 and repeated < 0.5, len(w) >= 20 and repeated > 0.75), vote(echo < 0.02, len(w) >= 6 and echo > 0.1),
            vote(doubled < 0.1, doubled > 0.3), vote(len(w) >= 40, len(w) < 3))


def label_posteriors(votes, given, rounds=100):
    """P(positive) of every document by EM over documents; ``given``: (votes, class) of the labelled ones, scaled to the mass of all."""
    mass = len(votes)
    scale = mass / max(1, len(given))
    k = len(votes[0])
    pattern = sorted(set(votes))
    times, told = Counter(votes), Counter((v, c) for v, c in given)
    post = {p: (told[p, 1] * scale + 0.01) / ((told[p, 0] + told[p, 1]) * scale + 0.02) for p in pattern}
    for _ in range(rounds):
        rates = [[[0.5] * 3 for _ in range(2)] for _ in range(k)]
        yes = 0.0
        for p in pattern:
            up, down = times[p] * post[p] + told[p, 1] * scale, times[p] * (1 - post[p]) + told[p, 0] * scale
            yes += up
            for j, v in enumerate(p):
                rates[j][1][v] += up
                rates[j][0][v] += down
        for j in range(k):
            for c in range(2):
                total = sum(rates[j][c])
                rates[j][c] = [x / total for x in rates[j][c]]
        prior = min(max(yes / (mass + scale * sum(told[p, c] for p in pattern for c in (0, 1))), 1e-6), 1 - 1e-6)
        new = {}
        for p in pattern:
            a = math.log(prior) + sum(math.log(rates[j][1][v]) for j, v in enumerate(p))
            b = math.log(1 - prior) + sum(math.log(rates[j][0][v]) for j, v in enumerate(p))
            new[p] = 1 / (1 + math.exp(min(500, max(-500, b - a))))
        moved = max(abs(new[p] - post[p]) for p in pattern)
        if moved < 1e-9:
            break
        post = new
    return [new[v] for v in votes]
