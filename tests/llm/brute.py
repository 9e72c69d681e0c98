"""Plain versions of the operators, to hold their results against."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import xxhash

WORD10 = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
BLANKS = re.compile("[^\x20\x09-\x0d]+")
_LOW = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def decontaminate(docs, items, window=10):
    """doc rows of (n_words, n_hit, n_items, digest, contaminated)."""
    split = lambda t: WORD10.findall((t or "").translate(_LOW))
    wins = defaultdict(set)
    for item, text in items:
        w = split(text)
        size = min(window, len(w))
        for i in range(len(w) - size + 1 if w else 0):
            wins[tuple(w[i : i + size])].add(item)
    sizes = {len(w) for w in wins}
    out = []
    for doc, text in docs:
        w, hit, found = split(text), set(), set()
        for size in sizes:
            for i in range(len(w) - size + 1):
                if own := wins.get(tuple(w[i : i + size])):
                    hit.update(range(i, i + size))
                    found |= own
        names = ",".join(sorted(str(x) for x in found if x is not None))
        out.append((doc, len(w), len(hit), len([x for x in found if x is not None]), hashlib.sha256(names.encode()).hexdigest(), bool(hit)))
    return out


def shingles(text):
    w = BLANKS.findall((text or "").translate(_LOW))
    return {tuple(w)} if len(w) == 1 else {tuple(w[i : i + 2]) for i in range(len(w) - 1)}


def near_duplicates(docs, percent=80):
    """(doc_id, n_shingles, component_id, kept), all pairs that share a shingle compared."""
    sets = [(d, shingles(t)) for d, t in docs]
    by = defaultdict(list)
    for i, (_, s) in enumerate(sets):
        for x in s:
            by[x].append(i)
    root = list(range(len(sets)))

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for i, (_, s) in enumerate(sets):
        both = defaultdict(int)
        for x in s:
            for j in by[x]:
                if j > i:
                    both[j] += 1
        for j, n in both.items():
            if 100 * n >= percent * (len(s) + len(sets[j][1]) - n):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    least = {}
    for i, (d, s) in enumerate(sets):
        if s and d is not None:
            least[find(i)] = min(least.get(find(i), d), d)
    return [(d, len(s), c := least.get(find(i)) if s else d, d == c) for i, (d, s) in enumerate(sets)]


_ASSIGN = re.compile(r"""(?ai:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")


def secrets(text):
    """Base spans (start, rank, kind, stop) of a text."""
    text, out = text or "", []
    out += [(m.start(), 0, "assign", m.end()) for m in _ASSIGN.finditer(text) if len(m[2]) >= 12]
    out += [(m.start(), 1, "access", m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    out += [(m.start(), 2, "hex", m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 16]
    return sorted(out)


def secret_row(doc, text):
    spans = secrets(text)
    joined = ",".join(f"{k}:{a}:{b}" for a, _, k, b in spans)
    count = lambda kind: sum(s[2] == kind for s in spans)
    return doc, count("assign"), count("access"), count("hex"), hashlib.sha256(joined.encode()).hexdigest()


def url_scores(learn, tune, urls, order=5, lam=2.0):
    """Scores of URLs by the two smoothed models of all (url, accepted) rows of `learn`, and the cut by `tune`."""

    def grams(url):
        t = "\x02" * (order - 1) + (url.partition("://")[2] or url).lower() + "\x03"
        return [[t[i - k : i] for k in range(1, order + 1)] for i in range(order, len(t) + 1)]

    counts, contexts = defaultdict(lambda: [0, 0]), defaultdict(lambda: [0, 0])
    for url, accepted in set(learn):
        for row in grams(url):
            for g in row:
                counts[g][0 if accepted else 1] += 1
    counts = {g: n for g, n in counts.items() if len(g) == 1 or sum(n) > 1}
    for g, n in counts.items():
        for y in (0, 1):
            contexts[g[:-1]][y] += n[y]

    def p(g, y):
        return (counts[g][y] + lam * (p(g[1:], y) if len(g) > 1 else 1 / 128)) / (contexts[g[:-1]][y] + lam)

    def weight(g):
        if g in counts:
            return math.log(p(g, 0) / p(g, 1)) - (math.log(p(g[1:], 0) / p(g[1:], 1)) if len(g) > 1 else 0.0)
        na, nb = contexts.get(g[:-1], (0, 0))
        return math.log((nb + lam) / (na + lam))

    def score(url):
        rows = grams(url)
        return sum(weight(g) for row in rows for g in row) / len(rows)

    (ma, sa), (mb, sb) = ((np.mean(x), np.std(x) + 1e-9) for x in ([score(u) for u, a in set(tune) if a == y] for y in (True, False)))
    return [score(u) for u in urls], (ma * sb + mb * sa) / (sa + sb)


def toxicity_scores(docs, labels, bits=31, min_z=4.5, epochs=300, decay=2e-4):
    """Scores of the documents by dense non-negative positive-unlabelled logistic regression on screened words."""
    held = lambda d: d is None or zlib.crc32(str(d).encode()) % 5 == 0
    words = lambda t: {xxhash.xxh3_64_intdigest(w) % (1 << bits) for w in re.findall(r"\w+", (t or "").casefold())}
    known = [(d, y) for d, y in labels if not held(d)]
    prior = float(np.mean([y for _, y in known if y in (0, 1)]))
    toxic = {d for d, y in known if y == 1}
    sets = [(d, words(t)) for d, t in docs]
    p, u = [s for d, s in sets if d in toxic], [s for d, s in sets if not held(d)]
    vocabulary = []
    for w in sorted(set().union(*p)):
        a, b = sum(w in s for s in p), sum(w in s for s in u)
        sp, su, both = a / len(p), (b + 0.5) / (len(u) + 1), (a + b) / (len(p) + len(u))
        z = (sp - su) / math.sqrt(both * (1 - both) * (1 / len(p) + 1 / len(u)) + 1e-12)
        if a >= 2 and z >= min_z and sp >= 2 * su:
            vocabulary.append(w)
    dense = lambda rows: np.array([[w in s for w in vocabulary] + [True] for s in rows], float)
    xp, xu, sig = dense(p), dense(u), lambda g: 1 / (1 + np.exp(-g))
    w, m, v = np.zeros(len(vocabulary) + 1), 0.0, 0.0
    for t in range(1, epochs + 1):
        gp, gu = xp @ w, xu @ w
        up = -prior * ((1 - sig(gp))[:, None] * xp).mean(0)
        down = (sig(gu)[:, None] * xu).mean(0) - prior * (sig(gp)[:, None] * xp).mean(0)
        below = np.log1p(np.exp(gu)).mean() - prior * np.log1p(np.exp(gp)).mean() < 0
        grad = (-down if below else up + down) + decay * np.append(w[:-1], 0)
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad**2
        w = w - 0.1 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-8)
    return len(vocabulary), sig(dense([s for _, s in sets]) @ w)


def quality_statistics(text):
    """The statistics of a text, character by character and word by word."""
    text = text or ""
    kinds = Counter()
    for ch in text:
        kinds["mark" if ch in ".,;:'\"?-()" else "beyond" if ord(ch) > 127 else "lower" if ch.islower() else "upper" if ch.isupper() else "digit" if ch.isdigit() else "blank" if ch.isspace() else "symbol"] += 1
    share = lambda k: kinds[k] / max(1, len(text))
    logit = lambda x: math.log((x + 0.002) / (1.002 - x))
    words = text.split()
    n, lengths = len(words), [len(w) for w in words]
    mean = sum(lengths) / n if n else 0.0
    spread = math.sqrt(sum((x - mean) ** 2 for x in lengths) / n) if n else 0.0
    tally = Counter(words)
    parts = [q for q in (x.strip() for x in re.split(r"[.\n]+", text)) if q]
    letters = share("lower") + share("upper") + share("beyond")
    of = lambda x: logit(x / n if n else 0.0)
    return [
        math.log1p(len(text)), math.log1p(n), math.log1p(mean), math.log1p(spread), math.log1p(max(lengths, default=0)),
        logit(letters), logit(share("upper") / letters if letters else 0.0), logit(share("digit")), logit(share("blank")), logit(share("mark")), logit(share("symbol")),
        of(len(tally)), math.log1p(len(tally)) / math.log1p(n) if n else 0.0, of(max(tally.values(), default=0)), of(sum(c == 1 for c in tally.values())),
        logit(1 - len(set(parts)) / len(parts) if parts else 0.0), math.log1p(n / len(parts)) if parts else 0.0, of(sum(x <= 2 for x in lengths)),
    ]


def licence_paragraphs(text):
    """The word lists of a text's lines and sentences."""
    return [w for p in re.split(r"\n+|(?<=[.!?;])\s+", (text or "").lower(), flags=re.ASCII) if (w := re.findall(r"[a-z]+|[0-9]+(?:\.[0-9]+)*", p))]


def word_pairs(words):
    return set(zip(words, words[1:], strict=False))


def template_shares(words, pairs):
    """For each family the best share of the shorter's 2-grams that a paragraph and a template have in common."""
    own = word_pairs(words)
    return {f: max(len(own & t) / max(min(len(own), len(t)), 2) for t in ts) for f, ts in pairs.items()}


def licence_hits(paragraphs, families, weights, intercepts, templates, cut, confirm):
    """Family and probability of paragraphs (text: shares) by the softmax of their 1- and 2-grams."""
    grams = lambda w: {*w, *map(" ".join, word_pairs(w))}
    place = {g: i for i, g in enumerate(sorted(set().union(*(grams(t.split()) for ts in templates.values() for t in ts))))}
    out = {}
    for text, shares in paragraphs.items():
        x = np.zeros(len(place))
        x[[place[g] for g in grams(text.split()) if g in place]] = 1
        m = weights @ x + intercepts
        p = (np.exp(m - m.max()) / np.exp(m - m.max()).sum())[1:]
        best = int(p.argmax())
        if p[best] >= cut and shares[best] >= confirm:
            out[text] = (families[best], p[best])
    return out
