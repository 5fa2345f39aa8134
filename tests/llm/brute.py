"""Brute-force versions that the tests hold the operators against."""

import math
import re
from collections import Counter

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words_of(t):
    return WORD.findall(t or "")


def brute_components(sets):
    """Least doc_id over rows that links reach; None without one."""
    label = list(range(len(sets)))

    def find(i):
        while label[i] != i:
            i = label[i]
        return i

    for i, (_, a) in enumerate(sets):
        for j in range(i):
            b = sets[j][1]
            both = len(a & b)
            if both and 100 * both >= 75 * (len(a) + len(b) - both):
                x, y = find(i), find(j)
                label[max(x, y)] = min(x, y)
    groups = {}
    for i in range(len(sets)):
        groups.setdefault(find(i), []).append(i)
    out = {}
    for members in groups.values():
        ids = [sets[i][0] for i in members if sets[i][0] is not None]
        for i in members:
            out[i] = min(ids, default=None) if sets[i][1] else sets[i][0]
    return out, groups


def shingles(t):
    w = words_of(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def quality_of(got):
    """A function from a row's counts to its quality: expectation maximisation over the rows that pass the base rules, one by one."""

    def votes(r):
        n = max(r["n_words"], 1)
        vote = lambda good, bad: -1 if bad else 1 if good else 0
        lines = r["n_dup_lines"] / max(r["n_lines"], 1)
        mean = r["word_chars"] / n
        return (
            vote(r["n_words"] >= 100, r["n_words"] < 50), vote(3 <= mean <= 10, mean < 2 or mean > 14), vote(r["n_symbols"] / n < 0.05, r["n_symbols"] / n > 0.2),
            vote(r["n_dup_lines"] == 0, lines > 0.3), vote(r["n_repeat_words"] / n < 0.2, r["n_repeat_words"] / n > 0.4), vote(r["n_shouts"] / n < 0.05, r["n_shouts"] / n > 0.3),
        )

    seen = [votes(r) for r in got if not r["base_failed"]]
    start = {1: {1: 0.6, 0: 0.25, -1: 0.15}, 0: {1: 0.15, 0: 0.25, -1: 0.6}}
    prior, weight = 0.8, max(5.0, 0.01 * len(seen))
    p = [{y: dict(start[y]) for y in (0, 1)} for _ in range(6)]
    chance = lambda v: 1 / (1 + (1 - prior) / prior * math.prod(p[k][0][x] / p[k][1][x] for k, x in enumerate(v)))
    for _ in range(100):
        q = [chance(v) for v in seen]
        mass = [{y: {x: weight * start[y][x] + sum((w if y else 1 - w) for v, w in zip(seen, q, strict=True) if v[k] == x) for x in (1, 0, -1)} for y in (0, 1)} for k in range(6)]
        was, prior = prior, min(0.99, max(0.01, (sum(q) + 0.8 * weight) / (len(seen) + weight)))
        p = [{y: {x: m / sum(mass[k][y].values()) for x, m in mass[k][y].items()} for y in (0, 1)} for k in range(6)]
        if abs(was - prior) < 1e-9:
            break
    return lambda r: chance(votes(r))


def without_repeats(texts, width=35):
    """(words, removed words, text that is left) of each text."""
    w = [words_of(t) for t in texts]
    seen = Counter(tuple(x[i : i + width]) for x in w for i in range(len(x) - width + 1))
    out = []
    for t, x in zip(texts, w, strict=True):
        gone = {j for i in range(len(x) - width + 1) if seen[tuple(x[i : i + width])] > 1 for j in range(i, i + width)}
        out.append((len(x), len(gone), " ".join(y for i, y in enumerate(x) if i not in gone) if gone else t))
    return out


def best_fit(sizes, lengths=(512, 1024, 2048, 4096), overhead=16):
    """(bin, offset, final length) of each size: best fit by looking at every bin."""
    bins = []  # [capacity, filled, last touched]
    out = []
    for t, s in enumerate(sizes):
        fits = [(c - f, -at, i) for i, (c, f, at) in enumerate(bins) if c - f >= s]
        if fits:
            i = min(fits)[2]
        else:
            i = len(bins)
            c = min((c for c in lengths if c >= s), key=lambda c: ((c + overhead) / (s * (c // s)), c))
            bins.append([c, 0, t])
        out.append((i, bins[i][1]))
        bins[i][1] += s
        bins[i][2] = t
    final = [min(c for c in lengths if c >= f) for _, f, _ in bins]
    return [i for i, _ in out], [o for _, o in out], [final[i] for i, _ in out]
