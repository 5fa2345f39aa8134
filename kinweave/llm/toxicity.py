"""Toxicity by a subsequence string kernel, Nystrom landmarks and a linear support vector machine.

A sentence is as toxic as its most toxic word, and a document as its most toxic sentence or as all its
words together (see below), whichever is more. Words are compared by their common subsequences of LENGTH
letters: each counts DECAY to the power of the shortest stretch it takes in either word, so a word with gaps
or inserted characters stays close to the insult it hides, and a word with marks within it counts without
them, however many they are. Runs of single letters count as one word as well. Landmarks are insults found in
training sentences, as runs of letters and as whole words; the kernel to the landmarks, whitened by the kernel
among them, is the feature vector of a linear SVM.

Training: a bounded sample of labelled documents (SAMPLE of each label, by a hash of doc_id), whose
sentences have their document's label. Landmarks are the runs of letters that many unlike toxic
documents share and clean ones hardly have, each by its own counts against chance. The SVM learns from the
witness words of toxic sentences, also with characters put in, against the words of clean sentences.

All words together: words that mark toxicity by being repeated stand in clean documents as well, so a
second SVM weighs how often a document holds each piece (a word or a beginning of words). Pieces are
those that toxic documents of one kind, mostly a language, hold once, twice or three times more often
than clean ones of that kind beyond chance; the threshold is taken from documents left out of the fit.

A word is compared only if it has letters enough for a subsequence of some landmark; of others the kernel
is 0. Null or empty text, or no words: the score of no toxic word. Very long texts: scored whole. Repeated rows
get the same score. Ties at the threshold: toxic. Null doc_id: scored like others, never taught. Extra columns
pass through. Empty table: no rows. No labels of one kind: every score is 0.
"""

from __future__ import annotations

import collections
import functools
import itertools
import math
import re
import sys

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinweave.llm.common import mix, rolling, small_batches, table

LENGTH, DECAY = 4, 0.6
#: Labelled documents of either label, clean words for the SVM.
SAMPLE, CLEAN_WORDS = 1500, 6000
#: Longer texts, in characters, teach nothing, so that the sample has a bound in bytes as well; they are scored whole like all others.
LONGEST_TAUGHT = 100_000
THRESHOLD = 0.7
#: Share of clean documents that the pieces may score as toxic.
FALSE = 0.002
#: The least margin of the pieces that is toxic, whatever the clean documents reach.
FLOOR = 0.2
#: Longer words are cut into overlapping stretches of this many letters.
WIDE = 16
_STRIP = re.compile(r"^[\W\d_]+|[\W\d_]+$")
_MARKS = re.compile(r"[\W\d_]+")


def units(text: str) -> list[str]:
    """The words of a text in lower case, without marks at their ends, and runs of single letters joined. A word with marks within it is also one without them."""
    out, run = [], []
    for w in text.lower().split():
        w = w if w.isalpha() else _STRIP.sub("", w)
        if len(w) == 1:
            run.append(w)
            continue
        if len(run) >= LENGTH:
            out.append("".join(run))
        run = []
        if len(w) >= LENGTH:
            out.append(w)
            if not w.isalpha() and len(bare := _MARKS.sub("", w)) >= LENGTH:
                out.append(bare)
    if len(run) >= LENGTH:
        out.append("".join(run))
    return out


def stretches(word: str) -> list[str]:
    return [word] if len(word) <= WIDE else [word[i : i + WIDE] for i in range(0, len(word) - WIDE // 2, WIDE // 2)]


def _flat(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(code points of all words, where each begins and the last ends)."""
    at = np.zeros(len(words) + 1, np.int64)
    np.cumsum([len(w) for w in words], out=at[1:])
    return np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32), at


def letter_bits(words: list[str]) -> np.ndarray:
    """64 bits of the letters of each word, none empty."""
    flat, at = _flat(words)
    return np.bitwise_or.reduceat(np.uint64(1) << (flat & 63).astype(np.uint64), at[:-1]) if words else np.empty(0, np.uint64)


@functools.lru_cache(64)
def _choices(n: int) -> tuple[np.ndarray, np.ndarray]:
    """All choices of LENGTH places of n in order, and what each weighs."""
    places = np.array(list(itertools.combinations(range(n), LENGTH)), np.int64).reshape(-1, LENGTH)
    return places, DECAY ** (places[:, -1] - places[:, 0] + 1.0)


class Scorer:
    """K(word, landmark) = sum over common subsequences of LENGTH letters of their weights in both words, over the landmark's own norm: a word's norm would count inserted characters against it."""

    def __init__(self, landmarks: list[str]):
        self.landmarks = landmarks
        letters = sorted(set("".join(landmarks)))
        self.letter = {c: i for i, c in enumerate(letters)}
        self.size = len(letters)
        weights: dict[int, dict[int, float]] = collections.defaultdict(dict)
        for k, word in enumerate(landmarks):
            places, weight = _choices(len(word))
            code = np.array([self.letter[c] for c in word])[places] @ self.size ** np.arange(LENGTH)
            total = collections.Counter()
            for c, w in zip(code.tolist(), weight.tolist(), strict=True):
                total[c] = max(total[c], w)
            norm = math.sqrt(sum(w * w for w in total.values()))
            for c, w in total.items():
                weights[c][k] = w / norm
        # Of each subsequence of a landmark, the landmarks that have it and its weights there.
        self.row = np.full(self.size**LENGTH, -1, np.int64)
        self.row[list(weights)] = np.arange(len(weights))
        self.first = np.cumsum([0, *(len(x) for x in weights.values())])
        self.column = np.array([k for x in weights.values() for k in x], np.int64)
        self.value = np.array([v for x in weights.values() for v in x.values()])
        self.bits = letter_bits(landmarks)
        # A word that shares a subsequence with a landmark has its letters: the fewest distinct ones of any of the landmark's.
        self.need = np.array([min(int(np.bitwise_count(letter_bits(["".join(x)])[0])) for x in itertools.combinations(w, LENGTH)) for w in landmarks], int)
        self.white = np.zeros((0, 0))
        self.weights, self.bias, self.scale, self.shift = np.zeros(0), 0.0, 1.0, 0.0
        self.weigher = Weigher([])
        if landmarks:
            value, vector = np.linalg.eigh(self.kernels(landmarks))
            keep = value > 1e-6
            self.white = vector[:, keep] / np.sqrt(value[keep])
            self.weights = np.zeros(self.white.shape[1])

    def kernels(self, words: list[str]) -> np.ndarray:
        """To each landmark."""
        n = len(self.landmarks)
        out = np.zeros((len(words), n))
        if not words:
            return out
        flat, at = _flat(words)
        table = np.full(int(flat.max()) + 1, -1, np.int64)
        for c, i in self.letter.items():
            if ord(c) < len(table):
                table[ord(c)] = i
        known = table[flat]
        length = np.diff(at)
        for size in np.unique(length).tolist():
            if size < LENGTH:
                continue
            mine = np.flatnonzero(length == size)
            places, weight = _choices(size)
            for block in np.array_split(mine, max(1, len(mine) * len(places) // 1_000_000)):
                letters = known[at[block][:, None] + np.arange(size)]
                code = np.zeros((len(block), len(places)), np.int64)
                bad = np.zeros(code.shape, bool)
                for k in range(LENGTH):
                    x = letters[:, places[:, k]]
                    bad |= x < 0
                    code += x * self.size**k
                code[bad] = 0
                row = self.row[code]
                w, p = np.nonzero(~bad & (row >= 0))
                # Of a subsequence's occurrences in a word the closest counts, so repeated syllables don't add up.
                cells, of = np.unique(w * len(self.first) + row[w, p], return_inverse=True)
                best = np.zeros(len(cells))
                np.maximum.at(best, of, weight[p])
                w, row = np.divmod(cells, len(self.first))
                many = self.first[row + 1] - self.first[row]
                entry = np.repeat(self.first[row] - np.cumsum(many) + many, many) + np.arange(int(many.sum()))
                cell = np.repeat(w, many) * n + self.column[entry]
                out[block] += np.bincount(cell, np.repeat(best, many) * self.value[entry], len(block) * n).reshape(-1, n)
        return out

    def near(self, bits: np.ndarray) -> np.ndarray:
        """Whether words of these letters can have a subsequence in common with any landmark."""
        found = np.zeros(len(bits), bool)
        for x, need in zip(self.bits, self.need, strict=True):
            found |= np.bitwise_count(bits & x) >= need
        return found

    def margins(self, words: list[str]) -> np.ndarray:
        """Of each word, the most of its stretches'."""
        out = np.full(len(words), self.bias)
        if not words or not self.landmarks:
            return out
        long = [i for i, w in enumerate(words) if len(w) > WIDE]
        parts, of = list(words), list(range(len(words)))
        for i in long:
            cut = stretches(words[i])
            parts[i] = cut[0]
            parts += cut[1:]
            of += [i] * (len(cut) - 1)
        near = np.flatnonzero(self.near(letter_bits(parts)))
        for k in range(0, len(near), 4096):
            mine = near[k : k + 4096]
            m = self.kernels([parts[i] for i in mine]) @ self.white @ self.weights + self.bias
            np.maximum.at(out, np.array(of)[mine], m)
        return out

    def score(self, margin: np.ndarray) -> np.ndarray:
        if not self.landmarks:
            return np.zeros_like(margin)
        return 1 / (1 + np.exp(-np.clip(self.scale * (margin - self.shift), -50, 50)))


# ---- training ---------------------------------------------------------------------------------------


def training_rows(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> list[tuple[str, int]]:
    """(text, toxic) of at most `sample` documents of each label outside the held-out fold, of LONGEST_TAUGHT characters at most. Of several texts of one id the smallest."""
    labels = labels.where((F.crc32(F.col("doc_id").cast("string")) % 3 != 1) & F.col("toxic").isin(0, 1)).select("doc_id", "toxic")
    order = F.xxhash64("doc_id", F.lit(5))
    picked = [labels.where(F.col("toxic") == k).groupBy("doc_id", "toxic").agg(F.first(order).alias("o")).orderBy("o", "doc_id").limit(sample).select("doc_id", "toxic") for k in (1, 0)]
    short = docs.select("doc_id", "text").where(F.length("text") <= LONGEST_TAUGHT)
    rows = short.join(F.broadcast(picked[0].union(picked[1])), "doc_id").groupBy("doc_id", "toxic").agg(F.min("text").alias("text"))
    return [x[1:] for x in sorted((r["doc_id"], r["text"], r["toxic"]) for r in rows.collect())]


def _stems(rows: list[str], size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, document, place) of every run of `size` letters within a word, once a document, by hash; places in the joined texts. Some documents at a time, for the driver's memory."""
    out, before = [], 0
    for k in range(0, len(rows), 100):
        some = rows[k : k + 100]
        flat = np.frombuffer("".join(some).encode("utf-32-le", "surrogatepass"), np.uint32)
        doc = np.repeat(np.arange(len(some), dtype=np.int32), [len(r) for r in some])
        if len(flat) >= size:
            h = rolling(mix(flat.astype(np.uint64) + np.uint64(1)), size)
            spaces = np.concatenate([[0], np.cumsum(flat == 32)])
            at = np.flatnonzero(spaces[size:] == spaces[:-size])
            at = at[doc[at] == doc[at + size - 1]]
            _, once = np.unique(mix(h[at] + doc[at].astype(np.uint64)), return_index=True)
            at = at[once]
            out.append((h[at], doc[at] + np.int32(k), (at + before).astype(np.int32)))
        before += len(flat)
    if not out:
        return np.empty(0, np.uint64), np.empty(0, np.int32), np.empty(0, np.int32)
    h, doc, at = (np.concatenate(x) for x in zip(*out, strict=True))
    order = np.argsort(h, kind="stable")
    return h[order], doc[order], at[order]


def toxic_stems(rows: list[tuple[str, int]], sizes: tuple[int, ...] = (6, 5, 4)) -> list[tuple[str, int]]:
    """(letters, documents): runs of letters that many unlike toxic documents share and clean ones hardly have.

    Copies of a document share all of its words, so documents are counted by four min-hashes of their
    words, and the least of the four counts holds: copies mostly have the same.
    """
    bad = [" ".join(units(t)) + " " for t, y in rows if y]
    good = [" ".join(units(t)) + " " for t, y in rows if not y]
    if not bad or not good:
        return []
    marks = np.array([[min((xxhash.xxh32_intdigest(w, k) for w in t.split()), default=0) for k in range(4)] for t in bad])
    joined = "".join(bad)
    least, found = 4, []

    def chance(n: int, clean: int) -> bool:
        return n < least or float(surprise(np.array([min(n, len(bad))]), len(bad), np.array([clean]), len(good))[0]) <= CHANCE

    for size in sizes:
        h, doc, at = _stems(bad, size)
        g = _stems(good, size)[0]
        name, first, n = np.unique(h, return_index=True, return_counts=True)
        clean = np.searchsorted(g, name, "right") - np.searchsorted(g, name, "left")  # g is sorted by hash
        for k in np.flatnonzero((n >= least) & (clean <= 0.01 * n)).tolist():
            mine = marks[doc[first[k] : first[k] + n[k]]]
            count = min(len(set(mine[:, j].tolist())) for j in range(4))
            if not chance(count, int(clean[k])):
                found.append((joined[at[first[k]] : at[first[k]] + size], count))
    found = sorted(found, key=lambda x: (-x[1] * (1 + 0.08 * len(x[0])), x[0]))  # a longer run says more
    if not found:
        return []
    # A run counts only where no run taken before it stands in the same word: endings of toxic words are no insults.
    clean_words = {u for t in good for u in t.split()}
    any_run = re.compile("|".join(re.escape(x) for x, _ in found))
    holds = collections.Counter(u for t in bad for u in set(t.split()) if any_run.search(u) and u not in clean_words)
    out: list[tuple[str, int]] = []
    for stem, count in found:
        mine = [u for u in holds if stem in u]
        if not chance(sum(holds[u] for u in mine), 0):
            out.append((stem, count))
            for u in mine:
                del holds[u]
    return out


def hidden(word: str, rng: np.random.Generator) -> str:
    """The word with a character put in or doubled."""
    i = int(rng.integers(1, len(word)))
    return word[:i] + str(rng.choice([*".-*_", word[i - 1]])) + word[i:]


def svm(x: np.ndarray, y: np.ndarray, weight: np.ndarray, rounds: int = 600, ridge: float = 1e-4) -> tuple[np.ndarray, float]:
    """Squared hinge loss by accelerated gradient descent."""
    z = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(z.shape[1])
    u = np.ones(z.shape[1])
    for _ in range(30):  # the largest eigenvalue bounds the steps
        u = z.T @ (weight * (z @ u))
        most = float(np.linalg.norm(u))
        u /= max(most, 1e-30)
    v, step = w.copy(), 1 / (2.2 * most + ridge)
    for k in range(rounds):
        slack = np.maximum(0, 1 - y * (z @ v))
        grad = -2 * z.T @ (weight * y * slack) + ridge * np.append(v[:-1], 0)
        w, was = v - step * grad, w
        v = w + k / (k + 3) * (w - was)
    return w[:-1], float(w[-1])


# ---- words that clean documents hold as well --------------------------------------------------------

#: Kinds of documents by their frequent words, and the least 2 ln of a likelihood ratio that isn't chance among all pieces.
KINDS, CHANCE = 8, 24.0
#: The longest beginning of a word that is a piece of its own.
LONGEST = 9


def tokens(text: str) -> list[str]:
    """All words of a text in lower case, without marks at their ends."""
    return [sys.intern(x) for w in text.lower().split() if (x := w if w.isalpha() else _STRIP.sub("", w))]


def pieces(word: str) -> list[str]:
    """A word's beginnings of three letters and more, and the whole word."""
    return [word[:n] for n in range(3, min(len(word), LONGEST + 1))] + [word + "$"]


def piece_counts(words: list[str], place: dict[str, int] | None = None, held: dict[str, list] | None = None) -> collections.Counter:
    """How many of the words hold each piece; with `place` only its pieces, by their places there."""
    many = collections.Counter(words)
    out: collections.Counter = collections.Counter()
    for w, n in many.items():
        if place is None:
            mine = pieces(w)
        elif held is None or (mine := held.get(w)) is None:
            mine = [place[x] for x in pieces(w) if x in place]
            if held is not None:
                held[w] = mine
        for x in mine:
            out[x] += n
    return out


def kinds(docs: list[list[str]], y: np.ndarray) -> np.ndarray:
    """Of each document its kind, by k-means over which of clean documents' most frequent words it holds: mostly its language. Words that mark toxicity make no kind."""
    often = collections.Counter(w for d, bad in zip(docs, y.tolist(), strict=True) if not bad for w in set(d))
    place = {w: i for i, (w, _) in enumerate(sorted(often.items(), key=lambda x: (-x[1], x[0]))[:100])}
    x = np.zeros((len(docs), len(place)))
    for i, d in enumerate(docs):
        x[i, [place[w] for w in set(d) if w in place]] = 1
    x /= np.maximum(1, np.linalg.norm(x, axis=1, keepdims=True))
    middle = x[:1]
    for _ in range(min(KINDS, len(docs)) - 1):  # each next one is the farthest from those before
        middle = np.vstack([middle, x[np.argmin((x @ middle.T).max(1))]])
    for _ in range(20):
        kind = np.argmax(x @ middle.T, 1)
        middle = np.array([x[kind == k].mean(0) if (kind == k).any() else middle[k] for k in range(len(middle))])
        middle /= np.maximum(1e-12, np.linalg.norm(middle, axis=1, keepdims=True))
    return kind


def surprise(a: np.ndarray, n: float, b: np.ndarray, m: float) -> np.ndarray:
    """2 ln of the likelihood ratio that a of n and b of m have different rates; 0 if b's is the higher."""

    def part(k, total, rate):
        with np.errstate(divide="ignore", invalid="ignore"):
            return np.where(k > 0, k * np.log(rate), 0) + np.where(total - k > 0, (total - k) * np.log1p(-rate), 0)

    one, two, both = a / max(n, 1), b / max(m, 1), (a + b) / max(n + m, 1)
    out = 2 * (part(a, n, one) + part(b, m, two) - part(a, n, both) - part(b, m, both))
    return np.where(one > two, out, 0)


class Weigher:
    """A linear SVM over how often a document holds pieces, each as a logarithm and as a share of its words."""

    def __init__(self, names: list[str]):
        self.place = {x: i for i, x in enumerate(names)}
        self.weights, self.bias, self.scale, self.shift = np.zeros(2 * len(names) + 1), 0.0, 1.0, 1e9

    def features(self, docs: list[list[str]], held: dict[str, list] | None = None) -> np.ndarray:
        n = len(self.place)
        out = np.zeros((len(docs), 2 * n + 1))
        for i, words in enumerate(docs):
            size = max(1, len(words))
            for k, many in piece_counts(words, self.place, {} if held is None else held).items():
                out[i, k] = math.log1p(many)
                out[i, n + k] = math.sqrt(many / size) * 4
            out[i, 2 * n] = math.log(size) / 4
        return out

    def margins(self, docs: list[list[str]], held: dict[str, list] | None = None) -> np.ndarray:
        return self.features(docs, held) @ self.weights + self.bias

    def scores(self, texts: list[str | None], held: dict[str, list]) -> np.ndarray:
        docs = [tokens(x or "") for x in texts]
        out = 1 / (1 + np.exp(-np.clip(self.scale * (self.margins(docs, held) - self.shift), -50, 50)))
        return np.where([len(d) > 0 for d in docs], out, 0.0)


def telling_pieces(docs: list[list[str]], y: np.ndarray) -> list[str]:
    """Pieces that more toxic documents of a kind hold once, twice or three times than chance explains, by their own counts alone."""
    if not y.any() or y.all():
        return []
    # Near copies count once.
    prints = [tuple(min((xxhash.xxh32_intdigest(w, k) for w in set(d)), default=0) for k in range(4)) for d in docs]
    once = sorted({(p, t): i for i, (p, t) in enumerate(zip(prints, y.tolist(), strict=True))}.values())
    docs, y = [docs[i] for i in once], y[once]
    kind = kinds(docs, y)
    seen: collections.Counter = collections.Counter()
    for i in np.flatnonzero(y).tolist():
        seen.update(piece_counts(docs[i]).keys())
    names = sorted(x for x, n in seen.items() if n >= 4)
    del seen
    place = {x: i for i, x in enumerate(names)}
    held: dict[str, list] = {}
    rows, columns, counts = [], [], []
    for i, d in enumerate(docs):
        c = piece_counts(d, place, held)
        rows.append(np.full(len(c), i, np.int32))
        columns.append(np.fromiter(c.keys(), np.int32, len(c)))
        counts.append(np.minimum(np.fromiter(c.values(), np.int64, len(c)), 100).astype(np.int8))
    row, column, count = (np.concatenate(x) for x in (rows, columns, counts))
    best = np.zeros(len(names))
    for k in np.unique(kind).tolist():
        n, m = int((y & (kind == k)).sum()), int((~y & (kind == k)).sum())
        if not n or not m:
            continue
        for cut in (1, 2, 3):
            mine = (kind[row] == k) & (count >= cut)
            a = np.bincount(column[mine & y[row]], minlength=len(names))
            b = np.bincount(column[mine & ~y[row]], minlength=len(names))
            best = np.maximum(best, np.where(a >= 4, surprise(a, n, b, m), 0))
    order = np.lexsort((np.arange(len(names)), -best))
    order = order[best[order] > CHANCE]
    at = np.full(len(names), -1)
    at[order] = np.arange(len(order))
    wanted = (at[column] >= 0) & y[row]
    held_by = np.zeros((len(docs), len(order)), np.float32)
    held_by[row[wanted], at[column[wanted]]] = 1
    held_by = held_by[y]
    size = held_by.sum(0)
    out: list[int] = []
    for k in range(len(order)):
        # Of a word and its beginnings, one that stands in the same documents as one before it says nothing new.
        name = names[order[k]].rstrip("$")
        near = [x for x in out if (other := names[order[x]].rstrip("$")).startswith(name) or name.startswith(other)]
        both = held_by[:, k] @ held_by[:, near]
        if not (both >= 0.95 * (size[k] + size[near] - both)).any():
            out.append(k)
    return [names[k] for k in order[out]]


def _weigh(docs: list[list[str]], y: np.ndarray) -> Weigher:
    made = Weigher(telling_pieces(docs, y))
    if made.place:
        weight = np.where(y, 0.5 / y.sum(), 0.5 / (~y).sum())
        made.weights, made.bias = svm(made.features(docs), np.where(y, 1.0, -1.0), weight, ridge=1e-3)
    return made


def weigh(rows: list[tuple[str, int]], folds: int = 3) -> Weigher:
    """The threshold comes from documents that neither the pieces nor the weights were taken from."""
    docs, y = [tokens(t) for t, _ in rows], np.array([bool(t) for _, t in rows], bool)
    if not y.any() or y.all():
        return Weigher([])
    made = _weigh(docs, y)
    if not made.place:
        return made
    fold = np.array([xxhash.xxh32_intdigest(t[:2000]) % folds for t, _ in rows])
    good, bad = [], []
    for k in range(folds):
        if not y[fold != k].any() or y[fold != k].all():
            continue
        other = _weigh([d for d, f in zip(docs, fold, strict=True) if f != k], y[fold != k])
        mine = other.margins([d for d, f in zip(docs, fold, strict=True) if f == k])
        good += mine[~y[fold == k]].tolist()
        bad += mine[y[fold == k]].tolist()
    if good and bad:
        good.sort()
        at = max(good[int((1 - FALSE) * (len(good) - 1))], FLOOR)
        made.scale = 3.0
        made.shift = at - math.log(THRESHOLD / (1 - THRESHOLD)) / made.scale
    return made


def whole_words(stems: list[str], rows: list[tuple[str, int]]) -> list[str]:
    """Of each stem the word that most toxic documents hold it in, if clean ones don't: with characters put in, a whole word keeps more of its subsequences than a part of it."""
    clean = {u for text, y in rows if not y for u in units(text)}
    holds = collections.Counter(u for text, y in rows if y for u in set(units(text)) if u.isalpha() and len(u) <= WIDE - 2 and u not in clean)
    out = []
    for stem in stems:
        mine = [(n, u) for u, n in holds.items() if stem in u]
        if mine:
            out.append(min(mine, key=lambda x: (-x[0], x[1]))[1])
    return out


#: Where sentences end, and rounds of picking the words that witness a sentence's label.
_SENTENCE = re.compile(r"[.!?]+\s|\n+")
ROUNDS = 3


def sentences(text: str) -> list[list[str]]:
    """The words of each sentence that has any."""
    return [u for x in _SENTENCE.split(text) if (u := units(x))]


def clean_reach(scorer: Scorer, texts: list[set[str]]) -> float:
    """The margin that all but one clean document in 500 stay below."""
    good: list[float] = []
    for i in range(0, len(texts), 100):
        some = sorted(set().union(*texts[i : i + 100]))
        seen = dict(zip(some, scorer.margins(some).tolist(), strict=True))
        good += [max((seen[u] for u in t), default=scorer.bias) for t in texts[i : i + 100]]
    good.sort()
    return good[int(0.998 * (len(good) - 1))]


def train(rows: list[tuple[str, int]]) -> Scorer:
    """Sentences have their document's label. Of a clean one all words are negative examples. A toxic document has clean sentences as
    well; a sentence of it counts as toxic if it has words that hold a whole landmark and are no clean sentence's words, and of these the one
    of the largest margin is its witness, a positive example. Witnesses are picked, the machine is fitted, and both again, until
    the witnesses stay."""
    stems = [x for x, _ in toxic_stems(rows)]
    landmarks = list(dict.fromkeys(stems + whole_words(stems, rows)))
    scorer = Scorer(landmarks)
    scorer.weigher = weigh(rows)
    if not landmarks:
        return scorer
    clean = collections.Counter(u for text, y in rows if not y for x in sentences(text) for u in x)
    # The clean words nearest to a landmark teach most, with the most frequent ones.
    names = sorted(w for w in clean if len(w) <= WIDE)
    names = [w for w, ok in zip(names, scorer.near(letter_bits(names)), strict=True) if ok]
    raw = np.concatenate([scorer.kernels(names[i : i + 4096]).max(1) for i in range(0, len(names), 4096)]) if names else np.zeros(0)
    hard = [names[i] for i in np.argsort(-raw, kind="stable")[: CLEAN_WORDS // 2]]
    often = [w for w, _ in sorted(clean.items(), key=lambda x: (-x[1], x[0]))[: CLEAN_WORDS // 2] if len(w) <= WIDE]
    negative = sorted({*hard, *often})
    # Of each toxic sentence the words that can be its witness.
    held = {u: any(x in u for x in landmarks) for text, y in rows if y for x in sentences(text) for u in x if len(u) <= WIDE - 2 and u not in clean}
    bad = [(i, mine) for i, (text, y) in enumerate(rows) if y for x in sentences(text) if (mine := sorted({u for u in x if held.get(u)}))]
    known = sorted({u for _, x in bad for u in x})
    worth = dict.fromkeys(known, 0.0)
    holds: collections.Counter = collections.Counter()
    rng = np.random.Generator(np.random.PCG64(11))
    for _ in range(ROUNDS):
        was, holds = holds, collections.Counter(u for _, u in {(i, max(x, key=lambda u: (worth[u], u))) for i, x in bad})
        if not holds or holds == was:
            break
        whole = sorted(holds)
        positive = whole + [hidden(w, rng) for w in whole]
        x = scorer.kernels(positive + negative) @ scorer.white
        y = np.array([1.0] * len(positive) + [-1.0] * len(negative))
        # A word counts by the documents that it stands for, so ten frequent insults aren't lost among many rare ones.
        times = np.array([holds[w] for w in whole] * 2 + [1.0] * len(negative))
        weight = np.where(y > 0, 0.5 * times / max(1.0, times[y > 0].sum()), 0.5 / max(1, len(negative)))
        scorer.weights, scorer.bias = svm(x, y, weight)
        worth = dict(zip(known, scorer.margins(known).tolist(), strict=True))
    if not holds:
        return scorer
    # The score is one half between what clean documents reach and what nearly all witnesses do.
    whole = sorted(holds)
    reach = scorer.margins(whole)
    order = np.argsort(reach)
    many = np.cumsum(np.array([holds[w] for w in whole], float)[order])
    # Clean documents are kept rather than toxic ones caught.
    low = clean_reach(scorer, [set(units(text)) for text, toxic in rows if not toxic])
    high = float(reach[order][np.searchsorted(many / many[-1], 0.02)])
    at = low + 0.35 * (high - low) if high > low else low + 0.05
    scorer.scale = min(15.0, max(4.0, 4.0 / max(1e-3, abs(high - low))))
    scorer.shift = at - math.log(THRESHOLD / (1 - THRESHOLD)) / scorer.scale
    return scorer


# ---- scoring ----------------------------------------------------------------------------------------


def score_documents(docs: DataFrame, scorer: Scorer, threshold: float = THRESHOLD) -> DataFrame:
    """docs, all columns, with score and predicted; own columns of these names are replaced."""
    small_batches(docs.sparkSession, 500)
    shared = docs.sparkSession.sparkContext.broadcast(scorer)
    own = [f for f in docs.schema if f.name not in ("score", "predicted")]

    def run(batches):
        s = shared.value
        seen: dict[str, float] = {}
        held: dict[str, list] = {}
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index("text"))
            found = [set(units(x or "")) if s.landmarks else set() for x in texts.to_pylist()]
            new = list(set().union(*found).difference(seen))
            if len(seen) + len(new) > 300_000:
                seen.clear()
                new = list(set().union(*found))
            seen.update(zip(new, s.margins(new).tolist(), strict=True))
            margins = np.array([max((seen[w] for w in words), default=s.bias) for words in found])
            score = s.score(margins)
            if s.weigher.place:
                if len(held) > 300_000:
                    held.clear()
                score = np.maximum(score, s.weigher.scores(texts.to_pylist(), held))
            columns = {f.name: batch.column(batch.schema.get_field_index(f.name)) for f in own}
            columns |= {"score": pa.array(score), "predicted": pa.array((score >= threshold).astype(np.int32))}
            yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

    return docs.mapInArrow(run, ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in own] + ["score double", "predicted int"]))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scorer = train(training_rows(docs, table(spark, sf_dir, "labels")))
    held_out = (F.crc32(F.col("doc_id").cast("string")) % 3 == 1).alias("held_out")
    return score_documents(docs, scorer).select("doc_id", held_out, "score", "predicted")
