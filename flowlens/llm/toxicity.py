"""Toxicity by a subsequence string kernel, Nyström landmarks and a support vector machine.

Two strings are compared by the subsequences of three letters that they share, gaps included; each
occurrence weighs ``DECAY`` to the power of its span, so that inserted or missing characters lower
the value but do not remove it. A sentence is described by its best kernel value with each of
``LANDMARKS`` landmark words (mapped by the landmarks' kernel matrix to the power -1/2), and a linear
SVM on these features decides. A document has the value of its most toxic sentence, turned into a
probability by Platt's logistic fit.

The model is fitted on the driver from at most ``SAMPLE`` labelled documents per class, drawn by a
hash of the id, never from held-out folds. The labels are of documents: the toxic sentence of a
toxic document is chosen anew after each fit. Scoring reads whole texts and needs no shuffle; the
kernel values of known words are kept by each worker process, up to ``KNOWN_WORDS``.

Defined cases: null and empty texts get the score of a text without sentences (near 0); without labelled rows
of both classes all scores are 0; a document labelled twice counts as toxic if one label says so;
repeated rows are scored one by one; other columns are never read.
"""

from __future__ import annotations

import math
import re
import uuid
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowlens.llm.chunks import append_columns
from flowlens.llm.text import fold

SAMPLE = 1000
LANDMARKS = 48
DECAY = 0.6
ORDER = 3
#: The normalised kernel is raised to this power (still a kernel), which parts near from equal strings.
POWER = 3
#: Weight of an altered toxic word against that of a sentence.
ALTERED_WEIGHT = 2.0
#: Longer strings are compared window by window.
WINDOW = 10
BLOCK_CHARS = 1_000_000
KNOWN_WORDS = 300_000
_SENTENCE = re.compile(r"[.!?\n]+(?:\s|$)")
#: Single letters, each apart from the next by one of these.
_APART = re.compile(r"[\s.\-_*]")
_EDGES = ".,;:!?\"'()[]{}"
#: Letter codes: a to z, and others by code point, so that up to ``_OTHERS`` neighbouring letters of a script differ.
_LETTERS, _OTHERS = 72, 45


def tokens(sentence: str) -> list[str]:
    """Lower-cased blank-separated strings; letters spelled apart stand as one string as well."""
    found, letters = [], []
    for word in sentence.lower().split():
        if len(word) > 2:
            found.append(word.strip(_EDGES))
            if word[1] in ".-_*" and max(map(len, parts := _APART.split(word))) == 1:
                found.append("".join(parts))
        elif len(word) == 1:
            letters.append(word)
            continue
        if letters:
            found.append("".join(letters))
            letters = []
    found.append("".join(letters))
    return [w for w in found if len(w) >= ORDER]


def sentences(text: str | None) -> list[list[str]]:
    return [found for s in _SENTENCE.split(text or "") if (found := tokens(s))]


def _codes(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Letter codes of windows of words, their lengths, and the word of each window."""
    windows, owner = [], []
    for n, word in enumerate(words):
        for at in range(0, max(1, len(word) - WINDOW + 2), 2):
            windows.append(word[at : at + WINDOW])
            owner.append(n)
    lengths = np.fromiter(map(len, windows), np.int64, len(windows))
    codes = np.zeros((len(windows), WINDOW), np.int64)
    for row, window in enumerate(windows):
        codes[row, : len(window)] = [ord(c) - 96 if "a" <= c <= "z" else 27 + ord(c) % _OTHERS for c in window]
    return codes, lengths, np.array(owner, np.int64)


def _triples(length: int) -> list[tuple[int, int, int]]:
    return [(i, j, k) for i in range(length) for j in range(i + 1, length) for k in range(j + 1, length)]


def _features(codes: np.ndarray, length: int) -> Iterator[tuple[np.ndarray, float]]:
    """Feature numbers and weight of each choice of three positions."""
    for i, j, k in _triples(length):
        yield (codes[:, i] * _LETTERS + codes[:, j]) * _LETTERS + codes[:, k], DECAY ** (k - i + 1)


@dataclass
class Vectors:
    """Normalised feature vectors of words, by the features that occur in them."""

    numbers: np.ndarray
    values: np.ndarray  # a row for each number and one of zeros, a column for each word

    def __len__(self) -> int:
        return self.values.shape[1]

    @cached_property
    def rows(self) -> np.ndarray:
        """The row of every feature number."""
        rows = np.full(_LETTERS**3, len(self.numbers), np.int32)
        rows[self.numbers] = np.arange(len(self.numbers))
        return rows


def explicit(words: list[str]) -> Vectors:
    """Normalised feature vectors of words (of their first windows)."""
    codes, lengths, owner = _codes(words)
    first = np.unique(owner, return_index=True)[1]
    entries = [
        (int(number[0]), word, weight)
        for word, at in enumerate(first)
        for number, weight in _features(codes[at : at + 1], int(lengths[at]))
    ]
    numbers, place = np.unique(np.array([e[0] for e in entries], np.int64), return_inverse=True)
    values = np.zeros((len(numbers) + 1, len(words)), np.float32)
    np.add.at(values, (place, np.array([e[1] for e in entries], np.int64)), np.array([e[2] for e in entries], np.float32))
    return Vectors(numbers, values / np.maximum(np.linalg.norm(values, axis=0), 1e-9))


def _squared_norm(codes: np.ndarray, length: int) -> np.ndarray:
    """Kernel of each string with itself, by the gap-weighted recursion over prefixes."""
    same = (codes[:, :length, None] == codes[:, None, :length]).astype(np.float64)
    inner = np.ones((len(codes), length + 1, length + 1))
    for _ in range(ORDER - 1):
        nxt = np.zeros_like(inner)
        for s in range(1, length + 1):
            run = np.zeros(len(codes))
            for t in range(1, length + 1):
                run = DECAY * run + DECAY**2 * same[:, s - 1, t - 1] * inner[:, s - 1, t - 1]
                nxt[:, s, t] = DECAY * nxt[:, s - 1, t] + run
        inner = nxt
    return DECAY**2 * (same * inner[:, :length, :length]).sum(axis=(1, 2))


def kernel(words: list[str], landmarks: Vectors) -> np.ndarray:
    """Normalised kernel of each word (its best window) with each landmark's feature vector."""
    table, place = landmarks.values, landmarks.rows
    codes, lengths, owner = _codes(words)
    values = np.zeros((len(codes), table.shape[1]), np.float32)
    for length in np.unique(lengths):
        rows = np.flatnonzero(lengths == length)
        if length < ORDER:
            continue
        for part in np.array_split(rows, max(1, len(rows) // 20_000)):
            total = np.zeros((len(part), table.shape[1]), np.float32)
            for number, weight in _features(codes[part], int(length)):
                total += np.float32(weight) * table[place[number]]
            norm = np.sqrt(_squared_norm(codes[part], int(length)))
            values[part] = (total / np.maximum(norm, 1e-9)[:, None]) ** POWER
    if not len(words):
        return values
    return np.maximum.reduceat(values, np.unique(owner, return_index=True)[1], axis=0)


@dataclass
class Model:
    landmarks: Vectors
    direction: np.ndarray  # SVM weights on raw kernel values: the Nyström map is folded in
    bias: float
    slope: float
    offset: float
    names: list[str]

    def probability(self, margin: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * margin + self.offset, -30, 30)))


def _pieces(word: str) -> set[str]:
    """Substrings of 4 to 6 letters, and the word itself if it fits a window."""
    found = {word[i : i + n] for n in (4, 5, 6) for i in range(len(word) - n + 1)}
    return found | {word} if len(word) <= WINDOW else found


def choose_landmarks(toxic: list[list[list[str]]], clean: list[list[list[str]]], most: int = LANDMARKS) -> list[str]:
    """Words and word parts whose contexts lie in toxic documents far more often than in clean ones.

    Contexts are counted, not documents, so that copies of one document count once. Each new
    landmark must differ from those before it; common clean words fill the rest.
    """
    seen: list[Counter] = []
    words: list[Counter] = []
    for docs in (toxic, clean):
        contexts = defaultdict(set)
        for doc in docs:
            for sentence in doc:
                for i, word in enumerate(sentence):
                    contexts[word].add((sentence[i - 1] if i else "", sentence[i + 1] if i + 1 < len(sentence) else ""))
        pieces: Counter = Counter()
        for word, around in contexts.items():
            for piece in _pieces(word):
                pieces[piece] += len(around)
        seen.append(pieces)
        words.append(Counter({w: len(c) for w, c in contexts.items() if len(w) <= WINDOW}))
    bad, good = seen
    total_bad, total_good = sum(bad.values()) + 1, sum(good.values()) + 1
    evidence = {}
    for piece, count in bad.items():
        odds = math.log((count + 0.3) / total_bad) - math.log((good[piece] + 0.3) / total_good)
        if odds > 1.5 or count >= 3 and odds > 1:
            evidence[piece] = min(count, 400) * odds * (1 + 0.02 * len(piece))
    picked: list[str] = []
    vectors: list[dict[int, float]] = []
    ranked = sorted(evidence, key=lambda w: (-evidence[w], -len(w), w))
    for piece in ranked[: 40 * most]:
        if len(picked) == most * 2 // 3:
            break
        own = explicit([piece])
        vector = dict(zip(own.numbers.tolist(), own.values[:-1, 0].tolist()))
        if all(sum(v * other.get(n, 0.0) for n, v in vector.items()) < 0.55 for other in vectors):
            picked.append(piece)
            vectors.append(vector)
    common = [w for w, _ in sorted(words[1].items(), key=lambda x: (-x[1], x[0])) if w not in picked]
    return picked + common[: most - len(picked)]


def _fit_svm(x: np.ndarray, y: np.ndarray, weight: np.ndarray, reg: float, rounds: int = 400) -> tuple[np.ndarray, float]:
    """Squared-hinge linear SVM by Newton steps on its active set."""
    z = np.concatenate([x, np.ones((len(x), 1))], axis=1)
    w = np.zeros(z.shape[1])
    ridge = np.eye(z.shape[1]) * reg
    ridge[-1, -1] = 1e-6
    for _ in range(rounds):
        active = y * (z @ w) < 1
        za = z[active] * weight[active, None]
        new = np.linalg.solve(za.T @ z[active] + ridge, za.T @ y[active])
        if np.allclose(new, w, atol=1e-9):
            break
        w = (w + new) / 2
    return w[:-1], float(w[-1])


def _altered(words: list[str]) -> list[str]:
    """Words alone, and with one character inserted or doubled, as further toxic examples."""
    found = []
    for word in words:
        found += 3 * [word]
        at = len(word) // 2
        found += [word[:at] + c + word[at:] for c in ("*", "-", word[at])]
        found += [word[:2] + "." + word[2:], word + word[-1], "a" + word]
    return found


def _platt(margin: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and offset of the logistic fit to smoothed targets."""
    positive = y.sum()
    target = np.where(y > 0, (positive + 1) / (positive + 2), 1 / (len(y) - positive + 2))
    z = np.stack([margin, np.ones(len(margin))], axis=1)
    w = np.zeros(2)
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        step = np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + 1e-4 * np.eye(2), z.T @ (target - p) - 1e-4 * w)
        w = w + np.clip(step, -5, 5)
        if abs(step).max() < 1e-8:
            break
    return max(float(w[0]), 1e-3), float(w[1])


def train(rows: list[tuple[int, str | None]], reselect: int = 4, reg: float = 1.0) -> Model | None:
    """Fit on (toxic, text) rows; None unless both classes occur."""
    split = [(label, sentences(text)) for label, text in rows]
    split = [(label, doc) for label, doc in split if doc]
    toxic, clean = [d for y, d in split if y], [d for y, d in split if not y]
    if not toxic or not clean:
        return None
    names = choose_landmarks(toxic, clean)
    landmarks = explicit(names)
    vocabulary = sorted({w for _, doc in split for s in doc for w in s})
    number = {w: i for i, w in enumerate(vocabulary)}
    values = kernel(vocabulary, landmarks)
    flat = [number[w] for _, doc in split for s in doc for w in s]
    sizes = [len(s) for _, doc in split for s in doc]
    raw = np.maximum.reduceat(values[flat], np.cumsum(sizes) - sizes, axis=0).astype(np.float64)
    counts = np.array([len(doc) for _, doc in split])
    starts = np.cumsum(counts) - counts
    owner = np.repeat(np.arange(len(split)), counts)
    y = np.array([1 if label else -1 for label, _ in split])
    vectors = landmarks.values.astype(np.float64)
    gram = (vectors.T @ vectors) ** POWER
    vals, vecs = np.linalg.eigh(gram)
    root = vecs @ np.diag(1 / np.sqrt(np.maximum(vals, 1e-2))) @ vecs.T
    mapped = raw @ root
    # At first the most suspicious sentence is the one nearest to a toxic landmark.
    margin = raw[:, : LANDMARKS * 2 // 3].max(axis=1)
    weights, bias = np.zeros(mapped.shape[1]), 0.0
    altered = kernel(_altered([w for w in names[: LANDMARKS * 2 // 3] if w in number]), landmarks) @ root
    # Clean words alone, and no words: a short text is not suspicious for what it lacks.
    usual = Counter(w for doc in clean for s in doc for w in s)
    usual = sorted(usual, key=lambda w: (-usual[w], w))[:200]
    alone = np.concatenate([kernel(usual, landmarks) @ root, np.zeros((1, len(names)))])
    for _ in range(reselect):
        order = np.lexsort((-margin, owner))
        top = order[starts]  # the most suspicious sentence of each document
        second = order[np.minimum(starts + 1, starts + counts - 1)]
        picked = np.unique(np.concatenate([top, second[y[owner[second]] < 0]]))
        labels = np.concatenate([y[owner[picked]], np.ones(len(altered)), -np.ones(len(alone))])
        positive = (labels > 0).sum()
        balance = np.where(labels > 0, 1.0, max(1.0, positive / max(1, (labels < 0).sum() - len(alone))))
        balance[len(picked) : len(picked) + len(altered)] = ALTERED_WEIGHT
        balance[-len(alone) :] = 0.2 * positive / len(alone)
        weights, bias = _fit_svm(np.concatenate([mapped[picked], altered, alone]), labels, balance, reg)
        margin = mapped @ weights + bias
    best = np.maximum.reduceat(margin, starts)
    slope, offset = _platt(best, (y > 0).astype(float))
    return Model(landmarks, root @ weights, bias, slope, offset, names)


class Scorer:
    def __init__(self, model: Model):
        self.model = model
        self.number: dict[str, int] = {}
        self.values = np.zeros((1 << 12, len(model.landmarks)), np.float32)

    def margins(self, texts: list[str]) -> np.ndarray:
        """The largest decision value over the sentences of each text; -inf without sentences."""
        docs = [sentences(t) for t in texts]
        out = np.full(len(texts), -np.inf)
        flat = [w for doc in docs for s in doc for w in s]
        if not flat:
            return out
        if len(self.number) > KNOWN_WORDS:
            self.number = {}
        new = sorted(set(flat) - self.number.keys())
        if new:
            start, end = len(self.number), len(self.number) + len(new)
            self.number.update(zip(new, range(start, end)))
            if end > len(self.values):
                larger = np.zeros((2 * end, self.values.shape[1]), np.float32)
                larger[:start] = self.values[:start]
                self.values = larger
            self.values[start:end] = kernel(new, self.model.landmarks)
        sizes = np.array([len(s) for doc in docs for s in doc])
        counts = np.array([len(doc) for doc in docs])
        found = np.fromiter(map(self.number.__getitem__, flat), np.int64, len(flat))
        best = np.maximum.reduceat(self.values[found], np.cumsum(sizes) - sizes, axis=0)
        margin = best @ self.model.direction + self.model.bias
        full = np.flatnonzero(counts)
        out[full] = np.maximum.reduceat(margin, (np.cumsum(counts) - counts)[full])
        return out

    def score(self, texts: list[str]) -> np.ndarray:
        return self.model.probability(self.margins(texts))


#: The scorer of the last model a worker process has seen, with its known words.
_current: dict[str, Scorer] = {}


def scorer_of(token: str, model: Model) -> Scorer:
    """One per worker process and model."""
    if token not in _current:
        _current.clear()
        _current[token] = Scorer(model)
    return _current[token]


def sample(docs: DataFrame, labels: DataFrame, most: int = SAMPLE) -> list[tuple[int, str | None]]:
    """At most ``most`` (toxic, text) rows of each class, by a hash of the id."""
    marked = labels.where("toxic IS NOT NULL AND doc_id IS NOT NULL").groupBy("doc_id").agg(F.max("toxic").alias("y"))
    order = F.xxhash64("doc_id")
    drawn = None
    for label in (0, 1):
        part = marked.where(F.col("y") == label).orderBy(order, "doc_id").limit(most)
        drawn = part if drawn is None else drawn.unionByName(part)
    # At most 2 * most rows of two integers.
    found = docs.select("doc_id", "text").join(F.broadcast(drawn), "doc_id")
    found = found.orderBy(order, "doc_id", F.xxhash64("text")).limit(4 * most)
    return [(int(r["y"]), r["text"]) for r in found.select("y", "text").collect()]


def held_out(modulus: int = 5, remainder: int = 0):
    return fold(F.col("doc_id"), modulus) == remainder


def fit(docs: DataFrame, labels: DataFrame) -> Model | None:
    """A model from the labelled documents that are not held out."""
    rows = sample(docs, labels.select("doc_id", "toxic").where(~held_out()))
    return train(sorted(rows, key=lambda r: (r[0], crc32((r[1] or "").encode()), r[1] or "")))


def score(docs: DataFrame, model: Model | None, name: str = "score") -> DataFrame:
    """``docs`` with the score of every row as a further column."""
    shared, token = docs.sparkSession.sparkContext.broadcast(model), uuid.uuid4().hex

    def start():
        if shared.value is None:
            return lambda texts: [[0.0] * len(texts)]
        scorer = scorer_of(token, shared.value)
        return lambda texts: [scorer.score(texts).tolist()]

    return append_columns(docs, {name: ("double", pa.float64())}, start, BLOCK_CHARS)


def learn_and_score(docs: DataFrame, labels: DataFrame) -> DataFrame:
    docs = docs.select("doc_id", "text")
    found = score(docs, fit(docs, labels))
    return found.select(
        "doc_id",
        held_out().alias("held_out"),
        "score",
        F.when(F.col("score") >= 0.5, 1).otherwise(0).cast("int").alias("predicted"),
    )
