"""Language identification with a linear-chain conditional random field over words.

Each word has affix, character n-gram and lexicon features; the transitions between the languages of
neighbouring words are learned. Forward-backward gives each word's distribution over languages, so
code-switched text is labelled word by word; a document's language has the largest expected share of
words.

The model is fitted on the driver from about ``DOCS_PER_LANGUAGE`` documents of every language that
occurs, drawn by a hash of the id; from each document at most ``SEGMENTS`` word segments, spread over
the whole text, are used, in parts of at most ``TRAINING_CELLS`` words times languages. The weights
take memory in proportion to the number of languages, and a round takes its square per word. Scoring
reads whole texts, needs no shuffle, and runs the recursions over all words of a block of documents at
once, or over all its documents side by side if there are more than ``FEW_LANGUAGES``.

Defined cases: a null text or one without letters is ``und`` with score 0; without any labelled row
every text is ``und``; repeated rows are scored one by one; other columns are never read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowlens.llm.chunks import text_blocks
from flowlens.llm.text import fold

DOCS_PER_LANGUAGE = 150
FEW_LANGUAGES = 16
TRAINING_CELLS = 2_000_000
SEGMENTS = 8
SEGMENT_WORDS = 16
LEXICON = 400
BUCKETS = 1 << 16
KNOWN_WORDS = 300_000
BLOCK_CHARS = 2_000_000
UNDETERMINED = "und"
_LETTERS = regex.compile(r"\p{L}+")


def words(text: str | None) -> list[str]:
    return _LETTERS.findall((text or "").lower())


def features(word: str, lexicon: dict[str, tuple[int, ...]]) -> list[int]:
    """Hashed affixes, character n-grams and lexicon entries of a word."""
    data = b"^" + word.encode() + b"$"
    found = [b"w" + data] if len(data) < 12 else []
    for n in (2, 3, 4):
        found += [data[i : i + n] for i in range(len(data) - n + 1)]
        found += [b"<" + data[: n + 1], b">" + data[-n - 1 :]]
    numbers = [crc32(f) % BUCKETS for f in found]
    return numbers + [BUCKETS + label for label in lexicon.get(word, ())]


def _csr(vocabulary: list[str], lexicon: dict[str, tuple[int, ...]]) -> tuple[np.ndarray, np.ndarray]:
    lists = [features(w, lexicon) for w in vocabulary]
    sizes = np.fromiter(map(len, lists), np.int64, len(lists))
    flat = np.fromiter((f for x in lists for f in x), np.int64, int(sizes.sum()))
    return flat, np.concatenate([[0], np.cumsum(sizes)[:-1]])


def _chain(potentials: np.ndarray, opens: np.ndarray, step: np.ndarray, prior: np.ndarray, width: int = 64):
    """Normalised forward vectors of many chains laid end to end; ``opens`` marks their first words.

    The sequence is cut into rows of ``width`` words. The product of a row's transfer matrices
    carries the state from row to row; all rows then advance together.
    """
    n, k = potentials.shape
    if k > FEW_LANGUAGES:
        return _chains_apart(potentials, opens, step, prior)
    rows = -(-n // width)
    pad = rows * width - n
    p = np.concatenate([potentials, np.ones((pad, k))]).reshape(rows, width, k)
    o = np.concatenate([opens, np.zeros(pad, bool)]).reshape(rows, width)
    product = np.broadcast_to(np.eye(k), (rows, k, k)).copy()
    for t in range(width):
        moved = product @ step
        first = o[:, t]
        if first.any():
            moved[first] = product[first].sum(axis=2, keepdims=True) * prior
        product = moved * p[:, t, None, :]
        product /= product.sum(axis=(1, 2), keepdims=True)
    entry = np.empty((rows, k))
    state = np.full(k, 1 / k)
    for r in range(rows):
        entry[r] = state
        state = state @ product[r]
        state = state / state.sum()
    out = np.empty((rows, width, k))
    state = entry
    for t in range(width):
        moved = np.where(o[:, t, None], prior, state @ step) * p[:, t]
        state = moved / moved.sum(axis=1, keepdims=True)
        out[:, t] = state
    return out.reshape(-1, k)[:n]


def _chains_apart(potentials: np.ndarray, opens: np.ndarray, step: np.ndarray, prior: np.ndarray):
    """The same vectors, by advancing all chains together: no matrix products of many languages."""
    begins = np.flatnonzero(opens)
    lengths = np.diff(np.concatenate([begins, [len(opens)]]))
    order = np.argsort(-lengths, kind="stable")
    begins, lengths = begins[order], lengths[order]
    out, state = np.empty_like(potentials), None
    for t in range(lengths[0]):
        at = begins[: np.searchsorted(-lengths, -t)] + t
        moved = (prior if state is None else state[: len(at)] @ step) * potentials[at]
        out[at] = state = moved / moved.sum(axis=1, keepdims=True)
    return out


def marginals(scores: np.ndarray, opens: np.ndarray, transitions: np.ndarray, prior: np.ndarray) -> np.ndarray:
    """Posterior of each word's label. ``scores`` are log potentials; chains lie end to end."""
    potentials = np.exp(scores - scores.max(axis=1, keepdims=True))
    potentials = np.maximum(potentials, 1e-30)
    step = np.exp(transitions - transitions.max())
    start = np.exp(prior - prior.max())
    closes = np.concatenate([opens[1:], [True]])
    forward = _chain(potentials, opens, step, start)
    backward = _chain(potentials[::-1], closes[::-1], step.T, np.ones(len(prior)))[::-1]
    joint = forward * backward / potentials
    return joint / joint.sum(axis=1, keepdims=True)


@dataclass
class Model:
    languages: list[str]
    weights: np.ndarray
    transitions: np.ndarray
    prior: np.ndarray
    lexicon: dict[str, tuple[int, ...]]

    def emissions(self, vocabulary: list[str]) -> np.ndarray:
        flat, starts = _csr(vocabulary, self.lexicon)
        return np.add.reduceat(self.weights[flat], starts, axis=0)


def _segments(rows: list[tuple[str, str]], labels: dict[str, int]) -> list[tuple[int, list[str]]]:
    found = []
    for lang, text in rows:
        all_words = words(text)
        pieces = max(1, min(SEGMENTS, len(all_words) // SEGMENT_WORDS))
        for i in range(pieces):
            at = i * len(all_words) // pieces
            if piece := all_words[at : at + SEGMENT_WORDS]:
                found.append((labels[lang], piece))
    return found


def _parts(token: np.ndarray, opens: np.ndarray, vocabulary: list[str], lexicon: dict, most: int) -> list[tuple]:
    """Whole chains of about ``most`` words: bounds, numbers of their words, and the features of these."""
    begins = np.flatnonzero(opens)
    cuts = [*begins[np.unique(begins // most, return_index=True)[1]], len(token)]
    found = []
    for low, high in zip(cuts, cuts[1:]):
        used, local = np.unique(token[low:high], return_inverse=True)
        flat, starts = _csr([vocabulary[i] for i in used], lexicon)
        sizes = np.diff(np.concatenate([starts, [len(flat)]]))
        found.append((low, high, local, flat.astype(np.int32), starts, np.repeat(np.arange(len(used), dtype=np.int32), sizes)))
    return found


def train(rows: list[tuple[str, str]], rounds: int = 40, rate: float = 0.15, decay: float = 1e-3) -> Model | None:
    """Fit the field on (language, text) rows by gradient ascent of the conditional likelihood.

    Segments of different documents are joined in pairs in a fixed mixed order, so that changes of
    language occur and their weights are learned.
    """
    languages = sorted({lang for lang, _ in rows})
    labels = {lang: i for i, lang in enumerate(languages)}
    segments = _segments(rows, labels)
    if not segments:
        return None
    k = len(languages)
    counts = [Counter() for _ in languages]
    for label, piece in segments:
        counts[label].update(set(piece))
    common: dict[str, list[int]] = {}
    for label, counter in enumerate(counts):
        for word, _ in sorted(counter.items(), key=lambda x: (-x[1], x[0]))[:LEXICON]:
            common.setdefault(word, []).append(label)
    lexicon = {w: tuple(x) for w, x in common.items()}
    segments.sort(key=lambda s: crc32(" ".join(s[1]).encode()))
    vocabulary = sorted({w for _, piece in segments for w in piece})
    number = {w: i for i, w in enumerate(vocabulary)}
    token = np.fromiter((number[w] for _, piece in segments for w in piece), np.int64)
    gold = np.fromiter((label for label, piece in segments for _ in piece), np.int64)
    ends = np.cumsum([len(piece) for _, piece in segments])
    opens = np.zeros(len(token), bool)
    opens[np.concatenate([[0], ends[1:-1:2]])] = True
    parts = _parts(token, opens, vocabulary, lexicon, max(1, TRAINING_CELLS // k))
    params = {"w": np.zeros((BUCKETS + k, k)), "t": np.zeros((k, k)), "p": np.zeros(k)}
    first = {n: np.zeros_like(v) for n, v in params.items()}
    second = {n: np.zeros_like(v) for n, v in params.items()}
    linked = np.flatnonzero(~opens)
    true_moves = np.zeros((k, k))
    np.add.at(true_moves, (gold[linked - 1], gold[linked]), 1)
    for r in range(1, rounds + 1):
        step, start = np.exp(params["t"]), np.exp(params["p"])
        by_feature, moves, by_start = np.zeros((BUCKETS + k, k)), np.zeros((k, k)), np.zeros(k)
        for low, high, local, flat, starts, owner in parts:
            here = opens[low:high]
            inner = np.flatnonzero(~here)
            scores = np.add.reduceat(params["w"][flat], starts, axis=0)[local]
            potentials = np.maximum(np.exp(scores - scores.max(axis=1, keepdims=True)), 1e-30)
            closes = np.concatenate([here[1:], [True]])
            forward = _chain(potentials, here, step, start)
            backward = _chain(potentials[::-1], closes[::-1], step.T, np.ones(k))[::-1]
            joint = forward * backward / potentials
            post = joint / joint.sum(axis=1, keepdims=True)
            left, right = forward[inner - 1], backward[inner]
            moves += step * ((left / ((left @ step) * right).sum(axis=1, keepdims=True)).T @ right)
            wrong = -post
            wrong[np.arange(len(post)), gold[low:high]] += 1
            by_start += wrong[here].sum(axis=0)
            for c in range(k):
                by_word = np.bincount(local, wrong[:, c], len(starts))
                by_feature[:, c] += np.bincount(flat, by_word[owner], BUCKETS + k)
        scale = 1 / len(token)
        slope = {
            "w": by_feature * scale - decay * scale * params["w"],
            "t": (true_moves - moves) * scale - decay * params["t"],
            "p": by_start * scale - decay * params["p"],
        }
        for n, g in slope.items():
            first[n] = 0.9 * first[n] + 0.1 * g
            second[n] = 0.99 * second[n] + 0.01 * g * g
            params[n] += rate * (first[n] / (1 - 0.9**r)) / (np.sqrt(second[n] / (1 - 0.99**r)) + 1e-9)
    return Model(languages, params["w"].astype(np.float32), params["t"], params["p"], lexicon)


class Tagger:
    """Scores blocks of texts; keeps the emission scores of known words up to a bound."""

    def __init__(self, model: Model):
        self.model = model
        self.number: dict[str, int] = {}
        self.scores = np.zeros((0, len(model.languages)), np.float32)

    def label(self, texts: list[str]) -> list[tuple[str, float]]:
        split = [words(t) for t in texts]
        sizes = np.fromiter(map(len, split), np.int64, len(split))
        full = np.flatnonzero(sizes)
        found = [(UNDETERMINED, 0.0)] * len(texts)
        if not len(full):
            return found
        if len(self.number) > KNOWN_WORDS:
            self.number, self.scores = {}, self.scores[:0]
        new = sorted(set().union(*split) - self.number.keys())
        if new:
            self.number.update(zip(new, range(len(self.scores), len(self.scores) + len(new))))
            self.scores = np.concatenate([self.scores, self.model.emissions(new)])
        token = np.fromiter((self.number[w] for s in split for w in s), np.int64, int(sizes.sum()))
        starts = (np.cumsum(sizes) - sizes)[full]
        opens = np.zeros(len(token), bool)
        opens[starts] = True
        post = marginals(self.scores[token].astype(float), opens, self.model.transitions, self.model.prior)
        share = np.add.reduceat(post, starts, axis=0) / sizes[full, None]
        best = share.argmax(axis=1)
        for row, label, value in zip(full, best, share[np.arange(len(best)), best]):
            found[row] = (self.model.languages[label], min(1.0, max(0.0, float(value))))
        return found


def sample(docs: DataFrame, per_language: int = DOCS_PER_LANGUAGE) -> list[tuple[str, str]]:
    """About ``per_language`` (language, text) rows of each language, by a hash of the id."""
    labelled = docs.where("lang IS NOT NULL AND text IS NOT NULL AND doc_id IS NOT NULL")
    space = 1 << 30
    limit = F.least(F.lit(space), F.ceil(F.lit(per_language * space) / F.count("*"))).alias("_limit")
    # One row of each language; nothing of the documents is shuffled.
    limits = labelled.groupBy("lang").agg(limit)
    near = F.pmod(F.xxhash64("doc_id"), F.lit(space)) < F.col("_limit")
    drawn = labelled.select("doc_id", "lang", "text").join(F.broadcast(limits), "lang").where(near)
    # A row that is repeated without end counts once.
    return [tuple(r) for r in drawn.dropDuplicates(["doc_id", "lang", "text"]).select("lang", "text").collect()]


def identify(docs: DataFrame, model: Model | None) -> DataFrame:
    """``doc_id``, ``lang_pred`` and ``score`` of every document."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tagger = Tagger(shared.value) if shared.value else None
        for ids, texts in text_blocks(batches, BLOCK_CHARS):
            found = tagger.label(texts) if tagger else [(UNDETERMINED, 0.0)] * len(texts)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(ids, pa.int64()),
                    pa.array([f[0] for f in found], pa.string()),
                    pa.array([f[1] for f in found], pa.float64()),
                ],
                ["doc_id", "lang_pred", "score"],
            )

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, lang_pred string, score double")


def held_out(modulus: int = 4, remainder: int = 2):
    return fold(F.col("doc_id"), modulus) == remainder


def learn_and_identify(docs: DataFrame) -> DataFrame:
    """Learn from the rows that are not held out, predict all."""
    rows = sorted(sample(docs.select("doc_id", "text", "lang").where(~held_out())))
    found = identify(docs, train(rows))
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")
