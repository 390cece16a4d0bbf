"""Byte-level BPE by prefix-sharing traversal of a trie of words.

The words of a block of texts that are not known yet are sorted, which lists their trie in
depth-first order. Along each path the last token of every prefix is found from the last tokens of
shorter prefixes: the token that ends there and fits the one before it. Words with a common prefix
share these states. An encoding is read back from the end by following the last tokens.

A worker keeps the encodings of about ``KNOWN_WORDS`` words, beyond that those of the current block, and
what it knows of at most ``KNOWN_PAIRS`` token pairs. This bounds memory and changes no result. No shuffle
is needed.

The vocabulary file says how text is cut before encoding. A file that asks for more than byte-level
cutting and plain merges (normalizers, word ends, dropout, ...) is refused, as its ids would be wrong.

Defined cases: a null text is empty and has no tokens; the special token's string inside a text is
its one token, as in the tokenizer's own library; repeated rows are encoded one by one.
"""

from __future__ import annotations

import json
import struct
from collections.abc import Iterable, Iterator
from functools import cache

import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from flowlens.llm.chunks import text_blocks

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
BLOCK_CHARS = 2_000_000
KNOWN_WORDS = 250_000
KNOWN_PAIRS = 1_000_000
#: Fixed value: how the byte-level pre-tokenizer cuts text if the file names no pattern.
WORDS = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+"
    r"|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"
)


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte in a byte-level vocabulary file."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    letters = {b: chr(b) for b in plain}
    for n, b in enumerate(b for b in range(256) if b not in letters):
        letters[b] = chr(256 + n)
    return [letters[b] for b in range(256)]


def cutting(spec: dict) -> str:
    """The pattern by which a vocabulary file cuts text; an error if the file asks for anything else."""
    model, cut = spec["model"], spec.get("pre_tokenizer") or {}
    unusual = [k for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix") if model.get(k)]
    unusual += [k for k in ("byte_fallback", "ignore_merges") if model.get(k)]
    unusual += ["normalizer"] if spec.get("normalizer") else []
    unusual += [k for t in spec["added_tokens"] for k in ("single_word", "lstrip", "rstrip") if t.get(k)]
    if model.get("type", "BPE") != "BPE" or unusual:
        raise ValueError(f"not a plain byte-level BPE vocabulary: {model.get('type')} {sorted(set(unusual))}")
    steps = cut.get("pretokenizers", [cut])
    last = steps[-1]
    if last.get("type") == "ByteLevel" and not last.get("add_prefix_space"):
        if len(steps) == 1 and last.get("use_regex", True):
            return WORDS
        pattern = steps[0].get("pattern", {}).get("Regex")
        isolated = steps[0].get("type") == "Split" and steps[0].get("behavior") == "Isolated"
        if len(steps) == 2 and pattern and isolated and not steps[0].get("invert") and not last.get("use_regex", True):
            # White space is that of Unicode there.
            return pattern.replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}")
    raise ValueError(f"unknown pre-tokenizer: {json.dumps(cut)}")


class PrefixEncoder:
    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        pattern = cutting(spec)
        byte_of = {letter: b for b, letter in enumerate(byte_letters())}
        as_bytes = lambda token: bytes(byte_of[c] for c in token)
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.id_of = {as_bytes(t): n for t, n in spec["model"]["vocab"].items() if t not in self.special}
        self.bytes_of = {n: t for t, n in self.id_of.items()}
        self.bytes_of |= {n: t.encode() for t, n in self.special.items()}
        self.longest = max(map(len, self.id_of))
        self.merged: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, pair in enumerate(spec["model"]["merges"]):
            left, right = map(as_bytes, pair.split(" ") if isinstance(pair, str) else pair)
            self.merged[self.id_of[left], self.id_of[right]] = (rank, self.id_of[left + right])
        self.pattern = regex.compile(pattern)
        self.whole = pattern == WORDS  # leaves nothing between its matches
        self.cut = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")") if self.special else None
        self._fits: dict[int, bool] = {}
        self._known: dict[str, bytes] = {}

    def merge(self, data: bytes) -> list[int]:
        """Plain BPE of a short byte string."""
        ids = [self.id_of[data[i : i + 1]] for i in range(len(data))]
        while len(ids) > 1:
            best = min((self.merged[p] + (i,) for i, p in enumerate(zip(ids, ids[1:])) if p in self.merged), default=None)
            if best is None:
                break
            _, token, at = best
            ids[at : at + 2] = [token]
        return ids

    def fits(self, left: int, right: int) -> bool:
        """Whether ``right`` can follow ``left`` (-1: stand first) in an encoding."""
        key = (left + 1) * len(self.bytes_of) + right
        known = self._fits.get(key)
        if known is None:
            whole = self.bytes_of[right] if left < 0 else self.bytes_of[left] + self.bytes_of[right]
            if len(self._fits) >= KNOWN_PAIRS:
                self._fits.clear()
            known = self.merge(whole) == ([right] if left < 0 else [left, right])
            self._fits[key] = known
        return known

    def encode_words(self, words: Iterable[bytes]) -> Iterator[list[int]]:
        """Ids of sorted byte strings; the states of a shared prefix are computed once.

        Exactly one token ends a prefix and fits what is before it, so candidates can be tried in
        any order: first the previous last token with one more byte, then from short to long.
        """
        last, begin, before = [-1], [0], b""
        id_of, fits, longest = self.id_of.get, self.fits, self.longest
        known, size = self._fits.get, len(self.bytes_of)
        for word in words:
            shared, most = 0, min(len(before), len(word))
            while shared < most and before[shared] == word[shared]:
                shared += 1
            del last[shared + 1 :], begin[shared + 1 :]
            for end in range(shared + 1, len(word) + 1):
                start = begin[-1]
                token = id_of(word[start:end])
                if token is None or not (known((last[start] + 1) * size + token) or fits(last[start], token)):
                    for start in range(end - 1, max(-1, end - 1 - longest), -1):
                        token = id_of(word[start:end])
                        if token is not None and fits(last[start], token):
                            break
                last.append(token)
                begin.append(start)
            before = word
            ids, end = [], len(word)
            while end:
                ids.append(last[end])
                end = begin[end]
            ids.reverse()
            yield ids

    def words(self, text: str) -> list[str]:
        """Pieces that are encoded apart; special strings stand alone."""
        if self.cut is None or not any(s in text for s in self.special):
            return self.pieces(text)
        found = []
        for n, part in enumerate(self.cut.split(text)):
            found += [part] if n % 2 else self.pieces(part)
        return found

    def pieces(self, text: str) -> list[str]:
        """What the pattern matches, and what lies between."""
        if self.whole:
            return self.pattern.findall(text)
        found, at = [], 0
        for match in self.pattern.finditer(text):
            found += [text[at : match.start()], match[0]]
            at = match.end()
        return [piece for piece in [*found, text[at:]] if piece]

    def encode_block(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        split = [self.words(t) for t in texts]
        present = set().union(*split)
        if len(self._known) > KNOWN_WORDS:
            self._known = {w: ids for w, ids in self._known.items() if w in present}
        known = self._known
        new = sorted((w.encode(), w) for w in present if w not in known)
        plain = [x for x in new if x[1] not in self.special]
        for (_, word), ids in zip(plain, self.encode_words(data for data, _ in plain)):
            known[word] = packed(ids)
        for word, number in self.special.items():
            known[word] = packed([number])
        return [b"".join(map(known.__getitem__, words)) for words in split]

    def decode(self, ids: bytes) -> str:
        return b"".join(map(self.bytes_of.__getitem__, unpacked(ids))).decode("utf-8", "replace")


def packed(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


def unpacked(ids: bytes) -> tuple[int, ...]:
    return struct.unpack(f"<{len(ids) // 4}I", ids)


@cache
def encoder(path: str) -> PrefixEncoder:
    """One per worker process and vocabulary."""
    return PrefixEncoder(path)


def encode(docs: DataFrame, path: str = VOCABULARY) -> DataFrame:
    """``doc_id``, ``n_tokens`` and ``ids``, the token ids as packed little-endian 32-bit integers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, texts in text_blocks(batches, BLOCK_CHARS):
            codes = encoder(path).encode_block(texts)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(ids, pa.int64()),
                    pa.array([len(c) // 4 for c in codes], pa.int64()),
                    pa.array(codes, pa.binary()),
                ],
                ["doc_id", "n_tokens", "ids"],
            )

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n_tokens long, ids binary")


def decode(encoded: DataFrame, path: str = VOCABULARY) -> DataFrame:
    """The rows of ``encode`` with their text as ``decoded``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [encoder(path).decode(ids.as_py() or b"") for ids in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(texts, pa.string())], ["doc_id", "n_tokens", "ids", "decoded"]
            )

    return encoded.select("doc_id", "n_tokens", "ids").mapInArrow(
        run, "doc_id long, n_tokens long, ids binary, decoded string"
    )


def count_tokens(docs: DataFrame, path: str = VOCABULARY) -> DataFrame:
    """``doc_id`` and ``n_tokens``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, texts in text_blocks(batches, BLOCK_CHARS):
            counts = [len(c) // 4 for c in encoder(path).encode_block(texts)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(counts, pa.int64())], ["doc_id", "n_tokens"]
            )

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n_tokens long")
