"""Benchmark decontamination with an FM-index per training shard.

A shard is a block of whole documents of one task. Its words that no benchmark item uses cannot lie
in a match; they separate runs of benchmark words, and runs shorter than the shortest window are
left out. Over the runs the shard builds a suffix order, the word-level BWT in a wavelet matrix and
sampled suffix positions. All benchmark windows are searched backward at once; occurrences are
located by walking to sampled positions and their spans merged per document.

Documents are never shuffled. The benchmark is a query set: it is broadcast while its text is at most
``BLOCK_MB``; a larger one is searched in blocks of that size whose spans are merged per document.

Defined cases: a null or wordless text has no words, is not contaminated and keeps its text; an item
without words or id has no window; a repeated item id counts once; repeated rows are searched one by
one; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowlens.llm.chunks import append_columns, unused

WINDOW = 13
SHARD_CHARS = 4_000_000
BLOCK_MB = 32
SAMPLE = 16

_SEPARATORS = [*range(0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)]
_FOLD = bytes(
    b + 32 if 0x41 <= b <= 0x5A else 0x20 if b in _SEPARATORS else b for b in range(256)
)
_WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text: str | None) -> list[bytes]:
    """Lower-cased (A-Z) words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` as UTF-8."""
    return (text or "").encode().translate(_FOLD).split()


class Windows:
    """Distinct benchmark windows as word numbers (from 1), and the items that hold each."""

    def __init__(self, items: Iterable[tuple[int, str | None]], length: int = WINDOW):
        self.number: dict[bytes, int] = {}
        holders: dict[tuple[int, ...], set[int]] = {}
        for item_id, text in items:
            ids = [self.number.setdefault(w, len(self.number) + 1) for w in words(text)]
            if item_id is None or not ids:
                continue
            for start in range(max(1, len(ids) - length + 1)):
                holders.setdefault(tuple(ids[start : start + length]), set()).add(item_id)
        self.lengths = np.array([len(w) for w in holders], np.int64)
        self.symbols = np.zeros((len(holders), length), np.int64)
        for row, window in enumerate(holders):
            self.symbols[row, : len(window)] = window
        self.items = [sorted(ids) for ids in holders.values()]
        self.shortest = int(self.lengths.min()) if len(holders) else 0


def suffix_order(symbols: np.ndarray) -> np.ndarray:
    """Suffix array of a sequence in which each 0 ends a run; zeros differ by position."""
    n = len(symbols)
    zeros = symbols == 0
    rank = symbols + int(zeros.sum())
    rank[zeros] = np.arange(zeros.sum())
    step = 1
    order = np.argsort(rank)
    while True:
        sorted_rank = rank[order]
        fresh = np.empty(n, bool)
        fresh[0] = True
        np.not_equal(sorted_rank[1:], sorted_rank[:-1], out=fresh[1:])
        place = np.cumsum(fresh) - 1
        rank = np.empty(n, np.int64)
        rank[order] = place
        if place[-1] == n - 1:
            return order
        ahead = np.full(n, -1, np.int64)
        ahead[: n - step] = rank[step:]
        rank = rank * (n + 1) + ahead + 1
        order = np.argsort(rank)
        step *= 2


class WaveletMatrix:
    """Rank of any symbol in a prefix of a sequence, one bit plane at a time."""

    def __init__(self, values: np.ndarray, largest: int):
        self.planes: list[np.ndarray] = []
        self.zeros: list[int] = []
        self.shifts = range(max(1, int(largest).bit_length()) - 1, -1, -1)
        for shift in self.shifts:
            bits = (values >> shift) & 1
            ones = np.zeros(len(values) + 1, np.int32)
            np.cumsum(bits, out=ones[1:])
            self.planes.append(ones)
            self.zeros.append(len(values) - int(ones[-1]))
            values = np.concatenate([values[bits == 0], values[bits == 1]])

    def rank(self, symbol: np.ndarray, end: np.ndarray) -> np.ndarray:
        """How often ``symbol`` occurs before ``end``; arrays of equal length."""
        low, high = np.zeros_like(end), end
        for shift, ones, zeros in zip(self.shifts, self.planes, self.zeros):
            bit = (symbol >> shift) & 1
            low_ones, high_ones = ones[low], ones[high]
            low = np.where(bit, zeros + low_ones, low - low_ones)
            high = np.where(bit, zeros + high_ones, high - high_ones)
        return high - low

    def value(self, at: np.ndarray) -> np.ndarray:
        found = np.zeros_like(at)
        for ones, zeros in zip(self.planes, self.zeros):
            bit = ones[at + 1] - ones[at]
            found = 2 * found + bit
            at = np.where(bit, zeros + ones[at], at - ones[at])
        return found


class FMIndex:
    """Backward search over a sequence of symbols from 1 in which 0 separates runs."""

    def __init__(self, symbols: np.ndarray, sample: int = SAMPLE):
        self.order = suffix_order(symbols)
        before = symbols[self.order - 1]  # the symbol before position 0 is the final separator
        largest = int(symbols.max(initial=0))
        self.bwt = WaveletMatrix(before, largest)
        counts = np.bincount(symbols, minlength=largest + 1)
        self.first = np.concatenate([[0], np.cumsum(counts)])
        # Walks stop at sampled positions and at the start of a run.
        starts = symbols[np.arange(len(symbols)) - 1] == 0
        kept = (np.arange(len(symbols)) % sample == 0) | starts
        self.kept = kept[self.order]
        self.sampled = self.order[self.kept]
        self.sampled_rank = np.concatenate([[0], np.cumsum(self.kept)])
        del self.order

    def search(self, patterns: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The row interval of each pattern; patterns are padded with 0 at the end."""
        low = np.zeros(len(patterns), np.int64)
        high = np.full(len(patterns), self.first[-1], np.int64)
        known = len(self.first) - 1
        for column in range(patterns.shape[1] - 1, -1, -1):
            active = np.flatnonzero((column < lengths) & (high > low))
            symbol = patterns[active, column]
            there = symbol < known
            high[active[~there]] = low[active[~there]]
            active, symbol = active[there], symbol[there]
            low[active] = self.first[symbol] + self.bwt.rank(symbol, low[active])
            high[active] = self.first[symbol] + self.bwt.rank(symbol, high[active])
        return low, high

    def locate(self, rows: np.ndarray) -> np.ndarray:
        position = np.zeros(len(rows), np.int64)
        rows, steps = rows.copy(), 0
        pending = np.arange(len(rows))
        while len(pending):
            at = rows[pending]
            done = self.kept[at]
            position[pending[done]] = self.sampled[self.sampled_rank[at[done]]] + steps
            pending, at = pending[~done], at[~done]
            symbol = self.bwt.value(at)
            rows[pending] = self.first[symbol] + self.bwt.rank(symbol, at)
            steps += 1
        return position


def _ranges(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All integers of the ranges, and the number of the range of each."""
    sizes = ends - starts
    owner = np.repeat(np.arange(len(starts)), sizes)
    offset = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    return starts[owner] + offset, owner


def search_shard(texts: list[str], windows: Windows) -> list[tuple[int, list[tuple[int, int]], list[int]]]:
    """Per text: number of words, merged word spans of hits, sorted ids of the items that occur."""
    split = [words(t) for t in texts]
    counts = np.array([len(s) for s in split], np.int64)
    bounds = np.concatenate([[0], np.cumsum(counts)])
    empty = [(int(n), [], []) for n in counts]
    if not windows.shortest or not bounds[-1]:
        return empty
    get = windows.number.get
    symbols = np.fromiter((get(w, 0) for s in split for w in s), np.int64, bounds[-1])
    # Runs of benchmark words inside one document.
    inside = symbols > 0
    opens = inside.copy()
    opens[1:] &= ~inside[:-1]
    closes = inside.copy()
    closes[:-1] &= ~inside[1:]
    edges = bounds[1:-1]
    edges = edges[(edges > 0) & (edges < len(symbols))]
    opens[edges] |= inside[edges]
    closes[edges - 1] |= inside[edges - 1]
    start, end = np.flatnonzero(opens), np.flatnonzero(closes) + 1
    long = end - start >= windows.shortest
    start, end = start[long], end[long]
    if not len(start):
        return empty
    # Each run is followed by a separator.
    word_at, _ = _ranges(start, end + 1)
    last = np.cumsum(end - start + 1) - 1
    word_at[last] = -1
    sequence = np.where(word_at < 0, 0, symbols[word_at])
    # Number the symbols of this shard without gaps.
    present = np.unique(sequence)
    index = FMIndex(np.searchsorted(present, sequence))
    place = np.searchsorted(present, windows.symbols)
    place = np.where(
        (place < len(present)) & (present[np.minimum(place, len(present) - 1)] == windows.symbols), place, len(present)
    )
    low, high = index.search(place, windows.lengths)
    found = np.flatnonzero(high > low)
    if not len(found):
        return empty
    rows, owner = _ranges(low[found], high[found])
    at = word_at[index.locate(rows)]
    window = found[owner]
    mark = np.zeros(len(symbols) + 1, np.int64)
    np.add.at(mark, at, 1)
    np.add.at(mark, at + windows.lengths[window], -1)
    hit = np.cumsum(mark[:-1]) > 0
    doc = np.searchsorted(bounds, at, side="right") - 1
    held: dict[int, set[int]] = {}
    for key in np.unique(doc * len(windows.lengths) + window):
        held.setdefault(int(key) // len(windows.lengths), set()).update(windows.items[int(key) % len(windows.lengths)])
    for row, items in held.items():
        flags = np.concatenate([[0], hit[bounds[row] : bounds[row + 1]].astype(np.int8), [0]])
        change = np.flatnonzero(np.diff(flags))
        spans = [(int(a), int(b)) for a, b in zip(change[::2], change[1::2])]
        empty[row] = (int(counts[row]), spans, sorted(items))
    return empty


_SPAN = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
_FIELDS = {
    "n_words": ("long", pa.int64()),
    "spans": ("array<struct<start:long,end:long>>", _SPAN),
    "items": ("array<long>", pa.list_(pa.int64())),
}


def _search(docs: DataFrame, items: list[tuple[int, str | None]], window: int, names: list[str]) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(items)

    def start():
        windows = Windows(shared.value, window)

        def process(texts: list[str]) -> list[list]:
            found = search_shard(texts, windows)
            spans = [[{"start": a, "end": b} for a, b in f[1]] for f in found]
            return [[f[0] for f in found], spans, [f[2] for f in found]]

        return process

    return append_columns(docs, dict(zip(names, _FIELDS.values())), start, SHARD_CHARS)


def _blocks(benchmark: DataFrame, block_mb: float) -> Iterator[list[tuple[int, str | None]]]:
    """Items in blocks of bounded text size, by a hash of the id."""
    items = benchmark.select("item_id", "text").where("item_id IS NOT NULL AND text IS NOT NULL")
    size = items.agg(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0
    blocks = int(size // (block_mb * 2**20 / 2)) + 1 if size > block_mb * 2**20 else 1
    for number in range(blocks):
        part = items.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == number) if blocks > 1 else items
        yield [(r["item_id"], r["text"]) for r in part.collect()]


def find_benchmark(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_mb: float = BLOCK_MB
) -> DataFrame:
    """Every document with ``n_words``, merged word ``spans``, ``n_hit``, ``items`` and ``contaminated``."""
    docs = docs.select("doc_id", "text")
    parts = [_search(docs, items, window, list(_FIELDS)) for items in _blocks(benchmark, block_mb)]
    found = parts[0] if len(parts) == 1 else _merge_blocks(parts)
    n_hit = hit_words(F.col("spans"))
    return found.withColumn("n_hit", n_hit).withColumn("contaminated", is_contaminated(n_hit, F.col("n_words")))


def hit_words(spans: Column) -> Column:
    return F.aggregate(spans, F.lit(0).cast("long"), lambda a, s: a + s["end"] - s["start"])


def is_contaminated(n_hit: Column, n_words: Column) -> Column:
    return (n_hit > 0) & (20 * n_hit >= n_words)


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_mb: float = BLOCK_MB) -> DataFrame:
    """``docs`` without the contaminated rows, all columns kept.

    Blocks of a large benchmark are searched one after the other in the same pass.
    """
    names, marked = [], docs
    for items in _blocks(benchmark, block_mb):
        names.append([unused(marked, f"found_{n}") for n in _FIELDS])
        marked = _search(marked, items, window, names[-1])
    if len(names) == 1:
        n_hit = hit_words(F.col(names[0][1]))
    else:
        covered = F.flatten(F.array(*[F.transform(F.col(n[1]), _positions) for n in names]))
        n_hit = F.size(F.array_distinct(F.flatten(covered))).cast("long")
    return marked.where(~is_contaminated(n_hit, F.col(names[0][0]))).select(docs.columns)


def _positions(span: Column) -> Column:
    return F.sequence(span["start"], span["end"] - 1)


def _merge_blocks(parts: list[DataFrame]) -> DataFrame:
    """Union of the spans and items that each block of the benchmark found in a document."""
    found = parts[0]
    for part in parts[1:]:
        found = found.unionByName(part.where(F.size("items") > 0))
    # A row of the first part stands for each document; repeated rows have equal findings.
    grouped = found.groupBy("doc_id", F.xxhash64("text").alias("h")).agg(
        F.first("text").alias("text"),
        F.max("n_words").alias("n_words"),
        F.array_sort(F.flatten(F.collect_list("spans"))).alias("all"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
    )
    start = F.expr("cast(array() as array<struct<start:bigint,end:bigint>>)")

    def add(done, span):
        tail = F.element_at(done, -1)
        joined = F.struct(tail["start"].alias("start"), F.greatest(tail["end"], span["end"]).alias("end"))
        merges = (F.size(done) > 0) & (F.try_element_at(done, F.lit(-1))["end"] >= span["start"])
        return F.when(merges, F.concat(F.slice(done, 1, F.size(done) - 1), F.array(joined))).otherwise(
            F.concat(done, F.array(span))
        )

    merged = grouped.select("doc_id", "n_words", F.aggregate("all", start, add).alias("spans"), "items", "text", "h")
    rows = parts[0].select("doc_id", F.xxhash64("text").alias("h"))
    return rows.join(merged, (rows["doc_id"].eqNullSafe(merged["doc_id"])) & (rows["h"] == merged["h"])).select(
        rows["doc_id"], "n_words", "spans", "items", "text"
    )


def cut_spans(text: str, spans: Iterable[tuple[int, int]]) -> str:
    """``text`` without the words of the given word spans and what stands between them."""
    data = text.encode()
    places = [m.span() for m in _WORD.finditer(data.translate(_FOLD))]
    kept, at = [], 0
    for start, end in spans:
        kept.append(data[at : places[start][0]])
        at = places[end - 1][1]
    kept.append(data[at:])
    return b"".join(kept).decode()
