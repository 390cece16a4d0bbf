"""SimHash near-duplicates by pigeonring filtering.

A fingerprint has 64 bits; a bit is 1 if it is set in over half the 64-bit hashes of a text's word
shingles. Two fingerprints link when they differ in at most ``near`` bits.

The bits are dealt to ``near + 1`` segments on a ring. If two fingerprints differ in at most ``near``
bits, then from some segment on every chain of 1, 2, ... consecutive segments differs in at most its
proportional part of the budget: chains of ``l`` segments in ``floor(l * near / segments)`` bits. So the
first segment of the chain is equal, and with a budget of ``b`` up to a segment, one of ``b + 1`` parts
of that segment is equal as well.

1. Equal fingerprints become one node, so copies are never paired.
2. Nodes that agree on a segment form a group. A group above ``GROUP`` nodes is split by the equal
   parts of the next segment of the chain, and so on around the ring; what is still larger is compared
   in pairs of blocks, each pair a task's work of its own.
3. In a group, pairs go through the chain budgets in turn; only survivors get the full Hamming check.
4. A group gives at most one link per node (the rest follows from them); components come from star
   contraction.

No partners are capped: ``GROUP`` and ``BLOCK`` change the plan only.

Defined cases: a text without words (null, empty, blanks) has fingerprint zero, which links like any
other; a text with fewer words than a shingle has its whole sequence as one shingle; a null id counts as
an id below all others; repeated rows are members of one node; other columns are ignored; an empty
table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowlens.llm.chunks import text_blocks
from flowlens.llm.jaccard import components
from flowlens.plans.skew import lookup_join
from flowlens.plans.staging import stage

BITS = 64
SEED = 42
#: Most nodes of a group that are compared with each other at once, and in one block of a larger group.
GROUP, BLOCK = 4_000, 2_000
#: Fingerprints compared in one step of a task, rows against all later ones.
TILE = 256
BLOCK_CHARS = 1_000_000
#: Shingles whose bits are counted at once.
CHUNK = 1 << 16
_NULL_ID = -(2**63)
_LOWER = bytes(b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))


@dataclass(frozen=True)
class Ring:
    """Segments of a fingerprint, lowest bits first, and the budgets of chains of segments."""

    near: int = 3

    def __post_init__(self):
        if not 0 <= self.near < BITS:
            raise ValueError("near must be from 0 to 63")

    @property
    def segments(self) -> int:
        return self.near + 1

    def budget(self, length: int) -> int:
        """Most differing bits in a chain of ``length`` segments."""
        return length * self.near // self.segments

    def bounds(self, segment: int) -> tuple[int, int]:
        """First bit of a segment and the first one after it."""
        return segment * BITS // self.segments, (segment + 1) * BITS // self.segments

    def parts(self, start: int, step: int) -> list[tuple[int, int]]:
        """Bit ranges of segment ``start + step``, one of which is equal in a chain from ``start``."""
        low, high = self.bounds((start + step) % self.segments)
        pieces = min(self.budget(step + 1) + 1, high - low)
        if pieces <= self.budget(step + 1):  # fewer bits than the budget: nothing need be equal
            return []
        return [(low + i * (high - low) // pieces, low + (i + 1) * (high - low) // pieces) for i in range(pieces)]

    def chain_masks(self, start: int) -> list[tuple[np.uint64, int]]:
        """Bits of the chains from ``start``, with their budgets."""
        found, bits = [], 0
        for length in range(1, self.segments + 1):
            low, high = self.bounds((start + length - 1) % self.segments)
            bits |= (1 << high) - (1 << low)
            found.append((np.uint64(bits), self.budget(length)))
        return found


def fingerprint(text: str, words: int) -> int:
    """The unsigned fingerprint of a text."""
    split = text.encode().translate(_LOWER).split()
    if not split:
        return 0
    joined = b" ".join(split)
    lengths = np.fromiter(map(len, split), np.int64, len(split))
    starts = np.cumsum(lengths + 1) - lengths - 1
    n = max(1, len(split) - words + 1)
    ends = (starts + lengths)[min(words, len(split)) - 1 :]
    digest = xxhash.xxh64_digest  # big-endian bytes
    votes = np.zeros(BITS, np.int64)
    for at in range(0, n, CHUNK):
        spans = zip(starts[at : min(n, at + CHUNK)].tolist(), ends[at : at + CHUNK].tolist())
        hashes = b"".join([digest(joined[a:b], SEED) for a, b in spans])
        votes += np.unpackbits(np.frombuffer(hashes, np.uint8)).reshape(-1, BITS).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * votes > n).tobytes(), "big")


def fingerprints(docs: DataFrame, words: int) -> DataFrame:
    """``doc_id`` (null as the lowest number) and the signed fingerprint ``fp`` of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, texts in text_blocks(batches, BLOCK_CHARS):
            found = np.array([fingerprint(t, words) for t in texts], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(found)], ["doc_id", "fp"])

    ids = F.coalesce(F.col("doc_id").cast("long"), F.lit(_NULL_ID)).alias("doc_id")
    return docs.select(ids, "text").mapInArrow(run, "doc_id long, fp long")


def _bits(low: int, high: int) -> Column:
    """Bits ``low`` to ``high - 1`` of a fingerprint as a number."""
    mask = (1 << (high - low)) - 1 if high - low < BITS else -1
    return F.shiftrightunsigned("fp", low).bitwiseAND(F.lit(mask))


def _deeper(rows: DataFrame, ring: Ring, step: int) -> DataFrame:
    """Rows (grp, start, fp) of groups, split by the equal parts of segment ``start + step``."""
    ways = None
    for start in range(ring.segments):
        keys = [
            F.xxhash64("grp", F.lit(step), F.lit(low), _bits(low, high)) for low, high in ring.parts(start, step)
        ]
        found = F.array(*keys)
        ways = F.when(F.col("start") == start, found) if ways is None else ways.when(F.col("start") == start, found)
    return rows.select(F.explode(ways).alias("grp"), "start", "fp")


def _candidates(nodes: DataFrame, ring: Ring, group: int) -> tuple[DataFrame, DataFrame | None]:
    """Rows (grp, start, fp) of groups to compare whole, and of those above ``group`` with their size ``n``."""
    starts = F.explode(F.array(*[F.lit(i) for i in range(ring.segments)])).alias("start")
    rows = _deeper(nodes.select(F.lit(0).cast("long").alias("grp"), starts, "fp"), ring, 0)
    cold = None
    for step in range(1, ring.segments + 1):
        sizes = rows.groupBy("grp").agg(F.count("*").alias("n")).where(F.col("n") > group)
        sizes = stage(sizes, "sizes")
        if sizes.isEmpty():
            return rows if cold is None else cold.unionByName(rows), None
        sized = stage(lookup_join(rows, sizes, ["grp"]), "groups")
        whole = sized.where("n IS NULL").drop("n")
        cold = whole if cold is None else cold.unionByName(whole)
        hot = sized.where("n IS NOT NULL")
        if step == ring.segments or any(not ring.parts(s, step) for s in range(ring.segments)):
            return cold, hot
        rows = _deeper(hot.drop("n"), ring, step)
    raise AssertionError("the last step returns")


def _in_blocks(hot: DataFrame, block: int) -> DataFrame:
    """Rows of large groups in each pair of blocks they belong to."""
    blocks = F.ceil(F.col("n") / block).cast("int")
    own = F.pmod(F.xxhash64("fp", "grp"), blocks).cast("int")
    rows = hot.select("grp", "start", "fp", own.alias("own"), F.explode(F.sequence(F.lit(0), blocks - 1)).alias("other"))
    pair = F.xxhash64("grp", F.least("own", "other"), F.greatest("own", "other"))
    return rows.select(pair.alias("grp"), "start", "fp")


def near_pairs(a: np.ndarray, b: np.ndarray, chain: list[tuple[np.uint64, int]]) -> tuple[np.ndarray, np.ndarray]:
    """Positions in ``a`` and ``b`` of the pairs within all budgets; the last budget is the full distance."""
    differ = np.bitwise_xor.outer(a, b).ravel()
    at = np.arange(len(differ))
    for mask, budget in chain:
        kept = np.bitwise_count(differ & mask) <= budget
        differ, at = differ[kept], at[kept]
    return at // len(b), at % len(b)


def group_links(fps: np.ndarray, chain: list[tuple[np.uint64, int]]) -> tuple[np.ndarray, np.ndarray]:
    """(member, representative) of the members of a group that are connected with an earlier one."""
    label = np.arange(len(fps))
    for top in range(0, len(fps), TILE):
        rows, others = near_pairs(fps[top : top + TILE], fps[top:], chain)
        later = others > rows
        rows, others = rows[later] + top, others[later] + top
        cuts = np.flatnonzero(np.diff(rows)) + 1
        for row, found in zip(rows[np.concatenate([[0], cuts])] if len(rows) else [], np.split(others, cuts)):
            roots = np.unique(np.append(label[found], label[row]))
            if len(roots) > 1:
                label[np.isin(label, roots)] = roots[0]
    moved = np.flatnonzero(label != np.arange(len(fps)))
    return fps[moved], fps[label[moved]]


def _links(rows: DataFrame, ring: Ring) -> DataFrame:
    """(a, b) links inside the groups (grp, start, fp)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chains = [ring.chain_masks(start) for start in range(ring.segments)]
        held: list[np.ndarray] = []
        current = None
        found: list[tuple[np.ndarray, np.ndarray]] = []

        def finish() -> None:
            fps = np.concatenate(held) if held else np.zeros(0, np.int64)
            if len(fps) > 1:
                found.append(group_links(np.unique(fps.view(np.uint64)), chains[current[1]]))

        def batch() -> pa.RecordBatch:
            sides = [np.concatenate(x).view(np.int64) for x in zip(*found)]
            return pa.RecordBatch.from_arrays([pa.array(s) for s in sides], ["a", "b"])

        for rows_in in batches:
            grp, start, fp = (rows_in.column(i).to_numpy(zero_copy_only=False) for i in range(3))
            cuts = np.flatnonzero((np.diff(grp) != 0) | (np.diff(start) != 0)) + 1
            edges = [0, *cuts.tolist(), len(grp)]
            for low, high in zip(edges, edges[1:]):
                if low == high:
                    continue
                key = (grp[low], start[low])
                if key != current:
                    finish()
                    current, held = key, []
                held.append(fp[low:high])
            if sum(len(a) for a, _ in found) >= 10_000:
                yield batch()
                found.clear()
        finish()
        if found:
            yield batch()

    placed = rows.repartition("grp", "start").sortWithinPartitions("grp", "start", "fp")
    return placed.mapInArrow(run, "a long, b long")


def find_links(nodes: DataFrame, near: int = 3, group: int = GROUP, block: int = BLOCK) -> DataFrame:
    """(a, b) pairs of the distinct fingerprints ``fp`` whose components are those of all pairs within ``near`` bits."""
    ring = Ring(near)
    whole, hot = _candidates(nodes, ring, group)
    links = _links(whole, ring)
    if hot is not None:
        links = links.unionByName(_links(_in_blocks(hot, block), ring))
    return stage(links, "links")


def near_duplicates(docs: DataFrame, words: int = 3, near: int = 3) -> DataFrame:
    """``doc_id``, ``fingerprint`` (16 hex digits) and ``component_id`` of every row."""
    printed = stage(fingerprints(docs.select("doc_id", "text"), words), "fingerprints")
    nodes = printed.groupBy("fp").agg(F.min("doc_id").alias("first"), F.count("*").alias("n"))
    nodes = stage(nodes, "nodes")
    roots = stage(components(find_links(nodes.select("fp"), near)), "roots")
    linked = roots.select("root").union(roots.select("k")).distinct().withColumnRenamed("root", "fp")
    members = nodes.join(linked, "fp", "left_semi").join(roots.withColumnRenamed("k", "fp"), "fp", "left")
    members = stage(members.select("fp", "first", F.coalesce("root", "fp").alias("root")), "members")
    least = members.groupBy("root").agg(F.min("first").alias("component"))
    # One row per fingerprint that is shared or linked; any other document stands alone.
    joined = members.join(least, "root").select("fp", "component")
    copies = nodes.where("n > 1").join(linked, "fp", "left_anti").select("fp", F.col("first").alias("component"))
    found = lookup_join(printed, stage(joined.unionByName(copies), "classes"), ["fp"])
    known = lambda value: F.when(value != _NULL_ID, value)
    return found.select(
        known(F.col("doc_id")).alias("doc_id"),
        F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
        known(F.coalesce("component", "doc_id")).alias("component_id"),
    )
