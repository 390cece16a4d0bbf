"""N-gram Jaccard join in metric space: Voronoi regions around pivots, exact links, components.

A document is the set of its distinct word shingles (64-bit hashes); the distance of two sets is one
minus their Jaccard similarity, a metric. Documents link when the distance is at most a radius.

1. Equal sets become one node, so copies are never paired.
2. *Cells.* The shingle universe is split into more groups than linked sets can differ in shingles,
   so linked sets agree on whole groups; a cell holds the nodes that agree on one. The group count
   depends on the size class; a node whose partner may be of the class below stands in both.
   Groups with very few shingles are left out while enough others are sure to agree. Linked sets
   share many cells, not one, so each node leaves out its most common cells, one fewer than a link
   needs. Texts that have no more than a passage in common are told apart here.
3. *Regions.* Each cell names its smallest node as pivot; the nodes that name a pivot are its
   Voronoi region, whatever cells they came by. Distances to the pivot are measured once per node
   and pivot.
   Nodes within the radius of the pivot are linked to it, and so to each other's component.
4. *Windows.* By the triangle inequality a node beyond twice the radius has no link into the inner
   part, and one between has links only to inner nodes whose distance to the pivot differs by at
   most the radius. These boundary nodes are compared with that window.
5. *Recursion.* Outer nodes go on, cell by cell, with a new pivot from among them. After ``ROUNDS``
   rounds what is left of the regions is compared in blocks.
6. Links are few (at most one per node, region and block); components come from star contraction.

All steps are shuffles of narrow rows; sets travel only for nodes of shared cells. A region is cut
into blocks of ``STREAMED`` rows to which the pivot is copied, and rows are streamed against it, so
no group is gathered. Bounds change the plan only, never the result.

Defined cases: a text without words has an empty set and stands alone; a text with fewer words than
a shingle has its whole sequence as one shingle; a null id counts as an id below all others; repeated
rows are members of one node; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from flowlens.llm.chunks import text_blocks
from flowlens.plans.staging import stage

ROUNDS = 2
#: Streamed rows of a region, and held rows, in one block.
STREAMED, HELD = 20_000, 400
#: Most entries of a broadcast list of what to compare, some 50 bytes each; a document counts as one more.
BROADCAST_ENTRIES = 1_500_000
CLASS_RATIO = 1.5
SPARE_GROUPS = 1.25
BLOCK_CHARS = 1_000_000
KNOWN_WORDS = 400_000
KNOWN_SETS = 500_000
_NULL_ID = -(2**63)
_LOWER = bytes(b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))
_EDGE = 1e-9


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit words."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@dataclass(frozen=True)
class Space:
    """Shingles of ``words`` words; links at a similarity of at least ``near`` percent."""

    words: int = 3
    near: int = 90

    @property
    def radius(self) -> float:
        return 1 - self.near / 100

    def spread(self, size: int) -> int:
        """Most shingles in which a set of ``size`` can differ from a linked one at least as large."""
        return size * (100 - self.near) // self.near

    def linked(self, shared, a, b):
        return 100 * shared >= self.near * (a + b - shared)

    def light(self) -> int:
        """Groups with fewer shingles than this are usually left out."""
        mean = self.near / (100 - self.near) / CLASS_RATIO / SPARE_GROUPS
        below, chance, least = 0.0, math.exp(-mean), 0
        while below + chance <= 0.16:
            below += chance
            least += 1
            chance *= mean / least
        return least

    def classes(self, size: int) -> list[tuple[int, int, int]]:
        """(class, groups, spread) of the size classes a set stands in."""
        own = max(1, math.ceil(math.log(size) / math.log(CLASS_RATIO) - _EDGE))
        found = []
        for c in (own, own - 1):
            top = int(CLASS_RATIO**c + _EDGE)
            # The class below holds partners only if its largest size is near enough.
            if c > 0 and (c == own or 100 * top >= self.near * size) and (spread := self.spread(top)):
                found.append((c, int(SPARE_GROUPS * (spread + 1)) + 2, spread))
        return found


class Shingler:
    """Shingle sets of texts; the hashes of known words are kept up to a bound."""

    def __init__(self, space: Space):
        self.space = space
        self.known: dict[bytes, int] = {}

    def sets(self, texts: list[str]) -> Iterator[np.ndarray]:
        split = [t.encode().translate(_LOWER).split() for t in texts]
        if len(self.known) > KNOWN_WORDS:
            self.known = {}
        known = self.known
        for word in set().union(*split):
            if word not in known:
                known[word] = xxhash.xxh3_64_intdigest(word)
        width = self.space.words
        for words in split:
            if not words:
                yield np.zeros(0, np.uint64)
                continue
            hashes = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
            n = max(1, len(words) - width + 1)
            taken = min(width, len(words))
            total = np.full(n, taken, np.uint64)
            for i in range(taken):
                total = mix(total * np.uint64(0x9E3779B97F4A7C15) + hashes[i : i + n])
            yield np.unique(total)


def set_key(values: np.ndarray) -> int:
    return int.from_bytes(xxhash.xxh3_128_digest(values.tobytes())[:8], "little", signed=True)


def _text_hash(text: str) -> int:
    """What Spark's ``xxhash64`` gives for the text."""
    h = xxhash.xxh64_intdigest(text.encode(), 42)
    return h - (1 << 64) if h >> 63 else h


def signatures(values: np.ndarray, space: Space, light: int) -> tuple[np.ndarray, list[int]]:
    """Cells of a set, as signed 64-bit numbers, and by their lowest bit how many a link needs.

    Linked sets agree on all groups of a class but at most ``spread``. A set leaves out its groups below a
    threshold, the highest one that leaves fewer out than are sure to agree. Two thresholds meet at the
    higher one, so only a set at the highest possible threshold knows how many cells it shares with a
    partner; any other needs one. The two classes of a set differ in the lowest bit.
    """
    found, needs = [], [1, 1]
    scrambled = mix(values ^ np.uint64(0x5851F42D4C957F2D))
    for number, groups, spread in space.classes(len(values)):
        group = (values % np.uint64(groups)).astype(np.int64)
        order = np.argsort(group, kind="stable")
        sizes = np.bincount(group, minlength=groups)
        sums = np.zeros(groups, np.uint64)
        full = np.flatnonzero(sizes)
        sums[full] = np.add.reduceat(scrambled[order], (np.cumsum(sizes) - sizes)[full])
        least = next(t for t in range(light, -1, -1) if (sizes < t).sum() < groups - spread)
        kept = np.flatnonzero(sizes >= least)
        if least == light:
            needs[number & 1] = len(kept) - spread
        place = mix((np.uint64(number) << np.uint64(40)) + kept.astype(np.uint64))
        found.append(mix(sums[kept] ^ place) & ~np.uint64(1) | np.uint64(number & 1))
    return np.concatenate(found).view(np.int64) if found else np.zeros(0, np.int64), needs


def _ids(docs: DataFrame):
    return docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(_NULL_ID)).alias("doc_id"), "text")


_CELLS = "doc_id long, h long, n long, k long, even long, odd long, sigs array<long>"


def _cells_of(docs: DataFrame, space: Space) -> DataFrame:
    """``doc_id``, text hash, set size, set key, needed cells by lowest bit and cells of every row.

    A task lists the cells of a set once.
    """
    light = space.light()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler, seen = Shingler(space), set()
        nothing = np.zeros(0, np.int64)
        for ids, texts in text_blocks(batches, BLOCK_CHARS):
            hashes = [_text_hash(t) for t in texts]
            sizes, keys, even, odd, cells = [], [], [], [], []
            for values in shingler.sets(texts):
                key = set_key(values)
                sizes.append(len(values))
                keys.append(key)
                new = len(values) and key not in seen
                sigs, needs = signatures(values, space, light) if new else (nothing, (None, None))
                even.append(needs[0])
                odd.append(needs[1])
                cells.append(sigs)
                if new and len(seen) < KNOWN_SETS:
                    seen.add(key)
            offsets = np.concatenate([[0], np.cumsum([len(c) for c in cells])]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    *[pa.array(x, pa.int64()) for x in (ids, hashes, sizes, keys, even, odd)],
                    pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(cells))),
                ],
                ["doc_id", "h", "n", "k", "even", "odd", "sigs"],
            )

    return _ids(docs).mapInArrow(run, _CELLS)


def _with_jobs(docs: DataFrame, per_doc: DataFrame) -> DataFrame:
    """Documents with what is to be compared of them, by id and text: ids may repeat or be null."""
    hashed = _ids(docs).withColumn("h", F.xxhash64("text"))
    return hashed.join(per_doc, ["doc_id", "h"]).select("doc_id", "text", "k", "jobs")


def _with_sets(docs: DataFrame, todo: DataFrame, classes: DataFrame, space: Space) -> DataFrame:
    """Rows of ``todo`` (grp, salt, role, k, d) with the shingles of ``k``, placed and sorted by group and role."""
    per_doc = stage(
        todo.join(classes.select("k", "doc_id", "h"), "k").groupBy("doc_id", "h", "k").agg(F.collect_list(F.struct("grp", "salt", "role", "d")).alias("jobs")),
        "todo",
    )
    entries = per_doc.agg(F.sum(F.size("jobs") + 1)).first()[0] or 0
    if entries <= BROADCAST_ENTRIES:
        per_doc = F.broadcast(per_doc)
    jobs = _with_jobs(docs, per_doc)
    names = ["grp", "salt", "role", "d", "k", "shingles"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(space)
        for batch in batches:
            for i in range(batch.num_rows):
                text, key, listed = (batch.column(c)[i].as_py() for c in (1, 2, 3))
                values = next(shingler.sets([text or ""]))
                if set_key(values) != key:  # another text with the same id and hash
                    continue
                data = values.tobytes()
                for part in range(0, len(listed), 256):
                    some = listed[part : part + 256]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([j["grp"] for j in some], pa.int64()),
                            pa.array([j["salt"] for j in some], pa.int32()),
                            pa.array([j["role"] for j in some], pa.int32()),
                            pa.array([j["d"] for j in some], pa.float64()),
                            pa.array([key] * len(some), pa.int64()),
                            pa.array([data] * len(some), pa.binary()),
                        ],
                        names,
                    )

    rows = jobs.mapInArrow(run, "grp long, salt int, role int, d double, k long, shingles binary")
    return rows.repartition("grp", "salt").sortWithinPartitions("grp", "salt", "role", "k")


class _Held:
    """An index over the sets that one block holds."""

    def __init__(self):
        self.keys, self.sets, self.distances = [], [], []
        self.values = None

    def add(self, key: int, values: np.ndarray, d: float | None) -> None:
        if not self.keys or self.keys[-1] != key:  # repeated rows
            self.keys.append(key)
            self.sets.append(values)
            self.distances.append(math.nan if d is None else d)

    def shared(self, values: np.ndarray) -> np.ndarray:
        """Shingles in common with each held set."""
        if self.values is None:
            flat = np.concatenate(self.sets)
            self.sizes = np.array([len(s) for s in self.sets])
            owner = np.repeat(np.arange(len(self.sets)), self.sizes)
            order = np.argsort(flat, kind="stable")
            self.values, self.owner = flat[order], owner[order]
            self.d = np.array(self.distances)
        low = np.searchsorted(self.values, values, "left")
        high = np.searchsorted(self.values, values, "right")
        sizes = high - low
        at = np.repeat(low - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())
        return np.bincount(self.owner[at], minlength=len(self.keys))


def _streamed(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[_Held, int, float, np.ndarray]]:
    """Each streamed row (role 1) with the held rows (role 0) of its block."""
    current, held = None, _Held()
    for batch in batches:
        grp, salt, role, d, key = (batch.column(c).to_pylist() for c in range(5))
        shingles = batch.column(5)
        for i in range(batch.num_rows):
            if (grp[i], salt[i]) != current:
                current, held = (grp[i], salt[i]), _Held()
            values = np.frombuffer(shingles[i].as_py(), np.uint64)
            if role[i] == 0:
                held.add(key[i], values, d[i])
            elif held.keys:
                yield held, key[i], d[i], values


def _measure(rows: DataFrame, space: Space) -> DataFrame:
    """(p, k, d, near): distance of every streamed node to the held pivot of its block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: list[tuple] = []
        for held, key, _, values in _streamed(batches):
            shared = int(held.shared(values)[0])
            union = len(values) + int(held.sizes[0]) - shared
            near = bool(space.linked(shared, len(values), int(held.sizes[0])))
            found.append((held.keys[0], key, 1 - shared / union, near))
            if len(found) == 10_000:
                yield _batch(found)
                found = []
        if found:
            yield _batch(found)

    def _batch(found):
        kinds = (pa.int64(), pa.int64(), pa.float64(), pa.bool_())
        return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*found), kinds)], ["p", "k", "d", "near"])

    return rows.mapInArrow(run, "p long, k long, d double, near boolean")


def _link(rows: DataFrame, space: Space, inner: bool) -> DataFrame:
    """(a, b) links between held and streamed nodes, without those that earlier links of the block imply.

    ``inner``: the streamed nodes are linked with each other already.
    """
    radius = space.radius + _EDGE

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: list[tuple[int, int]] = []
        block, root = None, {}

        def top(x):
            while (up := root.get(x, x)) != x:
                root[x] = root.get(up, up)
                x = up
            return x

        for held, key, d, values in _streamed(batches):
            if held is not block:
                block, root = held, {}
            shared = held.shared(values)
            near = space.linked(shared, len(values), held.sizes)
            if d is not None:
                near &= ~(np.abs(held.d - d) > radius)
            mine = "inner" if inner else key
            for i in np.flatnonzero(near):
                other = held.keys[i]
                if other != key and top(other) != top(mine):
                    root[top(other)] = top(mine)
                    found.append((other, key))
            if len(found) >= 10_000:
                yield _batch(found)
                found = []
        if found:
            yield _batch(found)

    def _batch(found):
        return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*found)], ["a", "b"])

    return rows.mapInArrow(run, "a long, b long")


def _blocks(count, most: int):
    return F.ceil(count / most).cast("int")


def _salt(blocks):
    return F.pmod(F.xxhash64("k"), blocks).cast("int")


def _every(blocks):
    return F.explode(F.sequence(F.lit(0), blocks - 1))


def _no_d():
    return F.lit(None).cast("double").alias("d")


def _rare(cells: DataFrame, needs: DataFrame) -> DataFrame:
    """Each node's shared cells of a class without the most common ones, one fewer than a link needs.

    Both nodes of a link leave out less than what they share, in the same order, so their rarest common
    cell stays; a node that shares fewer cells with all others together than a link needs keeps none.
    """
    shared = cells.groupBy("sig").agg(F.count("*").alias("nodes")).where("nodes > 1")
    odd = F.col("sig").bitwiseAND(F.lit(1).cast("long"))
    need = F.when(odd == 1, F.col("need_odd")).otherwise(F.col("need_even"))
    rows = cells.join(shared, "sig").join(needs, "k").select("sig", "k", "nodes", odd.alias("odd"), need.alias("need"))
    order = Window.partitionBy("k", "odd").orderBy(F.desc("nodes"), "sig")
    return rows.withColumn("place", F.row_number().over(order)).where("place >= need").select("sig", "k")


def _regions(cells: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Cells with their pivots, and the (p, k) pairs to measure."""
    pivots = cells.groupBy("sig").agg(F.min("k").alias("p"), F.max("k").alias("top")).where("p < top")
    named = stage(cells.join(pivots.drop("top"), "sig"), "cells")
    return named, named.where("k <> p").select("p", "k").distinct()


def _pivot_rows(pairs: DataFrame) -> DataFrame:
    counts = pairs.groupBy("p").agg(_blocks(F.count("*"), STREAMED).alias("blocks"))
    streamed = pairs.join(counts, "p").select(
        F.col("p").alias("grp"), _salt(F.col("blocks")).alias("salt"), F.lit(1).alias("role"), "k", _no_d()
    )
    held = counts.select(
        F.col("p").alias("grp"), _every(F.col("blocks")).alias("salt"), F.lit(0).alias("role"), F.col("p").alias("k"), _no_d()
    )
    return streamed.unionByName(held)


def _window_rows(measured: DataFrame, space: Space) -> DataFrame:
    """Boundary nodes of each region, held in blocks, and the inner nodes of their window, streamed."""
    boundary = measured.where((~F.col("near")) & (F.col("d") <= 2 * space.radius + _EDGE))
    regions = boundary.groupBy("p").agg(
        _blocks(F.count("*"), HELD).alias("blocks"), F.min("d").alias("low"), F.max("d").alias("high")
    )
    held = boundary.join(regions, "p").select(
        F.col("p").alias("grp"), _salt(F.col("blocks")).alias("salt"), F.lit(0).alias("role"), "k", "d"
    )
    inner = measured.where("near").join(regions, "p")
    inner = inner.where((F.col("d") >= F.col("low") - space.radius - _EDGE) & (F.col("k") != F.col("p")))
    streamed = inner.select(
        F.col("p").alias("grp"), _every(F.col("blocks")).alias("salt"), F.lit(1).alias("role"), "k", "d"
    )
    return held.unionByName(streamed)


def _rest_rows(cells: DataFrame) -> DataFrame:
    """What is left of the cells, by pivot: held blocks of each region against all its nodes."""
    pivots = cells.groupBy("sig").agg(F.min("k").alias("p"), F.max("k").alias("top")).where("p < top")
    members = stage(cells.join(pivots.select("sig", "p"), "sig").select("p", "k").distinct(), "rest")
    regions = members.groupBy("p").agg(_blocks(F.count("*"), HELD).alias("blocks"))
    kept = members.join(regions, "p").select(F.col("p").alias("grp"), "k", "blocks")
    held = kept.select("grp", _salt(F.col("blocks")).alias("salt"), F.lit(0).alias("role"), "k", _no_d())
    streamed = kept.select("grp", _every(F.col("blocks")).alias("salt"), F.lit(1).alias("role"), "k", _no_d())
    return held.unionByName(streamed)


def find_links(docs: DataFrame, keys: DataFrame, classes: DataFrame, space: Space) -> DataFrame:
    """(a, b) node pairs within the radius whose components are those of all such pairs."""
    rows = keys.select(F.explode("sigs").alias("sig"), "k")
    shared = rows.groupBy("sig").count().where("count > 1").select("sig")
    cells = stage(rows.join(shared, "sig").distinct(), "shared")
    cells = stage(_rare(cells, classes.select("k", "need_even", "need_odd")), "rare")
    links = []
    for _ in range(ROUNDS):
        named, pairs = _regions(cells)
        if named.isEmpty():
            return _union(links, cells)
        measured = stage(_measure(_with_sets(docs, _pivot_rows(pairs), classes, space), space).distinct(), "measured")
        links.append(measured.where("near").select(F.col("p").alias("a"), F.col("k").alias("b")))
        window = _window_rows(measured, space)
        links.append(stage(_link(_with_sets(docs, window, classes, space), space, inner=True), "links"))
        outer = measured.where(~F.col("near")).select("p", "k")
        cells = stage(named.join(outer, ["p", "k"]).select("sig", "k"), "outer")
    rest = _rest_rows(cells)
    links.append(stage(_link(_with_sets(docs, rest, classes, space), space, inner=False), "links"))
    return _union(links, cells)


def _union(links: list[DataFrame], like: DataFrame) -> DataFrame:
    empty = like.select(F.col("k").alias("a"), F.col("k").alias("b")).limit(0)
    for part in links:
        empty = empty.unionByName(part)
    return empty


def components(links: DataFrame) -> DataFrame:
    """(k, root) of every linked node: the smallest node of its component, by star contraction.

    Large stars hang each node's larger neighbours on its smallest one, small stars its smaller ones.
    """
    edges = stage(
        links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u > v").distinct(), "edges"
    )
    before = None
    while True:
        state = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v") % (1 << 40)).alias("h")).first()
        if state == before:
            return edges.select(F.col("u").alias("k"), F.col("v").alias("root"))
        before = state
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = stage(large.where("u > v").distinct(), "edges")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u")
        edges = small.select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = stage(edges.unionByName(least.select("u", F.col("m").alias("v"))).where("u > v").distinct(), "edges")


def grouped(docs: DataFrame, space: Space = Space()) -> DataFrame:
    """Every row's ``doc_id``, text hash ``h``, ``n_shingles``, ``component_id`` and whether it is ``first``.

    First is the row of a component with the smallest id, of several texts with that id the one with the
    smallest hash; rows that repeat its id and text are first with it. A null text has the hash of an empty one.
    """
    docs = docs.select("doc_id", "text")
    keys = stage(_cells_of(docs, space), "keys")
    least = F.min(F.struct("doc_id", "h")).alias("least")
    needs = [F.max("even").alias("need_even"), F.max("odd").alias("need_odd")]
    classes = keys.where("n > 0").groupBy("k").agg(least, *needs)
    classes = stage(classes.select("k", "least.*", "need_even", "need_odd"), "classes")
    roots = stage(components(find_links(docs, keys, classes, space)), "roots")
    labelled = classes.join(roots, "k", "left").select("k", "doc_id", "h", F.coalesce("root", "k").alias("root"))
    smallest = labelled.groupBy("root").agg(F.min(F.struct("doc_id", "h")).alias("least"))
    by_key = labelled.join(smallest, "root").select("k", "least")
    # Empty sets carry no key to a component; one side has one row per key.
    first = F.struct("doc_id", "h") == F.col("least")
    full = keys.where("n > 0").join(by_key, "k").select("doc_id", "h", "n", "least.doc_id", first.alias("first"))
    full = full.toDF("doc_id", "h", "n", "component_id", "first")
    own = F.col("doc_id").alias("component_id")
    alone = keys.where("n = 0").select("doc_id", "h", "n", own, F.lit(True).alias("first"))
    null_id = lambda name: F.when(F.col(name) != _NULL_ID, F.col(name)).alias(name)
    return full.unionByName(alone).select(
        null_id("doc_id"), "h", F.col("n").alias("n_shingles"), null_id("component_id"), "first"
    )


def near_duplicates(docs: DataFrame, space: Space = Space()) -> DataFrame:
    """``doc_id``, ``n_shingles`` and ``component_id`` of every row."""
    return grouped(docs, space).select("doc_id", "n_shingles", "component_id")
