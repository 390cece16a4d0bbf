import random

import numpy as np
import pytest

from flowlens.llm import jaccard
from flowlens.llm.jaccard import Space


def shingles(text, words):
    found = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").encode().split()
    n = max(1, len(found) - words + 1)
    return {tuple(found[i : i + words]) for i in range(n)} if found else set()


def brute(pairs, space):
    sets = [shingles(t, space.words) for _, t in pairs]
    root = list(range(len(pairs)))

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(sets)):
        for b in range(a):
            if sets[a] and sets[b] and space.linked(len(sets[a] & sets[b]), len(sets[a]), len(sets[b])):
                root[top(a)] = top(b)
    rank = lambda i: -(2**63) if i is None else i
    least = {}
    for x, (i, _) in enumerate(pairs):
        least[top(x)] = min(least.get(top(x), 2**63), rank(i))
    plain = lambda i: None if i == -(2**63) else i
    return sorted(((i, len(sets[x]), plain(least[top(x)])) for x, (i, _) in enumerate(pairs)), key=repr)


def edited(words, rate, rng):
    return [rng.choice(["new", "old", "odd"]) + str(rng.randint(0, 999)) if rng.random() < rate else w for w in words]


def corpus(groups, rng, rates):
    texts = []
    for _ in range(groups):
        base = [f"w{rng.randint(0, 400)}" for _ in range(rng.choice([4, 12, 40, 120, 400]))]
        texts += [" ".join(edited(base, rng.choice(rates), rng)) for _ in range(rng.randint(1, 8))]
    passage = " ".join(f"p{i}" for i in range(60))
    texts += [passage + " " + " ".join(f"q{rng.randint(0, 9999)}" for _ in range(80)) for _ in range(12)]
    rng.shuffle(texts)
    return [(3 * i + 1, t) for i, t in enumerate(texts)]


def rows(found):
    return sorted((tuple(r) for r in found.collect()), key=repr)


@pytest.mark.parametrize("space", [Space(3, 90), Space(5, 80), Space(1, 60)], ids=str)
def test_components_against_brute_force(docs_of, space):
    rng = random.Random(space.near)
    pairs = corpus(12, rng, [0, 0.01, 0.02, 0.04])
    assert rows(jaccard.near_duplicates(docs_of(pairs), space)) == brute(pairs, space)


def test_one_hot_group_in_small_blocks(docs_of, monkeypatch):
    """Chains through the windows: copies drift step by step, so that no pivot sees all."""
    monkeypatch.setattr(jaccard, "STREAMED", 7)
    monkeypatch.setattr(jaccard, "HELD", 3)
    monkeypatch.setattr(jaccard, "BROADCAST_ENTRIES", 0)
    rng = random.Random(8)
    words = [f"w{i}" for i in range(300)]
    texts = []
    for _ in range(45):
        at = rng.randrange(len(words))
        words = words[:at] + [f"x{rng.randint(0, 9999)}"] + words[at + 1 :]
        texts.append(" ".join(words))
    pairs = [(i, t) for i, t in enumerate(rng.sample(texts, len(texts)))]
    assert rows(jaccard.near_duplicates(docs_of(pairs), Space(3, 90))) == brute(pairs, Space(3, 90))


def test_odd_rows(docs_of, odd):
    pairs = odd + [(7, "word"), (8, "WORD "), (9, "two words"), (10, "two  Words"), (None, "two words")]
    assert rows(jaccard.near_duplicates(docs_of(pairs))) == brute(pairs, Space())
    assert jaccard.near_duplicates(docs_of([])).count() == 0
    assert rows(jaccard.near_duplicates(docs_of([(1, None), (2, "")]))) == [(1, 0, 1), (2, 0, 2)]


def test_texts_with_a_common_passage_leave_before_they_are_compared(docs_of, monkeypatch):
    rng = random.Random(5)
    passage = " ".join(f"p{i}" for i in range(60))
    texts = [f"{passage} " + " ".join(f"q{rng.randint(0, 10**6)}" for _ in range(700)) for _ in range(150)]
    pairs = list(enumerate([*texts, texts[0].replace("p30", "changed")]))
    compared = []
    joined = jaccard._with_jobs

    def counted(docs, per_doc):
        compared.append(per_doc.count())
        return joined(docs, per_doc)

    monkeypatch.setattr(jaccard, "_with_jobs", counted)
    assert rows(jaccard.near_duplicates(docs_of(pairs), Space(5, 80))) == brute(pairs, Space(5, 80))
    assert max(compared) <= 4


@pytest.mark.parametrize("space", [Space(3, 90), Space(5, 80), Space(2, 67), Space(2, 95)], ids=str)
def test_linked_sets_share_a_cell(space):
    rng = np.random.default_rng(space.near)
    light = space.light()
    for _ in range(400):
        size = int(rng.integers(1, 300))
        a = rng.integers(0, 2**63, size).astype(np.uint64)
        lost, added = rng.integers(0, size // 4 + 1), rng.integers(0, size // 4 + 1)
        b = np.unique(np.concatenate([a[lost:], rng.integers(0, 2**63, added).astype(np.uint64)]))
        a = np.unique(a)
        shared = len(np.intersect1d(a, b))
        if len(b) and shared < max(len(a), len(b)) and space.linked(shared, len(a), len(b)):
            (cells, need), (others, other_need) = (jaccard.signatures(x, space, light) for x in (a, b))
            common = set(cells.tolist()) & set(others.tolist())
            per_class = [sum(c & 1 == bit for c in common) for bit in (0, 1)]
            assert any(n >= max(1, need[bit], other_need[bit]) for bit, n in enumerate(per_class))


def test_short_unrelated_sets_share_no_empty_cell():
    rng = np.random.default_rng(4)
    space, counts = Space(3, 90), {}
    for _ in range(5000):
        for cell in set(jaccard.signatures(np.unique(rng.integers(0, 2**63, 10).astype(np.uint64)), space, space.light())[0].tolist()):
            counts[cell] = counts.get(cell, 0) + 1
    assert max(counts.values()) < 25


def test_components_of_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(7, 7), (205, 203), (203, 205)]
    got = {r.k: r.root for r in jaccard.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    expected = {i: 0 for i in range(1, 41)} | {100 + i: 100 for i in range(1, 30)} | {205: 203}
    assert got == expected
    assert jaccard.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_rows_without_an_id_meet_their_own_work_only(spark, docs_of, monkeypatch):
    rng = random.Random(11)
    base = [[f"w{rng.randint(0, 10**6)}" for _ in range(60)] for _ in range(100)]
    pairs = [(None, " ".join(words[i:])) for words in base for i in (0, 1)]
    seen = []
    joined = jaccard._with_jobs

    def counted(docs, per_doc):
        found = joined(docs, per_doc)
        seen.append(found.count())
        return found

    monkeypatch.setattr(jaccard, "_with_jobs", counted)
    assert rows(jaccard.near_duplicates(docs_of(pairs), Space(3, 90))) == brute(pairs, Space(3, 90))
    assert seen and max(seen) <= len(pairs)


def test_text_hash_is_that_of_spark(spark):
    texts = ["", "a", "ünï 😀", "x" * 1000]
    found = spark.createDataFrame([(t,) for t in texts], "t string").selectExpr("t", "xxhash64(t) AS h").collect()
    assert [jaccard._text_hash(r.t) for r in found] == [r.h for r in found]


def test_first_rows_of_components(docs_of):
    """One text of a component is first: smallest id, null below all, then smallest hash."""
    text = " ".join(f"w{i}" for i in range(80))
    near = text.replace("w40", "x")
    pairs = [(None, near), (5, text), (5, text), (6, near), (6, "something else here"), (7, ""), (7, None)]
    found = jaccard.grouped(docs_of(pairs), Space(3, 90))
    rows = sorted(((r.doc_id, r.n_shingles, r.component_id, r.first) for r in found.collect()), key=repr)
    assert rows == sorted(
        [
            (None, 78, None, True),
            (5, 78, None, False),
            (5, 78, None, False),
            (6, 78, None, False),
            (6, 1, 6, True),
            (7, 0, 7, True),
            (7, 0, 7, True),
        ],
        key=repr,
    )
    both = [r.first for r in jaccard.grouped(docs_of([(1, text), (1, near), (2, near)]), Space(3, 90)).collect()]
    assert sorted(both) == [False, False, True]
