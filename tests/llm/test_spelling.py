import random
import re
import zlib
from collections import Counter

import pytest

from flowlens.llm import spelling

RUN = re.compile("[A-Za-zÀ-ÿ]+")


def words_of(doc_id, text):
    for run in RUN.findall(text or ""):
        run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
        h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
        if h % 31 == 0:
            at = h % len(run)
            run = run[:at] + run[at + 1 :]
        if len(run) >= 7:
            yield run


def is_near(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(a) + 1 == len(b) and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute(pairs):
    counts = Counter(w for i, t in pairs for w in words_of(i, t))
    counts = {w: n for w, n in counts.items() if n >= 2}
    near = {w: [v for v in counts if is_near(w, v)] for w in counts}
    form = {}
    for w, n in counts.items():
        best = min(near[w], key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best is not None and counts[best] >= 10 * n else None

    def root(w):
        while form[w] is not None:
            w = form[w]
        return w

    return sorted(
        ((w, form[w], root(w), n, len(near[w]), counts.get(form[w])) for w, n in counts.items()), key=repr
    )


def rows(found):
    return sorted((tuple(r) for r in found.collect()), key=repr)


def altered(word, rng):
    at = rng.randrange(len(word))
    letter = rng.choice("abcéÿZ")
    return rng.choice([word[:at] + word[at + 1 :], word[:at] + letter + word[at:], word[:at] + letter + word[at + 1 :]])


def corpus(rng):
    bases = ["".join(rng.choice("abc") for _ in range(rng.randint(6, 14))) for _ in range(12)]
    bases += ["aaaaaaa", "aaaaaaaa", "aaaaaaaaaaa", "Étéabcdefgh", "x" * 40]
    found = []
    for i in range(60):
        picked = []
        for _ in range(rng.randint(0, 60)):
            word = rng.choice(bases)
            for _ in range(rng.choice([0, 0, 0, 0, 1, 2])):
                word = altered(word, rng)
            picked.append(rng.choice([word, word.upper(), word.capitalize()]))
        found.append((i, rng.choice([" ", "-", ", 7"]).join(picked)))
    return found


@pytest.mark.parametrize("group", [spelling.GROUP, 3, 1])
def test_variants_against_brute_force(docs_of, group):
    pairs = corpus(random.Random(5))
    expected = brute(pairs)
    assert any(form for _, form, *_ in expected) and any(n > 3 for *_, n, _ in expected)
    assert rows(spelling.group_variants(docs_of(pairs), group=group)) == expected


def test_chains_of_forms_end_at_their_root(docs_of):
    pairs = [(i, "abcdefgh " * 100 + "abcdefgx " * 10 + "abcdefyx") for i in range(2)]
    found = {w: (form, root) for w, form, root, *_ in rows(spelling.group_variants(docs_of(pairs)))}
    expected = {w: (form, root) for w, form, root, *_ in brute(pairs)}
    assert found == expected and found["abcdefyx"] == ("abcdefgx", "abcdefgh")


def test_odd_rows(docs_of, odd):
    pairs = [*odd, (None, "sentence sentence"), (9, "sentences× sentences×"), (10, "q" * 5000 + " " + "q" * 5000)]
    assert rows(spelling.group_variants(docs_of(pairs))) == brute(pairs)


def test_empty_table(docs_of):
    assert spelling.group_variants(docs_of([])).collect() == []
    assert spelling.group_variants(docs_of([(1, "short"), (2, None)])).collect() == []


def test_every_pair_meets_in_one_window():
    rng = random.Random(2)
    for _ in range(300):
        a = "".join(rng.choice("ab") for _ in range(rng.randint(7, 11)))
        b = altered(a, rng).lower()
        length = max(len(a), len(b))
        for cuts in ([0, length // 2, length], list(range(length + 1))):
            met = [
                (low, high)
                for low, high in zip(cuts, cuts[1:])
                if list(spelling.near_in_group([a, b], length, low, high, block=1)) == [(0, 1)]
            ] if a != b else []
            assert len(met) == (1 if is_near(a, b) else 0)
            for low, high in met:
                tail = length - high
                assert a[:low] == b[:low] and a[len(a) - tail :] == b[len(b) - tail :]
