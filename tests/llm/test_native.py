import hashlib
import os
import random
import re
from collections import Counter, defaultdict

from hypothesis import given, settings
from hypothesis import strategies as st

from flowlens.llm import lines, quality

BLANK = " \t\n\x0b\x0c\r"


def expected_lines(pairs):
    def key(line):
        return re.sub("[A-Z]", lambda m: m[0].lower(), line.strip(BLANK))

    rank = lambda i: -(2**63) if i is None else i
    holders = defaultdict(set)
    for i, text in pairs:
        for line in (text or "").split("\n"):
            if len(key(line)) >= 10:
                holders[key(line)].add(rank(i))
    found = []
    for i, text in pairs:
        parts = (text or "").split("\n")
        kept = [p for p in parts if key(p) not in holders or min(holders[key(p)]) == rank(i)]
        found.append((i, len(parts), len(parts) - len(kept), "\n".join(kept)))
    return sorted(found, key=repr)


def test_line_dedup_of_odd_rows(docs_of, odd):
    got = lines.dedup_lines(docs_of(odd)).collect()
    assert sorted(map(tuple, got), key=repr) == expected_lines(odd)


def test_line_dedup_against_brute_force(docs_of):
    rng = random.Random(5)
    pool = [f"Line number {n} of the pool{' ' * (n % 3)}" for n in range(40)] + ["short", "", "LINE NUMBER 3 OF THE POOL"]
    pairs = [(i * 7 % 101, "\n".join(rng.choices(pool, k=rng.randint(0, 9)))) for i in range(101)]
    for batches, fan_in in ((1, 2), (4, 2), (7, 3)):
        got = lines.dedup_lines(docs_of(pairs), batches=batches, fan_in=fan_in).collect()
        assert sorted(map(tuple, got), key=repr) == expected_lines(pairs)


def test_line_dedup_of_nothing_and_carried_columns(docs_of):
    assert lines.dedup_lines(docs_of([])).count() == 0
    kept = lines.dedup_lines(docs_of([(1, "x"), (2, "y")]), carry=("ord", "lang", "rows"))
    assert kept.columns == ["doc_id", "n_lines", "n_dropped", "kept_text", "ord", "lang", "rows"]
    assert {(r.ord, r.rows) for r in kept.collect()} == {("y", "z")}


def test_runs_are_compacted_by_level(spark):
    store = lines.LineRuns(spark, buckets=2, fan_in=2)
    schema = "ord long, row long, pos int, h1 long, h2 long"
    for batch in range(4):
        rows = [(10 * batch + i, 0, 0, i, i) for i in range(batch + 2)]
        marked = store.add(spark.createDataFrame(rows, schema)).collect()
        assert {r.h1 for r in marked} == (set(range(batch + 1)) if batch else set())
    assert [len(level) for level in store.levels] == [0, 0, 1]
    assert spark.table(store.runs()[0]).count() == 5
    store.close()
    assert store.runs() == []


def test_runs_are_merged_without_a_shuffle(spark):
    store = lines.LineRuns(spark, buckets=3, fan_in=9)
    schema = "ord long, row long, pos int, h1 long, h2 long"
    for batch in range(2):
        store.add(spark.createDataFrame([(i, 0, 0, i, i) for i in range(5 * batch, 7 + 5 * batch)], schema))
    merged = store.merged(store.runs())
    assert "Exchange" not in merged._jdf.queryExecution().executedPlan().toString()
    assert sorted(r.h1 for r in merged.collect()) == list(range(12))
    store.close()


def test_a_store_outlives_the_call(docs_of, spark, tmp_path):
    """Two tables in turn give what one call on both gives, also when the store is opened anew between."""
    rng = random.Random(6)
    pool = [f"line number {n} of the pool" for n in range(60)] + ["short"]
    pairs = [(None, pool[0])] + [(i, "\n".join(rng.choices(pool, k=rng.randint(0, 6)))) for i in range(60)]
    folder = str(tmp_path / "runs")
    store = lines.LineRuns(spark, buckets=2, folder=folder)
    first = lines.dedup_lines(docs_of(pairs[:30]), store=store).collect()
    store.close()
    store = lines.LineRuns.open(spark, folder)
    lost = lines.LineRuns.open(spark, folder)
    lost.add(spark.createDataFrame([(1, 0, 0, 5, 5)], "ord long, row long, pos int, h1 long, h2 long"))
    second = lines.dedup_lines(docs_of(pairs[30:]), store=store).collect()
    assert sorted(map(tuple, first + second), key=repr) == expected_lines(pairs)
    again = lines.LineRuns.open(spark, folder)
    named = {spark.table(name).inputFiles()[0].split("/run-")[1].split("/")[0] for name in again.runs()}
    assert len(again.runs()) == len(store.runs()) and len(named) == len(again.runs())
    repeated = lines.dedup_lines(docs_of(pairs[30:]), store=again).collect()
    assert sorted(map(tuple, repeated), key=repr) == sorted(map(tuple, second), key=repr)
    for opened in (store, lost, again):
        opened.close()


def test_no_files_are_left(docs_of, spark):
    from flowlens.plans.staging import work_dir

    before = set(os.listdir(f"{work_dir(spark)}/flowlens")) if os.path.isdir(f"{work_dir(spark)}/flowlens") else set()
    assert lines.dedup_lines(docs_of([(1, "some long line here"), (2, "Some long line here")])).count() == 2
    left = {name.rsplit("-", 5)[0].split("-")[0] for name in set(os.listdir(f"{work_dir(spark)}/flowlens")) - before}
    assert left <= {"keys", "marked"}


def covered(words):
    at = defaultdict(list)
    for i in range(len(words) - 2):
        at[tuple(words[i : i + 3])].append(i)
    return len({i + s for places in at.values() if len(places) > 1 for i in places for s in range(3)})


def measured(text):
    words = [w for w in re.split("[\x20\x09-\x0d]+", text or "") if w]
    full = [x for x in (text or "").split("\n") if re.search("[^\x20\x09-\x0d]", x)]
    return (
        len(words),
        sum(map(len, words)),
        sum((text or "").count(c) for c in quality.SYMBOLS),
        sum(n - 1 for n in Counter(full).values()),
        covered(words),
    )


def test_quality_measures(docs_of, odd):
    rng = random.Random(2)
    texts = ["\n".join(" ".join(rng.choices("a b c d #x $ the".split(), k=rng.randint(0, 12))) for _ in range(6)) for _ in range(40)]
    pairs = odd + [(100 + i, t) for i, t in enumerate(texts)]
    rated = quality.apply_rules(docs_of(pairs)).collect()
    assert len(rated) == len(pairs)
    got = sorted((tuple(r)[:6] for r in rated), key=repr)
    assert got == sorted(((i, *measured(t)) for i, t in pairs), key=repr)
    assert all(r.base_failed == (r.n_words < 50 or 2 * r.n_repeat_words > r.n_words) for r in rated)
    assert not any(r.kept for r in rated if r.base_failed)
    assert all(r.kept == (r.broken_rules == []) for r in rated)


def test_quality_rules_name_what_is_broken(docs_of):
    good = " ".join(f"the word{i} of" for i in range(30))
    pairs = [(1, good), (2, good.replace("word", "###word")), (3, good.replace("the", "zz").replace("of", "yy"))]
    broken = {r.doc_id: r.broken_rules for r in quality.apply_rules(docs_of(pairs)).collect()}
    assert broken == {1: [], 2: ["symbols"], 3: ["stop_words"]}
    assert quality.apply_rules(docs_of([])).count() == 0


@settings(max_examples=20, deadline=None)
@given(st.lists(st.sampled_from(["a", "b", "c"]), max_size=25))
def test_repeated_words(words):
    # The union length of repeated windows, by sorted starts as the projection does it.
    at = defaultdict(list)
    for i in range(len(words) - 2):
        at[tuple(words[i : i + 3])].append(i)
    total, last = 0, -3
    for p in sorted(i for places in at.values() if len(places) > 1 for i in places):
        total, last = total + min(3, p - last), p
    assert total == covered(words)


def test_kept_text_digest(docs_of):
    row = lines.dedup_lines(docs_of([(1, "only here, once")])).first()
    assert hashlib.sha256(row.kept_text.encode()).hexdigest() == hashlib.sha256(b"only here, once").hexdigest()
