import random

import pytest
import xxhash

import corpus_pipeline
from flowlens.llm import bpe, toxicity
from tests.llm.test_decontam import brute as contaminated
from tests.llm.test_jaccard import brute as near_groups
from tests.llm.test_jaccard import Space
from tests.llm.test_native import expected_lines

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, toxicity double, found_spans string"


def corpus():
    """Toxic texts, repeated lines, near copies and benchmark passages, among ordinary texts."""
    rng = random.Random(12)
    words = [f"word{n}" for n in range(300)]
    items = [(n, " ".join(rng.choices(words, k=20))) for n in range(3)]
    shared = "this very line is in many documents"
    pairs, labels = [], []
    for i in range(120):
        text = " ".join(rng.choices(words, k=60))
        if i % 6 == 0:
            text += " blorfix " + " ".join(rng.choices(words, k=5)) + " zwackel you"
        if i % 5 == 0:
            text = f"{shared}\n{text}\nno{i}"
        if i % 9 == 4:
            text += " " + items[i % 3][1]
        if i % 10 == 7:
            old = pairs[-1][1].split(" ")
            text = " ".join(old[:30] + ["changed"] + old[31:])
        pairs.append((i, text))
        if i % 2 == 0:
            labels.append((i, 1, int(i % 6 == 0)))
    pairs += [(200, None), (201, ""), (3, pairs[3][1]), (None, "no id here")]
    return pairs, labels, items


def kept_of_groups(pairs, space=Space(5, 80)):
    """One row of each group: smallest id (null below all), then smallest hash; all rows without words."""
    hashed = lambda t: (xxhash.xxh64_intdigest((t or "").encode(), 42) + 2**63) % 2**64 - 2**63
    rank = lambda p: (-(2**63) if p[0] is None else p[0], hashed(p[1]))
    kept, groups = [], {}
    for n, size, group in near_groups([(n, t) for n, (_, t) in enumerate(pairs)], space):
        if size:
            groups.setdefault(group, []).append(pairs[n])
        else:
            kept.append(pairs[n])
    return kept + [min(group, key=rank) for group in groups.values()]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    pairs, labels, items = corpus()
    path = str(tmp_path_factory.mktemp("corpus"))
    rows = [(i, t, "en", "s", len(t or ""), 0.9, "x") for i, t in pairs]
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path


def pairs_of(docs):
    return [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]


def test_every_stage_against_brute_force(spark, folder):
    pairs, labels, items = corpus()
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for name, step in corpus_pipeline.STAGES:
        before = pairs_of(docs)
        after = corpus_pipeline.stage(step(spark, docs, folder), name)
        if name != "bpe":
            assert after.columns == docs.columns
        if name == "toxicity":
            corpus_docs = spark.read.parquet(f"{folder}/documents.parquet")
            model = toxicity.fit(corpus_docs, spark.read.parquet(f"{folder}/labels.parquet"))
            scores = toxicity.Scorer(model).score([t or "" for _, t in before])
            expected = [p for p, s in zip(before, scores) if s < 0.5]
            # A score this size of training set gives: most toxic texts go, the others stay.
            toxic = sum("blorfix" in (t or "") for _, t in before)
            missed = sum("blorfix" in (t or "") for _, t in expected)
            assert missed <= 0.2 * toxic and len(expected) - missed >= 0.97 * (len(before) - toxic)
        elif name == "line_dedup":
            expected = [(i, t) for i, _, _, t in expected_lines(before)]
        elif name == "near_duplicates":
            expected = kept_of_groups(before)
            assert (3, pairs[3][1]) in before and before.count((3, pairs[3][1])) == 2
        elif name == "decontamination":
            bad = {r[0] for r in contaminated(before, items) if r[4]}
            expected = [p for p in before if p[0] not in bad]
            assert bad
        else:
            rows = after.collect()
            texts = dict(before)
            encoder = bpe.PrefixEncoder(bpe.VOCABULARY)
            assert sorted((r.doc_id for r in rows), key=repr) == sorted((i for i, _ in before), key=repr)
            assert all(encoder.decode(r.ids) == (texts[r.doc_id] or "") for r in rows)
            break
        assert sorted(pairs_of(after), key=repr) == sorted(expected, key=repr)
        docs = after


def test_run_applies_all_stages(spark, folder):
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "toxicity", "line_dedup", "near_duplicates", "decontamination", "bpe",
    ]
    found = corpus_pipeline.run(spark, folder)
    assert found.columns == ["doc_id", "n_tokens", "ids"] and 0 < found.count() < 124


def test_stages_of_empty_tables(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").limit(0)
    for name, step in corpus_pipeline.STAGES:
        docs = corpus_pipeline.stage(step(spark, docs, folder), name)
        assert docs.count() == 0


def test_one_row_of_each_group_stays(spark, monkeypatch):
    text = " ".join(f"w{i}" for i in range(80))
    near, other, third = text.replace("w40", "x"), "quite another text that stays", "text of a row without id"
    rows = [(1, text, "a"), (2, near, "a"), (2, other, "a"), (None, third, "b"), (None, third, "b"), (7, third, "b")]
    rows += [(9, "seen twice with other columns", "d"), (9, "seen twice with other columns", "c"), (9, "", "e"), (9, "", "e")]
    rows += [(10, None, "f"), (None, "w1 alone", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, near_id string").repartition(5)
    expected = [rows[0], rows[2], rows[3], rows[7], *rows[8:]]
    for most in (corpus_pipeline.BROADCAST_IDS, 0):
        monkeypatch.setattr(corpus_pipeline, "BROADCAST_IDS", most)
        kept = corpus_pipeline.remove_near_duplicates(spark, docs, "")
        assert kept.columns == docs.columns
        assert sorted(map(tuple, kept.collect()), key=repr) == sorted(expected, key=repr)
