import json
import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from flowlens.llm import bpe, tokens


@pytest.fixture(scope="module")
def library():
    tokenizer = Tokenizer.from_file(bpe.VOCABULARY)
    tokenizer.no_padding()
    tokenizer.no_truncation()
    return tokenizer


def hard_texts():
    rng = random.Random(1)
    letters = "abetionst hr'éß😀漢 \n\t12.½_-​"
    texts = ["".join(rng.choices(letters, k=rng.randint(0, 60))) for _ in range(300)]
    return texts + ["", "   ", "don't I'LL we've", "a" * 500, "<|endoftext|>a<|endoftext|>", " <|endoftext", "\x00\x1c\x85　x"]


def test_encoding_equals_the_library(library):
    texts = hard_texts()
    encoder = bpe.PrefixEncoder(bpe.VOCABULARY)
    ids = [list(bpe.unpacked(x)) for x in encoder.encode_block(texts)]
    assert ids == [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    decoded = [encoder.decode(bpe.packed(x)) for x in ids]
    assert decoded == [library.decode(x, skip_special_tokens=False) for x in ids]


def test_prefix_states_equal_plain_merging():
    encoder = bpe.PrefixEncoder(bpe.VOCABULARY)
    words = sorted({t.encode() for text in hard_texts() for t in encoder.words(text)} - {b"<|endoftext|>"})
    assert list(encoder.encode_words(words)) == [encoder.merge(w) for w in words]


def test_forgetting_words_changes_nothing(monkeypatch):
    texts = hard_texts()
    whole = bpe.PrefixEncoder(bpe.VOCABULARY).encode_block(texts)
    monkeypatch.setattr(bpe, "KNOWN_WORDS", 10)
    encoder = bpe.PrefixEncoder(bpe.VOCABULARY)
    assert [encoder.encode_block([t])[0] for t in texts] == whole


def test_round_trip_of_odd_rows(docs_of, odd, library):
    got = bpe.decode(bpe.encode(docs_of(odd))).collect()
    assert sorted(((r.doc_id, r.decoded) for r in got), key=repr) == sorted(((i, t or "") for i, t in odd), key=repr)
    for row in got:
        assert row.n_tokens == len(library.encode(row.decoded, add_special_tokens=False).ids) == len(row.ids) // 4
    assert bpe.decode(bpe.encode(docs_of([]))).count() == 0


def test_length_sums_against_brute_force(docs_of, odd, library):
    pairs = odd + [(100 + i, "tok " * (i % 9) + "x" * (700 * (i == 3))) for i in range(60)]
    lengths = [len(library.encode(t or "", add_special_tokens=False).ids) for _, t in pairs]
    sums = tokens.suffix_sums(tokens.histogram(docs_of(pairs))).collect()
    assert {r.n_tokens for r in sums} == set(lengths)
    for r in sums:
        limit = r.n_tokens
        assert r.n_docs == lengths.count(limit)
        assert r.docs_at_least == sum(n >= limit for n in lengths)
        assert r.tokens_at_least == sum(n for n in lengths if n >= limit)
        assert r.truncated_tokens == sum(min(n, limit) for n in lengths)
        assert r.rank_share == sum(n <= limit for n in lengths) / len(lengths)
        assert (r.all_docs, r.all_tokens) == (len(lengths), sum(lengths))


def test_limits_between_lengths_and_quantiles(docs_of, library):
    pairs = [(i, "tok " * n) for i, n in enumerate([0, 1, 5, 5, 9])]
    lengths = sorted(len(library.encode(t, add_special_tokens=False).ids) for _, t in pairs)
    sums = tokens.suffix_sums(tokens.histogram(docs_of(pairs)))
    for limit in (0, 3, 7, 100):
        assert tokens.truncated_total(sums, limit).first().truncated_tokens == sum(min(n, limit) for n in lengths)
    got = {r.share: r.n_tokens for r in tokens.quantiles(sums, [0.2, 0.5, 1.0]).collect()}
    assert got == {0.2: lengths[0], 0.5: lengths[2], 1.0: lengths[4]}


def test_no_documents(docs_of):
    assert tokens.suffix_sums(tokens.histogram(docs_of([]))).count() == 0


def _odd_texts(n):
    rng = random.Random(n)
    letters = "abcde  \n\t019.,'sß漢字😀\u00a0\x1c-"
    return ["".join(rng.choices(letters, k=rng.randint(0, 300))) + " it's <|endoftext|> x" for _ in range(60)]


def test_known_pairs_are_bounded(monkeypatch):
    monkeypatch.setattr(bpe, "KNOWN_PAIRS", 7)
    encoder, texts = bpe.PrefixEncoder(bpe.VOCABULARY), _odd_texts(1)
    expected = Tokenizer.from_file(bpe.VOCABULARY).encode_batch(texts, add_special_tokens=False)
    assert [list(bpe.unpacked(c)) for c in encoder.encode_block(texts)] == [e.ids for e in expected]
    assert len(encoder._fits) <= 7


@pytest.mark.parametrize("pattern", [r"\p{N}{1,3}| ?\p{L}+|\s+(?!\S)|\s+", r"[^\s\p{L}]+|\p{L}{2,}"])
def test_the_file_says_how_text_is_cut(tmp_path, pattern):
    with open(bpe.VOCABULARY, encoding="utf-8") as file:
        spec = json.load(file)
    split = {"type": "Split", "pattern": {"Regex": pattern}, "behavior": "Isolated", "invert": False}
    plain = {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}
    spec["pre_tokenizer"] = {"type": "Sequence", "pretokenizers": [split, plain]}
    path = str(tmp_path / "cut.json")
    with open(path, "w", encoding="utf-8") as file:
        json.dump(spec, file)
    texts = _odd_texts(2)
    expected = Tokenizer.from_file(path).encode_batch(texts, add_special_tokens=False)
    assert [list(bpe.unpacked(c)) for c in bpe.PrefixEncoder(path).encode_block(texts)] == [e.ids for e in expected]


def test_other_kinds_of_vocabulary_are_refused(tmp_path):
    with pytest.raises(ValueError, match="end_of_word_suffix"):
        bpe.PrefixEncoder(public_tokenizers.path("word_bpe_49k.json"))
    with open(bpe.VOCABULARY, encoding="utf-8") as file:
        spec = json.load(file)
    spec["pre_tokenizer"]["add_prefix_space"] = True
    with pytest.raises(ValueError, match="pre-tokenizer"):
        bpe.cutting(spec)
