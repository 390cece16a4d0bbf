import random
import zlib

import numpy as np
import pytest

from flowlens.llm import langid, licenses, toxicity

SYLLABLES = {"en": "the an er on tion ing", "de": "der ch ung ein keit sch", "fr": "le eau ai ez ou é"}


def invented(lang, rng, words=60):
    parts = SYLLABLES[lang].split()
    return " ".join("".join(rng.choices(parts, k=rng.randint(1, 3))) for _ in range(words)) + "."


@pytest.fixture(scope="module")
def many():
    rng = random.Random(4)
    langs = [rng.choice(list(SYLLABLES)) for _ in range(160)]
    return [(i, invented(lang, rng), lang) for i, lang in enumerate(langs)]


# languages


def brute_marginals(scores, transitions, prior):
    """Posterior of one chain by the plain recursions in log space."""
    n, k = scores.shape
    alpha, beta = np.zeros((n, k)), np.zeros((n, k))
    alpha[0] = prior + scores[0]
    for t in range(1, n):
        alpha[t] = scores[t] + np.logaddexp.reduce(alpha[t - 1][:, None] + transitions, axis=0)
    for t in range(n - 2, -1, -1):
        beta[t] = np.logaddexp.reduce(transitions + scores[t + 1] + beta[t + 1], axis=1)
    joint = alpha + beta
    joint = np.exp(joint - joint.max(axis=1, keepdims=True))
    return joint / joint.sum(axis=1, keepdims=True)


def test_marginals_of_laid_out_chains_equal_plain_recursions():
    rng = np.random.default_rng(0)
    sizes = [1, 3, 64, 65, 200, 2]
    k = 3
    transitions, prior = rng.normal(size=(k, k)), rng.normal(size=k)
    chains = [rng.normal(size=(n, k)) * 2 for n in sizes]
    opens = np.zeros(sum(sizes), bool)
    opens[np.cumsum(sizes) - sizes] = True
    got = langid.marginals(np.concatenate(chains), opens, transitions, prior)
    expected = np.concatenate([brute_marginals(c, transitions, prior) for c in chains])
    assert np.allclose(got, expected, atol=1e-8)


def test_held_out_languages(spark, many):
    docs = spark.createDataFrame([(i, t, lang, "und") for i, t, lang in many], "doc_id long, text string, lang string, score string")
    found = {r.doc_id: r for r in langid.learn_and_identify(docs).collect()}
    for i, _, lang in many:
        assert found[i].held_out == (zlib.crc32(str(i).encode()) % 4 == 2)
        assert 0 <= found[i].score <= 1
    held = [(found[i].lang_pred, lang) for i, _, lang in many if found[i].held_out]
    assert sum(a == b for a, b in held) >= 0.95 * len(held)


def test_words_of_switched_text_are_labelled_apart(many):
    model = langid.train([(lang, text) for _, text, lang in many])
    rng = random.Random(9)
    tagger = langid.Tagger(model)
    mixed = invented("en", rng, 40) + " " + invented("de", rng, 40)
    (label, score), = tagger.label([mixed])
    assert label in ("en", "de") and 0.35 < score < 0.75
    assert tagger.label(["", "12 !?", "\x00"]) == [("und", 0.0)] * 3


def test_languages_of_odd_rows(docs_of, odd):
    got = langid.learn_and_identify(docs_of(odd, lang="en")).collect()
    assert len(got) == len(odd)
    assert {r.lang_pred for r in got if r.doc_id in (1, 2, 3)} == {"und"}
    assert {r.lang_pred for r in langid.learn_and_identify(docs_of(odd)).collect()} == {"und"}
    assert langid.learn_and_identify(docs_of([])).count() == 0


# toxicity


def plain_kernel(a, b):
    """Sum over common subsequences of three letters of the decays of both spans."""

    def weights(word):
        found = {}
        for i in range(len(word)):
            for j in range(i + 1, len(word)):
                for k in range(j + 1, len(word)):
                    key = word[i] + word[j] + word[k]
                    found[key] = found.get(key, 0) + toxicity.DECAY ** (k - i + 1)
        return found

    x, y = weights(a), weights(b)
    dot = lambda p, q: sum(v * q.get(key, 0) for key, v in p.items())
    return dot(x, y) / np.sqrt(dot(x, x) * dot(y, y))


def test_kernel_equals_its_definition():
    words = ["idiot", "idxiot", "moron", "abcabc", "trash"]
    values = toxicity.kernel(words, toxicity.explicit(["idiot", "abc"]))
    for row, word in enumerate(words):
        for column, landmark in enumerate(["idiot", "abc"]):
            assert values[row, column] == pytest.approx(plain_kernel(word, landmark) ** toxicity.POWER, abs=1e-5)
    assert (toxicity.kernel(["ab", "x"], toxicity.explicit(["idiot"])) == 0).all()


def toxic_rows(many, insults=("blorf", "zwackel", "grunxe")):
    rng = random.Random(6)
    found = []
    for i, text, _ in many:
        words = text.split()
        bad = i % 3 == 0
        if bad:
            for word in rng.choices(insults, k=3):
                words.insert(rng.randint(1, len(words) - 1), word)
        found.append((i, " ".join(words), int(bad)))
    return found


def test_held_out_toxicity(spark, many):
    rows = toxic_rows(many)
    docs = spark.createDataFrame([(i, t, "x") for i, t, _ in rows], "doc_id long, text string, toxic string")
    labels = spark.createDataFrame([(i, None, y) for i, _, y in rows], "doc_id long, quality int, toxic int")
    found = {r.doc_id: r for r in toxicity.learn_and_score(docs, labels).collect()}
    held = [(found[i].predicted, y) for i, _, y in rows if found[i].held_out]
    assert len(held) > 15 and sum(a == b for a, b in held) >= 0.9 * len(held)
    for i, _, _ in rows:
        assert found[i].held_out == (zlib.crc32(str(i).encode()) % 5 == 0)
        assert found[i].predicted == (found[i].score >= 0.5) and 0 <= found[i].score <= 1


def test_altered_insults_are_found(many):
    model = toxicity.train([(y, t) for _, t, y in toxic_rows(many)])
    scores = toxicity.Scorer(model).score(["the on zwackel er", "the on zwac*kel er", "the z w a c k e l er", "the on er", ""])
    assert (scores[:3] > 0.5).all() and (scores[3:] < 0.5).all()


@pytest.mark.parametrize("first", ["а", "ء", "à"], ids=["cyrillic", "arabic", "accented"])
def test_other_scripts_are_read_like_latin(many, first):
    """The same corpus in other letters: altered insults are found, words of letters five further on are not."""

    def written(text, by=0):
        return "".join(chr(ord(first) + (ord(c) - 97 + by) % 26) if "a" <= c <= "z" else c for c in text)

    model = toxicity.train([(y, written(t)) for _, t, y in toxic_rows(many)])
    around = [f"{written('the on')} {{}} {written('er')}"] * 5
    words = [written("zwackel"), written("zwac*kel"), written("z w a c k e l"), written("zwackel", 5), written("ing")]
    scores = toxicity.Scorer(model).score([a.format(w) for a, w in zip(around, words)])
    assert (scores[:3] > 0.5).all() and (scores[3:] < 0.5).all()


def test_letters_of_a_script_differ():
    for first, last in (("a", "z"), ("а", "я"), ("α", "ω"), ("ء", "ي"), ("0", "9")):
        word = [chr(c) for c in range(ord(first), ord(last) + 1)]
        codes, lengths, _ = toxicity._codes(["".join(word[i : i + 10]) for i in range(0, len(word), 10)])
        found = [c for row, n in zip(codes, lengths) for c in row[:n]]
        assert len(set(found)) == len(word) and max(found) < toxicity._LETTERS


def test_fitted_scores_against_brute_force(many):
    rows = [(y, t) for _, t, y in toxic_rows(many)][:60]
    model = toxicity.train(rows)
    texts = [t for _, t in rows[:12]] + ["the on zwackel er. ein blorf. é ou", "x"]

    def margin(text):
        best = -np.inf
        for words in toxicity.sentences(text):
            size = toxicity.WINDOW
            parts = [w[at : at + size] for w in words for at in range(0, max(1, len(w) - size + 2), 2)]
            values = [max(plain_kernel(w, name) ** toxicity.POWER for w in parts if len(w) > 2) for name in model.names]
            best = max(best, float(np.dot(values, model.direction)) + model.bias)
        return best

    expected = np.array([margin(t) for t in texts])
    got = toxicity.Scorer(model).margins(texts)
    full = np.isfinite(expected)
    assert (np.isfinite(got) == full).all()
    assert np.allclose(got[full], expected[full], atol=2e-3)
    assert ((model.probability(got) >= 0.5) == (model.probability(expected) >= 0.5)).all()


def test_toxicity_of_odd_rows(spark, docs_of, odd):
    labels = "doc_id long, quality int, toxic int"
    for rows in ([], [(1, 1, None), (None, 0, 1)], [(4, 1, 1), (4, 1, 0), (5, 0, 0), (77, 0, 1)]):
        got = toxicity.learn_and_score(docs_of(odd), spark.createDataFrame(rows, labels)).collect()
        assert len(got) == len(odd) and all(0 <= r.score <= 1 for r in got)
    assert toxicity.learn_and_score(docs_of([]), spark.createDataFrame([], labels)).count() == 0


# licences


@pytest.fixture(scope="module")
def scanner(many):
    return licenses.train([t for _, t, _ in many])


def test_every_template_is_found(scanner):
    for family, texts in licenses.TEMPLATES.items():
        found = licenses.scan_texts([f"first line\n{t}\nlast" for t in texts], scanner)
        assert [{f[1] for f in rows} for rows in found] == [{family}] * len(texts)
        assert all(f[0] == 1 and f[2] >= licenses.SURE and f[3] >= licenses.OVERLAP for rows in found for f in rows)


def test_altered_notices_and_texts_about_licences(scanner):
    notice = "our tool is Released  under the MIT-License, enjoy", "Licensed under the Apache License 2.0"
    assert [r[0][1] for r in licenses.scan_texts([notice[1]], scanner)] == ["apache-2.0"]
    assert licenses.scan_texts(list(licenses.ABOUT_LICENCES), scanner) == [[]] * len(licenses.ABOUT_LICENCES)
    long = "word " * 3000 + licenses.TEMPLATES["mit"][1] + " word" * 3000
    assert [f[1] for f in licenses.scan_texts([long], scanner)[0]] == ["mit"]


def test_licences_of_odd_rows(docs_of, odd):
    pairs = odd + [(50, "a\nReleased under the MIT License.\nb")]
    got = licenses.learn_and_scan(docs_of(pairs)).collect()
    assert len(got) == len(pairs)
    assert [(r.doc_id, [(f.line, f.family) for f in r.findings]) for r in got if r.findings] == [(50, [(1, "mit")])]
    assert {r.n_lines for r in got if r.doc_id in (1, 2)} == {1}
    assert licenses.learn_and_scan(docs_of([])).count() == 0


def test_wrapped_notices_are_one_finding(scanner):
    import textwrap

    for family, texts in licenses.TEMPLATES.items():
        for text in texts:
            for width in (20, 40, 72):
                wrapped = "\n".join(" * " + x for x in textwrap.wrap(text, width, break_long_words=False, break_on_hyphens=False))
                rows = licenses.scan_texts([f"some words before it\n\n{wrapped}\n\nand words behind"], scanner)[0]
                assert [(f[0], f[1], f[4]) for f in rows] == [(2, family, 2 + wrapped.count("\n"))], (text, width, rows)
    assert [f[:2] for f in licenses.scan_texts(["Released under the\nMIT License."], scanner)[0]] == [(0, "mit")]
    assert licenses.scan_texts(["Released under the\n\nMIT License."], scanner) == [[]]


def test_hyphens_and_repeated_notices(scanner):
    notice = "our tool is Released  under the MIT-License, enjoy"
    assert [f[1] for f in licenses.scan_texts([notice], scanner)[0]] == ["mit"]
    twice = "Released under\nthe MIT License.\nReleased under\nthe MIT License."
    assert [(f[0], f[1], f[4]) for f in licenses.scan_texts([twice], scanner)[0]] == [(0, "mit", 1), (2, "mit", 3)]
    prose = "one of the long lines of plain words\n" * 30
    amid = prose + "Released under the\nMIT License.\n" + prose
    assert [(f[0], f[1], f[4]) for f in licenses.scan_texts([amid], scanner)[0]] == [(30, "mit", 31)]


#: Notices as people write them, none of them a template; the last ones are of no family.
WRITTEN = (
    ("agpl", "This service is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the FSF, version 3."),
    ("agpl", "You should have received a copy of the GNU Affero General Public License along with Foo. If not, see <https://www.gnu.org/licenses/>."),
    ("gpl", "Foo is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version."),
    ("gpl", "The tool is distributed under the GNU General Public License, version 3."),
    ("lgpl", "This package is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License."),
    ("cc-by", "Except where noted, this article is licensed under a Creative Commons Attribution 4.0 International License."),
    ("cc-by-sa", "This article is licensed under the Creative Commons Attribution-ShareAlike 3.0 License."),
    ("cc-by-nd", "These pictures are licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License."),
    ("cc-by-nc", "Our slides are licensed under the Creative Commons Attribution-NonCommercial License."),
    ("cc-by-nc-sa", "Text licensed under CC BY-NC-SA 4.0 by the authors."),
    ("cc-by-nc-nd", "The book is licensed under a Creative Commons Attribution-NonCommercial-NoDerivs 3.0 Unported License."),
    ("isc", "Permission to use, copy, modify, and distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("zlib", "This software is provided 'as-is', without any express or implied warranty. In no event will the author be held liable for any damages arising from the use of this software."),
    ("bsd", "Neither the name of Foo nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."),
    ("bsd", "Redistribution and use of this software in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"),
    ("boost", "Distributed under the Boost Software License, Version 1.0. (See accompanying file LICENSE_1_0.txt)"),
    ("epl", "This program and the accompanying materials are made available under the terms of the Eclipse Public License v1.0, which is available on the web."),
    ("cc0", "To the extent possible under law, Jane Doe has waived all copyright and related or neighboring rights to this package."),
    ("unlicense", "This is free and unencumbered software released into the public domain by its author."),
    ("mpl-2.0", "This file is subject to the terms of the Mozilla Public License, v. 2.0. You can obtain one at http://mozilla.org/MPL/2.0/."),
    ("mit", "This project is licensed under the MIT License - see the file for details."),
    ("apache-2.0", "This project is licensed under the Apache License, Version 2.0, see LICENSE"),
    (None, "Licensed under the Elastic License 2.0."),
    (None, "Licensed under the European Union Public Licence, version 1.2."),
    (None, "Copyright 2019 Foo Inc. All rights reserved. This software may not be redistributed without permission."),
    (None, "Licensed under the Business Source License 1.1; commercial production use requires a license from the vendor."),
    (None, "Many lawyers have written about the GNU General Public License and about Creative Commons."),
)


def families_of(text, scanner):
    return [f[1] for f in licenses.scan_texts([f"some text before\n\n{text}\n\nand after"], scanner)[0]]


def test_accuracy_on_notices_as_written(scanner):
    found = [(family, families_of(text, scanner)) for family, text in WRITTEN]
    wrong = [x for x in found if x[1] != ([x[0]] if x[0] else [])]
    assert len(wrong) <= 0.1 * len(WRITTEN), wrong
    # A related licence that grants less is never read as one that grants more.
    assert all(got in ([], [family]) for family, got in found), wrong


def test_ids_are_read_as_ids(scanner):
    ids = {"AGPL-3.0-or-later": "agpl", "GPL-2.0-only": "gpl", "LGPL-3.0-or-later": "lgpl", "BSD-2-Clause": "bsd", "ISC": "isc"}
    ids |= {"CC-BY-SA-4.0": "cc-by-sa", "CC-BY-ND-4.0": "cc-by-nd", "CC-BY-NC-ND-3.0": "cc-by-nc-nd", "Unlicense": "unlicense"}
    for name, family in ids.items():
        rows = licenses.scan_texts([f"# SPDX-License-Identifier: {name}\nimport this"], scanner)[0]
        assert [f[1] for f in rows] == [family], name
        number = name.split("-")[-1 if family.startswith("cc") else 1] if "." in name else None
        assert rows[0][5] == number
    assert licenses.scan_texts(["SPDX-License-Identifier: Elastic-2.0"], scanner) == [[]]


def test_texts_of_other_licences_are_unknown(scanner):
    assert licenses.scan_texts(list(licenses.FOREIGN), scanner) == [[]] * len(licenses.FOREIGN)
    notice = "This work is licensed under a Creative Commons Attribution-{} 4.0 International License."
    assert families_of(notice.format("Sampling-ShareAlike"), scanner) in ([], ["cc-by-sa"])
    assert "cc-by" not in families_of(notice.format("Share-Alike"), scanner)


def test_versions():
    assert licenses.version("version 3 of the license".split()) == "3.0"
    assert licenses.version(["spdx-license-identifier", "lgpl-2.1-only"]) == "2.1"
    assert licenses.version(["eclipse", "public", "license", "v2.0"]) == "2.0"
    assert licenses.version(["year", "2024", "mp3"]) is None


def test_overlap_against_brute_force(scanner):
    rng = random.Random(4)
    for family, texts in licenses.TEMPLATES.items():
        for text in texts:
            found = [w for w in licenses.words(text) if rng.random() < 0.8] + ["end"]
            here = {(found[i], found[i + 1]) for i in range(len(found) - 1)}
            shares = []
            for own in map(licenses.words, texts):
                pairs = {(own[i], own[i + 1]) for i in range(len(own) - 1)}
                common = sum(p in pairs for p in here)
                shares.append(common / max(min(len(pairs), len(here)), min(4, len(pairs)), 1))
            assert scanner.overlap(family, found) == pytest.approx(max(shares))


def test_every_language_is_learned(spark):
    from flowlens.llm import langid

    rows = [(70 * d + n, " ".join(f"{chr(97 + n % 26)}{chr(97 + n // 26)}{w}q{w}" for w in ("ab", "cd", "ef")), f"l{n:02}") for n in range(70) for d in range(1 + (n < 66))]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    drawn = langid.sample(docs)
    assert sorted(drawn) == sorted((lang, text) for _, text, lang in rows)
    model = langid.train(sorted(drawn), rounds=10)
    assert [x for x, _ in langid.Tagger(model).label([t for _, t, _ in rows])] == [lang for _, _, lang in rows]


def test_training_in_parts_and_many_languages_give_the_same(monkeypatch):
    import numpy as np

    from flowlens.llm import langid

    rows = [(f"l{n}", " ".join(f"w{n}x{d}{i}" for i in range(40))) for n in range(3) for d in "abc"]
    whole = langid.train(rows, rounds=5)
    monkeypatch.setattr(langid, "TRAINING_CELLS", 150)
    monkeypatch.setattr(langid, "FEW_LANGUAGES", 2)
    parts = langid.train(rows, rounds=5)
    assert np.allclose(whole.weights, parts.weights, atol=1e-5) and np.allclose(whole.transitions, parts.transitions)
    assert np.allclose(whole.prior, parts.prior)
