"""Licence scans with a trained paragraph classifier.

Paragraphs of a document are runs of lines with words; the words of their lines are joined, so a
wrapped notice is read as one. Three kinds of pieces are classified by sparse word 1- and 2-gram
multinomial logistic regression into licence families and *unknown*: single lines, windows of
``WINDOW_WORDS`` words of longer lines and of whole paragraphs, and the stretches in which the word
pairs of a template follow each other. The model is trained on notice templates, cut and altered by
rule, against a bounded sample of ordinary lines of the corpus and of texts about licences that grant
none. Probabilities are calibrated by a temperature fitted on held-back examples; a piece that is not
surely of one family stays unknown. A finding counts when the word sequence of the best template of
its family confirms it, and when the words that tell related licences apart (Affero, Lesser,
NonCommercial, ShareAlike, NoDerivatives) are just those of the family. Of overlapping findings the one with most words of a template stays: a
finding is a notice, with its first and last line, and its version where the family has several.

Training runs on the driver over at most ``SAMPLE_LINES`` lines. Scanning reads whole texts and
needs no shuffle: word n-grams that no template has do not change a score, so a paragraph costs one
look-up per word. Hyphens part a word that no template has (``MIT-License``).

Defined cases: null and empty texts have one empty line and no finding; repeated rows are scanned
one by one; an empty table trains on the templates alone; other columns are never read.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowlens.llm.chunks import text_blocks

SAMPLE_LINES = 2000
WINDOW_WORDS, WINDOW_STEP = 48, 24
#: A finding needs this calibrated probability and this share of its words in template order.
SURE, OVERLAP = 0.7, 0.6
#: Words between neighbouring word pairs of a template in one stretch: little and much altered notices.
GAPS = (2, 8)
#: Pairs of a long template that are as good as all of a short one.
STRETCH_PAIRS = 12
BLOCK_CHARS = 2_000_000
UNKNOWN = "unknown"
#: Usual notices of public licences.
TEMPLATES: dict[str, tuple[str, ...]] = {
    "apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
        "compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is "
        "distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
        "SPDX-License-Identifier: Apache-2.0",
    ),
    "bsd": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
        "that the following conditions are met",
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the "
        "following disclaimer.",
        "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
        "Released under the BSD License.",
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
        "products derived from this software without specific prior written permission.",
        "SPDX-License-Identifier: BSD-3-Clause",
        "SPDX-License-Identifier: BSD-2-Clause",
    ),
    "boost": (
        "Distributed under the Boost Software License, Version 1.0.",
        "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software "
        "and accompanying documentation covered by this license (the \"Software\") to use, reproduce, display, "
        "distribute, execute, and transmit the Software",
        "SPDX-License-Identifier: BSL-1.0",
    ),
    "cc0": (
        "To the extent possible under law, the author has waived all copyright and related or neighboring rights to "
        "this work.",
        "This work is dedicated to the public domain under the CC0 1.0 Universal Public Domain Dedication.",
        "https://creativecommons.org/publicdomain/zero/1.0/",
        "SPDX-License-Identifier: CC0-1.0",
    ),
    "epl": (
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License "
        "v2.0 which accompanies this distribution.",
        "Licensed under the Eclipse Public License, version 2.0.",
        "SPDX-License-Identifier: EPL-2.0",
        "SPDX-License-Identifier: EPL-1.0",
    ),
    "gpl": (
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version.",
        "You should have received a copy of the GNU General Public License along with this program.",
        "Licensed under the GNU GPL, version 2 or later.",
    ),
    "agpl": (
        "This work is licensed under the GNU Affero General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero "
        "General Public License as published by the Free Software Foundation, either version 3 of the License, or (at "
        "your option) any later version.",
        "You should have received a copy of the GNU Affero General Public License along with this program.",
        "Licensed under the GNU AGPL, version 3 or later.",
    ),
    "lgpl": (
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser "
        "General Public License as published by the Free Software Foundation.",
        "Licensed under the GNU Lesser General Public License, version 2.1.",
        "You should have received a copy of the GNU Lesser General Public License along with this library.",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Library "
        "General Public License as published by the Free Software Foundation.",
        "Licensed under the GNU LGPL, version 2.1 or later.",
    ),
    "isc": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies.",
        "Released under the ISC License.",
        "SPDX-License-Identifier: ISC",
    ),
    "mit": (
        "Released under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without "
        "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of "
        "the Software",
        "Licensed under the MIT License. See LICENSE in the project root for license information.",
        "SPDX-License-Identifier: MIT",
    ),
    "mpl-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was "
        "not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
        "SPDX-License-Identifier: MPL-2.0",
    ),
    "unlicense": (
        "This is free and unencumbered software released into the public domain.",
        "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code "
        "form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.",
        "SPDX-License-Identifier: Unlicense",
    ),
    "zlib": (
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held "
        "liable for any damages arising from the use of this software.",
        "Permission is granted to anyone to use this software for any purpose, including commercial applications, and to "
        "alter it and redistribute it freely, subject to the following restrictions",
        "SPDX-License-Identifier: Zlib",
    ),
}
#: What Creative Commons licences are put together from, and versions that occur.
CC_PARTS = {"by": "Attribution", "nc": "NonCommercial", "sa": "ShareAlike", "nd": "NoDerivatives"}
CC_KINDS = ("by", "by-sa", "by-nd", "by-nc", "by-nc-sa", "by-nc-nd")
CC_VERSIONS = ("3.0", "4.0")
GNU_NAMES = {"gpl": "General", "lgpl": "Lesser General", "agpl": "Affero General"}
GNU_VERSIONS = {"gpl": ("2.0", "3.0"), "lgpl": ("2.0", "2.1", "3.0"), "agpl": ("3.0",)}


def _families() -> dict[str, tuple[str, ...]]:
    """``TEMPLATES`` above with what follows from the rules of names."""
    found = dict(TEMPLATES)
    for family, versions in GNU_VERSIONS.items():
        number = versions[0].removesuffix(".0")
        found[family] += (f"This program is distributed under the GNU {GNU_NAMES[family]} Public License, version {number}.",)
        ids = [f"{family.upper()}-{v}-{more}" for v in versions for more in ("only", "or-later")]
        found[family] += tuple(f"SPDX-License-Identifier: {name}" for name in ids)
    for kind in CC_KINDS:
        name = "-".join(CC_PARTS[part] for part in kind.split("-"))
        texts = [
            f"This work is licensed under a Creative Commons {name} 4.0 International License.",
            f"This work is licensed under the Creative Commons {name} License.",
            f"Licensed under CC {kind.upper()} 4.0.",
            f"https://creativecommons.org/licenses/{kind}/4.0/",
        ]
        older = name.replace("NoDerivatives", "NoDerivs")
        texts.append(f"This work is licensed under a Creative Commons {older} 3.0 Unported License.")
        if kind != "by":  # written with blanks
            spaced = re.sub("(?<=[a-z])(?=[A-Z])|-", " ", name)
            texts.append(f"This work is licensed under a Creative Commons {spaced} 4.0 International License.")
        ids = [f"CC-{kind.upper()}-{v}" for v in CC_VERSIONS]
        found[f"cc-{kind}"] = (*texts, *(f"SPDX-License-Identifier: {name}" for name in ids))
    return found


TEMPLATES = _families()
#: Words that tell related families apart, by what they stand for.
TELLING = {
    "affero": "affero", "agpl": "affero", "lesser": "lesser", "lgpl": "lesser", "librarygeneral": "lesser",
    "nc": "nc", "noncommercial": "nc", "sa": "sa", "sharealike": "sa", "nd": "nd", "noderivatives": "nd", "noderivs": "nd",
}
#: Words before and behind a piece that may tell its family.
TELLING_REACH = 2, 4
VERSIONED = {*GNU_VERSIONS, *(f"cc-{kind}" for kind in CC_KINDS), "epl"}
_VERSION = re.compile(r"(?:^|-)v?(\d(?:\.\d)?)(?:-|$)")
#: Texts that use the same words and grant nothing.
ABOUT_LICENCES = (
    "the driver showed a license and the officer wrote down the version of events",
    "software is distributed to the public by mail and modified by the reader",
    "permission to enter the building is granted by the general manager free of charge",
    "public work on the library was released under the new foundation",
    "the apache tribe and the university signed an agreement in writing",
    "see the license plate at the source of the road without conditions",
    "the license of the shop was not renewed this year",
    "a copy of the book can be obtained from the publisher",
    "version 2.0 of the program adds a source code form and a file list",
    "he was permitted to sell copies of the general public work",
    "any person may use the file in the project root",
    "all rights reserved by the author of this work",
)
#: Texts of other licences, which are of no family.
FOREIGN = (
    "all rights reserved no part of this publication may be reproduced or distributed in any form without the prior "
    "written permission of the publisher",
    "permission is granted to copy distribute and or modify this document under the terms of the GNU Free Documentation "
    "License version 1.3 or any later version published by the Free Software Foundation",
    "this software is licensed under a commercial agreement and may not be copied or modified without written consent",
    "licensed under the Business Source License version 1.1",
    "this program is available under the Server Side Public License version 1 as published by the company",
    "you may use this file for personal and educational purposes only commercial use requires a separate license",
    "this work is protected by copyright and may not be distributed or sold without permission",
    "released under a proprietary license",
    "licensed under the terms of your agreement with the vendor",
)
_WORD = re.compile(r"[a-z0-9]+(?:[.\-][a-z0-9]+)*")


def words(line: str) -> list[str]:
    return _WORD.findall(line.lower())


def windows(line: str) -> list[list[str]]:
    found = words(line)
    if len(found) <= WINDOW_WORDS:
        return [found]
    return [found[low:high] for low, high in spans(0, len(found))]


def spans(low: int, high: int) -> list[tuple[int, int]]:
    """The places of the windows of the words from ``low`` to ``high``."""
    if high - low <= WINDOW_WORDS:
        return [(low, high)]
    return [(at, min(high, at + WINDOW_WORDS)) for at in range(low, high - WINDOW_STEP, WINDOW_STEP)]


def grams(found: list[str]) -> list[str]:
    return found + [f"{a} {b}" for a, b in zip(found, found[1:])]


def telling(found: list[str]) -> set[str]:
    """What the words say of related families."""
    parts = [part for w in found for part in w.split("-")]
    both = map("".join, zip(parts, parts[1:]))
    return {TELLING[w] for w in (*parts, *both) if w in TELLING}


def _family_tells(family: str) -> set[str] | None:
    """What a text of the family has to say; None if it is like no other."""
    if family in GNU_VERSIONS or family.startswith("cc-"):
        return set().union(*(telling(words(text)) for text in TEMPLATES[family]))
    return None


def version(found: list[str]) -> str | None:
    """The first version number among the words."""
    numbers = (m[1] for w in found if (m := _VERSION.search(w)))
    number = next(numbers, None)
    return number if number is None or "." in number else f"{number}.0"


def _examples() -> list[tuple[str, list[str]]]:
    """Templates, long ones also in pieces, and versions with words left out or added.

    A piece of which each n-gram occurs in another family too says nothing of its own and is no example.
    """
    found = []
    owners: dict[str, set[str]] = {}
    for family, texts in TEMPLATES.items():
        for text in texts:
            for g in grams(words(text)):
                owners.setdefault(g, set()).add(family)
    for family, texts in TEMPLATES.items():
        for text in texts:
            whole = words(text)
            pieces = [whole] + [whole[at : at + 14] for at in range(0, max(0, len(whole) - 8), 5) if len(whole) > 14]
            for piece in pieces:
                if piece is not whole and all(len(owners[g]) > 1 for g in grams(piece)):
                    continue
                found.append((family, piece))
                for seed in range(4):
                    drop = crc32(f"{seed} {' '.join(piece)}".encode()) % max(1, len(piece))
                    found.append((family, piece[:drop] + piece[drop + 1 :] if len(piece) > 6 else piece))
                    found.append((family, ["this", "file", "is"] + piece if seed % 2 else piece + ["all", "rights", "reserved"]))
    return found


@dataclass
class Model:
    families: list[str]
    number: dict[str, int]
    weights: np.ndarray  # one row per n-gram
    bias: np.ndarray
    temperature: float
    orders: dict[str, list[tuple[list[str], set[tuple[str, str]]]]]

    def probabilities(self, scores: np.ndarray) -> np.ndarray:
        z = scores / self.temperature
        z = np.exp(z - z.max(axis=1, keepdims=True))
        return z / z.sum(axis=1, keepdims=True)

    def overlap(self, family: str, found: list[str]) -> float:
        """Largest share, over the family's templates, of neighbouring words in common.

        Measured against the shorter of text and template, but at least four pairs.
        """
        pairs = set(zip(found, found[1:]))
        best = 0.0
        for _, own in self.orders[family]:
            best = max(best, len(pairs & own) / max(min(len(own), len(pairs)), min(4, len(own)), 1))
        return best


def _matrix(texts: list[list[str]], number: dict[str, int]) -> np.ndarray:
    x = np.zeros((len(texts), len(number)), np.float32)
    for row, found in enumerate(texts):
        known = {number[g] for g in grams(found) if g in number}
        x[row, list(known)] = 1 / np.sqrt(max(1, len(found)))
    return x


def train(ordinary: list[str], rounds: int = 300, decay: float = 3e-4) -> Model:
    examples = _examples()
    negative = [(UNKNOWN, w) for line in (*ABOUT_LICENCES, *FOREIGN, *ordinary) for w in windows(line)[:1]]
    families = [UNKNOWN, *sorted(TEMPLATES)]
    number = {g: i for i, g in enumerate(sorted({g for _, found in examples for g in grams(found)}))}
    rows = examples + negative + [(UNKNOWN, [])]
    held = np.array([crc32(" ".join(found).encode()) % 5 == 0 for _, found in rows])
    x, y = _matrix([found for _, found in rows], number), np.array([families.index(f) for f, _ in rows])
    weight = 1 / np.bincount(y, minlength=len(families))[y]
    weight[y == 0] *= 2
    truth = np.eye(len(families), dtype=np.float32)[y]

    def fit(use: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        w, b = np.zeros((len(number), len(families)), np.float32), np.zeros(len(families), np.float32)
        speed_w, speed_b = np.zeros_like(w), np.zeros_like(b)
        learned, goal, share = x[use], truth[use], (weight[use] / weight[use].sum())[:, None].astype(np.float32)
        for _ in range(rounds):
            z = learned @ w + b
            z = np.exp(z - z.max(axis=1, keepdims=True))
            wrong = (goal - z / z.sum(axis=1, keepdims=True)) * share
            speed_w = 0.9 * speed_w + learned.T @ wrong - np.float32(decay) * w
            speed_b = 0.9 * speed_b + wrong.sum(axis=0)
            w, b = w + 6 * speed_w, b + 2 * speed_b
        return w, b

    # Calibrated on examples that the first fit has not seen; the model itself learns from all.
    w, b = fit(~held)
    scores = x[held] @ w + b

    def loss(t):
        z = scores / t
        z = z - z.max(axis=1, keepdims=True)
        logs = z - np.log(np.exp(z).sum(axis=1, keepdims=True))
        return -(logs[np.arange(len(z)), y[held]] * weight[held]).sum()

    temperature = min((0.25, 0.35, 0.5, 0.7, 1.0, 1.4, 2.0, 3.0), key=loss) if held.any() else 1.0
    w, b = fit(np.ones(len(rows), bool))
    orders = {f: [(t, set(zip(t, t[1:]))) for t in map(words, texts)] for f, texts in TEMPLATES.items()}
    return Model(families, number, w, b, temperature, orders)


def paragraphs(text: str, known: dict[str, int]) -> Iterator[tuple[list[str], list[int]]]:
    """Words of each run of lines that have words, and the line of each word."""
    found, lines = [], []
    for line, content in enumerate(text.split("\n")):
        here = words(content)
        if "-" in content and any("-" in w and w not in known for w in here):
            here = [part for w in here for part in ([w] if w in known else w.split("-"))]
        if here:
            found += here
            lines += [line] * len(here)
        elif found:
            yield found, lines
            found, lines = [], []
    if found:
        yield found, lines


def _least(own: set[tuple[str, str]]) -> int:
    """Fewest word pairs of a template that can confirm a finding."""
    return math.ceil(OVERLAP * min(4, len(own)))


class Finder:
    """Pieces of a paragraph that may be confirmed, by the word pairs of the templates."""

    def __init__(self, model: Model):
        self.own = [own for orders in model.orders.values() for _, own in orders]
        self.templates: dict[tuple[str, str], list[int]] = {}
        for number, own in enumerate(self.own):
            for pair in own:
                self.templates.setdefault(pair, []).append(number)
        self.least = list(map(_least, self.own))
        # Word pairs of templates that fewer than three pairs confirm.
        self.short = {pair for own, n in zip(self.own, self.least) if n < 3 for pair in own}

    def stretches(self, found: list[str], at: list[int], number: int) -> Iterator[tuple[int, int]]:
        """Where most of a template stands, or of a long one most of ``STRETCH_PAIRS`` pairs.

        Once through repeated notices, once from one to the next.
        """
        own = self.own[number]
        least = math.ceil(OVERLAP * min(STRETCH_PAIRS, len(own)))
        for gap, restart in ((gap, restart) for gap in GAPS for restart in (False, True)):
            start, seen, last = at[0], set(), at[0]
            for i in [*at, None]:
                pair = None if i is None else (found[i], found[i + 1])
                again = restart and i != start and pair == (found[start], found[start + 1])
                if i is None or i - last > gap + 1 or again:
                    share = len(seen) / max(min(len(own), last + 1 - start), min(4, len(own)), 1)
                    if len(seen) >= least and share >= OVERLAP:
                        yield start, last + 2
                    start, seen = i, set()
                seen.add(pair)
                last = i

    def pieces(self, found: list[str], lines: list[int]) -> set[tuple[int, int]]:
        hits = [i for i, pair in enumerate(zip(found, found[1:])) if pair in self.templates]
        short = [i for i in hits if (found[i], found[i + 1]) in self.short]
        if len(hits) < 3 and not short:
            return set()

        def enough(low: int, high: int) -> bool:
            """Whether three pairs, or one of a short template, lie in the piece."""
            inside = bisect_left(hits, high - 1) - bisect_left(hits, low)
            return inside >= 3 or bisect_left(short, high - 1) > bisect_left(short, low)

        ends = [i for i in range(1, len(lines)) if lines[i] != lines[i - 1]]
        ranges = [*zip([0, *ends], [*ends, len(lines)]), (0, len(lines))]
        taken = {span for low, high in ranges if enough(low, high) for span in spans(low, high) if enough(*span)}
        places: dict[int, list[int]] = {}
        for i in hits:
            for number in self.templates[found[i], found[i + 1]]:
                places.setdefault(number, []).append(i)
        for number, at in places.items():
            if len(at) >= self.least[number]:
                taken.update(self.stretches(found, at, number))
        return taken


def _notices(found: list[tuple[int, int, int, str, float, float]]) -> list[tuple[int, int, int, str, float, float]]:
    """Of overlapping findings (pairs, start, end, family, ...) the one with most pairs, then the shortest.

    Findings of two families overlap if one lies by half in the other.
    """
    kept: list[tuple[int, int, int, str, float, float]] = []
    for f in sorted(set(found), key=lambda f: (-f[0], f[2] - f[1], f[1], f[3])):
        shared = [(min(f[2], k[2]) - max(f[1], k[1]), k[3]) for k in kept]
        if not any(n > 0 and (family == f[3] or 2 * n >= f[2] - f[1]) for n, family in shared):
            kept.append(f)
    return kept


def scan_texts(texts: list[str], model: Model) -> list[list[tuple[int, str, float, float, int, str | None]]]:
    """(first line, family, probability, overlap, last line, version) of the notices of each text."""
    result: list[list[tuple[int, str, float, float, int, str | None]]] = [[] for _ in texts]
    tells = {family: _family_tells(family) for family in TEMPLATES}
    finder, get = Finder(model), model.number.get
    family_pairs = {f: set().union(*(own for _, own in orders)) for f, orders in model.orders.items()}
    repeats = {f: [Counter(zip(t, t[1:])) for t, _ in orders] for f, orders in model.orders.items()}
    for row, text in enumerate(texts):
        for found, lines in paragraphs(text.lower(), model.number):
            places = sorted(finder.pieces(found, lines))
            confirmed = []
            for at in range(0, len(places), 4096):
                part = [found[low:high] for low, high in places[at : at + 4096]]
                scores = np.tile(model.bias.astype(np.float64), (len(part), 1))
                for i, piece in enumerate(part):
                    known = {n for g in grams(piece) if (n := get(g)) is not None}
                    scores[i] += model.weights[list(known)].sum(axis=0) / np.sqrt(max(1, len(piece)))
                for i, p in enumerate(model.probabilities(scores)):
                    best = int(p.argmax())
                    family = model.families[best]
                    if family == UNKNOWN or p[best] < SURE:
                        continue
                    share = model.overlap(family, part[i])
                    low, high = places[at + i]
                    around = found[max(0, low - TELLING_REACH[0]) : high + TELLING_REACH[1]]
                    if share >= OVERLAP and (tells[family] is None or telling(around) == tells[family]):
                        pairs = list(zip(part[i], part[i][1:]))
                        inside = [j for j, pair in enumerate(pairs) if pair in family_pairs[family]]
                        start = places[at + i][0]
                        here = Counter(pairs)
                        most = max((here & own).total() for own in repeats[family])
                        confirmed.append((most, start + inside[0], start + inside[-1] + 2, family, float(p[best]), share))
            for _, start, end, family, p, share in _notices(confirmed):
                number = version(found[start : end + TELLING_REACH[1]]) if family in VERSIONED else None
                result[row].append((lines[start], family, p, share, lines[end - 1], number))
        result[row].sort(key=lambda f: (*f[:5], f[5] or ""))
    return result


def sample_lines(docs: DataFrame, most: int = SAMPLE_LINES) -> list[str]:
    """Ordinary lines: one line each, by a hash, of at most ``most`` documents; none that names a licence."""
    lines = F.filter(F.split("text", "\n"), lambda x: (F.length(x) > 0) & ~F.lower(x).rlike("licen[sc]e|copyright|spdx|permission"))
    order = F.xxhash64("doc_id")
    texts = docs.where("text IS NOT NULL AND doc_id IS NOT NULL").select("doc_id", "text")
    # Only ids are ordered; at most ``most`` of them are broadcast.
    drawn = texts.select("doc_id").orderBy(order, "doc_id").limit(most).distinct()
    picked = texts.join(F.broadcast(drawn), "doc_id").select(
        F.get(lines, F.pmod(order, F.greatest(F.size(lines), F.lit(1))).cast("int")).alias("line")
    )
    return sorted(r["line"] for r in picked.where("line IS NOT NULL").limit(most).collect())


_FINDINGS = pa.list_(
    pa.struct([("line", pa.int64()), ("family", pa.string()), ("probability", pa.float64()), ("overlap", pa.float64()), ("last_line", pa.int64()), ("version", pa.string())])
)


def scan(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id``, ``n_lines`` and ``findings`` (line, family, probability, overlap, last_line, version) of every document."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, texts in text_blocks(batches, BLOCK_CHARS):
            found = [
                [
                    {"line": line, "family": f, "probability": p, "overlap": o, "last_line": last, "version": v}
                    for line, f, p, o, last, v in rows
                ]
                for rows in scan_texts(texts, shared.value)
            ]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(ids, pa.int64()),
                    pa.array([t.count("\n") + 1 for t in texts], pa.int64()),
                    pa.array(found, _FINDINGS),
                ],
                ["doc_id", "n_lines", "findings"],
            )

    schema = (
        "doc_id long, n_lines long, "
        "findings array<struct<line:long,family:string,probability:double,overlap:double,last_line:long,version:string>>"
    )
    return docs.select("doc_id", "text").mapInArrow(run, schema)


def learn_and_scan(docs: DataFrame) -> DataFrame:
    return scan(docs, train(sample_lines(docs)))
