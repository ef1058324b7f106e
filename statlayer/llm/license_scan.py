"""Licence scan: a paragraph classifier over word n-grams, confirmed against licence templates.

Lines of a text are its paragraphs; a line over ``WINDOW`` words is read in half-overlapping windows, so
whole texts are covered. A sparse multinomial logistic regression over hashed 1- to 3-grams of words names
the licence family or ``unknown`` (everything that is no licence notice of a family known here, notices of other
licences among it). A family of probability ``LEAST_PROBABILITY`` is found; its template comparison, the share of
word pairs in common, measured on the shorter of the two texts, must reach ``CONFIRM`` to confirm it. In windows that
are not surely unknown (``DOUBT``) the other families of probability ``SECOND`` are compared too, and those found whose
templates confirm them: a notice of two licences names both.

Training set: windows cut from the templates, with dropped words and strange words around them, and as
``unknown`` a bounded hash-chosen sample of the corpus' own paragraphs (about ``SAMPLE_PARAGRAPHS``) that
share few word pairs with any template, notices of licences that are not known here, and shuffled template words. A
fifth is kept aside to calibrate the probabilities by one temperature.

Defined results: null and empty texts have no paragraph; very long lines are read window by window; repeated rows
report each; of windows of a line that tie the first is reported; an empty table gives an empty result. Extra columns
are ignored.
"""
from __future__ import annotations

import re
import zlib

import numpy as np
from pyspark.sql import DataFrame, functions as F

from .common import share, slices, strings

BITS = 15
WINDOW, STEP = 20, 10
ORDERS = 3
SAMPLE_PARAGRAPHS = 1600
LEAST_PROBABILITY, CONFIRM = 0.5, 0.7
DOUBT, SECOND = 0.05, 0.01
CACHE_WORDS = 1 << 19
SLICE = 1 << 19
UNKNOWN = "unknown"
find_words = re.compile(r"[^\W_]+").findall

# Notices of the licence families, as their publishers word them: fixed values.
TEMPLATES = {
    "MIT": (
        "Released under the MIT License.",
        "SPDX-License-Identifier: MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the Software), to deal in the Software without restriction, including without limitation the "
        "rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software.",
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    ),
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        "SPDX-License-Identifier: Apache-2.0",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License.",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "
        "AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
    ),
    "GPL-3.0": (
        "This work is licensed under the GNU General Public License, version 3.",
        "Distributed under the GNU GPL v3",
        "SPDX-License-Identifier: GPL-3.0-or-later",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation, either version 3 of the License, or any later version.",
    ),
    "GPL-2.0": (
        "This work is licensed under the GNU General Public License, version 2.",
        "SPDX-License-Identifier: GPL-2.0-only",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License version 2 as published by the Free Software Foundation.",
    ),
    "LGPL-3.0": (
        "This library is licensed under the GNU Lesser General Public License, version 3.",
        "SPDX-License-Identifier: LGPL-3.0-or-later",
    ),
    "AGPL-3.0": (
        "This work is licensed under the GNU Affero General Public License, version 3.",
        "SPDX-License-Identifier: AGPL-3.0-only",
    ),
    "BSD-3-Clause": (
        "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
        "SPDX-License-Identifier: BSD-3-Clause",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met: Redistributions of source code must retain the above copyright notice.",
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products "
        "derived from this software without specific prior written permission.",
    ),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "SPDX-License-Identifier: MPL-2.0",
    ),
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted.",
        "Released under the ISC License.",
    ),
    "CC-BY-4.0": (
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ),
    "CC-BY-SA-4.0": (
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    ),
    "CC-BY-NC-4.0": (
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ),
    "CC0-1.0": (
        "Released under CC0 1.0 Universal.",
        "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
    ),
    "Unlicense": (
        "This is free and unencumbered software released into the public domain.",
    ),
}


# Notices of licences that are no family here, as their publishers word them: fixed values.
OTHER_NOTICES = (
    "Licensed under the Eclipse Public License 2.0",
    "This program and the accompanying materials are made available under the terms of the Eclipse Public License v2.0",
    "SPDX-License-Identifier: EPL-2.0",
    "Licensed under the EUPL, Version 1.2 or later",
    "SPDX-License-Identifier: EUPL-1.2",
    "The contents of this file are subject to the terms of the Common Development and Distribution License (the License)",
    "SPDX-License-Identifier: CDDL-1.0",
    "This software is provided under the terms of the zlib license",
    "SPDX-License-Identifier: Zlib",
    "This library is free software under the terms of the Artistic License 2.0",
    "SPDX-License-Identifier: Artistic-2.0",
    "Licensed under the Boost Software License, Version 1.0",
    "SPDX-License-Identifier: BSL-1.0",
    "Licensed under the Microsoft Public License (Ms-PL)",
    "Licensed under the Python Software Foundation License Version 2",
    "Licensed under the Server Side Public License",
    "Licensed under the Business Source License 1.1",
    "All rights reserved. Unauthorized copying of this file, via any medium is strictly prohibited. Proprietary and confidential",
    "Use of this source code is governed by the license agreement that came with it",
)


class WordHash(dict):
    """32-bit hash of a word, remembered."""

    def __missing__(self, word: str) -> int:
        value = self[word] = zlib.crc32(word.encode("utf-8", "replace"))
        return value


def paragraphs(text: str) -> list[tuple[int, list[str]]]:
    """(line number, words) of every window of every line that has a word."""
    out = []
    for n, line in enumerate(text.lower().split("\n")):
        words = find_words(line)
        if len(words) <= WINDOW:
            if words:
                out.append((n, words))
        else:
            out += [(n, words[i:i + WINDOW]) for i in range(0, len(words) - STEP, STEP)]
    return out


def word_pairs(words: list[str]) -> set:
    return set(zip(words, words[1:]))


TEMPLATE_PAIRS = {f: [word_pairs(find_words(t.lower())) for t in texts] for f, texts in TEMPLATES.items()}


def template_share(words: list[str], family: str) -> float:
    """Largest share of common word pairs with a template, measured on the shorter text."""
    own = word_pairs(words)
    return max((len(own & p) / min(len(own), len(p)) for p in TEMPLATE_PAIRS[family] if own and p), default=0.0)


def gram_slots(windows: list[list[str]], hashes: WordHash):
    """For each order the hashed n-grams of all windows and where each window starts and ends."""
    size = np.fromiter(map(len, windows), dtype=np.int64, count=len(windows))
    flat = np.fromiter((hashes[w] for ws in windows for w in ws), dtype=np.uint64, count=int(size.sum()))
    row = np.repeat(np.arange(len(windows)), size)
    value = flat.copy()
    for order in range(ORDERS):
        if order:
            n = len(flat) - order
            value = value[:n] * np.uint64(0x9E3779B97F4A7C15) + flat[order:order + n]
        same = row[:len(value)] == row[order:] if order else np.ones(len(value), dtype=bool)
        slot = ((value + np.uint64(order)) * np.uint64(0xC4CEB9FE1A85EC53) >> np.uint64(64 - BITS)).astype(np.int64)
        yield slot[same], row[:len(value)][same]


class Model:
    """Weights [slots, families]; the last family is ``unknown``."""

    def __init__(self):
        self.names = [*TEMPLATES, UNKNOWN]
        self.w = np.zeros((1 << BITS, len(self.names)), dtype=np.float32)
        self.bias = np.zeros(len(self.names), dtype=np.float32)
        self.heat = 1.0

    def logits(self, windows, hashes) -> np.ndarray:
        out = np.zeros((len(windows), len(self.names)), dtype=np.float32)
        grams = np.zeros(len(windows), dtype=np.float32)
        for slot, row in gram_slots(windows, hashes):
            if not len(row):
                continue
            start = np.flatnonzero(np.concatenate([[True], row[1:] != row[:-1]]))
            out[row[start]] += np.add.reduceat(self.w[slot], start, axis=0)
            grams += np.bincount(row, minlength=len(windows))
        return out / np.sqrt(np.maximum(grams, 1))[:, None] + self.bias

    def probabilities(self, windows, hashes) -> np.ndarray:
        e = self.logits(windows, hashes) / self.heat
        e = np.exp(e - e.max(axis=1, keepdims=True))
        return e / e.sum(axis=1, keepdims=True)

    def fit(self, windows, y: np.ndarray, steps: int = 40, rate: float = 0.5, l1: float = 2e-5) -> None:
        """Full-batch Adagrad with an L1 shrink after every step."""
        hashes = WordHash()
        parts = list(gram_slots(windows, hashes))
        slot, row = (np.concatenate([p[i] for p in parts]) for i in (0, 1))
        norm = 1 / np.sqrt(np.maximum(np.bincount(row, minlength=len(windows)), 1)).astype(np.float32)
        order = np.argsort(slot, kind="stable")
        slot, row = slot[order], row[order]
        used, start = np.unique(slot, return_index=True)
        place = np.repeat(np.arange(len(used)), np.diff(np.append(start, len(slot))))
        by_row = np.argsort(row, kind="stable")
        row_of, place_of = row[by_row], place[by_row]
        first = np.flatnonzero(np.concatenate([[True], row_of[1:] != row_of[:-1]]))
        count = np.bincount(y, minlength=len(self.names))
        weight = (len(y) / (len(self.names) * np.maximum(count, 1)))[y].astype(np.float32)[:, None]
        w, seen = np.zeros((len(used), len(self.names)), dtype=np.float32), 1e-4
        bias_seen = 1e-2
        for _ in range(steps):
            e = np.tile(self.bias, (len(windows), 1))
            e[row_of[first]] += np.add.reduceat(w[place_of], first, axis=0) * norm[row_of[first], None]
            e = np.exp(e - e.max(axis=1, keepdims=True))
            e /= e.sum(axis=1, keepdims=True)
            e[np.arange(len(y)), y] -= 1
            e *= weight / len(y)
            g = np.add.reduceat((e * norm[:, None])[row], start, axis=0)
            seen = seen + g * g
            w -= rate * g / np.sqrt(seen)
            w = np.sign(w) * np.maximum(np.abs(w) - rate * l1 / np.sqrt(seen), 0)
            gb = e.sum(axis=0)
            bias_seen = bias_seen + gb * gb
            self.bias = (self.bias - rate * gb / np.sqrt(bias_seen)).astype(np.float32)
        self.w[used] = w

    def calibrate(self, windows, y: np.ndarray) -> None:
        """The temperature of least log loss on rows that the weights have not seen."""
        z, best = self.logits(windows, WordHash()), (np.inf, 1.0)
        for heat in np.geomspace(0.1, 5, 40):
            e = np.exp((z - z.max(axis=1, keepdims=True)) / heat)
            loss = -np.log(np.maximum(e[np.arange(len(y)), y] / e.sum(axis=1), 1e-9)).mean()
            best = min(best, (loss, float(heat)))
        self.heat = best[1]


def training_set(background: list[list[str]], seed: int = 3) -> tuple[list[list[str]], np.ndarray]:
    """Windows with their family number."""
    rng = np.random.default_rng(seed)
    names = [*TEMPLATES, UNKNOWN]
    stray = sorted({w for b in background for w in b})[:20_000] or ["lorem", "ipsum"]
    out, y = [], []
    pool = [w for texts in TEMPLATES.values() for t in texts for w in find_words(t.lower())]
    for n, (family, texts) in enumerate(TEMPLATES.items()):
        for t in texts:
            words = find_words(t.lower())
            for k in range(40):
                at = int(rng.integers(0, max(1, len(words) - WINDOW + 1))) if k % 2 else 0
                part = words[at:at + WINDOW]
                if k > 4 and len(part) > 4:
                    part = [w for w in part if rng.random() > 0.06]
                extra = int(rng.integers(0, max(1, WINDOW - len(part) + 1))) if k > 8 else 0
                cut = int(rng.integers(0, extra + 1))
                noise = list(rng.choice(stray, extra)) if extra else []
                out.append([*map(str, noise[:cut]), *part, *map(str, noise[cut:])])
                y.append(n)
    for words in background:
        if all(template_share(words, f) < 0.3 for f in TEMPLATES):
            out.append(words)
            y.append(len(names) - 1)
    for notice in OTHER_NOTICES:                # other licences' notices, whole, cut and with strange words
        words = find_words(notice.lower())
        for k in range(20):
            part = [w for w in words if rng.random() > 0.05 * (k > 3)][:WINDOW]
            extra = int(rng.integers(0, max(1, WINDOW - len(part) + 1))) if k > 8 else 0
            out.append([*part, *map(str, rng.choice(stray, extra))])
            y.append(len(names) - 1)
    for _ in range(600):                        # licence words in no licence's order, and lone words
        size = int(rng.integers(1, WINDOW + 1))
        words = [str(w) for w in np.where(rng.random(size) < 0.4, rng.choice(pool, size), rng.choice(stray, size))]
        if all(template_share(words, f) < 0.5 for f in TEMPLATES):
            out.append(words)
            y.append(len(names) - 1)
    return out, np.array(y)


def sample_texts(docs: DataFrame) -> DataFrame:
    """text: at most a quarter of ``SAMPLE_PARAGRAPHS`` distinct texts, those of smallest hash among a share of all."""
    rows = docs.select(F.col("text").cast("string").alias("text")).where("text is not null and text <> ''")
    total = rows.count()
    scale, most = 1 << 30, SAMPLE_PARAGRAPHS // 4
    quota = int(scale * min(1.0, 2 * most / max(total, 1)))
    names = [F.xxhash64("text").alias("name1"), F.xxhash64(F.lit(1), "text").alias("name2")]
    return rows.select("text", *names).where(F.pmod("name1", F.lit(scale)) < quota).dropDuplicates(["name1", "name2"]) \
        .orderBy(F.pmod("name1", F.lit(scale)), "name2").limit(most).select("text")


def train(docs: DataFrame) -> Model:
    """Fit on the templates and a sample of the corpus' paragraphs."""

    def pick(batches):
        import pyarrow as pa

        for batch in batches:
            found = []
            for text in strings(batch.column("text")):
                own = paragraphs(text)
                rng = np.random.default_rng(zlib.crc32(text.encode("utf-8", "replace")))
                found += [own[i][1] for i in (rng.permutation(len(own))[:4] if own else [])]
            yield pa.RecordBatch.from_arrays([pa.array(found, type=pa.list_(pa.string()))], names=["words"])

    background = sorted(r["words"] for r in sample_texts(docs).mapInArrow(pick, "words array<string>").collect())
    windows, y = training_set(background)
    aside = np.arange(len(y)) % 5 == 0
    model = Model()
    model.fit([w for w, a in zip(windows, aside) if not a], y[~aside])
    model.calibrate([w for w, a in zip(windows, aside) if a], y[aside])
    return model


def scan(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, line, family, probability, template_share, confirmed: the best window of each line and family found."""
    rows = docs.select(F.col("doc_id").alias("id_"), F.col("text").cast("string").alias("text")).where("text is not null")
    kind = rows.schema["id_"].dataType.simpleString()
    shipped = share(docs.sparkSession, model)

    def run(batches):
        import pyarrow as pa

        model, hashes = shipped(), WordHash()
        for batch in batches:
            for part in slices(batch, "text", SLICE):
                if len(hashes) > CACHE_WORDS:
                    hashes.clear()
                ids, places, windows, lines = [], [], [], []
                for place, (i, text) in enumerate(zip(part.column("id_").to_pylist(), strings(part.column("text")))):
                    for line, words in paragraphs(text):
                        ids.append(i), places.append(place), lines.append(line), windows.append(words)
                if not windows:
                    continue
                p = model.probabilities(windows, hashes)
                best: dict = {}
                for j in np.flatnonzero(p[:, -1] <= 1 - DOUBT):
                    for f in np.flatnonzero(p[j, :-1] >= SECOND):
                        family, q = model.names[f], float(p[j, f])
                        common = template_share(windows[j], family)
                        if q >= LEAST_PROBABILITY or common >= CONFIRM:
                            key = (places[j], lines[j], family)
                            best[key] = max(best.get(key, (0.0, 0.0, None)), (common, q, j), key=lambda x: x[:2])
                found = [(ids[j], lines[j], family, q, c, c >= CONFIRM) for (_, _, family), (c, q, j) in best.items()]
                types = [batch.column("id_").type, pa.int32(), pa.string(), pa.float64(), pa.float64(), pa.bool_()]
                names = ["id_", "line", "family", "probability", "template_share", "confirmed"]
                yield pa.RecordBatch.from_arrays([pa.array([f[k] for f in found], type=t) for k, t in enumerate(types)], names=names)

    out = rows.mapInArrow(run, f"id_ {kind}, line int, family string, probability double, template_share double, confirmed boolean")
    return out.withColumnRenamed("id_", "doc_id")
