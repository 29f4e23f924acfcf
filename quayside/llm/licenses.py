"""Licence scan: a trained paragraph classifier, confirmed by template comparison.

A paragraph is a notice, on one line or wrapped over any number of them, or a line.  Sparse features are its
distinct words and pairs of neighbouring words, as far as they occur in the templates; a multinomial logistic
regression gives the chances of the licence families and of the class ``unknown``.  It is trained in numpy, on
the templates, whole, shortened and with other words around them, against lines of a bounded sample of the
corpus; the chances are calibrated by a temperature fitted to rows kept apart.

Notices are found by the templates' key words: as many of a template's least shared words as a paragraph that
has ``CONFIRMS`` of its words cannot all miss.  From a key word on, and then back to the one before, words of the
template that were not there yet are taken on, as long as at most ``GAP`` other words lie in between and the
paragraph has at most twice the template's words and ``SPREAD`` more: the same words farther apart are prose.  Line
ends do not count, but lines without a word, as blank lines or bare comment marks, end a paragraph.  What has the
template's share so is a candidate.  Of overlapping ones the first is kept, of those with the same start the one
of the longest template and then the longest one.  What is kept is classified; the prediction counts if it is likely enough and the paragraph
has ``CONFIRMS`` of the words of one of the predicted family's templates.
Lines outside of notices that have a word which templates do not share with ordinary prose are classified
too, and given out as ``unknown``.

Scanning uses DataFrame functions alone and does not shuffle; a text's rows are made from its words in place,
in time linear in its length, and no row carries more than its own paragraph.

Defined results: one row for each notice, and for each other line that is scored; null and empty texts give
none, nor does an empty table; repeated rows give repeated rows; of equal chances the first family in alphabetical
order is taken.  Long texts are scanned whole.  Only the named columns are read.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside.llm.common import bounded

#: The wording of public licence notices.
TEMPLATES: dict[str, tuple[str, ...]] = {
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License.',
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
        "SPDX-License-Identifier: Apache-2.0",
    ),
    "AGPL-3.0": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
        "This work is licensed under the GNU Affero General Public License, version 3.",
        "SPDX-License-Identifier: AGPL-3.0-or-later",
    ),
    "BSD-3-Clause": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
        "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
        "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
        "Released under the BSD 3-Clause License.",
        "SPDX-License-Identifier: BSD-3-Clause",
    ),
    "CC-BY-4.0": (
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
        "Licensed under CC BY 4.0.",
        "SPDX-License-Identifier: CC-BY-4.0",
    ),
    "CC-BY-NC-4.0": (
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
        "Licensed under CC BY-NC 4.0.",
        "SPDX-License-Identifier: CC-BY-NC-4.0",
    ),
    "CC-BY-SA-4.0": (
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
        "Licensed under CC BY-SA 4.0.",
        "SPDX-License-Identifier: CC-BY-SA-4.0",
    ),
    "CC0-1.0": (
        "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
        "Released under CC0 1.0 Universal Public Domain Dedication.",
        "SPDX-License-Identifier: CC0-1.0",
    ),
    "GPL-2.0": (
        "This work is licensed under the GNU General Public License, version 2.",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
        "SPDX-License-Identifier: GPL-2.0-only",
    ),
    "GPL-3.0": (
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
        "SPDX-License-Identifier: GPL-3.0-or-later",
    ),
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
        "Licensed under the ISC License.",
        "SPDX-License-Identifier: ISC",
    ),
    "LGPL": (
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.",
        "This work is licensed under the GNU Lesser General Public License.",
        "SPDX-License-Identifier: LGPL-2.1-or-later",
        "SPDX-License-Identifier: LGPL-3.0-or-later",
    ),
    "MIT": (
        "Released under the MIT License.",
        'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction.',
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
        "Licensed under the MIT License.",
        "SPDX-License-Identifier: MIT",
    ),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "Released under the Mozilla Public License 2.0.",
        "SPDX-License-Identifier: MPL-2.0",
    ),
    "Proprietary": ("All rights reserved.", "Confidential and proprietary. All rights reserved."),
}
#: Words that templates share with ordinary prose.
_COMMON = frozenset(
    "a all and any are as at be by can charge either except file files following for form forms found free in is it later law met not of"
    " option or person possible terms that the this to under use used version with without work you"
    " 0 1 2 3 4 above appear binary by cc code copies copy derived from included its list materials mit must name names nc neither nor only other"
    " portions prior products program promote provided purpose retain reproduce sa shall specific use v written".split()
)
UNKNOWN = "unknown"
#: The share of a template's words that confirms a prediction, and the least chance.
CONFIRMS, LEAST_CHANCE = 0.9, 0.5
#: Words that a notice may have beyond twice its template's, and between two words that it takes on.
SPREAD, GAP = 24, 12
#: Documents whose lines stand for unknown text, at most about so many, and lines.
SAMPLE_ROWS, SAMPLE_LINES = 500, 3000
_SPLIT = "[^a-z0-9]+"


@dataclass(frozen=True)
class LicenseModel:
    families: list[str]
    grams: list[str]
    #: A line of weights per feature, and the bias, with the temperature divided out.
    weights: np.ndarray
    bias: np.ndarray


def words_of(text: str) -> list[str]:
    return [w for w in re.split(_SPLIT, text.lower()) if w]


def _grams(words: list[str]) -> set[str]:
    return {*words, *(f"{a} {b}" for a, b in zip(words, words[1:], strict=False))}


def _covered(words: set[str], template: str) -> float:
    own = set(words_of(template))
    return len(own & words) / len(own)


def _fit_softmax(rows: np.ndarray, wanted: np.ndarray, classes: int, steps: int = 400) -> tuple[np.ndarray, np.ndarray]:
    weights, bias = np.zeros((rows.shape[1], classes)), np.zeros(classes)
    counts = np.bincount(wanted, minlength=classes)
    weight = (1 / np.maximum(counts, 1))[wanted][:, None] / classes
    ones = np.eye(classes)[wanted]
    speed = [np.zeros_like(weights), np.zeros_like(bias)]
    for _ in range(steps):
        error = (_chances(rows @ weights + bias) - ones) * weight
        for k, (values, slope) in enumerate(((weights, rows.T @ error + 1e-4 * weights), (bias, error.sum(axis=0)))):
            speed[k] = 0.9 * speed[k] - 0.5 * slope
            values += speed[k]
    return weights, bias


def _chances(logits: np.ndarray) -> np.ndarray:
    raised = np.exp(logits - logits.max(axis=1, keepdims=True))
    return raised / raised.sum(axis=1, keepdims=True)


def fit(lines: list[str], seed: int = 13) -> LicenseModel:
    """Train on the templates and on lines of other text; lines that a template's words cover are left out."""
    families = [*sorted(TEMPLATES), UNKNOWN]
    random = np.random.default_rng(seed)
    known = [(k, t) for k, family in enumerate(families[:-1]) for t in TEMPLATES[family]]
    other = [w for line in lines if (w := words_of(line)) and max(_covered(set(w), t) for _, t in known) < 0.5]
    filler = [word for words in other for word in words] or ["x"]
    grams = sorted({g for _, t in known for g in _grams(words_of(t))})
    place = {g: n for n, g in enumerate(grams)}
    examples: list[tuple[int, list[str]]] = []
    for k, template in known:
        words = words_of(template)
        examples += [(k, words)] * 4
        for _ in range(30):
            kept = [w for w in words if random.random() > 0.08] or words
            around = [[filler[i] for i in random.integers(0, len(filler), random.integers(0, 12))] for _ in range(2)]
            examples.append((k, around[0] + kept + around[1]))
        for _ in range(10):
            # Single words of a notice are not a notice.
            few = [words[i] for i in random.integers(0, len(words), max(1, len(words) // 4))]
            examples.append((len(families) - 1, few + [filler[i] for i in random.integers(0, len(filler), 10)]))
    examples += [(len(families) - 1, words) for words in other]
    rows = np.zeros((len(examples), len(grams)))
    for n, (_, words) in enumerate(examples):
        rows[n, [place[g] for g in _grams(words) if g in place]] = 1
    wanted = np.array([k for k, _ in examples])
    apart = random.random(len(examples)) < 0.2
    weights, bias = _fit_softmax(rows[~apart], wanted[~apart], len(families))
    logits = rows[apart] @ weights + bias
    heats = np.geomspace(0.2, 5, 40)
    losses = [-np.log(_chances(logits / h)[np.arange(len(logits)), wanted[apart]] + 1e-12).mean() for h in heats] if apart.any() else [0]
    heat = heats[int(np.argmin(losses))]
    return LicenseModel(families, grams, weights / heat, bias / heat)


def learn(documents: DataFrame, key: str = "doc_id", text: str = "text") -> LicenseModel:
    """Fit against lines of ``SAMPLE_ROWS`` documents at most, ``SAMPLE_LINES`` at most."""
    texts = documents.where(F.col(text).isNotNull()).select(F.col(key).alias("k"), F.col(text).alias("t"))
    drawn = bounded(texts, SAMPLE_ROWS, 10).select("t")
    lines = sorted({line for (t,) in drawn.collect() for line in t.split("\n")})
    pick = np.random.default_rng(1).permutation(len(lines))[:SAMPLE_LINES]
    return fit([lines[k] for k in sorted(pick)])


def _literal(words: list[str]) -> Column:
    """Words as one constant array; a literal for each would take long to put together."""
    return F.split(F.lit("\t".join(words)), "\t")


def _numbers(values, kind: str) -> Column:
    return _literal([f"{v:.6f}" if kind == "double" else str(v) for v in values]).cast(f"array<{kind}>")


def _let(value: Column, body) -> Column:
    """``body`` of a value that is evaluated once, however often the body uses it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _words(line: Column) -> Column:
    return F.filter(F.split(F.lower(line), _SPLIT), lambda w: w != "")


# --- templates as tables ------------------------------------------------------------------------


@dataclass(frozen=True)
class Template:
    """The distinct words of a template, how many of them confirm, and the words of which one is always among these."""

    family: str
    words: tuple[str, ...]
    need: int
    keys: tuple[str, ...]

    @property
    def most(self) -> int:
        """Words of a notice at most."""
        return 2 * len(self.words) + SPREAD


def templates() -> list[Template]:
    every = [(family, sorted(set(words_of(t)))) for family in sorted(TEMPLATES) for t in TEMPLATES[family]]
    shared = Counter(w for _, words in every for w in words)
    out = []
    for family, words in every:
        need = math.ceil(CONFIRMS * len(words) - 1e-9)
        rare = sorted(words, key=lambda w: (w in _COMMON, shared[w], -len(w), w))
        out.append(Template(family, tuple(words), need, tuple(rare[: len(words) - need + 1])))
    return out


def anchors() -> list[str]:
    """Words that templates do not share with ordinary prose, and all key words."""
    return sorted({w for t in templates() for w in (*t.keys, *t.words)} - (_COMMON - {w for t in templates() for w in t.keys}))


@dataclass(frozen=True)
class _Tables:
    """The templates, from 1 on, as constants."""

    words: Column
    need: Column
    most: Column
    size: Column
    keys: Column
    #: Numbers of the templates that a word is a key of, and of those of a class.
    by_key: Column
    by_class: Column

    @classmethod
    def of(cls, known: list[Template], families: list[str]) -> _Tables:
        keyed = sorted({w for t in known for w in t.keys})
        numbers = [" ".join(str(n) for n, t in enumerate(known, 1) if w in t.keys) for w in keyed]
        own = [" ".join(str(n) for n, t in enumerate(known, 1) if t.family == family) or "0" for family in families]
        return cls(
            _literal([" ".join(t.words) for t in known]),
            _numbers([t.need for t in known], "int"),
            _numbers([t.most for t in known], "int"),
            _numbers([len(t.words) for t in known], "int"),
            _literal([" ".join(t.keys) for t in known]),
            F.map_from_arrays(_literal(keyed), _literal(numbers)),
            _literal(own),
        )

    def words_of(self, number: Column) -> Column:
        return F.split(F.element_at(self.words, number), " ")


# --- notices of one text ------------------------------------------------------------------------


def _bit(word: Column, own: Column) -> Column:
    """A bit for each of a template's words."""
    place = F.array_position(own, word).cast("int")
    return F.when(place > 0, F.call_function("shiftleft", F.lit(1).cast("bigint"), place - 1)).otherwise(F.lit(0).cast("bigint"))


def _taken(words: Column, mask: Column, own: Column) -> Column:
    """``mask, n``: the template's words found from here on, and the place of the last that was new."""

    def step(state: Column, word: Column) -> Column:
        return _let(_bit(word, own), lambda bit: F.when(
            (bit != 0) & (state["mask"].bitwiseAND(bit) == 0) & (state["at"] - state["n"] <= GAP),
            F.struct(state["mask"].bitwiseOR(bit).alias("mask"), (state["at"] + 1).alias("n"), (state["at"] + 1).alias("at")),
        ).otherwise(F.struct(state["mask"].alias("mask"), state["n"].alias("n"), (state["at"] + 1).alias("at"))))

    start = F.struct(mask.alias("mask"), F.lit(0).alias("n"), F.lit(0).alias("at"))
    return F.aggregate(words, start, step)


def _until(words: Column, stops) -> Column:
    """The words before the first for which ``stops`` holds."""
    # The place of the first, one past the end if there is none.
    first = F.array_position(F.transform(words, lambda w: stops(w)), F.lit(True)).cast("int")
    return F.when(first > 0, F.slice(words, F.lit(1), first - 1)).otherwise(words)


def _notice(flat: Column, place: Column, number: Column, tables: _Tables) -> Column:
    """The paragraph around the key word at ``place`` that reaches the template, or null."""
    need, most = (F.element_at(t, number) for t in (tables.need, tables.most))

    def words(start: Column, count: Column) -> Column:
        return F.transform(F.slice(flat, start, count), lambda x: x["word"])

    def of_template(own: Column) -> Column:
        ahead = _until(words(place, most), lambda w: w == "")
        return _let(_taken(ahead, F.lit(0).cast("bigint"), own), lambda ahead: around(own, ahead))

    def around(own: Column, ahead: Column) -> Column:
        low = F.greatest(F.lit(1), place - most + ahead["n"])
        keys = F.split(F.element_at(tables.keys, number), " ")
        behind = _let(keys, lambda keys: _until(F.reverse(words(low, place - low)), lambda w: (w == "") | F.array_contains(keys, w)))
        return _let(_taken(behind, ahead["mask"], own), lambda behind: F.when(F.bit_count(behind["mask"]) >= need, F.struct(
            (place - behind["n"]).alias("first"), (-F.element_at(tables.size, number)).alias("longest"),
            (1 - place - ahead["n"]).alias("farthest"),
        )))

    return _let(tables.words_of(number), of_template)


def _candidates(flat: Column, tables: _Tables) -> Column:
    """The paragraphs of a text that reach a template and do not overlap, by their start."""

    def of_word(item: Column, at: Column) -> Column:
        numbers = F.element_at(tables.by_key, item["word"])
        places = F.transform(F.split(numbers, " ").cast("array<int>"), lambda n: F.struct((at + 1).alias("place"), n.alias("number")))
        return F.when(numbers.isNotNull(), places)

    places = F.flatten(F.filter(F.transform(flat, of_word), lambda x: x.isNotNull()))
    found = F.filter(F.transform(places, lambda p: _notice(flat, p["place"], p["number"], tables)), lambda n: n.isNotNull())
    kind = "array<struct<first: int, longest: int, farthest: int>>"

    def apart(kept: Column, n: Column) -> Column:
        free = (F.size(kept) == 0) | (-F.element_at(kept, -1)["farthest"] < n["first"])
        return F.when(free, F.array_append(kept, n)).otherwise(kept)

    return F.aggregate(F.sort_array(found.cast(kind)), F.array().cast(kind), apart)


def _class_of(words: Column, model: LicenseModel) -> Column:
    """The class of a paragraph's words and its chance."""
    classes = len(model.families)
    pairs = F.when(
        F.size(words) > 1,
        F.transform(F.sequence(F.lit(1), F.size(words) - 1), lambda n: F.concat_ws(" ", F.element_at(words, n), F.element_at(words, n + 1))),
    ).otherwise(F.array().cast("array<string>"))
    grams, weights = _literal(model.grams), _numbers(model.weights.ravel(), "double")
    found = F.transform(F.array_intersect(F.concat(words, pairs), grams), lambda g: F.array_position(grams, g).cast("int"))
    logits = F.aggregate(
        found, _numbers(model.bias, "double"),
        lambda total, n: F.zip_with(total, F.slice(weights, (n - 1) * classes + 1, F.lit(classes)), lambda a, b: a + b),
    )

    def judged(logits: Column) -> Column:
        top = F.array_max(logits)
        chance = 1 / F.aggregate(logits, F.lit(0.0), lambda total, v: total + F.exp(v - top))
        return F.struct(F.array_position(logits, top).cast("int").alias("class"), chance.alias("chance"))

    return _let(logits, judged)


def _similarity(words: Column, class_: Column, tables: _Tables) -> Column:
    """The largest share of a template of the class that is among the words; 0 for the class without any."""

    def share(number: Column) -> Column:
        own = F.array_intersect(words, tables.words_of(number))
        return F.size(own) / F.element_at(tables.size, number).cast("double")

    numbers = F.filter(F.split(F.element_at(tables.by_class, class_), " ").cast("array<int>"), lambda n: n > 0)
    return F.coalesce(F.array_max(F.transform(numbers, share)), F.lit(0.0))


def _judged(words: Column, model: LicenseModel, tables: _Tables) -> Column:
    return _let(words, lambda words: _let(_class_of(words, model), lambda c: F.struct(
        c["class"].alias("class"), c["chance"].alias("chance"), _similarity(words, c["class"], tables).alias("similarity"),
    )))


def _notices(flat: Column, model: LicenseModel, tables: _Tables) -> Column:
    """The confirmed paragraphs of a text, by their start."""

    def classified(n: Column) -> Column:
        words = F.transform(F.slice(flat, n["first"], 1 - n["farthest"] - n["first"]), lambda x: x["word"])
        first, last = (F.element_at(flat, place)["line"] for place in (n["first"], -n["farthest"]))
        return F.struct(first.alias("paragraph"), (last - first + 1).alias("lines"), _judged(words, model, tables).alias("judged"))

    def sure(n: Column) -> Column:
        judged = n["judged"]
        return (judged["similarity"] >= CONFIRMS) & (judged["chance"] >= LEAST_CHANCE)

    return F.filter(F.transform(_candidates(flat, tables), classified), sure)


def scan(documents: DataFrame, model: LicenseModel, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, paragraph, family, chance, similarity, lines`` for every notice and every other line that is scored.

    ``paragraph`` is the number of its first line, and ``lines`` how many it has.
    """
    known = templates()
    tables = _Tables.of(known, model.families)
    marks = _literal(anchors())
    kept = documents.select(F.col(key).alias("doc_id"), F.col(text).alias("text"))
    kept = kept.where(F.arrays_overlap(F.split(F.lower("text"), _SPLIT), marks))

    def of_line(line: Column, number: Column) -> Column:
        # A line without words is one empty word, which no paragraph holds.
        words = _let(_words(line), lambda own: F.when(F.size(own) > 0, own).otherwise(_literal([""])))
        return F.transform(words, lambda w: F.struct(w.alias("word"), number.alias("line")))

    flat = F.flatten(F.transform(F.split("text", "\n"), of_line))
    read = kept.select("doc_id", "text", _let(flat, lambda flat: _notices(flat, model, tables)).alias("notices"))
    # An explode in between keeps what is found from being worked out for each line again.
    read = read.select("doc_id", "text", F.explode(F.array("notices")).alias("notices"))

    def left(lines: Column) -> Column:
        covered = F.flatten(F.transform("notices", lambda n: F.sequence(n["paragraph"], n["paragraph"] + n["lines"] - 1)))
        rest = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), covered)
        return F.transform(rest, lambda n: F.struct(n.alias("paragraph"), _words(F.element_at(lines, n + 1)).alias("words")))

    lines = F.filter(_let(F.split("text", "\n"), left), lambda x: F.arrays_overlap(x["words"], marks))
    lines = F.transform(lines, lambda x: F.struct(
        x["paragraph"].alias("paragraph"), F.lit(1).alias("lines"), _judged(x["words"], model, tables).alias("judged"), F.lit(False).alias("sure"),
    ))
    notices = F.transform("notices", lambda n: F.struct(
        n["paragraph"].alias("paragraph"), n["lines"].alias("lines"), n["judged"].alias("judged"), F.lit(True).alias("sure"),
    ))
    rows = read.select("doc_id", F.explode(F.concat(notices, lines)).alias("p")).select("doc_id", "p.*")
    family = F.when(F.col("sure"), F.element_at(_literal(model.families), F.col("judged.class"))).otherwise(F.lit(UNKNOWN))
    return rows.select("doc_id", "paragraph", family.alias("family"), "judged.chance", "judged.similarity", "lines")
