"""License scans by a trained paragraph classifier.

A multinomial logistic regression over word n-grams tells the license family of a paragraph or that it is none of them. It
is trained on variants of short notice templates (words left out, set among corpus words) and on corpus paragraphs that match
no template, and its probabilities are calibrated by a temperature on examples kept aside. A prediction counts when the
paragraph also holds most of a template of that family, and what tells families apart agrees: version, restrictions, the kind of
public license, and that nothing is denied. Neighbouring lines are also joined, so that wrapped notices are seen
as a whole.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain, pairwise

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cyclelake.llm.common import text_or_empty
from cyclelake.llm.samples import Adam

# Short notices by family, as they are commonly written.
TEMPLATES = {
    "MIT": ["Released under the MIT License.", "Licensed under the MIT license",
            "Permission is hereby granted, free of charge, to any person obtaining a copy of this software"],
    "Apache-2.0": ["Licensed under the Apache License, Version 2.0.", "Apache License Version 2.0, January 2004",
                   "you may not use this file except in compliance with the License"],
    "GPL-3.0": ["This work is licensed under the GNU General Public License, version 3.", "Licensed under the GPL version 3",
                "under the terms of the GNU General Public License version 3 or later",
                "under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3"],
    "GPL-2.0": ["This work is licensed under the GNU General Public License, version 2.", "Licensed under the GPL version 2",
                "under the terms of the GNU General Public License version 2 or later",
                "under the terms of the GNU General Public License as published by the Free Software Foundation, either version 2"],
    "LGPL": ["This library is licensed under the GNU Lesser General Public License.", "Licensed under the LGPL version 2.1",
             "under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3"],
    "AGPL": ["This program is licensed under the GNU Affero General Public License.", "Licensed under the AGPL version 3",
             "under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3"],
    "BSD": ["Released under the BSD License.", "Licensed under the BSD 3-Clause license",
            "Redistribution and use in source and binary forms, with or without modification, are permitted"],
    "MPL-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
                "Licensed under the Mozilla Public License 2.0"],
    "CC-BY": ["Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."],
    "CC-BY-SA": ["Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 License."],
    "CC-BY-NC": ["Licensed under CC BY-NC 4.0.",
                 "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 License."],
    "CC0": ["Released under CC0 1.0 Universal.", "To the extent possible under law, the author has waived all copyright",
            "This work is dedicated to the public domain"],
    "ISC": ["Released under the ISC License.",
            "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"],
    "CC-BY-ND": ["Licensed under CC BY-ND 4.0.", "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 License."],
    "CC-BY-NC-SA": ["Licensed under CC BY-NC-SA 4.0.",
                    "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 License."],
    "CC-BY-NC-ND": ["Licensed under CC BY-NC-ND 4.0.",
                    "This work is licensed under a Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 License."],
    "Zlib": ["Released under the zlib license.",
             "This software is provided as-is, without any express or implied warranty. In no event will the authors be held liable"],
    "BSL-1.0": ["Distributed under the Boost Software License, Version 1.0."],
    "EPL-2.0": ["This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0"],
    "OFL-1.1": ["This Font Software is licensed under the SIL Open Font License, Version 1.1."],
    "Unlicense": ["This is free and unencumbered software released into the public domain."],
    "All-rights-reserved": ["All rights reserved.", "Copyright, all rights reserved", "No part may be reproduced without permission"],
}
# Identifiers of the families in one-line tags.
SPDX = {
    "MIT": ["MIT"], "Apache-2.0": ["Apache-2.0"], "GPL-3.0": ["GPL-3.0", "GPL-3.0-only", "GPL-3.0-or-later"],
    "GPL-2.0": ["GPL-2.0", "GPL-2.0-only", "GPL-2.0-or-later"], "LGPL": ["LGPL-2.1-only", "LGPL-2.1-or-later", "LGPL-3.0-only", "LGPL-3.0-or-later"],
    "AGPL": ["AGPL-3.0", "AGPL-3.0-only", "AGPL-3.0-or-later"], "BSD": ["BSD-2-Clause", "BSD-3-Clause"], "MPL-2.0": ["MPL-2.0"],
    "CC-BY": ["CC-BY-4.0"], "CC-BY-SA": ["CC-BY-SA-4.0"], "CC-BY-NC": ["CC-BY-NC-4.0"], "CC-BY-ND": ["CC-BY-ND-4.0"],
    "CC-BY-NC-SA": ["CC-BY-NC-SA-4.0"], "CC-BY-NC-ND": ["CC-BY-NC-ND-4.0"], "CC0": ["CC0-1.0"], "ISC": ["ISC"], "Zlib": ["Zlib"],
    "BSL-1.0": ["BSL-1.0"], "EPL-2.0": ["EPL-2.0"], "OFL-1.1": ["OFL-1.1"], "Unlicense": ["Unlicense"],
}
for _family, _names in SPDX.items():
    TEMPLATES[_family] += [f"SPDX-License-Identifier: {name}" for name in _names]
# Versions of the families that have one, the restrictions of a family, words for them, kinds of public licenses.
VERSIONS = {"Apache-2.0": "2", "GPL-3.0": "3", "GPL-2.0": "2", "MPL-2.0": "2", "BSL-1.0": "1", "EPL-2.0": "2", "OFL-1.1": "1.1"}
RESTRICTIONS = {"nc": "nc", "noncommercial": "nc", "sa": "sa", "sharealike": "sa", "nd": "nd", "noderivatives": "nd", "noderivs": "nd"}
KINDS = {"lesser": "LGPL", "lgpl": "LGPL", "affero": "AGPL", "agpl": "AGPL"}
DENIALS = {"not", "never", "isn't", "isn’t", "aren't", "aren’t", "neither", "nor"}
GRANTS = {"licensed", "released", "distributed", "available", "dedicated", "covered", "published", "granted", "under"}
NAMED_BEFORE_VERSION = {"version", "v", "license", "gpl", "lgpl", "agpl", "apache", "mpl", "mozilla", "public"}
VERSION = re.compile(r"v?(\d+(?:\.\d+)*)$")
# Sentences that use the same words for something else.
OTHER_USES = [
    "You need a driver license to rent a car.", "The license plate was reserved for the mayor.", "She had the right to use the software.",
    "Attribution of the work is a matter for the public.", "All seats are reserved, the rights of way are open.",
    "He was released under the terms of the court.", "The general public may use the library free of charge.",
]
FAMILIES = ["unknown", *TEMPLATES]
VARIANTS = 60        # examples made of a template
PARAGRAPHS = 1_500   # corpus paragraphs to train on, at most
SURE, CONFIRMED = 0.5, 0.7
JOINED = 60          # words; lines are joined until they hold more, besides the whole run of lines (the longest template has 20)
BROKEN = re.compile(r"(?<=\w)-[ \t\r]*\n[ \t#*/]*(?=\w)")   # a word that goes on after a hyphen in the next line
STRIP = ".,;:()[]{}\"'!?*<>#/-"


def words_of(paragraph: str) -> list[str]:
    return [w for w in (x.strip(STRIP) for x in paragraph.lower().split()) if w]


def grams(words: list[str]) -> set[str]:
    return {*words, *map(" ".join, zip(words, words[1:])), *map(" ".join, zip(words, words[1:], words[2:]))}


_TEMPLATE_PAIRS = {family: [set(zip(w, w[1:])) for w in map(words_of, texts)] for family, texts in TEMPLATES.items()}
_PAIRS = frozenset().union(*[p for pairs in _TEMPLATE_PAIRS.values() for p in pairs])


def coverage(words: list[str], family: str) -> float:
    """The largest share of a template's word pairs that the paragraph holds."""
    own = set(zip(words, words[1:]))
    return max((len(own & pairs) / len(pairs) for pairs in _TEMPLATE_PAIRS.get(family, [])), default=0.0)


def agrees(words: list[str], family: str) -> bool:
    """Whether what tells families apart fits the family: no other version is named, the restrictions are the family's, the kind of
    public license is, and what grants the license is not denied."""
    if family in VERSIONS:
        named = [m[1] for a, b in pairwise(words) if a in NAMED_BEFORE_VERSION and (m := VERSION.match(b))]
        named += [m[1] for w in words if (m := re.match(r"(?:gpl|mpl|apache)-?v?(\d[\d.]*)", w))]
        if any(re.sub(r"(\.0)+$", "", v) != VERSIONS[family] for v in named):
            return False
    if family.startswith("CC-BY"):
        parts = {p for w in words if "-" in w or w in RESTRICTIONS for p in w.split("-")}
        held = {RESTRICTIONS[p] for p in parts if p in RESTRICTIONS} | {"nc" for a, b in pairwise(words) if (a, b) == ("non", "commercial")}
        if held != {r for r in family.lower().split("-") if r in RESTRICTIONS}:
            return False
    if family in ("GPL-3.0", "GPL-2.0", "LGPL", "AGPL"):
        kinds = {KINDS[p] for w in words for p in w.split("-") if p in KINDS}
        if kinds != ({family} if family in KINDS.values() else set()):
            return False
    return not any(w in DENIALS and not GRANTS.isdisjoint(words[at + 1:at + 4]) for at, w in enumerate(words))


@dataclass(frozen=True)
class LicenseModel:
    """Weights per n-gram of the templates and family, biases, and the temperature of the calibrated probabilities."""

    vocabulary: dict[str, int]
    weights: np.ndarray
    bias: np.ndarray
    temperature: float

    def probabilities(self, words: list[str]) -> np.ndarray:
        known = [self.vocabulary[g] for g in grams(words) if g in self.vocabulary]
        z = (self.weights[known].sum(0) + self.bias) / self.temperature
        p = np.exp(z - z.max())
        return p / p.sum()

    def paragraph(self, text: str) -> tuple[str, float, bool] | None:
        """Family, probability and whether a template confirms it; None for the unknown class. A paragraph that holds no
        two neighbouring words of any template is unknown."""
        found = self._classified(words_of(text))
        return found and (found[0], found[1], found[2] >= CONFIRMED)

    def _classified(self, words: list[str]) -> tuple[str, float, float] | None:
        """Family, probability and coverage."""
        if _PAIRS.isdisjoint(zip(words, words[1:])):
            return None
        p = self.probabilities(words)
        best = int(p.argmax())
        if best == 0 or p[best] < SURE:
            return None
        return FAMILIES[best], float(p[best]), coverage(words, FAMILIES[best]) if agrees(words, FAMILIES[best]) else 0.0

    def notices(self, text: str) -> tuple[int, list[tuple[str, float]], int]:
        """Number of lines, (family, probability) of confirmed notices, and number of unconfirmed ones.

        In a run of lines without a blank one, every line, every join of neighbouring lines of up to JOINED words, and the
        whole run are candidates. Those that hold most of a template count first, shorter ones before longer ones; a line
        is part of one notice. What other lines are classified as is unconfirmed, or, if none is, the whole of them."""
        lines = [p for p in text.split("\n") if p.strip()]
        sure: list[tuple[str, float]] = []
        unsure = 0
        run: list[list[str]] = []
        for line in [*BROKEN.sub("-", text).split("\n"), ""]:
            words = words_of(line)
            if words:
                run.append(words)
            elif run:
                if not _PAIRS.isdisjoint(pairwise(chain.from_iterable(run))):
                    found, more = self._in_run(run)
                    sure += found
                    unsure += more
                run = []
        return len(lines), sure, unsure

    def _in_run(self, run: list[list[str]]) -> tuple[list[tuple[str, float]], int]:
        hits = [_PAIRS.intersection(zip(w, w[1:])) for w in run]
        between = [_PAIRS.intersection([(a[-1], b[0])]) for a, b in zip(run, run[1:])]
        alone = [self._classified(w) if h else None for w, h in zip(run, hits)]
        candidates = [(-c[2], 1, -c[1], at, c[0]) for at, c in enumerate(alone) if c and c[2] >= CONFIRMED]

        def joined(first, last, held):
            if any(len(held & pairs) >= CONFIRMED * len(pairs) for own in _TEMPLATE_PAIRS.values() for pairs in own):
                found = self._classified([w for line in run[first:last + 1] for w in line])
                if found and found[2] >= CONFIRMED:
                    candidates.append((-found[2], last + 1 - first, -found[1], first, found[0]))

        for first in range(len(run)):
            held, size, last = hits[first], len(run[first]), first
            while last + 1 < len(run) and size <= JOINED:
                last += 1
                new = held | hits[last] | between[last - 1]
                size += len(run[last])
                if len(new) > len(held):
                    held = new
                    joined(first, last, held)
        if len(run) > 1:
            joined(0, len(run) - 1, frozenset().union(*hits, *between))
        free, sure = [True] * len(run), []
        for _, lines, p, first, family in sorted(candidates):
            if all(free[first:first + lines]):
                free[first:first + lines] = [False] * lines
                sure.append((family, -p))
        unsure = sum(1 for c, f in zip(alone, free) if c and f)
        if not unsure and not sure and len(run) > 1 and self._classified([w for line in run for w in line]):
            unsure = 1
        return sure, unsure


def _examples(paragraphs: list[list[str]], rng) -> tuple[list[set[str]], np.ndarray]:
    """Grams and classes of template variants, other uses and corpus paragraphs."""
    filler = np.array([w for p in paragraphs for w in p] or ["text"])
    found, classes = [], []

    def among(words):
        around = filler[rng.integers(len(filler), size=(0, 0, 4, 30)[rng.integers(4)])].tolist()
        cut = rng.integers(len(around) + 1)
        return around[:cut] + words + around[cut:]

    for number, family in enumerate(TEMPLATES, 1):
        for text in TEMPLATES[family]:
            words = words_of(text)
            for _ in range(VARIANTS):
                kept = [w for w, r in zip(words, rng.random(len(words))) if r > (0, 0.05, 0.1)[number % 3]]
                found.append(grams(among(kept or words)))
                classes.append(number)
    for text in OTHER_USES:
        for _ in range(VARIANTS // 4):
            found.append(grams(among(words_of(text))))
            classes.append(0)
    for words in paragraphs:
        if all(coverage(words, family) < 0.5 for family in TEMPLATES):
            found.append(grams(words))
            classes.append(0)
    return found, np.array(classes)


def fit_licenses(paragraphs: list[str], seed=0, steps=250) -> LicenseModel:
    rng = np.random.default_rng(seed)
    vocabulary = {g: n for n, g in enumerate(sorted(set().union(*[grams(words_of(t)) for ts in TEMPLATES.values() for t in ts])))}
    found, classes = _examples([words_of(p) for p in paragraphs], rng)
    x = np.zeros((len(found), len(vocabulary)), np.float32)
    for row, own in enumerate(found):
        x[row, [vocabulary[g] for g in own if g in vocabulary]] = 1
    aside = rng.random(len(found)) < 0.2
    weights, bias = np.zeros((len(vocabulary), len(FAMILIES)), np.float32), np.zeros(len(FAMILIES), np.float32)
    adam, xt, yt = Adam([weights, bias], 0.05), x[~aside], np.eye(len(FAMILIES), dtype=np.float32)[classes[~aside]]
    for _ in range(steps):
        z = xt @ weights + bias
        p = np.exp(z - z.max(1, keepdims=True))
        d = (p / p.sum(1, keepdims=True) - yt) / len(xt)
        adam.step([xt.T @ d + 1e-4 * weights, d.sum(0)])
    z, wanted = x[aside] @ weights + bias, classes[aside]

    def loss(temperature):
        s = z / temperature
        s = s - s.max(1, keepdims=True)
        return -(s[np.arange(len(s)), wanted] - np.log(np.exp(s).sum(1))).mean()

    grid = np.geomspace(0.25, 4, 33)
    return LicenseModel(vocabulary, weights, bias, float(grid[np.argmin([loss(t) for t in grid])]))


def scan_licenses(df: DataFrame, id_column="doc_id", text="text", sampled=PARAGRAPHS) -> DataFrame:
    """id, n_paragraphs, licenses (confirmed families, sorted, each once), n_confirmed and n_unconfirmed (notices), and
    probability (the highest of a confirmed one, else null): one row per input row.

    n_paragraphs counts the non-blank lines of the whole text, however long; a notice is a line or several neighbouring ones. Null and
    empty texts have none; null ids and repeated rows are kept; other columns are not read; an empty table
    gives no rows. The classifier is fitted on the templates and on the ``sampled`` corpus paragraphs with the smallest hashes.
    """
    rows = df.select(F.col(id_column).alias("_id"), text_or_empty(text).alias("_text"))
    lines = rows.select("_text", F.explode(F.split("_text", "\n")).alias("p")).select(F.xxhash64("_text", "p").alias("h"), "p")
    # Only lines below a hash that twice the sample lies below can be in it, so tasks send the driver no more than that together.
    total = rows.agg(F.sum(F.length("_text") - F.length(F.translate("_text", "\n", "")) + 1)).first()[0] or 0
    least = int(-2 ** 63 + 2 ** 64 * min(1.0, 2 * sampled / total)) if total > 2 * sampled else 2 ** 63 - 1
    sample = lines.filter(F.col("h") <= min(least, 2 ** 63 - 1)).orderBy("h", "p").limit(sampled).collect()
    if len(sample) < min(sampled, total):    # lines that repeat may share few hashes
        sample = lines.orderBy("h", "p").limit(sampled).collect()
    model = fit_licenses([r.p for r in sample])
    id_type = df.schema[id_column].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for own in batch["_text"]:
                lines, sure, unsure = model.notices(own)
                out.append((lines, sorted({h[0] for h in sure}), len(sure), unsure, max((h[1] for h in sure), default=None)))
            columns = ["n_paragraphs", "licenses", "n_confirmed", "n_unconfirmed", "probability"]
            yield pd.DataFrame(out, columns=columns).astype({"probability": "float64"}).assign(id=batch["_id"].to_numpy())

    scanned = rows.mapInPandas(run, "n_paragraphs bigint, licenses array<string>, n_confirmed bigint, n_unconfirmed bigint, "
                                    f"probability double, id {id_type}")
    return scanned.select(F.col("id").alias(id_column), "n_paragraphs", "licenses", "n_confirmed", "n_unconfirmed", "probability")
