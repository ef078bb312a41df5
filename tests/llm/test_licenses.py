import math
import random
import textwrap

import numpy as np
import pytest
from pyspark.sql import functions as F

from cyclelake.llm.licenses import OTHER_USES, TEMPLATES, coverage, fit_licenses, scan_licenses, words_of

LINES = ["the river was long and the stone was grey", "general rules of the house", "public use of the free path", "copy the work"] * 20
MODEL = fit_licenses(LINES)


def test_families_and_others():
    model = fit_licenses(LINES)
    right = [model.paragraph(t) for f, ts in TEMPLATES.items() for t in ts]
    assert np.mean([r is not None and r[0] == f and r[2] for r, f in zip(right, [f for f, ts in TEMPLATES.items() for _ in ts])]) >= 0.95
    assert not any((r := model.paragraph(t)) and r[2] for t in OTHER_USES + LINES)
    changed = model.paragraph("note: THIS work is licensed under the gnu general public license, version 3 (see file)")
    assert changed[0] == "GPL-3.0" and changed[2]
    assert coverage(words_of("Licensed under the Apache License"), "MIT") < 0.7


def test_documents(spark, documents):
    rows = [(1, "first\n\nReleased under the MIT License.\nlast"), (2, None), (3, ""), (None, "All rights reserved."),
            (5, "All rights reserved.\n" * 3 + "x " * 50_000 + "\nLicensed under CC BY-NC 4.0."), (6, "free work"), (6, "free work")]
    df = documents(rows).withColumn("licenses", F.lit("clash"))
    out = sorted(scan_licenses(df).collect(), key=lambda r: (r.doc_id is None, r.doc_id or 0))
    assert [(r.doc_id, r.n_paragraphs, r.licenses, r.n_confirmed) for r in out] == [
        (1, 3, ["MIT"], 1), (2, 0, [], 0), (3, 0, [], 0), (5, 5, ["All-rights-reserved", "CC-BY-NC"], 4), (6, 1, [], 0), (6, 1, [], 0),
        (None, 1, ["All-rights-reserved"], 1)]
    assert scan_licenses(documents([])).count() == 0


GNU = ("This program is free software: you can redistribute it and/or modify it under the terms of the GNU {}General Public License "
       "as published by the Free Software Foundation, either version {} of the License, or (at your option) any later version.")
WRAPPED = {f: ts + [GNU.format(k, v)] for f, k, v, ts in (
    ("GPL-3.0", "", 3, TEMPLATES["GPL-3.0"]), ("GPL-2.0", "", 2, TEMPLATES["GPL-2.0"]), ("LGPL", "Lesser ", 3, TEMPLATES["LGPL"]),
    ("AGPL", "Affero ", 3, TEMPLATES["AGPL"]))}


def test_wrapped_notices_of_every_family():
    model = fit_licenses(LINES)
    wrong = []
    for family, texts in (TEMPLATES | WRAPPED).items():
        for text in texts:
            for width in (24, 40, 72):
                lines = textwrap.wrap(text, width)
                for given in ("\n".join(lines), "# " + "\n# ".join(lines), "a river of stone\n" + "\n".join(lines) + "\nthe house was grey"):
                    found = model.notices(given)[1]
                    if [f for f, _ in found] != [family]:
                        wrong.append((family, width, text, found))
    assert not wrong
    assert model.notices("\n".join(LINES))[1] == []
    both = "\n".join(textwrap.wrap(GNU.format("", 3), 50) + ["Released under", "the MIT License."])
    assert sorted(f for f, _ in model.notices(both)[1]) == ["GPL-3.0", "MIT"]


@pytest.mark.parametrize("text, family", [
    ("Licensed under CC BY-NC-ND 4.0.", "CC-BY-NC-ND"), ("Licensed under CC BY-SA 4.0.", "CC-BY-SA"), ("SPDX-License-Identifier: MIT", "MIT"),
    ("// SPDX-License-Identifier: Apache-2.0", "Apache-2.0"), ("SPDX-License-Identifier: GPL-2.0-or-later", "GPL-2.0"),
    ("Licensed under the Apache License, Version 2.0.", "Apache-2.0"), ("Licensed under the GPL version 3", "GPL-3.0"),
    ("This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 License.", "CC-BY-NC-SA"),
    ("Licensed under the Apache License, Version 1.1", None), ("Apache License, Version 1.1", None), ("Licensed under the GPL version 1", None),
    ("This work is licensed under the GNU General Public License, version 1.", None), ("This is **not** released under the MIT License", None),
    ("It was never licensed under the Apache License, Version 2.0.", None), ("SPDX-License-Identifier: Unheard-1.0", None),
])
def test_versions_restrictions_and_denials(text, family):
    for given in (text, "the river was long\n" + text + "\nthe house was grey"):
        assert [f for f, _ in MODEL.notices(given)[1]] == ([family] if family else [])


def test_coverage_and_probabilities_equal_plain_counts():
    rng = random.Random(3)
    texts = [t for ts in TEMPLATES.values() for t in ts]
    for _ in range(60):
        mixed = " ".join(rng.sample(texts, 4)).split()
        words = words_of(" ".join(rng.sample(mixed, min(12, len(mixed)))) + " " + rng.choice(texts)[: rng.randint(5, 80)])
        for family, own in TEMPLATES.items():
            best = 0.0
            for t in own:
                w = words_of(t)
                pairs = {(a, b) for a, b in zip(w, w[1:])}
                held = sum(any(words[i:i + 2] == list(p) for i in range(len(words))) for p in pairs)
                best = max(best, held / len(pairs))
            assert coverage(words, family) == best
        z = list(MODEL.bias)
        for gram, row in MODEL.vocabulary.items():
            size = gram.count(" ") + 1
            if any(" ".join(words[i:i + size]) == gram for i in range(len(words) - size + 1)):
                z = [a + b for a, b in zip(z, MODEL.weights[row])]
        p = [math.exp((a - max(z)) / MODEL.temperature) for a in z]
        assert MODEL.probabilities(words) == pytest.approx([x / sum(p) for x in p], abs=1e-4)


def test_sample_is_the_lines_with_the_smallest_hashes(spark, documents, monkeypatch):
    from cyclelake.llm import licenses

    seen = []
    monkeypatch.setattr(licenses, "fit_licenses", lambda p: seen.append(p) or MODEL)
    df = documents([(i, f"line {i}\nother {i % 7}\nsame") for i in range(300)])
    licenses.scan_licenses(df, sampled=50).count()
    rows = df.select("text", F.explode(F.split("text", "\n")).alias("p")).orderBy(F.xxhash64("text", "p"), "p").limit(50).collect()
    assert seen == [[r.p for r in rows]]
