import collections
import re

import pytest

from cardwatch.llm import licences


@pytest.fixture(scope="module")
def model(spark):
    return licences.train(spark)


def found(docs, model, rows):
    return sorted(((r.doc_id, r.paragraph, r.family) for r in licences.scan(docs(rows), model).collect() if r.family != "unknown"), key=str)


def test_held_out_notices(docs, model):
    """Wordings that aren't in the training notices, inside other text."""
    other = "Some prose about the sea.\n\n{}\n\nMore prose follows here."
    lines = {
        "apache": "The tool is licensed under the Apache License, Version 2.0, as found in LICENSE.",
        "mit": "All of this is released under the MIT License by its authors.",
        "gpl": "This book is licensed under the GNU General Public License, version 2.",
        "cc-by-nc": "Photos: licensed under CC BY-NC 4.0.",
        "mpl": "The parser is licensed under the Mozilla Public License, version 2.0.",
        "bsd": "Everything is released under the BSD 3-Clause License here.",
    }
    rows = [(k, other.format(t)) for k, t in enumerate(lines.values())]
    assert found(docs, model, rows) == [(k, 1, f) for k, f in enumerate(lines)]


def test_look_alikes_are_unknown(docs, model):
    rows = [(k, t) for k, t in enumerate([
        "His driving license was taken away.", "The general public may enter.", "Permission granted, said the king.", "Ships licensed under older rules may sail.",
        "A warranty and a copyright notice were printed on the box.", "mit Freude und mit Geduld", "cc everyone please", "The terms of the deal are public."])]
    assert found(docs, model, rows) == []


def test_lines_of_long_blocks_count_alone(docs, model):
    block = "\n".join(["word " * 30, "Released under the MIT License.", "word " * 40])
    assert found(docs, model, [(1, block)]) == [(1, 1, "mit")]


def test_odd_rows(docs, odd, model):
    table = docs([*odd, (20, "Released under the MIT License."), (20, "Released under the MIT License."), (None, "Licensed under CC BY 4.0.")])
    rows = licences.scan(table.withColumnRenamed("lang", "row").withColumnRenamed("source", "paragraph"), model).where("family <> 'unknown'").collect()
    assert collections.Counter((r.doc_id, r.family) for r in rows) == {(20, "mit"): 2, (None, "cc-by"): 1}
    assert licences.scan(docs([]), model).collect() == []


def test_scores_are_the_models(docs, model):
    """The joined sums against the sums of every feature of the paragraph."""
    import math

    text = "Licensed under the Apache License, Version 2.0 or under the MIT license."
    w = licences.words(text)
    features = {" ".join(w[i:i + n]) for n in (1, 2, 3) for i in range(len(w) - n + 1)}
    z = [b + sum(model.weights[f][k] for f in features if f in model.weights) for k, b in enumerate(model.intercept)]
    row = licences.scan(docs([(1, text)]), model).collect()[0]
    assert row.predicted == model.families[z.index(max(z))]
    assert math.isclose(row.probability, 1 / sum(math.exp(x - max(z)) for x in z), rel_tol=1e-9)


def test_plan_has_no_python(docs, model):
    plan = licences.scan(docs([(1, "a")]), model)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_proprietary_and_headings(docs, model):
    """Notices without an invented name, and lines that only name a licence."""
    lines = [("All rights reserved.", "proprietary"), ("Copyright 2021 Acme Inc. All rights reserved.", "proprietary"), ("Some prose.\nAll rights reserved.", "proprietary"),
             ("MIT License", "mit"), ("License: MIT", "mit"), ("License: Apache-2.0", "apache"), ("BSD 3-Clause License", "bsd"), ("License: GPLv3", "gpl"), ("ISC License", "isc"),
             ("Mozilla Public License 2.0", "mpl"), ("License: CC BY 4.0", "cc-by"), ("License: CC BY-SA 4.0", "cc-by-sa"), ("License: CC BY-NC 4.0", "cc-by-nc"),
             ("GNU Lesser General Public License v2.1", "lgpl"), ("GNU Affero General Public License v3.0", "agpl"), ("License: Public Domain", "public-domain")]
    assert found(docs, model, [(k, t) for k, (t, _) in enumerate(lines)]) == sorted(((k, 0, f) for k, (_, f) in enumerate(lines)), key=str)


def test_names_in_prose_are_unknown(docs, model):
    rows = [(k, t) for k, t in enumerate([
        "A long chapter of the book compares the MIT license to many other texts.", "All seats were reserved.", "He reserved all the rights for himself."])]
    assert found(docs, model, rows) == []


def test_whole_table_all_five(spark, sf_small, model):
    """Every one of the five planted kinds of licence line is found, and nothing else."""
    families = {"Apache License": "apache", "MIT License": "mit", "GNU General Public": "gpl", "CC BY-NC": "cc-by-nc", "All rights reserved": "proprietary"}
    table = spark.read.parquet(f"{sf_small}/documents.parquet")
    expected = collections.Counter()
    for r in table.collect():
        for line in (r.text or "").split("\n"):
            expected.update((r.doc_id, f) for mark, f in families.items() if re.search(mark, line))
    got = collections.Counter((r.doc_id, r.family) for r in licences.scan(table, model).collect() if r.family != "unknown")
    assert got == expected and "proprietary" in {f for _, f in expected}


PROSE = "The old harbour lay quiet under the evening sky and the boats came home one after the other while the lamps were lit along the quay"
BSD = """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions
are met: one, redistributions of source code keep the notice above and
this list and the text below it; two, redistributions in binary form show the
notice above and this list and the text below it in the
manual or in other things that come with it when it is
handed out to others."""


def wrapped(text, width):
    w = text.split()
    return "\n".join(" ".join(w[k:k + width]) for k in range(0, len(w), width))


def test_wrapped_notices_in_long_blocks(docs, model):
    """Notices over two lines or behind prose count in blocks of any size."""
    notices = {"bsd": BSD, "cc-by-sa": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
               "gpl": "This program is free software: you can redistribute it under the terms of the GNU General Public License.",
               "mit": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files."}
    for family, notice in notices.items():
        lines = wrapped(notice, 9) if family != "bsd" else notice
        blocks = [lines, f"{wrapped(PROSE, 11)}\n{lines}\n{wrapped(PROSE, 7)}\n{wrapped(PROSE, 13)}", f"{PROSE}. {PROSE}. {PROSE}. " + " ".join(notice.split()) + f" {PROSE}. {PROSE}.",
                  wrapped(f"{PROSE}. {PROSE}. {PROSE}. {notice} {PROSE}.", 10), wrapped(f"{PROSE}. {PROSE}. {notice}", 3)]
        rows = licences.scan(docs([*enumerate(blocks)]), model).where("family <> 'unknown'").collect()
        assert collections.Counter((r.doc_id, r.family) for r in rows) == {(k, family): 1 for k in range(len(blocks))}, family


def test_windows_against_brute_force(docs, model):
    """Every paragraph's family by a plain reading of the rules, from the model's weights."""
    import math
    import random

    rng = random.Random(4)
    anchor = re.compile("(?i)(?<![a-z0-9])(" + "|".join(a.replace(".", "[.]") for a in licences.ANCHORS) + ")(?![a-z0-9])")
    shapes = [(f, set(licences.pairs_of(t)), most) for kind, most in ((licences.templates(), 10 ** 9), (licences.HEADINGS, licences.SHORT)) for f, ns in kind.items() if f != "unknown" for t in ns]

    def judge(text):
        w = licences.words(text)
        has = {" ".join(w[i:i + n]) for n in (1, 2, 3) for i in range(len(w) - n + 1)}
        features = has & model.weights.keys()
        if not features:
            return None
        z = [b + sum(model.weights[f][k] for f in features) for k, b in enumerate(model.intercept)]
        family, p = model.families[z.index(max(z))], 1 / sum(math.exp(x - max(z)) for x in z)
        match = max((len(ps & has) / len(ps) for f, ps, most in shapes if f == family and most >= len(w)), default=0)
        return family, p >= model.threshold and match >= licences.OVERLAP

    def expected(text):
        out, before = [], 0
        for block in (b for b in re.split(r"\n[ \t\r]*\n", text) if b.strip(" ")):
            lines = [block]
            if len(re.split(r"\s+", block)) > licences.LONG:
                lines = []
                for line in (x for x in block.split("\n") if x.strip(" ")):
                    t = re.split(r"\s+", line.strip(" "))
                    lines += [" ".join(t[k:k + licences.PIECE]) for k in range(0, len(t), licences.PIECE)] if len(t) > licences.PIECE else [line]
            alone = [judge(x) if anchor.search(x) else None for x in lines]
            out += [(before + i, f[0] if f[1] else "unknown") for i, f in enumerate(alone) if f]
            spans = {}
            for i in range(len(lines)):
                n, j = 0, i
                while j < len(lines) and n < licences.TOGETHER:
                    n += len(re.split(r"\s+", lines[j].strip(" ")))
                    j += 1
                if j - 1 > i and any(anchor.search(x) for x in lines[i:j]):
                    f = judge(" ".join(lines[i:j]))
                    if f and f[1]:
                        spans[i] = (j - 1, f[0])
            for i, (j, f) in spans.items():
                if (f, True) not in alone[i:j + 1] and all(g != f for k, (_, g) in spans.items() if i < k <= j):
                    out.append((before + i, f))
            before += len(lines)
        return sorted(out)

    some = [t for f, ns in licences.NOTICES.items() for t in map(licences.plain, ns)] + [t for ts in licences.HEADINGS.values() for t in ts] + [PROSE, PROSE, "short line", BSD]
    texts = []
    for _ in range(60):
        parts = [wrapped(rng.choice(some), rng.choice([3, 8, 12, 50])) for _ in range(rng.randrange(1, 9))]
        texts.append("".join(p + rng.choice(["\n", " ", "\n\n", "\n \t\n", ". "]) for p in parts))
    rows = licences.scan(docs([*enumerate(texts)]), model).collect()
    got = collections.defaultdict(list)
    for r in rows:
        got[r.doc_id].append((r.paragraph, r.family))
    for k, t in enumerate(texts):
        assert sorted(got[k]) == expected(t), t


def test_whole_licences(docs, model):
    """Every paragraph of the whole texts is found, in any wrapping; their disclaimers name no licence."""
    disclaimer = 'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED.'
    rows = [(f"{f}-{width}", "\n\n".join([*(wrapped(p, width) for p in ps), disclaimer])) for f, ps in licences.TEXTS.items() for width in (9, 14, 1000)]
    table = docs([(k, t) for k, (_, t) in enumerate(rows)])
    got = collections.defaultdict(set)
    for r in licences.scan(table, model).where("family <> 'unknown'").collect():
        got[rows[r.doc_id][0]].add(r.family)
    assert {k: v for k, v in got.items() if v != {k.rsplit("-", 1)[0]}} == {} and len(got) == len(rows)


def test_versions(docs, model):
    lines = {
        "This book is licensed under the GNU General Public License, version 2.": "2.0", "Released under the GNU GPL v3 license.": "3.0",
        licences.TEXTS["gpl"][0]: "2.0-or-later", wrapped(licences.TEXTS["gpl"][1], 9): "3.0-or-later", "License: GPLv3": "3.0", "SPDX-License-Identifier: GPL-3.0-or-later": "3.0-or-later",
        "SPDX-License-Identifier: LGPL-2.1-only": "2.1", "Licensed under the AGPL, version 3.": "3.0", "Licensed under the Apache License, Version 2.0.": "2.0",
        "Photos: licensed under CC BY-NC 4.0.": "4.0", "Released under the BSD 3-Clause License.": "3-clause", "Licensed under the BSD license.": None, "All rights reserved.": None,
        "Released under the MIT License. Copyright 2021.": None, "Licensed under the Mozilla Public License, version 2.0.": "2.0"}
    rows = licences.scan(docs([*enumerate(lines)]), model).where("family <> 'unknown'").collect()
    got = {}
    for r in rows:
        got[r.doc_id] = max(got.get(r.doc_id) or "", r.version or "") or None
    assert got == dict(enumerate(lines.values()))


def test_calibration(spark):
    """Temperature and threshold from made held-out scores, against the same by hand."""
    import math
    import random

    rng = random.Random(7)
    rows = []
    for _ in range(300):
        label = rng.randrange(3)
        z = [rng.gauss(0, 3) for _ in range(3)]
        z[label] += 4
        rows.append((float(label), 2, z))
    temperature, threshold = licences._calibrate(spark.createDataFrame(rows, "label double, unknown int, z array<double>"))

    def soft(z, t):
        e = [math.exp((x - max(z)) / t) for x in z]
        return [x / sum(e) for x in e]

    loss = {t: sum(-math.log(max(soft(z, t)[int(y)], 1e-12)) for y, _, z in rows) / len(rows) for t in licences.TEMPERATURES}
    assert temperature == min(loss, key=lambda t: (round(loss[t], 12), t)) and temperature != 1
    alike = sorted(max(p) if p.index(max(p)) != 2 else 0 for y, _, z in rows if y == 2 for p in [soft(z, temperature)])
    allowed = int(licences.FALSE_RATE * len(alike))
    others = [max(p) for _, _, z in rows for p in [soft(z, temperature)] if p.index(max(p)) != 2]
    assert sum(p >= threshold for p in alike) == allowed and threshold > alike[-allowed - 1]
    assert not any(alike[-allowed - 1] < p < threshold for p in others)


def test_threshold_is_calibrated(model):
    assert 0 < model.threshold < 1 and model.threshold not in (0.5, 0.9)
