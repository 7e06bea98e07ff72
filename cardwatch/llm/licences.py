"""Licence scan: a trained paragraph classifier confirmed by templates, in DataFrame operations only.

Paragraphs are blocks between blank lines. A block of over ``LONG`` words is read in parts: its lines (cut into pieces of
``PIECE`` words if longer), each by itself, and from each line on as many together as make ``TOGETHER`` words, so that a notice
counts that is wrapped over lines or stands behind other text; ``paragraph`` numbers blocks and the lines of long blocks. A
notice that a line of such a window holds by itself counts once, for that line; else windows that overlap
count once, for the last one. Features are
the one-, two- and three-word sequences of the training notices that hold a licence word (``ANCHORS``). MLlib fits a
sparse multinomial logistic regression on the notices below, on the sentences of whole licences (``TEXTS``) and on variants
of them, with look-alikes and disclaimers (which licences share) as the class ``unknown``. Calibration: each of ``FOLDS`` fits leaves
a share of the **notices** out and scores them. On these scores a temperature is fitted by their log loss, so that a
probability is the share of notices like it that are right, and the threshold is the least one at which at most ``FALSE_RATE``
of the held-out look-alikes get a family, halfway to the next surer held-out row (notices of two families that are taken for each other are left to the templates).
A prediction counts if its probability reaches the threshold, and if
the paragraph holds at least ``OVERLAP`` of the word pairs of one of the family's templates. Words between < and >
(an invented name or year) are trained on but in no word pair. A heading names a licence only, so it confirms only a
paragraph of at most ``SHORT`` words.

``version`` is the version that a confirmed paragraph names after the licence's name, as ``3.0``, ``3.0-or-later`` or
``3-clause``; null if it names none.

A paragraph without a licence word has no feature, so it is skipped by one pattern: the result is the same. Rows:
one for each paragraph with a feature: doc_id, paragraph (number from 0), family (``unknown`` unless confirmed),
predicted, probability, template, overlap, version.

Null and empty texts have no paragraphs. Repeated rows and ids give rows of their own; null ids are kept; an empty
table gives an empty table; other columns are ignored. The model and its tables are bounded by the notices.
"""

from __future__ import annotations

import json
import re
from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizer, StringIndexer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cardwatch.llm.common import need

UNKNOWN = "unknown"
LONG, SHORT, OVERLAP, REGULARISATION = 60, 6, 0.6, 0.002
#: Parts that the notices are dealt into for calibration, and the share of held-out look-alikes that may pass the threshold.
FOLDS, FALSE_RATE = 3, 0.02
#: Temperatures tried: 0.25 to 4.
TEMPERATURES = [2 ** (k / 4) for k in range(-8, 9)]
#: Words of a piece of a long line; words that lines are read together for. A notice of up to 31 words is whole in some window.
PIECE, TOGETHER = 30, 50

#: Notices of each family; each is also a template.
NOTICES = {
    "apache": [
        "Licensed under the Apache License, Version 2.0.",
        "This project is released under the Apache 2.0 license.",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License.',
        "SPDX-License-Identifier: Apache-2.0",
    ],
    "mit": [
        "Released under the MIT License.",
        "Distributed under the terms of the MIT license.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files.",
        "SPDX-License-Identifier: MIT",
    ],
    "gpl": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it under the terms of the GNU General Public License.",
        "Licensed under the GPL, version 2 or later.",
        "Released under the GNU GPL v3 license.",
        "SPDX-License-Identifier: GPL-3.0-or-later",
    ],
    "lgpl": [
        "This library is licensed under the GNU Lesser General Public License, version 2.1.",
        "Licensed under the LGPL, version 3.",
        "SPDX-License-Identifier: LGPL-2.1-only",
    ],
    "agpl": [
        "This software is licensed under the GNU Affero General Public License, version 3.",
        "Licensed under the AGPL, version 3.",
        "SPDX-License-Identifier: AGPL-3.0-only",
    ],
    "mpl": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "Licensed under the Mozilla Public License, version 2.0.",
        "SPDX-License-Identifier: MPL-2.0",
    ],
    "bsd": [
        "Released under the BSD 3-Clause License.",
        "Licensed under the BSD license.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met.",
        "SPDX-License-Identifier: BSD-3-Clause",
    ],
    "isc": [
        "Released under the ISC License.",
        "Permission to use, copy, modify, and distribute this software for any purpose with or without fee is hereby granted.",
        "SPDX-License-Identifier: ISC",
    ],
    "cc-by": [
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
        "Available under the Creative Commons Attribution license.",
    ],
    "cc-by-sa": [
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
        "Text is available under the Creative Commons Attribution-ShareAlike license.",
    ],
    "cc-by-nc": [
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
        "Licensed under CC BY-NC-SA 4.0.",
        "Licensed under CC BY-NC-ND 4.0.",
    ],
    "public-domain": [
        "This work has been dedicated to the public domain under CC0 1.0.",
        "This is free and unencumbered software released into the public domain.",
        "This work is in the public domain, no copyright applies.",
    ],
    "proprietary": [
        "All rights reserved.",
        "Copyright <2020 Example Company>. All rights reserved.",
        "Copyright (c) <2015-2021 Some Authors>. All rights reserved.",
        "This software is proprietary and confidential; no license is granted.",
        "All rights reserved. Unauthorized copying of this file is prohibited under copyright law.",
    ],
    UNKNOWN: [
        "You need a driving license to rent the car.",
        "The doctor lost his medical license last year.",
        "A fishing license costs ten dollars, version two of the rules says.",
        "The board asked permission to use the hall on Sunday.",
        "The phone has a warranty of two years.",
        "Public access to the domain of the castle is free.",
        "The general public was granted free entry.",
        "He wrote a book about copyright and the history of printing.",
        "The song was released under a new title in version 2.0.",
        "The licensed plumber came under heavy rain.",
        "Poetic license lets writers break the rules.",
        "Permission was granted by the mayor, free of charge.",
        "The new license plate was issued in Boston.",
        "The restaurant is licensed to sell wine.",
        "Terms of use may change without notice.",
        "All seats in the front row are reserved for members.",
        "The rights of the guests were reserved to the owner.",
        'The software is provided "as is", without warranty of any kind, express or implied.',
        "This software is provided by the copyright holders and contributors as is, and any express or implied warranties are disclaimed.",
        "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of merchantability.",
        "In no event shall the authors or copyright holders be liable for any claim or damages.",
        "The law on copyright was changed last year.",
        "A license fee is due on the first day of the month.",
        "Which license fits your project depends on its readers.",
        "The terms of the contract were read aloud in court.",
        "The club reserved a room at the public library.",
        "The house of commons met in public on Monday.",
        "Please send a copy, cc the office, and ask for permission.",
        "The proprietary recipe of the bakery is a secret.",
        "The essay compares open licenses such as the MIT and the GNU ones in general terms.",
        "The report was released to the public under pressure.",
        "Copyright law in the digital age is a course for lawyers.",
        "The museum was granted a loan of two paintings.",
    ],
}
#: Grants and conditions of whole public licences and their notices, a paragraph each. Their disclaimers name
#: no licence: several share them.
TEXTS = {
    "apache": [
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0',
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.",
    ],
    "mit": [
        'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:',
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    ],
    "gpl": [
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
        "See the GNU General Public License for more details. You should have received a copy of the GNU General Public License along with this program. If not, see <https://www.gnu.org/licenses/>.",
    ],
    "lgpl": [
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.",
        "See the GNU Lesser General Public License for more details. You should have received a copy of the GNU Lesser General Public License along with this library; if not, write to the Free Software Foundation.",
    ],
    "agpl": [
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
        "See the GNU Affero General Public License for more details. You should have received a copy of the GNU Affero General Public License along with this program. If not, see <https://www.gnu.org/licenses/>.",
    ],
    "mpl": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
    ],
    "bsd": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
        "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
    ],
    "isc": [
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    ],
    "cc-by": [
        "This work is licensed under the Creative Commons Attribution 4.0 International License. To view a copy of this license, visit http://creativecommons.org/licenses/by/4.0/ or send a letter to Creative Commons.",
    ],
    "cc-by-sa": [
        "This work is licensed under the Creative Commons Attribution-ShareAlike 4.0 International License. To view a copy of this license, visit http://creativecommons.org/licenses/by-sa/4.0/ or send a letter to Creative Commons.",
    ],
    "cc-by-nc": [
        "This work is licensed under the Creative Commons Attribution-NonCommercial 4.0 International License. To view a copy of this license, visit http://creativecommons.org/licenses/by-nc/4.0/ or send a letter to Creative Commons.",
    ],
    "public-domain": [
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.",
        "In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright interest in the software to the public domain.",
    ],
}
#: The name of each family that has versions, as a pattern that its version follows.
NAMES = {
    "apache": "apache",
    "gpl": "(?<![al])gpl|(?<!lesser |library |affero )general public licen[cs]e",
    "lgpl": "lgpl|(?:lesser|library) general public licen[cs]e",
    "agpl": "agpl|affero general public licen[cs]e",
    "mpl": "mpl|mozilla public licen[cs]e",
    "cc-by": "cc[ -]by|attribution",
    "cc-by-sa": "cc[ -]by-sa|sharealike",
    "cc-by-nc": "cc[ -]by-nc|noncommercial",
    "public-domain": "cc0",
}
#: Lines that name a licence and say nothing else; templates of short paragraphs.
HEADINGS = {
    "apache": ["Apache License 2.0", "Apache License, Version 2.0", "License: Apache-2.0"],
    "mit": ["MIT License", "The MIT License (MIT)", "License: MIT"],
    "gpl": ["GNU General Public License v3.0", "License: GPL-3.0", "License: GPLv3"],
    "lgpl": ["GNU Lesser General Public License v2.1", "License: LGPL-2.1", "License: LGPLv3"],
    "agpl": ["GNU Affero General Public License v3.0", "License: AGPL-3.0", "License: AGPLv3"],
    "mpl": ["Mozilla Public License 2.0", "License: MPL-2.0"],
    "bsd": ["BSD 3-Clause License", "BSD License", "License: BSD-3-Clause"],
    "isc": ["ISC License", "License: ISC"],
    "cc-by": ["Creative Commons Attribution 4.0 International", "License: CC BY 4.0", "License: CC-BY-4.0"],
    "cc-by-sa": ["Creative Commons Attribution-ShareAlike 4.0 International", "License: CC BY-SA 4.0", "License: CC-BY-SA-4.0"],
    "cc-by-nc": ["Creative Commons Attribution-NonCommercial 4.0 International", "License: CC BY-NC 4.0", "License: CC-BY-NC-4.0"],
    "public-domain": ["CC0 1.0 Universal", "License: CC0-1.0", "License: Public Domain"],
    "proprietary": ["Proprietary License", "License: Proprietary"],
}
#: Words of which each feature holds one.
ANCHORS = [
    "license", "licence", "licensed", "licenses", "spdx", "copyright", "permission", "permitted", "redistribution", "redistribute", "gpl", "lgpl", "agpl", "mpl",
    "gnu", "bsd", "isc", "cc", "cc0", "commons", "public", "unencumbered", "reserved", "proprietary", "warranty", "license-identifier", "spdx-license-identifier",
    "apache-2.0", "unlicense", "granted", "terms", "sublicense", "redistributions",
]
TOKEN = "[a-z0-9]+(?:[.-][a-z0-9]+)*"


def words(text: str) -> list[str]:
    return re.findall(TOKEN, text.lower())


def pairs_of(notice: str) -> list[str]:
    """The word pairs of a template, without those that hold an invented word."""
    return sorted({" ".join(p) for part in re.split("<[^>]*>", notice) for w in [words(part)] for p in zip(w, w[1:], strict=False)})


def sentences(paragraph: str) -> list[str]:
    """The sentences and clauses of a paragraph in parts of at most ``PIECE`` words and at least a third of that, if it has as many."""
    out: list[list[str]] = []
    for part in re.split(r"(?<=[.;:])\s+", paragraph):
        w = part.split()
        for k in range(0, len(w), PIECE):
            piece = w[k:k + PIECE]
            if out and len(piece) < PIECE // 3 and len(out[-1]) + len(piece) <= PIECE:
                out[-1] += piece
            else:
                out.append(piece)
    return [" ".join(w) for w in out if len(w) >= PIECE // 3 and not set(words(" ".join(w))).isdisjoint(ANCHORS)]


def templates() -> dict[str, list[str]]:
    """Templates by family: notices, and the sentences of whole licences."""
    return {f: list(dict.fromkeys([*notices, *(s for p in TEXTS.get(f, []) for s in sentences(p))])) for f, notices in NOTICES.items()}


def plain(notice: str) -> str:
    return re.sub("[<>]", "", notice)


def variants(text: str) -> list[str]:
    """The notice in other surroundings, cut short, and with words missing."""
    w = text.rstrip(".").split()
    out = [text, f"Note. {text} See the file for more.", f"{text} Thank you for reading.", f"The code and data. {text}"]
    out += [" ".join(w[:k] + w[k + 1:]) for k in range(0, len(w), 3)] if len(w) > 6 else []
    return out


def _rows(spark: SparkSession, rows: list[tuple], kind: str) -> DataFrame:
    """A small table in one partition out of one JSON literal (a Column call for each value takes long)."""
    names = [f.split()[0] for f in re.split(r",\s*(?![^<]*>)", kind)]
    text = json.dumps([dict(zip(names, r, strict=True)) for r in rows])
    fields = ", ".join(f.replace(" ", ": ", 1) for f in re.split(r",\s*(?![^<]*>)", kind))
    return spark.range(0, 1, 1, 1).select(F.explode(F.from_json(F.lit(text), f"array<struct<{fields}>>")).alias("r")).select("r.*")


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def sequences(tokens: str) -> str:
    """SQL: the distinct sequences of one to three words that hold an anchor."""
    anchors = ", ".join(f"'{a}'" for a in ANCHORS)
    several = [f"transform(sequence(1, greatest(size({tokens}) - {n - 1}, 0) + 1), i -> concat_ws(' ', slice({tokens}, i, {n})))" for n in (1, 2, 3)]
    return f"filter(array_distinct(concat({', '.join(several)})), s -> arrays_overlap(split(s, ' '), array({anchors})))"


def parts_of(text: str) -> str:
    """SQL: the blocks of a text as arrays of lines; a block of at most ``LONG`` words is one."""
    pieces = f"transform(sequence(0, (size(t) - 1) DIV {PIECE}), k -> array_join(slice(t, k * {PIECE} + 1, {PIECE}), ' '))"
    lines = f"flatten(transform(filter(split(b, '\\\\n'), x -> trim(x) <> ''), x -> element_at(transform(array(split(trim(x), '\\\\s+')), t -> IF(size(t) > {PIECE}, {pieces}, array(x))), 1)))"
    return f"transform(filter(split({text}, '\\\\n[ \\\\t\\\\r]*\\\\n'), b -> trim(b) <> ''), b -> IF(size(split(b, '\\\\s+')) > {LONG}, {lines}, array(b)))"


def windows_of(lines: str, anchor: str) -> str:
    """SQL: (first, last, text) of each line that holds an anchor, and of those lines together that do."""
    # every line has a word, so ``TOGETHER`` lines are always enough
    count = (f"aggregate(slice(sizes, i + 1, {TOGETHER}), named_struct('n', 0, 'k', 0), "
             f"(a, x) -> IF(a.n >= {TOGETHER}, a, named_struct('n', a.n + x, 'k', a.k + 1)), a -> a.k)")
    single = "transform(filter(sequence(0, size(lines) - 1), i -> held[i]), i -> named_struct('first', i, 'last', i, 'text', lines[i]))"
    spans = f"transform(sequence(0, size(lines) - 1), i -> named_struct('first', i, 'last', i + {count} - 1))"
    several = (f"transform(filter({spans}, m -> m.last > m.first AND exists(slice(held, m.first + 1, m.last - m.first + 1), z -> z)), "
               "m -> named_struct('first', m.first, 'last', m.last, 'text', array_join(slice(lines, m.first + 1, m.last - m.first + 1), ' ')))")
    bound = (f"transform(array(named_struct('lines', {lines}, 'sizes', transform({lines}, x -> size(split(trim(x), '\\\\s+'))), "
             f"'held', transform({lines}, x -> x RLIKE {anchor}))), z -> element_at(transform(array(z.lines), lines -> element_at(transform(array(z.sizes), "
             f"sizes -> element_at(transform(array(z.held), held -> concat({single}, {several})), 1)), 1)), 1))")
    return f"element_at({bound}, 1)"


@dataclass
class Model:
    families: list[str]
    #: Intercept and weights are divided by the temperature.
    intercept: list[float]
    #: Sequence -> weight in each family.
    weights: dict[str, list[float]]
    threshold: float
    temperature: float


def _calibrate(held: DataFrame) -> tuple[float, float]:
    """Temperature and threshold from held-out rows (label, unknown, z)."""
    tried = held.select("label", "unknown", "z", F.explode(F.array(*map(F.lit, TEMPERATURES))).alias("t")).selectExpr(
        "t", "label", "unknown", "transform(z, x -> exp((x - array_max(z)) / t)) AS e").selectExpr(
        "t", "label", "unknown", "element_at(e, CAST(label AS INT) + 1) / aggregate(e, 0D, (s, x) -> s + x) AS own",
        "array_position(e, array_max(e)) - 1 AS predicted", "array_max(e) / aggregate(e, 0D, (s, x) -> s + x) AS p")
    best = tried.groupBy("t").agg(F.avg(-F.log(F.greatest("own", F.lit(1e-12)))).alias("loss")).orderBy("loss", "t").first()
    temperature = best["t"]
    named = tried.where(F.col("t") == temperature).selectExpr("label = unknown AS alike", "IF(predicted = unknown, 0D, p) AS p")
    falling = named.groupBy("alike").agg(F.sort_array(F.collect_list("p"), asc=False).alias("p")).collect()  # bounded by the notices
    probabilities = {r["alike"]: r["p"] for r in falling}
    surest = probabilities[True][int(FALSE_RATE * len(probabilities[True]))]  # the first look-alike that may not pass
    return temperature, (surest + min((p for ps in probabilities.values() for p in ps if p > surest), default=1.0)) / 2


def train(spark: SparkSession) -> Model:
    rows, number = [], 0
    for f, notices in templates().items():
        for notice in [*notices, *HEADINGS.get(f, [])]:
            rows += [(f, v, number % FOLDS) for v in variants(plain(notice))]
            number += 1
    data = _rows(spark, rows, "family string, text string, fold int").selectExpr("family", "fold", f"regexp_extract_all(lower(text), '{TOKEN}', 0) AS w").selectExpr(
        "family", "fold", f"{sequences('w')} AS sequences")
    data = StringIndexer(inputCol="family", outputCol="label", stringOrderType="alphabetAsc").fit(data).transform(data)
    vectors = CountVectorizer(inputCol="sequences", outputCol="features", binary=True, minDF=2.0).fit(data)
    data = vectors.transform(data).select("label", "fold", "features").cache()
    logistic = LogisticRegression(regParam=REGULARISATION, elasticNetParam=0.9, standardization=False, family="multinomial", maxIter=60)
    families = sorted(NOTICES)
    held = None
    for fold in range(FOLDS):
        scored = logistic.fit(data.where(f"fold <> {fold}")).transform(data.where(f"fold = {fold}"))
        scored = scored.select("label", F.lit(families.index(UNKNOWN)).alias("unknown"), vector_to_array("rawPrediction").alias("z"))
        held = scored if held is None else held.unionByName(scored)
    temperature, threshold = _calibrate(held)
    model = logistic.fit(data)
    data.unpersist()
    matrix = model.coefficientMatrix.toArray() / temperature
    weights = {s: matrix[:, k].tolist() for k, s in enumerate(vectors.vocabulary) if abs(matrix[:, k]).max() > 1e-9}
    return Model(families, (model.interceptVector.toArray() / temperature).tolist(), weights, threshold, temperature)


def version_of(family: str, text: str) -> str:
    """SQL: the version that follows the family's name in a text, null if there is none."""
    number = "[^0-9]{0,90}?([0-9]{1,2})([.][0-9]{1,2})?(?![0-9])(?!-clause)"
    later = "or any later|or later|later version|or-later|(?<=[0-9])[+]"
    cases = []
    for f, name in NAMES.items():
        found = [f"regexp_extract(lower(x), {_quoted(f'(?:{name}){number}')}, {k})" for k in (1, 2)]
        also = f"IF(lower(x) RLIKE {_quoted(later)}, '-or-later', '')" if f.endswith("gpl") else "''"
        cases.append(f"WHEN {_quoted(f)} THEN nullif(concat({found[0]}, IF({found[0]} = '' OR {found[1]} <> '', {found[1]}, '.0'), IF({found[0]} = '', '', {also})), '')")
    clauses = "nullif(regexp_extract(lower(x), '([2-4]-clause)', 1), '')"
    squeezed = f"regexp_replace({text}, {_quoted(chr(92) + 's+')}, ' ')"
    return f"element_at(transform(array({squeezed}), x -> CASE {family} {' '.join(cases)} WHEN 'bsd' THEN {clauses} END), 1)"


def scan(docs: DataFrame, model: Model) -> DataFrame:
    need(docs, "doc_id", "text")
    spark = docs.sparkSession
    k = len(model.families)
    listed = [(f, t, most) for kind, most in ((templates(), 2**31 - 1), (HEADINGS, SHORT)) for f, notices in kind.items() if f != UNKNOWN for t in notices]
    pairs = [pairs_of(t) for _, t, _ in listed]
    bound = {p: n for n, p in enumerate(sorted({p for ps in pairs for p in ps} | set(model.weights)))}
    zero = [0.0] * k
    vocabulary = _rows(spark, [(s, n, model.weights.get(s, zero)) for s, n in bound.items()], "s string, n int, w array<double>")  # bounded by the notices

    anchor = "(?i)(?<![a-z0-9])(" + "|".join(a.replace(".", "[.]") for a in ANCHORS) + ")(?![a-z0-9])"
    read = docs.select("doc_id", "text").where(F.col("text").rlike(anchor)).withColumn("row", F.monotonically_increasing_id())
    blocks = (read.select("doc_id", "row", F.expr(parts_of("text")).alias("blocks")).withColumn("sizes", F.expr("transform(blocks, b -> size(b))"))
              .select("doc_id", "row", "sizes", F.posexplode("blocks").alias("block", "lines"))
              .withColumn("before", F.expr("aggregate(slice(sizes, 1, block), 0, (s, x) -> s + x)")))
    paragraphs = blocks.select("doc_id", "row", "block", "before", F.explode(F.expr(windows_of("lines", _quoted(anchor)))).alias("x")).selectExpr(
        "doc_id", "row", "block", "before + x.first AS paragraph", "before + x.last AS last", "x.text AS text")
    tokens = paragraphs.selectExpr("doc_id", "row", "block", "paragraph", "last", "text", f"regexp_extract_all(lower(text), '{TOKEN}', 0) AS w")
    several = ", ".join(f"transform(sequence(1, greatest(size(w) - {n - 1}, 0) + 1), i -> concat_ws(' ', slice(w, i, {n})))" for n in (1, 2, 3))
    found = (tokens.selectExpr("doc_id", "row", "block", "paragraph", "last", "text", "size(w) AS words", f"explode(array_distinct(concat({several}))) AS s").join(F.broadcast(vocabulary), "s")
             .groupBy("row", "block", "paragraph", "last", "doc_id", "words").agg(F.first("text").alias("text"), F.sort_array(F.collect_set("n")).alias("has"), *(F.sum(F.col("w")[i]).alias(f"z{i}") for i in range(k))))
    # a row needs a feature of the model, not just a template's word pair
    logits = "array(" + ", ".join(f"z{i} + {model.intercept[i]!r}D" for i in range(k)) + ")"
    scored = (found.withColumn("z", F.expr(logits)).withColumn("e", F.expr("transform(z, x -> exp(x - array_max(z)))"))
              .withColumn("at", F.expr("array_position(e, array_max(e))")).withColumn("probability", F.expr("array_max(e) / aggregate(e, 0D, (s, x) -> s + x)"))
              .withColumn("predicted", F.element_at(F.array(*map(F.lit, model.families)), F.col("at").cast("int"))))
    shapes = F.expr("array(" + ", ".join(
        f"named_struct('family', {_quoted(f)}, 'template', {_quoted(plain(t))}, 'most', {most}, 'pairs', array({', '.join(str(bound[p]) for p in ps)}))"
        for (f, t, most), ps in zip(listed, pairs, strict=True)) + ")")
    best = scored.withColumn("match", F.array_max(F.transform(
        F.filter(shapes, lambda t: (t["family"] == F.col("predicted")) & (t["most"] >= F.col("words"))),
        lambda t: F.struct((F.size(F.array_intersect(t["pairs"], F.col("has"))) / F.size(t["pairs"])).alias("overlap"), t["template"].alias("template")))))
    sure = (F.col("probability") >= model.threshold) & (F.col("match.overlap") >= OVERLAP)
    best = best.where(F.expr("aggregate(z, 0D, (s, x) -> s + abs(x))") != sum(map(abs, model.intercept)))
    best = best.withColumns({"several": F.col("last") > F.col("paragraph"), "sure": F.coalesce(sure, F.lit(False))})
    # lines together count only if they are sure, none of them is so by itself, and no later window begins in them
    one = Window.partitionBy("row", "block", "predicted").orderBy("paragraph", F.desc("last")).rowsBetween(Window.currentRow, Window.unboundedFollowing)
    like = Window.partitionBy("row", "block", "predicted", "several", "sure").orderBy("paragraph")
    best = best.withColumns({"line": F.min(F.when(~F.col("several") & F.col("sure"), F.col("paragraph"))).over(one), "later": F.lead("paragraph").over(like)})
    counts = ~F.col("several") | F.expr("sure AND coalesce(line > last, true) AND coalesce(later > last, true)")
    return best.where(counts).select(
        "doc_id", "paragraph", F.when(sure, F.col("predicted")).otherwise(UNKNOWN).alias("family"), "predicted", "probability",
        F.col("match.template").alias("template"), F.coalesce("match.overlap", F.lit(0.0)).alias("overlap"),
        F.when(sure, F.expr(version_of("predicted", "text"))).alias("version"))
