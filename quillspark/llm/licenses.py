"""Licence scans: a trained paragraph classifier, confirmed by templates.

Paragraphs become sparse counts of the word n-grams that occur in licence
templates. A multinomial logistic regression with a class of its own for everything
that is none of the families is trained on variants of the templates, on notices of
licences outside the families, and on a bounded sample of paragraphs that resemble no
template; a temperature fitted on held-out variants calibrates its probabilities. A
paragraph is reported if the calibrated probability of a family is high enough and
its n-grams agree most with a template of that family; a licence of the unknown
class is reported as ``unknown``. Everything runs as DataFrame operations inside the JVM.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import CountVectorizerModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillspark.functions.text import compute_once, let
from quillspark.llm.common import written

# Notices and opening paragraphs of public licences, by family.
TEMPLATES: dict[str, list[str]] = {
    "apache-2.0": [
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in '
        "compliance with the License. You may obtain a copy of the License at",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is "
        'distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. '
        "See the License for the specific language governing permissions and limitations under the License.",
        "Licensed under the Apache License, Version 2.0.",
        "This project is released under the Apache License 2.0.",
        "Licensed under Apache 2.0.",
        "Licensed under the Apache-2.0 license.",
        "SPDX-License-Identifier: Apache-2.0",
    ],
    "mit": [
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        'documentation files (the "Software"), to deal in the Software without restriction, including without '
        "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of "
        "the Software, and to permit persons to whom the Software is furnished to do so, subject to the following "
        "conditions:",
        "The above copyright notice and this permission notice shall be included in all copies or substantial "
        "portions of the Software.",
        "Released under the MIT License.",
        "This project is licensed under the terms of the MIT license.",
        'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT '
        "LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN "
        "NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, "
        "WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE "
        "SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
        "Licensed under the MIT license.",
        "MIT licensed.",
        "SPDX-License-Identifier: MIT",
    ],
    "gpl": [
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version.",
        "You should have received a copy of the GNU General Public License along with this program. If not, see",
        "This work is licensed under the GNU General Public License, version 3.",
        "Released under the GNU General Public License, version 2 or later.",
        "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even "
        "the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public "
        "License for more details.",
        "Licensed under the GPL version 2.",
        "Licensed under GPLv3.",
        "SPDX-License-Identifier: GPL-2.0-only",
        "SPDX-License-Identifier: GPL-3.0-or-later",
    ],
    "lgpl": [
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser "
        "General Public License as published by the Free Software Foundation; either version 2.1 of the License, or "
        "(at your option) any later version.",
        "This work is licensed under the GNU Lesser General Public License, version 3.",
        "You should have received a copy of the GNU Lesser General Public License along with this library. If "
        "not, see",
        "Licensed under the LGPL version 2.1 or later.",
        "SPDX-License-Identifier: LGPL-2.1-or-later",
    ],
    "bsd": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
        "the following conditions are met:",
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the "
        "following disclaimer.",
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
        "products derived from this software without specific prior written permission.",
        "Released under the BSD 3-Clause License.",
        "Licensed under the 2-clause BSD license.",
        'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED '
        "WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A "
        "PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR "
        "ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT "
        "LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS "
        "INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY.",
        "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and "
        "the following disclaimer in the documentation and/or other materials provided with the distribution.",
        "BSD licensed.",
        "SPDX-License-Identifier: BSD-3-Clause",
        "SPDX-License-Identifier: BSD-2-Clause",
    ],
    "mpl-2.0": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was "
        "not distributed with this file, You can obtain one at",
        "Licensed under the Mozilla Public License, version 2.0.",
        "Licensed under MPL 2.0.",
        "SPDX-License-Identifier: MPL-2.0",
    ],
    "cc-by": [
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
        "Licensed under CC BY 4.0.",
        "This content is available under the Creative Commons Attribution License.",
        "SPDX-License-Identifier: CC-BY-4.0",
    ],
    "cc-by-sa": [
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
        "Licensed under CC BY-SA 4.0.",
        "Text is available under the Creative Commons Attribution-ShareAlike License.",
        "SPDX-License-Identifier: CC-BY-SA-4.0",
    ],
    "cc-by-nc": [
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
        "Licensed under CC BY-NC 4.0.",
        "Available under the Creative Commons Attribution-NonCommercial License.",
        "SPDX-License-Identifier: CC-BY-NC-4.0",
    ],
    "cc0": [
        "To the extent possible under law, the author has waived all copyright and related or neighboring rights to "
        "this work.",
        "Released into the public domain under CC0 1.0 Universal.",
        "Licensed under CC0 1.0.",
        "SPDX-License-Identifier: CC0-1.0",
    ],
    "agpl": [
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
        "Affero General Public License as published by the Free Software Foundation, either version 3 of the "
        "License, or (at your option) any later version.",
        "You should have received a copy of the GNU Affero General Public License along with this program. If "
        "not, see",
        "This work is licensed under the GNU Affero General Public License, version 3.",
        "Licensed under the AGPL version 3.",
        "SPDX-License-Identifier: AGPL-3.0-or-later",
    ],
    "isc": [
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
        "hereby granted, provided that the above copyright notice and this permission notice appear in all "
        "copies.",
        'THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE '
        "INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS.",
        "Released under the ISC License.",
        "This project is licensed under the terms of the ISC license.",
        "SPDX-License-Identifier: ISC",
    ],
    "cc-by-nd": [
        "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License.",
        "Licensed under CC BY-ND 4.0.",
        "Available under the Creative Commons Attribution-NoDerivatives License.",
        "SPDX-License-Identifier: CC-BY-ND-4.0",
    ],
    "cc-by-nc-sa": [
        "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International "
        "License.",
        "Licensed under CC BY-NC-SA 4.0.",
        "Available under the Creative Commons Attribution-NonCommercial-ShareAlike License.",
        "SPDX-License-Identifier: CC-BY-NC-SA-4.0",
    ],
    "cc-by-nc-nd": [
        "This work is licensed under a Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 "
        "International License.",
        "Licensed under CC BY-NC-ND 4.0.",
        "Available under the Creative Commons Attribution-NonCommercial-NoDerivatives License.",
        "SPDX-License-Identifier: CC-BY-NC-ND-4.0",
    ],
    "unlicense": [
        "This is free and unencumbered software released into the public domain.",
        "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in "
        "source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any "
        "means.",
        "Released under the Unlicense.",
        "SPDX-License-Identifier: Unlicense",
    ],
}
# Notices of licences outside the families; they teach the unknown class what a licence of its own looks like.
OTHERS: list[str] = [
    "This program and the accompanying materials are made available under the terms of the Eclipse Public "
    "License 2.0 which accompanies this distribution.",
    "Licensed under the EUPL, version 1.2 only.",
    "The contents of this file are subject to the terms of the Common Development and Distribution License.",
    "This Font Software is licensed under the SIL Open Font License, Version 1.1.",
    "Released under the NCSA Open Source License.",
    "Released under the Artistic License 2.0.",
    "Released under the zlib License.",
    "Released under the PostgreSQL License.",
    "Licensed under the Boost Software License, version 1.0.",
    "Licensed under the Python Software Foundation License.",
    "This software is licensed under the Microsoft Public License.",
    "Licensed under the Open Database License, version 1.0.",
    "This software is proprietary and confidential. Unauthorized copying of this file, via any medium, is "
    "strictly prohibited.",
    "All rights reserved. No part of this publication may be reproduced without the prior permission of the "
    "publisher.",
    "Use of this software is governed by the Business Source License, version 1.1.",
    "Released under the terms of our commercial license.",
    "This project is licensed under the terms of the Elastic License.",
    "This work is licensed under the Free Art License, version 1.3.",
    "SPDX-License-Identifier: EPL-2.0",
    "SPDX-License-Identifier: Zlib",
    "SPDX-License-Identifier: Artistic-2.0",
    "SPDX-License-Identifier: LicenseRef-Proprietary",
]
# A paragraph of the unknown class without any of these is no licence.
MARKERS = ("license", "licence", "licensed", "licenced", "spdx", "copyright", "permission", "rights", "proprietary")
# The words that tell one family from its relatives.
NAMES = (
    "apache", "mit", "affero", "agpl", "gpl", "gplv3", "lesser", "lgpl", "bsd", "mozilla", "mpl", "isc", "unlicense",
    "cc", "cc0", "by", "sa", "nc", "nd", "attribution", "sharealike", "noncommercial", "noderivatives",
)
FAMILIES = sorted(TEMPLATES)
# The last class, which also wins ties of agreement.
UNKNOWN = float(len(FAMILIES))
LABELLED = [(i, t) for i, f in enumerate(FAMILIES) for t in TEMPLATES[f]] + [(int(UNKNOWN), t) for t in OTHERS]
GRAMS = (1, 2, 3)
ODDMENTS = "the of and a to in is you for it this work file copy version terms see at".split()


def words_of(text: Column) -> Column:
    """Lower-case words and numbers."""
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+", -1), lambda w: w != "")


def grams_of(words: Column, sizes=GRAMS, known: list[str] | None = None) -> Column:
    """The n-grams of a word array, as strings.

    With ``known`` words, only the n-grams of those: others are no features, and
    most places of ordinary text are passed over without making a string.
    """
    def all_of(w: Column) -> Column:
        def of(n: int) -> Column:
            at = F.filter(
                F.transform(w, lambda x, i: i),
                lambda i: reduce(lambda a, b: a & b, [F.coalesce(F.get(w, i + k), F.lit("")) != "" for k in range(n)]),
            )
            return F.transform(at, lambda i: F.concat_ws(" ", *[F.get(w, i + k) for k in range(n)]))

        return F.concat(*[of(n) for n in sizes])

    if known is not None:
        words = F.transform(words, lambda x: F.when(x.isin(known), x).otherwise(F.lit("")))
    return let(words, all_of)


def paragraphs(docs: DataFrame, *, id: str, text: str, separator: str) -> DataFrame:
    """(id, paragraph, body) of the paragraphs that hold a word character."""
    return docs.select(
        F.col(id).alias("id"), F.posexplode(F.split(F.coalesce(text, F.lit("")), separator, -1)).alias("paragraph", "body")
    ).filter(F.col("body").rlike(r"[\p{L}\p{N}]"))


def variants(spark: SparkSession, copies: int = 24, others: bool = False) -> DataFrame:
    """(label, held_out, words): the templates and ``copies`` damaged variants of each; with ``others`` those of OTHERS.

    Words are dropped, replaced by oddments and cut off at both ends, by hashes of
    the variant's number: about one word in twelve each. Words of ``NAMES`` are spared
    unless cut off, for a notice without its name is another family's notice ("CC BY-NC"
    without "NC") and its label would be wrong. A third is held out.
    """
    rows = [r for r in LABELLED if (r[0] == int(UNKNOWN)) == others]
    base = spark.createDataFrame(rows, "label int, text string")
    n = F.col("copy")
    odd = F.array(*map(F.lit, ODDMENTS))
    roll = lambda i, salt: F.pmod(F.xxhash64(F.lit(salt), "text", n, i), F.lit(1200)) / 1200.0
    damaged = F.transform(
        F.col("w"),
        lambda w, i: F.when((n == 0) | w.isin(*NAMES), w).when(roll(i, "drop") < 0.08, F.lit("")).when(
            roll(i, "odd") < 0.08, F.element_at(odd, (roll(i, "which") * len(ODDMENTS)).cast("int") + 1)).otherwise(w),
    )
    cut = F.floor(F.size("w") * 0.15 * roll(F.lit(-1), "cut")).cast("int")
    return (
        base.select("label", "text", words_of(F.col("text")).alias("w"))
        .withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(copies))))
        .withColumn("d", F.when(n == 0, F.col("w")).otherwise(F.filter(damaged, lambda w: w != "")))
        .withColumn("d", F.when(n == 0, F.col("d")).otherwise(F.slice("d", cut + 1, F.greatest(F.size("d") - 2 * cut, F.lit(2)))))
        .select(
            F.col("label").cast("double").alias("label"),
            (F.pmod(F.xxhash64("text", n), F.lit(3)) == 0).alias("held_out"), F.col("d").alias("words"))
    )


@dataclass
class LicenceModel:
    vectors: CountVectorizerModel
    model: LogisticRegressionModel
    temperature: float


def _template_grams(spark: SparkSession) -> DataFrame:
    """(family, grams) of every template: its word pairs and triples."""
    return spark.createDataFrame(LABELLED, "family int, text string").select(
        "family", F.array_distinct(grams_of(words_of(F.col("text")), (2, 3))).alias("grams"))


def _vocabulary(spark: SparkSession) -> list[str]:
    """All n-grams of the templates: a few thousand strings, by the fixed list above."""
    grams = spark.createDataFrame(LABELLED, "family int, text string").select(
        F.explode(grams_of(words_of(F.col("text")))).alias("g")).distinct()
    return sorted(r["g"] for r in grams.collect())


def _agreement(spark: SparkSession) -> Column:
    """(similarity, family) of the best template: the share of the paragraph's or the template's n-grams that are shared."""
    rows = _template_grams(spark).collect()
    return let(F.array_distinct(grams_of(F.col("words"), (2, 3))), lambda p: F.array_max(F.array(*[
        F.struct(
            (F.size(F.array_intersect(p, F.array(*map(F.lit, r["grams"])))) / F.least(
                F.greatest(F.size(p), F.lit(1)), F.lit(len(r["grams"])))).alias("similarity"),
            F.lit(r["family"]).alias("family"),
        ) for r in rows
    ])))


def _softmax(temperature: Column | float) -> Column:
    """Class probabilities from the raw margins in ``raw``."""
    t = temperature if isinstance(temperature, Column) else F.lit(float(temperature))
    most = F.array_max("raw")
    total = F.aggregate(F.col("raw"), F.lit(0.0), lambda a, x: a + F.exp((x - most) / t))
    return F.transform(F.col("raw"), lambda x: F.exp((x - most) / t) / total)


def train(
    docs: DataFrame, *, id: str = "doc_id", text: str = "text", separator: str = r"\n", bound: int = 4_000,
    copies: int = 24,
) -> LicenceModel:
    """Fit the classifier; about ``bound`` paragraphs of ``docs``, by a hash, teach the unknown class.

    Only paragraphs that share under a quarter of their n-grams with every
    template do, so unlabelled licences in the corpus are not taught as unknown.
    An empty corpus leaves a handful of oddments for that class.
    """
    spark = docs.sparkSession
    vocabulary = _vocabulary(spark)
    vectors = CountVectorizerModel.from_vocabulary(vocabulary, inputCol="grams", outputCol="features")
    known = [g for g in vocabulary if " " not in g]
    rows = docs.count()
    share = min(1.0, bound / max(rows, 1))
    # One paragraph of each chosen document.
    picked = docs.filter(
        F.pmod(F.xxhash64(F.lit("licences"), id), F.lit(1 << 20)) < F.lit(int(share * (1 << 20))))
    lines = F.filter(F.split(F.coalesce(text, F.lit("")), separator, -1), lambda x: x.rlike(r"[\p{L}\p{N}]"))
    unlike = (
        picked.select(F.xxhash64(text).alias("h"), lines.alias("lines")).filter(F.size("lines") > 0)
        .select("h", words_of(F.get("lines", F.pmod(F.col("h"), F.size("lines")).cast("int"))).alias("words"))
    )
    unlike = (
        compute_once(unlike, "agreement", _agreement(spark)).filter("agreement.similarity < 0.25")
        .select(F.lit(UNKNOWN).alias("label"), (F.pmod("h", F.lit(3)) == 0).alias("held_out"), "words")
    )
    oddments = spark.createDataFrame([(UNKNOWN, i % 3 == 0, ODDMENTS[i:]) for i in range(12)], "label double, held_out boolean, words array<string>")
    data = variants(spark, copies).union(variants(spark, copies, others=True)).union(unlike).union(oddments).withColumn("grams", grams_of(F.col("words"), known=known))
    data = written(vectors.transform(data).select("label", "held_out", "features"), "licence-training").coalesce(4)
    logistic = LogisticRegression(
        family="multinomial", regParam=0.002, elasticNetParam=0.3, maxIter=60, standardization=False)
    model = logistic.fit(data.filter("NOT held_out"))
    scored = model.transform(data.filter("held_out")).select(
        F.col("label").cast("int").alias("label"), vector_to_array("rawPrediction").alias("raw"))
    grid = [0.25, 0.35, 0.5, 0.7, 1.0, 1.4, 2.0, 2.8]
    losses = scored.select(*[
        F.avg(-F.log(F.greatest(F.get(_softmax(t), F.col("label")), F.lit(1e-12)))).alias(str(i)) for i, t in enumerate(grid)
    ]).first()
    best = min(range(len(grid)), key=lambda i: losses[i] if losses[i] is not None else 0.0)
    return LicenceModel(vectors, model, grid[best])


def scan(
    docs: DataFrame, model: LicenceModel, *, id: str = "doc_id", text: str = "text", separator: str = r"\n",
    at: float = 0.5, agree: float = 0.4,
) -> DataFrame:
    """(id, paragraph, family, probability, similarity): a row per licence paragraph.

    ``paragraph`` counts from 0 in the text split by ``separator``. A paragraph is
    reported when the calibrated probability of its best family is ``at`` or more
    and it shares ``agree`` of its word pairs and triples, or of a template's,
    with the closest template, which must be of that family. A paragraph of the
    unknown class is reported as ``unknown`` if it holds a word of ``MARKERS`` and its
    closest template is a licence outside the families; of a list of several SPDX
    identifiers the closest one counts. Null, empty and
    wordless texts have none; null ids and repeated rows are reported as they
    come; other columns are ignored; an empty table gives no rows.
    """
    spark = docs.sparkSession
    rows = paragraphs(docs, id=id, text=text, separator=separator).select(
        "id", "paragraph", words_of(F.col("body")).alias("words"))
    known = [g for g in model.vectors.vocabulary if " " not in g]
    featured = model.vectors.transform(compute_once(rows, "grams", grams_of(F.col("words"), known=known)))
    # A paragraph without any n-gram of a template agrees with none, whatever its class.
    scored = model.model.setProbabilityCol("").setPredictionCol("").transform(
        featured.filter(F.size("grams") > 0).select("id", "paragraph", "words", "features"))
    raw = compute_once(
        scored.select("id", "paragraph", "words", vector_to_array("rawPrediction").alias("margins")), "raw", F.col("margins"),
    ).withColumn("family", (F.array_position("raw", F.array_max("raw")) - 1).cast("int")).filter(
        (F.col("family") != int(UNKNOWN)) | F.exists("words", lambda w: w.isin(*MARKERS)))
    likely = raw.withColumn("probability", F.get(_softmax(model.temperature), F.col("family"))).filter(
        F.col("probability") >= at)
    judged = compute_once(likely, "closest", _agreement(spark))
    names = F.array(*map(F.lit, [*FAMILIES, "unknown"]))
    return judged.filter(
        (F.col("closest.similarity") >= agree) & (F.col("closest.family") == F.col("family"))
    ).select(
        F.col("id").alias(id), F.col("paragraph").cast("long").alias("paragraph"),
        F.element_at(names, F.col("family") + 1).alias("family"), "probability",
        F.col("closest.similarity").alias("similarity"),
    )
