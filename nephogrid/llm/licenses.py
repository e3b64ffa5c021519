"""License scans: a trained passage classifier whose predictions are confirmed against templates.

A text is its sequence of words, so a notice reads the same in one line of prose and wrapped at any width. Passages of a few sizes, which overlap so
that every notice lies whole in one of them, are sets of word uni- and bigrams. Multinomial logistic regression with an L1 share, so a sparse one,
tells licence families from each other and from an unknown class; it is fitted on the families' notices, whole and with words left out, and on prose
and other licences that use the same words. The level a prediction must reach is calibrated on texts that share no notice with those. A prediction
stands if enough of a template of its family is in the passage, no other family's template fits better, and the family's version is named.
Everything on the way over the documents is a DataFrame function; n-grams one of which any such passage must hold leave few passages to score.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass
from functools import reduce

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import CountVectorizerModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from nephogrid.llm._common import ascii_lower, let

#: Notices by which licences name themselves, by family. The names and notices are fixed values.
TEMPLATES = {
    "apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License.",
        "Apache License Version 2.0, January 2004",
        "SPDX-License-Identifier: Apache-2.0",
    ),
    "mit": (
        "Released under the MIT License.",
        "The MIT License (MIT)",
        "This project is licensed under the terms of the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
        "SPDX-License-Identifier: MIT",
    ),
    "gpl-2.0": (
        "This work is licensed under the GNU General Public License, version 2.",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License version 2 as published by the Free Software Foundation",
        "GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version",
        "SPDX-License-Identifier: GPL-2.0-only",
        "SPDX-License-Identifier: GPL-2.0-or-later",
    ),
    "gpl-3.0": (
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License version 3 as published by the Free Software Foundation",
        "GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version",
        "SPDX-License-Identifier: GPL-3.0-only",
        "SPDX-License-Identifier: GPL-3.0-or-later",
    ),
    "lgpl-2.1": (
        "Licensed under the GNU Lesser General Public License, version 2.1.",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License version 2.1",
        "GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version",
        "SPDX-License-Identifier: LGPL-2.1-only",
        "SPDX-License-Identifier: LGPL-2.1-or-later",
    ),
    "lgpl-3.0": (
        "Licensed under the GNU Lesser General Public License, version 3.",
        "GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version",
        "SPDX-License-Identifier: LGPL-3.0-only",
        "SPDX-License-Identifier: LGPL-3.0-or-later",
    ),
    "agpl-3.0": (
        "Licensed under the GNU Affero General Public License, version 3.",
        "GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version",
        "SPDX-License-Identifier: AGPL-3.0-only",
        "SPDX-License-Identifier: AGPL-3.0-or-later",
    ),
    "mpl-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "Licensed under the Mozilla Public License, version 2.0.",
        "SPDX-License-Identifier: MPL-2.0",
    ),
    "isc": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted",
        "Released under the ISC License.",
        "SPDX-License-Identifier: ISC",
    ),
    "bsd-2-clause": (
        "Released under the 2-Clause BSD License.",
        "Licensed under the Simplified BSD License.",
        "SPDX-License-Identifier: BSD-2-Clause",
    ),
    "bsd-3-clause": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted",
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software",
        "Released under the 3-Clause BSD License.",
        "SPDX-License-Identifier: BSD-3-Clause",
    ),
    "cc0-1.0": (
        "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
        "Licensed under CC0 1.0 Universal, a public domain dedication.",
        "SPDX-License-Identifier: CC0-1.0",
    ),
    "unlicense": (
        "This is free and unencumbered software released into the public domain.",
        "SPDX-License-Identifier: Unlicense",
    ),
    "cc-by-nc-4.0": (
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ),
    "cc-by-sa-4.0": (
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    ),
    "cc-by-4.0": (
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ),
    "all-rights-reserved": (
        "Copyright. All rights reserved.",
        "No part of this publication may be reproduced without the prior written permission of the publisher.",
    ),
}
#: What tells a family from its neighbours: of these one must be in a passage that names it. Fixed values.
VERSIONS = {
    "apache-2.0": ("version 2.0", "version 2", "license 2.0", "apache-2.0", "v2.0", "v 2.0"),
    "gpl-2.0": ("version 2", "version 2.0", "license 2", "gpl-2.0", "gpl-2.0-only", "gpl-2.0-or-later", "v2"),
    "gpl-3.0": ("version 3", "version 3.0", "license 3", "gpl-3.0", "gpl-3.0-only", "gpl-3.0-or-later", "v3"),
    "lgpl-2.1": ("version 2.1", "license 2.1", "lgpl-2.1", "lgpl-2.1-only", "lgpl-2.1-or-later", "v2.1"),
    "lgpl-3.0": ("version 3", "version 3.0", "license 3", "lgpl-3.0", "lgpl-3.0-only", "lgpl-3.0-or-later", "v3"),
    "agpl-3.0": ("version 3", "version 3.0", "license 3", "agpl-3.0", "agpl-3.0-only", "agpl-3.0-or-later", "v3"),
    "mpl-2.0": ("version 2.0", "version 2", "v 2.0", "v2.0", "license 2.0", "mpl-2.0"),
    "cc-by-nc-4.0": ("by-nc 4.0", "attribution-noncommercial 4.0", "cc-by-nc-4.0"),
    "cc-by-sa-4.0": ("by-sa 4.0", "attribution-sharealike 4.0", "cc-by-sa-4.0"),
    "cc-by-4.0": ("by 4.0", "attribution 4.0", "cc-by-4.0"),
}
#: And one of these: names that would otherwise be part of each other.
NAMES = {
    "gpl-2.0": ("gnu general", "gpl-2.0", "gpl-2.0-only", "gpl-2.0-or-later"),
    "gpl-3.0": ("gnu general", "gpl-3.0", "gpl-3.0-only", "gpl-3.0-or-later"),
    "lgpl-2.1": ("lesser general", "lgpl-2.1", "lgpl-2.1-only", "lgpl-2.1-or-later"),
    "lgpl-3.0": ("lesser general", "lgpl-3.0", "lgpl-3.0-only", "lgpl-3.0-or-later"),
    "agpl-3.0": ("affero general", "agpl-3.0", "agpl-3.0-only", "agpl-3.0-or-later"),
}
#: Around a BSD notice: the clause that makes it the licence of four clauses, the second clause, and the third.
FOUR_CLAUSES, SECOND_CLAUSE, THIRD_CLAUSE = "advertising materials", "the documentation", "neither the"
#: Prose that shares words with the notices and names no licence, and licences of no family here.
OTHER = (
    "The driver had a license but the car was not permitted on the road.",
    "Version 3 of the report was released under pressure from the public.",
    "The Apache helicopter landed near the village.",
    "She works at MIT and studies the history of public libraries.",
    "In general the work is free and open to any person with permission.",
    "You may not use this door except in case of fire.",
    "A copy of the source is kept in the museum without charge.",
    "The terms of the contract were granted in a written form.",
    "All seats are reserved for the international visitors.",
    "This program is on the air at four and this work is hard.",
    "The gnu is a large animal of the plains.",
    "Please cc me by mail at 4 or by phone.",
    "The creative team shares the common room of the publisher.",
    "Binary stars and their use in source counts.",
    "the of and in to is that it for was on are with as",
    "The license plate was under the bridge.",
    "The software was released into the hands of its first users without warranty.",
    "The author has waived the fee for students of law.",
    "The Mozilla office has moved to another city.",
    "Neither the name of the street nor the number was known.",
    "The general public was invited to the affair by the foundation.",
    "He published the second version of his book at his own option.",
    "Any purpose will do with or without a plan.",
    "The identifier of the parcel is on the back, clause 2 and clause 3 apply.",
    "Licensed under the Apache License, Version 1.1.",
    "Licensed under the Artistic License 2.0.",
    "Licensed under the Eclipse Public License, version 2.0.",
    "Licensed under the Boost Software License, Version 1.0.",
    "Released under the zlib License.",
    "Released under the PostgreSQL License.",
    "Permission is granted to copy, distribute and/or modify this document under the terms of the GNU Free Documentation License, version 1.3.",
    "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License.",
    "Licensed under the European Union Public Licence, version 1.2.",
    "Licensed under the Common Development and Distribution License, version 1.0.",
    "SPDX-License-Identifier: Zlib",
    "SPDX-License-Identifier: EPL-2.0",
    "SPDX-License-Identifier: NOASSERTION",
    "The licence is valid for two years and the fee is not returned.",
)
#: Texts the level is calibrated on: other wordings than the above, with the family or "unknown".
CALIBRATION = (
    ("apache-2.0", "The code is made available under the Apache License, Version 2.0"),
    ("mit", "MIT License"),
    ("mit", "This package is distributed under the MIT License, see the file"),
    ("gpl-2.0", "The driver may be used under the GNU General Public License version 2"),
    ("gpl-3.0", "The game is released under the GNU General Public License version 3"),
    ("lgpl-2.1", "The plugin is under the GNU Lesser General Public License version 2.1"),
    ("lgpl-3.0", "It may be linked under the GNU Lesser General Public License version 3"),
    ("agpl-3.0", "The server is under the GNU Affero General Public License version 3"),
    ("mpl-2.0", "Portions fall under the Mozilla Public License version 2.0"),
    ("isc", "It is distributed under the ISC License"),
    ("bsd-2-clause", "Available under the 2-Clause BSD License"),
    ("bsd-3-clause", "Available under the 3-Clause BSD License"),
    ("cc0-1.0", "The data are under CC0 1.0 Universal"),
    ("cc-by-nc-4.0", "The pictures are under CC BY-NC 4.0"),
    ("cc-by-sa-4.0", "The map is under CC BY-SA 4.0"),
    ("cc-by-4.0", "The figures are under CC BY 4.0"),
    ("all-rights-reserved", "All rights reserved by the author"),
    ("unknown", "Her fishing license and permit were granted by the county office."),
    ("unknown", "The report covers general software terms and free lunches."),
    ("unknown", "Under the bridge the public waited for the author of the book."),
    ("unknown", "The library may be used by any person without charge."),
    ("unknown", "Copies of the document are with the publisher in written form."),
    ("unknown", "The bus driver's licence has been revoked for a year."),
    ("unknown", "Distributed under the Academic Free License version 3.0"),
    ("unknown", "Licensed under the Open Data Commons Attribution License"),
)
UNKNOWN = "unknown"


#: Runs of letters and digits, with dots and hyphens inside.
WORDS = r"[a-z0-9]+(?:[.\-][a-z0-9]+)*"


def grams(text: Column) -> Column:
    """Distinct word uni- and bigrams; words are runs of letters, digits, dots and hyphens inside them, A-Z lower-cased."""
    found = F.regexp_extract_all(ascii_lower(text), F.lit(WORDS), F.lit(0))

    def both(w: Column) -> Column:
        pairs = F.when(F.size(w) > 1, F.transform(F.sequence(F.lit(1), F.size(w) - 1), lambda i: F.concat_ws(" ", F.get(w, i - 1), F.get(w, i))))
        return F.array_distinct(F.concat(w, F.coalesce(pairs, F.array().cast("array<string>"))))

    return let(found, both)


@dataclass(frozen=True)
class LicenseModel:
    vectors: CountVectorizerModel
    logistic: LogisticRegressionModel
    level: float  # least probability of a prediction


def _training_rows() -> list[tuple[str, float]]:
    """(text, class): each notice whole, with every fifth or seventh word left out from different beginnings, and beside a line of prose."""
    rows = []
    for y, texts in enumerate([OTHER, *TEMPLATES.values()]):
        for n, text in enumerate(texts):
            w = text.split()
            rows += [(text, float(y)), (text.lower(), float(y)), (f"{OTHER[n % 24]} {text}", float(y))]
            for k in (5, 7):
                rows += [(" ".join(x for i, x in enumerate(w) if i % k != at), float(y)) for at in range(min(k, len(w)) if y else 1)]
    return rows


def fit(spark: SparkSession) -> LicenseModel:
    """The model of the families above. The level lies midway between the least probable right prediction and the most probable wrong one of a
    family on the calibration texts, and between 0.5 and 0.9."""
    names = [UNKNOWN, *TEMPLATES]
    rows = [(t, y, False) for t, y in _training_rows()] + [(t, float(names.index(f)), True) for f, t in CALIBRATION]
    terms = sorted({t for text, _ in _training_rows() for t in phrase_grams(text)})
    df = spark.createDataFrame(rows, "text string, label double, apart boolean").coalesce(1).withColumn("grams", grams(F.col("text")))
    vectors = CountVectorizerModel.from_vocabulary(terms, inputCol="grams", outputCol="features", minTF=0.0).setBinary(True)
    df = vectors.transform(df)
    model = LogisticRegression(family="multinomial", maxIter=60, regParam=0.001, elasticNetParam=0.5).fit(df.where("not apart"))
    scored = model.transform(df.where("apart")).select("label", "prediction", "probability").collect()
    right = [max(r["probability"]) for r in scored if r["label"] and r["label"] == r["prediction"]]
    wrong = [max(r["probability"]) for r in scored if r["prediction"] and r["label"] != r["prediction"]]
    level = min(0.9, max(0.5, (min(right, default=0.5) + max(wrong, default=0.0)) / 2))
    return LicenseModel(vectors, model, level)


#: Words of every text, which the screen does without where it can.
COMMON = (
    "the of and to in a is it for as or not at are be with from by any all no may can you this that its into your use used under one made part two public work general road village "
    "free new either without project program law library person code file files copy source author fee terms written possible purpose"
).split()


def anchors(phrase: str, confirm: float) -> list[str]:
    """So many n-grams of a phrase that whatever holds the ``confirm``-th part of all of them holds one of these; those least like prose are taken."""
    own = phrase_grams(phrase)
    plain = lambda g: sum(w in COMMON for w in g.split(" ")) / len(g.split(" "))
    by_worth = sorted(own, key=lambda g: (" " not in g, plain(g), -len(g)))
    return by_worth[: len(own) - math.ceil(confirm * len(own) - 1e-9) + 1]


#: Words of a passage; of each size passages begin at every fourth of it, so three fourths are whole in one of them wherever they stand.
SIZES = (6, 12, 24, 48)
#: Words on either side in which clauses are looked for.
CONTEXT = 200
#: What the next size has to add to the overlap.
SIZE_COSTS = 0.03


def words_of(text: Column) -> Column:
    """Array of struct(w, line): the words of a text, A-Z lower-cased, with their lines from 0."""
    lines = F.split(ascii_lower(F.coalesce(text, F.lit(""))), "\n")
    return F.flatten(F.transform(lines, lambda x, i: F.transform(F.regexp_extract_all(x, F.lit(WORDS), F.lit(0)), lambda w: F.struct(w.alias("w"), i.alias("line")))))


def passages(at: Column) -> Column:
    """Array of struct(start, size): all passages, in words, that hold a word of ``at`` (an array of places)."""

    def around(i: Column) -> Column:
        every = []
        for size in SIZES:
            step = size // 4
            every += [F.struct(((F.floor(i / step) - back) * step).cast("int").alias("start"), F.lit(size).alias("size")) for back in range(-(-size // step))]
        return F.filter(F.array(*every), lambda p: p["start"] >= 0)

    return F.array_distinct(F.flatten(F.transform(at, around)))


def _bigram(w: Column, i: Column) -> Column:
    return F.concat_ws(" ", F.get(w, i)["w"], F.get(w, i + 1)["w"])


def scan(docs: DataFrame, model: LicenseModel | None = None, confirm: float = 0.6, screen: bool = True) -> DataFrame:
    """(doc_id, paragraph, lines, family, probability, overlap, text): the passages of (doc_id, text) that name a licence, lower-cased words.

    A text is its words, however it is wrapped, and passages of 6, 12, 24 and 48 of them are judged. ``overlap`` is the largest share of a template's
    n-grams of the predicted family that the passage holds, which must reach ``confirm`` and that of every other family; the passage must say the
    family's name and version where those tell it from others. The four-clause BSD licence is no family; the third clause tells the other two apart, where the second is
    there. From its first to its last n-gram that is typical of the family is its notice; a passage is given if none of its family whose notice
    meets its own is worth more (the overlap, less SIZE_COSTS for each size up), or as much with a shorter notice, a shorter passage or an earlier one.
    ``paragraph`` is the line, from 0, where the notice begins, ``lines`` the number of its lines.

    Null and empty texts have no passages; repeated rows each give theirs; an empty table gives an empty result; other columns are ignored. Passages
    without any of the templates' ``anchors`` cannot reach ``confirm``, so ``screen`` leaves them out before the model sees them and changes nothing.
    """
    m, names = model or fit(docs.sparkSession), list(TEMPLATES)
    typical = {f: sorted({a for t in ts for a in anchors(t, confirm)}) for f, ts in TEMPLATES.items()}
    telling = sorted({a for own in typical.values() for a in own})
    runs = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), words_of(F.col("text")).alias("words"))  # numbered before they are cut
    places = F.when(F.size("words") > 0, F.sequence(F.lit(0), F.size("words") - 1))
    told = lambda w: lambda i: (F.get(w, i)["w"].isin(*telling) | _bigram(w, i).isin(*telling)) if screen else F.lit(True)
    runs = runs.withColumn("at", F.filter(places, told(F.col("words")))).where(F.size("at") > 0)
    runs = runs.select("row", "doc_id", "words", F.explode(passages(F.col("at"))).alias("p"))
    cut = lambda start, size: F.transform(F.slice("words", F.greatest(start, F.lit(0)) + 1, size), lambda x: x["w"])
    start, size = F.col("p.start"), F.col("p.size")
    clauses = let(F.array_join(cut(start - CONTEXT, size + 2 * CONTEXT), " "), lambda t: F.struct(*[t.contains(c).alias(n) for n, c in (("four", FOUR_CLAUSES), ("second", SECOND_CLAUSE), ("third", THIRD_CLAUSE))]))
    runs = runs.select("row", "doc_id", start.alias("start"), size.alias("size"), F.slice("words", start + 1, size).alias("words"), clauses.alias("clauses")).withColumn("text", F.array_join(F.transform("words", lambda x: x["w"]), " "))
    scored = m.logistic.transform(m.vectors.transform(runs.withColumn("grams", grams(F.col("text")))))
    scored = scored.withColumn("probability", F.array_max(vector_to_array("probability"))).where((F.col("prediction") > 0) & (F.col("probability") >= m.level))
    shares = []
    for phrases in TEMPLATES.values():
        own = [F.array(*[F.lit(g) for g in phrase_grams(t)]) for t in phrases]
        each = [F.size(F.array_intersect("grams", x)) / F.size(x) for x in own]
        shares.append(F.greatest(*each) if len(each) > 1 else each[0])
    y = F.col("prediction").cast("int")
    scored = scored.select("row", "doc_id", "start", "size", "words", "text", "grams", "clauses", "probability", y.alias("y"), F.array(*shares).alias("shares"))
    scored = scored.withColumn("overlap", F.get("shares", F.col("y") - 1)).where((F.col("overlap") >= confirm) & (F.col("overlap") >= F.array_max("shares") - 1e-9))
    any_of = lambda grams_: F.arrays_overlap("grams", F.array(*map(F.lit, grams_)))
    family, sound = F.get(F.array(*map(F.lit, names)), F.col("y") - 1), F.lit(True)
    for f, asked in [*VERSIONS.items(), *NAMES.items()]:
        sound = sound & ((F.col("family") != f) | any_of(asked))
    sound = sound & ~(F.col("family").startswith("bsd-") & F.col("clauses.four"))
    two = (family == "bsd-3-clause") & F.col("clauses.second") & ~F.col("clauses.third")
    scored = scored.withColumn("family", family).where(sound).withColumn("family", F.when(two, "bsd-2-clause").otherwise(family))
    told = lambda i: reduce(lambda a, b: a | b, [(F.col("y") == k) & (F.get("words", i)["w"].isin(*typical[f]) | _bigram(F.col("words"), i).isin(*typical[f])) for k, f in enumerate(names, 1)])
    scored = scored.withColumn("own", F.filter(F.sequence(F.lit(0), F.size("words") - 1), told))
    low, high = F.get("own", F.lit(0)), F.least(F.element_at("own", -1) + 1, F.size("words") - 1)
    line = lambda i: F.get("words", i)["line"].cast("long")
    worth = F.round(F.col("overlap") - SIZE_COSTS * F.log2(F.col("size") / SIZES[0]), 9)
    scored = scored.select("row", "doc_id", "start", "size", "text", "family", "probability", "overlap", worth.alias("worth"), (F.col("start") + low).alias("low"), (F.col("start") + high).alias("high"), line(low).alias("paragraph"), (line(high) - line(low) + 1).alias("lines"))
    # passages that share a word begin fewer than the largest size apart: some hundred at most
    near = Window.partitionBy("row", "family").orderBy("start").rangeBetween(1 - SIZES[-1], SIZES[-1] - 1)
    scored = scored.withColumn("near", F.collect_list(F.struct("start", "size", "worth", "low", "high")).over(near))

    def better(x: Column) -> Column:
        shared = (x["low"] <= F.col("high")) & (F.col("low") <= x["high"])
        first = lambda low, high, size, start: F.struct((high - low).alias("length"), size.alias("size"), start.alias("start"))
        tighter = first(x["low"], x["high"], x["size"], x["start"]) < first(F.col("low"), F.col("high"), F.col("size"), F.col("start"))
        return shared & ((x["worth"] > F.col("worth")) | ((x["worth"] == F.col("worth")) & tighter))

    return scored.where(~F.exists("near", better)).select("doc_id", "paragraph", "lines", "family", "probability", "overlap", "text")


def phrase_grams(text: str) -> list[str]:
    """``grams`` of one of the fixed phrases."""
    w = re.findall(WORDS, text.lower())
    return list(dict.fromkeys([*w, *(f"{a} {b}" for a, b in zip(w, w[1:], strict=False))]))
