"""License scans: MinHash bands over overlapping windows find templates, containment verifies them.

Shingles of five words that occur in no template can neither make a window match nor count in the
verification, so only the others are kept, with their places. Their windows are signed for each
template on the shingles in common with it, so that other templates beside it take nothing from the
similarity; bands of the signatures retrieve templates; a template is reported if enough of its
shingles, compared as text, occur in the document. DataFrame functions only.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from opsloom.llm.common import staged, unused
from opsloom.llm.decontaminate import words_of

SHINGLE_WORDS = 5
# Windows of the text and of the templates, in words.
WINDOW_WORDS, STEP = 24, 4
# Besides windows of words there is one over all shingles in common, whose similarity to the whole
# template is the share it holds: at CONTAINED or more it meets in no band with probability
# (1 - 0.75 ** ROWS) ** BANDS < 3e-9, wherever in the text the shingles are.
BANDS, ROWS = 24, 2
# Share of a template's distinct shingles a document has to hold.
CONTAINED = 0.75

# Public license notices.
TEMPLATES = {
    "MIT-notice": "Released under the MIT License.",
    "Apache-2.0-notice": "Licensed under the Apache License, Version 2.0.",
    "GPL-3.0-notice": "This work is licensed under the GNU General Public License, version 3.",
    "CC-BY-NC-4.0-notice": "Licensed under CC BY-NC 4.0.",
    "CC-BY-4.0-notice": "Licensed under CC BY 4.0.",
    "CC-BY-SA-4.0-notice": "Licensed under CC BY-SA 4.0.",
    "MIT": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        'documentation files (the "Software"), to deal in the Software without restriction, including without limitation '
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and "
        "to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above "
        "copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."
    ),
    "Apache-2.0": (
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance '
        "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless "
        "required by applicable law or agreed to in writing, software distributed under the License is distributed on an "
        '"AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the '
        "specific language governing permissions and limitations under the License."
    ),
    "GPL-3.0-or-later": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any "
        "later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without "
        "even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE."
    ),
    "BSD-3-Clause": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met: Redistributions of source code must retain the above copyright notice, this list of "
        "conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, "
        "this list of conditions and the following disclaimer in the documentation and/or other materials provided with the "
        "distribution. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or "
        "promote products derived from this software without specific prior written permission."
    ),
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies."
    ),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
        "distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."
    ),
}


def template_shingles(spark: SparkSession, templates: Mapping[str, str]) -> DataFrame:
    """``template, place, shingle``: a table as large as the list of templates, which is in the plan."""
    rows = [F.struct(F.lit(name).alias("template"), F.lit(text).alias("text")) for name, text in sorted(templates.items())]
    texts = spark.range(1).select(F.explode(F.array(*rows)).alias("t")).select("t.template", words_of(F.col("t.text")).alias("words"))
    return texts.select("template", F.explode(_shingles(F.col("words"))).alias("s")).select("template", "s.place", "s.shingle")


def _shingles(words: Column, places: Column | None = None) -> Column:
    """Places and texts of the five-word shingles; a shorter text is one shingle of all its words."""
    last = F.greatest(F.size(words) - SHINGLE_WORDS, F.lit(0))
    every = F.when(F.size(words) > 0, F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>"))
    return F.transform(
        every if places is None else places,
        lambda i: F.struct(i.alias("place"), F.array_join(F.slice(words, i + 1, SHINGLE_WORDS), " ").alias("shingle")),
    )


def _bands(placed: DataFrame, keys: list[str]) -> DataFrame:
    """``keys, band``: bands of the MinHash signatures of all placed shingles and of every window of them."""
    # Windows that hold the shingle whole; the first one also holds what lies before its end.
    least = F.greatest(F.ceil((F.col("place") + SHINGLE_WORDS - WINDOW_WORDS) / STEP), F.lit(0)).cast("int")
    held = F.sequence(least, F.floor(F.col("place") / STEP).cast("int"))
    windows = placed.select(*keys, "shingle", F.explode(F.concat(F.array(F.lit(-1)), held)).alias("window"))
    minima = [F.min(F.xxhash64(F.lit(k), "shingle")).alias(f"m{k}") for k in range(BANDS * ROWS)]
    signed = windows.groupBy(*keys, "window").agg(*minima)
    bands = [F.xxhash64(F.lit(b), *(F.col(f"m{b * ROWS + r}") for r in range(ROWS))) for b in range(BANDS)]
    return signed.select(*keys, F.explode(F.array(*bands)).alias("band")).distinct()


def license_matches(documents: DataFrame, templates: Mapping[str, str] = TEMPLATES, *, text: str = "text") -> DataFrame:
    """``row_a, row_b, template, contained, first_word``: the templates each text holds.

    Rows are told apart by two hashes of the text. ``contained`` is the share of the template's
    distinct shingles in the text, ``first_word`` the place of the first one.
    """
    spark = documents.sparkSession
    known = template_shingles(spark, templates)
    content = F.col(f"`{text}`")
    texts = documents.select(F.xxhash64(content).alias("row_a"), F.hash(content).alias("row_b"), words_of(content).alias("words"))
    # The first words of shingles are as many as the templates have words; they go into the plan.
    starts = sorted({r.word for r in known.select(F.substring_index("shingle", " ", 1).alias("word")).distinct().collect()})
    last = F.size("words") - F.least(F.size("words"), F.lit(SHINGLE_WORDS))
    every = F.when(F.size("words") > 0, F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>"))
    likely = F.filter(every, lambda i: F.get("words", i).isin(starts))
    found = texts.select("row_a", "row_b", F.explode(_shingles(F.col("words"), likely)).alias("s")).select("row_a", "row_b", "s.place", "s.shingle")
    # Bounded by the list of templates.
    hits = staged(found.join(F.broadcast(known.select("shingle").distinct()), "shingle"), "license-shingles")
    template_bands = F.broadcast(_bands(known, ["template"]))
    sizes = known.groupBy("template").agg(F.count_distinct("shingle").alias("size"))
    of_template = hits.join(F.broadcast(known.select("template", "shingle").distinct()), "shingle")
    bands = _bands(of_template, ["row_a", "row_b", "template"])
    retrieved = bands.join(template_bands, ["template", "band"], "left_semi").select("row_a", "row_b", "template").distinct()
    held = of_template.groupBy("row_a", "row_b", "template").agg(F.count_distinct("shingle").alias("n"), F.min("place").alias("first_word"))
    checked = retrieved.join(held, ["row_a", "row_b", "template"]).join(F.broadcast(sizes), "template")
    contained = F.col("n") / F.col("size")
    return checked.where(contained >= CONTAINED).select("row_a", "row_b", "template", contained.alias("contained"), "first_word")


def scan_licenses(documents: DataFrame, templates: Mapping[str, str] = TEMPLATES, *, text: str = "text") -> DataFrame:
    """``documents`` with ``licenses``, the sorted names of the templates its text holds, and ``n_licenses``.

    Null and empty texts hold none; repeated rows are scanned alike. Columns of the two names are
    replaced, all others kept.
    """
    kept = [c for c in documents.columns if c not in ("licenses", "n_licenses")]
    source = documents.select(*(F.col(f"`{c}`") for c in kept))
    one, two, listed = unused(source, "row_a", "row_b", "held_licenses")
    # Bounded by the number of templates.
    found = license_matches(source, templates, text=text).groupBy(F.col("row_a").alias(one), F.col("row_b").alias(two))
    lists = found.agg(F.sort_array(F.collect_set("template")).alias(listed))
    rows = source.withColumns({one: F.xxhash64(F.col(f"`{text}`")), two: F.hash(F.col(f"`{text}`"))})
    named = F.coalesce(listed, F.array().cast("array<string>"))
    return rows.join(lists, [one, two], "left").select(
        *(F.col(f"`{c}`") for c in kept), named.alias("licenses"), F.size(named).cast("long").alias("n_licenses")
    )
