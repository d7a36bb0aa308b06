"""License scans by MinHash over overlapping text windows (operator 6), DataFrame and SQL functions only.

Texts become words (letters and digits, lower case) and hashes of five-word shingles. Templates are
filed by window size: the least of 8, 16, 32, ... words that holds 4/3 of the template, so that with
windows starting every quarter of their size some window holds a whole occurrence. A window that
shares no shingle with any template cannot be similar to one (a bit filter and an exact join tell); the
others get one minimum hash per band, and a band that a template shares retrieves it.

With 64 bands of one row a window of similarity s retrieves a template with probability
1 - (1 - s)^64. The least similarity of a window that holds 80 % of a template is above 0.15 (a
template fills at least 3/8 of its window), so that probability is at least 0.99997.

A candidate is verified exactly: at least 80 % of the template's distinct shingles must occur in the
window or half a window beside it.

Defined results: null texts and texts of fewer than five words match nothing; a template of fewer
than five words matches nothing; repeated rows give repeated results; texts that share an id are
one license, found when any of them is, and reported with the one found best (by containment, then size,
then text); an empty table gives no rows. The result has a row per document and license found.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from skyledger.llm.common import register, staged, table

SHINGLE = 5
BANDS = 64
CONTAINED = 0.8
SMALLEST_WINDOW = 8
_BITS_EACH = 256                 # bits of the filter for each shingle of a template

# License statements, the opening of license notices and paragraphs of their bodies, by SPDX-like id.
TEMPLATES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0-notice", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance "
                          "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("BSD-notice", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
                   "the following conditions are met:"),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0-notice", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
                       "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("MIT", "Released under the MIT License."),
    ("MIT-notice", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
                   "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation "
                   "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software"),
    # paragraphs of license bodies, each found without the opening
    ("BSD-notice", "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. "
                   "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following "
                   "disclaimer in the documentation and/or other materials provided with the distribution."),
    ("BSD-notice", "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, "
                   "BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED."),
    ("MIT-notice", "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."),
    ("MIT-notice", "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF "
                   "MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE "
                   "LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN "
                   "CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that "
            "the above copyright notice and this permission notice appear in all copies."),
    ("Apache-2.0-notice", "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "
                          "\"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific "
                          "language governing permissions and limitations under the License."),
    ("GPL-3.0-notice", "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of "
                       "MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details."),
]


def templates(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(TEMPLATES, "license_id string, text string")


def _words(text):
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def _shingles(words):
    """Hashes of all five-word shingles, in text order (none for shorter texts)."""
    count = F.size(words) - (SHINGLE - 1)
    return F.when(count > 0, F.transform(F.sequence(F.lit(1), count), lambda i: F.xxhash64(F.slice(words, i, SHINGLE)))).otherwise(
        F.array().cast("array<bigint>"))


def _minima(shingles):
    """The least hash of each band."""
    return F.array(*[F.array_min(F.transform(shingles, _hashed(b))) for b in range(BANDS)])


def _hashed(band: int):
    return lambda h: F.xxhash64(h, F.lit(band))


def _prepared(licenses: DataFrame) -> DataFrame:
    """template (a number), license_id, the text's distinct shingles, window size and minima. The templates are a stated set."""
    words = licenses.select("license_id", "text").distinct().withColumn("template", F.row_number().over(Window.orderBy("license_id", "text"))) \
        .withColumn("words", _words(F.col("text")))
    doublings = F.ceil(F.log2(F.size("words") * 4 / (3 * F.lit(SMALLEST_WINDOW))) - F.lit(1e-9))
    size = (F.lit(SMALLEST_WINDOW) * F.pow(F.lit(2.0), F.greatest(F.lit(0), doublings))).cast("int")
    return words.select("template", "license_id", F.array_distinct(_shingles(F.col("words"))).alias("of_template"), size.alias("size")).filter(
        "size(of_template) > 0").withColumn("minima", _minima(F.col("of_template")))


def scan(docs: DataFrame, licenses: DataFrame, id_col: str = "doc_id", text_col: str = "text", contained: float = CONTAINED) -> DataFrame:
    """doc_id, license_id, shingles (of the template), found (most in one place), containment, first_word (of the first place)."""
    prepared = staged(_prepared(licenses), "license-templates")
    seeds, sizes = _seed_filter(prepared)
    texts = docs.select(F.col(id_col).alias("doc_id"), F.monotonically_increasing_id().alias("row"), _words(F.col(text_col)).alias("words"))
    texts = texts.withColumn("shingles", _shingles(F.col("words"))).drop("words")
    at = F.filter(F.transform("shingles", lambda h, i: F.when(seeds(h), F.struct(h.alias("h"), i.alias("seed")))), lambda x: x.isNotNull())
    seeded = staged(texts.withColumn("seeds", at).filter("size(seeds) > 0"), "license-seeds")
    known = prepared.select(F.explode("of_template").alias("h")).distinct()
    true_seeds = seeded.select("row", F.explode("seeds").alias("s")).select("row", "s.h", "s.seed").join(known, "h", "left_semi")
    # windows of every size in use that hold a seed; they start at multiples of a quarter of their size
    starts = true_seeds.select("row", "seed").withColumn("size", F.explode(F.lit(sizes).cast("array<int>"))).select(
        "row", "size", F.explode(F.expr("sequence(greatest(0, ceil((seed - size + 5) * 4 / size)), floor(seed * 4 / size))")).alias("k"))
    windows = starts.distinct().select("row", "size", (F.col("k") * F.col("size") / 4).cast("int").alias("start"))
    begin = F.greatest(F.lit(0), F.col("start") - (F.col("size") / 2).cast("int"))
    near = F.slice("shingles", begin + 1, (F.col("start") - begin + F.col("size") * 1.5).cast("int") - (SHINGLE - 1))
    # a window goes on with its own words and half a window on either side, not with its document
    windows = staged(windows.join(seeded.select("doc_id", "row", "shingles"), "row").select(
        "doc_id", "row", "size", "start", begin.alias("begin"), near.alias("near")), "license-windows")
    windows = windows.withColumn("minima", _minima(F.slice("near", F.col("start") - F.col("begin") + 1, F.col("size") - (SHINGLE - 1))))
    bands = windows.select("row", "size", "start", F.posexplode("minima").alias("band", "value"))
    filed = prepared.select("template", "size", F.posexplode("minima").alias("band", "value"))
    candidates = bands.join(filed, ["size", "band", "value"]).select("row", "size", "start", "template").distinct()
    verified = candidates.join(windows.select("doc_id", "row", "size", "start", "begin", "near"), ["row", "size", "start"]).join(
        prepared.select("template", "license_id", "of_template"), "template")
    verified = verified.withColumn("found", F.size(F.array_intersect("of_template", "near"))).withColumn(
        "shingles", F.size("of_template")).filter(F.col("found") >= F.lit(contained) * F.col("shingles"))
    first = F.array_min(F.filter(F.transform("near", lambda h, i: F.when(F.array_contains("of_template", h), i)), lambda i: i.isNotNull()))
    texts_found = verified.withColumn("first_word", F.col("begin") + first).groupBy("doc_id", "row", "license_id", "template").agg(
        F.first("shingles").cast("long").alias("shingles"), F.max("found").cast("long").alias("found"), F.min("first_word").cast("long").alias("first_word"))
    best = F.max(F.struct((F.col("found") / F.col("shingles")).alias("share"), "shingles", (-F.col("template")).alias("place"), "found", "first_word")).alias("b")
    return texts_found.groupBy("doc_id", "row", "license_id").agg(best).select(
        "doc_id", "license_id", "b.shingles", "b.found", F.round("b.share", 6).alias("containment"), "b.first_word")


def _seed_filter(prepared: DataFrame):
    """(a test that holds for all shingles of all templates and for one in _BITS_EACH^2 of others, the window
    sizes in use). The templates are a stated set: _BITS_EACH bits for each of their shingles enter the
    plan as a constant, and at most 30 sizes."""
    hashes = [r["h"] for r in prepared.select(F.explode("of_template").alias("h")).distinct().collect()]
    bits = 64
    while bits < _BITS_EACH * len(hashes):
        bits *= 2
    filled = [0] * (bits // 64)
    for h in hashes:
        for place in (h % bits, (h >> 32) % bits):
            filled[place // 64] |= 1 << place % 64
    words = F.expr("array(" + ", ".join(f"{w - (1 << 64) if w >> 63 else w}L" if w != 1 << 63 else "-9223372036854775807L - 1L" for w in filled) + ")")

    def has(place):
        return F.getbit(F.get(words, F.shiftright(place, 6).cast("int")), F.pmod(place, F.lit(64)).cast("int")) == 1

    sizes = sorted(r["size"] for r in prepared.select("size").distinct().collect())
    return (lambda h: has(F.pmod(h, F.lit(bits))) & has(F.pmod(F.shiftright(h, 32), F.lit(bits)))), sizes


@register("op6_license_scan")
def op6_license_scan(spark, sf_dir):
    return scan(table(spark, sf_dir, "documents"), templates(spark))
