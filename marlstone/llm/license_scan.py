"""License scans: MinHash bands over overlapping windows, then exact shingle containment.

Texts and templates become lower-cased words (runs of a-z and 0-9) and shingles of five words.
Templates are put in length classes; the windows of a class are half as long again as its
longest template and start every half of that length, so any occurrence lies whole in a
window. Windows are signed by MinHash; a template is retrieved where a band of ``rows`` minima
agrees. The number of bands follows from the smallest Jaccard similarity that a window with
``containment`` of a template can have, so that retrieval succeeds with at least
``probability``. Retrieved pairs are verified by the exact share of the template's shingles
that the window holds.

A band can only agree where the window holds the shingles that are the template's minima in it.
A window without any of these minima collides in no band, so it is not signed; the bands decide
all the same. The minima are one literal: templates times bands times rows numbers at most.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import SPACE_CHARS, materialise, text_or_empty

SHINGLE = 5
_MIT_GRANT = "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software"
_BSD_LIST = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:
1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."""
_BSD_END = """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
#: Public licenses as published, without their copyright lines; whole texts, then notices and grants.
TEMPLATES = {
    "MIT": _MIT_GRANT + """, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:
The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
    "ISC": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.
THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.""",
    "BSD-2-Clause": _BSD_LIST + "\n" + _BSD_END,
    "BSD-3-Clause": _BSD_LIST + "\n3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.\n" + _BSD_END,
    "Zlib": """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software.
Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:
1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required.
2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.
3. This notice may not be removed or altered from any source distribution.""",
    "BSL-1.0": """Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license (the "Software") to use, reproduce, display, distribute, execute, and transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the Software is furnished to do so, all subject to the following:
The copyright notices in the Software and this entire statement, including the above license grant, this restriction and the following disclaimer, must be included in all copies of the Software, in whole or in part, and all derivative works of the Software, unless such copies or derivative works are solely in the form of machine-executable object code generated by a source language processor.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE, TITLE AND NON-INFRINGEMENT. IN NO EVENT SHALL THE COPYRIGHT HOLDERS OR ANYONE DISTRIBUTING THE SOFTWARE BE LIABLE FOR ANY DAMAGES OR OTHER LIABILITY, WHETHER IN CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
    "Unlicense": """This is free and unencumbered software released into the public domain.
Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.""",
    "MIT-notice": "Released under the MIT License.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "Apache-2.0-short": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0": """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0
Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.""",
    "GPL-3.0-notice": "This work is licensed under the GNU General Public License, version 3.",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-SA-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    "MIT-grant": _MIT_GRANT,
    "BSD-grant": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    "GPL": """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.
This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.""",
    "GPL-grant": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation",
}


def template_words(text: str) -> list[str]:
    return re.findall(r"[a-z0-9]+", text.lower())


def bands_needed(jaccard: float, rows: int, probability: float) -> int:
    """Bands of ``rows`` minima for a pair of this similarity to collide with this probability."""
    return math.ceil(math.log(1 - probability) / math.log(1 - jaccard**rows))


def length_classes(templates: dict[str, str]) -> list[dict]:
    """Templates by length, each class up to a quarter longer than the one before: names, longest, window, step."""
    by: dict[int, list[str]] = {}
    for name, text in templates.items():
        by.setdefault(math.ceil(math.log(len(template_words(text)), 1.25)), []).append(name)
    out = []
    for names in (by[k] for k in sorted(by)):
        longest = max(len(template_words(templates[n])) for n in names)
        out.append({"names": names, "longest": longest, "window": longest + -(-longest // 2), "step": -(-longest // 2)})
    return out


def least_jaccard(words: int, window: int, containment: float) -> float:
    """Of a template with so many words and a window that holds ``containment`` of its shingles."""
    m, w = words - SHINGLE + 1, window - SHINGLE + 1
    common = math.ceil(containment * m)
    return common / (w + m - common)


def word_array(text: Column) -> Column:
    plain = F.btrim(F.regexp_replace(F.lower(text_or_empty(text)), "[^a-z0-9]+", " "), F.lit(SPACE_CHARS))
    return F.when(plain == "", F.array().cast("array<string>")).otherwise(F.split(plain, " "))


def shingle_hashes(w: Column) -> Column:
    last = F.greatest(F.size(w) - (SHINGLE - 1), F.lit(0))
    return F.transform(F.slice(w, F.lit(1), last), lambda x, i: F.xxhash64(x, *[F.get(w, i + k) for k in range(1, SHINGLE)]))


def _bands(shingles: Column, bands: int, rows: int) -> Column:
    """Keys of the bands: each a hash of ``rows`` minima over differently seeded hashes of the shingles."""

    def smallest(j: Column) -> Column:
        return F.array_min(F.transform(shingles, lambda s: F.xxhash64(j, s)))

    if rows == 1:
        return F.transform(F.sequence(F.lit(0), F.lit(bands - 1)), smallest)
    return F.transform(F.sequence(F.lit(0), F.lit(bands - 1)), lambda b: F.xxhash64(F.transform(F.sequence(b * rows, b * rows + (rows - 1)), smallest)))


def _minima(shingles: Column, bands: int, rows: int) -> Column:
    """The shingles that are the minima of the bands."""

    def smallest(j: Column) -> Column:
        return F.array_min(F.transform(shingles, lambda s: F.struct(F.xxhash64(j, s).alias("h"), s.alias("s"))))["s"]

    return F.array_distinct(F.transform(F.sequence(F.lit(0), F.lit(bands * rows - 1)), smallest))


def template_table(spark: SparkSession, templates: dict[str, str]) -> DataFrame:
    """license, shingles: one row per template."""
    names, texts = list(templates), [" ".join(template_words(t)) for t in templates.values()]
    at = F.col("id").cast("int")
    rows = spark.range(len(names)).select(F.get(F.split(F.lit("\n".join(names)), "\n"), at).alias("license"), F.get(F.split(F.lit("\n".join(texts)), "\n"), at).alias("text"))
    return rows.select("license", word_array(F.col("text")).alias("w")).select("license", F.array_distinct(shingle_hashes(F.col("w"))).alias("shingles"))


def _numbers(numbers: list[int]) -> Column:
    return F.split(F.lit(",".join(map(str, numbers))), ",").cast("array<bigint>") if numbers else F.array().cast("array<bigint>")  # folded to one literal


def license_scan(docs: DataFrame, templates: dict[str, str] | None = None, containment: float = 0.75, rows: int = 1, probability: float = 0.99999) -> DataFrame:
    """One row per document: doc_id, licenses (names by order of name, comma-joined), n_licenses, containment.

    ``containment`` is the largest verified share, 0 without a match. Null, empty and short
    texts match nothing. Repeated rows are each scanned, null ids are passed through, extra
    columns are ignored. Templates of fewer than five words are refused.
    """
    templates = TEMPLATES if templates is None else templates
    if any(len(template_words(t)) < SHINGLE for t in templates.values()):
        raise ValueError("a template needs five words")
    spark = docs.sparkSession
    classes = length_classes(templates)
    of_class = {n: i for i, c in enumerate(classes) for n in c["names"]}
    bands = max((bands_needed(least_jaccard(len(template_words(templates[n])), c["window"], containment), rows, probability) for c in classes for n in c["names"]), default=1)
    table = template_table(spark, templates).select("license", _minima(F.col("shingles"), bands, rows).alias("minima")).collect()  # one row per template
    minima = [sorted({s for t in table if of_class[t.license] == i for s in t.minima}) for i in range(len(classes))]
    known = _numbers(sorted({s for m in minima for s in m}))
    marked = docs.select("doc_id", F.monotonically_increasing_id().alias("row_no"), word_array(F.col("text")).alias("w"))  # a column of its own: it is used once a word below
    marked = marked.select("doc_id", "row_no", shingle_hashes(F.col("w")).alias("s"))
    marked = materialise(marked.select("doc_id", "row_no", F.when(F.arrays_overlap("s", known), F.col("s")).alias("s")), "license-marked")

    shapes = F.array(*[F.struct(F.lit(i).alias("class"), F.lit(c["window"]).alias("window"), F.lit(c["step"]).alias("step"), _numbers(minima[i]).alias("minima")) for i, c in enumerate(classes)])
    windows = marked.where("s IS NOT NULL").select("row_no", "s", F.explode(shapes).alias("c")).where(F.arrays_overlap("s", "c.minima"))
    windows = windows.select("row_no", "s", "c", F.explode(F.sequence(F.lit(0), F.size("s"), F.col("c.step"))).alias("start"))
    windows = windows.select("row_no", "c", F.array_distinct(F.slice("s", F.col("start") + 1, F.col("c.window") - (SHINGLE - 1))).alias("held"))
    windows = windows.where(F.arrays_overlap("held", "c.minima")).select("row_no", "c.class", "held")
    signed = windows.select("row_no", "class", "held", F.posexplode(_bands(F.col("held"), bands, rows)).alias("band", "key"))
    number = F.element_at(F.create_map(*[F.lit(x) for pair in of_class.items() for x in pair]), F.col("license"))
    keys = template_table(spark, templates).select("license", "shingles", number.alias("t_class"), F.posexplode(_bands(F.col("shingles"), bands, rows)).alias("t_band", "t_key"))
    on = (F.col("class") == F.col("t_class")) & (F.col("band") == F.col("t_band")) & (F.col("key") == F.col("t_key"))
    hits = signed.join(F.broadcast(keys), on)  # templates x bands rows
    share = F.size(F.array_intersect("held", "shingles")) / F.size("shingles")
    found = hits.select("row_no", "license", share.alias("share")).where(F.col("share") >= containment)
    best = found.groupBy("row_no", "license").agg(F.max("share").alias("share"))
    best = best.groupBy("row_no").agg(F.array_join(F.sort_array(F.collect_list("license")), ",").alias("licenses"), F.count("*").alias("n_licenses"), F.max("share").alias("containment"))
    out = marked.select("doc_id", "row_no").join(best, "row_no", "left")
    return out.select("doc_id", F.coalesce("licenses", F.lit("")).alias("licenses"), F.coalesce("n_licenses", F.lit(0)).alias("n_licenses"), F.coalesce("containment", F.lit(0.0)).alias("containment"))
