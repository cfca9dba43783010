"""License scans (operator 7), with DataFrame functions only.

A text is normalised to words of a-z and 0-9 and compared with licence templates
by the Dice coefficient 2 |A and B| / (|A| + |B|) over word bigrams, wherever a
licence may stand in it: A is a window of neighbouring bigrams that begins at a
bigram of the template and is as long as the template, a fifth shorter or a
quarter longer. B is a set; a window counts the template's bigrams once and any
other bigram as often as it stands there.

A coefficient of at least t needs t / (2 - t) times |B| of the template's bigrams.
That size bound prunes templates for each document before any window is made; the
bigrams get there by an equi-join with the (small, fixed) table of templates.

Of the windows of one template that begin within half a template's length the best
is kept, of equal ones the first, then the shortest. Between templates each word
goes to the best window over it (the greater coefficient, then the longer template,
then alphabetical order), and windows that hold at least half of their words are
returned.

Defined cases: null text counts as empty; texts of fewer than two words have no
bigram and match nothing. Rows with one id (or a null id) and different texts are
scanned apart; repeated rows of one id and text count as one. Other columns are
ignored; whole texts are read. Empty tables give no rows.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from furrow.llm.common import read_table

THRESHOLD = 0.8
#: Lengths of windows, as shares of the template's.
LENGTHS = (0.8, 1.0, 1.25)

_MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
_ISC = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""
_BSD = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."""
_BSD_THIRD = """3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."""
_BSD_END = """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
_APACHE = """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."""
_GPL = """This program is free software: you can redistribute it and/or modify it under the terms of the GNU {0}General Public License as published by the Free Software Foundation, either version {1} of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU {0}General Public License for more details. You should have received a copy of the GNU {0}General Public License along with this program. If not, see https://www.gnu.org/licenses/."""
_UNLICENSE = """This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means. In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright interest in the software to the public domain."""
_ZLIB = """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions: 1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required. 2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software. 3. This notice may not be removed or altered from any source distribution."""
_CC = "This work is licensed under a Creative Commons {} 4.0 International License."
_GNU = "This work is licensed under the GNU {}, version {}."

#: Licence templates by name: fixed values, the public wording of licences, of notices and of one-line references.
TEMPLATES = {
    "AGPL-3.0 notice": _GPL.format("Affero ", 3),
    "Apache-2.0 notice": _APACHE,
    "Apache-2.0 reference": "Licensed under the Apache License, Version 2.0.",
    "BSD-2-Clause text": f"{_BSD} {_BSD_END}",
    "BSD-3-Clause reference": "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
    "BSD-3-Clause text": f"{_BSD} {_BSD_THIRD} {_BSD_END}",
    "CC-BY-4.0 reference": _CC.format("Attribution"),
    "CC-BY-NC-4.0 reference": "Licensed under CC BY-NC 4.0.",
    "CC-BY-NC-4.0 sentence": _CC.format("Attribution-NonCommercial"),
    "CC-BY-ND-4.0 sentence": _CC.format("Attribution-NoDerivatives"),
    "CC-BY-SA-4.0 reference": "Licensed under CC BY-SA 4.0.",
    "CC-BY-SA-4.0 sentence": _CC.format("Attribution-ShareAlike"),
    "GPL-2.0 notice": _GPL.format("", 2),
    "GPL-2.0 reference": _GNU.format("General Public License", 2),
    "GPL-3.0 notice": _GPL.format("", 3),
    "GPL-3.0 reference": _GNU.format("General Public License", 3),
    "ISC text": _ISC,
    "LGPL-2.1 notice": _GPL.format("Lesser ", "2.1"),
    "LGPL-3.0 notice": _GPL.format("Lesser ", 3),
    "MIT reference": "Released under the MIT License.",
    "MIT text": _MIT,
    "MPL-2.0 notice": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
    "Proprietary notice": "All rights reserved. No part of this work may be reproduced without written permission of the copyright holder.",
    "Unlicense text": _UNLICENSE,
    "Zlib text": _ZLIB,
}
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def template_words(text: str) -> list[str]:
    return re.findall("[a-z0-9]+", text.translate(str.maketrans(_UPPER, _UPPER.lower())))


def template_rows(templates: dict[str, str]) -> list[tuple[str, int, list[int], str, str]]:
    """Rows (license, number of distinct bigrams, lengths of windows, first and second word of a bigram)."""
    rows = []
    for name, text in sorted(templates.items()):
        w = template_words(text)
        pairs = sorted(set(zip(w, w[1:], strict=False)))
        lengths = sorted({max(1, int((len(w) - 1) * x + 0.5)) for x in LENGTHS})
        rows += [(name, len(pairs), lengths, a, b) for a, b in pairs]
    return rows


def _words(text: Column) -> Column:
    return F.split(F.trim(F.lower(F.regexp_replace(text, "[^A-Za-z0-9]+", " "))), " ")


def scan(docs: DataFrame, templates: dict[str, str] = TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """Rows (doc_id, license, start_word, end_word, dice): the licences found in docs (doc_id, text); ends are exclusive."""
    spark = docs.sparkSession
    table = spark.createDataFrame(template_rows(templates), "license string, t_size int, lengths array<int>, a string, b string")
    table = F.broadcast(table.select("license", F.xxhash64("a", "b").alias("bigram")))  # as many rows as templates have bigrams
    meta = F.broadcast(spark.createDataFrame(sorted({(n, t, *[tuple(x)]) for n, t, x, _, _ in template_rows(templates)}), "license string, t_size int, lengths array<int>"))
    own = ["row", "doc_id", "license"]

    # a row for each bigram that some template has: made and tested one by one inside one generated loop. (An explode
    # of the words themselves, or a filter on their number, would split each text once more.)
    read = docs.select("doc_id", F.xxhash64("doc_id", "text").alias("row"), _words(F.coalesce("text", F.lit(""))).alias("w"))
    n = F.size("w") - 1
    each = read.select("doc_id", "row", n.alias("n"), F.inline(F.arrays_zip(F.col("w").alias("first"), F.slice("w", F.lit(2), F.greatest(n, F.lit(0))).alias("second"), F.sequence(F.lit(0), n).alias("pos"))))
    met = each.select("doc_id", "row", "n", "pos", F.xxhash64("first", "second").alias("bigram"), "second").join(table, "bigram").where("second is not null")
    hits = met.groupBy(*own).agg(F.first("n").alias("n"), F.collect_set(F.struct("pos", "bigram")).alias("hits"), F.size(F.collect_set("bigram")).alias("kinds"))
    likely = hits.join(meta, "license").where((2 - threshold) * F.col("kinds") >= threshold * F.col("t_size") - 1e-9)

    spread = likely.select(*own, "n", "t_size", F.explode("lengths").alias("length"), "hits").select(*own, "n", "t_size", "length", F.inline("hits"))
    # positions over the length: a window is whatever lies less than 1 further on
    over = "OVER (PARTITION BY row, doc_id, license, length ORDER BY pos / cast(length AS double) RANGE BETWEEN CURRENT ROW AND 0.999999999D FOLLOWING)"
    seen = spread.select("*", F.expr(f"size(collect_set(bigram) {over})").alias("both"), F.expr(f"count(*) {over}").alias("stand"), F.expr(f"max(pos) {over}").alias("last"))
    size = F.col("both") + F.least("length", F.col("n") - F.col("pos")) - F.col("stand")
    windows = seen.withColumn("dice", F.lit(2.0) * F.col("both") / (size + F.col("t_size"))).where(F.col("dice") >= threshold)

    rank = "struct(-dice AS d, pos AS p, length AS l)"
    near = f"min({rank}) OVER (PARTITION BY row, doc_id, license ORDER BY pos / cast(t_size AS double) RANGE BETWEEN 0.500000001D PRECEDING AND 0.500000001D FOLLOWING)"
    best = windows.select(*own, "t_size", "pos", "length", "last", "dice", F.expr(near).alias("top")).where("top = struct(-dice AS d, pos AS p, length AS l)")

    place = F.struct((-F.col("dice")).alias("d"), (-F.col("t_size")).alias("t"), "license", "pos", "last")
    words = best.select("row", "doc_id", place.alias("place"), F.explode(F.sequence("pos", "last")).alias("word"))
    won = words.groupBy("row", "doc_id", "word").agg(F.min("place").alias("place")).groupBy("row", "doc_id", "place").count()
    kept = won.where(2 * F.col("count") >= F.col("place.last") - F.col("place.pos") + 1)
    return kept.select("doc_id", F.col("place.license").alias("license"), F.col("place.pos").alias("start_word"), (F.col("place.last") + 2).alias("end_word"), (-F.col("place.d")).alias("dice"))


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(read_table(spark, sf_dir, "documents"))


def op7_sql(templates: dict[str, str] = TEMPLATES) -> str:
    """The same in SQL, over strings in place of hashes and with windows by a join of hits."""
    values = ", ".join(f"('{n}', '{a} {b}', {t}, {x})" for n, t, x, a, b in template_rows(templates))
    t = THRESHOLD
    return f"""
    WITH tg(license, bigram, t_size, lengths) AS (VALUES {values}),
    docs AS (SELECT row_number() OVER () AS id, doc_id, text FROM (SELECT DISTINCT doc_id, coalesce(text, '') AS text FROM documents)),
    read AS (SELECT id, doc_id, string_split(trim(regexp_replace(translate(text, '{_UPPER}', '{_UPPER.lower()}'), '[^a-z0-9]+', ' ', 'g')), ' ') AS w FROM docs),
    grams AS (SELECT id, doc_id, len(w) - 1 AS n, unnest(range(0, len(w) - 1)) AS pos, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS bigram FROM read),
    met AS (SELECT * FROM grams JOIN tg USING (bigram)),
    likely AS (SELECT id, license FROM met GROUP BY id, license, t_size HAVING (2 - {t}) * count(DISTINCT bigram) >= {t} * t_size - 1e-9),
    hits AS (SELECT met.* FROM met SEMI JOIN likely USING (id, license)),
    starts AS (SELECT id, doc_id, license, n, t_size, pos, unnest(lengths) AS length FROM hits),
    seen AS (
        SELECT s.id, s.doc_id, s.license, s.n, s.t_size, s.pos, s.length, count(DISTINCT h.bigram) AS both_n, count(*) AS stand, max(h.pos) AS last
        FROM starts s JOIN hits h ON h.id = s.id AND h.license = s.license AND h.pos BETWEEN s.pos AND s.pos + s.length - 1 GROUP BY ALL),
    windows AS (SELECT *, 2.0::DOUBLE * both_n / (both_n + least(length, n - pos) - stand + t_size) AS dice FROM seen),
    good AS (SELECT * FROM windows WHERE dice >= {t}),
    best AS (
        SELECT * FROM good g WHERE NOT EXISTS (
            SELECT 1 FROM good o WHERE o.id = g.id AND o.license = g.license AND 2 * abs(o.pos - g.pos) <= g.t_size
            AND (o.dice > g.dice OR o.dice = g.dice AND (o.pos < g.pos OR o.pos = g.pos AND o.length < g.length)))),
    words AS (SELECT *, unnest(range(pos, last + 1)) AS word FROM best),
    won AS (SELECT *, row_number() OVER (PARTITION BY id, word ORDER BY dice DESC, t_size DESC, license, pos) AS place FROM words),
    kept AS (SELECT id, doc_id, license, pos, last, dice FROM won WHERE place = 1 GROUP BY ALL HAVING 2 * count(*) >= last - pos + 1)
    SELECT doc_id, license, pos::INTEGER AS start_word, (last + 2)::INTEGER AS end_word, dice FROM kept"""
