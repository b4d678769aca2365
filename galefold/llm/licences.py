"""Licence scan: normalised text against licence templates by the Dice coefficient over word bigrams.

Units of a text are its lines, its blocks of two lines and more between blank lines, the whole text, and
windows: as many consecutive words as a template has, wherever they begin and however their lines break.
A unit and a template can only reach ``percent`` if the numbers of their distinct bigrams lie within
``percent : 200 - percent`` of each other; units outside these bounds of every template are pruned before
their bigrams are spread, and pairs outside before they are scored.

Windows are anchored. A window that reaches ``percent`` shares so many bigrams with its template that it
can miss only a few, so of one more than that many (the longest ones, as they are rare: ``anchors``) it has
one. Wherever an anchor occurs, the window that puts it to its place in the template is scored; of each
document and template the best window is given, the first of equals.

So has every unit that reaches ``percent``. The first stage therefore only looks for anchors: texts without one
are done, the others, few in most corpora, are written and scanned for units and windows.

The templates (fixed in this module or given, a few thousand bigrams) are broadcast. Line ends may be LF, CRLF
or CR.

Edge cases: null texts and units of fewer than two words give nothing. Copies of a row are scanned row by
row but share results (rows with equal ids and units are one, null ids too). Texts of any length are scanned
whole. An empty table gives an empty result. Extra columns are ignored.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from galefold.llm.shared import Scratch

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# Notices and texts of public licences.
TEMPLATES = [
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "This project is licensed under the terms of the MIT license."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:"),
    ("MIT", "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("Apache-2.0", "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"),
    ("BSD-3-Clause", "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."),
    ("LGPL-2.1", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version."),
    ("LGPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("AGPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("GPL", "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details."),
    ("EPL-2.0", "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0/"),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."),
    ("BSD-2-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."),
    ("Zlib", "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions: 1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required. 2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software. 3. This notice may not be removed or altered from any source distribution."),
    ("BSL-1.0", "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license (the \"Software\") to use, reproduce, display, distribute, execute, and transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the Software is furnished to do so, all subject to the following: The copyright notices in the Software and this entire statement, including the above license grant, this restriction and the following disclaimer, must be included in all copies of the Software, in whole or in part, and all derivative works of the Software, unless such copies or derivative works are solely in the form of machine-executable object code generated by a source language processor."),
    ("Unlicense", "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means. In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright interest in the software to the public domain. We make this dedication for the benefit of the public at large and to the detriment of our heirs and successors. We intend this dedication to be an overt act of relinquishment in perpetuity of all present and future rights to this software under copyright law."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."),
]


def words(text: Column) -> Column:
    """Lower-case runs of a-z and 0-9 (case folding of A-Z alone)."""
    return F.regexp_extract_all(F.translate(text, UPPER, LOWER), F.lit("[a-z0-9]+"), F.lit(0))


def bigrams(own: str) -> Column:
    """Distinct bigrams of an array of words, as one string each."""
    # Both slices are made once; a lambda that named the array itself would make it anew for each element.
    pairs = F.zip_with(F.slice(own, F.lit(1), F.size(own) - 1), F.slice(own, F.lit(2), F.size(own) - 1), lambda a, b: F.concat(a, F.lit(" "), b))
    return F.when(F.size(own) >= 2, F.array_distinct(pairs))


@dataclass(frozen=True)
class Template:
    number: int
    licence: str
    words: list[str]

    @property
    def places(self) -> list[str]:
        return [f"{a} {b}" for a, b in zip(self.words, self.words[1:], strict=False)]

    @property
    def pairs(self) -> list[str]:
        return list(dict.fromkeys(self.places))

    def anchors(self, percent: int) -> list[tuple[int, str]]:
        """(place, bigram) of the bigrams of which every window that reaches ``percent`` has one."""
        needed = -(-percent * len(self.pairs) // (200 - percent))
        chosen = set(sorted(self.pairs, key=lambda x: (-len(x), x))[: len(self.pairs) - needed + 1])
        return [(i, x) for i, x in enumerate(self.places) if x in chosen]


def prepared(templates: list[tuple[str, str]]) -> list[Template]:
    found = [Template(i, name, re.findall("[a-z0-9]+", text.translate(str.maketrans(UPPER, LOWER)))) for i, (name, text) in enumerate(templates)]
    return [t for t in found if len(t.words) >= 2]


def even_lines(text: Column) -> Column:
    """The text with line feeds for all line ends."""
    return F.translate(F.replace(text.cast("string"), F.lit("\r\n"), F.lit("\n")), "\r", "\n")


def units(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, unit, unit_no, text) of lines, blocks and whole texts; numbers from 0."""
    rows = docs.select(F.col(id_col).alias("doc_id"), even_lines(F.col(text_col)).alias("text")).where("text IS NOT NULL")
    lines = F.transform(F.split("text", "\n", -1), lambda t, i: F.struct(F.lit("line").alias("unit"), i.alias("unit_no"), t.alias("part")))
    blocks = F.transform(F.split("text", "\n[ \t]*\n", -1), lambda t, i: F.struct(F.lit("block").alias("unit"), i.alias("unit_no"), t.alias("part")))
    blocks = F.when(F.col("text").rlike("\n[ \t]*\n"), F.filter(blocks, lambda b: F.contains(F.trim(b["part"], F.lit("\n")), F.lit("\n"))))
    whole = F.when(F.contains("text", F.lit("\n")), F.array(F.struct(F.lit("text").alias("unit"), F.lit(0).alias("unit_no"), F.col("text").alias("part"))))
    every = F.concat(lines, F.coalesce(blocks, F.array().cast("array<struct<unit:string,unit_no:int,part:string>>")), F.coalesce(whole, F.array().cast("array<struct<unit:string,unit_no:int,part:string>>")))
    return rows.select("doc_id", F.explode(every).alias("u")).select("doc_id", "u.unit", "u.unit_no", F.col("u.part").alias("part"))


def scan(docs: DataFrame, percent: int = 75, id_col: str = "doc_id", text_col: str = "text", templates: list[tuple[str, str]] | None = None) -> DataFrame:
    """(doc_id, unit, unit_no, licence, template, shared, unit_bigrams, template_bigrams) of each unit like a template.

    Like: ``200 * shared >= percent * (unit_bigrams + template_bigrams)``. ``unit_no`` is the number of a line or
    block, and the place of the first word of a window. ``templates``: (licence, text), the ones here if not given.
    """
    spark, known = docs.sparkSession, prepared(templates or TEMPLATES)
    texts = ", ".join(f"({t.number}, '{t.licence}', {len(t.words)}, {len(t.pairs)}, array({', '.join(map(repr, t.pairs))}))" for t in known)
    theirs = spark.sql(f"SELECT * FROM VALUES {texts} AS t(template, licence, template_words, template_bigrams, template_pairs)")
    some = Scratch(spark, "licences").keep(anchored(docs, known, percent, id_col, text_col))
    out = union_of_units(some, theirs, known, percent, "doc_id", "text").union(windows(some, theirs, known, percent, "doc_id", "text"))
    return out.select("doc_id", "unit", *[F.col(c).cast("bigint").alias(c) if c != "licence" else c for c in ("unit_no", "licence", "template", "shared", "unit_bigrams", "template_bigrams")])


def spread_pairs(docs: DataFrame, text_col: str, *keep: str) -> DataFrame:
    """The columns ``keep``, words, at, pair: the bigrams of each text with their places."""
    # Exploding an array of one binds its value, so that it isn't made anew for each use.
    own = docs.select(*keep, F.explode(F.array(words(F.col(text_col).cast("string")))).alias("words")).where(F.size("words") >= 2)
    pairs = F.zip_with(F.slice("words", F.lit(1), F.size("words") - 1), F.slice("words", F.lit(2), F.size("words") - 1), lambda a, b: F.concat(a, F.lit(" "), b))
    return own.select(*keep, "words", F.posexplode(pairs).alias("at", "pair"))


def anchored(docs: DataFrame, known: list[Template], percent: int, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, text) of the texts that have an anchor of a template."""
    pairs = ", ".join(f"'{pair}'" for pair in sorted({pair for t in known for _, pair in t.anchors(percent)}))
    wanted = docs.sparkSession.sql(f"SELECT * FROM VALUES {pairs} AS a(pair)")
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"), F.xxhash64(F.col(text_col)).alias("hash")).where("text IS NOT NULL")
    met = spread_pairs(rows, "text", "doc_id", "text", "hash").join(F.broadcast(wanted), "pair", "left_semi")  # the templates
    # All hits of a row are in one task, so it leaves it once.
    return met.groupBy("doc_id", "hash").agg(F.any_value("text").alias("text")).select("doc_id", "text")


def union_of_units(docs: DataFrame, theirs: DataFrame, known: list[Template], percent: int, id_col: str, text_col: str) -> DataFrame:
    """Lines, blocks and whole texts."""
    sizes = [len(t.pairs) for t in known]
    least, most = min(sizes) * percent // (200 - percent), -(-max(sizes) * (200 - percent) // percent)
    # Exploding an array of one binds its value: filters on it aren't pushed below and so don't compute it anew.
    own = units(docs, id_col, text_col).select("doc_id", "unit", "unit_no", F.explode(F.array(words(F.col("part")))).alias("words"))
    own = own.where(F.size("words") > least).select("doc_id", "unit", "unit_no", F.explode(F.array(bigrams("words"))).alias("pairs"))
    own = own.where(F.size("pairs").between(least, most)).select("doc_id", "unit", "unit_no", F.size("pairs").alias("unit_bigrams"), F.explode("pairs").alias("pair"))
    met = own.join(F.broadcast(theirs.select("template", "licence", "template_bigrams", F.explode("template_pairs").alias("pair"))), "pair")  # the templates
    fits = (percent * F.col("unit_bigrams") <= (200 - percent) * F.col("template_bigrams")) & (percent * F.col("template_bigrams") <= (200 - percent) * F.col("unit_bigrams"))
    scored = met.where(fits).groupBy("doc_id", "unit", "unit_no", "licence", "template", "unit_bigrams", "template_bigrams").agg(F.count_distinct("pair").alias("shared"))
    scored = scored.where(200 * F.col("shared") >= percent * (F.col("unit_bigrams") + F.col("template_bigrams")))
    return scored.select("doc_id", "unit", "unit_no", "licence", "template", "shared", "unit_bigrams", "template_bigrams")


def windows(docs: DataFrame, theirs: DataFrame, known: list[Template], percent: int, id_col: str, text_col: str) -> DataFrame:
    """The best window of each document and template that reaches ``percent``."""
    anchors = ", ".join(f"({t.number}, {place}, '{pair}')" for t in known for place, pair in t.anchors(percent))
    anchors = docs.sparkSession.sql(f"SELECT * FROM VALUES {anchors} AS a(template, place, pair)").join(F.broadcast(theirs), "template")
    spread = spread_pairs(docs.withColumnRenamed(id_col, "doc_id"), text_col, "doc_id")
    met = spread.join(F.broadcast(anchors), "pair")  # the templates
    met = met.withColumn("start", F.greatest(F.col("at") - F.col("place"), F.lit(0)))
    held = met.select("doc_id", "start", "licence", "template", "template_bigrams", "template_pairs", F.explode(F.array(F.slice("words", F.col("start") + 1, F.col("template_words")))).alias("held"))
    held = held.select("doc_id", "start", "licence", "template", "template_bigrams", "template_pairs", F.explode(F.array(bigrams("held"))).alias("pairs"))
    scored = held.select("doc_id", "start", "licence", "template", "template_bigrams", F.size("pairs").alias("unit_bigrams"), F.size(F.array_intersect("pairs", "template_pairs")).alias("shared"))
    scored = scored.where(200 * F.col("shared") >= percent * (F.col("unit_bigrams") + F.col("template_bigrams")))
    dice = 2.0 * F.col("shared") / (F.col("unit_bigrams") + F.col("template_bigrams"))
    best = scored.groupBy("doc_id", "licence", "template", "template_bigrams").agg(F.max(F.struct(dice.alias("dice"), (-F.col("start")).alias("back"), "shared", "unit_bigrams")).alias("b"))
    return best.select("doc_id", F.lit("window").alias("unit"), (-F.col("b.back")).alias("unit_no"), "licence", "template", "b.shared", "b.unit_bigrams", "template_bigrams")


def oracle_sql(percent: int = 75) -> str:
    """The same in DuckDB's SQL, without pruning."""
    known = prepared(TEMPLATES)
    texts = ", ".join(f"({t.number}, '{t.licence}', {len(t.words)}, {len(t.pairs)}, [{', '.join(map(repr, t.pairs))}])" for t in known)
    anchors = ", ".join(f"({t.number}, {place}, '{pair}')" for t in known for place, pair in t.anchors(percent))
    return rf"""
WITH tt(template, licence, template_words, template_bigrams, template_pairs) AS (VALUES {texts}),
an(template, place, pair) AS (VALUES {anchors}),
t AS (SELECT template, licence, template_bigrams, unnest(template_pairs) AS pair FROM tt),
d AS (SELECT doc_id, translate(replace(text, chr(13) || chr(10), chr(10)), chr(13), chr(10)) AS text FROM documents WHERE text IS NOT NULL),
l AS (SELECT doc_id, string_split(text, chr(10)) AS parts FROM d),
k AS (SELECT doc_id, string_split_regex(text, '
[ 	]*
') AS parts FROM d WHERE regexp_matches(text, '
[ 	]*
')),
u AS (SELECT doc_id, 'line' AS unit, unnest(range(len(parts))) AS unit_no, unnest(parts) AS part FROM l
  UNION ALL SELECT * FROM (SELECT doc_id, 'block' AS unit, unnest(range(len(parts))) AS unit_no, unnest(parts) AS part FROM k) WHERE contains(trim(part, chr(10)), chr(10))
  UNION ALL SELECT doc_id, 'text', 0, text FROM d WHERE contains(text, chr(10))),
w AS (SELECT doc_id, unit, unit_no, regexp_extract_all(translate(part, '{UPPER}', '{LOWER}'), '[a-z0-9]+') AS words FROM u),
b AS (SELECT doc_id, unit, unit_no, list_distinct(list_transform(range(1, len(words)), lambda i: words[i] || ' ' || words[i + 1])) AS pairs FROM w WHERE len(words) >= 2),
e AS (SELECT doc_id, unit, unit_no, len(pairs) AS unit_bigrams, unnest(pairs) AS pair FROM b),
x AS (SELECT doc_id, regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '[a-z0-9]+') AS words FROM d),
xp AS (SELECT doc_id, words, unnest(range(len(words) - 1)) AS pos FROM x WHERE len(words) >= 2),
xa AS (SELECT DISTINCT doc_id, words, template, greatest(pos - place, 0) AS start FROM xp JOIN an ON an.pair = words[pos + 1] || ' ' || words[pos + 2]),
xw AS (SELECT doc_id, start, tt.*, words[start + 1:start + template_words] AS held FROM xa JOIN tt USING (template)),
xb AS (SELECT doc_id, start, licence, template, template_bigrams, template_pairs, list_distinct(list_transform(range(1, len(held)), lambda i: held[i] || ' ' || held[i + 1])) AS pairs FROM xw),
xs AS (SELECT doc_id, start, licence, template, template_bigrams, len(pairs) AS unit_bigrams, len(list_intersect(pairs, template_pairs)) AS shared FROM xb),
xr AS (SELECT *, row_number() OVER (PARTITION BY doc_id, template ORDER BY 2.0 * shared / (unit_bigrams + template_bigrams) DESC, start) AS rank_no FROM xs WHERE 200 * shared >= {percent} * (unit_bigrams + template_bigrams))
SELECT doc_id, unit, CAST(unit_no AS BIGINT) AS unit_no, licence, CAST(template AS BIGINT) AS template, count(DISTINCT pair) AS shared,
  CAST(unit_bigrams AS BIGINT) AS unit_bigrams, CAST(template_bigrams AS BIGINT) AS template_bigrams
FROM e JOIN t USING (pair) GROUP BY doc_id, unit, unit_no, licence, template, unit_bigrams, template_bigrams
HAVING 200 * count(DISTINCT pair) >= {percent} * (unit_bigrams + template_bigrams)
UNION ALL SELECT doc_id, 'window', CAST(start AS BIGINT), licence, CAST(template AS BIGINT), shared, CAST(unit_bigrams AS BIGINT), CAST(template_bigrams AS BIGINT) FROM xr WHERE rank_no = 1
"""
