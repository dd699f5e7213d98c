"""Licence scan in DataFrame operations: sparse TF-IDF cosine of headers and licence
files to templates, then inheritance from the nearest directory with a licence file.

A line of a text that names a licence, a copyright or a grant is a header line. Three kinds of
units are compared with the templates: header lines; the blocks (between blank lines) of several lines that
hold one, for notices that are wrapped; and the whole of a text most of whose blocks do, for licence texts. A unit's terms
and those of the templates are weighted by tf * idf, idf over the units of the
whole corpus, and each unit takes the template with the largest cosine. A text is a licence file if
its matching units hold LICENCE_FILE of its words, or if its first block is a licence's title. It covers its directory;
a text without a notice of its own inherits from the nearest ancestor directory that is
covered.

Scale: only units leave the scan. The template table has a fixed size.
Inheritance is resolved per distinct directory and joined to the documents once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewatch.llm.common import SPACES, numbered, saved

# fixed values: notices as their licences give them
TEMPLATES = (
    ("AGPL-3.0", "Licensed under the GNU Affero General Public License, version 3."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC0-1.0", "Dedicated to the public domain under CC0 1.0 Universal."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"),
    ("LGPL-3.0", "Licensed under the GNU Lesser General Public License, version 3."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software"),
    ("MIT", "Released under the MIT License."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("proprietary", "All rights reserved."),
)
# fixed values: names in identifier lines
SPDX = ("AGPL-3.0", "Apache-2.0", "BSD-2-Clause", "BSD-3-Clause", "CC-BY-4.0", "CC-BY-NC-4.0", "CC-BY-SA-4.0", "CC0-1.0", "GPL-2.0", "GPL-3.0", "ISC",
        "LGPL-3.0", "MIT", "MPL-2.0")
# fixed values: titles of licence texts
TITLES = (
    ("AGPL-3.0", "GNU Affero General Public License Version 3, 19 November 2007"),
    ("Apache-2.0", "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/"),
    ("GPL-2.0", "GNU General Public License Version 2, June 1991"),
    ("GPL-3.0", "GNU General Public License Version 3, 29 June 2007"),
    ("LGPL-3.0", "GNU Lesser General Public License Version 3, 29 June 2007"),
    ("MPL-2.0", "Mozilla Public License Version 2.0"),
)
# fixed values: licence texts and the notices that files carry, as the licences give them
_BSD_START = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following
conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation
and/or other materials provided with the distribution. """
_BSD_NAMES = """3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived
from this software without specific prior written permission. """
_BSD_END = """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT
LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR
CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF
SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT,
STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF
SUCH DAMAGE."""
TEXTS = (
    ("MIT", """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the
"Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute,
sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:
The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER
LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN
THE SOFTWARE."""),
    ("ISC", """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the
above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD
TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT,
OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER
TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""),
    ("BSD-2-Clause", _BSD_START + _BSD_END),
    ("BSD-3-Clause", _BSD_START + _BSD_NAMES + _BSD_END),
    ("Apache-2.0", """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may
obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed
under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific
language governing permissions and limitations under the License."""),
    ("GPL-3.0", """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by
the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is distributed in the hope that it will be
useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License
for more details. You should have received a copy of the GNU General Public License along with this program. If not, see https://www.gnu.org/licenses/."""),
    ("MPL-2.0", """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this
file, You can obtain one at https://mozilla.org/MPL/2.0/."""),
)
HEADER = r"(?i)licen[sc]e|copyright|all rights reserved|permission (is hereby|to use)|redistribution and use|public domain|spdx"
TERM = r"[a-z]+[0-9]*|[0-9]+(?:\.[0-9]+)?"
BLANK = r"\n[\x20\x09-\x0D]*\n"
LINE, BLOCK, WHOLE = 0, 1, 2
LEAST = 0.6  # cosine of a match
LICENCE_FILE = 0.3  # share of a licence file's words


def _terms(line: Column) -> Column:
    return F.regexp_extract_all(F.lower(line), F.lit(TERM), F.lit(0))


def _words(text: Column) -> Column:
    return F.size(F.filter(F.split(text, SPACES), lambda w: w != ""))


def _once(value: Column, use) -> Column:
    """``use(value)`` with the value computed once per row."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _heads(text: str) -> Column:
    """The units of a text: kind, place among its kind, text."""
    def unit(kind, i, x):
        return F.struct(F.lit(kind).alias("kind"), i.alias("line"), x.alias("x"))

    def of(t):
        lines = F.filter(F.transform(F.split(t, "\n"), lambda x, i: unit(LINE, i, x)), lambda s: s["x"].rlike(HEADER))
        blocks = F.filter(F.transform(F.split(t, BLANK), lambda x, i: unit(BLOCK, i, x)), lambda s: s["x"].rlike(HEADER))
        share = lambda b: F.aggregate(b, F.lit(0), lambda n, s: n + _words(s["x"])) >= LICENCE_FILE * _words(t)
        whole = lambda b: F.when(t.rlike(BLANK) & share(b), F.array(unit(WHOLE, F.lit(0), t))).otherwise(F.slice(b, 1, 0))
        wrapped = lambda b: F.filter(b, lambda s: F.trim(s["x"]).contains("\n"))
        return F.when(t.rlike(HEADER), _once(blocks, lambda b: F.concat(lines, wrapped(b), whole(b)))).otherwise(F.slice(lines, 1, 0))

    return _once(F.coalesce(F.col(text), F.lit("")), of)


def templates() -> list[tuple[int, str, str, bool]]:
    """(number, licence, text, whether it is a title) of everything that units are compared with."""
    rows = [(k, x, False) for k, x in (*TEMPLATES, *((k, f"SPDX-License-Identifier: {k}") for k in SPDX), *TEXTS)] + [(k, x, True) for k, x in TITLES]
    return [(i, *r) for i, r in enumerate(rows)]


def notices(docs: DataFrame, text: str = "text") -> DataFrame:
    """rid, kind, line, words, license, cosine, title for every unit that matches a template;
    rid numbers the rows of ``docs``."""
    return _matched(saved(docs.select(F.monotonically_increasing_id().alias("rid"), _heads(text).alias("heads")), "header-rows"))


def _matched(heads: DataFrame) -> DataFrame:
    """``notices`` of a stored table of rid, heads."""
    spark = heads.sparkSession
    at = ["rid", "kind", "line"]
    lines = saved(heads.select("rid", F.explode("heads").alias("h")).select(
        "rid", "h.kind", "h.line", _words(F.col("h.x")).alias("words"), _terms(F.col("h.x")).alias("terms")), "header-lines")
    tf = lines.select(*at, F.explode("terms").alias("term")).groupBy(*at, "term").agg(F.count(F.lit(1)).alias("tf"))
    tf = saved(tf, "header-terms")
    total = lines.agg(F.count(F.lit(1))).scalar()
    df = tf.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    idf = saved(df.select("term", (F.log((total + 1) / (F.col("df") + 1)) + 1).alias("idf")), "header-idf")
    rare = F.log(F.lit(1.0) + total) + 1  # of a term that no line has

    rows = spark.createDataFrame(templates(), "t int, license string, x string, title boolean")
    tpl = rows.select("t", "license", "title", F.explode(_terms(F.col("x"))).alias("term")).groupBy("t", "license", "title", "term").agg(
        F.count(F.lit(1)).alias("n")).join(idf, "term", "left").select(
        "t", "license", "title", "term", (F.col("n") * F.coalesce("idf", rare)).alias("tw"))
    tpl = saved(tpl, "license-templates")  # some thousand rows, whatever the corpus
    norm = tpl.groupBy("t").agg(F.sqrt(F.sum(F.col("tw") * F.col("tw"))).alias("tn"))
    weighted = tf.join(idf, "term").withColumn("w", F.col("tf") * F.col("idf"))
    own = weighted.groupBy(*at).agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("n"))
    dot = weighted.join(F.broadcast(tpl), "term").groupBy(*at, "t", "license", "title").agg(F.sum(F.col("w") * F.col("tw")).alias("dot"))
    cosine = dot.join(F.broadcast(norm), "t").join(own, at).withColumn("cosine", F.round(F.col("dot") / (F.col("n") * F.col("tn")), 6))
    best = cosine.groupBy(*at).agg(F.max(F.struct("cosine", (-F.col("t")).alias("o"), "license", "title")).alias("b"))
    return best.filter(F.col("b.cosine") >= LEAST).join(lines.select(*at, "words"), at).select(
        *at, "words", "b.license", "b.cosine", "b.title")


def _parent(path: Column) -> Column:
    """Directory of a path; the root is ''."""
    return F.regexp_replace(path, "/?[^/]*$", "")


def licensed(docs: DataFrame, path: Column, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, own_license, cosine, n_notices, license_file, license, from_dir.

    own_license is the licence of the unit with the largest cosine (then lines before blocks before the whole text, then
    the first); n_notices counts its matching header lines, or its blocks where no line matches.
    license is the same, or else that of the nearest ancestor directory with a licence
    file (from_dir; of several files the largest cosine, then the smallest licence name), or null. A null path lies in the root. A null text has no
    notice. An empty table gives an empty result; other columns are not read, whatever their names."""
    base = numbered(docs.select(F.col(id_col).alias("doc_id"), _parent(F.coalesce(path, F.lit(""))).alias("dir"),
                                _words(F.coalesce(text, F.lit(""))).alias("words"),
                                _heads(text).alias("heads")), "rid")  # one scan: numbers, and all that is needed of the texts
    of = lambda kind, c: F.when(F.col("kind") == kind, F.col(c))
    found = saved(_matched(base.select("rid", "heads")), "notices").groupBy("rid").agg(
        F.max(F.struct("cosine", (-F.col("kind")).alias("q"), (-F.col("line")).alias("o"), "license")).alias("b"),
        F.coalesce(F.nullif(F.count(of(LINE, "line")), F.lit(0)), F.count(of(BLOCK, "line"))).alias("k"),
        F.greatest(F.sum(of(LINE, "words")), F.sum(of(BLOCK, "words")), F.max(of(WHOLE, "words"))).alias("lw"),
        F.bool_or((F.col("kind") == BLOCK) & (F.col("line") == 0) & F.col("title")).alias("titled"))
    rows = saved(base.join(found, "rid", "left").select(
        "rid", "doc_id", "dir", F.col("b.license").alias("own_license"), F.col("b.cosine").alias("cosine"),
        F.coalesce("k", F.lit(0)).alias("n_notices"), F.coalesce(F.col("titled") | (F.col("lw") >= LICENCE_FILE * F.col("words")), F.lit(False)).alias("license_file")),
        "licensed-rows")
    covered = saved(rows.filter("license_file").groupBy("dir").agg(
        F.max(F.struct("cosine")).alias("c")).withColumnRenamed("dir", "d").join(rows.filter("license_file"), F.col("d") == F.col("dir"))
        .filter(F.col("c.cosine") == F.col("cosine")).groupBy("dir").agg(F.min("own_license").alias("dir_license")), "covered-dirs")
    dirs = rows.select("dir").distinct()
    parts = F.split("dir", "/")
    up = F.transform(F.sequence(F.lit(0), F.size(parts)), lambda i: F.array_join(F.slice(parts, 1, i), "/"))  # '' to dir itself
    above = dirs.select("dir", F.explode(F.array_distinct(up)).alias("at")).join(
        covered.select(F.col("dir").alias("at"), "dir_license"), "at")
    nearest = saved(above.groupBy("dir").agg(F.max(F.struct(F.char_length("at").alias("n"), "at", "dir_license")).alias("b")).select(
        "dir", F.col("b.at").alias("at"), F.col("b.dir_license").alias("dir_license")), "nearest-dirs")
    return rows.join(nearest, "dir", "left").select(
        "doc_id", "own_license", "cosine", "n_notices", "license_file", F.coalesce("own_license", "dir_license").alias("license"),
        F.when(F.col("own_license").isNull(), F.col("at")).alias("from_dir"))
