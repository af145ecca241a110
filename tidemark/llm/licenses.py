"""Licence scan: TF-IDF cosine of headers, licence files and notice lines to templates, then inheritance along
the path.

The units of a file are its header (the comment lines that it begins with, as one text), each line that a cue
word marks, and, of a licence file, the whole text and its title (the first lines with words). A unit is a
sparse vector of words and pairs of neighbouring words, so that ``version 2`` and ``version 3`` differ; the
templates are vectors of the same kind, and the two meet in a join on words. Equal units are compared once. A
file takes the best template of its units; an SPDX identifier in it stands before all of them. A file without
either takes the licence of the licence file in the nearest directory above it, found by joining the
directories of the table with those of the licence files.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import written

_GRANT = ("is free software: you can redistribute it and/or modify it under the terms of the GNU {name} General Public License as "
          "published by the Free Software Foundation, either version {version} of the License, or (at your option) any later version.")
_NO_WARRANTY = ("is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of "
                "MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU {name} General Public License for more details. "
                "You should have received a copy of the GNU {name} General Public License along with this program.")
_BSD = ("Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following "
        "conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the "
        "following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and "
        "the following disclaimer in the documentation and/or other materials provided with the distribution. ")
_BSD_NAMES = ("3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products "
              "derived from this software without specific prior written permission. ")
_BSD_END = ('THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, '
            "BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT "
            "SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL "
            "DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS "
            "INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING "
            "NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.")
#: Licence texts, file headers, titles and notice lines by licence, in the wording of their publishers.
#: Of licences of many pages the title stands for the file.
TEMPLATES: list[tuple[str, str]] = [
    ("AGPL-3.0", "This program is licensed under the GNU Affero General Public License, version 3."),
    ("AGPL-3.0", "GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007"),
    ("AGPL-3.0", "GNU AFFERO GENERAL PUBLIC LICENSE Version 3"),
    ("AGPL-3.0", "This program " + _GRANT.format(name="Affero", version=3)),
    ("AGPL-3.0", f"This program {_GRANT.format(name='Affero', version=3)} This program {_NO_WARRANTY.format(name='Affero')}"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the "
                   "License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable "
                   "law or agreed to in writing, software distributed under the License is distributed on an AS IS BASIS, WITHOUT WARRANTIES OR "
                   "CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and "
                   "limitations under the License."),
    ("Apache-2.0", "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/"),
    ("Apache-2.0", "Apache License Version 2.0"),
    ("BSD-2-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted."),
    ("BSD-2-Clause", _BSD + _BSD_END),
    ("BSD-3-Clause", "Released under the BSD 3-Clause License."),
    ("BSD-3-Clause", _BSD + _BSD_NAMES + _BSD_END),
    ("BSL-1.0", "Distributed under the Boost Software License, Version 1.0."),
    ("BSL-1.0", "Boost Software License - Version 1.0 - August 17th, 2003"),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "Creative Commons Attribution 4.0 International Public License"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "Creative Commons Attribution-NonCommercial 4.0 International Public License"),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-SA-4.0", "Creative Commons Attribution-ShareAlike 4.0 International Public License"),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related rights: CC0 1.0 public domain."),
    ("CC0-1.0", "Creative Commons Legal Code CC0 1.0 Universal"),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-2.0", "GNU GENERAL PUBLIC LICENSE Version 2, June 1991"),
    ("GPL-2.0", "GNU GENERAL PUBLIC LICENSE Version 2"),
    ("GPL-2.0", "This program " + _GRANT.format(name="", version=2)),
    ("GPL-2.0", f"This program {_GRANT.format(name='', version=2)} This program {_NO_WARRANTY.format(name='')}"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007"),
    ("GPL-3.0", "GNU GENERAL PUBLIC LICENSE Version 3"),
    ("GPL-3.0", "This program " + _GRANT.format(name="", version=3)),
    ("GPL-3.0", f"This program {_GRANT.format(name='', version=3)} This program {_NO_WARRANTY.format(name='')}"),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided "
            "that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED AS IS AND THE AUTHOR "
            "DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS."),
    ("LGPL-2.1", "GNU LESSER GENERAL PUBLIC LICENSE Version 2.1, February 1999"),
    ("LGPL-2.1", "This library " + _GRANT.format(name="Lesser", version=2.1)),
    ("LGPL-3.0", "This library is licensed under the GNU Lesser General Public License, version 3."),
    ("LGPL-3.0", "GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007"),
    ("LGPL-3.0", "GNU LESSER GENERAL PUBLIC LICENSE Version 3"),
    ("LGPL-3.0", "This library " + _GRANT.format(name="Lesser", version=3)),
    ("MIT", "Released under the MIT License."),
    ("MIT", "The MIT License"),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files "
            "(the Software), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, "
            "publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do "
            "so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or "
            "substantial portions of the Software. THE SOFTWARE IS PROVIDED AS IS, WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING "
            "BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE "
            "AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR "
            "OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed "
                "with this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
    ("MPL-2.0", "Mozilla Public License Version 2.0"),
    ("Proprietary", "Copyright. All rights reserved."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("Unlicense", "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, "
                  "sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or "
                  "non-commercial, and by any means."),
]
CUE = r"(?i)licen[sc]e|copyright|redistribut|public domain|rights reserved|permission is hereby"
WORD = r"[a-z0-9]+(?:[.+-][a-z0-9]+)*"
LICENCE_FILE = r"(?i)^(licen[sc]e|copying|notice|unlicense)([.-].*)?$"
SPDX = r"SPDX-License-Identifier:[ \t]*([A-Za-z0-9][A-Za-z0-9.+-]*(?:[ \t]+(?:OR|AND|WITH)[ \t]+[A-Za-z0-9][A-Za-z0-9.+-]*)*)"
#: A line of a header: it begins as comments of common languages do, or is blank.
COMMENT = r"^[ \t]*(#|//|/\*|\*|--|;|%|<!--|$)"
BREAK = r"\r\n|\r|\n"
TITLE_LINES = 3
LEAST = 0.6


def _features(text: str) -> Column:
    """Words, and pairs of neighbouring words, by 64-bit digests."""
    words = F.regexp_extract_all(F.lower(F.col(text)), F.lit(WORD), F.lit(0))
    pairs = F.greatest(F.size(words) - 1, F.lit(0))
    both = F.concat(words, F.zip_with(F.slice(words, 1, pairs), F.slice(words, 2, pairs), lambda a, b: F.concat(a, F.lit(" "), b)))
    return F.transform(both, lambda w: F.xxhash64(w))


def units(files: DataFrame) -> DataFrame:
    """``files (doc, path, folder, name, text)`` as one row per unit: ``(doc, path, folder, name, unit, spdx)``,
    with ``unit`` null where only an SPDX identifier was found."""
    lines = F.split("text", BREAK)
    before = F.array_position(F.transform(lines, lambda x: ~x.rlike(COMMENT)), True)
    header = F.slice(lines, 1, F.when(before > 0, (before - 1).cast("int")).otherwise(F.size(lines)))
    titles = F.slice(F.filter(lines, lambda x: x.rlike("[A-Za-z0-9]")), 1, TITLE_LINES)
    licence = F.col("name").rlike(LICENCE_FILE)
    found = files.where(F.col("text").isNotNull()).withColumn("spdx", F.nullif(F.regexp_extract("text", SPDX, 1), F.lit("")))
    found = found.where(F.col("text").rlike(CUE) | F.col("text").rlike(COMMENT) | licence | F.col("spdx").isNotNull())
    all_units = F.concat(
        F.filter(lines, lambda x: x.rlike(CUE)), F.array(F.array_join(header, "\n")),
        F.when(licence, F.array(F.col("text"), F.array_join(titles, "\n"))).otherwise(F.array().cast("array<string>")))
    kept = F.array_distinct(F.filter(all_units, lambda x: x.rlike("[A-Za-z0-9]")))
    return found.select("doc", "path", "folder", "name", "spdx", F.explode_outer(kept).alias("unit"))


def matches(spark: SparkSession, rows: DataFrame, templates: list[tuple[str, str]] = TEMPLATES) -> DataFrame:
    """``(key, license, score)``: the best template of every distinct unit, by the digest of its text, if it
    reaches ``LEAST``.

    ``rows (key, unit)`` may repeat; word frequencies count every repetition. Empty tables have no matches; a
    unit of any length is compared whole.
    """
    counted = written(rows.where("unit is not null").groupBy("key").agg(F.count("*").alias("times"), F.first("unit").alias("unit"))
                      .withColumn("number", F.monotonically_increasing_id()), "units")
    total = F.lit(float(counted.agg(F.sum("times")).first()[0] or 0))
    held = counted.select("number", "times", F.explode(_features("unit")).alias("word"))
    tf = written(held.groupBy("number", "word").agg(F.count("*").alias("tf"), F.first("times").alias("times")), "features")
    df = tf.groupBy("word").agg(F.sum("times").alias("df"))
    idf = df.select("word", (F.log((total + 1) / (F.col("df") + 1)) + 1).alias("idf"))
    weights = tf.join(idf, "word").select("number", "word", (F.col("tf") * F.col("idf")).alias("w"))
    sizes = weights.groupBy("number").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("size"))
    listed = spark.createDataFrame([(i, n, t) for i, (n, t) in enumerate(templates)], "template int, license string, notice string")
    unseen = F.log(total + 1) + 1  # the weight of a template's word that no unit holds
    asked = (listed.select("template", "license", F.explode(_features("notice")).alias("word"))
             .groupBy("template", "license", "word").agg(F.count("*").alias("tf"))
             .join(idf, "word", "left")
             .select("template", "license", "word", (F.col("tf") * F.coalesce("idf", unseen)).alias("v")))
    lengths = asked.groupBy("template").agg(F.sqrt(F.sum(F.col("v") * F.col("v"))).alias("length"))
    dots = (weights.join(asked, "word").groupBy("number", "template", "license").agg(F.sum(F.col("w") * F.col("v")).alias("dot")))
    scored = (dots.join(sizes, "number").join(lengths, "template")
              .select("number", "license", F.round(F.col("dot") / (F.col("size") * F.col("length")), 6).alias("score"))
              .where(F.col("score") >= LEAST))
    best = F.min(F.struct((-F.col("score")).alias("order"), F.col("license").alias("license"))).alias("best")
    return scored.groupBy("number").agg(best).join(counted.select("number", "key"), "number").select("key", F.col("best.license").alias("license"), (-F.col("best.order")).alias("score"))


def _folders(folder: str) -> Column:
    """The folder and all those above it, the root (an empty text) last."""
    parts = F.split(F.col(folder), "/")
    up = F.transform(F.sequence(F.lit(0), F.size(parts)), lambda n: F.array_join(F.slice(parts, 1, n), "/"))
    return F.array_distinct(up)


def scan(docs: DataFrame, doc: str = "doc_id", path: str = "path", text: str = "text") -> DataFrame:
    """``(doc_id, license, score, origin, folder)`` per row of ``docs``.

    ``origin`` is ``own``, ``inherited`` or ``none``; ``folder`` names the folder inherited from. An SPDX
    identifier (the first one of a text) is taken as it stands, with a score of 1, before any unit. Several
    units or licence files are settled by the higher score, then the name. Null and empty texts hold no unit, a
    null path lies in the root folder and is no licence file; texts of any length are compared whole. Rows that share id and path count as one
    file and get the same answer; other columns are ignored.
    """
    files = docs.select(F.col(doc).alias("doc"), F.coalesce(F.col(path), F.lit("")).alias("path"), F.col(text).alias("text"))
    files = files.withColumn("folder", F.regexp_replace("path", "/?[^/]*$", "")).withColumn("name", F.regexp_extract("path", "([^/]*)$", 1))
    found = written(units(files).withColumn("key", F.md5("unit")), "units")
    known = matches(docs.sparkSession, found.select("key", "unit"))
    best = F.min(F.struct(F.coalesce(F.when(F.col("spdx").isNotNull(), -1.0), -F.col("score")).alias("order"),
                          F.col("spdx").isNull().alias("scored"), F.coalesce("spdx", "license").alias("license"))).alias("best")
    own = (found.join(known, "key", "left").where("spdx is not null or license is not null")
           .groupBy("doc", "path", "folder", "name").agg(best))
    above = (own.where(F.col("name").rlike(LICENCE_FILE)).groupBy("folder").agg(F.min("best").alias("from_best"))
             .withColumnRenamed("folder", "at"))
    folders = files.select("folder").distinct().withColumn("at", F.explode(_folders("folder")))
    nearest = (folders.join(above, "at").groupBy("folder")
               .agg(F.max(F.struct(F.length("at").alias("depth"), F.col("at").alias("at"), F.col("from_best").alias("from_best"))).alias("near"))
               .select("folder", F.col("near.at").alias("at"), F.col("near.from_best").alias("from_best")))
    mine = own.select(F.col("doc").alias("own_doc"), F.col("path").alias("own_path"), "best")
    rows = (files.select("doc", "path", "folder")
            .join(mine, F.col("doc").eqNullSafe(F.col("own_doc")) & (F.col("path") == F.col("own_path")), "left")
            .join(nearest, "folder", "left"))
    taken = F.coalesce("best", "from_best")
    return rows.select(
        F.col("doc").alias(doc), taken.getField("license").alias("license"), (-taken.getField("order")).alias("score"),
        F.when(F.col("best").isNotNull(), "own").when(F.col("from_best").isNotNull(), "inherited").otherwise("none").alias("origin"),
        F.when(F.col("best").isNull(), F.col("at")).alias("folder"))


def oracle(files: str) -> str:
    """SQL of ``scan`` over the rows of ``files (doc_id, path, text)``."""
    quote = lambda t: t.replace("'", "''")
    values = ", ".join(f"({i}, '{n}', '{quote(t)}')" for i, (n, t) in enumerate(TEMPLATES))
    words = lambda c: f"regexp_extract_all(lower({c}), '{WORD}')"
    pairs = "list_concat(ws, list_transform(range(1, len(ws)), lambda i: ws[i] || ' ' || ws[i + 1]))"
    return f"""
    WITH f AS (SELECT doc_id, path, text, regexp_replace(path, '/?[^/]*$', '') AS folder, regexp_extract(path, '([^/]*)$', 1) AS name,
                      nullif(regexp_extract(text, '{SPDX}', 1), '') AS spdx, regexp_split_to_array(text, '{BREAK}') AS lines FROM ({files})),
    h AS (SELECT *, list_position(list_transform(lines, lambda x: NOT regexp_matches(x, '{COMMENT}')), true) AS code,
                 regexp_matches(name, '{LICENCE_FILE}') AS licence FROM f WHERE text IS NOT NULL),
    l AS (SELECT doc_id, path, folder, name, spdx, unnest(list_distinct(list_filter(list_concat(
              list_filter(lines, lambda x: regexp_matches(x, '{CUE}')), [array_to_string(lines[1:coalesce(code, len(lines) + 1) - 1], chr(10))],
              CASE WHEN licence THEN [text, array_to_string(list_filter(lines, lambda x: regexp_matches(x, '[A-Za-z0-9]'))[1:{TITLE_LINES}], chr(10))] ELSE [] END),
              lambda x: regexp_matches(x, '[A-Za-z0-9]')))) AS line FROM h),
    c AS (SELECT line, count(*) AS times FROM l GROUP BY 1), n AS (SELECT coalesce(sum(times), 0)::DOUBLE AS total FROM c),
    tf AS (SELECT line, word, count(*) AS tf, any_value(times) AS times
           FROM (SELECT line, times, unnest({pairs}) AS word FROM (SELECT *, {words('line')} AS ws FROM c)) GROUP BY ALL),
    idf AS (SELECT word, ln((any_value(total) + 1) / (sum(times) + 1)) + 1 AS idf FROM tf, n GROUP BY 1),
    w AS (SELECT line, word, tf * idf AS w FROM tf JOIN idf USING (word)),
    s AS (SELECT line, sqrt(sum(w * w)) AS size FROM w GROUP BY 1),
    t(template, license, notice) AS (VALUES {values}),
    a AS (SELECT template, license, word, count(*) * coalesce(any_value(idf), any_value((SELECT ln(total + 1) + 1 FROM n))) AS v
          FROM (SELECT template, license, unnest({pairs}) AS word FROM (SELECT *, {words('notice')} AS ws FROM t)) LEFT JOIN idf USING (word) GROUP BY 1, 2, 3),
    g AS (SELECT template, sqrt(sum(v * v)) AS length FROM a GROUP BY 1),
    d AS (SELECT line, template, license, sum(w * v) AS dot FROM w JOIN a USING (word) GROUP BY ALL),
    k AS (SELECT line, license, round(dot / (size * length), 6) AS score FROM d JOIN s USING (line) JOIN g USING (template)
          WHERE round(dot / (size * length), 6) >= {LEAST} QUALIFY row_number() OVER (PARTITION BY line ORDER BY round(dot / (size * length), 6) DESC, license) = 1),
    own AS (SELECT doc_id, path, folder, name, license, score FROM (
                SELECT doc_id, path, folder, name, license, score, 1 AS place FROM l JOIN k USING (line) WHERE spdx IS NULL
                UNION ALL SELECT doc_id, path, folder, name, spdx, 1.0, 0 FROM f WHERE spdx IS NOT NULL)
            QUALIFY row_number() OVER (PARTITION BY doc_id, path ORDER BY score DESC, place, license) = 1),
    above AS (SELECT folder AS at_folder, license, score FROM own WHERE regexp_matches(name, '{LICENCE_FILE}')
              QUALIFY row_number() OVER (PARTITION BY folder ORDER BY score DESC, license) = 1),
    near AS (SELECT x.folder, at_folder, license, score FROM (SELECT DISTINCT folder FROM f) x
             JOIN above ON at_folder = '' OR x.folder = at_folder OR starts_with(x.folder, at_folder || '/')
             QUALIFY row_number() OVER (PARTITION BY x.folder ORDER BY length(at_folder) DESC) = 1)
    SELECT f.doc_id, coalesce(own.license, near.license) AS license, coalesce(own.score, near.score) AS score,
           CASE WHEN own.license IS NOT NULL THEN 'own' WHEN near.license IS NOT NULL THEN 'inherited' ELSE 'none' END AS origin,
           CASE WHEN own.license IS NULL THEN near.at_folder END AS folder
    FROM f LEFT JOIN own USING (doc_id, path) LEFT JOIN near ON near.folder = f.folder"""
