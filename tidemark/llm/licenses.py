"""License scans by canonical digests, in DataFrame functions only.

A line's canonical form is lower-case, without punctuation and list numbers, with one of each set of
equivalent spellings, and empty if it is a copyright line or a license's title. A text's form is its lines'
forms in a row, so it does not matter how a text is wrapped. Two texts are the same license if the forms'
digests are the same, so a scan is one hash join with the known ones.

What is looked up: whole documents, and every run of whole lines that has as many words as a known text
that begins with the same words. So a license is found in a file of its own, under a title and copyright
lines, and within a longer document, wherever its first word begins a line and its last one ends a line.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Wording of common license notices and of short licenses.
_BSD_DISCLAIMER = (
    'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT '
    "LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE "
    "COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES "
    "(INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) "
    "HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) "
    "ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)
KNOWN = [
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "This project is licensed under the MIT License."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Released under the Apache License, Version 2.0."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("MPL-2.0", "Licensed under the Mozilla Public License, Version 2.0."),
    ("BSD-2-Clause", "Licensed under the BSD 2-Clause License."),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License."),
    ("CC0-1.0", "Licensed under CC0 1.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-ND-4.0", "Licensed under CC BY-ND 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-SA-4.0", "Licensed under CC BY-NC-SA 4.0."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("all-rights-reserved", "All rights reserved."),
    (
        "ISC",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
        "provided that the above copyright notice and this permission notice appear in all copies.\n"
        'THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED '
        "WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR "
        "CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, "
        "NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.",
    ),
    (
        "MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation "
        'files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, '
        "modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software "
        "is furnished to do so, subject to the following conditions:\n"
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.\n"
        'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES '
        "OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE "
        "LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR "
        "IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    ),
    (
        "BSD-2-Clause",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following "
        "conditions are met:\n"
        "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.\n"
        "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer "
        "in the documentation and/or other materials provided with the distribution.\n" + _BSD_DISCLAIMER,
    ),
    (
        "BSD-3-Clause",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following "
        "conditions are met:\n"
        "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.\n"
        "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer "
        "in the documentation and/or other materials provided with the distribution.\n"
        "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived "
        "from this software without specific prior written permission.\n" + _BSD_DISCLAIMER,
    ),
    (
        "0BSD",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted.\n"
        'THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED '
        "WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR "
        "CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, "
        "NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.",
    ),
    (
        "Zlib",
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any "
        "damages arising from the use of this software.\n"
        "Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and "
        "redistribute it freely, subject to the following restrictions:\n"
        "1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use "
        "this software in a product, an acknowledgment in the product documentation would be appreciated but is not required.\n"
        "2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.\n"
        "3. This notice may not be removed or altered from any source distribution.",
    ),
    (
        "Unlicense",
        "This is free and unencumbered software released into the public domain.\n"
        "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a "
        "compiled binary, for any purpose, commercial or non-commercial, and by any means.\n"
        "In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright interest in "
        "the software to the public domain. We make this dedication for the benefit of the public at large and to the detriment of our "
        "heirs and successors. We intend this dedication to be an overt act of relinquishment in perpetuity of all present and future "
        "rights to this software under copyright law.\n"
        'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES '
        "OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS BE LIABLE FOR ANY CLAIM, "
        "DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE "
        "SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.\n"
        "For more information, please refer to <https://unlicense.org/>",
    ),
    (
        "Apache-2.0",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. '
        "You may obtain a copy of the License at\n"
        "http://www.apache.org/licenses/LICENSE-2.0\n"
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "
        '"AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language '
        "governing permissions and limitations under the License.",
    ),
    (
        "GPL-2.0-or-later",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as "
        "published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.\n"
        "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of "
        "MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.",
    ),
    (
        "GPL-3.0-or-later",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as "
        "published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.\n"
        "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of "
        "MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.",
    ),
    (
        "MPL-2.0",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with "
        "this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
    ),
]
# Titles above license texts, as canonical text.
TITLES = [
    "mit license",
    "the mit license",
    "the mit license mit",
    "isc license",
    "the isc license",
    "bsd 2 clause license",
    "the bsd 2 clause license",
    "simplified bsd license",
    "bsd 3 clause license",
    "the bsd 3 clause license",
    "new bsd license",
    "bsd zero clause license",
    "zlib license",
    "the zlib license",
    "the unlicense",
]
# Equivalent spellings, as canonical text; the second of each is kept.
SPELLINGS = [
    ("licence", "license"),
    ("licenced", "licensed"),
    ("licences", "licenses"),
    ("licencing", "licensing"),
    ("sub license", "sublicense"),
    ("sub licence", "sublicense"),
    ("non commercial", "noncommercial"),
    ("non infringement", "noninfringement"),
    ("acknowledgement", "acknowledgment"),
    ("authorisation", "authorization"),
    ("authorised", "authorized"),
    ("organisation", "organization"),
    ("recognised", "recognized"),
    ("initialise", "initialize"),
    ("favour", "favor"),
    ("behaviour", "behavior"),
    ("judgement", "judgment"),
    ("fulfil", "fulfill"),
    ("whilst", "while"),
    ("per cent", "percent"),
    ("https", "http"),
    ("copyright owner", "copyright holder"),
]
_MARKS = r"[^\p{L}\p{N}]+"
_COPYRIGHT = r"^[^\p{L}\p{N}]*(copyright[^\p{L}]*[0-9]{4}|copyright \(c\)|\(c\)|©)"
_LIST_NUMBER = r"^[^\p{L}\p{N}]*([0-9]{1,2}|[a-e])[.)][ \t]+"
_ANY_SPELLING = r"\b(" + "|".join(a for a, _ in SPELLINGS) + r")\b"
#: A scan takes at most this many different beginnings of known texts, since each task holds them.
MOST_BEGINNINGS = 10_000


def _spelled(plain: Column) -> Column:
    changed = reduce(lambda text, change: F.regexp_replace(text, rf"\b{change[0]}\b", change[1]), SPELLINGS, plain)
    return F.when(plain.rlike(_ANY_SPELLING), changed).otherwise(plain)


def _plain(low: Column) -> Column:
    words = F.trim(F.regexp_replace(F.regexp_replace(low, _LIST_NUMBER, ""), _MARKS, " "))
    return F.when(low.rlike(_COPYRIGHT), F.lit("")).otherwise(words)


def canonical_lines(text: Column) -> Column:
    """The lines' canonical forms; empty for copyright lines, titles and lines of marks only.

    Step by step over the whole array: what a step uses twice was computed once, by the step before.
    """
    low = F.transform(F.split(text, "\r?\n"), F.lower)
    spelled = F.transform(F.transform(low, _plain), _spelled)
    return F.transform(spelled, lambda form: F.when(form.isin(TITLES), F.lit("")).otherwise(form))


def whole(lines: Column) -> Column:
    """A text's canonical form from those of its lines."""
    return F.array_join(F.filter(lines, lambda x: x != ""), " ")


def known_licenses(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(KNOWN, "license_id string, text string")


def _forms(known: DataFrame) -> DataFrame:
    return known.select("license_id", whole(canonical_lines(F.col("text"))).alias("form")).where("form <> ''")


def digests(known: DataFrame) -> DataFrame:
    """``digest, license_id`` of each known text that has a canonical form."""
    return _forms(known).select(F.md5("form").alias("digest"), "license_id").distinct()


def _beginning(form: Column) -> Column:
    return F.substring_index(form, " ", 2)


def word_counts(known: DataFrame) -> dict[str, list[int]]:
    """How many words the known texts have that begin with the same two words; a line may hold only the first of them."""
    forms = _forms(known).select("form", F.size(F.split("form", " ")).alias("words"))
    begins = F.explode(F.array_distinct(F.array(_beginning(F.col("form")), F.substring_index("form", " ", 1))))
    rows = forms.select(begins.alias("begin"), "words").groupBy("begin").agg(F.sort_array(F.collect_set("words")).alias("words"))
    found = {r["begin"]: r["words"] for r in rows.limit(MOST_BEGINNINGS + 1).collect()}
    if len(found) > MOST_BEGINNINGS:
        raise ValueError(f"the known texts begin in more than {MOST_BEGINNINGS} ways: scan with a part of them at a time")
    return found


def _ends_a_line(run: Column, words: Column) -> Column:
    """Whether some number of whole lines from the run's start has this many words."""
    nothing = F.struct(F.lit(0).alias("n"), F.lit(False).alias("met"))

    def add(so_far: Column, line: Column) -> Column:
        n = so_far["n"] + F.size(F.split(line, " "))
        return F.struct(n.alias("n"), (so_far["met"] | (n == words)).alias("met"))

    return F.aggregate(run, nothing, add)["met"]


def scan(docs: DataFrame, known: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Documents and runs of their lines that are a known license: ``doc_id, line, license_id, digest``.

    Line 0 is the whole document, others count from 1 and are those a run begins with. A document that is one
    run is found both ways; a license within a longer one is found too. Null and empty texts and forms give
    nothing; a null id is kept; each of several equal rows is found; a text known under several names gives a
    row for each; an empty table gives no rows; other columns are ignored. A very long text gives a row only for
    lines that begin like a known text, each with no more lines than that text has words. The known side's
    size decides, by Spark's own rule, whether the join is a broadcast.
    """
    counts = word_counts(known)
    of_begin = F.create_map(*[F.lit(x) for item in counts.items() for x in item]) if counts else F.lit(None).cast("map<string,array<int>>")
    lines = docs.select(F.col(id_column).alias("doc_id"), canonical_lines(F.col(text_column).cast("string")).alias("lines"))
    filled = F.filter(F.transform("lines", lambda x, i: F.struct((i + 1).alias("line"), x.alias("form"))), lambda x: x["form"] != "")
    rows = lines.select("doc_id", filled.alias("filled"))
    placed = F.transform("filled", lambda x, i: F.struct(x["line"].alias("line"), (i + 1).alias("place"), x["form"].alias("form")))
    begins = F.filter(placed, lambda x: _beginning(x["form"]).isin(list(counts)))
    starts = F.transform(begins, lambda x: F.struct(x["line"].alias("line"), x["place"].alias("place"), F.try_element_at(of_begin, _beginning(x["form"])).alias("words")))
    document = F.array(F.struct(F.lit(0).alias("line"), F.lit(1).alias("place"), F.array(F.lit(0)).alias("words")))
    forms = F.col("filled.form")
    units = rows.select("doc_id", forms.alias("forms"), F.md5(F.array_join(forms, " ")).alias("whole"), F.concat(document, starts).alias("starts"))
    # every text has its document among the starts; a plain explode would compute them once more, to look for empty ones
    units = units.select("doc_id", "forms", "whole", F.explode_outer("starts").alias("at"))
    # the run is cut in the step that makes its row, so that a long document's lines are not carried further
    runs = units.select("doc_id", "whole", "at.line", "at.words", F.slice("forms", F.col("at.place"), F.array_max("at.words")).alias("run"))
    sized = runs.select("doc_id", "whole", "line", "run", F.explode("words").alias("n"))
    met = sized.where((F.col("line") == 0) | _ends_a_line(F.col("run"), F.col("n")))
    cut = F.call_function("substring_index", F.array_join("run", " "), F.lit(" "), F.col("n"))
    found = met.select("doc_id", "line", F.when(F.col("line") == 0, F.col("whole")).otherwise(F.md5(cut)).alias("digest"))
    return found.join(digests(known), "digest").select("doc_id", "line", "license_id", "digest")


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _line_sql(line: str) -> str:
    plain = rf"trim(regexp_replace(regexp_replace(lower({line}), '{_LIST_NUMBER}', ''), '{_MARKS}', ' ', 'g'))"
    for a, b in SPELLINGS:
        plain = rf"regexp_replace({plain}, '\b{a}\b', '{b}', 'g')"
    return f"CASE WHEN regexp_matches(lower({line}), '{_COPYRIGHT}') THEN '' ELSE {plain} END"


def _lines_sql(text: str) -> str:
    forms = rf"list_transform(string_split_regex({text}, '\r?\n'), lambda x: {_line_sql('x')})"
    return f"list_transform({forms}, lambda z: CASE WHEN list_contains([{', '.join(map(_quoted, TITLES))}], z) THEN '' ELSE z END)"


_WHOLE_SQL = "array_to_string(list_filter({}, lambda y: y <> ''), ' ')"
#: The scan of table documents for KNOWN, in DuckDB SQL: every run of lines with the words and first word of a known text.
SCAN_SQL = f"""
WITH forms AS (SELECT DISTINCT license_id, {_WHOLE_SQL.format(_lines_sql("body"))} AS form
  FROM (VALUES {", ".join(f"({_quoted(name)}, {_quoted(text)})" for name, text in KNOWN)}) AS v(license_id, body)),
known AS (SELECT license_id, md5(form) AS digest FROM forms WHERE form <> ''),
sizes AS (SELECT DISTINCT split_part(form, ' ', 1) AS first, len(string_split(form, ' ')) AS words FROM forms WHERE form <> ''),
lines AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, {_lines_sql("text")} AS l FROM documents WHERE text IS NOT NULL),
split AS (SELECT r, doc_id, unnest(range(1, len(l) + 1)) AS line, unnest(l) AS form FROM lines),
filled AS MATERIALIZED (SELECT r, doc_id, line, form, len(string_split(form, ' ')) AS n, row_number() OVER (PARTITION BY r ORDER BY line) AS place,
  sum(len(string_split(form, ' '))) OVER (PARTITION BY r ORDER BY line) AS stop FROM split WHERE form <> ''),
wanted AS MATERIALIZED (SELECT a.r, a.line AS start, a.place AS first, a.stop - a.n + s.words AS stop
  FROM filled a JOIN sizes s ON split_part(a.form, ' ', 1) = s.first),
runs AS MATERIALIZED (SELECT w.r, w.start, w.first, b.place AS last FROM wanted w JOIN filled b ON b.r = w.r AND b.stop = w.stop),
units AS (SELECT doc_id, 0 AS line, md5({_WHOLE_SQL.format("l")}) AS digest FROM lines
  UNION ALL SELECT doc_id, start AS line, md5(string_agg(form, ' ' ORDER BY place)) FROM runs JOIN filled USING (r)
  WHERE place BETWEEN first AND last GROUP BY r, doc_id, start, first, last)
SELECT doc_id, CAST(line AS INTEGER) AS line, license_id, digest FROM units JOIN known USING (digest)
"""
