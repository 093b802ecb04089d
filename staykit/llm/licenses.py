"""Licence scans by canonical digest lookup.

A known licence is an entire text: a notice of one line or a licence of many.
Texts are brought to one canonical form before they are digested:

* A-Z are lower-cased, quotes and dashes unified by dropping all punctuation;
* copyright notices go: lines that begin with "copyright" and a sign, a year
  or a name, or with the sign and a year; what follows such a notice on its
  line stays if it is a licence sentence, and so do sentences of a licence
  that a line break lets begin with "copyright";
* equivalent spellings become one (``licence``/``license``, ``&``/``and``,
  ``http``/``https``, the spellings in ``SPELLINGS``);
* white space of any kind and length is one space, ends trimmed.

The units looked up are the whole document, and each of its lines and
paragraphs (runs of lines without a blank one), since a notice mostly stands
in a longer text. Units are hash-joined on the SHA-256 of the canonical form;
the digest table is built by the same DataFrame functions from the list below
and has as many rows as the list, so it is broadcast. Only units whose length
matches a known text's are digested.

All of it is DataFrame functions; no document's text is shuffled, and a unit
that matches is one small row.

Edge cases: null text is empty; a text that is empty after normalising
matches nothing; a unit found as document, paragraph and line counts once a
kind; repeated rows and null ids are rows like any other; an empty table
gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Canonical licence notices and short licence texts, by SPDX id.
LICENSES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance "
                   "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 "
                   "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed "
                   "on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License "
                   "for the specific language governing permissions and limitations under the License."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "SPDX-License-Identifier: GPL-3.0-only"),
    ("GPL-3.0-or-later", "SPDX-License-Identifier: GPL-3.0-or-later"),
    ("GPL-2.0", "SPDX-License-Identifier: GPL-2.0-only"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under the Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under the Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-SA-4.0", "This work is licensed under the Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC0-1.0", "SPDX-License-Identifier: CC0-1.0"),
    ("BSD-2-Clause", "SPDX-License-Identifier: BSD-2-Clause"),
    ("BSD-3-Clause", "SPDX-License-Identifier: BSD-3-Clause"),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
                "distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
]
# Short licence texts with the headings they stand under ('' for none), by SPDX id.
_BSD = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions "
    "are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. "
    "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the "
    "documentation and/or other materials provided with the distribution. ")
_BSD_END = (
    "ARE DISCLAIMED. IN NO EVENT SHALL THE {0} BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES "
    "(INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) "
    "HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING "
    "IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.")
_BSD_HOLDER = (
    "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT "
    "LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ")
SHORT_TEXTS = [
    ("MIT", ["", "MIT License", "The MIT License", "The MIT License (MIT)", "MIT License (MIT)", "License: MIT"],
     "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
     "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the "
     "rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit "
     "persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and "
     "this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED "
     "\"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF "
     "MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT "
     "HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING "
     "FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."),
    ("ISC", ["", "ISC License", "The ISC License", "ISC License (ISC)"],
     "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
     "provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED \"AS IS\" "
     "AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND "
     "FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES "
     "WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, "
     "ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."),
    ("BSD-2-Clause", ["", "BSD 2-Clause License", "The 2-Clause BSD License", "The BSD 2-Clause License", "Simplified BSD License"],
     _BSD + _BSD_HOLDER + _BSD_END.format("COPYRIGHT HOLDER OR CONTRIBUTORS")),
    ("BSD-3-Clause", ["", "BSD 3-Clause License", "The 3-Clause BSD License", "The BSD 3-Clause License", "New BSD License"],
     _BSD + "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived "
     "from this software without specific prior written permission. " + _BSD_HOLDER + _BSD_END.format("COPYRIGHT HOLDER OR CONTRIBUTORS")),
    ("BSD-3-Clause", ["", "The BSD License"],
     _BSD + "3. Neither the name of the University nor the names of its contributors may be used to endorse or promote products derived "
     "from this software without specific prior written permission. THIS SOFTWARE IS PROVIDED BY THE REGENTS AND CONTRIBUTORS \"AS IS\" AND "
     "ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A "
     "PARTICULAR PURPOSE " + _BSD_END.format("REGENTS OR CONTRIBUTORS")),
    ("Zlib", ["", "zlib License", "The zlib License", "The zlib/libpng License"],
     "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages "
     "arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial "
     "applications, and to alter it and redistribute it freely, subject to the following restrictions: 1. The origin of this software must "
     "not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment "
     "in the product documentation would be appreciated but is not required. 2. Altered source versions must be plainly marked as such, and "
     "must not be misrepresented as being the original software. 3. This notice may not be removed or altered from any source distribution."),
    ("Unlicense", ["", "The Unlicense"],
     "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or "
     "distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any "
     "means. In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright interest in "
     "the software to the public domain. We make this dedication for the benefit of the public at large and to the detriment of our heirs and "
     "successors. We intend this dedication to be an overt act of relinquishment in perpetuity of all present and future rights to this "
     "software under copyright law. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT "
     "LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS BE "
     "LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN "
     "CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE. For more information, please refer to <https://unlicense.org>"),
]
# Where the terms of the long texts end; what follows is how to apply them.
TERMS_END = "END OF TERMS AND CONDITIONS"
LONG_TEXTS = os.path.join(os.path.dirname(os.path.abspath(__file__)), "license_texts")


def known_texts() -> list[tuple[str, str]]:
    """(license, text) of the default table: notices, short texts under each heading, long texts whole and up to the end of their terms."""
    out = list(LICENSES)
    for name, headings, text in SHORT_TEXTS:
        out += [(name, f"{h}\n\n{text}" if h else text) for h in headings]
    for file in sorted(os.listdir(LONG_TEXTS)):
        with open(os.path.join(LONG_TEXTS, file), encoding="utf-8") as f:
            text = f.read()
        name, (terms, end, _) = file.removesuffix(".txt"), text.partition(TERMS_END)
        out += [(name, text)] + ([(name, terms), (name, terms + end)] if end else [])
    return out


# Equivalent spellings, after lower-casing and without punctuation.
SPELLINGS = [
    ("licence", "license"), ("licenced", "licensed"), ("licences", "licenses"), ("licencing", "licensing"), ("sublicence", "sublicense"),
    ("https", "http"), ("noninfringement", "non infringement"), ("organisation", "organization"), ("recognise", "recognize"),
    ("utilise", "utilize"), ("favour", "favor"), ("honour", "honor"), ("merchantibility", "merchantability"), ("cc by", "creative commons by"),
    ("ver 2 0", "version 2 0"), ("v 2 0", "version 2 0"), ("v2 0", "version 2 0"), ("ver 3", "version 3"), ("v3", "version 3"),
]
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# a notice at the start of a line: "copyright" with the sign or a year, or the sign with a year; or with a name
_SIGN, _YEAR = r"(?:\(c\)|©)", r"[\[<{(]?(?:[12][0-9]{3}|year|yyyy)"
_BEGINS = rf"\n[^a-z0-9\n(©]*(?:copyright[ \t:]*{_SIGN}|copyright[ \t:]*(?:by +)?{_YEAR}|{_SIGN}[ \t]*(?:copyright[ \t]*)?(?:by +)?{_YEAR})"
_NAMED = r"\n[^A-Za-z0-9\n]*Copyright(?: [A-Z][A-Za-z.'-]*){2,5}[.,]?[ \t]*\n"
_STARTS = "(?:licensed|released|distributed|permission|redistribution|spdx|this (?:work|file|program|software|project|code|source))"
_NOTICE_THEN = rf"{_BEGINS}[^\n]*?[.;:,)>\]] +({_STARTS}[^\n]*\n)"
_NOTICE = rf"{_BEGINS}[^\n]*\n"
_RESERVED = r"\n[^a-z0-9\n]*all rights reserved[^a-z0-9\n]*\n"
_PUNCTUATION = r"[^a-z0-9\x{80}-\x{10FFFF}]+|[\x{2010}-\x{201F}\x{A0}]+"
_BREAK = r"\n[\x20\x09\x0B-\x0D]*\n[\x20\x09-\x0D]*"


def canonical(text: Column) -> Column:
    """The form under which equal licences are equal."""
    # a line break on both sides of every line
    text = F.concat(F.lit("\n"), F.replace(text, F.lit("\n"), F.lit("\n\n")), F.lit("\n"))
    text = F.translate(F.regexp_replace(text, _NAMED, "\n"), UPPER, LOWER)
    text = F.regexp_replace(text, _NOTICE_THEN, "\n$1")
    text = F.regexp_replace(F.regexp_replace(text, _NOTICE, "\n"), _RESERVED, "\n")
    text = F.regexp_replace(text, "&", " and ")
    text = F.concat(F.lit(" "), F.trim(F.regexp_replace(text, _PUNCTUATION, " ")), F.lit(" "))
    for old, new in SPELLINGS:
        text = F.replace(text, F.lit(f" {old} "), F.lit(f" {new} "))
    return F.trim(F.regexp_replace(text, " +", " "))


def known(table: DataFrame) -> DataFrame:
    """(digest, license) of a licence table, distinct."""
    rows = table.select(F.col("license").cast("string").alias("license"), canonical(F.coalesce(F.col("text").cast("string"), F.lit(""))).alias("canon"))
    return rows.where("canon <> '' and license is not null").select(F.sha2("canon", 256).alias("digest"), "license").distinct()


#: A unit can be a notice only if it holds one of these, in any case.
_MAY = r"(?i)licen[cs]|permission|permitted|public\s+domain"
KINDS = ["whole", "paragraph", "line"]


def _units(text: Column, kind: str, mark: str) -> Column:
    return F.transform(F.split(text, mark), lambda u, i: F.struct(F.lit(kind).alias("kind"), i.alias("at"), u.alias("unit")))


def scan(docs: DataFrame, licenses: DataFrame | None = None) -> DataFrame:
    """Per row: doc_id, license (whole text, or null), n_paragraphs, n_lines, licenses.

    ``n_paragraphs`` and ``n_lines`` count the units that are a known text,
    ``licenses`` is the sorted, comma-joined set of all that were found. The
    argument ``licenses`` (license, text) replaces the default table; two ids
    for one text are both found, and ``license`` is the lesser.
    """
    if licenses is None:
        table = F.broadcast(known(docs.sparkSession.createDataFrame(known_texts(), "license string, text string")))     # a fixed table
    else:
        table = known(licenses)
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    may = text.rlike(_MAY)
    # rows are joined to their hits by their text; what can't have a hit has a key of its own
    key = F.when(may, F.sha2(text, 256)).otherwise(F.concat(F.lit("#"), F.xxhash64("doc_id", text).cast("string")))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), key.alias("key"))
    units = F.concat(
        F.array(F.struct(F.lit("whole").alias("kind"), F.lit(0).alias("at"), text.alias("unit"))),
        _units(text, "paragraph", _BREAK), _units(text, "line", "\n"))
    cut = docs.where(may).select(key.alias("of"), F.explode(F.filter(units, lambda u: u["unit"].rlike(_MAY))).alias("u"))
    digests = cut.select("of", "u.kind", "u.at", F.sha2(canonical(F.col("u.unit")), 256).alias("digest"))
    hits = digests.join(table, "digest").select("of", "kind", "at", "license").distinct()

    def places(kind: str) -> Column:
        return F.count_distinct(F.when(F.col("kind") == kind, F.col("at")))

    found = hits.groupBy("of").agg(
        F.min(F.when(F.col("kind") == "whole", F.col("license"))).alias("license"),
        places("paragraph").alias("n_paragraphs"), places("line").alias("n_lines"),
        F.array_join(F.array_sort(F.collect_set("license")), ",").alias("licenses"))
    return rows.join(found, F.col("key") == F.col("of"), "left").select(
        "doc_id", "license", F.coalesce("n_paragraphs", F.lit(0)).cast("long").alias("n_paragraphs"),
        F.coalesce("n_lines", F.lit(0)).cast("long").alias("n_lines"), F.coalesce("licenses", F.lit("")).alias("licenses"))


def _sql_quote(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _sql_canonical(text: str) -> str:
    text = f"chr(10) || replace({text}, chr(10), chr(10) || chr(10)) || chr(10)"
    text = f"translate(regexp_replace({text}, {_sql_quote(_NAMED)}, chr(10), 'g'), '{UPPER}', '{LOWER}')"
    text = f"regexp_replace({text}, {_sql_quote(_NOTICE_THEN)}, chr(10) || '\\1', 'g')"
    text = f"regexp_replace(regexp_replace({text}, '{_NOTICE}', chr(10), 'g'), '{_RESERVED}', chr(10), 'g')"
    text = f"regexp_replace({text}, '&', ' and ', 'g')"
    text = f"' ' || trim(regexp_replace({text}, '{_PUNCTUATION}', ' ', 'g')) || ' '"
    for old, new in SPELLINGS:
        text = f"replace({text}, ' {old} ', ' {new} ')"
    return f"trim(regexp_replace({text}, ' +', ' ', 'g'))"


ORACLE = f"""
WITH k AS (SELECT DISTINCT sha256({_sql_canonical('t')}) AS digest, l AS license
           FROM (VALUES {', '.join(f'({_sql_quote(n)}, {_sql_quote(t)})' for n, t in known_texts())}) AS v(l, t)),
d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
m AS (SELECT rid, t FROM d WHERE regexp_matches(t, '{_MAY}')),
u AS (SELECT rid, 'whole' AS kind, 0 AS place, t AS unit FROM m
      UNION ALL SELECT rid, 'paragraph', unnest(range(len(p))), unnest(p) FROM (SELECT rid, string_split_regex(t, '{_BREAK}') AS p FROM m)
      UNION ALL SELECT rid, 'line', unnest(range(len(p))), unnest(p) FROM (SELECT rid, string_split(t, chr(10)) AS p FROM m)),
h AS (SELECT DISTINCT rid, kind, place, license
      FROM (SELECT rid, kind, place, sha256({_sql_canonical('unit')}) AS digest FROM u WHERE regexp_matches(unit, '{_MAY}')) JOIN k USING (digest)),
f AS (SELECT rid, min(license) FILTER (kind = 'whole') AS license, count(DISTINCT place) FILTER (kind = 'paragraph') AS n_paragraphs,
      count(DISTINCT place) FILTER (kind = 'line') AS n_lines, string_agg(DISTINCT license, ',' ORDER BY license) AS licenses
      FROM h GROUP BY rid)
SELECT doc_id, license, coalesce(n_paragraphs, 0) AS n_paragraphs, coalesce(n_lines, 0) AS n_lines, coalesce(licenses, '') AS licenses
FROM d LEFT JOIN f USING (rid)
"""
