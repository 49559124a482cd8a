"""Licence scans by canonical digests, with DataFrame functions only.

A text's canonical form: lower case; lines that only state a copyright or that
all rights are reserved removed (``_COPYRIGHT``; a line of a licence that merely
begins with "copyright" stays); every run of characters that are neither letters
nor digits taken as one word gap; equivalent spellings (``SPELLINGS``) replaced by
one of them, word by word, in whole texts also across line ends.  Its SHA-256 is joined to the digests of the known
licences, which get the same form from the same expressions.  Whole texts are
compared: a document is a licence if its whole canonical text is one, and every
line of it is a text of its own, so notices ("Licensed under ...") are found in
documents that hold more than the notice.

The known licences are a table (name, text); ``KNOWN`` holds public ones, and
``licenses_in`` reads a folder of them.  Their digests are broadcast while there are
at most ``BROADCAST_LICENSES`` rows, and joined by a shuffle beyond.  Lines are only
looked up with at most as many words as the longest known text has.

Texts without any copyright mark or any spelling of the table skip those passes.
Line digests meet the known ones first: per document only its hits and one marker
are grouped, by a row number that stays inside the plan.

Defined results.  One row per document, repeated rows and equal or NULL ids too.
NULL text is empty; a text without any letter or digit has the empty canonical form
and no licence.  Two names with one canonical text are both found: the smaller is
``license``, the list of notices holds both.  An empty table gives an empty result;
extra columns are ignored.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vaultmart.llm.common import id_and_text, named

BROADCAST_LICENSES = 10_000

# Spellings that count as equal, as (written, canonical).
SPELLINGS = [
    ("licence", "license"), ("licences", "licenses"), ("licenced", "licensed"), ("sublicence", "sublicense"),
    ("acknowledgement", "acknowledgment"), ("analogue", "analog"), ("analyse", "analyze"), ("artefact", "artifact"),
    ("authorisation", "authorization"), ("authorised", "authorized"), ("calibre", "caliber"),
    ("cancelled", "canceled"), ("catalogue", "catalog"), ("categorise", "categorize"), ("centre", "center"),
    ("emphasised", "emphasized"), ("favour", "favor"), ("favourite", "favorite"), ("fulfil", "fulfill"),
    ("fulfilment", "fulfillment"), ("initialise", "initialize"), ("judgement", "judgment"),
    ("labelling", "labeling"), ("labour", "labor"), ("maximise", "maximize"), ("modelled", "modeled"),
    ("modelling", "modeling"), ("offence", "offense"), ("optimise", "optimize"), ("organisation", "organization"),
    ("organise", "organize"), ("practise", "practice"), ("programme", "program"), ("realise", "realize"),
    ("recognise", "recognize"), ("signalling", "signaling"), ("utilisation", "utilization"), ("whilst", "while"),
    ("wilful", "willful"), ("noncommercial", "non commercial"), ("copyright holder", "copyright owner"),
    ("copyright holders", "copyright owners"), ("percent", "per cent"), ("owner s", "owners"),
]

# Public licence texts and notices, one paragraph a line.
_MIT = (
    'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated '
    'documentation files (the "Software"), to deal in the Software without restriction, including without '
    'limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of '
    'the Software, and to permit persons to whom the Software is furnished to do so, subject to the following '
    'conditions:\n\n'
    'The above copyright notice and this permission notice shall be included in all copies or substantial '
    'portions of the Software.\n\n'
    'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT '
    'LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO '
    'EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN '
    'AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE '
    'OR OTHER DEALINGS IN THE SOFTWARE.')
_ISC = (
    'Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is '
    'hereby granted, provided that the above copyright notice and this permission notice appear in all copies.\n\n'
    'THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE '
    'INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR '
    'ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF '
    'USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF '
    'OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.')
_APACHE = (
    'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in '
    'compliance with the License. You may obtain a copy of the License at\n\n'
    'http://www.apache.org/licenses/LICENSE-2.0\n\n'
    'Unless required by applicable law or agreed to in writing, software distributed under the License is '
    'distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. '
    'See the License for the specific language governing permissions and limitations under the License.')
_WARRANTY = (
    'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED '
    'WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A '
    'PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY '
    'DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, '
    'PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER '
    'CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR '
    'OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH '
    'DAMAGE.')
_BSD2 = (
    'Redistribution and use in source and binary forms, with or without modification, are permitted provided that '
    'the following conditions are met:\n\n'
    '1. Redistributions of source code must retain the above copyright notice, this list of conditions and the '
    'following disclaimer.\n\n'
    '2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the '
    'following disclaimer in the documentation and/or other materials provided with the distribution.\n\n')
_BSD3 = _BSD2 + (
    '3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or '
    'promote products derived from this software without specific prior written permission.\n\n')
_0BSD = (
    'Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is '
    'hereby granted.\n\n') + _ISC.split('\n\n')[1]
_ZLIB = (
    "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be "
    'held liable for any damages arising from the use of this software.\n\n'
    'Permission is granted to anyone to use this software for any purpose, including commercial applications, and '
    'to alter it and redistribute it freely, subject to the following restrictions:\n\n'
    '1. The origin of this software must not be misrepresented; you must not claim that you wrote the original '
    'software. If you use this software in a product, an acknowledgment in the product documentation would be '
    'appreciated but is not required.\n\n'
    '2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the '
    'original software.\n\n'
    '3. This notice may not be removed or altered from any source distribution.')
_UNLICENSE = (
    'This is free and unencumbered software released into the public domain.\n\n'
    'Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source '
    'code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.\n\n'
    'In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all '
    'copyright interest in the software to the public domain. We make this dedication for the benefit of the '
    'public at large and to the detriment of our heirs and successors. We intend this dedication to be an overt '
    'act of relinquishment in perpetuity of all present and future rights to this software under copyright '
    'law.\n\n' + _MIT.split('\n\n')[2].replace('AUTHORS OR COPYRIGHT HOLDERS', 'AUTHORS') +
    '\n\nFor more information, please refer to <https://unlicense.org>')
_BOOST = (
    'Boost Software License - Version 1.0 - August 17th, 2003\n\n'
    'Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software '
    'and accompanying documentation covered by this license (the "Software") to use, reproduce, display, '
    'distribute, execute, and transmit the Software, and to prepare derivative works of the Software, and to permit '
    'third-parties to whom the Software is furnished to do so, all subject to the following:\n\n'
    'The copyright notices in the Software and this entire statement, including the above license grant, this '
    'restriction and the following disclaimer, must be included in all copies of the Software, in whole or in part, '
    'and all derivative works of the Software, unless such copies or derivative works are solely in the form of '
    'machine-executable object code generated by a source language processor.\n\n'
    'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED '
    'TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE, TITLE AND NON-INFRINGEMENT. IN NO '
    'EVENT SHALL THE COPYRIGHT HOLDERS OR ANYONE DISTRIBUTING THE SOFTWARE BE LIABLE FOR ANY DAMAGES OR OTHER '
    'LIABILITY, WHETHER IN CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR '
    'THE USE OR OTHER DEALINGS IN THE SOFTWARE.')
_MIT0 = _MIT.split(', subject to')[0] + '.\n\n' + _MIT.split('\n\n')[2]
KNOWN = [
    ("BSD-2-Clause", _BSD2 + _WARRANTY), ("BSD-2-Clause", "BSD 2-Clause License\n" + _BSD2 + _WARRANTY),
    ("BSD-3-Clause", _BSD3 + _WARRANTY), ("BSD-3-Clause", "BSD 3-Clause License\n" + _BSD3 + _WARRANTY),
    ("0BSD", _0BSD), ("MIT-0", _MIT0), ("MIT-0", "MIT No Attribution\n" + _MIT0), ("Zlib", _ZLIB),
    ("Zlib", "zlib License\n" + _ZLIB), ("Unlicense", _UNLICENSE), ("BSL-1.0", _BOOST),
    ("MIT", _MIT), ("MIT", "The MIT License\n" + _MIT), ("MIT", "MIT License\n" + _MIT), ("MIT", "The MIT License (MIT)\n" + _MIT),
    ("ISC", _ISC), ("ISC", "ISC License\n" + _ISC), ("Apache-2.0", _APACHE),
    ("MIT", "Released under the MIT License."), ("MIT", "Licensed under the MIT License."),
    ("MIT", "SPDX-License-Identifier: MIT"), ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."), ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."), ("CC0-1.0", "Dedicated to the public domain under CC0 1.0."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "SPDX-License-Identifier: GPL-3.0"), ("BSD-3-Clause", "SPDX-License-Identifier: BSD-3-Clause"),
    ("BSD-3-Clause", "Released under the BSD 3-Clause License."),
]

# Lines that only state a copyright: the word or a sign with a year (or its
# placeholder), the word with a sign or "by", or a © alone; a paragraph of one short
# line that begins with the word; "all rights reserved" and nothing else.
_GAP = r"[^\p{L}\p{N}\n]*"
STATES = (rf"{_GAP}(?:(?:copyright|\(c\)){_GAP}(?:[0-9]{{4}}|[<\[{{](?:year|yyyy))[^\n]*"
          rf"|copyright{_GAP}(?:\(c\)|©|by\b)[^\n]*|©[^\n]*|all{_GAP}rights{_GAP}reserved{_GAP})")
SHORT = rf"{_GAP}copyright[^\n]{{0,100}}"
BLANK = r"[ \t\r]{0,8}"
# looked for at the beginnings of lines alone, and there only behind a cheap test
_COPYRIGHT = (rf"(?md)^(?={_GAP}(?:copyright|\(c\)|©|all))"
              rf"(?:{STATES}$|(?<=\A|\A{BLANK}\n|\n{BLANK}\n){SHORT}(?=\n{BLANK}(?:\n|\z)|\z))")
_MARKS = ("copyright", "(c)", "©", "rights")
_SPELLED = " (?:" + "|".join(w.replace(" ", "  ") for w, _ in SPELLINGS) + ") "
_SEVERAL = [(w, one) for w, one in SPELLINGS if " " in w]


def _any_of(column: Column, parts) -> Column:
    return functools.reduce(lambda x, y: x | y, [column.contains(p) for p in parts])


def with_canonical(rows: DataFrame) -> DataFrame:
    """``text`` becomes ``lines``, the canonical form with its line breaks, and
    ``canonical``, the whole text without them; words stand between single spaces."""
    lines = F.col("lines")
    out = rows.withColumn("lines", F.lower("text")).drop("text")
    out = out.withColumn("lines", F.when(_any_of(lines, _MARKS), F.regexp_replace(lines, _COPYRIGHT, "")).otherwise(lines))
    # Every gap is written as two spaces, so neighbouring words can both be replaced.
    gaps = F.replace(F.regexp_replace(lines, r"[^\p{L}\p{N}\n]+", "  "), F.lit("\n"), F.lit("  \n  "))
    out = out.withColumn("lines", F.concat(F.lit("  "), gaps, F.lit("  ")))
    replaced = lines
    for written, one in SPELLINGS:
        replaced = F.replace(replaced, F.lit(f" {written.replace(' ', '  ')} "), F.lit(f" {one.replace(' ', '  ')} "))
    out = out.withColumn("lines", F.when(lines.rlike(_SPELLED), replaced).otherwise(lines))
    out = out.withColumn("lines", F.regexp_replace(lines, " +", " "))
    # spellings of several words once more, for a line end may have been inside them
    whole = joined = F.col("canonical")
    for written, one in _SEVERAL:
        joined = F.regexp_replace(joined, f" {written}(?= )", f" {one}")
    return (out.withColumn("canonical", F.replace(lines, F.lit("\n "), F.lit("")))
               .withColumn("canonical", F.trim(F.when(_any_of(whole, [f" {w} " for w, _ in _SEVERAL]), joined)
                                               .otherwise(whole))))


def digest(canonical: Column) -> Column:
    """SHA-256 of a canonical text; NULL for the empty one."""
    return F.when(canonical != "", F.sha2(canonical, 256))


def known_licenses(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(KNOWN, "name string, text string")


def licenses_in(spark: SparkSession, folder: str) -> DataFrame:
    """(name, text) of every file of a folder: its name without the ending, its whole text."""
    name = F.regexp_extract(F.input_file_name(), r"([^/]+?)(?:\.(?:txt|md))?$", 1)
    return spark.read.text(folder, wholetext=True).select(F.url_decode(name).alias("name"), F.col("value").alias("text"))


def license_digests(licenses: DataFrame) -> DataFrame:
    known = with_canonical(licenses.select(named("name").alias("name"), named("text").cast("string").alias("text")))
    return (known.where("canonical <> ''").groupBy(digest(F.col("canonical")).alias("known"))
            .agg(F.min("name").alias("license"), F.sort_array(F.collect_set("name")).alias("names"),
                 F.max(F.size(F.split("canonical", " "))).alias("words")))


def scan(docs: DataFrame, licenses: DataFrame | None = None, id_col: str = "doc_id",
         text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, canonical_sha256, license (of the whole
    text, or NULL), notices (names found on whole lines, comma-joined, or '')."""
    spark = docs.sparkSession
    known = license_digests(known_licenses(spark) if licenses is None else licenses)
    rows, longest = known.agg(F.count("*"), F.coalesce(F.max("words"), F.lit(0))).first()
    known = F.broadcast(known) if rows <= BROADCAST_LICENSES else known
    base = with_canonical(id_and_text(docs, id_col, text_col, F.monotonically_increasing_id().alias("row")))
    # A line is looked up if it is short enough to be a known text.
    lines = F.transform(F.split("lines", "\n"), lambda x: F.trim(x))
    lines = F.filter(lines, lambda x: (x != "") & (F.length(x) - F.length(F.replace(x, F.lit(" "))) < longest))
    digests = F.transform(F.array_distinct(lines), lambda x: F.sha2(x, 256))
    each = base.select("doc_id", "row", F.sha2("canonical", 256).alias("canonical_sha256"),
                       F.explode(F.concat(F.array(F.lit("")), digests)).alias("known"))      # '' keeps the document
    found = (each.join(known.select("known", "names"), "known", "left")
             .where("known = '' OR names IS NOT NULL")
             .groupBy("row", "doc_id", "canonical_sha256")
             .agg(F.array_join(F.sort_array(F.array_distinct(F.flatten(F.collect_set("names")))), ",").alias("notices")))
    return (found.join(known.select(F.col("known").alias("canonical_sha256"), "license"), "canonical_sha256", "left")
                 .select("doc_id", "canonical_sha256", "license", "notices"))
