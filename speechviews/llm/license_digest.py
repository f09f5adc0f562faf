"""Licence scans by canonical digest; DataFrame functions only.

A text and each of its lines are normalised (case, copyright lines, punctuation, equivalent spellings, blanks) and the
SHA-256 of the whole normalised unit is hash-joined with the digests of known licence texts and notices, which the
same functions normalise. A title line ("MIT License") before a whole text is dropped on both sides. A digest of several known licences
names all of them. The known list is a constant unless the caller gives a table, which is broadcast only
when it is proven small. Only ids and digests leave the scan.

Nulls and empty texts, or units without a letter or digit, match nothing; null ids and repeated rows are judged by their
text. An empty table gives no rows.
"""

from pyspark.sql import DataFrame, SparkSession, functions as F

from speechviews.llm.common import text_or_empty
from speechviews.session import broadcast_if_small

#: Spellings taken as equal (fixed values).
SPELLINGS = [
    ("licence", "license"), ("acknowledgement", "acknowledgment"), ("analogue", "analog"), ("authoris", "authoriz"),
    ("favour", "favor"), ("fulfilment", "fulfillment"), ("initialis", "initializ"), ("judgement", "judgment"),
    ("modernis", "moderniz"), ("organis", "organiz"), ("recognis", "recogniz"), ("utilis", "utiliz"),
    ("sub license", "sublicense"), ("copyright owner", "copyright holder"), ("per cent", "percent"), ("non commercial", "noncommercial"),
]

#: The disclaimer that the BSD licences share (fixed value).
BSD_DISCLAIMER = (
    "\n\nTHIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, "
    "INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. "
    "IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR "
    "CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR "
    "PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR "
    "TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE "
    "POSSIBILITY OF SUCH DAMAGE."
)

#: The grant and the first two conditions that the BSD licences share (fixed value).
BSD_CONDITIONS = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following "
    "conditions are met:\n\n1. Redistributions of source code must retain the above copyright notice, this list of conditions and "
    "the following disclaimer.\n\n2. Redistributions in binary form must reproduce the above copyright notice, this list of "
    "conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."
)

#: Licence texts and notices known by name (fixed values).
KNOWN = [
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Released under the Apache License, Version 2.0."),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "Licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "SPDX-License-Identifier: GPL-3.0-only"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC0-1.0", "SPDX-License-Identifier: CC0-1.0"),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
            "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation "
            "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to "
            "permit persons to whom the Software is furnished to do so, subject to the following conditions:\n\nThe above "
            "copyright notice and this permission notice shall be included in all copies or substantial portions of the "
            "Software.\n\nTHE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT "
            "LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL "
            "THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, "
            "TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
            "provided that the above copyright notice and this permission notice appear in all copies.\n\nTHE SOFTWARE IS PROVIDED "
            "\"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF "
            "MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL "
            "DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE "
            "OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."),
    ("BSD-2-Clause", BSD_CONDITIONS + BSD_DISCLAIMER),
    ("BSD-3-Clause", BSD_CONDITIONS + "\n\n3. Neither the name of the copyright holder nor the names of its contributors may be used to "
                     "endorse or promote products derived from this software without specific prior written permission." + BSD_DISCLAIMER),
    ("Zlib", "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable "
             "for any damages arising from the use of this software.\n\nPermission is granted to anyone to use this software for any "
             "purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following "
             "restrictions:\n\n1. The origin of this software must not be misrepresented; you must not claim that you wrote the original "
             "software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is "
             "not required.\n2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the "
             "original software.\n3. This notice may not be removed or altered from any source distribution."),
    ("Unlicense", "This is free and unencumbered software released into the public domain.\n\nAnyone is free to copy, modify, publish, "
                  "use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, "
                  "commercial or non-commercial, and by any means.\n\nIn jurisdictions that recognize copyright laws, the author or "
                  "authors of this software dedicate any and all copyright interest in the software to the public domain. We make this "
                  "dedication for the benefit of the public at large and to the detriment of our heirs and successors. We intend this "
                  "dedication to be an overt act of relinquishment in perpetuity of all present and future rights to this software under "
                  "copyright law.\n\nTHE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT "
                  "NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT "
                  "SHALL THE AUTHORS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR "
                  "OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.\n\n"
                  "For more information, please refer to <https://unlicense.org/>"),
    ("0BSD", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted."
             "\n\nTHE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL "
             "IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, "
             "INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN "
             "ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF "
             "THIS SOFTWARE."),
]

#: Lines that name the owner, with or without a year, and the reservation of rights after them.
COPYRIGHT_LINE = r"(^|\n)[^a-z0-9\n(]*((copyright|\(c\)|©)[^\n]*[0-9]{4}[^\n]*|(copyright[ ]*\(c\)|copyright[ ]*©|©|copyright by )[^\n]*|all rights reserved)"
#: A first line that is the name of a licence of the list, such as "The MIT License (MIT)", in normalised text; a notice is none.
TITLE = r"^[ \n]*(the )?(new |modified |simplified |zero clause )?(mit|isc|bsd|0bsd|zlib|unlicense)( [^\n]{0,40})?\n"
NOT_WORD = r"[^\p{L}\p{N}\n]+"


def normalised(text):
    """Lower case, no copyright lines, one blank for each run of other characters, equal spellings; newlines stay."""
    t = F.lower(text)
    t = F.when(F.contains(t, F.lit("copyright")) | F.contains(t, F.lit("(c)")) | F.contains(t, F.lit("©")) | F.contains(t, F.lit("all rights reserved")),
               F.regexp_replace(t, COPYRIGHT_LINE, "\n")).otherwise(t)
    t = F.regexp_replace(t, NOT_WORD, " ")
    for spelled, common in SPELLINGS:
        t = F.replace(t, F.lit(spelled), F.lit(common))
    return t


def whole(text):
    """A normalised unit of several lines as one, without its title line."""
    titled = F.contains(F.substring(text, 1, 400), F.lit("license"))
    return F.trim(F.regexp_replace(F.when(titled, F.regexp_replace(text, TITLE, "")).otherwise(text), r"[ \n]+", " "))


def known_digests(spark: SparkSession, known=None) -> DataFrame:
    """``digest, license`` of the known texts; ``known`` is a table ``license, text`` to use instead of the list."""
    table = known if known is not None else spark.createDataFrame(KNOWN, "license string, text string")
    unit = whole(normalised(text_or_empty()))
    return table.select(F.sha2(unit, 256).alias("digest"), "license", unit.alias("unit")).where("unit <> ''").groupBy("digest").agg(
        F.array_join(F.sort_array(F.collect_set("license")), "|").alias("license")
    )


def matches(docs: DataFrame, known: DataFrame) -> DataFrame:
    """``doc_id, text_key, line, license``; line -1 is the whole text."""
    rows = docs.select("doc_id", F.xxhash64("text").alias("text_key"), normalised(text_or_empty()).alias("norm"))
    lines = F.transform(F.split("norm", "\n"), lambda line: F.trim(line))
    units = rows.select("doc_id", "text_key", F.posexplode(F.concat(F.array(whole(F.col("norm"))), lines)).alias("line", "unit"))
    hashed = units.where("unit <> ''").select("doc_id", "text_key", (F.col("line") - 1).alias("line"), F.sha2("unit", 256).alias("digest"))
    digests, _ = broadcast_if_small(known)
    return hashed.join(digests, "digest").drop("digest")


def scanned(docs: DataFrame, known=None) -> DataFrame:
    """Every row's ``doc_id, text_license, line_licenses, n_license_lines``."""
    found = matches(docs, known_digests(docs.sparkSession, known)).distinct()
    line = F.when(F.col("line") >= 0, F.col("license"))
    per = found.groupBy(F.col("doc_id").alias("id_"), F.col("text_key").alias("key_")).agg(
        F.max(F.when(F.col("line") < 0, F.col("license"))).alias("text_license"),
        F.array_join(F.sort_array(F.collect_set(line)), ",").alias("line_licenses"),
        F.count(line).alias("n_license_lines"),
    )
    rows = docs.select("doc_id", F.xxhash64("text").alias("text_key"))
    same = F.col("doc_id").eqNullSafe(F.col("id_")) & (F.col("text_key") == F.col("key_"))
    return rows.join(per, same, "left").select(
        "doc_id", "text_license", F.coalesce("line_licenses", F.lit("")).alias("line_licenses"),
        F.coalesce("n_license_lines", F.lit(0)).cast("long").alias("n_license_lines"),
    )


def _sql(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _sql_normalised(column: str) -> str:
    t = f"regexp_replace(lower({column}), {_sql(COPYRIGHT_LINE)}, chr(10), 'g')"
    t = f"regexp_replace({t}, {_sql(NOT_WORD)}, ' ', 'g')"
    for spelled, common in SPELLINGS:
        t = f"replace({t}, {_sql(spelled)}, {_sql(common)})"
    return t


_UNTITLED = f"CASE WHEN contains(substr(norm, 1, 400), 'license') THEN regexp_replace(norm, {_sql(TITLE)}, '') ELSE norm END"
_WHOLE = f"trim(regexp_replace({_UNTITLED}, '[ \\n]+', ' ', 'g'))"
ORACLE = f"""
WITH known AS (
  SELECT sha256(unit) AS digest, string_agg(DISTINCT license, '|' ORDER BY license) AS license FROM (
    SELECT license, {_WHOLE} AS unit FROM (
      SELECT license, {_sql_normalised("text")} AS norm FROM (VALUES {", ".join(f"({_sql(n)}, {_sql(t)})" for n, t in KNOWN)}) AS k(license, text)))
  WHERE unit <> '' GROUP BY 1),
texts AS (SELECT doc_id, {_sql_normalised("coalesce(text, '')")} AS norm FROM documents),
units AS (
  SELECT doc_id, true AS is_text, {_WHOLE} AS unit FROM texts
  UNION ALL SELECT doc_id, false, trim(unnest(string_split(norm, chr(10)))) FROM texts),
found AS (SELECT doc_id, is_text, license FROM units JOIN known ON sha256(unit) = digest WHERE unit <> '')
SELECT d.doc_id, max(license) FILTER (WHERE is_text) AS text_license,
  coalesce(string_agg(DISTINCT license, ',' ORDER BY license) FILTER (WHERE NOT is_text), '') AS line_licenses,
  count(license) FILTER (WHERE NOT is_text) AS n_license_lines
FROM documents d LEFT JOIN found f ON f.doc_id = d.doc_id GROUP BY d.doc_id"""
