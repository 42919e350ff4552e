"""License scans by canonical digests, with DataFrame functions only.

A text is brought into canonical form: lower case, copyright lines out, equivalent spellings
made one, everything but letters and digits as one space.  A copyright line begins with the word
and "(c)", the sign or a year after it, or has a year at its end, or begins with the sign or "(c)"
and a year; "all rights reserved" goes if it is a line of its own.  Other lines that begin with these
words are licence text that was wrapped there and stay.  The form's SHA-256 is joined with
the digests of known licences.  Both a document's whole text and each of its lines are looked
up, so a licence text is found as a document and a notice as a line.

The digests come from the texts below and the full texts in ``license_texts``, in the same form;
their number is that of the list, so the table is broadcast.  A caller can add texts as a table
of any size, which is joined by digest.

Defined cases: a null text has no digest and no licence; an empty one, or one of copyright lines
alone, has the digest of the empty form, which no licence has; a null doc_id stays null; repeated
rows are looked up each by itself; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# Spellings that licence texts use for the same word.
SPELLINGS = [("licence", "license"), ("licences", "licenses"), ("licenced", "licensed"), ("sublicence", "sublicense"),
             ("https", "http"), ("noninfringement", "non infringement"), ("copyright owner", "copyright holder"),
             ("v2", "version 2"), ("v3", "version 3"), ("merchantibility", "merchantability"), ("programme", "program"),
             ("organisation", "organization"), ("acknowledgement", "acknowledgment"), ("favour", "favor"),
             ("whilst", "while"), ("per cent", "percent")]

_GRANT = ("Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
          "documentation files (the \"Software\"), to deal in the Software without restriction, including without "
          "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the "
          "Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: ")
_MIT_NOTICE = ("The above copyright notice and this permission notice shall be included in all copies or substantial "
               "portions of the Software. ")
_AS_IS = ("THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED "
          "TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL "
          "THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF "
          "CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER "
          "DEALINGS IN THE SOFTWARE.")
_BSD_HEAD = ("Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
             "the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, "
             "this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the "
             "above copyright notice, this list of conditions and the following disclaimer in the documentation and/or "
             "other materials provided with the distribution. ")
_BSD_NAMES = ("3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or "
              "promote products derived from this software without specific prior written permission. ")
_BSD_TAIL = ("THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED "
             "WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A "
             "PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY "
             "DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, "
             "PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER "
             "CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE "
             "OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH "
             "DAMAGE.")
_ISC_GRANT = "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"
_ISC_TAIL = ("THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE "
             "INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR "
             "ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, "
             "DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN "
             "CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.")
_APACHE_NOTICE = ("Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
                  "compliance with the License. You may obtain a copy of the License at "
                  "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, "
                  "software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR "
                  "CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing "
                  "permissions and limitations under the License.")

# Known texts and notices, with the licence each stands for.
KNOWN = [
    ("MIT", "MIT License " + _GRANT + _MIT_NOTICE + _AS_IS), ("MIT", "The MIT License (MIT) " + _GRANT + _MIT_NOTICE + _AS_IS),
    ("MIT", _GRANT + _MIT_NOTICE + _AS_IS), ("MIT-0", _GRANT[:-len(", subject to the following conditions: ")] + ". " + _AS_IS),
    ("BSD-2-Clause", _BSD_HEAD + _BSD_TAIL), ("BSD-2-Clause", "BSD 2-Clause License " + _BSD_HEAD + _BSD_TAIL),
    ("BSD-3-Clause", _BSD_HEAD + _BSD_NAMES + _BSD_TAIL), ("BSD-3-Clause", "BSD 3-Clause License " + _BSD_HEAD + _BSD_NAMES + _BSD_TAIL),
    ("ISC", _ISC_GRANT + ", provided that the above copyright notice and this permission notice appear in all copies. " + _ISC_TAIL),
    ("ISC", "ISC License " + _ISC_GRANT + ", provided that the above copyright notice and this permission notice appear in all copies. " + _ISC_TAIL),
    ("0BSD", _ISC_GRANT + ". " + _ISC_TAIL), ("Apache-2.0", _APACHE_NOTICE),
    ("MIT", "Released under the MIT License."), ("MIT", "Licensed under the MIT License."), ("MIT", "SPDX-License-Identifier: MIT"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."), ("Apache-2.0", "Released under the Apache License, Version 2.0."),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "Licensed under the GNU General Public License, version 3."), ("GPL-3.0", "SPDX-License-Identifier: GPL-3.0-only"),
    ("GPL-2.0", "Licensed under the GNU General Public License, version 2."), ("GPL-2.0", "SPDX-License-Identifier: GPL-2.0-only"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."), ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."), ("CC0-1.0", "Released under CC0 1.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("BSD-3-Clause", "SPDX-License-Identifier: BSD-3-Clause"), ("BSD-2-Clause", "SPDX-License-Identifier: BSD-2-Clause"),
    ("MPL-2.0", "SPDX-License-Identifier: MPL-2.0"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was "
                "not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
]


#: Lines that name a holder, in lower case.
_NOTICE = ("(?m)^[ \\t]*(?:copyright[ \\t:]*(?:\\(c\\)|©|[0-9]{4}\\b)[^\\n]*|copyright\\b[^\\n]*\\b(?:19|20)[0-9]{2}[.) \\t\\r]*"
           "|(?:©|\\(c\\)[ \\t]*(?:copyright\\b|[0-9]{4}\\b))[^\\n]*|all rights reserved[.! \\t\\r]*)$")


def canonical(text: Column) -> Column:
    """The form of which digests are made."""
    body = F.regexp_replace(F.lower(text), _NOTICE, " ")
    body = F.concat(F.lit(" "), F.regexp_replace(body, "[^a-z0-9]+", " "), F.lit(" "))
    for word, same in SPELLINGS:
        body = F.replace(body, F.lit(f" {word} "), F.lit(f" {same} "))
    return F.trim(body)


def full_texts() -> list[tuple[str, str]]:
    """(license, text) of the full texts, each named by its file, with and without what follows its terms."""
    out = []
    for path in sorted(Path(__file__).with_name("license_texts").glob("*.txt")):
        text = path.read_text(encoding="utf-8")
        terms, end, _ = text.partition("END OF TERMS AND CONDITIONS")
        out += [(path.name.removesuffix(".txt"), t) for t in dict.fromkeys([text, terms + end])]
    return out


def known_licenses(spark: SparkSession, more: DataFrame | None = None) -> DataFrame:
    """(digest, license), one row per known text: those shipped and the rows (license, text) of ``more``."""
    rows = spark.createDataFrame(KNOWN + full_texts(), "license string, text string")
    if more is not None:
        rows = rows.unionByName(more.select(F.col("license").cast("string"), "text").filter("license IS NOT NULL AND text IS NOT NULL"))
    form = canonical(F.col("text"))
    return rows.select(form.alias("form"), "license").filter("form <> ''").groupBy(F.sha2("form", 256).alias("digest")).agg(F.min("license").alias("license"))


def scan_licenses(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", more: DataFrame | None = None) -> DataFrame:
    """One row per document: digest of the whole text, its licence, and the licences of its lines.

    ``more``: (license, text) of further known texts.  Without it, lines are looked up in the
    known digests as a literal list, of the list's own length; with it, they are joined.
    """
    spark = docs.sparkSession
    known = known_licenses(spark, more)
    rows = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("body"))
    lines = F.split(F.coalesce("body", F.lit("")), "\n")
    digest = F.sha2(canonical(F.col("body")), 256).alias("digest")
    if more is None:
        table = known.collect()  # as many rows as texts are shipped
        names = F.create_map(*[F.lit(v) for r in sorted(table) for v in (r.digest, r.license)])
        found = F.filter(F.transform(lines, lambda x: names[F.sha2(canonical(x), 256)]), lambda x: x.isNotNull())
        whole, known = rows.select("doc_id", digest, found.alias("lines")), F.broadcast(known)
    else:
        # what lines hold depends on the text alone, so it comes back by the text's digest
        key = F.sha2("body", 256).alias("key")
        notes = rows.select(key, F.posexplode(lines).alias("i", "line")).select("key", "i", F.sha2(canonical(F.col("line")), 256).alias("digest")) \
            .join(known, "digest").select("key", "i", "license").distinct().groupBy("key").agg(F.collect_list("license").alias("lines"))
        whole = rows.select("doc_id", digest, key).join(notes, "key", "left").withColumn("lines", F.coalesce("lines", F.array().cast("array<string>")))
    return whole.join(known, "digest", "left").select(
        "doc_id", "digest", "license", F.size("lines").cast("long").alias("n_notices"),
        F.concat_ws(",", F.array_sort(F.array_distinct("lines"))).alias("notices"))
