"""Licence scan by canonical digests.

A text is brought to a canonical form (lower case, copyright lines dropped,
equivalent spellings made one, punctuation and white space folded) and its
SHA-256 is joined with the digests of known licence texts.  The units looked up
are the whole text and each of its lines, so a document that is a licence and a
document that carries a licence notice are both found; a unit matches only as a
whole.
"""

from __future__ import annotations

import pkgutil

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The entire texts in license_texts, each with the number of its title lines.
_ENTIRE = {
    "Apache-2.0": 3,
    "Artistic-1.0": 1,
    "BSD-3-Clause": 0,
    "CC0-1.0": 2,
    "GFDL-1.2": 2,
    "GFDL-1.3": 2,
    "GPL-1.0": 2,
    "GPL-2.0": 2,
    "GPL-3.0": 2,
    "LGPL-2.0": 2,
    "LGPL-2.1": 2,
    "LGPL-3.0": 2,
    "MPL-1.1": 2,
    "MPL-2.0": 1,
}
#: What the text of a licence ends with where the file goes on with how to apply it.
_END = "END OF TERMS AND CONDITIONS"
#: Titles that short licences carry or not.
_TITLES = {
    "MIT": ["MIT License", "The MIT License", "The MIT License (MIT)"],
    "ISC": ["ISC License", "The ISC License"],
    "BSD-2-Clause": ["BSD 2-Clause License", "The 2-Clause BSD License", "The BSD 2-Clause License", "Simplified BSD License"],
    "BSD-3-Clause": ["BSD 3-Clause License", "The 3-Clause BSD License", "The BSD 3-Clause License", "New BSD License"],
}


def _entire_texts() -> list[tuple[str, str]]:
    """Each text with and without its title, and with and without what follows its terms."""
    out = []
    for name, n_title in _ENTIRE.items():
        text = pkgutil.get_data(__package__, f"license_texts/{name}.txt").decode()
        lines = text.split("\n")
        filled = [k for k, line in enumerate(lines) if any(map(str.isalnum, line))]
        for form in dict.fromkeys([text, "\n".join(lines[filled[n_title] :])]):
            out.append((name, form))
            if _END in form:
                out.append((name, form[: form.index(_END) + len(_END)]))
    return out


def _bsd_texts() -> list[tuple[str, str]]:
    """The BSD licences of any holder: two and three clauses, numbered or with marks."""
    text = pkgutil.get_data(__package__, "license_texts/BSD-3-Clause.txt").decode()
    text = text.replace("University", "copyright holder").replace("THE REGENTS AND", "THE COPYRIGHT HOLDERS AND")
    three = text.replace("THE REGENTS OR", "THE COPYRIGHT HOLDER OR")
    two = three[: three.index("3. ")] + three[three.index("\nTHIS SOFTWARE") :]
    out = []
    for name, numbered in (("BSD-3-Clause", three), ("BSD-2-Clause", two)):
        marked = numbered
        for k in "123":
            marked = marked.replace(f"\n{k}. ", "\n* ")
        for form in (numbered, marked):
            for one in (form, form.replace("THE COPYRIGHT HOLDER OR", "THE COPYRIGHT OWNER OR")):
                out.append((name, one))
    return out


# The usual one-line notices and public licence texts.
_NOTICES = [
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
    ("CC-BY-NC-4.0", "This work is licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "SPDX-License-Identifier: CC-BY-NC-4.0"),
]
_SHORT_TEXTS = [
    (
        "MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        'documentation files (the "Software"), to deal in the Software without restriction, including without limitation '
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and "
        "to permit persons to whom the Software is furnished to do so, subject to the following conditions:\n\n"
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of "
        'the Software.\n\nTHE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING '
        "BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN "
        "NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN "
        "AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR "
        "OTHER DEALINGS IN THE SOFTWARE.",
    ),
    (
        "ISC",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies.\n\n"
        'THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING '
        "ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, "
        "DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR "
        "PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION "
        "WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.",
    ),
]
KNOWN_TEXTS = [*_NOTICES, *_entire_texts(), *_bsd_texts()]
KNOWN_TEXTS += [(a, f"{title}\n\n{b}") for a, b in [*_bsd_texts(), *_SHORT_TEXTS] for title in _TITLES[a]]
KNOWN_TEXTS += _SHORT_TEXTS

# Spellings taken as equal, after lower-casing.
EQUIVALENT = {
    "licence": "license",
    "licences": "licenses",
    "licenced": "licensed",
    "sublicence": "sublicense",
    "favour": "favor",
    "authorisation": "authorization",
    "authorised": "authorized",
    "merchantibility": "merchantability",
    "organisation": "organization",
    "whilst": "while",
}

#: Lines that name the copyright holder, and no more than that: with a year, with the mark, or (without either) at the
#: beginning of a paragraph, as a wrapped text may have a line that begins with the word.
_BEFORE = "[^\\n\\p{L}\\p{N}]*"
COPYRIGHT_LINE = (
    f"(?m)^{_BEFORE}((copyright|[(]c[)]|©)[ \\t]*)+[0-9][^\\n]*$|^{_BEFORE}all rights reserved[.]?[ \\t\\r]*$"
    f"|^[^\\n\\p{{L}}\\p{{N}}©]*(copyright[ \\t:]*([(]c[)]|©)|©)[^\\n]*$"
    f"|(\\A[ \\t\\r\\n]*|\\n[ \\t\\r]*\\n){_BEFORE}copyright[ \\t:]+[^\\n]*(\\n{_BEFORE}copyright[ \\t:]+[^\\n]*)*$"
)


def canonical(text: Column) -> Column:
    """The canonical form; empty where nothing but punctuation and copyright lines is left, null for null."""
    plain = F.replace(F.regexp_replace(F.lower(text), COPYRIGHT_LINE, ""), F.lit("&"), F.lit(" and "))
    words = F.split(F.trim(F.regexp_replace(plain, "[^\\p{L}\\p{N}]+", " ")), " ")
    spelling = F.create_map(*[F.lit(x) for pair in EQUIVALENT.items() for x in pair])
    return F.array_join(F.transform(words, lambda w: F.coalesce(spelling[w], w)), " ")


def known_licenses(spark: SparkSession, texts: list[tuple[str, str]] | None = None) -> DataFrame:
    """``license``, ``digest`` and ``anchor`` of each distinct canonical text; a text of two licences lists both.

    The anchor is the longest word of the text that no other spelling stands for
    ("" if it has none): a text without it, in lower case, cannot match.
    """
    rows = spark.createDataFrame(KNOWN_TEXTS if texts is None else texts, "license string, text string")
    form = rows.select("license", canonical(F.col("text")).alias("form")).filter(F.length("form") > 0)
    spelt = F.array(*[F.lit(x) for x in sorted({*EQUIVALENT.values(), "and"})])
    words = F.filter(F.split("form", " "), lambda w: ~F.array_contains(spelt, w) & w.rlike("^[a-z0-9]+$"))
    longest = F.array_max(F.transform(words, lambda w: F.struct(F.length(w).alias("n"), w.alias("word"))))
    return form.select("license", F.sha2("form", 256).alias("digest"), F.coalesce(longest["word"], F.lit("")).alias("anchor")).distinct()


def scan(docs: DataFrame, known: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: the id, ``licenses`` (sorted, comma-joined, empty if none), ``n_notices`` (lines that
    are a licence text or notice) and ``whole_text`` (the whole text is one).

    A null, empty or unmatched text has no licence.  Rows that repeat an id share
    what all of them have.  Extra columns are ignored.  ``known`` is a table of
    licences; Spark broadcasts it by its measured size, or shuffles.  Only texts
    with one of its anchors are brought to the canonical form, which leaves out
    none that could match.
    """
    anchors = [r[0] for r in known.select("anchor").distinct().orderBy("anchor").collect()]  # a row for each licence text
    texts = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    may = F.lit(False)
    if anchors and "" not in anchors:
        may = F.lower("_text").rlike("|".join(anchors))
    elif anchors:
        may = F.col("_text").isNotNull()
    lines = F.split("_text", "\n")
    whole = F.array(F.struct(F.lit(True).alias("whole"), F.col("_text").alias("unit")))
    each = F.transform(lines, lambda x: F.struct(F.lit(False).alias("whole"), x.alias("unit")))
    units = texts.filter(may).select("_id", F.explode(F.concat(whole, each)).alias("u"))
    found = (
        units.select("_id", F.col("u.whole").alias("whole"), F.sha2(canonical(F.col("u.unit")), 256).alias("digest"))
        .join(known.select("license", "digest"), "digest")
        .groupBy("_id")
        .agg(
            F.array_join(F.sort_array(F.collect_set("license")), ",").alias("licenses"),
            F.count(F.when(~F.col("whole"), 1)).alias("n_notices"),
            F.max("whole").alias("whole_text"),
        )
        .withColumnRenamed("_id", "_found")
    )
    ids = docs.select(F.col(id_col).alias("_id"))
    return ids.join(found, ids["_id"].eqNullSafe(found["_found"]), "left").select(
        F.col("_id").alias(id_col),
        F.coalesce("licenses", F.lit("")).alias("licenses"),
        F.coalesce("n_notices", F.lit(0)).cast("long").alias("n_notices"),
        F.coalesce("whole_text", F.lit(False)).alias("whole_text"),
    )
