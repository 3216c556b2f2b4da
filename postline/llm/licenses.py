"""License scan by canonical digests.

A text is brought to a canonical form, line by line: ASCII letters to lower case,
every run of other ASCII characters but digits and of Unicode punctuation to one
space, equivalent spellings to one of them; empty lines and copyright lines are left out and the rest is
joined with single spaces.  The digest of the whole canonical text is looked up
among the digests of known licence texts, and so is the digest of each canonical
line, for notices that stand on a line of their own.  A known text has to be the
entire text or the entire line: nothing is cut or guessed.

Known digests are a table; digests meet it by a hash join, a line that very many
documents hold is one row before that join.

Defined results: a null text counts as empty; an empty canonical text has no
licence; a null doc_id stays null; repeated rows are each reported; a known text
listed under several licences reports the smallest name; an empty table gives an
empty result; columns other than the two named are not read.
"""

from __future__ import annotations

from importlib.resources import files

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from postline.llm.common import cut, read_table

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
OTHER = (r"[\x00-\x2f\x3a-\x60\x7b-\x7f\x{a0}\x{ab}\x{ad}\x{b7}\x{bb}\x{2000}-\x{206f}\x{2212}\x{3000}-\x{3003}"
         r"\x{300a}-\x{300f}\x{feff}]+")

# Spellings on the left count as those on the right.
SPELLINGS = [
    ("licence", "license"), ("licences", "licenses"), ("licenced", "licensed"), ("sublicence", "sublicense"),
    ("acknowledgement", "acknowledgment"), ("analogue", "analog"), ("analyse", "analyze"), ("artefact", "artifact"),
    ("authorisation", "authorization"), ("authorised", "authorized"), ("cancelled", "canceled"),
    ("catalogue", "catalog"), ("centre", "center"), ("favour", "favor"), ("fulfil", "fulfill"),
    ("initialise", "initialize"), ("judgement", "judgment"), ("labour", "labor"), ("modelled", "modeled"),
    ("non commercial", "noncommercial"), ("organisation", "organization"), ("per cent", "percent"),
    ("recognise", "recognize"), ("utilisation", "utilization"), ("whilst", "while"), ("wilful", "willful"),
    ("https", "http"), ("merchantibility", "merchantability"), ("copyright owner", "copyright holder"),
    ("\u00a9", "copyright"),
]

BSD_START = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.

"""
BSD_NAMES = """3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.

"""
BSD_END = """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""

# Known notices and licence texts.
_LISTED = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License");'),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("BSD-3-Clause", "SPDX-License-Identifier: BSD-3-Clause"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "SPDX-License-Identifier: GPL-3.0-only"),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("0BSD", """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""),
    ("ISC", """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""),
    ("MIT", """MIT License

Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""),
]


# Usual titles; the first is none.
TITLES = {
    "0BSD": ("", "BSD Zero Clause License", "Zero-Clause BSD", "Zero Clause BSD License"),
    "BSD-2-Clause": ("", "BSD 2-Clause License", "The BSD 2-Clause License", 'BSD 2-Clause "Simplified" License', "Simplified BSD License"),
    "BSD-3-Clause": ("", "BSD 3-Clause License", "The BSD 3-Clause License", 'BSD 3-Clause "New" or "Revised" License', "New BSD License",
                     "Modified BSD License"),
    "ISC": ("", "ISC License", "The ISC License", "ISC License (ISC)"),
    "MIT": ("", "MIT License", "The MIT License", "The MIT License (MIT)", "MIT License (MIT)"),
}
TERMS_END = "END OF TERMS AND CONDITIONS"


def _known() -> list[tuple[str, str]]:
    """Notices, short licences under each title, and the full texts of the files with and without what follows their terms."""
    mit = _LISTED[-1][1]
    bodies = [(name, text) for name, text in _LISTED[:-1] if name in ("0BSD", "ISC") and "\n" in text]
    bodies += [("BSD-2-Clause", BSD_START + BSD_END), ("BSD-3-Clause", BSD_START + BSD_NAMES + BSD_END), ("MIT", mit.split("\n", 1)[1])]
    out = _LISTED[:-1] + [(name, f"{title}\n\n{text}") for name, text in bodies for title in TITLES[name]]
    for file in sorted(files("postline.llm").joinpath("license_texts").iterdir(), key=lambda f: f.name):
        if file.name.endswith(".txt"):
            name, text = file.name.removesuffix(".txt"), file.read_text(encoding="utf-8")
            out.append((name, text))
            if TERMS_END in text:
                out.append((name, text[:text.index(TERMS_END)]))
                out.append((name, text[:text.index(TERMS_END) + len(TERMS_END)]))
    return [*out, _LISTED[-1]]


KNOWN = _known()


SALTS = 16


def canonical_line(line: Column) -> Column:
    plain = F.trim(F.regexp_replace(F.translate(line, UPPER, LOWER), OTHER, " "))
    padded = F.concat(F.lit(" "), plain, F.lit(" "))
    for old, new in SPELLINGS:
        padded = F.replace(padded, F.lit(f" {old} "), F.lit(f" {new} "))
    return F.trim(padded)


def _is_copyright(line: Column) -> Column:
    """On a canonical line."""
    return line.startswith("copyright ") | line.startswith("c copyright ") | (line == "copyright") | (line == "all rights reserved")


def _canonical_lines(text: Column) -> Column:
    lines = F.transform(F.split(text, "\n", -1), canonical_line)
    return F.filter(lines, lambda x: (x != "") & ~_is_copyright(x))


def known_digests(spark: SparkSession, known: list[tuple[str, str]]) -> DataFrame:
    """(digest, license): distinct canonical digests of the known texts."""
    listed = spark.createDataFrame(known, "license string, text string")
    text = F.array_join(_canonical_lines(F.col("text")), " ")
    return (listed.select("license", text.alias("canonical")).where("canonical <> ''")
            .groupBy(F.md5("canonical").alias("digest")).agg(F.min("license").alias("license")))


def scan_licenses(docs: DataFrame, known: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text_digest, text_license, line_licenses, n_license_lines) for each row.

    ``line_licenses`` are the distinct licences of whole lines, in order, comma-joined.
    """
    lines = _canonical_lines(F.coalesce(F.col(text_col).cast("string"), F.lit("")))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), lines.alias("lines"))
    rows = cut(rows.select(
        "doc_id", F.md5(F.array_join("lines", " ")).alias("text_digest"), (F.size("lines") == 0).alias("bare"),
        F.transform("lines", lambda x: F.md5(x.cast("binary"))).alias("lines")), "digests")
    texts = rows.select("text_digest").distinct().join(
        known.select(F.col("digest").alias("text_digest"), F.col("license").alias("text_license")), "text_digest")
    each = rows.select("text_digest", F.hash("lines").alias("lines_hash"), F.explode(F.array_distinct("lines")).alias("digest"))
    # rows of one canonical text have the same lines but for where they break
    found = each.distinct().join(known, "digest")
    named = found.groupBy("text_digest", "lines_hash").agg(
        F.array_join(F.array_sort(F.collect_set("license")), ",").alias("line_licenses"),
        F.collect_set("digest").alias("digests"))
    # copies of one text are dealt over several keys; only texts with a known digest or line are repeated for that
    salts = F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(SALTS - 1).cast("bigint"))).alias("salt")
    out = (rows.withColumn("lines_hash", F.hash("lines")).withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)))
           .join(texts.select("*", salts), ["text_digest", "salt"], "left")
           .join(named.select("*", salts), ["text_digest", "lines_hash", "salt"], "left"))
    hits = F.size(F.filter("lines", lambda x: F.array_contains(F.col("digests"), x)))
    return out.select(
        "doc_id", "text_digest", F.when(~F.col("bare"), F.col("text_license")).alias("text_license"),
        F.coalesce("line_licenses", F.lit("")).alias("line_licenses"),
        F.when(F.col("digests").isNull(), 0).otherwise(hits).cast("long").alias("n_license_lines"))


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Known licences among the whole texts and whole lines of ``documents``."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return scan_licenses(docs, known_digests(spark, KNOWN))


def _sql_canonical(line: str) -> str:
    out = f"' ' || trim(regexp_replace(translate({line}, '{UPPER}', '{LOWER}'), '{OTHER}', ' ', 'g')) || ' '"
    for old, new in SPELLINGS:
        out = f"replace({out}, ' {old} ', ' {new} ')"
    return f"trim({out})"


_KNOWN_SQL = ", ".join("('{}', '{}')".format(n, t.replace("'", "''")) for n, t in KNOWN)
ORACLE = f"""
WITH texts AS (
  SELECT row_number() OVER () AS id, doc_id, coalesce(text, '') AS text, NULL AS license FROM documents
  UNION ALL SELECT -row_number() OVER (), NULL, text, license FROM (VALUES {_KNOWN_SQL}) AS k(license, text)),
lines AS (
  SELECT id, doc_id, license, list_filter(
    list_transform(string_split(text, chr(10)), lambda x: {_sql_canonical('x')}),
    lambda x: x <> '' AND NOT (starts_with(x, 'copyright ') OR starts_with(x, 'c copyright ')
                               OR x IN ('copyright', 'all rights reserved'))) AS lines FROM texts),
digests AS (SELECT id, doc_id, license, lines, md5(coalesce(array_to_string(lines, ' '), '')) AS digest FROM lines),
known AS (SELECT digest, min(license) AS license FROM digests WHERE id < 0 AND len(lines) > 0 GROUP BY digest),
hits AS (
  SELECT id, string_agg(DISTINCT known.license, ',' ORDER BY known.license) AS names, count(*) AS n
  FROM (SELECT id, md5(unnest(lines)) AS digest FROM digests WHERE id > 0) AS l JOIN known USING (digest) GROUP BY id)
SELECT doc_id, d.digest AS text_digest, CASE WHEN len(lines) > 0 THEN known.license END AS text_license,
       coalesce(names, '') AS line_licenses, coalesce(n, 0) AS n_license_lines
FROM digests AS d LEFT JOIN known USING (digest) LEFT JOIN hits USING (id) WHERE id > 0
"""
