"""Licences by canonical digest: texts are normalised and hash-joined, whole, to known digests."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from haulwatch.llm.common import body, documents, small_table

# Beginnings of words that have two spellings, after lower case.
SPELLINGS = (
    ("acknowledgement", "acknowledgment"), ("authoris", "authoriz"), ("centre", "center"), ("favour", "favor"),
    ("initialis", "initializ"), ("judgement", "judgment"), ("labour", "labor"), ("licence", "license"),
    ("noncommercial", "non commercial"), ("organis", "organiz"), ("programme", "program"),
    ("recognis", "recogniz"), ("utilis", "utiliz"), ("whilst", "while"), ("wilful", "willful"),
)

# Licence texts and the notices that stand for a licence.
MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and
associated documentation files (the "Software"), to deal in the Software without restriction, including
without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the
following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial
portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT
LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO
EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER
IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE
USE OR OTHER DEALINGS IN THE SOFTWARE."""
ISC_GRANT = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without
fee is hereby granted"""
ISC_CONDITION = """, provided that the above copyright notice and this permission notice appear in all copies."""
ISC_WARRANTY = """THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS
SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE
LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM
LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING
OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""
BSD_HEAD = """Redistribution and use in source and binary forms, with or without modification, are permitted
provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this list of conditions and the
following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the
following disclaimer in the documentation and/or other materials provided with the distribution."""
BSD_NAMES = """3. Neither the name of the copyright holder nor the names of its contributors may be used to
endorse or promote products derived from this software without specific prior written permission."""
BSD_WARRANTY = """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR
IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A
PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY
DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO,
PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER
CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR
OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH
DAMAGE."""
TEXTS = (
    ("MIT", MIT),
    ("MIT", "MIT License\n\n" + MIT),
    ("MIT", "The MIT License (MIT)\n\n" + MIT),
    ("ISC", ISC_GRANT + ISC_CONDITION + "\n\n" + ISC_WARRANTY),
    ("ISC", "ISC License\n\n" + ISC_GRANT + ISC_CONDITION + "\n\n" + ISC_WARRANTY),
    ("0BSD", ISC_GRANT + ".\n\n" + ISC_WARRANTY),
    ("BSD-2-Clause", BSD_HEAD + "\n\n" + BSD_WARRANTY),
    ("BSD-2-Clause", "BSD 2-Clause License\n\n" + BSD_HEAD + "\n\n" + BSD_WARRANTY),
    ("BSD-3-Clause", BSD_HEAD + "\n\n" + BSD_NAMES + "\n\n" + BSD_WARRANTY),
    ("BSD-3-Clause", "BSD 3-Clause License\n\n" + BSD_HEAD + "\n\n" + BSD_NAMES + "\n\n" + BSD_WARRANTY),
)
# Names under which notices speak of a licence, by identifier.
NAMES = {
    "MIT": ("the MIT License", "MIT"),
    "ISC": ("the ISC License", "ISC"),
    "0BSD": ("the BSD Zero Clause License", "0BSD"),
    "BSD-2-Clause": ("the BSD 2-Clause License", "BSD-2-Clause"),
    "BSD-3-Clause": ("the BSD 3-Clause License", "BSD-3-Clause"),
    "Apache-2.0": ("the Apache License, Version 2.0", "Apache-2.0", "the Apache License 2.0"),
    "GPL-2.0": ("the GNU General Public License, version 2", "GPL-2.0", "GPL-2.0-only", "GPL-2.0-or-later"),
    "GPL-3.0": ("the GNU General Public License, version 3", "GPL-3.0", "GPL-3.0-only", "GPL-3.0-or-later"),
    "LGPL-2.1": ("the GNU Lesser General Public License, version 2.1", "LGPL-2.1", "LGPL-2.1-only"),
    "LGPL-3.0": ("the GNU Lesser General Public License, version 3", "LGPL-3.0", "LGPL-3.0-only"),
    "AGPL-3.0": ("the GNU Affero General Public License, version 3", "AGPL-3.0", "AGPL-3.0-only"),
    "MPL-2.0": ("the Mozilla Public License, Version 2.0", "MPL-2.0"),
    "Unlicense": ("the Unlicense", "Unlicense"),
    "CC0-1.0": ("CC0 1.0", "CC0-1.0"),
    "CC-BY-4.0": ("CC BY 4.0", "CC-BY-4.0"),
    "CC-BY-SA-4.0": ("CC BY-SA 4.0", "CC-BY-SA-4.0"),
    "CC-BY-NC-4.0": ("CC BY-NC 4.0", "CC-BY-NC-4.0"),
    "CC-BY-ND-4.0": ("CC BY-ND 4.0", "CC-BY-ND-4.0"),
    "CC-BY-NC-SA-4.0": ("CC BY-NC-SA 4.0", "CC-BY-NC-SA-4.0"),
}
NOTICES = (
    "Licensed under {}", "Released under {}", "Distributed under {}", "Available under {}",
    "This work is licensed under {}", "This software is licensed under {}", "This file is licensed under {}",
    "This program is licensed under {}", "SPDX-License-Identifier: {}", "License: {}",
)

#: A line that only says who holds the rights; it is left out.
RIGHTS = r"^(copyright|c|all rights reserved)( |$)"
#: Anything but letters, digits and line feeds; runs of it become one space.
OTHER = r"[^\p{L}\p{N}\n]+"


def _known_rows() -> list[tuple[str, str]]:
    notices = [(i, notice.format(name)) for i, names in NAMES.items() for name in names for notice in NOTICES]
    return [*TEXTS, *notices]


def known_licenses(spark: SparkSession, path: str | None = None) -> DataFrame:
    """license_id, text: a fixed list of some 300 rows, five whole licences and the notices of NAMES, and the rows of
    the Parquet table at path(license_id, text), if one is given."""
    rows = small_table(spark, _known_rows(), "license_id string, text string")
    return rows.unionByName(spark.read.parquet(path).select("license_id", "text")) if path else rows


def canonical_lines(text: Column) -> Column:
    """Lines of the text in canonical form: lower case, one space for punctuation and blanks, one
    spelling, without empty lines and lines of rights."""
    flat = F.regexp_replace(F.lower(text), OTHER, " ")
    for other, usual in SPELLINGS:
        flat = F.replace(flat, F.lit(other), F.lit(usual))
    lines = F.transform(F.split(flat, "\n"), lambda line: F.trim(line))
    return F.filter(lines, lambda line: (line != "") & ~line.rlike(RIGHTS))


def _paragraphs(rows: DataFrame, *keys: str) -> DataFrame:
    """keys, lines, paragraphs: in canonical form, without empty ones."""
    lines = rows.select(*keys, F.split("body", r"\n[\x20\x09-\x0D]*\n").alias("paragraphs"))
    lines = lines.select(*keys, F.transform("paragraphs", canonical_lines).alias("paragraphs"))
    joined = F.filter(F.transform("paragraphs", lambda p: F.array_join(p, " ")), lambda p: p != "")
    return lines.select(*keys, F.flatten("paragraphs").alias("lines"), joined.alias("paragraphs"))


def _runs(firsts: list[str], lengths: list[int]) -> Column:
    """Runs of consecutive paragraphs, shorter than the text, that begin with one of the digests `firsts`."""
    paragraphs, n = F.col("paragraphs"), F.size("paragraphs")
    places = F.when(n > 1, F.sequence(F.lit(1), n)).otherwise(F.array().cast("array<int>"))
    starts = F.filter(places, lambda i: F.md5(F.element_at(paragraphs, i)).isin(firsts))
    sizes = F.array(*[F.lit(k) for k in lengths])
    return F.flatten(F.transform(starts, lambda i: F.transform(
        F.filter(sizes, lambda k: (k < n) & (i + k <= n + 1)),
        lambda k: _unit("run", F.array_join(F.slice(paragraphs, i, k), " "), i, k))))


def _unit(kind: str, of: Column, at: Column | None = None, size: Column | None = None) -> Column:
    place = lambda x: (F.lit(None) if x is None else x).cast("int")
    return F.struct(F.lit(kind).alias("unit"), of.alias("of"), place(at).alias("at"), place(size).alias("size"))


def units(rows: DataFrame, *keys: str, firsts: list[str] = (), lengths: list[int] = ()) -> DataFrame:
    """keys, unit, digest, at, size: of the whole text ('text'), of each paragraph and of each line, and of each run
    of as many paragraphs as one of lengths that begins with a paragraph of one of the digests firsts."""
    lines = _paragraphs(rows, *keys)
    whole = F.array(_unit("text", F.array_join("lines", " "), F.lit(1), F.size("paragraphs")))
    joined = F.transform("paragraphs", lambda p: _unit("paragraph", p))
    each = F.transform("lines", lambda x: _unit("line", x))
    runs = [_runs(firsts, lengths)] if firsts else []
    found = lines.select(*keys, F.explode(F.concat(whole, joined, each, *runs)).alias("u")).where(F.col("u.of") != "")
    return found.select(*keys, "u.unit", F.unhex(F.md5("u.of")).alias("digest"), "u.at", "u.size")


def licenses(docs: DataFrame, known: DataFrame) -> DataFrame:
    """Every licence of known(license_id, text) that a text of docs(doc_id, text) is or holds as a whole
    paragraph, line or run of paragraphs: doc_id, license_id, unit ('text', 'paragraph', 'line', 'run'), n (how often).
    A run has as many paragraphs as the known text, at least two, and is not the whole text; of runs of the same
    licence inside each other, or inside a text that is the licence, the longest counts. The first paragraphs of known, as digests, reach the driver.

    Both sides are normalised alike and meet by the digest of the entire unit. Null and empty texts, and
    null rows of known, match nothing; a licence known twice counts once; rows with the same doc_id add
    up; a null doc_id is kept as such. Other columns are ignored."""
    table = known.select("license_id", body().alias("body")).where("license_id IS NOT NULL")
    shapes = _paragraphs(table).where(F.size("paragraphs") > 1).select(
        F.md5(F.col("paragraphs")[0]).alias("first"), F.size("paragraphs").alias("length")).distinct().collect()
    firsts, lengths = sorted({r["first"] for r in shapes}), sorted({r["length"] for r in shapes})
    table = units(table, "license_id").where("unit = 'text'").select("license_id", "digest").distinct()
    rows = docs.select("doc_id", body().alias("body")).withColumn("text_hash", F.xxhash64("body"))
    rows = units(rows, "doc_id", "text_hash", firsts=firsts, lengths=lengths)
    found = rows.join(table, "digest").groupBy("doc_id", "text_hash", "license_id", "unit", "at", "size").agg(
        F.count(F.lit(1)).alias("n"))
    before = W.partitionBy("doc_id", "text_hash", "license_id", F.col("at").isNull()).orderBy("at", F.desc("size")).rowsBetween(W.unboundedPreceding, -1)
    found = found.withColumn("covered", F.max(F.col("at") + F.col("size")).over(before))
    found = found.where(F.col("covered").isNull() | (F.col("covered") < F.col("at") + F.col("size")))
    return found.groupBy("doc_id", "license_id", "unit").agg(F.sum("n").alias("n"))


def license_report(docs: DataFrame, known: DataFrame) -> DataFrame:
    """One row per row of docs: doc_id, n_matches, license_ids (sorted, comma-joined, empty if none),
    is_license (the whole text is a licence)."""
    found = licenses(docs, known).groupBy("doc_id").agg(
        F.sum("n").alias("n"), F.array_join(F.array_sort(F.collect_set("license_id")), ",").alias("ids"),
        F.max(F.col("unit") == "text").alias("whole"))
    found = found.select(F.col("doc_id").alias("found_id"), "n", "ids", "whole")
    rows = docs.select("doc_id").join(found, F.col("doc_id").eqNullSafe(F.col("found_id")), "left")
    return rows.select(
        "doc_id", F.coalesce("n", F.lit(0)).cast("long").alias("n_matches"),
        F.coalesce("ids", F.lit("")).alias("license_ids"), F.coalesce("whole", F.lit(False)).alias("is_license"))


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return license_report(docs, known_licenses(spark, spark.conf.get("spark.haulwatch.licenses", None)))


def oracle() -> str:
    quote = lambda text: "'" + text.replace("'", "''") + "'"
    rows = _known_rows()
    known = ", ".join(f"({quote(i)}, {quote(text)})" for i, text in rows)
    flat = f"regexp_replace(lower(p), {quote(OTHER)}, ' ', 'g')"
    for other, usual in SPELLINGS:
        flat = f"replace({flat}, {quote(other)}, {quote(usual)})"
    lines = (f"list_filter(list_transform(string_split({flat}, chr(10)), lambda x: trim(x, ' ')), "
             f"lambda x: x <> '' AND NOT regexp_matches(x, {quote(RIGHTS)}))")
    split = r"regexp_split_to_array(coalesce(t, ''), '\n[\x20\x09-\x0D]*\n')"
    units = f"SELECT k, r, list_transform({split}, lambda p: {lines}) AS ps FROM "
    joined = "list_filter(list_transform(ps, lambda p: array_to_string(p, ' ')), lambda p: p <> '')"
    return f"""
WITH known(k, t) AS (VALUES {known}),
known_parts AS (SELECT k, flatten(ps) AS ls, {joined} AS pj FROM ({units} (SELECT k, t, 0 AS r FROM known))),
known_units AS (SELECT DISTINCT k AS license_id, md5(array_to_string(ls, ' ')) AS digest FROM known_parts),
firsts AS (SELECT DISTINCT pj[1] AS p FROM known_parts WHERE len(pj) > 1),
lengths AS (SELECT DISTINCT len(pj) AS m FROM known_parts WHERE len(pj) > 1),
parts AS (SELECT k, r, flatten(ps) AS ls, {joined} AS pj
    FROM ({units} (SELECT doc_id AS k, text AS t, row_number() OVER () AS r FROM documents))),
starts AS (SELECT r, i FROM (SELECT r, unnest(pj) AS p, generate_subscripts(pj, 1) AS i FROM parts) JOIN firsts USING (p)),
units AS (
    SELECT k, r, 'text' AS unit, array_to_string(ls, ' ') AS u, 1 AS pos, len(pj) AS size FROM parts
    UNION ALL SELECT k, r, 'paragraph', unnest(pj), NULL, NULL FROM parts
    UNION ALL SELECT k, r, 'line', unnest(ls), NULL, NULL FROM parts
    UNION ALL SELECT k, r, 'run', array_to_string(pj[i:i + m - 1], ' '), i, m
        FROM parts JOIN starts USING (r), lengths WHERE m < len(pj) AND i + m <= len(pj) + 1),
hits AS (SELECT *, max(pos + size) OVER (PARTITION BY r, license_id, pos IS NULL ORDER BY pos, size DESC
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS covered
    FROM units JOIN known_units ON md5(u) = digest WHERE u <> ''),
found AS (SELECT k, count(*) AS n, string_agg(DISTINCT license_id, ',' ORDER BY license_id) AS ids,
    bool_or(unit = 'text') AS whole
    FROM hits WHERE covered IS NULL OR covered < pos + size GROUP BY k)
SELECT doc_id, coalesce(n, 0) AS n_matches, coalesce(ids, '') AS license_ids, coalesce(whole, false) AS is_license
FROM documents LEFT JOIN found ON doc_id IS NOT DISTINCT FROM k
"""


ORACLE = oracle()
