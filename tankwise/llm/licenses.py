"""Known licence texts, found by the digest of a canonical form.

The canonical form has no case, punctuation, copyright lines or spacing, and one spelling where English
has two. The digest of a whole canonical text is joined to the digests of known texts. Besides whole
documents, each line of a document is looked up as a text of its own, since notices are often one line."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tankwise.llm.common import picked
from tankwise.llm.license_texts import whole_texts

#: Known digests up to this number are sent to every task; more are joined by a shuffle.
SMALL = 20_000

# The shortest whole texts, and notices; longer texts are stored beside this module.
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
IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR
THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
ISC = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee
is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.
THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE
INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR
ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF
USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF
OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""
KNOWN = [
    ("MIT", MIT),
    ("MIT", "MIT License\n" + MIT),
    ("MIT", "The MIT License (MIT)\n" + MIT),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("ISC", ISC),
    ("ISC", "ISC License\n" + ISC),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC0-1.0", "Released under CC0 1.0."),
    *whole_texts(),
]
#: Spellings that count as the same, in the order in which they are replaced. They apply
#: inside words too; a canonical text is for comparing only.
SPELLINGS = [
    ("licenc", "licens"),
    ("isation", "ization"),
    ("ising", "izing"),
    ("ise", "ize"),
    ("yse", "yze"),
    ("our", "or"),
    ("dgement", "dgment"),
    ("ll", "l"),
    ("whilst", "while"),
    ("per cent", "percent"),
    ("non infringement", "noninfringement"),
    ("sub license", "sublicense"),
    ("copyright owner", "copyright holder"),
]
#: Fixed value: a line that is only about who holds the rights.
COPYRIGHT_LINE = r"(?m)^[ \t#*/;-]*(copyright[ \t]|\(c\)|©|all rights reserved)[^\n]*$"


def canonical_lines(text: Column) -> Column:
    """Lower case, no copyright lines, other than letters and digits as one space, one spelling. Lines
    stay apart. A null text is empty."""
    plain = F.lower(F.coalesce(text, F.lit("")))
    plain = F.regexp_replace(F.replace(plain, F.lit("\r"), F.lit("\n")), COPYRIGHT_LINE, "")
    plain = F.regexp_replace(plain, r"[^\p{L}\p{N}\n]+", " ")
    for spelling, same in SPELLINGS:
        plain = F.replace(plain, F.lit(spelling), F.lit(same))
    return plain


def canonical(text: Column) -> Column:
    """The canonical form of a whole text, on one line."""
    return F.trim(F.regexp_replace(canonical_lines(text), r"[ \n]+", " "))


def known_texts(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(KNOWN, "license string, text string")


def known_digests(known: DataFrame) -> tuple[DataFrame, bool]:
    """``license, digest, length`` of known texts, and whether they are few. A canonical text that two
    licences share stands for the first by name; an empty one stands for none."""
    form = known.select("license", canonical(F.col("text")).alias("form")).filter("form <> ''")
    digests = form.groupBy(F.sha2("form", 256).alias("digest"), F.length("form").alias("length")).agg(
        F.min("license").alias("license")
    )
    return digests, digests.limit(SMALL + 1).count() <= SMALL


def scan(docs: DataFrame, known: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row: ``doc_id``, ``canonical_sha256`` of the whole text, ``license`` whose text it is
    (null if none), and ``notices``: licences with a known text that is one whole line, sorted.

    Null and empty texts have the digest of an empty form and no licence. Rows that share an id and a text
    have the same notices; rows given twice give two rows. An empty table gives none, and with no known
    texts nothing is found. Further columns play no part."""
    digests, few = known_digests(known)
    lookup = F.broadcast(digests) if few else digests
    rows = picked(docs, doc_id=id, text=text).select("doc_id", canonical_lines(F.col("text")).alias("lines"))
    whole = rows.select(
        "doc_id", F.sha2(F.trim(F.regexp_replace("lines", r"[ \n]+", " ")), 256).alias("canonical_sha256"), "lines"
    )
    line = F.explode(F.split("lines", "\n")).alias("line")
    short = whole.select("doc_id", "canonical_sha256", line).select("doc_id", "canonical_sha256", F.trim("line").alias("line"))
    # Lines are looked up only if some known text has their length.
    asked = short.filter(F.col("line") != "").join(
        F.broadcast(digests.select("length").distinct()), F.length("line") == F.col("length"), "left_semi"
    )
    hits = (
        asked.withColumn("digest", F.sha2("line", 256))
        .join(lookup.select("digest", "license"), "digest")
        .select("doc_id", "canonical_sha256", "license")
        .distinct()
        .groupBy(F.col("doc_id").alias("_id"), F.col("canonical_sha256").alias("_form"))
        .agg(F.concat_ws(",", F.array_sort(F.collect_set("license"))).alias("notices"))
    )
    named = whole.select("doc_id", "canonical_sha256").join(
        lookup.select(F.col("digest").alias("canonical_sha256"), "license"), "canonical_sha256", "left"
    )
    return named.join(
        hits,
        F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("canonical_sha256") == F.col("_form")),
        "left",
    ).select("doc_id", "canonical_sha256", "license", F.coalesce("notices", F.lit("")).alias("notices"))
