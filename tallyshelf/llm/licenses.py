"""Licence scan by canonical digests.

A text is brought to a canonical form, so that copies of a licence that differ in case, punctuation, white space,
copyright lines or equivalent spellings have the same one. The digest of the whole canonical text is looked up among the
digests of known licences by a hash join. What is looked up is every entire document, and every entire line of it, as
notices of one line stand among other text. Known texts of several lines, or of RUN_WORDS words and more, are also looked for
from every line on: where a line begins with the first words of such texts, the digests of as many words from there on as they
have are looked up. How the lines are broken makes no difference, nor what stands before or after.

The known licences are a table of the caller's, or `KNOWN` and the full texts in `license_texts`. They are broadcast if they are few, else shuffled. If they
are few, texts whose first word none of them can start with are left out before the costly steps: a canonical form
starts with the text's first word, with what that is spelled otherwise, or after copyright lines.

A run's words are read from a line on only as far as known texts begin alike (PREFIXES), so a text's cost is in proportion to its
length, however many of its lines begin like a licence.

Edge cases. Very long texts are read whole. Null and empty texts, and texts of nothing but punctuation or copyright lines, match nothing. Repeated rows
match each for itself by id: rows alike in id are counted together. A known licence given twice under one name counts
once; one text under two names gives both. An empty table gives no rows. Extra columns are left out.
"""

from __future__ import annotations

import pkgutil

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyshelf.llm.common import text_of

# Known licences as text. Public licence texts and notices, by their usual short names.
KNOWN: tuple[tuple[str, str], ...] = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC0-1.0", "Released under CC0 1.0."),
    ("MPL-2.0", "Licensed under the Mozilla Public License, Version 2.0."),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License."),
    ("0BSD", """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted.
THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""),
    ("ISC", """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.
THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""),
    ("MIT", """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:
The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""),
    ("Apache-2.0", """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at
http://www.apache.org/licenses/LICENSE-2.0
Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."""),
)

# Full texts that are shipped with the package, by their short names. The licences' files as they are published.
FULL: tuple[str, ...] = (
    "Apache-2.0", "Artistic-1.0-Perl", "BSD-2-Clause", "BSD-3-Clause", "BSL-1.0", "CC0-1.0", "GFDL-1.2", "GFDL-1.3", "GPL-1.0", "GPL-2.0",
    "GPL-3.0", "LGPL-2.0", "LGPL-2.1", "LGPL-3.0", "MPL-1.1", "MPL-2.0", "Unlicense",
)
# What follows this line of a full text is advice on its use, which copies may lack. Fixed value.
END_OF_TERMS = "END OF TERMS AND CONDITIONS"

# Spellings that count as equal, as whole words of the canonical form. Fixed values.
SPELLINGS: tuple[tuple[str, str], ...] = (
    ("licence", "license"), ("licences", "licenses"), ("licenced", "licensed"), ("acknowledgement", "acknowledgment"),
    ("analogue", "analog"), ("authorisation", "authorization"), ("authorised", "authorized"), ("behaviour", "behavior"),
    ("favour", "favor"), ("fulfil", "fulfill"), ("labelled", "labeled"),
    ("modelling", "modeling"), ("non infringement", "noninfringement"), ("non commercial", "noncommercial"),
    ("organisation", "organization"), ("organisations", "organizations"), ("programme", "program"),
    ("recognised", "recognized"), ("sub license", "sublicense"), ("https", "http"), ("v2 0", "version 2 0"), ("v3", "version 3"),
    ("copyright owner", "copyright holder"), ("per cent", "percent"), ("whilst", "while"),
)
# A line that names a copyright: the sign, (c) or the word first, then anything. Fixed value.
COPYRIGHT_LINE = r"(?imd)^[ \t*#/;-]*(copyright[ \t]+(\(c\)|©|[0-9]{4})|©|\(c\)[ \t]+[0-9]{4})[^\n]*$"
NO_WORD, HAS_WORD = r"[^\p{L}\p{Nd}]+", r"[\p{L}\p{Nd}]+"
# The first word of a copyright line, unless the sign © is.
COPYRIGHT = "copyright"
# Documented parameter: known texts up to this many are broadcast.
BROADCAST_TEXTS = 100_000
# Documented parameters: words from which a known text of one line is looked for in runs too, and words that find a run.
RUN_WORDS, ANCHOR_WORDS = 20, 4
# Documented parameter: words from a line on that are compared with known texts' first words before more are read.
PREFIXES = (16, 64, 256, 1024, 4096)
# Words of text that one word of the canonical form may stand for: no merged spelling is part of another.
WIDEST = max(len(spelled.split()) for spelled, _ in SPELLINGS)
# Parts that one text's copies are dealt over where places are joined to texts.
SALTS = 32


def canonical(text: Column) -> Column:
    """Lower-case words with one space between; no copyright lines, no punctuation, one spelling."""
    # Two spaces between words, so that neighbours that are both spelled otherwise have a space each.
    return _one_spelling(F.trim(F.regexp_replace(_lowered(text), NO_WORD, "  ")))


def _lowered(text: Column) -> Column:
    return F.lower(F.regexp_replace(text, COPYRIGHT_LINE, ""))


def _one_spelling(words: Column) -> Column:
    """The canonical form of lower-case words with two spaces between."""
    form = F.concat(F.lit(" "), words, F.lit(" "))
    for spelled, same in SPELLINGS:
        form = F.replace(form, F.lit(f" {spelled} ".replace(" ", "  ")[1:-1]), F.lit(f" {same} ".replace(" ", "  ")[1:-1]))
    return F.trim(F.replace(form, F.lit("  "), F.lit(" ")))


def digest(form: Column) -> Column:
    """Digest of a canonical form. Never null: a test for null would go below the joins, and cost the form for all."""
    return F.coalesce(F.sha2(form, 256), F.lit(""))


def known_digests(known: DataFrame, name: str = "license_id", text: str = "text") -> DataFrame:
    form = canonical(text_of(text))
    lines = F.size(F.filter(F.split(text_of(text), "\n"), lambda line: canonical(line) != ""))
    rows = known.select(F.col(f"`{name}`").alias("license_id"), form.alias("form"), lines.alias("lines")).where("form <> ''")
    form = F.col("form")
    words = F.size(F.split(form, " "))
    return rows.select(
        "license_id", digest(form).alias("digest"), F.substring_index(form, " ", 1).alias("first"), words.alias("n_words"),
        F.xxhash64(F.substring_index(form, " ", ANCHOR_WORDS)).alias("anchor"),
        F.filter(
            F.array(*[F.struct(F.lit(n).alias("n"), F.xxhash64(F.substring_index(form, " ", n)).alias("hash")) for n in PREFIXES]), lambda p: p["n"] < words
        ).alias("prefixes"),
        ((F.col("lines") > 1) | (words >= RUN_WORDS)).alias("in_runs"),
    ).distinct()


def first_word(text: Column) -> Column:
    """The first word in lower case, found without reading on; lower case may split it."""
    first = F.regexp_extract(text, HAS_WORD, 0)
    return F.regexp_extract(F.lower(first), HAS_WORD, 0)


def _spelled_firsts(spark: SparkSession) -> DataFrame:
    """First words that the canonical form may replace or take away with their line."""
    words = {spelled.split()[0] for spelled, _ in SPELLINGS} | {COPYRIGHT, "c"}
    return spark.createDataFrame([(w,) for w in sorted(words)], "first string")


def full_texts() -> list[tuple[str, str]]:
    """The shipped texts, those with advice on their use also without."""
    texts = [(name, pkgutil.get_data(__package__, f"license_texts/{name}.txt").decode()) for name in FULL]
    cut = [(name, text[: text.index(END_OF_TERMS)]) for name, text in texts if END_OF_TERMS in text]
    return texts + [(name, body + more) for name, body in cut for more in ("", END_OF_TERMS)]


def known_table(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([*KNOWN, *full_texts()], "license_id string, text string")


def tokens_of(text: Column) -> Column:
    """The text's words in lower case, and a line end before the first word of each line that has one.

    Copyright lines are left out. No two line ends are neighbours.
    """
    spaced = F.regexp_replace(F.concat(F.lit("\n"), _lowered(text)), r"[^\p{L}\p{Nd}\n]+", " ")
    return F.split(F.trim(F.regexp_replace(spaced, r" ?(?:\n ?)+", " \n ")), " ")


def _words_from(tokens: Column, place: Column, n: Column | int) -> Column:
    """The first n words of the canonical form of what begins at a line end, from a number of tokens that n bounds."""
    n = F.lit(n) if isinstance(n, int) else n
    some = F.slice(tokens, place + 1, (n + 1) * (2 * WIDEST))
    form = _one_spelling(F.array_join(F.filter(some, lambda t: t != "\n"), "  "))
    return F.call_function("substring_index", form, F.lit(" "), n)


def _anchors_of(tokens: Column, place: Column, sizes: list[int]) -> Column:
    head = _words_from(tokens, place, max(sizes, default=1))
    return F.array_distinct(F.array(*[F.xxhash64(F.substring_index(head, " ", n)) for n in sizes]))


def _line_ends(tokens: Column) -> Column:
    return F.filter(F.sequence(F.lit(0), F.size(tokens) - 1), lambda i: F.get(tokens, i) == "\n")


def _places_of_many(rows: DataFrame, known: DataFrame, sizes: list[int]) -> DataFrame:
    """doc_id, row, tokens, at: the places where a known start is, and the words of the longest known text with it, by shuffled joins.

    Texts without one go. Places belong to a text, not to its copies, and are joined to each copy by the text's digest.
    """
    rows = rows.withColumn("tokens", tokens_of(F.col("body"))).withColumn("of", F.sha2("body", 256))
    starts = F.transform(_line_ends(F.col("tokens")), lambda i: F.struct(i.alias("place"), _anchors_of(F.col("tokens"), i, sizes).alias("anchors")))
    starts = rows.select("of", F.explode(starts).alias("s")).select("of", "s.place", F.explode("s.anchors").alias("anchor"))
    starts = starts.join(known.groupBy("anchor").agg(F.max("run_words").alias("reach")), "anchor")
    starts = starts.groupBy("of", "place").agg(F.max("reach").alias("reach"))
    at = starts.groupBy("of").agg(F.collect_list(F.struct("place", "reach")).alias("at")).withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    salt = F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).cast("int")
    return rows.withColumn("salt", salt).join(at, ["of", "salt"]).select("doc_id", "row", "tokens", "at")


def _places_of_few(rows: DataFrame, known: DataFrame, sizes: list[int]) -> DataFrame:
    """doc_id, row, tokens, at: the places where a known start may be, and the words worth reading from there, told by literals.

    Most texts without one go. Words are read four times as far as long as a known text begins with all that was read.
    """
    firsts = sorted({r[0] for r in known.select("first").union(_spelled_firsts(rows.sparkSession)).distinct().collect()})
    anchors = sorted(r[0] for r in known.select("anchor").distinct().collect())
    begun = known.select(F.explode("prefixes").alias("p")).groupBy("p.n").agg(F.collect_set("p.hash").alias("hashes")).orderBy("n").collect()
    longest = known.agg(F.max("run_words")).first()[0] or 1
    # First words are cheap and leave few texts, the only ones whose words are listed.
    rows = rows.where(F.exists(F.split("body", "\n"), lambda line: first_word(line).isin(firsts)))
    rows = rows.withColumn("tokens", tokens_of(F.col("body")))
    tokens = F.col("tokens")

    def reach(i: Column) -> Column:
        words = F.lit(longest)
        for n, hashes in reversed(begun):
            words = F.when(F.xxhash64(_words_from(tokens, i, n)).isin(sorted(hashes)), words).otherwise(F.lit(n))
        return words

    starts = F.filter(_line_ends(tokens), lambda i: F.get(tokens, i + 1).isin(firsts))
    at = F.filter(starts, lambda i: F.exists(_anchors_of(tokens, i, sizes), lambda a: a.isin(anchors)))
    return rows.select("doc_id", "row", "tokens", F.transform(at, lambda i: F.struct(i.alias("place"), reach(i).alias("reach"))).alias("at"))


def _runs(docs: DataFrame, digests: DataFrame, few: bool, doc_id: str, text: str) -> DataFrame:
    """One row per document, place and licence found from the start of a line on: doc_id, unit 'lines', license_id, row, place."""
    known = digests.where("in_runs").select("license_id", "digest", "anchor", "first", "prefixes", F.col("n_words").alias("run_words")).distinct()
    sizes = sorted(r[0] for r in known.select(F.least("run_words", F.lit(ANCHOR_WORDS))).distinct().collect())
    rows = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), text_of(text).alias("body")).withColumn("row", F.monotonically_increasing_id())
    rows = (_places_of_few if few else _places_of_many)(rows, known, sizes)
    tokens = F.col("tokens")
    starts = F.transform("at", lambda s: F.struct(s["place"].alias("place"), _anchors_of(tokens, s["place"], sizes).alias("anchors"), _words_from(tokens, s["place"], s["reach"]).alias("form")))
    rows = rows.select("doc_id", "row", F.explode(starts).alias("s"))
    rows = rows.select("doc_id", "row", "s.place", "s.form", F.explode("s.anchors").alias("anchor"))
    known = known.drop("first", "prefixes")
    rows = rows.join(F.broadcast(known) if few else known, "anchor")
    run = F.expr("substring_index(form, ' ', run_words)")
    return rows.where(digest(run) == F.col("digest")).select("doc_id", F.lit("lines").alias("unit"), "license_id", "row", "place").distinct()


def scan_licenses(docs: DataFrame, known: DataFrame | None = None, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document, unit ('text', 'line' or 'lines') and licence found: n_found counts the units that match.

    A unit 'lines' is a run of lines, counted by the line where it begins.
    """
    digests = known_digests(known if known is not None else known_table(docs.sparkSession))
    few = digests.count() <= BROADCAST_TEXTS
    runs = _runs(docs, digests, few, doc_id, text).select("doc_id", "unit", "license_id")
    digests = digests.select("license_id", "digest", "first").distinct()
    body = text_of(text)
    units = F.concat(
        F.array(F.struct(F.lit("text").alias("unit"), body.alias("body"))),
        F.transform(F.split(body, "\n"), lambda line: F.struct(F.lit("line").alias("unit"), line.alias("body"))),
    )
    rows = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.explode(units).alias("u")).select("doc_id", "u.unit", "u.body")
    if few:
        digests = F.broadcast(digests)
        firsts = digests.select("first").union(_spelled_firsts(docs.sparkSession)).distinct()
        marked = F.contains("body", F.lit("©"))
        first = F.when(marked, F.lit(COPYRIGHT)).otherwise(first_word(F.col("body")))
        rows = rows.withColumn("first", F.coalesce(first, F.lit("")))
        rows = rows.join(F.broadcast(firsts), "first", "left_semi")
    rows = rows.select("doc_id", "unit", digest(canonical(F.col("body"))).alias("digest"))
    found = rows.join(digests, "digest").select("doc_id", "unit", "license_id").union(runs)
    return found.groupBy("doc_id", "unit", "license_id").agg(F.count(F.lit(1)).alias("n_found"))
