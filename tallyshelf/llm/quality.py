"""Quality rules as a short-circuit cascade.

Every document gets the base counts. Documents that pass the base rules run through further rules, which stop at the
first that rejects. The rules' order is estimated on a sample: each rule's cost in seconds and its share of rejections
there give rejections per cost, and the rule with the most goes first. The order changes the time, never the verdict.

Edge cases. A null or empty text has no words and fails the base rules. Repeated rows are judged each for itself. An
empty table gives no rows and runs the rules as listed. Extra columns are left out by `judge`, and kept by
`filter_documents`. Long texts are judged whole: the work per text is linear, but for a sort of the windows of those that
repeat any.
"""

from __future__ import annotations

import time
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyshelf.llm.common import SPACES, WORD, text_of
from tallyshelf.scratch import Scratch

# Fixed values of the base rules.
WINDOW, LEAST_WORDS, MOST_REPEATED = 8, 20, 30
# Documented parameter: rows of the sample that the order is estimated on.
SAMPLE_ROWS = 1000


@dataclass(frozen=True)
class Rule:
    """`rejects` is a condition over the base counts, `text` and `words`."""

    name: str
    rejects: Column


def rules() -> tuple[Rule, ...]:
    """Further rules. Counts are compared as whole numbers."""
    text = F.col("text")
    return (
        Rule("word length", (F.col("word_chars") < 2 * F.col("n_words")) | (F.col("word_chars") > 15 * F.col("n_words"))),
        Rule("symbols", 10 * F.col("n_symbols") > F.col("n_words")),
        Rule("repeated lines", 100 * F.col("n_dup_lines") > 50 * F.col("n_lines")),
        Rule("letters", 100 * F.regexp_count(text, F.lit(r"\p{L}")) < 60 * F.col("word_chars")),
        Rule("capitals", 2 * F.regexp_count(text, F.lit(r"\p{Lu}")) > F.col("word_chars")),
        Rule("digits", 100 * F.regexp_count(text, F.lit(r"\p{Nd}")) > 20 * F.col("word_chars")),
        Rule("ellipses", 100 * F.regexp_count(text, F.lit(r"(?m)(\.\.\.|…)$")) > 30 * F.col("n_lines")),
        Rule("doubled words", 100 * doubled_words(F.col("words")) > 30 * F.col("n_words")),
        Rule("bullets", 100 * F.regexp_count(text, F.lit(r"(?m)^[ \t]*[-*•]")) > 90 * F.col("n_lines")),
    )


def _let(value: Column, body) -> Column:
    """`body` of the value, which is computed once, however often the body names it."""
    return F.transform(F.array(value), body)[0]


def _joined(hashes: Column, apart: int) -> Column:
    """Hash of each element with the one that many places on."""
    n = F.greatest(F.size(hashes) - apart, F.lit(0))
    return F.zip_with(F.slice(hashes, 1, n), F.slice(hashes, 1 + apart, n), lambda a, b: F.xxhash64(a, b))


def _covered(starts: Column) -> Column:
    """Positions that windows at these ascending starts cover."""
    steps = F.zip_with(
        F.slice(starts, 1, F.size(starts) - 1), F.slice(starts, 2, F.size(starts) - 1),
        lambda a, b: F.least(b - a, F.lit(WINDOW)),
    )
    return F.aggregate(steps, F.lit(WINDOW), lambda total, step: total + step)


def _repeated_starts(windows: Column) -> Column:
    """Starts of the windows that occur more than once, ascending."""
    def starts(ordered: Column) -> Column:
        twice = F.filter(ordered, lambda x, i: F.coalesce(
            (F.get(ordered, i - 1)["h"] == x["h"]), F.lit(False)) | F.coalesce((F.get(ordered, i + 1)["h"] == x["h"]), F.lit(False)))
        return F.sort_array(F.transform(twice, lambda x: x["i"]))

    ordered = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    return _let(ordered, starts)


def repeat_words(words: Column) -> Column:
    """Words in windows of eight that are found twice or more in the text, the first included."""
    single = F.transform(words, lambda w: F.xxhash64(w))
    eight = _let(single, lambda a: _let(_joined(a, 1), lambda b: _let(_joined(b, 2), lambda c: _joined(c, 4))))

    def covered(windows: Column) -> Column:
        any_twice = F.size(F.array_distinct(windows)) < F.size(windows)
        return F.when(any_twice, _let(_repeated_starts(windows), _covered)).otherwise(F.lit(0))

    return F.when(F.size(words) > WINDOW, _let(eight, covered)).otherwise(F.lit(0))


def doubled_words(words: Column) -> Column:
    """Words that equal the word before them."""
    n = F.greatest(F.size(words) - 1, F.lit(0))
    return F.size(F.filter(F.zip_with(F.slice(words, 1, n), F.slice(words, 2, n), lambda a, b: a == b), lambda same: same))


def base_counts(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, text, words, and the counts: n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words, base_failed."""
    rows = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), text_of(text).alias("text"))
    rows = rows.select("*", F.array_remove(F.split("text", SPACES), "").alias("words"))
    rows = rows.select("*", F.filter(F.split("text", "\n"), lambda line: line.rlike(WORD)).alias("lines"))
    rows = rows.select(
        "doc_id", "text", "words", F.size("words").cast("bigint").alias("n_words"),
        F.length(F.array_join("words", "")).cast("bigint").alias("word_chars"),
        F.regexp_count("text", F.lit(r"[#*$%&|<>]")).cast("bigint").alias("n_symbols"),
        F.size("lines").cast("bigint").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("bigint").alias("n_dup_lines"),
        repeat_words(F.col("words")).cast("bigint").alias("n_repeat_words"),
    )
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    return rows.withColumn("base_failed", failed)


def _seconds(df: DataFrame) -> float:
    """The lesser of two runs."""
    took = []
    for _ in range(2):
        started = time.perf_counter()
        df.write.format("noop").mode("overwrite").save()
        took.append(time.perf_counter() - started)
    return min(took)


def order_rules(counts: DataFrame, cascade: Sequence[Rule]) -> list[Rule]:
    """The rules by rejections per second on `counts`, a small written sample. The costs are measured one by one."""
    flags = [F.sum(r.rejects.cast("bigint")).alias(f"r{i}") for i, r in enumerate(cascade)]
    rejected = counts.agg(*flags).first()
    idle = _seconds(counts.select("text", "words"))
    costs = [max(_seconds(counts.select("text", "words", r.rejects.alias("r"))) - idle, 1e-4) for r in cascade]
    rate = [(rejected[i] or 0) / costs[i] for i in range(len(cascade))]
    return [cascade[i] for i in sorted(range(len(cascade)), key=lambda i: -rate[i])]


def cascade_verdict(ordered: Sequence[Rule]) -> Column:
    """Name of the first rule that rejects, null if none does. A CASE looks no further than its first true branch."""
    verdict = F.when(F.col("base_failed"), F.lit("base"))
    for rule in ordered:
        verdict = verdict.when(rule.rejects, F.lit(rule.name))
    return verdict


def judge(
    docs: DataFrame, cascade: Sequence[Rule] | None = None, doc_id: str = "doc_id", text: str = "text", sample_rows: int = SAMPLE_ROWS,
) -> DataFrame:
    """Base counts of every document, the rule that rejects it, the text's hash, and kept."""
    cascade = list(rules() if cascade is None else cascade)
    scratch = Scratch(docs.sparkSession)
    share = min(1.0, 2.0 * sample_rows / max(1, docs.count()))
    some = docs.select(F.col(f"`{doc_id}`"), F.col(f"`{text}`")).sample(share, seed=1).limit(sample_rows)
    sample = scratch.table(base_counts(some, doc_id, text).where(~F.col("base_failed")), "sample")
    rows = base_counts(docs, doc_id, text)
    rows = rows.withColumn("rejected_by", cascade_verdict(order_rules(sample, cascade)))
    rows = rows.select("*", F.xxhash64("text").alias("text_hash"), F.col("rejected_by").isNull().alias("kept"))
    return rows.drop("text", "words")


def filter_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The documents that no rule rejects, all their columns; rows of one id stay or go by the text's hash."""
    kept = judge(docs, doc_id=doc_id, text=text, **options).where("kept").select("doc_id", "text_hash").distinct()
    rows = docs.select(
        F.col(f"`{doc_id}`").alias("id"), F.xxhash64(text_of(text)).alias("hash"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    return rows.join(kept, F.col("id").eqNullSafe(F.col("doc_id")) & (F.col("hash") == F.col("text_hash")), "left_semi").select("row.*")
