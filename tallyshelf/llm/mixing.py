"""Mixes sources to target sizes by Pareto order sampling.

Each document of a source gets the whole part of target over size as certain copies. What is open then is a sample without
replacement in which long documents, whose words hang together over more context, are likelier: the inclusion probability p
grows with the number of binary digits of a document's size (its class), p = min(1, level * digits), at the level where the
expected words are those still open. Where p is 1 a copy more is certain. The others are ranked by
q = (u / (1 - u)) / (p / (1 - p)) with u uniform, and the first ones, up to the size still open, are taken.

The open size is counted in words, so the cut falls where taking one more document would miss the target by more than
leaving it: a source misses its target by at most half of the document at its cut.

The cut is found without sorting a source. Ranks map to (0, 1) and are counted in a fixed number of bins, whose sums
are combined in the map tasks; only the bin that holds the cut is ranked document by document.

u is a hash of id, size and text, so reruns agree. Rows alike in all three are interchangeable and have one rank. Where the cut
falls among them, as many of them as are due are taken, in order of their place in a written table: whole parts of it
from counts of each part, so that only the rows of one part are ever sorted.

Edge cases. A null text has size 0 and is drawn as the empty text is. A null source is a source of its own, the last one. A
source of size 0 has target 0 and p 0. A null id is an id like any other. A very long text is one document, of the class
of its size. An empty table gives no rows. Columns of the input other than id, text and source are not read here;
`mixed_copies` keeps them all, of whatever name.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyshelf.llm.common import word_count
from tallyshelf.scratch import Scratch

# Documented parameter: bins of ranks per source, coarse and fine.
BINS = (1 << 8, 1 << 16)
# Fixed value: hexadecimal digits of a digest that make the 52 bits of a uniform number.
DIGITS = 13
# Fixed value: low bits of a row's place, which count within a part of the table.
PLACE_BITS = 33


def uniform(*parts: Column) -> Column:
    """A number in (0, 1) that depends on the parts alone."""
    text = F.concat_ws(":", *[F.coalesce(p.cast("string"), F.lit("null")) for p in parts])
    whole = F.conv(F.substring(F.md5(text), 1, DIGITS), 16, 10).cast("double")
    return (whole + 0.5) / F.lit(float(16**DIGITS))


def source_targets(sizes: DataFrame, weights: Sequence[float], share: float, most: float) -> DataFrame:
    """Adds `target` to one row per source with `source` and `source_size`.

    Sources in order of code points, null last, weigh as `weights`, repeating. The level at which all sources, capped
    at `most` times their size, reach the total is the largest of the levels after capping the sources one by one.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights))) + 1)
    caps = sizes.select("*", weight.alias("weight"), (F.col("source_size") * F.lit(float(most))).alias("cap"))
    before = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    total = F.sum("source_size").over(everything) * F.lit(float(share))
    open_size = total - F.coalesce(F.sum("cap").over(before), F.lit(0.0))
    open_weight = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    levels = caps.select("source", "source_size", "weight", "cap", (open_size / open_weight).alias("level"))
    level = F.max("level").over(everything)
    return levels.select("source", "source_size", F.least(F.col("cap"), level * F.col("weight")).alias("target"))


def source_classes(sizes: DataFrame, targets: DataFrame) -> DataFrame:
    """One row per source and class with `whole` copies, `p`, and the source's `open` size after all certain copies.

    The level is found as that of the sources' targets: the largest after giving the classes p = 1 one by one, long ones first.
    """
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    same = F.col("source").eqNullSafe(F.col("its_source"))
    rows = sizes.withColumnRenamed("source", "its_source").join(targets, same).drop("its_source").withColumn("base", F.floor(ratio))
    rows = rows.withColumn("to_draw", F.col("target") - F.col("base") * F.col("source_size"))
    its = Window.partitionBy("source")
    before = its.orderBy(F.desc("digits")).rowsBetween(Window.unboundedPreceding, -1)
    measure = F.col("words") * F.col("digits")
    rest = F.sum(measure).over(its) - F.coalesce(F.sum(measure).over(before), F.lit(0))
    left = F.col("to_draw") - F.coalesce(F.sum("words").over(before), F.lit(0))
    rows = rows.withColumn("level", F.when(rest > 0, left / rest))
    rows = rows.withColumn("raw", F.coalesce(F.max("level").over(its), F.lit(0.0)) * F.col("digits"))
    sure = F.col("raw") >= 1
    return rows.select(
        "source", "digits", "source_size", "target",
        (F.col("base") + sure.cast("bigint")).alias("whole"), F.when(sure, F.lit(0.0)).otherwise(F.col("raw")).alias("p"),
        (F.col("to_draw") - F.sum(F.when(sure, F.col("words")).otherwise(F.lit(0))).over(its)).alias("open"))


def _drawn(narrow: DataFrame, classes: DataFrame) -> DataFrame:
    """Documents with `whole` copies, the open size of their source, and `rank` in (0, 1), null if p is 0."""
    q = (F.col("u") / (1 - F.col("u"))) / (F.col("p") / (1 - F.col("p")))
    per_class = classes.withColumnRenamed("source", "its_source").withColumnRenamed("digits", "its_digits")
    same = F.col("source").eqNullSafe(F.col("its_source")) & (F.col("digits") == F.col("its_digits"))
    rows = narrow.join(per_class, same).drop("its_source", "its_digits")
    return rows.withColumn("rank", F.when(F.col("p") > 0, q / (1 + q)))


def _cuts(drawn: DataFrame, scratch: Scratch) -> DataFrame:
    """One row per source that takes any: `cut`, the largest rank that is taken, and `due`, how many rows of that rank are.

    Ranks are counted in bins, and the bin that holds the cut in finer bins again, so a source's window has a fixed number of
    rows at each level, and only the documents of one of the finest bins at the end. `due` is null where all rows of the rank are.
    """
    same = F.col("source").eqNullSafe(F.col("cut_source"))
    so_far = Window.partitionBy("source")
    ranked = drawn.where(F.col("rank").isNotNull()).select("source", "open", "rank", "size", F.lit(0).cast("bigint").alias("before"))
    taken = []
    for bins in BINS:
        ranked = ranked.withColumn("bin", F.least(F.floor(F.col("rank") * bins), F.lit(bins - 1)))
        sums = ranked.groupBy("source", "open", "before", "bin").agg(F.sum("size").alias("words"), F.max("rank").alias("last"))
        sums = scratch.table(sums.withColumn("through", F.col("before") + F.sum("words").over(so_far.orderBy("bin"))), "bins")
        taken.append(sums.where("through <= open").groupBy("source").agg(F.max("last").alias("cut")).withColumn("due", F.lit(None).cast("bigint")))
        at_cut = sums.where("through > open AND through - words <= open")
        at_cut = scratch.table(at_cut.select(F.col("source").alias("cut_source"), F.col("bin").alias("cut_bin"), (F.col("through") - F.col("words")).alias("start")), "at_cut")
        ranked = ranked.join(at_cut, same & (F.col("bin") == F.col("cut_bin"))).select("source", "open", "rank", "size", F.col("start").alias("before"))
    # Rows of one rank have one size.
    units = ranked.groupBy("source", "open", "before", "rank").agg(F.max("size").alias("size"), F.count(F.lit(1)).alias("n"))
    earlier = so_far.orderBy("rank").rowsBetween(Window.unboundedPreceding, -1)
    through = F.col("before") + F.coalesce(F.sum(F.col("size") * F.col("n")).over(earlier), F.lit(0))
    room = 2 * (F.col("open") - F.col("through")) - F.col("size")
    fit = F.when(F.col("size") > 0, F.floor(room / (2 * F.col("size"))) + 1).when(room >= 0, F.col("n")).otherwise(F.lit(0))
    near = units.withColumn("through", through).withColumn("fit", fit).where("fit > 0")
    last = F.max(F.struct("rank", F.when(F.col("fit") < F.col("n"), F.col("fit")).alias("due")))
    taken.append(near.groupBy("source").agg(last.alias("last")).select("source", F.col("last.rank").alias("cut"), F.col("last.due").alias("due")))
    rows = reduce(DataFrame.union, taken).groupBy("source").agg(F.max(F.struct("cut", "due")).alias("last"))
    return rows.select("source", "last.cut", "last.due")


def _measured(docs: DataFrame, doc_id: str, text: str, source: str, seed: int, *more: Column) -> DataFrame:
    body = F.col(f"`{text}`")
    rows = docs.select(
        F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{source}`").alias("source"), word_count(body).alias("size"),
        F.md5(F.coalesce(body, F.lit(""))).alias("digest"), *more)
    rows = rows.withColumn("digits", F.length(F.bin("size")))
    return rows.withColumn("u", uniform(F.lit(seed), F.col("doc_id"), F.col("size"), F.col("digest"))).drop("digest")


class _Plan:
    """Classes and cuts of a mix: two written tables with few rows per source, so that joins to them move no document."""

    def __init__(self, narrow: DataFrame, weights: Sequence[float], share: float, most: float, scratch: Scratch):
        self.scratch = scratch
        sizes = scratch.table(narrow.groupBy("source", "digits").agg(F.sum("size").alias("words")), "sums")
        by_source = sizes.groupBy("source").agg(F.sum("words").alias("source_size"))
        targets = scratch.table(source_targets(by_source, weights, share, most), "targets")
        self.classes = scratch.table(source_classes(sizes, targets), "classes")
        self.cuts = scratch.table(_cuts(_drawn(narrow, self.classes), scratch), "cuts").withColumnRenamed("source", "cut_source")
        self.splits = not self.cuts.where("due IS NOT NULL").isEmpty()

    def _last_places(self, rows: DataFrame) -> DataFrame:
        """Per source whose cut falls among equal rows: the last place that is taken. `rows` is a written table with places."""
        tied = rows.where("rank = cut AND due IS NOT NULL").select("source", "due", "place", F.shiftright("place", PLACE_BITS).alias("part"))
        tied = self.scratch.table(tied, "tied")
        parts = tied.groupBy("source", "due", "part").agg(F.count(F.lit(1)).alias("n"))
        parts = parts.withColumn("through", F.sum("n").over(Window.partitionBy("source").orderBy("part")))
        parts = parts.where("through >= due AND through - n < due").select(
            F.col("source").alias("its_source"), F.col("part").alias("its_part"), (F.col("due") - F.col("through") + F.col("n")).alias("here"))
        same = F.col("source").eqNullSafe(F.col("its_source")) & (F.col("part") == F.col("its_part"))
        number = F.row_number().over(Window.partitionBy("source", "part").orderBy("place"))
        last = tied.join(parts, same).withColumn("number", number).where("number = here")
        return self.scratch.table(last.select(F.col("source").alias("last_source"), F.col("place").alias("last_place")), "last")

    def with_copies(self, measured: DataFrame) -> DataFrame:
        rows = _drawn(measured, self.classes).join(self.cuts, F.col("source").eqNullSafe(F.col("cut_source")), "left")
        taken = F.col("rank") <= F.col("cut")
        if self.splits:
            last = self._last_places(rows)
            rows = rows.join(last, F.col("source").eqNullSafe(F.col("last_source")), "left")
            taken = taken & ((F.col("rank") < F.col("cut")) | F.col("due").isNull() | (F.col("place") <= F.col("last_place")))
        return rows.withColumn("copies", (F.col("whole") + F.coalesce(taken.cast("bigint"), F.lit(0))).cast("bigint"))


def mix(
    docs: DataFrame, weights: Sequence[float] = (5, 2, 1), share: float = 1.5, most: float = 2.0, doc_id: str = "doc_id",
    text: str = "text", source: str = "source", seed: int = 0,
) -> DataFrame:
    """One row per document: size, source_size, its source's target, copies, and taken = copies * size."""
    scratch = Scratch(docs.sparkSession)
    narrow = scratch.table(_measured(docs, doc_id, text, source, seed, F.monotonically_increasing_id().alias("place")), "sizes")
    mixed = _Plan(narrow, weights, share, most, scratch).with_copies(narrow)
    return mixed.select("doc_id", "source", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"))


def mixed_copies(
    docs: DataFrame, weights: Sequence[float] = (5, 2, 1), share: float = 1.5, most: float = 2.0, doc_id: str = "doc_id",
    text: str = "text", source: str = "source", seed: int = 0,
) -> DataFrame:
    """The documents themselves, all columns, each as often as the mix takes it. No document is shuffled.

    Only if a cut falls among equal rows are the documents written once with their places.
    """
    scratch = Scratch(docs.sparkSession)
    narrow = scratch.table(_measured(docs, doc_id, text, source, seed), "sizes")
    plan = _Plan(narrow, weights, share, most, scratch)
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    measured = _measured(docs, doc_id, text, source, seed, whole, F.monotonically_increasing_id().alias("place"))
    rows = plan.with_copies(scratch.table(measured, "placed") if plan.splits else measured).where("copies > 0")
    rows = rows.select("row", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("copies"))).alias("copy"))
    return rows.select("row.*")
