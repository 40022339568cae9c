"""Mix sources to target weights by entropy balancing.

Of all document rates whose words sum to each source's target, those closest
to 1 in relative entropy are taken. They have the form
``min(most, exp(tilt * size / mean size of the source))``: one dual variable
per source, found by Newton steps on the convex dual that all sources take
together. A step reads counts per source and size, not documents, and its sums
are exact decimals, so reruns agree. Where a step leaves the bracket known to
hold the root, or the curve is flat, the bracket is halved instead.

Rates are rounded into whole copies along the order source, size, id: the copies
of the first n documents are the rounded sum of their rates. The words then miss
the target by less than one document of the largest size; a few documents per
source get a copy more or less to close that gap.

A null text has no words. The null source is a source of its own, last in
order. Documents without words have rate 1 and no weight. Sources without
words have target 0. Extra columns are not read. An empty table gives none.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import SPACES, Scratch, join_checked, running_total

UNIT = 1 << 20  # rates are summed in these fractions, exactly


def word_count(text: Column) -> Column:
    """Number of ``[^\\x20\\x09-\\x0D]+`` in a text."""
    plain = F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), SPACES, " "))
    blanks = F.octet_length(plain) - F.octet_length(F.replace(plain, F.lit(" "), F.lit("")))
    return F.when(plain == "", F.lit(0).cast("long")).otherwise((blanks + 1).cast("long"))


def targets(sizes: DataFrame, weights: tuple[int, ...] = (1, 2, 3), most: int = 3) -> DataFrame:
    """source, source_size -> with target.

    Sources in code-point order, null last, weigh ``weights`` in turn. A target
    is at most ``most`` times its source; the rest is shared by weight again.
    That is one level L with target = min(most * size, weight * L): sources
    ordered by the level at which they are full give it in one pass. Windows
    here run over one row per source.
    """
    order = Window.orderBy(F.col("source").isNull(), "source")
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.pmod(F.row_number().over(order) - 1, F.lit(len(weights))) + 1).cast("int"))
    full = sizes.withColumn("weight", weight).withColumn("most", F.col("source_size") * most)
    by_level = Window.orderBy(F.col("most") / F.col("weight"), F.col("source").isNull(), "source")
    before = by_level.rowsBetween(Window.unboundedPreceding, -1)
    after = by_level.rowsBetween(0, Window.unboundedFollowing)
    every = Window.orderBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    fills = F.col("most") / F.col("weight")
    level = full.withColumn(
        "level", (F.sum("source_size").over(every) - F.coalesce(F.sum("most").over(before), F.lit(0))) / F.sum("weight").over(after)
    )
    # The first source that the level of those not yet full does not fill.
    found = level.withColumn("level", F.min(F.when(fills >= F.col("level"), F.struct(fills.alias("fills"), "level"))).over(every)["level"])
    return found.select(
        "source", "source_size", F.least(F.col("most").cast("double"), F.col("weight") * F.col("level")).alias("target")
    )


def _tilts(cells: DataFrame, goals: DataFrame, most: int, scratch: Scratch, rounds: int = 60, near: float = 1e-7) -> DataFrame:
    """source_id -> tilt, by guarded Newton steps. ``cells``: source_id, size, n."""
    exact = lambda c: F.sum(F.round(c, 6).cast("decimal(30,6)")).cast("double")
    state = goals.select(
        "source_id", "mean", "target", F.lit(0.0).alias("tilt"), F.lit(-64.0).alias("low"), F.lit(64.0).alias("high"),
        F.lit(False).alias("done"),
    )
    state = scratch.put(state, "tilts")
    for _ in range(rounds):
        open_ = state.where(~F.col("done"))
        at = cells.join(open_.select("source_id", "mean", "tilt"), "source_id")
        x = F.col("size") / F.col("mean")
        rate = F.least(F.lit(float(most)), F.exp(F.least(F.col("tilt") * x, F.lit(50.0))))
        words = F.col("n") * F.col("size") * rate
        slope = F.when(rate < most, words * x).otherwise(F.lit(0.0))
        sums = at.groupBy("source_id").agg(exact(words).alias("words"), exact(slope).alias("slope"))
        gap = F.col("target") - F.col("words")
        moved = (
            state.join(sums, "source_id", "left")
            .withColumn("low", F.when(gap > 0, F.col("tilt")).otherwise(F.col("low")))
            .withColumn("high", F.when(gap <= 0, F.col("tilt")).otherwise(F.col("high")))
            .withColumn("step", F.col("tilt") + F.when(F.col("slope") > 0, gap / F.col("slope")))
            .withColumn("close", F.col("words").isNull() | (F.abs(gap) <= F.col("target") * near))
        )
        inside = (F.col("step") > F.col("low")) & (F.col("step") < F.col("high"))
        best = F.when(F.col("done") | F.col("close"), F.col("tilt")).when(inside, F.col("step")).otherwise(
            (F.col("low") + F.col("high")) / 2
        )
        new = scratch.put(
            moved.select("source_id", "mean", "target", F.round(best, 12).alias("tilt"), "low", "high",
                         (F.col("done") | F.col("close") | (F.col("high") - F.col("low") < 1e-11)).alias("done")),
            "tilts",
        )
        scratch.drop(state)
        state = new
        if state.where(~F.col("done")).isEmpty():
            break
    return state.select("source_id", "mean", "tilt")


def _corrections(rounded: DataFrame, most: int, scratch: Scratch, rounds: int = 2) -> DataFrame:
    """(source_id, doc_id, change): at most ``rounds`` documents a source get a copy more or less.

    Each is the one whose size comes closest to what its source still misses.
    """
    target_gap = F.first("target") - F.sum(F.col("copies") * F.col("size"))
    gaps = rounded.groupBy("source_id").agg(target_gap.alias("gap")).withColumn("last", F.lit(None).cast("long"))
    gaps = scratch.put(gaps, "gaps")
    found = []
    for _ in range(rounds):
        at = rounded.join(gaps, "source_id").where(~F.col("doc_id").eqNullSafe(F.col("last")))
        sign = F.when(F.col("gap") > 0, 1).otherwise(-1)
        rest = F.abs(F.col("gap") - sign * F.col("size"))
        room = F.when(F.col("gap") > 0, F.col("copies") < most).otherwise(F.col("copies") > 0)
        best = at.where(room & (rest < F.abs("gap"))).groupBy("source_id").agg(
            F.min(F.struct(rest.alias("rest"), "doc_id", "size", sign.alias("change"))).alias("b")
        )
        best = scratch.put(best.select("source_id", "b.doc_id", "b.size", "b.change"), "change")
        found.append(best.select("source_id", "doc_id", "change"))
        gaps = gaps.join(best, "source_id", "left").select(
            "source_id", (F.col("gap") - F.coalesce(F.col("size") * F.col("change"), F.lit(0))).alias("gap"),
            F.col("doc_id").alias("last"),
        )
    return reduce(DataFrame.union, found)


def mix(
    docs: DataFrame, weights: tuple[int, ...] = (1, 2, 3), most: int = 3, id_column: str = "doc_id",
    text_column: str = "text", source_column: str = "source",
) -> DataFrame:
    """doc_id, source, size, source_size, target, rate, copies, taken; one row per row."""
    scratch = Scratch(docs.sparkSession, "mix")
    sized = scratch.put(
        docs.select(F.col(id_column).alias("doc_id"), F.col(source_column).alias("source"), word_count(F.col(text_column)).alias("size")),
        "sizes",
    )
    counts = scratch.put(sized.groupBy("source", "size").agg(F.count(F.lit(1)).alias("n")), "cells")
    sources = counts.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"), F.sum("n").alias("n"))
    numbered = Window.orderBy(F.col("source").isNull(), "source")
    goals = scratch.put(
        targets(sources.select("source", "source_size"), weights, most)
        .join(sources.select(F.col("source").alias("s"), "n"), F.col("source").eqNullSafe(F.col("s")))
        .drop("s")
        .withColumn("source_id", F.row_number().over(numbered))
        .withColumn("mean", F.greatest(F.col("source_size") / F.col("n"), F.lit(1e-9))),
        "goals",
    )
    known = goals.select("source_id", F.col("source").alias("s"))
    by_id = lambda df: df.join(known, F.col("source").eqNullSafe(F.col("s"))).drop("s")
    cells = scratch.put(by_id(counts).drop("source"), "cells-by-id")
    full = F.col("target") >= F.col("source_size") * most * (1 - 1e-12)
    tilts = _tilts(cells, goals.where(~full & (F.col("source_size") > 0)), most, scratch)
    rates = goals.join(tilts.select("source_id", "tilt"), "source_id", "left").select(
        "source_id", "source_size", "target", "mean", "tilt", (full & (F.col("source_size") > 0)).alias("full")
    )
    rates = scratch.put(rates, "rates")
    x = F.col("size") / F.col("mean")
    tilted = F.least(F.lit(float(most)), F.exp(F.least(F.col("tilt") * x, F.lit(50.0))))
    rate = F.when((F.col("size") == 0) | F.col("tilt").isNull() & ~F.col("full"), 1.0).when(F.col("full"), float(most)).otherwise(tilted)
    rated = join_checked(by_id(sized), rates, "source_id").select(
        "doc_id", "source", "source_id", "size", "source_size", "target", rate.alias("rate"),
        F.round(rate * UNIT).cast("long").alias("_units"),
    )
    order = ["size", "doc_id"]
    summed = running_total(rated, ["source_id"], [F.col(c) for c in order], order, "_units", "_sum", scratch)
    half = UNIT // 2
    copies = F.expr(f"(_sum + {half}) div {UNIT} - (_sum - _units + {half}) div {UNIT}")
    rounded = scratch.put(summed.withColumn("copies", copies).drop("_sum", "_units"), "rounded")
    changes = _corrections(rounded, most, scratch)
    changed = rounded.join(changes.withColumnRenamed("source_id", "s").withColumnRenamed("doc_id", "d"),
                           (F.col("source_id") == F.col("s")) & (F.col("doc_id") == F.col("d")), "left")
    final = changed.withColumn("copies", F.col("copies") + F.coalesce("change", F.lit(0)))
    return final.select(
        "doc_id", "source", "size", "source_size", "target", "rate", "copies", (F.col("copies") * F.col("size")).alias("taken")
    )
