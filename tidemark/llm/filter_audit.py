"""How filters act together: all orders of five filters from one contingency tensor.

Each document is one of 2^5 patterns of passing and failing. Only the counts of
patterns per part are needed for every order, so the documents are read once:

1. per row, the pattern of the filters that look at the text alone;
2. per distinct text and part, rows and the smallest id, from which follows how
   many rows repeat the text of a smaller id. A text that fills a third of the
   table is a handful of partial sums before it is shuffled;
3. per part a tensor of shape 2x2x2x2x2, contracted along each axis with the
   selector of passing, failing or all rows, for every step of every order.

Parts are the values of a column; null counts as the empty string. Null text is
the empty text. A row without an id repeats no smaller id and is none itself;
rows that repeat an id do not repeat each other. An id with several labels
counts as good or toxic if one of them says so. Extra columns are not read. An
empty table has no parts and gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import permutations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import Scratch, arrow_chunks, arrow_rows, join_checked
from tidemark.llm.risk_rules import words_of

FILTERS = "ABCDE"
REPEATS = 1 << FILTERS.index("E")
SYMBOLS = "[#$%&*|]"


def text_pattern(text: Column, words: Column) -> Column:
    """Bits of the filters A to D that the text fails."""
    n, distinct = F.size(words), F.size(F.array_distinct(words))
    capitals = F.length(F.regexp_replace(text, "[^A-Z]+", ""))
    fails = [n < 200, 100 * distinct < 50 * n, 100 * capitals > 3 * F.length(text), text.rlike(SYMBOLS)]
    return sum((F.when(failed, 1 << k).otherwise(0) for k, failed in enumerate(fails)), F.lit(0))


def patterns(docs: DataFrame, labels: DataFrame, scratch: Scratch, part_column: str = "lang") -> DataFrame:
    """part, pattern, n, good, toxic: counts per part and pattern of failed filters."""
    rows = docs.select(
        "doc_id", F.coalesce(F.col(part_column).cast("string"), F.lit("")).alias("part"), F.coalesce("text", F.lit("")).alias("text")
    ).withColumn("words", words_of(F.col("text")))
    rows = scratch.put(
        rows.select(
            "doc_id", "part", F.unhex(F.sha2("text", 256)).alias("same"), text_pattern(F.col("text"), F.col("words")).alias("pattern")
        ), "rows",
    )
    marks = scratch.put(
        labels.where("doc_id IS NOT NULL").groupBy("doc_id")
        .agg(F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
        .where("good = 1 OR toxic = 1"), "marks",
    )
    marked = join_checked(rows, marks, "doc_id", "left").fillna(0, ["good", "toxic"])
    cell = ["same", "part", "pattern", "good", "toxic"]
    by_id = marked.groupBy(*cell, "doc_id").agg(F.count(F.lit(1)).alias("n"))
    has_id = F.col("doc_id").isNotNull()
    cells = by_id.groupBy(*cell).agg(
        F.sum("n").alias("n"), F.sum(F.when(~has_id, F.col("n")).otherwise(0)).alias("no_id"),
        F.min(F.when(has_id, F.struct("doc_id", "n"))).alias("first"),
    )
    # A text has few cells: its pattern is one, so parts and labels alone tell them apart.
    smallest = F.min("first.doc_id").over(Window.partitionBy("same"))
    leads = F.when(F.col("first.doc_id") == smallest, F.col("first.n")).otherwise(0)
    split = cells.withColumn("lead", F.coalesce(leads, F.lit(0)) + F.col("no_id")).select(
        "part", "good", "toxic",
        F.explode(F.array(
            F.struct(F.col("pattern").alias("pattern"), F.col("lead").alias("n")),
            F.struct((F.col("pattern") + REPEATS).alias("pattern"), (F.col("n") - F.col("lead")).alias("n")),
        )).alias("x"),
    )
    return split.groupBy("part", "x.pattern").agg(
        F.sum("x.n").alias("n"), F.sum(F.col("x.n") * F.col("good")).alias("good"), F.sum(F.col("x.n") * F.col("toxic")).alias("toxic")
    )


def contract(tensor) -> Iterator[tuple]:
    """(order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley) of one part.

    ``tensor``: measure (rows, good, toxic) x pass/fail along each filter.
    """
    import numpy as np

    passing, failing, every = (np.array(v, np.int64) for v in ([1, 0], [0, 1], [1, 1]))
    known: dict[tuple[str, str], object] = {}

    def chosen(passed: str, failed: str):
        """Sums over rows that pass and fail these filters, whatever the others say."""
        key = "".join(sorted(passed)), failed
        if key not in known:
            axes = [passing if f in passed else failing if f in failed else every for f in FILTERS]
            known[key] = np.einsum("mabcde,a,b,c,d,e->m", tensor, *axes)
        return known[key]

    orders = ["".join(o) for o in permutations(FILTERS)]
    shapley = {f: sum(int(chosen(o[: o.index(f)], f)[0]) for o in orders) for f in FILTERS}
    for order in orders:
        for step, f in enumerate(order, 1):
            removed, good, toxic = (int(v) for v in chosen(order[: step - 1], f))
            kept = int(chosen(order[:step], "")[0])
            redundant = int(chosen("", f)[0]) - removed
            unique = int(chosen(FILTERS.replace(f, ""), f)[0])
            yield order, step, kept, removed, redundant, unique, good, toxic, shapley[f]


def audit(docs: DataFrame, labels: DataFrame, part_column: str = "lang") -> DataFrame:
    """One row per part, filter_order and step."""
    import pyarrow as pa

    scratch = Scratch(docs.sparkSession, "audit")
    counted = scratch.put(patterns(docs, labels, scratch, part_column), "patterns")
    parts = counted.groupBy("part").agg(F.collect_list(F.struct("pattern", "n", "good", "toxic")).alias("cells"))
    names = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    schema = pa.schema([("part", pa.string()), ("filter_order", pa.string()), ("step", pa.int32()), *[(n, pa.int64()) for n in names]])

    def contracted(batches: Iterator) -> Iterator:
        import numpy as np

        def out():
            for part, cells in arrow_rows(batches, ["part", "cells"]):
                flat = np.zeros((3, 1 << len(FILTERS)), np.int64)
                for c in cells:
                    flat[:, c["pattern"]] = c["n"], c["good"], c["toxic"]
                # The first filter is the lowest bit, hence the last axis of a plain reshape.
                tensor = flat.reshape(3, 2, 2, 2, 2, 2).transpose(0, 5, 4, 3, 2, 1)
                for row in contract(tensor):
                    yield part, *row

        yield from arrow_chunks(out(), schema)

    return parts.mapInArrow(contracted, "part string, filter_order string, step int, " + ", ".join(f"{n} long" for n in names))
