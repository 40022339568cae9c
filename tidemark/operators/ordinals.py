"""Row numbers over a whole table or file without a single-task window.

Rows are written once with the chunk they are in (a file split, or a range
partition). Counting rows per chunk and summing the counts of earlier chunks
gives each chunk its offset, so only one small row per chunk is ever ordered
globally and a single huge file is numbered by all its splits in parallel.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import stage

FILE_COLUMNS = ["_file", "_block"]


def with_source_position(df: DataFrame) -> DataFrame:
    """Add file, split start and in-task row number.

    Call on a scan that is already filtered: numbers must have no gaps.
    """
    return df.withColumns(
        {
            "_file": F.col("_metadata.file_path"),
            "_block": F.col("_metadata.file_block_start"),
            "_row": F.monotonically_increasing_id(),
        }
    )


def _number_chunks(staged: DataFrame, chunk: list[str], within: list[str], out: str, start: int) -> DataFrame:
    sizes = staged.groupBy(*chunk).agg(
        F.count(F.lit(1)).alias("_n"), F.min("_row").alias("_first")
    )
    order = [c for c in chunk if c not in within]
    earlier = Window.partitionBy(*within).orderBy(*order).rowsBetween(
        Window.unboundedPreceding, -1
    )
    offsets = sizes.withColumn("_offset", F.coalesce(F.sum("_n").over(earlier), F.lit(0))).drop("_n")
    return (
        staged.join(offsets, chunk)
        .withColumn(out, F.col("_row") - F.col("_first") + F.col("_offset") + F.lit(start))
        .drop("_first", "_offset")
    )


def number_file_rows(staged: DataFrame, out: str = "_ordinal", start: int = 0) -> DataFrame:
    """Number the rows of each file in file order.

    ``staged`` carries the columns of :func:`with_source_position`, written
    once with :func:`tidemark.session.stage` so that both passes agree.
    """
    return _number_chunks(staged, FILE_COLUMNS, ["_file"], out, start)


def number_rows(
    df: DataFrame, order_by: list[Column | str], out: str = "_ordinal", start: int = 1
) -> DataFrame:
    """Number all rows of ``df`` in the given (total) order."""
    ranged = df.repartitionByRange(*order_by).sortWithinPartitions(*order_by)
    placed = stage(
        ranged.withColumns(
            {"_chunk": F.spark_partition_id(), "_row": F.monotonically_increasing_id()}
        ),
        "rows",
    )
    return _number_chunks(placed, ["_chunk"], [], out, start).drop("_chunk", "_row")


def running_sums(df: DataFrame, order_by: list[str], value: str, out: str) -> DataFrame:
    """Sum of a whole-number column over the earlier rows and this one, in the given (total) order.

    Rows are range-partitioned and staged once; each partition sums its own
    rows, and only one sum per partition is ordered globally.
    """
    ranged = df.repartitionByRange(*order_by).withColumn("_chunk", F.spark_partition_id())
    placed = stage(ranged, "sums")
    sums = placed.groupBy("_chunk").agg(F.sum(value).alias("_sum"))
    earlier = Window.orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select("_chunk", F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_offset"))
    inside = Window.partitionBy("_chunk").orderBy(*order_by).rowsBetween(Window.unboundedPreceding, 0)
    summed = placed.withColumn(out, F.sum(value).over(inside)).join(offsets, "_chunk")
    return summed.withColumn(out, F.col(out) + F.col("_offset")).drop("_chunk", "_offset")
