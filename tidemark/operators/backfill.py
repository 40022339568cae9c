"""Fill the lifted attribute columns of stored rows that lack an archive."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import fixed
from tidemark.functions.attributes import lifted_from_map


@dataclass(frozen=True)
class BackfillCounts:
    scanned: int
    updated: int
    skipped: int


def candidate(since_ms: int | None = None) -> Column:
    """Rows never backfilled, optionally only from an event time on."""
    missing = F.col(fixed.RAW_ATTRIBUTES_COLUMN).isNull()
    return missing if since_ms is None else missing & (F.col("eventDate") >= since_ms)


def _has_data() -> Column:
    return F.coalesce(F.exists(F.map_values("attrs"), lambda v: v.isNotNull() & (v != "")), F.lit(False))


def mark_candidates(
    events: DataFrame, since_ms: int | None = None, limit: int | None = None, key: str = "id"
) -> DataFrame:
    """Add ``_candidate``; a limit takes the first rows by event time and key."""
    if limit is None:
        return events.withColumn("_candidate", F.coalesce(candidate(since_ms), F.lit(False)))
    first = (
        events.where(candidate(since_ms)).orderBy("eventDate", key).limit(limit)
        .select(F.col(key).alias("_k"), F.lit(True).alias("_candidate"))
    )
    return events.join(first, F.col(key) == F.col("_k"), "left").drop("_k").withColumn(
        "_candidate", F.coalesce("_candidate", F.lit(False))
    )


def backfill(
    marked: DataFrame, *, categories: Iterable[str] | None = None, retain_raw: bool = True
) -> DataFrame:
    """Rebuild the lifted columns of marked rows that hold attributes."""
    applies = F.col("_candidate") & _has_data()
    rebuilt = lifted_from_map(F.col("attrs"), categories=categories, retain_raw=retain_raw)
    return marked.withColumns(
        {c: F.when(applies, new).otherwise(F.col(c)) for c, new in rebuilt.items()}
    ).drop("_candidate")


def backfill_counts(marked: DataFrame) -> DataFrame:
    """One row: rows scanned, updated, and skipped for want of attributes."""
    return marked.where("_candidate").agg(
        F.count(F.lit(1)).alias("rows_scanned"),
        F.count_if(_has_data()).alias("rows_updated"),
        F.count_if(~_has_data()).alias("rows_skipped"),
    )
