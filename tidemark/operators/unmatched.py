"""Report of descriptions that no classification rule covers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark import fixed
from tidemark.operators.upsert import merge_rows


def unmatched_counts(classified: DataFrame) -> DataFrame:
    """Occurrences per description that fell to the catch-all, over all models."""
    expected = F.col("description").isin("", fixed.CATCHALL_CHANGE_TYPE)
    return (
        classified.where((F.col("change_type") == fixed.CATCHALL_CHANGE_TYPE) & ~expected)
        .groupBy("description").agg(F.count(F.lit(1)).alias("occurrences"))
    )


def unmatched_summary(counts: DataFrame) -> DataFrame:
    """One row: total occurrences and number of distinct descriptions."""
    return counts.agg(
        F.coalesce(F.sum("occurrences"), F.lit(0)).alias("total"),
        F.count(F.lit(1)).alias("distinct_descriptions"),
    )


def unmatched_top(counts: DataFrame, top_n: int = 10) -> DataFrame:
    """The most frequent descriptions; ties by text."""
    return counts.orderBy(F.desc("occurrences"), "description").limit(top_n)


def merge_unmatched(stored: DataFrame, counts: DataFrame, captured_at: str) -> DataFrame:
    """This run's counts merged in; the first sighting of a description is kept."""
    batch = counts.withColumns(
        {"first_seen_at": F.lit(captured_at), "last_seen_at": F.lit(captured_at)}
    )
    return merge_rows(stored, batch, "description", update=["occurrences", "last_seen_at"])


def unmatched_report(stored: DataFrame, head: int | None = 50, latest_only: bool = False) -> DataFrame:
    """Stored rows, latest and most frequent first.

    ``latest_only`` keeps the rows last seen in the newest run.
    """
    if latest_only:
        newest = stored.agg(F.max("last_seen_at").alias("last_seen_at"))
        stored = stored.join(newest, "last_seen_at", "left_semi")
    ordered = stored.orderBy(F.desc("last_seen_at"), F.desc("occurrences"), "description")
    return ordered if head is None else ordered.limit(head)
