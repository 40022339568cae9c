"""Landed event pages as a stream of upserts.

The checkpoint remembers which files were read, so there is no watermark to
keep. Events of any age are merged. Overlapping polls deliver an event more
than once and files may be picked up out of order; the stored arrival order
decides which version stays, so a replay gives the same table as one batch, and
a micro-batch that runs twice changes nothing the second time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tidemark.plans.events import EventStore, prepare_events
from tidemark.sources.pages import landed_pages, page_rows


def ingest(
    spark: SparkSession, landing: str, store: EventStore, checkpoint: str, *,
    files_per_batch: int | None = None, multiline: bool = False, **options,
) -> StreamingQuery:
    """Start the ingest of everything landed so far; await it to finish."""
    pages = landed_pages(
        spark, landing, "events", stream=True, multiline=multiline, files_per_batch=files_per_batch
    )

    def merge(batch: DataFrame, batch_id: int) -> None:
        store.load(prepare_events(page_rows(batch, "events"), **options))

    return (
        pages.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )
