"""Stored audit events: ingest, retention, backfill and run state."""

from __future__ import annotations

import json
from collections import Counter
from collections.abc import Iterable
from dataclasses import dataclass, field
from datetime import datetime

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidemark import fixed, schemas
from tidemark.functions.attributes import with_attributes, yields_value
from tidemark.operators import backfill as fill
from tidemark.operators import retention
from tidemark.operators.normalize import coerce_events
from tidemark.operators.upsert import attribute_keys, one_per_key
from tidemark.session import observed, stage, unstage
from tidemark.sources import publish
from tidemark.sources.snapshots import SnapshotTable, by_day

# Keys that one bucket of the event index should hold.
INDEX_ROWS = 1_000_000


def prepare_events(
    landed: DataFrame, *, attributes: bool = True, categories: Iterable[str] | None = tuple(fixed.DEFAULT_ENABLED_CATEGORIES),
    retain_raw: bool = True,
) -> DataFrame:
    """Landed rows to stored shape. With ``attributes`` off nothing is lifted."""
    coerced = coerce_events(landed)
    parsed = with_attributes(coerced, categories=categories, retain_raw=retain_raw).drop("additionalAttributes")
    if not attributes:
        parsed = parsed.drop(*fixed.ATTRIBUTE_COLUMNS.values(), fixed.RAW_ATTRIBUTES_COLUMN)
    return parsed


def load_metrics(prepared: DataFrame) -> list[Column]:
    """What a load counts while it writes: rows, rows without an id or date, and rows with optional values."""
    has = lambda column: column in prepared.columns
    lifted = [c for c in fixed.ATTRIBUTE_COLUMNS.values() if has(c)]
    flags = {
        "without_id": F.col("id") == "",
        "without_date": F.col("eventDate") == 0,
        "with_attributes": F.size("attrs") > 0 if has("attrs") else F.lit(False),
        "with_values": yields_value(lifted) if lifted else F.lit(False),
        "with_other_fields": F.size("other") > 0 if has("other") else F.lit(False),
    }
    return [F.count(F.lit(1)).alias("rows_in"), *[F.count_if(flag).alias(name) for name, flag in flags.items()]]


@dataclass
class EventStore:
    """The stored events below one folder, laid out by event day.

    ``steps`` holds the counts of the loads since the last finished run, by
    step and metric. They are taken while the rows are written.
    """

    spark: SparkSession
    path: str
    index_rows: int = INDEX_ROWS
    steps: Counter = field(default_factory=Counter, init=False)

    def __post_init__(self) -> None:
        self.table = SnapshotTable(
            self.spark, f"{self.path}/events", schemas.EVENTS, "id", by_day("eventDate"), index_rows=self.index_rows
        )
        self.run_metrics = SnapshotTable(self.spark, f"{self.path}/run_metrics", schemas.RUN_METRICS, "metric_id")
        self.run_log = SnapshotTable(self.spark, f"{self.path}/run_log", schemas.RUN_LOG, "batch_code")
        self.watermark = SnapshotTable(self.spark, f"{self.path}/watermark", schemas.WATERMARK, "last_run_epoch")

    def load(self, prepared: DataFrame) -> int:
        """Upsert a batch, the later arrival winning; returns its row count.

        Optional columns this batch does not carry at all keep their values,
        as do attribute keys and undeclared fields that no event of the batch has.
        """
        seen = Observation()
        batch = stage(prepared.observe(seen, *load_metrics(prepared)), "events")
        counts = observed(seen) or {"rows_in": 0}
        self.steps.update({("load", name): n or 0 for name, n in counts.items()})
        if counts["rows_in"]:
            maps = attribute_keys(batch, [c for c in ("attrs", "other") if c in batch.columns])
            properties = {"schema_version": str(fixed.EVENTS_SCHEMA_VERSION)}
            if maps.get("other"):
                properties["event_fields"] = json.dumps(sorted({*self.fields(), *maps["other"]}))
            unique, same = one_per_key(batch, "id", ["_ord"])
            self.table.upsert(unique, not_older="_ord", maps=maps, properties=properties, staged=same)
            self.steps["load", "rows_written"] += self.table.last["rows_written"]
        unstage(batch)
        return counts["rows_in"]

    def fields(self, number: int | None = None) -> list[str]:
        """Undeclared fields that events of a version (the newest if not given) have brought so far."""
        return json.loads(self.table.version(number).properties.get("event_fields", "[]"))

    def read(self, number: int | None = None) -> DataFrame:
        """Stored events with each undeclared field as a column of its own."""
        events = self.table.read(number)
        if not (fields := self.fields(number)):
            return events.drop("other")
        taken = {c.lower() for c in events.columns}
        named = {f: f if f.lower() not in taken else f"other.{f}" for f in fields}
        kept = [F.col(f"`{c}`") for c in events.columns if c != "other"]
        return events.select(*kept, *[F.element_at("other", f).alias(n) for f, n in named.items()])

    def purge(self, now: datetime, years: int) -> int:
        """Drop events older than the retention window; 0 years keeps all."""
        if years <= 0 or not self.table.exists():
            return 0
        cutoff = retention.cutoff_ms(now, years)
        last_day = retention.cutoff_time(now, years).date().isoformat()
        old_days = [p for p in self.table.version().parts if p <= last_day]
        return self.table.keep_where(retention.kept_by_ms("eventDate", cutoff), old_days)

    def backfill(
        self, *, since_ms: int | None = None, limit: int | None = None, dry_run: bool = False,
        categories: Iterable[str] | None = None, retain_raw: bool = True,
    ) -> fill.BackfillCounts:
        """Fill lifted columns of rows stored before they were extracted."""
        if not self.table.exists():
            return fill.BackfillCounts(0, 0, 0)
        marked = fill.mark_candidates(self.table.read(), since_ms, limit)
        marked = stage(marked.where("_candidate"), "backfill")
        counts = fill.BackfillCounts(*fill.backfill_counts(marked).first())
        if not dry_run and counts.updated:
            done = fill.backfill(marked, categories=categories, retain_raw=retain_raw)
            self.table.upsert(
                done.select("id", "eventDate", *fixed.ATTRIBUTE_COLUMNS.values(), fixed.RAW_ATTRIBUTES_COLUMN)
            )
        unstage(marked)
        return counts

    def finish_run(self, epoch_seconds: int, records: int) -> None:
        """Record a published run: its watermark, a run-log entry and the counts of its steps."""
        self.watermark.replace(publish.last_run(self.spark, epoch_seconds))
        self.run_log.upsert(publish.run_log_row(self.spark, epoch_seconds, records))
        if self.steps:
            self.run_metrics.upsert(publish.run_metric_rows(self.spark, epoch_seconds, self.steps))
        self.steps = Counter()

    def last_run(self) -> int:
        row = self.watermark.read().agg(F.max("last_run_epoch")).first()
        return row[0] or 0
