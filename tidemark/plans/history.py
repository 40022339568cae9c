"""Change history: exports to the classified table, its list and registry."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import fixed, schemas
from tidemark.functions.rules import Rule, with_classification
from tidemark.functions.text import clean_name
from tidemark.operators import retention, unmatched
from tidemark.operators.joins import name_or_id
from tidemark.operators.upsert import one_per_key
from tidemark.session import stage, unstage
from tidemark.sources import publish
from tidemark.sources.exports import read_exports
from tidemark.sources.snapshots import SnapshotGroup, SnapshotTable, by_bucket_and_year

MODEL_BUCKETS = 8


def history_rows(
    spark: SparkSession, path: str, captured_at: str, rules: list[Rule] | None = None
) -> DataFrame:
    """Landed exports as the 21-column history table."""
    classified = with_classification(read_exports(spark, path, captured_at), "description", rules)
    return classified.select(*fixed.HISTORY_COLUMNS)


def history_list(history: DataFrame) -> DataFrame:
    return history.select("record_id", "model_id", "date_time_utc")


def registry(pairs: DataFrame, workspaces: DataFrame, models: DataFrame, captured_at: str) -> DataFrame:
    """One row per exported model; unknown names fall back to the id."""
    named = name_or_id(pairs, workspaces, "workspace_id", "workspace_name")
    named = name_or_id(named, models, "model_id", "_name")
    return named.select(
        "model_id", clean_name(F.col("_name")).alias("model_name"), "workspace_id", "workspace_name",
        F.lit(captured_at).alias("last_synced_at"),
    )


@dataclass
class HistoryStore:
    """The stored change-history tables below one folder.

    Rows are laid out by a hash of the model and the year of the change, which
    never change for a record, so a run only rewrites the parts of the models it
    exported, and a purge drops whole years unread. The four tables are
    committed together: a run that fails changes none of them. ``buckets`` should
    grow with the number of models and stay as it is for a stored table.
    """

    spark: SparkSession
    path: str
    buckets: int = MODEL_BUCKETS

    def __post_init__(self) -> None:
        self.group = SnapshotGroup(self.spark, self.path)
        dated = {
            "part": by_bucket_and_year("model_id", self.buckets, "date_time_utc"), "moves": False, "zone": "date_time_utc",
            "group": self.group,
        }
        self.registry = SnapshotTable(self.spark, f"{self.path}/model_registry", schemas.REGISTRY, "model_id", group=self.group)
        self.list = SnapshotTable(self.spark, f"{self.path}/model_history_list", schemas.HISTORY_LIST, "record_id", **dated)
        self.normalized = SnapshotTable(self.spark, f"{self.path}/model_history_normalized", schemas.HISTORY, "record_id", **dated)
        self.unmatched = SnapshotTable(self.spark, f"{self.path}/unmatched_descriptions", schemas.UNMATCHED, "description", group=self.group)

    def load(self, rows: DataFrame, registry_rows: DataFrame, captured_at: str) -> None:
        """Merge one run in one commit: registry replaced, list insert-only, labels refreshed."""
        rows = stage(rows, "history")
        unique, same = one_per_key(rows, "record_id", [c for c in fixed.HISTORY_COLUMNS if c != "record_id"])
        unique = unique if same else stage(unique, "history-unique")
        try:
            with self.group.transaction():
                self.registry.upsert(registry_rows)
                self.list.upsert(history_list(unique), update=[], staged=True)
                self.normalized.upsert(unique, update=["change_type", "object_type"], staged=True)
                self.count_unmatched(rows, captured_at)
        finally:
            unstage(rows, *([] if same else [unique]))

    def count_unmatched(self, classified: DataFrame, captured_at: str) -> None:
        """Merge a run's counts of descriptions that no rule covers; the first sighting is kept."""
        counts = unmatched.unmatched_counts(classified).withColumns(
            {"first_seen_at": F.lit(captured_at), "last_seen_at": F.lit(captured_at)}
        )
        self.unmatched.upsert(counts, update=["occurrences", "last_seen_at"])

    def purge(self, now: datetime, years: int = 2, typed: bool = False) -> dict[str, int]:
        """Drop rows older than the retention window in one commit; returns how many.

        Compared as text, only parts that hold dates on both sides are read;
        compared as instants (``typed``) all are.
        """
        cutoff = retention.cutoff_text(now, years)
        kept = (retention.kept_by_time if typed else retention.kept_by_text)("date_time_utc", cutoff)
        least = None if typed else cutoff
        with self.group.transaction():
            return {"normalized": self.normalized.keep_where(kept, least=least), "list": self.list.keep_where(kept, least=least)}

    def rotate(self, keep: int = 7) -> None:
        """Keep the newest ``keep`` commits."""
        self.group.rotate(keep)

    def publish(self, folder: str) -> None:
        publish.publish_history(self.registry.read(), self.list.read(), self.normalized.read(), folder)
