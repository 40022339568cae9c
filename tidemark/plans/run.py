"""The two whole flows over a landing folder.

Landing layout: ``events users workspaces models actions processes files
integrations`` hold JSON pages (see :mod:`tidemark.sources.pages`), ``history``
holds the exports (see :mod:`tidemark.sources.exports`).
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, field
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import fixed, schemas
from tidemark.functions.rules import Rule
from tidemark.functions.taxonomy import category_seed
from tidemark.operators import catalog, lists, normalize
from tidemark.plans import history
from tidemark.plans.audit import wide_audit
from tidemark.plans.events import EventStore, prepare_events
from tidemark.plans.history import HistoryStore
from tidemark.session import empty_table, stage
from tidemark.sources import pages, paths, publish, tables
from tidemark.sources.snapshots import SnapshotTable

METADATA = {
    "workspaces": (pages.read_workspaces, schemas.WORKSPACES),
    "users": (pages.read_users, schemas.USERS),
    "models": (pages.read_models, schemas.MODELS),
    "cloudworks": (pages.read_integrations, schemas.INTEGRATIONS),
    "actions": (pages.read_actions, schemas.ACTIONS),
    "processes": (pages.read_processes, schemas.PROCESSES),
    "files": (pages.read_files, schemas.FILES),
}
LANDING_FOLDERS = {"cloudworks": "integrations"}
PER_MODEL = ["actions", "processes", "files"]
SCOPE_KEYS = ["workspace_id", "model_id"]


@dataclass
class Scope:
    """Which (workspace, model) pairs a run covers; all when no pairs are given."""

    pairs: DataFrame | None = None
    select: bool = True

    def apply(self, df: DataFrame) -> DataFrame:
        return df if self.pairs is None else lists.in_scope(df, self.pairs, SCOPE_KEYS, self.select)


def resolved_scope(references: DataFrame, workspaces: DataFrame, models: DataFrame) -> Scope:
    """A selecting scope from ids or names; fails on one that is unknown.

    ``references`` has columns ``workspace`` and ``model``. Of several with one
    name the last listed counts, by ``_ord`` where the tables have it and by id
    otherwise.
    """
    def place(listed: DataFrame):
        return F.col("_ord" if "_ord" in listed.columns else "id").alias("position")

    spaces = workspaces.select("id", "name", place(workspaces))
    found = lists.require_resolved(lists.resolve_names(references, spaces, "workspace", "workspace_id"), "workspace", "workspace_id")
    known = models.select("id", "name", F.col("workspaceId").alias("workspace_id"), place(models))
    found = lists.resolve_names(found, known, "model", "model_id", within=["workspace_id"])
    return Scope(lists.require_resolved(found, "model", "model_id").select(*SCOPE_KEYS).distinct())


@dataclass
class MetadataStore:
    """Metadata tables, replaced as a whole by every run."""

    spark: SparkSession
    path: str
    known: dict[str, SnapshotTable] = field(init=False)

    def __post_init__(self) -> None:
        shapes = {name: schema for name, (_, schema) in METADATA.items()}
        shapes["act_codes"] = schemas.CATALOG_COMPLETE
        self.known = {n: SnapshotTable(self.spark, f"{self.path}/{n}", s) for n, s in shapes.items()}

    def read(self, name: str) -> DataFrame:
        return self.in_order(name).drop("_ord")

    def in_order(self, name: str) -> DataFrame:
        """A table with the arrival order of its rows as ``_ord``."""
        return self.known[name].read()

    def load(self, landing: str, scope: Scope, **options) -> None:
        """Replace every table; a kind with no landed folder becomes empty."""
        for name, (reader, schema) in METADATA.items():
            folder = f"{landing}/{LANDING_FOLDERS.get(name, name)}"
            kept = schemas.ordered(schema)
            rows = reader(self.spark, folder, ordered=True, **options) if paths.exists(self.spark, folder) else empty_table(self.spark, kept)
            if name in PER_MODEL:
                rows = normalize.with_provenance(scope.apply(rows), self.read("workspaces"), self.read("models"))
            self.known[name].replace(normalize.to_schema(rows, kept), evolve=True)

    def load_catalog(self, catalog_path: str, events: DataFrame | None) -> None:
        listed = tables.read_catalog(self.spark, catalog_path)
        self.known["act_codes"].replace(catalog.with_catalog_columns(catalog.complete_catalog(listed, events)))


@dataclass(frozen=True)
class RunResult:
    events_loaded: int
    published: list[str]
    purged: int


def run_audit(
    spark: SparkSession, landing: str, storage: str, out: str, catalog_path: str, *, now: datetime,
    tenant_name: str = "", scope: Scope | None = None, categories: Iterable[str] = tuple(fixed.DEFAULT_ENABLED_CATEGORIES),
    list_categories: Iterable[str] = tuple(fixed.DEFAULT_LIST_CATEGORIES), extracts: dict[str, str] | None = None,
    list_extracts: dict[str, str] | None = None, retention_years: int = 0, dry_run: bool = False, multiline: bool = False,
    max_events: int | None = None, sync_lists: dict[str, str] | None = None, listed: dict[str, DataFrame] | None = None,
) -> RunResult:
    """Load landed pages, rebuild the catalogue, publish every extract, purge.

    Nothing is published, and the watermark stays, on a dry run or without
    events. ``extracts`` and ``list_extracts`` name the files; a table without
    a name is not published. Events before the last published run are not read
    again, and of the rest the first ``max_events`` in arrival order if given.

    ``sync_lists`` maps a list to a column of the wide table, ``listed`` gives
    the items (``code``, ``name``) each list has; what it lacks is published as
    ``NEW_<list>``, also when that is nothing.
    """
    store, metadata = EventStore(spark, storage), MetadataStore(spark, f"{storage}/metadata")
    metadata.load(landing, scope or Scope(), multiline=multiline)
    loaded = 0
    if paths.exists(spark, f"{landing}/events"):
        landed = pages.read_pages(spark, f"{landing}/events", "events", multiline=multiline)
        if store.watermark.exists():
            landed = pages.since(landed, store.last_run())
        if max_events is not None:
            landed = pages.first_arrived(landed, max_events)
        loaded = store.load(prepare_events(landed, categories=list(categories)))
    events = store.table.read() if store.table.exists() else None
    metadata.load_catalog(catalog_path, events)

    published: list[str] = []
    if events is not None and not dry_run:
        batch_ms = int(now.timestamp() * 1000)
        wide = wide_audit(
            events, users=metadata.read("users"), workspaces=metadata.read("workspaces"), models=metadata.read("models"),
            integrations=metadata.read("cloudworks"), actions=metadata.read("actions"), catalog=metadata.read("act_codes"),
            tenant_name=tenant_name, batch_ms=batch_ms,
        )
        if sync_lists:
            wide = stage(wide, "wide")
        publish.publish_audit(wide, out)
        exported = {name: metadata.in_order(name) for name in metadata.known}
        exported["models"] = lists.models_with_modifier(exported["models"], exported["users"].drop("_ord"))
        exported["act_codes"] = exported["act_codes"].orderBy("position").drop("position")
        exported["event_categories"] = category_seed(spark)
        published = ["audit", *publish.publish_metadata(exported, out, extracts or {}, {})]
        published += publish.publish_lists(spark, events, out, list_extracts or {}, list(list_categories))
        for name, items in publish.new_list_items(spark, wide, sync_lists or {}, listed or {}).items():
            publish.write_csv(items, f"{out}/NEW_{name}")
            published.append(f"new:{name}")
        publish.write_csv(publish.last_run(spark, batch_ms // 1000), f"{out}/last_run", single_file=True)
        store.finish_run(batch_ms // 1000, loaded)
    return RunResult(loaded, published, store.purge(now, retention_years))


def run_history(
    spark: SparkSession, landing: str, storage: str, out: str, *, now: datetime, pairs: DataFrame,
    rules: list[Rule] | None = None, retention_years: int = 2, keep_versions: int = 7,
) -> HistoryStore:
    """Load landed exports, publish the accumulated tables, then rotate and purge.

    ``pairs`` are the exported (workspace_id, model_id); each gets a registry
    row even when its export was empty.
    """
    captured_at = now.isoformat()
    metadata, store = MetadataStore(spark, f"{storage}/metadata"), HistoryStore(spark, f"{storage}/history")
    rows = history.history_rows(spark, f"{landing}/history", captured_at, rules)
    named = history.registry(pairs, metadata.read("workspaces"), metadata.read("models"), captured_at)
    store.load(rows, named, captured_at)
    store.publish(out)
    store.purge(now, retention_years)
    store.rotate(keep_versions)
    return store
