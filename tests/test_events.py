"""Landed events to stored events: coercion, attributes, upsert, stream, backfill."""

import json
from datetime import UTC, datetime

import pytest
from pyspark.sql import functions as F

from tidemark import fixed
from tidemark.functions import attributes
from tidemark.plans import table_checks
from tidemark.plans.events import EventStore, prepare_events
from tidemark.session import stage
from tidemark.sources import pages, snapshots
from tidemark.sources.pages import read_pages
from tidemark.streaming.ingest import ingest


def land(folder, number, events):
    folder.mkdir(exist_ok=True)
    page = {"meta": {"paging": {}}, "status": {"code": 200}, "response": events}
    (folder / f"page-{number:03d}.json").write_text(json.dumps(page, ensure_ascii=False) + "\n")


def prepared(spark, folder, **options):
    return prepare_events(read_pages(spark, str(folder), "events"), **options)


def by_id(df, *columns):
    return {r["id"]: tuple(r[c] for c in columns) if len(columns) > 1 else r[columns[0]] for r in df.collect()}


def test_loose_types_are_coerced(spark, tmp_path):
    land(tmp_path / "in", 0, [
        {"id": 2529918698, "eventDate": 1705312200000, "userId": None, "success": False, "errorNumber": 7},
        {"id": "b"}, {"userId": "no id"},
    ])
    rows = by_id(prepared(spark, tmp_path / "in"), "eventDate", "userId", "success", "errorNumber", "message", "index")
    assert rows["2529918698"] == (1705312200000, "", False, "7", "", 0)
    assert rows["b"] == (0, "", True, None, "", 0)
    assert rows[""] == (0, "no id", True, None, "", 0)


def test_empty_page_adds_nothing_and_pages_may_be_pretty_printed(spark, tmp_path):
    land(tmp_path / "in", 0, [])
    assert prepared(spark, tmp_path / "in").count() == 0
    (tmp_path / "pretty").mkdir()
    (tmp_path / "pretty/p.json").write_text(json.dumps({"response": [{"id": "x"}, {"id": "y"}]}, indent=4))
    rows = read_pages(spark, str(tmp_path / "pretty"), "events", multiline=True)
    assert [r["id"] for r in rows.orderBy("_ord").collect()] == ["x", "y"]


def test_since_and_cap_follow_arrival_order(spark, tmp_path):
    for page in range(3):
        land(tmp_path / "in", page, [{"id": f"{page}-{i}", "eventDate": 1000 * (10 * page + i)} for i in range(4)])
    rows = prepared(spark, tmp_path / "in")
    late = pages.since(rows, 11)
    assert {r["id"] for r in late.collect()} == {"1-1", "1-2", "1-3", "2-0", "2-1", "2-2", "2-3"}
    assert [r["id"] for r in pages.first_arrived(late, 4).collect()] == ["1-1", "1-2", "1-3", "2-0"]


ATTRS = {
    "object": {"appId": "a", "pageId": 5, "active": True, "actionName": False, "note": None},
    "text": '{"appName": "Übung | G&A", "appId": "t"}',
    "blank": "   ", "bare": "FRCST-id", "list": [1, 2], "listtext": "[1]", "empty": {}, "none": None,
    "tail": '{"appId": "x"} trailing', "two": '{"appId": "x"},{"appId": "y"}', "number": 5,
    "nested": {"a": {"b": {"c": "deep", "d": [1, {"e": 2}]}, "empty": {}}, "appId": {"k": 1}, "a.b": {"z": True}},
}


@pytest.fixture(scope="module")
def attribute_rows(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("attrs") / "in"
    land(folder, 0, [{"id": k, "additionalAttributes": v} for k, v in ATTRS.items()])
    return prepared(spark, folder, categories=None).cache()


def test_attribute_map(attribute_rows):
    maps = by_id(attribute_rows, "attrs")
    assert maps["object"] == {"appId": "a", "pageId": "5", "active": "1", "actionName": "0", "note": None}
    assert maps["text"] == {"appName": "Übung | G&A", "appId": "t"}
    assert maps["nested"] == {"a.b.c": "deep", "a.b.d": '[1,{"e":2}]', "appId.k": "1", "a.b.z": "1"}
    assert maps["empty"] == {}
    for absent in ("blank", "bare", "list", "listtext", "none", "tail", "two", "number"):
        assert maps[absent] is None, absent


def test_lifted_columns_and_archive(attribute_rows):
    got = by_id(attribute_rows, "app_id", "page_id", "action_name", fixed.RAW_ATTRIBUTES_COLUMN)
    assert got["object"][:3] == ("a", "5", "False")
    assert json.loads(got["object"][3]) == ATTRS["object"]
    assert got["nested"][0] == '{"k":1}'
    assert json.loads(got["nested"][3]) == ATTRS["nested"]
    assert got["empty"] == got["none"] == got["bare"] == (None,) * 4


def test_archive_keys_are_sorted(attribute_rows):
    raw = by_id(attribute_rows, fixed.RAW_ATTRIBUTES_COLUMN)["nested"]
    assert raw == json.dumps(ATTRS["nested"], sort_keys=True, separators=(",", ":"))


def test_gating_and_archive_switch(spark, tmp_path):
    land(tmp_path / "in", 0, [{"id": "1", "additionalAttributes": {"appId": "a", "roleId": "r", "actionId": "x"}}])
    default = prepared(spark, tmp_path / "in").first()
    assert (default["app_id"], default["action_id"], default["role_id"]) == ("a", "x", None)
    gated = prepared(spark, tmp_path / "in", categories=["role", "nope"], retain_raw=False).first()
    assert (gated["app_id"], gated["role_id"], gated[fixed.RAW_ATTRIBUTES_COLUMN]) == (None, "r", None)
    assert "app_id" not in prepared(spark, tmp_path / "in", attributes=False).columns


def test_upsert_keeps_history_and_absent_attributes(spark, tmp_path):
    store = EventStore(spark, str(tmp_path / "store"))
    land(tmp_path / "a", 0, [
        {"id": "1", "eventDate": 1705312200000, "message": "old", "additionalAttributes": {"appId": "a", "kept": "k"}},
        {"id": "2", "eventDate": 1705312200000, "message": "stays"},
    ])
    land(tmp_path / "b", 1, [
        {"id": "1", "eventDate": 1705312200000, "message": "first", "additionalAttributes": {"appId": "z"}},
        {"id": "1", "eventDate": 1705400000000, "message": "last", "additionalAttributes": {"pageId": "p"}},
        {"id": "3", "eventDate": 1705312200000, "message": "new"},
    ])
    assert store.load(prepared(spark, tmp_path / "a")) == 2
    assert store.load(prepared(spark, tmp_path / "b")) == 3
    rows = by_id(store.table.read(), "message", "attrs", "app_id", "page_id")
    # appId occurs in the second batch, so the last row's lack of it overwrites;
    # "kept" occurs nowhere in it and stays.
    assert rows["1"] == ("last", {"kept": "k", "pageId": "p"}, None, "p")
    assert rows["2"][0] == "stays" and rows["3"][0] == "new" and len(rows) == 3
    assert set(store.table.version().parts) == {"2024-01-15", "2024-01-16"}


def test_upsert_is_idempotent_and_moves_a_row_between_days(spark, tmp_path):
    store = EventStore(spark, str(tmp_path / "store"))
    land(tmp_path / "a", 0, [{"id": str(i), "eventDate": 86_400_000 * i} for i in range(5)])
    land(tmp_path / "b", 1, [{"id": "3", "eventDate": 0}])
    for folder in ("a", "b", "a", "b"):
        store.load(prepared(spark, tmp_path / folder))
    dates = by_id(store.table.read(), "eventDate")
    assert dates == {"0": 0, "1": 86_400_000, "2": 172_800_000, "3": 0, "4": 345_600_000}


def test_an_untouched_day_is_not_rewritten(spark, tmp_path):
    store = EventStore(spark, str(tmp_path / "store"))
    land(tmp_path / "a", 0, [{"id": str(i), "eventDate": 86_400_000 * i} for i in range(3)])
    land(tmp_path / "b", 1, [{"id": "1", "eventDate": 86_400_000}])
    store.load(prepared(spark, tmp_path / "a"))
    before = store.table.version().parts
    store.load(prepared(spark, tmp_path / "b"))
    after = store.table.version().parts
    assert before["1970-01-01"] == after["1970-01-01"] and before["1970-01-02"] != after["1970-01-02"]


def test_one_hot_id_collapses(spark, tmp_path):
    land(tmp_path / "in", 0, [{"id": None if i % 3 else i, "message": str(i)} for i in range(3000)])
    store = EventStore(spark, str(tmp_path / "store"))
    store.load(prepared(spark, tmp_path / "in"))
    rows = by_id(store.table.read(), "message")
    assert len(rows) == 1001 and rows[""] == "2999"


@pytest.mark.parametrize("files_per_batch", [1, 2, None])
def test_stream_equals_batch(spark, tmp_path, files_per_batch):
    for page in range(4):
        land(tmp_path / "in", page, [
            {"id": (i * 7 + page) % 11, "eventDate": 1705312200000 + page, "message": f"{page}/{i}"} for i in range(6)
        ])
    batch = EventStore(spark, str(tmp_path / "batch"))
    batch.load(prepared(spark, tmp_path / "in"))
    stream = EventStore(spark, str(tmp_path / "stream"))
    for _ in range(2):
        query = ingest(spark, str(tmp_path / "in"), stream, str(tmp_path / "check"), files_per_batch=files_per_batch)
        query.awaitTermination()
        assert query.exception() is None
    assert by_id(stream.table.read(), "message") == by_id(batch.table.read(), "message")


def test_purge_events(spark, tmp_path):
    store = EventStore(spark, str(tmp_path / "store"))
    now = datetime(2025, 6, 1, 12, tzinfo=UTC)
    cutoff = int(datetime(2024, 6, 1, 12, tzinfo=UTC).timestamp() * 1000)
    land(tmp_path / "in", 0, [{"id": str(d), "eventDate": cutoff + d} for d in (-90_000_000, -1, 0, 1, 90_000_000)])
    store.load(prepared(spark, tmp_path / "in"))
    assert store.purge(now, 0) == 0
    assert store.purge(now, 1) == 2
    assert set(by_id(store.table.read(), "id")) == {"0", "1", "90000000"}
    assert store.purge(now, 1) == 0
    assert EventStore(spark, str(tmp_path / "none")).purge(now, 1) == 0


def test_backfill(spark, tmp_path):
    store = EventStore(spark, str(tmp_path / "store"))
    assert store.backfill().scanned == 0
    land(tmp_path / "in", 0, [
        {"id": "1", "eventDate": 10, "additionalAttributes": {"appId": "a", "blank": "", "other": 5}},
        {"id": "2", "eventDate": 20, "additionalAttributes": {"roleId": "r"}},
        {"id": "3", "eventDate": 30},
    ])
    store.load(prepared(spark, tmp_path / "in", attributes=False))
    dry = store.backfill(dry_run=True)
    assert (dry.scanned, dry.updated, dry.skipped) == (3, 2, 1)
    assert store.backfill(since_ms=15, limit=1).updated == 1
    rows = by_id(store.table.read(), "app_id", "role_id", fixed.RAW_ATTRIBUTES_COLUMN)
    assert rows["2"] == (None, "r", '{"roleId":"r"}') and rows["1"] == (None, None, None)
    full = store.backfill(categories=["role"])
    assert (full.scanned, full.updated, full.skipped) == (2, 1, 1)
    rows = by_id(store.table.read(), "app_id", fixed.RAW_ATTRIBUTES_COLUMN, "eventDate", "attrs")
    assert rows["1"] == (None, '{"appId":"a","other":"5"}', 10, {"appId": "a", "blank": "", "other": "5"})
    again = store.backfill()
    assert (again.updated, again.skipped) == (0, 1)


def test_run_state(spark, tmp_path):
    store = EventStore(spark, str(tmp_path / "store"))
    assert store.last_run() == 0
    store.finish_run(1736951400, 12)
    store.finish_run(1736951500, 3)
    assert store.last_run() == 1736951500
    log = {r["batch_code"]: (r["logged_at"], r["records_loaded"]) for r in store.run_log.read().collect()}
    assert log == {"1736951400": ("2025-01-15T14:30:00Z", 12), "1736951500": ("2025-01-15T14:31:40Z", 3)}


def test_yield_count(attribute_rows):
    assert attribute_rows.agg(F.count_if(attributes.yields_value())).first()[0] == 3


def test_load_writes_a_batch_without_repeated_ids_once(spark, tmp_path, monkeypatch):
    labels = []
    monkeypatch.setattr(snapshots, "stage", lambda df, label: labels.append(label) or stage(df, label))
    landed = table_checks.landed_events(spark, "/root/testdata/sf0.001")
    store = EventStore(spark, str(tmp_path / "store"))
    n = store.load(prepare_events(landed))
    assert n == store.read().count() == landed.count() and "batch" not in labels
    assert store.load(prepare_events(landed.unionByName(landed.limit(3)))) == n + 3
    assert store.read().count() == n


def test_undeclared_fields_are_opened_without_naming_their_types(spark):
    """The whole type of each value was named again for every question about it."""
    cases = {
        '{"id":"7","a":{"b":{"c":{"d":true}}},"a.b":5.0}': {"a.b.c.d": "1", "a.b": "5"},
        '{"x":"{","y":{"z":"true","w":false}}': {"x": "{", "y.z": "true", "y.w": "0"},
        '{"a":1,"b":true,"s":"false"}': {"a": "1", "b": "1", "s": "false"},
        '{"id":"7"}': None,
    }
    rows = spark.createDataFrame([(i, text) for i, text in enumerate(cases)], "i int, event string")
    opened = attributes.with_other_fields(rows, "event", ["id"])
    assert [r["other"] for r in opened.orderBy("i").collect()] == list(cases.values())
    plan = opened._jdf.queryExecution().optimizedPlan().toString()
    assert "schema_of_variant" not in plan.lower() and "schemaofvariant" not in plan.lower()
