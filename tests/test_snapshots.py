"""What a version holds: columns, zones, key index; and several tables in one commit."""

import json

import pytest
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.plans.events import EventStore, prepare_events
from tidemark.plans.history import HistoryStore
from tidemark.session import empty_table
from tidemark.sources import paths
from tidemark.sources.pages import read_pages
from tidemark.sources.snapshots import SnapshotGroup, SnapshotTable, by_bucket, by_bucket_and_year

SCHEMA = "k long, day string, v string"


def by_day_text():
    return F.col("day")


def indexed(spark, path, index_rows=50):
    return SnapshotTable(spark, str(path), spark.createDataFrame([], SCHEMA).schema, "k", by_day_text, index_rows=index_rows)


def content(table, *columns):
    rows = table.read()
    return sorted(tuple(r) for r in (rows.select(*columns) if columns else rows).collect())


# -- columns ------------------------------------------------------------------


def test_columns_that_a_batch_adds_stay(spark, tmp_path):
    table = SnapshotTable(spark, str(tmp_path / "t"), spark.createDataFrame([], "k int, v string").schema, "k", by_bucket("k", 2))
    table.upsert(spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string"))
    table.upsert(spark.createDataFrame([(2, "c", 7)], "k int, v string, extra long"), evolve=True)
    table.upsert(spark.createDataFrame([(1, "d"), (3, "e")], "k int, v string"))
    assert content(table) == [(1, "d", None), (2, "c", 7), (3, "e", None)]
    assert table.read(1).columns == ["k", "v"] and table.read(2).columns == ["k", "v", "extra"]
    # A reopened table knows them, and a stored type stays.
    again = SnapshotTable(spark, str(tmp_path / "t"), spark.createDataFrame([], "k int, v string").schema, "k", by_bucket("k", 2))
    again.upsert(spark.createDataFrame([(9, "f", "12", "n")], "k int, v string, extra string, more string"), evolve=True)
    assert again.columns()["extra"].dataType.simpleString() == "bigint"
    assert content(again) == [(1, "d", None, None), (2, "c", 7, None), (3, "e", None, None), (9, "f", 12, "n")]
    again.upsert(spark.createDataFrame([(9, "g", "left out")], "k int, v string, unknown string"))
    assert again.read().columns == ["k", "v", "extra", "more"]
    again.keep_where(F.col("k") > 1)
    assert content(again, "k", "extra") == [(2, 7), (3, None), (9, 12)]


def land(folder, number, events):
    folder.mkdir(exist_ok=True)
    (folder / f"page-{number:03d}.json").write_text(json.dumps({"response": events}) + "\n")
    return str(folder / f"page-{number:03d}.json")


def test_undeclared_event_fields_survive(spark, tmp_path):
    store = EventStore(spark, str(tmp_path / "store"))
    batches = [
        [{"id": "1", "message": "a"}, {"id": "2", "message": "b"}],
        [{"id": "2", "message": "c", "region": "eu", "context": {"device": {"os": "x"}, "beta": True}, "App_Id": 5},
         {"id": "3", "region": None, "tags": [1, {"a": 2}], "additionalAttributes": {"appId": "k"}}],
        [{"id": "2", "message": "d"}, {"id": "4", "message": "e"}],
        [{"id": "3", "region": "us"}],
    ]
    for i, events in enumerate(batches):
        store.load(prepare_events(read_pages(spark, land(tmp_path / "in", i, events), "events")))
    assert store.fields(1) == [] and "region" not in store.read(1).columns
    assert store.fields() == ["App_Id", "context.beta", "context.device.os", "region", "tags"]
    rows = {r["id"]: r for r in store.read().collect()}
    assert (rows["2"]["message"], rows["2"]["region"], rows["2"]["context.device.os"], rows["2"]["context.beta"]) == ("d", "eu", "x", "1")
    assert (rows["2"]["other.App_Id"], rows["2"]["app_id"]) == ("5", None)
    assert (rows["3"]["region"], rows["3"]["tags"], rows["1"]["region"], rows["4"]["region"]) == ("us", '[1,{"a":2}]', None, None)


def test_an_event_that_is_no_object_fails(spark, tmp_path):
    path = land(tmp_path / "in", 0, [{"id": "1"}, 5])
    with pytest.raises(Exception, match="no event object"):
        read_pages(spark, path, "events").collect()


# -- key index ----------------------------------------------------------------


def test_index_reads_only_the_buckets_of_the_batch(spark, tmp_path):
    table = indexed(spark, tmp_path / "t", index_rows=200)
    rows = [(i, f"d{i % 5}", "a") for i in range(10_000)]
    table.upsert(spark.createDataFrame(rows, SCHEMA))
    assert table.version().index["bits"] == 6 and table.version().index["rows"] == 10_000
    for n in (1, 10):
        table.upsert(spark.createDataFrame([(i, f"d{i % 5}", f"b{n}") for i in range(n)], SCHEMA))
        assert table.last["index_buckets_read"] <= n and table.last["index_rows_read"] < 300 * n
        assert table.last["parts_read"] == min(n, 5)
    assert table.version().index["rows"] == 10_000
    assert content(table) == sorted([(i, f"d{i % 5}", "b10") for i in range(10)] + rows[10:])


def test_keys_that_move_or_went_are_found(spark, tmp_path):
    """Random batches that move keys between parts, with purges, equal a dictionary."""
    import random

    rng = random.Random(4)
    table, held = indexed(spark, tmp_path / "t", index_rows=15), {}
    for step in range(9):
        if step % 4 == 3:
            gone = f"d{rng.randrange(4)}"
            table.keep_where(F.col("day") != gone)
            held = {k: v for k, v in held.items() if v[0] != gone}
            continue
        keys = rng.sample(range(120), rng.randint(20, 60))
        batch = {k: (f"d{rng.randrange(4)}", f"s{step}") for k in keys}
        table.upsert(spark.createDataFrame([(k, *v) for k, v in batch.items()], SCHEMA))
        held |= batch
        assert content(table) == sorted((k, *v) for k, v in held.items()), step
    index = table.version().index
    assert index["bits"] >= 2 and max(len(f) for f in index["buckets"].values()) <= 9
    table.keep_where(F.lit(False))
    table.upsert(spark.createDataFrame([(1, "d1", "new")], SCHEMA))
    assert content(table) == [(1, "d1", "new")]


def test_empty_batches_and_tables(spark, tmp_path):
    schema = spark.createDataFrame([], SCHEMA).schema
    table = indexed(spark, tmp_path / "t")
    table.replace(empty_table(spark, schema))
    table.upsert(empty_table(spark, schema))
    assert content(table) == [] and table.last["rows_written"] == 0
    table.upsert(spark.createDataFrame([(1, "d", "a")], SCHEMA))
    table.upsert(empty_table(spark, schema))
    assert content(table) == [(1, "d", "a")]


# -- zones --------------------------------------------------------------------


def test_purge_reads_only_parts_that_the_cutoff_divides(spark, tmp_path):
    schema = spark.createDataFrame([], "k long, m string, date string").schema
    table = SnapshotTable(spark, str(tmp_path / "t"), schema, "k", by_bucket_and_year("m", 2, "date"), moves=False, zone="date")
    rows = [(i, f"m{i % 7}", f"{2018 + i % 6}-{1 + i % 12:02d}-01") for i in range(600)] + [(1000, "m1", None), (1001, "m1", "unknown"), (1002, "m2", "2019")]
    table.replace(spark.createDataFrame(rows, schema))
    assert all(len(z) == 4 for z in table.version().zones.values())
    kept = [r for r in rows if r[2] is None or r[2] >= "2021-06-01"]
    deleted = table.keep_where(F.coalesce(F.col("date") >= "2021-06-01", F.lit(True)), least="2021-06-01")
    assert deleted == len(rows) - len(kept) and content(table, "k") == sorted((r[0],) for r in kept)
    assert table.last["parts_read"] == 2 and table.last["parts_dropped"] == 6
    assert table.keep_where(F.coalesce(F.col("date") >= "2021-06-01", F.lit(True)), least="2021-06-01") == 0
    assert table.last["parts_read"] == 0
    # A table whose key keeps its part is asked in the parts of the batch alone.
    table.upsert(spark.createDataFrame([(3, "m3", "2021-07-01")], schema))
    assert table.last["parts_read"] == 1


# -- commits ------------------------------------------------------------------


def test_tables_of_a_group_change_together(spark, tmp_path):
    group = SnapshotGroup(spark, str(tmp_path / "g"))
    schema = spark.createDataFrame([], "k int, v string").schema
    tables = [SnapshotTable(spark, str(tmp_path / "g" / n), schema, "k", group=group) for n in "abcd"]
    row = lambda v: spark.createDataFrame([(1, v)], schema)
    with group.transaction():
        for t in tables:
            t.upsert(row("one"))
        assert content(tables[0]) == [(1, "one")]
    before = [content(t) for t in tables]
    with pytest.raises(ZeroDivisionError):
        with group.transaction():
            tables[0].upsert(row("two"))
            tables[1].replace(row("two"))
            tables[2].upsert(row("two").withColumn("v", F.lit(str(1 / 0))))
            tables[3].upsert(row("two"))
    assert [content(t) for t in tables] == before and [t.version_numbers() for t in tables] == [[1]] * 4
    with group.transaction():
        tables[0].upsert(row("three"))
    assert [content(t)[0][1] for t in tables] == ["three", "one", "one", "one"]
    # The versions of the failed commit belong to nobody and go by age.
    assert tables[0].stored_numbers() == [1, 2, 3]
    assert group.vacuum(3600) == {n: [] for n in "abcd"}
    assert {n: len(v) for n, v in group.vacuum(-1).items()} == {"a": 1, "b": 1, "c": 0, "d": 0}
    assert tables[0].stored_numbers() == [1, 3] and [content(t)[0][1] for t in tables] == ["three", "one", "one", "one"]
    assert group.rotate(1) == [1] and tables[0].version_numbers() == [3] and content(tables[1]) == [(1, "one")]


def test_a_second_writer_of_a_group_fails(spark, tmp_path):
    schema = spark.createDataFrame([], "k int, v string").schema
    groups = [SnapshotGroup(spark, str(tmp_path / "g")) for _ in range(2)]
    first, second = (SnapshotTable(spark, str(tmp_path / "g/a"), schema, "k", group=g) for g in groups)
    with pytest.raises(paths.AlreadyThere):
        with groups[0].transaction():
            first.upsert(spark.createDataFrame([(1, "late")], schema))
            second.upsert(spark.createDataFrame([(1, "early")], schema))
    assert content(first) == content(second) == [(1, "early")]


def test_an_upsert_that_loses_the_race_starts_again(spark, tmp_path):
    schema = spark.createDataFrame([], "k int, v string").schema
    table, other = (SnapshotTable(spark, str(tmp_path / "t"), schema, "k") for _ in range(2))
    table.upsert(spark.createDataFrame([(1, "a")], schema))
    write, raced = table._write, []

    def slow(rows, columns):
        if not raced:
            raced.append(other.upsert(spark.createDataFrame([(2, "b")], schema)))
        return write(rows, columns)

    table._write = slow
    table.upsert(spark.createDataFrame([(3, "c")], schema))
    assert content(table) == [(1, "a"), (2, "b"), (3, "c")] and table.version_numbers() == [1, 2, 3]
    assert len(table.vacuum(-1)) == 1 and content(table) == [(1, "a"), (2, "b"), (3, "c")]


def test_history_that_fails_midway_changes_no_table(spark, tmp_path, monkeypatch):
    store = HistoryStore(spark, str(tmp_path / "h"))
    rows = spark.createDataFrame([tuple(f"{c}1" for c in schemas.HISTORY.names)], schemas.HISTORY)
    named = spark.createDataFrame([("m", "n", "w", "wn", "T1")], schemas.REGISTRY)
    store.load(rows, named, "T1")

    def full(*_, **__):
        raise OSError("disk full")

    monkeypatch.setattr(store.normalized, "_write", full)
    with pytest.raises(OSError, match="disk full"):
        store.load(rows.withColumn("record_id", F.lit("new")), named.withColumn("last_synced_at", F.lit("T2")), "T2")
    assert store.registry.read().first()["last_synced_at"] == "T1"
    assert [t.read().count() for t in (store.list, store.normalized)] == [1, 1]


# -- run metrics --------------------------------------------------------------


def test_counts_of_a_run(spark, tmp_path):
    store = EventStore(spark, str(tmp_path / "store"))
    events = [{"id": "1", "eventDate": 5, "additionalAttributes": {"appId": "a"}}, {"id": "1", "eventDate": 6}, {"eventDate": 7},
              {"id": "2", "new": 1, "additionalAttributes": {"zzz": "no column"}}]
    assert store.load(prepare_events(read_pages(spark, land(tmp_path / "in", 0, events), "events"))) == 4
    store.finish_run(1700000000, 4)
    got = {(r["step"], r["metric"]): r["value"] for r in store.run_metrics.read().where("batch_code = '1700000000'").collect()}
    assert got == {("load", m): n for m, n in {
        "rows_in": 4, "without_id": 1, "without_date": 1, "with_attributes": 2, "with_values": 1, "with_other_fields": 1, "rows_written": 3}.items()}
    assert not store.steps
