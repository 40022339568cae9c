"""Operators against brute force on small inputs, and their plans."""

import random

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tidemark import fixed, schemas
from tidemark.functions import taxonomy, text
from tidemark.operators import catalog, joins, lists, normalize, ordinals, retention, unmatched, upsert
from tidemark.session import empty_table, literal_table, stage
from tidemark.sources import paths
from tidemark.sources.snapshots import SnapshotTable, Version, by_bucket
from tidemark.sources.tables import read_catalog


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


# -- names --------------------------------------------------------------------


def names_by_hand(rows, limit=60):
    """Go through the rows in order, remembering every name handed out."""
    taken, out = set(), {}
    for position, code, message in sorted(rows):
        wanted = (message or "").strip()
        name = wanted if wanted and len(wanted) <= limit and wanted not in taken else code
        taken.add(name)
        out[position] = name
    return out


@pytest.mark.parametrize("seed", range(6))
def test_names_with_codes_that_equal_messages(spark, seed):
    rng = random.Random(seed)
    words = [f"c{i}" for i in range(12)] + ["  c3 ", "", None, "x" * 61, "free"]
    codes = [f"c{i}" for i in range(12)] + [f"u{i}" for i in range(28)]
    rng.shuffle(codes)
    rows = [(i, code, rng.choice(words)) for i, code in enumerate(codes)]
    df = spark.createDataFrame(rows, "position long, code string, message string")
    got = {r["position"]: r["Event Name"] for r in catalog.assign_names(df, "code", "message", "position").collect()}
    assert got == names_by_hand(rows)


def test_name_chain(spark):
    # Row 1 falls back to its code b, which takes the name of row 2, whose code
    # c then takes the name of row 3, and so on.
    rows = [(0, "a", "same"), (1, "b", "same"), (2, "c", "b"), (3, "d", "c"), (4, "e", "d"), (5, "f", "zzz")]
    df = spark.createDataFrame(rows, "position long, code string, message string")
    got = {r["position"]: r["Event Name"] for r in catalog.assign_names(df, "code", "message", "position").collect()}
    assert got == names_by_hand(rows) == {0: "same", 1: "b", 2: "c", 3: "d", 4: "e", 5: "zzz"}


def test_catalog_file_completed(spark, tmp_path):
    (tmp_path / "codes.csv").write_text(
        'Event Code,Event Message,Associated Object ID,Notes\nUSR-9,"Said ""no"", left",The id,--\nUSR-10,Login,,\n')
    listed = read_catalog(spark, str(tmp_path / "codes.csv"))
    events = spark.createDataFrame([("ZZ-2",), ("USR-9",), ("WF-1",), ("",), (None,), ("ZZ-2",)], "eventTypeId string")
    full = catalog.with_catalog_columns(catalog.complete_catalog(listed, events)).orderBy("position").collect()
    assert [(r["Event Code"], r["Parent Code"], r["Parent"], r["Event Name"]) for r in full] == [
        ("USR-9", "USR", "USER ACTIVITY", 'Said "no", left'), ("USR-10", "USR", "USER ACTIVITY", "Login"),
        ("WF-1", "WF", "WORKFLOW", "WF-1"), ("ZZ-2", "UNCAT", "UNCATEGORIZED", "ZZ-2"),
    ]
    alone = catalog.with_catalog_columns(catalog.complete_catalog(listed, None))
    assert alone.count() == 2


@pytest.mark.parametrize(("code", "parent"), [
    ("USR-8", "USER ACTIVITY"), ("dsm-DAO0071I", "ENCRYPTION ACTIVITY"), (" wf -1-2", "WORKFLOW"), ("\tINT\n", "INTEGRATION"),
    ("", "UNCATEGORIZED"), (None, "UNCATEGORIZED"), ("-USR", "UNCATEGORIZED"), ("XYZ-1", "UNCATEGORIZED"), ("COMMENT", "COMMENT"),
])
def test_taxonomy(spark, code, parent):
    df = spark.createDataFrame([(code,)], "code string")
    taxonomy.register_sql_functions(spark)
    row = df.select(taxonomy.event_parent_name(F.col("code")).alias("a"), F.expr("event_parent_name(code)").alias("b")).first()
    assert row["a"] == row["b"] == parent


def test_category_seed(spark):
    rows = taxonomy.category_seed(spark).collect()
    assert [r["Code"] for r in rows] == fixed.CATEGORY_LIST_ORDER
    assert {r["Parent"] for r in rows} == {"All Events"}


# -- ordinals -----------------------------------------------------------------


def test_number_rows(spark):
    n = 20000
    keys = list(range(n))
    random.Random(1).shuffle(keys)
    df = spark.createDataFrame([(k, "hot" if k % 3 else str(k)) for k in keys], "k long, g string")
    numbered = ordinals.number_rows(df.repartition(16), [F.desc("k")], "n", start=5)
    assert {r["k"]: r["n"] for r in numbered.collect()} == {k: n - 1 - k + 5 for k in range(n)}
    assert ordinals.number_rows(df.where("k < 0"), ["k"], "n").count() == 0


# -- joins --------------------------------------------------------------------


def test_lookup_keeps_every_match_and_null_keys(spark):
    facts = spark.createDataFrame([(i, None if i % 3 else f"k{i % 4}") for i in range(60)], "id long, key string")
    side = spark.createDataFrame([("K0", "a"), ("k0", "b"), ("k2", "c"), (None, "d")], "id string, name string")
    expected = []
    for r in facts.collect():
        hits = [d["name"] for d in side.collect() if r["key"] and d["id"] and d["id"].upper() == r["key"].upper()]
        expected += [(r["id"], h) for h in hits or [None]]
    for threshold in ("10485760", "-1"):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
        try:
            out = joins.lookup(facts, side, F.upper("key"), F.upper("id"), {"name": "found"}, F.col("id"))
            assert sorted(((r["id"], r["found"]) for r in out.collect()), key=repr) == sorted(expected, key=repr)
        finally:
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10485760")
    assert {tuple(r) for r in joins.duplicate_keys(side, F.upper("id")).collect()} == {("K0", 2)}


def test_null_keys_are_spread(spark):
    facts = spark.range(40000).select("id", F.when(F.col("id") % 100 == 0, F.lit("k")).alias("key"))
    side = spark.createDataFrame([("k", "x")], "id string, name string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        out = joins.lookup(facts, side, F.col("key"), F.col("id"), {"name": "found"}, F.col("id"))
        sizes = [r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10485760")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert len(sizes) == 8 and max(sizes) < 40000 / 8 * 1.5


def test_name_or_id(spark):
    names = spark.createDataFrame([("a", "Alpha")], "id string, name string")
    out = joins.name_or_id(spark.createDataFrame([("a",), ("b",)], "ref string"), names, "ref", "label")
    assert {r["ref"]: r["label"] for r in out.collect()} == {"a": "Alpha", "b": "b"}


# -- upsert -------------------------------------------------------------------


@pytest.mark.parametrize("policy", ["replace", "insert", "refresh", "older"])
@pytest.mark.parametrize("probed", [False, True])
def test_merge_against_dicts(spark, policy, probed):
    rng = random.Random(3)
    old = {k: (rng.randint(0, 9), rng.choice("xy"), None if rng.random() < 0.2 else "o") for k in rng.sample(range(60), 35)}
    new = {k: (rng.randint(0, 9), None if rng.random() < 0.3 else rng.choice("pq")) for k in rng.sample(range(60), 35)}
    current = spark.createDataFrame([(k, *v) for k, v in old.items()], "k int, ord int, a string, b string")
    batch = spark.createDataFrame([(k, *v) for k, v in new.items()], "k int, ord int, a string")
    update = {"replace": None, "insert": [], "refresh": ["a"], "older": None}[policy]
    matched = current.join(batch.select("k"), "k", "left_semi").select("k") if probed else None
    out = upsert.merge_rows(current, batch, "k", update=update, not_older="ord" if policy == "older" else None, matched=matched)

    expected = {k: list(v) for k, v in old.items()}
    for k, (order, a) in new.items():
        if k not in old:
            expected[k] = [order, a, None]
        elif policy == "replace" or (policy == "older" and order >= old[k][0]):
            expected[k][:2] = [order, a]
        elif policy == "refresh":
            expected[k][1] = a
    assert {r["k"]: [r["ord"], r["a"], r["b"]] for r in out.collect()} == expected


def test_last_wins_reduces_before_the_shuffle(spark):
    df = spark.range(10000).select((F.col("id") % 3).alias("k"), "id")
    out = upsert.last_wins(df, "k", ["id"])
    assert "WindowGroupLimit" in plan(out)
    assert {r["k"]: r["id"] for r in out.collect()} == {0: 9999, 1: 9997, 2: 9998}


def test_new_columns_are_added_and_absent_ones_kept(spark):
    current = spark.createDataFrame([(1, "a")], "k int, x string")
    batch = spark.createDataFrame([(1, 5), (2, 6)], "k int, y int")
    out = upsert.merge_rows(current, batch, "k")
    assert out.columns == ["k", "x", "y"]
    assert {tuple(r) for r in out.collect()} == {(1, "a", 5), (2, None, 6)}


def test_unmatched_report_keeps_first_sighting(spark):
    first = spark.createDataFrame([("a", 3), ("b", 1)], "description string, occurrences long")
    second = spark.createDataFrame([("b", 7), ("c", 7)], "description string, occurrences long")
    stored = unmatched.merge_unmatched(empty_table(spark, schemas.UNMATCHED), first, "T1")
    stored = unmatched.merge_unmatched(stored, second, "T2")
    assert [tuple(r) for r in unmatched.unmatched_report(stored).collect()] == [
        ("b", 7, "T1", "T2"), ("c", 7, "T2", "T2"), ("a", 3, "T1", "T1")]
    assert unmatched.unmatched_report(stored, head=1).count() == 1
    assert unmatched.unmatched_report(stored, head=None, latest_only=True).count() == 2


# -- snapshots ----------------------------------------------------------------


def test_snapshot_versions_and_rotation(spark, tmp_path):
    schema = spark.createDataFrame([], "k int, v string").schema
    table = SnapshotTable(spark, str(tmp_path / "t"), schema, "k", by_bucket("k", 4))
    assert not table.exists() and table.read().count() == 0 and table.rotate(1) == []
    table.upsert(spark.createDataFrame([(i, "a") for i in range(20)], schema))
    table.upsert(spark.createDataFrame([(3, "b"), (99, "b")], schema), properties={"schema_version": "2"})
    table.keep_where(F.col("k") != 4)
    assert {r["k"]: r["v"] for r in table.read(1).collect()} == {i: "a" for i in range(20)}
    now = {r["k"]: r["v"] for r in table.read().collect()}
    assert now == {**{i: "a" for i in range(20) if i not in (3, 4)}, 3: "b", 99: "b"}
    assert table.version().properties == {"schema_version": "2"}
    assert table.rotate(0) == [] and table.rotate(2) == [1]
    assert table.version_numbers() == [2, 3] and {r["k"]: r["v"] for r in table.read().collect()} == now
    held = {f for n in (2, 3) for fs in table.version(n).parts.values() for f in fs}
    left = {f"{p.parent.name}/{p.name}" for p in (tmp_path / "t/data").glob("*/_part=*")}
    assert left == held


def test_two_writers_cannot_both_commit(spark, tmp_path):
    schema = spark.createDataFrame([], "k int").schema
    table = SnapshotTable(spark, str(tmp_path / "t"), schema, "k")
    base = table.version()
    table._commit(base, Version())
    with pytest.raises(paths.AlreadyThere, match="exists"):
        table._commit(base, Version())


# -- lists and scope ----------------------------------------------------------


def test_lists_drop_blank_parts_and_follow_categories(spark):
    columns = list(fixed.ATTRIBUTE_COLUMNS.values())
    rows = [{"app_id": "a", "app_name": "A", "page_id": "p", "page_name": "P"}, {"app_id": "a", "app_name": "A"},
            {"app_id": "a", "app_name": "B"}, {"app_id": "", "app_name": "A", "page_id": "p", "page_name": "P"},
            {"app_id": "z", "app_name": ""}, {"role_id": "r", "role_name": "R"}]
    df = spark.createDataFrame([[r.get(c) for c in columns] for r in rows], schemas._strings(*columns))
    made = lists.attribute_lists(df)
    assert set(made) == set(fixed.ATTRIBUTE_LISTS)
    assert {tuple(r) for r in made["ux_app"].collect()} == {("a", "A"), ("a", "B")}
    assert [tuple(r) for r in made["ux_page"].collect()] == [("p", "P", "a")]
    assert made["ux_page"].columns == ["code", "name", "parent_code"]
    assert set(lists.attribute_lists(df, ["role", "none"])) == {"role"}


def test_resolve_names(spark):
    known = spark.createDataFrame([("1", "Plan", 0), ("2", "plan", 1), ("3", "Plan", 2), ("Plan2", "x", 3)], "id string, name string, position int")
    refs = spark.createDataFrame([("1",), ("Plan",), ("plan",), ("PLAN",), ("Plan2",), ("gone",)], "ref string")
    out = lists.resolve_names(refs, known, "ref", "id_out")
    assert {r["ref"]: r["id_out"] for r in out.collect()} == {"1": "1", "Plan": "3", "plan": "2", "PLAN": "3", "Plan2": "Plan2", "gone": None}
    with pytest.raises(PySparkException, match="gone"):
        lists.require_resolved(out, "ref", "id_out").collect()
    inside = spark.createDataFrame([("w1", "m")], "ws string, ref string")
    per = spark.createDataFrame([("w1", "a", "M", 0), ("w2", "b", "m", 1)], "ws string, id string, name string, position int")
    assert lists.resolve_names(inside, per, "ref", "o", within=["ws"]).first()["o"] == "a"


def test_missing_items_checks_codes_and_names(spark):
    seen = lists.observed_values(spark.createDataFrame([("a",), ("b",), ("c",), ("",), (None,), ("a",)], "x string"), "x")
    existing = spark.createDataFrame([("a", "zz"), (None, "b"), ("", "")], "code string, name string")
    assert [tuple(r) for r in lists.missing_items(seen, existing).collect()] == [("c", "c")]


# -- shaping and retention ----------------------------------------------------


def test_metadata_shapes(spark):
    shaped = normalize.to_schema(spark.createDataFrame([("m", 5)], "id string, memoryUsage int"), schemas.MODELS)
    assert shaped.schema.fieldNames() == schemas.MODELS.fieldNames() and shaped.first()["memoryUsage"] == 5
    assert normalize.to_schema(empty_table(spark, schemas.USERS), schemas.USERS).count() == 0
    kept = normalize.to_schema(spark.createDataFrame([("m", 1)], "id string, extra int"), schemas.USERS, keep_extra=True)
    assert kept.columns[-1] == "extra"


def test_models_export_keeps_models_without_a_known_modifier(spark):
    models = normalize.to_schema(spark.createDataFrame([("m1", "u1"), ("m2", "gone")], "id string, lastModifiedByUserGuid string"), schemas.MODELS)
    users = spark.createDataFrame([("u1", "a@x", "Ann")], "id string, userName string, displayName string")
    out = lists.models_with_modifier(models, users)
    assert len(out.columns) == 13 and out.columns[9:11] == ["lastModifiedByEmail", "lastModifiedByDisplayName"]
    assert {r["id"]: r["lastModifiedByEmail"] for r in out.collect()} == {"m1": "a@x", "m2": None}


def test_retention_text_and_time(spark):
    rows = [("2025-01-15 14:22:31",), ("2025-01-15T14:22:31+00:00",), ("2025-01-14 23:00:00",), ("2025-01-16 00:00:00",), ("odd",), (None,)]
    df = spark.createDataFrame(rows, "d string")
    cutoff = "2025-01-15T10:00:00+00:00"
    by_text = {r["d"] for r in df.where(retention.kept_by_text("d", cutoff)).collect()}
    assert by_text == {"2025-01-15T14:22:31+00:00", "2025-01-16 00:00:00", "odd", None}
    by_time = {r["d"] for r in df.where(retention.kept_by_time("d", cutoff)).collect()}
    assert by_time == by_text | {"2025-01-15 14:22:31"}


def test_load_id_and_dates(spark):
    df = spark.createDataFrame([(1736951000999, 1), (-1500, 1234567890), (0, None)], "ms long, i long")
    got = [tuple(r) for r in df.select(text.load_id(F.col("ms"), F.col("i")), text.epoch_ms_text(F.col("ms"))).collect()]
    assert got == [("1736951000000000001", "2025-01-15 14:23:20"), ("-1123456789", "1969-12-31 23:59:58"), (None, "1970-01-01 00:00:00")]


def test_small_tables_are_known_to_be_small(spark):
    facts = spark.range(1000).withColumn("k", F.col("id").cast("string"))
    for side in (empty_table(spark, schemas.USERS), literal_table(spark, [("1", "a", "b", "c", "d")], schemas.USERS)):
        joined = joins.lookup(facts, side, F.col("k"), F.col("id"), {"userName": "n"}, F.col("id"))
        assert "SortMergeJoin" not in plan(joined)
        assert joined.count() == 1000


def test_patterns_must_work_in_the_jvm(spark):
    from tidemark.functions.rules import build_rules

    row = {"priority": "1", "object_type": "Other", "change_type": "Edit"}
    assert build_rules([row | {"pattern": "(?P<n>x)"}]) == []
    assert build_rules([row | {"pattern": "x", "change_type": "Edlt"}]) == []
    assert len(build_rules([row | {"pattern": "x"}])) == 1


def test_blank_keys_are_spread_and_still_match(spark):
    from pyspark.sql import functions as F

    from tidemark.operators.joins import lookup

    facts = spark.createDataFrame([(i, "") for i in range(50)] + [(50, "a"), (51, None)], "id long, k string")
    for dims, names in (([("", "blank"), ("a", "A")], {"blank": 50, "A": 1, None: 1}), ([("a", "A")], {"A": 1, None: 51})):
        side = spark.createDataFrame(dims, "k string, name string")
        out = lookup(facts, side, F.col("k"), F.col("k"), {"name": "name"}, spread_by=F.col("id"))
        assert {r["name"]: r["count"] for r in out.groupBy("name").count().collect()} == names


@pytest.mark.parametrize("copies", [0, 1, 40])
def test_one_per_key_ranks_only_repeated_keys(spark, copies):
    """A batch without repeated keys is given back as it is staged; else the rows are those of last_wins."""
    rows = [(f"k{i}", i) for i in range(100)] + [(None, 1)] + [(f"k{i}", 1000 + i) for i in range(copies)] + [(None, 2)] * bool(copies)
    staged = stage(spark.createDataFrame(rows, "id string, n int"), "test")
    got, same = upsert.one_per_key(staged, "id", ["n"])
    assert same == (copies == 0) and (got is staged) == same
    assert sorted(map(str, got.collect())) == sorted(map(str, upsert.last_wins(staged, "id", ["n"]).collect()))


def test_insert_only_merge_does_not_join_stored_rows(spark):
    current, batch = (spark.createDataFrame(r, "id string, n int") for r in ([("a", 1), ("b", 2)], [("b", 9), ("c", 3)]))
    matched = spark.createDataFrame([("b",)], "id string")
    merged = upsert.merge_rows(current, batch, "id", update=[], matched=matched)
    assert sorted(tuple(r) for r in merged.collect()) == [("a", 1), ("b", 2), ("c", 3)]
    assert merged._jdf.queryExecution().optimizedPlan().toString().count("Join") == 1
