"""Change-history exports: headers, padding, record ids, rules, stores."""

import csv
import hashlib
import io
import re
from datetime import UTC, datetime

import pytest

from tidemark import fixed, schemas
from tidemark.functions import rules, text
from tidemark.plans.history import HistoryStore, history_rows, registry
from tidemark.session import literal_table
from tidemark.sources.exports import delimiter_of, read_exports, resolve_header

CAPTURED = "2025-01-15T14:30:00+00:00"


def land(root, model, content, name="export.csv"):
    folder = root / "workspace_id=w1" / f"model_id={model}"
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text(content)


def resolved(*headers):
    return {t: headers[i] for t, i in resolve_header(list(headers)).items()}


def test_full_header():
    got = resolved("ID", "Date/Time (UTC)", "User", "Description", "Security Change", "Previous Value", "New Value",
                   "Module/List", "Line Item/Property", "SKU", "Target User", "Export", "Import", "Data Types", "Table Name", "Object")
    assert got == {
        "source_record_id": "ID", "date_time_utc": "Date/Time (UTC)", "user": "User", "description": "Description",
        "security_change": "Security Change", "previous_value": "Previous Value", "new_value": "New Value",
        "module_list": "Module/List", "line_item_property": "Line Item/Property", "customer": "SKU",
        "target_user": "Target User", "export": "Export", "import_action": "Import", "data_types": "Data Types",
        "table_name": "Table Name", "object": "Object",
    }


def test_short_and_unknown_headers():
    assert resolved("DATE_TIME_UTC", "USER", "DESCRIPTION") == {
        "date_time_utc": "DATE_TIME_UTC", "user": "USER", "description": "DESCRIPTION"}
    got = resolved("date_time_utc", "user", "description", "Modified", "Zone", "Grid")
    assert got["module_list"] == "Modified" and "source_record_id" not in got
    # A repeated header reads its first occurrence.
    assert resolve_header(["user", "description", "USER"])["module_list"] == 0
    assert delimiter_of("a\tb,c") == "\t" and delimiter_of("a,b") == ","


def expected_id(model, date, user, description, ordinal):
    return hashlib.sha256(f"{model}:{date}:{user}:{description}:{ordinal}".encode()).hexdigest()[:16]


def test_rows_padding_quotes_and_record_ids(spark, tmp_path):
    land(tmp_path, "m1", 'ID\tDate/Time (UTC)\tUser\tDescription\tPrevious Value\n'
                         '7\t2025-01-15 14:22:31\tzoë\tAdd "big" List\told\n\n'
                         '8\t2025-01-15 14:22:32\tben\n'
                         '9\t2025-01-15 14:22:33\tann\tUndo\tx\textra\ttrailing\n', "e.tsv")
    land(tmp_path, "m2", 'date_time_utc,user,description,Area\r\n2025,u,"say ""hi"", x",  pad \r\n2025,u,"say ""hi"", x",\r\n')
    land(tmp_path, "m3", "date_time_utc,user,description\n")
    land(tmp_path, "m4", "")
    rows = read_exports(spark, str(tmp_path), CAPTURED).collect()
    assert all(v is not None for r in rows for v in r)
    got = {r["record_id"]: r for r in rows}
    assert len(got) == 5
    zoe = got[expected_id("m1", "2025-01-15 14:22:31", "zoë", 'Add "big" List', 0)]
    assert (zoe["source_record_id"], zoe["previous_value"], zoe["module_list"], zoe["captured_at"]) == ("7", "old", "", CAPTURED)
    short = got[expected_id("m1", "2025-01-15 14:22:32", "ben", "", 1)]
    assert short["previous_value"] == ""
    assert got[expected_id("m1", "2025-01-15 14:22:33", "ann", "Undo", 2)]["previous_value"] == "x"
    assert got[expected_id("m2", "2025", "u", 'say "hi", x', 0)]["module_list"] == "  pad "
    assert got[expected_id("m2", "2025", "u", 'say "hi", x', 1)]["module_list"] == ""


def test_no_exports_at_all(spark, tmp_path):
    land(tmp_path, "m1", "")
    assert history_rows(spark, str(tmp_path), CAPTURED).collect() == []


def test_ordinals_of_one_file_in_many_splits(spark, tmp_path):
    n = 5000
    land(tmp_path, "m1", "date_time_utc,user,description\n" + "".join(f"d,u,row {i}\n" for i in range(n)))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        ids = {r["description"]: r["record_id"] for r in read_exports(spark, str(tmp_path), CAPTURED).collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert ids == {f"row {i}": expected_id("m1", "d", "u", f"row {i}", i) for i in range(n)}


def by_hand(description):
    table = list(csv.DictReader(io.StringIO(fixed.RULES_CSV)))
    for rule in sorted(table, key=lambda r: int(r["priority"])):
        if description and re.fullmatch(rule["pattern"], description):
            return rule["change_type"], rule["object_type"]
    return fixed.CATCHALL_CHANGE_TYPE, fixed.CATCHALL_OBJECT_TYPE


def test_shipped_rules(spark):
    known = [r["change_type"] for r in csv.DictReader(io.StringIO(fixed.RULES_CSV))]
    odd = ["", None, " ", "Add List\n", "add list", "12 Item(s) Added", "٣ Item(s) Added", "x Item(s) Added", "Add Listing",
           "Breakback data change affecting 7 cells", "two\nlines", "it's \\ odd"]
    df = spark.createDataFrame([(d,) for d in known + odd], "description string")
    rules.register_sql_functions(spark)
    out = rules.with_classification(df).selectExpr(
        "description", "change_type", "object_type", "classify_change_type(description) AS c2", "classify_object_type(description) AS o2")
    for r in out.collect():
        assert (r["change_type"], r["object_type"]) == by_hand(r["description"]), r["description"]
        assert (r["c2"], r["o2"]) == (r["change_type"], r["object_type"])


def test_rule_validation_and_order(spark, tmp_path):
    (tmp_path / "rules.csv").write_text(
        'priority,pattern,object_type,change_type\n'
        '50,^a.*$,Role,Edit\n50,^ab$,User,Add\n10,^abc$,Export,Create\nbad,^x$,Role,Edit\n5,(,Role,Edit\n'
        '5,^x$,Nope,Edit\n5,^x$,Role,Nope\n5,,Role,Edit\n60,"^q, ""z""$",Other,Other\n70,b{2},Other,Rename\n')
    loaded = rules.read_rules(spark, str(tmp_path / "rules.csv"))
    assert [(r.priority, r.pattern) for r in loaded] == [(10, "^abc$"), (50, "^a.*$"), (50, "^ab$"), (60, '^q, "z"$'), (70, "b{2}")]
    assert [r.literal for r in loaded] == ["abc", None, "ab", 'q, "z"', None]
    df = spark.createDataFrame([("abc",), ("ab",), ("ax",), ("x",), ('q, "z"',), ("bb",)], "description string")
    got = {r["description"]: (r["object_type"], r["change_type"]) for r in rules.with_classification(df, rules=loaded).collect()}
    assert got == {"abc": ("Export", "Create"), "ab": ("Role", "Edit"), "ax": ("Role", "Edit"), 'q, "z"': ("Other", "Other"),
                   "bb": ("Other", "Rename"), "x": (fixed.CATCHALL_OBJECT_TYPE, fixed.CATCHALL_CHANGE_TYPE)}
    assert {r["change_type"] for r in rules.with_classification(df, rules=[]).collect()} == {fixed.CATCHALL_CHANGE_TYPE}


def test_shipped_rules_are_all_usable():
    assert len(rules.default_rules()) == 76
    objects, changes = rules.vocabularies()
    assert len(objects) == 12 and len(changes) == 82


def test_store_policies(spark, tmp_path):
    store = HistoryStore(spark, str(tmp_path / "store"))
    land(tmp_path / "a", "m1", "date_time_utc,user,description\n2025-01-15 10:00:00,u,Gap one\n2020-01-01 10:00:00,u,Add List\n2025-01-15 10:00:00,u,Gap one\n")
    pairs = literal_table(spark, [("w1", "m1")], schemas._strings("workspace_id", "model_id"))
    names = literal_table(spark, [("m1", 'Plan: "A"/B')], schemas._strings("id", "name"))
    spaces = literal_table(spark, [("zz", "none")], schemas._strings("id", "name"))
    store.load(history_rows(spark, str(tmp_path / "a"), "T1"), registry(pairs, spaces, names, "T1"), "T1")
    assert store.registry.read().collect() == [("m1", "Plan A B", "w1", "w1", "T1")]
    own = rules.build_rules([{"priority": "1", "pattern": "Gap .*", "object_type": "Role", "change_type": "Edit"}])
    store.load(history_rows(spark, str(tmp_path / "a"), "T2", own), registry(pairs, spaces, names, "T2"), "T2")
    rows = store.normalized.read().collect()
    assert {(r["description"], r["change_type"], r["captured_at"]) for r in rows} == {
        ("Gap one", "Edit", "T1"), ("Add List", fixed.CATCHALL_CHANGE_TYPE, "T1")}
    assert len(rows) == 3 and store.list.read().count() == 3
    assert store.registry.read().first()["last_synced_at"] == "T2"
    seen = {r["description"]: tuple(r)[1:] for r in store.unmatched.read().collect()}
    assert seen == {"Gap one": (2, "T1", "T1"), "Add List": (1, "T2", "T2")}
    assert store.purge(datetime(2025, 6, 1, tzinfo=UTC), 2) == {"normalized": 1, "list": 1}
    assert store.normalized.read().count() == 2
    store.rotate(2)
    assert len(store.normalized.version_numbers()) == 2
    store.publish(str(tmp_path / "out"))
    header = next((tmp_path / "out/MODEL_HISTORY_NORMALIZED").glob("part-*")).read_text().splitlines()[0]
    assert header.split(",") == fixed.HISTORY_COLUMNS


@pytest.mark.parametrize(("raw", "clean"), [
    ('a/b\\c:d*e?f"g<h>i|j', "a b c d e f g h i j"), ("  FP&A   Model ", "FP&A Model"), ("\tx ", "x"), ("///", ""), ("", ""),
])
def test_clean_name(spark, raw, clean):
    df = spark.createDataFrame([(raw,)], "name string")
    assert df.select(text.clean_name(df["name"])).first()[0] == clean


@pytest.mark.parametrize(("pattern", "prefix"), [
    ("^Add List$", "Add List"), (r"Add \(x\) .*", "Add (x) "), ("ab*c", "a"), ("ab+c", "ab"), ("ab?c", "a"), ("ab{2}", "a"), ("a|b", ""),
    ("Ad(d|x)", "Ad"), ("[a|b]c", ""), (r"a\|b.", "a|b"), (r"x\d+", "x"), ("(?i)abc", ""), (".*", ""), ("é.", "é"), ("a\\", "a"), ("^a^b", "a"),
])
def test_literal_prefix(pattern, prefix):
    assert rules.literal_prefix(pattern) == prefix


def test_many_rules_equal_rules_in_turn(spark, monkeypatch):
    """Rules of all kinds, looked up and tried in turn, label the same texts alike."""
    import random

    rng = random.Random(2)
    words = ["Add", "List", "Gap", "é", "(s)", "Item", "x|y", "a.b"]
    texts = [" ".join(rng.choice(words) for _ in range(rng.randint(0, 5))) for _ in range(300)] + [None, "", "Add", " "]
    own = []
    for i in range(200):
        parts = [re.escape(w) for w in rng.choices(words, k=rng.randint(1, 4))]
        tail = rng.choice(["", ".*", " ?.*", "(é|x).*", "[A-Z].*", "x*"])
        body = rng.choice(["", "", "^", ".*", "(Add|Gap) "]) + " ".join(parts) + tail
        own.append({"priority": str(rng.randint(1, 90)), "pattern": body, "object_type": fixed.OBJECT_TYPES[i % 7], "change_type": fixed.CHANGE_TYPES[i % 5]})
    built = rules.build_rules(own)
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, description string")
    in_turn = {tuple(r) for r in rules.with_classification(df, rules=built).collect()}
    monkeypatch.setattr(rules, "TRIED_IN_TURN", 0)
    assert {tuple(r) for r in rules.with_classification(df, rules=built).collect()} == in_turn
    assert len({r[2:] for r in in_turn}) > 5 and len(in_turn) == len(texts)
