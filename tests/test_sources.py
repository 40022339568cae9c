"""Landed metadata pages and published extracts."""

import csv
import io
import json

import pytest

from tidemark import fixed, schemas
from tidemark.operators import normalize
from tidemark.plans import audit
from tidemark.plans.events import EventStore, prepare_events
from tidemark.session import literal_table
from tidemark.sources import pages, publish


def land(root, folder, document):
    path = root / folder
    path.mkdir(parents=True, exist_ok=True)
    (path / "page-000.json").write_text(json.dumps(document) + "\n")


@pytest.fixture
def landed(tmp_path):
    land(tmp_path, "users", {"totalResults": 2, "Resources": [
        {"id": "u1", "userName": "a@x", "displayName": "Ann", "name": {"givenName": "Ann", "familyName": None}, "emails": [{"value": "a"}]},
        {"id": "u2", "userName": "b@x", "firstName": "Top", "name": {"givenName": "Low"}, "active": True}]})
    land(tmp_path, "workspaces", {"workspaces": [{"id": "w1", "name": "Space", "active": False, "currentSize": 5}, {"id": "2", "name": "Two"}]})
    land(tmp_path, "models/workspaceId=w1", {"models": [{"id": "M1", "name": "Plan", "memoryUsage": 7, "categoryValues": {"a": 1}}]})
    land(tmp_path, "models/workspaceId=002", {"models": [{"id": "M2", "name": "Other", "lastModified": 1705312200000}]})
    land(tmp_path, "actions/workspace_id=w1/model_id=M1", {"actions": [
        {"id": "a1", "name": "Load", "actionType": "IMPORT", "type": "x"}, {"id": "a2", "name": "Old", "type": "EXPORT"}, {"id": "a3", "name": "None"}]})
    land(tmp_path, "processes/workspace_id=w1/model_id=M1", {"processes": [{"id": "p1", "name": "Run"}]})
    land(tmp_path, "files/workspace_id=w1/model_id=M9", {"files": [{"id": "f1", "name": "x.csv", "chunkCount": 3, "headerRow": 1}]})
    land(tmp_path, "integrations", {"integrations": [
        {"integrationId": "cw1", "name": "Sync", "modelId": "M1", "modifiedBy": None, "latestRun": {"success": True, "executionErrorCode": 0}, "schedule": {"name": "Nightly"}},
        {"integrationId": "cw2", "name": "Bare"}]})
    return tmp_path


def test_users(spark, landed):
    rows = {r["id"]: tuple(r) for r in pages.read_users(spark, f"{landed}/users").collect()}
    assert rows == {"u1": ("u1", "a@x", "Ann", "Ann", ""), "u2": ("u2", "b@x", "", "Top", "")}


def test_workspaces_models_and_folder_columns(spark, landed):
    ws = {r["id"]: tuple(r) for r in pages.read_workspaces(spark, f"{landed}/workspaces").collect()}
    assert ws == {"w1": ("w1", "Space", False, 0, 5), "2": ("2", "Two", True, 0, 0)}
    mo = {r["id"]: r.asDict() for r in pages.read_models(spark, f"{landed}/models").collect()}
    assert mo["M1"]["workspaceId"] == "w1" and mo["M1"]["memoryUsage"] == 7 and mo["M1"]["modelUrl"] == ""
    assert mo["M2"]["workspaceId"] == "002" and mo["M2"]["lastModified"] == "1705312200000"
    assert list(mo["M1"]) == schemas.MODELS.fieldNames()


def test_per_model_pages_and_provenance(spark, landed):
    ws, mo = pages.read_workspaces(spark, f"{landed}/workspaces"), pages.read_models(spark, f"{landed}/models")
    acts = normalize.with_provenance(pages.read_actions(spark, f"{landed}/actions"), ws, mo)
    got = {r["id"]: (r["type"], r["workspace_name"], r["model_name"]) for r in acts.collect()}
    assert got == {"a1": ("IMPORT", "Space", "Plan"), "a2": ("EXPORT", "Space", "Plan"), "a3": ("", "Space", "Plan")}
    files = normalize.with_provenance(pages.read_files(spark, f"{landed}/files"), ws, mo).first()
    assert (files["chunkCount"], files["model_id"], files["model_name"]) == ("3", "M9", "")
    assert pages.read_processes(spark, f"{landed}/processes").columns == schemas.PROCESSES.fieldNames()


def test_integrations(spark, landed):
    rows = {r["integrationId"]: r.asDict() for r in pages.read_integrations(spark, f"{landed}/integrations").collect()}
    assert rows["cw1"]["latestRun.success"] == "true" and rows["cw1"]["latestRun.executionErrorCode"] == "0"
    assert rows["cw1"]["schedule.name"] == "Nightly" and rows["cw1"]["modifiedBy"] == ""
    assert rows["cw2"]["latestRun.success"] is None
    assert not {"type", "uxVisible", "latestRun", "schedule"} & set(rows["cw1"])


def text_of(folder):
    return [line for p in sorted(folder.glob("part-*")) for line in p.read_text().splitlines()]


def test_metadata_extracts(spark, landed, tmp_path):
    tables = {
        "workspaces": pages.read_workspaces(spark, f"{landed}/workspaces"), "users": pages.read_users(spark, f"{landed}/users"),
        "act_codes": literal_table(spark, [("C", 'say "x", y', " pad ", None)], schemas.CATALOG),
    }
    names = {"workspaces": "WORKSPACE_LIST", "users": "", "act_codes": "ACTIVITY_CODES", "files": "FILE_LIST"}
    assert publish.publish_metadata(tables, str(tmp_path / "out"), names, {}) == ["workspaces", "act_codes"]
    rows = text_of(tmp_path / "out/WORKSPACE_LIST")
    assert [r for r in rows if not r.startswith("WS_CT")] == ["1,2,Two,1,0,0", "2,w1,Space,0,0,5"]
    assert text_of(tmp_path / "out/ACTIVITY_CODES") == ["Event Code,Event Message,Associated Object ID,Notes", 'C,"say ""x"", y", pad ,']


def test_list_extracts(spark, tmp_path):
    names = {"ux_app": "UX_APP_LIST", "ux_page": "", "role": "ROLE_LIST"}
    assert publish.publish_lists(spark, None, str(tmp_path / "none"), names) == ["ux_app"]
    assert text_of(tmp_path / "none/UX_APP_LIST") == ["code,name"]
    columns = list(fixed.ATTRIBUTE_COLUMNS.values())
    events = spark.createDataFrame([[{"app_id": "a", "app_name": "A, B", "role_id": "r", "role_name": "R"}.get(c) for c in columns]], schemas._strings(*columns))
    assert publish.publish_lists(spark, events, str(tmp_path / "some"), names, ["uxAppPage", "role"]) == ["ux_app", "role"]
    assert text_of(tmp_path / "some/UX_APP_LIST") == ["code,name", 'a,"A, B"']


def test_last_run_extract(spark, tmp_path):
    publish.write_csv(publish.last_run(spark, 1736951400), str(tmp_path / "last"), single_file=True)
    assert text_of(tmp_path / "last") == ["last_run_epoch,last_run_utc", "1736951400,2025-01-15T14:30:00Z"]


def test_wide_audit_from_landed_pages(spark, landed, tmp_path):
    land(landed, "events", {"response": [
        {"id": 1, "eventDate": 1705312200000, "index": 1, "eventTypeId": "USR-41", "userId": "u1", "objectId": "m1", "additionalAttributes": {"actionId": "a1"}},
        {"id": 2, "eventTypeId": "NEW-1", "userId": "gone", "objectId": "CW1", "additionalAttributes": {"actionId": "-1", "workspaceId": "w1"}},
        {"id": 3, "objectId": "U2", "additionalAttributes": {"modelId": "", "actionId": "", "active": True}},
        {"id": 4, "objectId": "nothing", "additionalAttributes": {"modelId": "M2", "actionId": "zz"}},
    ]})
    store = EventStore(spark, str(tmp_path / "store"))
    store.load(prepare_events(pages.read_pages(spark, f"{landed}/events", "events")))
    ws, mo = pages.read_workspaces(spark, f"{landed}/workspaces"), pages.read_models(spark, f"{landed}/models")
    wide = audit.wide_audit(
        store.table.read(), users=pages.read_users(spark, f"{landed}/users"), workspaces=ws, models=mo,
        integrations=pages.read_integrations(spark, f"{landed}/integrations"),
        actions=normalize.with_provenance(pages.read_actions(spark, f"{landed}/actions"), ws, mo),
        catalog=literal_table(spark, [("USR-41", "Process executed", "obj", "n")], schemas.CATALOG), tenant_name="T'x", batch_ms=5)
    assert wide.columns == fixed.WIDE_COLUMNS and len(wide.columns) == 59
    rows = {r["AUDIT_ID"]: r for r in wide.collect()}
    one, two, three, four = (rows[k] for k in "1234")
    assert (one["MODEL_ID"], one["MODEL_NAME"], one["OBJECT_TYPE"], one["ACTION_NAME"], one["USER_NAME"]) == ("M1", "Plan", "Model", "Load", "a@x")
    assert (one["LOAD_ID"], one["EVENT_DATE"], one["EVENT_MESSAGE"], one["EVENT_CATEGORY"]) == (
        "1705312200000000001", "2024-01-15 09:50:00", "Process executed", "USER ACTIVITY")
    assert (two["MODEL_ID"], two["MODEL_NAME"], two["OBJECT_TYPE"], two["OBJECT_NAME"], two["ACTION_NAME"]) == (
        "M1", "Plan", "CloudWorks Integration", "Sync", "Unsaved Action")
    assert (two["WORKSPACE_NAME"], two["USER_NAME"], two["EVENT_CATEGORY"]) == ("Space", None, "UNCATEGORIZED")
    # An empty model id still wins, without a name; an empty action id reads as deleted.
    assert (three["MODEL_ID"], three["MODEL_NAME"], three["OBJECT_TYPE"], three["ACTION_NAME"]) == ("", None, "User", "<Object has been Deleted>")
    assert (three["ADDITIONAL_ATTRIBUTES_ACTIVE"], three["UX_APP_NAME"], three["EVENT_DATE"]) == ("1", None, "1970-01-01 00:00:00")
    assert (four["MODEL_NAME"], four["OBJECT_TYPE"], four["SUCCESS"], four["TENANT_NAME"]) == ("Other", None, 1, "T'x")


def _landed(tmp_path, name, text):
    folder = tmp_path / "workspace_id=w" / "model_id=m"
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text(text, encoding="utf-8")
    return str(tmp_path)


def test_blank_cells_are_a_row_and_every_file_is_read(spark, tmp_path):
    from tidemark.sources.exports import read_exports

    _landed(tmp_path, "a.tsv", "date_time_utc\tuser\tdescription\nd1\tu\tx\n\t\t\nd3\tu\ty\n")
    path = _landed(tmp_path, "b.txt", "date_time_utc,user,description\nd4,u,z\n")
    rows = read_exports(spark, path, "now").collect()
    assert sorted(r["date_time_utc"] for r in rows) == ["", "d1", "d3", "d4"]


def test_quoted_line_break_stays_in_its_cell(spark, tmp_path):
    from tidemark.sources.exports import read_exports

    path = _landed(tmp_path, "a.csv", 'date_time_utc,user,description\nd1,u,"one\ntwo"\n')
    assert read_exports(spark, path, "now").first()["description"] == "one\ntwo"


def test_each_export_line_is_parsed_once(spark, tmp_path):
    from tidemark.sources.exports import read_exports

    path = _landed(tmp_path, "a.csv", "date_time_utc,user,description,export\nd1,u,x,e\n")
    plan = read_exports(spark, path, "now")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_csv(") == 2


@pytest.mark.parametrize("text", ['{"response": [{"id": "a"', '{\n  "response": [\n {"id": "a"}]\n}'])
def test_unreadable_page_fails(spark, tmp_path, text):
    from tidemark.sources.pages import read_pages

    (tmp_path / "page.json").write_text(text)
    with pytest.raises(Exception, match="unreadable events page"):
        read_pages(spark, str(tmp_path), "events").collect()


def test_numbers_of_events(spark):
    from tidemark import schemas
    from tidemark.operators.normalize import coerce_events

    names = [f.name for f in schemas.LANDED_EVENT.fields]
    row = {n: None for n in names} | {"eventDate": "1704067200000.0"}
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schemas.LANDED_EVENT.fields)
    one = spark.createDataFrame([tuple(row[n] for n in names)], schema)
    assert coerce_events(one).first()["eventDate"] == 1704067200000
    bad = spark.createDataFrame([tuple((row | {"eventDate": "soon"})[n] for n in names)], schema)
    with pytest.raises(Exception, match="no whole number"):
        coerce_events(bad).collect()


def test_file_parts_are_bounded_and_make_up_the_file(spark, tmp_path):
    rows = [(i, "x" * (i % 23), 'say "hi", ' + str(i) if i % 3 else None, i % 2 == 0) for i in range(500)]
    df = spark.createDataFrame(rows, "k int, a string, b string, flag boolean").repartition(7)
    publish.write_parts(df, str(tmp_path / "parts"), ["k"], 400)
    files = sorted((tmp_path / "parts").glob("part=*/part-*"), key=lambda p: int(p.parent.name.removeprefix("part=")))
    texts = [p.read_text() for p in files]
    assert len({p.parent.name for p in files}) == len(files) > 20 and all(len(t) <= 400 for t in texts)
    found = list(csv.reader(io.StringIO("".join(texts))))
    assert found == [["k", "a", "b", "flag"], *[[str(i), a, b or "", "1" if f else "0"] for i, a, b, f in rows]]
    with pytest.raises(ValueError, match="does not fit"):
        publish.write_parts(df, str(tmp_path / "short"), ["k"], 20)
