"""Both flows from a landing folder to published files."""

import json
from datetime import UTC, datetime

import pytest
from pyspark.errors import PySparkException

from tidemark import schemas
from tidemark.plans.run import MetadataStore, Scope, resolved_scope, run_audit, run_history
from tidemark.session import literal_table
from tidemark.sources import publish

NOW = datetime(2025, 1, 15, 14, 30, tzinfo=UTC)


def land(root, folder, document, name="page-000.json"):
    path = root / folder
    path.mkdir(parents=True, exist_ok=True)
    (path / name).write_text(json.dumps(document) + "\n")


def lines(folder):
    return sorted({line for p in folder.glob("part-*") for line in p.read_text().splitlines()})


def test_audit_run(spark, tmp_path):
    landing, storage, out = tmp_path / "in", str(tmp_path / "store"), tmp_path / "out"
    land(landing, "workspaces", {"workspaces": [{"id": "w1", "name": "Space"}]})
    land(landing, "users", {"Resources": [{"id": "u1", "userName": "a@x", "displayName": "Ann"}]})
    land(landing, "models/workspaceId=w1", {"models": [{"id": "M1", "name": "Plan", "lastModifiedByUserGuid": "u1"}]})
    for model in ("M1", "M2"):
        land(landing, f"actions/workspace_id=w1/model_id={model}", {"actions": [{"id": "a", "name": f"Act {model}", "actionType": "IMPORT"}]})
    land(landing, "events", {"response": [
        {"id": 1, "eventDate": 1736951000000, "eventTypeId": "USR-1", "userId": "u1", "objectId": "m1", "additionalAttributes": {"actionId": "A", "appId": "x", "appName": "App"}},
        {"id": 2, "eventDate": 1000, "eventTypeId": "WF-77", "objectId": "M2", "additionalAttributes": {"actionId": "a"}}]})
    (tmp_path / "codes.csv").write_text("Event Code,Event Message,Associated Object ID,Notes\nUSR-1,User created,id,--\n")
    scope = Scope(literal_table(spark, [("w1", "M1")], schemas._strings("workspace_id", "model_id")))
    options = dict(
        now=NOW, tenant_name="Example", scope=scope, retention_years=1, list_extracts={"ux_app": "UX_APP_LIST"},
        extracts={"models": "MODEL_LIST", "actions": "ACTION_LIST", "act_codes": "ACTIVITY_CODES", "event_categories": "EVENT_CATEGORIES", "cloudworks": "CLOUDWORKS_LIST"})
    dry = run_audit(spark, str(landing), storage, str(out), str(tmp_path / "codes.csv"), **{**options, "retention_years": 0}, dry_run=True)
    assert dry.events_loaded == 2 and dry.published == [] and not out.exists()
    sync = {"sync_lists": {"Users": "USER_ID", "Gone": "USER_ID"}, "listed": {"Users": literal_table(spark, [("old", "Old")], schemas.EMPTY_LIST)}}
    done = run_audit(spark, str(landing), storage, str(out), str(tmp_path / "codes.csv"), **options, **sync)
    assert done.published == ["audit", "models", "actions", "cloudworks", "act_codes", "event_categories", "ux_app", "new:Users"]
    assert lines(out / "NEW_Users")[-1].startswith("u1")
    assert done.events_loaded == 2 and done.purged == 1
    assert lines(out / "ACTIVITY_CODES") == [
        "Event Code,Event Message,Associated Object ID,Notes,Parent Code,Parent,Event Name",
        "USR-1,User created,id,--,USR,USER ACTIVITY,User created", "WF-77,,,,WF,WORKFLOW,WF-77"]
    assert lines(out / "ACTION_LIST")[0] == "1,a,Act M1,IMPORT,w1,M1,Space,Plan"
    assert any(r.startswith("1,M1,Plan,") and ",u1,a@x,Ann," in r for r in lines(out / "MODEL_LIST"))
    assert lines(out / "UX_APP_LIST") == ["code,name", "x,App"]
    assert len(lines(out / "EVENT_CATEGORIES")) == 12 and len(lines(out / "CLOUDWORKS_LIST")) == 1
    assert lines(out / "last_run")[0] == "1736951400,2025-01-15T14:30:00Z"
    wide = [r for r in lines(out / "AUDIT_LOG") if not r.startswith("LOAD_ID")]
    assert len(wide) == 2
    assert any(",Act M1," in r and ",Model,Plan," in r for r in wide)
    assert any("<Object has been Deleted>" in r for r in wide)


def test_history_run(spark, tmp_path):
    landing, storage, out = tmp_path / "in", str(tmp_path / "store"), tmp_path / "out"
    folder = landing / "history/workspace_id=w1/model_id=M1"
    folder.mkdir(parents=True)
    (folder / "x.csv").write_text("date_time_utc,user,description\n2025-01-01 00:00:00,u,Add List\n2020-01-01 00:00:00,u,Odd\n")
    land(landing, "workspaces", {"workspaces": [{"id": "w1", "name": "Space"}]})
    land(landing, "models/workspaceId=w1", {"models": [{"id": "M1", "name": "FP&A: One"}]})
    MetadataStore(spark, f"{storage}/metadata").load(str(landing), Scope())
    pairs = literal_table(spark, [("w1", "M1"), ("w1", "M9")], schemas._strings("workspace_id", "model_id"))
    store = run_history(spark, str(landing), storage, str(out), now=NOW, pairs=pairs)
    assert {tuple(r)[:4] for r in store.registry.read().collect()} == {("M1", "FP&A One", "w1", "Space"), ("M9", "M9", "w1", "Space")}
    assert [r["change_type"] for r in store.normalized.read().collect()] == ["Add List"]
    assert len(lines(out / "MODEL_HISTORY_LIST")) == 3
    assert [r["description"] for r in store.unmatched.read().collect()] == ["Odd"]


def test_scope_from_names(spark, tmp_path):
    ws = spark.createDataFrame([("w1", "Space"), ("w2", "Other")], "id string, name string")
    mo = spark.createDataFrame([("m1", "Plan", "w1"), ("m2", "Plan", "w2")], "id string, name string, workspaceId string")
    refs = spark.createDataFrame([("space", "PLAN"), ("w2", "m2"), ("Space", "m1")], "workspace string, model string")
    pairs = resolved_scope(refs, ws, mo).pairs
    assert {tuple(r) for r in pairs.collect()} == {("w1", "m1"), ("w2", "m2")}
    with pytest.raises(PySparkException, match="nowhere"):
        resolved_scope(spark.createDataFrame([("w1", "nowhere")], "workspace string, model string"), ws, mo).pairs.collect()


def test_counters_and_name_ties_follow_the_listing(spark, tmp_path):
    landing, out = tmp_path / "in", tmp_path / "out"
    land(landing, "workspaces", {"workspaces": [{"id": "z", "name": "Same"}, {"id": "a", "name": "Other"}]}, "page-000.json")
    land(landing, "workspaces", {"workspaces": [{"id": "b", "name": "Same"}]}, "page-001.json")
    land(landing, "models/workspaceId=b", {"models": [{"id": "M2", "name": "Plan"}, {"id": "M1", "name": "plan"}]})
    store = MetadataStore(spark, str(tmp_path / "store"))
    store.load(str(landing), Scope())
    assert "_ord" not in store.read("workspaces").columns
    publish.publish_metadata({"workspaces": store.in_order("workspaces")}, str(out), {"workspaces": "WORKSPACES"}, {})
    assert [r.split(",")[:2] for r in lines(out / "WORKSPACES")][:3] == [["1", "z"], ["2", "a"], ["3", "b"]]
    refs = spark.createDataFrame([("Same", "PLAN")], "workspace string, model string")
    found = resolved_scope(refs, store.in_order("workspaces"), store.in_order("models")).pairs.collect()
    assert [tuple(r) for r in found] == [("b", "M1")]
