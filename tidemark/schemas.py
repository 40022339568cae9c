"""Explicit schemas: nothing is inferred from data."""

from __future__ import annotations

from pyspark.sql import types as T

from tidemark import fixed

EVENT_TEXT_FIELDS = [
    "id", "eventTimeZone", "createdTimeZone", "eventTypeId", "userId", "tenantId", "objectId",
    "objectTypeId", "objectTenantId", "message", "ipAddress", "userAgent", "sessionId",
    "hostName", "serviceVersion", "checksum",
]
EVENT_NUMBER_FIELDS = ["eventDate", "index", "createdDate"]


def _strings(*names: str) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


# Landed events are loosely typed, so every field is read as its JSON text and
# coerced afterwards. An object read as a string keeps its JSON source text.
LANDED_EVENT = _strings(
    *EVENT_TEXT_FIELDS, *EVENT_NUMBER_FIELDS, "success", "errorNumber", "additionalAttributes"
)

ORDER = T.StructType([
    T.StructField("file", T.StringType()),
    T.StructField("block", T.LongType()),
    T.StructField("row", T.LongType()),
    T.StructField("pos", T.IntegerType()),
])



def ordered(schema: T.StructType) -> T.StructType:
    """The schema with the arrival order of its rows."""
    return T.StructType([*schema.fields, T.StructField("_ord", ORDER)])


EVENTS = T.StructType(
    [T.StructField(n, T.StringType()) for n in EVENT_TEXT_FIELDS]
    + [T.StructField(n, T.LongType()) for n in EVENT_NUMBER_FIELDS]
    + [T.StructField("success", T.BooleanType()), T.StructField("errorNumber", T.StringType())]
    + [T.StructField("attrs", T.MapType(T.StringType(), T.StringType()))]
    + [T.StructField(n, T.StringType()) for n in fixed.ATTRIBUTE_COLUMNS.values()]
    + [T.StructField(fixed.RAW_ATTRIBUTES_COLUMN, T.StringType())]
    # Top-level fields that are not declared above, by dotted path.
    + [T.StructField("other", T.MapType(T.StringType(), T.StringType())), T.StructField("_ord", ORDER)]
)

WORKSPACES = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("name", T.StringType()),
    T.StructField("active", T.BooleanType()),
    T.StructField("sizeAllowance", T.LongType()),
    T.StructField("currentSize", T.LongType()),
])
USERS = _strings("id", "userName", "displayName", "firstName", "lastName")
MODELS = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("name", T.StringType()),
    T.StructField("activeState", T.StringType()),
    T.StructField("currentWorkspaceId", T.StringType()),
    T.StructField("currentWorkspaceName", T.StringType()),
    T.StructField("modelUrl", T.StringType()),
    T.StructField("isoCreationDate", T.StringType()),
    T.StructField("lastSavedSerialNumber", T.LongType()),
    T.StructField("lastModifiedByUserGuid", T.StringType()),
    T.StructField("memoryUsage", T.LongType()),
    T.StructField("lastModified", T.StringType()),
    T.StructField("workspaceId", T.StringType()),
])
PROVENANCE = ["workspace_id", "model_id", "workspace_name", "model_name"]
ACTIONS = _strings("id", "name", "type", *PROVENANCE)
PROCESSES = _strings("id", "name", *PROVENANCE)
FILES = _strings(
    "id", "name", "chunkCount", "delimiter", "encoding", "firstDataRow", "format", "headerRow",
    "separator", *PROVENANCE,
)
RUN_FIELDS = [
    "triggeredBy", "startDate", "endDate", "success", "message", "executionErrorCode",
    "triggerSource",
]
SCHEDULE_FIELDS = ["name", "type", "toTime", "timezone", "fromTime", "start"]
INTEGRATION_FIELDS = [
    "integrationId", "name", "workspaceId", "modelId", "createdBy", "creationDate", "modifiedBy",
    "modificationDate", "notificationId", "processId", "integrationType", "nuxVisible",
]
INTEGRATIONS = _strings(
    *INTEGRATION_FIELDS,
    *[f"latestRun.{f}" for f in RUN_FIELDS],
    *[f"schedule.{f}" for f in SCHEDULE_FIELDS],
)
CATALOG = _strings(*fixed.CATALOG_COLUMNS)
CATALOG_COMPLETE = _strings(*fixed.CATALOG_COLUMNS, "Parent Code", "Parent", "Event Name").add("position", T.LongType())
CATEGORY_SEED = _strings("Code", "Name", "Parent")
EMPTY_LIST = _strings("code", "name")

HISTORY = _strings(*fixed.HISTORY_COLUMNS)
HISTORY_LIST = _strings("record_id", "model_id", "date_time_utc")
REGISTRY = _strings("model_id", "model_name", "workspace_id", "workspace_name", "last_synced_at")
UNMATCHED = T.StructType([
    T.StructField("description", T.StringType()),
    T.StructField("occurrences", T.LongType()),
    T.StructField("first_seen_at", T.StringType()),
    T.StructField("last_seen_at", T.StringType()),
])
RUN_LOG = T.StructType([
    T.StructField("batch_code", T.StringType()),
    T.StructField("logged_at", T.StringType()),
    T.StructField("records_loaded", T.LongType()),
])
# One number of one step of a run, such as the rows a load read.
RUN_METRICS = T.StructType([
    T.StructField("metric_id", T.StringType()),
    T.StructField("batch_code", T.StringType()),
    T.StructField("step", T.StringType()),
    T.StructField("metric", T.StringType()),
    T.StructField("value", T.LongType()),
])
WATERMARK = T.StructType([
    T.StructField("last_run_epoch", T.LongType()),
    T.StructField("last_run_utc", T.StringType()),
])
