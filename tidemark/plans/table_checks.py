"""Every operator over the test tables, each next to the SQL it must equal.

The tables stand in for the library's own: ``events`` for audit events,
``customer`` for users, ``part`` for models, ``supplier`` for integrations,
``nation`` for workspaces and ``orders`` for change-history rows.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import UTC, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import fixed, schemas
from tidemark.functions import attributes, rules, taxonomy, text
from tidemark.operators import backfill, catalog, joins, lists, normalize, ordinals, retention, unmatched, upsert
from tidemark.plans import audit, history
from tidemark.plans.events import EventStore, prepare_events
from tidemark.plans.history import HistoryStore
from tidemark.session import configure, empty_table, literal_table, shared_dir
from tidemark.sources import pages, publish
from tidemark.sources.exports import read_exports
from tidemark.sources.snapshots import SnapshotTable, by_bucket
from tidemark.streaming.ingest import ingest

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}

BATCH_MS = 1704067200000
SPLIT = "2024-01-16 00:00:00"
RUN_1, RUN_2 = "2024-01-10T00:00:00+00:00", "2024-01-20T00:00:00+00:00"


def check(sql: str | None) -> Callable[[Query], Query]:
    """Register a query under its function name together with its SQL."""

    def register(query: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return query(configure(spark), sf_dir)

        QUERIES[query.__name__] = run
        if sql:
            SQL[query.__name__] = sql
        return query

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def millis(column: str) -> Column:
    return F.unix_millis(F.col(column).cast("timestamp"))


def tagged(letter: str, column: str | Column) -> Column:
    return F.concat(F.lit(letter), (F.col(column) if isinstance(column, str) else column).cast("string"))


# --------------------------------------------------------------------------
# Landed events derived from the events table
# --------------------------------------------------------------------------

CODE_SQL = """CASE event_type WHEN 'signup' THEN 'USR-1' WHEN 'purchase' THEN 'INT-2'
 WHEN 'view' THEN ' wf-3' WHEN 'click' THEN 'AUTHZ-4' ELSE 'XX-5' END"""


def event_code() -> Column:
    return (
        F.when(F.col("event_type") == "signup", "USR-1").when(F.col("event_type") == "purchase", "INT-2")
        .when(F.col("event_type") == "view", " wf-3").when(F.col("event_type") == "click", "AUTHZ-4")
        .otherwise("XX-5")
    )


def number_k() -> Column:
    return F.get_json_object("props", "$.k")


def landed_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Audit events in landed (all text) form with a JSON attribute text."""
    ev = table(spark, sf_dir, "events").withColumns({"k": number_k(), "ms": millis("ts")})
    error_keys = [k for k in fixed.WIDE_ATTRIBUTES.values()]
    error_json = F.to_json(F.struct(*[F.concat(F.lit(f"{k}-"), F.col("k")).alias(k) for k in error_keys]))
    workspace = F.concat(F.lit("W"), (F.col("user_id") % 30).cast("string")).alias("workspaceId")
    attrs = (
        F.when(F.col("event_type") == "purchase", F.to_json(F.struct(workspace, tagged("M", "k").alias("modelId"))))
        .when(F.col("event_type") == "view", F.to_json(F.struct(workspace, tagged("A", "k").alias("actionId"))))
        .when(F.col("event_type") == "click", F.to_json(F.struct(F.lit("-1").alias("actionId"))))
        .when(F.col("event_type") == "error", error_json)
    )
    object_id = (
        F.when(F.col("event_id") % 4 == 0, tagged("m", "k")).when(F.col("event_id") % 4 == 1, tagged("s", "k"))
        .when(F.col("event_id") % 4 == 2, tagged("c", "k"))
    )
    return ev.select(
        F.col("event_id").cast("string").alias("id"),
        F.col("ms").cast("string").alias("eventDate"),
        (F.col("ms") + 1500).cast("string").alias("createdDate"),
        (F.col("event_id") % 1000).cast("string").alias("index"),
        F.lit("UTC").alias("eventTimeZone"), F.lit("UTC").alias("createdTimeZone"),
        event_code().alias("eventTypeId"), tagged("C", "user_id").alias("userId"),
        F.lit("T1").alias("tenantId"), object_id.alias("objectId"), F.lit("2").alias("objectTypeId"),
        F.lit("T1").alias("objectTenantId"), F.col("event_type").alias("message"),
        F.when(F.col("event_type") == "error", "false").when(F.col("event_type") != "click", "true").alias("success"),
        F.when(F.col("event_type") == "error", tagged("E", "k")).alias("errorNumber"),
        tagged("ip", "k").alias("ipAddress"), tagged("ua", "k").alias("userAgent"),
        tagged("s", "user_id").alias("sessionId"), F.lit("host").alias("hostName"), F.lit("1.0").alias("serviceVersion"),
        F.sha2(F.col("event_id").cast("string"), 256).alias("checksum"), attrs.alias("additionalAttributes"),
        F.struct(F.lit("f").alias("file"), F.lit(0).cast("long").alias("block"), F.col("event_id").alias("row"),
                 F.lit(0).alias("pos")).alias("_ord"),
    )


def users_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    return c.select(tagged("C", "c_custkey").alias("id"), F.col("c_name").alias("userName"), F.col("c_mktsegment").alias("displayName"))


def models_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(tagged("M", "p_partkey").alias("id"), F.col("p_name").alias("name"))


def integrations_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "supplier")
    return s.select(tagged("S", "s_suppkey").alias("integrationId"), F.col("s_name").alias("name"), tagged("M", "s_suppkey").alias("modelId"))


def code_table(spark: SparkSession) -> DataFrame:
    rows = [("USR-1", "User created", "The user", "note 1"), ("INT-2", "Integration run", "The integration", "note 2"),
            ("AUTHZ-4", "Role changed", "The role", "note 4")]
    return literal_table(spark, rows, schemas.CATALOG)


_ERROR_ATTRS = ",\n ".join(
    f"CASE WHEN event_type = 'error' THEN '{key}-' || k END AS {out}" for out, key in fixed.WIDE_ATTRIBUTES.items()
)


@check(f"""
WITH e AS (
 SELECT *, props->>'$.k' AS k, epoch_us(ts) // 1000 AS ms, {CODE_SQL} AS code,
  CASE event_id % 4 WHEN 0 THEN 'm' WHEN 1 THEN 's' WHEN 2 THEN 'c' END || (props->>'$.k') AS oid0,
  CASE WHEN event_type IN ('purchase', 'view') THEN 'W' || (user_id % 30) END AS ws,
  CASE WHEN event_type = 'purchase' THEN 'M' || (props->>'$.k') END AS mid,
  CASE event_type WHEN 'view' THEN 'A' || (props->>'$.k') WHEN 'click' THEN '-1' END AS aid
 FROM events),
f AS (SELECT *, coalesce(oid0, '') AS oid FROM e),
m AS (SELECT 'M' || p_partkey AS id, p_name AS name FROM part),
cw AS (SELECT 'S' || s_suppkey AS id, s_name AS name, 'M' || s_suppkey AS model_id FROM supplier),
u AS (SELECT 'C' || c_custkey AS id, c_name AS name, c_mktsegment AS display FROM customer),
w AS (SELECT 'W' || n_nationkey AS id, n_name AS name FROM nation),
a AS (SELECT 'A' || p_partkey AS id, 'M' || p_partkey AS model_id, p_type AS name FROM part WHERE p_size > 25),
ac(code, message, object, notes) AS (VALUES ('USR-1','User created','The user','note 1'),
 ('INT-2','Integration run','The integration','note 2'), ('AUTHZ-4','Role changed','The role','note 4'))
SELECT CAST(ms // 1000 AS VARCHAR) || lpad(CAST(event_id % 1000 AS VARCHAR), 9, '0') AS LOAD_ID,
 CAST({BATCH_MS} AS BIGINT) AS BATCH_ID, CAST(event_id AS VARCHAR) AS AUDIT_ID,
 strftime(make_timestamp(ms * 1000), '%Y-%m-%d %H:%M:%S') AS EVENT_DATE, 'UTC' AS EVENT_TIMEZONE,
 strftime(make_timestamp((ms + 1500) * 1000), '%Y-%m-%d %H:%M:%S') AS CREATED_DATE, 'UTC' AS CREATE_TIMEZONE,
 f.code AS EVENT_ID, ac.message AS EVENT_MESSAGE, ac.object AS ASSOCIATED_OBJECT_ID, ac.notes AS NOTES,
 'C' || user_id AS USER_ID, u.name AS USER_NAME, u.display AS DISPLAY_NAME, 'T1' AS TENANT_ID, 'O''Neil & Co' AS TENANT_NAME,
 ws AS WORKSPACE_ID, w.name AS WORKSPACE_NAME,
 CASE WHEN mid IS NOT NULL THEN mid WHEN m2.id IS NOT NULL THEN m2.id WHEN cw.id IS NOT NULL THEN cw.model_id END AS MODEL_ID,
 CASE WHEN mid IS NOT NULL THEN m.name WHEN m2.id IS NOT NULL THEN m2.name
  WHEN cw.id IS NOT NULL THEN (SELECT m3.name FROM m m3 WHERE m3.id = cw.model_id) END AS MODEL_NAME,
 oid AS OBJECT_ID,
 CASE WHEN m2.id IS NOT NULL THEN 'Model' WHEN cw.id IS NOT NULL THEN 'CloudWorks Integration' WHEN u2.id IS NOT NULL THEN 'User' END AS OBJECT_TYPE,
 CASE WHEN m2.id IS NOT NULL THEN m2.name WHEN cw.id IS NOT NULL THEN cw.name WHEN u2.id IS NOT NULL THEN u2.name END AS OBJECT_NAME,
 event_type AS MESSAGE, CASE WHEN event_type = 'error' THEN 0 ELSE 1 END AS SUCCESS,
 CASE WHEN event_type = 'error' THEN 'E' || k END AS ERROR_NUMBER, 'ip' || k AS IP_ADDRESS, 'ua' || k AS USER_AGENT,
 's' || user_id AS SESSION_ID, 'host' AS HOST_NAME, '1.0' AS SERVICE_VERSION, '2' AS OBJECT_TYPE_ID, 'T1' AS OBJECT_TENANT_ID,
 aid AS ACTION_ID,
 CASE WHEN aid = '-1' THEN 'Unsaved Action' WHEN a.name IS NULL AND aid IS NOT NULL THEN '<Object has been Deleted>' ELSE a.name END AS ACTION_NAME,
 {_ERROR_ATTRS},
 CASE event_type WHEN 'signup' THEN 'USER ACTIVITY' WHEN 'purchase' THEN 'INTEGRATION' WHEN 'view' THEN 'WORKFLOW'
  WHEN 'click' THEN 'ACCESS CONTROL' ELSE 'UNCATEGORIZED' END AS EVENT_CATEGORY,
 sha256(CAST(event_id AS VARCHAR)) AS CHECKSUM
FROM f LEFT JOIN u ON 'C' || user_id = u.id LEFT JOIN u u2 ON upper(oid) = upper(u2.id)
LEFT JOIN w ON ws = w.id LEFT JOIN m ON mid = m.id LEFT JOIN m m2 ON upper(oid) = upper(m2.id)
LEFT JOIN cw ON upper(oid) = upper(cw.id) LEFT JOIN ac ON f.code = ac.code
LEFT JOIN a ON upper(aid || oid) = upper(a.id || a.model_id)
""")
def q_audit_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = table(spark, sf_dir, "nation")
    part = table(spark, sf_dir, "part")
    return audit.wide_audit(
        prepare_events(landed_events(spark, sf_dir)),
        users=users_of(spark, sf_dir), models=models_of(spark, sf_dir), integrations=integrations_of(spark, sf_dir),
        workspaces=nation.select(tagged("W", "n_nationkey").alias("id"), F.col("n_name").alias("name")),
        actions=part.where("p_size > 25").select(
            tagged("A", "p_partkey").alias("id"), tagged("M", "p_partkey").alias("model_id"), F.col("p_type").alias("name")),
        catalog=code_table(spark), tenant_name="O'Neil & Co", batch_ms=BATCH_MS,
    )


@check(f"""
SELECT CAST(CASE WHEN event_id % 10 = 0 THEN '' ELSE CAST(event_id AS VARCHAR) END AS VARCHAR) AS id,
 CASE WHEN event_id % 7 = 0 THEN 0 ELSE epoch_us(ts) // 1000 END AS eventDate, event_id % 1000 AS "index",
 {CODE_SQL} AS eventTypeId, CASE WHEN event_type = 'error' THEN FALSE ELSE TRUE END AS success,
 CASE WHEN event_type = 'error' THEN 'E' || (props->>'$.k') END AS errorNumber, event_type AS message
FROM events
""")
def q_event_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    loose = landed_events(spark, sf_dir).withColumns({
        "eventDate": F.when(F.col("id").cast("long") % 7 != 0, F.col("eventDate")),
        "id": F.when(F.col("id").cast("long") % 10 != 0, F.col("id")),
    })
    return normalize.coerce_events(loose).select("id", "eventDate", "index", "eventTypeId", "success", "errorNumber", "message")


@check("""
SELECT event_id, epoch_us(ts) // 1000 AS eventDate FROM events
WHERE epoch_us(ts) // 1000 >= 1704844800000 ORDER BY ts, event_id LIMIT 2000
""")
def q_since_limit(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events").select("event_id", millis("ts").alias("eventDate"), F.struct("ts", "event_id").alias("_ord"))
    return pages.first_arrived(pages.since(ev, 1704844800), 2000).drop("_ord")


# --------------------------------------------------------------------------
# Flattening and shaping
# --------------------------------------------------------------------------


@check("""
SELECT CAST(c_custkey AS VARCHAR) AS id, c_name AS "userName", CASE WHEN c_custkey % 5 = 0 THEN '' ELSE c_mktsegment END AS "displayName",
 CASE WHEN c_custkey % 3 = 0 THEN 'top' WHEN c_custkey % 4 = 0 THEN '' ELSE 'given ' || c_nationkey END AS "firstName",
 CASE WHEN c_custkey % 4 = 1 THEN '' ELSE 'family ' || c_nationkey END AS "lastName" FROM customer
""")
def q_user_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("c_custkey")
    landed = table(spark, sf_dir, "customer").select(
        key.cast("string").alias("id"), F.col("c_name").alias("userName"),
        F.when(key % 5 != 0, F.col("c_mktsegment")).alias("displayName"),
        F.when(key % 3 == 0, "top").alias("firstName"), F.lit(None).cast("string").alias("lastName"),
        F.struct(
            F.when(key % 4 != 0, F.concat(F.lit("given "), F.col("c_nationkey"))).alias("givenName"),
            F.when(key % 4 != 1, F.concat(F.lit("family "), F.col("c_nationkey"))).alias("familyName"),
        ).alias("name"),
    )
    return normalize.lift_user_name(landed)


@check("""
SELECT CAST(p_partkey AS VARCHAR) AS id, p_name AS name,
 CASE WHEN p_size % 3 = 0 THEN p_type WHEN p_size % 3 = 1 THEN p_brand ELSE '' END AS type FROM part
""")
def q_action_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    size = F.col("p_size")
    landed = table(spark, sf_dir, "part").select(
        F.col("p_partkey").cast("string").alias("id"), F.col("p_name").alias("name"),
        F.when(size % 3 == 0, F.col("p_type")).alias("actionType"), F.when(size % 3 != 2, F.col("p_brand")).alias("type"),
    )
    return normalize.action_kind(landed)


@check("""
SELECT 'S' || s_suppkey AS "integrationId", s_name AS name, 'W' || s_nationkey AS "workspaceId",
 CASE WHEN s_suppkey % 2 = 0 THEN 'by ' || s_nationkey END AS "latestRun.triggeredBy",
 CASE WHEN s_suppkey % 2 = 0 THEN CASE WHEN s_nationkey > 10 THEN 'true' ELSE 'false' END END AS "latestRun.success",
 n_name AS "schedule.name", CAST(n_regionkey AS VARCHAR) AS "schedule.type"
FROM supplier JOIN nation ON s_nationkey = n_nationkey
""")
def q_nested_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = table(spark, sf_dir, "supplier").join(table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))

    def filled(names: list[str], given: dict[str, Column]) -> Column:
        return F.struct(*[given.get(n, F.lit(None).cast("string")).alias(n) for n in names])

    run = filled(schemas.RUN_FIELDS, {
        "triggeredBy": F.concat(F.lit("by "), F.col("s_nationkey")), "success": F.col("s_nationkey") > 10})
    landed = joined.select(
        *[F.lit(None).cast("string").alias(n) for n in schemas.INTEGRATION_FIELDS if n not in ("integrationId", "name", "workspaceId")],
        tagged("S", "s_suppkey").alias("integrationId"), F.col("s_name").alias("name"), tagged("W", "s_nationkey").alias("workspaceId"),
        F.when(F.col("s_suppkey") % 2 == 0, run).alias("latestRun"),
        filled(schemas.SCHEDULE_FIELDS, {"name": F.col("n_name"), "type": F.col("n_regionkey")}).alias("schedule"),
    )
    flat = normalize.flatten_integrations(landed)
    kept = ["integrationId", "name", "workspaceId", "latestRun.triggeredBy", "latestRun.success", "schedule.name", "schedule.type"]
    return flat.select(*[F.col(f"`{c}`") for c in kept])


@check("""
SELECT c_custkey, CAST(to_json({'name': c_name, 'nation': c_nationkey}) AS VARCHAR) AS profile,
 CAST(to_json([c_mktsegment, c_name]) AS VARCHAR) AS labels FROM customer
""")
def q_nested_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    return normalize.nested_to_json(table(spark, sf_dir, "customer").select(
        "c_custkey", F.struct(F.col("c_name").alias("name"), F.col("c_nationkey").alias("nation")).alias("profile"),
        F.array("c_mktsegment", "c_name").alias("labels"),
    ))


@check("""
SELECT 'M' || p_partkey AS id, p_name AS name, 'W' || (p_size % 25) AS "workspaceId", CAST(p_size AS BIGINT) AS "memoryUsage",
 TRUE AS url_missing, FALSE AS has_category_values FROM part
""")
def q_meta_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "part").select(
        tagged("M", "p_partkey").alias("id"), F.col("p_name").alias("name"), F.col("p_size").alias("memoryUsage"),
        F.create_map(F.lit("k"), F.col("p_brand")).alias("categoryValues"), tagged("W", F.col("p_size") % 25).alias("workspaceId"),
    )
    empty = empty_table(spark, schemas.MODELS)
    shaped = empty.unionByName(normalize.to_schema(rows, schemas.MODELS), allowMissingColumns=True)
    return shaped.select(
        "id", "name", "workspaceId", "memoryUsage", F.col("modelUrl").isNull().alias("url_missing"),
        F.lit("categoryValues" in shaped.columns).alias("has_category_values"),
    )


@check("""
SELECT 'A' || l_orderkey || '.' || l_linenumber AS id, 'W' || (l_suppkey % 25) AS workspace_id, 'M' || l_partkey AS model_id,
 coalesce(n_name, '') AS workspace_name, coalesce(p_name, '') AS model_name
FROM lineitem LEFT JOIN (SELECT * FROM nation WHERE n_regionkey < 4) ON l_suppkey % 25 = n_nationkey
LEFT JOIN (SELECT * FROM part WHERE p_size <= 40) ON l_partkey = p_partkey
""")
def q_provenance(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem").select(
        F.concat(F.lit("A"), F.col("l_orderkey"), F.lit("."), F.col("l_linenumber")).alias("id"),
        tagged("W", F.col("l_suppkey") % 25).alias("workspace_id"), tagged("M", "l_partkey").alias("model_id"),
    )
    ws = table(spark, sf_dir, "nation").where("n_regionkey < 4").select(tagged("W", "n_nationkey").alias("id"), F.col("n_name").alias("name"))
    mo = table(spark, sf_dir, "part").where("p_size <= 40").select(tagged("M", "p_partkey").alias("id"), F.col("p_name").alias("name"))
    return normalize.with_provenance(rows, ws, mo)


# --------------------------------------------------------------------------
# Attributes
# --------------------------------------------------------------------------

ATTR_TEXT_SQL = """CASE event_type WHEN 'signup' THEN props
 WHEN 'purchase' THEN '  {"appId":"app-' || k || '","appName":"App ' || k || '","pageId":' || k || ',"pageName":"P","active":true,"roleId":"r' || k || '"} '
 WHEN 'view' THEN '{"actionId":"a' || k || '","nested":{"x":' || k || ',"y":{"z":"q"}},"roleName":null,"actionName":false}'
 WHEN 'click' THEN CASE WHEN event_id % 2 = 0 THEN 'bare ' || k ELSE '{"appId":"x"} tail' END
 ELSE CASE WHEN event_id % 3 = 0 THEN '[1,2]' WHEN event_id % 3 = 1 THEN '{}' END END"""


def attribute_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with an attribute text that is an object, malformed, empty or absent."""
    ev = table(spark, sf_dir, "events").withColumn("k", number_k())
    return ev.withColumn("additionalAttributes", F.expr(ATTR_TEXT_SQL))


ATTR_SQL = f"""WITH t AS (SELECT *, props->>'$.k' AS k FROM events),
s AS (SELECT *, trim({ATTR_TEXT_SQL}) AS txt FROM t),
p AS (SELECT *, CASE WHEN json_valid(txt) AND json_type(txt) = 'OBJECT' THEN txt::JSON END AS j FROM s)
"""


@check(ATTR_SQL + """
SELECT event_id, j->>'$.k' AS attr_k, j->>'$.appId' AS attr_app_id, j->>'$.pageId' AS attr_page_id,
 CASE j->>'$.active' WHEN 'true' THEN '1' WHEN 'false' THEN '0' END AS attr_active,
 j->>'$.nested.x' AS attr_x, j->>'$.nested.y.z' AS attr_z,
 CASE event_type WHEN 'signup' THEN 1 WHEN 'purchase' THEN 6 WHEN 'view' THEN 5
  WHEN 'error' THEN CASE WHEN event_id % 3 = 1 THEN 0 END END AS n_keys
FROM p
""")
def q_attr_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = attributes.with_attributes(attribute_events(spark, sf_dir), retain_raw=False)
    at = {"attr_k": "k", "attr_app_id": "appId", "attr_page_id": "pageId", "attr_active": "active", "attr_x": "nested.x", "attr_z": "nested.y.z"}
    size = F.when(F.col("attrs").isNotNull(), F.size("attrs"))
    return rows.select("event_id", *[F.element_at("attrs", k).alias(c) for c, k in at.items()], size.alias("n_keys"))


_LIFTED_SQL = ", ".join(
    f"CASE WHEN json_type(j, '$.{k}') = 'BOOLEAN' THEN upper(left(j->>'$.{k}', 1)) || substr(j->>'$.{k}', 2) ELSE j->>'$.{k}' END AS {c}"
    for k, c in fixed.ATTRIBUTE_COLUMNS.items() if k in ("appId", "appName", "pageId", "pageName", "actionId", "actionName", "roleId")
)
_LIFTED = ["app_id", "app_name", "page_id", "page_name", "action_id", "action_name", "role_id"]


@check(ATTR_SQL + f"SELECT event_id, {_LIFTED_SQL} FROM p")
def q_attr_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = attributes.with_attributes(attribute_events(spark, sf_dir))
    return rows.select("event_id", *_LIFTED)


@check(ATTR_SQL + """SELECT event_id, j->>'$.appId' AS app_id, j->>'$.appName' AS app_name,
 FALSE AS action_set, FALSE AS role_set FROM p""")
def q_attr_gating(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = attributes.with_attributes(attribute_events(spark, sf_dir), categories=["uxAppPage", "unknown"])
    return rows.select("event_id", "app_id", "app_name", F.col("action_id").isNotNull().alias("action_set"),
                       F.col("role_id").isNotNull().alias("role_set"))


@check(ATTR_SQL + """
SELECT event_id, CASE event_type WHEN 'signup' THEN '{"k":' || k || '}'
 WHEN 'purchase' THEN '{"active":true,"appId":"app-' || k || '","appName":"App ' || k || '","pageId":' || k || ',"pageName":"P","roleId":"r' || k || '"}'
 WHEN 'view' THEN '{"actionId":"a' || k || '","actionName":false,"nested":{"x":' || k || ',"y":{"z":"q"}},"roleName":null}' END AS additional_attributes_raw
FROM p
""")
def q_attr_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return attributes.with_attributes(attribute_events(spark, sf_dir)).select("event_id", "additional_attributes_raw")


@check(ATTR_SQL + """
SELECT event_type, count(*) AS events_processed,
 count(*) FILTER (coalesce(j->>'$.appId', j->>'$.pageId', j->>'$.actionId', j->>'$.actionName', j->>'$.roleId') IS NOT NULL) AS events_with_values
FROM p GROUP BY event_type
""")
def q_attr_yield_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = attributes.with_attributes(attribute_events(spark, sf_dir), retain_raw=False)
    return rows.groupBy("event_type").agg(
        F.count(F.lit(1)).alias("events_processed"), F.count_if(attributes.yields_value()).alias("events_with_values"))


@check("SELECT event_id, CASE WHEN value > 20 THEN 1 ELSE 0 END AS success, CASE WHEN value > 20 THEN '1' ELSE '0' END AS success_text FROM events")
def q_bool_to_int(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").select("event_id", (F.col("value") > 20).alias("success"))
    kind = rows.schema["success"].dataType
    return rows.select("event_id", text.flag(F.col("success")).alias("success"), normalize.bool_to_text(F.col("success"), kind).alias("success_text"))


# --------------------------------------------------------------------------
# Categories and catalogue
# --------------------------------------------------------------------------


@check(f"""
SELECT o_orderkey, CASE split_part(o_orderpriority, '-', 1) WHEN '1' THEN 'FIRST' WHEN '2' THEN 'SECOND' WHEN '3' THEN 'THIRD' ELSE 'UNCATEGORIZED' END AS category,
 'UNCATEGORIZED' AS event_category FROM orders
""")
def q_taxonomy(spark: SparkSession, sf_dir: str) -> DataFrame:
    taxonomy.register_sql_functions(spark)
    names = {"1": "FIRST", "2": "SECOND", "3": "THIRD"}
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", taxonomy.category_lookup(F.col("o_orderpriority"), names, fixed.UNCATEGORIZED[1]).alias("category"),
        F.expr("event_parent_name(o_orderpriority)").alias("event_category"),
    )


@check(f"""
WITH c AS (SELECT CASE event_type WHEN 'signup' THEN 'USR' WHEN 'purchase' THEN 'INT' WHEN 'view' THEN 'WF' WHEN 'click' THEN 'AUTHZ' ELSE 'UNCAT' END AS code, count(*) AS n FROM events GROUP BY 1),
s(code, name) AS (VALUES ('AUTHZ','ACCESS CONTROL'),('CONN','SAML CONNECTION'),('DSM','ENCRYPTION ACTIVITY'),('INT','INTEGRATION'),('PIQ','PLANIQ'),
 ('FRCST','FORECASTER'),('USR','USER ACTIVITY'),('WF','WORKFLOW'),('OAUTH','OAUTH'),('COMMENT','COMMENT'),('UNCAT','UNCATEGORIZED'))
SELECT s.code AS "Code", s.name AS "Name", 'All Events' AS "Parent", coalesce(n, 0) AS n_events FROM s LEFT JOIN c ON s.code = c.code
""")
def q_category_seed(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = (
        table(spark, sf_dir, "events").groupBy(taxonomy.event_parent_code(event_code()).alias("Code"))
        .agg(F.count(F.lit(1)).alias("n_events"))
    )
    return taxonomy.category_seed(spark).join(counts, "Code", "left").withColumn("n_events", F.coalesce("n_events", F.lit(0).cast("long")))


@check(f"""
WITH s(position, code, message) AS (VALUES (1,'USR-1','User created'),(2,'INT-2','Integration run'),(3,'AUTHZ-4','Role changed')),
o AS (SELECT DISTINCT {CODE_SQL} AS code FROM events),
n AS (SELECT 3 + row_number() OVER (ORDER BY code) AS position, code FROM o WHERE code NOT IN (SELECT code FROM s))
SELECT position, code AS "Event Code", message AS "Event Message",
 CASE upper(trim(split_part(code, '-', 1))) WHEN 'USR' THEN 'USR' WHEN 'INT' THEN 'INT' WHEN 'AUTHZ' THEN 'AUTHZ' WHEN 'WF' THEN 'WF' ELSE 'UNCAT' END AS "Parent Code",
 CASE upper(trim(split_part(code, '-', 1))) WHEN 'USR' THEN 'USER ACTIVITY' WHEN 'INT' THEN 'INTEGRATION' WHEN 'AUTHZ' THEN 'ACCESS CONTROL' WHEN 'WF' THEN 'WORKFLOW' ELSE 'UNCATEGORIZED' END AS "Parent",
 coalesce(message, code) AS "Event Name"
FROM (SELECT CAST(position AS BIGINT) AS position, code, message FROM s UNION ALL SELECT CAST(position AS BIGINT), code, NULL FROM n)
""")
def q_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    listed = ordinals.number_rows(
        code_table(spark).withColumn("_at", F.array_position(F.array(*[F.lit(c) for c in ("USR-1", "INT-2", "AUTHZ-4")]), F.col("Event Code"))),
        ["_at"], "position",
    ).drop("_at")
    seen = table(spark, sf_dir, "events").select(event_code().alias("eventTypeId"))
    full = catalog.with_catalog_columns(catalog.complete_catalog(listed, seen))
    return full.select("position", "Event Code", "Event Message", "Parent Code", "Parent", "Event Name")


@check("""
WITH p AS (SELECT p_partkey, CASE WHEN p_partkey % 7 = 0 THEN '' WHEN p_partkey % 11 = 0 THEN repeat(p_name, 8) ELSE ' ' || p_name || ' ' || (p_partkey % 500) END AS msg FROM part),
q AS (SELECT *, trim(msg) AS m, row_number() OVER (PARTITION BY trim(msg) ORDER BY p_partkey) AS rn FROM p)
SELECT p_partkey, CASE WHEN m <> '' AND length(m) <= 60 AND rn = 1 THEN m ELSE CAST(p_partkey AS VARCHAR) END AS event_name FROM q
""")
def q_event_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    message = (
        F.when(F.col("p_partkey") % 7 == 0, "").when(F.col("p_partkey") % 11 == 0, F.repeat("p_name", F.lit(8)))
        .otherwise(F.concat(F.lit(" "), F.col("p_name"), F.lit(" "), F.col("p_partkey") % 500))
    )
    rows = table(spark, sf_dir, "part").select("p_partkey", message.alias("msg"))
    return catalog.assign_names(rows, "p_partkey", "msg", "p_partkey", "event_name").select("p_partkey", "event_name")


# --------------------------------------------------------------------------
# Lists and scope
# --------------------------------------------------------------------------


@check("""
SELECT DISTINCT 'app-' || (props->>'$.k') AS code, 'App ' || event_type AS name FROM events WHERE event_type <> 'click' AND event_type <> 'view'
""")
def q_list_flat(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").select(
        F.when(F.col("event_type") != "click", F.concat(F.lit("app-"), number_k())).otherwise("").alias("app_id"),
        F.when(F.col("event_type") != "view", F.concat(F.lit("App "), F.col("event_type"))).alias("app_name"),
    )
    return lists.distinct_list(rows, "app_id", "app_name")


@check("""
SELECT DISTINCT CAST(c_nationkey AS VARCHAR) AS code, n_name AS name, r_name AS parent_code
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey WHERE n_regionkey <> 0
""")
def q_list_hier(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    rows = (
        table(spark, sf_dir, "customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        .select(F.col("c_nationkey").cast("string").alias("page_id"), F.col("n_name").alias("page_name"),
                F.when(F.col("n_regionkey") != 0, F.col("r_name")).otherwise("").alias("app_id"))
    )
    return lists.distinct_list(rows, "page_id", "page_name", "app_id")


@check("""
SELECT 'S' || s_suppkey AS id, s_name AS name, 'G' || s_nationkey AS "lastModifiedByUserGuid",
 n_name AS "lastModifiedByEmail", CAST(n_regionkey AS VARCHAR) AS "lastModifiedByDisplayName", CAST(s_suppkey AS BIGINT) AS "memoryUsage"
FROM supplier LEFT JOIN (SELECT * FROM nation WHERE n_regionkey < 3) ON s_nationkey = n_nationkey
""")
def q_models_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "supplier").select(
        tagged("S", "s_suppkey").alias("id"), F.col("s_name").alias("name"), tagged("G", "s_nationkey").alias("lastModifiedByUserGuid"),
        F.col("s_suppkey").alias("memoryUsage"))
    who = table(spark, sf_dir, "nation").where("n_regionkey < 3").select(
        tagged("G", "n_nationkey").alias("id"), F.col("n_name").alias("userName"), F.col("n_regionkey").cast("string").alias("displayName"))
    out = lists.models_with_modifier(normalize.to_schema(rows, schemas.MODELS), who)
    return out.select("id", "name", "lastModifiedByUserGuid", "lastModifiedByEmail", "lastModifiedByDisplayName", "memoryUsage")


@check("""
SELECT event_id, u.c_custkey AS actor_key, o.c_custkey AS object_key, o.c_mktsegment AS object_segment
FROM (SELECT *, lower('Customer#' || lpad(CAST(user_id AS VARCHAR), 9, '0')) AS actor,
 CASE WHEN event_type <> 'view' THEN 'CUSTOMER#' || lpad(CAST(user_id * 13 AS VARCHAR), 9, '0') END AS object FROM events) e
LEFT JOIN customer u ON upper(actor) = upper(u.c_name) LEFT JOIN customer o ON upper(object) = upper(o.c_name)
""")
def q_ci_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    def named(col: Column) -> Column:
        return F.concat(F.lit("Customer#"), F.lpad(col.cast("string"), 9, "0"))

    facts = table(spark, sf_dir, "events").select(
        "event_id", F.lower(named(F.col("user_id"))).alias("actor"),
        F.when(F.col("event_type") != "view", F.upper(named(F.col("user_id") * 13))).alias("object"))
    who = table(spark, sf_dir, "customer")
    rows = joins.lookup(facts, who, F.upper("actor"), F.upper("c_name"), {"c_custkey": "actor_key"}, F.col("event_id"))
    rows = joins.lookup(rows, who, F.upper("object"), F.upper("c_name"), {"c_custkey": "object_key", "c_mktsegment": "object_segment"}, F.col("event_id"))
    return rows.select("event_id", "actor_key", "object_key", "object_segment")


@check("""
WITH o AS (SELECT o_orderkey, 'x' || (o_orderkey % 3000) AS oid FROM orders)
SELECT o_orderkey, CASE WHEN p_partkey IS NOT NULL THEN 'X' || p_partkey WHEN s_suppkey IS NOT NULL THEN 'X' || (s_suppkey + 1) END AS model_id,
 CASE WHEN p_partkey IS NOT NULL THEN p_name WHEN s_suppkey IS NOT NULL THEN (SELECT p2.p_name FROM part p2 WHERE p2.p_partkey = s_suppkey + 1 AND p2.p_size < 30) END AS model_name,
 CASE WHEN p_partkey IS NOT NULL THEN 'Model' WHEN s_suppkey IS NOT NULL THEN 'CloudWorks Integration' WHEN c_custkey IS NOT NULL THEN 'User' END AS object_type,
 CASE WHEN p_partkey IS NOT NULL THEN p_name WHEN s_suppkey IS NOT NULL THEN s_name WHEN c_custkey IS NOT NULL THEN c_name END AS object_name
FROM o LEFT JOIN (SELECT * FROM part WHERE p_size < 30) p ON upper(oid) = 'X' || p_partkey LEFT JOIN supplier ON upper(oid) = 'X' || s_suppkey
LEFT JOIN customer ON upper(oid) = 'X' || c_custkey
""")
def q_case_resolve(spark: SparkSession, sf_dir: str) -> DataFrame:
    mo = table(spark, sf_dir, "part").where("p_size < 30").select(tagged("X", "p_partkey").alias("id"), F.col("p_name").alias("name"))
    cw = table(spark, sf_dir, "supplier").select(tagged("X", "s_suppkey").alias("integrationId"), F.col("s_name").alias("name"), tagged("X", F.col("s_suppkey") + 1).alias("modelId"))
    us = table(spark, sf_dir, "customer").select(tagged("X", "c_custkey").alias("id"), F.col("c_name").alias("userName"))
    objects = audit.object_dimension(mo, cw, us)
    facts = table(spark, sf_dir, "orders").select("o_orderkey", tagged("x", F.col("o_orderkey") % 3000).alias("oid"))
    rows = joins.lookup(facts, objects, F.upper("oid"), F.col("_okey"), {c: c for c in objects.columns if c != "_okey"}, F.col("o_orderkey"))
    absent = F.lit(None).cast("string")
    model_id, model_name = audit.resolved_model(absent, absent)
    kind, name = audit.resolved_object()
    return rows.select("o_orderkey", model_id.alias("model_id"), model_name.alias("model_name"), kind.alias("object_type"), name.alias("object_name"))


@check("""
SELECT l_orderkey, l_linenumber, a.name AS action_name FROM lineitem
LEFT JOIN (SELECT DISTINCT 'a' || l_partkey AS id, 'm' || l_suppkey AS model_id, 'act ' || l_partkey || '/' || l_suppkey AS name FROM lineitem WHERE l_returnflag = 'R') a
ON upper(CASE WHEN l_linenumber <> 2 THEN 'A' || l_partkey END || ('M' || l_suppkey)) = upper(a.id || a.model_id)
""")
def q_composite_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    acts = li.where("l_returnflag = 'R'").select(
        tagged("a", "l_partkey").alias("id"), tagged("m", "l_suppkey").alias("model_id"),
        F.concat(F.lit("act "), F.col("l_partkey"), F.lit("/"), F.col("l_suppkey")).alias("name")).distinct()
    facts = li.select("l_orderkey", "l_linenumber", F.when(F.col("l_linenumber") != 2, tagged("A", "l_partkey")).alias("aid"), tagged("M", "l_suppkey").alias("oid"))
    rows = joins.lookup(facts, acts, F.upper(F.concat("aid", "oid")), F.upper(F.concat("id", "model_id")), {"name": "action_name"}, F.col("l_orderkey"))
    return rows.select("l_orderkey", "l_linenumber", "action_name")


@check("""
SELECT l_orderkey, l_linenumber, CASE WHEN aid = '-1' THEN 'Unsaved Action' WHEN p_name IS NULL AND aid IS NOT NULL THEN '<Object has been Deleted>' ELSE p_name END AS action_name
FROM (SELECT *, CASE l_linenumber WHEN 1 THEN '-1' WHEN 2 THEN NULL ELSE CAST(l_partkey AS VARCHAR) END AS aid FROM lineitem)
LEFT JOIN part ON aid = CAST(p_partkey AS VARCHAR) AND p_size > 10
""")
def q_deleted_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    aid = F.when(F.col("l_linenumber") == 1, "-1").when(F.col("l_linenumber") != 2, F.col("l_partkey").cast("string"))
    facts = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", aid.alias("aid"))
    acts = table(spark, sf_dir, "part").where("p_size > 10")
    rows = joins.lookup(facts, acts, F.col("aid"), F.col("p_partkey").cast("string"), {"p_name": "p_name"}, F.col("l_orderkey"))
    return rows.select("l_orderkey", "l_linenumber", audit.action_label(F.col("aid"), F.col("p_name")).alias("action_name"))


@check("""
SELECT 'S' || s_suppkey AS integration_id, (SELECT n.n_name FROM nation n WHERE n.n_nationkey = s_nationkey AND n.n_regionkey <> 2) AS model_name FROM supplier
""")
def q_scalar_sub(spark: SparkSession, sf_dir: str) -> DataFrame:
    mo = table(spark, sf_dir, "nation").where("n_regionkey <> 2").select(tagged("N", "n_nationkey").alias("id"), F.col("n_name").alias("name"))
    cw = table(spark, sf_dir, "supplier").select(tagged("S", "s_suppkey").alias("integrationId"), F.col("s_name").alias("name"), tagged("N", "s_nationkey").alias("modelId"))
    us = table(spark, sf_dir, "customer").select(tagged("C", "c_custkey").alias("id"), F.col("c_name").alias("userName"))
    objects = audit.object_dimension(mo, cw, us).where("_cw_id IS NOT NULL")
    return objects.select(F.col("_cw_id").alias("integration_id"), F.col("_cw_model_name").alias("model_name"))


@check("""
WITH p AS (SELECT DISTINCT s_nationkey AS nation, CASE WHEN s_suppkey % 2 = 0 THEN 'BUILDING' ELSE 'MACHINERY' END AS segment FROM supplier)
SELECT c_custkey, CASE WHEN EXISTS (SELECT 1 FROM p WHERE nation = c_nationkey AND segment = c_mktsegment) THEN 'select' ELSE 'skip' END AS mode FROM customer
""")
def q_scope(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "customer").select("c_custkey", F.col("c_nationkey").alias("nation"), F.col("c_mktsegment").alias("segment"))
    pairs = table(spark, sf_dir, "supplier").select(
        F.col("s_nationkey").alias("nation"), F.when(F.col("s_suppkey") % 2 == 0, "BUILDING").otherwise("MACHINERY").alias("segment"))
    chosen = lists.in_scope(rows, pairs, ["nation", "segment"]).withColumn("mode", F.lit("select"))
    rest = lists.in_scope(rows, pairs, ["nation", "segment"], select=False).withColumn("mode", F.lit("skip"))
    return chosen.unionByName(rest).select("c_custkey", "mode")


@check("SELECT o_custkey, min(o_orderkey) AS first_position FROM orders GROUP BY o_custkey")
def q_first_seen(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lists.first_seen(table(spark, sf_dir, "orders"), "o_custkey", F.col("o_orderkey"))


@check("""
WITH r AS (SELECT s_suppkey, CASE s_suppkey % 4 WHEN 0 THEN 'N' || s_nationkey WHEN 1 THEN n_name WHEN 2 THEN lower(n_name) ELSE 'nowhere' END AS ref
 FROM supplier JOIN nation ON s_nationkey = n_nationkey)
SELECT s_suppkey, ref, (SELECT 'N' || n_nationkey FROM nation WHERE 'N' || n_nationkey = ref OR lower(n_name) = lower(ref)) AS resolved_id FROM r
""")
def q_resolve_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = table(spark, sf_dir, "nation")
    key = F.col("s_suppkey") % 4
    refs = table(spark, sf_dir, "supplier").join(nation, F.col("s_nationkey") == F.col("n_nationkey")).select(
        "s_suppkey", F.when(key == 0, tagged("N", "s_nationkey")).when(key == 1, F.col("n_name")).when(key == 2, F.lower("n_name"))
        .otherwise("nowhere").alias("ref"))
    known = nation.select(tagged("N", "n_nationkey").alias("id"), F.col("n_name").alias("name"), F.col("n_nationkey").alias("position"))
    return lists.resolve_names(refs, known, "ref", "resolved_id")


@check("""
WITH o AS (SELECT DISTINCT 'K' || (props->>'$.k') AS code FROM events WHERE event_type <> 'view'),
x AS (SELECT 'K' || s_suppkey AS code, 'K' || (s_suppkey + 40) AS name FROM supplier WHERE s_suppkey < 20)
SELECT code, code AS name FROM o WHERE code NOT IN (SELECT code FROM x) AND code NOT IN (SELECT name FROM x)
""")
def q_list_sync(spark: SparkSession, sf_dir: str) -> DataFrame:
    wide = table(spark, sf_dir, "events").select(
        F.when(F.col("event_type") != "view", F.concat(F.lit("K"), number_k())).alias("EVENT_ID"))
    existing = table(spark, sf_dir, "supplier").where("s_suppkey < 20").select(
        tagged("K", "s_suppkey").alias("code"), tagged("K", F.col("s_suppkey") + 40).alias("name"))
    return publish.new_list_items(spark, wide, {"codes": "EVENT_ID", "other": "NO_COLUMN"}, {"codes": existing, "other": existing})["codes"]


# --------------------------------------------------------------------------
# Upserts
# --------------------------------------------------------------------------


def halves(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Last event per user before and after a date: stored rows and a batch."""
    ev = table(spark, sf_dir, "events").withColumn("user_key", F.when(F.col("user_id") % 5 == 0, F.col("user_id") + F.dayofmonth("ts") * 1000).otherwise(F.col("user_id")))
    ev = ev.select("user_key", "event_id", "event_type", "value", "ts")
    old = upsert.last_wins(ev.where(F.col("ts") < F.lit(SPLIT).cast("timestamp_ntz")), "user_key", ["ts", "event_id"]).drop("ts")
    new = upsert.last_wins(ev.where(F.col("ts") >= F.lit(SPLIT).cast("timestamp_ntz")), "user_key", ["ts", "event_id"]).drop("ts")
    return old, new


HALVES_SQL = f"""WITH k AS (SELECT *, CASE WHEN user_id % 5 = 0 THEN user_id + day(ts) * 1000 ELSE user_id END AS user_key FROM events),
h AS (SELECT *, ts >= TIMESTAMP '{SPLIT}' AS later FROM k),
l AS (SELECT * FROM h QUALIFY row_number() OVER (PARTITION BY user_key, later ORDER BY ts DESC, event_id DESC) = 1),
old AS (SELECT user_key, event_id, event_type, value FROM l WHERE NOT later),
new AS (SELECT user_key, event_id, event_type, value FROM l WHERE later)
"""
_KEY = "coalesce(new.user_key, old.user_key) AS user_key"
_FULL = "FROM old FULL OUTER JOIN new ON old.user_key = new.user_key"


@check(HALVES_SQL + f"""SELECT {_KEY}, coalesce(new.event_id, old.event_id) AS event_id, coalesce(new.event_type, old.event_type) AS event_type,
 CASE WHEN new.user_key IS NOT NULL THEN new.value ELSE old.value END AS value {_FULL}""")
def q_upsert_last_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    old, new = halves(spark, sf_dir)
    return upsert.merge_rows(old, new, "user_key")


@check(HALVES_SQL + f"""SELECT {_KEY}, coalesce(new.event_id, old.event_id) AS event_id, coalesce(new.event_type, old.event_type) AS event_type, old.value AS value {_FULL}""")
def q_upsert_subset(spark: SparkSession, sf_dir: str) -> DataFrame:
    old, new = halves(spark, sf_dir)
    return upsert.merge_rows(old, new.drop("value"), "user_key")


@check(HALVES_SQL + "SELECT * FROM old UNION ALL SELECT * FROM new WHERE user_key NOT IN (SELECT user_key FROM old)")
def q_upsert_insert_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    old, new = halves(spark, sf_dir)
    return upsert.merge_rows(old, new, "user_key", update=[])


@check(HALVES_SQL + f"""SELECT {_KEY}, coalesce(old.event_id, new.event_id) AS event_id, coalesce(new.event_type, old.event_type) AS event_type,
 coalesce(old.value, new.value) AS value {_FULL}""")
def q_upsert_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    old, new = halves(spark, sf_dir)
    return upsert.merge_rows(old, new, "user_key", update=["event_type"])


@check("""
WITH b AS (SELECT *, props->>'$.k' AS k, CASE WHEN ts < TIMESTAMP '2024-01-11' THEN 1 WHEN ts < TIMESTAMP '2024-01-21' THEN 2 ELSE 3 END AS batch FROM events),
l AS (SELECT * FROM b QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY batch DESC, event_id DESC) = 1),
m AS (SELECT * FROM b WHERE batch = 2 QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) = 1)
SELECT CAST(l.user_id AS VARCHAR) AS id, l.event_type AS message, CAST(l.event_id AS VARCHAR) AS checksum, CASE WHEN m.event_type <> 'view' THEN 'r' || m.k END AS region,
 m.event_type AS "context.kind", CASE WHEN m.value > 50 THEN '1' WHEN m.value IS NOT NULL THEN '0' END AS "context.high", 0 AS fields_before, 3 AS fields_after
FROM l LEFT JOIN m ON l.user_id = m.user_id
""")
def q_schema_evolve(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second of three landed batches brings fields that nobody declared."""
    ev = table(spark, sf_dir, "events")
    store, landing = EventStore(spark, shared_dir(spark, "evolve")), shared_dir(spark, "evolve-landing")
    declared = [F.col("event_id").alias("checksum"), F.col("user_id").alias("id"), millis("ts").alias("eventDate"), F.col("event_type").alias("message")]
    more = [F.when(F.col("event_type") != "view", F.concat(F.lit("r"), number_k())).alias("region"),
            F.struct(F.col("event_type").alias("kind"), (F.col("value") > 50).alias("high")).alias("context")]
    borders = [None, "2024-01-11", "2024-01-21", None]
    for i in range(3):
        low, high = (F.lit(b).cast("timestamp_ntz") if b else None for b in borders[i : i + 2])
        batch = ev if low is None else ev.where(F.col("ts") >= low)
        batch = batch if high is None else batch.where(F.col("ts") < high)
        event = F.struct(*declared, *(more if i == 1 else []))
        paged = batch.groupBy(F.floor(F.col("event_id") / 500).alias("page")).agg(F.array_sort(F.collect_list(event)).alias("response"))
        folder = f"{landing}/batch={i}"
        paged.repartitionByRange(8, "page").sortWithinPartitions("page").select("response").write.json(folder)
        store.load(prepare_events(pages.read_pages(spark, folder, "events")))
    found = store.read().select("id", "message", "checksum", "region", "`context.kind`", "`context.high`")
    return found.withColumns({"fields_before": F.lit(len(store.fields(1))), "fields_after": F.lit(len(store.fields()))})


@check(HALVES_SQL + f"""SELECT {_KEY}, coalesce(new.event_id, old.event_id) AS event_id, coalesce(new.event_type, old.event_type) AS event_type,
 CASE WHEN new.user_key IS NOT NULL THEN new.value ELSE old.value END AS value,
 CASE WHEN new.user_key IS NOT NULL THEN 'app ' || new.event_type END AS app_name, 4 AS columns_before {_FULL}""")
def q_column_evolve(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A batch with a column that the stored table lacks; the version before it still reads as it was."""
    old, new = halves(spark, sf_dir)
    snap = SnapshotTable(spark, shared_dir(spark, "columns"), old.schema, "user_key", by_bucket("user_key", 8), moves=False)
    snap.upsert(old)
    snap.upsert(new.withColumn("app_name", F.concat(F.lit("app "), F.col("event_type"))), evolve=True)
    return snap.read().withColumn("columns_before", F.lit(len(snap.read(1).columns)))


@check(HALVES_SQL + f"""SELECT {_KEY}, coalesce(new.event_id, old.event_id) AS event_id, coalesce(new.event_type, old.event_type) AS event_type,
 CASE WHEN new.user_key IS NOT NULL THEN new.value ELSE old.value END AS value, true AS index_read {_FULL}""")
def q_upsert_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys that change their part, found by the key index."""
    old, new = halves(spark, sf_dir)
    by_type = lambda: F.col("event_type")
    snap = SnapshotTable(spark, shared_dir(spark, "indexed"), old.schema, "user_key", by_type, index_rows=100)
    snap.upsert(old)
    snap.upsert(new)
    return snap.read().withColumn("index_read", F.lit(snap.last.get("index_rows_read", 0) > 0))


@check(HALVES_SQL + f"""SELECT {_KEY}, CASE WHEN new.user_key IS NULL THEN 'o' || old.event_id ELSE CASE WHEN new.event_type <> 'view' THEN 'n' || new.event_id END END AS shared,
 'old' || old.event_id AS only_old, 'new' || new.event_id AS only_new {_FULL}""")
def q_upsert_attributes(spark: SparkSession, sf_dir: str) -> DataFrame:
    old, new = halves(spark, sf_dir)
    old = old.select("user_key", F.create_map(F.lit("shared"), tagged("o", "event_id"), F.lit("only_old"), tagged("old", "event_id")).alias("attrs"))
    new = new.select("user_key", F.create_map(
        F.lit("shared"), F.when(F.col("event_type") != "view", tagged("n", "event_id")), F.lit("only_new"), tagged("new", "event_id")).alias("attrs"))
    merged = upsert.merge_rows(old, new, "user_key", maps=upsert.attribute_keys(new))
    return merged.select("user_key", *[F.element_at("attrs", k).alias(k) for k in ("shared", "only_old", "only_new")])


# --------------------------------------------------------------------------
# Change history
# --------------------------------------------------------------------------


@check(r"""
SELECT p_partkey, trim(regexp_replace(regexp_replace(p_name || '/' || p_brand || ':' || p_type || ' ?', '[/\\:*?"<>|]', ' ', 'g'), ' {2,}', ' ', 'g')) AS model_name FROM part
""")
def q_clean_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = F.concat("p_name", F.lit("/"), "p_brand", F.lit(":"), "p_type", F.lit(" ?"))
    return table(spark, sf_dir, "part").select("p_partkey", text.clean_name(raw).alias("model_name"))


def description_of(priority: Column, key: Column, status: Column) -> Column:
    return (
        F.when(priority == "1-URGENT", "Add List").when(priority == "2-HIGH", F.concat(key.cast("string"), F.lit(" Item(s) Added")))
        .when(priority == "3-MEDIUM", "Bulk data change (add-in)").when(priority == "4-NOT SPECIFIED", F.concat(F.lit("Gap "), status, F.lit(" "), (key % 50).cast("string")))
        .otherwise("")
    )


DESCRIPTION_SQL = """CASE o_orderpriority WHEN '1-URGENT' THEN 'Add List' WHEN '2-HIGH' THEN o_orderkey || ' Item(s) Added'
 WHEN '3-MEDIUM' THEN 'Bulk data change (add-in)' WHEN '4-NOT SPECIFIED' THEN 'Gap ' || o_orderstatus || ' ' || (o_orderkey % 50) ELSE '' END"""


def change_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").withColumn(
        "description", description_of(F.col("o_orderpriority"), F.col("o_orderkey"), F.col("o_orderstatus")))


def land_exports(spark: SparkSession, sf_dir: str) -> str:
    """Write the orders as exports: tabs and a full header, or commas and a short one.

    A file holds one model's rows of one key range, so that none can grow large.
    """
    folder = shared_dir(spark, "exports")
    rows = change_orders(spark, sf_dir).withColumns({
        "workspace_id": tagged("w", F.floor(F.col("o_orderkey") / 50000)), "model": F.col("o_custkey") % 40})
    keys = ["workspace_id", "model_id"]
    rows = rows.withColumn("model_id", tagged("m", "model")).repartition(*keys).sortWithinPartitions(*keys, "o_orderkey")
    when = F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss")
    full = rows.where("model % 2 = 0").select(
        F.col("o_orderkey").alias("ID"), when.alias("Date/Time (UTC)"), tagged("user ", "o_custkey").alias("USER"), F.col("description").alias("Description"),
        F.concat(F.lit('old "'), F.col("o_orderstatus"), F.when(F.col("o_orderkey") % 3 == 0, F.lit('"\n\n"next')).otherwise(F.lit('"'))).alias("Previous Value"), F.col("o_orderpriority").alias("New Value"),
        F.concat(F.lit("a, b"), F.col("o_orderstatus")).alias("SKU"), tagged("t", "o_custkey").alias("Target User"), F.lit("x").alias("Unknown"), "workspace_id", "model_id")
    short = rows.where("model % 2 = 1").select(
        when.alias("date_time_utc"), tagged("user ", "o_custkey").alias("user"), F.col("description").alias("description"),
        F.concat(F.lit("m, "), F.col("o_orderstatus")).alias("Area"), "workspace_id", "model_id")
    options = {"header": True, "quote": '"', "escape": '"', "emptyValue": "", "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    for part, sep in ((full, "\t"), (short, ",")):
        part.write.mode("append").partitionBy("workspace_id", "model_id").options(sep=sep, **options).csv(folder)
    return folder


LABELS_SQL = """CASE WHEN description = 'Add List' THEN 'Add List' WHEN regexp_full_match(description, '\\d+ Item\\(s\\) Added') THEN 'x Item(s) Added'
 WHEN description = 'Bulk data change (add-in)' THEN description ELSE 'Model change (no details available)' END AS change_type,
 CASE WHEN description = 'Add List' OR regexp_full_match(description, '\\d+ Item\\(s\\) Added') THEN 'Module/List'
 WHEN description = 'Bulk data change (add-in)' THEN 'Line Item/Property' ELSE 'Other' END AS object_type"""

EXPORT_SQL = f"""WITH o AS (SELECT *, o_custkey % 40 AS model, {DESCRIPTION_SQL} AS description FROM orders),
n AS (SELECT *, 'm' || model AS model_id, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS date_time_utc, 'user ' || o_custkey AS usr,
 row_number() OVER (PARTITION BY model, o_orderkey // 50000 ORDER BY o_orderkey) - 1 AS ordinal FROM o)
"""


@check(EXPORT_SQL + f"""
SELECT substring(sha256(model_id || ':' || date_time_utc || ':' || usr || ':' || description || ':' || ordinal), 1, 16) AS record_id,
 CASE WHEN model % 2 = 0 THEN CAST(o_orderkey AS VARCHAR) ELSE '' END AS source_record_id, model_id, date_time_utc, usr AS "user", description,
 '' AS security_change, CASE WHEN model % 2 = 0 THEN 'old "' || o_orderstatus || CASE WHEN o_orderkey % 3 = 0 THEN '"' || chr(10) || chr(10) || '"next' ELSE '"' END ELSE '' END AS previous_value,
 CASE WHEN model % 2 = 0 THEN o_orderpriority ELSE '' END AS new_value,
 CASE WHEN model % 2 = 0 THEN 'x' ELSE 'm, ' || o_orderstatus END AS module_list, '' AS line_item_property,
 CASE WHEN model % 2 = 0 THEN 'a, b' || o_orderstatus ELSE '' END AS customer, '' AS "export", '' AS import_action, '' AS data_types, '' AS table_name, '' AS "object",
 CASE WHEN model % 2 = 0 THEN 't' || o_custkey ELSE '' END AS target_user, '{RUN_1}' AS captured_at, {LABELS_SQL} FROM n
""")
def q_history_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    return history.history_rows(spark, land_exports(spark, sf_dir), RUN_1)


@check(f"""
WITH o AS (SELECT *, {DESCRIPTION_SQL} AS description, row_number() OVER (ORDER BY o_orderkey) - 1 AS ordinal FROM orders)
SELECT o_orderkey, ordinal, substring(sha256('m' || o_custkey || ':' || strftime(o_orderdate, '%Y-%m-%d') || ':' || o_orderstatus || ':' || description || ':' || ordinal), 1, 16) AS record_id FROM o
""")
def q_record_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = ordinals.number_rows(change_orders(spark, sf_dir), ["o_orderkey"], "ordinal", start=0)
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    return rows.select("o_orderkey", "ordinal", text.record_id(tagged("m", "o_custkey"), day, F.col("o_orderstatus"), F.col("description"), F.col("ordinal")).alias("record_id"))


@check(EXPORT_SQL + """
SELECT substring(sha256(model_id || ':' || date_time_utc || ':' || usr || ':' || description || ':' || ordinal), 1, 16) AS record_id, model_id, date_time_utc FROM n
""")
def q_history_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    return history.history_list(read_exports(spark, land_exports(spark, sf_dir), RUN_1))


@check(f"""
SELECT DISTINCT 'm' || o_custkey AS model_id, coalesce(replace(c_name, '#', ' '), 'm' || o_custkey) AS model_name,
 'w' || coalesce(c_nationkey, o_custkey % 25) AS workspace_id, coalesce(n_name, 'w' || coalesce(c_nationkey, o_custkey % 25)) AS workspace_name, '{RUN_1}' AS last_synced_at
FROM orders LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN (SELECT * FROM nation WHERE n_regionkey <> 1) ON c_nationkey = n_nationkey
""")
def q_registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    cust = table(spark, sf_dir, "customer")
    homes = cust.select(F.col("c_custkey").alias("o_custkey"), "c_nationkey")
    pairs = table(spark, sf_dir, "orders").select("o_custkey").distinct().join(homes, "o_custkey", "left").select(
        tagged("m", "o_custkey").alias("model_id"), tagged("w", F.coalesce("c_nationkey", F.col("o_custkey") % 25)).alias("workspace_id"))
    ws = table(spark, sf_dir, "nation").where("n_regionkey <> 1").select(tagged("w", "n_nationkey").alias("id"), F.col("n_name").alias("name"))
    mo = cust.select(tagged("m", "c_custkey").alias("id"), F.replace("c_name", F.lit("#"), F.lit(" /: ")).alias("name"))
    return history.registry(pairs, ws, mo, RUN_1)


@check(f"WITH o AS (SELECT o_orderkey, {DESCRIPTION_SQL} AS description FROM orders) SELECT o_orderkey, {LABELS_SQL} FROM o")
def q_classify(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = rules.with_classification(change_orders(spark, sf_dir).select("o_orderkey", "description"))
    return rows.select("o_orderkey", "change_type", "object_type")


@check(r"""
SELECT p_partkey, CASE WHEN p_name LIKE 'red %' THEN 'Edit' WHEN p_name = 'small ring' THEN 'Create' WHEN regexp_full_match(p_name, '[a-m].*') THEN 'Delete' ELSE 'Model change (no details available)' END AS change_type,
 CASE WHEN p_name LIKE 'red %' THEN 'Module/List' WHEN p_name = 'small ring' THEN 'User' WHEN regexp_full_match(p_name, '[a-m].*') THEN 'Export' ELSE 'Other' END AS object_type FROM part
""")
def q_classify_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = [
        {"priority": "20", "pattern": "^[a-m].*$", "object_type": "Export", "change_type": "Delete"},
        {"priority": "10", "pattern": "red .*", "object_type": "Module/List", "change_type": "Edit"},
        {"priority": "15", "pattern": "^small ring$", "object_type": "User", "change_type": "Create"},
        {"priority": "15", "pattern": "small.*", "object_type": "No such type", "change_type": "Edit"},
        {"priority": "x", "pattern": ".*", "object_type": "User", "change_type": "Edit"},
        {"priority": "1", "pattern": "(", "object_type": "User", "change_type": "Edit"},
    ]
    rows = rules.with_classification(table(spark, sf_dir, "part"), "p_name", rules.build_rules(own))
    return rows.select("p_partkey", "change_type", "object_type")


@check(f"""
WITH o AS (SELECT o_orderkey, CAST(o_orderkey AS VARCHAR) AS k, {DESCRIPTION_SQL} AS description FROM orders),
b AS (SELECT *, greatest(CAST(k[1:1] AS INT), CASE WHEN CAST(k[1:2] AS INT) < 5000 THEN CAST(k[1:2] AS INT) ELSE 0 END,
 CASE WHEN CAST(k[1:3] AS INT) < 5000 THEN CAST(k[1:3] AS INT) ELSE 0 END, CASE WHEN CAST(k[1:4] AS INT) < 5000 THEN CAST(k[1:4] AS INT) ELSE 0 END) AS n FROM o)
SELECT o_orderkey, CASE WHEN description = 'Add List' THEN 'Add' WHEN regexp_full_match(description, '\\d+ Item\\(s\\) Added') THEN CASE n % 3 WHEN 0 THEN 'Edit' WHEN 1 THEN 'Create' ELSE 'Delete' END
  WHEN regexp_full_match(description, 'Gap [FO] .*') THEN 'Create' WHEN description LIKE 'Gap P %' THEN 'Edit' ELSE 'Model change (no details available)' END AS change_type,
 CASE WHEN description = 'Add List' THEN 'User' WHEN regexp_full_match(description, '\\d+ Item\\(s\\) Added') THEN 'Module/List'
  WHEN regexp_full_match(description, 'Gap [FO] .*') THEN 'Export' WHEN description LIKE 'Gap P %' THEN 'User' ELSE 'Other' END AS object_type FROM b
""")
def q_classify_many(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five thousand rules, of which the one with the longest beginning comes first."""
    kinds = ["Edit", "Create", "Delete"]
    own = [{"priority": str(5000 - k), "pattern": f"^{k}\\d* Item\\(s\\) Added$", "object_type": "Module/List", "change_type": kinds[k % 3]} for k in range(5000)]
    own += [{"priority": "1", "pattern": "Add List", "object_type": "User", "change_type": "Add"},
            {"priority": "2", "pattern": "Gap [FO] .*", "object_type": "Export", "change_type": "Create"},
            {"priority": "3", "pattern": "Gap P{1} .*", "object_type": "User", "change_type": "Edit"}]
    rows = rules.with_classification(change_orders(spark, sf_dir).select("o_orderkey", "description"), rules=rules.build_rules(own))
    return rows.select("o_orderkey", "change_type", "object_type")


def classified_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.with_classification(change_orders(spark, sf_dir).select("o_orderkey", "o_orderdate", "description"))


GAPS_SQL = f"""WITH o AS (SELECT *, {DESCRIPTION_SQL} AS description FROM orders),
g AS (SELECT * FROM o WHERE o_orderpriority = '4-NOT SPECIFIED'),
c AS (SELECT description, count(*) AS occurrences FROM g GROUP BY description),
a AS (SELECT description, count(*) AS occurrences FROM g WHERE year(o_orderdate) < 1995 GROUP BY description),
b AS (SELECT description, count(*) AS occurrences FROM g WHERE year(o_orderdate) >= 1995 GROUP BY description),
m AS (SELECT coalesce(b.description, a.description) AS description, coalesce(b.occurrences, a.occurrences) AS occurrences,
 CASE WHEN a.description IS NOT NULL THEN '{RUN_1}' ELSE '{RUN_2}' END AS first_seen_at,
 CASE WHEN b.description IS NOT NULL THEN '{RUN_2}' ELSE '{RUN_1}' END AS last_seen_at FROM a FULL OUTER JOIN b ON a.description = b.description)
"""


@check(GAPS_SQL + "SELECT * FROM c")
def q_unmatched(spark: SparkSession, sf_dir: str) -> DataFrame:
    return unmatched.unmatched_counts(classified_orders(spark, sf_dir))


@check(GAPS_SQL + "SELECT CAST(coalesce(sum(occurrences), 0) AS BIGINT) AS total, count(*) AS distinct_descriptions FROM c")
def q_unmatched_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return unmatched.unmatched_summary(q_unmatched(spark, sf_dir))


@check(GAPS_SQL + "SELECT * FROM c ORDER BY occurrences DESC, description LIMIT 10")
def q_unmatched_top(spark: SparkSession, sf_dir: str) -> DataFrame:
    return unmatched.unmatched_top(q_unmatched(spark, sf_dir))


def unmatched_store(spark: SparkSession, sf_dir: str) -> HistoryStore:
    """A store that counted the orders before 1995 in one run and all later ones in the next."""
    store, rows = HistoryStore(spark, shared_dir(spark, "unmatched")), classified_orders(spark, sf_dir)
    for run, part in ((RUN_1, rows.where(F.year("o_orderdate") < 1995)), (RUN_2, rows.where(F.year("o_orderdate") >= 1995))):
        store.count_unmatched(part, run)
    return store


@check(GAPS_SQL + "SELECT * FROM m")
def q_unmatched_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    return unmatched_store(spark, sf_dir).unmatched.read()


@check(GAPS_SQL + "SELECT * FROM m ORDER BY last_seen_at DESC, occurrences DESC, description LIMIT 50")
def q_unmatched_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return unmatched.unmatched_report(unmatched_store(spark, sf_dir).unmatched.read())


# --------------------------------------------------------------------------
# Retention, publishing, maintenance
# --------------------------------------------------------------------------


@check("""
SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS date_time_utc FROM orders
WHERE NOT (strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') < '1995-06-15T00:00:00+00:00')
""")
def q_purge_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "orders").select("o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("date_time_utc"))
    return rows.where(retention.kept_by_text("date_time_utc", "1995-06-15T00:00:00+00:00"))


@check("""
SELECT event_id, CASE WHEN event_id % 100 <> 0 THEN epoch_us(ts) // 1000 END AS eventDate FROM events
WHERE event_id % 100 = 0 OR epoch_us(ts) // 1000 >= 1705000000000
""")
def q_purge_ms(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").select("event_id", F.when(F.col("event_id") % 100 != 0, millis("ts")).alias("eventDate"))
    return rows.where(retention.kept_by_ms("eventDate", 1705000000000))


@check("""
SELECT row_number() OVER (ORDER BY c_custkey) AS "USR_CT", c_custkey, c_name, CASE WHEN c_acctbal > 0 THEN 1 ELSE 0 END AS active FROM customer
""")
def q_counter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "customer").select("c_custkey", "c_name", (F.col("c_acctbal") > 0).alias("active"))
    return publish.metadata_extract("users", rows, ["c_custkey"])


@check("""
SELECT CAST(row_number() OVER (ORDER BY p_partkey) AS VARCHAR) AS "MOD_CT", CAST(p_partkey AS VARCHAR) AS p_partkey,
 CASE p_size % 4 WHEN 0 THEN NULL WHEN 1 THEN '  ' || p_name || ' ' WHEN 2 THEN p_name || ' "q", ' || p_brand ELSE NULL END AS label,
 CASE WHEN p_size > 20 THEN '1' ELSE '0' END AS big FROM part
""")
def q_publish(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = (
        F.when(F.col("p_size") % 4 == 1, F.concat(F.lit("  "), F.col("p_name"), F.lit(" ")))
        .when(F.col("p_size") % 4 == 2, F.concat(F.col("p_name"), F.lit(' "q", '), F.col("p_brand"))).when(F.col("p_size") % 4 == 3, "")
    )
    rows = table(spark, sf_dir, "part").select("p_partkey", label.alias("label"), (F.col("p_size") > 20).alias("big"))
    folder = shared_dir(spark, "published")
    publish.publish_metadata({"models": rows}, folder, {"models": "MODEL_LIST"}, {"models": ["p_partkey"]})
    text_columns = "MOD_CT string, p_partkey string, label string, big string"
    return publish.read_csv_back(spark, f"{folder}/MODEL_LIST", text_columns)


@check("""
WITH l AS (SELECT o_orderkey, o_orderkey || ',' || o_orderstatus || ',' || o_orderpriority || ',' || strftime(o_orderdate, '%Y-%m-%d') AS line FROM orders),
e AS (SELECT *, length(line) + 1 AS chars, sum(length(line) + 1) OVER (ORDER BY o_orderkey) + 30 AS upto, max(length(line) + 1) OVER () AS longest FROM l),
p AS (SELECT *, (upto - 1) // (50000 - greatest(longest, 30) + 1) AS part FROM e)
SELECT CAST(part AS INT) AS part, CAST(count(*) + CASE WHEN part = 0 THEN 1 ELSE 0 END AS BIGINT) AS file_lines,
 CAST(sum(chars) + CASE WHEN part = 0 THEN 30 ELSE 0 END AS BIGINT) AS chars, min(o_orderkey) AS least_key, max(o_orderkey) AS greatest_key FROM p GROUP BY part
""")
def q_publish_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One ordered file in parts of at most 50,000 characters, counted from what was written."""
    day = F.date_format("o_orderdate", "yyyy-MM-dd").alias("day")
    rows = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_orderstatus").alias("status"), F.col("o_orderpriority").alias("priority"), day)
    folder = shared_dir(spark, "parts")
    publish.write_parts(rows.withColumnRenamed("o_orderkey", "order_key"), folder, ["order_key"], 50_000)
    lines = spark.read.schema("value string, part int").text(folder)
    key = F.split("value", ",")[0].try_cast("bigint")
    return lines.groupBy("part").agg(
        F.count(F.lit(1)).alias("file_lines"), F.sum(F.length("value") + 1).alias("chars"), F.min(key).alias("least_key"), F.max(key).alias("greatest_key"))


def stored_without_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = attributes.with_attributes(attribute_events(spark, sf_dir), categories=[], retain_raw=False)
    done = F.when(F.col("id") % 10 == 0, "{}")
    return rows.select(F.col("event_id").alias("id"), millis("ts").alias("eventDate"), "attrs", *fixed.ATTRIBUTE_COLUMNS.values()).withColumn(fixed.RAW_ATTRIBUTES_COLUMN, done)


BACKFILL_SQL = ATTR_SQL + """, r AS (SELECT *, event_id % 10 <> 0 AND epoch_us(ts) // 1000 >= 1704844800000 AS candidate,
 event_type IN ('signup', 'purchase', 'view') AS has_data FROM p)
"""


@check(BACKFILL_SQL + """
SELECT event_id AS id, CASE WHEN candidate THEN j->>'$.appId' END AS app_id, CASE WHEN candidate THEN j->>'$.pageId' END AS page_id,
 CASE WHEN candidate THEN CASE WHEN event_type = 'view' THEN '0' END END AS action_name,
 CASE WHEN candidate AND has_data THEN CASE event_type WHEN 'signup' THEN '{"k":"' || k || '"}'
  WHEN 'purchase' THEN '{"active":"1","appId":"app-' || k || '","appName":"App ' || k || '","pageId":"' || k || '","pageName":"P","roleId":"r' || k || '"}'
  ELSE '{"actionId":"a' || k || '","actionName":"0","nested.x":"' || k || '","nested.y.z":"q"}' END
  WHEN event_id % 10 = 0 THEN '{}' END AS additional_attributes_raw
FROM r
""")
def q_backfill(spark: SparkSession, sf_dir: str) -> DataFrame:
    marked = backfill.mark_candidates(stored_without_archive(spark, sf_dir), since_ms=1704844800000)
    return backfill.backfill(marked).select("id", "app_id", "page_id", "action_name", "additional_attributes_raw")


@check(BACKFILL_SQL + """
SELECT count(*) AS rows_scanned, count(*) FILTER (has_data) AS rows_updated, count(*) FILTER (NOT has_data) AS rows_skipped
FROM (SELECT * FROM r WHERE candidate ORDER BY ts, event_id LIMIT 3000)
""")
def q_backfill_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    marked = backfill.mark_candidates(stored_without_archive(spark, sf_dir), since_ms=1704844800000, limit=3000)
    return backfill.backfill_counts(marked)


@check("""
SELECT strftime(ts, '%Y-%m-%d') AS run_day, max(epoch_us(ts) // 1000000) AS last_run_epoch,
 strftime(make_timestamp(max(epoch_us(ts) // 1000000) * 1000000), '%Y-%m-%dT%H:%M:%SZ') AS last_run_utc FROM events GROUP BY 1
""")
def q_watermark(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = table(spark, sf_dir, "events").groupBy(F.date_format("ts", "yyyy-MM-dd").alias("run_day")).agg(
        F.max(F.unix_seconds(F.col("ts").cast("timestamp"))).alias("last_run_epoch"))
    return days.withColumn("last_run_utc", text.epoch_s_iso(F.col("last_run_epoch")))


@check("""
SELECT CAST(max(epoch_us(ts) // 1000000) AS VARCHAR) AS batch_code,
 strftime(make_timestamp(max(epoch_us(ts) // 1000000) * 1000000), '%Y-%m-%dT%H:%M:%SZ') AS logged_at, count(*) AS records_loaded FROM events
""")
def q_run_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    run = table(spark, sf_dir, "events").agg(
        F.max(F.unix_seconds(F.col("ts").cast("timestamp"))).alias("e"), F.count(F.lit(1)).alias("n")).first()
    store = EventStore(spark, shared_dir(spark, "run-log"))
    store.finish_run(run["e"], run["n"])
    return store.run_log.read()


@check("""
WITH c AS (SELECT count(*) AS rows_in, count(*) FILTER (event_id % 100 = 0) AS without_id, count(*) FILTER (event_type = 'error') AS without_date,
 count(*) FILTER (props IS NOT NULL) AS with_attributes, count(*) FILTER (event_type = 'purchase') AS with_values,
 count(*) FILTER (event_type = 'view') AS with_other_fields, count(DISTINCT CASE WHEN event_id % 100 <> 0 THEN event_id // 2 ELSE -1 END) AS rows_written FROM events)
SELECT '1704067200' AS batch_code, 'load' AS step, metric, CAST(value AS BIGINT) AS value
FROM (UNPIVOT c ON rows_in, without_id, without_date, with_attributes, with_values, with_other_fields, rows_written INTO NAME metric VALUE value)
""")
def q_run_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a load counts while it writes: landed rows without id or date, with attributes and with undeclared fields."""
    has_id = F.col("event_id") % 100 != 0
    rows = table(spark, sf_dir, "events").select(
        F.when(has_id, F.floor(F.col("event_id") / 2)).alias("id"), F.when(F.col("event_type") != "error", millis("ts")).alias("eventDate"),
        F.when(F.col("event_type") == "purchase", F.to_json(F.struct(number_k().alias("appId")))).otherwise(F.col("props")).alias("additionalAttributes"),
        F.when(F.col("event_type") == "view", number_k()).alias("newField"), "event_id")
    folder = land_pages(rows.withColumnRenamed("event_id", "index"), "response", F.floor(F.col("index") / 500), shared_dir(spark, "metric-pages"))
    store = EventStore(spark, shared_dir(spark, "metrics"))
    store.finish_run(BATCH_MS // 1000, store.load(prepare_events(pages.read_pages(spark, folder, "events"))))
    return store.run_metrics.read().select("batch_code", "step", "metric", "value")


@check(HALVES_SQL + f"""SELECT {_KEY}, coalesce(new.event_id, old.event_id) AS event_id, coalesce(new.event_type, old.event_type) AS event_type,
 CASE WHEN new.user_key IS NOT NULL THEN new.value ELSE old.value END AS value, 2 AS versions_kept {_FULL}""")
def q_snapshot_rotate(spark: SparkSession, sf_dir: str) -> DataFrame:
    old, new = halves(spark, sf_dir)
    snap = SnapshotTable(spark, shared_dir(spark, "snapshots"), old.schema, "user_key", by_bucket("user_key", 8))
    snap.replace(old.limit(0))
    snap.upsert(old)
    snap.upsert(new)
    snap.upsert(new.where("event_type = 'view'"))
    snap.rotate(2)
    return snap.read().withColumn("versions_kept", F.lit(len(snap.version_numbers())))


@check("""
SELECT CAST(user_id AS VARCHAR) AS id, epoch_us(ts) // 1000 AS "eventDate", event_type AS message, CAST(event_id AS VARCHAR) AS checksum,
 props->>'$.k' AS attr_k FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) = 1
""")
def q_stream_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    landing, state = shared_dir(spark, "landing"), shared_dir(spark, "stream")
    event = F.struct(
        F.col("event_id").alias("order"), F.col("user_id").alias("id"), millis("ts").alias("eventDate"), F.col("event_type").alias("message"),
        F.col("event_id").alias("checksum"), F.col("props").alias("additionalAttributes"))
    # Pages hold a fixed number of events; files sort by page.
    paged = table(spark, sf_dir, "events").groupBy(F.floor(F.col("event_id") / 500).alias("page")).agg(F.array_sort(F.collect_list(event)).alias("response"))
    paged.repartitionByRange(8, "page").sortWithinPartitions("page").select("response").write.json(landing)
    store = EventStore(spark, state)
    ingest(spark, landing, store, f"{state}/checkpoint", files_per_batch=3).awaitTermination()
    return store.table.read().select("id", "eventDate", "message", "checksum", F.element_at("attrs", "k").alias("attr_k"))


# --------------------------------------------------------------------------
# Readers, stores and published files, each through the folder they use
# --------------------------------------------------------------------------

def land_pages(rows: DataFrame, field: str, page: Column, folder: str, partitions: list[str] | None = None) -> str:
    """Write rows as JSON pages, one page a line."""
    held = F.struct(*[F.col(f"`{c}`") for c in rows.columns if c not in (partitions or [])])
    paged = rows.withColumn("_page", page).groupBy("_page", *(partitions or [])).agg(F.collect_list(held).alias(field)).drop("_page")
    paged.write.partitionBy(*(partitions or [])).json(folder)
    return folder


@check(f"""
SELECT CAST(event_id AS VARCHAR) AS id, epoch_us(ts) // 1000 AS "eventDate", {CODE_SQL} AS "eventTypeId", event_type <> 'error' AS success FROM events
""")
def q_page_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").select(
        F.col("event_id").alias("id"), millis("ts").cast("double").alias("eventDate"), event_code().alias("eventTypeId"),
        (F.col("event_type") != "error").alias("success"))
    folder = land_pages(rows, "response", F.floor(F.col("id") / 500), shared_dir(spark, "pages"))
    return normalize.coerce_events(pages.read_pages(spark, folder, "events")).select("id", "eventDate", "eventTypeId", "success")


@check("""
SELECT 'C' || c_custkey AS id, c_name AS "userName", c_mktsegment AS "displayName", 'G' || c_custkey AS "firstName", 'F' || c_nationkey AS "lastName" FROM customer
""")
def q_user_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = F.struct(tagged("G", "c_custkey").alias("givenName"), tagged("F", "c_nationkey").alias("familyName"))
    rows = table(spark, sf_dir, "customer").select(
        tagged("C", "c_custkey").alias("id"), F.col("c_name").alias("userName"), F.col("c_mktsegment").alias("displayName"), name.alias("name"))
    folder = land_pages(rows, "Resources", F.floor(F.substring("id", 2, 20).cast("long") / 500), shared_dir(spark, "users"))
    return pages.read_users(spark, folder).select("id", "userName", "displayName", "firstName", "lastName")


@check("""
SELECT 'workspace' AS kind, 'W' || n_nationkey AS id, n_name AS name, NULL AS parent FROM nation
UNION ALL SELECT 'model', 'M' || p_partkey, p_name, 'W' || (p_partkey % 25) FROM part
UNION ALL SELECT 'action', 'A' || p_partkey, p_type, 'W' || (p_size % 5) || '/M' || (p_size % 10) FROM part
UNION ALL SELECT 'process', 'P' || s_suppkey, s_name, 'W' || (s_nationkey % 5) || '/M' || (s_nationkey % 10) FROM supplier
UNION ALL SELECT 'file', 'F' || s_suppkey, s_name, 'W' || (s_nationkey % 5) || '/M' || (s_nationkey % 10) FROM supplier
UNION ALL SELECT 'integration', 'I' || s_suppkey, s_name, 'run ' || s_nationkey FROM supplier
""")
def q_metadata_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    part, supplier = table(spark, sf_dir, "part"), table(spark, sf_dir, "supplier")
    root = shared_dir(spark, "metadata")

    def landed(rows: DataFrame, kind: str, key: str, partitions: list[str] | None = None) -> str:
        return land_pages(rows, pages.PAGES[kind][0], F.floor(F.substring(key, 2, 20).cast("long") / 500), f"{root}/{kind}", partitions)

    def homes(of: str) -> list[Column]:
        return [tagged("W", F.col(of) % 5).alias("workspace_id"), tagged("M", F.col(of) % 10).alias("model_id")]

    where = ["workspace_id", "model_id"]
    landed(table(spark, sf_dir, "nation").select(tagged("W", "n_nationkey").alias("id"), F.col("n_name").alias("name")), "workspaces", "id")
    landed(part.select(tagged("M", "p_partkey").alias("id"), F.col("p_name").alias("name"), tagged("W", F.col("p_partkey") % 25).alias("workspaceId")),
           "models", "id", ["workspaceId"])
    landed(part.select(tagged("A", "p_partkey").alias("id"), F.col("p_type").alias("name"), *homes("p_size")), "actions", "id", where)
    for letter, kind in (("P", "processes"), ("F", "files")):
        landed(supplier.select(tagged(letter, "s_suppkey").alias("id"), F.col("s_name").alias("name"), *homes("s_nationkey")), kind, "id", where)
    run = F.struct(tagged("run ", "s_nationkey").alias("message")).alias("latestRun")
    landed(supplier.select(tagged("I", "s_suppkey").alias("integrationId"), F.col("s_name").alias("name"), run), "integrations", "integrationId")

    def read(reader: Callable, kind: str, name: str, parent: Column, key: str = "id") -> DataFrame:
        return reader(spark, f"{root}/{kind}").select(F.lit(name).alias("kind"), F.col(key).alias("id"), "name", parent.alias("parent"))

    home = F.concat_ws("/", "workspace_id", "model_id")
    found = read(pages.read_workspaces, "workspaces", "workspace", F.lit(None).cast("string"))
    found = found.unionByName(read(pages.read_models, "models", "model", F.col("workspaceId")))
    for reader, kind, name in ((pages.read_actions, "actions", "action"), (pages.read_processes, "processes", "process"), (pages.read_files, "files", "file")):
        found = found.unionByName(read(reader, kind, name, home))
    return found.unionByName(read(pages.read_integrations, "integrations", "integration", F.col("`latestRun.message`"), "integrationId"))


@check("""
SELECT CAST(event_id AS VARCHAR) AS id, (SELECT count(*) FROM events WHERE epoch_us(ts) // 1000 < 1704844800000) AS deleted, '2' AS schema_version
FROM events WHERE epoch_us(ts) // 1000 >= 1704844800000
""")
def q_event_purge(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = EventStore(spark, shared_dir(spark, "purged"))
    store.load(prepare_events(landed_events(spark, sf_dir), attributes=False))
    deleted = store.purge(datetime(2026, 1, 9, tzinfo=UTC), 2)
    version = store.table.version().properties["schema_version"]
    return store.table.read().select("id", F.lit(deleted).cast("long").alias("deleted"), F.lit(version).alias("schema_version"))


# Two years of 365 days before it is 1995-06-15.
HISTORY_NOW = datetime(1997, 6, 14, tzinfo=UTC)
HISTORY_SQL = EXPORT_SQL + """, h AS (SELECT substring(sha256(model_id || ':' || date_time_utc || ':' || usr || ':' || description || ':' || ordinal), 1, 16) AS record_id,
 model_id, date_time_utc FROM n WHERE date_time_utc >= '1995-06-15T00:00:00+00:00')
"""


def history_store(spark: SparkSession, sf_dir: str) -> tuple[HistoryStore, dict[str, int]]:
    """A store that loaded its exports twice and then lost what is too old."""
    store = HistoryStore(spark, shared_dir(spark, "history"))
    pairs = change_orders(spark, sf_dir).select(tagged("m", F.col("o_custkey") % 40).alias("model_id"), F.lit("w1").alias("workspace_id")).distinct()
    named = table(spark, sf_dir, "nation").select(tagged("m", "n_nationkey").alias("id"), F.col("n_name").alias("name"))
    folder = land_exports(spark, sf_dir)
    for run in (RUN_1, RUN_2):
        store.load(history.history_rows(spark, folder, run), history.registry(pairs, named, named, run), run)
    return store, store.purge(HISTORY_NOW, 2)


@check(HISTORY_SQL + """
SELECT *, (SELECT count(*) FROM n WHERE date_time_utc < '1995-06-15T00:00:00+00:00') AS deleted FROM h
""")
def q_history_purge(spark: SparkSession, sf_dir: str) -> DataFrame:
    store, deleted = history_store(spark, sf_dir)
    return store.list.read().withColumn("deleted", F.lit(deleted["normalized"]).cast("long"))


@check(HISTORY_SQL + f"""
SELECT 'list' AS file, record_id AS key, model_id AS detail FROM h
UNION ALL SELECT 'normalized', record_id, '{RUN_1}' FROM h
UNION ALL SELECT 'registry', m.model_id, coalesce(n_name, m.model_id) || ' {RUN_2}' FROM (SELECT DISTINCT model_id FROM n) m
 LEFT JOIN nation ON m.model_id = 'm' || n_nationkey
""")
def q_history_publish(spark: SparkSession, sf_dir: str) -> DataFrame:
    store, _ = history_store(spark, sf_dir)
    folder = shared_dir(spark, "history-out")
    store.publish(folder)

    def file(name: str, kept: SnapshotTable) -> DataFrame:
        return publish.read_csv_back(spark, f"{folder}/{name}", kept.schema)

    listed = file("MODEL_HISTORY_LIST", store.list).select(F.lit("list").alias("file"), F.col("record_id").alias("key"), F.col("model_id").alias("detail"))
    rows = file("MODEL_HISTORY_NORMALIZED", store.normalized).select(F.lit("normalized"), "record_id", "captured_at")
    models = file("MODEL_REGISTRY", store.registry).select(F.lit("registry"), "model_id", F.concat_ws(" ", "model_name", "last_synced_at"))
    return listed.union(rows).union(models)


@check("""
SELECT DISTINCT 'app-' || (props->>'$.k') AS code, 'App ' || (props->>'$.k') AS name FROM events WHERE event_type = 'purchase'
""")
def q_list_publish(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = shared_dir(spark, "lists")
    events = attributes.with_attributes(attribute_events(spark, sf_dir))
    publish.publish_lists(spark, events, folder, {"ux_app": "UX_APP_LIST"}, ["uxAppPage"])
    return publish.read_csv_back(spark, f"{folder}/UX_APP_LIST", schemas.EMPTY_LIST)


@check("""
SELECT max(epoch_us(ts) // 1000000) AS last_run_epoch,
 strftime(make_timestamp(max(epoch_us(ts) // 1000000) * 1000000), '%Y-%m-%dT%H:%M:%SZ') AS last_run_utc FROM events
""")
def q_last_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs are finished; the file holds what the store says of the later one."""
    ends = F.unix_seconds(F.col("ts").cast("timestamp"))
    run = table(spark, sf_dir, "events").agg(F.min(ends).alias("first"), F.max(ends).alias("last"), F.count(F.lit(1)).alias("n")).first()
    store, folder = EventStore(spark, shared_dir(spark, "last-run")), shared_dir(spark, "last-run-out")
    store.finish_run(run["first"], 0)
    store.finish_run(run["last"], run["n"])
    publish.write_csv(publish.last_run(spark, store.last_run()), f"{folder}/last_run", single_file=True)
    return publish.read_csv_back(spark, f"{folder}/last_run", schemas.WATERMARK)


_AS_TEXT = ", ".join(f"nullif(CAST({c} AS VARCHAR), '') AS {c}" for c in fixed.WIDE_COLUMNS)


@check(f"SELECT {_AS_TEXT} FROM ({SQL['q_audit_wide']})")
def q_wide_publish(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = shared_dir(spark, "wide")
    wide = q_audit_wide(spark, sf_dir)
    publish.publish_audit(wide, folder)
    return publish.read_csv_back(spark, f"{folder}/AUDIT_LOG", schemas._strings(*wide.columns))
