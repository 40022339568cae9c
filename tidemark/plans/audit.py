"""The wide audit table: events with every dimension resolved, 59 columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import fixed
from tidemark.functions.taxonomy import event_parent_name
from tidemark.functions.text import epoch_ms_text, flag, load_id
from tidemark.operators.joins import lookup
from tidemark.session import stage


def named_rows(dimension: DataFrame, key: Column, named: DataFrame) -> DataFrame:
    """Rows of a dimension whose key is among those that events name (``_named``)."""
    return dimension.join(named, key == F.col("_named"), "left_semi")


def object_dimension(models: DataFrame, integrations: DataFrame, users: DataFrame, named: DataFrame | None = None) -> DataFrame:
    """Models, integrations and users by upper-cased id, side by side; only those ``named``, if given.

    An object id is looked up in all three; joining them to each other first
    leaves one join of the events, and every combination of matches survives.
    The name of an integration's model is resolved here too.
    """
    def kept(rows: DataFrame) -> DataFrame:
        return rows if named is None else named_rows(rows, F.col("_okey"), named)

    model = models.select(F.upper("id").alias("_okey"), F.col("id").alias("_m2_id"), F.col("name").alias("_m2_name"))
    owner = models.groupBy("id").agg(
        F.max("name").alias("_cw_model_name"), (F.count(F.lit(1)) > 1).alias("_cw_model_twice")
    ).withColumnRenamed("id", "_m3_id")
    integration = kept(integrations.select(
        F.upper("integrationId").alias("_okey"), F.col("integrationId").alias("_cw_id"),
        F.col("modelId").alias("_cw_model_id"), F.col("name").alias("_cw_name"),
    )).join(owner, F.col("_cw_model_id") == F.col("_m3_id"), "left").drop("_m3_id")
    user = users.select(F.upper("id").alias("_okey"), F.col("id").alias("_u2_id"), F.col("userName").alias("_u2_name"))
    return kept(model).join(integration, "_okey", "full_outer").join(kept(user), "_okey", "full_outer")


def resolved_model(attr_id: Column, attr_name: Column) -> tuple[Column, Column]:
    """Model id and name: the attribute's, else the object's, else the integration's.

    An integration's model that is listed twice has no one name: the row that
    needs it fails.
    """
    twice = F.raise_error(F.concat(F.lit("model id occurs more than once: "), F.col("_cw_model_id")))
    owner_name = F.when(F.coalesce("_cw_model_twice", F.lit(False)), twice.cast("string")).otherwise(F.col("_cw_model_name"))

    def by(when_attr: Column, when_model: Column, when_integration: Column) -> Column:
        return (
            F.when(attr_id.isNotNull(), when_attr)
            .when(F.col("_m2_id").isNotNull(), when_model)
            .when(F.col("_cw_id").isNotNull(), when_integration)
        )
    return (
        by(attr_id, F.col("_m2_id"), F.col("_cw_model_id")),
        by(attr_name, F.col("_m2_name"), owner_name),
    )


def resolved_object() -> tuple[Column, Column]:
    """Kind and name of the object: model before integration before user."""
    def by(when_model: Column, when_integration: Column, when_user: Column) -> Column:
        return (
            F.when(F.col("_m2_id").isNotNull(), when_model)
            .when(F.col("_cw_id").isNotNull(), when_integration)
            .when(F.col("_u2_id").isNotNull(), when_user)
        )
    return (
        by(F.lit(fixed.OBJECT_LABEL_MODEL), F.lit(fixed.OBJECT_LABEL_INTEGRATION), F.lit(fixed.OBJECT_LABEL_USER)),
        by(F.col("_m2_name"), F.col("_cw_name"), F.col("_u2_name")),
    )


def action_label(action_id: Column, action_name: Column) -> Column:
    """Name of an action, or why it has none."""
    return (
        F.when(action_id == fixed.UNSAVED_ACTION_ID, fixed.UNSAVED_ACTION_LABEL)
        .when(action_name.isNull() & action_id.isNotNull(), fixed.DELETED_OBJECT_LABEL)
        .otherwise(action_name)
    )


def wide_audit(
    events: DataFrame,
    *,
    users: DataFrame,
    workspaces: DataFrame,
    models: DataFrame,
    integrations: DataFrame,
    actions: DataFrame,
    catalog: DataFrame,
    tenant_name: str,
    batch_ms: int,
) -> DataFrame:
    """Join stored events to their dimensions; one output row per match.

    Events are written out once with the columns they need. Their keys are then
    read apart, and of each dimension that can be large the rows with such a key
    are written out: their size is known before the events are planned, and
    events are only shuffled for rows that are too many to broadcast.
    """
    fields = [
        "id", "eventDate", "createdDate", "index", "eventTimeZone", "createdTimeZone", "eventTypeId", "userId", "tenantId", "objectId",
        "objectTypeId", "objectTenantId", "message", "success", "errorNumber", "ipAddress", "userAgent", "sessionId", "hostName",
        "serviceVersion", "checksum",
    ]
    needed = {"workspaceId": "_ws_id", "modelId": "_model_id", "actionId": "_action_id"}
    lifted = [*needed.items(), *[(key, f"_attr_{out}") for out, key in fixed.WIDE_ATTRIBUTES.items()]]
    facts = stage(events.select(*fields, *[F.element_at("attrs", key).alias(out) for key, out in lifted]), "audit-events")
    spread = F.col("id")

    def named(fact_key: Column) -> DataFrame:
        return facts.select(fact_key.alias("_named")).distinct()

    def narrowed(dimension: DataFrame, fact_key: Column, dimension_key: Column, label: str) -> DataFrame:
        return stage(named_rows(dimension, dimension_key, named(fact_key)), label)

    action_key, action_of = F.upper(F.concat("_action_id", "objectId")), F.upper(F.concat("id", "model_id"))
    objects = stage(object_dimension(models, integrations, users, named(F.upper("objectId"))), "objects")
    users = narrowed(users, F.col("userId"), F.col("id"), "users")
    models = narrowed(models, F.col("_model_id"), F.col("id"), "models")
    actions = narrowed(actions, action_key, action_of, "actions")

    def joined(facts: DataFrame, dimension: DataFrame, fact_key: Column, dimension_key: Column, columns: dict[str, str]) -> DataFrame:
        return lookup(facts, dimension, fact_key, dimension_key, columns, spread_by=spread)

    rows = joined(facts, users, F.col("userId"), F.col("id"), {"userName": "_u_name", "displayName": "_u_display"})
    rows = joined(rows, workspaces, F.col("_ws_id"), F.col("id"), {"name": "_ws_name"})
    rows = joined(rows, models, F.col("_model_id"), F.col("id"), {"name": "_model_name"})
    rows = joined(rows, objects, F.upper("objectId"), F.col("_okey"), {c: c for c in objects.columns if c != "_okey"})
    rows = joined(
        rows, catalog, F.col("eventTypeId"), F.col("Event Code"),
        {"Event Message": "_ac_message", "Associated Object ID": "_ac_object", "Notes": "_ac_notes"},
    )
    rows = joined(rows, actions, action_key, action_of, {"name": "_action_name"})

    model_id, model_name = resolved_model(F.col("_model_id"), F.col("_model_name"))
    object_type, object_name = resolved_object()
    columns: dict[str, Column] = {
        "LOAD_ID": load_id(F.col("eventDate"), F.col("index")),
        "BATCH_ID": F.lit(batch_ms).cast("long"),
        "AUDIT_ID": F.col("id"),
        "EVENT_DATE": epoch_ms_text(F.col("eventDate")),
        "EVENT_TIMEZONE": F.col("eventTimeZone"),
        "CREATED_DATE": epoch_ms_text(F.col("createdDate")),
        "CREATE_TIMEZONE": F.col("createdTimeZone"),
        "EVENT_ID": F.col("eventTypeId"),
        "EVENT_MESSAGE": F.col("_ac_message"),
        "ASSOCIATED_OBJECT_ID": F.col("_ac_object"),
        "NOTES": F.col("_ac_notes"),
        "USER_ID": F.col("userId"),
        "USER_NAME": F.col("_u_name"),
        "DISPLAY_NAME": F.col("_u_display"),
        "TENANT_ID": F.col("tenantId"),
        "TENANT_NAME": F.lit(tenant_name),
        "WORKSPACE_ID": F.col("_ws_id"),
        "WORKSPACE_NAME": F.col("_ws_name"),
        "MODEL_ID": model_id,
        "MODEL_NAME": model_name,
        "OBJECT_ID": F.col("objectId"),
        "OBJECT_TYPE": object_type,
        "OBJECT_NAME": object_name,
        "MESSAGE": F.col("message"),
        "SUCCESS": flag(F.col("success")),
        "ERROR_NUMBER": F.col("errorNumber"),
        "IP_ADDRESS": F.col("ipAddress"),
        "USER_AGENT": F.col("userAgent"),
        "SESSION_ID": F.col("sessionId"),
        "HOST_NAME": F.col("hostName"),
        "SERVICE_VERSION": F.col("serviceVersion"),
        "OBJECT_TYPE_ID": F.col("objectTypeId"),
        "OBJECT_TENANT_ID": F.col("objectTenantId"),
        "ACTION_ID": F.col("_action_id"),
        "ACTION_NAME": action_label(F.col("_action_id"), F.col("_action_name")),
        **{out: F.col(f"_attr_{out}") for out in fixed.WIDE_ATTRIBUTES},
        "EVENT_CATEGORY": event_parent_name(F.col("eventTypeId")),
        "CHECKSUM": F.col("checksum"),
    }
    return rows.select(*[columns[name].alias(name) for name in fixed.WIDE_COLUMNS])
