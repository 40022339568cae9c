"""Shape landed rows to their declared schemas."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import schemas
from tidemark.functions.text import as_text


def _flag(col: Column, default: bool) -> Column:
    return F.coalesce(col.try_cast("boolean"), F.lit(default))


def _whole_number(name: str, is_text: bool) -> Column:
    """A whole number, also one written ``5.0``; null is 0, anything else fails.

    Texts are mostly plain digits, so the exact decimal is only made for others.
    """
    exact = f"try_cast(`{name}` AS decimal(38,9))"
    wrong = f"raise_error(concat('{name} is no whole number: ', CAST(`{name}` AS string)))"
    slow = f"CASE WHEN `{name}` IS NULL THEN 0L WHEN {exact} = floor({exact}) THEN CAST({exact} AS bigint) ELSE {wrong} END"
    return F.expr(f"coalesce(try_cast(`{name}` AS bigint), {slow})" if is_text else slow)


def coerce_events(events: DataFrame) -> DataFrame:
    """Loosely typed events to declared types: no null text, numbers or flags.

    ``errorNumber`` alone may be null. A number that is none fails.
    """
    texts = {n: F.expr(f"coalesce(CAST(`{n}` AS string), '')") for n in schemas.EVENT_TEXT_FIELDS}
    types = dict(events.dtypes)
    numbers = {n: _whole_number(n, types.get(n) == "string") for n in schemas.EVENT_NUMBER_FIELDS}
    return events.withColumns({**texts, **numbers, "success": _flag(F.col("success"), True)})


def bool_to_text(col: Column, data_type: T.DataType) -> Column:
    """A stored cell as text: booleans read 1/0."""
    return (col.cast("int") if isinstance(data_type, T.BooleanType) else col).cast("string")


def nested_to_json(df: DataFrame) -> DataFrame:
    """Structs, arrays and maps as JSON text; other columns unchanged."""
    nested = (T.StructType, T.ArrayType, T.MapType, T.VariantType)
    return df.select(
        *[
            F.to_json(F.col(f"`{f.name}`")).alias(f.name) if isinstance(f.dataType, nested) else F.col(f"`{f.name}`")
            for f in df.schema.fields
        ]
    )


def to_schema(df: DataFrame, schema: T.StructType, keep_extra: bool = False) -> DataFrame:
    """Exactly the declared columns (absent ones null), plus any extra ones."""
    present = {c.lower() for c in df.columns}
    declared = [
        (F.col(f"`{f.name}`") if f.name.lower() in present else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in schema.fields
    ]
    names = {f.name.lower() for f in schema.fields}
    extra = [F.col(f"`{c}`") for c in df.columns if keep_extra and c.lower() not in names]
    return df.select(*declared, *extra)


def with_defaults(df: DataFrame, defaults: dict[str, object]) -> DataFrame:
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in defaults.items()})


def lift_user_name(users: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """First and last name from the nested name, unless given at top level; and the columns to ``keep``."""
    return users.select(
        as_text(F.col("id")).alias("id"),
        as_text(F.col("userName")).alias("userName"),
        as_text(F.col("displayName")).alias("displayName"),
        F.coalesce("firstName", "name.givenName", F.lit("")).alias("firstName"),
        F.coalesce("lastName", "name.familyName", F.lit("")).alias("lastName"),
        *keep,
    )


def action_kind(actions: DataFrame) -> DataFrame:
    """``type`` from ``actionType``, else from ``type``."""
    return actions.withColumn("type", F.coalesce("actionType", "type", F.lit(""))).drop("actionType")


def flatten_integrations(integrations: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """``latestRun.*`` and ``schedule.*`` as dotted columns; and the columns to ``keep``."""
    top = [as_text(F.col(n)).alias(n) for n in schemas.INTEGRATION_FIELDS]
    run = [F.col(f"latestRun.{n}").cast("string").alias(f"latestRun.{n}") for n in schemas.RUN_FIELDS]
    plan = [F.col(f"schedule.{n}").cast("string").alias(f"schedule.{n}") for n in schemas.SCHEDULE_FIELDS]
    return integrations.select(*top, *run, *plan, *keep)


def with_provenance(df: DataFrame, workspaces: DataFrame, models: DataFrame) -> DataFrame:
    """Names of the workspace and model a row came from, empty if unknown."""
    ws = workspaces.select(F.col("id").alias("workspace_id"), F.col("name").alias("workspace_name"))
    mo = models.select(F.col("id").alias("model_id"), F.col("name").alias("model_name"))
    named = df.drop("workspace_name", "model_name").join(ws, "workspace_id", "left").join(mo, "model_id", "left")
    return with_defaults(named, {"workspace_name": "", "model_name": ""})
