"""Complete an event-code catalogue and give every code a parent and a name."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark import fixed
from tidemark.functions.taxonomy import event_parent_code, event_parent_name
from tidemark.functions.text import non_empty, strip
from tidemark.operators.ordinals import number_rows
from tidemark.session import stage


def unlisted_codes(catalog: DataFrame, events: DataFrame, code: str = "Event Code", event_code: str = "eventTypeId") -> DataFrame:
    """Distinct codes that occur in the events but not in the catalogue."""
    observed = (
        events.select(F.col(event_code).alias(code)).where(non_empty(F.col(event_code))).distinct()
    )
    return observed.join(catalog.select(code), code, "left_anti")


def complete_catalog(
    catalog: DataFrame, events: DataFrame | None, position: str = "position",
    code: str = "Event Code", event_code: str = "eventTypeId",
) -> DataFrame:
    """The catalogue followed by the unlisted codes in sorted order."""
    if events is None:
        return catalog
    new = number_rows(unlisted_codes(catalog, events, code, event_code), [code], position, start=1)
    last = catalog.agg(F.coalesce(F.max(position), F.lit(0)).alias("_last")).first()["_last"]
    placed = new.withColumn(position, F.col(position) + F.lit(last))
    return catalog.unionByName(placed, allowMissingColumns=True)


def assign_names(
    df: DataFrame, code: str, message: str, position: str, out: str = "Event Name",
    max_length: int = fixed.MAX_EVENT_NAME_LENGTH,
) -> DataFrame:
    """A unique name per row: the message if short enough and free, else the code.

    A message is free for the first row that carries it, unless an earlier row
    had to fall back to a code that reads the same. That exception can chain,
    so it is followed round by round until no row changes; normally no code
    equals a message and there is no round at all.
    """
    msg = strip(F.coalesce(F.col(message), F.lit("")))
    rows = df.withColumn("_msg", F.when((msg != "") & (F.length(msg) <= max_length), msg))
    firsts = (
        rows.where("_msg IS NOT NULL").groupBy("_msg").agg(F.min(position).alias("_at"))
        .select(F.col("_at"), F.lit(True).alias("_first"))
    )
    base = rows.join(firsts, F.col(position) == F.col("_at"), "left").drop("_at")

    # A first row waits on every earlier row whose code is its message.
    waiting = base.where("_first").select(F.col(position).alias("_pos"), F.col("_msg").alias("_key"))
    codes = base.select(
        F.col(code).cast("string").alias("_key"), F.col(position).alias("_on"),
        F.col("_first").isNull().alias("_fallback"),
    )
    waits = waiting.join(codes, "_key").where("_on < _pos").select("_pos", "_on", "_fallback")
    fallen = _fallen(waits)
    if fallen is not None:
        base = base.join(fallen, F.col(position) == F.col("_pos"), "left").withColumn(
            "_first", F.when(F.col("_pos").isNull(), F.col("_first"))
        ).drop("_pos")
    return base.withColumn(
        out, F.when(F.col("_first"), F.col("_msg")).otherwise(F.col(code).cast("string"))
    ).drop("_msg", "_first")


def _fallen(waits: DataFrame) -> DataFrame | None:
    """Positions that lose their message to an earlier fallback code."""
    waits = stage(waits, "name-waits")
    newly = waits.where("_fallback").select("_pos").distinct()
    if newly.isEmpty():
        return None
    fallen = newly = stage(newly, "name-fallen")
    while True:
        following = waits.join(newly.select(F.col("_pos").alias("_on")), "_on", "left_semi")
        newly = stage(
            following.select("_pos").distinct().join(fallen, "_pos", "left_anti"), "name-fallen"
        )
        if newly.isEmpty():
            return fallen
        fallen = fallen.unionByName(newly)


def with_catalog_columns(
    catalog: DataFrame, position: str = "position", code: str = "Event Code", message: str = "Event Message"
) -> DataFrame:
    """Add ``Parent Code``, ``Parent`` and ``Event Name``."""
    parented = catalog.withColumns(
        {"Parent Code": event_parent_code(F.col(code)), "Parent": event_parent_name(F.col(code))}
    )
    return assign_names(parented, code, message, position)
