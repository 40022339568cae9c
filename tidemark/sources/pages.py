"""Landed JSON pages: one document per page, rows in an array field.

Pages lie in a folder, one per line or (``multiline``) one per file; names
should sort by run and page, since that order decides which of two versions of
an event is the later one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import schemas
from tidemark.functions.attributes import with_other_fields
from tidemark.operators import normalize


def _strings(*names: str) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


# Array field of each kind of page, and the fields read from its rows. Events are
# read as their JSON text, so that fields nobody declared are not lost.
PAGES = {
    "events": ("response", T.StringType()),
    "users": ("Resources", _strings("id", "userName", "displayName", "firstName", "lastName").add(
        "name", _strings("givenName", "familyName"))),
    "workspaces": ("workspaces", schemas.WORKSPACES),
    "models": ("models", T.StructType(schemas.MODELS.fields[:-1])),
    "actions": ("actions", _strings("id", "name", "type", "actionType")),
    "processes": ("processes", _strings("id", "name")),
    "files": ("files", _strings("id", "name", "chunkCount", "delimiter", "encoding", "firstDataRow",
                                "format", "headerRow", "separator")),
    "integrations": ("integrations", _strings(*schemas.INTEGRATION_FIELDS).add(
        "latestRun", _strings(*schemas.RUN_FIELDS)).add("schedule", _strings(*schemas.SCHEDULE_FIELDS))),
}


# Holds what is not a page; such a file fails the read, so no event is lost unseen.
CORRUPT = "_unreadable"


def page_schema(kind: str, partitions: tuple[str, ...] = ()) -> T.StructType:
    field, row = PAGES[kind]
    schema = T.StructType([T.StructField(field, T.ArrayType(row)), T.StructField(CORRUPT, T.StringType())])
    for name in partitions:
        schema = schema.add(name, T.StringType())
    return schema


def landed_pages(
    spark: SparkSession, path: str | list[str], kind: str, *, stream: bool = False,
    multiline: bool = False, partitions: tuple[str, ...] = (), files_per_batch: int | None = None,
) -> DataFrame:
    """Whole pages with the file and split they were read from.

    ``partitions`` are folder columns such as ``workspace_id=.../``.
    """
    reader = spark.readStream if stream else spark.read
    reader = reader.schema(page_schema(kind, partitions)).option("multiLine", multiline)
    reader = reader.option("columnNameOfCorruptRecord", CORRUPT)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    unreadable = F.raise_error(F.concat(F.lit(f"unreadable {kind} page in "), F.col("_metadata.file_path")))
    rows = F.when(F.col(CORRUPT).isNull(), F.col(PAGES[kind][0])).otherwise(unreadable)
    return reader.json(path).select(
        rows.alias(PAGES[kind][0]), *partitions, F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"),
    )


def page_rows(pages: DataFrame, kind: str, partitions: tuple[str, ...] = ()) -> DataFrame:
    """Rows of all pages with their arrival order ``_ord``; an empty page adds none.

    Events have their undeclared fields in the map ``other``.
    """
    rows = pages.withColumn("_row", F.monotonically_increasing_id()).select(
        "_file", "_block", "_row", *partitions, F.posexplode(PAGES[kind][0]).alias("_pos", "_event")
    )
    order = F.struct(
        F.col("_file").alias("file"), F.col("_block").alias("block"), F.col("_row").alias("row"),
        F.col("_pos").alias("pos"),
    )
    if kind == "events":
        rows = _opened_events(rows)
        return rows.select("_event.*", "other", *partitions, order.alias("_ord"))
    return rows.select("_event.*", *partitions, order.alias("_ord"))


def _opened_events(rows: DataFrame) -> DataFrame:
    """The declared fields of each event's JSON text as a struct, the others as a map."""
    wrong = F.raise_error(F.concat(F.lit("no event object in "), F.col("_file"), F.lit(": "), F.col("_event")))
    rows = rows.withColumn("_event", F.when(F.col("_event").isNull() | F.startswith("_event", F.lit("{")), F.col("_event")).otherwise(wrong))
    opened = with_other_fields(rows, "_event", schemas.LANDED_EVENT.names)
    return opened.withColumn("_event", F.from_json("_event", schemas.LANDED_EVENT))


def read_pages(
    spark: SparkSession, path: str | list[str], kind: str, *, multiline: bool = False,
    partitions: tuple[str, ...] = (),
) -> DataFrame:
    """Rows of every landed page of one kind."""
    pages = landed_pages(spark, path, kind, multiline=multiline, partitions=partitions)
    return page_rows(pages, kind, partitions)


def since(events: DataFrame, epoch_seconds: int) -> DataFrame:
    """Events at or after a watermark given in seconds, and those without a date."""
    return events.where(F.coalesce(F.col("eventDate") >= epoch_seconds * 1000, F.lit(True)))


def first_arrived(events: DataFrame, n: int, order: str = "_ord") -> DataFrame:
    """The first ``n`` events in arrival order."""
    return events.orderBy(order).limit(n)


# The readers below keep the arrival order of their rows (``_ord``) if ``ordered``.


def _shaped(rows: DataFrame, schema: T.StructType, ordered: bool) -> DataFrame:
    return normalize.to_schema(rows, schemas.ordered(schema) if ordered else schema)


def read_users(spark: SparkSession, path: str, *, ordered: bool = False, **options) -> DataFrame:
    return normalize.lift_user_name(read_pages(spark, path, "users", **options), keep=["_ord"] if ordered else [])


def read_workspaces(spark: SparkSession, path: str, *, ordered: bool = False, **options) -> DataFrame:
    rows = _shaped(read_pages(spark, path, "workspaces", **options), schemas.WORKSPACES, ordered)
    return normalize.with_defaults(
        rows, {"id": "", "name": "", "active": True, "sizeAllowance": 0, "currentSize": 0}
    )


def read_models(spark: SparkSession, path: str, *, ordered: bool = False, **options) -> DataFrame:
    """Models below ``workspaceId=.../`` folders."""
    rows = read_pages(spark, path, "models", partitions=("workspaceId",), **options)
    shaped = _shaped(rows, schemas.MODELS, ordered)
    texts = {f.name: "" for f in schemas.MODELS.fields if f.dataType == T.StringType()}
    return normalize.with_defaults(shaped, {**texts, "lastSavedSerialNumber": 0, "memoryUsage": 0})


def _per_model(spark: SparkSession, path: str, kind: str, **options) -> DataFrame:
    return read_pages(spark, path, kind, partitions=("workspace_id", "model_id"), **options)


def read_actions(spark: SparkSession, path: str, *, ordered: bool = False, **options) -> DataFrame:
    rows = normalize.action_kind(_per_model(spark, path, "actions", **options))
    return _shaped(rows, schemas.ACTIONS, ordered)


def read_processes(spark: SparkSession, path: str, *, ordered: bool = False, **options) -> DataFrame:
    return _shaped(_per_model(spark, path, "processes", **options), schemas.PROCESSES, ordered)


def read_files(spark: SparkSession, path: str, *, ordered: bool = False, **options) -> DataFrame:
    return _shaped(_per_model(spark, path, "files", **options), schemas.FILES, ordered)


def read_integrations(spark: SparkSession, path: str, *, ordered: bool = False, **options) -> DataFrame:
    return normalize.flatten_integrations(read_pages(spark, path, "integrations", **options), keep=["_ord"] if ordered else [])
