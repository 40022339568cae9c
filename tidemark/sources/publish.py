"""CSV extracts as the receiving reporting model imports them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import fixed, schemas
from tidemark.functions.text import epoch_s_iso
from tidemark.operators import lists
from tidemark.operators.ordinals import number_rows, running_sums
from tidemark.session import empty_table, literal_table

# Null and empty text both print as nothing; quotes are doubled; blanks stay.
CSV_OPTIONS = {
    "header": True, "nullValue": "", "emptyValue": "", "quote": '"', "escape": '"',
    "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False,
}


# Characters that one part of a file may have.
PART_CHARS = 1_000_000


def flags_to_int(df: DataFrame) -> DataFrame:
    """Boolean columns as 1/0."""
    return df.select(
        *[
            (F.col(f"`{f.name}`").cast("int") if isinstance(f.dataType, T.BooleanType) else F.col(f"`{f.name}`")).alias(f.name)
            for f in df.schema.fields
        ]
    )


def with_counter(df: DataFrame, counter: str, order_by: list) -> DataFrame:
    """A 1-based counter as the first column."""
    numbered = number_rows(df, order_by, counter, start=1)
    return numbered.select(counter, *[F.col(f"`{c}`") for c in df.columns])


def metadata_extract(table: str, df: DataFrame, order_by: list) -> DataFrame:
    """A metadata table shaped for its file: flags as 1/0, counter first.

    Rows that know their arrival order (``_ord``) are counted in that order.
    """
    shaped = flags_to_int(df)
    counter = fixed.COUNTER_COLUMNS.get(table)
    counted = with_counter(shaped, counter, ["_ord"] if "_ord" in df.columns else order_by) if counter else shaped
    return counted.drop("_ord")


def write_csv(df: DataFrame, path: str, single_file: bool = False) -> None:
    """Write an extract folder; ``single_file`` is for small tables.

    Large extracts keep one file per partition, each with the header.
    """
    out = flags_to_int(df)
    (out.coalesce(1) if single_file else out).write.mode("overwrite").options(**CSV_OPTIONS).csv(path)


def file_parts(df: DataFrame, order_by: list[str], most_chars: int = PART_CHARS) -> DataFrame:
    """The lines of one ordered CSV file, cut into parts of at most ``most_chars`` characters.

    Gives part, line and the columns of ``order_by``. Lines are never cut: with
    a longest line of L characters, a part takes the lines that end within one
    stretch of ``most_chars - L + 1`` characters of the whole file, so it never
    exceeds the bound, and the part of a line follows from the running length
    alone. A line longer than a part fails. The first part begins with the header.
    """
    out = flags_to_int(df)
    options = {k: str(v).lower() if isinstance(v, bool) else v for k, v in CSV_OPTIONS.items() if k != "header"}
    line = F.to_csv(F.struct(*[F.col(f"`{c}`") for c in out.columns]), options)
    lines = out.select(line.alias("line"), *order_by).withColumn("_chars", F.length("line") + 1)
    header = len(",".join(out.columns)) + 1
    placed = running_sums(lines, order_by, "_chars", "_end")
    longest = max(header, placed.agg(F.max("_chars")).first()[0] or 0)
    if longest > most_chars:
        raise ValueError(f"a line of {longest} characters does not fit into a part of {most_chars}")
    width = most_chars - longest + 1
    return placed.select(F.expr(f"CAST((_end + {header} - 1) DIV {width} AS int)").alias("part"), "line", *order_by)


def write_parts(df: DataFrame, path: str, order_by: list[str], most_chars: int = PART_CHARS) -> None:
    """Write an extract as numbered parts of one file (``part=0``, ``part=1``, ...), rows in order.

    Put one behind the other the parts are the whole CSV file.
    """
    lines = file_parts(df, order_by, most_chars)
    header = ",".join(df.columns) + "\n"
    # The window brings each part, which is of bounded size, to one task in order.
    place = F.row_number().over(Window.partitionBy("part").orderBy(*order_by))
    headed = (F.col("part") == 0) & (place == 1)
    text = F.when(headed, F.concat(F.lit(header), F.col("line"))).otherwise(F.col("line"))
    lines.select("part", text.alias("value")).write.mode("overwrite").partitionBy("part").text(path)


def read_csv_back(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A published extract; its quoted cells may hold line breaks, so a file is one task."""
    return spark.read.schema(schema).options(**CSV_OPTIONS, multiLine=True).csv(path)


def publish_audit(wide: DataFrame, folder: str, name: str = "AUDIT_LOG") -> None:
    write_csv(wide, f"{folder}/{name}")


def publish_metadata(tables: dict[str, DataFrame], folder: str, names: dict[str, str], order_by: dict[str, list]) -> list[str]:
    """Publish each metadata table that has a file name; returns those written."""
    written = []
    for table in fixed.PUBLISHED_METADATA:
        if not names.get(table) or table not in tables:
            continue
        write_csv(metadata_extract(table, tables[table], order_by.get(table, ["id"])), f"{folder}/{names[table]}")
        written.append(table)
    return written


def publish_lists(
    spark: SparkSession, events: DataFrame | None, folder: str, names: dict[str, str],
    categories: list[str] | None = None,
) -> list[str]:
    """Publish the dimension lists that are enabled *and* named.

    Without events each enabled list is an empty file with its header.
    """
    enabled = fixed.DEFAULT_LIST_CATEGORIES if categories is None else categories
    found = lists.attribute_lists(events, enabled) if events is not None else {}
    written = []
    for name, (category, *_) in fixed.ATTRIBUTE_LISTS.items():
        if category not in enabled or not names.get(name):
            continue
        rows = found.get(name)
        write_csv(empty_table(spark, schemas.EMPTY_LIST) if rows is None else rows, f"{folder}/{names[name]}")
        written.append(name)
    return written


def publish_history(registry: DataFrame, listing: DataFrame, normalized: DataFrame, folder: str) -> None:
    write_csv(registry, f"{folder}/MODEL_REGISTRY")
    write_csv(listing, f"{folder}/MODEL_HISTORY_LIST")
    write_csv(normalized, f"{folder}/MODEL_HISTORY_NORMALIZED")


def last_run(spark: SparkSession, epoch_seconds: int) -> DataFrame:
    """The watermark as one row: epoch seconds and ISO text."""
    one = spark.range(0, 1, 1, 1).select(F.lit(epoch_seconds).cast("long").alias("last_run_epoch"))
    return one.withColumn("last_run_utc", epoch_s_iso(F.col("last_run_epoch")))


def run_log_row(spark: SparkSession, epoch_seconds: int, records: int) -> DataFrame:
    """One entry of the run log: batch code, time and rows loaded."""
    return last_run(spark, epoch_seconds).select(
        F.col("last_run_epoch").cast("string").alias("batch_code"),
        F.col("last_run_utc").alias("logged_at"),
        F.lit(records).cast("long").alias("records_loaded"),
    )


def run_metric_rows(spark: SparkSession, epoch_seconds: int, steps: dict[tuple[str, str], int]) -> DataFrame:
    """The counts of a run, one row per step and metric."""
    code = str(epoch_seconds)
    rows = [(f"{code}:{step}:{metric}", code, step, metric, n) for (step, metric), n in sorted(steps.items())]
    return literal_table(spark, rows, schemas.RUN_METRICS)


def new_list_items(
    spark: SparkSession, wide: DataFrame, wanted: dict[str, str], existing: dict[str, DataFrame]
) -> dict[str, DataFrame]:
    """Per list the observed codes it lacks; ``wanted`` maps list to column.

    A list or column that does not exist is skipped.
    """
    columns = set(wide.columns)
    return {
        name: lists.missing_items(lists.observed_values(wide, column), existing[name])
        for name, column in wanted.items()
        if name in existing and column in columns
    }
