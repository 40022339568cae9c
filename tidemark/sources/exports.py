"""Change-history exports: delimited files whose header differs per file.

Files of any name lie in ``workspace_id=.../model_id=.../`` folders. Quoted cells
may hold line breaks, also across the splits of a file; a quote that is never
closed fails with the name of the file. Empty lines are no records. All of them are read in one scan: the driver only resolves each *distinct*
header once, and the resulting column positions are joined back per file.
"""

from __future__ import annotations

import csv
import io

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import fixed
from tidemark.functions.text import record_id
from tidemark.session import literal_table, stage
from tidemark.sources.records import file_heads, numbered_records, staged_lines

# Columns that come from the export itself, by position of their header.
SOURCE_COLUMNS = [
    c for c in fixed.HISTORY_COLUMNS
    if c not in ("record_id", "model_id", "captured_at", "change_type", "object_type")
]
LAYOUT = T.StructType([
    T.StructField("header", T.StringType()),
    T.StructField("_tabbed", T.BooleanType()),
    T.StructField("_at", T.ArrayType(T.IntegerType())),
])


def delimiter_of(header_line: str) -> str:
    return "\t" if "\t" in header_line else ","


def resolve_header(headers: list[str]) -> dict[str, int]:
    """Target column -> position of the header it takes.

    Targets choose in a fixed order, each the first unclaimed header that
    contains one of its patterns; an exact ID header is the source's own
    record id, and the first leftover is the module when none was named. A
    repeated header always reads its first occurrence.
    """
    free = list(range(len(headers)))
    chosen: dict[str, int] = {}

    def claim(target: str, accepts) -> None:
        hit = next((i for i in free if accepts(headers[i])), None)
        if hit is not None:
            free.remove(hit)
            chosen[target] = hit

    for target, patterns in fixed.HEADER_PATTERNS.items():
        claim(target, lambda h, p=patterns: any(part in h.lower() for part in p))
    claim("source_record_id", lambda h: h.strip().upper() == fixed.EXACT_ID_HEADER)
    if "module_list" not in chosen:
        claim("module_list", lambda h: True)

    lowered = [h.lower() for h in headers]
    return {target: lowered.index(lowered[i]) for target, i in chosen.items()}


def _layouts(spark: SparkSession, headers: DataFrame) -> tuple[DataFrame, int]:
    """Per file its delimiter and column positions, and the widest header.

    ``headers``: the file's number, the header record and its first line, which
    tells the delimiter.
    """
    file_headers = headers.select("_no", "header", F.contains("_head", F.lit("\t")).alias("_tabbed"))
    layouts, width = [], 1
    for row in file_headers.select("header", "_tabbed").distinct().collect():
        names = next(csv.reader(io.StringIO(row["header"], newline=""), delimiter="\t" if row["_tabbed"] else ","))
        chosen = resolve_header(names)
        width = max(width, len(names))
        layouts.append((row["header"], row["_tabbed"], [chosen.get(c, -1) for c in SOURCE_COLUMNS]))
    resolved = literal_table(spark, layouts, LAYOUT)
    return file_headers.join(resolved, ["header", "_tabbed"]).drop("header"), width


def _record(width: int) -> Column:
    """The fields of a line as a struct; a short line gives nulls at its end."""
    schema = ", ".join(f"c{i} string" for i in range(width))

    def parsed(sep: str) -> Column:
        options = {"sep": sep, "quote": '"', "escape": '"', "mode": "PERMISSIVE"}
        return F.from_csv("value", schema, options)

    return F.when(F.col("_tabbed"), parsed("\t")).otherwise(parsed(","))


def read_exports(spark: SparkSession, path: str, captured_at: str) -> DataFrame:
    """All exports as change-history rows, not yet classified.

    No value is null: what a file does not hold is the empty text.
    """
    text = (
        spark.read.schema("value string, workspace_id string, model_id string").option("lineSep", "\n")
        .text(path).select("value", "model_id", "_metadata")
    )
    lines, plain = staged_lines(text)
    headers = file_heads(lines)
    numbered = numbered_records(lines, plain, ["model_id"], headers)
    if plain:
        headers = headers.withColumn("header", F.col("_head"))
    else:
        numbered = stage(numbered, "export-records")
        headers = headers.join(numbered.where("_ordinal = -1").select("_no", F.col("value").alias("header")), "_no")
    layouts, width = _layouts(spark, headers)
    layouts = stage(layouts, "export-layouts")
    numbered = numbered.where("_ordinal >= 0")
    # Each line is parsed once: its fields are taken from one struct, made in a step of its own.
    parsed = numbered.join(layouts, "_no").withColumn("_record", _record(width))
    split = parsed.withColumn("_fields", F.array(*[F.col(f"_record.c{i}") for i in range(width)]))
    empty = F.lit("")
    values = {
        c: F.when(F.col("_at")[i] >= 0, F.coalesce(F.get("_fields", F.col("_at")[i]), empty)).otherwise(empty)
        for i, c in enumerate(SOURCE_COLUMNS)
    }
    rows = split.select("model_id", "_ordinal", *[v.alias(c) for c, v in values.items()])
    identity = record_id(*[F.col(c) for c in ("model_id", "date_time_utc", "user", "description", "_ordinal")])
    return rows.withColumns({"record_id": identity, "captured_at": F.lit(captured_at)}).select(
        *[c for c in fixed.HISTORY_COLUMNS if c not in ("change_type", "object_type")]
    )
