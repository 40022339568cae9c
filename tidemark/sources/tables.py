"""Small configuration tables read from CSV."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark import schemas
from tidemark.operators.ordinals import number_file_rows, with_source_position
from tidemark.session import stage


def read_csv(spark: SparkSession, path: str, schema) -> DataFrame:
    """A quoted CSV with a header; doubled quotes stand for one."""
    return spark.read.schema(schema).options(header=True, quote='"', escape='"').csv(path)


def read_catalog(spark: SparkSession, path: str) -> DataFrame:
    """The event-code catalogue with its row position."""
    rows = with_source_position(read_csv(spark, path, schemas.CATALOG))
    numbered = number_file_rows(stage(rows, "catalog"), "position", start=1)
    return numbered.select(*schemas.CATALOG.fieldNames(), "position")
