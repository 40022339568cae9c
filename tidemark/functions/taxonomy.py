"""Event category from the prefix of an event code."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import fixed, schemas
from tidemark.functions.text import WHITESPACE, sql_text, strip
from tidemark.session import literal_table


def _prefix(code: Column) -> Column:
    return F.upper(strip(F.split_part(code, F.lit("-"), F.lit(1))))


def category_lookup(
    code: Column, names: dict[str, str], default: str
) -> Column:
    """Look the first hyphen-separated part of ``code`` up, never null."""
    table = F.create_map(*[F.lit(x) for x in chain.from_iterable(names.items())])
    return F.coalesce(F.element_at(table, _prefix(F.coalesce(code, F.lit("")))), F.lit(default))


def event_parent_code(code: Column) -> Column:
    codes = {k: v[0] for k, v in fixed.CATEGORY_BY_PREFIX.items()}
    return category_lookup(code, codes, fixed.UNCATEGORIZED[0])


def event_parent_name(code: Column) -> Column:
    names = {k: v[1] for k, v in fixed.CATEGORY_BY_PREFIX.items()}
    return category_lookup(code, names, fixed.UNCATEGORIZED[1])


def category_seed(spark: SparkSession) -> DataFrame:
    """The category tier under its root, in list order."""
    names = {code: name for code, name in fixed.CATEGORY_BY_PREFIX.values()}
    names[fixed.UNCATEGORIZED[0]] = fixed.UNCATEGORIZED[1]
    rows = [(code, names[code], fixed.CATEGORY_ROOT) for code in fixed.CATEGORY_LIST_ORDER]
    return literal_table(spark, rows, schemas.CATEGORY_SEED)


def register_sql_functions(spark: SparkSession) -> None:
    """Make ``event_parent_code`` / ``event_parent_name`` usable from SQL."""
    for name, pick in (("event_parent_code", 0), ("event_parent_name", 1)):
        pairs = ", ".join(
            f"{sql_text(k)}, {sql_text(v[pick])}" for k, v in fixed.CATEGORY_BY_PREFIX.items()
        )
        spark.sql(
            f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(code STRING) RETURNS STRING RETURN "
            f"coalesce(element_at(map({pairs}), "
            f"upper(btrim(split_part(coalesce(code, ''), '-', 1), {sql_text(WHITESPACE)}))), "
            f"{sql_text(fixed.UNCATEGORIZED[pick])})"
        )
