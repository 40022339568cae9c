"""Left joins of a large table to its dimensions.

No broadcast hints: a dimension is broadcast when its size, estimated or
measured at run time, is under the session's threshold, and otherwise both
sides are shuffled and adaptive execution splits a skewed key on the large
side. Rows without a key (null or blank) would still all meet in one partition
of a shuffled join, so they are spread by a second key that only they vary.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

NULL_KEY_SPREAD = 1024


def lookup(
    facts: DataFrame,
    dimension: DataFrame,
    fact_key: Column,
    dimension_key: Column,
    columns: dict[str, str],
    spread_by: Column | None = None,
) -> DataFrame:
    """Left join keeping ``columns`` (dimension column -> output column).

    Every match is kept, as in SQL. ``spread_by`` is any well-spread fact
    column; given one, facts with a null or blank text key do not gather in one task.
    """
    side = dimension.select(
        dimension_key.alias("_dkey"), *[F.col(f"`{c}`").alias(o) for c, o in columns.items()]
    ).where(F.col("_dkey").isNotNull())
    keyed = facts.withColumn("_fkey", fact_key)
    condition = F.col("_fkey") == F.col("_dkey")
    if spread_by is not None:
        spread = F.pmod(F.xxhash64(spread_by), F.lit(NULL_KEY_SPREAD)).cast("int")
        blank = F.coalesce(F.col("_fkey") == "", F.lit(True))
        keyed = keyed.withColumn("_fspread", F.when(blank, spread).otherwise(0))
        # A blank key of the dimension meets all of the facts' blank keys.
        everywhere = F.sequence(F.lit(0), F.lit(NULL_KEY_SPREAD - 1))
        side = side.withColumn("_dspread", F.explode(F.when(F.col("_dkey") == "", everywhere).otherwise(F.array(F.lit(0)))))
        condition = condition & (F.col("_fspread") == F.col("_dspread"))
    return keyed.join(side, condition, "left").drop("_fkey", "_dkey", "_fspread", "_dspread")


def duplicate_keys(dimension: DataFrame, key: Column) -> DataFrame:
    """Keys that occur more than once; a lookup on them repeats fact rows."""
    return (
        dimension.groupBy(key.alias("key")).agg(F.count(F.lit(1)).alias("occurrences"))
        .where((F.col("occurrences") > 1) & F.col("key").isNotNull())
    )


def name_or_id(
    facts: DataFrame, names: DataFrame, id_column: str, out: str, fallback_to_id: bool = True
) -> DataFrame:
    """Display name of an id, or the id itself (or the empty text)."""
    found = lookup(
        facts, names, F.col(id_column), F.col("id"), {"name": out}, spread_by=None
    )
    fallback = F.col(id_column) if fallback_to_id else F.lit("")
    return found.withColumn(out, F.coalesce(F.col(out), fallback))
