"""Dimension lists derived from a fact table, and their difference to a list."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import fixed, schemas
from tidemark.functions.text import non_empty


def distinct_list(df: DataFrame, code: str, name: str, parent: str | None = None) -> DataFrame:
    """Distinct ``(code, name[, parent_code])`` without null or empty parts."""
    parts = {"code": code, "name": name, **({"parent_code": parent} if parent else {})}
    picked = df.select(*[F.col(source).alias(out) for out, source in parts.items()])
    for out in parts:
        picked = picked.where(non_empty(F.col(out)))
    return picked.distinct()


def attribute_lists(events: DataFrame, categories: Iterable[str] | None = None) -> dict[str, DataFrame]:
    """The dimension lists of the given categories (all when not given)."""
    wanted = None if categories is None else set(categories)
    return {
        name: distinct_list(events, code, label, parent)
        for name, (category, code, label, parent) in fixed.ATTRIBUTE_LISTS.items()
        if wanted is None or category in wanted
    }


def models_with_modifier(models: DataFrame, users: DataFrame) -> DataFrame:
    """Models with mail and display name of who last changed them, if known."""
    who = users.select(
        F.col("id").alias("_uid"),
        F.col("userName").alias("lastModifiedByEmail"),
        F.col("displayName").alias("lastModifiedByDisplayName"),
    )
    joined = models.join(who, F.col("lastModifiedByUserGuid") == F.col("_uid"), "left")
    columns = [f.name for f in schemas.MODELS.fields if f.name != "workspaceId"]
    at = columns.index("lastModifiedByUserGuid") + 1
    order = ["_ord"] if "_ord" in models.columns else []
    return joined.select(
        *columns[:at], "lastModifiedByEmail", "lastModifiedByDisplayName", *columns[at:], *order
    )


def observed_values(df: DataFrame, column: str) -> DataFrame:
    """Distinct non-empty values of a column as ``code``."""
    return (
        df.select(F.col(f"`{column}`").cast("string").alias("code"))
        .where(non_empty(F.col("code"))).distinct()
    )


def missing_items(observed: DataFrame, existing: DataFrame) -> DataFrame:
    """Observed codes that are neither a code nor a name of the existing list."""
    taken = existing.select(F.col("code").cast("string").alias("code")).unionByName(
        existing.select(F.col("name").cast("string").alias("code"))
    ).where(non_empty(F.col("code")))
    new = observed.join(taken, "code", "left_anti")
    return new.select("code", F.col("code").alias("name"))


def in_scope(df: DataFrame, pairs: DataFrame, keys: list[str], select: bool = True) -> DataFrame:
    """Rows whose key pair is listed (or, with ``select=False``, is not)."""
    return df.join(pairs.select(*keys), keys, "left_semi" if select else "left_anti")


def first_seen(df: DataFrame, key: str, order_by: Column) -> DataFrame:
    """Distinct values of ``key`` with the position of their first row."""
    return df.groupBy(key).agg(F.min(order_by).alias("first_position"))


def resolve_names(
    references: DataFrame, known: DataFrame, reference: str, out: str,
    within: list[str] | None = None,
) -> DataFrame:
    """Id of each reference: an id, else an exact name, else any-case name.

    When several known rows share a name the last by ``position`` counts, as
    when a later entry replaces an earlier one. ``out`` is null if unresolved.
    """
    within = within or []
    listed = known.withColumn("_name_ci", F.lower("name"))

    def by(column: str, result: str) -> DataFrame:
        pick = F.max_by("id", "position") if column != "id" else F.max("id")
        return listed.groupBy(*within, F.col(column).alias(f"_k_{result}")).agg(pick.alias(result))

    found = references
    for column, probe, result in (
        ("id", F.col(reference), "_by_id"),
        ("name", F.col(reference), "_by_name"),
        ("_name_ci", F.lower(reference), "_by_ci"),
    ):
        side = by(column, result)
        condition = probe == F.col(f"_k_{result}")
        for w in within:
            side = side.withColumnRenamed(w, f"_w_{w}")
            condition = condition & (F.col(w) == F.col(f"_w_{w}"))
        found = found.join(side, condition, "left").drop(f"_k_{result}", *[f"_w_{w}" for w in within])
    chosen = F.coalesce("_by_id", "_by_name", "_by_ci")
    return found.withColumn(out, chosen).drop("_by_id", "_by_name", "_by_ci")


def require_resolved(df: DataFrame, reference: str, out: str) -> DataFrame:
    """Fail the job on the first reference that was not resolved."""
    message = F.concat(F.lit("not found by id or name: "), F.col(reference))
    return df.withColumn(out, F.coalesce(F.col(out), F.raise_error(message).cast("string")))
