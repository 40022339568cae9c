"""Keyed upsert with four conflict policies.

=================  ======================================================
replace            ``update=None``: every column of the batch overwrites
insert only        ``update=[]``: an existing row is left alone
refresh            ``update=[...]``: only these columns are overwritten
keep first seen    ``update=["occurrences", "last_seen_at"]``
=================  ======================================================

Columns the batch does not carry keep their stored value; columns the table
does not carry yet are added. Nothing is collected and no row is dropped.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from tidemark.session import observed, stage, unstage

# Repeated keys are ranked apart from the others while at most one key in so many repeats.
FEW_REPEATED = 20


def last_wins(batch: DataFrame, key: str, order_by: Sequence[str | Column]) -> DataFrame:
    """One row per key, the last in ``order_by``.

    The rank filter is pushed below the shuffle as a group limit, so each map
    task sends at most one row per key, however often a key repeats.
    """
    newest = Window.partitionBy(key).orderBy(
        *[(F.col(c) if isinstance(c, str) else c).desc() for c in order_by]
    )
    return batch.withColumn("_rank", F.row_number().over(newest)).where("_rank = 1").drop("_rank")


def one_per_key(staged: DataFrame, key: str, order_by: Sequence[str | Column]) -> tuple[DataFrame, bool]:
    """:func:`last_wins` of a staged batch, and whether that is the batch itself.

    Keys alone are shuffled to find those that repeat; as a rule few do, and only
    their rows are ranked.
    """
    seen = Observation()
    counted = staged.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).observe(seen, F.count(F.lit(1)).alias("keys"))
    repeated = stage(counted.where("_n > 1").select(F.col(f"`{key}`").alias("_key")), "repeated")
    n = repeated.count()
    if n == 0:
        unstage(repeated)
        return staged, True
    if n * FEW_REPEATED > observed(seen).get("keys", 0):
        unstage(repeated)
        return last_wins(staged, key, order_by), False
    same = F.col(f"`{key}`").eqNullSafe(F.col("_key"))
    ranked = last_wins(staged.join(repeated, same, "left_semi"), key, order_by)
    return staged.join(repeated, same, "left_anti").unionByName(ranked), False


def attribute_keys(batch: DataFrame, columns: Sequence[str] = ("attrs",)) -> dict[str, list[str]]:
    """Distinct keys of each map column: the optional columns this batch carries."""
    each = [f"transform(map_keys(`{c}`), k -> named_struct('map', '{c}', 'k', k))" for c in columns]
    if not each:
        return {}
    # concat is null where one map is.
    keys = batch.selectExpr(f"inline(concat({', '.join(f'coalesce({e}, array())' for e in each)}))").distinct()
    held: dict[str, list[str]] = {c: [] for c in columns}
    for row in keys.collect():
        held[row["map"]].append(row["k"])
    return {c: sorted(ks) for c, ks in held.items()}


def _merged_map(old: Column, new: Column, batch_keys: Sequence[str]) -> Column:
    """Stored entries the batch does not carry, plus the batch row's entries."""
    empty = F.create_map().cast("map<string,string>")
    kept = F.map_filter(
        F.coalesce(old, empty), lambda k, _: ~F.coalesce(k.isin(list(batch_keys)), F.lit(False))
    )
    given = F.map_filter(F.coalesce(new, empty), lambda _, v: v.isNotNull())
    return F.map_concat(kept, given)


def merge_rows(
    current: DataFrame,
    batch: DataFrame,
    key: str,
    *,
    update: Sequence[str] | None = None,
    not_older: str | None = None,
    maps: dict[str, Sequence[str]] | None = None,
    matched: DataFrame | None = None,
) -> DataFrame:
    """``current`` with ``batch`` merged into it; both hold one row per key.

    ``not_older`` names an order column: a batch row only overwrites when its
    order is not below the stored one. ``maps`` gives, per map column, the keys
    the batch carries. Without ``matched`` this is one full outer join. With
    ``matched`` (the keys present in both) it is a left join plus the new rows,
    which needs no shuffle of ``current`` while the batch is small.
    """
    maps = maps or {}
    update = [c for c in batch.columns if c != key] if update is None else list(update)
    columns = current.columns + [c for c in batch.columns if c not in current.columns]
    types = {f.name: f.dataType for f in [*batch.schema.fields, *current.schema.fields]}

    fresh = None if matched is None else batch.join(matched.select(key), key, "left_anti")
    if fresh is not None and not update and not maps and set(batch.columns) <= set(current.columns):
        return current.unionByName(fresh, allowMissingColumns=True)
    # Plans of many columns are written as SQL text: built column by column they
    # take longer to put together than a small batch takes to run.
    incoming = batch.selectExpr(f"`{key}`", *[f"`{c}` AS `_b_{c}`" for c in batch.columns if c != key], "true AS _b")
    stored = current.withColumn("_c", F.lit(True))
    how = "full_outer" if matched is None else "left"
    joined = stored.join(incoming, key, how)

    overwrites = "_b IS NOT NULL"
    if not_older:
        overwrites += f" AND coalesce(NOT (`_b_{not_older}` < `{not_older}`), true)"
    joined = joined.withColumn("_over", F.expr(overwrites))

    def value(c: str) -> Column:
        if c == key:
            return F.col(f"`{c}`")
        kind = types[c].simpleString()
        old = f"`{c}`" if c in current.columns else f"CAST(NULL AS {kind})"
        if c not in batch.columns:
            return F.expr(f"{old} AS `{c}`")
        new = f"CAST(`_b_{c}` AS {kind})"
        if c in maps:
            taken = F.when(F.col("_over"), _merged_map(F.expr(old), F.expr(new), maps[c])).otherwise(F.expr(old))
            return F.when(F.col("_c").isNull(), F.expr(new)).otherwise(taken).alias(c)
        taken = f"CASE WHEN _over THEN {new} ELSE {old} END" if c in update else old
        return F.expr(f"CASE WHEN _c IS NULL THEN {new} ELSE {taken} END AS `{c}`")

    merged = joined.select(*[value(c) for c in columns])
    if matched is None:
        return merged
    return merged.unionByName(fresh.select(*batch.columns), allowMissingColumns=True)
