"""Semi-structured event attributes: parse, flatten, lift, archive.

``attrs`` is a ``map<string,string>`` keyed by the dotted path of each scalar,
so a new attribute key never changes a schema. The sixteen lifted columns and
the raw archive are ordinary columns next to it.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import fixed
from tidemark.functions.text import strip


# The expressions are SQL texts: built call by call, one load would spend longer
# on its plan than on a small batch.


# The type of a value shows in its JSON text, where strings are quoted; naming its whole type takes longer.


def _is_object(value: str) -> str:
    return f"startswith(to_json({value}), '{{')"


def _is_boolean(value: str) -> str:
    return f"to_json({value}) IN ('true', 'false')"


def _stored_text(value: str) -> str:
    """Scalar text as stored under a dotted key: booleans are 1/0."""
    return (
        f"CASE WHEN {_is_boolean(value)} THEN CAST(CAST(CAST({value} AS boolean) AS int) AS string)"
        f" ELSE CAST({value} AS string) END"
    )


def _lifted_text(key: str) -> Column:
    """Top-level value as stored in a named column: booleans are True/False."""
    text, field = f"element_at(_text, '{key}')", f"element_at(_fields, '{key}')"
    return F.expr(f"CASE WHEN _fields IS NOT NULL AND {_is_boolean(field)} THEN initcap({text}) ELSE {text} END")


# Each nested object of the entries ``opened`` replaced by its own entries under ``parent.child``.
_OPEN_NESTED = f"""flatten(transform(opened, e -> CASE WHEN {_is_object("e.value")}
    THEN transform(map_entries(CAST(e.value AS map<string,variant>)),
                   c -> named_struct('key', concat_ws('.', e.key, c.key), 'value', c.value))
    ELSE array(e) END))"""

# The entries of ``_once``, whose outermost objects are opened, opened level by level until none holds an
# object. Two braces are those of the whole and of one object in it, so a third is the first to be one deeper.
_OPEN_ALL = f"""CASE WHEN _braces < 3 THEN _once ELSE reduce(sequence(3, _braces), _once, (opened, n) ->
    CASE WHEN exists(opened, x -> {_is_object("x.value")}) THEN {_OPEN_NESTED} ELSE opened END) END"""

# Opened entries as a map of dotted path to text; a repeated path keeps its last.
_ENTRIES_TO_MAP = f"""map_from_entries(transform(
    CASE WHEN size(array_distinct(transform(_entries, e -> e.key))) = size(_entries) THEN _entries
    ELSE filter(_entries, (e, i) -> NOT exists(slice(_entries, i + 2, size(_entries)), x -> x.key = e.key)) END,
    e -> named_struct('key', e.key, 'value', {_stored_text("e.value")})))"""


def with_parsed(df: DataFrame, source: str, both: bool = True) -> DataFrame:
    """Parse a JSON object text; blank, malformed and other texts give null.

    Adds ``_obj`` (the object), ``_text`` (its top level as text), ``_fields``
    (its top level with types) and ``_braces`` (which bounds its nesting).
    ``_fields`` is only there when the source text can hold a boolean or a
    nested object, the two kinds whose stored form depends on the type; most
    rows need just the plain text. Unless ``both``, rows that have ``_fields`` have no ``_text``.

    The text is parsed as the only element of an array, so that anything after
    the object makes it malformed. Each step is its own projection: the
    optimizer keeps them apart because the parse is used more than once.
    """
    is_object = "startswith(_body, '{') AND endswith(_body, '}')"
    typed = "_braces > 1 OR contains(_body, 'true') OR contains(_body, 'false')"
    return (
        df.withColumn("_body", strip(F.col(source)))
        .withColumns({
            "_braces": F.expr("length(_body) - length(replace(_body, '{'))"),
            "_list": F.expr(f"CASE WHEN {is_object} THEN try_parse_json(concat('[', _body, ']')) END"),
        })
        .withColumn("_obj", F.expr(
            "CASE WHEN try_variant_get(_list, '$[1]', 'variant') IS NULL THEN try_variant_get(_list, '$[0]', 'variant') END"
        ))
        .withColumns({
            "_text": F.expr("CAST(_obj AS map<string,string>)" if both else f"CASE WHEN NOT ({typed}) THEN CAST(_obj AS map<string,string>) END"),
            "_fields": F.expr(f"CASE WHEN {typed} THEN CAST(_obj AS map<string,variant>) END"),
        })
        .drop("_body", "_list")
    )


def with_attribute_map(parsed: DataFrame) -> DataFrame:
    """Add ``attrs``, opening nested objects if there are any.

    The opened entries are a column of their own, and null for the usual flat
    object, so that nothing is opened twice.
    """
    nested = f"_braces > 1 AND exists(map_values(_fields), v -> {_is_object('v')})"
    typed = f"transform_values(_fields, (k, v) -> {_stored_text('v')})"
    return (
        parsed.withColumn("_once", F.expr(f"CASE WHEN {nested} THEN transform(array(map_entries(_fields)), opened -> {_OPEN_NESTED})[0] END"))
        .withColumn("_entries", F.expr(f"CASE WHEN _once IS NOT NULL THEN {_OPEN_ALL} END"))
        .withColumn("attrs", F.expr(
            f"CASE WHEN _entries IS NOT NULL THEN {_ENTRIES_TO_MAP} WHEN _fields IS NOT NULL THEN {typed} ELSE _text END"
        ))
        .drop("_once", "_entries")
    )


def with_other_fields(df: DataFrame, source: str, known: Iterable[str]) -> DataFrame:
    """Add ``other``: the fields of a JSON object text that are not ``known``, by dotted path.

    Values have the form of ``attrs``. Null where the object has no such field;
    the text is only parsed where it has one.
    """
    names = ", ".join(f"'{n}'" for n in known)
    unknown = F.expr(f"CASE WHEN size(array_except(json_object_keys({source}), array({names}))) > 0 THEN {source} END")
    parsed = with_parsed(df.withColumn("_unknown", unknown), "_unknown", both=False)
    kept = {c: F.expr(f"map_filter({c}, (k, v) -> k NOT IN ({names}))") for c in ("_text", "_fields")}
    opened = with_attribute_map(parsed.withColumns(kept)).withColumnRenamed("attrs", "other")
    return opened.drop("_unknown", "_obj", "_text", "_fields", "_braces")


def enabled_columns(categories: Iterable[str] | None) -> set[str]:
    """Lifted columns of the enabled categories; unknown names are ignored."""
    if categories is None:
        return set(fixed.ATTRIBUTE_COLUMNS.values())
    return {c for name in categories for c in fixed.CATEGORY_ATTRIBUTES.get(name, [])}


def lifted_columns(
    value_of, *, categories: Iterable[str] | None = None
) -> dict[str, Column]:
    """All sixteen columns; those of a disabled category are null."""
    allowed = enabled_columns(categories)
    return {
        column: value_of(key) if column in allowed else F.lit(None).cast("string")
        for key, column in fixed.ATTRIBUTE_COLUMNS.items()
    }


def with_attributes(
    df: DataFrame,
    source: str = "additionalAttributes",
    *,
    categories: Iterable[str] | None = None,
    retain_raw: bool = True,
) -> DataFrame:
    """Parse ``source`` into ``attrs``, the lifted columns and the raw archive."""
    parsed = with_attribute_map(with_parsed(df, source))
    lifted = lifted_columns(_lifted_text, categories=categories)
    raw = F.when(F.size("_text") > 0, F.to_json("_obj")) if retain_raw else F.lit(None)
    return parsed.withColumns(
        {
            **lifted,
            fixed.RAW_ATTRIBUTES_COLUMN: raw.cast("string"),
        }
    ).drop("_obj", "_text", "_fields", "_braces")


def lifted_from_map(
    attrs: Column, *, categories: Iterable[str] | None = None, retain_raw: bool = True
) -> dict[str, Column]:
    """The lifted columns and archive rebuilt from stored dotted values."""
    kept = F.map_filter(attrs, lambda _, v: v.isNotNull() & (v != ""))
    columns = lifted_columns(lambda key: F.element_at(kept, key), categories=categories)
    ordered = F.map_from_entries(F.array_sort(F.map_entries(kept)))
    raw = F.when(F.size(kept) > 0, F.to_json(ordered)) if retain_raw else F.lit(None)
    return {**columns, fixed.RAW_ATTRIBUTES_COLUMN: raw.cast("string")}


def yields_value(columns: Iterable[str] = tuple(fixed.ATTRIBUTE_COLUMNS.values())) -> Column:
    """True when any lifted column holds a value."""
    return F.coalesce(*[F.col(c) for c in columns]).isNotNull()
