"""First-match-wins classification rules compiled to one column expression."""

from __future__ import annotations

import csv
import io
import re
from collections.abc import Iterable, Mapping
from dataclasses import dataclass
from itertools import groupby

from pyspark import SparkContext
from pyspark.errors import IllegalArgumentException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import fixed
from tidemark.functions.text import sql_text

# Rules that are tried one by one; longer lists are looked up.
TRIED_IN_TURN = 256
# Characters of a pattern's beginning that rules are looked up by.
PREFIX_LENGTHS = (2, 4, 8, 16, 32, 64)


@dataclass(frozen=True)
class Rule:
    priority: int
    pattern: str
    object_type: str
    change_type: str

    @property
    def literal(self) -> str | None:
        """The only text the pattern accepts, when there is just one."""
        body = re.sub(r"^\^|(?<!\\)\$$", "", self.pattern)
        plain = re.sub(r"\\([^0-9A-Za-z])", lambda m: "\0" + m.group(1), body)
        if re.search(r"(?<!\0)[\\.^$*+?()\[\]{}|]", plain):
            return None
        return plain.replace("\0", "")


def vocabularies() -> tuple[set[str], set[str]]:
    """Known object types and change types."""
    return set(fixed.OBJECT_TYPES), set(fixed.CHANGE_TYPES)


def _java_pattern(pattern: str) -> str:
    """What a rule's pattern is at run time.

    (?d) limits line ends to \\n and (?U) makes \\d Unicode-aware.
    """
    return f"(?Ud)\\A(?:{pattern})\\z"


def _compiler():
    """The JVM's compiler of patterns; none without a session. Looked up once for many rules."""
    context = SparkContext._active_spark_context
    return context._jvm.java.util.regex.Pattern.compile if context else lambda pattern: None


def _compiles(pattern: str, compiler) -> bool:
    """Whether a pattern works here and in the JVM, where it runs."""
    try:
        re.compile(pattern)
        compiler(_java_pattern(pattern))
    except (re.error, IllegalArgumentException):
        return False
    return True


def _usable(row: Mapping[str, str | None], objects: set[str], changes: set[str], compiler) -> Rule | None:
    field = {k: (row.get(k) or "").strip() for k in ("priority", "pattern", "object_type", "change_type")}
    try:
        rule = Rule(int(field["priority"]), field["pattern"], field["object_type"], field["change_type"])
    except ValueError:
        return None
    known = rule.object_type in objects and rule.change_type in changes
    return rule if rule.pattern and known and _compiles(rule.pattern, compiler) else None


def build_rules(
    rows: Iterable[Mapping[str, str | None]],
    object_types: set[str] | None = None,
    change_types: set[str] | None = None,
) -> list[Rule]:
    """Usable rules by ascending priority; ties keep their source order."""
    objects, changes = vocabularies()
    compiler = _compiler()
    rules = [
        _usable(row, objects if object_types is None else object_types,
                changes if change_types is None else change_types, compiler)
        for row in rows
    ]
    return sorted((r for r in rules if r), key=lambda r: r.priority)


def default_rules() -> list[Rule]:
    return build_rules(csv.DictReader(io.StringIO(fixed.RULES_CSV)))


def read_rules(
    spark: SparkSession,
    path: str,
    object_types: set[str] | None = None,
    change_types: set[str] | None = None,
) -> list[Rule]:
    """Rules from a CSV file: a configuration list that becomes an expression."""
    table = (
        spark.read.schema("priority string, pattern string, object_type string, change_type string")
        .option("header", True).option("quote", '"').option("escape", '"')
        .csv(path)
    )
    return build_rules([r.asDict() for r in table.collect()], object_types, change_types)


def _match_sql(rules: list[Rule], text: str) -> str:
    """SQL for the position of the first rule that matches, or null.

    Neighbouring literal rules share one map lookup; patterns are tried in
    turn.
    """
    parts = []
    numbered = list(enumerate(rules))
    for is_literal, run in groupby(numbered, key=lambda p: p[1].literal is not None):
        if is_literal:
            first: dict[str, int] = {}
            for i, rule in run:
                first.setdefault(rule.literal, i)
            entries = ", ".join(f"{sql_text(k)}, {i}" for k, i in first.items())
            parts.append(f"element_at(map({entries}), {text})")
        else:
            whens = " ".join(
                f"WHEN {text} RLIKE {sql_text(_java_pattern(r.pattern))} THEN {i}" for i, r in run
            )
            parts.append(f"CASE {whens} END")
    return f"coalesce({', '.join(parts)}, -1)" if parts else "-1"


def _pick_sql(rules: list[Rule], text: str, field: str, default: str) -> str:
    labels = ", ".join(sql_text(v) for v in [default, *[getattr(r, field) for r in rules]])
    blank = f"coalesce({text}, '') = ''"
    return f"element_at(array({labels}), 2 + CASE WHEN {blank} THEN -1 ELSE {_match_sql(rules, text)} END)"


def literal_prefix(pattern: str) -> str:
    """Text that everything a pattern accepts begins with; empty if none is certain."""
    body, depth, in_class, escaped = pattern.removeprefix("^"), 0, False, False
    for c in body:
        if escaped:
            escaped = False
        elif c == "\\":
            escaped = True
        elif in_class:
            in_class = c != "]"
        elif c == "[":
            in_class = True
        elif c == "|" and depth == 0:
            return ""
        else:
            depth += (c == "(") - (c == ")")
    found: list[str] = []
    at = 0
    while at < len(body):
        c, width = body[at], 1
        if c == "\\":
            if at + 1 == len(body) or body[at + 1].isalnum():
                break
            c, width = body[at + 1], 2
        elif c in ".^$*+?()[]{}|":
            # The character before these may be missing.
            if c in "*?{" and found:
                found.pop()
            break
        found.append(c)
        at += width
    return "".join(found)


def _indexed_rules(df: DataFrame, text: str, rules: list[Rule]) -> DataFrame:
    """Adds ``_rule``, the position of the first rule that matches, for long rule lists.

    Rules are grouped by the beginning that their pattern is sure of, cut to one
    of a few lengths. A text is joined to the group of each of its beginnings
    (one lookup a length, whatever the number of rules) and tries only their
    patterns. Rules of one text are looked up by it, and patterns without such a
    beginning are tried on every text. Every row stays one row throughout.
    """
    spark = df.sparkSession
    exact: dict[str, int] = {}
    groups: dict[int, dict[str, list[tuple[int, str]]]] = {}
    others: list[tuple[int, Rule]] = []
    for i, rule in enumerate(rules):
        if rule.literal is not None:
            exact.setdefault(rule.literal, i)
            continue
        prefix = literal_prefix(rule.pattern)
        length = max((n for n in PREFIX_LENGTHS if n <= len(prefix)), default=0)
        if length:
            groups.setdefault(length, {}).setdefault(prefix[:length], []).append((i, _java_pattern(rule.pattern)))
        else:
            others.append((i, rule))
    whens = " ".join(f"WHEN {text} RLIKE {sql_text(_java_pattern(r.pattern))} THEN {i}" for i, r in others)
    found = [f"CASE {whens} END"] if others else []
    joined = df
    if exact:
        known = spark.createDataFrame(list(exact.items()), "_literal string, _exact int")
        joined = joined.join(known, F.expr(text) == F.col("_literal"), "left").drop("_literal")
        found.append("_exact")
    for length, by_prefix in sorted(groups.items()):
        rows = spark.createDataFrame(
            [(p, tried) for p, tried in by_prefix.items()], f"_p{length} string, _tried{length} array<struct<i: int, pattern: string>>"
        )
        joined = joined.join(rows, F.expr(f"substring({text}, 1, {length})") == F.col(f"_p{length}"), "left").drop(f"_p{length}")
        found.append(f"array_min(transform(filter(_tried{length}, c -> {text} RLIKE c.pattern), c -> c.i))")
    first = f"least({', '.join(found)})" if len(found) > 1 else found[0]
    ruled = joined.withColumn("_rule", F.expr(f"CASE WHEN coalesce({text}, '') = '' THEN -1 ELSE coalesce({first}, -1) END"))
    return ruled.drop("_exact", *[f"_tried{n}" for n in groups])


def with_classification(
    df: DataFrame, description: str = "description", rules: list[Rule] | None = None
) -> DataFrame:
    """Add ``change_type`` and ``object_type``; never null.

    Lists of many patterns are looked up by how they begin instead of tried in turn.
    """
    rules = default_rules() if rules is None else rules
    if len(rules) > TRIED_IN_TURN:
        ruled = _indexed_rules(df, f"`{description}`", rules)
        labels = df.sparkSession.createDataFrame(
            [(-1, fixed.CATCHALL_CHANGE_TYPE, fixed.CATCHALL_OBJECT_TYPE), *[(i, r.change_type, r.object_type) for i, r in enumerate(rules)]],
            "_at int, change_type string, object_type string",
        )
        return ruled.drop("change_type", "object_type").join(labels, F.col("_rule") == F.col("_at"), "left").drop("_rule", "_at")
    text = f"`{description}`"
    labelled = df.withColumn(
        "_rule", F.expr(f"CASE WHEN coalesce({text}, '') = '' THEN -1 ELSE {_match_sql(rules, text)} END")
    )

    def label(field: str, default: str) -> Column:
        labels = [default, *[getattr(r, field) for r in rules]]
        return F.element_at(F.array(*[F.lit(v) for v in labels]), F.col("_rule") + 2)

    return labelled.withColumns(
        {
            "change_type": label("change_type", fixed.CATCHALL_CHANGE_TYPE),
            "object_type": label("object_type", fixed.CATCHALL_OBJECT_TYPE),
        }
    ).drop("_rule")


def register_sql_functions(spark: SparkSession, rules: list[Rule] | None = None) -> None:
    """Make ``classify_change_type`` / ``classify_object_type`` usable from SQL."""
    rules = default_rules() if rules is None else rules
    for name, field, default in (
        ("classify_change_type", "change_type", fixed.CATCHALL_CHANGE_TYPE),
        ("classify_object_type", "object_type", fixed.CATCHALL_OBJECT_TYPE),
    ):
        spark.sql(
            f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(description STRING) RETURNS STRING "
            f"RETURN {_pick_sql(rules, 'description', field, default)}"
        )
