"""Records of delimited text whose quoted cells hold line breaks.

Lines are read by all splits of a file in parallel, so a task does not know
whether its first line lies inside a quoted cell. Each line is therefore seen as
a function: given that it begins outside or inside quotes, does it end inside?
Such functions chain: one that gives the same answer for both settles the
matter, one that swaps the two counts, and all others change nothing. The
state before a line follows from the last settling line before it and the
number of swaps since; the same rule over one row per split gives each split
its beginning. Two passes over the staged lines, one task per split.

Where no line can leave a quote open, lines are records as they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.operators.ordinals import number_file_rows
from tidemark.session import observed, shared_dir, stage

# What ended a line, by its code.
ENDS = ["\n", "\r\n", "\r"]
# A line without quotes: outside stays outside and inside stays inside, for either delimiter.
NO_QUOTES = 0b1010


# Patterns recurse at repetitions, so longer lines are read by :func:`_ends_inside`.
PATTERN_CHARS = 500


def _inside_pattern(sep: str, inside: bool) -> str:
    """Matches a line that begins outside (or inside) quotes and ends inside them, as :func:`_ends_inside` reads it."""
    open_cell = '[^"]*+(?:""[^"]*+)*+'
    tail = f'(?:[^"{sep}][^{sep}]*+)?+'
    cell = f'(?:"{open_cell}"{tail}|{tail})'
    from_outside = f'(?:{cell}{sep})*+"{open_cell}'
    return f'(?s)\\A{open_cell}(?:"{tail}{sep}{from_outside})?+\\z' if inside else f"(?s)\\A{from_outside}\\z"


def _ends_inside(value: Column, sep: str, inside: bool) -> Column:
    """1 if a line that begins outside (or inside) quotes ends inside them.

    Only a quote at the beginning of a cell opens one; inside, a doubled quote is
    a quote. States: 0 at the beginning of a cell, 1 inside, 2 just behind a
    quote inside, 3 in a cell without opening quote.
    """
    def text(state: Column, piece: Column) -> Column:
        behind = F.when(piece.endswith(sep), 0).otherwise(3)
        return F.when((state == 1) | (piece == ""), state).otherwise(behind)

    def quote(state: Column) -> Column:
        return F.when(state == 1, 2).when(state == 3, 3).otherwise(1)

    pieces = F.split(value, '"', -1)
    first = text(F.lit(1 if inside else 0), F.get(pieces, F.lit(0)))
    rest = F.slice(pieces, F.lit(2), F.size(pieces))
    return F.aggregate(rest, first, lambda s, piece: text(quote(s), piece), lambda s: (s == 1).cast("int"))


def _turn(value: Column) -> Column:
    """The line's function as bits: comma outside, comma inside, tab outside, tab inside."""
    kinds = [(sep, inside) for sep in (",", "\t") for inside in (False, True)]
    matched = [value.rlike(_inside_pattern(sep, inside)).cast("int") for sep, inside in kinds]
    read = [_ends_inside(value, sep, inside) for sep, inside in kinds]
    packed, long_packed = (sum((F.shiftleft(bit, k) for k, bit in enumerate(bits)), F.lit(0)) for bits in (matched, read))
    return F.when(~F.contains(value, F.lit('"')), NO_QUOTES).when(F.length(value) <= PATTERN_CHARS, packed).otherwise(long_packed)


def staged_lines(text: DataFrame) -> tuple[DataFrame, bool]:
    """Lines of a text scan (split at ``\\n`` alone) with their position; and whether they are records as they are."""
    spark = text.sparkSession
    others = [c for c in text.columns if c != "value"]
    body = F.regexp_replace("value", "\r$", "")
    pieces = text.select(
        "*", F.when(F.endswith("value", F.lit("\r")), 1).otherwise(0).alias("_last"), F.split(body, "\r", -1).alias("_pieces")
    )
    position = {"_file": F.col("_metadata.file_path"), "_block": F.col("_metadata.file_block_start")}
    pieces = pieces.withColumns(position).select(*others, "_file", "_block", "_last", F.size("_pieces").alias("_n"), F.posexplode("_pieces").alias("_at", "value"))
    lines = pieces.select(
        *others, "value", "_file", "_block", F.when(F.col("_at") == F.col("_n") - 1, F.col("_last")).otherwise(2).alias("_end"),
        _turn(F.col("value")).alias("_turn"), F.monotonically_increasing_id().alias("_row"),
    )
    seen, path = Observation(), shared_dir(spark, "export-lines")
    plain = (F.col("value") != "") & (F.col("_turn").bitwiseAND(0b0101) == 0)
    lines.observe(seen, F.count_if(~plain).alias("special")).write.parquet(path)
    staged = spark.read.schema(lines.schema).parquet(path)
    staged._staged_at = path
    return staged, observed(seen).get("special", 0) == 0


def file_heads(lines: DataFrame) -> DataFrame:
    """_file, a number for it (_no) and its first line that is not empty.

    Staged: its size is known when lines are joined to it.
    """
    first = lines.where("_block = 0 AND value <> ''").groupBy("_file").agg(F.min("_row").alias("_no"))
    named = lines.select("_file", F.col("_row").alias("_no"), F.col("value").alias("_head"))
    return stage(named.join(stage(first, "export-firsts"), ["_file", "_no"]), "export-heads")


def _before(order: str, f0: str, f1: str, by: list[str]) -> tuple[Column, Column]:
    """The state before a row, given that the first row of its group begins outside or inside."""
    earlier = Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    swaps = F.coalesce(F.sum(F.when((F.col(f0) == 1) & (F.col(f1) == 0), 1).otherwise(0)).over(earlier), F.lit(0))
    settled = F.max(F.when(F.col(f0) == F.col(f1), F.struct(F.col(order), F.col(f0).alias("state"), F.col("_swaps").alias("swaps")))).over(earlier)
    return swaps, settled


def _states(rows: DataFrame, order: str, f0: str, f1: str, by: list[str]) -> DataFrame:
    """Adds _s0 and _s1: the state before each row if its group begins outside or inside quotes."""
    swaps, _ = _before(order, f0, f1, by)
    rows = rows.withColumn("_swaps", swaps)
    _, settled = _before(order, f0, f1, by)
    rows = rows.withColumn("_settled", settled)

    def state(start: int) -> Column:
        open_ = (F.lit(start) + F.col("_swaps")) % 2
        return F.when(F.col("_settled").isNull(), open_).otherwise((F.col("_settled.state") + F.col("_swaps") - F.col("_settled.swaps")) % 2)

    return rows.withColumns({"_s0": state(0), "_s1": state(1)}).drop("_swaps", "_settled")


def _after(start: str) -> Column:
    return F.when(F.col(start) == 1, F.col("_f1")).otherwise(F.col("_f0"))


def records(lines: DataFrame, others: list[str], heads: DataFrame) -> DataFrame:
    """``others``, _no of the file, value and _ordinal (-1: the header) of every record.

    A record is a line that is not empty and does not lie inside a quoted cell,
    with the lines after it that its open quotes take in. A file whose last
    quote stays open fails. Lines carry their file's number instead of its long name.
    """
    spark: SparkSession = lines.sparkSession
    split = ["_no", "_block"]
    tabbed = heads.select("_file", "_no", F.contains("_head", F.lit("\t")).alias("_tabbed"))
    bit = lambda k: F.shiftright("_turn", k).bitwiseAND(1)
    turned = lines.join(tabbed, "_file").select(
        *others, "value", *split, "_row", "_end",
        F.when(F.col("_tabbed"), bit(2)).otherwise(bit(0)).alias("_f0"), F.when(F.col("_tabbed"), bit(3)).otherwise(bit(1)).alias("_f1"),
    )
    stated = _states(turned, "_row", "_f0", "_f1", split)
    through = Window.partitionBy(*split).orderBy("_row").rowsBetween(Window.unboundedPreceding, 0)
    begins = lambda s: F.when((F.col(s) == 0) & (F.col("value") != ""), 1).otherwise(0)
    stated = stated.withColumns({"_r0": F.sum(begins("_s0")).over(through), "_r1": F.sum(begins("_s1")).over(through)})
    path = shared_dir(spark, "export-states")
    stated.write.parquet(path)
    stated = spark.read.schema(stated.schema).parquet(path)

    chunks = stated.groupBy(*split).agg(
        F.max_by(_after("_s0"), "_row").alias("_f0"), F.max_by(_after("_s1"), "_row").alias("_f1"),
        F.max("_r0").alias("_n0"), F.max("_r1").alias("_n1"),
    )
    chunks = _states(chunks.join(heads.select("_no", "_file"), "_no"), "_block", "_f0", "_f1", ["_no"])
    by_file = Window.partitionBy("_no").orderBy("_block")
    unclosed = F.lead("_block").over(by_file).isNull() & (_after("_s0") == 1)
    message = F.concat(F.lit("a quote is never closed in "), F.col("_file"))
    chunks = chunks.withColumn("_begin", F.when(unclosed, F.raise_error(message).cast("int")).otherwise(F.col("_s0")))
    held = F.when(F.col("_s0") == 1, F.col("_n1")).otherwise(F.col("_n0"))
    offsets = F.coalesce(F.sum(held).over(by_file.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    # Staged: one small row per split, whose size is then known when lines are joined to them.
    chunks = stage(chunks.withColumn("_offset", offsets).select(*split, "_begin", "_offset"), "export-splits")

    placed = stated.join(chunks, split)
    inside = F.when(F.col("_begin") == 1, F.col("_s1")).otherwise(F.col("_s0"))
    number = F.col("_offset") + F.when(F.col("_begin") == 1, F.col("_r1")).otherwise(F.col("_r0"))
    placed = placed.withColumns({"_inside": inside, "_record": number}).withColumn("_open", _after("_inside"))
    whole = placed.where("_inside = 0 AND _open = 0 AND value <> ''").select(*others, "_no", "_record", "value")
    ends = F.element_at(F.array(*[F.lit(e) for e in ENDS]), F.col("_end") + 1)
    broken = placed.where("_inside = 1 OR _open = 1").groupBy(*others, "_no", "_record").agg(
        F.sort_array(F.collect_list(F.struct("_block", "_row", "value", ends.alias("end")))).alias("_lines")
    )
    text = F.transform("_lines", lambda x, i: F.when(i == F.size("_lines") - 1, x["value"]).otherwise(F.concat(x["value"], x["end"])))
    joined = broken.select(*others, "_no", "_record", F.array_join(text, "").alias("value"))
    return whole.unionByName(joined).select(*others, "_no", "value", (F.col("_record") - 2).alias("_ordinal"))


def numbered_records(lines: DataFrame, plain: bool, others: list[str], heads: DataFrame | None = None) -> DataFrame:
    """Records as :func:`records` gives them, without its passes where lines are records."""
    heads = file_heads(lines) if heads is None else heads
    if plain:
        numbered = number_file_rows(lines.join(heads.select("_file", "_no"), "_file"), "_ordinal", start=-1)
        return numbered.select(*others, "_no", "value", "_ordinal")
    return records(lines, others, heads)
