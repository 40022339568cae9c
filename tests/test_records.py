"""Records whose quoted cells hold line breaks, against Python's csv reader."""

import csv
import io
import itertools
import random

import pytest
from pyspark.sql import functions as F

from tidemark.sources import records
from tidemark.sources.exports import read_exports
from tidemark.sources.records import numbered_records, staged_lines

CELLS = ["a", "", "two words", 'say "hi"', "first\nsecond", "x\n\ny", "tail\r\nnext", '"', "\n", 'q"\n"q', "comma, here", "tab\there", "cr\ralone"]


def land(root, model, content):
    folder = root / "workspace_id=w1" / f"model_id={model}"
    folder.mkdir(parents=True, exist_ok=True)
    (folder / "export.csv").write_bytes(content.encode())


def found(spark, root, split_bytes=None):
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(split_bytes or 1 << 20))
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        text = spark.read.schema("value string, workspace_id string, model_id string").option("lineSep", "\n").text(str(root))
        lines, plain = staged_lines(text.select("value", "model_id", "_metadata"))
        rows = numbered_records(lines, plain, ["model_id"]).collect()
        return rows, plain, lines.select("_block").distinct().count()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
        spark.conf.unset("spark.sql.files.openCostInBytes")


def written(rows, sep, end="\n"):
    out = io.StringIO(newline="")
    csv.writer(out, delimiter=sep, lineterminator=end).writerows(rows)
    return out.getvalue()


@pytest.mark.parametrize(("sep", "end"), [(",", "\n"), ("\t", "\r\n")])
def test_records_across_splits(spark, tmp_path, sep, end):
    """Every record of files of many splits, whatever lies at their borders."""
    rng = random.Random(sep)
    # The first line of a header tells the delimiter.
    files = {f"m{f}": [["h1", "h2", "h3"], *[[rng.choice(CELLS) + rng.choice(["", "z"]) for _ in range(3)] for _ in range(50)]] for f in range(2)}
    for model, rows in files.items():
        land(tmp_path, model, written(rows, sep, end))
    got, plain, splits = found(spark, tmp_path, 200)
    assert not plain and splits > 5
    for model, rows in files.items():
        mine = {r["_ordinal"]: r["value"] for r in got if r["model_id"] == model}
        assert sorted(mine) == list(range(-1, 50))
        parsed = {i: next(csv.reader(io.StringIO(v, newline=""), delimiter=sep)) for i, v in mine.items()}
        assert parsed == {i - 1: row for i, row in enumerate(rows)}


def test_stray_quotes_open_nothing(spark, tmp_path):
    land(tmp_path, "m1", 'date_time_utc,user,description\nd,u,5" pipe\nd,u,"closed"tail"\nd,u,plain\n\nd,u,a"b"c"\n')
    got, _, _ = found(spark, tmp_path)
    assert {r["_ordinal"]: r["value"] for r in got} == {
        -1: "date_time_utc,user,description", 0: 'd,u,5" pipe', 1: 'd,u,"closed"tail"', 2: "d,u,plain", 3: 'd,u,a"b"c"'}


def test_plain_lines_take_the_short_way(spark, tmp_path):
    land(tmp_path, "m1", 'a,b\r\n1,"x, y"\r\n2,"say ""hi"""\r\n')
    got, plain, _ = found(spark, tmp_path)
    assert plain and {r["_ordinal"]: r["value"] for r in got} == {-1: "a,b", 0: '1,"x, y"', 1: '2,"say ""hi"""'}


def test_exports_with_line_breaks(spark, tmp_path):
    rows = [["date_time_utc", "user", "description", "Previous Value\n(old)"], ["2025", "u", "two\nlines", "old"], ["2026", "v", 'a "b"\n\nc', "x\r\ny"], ["2027", "w", "one", ""]]
    land(tmp_path, "m1", written(rows, ","))
    land(tmp_path, "m2", written([["date_time_utc", "user", "description"], ["1", "2", "3"]], "\t"))
    land(tmp_path, "m3", "")
    got = read_exports(spark, str(tmp_path), "T").where(F.col("model_id") == "m1").collect()
    assert {tuple(r[c] for c in ("date_time_utc", "user", "description", "previous_value")) for r in got} == {tuple(r) for r in rows[1:]}
    assert read_exports(spark, str(tmp_path), "T").count() == 4


def test_a_quote_that_stays_open_fails(spark, tmp_path):
    land(tmp_path, "m1", 'date_time_utc,user,description\nd,u,"never closed\nd,u,x\n')
    with pytest.raises(Exception, match="a quote is never closed in .*model_id=m1"):
        read_exports(spark, str(tmp_path), "T").collect()


def test_patterns_read_quotes_as_the_states_do(spark):
    """Every short line, and long ones that patterns are not tried on."""
    lines = ["".join(p) for n in range(7) for p in itertools.product('",\tx', repeat=n)]
    lines += ['"' + 'a""' * 20000, "x," * 20000 + '"', '"' + "b" * (records.PATTERN_CHARS - 1)]
    df = spark.createDataFrame([(x,) for x in lines], "value string").repartition(8)
    bits = {f"{'c' if sep == ',' else 't'}{inside:d}": records._ends_inside(F.col("value"), sep, inside) for sep in ",\t" for inside in (False, True)}
    read = sum((F.shiftleft(bit, k) for k, bit in enumerate(bits.values())), F.lit(0))
    wrong = df.where(records._turn(F.col("value")) != F.when(F.contains("value", F.lit('"')), read).otherwise(records.NO_QUOTES))
    assert wrong.collect() == []


def test_lines_carry_no_file_name_through_the_passes(spark, tmp_path):
    """The long name of its file was a large part of what a task sorts a line with."""
    land(tmp_path, "m1", 'date_time_utc,user,description\nd,u,"a\nb"\n')
    rows, plain, _ = found(spark, tmp_path)
    assert not plain and "_file" not in rows[0].asDict()


def test_shuffles_begin_with_many_partitions(spark):
    """Of a fixed number each would grow with the input; small ones are put together."""
    assert int(spark.conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum")) >= 1000
    small = spark.range(100).groupBy((F.col("id") % 7).alias("k")).count()
    assert small.rdd.getNumPartitions() <= 8
