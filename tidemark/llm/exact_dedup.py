"""Exact duplicates by an extendible-hash index on shared files.

Two texts are equal when identical after each run of ``[\\x20\\x09-\\x0D]`` is
replaced by one space. Null counts as the empty text; empty texts are equal to
each other. Of equal texts the row with the smallest id stays. Extra columns
of the input are not read. An empty table gives an empty result.

The index maps the top bits of a 64-bit hash to buckets. The directory doubles
its depth until every bucket holds at most ``capacity`` keys; equal keys are
one entry, so copies never overfill a bucket. Entries are counted per task
before they are shuffled, and owner tasks get ranges of buckets. Texts whose
hash is unique need no comparison. The others are chained per hash by grouping
on the text itself, which compares bytes, so two texts with one hash stay apart.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import SPACES, Scratch, join_checked


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACES, " ")


def directory(keys: DataFrame, capacity: int, most_bits: int = 24) -> DataFrame:
    """(slot, bits, bucket, depth): every slot of the directory and the bucket it points to.

    ``keys`` has one row per distinct hash ``h``. A bucket of depth d holds the
    hashes that share their top d bits; it is split while it holds more than
    ``capacity``, up to the directory's ``bits``, which follow the number of keys.
    """
    n = max(1, keys.count())
    bits = min(most_bits, max(1, math.ceil(math.log2(n / capacity)) + 4 if n > capacity else 1))
    slots = keys.groupBy(F.shiftrightunsigned("h", 64 - bits).alias("slot")).agg(F.count(F.lit(1)).alias("n"))
    levels = slots.withColumn("depth", F.explode(F.sequence(F.lit(0), F.lit(bits)))).withColumn(
        "bucket", F.expr(f"slot div cast(power(2, {bits} - depth) as bigint)")
    )
    filled = levels.groupBy("depth", "bucket").agg(F.sum("n").alias("n"))
    fits = levels.drop("n").join(filled, ["depth", "bucket"]).where((F.col("n") <= capacity) | (F.col("depth") == bits))
    return fits.groupBy("slot").agg(F.min(F.struct("depth", "bucket")).alias("b")).select(
        "slot", F.lit(bits).alias("bits"), "b.bucket", "b.depth"
    )


def exact_duplicates(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", capacity: int = 4096
) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256, bucket and chain position, one row per row."""
    scratch = Scratch(docs.sparkSession, "exact")
    text = normalised(F.col(text_column))
    entries = scratch.put(
        docs.select(F.col(id_column).alias("doc_id"), text.alias("t"))
        .select("doc_id", F.xxhash64("t").alias("h"), F.sha2("t", 256).alias("text_sha256")),
        "entries",
    )
    keys = scratch.put(entries.groupBy("h").agg(F.count(F.lit(1)).alias("n")), "keys")
    shared = scratch.put(keys.where("n > 1").select("h"), "shared")
    # Only texts that share their hash with another row are compared.
    compared = join_checked(docs.select(F.col(id_column).alias("doc_id"), text.alias("t")).withColumn("h", F.xxhash64("t")),
                            shared, "h", "left_semi")
    chains = compared.groupBy("h", "t").agg(F.min("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size")).select(
        "h", F.sha2("t", 256).alias("text_sha256"), "keep_id", "group_size"
    )
    slots = scratch.put(directory(keys, capacity), "directory")
    bits = slots.agg(F.max("bits")).first()[0] or 1
    placed = join_checked(chains.withColumn("slot", F.shiftrightunsigned("h", 64 - bits)), slots, "slot")
    chain = Window.partitionBy("bucket", "depth", "h").orderBy("keep_id")
    index = scratch.put(
        placed.repartitionByRange("bucket", "h").withColumn("chain_position", F.row_number().over(chain))
        .select("h", "text_sha256", "keep_id", "group_size", "bucket", "chain_position"),
        "index",
    )
    found = join_checked(entries, index, ["h", "text_sha256"], "left")
    keep = F.coalesce("keep_id", "doc_id")
    return found.select(
        "doc_id", keep.alias("keep_id"), F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"),
        (keep == F.col("doc_id")).alias("kept"), "text_sha256", "bucket", "chain_position",
    )
