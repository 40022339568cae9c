"""From documents to packed training sequences, in stages that are written and read again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import exact_dedup, kneser_ney, minhash, mixing, packing
from tidemark.llm.common import Scratch, join_checked
from tidemark.llm.queries import table, tokenizer_path

# Executors that have run all stages have less memory left than those of one operator alone.
QUALITY_SIZES = {"block_bytes": 2 << 20, "part_bytes": 512 << 10, "shard_bytes": kneser_ney.BLOCK_BYTES}


def _without(docs: DataFrame, decided: DataFrame, label: str) -> DataFrame:
    """``docs`` less those whose id is not kept in ``decided``; rows of one id stand or fall together."""
    gone = Scratch(docs.sparkSession, label).put(decided.where(~F.col("kept")).select("doc_id").distinct(), "gone")
    return join_checked(docs, gone, "doc_id", "left_anti").select(*docs.columns)


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the model of trusted text does not reject."""
    decided = kneser_ney.quality(docs, table(spark, sf_dir, "labels"), **QUALITY_SIZES)
    return _without(docs, decided, "quality-gone")


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return _without(docs, exact_dedup.exact_duplicates(docs), "exact-gone")


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of similar texts."""
    return _without(docs, minhash.near_duplicates(docs), "minhash-gone")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it; those it does not take go."""
    copies = mixing.mix(docs).select("doc_id", F.col("copies").cast("int").alias("_copies")).where("_copies > 0").dropDuplicates(["doc_id"])
    taken = Scratch(spark, "mix-taken").put(copies, "copies")
    repeated = F.explode(F.sequence(F.lit(1), F.col("_copies"))).alias("_copy")
    return join_checked(docs, taken, "doc_id").select(*docs.columns, repeated).drop("_copy")


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents placed in sequences."""
    return packing.pack(docs, tokenizer_path())


STAGES = [
    ("quality", keep_quality),
    ("exact", drop_copies),
    ("minhash", drop_near_copies),
    ("mix", mix_sources),
    ("pack", pack_sequences),
]

# Perplexities, similarities and packing have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        after = scratch.put(stage(spark, docs, sf_dir), name)
        if hasattr(docs, "_staged_at"):
            scratch.drop(docs)
        docs = after
    return STAGES[-1][1](spark, docs, sf_dir)
