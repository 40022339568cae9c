"""What several operators share: staging, guarded joins, running totals, components."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Iterator, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.sources import paths

SPACES = r"[\x20\x09-\x0D]+"
# A side of at most so many rows is broadcast, if its rows are narrow.
BROADCAST_ROWS = 500_000
# Rows with whole texts that are handed to Python at once.
BATCH_ROWS = 1000


class Scratch:
    """Tables of one run in the cluster's shared folder (``spark.checkpoint.dir``).

    A staged table cuts the lineage and survives the loss of any executor.
    ``drop`` removes one that no later step reads; what the result itself
    reads stays, since results are lazy.
    """

    def __init__(self, spark: SparkSession, label: str):
        root = spark.conf.get("spark.checkpoint.dir", None)
        if not root:
            raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
        self.spark = spark
        self.root = f"{root.rstrip('/')}/tidemark/{label}-{uuid.uuid4().hex}"
        self.made = 0

    def put(self, df: DataFrame, name: str, codec: str = "zstd") -> DataFrame:
        path = f"{self.root}/{name}-{self.made}"
        self.made += 1
        df.write.option("compression", codec).parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        out._staged_at = path
        return out

    def drop(self, *tables: DataFrame) -> None:
        for table in tables:
            paths.delete(self.spark, table._staged_at)


def join_checked(
    big: DataFrame, small: DataFrame, on: str | list[str], how: str = "inner",
    rows: int | None = None, most: int = BROADCAST_ROWS,
) -> DataFrame:
    """Join with ``small`` broadcast if it has at most ``most`` rows, else shuffled.

    ``small`` must have narrow rows and be staged, so that counting it is cheap.
    Beyond the bound both sides are shuffled and adaptive execution splits hot keys.
    """
    n = small.count() if rows is None else rows
    return big.join(F.broadcast(small) if n <= most else small, on, how)


def tasks_of(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def running_total(
    df: DataFrame, group: Sequence[str], order: Sequence[Column], order_names: Sequence[str], value: str,
    out: str, scratch: Scratch,
) -> DataFrame:
    """Sum of integer ``value`` over the earlier rows and this one of its group.

    Rows are range-partitioned by group and a total order, so a hot group spans
    many tasks. Each task's part of a group is summed, and only those sums (one
    row per group and task) are ordered per group.
    """
    ranged = df.repartitionByRange(*[F.col(g) for g in group], *order).withColumn("_part", F.spark_partition_id())
    rows = scratch.put(ranged, "ranged")
    keys = [*group, "_part"]
    parts = rows.groupBy(*keys).agg(F.sum(value).alias("_sum"))
    earlier = Window.partitionBy(*group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.withColumn("_offset", F.coalesce(F.sum("_sum").over(earlier), F.lit(0))).drop("_sum")
    inside = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    summed = rows.withColumn(out, F.sum(value).over(inside))
    return summed.join(offsets, keys).withColumn(out, F.col(out) + F.col("_offset")).drop("_part", "_offset")


def connected_components(edges: DataFrame, scratch: Scratch, rounds: int = 50) -> DataFrame:
    """(v, component) of every vertex of ``edges`` (a, b long); component is the smallest vertex.

    Large-star and small-star steps in turn, each a grouped minimum joined
    back, until nothing changes: a logarithmic number of rounds in practice.
    Minima combine before their shuffle and joins split hot vertices, so a
    vertex with very many links is no problem. Self-links are ignored.
    """
    spark = edges.sparkSession
    now = scratch.put(
        edges.select(F.least("a", "b").alias("p"), F.greatest("a", "b").alias("v")).where("p <> v").distinct(), "edges"
    )

    def signature(e: DataFrame) -> tuple:
        row = e.agg(F.count(F.lit(1)), F.sum("p"), F.sum(F.xxhash64("v", "p").cast("decimal(20,0)"))).first()
        return tuple(row)

    last = signature(now)
    for _ in range(rounds):
        if last[0] == 0:
            break
        both = now.select("v", F.col("p").alias("n")).union(now.select(F.col("p").alias("v"), F.col("v").alias("n")))
        least = both.groupBy("v").agg(F.min("n").alias("m")).withColumn("m", F.least("m", "v"))
        large = both.where("n > v").join(least, "v").select(F.col("n").alias("v"), F.col("m").alias("p")).distinct()
        large = large.where("v <> p")
        # In the small-star step a vertex looks at its smaller neighbours only.
        least = large.groupBy("v").agg(F.min("p").alias("m"))
        linked = large.join(least, "v")
        small = linked.select(F.col("p").alias("v"), F.col("m").alias("p")).union(linked.select("v", F.col("m").alias("p")))
        new = scratch.put(small.where("v <> p").distinct(), "edges")
        scratch.drop(now)
        now, seen = new, signature(new)
        if seen == last:
            break
        last = seen
    else:
        raise RuntimeError(f"components have not settled after {rounds} rounds; allow more")
    if not last[0]:
        return spark.createDataFrame([], "v long, component long")
    roots = now.select(F.col("p").alias("v"), F.col("p").alias("component")).distinct()
    return now.groupBy("v").agg(F.min("p").alias("component")).union(roots)


def linked_components(
    members: DataFrame, signatures: DataFrame, estimate: Callable[[str, str], Column], least: float,
    confirmed: Callable[[DataFrame], DataFrame], scratch: Scratch,
    finer: Callable[[DataFrame], tuple[DataFrame, Callable[[str, str], Column]]] | None = None,
) -> DataFrame:
    """(v, component) of rows that share buckets, without pairing out any bucket.

    ``members``: key, doc_id and n, the size of the bucket. ``signatures``: doc_id
    and columns from which ``estimate`` of two prefixes tells how like two rows
    are; pairs below ``least`` are not checked. ``confirmed`` keeps the pairs (a, b)
    that are linked.

    Every member is first checked with one pivot: a bucket's pivot is the member
    that shares most with others, a member's is the one it shares most buckets
    with. Members that are then still outside their bucket pivot's component are
    checked with the likely members of other components in the bucket; the join
    that finds these gives likely pairs only, each in the smallest bucket it shares.
    A likely linked pair with a common bucket is so either confirmed or within one
    component already.

    ``finer`` may give, for the rows (doc_id) that this join concerns, longer
    signatures and the condition under which a pair of them is likely.
    """
    def signed(df: DataFrame, v: str, by: DataFrame = signatures) -> DataFrame:
        return df.join(by.select(F.col("doc_id").alias(v), *[F.col(c).alias(f"{v}_{c}") for c in by.columns if c != "doc_id"]), v)

    ranks = members.groupBy("doc_id").agg(F.sum(F.log2("n")).alias("rank"))
    pivots = scratch.put(
        members.join(ranks, "doc_id").groupBy("key").agg(F.max(F.struct("rank", (-F.col("doc_id")).alias("d"))).alias("p"))
        .select("key", (-F.col("p.d")).alias("b")), "pivots",
    )
    stars = members.select("key", F.col("doc_id").alias("a")).join(pivots, "key").where("a <> b")
    shared = stars.groupBy("a", "b").agg(F.count(F.lit(1)).alias("shared"))
    nearest = shared.groupBy("a").agg(F.max(F.struct("shared", "b")).alias("m")).select("a", "m.b")
    tried = scratch.put(signed(signed(nearest, "a"), "b").where(estimate("a_", "b_") >= least).select("a", "b"), "tried")
    links = confirmed(tried)
    components = scratch.put(connected_components(links, scratch), "components")

    def component(df: DataFrame, v: str, out: str) -> DataFrame:
        return df.join(components.select(F.col("v").alias(v), F.col("component").alias(out)), v, "left").withColumn(out, F.coalesce(out, v))

    placed = scratch.put(component(members.select("key", F.col("doc_id").alias("a")), "a", "ca"), "placed")
    hub = component(pivots, "b", "cb").select("key", "cb")
    outside = scratch.put(placed.join(hub, "key").where("ca <> cb").select("key", "a", "ca"), "outside")
    if outside.isEmpty():
        scratch.drop(pivots, tried, placed, outside)
        return components
    open_ = outside.select("key").distinct()
    inside = scratch.put(placed.join(open_, "key", "left_semi").select("key", F.col("a").alias("b"), F.col("ca").alias("cb")), "inside")
    by, likely = signatures, lambda a, b: estimate(a, b) >= least
    if finer:
        by, likely = finer(scratch.put(inside.select(F.col("b").alias("doc_id")).distinct(), "open"))

    def bucketed(df: DataFrame, v: str) -> DataFrame:
        return signed(df, v, by).join(df.groupBy(v).agg(F.collect_list("key").alias(f"keys_{v}")), v)

    left, right = bucketed(outside, "a"), bucketed(inside, "b").withColumnRenamed("key", "key_b")
    # Conditions are tried in this order, so few pairs come to the last.
    once = F.array_min(F.array_intersect("keys_a", "keys_b")) == F.col("key")
    near = (F.col("key") == F.col("key_b")) & (F.col("ca") != F.col("cb")) & likely("a_", "b_") & once
    pairs = left.join(right, near).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    known = tried.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    more = scratch.put(pairs.join(known, ["a", "b"], "left_anti"), "more")
    if not more.isEmpty():
        links = scratch.put(links.union(confirmed(more)), "links")
        components = scratch.put(connected_components(links, scratch), "components")
    scratch.drop(pivots, tried, placed, outside, inside, more)
    return components


def release_memory() -> None:
    """Hand what a Python worker has freed back to the machine: idle workers stay, and the next stage needs the memory."""
    import ctypes

    import pyarrow as pa

    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def small_batches(df: DataFrame) -> DataFrame:
    """``df`` itself, its session set to hand Python ``BATCH_ROWS`` rows at a time: a batch is held whole on both sides."""
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return df


def arrow_rows(batches: Iterator, names: Sequence[str]) -> Iterator[tuple]:
    """Rows of Arrow batches as tuples of Python values."""
    for batch in batches:
        yield from zip(*[batch.column(batch.schema.get_field_index(n)).to_pylist() for n in names], strict=True)


def arrow_chunks(rows: Iterable[tuple], schema, size: int = 5000) -> Iterator:
    """Tuples as Arrow batches of at most ``size`` rows."""
    import pyarrow as pa

    held: list[tuple] = []

    def batch():
        columns = zip(*held, strict=True)
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

    for row in rows:
        held.append(row)
        if len(held) >= size:
            yield batch()
            held.clear()
    if held:
        yield batch()
