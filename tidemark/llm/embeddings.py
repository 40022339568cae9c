"""Near-duplicate vectors by Euclidean p-stable hashing.

Vectors are normalised. In each of several tables, ``k`` Gaussian projections are
shifted, divided by a width and rounded down; equal k-tuples share a bucket. At
cosine 0.9 a pair shares one of the 72 tables with probability 0.993, at 0.95 with
0.99999. Bucket rows carry the id and 128 sign bits of other projections, which
sort out unlikely pairs; every link is an exact cosine in double precision.

Members are compared with a pivot of their bucket, then across components
(see ``linked_components``). Inside a component all vectors are compared in blocks,
so links are counted exactly there, also where no table had the pair, and no pair
is ever a row. Equal vectors are one class that counts with its size.

Vectors that are null, empty or zero, or hold null or non-finite components, link
with nothing and are their own component. Only vectors of the same length are
compared. Rows that repeat an id count as different vectors of that id. Labels
and other columns are not read. An empty table gives none.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import Scratch, linked_components

TABLES, K, WIDTH = 72, 10, 1.5
BLOCK = 1024
# At cosine 0.9 18 of 128 signs differ on average; this is 4.4 standard deviations more.
MOST_SIGNS = 36


def _hashed(vectors: DataFrame) -> DataFrame:
    """vec_id, keys (one per table) and two longs of sign bits, for usable vectors."""
    import numpy as np
    import pyarrow as pa

    from tidemark.llm import textarrays as ta

    schema = pa.schema([("vec_id", pa.int64()), ("keys", pa.list_(pa.int64())), ("s0", pa.int64()), ("s1", pa.int64())])

    def run(batches: Iterator) -> Iterator:
        drawn: dict[int, tuple] = {}
        factors = ta.mixed(np.arange(1, K + 1, dtype=np.uint64)) | np.uint64(1)
        bits = np.uint64(1) << np.arange(64, dtype=np.uint64)
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            lists = batch.column(1)
            lengths = lists.value_lengths().to_numpy(zero_copy_only=False)
            for n in np.unique(lengths).tolist():
                at = np.flatnonzero(lengths == n)
                x = lists.take(pa.array(at)).flatten().to_numpy(zero_copy_only=False).astype(float).reshape(len(at), n)
                x = x / np.linalg.norm(x, axis=1)[:, None]
                if n not in drawn:
                    rng = np.random.default_rng([3, n])
                    drawn[n] = rng.normal(size=(n, TABLES * K)), rng.uniform(0, WIDTH, TABLES * K), rng.normal(size=(n, 128))
                a, b, c = drawn[n]
                cells = np.floor((x @ a + b) / WIDTH).astype(np.int64).view(np.uint64).reshape(len(at), TABLES, K)
                tables = np.arange(TABLES, dtype=np.uint64) * np.uint64(1 << 20) + np.uint64(n)
                keys = ta.mixed((ta.mixed(cells) * factors).sum(axis=2) + ta.mixed(tables)).view(np.int64)
                signs = ((x @ c > 0).reshape(len(at), 2, 64) * bits).sum(axis=2, dtype=np.uint64).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[at]), pa.array(list(keys), pa.list_(pa.int64())), pa.array(signs[:, 0].copy()), pa.array(signs[:, 1].copy())], schema=schema
                )

    return vectors.mapInArrow(run, "vec_id long, keys array<long>, s0 long, s1 long")


def _usable(v: Column) -> Column:
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(v.isNotNull() & ~bad & F.exists(v, lambda x: x != 0), F.lit(False))


def _cosines(pairs: DataFrame, vectors: DataFrame, least: float) -> DataFrame:
    """The pairs (a, b) with at least this cosine."""
    import numpy as np
    import pyarrow as pa

    def run(batches: Iterator) -> Iterator:
        for batch in batches:
            kept = []
            for i, (u, v) in enumerate(zip(batch.column(2), batch.column(3), strict=True)):
                x, y = (np.asarray(s.values.to_numpy(zero_copy_only=False), float) for s in (u, v))
                kept.append(len(x) == len(y) and x @ y >= least * np.linalg.norm(x) * np.linalg.norm(y))
            yield batch.select(["a", "b"]).filter(pa.array(kept, pa.bool_()))

    sides = [vectors.select(F.col("vec_id").alias(k), F.col("v").alias("v" + k)) for k in "ab"]
    return pairs.select("a", "b").join(sides[0], "a").join(sides[1], "b").select("a", "b", "va", "vb").mapInArrow(run, "a long, b long")


def _links_inside(vectors: DataFrame, least: float) -> DataFrame:
    """(vec_id, linked): summed weights of the vectors of its component that it is linked with, itself included.

    ``vectors``: component, size (of the component), vec_id, weight, v. A component
    is cut into blocks, and each pair of blocks is one task's matrix product.
    """
    import numpy as np
    import pyarrow as pa

    blocks = F.ceil(F.col("size") / BLOCK).cast("int")
    own = vectors.withColumn("blocks", blocks).withColumn("block", F.pmod(F.xxhash64("vec_id"), F.col("blocks")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    dealt = own.withColumn("other", other).select(
        "component", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"),
        F.when(F.col("block") <= F.col("other"), 0).otherwise(1).alias("side"), "vec_id", "weight", "v",
    )
    sorted_ = dealt.repartition("component", "i", "j").sortWithinPartitions("component", "i", "j", "side")
    schema = pa.schema([("vec_id", pa.int64()), ("linked", pa.int64())])

    def run(batches: Iterator) -> Iterator:
        held: list[tuple] = []

        def counted():
            same = held[0][0][1] == held[0][0][2]
            sides = [[h for h in held if h[1] == s] for s in (0, 1)]
            if same:
                sides[1] = sides[0]
            if not sides[0] or not sides[1]:
                return [], []
            ids, weights, unit = [], [], []
            for side in sides:
                ids.append(np.array([h[2] for h in side], np.int64))
                weights.append(np.array([h[3] for h in side], np.int64))
                x = np.array([h[4] for h in side], float)
                unit.append((x, np.linalg.norm(x, axis=1)))
            near = unit[0][0] @ unit[1][0].T >= least * np.outer(unit[0][1], unit[1][1])
            out_ids, out = [ids[0]], [near @ weights[1]]
            if not same:
                out_ids.append(ids[1])
                out.append(near.T @ weights[0])
            return np.concatenate(out_ids), np.concatenate(out)

        def emit():
            found = counted()
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array(found[0], pa.int64()), pa.array(found[1], pa.int64())], schema=schema)

        for batch in batches:
            columns = [c.to_pylist() for c in batch.columns]
            for component, i, j, side, vec_id, weight, v in zip(*columns, strict=True):
                key = (component, i, j)
                if held and held[0][0] != key:
                    yield emit()
                held.append((key, side, vec_id, weight, v))
        if held:
            yield emit()

    return sorted_.mapInArrow(run, "vec_id long, linked long").groupBy("vec_id").agg(F.sum("linked").alias("linked"))


def near_vectors(embeddings: DataFrame, least: float = 0.9, id_column: str = "vec_id", vector_column: str = "embedding") -> DataFrame:
    """vec_id, n_links, component_id, kept; one row per row."""
    scratch = Scratch(embeddings.sparkSession, "vectors")
    rows = scratch.put(
        embeddings.select(F.col(id_column).cast("long").alias("vec_id"), F.col(vector_column).alias("v"))
        .withColumn("usable", _usable(F.col("v")))
        .select("vec_id", "usable", F.when(F.col("usable"), F.col("v")).alias("v"),
                F.when(F.col("usable"), F.xxhash64("v")).alias("h"), F.when(F.col("usable"), F.hash("v")).alias("g")),
        "vectors",
    )
    classes = scratch.put(rows.where("usable").groupBy("h", "g").agg(F.min("vec_id").alias("first"), F.count(F.lit(1)).alias("weight")), "classes")
    reps = rows.where("usable").join(classes.withColumnRenamed("first", "vec_id"), ["h", "g", "vec_id"]).select("vec_id", "weight", "v")
    reps = scratch.put(reps.dropDuplicates(["vec_id"]), "representatives")
    hashed = scratch.put(_hashed(reps.select("vec_id", "v")), "hashed", "snappy")
    banded = hashed.select(F.col("vec_id").alias("doc_id"), F.explode("keys").alias("key"))
    shared = banded.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    members = scratch.put(banded.join(shared, "key"), "members")

    def agreement(a: str, b: str) -> Column:
        differing = [F.bit_count(F.col(f"{a}{s}").bitwiseXOR(F.col(f"{b}{s}"))) for s in ("s0", "s1")]
        return -(differing[0] + differing[1])

    signs = hashed.select(F.col("vec_id").alias("doc_id"), "s0", "s1")
    components = linked_components(
        members, signs, agreement, -MOST_SIGNS, lambda pairs: scratch.put(_cosines(pairs, reps.select("vec_id", "v"), least), "links"), scratch
    )
    sizes = components.groupBy("component").agg(F.count(F.lit(1)).alias("size"))
    inside = reps.join(components.withColumnRenamed("v", "vec_id"), "vec_id").join(sizes, "component")
    linked = scratch.put(_links_inside(inside.select("component", "size", "vec_id", "weight", "v"), least), "linked")
    scratch.drop(members)
    known = reps.select(F.col("vec_id").alias("first"), "weight").join(linked.withColumnRenamed("vec_id", "first"), "first", "left").join(
        components.select(F.col("v").alias("first"), "component"), "first", "left"
    ).drop("weight")
    out = rows.select("vec_id", "h", "g").join(classes, ["h", "g"], "left").join(known, "first", "left")
    component = F.coalesce("component", "first", "vec_id")
    return out.select(
        "vec_id", (F.coalesce("linked", "weight", F.lit(1)) - 1).alias("n_links"), component.alias("component_id"),
        (component == F.col("vec_id")).alias("kept"),
    )
