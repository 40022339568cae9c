"""Near-duplicate documents by b-bit MinHash over word shingles.

A document's set is its distinct shingles of five words (A-Z lower-cased, words
parted by ``[\\x20\\x09-\\x0D]``); one with fewer words has its whole sequence as its
one shingle, one without words or text has an empty set and no links. Documents
are linked when their sets' similarity is at least 0.75. The smallest id that can
be reached by links names the component, and its document is kept.

Documents of equal sets are one class. Each class has 128 minima; bands of four
full minima propose candidates. Only the low four bits of each minimum are kept
otherwise, packed in eight longs; similarity is estimated from counted bits,
corrected for chance agreement, to order and thin out candidates with a wide
margin. Every link is confirmed on the full sets.

Buckets are not paired out. Every member is compared with one pivot; this joins
nearly all of a group of copies. Then members that are still apart from their
bucket's pivot are compared with the likely members of other components there
(see ``linked_components``). For these members alone a longer signature is made,
the lowest bit of 1,024 minima, whose estimate is twice as sharp, and sets whose
sizes rule a link out are left apart. So every likely link that shares a band is
either confirmed or inside a component already.

Extra columns are not read; an empty table gives none. Rows that repeat an id
are one vertex with the set of each of them linked.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import Scratch, arrow_chunks, arrow_rows, join_checked, linked_components, release_memory, small_batches, tasks_of

WORDS, PERCENT = 5, 75
MINIMA, ROWS, BITS = 128, 4, 4
LONGS = MINIMA * BITS // 64
# Four standard errors of the estimate at the threshold.
MARGIN = 0.16
# The longer signature keeps one bit of each minimum.
LONGER = 1024
LONGER_MARGIN = 0.083
# Texts worked on together; a chunk's arrays take some 60 times this.
CHUNK_BYTES = 1 << 18


def _sketches(docs: DataFrame, words: int) -> DataFrame:
    """doc_id, n_shingles, set_a, set_b (128 bits that name the set), bands and packed minima."""
    import numpy as np
    import pyarrow as pa

    from tidemark.llm import textarrays as ta

    bands = MINIMA // ROWS
    fields = [("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("set_a", pa.int64()), ("set_b", pa.int64()),
              ("bands", pa.list_(pa.int64())), *[(f"s{i}", pa.int64()) for i in range(LONGS)]]
    schema = pa.schema(fields)

    def run(batches: Iterator) -> Iterator:
        rng = np.random.default_rng(11)
        factors = rng.integers(0, 1 << 31, MINIMA, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
        shifts = rng.integers(0, 1 << 32, MINIMA, dtype=np.uint32)
        band_factors = ta.mixed(np.arange(1, ROWS + 1, dtype=np.uint64)) | np.uint64(1)
        hasher = ta.WordHasher()

        def rows():
            for held, data, bounds in ta.chunks(arrow_rows(batches, ["doc_id", "text"]), 1, CHUNK_BYTES):
                sets = ta.shingle_sets(data, bounds, hasher, words)
                sizes = np.array([len(s) for s in sets])
                full = np.flatnonzero(sizes)
                minima = np.zeros((len(sets), MINIMA), np.uint32)
                named = np.zeros((len(sets), 2), np.uint64)
                if len(full):
                    every = np.concatenate([sets[i] for i in full])
                    starts = np.concatenate([[0], np.cumsum(sizes[full])[:-1]])
                    named[full, 0] = np.add.reduceat(every, starts)
                    named[full, 1] = np.add.reduceat(ta.mixed(every), starts)
                    x = (every >> np.uint64(32)).astype(np.uint32)
                    y = np.empty_like(x)
                    for k in range(MINIMA):
                        np.multiply(x, factors[k], out=y)
                        y += shifts[k]
                        minima[full, k] = np.minimum.reduceat(y, starts)
                grouped = minima.reshape(len(sets), bands, ROWS).astype(np.uint64)
                keys = ta.mixed((ta.mixed(grouped) * band_factors).sum(axis=2) + np.arange(bands, dtype=np.uint64)).view(np.int64)
                # The low bits of a minimum follow its factor closely, so they are mixed first.
                low = (ta.mixed(minima.astype(np.uint64)) & np.uint64((1 << BITS) - 1)).reshape(len(sets), LONGS, 64 // BITS)
                packed = (low << (np.arange(64 // BITS, dtype=np.uint64) * np.uint64(BITS))).sum(axis=2, dtype=np.uint64).view(np.int64)
                for i, (doc_id, _) in enumerate(held):
                    yield doc_id, int(sizes[i]), int(named[i, 0].view(np.int64)), int(named[i, 1].view(np.int64)), keys[i] if sizes[i] else [], *packed[i].tolist()

        yield from arrow_chunks(rows(), schema)
        release_memory()

    longs = ", ".join(f"s{i} long" for i in range(LONGS))
    return small_batches(docs).mapInArrow(run, f"doc_id long, n_shingles long, set_a long, set_b long, bands array<long>, {longs}")


def estimate(a: str = "a_", b: str = "b_", minima: int = MINIMA, bits: int = BITS) -> Column:
    """Similarity from counted bits of two packed signatures, without agreement by chance."""
    lanes = F.lit(int("1".rjust(bits, "0") * (64 // bits), 2)) if bits > 1 else None

    def differing(i: int) -> Column:
        x = F.col(f"{a}s{i}").bitwiseXOR(F.col(f"{b}s{i}"))
        shift = 1
        while shift < bits:
            x = x.bitwiseOR(F.shiftrightunsigned(x, shift))
            shift *= 2
        return F.bit_count(x if lanes is None else x.bitwiseAND(lanes))

    same = F.lit(1.0) - reduce(Column.__add__, [differing(i) for i in range(minima * bits // 64)]) / minima
    chance = 1 / (1 << bits)
    return (same - chance) / (1 - chance)


def _longer(docs: DataFrame, words: int) -> DataFrame:
    """doc_id, n and s0 ...: size of the set and the lowest bit of each of its minima, of documents with words."""
    import numpy as np
    import pyarrow as pa

    from tidemark.llm import textarrays as ta

    longs = LONGER // 64
    schema = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), *[(f"s{i}", pa.int64()) for i in range(longs)]])

    def run(batches: Iterator) -> Iterator:
        rng = np.random.default_rng(12)
        factors = rng.integers(0, 1 << 31, LONGER, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
        shifts = rng.integers(0, 1 << 32, LONGER, dtype=np.uint32)
        hasher = ta.WordHasher()

        def rows():
            for held, data, bounds in ta.chunks(arrow_rows(batches, ["doc_id", "text"]), 1, CHUNK_BYTES):
                sets = ta.shingle_sets(data, bounds, hasher, words)
                full = [i for i, s in enumerate(sets) if len(s)]
                if not full:
                    continue
                sizes = np.array([len(sets[i]) for i in full])
                starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
                x = (np.concatenate([sets[i] for i in full]) >> np.uint64(32)).astype(np.uint32)
                y = np.empty_like(x)
                minima = np.empty((len(full), LONGER), np.uint32)
                for k in range(LONGER):
                    np.multiply(x, factors[k], out=y)
                    y += shifts[k]
                    minima[:, k] = np.minimum.reduceat(y, starts)
                low = (ta.mixed(minima.astype(np.uint64)) & np.uint64(1)).reshape(len(full), longs, 64)
                packed = (low << np.arange(64, dtype=np.uint64)).sum(axis=2, dtype=np.uint64).view(np.int64)
                for j, i in enumerate(full):
                    yield held[i][0], int(sizes[j]), *packed[j].tolist()

        yield from arrow_chunks(rows(), schema)
        release_memory()

    return small_batches(docs).mapInArrow(run, "doc_id long, n long, " + ", ".join(f"s{i} long" for i in range(longs)))


def _confirmed(pairs: DataFrame, docs: DataFrame, words: int, percent: int, scratch: Scratch) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough.

    Sets are made anew from the texts that occur in pairs. Per ``b``, its set is
    read first and those of its partners stream by; a ``b`` with many partners is
    dealt to many tasks.
    """
    import numpy as np
    import pyarrow as pa

    from tidemark.llm import textarrays as ta

    spark = docs.sparkSession
    salts = tasks_of(spark)
    dealt = scratch.put(pairs.select("a", "b", F.pmod(F.xxhash64("a"), F.lit(salts)).cast("int").alias("salt")), "pairs")
    needed = scratch.put(dealt.select(F.col("a").alias("doc_id")).union(dealt.select("b")).distinct(), "needed")
    set_schema = pa.schema([("doc_id", pa.int64()), ("members", pa.binary())])

    def sets_of(batches: Iterator) -> Iterator:
        hasher = ta.WordHasher()

        def rows():
            for held, data, bounds in ta.chunks(arrow_rows(batches, ["doc_id", "text"]), 1, CHUNK_BYTES):
                for (doc_id, _), members in zip(held, ta.shingle_sets(data, bounds, hasher, words), strict=True):
                    yield doc_id, members.tobytes()

        yield from arrow_chunks(rows(), set_schema, 500)
        release_memory()

    sets = scratch.put(small_batches(join_checked(docs, needed, "doc_id")).mapInArrow(sets_of, "doc_id long, members binary"), "sets", "snappy")
    partners = dealt.join(sets, dealt["a"] == sets["doc_id"]).select("b", "salt", F.lit(1).alias("role"), "a", "members")
    hubs = dealt.select("b", "salt").distinct().join(sets, F.col("b") == F.col("doc_id")).select(
        "b", "salt", F.lit(0).alias("role"), F.lit(None).cast("long").alias("a"), "members"
    )
    together = hubs.union(partners).repartition("b", "salt").sortWithinPartitions("b", "salt", "role")
    link_schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def compare(batches: Iterator) -> Iterator:
        def links():
            hub = at = None
            for b, role, a, members in arrow_rows(batches, ["b", "role", "a", "members"]):
                values = np.frombuffer(members, np.uint64)
                if role == 0:
                    hub, at = values, b
                    continue
                assert at == b
                place = np.searchsorted(hub, values)
                place[place == len(hub)] = 0
                shared = int((hub[place] == values).sum()) if len(hub) else 0
                if shared and 100 * shared >= percent * (len(hub) + len(values) - shared):
                    yield a, b

        yield from arrow_chunks(links(), link_schema)

    out = scratch.put(together.mapInArrow(compare, "a long, b long"), "links")
    scratch.drop(dealt, needed, sets)
    return out


def near_duplicates(docs: DataFrame, words: int = WORDS, percent: int = PERCENT, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id, kept; one row per row."""
    scratch = Scratch(docs.sparkSession, "minhash")
    texts = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("binary").alias("text"))
    sketches = scratch.put(_sketches(texts, words), "sketches", "snappy")
    named = ["set_a", "set_b", "n_shingles"]
    classes = scratch.put(
        sketches.where("n_shingles > 0").groupBy(*named).agg(F.min("doc_id").alias("first")), "classes"
    )
    reps = scratch.put(
        sketches.join(classes.select(*named, F.col("first").alias("doc_id")), [*named, "doc_id"]).drop(*named).dropDuplicates(["doc_id"]),
        "representatives", "snappy",
    )
    signatures = reps.select("doc_id", *[f"s{i}" for i in range(LONGS)])
    banded = reps.select("doc_id", F.explode("bands").alias("key"))
    shared = banded.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    members = scratch.put(banded.join(shared, "key"), "members")

    def finer(ids: DataFrame) -> tuple[DataFrame, Callable[[str, str], Column]]:
        by = scratch.put(_longer(join_checked(texts, ids, "doc_id"), words), "longer", "snappy").dropDuplicates(["doc_id"])

        def likely(a: str, b: str) -> Column:
            sizes = [F.col(f"{v}n") for v in (a, b)]
            fits = 100 * F.least(*sizes) >= percent * F.greatest(*sizes)
            return fits & (estimate(a, b, LONGER, 1) >= percent / 100 - LONGER_MARGIN)

        return by, likely

    components = linked_components(
        members, signatures, estimate, percent / 100 - MARGIN, lambda pairs: _confirmed(pairs, texts, words, percent, scratch), scratch, finer
    )
    scratch.drop(members, reps)
    in_class = sketches.select("doc_id", *named).join(classes, named, "left")
    first = F.coalesce("first", "doc_id")
    whole = in_class.withColumn("first", first).join(components.select(F.col("v").alias("first"), "component"), "first", "left")
    named_component = F.coalesce("component", "first")
    return whole.select(
        "doc_id", "n_shingles", named_component.alias("component_id"), (F.col("doc_id") == named_component).alias("kept")
    )
