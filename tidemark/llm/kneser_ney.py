"""Quality classifier by an interpolated modified Kneser-Ney model of trusted text.

Two models predict characters by up to four characters before them. One reads words,
from a begin mark to an end mark; words are what ``[\\x20\\x09-\\x0D]`` parts, in their
own case. The other reads the running text: all words of a document, parted by one
blank, between two marks, so its n-grams cross the blanks and the order of words
counts. Both are trained on all documents labelled good (``quality`` 1).
A document's perplexities are per predicted character. It is kept if neither is over
its limit: a quantile, by default 0.995, of the trusted documents of its language, each
held out when its own perplexity is taken for the limit: n-grams and contexts that no
other trusted document has count as unseen. A language's limit is the mean of its own
quantile and the one over all trusted documents, weighted by its number of trusted
documents and by ``PRIOR``; the overall one alone holds where it has none.

The longest n-grams are counted some documents at a time and summed as strings; grouped
counts by suffix and by prefix give the shorter ones, their distinct left neighbours,
probabilities and interpolation weights. Orders below the highest count left
neighbours, except at the begin mark. Blocks ask the shards of that table for their
distinct n-grams (see ``ngramshards``), so neither the table nor the counts must fit in
one place. Here n-grams are told apart by 40 bits of a hash within their shard.
Most characters of running text depend on their own word alone, the first ones also on
the end of what stands before; each such word and border is worked out once per part
of a block (see ``Layer``), each distinct n-gram of any order once per block (see ``Level``).

A document without words (null or empty text) has no perplexity and is kept, as is
everything if no document is trusted. The null language is one of its own. Labels
of ids without a document are ignored, and a document with several labels is
trusted if one says so. Rows that repeat an id are scored each.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import ngramshards as ns
from tidemark.llm import textarrays as ta
from tidemark.llm.common import Scratch, join_checked, release_memory

ORDER = 5
# A language's own quantile counts by its number of trusted documents, the overall one as so many.
QUANTILE, PRIOR = 0.995, 20
# Marks are white space, which no word has.
BEGIN, END, GAP = 0x0A, 0x0D, 0x20
WORDS, TEXT = 0, 1
PARTS = ("word", "text")
BLOCK_BYTES = 10 << 20
# Blocks are read in parts of about this size.
PART_BYTES = 4 << 20
# Rows of counts handed to Spark at once; an executor keeps the memory that a batch once took.
COUNTED_ROWS = 20_000


class Layer:
    """One model's predicted characters in some texts, those that must agree counted once.

    ``tokens`` says which unit each word occurrence uses and ``owners`` in which document; a unit
    is a row of predicted characters with all they depend on. ``unit`` and ``number`` say per
    predicted character of a unit which unit it is in and which distinct n-gram it ends; ``codes``
    has the symbols of those n-grams, the predicted one first, and ``reach`` how many they are.
    """

    def __init__(self, kind: int, order: int, codes: np.ndarray, at: np.ndarray, reach: np.ndarray, unit: np.ndarray,
                 tokens: np.ndarray, owners: np.ndarray, units: int, ends: np.ndarray | None = None):
        self.kind, self.order, self.units = kind, order, units
        # A part has far fewer than 2**31 of anything, and a block's layers are held at a time.
        self.unit, self.tokens, self.owners = unit.astype(np.int32), tokens.astype(np.int32), owners.astype(np.int32)
        reach = np.minimum(reach, order).astype(np.int8)
        # Equal n-grams are found by their symbols as they stand; only the distinct ones are written out.
        number, first, _ = distinct(_sums(codes, at, reach, order))
        self.number = number.astype(np.int32)
        at, reach = at[first], reach[first]
        symbols = [codes[np.maximum(at - i, 0)] for i in range(order)]
        if ends is not None:
            # Inside words both neighbouring blanks are marks.
            symbols[0] = np.where(ends[first], END, symbols[0])
            for i in range(1, order):
                symbols[i] = np.where((symbols[i] == GAP) & (reach == i + 1), BEGIN, symbols[i])
        self.codes = [np.where(reach > i, c, 0) for i, c in enumerate(symbols)]
        self.top = key(self.codes, order, kind)
        self.reach = reach

    def forget(self) -> None:
        """Drop what :class:`Grams` has taken over."""
        del self.codes, self.top, self.reach


class Grams:
    """The distinct longest n-grams of one model in several layers; ``number`` has for each layer where its own are."""

    def __init__(self, some: list[Layer]):
        self.kind, self.order = some[0].kind, some[0].order
        number, first, self.top = distinct(np.concatenate([layer.top for layer in some]))
        self.number = np.split(number, np.cumsum([len(layer.top) for layer in some])[:-1])
        self.codes = [np.concatenate([layer.codes[i] for layer in some])[first] for i in range(self.order)]
        self.reach = np.concatenate([layer.reach for layer in some])[first]

    def levels(self) -> list[Level]:
        """The distinct n-grams of each order, from 1 on, among the ends of the longest ones."""
        out: list[Level] = []
        rows = np.zeros(0, np.int64)
        sums = np.zeros(0, np.uint64)
        with np.errstate(over="ignore"):
            for k in range(self.order, 0, -1):
                longest = np.flatnonzero(self.reach == k)
                # Without its first symbol an n-gram is one of the order below.
                sums -= values()[self.codes[k][rows]] * _factor(k) if len(rows) else np.uint64(0)
                number, first, sums = distinct(np.concatenate([sums, _sum([c[longest] for c in self.codes[:k]])]))
                if out:
                    out[-1].shorter = number[: len(rows)]
                ends, rows = number[len(rows) :], np.concatenate([rows, longest])[first]
                before = (sums - values()[self.codes[0][rows]] * _factor(0)) * np.uint64(pow(ta.STEP, -2, 1 << 64))
                out.append(Level(_mixed(sums, k, self.kind), _mixed(before, k - 1, self.kind), longest, ends))
        out[-1].shorter = np.zeros(len(rows), np.int64)
        return out[::-1]


class Level:
    """Distinct n-grams of one order: ``keys``, ``contexts`` (keys of those) and ``shorter``, where each one's end is a level below.

    ``longest`` are the longest n-grams that have this order, ``ends`` where they are here.
    """

    def __init__(self, keys: np.ndarray, contexts: np.ndarray, longest: np.ndarray, ends: np.ndarray):
        self.keys, self.contexts, self.longest, self.ends = keys, contexts, longest, ends
        self.shorter = ends


def by_model(docs: list[tuple], order: int, part_bytes: int = PART_BYTES) -> list[tuple[list[Layer], Grams]]:
    """The layers of each model in some documents, with their n-grams."""
    parts = list(layers(docs, order, part_bytes))
    some = [[layer for part in parts for layer in part if layer.kind == kind] for kind in (WORDS, TEXT)]
    out = [(found, Grams(found)) for found in some if found]
    release_memory()
    return out


def distinct(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Number of each element among the distinct ones, where each of these stands first, and their values."""
    number, values = pd.factorize(hashes)
    # Numbers are given in order of first occurrence.
    first = np.flatnonzero(np.diff(np.maximum.accumulate(number), prepend=-1))
    return number, first, values


_VALUES: list[np.ndarray] = []


def values() -> np.ndarray:
    """A random number for each code point, made once per process."""
    if not _VALUES:
        _VALUES.append(ta.mixed(np.arange(0x110000, dtype=np.uint64) + np.uint64(1 << 33)))
    return _VALUES[0]


def _factor(i: int) -> np.uint64:
    return np.uint64(pow(ta.STEP, 2 * i + 1, 1 << 64))


def _sum(symbols: list[np.ndarray]) -> np.ndarray:
    total = np.zeros(len(symbols[0]), np.uint64)
    with np.errstate(over="ignore"):
        for i, c in enumerate(symbols):
            total += values()[c] * _factor(i)
    return total


def _mixed(sums: np.ndarray, k: int, kind: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return ta.mixed(sums + np.uint64(k + 64 * kind))


def key(symbols: list[np.ndarray], k: int, kind: int) -> np.ndarray:
    """64-bit hashes of k-grams given by their symbols, the last one first; missing symbols are 0."""
    return _mixed(_sum(symbols[:k]), k, kind)


def _sums(codes: np.ndarray, at: np.ndarray, reach: np.ndarray, order: int) -> np.ndarray:
    """A 64-bit hash of the last ``reach`` symbols before and at each place, the number of symbols counted in."""
    known = values()[codes]
    least = int(reach.min()) if len(reach) else order
    total = np.zeros(len(codes), np.uint64)
    term = np.empty_like(known)
    fewer = []
    with np.errstate(over="ignore"):
        for i in range(order):
            # All places are summed, since neighbours in memory are read many times faster than places one by one.
            n = max(0, len(known) - i)
            total[i:] += np.multiply(known[:n], _factor(i), out=term[:n])
            if least <= i + 1 < order:
                some = np.flatnonzero(reach == i + 1)
                fewer.append((some, total[at[some]]))
        out = total[at]
        for some, found in fewer:
            out[some] = found
        return out + (np.arange(order + 1, dtype=np.uint64) * np.uint64(ta.BASE))[reach]


def empty_key(kind: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return ta.mixed(np.array([64 * kind], np.uint64))


def stretches(codes: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Stretches of ``codes`` one after another, and for each symbol its stretch and its place there."""
    of = np.repeat(np.arange(len(starts)), lengths)
    place = np.arange(len(of)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    return codes[place + starts[of]], of, place


# All white space that parts words becomes a blank.
_BLANKS = bytes.maketrans(b"\t\n\v\f\r", b"     ")


def _single_spaced(text: bytes) -> bytes:
    """Words parted by one blank each."""
    text = text.translate(_BLANKS).strip(b" ")
    return b" ".join(text.split()) if b"  " in text else text


def layers(docs: list[tuple], order: int, part_bytes: int = PART_BYTES) -> Iterator[list[Layer]]:
    """Per part of a block: words on their own, the insides of words in running text, and what spans their borders.

    From the ``order - 1``-th character on, a word's characters are predicted from the word and from
    whether it begins the document; those before depend on the last symbols in front of the word too.
    """
    held: list[tuple[int, bytes]] = []
    size = 0
    powers = [np.zeros(0, np.uint64)] * 2
    for i, doc in enumerate(docs):
        words = _single_spaced(doc[1])
        if words:
            held.append((i, b"\n" + words + b"\r"))
            size += len(held[-1][1])
        if held and (size >= part_bytes or i == len(docs) - 1):
            if size + 1 > len(powers[0]):
                powers = [ta.powers(size + 1, of) for of in (ta.BASE, ta.INVERSE)]
            yield _layers(b"".join(t for _, t in held), np.array([j for j, _ in held]), order, *powers)
            held, size = [], 0


def _layers(joined: bytes, numbers: np.ndarray, order: int, up: np.ndarray, down: np.ndarray) -> list[Layer]:
    codes = np.frombuffer(joined.decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
    if b"\0" in joined:
        # Zeros stand for missing symbols.
        codes = np.where(codes == 0, np.uint32(0x0B), codes)
    # Other control characters are parts of words.
    edges = np.flatnonzero(codes <= GAP)
    marks = codes[edges]
    begun, ended = marks == BEGIN, marks == END
    parting = begun | ended | (marks == GAP)
    if not parting.all():
        edges, begun, ended = edges[parting], begun[parting], ended[parting]
    starts, stops, opens = edges[~ended] + 1, edges[~begun], begun[~ended]
    local = np.cumsum(opens) - 1
    begins = (starts[opens] - 1)[local]
    owners = numbers[local]
    n = len(codes)
    step = np.uint64(ta.STEP)
    with np.errstate(over="ignore"):
        sums = np.zeros(n + 1, np.uint64)
        hashed = values()[codes]
        hashed *= up[:n]
        np.cumsum(hashed, out=sums[1:])
        # The symbol after a word is predicted too: a blank or the end. The one before it, a blank or the
        # begin mark, is in the n-gram of the first character inside.
        word = ta.mixed((sums[stops + 1] - sums[starts]) * down[starts] + ((stops - starts) * 2 + opens).astype(np.uint64) * step)
        low, high = np.maximum(starts - order + 1, begins), np.minimum(starts + order - 2, stops + 1)
        border = ta.mixed((sums[high] - sums[low]) * down[low] + ((high - low) * 64 + (starts - low)).astype(np.uint64) * step)
    del sums, hashed
    word_of, at, _ = distinct(word)
    border_of, by, _ = distinct(border)
    # Each distinct word with the symbols on both sides of it.
    lengths = stops[at] - starts[at] + 2
    alone, of_alone, place = stretches(codes, starts[at] - 1, lengths)
    predicted, inside = np.flatnonzero(place > 0), np.flatnonzero(place >= order - 1)
    marks = np.where((alone == BEGIN) | (alone == END), np.uint32(GAP), alone)
    words = Layer(WORDS, order, marks, predicted, place[predicted] + 1, of_alone[predicted], word_of, owners, len(at),
                  place[predicted] == lengths[of_alone[predicted]] - 1)
    insides = Layer(TEXT, order, alone, inside, np.full(len(inside), order), of_alone[inside], word_of, owners, len(at))
    del alone, of_alone, place, predicted, inside, marks
    low = low[by]
    across, of_across, place = stretches(codes, low, high[by] - low)
    predicted = np.flatnonzero(place >= (starts[by] - low)[of_across])
    borders = Layer(TEXT, order, across, predicted, place[predicted] + 1, of_across[predicted], border_of, owners, len(by))
    return [words, insides, borders]


COUNTED = "kind int, gram string, n long, low long, high long"


def _counted(order: int, most: int, part_bytes: int = PART_BYTES):
    """Counts of the longest n-grams of trusted documents, about ``most`` bytes of text at a time, with the least and greatest id that has them."""
    schema = pa.schema([("kind", pa.int32()), ("gram", pa.string()), ("n", pa.int64()), ("low", pa.int64()), ("high", pa.int64())])

    def counted(docs: list[tuple]) -> Iterator[pa.RecordBatch]:
        docs.sort(key=lambda d: d[0])
        ids = np.array([d[0] for d in docs], np.int64)
        for some, grams in by_model(docs, order, part_bytes):
            uses = []
            for layer, number in zip(some, grams.number, strict=True):
                # Documents are in the order of their ids, so the first and last use tell the least and greatest.
                n = np.bincount(layer.tokens, minlength=layer.units)
                low, high = np.zeros(layer.units, np.int64), np.zeros(layer.units, np.int64)
                low[layer.tokens[::-1]] = ids[layer.owners[::-1]]
                high[layer.tokens] = ids[layer.owners]
                uses.append((number, *by_number(layer.number, len(number), n[layer.unit], low[layer.unit], high[layer.unit])))
                layer.forget()
            n, low, high = by_number(np.concatenate([u[0] for u in uses]), len(grams.top), *[np.concatenate([u[i] for u in uses]) for i in (1, 2, 3)])
            # Symbols in reading order; what is missing goes behind and is no part of the string.
            place = grams.reach[:, None].astype(np.int64) - 1 - np.arange(order)[None, :]
            text = np.where(place >= 0, np.take_along_axis(np.column_stack(grams.codes), np.maximum(place, 0), 1), 0)
            strings = np.ascontiguousarray(text.astype(np.uint32)).view(f"<U{order}").ravel()
            batch = pa.RecordBatch.from_arrays([pa.array(np.full(len(n), grams.kind, np.int32)), pa.array(strings, pa.string()), *map(pa.array, (n, low, high))], schema=schema)
            yield from (batch.slice(at, COUNTED_ROWS) for at in range(0, len(n), COUNTED_ROWS))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size = 0
        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                held.append((doc_id, text or b""))
                size += len(held[-1][1])
                if size >= most:
                    yield from counted(held)
                    held, size = [], 0
        if held:
            yield from counted(held)
        del held
        release_memory()

    return run


def by_number(number: np.ndarray, size: int, n: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sum of n, least low and greatest high per number."""
    total = np.bincount(number, n, size).astype(np.int64)
    least, most = np.full(size, np.iinfo(np.int64).max), np.full(size, np.iinfo(np.int64).min)
    np.minimum.at(least, number, low)
    np.maximum.at(most, number, high)
    return total, least, most


def model_table(counts: DataFrame, order: int, scratch: Scratch) -> DataFrame:
    """(kind, gram, weight, value): discounted probabilities of n-grams and, if ``weight``, interpolation weights of contexts.

    ``counts`` has the columns of ``COUNTED``. Values of what one document alone has are negative (or -0).
    """
    longest = scratch.put(counts.groupBy("kind", "gram").agg(F.sum("n").alias("c"), F.min("low").alias("low"), F.max("high").alias("high")), "grams")
    # n-grams of full length and those from a begin mark have their counts, all others the number of left neighbours.
    levels = [longest.where(F.length("gram") == order)]
    for k in range(order - 1, 0, -1):
        shorter = levels[-1].groupBy("kind", F.expr("substring(gram, 2)").alias("gram")).agg(
            F.count(F.lit(1)).alias("c"), F.min("low").alias("low"), F.max("high").alias("high"))
        levels.append(scratch.put(longest.where(F.length("gram") == k).unionByName(shorter), f"grams{k}"))
    used = levels[0]
    for level in levels[1:]:
        used = used.unionByName(level)
    used = used.withColumn("k", F.length("gram"))
    times = used.groupBy("kind", "k").agg(*[F.count(F.when(F.col("c") == i, 1)).alias(f"t{i}") for i in (1, 2, 3, 4)])
    y = F.col("t1") / F.greatest(F.col("t1") + 2 * F.col("t2"), F.lit(1))
    discount = lambda i: F.greatest(F.lit(0.0), F.least(F.lit(float(i)), F.when(F.col(f"t{i}") > 0, i - (i + 1) * y * F.col(f"t{i + 1}") / F.col(f"t{i}")).otherwise(F.lit(0.5 * i))))
    # One row per kind and order.
    discounts = F.broadcast(scratch.put(times.select("kind", "k", *[discount(i).alias(f"d{i}") for i in (1, 2, 3)]), "discounts"))
    d = F.when(F.col("c") == 1, F.col("d1")).when(F.col("c") == 2, F.col("d2")).otherwise(F.col("d3"))
    context = F.expr("substring(gram, 1, k - 1)")
    discounted = used.join(discounts, ["kind", "k"]).select("kind", "gram", context.alias("context"), "c", "low", "high", d.alias("d"))
    marked = lambda value: F.when(F.col("low") == F.col("high"), -value).otherwise(value).cast("float")
    weights = scratch.put(discounted.groupBy("kind", "context").agg(
        F.sum("c").alias("total"), (F.sum("d") / F.sum("c")).alias("weight"), F.min("low").alias("low"), F.max("high").alias("high")), "weights")
    probabilities = discounted.join(weights.select("kind", "context", "total"), ["kind", "context"]).select(
        "kind", "gram", F.lit(False).alias("weight"), marked((F.col("c") - F.col("d")) / F.col("total")).alias("value"))
    model = scratch.put(probabilities.union(weights.select("kind", "context", F.lit(True), marked(F.col("weight")))), "model")
    scratch.drop(longest, *levels[1:], weights)
    return model


def _keyed(shards: int):
    """Model rows with their shard and the rest of their key."""
    schema = pa.schema([("shard", pa.int32()), ("low", pa.int64()), ("weight", pa.bool_()), ("value", pa.float32())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            grams = batch.column("gram").to_pylist()
            kinds = batch.column("kind").to_numpy()
            lengths = np.fromiter(map(len, grams), np.int64, len(grams))
            codes = np.frombuffer("".join(grams).encode("utf-32-le"), np.uint32)
            ends = np.cumsum(lengths)
            hashes = np.zeros(len(grams), np.uint64)
            for kind in (WORDS, TEXT):
                for k in np.unique(lengths).tolist():
                    has = (kinds == kind) & (lengths == k)
                    hashes[has] = key([codes[ends[has] - 1 - i] for i in range(k)], k, kind) if k else empty_key(kind)
            keys = ns.shard_keys(hashes, shards)
            yield pa.RecordBatch.from_arrays([
                pa.array((keys >> np.uint64(40)).astype(np.int32)), pa.array((keys & np.uint64(ns.LOW)).astype(np.int64)),
                batch.column("weight"), batch.column("value")], schema=schema)

    return run


def perplexities(docs: DataFrame, labels: DataFrame, order: int, scratch: Scratch, id_column: str, text_column: str, lang_column: str,
                 block_bytes: int, shard_bytes: int | None = None, part_bytes: int = PART_BYTES) -> DataFrame:
    """doc_id, lang, trusted of every document, and for words and running text each: n_chars, log_probability, held_out.

    ``held_out`` is the log probability without what the model has from this document alone; null if it is not trusted.
    """
    blocks = ns.block_count(docs, text_column, block_bytes)
    # Each block writes to each shard, so smaller blocks alone would bring messages by the square.
    shards = max(1, -(-blocks * block_bytes // (shard_bytes or block_bytes)))
    good = scratch.put(labels.where("quality = 1 and doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id"), F.lit(1).alias("flag")).distinct(), "good")
    texts = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("binary").alias("text"),
                        F.col(lang_column).cast("string").alias("lang"))
    rows = join_checked(texts, good, "doc_id", "left").withColumn("flag", F.coalesce("flag", F.lit(0)))
    packed = ns.packed_blocks(rows, blocks)
    counts = rows.where("flag = 1").select("doc_id", "text").mapInArrow(_counted(order, block_bytes, part_bytes), COUNTED)
    model = model_table(counts, order, scratch)
    sizes = dict(model.groupBy("kind").count().collect())
    uniform = [1.0 / max(1, sizes.get(kind, 0)) for kind in (WORDS, TEXT)]
    request_schema = pa.schema([("shard", pa.int32()), ("block", pa.int32()), ("keys", pa.binary())])
    reply_schema = pa.schema([("block", pa.int32()), ("shard", pa.int32()), ("found", pa.binary())])
    result_schema = pa.schema([("doc_id", pa.int64()), ("lang", pa.string()), ("trusted", pa.int32()),
                               *[(f"{part}_{c}", t) for part in PARTS for c, t in (("n_chars", pa.int64()), ("log_probability", pa.float64()), ("held_out", pa.float64()))]])

    def block_keys(levels: Iterable[Level]) -> tuple[np.ndarray, Iterator[np.ndarray]]:
        """Sorted keys of all n-grams and contexts in a block, those of the empty context always among them, and where each level's are."""
        some = [empty_key(WORDS), empty_key(TEXT), *[hashes for level in levels for hashes in (level.keys, level.contexts)]]
        number, found = pd.factorize(np.concatenate(some))
        keys, place = ta.distinct_places(ns.shard_keys(found, shards))
        return keys, iter(np.split(place[number], np.cumsum([len(h) for h in some])[1:-1])[1:])

    def ask(table: pa.Table) -> pa.Table:
        block = table.column("block")[0].as_py()
        keys, _ = block_keys(level for grams in [g for _, g in by_model(ns.block_texts(table), order, part_bytes)] for level in grams.levels())
        ends = np.searchsorted(keys, np.arange(shards + 1, dtype=np.uint64) << np.uint64(40))
        release_memory()
        rows = [{"shard": i, "block": block, "keys": ns.packed_keys(keys[a:b])} for i, (a, b) in enumerate(zip(ends[:-1], ends[1:], strict=True)) if b > a]
        return ns.table_of(rows, request_schema)

    def answer(asked: pa.Table, table: pa.Table) -> pa.Table:
        if not asked.num_rows:
            return reply_schema.empty_table()
        shard = asked.column("shard")[0].as_py()
        low, is_weight, value = [table.column(c).to_numpy() for c in ("low", "weight", "value")]
        known = []
        for wants in (False, True):
            some = np.flatnonzero(is_weight == wants)
            some = some[np.argsort(low[some])]
            known.append((low[some].astype(np.uint64), value[some]))
        out = []
        for block, payload in zip(asked.column("block").to_pylist(), asked.column("keys").to_pylist(), strict=True):
            keys = ns.unpacked_keys(payload)
            found = np.full((2, len(keys)), np.nan, np.float32)
            for i, (lows, vs) in enumerate(known):
                if len(lows):
                    at = np.minimum(np.searchsorted(lows, keys), len(lows) - 1)
                    found[i] = np.where(lows[at] == keys, vs[at], np.float32(np.nan))
            out.append({"block": block, "shard": shard, "found": ns.packed_floats(found)})
        del known, low, is_weight, value
        release_memory()
        return ns.table_of(out, reply_schema)

    def finish(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows:
            return result_schema.empty_table()
        docs = ns.block_texts(left)
        chars = np.zeros((2, len(docs)), np.int64)
        logs = np.zeros((2, 2, len(docs)))
        read = []
        for some, grams in by_model(docs, order, part_bytes):
            for layer in some:
                layer.forget()
            read.append((some, grams.kind, grams.number, len(grams.top), grams.levels()))
            del grams
        _, places = block_keys(level for *_, levels in read for level in levels)
        replies = sorted(zip(right.column("shard").to_pylist(), right.column("found").to_pylist(), strict=True))
        found, weights = np.concatenate([ns.unpacked_floats(p).reshape(2, -1) for _, p in replies], axis=1)
        for some, kind, numbers, size, levels in read:
            plain, alone = np.empty(size), np.empty(size)
            shorter = shorter_alone = np.full(1, uniform[kind])
            for level in levels:
                v, w = found[next(places)].astype(float), weights[next(places)].astype(float)
                shorter, shorter_alone = shorter[level.shorter], shorter_alone[level.shorter]
                # A context never seen leaves the shorter one's probability as it is.
                others = np.where(np.signbit(v), 0.0, np.nan_to_num(v)) + np.nan_to_num(w) * shorter_alone
                shorter_alone = np.where(np.isnan(w) | np.signbit(w), shorter_alone, others)
                shorter = np.where(np.isnan(w), shorter, np.abs(np.nan_to_num(v)) + np.abs(np.nan_to_num(w)) * shorter)
                plain[level.longest], alone[level.longest] = shorter[level.ends], shorter_alone[level.ends]
            plain, alone = np.log(np.maximum(plain, 1e-300)), np.log(np.maximum(alone, 1e-300))
            for layer, number in zip(some, numbers, strict=True):
                per_unit = np.bincount(layer.unit, minlength=layer.units)
                chars[kind] += np.bincount(layer.owners, per_unit[layer.tokens], len(docs)).astype(np.int64)
                for i, logarithm in enumerate((plain, alone)):
                    per_unit = np.bincount(layer.unit, logarithm[number][layer.number], layer.units)
                    logs[kind, i] += np.bincount(layer.owners, per_unit[layer.tokens], len(docs))
        del read, found, weights, places
        release_memory()
        trusted = np.array([d[2] for d in docs]) == 1
        return pa.Table.from_arrays([
            pa.array([d[0] for d in docs], pa.int64()), pa.array([d[3] for d in docs], pa.string()), pa.array([d[2] for d in docs], pa.int32()),
            *[c for kind in (WORDS, TEXT) for c in (pa.array(chars[kind]), pa.array(logs[kind, 0]), pa.array(logs[kind, 1], mask=~trusted))],
        ], schema=result_schema)

    asked = packed.groupBy("block").applyInArrow(ask, "shard int, block int, keys binary")
    placed = model.mapInArrow(_keyed(shards), "shard int, low long, weight boolean, value float")
    answered = asked.groupBy("shard").cogroup(placed.groupBy("shard")).applyInArrow(answer, ns.REPLY)
    scored = packed.groupBy("block").cogroup(answered.groupBy("block")).applyInArrow(
        finish, "doc_id long, lang string, trusted int, " + ", ".join(f"{p}_n_chars long, {p}_log_probability double, {p}_held_out double" for p in PARTS)
    )
    return scratch.put(scored, "scored")


def quality(docs: DataFrame, labels: DataFrame, order: int = ORDER, quantile: float = QUANTILE,
            id_column: str = "doc_id", text_column: str = "text", lang_column: str = "lang", block_bytes: int = BLOCK_BYTES,
            shard_bytes: int | None = None, part_bytes: int = PART_BYTES) -> DataFrame:
    """doc_id, lang, perplexity, threshold (inside words), text_perplexity, text_threshold (running text), kept; one row per row.

    A task's memory follows ``block_bytes`` and ``part_bytes``; there is a shard of the model for each ``shard_bytes`` of text, by default for each block.
    """
    scratch = Scratch(docs.sparkSession, "quality")
    scored = perplexities(docs, labels, order, scratch, id_column, text_column, lang_column, block_bytes, shard_bytes, part_bytes)
    of = lambda part, logs: F.when(F.col(f"{part}_n_chars") > 0, F.exp(-F.col(f"{part}_{logs}") / F.col(f"{part}_n_chars")))
    trusted = scored.where("trusted = 1 and word_n_chars > 0")
    at = [F.percentile_approx(of(p, "held_out"), F.lit(quantile), F.lit(10_000)).alias(f"{p}_limit") for p in PARTS]
    by_lang = trusted.groupBy("lang").agg(*at, F.count(F.lit(1)).alias("n"))
    overall = trusted.agg(*at).first()
    shrunk = [((F.col("n") * F.col(f"{p}_limit") + PRIOR * F.lit(overall[f"{p}_limit"])) / (F.col("n") + PRIOR)).alias(f"{p}_limit") for p in PARTS]
    limits = scratch.put(by_lang.select(F.col("lang").alias("l"), *shrunk), "limits")
    joined = scored.join(limits, F.col("lang").eqNullSafe(F.col("l")), "left")
    for part in PARTS:
        joined = joined.withColumn(f"{part}_perplexity", of(part, "log_probability")).withColumn(
            f"{part}_threshold", F.coalesce(f"{part}_limit", F.lit(overall[f"{part}_limit"]).cast("double")))
    kept = [F.coalesce(F.col(f"{p}_perplexity") <= F.col(f"{p}_threshold"), F.lit(True)) for p in PARTS]
    return joined.select("doc_id", "lang", F.col("word_perplexity").alias("perplexity"), F.col("word_threshold").alias("threshold"),
                         "text_perplexity", "text_threshold", (kept[0] & kept[1]).alias("kept"))
