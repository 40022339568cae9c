"""Pack tokenised documents into fixed-length sequences, shortest pack first.

A document is its token ids followed by the end id, so every document has at
least one id (null text counts as empty). It is cut into full pieces of
``length`` ids and one remainder. Full pieces fill a sequence each. Remainders
are packed over the histogram of their lengths, longest first, each into the
packs that hold least so far and still have room; what is counted are packing
patterns, so the work follows the number of lengths, not of documents. Patterns
are then joined back to the pieces by their rank among pieces of equal length.

The histogram and the patterns are bounded by ``length`` and are the only thing
the driver sees. Ranks come from range partitions (a hot length spans tasks).
Equal texts and repeated rows are packed each on its own, in order of id.
An empty table gives none. Extra columns are not read.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import Scratch, arrow_chunks, arrow_rows, release_memory, running_total, small_batches

LENGTH = 2048
END_ID = 1
# Words whose ids a task keeps at hand; when full, the memory starts anew.
KEPT_WORDS = 400_000
# What the tokenizer's own cutting is known to do with: printable ASCII without
# the apostrophe, and the Latin letters that have one lower-case letter each.
LETTERS = "A-Za-zÀ-ÖØ-öø-ÿ"
SIMPLE = re.compile(f"[!-&(-~{LETTERS}]+")
PIECE = re.compile(f"[{LETTERS}]+|[0-9]|[^{LETTERS}0-9]+")
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


class Remembered(dict):
    """Values made from their keys when first asked for."""

    def __init__(self, make: Callable):
        self.make = make

    def __missing__(self, key):
        value = self[key] = self.make(key)
        return value


def word_encoder(tokenizer_file: str) -> Callable[[bytes], bytes]:
    """A function from UTF-8 text to its ids as little-endian unsigned 32-bit numbers.

    The tokenizer never joins across white space, so words between ASCII blanks
    are encoded on their own, each distinct word once while it is kept. Words of
    printable ASCII and Latin letters are cut and lower-cased here as the
    tokenizer does it, and their pieces go straight to its merges, which is
    several times faster; all others go through the whole tokenizer.
    """
    from tokenizers import Tokenizer, pre_tokenizers

    tokenizer = Tokenizer.from_file(tokenizer_file)
    merges = tokenizer.model.tokenize
    as_bytes = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str
    accents = str.maketrans({c: as_bytes(c)[0][0] for c in map(chr, range(0xC0, 0x100)) if PIECE.fullmatch(c)})
    packed = Remembered(lambda i: i.to_bytes(4, "little"))

    def of_piece(piece: str) -> bytes:
        return b"".join([packed[token.id] for token in merges(piece if piece.isascii() else piece.translate(accents))])

    pieces = Remembered(of_piece)

    def of_word(word: bytes) -> bytes:
        text = word.decode()
        if SIMPLE.fullmatch(text) and "<|" not in text:
            return b"".join([pieces[piece] for piece in PIECE.findall(text.lower())])
        return b"".join([packed[i] for i in tokenizer.encode(text, add_special_tokens=False).ids])

    known = Remembered(of_word)

    def encode(text: bytes) -> bytes:
        if len(known) > KEPT_WORDS:
            known.clear()
            pieces.clear()
        return b"".join(map(known.__getitem__, text.split()))

    return encode


def cut_documents(docs: DataFrame, tokenizer_file: str, length: int, id_column: str, text_column: str, with_ids: bool = False) -> DataFrame:
    """Pieces of every document: doc_id, start, length, ids_crc32, doc_tokens (and the ids)."""
    import pyarrow as pa

    fields = [("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("doc_tokens", pa.int64())]
    if with_ids:
        fields.append(("ids", pa.binary()))
    schema = pa.schema(fields)
    end = END_ID.to_bytes(4, "little")

    def cut(batches: Iterator) -> Iterator:
        encode = word_encoder(tokenizer_file)

        def pieces():
            for doc_id, text in arrow_rows(batches, ["doc_id", "text"]):
                ids = encode(text or b"") + end
                n = len(ids) // 4
                for start in range(0, n, length):
                    part = ids[4 * start : 4 * (start + length)]
                    row = (doc_id, start, len(part) // 4, zlib.crc32(part), n)
                    yield (*row, part) if with_ids else row

        yield from arrow_chunks(pieces(), schema)
        del encode
        release_memory()

    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("binary").alias("text"))
    return small_batches(rows).mapInArrow(cut, PIECES + (", ids binary" if with_ids else ""))


def shortest_pack_first(histogram: dict[int, int], length: int) -> list[tuple[tuple[int, ...], int]]:
    """Packing patterns (lengths in order of placing) and how often each is used."""
    # By room left: patterns with that room and their counts.
    room: dict[int, dict[tuple[int, ...], int]] = {}
    for size in sorted(histogram, reverse=True):
        left = histogram[size]
        while left:
            free = max((r for r in room if r >= size), default=None)
            if free is None:
                room.setdefault(length - size, {})[(size,)] = left
                break
            pattern, count = next(iter(room[free].items()))
            taken = min(count, left)
            if taken == count:
                del room[free][pattern]
                if not room[free]:
                    del room[free]
            else:
                room[free][pattern] = count - taken
            grown = room.setdefault(free - size, {})
            grown[(*pattern, size)] = grown.get((*pattern, size), 0) + taken
            left -= taken
    return [(p, n) for found in sorted(room) for p, n in room[found].items()]


def _slots(patterns: list[tuple[tuple[int, ...], int]]) -> list[tuple[int, int, int, int, int]]:
    """(length, first rank, last rank + 1, first sequence, offset) for every slot of every pattern."""
    used: dict[int, int] = {}
    slots, first = [], 0
    for pattern, count in patterns:
        offset = 0
        for size in pattern:
            rank = used.get(size, 0)
            slots.append((size, rank, rank + count, first, offset))
            used[size] = rank + count
            offset += size
        first += count
    return slots


def pack(
    docs: DataFrame, tokenizer_file: str, length: int = LENGTH, id_column: str = "doc_id", text_column: str = "text",
    with_ids: bool = False,
) -> DataFrame:
    """Pieces with sequence_id and offset; sequences of full pieces follow the packed ones."""
    import numpy as np
    import pyarrow as pa

    scratch = Scratch(docs.sparkSession, "pack")
    pieces = scratch.put(cut_documents(docs, tokenizer_file, length, id_column, text_column, with_ids), "pieces")
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    full = counts.pop(length, 0)
    patterns = shortest_pack_first(counts, length)
    packed = sum(n for _, n in patterns)
    slots = _slots(patterns) + ([(length, 0, full, packed, 0)] if full else [])
    # Slots of a length lie together, by rank; ranks of all lengths are made one ascending key.
    slots.sort()
    stride = 1 << 44
    starts = np.array([s[0] * stride + s[1] for s in slots], "int64")
    ranks, sequences, offsets = (np.array([s[i] for s in slots], "int64") for i in (1, 3, 4))
    # Repeated rows of one id differ in nothing, so any order among them gives the same result.
    order = ["doc_id", "start"]
    ranked = running_total(pieces.withColumn("_one", F.lit(1).cast("long")), ["length"], [F.col(c) for c in order], order, "_one", "_rank", scratch)
    scratch.drop(pieces)
    rows = ranked.drop("_one")

    def place(batches: Iterator) -> Iterator:
        for batch in batches:
            at = batch.schema.get_field_index
            size = batch.column(at("length")).to_numpy(zero_copy_only=False)
            rank = batch.column(at("_rank")).to_numpy(zero_copy_only=False) - 1
            slot = np.searchsorted(starts, size * stride + rank, side="right") - 1
            keep = [i for i, name in enumerate(batch.schema.names) if name != "_rank"]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(i) for i in keep], pa.array(sequences[slot] + rank - ranks[slot]), pa.array(offsets[slot])],
                names=[*[batch.schema.names[i] for i in keep], "sequence_id", "offset"],
            )

    names = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields if f.name != "_rank")
    placed = rows.mapInArrow(place, f"{names}, sequence_id long, offset long")
    return placed.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", *(["ids"] if with_ids else []))
