"""Count tables sharded by hash, asked and answered in blocks.

Documents are dealt to blocks of bounded size by a hash of their id, with their
texts compressed. A block sends each shard the distinct n-gram keys it wants to
know about, as one packed row; the shard answers with values in the same order.
This is a join of exploded n-grams with count tables partitioned by hash, with the
rows of a block and a shard kept together: an n-gram is sent once per block that
has it, however often it occurs, so frequent ones are no hot keys.

Blocks and shards grow in number with the input, not in size. A key is 40 bits
of its hash within its shard. Each block writes to each shard, as in any shuffle;
for very large inputs choose larger blocks, as executors' memory allows (a task
needs about 25 times a block).
"""

from __future__ import annotations

import math
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import small_batches

BLOCK_BYTES = 8 << 20
LOW = (1 << 40) - 1
PACKED = "block int, ids binary, lengths binary, flags binary, langs array<string>, payload binary"
REQUEST = "shard int, block int, keys binary, counts binary"
REPLY = "block int, shard int, found binary"


def block_count(docs: DataFrame, text_column: str = "text", block_bytes: int = BLOCK_BYTES) -> int:
    size = docs.agg(F.sum(F.octet_length(F.col(text_column)).cast("long"))).first()[0] or 0
    return max(1, math.ceil(size / block_bytes))


def packed_blocks(docs: DataFrame, blocks: int) -> DataFrame:
    """``docs``: doc_id long, text binary, flag int, lang string -> rows of compressed texts per block and task."""
    import numpy as np
    import pyarrow as pa
    import zstandard

    schema = pa.schema([("block", pa.int32()), ("ids", pa.binary()), ("lengths", pa.binary()), ("flags", pa.binary()),
                        ("langs", pa.list_(pa.string())), ("payload", pa.binary())])

    def run(batches: Iterator) -> Iterator:
        pack = zstandard.ZstdCompressor(level=6).compress
        held: dict[int, list[tuple]] = {}
        size = 0

        def flushed():
            for block, rows in sorted(held.items()):
                texts = [r[1] or b"" for r in rows]
                yield pa.RecordBatch.from_arrays([
                    pa.array([block], pa.int32()), pa.array([np.array([r[0] for r in rows], np.int64).tobytes()]),
                    pa.array([np.array([len(t) for t in texts], np.int64).tobytes()]),
                    pa.array([np.array([r[2] or 0 for r in rows], np.int8).tobytes()]),
                    pa.array([[r[3] for r in rows]], pa.list_(pa.string())), pa.array([pack(b"".join(texts))]),
                ], schema=schema)

        for batch in batches:
            columns = [c.to_pylist() for c in batch.columns]
            for doc_id, text, flag, lang, block in zip(*columns, strict=True):
                held.setdefault(block, []).append((doc_id, text, flag, lang))
                size += len(text or b"")
            if size > 32 << 20:
                yield from flushed()
                held.clear()
                size = 0
        yield from flushed()

    dealt = docs.select("doc_id", "text", "flag", "lang", F.pmod(F.xxhash64("doc_id"), F.lit(blocks)).cast("int").alias("block"))
    return small_batches(dealt).mapInArrow(run, PACKED).repartition(blocks, "block")


def block_texts(rows) -> Iterator[tuple[int, bytes, int, str | None]]:
    """(doc_id, text, flag, lang) of a block, in an order that only depends on the documents."""
    import numpy as np
    import zstandard

    unpack = zstandard.ZstdDecompressor()
    found = []
    for ids, lengths, flags, langs, payload in zip(*[rows.column(c).to_pylist() for c in ("ids", "lengths", "flags", "langs", "payload")], strict=True):
        text, at = unpack.decompress(payload, max_output_size=1 << 31), 0
        for doc_id, n, flag, lang in zip(np.frombuffer(ids, np.int64).tolist(), np.frombuffer(lengths, np.int64).tolist(), np.frombuffer(flags, np.int8).tolist(), langs, strict=True):
            found.append((doc_id, text[at : at + n], flag, lang))
            at += n
    found.sort(key=lambda r: (r[0], r[1]))
    return found


def shard_keys(hashes, shards: int):
    """Shard and 40 bits of each hash, as one number that sorts by shard."""
    import numpy as np

    return (((hashes >> np.uint64(40)) % np.uint64(shards)) << np.uint64(40)) | (hashes & np.uint64(LOW))


def requests(block: int, keys, counts, shards: int) -> list[dict]:
    """Rows to send for sorted distinct ``keys`` of :func:`shard_keys`."""
    import numpy as np
    import zstandard

    pack = zstandard.ZstdCompressor(level=1).compress
    ends = np.searchsorted(keys, np.arange(shards + 1, dtype=np.uint64) << np.uint64(40))
    low = np.ascontiguousarray(keys).view(np.uint8).reshape(-1, 8)[:, :5]
    rows = []
    for shard in range(shards):
        a, b = ends[shard], ends[shard + 1]
        if b > a:
            rows.append({"shard": shard, "block": block, "keys": low[a:b].tobytes(), "counts": pack(counts[a:b].astype(np.uint32).tobytes())})
    return rows


def packed_planes(values, *before) -> bytes:
    """Numbers byte by byte, each place packed on its own, after any other arrays; lengths come first."""
    import numpy as np
    import zstandard

    pack = zstandard.ZstdCompressor(level=1).compress
    width = values.itemsize * (values.shape[1] if values.ndim > 1 else 1)
    parts = [pack(np.ascontiguousarray(p).tobytes()) for p in (*before, *values.view(np.uint8).reshape(len(values), width).T)]
    return np.array([len(p) for p in parts], np.uint32).tobytes() + b"".join(parts)


def unpacked_planes(payload: bytes, parts: int) -> list:
    """The byte arrays of :func:`packed_planes`."""
    import numpy as np
    import zstandard

    unpack = zstandard.ZstdDecompressor()
    ends = 4 * parts + np.cumsum(np.frombuffer(payload, np.uint32, parts), dtype=np.int64)
    return [np.frombuffer(unpack.decompress(payload[a:b], max_output_size=1 << 31), np.uint8) for a, b in zip([4 * parts, *ends[:-1].tolist()], ends.tolist(), strict=True)]


def packed_keys(keys) -> bytes:
    """Sorted distinct keys of one shard: the steps between their 40 bits, which need fewer bytes."""
    import numpy as np

    low = keys & np.uint64(LOW)
    steps = np.diff(low, prepend=np.uint64(0)).view(np.uint8).reshape(-1, 8)
    return packed_planes(np.ascontiguousarray(steps[:, :5]))


def unpacked_keys(payload: bytes):
    import numpy as np

    planes = unpacked_planes(payload, 5)
    wide = np.zeros((len(planes[0]), 8), np.uint8)
    for i, plane in enumerate(planes):
        wide[:, i] = plane
    return np.cumsum(wide.view(np.uint64).ravel(), dtype=np.uint64)


def packed_floats(values) -> bytes:
    """32-bit numbers, of which NaN take a bit only."""
    import numpy as np

    flat = values.ravel()
    known = ~np.isnan(flat)
    return packed_planes(flat[known], np.array([len(flat)], np.int64).view(np.uint8), np.packbits(known))


def unpacked_floats(payload: bytes):
    import numpy as np

    n, known, *planes = unpacked_planes(payload, 6)
    out = np.full(n.view(np.int64)[0], np.nan, np.float32)
    out[np.unpackbits(known, count=len(out)).astype(bool)] = np.column_stack(planes).view(np.float32).ravel()
    return out


def request_keys(payload: bytes):
    import numpy as np

    low = np.frombuffer(payload, np.uint8).reshape(-1, 5)
    wide = np.zeros((len(low), 8), np.uint8)
    wide[:, :5] = low
    return wide.view(np.uint64).ravel()


def request_counts(payload: bytes):
    import numpy as np
    import zstandard

    return np.frombuffer(zstandard.ZstdDecompressor().decompress(payload, max_output_size=1 << 31), np.uint32)


def reply(values) -> bytes:
    import zstandard

    return zstandard.ZstdCompressor(level=1).compress(values.tobytes())


def replies(rows, dtype) -> object:
    """Values for all keys of a block, in the order of its keys."""
    import numpy as np
    import zstandard

    unpack = zstandard.ZstdDecompressor()
    pairs = sorted(zip(rows.column("shard").to_pylist(), rows.column("found").to_pylist(), strict=True))
    parts = [np.frombuffer(unpack.decompress(p, max_output_size=1 << 31), dtype) for _, p in pairs]
    return np.concatenate(parts) if parts else np.zeros(0, dtype)


def table_of(rows: list[dict], schema):
    import pyarrow as pa

    return pa.Table.from_pylist(rows, schema=schema)
