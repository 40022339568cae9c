"""Fill-in-the-middle texts by rotating blocks in place.

A text is cut into units (``[A-Za-z]+|[^A-Za-z]``, over code points). Two cuts
drawn from a hash of the id part it into prefix, middle and suffix. Sentinels go
into a bytearray in reading order, ``<P>prefix<M>middle<S>suffix``, and one
rotation by three reversals exchanges two neighbouring blocks:

* psm: ``<M>middle`` with ``<S>suffix`` gives ``<P>prefix<S>suffix<M>middle``;
* spm: all before with ``<S>suffix`` gives ``<S>suffix<P>prefix<M>middle``.

``restore`` finds the sentinels, rotates back and takes them out. Sentinels share
no beginning with an ending, so the first one found is the one put in: texts that
hold one themselves stay plain, as do empty texts and a given share of the others.

Work is per text: a task holds a batch of texts, never a group. Null text counts
as empty. A null id draws from the hash of the seed alone. Rows that repeat an id
get the same draws; each is cut by itself. Extra columns are not read. An empty
table gives none.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values of the format.
PREFIX, MIDDLE, SUFFIX = b"<P>", b"<M>", b"<S>"
MARK = 3  # bytes of a sentinel
BATCH_BYTES = 16 << 20


def draws(id_column: str = "doc_id", seed: str = "1") -> list[Column]:
    """Four unsigned 32-bit numbers from the id."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_column).cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long") for k in range(4)]


def unit_starts(raw: bytes):
    """Byte offset of every unit of a UTF-8 text, and the text's length."""
    import numpy as np

    at = np.frombuffer(raw, np.uint8)
    lower = at | 0x20
    letter = (lower >= 97) & (lower <= 122)
    begins = (at & 0xC0) != 0x80
    begins[1:] &= ~(letter[1:] & letter[:-1])
    return np.append(np.flatnonzero(begins), len(raw))


def code_points(raw: bytes) -> int:
    import numpy as np

    return int(np.count_nonzero((np.frombuffer(raw, np.uint8) & 0xC0) != 0x80))


def _reverse(view, a: int, b: int) -> None:
    half = (b - a) // 2
    front = view[a : a + half].copy()
    view[a : a + half] = view[b - half : b][::-1]
    view[b - half : b] = front[::-1]


def exchange(buffer: bytearray, a: int, m: int, b: int) -> None:
    """Swap the neighbours [a, m) and [m, b) in place by three reversals."""
    import numpy as np

    view = np.frombuffer(buffer, np.uint8)
    _reverse(view, a, m)
    _reverse(view, m, b)
    _reverse(view, a, b)


def rearrange(raw: bytes, first: int, second: int, form: str) -> bytes:
    """The text with its byte range [first, second) as the middle."""
    buffer = bytearray(raw)
    for at, mark in ((second, SUFFIX), (first, MIDDLE), (0, PREFIX)):
        buffer[at:at] = mark
    middle, suffix = first + MARK, second + 2 * MARK
    exchange(buffer, middle if form == "psm" else 0, suffix, len(buffer))
    return bytes(buffer)


def put_back(output: bytes, form: str) -> bytes:
    """The text that ``rearrange`` was given."""
    buffer = bytearray(output)
    if form == "psm":
        suffix = buffer.find(SUFFIX)
        middle = buffer.find(MIDDLE, suffix)
        exchange(buffer, suffix, middle, len(buffer))
        middle, suffix = suffix, suffix + len(buffer) - middle
    else:
        prefix = buffer.find(PREFIX)
        middle = buffer.find(MIDDLE, prefix) - prefix
        exchange(buffer, 0, prefix, len(buffer))
        suffix = len(buffer) - prefix
    for at in (suffix, middle, 0):
        del buffer[at : at + MARK]
    return bytes(buffer)


def _batches(rows: Iterator[tuple], schema) -> Iterator:
    """Rows as Arrow batches of bounded bytes; the texts are the binary columns."""
    import pyarrow as pa

    held: list[tuple] = []
    size = 0
    for row in rows:
        held.append(row)
        size += 64 + sum(len(v) for v in row if isinstance(v, bytes))
        if size >= BATCH_BYTES:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held, strict=True), schema, strict=True)], schema=schema)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held, strict=True), schema, strict=True)], schema=schema)


def _values(batches: Iterator) -> Iterator[tuple]:
    """Rows of batches, one value at a time, so that no batch stands twice in memory."""
    for batch in batches:
        columns = batch.columns
        for i in range(batch.num_rows):
            yield tuple(c[i].as_py() for c in columns)


def fill_in_middle(
    docs: DataFrame, plain_from: int = 90, spm_below: int = 20, seed: str = "1", id_column: str = "doc_id", text_column: str = "text",
) -> DataFrame:
    """doc_id, n (units), form, prefix_chars, middle_chars, output.

    Of the draws, ``plain_from`` per cent of texts are rearranged, ``spm_below``
    per cent of those with the suffix first.
    """
    import pyarrow as pa

    text = F.coalesce(F.col(text_column), F.lit(""))
    h1, h2, h3, h4 = draws(id_column, seed)
    marked = [F.contains(text, F.lit(m.decode())) for m in (PREFIX, MIDDLE, SUFFIX)]
    plain = (text == "") | marked[0] | marked[1] | marked[2] | (h3 % 100 >= plain_from)
    rows = docs.select(
        F.col(id_column).alias("doc_id"), h1.alias("h1"), h2.alias("h2"),
        F.when(plain, "plain").when(h4 % 100 < spm_below, "spm").otherwise("psm").alias("form"),
        text.cast("binary").alias("text"),
    )
    kind = dict(rows.dtypes)["doc_id"]
    fields = [("n", pa.int64()), ("form", pa.string()), ("prefix_chars", pa.int64()), ("middle_chars", pa.int64()), ("output", pa.binary())]

    def cut(batches: Iterator) -> Iterator:
        schema = None

        def out(first, rest):
            def every():
                yield first
                yield from rest

            for doc_id, h1, h2, form, raw in _values(every()):
                at = unit_starts(raw)
                n = len(at) - 1
                if form == "plain":
                    yield doc_id, n, form, None, None, raw
                    continue
                first_cut, second_cut = sorted((h1 % (n + 1), h2 % (n + 1)))
                a, b = int(at[first_cut]), int(at[second_cut])
                yield doc_id, n, form, code_points(raw[:a]), code_points(raw[a:b]), rearrange(raw, a, b, form)

        for first in batches:
            schema = pa.schema([("doc_id", first.schema.field("doc_id").type), *fields])
            yield from _batches(out(first, batches), schema)

    cut_rows = rows.mapInArrow(cut, f"doc_id {kind}, n long, form string, prefix_chars long, middle_chars long, output binary")
    return cut_rows.withColumn("output", F.col("output").cast("string"))


def restore(rearranged: DataFrame) -> DataFrame:
    """All columns of rows with ``form`` and ``output``, and the exact text before as ``text``."""
    import pyarrow as pa
    from pyspark.sql import types as T

    raw = rearranged.withColumn("output", F.col("output").cast("binary"))
    schema = T.StructType([*raw.schema.fields, T.StructField("text", T.BinaryType())])

    def back(batches: Iterator) -> Iterator:
        for batch in batches:
            output, form = (batch.column(batch.schema.get_field_index(c)) for c in ("output", "form"))
            texts = [
                o.as_py() if f == "plain" else put_back(o.as_py(), f)
                for o, f in zip(output, form.to_pylist(), strict=True)
            ]
            arrays = [*batch.columns, pa.array(texts, pa.binary())]
            yield pa.RecordBatch.from_arrays(arrays, names=[*batch.schema.names, "text"])

    return raw.mapInArrow(back, schema).withColumns({c: F.col(c).cast("string") for c in ("output", "text")})
