"""Stupid-backoff scores of documents against all other documents.

A word's score is c(a b w) / c(a b); where that n-gram occurs in no other document
it is 0.4 times the score with the shorter context, down to c(w) / N, or 0.4 / (N + 1)
for a word that no other document has. Counts are of the whole
corpus less the document itself, else every text would vouch for itself. The first
words of a document start with the context they have. Words are what
``[\\x20\\x09-\\x0D]`` parts, with A-Z in lower case. A document's score is the sum
of logarithms; the mean is per word, and null without words (null or empty text).

Count tables are sharded by hash (see ``ngramshards``). Repeated rows count each;
rows of one id form one document. Extra columns are not read; an empty table gives none.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import ngramshards as ns
from tidemark.llm import textarrays as ta
from tidemark.llm.mixing import word_count

ORDER, FACTOR = 3, 0.4


def _ngrams(docs: list[tuple], order: int):
    """Per order the hash of the n-gram that ends at each word (0 where there is none); the words' document numbers."""
    hasher = ta.WordHasher()
    words, owners = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    number = {}
    rows = [(number.setdefault(d[0], len(number)), d[1]) for d in docs]
    for held, data, bounds in ta.chunks(iter(rows), 1):
        hashes, starts = hasher(ta.lower_ascii(data))
        words.append(hashes)
        owners.append(np.array([h[0] for h in held], np.int64)[np.searchsorted(bounds, starts, side="right") - 1])
    words, owner = np.concatenate(words), np.concatenate(owners)
    # Rows of one id follow each other, so their words do too, but no n-gram spans two rows.
    row = np.zeros(len(words), np.int64)
    if len(words):
        counts = [len(t.split()) for _, t in rows]
        row = np.repeat(np.arange(len(counts)), counts)
    out = [words | np.uint64(1)]
    with np.errstate(over="ignore"):
        for n in range(2, order + 1):
            longer = np.zeros(len(words), np.uint64)
            if len(words) >= n:
                same = row[n - 1 :] == row[: len(row) - n + 1]
                # The shorter n-gram one word back, followed by this word.
                joined = ta.mixed(out[-1][n - 2 : len(words) - 1] * np.uint64(ta.STEP) + words[n - 1 :]) | np.uint64(1)
                longer[n - 1 :] = np.where(same, joined, np.uint64(0))
            out.append(longer)
    return out, owner, list(number)


def scores(docs: DataFrame, order: int = ORDER, factor: float = FACTOR, id_column: str = "doc_id", text_column: str = "text",
           block_bytes: int = ns.BLOCK_BYTES) -> DataFrame:
    """doc_id, n_words, log_score, mean_log_score, and backed_off: words scored below the full order."""
    blocks = shards = ns.block_count(docs, text_column, block_bytes)
    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("binary").alias("text"),
                       F.lit(0).alias("flag"), F.lit(None).cast("string").alias("lang"))
    packed = ns.packed_blocks(rows, blocks)
    request_schema = pa.schema([("shard", pa.int32()), ("block", pa.int32()), ("keys", pa.binary()), ("counts", pa.binary())])
    reply_schema = pa.schema([("block", pa.int32()), ("shard", pa.int32()), ("found", pa.binary())])
    result_schema = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("log_score", pa.float64()), ("backed_off", pa.int64())])

    total, log_factor = scores_total(rows), float(np.log(factor))

    def ask(table: pa.Table) -> pa.Table:
        block = table.column("block")[0].as_py()
        grams, _, _ = _ngrams(ns.block_texts(table), order)
        out = []
        for n, hashes in enumerate(grams):
            found, counts = np.unique(ns.shard_keys(hashes[hashes != 0], shards), return_counts=True)
            out += [r | {"shard": r["shard"] * order + n} for r in ns.requests(block, found, counts, shards)]
        if not out:
            out = [{"shard": 0, "block": block, "keys": b"", "counts": ns.reply(np.zeros(0, np.uint32))}]
        return ns.table_of(out, request_schema)

    def answer(table: pa.Table) -> pa.Table:
        shard = table.column("shard")[0].as_py()
        keys = [ns.request_keys(k) for k in table.column("keys").to_pylist()]
        counts = [ns.request_counts(c) for c in table.column("counts").to_pylist()]
        _, at = np.unique(np.concatenate(keys), return_inverse=True)
        totals = np.bincount(at, np.concatenate(counts)).astype(np.uint32) if len(at) else np.zeros(0, np.uint32)
        ends = np.cumsum([len(k) for k in keys])[:-1]
        parts = np.split(totals[at] if len(at) else totals, ends)
        return ns.table_of([{"block": b, "shard": shard, "found": ns.reply(p)} for b, p in zip(table.column("block").to_pylist(), parts, strict=True)], reply_schema)

    def finish(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows:
            return result_schema.empty_table()
        grams, owner, ids = _ngrams(ns.block_texts(left), order)
        n_docs, n_words = len(ids), np.bincount(owner, minlength=len(ids))
        shard = np.array(right.column("shard").to_pylist(), np.int64)
        elsewhere = []
        for n, hashes in enumerate(grams):
            present = hashes != 0
            _, at = np.unique(ns.shard_keys(hashes[present], shards), return_inverse=True)
            mine = right.filter(pa.array(shard % order == n)) if len(shard) else right
            totals = ns.replies(mine, np.uint32).astype(np.int64)[at]
            # Occurrences in the document itself.
            own = at.astype(np.int64) * n_docs + owner[present]
            _, which, times = np.unique(own, return_inverse=True, return_counts=True)
            counts = np.zeros(len(hashes), np.int64)
            counts[present] = totals - times[which]
            elsewhere.append(counts)
        counts, n = elsewhere, len(owner)
        rest = total - n_words[owner]
        value = np.where(counts[0] > 0, np.log(np.maximum(counts[0], 1)) - np.log(np.maximum(rest, 1)), log_factor - np.log(rest + 1.0))
        steps = np.zeros(n, np.int64)
        for k in range(1, order):
            has = grams[k] != 0
            # The context is the n-gram of one word less that ends one word earlier.
            context = np.zeros(n, np.int64)
            context[1:] = counts[k - 1][:-1]
            hit = has & (counts[k] > 0)
            direct = np.log(np.maximum(counts[k], 1)) - np.log(np.maximum(context, 1))
            value = np.where(hit, direct, np.where(has, value + log_factor, value))
            steps = np.where(hit, 0, np.where(has, steps + 1, steps))
        return pa.Table.from_arrays([
            pa.array(ids, pa.int64()), pa.array(n_words, pa.int64()), pa.array(np.bincount(owner, value, n_docs)),
            pa.array(np.bincount(owner, steps > 0, n_docs).astype(np.int64)),
        ], schema=result_schema)

    asked = packed.groupBy("block").applyInArrow(ask, ns.REQUEST)
    answered = asked.groupBy("shard").applyInArrow(answer, ns.REPLY)
    scored = packed.groupBy("block").cogroup(answered.groupBy("block")).applyInArrow(
        finish, "doc_id long, n_words long, log_score double, backed_off long"
    )
    mean = F.when(F.col("n_words") > 0, F.col("log_score") / F.col("n_words"))
    return scored.select("doc_id", "n_words", "log_score", mean.alias("mean_log_score"), "backed_off")


def scores_total(rows: DataFrame) -> int:
    """Words of all documents."""
    return rows.agg(F.sum(word_count(F.col("text").cast("string")))).first()[0] or 0
