"""Remove repeated byte strings by induced suffix sorting of shards.

Texts are UTF-8 bytes (null: empty). Every byte is removed that lies in a string
of ``span`` bytes which also starts earlier: in a document of smaller id, or
earlier in the same one. Strings are judged on the input and never cross documents.
Rows that repeat an id come in the order of their bytes, each a document of its own:
of equal rows the first stays. An empty table gives none; extra columns are not read.

1. A text of at least ``span`` bytes that a smaller id has whole is removed whole.
2. Each window of ``span`` bytes is anchored at its smallest 32-byte hash, so equal
   windows have equal anchors at equal places. Blocks of documents ask shards how
   often anchors occur (see ``ngramshards``); windows with a unique anchor are unique.
3. The stretches around repeated anchors go to the shard of their anchor. A block
   sends a stretch it has several times once, and drops the later ones itself:
   so a group of many copies sends no more than a few rows per block.
   Around an anchor with over ``HOT`` occurrences (a common line with other text about
   it each time) windows are dealt by their own bytes: blocks ask which windows
   occur again, and each of those goes alone, once per part of a block.
4. A shard's stretches are suffix sorted: LMS substrings are put in order by one
   induction and named, the string of names is sorted, and a second induction puts all
   suffixes in order. Suffixes with ``span`` bytes in common are then neighbours; all
   but the earliest are removed.

No anchor brings more than ``HOT`` stretches and their shards' number follows the input,
so the queues of the induction (one per first byte) are arrays in memory.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import ngramshards as ns
from tidemark.llm import textarrays as ta
from tidemark.llm.common import Scratch, join_checked

SPAN, GRAM = 100, 32
# Texts hashed together: their arrays of eight bytes a byte should stay near the processor.
PART_BYTES = 1 << 17
# An anchor that occurs more often is split by the bytes of its windows.
HOT = 2000
FOUND = "kind int, place int, anchor long, doc_id long, row int, start long, n long, bytes binary"
FOUND_SCHEMA = pa.schema([("kind", pa.int32()), ("place", pa.int32()), ("anchor", pa.int64()), ("doc_id", pa.int64()), ("row", pa.int32()), ("start", pa.int64()),
                          ("n", pa.int64()), ("bytes", pa.binary())])
GONE = "block int, doc_id long, row int, start long, stop long"
GONE_SCHEMA = pa.schema([("block", pa.int32()), ("doc_id", pa.int64()), ("row", pa.int32()), ("start", pa.int64()), ("stop", pa.int64())])


class Anchors:
    """Runs of windows with one anchor, over the joined bytes of several texts."""

    def __init__(self, span: int):
        self.span = span
        self.values = ta.byte_values(13)
        self.up = self.down = np.zeros(0, np.uint64)

    def __call__(self, data: np.ndarray, bounds: np.ndarray):
        """anchor hash, text number, first window, windows of each run. Texts are parted by one byte."""
        n, width = len(data), self.span - GRAM + 1
        empty = np.zeros(0, np.int64)
        if n < self.span:
            return np.zeros(0, np.uint64), empty, empty, empty
        if n + 1 > len(self.up):
            self.up, self.down = ta.powers(n + n // 4 + 1, ta.BASE), ta.powers(n + n // 4 + 1, ta.INVERSE)
        with np.errstate(over="ignore"):
            sums = np.zeros(n + 1, np.uint64)
            np.cumsum(self.values[data] * self.up[:n], out=sums[1:])
            hashes = ta.mixed((sums[GRAM:] - sums[:-GRAM]) * self.down[: n - GRAM + 1])
        # The smallest of each window, the first of equals: 32 bits of hash, then the place.
        least = (hashes & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(hashes), dtype=np.uint64)
        reach = 1
        while 2 * reach <= width:
            least = np.minimum(least[:-reach], least[reach:])
            reach *= 2
        rest = width - reach
        if rest:
            least = np.minimum(least[:-rest], least[rest:])
        place = (least & np.uint64(0xFFFFFFFF)).astype(np.int64)
        # Per text its windows, and those of them that begin a run: the first, and each with another anchor than the one before.
        windows = np.maximum(np.diff(bounds) - self.span, 0)
        if not windows.any():
            return np.zeros(0, np.uint64), empty, empty, empty
        new = np.zeros(len(place) + 1, bool)
        new[1:-1] = place[1:] != place[:-1]
        inside = np.zeros(len(place) + 1, np.int8)
        some = windows > 0
        inside[bounds[:-1][some]] = 1
        inside[bounds[:-1][some] + windows[some]] -= 1
        new[bounds[:-1][some]] = True
        first = np.flatnonzero(new[:-1] & (np.cumsum(inside[:-1], dtype=np.int8) > 0))
        text = np.searchsorted(bounds, first, side="right") - 1
        stop = bounds[text] + windows[text]
        following = np.append(first[1:], stop[-1])
        return hashes[place[first]], text, first, np.minimum(following, stop) - first


def _numbered(table: pa.Table) -> list[tuple]:
    """(doc_id, text, flag, row) of a block; row counts the rows of an id, which all are in its block, by their bytes."""
    out: list[tuple] = []
    for doc_id, text, flag, _ in ns.block_texts(table):
        out.append((doc_id, text, flag, out[-1][3] + 1 if out and out[-1][0] == doc_id else 0))
    return out


def _windows(data: np.ndarray, at: np.ndarray, span: int) -> np.ndarray:
    """Hashes of the windows that start at some places of a byte array."""
    up, down = ta.powers(len(data) + 1, ta.BASE), ta.powers(len(data) + 1, ta.INVERSE)
    with np.errstate(over="ignore"):
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(ta.byte_values(19)[data] * up[:-1], out=sums[1:])
        return ta.mixed((sums[at + span] - sums[at]) * down[at])


def _starts(first: np.ndarray, n: np.ndarray) -> np.ndarray:
    """All windows of some runs."""
    return np.repeat(first - np.cumsum(n) + n, n) + np.arange(n.sum())


def _later_equals(data: np.ndarray, at: np.ndarray, hashes: np.ndarray, span: int) -> np.ndarray:
    """Which of the windows at ascending places equal an earlier one."""
    by = np.argsort(hashes, kind="stable")
    new = np.ones(len(by), bool)
    new[1:] = hashes[by[1:]] != hashes[by[:-1]]
    lead = at[by[np.flatnonzero(new)[np.cumsum(new) - 1]]] if len(by) else at
    equal = ~new
    for i in range(span):
        equal &= data[at[by] + i] == data[lead + i]
    out = np.zeros(len(by), bool)
    out[by] = equal
    return out


def _runs(docs: list[tuple], span: int):
    """Per chunk of a block: its rows, bytes, bounds and runs."""
    find = Anchors(span)
    for held, data, bounds in ta.chunks((d for d in docs if not d[2]), 1):
        cuts = ta.distinct_sorted(np.array([0, *np.searchsorted(bounds, np.arange(PART_BYTES, len(data), PART_BYTES)), len(held)]))
        found = []
        for i, j in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
            anchors, text, first, n = find(data[bounds[i] : bounds[j]], bounds[i : j + 1] - bounds[i])
            found.append((anchors, text + i, first + bounds[i], n))
        yield held, data, bounds, tuple(np.concatenate(c) for c in zip(*found, strict=True))


def induced_suffix_array(text: np.ndarray, span: int) -> np.ndarray:
    """Suffixes of a byte string in order of at least their first ``span`` bytes."""
    n = len(text)
    if n < 2:
        return np.arange(n)
    t = text.astype(np.int16)
    # A suffix is S-type if it is smaller than the next one; the last one counts as L-type.
    step = np.sign(np.diff(t, append=-1))
    following = np.where(step != 0, np.arange(n), n - 1)
    following = np.minimum.accumulate(following[::-1])[::-1]
    is_s = step[following] > 0
    lms = np.flatnonzero(is_s[1:] & ~is_s[:-1]) + 1

    def induce(order: np.ndarray) -> np.ndarray:
        """All suffixes in the order that this order of the LMS suffixes implies."""
        size = int(t.max()) + 1
        by_first = np.split(order, np.searchsorted(t[order], np.arange(1, size))) if len(order) else [order] * size
        larger: list[list[np.ndarray]] = [[] for _ in range(size)]
        larger[t[n - 1]].append(np.array([n - 1]))
        smaller: list[list[np.ndarray]] = [[] for _ in range(size)]

        def send(batch: np.ndarray, queues: list, want_s: bool, own: int) -> np.ndarray:
            """Queue the suffixes one byte longer; return those that fall into the bucket at hand."""
            before = batch[batch > 0] - 1
            before = before[is_s[before] == want_s]
            first = t[before]
            by = np.argsort(first, kind="stable")
            before, first = before[by], first[by]
            cut = np.flatnonzero(np.diff(first)) + 1
            again = before[:0]
            for part in np.split(before, cut) if len(before) else ():
                if t[part[0]] == own:
                    again = part
                else:
                    queues[t[part[0]]].append(part)
            return again

        ordered_l: list[np.ndarray] = []
        for c in range(size):
            done = []
            batch = np.concatenate([np.zeros(0, np.int64), *larger[c]])
            while len(batch):
                done.append(batch)
                batch = send(batch, larger, False, c)
            if len(by_first[c]):
                send(by_first[c], larger, False, c)
            ordered_l.append(np.concatenate([np.zeros(0, np.int64), *done]))
        parts: list[np.ndarray] = []
        for c in range(size - 1, -1, -1):
            done = []
            batch = np.concatenate([np.zeros(0, np.int64), *smaller[c]])
            while len(batch):
                done.append(batch)
                batch = send(batch, smaller, True, c)
            if len(ordered_l[c]):
                send(ordered_l[c][::-1], smaller, True, c)
            parts += [*done, ordered_l[c][::-1]]
        return np.concatenate(parts)[::-1]

    if len(lms):
        # Put LMS substrings in order, name equal ones alike, and sort the string of names.
        some = lms[np.argsort(t[lms], kind="stable")]
        found = induce(some)
        is_lms = np.zeros(n, bool)
        is_lms[lms] = True
        sorted_lms = found[is_lms[found]]
        index = np.zeros(n, np.int64)
        index[lms] = np.arange(len(lms))
        ends = np.append(lms[1:], n - 1)
        lengths = ends - lms + 1
        values = ta.byte_values(17)[text]
        with np.errstate(over="ignore"):
            sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values * ta.powers(n, ta.BASE))])
            sums = (sums[ends + 1] - sums[lms]) * ta.powers(n, ta.INVERSE)[lms]
        k = index[sorted_lms]
        differs = np.ones(len(k), bool)
        differs[1:] = (sums[k[1:]] != sums[k[:-1]]) | (lengths[k[1:]] != lengths[k[:-1]])
        name = np.zeros(len(k), np.int64)
        name[k] = np.cumsum(differs)
        # Each name spans two bytes or more, so these rounds order the first ``span`` bytes.
        reach = 1
        while reach < span and name.max() < len(name):
            pair = np.zeros(len(name), np.int64)
            pair[:-reach] = name[reach:]
            name = ta.distinct_places(name * (len(name) + 1) + pair)[1] + 1
            reach *= 2
            if reach >= len(name):
                break
        lms = lms[np.argsort(name, kind="stable")]
    return induce(lms)


def repeated_starts(stretches: list[bytes], windows: list[int], ranks: list[tuple], span: int) -> list[tuple[int, int]]:
    """(stretch, offset) of windows that an earlier one equals; ``ranks`` order the stretches' first bytes."""
    text = np.frombuffer(b"".join(s + b"\n" for s in stretches), np.uint8)
    lengths = np.array([len(s) + 1 for s in stretches])
    begins = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    owner = np.repeat(np.arange(len(stretches)), lengths)
    offset = np.arange(len(text)) - begins[owner]
    starts = offset < np.array(windows)[owner]
    order = induced_suffix_array(text, span)
    order = order[starts[order]]
    # Hashes tell most neighbours apart; those that agree are compared byte by byte.
    hashes = _windows(text, np.arange(len(text) - span + 1), span) if len(order) else np.zeros(0, np.uint64)
    same = np.zeros(len(order), bool)
    for a in range(1, len(order), 1 << 16):
        x, y = order[a - 1 : a + (1 << 16) - 1], order[a : a + (1 << 16)]
        equal = hashes[x[: len(y)]] == hashes[y]
        for i in range(0, span, 25):
            live = np.flatnonzero(equal)
            at = np.arange(i, min(i + 25, span))
            equal[live] = (text[x[: len(y)][live, None] + at] == text[y[live, None] + at]).all(axis=1)
        same[a : a + len(y)] = equal
    # Only windows that some other equals matter from here on.
    some = same.copy()
    some[:-1] |= same[1:]
    order, group = order[some], np.cumsum(~same)[some]
    *doc, place = [np.array(c)[owner[order]] for c in zip(*ranks, strict=True)]
    by = np.lexsort((place + offset[order], *doc[::-1], group))
    later = np.zeros(len(by), bool)
    later[1:] = group[by[1:]] == group[by[:-1]]
    hit = order[by[later]]
    return list(zip(owner[hit].tolist(), offset[hit].tolist(), strict=True))


def remove_repeats(docs: DataFrame, span: int = SPAN, id_column: str = "doc_id", text_column: str = "text", block_bytes: int = ns.BLOCK_BYTES,
                   with_text: bool = False, hot: int = HOT) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 (and spans and the kept bytes); one row per row."""
    scratch = Scratch(docs.sparkSession, "repeats")
    blocks = shards = ns.block_count(docs, text_column, block_bytes)
    texts = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.coalesce(F.col(text_column).cast("binary"), F.lit(b"")).alias("text"))
    texts = texts.withColumn("sha", F.sha2("text", 256))
    named = scratch.put(texts.select("doc_id", "sha"), "names")
    firsts = named.groupBy("sha").agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    copies = scratch.put(named.join(firsts, "sha").where("doc_id <> first").select("doc_id", "sha", F.lit(1).alias("flag")).distinct(), "copies")
    rows = join_checked(texts, copies, ["doc_id", "sha"], "left").select("doc_id", "text", F.coalesce("flag", F.lit(0)).alias("flag"), F.lit(None).cast("string").alias("lang"))
    packed = ns.packed_blocks(rows, blocks)
    request_schema = pa.schema([("shard", pa.int32()), ("block", pa.int32()), ("keys", pa.binary()), ("counts", pa.binary())])
    reply_schema = pa.schema([("block", pa.int32()), ("shard", pa.int32()), ("found", pa.binary())])

    def ask(table: pa.Table) -> pa.Table:
        block = table.column("block")[0].as_py()
        hashes = [runs[0] for _, _, _, runs in _runs(_numbered(table), span)]
        keys, counts = ta.distinct_counts(ns.shard_keys(np.concatenate([np.zeros(0, np.uint64), *hashes]), shards))
        return ns.table_of(ns.requests(block, keys, counts, shards) or [{"shard": 0, "block": block, "keys": b"", "counts": ns.reply(np.zeros(0, np.uint32))}], request_schema)

    def answer(table: pa.Table) -> pa.Table:
        """Which of the asked keys occur more than once (1), and more than ``hot`` times (2)."""
        shard = table.column("shard")[0].as_py()
        keys = [ns.request_keys(k) for k in table.column("keys").to_pylist()]
        counts = [ns.request_counts(c) for c in table.column("counts").to_pylist()]
        _, at = ta.distinct_places(np.concatenate(keys))
        times = np.bincount(at, np.concatenate(counts)) if len(at) else np.zeros(0)
        many = (times > 1).astype(np.uint8) + (times > hot)
        parts = np.split(many[at].astype(np.uint8), np.cumsum([len(k) for k in keys])[:-1])
        return ns.table_of([{"block": b, "shard": shard, "found": ns.reply(p)} for b, p in zip(table.column("block").to_pylist(), parts, strict=True)], reply_schema)

    def judged(chunks: list[tuple], found: np.ndarray) -> list[np.ndarray]:
        """Per chunk what the shards say of the anchor of each run; ``found`` starts with their answers."""
        hashes = np.concatenate([np.zeros(0, np.uint64), *[c[3][0] for c in chunks]])
        _, at = ta.distinct_places(ns.shard_keys(hashes, shards))
        return np.split(found[at], np.cumsum([len(c[3][0]) for c in chunks])[:-1])

    def hot_windows(chunks: list[tuple], many: list[np.ndarray]) -> list[tuple]:
        """Per chunk the windows around hot anchors: where they start, their hashes and keys."""
        out = []
        for (_, data, _, (_, _, first, n)), m in zip(chunks, many, strict=True):
            at = _starts(first[m == 2], n[m == 2])
            hashes = _windows(data, at, span) if len(at) else np.zeros(0, np.uint64)
            out.append((at, hashes, ns.shard_keys(hashes, shards)))
        return out

    def ask_windows(left: pa.Table, right: pa.Table) -> pa.Table:
        """Windows around hot anchors, under shard numbers that follow those of the anchors."""
        found = ns.replies(right, np.uint8)
        if not left.num_rows or not (found == 2).any():
            return request_schema.empty_table()
        chunks = list(_runs(_numbered(left), span))
        keys, counts = ta.distinct_counts(np.concatenate([w[2] for w in hot_windows(chunks, judged(chunks, found))]))
        rows = ns.requests(left.column("block")[0].as_py(), keys, counts, shards)
        return ns.table_of([{**r, "shard": r["shard"] + shards} for r in rows], request_schema)

    def send(left: pa.Table, right: pa.Table) -> pa.Table:
        """Stretches around repeated anchors, each once; those that came before in the block are gone."""
        if not left.num_rows:
            return FOUND_SCHEMA.empty_table()
        block = left.column("block")[0].as_py()
        chunks = list(_runs(_numbered(left), span))
        found = ns.replies(right, np.uint8)
        many = judged(chunks, found)
        windows_of = hot_windows(chunks, many)
        _, window_at = ta.distinct_places(np.concatenate([np.zeros(0, np.uint64), *[w[2] for w in windows_of]]))
        again = found[len(found) - (window_at.max() + 1 if len(window_at) else 0) :][window_at] > 0
        seen: set[tuple] = set()
        out, done = [], 0
        for (held, data, bounds, (anchors, text, first, n)), m, (at, window_hashes, _) in zip(chunks, many, windows_of, strict=True):
            some = again[done : done + len(at)]
            done += len(at)
            at, window_hashes = at[some], window_hashes[some]
            if len(at):
                later = _later_equals(data, at, window_hashes, span)
                owner = np.searchsorted(bounds, at, side="right") - 1
                for i in np.flatnonzero(~later).tolist():
                    doc, a = int(owner[i]), int(at[i])
                    signed = int(window_hashes[i : i + 1].view(np.int64)[0])
                    place = int(window_hashes[i] >> np.uint64(33)) % (4 * shards)
                    out.append((0, place, signed, held[doc][0], held[doc][3], a - int(bounds[doc]), 1, data[a : a + span].tobytes()))
                at, owner = at[later], owner[later]
                new = np.ones(len(at), bool)
                new[1:] = (np.diff(at) != 1) | (np.diff(owner) != 0)
                begins = np.flatnonzero(new)
                for i, k in zip(begins.tolist(), np.diff(np.append(begins, len(at))).tolist(), strict=True):
                    doc = int(owner[i])
                    out.append((1, block, 0, held[doc][0], held[doc][3], int(at[i]) - int(bounds[doc]), k, None))
            for i in np.flatnonzero(m == 1).tolist():
                doc, a, windows = int(text[i]), int(first[i]), int(n[i])
                doc_id, row, start = held[doc][0], held[doc][3], a - int(bounds[doc])
                part = data[a : a + windows + span - 1].tobytes()
                key = (int(anchors[i]), part)
                if key in seen:
                    out.append((1, block, 0, doc_id, row, start, windows, None))
                else:
                    seen.add(key)
                    signed = int(anchors[i : i + 1].view(np.int64)[0])
                    out.append((0, int(anchors[i] >> np.uint64(33)) % (4 * shards), signed, doc_id, row, start, windows, part))
        return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), FOUND_SCHEMA, strict=True)], schema=FOUND_SCHEMA) if out else FOUND_SCHEMA.empty_table()

    def sort_shard(table: pa.Table) -> pa.Table:
        found = sorted(zip(*[table.column(c).to_pylist() for c in ("anchor", "bytes", "doc_id", "row", "start", "n")], strict=True))
        gone, distinct = [], []
        for i, (anchor, part, doc_id, row, start, n) in enumerate(found):
            if i and found[i - 1][:2] == (anchor, part):
                gone.append((doc_id, row, start, start + n + span - 1))
            else:
                distinct.append((anchor, part, doc_id, row, start, n))
        # An anchor with one stretch has no two equal windows but by hash collision of anchors in the stretch itself.
        shared = [d for i, d in enumerate(distinct) if i and distinct[i - 1][0] == d[0] or i + 1 < len(distinct) and distinct[i + 1][0] == d[0]]
        at = 0
        while at < len(shared):
            # Sort about eight megabytes at a time, whole anchors each.
            stop, size = at, 0
            while stop < len(shared) and (size < 8 << 20 or shared[stop][0] == shared[stop - 1][0]):
                size += len(shared[stop][1])
                stop += 1
            some = shared[at:stop]
            for which, offset in repeated_starts([s[1] for s in some], [s[5] for s in some], [s[2:5] for s in some], span):
                start = some[which][4] + offset
                gone.append((*some[which][2:4], start, start + span))
            at = stop
        # Neighbouring windows of one document are one run.
        gone.sort()
        merged: list[list[int]] = []
        for doc_id, row, start, stop in gone:
            if merged and merged[-1][:2] == [doc_id, row] and start <= merged[-1][3]:
                merged[-1][3] = max(stop, merged[-1][3])
            else:
                merged.append([doc_id, row, start, stop])
        columns = list(zip(*[[0, *m] for m in merged], strict=True)) if merged else [[], [], [], [], []]
        return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(columns, GONE_SCHEMA, strict=True)], schema=GONE_SCHEMA)

    asked = packed.groupBy("block").applyInArrow(ask, ns.REQUEST)
    answered = scratch.put(asked.groupBy("shard").applyInArrow(answer, ns.REPLY), "anchors")
    asked = packed.groupBy("block").cogroup(answered.groupBy("block")).applyInArrow(ask_windows, ns.REQUEST)
    answered = answered.union(asked.groupBy("shard").applyInArrow(answer, ns.REPLY))
    sent = scratch.put(packed.groupBy("block").cogroup(answered.groupBy("block")).applyInArrow(send, FOUND), "stretches")
    here = sent.where("kind = 1").select(F.col("place").alias("block"), "doc_id", "row", "start", (F.col("start") + F.col("n") + span - 1).alias("stop"))
    there = sent.where("kind = 0").groupBy("place").applyInArrow(sort_shard, GONE)
    block = F.pmod(F.xxhash64("doc_id"), F.lit(blocks)).cast("int")
    gone = scratch.put(here.union(there.withColumn("block", block)), "gone")
    scratch.drop(sent)
    fields = [("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string())]
    if with_text:
        fields += [("starts", pa.list_(pa.int64())), ("stops", pa.list_(pa.int64())), ("kept", pa.binary())]
    result_schema = pa.schema(fields)

    def finish(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows:
            return result_schema.empty_table()
        cuts: dict[tuple, list] = {}
        for doc_id, row, start, stop in zip(*[right.column(c).to_pylist() for c in ("doc_id", "row", "start", "stop")], strict=True):
            cuts.setdefault((doc_id, row), []).append((start, stop))
        out = []
        for doc_id, text, copy, number in _numbered(left):
            runs: list[list[int]] = []
            found = [(0, len(text))] if copy and len(text) >= span else [] if copy else sorted(cuts.get((doc_id, number), ()))
            for start, stop in found:
                if runs and start <= runs[-1][1]:
                    runs[-1][1] = max(stop, runs[-1][1])
                else:
                    runs.append([start, stop])
            edges = [0, *[e for r in runs for e in r], len(text)]
            kept = b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True))
            row = (doc_id, len(text), len(text) - len(kept), len(runs), hashlib.sha256(kept).hexdigest())
            out.append((*row, [r[0] for r in runs], [r[1] for r in runs], kept) if with_text else row)
        return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), result_schema, strict=True)], schema=result_schema)

    columns = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + (", starts array<long>, stops array<long>, kept binary" if with_text else "")
    return packed.groupBy("block").cogroup(gone.groupBy("block")).applyInArrow(finish, columns)
