"""Corpus operators against brute force on small tables with awkward rows."""

import hashlib
import itertools
import math
import random
import re
import tracemalloc
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pyarrow as pa
import pytest

import corpus_pipeline
from tidemark.llm import backoff, embeddings, exact_dedup, html_extract, kneser_ney, minhash, mixing, ngramshards, packing, queries, suffix_dedup, textarrays, toxicity

SF = "/root/testdata/sf0.001"
SPLIT = re.compile(r"[\x20\x09-\x0D]+")
BASE = "the quick brown fox jumps over the lazy dog and runs far away from all of the other animals in the wide green wood today"
TEXTS = [
    None, "", " ", "one", "One\t two", "one two", "one  two", BASE, BASE, BASE.upper(), BASE + " again", BASE.replace("fox", "cat"),
    "x " * 3000, " ".join(f"w{i % 977}" for i in range(20000)), " ".join(f"w{i % 977}" for i in range(20000)) + " tail",
    "a\x0bb\x0cc\r\nd", "ünï cödé 漢字 " * 30, "é" * 120, BASE + BASE + BASE, "tie tie tie tie tie tie",
]


def words(text, lower=True):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "") if lower else text or ""
    return [w for w in SPLIT.split(text) if w]


def roots(n, links):
    parent = {i: i for i in n}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {i: find(i) for i in n}


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, ["en", "de", None][i % 3], ["s1", "s2", None][i % 3], len(t or ""), "clash", i) for i, t in enumerate(TEXTS)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, h string, b long").repartition(3)


@pytest.fixture(scope="module")
def empty(docs):
    return docs.where("false")


def test_exact(docs, empty):
    norm = [SPLIT.sub(" ", t or "") for t in TEXTS]
    got = {r["doc_id"]: r for r in exact_dedup.exact_duplicates(docs, capacity=2).collect()}
    for i, t in enumerate(norm):
        r = got[i]
        assert (r["keep_id"], r["group_size"]) == (norm.index(t), norm.count(t))
        assert r["kept"] == (norm.index(t) == i) and r["text_sha256"] == hashlib.sha256(t.encode()).hexdigest()
    assert exact_dedup.exact_duplicates(empty).count() == 0


def test_exact_matches_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{SF}/documents.parquet')")
    expected = con.execute(queries.SQL["op3_exact"]).fetchall()
    assert sorted(expected) == sorted(tuple(r) for r in queries.op3_exact(spark, SF).collect())


def test_directory_splits_overfull_buckets(spark):
    keys = spark.range(5000).selectExpr("xxhash64(id) as h").cache()
    slots = exact_dedup.directory(keys, 100).collect()
    bits = slots[0]["bits"]
    filled = Counter()
    for r in keys.collect():
        slot = (r["h"] % (1 << 64)) >> (64 - bits)
        filled[next((s["depth"], s["bucket"]) for s in slots if s["slot"] == slot)] += 1
    assert max(filled.values()) <= 100 and sum(filled.values()) == 5000


def test_minhash(docs, empty):
    sets = {}
    for i, t in enumerate(TEXTS):
        w = words(t)
        sets[i] = {tuple(w[j : j + 5]) for j in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())
    links = [(a, b) for a, b in itertools.combinations(sets, 2)
             if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
    expected = roots(sets, links)
    got = {r["doc_id"]: r for r in minhash.near_duplicates(docs).collect()}
    assert {i: (r["n_shingles"], r["component_id"], r["kept"]) for i, r in got.items()} == {
        i: (len(sets[i]), expected[i], expected[i] == i) for i in sets}
    assert minhash.near_duplicates(empty).count() == 0


def test_few_texts_are_held_at_once(spark, docs):
    spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    for step in (minhash.near_duplicates, lambda d: packing.pack(d, queries.tokenizer_path()), lambda d: ngramshards.packed_blocks(
            d.selectExpr("doc_id", "cast(text as binary) text", "0 flag", "lang"), 1)):
        step(docs)
        assert int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) <= 1000
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    hasher = textarrays.WordHasher()
    hasher(np.frombuffer(b"word " * 10_000, np.uint8))
    assert len(hasher.up) < 1.5 * 50_000


def test_minhash_of_one_large_group(spark):
    """Copies with one word changed each, linked only through their original."""
    base = [f"b{i}" for i in range(100)]
    rows = [(0, " ".join(base))] + [(i, " ".join(base[: i % 90] + [f"new{i}", f"newer{i}"] + base[i % 90 + 2 :])) for i in range(1, 400)]
    got = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))
    assert [tuple(r) for r in got.groupBy("component_id").count().collect()] == [(0, 400)]


def test_vectors(spark):
    rng = np.random.default_rng(0)
    base = rng.normal(size=(40, 16))
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(np.vstack([base, base[:10] + rng.normal(size=(10, 16)) * 0.1, base[:5]]))]
    bad = [None, [], [0.0] * 16, [math.nan] * 16, [math.inf] + [1.0] * 15, [None] + [1.0] * 15, [1.0, 0.0], [2.0, 0.0]]
    rows += [(100 + i, v) for i, v in enumerate(bad)]
    frame = spark.createDataFrame([(i, v, 1, "x") for i, v in rows], "vec_id long, embedding array<double>, label int, component string")
    usable = {i: np.array(v) for i, v in rows if v and all(x is not None and math.isfinite(x) for x in v) and any(v)}
    links = [(a, b) for a, b in itertools.combinations(usable, 2) if len(usable[a]) == len(usable[b])
             and usable[a] @ usable[b] >= 0.9 * np.linalg.norm(usable[a]) * np.linalg.norm(usable[b])]
    expected, degree = roots(dict(rows), links), Counter(i for p in links for i in p)
    got = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in embeddings.near_vectors(frame).collect()}
    assert got == {i: (degree[i], expected[i], expected[i] == i) for i in dict(rows)}
    assert embeddings.near_vectors(frame.where("false")).count() == 0


def test_backoff(docs, empty):
    all_words = {i: words(t) for i, t in enumerate(TEXTS)}
    own = {i: Counter(tuple(w[j : j + n]) for n in (1, 2, 3) for j in range(len(w) - n + 1)) for i, w in all_words.items()}
    total, size = sum(own.values(), Counter()), sum(map(len, all_words.values()))
    got = {r["doc_id"]: r for r in backoff.scores(docs, block_bytes=40_000).collect()}
    for i, w in all_words.items():
        expected = 0.0
        for j in range(len(w)):
            gram, factor = tuple(w[max(0, j - 2) : j + 1]), 1.0
            count = lambda g: total[g] - own[i][g]
            while len(gram) > 1 and not count(gram):
                gram, factor = gram[1:], factor * 0.4
            if len(gram) > 1:
                expected += math.log(factor * count(gram) / count(gram[:-1]))
            else:
                expected += math.log(factor * (count(gram) / (size - len(w)) if count(gram) else 0.4 / (size - len(w) + 1)))
        assert got[i]["n_words"] == len(w) and got[i]["log_score"] == pytest.approx(expected)
        assert (got[i]["mean_log_score"] is None) == (not w)
    assert backoff.scores(empty).count() == 0


def test_kneser_ney(spark, docs, empty):
    """Perplexities of the table form equal a plain recursive one."""
    labels = spark.createDataFrame([(i, 1 if i in (3, 7, 10, 11, 16) else 0, 0) for i in range(18)], "doc_id long, quality int, toxic int")
    order, types = 3, defaultdict(Counter)
    for i in (3, 7, 10, 11, 16):
        for w in words(TEXTS[i], lower=False):
            s = "\1" + w + "\2"
            for j in range(len(s)):
                for k in range(1, min(order, j + 1) + 1):
                    if j > 0:
                        types[k][s[j - k + 1 : j + 1]] += 1
    counts = {}
    for k in range(1, order + 1):
        left = Counter(g[1:] for g in types[k + 1])
        counts[k] = {g: n if k == order or g[0] == "\1" else left.get(g, n) for g, n in types[k].items()}
    discounts = {}
    for k, c in counts.items():
        t = [0, *[sum(v == i for v in c.values()) for i in (1, 2, 3, 4)]]
        y = t[1] / max(1, t[1] + 2 * t[2])
        discounts[k] = [max(0.0, min(float(i), i - (i + 1) * y * t[i + 1] / t[i] if t[i] else 0.5 * i)) for i in (1, 2, 3)]
    size = sum(len(c) for c in counts.values()) + sum(len({g[:-1] for g in c}) for c in counts.values())

    def probability(gram):
        p = 1 / size
        for k in range(1, len(gram) + 1):
            g = gram[-k:]
            same = {x: n for x, n in counts[k].items() if x[:-1] == g[:-1]}
            if same:
                d = lambda n: discounts[k][min(n, 3) - 1]  # noqa: B023, E731
                total = sum(same.values())
                p = ((same[g] - d(same[g])) / total if g in same else 0) + sum(map(d, same.values())) / total * p
        return p

    got = {r["doc_id"]: r for r in kneser_ney.quality(docs, labels, order=order, block_bytes=2_000).collect()}
    assert len(got) == len(TEXTS)
    for i in (3, 4, 7, 10, 15, 16, 19):
        logs = [math.log(probability(s[max(0, j - order + 1) : j + 1])) for w in words(TEXTS[i], lower=False)
                for s in ["\1" + w + "\2"] for j in range(1, len(s))]
        assert got[i]["perplexity"] == pytest.approx(math.exp(-sum(logs) / len(logs)))
    assert got[0]["perplexity"] is None and got[0]["kept"]
    assert kneser_ney.quality(empty, labels).count() == 0
    assert all(r["kept"] for r in kneser_ney.quality(docs, labels.where("false")).collect())


def test_running_text_tells_first_words_from_others():
    """A word that begins one document and stands inside another has other n-grams there."""
    texts = [b"houses stand", b"the houses stand", b"stand houses houses", b"houses"]
    for docs in (list(enumerate(texts)), list(enumerate(texts[::-1]))):
        expected = Counter(s[max(0, j - 4) : j + 1] for _, t in docs for s in ["\n" + t.decode() + "\r"] for j in range(1, len(s)))
        for part_bytes in (1, 1 << 20):
            some, grams = next((some, grams) for some, grams in kneser_ney.by_model(docs, 5, part_bytes) if grams.kind == kneser_ney.TEXT)
            names = ["".join(chr(c[i]) for c in grams.codes[: grams.reach[i]][::-1]) for i in range(len(grams.top))]
            got = Counter()
            for layer, number in zip(some, grams.number, strict=True):
                uses = np.bincount(layer.tokens, minlength=layer.units)[layer.unit]
                for i, n in zip(number[layer.number].tolist(), uses.tolist(), strict=True):
                    got[names[i]] += n
            assert got == expected


def test_pipeline_counts_quality_in_little_memory():
    """After all stages an executor of 3000 MB has some 150 MB left for each task's arrays; blocks of 10 MB took 400."""
    sizes = corpus_pipeline.QUALITY_SIZES
    rng = random.Random(4)
    known = ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=rng.randint(2, 9))) for _ in range(3000)]
    text = " ".join(rng.choices(known, k=sizes["block_bytes"] // 4)).encode()
    docs = [(i, text[at : at + 4_000]) for i, at in enumerate(range(0, sizes["block_bytes"], 4_000))]
    tracemalloc.start()
    kneser_ney.by_model(docs, 5, sizes["part_bytes"])
    used = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert used < 110e6


def test_requests_and_replies_of_shards_are_small():
    rng = np.random.default_rng(3)
    for n in (1, 2, 7000):
        keys = np.unique(rng.integers(0, 1 << 40, n, dtype=np.uint64))
        packed = ngramshards.packed_keys(keys | np.uint64(9 << 40))
        assert np.array_equal(ngramshards.unpacked_keys(packed), keys)
        values = np.where(rng.random((2, n)) < 0.5, np.float32("nan"), -rng.integers(0, 9, (2, n)).astype(np.float32))
        replied = ngramshards.packed_floats(values)
        assert ngramshards.unpacked_floats(replied).reshape(2, n).tobytes() == values.tobytes()
    # A key took 5 bytes, a reply half a byte more than a number.
    assert len(packed) < 3.8 * n and len(replied) < len(ngramshards.reply(values.T.copy()))
    assert np.isnan(ngramshards.unpacked_floats(ngramshards.packed_floats(np.full((2, 3), np.nan, np.float32)))).all()


def test_equal_ngrams_have_one_number():
    texts = ["ab ab\x00 b", "", "a", "日本 語 日本 \U0001f600", "ab b ab", "\ufffd a"]
    docs = [(i, t.encode(), 1, "en") for i, t in enumerate(texts)]
    for order in (2, 3, 5):
        for some, grams in kneser_ney.by_model(docs, order):
            for layer, number in zip(some, grams.number, strict=True):
                for i in range(order):
                    assert np.array_equal(grams.codes[i][number], layer.codes[i])
                written = list(zip(*[c.tolist() for c in layer.codes], strict=True))
                assert len(set(written)) == len(written)
                assert all((c != 0).sum() == (layer.reach > i).sum() for i, c in enumerate(layer.codes))


def test_ngrams_of_each_order_are_asked_once():
    """The ends of longer n-grams were asked once for each longer n-gram."""
    texts = ["houses stand", "the houses  stand\tthere", "\x01a \x00b", "", "日本 語 houses"]
    docs = [(i, t.encode(), 0, None) for i, t in enumerate(texts)]
    for order, part_bytes in itertools.product((2, 5), (1, 1 << 20)):
        for _, grams in kneser_ney.by_model(docs, order, part_bytes):
            names = [tuple(int(c[i]) for c in grams.codes[: grams.reach[i]]) for i in range(len(grams.top))]
            levels, below = grams.levels(), []
            assert sorted(np.concatenate([level.longest for level in levels]).tolist()) == list(range(len(names)))
            for k, level in enumerate(levels, 1):
                known = {int(kneser_ney.key([np.array([c]) for c in g], k, grams.kind)[0]): g for g in {n[:k] for n in names if len(n) >= k}}
                found = [known[h] for h in level.keys.tolist()]
                assert len(found) == len(set(found)) == len(known)
                before = [int(kneser_ney.key([np.array([c]) for c in g[1:]], k - 1, grams.kind)[0]) if k > 1 else int(kneser_ney.empty_key(grams.kind)[0]) for g in found]
                assert level.contexts.tolist() == before
                assert all(found[e] == names[at] for at, e in zip(level.longest.tolist(), level.ends.tolist(), strict=True))
                assert k == 1 or [below[i] for i in level.shorter.tolist()] == [g[:-1] for g in found]
                below = found


def test_trusted_counts_leave_in_small_batches():
    """An executor kept the memory that one batch of a whole block took."""
    rng = random.Random(5)
    text = " ".join("".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=6)) for _ in range(20_000)).encode()
    batches = list(kneser_ney._counted(5, 1 << 20)(iter([pa.RecordBatch.from_pydict({"doc_id": [1], "text": [text]})])))
    assert max(b.num_rows for b in batches) <= 20_000
    rows = Counter()
    for b in batches:
        for kind, gram, n in zip(*[b.column(c).to_pylist() for c in ("kind", "gram", "n")], strict=True):
            assert (kind, gram) not in rows
            rows[kind, gram] = n
    whole = "\n" + text.decode() + "\r"
    expected = Counter((kneser_ney.TEXT, whole[max(0, j - 4) : j + 1]) for j in range(1, len(whole)))
    for w in text.decode().split():
        expected.update((kneser_ney.WORDS, f"\n{w}\r"[max(0, j - 4) : j + 1]) for j in range(1, len(w) + 2))
    assert rows == expected


def test_quality_reads_running_text(spark):
    """A repeated word and words out of order are made of normal words; only n-grams across blanks see them."""
    rng = random.Random(3)
    names, verbs, ends = ["anna", "bert", "carl", "dora"], ["sees", "hears", "finds"], ["houses.", "rivers.", "trees."]
    prose = lambda n: " ".join(w for _ in range(n) for w in (rng.choice(names), rng.choice(verbs), rng.choice(ends)))
    good = [(i, prose(60), "en") for i in range(60)]
    salad = prose(60).split()
    rng.shuffle(salad)
    other = [(100, "anna " * 180, "en"), (101, "houses. " * 180, "en"), (102, " ".join(salad), "en"), (103, prose(60), "en")]
    labels = spark.createDataFrame([(i, 1, 0) for i in range(60)], "doc_id long, quality int, toxic int")
    for block_bytes in (1 << 20, 5_000):
        got = kneser_ney.quality(spark.createDataFrame(good + other, "doc_id long, text string, lang string"), labels, block_bytes=block_bytes)
        rows = {r["doc_id"]: r for r in got.collect()}
        assert [rows[i]["kept"] for i in (100, 101, 102, 103)] == [False, False, False, True]
        assert sum(rows[i]["kept"] for i in range(60)) >= 58
    # Fewer shards than blocks, and blocks read in small parts, change nothing.
    small = kneser_ney.quality(spark.createDataFrame(good + other, "doc_id long, text string, lang string"), labels, block_bytes=5_000, shard_bytes=20_000, part_bytes=1_000)
    for r in small.collect():
        assert r["kept"] == rows[r["doc_id"]]["kept"] and r["text_perplexity"] == pytest.approx(rows[r["doc_id"]]["text_perplexity"], rel=1e-9)
    # Each trusted document is held out: a text that only it has does not lower the limit.
    lone = [(200, "zyxw vuts " * 40, "en")]
    more = spark.createDataFrame([(i, 1, 0) for i in [*range(60), 200]], "doc_id long, quality int, toxic int")
    row = kneser_ney.quality(spark.createDataFrame(good + lone, "doc_id long, text string, lang string"), more).where("doc_id = 200").first()
    assert row["text_threshold"] > 10 * row["text_perplexity"]


@pytest.mark.parametrize("seed", range(4))
def test_suffix_array(seed):
    rng = np.random.default_rng(seed)
    for _ in range(20):
        text = rng.integers(97, 97 + rng.integers(1, 5), rng.integers(0, 150)).astype(np.uint8)
        plain = text.tobytes()
        assert list(suffix_dedup.induced_suffix_array(text, 1000)) == sorted(range(len(plain)), key=lambda i: plain[i:])


def test_anchors_are_hashed_in_small_parts(monkeypatch):
    rng = random.Random(5)
    texts = [(i, bytes(rng.choice(b"ab") for _ in range(rng.choice([0, 99, 100, 101, 300, 900]))), 0, 0) for i in range(200)]
    find, sizes = suffix_dedup.Anchors.__call__, []

    def sized(self, data, bounds):
        sizes.append(len(data))
        return find(self, data, bounds)

    monkeypatch.setattr(suffix_dedup.Anchors, "__call__", sized)
    ((_, data, bounds, whole),) = suffix_dedup._runs(texts, 100)
    monkeypatch.setattr(suffix_dedup, "PART_BYTES", 2000)
    sizes.clear()
    ((*_, parted),) = suffix_dedup._runs(texts, 100)
    assert max(sizes) <= 2000 + 901 and sum(sizes) == len(data)
    assert all(np.array_equal(a, b) for a, b in zip(whole, parted, strict=True))
    # Every window is in one run, and runs stay inside their text.
    _, text, first, n = parted
    starts = [s for a, k in zip(first.tolist(), n.tolist(), strict=True) for s in range(a, a + k)]
    assert starts == [b + j for b, (_, t, _, _) in zip(bounds.tolist(), texts, strict=False) for j in range(len(t) - 99)]
    assert all(bounds[t] <= a for t, a in zip(text.tolist(), first.tolist(), strict=True))


@pytest.mark.parametrize("n", [0, 1, 2, 700])
def test_distinct_numbers(n):
    x = np.random.default_rng(n).integers(0, 200, n, dtype=np.uint64)
    values, at, counts = np.unique(x, return_inverse=True, return_counts=True)
    assert np.array_equal(textarrays.distinct_sorted(x), values)
    assert all(np.array_equal(a, b) for a, b in zip(textarrays.distinct_counts(x), (values, counts), strict=True))
    assert all(np.array_equal(a, b) for a, b in zip(textarrays.distinct_places(x), (values, at), strict=True))


def test_suffix_removal(docs, empty):
    seen, got = set(), {r["doc_id"]: r for r in suffix_dedup.remove_repeats(docs, block_bytes=40_000, with_text=True).collect()}
    for i, t in enumerate(TEXTS):
        data = (t or "").encode()
        gone = bytearray(len(data))
        for j in range(len(data) - 99):
            if data[j : j + 100] in seen:
                gone[j : j + 100] = b"\1" * 100
            seen.add(data[j : j + 100])
        kept = bytes(c for c, g in zip(data, gone, strict=True) if not g)
        spans = len(re.findall(b"\1+", bytes(gone)))
        r = got[i]
        assert (r["n_bytes"], r["n_removed"], r["n_spans"], bytes(r["kept"])) == (len(data), sum(gone), spans, kept)
        assert r["kept_sha256"] == hashlib.sha256(kept).hexdigest()
    assert suffix_dedup.remove_repeats(empty).count() == 0


def test_suffix_removal_around_a_hot_anchor(spark):
    """A phrase with other text about it each time is split by its windows, with the results of one sort."""
    rng = random.Random(7)
    text = lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n))
    phrase, both = text(60), text(70)
    rows = [(i, text(rng.randrange(80, 120)) + phrase + text(rng.randrange(80, 120))) for i in range(60)]
    rows += [(100 + i, text(30) + both + phrase + both + text(30)) for i in range(4)] + [(200, text(20) + (phrase + both) * 4), (201, rows[3][1] + "x")]
    docs, span = spark.createDataFrame(rows, "doc_id long, text string"), 100
    seen, expected = set(), {}
    for doc_id, t in rows:
        gone = set()
        for i in range(len(t) - span + 1):
            if t[i : i + span] in seen:
                gone.update(range(i, i + span))
            seen.add(t[i : i + span])
        expected[doc_id] = "".join(c for i, c in enumerate(t) if i not in gone)
    for block_bytes, hot in ((1 << 20, 5), (3_000, 5), (3_000, 1 << 30)):
        got = suffix_dedup.remove_repeats(docs, block_bytes=block_bytes, with_text=True, hot=hot)
        assert {r["doc_id"]: bytes(r["kept"]).decode() for r in got.collect()} == expected
    data = np.frombuffer(rows[0][1].encode(), np.uint8)
    at = suffix_dedup._starts(np.array([2, 50]), np.array([3, 2]))
    assert at.tolist() == [2, 3, 4, 50, 51] and not suffix_dedup._later_equals(data, at, suffix_dedup._windows(data, at, span), span).any()


def test_suffix_removal_of_repeated_ids(spark):
    """Rows of one id are documents of their own: of equal rows one stays, and cuts of one text stay out of the other."""
    rng = random.Random(5)
    text = lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n))
    one, two, long, shared = text(300), text(400), text(500), text(150)
    a, b = "A" + text(50) + shared, "B" + text(250)
    rows = [(1, one), (1, one), (2, two), (2, long), (3, two), (3, a), (4, b), (4, shared + text(40)), (5, "short"), (5, "short")]
    for block_bytes in (1 << 20, 500):
        got = suffix_dedup.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string"), block_bytes=block_bytes, with_text=True)
        kept = sorted((r["doc_id"], r["n_bytes"], bytes(r["kept"]).decode()) for r in got.collect())
        assert kept == sorted([
            (1, 300, one), (1, 300, ""), (2, 400, two), (2, 500, long), (3, 400, ""), (3, len(a), a), (4, len(b), b),
            (4, 190, rows[7][1][150:]), (5, 5, "short"), (5, 5, "short"),
        ])


def test_mixing(spark, docs, empty):
    rows = [r.asDict() for r in mixing.mix(docs).collect()]
    assert len(rows) == len(TEXTS)
    assert {r["doc_id"]: r["size"] for r in rows} == {i: len(words(t)) for i, t in enumerate(TEXTS)}
    assert all(0 <= r["taken"] <= 3 * r["size"] and r["taken"] == r["copies"] * r["size"] for r in rows)
    assert rows and sorted(r["doc_id"] for r in rows) == list(range(len(TEXTS)))
    assert mixing.mix(empty).count() == 0
    many = spark.range(3000).selectExpr("id as doc_id", "repeat('w ', cast(1 + pmod(xxhash64(id), 40) as int)) as text", "concat('s', id % 5) as source")
    first, again = (sorted((r["doc_id"], r["taken"], r["source"], r["target"]) for r in mixing.mix(many).collect()) for _ in range(2))
    assert first == again
    for _, group in itertools.groupby(sorted(first, key=lambda r: r[2]), key=lambda r: r[2]):
        group = list(group)
        assert sum(r[1] for r in group) == pytest.approx(group[0][3], rel=0.002)


def test_targets(spark):
    """Against pouring out the rest again and again."""
    sizes = {"a": 10, "b": 1000, "c": 5, None: 300, "d": 0}
    frame = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    names = [*sorted(k for k in sizes if k), None]
    weight = {k: i % 3 + 1 for i, k in enumerate(names)}
    target, open_, rest = dict.fromkeys(sizes, 0.0), set(sizes), float(sum(sizes.values()))
    while rest > 1e-9 and open_:
        share, given = sum(weight[k] for k in open_), rest
        for k in list(open_):
            target[k] += given * weight[k] / share
        rest = sum(max(0.0, target[k] - 3 * sizes[k]) for k in open_)
        for k in list(open_):
            if target[k] >= 3 * sizes[k]:
                target[k] = 3.0 * sizes[k]
                open_.discard(k)
    assert {r["source"]: r["target"] for r in mixing.targets(frame).collect()} == pytest.approx(target)


def test_packing(docs, empty):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(queries.tokenizer_path())
    rows = [r.asDict() for r in packing.pack(docs, queries.tokenizer_path()).collect()]
    for i, t in enumerate(TEXTS):
        ids = np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, packing.END_ID], "<u4")
        pieces = sorted((r for r in rows if r["doc_id"] == i), key=lambda r: r["start"])
        assert [r["start"] for r in pieces] == [0, *np.cumsum([r["length"] for r in pieces])[:-1]]
        assert sum(r["length"] for r in pieces) == len(ids) == pieces[0]["doc_tokens"]
        assert all(r["ids_crc32"] == zlib.crc32(ids[r["start"] : r["start"] + r["length"]].tobytes()) for r in pieces)
    for _, group in itertools.groupby(sorted(rows, key=lambda r: (r["sequence_id"], r["offset"])), key=lambda r: r["sequence_id"]):
        at = 0
        for r in group:
            assert r["offset"] == at
            at += r["length"]
        assert at <= packing.LENGTH
    assert {r["sequence_id"] for r in rows} == set(range(1 + max(r["sequence_id"] for r in rows)))
    assert packing.pack(empty, queries.tokenizer_path()).count() == 0


def test_patterns_place_every_length():
    histogram = {2047: 3, 1500: 10, 700: 4, 548: 20, 100: 7, 1: 5}
    patterns = packing.shortest_pack_first(histogram, 2048)
    placed = Counter()
    for lengths, n in patterns:
        assert sum(lengths) <= 2048
        placed.update({s: lengths.count(s) * n for s in set(lengths)})
    assert placed == histogram


PAGE = """<html><head><title>t</title></head><body><header class="site">top</header><div class="cookie-notice">We use</div><nav>m</nav>
<main><article><header><h1>A &amp; B</h1></header><p>one<b>two</b>  x<br>y<p>three &lt;tag&gt;<ul><li>l1<li>l2</ul><aside>side</aside>
<div class="ad">buy</div><form>f</form><script>var t="</p>";</script><!-- no > --><section class="comments"><p>c</p></section></article></main>
<footer>f</footer><scr"""


def test_html(spark):
    texts = {1: "A & B\n\nonetwo x y\n\nthree <tag>\n\nl1\n\nl2", 2: "", 3: "", 4: "plain text", 5: "body words"}
    pages = [(1, "http://a.example/x", PAGE), (2, "http://a.example/y", None), (3, None, ""), (4, "", "plain text"),
             (5, "nonsense", '<div id="sidebar">x</div><p>body words</p>')]
    frame = spark.createDataFrame([(*p, "clash") for p in pages], "page_id long, url string, html string, host string")
    got = {r["page_id"]: r for r in html_extract.extract(frame).collect()}
    assert {i: r["text"] for i, r in got.items()} == texts
    assert all(r["n_chars"] == len(r["text"]) for r in got.values())
    assert html_extract.extract(frame.where("false")).count() == 0


def test_html_template_of_a_host(spark):
    """What every page of a host repeats in one place is template, whatever its tags are called."""
    pages = [(i, "http://a.example/", f"<body><div class='q'>Always the same line</div><div class='z'><p>Text number {i} of it</p></div></body>") for i in range(40)]
    frame = spark.createDataFrame(pages, "page_id long, url string, html string")
    assert all(r["text"] == f"Text number {r['page_id']} of it" for r in html_extract.extract(frame).collect())


def test_toxicity(spark):
    rng = np.random.default_rng(5)
    rows, labels = [], []
    for i in range(600):
        toxic = int(rng.random() < 0.3)
        plain = " ".join(f"word{rng.integers(50)}" for _ in range(30))
        named = " women" if rng.random() < (0.8 if toxic else 0.2) else " men"
        rows.append((i, plain + named + (" horrid fool" if toxic else "")))
        labels.append((i, 1, toxic))
    docs = spark.createDataFrame([*rows, (1000, None), (1001, ""), (1002, "all the women met"), (1003, "all the men met")], "doc_id long, text string")
    given = spark.createDataFrame([*labels, (None, 1, 1), (5000, 1, 1), (3, 1, None)], "doc_id long, quality int, toxic int")
    got = {r["doc_id"]: r for r in toxicity.toxicity(docs, given).collect()}
    assert len(got) == 604
    assert all(r["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0) and r["predicted"] == int(r["score"] >= 0.5) for i, r in got.items())
    held = [i for i in range(600) if got[i]["held_out"]]
    assert np.mean([got[i]["predicted"] == labels[i][2] for i in held]) > 0.97
    # The name of a group alone hardly moves the score, though it goes with the label here.
    assert abs(got[1002]["score"] - got[1003]["score"]) < 0.05
    assert toxicity.toxicity(docs.where("false"), given).count() == 0
    assert all(r["score"] < 1e-9 for r in toxicity.toxicity(docs, given.where("false")).collect())


def test_held_out_accuracy(spark):
    docs, labels = (queries.table(spark, "/root/testdata/sf0.01", n) for n in ("documents", "labels"))
    rows = toxicity.toxicity(docs, labels).where("held_out").join(labels, "doc_id").collect()
    assert np.mean([r["predicted"] == r["toxic"] for r in rows]) > 0.9


def test_pipeline(spark):
    import corpus_pipeline

    columns = queries.table(spark, SF, "documents").columns
    frame = queries.table(spark, SF, "documents")
    sizes = [frame.count()]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        frame = stage(spark, frame, SF)
        assert frame.columns == columns
        sizes.append(frame.count())
    assert sizes[0] > sizes[1] > sizes[2] >= sizes[3] > 0
    texts = {r["text"] for r in frame.collect()}
    out = corpus_pipeline.run(spark, SF).collect()
    assert out and len({SPLIT.sub(" ", t) for t in texts}) == len(texts)
