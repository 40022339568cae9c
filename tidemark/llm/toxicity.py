"""Counterfactual-regularised toxicity classifier.

A logistic model over words and word beginnings. Every labelled text that names
a group is also read with the name swapped for another of the same kind, and the
model pays for the squared change of its score between the two readings: what
it learns can then not rest on which group is named. Penalised Newton steps fit
it; the features are those that differ most between the two labels.

It is fitted on at most ``max_rows`` labelled rows (the smallest by a hash of
their id), never on held-out rows (``crc32`` of the id as text divisible by 5).
Scoring reads every whole text. Null and empty texts, and texts without letters,
get the score of a text without features. A label of a repeated id counts once
per row, null labels are left out; without both labels every score is the share
of label 1 (0 if there is none). Extra columns are not read.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import Scratch, arrow_chunks, arrow_rows, join_checked

MAX_ROWS = 12_000
FEATURES = 512
# Names of groups by kind; a name is swapped for the next of its kind.
IDENTITY_TERMS = (
    ("women", "men"), ("woman", "man"), ("female", "male"), ("girl", "boy"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist"),
    ("black", "white", "asian", "latino"), ("gay", "lesbian", "straight", "transgender"),
    ("african", "american", "european", "mexican", "chinese", "arab"),
    ("young", "old"), ("disabled", "blind", "deaf"), ("immigrant", "native"),
)
SWAPS = {a: kind[(i + 1) % len(kind)] for kind in IDENTITY_TERMS for i, a in enumerate(kind)}
KEPT_WORDS = 500_000


def held_out(doc_id: Column) -> Column:
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(5)) == 0


def word_of(token: bytes) -> str:
    """A token in lower case without what surrounds its letters and digits."""
    return re.sub(r"^\W+|\W+$", "", token.decode("utf-8", "replace").lower())


def features_of(word: str) -> list[str]:
    """The word and its beginnings of four to nine characters."""
    return [f"={word}", *[f"^{word[:n]}" for n in range(4, min(9, len(word)) + 1)]] if word else []


def _training_rows(docs: DataFrame, labels: DataFrame, max_rows: int, scratch: Scratch, id_column: str, text_column: str) -> DataFrame:
    known = labels.select(F.col("doc_id").alias("_id"), F.col("toxic").cast("int").alias("toxic")).where(
        F.col("toxic").isin(0, 1) & F.col("_id").isNotNull() & ~held_out(F.col("_id"))
    )
    chosen = scratch.put(known.orderBy(F.xxhash64("_id"), "_id", "toxic").limit(max_rows), "labelled")
    texts = docs.select(F.col(id_column).alias("_id"), F.col(text_column).cast("binary").alias("text"))
    return scratch.put(join_checked(texts, chosen, "_id").select("text", "toxic"), "training")


def _frequencies(rows: DataFrame) -> DataFrame:
    """(feature, n0, n1): texts of either label that have a feature, summed per task first."""
    import pyarrow as pa

    schema = pa.schema([("feature", pa.string()), ("n0", pa.int64()), ("n1", pa.int64())])

    def count(batches: Iterator) -> Iterator:
        def flushed(seen):
            return [(f, seen[0][f], seen[1][f]) for f in seen[0].keys() | seen[1].keys()]

        def rows_():
            seen = (Counter(), Counter())
            for text, toxic in arrow_rows(batches, ["text", "toxic"]):
                words = {word_of(t) for t in set((text or b"").split())}
                seen[toxic].update({f for w in words for f in features_of(w)})
                if len(seen[0]) + len(seen[1]) > 1_000_000:
                    yield from flushed(seen)
                    seen = (Counter(), Counter())
            yield from flushed(seen)

        yield from arrow_chunks(rows_(), schema, 20_000)

    parts = rows.mapInArrow(count, "feature string, n0 long, n1 long")
    return parts.groupBy("feature").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))


def _counts(text: bytes, index: dict[str, int]) -> tuple[dict[int, int], dict[int, int]]:
    """Feature counts of a text, and of its swapped reading."""
    plain, swapped = Counter(), Counter()
    for token, n in Counter(text.split()).items():
        word = word_of(token)
        for counts, w in ((plain, word), (swapped, SWAPS.get(word, word))):
            for f in features_of(w):
                if f in index:
                    counts[index[f]] += n
    return plain, swapped


def fit_logistic(x, y, changed, penalty: float = 1.0, swap_penalty: float = 10.0, steps: int = 40):
    """Weights (the last one is the constant) by damped Newton steps.

    The loss is log loss + penalty * |w|^2 / 2 + swap_penalty * sum((changed @ w)^2) / 2.
    """
    import numpy as np

    x1 = np.hstack([x, np.ones((len(x), 1))])
    ridge = np.eye(x1.shape[1]) * penalty
    ridge[-1, -1] = 1e-6
    if len(changed):
        c1 = np.hstack([changed, np.zeros((len(changed), 1))])
        ridge = ridge + swap_penalty * c1.T @ c1
    w = np.zeros(x1.shape[1])
    loss = lambda v: np.logaddexp(0, -(2 * y - 1) * (x1 @ v)).sum() + v @ ridge @ v / 2
    now = loss(w)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x1 @ w, -40, 40)))
        step = np.linalg.solve((x1 * (p * (1 - p) + 1e-9)[:, None]).T @ x1 + ridge, x1.T @ (p - y) + ridge @ w)
        size = 1.0
        while size > 1e-4 and loss(w - size * step) > now:
            size /= 2
        w = w - size * step
        before, now = now, loss(w)
        if before - now < 1e-6 * (1 + abs(now)):
            break
    return w


def train(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS, n_features: int = FEATURES,
          id_column: str = "doc_id", text_column: str = "text") -> tuple[dict[str, float], float]:
    """Weight of each feature and the constant. The driver sees ``n_features`` counts of ``max_rows`` texts at most."""
    import numpy as np
    import pyarrow as pa

    scratch = Scratch(docs.sparkSession, "toxicity")
    rows = _training_rows(docs, labels, max_rows, scratch, id_column, text_column)
    totals = {r["toxic"]: r["n"] for r in rows.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    n0, n1 = totals.get(0, 0), totals.get(1, 0)
    if not n0 or not n1:
        share = n1 / max(1, n0 + n1)
        return {}, 40.0 if share == 1 else -40.0
    p0, p1 = (F.col("n0") + 0.5) / (n0 + 1), (F.col("n1") + 0.5) / (n1 + 1)
    spread = F.abs(p1 - p0) / F.sqrt((F.col("n0") + F.col("n1") + 1.0) / (n0 + n1 + 2))
    frequent = _frequencies(rows).where("n0 + n1 >= 3")
    best = frequent.orderBy(spread.desc(), "feature").limit(n_features).collect()
    index = {r["feature"]: i for i, r in enumerate(sorted(best, key=lambda r: r["feature"]))}
    swapped = {f for w in SWAPS for f in features_of(w)} & index.keys()
    schema = pa.schema([("toxic", pa.int32()), ("at", pa.list_(pa.int32())), ("n", pa.list_(pa.int32())), ("swap", pa.list_(pa.int32())), ("swap_n", pa.list_(pa.int32()))])

    def sparse(batches: Iterator) -> Iterator:
        def out():
            for text, toxic in arrow_rows(batches, ["text", "toxic"]):
                a, b = _counts(text or b"", index)
                b = b if swapped and a != b else {}
                yield toxic, list(a), list(a.values()), list(b), list(b.values())

        yield from arrow_chunks(out(), schema)

    got = rows.mapInArrow(sparse, "toxic int, at array<int>, n array<int>, swap array<int>, swap_n array<int>").collect()
    x, z = np.zeros((len(got), len(index))), np.zeros((len(got), len(index)))
    for i, r in enumerate(got):
        x[i, r["at"]] = np.log1p(r["n"])
        z[i, r["swap"]] = np.log1p(r["swap_n"])
    changed = np.array([bool(r["swap"]) for r in got])
    w = fit_logistic(x, np.array([r["toxic"] for r in got], float), (x - z)[changed])
    scratch.drop(rows)
    return {f: float(w[i]) for f, i in index.items()}, float(w[-1])


def score(docs: DataFrame, model: tuple[dict[str, float], float], id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """doc_id, score: the probability of label 1 for every whole text."""
    import pyarrow as pa

    weights, constant = model
    index = {f: i for i, f in enumerate(sorted(weights))}
    by_index = [weights[f] for f in sorted(weights)]
    schema = pa.schema([("doc_id", pa.int64()), ("score", pa.float64())])

    def run(batches: Iterator) -> Iterator:
        known: dict[bytes, tuple[int, ...]] = {}

        def scored():
            for doc_id, text in arrow_rows(batches, ["doc_id", "text"]):
                tokens = (text or b"").split()
                if len(known) > KEPT_WORDS:
                    known.clear()
                for t in {t for t in tokens if t not in known}:
                    known[t] = tuple(index[f] for f in features_of(word_of(t)) if f in index)
                counts = Counter(i for hit in filter(None, map(known.__getitem__, tokens)) for i in hit)
                s = constant + sum(by_index[i] * math.log1p(n) for i, n in sorted(counts.items()))
                yield doc_id, 1 / (1 + math.exp(-max(-40.0, min(40.0, s))))

        yield from arrow_chunks(scored(), schema)

    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("binary").alias("text"))
    return rows.mapInArrow(run, "doc_id long, score double")


def toxicity(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS, **columns: str) -> DataFrame:
    """doc_id, held_out, score, predicted for every row."""
    scored = score(docs, train(docs, labels, max_rows, **columns), **columns)
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
