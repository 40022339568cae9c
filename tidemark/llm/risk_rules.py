"""Quality rules whose cutoffs are chosen under a bound on false rejections.

Every rule scores a document from 0 to 1000 with whole-number arithmetic; a
document is rejected by a rule when its score is above the rule's cutoff in the
document's stratum (its language; the null language is one of its own).

Cutoffs come from labelled holdouts: the documents labelled good that pass the
base limits. Nothing else is fitted to these labels, so all of them count. For
one stratum and rule the cutoffs 1000, 999, ... form a fixed sequence of nested
tests, each of "this cutoff rejects more than ``share / rules`` of good
documents". Its exact p-value is the binomial chance of as few rejected
holdouts as were seen; the walk goes on while it is at most ``error /
(strata * rules)`` and the last cutoff reached is taken. By Bonferroni over
strata and rules, with probability ``1 - error`` no stratum loses more than
``share`` of its good documents to all rules together. A stratum with too few
holdouts to show this for any cutoff gets none, and its documents pass.

Only sums per stratum, rule and score leave the document rows: at most 1001
per rule and stratum. All is done by DataFrame functions.

A null text has no words. An id without a label, or null, is no holdout; an id
with several labels is good if all of them say so. Rows that repeat an id are
judged one by one, and each counts as a holdout. Extra columns are not read. An
empty table gives none; without labels only the base limits reject.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import Scratch, join_checked

# Fixed values of the base measures.
BLANKS = " \t\n\x0b\f\r"
SYMBOLS = "#*$%&|<>"
WINDOW = 5
LEAST_WORDS = 10
MOST_REPEATS = 20  # per cent of the words

TOP = 1000  # greatest score


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is worked out once, however often body reads it."""
    return F.transform(F.array(value), body)[0]


def words_of(text: Column) -> Column:
    """The runs of ``[^\\x20\\x09-\\x0D]+`` of a text in order."""
    spaced = reduce(lambda t, blank: F.replace(t, F.lit(blank), F.lit(" ")), BLANKS[1:], text)
    return F.array_remove(F.split(spaced, " "), "")


def repeated_words(words: Column, size: int = WINDOW) -> Column:
    """How many words lie in a window of ``size`` words that stands twice or more.

    Windows are compared by hash, and by their words where hashes are equal.
    Only texts in which a hash repeats are sorted.
    """
    def hashed(h: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), F.size(h) - size), lambda i: F.xxhash64(*[h[i + k] for k in range(size)]))

    def covered(w: Column, hashes: Column) -> Column:
        ordered = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def equal(x: Column, y: Column) -> Column:
            same = reduce(lambda a, b: a & b, [w[x["i"] + k] == w[y["i"] + k] for k in range(size)])
            return F.coalesce((x["h"] == y["h"]) & same, F.lit(False))

        def starts(s: Column) -> Column:
            twice = F.filter(s, lambda x, j: equal(F.get(s, j - 1), x) | equal(x, F.get(s, j + 1)))
            return F.sort_array(F.transform(twice, lambda x: x["i"]))

        def total(at: Column) -> Column:
            parts = F.transform(at, lambda x, j: F.least(F.coalesce(F.get(at, j + 1) - x, F.lit(size)), F.lit(size)))
            return F.aggregate(parts, F.lit(0), lambda a, x: a + x)

        return let(let(ordered, starts), total)

    def counted(w: Column) -> Column:
        hashes = let(F.transform(w, lambda x: F.xxhash64(x)), hashed)
        repeats = let(hashes, lambda g: F.when(F.size(F.array_distinct(g)) == F.size(g), F.lit(0)).otherwise(covered(w, g)))
        return F.when(F.size(w) < size, F.lit(0)).otherwise(repeats)

    return let(words, counted).cast("long")


def measures(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", stratum_column: str = "lang") -> DataFrame:
    """doc_id, stratum and what the rules look at, one narrow row per row."""
    text = F.col("_text")
    with_words = F.filter(F.split(text, "\n", -1), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    lines = let(with_words, lambda x: F.struct(F.size(x).alias("n"), F.size(F.array_distinct(x)).alias("d")))
    words = F.col("_words")
    rows = docs.select(
        F.col(id_column).alias("doc_id"), F.col(stratum_column).cast("string").alias("stratum"),
        F.coalesce(F.col(text_column), F.lit("")).alias("_text"),
    )
    # Few characters are capitals or symbols: one pass finds them, then they are told apart.
    rows = rows.withColumn("_words", words_of(text)).withColumn("_lines", lines).withColumn(
        "_marks", F.regexp_replace(text, f"[^A-Z{SYMBOLS}]+", "")
    )
    counted = rows.select(
        "doc_id", "stratum",
        F.size(words).cast("long").alias("n_words"),
        F.length(F.array_join(words, "")).cast("long").alias("word_chars"),
        F.length(F.regexp_replace("_marks", "[A-Z]+", "")).cast("long").alias("n_symbols"),
        (F.col("_lines.n") - F.col("_lines.d")).cast("long").alias("n_dup_lines"),
        repeated_words(words).alias("n_repeat_words"),
        F.col("_lines.n").cast("long").alias("n_lines"),
        F.size(F.array_distinct(words)).cast("long").alias("n_distinct"),
        F.length(F.regexp_replace("_marks", "[^A-Z]+", "")).cast("long").alias("n_capitals"),
    )
    failed = f"n_words < {LEAST_WORDS} OR 100 * n_repeat_words > {MOST_REPEATS} * n_words"
    return counted.withColumn("base_failed", F.expr(failed))


def _share(part: str, whole: str) -> str:
    return f"least({TOP}, {TOP} * ({part}) div greatest({whole}, 1))"


# Score of each rule, in the order in which they are named as a reason.
RULES = {
    "symbols": _share("n_symbols", "word_chars"),
    "capitals": _share("n_capitals", "word_chars"),
    "dup_lines": _share("n_dup_lines", "n_lines"),
    "repeats": _share("n_repeat_words", "n_words"),
    "sameness": _share("n_words - n_distinct", "n_words"),
    "long_words": f"least({TOP}, 50 * word_chars div greatest(n_words, 1))",
    "short_words": f"{TOP} - least({TOP}, 50 * word_chars div greatest(n_words, 1))",
}


def most_rejected(n: Column, share: float, error: Column) -> Column:
    """The greatest k with P(Binomial(n, share) <= k) <= error; -1 if there is none.

    The chances are summed one by one in logarithms; beyond ``n * share`` the sum
    is about a half, so no more terms are looked at.
    """
    odds = F.lit(share / (1 - share))

    def step(state: Column, j: Column) -> Column:
        high, low = F.greatest(state["sum"], state["term"]), F.least(state["sum"], state["term"])
        total = high + F.log1p(F.exp(low - high))
        return F.struct(
            (state["term"] + F.log((n - j) / (j + 1) * odds + F.lit(1e-300))).alias("term"),
            total.alias("sum"),
            F.when(total <= F.log(error), j).otherwise(state["k"]).alias("k"),
        )

    start = F.struct(
        (n * F.log1p(F.lit(-share))).alias("term"), F.lit(-1e300).alias("sum"), F.lit(-1).cast("long").alias("k")
    )
    terms = F.sequence(F.lit(0).cast("long"), F.ceil(n * F.lit(share)).cast("long"))
    return F.aggregate(terms, start, step, lambda s: s["k"])


def cutoffs(holdouts: DataFrame, scratch: Scratch, share: float, error: float, rules: dict[str, str]) -> DataFrame:
    """stratum, rule, cutoff, n (holdouts), rejected, allowed: the cutoffs that hold.

    ``holdouts``: measures of documents that must not be rejected.
    """
    each = F.explode(F.array(*[F.struct(F.lit(r).alias("rule"), F.expr(s).cast("long").alias("score")) for r, s in rules.items()]))
    cells = scratch.put(
        holdouts.select("stratum", each.alias("x")).groupBy("stratum", "x.rule", "x.score").agg(F.count(F.lit(1)).alias("rows")),
        "cells",
    )
    sizes = scratch.put(cells.where(F.col("rule") == next(iter(rules))).groupBy("stratum").agg(F.sum("rows").alias("n")), "sizes")
    tests = max(1, sizes.count()) * len(rules)
    allowed = sizes.withColumn("allowed", most_rejected(F.col("n"), share / len(rules), F.lit(error / tests)))
    allowed = allowed.where("allowed >= 0").select(F.col("stratum").alias("s"), "n", "allowed")
    # A cutoff between two scores that occur rejects what the lower one rejects,
    # so only the scores that occur, and 0, are looked at.
    ladder = cells.union(cells.select("stratum", "rule").distinct().select("stratum", "rule", F.lit(0).cast("long"), F.lit(0).cast("long")))
    ladder = ladder.groupBy("stratum", "rule", "score").agg(F.sum("rows").alias("rows"))
    above = Window.partitionBy("stratum", "rule").orderBy(F.desc("score")).rowsBetween(Window.unboundedPreceding, -1)
    walked = ladder.withColumn("rejected", F.coalesce(F.sum("rows").over(above), F.lit(0).cast("long")))
    held = walked.join(allowed, F.col("stratum").eqNullSafe(F.col("s"))).where("rejected <= allowed")
    return held.groupBy("stratum", "rule").agg(
        F.min(F.struct(F.col("score").alias("cutoff"), "rejected", "n", "allowed")).alias("b")
    ).select("stratum", "rule", "b.cutoff", "b.n", "b.rejected", "b.allowed")


def apply_rules(
    docs: DataFrame, labels: DataFrame, share: float = 0.02, error: float = 0.05, rules: dict[str, str] = RULES,
    id_column: str = "doc_id", text_column: str = "text", stratum_column: str = "lang", label_column: str = "quality",
) -> DataFrame:
    """Measures of every row with base_failed, failed_rule (the first; null if none) and kept."""
    scratch = Scratch(docs.sparkSession, "rules")
    rows = scratch.put(measures(docs, id_column, text_column, stratum_column), "measures")
    good = scratch.put(
        labels.select(F.col(id_column).alias("doc_id"), F.col(label_column).alias("label")).where("doc_id IS NOT NULL")
        .groupBy("doc_id").agg(F.min("label").alias("least"), F.max("label").alias("most"))
        .where("least = 1 AND most = 1").select("doc_id"),
        "good",
    )
    holdouts = join_checked(rows.where("NOT base_failed"), good, "doc_id", "left_semi")
    limits = cutoffs(holdouts, scratch, share, error, rules)
    wide = limits.groupBy("stratum").agg(
        *[F.max(F.when(F.col("rule") == r, F.col("cutoff"))).alias(f"_{r}") for r in rules]
    ).withColumnRenamed("stratum", "_stratum")
    wide = scratch.put(wide.withColumn("_key", F.coalesce(F.concat(F.lit("="), "_stratum"), F.lit(""))).drop("_stratum"), "limits")
    scratch.drop(good)
    keyed = rows.withColumn("_key", F.coalesce(F.concat(F.lit("="), "stratum"), F.lit("")))
    judged = join_checked(keyed, wide, "_key", "left")
    first = F.coalesce(*[F.when(F.expr(f"({score}) > _{rule}"), F.lit(rule)) for rule, score in rules.items()])
    judged = judged.withColumn("failed_rule", F.when(~F.col("base_failed"), first))
    return judged.withColumn("kept", ~F.col("base_failed") & F.col("failed_rule").isNull()).drop("_key", *[f"_{r}" for r in rules])
