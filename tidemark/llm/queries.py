"""Each operator over its whole table, and the SQL that some of them must equal."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import (
    backoff, embeddings, exact_dedup, fill_middle, filter_audit, html_extract, kneser_ney, minhash, mixing, packing, risk_rules,
    suffix_dedup, toxicity,
)


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op3_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(table(spark, sf_dir, "documents")).select(
        "doc_id", "keep_id", "group_size", "kept", "text_sha256"
    )


def op6_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken", "rate", "copies"
    )


def op7_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_path())


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(table(spark, sf_dir, "pages"))


def op10_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"))


def op1_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_vectors(table(spark, sf_dir, "embeddings"))


def op2_backoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    return backoff.scores(table(spark, sf_dir, "documents"))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kneser_ney.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_suffix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"))


def op11_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = risk_rules.apply_rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "failed_rule"
    )


def op12_fim(spark: SparkSession, sf_dir: str) -> DataFrame:
    restored = fill_middle.restore(fill_middle.fill_in_middle(table(spark, sf_dir, "documents")))
    return restored.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
        F.sha2("text", 256).alias("restored_sha256"),
    )


def op13_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


QUERIES = {"op1_vectors": op1_vectors, "op2_backoff": op2_backoff, "op3_exact": op3_exact, "op6_mix": op6_mix, "op4_quality": op4_quality, "op5_suffix": op5_suffix, "op7_pack": op7_pack, "op8_extract": op8_extract, "op9_toxicity": op9_toxicity, "op10_minhash": op10_minhash, "op11_rules": op11_rules, "op12_fim": op12_fim, "op13_audit": op13_audit}

SQL = {
    "op3_exact": r"""
        WITH n AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents)
        SELECT doc_id, min(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
               doc_id = min(doc_id) OVER (PARTITION BY t) AS kept, sha256(t) AS text_sha256
        FROM n""",

    # The binomial sums use the gamma function where the operator sums chances one by one.
    "op11_rules": r"""
        WITH t AS (
            SELECT row_number() OVER () AS rn, doc_id, lang, coalesce(text, '') AS text,
                   regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
                   list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l
            FROM documents),
        windows AS (
            SELECT rn, i, array_to_string(w[i : i + 4], ' ') AS win
            FROM (SELECT rn, w, unnest(range(1, len(w) - 3)) AS i FROM t WHERE len(w) >= 5)),
        repeated AS (
            SELECT rn, count(DISTINCT pos) AS n FROM (
                SELECT rn, unnest(range(i, i + 5)) AS pos
                FROM (SELECT rn, i, count(*) OVER (PARTITION BY rn, win) AS c FROM windows) WHERE c > 1)
            GROUP BY rn),
        m AS (
            SELECT t.rn, doc_id, lang, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
                   length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
                   (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines, coalesce(n, 0)::BIGINT AS n_repeat_words,
                   len(l) AS n_lines, len(list_distinct(w)) AS n_distinct, length(regexp_replace(text, '[^A-Z]', '', 'g')) AS n_capitals
            FROM t LEFT JOIN repeated r ON t.rn = r.rn),
        b AS (
            SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
                   [{'k': 1, 'rule': 'symbols', 's': least(1000, 1000 * n_symbols // greatest(word_chars, 1))},
                    {'k': 2, 'rule': 'capitals', 's': least(1000, 1000 * n_capitals // greatest(word_chars, 1))},
                    {'k': 3, 'rule': 'dup_lines', 's': least(1000, 1000 * n_dup_lines // greatest(n_lines, 1))},
                    {'k': 4, 'rule': 'repeats', 's': least(1000, 1000 * n_repeat_words // greatest(n_words, 1))},
                    {'k': 5, 'rule': 'sameness', 's': least(1000, 1000 * (n_words - n_distinct) // greatest(n_words, 1))},
                    {'k': 6, 'rule': 'long_words', 's': least(1000, 50 * word_chars // greatest(n_words, 1))},
                    {'k': 7, 'rule': 'short_words', 's': 1000 - least(1000, 50 * word_chars // greatest(n_words, 1))}] AS scores
            FROM m),
        good AS (SELECT doc_id FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id HAVING min(quality) = 1 AND max(quality) = 1),
        held AS (
            SELECT lang, x.rule AS rule, x.s AS s, count(*) AS n
            FROM (SELECT lang, unnest(scores) AS x FROM b SEMI JOIN good USING (doc_id) WHERE NOT base_failed) GROUP BY ALL),
        sizes AS (SELECT lang, sum(n) AS n FROM held WHERE rule = 'symbols' GROUP BY lang),
        tests AS (SELECT 7 * greatest(count(*), 1) AS tests FROM sizes),
        chances AS (
            SELECT lang, k, sum(exp(lgamma(n + 1) - lgamma(k + 1) - lgamma(n - k + 1) + k * ln(0.02 / 7) + (n - k) * ln(1 - 0.02 / 7)))
                       OVER (PARTITION BY lang ORDER BY k) AS p
            FROM (SELECT lang, n, unnest(range(0, ceil(n * 0.02 / 7)::BIGINT + 1)) AS k FROM sizes)),
        allowed AS (SELECT lang, max(k) AS allowed FROM chances, tests WHERE p <= 0.05 / tests GROUP BY lang),
        ladder AS (SELECT lang, rule, s, n FROM held UNION ALL SELECT DISTINCT lang, rule, 0, 0 FROM held),
        walked AS (
            SELECT lang, rule, s, coalesce(sum(n) OVER (PARTITION BY lang, rule ORDER BY s DESC
                       RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 0) - sum(n) OVER (PARTITION BY lang, rule, s) AS rejected
            FROM ladder),
        cutoffs AS (
            SELECT w.lang, rule, min(s) AS cutoff FROM walked w JOIN allowed a ON w.lang IS NOT DISTINCT FROM a.lang
            WHERE rejected <= allowed GROUP BY w.lang, rule),
        broken AS (
            SELECT rn, min_by(x.rule, x.k) AS rule FROM (SELECT rn, lang, unnest(scores) AS x FROM b WHERE NOT base_failed) y
            JOIN cutoffs c ON y.lang IS NOT DISTINCT FROM c.lang AND y.x.rule = c.rule AND y.x.s > c.cutoff GROUP BY rn)
        SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
               NOT base_failed AND rule IS NULL AS kept, rule AS failed_rule
        FROM b LEFT JOIN broken ON b.rn = broken.rn""",
    "op12_fim": r"""
        WITH t AS (
            SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS u,
                   sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS h
            FROM documents),
        d AS (
            SELECT *, len(u) AS n, ('0x' || h[1:8])::BIGINT % (len(u) + 1) AS c1, ('0x' || h[9:16])::BIGINT % (len(u) + 1) AS c2,
                   CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>')
                             OR ('0x' || h[17:24])::BIGINT % 100 >= 90 THEN 'plain'
                        WHEN ('0x' || h[25:32])::BIGINT % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
            FROM t),
        p AS (
            SELECT *, array_to_string(u[1 : least(c1, c2)], '') AS prefix,
                   array_to_string(u[least(c1, c2) + 1 : greatest(c1, c2)], '') AS middle,
                   array_to_string(u[greatest(c1, c2) + 1 : n], '') AS suffix
            FROM d)
        SELECT doc_id, n::BIGINT AS n, form, CASE WHEN form <> 'plain' THEN length(prefix)::BIGINT END AS prefix_chars,
               CASE WHEN form <> 'plain' THEN length(middle)::BIGINT END AS middle_chars,
               sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                      ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
               sha256(text) AS restored_sha256
        FROM p""",
    "op13_audit": r"""
        WITH w AS (
            SELECT d.doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text,
                   regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w, min(d.doc_id) OVER (PARTITION BY coalesce(text, '')) AS least_id,
                   coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic
            FROM documents d LEFT JOIN (
                SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic FROM labels GROUP BY doc_id) l ON d.doc_id = l.doc_id),
        fails AS (
            SELECT part, good, toxic,
                   (CASE WHEN len(w) < 200 THEN 'A' ELSE '' END) || (CASE WHEN 100 * len(list_distinct(w)) < 50 * len(w) THEN 'B' ELSE '' END)
                   || (CASE WHEN 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 3 * length(text) THEN 'C' ELSE '' END)
                   || (CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 'D' ELSE '' END)
                   || (CASE WHEN doc_id > least_id THEN 'E' ELSE '' END) AS f
            FROM w),
        cells AS (SELECT part, f, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM fails GROUP BY part, f),
        l AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS c),
        orders AS (
            SELECT a.c || b.c || c.c || d.c || e.c AS o FROM l a, l b, l c, l d, l e
            WHERE a.c <> b.c AND a.c <> c.c AND a.c <> d.c AND a.c <> e.c AND b.c <> c.c AND b.c <> d.c AND b.c <> e.c
              AND c.c <> d.c AND c.c <> e.c AND d.c <> e.c),
        steps AS (SELECT o, s, o[s:s] AS c, o[1 : s - 1] AS before FROM orders, (SELECT unnest(range(1, 6)) AS s)),
        x AS (
            SELECT part, o, s, c, n, good, toxic, f, contains(f, c) AS failing,
                   before <> '' AND regexp_matches(f, '[' || before || 'x]') AS gone
            FROM steps, cells),
        sums AS (
            SELECT part, o, s, c, sum(CASE WHEN NOT gone AND NOT failing THEN n ELSE 0 END) AS kept,
                   sum(CASE WHEN NOT gone AND failing THEN n ELSE 0 END) AS removed, sum(CASE WHEN gone AND failing THEN n ELSE 0 END) AS redundant,
                   sum(CASE WHEN f = c THEN n ELSE 0 END) AS unique_fails, sum(CASE WHEN NOT gone AND failing THEN good ELSE 0 END) AS good_lost,
                   sum(CASE WHEN NOT gone AND failing THEN toxic ELSE 0 END) AS toxic_lost
            FROM x GROUP BY part, o, s, c)
        SELECT part, o AS filter_order, s::INT AS step, kept::BIGINT AS kept, removed::BIGINT AS removed, redundant::BIGINT AS redundant,
               unique_fails::BIGINT AS unique_fails, good_lost::BIGINT AS good_lost, toxic_lost::BIGINT AS toxic_lost,
               (sum(removed) OVER (PARTITION BY part, c))::BIGINT AS shapley
        FROM sums""",
}
