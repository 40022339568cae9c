"""Quality rules, fill-in-the-middle and the filter audit against brute force."""

import hashlib
import itertools
import math
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tidemark.llm import fill_middle, filter_audit, queries, risk_rules
from tidemark.llm.common import Scratch

WORD = re.compile(r"[^\x20\x09-\x0D]+")
UNIT = re.compile(r"[A-Za-z]+|[^A-Za-z]")
SF = "/root/testdata/sf0.001"
PROSE = "The quick brown fox jumps over the lazy dog and runs far away from all other animals in a wide green wood today"
TEXTS = [
    None, "", " ", "\n\n", "one", PROSE, PROSE, PROSE + "\n" + PROSE, "A line here\n\nA line here\n  \nA line here \nA LINE",
    "a b c d e a b c d e a b c d e", "a b c d e x a b c d e", "tie " * 400, " ".join(f"w{i % 977}" for i in range(20000)),
    " ".join(f"u{i}" for i in range(30000)) + " u7 u8 u9 u10 u11", "ünï cödé 漢字 🙂 " * 60, "$$ ### ** && %% || << >> " * 20,
    "SHOUT " * 100 + PROSE, "a\x0bb\x0cc\r\nd\te", "<P> in the text", "x<S", "<M>", "é", "Zz9", "0" * 300,
    " ".join(f"word{i}" for i in range(250)), " ".join(f"word{i}" for i in range(250)), "x\x00y z",
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, ["en", "de", None][i % 3], "s", "clash", 1) for i, t in enumerate(TEXTS)]
    rows += [(None, PROSE, "en", "s", "clash", 1), (None, None, None, "s", "clash", 1)]
    rows += [(5, PROSE, "en", "s", "clash", 1), (7, "other text of a repeated id", "fr", "s", "clash", 1)] * 2
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, words string, n long").repartition(3)


@pytest.fixture(scope="module")
def labels(spark):
    rows = [(i, int(i % 4 != 1), int(i % 5 == 0), "clash") for i in range(0, len(TEXTS), 2)] + [(5, 1, 0, "x"), (5, 1, 1, "x"), (None, 1, 1, "x"), (6, 0, 1, "x")]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int, part string")


def base(text):
    w = WORD.findall(text or "")
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    seen = Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
    covered = {i + k for i in range(len(w) - 4) if seen[tuple(w[i : i + 5])] > 1 for k in range(5)}
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered)


def test_measures(docs):
    got = risk_rules.measures(docs).collect()
    assert len(got) == len(TEXTS) + 6
    for r in got:
        if r["doc_id"] is None or r["doc_id"] in (5, 7):
            continue
        want = base(TEXTS[r["doc_id"]])
        assert tuple(r[c] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")) == want, r["doc_id"]
        assert r["base_failed"] == (want[0] < 10 or 100 * want[4] > 20 * want[0])


def test_repeats_of_many_windows(spark):
    """Random texts over few words have windows that overlap, touch and repeat often."""
    rng = random.Random(3)
    texts = [" ".join(rng.choice("ab") for _ in range(rng.randint(0, 40))) for _ in range(300)]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("lang", F.lit("x"))
    got = {r["doc_id"]: r["n_repeat_words"] for r in risk_rules.measures(rows).collect()}
    assert got == {i: base(t)[4] for i, t in enumerate(texts)}


def allowed_by_hand(n, share, error):
    total, k = 0.0, -1
    for j in range(n + 1):
        total += math.comb(n, j) * share**j * (1 - share) ** (n - j)
        if total > error:
            break
        k = j
    return k


def test_exact_binomial_bound(spark):
    sizes = [0, 1, 10, 59, 60, 200, 500, 777, 1000]
    for share, error in ((0.05, 0.05), (0.01, 0.002), (0.2, 0.1)):
        rows = spark.createDataFrame([(n,) for n in sizes], "n long")
        got = rows.select("n", risk_rules.most_rejected(F.col("n"), share, F.lit(error)).alias("k")).collect()
        assert {r["n"]: r["k"] for r in got} == {n: allowed_by_hand(n, share, error) for n in sizes}
    large = spark.range(1).select(risk_rules.most_rejected(F.lit(2_000_000).cast("long"), 0.003, F.lit(0.001)).alias("k")).first()["k"]
    # Three standard deviations below the mean, by the normal approximation.
    assert abs(large - (6000 - 3.09 * math.sqrt(6000 * 0.997))) < 10


def test_cutoffs_are_the_strictest_that_hold(spark):
    rng = random.Random(5)
    rows = [("a", min(1000, int(rng.expovariate(1 / 60)))) for _ in range(4000)] + [(None, rng.randint(0, 1000)) for _ in range(3000)] + [("few", 5)] * 40
    held = spark.createDataFrame(rows, "stratum string, s long")
    got = {r["stratum"]: r for r in risk_rules.cutoffs(held, Scratch(spark, "t"), 0.02, 0.05, {"r": "s"}).collect()}
    assert set(got) == {"a", None}
    for name in got:
        scores = [s for g, s in rows if g == name]
        k = allowed_by_hand(len(scores), 0.02, 0.05 / 3)
        strictest = min(c for c in {0, *scores} if sum(s > c for s in scores) <= k)
        assert (got[name]["cutoff"], got[name]["allowed"], got[name]["n"]) == (strictest, k, len(scores))


def test_rules_reject_noise_and_keep_the_rest(spark):
    """The share of good documents lost stays under the bound, whatever the stratum; noise goes."""
    rng = random.Random(7)
    vocabulary = [f"{a}{b}{c}" for a in "bdfgk" for b in "aeiou" for c in "lmnrst"]
    good = [(i, " ".join(rng.choice(vocabulary) for _ in range(rng.randint(20, 120))), ["en", None][i % 2]) for i in range(6000)]
    bad = [(10000 + i, " ".join(rng.choice(vocabulary) + "&&&" for _ in range(60)), ["en", None][i % 2]) for i in range(200)]
    fresh = [(20000 + i, " ".join(rng.choice(vocabulary) for _ in range(rng.randint(20, 120))), ["en", None][i % 2]) for i in range(2000)]
    alone = [(30000, good[0][1] + " &&&", "unlabelled")]
    docs = spark.createDataFrame(good + bad + fresh + alone, "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, 1) for i, *_ in good] + [(i, 0) for i, *_ in bad], "doc_id long, quality int")
    out = {r["doc_id"]: r for r in risk_rules.apply_rules(docs, labels).collect()}
    assert not any(out[i]["kept"] for i, *_ in bad) and out[10000]["failed_rule"] == "symbols"
    assert out[30000]["kept"]
    for lang in ("en", None):
        ids = [i for i, _, x in fresh if x == lang]
        assert sum(not out[i]["kept"] for i in ids) <= 0.02 * len(ids)


def test_rules_without_labels_or_rows(docs, labels):
    out = risk_rules.apply_rules(docs, labels.where("false")).collect()
    assert len(out) == len(TEXTS) + 6 and all(r["kept"] is not r["base_failed"] for r in out)
    assert risk_rules.apply_rules(docs.where("false"), labels).count() == 0
    assert risk_rules.apply_rules(docs, labels).count() == len(TEXTS) + 6


def fim_by_hand(doc_id, text):
    text = text or ""
    units = UNIT.findall(text)
    h = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(h[8 * k : 8 * k + 8], 16) for k in range(4)]
    a, b = sorted((h[0] % (len(units) + 1), h[1] % (len(units) + 1)))
    parts = ["".join(units[:a]), "".join(units[a:b]), "".join(units[b:])]
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return len(units), "plain", None, None, text
    p, m, s = parts
    spm = h[3] % 100 < 20
    return len(units), "spm" if spm else "psm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}" if spm else f"<P>{p}<S>{s}<M>{m}"


def test_fill_in_middle(docs):
    rows = Counter((r["doc_id"], r["text"] or "") for r in docs.collect())
    got = fill_middle.restore(fill_middle.fill_in_middle(docs)).collect()
    assert Counter((r["doc_id"], r["text"]) for r in got) == rows
    for r in got:
        assert (r["n"], r["form"], r["prefix_chars"], r["middle_chars"], r["output"]) == fim_by_hand(r["doc_id"], r["text"])
    assert {r["form"] for r in got} == {"plain", "psm", "spm"}
    assert fill_middle.restore(fill_middle.fill_in_middle(docs.where("false"))).count() == 0


def test_rotations_round_trip():
    rng = random.Random(11)
    for _ in range(3000):
        raw = "".join(rng.choice("a<PSM>é🙂 \n") for _ in range(rng.randint(1, 30)))
        if any(m in raw for m in ("<P>", "<S>", "<M>")):
            continue
        raw = raw.encode()
        at = fill_middle.unit_starts(raw)
        assert [raw[a:b].decode() for a, b in itertools.pairwise(at)] == UNIT.findall(raw.decode())
        a, b = sorted(int(rng.choice(at)) for _ in range(2))
        for form in ("psm", "spm"):
            out = fill_middle.rearrange(raw, a, b, form)
            p, m, s = raw[:a], raw[a:b], raw[b:]
            assert out == (b"<P>" + p + b"<S>" + s + b"<M>" + m if form == "psm" else b"<S>" + s + b"<P>" + p + b"<M>" + m)
            assert fill_middle.put_back(out, form) == raw


def audit_by_hand(rows, good, toxic):
    """rows: (doc_id, text, part)."""
    least = {}
    for i, t, _ in rows:
        if i is not None:
            least[t] = min(least.get(t, i), i)
    fails = []
    for i, t, part in rows:
        w = WORD.findall(t)
        f = {"A": len(w) < 200, "B": 100 * len(set(w)) < 50 * len(w), "C": 100 * len(re.findall("[A-Z]", t)) > 3 * len(t),
             "D": bool(re.search(r"[#$%&*|]", t)), "E": i is not None and least[t] < i}
        fails.append((part, {k for k, v in f.items() if v}, i in good, i in toxic))
    out, shapley = {}, Counter()
    for part in {p for p, *_ in fails}:
        mine = [x for x in fails if x[0] == part]
        for order in map("".join, itertools.permutations("ABCDE")):
            left = mine
            for step, c in enumerate(order, 1):
                gone = [x for x in left if c in x[1]]
                left = [x for x in left if c not in x[1]]
                failing = sum(c in x[1] for x in mine)
                out[part, order, step] = [len(left), len(gone), failing - len(gone), sum(x[1] == {c} for x in mine), sum(x[2] for x in gone), sum(x[3] for x in gone)]
                shapley[part, c] += len(gone)
    return {k: (*v, shapley[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


def test_audit(docs, labels):
    rows = [(r["doc_id"], r["text"] or "", r["lang"] or "") for r in docs.collect()]
    good = {r["doc_id"] for r in labels.collect() if r["quality"] == 1 and r["doc_id"] is not None}
    toxic = {r["doc_id"] for r in labels.collect() if r["toxic"] == 1 and r["doc_id"] is not None}
    got = {(r["part"], r["filter_order"], r["step"]): tuple(r)[3:] for r in filter_audit.audit(docs, labels).collect()}
    assert got == audit_by_hand(rows, good, toxic)
    assert filter_audit.audit(docs.where("false"), labels).count() == 0
    assert filter_audit.audit(docs, labels.where("false")).count() == len(got)


@pytest.mark.parametrize("name", ["op11_rules", "op12_fim", "op13_audit"])
def test_queries_match_sql(spark, name):
    import duckdb

    con = duckdb.connect()
    for t in ("documents", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    out = queries.QUERIES[name](spark, SF)
    found = con.execute(queries.SQL[name])
    names = [c[0] for c in found.description]
    assert sorted(map(repr, found.fetchall())) == sorted(repr(tuple(r)) for r in out.select(*names).collect())
