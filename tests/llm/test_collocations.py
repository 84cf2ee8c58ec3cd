"""Collocations against counting in plain Python."""

import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import collocations, common

from .conftest import docs_of, edge_rows


def brute(rows, least, longest, first):
    count, totals = Counter(), Counter()
    for lang, text in rows:
        text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\n-\r]", text):
            words = re.findall("[^ \t]+", piece)
            totals[lang or "und"] += len(words)
            for m in range(1, longest + 1):
                for i in range(len(words) - m + 1):
                    count[lang or "und", tuple(words[i : i + m])] += 1
    kept = {k: a for k, a in count.items() if a >= least}
    out = {}
    for (lang, phrase), a in kept.items():
        if len(phrase) == 1:
            continue
        longer = [b for (other, p), b in kept.items() if other == lang and len(p) > len(phrase) and any(p[i : i + len(phrase)] == phrase for i in range(len(p)))]
        if any(b >= a for b in longer):
            continue
        n = totals[lang]
        cut = min((1000 * a * n // (kept[lang, phrase[:k]] * kept[lang, phrase[k:]]), k) for k in range(1, len(phrase)))
        left, right = kept[lang, phrase[: cut[1]]], kept[lang, phrase[cut[1] :]]
        out.setdefault(lang, []).append((-cut[0], -a, " ".join(phrase).encode(), left, right, n))
    return {(lang, rank + 1, p.decode(), -a, left, right, n, -score) for lang, own in out.items() for rank, (score, a, p, left, right, n) in enumerate(sorted(own)[:first])}


def some_docs(seed=0):
    rng = random.Random(seed)
    common_words, rare = ["the", "of", "Élan", "blue", "sky", "K", "x\x01y", "漢", "nbsp in", " "], [f"r{k}" for k in range(60)]
    phrases = ["New York City hall", "as well as", "a b a b a b", "one two three four five six"]
    out = []
    for _ in range(300):
        words = [rng.choice([rng.choice(common_words), rng.choice(rare), rng.choice(phrases)]) + rng.choice(["", "", "", ".", ",", "\n", ";  ", "\t"]) for _ in range(rng.randint(0, 60))]
        out.append((rng.choice(["en", "en", "en", None, "und", "de"]), " ".join(words)))
    return out + [(None, None), ("en", ""), ("en", " .,\n"), ("fr", "only once")]


@pytest.fixture
def docs(spark):
    rows = [(k, text, lang, "s", 0) for k, (lang, text) in enumerate(some_docs())]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(6)


def test_mined_equal_counting(docs):
    got = {(r.lang, r["rank"], r.phrase, r.a, r.l, r.r, r.n, r.score) for r in collocations.mined(docs, 6, 5, 40).collect()}
    want = brute(some_docs(), 6, 5, 40)
    assert got == want and len(want) > 60


def test_a_filter_that_lets_everything_through_changes_nothing(docs, monkeypatch):
    want = {tuple(r) for r in collocations.mined(docs, 20, 4, 500).collect()}
    monkeypatch.setattr(collocations, "filter_of", lambda rows, checksum: b"\xff" * (common.FILTER_BITS // 8))
    monkeypatch.setattr(collocations, "WORDS_HELD", 50)
    monkeypatch.setattr(collocations, "TABLE", 20)
    assert {tuple(r) for r in collocations.mined(docs, 20, 4, 500).collect()} == want


def test_streams_are_merged_in_order(docs):
    plan = collocations.counted(docs, 20, 3)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastNestedLoopJoin" not in plan and "CartesianProduct" not in plan


def test_scores_are_exact_beyond_64_bits(spark, monkeypatch):
    a, n = 3_000_000_007, 9_000_000_000_003
    row = spark.createDataFrame([("en", "p q", 2, a, [a + 1], [a + 2], None, n)], "lang string, phrase string, words int, a long, left array<long>, right array<long>, extension long, n long")
    monkeypatch.setattr(collocations, "counted", lambda *args: row)
    got = collocations.mined(None).first()
    assert got.score == 1000 * a * n // ((a + 1) * (a + 2)) and (got.l, got.r) == (a + 1, a + 2)


def test_filter_holds_every_phrase(spark):
    values = [0, 1, 7, 8, 32767, 32768, 65535, 65536, common.FILTER_BITS - 1, common.FILTER_BITS, 2**32 - 1]
    rows = spark.createDataFrame([(v,) for v in values], "v long")
    bits = common.filter_of(rows, F.col("v"))
    import numpy as np

    assert common.passes(bits, np.array(values)).all() and not common.passes(bits, np.array([2, 9, 32766, 65537])).any()
    assert sum(b.bit_count() for b in bits) == len({v % common.FILTER_BITS for v in values})


def test_edge_rows_and_no_rows(spark, edge):
    got = {(r.lang, r["rank"], r.phrase, r.a, r.l, r.r, r.n, r.score) for r in collocations.mined(edge, 3, 5, 2000).collect()}
    assert got == brute([(r[2], r[1]) for r in edge_rows()], 3, 5, 2000)
    assert collocations.mined(edge.limit(0)).count() == 0
    assert collocations.mined(docs_of(spark, [(1, "a b")])).count() == 0
