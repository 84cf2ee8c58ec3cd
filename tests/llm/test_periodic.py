"""Periodic runs against every stretch and lag."""

import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerloom.llm import periodic, queries

from .conftest import docs_of, edge_rows


def every_run(words):
    """Maximal stretches of each lag, kept where no smaller lag has the same stretch."""
    out, n = {}, len(words)
    for lag in range(1, n // 3 + 1):
        start = 0
        for i in range(lag, n + 1):
            if i == n or words[i] != words[i - lag]:
                if i - start >= max(24, 3 * lag):
                    out.setdefault((start, i), lag)
                start = i - lag + 1
    return sorted((s, e - s, q) for (s, e), q in out.items())


@st.composite
def repetitive(draw):
    rng = random.Random(draw(st.integers(0, 10**9)))
    words, letters = [], "ab" if rng.random() < 0.5 else "abcdefgh"
    for _ in range(rng.randint(1, 5)):
        unit = [rng.choice(letters) for _ in range(rng.choice([1, 1, 2, 3, 5, 9, 17, 40]))]
        if rng.random() < 0.4:
            unit = unit * rng.randint(2, 30) + [rng.choice(letters) for _ in range(rng.randint(0, 3))]
        words += (unit * rng.randint(1, 40))[: rng.randint(1, 300)]
    return words * rng.choice([1, 1, 3])


@settings(max_examples=80, deadline=None)
@given(repetitive())
def test_runs_equal_every_lag_on_both_ways(words):
    want = every_run(words)
    assert periodic.runs_of(words, dense=10**9) == want
    assert periodic.runs_of(words, dense=-1) == want


def test_a_long_text_of_one_word_and_nested_repeats_stay_cheap():
    assert periodic.runs_of(["a"] * 200_000) == [(0, 200_000, 1)]
    block = ["x", "y", "z"] * 300 + ["end"]
    runs = periodic.runs_of(block * 20)
    assert (0, 901 * 20, 901) in runs and len(runs) == 21 and all(q in (3, 901) for *_, q in runs)


def altered(doc_id, words):
    h = zlib.crc32(str(doc_id).encode())
    g, n = h // 10, len(words)
    if h % 10 or n == 0:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]


def expected(doc_id, text):
    words = altered(doc_id, re.findall("[^\x20\x09-\x0d]+", text or "")) if doc_id is not None else re.findall("[^\x20\x09-\x0d]+", text or "")
    runs = every_run(words)
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=(None,) * 3)
    gone = {i for s, size, q in runs for i in range(s + q, s + size)}
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return (
        doc_id, len(runs), best[0], best[1], best[2], None if best[0] is None else 1000 * best[1] // best[2],
        sha("".join(f"{s},{size},{q}\n" for s, size, q in runs)), sha(" ".join(w for i, w in enumerate(words) if i not in gone)),
    )


def test_query_equals_brute_force(spark, tmp_path):
    rng = random.Random(5)
    texts = [None, "", " \t", "a b " * 40, "a b\x0bc\r\n" * 30]
    texts += [" ".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 400))) for _ in range(200)]
    docs_of(spark, [*enumerate(texts), (3, texts[3]), (None, texts[3])]).write.parquet(f"{tmp_path}/documents.parquet")
    rows = queries.op12_periodic_runs(spark, str(tmp_path)).collect()
    assert sum(r.n_runs > 0 for r in rows) > 15
    want = [expected(k, t) for k, t in [*enumerate(texts), (3, texts[3]), (None, texts[3])]]
    assert sorted(map(tuple, rows), key=str) == sorted(want, key=str)


def test_edge_rows_and_no_rows(spark, edge):
    rows = periodic.found(edge).collect()
    assert len(rows) == len(edge_rows()) and all(r.text is not None for r in rows)
    assert {r.text for r in rows if r.id in (0, 1, 2)} == {""}
    assert periodic.found(edge.limit(0)).count() == 0


def test_kept_words_lose_later_periods_only():
    words = ["p"] + ["a", "b", "c"] * 9 + ["q"]
    assert periodic.without_repeats(words, periodic.runs_of(words)) == ["p", "a", "b", "c", "q"]
    assert np.array_equal(periodic.runs_of(words), [(1, 27, 3)])
