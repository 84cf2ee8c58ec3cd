"""Neighbours, personal data, licences, languages, toxicity."""

import random
import re
from itertools import combinations

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledgerloom.llm import language, licenses, neighbours, personal, toxicity

from .conftest import docs_of, edge_rows

VECTORS = "vec_id long, embedding array<float>, label int, block int, vector string"


def vectors_of(spark, rows):
    return spark.createDataFrame([(k, v, None, 1, "x") for k, v in rows], VECTORS)


def test_neighbours_reach_the_recall_in_many_blocks(spark):
    rng = np.random.default_rng(0)
    centres = rng.normal(size=(20, 16))
    data = (centres[rng.integers(0, 20, 1500)] + 0.4 * rng.normal(size=(1500, 16))).astype(np.float32)
    table = vectors_of(spark, [(k, v.tolist()) for k, v in enumerate(data)])
    rows = neighbours.search(table, F.col("vec_id") % 50 == 0, block_rows=300).collect()
    wide, hits = data.astype(float), 0
    for q in range(0, 1500, 50):
        own = sorted((r.rank, r.id, r.score) for r in rows if r.query_id == q)
        gap = np.sqrt(((wide - wide[q]) ** 2).sum(axis=1))
        gap[q] = np.inf
        assert [r for r, _, _ in own] == list(range(1, 11))
        assert all(abs(s - gap[i]) < 1e-12 for _, i, s in own) and [s for *_, s in own] == sorted(s for *_, s in own)
        hits += len(set(np.argsort(gap)[:10].tolist()) & {i for _, i, _ in own})
    assert hits >= 0.9 * 300


def test_queries_whose_buckets_are_empty_still_get_their_neighbours(spark):
    rng = np.random.default_rng(1)
    data = rng.normal(size=(1500, 32)).astype(np.float32)
    data[::100] *= 100
    table = vectors_of(spark, [(k, v.tolist()) for k, v in enumerate(data)])
    rows = neighbours.search(table, F.col("vec_id") % 100 == 0, block_rows=500).collect()
    wide = data.astype(float)
    for q in range(0, 1500, 100):
        gap = np.sqrt(((wide - wide[q]) ** 2).sum(axis=1))
        gap[q] = np.inf
        assert [r.id for r in sorted(rows, key=lambda r: r.rank) if r.query_id == q] == np.argsort(gap)[:10].tolist()


def test_recall_holds_in_every_range_of_norms(spark):
    """Every tenth vector is eight times, every hundredth forty times as long; one bucket holds a third of all."""
    rng = np.random.default_rng(4)
    data = rng.normal(size=(6000, 32)).astype(np.float32)
    data[::3] = data[0] + 0.01 * rng.normal(size=(2000, 32))
    data[::10] *= 8
    data[::100] *= 5
    table = vectors_of(spark, [(k, v.tolist()) for k, v in enumerate(data)])
    asks = (F.col("vec_id") % 50 == 0) | (F.col("vec_id") % 50 == 7)
    rows = neighbours.search(table, asks, block_rows=700).collect()
    wide, hits = data.astype(float), {}
    for q in [k for k in range(6000) if k % 50 in (0, 7)]:
        own = [r for r in rows if r.query_id == q]
        gap = np.sqrt(((wide - wide[q]) ** 2).sum(axis=1))
        gap[q] = np.inf
        assert len(own) == 10 and all(abs(r.score - gap[r.id]) < 1e-9 for r in own)
        length = 40 if q % 100 == 0 else 8 if q % 10 == 0 else 1
        hits.setdefault(length, []).append(len({r.id for r in own} & set(np.argsort(gap)[:10].tolist())) / 10)
    assert len(hits) == 3 and all(np.mean(h) >= 0.9 for h in hits.values()), {k: np.mean(h) for k, h in hits.items()}


def test_neighbours_leave_unusable_rows_out_and_break_ties_by_id(spark):
    nan, inf = float("nan"), float("inf")
    bad = [(1, None), (2, []), (3, [0.0, 0.0]), (4, [nan, 1.0]), (5, [inf, 1.0]), (6, [None, 1.0]), (None, [1.0, 0.0]), (7, [1.0, 2.0, 3.0])]
    good = [(0, [1.0, 0.0]), (20, [0.0, 1.0]), (10, [0.0, 1.0]), (10, [0.0, 1.0]), (30, [1.0, 0.0])]
    rows = neighbours.search(vectors_of(spark, bad + good), F.col("vec_id") == 0, k=3).collect()
    assert [(r["rank"], r.id) for r in sorted(rows, key=lambda r: r["rank"])] == [(1, 30), (2, 10), (3, 20)]
    assert neighbours.search(vectors_of(spark, bad), F.lit(True)).count() == 0
    assert neighbours.search(vectors_of(spark, []), F.lit(True)).count() == 0
    assert neighbours.search(vectors_of(spark, [(0, [1.0, 2.0])]), F.lit(True)).count() == 0


def test_probe_order_is_by_expected_cost():
    m = 4
    cost = [0] + [j * (j + 1) / (4 * (m + 1) * (m + 2)) if j <= m else 1 - (9 - j) / (m + 1) + (9 - j) * (10 - j) / (4 * (m + 1) * (m + 2)) for j in range(1, 9)]
    valid = [s for n in range(1, 5) for s in combinations(range(1, 9), n) if len({min(j, 9 - j) for j in s}) == n]
    want = sorted(sum(cost[j] for j in s) for s in valid)[:30]
    got = neighbours.probe_order(m, 30)
    assert np.allclose([sum(cost[j] for j in s) for s in got], want) and len(set(got)) == 30


@pytest.fixture(scope="module")
def field():
    return personal.learn_from([])


LOST = "x +1 (269) 555-3296 4524132264652876 y"


def test_field_adds_what_the_patterns_lose(field):
    base, spans = personal.spans_of(LOST, field)
    assert base == []
    assert [(k, LOST[a:b]) for k, a, b in spans] == [("card", "4524132264652876"), ("phone", "+1 (269) 555-3296")]


def held_out_windows(seed):
    """Texts in which the patterns find nothing, and what is in them."""
    rng = random.Random(seed)
    out = list(personal.made_up_secrets(400, seed))
    for _ in range(150):
        card = [rng.randrange(10) for _ in range(15)]
        card.append(next(d for d in range(10) if personal.luhn("".join(map(str, [*card, d])))))
        card = "".join(map(str, card))
        phone = f"+{rng.randint(1, 99)} ({rng.randint(100, 999)}) {rng.randint(100, 999)}-{rng.randint(1000, 9999)}"
        text = f"{rng.choice(['x', 'call', 'or'])} {phone} {card} {rng.choice(['y', 'and'])}"
        if not personal.base_spans(text):
            at = text.index(phone)
            out.append((text, {("phone", at, at + len(phone)), ("card", at + len(phone) + 1, at + len(phone) + 17)}))
    return out


def test_added_spans_of_held_out_windows(field):
    right = said = true = 0
    by_kind = {}
    for text, gold in held_out_windows(77):
        base, spans = personal.spans_of(text, field)
        more = set(spans) - set(base)
        right, said, true = right + len(more & gold), said + len(more), true + len(gold)
        for kind, a, b in gold:
            by_kind.setdefault(kind, []).append((kind, a, b) in more)
    assert right / said >= 0.95 and right / true >= 0.9, (right, said, true)
    assert {k: np.mean(v) >= 0.85 for k, v in by_kind.items()} == {"secret": True, "phone": True, "card": True}


def test_secrets_are_found_with_their_own_cue(field):
    text = 'so the token = "2100a60029d9170a161913d4d019930026318f5d" for section2019final04draft is set'
    assert personal.base_spans(text) == []
    assert [(k, text[a:b]) for k, a, b in personal.spans_of(text, field)[1]] == [("secret", "2100a60029d9170a161913d4d019930026318f5d")]


@pytest.mark.parametrize("text", ["", "plain words", "version 2.0. of 1999", "1 2 3 4 5 6 7 8 9 10 11 12 13", "a@b", "999.1.1.1", "4111111111111112"])
def test_nothing_is_added_to_clean_text(field, text):
    assert personal.spans_of(text, field) == ([], [])


def test_base_matches_stay(field):
    text = "é a.b@c.de 10.1.2.3 4111 1111 1111 1111, +49 (30) 123-4567 \U0001f600 z@y.x"
    base, spans = personal.spans_of(text, field)
    assert set(base) <= set(spans)
    assert [(k, text[a:b]) for k, a, b in base][:4] == [("email", "a.b@c.de"), ("email", "z@y.x"), ("ip", "10.1.2.3"), ("phone", "+49 (30) 123-4567")] or len(base) == 5


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet="0123456789.+-() @ab\n", max_size=60))
def test_best_cut_equals_trying_all(text):
    field = personal.learn_from([])
    for a, b in personal.windows(text):
        graph = personal.lattice(text, a, b)
        if len(graph.plain) > 9:
            continue
        scored, outside = field._scored(graph), field._outside(graph)

        def best(j):
            if j == 0:
                return 0.0
            return max([best(j - 1) + outside[j - 1], *[best(x[0]) + x[4] for x in scored if x[1] == j]])

        spans = field.best(graph)
        inner = sum(max(x[4] for x in scored if (x[2], graph.edges[x[0]], graph.edges[x[1]]) == s) for s in spans)
        outer = sum(v for k, v in enumerate(outside) if not any(s <= graph.edges[k] < e for _, s, e in spans))
        assert abs(inner + outer - best(len(graph.plain))) < 1e-9


def test_gradient_is_that_of_the_likelihood():
    text, field = "a 10.2.3.4 b", personal.learn_from([])
    graph = personal.lattice(text, 0, len(text))
    gold = {("ip", 2, 10)}

    def value():
        scored, outside = field._scored(graph), field._outside(graph)
        forward = [0.0]
        for j in range(1, len(graph.plain) + 1):
            forward.append(personal._logsum([forward[-1] + outside[j - 1], *[forward[x[0]] + x[4] for x in scored if x[1] == j]]))
        true = sum(x[4] for x in scored if (x[2], graph.edges[x[0]], graph.edges[x[1]]) in gold)
        return true + sum(v for k, v in enumerate(outside) if not 2 <= graph.edges[k] < 10) - forward[-1]

    gradient = field.gradient(graph, gold)
    for key in list(gradient)[:12]:
        old = field.weights.get(key, 0.0)
        field.weights[key] = old + 1e-5
        up = value()
        field.weights[key] = old - 1e-5
        down = value()
        field.weights[key] = old
        assert abs((up - down) / 2e-5 - gradient[key]) < 1e-3


def test_personal_edge_rows(spark, edge):
    model = personal.learn(edge)
    rows = personal.found(edge, model).collect()
    assert sorted(str(r.id) for r in rows) == sorted(str(r[0]) for r in edge_rows()) and all(r.base == [] for r in rows)
    assert personal.found(docs_of(spark, []), model).count() == 0


WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def slow_places(text):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    parts = [(label, p.split()) for label, p in licenses.BASE]
    return len(words), sorted((k, len(p)) for _, p in parts for k in range(len(words)) if words[k : k + len(p)] == p)


LICENCE_TEXTS = [
    "Released under the MIT License. mit license MIT-License", "Licensed under the Apache License, Version 2.0.", "GNU General Public License", "general public licensee mit",
    "Licensed under CC BY-NC 4.0.", "All rights reserved.", "mit apache general license public", "the GNU Lesser General Public License", "mİt license", "MIT Lıcense apacKe license",
    "Permission is hereby granted, free of charge, to any person obtaining a copy", "public general license " * 50 + "mit license " * 30, "redistribution of forms and use in source and binary",
]


def test_licences(spark, edge):
    texts = LICENCE_TEXTS + [r[1] for r in edge_rows()]
    rows = {r.id: r for r in licenses.scan(docs_of(spark, list(enumerate(texts)))).collect()}
    for k, text in enumerate(texts):
        n, places = slow_places(text)
        assert rows[k].n_words == n and sorted((p.start, p.length) for p in rows[k].places) == places, text
        assert set(rows[k].base_labels) <= set(rows[k].labels) and 0 <= rows[k].score <= 1
    assert rows[4].labels == ["cc-by-nc"] and rows[5].labels == ["reserved"] and rows[6].labels == [] and rows[12].labels == []
    assert rows[10].labels == ["mit"] and rows[10].base_labels == []
    assert "lgpl" in rows[7].labels
    assert licenses.scan(docs_of(spark, [])).count() == 0
    assert licenses.scan(edge).count() == len(edge_rows())


def test_every_notice_of_a_file_is_found(spark):
    bsd, mit = licenses.TEMPLATES[7][1], licenses.TEMPLATES[1][1]
    wordings = [t for _, t, _ in licenses.TEMPLATES]
    texts = [f"{bsd}. {mit}. all rights reserved", f"{bsd}. {mit}. licensed under cc by nc 4 0", " x ".join(wordings), " x ".join(wordings[::-1]), "the of " * 300 + " x ".join(wordings * 3), bsd]
    rows = {r.id: r.labels for r in licenses.scan(docs_of(spark, list(enumerate(texts)))).collect()}
    assert rows[0] == ["bsd", "mit", "reserved"] and rows[1] == ["bsd", "cc-by-nc", "mit"] and rows[5] == ["bsd"]
    every = sorted({label for label, _, _ in licenses.TEMPLATES})
    assert rows[2] == rows[3] == rows[4] == every


def slow_labels(texts):
    """Labels and score of each text by trying every template at every place."""
    words = [re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in t)) for t in texts]
    vocabulary = {w for _, t, _ in licenses.TEMPLATES for w in t.split()} | {w for _, p in licenses.BASE for w in p.split()}
    weight = {w: max(np.log((len(texts) + 1) / (sum(w in own for own in words) + 0.5)), 1e-6) for w in vocabulary}
    out = []
    for own in words:
        labels, score = set(), 0.0
        for label, phrase in licenses.BASE:
            if any(own[i : i + len(phrase.split())] == phrase.split() for i in range(len(own))):
                labels.add(label)
                score = 1.0
        for label, text, key in licenses.TEMPLATES:
            template, phrase = text.split(), key.split()
            at = next(k for k in range(len(template)) if template[k : k + len(phrase)] == phrase)
            for start in range(-len(template), len(own)):
                if any(not 0 <= start + at + k < len(own) or own[start + at + k] != w for k, w in enumerate(phrase)):
                    continue
                held = {w for k, w in enumerate(template) if 0 <= start + k < len(own) and own[start + k] == w}
                share = sum(weight[w] for w in held) / sum(weight[w] for w in set(template))
                more = set(template) - set(phrase)
                if share >= 0.5 and (not more or sum(weight[w] for w in held & more) / sum(weight[w] for w in more) >= 0.2):
                    labels.add(label)
                    score = max(score, share)
        out.append((sorted(labels), score))
    return out


def test_template_labels_and_score_equal_trying_every_place(spark):
    rng = random.Random(8)
    texts = [""] * 20
    for _ in range(250):
        parts = []
        for _ in range(rng.randint(1, 3)):
            template = rng.choice(licenses.TEMPLATES)[1].split()
            for k in range(len(template)):
                if rng.random() < rng.choice([0, 0.1, 0.4]):
                    template[k] = rng.choice(["the", "of", "xyz", "license", "free", "gnu"])
            first = rng.choice([0, 0, rng.randrange(len(template))])
            parts += template[first : rng.randint(first + 1, len(template))] + rng.choices(["the", "of", "ab", "this", "is"], k=rng.randint(0, 6))
        texts.append(rng.choice([" ", ", "]).join(parts))
    texts += [key for _, _, key in licenses.TEMPLATES]
    rows = {r.id: r for r in licenses.scan(docs_of(spark, list(enumerate(texts)))).collect()}
    want = slow_labels(texts)
    for k, (labels, score) in enumerate(want):
        assert rows[k].labels == labels and abs(rows[k].score - score) < 1e-9, texts[k]
    assert len({label for labels, _ in want for label in labels}) >= 10
    alone = {key: rows[k].labels for k, key in list(enumerate(texts))[-len(licenses.TEMPLATES) :]}
    assert alone["redistribution and use in source and binary forms"] == [] and alone["all rights reserved"] == ["reserved"]


def slow_phrases(train, text):
    at = count = 0
    while at < len(text):
        end = at + 1
        while end <= len(text) and text[at:end] in train:
            end += 1
        at, count = max(at + 1, end - 1), count + 1
    return count


@settings(max_examples=100, deadline=None)
@given(st.text(alphabet="abcd", max_size=60), st.text(alphabet="abcde", min_size=1, max_size=40))
def test_phrases(train, text):
    table = language.suffix_automaton([ord(c) - 95 for c in train], 8)
    symbols = np.array([ord(c) - 95 for c in text], dtype=np.uint8)
    assert language.phrases(table, symbols, np.array([0]), np.array([len(text)]))[0] == slow_phrases(train, text)


def test_languages_are_told_apart_on_held_out_rows(spark, edge):
    rng = random.Random(0)
    sets = {"aa": ["kala", "mine", "otto", "suru"], "bb": ["xyz", "qwr", "vvt", "zzk"], "cc": ["élan", "çort", "ñub", "œuf"]}
    rows = [(k, " ".join(rng.choice(sets[lang]) for _ in range(rng.choice([5, 40, 3000]))), lang) for k in range(120) for lang in [sorted(sets)[k % 3]]]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language.learn(docs)
    got = {r.id: r for r in language.identified(docs, model).collect()}
    assert all(got[k].lang_pred == lang and 0 <= got[k].score <= 1 for k, _, lang in rows)
    unnamed = language.identified(edge, model).collect()
    assert len(unnamed) == len(edge_rows())
    assert all(r.lang_pred == "und" and r.score == 0 for r in unnamed if r.id in (0, 1, 2))
    empty = docs.limit(0)
    assert language.identified(empty, model).count() == 0
    assert {r.lang_pred for r in language.identified(docs, language.learn(empty)).collect()} == {"und"}


def made_up(rng, languages, letters, first):
    """Languages of invented words over ``letters`` signs each, from ``first`` on."""
    out = {}
    for k in range(languages):
        own = [chr(first + c) for c in rng.sample(range(letters), min(letters, 3000))]
        out[f"l{k:02}"] = ["".join(rng.choice(own) for _ in range(rng.randint(2, 5))) for _ in range(400)]
    return out


def held_out_share(spark, rng, words, rows, n, fit):
    data = [(k, " ".join(rng.choice(words[lang]) for _ in range(n)), lang) for k in range(rows) for lang in [sorted(words)[k % len(words)]]]
    docs = spark.createDataFrame(data, "doc_id long, text string, lang string").repartition(8)
    got = language.identified(docs, language.learn(docs, fit)).where("crc32(cast(cast(id as string) as binary)) % 4 = 2").collect()
    right = {}
    for r in got:
        lang = data[r.id][2]
        right.setdefault(lang, []).append(r.lang_pred == lang)
    return {lang: sum(x) / len(x) for lang, x in right.items()}


def test_languages_of_thousands_of_letters(spark):
    rng = random.Random(5)
    words = made_up(rng, 2, 3000, 0x4E00) | {"en": ["the", "cat", "sat", "on", "a", "mat", "with", "hats"]}
    shares = held_out_share(spark, rng, words, 600, 40, language.Fit())
    assert len(shares) == 3 and min(shares.values()) >= 0.95


def test_sixty_languages_share_the_bound_of_the_tables(spark):
    rng = random.Random(6)
    words = made_up(rng, 60, 26, ord("a"))
    fit = language.Fit(table_bytes=24 << 20)
    shares = held_out_share(spark, rng, words, 1800, 60, fit)
    assert len(shares) == 60 and min(shares.values()) >= 0.75 and sum(shares.values()) / 60 >= 0.95


def test_long_texts_are_read_whole_and_come_to_the_driver_in_part(spark):
    rng = random.Random(7)
    words = made_up(rng, 2, 26, ord("a"))
    say = lambda lang, n: " ".join(rng.choice(words[lang]) for _ in range(n))
    rows = [(k, say(lang, 50_000 if k < 4 else 30), lang) for k in range(40) for lang in [f"l0{k % 2}"]]
    rows.append((100, say("l00", 20_000) + " " + say("l01", 40_000), None))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {r.id: r.lang_pred for r in language.identified(docs, language.learn(docs)).collect()}
    assert all(got[k] == lang for k, _, lang in rows[:-1]) and got[100] == "l01"


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


TERMS, STEMS = ("idiot", "scum", "worthless", "moron"), ("lowei", "vequ")


@settings(max_examples=300, deadline=None)
@given(st.one_of(st.text(alphabet="idotscumwrhlenvqx", min_size=1, max_size=14), st.sampled_from(TERMS + STEMS).flatmap(
    lambda t: st.tuples(st.integers(0, len(t)), st.text(alphabet="idoxé", max_size=2), st.integers(0, 2)).map(lambda e: (t[: e[0]] + e[1] + t[e[0] + e[2] :]) or "x"))))
def test_automaton_equals_edit_distance(word):
    scanner = toxicity.Scanner(toxicity.Model(TERMS, STEMS))
    near = [edits(word, t) for t in TERMS]
    got = scanner.features([word])[0]
    stem = any(word.startswith(s) for s in STEMS)
    exact = word in TERMS
    close = any(d <= toxicity.allowed_edits(t) for d, t in zip(near, TERMS, strict=True))
    assert got[:3].tolist() == ([0, 1, 0] if stem else [1, 0, 0] if exact else [0, 0, 1] if close else [0, 0, 0])


def test_context_separates_quotation_from_abuse():
    scanner = toxicity.Scanner(toxicity.Model(TERMS, ()))
    quoted, abuse, plain, spelt = scanner.features(['he said "what an idiot he is" yesterday', "you are an idiot", "the idiot", "1d1ot idi0t m0ron"])
    assert quoted.tolist() == [1, 0, 0, 1, 0] and abuse.tolist() == [1, 0, 0, 0, 1] and plain.tolist() == [1, 0, 0, 0, 0]
    assert spelt[2] == 2
    q, a, p = toxicity.scores(np.array([quoted, abuse, plain]), toxicity.PRIOR)
    assert q < p < a


def test_toxicity_learns_words_from_labels(spark):
    rng = random.Random(4)
    clean = ["bora", "tilu", "meka", "soni", "rafe", "duna"]
    rows, marks = [], []
    for k in range(400):
        bad = k % 4 == 0
        words = [rng.choice(clean) for _ in range(30)] + (["grumblesnort"] * 2 if bad else [])
        rng.shuffle(words)
        rows.append((k, f"n{k} " + " ".join(words)))
        marks.append((k, int(bad)))
    docs, labels = docs_of(spark, rows), spark.createDataFrame(marks, "doc_id long, toxic int")
    model = toxicity.learn(docs, labels)
    assert "grumblesnort" in model.terms
    got = {r.doc_id: r.score for r in toxicity.scored(docs, model).collect()}
    assert all((got[k] >= 0.5) == bool(t) for k, t in marks)
    assert sorted(r.doc_id for r in toxicity.without_toxic(docs, model).collect()) == [k for k, t in marks if not t]


def test_toxicity_keeps_every_term_that_passes_however_few_texts_share_it(spark):
    rng = random.Random(5)
    few = ["zk", "overlongwordofmorethantwentyletters", *{"".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(8)) for _ in range(220)}]
    held = [[] for _ in range(400)]
    for word in few:
        for k in rng.sample(range(400), 10):  # under three hundredths of the toxic texts
            held[k].append(word)
    rows = [(k, f"bora tilu {'x' * k}y " + " ".join(held[k] if k < 400 else ["meka"])) for k in range(2400)]
    marks = [(k, int(k < 400)) for k, _ in rows]
    model = toxicity.learn(docs_of(spark, rows), spark.createDataFrame(marks, "doc_id long, toxic int"), toxicity.Fit(stem_words=1000))
    outside = spark.createDataFrame(marks, "doc_id long, toxic int").where("toxic = 1").where(toxicity.id_residue("doc_id", 5) != 0)
    kept = {r.doc_id for r in outside.collect()}
    count = {w: sum(w in held[k] for k in kept) for w in few}
    assert {w for w in few if count[w] >= 7} <= set(model.terms)


def test_a_bounded_sample_keeps_the_ratio_of_the_classes(spark):
    rows = [(k, f"n{k} {'x' * k}y " + ("bora idiot" if k % 10 < (7 if k < 300 else 1) else "bora tilu")) for k in range(2700)]
    docs, labels = docs_of(spark, rows), spark.createDataFrame([(k, int(k < 300)) for k, _ in rows], "doc_id long, toxic int")
    whole, bounded = (toxicity.learn(docs, labels, toxicity.Fit(rows_per_class=n, pull=0.01)) for n in (12_000, 150))
    assert abs(whole.weights[0] - bounded.weights[0]) < 0.8  # a sample of equal classes moves it by log 9


def test_toxicity_of_edge_rows(spark, edge, labels):
    model = toxicity.learn(edge, labels)
    rows = toxicity.scored(edge, model).collect()
    assert sorted(str(r.doc_id) for r in rows) == sorted(str(r[0]) for r in edge_rows()) and all(0 <= r.score < 0.5 for r in rows)
    kept = toxicity.without_toxic(edge, model)
    assert kept.schema == edge.schema and kept.count() == len(edge_rows())
    nothing = toxicity.learn(docs_of(spark, []), labels.limit(0))
    assert nothing == toxicity.Model(toxicity.SEED_TERMS, ()) and toxicity.scored(docs_of(spark, []), nothing).count() == 0
