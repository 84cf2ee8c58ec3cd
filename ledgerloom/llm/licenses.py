"""Licence scans with a positional index of rare words; DataFrame operations only.

One pass over the texts stores, for each file, its number of words, which licence words it holds, and, if these suffice
for some key phrase, the *postings* of its licence words: word to places.  Everything else reads that table.

Words weigh their inverse document frequency over all files.  Of each template the words of highest weight are looked up,
as many as it takes for the others to weigh less than the share that must stand in place: wherever a template stands,
one of them does.  Their postings, shifted by their places in the template, propose where it would begin; there the
postings of all its words are intersected by relative position, and what is left is verified by the template's key phrase,
the words a licence cannot do without, word for word.  All of it happens inside the file's own row, so files that share a
licence line are never gathered.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import add, and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import whole
from ledgerloom.session import materialise

#: Phrases that mean a licence wherever they stand, and their labels.
BASE = (("mit", "mit license"), ("apache", "apache license"), ("gpl", "general public license"))

#: Label, wording, key phrase.
TEMPLATES = (
    ("mit", "released under the mit license", "mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files", "permission is hereby granted free of charge"),
    ("apache", "licensed under the apache license version 2 0", "apache license"),
    ("gpl", "this work is licensed under the gnu general public license version 3", "general public license"),
    ("gpl", "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation", "general public license"),
    ("lgpl", "under the terms of the gnu lesser general public license", "lesser general public license"),
    ("agpl", "under the terms of the gnu affero general public license", "affero general public license"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met", "redistribution and use in source and binary forms"),
    ("mpl", "this source code form is subject to the terms of the mozilla public license v 2 0", "mozilla public license"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", "with or without fee is hereby granted"),
    ("unlicense", "this is free and unencumbered software released into the public domain", "released into the public domain"),
    ("cc-by", "this work is licensed under a creative commons attribution 4 0 international license", "creative commons attribution"),
    ("cc-by-nc", "licensed under cc by nc 4 0", "cc by nc"),
    ("reserved", "all rights reserved", "all rights reserved"),
)

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


@dataclass(frozen=True)
class Rules:
    """The ``share`` of a template's weight that must stand in place, and that of its words ``beyond`` the key phrase.

    A key phrase alone is no template, unless it is all of it.
    """

    share: float = 0.5
    beyond: float = 0.2


def words_of(text: Column) -> Column:
    """Words after lower-casing A-Z.  The Kelvin sign is put aside: it alone would turn into an ASCII letter."""
    return F.regexp_extract_all(F.lower(F.replace(text, F.lit("K"), F.lit("κ"))), F.lit(WORD), F.lit(0))


def _strings(values: Sequence[str]) -> Column:
    return F.array(*[F.lit(v) for v in values])


def _vocabulary() -> list[str]:
    return sorted({w for _, text, _ in TEMPLATES for w in text.split()} | {w for _, p in BASE for w in p.split()})


def _keys() -> list[str]:
    return sorted({p for _, _, p in TEMPLATES} | {p for _, p in BASE})


def indexed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, n_words, present, keys, postings``: one pass over the texts.

    ``keys`` are the key phrases whose words the file holds; a file without any has no ``postings``.
    """
    vocabulary = _strings(_vocabulary())
    step = docs.select(F.col(id_col).alias("id"), words_of(whole(text_col)).alias("words"))
    step = step.select("id", "words", F.size("words").cast("long").alias("n_words"), F.array_intersect("words", vocabulary).alias("present"))
    holds = {p: F.forall(_strings(sorted(set(p.split()))), lambda w: F.array_contains("present", w)) for p in _keys()}
    step = step.withColumn("keys", F.filter(F.array(*[F.when(holds[p], F.lit(p)) for p in _keys()]), lambda p: p.isNotNull()))
    hits = F.filter(F.transform("words", lambda w, i: F.struct(w.alias("word"), i.alias("at"))), lambda h: F.array_contains("present", h["word"]))
    step = step.select("id", "n_words", "present", "keys", F.when(F.size("keys") > 0, hits).alias("hits"))
    places = F.transform("present", lambda w: F.transform(F.filter("hits", lambda h: h["word"] == w), lambda h: h["at"]))
    return step.select("id", "n_words", "present", "keys", F.when(F.size("keys") > 0, F.map_from_arrays("present", places)).alias("postings"))


def weights(index: DataFrame) -> dict[str, float]:
    """Inverse document frequency of each licence word; one that no file holds counts as standing in half a file."""
    held = index.select(F.explode(F.array_append("present", F.lit(""))).alias("word")).groupBy("word").agg(F.count("*").alias("n"))
    counts = {r["word"]: r["n"] for r in held.collect()}  # a row for each word of the vocabulary at most
    total = counts.pop("", 0)
    return {w: max(math.log((total + 1) / (counts.get(w, 0) + 0.5)), 1e-6) for w in _vocabulary()}


def _posted(word: str) -> Column:
    """Where a word stands, no place if it does not."""
    return F.coalesce(F.try_element_at("postings", F.lit(word)), F.array().cast("array<int>"))


def _in_place(words: Sequence[str], word: str, start: Column) -> Column:
    """Whether ``word`` stands in one of its places of ``words``, if these begin at ``start``."""
    return reduce(or_, [F.array_contains(_posted(word), start + q) for q, w in enumerate(words) if w == word])


def _stands(words: Sequence[str], start: Column) -> Column:
    """Whether ``words`` stand one after the other from ``start``."""
    return reduce(and_, [F.array_contains(_posted(w), start + q) for q, w in enumerate(words)])


def _proposed(words: Sequence[str], looked_up: Sequence[str]) -> Column:
    """Where ``words`` would begin by the places of the words looked up."""
    def moved(word: str, by: int) -> Column:
        return F.transform(_posted(word), lambda p: p - by)

    shifted = [moved(w, q) for w in looked_up for q, v in enumerate(words) if v == w]
    return F.array_distinct(F.flatten(F.array(*shifted)))


def _with_words_of(phrase: str, places: Column) -> Column:
    return F.when(F.array_contains("keys", F.lit(phrase)), places).otherwise(F.array().cast("array<int>"))


def looked_up(words: Sequence[str], weight: dict[str, float], share: float) -> list[str]:
    """The words of highest weight, as many as it takes for the others to weigh less than ``share`` of all."""
    order = sorted(set(words), key=lambda w: (-weight[w], w))
    total, out = sum(weight[w] for w in order), []
    while sum(weight[w] for w in order[len(out) :]) >= share * total * (1 - 1e-9) and len(out) < len(order):
        out.append(order[len(out)])
    return out


def _share(words: list[str], key: str, weight: dict[str, float], rules: Rules) -> Column:
    """The largest share of a template's weight that stands in place, over all places where it counts as found; or 0."""
    phrase = key.split()
    key_at = [k for k in range(len(words)) if words[k : k + len(phrase)] == phrase][0]
    own = sorted(set(words))
    more = [w for w in own if w not in phrase]

    def part(of: list[str], start: Column) -> Column:
        total = sum(weight[w] for w in of)
        return F.least(reduce(add, [F.when(_in_place(words, w, start), F.lit(weight[w] / total)).otherwise(0.0) for w in of]), F.lit(1.0))

    shares = F.transform(_proposed(words, looked_up(words, weight, rules.share)), lambda s: F.struct(s.alias("at"), part(own, s).alias("share")))
    shares = F.filter(shares, lambda s: s["share"] >= rules.share)
    found = F.filter(shares, lambda s: _stands(phrase, s["at"] + key_at) & (part(more, s["at"]) >= rules.beyond if more else F.lit(True)))
    return F.when(F.array_contains("keys", F.lit(key)), F.coalesce(F.array_max(F.transform(found, lambda s: s["share"])), F.lit(0.0))).otherwise(0.0)


def scanned(index: DataFrame, weight: dict[str, float], rules: Rules = Rules()) -> DataFrame:
    """``id, n_words, places, base_labels, labels, score`` for every row of a stored ``indexed`` table.

    ``places`` are (start, length) of each base phrase; ``labels`` also hold those of the templates found; ``score`` is the
    largest share of a found template's weight in place, 1 for a base phrase, 0 without any label.
    """
    def places(phrase: str) -> Column:
        words = phrase.split()
        rarest = max(words, key=lambda w: (weight[w], w))
        starts = F.filter(_proposed(words, [rarest]), lambda s: _stands(words, s))
        return F.transform(_with_words_of(phrase, starts), lambda s: F.struct(s.alias("start"), F.lit(len(words)).alias("length")))

    base = [places(phrase) for _, phrase in BASE]
    shares = [_share(text.split(), key, weight, rules) for _, text, key in TEMPLATES]
    step = index.select("id", "n_words", F.array(*base).alias("base"), F.array(*shares).alias("shares"))

    labels = [F.when(F.size(F.col("base")[k]) > 0, F.lit(label)) for k, (label, _) in enumerate(BASE)]
    more = [F.when(F.col("shares")[k] > 0, F.lit(label)) for k, (label, _, _) in enumerate(TEMPLATES)]
    named = lambda parts: F.array_sort(F.array_distinct(F.filter(F.array(*parts), lambda v: v.isNotNull())))
    return step.select(
        "id", "n_words", F.flatten("base").alias("places"), named(labels).alias("base_labels"), named(labels + more).alias("labels"),
        F.when(F.size(F.flatten("base")) > 0, F.lit(1.0)).otherwise(F.array_max("shares")).alias("score"),
    )


def scan(docs: DataFrame, rules: Rules = Rules(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``scanned`` with weights over all of ``docs``.

    Null and empty texts have no words; repeated rows and null ids keep a row each; no rows give no rows; other columns
    are not read.
    """
    index = materialise(indexed(docs, id_col, text_col), "licence-index")
    return scanned(index, weights(index), rules)
