"""Mixing, sharding and packing."""

import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledgerloom.llm import mixing, packing, sharding

from .conftest import docs_of, edge_rows

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def sources(spark, sizes, words=3):
    rows = [(1000 * k + i, " ".join(["w"] * words), "en", name, 0) for k, (name, n) in enumerate(sizes.items()) for i in range(n)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")


def totals_of(spark, docs):
    return mixing.source_totals(mixing._thin(docs, "doc_id", "text", "source"))


def test_exponent_meets_the_repetition_limit(spark):
    docs = sources(spark, {"a": 400, "b": 50, "c": 100})
    a = mixing.exponent(totals_of(spark, docs), mixing.Target(repetitions=2.0))
    assert a == math.ceil((1 - math.log(2) / math.log(8)) * 10_000) / 10_000
    assert mixing.exponent(totals_of(spark, docs), mixing.Target(repetitions=8.0)) == 0.0
    assert mixing.exponent(totals_of(spark, docs), mixing.Target(repetitions=1.0)) == 1.0


@pytest.mark.parametrize("entropy", [1.3, 1.5])
def test_exponent_meets_the_entropy(spark, entropy):
    sizes = {"a": 400, "b": 50, "c": 100}
    a = mixing.exponent(totals_of(spark, sources(spark, sizes)), mixing.Target(entropy=entropy))

    def bits(x):
        p = np.array(list(sizes.values())) / 550
        w = p**x / (p**x).sum()
        return -(w * np.log2(w)).sum()

    assert bits(a) <= entropy + 1e-9 and (a == 0 or bits(a - 2e-4) > entropy)


def test_blocks_are_permutations_within_the_budget(spark):
    docs = sources(spark, {"a": 400, "b": 50, "c": 100})
    rows = mixing.mixed(docs, mixing.Target(repetitions=2.0)).collect()
    taken = defaultdict(list)
    for r in rows:
        taken[r.source, r.block].append((r.start, r.id, r.tokens, r.quota))
    assert len(taken["a", 0]) == 400 and ("a", 1) not in taken
    assert len(taken["b", 0]) == 50 and 45 <= len(taken["b", 1]) <= 50
    for (source, block), picks in taken.items():
        picks.sort()
        starts = [p[0] for p in picks]
        size = {"a": 400, "b": 50, "c": 100}[source] * 3
        assert starts == [block * size + 3 * k for k in range(len(picks))] and starts[-1] < picks[0][3]
        assert len({p[1] for p in picks}) == len(picks)
    assert [p[1] for p in sorted(taken["b", 0])] != [p[1] for p in sorted(taken["b", 1])]


def test_realised_rows_are_the_picked_ones(spark, edge):
    some = sources(spark, {"a": 90, "b": 20, "c": 31})
    for docs, target in ((some, mixing.Target(1.7)), (edge, mixing.Target(1.7)), (some, mixing.Target(1.2, budget=240))):
        picks = sorted((r.id for r in mixing.mixed(docs, target).collect()), key=str)
        out = mixing.realised(docs, target)
        assert out.schema == docs.schema
        assert abs(len(picks) - out.count()) <= 1  # a repeated row at the very edge of the budget
        assert set(picks) == {r.doc_id for r in out.collect()}


def test_mixing_of_edge_rows_and_of_none(spark, edge):
    rows = mixing.mixed(edge, mixing.Target(repetitions=3.0)).collect()
    assert {r.id for r in rows} == {r[0] for r in edge_rows()}
    assert {r.unnamed for r in rows} == {True, False}
    assert mixing.mixed(docs_of(spark, []), mixing.Target()).count() == 0


def test_budget_and_repetitions_together(spark):
    docs = sources(spark, {"a": 400, "b": 50})
    rows = mixing.mixed(docs, mixing.Target(repetitions=1.5, budget=900)).groupBy("source").agg(F.sum("tokens").alias("t")).collect()
    got = {r.source: r.t for r in rows}
    assert got["b"] <= 1.5 * 150 + 3 and abs(sum(got.values()) - 900) <= 6


def test_shards_move_into_the_new_one_only(spark):
    docs = docs_of(spark, [(k, "x" * (k % 5)) for k in range(4000)])
    rows = sharding.sharded(docs, [1.0] * 16, [1.0] * 17).collect()
    assert all(r.grown_shard in (r.shard, 16) for r in rows)
    moved = sum(r.grown_shard == 16 for r in rows)
    assert abs(moved - 4000 / 17) < 5 * math.sqrt(4000 / 17)
    slots = defaultdict(list)
    for r in rows:
        slots[r.shard].append(r.slot)
        assert r.size == r.id % 5 + 1 and r.text_crc32 == zlib.crc32(b"x" * (r.id % 5))
    assert set(slots) == set(range(16)) and all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_shares_follow_the_weights(spark):
    docs = docs_of(spark, [(k, "") for k in range(6000)])
    n = {r.shard: r["n"] for r in sharding.sharded(docs, [3.0, 1.0, 2.0]).groupBy("shard").agg(F.count("*").alias("n")).collect()}
    assert all(abs(n[k] - 1000 * w) < 5 * math.sqrt(1000 * w) for k, w in enumerate([3, 1, 2]))


def test_sharding_of_edge_rows_and_of_none(spark, edge):
    rows = sharding.sharded(edge, [1.0] * 4, [1.0] * 5).collect()
    assert sorted(map(str, (r.id for r in rows))) == sorted(str(r[0]) for r in edge_rows())
    by_size = sorted(len((r[1] or "").encode()) + 1 for r in edge_rows())
    assert sorted(r.size for r in rows) == by_size
    slots = defaultdict(list)
    for r in rows:
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert sharding.sharded(docs_of(spark, []), [1.0]).count() == 0


ENCODER = packing.Encoder(TOKENIZER)


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet=st.one_of(st.characters(exclude_categories=["Cs"]), st.sampled_from(list(".,_ \t\ń \x1c'sİßΣσ1aB."))), max_size=60))
def test_ids_are_the_tokenizers(text):
    want = ENCODER.tokenizer.encode(text, add_special_tokens=False).ids
    assert np.frombuffer(ENCODER.encode([text])[0], dtype="<u4").tolist() == want


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 60), max_size=80), st.sampled_from(["norm", "dot"]))
def test_best_fit_keeps_every_capacity(lengths, rule):
    capacity = packing.Capacity(tokens=64, documents=5, attention=64 * 64, rule=rule)
    lengths = np.array(sorted(lengths, reverse=True), dtype=np.int64)
    sequence, offset = packing.best_fit(lengths, capacity)
    for s in set(sequence.tolist()):
        own = sorted(zip(offset[sequence == s].tolist(), lengths[sequence == s].tolist(), strict=True))
        assert len(own) <= 5 and sum(n * n for _, n in own) <= 64 * 64 and sum(n for _, n in own) <= 64
        assert [o for o, _ in own] == [sum(n for _, n in own[:k]) for k in range(len(own))]


def test_attention_cost_binds():
    capacity = packing.Capacity(tokens=64, documents=64, attention=64 * 64)
    tight = packing.Capacity(tokens=64, documents=64, attention=1200)
    lengths = np.array([24] * 8)
    assert len(set(packing.best_fit(lengths, capacity)[0].tolist())) == 4
    assert len(set(packing.best_fit(lengths, tight)[0].tolist())) == 4
    assert len(set(packing.best_fit(lengths, packing.Capacity(64, 64, 600))[0].tolist())) == 8


def test_packing_round_trip(edge):
    capacity = packing.Capacity(tokens=128, attention=128 * 128)
    rows = packing.pack(edge, TOKENIZER, capacity, with_ids=True).collect()
    texts = defaultdict(list)
    for r in edge_rows():
        texts[r[0]].append(ENCODER.tokenizer.encode(r[1] or "", add_special_tokens=False).ids + [0])
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        assert r.crc == zlib.crc32(np.array(r.ids, dtype="<u4").tobytes()) and r.length == len(r.ids)
        pieces[r.id].append((r.start, r.piece, tuple(r.ids)))
        sequences[r.sequence].append((r.offset, r.length))
    for key, wholes in texts.items():
        want = sorted((s, k, tuple(ids[s : s + 128])) for ids in wholes for k, s in enumerate(range(0, len(ids), 128)))
        assert sorted(pieces[key]) == want
    for own in sequences.values():
        own.sort()
        assert [o for o, _ in own] == [sum(n for _, n in own[:k]) for k in range(len(own))] and sum(n for _, n in own) <= 128


def test_packing_of_many_groups_and_of_none(spark):
    cut = spark.range(3000).select(F.col("id"), F.lit(0).alias("piece"), F.lit(0).cast("long").alias("start"), (F.col("id") % 97 + 1).alias("length"), F.lit(0).cast("long").alias("crc"))
    capacity = packing.Capacity(tokens=100, documents=100, attention=10_000)
    total = cut.agg(F.sum("length")).first()[0]
    n = packing.packed(cut, capacity, group_rows=500).select("sequence").distinct().count()
    assert n <= 1.08 * total / 100
    assert packing.pack(docs_of(spark, []), TOKENIZER).count() == 0


def test_attention_capacity_binds_through_pack(spark):
    docs = docs_of(spark, [(k, "the cat sat " * (k % 40)) for k in range(200)])
    wide, tight = packing.Capacity(tokens=100, documents=100), packing.Capacity(tokens=100, documents=100, attention=2_600)
    assert (wide.piece, tight.piece) == (100, 50)
    used = {}
    for capacity in (wide, tight):
        cost, tokens = Counter(), Counter()
        for r in packing.pack(docs, TOKENIZER, capacity).collect():
            cost[r.sequence] += r.length**2
            tokens[r.sequence] += r.length
        assert max(cost.values()) <= capacity.attention and max(tokens.values()) <= 100
        used[capacity] = len(cost)
    assert used[tight] > 1.2 * used[wide]


def test_two_generations_remember_common_chunks(monkeypatch):
    monkeypatch.setattr(packing, "REMEMBERED", 3)
    encoder = packing.Encoder(TOKENIZER)
    for text in ["the cat, sat.", "a_, b", "it's the cat... the end. ", "the q r s t u v", "the cat, q", "naïve, «été». ü", ",, ,.", ". a, "]:
        want = encoder.tokenizer.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(encoder.encode([text])[0], dtype="<u4").tolist() == want
        assert len(encoder.young) <= 3 + 8 and len(encoder.old) <= 3 + 8
