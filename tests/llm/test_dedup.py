import hashlib
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from ledgerloom.llm import exact_dedup, simhash

from .conftest import docs_of, edge_rows


def decided(df):
    return sorted(((r.id, bytes(r.digest), r.keep_id, r.group_size, r.kept) for r in df.collect()), key=str)


def expected(rows, digest):
    groups = defaultdict(list)
    for i, t in rows:
        groups[t or ""].append(i)
    out, seen = [], set()
    for i, t in rows:
        ids = groups[t or ""]
        keep = max((x for x in ids if x is not None), default=None)
        first = i == keep and (t or "") not in seen
        seen |= {t or ""} if first else set()
        out.append((i, digest(t or ""), keep, len(ids), first))
    return sorted(out, key=str)


def test_edge_rows(edge):
    rows = [(r[0], r[1]) for r in edge_rows()]
    assert decided(exact_dedup.decisions(edge)) == expected(rows, lambda t: hashlib.sha256(t.encode()).digest())


def test_state_across_many_batches(spark, tmp_path):
    rng = random.Random(1)
    rows = [(k, f"text {rng.randrange(60)}") for k in range(400)]
    docs_of(spark, rows).repartition(8).write.parquet(str(tmp_path / "d"))
    got = exact_dedup.decisions(spark.read.parquet(str(tmp_path / "d")), batch_bytes=1)
    assert decided(got) == expected(rows, lambda t: hashlib.sha256(t.encode()).digest())


def test_equal_digests_of_different_texts_are_told_apart(spark):
    rows = [(k, f"text {k % 9}") for k in range(40)]
    short = lambda text: F.unhex(F.lpad(F.hex(F.crc32(text.cast("binary")) % 3), 2, "0"))
    got = decided(exact_dedup.decisions(docs_of(spark, rows), digest=short))
    want = expected(rows, lambda t: bytes([zlib.crc32(t.encode()) % 3]))
    assert got == want


def test_no_rows(spark):
    empty = docs_of(spark, [])
    assert exact_dedup.decisions(empty).count() == 0
    assert exact_dedup.without_copies(empty).columns == empty.columns


def test_rows_that_stay_keep_their_columns(edge):
    kept = exact_dedup.without_copies(edge)
    assert kept.schema == edge.schema
    texts = [r.text or "" for r in kept.collect()]
    assert sorted(texts) == sorted({r[1] or "" for r in edge_rows()})


def slow_fingerprint(text, shingle=3):
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or "")) if w]
    parts = [" ".join(words[k : k + shingle]) for k in range(len(words) - shingle + 1)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(p.encode(), 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


@pytest.mark.parametrize("text", ["", " \n", "One", "a b", "A b C", "x y z w x y z w", "É É é 漢 字 b c", "word " * 500])
def test_fingerprint(text):
    assert simhash.fingerprint(text) == slow_fingerprint(text)


def slow_components(values, distance=2):
    label = {v: v for v in values}
    changed = True
    while changed:
        changed = False
        for a in values:
            for b in values:
                if (a ^ b).bit_count() <= distance and label[a] != label[b]:
                    label[a] = label[b] = min(label[a], label[b])
                    changed = True
    return label


def grouped(labels):
    out = defaultdict(set)
    for member, label in labels.items():
        out[label].add(member)
    return sorted(map(sorted, out.values()))


@pytest.mark.parametrize("hot", [0, 3, 130])
def test_links_equal_brute_force_whatever_the_route(spark, hot):
    rng = random.Random(5)
    values = {rng.getrandbits(64) for _ in range(60)}
    for v in list(values)[:25]:  # chains and dense balls
        for _ in range(rng.randrange(1, 8)):
            for _ in range(rng.randrange(1, 4)):
                v ^= 1 << rng.randrange(64)
            values.add(v)
    base = rng.getrandbits(64)
    values |= {base ^ (1 << a) for a in range(40)}
    signed = [int(np.uint64(v).view(np.int64)) for v in sorted(values)]
    fps = spark.createDataFrame([(v,) for v in signed], "fp long")
    pairs = simhash.links(fps, 2, hot=hot).collect()
    label = {v: v for v in signed}

    def root(v):
        while label[v] != v:
            v = label[v]
        return v

    for r in pairs:
        assert ((r.id_a ^ r.id_b) & (2**64 - 1)).bit_count() <= 2
        a, b = root(r.id_a), root(r.id_b)
        label[max(a, b)] = min(a, b)
    want = slow_components([v & (2**64 - 1) for v in signed])
    assert grouped({v & (2**64 - 1): root(v) for v in signed}) == grouped(want)


@pytest.mark.parametrize("partitions", [2, 3])
def test_thresholds_keep_every_near_pair(spark, partitions):
    rng = np.random.default_rng(2)
    values = rng.integers(0, 2**63, size=300, dtype=np.int64)
    fps = spark.createDataFrame([(int(v),) for v in values], "fp long")
    plan = simhash.make_plan(fps, 2, choices=(partitions,))
    assert sorted(b for p in plan.partitions for b in p) == list(range(64))
    unsigned = values.view(np.uint64)
    thresholds = simhash.allocated(plan, unsigned)
    assert (thresholds.sum(axis=1) == 2 - partitions + 1).all() and thresholds.min() >= -1
    for k in range(len(unsigned)):
        a, b = rng.choice(64, 2, replace=False)
        other = unsigned[k] ^ np.uint64(1 << int(a)) ^ np.uint64(1 << int(b))
        apart = [int(np.bitwise_count(simhash.packed(unsigned[k : k + 1], p) ^ simhash.packed(np.array([other]), p))[0]) for p in plan.partitions]
        assert any(d <= t for d, t in zip(apart, thresholds[k], strict=True))


def test_components_of_edge_rows(edge):
    rows = [(r[0], r[1]) for r in edge_rows()]
    got = sorted(((r.id, r.fp & (2**64 - 1), r.component_id) for r in simhash.components(edge).collect()), key=str)
    prints = [(i, slow_fingerprint(t)) for i, t in rows]
    label = slow_components(sorted({f for _, f in prints}))
    least = defaultdict(list)
    for i, f in prints:
        if i is not None:
            least[label[f]].append(i)
    assert got == sorted(((i, f, min(least[label[f]], default=None)) for i, f in prints), key=str)


def test_one_of_each_group_stays(spark):
    text = " ".join(f"w{k}" for k in range(3000))
    docs = docs_of(spark, [(5, text), (3, text + " more"), (9, "another text altogether it is"), (None, text)])
    kept = sorted((r.doc_id for r in simhash.one_of_each(docs).collect()), key=str)
    close = (slow_fingerprint(text) ^ slow_fingerprint(text + " more")).bit_count() <= 2
    assert kept == ([3, 9, None] if close else [3, 5, 9, None])
    assert simhash.one_of_each(docs_of(spark, [])).count() == 0


def test_a_row_is_not_dropped_for_another_text_of_its_id(spark):
    say = lambda letter: " ".join(f"{letter}{k}" for k in range(200))
    docs = docs_of(spark, [(1, say("a")), (2, say("a")), (2, say("b")), (7, say("c")), (7, say("d")), (9, say("d")), (7, say("d"))])
    kept = sorted((r.doc_id, r.text[0]) for r in simhash.one_of_each(docs).collect())
    assert kept == [(1, "a"), (2, "b"), (7, "c"), (7, "d"), (7, "d")]
