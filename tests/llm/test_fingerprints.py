"""Signatures, edited texts and classes against brute force."""

import hashlib
import random
from itertools import combinations

import numpy as np

from ledgerloom.llm import fingerprints, queries
from ledgerloom.llm.fingerprints import Plan, Shingles, Signer
from ledgerloom.session import materialise

from .conftest import docs_of, edge_rows


def shingle_set(text):
    words = (text or "").encode().split()
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4)))


def similarity(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def brute_classes(rows):
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    sets = [shingle_set(t) for _, t in rows]
    for i, j in combinations(range(len(rows)), 2):
        if similarity(sets[i], sets[j]) >= 0.8:
            parent[max(root(i), root(j))] = min(root(i), root(j))
    least = {}
    for i, (key, _) in enumerate(rows):
        if key is not None:
            least[root(i)] = min(key, least.get(root(i), key))
    return [least.get(root(i)) for i in range(len(rows))]


def some_rows(seed=0, n=150):
    rng = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(500)] + ["é漢", "ß"]
    say = lambda m: [rng.choice(vocabulary) for _ in range(m)]
    texts = [None, "", " \n", "one", "one two", "one  two", "a b c d e", "a b c d e f"]
    while len(texts) < n:
        words = say(rng.choice([8, 40, 120, 400]))
        texts.append(" ".join(words))
        for _ in range(rng.choice([0, 0, 1, 3])):
            new = list(words)
            for _ in range(rng.choice([0, 1, 2, 6])):
                new[rng.randrange(len(new))] = rng.choice(vocabulary)
            texts.append("\t".join(new))
    rows = [(k * 3, t) for k, t in enumerate(texts)]
    rng.shuffle(rows)
    return rows


def test_shingle_hashes_stand_for_shingles():
    texts = [(t or "").encode() for _, t in some_rows()]
    hashes, begin = Shingles(5).of(texts)
    meaning = {}
    for k, text in enumerate(texts):
        words = text.split()
        want = [tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))] if words else []
        got = hashes[begin[k] : begin[k + 1]].tolist()
        assert len(got) == len(want)
        for h, shingle in zip(got, want, strict=True):
            assert meaning.setdefault(h, shingle) == shingle
    assert len(set(meaning.values())) == len(meaning)
    alone = [Shingles(5).of([t])[0].tolist() for t in texts]
    assert [h for own in alone for h in own] == hashes.tolist()


def test_signatures_estimate_similarity():
    rng = np.random.default_rng(1)
    signer, errors = Signer(Plan()), []
    for _ in range(200):
        share = rng.random()
        common, own, other = (rng.integers(0, 2**63, k, dtype=np.uint64) for k in (int(400 * share) + 1, int(400 * (1 - share)) + 1, int(400 * (1 - share)) + 1))
        hashes = np.concatenate([common, own, common, other])
        signed = signer.sign(hashes, np.array([0, len(common) + len(own), len(hashes)]))
        errors.append(fingerprints.likeness(signed[0], signed[1]) - len(common) / (len(common) + len(own) + len(other)))
    assert abs(np.mean(errors)) < 0.01 and np.std(errors) < 0.045


def expected_edits(rows):
    ordered = sorted(rows, key=lambda r: r[0])
    out = []
    for k, (key, text) in enumerate(ordered):
        text, following = text or "", ordered[(k + 1) % len(ordered)][1] or ""
        half = len(text) // 2
        new = text[: len(text) - half] + following[:half]
        out.append((key, len(text), hashlib.sha256(new.encode()).hexdigest(), new, following))
    return out


def test_query_equals_brute_force_over_many_ranges(spark, tmp_path):
    rows = some_rows()
    docs_of(spark, rows).repartition(5).write.parquet(f"{tmp_path}/documents.parquet")
    before = spark.conf.get("spark.sql.shuffle.partitions"), spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "9")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        got = {r.doc_id: r for r in queries.op11_minhash_fingerprints(spark, str(tmp_path)).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before[0])
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before[1])
    assert len(got) == len(rows)
    assert {k: r.class_id for k, r in got.items()} == {k: c for (k, _), c in zip(rows, brute_classes(rows), strict=True)}
    signer, shingles = Signer(Plan()), Shingles(5)
    sign = lambda t: signer.sign(*shingles.of([t.encode()]))[0]
    texts = dict(rows)
    for key, size, digest, new, following in expected_edits(rows):
        row, own = got[key], sign(texts[key] or "")
        assert (row.n_chars, row.edited_sha256) == (size, digest)
        assert row.fingerprint == own.tobytes().hex() and row.edited_fingerprint == sign(new).tobytes().hex()
        assert row.near_edited == np.mean(own == sign(new)) and row.near_next == np.mean(own == sign(following))


def test_large_bucket_with_several_components_loses_no_link(spark):
    """Members of a bucket that are far from its head, in groups of their own, in tiles of four."""
    rng = random.Random(2)
    shared = [f"s{k}" for k in range(60)]
    rows = []
    for group in range(12):
        own = [f"g{group}x{k}" for k in range(60)]
        for copy in range(4):
            new = own[:]
            new[rng.randrange(60)] = f"c{copy}"
            rows.append((len(rows), " ".join(shared + new)))
    plan = Plan(bands=8, rows=1, permutations=128, tile=4)
    docs = docs_of(spark, rows)
    signed = materialise(fingerprints.signatures(docs, plan), "test-signed")
    got = {r.id: r.class_id for r in fingerprints.classes(docs, signed, plan).collect()}
    assert got == dict(zip((k for k, _ in rows), brute_classes(rows), strict=True))
    assert len(set(got.values())) == 12


def test_edge_rows_repeats_and_no_rows(spark, edge):
    rows = fingerprints.found(edge).collect()
    assert len(rows) == len(edge_rows())
    by_text = {}
    for r in rows:
        by_text.setdefault((r.id, r.n_chars), set()).add((r.fingerprint, r.class_id))
    assert all(len(own) == 1 for own in by_text.values())
    assert {r.class_id for r in rows if r.id in (0, 1, 2)} == {0} and {r.class_id for r in rows if r.id is None} == {None}
    assert {r.class_id for r in rows if r.id in (6, 40)} == {6}
    assert all(r.near_next is not None and r.edited_fingerprint is not None for r in rows)
    assert fingerprints.found(edge.limit(0)).count() == 0
    alone = fingerprints.found(edge.where("doc_id = 6").limit(1)).collect()
    assert len(alone) == 1 and alone[0].near_next == 1.0
