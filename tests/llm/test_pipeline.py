"""The pipeline's stages on a small corpus with planted cases, each against what it must keep."""

import random
from collections import defaultdict

import pytest

import corpus_pipeline
from ledgerloom.llm import stages

from .test_dedup import slow_components, slow_fingerprint

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    """Clean texts, toxic ones, copies in groups of up to twenty, near copies of long texts, an empty and a null text."""
    rng = random.Random(8)
    words = ["bora", "tilu", "meka", "soni", "rafe", "duna", "kelo", "pari", "vust", "hint"]
    say = lambda n: " ".join(rng.choice(words) + str(rng.randrange(50)) for _ in range(n))
    rows, toxic = [], set()
    for k in range(150):
        bad = k % 10 == 0
        text = say(60) + (" you worthless moron scum " + say(5) if bad else "")
        if bad:
            toxic.add(len(rows))
        rows.append(text)
    long_text = say(4000)
    rows += [rows[1]] * 20 + [long_text, long_text + " more", "also " + long_text] + ["", None]
    docs = [(k, t, "en", f"s{0 if k % 3 else k % 4}", len(t or "")) for k, t in enumerate(rows)]
    folder = str(tmp_path_factory.mktemp("corpus"))
    spark.createDataFrame(docs, SCHEMA).repartition(4).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(k, 1, int(k in toxic)) for k in range(150)], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return folder, docs, toxic


def test_stages(spark, corpus, tmp_path):
    folder, rows, toxic = corpus
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    kept = [r[:2] for r in rows]
    for number, (name, stage) in enumerate(corpus_pipeline.STAGES[:4]):
        out = stage(spark, docs, folder)
        assert out.columns == docs.columns, name
        out.write.parquet(str(tmp_path / str(number)))
        docs = spark.read.parquet(str(tmp_path / str(number)))
        got = sorted((r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()) if number < 3 else None
        if number == 0:
            kept = [r for r in kept if r[0] not in toxic]
        elif number == 1:
            last = {t or "": k for k, t in kept}
            kept = [(k, t) for k, t in kept if last[t or ""] == k]
        elif number == 2:
            prints = {k: slow_fingerprint(t) for k, t in kept}
            label = slow_components(sorted(set(prints.values())))
            groups = defaultdict(list)
            for k, f in prints.items():
                groups[label[f]].append(k)
            kept = [(k, t) for k, t in kept if k == min(groups[label[prints[k]]])]
        if got is not None:
            assert [k for k, _ in got] == sorted(k for k, _ in kept), name
    assert {r.doc_id for r in docs.select("doc_id").collect()} == {k for k, _ in kept}
    placed = stages.packed(spark, docs, folder).collect()
    sequences = defaultdict(list)
    for r in placed:
        sequences[r.sequence_id].append((r.offset, r.length))
    assert sum(r.piece == 0 for r in placed) == docs.count()
    for own in sequences.values():
        own.sort()
        assert [o for o, _ in own] == [sum(n for _, n in own[:k]) for k in range(len(own))] and sum(n for _, n in own) <= 2048


def test_run_is_the_stages_in_turn(spark, corpus):
    folder, *_ = corpus
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "exact dedup", "SimHash near-dedup", "temperature mixing", "vector packing"]
    out = corpus_pipeline.run(spark, folder)
    assert out.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"] and out.count() > 0
