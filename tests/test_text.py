import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerloom.functions import parsing
from ledgerloom.functions import text as T
from ledgerloom.functions.hashing import MODULUS, coefficients, gram_hashes, grams_of, hash_grams, token_hash
from ledgerloom.functions.similarity import jaccard
from ledgerloom.operators.signatures import hashed, shingle_columns, with_signatures
from ledgerloom.session import spread


def one(spark, expression, **values):
    schema = ", ".join(f"{k} string" for k in values)
    return spark.createDataFrame([tuple(values.values())], schema).select(expression.alias("x")).first()["x"]


def test_title_cleaning(spark):
    cases = {
        "Corrigendum - e-Tender - Supply of Pumps [PWD/12] - North District": "supply of pumps",
        "TENDER NOTICE: Road works": "road works",
        "NIT for Check dam": "check dam",
        "Road 33/11 kV - Phase 2": "road 33/11 kv - phase 2",
        "  [a] [b]  ": "",
        "": "",
    }
    for raw, clean in cases.items():
        assert one(spark, T.clean_title(F.col("t")), t=raw) == clean
    assert one(spark, T.clean_title(F.col("t")), t=None) == ""


def test_body_cleaning(spark):
    national = f"{T.NATIONAL_PREAMBLE[0]} legal\nwords {T.NATIONAL_PREAMBLE[1]} more\n\nReal Work"
    state = f"{T.STATE_PREAMBLE[0]} x {T.STATE_PREAMBLE[1]} y\n{T.PREAMBLE_RULE}Core"
    cases = {
        national: "Real Work".lower(),
        state: "core",
        "Build it. DISCLAIMER: not us\nat all": "build it. ",
        "see NPAS-2024-0001234 and ref-2024-00912, TN-000412/2024.": "see  and , .",
        "ids 12345 67890 1234 123456789": "ids   1234 123456789",
        "reference tender": " tender",
        "préref1 x": "préref1 x",
    }
    for raw, clean in cases.items():
        assert one(spark, T.clean_body(F.col("t")), t=raw) == clean


def test_tokens_skip_parts_of_longer_words(spark):
    assert one(spark, T.tokens(F.col("t")), t="Él été pump_2 Pump-2, 33/11 áb") == ["pump", "2", "33", "11", "a", "b"]


def test_grams_of_short_and_empty_texts(spark):
    assert one(spark, T.word_grams(T.tokens(F.col("t")), 3), t="a b a b a b") == ["a b a", "b a b"]
    assert one(spark, T.word_grams(T.tokens(F.col("t")), 3), t="a b") == ["a b"]
    assert one(spark, T.word_grams(T.tokens(F.col("t")), 3), t="é") == []


def test_empty_sets_are_not_similar(spark):
    empty = F.array().cast("array<string>")
    assert one(spark, jaccard(empty, empty), t="x") == 0.0
    assert one(spark, jaccard(F.split("t", " "), F.split(F.lit("b c"), " ")), t="a b") == 1 / 3


def test_common_prefix(spark):
    assert one(spark, T.common_prefix_length(F.col("a"), F.col("b")), a="abcdef", b="abcxef") == 3
    assert one(spark, T.common_prefix_length(F.col("a"), F.col("b")), a="abc", b="abcdef") == 3
    assert one(spark, T.common_prefix_length(F.col("a"), F.col("b")), a="", b="x") == 0


def test_token_hash_is_the_first_eight_md5_bytes(spark):
    words = ["a b c", "x", "road works north", "éa", ""] + [f"w{i}" for i in range(200)]
    rows = spark.createDataFrame([(w,) for w in words], "w string").select("w", token_hash(F.col("w")).alias("h"))
    for row in rows.collect():
        digest = hashlib.md5(row["w"].encode()).digest()
        assert row["h"] == int.from_bytes(digest[:8], "little") % (1 << 61)


def test_signature_against_plain_integers(spark):
    notices = spark.createDataFrame(
        [(1, "p", "Road works north", "build a road to the north side"), (2, "p", "", "x"), (3, "q", "é", "")],
        "notice_id bigint, portal_id string, title string, body string",
    )
    for row in with_signatures(hashed(notices)).collect():
        for place, field in enumerate(("title", "body")):
            values = row[f"{field}_set"]
            a, b = coefficients(field)
            expected = [
                min((((int(a[i]) * x + int(b[i])) % (1 << 64)) % MODULUS for x in values), default=0) for i in range(64)
            ]
            assert row["signature"][place::2] == expected


def test_coefficients_are_fixed():
    a, b = coefficients("title")
    assert a.dtype == np.uint64 and len(a) == 512 and bool((a & np.uint64(1)).all())
    assert not np.array_equal(a, coefficients("body")[0])
    first = {n: [[int(v) for v in part[:3]] for part in coefficients(n)] for n in ("title", "body")}
    assert first == {
        "title": [[2297359619001564597, 1396682528897996047, 1973689801170867273], [1064902540256928541, 2141000865387175162, 834137264395293700]],
        "body": [[1277741186154202589, 1830179236967386335, 2066822225386588533], [1035772707314828550, 1035191704480820331, 1041103688052929574]],
    }


def test_dates_and_money(spark):
    day = "2024-03-12"
    for written in ("12-03-2024", "12/03/2024", "12.03.2024", "2024-03-12", "12 Mar 2024", "Mar 12, 2024", "12-Mar-24"):
        assert str(one(spark, parsing.parse_date(F.col("t")), t=written)) == day
        assert one(spark, parsing.date_mentions(F.col("t")), t=f"closing {written}, noon") == [written]
    assert one(spark, parsing.parse_date(F.col("t")), t="31-02-2024") is None
    for written in ("Rs. 4,50,00,000/-", "Rs. 450.00 lakh", "INR 4.500 Cr", "45000000", "RUPEES 4,50,00,000 ONLY"):
        assert one(spark, parsing.parse_money(F.col("t")), t=written) == 45_000_000


def test_rows_of_one_row_group_are_dealt_to_every_core(spark, tmp_path):
    path = str(tmp_path / "one.parquet")
    spark.range(4000).select("id", F.md5(F.col("id").cast("string")).alias("text")).coalesce(1).write.parquet(path)
    splits = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
        spark.conf.set("spark.sql.files.openCostInBytes", "0")
        one = spark.read.parquet(path)
        cores = spark.sparkContext.defaultParallelism
        assert one.rdd.getNumPartitions() >= cores
        held = spread(one).groupBy(F.spark_partition_id()).count().collect()
        assert len(held) > cores // 2 and max(r["count"] for r in held) <= 2 * 4000 // cores
        assert sorted(r["id"] for r in spread(one).collect()) == list(range(4000))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", splits)
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_shingles_over_batches_are_those_of_the_expressions(spark):
    texts = [(0, "p", "Tender Notice: A b c", "one two three four two three four"), (1, "p", "x", "one"), (2, None, None, None), (3, "q", "", "É a1 _b c")]
    rows = spark.createDataFrame(texts, "notice_id bigint, portal_id string, title string, body string")
    for cleaned in (True, False):
        title, body = shingle_columns(cleaned)
        stated = {r["notice_id"]: r for r in rows.select("notice_id", hash_grams(title).alias("t"), hash_grams(body).alias("b")).collect()}
        for row in hashed(rows, cleaned).collect():
            assert (row["title_set"], row["body_set"]) == (stated[row["notice_id"]]["t"], stated[row["notice_id"]]["b"])


@pytest.mark.parametrize("n", [1, 2, 3])
def test_hashes_of_many_texts_at_once_are_those_of_each_gram(n):
    rng = random.Random(n)
    words = ["a" * k for k in (1, 2, 16, 17, 18, 27, 28, 53, 54, 55, 56, 57, 64, 119, 130)] + [f"w{k}" for k in range(60)] + ["\u00e9\u00df", "\u4e16"]
    texts = ["", None, "one", "one two", "a b a b a b", *(" ".join(rng.choices(words, k=rng.randrange(60))) for _ in range(600)), ""]
    stated = [[int.from_bytes(hashlib.md5(g.encode()).digest()[:8], "little") & MODULUS for g in grams_of(t, n)] for t in texts]
    assert [h.tolist() for h in gram_hashes(texts, n)] == stated and gram_hashes([], n) == []
