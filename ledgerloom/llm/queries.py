"""The named queries of this subpackage and their SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm import collocations, exact_dedup, fingerprints, language, licenses, mixing, neighbours, packing, periodic, personal, sharding, simhash, toxicity
from ledgerloom.llm.common import id_residue, table, whole

Query = Callable[[SparkSession, str], DataFrame]


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.decisions(table(spark, sf_dir, "documents")).select(
        F.col("id").alias("doc_id"), "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256")
    )


def op2_temperature_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mix = mixing.mixed(table(spark, sf_dir, "documents"), mixing.Target(repetitions=1.5))
    return mix.select(
        F.col("id").alias("doc_id"), F.when(~F.col("unnamed"), F.col("source")).alias("source"), "block", F.col("tokens").alias("n_tokens"),
        "start", "quota", (F.col("start") / F.col("quota")).alias("place"),
    )


def op3_multiprobe_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = neighbours.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, k=10)
    return found.select("query_id", "rank", F.col("id").alias("vec_id"), "score")


def op4_rendezvous_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = sharding.sharded(table(spark, sf_dir, "documents"), [1.0] * 16, [1.0] * 17)
    return out.select(F.col("id").alias("doc_id"), "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")


def op5_semi_markov_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    joined = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return personal.found(docs, personal.learn(docs)).select(
        F.col("id").alias("doc_id"), *[count(kind) for kind in personal.KINDS], F.sha2(joined("base"), 256).alias("base_sha256"), joined("spans").alias("spans")
    )


def op6_vector_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed_columns(packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json")))


def packed_columns(placed: DataFrame) -> DataFrame:
    return placed.select(
        F.col("id").alias("doc_id"), "piece", "start", "length", F.col("crc").alias("ids_crc32"), F.col("sequence").alias("sequence_id"), "offset"
    )


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    starts = F.transform("places", lambda p: p["start"].cast("long"))
    return licenses.scan(table(spark, sf_dir, "documents")).select(
        F.col("id").alias("doc_id"), "n_words", F.size("places").cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"), F.array_max(starts).alias("last_word"),
        F.array_join("base_labels", ",").alias("base_labels"), F.array_join("labels", ",").alias("labels"), "score",
    )


def op8_cross_parsing_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return language.identified(docs, language.learn(docs)).select(
        F.col("id").alias("doc_id"), (id_residue("id", 4) == 2).alias("held_out"), "lang_pred", "score"
    )


def op9_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.components(table(spark, sf_dir, "documents"), shingle=3, distance=2).select(
        F.col("id").alias("doc_id"), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.learn(docs, table(spark, sf_dir, "labels"))
    return toxicity.scored(docs, model).select(
        "doc_id", (id_residue("doc_id", 5) == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


def op11_minhash_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = fingerprints.found(table(spark, sf_dir, "documents"))
    text = lambda name: F.lower(F.hex(name)).alias(name)
    return found.select(
        F.col("id").alias("doc_id"), "n_chars", text("edited_sha256"), text("fingerprint"), text("edited_fingerprint"), "near_edited", "near_next", "class_id"
    )


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic.found(with_periods(table(spark, sf_dir, "documents"))).withColumn("best", periodic.strongest(F.col("runs")))
    line = lambda r: F.concat_ws(",", *[r[c].cast("string") for c in ("start", "length", "period")])
    lines = F.array_join(F.transform("runs", lambda r: F.concat(line(r), F.lit("\n"))), "")
    return found.select(
        F.col("id").alias("doc_id"), F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"), F.sha2(lines, 256).alias("runs_sha256"), F.sha2("text", 256).alias("collapsed_sha256"),
    )


def with_periods(docs: DataFrame) -> DataFrame:
    """The documents, those whose id's checksum ends in 0 with a tail that repeats itself."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.regexp_extract_all(whole("text"), F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))
    step = docs.select("doc_id", "text", h.alias("h"), F.when(h % 10 == 0, words).alias("words")).withColumn("n", F.size("words"))
    step = step.selectExpr("*", "cast((h div 10) % n as int) as a", "cast(1 + (n - (h div 10) % n) div (3 + (h div 10) % 8) as int) as p")
    tail = F.transform("words", lambda w, i: F.get("words", F.when(i < F.col("a"), i).otherwise(F.col("a") + (i - F.col("a")) % F.col("p"))))
    return step.select("doc_id", F.when(F.col("n") > 0, F.array_join(tail, " ")).otherwise(F.col("text")).alias("text"))


def op13_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    best = collocations.mined(table(spark, sf_dir, "documents"), least=100, longest=5, first=2000)
    return best.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


QUERIES: dict[str, Query] = {
    "op1_exact_dedup": op1_exact_dedup,
    "op2_temperature_mixing": op2_temperature_mixing,
    "op3_multiprobe_neighbours": op3_multiprobe_neighbours,
    "op4_rendezvous_sharding": op4_rendezvous_sharding,
    "op5_semi_markov_pii": op5_semi_markov_pii,
    "op6_vector_packing": op6_vector_packing,
    "op7_license_scan": op7_license_scan,
    "op8_cross_parsing_language": op8_cross_parsing_language,
    "op9_simhash_near_dedup": op9_simhash_near_dedup,
    "op10_toxicity": op10_toxicity,
    "op11_minhash_fingerprints": op11_minhash_fingerprints,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_phrase_collocations": op13_phrase_collocations,
}

ORACLES: dict[str, str] = {
    "op1_exact_dedup": """
        SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
               doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
        FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
    """,
    "op2_temperature_mixing": r"""
        WITH rows AS (
            SELECT doc_id, source, greatest(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')), 1)::BIGINT AS n_tokens FROM documents
        ), totals AS (
            SELECT source, sum(n_tokens)::BIGINT AS total FROM rows GROUP BY source
        ), bounds AS (
            SELECT max(total)::DOUBLE AS most, max(total)::DOUBLE / min(total) AS spread FROM totals
        ), exponent AS (
            SELECT most, CASE WHEN spread <= 1.5 THEN 0 ELSE ceil((1 - ln(1.5) / ln(spread)) * 10000) / 10000 END AS a FROM bounds
        ), quotas AS (
            SELECT source, total, round(total * pow(most / total, 1 - a))::BIGINT AS quota FROM totals, exponent
        ), blocks AS (
            SELECT doc_id, r.source, n_tokens, total, quota, unnest(range(ceil(quota / total)::BIGINT))::INT AS block
            FROM rows r JOIN quotas q ON r.source IS NOT DISTINCT FROM q.source
        ), placed AS (
            SELECT doc_id, source, block, n_tokens, quota, (block * total + coalesce(sum(n_tokens) OVER (
                PARTITION BY source, block ORDER BY md5('0:' || block || ':' || coalesce(doc_id::VARCHAR, '')), n_tokens ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING
            ), 0))::BIGINT AS start FROM blocks
        )
        SELECT *, start / quota AS place FROM placed WHERE start < quota
    """,
    "op4_rendezvous_sharding": """
        WITH crc AS (
            SELECT list(list_reduce(list_prepend(i, range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END) ORDER BY i) AS entries
            FROM range(256) t(i)
        ), keyed AS (
            SELECT doc_id, coalesce(text, '') AS text, coalesce(doc_id::VARCHAR, '') AS key FROM documents
        ), draws AS (
            SELECT key, k, -ln((('0x' || substr(md5(key || ':' || (k // 4)), 1 + 8 * (k % 4), 8))::BIGINT + 0.5::DOUBLE) / 4294967296::DOUBLE) AS draw
            FROM (SELECT DISTINCT key FROM keyed), range(17) t(k)
        ), won AS (
            SELECT key, arg_min(k, draw) FILTER (k < 16) AS shard, arg_min(k, draw) AS grown FROM draws GROUP BY key
        )
        SELECT doc_id, (octet_length(encode(text)) + 1)::BIGINT AS size, xor(list_reduce(
                   list_prepend(4294967295, list_transform(regexp_extract_all(hex(encode(text)), '..'), lambda h: ('0x' || h)::BIGINT)),
                   lambda c, b: xor(c >> 8, entries[(xor(c, b) & 255) + 1])
               ), 4294967295)::BIGINT AS text_crc32, 'key' AS law, shard::INT AS shard,
               row_number() OVER (PARTITION BY shard ORDER BY substr(md5(keyed.key || ':-1'), 1, 3), doc_id) - 1 AS slot, grown::INT AS grown_shard
        FROM keyed JOIN won USING (key), crc
    """,
    "op13_phrase_collocations": r"""
        WITH pieces AS (
            SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM (
                SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
                    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]'
                )) AS piece FROM documents
            )
        ), totals AS (
            SELECT lang, sum(len(w))::BIGINT AS n FROM pieces GROUP BY lang
        ), grams AS (
            SELECT lang, m, array_to_string(w[i:i + m - 1], ' ') AS phrase
            FROM (SELECT lang, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM pieces, range(1, 6) t(m))
        ), f AS (
            SELECT lang, m, phrase, count(*) AS a FROM grams GROUP BY ALL HAVING count(*) >= 100
        ), cuts AS (
            SELECT lang, phrase, a, m, string_split(phrase, ' ') AS w, unnest(range(1, m)) AS k FROM f WHERE m >= 2
        ), scored AS (
            SELECT c.lang, c.phrase, c.m, c.a, l.a AS l, r.a AS r, n, (1000::HUGEINT * c.a * n // (l.a::HUGEINT * r.a))::BIGINT AS score,
                   row_number() OVER (PARTITION BY c.lang, c.phrase ORDER BY 1000::HUGEINT * c.a * n // (l.a::HUGEINT * r.a), k) AS nth
            FROM cuts c JOIN totals USING (lang)
            JOIN f l ON l.lang = c.lang AND l.phrase = array_to_string(c.w[1:k], ' ')
            JOIN f r ON r.lang = c.lang AND r.phrase = array_to_string(c.w[k + 1:], ' ')
        ), ranked AS (
            SELECT s.*, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM scored s
            WHERE nth = 1 AND NOT EXISTS (
                SELECT 1 FROM f g WHERE g.lang = s.lang AND g.m > s.m AND g.a >= s.a AND contains(' ' || g.phrase || ' ', ' ' || s.phrase || ' ')
            )
        )
        SELECT lang, rank, phrase, a, l, r, n, score FROM ranked WHERE rank <= 2000
    """,
}
