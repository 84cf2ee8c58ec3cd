"""Inputs of the notice queries derived from the given tables."""

from __future__ import annotations

import sys
from collections.abc import Iterator
from itertools import product

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.functions import text as T
from ledgerloom.functions.hashing import gram_hashes, grams_of
from ledgerloom.functions.similarity import ALPHA
from ledgerloom.operators.matching import both_sides
from ledgerloom.operators.signatures import hashed, with_signatures, worded
from ledgerloom.session import materialise, spread
from ledgerloom.sources import lake
from ledgerloom.sources import tables as S

SAME_CONTAINMENT = 0.8
#: Rows that are compared in one place, and notices of one smallest body hash from which on they are cut into tiles.
ROOM, HOT = 256, 4096
TYPES = [pa.int64(), pa.int64(), pa.bool_(), *[pa.float64()] * 4]

# Executors need no installed copy of this package: the few helpers travel with the task.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def signed_notices(spark: SparkSession, sf_dir: str, cleaned: bool = True) -> DataFrame:
    """Sets and signatures of all notices, landed once for their files."""
    build = lambda: with_signatures(hashed(S.notices(spark, sf_dir), cleaned))
    return lake.once(spark, f"signed {cleaned}", [S.location(sf_dir, "documents")], [], build)


def signatures(spark: SparkSession, sf_dir: str, cleaned: bool = True) -> DataFrame:
    """Signatures of all notices for what asks for no sets: landed once without them, which are several times as long, unless
    ``signed_notices`` is there."""
    sources = [S.location(sf_dir, "documents")]
    if lake.is_landed(spark, f"signed {cleaned}", sources):
        return signed_notices(spark, sf_dir, cleaned).drop("title_set", "body_set")
    build = lambda: with_signatures(hashed(S.notices(spark, sf_dir), cleaned)).drop("title_set", "body_set")
    return lake.once(spark, f"signatures {cleaned}", sources, [], build)


def pair_pool(sets: DataFrame) -> DataFrame:
    """Pairs to label, without regard to any banding: each notice with the next id, and with the first
    notice that has the same smallest body hash.  At most two pairs per notice."""
    ids = sets.select("notice_id")
    following = ids.select(F.col("notice_id").alias("id_a"), (F.col("notice_id") + 1).alias("id_b")).join(
        ids.select(F.col("notice_id").alias("id_b")), "id_b", "left_semi"
    )
    keyed = sets.select("notice_id", F.array_min("body_set").alias("least")).where("least is not null")
    first = keyed.groupBy("least").agg(F.min("notice_id").alias("id_a"))
    alike = keyed.join(first, "least").where("notice_id > id_a").select("id_a", F.col("notice_id").alias("id_b"))
    return following.select("id_a", "id_b").unionByName(alike).distinct()


def labelled(sets: DataFrame) -> DataFrame:
    """The pair pool labelled: the same notice when one body holds most of the other's shingles."""
    joined = both_sides(pair_pool(sets), sets, ["body_set"])
    a, b = F.col("body_set_a"), F.col("body_set_b")
    smaller = F.least(F.size(a), F.size(b))
    same = F.when(smaller > 0, F.size(F.array_intersect(a, b)) / smaller >= SAME_CONTAINMENT).otherwise(F.lit(False))
    return joined.select("id_a", "id_b", same.alias("is_same"))


def scored(spark: SparkSession, sf_dir: str, raw: bool = False) -> DataFrame:
    """Labelled pairs with the composite similarity, landed once for their files; with ``raw`` also the similarity of the
    uncleaned texts."""
    return lake.once(spark, f"scored {raw}", [S.location(sf_dir, "documents")], [], lambda: scored_pairs(S.notices(spark, sf_dir), raw))


def scored_pairs(notices: DataFrame, raw: bool, room: int = ROOM, hot: int = HOT) -> DataFrame:
    """The pairs of ``pair_pool`` labelled as by ``labelled``, with ``exact_scores`` of their cleaned texts.

    Every pair is one of neighbouring ids, or of a smallest body hash and its first notice.  So a notice goes, with its
    words, to the block of its id (the first id of a block to the one before as well) and to its smallest hash, and the
    pairs are compared where they meet: texts are shuffled twice, whatever is compared, and n-grams never.  Of a hash that
    more than ``hot`` notices have, the first goes to every tile and the others to one.  Blocks and tiles are dealt to rooms
    of about ``room`` rows.  Where ids repeat, each of the label and the similarities has a row for any two of their rows,
    and a pair the combinations of these.
    """
    words = materialise(_with_least(notices, raw), "worded")
    heads = words.groupBy("least").agg(F.min("notice_id").alias("head"), F.count("*").alias("n")).where("least is not null")
    # one row for every ``hot`` notices at most
    crowded = F.broadcast(heads.where(F.col("n") > hot).select("least", "head", F.ceil(F.col("n") / hot).cast("int").alias("tiles")))
    rooms = max(1, -(-2 * words.count() // room))
    block = lambda key: F.struct(F.lit(0).alias("kind"), key.alias("key"), F.lit(0).alias("tile"))
    meets = lambda tile: F.struct(F.lit(1).alias("kind"), F.col("least").alias("key"), tile.alias("tile"))
    own, before = F.floor(F.col("notice_id") / room), F.floor((F.col("notice_id") - 1) / room)
    tile = F.coalesce(F.pmod(F.xxhash64("notice_id"), "tiles").cast("int"), F.lit(0))
    tiles = F.when(F.col("notice_id") == F.col("head"), F.sequence(F.lit(0), F.col("tiles") - 1)).otherwise(F.array(tile))
    places = F.concat(
        F.array_distinct(F.array(block(own), block(before))),
        F.when(F.col("least").isNotNull(), F.transform(tiles, meets)).otherwise(F.array().cast("array<struct<kind:int,key:bigint,tile:int>>")),
    )
    texts = ["title_words", "body_words", *(["raw_words"] if raw else [])]
    placed = words.where("notice_id is not null").join(crowded, "least", "left").select("notice_id", *texts, F.explode(places).alias("place"))
    dealt = placed.select("notice_id", *texts, "place.*").withColumn("room", F.pmod(F.xxhash64("kind", "key", "tile"), F.lit(rooms)))
    grams = (T.TITLE_GRAM, T.BODY_GRAM, *([T.RAW_GRAM] if raw else []))
    names = ["id_a", "id_b", "is_same", *(["raw_similarity"] if raw else []), "title_sim", "body_sim", "similarity"]

    def compare(table: pa.Table) -> pa.Table:
        ids = table.column("notice_id").to_pylist()
        columns = [table.column(c).to_pylist() for c in texts]
        sets: dict[tuple[int, int], frozenset[str]] = {}

        def of(field: int, row: int) -> frozenset[str]:
            if (field, row) not in sets:
                sets[field, row] = frozenset(grams_of(columns[field][row], grams[field]))
            return sets[field, row]

        def alike(field: int, a: int, b: int) -> float:
            x, y = of(field, a), of(field, b)
            shared = len(x & y)
            return shared / (len(x) + len(y) - shared) if x and y else 0.0

        def same(a: int, b: int) -> bool:
            x, y = of(1, a), of(1, b)
            smaller = min(len(x), len(y))
            return smaller > 0 and len(x & y) / smaller >= SAME_CONTAINMENT

        held: dict[tuple, dict[int, list[int]]] = {}
        for row, where in enumerate(zip(*(table.column(c).to_pylist() for c in ("kind", "key", "tile")), strict=True)):
            held.setdefault(where, {}).setdefault(ids[row], []).append(row)
        out = []
        for (kind, key, _), rows in held.items():
            if kind == 0:
                met = [(a, a + 1) for a in rows if a + 1 in rows and a // room == key]
            else:
                first = min(rows)
                met = [(first, b) for b in rows if b > first + 1]  # the next id meets it in its block
            for a, b in met:
                both = list(product(rows[a], rows[b]))
                labels = [same(*rows) for rows in both]
                shown = [(t, v, ALPHA * t + (1.0 - ALPHA) * v) for t, v in ((alike(0, *rows), alike(1, *rows)) for rows in both)]
                rest = [[(alike(2, *rows),) for rows in both]] if raw else []
                out += [(a, b, label, *more) for label, *parts in product(labels, *rest, shown) for more in [sum(parts, ())]]
        return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True) if out else [()] * len(names), TYPES[: len(names)], strict=True)], names=names)

    schema = "id_a bigint, id_b bigint, is_same boolean, " + ", ".join(f"{c} double" for c in names[3:])
    return dealt.groupBy("room").applyInArrow(compare, schema)


def _with_least(notices: DataFrame, raw: bool) -> DataFrame:
    """The words of each notice, cleaned and with ``raw`` also as they came, and its smallest body hash."""
    rows = worded(spread(notices))
    as_it_came = F.array_join(T.tokens(F.concat_ws(" ", F.coalesce("title", F.lit("")), F.coalesce("body", F.lit("")))), " ")
    rows = rows.select("notice_id", "title_words", "body_words", *([as_it_came.alias("raw_words")] if raw else []))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)

    def least(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes = gram_hashes(batch.column("body_words").to_pylist(), T.BODY_GRAM)
            found = pa.array([int(h.min()) if len(h) else None for h in hashes], pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns, found], names=[*batch.schema.names, "least"])

    return rows.mapInArrow(least, f"{schema}, least bigint")
