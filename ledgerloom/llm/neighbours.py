"""Approximate nearest neighbours by multiprobe p-stable hashing.

A table hashes a vector to ``floor((A x + b) / w)`` for a few random directions.  Every vector goes to its bucket in each
table, and a query to its own bucket and to perturbed ones, in the order of their estimated chance to hold a near vector;
table and bucket are the key of that shuffle, so vectors and queries are sent as often as there are tables and probes,
however many of either there are.  A bucket shared by very many vectors is cut into parts that its queries all visit.
What the tables give is merged and ranked by exact distance.

Cell width and number of probes are fitted on a bounded sample for each *range of norms* among the queries, as what lies
near a long vector lies farther away: the width follows the distances found there, and the fewest probes are taken that
reach the wished recall.  A range that no number of probes serves, and queries whose buckets hold fewer than ``k``, are
compared with every vector.  Nearest neighbours lie farther apart in a sample than among all vectors, so the fit errs
on the safe side.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.session import materialise


@dataclass(frozen=True)
class Tables:
    tables: int = 8
    directions: int = 8
    width: float = 2.0  # of a hash cell, in distances of the k-th neighbour
    probes: int = 64  # perturbed buckets a table and query
    seed: int = 7


@dataclass(frozen=True)
class Fit:
    """Bounds of the sample and of the queries tried in each range of norms, the recall wished for, and the probes tried."""

    sample: int = 2_000
    queries: int = 200
    recall: float = 0.96
    probes: tuple[int, ...] = (16, 32, 48, 64, 96, 128, 192, 256, 384, 512, 768, 1024)


def probe_order(directions: int, probes: int) -> list[tuple[int, ...]]:
    """Perturbation sets in expected order of success.

    With the ``2 m`` distances to cell borders sorted, ranks ``j`` and ``2 m + 1 - j`` belong to the two sides of one
    direction.  A set of ranks costs the sum of the expected squared distances; sets come out of a heap by
    shifting or extending their largest rank.
    """
    m = directions
    cost = [0.0]
    for j in range(1, 2 * m + 1):
        k = 2 * m + 1 - j
        cost.append(j * (j + 1) / (4 * (m + 1) * (m + 2)) if j <= m else 1 - k / (m + 1) + k * (k + 1) / (4 * (m + 1) * (m + 2)))
    heap, out = [(cost[1], (1,))], []
    while heap and len(out) < probes:
        price, ranks = heapq.heappop(heap)
        if len({min(j, 2 * m + 1 - j) for j in ranks}) == len(ranks):
            out.append(ranks)
        last = ranks[-1]
        if last < 2 * m:
            heapq.heappush(heap, (price - cost[last] + cost[last + 1], (*ranks[:-1], last + 1)))
            heapq.heappush(heap, (price + cost[last + 1], (*ranks, last + 1)))
    return out


class Hasher:
    def __init__(self, dimension: int, spec: Tables, spread: float):
        random = np.random.default_rng(spec.seed)
        self.spec = spec
        self.cell = spec.width * spread
        self.lines = random.normal(size=(spec.tables, spec.directions, dimension))
        self.offsets = random.uniform(0, self.cell, size=(spec.tables, spec.directions))
        self.mix = random.integers(1, 1 << 62, size=spec.directions, dtype=np.int64) | 1
        self.order = np.zeros((spec.probes + 1, 2 * spec.directions), dtype=np.int64)  # the own bucket first
        for k, ranks in enumerate(probe_order(spec.directions, spec.probes), start=1):
            self.order[k, [j - 1 for j in ranks]] = 1

    def _cells(self, vectors: np.ndarray, table: int) -> np.ndarray:
        return (vectors @ self.lines[table].T + self.offsets[table]) / self.cell

    def buckets(self, vectors: np.ndarray, table: int) -> np.ndarray:
        return (np.floor(self._cells(vectors, table)).astype(np.int64) * self.mix).sum(axis=1)

    def probed(self, vectors: np.ndarray, table: int) -> np.ndarray:
        """The buckets each query visits, its own first: one row a query."""
        exact = self._cells(vectors, table)
        cell = np.floor(exact)
        up = exact - cell  # to the lower border; the rest to the upper
        borders = np.concatenate([up, 1 - up], axis=1)
        change = np.concatenate([-self.mix, self.mix])
        ranked = np.argsort(borders, axis=1, kind="stable")
        return (cell.astype(np.int64) * self.mix).sum(axis=1)[:, None] + change[ranked] @ self.order.T


def nearest(queries: np.ndarray, query_ids: np.ndarray, vectors: np.ndarray, ids: np.ndarray, k: int, hasher: Hasher) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each query, the positions and distances of the ``k`` nearest candidates of the merged tables."""
    found: list[list[np.ndarray]] = [[] for _ in range(len(queries))]
    for table in range(hasher.spec.tables):
        members = Members(hasher.buckets(vectors, table))
        for q, wanted in enumerate(hasher.probed(queries, table)):
            found[q].append(members.of(wanted))
    for q, parts in enumerate(found):
        rows = np.unique(np.concatenate(parts))
        rows = rows[ids[rows] != query_ids[q]]
        if len(rows):
            yield q, *_closest(queries[q], rows, vectors, ids, k)


class Members:
    """The rows of each bucket."""

    def __init__(self, keys: np.ndarray):
        self.order = np.argsort(keys, kind="stable")
        self.names, self.starts, self.counts = np.unique(keys[self.order], return_index=True, return_counts=True)

    def of(self, wanted: np.ndarray) -> np.ndarray:
        at = np.minimum(np.searchsorted(self.names, wanted), len(self.names) - 1)
        mine = np.unique(at[self.names[at] == wanted])
        parts = [self.order[s : s + n] for s, n in zip(self.starts[mine].tolist(), self.counts[mine].tolist(), strict=True)]
        return np.concatenate(parts) if parts else np.zeros(0, dtype=np.int64)


def _closest(query: np.ndarray, rows: np.ndarray, vectors: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` of ``rows`` nearest to ``query`` and their distances; of rows with one id the nearest only."""
    gap = np.sqrt(((vectors[rows] - query) ** 2).sum(axis=1))
    near = gap <= np.partition(gap, k - 1)[k - 1] if len(rows) > k else np.ones(len(rows), dtype=bool)
    best = np.flatnonzero(near)
    best = best[np.lexsort((ids[rows[best]], gap[best]))[:k]]
    if len(np.unique(ids[rows[best]])) < len(best):
        order = np.lexsort((gap, ids[rows]))
        own = ids[rows[order]]
        order = order[np.concatenate([[True], own[1:] != own[:-1]])]
        best = order[np.lexsort((ids[rows[order]], gap[order]))[:k]]
    return rows[best], gap[best]


def usable(embedding: Column) -> Column:
    """Neither null nor empty nor zero, and nothing null or non-finite in it."""
    value = embedding.cast("array<double>")
    finite = F.forall(value, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return value.isNotNull() & finite & F.exists(value, lambda v: v != 0)


def _norm_range(middle: float) -> Column:
    """Ranges of norms by powers of two around the middle one."""
    norm = F.sqrt(F.aggregate("vector", F.lit(0.0), lambda s, v: s + v * v))
    return F.round(F.log2(norm / F.lit(middle))).cast("int")


def fitted(rows: DataFrame, spec: Tables, fit: Fit, k: int) -> tuple[float, dict[int, Hasher | None]]:
    """The middle norm, and for each range of norms among the queries a hasher, or none where no number of probes serves.

    ``fit.sample`` vectors of smallest id hash, and up to ``fit.queries`` queries of each range, are looked at.
    """
    chosen = rows.orderBy(F.xxhash64("id"), "id").limit(fit.sample).collect()
    data, ids = np.array([r["vector"] for r in chosen], dtype=float), np.array([r["id"] for r in chosen])
    middle = float(np.median(np.sqrt((data**2).sum(axis=1)))) or 1.0
    first = Window.partitionBy("range", F.pmod(F.xxhash64("id", F.lit(1)), F.lit(64))).orderBy(F.xxhash64("id"))
    again = Window.partitionBy("range").orderBy(F.xxhash64("id"))
    asked = rows.where("asks").withColumn("range", _norm_range(middle))
    asked = asked.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= fit.queries)
    asked = asked.withColumn("rank", F.row_number().over(again)).where(F.col("rank") <= fit.queries)
    by_range: dict[int, list] = {}
    for r in asked.select("range", "id", "vector").collect():
        by_range.setdefault(r["range"], []).append(r)
    return middle, {number: _fitted_range(own, data, ids, spec, fit, k) for number, own in by_range.items()}


def _fitted_range(own: list, data: np.ndarray, ids: np.ndarray, spec: Tables, fit: Fit, k: int) -> Hasher | None:
    points, point_ids = np.array([r["vector"] for r in own], dtype=float), np.array([r["id"] for r in own])
    exact, far = [], []
    for point, key in zip(points, point_ids, strict=True):
        rows, gap = _closest(point, np.flatnonzero(ids != key), data, ids, k)
        exact.append(set(rows.tolist()))
        far.append(gap[-1] if len(gap) else 0.0)
    wished = sum(map(len, exact))
    spread = float(np.median(far)) or 1.0
    for probes in fit.probes:
        hasher = Hasher(data.shape[1], replace(spec, probes=probes), spread)
        got = nearest(points, point_ids, data, ids, k, hasher)
        if wished and sum(len(exact[q] & set(rows.tolist())) for q, rows, _ in got) >= fit.recall * wished:
            return hasher
    return None


RESULT = "query_id long, rank int, id long, score double"
FOUND = "query_id long, id long, score double"


def _stacked(vectors: pd.Series) -> np.ndarray:
    return np.stack(vectors.to_numpy()).astype(float)


def _frame(parts: list[tuple[int, np.ndarray, np.ndarray]]) -> pd.DataFrame:
    counts = [len(ids) for _, ids, _ in parts]
    return pd.DataFrame({
        "query_id": np.repeat(np.array([q for q, _, _ in parts], dtype=np.int64), counts),
        "id": np.concatenate([ids for _, ids, _ in parts] or [np.zeros(0, dtype=np.int64)]).astype(np.int64),
        "score": np.concatenate([gap for _, _, gap in parts] or [np.zeros(0)]),
    })


def _by_buckets(rows: DataFrame, queries: DataFrame, hashers: dict[int, Hasher], k: int, block_rows: int) -> DataFrame:
    """``query_id, id, score``: up to ``k`` of each part of each bucket that a query visits.

    ``queries`` has its ``range``.  Buckets are dealt by table and bucket to groups of about ``block_rows`` vectors; a larger
    bucket is cut into parts.
    """
    spark = rows.sparkSession
    shared = spark.sparkContext.broadcast(hashers)

    def keyed(of: pd.DataFrame, numbers: list[int], probing: bool) -> Iterator[pd.DataFrame]:
        vectors = _stacked(of["vector"])
        for number in numbers:
            hasher = shared.value[number]
            own = (of["range"] == number).to_numpy() if probing else np.ones(len(of), dtype=bool)
            if not own.any():
                continue
            for table in range(hasher.spec.tables):
                keys = hasher.probed(vectors[own], table) if probing else hasher.buckets(vectors, table)
                yield pd.DataFrame({"range": np.int32(number), "place": np.int32(table), "key": list(keys), "id": of["id"][own], "vector": of["vector"][own]})

    def index(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                yield from keyed(batch, sorted(shared.value), False)

    def counting(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in index(batches):
            yield part.groupby(["range", "place", "key"], as_index=False).size()

    def probe(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                yield from (part.drop(columns="vector") for part in keyed(batch, sorted(shared.value), True))

    bucket = ["range", "place", "key"]
    counted = rows.select("id", "vector").mapInPandas(counting, "range int, place int, key long, size long")
    large = counted.groupBy(*bucket).agg(F.sum("size").alias("size")).where(F.col("size") > block_rows)
    large = materialise(large.select(*bucket, F.ceil(F.col("size") / block_rows).cast("int").alias("parts")), "large-buckets")
    groups = max(1, -(-rows.count() // block_rows))
    group = [F.col("range"), F.col("place"), F.pmod(F.xxhash64("key"), F.lit(groups)).cast("int").alias("group")]

    held = rows.select("id", "vector").mapInPandas(index, "range int, place int, key long, id long, vector array<double>").join(large, bucket, "left")
    held = held.select(*group, F.coalesce(F.pmod(F.xxhash64("id"), "parts"), F.lit(0)).cast("int").alias("part"), "key", "id", "vector")
    asking = queries.mapInPandas(probe, "range int, place int, key array<long>, id long").withColumn("key", F.explode(F.array_distinct("key")))
    asking = asking.join(large, bucket, "left").withColumn("part", F.explode(F.sequence(F.lit(0), F.coalesce("parts", F.lit(1)) - 1)))
    # as many keys as there are probes at most
    asking = asking.select(*group, "part", "id", "key").groupBy("range", "place", "group", "part", "id").agg(F.collect_list("key").alias("keys"))
    asking = asking.join(queries.select("id", "vector"), "id")

    def look(held: pd.DataFrame, asking: pd.DataFrame) -> pd.DataFrame:
        parts = []
        if len(held) and len(asking):
            vectors, ids = _stacked(held["vector"]), held["id"].to_numpy()
            members = Members(held["key"].to_numpy())
            for key, point, keys in zip(asking["id"].tolist(), _stacked(asking["vector"]), asking["keys"], strict=True):
                at = members.of(np.asarray(keys))
                at = at[ids[at] != key]
                if len(at):
                    near, gap = _closest(point, at, vectors, ids, k)
                    parts.append((key, ids[near], gap))
        return _frame(parts)

    by = ["range", "place", "group", "part"]
    return held.groupBy(*by).cogroup(asking.groupBy(*by)).applyInPandas(look, FOUND)


def _by_all(rows: DataFrame, queries: DataFrame, k: int, chunk: int) -> DataFrame:
    """``query_id, id, score``: up to ``k`` of each partition of ``rows`` for each query.

    Queries are sent to the vectors in chunks of bounded size, one scan of the vectors for each; vectors stay where they are.
    """
    spark, out = rows.sparkSession, None
    chunks = max(1, -(-queries.count() // chunk))
    dealt = queries.select("id", "vector", F.pmod(F.xxhash64("id"), F.lit(chunks)).alias("chunk"))
    for number in range(chunks):
        own = dealt.where(F.col("chunk") == number).select("id", "vector").collect()
        if not own:
            continue
        shared = spark.sparkContext.broadcast((np.array([r["id"] for r in own]), np.array([r["vector"] for r in own], dtype=float)))

        def look(batches: Iterator[pd.DataFrame], shared=shared) -> Iterator[pd.DataFrame]:
            query_ids, points = shared.value
            best = [(np.zeros(0, dtype=np.int64), np.zeros(0))] * len(points)
            for batch in batches:
                if not len(batch):
                    continue
                ids, vectors = batch["id"].to_numpy(), _stacked(batch["vector"])
                for q, (key, point) in enumerate(zip(query_ids, points, strict=True)):
                    near, gap = _closest(point, np.flatnonzero(ids != key), vectors, ids, k)
                    every, gaps = np.concatenate([best[q][0], ids[near]]), np.concatenate([best[q][1], gap])
                    order = np.lexsort((every, gaps))
                    _, first = np.unique(every[order], return_index=True)
                    order = order[np.sort(first)[:k]]
                    best[q] = every[order], gaps[order]
            yield _frame([(key, *own) for key, own in zip(query_ids.tolist(), best, strict=True)])

        found = materialise(rows.select("id", "vector").mapInPandas(look, FOUND), "near-all")
        out = found if out is None else out.unionByName(found)
    return out if out is not None else spark.createDataFrame([], FOUND)


def search(
    table: DataFrame, is_query: Column, k: int = 10, spec: Tables = Tables(), fit: Fit = Fit(), id_col: str = "vec_id", vector_col: str = "embedding",
    block_rows: int = 8_192, chunk_rows: int = 2_048,
) -> DataFrame:
    """``query_id, rank, id, score``: the nearest found for each query row, by Euclidean distance and then id.

    Rows without a usable vector or id, or with another length than most, take no part.  A row that is repeated counts
    once; a query never meets its own id, and an id with several vectors is as near as its nearest, to the nearest of a
    query's.  Without queries or candidates there are no rows.
    """
    rows = table.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("vector"), is_query.alias("asks"))
    rows = materialise(rows.where(F.col("id").isNotNull() & usable(F.col("vector"))).distinct(), "vectors")
    spark = table.sparkSession
    sizes = rows.groupBy(F.size("vector").alias("dimension")).agg(F.count("*").alias("n"), F.count_if("asks").alias("q")).orderBy(F.desc("n"), "dimension").limit(1).collect()
    if not sizes or not sizes[0]["q"]:
        return spark.createDataFrame([], RESULT)
    rows = rows.where(F.size("vector") == sizes[0]["dimension"])
    middle, hashers = fitted(rows, spec, fit, k)
    served = {number: hasher for number, hasher in hashers.items() if hasher is not None}
    queries = materialise(rows.where("asks").select("id", "vector", _norm_range(middle).alias("range")), "queries")

    near = spark.createDataFrame([], FOUND)
    if served:
        near = _by_buckets(rows, queries.where(F.col("range").isin(sorted(served))), served, k, block_rows)
        near = near.groupBy("query_id", "id").agg(F.min("score").alias("score"))
    near = materialise(near, "near")
    # Queries whose buckets held too few, and those of ranges without tables, are compared with every vector.
    enough = min(k, rows.select("id").distinct().count() - 1)
    full = near.groupBy("query_id").agg(F.count("*").alias("n")).where(F.col("n") >= enough).select(F.col("query_id").alias("id"))
    short = materialise(queries.join(full, "id", "left_anti"), "short")
    if enough and not short.isEmpty():
        again = _by_all(rows, short, k, chunk_rows).groupBy("query_id", "id").agg(F.min("score").alias("score"))
        near = near.join(short.select(F.col("id").alias("query_id")).distinct(), "query_id", "left_anti").unionByName(again)
    best = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "id"))
    return near.withColumn("rank", best).where(F.col("rank") <= k).select("query_id", "rank", "id", "score")
