"""SimHash near-duplicates, found by the generalised pigeonhole principle.

Fingerprints are cut into ``m`` partitions of correlated bits.  If two fingerprints differ in at most ``d`` bits,
then for *any* thresholds that sum up to ``d - m + 1`` there is a partition in which they differ in at most that
partition's threshold (-1: not probed).  So each fingerprint picks the thresholds that promise it the fewest
candidates: a small dynamic programme over partitions and remaining threshold, fed with counts estimated from
histograms of all fingerprints.  Every fingerprint is indexed once per partition and probes the values within its
thresholds; candidates are verified on all bits.

A value shared by very many fingerprints would pair them all.  Where a bucket holds more fingerprints than it costs
to list the points around them, its fingerprints (and the probes into it) are linked through those points instead:
two fingerprints are within two bits exactly if flipping at most one bit of each can give the same point, so every
point links its fingerprints to the smallest of them.  That is exact and linear in the number of fingerprints.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import blocks, whole
from ledgerloom.operators.components import min_labels
from ledgerloom.session import materialise

BITS = 64
SEED = 42
UPPER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def fingerprint(text: str, shingle: int = 3) -> int:
    """The SimHash of one text: a bit is set if over half of the shingles' hashes set it."""
    words = text.encode("utf-8", "surrogatepass").translate(UPPER).split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1) - 1
    if len(words) <= shingle:
        hashes = np.array([xxhash.xxh64_intdigest(joined, SEED)], dtype=np.uint64)
    else:
        stops = ends[shingle - 1 :].tolist()
        starts = [0, *(ends[: len(words) - shingle] + 1).tolist()]
        digest = xxhash.xxh64_intdigest
        hashes = np.fromiter((digest(joined[a:b], SEED) for a, b in zip(starts, stops, strict=True)), dtype=np.uint64, count=len(starts))
    ones = np.zeros(BITS, dtype=np.int64)
    for start in range(0, len(hashes), 4096):
        some = hashes[start : start + 4096].astype("<u8")
        ones += np.unpackbits(some.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(sum(1 << b for b in np.flatnonzero(2 * ones > len(hashes)).tolist()))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3) -> DataFrame:
    """``id, hash, fp`` (the 64 bits as a signed long) for every row; a null text counts as empty.

    ``hash`` tells different texts of one id apart.
    """
    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, "text"):
            found = np.array([fingerprint(t, shingle) for t in block.column("text").to_pylist()], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([block.column(0), block.column(1), pa.array(found.view(np.int64))], names=["id", "hash", "fp"])

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(whole(text_col)).alias("hash"), whole(text_col).alias("text"))
    return rows.mapInArrow(compute, "id long, hash long, fp long")


# --- the plan: partitions and histograms -------------------------------------------------------------------


@dataclass(frozen=True)
class Plan:
    """Bits of each partition and, for blocks of up to 8 of its bits, the share of fingerprints by value."""

    partitions: tuple[tuple[int, ...], ...]
    distance: int
    total: int
    histograms: tuple[tuple[tuple[tuple[int, ...], np.ndarray], ...], ...]


def _together(fps: DataFrame) -> tuple[np.ndarray, int]:
    """How many fingerprints set bits i and j, for all i and j: 64 sums of 64 numbers."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((BITS, BITS))
        rows = 0
        for batch in batches:
            value = np.asarray(batch.column(0)).astype("<i8")
            bits = np.unpackbits(value.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(np.float32)
            total += bits.T @ bits
            rows += len(value)
        if rows:
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(BITS)), pa.array([rows] * BITS), pa.array(total.astype(np.int64).tolist(), type=pa.list_(pa.int64()))], names=["bit", "n", "c"]
            )

    parts = fps.select("fp").mapInArrow(count, "bit long, n long, c array<long>")
    sums = parts.groupBy("bit").agg(F.sum("n").alias("n"), *[F.sum(F.col("c")[j]).alias(f"c{j}") for j in range(BITS)]).collect()
    out, total = np.zeros((BITS, BITS)), 0
    for row in sums:
        out[row["bit"]] = [row[f"c{j}"] for j in range(BITS)]
        total = row["n"]
    return out, total


def _grouped_bits(together: np.ndarray, total: int, m: int) -> tuple[tuple[int, ...], ...]:
    """Bits dealt to ``m`` partitions of nearly equal width, the most correlated together."""
    share = np.diag(together) / max(total, 1)
    spread = np.sqrt(np.maximum(share * (1 - share), 1e-12))
    correlation = np.abs(together / max(total, 1) - np.outer(share, share)) / np.outer(spread, spread)
    left, out = set(range(BITS)), []
    for k in range(m):
        width = (len(left) + (m - k) - 1) // (m - k)
        pairs = [(correlation[i, j], -i, -j) for i, j in combinations(sorted(left), 2)]
        group = [-v for v in max(pairs)[1:]] if pairs else list(left)
        left -= set(group)
        while len(group) < width:
            nearest = max(left, key=lambda b: (correlation[b, group].sum(), -b))
            group.append(nearest)
            left.remove(nearest)
        out.append(tuple(sorted(group)))
    return tuple(out)


def _block_values(fps: DataFrame, cut: list[tuple[int, ...]]) -> DataFrame:
    """``block, value, n``: a histogram of each block of bits, at most 256 rows a block."""
    fields = F.array(*[
        F.struct(F.lit(k).alias("block"), sum((F.shiftrightunsigned("fp", b).bitwiseAND(1) * (1 << i) for i, b in enumerate(bits)), F.lit(0)).alias("value"))
        for k, bits in enumerate(cut)
    ])
    return fps.select(F.explode(fields).alias("f")).groupBy("f.block", "f.value").agg(F.count("*").alias("n"))


def make_plan(fps: DataFrame, distance: int, choices: tuple[int, ...] = (2, 3)) -> Plan:
    """The partitioning, of ``choices`` partitions, that promises the least work; all from sums over all fingerprints."""
    together, total = _together(fps)
    options = [_grouped_bits(together, total, m) for m in choices]
    cuts = [[tuple(p[i : i + 8]) for i in range(0, len(p), 8)] for option in options for p in option]
    flat = [bits for cut in cuts for bits in cut]
    shares = [np.zeros(1 << len(bits)) for bits in flat]
    for row in _block_values(fps, flat).collect():
        shares[row["block"]][row["value"]] = row["n"] / max(total, 1)
    at = iter(zip(flat, shares, strict=True))
    plans = [Plan(option, distance, total, tuple(tuple(next(at) for _ in range(0, len(p), 8)) for p in option)) for option in options]
    return min(plans, key=_expected_work)


def _expected_work(plan: Plan) -> float:
    """Probes and candidates of a typical fingerprint, taking partition values as independent of each other."""
    best: dict[int, float] = {0: 0.0}
    target = plan.distance - len(plan.partitions) + 1
    for blocks_of in plan.histograms:
        same = [float((share**2).sum()) for _, share in blocks_of]
        width = sum(len(bits) for bits, _ in blocks_of)
        costs = {-1: 0.0}
        for t in range(plan.distance + 1):
            probes = sum(_choose(width, k) for k in range(t + 1))
            costs[t] = probes * (1 + plan.total * float(np.prod(same)))
        best = _allocate(best, costs)
    return best.get(target, float("inf"))


def _choose(n: int, k: int) -> int:
    out = 1
    for i in range(k):
        out = out * (n - i) // (i + 1)
    return out


def _allocate(best: dict[int, float], costs: dict[int, float]) -> dict[int, float]:
    after: dict[int, float] = {}
    for spent, cost in best.items():
        for t, more in costs.items():
            if cost + more < after.get(spent + t, float("inf")):
                after[spent + t] = cost + more
    return after


def packed(values: np.ndarray, bits: tuple[int, ...]) -> np.ndarray:
    """The given bits of each value, side by side."""
    out = np.zeros(len(values), dtype=np.uint64)
    for i, b in enumerate(bits):
        out |= ((values >> np.uint64(b)) & np.uint64(1)) << np.uint64(i)
    return out


def allocated(plan: Plan, values: np.ndarray) -> np.ndarray:
    """Thresholds (a column per partition) of each fingerprint: the dynamic programme over estimated candidates."""
    d, m = plan.distance, len(plan.partitions)
    estimates = np.zeros((m, d + 2, len(values)))  # by partition, threshold + 1
    for p, blocks_of in enumerate(plan.histograms):
        within = [np.ones(len(values))] + [np.zeros(len(values)) for _ in range(d)]  # share of rows at exactly k bits
        for bits, share in blocks_of:
            own = packed(values, bits).astype(np.int64)
            near = []
            for k in range(min(d, len(bits)) + 1):
                masks = [sum(1 << i for i in c) for c in combinations(range(len(bits)), k)]
                near.append(sum(share[own ^ mask] for mask in masks))
            within = [sum(within[k - j] * near[j] for j in range(min(k, len(near) - 1) + 1)) for k in range(d + 1)]
        width = len(plan.partitions[p])
        for t in range(d + 1):
            probes = sum(_choose(width, k) for k in range(t + 1))
            estimates[p, t + 1] = probes + plan.total * sum(within[: t + 1])
    # best[s]: least cost so far with thresholds that sum up to s - p (each is at least -1); choice remembers how
    room = d + 2
    best = np.full((room * m + 1, len(values)), np.inf)
    best[0] = 0
    chosen = []
    for p in range(m):
        after = np.full_like(best, np.inf)
        how = np.zeros(best.shape, dtype=np.int8)
        for s in range(p * (d + 1) + 1):
            for t in range(d + 2):
                cost = best[s] + estimates[p, t]
                better = cost < after[s + t]
                after[s + t][better] = cost[better]
                how[s + t][better] = t
        best = after
        chosen.append(how)
    out = np.zeros((len(values), m), dtype=np.int64)
    at = np.full(len(values), d + 1)  # sum of (threshold + 1) is d - m + 1 + m
    for p in range(m - 1, -1, -1):
        t = chosen[p][at, np.arange(len(values))].astype(np.int64)
        out[:, p] = t - 1
        at = at - t
    return out


# --- probing, verifying, linking ---------------------------------------------------------------------------


def _flips(width: int, threshold: int) -> np.ndarray:
    masks = [sum(1 << i for i in c) for k in range(threshold + 1) for c in combinations(range(width), k)]
    return np.array(masks, dtype=np.uint64)


def _probes(fps: DataFrame, plan: Plan) -> DataFrame:
    """``part, value, fp``: the partition values each fingerprint looks up."""
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            whole_batch = np.asarray(batch.column(0)).astype(np.int64).view(np.uint64)
            for start in range(0, len(whole_batch), 2048):
                values = whole_batch[start : start + 2048]
                thresholds = allocated(plan, values)
                for p, bits in enumerate(plan.partitions):
                    own = packed(values, bits)
                    for t in range(plan.distance + 1):
                        rows = thresholds[:, p] == t
                        if rows.any():
                            masks = _flips(len(bits), t)
                            keys = (own[rows][:, None] ^ masks[None, :]).ravel()
                            yield pa.RecordBatch.from_arrays(
                                [pa.array(np.full(len(keys), p, dtype=np.int32)), pa.array(keys.view(np.int64)), pa.array(np.repeat(values[rows], len(masks)).view(np.int64))],
                                names=["part", "value", "fp"],
                            )

    return fps.select("fp").mapInArrow(emit, "part int, value long, fp long")


def _index(fps: DataFrame, plan: Plan) -> DataFrame:
    """``part, value, fp``: where each fingerprint can be found; column expressions only."""
    values = F.array(*[
        F.struct(F.lit(p).alias("part"), sum((F.shiftleft(F.shiftrightunsigned("fp", b).bitwiseAND(F.lit(1).cast("long")), i) for i, b in enumerate(bits)), F.lit(0).cast("long")).alias("value"))
        for p, bits in enumerate(plan.partitions)
    ])
    return fps.select(F.explode(values).alias("f"), "fp").select("f.part", "f.value", "fp")


def _around(fps: DataFrame) -> DataFrame:
    """Each fingerprint linked to the smallest one that shares a point one flipped bit away from both."""
    flips = F.array(F.lit(0).cast("long"), *[F.shiftleft(F.lit(1).cast("long"), b) for b in range(BITS)])
    points = fps.select("fp", F.explode(F.transform(flips, lambda mask: F.col("fp").bitwiseXOR(mask))).alias("point"))
    least = points.groupBy("point").agg(F.min("fp").alias("low"), F.max("fp").alias("high")).where("low <> high").select("point", "low")
    return points.join(least, "point").where("fp <> low").select(F.col("low").alias("id_a"), F.col("fp").alias("id_b"))


def links(fps: DataFrame, distance: int = 2, hot: int = 2 * (BITS + 1)) -> DataFrame:
    """``id_a, id_b``: links between distinct fingerprints that connect all that differ in up to ``distance`` bits.

    ``hot`` is the bucket size from which the points around cost less than the pairs; it decides the route, not the result.
    """
    if distance != 2:
        hot = 1 << 62  # the points around only stand for two bits
    plan = make_plan(fps, distance)
    index = materialise(_index(fps, plan), "simhash-index")
    probes = materialise(_probes(fps, plan), "simhash-probes")
    sizes = index.groupBy("part", "value").agg(F.count("*").alias("size"))
    large = materialise(sizes.where(F.col("size") > hot).select("part", "value"), "simhash-large")
    small = index.join(large, ["part", "value"], "left_anti")
    pairs = probes.alias("q").join(small.alias("c"), ["part", "value"]).where(
        (F.col("q.fp") != F.col("c.fp")) & (F.bit_count(F.col("q.fp").bitwiseXOR(F.col("c.fp"))) <= distance)
    ).select(F.least("q.fp", "c.fp").alias("id_a"), F.greatest("q.fp", "c.fp").alias("id_b"))
    crowded = probes.join(large, ["part", "value"], "left_semi").select("fp").unionByName(index.join(large, ["part", "value"], "left_semi").select("fp")).distinct()
    return pairs.unionByName(_around(crowded))


def _grouped(docs: DataFrame, id_col: str, text_col: str, shingle: int, distance: int) -> DataFrame:
    """``id, hash, fp, label, component_id`` for every row; a label is the same throughout a component and only there."""
    rows = materialise(fingerprints(docs, id_col, text_col, shingle), "fingerprints")
    classes = materialise(rows.groupBy("fp").agg(F.min("id").alias("least")), "fingerprint-classes")
    labels = min_labels(links(classes.select("fp"), distance))
    grouped = labels.join(classes, labels["notice_id"] == classes["fp"]).groupBy("label").agg(F.min("least").alias("component_id"))
    named = labels.join(grouped, "label").select(F.col("notice_id").alias("fp"), "label", "component_id")
    all_classes = classes.join(named, "fp", "left").select("fp", F.coalesce("label", "fp").alias("label"), F.coalesce("component_id", "least").alias("component_id"))
    return rows.join(all_classes, "fp")


def components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, distance: int = 2) -> DataFrame:
    """``id, fp, component_id`` for every row; the component is the smallest id reachable over links.

    Texts without words have fingerprint zero and are linked like any other.  Rows with a null id take part; their
    component is the smallest id that is not null, if there is one.  Repeated rows keep a row each; no rows give no rows.
    """
    return _grouped(docs, id_col, text_col, shingle, distance).select("id", "fp", "component_id")


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, distance: int = 2) -> DataFrame:
    """``docs`` with the row of the smallest id of each component, and all rows with a null id.

    Rows are told apart by id and text: of several texts of the smallest id one stays, a row is not dropped for another
    text of its id, and rows equal in both stay together.
    """
    found = materialise(_grouped(docs, id_col, text_col, shingle, distance).where("id IS NOT NULL").select("id", "hash", "label"), "simhash-rows")
    kept = found.groupBy("label").agg(F.min(F.struct("id", "hash")).alias("kept"))
    dropped = found.join(kept, "label").where(F.struct("id", "hash") != F.col("kept")).select(F.col("id").alias("_id"), F.col("hash").alias("_hash")).distinct()
    same = (docs[f"`{id_col}`"].cast("long") == dropped["_id"]) & (F.xxhash64(whole(docs[f"`{text_col}`"])) == dropped["_hash"])
    return docs.join(dropped, same, "left_anti")
