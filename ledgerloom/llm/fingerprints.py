"""Document fingerprints by MinHash, and the near-duplicate classes they lead to.

*Signatures.*  A text's shingles of five words are hashed, and each of 128 universal hash permutations (multiply, add, keep
the high bits) keeps its minimum; all texts of a block go through numpy together.  A fingerprint is 16 bits of each
minimum, and the share of equal ones estimates the Jaccard similarity of two texts' shingles.

*Edited texts* need the document that follows by id.  Texts travel compressed to ranges of the id, where neighbours
lie next to each other; only the first and last text of a range are stored, and the last ones are edited in a second step.

*Classes.*  Texts with the same shingles are one node.  Signature bands are joined in Spark: every member of a bucket is
compared with the head of one of its buckets, exactly, by their shingles.  What shares a bucket and is then still in different components is cut into tiles, in which all
sets of two sides are intersected at once; a tile returns only the links that join something.  So no pair within a component
is listed, and none between two is left out, however large a bucket is.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyspark
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.common import blocks, discard, filter_of, passes, whole
from ledgerloom.operators.components import min_labels
from ledgerloom.session import materialise

#: Bytes of text that go through numpy together.
STEP_BYTES = 1 << 20
_U = np.uint64


@dataclass(frozen=True)
class Plan:
    """``bands`` of ``rows`` 16-bit values each, of ``permutations`` in all.

    A pair at the threshold shares no band once in 20,000 times with the defaults, more similar ones much less often.
    """

    shingle: int = 5
    permutations: int = 128
    bands: int = 25
    rows: int = 5
    similarity: float = 0.8
    tile: int = 512
    seed: int = 11


def _powers(base: int, n: int) -> np.ndarray:
    return np.cumprod(np.concatenate([[_U(1)], np.full(n, _U(base))]), dtype=np.uint64)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


class Shingles:
    """Hashes of the shingles of many texts: one array, with the place where each text's begin.

    Words stand between blanks, tabs and line ends.  A text with fewer words than a shingle has the whole sequence as its
    only one; a text without words has none.  A word's hash is a polynomial over its bytes, taken from running sums.
    """

    BASE = 0x100000001B3 | 1

    def __init__(self, width: int):
        self.width = width
        self.up, self.down = _powers(self.BASE, 0), _powers(pow(self.BASE, -1, 1 << 64), 0)

    def _room(self, n: int) -> None:
        if len(self.up) < n + 1:
            self.up, self.down = _powers(self.BASE, n), _powers(pow(self.BASE, -1, 1 << 64), n)

    def of(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        data = np.frombuffer(b" " + b" ".join(texts) + b" ", dtype=np.uint8)
        self._room(len(data))
        inside = ~((data == 32) | ((data >= 9) & (data <= 13)))
        edges = np.flatnonzero(inside[1:] != inside[:-1]) + 1
        starts, ends = edges[::2], edges[1::2]
        sums = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum((data.astype(np.uint64) + _U(1)) * self.up[: len(data)], out=sums[1:])
        words = _mixed((sums[ends] - sums[starts]) * self.down[starts])

        first = np.cumsum([1] + [len(t) + 1 for t in texts])  # where each text begins in ``data``
        bounds = np.searchsorted(starts, first)
        sizes = np.diff(bounds)
        counts = np.where(sizes > 0, np.maximum(sizes - self.width + 1, 1), 0)
        begin = np.concatenate([[0], np.cumsum(counts)])
        at = np.arange(begin[-1]) - np.repeat(begin[:-1] - bounds[:-1], counts)
        last = np.repeat(bounds[1:], counts)
        padded = np.concatenate([words, np.zeros(self.width, dtype=np.uint64)])
        out = np.zeros(len(at), dtype=np.uint64)
        for k in range(self.width):
            out = _mixed(out * _U(0x9E3779B97F4A7C15) + np.where(at + k < last, padded[at + k], _U(0)))
        return out, begin


class Signer:
    """Minima of universal hash permutations over shingles."""

    def __init__(self, plan: Plan):
        rng = np.random.default_rng(plan.seed)
        self.factors = rng.integers(0, 1 << 63, plan.permutations, dtype=np.uint64) * _U(2) + _U(1)
        self.terms = rng.integers(0, 1 << 63, plan.permutations, dtype=np.uint64) * _U(2) + rng.integers(0, 2, plan.permutations, dtype=np.uint64)

    def sign(self, hashes: np.ndarray, begin: np.ndarray) -> np.ndarray:
        """One row of 16-bit values a text; all ones for a text without shingles."""
        out = np.full((len(begin) - 1, len(self.factors)), 0xFFFF, dtype=np.uint16)
        there = np.flatnonzero(np.diff(begin))
        if len(there) == 0:
            return out
        short, starts = hashes >> _U(32), begin[there]
        held, low = np.empty_like(short), np.empty((len(there), len(self.factors)), dtype=np.uint64)
        for k, (a, b) in enumerate(zip(self.factors, self.terms, strict=True)):
            np.multiply(short, a, out=held)
            np.add(held, b, out=held)
            low[:, k] = np.minimum.reduceat(held, starts)
        out[there] = _mixed(low >> _U(32)) >> _U(48)
        return out


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The share of equal values."""
    return (a == b).mean(axis=-1)


def edited(text: str, following: str) -> str:
    """``text`` with its last half replaced by as much of the beginning of ``following`` as there is."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def _by_id(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = whole(text_col)
    return docs.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(text).alias("hash"), text.cast("binary").alias("text"))


def signatures(docs: DataFrame, plan: Plan = Plan(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, hash, node, fingerprint`` for every row; ``node`` is the same for texts with the same set of shingles.

    ``hash`` tells texts of one id apart.  A null text is an empty one; texts without words share a node, whose
    fingerprint is all ones.  Repeated rows and null ids keep a row each, and other columns are not read.
    """

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        signer, shingles = Signer(plan), Shingles(plan.shingle)
        for block in blocks(batches, "text", STEP_BYTES):
            hashes, begin = shingles.of(block.column("text").to_pylist())
            nodes = [_node(hashes[a:b]) for a, b in zip(begin[:-1].tolist(), begin[1:].tolist(), strict=True)]
            prints = [row.tobytes() for row in signer.sign(hashes, begin)]
            yield pa.RecordBatch.from_arrays([block.column("id"), block.column("hash"), pa.array(nodes, pa.binary()), pa.array(prints, pa.binary())], names=["id", "hash", "node", "fingerprint"])

    return _by_id(docs, id_col, text_col).mapInArrow(scan, "id long, hash long, node binary, fingerprint binary")


def _node(hashes: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(np.unique(hashes).tobytes())


def _matrix(prints: pa.Array, plan: Plan) -> np.ndarray:
    return np.frombuffer(b"".join(prints.to_pylist()), dtype=np.uint16).reshape(-1, plan.permutations)


def _banded(signed: DataFrame, plan: Plan, kept: pyspark.Broadcast | None) -> DataFrame:
    """``key, node`` of every band, or of those whose key passes the filter; a key is a hash of the band and its values."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows == 0:
                continue
            values = np.frombuffer(b"".join(batch.column("fingerprint").to_pylist()), dtype=np.uint16).reshape(-1, plan.permutations).astype(np.uint64)
            keys = np.empty((len(values), plan.bands), dtype=np.uint64)
            for band in range(plan.bands):
                key = np.full(len(values), band + 1, dtype=np.uint64)
                for k in range(plan.rows):
                    key = _mixed(key * _U(0x9E3779B97F4A7C15) + values[:, band * plan.rows + k])
                keys[:, band] = key
            at = np.repeat(np.arange(len(values)), plan.bands)
            keys = keys.ravel().view(np.int64)
            if kept is not None:
                good = passes(kept.value, keys & 0x7FFFFFFF)
                at, keys = at[good], keys[good]
            yield pa.RecordBatch.from_arrays([pa.array(keys), batch.column("node").take(pa.array(at))], names=["key", "node"])

    return signed.select("node", "fingerprint").mapInArrow(scan, "key long, node binary")


def _sets(nodes: DataFrame, docs: DataFrame, signed: DataFrame, plan: Plan, id_col: str, text_col: str) -> DataFrame:
    """``node, shingles`` of the given nodes: their sets of shingles as sorted 32-bit hashes, read from one text of each.

    A filter of bounded size keeps other texts from being shuffled.
    """
    sources = signed.join(nodes, "node", "left_semi").groupBy("node").agg(F.min(F.struct("id", "hash")).alias("at")).select("at.*")
    checksum = F.crc32(F.concat_ws(":", F.coalesce(F.col("id").cast("string"), F.lit("")), F.col("hash").cast("string")).cast("binary"))
    bits = docs.sparkSession.sparkContext.broadcast(filter_of(sources, checksum))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = Shingles(plan.shingle)
        for batch in batches:
            chosen = batch.filter(pa.array(passes(bits.value, batch.column("checksum").to_numpy())))
            for block in blocks([chosen], "text", STEP_BYTES):
                hashes, begin = shingles.of(block.column("text").to_pylist())
                own = [hashes[a:b] for a, b in zip(begin[:-1].tolist(), begin[1:].tolist(), strict=True)]
                sets = [np.unique(h >> _U(32)).astype(np.uint32).view(np.int32) for h in own]
                yield pa.RecordBatch.from_arrays([pa.array([_node(h) for h in own], pa.binary()), pa.array(sets, pa.list_(pa.int32()))], names=["node", "shingles"])

    texts = _by_id(docs, id_col, text_col).withColumn("checksum", checksum).select("text", "checksum")
    sets = texts.mapInArrow(scan, "node binary, shingles array<int>").join(nodes, "node", "left_semi").dropDuplicates(["node"])
    return materialise(sets, "fingerprint-shingles")


def _verified(pairs: DataFrame, sets: DataFrame, plan: Plan) -> DataFrame:
    """Those of ``pairs`` (nodes ``id_a, id_b``) whose shingles have at least the similarity, as the sets themselves say."""
    side = lambda c: sets.select(F.col("node").alias(f"id_{c}"), F.col("shingles").alias(f"set_{c}"))
    common = F.size(F.array_intersect("set_a", "set_b"))
    both = pairs.join(side("b"), "id_b").join(side("a"), "id_a")
    # in whole numbers, so that a pair exactly at the threshold is in
    similar = common * 1000 >= F.lit(round(plan.similarity * 1000)) * (F.size("set_a") + F.size("set_b") - common)
    return materialise(both.where(similar).select("id_a", "id_b"), "fingerprint-links")


def _labelled(members: DataFrame, links: DataFrame) -> DataFrame:
    """Members of buckets that hold more than one component, with their component's ``label``."""
    labels = min_labels(links).withColumnsRenamed({"notice_id": "node"})
    held = materialise(members.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node")), "fingerprint-held")
    open_ = held.groupBy("key").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low <> high").select("key")
    return materialise(held.join(open_, "key", "left_semi"), "fingerprint-open")


def _one_each(rows: DataFrame) -> DataFrame:
    """A pair for each node: with the member of one of its buckets that has the most company, if it is another one."""
    heads = rows.groupBy("key").agg(F.max(F.struct("company", "node")).alias("head"))
    pairs = rows.join(heads, "key").groupBy("node").agg(F.max("head")["node"].alias("head")).where("node <> head")
    return pairs.select(F.col("head").alias("id_a"), F.col("node").alias("id_b"))


def _overlaps(left: list[np.ndarray], right: list[np.ndarray], width: int = 4096) -> np.ndarray:
    """Sizes of all intersections of two lists of sets, by products of incidence matrices of some elements at a time."""
    every = np.concatenate([*left, *right])
    values, which, often = np.unique(every, return_inverse=True, return_counts=True)
    place = np.cumsum(often > 1) - 1  # an element of one set only is in no intersection
    owner = np.repeat(np.arange(len(left) + len(right)), [len(x) for x in (*left, *right)])
    shared = often[which] > 1
    owner, column = owner[shared], place[which[shared]]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    out = np.zeros((len(left), len(right)), dtype=np.float32)
    for start in range(0, int((often > 1).sum()), width):
        a, b = np.searchsorted(column, [start, start + width])
        block = np.zeros((len(left) + len(right), width), dtype=np.float32)
        block[owner[a:b], column[a:b] - start] = 1
        out += block[: len(left)] @ block[len(left) :].T
    return out


def _tiles(plan: Plan) -> Column:
    """Tiles of a group of ``size`` nodes with ``shingles`` in all."""
    return F.greatest(F.ceil(F.col("size") / plan.tile), F.ceil(F.col("shingles") / (plan.tile << 11))).cast("int")


def _dealt(rows: DataFrame, sets: DataFrame, plan: Plan) -> DataFrame:
    """``group, node, label, shingles`` of ``rows``, with the number of tiles of the group and the node's own."""
    rows = rows.join(sets, "node")
    sizes = rows.groupBy("group").agg(F.count("*").alias("size"), F.sum(F.size("shingles")).alias("shingles"))
    return rows.join(sizes.select("group", _tiles(plan).alias("tiles")), "group").withColumn("tile", F.pmod(F.xxhash64("node"), "tiles").cast("int"))


def _linking(dealt: DataFrame, plan: Plan) -> DataFrame:
    """Verified links between the sides of each tile pair (``group, low, high``) that join something; ``side`` 2 is both."""
    part = round(plan.similarity * 1000)

    def compare(rows: pd.DataFrame) -> pd.DataFrame:
        labels, names = pd.factorize(rows["label"])
        side, sets, nodes = rows["side"].to_numpy(), rows["shingles"].to_numpy(), rows["node"].to_numpy()
        a, b = np.flatnonzero(side != 1), np.flatnonzero(side != 0)
        root, found = list(range(len(names))), []

        def of(k: int) -> int:
            while root[k] != k:
                root[k] = k = root[root[k]]
            return k

        if len(a) and len(b):
            common = _overlaps([sets[i] for i in a], [sets[i] for i in b])
            either = np.array([len(sets[i]) for i in a])[:, None] + np.array([len(sets[i]) for i in b])[None, :] - common
            linked = (common * 1000 >= part * either) & (labels[a][:, None] != labels[b][None, :])
            for i, j in zip(*np.nonzero(linked), strict=True):
                x, y = of(labels[a[i]]), of(labels[b[j]])
                if x != y:
                    root[max(x, y)] = min(x, y)
                    found.append((nodes[a[i]], nodes[b[j]]))
        return pd.DataFrame(found, columns=["id_a", "id_b"])

    columns = ["group", "low", "high", "side", "node", "label", "shingles"]
    return dealt.select(*columns).groupBy("group", "low", "high").applyInPandas(compare, "id_a binary, id_b binary")


def _across(unsettled: DataFrame, sets: DataFrame, plan: Plan) -> DataFrame:
    """Verified links that join what is still apart in a bucket: no more of them than there are components in a tile pair.

    In each bucket one component has most members, often nearly all.  The others meet it once, not once a bucket: its
    nodes and all nodes that share such a bucket with it are two sides, cut into tiles, and every two tiles of either
    side are compared.  Among themselves the others are compared bucket by bucket, in the same way.
    """
    counts = unsettled.groupBy("key", "label").agg(F.count("*").alias("n"))
    main = counts.groupBy("key").agg(F.max(F.struct("n", "label"))["label"].alias("main"))
    rows = unsettled.join(main, "key")
    others = rows.where("label <> main")

    few = _dealt(others.select(F.col("main").alias("group"), "node", "label").distinct(), sets, plan)
    many = _dealt(rows.where("label = main").select(F.col("main").alias("group"), "node", "label").distinct(), sets, plan)
    sizes = lambda of: of.groupBy("group").agg(F.max("tiles").alias("facing"))
    facing = lambda of, tiles, own, other: of.join(tiles, "group").withColumn(own, F.col("tile")).withColumn(other, F.explode(F.sequence(F.lit(0), F.col("facing") - 1)))
    columns = ["group", "low", "high", "side", "node", "label", "shingles"]
    sides = facing(few, sizes(many), "low", "high").withColumn("side", F.lit(0)).select(*columns).unionByName(
        facing(many, sizes(few), "high", "low").withColumn("side", F.lit(1)).select(*columns)
    )

    apart = others.groupBy("key").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low <> high").select("key")
    each = _dealt(others.join(apart, "key", "left_semi").select(F.col("key").alias("group"), "node", "label"), sets, plan)
    each = each.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
    side = F.when(F.col("tile") == F.col("other"), 2).when(F.col("tile") < F.col("other"), 0).otherwise(1)
    each = each.withColumns({"low": F.least("tile", "other"), "high": F.greatest("tile", "other"), "side": side})
    return materialise(_linking(sides, plan).unionByName(_linking(each, plan)), "fingerprint-links")


def classes(docs: DataFrame, signed: DataFrame, plan: Plan = Plan(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, hash, class_id`` of every distinct (id, hash) of ``signed`` (stored ``signatures`` of ``docs``), stored.

    Two texts are linked if the Jaccard similarity of their shingles reaches ``plan.similarity``; a class is what links
    lead to, and ``class_id`` its smallest id (null if no text of it has one).  No rows give no classes.
    """
    spark = docs.sparkSession
    bands = _banded(signed, plan, None).select("key", F.xxhash64("node").alias("tag"))
    shared = bands.groupBy("key").agg(F.min("tag").alias("low"), F.max("tag").alias("high")).where("low <> high").select("key")
    shared = materialise(shared, "fingerprint-buckets")
    kept = spark.sparkContext.broadcast(filter_of(shared, F.col("key").bitwiseAND(0x7FFFFFFF)))
    members = materialise(_banded(signed, plan, kept).distinct().join(shared, "key", "left_semi"), "fingerprint-members")
    sets = _sets(members.select("node").distinct(), docs, signed, plan, id_col, text_col)

    # the member with the most company is nearest to all the others
    company = members.join(members.groupBy("key").agg(F.count("*").alias("n")), "key").groupBy("node").agg(F.sum("n").alias("company"))
    known = materialise(members.join(company, "node"), "fingerprint-company")
    links = _verified(_one_each(known), sets, plan)
    unsettled = _labelled(known, links)
    links = links.unionByName(_across(unsettled, sets, plan))

    labels = min_labels(links).withColumnsRenamed({"notice_id": "node"})
    least = signed.groupBy("node").agg(F.min("id").alias("id")).join(labels, "node", "left")
    least = least.select("node", "id", F.coalesce("label", "node").alias("label"))
    named = least.join(least.groupBy("label").agg(F.min("id").alias("class_id")), "label").select("node", "class_id")
    out = signed.select("id", "hash", "node").distinct().join(named, "node").select("id", "hash", "class_id")
    out = materialise(out, "fingerprint-classes")
    discard(shared, members, known, sets, unsettled)
    return out


RANGED = (
    "id long, n_chars long, edited_sha256 binary, fingerprint binary, edited_fingerprint binary, near_edited double, near_next double, class_id long, "
    "part int, first binary, last binary"
)


class _Range:
    """What a task needs to sign texts along a range of ids."""

    def __init__(self, plan: Plan):
        self.signer, self.shingles = Signer(plan), Shingles(plan.shingle)

    def rows(self, own: list[tuple], following: list[str]) -> list[list]:
        """Columns of ``RANGED`` up to ``class_id`` for (id, class, text) and the texts that follow, one less or as many."""
        texts = [text for *_, text in own]
        after = following[: len(texts)]
        new = [edited(*pair).encode() for pair in zip(texts, after, strict=False)]
        extra = following[len(texts) - 1 : len(texts)]  # only its fingerprint is asked for
        signatures = self.signer.sign(*self.shingles.of([t.encode() for t in texts] + new + [t.encode() for t in extra]))
        prints, changed = signatures[: len(texts)], signatures[len(texts) : len(texts) + len(new)]
        chain = np.concatenate([prints, signatures[len(texts) + len(new) :]])
        blank = [None] * (len(texts) - len(new))
        return [
            [key for key, *_ in own], [len(t) for t in texts], [hashlib.sha256(t).digest() for t in new] + blank, [p.tobytes() for p in prints],
            [p.tobytes() for p in changed] + blank, likeness(prints[: len(new)], changed).tolist() + blank, likeness(chain[:-1], chain[1:]).tolist() + blank,
            [label for _, label, _ in own],
        ]


def _along(plan: Plan):
    """Through the texts of a range in order; the range's first and last text are handed on, the last one unedited."""
    kinds = [pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.float64(), pa.float64(), pa.int64(), pa.int32(), pa.binary(), pa.binary()]
    names = [c.split()[0] for c in RANGED.split(", ")]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step, unpack, pack = _Range(plan), zstandard.ZstdDecompressor(), zstandard.ZstdCompressor()
        part = pyspark.TaskContext.get().partitionId()
        began, size, label = False, 0, None
        held: list[tuple] = []

        def made(own: list[tuple], following: list[str], end: bool) -> pa.RecordBatch:
            nonlocal began
            first = [None] * len(own) if began else [pack.compress(own[0][2].encode())] + [None] * (len(own) - 1)
            last = [None] * (len(own) - 1) + [pack.compress(own[-1][2].encode()) if end else None]
            began = True
            columns = [*step.rows(own, following), [part] * len(own), first, last]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

        for batch in batches:
            for key, value, packed in zip(*(batch.column(c).to_pylist() for c in ("id", "class_id", "text")), strict=True):
                if packed is None:  # the class of the rows that follow
                    label = value
                    continue
                text = unpack.decompress(packed).decode()
                held.append((key, label, text))
                size += len(text)
                if size > STEP_BYTES // 2 and len(held) > 1:
                    yield made(held[:-1], [t for *_, t in held[1:]], False)
                    held, size = held[-1:], len(text)
        if len(held) > 1:
            yield made(held[:-1], [t for *_, t in held[1:]], False)
        if held:
            yield made(held[-1:], [], True)

    return scan


def _closed(plan: Plan):
    """The last text of each range, edited with the one that follows."""
    kinds = [pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.float64(), pa.float64(), pa.int64()]
    names = [c.split()[0] for c in RANGED.split(", ")][: len(kinds)]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step, unpack = _Range(plan), zstandard.ZstdDecompressor()
        for batch in batches:
            for key, label, own, after in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                columns = step.rows([(key, label, unpack.decompress(own).decode())], [unpack.decompress(after).decode()])
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

    return scan


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    pack = zstandard.ZstdCompressor(level=3)
    for batch in batches:
        packed = pa.array([pack.compress(t) for t in batch.column("text").to_pylist()], pa.binary())
        yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("hash"), packed], names=["id", "hash", "text"])


def found(docs: DataFrame, plan: Plan = Plan(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every row with its fingerprint, its class, its edited text's fingerprint, and the likeness to that and to the next row.

    ``id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next, class_id``.  The next row is by
    id, null ids first, ties by a hash of the text, and the first one after the last.  A null text is an empty one; a row
    that is alone follows itself; repeated rows keep a row each; no rows give no rows; other columns are not read.
    """
    signed = materialise(signatures(docs, plan, id_col, text_col), "fingerprint-signed")
    labels = classes(docs, signed, plan, id_col, text_col)
    discard(signed)
    texts = _by_id(docs, id_col, text_col).mapInArrow(_packed, "id long, hash long, text binary")
    # a class travels as a row before those of its id and text
    rows = labels.withColumn("text", F.lit(None).cast("binary")).unionByName(texts.withColumn("class_id", F.lit(None).cast("long")))
    ordered = rows.repartitionByRange("id", "hash").sortWithinPartitions("id", "hash", F.col("text").isNotNull())
    ranged = materialise(ordered.select("id", "class_id", "text").mapInArrow(_along(plan), RANGED), "fingerprint-ranges")

    columns = [c.split()[0] for c in RANGED.split(", ")][:8]
    firsts = ranged.where("first IS NOT NULL").select("part", F.col("first").alias("following"))
    order = Window.orderBy("part")  # one row a range
    parts = firsts.select("part", F.coalesce(F.lead("part").over(order), F.min("part").over(Window.partitionBy())).alias("then"))
    lasts = ranged.where("last IS NOT NULL").select("id", "class_id", "last", "part").join(parts, "part")
    lasts = lasts.join(firsts.withColumnRenamed("part", "then"), "then").select("id", "class_id", "last", "following")
    closed = lasts.mapInArrow(_closed(plan), ", ".join(RANGED.split(", ")[:8]))
    return ranged.where("last IS NULL").select(*columns).unionByName(closed)
