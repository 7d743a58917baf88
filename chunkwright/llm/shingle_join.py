"""N-gram Jaccard join with signature trees.

A document's set is its distinct shingles of `words` words, A-Z in lower case; with fewer words the whole sequence is
its one shingle, and without words the set is empty and linked with nothing. Two documents link if
100 * intersection >= percent * union. Shingles are compared by 64-bit hashes over keyed BLAKE2b hashes of their words.

Documents with the same set form a class, found by a digest of the set; a class is joined once, whatever its copies.
The join is partitioned by the smallest shingle of each class under `orders` random orders: two sets with similarity s
have such a shingle in common with probability s in each order, so a pair at 0.85 shares no partition with probability
0.15**14 = 3e-12. Shingles that bring up one class only are dropped, and of those that bring up the same classes one
stays, all by counts and digests in the JVM; then each class's text goes, once for each group that is left, to a bucket.

A bucket's sets are joined by one signature tree: leaves of LEAF sets in order of group and size, nodes with the OR of
their token bitmaps and their range of sizes. A dual traversal goes down level by level and drops node pairs whose
largest possible overlap is too small for any two of their sets. Leaf pairs that are left are taken from near to far;
those whose sets are all connected already go too, and bitmaps of single sets leave the pairs that are compared shingle
by shingle. So only links that join two parts are returned: connected classes keep one path, not all pairs. A group with
more than group_rows classes, or more than four times block_bytes, is cut to tiles, and each pair of tiles is a group.

Null text has no words. Texts of any length are read whole. Rows are told apart by doc_id and text: repeated doc_ids are
joined as the rows they are; a null doc_id is never the smallest of a component unless it has no other. An empty table
gives an empty result. Columns other than doc_id and text aren't read, and keep_one returns all columns of docs.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chunkwright.llm import shared
from chunkwright.llm.components import components

WORDS, PERCENT, ORDERS = 4, 85, 14
BLOCK_BYTES = 4 << 20
GROUP_ROWS = 20_000
LEAF, FAN = 16, 8
#: Bits of a node's bitmap and of a single set's, as powers of two. Sets are told apart by the high bits of their hashes.
NODE_BITS, SET_BITS = 15, 11
PAIRS_AT_ONCE = 2048

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = bytes.maketrans(bytes(range(0x41, 0x5B)), bytes(range(0x61, 0x7B)))
_RANDOM = np.random.default_rng(20240229)
_ORDER_CODES = _RANDOM.integers(1, 1 << 63, 128, np.uint64) | np.uint64(1)
_KEY = _RANDOM.bytes(16)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def _shingled(w: np.ndarray, n: int) -> np.ndarray:
    h = np.zeros(len(w) - n + 1, np.uint64)
    for k in range(n):
        h = _mixed(h + w[k : len(w) - n + 1 + k] * _ORDER_CODES[64 + k])
    return h


def _distinct(h: np.ndarray) -> np.ndarray:
    h = np.sort(h)
    return h[np.concatenate([[True], h[1:] != h[:-1]])] if len(h) else h


def shingle_sets(texts: list[bytes], words: int = WORDS) -> list[np.ndarray]:
    """Sorted distinct 64-bit hashes of the shingles of each text. Arrow numbers the distinct words of all texts, so each is hashed once."""
    flat = np.frombuffer((b"\n".join(texts) + b"\n").translate(_LOWER), np.uint8)
    inside = ~_SPACE[flat]
    edge = np.flatnonzero(np.diff(inside, prepend=False, append=False))
    start, size = edge[::2], edge[1::2] - edge[::2]
    ends = np.cumsum([len(t) + 1 for t in texts])
    count = np.diff(np.searchsorted(start, ends), prepend=0)
    if not len(start):
        return [np.zeros(0, np.uint64)] * len(texts)
    offsets = np.concatenate([[0], np.cumsum(size)])
    coded = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(start), [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(flat[inside])]).dictionary_encode()
    digests = b"".join([hashlib.blake2b(x, digest_size=8, key=_KEY).digest() for x in coded.dictionary.to_pylist()])
    w = np.frombuffer(digests, "<u8")[coded.indices.to_numpy()]
    out = []
    with np.errstate(over="ignore"):
        h = _shingled(w, words) if len(w) >= words else w[:0]
        for at, n in zip((np.cumsum(count) - count).tolist(), count.tolist(), strict=True):
            out.append(_distinct(h[at : at + n - words + 1] if n >= words else _shingled(w[at : at + n], n)) if n else w[:0])
    return out


def shingle_set(text: bytes, words: int = WORDS) -> np.ndarray:
    return shingle_sets([text], words)[0]


def smallest(sets: list[np.ndarray], orders: int = ORDERS) -> np.ndarray:
    """For each set, which isn't empty, its smallest shingle under each order, as a key that no other order has."""
    size = np.array([len(s) for s in sets])
    flat, at = np.concatenate(sets), np.cumsum(size) - size
    with np.errstate(over="ignore"):
        least = [np.minimum.reduceat((flat ^ _ORDER_CODES[2 * k]) * _ORDER_CODES[2 * k + 1], at) for k in range(orders)]
        return np.stack([_mixed(x + np.uint64(k)) for k, x in enumerate(least)], axis=1)


def linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    if len(a) > len(b):
        a, b = b, a
    if 100 * len(a) < percent * len(b):
        return False
    both = int(np.count_nonzero(b[np.minimum(np.searchsorted(b, a), len(b) - 1)] == a))
    return 100 * both >= percent * (len(a) + len(b) - both)


class Parts:
    """Union-find."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def root(self, i: int) -> int:
        up = self.up
        while up[i] != i:
            up[i] = up[up[i]]
            i = up[i]
        return i

    def roots(self) -> np.ndarray:
        up = np.array(self.up)
        while (up != (up := up[up])).any():
            pass
        return up

    def join(self, i: int, j: int) -> None:
        self.up[self.root(i)] = self.root(j)


def _bitmaps(sets: list[np.ndarray], bits: int, node: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """OR-combined bitmaps of the sets of each node (numbered in ascending order), and the shingles of each set that share a bit with another."""
    size = np.array([len(x) for x in sets])
    bit = (np.concatenate(sets) >> np.uint64(64 - bits)).astype(np.int64)
    begins = np.cumsum(size) - size
    new = np.ones(len(bit), bool)
    new[1:] = bit[1:] != bit[:-1]
    new[begins] = True
    extra = size - np.add.reduceat(new, begins, dtype=np.int64)
    out = []
    for lo in range(0, int(node[-1]) + 1, 1024):  # a bounded number of bytes at once
        a, z = np.searchsorted(node, (lo, lo + 1024))
        own = slice(int(begins[a]), int(begins[z - 1] + size[z - 1]))
        maps = np.zeros((int(node[z - 1]) - lo + 1, 1 << bits), bool)
        maps[np.repeat(node[a:z] - lo, size[a:z]), bit[own]] = True
        out.append(np.packbits(maps, axis=1).view(np.uint64))
    return np.concatenate(out), extra


class SignatureTree:
    """Leaves of sets in the order of members; nodes hold OR-combined token bitmaps, size ranges and the largest count of bit collisions."""

    def __init__(self, members: list[int], sets: list[np.ndarray]):
        self.members = np.array(members)
        own = [sets[i] for i in members]
        self.size = np.array([len(x) for x in own])
        leaf = np.arange(len(own)) // LEAF
        self.maps, _ = _bitmaps(own, SET_BITS, np.arange(len(own)))
        maps, extra = _bitmaps(own, NODE_BITS, leaf)
        cuts, least, most = np.arange(0, len(own), LEAF), self.size, self.size
        self.levels = []
        while True:
            least, most, extra = np.minimum.reduceat(least, cuts), np.maximum.reduceat(most, cuts), np.maximum.reduceat(extra, cuts)
            self.levels.append((maps, least, most, extra))
            if len(maps) == 1:
                break
            cuts = np.arange(0, len(maps), FAN)
            maps = np.bitwise_or.reduceat(maps, cuts)

    def may(self, level: int, x: np.ndarray, y: np.ndarray, percent: int) -> np.ndarray:
        """False for pairs of nodes of which no two sets can link."""
        maps, least, most, extra = self.levels[level]
        out = 100 * np.minimum(most[x], most[y]) >= percent * np.maximum(least[x], least[y])
        for i in range(0, len(x), PAIRS_AT_ONCE):
            k = i + np.flatnonzero(out[i : i + PAIRS_AT_ONCE])
            a, b = x[k], y[k]
            both = np.bitwise_count(maps[a] & maps[b]).sum(axis=1, dtype=np.int64) + np.minimum(extra[a], extra[b])
            both = np.minimum(both, np.minimum(most[a], most[b]))
            out[k] = 100 * both >= percent * (least[a] + least[b] - both)
        return out

    def leaf_pairs(self, percent: int) -> tuple[np.ndarray, np.ndarray]:
        """Pairs of leaves that the traversal can't drop, near ones first."""
        x = y = np.zeros(1, np.int64)
        for level in range(len(self.levels) - 1, -1, -1):
            keep = self.may(level, x, y, percent)
            x, y = x[keep], y[keep]
            if level:
                n = len(self.levels[level - 1][0])
                i, j = np.divmod(np.arange(FAN * FAN), FAN)
                below = (FAN * x[:, None] + i).ravel(), (FAN * y[:, None] + j).ravel()
                keep = (below[0] <= below[1]) & (below[1] < n)
                x, y = below[0][keep], below[1][keep]
        order = np.lexsort((x, y - x))
        return x[order], y[order]

    def join(self, sets: list[np.ndarray], parts: Parts, percent: int, found: list[tuple[int, int]]) -> None:
        """Adds to found the links that join two parts; near pairs first, so that large groups are soon one part."""
        x, y = self.leaf_pairs(percent)
        n, at, step = len(self.members), 0, 64
        i, j = np.divmod(np.arange(LEAF * LEAF), LEAF)
        while at < len(x):
            root = parts.roots()[self.members]
            cuts = np.arange(0, n, LEAF)
            low, high = np.minimum.reduceat(root, cuts), np.maximum.reduceat(root, cuts)
            part = np.where(low == high, low, -1 - np.arange(len(cuts)))
            two = part[x[at:]] != part[y[at:]]
            two |= part[x[at:]] < 0
            x, y, at = x[at:][two], y[at:][two], 0
            a, b = (LEAF * x[:step, None] + i).ravel(), (LEAF * y[:step, None] + j).ravel()
            keep = (a < b) & (b < n)
            a, b = a[keep], b[keep]
            keep = root[a] != root[b]
            a, b = a[keep], b[keep]
            keep = 100 * np.minimum(self.size[a], self.size[b]) >= percent * np.maximum(self.size[a], self.size[b])
            a, b = a[keep], b[keep]
            only = np.maximum(self.size[a] - np.bitwise_count(self.maps[a] & ~self.maps[b]).sum(axis=1, dtype=np.int64), 0)
            both = np.minimum(only, self.size[b] - np.bitwise_count(self.maps[b] & ~self.maps[a]).sum(axis=1, dtype=np.int64))
            keep = 100 * both >= percent * (self.size[a] + self.size[b] - both)
            for p, q in zip(self.members[a[keep]].tolist(), self.members[b[keep]].tolist(), strict=True):
                if parts.root(p) != parts.root(q) and linked(sets[p], sets[q], percent):
                    parts.join(p, q)
                    found.append((p, q))
            at = step
            step = min(2 * step, 512)


def _runs(texts: list[bytes], most: int = 2 << 20) -> Iterator[slice]:
    """Runs of texts of about that many bytes; a longer text is a run of its own."""
    at = size = 0
    for i, t in enumerate(texts):
        if i > at and size + len(t) > most:
            yield slice(at, i)
            at, size = i, 0
        size += len(t)
    if texts:
        yield slice(at, len(texts))


def _described(words: int, orders: int):
    """Adds to each row the size and digest of its set, and to the first row of a class in a task the class's keys."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shared.worker_memory("shingle_join")
        seen: set[bytes] = set()
        for batch in shared.small_batches(batches, 2048):
            texts = [t or b"" for t in batch.column(3).cast(pa.binary()).to_pylist()]
            sets = [s for own in _runs(texts) for s in shingle_sets(texts[own], words)]
            cls = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets]
            keys: list = [None] * len(sets)
            first = []
            for i, c in enumerate(cls):
                if c is not None and c not in seen:
                    seen.add(c)
                    first.append(i)
            for own in _runs([texts[i] for i in first]):
                pick = first[own]
                for i, k in zip(pick, smallest([sets[i] for i in pick], orders).view(np.int64), strict=True):
                    keys[i] = k
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(2), pa.array([len(s) for s in sets], pa.int64()), pa.array(cls, pa.binary()), pa.array(keys, pa.list_(pa.int64()))], names=["doc_id", "k1", "k2", "n", "cls", "keys"])

    return run


def _meet(words: int, percent: int):
    """Joins the sets of a bucket."""

    def run(table: pa.Table) -> pa.Table:
        shared.worker_memory("shingle_join")
        place: dict[bytes, int] = {}
        group: list[int] = []
        texts: list[bytes] = []
        for key, cls, text in zip(table.column("key").to_pylist(), table.column("cls").to_pylist(), table.column("text").cast(pa.binary()).to_pylist(), strict=True):
            if cls not in place:
                place[cls] = len(texts)
                texts.append(text)
                group.append(key)
        sets = [s for own in _runs(texts) for s in shingle_sets(texts[own], words)]
        parts, links, names = Parts(len(sets)), [], list(place)
        order = sorted(range(len(sets)), key=lambda i: (group[i], len(sets[i]), names[i]))
        if len(order) > 1:
            SignatureTree(order, sets).join(sets, parts, percent, links)
        return pa.Table.from_pydict({"a": pa.array([names[i] for i, _ in links], pa.binary()), "b": pa.array([names[j] for _, j in links], pa.binary())})

    return run


def shingle_links(docs: DataFrame, words: int = WORDS, percent: int = PERCENT, orders: int = ORDERS, block_bytes: int = BLOCK_BYTES, group_rows: int = GROUP_ROWS) -> tuple[DataFrame, DataFrame]:
    """(doc_id, k1, k2, n, cls) of each row, k1 and k2 its hashes, cls null for empty sets; and links (a, b) between classes that join all that are connected.

    A bucket holds about block_bytes of texts, by eight bytes for each shingle.
    """
    shared.shared_dir(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("doc_id", "text").alias("k1"), F.xxhash64("text", "doc_id", F.lit(1)).alias("k2"), "text")
    found = shared.written(rows.mapInArrow(_described(words, orders), "doc_id long, k1 long, k2 long, n long, cls binary, keys array<long>"), "shingles")
    # One row of each class stands for it.
    classes = found.where("keys is not null").groupBy("cls").agg(F.min(F.struct("k1", "k2", "n", "keys")).alias("o")).select("cls", "o.*")
    single = classes.select("cls", "k1", "k2", "n", F.explode("keys").alias("key"))
    # Groups of two classes or more; of those with the same classes one is enough.
    mark = [F.bit_xor(F.xxhash64("cls", F.lit(i))) for i in (1, 2)]
    shape = single.groupBy("key").agg(F.count("*").alias("total"), F.sum("n").alias("tokens"), mark[0].alias("m1"), mark[1].alias("m2")).where("total > 1")
    groups = shared.written(shape.groupBy("total", "tokens", "m1", "m2").agg(F.min("key").alias("key")).select("key", "total", "tokens"), "groups")
    buckets = max(1, -(-8 * (groups.agg(F.sum("tokens")).first()[0] or 0) // block_bytes))
    tiles = F.greatest(F.ceil(F.col("total") / group_rows), F.ceil(8 * F.col("tokens") / (4 * block_bytes)))
    wanted = single.join(groups.withColumn("tiles", tiles), "key").withColumn("tile", F.pmod(F.xxhash64("cls"), "tiles"))
    # A row of tile t goes to the tile pairs of t and any other.
    pairs = F.expr("case when tiles > 1 then transform(sequence(0L, tiles - 1), j -> xxhash64(key, least(tile, j), greatest(tile, j))) else array(key) end")
    wanted = wanted.groupBy("k1", "k2", "cls").agg(F.flatten(F.collect_list(pairs)).alias("keys"))
    sent = rows.select("k1", "k2", "text").join(wanted, ["k1", "k2"]).select("cls", F.explode("keys").alias("key"), "text")
    met = sent.withColumn("bucket", F.pmod(F.xxhash64("key"), F.lit(buckets).cast("long"))).groupBy("bucket")
    return found.select("doc_id", "k1", "k2", "n", "cls"), met.applyInArrow(_meet(words, percent), "a binary, b binary")


def shingle_components(docs: DataFrame, **options) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest doc_id reachable), class_id (smallest doc_id with the same set) of every row, and its hashes k1 and k2."""
    found, links = shingle_links(docs, **options)
    classes = found.where("cls is not null").groupBy("cls").agg(F.min("doc_id").alias("class_id"))
    node = F.struct(F.col("class_id").isNull().alias("no_id"), "class_id", "cls")
    nodes = classes.select("cls", node.alias("node"))
    edges = links.distinct().join(nodes.select(F.col("cls").alias("a"), F.col("node").alias("u")), "a").join(nodes.select(F.col("cls").alias("b"), F.col("node").alias("v")), "b")
    roots = components(edges.select("u", "v")).select(F.col("node.cls").alias("cls"), F.col("root.class_id").alias("root_id"))
    named = classes.join(roots, "cls", "left").select("cls", "class_id", F.coalesce("root_id", "class_id").alias("component_id"))
    # A class may hold a third of all rows: named has a row for each class, and Spark can split the rows' side.
    out = found.join(named, "cls", "left")
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"), F.coalesce("class_id", "doc_id").alias("class_id"), "k1", "k2")


def keep_one(docs: DataFrame, **options) -> DataFrame:
    """docs without the rows whose component has a smaller doc_id. Rows without a doc_id stay; rows that share doc_id and text stay or go together.

    A row is told by its doc_id and hashes of its text, so that others of the same doc_id don't go with it.
    """
    found = shingle_components(docs, **options).where("doc_id > component_id").select(F.col("doc_id").alias("_gone"), "k1", "k2").distinct()
    own = (F.col("doc_id").cast("long") == F.col("_gone")) & (F.xxhash64("doc_id", "text") == F.col("k1")) & (F.xxhash64("text", "doc_id", F.lit(1)) == F.col("k2"))
    hidden = shared.hidden(docs, ("doc_id", "text"))
    return shared.shown(hidden.join(found, own, "left_anti"), docs, ("doc_id", "text"))


def op8_shingle_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shingle_components(shared.documents(spark, sf_dir)).drop("k1", "k2")


QUERIES = {"op8_shingle_join": op8_shingle_join}
ORACLES: dict[str, str] = {}
