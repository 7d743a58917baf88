"""Removal of byte strings that an earlier document has, by prefix-free parsing.

A rolling hash over GRAM bytes marks triggers: in every string of `length` bytes the position with the least hash is
one. Triggers cut a text to phrases, and any suffix of the text is a phrase suffix (bytes up to the next trigger)
followed by a parse suffix (text from a trigger on). Suffixes are wanted to a depth of `length` bytes only. So

1. each block of documents sends the hashes of its triggers to buckets of hashes, and hears which occur again;
2. for those it sends the segments around the trigger: all strings of `length` bytes that share it, once for each
   distinct segment and with the smallest doc_id of the block;
3. a bucket sorts its parse suffixes and its phrase suffixes (read backwards from the trigger), which with the common
   prefixes of neighbours gives their classes at every depth, and combines the two to the order of the corpus: two
   strings are the same if their phrase suffix and their parse suffix are in one class. Bytes are compared, not
   hashes. The smallest doc_id of each class decides;
4. each block hears, for each segment sent, which of its strings an earlier document has, and marks their bytes.

Blocks hold about BLOCK_BYTES of text and buckets about as many hashes as a block, at any size of the input. A block
sends a segment once, however many copies it holds, so a passage that a third of all documents share reaches a
bucket at most once from each block. A trigger with more than `wide` occurrences sends its strings one by one, each to the
bucket of its own hash, so that no trigger fills a bucket.

Matches are between documents only, by doc_id: rows with the same doc_id don't remove from each other, and a null
doc_id counts as smaller than all others. Null texts are empty; a text shorter than `length` loses nothing. Long texts
are read whole, though one text is never cut: its arrays of some 80 bytes for each byte must fit a task. An empty table
gives an empty result. Repeated rows are results of their own. Columns other than doc_id and text aren't read.

Each block writes a row to each bucket that it has hashes for, so rows grow with the square of the input while bytes grow
with the input, until a row holds one hash; see the README for figures.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chunkwright.llm import shared

LENGTH = 50
GRAM = 16
BLOCK_BYTES = 4 << 20
PIECE_BYTES = 1 << 20
WIDE = 1 << 18
NULL_ID = -(1 << 63)

_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_MIX = np.uint64(0xD6E8FEB86659FD93)
_HIGH = np.uint64(0xFFFFFFFF00000000)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * _MIX
    return (h ^ (h >> np.uint64(29))) * _MIX


def gram_hashes(flat: np.ndarray, n: int) -> np.ndarray:
    """Rolling polynomial hash of the GRAM bytes at each of the first n positions, mixed."""
    h, power, k = flat.astype(np.uint64) + np.uint64(1), _BASE, 1
    with np.errstate(over="ignore"):
        while k < GRAM:
            h = h[:-k] * power + h[k:]
            power, k = power * power, 2 * k
        return _mixed(h[:n])


def _window_min(v: np.ndarray, slots: int) -> np.ndarray:
    """Minimum over each run of that many values."""
    k = 1
    while 2 * k <= slots:
        v = np.minimum(v[:-k], v[k:])
        k *= 2
    return np.minimum(v[: len(v) - (slots - k)], v[slots - k :]) if slots > k else v


def segments(texts: list[bytes], length: int) -> tuple[np.ndarray, ...]:
    """Of the texts put end to end: bytes (with room behind), document, trigger, hash, first and last string of each segment."""
    size = np.array([len(t) for t in texts], np.int64)
    flat = np.frombuffer(b"".join(texts) + bytes(2 * length + GRAM), np.uint8)
    n, ends = int(size.sum()), np.cumsum(size)
    h = gram_hashes(flat, n + length)
    low = _window_min((h & _HIGH) | np.arange(len(h), dtype=np.uint64), length - GRAM + 1)
    doc = np.repeat(np.arange(len(texts)), size)
    at = np.flatnonzero(np.arange(n) + length <= ends[doc])
    if not len(at):
        none = np.zeros(0, np.int64)
        return flat, none, none, none.astype(np.uint64), none, none
    trigger = (low[at] & np.uint64(0xFFFFFFFF)).astype(np.int64)
    new = np.flatnonzero(np.concatenate([[True], trigger[1:] != trigger[:-1]]))
    last = at[np.concatenate([new[1:], [len(at)]]) - 1]
    return flat, doc[at[new]], trigger[new], h[trigger[new]], at[new], last


class Block:
    """The documents of a block in order of doc_id and text, and their segments, found piece by piece."""

    def __init__(self, table: pa.Table, length: int):
        rows = sorted((NULL_ID if i is None else i, t or b"") for i, t in zip(table.column("doc_id").to_pylist(), table.column("text").cast(pa.binary()).to_pylist(), strict=True))
        self.ids, self.texts, self.length = np.array([r[0] for r in rows], np.int64), [r[1] for r in rows], length

    def pieces(self):
        at = 0
        while at < len(self.texts):
            to, size = at, 0
            while to < len(self.texts) and (to == at or size + len(self.texts[to]) <= PIECE_BYTES):
                size += len(self.texts[to])
                to += 1
            yield at, to, segments(self.texts[at:to], self.length)
            at = to


class Records:
    """What a block sends for its repeated triggers: distinct segments, sorted by hash, with the smallest doc_id of each.

    left: bytes before the trigger, read backwards; right: bytes from it on; both with zeros behind what belongs to
    the segment. least, most: how far before the trigger the segment's last and first strings begin.
    """

    def __init__(self, block: Block, hot: np.ndarray, wide: np.ndarray):
        length, before = block.length, block.length - GRAM
        parts: list[tuple[np.ndarray, ...]] = []
        for at, _, (flat, doc, trigger, key, first, last) in block.pieces():
            pick = _within(key, hot)
            doc, trigger, key, first, last = doc[pick], trigger[pick], key[pick], first[pick], last[pick]
            if len(wide):
                own = _within(key, wide)
                count = np.where(own, last - first + 1, 1)
                back = np.repeat(np.arange(len(key)), count)
                step = np.arange(len(back)) - np.repeat(np.cumsum(count) - count, count)
                single = own[back]
                doc, trigger, key, last, first = doc[back], trigger[back], key[back], np.where(single, first[back] + step, last[back]), first[back] + step * single
            else:
                single = np.zeros(len(key), bool)
            least, most = trigger - last, trigger - first
            left = flat[np.maximum(trigger[:, None] - 1 - np.arange(before), 0)]
            left[np.arange(before) >= most[:, None]] = 0
            right = flat[trigger[:, None] + np.arange(length)]
            right[np.arange(length) >= (length - least)[:, None]] = 0
            parts.append((np.full(len(key), at) + doc, key, single, least, most, left, right, first + 0, np.full(len(key), at)))
        doc, key, single, least, most, left, right, self.first, self.piece = map(np.concatenate, zip(*parts, strict=True)) if parts else (np.zeros(0, np.int64),) * 9
        self.doc = doc
        if not len(doc):
            self.n, self.key, self.of = 0, np.zeros(0, np.uint64), np.zeros(0, np.int64)
            return
        self.least, self.most = least, most
        words = np.zeros((len(doc), -(-(before + length + 2) // 8) * 8), np.uint8)
        words[:, :before], words[:, before : before + length] = left, right
        words[:, before + length], words[:, before + length + 1] = least, most
        with np.errstate(over="ignore"):
            mark = np.full(len(doc), 7, np.uint64)
            for w in words.view("<u8").T:
                mark = _mixed(mark * _BASE + w)
            key = np.where(single, mark, key)
        order = np.lexsort((block.ids[doc], mark, key))
        new = np.ones(len(order), bool)
        new[1:] = (key[order][1:] != key[order][:-1]) | (mark[order][1:] != mark[order][:-1])
        self.of = np.empty(len(order), np.int64)
        self.of[order] = np.cumsum(new) - 1
        pick = order[new]
        self.n, self.key, self.id = len(pick), key[pick], block.ids[doc[pick]]
        self.sent = np.concatenate([left[pick], right[pick], least[pick, None].astype(np.uint8), most[pick, None].astype(np.uint8)], axis=1)


def _within(keys: np.ndarray, chosen: np.ndarray) -> np.ndarray:
    """chosen is sorted."""
    if not len(chosen):
        return np.zeros(len(keys), bool)
    return chosen[np.minimum(np.searchsorted(chosen, keys), len(chosen) - 1)] == keys


def _zip(data: np.ndarray) -> bytes:
    raw = np.ascontiguousarray(data).tobytes()
    return len(raw).to_bytes(8, "little") + pa.compress(raw, codec="zstd", asbytes=True)


def _unzip(data: bytes) -> bytes:
    return pa.decompress(data[8:], decompressed_size=int.from_bytes(data[:8], "little"), codec="zstd", asbytes=True)


def _per_bucket(key: np.ndarray, buckets: int):
    """(bucket, indexes in ascending order) for sorted keys."""
    bucket = (key % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    values, cuts = np.unique(bucket[order], return_index=True)
    return zip(values.tolist(), np.split(order, cuts[1:]), strict=True) if len(values) else ()


def _common(rows: np.ndarray) -> np.ndarray:
    """Bytes that each row but the first has in common with the row before."""
    differ = rows[1:] != rows[:-1]
    return np.where(differ.any(axis=1), differ.argmax(axis=1), rows.shape[1])


def _classes(key: np.ndarray, rows: np.ndarray):
    """A function from a depth to class numbers: rows of one key with the same bytes to that depth. It sorts the rows as a suffix array would."""
    width = -(-rows.shape[1] // 8) * 8
    words = np.zeros((len(rows), width), np.uint8)
    words[:, : rows.shape[1]] = rows
    order = np.lexsort((*words.view(">u8").astype(np.uint64).T[::-1], key))
    common = _common(rows[order])
    other = key[order][1:] != key[order][:-1]

    def at(depth: int) -> np.ndarray:
        out = np.empty(len(order), np.int64)
        out[order] = np.concatenate([[0], np.cumsum(other | (common < depth))])
        return out

    return at


def earlier(key: np.ndarray, doc_id: np.ndarray, left: np.ndarray, right: np.ndarray, least: np.ndarray, most: np.ndarray, length: int) -> np.ndarray:
    """For each segment, bit s is set if its string that begins s bytes before the trigger is in a segment with a smaller doc_id."""
    out = np.zeros(len(key), np.uint64)
    if not len(key):
        return out
    phrase, parse = _classes(key, left), _classes(key, right)
    for s in range(int(most.max()) + 1):
        rows = np.flatnonzero((least <= s) & (s <= most))
        if len(rows) < 2:
            continue
        both = phrase(s)[rows] * len(key) + parse(length - s)[rows]
        order = np.argsort(both, kind="stable")
        new = np.flatnonzero(np.concatenate([[True], both[order][1:] != both[order][:-1]]))
        first = np.repeat(np.minimum.reduceat(doc_id[rows][order], new), np.diff(np.append(new, len(order))))
        out[rows[order[first < doc_id[rows][order]]]] |= np.uint64(1 << s)
    return out


def dedup_bytes(docs: DataFrame, length: int = LENGTH, block_bytes: int = BLOCK_BYTES, wide: int = WIDE) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 and kept (the bytes left) of every row. length: 17 to 64 + GRAM."""
    spark = docs.sparkSession
    shared.shared_dir(spark)
    n = shared.parts_for(docs, block_bytes)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.pmod(F.xxhash64("doc_id", "text"), F.lit(n).cast("long")).alias("block"))
    before = length - GRAM

    def sent(key: tuple, table: pa.Table) -> pa.Table:
        keys = [s[3] for _, _, s in Block(table, length).pieces()]
        found, count = np.unique(np.concatenate(keys) if keys else np.zeros(0, np.uint64), return_counts=True)
        out = [(b, key[0].as_py(), _zip(found[i]), _zip(np.minimum(count[i], 65535).astype("<u2"))) for b, i in _per_bucket(found, n)]
        return pa.Table.from_pylist([dict(zip(("bucket", "block", "keys", "counts"), r, strict=True)) for r in out], pa.schema([("bucket", pa.int64()), ("block", pa.int64()), ("keys", pa.binary()), ("counts", pa.binary())]))

    answer = pa.schema([("block", pa.int64()), ("kind", pa.int64()), ("bucket", pa.int64()), ("data", pa.binary())])

    def again(key: tuple, table: pa.Table) -> pa.Table:
        keys = [np.frombuffer(_unzip(x), "<u8") for x in table.column("keys").to_pylist()]
        counts = np.concatenate([np.frombuffer(_unzip(x), "<u2") for x in table.column("counts").to_pylist()])
        _, which = np.unique(np.concatenate(keys), return_inverse=True)
        total = np.bincount(which, weights=counts)[which]
        cuts, out = np.cumsum([len(k) for k in keys])[:-1], []
        for block, k, t in zip(table.column("block").to_pylist(), keys, np.split(total, cuts), strict=True):
            for kind, pick in ((0, (t > 1) & (t <= wide)), (1, t > wide)):
                if pick.any():
                    out.append({"block": block, "kind": kind, "bucket": key[0].as_py(), "data": _zip(k[pick])})
        return pa.Table.from_pylist(out, answer)

    def keys_of(table: pa.Table, kind: int) -> np.ndarray:
        found = [np.frombuffer(_unzip(d), "<u8") for k, d in zip(table.column("kind").to_pylist(), table.column("data").to_pylist(), strict=True) if k == kind]
        return np.sort(np.concatenate(found)) if found else np.zeros(0, np.uint64)

    def records(table: pa.Table, heard: pa.Table) -> tuple[Block, Records]:
        block, wide_keys = Block(table, length), keys_of(heard, 1)
        return block, Records(block, np.sort(np.concatenate([keys_of(heard, 0), wide_keys])), wide_keys)

    def around(key: tuple, table: pa.Table, heard: pa.Table) -> pa.Table:
        _, r = records(table, heard)
        out = [{"bucket": b, "block": key[0].as_py(), "keys": _zip(r.key[i]), "ids": _zip(r.id[i]), "sent": _zip(r.sent[i])} for b, i in _per_bucket(r.key, n)]
        return pa.Table.from_pylist(out, pa.schema([("bucket", pa.int64()), ("block", pa.int64()), ("keys", pa.binary()), ("ids", pa.binary()), ("sent", pa.binary())]))

    def decide(key: tuple, table: pa.Table) -> pa.Table:
        keys = [np.frombuffer(_unzip(x), "<u8") for x in table.column("keys").to_pylist()]
        ids = np.concatenate([np.frombuffer(_unzip(x), "<i8") for x in table.column("ids").to_pylist()])
        s = np.concatenate([np.frombuffer(_unzip(x), np.uint8).reshape(-1, before + length + 2) for x in table.column("sent").to_pylist()])
        mask = earlier(np.concatenate(keys), ids, s[:, :before], s[:, before : before + length], s[:, -2].astype(np.int64), s[:, -1].astype(np.int64), length)
        masks = np.split(mask, np.cumsum([len(k) for k in keys])[:-1])
        return pa.Table.from_pylist([{"block": b, "kind": 2, "bucket": key[0].as_py(), "data": _zip(m)} for b, m in zip(table.column("block").to_pylist(), masks, strict=True)], answer)

    result = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string()), ("kept", pa.binary())])

    def mark(key: tuple, table: pa.Table, heard: pa.Table) -> pa.Table:
        block, r = records(table, heard)
        mask = np.zeros(r.n, np.uint64)
        told = {b: d for k, b, d in zip(heard.column("kind").to_pylist(), heard.column("bucket").to_pylist(), heard.column("data").to_pylist(), strict=True) if k == 2}
        for b, i in _per_bucket(r.key, n):
            mask[i] = np.frombuffer(_unzip(told[b]), "<u8")
        size = np.array([len(t) for t in block.texts], np.int64)
        cover = [np.zeros(0, bool)] * len(block.texts)
        if r.n:
            bits = np.where(block.ids[r.doc] > r.id[r.of], ~np.uint64(0), mask[r.of])
            for at in np.unique(r.piece).tolist():
                own = r.piece == at
                to = at
                total = 0
                while to < len(block.texts) and (to == at or total + size[to] <= PIECE_BYTES):
                    total += int(size[to])
                    to += 1
                edge = np.zeros(total + length + 1, np.int64)
                first, b, least, most = r.first[own], bits[own], r.least[own], r.most[own]
                for s in range(before + 1):
                    hit = (least <= s) & (s <= most) & ((b >> np.uint64(s)) & np.uint64(1)).astype(bool)
                    start = first[hit] + most[hit] - s
                    edge[start] += 1  # a string begins at a position once
                    edge[start + length] -= 1
                covered = np.cumsum(edge)[:total] > 0
                ends = np.cumsum(size[at:to])
                for k, (e, z) in enumerate(zip(ends.tolist(), size[at:to].tolist(), strict=True)):
                    cover[at + k] = covered[e - z : e]
        out = []
        for i, t, c in zip(block.ids.tolist(), block.texts, cover, strict=True):
            gone = int(c.sum())
            kept = np.frombuffer(t, np.uint8)[~c].tobytes() if gone else t
            spans = int(c[0]) + int(np.sum(c[1:] & ~c[:-1])) if gone else 0
            out.append({"doc_id": None if i == NULL_ID else i, "n_bytes": len(t), "n_removed": gone, "n_spans": spans, "kept_sha256": hashlib.sha256(kept).hexdigest(), "kept": kept})
        return pa.Table.from_pylist(out, result)

    kinds = "block long, kind long, bucket long, data binary"
    blocks = rows.groupBy("block")
    heard = shared.written(blocks.applyInArrow(sent, "bucket long, block long, keys binary, counts binary").groupBy("bucket").applyInArrow(again, kinds), "triggers")
    segs = blocks.cogroup(heard.groupBy("block")).applyInArrow(around, "bucket long, block long, keys binary, ids binary, sent binary")
    masks = segs.groupBy("bucket").applyInArrow(decide, kinds)
    return blocks.cogroup(heard.unionByName(masks).groupBy("block")).applyInArrow(mark, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_bytes(shared.documents(spark, sf_dir)).drop("kept")


QUERIES = {"op1_suffix_dedup": op1_suffix_dedup}
ORACLES: dict[str, str] = {}
