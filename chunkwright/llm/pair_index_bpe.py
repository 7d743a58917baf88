"""BPE encoding and decoding with a pair occurrence index.

Texts are cut at ASCII white space; each distinct run of other bytes is normalised and split to pieces as the
tokenizer file says, and distinct pieces that a Python worker doesn't remember are merged together: all their symbols
stand in one linked list, an index maps each merge rank to the positions of its pair, and active ranks are taken
from a heap in ascending order. A merge updates the lists of the pairs to its left and right. Where it brings up a
lower rank than the one at hand, that rank goes first, so each piece sees the order that it would see alone.

Covered: BPE files with end_of_word_suffix, normaliser and pre-tokeniser of the file (the tokenizers library runs
these two on distinct runs; the merges are ours). Strings of the file's added tokens are tokens of their own.
Null and empty texts have no tokens; texts of any length are encoded whole; rows are independent of each other, so an
empty table gives an empty result and repeated rows equal ones. Other columns aren't read, unless they are carried.
"""

from __future__ import annotations

import hashlib
import heapq
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession

from chunkwright.llm import shared

#: Runs, and pieces, of which a worker remembers about this many at most.
REMEMBERED = 400_000
GROUP_BYTES = 8 << 20


def _byte_chars() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies: itself if printable, else from 256 on."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    out, more = [], 256
    for b in range(256):
        out.append(chr(b if b in plain else more))
        more += b not in plain
    return out


class Remembered:
    """A dictionary in two generations: when the young one is full it becomes the old one, and what is used again is young again."""

    def __init__(self, most: int):
        self.most, self.young, self.old = most, {}, {}

    def unknown(self, keys: set[bytes]) -> set[bytes]:
        """Those of keys that aren't remembered; the others are young from here on."""
        if len(self.young) > self.most // 2:
            self.young, self.old = {}, self.young
        new = keys - self.young.keys()
        again = new & self.old.keys()
        self.young.update(zip(again, map(self.old.__getitem__, again), strict=True))
        return new - again


def _lowers_alone(text: str) -> bool:
    """Latin text without marks: its normal form and lower case need no more than str.lower()."""
    return text.isascii() or max(text) < "ɐ"


class PairIndexBpe:
    """A tokenizer file, and what this worker has encoded so far."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        raw = json.load(open(path, encoding="utf-8"))
        model, self.lib = raw["model"], Tokenizer.from_file(path)
        self.vocab: dict[str, int] = model["vocab"]
        end = model["end_of_word_suffix"] or ""
        self.added = {t["content"]: t["id"] for t in raw["added_tokens"]}
        self.added_split = regex.compile("(" + "|".join(map(regex.escape, self.added)) + ")")
        pattern = raw["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.split, self.split_lines = regex.compile(pattern), regex.compile(pattern + "|\n")
        self.names = [""] * (max([*self.vocab.values(), *self.added.values()]) + 1)
        for k, v in (*self.vocab.items(), *self.added.items()):
            self.names[v] = k
        chars = _byte_chars()
        self.byte_of = {c: b for b, c in enumerate(chars)}
        self.first = np.array([self.vocab[c] for c in chars], np.int64)
        self.last = np.array([self.vocab[c + end] for c in chars], np.int64)
        self.merges, self.rank = [], {}
        for r, m in enumerate(model["merges"]):
            a, b = m if isinstance(m, list) else m.split(" ")
            pair = self.vocab[a], self.vocab[b]
            self.merges.append((*pair, self.vocab[a + b]))
            self.rank[pair] = r
        #: Run or piece -> ids as little-endian unsigned 32-bit integers.
        self.runs, self.pieces = Remembered(REMEMBERED), Remembered(REMEMBERED)

    def merge(self, pieces: list[bytes]) -> list[bytes]:
        """Ids, as bytes, of each piece, which isn't empty."""
        size = np.array([len(p) for p in pieces])
        data = np.frombuffer(b"".join(pieces), np.uint8)
        ends = np.cumsum(size) - 1
        symbols = self.first[data]
        symbols[ends] = self.last[data[ends]]
        n = len(symbols)
        joined = np.ones(n, bool)
        joined[ends] = False
        at = np.flatnonzero(joined)
        sym, rank, merges = symbols.tolist(), self.rank, self.merges
        after = np.where(joined, np.arange(1, n + 1), -1).tolist()
        joined = np.roll(joined, 1)
        before = np.where(joined, np.arange(-1, n - 1), -1).tolist()
        pairs, which = np.unique((symbols[at] << 32) | symbols[np.minimum(at + 1, n - 1)], return_inverse=True)
        ranks = np.array([rank.get((int(p) >> 32, int(p) & 0xFFFFFFFF), -1) for p in pairs], np.int64)[which] if len(at) else at
        at, ranks = at[ranks >= 0], ranks[ranks >= 0]
        order = np.argsort(ranks, kind="stable")
        active, cuts = np.unique(ranks[order], return_index=True)
        where = dict(zip(active.tolist(), (x.tolist() for x in np.split(at[order], cuts[1:])), strict=False))
        heap = active.tolist()
        heapq.heapify(heap)
        while heap:
            r = heapq.heappop(heap)
            found = where.pop(r, None)
            if found is None:
                continue
            found.sort()
            a, b, c = merges[r]
            for k, p in enumerate(found):
                q = after[p]
                if sym[p] != a or q < 0 or sym[q] != b:
                    continue
                sym[p], sym[q] = c, -1
                after[p] = o = after[q]
                low = r
                if o >= 0:
                    before[o] = p
                    s = rank.get((c, sym[o]))
                    if s is not None:
                        if s in where:
                            where[s].append(p)
                        else:
                            where[s] = [p]
                            heapq.heappush(heap, s)
                        low = min(low, s)
                o = before[p]
                if o >= 0:
                    s = rank.get((sym[o], c))
                    if s is not None:
                        if s in where:
                            where[s].append(o)
                        else:
                            where[s] = [o]
                            heapq.heappush(heap, s)
                        low = min(low, s)
                if low < r or r in where:  # a lower rank, or more of this one: the rest waits
                    rest = where.setdefault(r, [])
                    rest += found[k + 1 :]
                    heapq.heappush(heap, r)
                    break
        flat = np.array(sym, np.int64)
        keep = flat >= 0
        cuts = (4 * np.cumsum(np.add.reduceat(keep, ends - size + 1))).tolist()
        raw = flat[keep].astype("<u4").tobytes()
        return [raw[s:e] for s, e in zip([0, *cuts[:-1]], cuts, strict=True)]

    def _cut(self, run: str) -> list[bytes]:
        if _lowers_alone(run):
            return [p.encode() for p in self.split.findall(run.lower())]
        whole = self.lib.normalizer.normalize_str(run)
        return [bytes(self.byte_of[c] for c in p) for p, _ in self.lib.pre_tokenizer.pre_tokenize_str(whole)]

    def _cut_lines(self, runs: list[bytes]) -> tuple[list[bytes], list[int]]:
        """Pieces of runs that lower alone, a line feed between runs, and where each run ends."""
        flat = list(map(str.encode, self.split_lines.findall(b"\n".join(runs).decode().lower())))
        return flat, [i for i, p in enumerate(flat) if p == b"\n"] + [len(flat)]

    def learn(self, runs: set[bytes]) -> None:
        """Makes the ids of the runs known."""
        plain = [r for r in runs if b"<" not in r and _lowers_alone(r.decode())]
        flat, ends = self._cut_lines(plain) if plain else ([], [])
        if len(ends) != len(plain):  # the file's pattern has pieces with line feeds
            plain, flat, ends = [], [], []
        cut: dict[bytes, list] = {}
        for run in runs.difference(plain):
            text = run.decode()
            parts = self.added_split.split(text) if b"<" in run else [text]
            cut[run] = [x for i, p in enumerate(parts) if p for x in ([self.added[p]] if i % 2 else self._cut(p))]
        met = {p for c in cut.values() for p in c if isinstance(p, bytes)}.union(flat)
        met.discard(b"\n")
        new = list(self.pieces.unknown(met))
        pieces, known = self.pieces.young, self.runs.young
        if new:
            pieces.update(zip(new, self.merge(new), strict=True))
        start = 0
        for run, end in zip(plain, ends, strict=True):
            known[run] = pieces[flat[start]] if end - start == 1 else b"".join([pieces[p] for p in flat[start:end]])
            start = end + 1
        for run, c in cut.items():
            known[run] = b"".join([p.to_bytes(4, "little") if isinstance(p, int) else pieces[p] for p in c])

    def encode(self, texts: list[bytes]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        runs = [t.split() for t in texts]
        new = self.runs.unknown(set().union(*runs))
        if new:
            self.learn(new)
        get = self.runs.young.__getitem__
        return [b"".join(map(get, r)) for r in runs]

    def decode(self, ids: bytes) -> str:
        """As the file has no decoder, tokens are joined with spaces."""
        return " ".join(map(self.names.__getitem__, np.frombuffer(ids, "<u4").tolist()))


def loaded(path: str) -> PairIndexBpe:
    memory = shared.worker_memory("pair_index_bpe")
    if path not in memory:
        memory[path] = PairIndexBpe(path)
    return memory[path]


def vocabulary_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def groups(texts: list[bytes], most: int = GROUP_BYTES) -> Iterator[list[bytes]]:
    own: list[bytes] = []
    size = 0
    for t in texts:
        if own and size + len(t) > most:
            yield own
            own, size = [], 0
        own.append(t)
        size += len(t)
    if own:
        yield own


def encode_documents(docs: DataFrame, path: str, keep_ids: bool = False, carry: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256, and with keep_ids the ids and decoded text; one pass, no shuffle. carry: columns of docs that pass through."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = loaded(path)
        for batch in shared.small_batches(batches, 1024):
            texts = [t or b"" for t in batch.column(1).cast(pa.binary()).to_pylist()]
            ids = [x for own in groups(texts) for x in bpe.encode(own)]
            decoded = map(bpe.decode, ids)
            if keep_ids:
                decoded = list(decoded)
            cols = {"doc_id": batch.column(0), "n_tokens": pa.array([len(i) // 4 for i in ids], pa.int64())}
            cols |= {"ids_sha256": pa.array([hashlib.sha256(i).hexdigest() for i in ids], pa.string()), "decoded_sha256": pa.array([hashlib.sha256(d.encode()).hexdigest() for d in decoded], pa.string())}
            if keep_ids:
                cols |= {"ids": pa.array([np.frombuffer(i, "<u4").astype(np.int32) for i in ids], pa.list_(pa.int32())), "decoded": pa.array(decoded, pa.string())}
            yield pa.RecordBatch.from_pydict(cols | {c: batch.column(2 + i) for i, c in enumerate(carry)})

    kind = docs.schema["doc_id"].dataType.simpleString()
    more = ", ids array<int>, decoded string" if keep_ids else ""
    more += "".join(f", `{c}` {docs.schema[c].dataType.simpleString()}" for c in carry)
    return docs.select("doc_id", "text", *[f"`{c}`" for c in carry]).mapInArrow(run, f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string{more}")


def op6_pair_index_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_documents(shared.documents(spark, sf_dir), vocabulary_path())


QUERIES = {"op6_pair_index_bpe": op6_pair_index_bpe}
ORACLES: dict[str, str] = {}
