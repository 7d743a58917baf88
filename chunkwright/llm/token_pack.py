"""Token ids as fixed-width packed blocks.

Documents are dealt to ranges of doc_id, sorted, encoded with the tokenizers library, closed with the end id, and
packed with as many bits for an id as the vocabulary needs. A block is one binary value:

    magic "TPK1" | bits u16 | documents u32 | of them without an id u32 | ids u64 | end of each document u64[documents] | doc ids i64[documents] | packed ids

all little-endian; ids are packed lowest bit first. The ends give random access to a document, and any run of ids is
unpacked with numpy alone. Blocks are rows (part, block, n_ids, first_doc, last_doc, data) of a Parquet table in the shared folder, in
ascending doc_id order of (part, block): Spark's commit protocol makes the output whole or absent, also where a task
is lost and runs again. A document is never cut, so one longer than BLOCK_IDS has a block of its own.

Null text is empty text: only the end id. Texts of any length are encoded whole. Rows with a null doc_id come first;
repeated doc_ids follow each other in order of a hash of their text. An empty table gives an empty table of blocks and
an empty result. Columns other than doc_id and text aren't read.
"""

from __future__ import annotations

import os
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from chunkwright.llm import shared

BLOCK_IDS = 1 << 20
REMEMBERED = 600_000
GROUP_BYTES = 8 << 20
MAGIC = b"TPK1"
HEAD = struct.Struct("<4sHIIQ")


def bits_for(vocabulary: int) -> int:
    return max(1, (vocabulary - 1).bit_length())


def pack(ids: np.ndarray, bits: int) -> bytes:
    if bits in (8, 16, 32):
        return ids.astype(f"<u{bits // 8}").tobytes()
    out = []
    for i in range(0, len(ids), 1 << 18):  # a multiple of 8 ids is whole bytes
        part = ids[i : i + (1 << 18)].astype("<u4").view(np.uint8).reshape(-1, 4)
        out.append(np.packbits(np.unpackbits(part, axis=1, bitorder="little")[:, :bits].ravel(), bitorder="little").tobytes())
    return b"".join(out)


def unpack(data: bytes, bits: int, start: int, stop: int) -> np.ndarray:
    """Ids start to stop of packed data."""
    if stop <= start:
        return np.zeros(0, np.uint32)
    if bits in (8, 16, 32):
        return np.frombuffer(data, f"<u{bits // 8}", stop - start, start * bits // 8).astype(np.uint32)
    lo, hi = start * bits // 8, -(-stop * bits // 8)
    flat = np.unpackbits(np.frombuffer(data, np.uint8, hi - lo, lo), bitorder="little")[start * bits - 8 * lo :][: (stop - start) * bits]
    wide = np.zeros((stop - start, 32), np.uint8)
    wide[:, :bits] = flat.reshape(-1, bits)
    return np.packbits(wide.ravel(), bitorder="little").view("<u4").astype(np.uint32)


def make_block(doc_ids: list[int | None], ids: list[np.ndarray], bits: int) -> bytes:
    """Documents without an id come first."""
    flat = np.concatenate(ids)
    ends = np.cumsum([len(x) for x in ids]).astype("<u8")
    return HEAD.pack(MAGIC, bits, len(ids), doc_ids.count(None), len(flat)) + ends.tobytes() + np.array([i or 0 for i in doc_ids], "<i8").tobytes() + pack(flat, bits)


class Block:
    """A packed block, unpacked where asked."""

    def __init__(self, data: bytes):
        magic, self.bits, n, nulls, self.n_ids = HEAD.unpack_from(data)
        if magic != MAGIC:
            raise ValueError("not a packed token block")
        self.ends = np.frombuffer(data, "<u8", n, HEAD.size).astype(np.int64)
        self.starts = np.concatenate([[0], self.ends[:-1]]).astype(np.int64)
        self.doc_ids = np.frombuffer(data, "<i8", n, HEAD.size + 8 * n)
        self.no_id = np.arange(n) < nulls
        self.data = memoryview(data)[HEAD.size + 16 * n :]

    def ids(self, start: int, stop: int) -> np.ndarray:
        return unpack(self.data, self.bits, start, stop)

    def document(self, k: int) -> np.ndarray:
        return self.ids(int(self.starts[k]), int(self.ends[k]))


def _bytes(chars: str) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(chars.encode())] = True
    return out


_ENDS = _bytes(" \n")
_BLANK = _bytes("".join(map(chr, (*range(0x09, 0x0E), *range(0x1C, 0x21)))))
_LETTER = _bytes("".join(map(chr, (*range(0x41, 0x5B), *range(0x61, 0x7B)))))
_SYMBOLS = "!\"#$%&'()*+,-./:;<=>?@[]^`{|}~"


class RunEncoder:
    """Encodes distinct runs of bytes with the library, once each.

    A byte-level piece always begins at white space behind a character that is none, and at a symbol behind a letter.
    numpy cuts a group of texts there, Arrow numbers the distinct runs, Python sees each of them once, and numpy
    gathers the ids of whole texts.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.lib = Tokenizer.from_file(path)
        self.lib.no_truncation()
        self.lib.no_padding()
        self.size = self.lib.get_vocab_size(with_added_tokens=True)
        self.opens = np.zeros(self.size, bool)
        for token, i in self.lib.get_vocab(with_added_tokens=False).items():
            self.opens[i] = token.startswith("Ġ")
        # An added token is never cut, so its characters don't begin a run.
        added = "".join(t.content for t in self.lib.get_added_tokens_decoder().values())
        self.symbol = _bytes("".join(set(_SYMBOLS) - set(added)))
        self.ends = _ENDS & ~_bytes(added)
        #: Run -> ids as little-endian unsigned 32-bit integers.
        self.known: dict[str, bytes] = {}
        #: What was known when the memory was last full: runs that come again move back.
        self.before: dict[str, bytes] = {}

    def _learn_alone(self, runs: list[str]) -> None:
        for i in range(0, len(runs), 2000):
            own = runs[i : i + 2000]
            self.known.update(zip(own, [np.array(e.ids, "<u4").tobytes() for e in self.lib.encode_batch_fast(own, add_special_tokens=False)], strict=True))

    def _learn(self, runs: list[str]) -> None:
        """Words behind a space are encoded as one text " x y z": each begins with the only ids that open with a space."""
        words = [r for r in runs if r[0] == " " and r[1:].isalpha()]
        batches, alone = [words[i : i + 500] for i in range(0, len(words), 500)], [r for r in runs if r[0] != " " or not r[1:].isalpha()]
        for at in range(0, len(batches), 20):
            own = batches[at : at + 20]
            for b, e in zip(own, self.lib.encode_batch_fast(["".join(b) for b in own], add_special_tokens=False), strict=True):
                ids = np.array(e.ids, "<u4")
                cuts = (4 * np.flatnonzero(self.opens[ids])).tolist()
                if len(cuts) == len(b) and cuts[0] == 0:
                    raw = ids.tobytes()
                    self.known.update(zip(b, [raw[s:e] for s, e in zip(cuts, [*cuts[1:], len(raw)], strict=True)], strict=True))
                else:
                    alone += b
        self._learn_alone(alone)

    def _looked_up(self, runs: list[str]) -> list[bytes]:
        if len(self.known) > REMEMBERED:
            self.before, self.known = self.known, {}
        known, before = self.known, self.before
        new = [r for r in runs if r not in known]
        back = {r: before[r] for r in new if r in before}
        known.update(back)
        self._learn([r for r in new if r not in back])
        return [known[r] for r in runs]

    def cuts(self, data: np.ndarray) -> np.ndarray:
        """True where a run begins behind another byte of the same text."""
        out = np.zeros(len(data), bool)
        if len(data) < 2:
            return out
        last, next_ = data[:-1], data[1:]
        wide = last >= 0x80
        out[1:] = (self.ends[next_] & ~_BLANK[last]) | (self.symbol[next_] & (_LETTER[last] | wide))
        at = np.flatnonzero(out[1:] & wide) + 1  # which character ends before?
        one, two, three = data[at - 1], data[np.maximum(at - 2, 0)], data[np.maximum(at - 3, 0)]
        blank = ((two == 0xC2) & ((one == 0x85) | (one == 0xA0))) | ((three >= 0xE1) & (three <= 0xE3) & ((two == 0x9A) | (two == 0x80) | (two == 0x81)))
        latin = (two == 0xC3) & (one != 0x97) & (one != 0xB7)
        out[at] = np.where(self.ends[data[at]], ~blank, latin)
        return out

    def encode_all(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the texts (strings without nulls) end to end, and how many each text has."""
        n, at = len(texts), texts.offset
        ends = np.frombuffer(texts.buffers()[1], np.int32, n + 1, 4 * at).astype(np.int64) if n else np.zeros(1, np.int64)
        if ends[-1] == ends[0]:
            return np.zeros(0, "<u4"), np.zeros(n, np.int64)
        data = np.frombuffer(texts.buffers()[2], np.uint8, int(ends[-1] - ends[0]), int(ends[0]))
        ends -= ends[0]
        begins = self.cuts(data)
        begins[ends[:-1][ends[:-1] < ends[1:]]] = True
        start = np.flatnonzero(begins)
        offsets = np.append(start, len(data)).astype(np.int32)
        coded = pa.StringArray.from_buffers(len(start), pa.py_buffer(offsets), pa.py_buffer(data)).dictionary_encode()
        ids = self._looked_up(coded.dictionary.to_pylist())
        size = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        item = coded.indices.to_numpy()
        count = size[item]
        total = np.concatenate([[0], np.cumsum(count)])
        gather = np.repeat((np.cumsum(size) - size)[item] - total[:-1], count)
        gather += np.arange(len(gather))
        return np.frombuffer(b"".join(ids), "<u4")[gather], np.diff(total[np.searchsorted(start, ends)])

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        ids, size = self.encode_all(pa.array(texts, pa.string()))
        return np.split(ids, np.cumsum(size)[:-1]) if len(texts) else []


def loaded(path: str) -> RunEncoder:
    memory = shared.worker_memory("token_pack")
    if path not in memory:
        memory[path] = RunEncoder(path)
    return memory[path]


def _groups(sizes: list[int], most: int) -> Iterator[tuple[int, int]]:
    """Runs of texts of about that many bytes; a longer text is a run of its own."""
    at = 0
    while at < len(sizes):
        to, total = at, 0
        while to < len(sizes) and (to == at or total + sizes[to] <= most):
            total += sizes[to]
            to += 1
        yield at, to
        at = to


def _blocks(path: str, end_id: int, block_ids: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, block, doc_ids, ids, n = TaskContext.get().partitionId(), 0, [], [], 0
        coder = loaded(path)
        bits = bits_for(coder.size)

        def row() -> pa.RecordBatch:
            known = [i for i in doc_ids if i is not None]
            cols = {"part": [part], "block": [block], "n_ids": [n], "first_doc": known[:1] or [None], "last_doc": known[-1:] or [None]}
            return pa.RecordBatch.from_pydict({k: pa.array(v, pa.int64()) for k, v in cols.items()} | {"data": pa.array([make_block(doc_ids, ids, bits)], pa.binary())})

        def gathered() -> Iterator[tuple[list, pa.Array]]:
            """Spark's small batches put together to groups of about GROUP_BYTES."""
            kept, size = [], 0
            for batch in batches:
                kept.append(batch)
                size += batch.nbytes
                if size >= GROUP_BYTES:
                    yield from whole(kept)
                    kept, size = [], 0
            yield from whole(kept)

        def whole(kept: list[pa.RecordBatch]) -> Iterator[tuple[list, pa.Array]]:
            if not kept:
                return
            table = pa.Table.from_batches(kept)
            texts = pc.fill_null(table.column(1).combine_chunks(), "")
            texts = pa.concat_arrays(texts.chunks) if isinstance(texts, pa.ChunkedArray) else texts
            keys, sizes = table.column(0).to_pylist(), pc.binary_length(texts).to_pylist()
            for at, to in _groups(sizes, GROUP_BYTES):
                yield keys[at:to], texts.slice(at, to - at)

        for keys, texts in gathered():
            flat, size = coder.encode_all(texts)
            ends = np.cumsum(size)
            for key, s, e in zip(keys, (ends - size).tolist(), ends.tolist(), strict=True):
                if doc_ids and n + e - s + 1 > block_ids:
                    yield row()
                    block, doc_ids, ids, n = block + 1, [], [], 0
                doc_ids.append(key)
                ids.append(np.append(flat[s:e], np.uint32(end_id)))
                n += e - s + 1
        if doc_ids:
            yield row()

    return run


def write_packed(docs: DataFrame, path: str, end_id: int, block_ids: int = BLOCK_IDS, part_bytes: int = 16 << 20) -> DataFrame:
    """The table of blocks, written and read again. Texts are shuffled once, to ranges of doc_id, which repeated doc_ids can span."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text")]
    dealt = rows.repartitionByRange(shared.parts_for(docs, part_bytes), *order).sortWithinPartitions(*order, "text")
    return shared.written(dealt.mapInArrow(_blocks(path, end_id, block_ids), "part long, block long, n_ids long, first_doc long, last_doc long, data binary"), "tokens")


def fetch(blocks: DataFrame, doc_id: int) -> list[np.ndarray]:
    """Ids of the documents with that doc_id: Parquet's statistics of first_doc and last_doc leave the blocks that may hold it."""
    found = blocks.where((F.col("first_doc") <= doc_id) & (F.col("last_doc") >= doc_id)).orderBy("part", "block").select("data").toLocalIterator()
    return [block.document(k) for block in (Block(r.data) for r in found) for k in np.flatnonzero((block.doc_ids == doc_id) & ~block.no_id).tolist()]


def read_documents(blocks: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document of the blocks.

    Starts come from sums at three levels (parts, blocks of a part, documents of a block); only parts, of which
    there is one for each 16 MB of text, are summed in one window.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, number, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                block = Block(data)
                whole = block.ids(0, block.n_ids).astype("<u4")
                crc = [zlib.crc32(whole[s:e].tobytes()) for s, e in zip(block.starts.tolist(), block.ends.tolist(), strict=True)]
                doc_ids = pa.array(block.doc_ids, mask=block.no_id)
                yield pa.RecordBatch.from_pydict({"part": np.full(len(crc), part), "block": np.full(len(crc), number), "doc_id": doc_ids, "inside": block.starts, "n_tokens": block.ends - block.starts, "ids_crc32": np.array(crc, np.int64)})

    found = blocks.select("part", "block", "data").mapInArrow(run, "part long, block long, doc_id long, inside long, n_tokens long, ids_crc32 long")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = blocks.groupBy("part").agg(F.sum("n_ids").alias("n")).select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("part_start"))
    inner = Window.partitionBy("part").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = blocks.select("part", "block", F.coalesce(F.sum("n_ids").over(inner), F.lit(0)).alias("block_start")).join(parts, "part")
    out = found.join(starts, ["part", "block"])
    return out.select("doc_id", (F.col("part_start") + F.col("block_start") + F.col("inside")).alias("start"), "n_tokens", "ids_crc32")


def vocabulary_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op9_token_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_documents(write_packed(shared.documents(spark, sf_dir), vocabulary_path(), end_id=2))


QUERIES = {"op9_token_pack": op9_token_pack}
ORACLES: dict[str, str] = {}
