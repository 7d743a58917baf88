"""Cross-tokenizer alignment: which tokens of two tokenizers cover the same bytes.

A is a byte-level BPE of space + text (tokenizers library), B a piece BPE of the text, to which it adds the space (sentencepiece).
A text is cut in runs, at each space behind a character that isn't blank: no token of A or B crosses such a
place (of B this is checked over its vocabulary), so a run is encoded alone and all that is asked for adds up over runs.
Of the distinct runs of some MB of text two token-byte incidence matrices are built by hand in CSR form (row pointers and column
numbers): A with a row for each A token, B with one for each B token, columns are bytes. The rows of A times B
transposed (Gustavson: a row of the product gathers the rows of B transposed that the row's columns name, and adds up equal
columns) are the overlap links. Bytes where tokens of both end cut tokens into groups; rows of the group-incidence
products hold the links between tokens that share a group, which are counted without being listed, as a group can be long.

How often an id pair is linked corpus-wide is summed in blocks of documents first: blocks exchange one row for each distinct pair
with the whole, the totals are joined, and each block looks its own pairs up. Pairs are at most the product of the
vocabularies, never broadcast and never on the driver; a pair or a B id that all texts have is one row a block.

Texts that are null or empty, or whose joined A or B bytes aren't those of space + text, have no tokens: zeros and ''. Strings of
special tokens are plain text. Texts of any length are read whole; one without spaces is one run. Null and repeated doc_ids and
repeated rows are rows like others. Other columns aren't read, whatever their names. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chunkwright.llm import shared, token_pack

#: Bytes of text that are cut at once; bytes of text and distinct runs in a block; runs that a worker remembers.
GROUP_BYTES, BLOCK_BYTES, BLOCK_RUNS, REMEMBERED = 6 << 20, 24 << 20, 300_000, 160_000
PAIRS_A_ROW = 1 << 15


def csr(sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Incidence of tokens with successive bytes: row pointers and column numbers."""
    indptr = np.concatenate([[0], np.cumsum(sizes)])
    return indptr, np.arange(indptr[-1])


def transposed(indptr: np.ndarray, indices: np.ndarray, columns: int) -> tuple[np.ndarray, np.ndarray]:
    """The transpose in CSR form; rows stay in order within a column."""
    rows = np.repeat(np.arange(len(indptr) - 1), np.diff(indptr))
    order = np.argsort(indices, kind="stable")
    return np.concatenate([[0], np.cumsum(np.bincount(indices, minlength=columns))]), rows[order]


def product(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray], columns: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Gustavson's product of two 0/1 matrices in CSR form: row pointers, columns, values, columns ascending in each row."""
    (ap, ai), (bp, bi) = a, b
    width = np.diff(bp)[ai]  # of the row of b that each entry of a names
    gather = np.repeat(bp[:-1][ai] - (np.cumsum(width) - width), width) + np.arange(width.sum())
    row = np.repeat(np.repeat(np.arange(len(ap) - 1), np.diff(ap)), width)
    keys, values = np.unique(row * max(columns, 1) + bi[gather], return_counts=True)
    rows, cols = np.divmod(keys, max(columns, 1))
    return np.concatenate([[0], np.cumsum(np.bincount(rows, minlength=len(ap) - 1))]), cols, values


class Aligned:
    """Links and groups of texts that stand end to end, whose tokens have sizes in bytes."""

    def __init__(self, a_sizes: np.ndarray, b_sizes: np.ndarray):
        a, b = csr(a_sizes), csr(b_sizes)
        n_bytes = len(a[1])
        self.link_ptr, self.link_b, self.overlap = product(a, transposed(*b, n_bytes), len(b_sizes))
        ends = np.intersect1d(a[0][1:], b[0][1:], assume_unique=True)  # a group ends where tokens of both do
        self.group_ends = ends
        self.a_group, self.b_group = np.searchsorted(ends, a[0][1:]), np.searchsorted(ends, b[0][1:])

    def shared_links(self) -> np.ndarray:
        """For each group the entries of its block of the product of group incidences (A tokens x groups x B tokens)."""
        n = len(self.group_ends)
        return np.bincount(self.a_group, minlength=n).astype(np.int64) * np.bincount(self.b_group, minlength=n)


def _byte_level() -> dict[str, int]:
    """Characters by which byte-level vocabularies write bytes: printable ones stand for themselves, the others follow from U+0100 on."""
    plain = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Pair:
    """Both tokenizers, with the bytes of each id, and what is known of runs."""

    def __init__(self, a_path: str, b_path: str):
        import sentencepiece

        self.a = token_pack.RunEncoder(a_path)
        self.a.lib.encode_special_tokens = True
        chars = _byte_level()
        self.a_bytes = [b""] * self.a.size
        for token, i in self.a.lib.get_vocab(with_added_tokens=True).items():
            self.a_bytes[i] = bytes(chars[c] for c in token) if all(c in chars for c in token) else token.encode()
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        self.b_size = self.b.get_piece_size()
        pieces = [self.b.id_to_piece(i) for i in range(self.b_size)]
        if any("▁" in p.lstrip("▁") for p in pieces):
            raise ValueError("a piece crosses a space, so runs can't be encoded alone")
        self.b_bytes = [bytes([int(p[3:-1], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        self.a_size_of, self.b_size_of = (np.array(list(map(len, x)), np.int64) for x in (self.a_bytes, self.b_bytes))
        self.code = np.dtype("<u4" if self.a.size * self.b_size < 1 << 32 else "<i8")
        self.space = [self.b.piece_to_id("▁")]
        #: Text of an id with what follows it: in its group, and at the end of its side of it.
        self.a_text, self.b_text = (np.array([[f"{i},", f"{i}{end}"] for i in range(n)], object).T for n, end in ((self.a.size, "|"), (self.b_size, ";")))
        self.known: dict[str, tuple] = {}
        self.before: dict[str, tuple] = {}

    def cuts(self, data: np.ndarray) -> np.ndarray:
        """True at spaces behind a character that is no blank."""
        return self.a.cuts(data) & (data == 0x20)

    def learn(self, runs: list[str]) -> None:
        """(numbers of A tokens, B tokens, groups, shared-group links and links; codes of links; text of groups) of new runs; None where bytes differ."""
        if len(self.a.known) > REMEMBERED // 2:
            self.a.before, self.a.known = self.a.known, {}
        a_all, a_n = self.a.encode_all(pa.array(runs, pa.string()))
        b_lists = [self.space if r == " " else x for r, x in zip(runs, self.b.encode([r[1:] for r in runs], num_threads=1), strict=True)]  # behind the last character nothing is added
        b_n = np.fromiter(map(len, b_lists), np.int64, len(runs))
        a_all, b_all = a_all.astype(np.int64), np.fromiter(chain.from_iterable(b_lists), np.int64, int(b_n.sum()))
        bad = self._differ(runs, a_all, a_n, b_all, b_n)
        if bad.any():
            self.known.update((runs[k], None) for k in np.flatnonzero(bad).tolist())
            runs = [runs[k] for k in np.flatnonzero(~bad).tolist()]
            a_all, b_all = a_all[np.repeat(~bad, a_n)], b_all[np.repeat(~bad, b_n)]
            a_n, b_n = a_n[~bad], b_n[~bad]
        if not runs:
            return
        got = Aligned(self.a_size_of[a_all], self.b_size_of[b_all])
        codes = np.repeat(a_all, np.diff(got.link_ptr)) * self.b_size + b_all[got.link_b]
        a_end = np.cumsum(a_n)
        link_end, group_end = got.link_ptr[a_end], got.a_group[a_end - 1] + 1
        shared_end = np.concatenate([[0], np.cumsum(got.shared_links())])[group_end]
        text, text_end = self._text(a_all, b_all, got, a_end)
        numbers = np.stack([a_n, b_n, *(np.diff(x, prepend=0) for x in (group_end, shared_end, link_end))], axis=1).tolist()
        raw, at, began = codes.astype(self.code).tobytes(), 0, 0
        for run, n, to, end in zip(runs, numbers, (link_end * self.code.itemsize).tolist(), text_end.tolist(), strict=True):
            self.known[run] = (tuple(n), raw[at:to], text[began : end - 1])
            at, began = to, end

    def _differ(self, runs: list[str], a: np.ndarray, a_n: np.ndarray, b: np.ndarray, b_n: np.ndarray) -> np.ndarray:
        """True for runs whose joined A or B bytes aren't the run's. All are compared at once, and one by one only if that fails."""
        raw = [r.encode() for r in runs]
        sizes = np.fromiter(map(len, raw), np.int64, len(raw))
        whole, bad = b"".join(raw), np.zeros(len(runs), bool)
        for ids, n, table, size_of in ((a, a_n, self.a_bytes, self.a_size_of), (b, b_n, self.b_bytes, self.b_size_of)):
            ends = np.cumsum(n)
            total = np.concatenate([[0], np.cumsum(size_of[ids])])
            if (total[ends] - total[ends - n] == sizes).all() and b"".join([table[i] for i in ids.tolist()]) == whole:
                continue
            for k, (e, m) in enumerate(zip(ends.tolist(), n.tolist(), strict=True)):
                bad[k] |= b"".join([table[i] for i in ids[e - m : e].tolist()]) != raw[k]
        return bad

    def _text(self, a: np.ndarray, b: np.ndarray, got: Aligned, a_end: np.ndarray) -> tuple[str, np.ndarray]:
        """`a1,a2|b1;` of all groups end to end, and where the text of each run ends, of which a_end is the end of its A tokens."""
        n = np.arange(len(got.group_ends))
        a_to, b_to = np.searchsorted(got.a_group, n, "right"), np.searchsorted(got.b_group, n, "right")
        last_a, last_b = np.zeros(len(a), np.int64), np.zeros(len(b), np.int64)
        last_a[a_to - 1], last_b[b_to - 1] = 1, 1
        parts = np.empty(len(a) + len(b), object)
        before_a, before_b = np.concatenate([[0], b_to])[got.a_group], a_to[got.b_group]
        at_a = np.arange(len(a)) + before_a
        parts[at_a] = self.a_text[last_a, a]
        parts[np.arange(len(b)) + before_b] = self.b_text[last_b, b]
        parts = parts.tolist()
        length = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)))
        run_groups = got.a_group[a_end - 1]
        return "".join(parts), length[a_to[run_groups] + b_to[run_groups] - 1]

    def look_up(self, runs: list[str]) -> list[tuple]:
        if len(self.known) > REMEMBERED:
            self.before, self.known = self.known, {}
        new = [r for r in runs if r not in self.known]
        back = {r: self.before[r] for r in new if r in self.before}
        self.known.update(back)
        new = [r for r in new if r not in back]
        at = 0
        while at < len(new):
            to, size = at, 0
            while to < len(new) and (to == at or size + len(new[to]) <= 1 << 18):
                size += len(new[to])
                to += 1
            self.learn(new[at:to])
            at = to
        return [self.known[r] for r in runs]


def loaded(a_path: str, b_path: str) -> Pair:
    memory = shared.worker_memory("token_alignment")
    if (a_path, b_path) not in memory:
        memory[a_path, b_path] = Pair(a_path, b_path)
    return memory[a_path, b_path]


#: kind 0: a document and its runs, as numbers of the block's list; 1: codes of links of each run of that list, end to end, in pieces; 2: some pairs of the block and their counts.
ROWS = "block long, kind int, seq long, doc_id long, n_a long, n_b long, n_groups long, n_links long, n_shared long, groups_sha256 string, runs binary, sizes binary, codes array<long>, counts array<long>"
_ROWS = pa.schema([("block", pa.int64()), ("kind", pa.int32()), ("seq", pa.int64()), ("doc_id", pa.int64())] + [(c, pa.int64()) for c in "n_a n_b n_groups n_links n_shared".split()] + [("groups_sha256", pa.string()), ("runs", pa.binary()), ("sizes", pa.binary()), ("codes", pa.list_(pa.int64())), ("counts", pa.list_(pa.int64()))])


def _empty(block: int, doc_id: int | None) -> dict:
    return {"block": block, "kind": 0, "doc_id": doc_id, "n_a": 0, "n_b": 0, "n_groups": 0, "n_links": 0, "n_shared": 0, "groups_sha256": "", "runs": b""}


class _Block:
    def __init__(self, number: int):
        self.number, self.bytes = number, 0
        self.at: dict[str, int] = {}
        self.codes: list[bytes] = []
        self.uses: list[np.ndarray] = []

    def take(self, doc_ids: list, texts: pa.Array, pair: Pair) -> Iterator[dict]:
        """Rows of documents, whose texts are non-empty and begin with the added space."""
        n = len(texts)
        ends = np.frombuffer(texts.buffers()[1], np.int32, n + 1, 4 * texts.offset).astype(np.int64)
        data = np.frombuffer(texts.buffers()[2], np.uint8, int(ends[-1] - ends[0]), int(ends[0]))
        ends = ends - ends[0]
        begins = pair.cuts(data)
        begins[ends[:-1]] = True
        start = np.flatnonzero(begins)
        coded = pa.StringArray.from_buffers(len(start), pa.py_buffer(np.append(start, len(data)).astype(np.int32)), pa.py_buffer(data)).dictionary_encode()
        runs = coded.dictionary.to_pylist()
        known = pair.look_up(runs)
        good = np.fromiter((x is not None for x in known), bool, len(known))
        numbers, at_of, codes = [], self.at, self.codes
        for r, x in zip(runs, known, strict=True):
            at = -1
            if x is not None:
                at = at_of.setdefault(r, len(codes))
                if at == len(codes):
                    codes.append(x[1])
            numbers.append(at)
        numbers = np.array(numbers, np.int64)
        sums = np.array([x[0] if x else (0,) * 5 for x in known], np.int64)
        texts_of = [x[2] if x else "" for x in known]
        item = coded.indices.to_numpy()
        cut = np.searchsorted(start, ends)
        self.bytes += len(data)
        for k, doc_id in enumerate(doc_ids):
            own = item[cut[k] : cut[k + 1]]
            if not good[own].all():
                yield _empty(self.number, doc_id)
                continue
            n_a, n_b, groups, shared_links, links = sums[own].sum(axis=0).tolist()
            digest = hashlib.sha256(";".join([texts_of[i] for i in own.tolist()]).encode()).hexdigest()
            self.uses.append(numbers[own].astype("<i4"))
            yield {"block": self.number, "kind": 0, "doc_id": doc_id, "n_a": n_a, "n_b": n_b, "n_groups": groups, "n_links": links, "n_shared": shared_links, "groups_sha256": digest, "runs": self.uses[-1].tobytes()}

    def close(self, pair: Pair) -> Iterator[dict]:
        """Rows of the block's runs and pairs."""
        if not self.codes:
            return
        uses = np.bincount(np.concatenate(self.uses), minlength=len(self.codes)) if self.uses else np.zeros(len(self.codes), np.int64)
        sizes = np.fromiter(map(len, self.codes), np.int64, len(self.codes)) // pair.code.itemsize
        flat = np.frombuffer(b"".join(self.codes), pair.code).astype(np.int64)
        codes, place = np.unique(flat, return_inverse=True)
        counts = np.bincount(place, weights=np.repeat(uses, sizes), minlength=len(codes)).astype(np.int64)
        yield {"block": self.number, "kind": 1, "sizes": sizes.astype("<i4").tobytes(), "runs": place.astype("<i4").tobytes()}
        for i in range(0, len(codes), PAIRS_A_ROW):
            yield {"block": self.number, "kind": 2, "seq": i, "codes": codes[i : i + PAIRS_A_ROW], "counts": counts[i : i + PAIRS_A_ROW]}


def _aligned(a_path: str, b_path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        pair, part, number = loaded(a_path, b_path), TaskContext.get().partitionId() << 32, 0
        block = _Block(part)

        def rows(kept: list[pa.RecordBatch]) -> list[dict]:
            nonlocal block, number
            table = pa.Table.from_batches(kept).combine_chunks()
            texts = pc.fill_null(table.column(1).chunk(0), "")
            keys, sizes = table.column(0).to_pylist(), pc.binary_length(texts).to_pylist()
            out = [_empty(block.number, k) for k, s in zip(keys, sizes, strict=True) if not s]
            some = pa.array(np.flatnonzero(sizes))
            keys, sizes, texts = [k for k, s in zip(keys, sizes, strict=True) if s], [s for s in sizes if s], texts.take(some)
            texts = pc.binary_join_element_wise(pa.scalar(" "), texts, "")
            for at, to in token_pack._groups(sizes, GROUP_BYTES):
                if block.bytes >= BLOCK_BYTES or len(block.codes) >= BLOCK_RUNS:
                    out += block.close(pair)
                    number += 1
                    block = _Block(part + number)
                out += block.take(keys[at:to], texts.slice(at, to - at), pair)
            return out

        kept, size = [], 0
        for batch in batches:  # Spark's batches put together to groups
            kept.append(batch)
            size += batch.nbytes
            if size >= GROUP_BYTES:
                yield pa.RecordBatch.from_pylist(rows(kept), _ROWS)
                kept, size = [], 0
        if size or any(b.num_rows for b in kept):
            yield pa.RecordBatch.from_pylist(rows(kept), _ROWS)
        if last := list(block.close(pair)):
            yield pa.RecordBatch.from_pylist(last, _ROWS)

    return run


RESULT = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string, n_shared long"
_PLAIN = ("n_a", "n_b", "n_groups", "n_links", "groups_sha256", "n_shared")


def _scored(left: pa.Table, right: pa.Table) -> pa.Table:
    """Documents of a block, with sums over their links of what the right side (code, count, best) knows of pairs."""
    kind = left.column("kind")
    docs, runs = left.filter(pc.equal(kind, 0)), left.filter(pc.equal(kind, 1))
    code_order = np.argsort(right.column("code").to_numpy(), kind="stable")  # as the block numbered its pairs
    count, best = (right.column(c).to_numpy()[code_order].astype(np.int64) for c in ("total", "best"))
    scores = np.zeros((2, 0), np.int64)
    if runs.num_rows:
        place, sizes = (np.frombuffer(runs.column(c)[0].as_py(), "<i4") for c in ("runs", "sizes"))
        at = np.cumsum(sizes, dtype=np.int64) - sizes
        scores = np.stack([np.add.reduceat(x[place], at) for x in (count, best)])
    own = [np.frombuffer(x.as_py(), "<i4") for x in docs.column("runs")]
    sums = np.array([[scores[0][x].sum(), scores[1][x].sum()] for x in own], np.int64).reshape(-1, 2)
    columns = {"doc_id": docs.column("doc_id"), **{c: docs.column(c) for c in _PLAIN}, "count_sum": pa.array(sums[:, 0]), "n_best": pa.array(sums[:, 1])}
    return pa.table(columns).select([c.split(" ")[0] for c in RESULT.split(", ")])


def align_documents(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """doc_id and the columns of RESULT for each row of docs (doc_id, text)."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    table = shared.written(rows.mapInArrow(_aligned(a_path, b_path), ROWS), "alignment")
    import sentencepiece

    b_size = sentencepiece.SentencePieceProcessor(model_file=b_path).get_piece_size()
    pairs = table.where("kind = 2").select("block", F.expr("inline(arrays_zip(codes, counts))")).withColumnRenamed("codes", "code")
    totals = pairs.groupBy("code").agg(F.sum("counts").alias("total")).withColumn("b", F.col("code") % b_size)
    most = totals.groupBy(F.col("b").alias("_b")).agg(F.max("total").alias("most"))
    totals = totals.join(most, F.col("b") == F.col("_b")).select(F.col("code").alias("_code"), "total", (F.col("total") == F.col("most")).cast("int").alias("best"))
    known = pairs.select("block", "code").join(totals, F.col("code") == F.col("_code")).select(F.col("block").alias("of"), "code", "total", "best")
    left = table.where("kind < 2").select("block", "kind", "doc_id", *_PLAIN, "runs", "sizes")
    return left.groupBy("block").cogroup(known.groupBy("of")).applyInArrow(_scored, RESULT)


def links(a_sizes: list[int], b_sizes: list[int]) -> list[tuple[int, int, int]]:
    """(A token, B token, shared bytes) of one text whose tokens have these sizes."""
    got = Aligned(np.array(a_sizes, np.int64), np.array(b_sizes, np.int64))
    rows = np.repeat(np.arange(len(a_sizes)), np.diff(got.link_ptr))
    return list(zip(rows.tolist(), got.link_b.tolist(), got.overlap.tolist(), strict=True))


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return align_documents(shared.documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))


QUERIES = {"op13_token_alignment": op13_token_alignment}
ORACLES: dict[str, str] = {}
