"""Exact top-k inner products over an impact-ordered index, score at a time.

Vectors are whole numbers (components times 256, floored). Candidates are dealt to blocks of about BLOCK_ROWS; in a
block every dimension has a posting segment for each quantised value (the value without its low bits), and for a
query a segment's impact is the least that it adds to the score, above the least of its dimension. Segments of all
dimensions are taken by descending impact and added to one accumulator for each row. What is still to come in a
dimension is at most the impact of its next segment, so accumulator + sum of these bounds a row from above and the
accumulator alone from below. Rows that this proves out are dropped; work stops where rescoring the rest with
whole-number inner products reads fewer components than the postings that are left, and at the latest where all
postings are read. Per block the k best leave, and a window takes the best k of all blocks, ties to the smaller id.

A block's index is built once: its rows come before its queries in one sorted stream, and queries pass through it in
batches, so a task holds one block, whatever the number of queries. A query is a row whose id is divisible by `every`;
a query id that repeats is asked once, with its smallest vector. Candidates are all rows with another id than the
query's, also where ids repeat. Vectors that are null, or that hold null or non-finite components, and rows with a null
id take no part. Shorter vectors are filled up with zeros; an empty vector is all zeros. Fewer than k candidates give
fewer rows, an empty table an empty result. Columns other than vec_id and embedding aren't read. Components times 256
must fit 31 bits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

BLOCK_ROWS = 32768
#: So few rows are rescored at once, whatever is left of the postings.
RESCORED = 16
LEVELS = 64
CHECK_EVERY = 128


class ImpactIndex:
    """Posting segments of a block of whole-number vectors."""

    def __init__(self, rows: np.ndarray, levels: int = LEVELS):
        self.rows = rows
        span = int(rows.max() - rows.min()) if rows.size else 0
        self.shift = max(0, (span // levels).bit_length())
        level = rows >> self.shift
        self.segments: list[tuple[np.ndarray, list[np.ndarray]]] = []
        for d in range(rows.shape[1]):
            order = np.argsort(level[:, d], kind="stable")
            values, cuts = np.unique(level[order, d], return_index=True)
            self.segments.append((values, np.split(order, cuts[1:])))

    def _ordered(self, query: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Dimension, number and impact of all segments by descending impact, each one's successor's bound in its dimension, and the bounds at the start."""
        dim, number, impact, after, top = [], [], [], [], np.zeros(len(query), np.int64)
        low = (1 << self.shift) - 1
        for d, q in enumerate(query.tolist()):
            values = self.segments[d][0]
            if not q or not len(values):
                continue
            ends = q * (values << self.shift), q * ((values << self.shift) + low)
            least, most = np.minimum(*ends), np.maximum(*ends)
            floor = least.min()
            order = np.argsort(-least, kind="stable")
            most = most[order] - floor
            dim.append(np.full(len(order), d))
            number.append(order)
            impact.append(least[order] - floor)
            after.append(np.append(most[1:], 0))
            top[d] = most[0]
        if not dim:
            none = np.zeros(0, np.int64)
            return none, none, none, none, top
        dim, number, impact, after = map(np.concatenate, (dim, number, impact, after))
        order = np.argsort(-impact, kind="stable")
        return dim[order], number[order], impact[order], after[order], top

    def possible(self, query: np.ndarray, k: int) -> np.ndarray:
        """Rows that may be among the k best."""
        n = len(self.rows)
        if n <= k:
            return np.arange(n)
        dim, number, impact, after, left = self._ordered(query)
        low = (1 << self.shift) - 1
        # What a row has gained may exceed its segment's impact by the low bits; that slack stays in the bound.
        slack = np.abs(query) * low
        score = np.zeros(n, np.int64)
        rest, alive = int(left.sum()), np.arange(n)
        unread = n * int(np.count_nonzero(query))
        for i, (d, s, x) in enumerate(zip(dim.tolist(), number.tolist(), impact.tolist(), strict=True)):
            segment = self.segments[d][1][s]
            score[segment] += x
            unread -= len(segment)
            new = max(int(after[i]), int(slack[d]))
            rest += new - int(left[d])
            left[d] = new
            if i % CHECK_EVERY == CHECK_EVERY - 1:
                kth = np.partition(score, n - k)[n - k]
                alive = np.flatnonzero(score + rest >= kth)
                if len(alive) <= RESCORED or len(alive) * len(query) <= unread:
                    return alive
        kth = np.partition(score, n - k)[n - k]
        return np.flatnonzero(score + rest >= kth)

    def best(self, query: np.ndarray, ids: np.ndarray, k: int, own: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Ids and scores of the k best rows whose id isn't own."""
        rows = self.possible(query, k + (0 if own is None else int(np.count_nonzero(ids == own))))
        rows = rows if own is None else rows[ids[rows] != own]
        score = self.rows[rows] @ query
        order = np.lexsort((ids[rows], -score))[:k]
        return ids[rows[order]], score[order]


def _matrix(vectors: pa.ListArray, width: int | None = None) -> np.ndarray:
    """Rows of the list's values, filled up with zeros or cut to width."""
    size = np.diff(vectors.offsets.to_numpy())
    out = np.zeros((len(size), int(size.max(initial=0))), np.int64)
    out[np.arange(out.shape[1]) < size[:, None]] = vectors.flatten().to_numpy()
    if width is None or width == out.shape[1]:
        return out
    fit = np.zeros((len(size), width), np.int64)
    least = min(width, out.shape[1])
    fit[:, :least] = out[:, :least]
    return fit


def _search(k: int):
    """Rows (block, asks, vec_id, v) in order of block and asks: first a block's vectors, then its queries."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, kept, index, ids = None, [], None, np.zeros(0, np.int64)
        for batch in batches:
            where = batch.column(0).to_numpy() * 2 + batch.column(1).to_numpy()
            cuts = [0, *(np.flatnonzero(np.diff(where)) + 1).tolist(), len(where)]
            for s, e in zip(cuts, cuts[1:], strict=False):
                if s == e:
                    continue
                own, asks = divmod(int(where[s]), 2)
                if own != block:
                    block, kept, index = own, [], None
                part = batch.slice(s, e - s)
                if not asks:
                    kept.append(part)
                    continue
                if index is None and kept:
                    table = pa.Table.from_batches(kept)
                    ids, index = table.column(2).to_numpy(), ImpactIndex(_matrix(pa.concat_arrays(table.column(3).chunks)))
                    kept = []
                if index is None:
                    continue
                out = []
                for q, vector in zip(part.column(2).to_pylist(), _matrix(part.column(3), index.rows.shape[1]), strict=True):
                    found, score = index.best(vector, ids, k, q)
                    out += [(q, i, x) for i, x in zip(found.tolist(), score.tolist(), strict=True)]
                cols = np.array(out, np.int64).reshape(-1, 3)
                yield pa.RecordBatch.from_pydict({c: pa.array(cols[:, i]) for i, c in enumerate(("query_id", "vec_id", "score"))})

    return run


def top_k(vectors: DataFrame, k: int = 5, every: int = 50, scale: int = 256) -> DataFrame:
    """query_id, rank, vec_id, score over columns vec_id and embedding."""
    good = "embedding is not null and vec_id is not null and forall(embedding, x -> x is not null and not isnan(x) and abs(x) < double('inf'))"
    whole = vectors.where(good).select(F.col("vec_id").cast("long").alias("vec_id"), F.expr(f"transform(embedding, x -> floor({scale} * double(x)))").alias("v"))
    blocks = max(1, -(-vectors.count() // BLOCK_ROWS))
    index = whole.select(F.pmod(F.xxhash64("vec_id", "v"), F.lit(blocks).cast("long")).alias("block"), F.lit(0).cast("long").alias("asks"), "vec_id", "v")
    queries = whole.where(F.col("vec_id") % every == 0).groupBy("vec_id").agg(F.min("v").alias("v"))
    queries = queries.select(F.explode(F.expr(f"sequence(0L, {blocks - 1}L)")).alias("block"), F.lit(1).cast("long").alias("asks"), "vec_id", "v")
    dealt = index.unionByName(queries).repartition(2 * blocks, "block").sortWithinPartitions("block", "asks")
    found = dealt.mapInArrow(_search(k), "query_id long, vec_id long, score long")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op10_impact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


QUERIES = {"op10_impact_topk": op10_impact_topk}
ORACLES = {
    "op10_impact_topk": """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.e, c.e) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM p QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) <= 5
"""
}
