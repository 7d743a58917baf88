"""Line dedup with content-defined chunks of lines (DataFrame functions only).

A text is split at \\n and every line hashed. A rolling hash over WINDOW line hashes closes a chunk where it is 0
modulo EVERY, so an inserted or lost line moves only the borders next to it. Chunks with two or more lines that hold
a word count; where the same lines stand as a chunk anywhere else in the table, or earlier in the same text, only
the first chunk stays: the one of the smallest doc_id, and in it the first. Hashes only find candidates: chunks are
the same if their bytes are, as they are grouped and joined by hash and text.

Only hashes and positions of all chunks are shuffled; text of chunks moves for those whose hash repeats. A chunk that a
third of all texts share is aggregated before its shuffle, and the join back is one that Spark can split.

With whole_runs, which the query and the pipeline set, the units that are compared are all pairs of a line that holds a
word and the next such line, with the blank lines between, in place of chunks: any run of two or more such lines
that stands at an earlier place goes whole, as all its pairs do, wherever borders of chunks are. Each line that goes has an
equal line that stays at an earlier place. Chunks then only count what went.

A null text has no lines and stays null; an empty one has one line and stays. A text may lose all its lines and is
then empty, but its row stays. A null doc_id counts as smaller than all others. Rows that share doc_id and text count
as one row, and each gets the result. Texts of any length are read whole. Other columns pass through, whatever their
names; n_chars, if there, is counted anew. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chunkwright.llm import shared

WINDOW = 2
EVERY = 3
_CODE_LEN = (1 << 31) - 1
_WORD = "[^\\\\x20\\\\x09-\\\\x0D]"


def _keyed(docs: DataFrame) -> DataFrame:
    """docs with a row key, _k1 and _k2."""
    return docs.withColumn("_k1", F.xxhash64("doc_id", "text")).withColumn("_k2", F.xxhash64("text", "doc_id", F.lit(1)))


def _hashed(docs: DataFrame) -> DataFrame:
    return docs.withColumn("_lines", F.split("text", "\n")).withColumn("_hashes", F.expr("transform(_lines, x -> xxhash64(x))"))


def _chunked(docs: DataFrame, window: int, every: int) -> DataFrame:
    """docs with _lines, _hashes and _chunks (first line and number of lines of each chunk in one long)."""
    hashed = _hashed(docs)
    rolling = ", ".join(f"get(_hashes, i - {k})" for k in range(1, window))
    ends = f"filter(sequence(0, size(_hashes) - 1), i -> i = size(_hashes) - 1 or pmod(xxhash64(get(_hashes, i), {rolling}), {every}) = 0)"
    cut = hashed.withColumn("_ends", F.expr(f"case when size(_hashes) > 0 then {ends} end"))
    return cut.withColumn("_chunks", F.expr("transform(_ends, (e, j) -> shiftleft(cast(coalesce(get(_ends, j - 1) + 1, 0) as bigint), 32) | cast(e - coalesce(get(_ends, j - 1), -1) as bigint))"))


def _paired(docs: DataFrame) -> DataFrame:
    """As _chunked, but with each line that holds a word and the next such line as a chunk; these overlap."""
    worded = _hashed(docs).withColumn("_worded", F.expr(f"case when size(_hashes) > 0 then filter(sequence(0, size(_hashes) - 1), i -> get(_lines, i) rlike '{_WORD}') end"))
    return worded.withColumn("_chunks", F.expr("transform(slice(_worded, 1, greatest(size(_worded) - 1, 0)), (i, j) -> shiftleft(cast(i as bigint), 32) | cast(get(_worded, j + 1) - i + 1 as bigint))"))


_START, _LEN = "cast(shiftright({c}, 32) as int)", f"cast({{c}} & {_CODE_LEN}L as int)"
_SLICE = "slice({a}, " + _START + " + 1, " + _LEN + ")"


def repeated_chunks(keyed: DataFrame, dealt: DataFrame, cut: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """(_k1, _k2, _gone: codes of chunks to remove) for rows that lose any. dealt is keyed, dealt by its key."""
    texts = cut(keyed.select("_k1", "_k2", "text"))
    multi = "filter(_chunks, c -> (c & {m}L) > 1)".format(m=_CODE_LEN)
    spread = texts.select("_k1", "_k2", F.explode(F.expr(f"transform({multi}, c -> named_struct('code', c, 'hash', xxhash64({_SLICE.format(a='_hashes', c='c')})))")).alias("c"))
    hashes = spread.select("_k1", "_k2", "c.hash", "c.code")
    # A row that occurs twice is one row: its key counts once.
    ranges = [f(c).alias(f"{c}_{f.__name__}") for c in ("_k1", "_k2", "code") for f in (F.min, F.max)]
    seen = hashes.groupBy("hash").agg(*ranges).where("_k1_min != _k1_max or _k2_min != _k2_max or code_min != code_max").select("hash")
    wanted = hashes.join(seen, "hash").groupBy("_k1", "_k2").agg(F.collect_set("code").alias("_maybe"))

    # Texts meet their candidates where they are dealt by row key: bare texts are shuffled, once for this and for the removal.
    own = dealt.select("_k1", "_k2", "doc_id", "text").join(wanted, ["_k1", "_k2"]).withColumn("_lines", F.split("text", "\n"))
    pick = f"transform(_maybe, c -> named_struct('code', c, 'text', array_join({_SLICE.format(a='_lines', c='c')}, '\n'), 'worded', size(filter({_SLICE.format(a='_lines', c='c')}, x -> x rlike '{_WORD}'))))"
    chunks = own.select("_k1", "_k2", "doc_id", F.explode(F.expr(pick)).alias("c")).where("c.worded > 1").select("_k1", "_k2", "doc_id", "c.code", "c.text")
    place = F.struct("doc_id", "_k1", "_k2", "code")
    firsts = chunks.groupBy("text").agg(F.min(place).alias("first"), F.max(place).alias("last")).where("first != last").select("text", "first")
    return chunks.join(firsts, "text").where(F.col("first") != place).groupBy("_k1", "_k2").agg(F.collect_set("code").alias("_gone"))


def remove_repeats(docs: DataFrame, window: int = WINDOW, every: int = EVERY, whole_runs: bool = False) -> DataFrame:
    """docs with text reduced, and _n_lines, _n_removed (lines), _n_gone (chunks that went whole)."""
    own = ("doc_id", "text")
    keyed = _keyed(shared.hidden(docs, own))
    dealt = keyed.repartition("_k1", "_k2")
    gone = repeated_chunks(keyed, dealt, _paired if whole_runs else lambda d: _chunked(d, window, every))
    out = _chunked(dealt.join(gone, ["_k1", "_k2"], "left"), window, every)
    # Pairs overlap, so lines are told apart by number: those that stay, and the chunk of each.
    lost = "flatten(transform(_gone, c -> sequence({s}, {s} + {n} - 1)))".format(s=_START.format(c="c"), n=_LEN.format(c="c"))
    out = out.withColumn("_left", F.expr(f"case when _gone is not null then array_except(sequence(0, size(_lines) - 1), {lost}) end"))
    out = out.withColumn("_chunk_of", F.expr(f"case when _gone is not null then flatten(transform(_chunks, (c, j) -> array_repeat(j, {_LEN.format(c='c')}))) end"))
    out = out.withColumn("text", F.expr("case when _gone is null then text else array_join(transform(_left, i -> get(_lines, i)), '\n') end"))
    out = out.withColumn("_n_lines", F.expr("cast(coalesce(size(_lines), 0) as bigint)")).withColumn("_n_lines", F.greatest("_n_lines", F.lit(0)))
    out = out.withColumn("_n_gone", F.expr("cast(case when _gone is null then 0 else size(_chunks) - size(array_distinct(transform(_left, i -> get(_chunk_of, i)))) end as bigint)"))
    out = out.withColumn("_n_removed", F.expr("cast(case when _gone is null then 0 else size(_lines) - size(_left) end as bigint)"))
    if "n_chars" in docs.columns:
        out = out.withColumn("_in_n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return shared.shown(out, docs, own, ("_n_lines", "_n_removed", "_n_gone"))


def dedup_lines(docs: DataFrame, keep_share: float = 0.0, drop_empty: bool = False, **options) -> DataFrame:
    """The rows and columns of docs, with repeated chunks (or runs) gone from text.

    With drop_empty, rows that lose lines and are left without a word go: all that they said stands elsewhere. With keep_share, rows
    that lose lines and keep a smaller share of their characters go too. Rows that lose nothing stay, whatever their text.
    """
    was = "_chars" + "_" * max(map(len, docs.columns))
    out = remove_repeats(docs.withColumn(was, F.length("text")), **options)
    stays = F.length("text") >= keep_share * F.col(was)
    stays = stays & F.col("text").rlike(r"[^\x20\x09-\x0D]") if drop_empty else stays
    return out.where((F.col("_n_removed") == 0) | stays).select(*[F.col(f"`{c}`") for c in docs.columns])


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = remove_repeats(shared.documents(spark, sf_dir).select("doc_id", "text"), whole_runs=True)
    kept = F.encode(F.coalesce("text", F.lit("")), "UTF-8")
    return out.select("doc_id", F.col("_n_lines").alias("n_lines"), F.col("_n_removed").alias("n_removed"), F.col("_n_gone").alias("n_chunks_removed"), F.octet_length(kept).cast("long").alias("kept_bytes"), F.sha2(kept, 256).alias("kept_sha256"))


QUERIES = {"op2_line_dedup": op2_line_dedup}
ORACLES: dict[str, str] = {}
