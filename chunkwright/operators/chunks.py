"""Rows in chunks, and what chunks hold."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chunkwright.functions.expressions import ceil_div, row_bytes


#: Cells of the key space for each chunk.
CELLS = 4
LEAST, MOST = -(1 << 63), (1 << 63) - 1


def plan_of(plan: DataFrame, table: str | None) -> DataFrame:
    """The chunks of `table` or `schema.table`; of all without a name."""
    if not table:
        return plan
    schema, _, name = table.rpartition(".")
    return plan.where((F.col("table") == name) & (F.col("schema") == schema)) if schema else plan.where(F.col("table") == table)


def assign_chunks(df: DataFrame, key: str, plan: DataFrame, table: str | None = None, piece_bytes: int | None = None) -> DataFrame:
    """df with chunk_id by the key ranges of its table's plan. First and last range are open, null keys go to chunk 0.

    table, `table` or `schema.table`, names the one that df is where the plan has more. A plan that has chunks without a range is an error. The key space of the plan is cut to cells, a few for each
    chunk: a row finds its chunk by an equality on the cell and two comparisons. Ranges by cells are broadcast, a few rows for each chunk
    of a threshold of bytes: a shuffle by cell would bring all rows of a wide chunk, as the open last one of blocks, to one task.

    With piece_bytes, also _piece, for writers that gather chunks: a chunk is cut by a hash of the key to as many pieces as its estimate has
    piece_bytes, one without an estimate. Null keys are in one piece.
    """
    no_range = F.raise_error(F.lit("a chunk of the plan has no key range"))
    size = F.col("est_bytes") if "est_bytes" in plan.columns else F.lit(None).cast("long")
    pieces = [F.greatest(F.coalesce(ceil_div(size, F.lit(piece_bytes)), F.lit(1)), F.lit(1)).alias("_pieces")] if piece_bytes else []
    own = plan_of(plan, table).select("idx", F.coalesce(F.col("range_start").cast("long"), no_range).alias("_from"), *pieces)
    bounds = own.agg(F.min("_from").alias("_lo"), F.max("_from").alias("_hi"), F.expr(f"(max(_from) - min(_from)) div ({CELLS} * count(*)) + 1").alias("_width"))
    one = F.broadcast(bounds)  # one row
    after = F.lead("_from").over(Window.orderBy("_from"))  # a row for each chunk of one table
    ranges = own.withColumn("_next", after).crossJoin(one)
    cells = F.sequence(F.expr("(_from - _lo) div _width"), F.expr("(coalesce(_next - 1, _hi) - _lo) div _width"))
    ranges = ranges.select(F.col("idx").cast("long").alias("chunk_id"), F.when(F.col("_from") > F.col("_lo"), F.col("_from")).otherwise(F.lit(LEAST)).alias("_from"), F.coalesce(F.col("_next") - 1, F.lit(MOST)).alias("_to"), F.explode(cells).alias("_cell"), *["_pieces"] * bool(pieces))
    at = F.coalesce(F.col(key).cast("long"), F.lit(LEAST))
    placed = df.drop("chunk_id").crossJoin(one).withColumn("_at", at).withColumn("_c", F.expr("(least(greatest(_at, _lo), _hi) - _lo) div _width"))
    out = placed.join(F.broadcast(ranges), (F.col("_c") == F.col("_cell")) & F.col("_at").between(F.col("_from"), F.col("_to")))
    out = out.withColumn("_piece", F.pmod(F.xxhash64("_at"), "_pieces")) if pieces else out
    return out.drop("_lo", "_hi", "_width", "_at", "_c", "_cell", "_from", "_to", "_pieces")


def assign_blocks(df: DataFrame, plan: DataFrame) -> DataFrame:
    """The same for rows with block numbers."""
    return assign_chunks(df, "block", plan.withColumn("range_start", F.col("block_start")))


def chunk_metrics(df: DataFrame, size: Column | None = None) -> DataFrame:
    """Rows and bytes of each chunk, combined before the shuffle."""
    plain = [c for c in df.columns if c != "chunk_id"]
    return df.groupBy("chunk_id").agg(F.count("*").alias("n_rows"), F.sum(row_bytes(df, plain) if size is None else size).alias("n_bytes"))


def chunk_balance(metrics: DataFrame, plan: DataFrame) -> DataFrame:
    """Estimate and fact of each chunk; chunks without rows count."""
    out = plan.select(F.col("idx").alias("chunk_id"), "est_bytes", "est_rows").join(metrics, "chunk_id", "left")
    zero = F.lit(0).cast("long")
    return out.select("chunk_id", "est_bytes", F.coalesce("n_bytes", zero).alias("n_bytes"), "est_rows", F.coalesce("n_rows", zero).alias("n_rows"))


def balance_ratio(balance: DataFrame) -> DataFrame:
    """The largest chunk over the mean, in thousandths rounded down."""
    most, total, n = F.max("n_bytes"), F.sum("n_bytes"), F.count("*")
    return balance.agg(n.alias("n_chunks"), total.alias("n_bytes"), most.alias("largest"), F.floor(most.cast("decimal(38,0)") * 1000 * n / F.greatest(total, F.lit(1))).cast("long").alias("max_over_mean_milli"))
