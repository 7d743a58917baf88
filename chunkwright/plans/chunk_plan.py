"""Chunk plans: cut each table in chunks of about equal bytes. Catalog rows in, plan rows out; no driver loops.

A catalog row has schema, table, bytes, est_rows, n_blocks, key_col, key_min, key_max. A plan row has schema, table,
strategy, idx, range_start, range_end (both included), block_start, block_end (not included; null: open), est_bytes,
est_rows. Estimates of a table's chunks add up to the table's.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chunkwright.functions.expressions import ceil_div, chunk_file, half_up, safe_name

PLAN = ("schema", "table", "strategy", "idx", "range_start", "range_end", "block_start", "block_end", "est_bytes", "est_rows")


def _plan(df: DataFrame, strategy: str, **columns: Column) -> DataFrame:
    missing = {c: F.lit(None).cast("long") for c in PLAN[4:8]}
    return df.withColumns(missing | columns | {"strategy": F.lit(strategy)}).withColumns({c: F.col(c).cast("long") for c in PLAN[3:]}).select(*PLAN)


def choose_strategy(catalog: DataFrame, threshold: int) -> DataFrame:
    """Adds strategy: single below the threshold, else key_range with a key and its bounds, else block_range, else single."""
    keyed = F.col("key_col").isNotNull() & F.col("key_min").isNotNull() & F.col("key_max").isNotNull()
    how = F.when(F.col("bytes") < threshold, "single").when(keyed, "key_range").when(F.col("n_blocks") > 0, "block_range").otherwise("single")
    return catalog.withColumn("strategy", how)


def plan_single(catalog: DataFrame) -> DataFrame:
    return _plan(catalog, "single", idx=F.lit(0), est_bytes=F.col("bytes"), est_rows=F.greatest("est_rows", F.lit(0)))


def _with_n(catalog: DataFrame, threshold: int, max_chunks: int) -> DataFrame:
    n = F.least(ceil_div(F.col("bytes"), F.lit(threshold).cast("long")), F.lit(max_chunks).cast("long"))
    return catalog.withColumn("_n", F.greatest(n, F.lit(1).cast("long")))


def _remainder(total: Column, each: Column) -> Column:
    """The same estimate for all chunks but the last, which gets what is left."""
    return F.when(F.col("idx") < F.col("_n") - 1, each).otherwise(F.greatest(total - each * (F.col("_n") - 1), F.lit(0)))


def plan_even(catalog: DataFrame, threshold: int, max_chunks: int) -> DataFrame:
    """Key ranges of equal width. Where rounding leaves empty ranges at the end, there are fewer."""
    keys = F.col("key_max") - F.col("key_min") + 1
    wide = _with_n(catalog, threshold, max_chunks).withColumn("_of", F.col("_n")).withColumn("_width", ceil_div(keys, F.col("_n"))).withColumn("_n", ceil_div(keys, F.col("_width")))
    rows = wide.withColumn("idx", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_n") - 1)))
    start = F.col("key_min") + F.col("idx") * F.col("_width")
    return _plan(
        rows,
        "key_range",
        range_start=start,
        range_end=F.least(start + F.col("_width") - 1, F.col("key_max")),
        est_bytes=_remainder(F.col("bytes"), half_up(F.col("bytes"), F.col("_of"))),
        est_rows=_remainder(F.col("est_rows"), half_up(F.col("est_rows"), F.col("_of"))),
    )


def plan_blocks(catalog: DataFrame, blocks_per_chunk: int, max_chunks: int) -> DataFrame:
    """Fixed numbers of blocks; the last chunk is open and takes all the rest."""
    n = F.least(ceil_div(F.col("n_blocks"), F.lit(blocks_per_chunk).cast("long")), F.lit(max_chunks).cast("long"))
    rows = catalog.where("n_blocks > 0").withColumn("_n", n).withColumn("idx", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_n") - 1)))
    start = F.col("idx") * blocks_per_chunk
    return _plan(
        rows,
        "block_range",
        block_start=start,
        block_end=F.when(F.col("idx") < F.col("_n") - 1, start + blocks_per_chunk),
        est_bytes=_remainder(F.col("bytes"), half_up(F.col("bytes") * blocks_per_chunk, F.col("n_blocks"))),
        est_rows=_remainder(F.col("est_rows"), half_up(F.col("est_rows") * blocks_per_chunk, F.col("n_blocks"))),
    )


def plan_balanced(catalog: DataFrame, samples: DataFrame, threshold: int, max_chunks: int) -> DataFrame:
    """Key ranges of equal bytes, by samples (schema, table, pk, bytes) in key order.

    A chunk closes at the first sample where the sampled bytes so far reach its share, at most one chunk at each
    sample: chunk numbers are i + least(0, min over j <= i of (q_j - j)), where q is the share reached. So two running
    windows over the samples do, of which a table has a bounded number. Tables without sampled bytes are cut evenly.
    """
    table = Window.partitionBy("schema", "table")
    ordered = table.orderBy("pk").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    wide = _with_n(catalog, threshold, max_chunks).where("_n > 1")
    s = samples.withColumnRenamed("bytes", "_b").join(wide, ["schema", "table"]).withColumn("_total", F.sum("_b").over(table)).withColumn("_samples", F.count("*").over(table)).where("_total > 0")
    s = s.withColumn("_i", F.row_number().over(table.orderBy("pk")).cast("long")).withColumn("_cum", F.sum("_b").over(ordered))
    reached = F.col("_cum").cast("decimal(20,0)") * F.col("_n")
    q = F.least(((reached - reached % F.col("_total")) / F.col("_total")).cast("long"), F.col("_n") - 1)
    s = s.withColumn("_c", F.col("_i") + F.least(F.lit(0).cast("long"), F.min(q - F.col("_i")).over(ordered)))
    s = s.withColumn("idx", F.coalesce(F.lag("_c").over(table.orderBy("pk")), F.lit(0).cast("long")))
    cuts = s.groupBy("schema", "table", "idx").agg(
        F.max(F.when(F.col("_c") > F.col("idx"), F.col("pk"))).alias("_cut"), F.sum("_b").alias("_own"), F.count("*").alias("_count"),
        *[F.first(c).alias(c) for c in ("bytes", "est_rows", "key_min", "key_max", "_total", "_samples")],
    )
    last = F.max("idx").over(table)
    # A last sample that closes a chunk leaves an open one without samples, unless no key is left for it.
    more = cuts.withColumn("_last", last).where("idx = _last and _cut < key_max")
    more = more.withColumn("idx", F.col("idx") + 1).withColumn("_cut", F.lit(None).cast("long")).withColumn("_own", F.lit(0).cast("long")).withColumn("_count", F.lit(0).cast("long")).drop("_last")
    cuts = cuts.unionByName(more)
    by_idx = table.orderBy("idx")
    cuts = cuts.withColumn("_end", F.lead("idx").over(by_idx).isNull()).withColumn("range_start", F.coalesce(F.lag("_cut").over(by_idx) + 1, F.col("key_min")))
    before = by_idx.rowsBetween(Window.unboundedPreceding, -1)
    for name, own, of in (("bytes", "_own", "_total"), ("est_rows", "_count", "_samples")):
        cuts = cuts.withColumn(f"_e_{name}", half_up(F.col(own).cast("decimal(20,0)") * F.col(name), F.col(of)))
        cuts = cuts.withColumn(f"_r_{name}", F.when(F.col("_end"), F.greatest(F.col(name) - F.coalesce(F.sum(f"_e_{name}").over(before), F.lit(0)), F.lit(0))).otherwise(F.col(f"_e_{name}")))
    balanced = _plan(cuts, "key_range", range_start=F.col("range_start"), range_end=F.when(F.col("_end"), F.col("key_max")).otherwise(F.col("_cut")), est_bytes=F.col("_r_bytes"), est_rows=F.col("_r_est_rows"))
    rest = catalog.join(balanced.select("schema", "table").distinct(), ["schema", "table"], "left_anti")
    return balanced.unionByName(plan_even(rest, threshold, max_chunks))


def plan_all(catalog: DataFrame, samples: DataFrame, threshold: int, max_chunks: int, blocks_per_chunk: int) -> DataFrame:
    """Every table by its strategy."""
    chosen = choose_strategy(catalog, threshold)
    part = lambda s: chosen.where(F.col("strategy") == s).drop("strategy")
    return plan_single(part("single")).unionByName(plan_balanced(part("key_range"), samples, threshold, max_chunks)).unionByName(plan_blocks(part("block_range"), blocks_per_chunk, max_chunks))


def fill_estimates(plan: DataFrame, catalog: DataFrame) -> DataFrame:
    """Missing estimates become the table's, dealt evenly over its chunks."""
    whole = catalog.select("schema", "table", F.col("bytes").alias("_bytes"), F.col("est_rows").alias("_rows"))
    n = F.count("*").over(Window.partitionBy("schema", "table"))
    out = plan.withColumn("_n", n).join(whole, ["schema", "table"], "left")
    out = out.withColumn("est_bytes", F.coalesce("est_bytes", half_up(F.col("_bytes"), F.col("_n")))).withColumn("est_rows", F.coalesce("est_rows", half_up(F.col("_rows"), F.col("_n"))))
    return out.select(*plan.columns)


def chunk_paths(plan: DataFrame, codec: str = "zstd") -> DataFrame:
    return plan.withColumn("file", chunk_file(F.col("schema"), F.col("table"), F.col("idx"), codec))


def chunk_folders(plan: DataFrame) -> DataFrame:
    """Adds file: the folder to which a chunk is written, by partition columns, so that manifest and folders agree."""
    return plan.withColumn("file", F.concat(F.lit("data/chunk_table="), "table", F.lit("/chunk_id="), F.col("idx").cast("string")))


def chunk_places(plan: DataFrame) -> DataFrame:
    """Adds file: the folder of a chunk by schema, table and number, so that tables of several schemas stay apart."""
    return plan.withColumn("file", F.concat(F.lit("data/"), safe_name(F.col("schema")), F.lit("."), safe_name(F.col("table")), F.lit("/chunk_id="), F.col("idx").cast("string")))


def plan_jobs(manifest: DataFrame) -> DataFrame:
    """One row for each chunk of a manifest (its tables as nested rows).

    plan names run, table and all its ranges, and n_chunks is how many chunks that plan has: what a load of several runs needs to know when a table is whole.
    """
    run = F.col("run_id") if "run_id" in manifest.columns else F.lit(None).cast("string")
    tables = manifest.select(run.alias("_run"), F.explode("tables").alias("t"))
    ranges = F.transform("t.chunks", lambda c: F.concat_ws(",", *[F.coalesce(c[n].cast("string"), F.lit("-")) for n in ("idx", "range_start", "range_end", "block_start", "block_end")]))
    name = F.sha2(F.concat_ws("\n", F.coalesce("_run", F.lit("")), "t.schema", "t.table", "t.strategy", F.array_sort(ranges)), 256)
    rows = tables.select("t.schema", "t.table", "t.kind", "t.strategy", name.alias("plan"), F.size("t.chunks").cast("long").alias("n_chunks"), F.explode("t.chunks").alias("c"))
    return rows.select("schema", "table", "kind", "strategy", "plan", "n_chunks", "c.*")


def order_jobs(jobs: DataFrame) -> DataFrame:
    """Adds place: largest first. Plans are small, one row for each chunk of about a threshold of bytes."""
    return jobs.withColumn("place", F.row_number().over(Window.orderBy(F.desc("est_bytes"), "schema", "table", "idx")).cast("long"))


def strategy_mix(plan: DataFrame) -> DataFrame:
    return plan.groupBy("strategy").agg(F.count("*").alias("n_chunks"), F.count_distinct("schema", "table").alias("n_tables"))


def audit_plan(plan: DataFrame, catalog: DataFrame) -> DataFrame:
    """For each table: are ranges contiguous, do they begin and end at the bounds, do estimates add up, is none negative."""
    by = Window.partitionBy("schema", "table").orderBy("idx")
    steps = plan.withColumn("_before", F.lag("range_end").over(by)).withColumn("_block", F.lag("block_end").over(by))
    ok = (F.col("idx") == 0) | F.when(F.col("strategy") == "key_range", F.col("range_start") == F.col("_before") + 1).when(F.col("strategy") == "block_range", F.col("block_start") == F.col("_block")).otherwise(F.lit(False))
    sums = steps.groupBy("schema", "table").agg(
        F.count("*").alias("n_chunks"), F.bool_and(F.coalesce(ok, F.lit(False))).alias("contiguous"), F.min("range_start").alias("_lo"), F.max("range_end").alias("_hi"),
        F.sum("est_bytes").alias("_bytes"), F.sum("est_rows").alias("_rows"), F.bool_and((F.col("est_bytes") >= 0) & (F.col("est_rows") >= 0)).alias("none_negative"),
    )
    out = sums.join(catalog, ["schema", "table"])
    bounds = F.col("_lo").isNull() | ((F.col("_lo") == F.col("key_min")) & (F.col("_hi") == F.col("key_max")))
    return out.select("schema", "table", "n_chunks", "contiguous", bounds.alias("bounds_match"), ((F.col("_bytes") == F.col("bytes")) & (F.col("_rows") == F.col("est_rows"))).alias("sums_match"), "none_negative")


def preview(jobs: DataFrame, ledger: DataFrame) -> DataFrame:
    """What a run would do: jobs with done set where the ledger has their chunk_key."""
    marks = ledger.select("chunk_key").distinct().withColumn("_done", F.lit(True))
    return jobs.join(marks, "chunk_key", "left").withColumn("done", F.coalesce("_done", F.lit(False))).drop("_done")
