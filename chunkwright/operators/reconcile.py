"""Source and target: the same rows?"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chunkwright.operators.chunks import assign_chunks, plan_of


def row_hash(names: list[str]) -> Column:
    """A hash of a row's values. Spark's hash skips nulls, so each value brings a mark of whether it is one."""
    return F.xxhash64(*[x for c in names for x in (F.col(f"`{c}`"), F.col(f"`{c}`").isNull())])


def fingerprint(tables: dict[str, DataFrame], columns: dict[str, list[str]] | None = None) -> DataFrame:
    """(table, n_rows, value_hash) of each table; the hash doesn't depend on the order of rows."""
    columns, parts = columns or {}, []
    for name, df in tables.items():
        names = columns.get(name, df.columns)
        one = df.agg(F.count("*").alias("n_rows"), F.coalesce(F.sum(row_hash(names).cast("decimal(38,0)")), F.lit(0).cast("decimal(38,0)")).cast("string").alias("value_hash"))
        parts.append(one.select(F.lit(name).alias("table"), "n_rows", "value_hash"))
    return reduce(DataFrame.unionByName, parts)


def reconcile(source: DataFrame, target: DataFrame) -> DataFrame:
    """Fingerprints side by side; a table that one side lacks has nulls there."""
    side = lambda df, p: df.select("table", F.col("n_rows").alias(f"{p}_rows"), F.col("value_hash").alias(f"{p}_hash"))
    out = side(source, "source").join(side(target, "target"), "table", "full_outer")
    same = F.col("source_rows").eqNullSafe(F.col("target_rows"))
    return out.select("table", "source_rows", "target_rows", same.alias("rows_match"), (same & F.col("source_hash").eqNullSafe(F.col("target_hash"))).alias("values_match"))


def surplus_rows(source: DataFrame, target: DataFrame, key: str, columns: list[str] | None = None) -> DataFrame:
    """(key, _hash, n): how many more rows with these values the source has than the target, or fewer; equal ones are left out.

    Tables are multisets: rows are counted by key and hash of their values, nulls like other values, in one shuffle that
    takes what each side has combined before.
    """
    names = columns or source.columns
    side = lambda df, n: df.select(F.col(f"`{key}`").alias(key), row_hash(names).alias("_hash"), F.lit(n).cast("long").alias("n"))
    return side(source, 1).unionAll(side(target, -1)).groupBy(f"`{key}`", "_hash").agg(F.sum("n").alias("n")).where("n <> 0")


def changed_rows(source: DataFrame, target: DataFrame, key: str) -> DataFrame:
    """Keys, null among them, whose rows differ: missing if only the source has rows more, extra if only the target has, changed if both have. A null and a value are different, wherever they stand."""
    return difference_counts(source, target, key).select(key, "difference")


def difference_counts(source: DataFrame, target: DataFrame, key: str, columns: list[str] | None = None) -> DataFrame:
    """changed_rows with n_missing and n_extra, the rows of the key that only one side has."""
    sums = surplus_rows(source, target, key, columns).groupBy(f"`{key}`").agg(F.coalesce(F.sum(F.when(F.col("n") > 0, F.col("n"))), F.lit(0)).alias("n_missing"), F.coalesce(F.sum(F.when(F.col("n") < 0, -F.col("n"))), F.lit(0)).alias("n_extra"))
    how = F.when(F.col("n_extra") == 0, "missing").when(F.col("n_missing") == 0, "extra").otherwise("changed")
    return sums.select(F.col(f"`{key}`"), how.alias("difference"), "n_missing", "n_extra")


def chunk_digests(df: DataFrame, key: str, plan: DataFrame, table: str | None = None, columns: list[str] | None = None) -> DataFrame:
    """(chunk_id, n_rows, digest) by the key ranges of a plan; the digest doesn't depend on the order of rows."""
    names = columns or df.columns
    rows = assign_chunks(df.select(*{*names, key}), key, plan, table)
    return rows.groupBy("chunk_id").agg(F.count("*").alias("n_rows"), F.sum(row_hash(names).cast("decimal(38,0)")).cast("string").alias("digest"))


def differing_chunks(source: DataFrame, target: DataFrame) -> DataFrame:
    """chunk_id, source_rows, target_rows of chunks whose digests differ; a chunk without rows has none."""
    side = lambda df, p: df.select("chunk_id", F.col("n_rows").alias(f"{p}_rows"), F.col("digest").alias(f"_{p}"))
    both = side(source, "source").join(side(target, "target"), "chunk_id", "full_outer").where(~F.col("_source").eqNullSafe(F.col("_target")) | ~F.col("source_rows").eqNullSafe(F.col("target_rows")))
    return both.select("chunk_id", F.coalesce("source_rows", F.lit(0)).alias("source_rows"), F.coalesce("target_rows", F.lit(0)).alias("target_rows"))


def in_chunks(key: str, plan: list, wanted: set[int]) -> Column:
    """Rows whose key is in one of the wanted chunks of a plan (idx, range_start), as ranges that a scan can use. First and last chunk are open, null keys are in chunk 0."""
    at, out = sorted(plan, key=lambda r: r.range_start), F.lit(False)
    for k, r in enumerate(at):
        if r.idx in wanted and not (k and at[k - 1].idx in wanted):
            last = next((j for j in range(k, len(at)) if at[j].idx not in wanted), len(at))
            low = F.lit(True) if k == 0 else F.col(key) >= r.range_start
            out = out | (low if last == len(at) else low & (F.col(key) < at[last].range_start))
    return out | F.col(key).isNull() if 0 in wanted else out & F.col(key).isNotNull()


def diff_by_chunks(source: DataFrame, target: DataFrame, key: str, plan: DataFrame, table: str | None = None) -> DataFrame:
    """difference_counts by a tree of digests: of the table's chunks first, then, in chunks that differ, of rows.

    Only rows of chunks that differ are read again, by ranges of the key that reach the scan; where none differs nothing is. The
    plan and the list of chunks that differ have a row for each chunk of a threshold of bytes.
    """
    names = source.columns
    wanted = {r.chunk_id for r in differing_chunks(*[chunk_digests(df, key, plan, table, names) for df in (source, target)]).collect()}
    if not wanted:
        return difference_counts(source.limit(0), target.limit(0), key)
    inside = in_chunks(key, plan_of(plan, table).select("idx", "range_start").collect(), wanted)
    return difference_counts(source.where(inside), target.where(inside), key, names)
