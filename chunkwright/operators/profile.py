"""Catalog and profile of tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from chunkwright.functions.expressions import ceil_div, row_bytes

CATALOG = "schema string, table string, kind string, est_rows long, bytes long, n_blocks long, key_col string, key_min long, key_max long"
SYSTEM_SCHEMAS = ("information_schema",)
SYSTEM_PREFIX = "pg_"


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def profile_tables(tables: dict[str, DataFrame], keys: dict[str, str | None] | None = None, columns: dict[str, list[str]] | None = None, schema: str = "public", kinds: dict[str, str] | None = None, rows_per_block: int = 1 << 16) -> DataFrame:
    """A catalog row for each table: rows, bytes, blocks and key bounds in one pass each, largest first."""
    keys, columns, kinds = keys or {}, columns or {}, kinds or {}
    parts = []
    for name, df in tables.items():
        key = keys.get(name)
        low, high = (F.min(key).cast("long"), F.max(key).cast("long")) if key else (F.lit(None).cast("long"),) * 2
        one = df.agg(F.count("*").alias("est_rows"), F.coalesce(F.sum(row_bytes(df, columns.get(name))), F.lit(0).cast("long")).alias("bytes"), low.alias("key_min"), high.alias("key_max"))
        one = one.withColumns({"schema": F.lit(schema), "table": F.lit(name), "kind": F.lit(kinds.get(name, "r")), "key_col": F.lit(key).cast("string"), "n_blocks": ceil_div(F.col("est_rows"), F.lit(rows_per_block))})
        parts.append(one.select("schema", "table", "kind", "est_rows", "bytes", "n_blocks", "key_col", "key_min", "key_max"))
    return _union(parts)


def user_tables(catalog: DataFrame, schema: str | None = None) -> DataFrame:
    """Tables and views outside system schemas, of one schema if asked; largest first, unknown sizes last."""
    mine = catalog.where(~F.col("schema").isin(*SYSTEM_SCHEMAS) & ~F.col("schema").startswith(SYSTEM_PREFIX) & F.col("kind").isin("r", "m"))
    return (mine.where(F.col("schema") == schema) if schema else mine).orderBy(F.desc_nulls_last("bytes"), "table")


def profile_columns(tables: dict[str, DataFrame], generated: dict[str, list[str]] | None = None) -> DataFrame:
    """A row for each column in table order: position from 1, whether it is generated, and how many values it has."""
    generated = generated or {}
    parts = []
    for name, df in tables.items():
        made = generated.get(name, [])
        counts = df.agg(*[F.count(c).alias(c) for c in df.columns])
        rows = F.array(*[F.struct(F.lit(i + 1).cast("long").alias("position"), F.lit(c).alias("column"), F.lit(c in made).alias("generated"), F.col(f"`{c}`").alias("n_values")) for i, c in enumerate(df.columns)])
        parts.append(counts.select(F.lit(name).alias("table"), F.inline(rows)))
    return _union(parts)


def column_lists(columns: DataFrame) -> DataFrame:
    """For each table its plain and its generated columns, in table order."""
    listed = columns.groupBy("table").agg(F.array_sort(F.collect_list(F.struct("position", "column", "generated"))).alias("_c"))
    pick = lambda made: F.transform(F.filter("_c", lambda c: c["generated"] == F.lit(made)), lambda c: c["column"])
    return listed.select("table", pick(False).alias("columns"), pick(True).alias("generated"))


def key_sketches(tables: dict[str, DataFrame]) -> DataFrame:
    """(table, column, position, n_rows, n_values, n_distinct, low, high) of every integer column; distinct values by a sketch. One pass over each table."""
    parts = []
    for name, df in tables.items():
        ints = [c for c, t in df.dtypes if t in ("smallint", "int", "bigint")]
        if ints:
            one = df.agg(F.count("*").alias("n"), *[f(c).cast("long").alias(f"{p}{i}") for i, c in enumerate(ints) for p, f in (("v", F.count), ("d", F.approx_count_distinct), ("l", F.min), ("h", F.max))])
            rows = F.array(*[F.struct(F.lit(c).alias("column"), F.lit(i).alias("position"), F.col("n").alias("n_rows"), *[F.col(f"{p}{i}").alias(x) for p, x in (("v", "n_values"), ("d", "n_distinct"), ("l", "low"), ("h", "high"))]) for i, c in enumerate(ints)])
            parts.append(one.select(F.lit(name).alias("table"), F.inline(rows)))
    if not parts:
        return next(iter(tables.values())).sparkSession.createDataFrame([], "table string, column string, position int, n_rows long, n_values long, n_distinct long, low long, high long")
    return _union(parts)


def pick_chunk_key(tables: dict[str, DataFrame], declared: dict[str, str] | None = None) -> DataFrame:
    """The chunk key of each table: an integer column that is never null and never repeats, a declared one first, else the first in table order; null if none.

    One job makes sketches of all columns of all tables. They drop columns with nulls, with fewer whole numbers between
    their bounds than rows, and with under half as many distinct values as rows: the sketch's standard error is a twentieth, so
    a unique column would have to be ten of them off. What is left is counted exactly, in the result's own job.
    """
    spark, declared = next(iter(tables.values())).sparkSession, declared or {}
    seen = key_sketches(tables).collect()  # a row for each integer column
    likely = [r for r in seen if r.n_values == r.n_rows and (not r.n_rows or r.high - r.low + 1 >= r.n_rows) and r.n_distinct >= 0.5 * r.n_rows]
    parts = [spark.createDataFrame([(t, None, True, 1 << 30) for t in tables], "table string, key_col string, other boolean, position int")]
    for r in likely:
        most = tables[r.table].groupBy(F.col(r.column).alias("k")).count().agg(F.coalesce(F.max("count"), F.lit(1)).alias("most"))
        parts.append(most.where("most = 1").select(F.lit(r.table).alias("table"), F.lit(r.column).alias("key_col"), F.lit(r.column != declared.get(r.table)).alias("other"), F.lit(r.position).alias("position")))
    best = _union(parts).groupBy("table").agg(F.min_by("key_col", F.struct(F.col("key_col").isNull(), "other", "position")).alias("key_col"))
    return best.select("table", "key_col")


def sequence_state(catalog: DataFrame) -> DataFrame:
    """High-water mark of each keyed table; unused ones are dropped."""
    return catalog.where("key_max is not null").select("schema", "table", F.col("key_max").alias("last_value"), F.lit(True).alias("is_called")).orderBy("schema", "table")


def assert_schema(catalog: DataFrame, schema: str) -> None:
    """Fails with the list of schemas if there is no such one."""
    if catalog.where(F.col("schema") == schema).isEmpty():
        names = [r[0] for r in catalog.select("schema").distinct().orderBy("schema").limit(100).collect()]
        raise ValueError(f"no schema {schema!r}; there are: {', '.join(names) or 'none'}")


def key_bounds(df: DataFrame, key: str) -> DataFrame:
    """Smallest and largest key; both null for an empty table."""
    return df.agg(F.min(key).cast("long").alias("key_min"), F.max(key).cast("long").alias("key_max"))


def probe_sample(df: DataFrame, key: str, target: int = 10_000, size: Column | None = None) -> DataFrame:
    """(pk, bytes): for probes every `step` keys from the smallest, the first row at or after the probe, repeats dropped.

    With unique keys that is the first row of each step that has any, so one aggregate does, combined before its shuffle.
    """
    rows = df.where(F.col(key).isNotNull()).select(F.col(key).cast("long").alias("pk"), (row_bytes(df) if size is None else size).alias("bytes"))
    # One row: the bounds.
    low = F.broadcast(rows.agg(F.min("pk").alias("lo"), F.max("pk").alias("hi")))
    step = F.greatest(F.lit(1).cast("long"), F.expr(f"(hi - lo) div {target}"))
    return rows.crossJoin(low).withColumn("_step", step).groupBy(F.expr("(pk - lo) div _step").alias("_s")).agg(F.min("pk").alias("pk"), F.min_by("bytes", "pk").alias("bytes")).drop("_s")


def top_tables(catalog: DataFrame, n: int = 5) -> DataFrame:
    return catalog.orderBy(F.desc_nulls_last("bytes"), "table").limit(n)


def catalog_totals(catalog: DataFrame) -> DataFrame:
    return catalog.agg(F.count("*").alias("n_tables"), F.coalesce(F.sum("bytes"), F.lit(0)).cast("long").alias("bytes"), F.coalesce(F.sum("est_rows"), F.lit(0)).cast("long").alias("est_rows"))


def target_is_populated(catalog: DataFrame) -> DataFrame:
    """How many user tables there are, and whether that is any: done marks count only in a target that has them."""
    mine = user_tables(catalog)
    return mine.agg(F.count("*").alias("n_tables")).withColumn("populated", F.col("n_tables") > 0)


def read_tables(spark: SparkSession, folder: str, names: list[str]) -> dict[str, DataFrame]:
    return {n: spark.read.parquet(f"{folder}/{n}.parquet") for n in names}
