"""Loading chunks, and what is checked and recomputed around it."""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chunkwright.operators.chunks import assign_blocks, assign_chunks, plan_of
from chunkwright.operators.ledger import Ledger
from chunkwright.plans.chunk_plan import chunk_places
from chunkwright.sources.chunk_store import ChunkStore, write_counted
from chunkwright.sources.tables import numbered_blocks, scan_view, write_chunks


def select_tables(rows: DataFrame, schema: str | None = None, table: str | None = None) -> DataFrame:
    """Rows of one schema and of one table, named `table` or `schema.table`; more dots are an error."""
    out = rows.where(F.col("schema") == schema) if schema else rows
    if table:
        parts = table.split(".")
        if len(parts) > 2:
            raise ValueError(f"{table!r} isn't table or schema.table")
        out = out.where(F.col("table") == parts[-1])
        out = out.where(F.col("schema") == parts[0]) if len(parts) == 2 else out
    return out


def loadable(jobs: DataFrame) -> DataFrame:
    """Chunks of tables; views are refreshed after the load."""
    return jobs.where(F.col("kind") != "m")


def drop_generated(df: DataFrame, generated: list[str]) -> DataFrame:
    return df.drop(*generated)


def recompute_generated(df: DataFrame, expressions: dict[str, Column]) -> DataFrame:
    return df.withColumns(expressions)


def check_generated(df: DataFrame, expressions: dict[str, Column]) -> DataFrame:
    """For each generated column: rows, nulls, and values that differ from their expression."""
    sums = [x for c, e in expressions.items() for x in (F.count_if(F.col(c).isNull()).alias(f"n_{c}"), F.count_if(~F.col(c).eqNullSafe(e)).alias(f"d_{c}"))]
    one = df.agg(F.count("*").alias("n_rows"), *sums)
    rows = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"n_{c}").alias("n_null"), F.col(f"d_{c}").alias("n_different")) for c in expressions])
    return one.select("n_rows", F.inline(rows)).select("column", "n_rows", "n_null", "n_different")


#: Tables whose jobs run side by side.
WORKERS = 4
#: Bytes of text of a chunk that a task gathers to write it, by the plan's estimate.
PIECE = 1 << 26


def side_by_side(do: Callable[[str], list], names: list, workers: int) -> list:
    """What do returns for each name, in order; Spark's jobs are begun from so many threads. All end before the first error is raised."""
    with ThreadPoolExecutor(max(1, workers)) as pool:
        return [f.result() for f in [pool.submit(do, n) for n in names]]


@dataclass
class Source:
    """A table to export: its rows as read, so that files can be asked for; the columns to take; its key, for plans of key ranges."""

    df: DataFrame
    columns: list[str] | None = None
    key: str | None = None
    rows_per_block: int | None = None


def route_rows(source: Source, plan: DataFrame, strategy: str) -> DataFrame:
    """The columns of a table with chunk_id, by the strategy of its plan: one chunk, key ranges (with _piece of a chunk), or blocks of its files."""
    columns = source.columns or source.df.columns
    if strategy == "single":
        return source.df.select(*columns, F.lit(0).cast("long").alias("chunk_id"))
    if strategy == "key_range" and source.key:
        return assign_chunks(source.df.select(*columns), source.key, plan, piece_bytes=PIECE).select(*columns, "chunk_id", "_piece")
    if strategy == "block_range" and source.rows_per_block:
        return assign_blocks(numbered_blocks(source.df, source.rows_per_block), plan).select(*columns, "chunk_id")
    raise ValueError(f"{strategy!r} can't place rows: it takes a key for key_range, rows_per_block for block_range")


def export_all(sources: dict[str, Source], plan: DataFrame, root: str, codec: str | None = None, workers: int = WORKERS) -> DataFrame:
    """Writes the tables of a plan, each by its own strategy, and returns the plan with file, status, n_rows and n_bytes.

    sources are by `schema.table`. Rows and bytes are counted by the writes themselves. A chunk without rows has no file, 0 rows and
    the status of any other. All rows of a source get a chunk, or the export fails. Chunks are replaced one by one, so a
    run may be repeated. Jobs of several tables run side by side, so that small ones don't wait for each other's last task. The
    result has a row for each chunk of a threshold of bytes.
    """
    spark, plan = plan.sparkSession, chunk_places(plan)
    chunks = plan.select("schema", "table", "strategy", "idx", "file").collect()  # a plan is small
    if len({c.file for c in chunks}) < len(chunks):
        raise ValueError("two chunks of the plan have one place: names of tables differ only by characters that paths can't hold")
    tables = {}
    for c in chunks:
        tables.setdefault(f"{c.schema}.{c.table}", []).append(c)
    for name, mine in tables.items():
        strategies = sorted({c.strategy for c in mine})
        if name not in sources or len(strategies) > 1:
            raise ValueError(f"{name} has no source" if name not in sources else f"{name} has chunks of {strategies}")

    def written(name: str) -> list[tuple]:
        mine = tables[name]
        rows = route_rows(sources[name], plan_of(plan, name), mine[0].strategy)
        counts, sizes = write_counted(rows, f"{root}/{mine[0].file.rpartition('/')[0]}", len(mine), codec, overwrite=True, gather=mine[0].strategy == "key_range")
        return [(c.file, counts.get(c.idx, 0), sizes.get(c.idx, 0)) for c in mine]

    facts = [f for own in side_by_side(written, sorted(tables), workers) for f in own]
    known = spark.createDataFrame(facts, "file string, n_rows long, n_bytes long")
    return plan.join(known, "file").withColumn("status", F.lit("exported"))


def export_tables(found: dict[str, DataFrame], keys: dict[str, str], plan: DataFrame, root: str, codec: str | None = None) -> None:
    """Writes the tables of a plan of key ranges, each chunk to the folder that chunk_folder names. A chunk without a range is an error; see export_all."""
    for name, df in found.items():
        rows = assign_chunks(df, keys[name], plan, name, PIECE).withColumn("chunk_table", F.lit(name))
        write_chunks(rows, f"{root}/data", codec, ("chunk_table", "chunk_id"))


def load_chunks(spark: SparkSession, jobs: DataFrame, root: str, columns: dict[str, list[str]], target: str, marks: Ledger, mark: bool = True, by_schema: bool = False, workers: int = WORKERS) -> None:
    """Loads the chunks of a manifest's jobs (schema, table, idx, file, chunk_key) that their targets don't have, then marks them.

    A table's target is a ChunkStore in `target/table`, or in `target/schema.table` with by_schema. What is loaded is what
    its log says, whatever the ledger does: a run may stop anywhere and loads each chunk once, and a load
    under another plan replaces the rows of the first one when it is complete. Jobs with plan and n_chunks, as plan_jobs has them,
    are complete with n_chunks chunks; without, with all jobs given here.

    Fails with the whole list if files are missing; a chunk whose n_rows is 0 has none. columns are by table, or by schema.table.
    """
    chunks = jobs.select("schema", "table", "idx", "file", "chunk_key", *[F.col(c) if c in jobs.columns else F.lit(None).alias(c) for c in ("plan", "n_chunks", "n_rows")]).collect()  # a row for each chunk
    names = sorted({(c.schema, c.table) for c in chunks})
    if not by_schema and len({t for _, t in names}) < len(names):
        raise ValueError("tables of several schemas have one name: load them by schema")
    todo, stores, plans = {}, {}, {}

    def left_of(name: tuple[str, str]) -> None:
        schema, table = name
        mine = [c for c in chunks if (c.schema, c.table) == (schema, table)]
        own = hashlib.sha256("\n".join(sorted(c.chunk_key for c in mine)).encode()).hexdigest()
        plans[schema, table] = (str(mine[0].plan or own), int(mine[0].n_chunks or len(mine)))
        stores[schema, table] = ChunkStore(spark, f"{target}/{schema}.{table}" if by_schema else f"{target}/{table}")
        held = stores[schema, table].state(f"{schema}.{table}").held.get(plans[schema, table][0], {})
        todo[schema, table] = [c for c in mine if c.chunk_key not in held]

    side_by_side(left_of, names, workers)
    left = [c.file for own in todo.values() for c in own if c.n_rows is None or c.n_rows > 0]
    if left:
        lost = missing_chunks(spark.createDataFrame([(f,) for f in left], "file string"), list_chunks(spark, root)).orderBy("file").select("file").collect()
        if lost:
            raise FileNotFoundError(f"{len(lost)} chunks are missing: " + ", ".join(r[0] for r in lost))

    def loaded(name: tuple[str, str]) -> None:
        schema, table = name
        wanted = columns.get(f"{schema}.{table}") or columns[table]
        rows = _read_chunks(spark, [f"{root}/{c.file}" for c in todo[name] if c.n_rows is None or c.n_rows > 0], wanted)
        stores[name].write(rows, {c.chunk_key: c.idx for c in todo[name]}, f"{schema}.{table}", *plans[name])

    side_by_side(loaded, [n for n in names if todo[n]], workers)
    if chunks and mark:
        marks.mark(jobs.select("chunk_key"))


def _read_chunks(spark: SparkSession, folders: list[str], columns: list[str]) -> DataFrame | None:
    """The rows of chunk folders with the number that each folder's name ends with."""
    if not folders:
        return None
    rows = spark.read.option("recursiveFileLookup", "true").parquet(*sorted(folders))
    number = F.regexp_extract(F.col("_metadata.file_path"), r"/chunk_id=(\d+)/[^/]*$", 1).cast("long")
    return rows.select(*columns, number.alias("chunk_id"))


def load_table(rows: DataFrame, table: str, columns: list[str] | None = None) -> None:
    """Appends rows to a table of the catalog by a list of columns; the table's others are null or their defaults, and its order of columns is its own."""
    spark = rows.sparkSession
    spark.sql(f"INSERT INTO {table} ({', '.join(f'`{c}`' for c in columns or rows.columns)}) SELECT {', '.join(f'`{c}`' for c in columns or rows.columns)} FROM {{rows}}", rows=rows)


def clean_target(spark: SparkSession, tables: list[str] = (), schemas: list[str] = (), data_only: bool = False) -> None:
    """Empties tables, or drops and makes whole schemas. Both with data_only would clean nothing, so that is an error."""
    if data_only and schemas:
        raise ValueError("a data-only load can't replace schemas")
    for name in tables:
        spark.sql(f"TRUNCATE TABLE {name}")
    for name in schemas:
        spark.sql(f"DROP SCHEMA IF EXISTS {name} CASCADE")
        spark.sql(f"CREATE SCHEMA {name}")


def refresh_view(spark: SparkSession, query: str, target: str, **tables: DataFrame) -> DataFrame:
    """Runs a view's query again and replaces its stored rows."""
    scan_view(spark, query, **tables).write.mode("overwrite").parquet(target)
    return spark.read.parquet(target)


def refresh_views(spark: SparkSession, views: list[tuple[str, str]], **tables: DataFrame) -> DataFrame:
    """(target, ok, error) of each, in the caller's order; a failure doesn't stop the rest."""
    out = []
    for query, target in views:
        try:
            refresh_view(spark, query, target, **tables)
            out.append((target, True, None))
        except Exception as e:  # the report has it
            out.append((target, False, str(e)[:500]))
    return spark.createDataFrame(out, "target string, ok boolean, error string")


def reset_sequences(state: DataFrame, schema: str | None = None) -> DataFrame:
    """Next value of each sequence; other schemas are skipped; ok is false where there is no value to go on from."""
    mine = state.where(F.col("schema") == schema) if schema else state
    return mine.select("schema", "table", (F.col("last_value") + F.col("is_called").cast("int")).alias("next_value"), F.col("last_value").isNotNull().alias("ok"))


def check_keys(df: DataFrame, key: list[str]) -> DataFrame:
    """Keys that occur more than once."""
    return df.groupBy(*key).agg(F.count("*").alias("n_rows")).where("n_rows > 1")


def check_orphans(child: DataFrame, parent: DataFrame, on: dict[str, str]) -> DataFrame:
    """Rows of child without a row of parent; a null doesn't refer to anything. The parent side is its distinct keys."""
    keys = parent.select(*[F.col(p).alias(c) for c, p in on.items()]).distinct()
    return child.where(" and ".join(f"`{c}` is not null" for c in on)).join(keys, list(on), "left_anti")


def missing_chunks(jobs: DataFrame, files: DataFrame) -> DataFrame:
    """Jobs whose file isn't among files: all of them, so that a load can fail with the whole list. A job that is known to have no rows has no file."""
    jobs = jobs.where("n_rows is null or n_rows > 0") if "n_rows" in jobs.columns else jobs
    return jobs.join(files.select("file").distinct(), "file", "left_anti")


def list_chunks(spark: SparkSession, path: str) -> DataFrame:
    """(file, chunk_id) of the chunk folders that hold files, as the manifest names them, without reading content."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(path)
    folder = F.regexp_extract("path", r"((data/[^/]+/)?chunk_id=\d+)/[^/]+$", 1)
    return found.select(folder.alias("file"), F.regexp_extract("path", r"/chunk_id=(\d+)/", 1).cast("long").alias("chunk_id")).distinct()


def redo_chunks(df: DataFrame, failed: DataFrame, path: str, codec: str | None = None) -> None:
    """Writes the failed chunks again in place of what is left of them. df has chunk_id; failed is a few rows of a plan."""
    write_chunks(df.join(failed.select("chunk_id").distinct(), "chunk_id", "left_semi"), path, codec)
