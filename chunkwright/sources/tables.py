"""Scans, pinned inputs and chunked output."""

from __future__ import annotations

from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

CODECS = ("zstd", "lz4")


def codec_or_default(codec: str | None) -> str:
    return codec if codec in CODECS else "zstd"


def scan_table(spark: SparkSession, source: str, columns: list[str] | None = None) -> DataFrame:
    """A Parquet table, with only the columns asked for in its scan."""
    df = spark.read.parquet(source)
    return df.select(*columns) if columns else df


def scan_view(spark: SparkSession, query: str, **tables: DataFrame) -> DataFrame:
    """The rows of a view's query; tables are the frames that it names in braces."""
    return spark.sql(query, **tables)


def in_key_range(key: str, first: int, last: int, idx: int = 1) -> Column:
    """Both ends included; chunk 0 also has the rows without a key."""
    inside = F.col(key).between(first, last)
    return inside | F.col(key).isNull() if idx == 0 else inside


def scan_key_range(df: DataFrame, key: str, first: int, last: int, idx: int = 1) -> DataFrame:
    return df.where(in_key_range(key, first, last, idx))


def block_index(pinned: DataFrame, table: str, rows_per_block: int) -> DataFrame:
    """(file, n_rows, first_block, n_blocks) of a pinned table's files by name: blocks are counted through them and begin anew at each.

    Rows of a file come from its footer, where pin_snapshot took them. There is a row for each file, as in any scan's list.
    """
    files = pinned.where(F.col("table") == table).select("file", "n_rows", F.expr(f"(n_rows + {rows_per_block} - 1) div {rows_per_block}").alias("n_blocks"))
    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    return files.withColumn("first_block", F.coalesce(F.sum("n_blocks").over(before), F.lit(0))).select("file", "n_rows", "first_block", "n_blocks")


def _numbered(rows: DataFrame, index: DataFrame, rows_per_block: int) -> DataFrame:
    """rows of files as read, with block. The index, a row for each file, is broadcast: a shuffle by file would bring a file's rows to one task."""
    named = rows.select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_row"))
    starts = index.select(F.col("file").alias("_of"), F.col("first_block").alias("_first"))
    return named.join(F.broadcast(starts), F.col("_file") == F.col("_of")).withColumn("block", F.col("_first") + F.expr(f"_row div {rows_per_block}")).drop("_file", "_of", "_row", "_first")


def numbered_blocks(rows: DataFrame, rows_per_block: int) -> DataFrame:
    """rows as read from files, with block, counted through the files by name. Files are opened for their footers first."""
    files = rows.select(F.col("_metadata.file_path").alias("file")).groupBy("file").agg(F.count("*").alias("n_rows")).select(F.lit("t").alias("table"), "file", "n_rows")
    return _numbered(rows, block_index(files, "t", rows_per_block), rows_per_block)


def with_blocks(spark: SparkSession, source: str, rows_per_block: int) -> DataFrame:
    """A Parquet table with its block numbers."""
    return numbered_blocks(spark.read.parquet(source), rows_per_block)


def scan_blocks(spark: SparkSession, index: DataFrame, rows_per_block: int, start: int, end: int | None = None) -> DataFrame:
    """Blocks start to end (not included; open without) with block, read from the files that hold any of them and no others."""
    inside = F.col("first_block") + F.col("n_blocks") > start
    mine = index.where(inside if end is None else inside & (F.col("first_block") < end))
    files = mine.orderBy("file").collect()  # at most the files of one chunk
    if not files:
        return scan_block_range(_numbered(spark.read.parquet(index.first().file), index, rows_per_block), start, end).limit(0)
    known = spark.createDataFrame(files, index.schema)
    return scan_block_range(_numbered(spark.read.parquet(*[f.file for f in files]), known, rows_per_block), start, end)


def scan_block_range(df: DataFrame, start: int, end: int | None = None) -> DataFrame:
    """Blocks start to end, end not included; open without end."""
    return df.where(F.col("block") >= start if end is None else (F.col("block") >= start) & (F.col("block") < end))


def chunk_predicates(plan: DataFrame, key: str) -> list[str]:
    """A WHERE clause for each key range of a table's plan. A plan is small: a row for each chunk of a threshold of bytes."""
    rows = plan.orderBy("idx").select("idx", "range_start", "range_end").collect()
    return [f"({key} >= {r[1]} AND {key} <= {r[2]}" + (f" OR {key} IS NULL)" if r[0] == 0 else ")") for r in rows]


def read_chunked_jdbc(spark: SparkSession, url: str, table: str, plan: DataFrame, key: str, **properties: str) -> DataFrame:
    """A JDBC table with one partition for each chunk of the plan."""
    return spark.read.jdbc(url, table, predicates=chunk_predicates(plan, key), properties=properties)


def gathered(df: DataFrame, by: tuple[str, ...]) -> DataFrame:
    """Rows of a chunk shuffled together, or those of each _piece of it where df has that column, which goes.

    Adaptive execution deals what is larger than the advisory size of a partition to several tasks, but doesn't cut what one task of
    the scan has for it: pieces do, so that a table read by one task (a file in one row group) isn't gathered by one for each chunk.
    """
    return df.hint("rebalance", *by, *[c for c in df.columns if c == "_piece"]).drop("_piece")


def write_chunks(df: DataFrame, path: str, codec: str | None = None, by: tuple[str, ...] = ("chunk_id",)) -> None:
    """One folder for each chunk, compressed; a file, or several where a chunk is larger than the advisory size of a partition. Chunks that are in df replace those of an earlier run, others stay."""
    out = gathered(df, by).write.mode("overwrite").partitionBy(*by).option("partitionOverwriteMode", "dynamic")
    out.option("compression", codec_or_default(codec)).parquet(path)


def kept(df: DataFrame, path: str) -> DataFrame:
    """df written and read again, so that it is worked out once."""
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def path_exists(spark: SparkSession, path: str) -> bool:
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(at)


def delete_path(spark: SparkSession, path: str) -> None:
    """Deletes a folder in whatever store it is."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def pin_snapshot(spark: SparkSession, sources: dict[str, str]) -> DataFrame:
    """(table, file, bytes, modified, n_rows) of the files that make up each table. Write it to keep it: the frame itself lists them anew.

    The scan asks for no column of data, so files are opened for their footers only.
    """
    parts = []
    for name, path in sources.items():
        meta = spark.read.parquet(path).select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("bytes"), F.col("_metadata.file_modification_time").alias("modified"))
        parts.append(meta.groupBy("file", "bytes", "modified").agg(F.count("*").alias("n_rows")).select(F.lit(name).alias("table"), "*"))
    return reduce(DataFrame.unionByName, parts)


def read_pinned(spark: SparkSession, pinned: DataFrame, table: str) -> DataFrame:
    """The pinned files of a table, whatever came later. The list of files is what any scan holds on the driver."""
    files = [r[0] for r in pinned.where(F.col("table") == table).select("file").orderBy("file").collect()]
    return spark.read.parquet(*files)


def read_or_degrade(spark: SparkSession, pinned: DataFrame, table: str, source: str) -> DataFrame:
    """The pinned files of a table while all are as they were, else the files that are there now; snapshot_lost in each row says which.

    Whether files changed is seen when this is called: size and time of the last change of each, from the store's list.
    """
    mine = pinned.where(F.col("table") == table)
    try:
        now = spark.read.parquet(source).select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("bytes"), F.col("_metadata.file_modification_time").alias("modified")).distinct()
        lost = not mine.join(now, ["file", "bytes", "modified"], "left_anti").isEmpty()
    except AnalysisException:  # nothing is left to read
        lost = True
    rows = spark.read.parquet(source) if lost else read_pinned(spark, pinned, table)
    return rows.withColumn("snapshot_lost", F.lit(lost))


def snapshot_lost(pinned: DataFrame, current: DataFrame) -> DataFrame:
    """For each table how many pinned files are gone or changed, and whether any is: reads are unpinned from then on."""
    gone = pinned.join(current.select("table", "file", "bytes", "modified"), ["table", "file", "bytes", "modified"], "left_anti").groupBy("table").agg(F.count("*").alias("_n"))
    out = pinned.groupBy("table").agg(F.count("*").alias("n_files")).join(gone, "table", "left").withColumn("n_lost", F.coalesce("_n", F.lit(0).cast("long")))
    return out.select("table", "n_files", "n_lost", (F.col("n_lost") > 0).alias("snapshot_lost"))
