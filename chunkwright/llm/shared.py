"""Small helpers that every operator of this subpackage uses."""

from __future__ import annotations

import ctypes
import gc
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_WORKER: dict = {}


def worker_memory(owner: str) -> dict:
    """What a Python worker keeps between the tasks of one operator. Spark uses workers again, so what another operator kept goes."""
    if _WORKER.get("owner") != owner:
        _WORKER.clear()
        _WORKER["owner"] = owner
        gc.collect()
        try:
            ctypes.CDLL("libc.so.6").malloc_trim(0)
        except (OSError, AttributeError):  # another C library
            pass
    return _WORKER.setdefault("memory", {})


def small_batches(batches: Iterator[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of which Python objects can be made at once."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def ship(spark: SparkSession) -> None:
    """Sends this package to the executors, once for each context, so that Python workers can import it wherever they run."""
    context, package = spark.sparkContext, Path(__file__).resolve().parents[1]
    if getattr(context, "_chunkwright_shipped", False):
        return
    path = Path(tempfile.mkdtemp(prefix="spark-ship-")) / "chunkwright.zip"
    with zipfile.ZipFile(path, "w") as z:
        for f in sorted(package.rglob("*.py")):
            z.write(f, f.relative_to(package.parent))
    context.addPyFile(str(path))
    context._chunkwright_shipped = True


def shared_dir(spark: SparkSession) -> str:
    """The folder that the cluster shares (spark.checkpoint.dir). Where it is unset, which is an error but in local mode, a local one is made and set."""
    kept = spark.conf.get("spark.checkpoint.dir", None)
    if not kept:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that the cluster shares")
        kept = getattr(spark, "_chunkwright_shared", None) or "file://" + tempfile.mkdtemp(prefix="spark-shared-")
        spark._chunkwright_shared = kept
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(kept)
    return kept.rstrip("/")


def written(df: DataFrame, name: str) -> DataFrame:
    """df as a Parquet table in the shared folder, read again: it cuts lineage and survives a lost executor."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def placed(docs: DataFrame, part: str, row: str) -> DataFrame:
    """docs with the number of the file that each row is read from and its place there, null where docs aren't read from files."""
    try:
        number = F.regexp_extract("_metadata.file_name", r"part-(\d+)", 1).cast("int")
        return docs.select(*[F.col(f"`{c}`") for c in docs.columns if c not in (part, row)], number.alias(part), F.col("_metadata.row_index").alias(row))
    except AnalysisException:
        return docs.drop(part, row).withColumns({part: F.lit(None).cast("int"), row: F.lit(None).cast("long")})


def hidden(docs: DataFrame, own: tuple[str, ...]) -> DataFrame:
    """docs with all columns but its own renamed, so that they can't clash with those that an operator adds."""
    return docs.select(*[F.col(f"`{c}`").alias(c if c in own else f"_in_{c}") for c in docs.columns])


def shown(df: DataFrame, docs: DataFrame, own: tuple[str, ...], more: tuple[str, ...] = ()) -> DataFrame:
    """The columns of docs by their names again, and more; a column of docs that is named as one of these gives way."""
    return df.select(*[F.col(f"`{c if c in own else f'_in_{c}'}`").alias(c) for c in docs.columns if c not in more], *more)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def text_bytes(docs: DataFrame) -> int:
    """UTF-8 bytes of all texts, to size partitions by."""
    return docs.select(F.sum(F.octet_length("text"))).first()[0] or 0


def parts_for(docs: DataFrame, bytes_each: int = 16 << 20, least: int = 1) -> int:
    """How many partitions of about bytes_each hold the texts."""
    return max(least, -(-text_bytes(docs) // bytes_each))
