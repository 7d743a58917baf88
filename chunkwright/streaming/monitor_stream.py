"""The same reports on a stream of events. Timestamps must be TIMESTAMP: watermarks don't take TIMESTAMP_NTZ."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

LATE = "10 minutes"


def read_stream(spark: SparkSession, path: str, files_per_batch: int = 64) -> DataFrame:
    """A folder of event files, or one file, as a stream."""
    now = spark.read.parquet(path)
    stream = spark.readStream.schema(now.schema).option("maxFilesPerTrigger", files_per_batch)
    folder, _, name = path.rstrip("/").rpartition("/")
    if all(f.endswith(f"/{name}") for f in now.inputFiles()):  # a stream reads folders
        return stream.option("pathGlobFilter", name).parquet(folder)
    return stream.parquet(path)


def stream_speed(events: DataFrame, size: str = "10 seconds", slide: str = "1 second", late: str = LATE) -> DataFrame:
    """Bytes of each run in sliding windows."""
    rows = events.withWatermark("ts", late).groupBy("run", F.window("ts", size, slide).alias("w")).agg(F.count("*").alias("n_events"), F.sum("bytes").alias("bytes"))
    return rows.select("run", F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "n_events", "bytes")


def stream_sessions(events: DataFrame, gap: str = "60 seconds", late: str = LATE) -> DataFrame:
    """Busy spans of each worker: a silence of the gap ends one."""
    rows = events.withWatermark("ts", late).groupBy("worker", F.session_window("ts", gap).alias("w")).agg(F.count("*").alias("n_events"), F.sum("bytes").alias("bytes"))
    return rows.select("worker", F.col("w.start").alias("session_start"), F.col("w.end").alias("session_end"), "n_events", "bytes")


def stream_silences(events: DataFrame, gap: str = "60 seconds", late: str = LATE) -> DataFrame:
    """For append mode: (worker, silent_since, n_events) of each worker that was silent for the gap, while it still is.

    The state is a worker's open session; its end, a gap behind the last event, is a timer on event time: the row comes as
    soon as the watermark has passed it, whether the worker is heard of again or not. What moves the watermark is the
    others' events. A silence is reported once; an event behind it opens a new session.
    """
    rows = events.withWatermark("ts", late).groupBy("worker", F.session_window("ts", gap).alias("w")).agg(F.max("ts").alias("silent_since"), F.count("*").alias("n_events"))
    return rows.select("worker", "silent_since", "n_events")


def stream_worker_state(events: DataFrame) -> DataFrame:
    """Latest state of each worker; the state kept is one row for each."""
    last = events.groupBy("worker").agg(F.max_by(F.struct("type", "job"), F.struct("ts", "event_id")).alias("e"), F.count("*").alias("n_events"))
    status = F.when(F.col("e.type") == "started", "working").when(F.col("e.type") == "retrying", "retrying").otherwise("idle")
    return last.select("worker", status.alias("status"), F.when(F.col("e.type").isin("started", "retrying"), F.col("e.job")).alias("job"), "n_events")


def batch_sink(path: str, mode: str) -> Callable[[DataFrame, int], None]:
    """For foreachBatch: puts each batch in a folder by its number, so that one which is replayed after a stop replaces what it wrote before. In complete mode a batch holds all, so it replaces every other."""

    def put(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/{'all' if mode == 'complete' else f'_batch={number}'}")

    return put


def batch_rows(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """What batch_sink has written."""
    rows = spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(path)
    return rows.select(*[F.col(f"`{f.name}`") for f in schema.fields])


def drained(stream: DataFrame, folder: str, mode: str = "complete") -> DataFrame:
    """All that is there now, as a table: the last batch of a complete-mode run, or all batches."""
    path = f"{folder}/stream-{uuid.uuid4().hex}"
    query = stream.writeStream.outputMode(mode).option("checkpointLocation", f"{path}/checkpoint").foreachBatch(batch_sink(f"{path}/rows", mode)).trigger(availableNow=True).start()
    query.awaitTermination()
    return batch_rows(stream.sparkSession, f"{path}/rows", stream.schema)
