"""Reports on a run from its events, in batch.

Events have run, worker, job, type (started, completed, skipped, failed, retrying), bytes, ts (timestamp), event_id.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chunkwright.functions.expressions import elapsed, human_size, percent

# Codes and phrases by which failures are told apart.
NETWORK_CODES = ("ECONNREFUSED", "ECONNRESET", "EPIPE", "ETIMEDOUT", "ENOTFOUND", "ENETUNREACH", "EHOSTUNREACH", "ECONNABORTED", "EAI_AGAIN")
STREAM_CODES = ("ERR_STREAM_PREMATURE_CLOSE", "ERR_STREAM_DESTROYED")
SERVER_CLASSES = ("08", "57")
STREAM_PHRASES = ("Connection terminated", "connection lost", "server closed the connection unexpectedly", "timeout expired", "Connection idle timeout", "connect timeout")
TRANSIENT = ("NETWORK", "SERVER", "STREAM")

DONE = ("completed", "skipped")
LONGEST_WAIT, MOST_DOUBLINGS = 60, 5
#: Running sums and gaps are windows inside buckets of that many seconds.
BUCKET_SECONDS = 3600
#: Rows without a time.
LAST_BUCKET = 2**63 - 1


def _class_of(code: str, message: str) -> Column:
    c, m = F.coalesce(F.col(code), F.lit("")), F.coalesce(F.col(message), F.lit(""))
    server = c.startswith(SERVER_CLASSES[0]) | c.startswith(SERVER_CLASSES[1])
    phrase = F.lit(False)
    for p in STREAM_PHRASES:
        phrase = phrase | m.contains(p)
    return F.when(c.isin(*NETWORK_CODES), "NETWORK").when(c.isin(*STREAM_CODES), "STREAM").when(server, "SERVER").when(phrase, "STREAM")


def triage_errors(failures: DataFrame) -> DataFrame:
    """Adds category and transient to rows with code, message, cause_code, cause_message: the error's own class, else its cause's, else UNKNOWN."""
    out = failures.withColumn("category", F.coalesce(_class_of("code", "message"), _class_of("cause_code", "cause_message"), F.lit("UNKNOWN")))
    return out.withColumn("transient", F.col("category").isin(*TRANSIENT))


def retry_schedule(failures: DataFrame, base_seconds: int = 5, jitter: bool = False) -> DataFrame:
    """Adds attempt (from 0 for each run and job), wait_s and due to failures in time order. The wait doubles up to a limit; jitter adds up to a second."""
    by = Window.partitionBy("run", "job").orderBy("ts", "event_id")
    out = failures.withColumn("attempt", F.row_number().over(by).cast("long") - 1)
    out = out.withColumn("wait_s", F.expr(f"cast(least({base_seconds} * shiftleft(1, cast(least(attempt, {MOST_DOUBLINGS}) as int)), {LONGEST_WAIT}) as bigint)"))
    late = F.col("wait_s") + F.rand() if jitter else F.col("wait_s")
    return out.withColumn("due", F.timestamp_micros(F.unix_micros("ts") + (late * 1_000_000).cast("long")))


def outcomes(events: DataFrame) -> DataFrame:
    """How many events of each type a run has."""
    return events.groupBy("run", "type").agg(F.count("*").alias("n"), F.sum("bytes").alias("bytes"))


def outcome_rule(triaged: DataFrame) -> DataFrame:
    """Transient failures are tried again without limit, others fail at once."""
    return triaged.withColumn("outcome", F.when(F.col("transient"), "retrying").otherwise("failed"))


def failed_chunks(events: DataFrame) -> DataFrame:
    """Chunks whose last word is failed, with a label and when."""
    last = events.groupBy("run", "job").agg(F.max_by("type", F.struct("ts", "event_id")).alias("type"), F.max("ts").alias("ts"), F.count_if(F.col("type") == "failed").alias("n_failed"))
    return last.where("type = 'failed'").select("run", "job", F.concat(F.lit("chunk "), F.col("job").cast("string"), F.lit(" of run "), F.col("run").cast("string")).alias("label"), "n_failed", "ts").orderBy("run", "job")


def _state(last: Column) -> Column:
    return F.when(last == "started", "working").when(last == "retrying", "retrying").otherwise("idle")


def worker_state(events: DataFrame, workers: DataFrame | None = None) -> DataFrame:
    """Latest state of each known worker. A retry keeps its job with no progress; whatever comes next ends it."""
    mine = events.join(workers.select("worker").distinct(), "worker", "left_semi") if workers is not None else events
    last = mine.groupBy("worker").agg(F.max_by(F.struct("type", "job", "bytes"), F.struct("ts", "event_id")).alias("e"), F.count("*").alias("n_events"))
    busy = F.col("e.type").isin("started", "retrying")
    return last.select("worker", _state(F.col("e.type")).alias("status"), F.when(busy, F.col("e.job")).alias("job"), F.when(F.col("e.type") == "started", F.col("e.bytes")).otherwise(F.lit(0)).cast("long").alias("progress"), "n_events")


def progress(events: DataFrame, jobs: DataFrame) -> DataFrame:
    """For each run: bytes of done chunks, what working workers have done of theirs (each at most its chunk), and both, at most the total."""
    done = events.groupBy("run").agg(F.coalesce(F.sum(F.when(F.col("type").isin(*DONE), F.col("bytes"))), F.lit(0)).alias("done_bytes"))
    last = events.groupBy("run", "worker").agg(F.max_by(F.struct("type", "job", "bytes"), F.struct("ts", "event_id")).alias("e")).where("e.type = 'started'")
    open_ = last.select("run", F.col("e.job").alias("job"), F.col("e.bytes").alias("_at")).join(jobs.select("job", "est_bytes"), "job").groupBy("run").agg(F.sum(F.least("_at", "est_bytes")).alias("_open"))
    total = F.broadcast(jobs.agg(F.sum("est_bytes").alias("total_bytes")))  # one row
    out = done.join(open_, "run", "left").crossJoin(total).withColumn("open_bytes", F.coalesce("_open", F.lit(0)).cast("long"))
    return out.select("run", "done_bytes", "open_bytes", F.least(F.col("done_bytes") + F.col("open_bytes"), F.col("total_bytes")).alias("effective_bytes"), "total_bytes")


def rolling_speed(samples: DataFrame, total_bytes: int, seconds: int = 10) -> DataFrame:
    """Adds speed (bytes a second over the last `seconds`, at least one) and eta_s to samples (run, ts, event_id, bytes so far), each run on its own.

    A sample stands in its own bucket of that many seconds and, moved on by as many, as history in the next one. Of a window's samples
    those in its own bucket are all that came before, and those in the bucket before all whose moved time is still to come: two running
    minima, one in each direction, so work is a sort of each bucket and doesn't depend on how many samples a window holds.
    """
    micros, span = F.unix_micros("ts"), seconds * 1_000_000
    bucket = F.expr(f"(unix_micros(ts) - pmod(unix_micros(ts), {span}L)) div {span}L")
    places = F.array(F.struct(bucket.alias("_bucket"), micros.alias("_at"), F.lit(False).alias("_past")), F.struct((bucket + 1).alias("_bucket"), (micros + span).alias("_at"), F.lit(True).alias("_past")))
    both = samples.select("*", F.inline(places))
    own = Window.partitionBy("run", "_bucket")
    before, after = [own.orderBy(o).rangeBetween(Window.unboundedPreceding, Window.currentRow) for o in (F.asc("_at"), F.desc("_at"))]
    least = lambda c: F.least(F.min(F.when(~F.col("_past"), c)).over(before), F.min(F.when(F.col("_past"), c)).over(after))
    out = both.withColumn("_first", least(F.col("done_bytes"))).withColumn("_since", F.greatest(F.lit(1_000_000).cast("long"), micros - least(micros)))
    out = out.where(~F.col("_past")).drop("_bucket", "_at", "_past")
    gained, left = F.col("done_bytes") - F.col("_first"), F.lit(total_bytes) - F.col("done_bytes")
    out = out.withColumn("_gained", gained).withColumn("speed", F.expr("(_gained * 1000000L) div _since"))
    need = left.cast("decimal(38,0)") * F.col("_since")
    per = F.greatest(F.col("_gained").cast("decimal(38,0)") * 1_000_000, F.lit(1))
    top = need + per - 1  # whole numbers: Spark rounds a quotient of decimals at its sixth place, so one just above a whole number isn't rounded up by ceil
    eta = F.when((F.col("_gained") > 0) & (left > 0), ((top - top % per) / per).cast("long")).otherwise(F.lit(0).cast("long"))
    return out.withColumn("eta_s", eta).drop("_first", "_since", "_gained")


def samples_of(events: DataFrame, seconds: int = BUCKET_SECONDS) -> DataFrame:
    """Bytes done so far after each event of a run: a sum for each bucket of time, a prefix over a run's buckets, and a window inside the bucket, which begins with a row that carries the prefix.

    Events without a time come last, in a bucket of their own; those without a run are a run. Before the first known bytes there is no sum.
    """
    done = F.when(F.col("type").isin(*DONE), F.col("bytes")).otherwise(F.lit(0).cast("long"))
    rows = events.withColumns({"_bucket": F.coalesce(F.expr(f"unix_seconds(ts) div {seconds}"), F.lit(LAST_BUCKET)), "_done": done, "_carried": F.lit(False)})
    before = Window.partitionBy("run").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = rows.groupBy("run", "_bucket").agg(F.sum("_done").alias("_sum")).select("run", "_bucket", F.sum("_sum").over(before).alias("_done"), F.lit(True).alias("_carried"))
    inside = Window.partitionBy("run", "_bucket").orderBy(F.desc("_carried"), "ts", F.asc_nulls_last("event_id")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    out = rows.unionByName(sums, allowMissingColumns=True).withColumn("done_bytes", F.sum("_done").over(inside))
    return out.where(~F.col("_carried")).select(*events.columns, "done_bytes")


def worker_speed(events: DataFrame, bucket: str = "5 seconds") -> DataFrame:
    """Bytes a second of each worker between the last and this bucket that has events; the worker's first has none."""
    sums = events.groupBy("worker", F.window("ts", bucket).alias("w")).agg(F.sum("bytes").alias("bytes")).select("worker", F.col("w.start").alias("bucket_start"), "bytes")
    before = F.lag("bucket_start").over(Window.partitionBy("worker").orderBy("bucket_start"))
    out = sums.withColumn("_s", F.unix_seconds("bucket_start") - F.unix_seconds(before))
    return out.withColumn("speed", F.when(F.col("_s").isNotNull(), F.expr("bytes div _s"))).drop("_s")


def idle_gaps(events: DataFrame, key: str = "worker", seconds: int = 60, bucket_seconds: int = BUCKET_SECONDS) -> DataFrame:
    """(key, from, to, gap_s) of silences of that long or longer. Windows are inside buckets of time; a bucket's first event looks back to the last one of the bucket before."""
    rows = events.withColumn("_bucket", F.expr(f"unix_seconds(ts) div {bucket_seconds}"))
    ends = rows.groupBy(key, "_bucket").agg(F.max("ts").alias("_end"))
    ends = ends.select(key, "_bucket", F.lag("_end").over(Window.partitionBy(key).orderBy("_bucket")).alias("_was"))
    before = F.lag("ts").over(Window.partitionBy(key, "_bucket").orderBy("ts", "event_id"))
    out = rows.withColumn("_lag", before).join(ends, [key, "_bucket"]).withColumn("gap_from", F.coalesce("_lag", "_was")).withColumn("gap_s", F.unix_seconds("ts") - F.unix_seconds("gap_from"))
    return out.where(F.col("gap_s") >= seconds).select(key, "gap_from", F.col("ts").alias("gap_to"), "gap_s")


def silences(events: DataFrame, key: str = "worker", seconds: int = 60, until: Column | None = None, bucket_seconds: int = BUCKET_SECONDS) -> DataFrame:
    """idle_gaps and, with gap_to null and lasts true, the silences that hadn't ended at the end: the last event of all, or until, a timestamp.

    A key with one event and then nothing has such a silence. gap_s counts to the end. A key's last event comes from an aggregate
    that is combined before its shuffle, and the end is one row.
    """
    closed = idle_gaps(events, key, seconds, bucket_seconds).withColumn("lasts", F.lit(False))
    last = events.groupBy(key).agg(F.max("ts").alias("gap_from"))
    if until is None:
        last = last.crossJoin(F.broadcast(events.agg(F.max("ts").alias("_end"))))  # one row
    else:
        last = last.withColumn("_end", until)
    open_ = last.withColumn("gap_s", F.unix_seconds("_end") - F.unix_seconds("gap_from")).where(F.col("gap_s") >= seconds)
    return closed.unionByName(open_.select(key, "gap_from", F.lit(None).cast("timestamp").alias("gap_to"), "gap_s", F.lit(True).alias("lasts")))


def run_report(events: DataFrame, catalog: DataFrame) -> DataFrame:
    """For each run: tables, succeeded (with skipped), skipped, failed, duration, sizes and percent in words."""
    count = lambda *t: F.count_if(F.col("type").isin(*t))
    runs = events.groupBy("run").agg(
        count("completed", "skipped").alias("succeeded"), count("skipped").alias("skipped"), count("failed").alias("failed"),
        (F.unix_seconds(F.max("ts")) - F.unix_seconds(F.min("ts"))).alias("_s"), F.coalesce(F.sum(F.when(F.col("type").isin(*DONE), F.col("bytes"))), F.lit(0)).alias("done_bytes"),
    )
    total = F.broadcast(catalog.agg(F.count("*").alias("n_tables"), F.sum("bytes").alias("_total")))  # one row
    out = runs.crossJoin(total)
    return out.select("run", "n_tables", "succeeded", "skipped", "failed", elapsed(F.col("_s")).alias("duration"), human_size(F.col("done_bytes")).alias("size"), percent(F.col("done_bytes"), F.col("_total")).alias("percent"))
