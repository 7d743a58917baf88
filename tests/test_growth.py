"""What keeps work and the largest task from growing faster than the input, on small inputs."""

import random
from contextlib import contextmanager
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from chunkwright.operators import chunks, ledger, load, monitor
from chunkwright.sources import chunk_store, tables

PLAN = "schema string, table string, strategy string, idx long, range_start long, range_end long, block_start long, block_end long, est_bytes long, est_rows long"


@contextmanager
def settings(spark, wanted):
    before = {k: spark.conf.get(k, None) for k in wanted}
    try:
        for k, v in wanted.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_windows_of_speed_are_running_minima(spark):
    """By brute force, with ties, times before 1970 and byte counts that fall; no frame is as long as its window."""
    draw, t0 = random.Random(3), datetime(1970, 1, 1)
    rows = [(i, draw.randrange(2), t0 + timedelta(milliseconds=500 * draw.randrange(-90, 90)), draw.randrange(10_000)) for i in range(400)]
    out = monitor.rolling_speed(spark.createDataFrame(rows, "event_id long, run int, ts timestamp, done_bytes long"), 9_000)
    got = {r.event_id: (r.done_bytes, r.speed, r.eta_s) for r in out.collect()}
    want = {}
    for i, run, ts, n in rows:
        inside = [(t, m) for _, r, t, m in rows if r == run and ts - timedelta(seconds=10) <= t <= ts]
        gained, since = n - min(m for _, m in inside), max(1_000_000, (ts - min(inside)[0]) // timedelta(microseconds=1))
        want[i] = (n, gained * 1_000_000 // since, max(0, -((n - 9_000) * since // (gained * 1_000_000))) if gained else 0)
    assert len(got) == len(rows) and got == want
    frames = out._jdf.queryExecution().analyzed().toString().split("specifiedwindowframe(")[1:]
    assert frames and all(f.startswith("RangeFrame, unboundedpreceding$(), currentrow$())") for f in frames)


def test_rows_find_their_block_chunk_without_a_shuffle(spark, tmp_path):
    """The last chunk of blocks is open and takes most rows; nor may all rows of a file go to one task."""
    spark.range(5000).select(F.col("id").alias("k")).coalesce(1).write.parquet(f"{tmp_path}/in")
    plan = spark.createDataFrame([("s", "t", "block_range", i, None, None, 4 * i, None if i == 2 else 4 * i + 4, 1, 1) for i in range(3)], PLAN).localCheckpoint()
    with settings(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1"}):
        rows = chunks.assign_blocks(tables.numbered_blocks(spark.read.parquet(f"{tmp_path}/in"), 10), plan)
        assert {r.chunk_id: r["count"] for r in rows.groupBy("chunk_id").count().collect()} == {0: 40, 1: 40, 2: 4920}
        assert "SortMergeJoin" not in (made := rows._jdf.queryExecution().executedPlan().toString()) and "ShuffledHashJoin" not in made


def test_a_large_chunk_is_dealt_to_several_tasks(spark, tmp_path):
    """One of three chunks has nearly all rows, from four files; small ones stay one file."""
    spark.range(40_000).select(F.col("id").alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("v")).repartition(4).write.parquet(f"{tmp_path}/in")
    rows = spark.read.parquet(f"{tmp_path}/in").withColumn("chunk_id", F.when(F.col("k") < 20, F.col("k") % 2).otherwise(7).cast("long"))
    with settings(spark, {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "256k", "spark.sql.files.openCostInBytes": "128m"}):
        counts, sizes = chunk_store.write_counted(rows, f"{tmp_path}/counted", 3, gather=True)
        tables.write_chunks(rows, f"{tmp_path}/written")
    assert counts == {0: 10, 1: 10, 7: 39_980} and sizes.keys() == counts.keys()
    for out in ("counted", "written"):
        files = spark.read.parquet(f"{tmp_path}/{out}").groupBy("chunk_id", F.input_file_name().alias("file")).count()
        n = {r.chunk_id: (r.files, r.rows) for r in files.groupBy("chunk_id").agg(F.count("*").alias("files"), F.sum("count").alias("rows")).collect()}
        assert n[7][0] > 2 and n == {0: (1, 10), 1: (1, 10), 7: (n[7][0], 39_980)}


def test_a_table_in_two_wide_chunks_travels(spark, tmp_path):
    """Half a table in each chunk: written by several tasks, no row lost or doubled by export, load and a load again."""
    spark.range(40_000).select(F.col("id").alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("v")).repartition(4).write.parquet(f"{tmp_path}/in")
    rows = spark.read.parquet(f"{tmp_path}/in")
    plan = spark.createDataFrame([("s", "t", "key_range", i, a, a + 19_999, None, None, 1, 1) for i, a in enumerate((0, 20_000))], PLAN)
    marks = ledger.Ledger(spark, f"{tmp_path}/ledger")
    marks.create()
    with settings(spark, {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "256k", "spark.sql.files.openCostInBytes": "128m"}):
        done = tables.kept(load.export_all({"s.t": load.Source(rows, None, "k")}, plan, f"{tmp_path}/out"), f"{tmp_path}/done")
    assert {r.idx: r.n_rows for r in done.collect()} == {0: 20_000, 1: 20_000}
    assert all(len(spark.read.parquet(f"{tmp_path}/out/{r.file}").inputFiles()) > 1 for r in done.collect())
    for _ in range(2):
        load.load_chunks(spark, done.withColumn("chunk_key", ledger.chunk_key("r")), f"{tmp_path}/out", {"t": ["k", "v"]}, f"{tmp_path}/target", marks)
        back = chunk_store.ChunkStore(spark, f"{tmp_path}/target/t").read(rows.schema)
        assert back.count() == 40_000 and rows.exceptAll(back.drop("chunk_id")).isEmpty()


def test_a_chunk_read_by_one_task_is_gathered_in_pieces(spark, tmp_path, monkeypatch):
    """A table in one row group: what its one task has for a chunk isn't gathered by one task, and no row is lost or doubled."""
    spark.range(40_000).select(F.when(F.col("id") % 9 > 0, F.col("id")).alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("v")).coalesce(1).write.parquet(f"{tmp_path}/in")
    rows = spark.read.parquet(f"{tmp_path}/in")
    plan = spark.createDataFrame([("s", "t", "key_range", i, a, b, None, None, n, 1) for i, a, b, n in ((0, 0, 19_999, 1_400_000), (1, 20_000, 39_979, 1_400_000), (2, 39_980, 39_999, None))], PLAN)
    monkeypatch.setattr(load, "PIECE", 1 << 16, raising=False)
    with settings(spark, {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k", "spark.sql.adaptive.coalescePartitions.minPartitionSize": "16k", "spark.sql.shuffle.partitions": "16"}):
        done = {r.idx: r for r in load.export_all({"s.t": load.Source(rows, None, "k")}, plan, f"{tmp_path}/out").collect()}
        load.export_tables({"t": rows}, {"t": "k"}, plan, f"{tmp_path}/plain")
    assert done[2].n_rows == 18 and sum(r.n_rows for r in done.values()) == 40_000
    for out, place in ((f"{tmp_path}/out/data/s.t", done[2].file.rpartition("/")[2]), (f"{tmp_path}/plain/data/chunk_table=t", "chunk_id=2")):
        back = spark.read.parquet(out)
        assert sorted(back.columns) == ["chunk_id", "k", "v"] and back.select("k", "v").exceptAll(rows).isEmpty() and back.count() == 40_000
        assert len(spark.read.parquet(f"{out}/{place}").inputFiles()) == 1
        most = back.where("k is not null").groupBy("chunk_id", F.input_file_name()).count().groupBy("chunk_id").agg(F.max("count").alias("n"))
        assert max(r.n for r in most.collect()) < 6_000
