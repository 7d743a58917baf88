"""Exports and loads that stop, repeat, change their plan or meet gaps; differences, silences and sinks on small inputs."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from chunkwright.functions import expressions as ex
from chunkwright.operators import chunks, ledger, load, monitor, profile, reconcile
from chunkwright.plans import chunk_plan as plans
from chunkwright.sources import chunk_store, jdbc_target, manifest, tables
from chunkwright.streaming import monitor_stream

PLAN = "schema string, table string, strategy string, idx long, range_start long, range_end long, block_start long, block_end long, est_bytes long, est_rows long"


def ranges(spark, *starts, schema="s", table="t"):
    ends = [*(s - 1 for s in starts[1:]), starts[-1] + 10**6]
    return spark.createDataFrame([(schema, table, "key_range", i, a, b, None, None, 1, 1) for i, (a, b) in enumerate(zip(starts, ends, strict=True))], PLAN)


def jobs_of(spark, exported, root, run):
    names = exported.select("schema", "table").distinct().collect()
    catalog = spark.createDataFrame([(*n, "r", 1, 1) for n in names], "schema string, table string, kind string, bytes long, est_rows long")
    none = spark.createDataFrame([], "schema string, table string, last_value long, is_called boolean")
    manifest.write_manifest(exported, catalog, none, run, f"{root}/manifest-{run}")
    return plans.plan_jobs(manifest.read_manifest(spark, f"{root}/manifest-{run}")).withColumn("chunk_key", ledger.chunk_key(run))


def marks_in(spark, root):
    marks = ledger.Ledger(spark, f"{root}/ledger")
    marks.create()
    return marks


def test_another_plan_replaces_the_first(spark, tmp_path):
    rows = spark.range(1000).select(F.col("id").alias("k"))
    marks, target = marks_in(spark, tmp_path), f"{tmp_path}/target"
    for run, starts in (("a", range(0, 1000, 200)), ("b", (0, 500))):
        done = load.export_all({"s.t": load.Source(rows, None, "k")}, ranges(spark, *starts), f"{tmp_path}/{run}")
        load.load_chunks(spark, jobs_of(spark, done, tmp_path, run), f"{tmp_path}/{run}", {"t": ["k"]}, target, marks)
        store = chunk_store.ChunkStore(spark, f"{target}/t")
        assert store.read("k long").count() == 1000 == store.read("k long").select("k").distinct().count()
        assert spark.read.parquet(f"{target}/t").count() == 1000  # who doesn't know of the log sees the same
        assert store.chunks().count() == len(list(starts))
    # Back to the first plan: the ledger has its marks, but the target hasn't its chunks.
    load.load_chunks(spark, plans.plan_jobs(manifest.read_manifest(spark, f"{tmp_path}/manifest-a")).withColumn("chunk_key", ledger.chunk_key("a")), f"{tmp_path}/a", {"t": ["k"]}, target, marks)
    assert store.read("k long").count() == 1000 and store.chunks().count() == 5


def test_a_stop_at_every_step_leaves_old_or_new(spark, tmp_path, monkeypatch):
    rows, marks, target = spark.range(100).select(F.col("id").alias("k")), marks_in(spark, tmp_path), f"{tmp_path}/target"
    store = chunk_store.ChunkStore(spark, f"{target}/t")
    seen = lambda: sorted((r.k, r.chunk_id) for r in store.read("k long").collect())
    exports = {}
    for run, starts in (("a", (0, 30, 60)), ("b", (0, 50))):
        done = load.export_all({"s.t": load.Source(rows, None, "k")}, ranges(spark, *starts), f"{tmp_path}/{run}")
        exports[run] = jobs_of(spark, done, tmp_path, run)
    go = lambda run, jobs: load.load_chunks(spark, jobs, f"{tmp_path}/{run}", {"t": ["k"]}, target, marks)
    go("a", exports["a"])
    old = seen()
    assert old == [(k, min(k // 30, 2)) for k in range(100)]
    new = [(k, k // 50) for k in range(100)]
    go("b", exports["b"].where("idx = 1"))
    assert seen() == old

    def stops(*_, **__):
        raise RuntimeError("stopped")

    for name in ("_append", "sweep"):  # behind the data, and behind the log
        with monkeypatch.context() as m:
            m.setattr(chunk_store.ChunkStore, name, stops)
            with pytest.raises(RuntimeError):
                go("b", exports["b"])
        assert seen() == (old if name == "_append" else new)
    with monkeypatch.context() as m:
        m.setattr(ledger.Ledger, "mark", stops)
        with pytest.raises(RuntimeError):
            go("b", exports["b"])
    go("b", exports["b"])
    assert seen() == new and ledger.pending(exports["b"], marks.done()).isEmpty()


def test_empty_ranges_load(spark, tmp_path):
    rows = spark.range(1, 101).unionAll(spark.range(100_001, 100_101)).select(F.col("id").alias("k"))
    done = load.export_all({"s.t": load.Source(rows, None, "k")}, ranges(spark, *range(1, 100_101, 20_000)), str(tmp_path))
    jobs, marks = jobs_of(spark, done, tmp_path, "r"), marks_in(spark, tmp_path)
    assert {r.idx: (r.n_rows, r.n_bytes > 0) for r in jobs.collect()} == {0: (100, True), 5: (100, True)} | {i: (0, False) for i in range(1, 5)}
    assert load.missing_chunks(jobs, load.list_chunks(spark, f"{tmp_path}/data")).isEmpty()
    load.load_chunks(spark, jobs, str(tmp_path), {"t": ["k"]}, f"{tmp_path}/target", marks)
    assert chunk_store.ChunkStore(spark, f"{tmp_path}/target/t").read("k long").count() == 200 and marks.done().count() == 6
    tables.delete_path(spark, f"{tmp_path}/data/s.t/chunk_id=5")
    with pytest.raises(FileNotFoundError, match="1 chunks.*chunk_id=5"):
        load.load_chunks(spark, jobs, str(tmp_path), {"t": ["k"]}, f"{tmp_path}/other", marks)


def test_an_empty_table_travels(spark, tmp_path):
    plan = spark.createDataFrame([("s", "t", "single", 0, None, None, None, None, 0, 0)], PLAN)
    done = load.export_all({"s.t": load.Source(spark.range(0))}, plan, str(tmp_path))
    load.load_chunks(spark, jobs_of(spark, done, tmp_path, "r"), str(tmp_path), {"t": ["id"]}, f"{tmp_path}/target", marks_in(spark, tmp_path))
    store = chunk_store.ChunkStore(spark, f"{tmp_path}/target/t")
    assert store.read("id long").columns == ["id", "chunk_id"] and store.read("id long").isEmpty() and [r.n_rows for r in store.chunks().collect()] == [0]


def test_each_strategy_places_all_rows(spark, tmp_path):
    spark.range(500).select(F.col("id").alias("k")).repartition(3).write.parquet(f"{tmp_path}/in")
    rows = spark.read.parquet(f"{tmp_path}/in")
    blocks = spark.createDataFrame([("s", "b", "block_range", i, None, None, 4 * i, None if i == 2 else 4 * i + 4, 1, 1) for i in range(3)], PLAN)
    single = spark.createDataFrame([("s", "o", "single", 0, None, None, None, None, 1, 1)], PLAN)
    plan = blocks.unionByName(single).unionByName(ranges(spark, 0, 100, 400, table="k"))
    sources = {f"s.{n}": load.Source(rows, ["k"], "k", 40) for n in "bok"}
    done = {(r.table, r.idx): r.n_rows for r in load.export_all(sources, plan, f"{tmp_path}/out").collect()}
    assert {n: sum(v for (t, _), v in done.items() if t == n) for n in "bok"} == dict.fromkeys("bok", 500)
    assert [done["k", i] for i in range(3)] == [100, 300, 100] and len([1 for t, _ in done if t == "b"]) == 3
    with pytest.raises(ValueError, match="no source"):
        load.export_all({}, plan, f"{tmp_path}/none")
    with pytest.raises(ValueError, match="can't place"):
        load.export_all({**sources, "s.k": load.Source(rows)}, plan, f"{tmp_path}/nokey")
    with pytest.raises(Exception, match="no key range"):
        chunks.assign_chunks(rows, "k", single).collect()


def test_one_name_in_two_schemas(spark, tmp_path):
    plan = ranges(spark, 0, 50, schema="a").unionByName(ranges(spark, 0, 5, schema="b"))
    rows = spark.range(100).select(F.col("id").alias("k"))
    sources = {"a.t": load.Source(rows, None, "k"), "b.t": load.Source(rows, None, "k")}
    done = load.export_all(sources, plan, str(tmp_path))
    assert {(r.schema, r.idx): r.n_rows for r in done.collect()} == {("a", 0): 50, ("a", 1): 50, ("b", 0): 5, ("b", 1): 95}
    jobs, marks = jobs_of(spark, done, tmp_path, "r"), marks_in(spark, tmp_path)
    with pytest.raises(ValueError, match="by schema"):
        load.load_chunks(spark, jobs, str(tmp_path), {"t": ["k"]}, f"{tmp_path}/target", marks)
    load.load_chunks(spark, jobs, str(tmp_path), {"t": ["k"]}, f"{tmp_path}/target", marks, by_schema=True)
    assert [chunk_store.ChunkStore(spark, f"{tmp_path}/target/{n}").read("k long").count() for n in ("a.t", "b.t")] == [100, 100]
    load.load_chunks(spark, jobs.where("schema = 'a'"), str(tmp_path), {"t": ["k"]}, f"{tmp_path}/one", marks)
    with pytest.raises(ValueError, match="has chunks of a.t"):
        load.load_chunks(spark, jobs.where("schema = 'b'"), str(tmp_path), {"t": ["k"]}, f"{tmp_path}/one", marks)


def test_block_scans_read_their_files_only(spark, tmp_path):
    for i in range(4):
        spark.range(100 * i, 100 * i + 95).coalesce(1).write.mode("append").parquet(f"{tmp_path}/t/part={i}")
    pinned = tables.kept(tables.pin_snapshot(spark, {"t": f"{tmp_path}/t"}), f"{tmp_path}/pinned")
    index = tables.kept(tables.block_index(pinned, "t", 10), f"{tmp_path}/index")
    assert [(r.n_rows, r.first_block, r.n_blocks) for r in index.orderBy("file").collect()] == [(95, 10 * i, 10) for i in range(4)]
    got = tables.scan_blocks(spark, index, 10, 12, 18)
    assert len(got.inputFiles()) == 1 and sorted(r.id for r in got.collect()) == list(range(120, 180))
    assert len(tables.scan_blocks(spark, index, 10, 18, 22).inputFiles()) == 2
    assert tables.scan_blocks(spark, index, 10, 35).count() == 45 and tables.scan_blocks(spark, index, 10, 99).count() == 0


def test_reads_degrade_when_files_change(spark, tmp_path):
    path = f"{tmp_path}/t"
    spark.range(5).write.parquet(path)
    pinned = tables.kept(tables.pin_snapshot(spark, {"t": path}), f"{tmp_path}/pinned")
    spark.range(7).write.mode("append").parquet(path)
    flags = lambda: [tuple(r) for r in tables.read_or_degrade(spark, pinned, "t", path).groupBy("snapshot_lost").count().collect()]
    assert flags() == [(False, 5)]
    spark.range(3).write.mode("overwrite").parquet(path)
    assert flags() == [(True, 3)]


def test_differences_of_multisets(spark):
    schema = "k long, v string"
    df = lambda *rows: spark.createDataFrame(rows, schema)
    same = df((None, "a"), (1, "x"), (1, "x"), (2, None))
    assert reconcile.changed_rows(same, same.repartition(3), "k").collect() == []
    got = reconcile.difference_counts(same, df((None, "b"), (1, "x"), (3, "n"), (2, None), (2, None)), "k")
    assert {r.k: (r.difference, r.n_missing, r.n_extra) for r in got.collect()} == {None: ("changed", 1, 1), 1: ("missing", 1, 0), 2: ("extra", 0, 1), 3: ("extra", 0, 1)}


def test_only_chunks_that_differ_are_read(spark, tmp_path):
    spark.range(1000).select(F.col("id").alias("k"), F.lit("v").alias("v")).repartitionByRange(10, "k").write.parquet(f"{tmp_path}/s")
    spark.range(1000).select(F.col("id").alias("k"), F.when(F.col("id") == 555, "w").otherwise("v").alias("v")).repartitionByRange(10, "k").write.parquet(f"{tmp_path}/t")
    source, target, plan = spark.read.parquet(f"{tmp_path}/s"), spark.read.parquet(f"{tmp_path}/t"), ranges(spark, *range(0, 1000, 100))
    digests = [reconcile.chunk_digests(df, "k", plan) for df in (source, target)]
    assert [tuple(r) for r in reconcile.differing_chunks(*digests).collect()] == [(5, 100, 100)]
    out = reconcile.diff_by_chunks(source, target, "k", plan)
    assert [tuple(r) for r in out.collect()] == [(555, "changed", 1, 1)]
    executed = out._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(k,500)" in executed and "LessThan(k,600)" in executed
    rows = [r.k for r in source.where(reconcile.in_chunks("k", plan.collect(), {0, 1, 9})).collect()]
    assert sorted(rows) == [*range(200), *range(900, 1000)]


def test_a_silence_that_lasts(spark):
    t0 = datetime(2024, 1, 1)
    rows = [(0, "dead", t0)] + [(i, "alive", t0 + timedelta(seconds=30 * i)) for i in range(1, 9)] + [(90, "alive", t0 + timedelta(seconds=400))]
    events = spark.createDataFrame(rows, "event_id long, worker string, ts timestamp")
    got = {(r.worker, r.gap_s, r.lasts) for r in monitor.silences(events).collect()}
    assert got == {("dead", 400, True), ("alive", 160, False)}
    later = monitor.silences(events, until=F.lit(t0 + timedelta(seconds=500)))
    assert {(r.worker, r.gap_s) for r in later.where("lasts").collect()} == {("dead", 500), ("alive", 100)}


def test_the_stream_reports_a_worker_while_it_is_silent(spark, tmp_path):
    t0 = datetime(2024, 1, 1)
    rows = [(0, 1, t0)] + [(i, 2, t0 + timedelta(seconds=30 * i)) for i in range(1, 9)]
    df = spark.createDataFrame(rows, "event_id long, worker long, ts timestamp").withColumns({"run": F.lit(1), "job": F.lit(1), "type": F.lit("started"), "bytes": F.lit(1)})
    for i in range(9):
        df.where(f"event_id = {i}").coalesce(1).write.mode("append").parquet(f"{tmp_path}/events")
    stream = monitor_stream.stream_silences(monitor_stream.read_stream(spark, f"{tmp_path}/events", 1), late="0 seconds")
    got = monitor_stream.drained(stream, str(tmp_path), "append").collect()
    assert [(r.worker, r.silent_since, r.n_events) for r in got] == [(1, t0, 1)]


def test_a_replayed_batch_changes_nothing(spark, tmp_path):
    for mode, want in (("append", 12), ("complete", 7)):
        put = monitor_stream.batch_sink(f"{tmp_path}/{mode}", mode)
        for number, n in ((0, 5), (1, 7), (1, 7)):
            put(spark.range(n), number)
        assert monitor_stream.batch_rows(spark, f"{tmp_path}/{mode}", spark.range(1).schema).count() == want


@pytest.mark.parametrize(("url", "masked", "tail"), [
    ("db://u:pa/ss@host/base", "db://u:***@host/base", "base"), ("db://u:p@ss@host/x", "db://u:***@host/x", "x"), ("db://:secret@host/b", "db://:***@host/b", "b"), ("db://u:pa?ss@host/b", "db://u:***@host/b", "b"),
    ("db://u:p@/?:w@h:1/b?q=1", "db://u:***@h:1/b", "b"), ("db://host:5432/b?x=1", "db://host:5432/b", "b"), ("db://host", "db://host", "host"), ("plain", "plain", ""), (None, None, None),
])
def test_no_character_of_a_password(spark, url, masked, tail):
    row = spark.createDataFrame([(url,)], "u string").select(ex.masked_url(F.col("u")).alias("m"), ex.url_tail(F.col("u")).alias("t")).first()
    assert row.m == masked and (row.t == tail or url is None)


def test_unsafe_names(spark):
    name = "a/b\\c<d>e:f\"g|h?i*j\x00k\x1fl\x7fm.n"
    assert spark.createDataFrame([(name,)], "n string").select(ex.safe_name(F.col("n"))).first()[0] == "a_b_c_d_e_f_g_h_i_j_k_l\x7fm.n"


def test_keys_of_all_tables_take_one_job(spark):
    a = spark.createDataFrame([(1, 1, 5), (2, 1, 6), (3, None, 7)], "x int, y int, z long")
    found = {"a": a, "b": spark.createDataFrame([(1, "q"), (1, "r")], "x int, s string"), "e": spark.range(0), "d": a}
    tracker, group = spark.sparkContext.statusTracker(), "key-choice"
    spark.sparkContext.setJobGroup(group, group)
    out = profile.pick_chunk_key(found, {"d": "z"})
    jobs = len(tracker.getJobIdsForGroup(group))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert jobs <= len(found)  # one action; adaptive execution may cut it to a stage a table
    assert {r.table: r.key_col for r in out.collect()} == {"a": "x", "b": None, "e": "id", "d": "z"}


def test_load_by_a_list_of_columns(spark):
    spark.sql("CREATE SCHEMA IF NOT EXISTS lists")
    spark.sql("DROP TABLE IF EXISTS lists.t")
    spark.sql("CREATE TABLE lists.t (c STRING, b BIGINT, a BIGINT) USING parquet")
    for _ in range(2):
        load.load_table(spark.range(3).selectExpr("id a", "id * 10 b"), "lists.t", ["a", "b"])
    assert sorted(tuple(r) for r in spark.table("lists.t").collect()) == sorted([(None, 10 * i, i) for i in range(3)] * 2)
    spark.sql("DROP SCHEMA lists CASCADE")


def test_rows_and_mark_of_a_chunk_are_one_transaction(spark):
    driver = {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}
    target = jdbc_target.JdbcTarget(spark, "jdbc:derby:memory:transactions;create=true", **driver)
    target._run('CREATE TABLE t ("k" BIGINT NOT NULL PRIMARY KEY, "v" VARCHAR(10) DEFAULT \'x\')')
    rows = spark.range(5).select(F.col("id").alias("k"))
    read = lambda: sorted(tuple(r) for r in spark.read.jdbc(target.url, "t", properties=driver).collect())
    assert target.load(rows, "t", "a") and not target.load(rows, "t", "a")
    assert read() == [(k, "x") for k in range(5)]
    with pytest.raises(Exception, match="(?i)truncation|too long|length"):  # the mark fails, so the rows go too
        target.load(spark.range(10, 12).select(F.col("id").alias("k")), "t", "b" * 600)
    with pytest.raises(Exception, match="(?i)duplicate"):  # the rows fail, so there is no mark
        target.load(rows, "t", "c")
    assert len(read()) == 5 and [r.chunk_key for r in target.done().collect()] == ["a"]
    assert jdbc_target.JdbcTarget(spark, target.url, **driver).done().count() == 1
    names = spark.read.jdbc(target.url, "SYS.SYSTABLES", properties=driver).select("TABLENAME").collect()
    assert not [n for n in names if n[0].upper().startswith("STAGE")]


def test_only_key_ranges_are_shuffled(spark, tmp_path, monkeypatch):
    """Blocks, single chunks and loads are written by the tasks that read them."""
    spark.range(400).select(F.col("id").alias("k")).repartition(4).write.parquet(f"{tmp_path}/in")
    rows = spark.read.parquet(f"{tmp_path}/in")
    single = spark.createDataFrame([("s", "o", "single", 0, None, None, None, None, 1, 1)], PLAN)
    plan = single.unionByName(ranges(spark, 0, 100, 300, table="k"))
    gathered, write = {}, load.write_counted

    def seen(df, path, *args, gather=False, **kw):
        gathered[path.rpartition("/")[2]] = gather
        return write(df, path, *args, gather=gather, **kw)

    monkeypatch.setattr(load, "write_counted", seen)
    load.export_all({"s.o": load.Source(rows), "s.k": load.Source(rows, None, "k")}, plan, f"{tmp_path}/out")
    assert gathered == {"s.o": False, "s.k": True}
    assert spark.read.parquet(f"{tmp_path}/out/data/s.k").count() == spark.read.parquet(f"{tmp_path}/out/data/s.o").count() == 400
