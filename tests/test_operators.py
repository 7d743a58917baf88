"""Manifest, ledger, load, expressions, sources and monitoring on small inputs."""

import json
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from chunkwright.functions import expressions as ex
from chunkwright.operators import chunks, ledger, load, monitor, profile, reconcile
from chunkwright.plans import chunk_plan as plans
from chunkwright.sources import manifest, tables


def one(spark, expression):
    return spark.range(1).select(expression.alias("x")).first().x


@pytest.mark.parametrize(("n", "text"), [(0, "0 B"), (1023, "1023 B"), (1536, "1.5 KB"), (2621440, "2.5 MB"), (3758096384, "3.50 GB")])
def test_human_size(spark, n, text):
    assert one(spark, ex.human_size(F.lit(n))) == text


@pytest.mark.parametrize(("n", "text"), [(59, "59s"), (330, "5m 30s"), (9045, "2h 30m 45s")])
def test_elapsed(spark, n, text):
    assert one(spark, ex.elapsed(F.lit(n))) == text


@pytest.mark.parametrize(("done", "total", "pct"), [(1, 0, 0), (1, 3, 33), (9, 3, 100)])
def test_percent(spark, done, total, pct):
    assert one(spark, ex.percent(F.lit(done), F.lit(total))) == pct


def test_urls(spark):
    u = F.lit("db://me:pw@host:5432/base?sslmode=require&x=1")
    assert one(spark, ex.masked_url(u)) == "db://me:***@host:5432/base"
    assert one(spark, ex.url_tail(u)) == "base"
    assert one(spark, ex.url_with_only(u, "sslmode")) == "db://me:pw@host:5432/base?sslmode=require"
    assert one(spark, ex.url_with_only(F.lit("db://h/b?x=1"), "sslmode")) == "db://h/b"


def _document(**chunk):
    base = {"idx": 0, "range_start": 1, "range_end": 9, "est_bytes": 10, "est_rows": 2, "file": "data/public.t/chunk_0000.parquet.zstd"}
    return {"version": 1, "run_id": "r", "tables": [{"schema": "public", "table": "t", "kind": "r", "strategy": "key_range", "bytes": "10", "est_rows": 2, "chunks": [base | chunk]}], "sequences": []}


def _read(spark, tmp_path, document):
    (tmp_path / "m.json").write_text(json.dumps(document, indent=1))
    return manifest.read_manifest(spark, str(tmp_path / "m.json"))


def test_manifest_numbers(spark, tmp_path):
    got = plans.plan_jobs(_read(spark, tmp_path, _document(est_bytes="77", est_rows="not_a_number", range_start="", range_end=None))).first()
    assert (got.est_bytes, got.est_rows, got.range_start, got.range_end, got.block_start) == (77, 0, 0, None, None)


@pytest.mark.parametrize("document", [_document() | {"version": 99}, _document(file="../../../etc/passwd"), _document(file="/etc/passwd")])
def test_manifest_refused(spark, tmp_path, document):
    with pytest.raises(Exception, match="not supported|outside"):
        _read(spark, tmp_path, document).collect()


def test_half_done_run_goes_on(spark, tmp_path):
    rows = spark.range(100).withColumnRenamed("id", "k").withColumn("v", F.concat(F.lit("v"), F.col("k")))
    catalog = profile.profile_tables({"t": rows}, {"t": "k"})
    plan = plans.plan_even(catalog, 100, 8)
    tagged, jobs = chunks.assign_chunks(rows, "k", plan), plan.withColumn("chunk_key", ledger.chunk_key("r")).withColumn("chunk_id", F.col("idx"))
    marks = ledger.Ledger(spark, str(tmp_path / "ledger"))
    marks.create()
    first = jobs.where("idx < 2")
    load.redo_chunks(tagged, first, str(tmp_path / "data"))
    marks.mark(first)
    marks.mark(first)  # again does nothing
    assert marks.done().count() == 2
    # A chunk that was written in part and not marked is written again.
    tagged.where("chunk_id = 3").limit(1).write.mode("append").partitionBy("chunk_id").parquet(str(tmp_path / "data"))
    left = ledger.pending(jobs, marks.done())
    assert left.count() == jobs.count() - 2
    load.redo_chunks(tagged, left, str(tmp_path / "data"), "lz4")
    marks.mark(left)
    back = spark.read.parquet(str(tmp_path / "data")).select("k", "v")
    assert reconcile.reconcile(reconcile.fingerprint({"t": rows}), reconcile.fingerprint({"t": back})).first().values_match
    assert ledger.pending(jobs, marks.done()).isEmpty()
    found = load.list_chunks(spark, str(tmp_path / "data")).select("chunk_id").distinct()
    assert found.count() == jobs.count()
    other = plans.plan_even(catalog, 50, 16).withColumn("chunk_key", ledger.chunk_key("r"))
    assert ledger.pending(other, marks.done()).count() == other.count()  # another plan has other keys
    marks.reset()
    assert marks.done().isEmpty()


def test_snapshot_is_pinned(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(5).write.parquet(path)
    pinned = tables.pin_snapshot(spark, {"t": path})
    pinned = spark.createDataFrame(pinned.collect(), pinned.schema)
    spark.range(7).write.mode("append").parquet(path)
    assert tables.read_pinned(spark, pinned, "t").count() == 5
    assert not tables.snapshot_lost(pinned, tables.pin_snapshot(spark, {"t": path})).first().snapshot_lost
    spark.range(1).write.mode("overwrite").parquet(path)
    assert tables.snapshot_lost(pinned, tables.pin_snapshot(spark, {"t": path})).first().snapshot_lost


def test_jdbc_chunks(spark):
    url = "jdbc:derby:memory:chunks;create=true"
    rows = spark.range(1, 41).select(F.col("id").cast("int").alias("K"))
    rows.unionByName(spark.createDataFrame([(None,)], "K int")).write.mode("overwrite").jdbc(url, "T", properties={"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"})
    plan = plans.plan_even(profile.profile_tables({"t": rows}, {"t": "K"}), 20, 8)
    got = tables.read_chunked_jdbc(spark, url, "T", plan, "K", driver="org.apache.derby.iapi.jdbc.AutoloadedDriver")
    assert got.rdd.getNumPartitions() == plan.count() and got.count() == 41


def test_clean_target(spark):
    spark.sql("CREATE SCHEMA IF NOT EXISTS shop")
    spark.range(3).write.mode("overwrite").saveAsTable("shop.t")
    load.clean_target(spark, tables=["shop.t"])
    assert spark.table("shop.t").count() == 0
    load.clean_target(spark, schemas=["shop"])
    assert not spark.catalog.tableExists("shop.t")
    with pytest.raises(ValueError):
        load.clean_target(spark, schemas=["shop"], data_only=True)


def test_views_go_on_after_a_failure(spark, tmp_path):
    got = load.refresh_views(spark, [("SELECT * FROM no_such_table", str(tmp_path / "a")), ("SELECT count(*) AS n FROM {t}", str(tmp_path / "b"))], t=spark.range(4))
    assert [r.ok for r in got.orderBy("target").collect()] == [False, True]


def test_schemas_travel(spark):
    df = spark.createDataFrame([(1, "a")], "k long, v string")
    schema = manifest.export_schemas({"t": df}).first().schema_json
    got = manifest.apply_schema(spark.createDataFrame([("a", 1)], "v string, k int"), schema)
    assert got.schema == df.schema and got.first() == (1, "a")


def test_selection(spark):
    c = spark.createDataFrame([("public", "t", "r"), ("x", "t", "m"), ("pg_catalog", "t", "r"), ("pgbench", "t", "r")], "schema string, table string, kind string").withColumn("bytes", F.lit(1))
    assert load.select_tables(c, table="x.t").count() == 1 and load.select_tables(c, table="t").count() == 4
    with pytest.raises(ValueError):
        load.select_tables(c, table="a.b.c")
    assert load.loadable(c).count() == 3
    assert {r.schema for r in profile.user_tables(c).select("schema").collect()} == {"public", "x", "pgbench"}
    with pytest.raises(ValueError, match="public"):
        profile.assert_schema(c, "nope")


ERRORS = [(c, "", "NETWORK") for c in monitor.NETWORK_CODES] + [(c, "", "STREAM") for c in monitor.STREAM_CODES] + [(c, "", "SERVER") for c in ("08000", "08006", "57P01", "57P02", "57P03")]
ERRORS += [(None, f"oh: {p}!", "STREAM") for p in monitor.STREAM_PHRASES] + [("23505", "duplicate", "UNKNOWN"), ("42P01", "", "UNKNOWN"), (None, "x", "UNKNOWN"), (None, None, "UNKNOWN")]


def test_triage(spark):
    rows = [(i, c, m, None, None, k) for i, (c, m, k) in enumerate(ERRORS)] + [(100 + i, "X", "wrapped", c, m, k) for i, (c, m, k) in enumerate(ERRORS)]
    got = monitor.triage_errors(spark.createDataFrame(rows, "i int, code string, message string, cause_code string, cause_message string, want string"))
    assert got.where("category <> want or transient <> (want <> 'UNKNOWN')").collect() == []


def test_waits(spark):
    t0 = datetime(2024, 1, 1)
    rows = [(1, 1, t0 + timedelta(seconds=i), i) for i in range(11)]
    got = monitor.retry_schedule(spark.createDataFrame(rows, "run int, job int, ts timestamp, event_id long")).orderBy("attempt").collect()
    assert [r.wait_s for r in got] == [5, 10, 20, 40, 60, 60, 60, 60, 60, 60, 60]
    late = monitor.retry_schedule(spark.createDataFrame(rows, "run int, job int, ts timestamp, event_id long"), jitter=True).selectExpr("unix_micros(due) - unix_micros(ts) - wait_s * 1000000 AS j").collect()
    assert all(0 <= r.j < 1_000_000 for r in late)


def test_probe_sample_is_the_lateral_join(spark):
    import random

    rng = random.Random(5)
    for _ in range(6):
        keys = sorted(rng.sample(range(1, 500), rng.randint(1, 80)))
        target = rng.randint(1, 60)
        step = max(1, (keys[-1] - keys[0]) // target)
        want = sorted({min(k for k in keys if k >= p) for p in range(keys[0], keys[-1] + 1, step)})
        df = spark.createDataFrame([(k,) for k in keys] + [(None,)], "k long")
        assert sorted(r.pk for r in profile.probe_sample(df, "k", target).collect()) == want


def test_key_choice(spark):
    a = spark.createDataFrame([(1, 1, 5), (2, 1, 6), (3, None, 7)], "x int, y int, z long")
    b = spark.createDataFrame([(1, "q"), (1, "r")], "x int, s string")
    c = spark.createDataFrame([("q",)], "s string")
    got = {r.table: r.key_col for r in profile.pick_chunk_key({"a": a, "b": b, "c": c, "d": a}, {"d": "z"}).collect()}
    assert got == {"a": "x", "b": None, "c": None, "d": "z"}


def test_empty_table_profile(spark):
    got = profile.profile_tables({"e": spark.range(0)}, {"e": "id"}).first()
    assert (got.est_rows, got.bytes, got.n_blocks, got.key_min, got.key_max) == (0, 0, 0, None, None)


def test_key_range_filter_reaches_the_scan(spark, sf):
    plan = tables.scan_key_range(tables.scan_table(spark, f"{sf}/documents.parquet", ["doc_id", "lang"]), "doc_id", 5, 9)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(doc_id,5)" in plan and "ReadSchema: struct<doc_id:bigint,lang:string>" in plan


def test_hashes_tell_nulls_apart(spark):
    a = spark.createDataFrame([(1, None, "x"), (2, "p", None), (3, "s", "t")], "k long, a string, b string")
    b = spark.createDataFrame([(1, "x", None), (2, "p", None), (3, "s", "t")], "k long, a string, b string")
    assert [r.values_match for r in reconcile.reconcile(reconcile.fingerprint({"t": a}), reconcile.fingerprint({"t": b})).collect()] == [False]
    assert [(r.k, r.difference) for r in reconcile.changed_rows(a, b, "k").collect()] == [(1, "changed")]


def test_chunk_keys_differ_by_kind_of_range(spark):
    rows = [("s", "t", 0, "key_range", 5, 9, None, None), ("s", "t", 0, "block_range", None, None, 5, 9), ("s", "t", 0, "key_range", 5, None, 9, None)]
    df = spark.createDataFrame(rows, "schema string, table string, idx long, strategy string, range_start long, range_end long, block_start long, block_end long")
    keys = [r[0] for c in (None, ["a"], ["b"]) for r in df.select(ledger.chunk_key("r", c)).collect()]
    assert len(set(keys)) == 9


def test_chunks_of_two_tables(spark):
    plan = spark.createDataFrame([("a", 0, 10), ("a", 1, 20), ("b", 0, 0), ("b", 1, 15), ("b", 2, 1000)], "table string, idx long, range_start long")
    rows = spark.createDataFrame([(k,) for k in (None, -(1 << 63), 0, 9, 10, 14, 15, 19, 20, 999, 1000, (1 << 63) - 1)], "k long")
    got = lambda t: sorted(((r.k, r.chunk_id) for r in chunks.assign_chunks(rows, "k", plan, t).collect()), key=str)
    want = lambda starts: sorted(((r.k, 0 if r.k is None else max(0, sum(s <= r.k for s in starts) - 1)) for r in rows.collect()), key=str)
    assert got("a") == want([10, 20]) and got("b") == want([0, 15, 1000])


def test_load_fails_with_the_whole_list(spark, tmp_path):
    rows = spark.range(100).select(F.col("id").alias("k"))
    plan = spark.createDataFrame([("s", "t", i, "key_range", 25 * i, 25 * i + 24, None, None) for i in range(4)], "schema string, table string, idx long, strategy string, range_start long, range_end long, block_start long, block_end long")
    plan = plans.chunk_folders(plan)
    load.export_tables({"t": rows}, {"t": "k"}, plan, str(tmp_path))
    jobs = plan.withColumn("chunk_key", ledger.chunk_key("r"))
    assert load.missing_chunks(jobs, load.list_chunks(spark, str(tmp_path))).count() == 0
    for i in (1, 3):
        tables.delete_path(spark, f"{tmp_path}/data/chunk_table=t/chunk_id={i}")
    marks = ledger.Ledger(spark, f"{tmp_path}/ledger")
    marks.create()
    with pytest.raises(FileNotFoundError, match="2 chunks.*chunk_id=1, .*chunk_id=3"):
        load.load_chunks(spark, jobs, str(tmp_path), {"t": ["k"]}, f"{tmp_path}/target", marks)
    for _ in range(2):  # a redo between data and mark doubles nothing
        load.load_chunks(spark, jobs.where("idx % 2 = 0"), str(tmp_path), {"t": ["k"]}, f"{tmp_path}/target", marks, mark=False)
    load.load_chunks(spark, jobs.where("idx % 2 = 0"), str(tmp_path), {"t": ["k"]}, f"{tmp_path}/target", marks)
    assert spark.read.parquet(f"{tmp_path}/target/t").count() == 50 and marks.done().count() == 2


def test_time_left_just_above_a_whole_second(spark):
    """Event 2 has 115,007.00000045 seconds left, which a quotient rounded at its sixth place makes whole."""
    t0 = datetime(2024, 1, 7)
    rows = [(1, 0, t0, 759_135_437), (2, 0, t0 + timedelta(microseconds=35_986_139_610), 816_540_600), (3, 1, t0, 0), (4, 1, t0 + timedelta(seconds=1), 1), (5, 2, t0, 0), (6, 2, t0 + timedelta(seconds=4), 2 * 10**9)]
    out = monitor.rolling_speed(spark.createDataFrame(rows, "event_id long, run int, ts timestamp, done_bytes long"), 10**9, 36_000)
    assert {r.event_id: r.eta_s for r in out.collect()} == {1: 0, 2: 115_008, 3: 0, 4: 10**9 - 1, 5: 0, 6: 0}
