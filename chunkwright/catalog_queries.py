"""Queries over the tables in a folder, one or more for each operator, with their DuckDB forms.

`events` stands for the event stream of a run: worker is user_id % 8, run is user_id % 3, job is event_id % 100, and its
five types are mapped to the five of a run. Time spans are in hours where a run's are in seconds.
"""

from __future__ import annotations

import uuid
from datetime import timedelta
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chunkwright.functions.expressions import masked_url, row_bytes, url_tail, url_with_only
from chunkwright.operators import chunks, ledger, load, monitor, profile, reconcile
from chunkwright.plans import chunk_plan as plans
from chunkwright.sources import manifest, tables
from chunkwright.sources.chunk_store import ChunkStore
from chunkwright.sources.jdbc_target import JdbcTarget
from chunkwright.sources.workspace import workspace
from chunkwright.streaming import monitor_stream as streams

#: Whole-number and text columns: those whose text form is the same in any engine.
COLUMNS = {
    "region": ["r_regionkey", "r_name"],
    "nation": ["n_nationkey", "n_name", "n_regionkey"],
    "customer": ["c_custkey", "c_name", "c_nationkey", "c_mktsegment"],
    "supplier": ["s_suppkey", "s_name", "s_nationkey"],
    "part": ["p_partkey", "p_name", "p_brand", "p_type", "p_size"],
    "orders": ["o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority"],
    "lineitem": ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_returnflag", "l_linestatus"],
    "events": ["event_id", "user_id", "event_type", "props"],
    "documents": ["doc_id", "text", "lang", "source", "n_chars"],
    "embeddings": ["vec_id", "label"],
    "pages": ["page_id", "url", "html"],
    "benchmark": ["item_id", "text"],
    "labels": ["doc_id", "quality", "toxic"],
    "conversations": ["conv_id", "turn", "role", "text"],
}
KEYS = {"region": "r_regionkey", "nation": "n_nationkey", "customer": "c_custkey", "supplier": "s_suppkey", "part": "p_partkey", "orders": "o_orderkey", "events": "event_id", "documents": "doc_id", "embeddings": "vec_id", "pages": "page_id", "benchmark": "item_id", "labels": "doc_id"}
CORPUS = ("documents", "embeddings", "pages", "benchmark", "labels", "conversations")
VIEWS = ("pages",)
ROWS_PER_BLOCK, THRESHOLD, MAX_CHUNKS, TARGET, BLOCKS_PER_CHUNK = 256, 1 << 18, 16, 200, 8
HOUR = 3600
TYPES = {"signup": "started", "view": "retrying", "click": "skipped", "purchase": "completed", "error": "failed"}
CODES = ["ECONNRESET", "08006", "57P01", "23505", "ERR_STREAM_DESTROYED", "", "EPIPE"]
MESSAGES = ["duplicate key", "Connection terminated by peer", "write failed", "read timeout expired", "bad row"]


def _tables(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    return profile.read_tables(spark, sf, list(COLUMNS))


def _catalog(spark: SparkSession, sf: str) -> DataFrame:
    found = _tables(spark, sf)
    part = lambda names, schema: profile.profile_tables({n: found[n] for n in names}, KEYS, COLUMNS, schema, dict.fromkeys(VIEWS, "m"), ROWS_PER_BLOCK)
    return part([n for n in COLUMNS if n not in CORPUS], "sales").unionByName(part(CORPUS, "corpus"))


def _documents(spark: SparkSession, sf: str) -> DataFrame:
    return tables.scan_table(spark, f"{sf}/documents.parquet", COLUMNS["documents"])


def _even(spark: SparkSession, sf: str) -> DataFrame:
    return plans.plan_even(_catalog(spark, sf).where("key_min is not null"), THRESHOLD, MAX_CHUNKS)


def _balanced(spark: SparkSession, sf: str) -> DataFrame:
    docs = _documents(spark, sf)
    catalog = profile.profile_tables({"documents": docs}, KEYS, COLUMNS, "corpus", rows_per_block=ROWS_PER_BLOCK)
    samples = profile.probe_sample(docs, "doc_id", TARGET).select(F.lit("corpus").alias("schema"), F.lit("documents").alias("table"), "pk", "bytes")
    return plans.plan_balanced(catalog, samples, THRESHOLD, MAX_CHUNKS)


def _blocks(spark: SparkSession, sf: str) -> DataFrame:
    return plans.plan_blocks(_catalog(spark, sf), BLOCKS_PER_CHUNK, MAX_CHUNKS)


def _events(spark: SparkSession, sf: str) -> DataFrame:
    return _as_run(spark.read.parquet(f"{sf}/events.parquet"))


def _as_run(events: DataFrame) -> DataFrame:
    kind = F.element_at(F.create_map(*[F.lit(x) for kv in TYPES.items() for x in kv]), F.col("event_type"))
    return events.select("event_id", F.col("ts").cast("timestamp").alias("ts"), (F.col("user_id") % 3).alias("run"), (F.col("user_id") % 8).alias("worker"), (F.col("event_id") % 100).alias("job"), kind.alias("type"), F.floor(F.col("value") * 100).cast("long").alias("bytes"))


def _naive(df: DataFrame) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c, t in df.dtypes if t == "timestamp"})


def _failures(spark: SparkSession, sf: str) -> DataFrame:
    at = lambda values, of: F.element_at(F.array(*map(F.lit, values)), (of % len(values) + 1).cast("int"))
    i = F.col("event_id")
    return _events(spark, sf).where("type = 'failed'").withColumns({"code": at(CODES, i), "message": at(MESSAGES, F.floor(i / 7).cast("long")), "cause_code": at(CODES, F.floor(i / 35).cast("long")), "cause_message": at(MESSAGES, F.floor(i / 3).cast("long"))})


def _jobs(spark: SparkSession, sf: str) -> DataFrame:
    """A chunk for each job, with the mean bytes of its events as its estimate."""
    return _events(spark, sf).groupBy("job").agg(F.expr("sum(bytes) div count(*)").alias("est_bytes"))


def q_table_profile(spark, sf):
    return profile.user_tables(_catalog(spark, sf)).select("schema", "table", "kind", "est_rows", "bytes", "n_blocks", "key_col", "key_min", "key_max")


def q_top_tables(spark, sf):
    return profile.top_tables(_catalog(spark, sf)).select("table", "bytes")


def q_catalog_totals(spark, sf):
    return profile.catalog_totals(_catalog(spark, sf))


def q_columns(spark, sf):
    return profile.profile_columns(_tables(spark, sf), {"documents": ["n_chars"]})


def q_column_lists(spark, sf):
    lists = profile.column_lists(profile.profile_columns(_tables(spark, sf), {"documents": ["n_chars"], "orders": ["o_orderdate", "o_totalprice"]}))
    return lists.select("table", F.concat_ws(",", "columns").alias("columns"), F.concat_ws(",", "generated").alias("generated"))


def q_key_candidates(spark, sf):
    return profile.pick_chunk_key(_tables(spark, sf), KEYS)


def q_key_bounds(spark, sf):
    return profile.key_bounds(_documents(spark, sf), "doc_id")


def q_row_bytes(spark, sf):
    found = _tables(spark, sf)
    return profile.profile_tables({n: found[n] for n in ("documents", "benchmark", "pages")}, columns=COLUMNS).select("table", F.col("est_rows").alias("n_rows"), F.col("bytes").alias("n_bytes"))


def q_probe_sample(spark, sf):
    found = _tables(spark, sf)
    part = lambda n, k: profile.probe_sample(found[n], k, TARGET, row_bytes(found[n], COLUMNS[n])).select(F.lit(n).alias("table"), "pk", "bytes")
    return part("labels", "doc_id").unionByName(part("documents", "doc_id"))


def q_assert_schema(spark, sf):
    catalog = _catalog(spark, sf)
    profile.assert_schema(catalog, "corpus")
    return catalog.groupBy("schema").agg(F.count("*").alias("n_tables"), F.sum("est_rows").alias("n_rows"))


def q_populated(spark, sf):
    return profile.target_is_populated(_catalog(spark, sf).where("est_rows > 0"))


def q_strategy(spark, sf):
    return plans.choose_strategy(_catalog(spark, sf), THRESHOLD).select("schema", "table", "strategy")


def q_plan_single(spark, sf):
    return plans.plan_single(_catalog(spark, sf)).select("schema", "table", "idx", "est_bytes", "est_rows")


def q_plan_even(spark, sf):
    return _even(spark, sf).select("schema", "table", "idx", "range_start", "range_end", "est_bytes", "est_rows")


def q_plan_blocks(spark, sf):
    return _blocks(spark, sf).select("schema", "table", "idx", "block_start", "block_end", "est_bytes", "est_rows")


def q_plan_balanced(spark, sf):
    return _balanced(spark, sf).select("idx", "range_start", "range_end", "est_bytes", "est_rows")


def q_plan_audit(spark, sf):
    """A sound plan with faults put in: a hole in documents, a lost end in pages, a wrong estimate in labels, a negative one in events."""
    bad = _even(spark, sf).where("not (table = 'documents' and idx = 1) and not (table = 'pages' and idx = 0)")
    bad = bad.withColumn("est_rows", F.when((F.col("table") == "labels") & (F.col("idx") == 0), F.col("est_rows") + 1).otherwise(F.col("est_rows")))
    bad = bad.withColumn("est_bytes", F.when((F.col("table") == "events") & (F.col("idx") == 0), -F.col("est_bytes")).otherwise(F.col("est_bytes")))
    return plans.audit_plan(bad, _catalog(spark, sf))


def q_strategy_mix(spark, sf):
    docs = _documents(spark, sf)
    samples = profile.probe_sample(docs, "doc_id", TARGET).select(F.lit("corpus").alias("schema"), F.lit("documents").alias("table"), "pk", "bytes")
    return plans.strategy_mix(plans.plan_all(_catalog(spark, sf), samples, THRESHOLD, MAX_CHUNKS, BLOCKS_PER_CHUNK)).select("strategy", "n_tables")


def q_fill_estimates(spark, sf):
    bare = _even(spark, sf).withColumns({c: F.when(F.col("idx") % 2 == 0, F.col(c)) for c in ("est_bytes", "est_rows")})
    return plans.fill_estimates(bare, _catalog(spark, sf)).select("schema", "table", "idx", "est_bytes", "est_rows")


def q_job_order(spark, sf):
    return plans.chunk_paths(plans.order_jobs(_even(spark, sf))).select("place", "file", "est_bytes")


def _planned(spark, sf):
    """The balanced plan, worked out once."""
    return tables.kept(_balanced(spark, sf), workspace(spark, "plan"))


def q_chunk_rows(spark, sf):
    return chunks.chunk_metrics(chunks.assign_chunks(_documents(spark, sf), "doc_id", _planned(spark, sf)))


def q_chunk_balance(spark, sf):
    plan = _planned(spark, sf)
    return chunks.chunk_balance(chunks.chunk_metrics(chunks.assign_chunks(_documents(spark, sf), "doc_id", plan)), plan)


def q_balance_ratio(spark, sf):
    return chunks.balance_ratio(q_chunk_balance(spark, sf))


def q_null_key(spark, sf):
    docs = _documents(spark, sf).withColumn("doc_id", F.when(F.col("doc_id") % 50 != 0, F.col("doc_id")))
    return chunks.assign_chunks(docs, "doc_id", _even(spark, sf), "documents").groupBy("chunk_id").agg(F.count("*").alias("n_rows"), F.count_if(F.col("doc_id").isNull()).alias("n_null"))


def q_key_range(spark, sf):
    """A scan for each range of the plan."""
    docs, out = _documents(spark, sf), []
    for r in _even(spark, sf).where("table = 'documents'").orderBy("idx").collect():
        out.append(tables.scan_key_range(docs, "doc_id", r.range_start, r.range_end, r.idx).agg(F.lit(r.idx).alias("chunk_id"), F.count("*").alias("n_rows"), F.sum("n_chars").alias("n_chars")))
    return reduce(DataFrame.unionByName, out)


def _database(spark):
    """The database that spark.chunkwright.jdbc.url names, which all executors must reach; where that is unset, which is an error but in local mode, one in this JVM."""
    url = spark.conf.get("spark.chunkwright.jdbc.url", None)
    if not url and not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.chunkwright.jdbc.url must name a database that all executors reach")
    url = url or "jdbc:derby:memory:chunkwright;create=true"
    return url, {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"} if url.startswith("jdbc:derby:") else {}


def q_jdbc_chunks(spark, sf):
    """Orders in a database, read back with a partition for each range of the plan."""
    (url, driver), name = _database(spark), f"orders_{uuid.uuid4().hex}"
    orders = tables.scan_table(spark, f"{sf}/orders.parquet", ["o_orderkey", "o_custkey"])
    orders.write.jdbc(url, name, properties=driver)
    plan = _even(spark, sf).where("table = 'orders'")
    rows = tables.read_chunked_jdbc(spark, url, name, plan, '"o_orderkey"', **driver).withColumn("chunk_id", F.spark_partition_id().cast("long"))
    return rows.groupBy("chunk_id").agg(F.count("*").alias("n_rows"), F.min("o_orderkey").alias("first_key"), F.max("o_orderkey").alias("last_key"), F.sum("o_custkey").alias("sum_custkey"))


def q_jdbc_load(spark, sf):
    """Chunks of orders loaded into a table of a database that has its columns in another order and one more; a run that does them again finds them done."""
    url, driver = _database(spark)
    name, orders = f"loaded_{uuid.uuid4().hex}", tables.scan_table(spark, f"{sf}/orders.parquet", ["o_orderkey", "o_custkey", "o_orderstatus"])
    target = JdbcTarget(spark, url, f"marks_{uuid.uuid4().hex}", **driver)
    target._run(f'CREATE TABLE {name} ("note" VARCHAR(20) DEFAULT \'none\', "o_orderstatus" VARCHAR(4), "o_custkey" BIGINT, "o_orderkey" BIGINT)')
    plan = _keyed_jobs(spark, sf).where("table = 'orders'").orderBy("idx").collect()  # a row for each chunk
    loaded = [target.load(tables.scan_key_range(orders, "o_orderkey", r.range_start, r.range_end, r.idx), name, r.chunk_key) for r in [*plan, plan[0]]]
    back = spark.read.jdbc(url, name, properties=driver).groupBy("o_orderstatus").agg(F.count("*").alias("n_rows"), F.count_if(F.col("note") == "none").alias("n_default"), F.sum("o_orderkey").alias("sum_key"))
    return back.withColumns({"again": F.lit(loaded[-1]), "all_marked": F.lit(target.done().count() == len(plan))}).withColumn("sum_key", F.col("sum_key").cast("long"))


def q_block_rows(spark, sf):
    plan = _blocks(spark, sf).where("table = 'orders'")
    rows = tables.with_blocks(spark, f"{sf}/orders.parquet", ROWS_PER_BLOCK)
    return chunks.assign_blocks(rows, plan).groupBy("chunk_id").agg(F.count("*").alias("n_rows"), F.min("block").alias("first_block"), F.max("block").alias("last_block"))


def _priced(spark, sf):
    price = F.col("l_extendedprice").cast("decimal(12,2)") * (1 - F.col("l_discount").cast("decimal(4,2)"))
    rows = spark.read.parquet(f"{sf}/lineitem.parquet").select("l_orderkey", "l_linenumber", "l_extendedprice", "l_discount")
    return rows, {"disc_price": price.cast("decimal(16,4)")}


def q_generated(spark, sf):
    rows, made = _priced(spark, sf)
    stored = rows.withColumn("disc_price", F.when(F.col("l_orderkey") % 97 == 0, None).when(F.col("l_orderkey") % 89 == 0, made["disc_price"] + 1).otherwise(made["disc_price"]))
    return load.check_generated(stored, made)


def q_recomputed(spark, sf):
    rows, made = _priced(spark, sf)
    loaded = load.recompute_generated(load.drop_generated(rows.withColumn("disc_price", F.lit(None)), ["disc_price"]), made)
    return loaded.groupBy("l_linenumber").agg(F.count("*").alias("n_rows"), (F.sum("disc_price") * 10000).cast("long").alias("disc_price_x10000"))


def q_select_tables(spark, sf):
    catalog = _catalog(spark, sf)
    return load.select_tables(catalog, "sales").unionByName(load.select_tables(catalog, table="corpus.labels")).select("schema", "table", "est_rows")


def q_loadable(spark, sf):
    return load.loadable(_catalog(spark, sf)).select("schema", "table", "kind", "est_rows")


def _keyed_jobs(spark, sf):
    return plans.chunk_paths(_even(spark, sf)).withColumn("chunk_key", ledger.chunk_key("run-1"))


def q_pending(spark, sf):
    jobs = _keyed_jobs(spark, sf)
    return ledger.pending(jobs, jobs.where("idx % 3 = 0")).select("schema", "table", "idx", "est_rows")


def q_preview(spark, sf):
    jobs = _keyed_jobs(spark, sf)
    return plans.preview(jobs, jobs.where("idx % 3 = 0")).select("schema", "table", "idx", "done")


_LOADED = {"documents": "doc_id", "orders": "o_orderkey"}


def _exported(spark, sf, names):
    """An export of some tables in one run, and its manifest's jobs."""
    root, catalog = workspace(spark, "export"), tables.kept(_catalog(spark, sf), workspace(spark, "catalog"))
    plan = tables.kept(plans.plan_even(catalog.where("key_min is not null"), THRESHOLD, MAX_CHUNKS).where(F.col("table").isin(*names)), f"{root}/plan")
    found = _tables(spark, sf)
    done = load.export_all({f"{_schema(n)}.{n}": load.Source(found[n], COLUMNS[n], KEYS[n]) for n in names}, plan, root, "lz4")
    return root, _manifest_jobs(spark, done, catalog, root, "run-1")


def _schema(table):
    return "corpus" if table in CORPUS else "sales"


def _manifest_jobs(spark, exported, catalog, root, run):
    """The export's manifest, written and read back as jobs."""
    manifest.write_manifest(exported, catalog, profile.sequence_state(catalog), run, f"{root}/manifest")
    return plans.plan_jobs(manifest.read_manifest(spark, f"{root}/manifest")).withColumn("chunk_key", ledger.chunk_key(run))


def q_missing_chunks(spark, sf):
    """Chunks of the manifest whose files were lost after the export."""
    root, jobs = _exported(spark, sf, ["documents"])
    for r in jobs.where("idx % 4 = 1").select("file").collect():
        tables.delete_path(spark, f"{root}/{r.file}")
    return load.missing_chunks(jobs, load.list_chunks(spark, root)).select("file", "status")


def q_load_resume(spark, sf):
    """Two tables loaded from a manifest through a ledger: a first run stops between data and mark, a second loads the rest once."""
    root, jobs = _exported(spark, sf, list(_LOADED))
    marks = ledger.Ledger(spark, f"{root}/ledger")
    marks.create()
    load.load_chunks(spark, jobs.where("idx % 4 = 0"), root, COLUMNS, f"{root}/target", marks)
    load.load_chunks(spark, jobs.where("idx % 2 = 0"), root, COLUMNS, f"{root}/target", marks, mark=False)
    load.load_chunks(spark, jobs, root, COLUMNS, f"{root}/target", marks)
    n_marks = jobs.join(marks.done(), "chunk_key").groupBy("table", F.col("idx").alias("chunk_id")).agg(F.count("*").alias("n_marks"))
    rows = reduce(DataFrame.unionByName, [ChunkStore(spark, f"{root}/target/{n}").read(spark.read.parquet(f"{sf}/{n}.parquet").select(*COLUMNS[n]).schema).select(F.lit(n).alias("table"), "chunk_id", F.col(k).alias("k")) for n, k in _LOADED.items()])
    return rows.groupBy("table", "chunk_id").agg(F.count("*").alias("n_rows"), F.min("k").alias("first_key"), F.max("k").alias("last_key")).join(n_marks, ["table", "chunk_id"])


def q_export_all(spark, sf):
    """All tables of two schemas and one of a third with a name that another has, each by its strategy, exported in one run and loaded from the manifest: do rows and values arrive?"""
    root, found = workspace(spark, "export"), _tables(spark, sf)
    twin = profile.profile_tables({"documents": found["orders"]}, {"documents": "o_orderkey"}, {"documents": COLUMNS["orders"]}, "archive", None, ROWS_PER_BLOCK)
    catalog = tables.kept(_catalog(spark, sf).unionByName(twin), f"{root}/catalog")
    samples = lambda schema, table, df, key, columns: profile.probe_sample(df, key, TARGET, row_bytes(df, columns)).select(F.lit(schema).alias("schema"), F.lit(table).alias("table"), "pk", "bytes")
    taken = samples("corpus", "documents", found["documents"], "doc_id", COLUMNS["documents"]).unionByName(samples("archive", "documents", found["orders"], "o_orderkey", COLUMNS["orders"]))
    plan = tables.kept(plans.plan_all(catalog, taken, THRESHOLD, MAX_CHUNKS, BLOCKS_PER_CHUNK), f"{root}/plan")
    sources = {f"{_schema(n)}.{n}": load.Source(df, COLUMNS[n], KEYS.get(n), ROWS_PER_BLOCK) for n, df in found.items()}
    sources["archive.documents"] = load.Source(found["orders"], COLUMNS["orders"], "o_orderkey", ROWS_PER_BLOCK)
    done = tables.kept(load.export_all(sources, plan, root), f"{root}/exported")
    marks = ledger.Ledger(spark, f"{root}/ledger")
    marks.create()
    load.load_chunks(spark, _manifest_jobs(spark, done, catalog, root, "run-1"), root, {n: s.columns for n, s in sources.items()}, f"{root}/target", marks, by_schema=True)
    back = {n: ChunkStore(spark, f"{root}/target/{n}").read(s.df.select(*s.columns).schema) for n, s in sources.items()}
    same = reconcile.reconcile(reconcile.fingerprint({n: s.df for n, s in sources.items()}, {n: s.columns for n, s in sources.items()}), reconcile.fingerprint(back, {n: s.columns for n, s in sources.items()}))
    counted = done.groupBy("schema", "table", "strategy").agg(F.sum("n_rows").alias("n_exported"))
    return counted.join(same, F.concat_ws(".", counted["schema"], counted["table"]) == same["table"]).select(counted["schema"], counted["table"], "strategy", "n_exported", F.col("target_rows").alias("n_loaded"), "values_match")


def q_replan_load(spark, sf):
    """A table loaded under one plan, then half and then all of it under another: readers see the first until the second is whole, and never both."""
    root, docs = workspace(spark, "replan"), _documents(spark, sf)
    catalog = tables.kept(profile.profile_tables({"documents": docs}, KEYS, COLUMNS, "corpus", rows_per_block=ROWS_PER_BLOCK), f"{root}/catalog")
    marks, store, out = ledger.Ledger(spark, f"{root}/ledger"), ChunkStore(spark, f"{root}/target/documents"), []
    marks.create()

    def step(name, jobs, export):
        load.load_chunks(spark, jobs, export, COLUMNS, f"{root}/target", marks)
        rows = tables.kept(store.read(docs.schema), f"{root}/{name}")
        out.append(rows.agg(F.lit(name).alias("step"), F.count("*").alias("n_rows"), F.count_distinct("doc_id").alias("n_keys"), F.max("chunk_id").alias("last_chunk")))

    for run, chunks_ in (("first", 5), ("second", 2)):
        plan = tables.kept(plans.plan_even(catalog, 1, chunks_), f"{root}/plan-{run}")
        done = load.export_all({"corpus.documents": load.Source(docs, None, "doc_id")}, plan, f"{root}/{run}-export")
        jobs = _manifest_jobs(spark, done, catalog, f"{root}/{run}-export", run)
        if run == "second":
            step("in part", jobs.where("idx = 0"), f"{root}/{run}-export")
        step(run, jobs, f"{root}/{run}-export")
    step("again", jobs, f"{root}/second-export")
    return reduce(DataFrame.unionByName, out)


def q_chunk_facts(spark, sf):
    """Keys with a wide hole: the export counts what it writes, so chunks without rows are known as empty, aren't missing, and load."""
    root, docs = workspace(spark, "facts"), _documents(spark, sf)
    docs = docs.withColumn("doc_id", F.when(F.col("doc_id") % 2 == 0, F.col("doc_id")).otherwise(F.col("doc_id") + 10_000_000))
    catalog = tables.kept(profile.profile_tables({"documents": docs}, KEYS, COLUMNS, "corpus", rows_per_block=ROWS_PER_BLOCK), f"{root}/catalog")
    plan = tables.kept(plans.plan_even(catalog, 1, 8), f"{root}/plan")
    jobs = tables.kept(_manifest_jobs(spark, load.export_all({"corpus.documents": load.Source(docs, None, "doc_id")}, plan, root), catalog, root, "run-1"), f"{root}/jobs")
    missing = load.missing_chunks(jobs, load.list_chunks(spark, f"{root}/data")).count()
    marks = ledger.Ledger(spark, f"{root}/ledger")
    marks.create()
    load.load_chunks(spark, jobs, root, COLUMNS, f"{root}/target", marks)
    loaded = ChunkStore(spark, f"{root}/target/documents").chunks().select("chunk_key", F.col("n_rows").alias("n_loaded"))
    return jobs.join(loaded, "chunk_key").select("idx", "n_rows", (F.col("n_bytes") > 0).alias("has_file"), "n_loaded", F.lit(missing).cast("long").alias("n_missing"))


def q_block_scan(spark, sf):
    """Orders in four files: each chunk of blocks is read from the files that hold it."""
    path = workspace(spark, "blocks")
    orders = spark.read.parquet(f"{sf}/orders.parquet").select(*COLUMNS["orders"]).withColumn("part", F.col("o_orderkey") % 4)
    orders.repartition("part").sortWithinPartitions("part", "o_orderkey").write.partitionBy("part").parquet(f"{path}/orders")
    pinned = tables.kept(tables.pin_snapshot(spark, {"orders": f"{path}/orders"}), f"{path}/pinned")
    index = tables.kept(tables.block_index(pinned, "orders", ROWS_PER_BLOCK), f"{path}/index")
    catalog = index.agg(F.sum("n_blocks").alias("n_blocks"), F.sum("n_rows").alias("est_rows"), F.sum("n_rows").alias("bytes")).select(F.lit("sales").alias("schema"), F.lit("orders").alias("table"), "*")
    out = []
    for r in plans.plan_blocks(catalog, BLOCKS_PER_CHUNK, MAX_CHUNKS).orderBy("idx").collect():
        rows = tables.scan_blocks(spark, index, ROWS_PER_BLOCK, r.block_start, r.block_end)
        out.append(rows.agg(F.lit(r.idx).alias("chunk_id"), F.count("*").alias("n_rows"), F.min("block").alias("first_block"), F.max("block").alias("last_block"), F.sum("o_orderkey").alias("sum_key")))
    return reduce(DataFrame.unionByName, out)


def q_codecs(spark, sf):
    """Chunks written by default, by an unknown codec's name and by lz4: what the files' names say, and the rows read back."""
    root, orders, out = workspace(spark, "codecs"), spark.read.parquet(f"{sf}/orders.parquet").select(*COLUMNS["orders"]), []
    plan = tables.kept(plans.plan_single(profile.profile_tables({"orders": orders}, schema="sales")), f"{root}/plan")
    for asked in (None, "unknown", "lz4"):
        load.export_all({"sales.orders": load.Source(orders)}, plan, f"{root}/{asked}", asked)
        rows = spark.read.option("recursiveFileLookup", "true").parquet(f"{root}/{asked}/data")
        used = F.regexp_extract(F.col("_metadata.file_name"), r"\.(zstd|lz4)[a-z]*\.parquet$", 1)
        out.append(rows.select(F.lit(asked or "none").alias("asked"), used.alias("codec")).groupBy("asked", "codec").agg(F.count("*").alias("n_rows")))
    return reduce(DataFrame.unionByName, out)


def q_load_table(spark, sf):
    """A load by a list of columns into a table of the catalog that has them in another order, and one column more."""
    path, schema = workspace(spark, "columns"), "target_" + uuid.uuid4().hex
    spark.sql(f"CREATE SCHEMA {schema} LOCATION '{path}/{schema}'")
    spark.sql(f"CREATE TABLE {schema}.rows (note STRING, o_orderstatus STRING, o_orderkey BIGINT, o_custkey BIGINT) USING parquet")
    load.load_table(spark.read.parquet(f"{sf}/orders.parquet").selectExpr("cast(o_orderkey as bigint) o_orderkey", "cast(o_custkey as bigint) o_custkey", "o_orderstatus"), f"{schema}.rows")
    out = tables.kept(spark.table(f"{schema}.rows").groupBy("o_orderstatus").agg(F.count("*").alias("n_rows"), F.count("note").alias("n_notes"), F.sum("o_orderkey").alias("sum_key"), F.sum("o_custkey").alias("sum_cust")), f"{path}/counts")
    load.clean_target(spark, schemas=[schema])
    spark.sql(f"DROP SCHEMA {schema}")
    return out


def q_manifest(spark, sf):
    path = workspace(spark, "manifest")
    catalog = tables.kept(_catalog(spark, sf), f"{path}/catalog")
    plan = plans.plan_even(catalog.where("key_min is not null"), THRESHOLD, MAX_CHUNKS)
    manifest.write_manifest(plans.chunk_paths(plan), catalog, profile.sequence_state(catalog), "run-1", f"{path}/document")
    return plans.plan_jobs(manifest.read_manifest(spark, f"{path}/document")).select("schema", "table", "kind", "idx", "range_start", "range_end", "est_bytes", "est_rows", "file")


def q_export_reload(spark, sf):
    """Exports half of the chunks, stops, resumes by the ledger, and reads all back."""
    path = workspace(spark, "export")
    plan = tables.kept(_balanced(spark, sf), f"{path}/plan")
    rows = chunks.assign_chunks(_documents(spark, sf), "doc_id", plan, piece_bytes=load.PIECE)
    jobs = plan.withColumn("chunk_key", ledger.chunk_key("run-1")).withColumn("chunk_id", F.col("idx"))
    marks = ledger.Ledger(spark, f"{path}/ledger")
    marks.create()
    for n, todo in enumerate((jobs.where("idx % 2 = 0"), jobs)):
        left = tables.kept(ledger.pending(todo, marks.done()), f"{path}/todo-{n}")
        load.redo_chunks(rows, left, f"{path}/data", "lz4")
        marks.mark(left)
    back = spark.read.parquet(f"{path}/data")
    return chunks.chunk_metrics(back.select(*COLUMNS["documents"], F.col("chunk_id").cast("long").alias("chunk_id")))


def q_keys_dup(spark, sf):
    return load.check_keys(spark.read.parquet(f"{sf}/lineitem.parquet"), ["l_orderkey"])


def q_orphans(spark, sf):
    parent = spark.read.parquet(f"{sf}/customer.parquet").where("c_custkey % 7 <> 0")
    return load.check_orphans(spark.read.parquet(f"{sf}/orders.parquet").select("o_orderkey", "o_custkey"), parent, {"o_custkey": "c_custkey"})


def q_sequences(spark, sf):
    """Tables without a key have no value to go on from, which the result says."""
    catalog = _catalog(spark, sf)
    unused = catalog.where("key_max is null").select("schema", "table", F.lit(None).cast("long").alias("last_value"), F.lit(False).alias("is_called"))
    return load.reset_sequences(profile.sequence_state(catalog).unionByName(unused))


VIEW = "SELECT n_name, count(*) AS n_orders, CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS BIGINT) AS cents FROM {orders} JOIN {customer} ON o_custkey = c_custkey JOIN {nation} ON c_nationkey = n_nationkey GROUP BY n_name"


def q_view_refresh(spark, sf):
    found = _tables(spark, sf)
    return load.refresh_view(spark, VIEW, workspace(spark, "view"), **{n: found[n] for n in ("orders", "customer", "nation")})


def _changed(spark, sf):
    """In the copy rows are missing, others have another status, and in some a null and a value have changed places."""
    k, status, priority = F.col("o_orderkey"), F.col("o_orderstatus"), F.col("o_orderpriority")
    raw = spark.read.parquet(f"{sf}/orders.parquet").select(*COLUMNS["orders"])
    orders = raw.withColumn("o_orderstatus", F.when(k % 17 != 0, status))
    swapped = raw.withColumns({"o_orderstatus": F.when(k % 17 == 0, priority).otherwise(status), "o_orderpriority": F.when(k % 17 != 0, priority)})
    return orders, swapped.where("o_orderkey % 11 <> 0").withColumn("o_orderstatus", F.when(k % 13 == 0, F.lit("?")).otherwise(status))


def q_reconcile(spark, sf):
    orders, copy = _changed(spark, sf)
    events = spark.read.parquet(f"{sf}/events.parquet").select(*COLUMNS["events"])
    return reconcile.reconcile(reconcile.fingerprint({"orders": orders, "events": events}), reconcile.fingerprint({"orders": copy, "events": events.repartition(3)}))


def q_changed_rows(spark, sf):
    return reconcile.changed_rows(*_changed(spark, sf), "o_orderkey")


def q_errors(spark, sf):
    return monitor.outcome_rule(monitor.triage_errors(_failures(spark, sf))).select("event_id", "category", "transient", "outcome")


def q_retry_schedule(spark, sf):
    return _naive(monitor.retry_schedule(_failures(spark, sf)).select("event_id", "attempt", "wait_s", "due"))


def q_outcomes(spark, sf):
    return monitor.outcomes(_events(spark, sf))


def q_failed(spark, sf):
    return _naive(monitor.failed_chunks(_events(spark, sf)))


def q_report(spark, sf):
    return monitor.run_report(_events(spark, sf), _catalog(spark, sf))


def q_worker_state(spark, sf):
    events = _events(spark, sf)
    return monitor.worker_state(events, events.where("worker <> 7").select("worker"))


def q_progress(spark, sf):
    return monitor.progress(_events(spark, sf), _jobs(spark, sf))


def q_rolling_speed(spark, sf):
    return monitor.rolling_speed(monitor.samples_of(_events(spark, sf)), 10**9, 10 * HOUR).select("event_id", "run", "done_bytes", "speed", "eta_s")


def q_worker_speed(spark, sf):
    return _naive(monitor.worker_speed(_events(spark, sf), "5 hours"))


def q_idle_gaps(spark, sf):
    return _naive(monitor.idle_gaps(_events(spark, sf), "worker", 2 * HOUR))


def _stream(spark, sf):
    return _as_run(streams.read_stream(spark, f"{sf}/events.parquet"))


def q_stream_window(spark, sf):
    return _naive(streams.drained(streams.stream_speed(_stream(spark, sf), "6 hours", "3 hours", "40 days"), workspace(spark, "window")))


def q_stream_session(spark, sf):
    return _naive(streams.drained(streams.stream_sessions(_stream(spark, sf), "2 hours", "40 days"), workspace(spark, "session")))


def q_stream_state(spark, sf):
    return streams.drained(streams.stream_worker_state(_stream(spark, sf)), workspace(spark, "state"))


def q_stream_late(spark, sf):
    """Append mode, a file a batch: the second brings late rows within the watermark, which count, the third older ones, which don't; two far marks close all windows."""
    path, events = workspace(spark, "late"), _events(spark, sf)
    end = events.agg(F.max("ts")).first()[0]
    day = timedelta(days=1)
    again = events.where(F.col("ts") >= F.lit(end - day / 2))
    old = events.where(F.col("ts") >= F.lit(end - 10 * day)).withColumn("ts", F.col("ts") - F.expr("interval 15 days"))
    for n, rows in enumerate((events, again, old, None, None)):
        if rows is None:
            rows = events.limit(1).withColumns({"run": F.lit(-1).cast("long"), "ts": F.lit(end + (100 + n) * day)})
        rows.withColumn("run", F.col("run").cast("long")).coalesce(1).write.mode("append").parquet(f"{path}/events")
    speed = streams.stream_speed(streams.read_stream(spark, f"{path}/events", 1), "6 hours", "6 hours", "1 day")
    return _naive(streams.drained(speed, path, "append").where("run >= 0"))


def q_scrub_urls(spark, sf):
    own = F.concat(F.lit("db://u"), F.col("page_id"), F.lit(":secret"), F.col("page_id"), F.lit("@host/base"), F.col("page_id"), F.lit("?a=1&sslmode=require&b=2"))
    pages = spark.read.parquet(f"{sf}/pages.parquet").select("page_id", "url").unionByName(spark.read.parquet(f"{sf}/pages.parquet").select("page_id", own.alias("url")))
    return pages.select("page_id", masked_url(F.col("url")).alias("masked"), url_tail(F.col("url")).alias("tail"), url_with_only(F.col("url"), "sslmode").alias("clean"))


def q_schema_export(spark, sf):
    """Exported schemas are applied to the tables with their columns in reverse, and read off the result."""
    found = _tables(spark, sf)
    kept = manifest.export_schemas(found).where("position = 1").select("table", "schema_json").collect()  # a row for each table
    back = {r["table"]: manifest.apply_schema(found[r["table"]].select(*reversed(found[r["table"]].columns)), r["schema_json"]) for r in kept}
    counts = profile.profile_tables(back, columns=COLUMNS).select("table", F.col("est_rows").alias("n_rows"))
    rows = manifest.export_schemas(back).withColumn("type", F.when(F.col("type").startswith("timestamp"), "timestamp").otherwise(F.col("type")))
    return rows.join(counts, "table").select("table", "position", "column", "type", "nullable", "n_rows")


def q_pin(spark, sf):
    """After the pin, orders gets more files, of which pinned reads see nothing, and events is replaced, so its snapshot is lost."""
    path, found = workspace(spark, "pin"), {}
    for n in ("orders", "events"):
        found[n] = f"{path}/{n}"
        spark.read.parquet(f"{sf}/{n}.parquet").select(*COLUMNS[n]).repartition(3).write.parquet(found[n])
    pinned = tables.kept(tables.pin_snapshot(spark, found), f"{path}/pinned")
    spark.read.parquet(f"{sf}/orders.parquet").select(*COLUMNS["orders"]).write.mode("append").parquet(found["orders"])
    spark.read.parquet(f"{sf}/events.parquet").select(*COLUMNS["events"]).where("event_id % 2 = 0").write.mode("overwrite").parquet(found["events"])
    read = [tables.read_or_degrade(spark, pinned, n, p).groupBy("snapshot_lost").agg(F.lit(n).alias("table"), F.count("*").alias("n_read")) for n, p in found.items()]
    rows = pinned.groupBy("table").agg(F.sum("n_rows").alias("n_rows"))
    return rows.join(reduce(DataFrame.unionByName, read), "table")


def q_scrub_passwords(spark, sf):
    """Passwords that hold what ends other parts of a URL, and one without a user."""
    pages = spark.read.parquet(f"{sf}/pages.parquet").select("page_id")
    forms = F.explode(F.array(*[F.struct(F.lit(n).alias("form"), F.lit(f).alias("pattern")) for n, f in _LOGINS.items()]))
    urls = pages.select("page_id", forms.alias("f")).select("page_id", "f.form", F.replace("f.pattern", F.lit("#"), F.col("page_id").cast("string")).alias("url"))
    return urls.select("page_id", "form", masked_url(F.col("url")).alias("masked"), url_tail(F.col("url")).alias("tail"))


#: URLs of logins, # for a number.
_LOGINS = {"slash": "db://u#:pa/ss#@host/base#", "at": "db://u#:p@ss#@host/base#?a=1", "no user": "db://:secret#@host/base#", "question": "db://u#:pa?ss#@host/base#?x=y", "all": "db://u#:p@/?:#@host:5432/base#", "none": "db://host:5432/base#?x=1"}


def q_silences(spark, sf):
    """Workers 0 to 3 die at half-time: their silence lasts to the end."""
    return _naive(monitor.silences(_dying(_events(spark, sf)), seconds=2 * HOUR))


def _dying(events):
    half = events.agg(F.min("ts").alias("_a"), F.max("ts").alias("_b"))
    return events.crossJoin(F.broadcast(half)).where((F.col("worker") > 3) | (F.unix_micros("ts") * 2 < F.unix_micros("_a") + F.unix_micros("_b"))).drop("_a", "_b")  # one row


def q_stream_silences(spark, sf):
    """The same as a stream in append mode: what is reported when the last event has come, ended or not."""
    stream = _stream(spark, sf)
    half = spark.read.parquet(f"{sf}/events.parquet").agg((F.unix_micros(F.min("ts").cast("timestamp")) + F.unix_micros(F.max("ts").cast("timestamp"))).alias("x")).first()[0]
    dying = stream.where((F.col("worker") > 3) | (F.unix_micros("ts") * 2 < half))
    return _naive(streams.drained(streams.stream_silences(dying, "2 hours", "1 hour"), workspace(spark, "silences"), "append"))


def q_multiset_difference(spark, sf):
    """Source and copy with null keys and repeated rows: a plan's digests say which chunks differ, and only those are compared row by row."""
    root, k = workspace(spark, "difference"), F.col("o_orderkey")
    raw = spark.read.parquet(f"{sf}/orders.parquet").select(*COLUMNS["orders"])
    orders = raw.unionAll(raw.where("o_orderkey % 10 = 3")).withColumn("o_orderkey", F.when(k % 50 != 0, k))
    copy = raw.where("o_orderkey % 7 <> 0").unionAll(raw.where("o_orderkey % 15 = 3")).withColumn("o_orderstatus", F.when((k % 50 == 0) | (k % 13 != 0), F.col("o_orderstatus"))).withColumn("o_orderkey", F.when(k % 50 != 0, k))
    plan = tables.kept(plans.plan_even(profile.profile_tables({"orders": orders}, KEYS, COLUMNS, "sales"), THRESHOLD, MAX_CHUNKS), f"{root}/plan")
    same = reconcile.diff_by_chunks(orders, orders.repartition(3), "o_orderkey", plan).select(F.lit("same").alias("side"), "*")
    return reconcile.diff_by_chunks(orders, copy, "o_orderkey", plan).select(F.lit("copy").alias("side"), "*").unionByName(same)


def q_clean(spark, sf):
    """Loads orders twice into a table that clean_target empties between, then has clean_target make its schema anew."""
    path, orders = workspace(spark, "target"), spark.read.parquet(f"{sf}/orders.parquet").select(*COLUMNS["orders"])
    schema = "target_" + uuid.uuid4().hex
    spark.sql(f"CREATE SCHEMA {schema} LOCATION '{path}/{schema}'")
    orders.limit(0).write.saveAsTable(f"{schema}.rows")
    for _ in range(2):
        load.clean_target(spark, tables=[f"{schema}.rows"])
        orders.write.insertInto(f"{schema}.rows")
    out = tables.kept(spark.table(f"{schema}.rows").groupBy("o_orderstatus").agg(F.count("*").alias("n_rows")), f"{path}/counts")
    load.clean_target(spark, schemas=[schema])
    left = spark.sql(f"SHOW TABLES IN {schema}").count()
    spark.sql(f"DROP SCHEMA {schema}")
    return out.withColumn("tables_left", F.lit(left).cast("long"))


def queries() -> dict:
    return {k: v for k, v in globals().items() if k.startswith("q_")}


def _bytes(columns: list[str]) -> str:
    return " + ".join(f"coalesce(strlen(CAST({c} AS VARCHAR)), 0)" for c in columns) + f" + {len(columns)}"


def _catalog_sql() -> str:
    one = "SELECT '{schema}' AS schema, '{t}' AS \"table\", '{kind}' AS kind, count(*) AS est_rows, CAST(coalesce(sum({b}), 0) AS BIGINT) AS bytes, CAST((count(*) + {r} - 1) // {r} AS BIGINT) AS n_blocks, {key} AS key_col, {lo} AS key_min, {hi} AS key_max FROM {t}"
    rows = []
    for t, columns in COLUMNS.items():
        k = KEYS.get(t)
        rows.append(one.format(schema="corpus" if t in CORPUS else "sales", t=t, kind="m" if t in VIEWS else "r", b=_bytes(columns), r=ROWS_PER_BLOCK, key=f"'{k}'" if k else "CAST(NULL AS VARCHAR)", lo=f"CAST(min({k}) AS BIGINT)" if k else "CAST(NULL AS BIGINT)", hi=f"CAST(max({k}) AS BIGINT)" if k else "CAST(NULL AS BIGINT)"))
    return "catalog AS (" + " UNION ALL ".join(rows) + ")"


def _half_up(p: str, d: str) -> str:
    return f"CAST((2 * CAST({p} AS HUGEINT) + {d}) // (2 * CAST({d} AS HUGEINT)) AS BIGINT)"


def oracle_sql() -> dict[str, str]:
    catalog = _catalog_sql()
    even = f"""
n AS (SELECT *, least((bytes + {THRESHOLD} - 1) // {THRESHOLD}, {MAX_CHUNKS}) AS n0, key_max - key_min + 1 AS keys FROM catalog WHERE key_min IS NOT NULL),
w AS (SELECT *, (keys + n0 - 1) // n0 AS width FROM n), x AS (SELECT *, (keys + width - 1) // width AS n1 FROM w),
plan AS (SELECT schema, "table", kind, CAST(i AS BIGINT) AS idx, key_min + i * width AS range_start, least(key_min + (i + 1) * width - 1, key_max) AS range_end,
  CASE WHEN i < n1 - 1 THEN {_half_up("bytes", "n0")} ELSE greatest(bytes - {_half_up("bytes", "n0")} * (n1 - 1), 0) END AS est_bytes,
  CASE WHEN i < n1 - 1 THEN {_half_up("est_rows", "n0")} ELSE greatest(est_rows - {_half_up("est_rows", "n0")} * (n1 - 1), 0) END AS est_rows
  FROM x, range(0, {MAX_CHUNKS}) AS r(i) WHERE i < n1)"""
    with_even = f"WITH {catalog}, {even}"
    b = BLOCKS_PER_CHUNK
    blocks = f"""
n AS (SELECT *, least((n_blocks + {b} - 1) // {b}, {MAX_CHUNKS}) AS n FROM catalog WHERE n_blocks > 0),
plan AS (SELECT schema, "table", CAST(i AS BIGINT) AS idx, CAST(i * {b} AS BIGINT) AS block_start, CASE WHEN i < n - 1 THEN CAST((i + 1) * {b} AS BIGINT) END AS block_end,
  CASE WHEN i < n - 1 THEN {_half_up(f"(bytes * {b})", "n_blocks")} ELSE greatest(bytes - {_half_up(f"(bytes * {b})", "n_blocks")} * (n - 1), 0) END AS est_bytes,
  CASE WHEN i < n - 1 THEN {_half_up(f"(est_rows * {b})", "n_blocks")} ELSE greatest(est_rows - {_half_up(f"(est_rows * {b})", "n_blocks")} * (n - 1), 0) END AS est_rows
  FROM n, range(0, {MAX_CHUNKS}) AS r(i) WHERE i < n)"""
    doc_bytes = _bytes(COLUMNS["documents"])
    probes = lambda t, k, size: f"SELECT DISTINCT '{t}' AS \"table\", s.pk, s.bytes FROM (SELECT min({k}) AS lo, max({k}) AS hi, greatest(1, (max({k}) - min({k})) // {TARGET}) AS step FROM {t}) z, LATERAL (SELECT unnest(generate_series(z.lo, z.hi, z.step)) AS p) q, LATERAL (SELECT {k} AS pk, CAST({size} AS BIGINT) AS bytes FROM {t} WHERE {k} >= q.p ORDER BY {k} LIMIT 1) s"
    greedy = f"""
samples AS (SELECT pk, bytes FROM ({probes("documents", "doc_id", doc_bytes)})),
t AS (SELECT CAST(sum({doc_bytes}) AS BIGINT) AS bytes, count(*) AS est_rows, min(doc_id) AS lo, max(doc_id) AS hi FROM documents),
z AS (SELECT t.*, least((bytes + {THRESHOLD} - 1) // {THRESHOLD}, {MAX_CHUNKS}) AS n, (SELECT CAST(sum(bytes) AS BIGINT) FROM samples) AS total, (SELECT count(*) FROM samples) AS m FROM t),
s AS (SELECT pk, bytes, row_number() OVER (ORDER BY pk) AS i, CAST(sum(bytes) OVER (ORDER BY pk) AS BIGINT) AS cum FROM samples),
walk(i, c, was, pk) AS (SELECT CAST(0 AS BIGINT), CAST(0 AS BIGINT), CAST(0 AS BIGINT), CAST(NULL AS BIGINT) UNION ALL
  SELECT s.i, CASE WHEN walk.c < z.n - 1 AND CAST(s.cum AS HUGEINT) * z.n >= (walk.c + 1) * CAST(z.total AS HUGEINT) THEN walk.c + 1 ELSE walk.c END, walk.c, s.pk FROM walk JOIN s ON s.i = walk.i + 1, z),
own AS (SELECT was AS idx, max(CASE WHEN c > was THEN walk.pk END) AS cut, CAST(sum(bytes) AS BIGINT) AS b, count(*) AS k FROM walk JOIN s USING (i) GROUP BY was),
allc AS (SELECT * FROM own UNION ALL SELECT idx + 1, NULL, 0, 0 FROM own, z WHERE idx = (SELECT max(idx) FROM own) AND cut < z.hi),
est AS (SELECT idx, cut, coalesce(lag(cut) OVER (ORDER BY idx) + 1, z.lo) AS range_start, idx = max(idx) OVER () AS last, z.*, {_half_up("(CAST(b AS HUGEINT) * bytes)", "total")} AS eb, {_half_up("(CAST(k AS HUGEINT) * est_rows)", "m")} AS er FROM allc, z),
plan AS (SELECT idx, range_start, CASE WHEN last THEN hi ELSE cut END AS range_end,
  CASE WHEN last THEN greatest(bytes - CAST(coalesce(sum(eb) OVER (ORDER BY idx ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT), 0) ELSE eb END AS est_bytes,
  CASE WHEN last THEN greatest(est_rows - CAST(coalesce(sum(er) OVER (ORDER BY idx ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT), 0) ELSE er END AS est_rows FROM est),
metrics AS (SELECT idx AS chunk_id, count(*) AS n_rows, CAST(sum({doc_bytes}) AS BIGINT) AS n_bytes FROM documents JOIN plan ON doc_id BETWEEN range_start AND range_end GROUP BY idx)"""
    with_greedy = f"WITH RECURSIVE {greedy}"
    balance = 'SELECT idx AS chunk_id, est_bytes, coalesce(n_bytes, 0) AS n_bytes, est_rows, coalesce(n_rows, 0) AS n_rows FROM plan LEFT JOIN metrics ON idx = chunk_id'
    ev = "ev AS (SELECT event_id, ts, user_id % 3 AS run, user_id % 8 AS worker, event_id % 100 AS job, CASE event_type " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in TYPES.items()) + " END AS type, CAST(floor(value * 100) AS BIGINT) AS bytes FROM events)"
    lst = lambda values, of: "[" + ", ".join(f"'{v}'" for v in values) + f"][CAST({of} % {len(values)} + 1 AS INTEGER)]"
    failures = f"{ev}, fl AS (SELECT *, {lst(CODES, 'event_id')} AS code, {lst(MESSAGES, '(event_id // 7)')} AS message, {lst(CODES, '(event_id // 35)')} AS cause_code, {lst(MESSAGES, '(event_id // 3)')} AS cause_message FROM ev WHERE type = 'failed')"

    def class_of(code: str, message: str) -> str:
        listed = lambda xs: ", ".join(f"'{x}'" for x in xs)
        phrases = " OR ".join(f"contains({message}, '{p}')" for p in monitor.STREAM_PHRASES)
        return f"CASE WHEN {code} IN ({listed(monitor.NETWORK_CODES)}) THEN 'NETWORK' WHEN {code} IN ({listed(monitor.STREAM_CODES)}) THEN 'STREAM' WHEN {code} LIKE '08%' OR {code} LIKE '57%' THEN 'SERVER' WHEN {phrases} THEN 'STREAM' END"

    category = f"coalesce({class_of('code', 'message')}, {class_of('cause_code', 'cause_message')}, 'UNKNOWN')"
    state = "CASE type WHEN 'started' THEN 'working' WHEN 'retrying' THEN 'retrying' ELSE 'idle' END AS status, CASE WHEN type IN ('started', 'retrying') THEN job END AS job"
    latest = "last AS (SELECT *, count(*) OVER (PARTITION BY worker) AS n_events FROM ev QUALIFY row_number() OVER (PARTITION BY worker ORDER BY ts DESC, event_id DESC) = 1)"
    done = "CASE WHEN type IN ('completed', 'skipped') THEN bytes ELSE 0 END"
    stamp = lambda s: f"make_timestamp(CAST({s} AS BIGINT) * 1000000)"
    secs = lambda c: f"epoch_us({c}) // 1000000"
    price = "CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l_discount AS DECIMAL(4,2))) AS DECIMAL(16,4))"
    size = lambda c: f"CASE WHEN {c} < 1024 THEN printf('%d B', {c}) WHEN {c} < 1048576 THEN printf('%.1f KB', {c} / 1024.0) WHEN {c} < 1073741824 THEN printf('%.1f MB', {c} / 1048576.0) ELSE printf('%.2f GB', {c} / 1073741824.0) END"
    span = lambda s: f"CASE WHEN {s} >= 3600 THEN printf('%dh %dm %ds', {s} // 3600, {s} % 3600 // 60, {s} % 60) WHEN {s} >= 60 THEN printf('%dm %ds', {s} // 60, {s} % 60) ELSE printf('%ds', {s}) END"
    declared = " ".join(f"WHEN '{t}' THEN '{k}'" for t, k in KEYS.items())
    ints = {"region": ["r_regionkey"], "nation": ["n_nationkey", "n_regionkey"], "customer": ["c_custkey", "c_nationkey"], "supplier": ["s_suppkey", "s_nationkey"], "part": ["p_partkey", "p_size"], "orders": ["o_orderkey", "o_custkey"], "lineitem": ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"], "events": ["event_id", "user_id"], "documents": ["doc_id", "n_chars"], "embeddings": ["vec_id", "label"], "pages": ["page_id"], "benchmark": ["item_id"], "labels": ["doc_id", "quality", "toxic"], "conversations": ["conv_id", "turn"]}
    candidates = " UNION ALL ".join(f"SELECT '{t}' AS t, '{c}' AS c, {i} AS p, count(*) = count({c}) AND count(*) = count(DISTINCT {c}) AS ok FROM {t}" for t, cs in ints.items() for i, c in enumerate(cs))
    positions = 'SELECT table_name AS "table", CAST(ordinal_position AS BIGINT) AS position, column_name AS "column", CASE data_type WHEN \'VARCHAR\' THEN \'string\' WHEN \'INTEGER\' THEN \'int\' WHEN \'FLOAT[]\' THEN \'array<float>\' WHEN \'DOUBLE[]\' THEN \'array<double>\' ELSE lower(data_type) END AS type, is_nullable = \'YES\' AS nullable FROM information_schema.columns WHERE table_name IN (' + ", ".join(f"'{t}'" for t in COLUMNS) + ")"
    all_columns = {"customer": ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"], "supplier": ["s_suppkey", "s_name", "s_nationkey", "s_acctbal"], "part": ["p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice"], "orders": ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"], "lineitem": ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"], "events": ["event_id", "ts", "user_id", "event_type", "value", "props"], "embeddings": ["vec_id", "embedding", "label"]}
    values = " UNION ALL ".join(f"SELECT '{t}' AS \"table\", '{c}' AS \"column\", count({c}) AS n_values FROM {t}" for t in COLUMNS for c in all_columns.get(t, COLUMNS[t]))
    counts = " UNION ALL ".join(f"SELECT '{t}' AS \"table\", count(*) AS n_rows FROM {t}" for t in COLUMNS)
    dying = "h AS (SELECT epoch_us(min(ts)) + epoch_us(max(ts)) AS x FROM ev), dy AS (SELECT ev.* FROM ev, h WHERE worker > 3 OR epoch_us(ts) * 2 < x)"
    window = f"SELECT run, {stamp(f'({secs("ts")} // 10800 - k) * 10800')} AS window_start, {stamp(f'({secs("ts")} // 10800 - k + 2) * 10800')} AS window_end, count(*) AS n_events, CAST(sum(bytes) AS BIGINT) AS bytes FROM ev, range(0, 2) AS r(k) GROUP BY ALL"
    return {
        "q_table_profile": f"WITH {catalog} SELECT * FROM catalog",
        "q_top_tables": f'WITH {catalog} SELECT "table", bytes FROM catalog ORDER BY bytes DESC, "table" LIMIT 5',
        "q_catalog_totals": f"WITH {catalog} SELECT count(*) AS n_tables, CAST(sum(bytes) AS BIGINT) AS bytes, CAST(sum(est_rows) AS BIGINT) AS est_rows FROM catalog",
        "q_columns": f"SELECT c.\"table\", c.position, c.\"column\", c.\"table\" = 'documents' AND c.\"column\" = 'n_chars' AS generated, v.n_values FROM ({positions}) c JOIN ({values}) v USING (\"table\", \"column\")",
        "q_column_lists": f"WITH c AS (SELECT *, (\"table\" = 'documents' AND \"column\" = 'n_chars') OR (\"table\" = 'orders' AND \"column\" IN ('o_orderdate', 'o_totalprice')) AS made FROM ({positions})) SELECT \"table\", coalesce(string_agg(\"column\", ',' ORDER BY position) FILTER (NOT made), '') AS columns, coalesce(string_agg(\"column\", ',' ORDER BY position) FILTER (made), '') AS generated FROM c GROUP BY \"table\"",
        "q_key_candidates": f"SELECT t AS \"table\", CASE WHEN ok THEN c END AS key_col FROM ({candidates}) QUALIFY row_number() OVER (PARTITION BY t ORDER BY NOT ok, c <> coalesce(CASE t {declared} END, ''), p) = 1",
        "q_key_bounds": "SELECT min(doc_id) AS key_min, max(doc_id) AS key_max FROM documents",
        "q_row_bytes": " UNION ALL ".join(f"SELECT '{t}' AS \"table\", count(*) AS n_rows, CAST(sum({_bytes(COLUMNS[t])}) AS BIGINT) AS n_bytes FROM {t}" for t in ("documents", "benchmark", "pages")),
        "q_probe_sample": f"{probes('labels', 'doc_id', _bytes(COLUMNS['labels']))} UNION ALL {probes('documents', 'doc_id', doc_bytes)}",
        "q_assert_schema": f"WITH {catalog} SELECT schema, count(*) AS n_tables, CAST(sum(est_rows) AS BIGINT) AS n_rows FROM catalog GROUP BY schema",
        "q_populated": f"WITH {catalog} SELECT count(*) AS n_tables, count(*) > 0 AS populated FROM catalog WHERE est_rows > 0",
        "q_strategy": f"WITH {catalog} SELECT schema, \"table\", CASE WHEN bytes < {THRESHOLD} THEN 'single' WHEN key_min IS NOT NULL THEN 'key_range' WHEN n_blocks > 0 THEN 'block_range' ELSE 'single' END AS strategy FROM catalog",
        "q_plan_single": f'WITH {catalog} SELECT schema, "table", CAST(0 AS BIGINT) AS idx, bytes AS est_bytes, est_rows FROM catalog',
        "q_plan_even": f'{with_even} SELECT schema, "table", idx, range_start, range_end, est_bytes, est_rows FROM plan',
        "q_plan_blocks": f"WITH {catalog}, {blocks} SELECT * FROM plan",
        "q_plan_balanced": f"{with_greedy} SELECT * FROM plan",
        "q_plan_audit": f'{with_even}, bad AS (SELECT schema, "table", idx, range_start, range_end, CASE WHEN "table" = {chr(39)}events{chr(39)} AND idx = 0 THEN -est_bytes ELSE est_bytes END AS est_bytes, CASE WHEN "table" = {chr(39)}labels{chr(39)} AND idx = 0 THEN est_rows + 1 ELSE est_rows END AS est_rows FROM plan WHERE NOT ("table" = {chr(39)}documents{chr(39)} AND idx = 1) AND NOT ("table" = {chr(39)}pages{chr(39)} AND idx = 0)), steps AS (SELECT *, lag(range_end) OVER (PARTITION BY schema, "table" ORDER BY idx) AS was FROM bad) SELECT p.schema, p."table", count(*) AS n_chunks, bool_and(coalesce(idx = 0 OR range_start = was + 1, false)) AS contiguous, min(range_start) = any_value(c.key_min) AND max(range_end) = any_value(c.key_max) AS bounds_match, sum(p.est_bytes) = any_value(c.bytes) AND sum(p.est_rows) = any_value(c.est_rows) AS sums_match, min(p.est_bytes) >= 0 AND min(p.est_rows) >= 0 AS none_negative FROM steps p JOIN catalog c ON p.schema = c.schema AND p."table" = c."table" GROUP BY p.schema, p."table"',
        "q_strategy_mix": f"WITH {catalog} SELECT strategy, count(*) AS n_tables FROM (SELECT CASE WHEN bytes < {THRESHOLD} THEN 'single' WHEN key_min IS NOT NULL THEN 'key_range' WHEN n_blocks > 0 THEN 'block_range' ELSE 'single' END AS strategy FROM catalog) GROUP BY strategy",
        "q_fill_estimates": f'{with_even}, c AS (SELECT "table", bytes AS tb, est_rows AS tr FROM catalog) SELECT schema, "table", idx, CASE WHEN idx % 2 = 0 THEN est_bytes ELSE {_half_up("tb", "count(*) OVER (PARTITION BY schema, \"table\")")} END AS est_bytes, CASE WHEN idx % 2 = 0 THEN est_rows ELSE {_half_up("tr", "count(*) OVER (PARTITION BY schema, \"table\")")} END AS est_rows FROM plan JOIN c USING ("table")',
        "q_job_order": f"{with_even} SELECT row_number() OVER (ORDER BY est_bytes DESC, schema, \"table\", idx) AS place, 'data/' || schema || '.' || \"table\" || printf('/chunk_%04d.parquet.zstd', idx) AS file, est_bytes FROM plan",
        "q_chunk_rows": f"{with_greedy} SELECT chunk_id, n_rows, n_bytes FROM metrics",
        "q_chunk_balance": f"{with_greedy} {balance}",
        "q_balance_ratio": f"{with_greedy}, b AS ({balance}) SELECT count(*) AS n_chunks, CAST(sum(n_bytes) AS BIGINT) AS n_bytes, max(n_bytes) AS largest, CAST(max(n_bytes) * 1000 * count(*) // sum(n_bytes) AS BIGINT) AS max_over_mean_milli FROM b",
        "q_null_key": f"{with_even} SELECT idx AS chunk_id, count(*) AS n_rows, count(*) FILTER (d.doc_id IS NULL) AS n_null FROM (SELECT CASE WHEN doc_id % 50 <> 0 THEN doc_id END AS doc_id FROM documents) d JOIN plan p ON p.\"table\" = 'documents' AND CASE WHEN d.doc_id IS NULL THEN p.idx = 0 ELSE d.doc_id BETWEEN p.range_start AND p.range_end END GROUP BY idx",
        "q_key_range": f"{with_even} SELECT p.idx AS chunk_id, count(d.doc_id) AS n_rows, CAST(sum(n_chars) AS BIGINT) AS n_chars FROM plan p LEFT JOIN documents d ON doc_id BETWEEN p.range_start AND p.range_end WHERE p.\"table\" = 'documents' GROUP BY p.idx",
        "q_block_rows": f"WITH {catalog}, {blocks}, n2 AS (SELECT count(*) AS n FROM orders), r AS (SELECT i // {ROWS_PER_BLOCK} AS block FROM n2, range(0, 1000000000) AS z(i) WHERE false UNION ALL SELECT unnest(generate_series(0, n - 1)) // {ROWS_PER_BLOCK} FROM n2) SELECT idx AS chunk_id, count(*) AS n_rows, CAST(min(block) AS BIGINT) AS first_block, CAST(max(block) AS BIGINT) AS last_block FROM r JOIN plan ON \"table\" = 'orders' AND block >= block_start AND (block_end IS NULL OR block < block_end) GROUP BY idx",
        "q_generated": "SELECT 'disc_price' AS \"column\", count(*) AS n_rows, count(*) FILTER (l_orderkey % 97 = 0) AS n_null, count(*) FILTER (l_orderkey % 97 = 0 OR l_orderkey % 89 = 0) AS n_different FROM lineitem",
        "q_recomputed": f"SELECT l_linenumber, count(*) AS n_rows, CAST(sum({price}) * 10000 AS BIGINT) AS disc_price_x10000 FROM lineitem GROUP BY l_linenumber",
        "q_select_tables": f"WITH {catalog} SELECT schema, \"table\", est_rows FROM catalog WHERE schema = 'sales' OR \"table\" = 'labels'",
        "q_loadable": f"WITH {catalog} SELECT schema, \"table\", kind, est_rows FROM catalog WHERE kind <> 'm'",
        "q_jdbc_chunks": f"{with_even} SELECT p.idx AS chunk_id, count(*) AS n_rows, min(o_orderkey) AS first_key, max(o_orderkey) AS last_key, CAST(sum(o_custkey) AS BIGINT) AS sum_custkey FROM plan p JOIN orders ON p.\"table\" = 'orders' AND CASE WHEN o_orderkey IS NULL THEN p.idx = 0 ELSE o_orderkey BETWEEN p.range_start AND p.range_end END GROUP BY p.idx",
        "q_jdbc_load": "SELECT o_orderstatus, count(*) AS n_rows, count(*) AS n_default, CAST(sum(o_orderkey) AS BIGINT) AS sum_key, false AS again, true AS all_marked FROM orders GROUP BY o_orderstatus",
        "q_pending": f'{with_even} SELECT schema, "table", idx, est_rows FROM plan WHERE idx % 3 <> 0',
        "q_preview": f'{with_even} SELECT schema, "table", idx, idx % 3 = 0 AS done FROM plan',
        "q_missing_chunks": f"{with_even} SELECT 'data/corpus.documents/chunk_id=' || idx AS file, 'exported' AS status FROM plan WHERE \"table\" = 'documents' AND idx % 4 = 1 AND EXISTS (SELECT 1 FROM documents WHERE doc_id BETWEEN range_start AND range_end)",
        "q_load_resume": f"{with_even} " + " UNION ALL ".join(f"SELECT '{t}' AS \"table\", p.idx AS chunk_id, count(*) AS n_rows, min({k}) AS first_key, max({k}) AS last_key, CAST(1 AS BIGINT) AS n_marks FROM plan p JOIN {t} ON p.\"table\" = '{t}' AND {k} BETWEEN range_start AND range_end GROUP BY p.idx" for t, k in _LOADED.items()),
        "q_stream_late": f"WITH {ev}, m AS (SELECT max(ts) AS mx FROM ev), a AS (SELECT ev.* FROM ev UNION ALL SELECT ev.* FROM ev, m WHERE ts >= mx - INTERVAL 12 HOUR) SELECT CAST(run AS BIGINT) AS run, {stamp(f'({secs("ts")} // 21600) * 21600')} AS window_start, {stamp(f'({secs("ts")} // 21600 + 1) * 21600')} AS window_end, count(*) AS n_events, CAST(sum(bytes) AS BIGINT) AS bytes FROM a GROUP BY ALL",
        "q_manifest": f"{with_even} SELECT schema, \"table\", kind, idx, range_start, range_end, est_bytes, est_rows, 'data/' || schema || '.' || \"table\" || printf('/chunk_%04d.parquet.zstd', idx) AS file FROM plan",
        "q_export_reload": f"{with_greedy} SELECT chunk_id, n_rows, n_bytes FROM metrics",
        "q_keys_dup": "SELECT l_orderkey, count(*) AS n_rows FROM lineitem GROUP BY l_orderkey HAVING count(*) > 1",
        "q_orphans": "SELECT o_custkey, o_orderkey FROM orders WHERE o_custkey IS NOT NULL AND NOT EXISTS (SELECT 1 FROM customer WHERE c_custkey = o_custkey AND c_custkey % 7 <> 0)",
        "q_sequences": f'WITH {catalog} SELECT schema, "table", key_max + 1 AS next_value, key_max IS NOT NULL AS ok FROM catalog',
        "q_view_refresh": VIEW.format(orders="orders", customer="customer", nation="nation"),
        "q_reconcile": "SELECT 'orders' AS \"table\", count(*) AS source_rows, count(*) FILTER (o_orderkey % 11 <> 0) AS target_rows, count(*) FILTER (o_orderkey % 11 = 0) = 0 AS rows_match, count(*) FILTER (o_orderkey % 11 = 0 OR o_orderkey % 13 = 0 OR o_orderkey % 17 = 0) = 0 AS values_match FROM orders UNION ALL SELECT 'events', count(*), count(*), true, true FROM events",
        "q_changed_rows": "SELECT o_orderkey, CASE WHEN o_orderkey % 11 = 0 THEN 'missing' ELSE 'changed' END AS difference FROM orders WHERE o_orderkey % 11 = 0 OR (o_orderkey % 13 = 0 AND o_orderstatus <> '?') OR o_orderkey % 17 = 0",
        "q_errors": f"WITH {failures}, c AS (SELECT event_id, {category} AS category FROM fl) SELECT event_id, category, category <> 'UNKNOWN' AS transient, CASE WHEN category <> 'UNKNOWN' THEN 'retrying' ELSE 'failed' END AS outcome FROM c",
        "q_retry_schedule": f"WITH {failures}, a AS (SELECT event_id, ts, row_number() OVER (PARTITION BY run, job ORDER BY ts, event_id) - 1 AS attempt FROM fl), w AS (SELECT *, CAST(least(5 * (1 << CAST(least(attempt, 5) AS INTEGER)), 60) AS BIGINT) AS wait_s FROM a) SELECT event_id, attempt, wait_s, ts + to_seconds(wait_s) AS due FROM w",
        "q_outcomes": f"WITH {ev} SELECT run, type, count(*) AS n, CAST(sum(bytes) AS BIGINT) AS bytes FROM ev GROUP BY run, type",
        "q_failed": f"WITH {ev} SELECT run, job, 'chunk ' || job || ' of run ' || run AS label, count(*) FILTER (type = 'failed') AS n_failed, max(ts) AS ts FROM ev GROUP BY run, job HAVING arg_max(type, (ts, event_id)) = 'failed'",
        "q_report": f"WITH {ev}, {catalog}, r AS (SELECT run, count(*) FILTER (type IN ('completed', 'skipped')) AS succeeded, count(*) FILTER (type = 'skipped') AS skipped, count(*) FILTER (type = 'failed') AS failed, CAST({secs('max(ts)')} - {secs('min(ts)')} AS BIGINT) AS s, CAST(sum({done}) AS BIGINT) AS b FROM ev GROUP BY run), t AS (SELECT count(*) AS n_tables, CAST(sum(bytes) AS BIGINT) AS total FROM catalog) SELECT run, n_tables, succeeded, skipped, failed, {span('s')} AS duration, {size('b')} AS size, CAST(least(b * 100 // total, 100) AS BIGINT) AS percent FROM r, t",
        "q_worker_state": f"WITH {ev}, {latest} SELECT worker, {state}, CASE WHEN type = 'started' THEN bytes ELSE 0 END AS progress, n_events FROM last WHERE worker <> 7",
        "q_progress": f"WITH {ev}, jobs AS (SELECT job, CAST(sum(bytes) // count(*) AS BIGINT) AS est_bytes FROM ev GROUP BY job), d AS (SELECT run, CAST(sum({done}) AS BIGINT) AS done_bytes FROM ev GROUP BY run), l AS (SELECT * FROM ev QUALIFY row_number() OVER (PARTITION BY run, worker ORDER BY ts DESC, event_id DESC) = 1), o AS (SELECT run, CAST(sum(least(bytes, est_bytes)) AS BIGINT) AS b FROM l JOIN jobs USING (job) WHERE type = 'started' GROUP BY run), t AS (SELECT CAST(sum(est_bytes) AS BIGINT) AS total_bytes FROM jobs) SELECT run, done_bytes, coalesce(b, 0) AS open_bytes, least(done_bytes + coalesce(b, 0), total_bytes) AS effective_bytes, total_bytes FROM d LEFT JOIN o USING (run), t",
        "q_rolling_speed": f"WITH {ev}, s AS (SELECT *, CAST(sum({done}) OVER (PARTITION BY run ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS done_bytes FROM ev), f AS (SELECT *, done_bytes - min(done_bytes) OVER w AS gained, greatest(1000000, epoch_us(ts) - min(epoch_us(ts)) OVER w) AS since FROM s WINDOW w AS (PARTITION BY run ORDER BY ts RANGE BETWEEN INTERVAL 10 HOUR PRECEDING AND CURRENT ROW)) SELECT event_id, run, done_bytes, CAST(gained * 1000000 // since AS BIGINT) AS speed, CASE WHEN gained > 0 THEN greatest(CAST((CAST(1000000000 - done_bytes AS HUGEINT) * since + gained * CAST(1000000 AS HUGEINT) - 1) // (gained * CAST(1000000 AS HUGEINT)) AS BIGINT), 0) ELSE 0 END AS eta_s FROM f",
        "q_worker_speed": f"WITH {ev}, b AS (SELECT worker, {secs('ts')} // 18000 * 18000 AS s, CAST(sum(bytes) AS BIGINT) AS bytes FROM ev GROUP BY ALL) SELECT worker, {stamp('s')} AS bucket_start, bytes, CAST(bytes // (s - lag(s) OVER (PARTITION BY worker ORDER BY s)) AS BIGINT) AS speed FROM b",
        "q_idle_gaps": f"WITH {ev}, g AS (SELECT worker, lag(ts) OVER (PARTITION BY worker ORDER BY ts, event_id) AS gap_from, ts AS gap_to FROM ev) SELECT *, CAST({secs('gap_to')} - {secs('gap_from')} AS BIGINT) AS gap_s FROM g WHERE {secs('gap_to')} - {secs('gap_from')} >= {2 * HOUR}",
        "q_stream_window": f"WITH {ev} {window}",
        "q_stream_session": f"WITH {ev}, g AS (SELECT *, CASE WHEN ts - lag(ts) OVER w < INTERVAL 2 HOUR THEN 0 ELSE 1 END AS new FROM ev WINDOW w AS (PARTITION BY worker ORDER BY ts, event_id)), n AS (SELECT *, sum(new) OVER (PARTITION BY worker ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS k FROM g) SELECT worker, min(ts) AS session_start, max(ts) + INTERVAL 2 HOUR AS session_end, count(*) AS n_events, CAST(sum(bytes) AS BIGINT) AS bytes FROM n GROUP BY worker, k",
        "q_stream_state": f"WITH {ev}, {latest} SELECT worker, {state}, n_events FROM last",
        "q_scrub_urls": "WITH p AS (SELECT page_id, url FROM pages UNION ALL SELECT page_id, 'db://u' || page_id || ':secret' || page_id || '@host/base' || page_id || '?a=1&sslmode=require&b=2' FROM pages) SELECT page_id, regexp_replace(regexp_replace(url, '://([^:]+):[^@]+@', '://\\1:***@', 'g'), '\\?.*', '', 'g') AS masked, regexp_extract(url, '/([^/?]+)(?:\\?.*)?$', 1) AS tail, split_part(url, '?', 1) || coalesce('?' || list_filter(string_split(CASE WHEN contains(url, '?') THEN split_part(url, '?', 2) END, '&'), lambda x: starts_with(lower(x), 'sslmode='))[1], '') AS clean FROM p",
        "q_schema_export": f"SELECT c.\"table\", c.position, c.\"column\", c.type, c.nullable, n.n_rows FROM ({positions}) c JOIN ({counts}) n USING (\"table\")",
        "q_pin": "SELECT 'orders' AS \"table\", count(*) AS n_rows, count(*) AS n_read, false AS snapshot_lost FROM orders UNION ALL SELECT 'events', count(*), count(*) FILTER (event_id % 2 = 0), true FROM events",
        "q_export_all": f"WITH {catalog}, every AS (SELECT * FROM catalog UNION ALL SELECT 'archive', 'documents', kind, est_rows, bytes, n_blocks, key_col, key_min, key_max FROM catalog WHERE \"table\" = 'orders') SELECT schema, \"table\", CASE WHEN bytes < {THRESHOLD} THEN 'single' WHEN key_min IS NOT NULL THEN 'key_range' WHEN n_blocks > 0 THEN 'block_range' ELSE 'single' END AS strategy, est_rows AS n_exported, est_rows AS n_loaded, true AS values_match FROM every",
        "q_replan_load": "WITH n AS (SELECT count(*) AS n_rows, count(DISTINCT doc_id) AS n_keys FROM documents) SELECT step, n_rows, n_keys, CAST(last_chunk AS BIGINT) AS last_chunk FROM n, (VALUES ('first', 4), ('in part', 4), ('second', 1), ('again', 1)) AS s(step, last_chunk)",
        "q_chunk_facts": "WITH d AS (SELECT CASE WHEN doc_id % 2 = 0 THEN doc_id ELSE doc_id + 10000000 END AS k FROM documents), z AS (SELECT min(k) AS lo, (max(k) - min(k) + 8) // 8 AS width FROM d), p AS (SELECT CAST(i AS BIGINT) AS idx, lo + i * width AS s, lo + (i + 1) * width AS e FROM z, range(0, 8) AS r(i)), c AS (SELECT idx, count(k) AS n FROM p LEFT JOIN d ON k >= s AND k < e GROUP BY idx) SELECT idx, n AS n_rows, n > 0 AS has_file, n AS n_loaded, CAST(0 AS BIGINT) AS n_missing FROM c",
        "q_block_scan": f"WITH o AS (SELECT o_orderkey AS k, o_orderkey % 4 AS part, (row_number() OVER (PARTITION BY o_orderkey % 4 ORDER BY o_orderkey) - 1) // {ROWS_PER_BLOCK} AS b FROM orders), f AS (SELECT part, max(b) + 1 AS n FROM o GROUP BY part), g AS (SELECT part, n, coalesce(sum(n) OVER (ORDER BY part ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS first FROM f), t AS (SELECT least((sum(n) + {b} - 1) // {b}, {MAX_CHUNKS}) AS n_chunks FROM f), r AS (SELECT k, CAST(b + first AS BIGINT) AS block, CAST(least((b + first) // {b}, n_chunks - 1) AS BIGINT) AS chunk_id FROM o JOIN g USING (part), t) SELECT chunk_id, count(*) AS n_rows, min(block) AS first_block, max(block) AS last_block, CAST(sum(k) AS BIGINT) AS sum_key FROM r GROUP BY chunk_id",
        "q_codecs": "SELECT asked, codec, n AS n_rows FROM (SELECT count(*) AS n FROM orders), (VALUES ('none', 'zstd'), ('unknown', 'zstd'), ('lz4', 'lz4')) AS v(asked, codec)",
        "q_load_table": "SELECT o_orderstatus, count(*) AS n_rows, CAST(0 AS BIGINT) AS n_notes, CAST(sum(o_orderkey) AS BIGINT) AS sum_key, CAST(sum(o_custkey) AS BIGINT) AS sum_cust FROM orders GROUP BY o_orderstatus",
        "q_scrub_passwords": "SELECT page_id, form, replace(masked, '#', CAST(page_id AS VARCHAR)) AS masked, 'base' || page_id AS tail FROM pages, (VALUES ('slash', 'db://u#:***@host/base#'), ('at', 'db://u#:***@host/base#'), ('no user', 'db://:***@host/base#'), ('question', 'db://u#:***@host/base#'), ('all', 'db://u#:***@host:5432/base#'), ('none', 'db://host:5432/base#')) AS v(form, masked)",
        "q_silences": f"WITH {ev}, {dying}, g AS (SELECT worker, lag(ts) OVER (PARTITION BY worker ORDER BY ts, event_id) AS gap_from, ts AS gap_to, false AS lasts, ts AS until FROM dy UNION ALL SELECT worker, max(ts), NULL, true, (SELECT max(ts) FROM dy) FROM dy GROUP BY worker) SELECT worker, gap_from, gap_to, CAST({secs('until')} - {secs('gap_from')} AS BIGINT) AS gap_s, lasts FROM g WHERE {secs('until')} - {secs('gap_from')} >= {2 * HOUR}",
        "q_stream_silences": f"WITH {ev}, {dying}, g AS (SELECT *, CASE WHEN ts - lag(ts) OVER w < INTERVAL 2 HOUR THEN 0 ELSE 1 END AS new FROM dy WINDOW w AS (PARTITION BY worker ORDER BY ts, event_id)), n AS (SELECT *, sum(new) OVER (PARTITION BY worker ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS k FROM g), s AS (SELECT worker, max(ts) AS silent_since, count(*) AS n_events FROM n GROUP BY worker, k) SELECT * FROM s WHERE epoch_ms(silent_since + INTERVAL 2 HOUR) <= epoch_ms((SELECT max(ts) FROM dy) - INTERVAL 1 HOUR)",
        "q_multiset_difference": "WITH raw AS (SELECT o_orderkey AS i, o_custkey, o_orderstatus, o_orderpriority FROM orders), s AS (SELECT CASE WHEN i % 50 <> 0 THEN i END AS o_orderkey, o_custkey, o_orderstatus, o_orderpriority FROM (SELECT * FROM raw UNION ALL SELECT * FROM raw WHERE i % 10 = 3)), t AS (SELECT CASE WHEN i % 50 <> 0 THEN i END AS o_orderkey, o_custkey, CASE WHEN i % 50 = 0 OR i % 13 <> 0 THEN o_orderstatus END AS o_orderstatus, o_orderpriority FROM (SELECT * FROM raw WHERE i % 7 <> 0 UNION ALL SELECT * FROM raw WHERE i % 15 = 3)), m AS (SELECT o_orderkey, count(*) AS n FROM (SELECT * FROM s EXCEPT ALL SELECT * FROM t) GROUP BY o_orderkey), e AS (SELECT o_orderkey, count(*) AS n FROM (SELECT * FROM t EXCEPT ALL SELECT * FROM s) GROUP BY o_orderkey) SELECT 'copy' AS side, coalesce(m.o_orderkey, e.o_orderkey) AS o_orderkey, CASE WHEN e.n IS NULL THEN 'missing' WHEN m.n IS NULL THEN 'extra' ELSE 'changed' END AS difference, coalesce(m.n, 0) AS n_missing, coalesce(e.n, 0) AS n_extra FROM m FULL JOIN e ON m.o_orderkey IS NOT DISTINCT FROM e.o_orderkey",
        "q_clean": "SELECT o_orderstatus, count(*) AS n_rows, CAST(0 AS BIGINT) AS tables_left FROM orders GROUP BY o_orderstatus",
    }
