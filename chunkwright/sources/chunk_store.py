"""A table as chunks behind a commit log, so that a load may be repeated, stopped anywhere and replaced by one of another plan."""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chunkwright.sources.tables import codec_or_default, delete_path, gathered, path_exists

LOG = "seq long, kind string, owner string, plan string, chunk_key string, chunk_id long, folder string, n_rows long, n_bytes long, at timestamp"
#: Chunks that one write can count exactly.
MOST_CHUNKS = 400_000


def write_counted(df: DataFrame, path: str, n_chunks: int, codec: str | None = None, overwrite: bool = False, gather: bool = False) -> tuple[dict[int, int], dict[int, int]]:
    """Writes df by chunk_id, a folder for each, and returns the rows and the bytes of files of each chunk that has any.

    Rows are counted by the write itself: an observed frequency sketch over chunk_id, which is exact below the number of
    items that it tracks, twice the chunks of the plan. It stands in the job's last stage, where a task's count is taken once.
    Bytes are what the store lists. With overwrite, folders of chunks that are in df are replaced and others stay.

    With gather, a chunk's rows are shuffled together, so that a chunk is one file, or several where it is larger than Spark's advisory
    size of a partition: adaptive execution deals it to several tasks, or where df has _piece, as assign_chunks cuts chunks. Without,
    each task writes a file for each chunk that it meets and nothing is shuffled: right where tasks meet few chunks, as those of blocks and of chunks that are read from their folders.
    """
    if n_chunks > MOST_CHUNKS:
        raise ValueError(f"{n_chunks} chunks in one write: use a larger threshold or several writes")
    seen, tracked = Observation(), max(64, 2 * n_chunks)
    out = (gathered(df, ("chunk_id",)) if gather else df).observe(seen, F.count("*").alias("n"), F.expr(f"approx_top_k(chunk_id, {tracked}, {tracked})").alias("each"))
    writer = out.write.partitionBy("chunk_id").option("compression", codec_or_default(codec))
    (writer.mode("overwrite").option("partitionOverwriteMode", "dynamic") if overwrite else writer).parquet(path)
    got = seen.get
    rows = {e["item"]: e["count"] for e in got["each"] or []}
    if sum(rows.values()) != got["n"]:
        raise ValueError("rows without a chunk, or chunks that the plan doesn't have")
    spark = df.sparkSession
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(path)
    sizes = files.select(F.regexp_extract("path", r"/chunk_id=(-?\d+)/", 1).cast("long").alias("c"), "length").groupBy("c").agg(F.sum("length").alias("n"))
    return rows, {r.c: r.n for r in sizes.collect() if r.c in rows}


@dataclass
class State:
    """What a log says: the plan that readers see, and for each plan the last commit of each chunk that still counts."""

    published: str | None = None
    held: dict[str, dict[str, Row]] = field(default_factory=dict)
    retired: list[str | None] = field(default_factory=list)
    last: int = 0


class ChunkStore:
    """The chunks of one table in a folder: `write=<id>/chunk_id=<n>/` with data, `_commits` with the log.

    A write puts its chunks in a folder of its own and then appends one file to the log, which says which chunks
    they are and of which plan. Later commits of a chunk replace earlier ones. When all chunks of a plan are there, the
    same file publishes it: from then on readers see this plan only, and chunks of others no longer count. So a
    run that stops before the log is written changes nothing, and one that stops behind it has done its work; a
    load under another plan leaves the old rows until it is complete and never mixes with them.

    The log has a row for each chunk of a threshold of bytes and is read by the driver, as a scan's list of files is. One
    run loads a table at a time.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def log(self) -> DataFrame:
        if not path_exists(self.spark, f"{self.path}/_commits"):
            return self.spark.createDataFrame([], LOG)
        return self.spark.read.schema(LOG).parquet(f"{self.path}/_commits")

    def state(self, owner: str | None = None) -> State:
        """owner, if given, must be the table that the log is of."""
        out = State()
        for r in sorted(self.log().collect(), key=lambda r: (r.seq, r.kind == "publish")):
            if owner is not None and r.owner != owner:
                raise ValueError(f"{self.path} has chunks of {r.owner}, not of {owner}")
            out.last = r.seq
            if r.kind == "publish":
                out.retired += [self._place(c) for p, chunks in out.held.items() if p != r.plan for c in chunks.values()]
                out.published, out.held = r.plan, {r.plan: out.held.get(r.plan, {})}
                continue
            chunks = out.held.setdefault(r.plan, {})
            if r.chunk_key in chunks:
                out.retired.append(self._place(chunks[r.chunk_key]))
            chunks[r.chunk_key] = r
        out.retired = sorted({p for p in out.retired if p})
        return out

    @staticmethod
    def _place(chunk: Row) -> str | None:
        """Where a chunk's files are; None for a chunk without rows."""
        return f"{chunk.folder}/chunk_id={chunk.chunk_id}" if chunk.folder else None

    def write(self, df: DataFrame | None, chunks: dict[str, int], owner: str, plan: str, n_plan: int, codec: str | None = None) -> None:
        """Writes df (with chunk_id; None: no rows) as these chunks (key: id) of a plan of n_plan chunks. Chunks without rows are committed as empty."""
        folder = f"write={uuid.uuid4().hex}"
        rows, sizes = write_counted(df, f"{self.path}/{folder}", len(chunks), codec) if df is not None else ({}, {})
        if not set(rows) <= set(chunks.values()):
            raise ValueError(f"rows of other chunks: {sorted(set(rows) - set(chunks.values()))[:9]}")
        before = self.state(owner)
        seq, held = before.last + 1, {**before.held.get(plan, {}), **chunks}
        log = [(seq, "chunk", owner, plan, k, i, folder if i in rows else None, rows.get(i, 0), sizes.get(i, 0)) for k, i in chunks.items()]
        if len(held) >= n_plan and before.published != plan:
            log.append((seq, "publish", owner, plan, None, None, None, None, None))
        self._append(log)
        self.sweep()

    def _append(self, log: list[tuple]) -> None:
        new = self.spark.createDataFrame(log, T.StructType(T._parse_datatype_string(LOG).fields[:-1])).withColumn("at", F.current_timestamp())
        new.coalesce(1).write.mode("append").parquet(f"{self.path}/_commits")  # one file, so whole or absent

    def sweep(self) -> None:
        """Deletes chunks that the log no longer counts, for readers that don't know of it; a write's whole folder at once where none of its chunks counts."""
        state = self.state()
        live = {c.folder for chunks in state.held.values() for c in chunks.values()}
        for place in sorted({p if p.partition("/")[0] in live else p.partition("/")[0] for p in state.retired}):
            delete_path(self.spark, f"{self.path}/{place}")

    def read(self, schema: T.StructType | str) -> DataFrame:
        """The rows of the published plan with chunk_id."""
        state, full = self.state(), T._parse_datatype_string(schema) if isinstance(schema, str) else schema
        full = T.StructType([f for f in full.fields if f.name != "chunk_id"]).add("chunk_id", "long")
        paths = sorted(p for p in map(self._place, state.held.get(state.published, {}).values()) if p)
        if not paths:
            return self.spark.createDataFrame([], full)
        rows = self.spark.read.schema(full).option("basePath", f"{self.path}").parquet(*[f"{self.path}/{p}" for p in paths])
        return rows.select(*[F.col(f"`{f.name}`") for f in full.fields])

    def chunks(self) -> DataFrame:
        """(chunk_key, chunk_id, n_rows, n_bytes) of the published plan, as counted by the writes."""
        state = self.state()
        rows = [(c.chunk_key, c.chunk_id, c.n_rows, c.n_bytes) for c in state.held.get(state.published, {}).values()]
        return self.spark.createDataFrame(rows, "chunk_key string, chunk_id long, n_rows long, n_bytes long")
