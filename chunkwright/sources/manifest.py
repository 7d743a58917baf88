"""The manifest: one JSON document that names all tables and chunks of an export; and schemas on their own."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

VERSION = 1
CHUNK = "idx: long, range_start: long, range_end: long, block_start: long, block_end: long, est_bytes: long, est_rows: long, file: string, status: string, n_rows: long, n_bytes: long"
_TEXT_CHUNK = "array<struct<" + CHUNK.replace(": long", ": string") + ">>"
_TABLE = f"struct<schema: string, table: string, kind: string, strategy: string, bytes: string, est_rows: string, chunks: {_TEXT_CHUNK}>"
DOCUMENT = f"version long, run_id string, tables array<{_TABLE}>, sequences array<struct<schema: string, table: string, last_value: string, is_called: boolean>>"


def manifest_document(plan: DataFrame, catalog: DataFrame, sequences: DataFrame, run_id: str) -> DataFrame:
    """One row. It holds a plan, a row for each chunk of a threshold of bytes, so its size follows the number of chunks.

    status, n_rows and n_bytes say how a chunk's export went, as export_all counted it, and are null before it.
    """
    names = [c.split(":")[0] for c in CHUNK.split(", ")]
    full = plan.withColumns({c: F.lit(None).cast(t) for c, t in (("status", "string"), ("n_rows", "long"), ("n_bytes", "long")) if c not in plan.columns})
    chunks = full.groupBy("schema", "table", "strategy").agg(F.array_sort(F.collect_list(F.struct(*names))).alias("chunks"))
    tables = chunks.join(catalog.select("schema", "table", "kind", "bytes", "est_rows"), ["schema", "table"])
    listed = tables.agg(F.array_sort(F.collect_list(F.struct("schema", "table", "kind", "strategy", "bytes", "est_rows", "chunks"))).alias("tables"))
    marks = sequences.agg(F.array_sort(F.collect_list(F.struct("schema", "table", "last_value", "is_called"))).alias("sequences"))
    return listed.crossJoin(marks).select(F.lit(VERSION).cast("long").alias("version"), F.lit(run_id).alias("run_id"), "tables", "sequences")  # one row each


def write_manifest(plan: DataFrame, catalog: DataFrame, sequences: DataFrame, run_id: str, path: str) -> None:
    manifest_document(plan, catalog, sequences, run_id).coalesce(1).write.mode("overwrite").json(path)


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """The document with numbers as numbers: bad ones 0, missing and null ones null. Fails on another version, or a file outside its folder."""
    raw = spark.read.schema(DOCUMENT).option("multiLine", "true").json(path)
    escapes = F.exists("tables", lambda t: F.exists(t["chunks"], lambda c: c["file"].rlike(r"(^|/)\.\.(/|$)|^/|^[a-zA-Z]+:")))
    checked = F.when(~F.col("version").eqNullSafe(F.lit(VERSION)), F.raise_error(F.concat(F.lit("manifest version not supported: "), F.coalesce(F.col("version").cast("string"), F.lit("none"))))).when(escapes, F.raise_error(F.lit("a chunk file is outside the export's folder"))).otherwise(F.col("version"))

    def number(c):
        return F.when(c.isNotNull(), F.coalesce(c.try_cast("bigint"), F.lit(0).cast("long")))

    def chunk(c):
        kinds = [x.split(": ") for x in CHUNK.split(", ")]
        return F.struct(*[(number(c[n]) if k == "long" else c[n]).alias(n) for n, k in kinds])

    tables = F.transform("tables", lambda t: F.struct(*[t[n].alias(n) for n in ("schema", "table", "kind", "strategy")], number(t["bytes"]).alias("bytes"), number(t["est_rows"]).alias("est_rows"), F.transform(t["chunks"], chunk).alias("chunks")))
    marks = F.transform("sequences", lambda s: F.struct(s["schema"].alias("schema"), s["table"].alias("table"), number(s["last_value"]).alias("last_value"), s["is_called"].alias("is_called")))
    return raw.select(checked.alias("version"), "run_id", tables.alias("tables"), marks.alias("sequences"))


def export_schemas(tables: dict[str, DataFrame]) -> DataFrame:
    """(table, position, column, type, nullable, schema_json) for each column."""
    parts = []
    for name, df in tables.items():
        rows = F.array(*[F.struct(F.lit(i + 1).cast("long").alias("position"), F.lit(f.name).alias("column"), F.lit(f.dataType.simpleString()).alias("type"), F.lit(f.nullable).alias("nullable")) for i, f in enumerate(df.schema.fields)])
        parts.append(df.sparkSession.range(1).select(F.lit(name).alias("table"), F.inline(rows), F.lit(df.schema.json()).alias("schema_json")))
    return reduce(DataFrame.unionByName, [p.select("table", "position", "column", "type", "nullable", "schema_json") for p in parts])


def apply_schema(df: DataFrame, schema_json: str) -> DataFrame:
    """df in the exported schema: columns by name, in its order and types."""
    import json

    return df.to(T.StructType.fromJson(json.loads(schema_json)))
