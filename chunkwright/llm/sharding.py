"""Sharding on a consistent-hash ring with virtual nodes and bounded loads (DataFrame functions only).

Every shard owns `vnodes` points of a ring of 2**63 positions. A row's key hashes to a position and belongs to
the next point clockwise. Each shard has a capacity; a key that finds its shard full continues clockwise to the
next point whose shard has room. Capacities are n // shards, one more for the first n % shards of them, so they
add up to n, every shard ends full, and row counts are at most one apart.

What overflows is decided per arc, not per row: row counts of the shards * vnodes arcs (a size fixed by the
parameters) are walked clockwise, which gives for each arc a list of rank ranges and the shards they go to. Rows
find their range by their rank within the arc, so no task ever holds more than an arc.
"""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from chunkwright.llm import shared

CELL_BITS = 13
RING_BITS = 63


def ring_points(shards: int, vnodes: int) -> list[tuple[int, int]]:
    """(position, shard) clockwise."""
    return sorted((int.from_bytes(hashlib.sha256(f"{s}/{v}".encode()).digest()[:8], "big") >> 1, s) for s in range(shards) for v in range(vnodes))


def _table(spark: SparkSession, rows: list[dict], schema: str) -> DataFrame:
    """A small table from the driver as a literal, so that no Python runs on executors."""
    return spark.range(1).select(F.inline(F.from_json(F.lit(json.dumps(rows)), f"array<struct<{schema}>>")))


def _arcs(points: list[tuple[int, int]]) -> list[dict]:
    """Arcs (lo, hi], cut at cell borders so that a position finds its arc by an equality on the cell and two comparisons."""
    width, rows, lo = 1 << (RING_BITS - CELL_BITS), [], 0
    for j, (hi, _) in enumerate([*points, ((1 << RING_BITS) - 1, None)]):
        arc = j % len(points)
        for cell in range(lo // width, hi // width + 1):
            rows.append({"cell": cell, "arc": arc, "lo": max(lo, cell * width), "hi": min(hi, (cell + 1) * width - 1)})
        lo = hi + 1
    return [r for r in rows if r["lo"] <= r["hi"]]


def spill_plan(counts: dict[int, int], points: list[tuple[int, int]], shards: int) -> list[dict]:
    """Rank ranges of each arc and the shard and first slot of each, by walking the ring clockwise with bounded loads."""
    n = sum(counts.values())
    room = [n // shards + (s < n % shards) for s in range(shards)]
    used, plan, placed = [0] * shards, [], {}

    def put(arc: int, count: int, shard: int) -> int:
        take = min(count, room[shard] - used[shard])
        if take > 0:
            lo = placed.get(arc, 0)
            plan.append({"arc": arc, "from_rank": lo, "to_rank": lo + take, "shard": shard, "slot0": used[shard]})
            placed[arc] = lo + take
            used[shard] += take
        return max(take, 0)

    carried: list[list[int]] = []
    left = {arc: c - put(arc, c, points[arc][1]) for arc, c in sorted(counts.items())}
    for step in range(2 * len(points)):
        arc = step % len(points)
        while carried and room[points[arc][1]] > used[points[arc][1]]:
            carried[0][1] -= put(*carried[0], points[arc][1])
            if not carried[0][1]:
                carried.pop(0)
        if left.get(arc):
            carried.append([arc, left.pop(arc)])
    assert not carried, "capacities add up to the rows, so two rounds place them all"
    return plan


def assign(df: DataFrame, key: Column, shards: int, vnodes: int = 128) -> DataFrame:
    """df with home_shard, shard and slot.

    Rows are ordered within an arc by position and then by all of `order` columns (doc_id, size, text_crc32), so
    equal rows may swap slots but the result as a set of rows is fixed. Null keys hash like any other value; an
    empty table gives an empty result; extra columns pass through, but for those named as one of the three that are added.
    """
    spark, points, given = df.sparkSession, ring_points(shards, vnodes), df.columns
    # The caller's columns travel under names that none here has.
    df = df.select(key.alias("_key"), *[F.col(f"`{c}`").alias(f"_in_{c}") for c in given])
    arcs = _table(spark, _arcs(points), "cell:bigint,arc:int,lo:bigint,hi:bigint")
    placed = df.withColumn("_pos", F.shiftrightunsigned(F.xxhash64("_key"), 1)).withColumn("_cell", F.shiftright("_pos", RING_BITS - CELL_BITS))
    # The arcs are shards * vnodes rows and at most 2**CELL_BITS more: a bound set by the parameters.
    placed = placed.join(F.broadcast(arcs), (F.col("_cell") == F.col("cell")) & F.col("_pos").between(F.col("lo"), F.col("hi"))).drop("cell", "lo", "hi", "_cell")
    counts = {r["arc"]: r["count"] for r in placed.groupBy("arc").count().collect()}
    plan = _table(spark, spill_plan(counts, points, shards), "arc:int,from_rank:bigint,to_rank:bigint,shard:int,slot0:bigint").withColumnRenamed("arc", "_arc")
    homes = _table(spark, [{"h_arc": j, "home_shard": s} for j, (_, s) in enumerate(points)], "h_arc:int,home_shard:int")
    plan = plan.join(F.broadcast(homes), F.col("h_arc") == F.col("_arc")).drop("h_arc")
    order = [f"_in_{c}" for c in ("doc_id", "size", "text_crc32") if c in given]
    ranked = placed.withColumn("_rank", F.row_number().over(Window.partitionBy("arc").orderBy("_pos", *order)).cast("long") - 1)
    at = (F.col("arc") == F.col("_arc")) & (F.col("_rank") >= F.col("from_rank")) & (F.col("_rank") < F.col("to_rank"))
    out = ranked.join(F.broadcast(plan), at)  # as many rows as arcs and overflowing ranges, again bound by the parameters
    return out.withColumn("slot", F.col("slot0") + F.col("_rank") - F.col("from_rank")).select(*[F.col(f"`_in_{c}`").alias(c) for c in given if c not in ("home_shard", "shard", "slot")], "home_shard", "shard", "slot")


def shard_documents(docs: DataFrame, shards: int = 40, vnodes: int = 128) -> DataFrame:
    """doc_id, size, text_crc32, home_shard, shard, slot of every document.

    Null text counts as no bytes (size 16, crc 0), and so does an empty one; texts of any length are read whole, for their
    bytes and crc only. A null doc_id is placed by its text's crc. Other columns aren't read.
    """
    data = F.encode(F.coalesce("text", F.lit("")), "UTF-8")
    rows = docs.select("doc_id", (F.octet_length(data) + 16).cast("long").alias("size"), F.crc32(data).alias("text_crc32"))
    return assign(rows, F.coalesce(F.col("doc_id").cast("string"), F.concat(F.lit("crc"), F.col("text_crc32").cast("string"))), shards, vnodes)


def op5_ring_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = shard_documents(shared.documents(spark, sf_dir))
    return out.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "home_shard")


QUERIES = {"op5_ring_sharding": op5_ring_sharding}
ORACLES: dict[str, str] = {}
