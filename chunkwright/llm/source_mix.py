"""Mixing sources to target weights by Pfair scheduling.

Rows of a source are put in a fixed order and cut to blocks of BLOCK_ROWS. The ideal mix gives each source that has
blocks left its exact weight's share of each slot; with V slots for each unit of weight so far, T(V) = sum of min(w * V, n)
slots are filled, where n is a source's blocks. Block k of a source with weight w has the release time floor(T(k / w)) and
the deadline ceil(T((k + 1) / w)); each slot takes the released block with the earliest deadline. The ideal mix keeps all
those times, so this does too: over the whole schedule, also where sources run out, a source is less than one block
away from its share by weight. Weights aren't rounded, and times are exact.

The schedule is made on executors in windows of slots. At the border of a window at most one block of each source is released
and not due, so what the windows before leave is one bit for each source: whether that block waits. Earliest deadline
first treats the j most urgent of these blocks as if there were no others, so of them wait j - m + the largest of (others that are
released before a) - (blocks released before a - a) over all slots a up to the border, where m of all of them are done. A
first job finds in each window the least blocks waiting between successive releases of these blocks; the driver carries the bits from border
to border with them, with work by windows and sources and not by blocks; a second job gives each window its slots from its bits.
A window has at least SLOTS_A_SOURCE slots for each source, so the driver holds at most a number for that many slots.

With a frame, weights become whole quotas q that add up to frame slots, at least one each, and the bound holds for these
rounded shares within a phase only. Releases floor(k * frame / q) and deadlines ceil((k + 1) * frame / q) repeat every
frame, so one frame's schedule gives the slot of any block by a division. When a source has no blocks left, a new phase
begins in which the others share all slots by their weights.

No row is dropped or repeated, and every source is mixed by its own weight, however many there are. The driver holds a name
and a few numbers for each source, and tasks get these numbers. A frame must have at least as many slots as there are sources.

A null source is a source of its own, NO_SOURCE in weights, whatever others are called. Rows may repeat and doc_id may be null; order within a source is by a hash of
doc_id, then doc_id, so it looks shuffled and is the same in every run (rows that share a doc_id may swap places).
An empty table gives an empty result; other columns pass through.
"""

from __future__ import annotations

import heapq
import json
import math
from collections.abc import Callable, Iterator
from itertools import accumulate, pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from chunkwright.llm import shared

BLOCK_ROWS = 32
WINDOW = 1 << 17
SLOTS_A_SOURCE = 64
PLAN_TASKS = 4096
BUCKET_ROWS = 20_000
LEAST_BUCKETS = 256


class _NoSource(str):
    """A name that is equal to itself only, not to a source's that reads the same."""

    __slots__ = ()
    __hash__ = str.__hash__

    def __eq__(self, other: object) -> bool:
        return self is other


#: Key of rows without a source in weights.
NO_SOURCE = _NoSource("(none)")
#: A time this near to a whole slot is worked out in whole numbers.
NEAR = 1e-6
#: More than any number of blocks.
NEVER = np.int64(1 << 62)


class Times:
    """Release times and deadlines of blocks: floor and ceil of T at k / w.

    T is worked out in floating point, whose error at 1e9 slots is under 1e-6. Only where that leaves the whole number open, as the
    time is that near to one, it is worked out again by whole numbers, which float weights are when brought to one denominator.
    """

    def __init__(self, blocks: list[int], weights: list[float]):
        self.n = np.array(blocks, np.int64)
        ratios = [float(w).as_integer_ratio() for w in weights]
        whole = math.lcm(*[d for _, d in ratios])
        self.exact = [a * (whole // d) for a, d in ratios]
        self.w = np.array(weights, np.float64) / math.fsum(weights)
        order = np.argsort(self.n / self.w)
        self.ends = (self.n / self.w)[order]  # V at which each source runs out
        self.spent = np.concatenate([[0], np.cumsum(self.n[order])])
        self.live = np.concatenate([np.cumsum(self.w[order][::-1])[::-1], [0.0]])
        left = list(accumulate([self.exact[i] for i in order[::-1].tolist()], initial=0))
        self.exact_live = left[::-1]
        self.borders: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def at(self, v: np.ndarray) -> np.ndarray:
        """T(v), slots filled when V is v."""
        gone = np.searchsorted(self.ends, v, "left")
        return self.spent[gone] + v * self.live[gone]

    def whole(self, s: np.ndarray, k: np.ndarray, up: bool) -> np.ndarray:
        """Floor, or ceil if up, of T(k / w) of the sources s."""
        v = k / self.w[s]
        t = self.at(v)
        out = (np.ceil(t) if up else np.floor(t)).astype(np.int64)
        near = np.flatnonzero(np.abs(t - np.rint(t)) < NEAR)
        gone = np.searchsorted(self.ends, v[near], "left")
        for i, g, source, block in zip(near.tolist(), gone.tolist(), s[near].tolist(), k[near].tolist(), strict=True):
            top, under = block * self.exact_live[g], self.exact[source]
            out[i] = int(self.spent[g]) + (-(-top // under) if up else top // under)
        return out

    def at_slot(self, slot: int) -> tuple[np.ndarray, np.ndarray]:
        """Of each source, how many blocks are due by the slot, and how many are released before it, which is at most one more."""
        if slot not in self.borders:
            if len(self.borders) > 1:  # a window has two
                del self.borders[min(self.borders)]
            self.borders[slot] = self._at_slot(slot)
        return self.borders[slot]

    def _at_slot(self, slot: int) -> tuple[np.ndarray, np.ndarray]:
        v = np.interp(slot, np.concatenate([[0.0], self.at(self.ends)]), np.concatenate([[0.0], self.ends]))
        guess = np.minimum(self.n, np.floor(v * self.w).astype(np.int64))
        return self._first(guess, lambda s, k: self.whole(s, k + 1, True) <= slot), self._first(guess, lambda s, k: self.whole(s, k, False) < slot)

    def _first(self, guess: np.ndarray, holds: Callable[[np.ndarray, np.ndarray], np.ndarray]) -> np.ndarray:
        """Of each source, how many of its blocks hold; those are its first ones, and guess is near."""
        out, s = guess.copy(), np.arange(len(guess))
        while True:
            down, up = s[out > 0], s[out < self.n]
            down, up = down[~holds(down, out[down] - 1)], up[holds(up, out[up])]
            if not len(down) and not len(up):
                return out
            out[down] -= 1
            out[up] += 1


def _between(before: np.ndarray, after: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(source, block) of all blocks from number before on to number after."""
    more = after - before
    s = np.repeat(np.arange(len(more)), more)
    return s, np.arange(len(s)) - np.repeat(np.cumsum(more) - more, more) + before[s]


def least_waiting(times: Times, start: int, end: int) -> tuple[np.ndarray, np.ndarray]:
    """Sources whose undue block at the end of the window is released in it, by release, and the least blocks waiting between these releases.

    The latter has a number for the slots up to the first release, one for those from there to the second and so on.
    """
    (_, out), (due, released) = times.at_slot(start), times.at_slot(end)
    s, k = _between(out, released)
    waiting = int(out.sum()) + np.cumsum(np.bincount(times.whole(s, k, False) - start, minlength=end - start)) - np.arange(start + 1, end + 1)
    fresh = np.flatnonzero((released > due) & (due >= out))
    at = times.whole(fresh, due[fresh], False)
    by = np.argsort(at, kind="stable")
    least = np.full(len(by) + 1, NEVER)
    np.minimum.at(least, np.searchsorted(at[by], np.arange(start + 1, end + 1), "left"), waiting)
    return fresh[by], least


class _Peak:
    """The largest of some numbers, all of which can be lowered by one from a place on, in steps of the root of how many there are."""

    def __init__(self, numbers: np.ndarray):
        self.width = math.isqrt(len(numbers))
        self.rows = np.pad(numbers, (0, -len(numbers) % self.width), constant_values=-NEVER).reshape(-1, self.width)
        self.lowered, self.tops = np.zeros(len(self.rows), np.int64), self.rows.max(axis=1)

    def lower(self, at: int) -> None:
        row, place = divmod(at, self.width)
        self.rows[row, place:] -= 1
        self.lowered[row + 1 :] += 1
        self.tops[row + 1 :] -= 1
        self.tops[row] = self.rows[row].max() - self.lowered[row]

    def top(self) -> int:
        return int(self.tops.max())


def carried(times: Times, start: int, end: int, waits: np.ndarray, fresh: np.ndarray, least: np.ndarray) -> np.ndarray:
    """For each source whether its block that is released and not due waits at the end of the window, if waits says that for its start."""
    (_, out), (due, released) = times.at_slot(start), times.at_slot(end)
    undue = np.flatnonzero(released > due)
    urgent = undue[np.lexsort((undue, times.whole(undue, due[undue] + 1, True)))]
    place = np.zeros(len(due), np.int64)
    place[fresh] = np.arange(1, len(fresh) + 1)
    older = np.zeros(len(due), bool)
    older[undue] = place[undue] == 0
    n_older, done = int(older.sum()), end - int(due.sum())
    before = int((waits & ~older).sum()) + n_older - (int(out.sum()) - start)
    peak = _Peak(n_older + np.arange(len(least)) - least)
    result, last = np.zeros(len(due), bool), 0
    for j, s in enumerate(urgent.tolist(), 1):
        peak.lower(int(place[s]))
        before += int(waits[s]) - 1 if older[s] else 0
        now = j - done + max(before, peak.top())
        result[s], last = now > last, now
    return result


def slots(times: Times, start: int, end: int, waits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(source, block) of the slots of a window, by earliest deadline first among the released."""
    (due, out), (_, released) = times.at_slot(start), times.at_slot(end)
    old = np.flatnonzero(waits)
    ready = list(zip(times.whole(old, due[old] + 1, True).tolist(), old.tolist(), due[old].tolist(), strict=True))
    heapq.heapify(ready)
    s, k = _between(out, released)
    release, deadline = times.whole(s, k, False), times.whole(s, k + 1, True)
    by = np.lexsort((deadline, release))
    made: list[tuple[int, int]] = []
    for at, last, i, b in zip((release[by] - start).tolist(), deadline[by].tolist(), s[by].tolist(), k[by].tolist(), strict=True):
        while len(made) < at:
            made.append(heapq.heappop(ready)[1:])
        heapq.heappush(ready, (last, i, b))
    while len(made) < end - start:
        made.append(heapq.heappop(ready)[1:])
    both = np.array(made, np.int64)
    return both[:, 0], both[:, 1]


def borders(total: int, window: int) -> list[tuple[int, int]]:
    """First slot of each window and the first behind it."""
    return list(pairwise([*range(0, total, window), total]))


def schedule(blocks: list[int], weights: list[float], window: int = WINDOW) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(source, block) of each slot, by windows, in one process. Weights are above 0; sources without blocks have no slots."""
    if not sum(blocks):
        return
    times, waits = Times(blocks, weights), np.zeros(len(blocks), bool)
    for start, end in borders(sum(blocks), window):
        yield slots(times, start, end, waits)
        waits = carried(times, start, end, waits, *least_waiting(times, start, end))


def quotas(weights: dict[str, float], frame: int) -> dict[str, int]:
    """Whole slots of a frame by largest remainder, at least one each. frame must be at least the number of weights."""
    total = sum(weights.values())
    exact = {s: w * frame / total for s, w in weights.items()}
    out = {s: max(1, int(x)) for s, x in exact.items()}
    by_need = sorted(exact, key=lambda s: (out[s] - exact[s], s))
    while (d := frame - sum(out.values())) != 0:
        for s in by_need if d > 0 else [s for s in reversed(by_need) if out[s] > 1]:
            if d == 0:
                break
            out[s] += 1 if d > 0 else -1
            d += -1 if d > 0 else 1
    return out


def frame_slots(quota: dict[str, int], frame: int) -> dict[str, list[int]]:
    """Slot of each block of a frame, by earliest deadline first among the released."""
    jobs = sorted((k * frame // q, -(-(k + 1) * frame // q), s, k) for s, q in quota.items() for k in range(q))
    ready: list[tuple[int, str, int]] = []
    out: dict[str, list[int]] = {s: [0] * q for s, q in quota.items()}
    at = 0
    for slot in range(frame):
        while at < len(jobs) and jobs[at][0] <= slot:
            heapq.heappush(ready, (jobs[at][1], jobs[at][2], jobs[at][3]))
            at += 1
        deadline, s, k = heapq.heappop(ready)
        assert slot < deadline
        out[s][k] = slot
    return out


def phases(blocks: dict[str, int], weights: dict[str, float], frame: int) -> list[dict]:
    """For each phase and source: blocks first to last of the source, its quota and slots in a frame, and the phase's first slot."""
    left, done, slot0, out = {s: n for s, n in blocks.items() if n}, dict.fromkeys(blocks, 0), 0, []
    while left:
        quota = quotas({s: weights[s] for s in left}, frame)
        slots = frame_slots(quota, frame)
        length = 1 + min((n - 1) // quota[s] * frame + slots[s][(n - 1) % quota[s]] for s, n in left.items())
        for s in sorted(left):
            n = length // frame * quota[s] + sum(x < length % frame for x in slots[s])
            if n:
                out.append({"p_source": s, "first": done[s], "last": done[s] + n - 1, "quota": quota[s], "slots": slots[s], "slot0": slot0})
            done[s] += n
            left[s] -= n
        left = {s: n for s, n in left.items() if n}
        slot0 += length
    return out


def root_weights(rows: dict[str, int]) -> dict[str, float]:
    """Default target: shares by the square root of a source's rows."""
    return {s: math.sqrt(n) for s, n in rows.items()}


_OWN = ("doc_id", "source")
#: Inside, a source goes by its name behind a mark, so that no name is that of rows without one.
_NAMED, _NAMELESS = "=", "-"
_MORE = ("mix_block", "mix_slot", "mix_place")


_LEAST = pa.schema([("w", pa.int64()), ("fresh", pa.binary()), ("least", pa.binary())])
_SLOTS = pa.schema([("p_source", pa.string()), ("p_block", pa.int64()), ("p_slot", pa.int64())])


def _least_of(blocks: list[int], weights: list[float], window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        times, edges = Times(blocks, weights), borders(sum(blocks), window)
        for batch in batches:
            for w in batch.column(0).to_pylist():
                fresh, least = least_waiting(times, *edges[w])
                yield pa.RecordBatch.from_pylist([{"w": w, "fresh": fresh.tobytes(), "least": least.tobytes()}], _LEAST)

    return run


def _slots_of(names: list[str], blocks: list[int], weights: list[float], window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        times, edges, of = Times(blocks, weights), borders(sum(blocks), window), pa.array(names, pa.string())
        for batch in batches:
            for w, bits in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                waits = np.unpackbits(np.frombuffer(bits, np.uint8), count=len(names)).astype(bool)
                s, k = slots(times, *edges[w], waits)
                yield pa.RecordBatch.from_arrays([of.take(pa.array(s)), pa.array(k), pa.array(np.arange(*edges[w]))], schema=_SLOTS)

    return run


def _planned(spark: SparkSession, blocks: dict[str, int], target: dict[str, float], window: int | None = None) -> DataFrame:
    """(p_source, p_block, p_slot) of all blocks."""
    names = [s for s, n in blocks.items() if n]
    kind = "p_source string, p_block long, p_slot long"
    if not names:
        return spark.createDataFrame([], kind)
    never = min((target[s] for s in names if target[s] > 0), default=1.0) / 1e6
    counts, weights = [blocks[s] for s in names], [target[s] if target[s] > 0 else never for s in names]
    window = window or max(WINDOW, SLOTS_A_SOURCE * len(names))
    edges = borders(sum(counts), window)
    parts = min(len(edges), PLAN_TASKS)
    times, waits = Times(counts, weights), np.zeros(len(names), bool)
    bits = [np.packbits(waits).tobytes()]
    if len(edges) > 1:
        shared.ship(spark)
        found = spark.range(0, len(edges) - 1, 1, parts).mapInArrow(_least_of(counts, weights, window), "w long, fresh binary, least binary")
        for r in shared.written(found, "mix_least").orderBy("w").toLocalIterator():
            waits = carried(times, *edges[r.w], waits, np.frombuffer(r.fresh, np.int64), np.frombuffer(r.least, np.int64))
            bits.append(np.packbits(waits).tobytes())
    state = spark.createDataFrame(pa.table({"w": pa.array(range(len(edges)), pa.int64()), "bits": pa.array(bits, pa.binary())}))
    return shared.written(state.repartition(parts).mapInArrow(_slots_of(names, counts, weights, window), kind), "mix_plan")


def _placed(docs: DataFrame, weights: dict[str, float] | Callable[[dict[str, int]], dict[str, float]] = root_weights, block_rows: int = BLOCK_ROWS, frame: int | None = None, window: int | None = None) -> DataFrame:
    spark = docs.sparkSession
    named = shared.hidden(docs, _OWN).withColumn("_source", F.coalesce(F.concat(F.lit(_NAMED), F.col("source").cast("string")), F.lit(_NAMELESS)))
    top = named.groupBy("_source").count().orderBy("_source").toArrow()
    rows = dict(zip(top.column(0).to_pylist(), top.column(1).to_pylist(), strict=True))
    if frame is not None and frame < len(rows):
        raise ValueError(f"a frame of {frame} slots can't hold {len(rows)} sources")
    name = {s: s.removeprefix(_NAMED) if s.startswith(_NAMED) else NO_SOURCE for s in rows}
    target = weights({name[s]: n for s, n in rows.items()}) if callable(weights) else weights
    least = min(target.values(), default=1.0)
    target = {s: target.get(name[s], least) for s in rows}
    blocks = {s: -(-n // block_rows) for s, n in rows.items()}

    buckets = max(LEAST_BUCKETS, -(-sum(rows.values()) // BUCKET_ROWS))
    id_hash = F.xxhash64(F.col("doc_id").cast("string"))
    dealt = named.withColumn("_bucket", F.pmod(id_hash, F.lit(buckets)))
    # Where one source holds a third of all rows, its rows still go to all buckets.
    before = Window.partitionBy("_source").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = dealt.groupBy("_source", "_bucket").count().withColumn("_before", F.coalesce(F.sum("count").over(before), F.lit(0)))
    if frame is None:
        # Each bucket of a source gets the slots of its few hundred blocks, so rows themselves aren't shuffled for the plan.
        offsets = offsets.withColumn("_first", F.expr(f"_before div {block_rows}")).withColumn("_blocks", F.expr(f"sequence(_first, (_before + count - 1) div {block_rows})"))
        plan = _planned(spark, blocks, target, window)
        slots = offsets.select("_source", "_bucket", F.explode("_blocks").alias("p_block")).join(plan.withColumnRenamed("p_source", "_source"), ["_source", "p_block"])
        slots = slots.groupBy("_source", "_bucket").agg(F.array_sort(F.collect_list(F.struct("p_block", "p_slot"))).getField("p_slot").alias("_slots"))
        offsets = offsets.join(slots, ["_source", "_bucket"]).drop("_blocks")
    inside = F.row_number().over(Window.partitionBy("_source", "_bucket").orderBy(id_hash, "doc_id"))
    ranked = dealt.withColumn("_inside", inside).join(offsets.drop("count"), ["_source", "_bucket"]).withColumn("_rank", F.col("_before") + F.col("_inside") - 1)
    ranked = ranked.withColumn("mix_block", F.expr(f"_rank div {block_rows}")).withColumn("mix_place", (F.col("_rank") % block_rows).cast("int"))
    if frame is None:
        return ranked.withColumn("mix_slot", F.expr("get(_slots, cast(mix_block - _first as int))"))
    table = spark.range(1).select(F.inline(F.from_json(F.lit(json.dumps(phases(blocks, target, frame))), "array<struct<p_source:string,first:bigint,last:bigint,quota:bigint,slots:array<int>,slot0:bigint>>")))
    # The plan has at most as many sources as a frame has slots, in as many phases.
    out = ranked.join(F.broadcast(table), (F.col("_source") == F.col("p_source")) & F.col("mix_block").between(F.col("first"), F.col("last")))
    k = F.col("mix_block") - F.col("first")
    slot = F.col("slot0") + F.expr("(mix_block - first) div quota") * frame + F.element_at("slots", (k % F.col("quota")).cast("int") + 1)
    return out.withColumn("mix_slot", slot.cast("long"))


def mix(docs: DataFrame, **options) -> DataFrame:
    """docs with mix_block (number within the source), mix_slot and mix_place (row within the block).

    weights: target weight of each source, or a function from row counts to weights. Sources that are not named get
    the smallest named weight, and a weight of 0 counts as a millionth of the smallest. block_rows, frame, window (slots
    that a task schedules): see above.
    """
    return shared.shown(_placed(docs, **options), docs, _OWN, _MORE)


def mixed_order(docs: DataFrame, **options) -> DataFrame:
    """The same rows and columns, in files and order of the mix."""
    order = [F.col("mix_slot"), F.col("mix_place")]
    return shared.shown(_placed(docs, **options).repartitionByRange(*order).sortWithinPartitions(*order), docs, _OWN)


def op4_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(shared.documents(spark, sf_dir).select("doc_id", "source"))


QUERIES = {"op4_source_mix": op4_source_mix}
ORACLES: dict[str, str] = {}
