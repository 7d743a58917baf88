"""Conversation structure repair by a run-length dynamic program.

Rows (conv_id, turn, role, text) of a conversation stand by turn, null first; rows of one turn by role and text. A row's first
fault counts: blank (no character outside [\\x20\\x09-\\x0D]), duplicate (role and text stand earlier in the conversation), truncated
(the last such character is none of .!?). Edits are Keep (0), Rerole to user or assistant (1), Delete (2, required for blank
and duplicate rows) and Insert an empty user or assistant row anywhere (5); a truncated row that isn't deleted adds 5.
The cheapest edits that give role initials `(s?(ua)+)?` are found, of equally cheap ones those with the least audit in ASCII.

A row is a symbol: role initial and fault. A symbol's costs from state to state (nothing yet, behind system, behind user,
behind assistant; inserts before the row included) are a min-plus matrix. Equal successive symbols are a run, and costs to
the end pass a run of n by the cached matrices of the powers of two in n. Choices are then unrolled from the front: a
run is halved at cached powers until few rows are left, so that no run is held row by row.

Rows are combined by (conv_id, turn, role, text) with their number, so a million repeated rows are one; what stood earlier is
known by an aggregate over (conv_id, hashes of role and text). Rows are then sorted in ranges of (conv_id, turn, role,
text), which cut a long conversation, and each range yields segments of it: symbols as runs, and texts that can stay. One
stream a conversation reads first all its runs and then its texts, piece by piece: it holds a byte a row, as the audit
does that it returns, 17 bytes a run, and no texts. Repeating the checksum of a whole conversation elsewhere isn't possible, so that stream is
one task's.

Nulls count as one space, in role and text and where a key is made of conv_id and turn; a null conv_id is a conversation of
its own. Empty texts are blank. Texts of any length are read whole. Rows that repeat are duplicates of the first. A
conversation of which damage left no row has zeros, an empty audit and the checksum of an empty string. An empty
table gives an empty result. Other columns aren't read, whatever their names.
"""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Iterator
from io import StringIO

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chunkwright.llm import shared

# States of what was put out so far.
NONE, SYSTEM, USER, ASSISTANT = range(4)
INFINITE = 1 << 60
KEEP, REROLE, DELETE, INSERT, CUT_OFF = 0, 1, 2, 5, 5
_FOLLOWS = {NONE: USER, SYSTEM: USER, ASSISTANT: USER, USER: ASSISTANT}
_NAME = {USER: "user", ASSISTANT: "assistant"}
_LEGAL = ("su", "ua", "au")
#: A symbol: (initial, s, u, a or another, as o; whether it is cut off), or GONE for rows that must be deleted.
GONE = "x"
SYMBOLS = {GONE: 0} | {(i, t): 1 + 2 * k + t for k, i in enumerate("suao") for t in (0, 1)}
_OF = {v: k for k, v in SYMBOLS.items()}
#: Rows and characters of text in a segment, and rows of a run that are unrolled one by one.
SEGMENT_ROWS, SEGMENT_CHARS, UNROLLED = 256, 1 << 15, 64
MARK = 512

Matrix = tuple[tuple[int, ...], ...]


def _times(a: Matrix, b: Matrix) -> Matrix:
    return tuple(tuple(min(INFINITE, *(a[i][k] + b[k][j] for k in range(4))) for j in range(4)) for i in range(4))


def _apply(a: Matrix, g: tuple[int, ...]) -> tuple[int, ...]:
    return tuple(min(INFINITE, *(a[i][k] + g[k] for k in range(4))) for i in range(4))


def _inserts() -> Matrix:
    """Least cost of inserted rows from state to state."""
    one = tuple(tuple(0 if i == j else INSERT if _FOLLOWS[i] == j else INFINITE for j in range(4)) for i in range(4))
    return _times(_times(one, one), one)


def _steps(symbol: int) -> list[list[tuple[str, int, int]]]:
    """For each state what can be done with a row: (edit, cost, next state), in ASCII order of edits."""
    if symbol == SYMBOLS[GONE]:
        return [[("D", DELETE, q)] for q in range(4)]
    initial, cut = _OF[symbol]
    out = []
    for q in range(4):
        stay = [("D", DELETE, q)]
        if (initial == "s" and q == NONE) or initial == {USER: "u", ASSISTANT: "a"}[_FOLLOWS[q]]:
            stay.append(("K", KEEP + CUT_OFF * cut, SYSTEM if initial == "s" else _FOLLOWS[q]))
        out.append([*stay, ("R", REROLE + CUT_OFF * cut, _FOLLOWS[q])])
    return out


def _matrix(symbol: int) -> Matrix:
    rows = []
    for steps in _steps(symbol):
        row = [INFINITE] * 4
        for _, cost, to in steps:
            row[to] = min(row[to], cost)
        rows.append(tuple(row))
    return _times(_inserts(), tuple(rows))


class Repair:
    """Costs and choices for runs of symbols; powers of matrices are kept."""

    #: Cost to the end from each state: nothing, or whole pairs of user and assistant.
    END = (0, *(min(_inserts()[q][NONE], _inserts()[q][ASSISTANT]) for q in (SYSTEM, USER, ASSISTANT)))

    def __init__(self, unrolled: int = UNROLLED) -> None:
        self.unrolled = unrolled
        self.steps = {s: _steps(s) for s in SYMBOLS.values()}
        self.powers: dict[int, list[Matrix]] = {s: [_matrix(s)] for s in SYMBOLS.values()}

    def power(self, symbol: int, k: int) -> Matrix:
        known = self.powers[symbol]
        while len(known) <= k:
            known.append(_times(known[-1], known[-1]))
        return known[k]

    def before(self, symbol: int, n: int, g: tuple[int, ...]) -> tuple[int, ...]:
        """Costs to the end in front of a run of n, from those behind it."""
        for k in range(n.bit_length()):
            if n >> k & 1:
                g = _apply(self.power(symbol, k), g)
        return g

    def unroll(self, symbol: int, n: int, q: int, behind: tuple[int, ...]) -> Iterator[tuple[str, int]]:
        """(edits, next state) through a run of n from state q, in pieces."""
        if symbol == SYMBOLS[GONE]:  # costs the same from any state, and D is least
            yield "D" * n, q
            return
        if n > self.unrolled:
            half = 1 << ((n - 1).bit_length() - 1)
            for edits, q in self.unroll(symbol, n - half, q, self.before(symbol, half, behind)):
                yield edits, q
            yield from self.unroll(symbol, half, q, behind)
            return
        costs = [behind]
        for _ in range(n):
            costs.append(_apply(self.power(symbol, 0), costs[-1]))
        out = []
        for left in range(n, 0, -1):
            here, then = costs[left], costs[left - 1]
            while True:
                edit, cost, to = min((s for s in self.steps[symbol][q] if s[1] + then[s[2]] == here[q]), default=("Z", 0, q))
                if edit != "D" and INSERT + here[_FOLLOWS[q]] == here[q]:
                    out.append("I")
                    q = _FOLLOWS[q]
                    continue
                out.append(edit)
                q = to
                break
        yield "".join(out), q

    def finish(self, q: int) -> str:
        """Inserts behind the last row."""
        out = ""
        while self.END[q]:
            out, q = out + "I", _FOLLOWS[q]
        return out


class Runs:
    """Successive equal symbols with their numbers, nine bytes a run."""

    def __init__(self) -> None:
        self.symbols, self.counts = bytearray(), array("q")

    def add(self, symbol: int, n: int) -> None:
        if n and self.symbols and self.symbols[-1] == symbol:
            self.counts[-1] += n
        elif n:
            self.symbols.append(symbol)
            self.counts.append(n)


def best_edits(runs: Runs, repair: Repair) -> tuple[int, str, array]:
    """Cost, audit, and where in it each run's edits end; what follows the last are inserts.

    Costs to the end are kept at each MARK-th run, and those between are worked out again on the way forward.
    """
    n, g = len(runs.symbols), Repair.END
    marks = [g]
    for k in range(n - 1, -1, -1):
        g = repair.before(runs.symbols[k], runs.counts[k], g)
        if k % MARK == 0:
            marks.append(g)
    cost, q, audit, ends, at = g[NONE], NONE, StringIO(), array("q"), 0
    for low in range(0, n, MARK):
        high = min(n, low + MARK)
        behind = [marks[-2 - low // MARK]]
        for k in range(high - 1, low, -1):
            behind.append(repair.before(runs.symbols[k], runs.counts[k], behind[-1]))
        for k in range(low, high):
            for edits, q in repair.unroll(runs.symbols[k], runs.counts[k], q, behind.pop()):
                audit.write(edits)
                at += len(edits)
            ends.append(at)
    audit.write(repair.finish(q))
    return cost, audit.getvalue(), ends


def damaged(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, n) after damage by crc32(conv_id:turn) % 20; a conversation's dropped rows are one row with n = 0."""
    space = F.lit(" ")
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space))
    own = rows.select("conv_id", "turn", F.coalesce("role", space).alias("role"), F.coalesce("text", space).alias("text"), (F.crc32(key) % 20).alias("_d"))
    text = F.when(F.col("_d").isin(0, 1), "").when(F.col("_d") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(F.col("_d") == 0, "").when(F.col("_d") == 4, "user").otherwise(F.col("role"))
    n = F.when(F.col("_d") == 0, 0).when(F.col("_d") == 3, 2).otherwise(1)
    return own.select("conv_id", F.when(F.col("_d") != 0, F.col("turn")).cast("long").alias("turn"), role.alias("role"), text.alias("text"), n.alias("n"))


def judged(rows: DataFrame) -> DataFrame:
    """Rows (conv_id, turn, role, text, n) combined, with blank, first (no equal role and text stands earlier) and cut."""
    own = rows.groupBy("conv_id", "turn", "role", "text").agg(F.sum("n").cast("long").alias("n"))
    own = own.withColumn("_h", F.xxhash64("role", "text")).withColumn("_g", F.xxhash64("text", "role", F.lit(1)))
    seen = own.where("n > 0").groupBy(F.col("conv_id").alias("_c"), F.col("_h").alias("_hh"), F.col("_g").alias("_gg")).agg(F.min("turn").alias("_turn"), F.bool_or(F.col("turn").isNull()).alias("_null"))
    out = own.join(seen, F.col("conv_id").eqNullSafe(F.col("_c")) & (F.col("_h") == F.col("_hh")) & (F.col("_g") == F.col("_gg")), "left")
    first = F.when(F.col("_null"), F.col("turn").isNull()).otherwise(F.col("turn").eqNullSafe(F.col("_turn")))
    solid = F.rtrim(F.col("text"), F.lit("".join(map(chr, (0x20, *range(0x09, 0x0E))))))
    return out.select("conv_id", "turn", "role", "text", "n", (solid == "").alias("blank"), first.alias("first"), (~F.right(solid, F.lit(1)).isin(".", "!", "?")).alias("cut"))


SEGMENT = "conv_id long, kind int, part long, seq long, symbols binary, counts array<long>, low long, high long, turns long, first_turn long, last_turn long, blank long, duplicate long, truncated long, illegal long, head string, tail string, roles array<string>, texts array<string>"
_SEGMENT = pa.schema([("conv_id", pa.int64()), ("kind", pa.int32()), ("part", pa.int64()), ("seq", pa.int64()), ("symbols", pa.binary()), ("counts", pa.list_(pa.int64()))] + [(n, pa.int64()) for n in "low high turns first_turn last_turn blank duplicate truncated illegal".split()] + [("head", pa.string()), ("tail", pa.string()), ("roles", pa.list_(pa.string())), ("texts", pa.list_(pa.string()))])


class _Segment:
    def __init__(self, conv: int | None):
        self.conv, self.rows, self.chars = conv, 0, 0
        self.runs, self.roles, self.texts = Runs(), [], []
        self.sums = dict.fromkeys(("turns", "blank", "duplicate", "truncated", "illegal"), 0)
        self.first_turn = self.last_turn = None
        self.head = self.tail = ""

    def add(self, turn: int | None, role: str, text: str, n: int, blank: bool, first: bool, cut: bool) -> None:
        self.rows += 1
        if not n:
            return
        if turn is not None and turn != self.last_turn:
            self.sums["turns"] += 1
            self.first_turn = turn if self.first_turn is None else self.first_turn
            self.last_turn = turn
        initial = role[:1]
        if self.tail:
            self.sums["illegal"] += self.tail[1:] + initial not in _LEGAL
        self.sums["illegal"] += n - 1  # next to a copy of itself
        self.head, self.tail = self.head or "^" + initial, "^" + initial
        stays = int(first and not blank)
        if stays:
            self.runs.add(SYMBOLS[(initial if initial in ("s", "u", "a") else "o", int(cut))], 1)
            self.roles.append(role)
            self.texts.append(text)
            self.chars += len(text)
            self.sums["truncated"] += cut
        self.runs.add(SYMBOLS[GONE], n - stays)
        self.sums["blank" if blank else "duplicate"] += n - stays

    def out(self, part: int, seq: int) -> list[dict]:
        base = {"conv_id": self.conv, "part": part, "seq": seq}
        turns = {"low": self.first_turn, "high": self.last_turn, "first_turn": self.first_turn, "last_turn": self.last_turn}
        runs = base | self.sums | turns | {"kind": 0, "symbols": bytes(self.runs.symbols), "counts": self.runs.counts.tolist(), "head": self.head, "tail": self.tail}
        return [runs, base | {"kind": 1, "roles": self.roles, "texts": self.texts}] if self.texts else [runs]


def _segments(most_rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, seq, now, out = TaskContext.get().partitionId(), 0, None, []
        for batch in shared.small_batches(batches):
            for conv, *row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if now is None or now.conv != conv or now.rows >= most_rows or now.chars >= SEGMENT_CHARS:
                    if now is not None:
                        out += now.out(part, seq)
                        seq += 1
                    now = _Segment(conv)
                now.add(*row)
            if out:
                yield pa.RecordBatch.from_pylist(out, _SEGMENT)
                out = []
        if now is not None:
            yield pa.RecordBatch.from_pylist(now.out(part, seq), _SEGMENT)

    return run


RESULT = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
_RESULT = pa.schema([("conv_id", pa.int64())] + [(n, pa.int64()) for n in "gaps blank duplicate truncated illegal cost".split()] + [("audit", pa.string()), ("repaired_sha256", pa.string())])


class _Conversation:
    """Takes a conversation's segments of runs and then its texts, in order."""

    def __init__(self, conv: int | None, repair: Repair):
        self.conv, self.repair, self.runs = conv, repair, Runs()
        self.sums = dict.fromkeys(("blank", "duplicate", "truncated", "illegal"), 0)
        self.low = self.high = self.last_turn = None
        self.turns, self.tail, self.audit = 0, "", None
        self.hash, self.begun = hashlib.sha256(), False

    def add(self, r: dict) -> None:
        if r["kind"] == 0:
            for k in self.sums:
                self.sums[k] += r[k]
            if self.tail and r["head"]:
                self.sums["illegal"] += self.tail[1:] + r["head"][1:] not in _LEGAL
            self.tail = r["tail"] or self.tail
            if r["low"] is not None:
                self.low = r["low"] if self.low is None else self.low
                self.turns += r["turns"] - (r["first_turn"] == self.last_turn)
                self.high = self.last_turn = r["last_turn"]
            for symbol, n in zip(r["symbols"], r["counts"], strict=True):
                self.runs.add(symbol, n)
            return
        self._plan()
        for role, text in zip(r["roles"], r["texts"], strict=True):
            self._to_text()
            edit = self.audit[self.at]
            self.at += 1
            if edit != "D":
                to = _FOLLOWS[self.state] if edit == "R" or role[:1] != "s" else SYSTEM
                self._put(role if edit == "K" else _NAME[to], text, to)

    def _plan(self) -> None:
        if self.audit is None:
            self.cost, self.audit, self.ends = best_edits(self.runs, self.repair)
            self.at, self.state, self.run = 0, NONE, 0

    def _to_text(self) -> None:
        """Goes to the edit of the next row that has a text here: rows that must go have none."""
        while True:
            while self.run < len(self.ends) and self.at >= self.ends[self.run]:
                self.run += 1
            if self.run < len(self.ends) and self.runs.symbols[self.run] == SYMBOLS[GONE]:
                self.at = self.ends[self.run]
            elif self.at < len(self.audit) and self.audit[self.at] == "I":
                self._put(_NAME[_FOLLOWS[self.state]], "", _FOLLOWS[self.state])
                self.at += 1
            else:
                return

    def _put(self, role: str, text: str, to: int) -> None:
        self.hash.update(("\n" if self.begun else "").encode() + f"{role}:{text}".encode())
        self.begun, self.state = True, to

    def result(self) -> dict:
        self._plan()
        self._to_text()
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        return {"conv_id": self.conv, "gaps": gaps, **self.sums, "cost": self.cost, "audit": self.audit, "repaired_sha256": self.hash.hexdigest()}


def _results(unrolled: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        repair, now, out = Repair(unrolled), None, []
        for batch in shared.small_batches(batches):
            for r in batch.to_pylist():
                if now is None or now.conv != r["conv_id"]:
                    if now is not None:
                        out.append(now.result())
                    now = _Conversation(r["conv_id"], repair)
                now.add(r)
            if out:
                yield pa.RecordBatch.from_pylist(out, _RESULT)
                out = []
        if now is not None:
            yield pa.RecordBatch.from_pylist([now.result()], _RESULT)

    return run


def repair_conversations(rows: DataFrame, segment_rows: int = SEGMENT_ROWS, unrolled: int = UNROLLED) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256 of conversations, from rows (conv_id, turn, role, text, n copies)."""
    order = [F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), F.col("role"), F.col("text")]
    own = rows.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), *[F.coalesce(c, F.lit(" ")).alias(c) for c in ("role", "text")], "n")
    dealt = judged(own).repartitionByRange(*order).sortWithinPartitions(*order)
    segments = dealt.mapInArrow(_segments(segment_rows), SEGMENT)
    one = segments.repartition("conv_id").sortWithinPartitions(F.col("conv_id").asc_nulls_first(), "kind", "part", "seq")
    return one.mapInArrow(_results(unrolled), RESULT)


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair_conversations(damaged(spark.read.parquet(f"{sf_dir}/conversations.parquet")))


QUERIES = {"op12_conversation_repair": op12_conversation_repair}
ORACLES: dict[str, str] = {}
