"""Quality rules, mixing and sharding."""

import heapq
import math
import random
import re
import zlib
from collections import Counter
from fractions import Fraction

import numpy as np
import pytest

from chunkwright.llm import quality_rules, sharding, source_mix

from .odd import CLASHING, PROSE, documents, empty, rows

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_counts(text):
    words = WORD.findall(text or "")
    windows = Counter(zip(words, words[1:], words[2:], strict=False))
    covered = {j for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for j in (i, i + 1, i + 2)}
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), dup, len(covered)


def brute_kept(text):
    """The rules again, in plain Python over characters."""
    text = text or ""
    n_words, word_chars, n_symbols, n_dup, n_repeat = brute_counts(text)
    words, lines = WORD.findall(text), text.split("\n")
    letter = lambda c: c.isascii() and c.isalpha() or not c.isascii()
    letters, upper = sum(map(letter, text)), sum("A" <= c <= "Z" for c in text)
    worded = sum(bool(WORD.search(x)) for x in lines)
    dots = sum(x.rstrip(" \t\n\r\x0b\x0c").endswith(("...", "\u2026")) for x in lines)
    wordlike = sum(any(map(letter, w)) for w in words)
    if n_words < 50 or 100 * n_repeat > 50 * n_words:
        return False
    bad = [10 * n_symbols > n_words, word_chars < 2 * n_words, word_chars > 20 * n_words, 2 * upper > letters, 10 * n_dup > 6 * worded, dots > 0.3 * len(lines), wordlike < 0.7 * n_words, max(Counter(words).values()) > 0.3 * n_words]
    return not any(bad)


def test_kept_by_brute_force(spark, sf):
    made = [" ".join([f"w{i}" for i in range(70)] + x) for x in (["#"] * 8, ["#"] * 3, ["A" * 300], ["1"] * 29, ["1"] * 40, ["same"] * 31, ["x" * 3000])]
    made += ["\n".join(f"line {i % k} has words {i % k}" for i in range(60)) for k in (3, 20, 40, 60)] + ["\n".join(f"a{i} b{i} c{i} d{i}" + ("..." if i % 3 == 0 else " \u2026 " if i % 7 == 0 else "") for i in range(40)), "é ü ß 日本 " * 3 + " ".join(f"ñ{i}" for i in range(60)), None, ""]
    rows_ = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()] + [(10**6 + i, t) for i, t in enumerate(made)]
    got = {r.doc_id: r.kept for r in quality_rules.quality_scores(spark.createDataFrame(rows_, "doc_id long, text string")).collect()}
    assert got == {i: brute_kept(t) for i, t in rows_}
    assert len(set(got[10**6 + i] for i in range(len(made)))) == 2


def test_counts(spark, sf):
    texts = [r.text for r in spark.read.parquet(f"{sf}/documents.parquet").select("text").collect()]
    texts += [r[1] for r in rows()] + ["a b a b a b a", "x\n\nx\n x", "#*$%&|<> word", "　 \x85 \x1c"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in quality_rules.quality_scores(df).collect():
        n, chars, symbols, dup, again = brute_counts(texts[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (n, chars, symbols, dup, again)
        assert r.base_failed == (n < 50 or 100 * again > 50 * n)
        assert not (r.kept and r.base_failed)


def test_order_doesnt_change_the_verdict():
    texts = [(PROSE if i % 3 else "# " * i + PROSE.upper()).encode() for i in range(90)]
    some = quality_rules.Cascade(sample_rows=0)
    some.order = list(reversed(some.order))
    assert (some.judge(texts)["kept"] == quality_rules.Cascade(sample_rows=20).judge(texts)["kept"]).all()
    first = quality_rules.Cascade(sample_rows=90)
    first.judge(texts)
    assert max(first.hits, key=lambda r: first.hits[r] / first.took[r]) == first.order[0]


def test_labelled_good_texts_stay(spark, sf):
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    got = quality_rules.quality_scores(docs).join(labels, "doc_id")
    assert got.where("quality = 1 and not base_failed and not kept").isEmpty()
    assert got.where("quality = 0 and kept").count() <= 0.05 * got.where("quality = 0").count()


def test_quality_odd(spark):
    df = documents(spark)
    got = quality_rules.keep_quality(df)
    assert got.columns == df.columns and got.select(*CLASHING).distinct().count() <= 1
    assert got.where("text is null or text = ''").isEmpty() and got.where("doc_id = 2").count() == 2
    assert quality_rules.quality_scores(df).count() == df.count()
    assert quality_rules.quality_scores(empty(spark)).count() == quality_rules.keep_quality(empty(spark)).count() == 0


@pytest.mark.parametrize("weights", [{"a": 1}, {"a": 5, "b": 3, "c": 1}, {"a": 0.7, "b": 0.2, "c": 0.05, "d": 0.05}, {str(i): 1 + i % 7 for i in range(30)}])
def test_frames_meet_their_deadlines(weights):
    quota = source_mix.quotas(weights, 100)
    assert sum(quota.values()) == 100 and min(quota.values()) >= 1
    slots = source_mix.frame_slots(quota, 100)
    assert sorted(x for s in slots.values() for x in s) == list(range(100))
    for s, q in quota.items():
        for k, x in enumerate(slots[s]):
            assert k * 100 // q <= x < -(-(k + 1) * 100 // q)


def simulated(blocks, weights, frame):
    """Slot by slot: earliest deadline first among released blocks, phase after phase."""
    left, order = {s: n for s, n in blocks.items() if n}, []
    done = dict.fromkeys(blocks, 0)
    while left:
        quota, at, t = source_mix.quotas({s: weights[s] for s in left}, frame), dict.fromkeys(left, 0), 0
        while all(left.values()):
            ready = [(-(-(at[s] + 1) * frame // quota[s]), s) for s in left if at[s] * frame // quota[s] <= t]
            s = min(ready)[1]
            order.append((s, done[s]))
            at[s], done[s], left[s], t = at[s] + 1, done[s] + 1, left[s] - 1, t + 1
        left = {s: n for s, n in left.items() if n}
    return order


def test_mix_is_the_simulation(spark):
    rows_ = [(i, s) for i, s in enumerate("a" * 400 + "b" * 130 + "c" * 35)] + [(1000, None), (1000, None)]
    df = spark.createDataFrame(rows_, "doc_id long, source string")
    weights = {"a": 2.0, "b": 1.0, "c": 1.0, source_mix.NO_SOURCE: 0.5}
    got = source_mix.mix(df, weights=weights, block_rows=5, frame=20).collect()
    assert len(got) == len(rows_)
    by_slot = {}
    for r in got:
        by_slot.setdefault(r.mix_slot, set()).add((r.source or source_mix.NO_SOURCE, r.mix_block))
    counts = {"a": 80, "b": 26, "c": 7, source_mix.NO_SOURCE: 1}
    assert [by_slot[t] for t in range(len(by_slot))] == [{x} for x in simulated(counts, weights, 20)]
    assert max(Counter((r.source, r.mix_block) for r in got).values()) <= 5


def test_mix_deviates_by_less_than_a_block(spark, sf):
    df = spark.read.parquet(f"{sf}/documents.parquet")
    got = source_mix.mix(df, block_rows=1, frame=200).select("source", "mix_slot").orderBy("mix_slot").collect()
    rows_ = Counter(r.source for r in got)
    quota = source_mix.quotas(source_mix.root_weights(rows_), 200)
    last = {s: max(r.mix_slot for r in got if r.source == s) for s in rows_}
    for t in range(1, min(last.values()) + 2):
        seen = Counter(r.source for r in got[:t])
        assert all(abs(seen[s] - t * q / 200) < 1 for s, q in quota.items())


def ideal(blocks, weights, slots):
    """Each source's blocks in the ideal mix after 0, 1, ... slots: those with blocks left share all slots by weight."""
    have, out = dict.fromkeys(blocks, 0.0), []
    for _ in range(slots + 1):
        out.append(dict(have))
        left = 1.0
        while left > 1e-12 and (live := [s for s in blocks if blocks[s] - have[s] > 1e-12]):
            total = sum(weights[s] for s in live)
            step = min(left, *((blocks[s] - have[s]) * total / weights[s] for s in live))
            for s in live:
                have[s] += step * weights[s] / total
            left -= step
    return out


@pytest.mark.parametrize("window", [7, 1000, 1 << 17])
@pytest.mark.parametrize("weights", [{"a": 0.9999, "b": 0.0001}, {"a": 2**0.5, "b": 3**0.5, "c": 1, "d": 0.001}, {str(i): (1 + i % 17) ** 0.5 for i in range(90)}])
def test_schedules_keep_to_the_weights(weights, window):
    blocks = {s: 1 + int(4000 * w**2) % 3001 for s, w in weights.items()} | {"none": 0}
    weights = weights | {"none": 1.0}
    names, got = list(blocks), []
    for s, k in source_mix.schedule(list(blocks.values()), [weights[s] for s in names], window):
        got += zip(s.tolist(), k.tolist(), strict=True)
    assert sorted(got) == [(i, k) for i, s in enumerate(names) for k in range(blocks[s])]
    live, seen = {s: n for s, n in blocks.items() if n}, Counter()
    for t, want in enumerate(ideal(live, weights, min(len(got), 4000))):
        assert all(abs(seen[s] - want[s]) < 1 + 1e-6 for s in live), t
        if t < len(got):
            assert seen[names[got[t][0]]] == got[t][1]
            seen[names[got[t][0]]] += 1


def one_pass(blocks, weights):
    """Earliest deadline first over all blocks, slot by slot, in exact fractions."""
    exact = [Fraction(w) for w in weights]
    ends = sorted((Fraction(n) / w, w, n) for n, w in zip(blocks, exact, strict=True))

    def filled(v):
        return sum(min(w * v, n) for _, w, n in ends)

    jobs = sorted((math.floor(filled(k / w)), math.ceil(filled((k + 1) / w)), s, k) for s, (n, w) in enumerate(zip(blocks, exact, strict=True)) for k in range(n))
    ready, at, out = [], 0, []
    for slot in range(len(jobs)):
        while at < len(jobs) and jobs[at][0] <= slot:
            heapq.heappush(ready, jobs[at][1:])
            at += 1
        deadline, s, k = heapq.heappop(ready)
        assert slot < deadline
        out.append((s, k))
    return out


@pytest.mark.parametrize("seed", range(24))
def test_windows_give_the_schedule_of_one_pass(seed):
    """What a window takes over from those before it is worked out without going through them."""
    rng = random.Random(seed)
    n = rng.choice([1, 2, 3, 7, 20])
    weight = [rng.random, lambda: float(rng.randint(1, 5)), lambda: 1.0, lambda: 10 ** rng.uniform(-4, 0)][seed % 4]
    weights, blocks = [weight() + 1e-9 for _ in range(n)], [rng.choice([1, rng.randint(1, 20), rng.randint(1, 120)]) for _ in range(n)]
    want = one_pass(blocks, weights)
    for window in (rng.randint(1, 9), rng.randint(10, 90), len(want) + 1):
        got = [x for s, k in source_mix.schedule(blocks, weights, window) for x in zip(s.tolist(), k.tolist(), strict=True)]
        assert got == want, window


def test_mix_is_the_same_in_any_windows(spark):
    rows_ = [(i, "abcdefgh"[min(i * i % 61, 7)]) for i in range(900)] + [(900 + i, None) for i in range(5)]
    df = spark.createDataFrame(rows_, "doc_id long, source string")
    weights = {"a": 2**0.5, "b": 1.0, "c": 0.01, "h": 3.0}
    whole, cut = (sorted(map(str, source_mix.mix(df, weights=weights, block_rows=3, window=w).collect())) for w in (None, 17))
    assert whole == cut and len(whole) == 905


def test_mix_keeps_to_the_weights_over_many_frames(spark):
    rows_ = [(i, "b" if i < 12 else "a") for i in range(6000)]
    weights = {"a": 0.9997, "b": 0.0003}
    got = source_mix.mix(spark.createDataFrame(rows_, "doc_id long, source string"), weights=weights, block_rows=1).orderBy("mix_slot").collect()
    assert [r.mix_slot for r in got] == list(range(6000))
    seen = Counter()
    for r, want in zip(got, ideal({"a": 5988, "b": 12}, weights, 5999), strict=True):
        assert all(abs(seen[s] - want[s]) < 1 + 1e-6 for s in "ab")
        seen[r.source] += 1


def test_mix_of_many_sources(spark):
    blocks = {f"site{i}": 1 + i % 5 for i in range(320)}
    weights = {s: 1.0 + i % 11 for i, s in enumerate(blocks)}
    rows_ = [(i, s) for i, s in enumerate(s for s, n in blocks.items() for _ in range(n))]
    got = source_mix.mix(spark.createDataFrame(rows_, "doc_id long, source string"), weights=weights, block_rows=1).orderBy("mix_slot").collect()
    assert [r.mix_slot for r in got] == list(range(len(rows_)))
    seen = Counter()
    for r, want in zip(got, ideal(blocks, weights, len(rows_) - 1), strict=True):
        assert all(abs(seen[s] - want[s]) < 1 + 1e-6 for s in blocks)
        assert r.mix_block == seen[r.source]
        seen[r.source] += 1
    with pytest.raises(ValueError):
        source_mix.mix(spark.createDataFrame(rows_, "doc_id long, source string"), frame=100)


def test_mix_odd(spark):
    df = documents(spark)
    got = source_mix.mixed_order(df)
    assert got.columns == df.columns and sorted(map(str, got.collect())) == sorted(map(str, df.collect()))
    assert source_mix.mixed_order(empty(spark)).count() == 0
    assert "mix_slot" in source_mix.mix(df).columns


def test_shards(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    texts = {r.doc_id: r.text.encode() for r in docs.collect()}
    got = sharding.shard_documents(docs, 7, 16).collect()
    assert sorted(r.doc_id for r in got) == sorted(texts)
    assert all((r.size, r.text_crc32) == (len(texts[r.doc_id]) + 16, zlib.crc32(texts[r.doc_id])) for r in got)
    sizes = Counter(r.shard for r in got)
    assert max(sizes.values()) - min(sizes.values()) <= 1 and len(sizes) == 7
    for s in sizes:
        assert sorted(r.slot for r in got if r.shard == s) == list(range(sizes[s]))


def walked(positions, points, shards):
    """Arc by arc as the plan does, but row by row."""
    import bisect

    n = len(positions)
    room = {s: n // shards + (s < n % shards) for s in range(shards)}
    at = [p for p, _ in points]
    home = lambda p: bisect.bisect_left(at, p) % len(points)
    out, over = {}, {}
    for arc in range(len(points)):
        for p in sorted(q for q in positions if home(q) == arc):
            s = points[arc][1]
            if room[s]:
                out[p], room[s] = s, room[s] - 1
            else:
                over.setdefault(arc, []).append(p)
    carried = []
    for step in range(2 * len(points)):
        arc = step % len(points)
        while carried and room[points[arc][1]]:
            out[carried.pop(0)] = points[arc][1]
            room[points[arc][1]] -= 1
        carried += over.pop(arc, [])
    return out


def test_ring_is_walked_clockwise(spark):
    from pyspark.sql import functions as F

    df = spark.range(500).withColumnRenamed("id", "doc_id")
    points = sharding.ring_points(5, 8)
    placed = {r.doc_id: r.shard for r in sharding.assign(df, F.col("doc_id").cast("string"), 5, 8).collect()}
    at = {r.doc_id: r.p for r in df.select("doc_id", F.shiftrightunsigned(F.xxhash64(F.col("doc_id").cast("string")), 1).alias("p")).collect()}
    want = walked(list(at.values()), points, 5)
    assert placed == {d: want[p] for d, p in at.items()}


def test_shards_odd(spark):
    df = documents(spark)
    got = sharding.shard_documents(df, 4, 8)
    sizes = [r["count"] for r in got.groupBy("shard").count().collect()]
    assert sum(sizes) == df.count() and max(sizes) - min(sizes) <= 1
    assert sharding.shard_documents(empty(spark), 4, 8).count() == 0


def test_no_python_in_native_plans(spark):
    from chunkwright.llm import line_dedup

    for df in (sharding.shard_documents(documents(spark)), line_dedup.dedup_lines(documents(spark))):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert not re.search("Python|Pandas|Arrow", plan)


def test_exact_times_at_a_billion_slots():
    """In windows far out, times are floor and ceil of exact fractions, and what a window takes over is known there."""
    weights = [3.0, 1.0, 1.0, 0.7, 2**0.5]
    times = source_mix.Times([10**10] * 5, weights)
    total = sum(map(Fraction, weights))
    for s, w in enumerate(weights):
        k = np.arange(10**9, 10**9 + 400)
        exact = [Fraction(int(i)) / Fraction(w) * total for i in k]
        source = np.full(len(k), s)
        assert times.whole(source, k, False).tolist() == [math.floor(x) for x in exact]
        assert times.whole(source, k, True).tolist() == [math.ceil(x) for x in exact]
    due, released = times.at_slot(10**9)
    assert set((released - due).tolist()) <= {0, 1} and due.sum() <= 10**9 <= released.sum()


def test_a_source_called_as_none_is(spark):
    rows = [(i, "(none)") for i in range(70)] + [(100 + i, None) for i in range(70)] + [(200, "-"), (201, "=")]
    got = source_mix.mix(spark.createDataFrame(rows, "doc_id long, source string")).collect()
    blocks = {}
    for r in got:
        blocks.setdefault(r.mix_slot, set()).add(r.source)
    assert len(got) == len(rows) and all(len(v) == 1 for v in blocks.values()) and len(blocks) == 3 + 3 + 2
