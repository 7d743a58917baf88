"""Planner cases, and the balanced split against the greedy loop that it stands for."""

import random
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from chunkwright.plans import chunk_plan as plans

CATALOG = "schema string, table string, kind string, est_rows long, bytes long, n_blocks long, key_col string, key_min long, key_max long"


def catalog(spark, *rows):
    return spark.createDataFrame([("public", *r) for r in rows], CATALOG)


def rows_of(df, *columns):
    return [tuple(r[c] for c in columns) for r in df.orderBy("table", "idx").collect()]


def half_up(x):
    return int(x + Fraction(1, 2))


def greedy(samples, lo, hi, n, total_bytes, total_rows):
    """Cut by cut, as a loop."""
    total, out, start, cum, b, k = sum(s[1] for s in samples), [], lo, 0, 0, 0
    for pk, size in samples:
        cum, b, k = cum + size, b + size, k + 1
        if cum * n >= (len(out) + 1) * total and len(out) < n - 1:
            out.append([start, pk, half_up(Fraction(b * total_bytes, total)), half_up(Fraction(k * total_rows, len(samples)))])
            start, b, k = pk + 1, 0, 0
    if start <= hi or not out:
        out.append([start, hi, 0, 0])
    out[-1][1] = hi
    for i, whole in ((2, total_bytes), (3, total_rows)):
        out[-1][i] = max(0, whole - sum(c[i] for c in out[:-1]))
    return [tuple(c) for c in out]


def test_balanced_is_the_greedy_loop(spark):
    rng, tables, samples, want = random.Random(7), [], [], {}
    for t in range(60):
        name, n = f"t{t:02d}", rng.randint(2, 9)
        lo = rng.randint(-50, 50)
        pks = sorted(rng.sample(range(lo, lo + 400), rng.randint(1, 60)))
        own = [(pk, rng.choice([1, 5, 20, 900])) for pk in pks]
        hi, rows = pks[-1] + rng.choice([0, 0, 30]), rng.randint(len(pks), 5000)
        tables.append((name, "r", rows, n * 100, 10, "k", pks[0], hi))
        samples += [("public", name, *s) for s in own]
        want[name] = greedy(own, pks[0], hi, n, n * 100, rows)
    got = plans.plan_balanced(catalog(spark, *tables), spark.createDataFrame(samples, "schema string, table string, pk long, bytes long"), 100, 50)
    found = {}
    for r in rows_of(got, "table", "range_start", "range_end", "est_bytes", "est_rows"):
        found.setdefault(r[0], []).append(r[1:])
    assert found == want
    audit = plans.audit_plan(got, catalog(spark, *tables)).collect()
    assert all(r.contiguous and r.bounds_match and r.none_negative for r in audit)


def test_strategy(spark):
    c = catalog(spark, ("a", "r", 10, 99, 5, "k", 1, 9), ("b", "r", 10, 100, 5, "k", 1, 9), ("c", "r", 10, 100, 5, None, None, None), ("d", "r", 0, 100, 0, "k", None, None))
    assert [(r.table, r.strategy) for r in plans.choose_strategy(c, 100).orderBy("table").collect()] == [("a", "single"), ("b", "key_range"), ("c", "block_range"), ("d", "single")]


def test_even(spark):
    got = rows_of(plans.plan_even(catalog(spark, ("t", "r", 100_000, 4 * 10**9, 0, "id", 1, 10_000_000)), 1 << 30, 64), "idx", "range_start", "range_end", "est_bytes", "est_rows")
    assert [g[0] for g in got] == [0, 1, 2, 3] and got[0][1] == 1 and got[-1][2] == 10_000_000
    assert all(a[2] + 1 == b[1] for a, b in zip(got, got[1:], strict=False))
    assert sum(g[3] for g in got) == 4 * 10**9 and sum(g[4] for g in got) == 100_000


def test_even_has_no_empty_ranges(spark):
    got = rows_of(plans.plan_even(catalog(spark, ("t", "r", 5, 400, 0, "id", 1, 5)), 100, 64), "range_start", "range_end", "est_bytes")
    assert [g[:2] for g in got] == [(1, 2), (3, 4), (5, 5)] and sum(g[2] for g in got) == 400


@pytest.mark.parametrize(("n_blocks", "most", "n"), [(365_000, 64, 3), (365_000, 2, 2), (1, 8, 1)])
def test_blocks(spark, n_blocks, most, n):
    got = rows_of(plans.plan_blocks(catalog(spark, ("t", "r", 1001, 3 * 10**9, n_blocks, None, None, None)), 131_072, most), "block_start", "block_end", "est_bytes", "est_rows")
    assert len(got) == n and got[-1][1] is None and sum(g[2] for g in got) == 3 * 10**9 and sum(g[3] for g in got) == 1001


def test_skew_makes_the_first_range_wider(spark):
    samples = spark.createDataFrame([("public", "t", i * 100_000, 10 if i <= 50 else 90) for i in range(1, 101)], "schema string, table string, pk long, bytes long")
    got = rows_of(plans.plan_balanced(catalog(spark, ("t", "r", 100_000, 4 * 10**9, 0, "id", 1, 10_000_000)), samples, 1 << 30, 64), "range_start", "range_end", "est_rows")
    assert len(got) == 4 and got[0][1] - got[0][0] > got[-1][1] - got[-1][0] and got[0][2] > got[-1][2]


def test_no_samples_falls_back_to_even(spark):
    c = catalog(spark, ("t", "r", 100, 400, 0, "id", 1, 100), ("z", "r", 100, 400, 0, "id", 1, 100))
    samples = spark.createDataFrame([("public", "z", 5, 0)], "schema string, table string, pk long, bytes long")
    assert rows_of(plans.plan_balanced(c, samples, 100, 64), *plans.PLAN) == rows_of(plans.plan_even(c, 100, 64), *plans.PLAN)


def test_missing_estimates(spark):
    plan = plans.plan_even(catalog(spark, ("t", "r", 100, 1000, 0, "id", 1, 10)), 500, 9)
    bare = plan.withColumn("est_bytes", F.lit(None).cast("long")).withColumn("est_rows", F.lit(None).cast("long"))
    assert rows_of(plans.fill_estimates(bare, catalog(spark, ("t", "r", 100, 1000, 0, "id", 1, 10))), "est_bytes", "est_rows") == [(500, 50)] * 2


def test_paths_and_order(spark):
    plan = plans.plan_single(spark.createDataFrame([("my/schema", "my:table", "r", 1, 5, 1, None, None, None)], CATALOG))
    assert plans.chunk_paths(plan).first().file == "data/my_schema.my_table/chunk_0000.parquet.zstd"
    jobs = plans.plan_single(catalog(spark, ("a", "r", 1, 5, 1, None, None, None), ("b", "r", 1, 50, 1, None, None, None)))
    assert [r.table for r in plans.order_jobs(jobs).orderBy("place").collect()] == ["b", "a"]
