"""Range arithmetic against plain integers, and streaming."""

import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators import ranges
from tidemark.sources import reports
from tidemark.streaming import monitor


def run_available(df, table, checkpoint, mode="append"):
    """Processes what is there and gives the result as a table in memory (for tests and small monitors)."""
    query = df.writeStream.format("memory").queryName(table).outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return df.sparkSession.table(table)


def listed(df):
    return sorted((int(r["min"]), int(r["max"])) for r in df.collect())


@pytest.mark.parametrize("seed", range(6))
def test_split_is_exact_and_without_gaps(spark, seed):
    rng = random.Random(seed)
    low = rng.choice([-(1 << 63), rng.randint(-1000, 1000)])
    high = low + rng.choice([0, 10, rng.randint(1, 1 << 40), (1 << 64) - 1])
    high = min(high, (1 << 63) - 1)
    parts = rng.choice([1, 7, 1000])
    got = listed(ranges.split(ranges.ring(spark, low, high), parts))
    size = (high - low) // parts or ranges.FALLBACK_SIZE
    want, at = [], low
    while at <= high:
        want.append((at, min(at + size, high)))
        at += size + 1
    assert got == want


def test_sampling_keeps_the_lower_part(spark):
    whole, part = listed(ranges.split(ranges.ring(spark, 0, 99_999), 10)), listed(ranges.split(ranges.ring(spark, 0, 99_999), 10, 25))
    assert all(a == c and d == a + (b - a) // 100 * 25 + (b - a) % 100 * 25 // 100 for (a, b), (c, d) in zip(whole, part, strict=True))


def test_equal_parts_and_limits(spark):
    one = ranges.ring(spark, 0, 9)
    assert listed(ranges.equal_parts(one, F.lit(3))) == [(0, 3), (4, 6), (7, 9)]
    assert len(listed(ranges.equal_parts(one, F.lit(50)))) == 10
    with pytest.raises(ValueError):
        ranges.split(one, 0)


def test_overlaps_match_all_pairs(spark):
    rng = random.Random(3)
    make = lambda n: sorted((a, a + rng.randint(0, 400)) for a in (rng.randint(0, 5000) for _ in range(n)))
    left, right = make(40), make(30)
    l = spark.createDataFrame(left, "min long, max long").select(*(F.col(c).cast("decimal(38,0)") for c in ("min", "max")))
    r = spark.createDataFrame(right, "r_min long, r_max long").select(*(F.col(c).cast("decimal(38,0)") for c in ("r_min", "r_max")))
    got = sorted((int(x["min"]), int(x["max"]), int(x["r_min"]), int(x["r_max"])) for x in ranges.overlaps(l, r).collect())
    assert got == sorted((a, b, c, d) for a, b in left for c, d in right if a <= d and c <= b)


def test_stream_counts_each_range_once(spark, tmp_path):
    rows = [("2024-01-01 00:00:0%d" % s, "t", 1, "n", "RangeCompleted", s, s, "PASS", None, None, None, 10) for s in (1, 1, 2, 3)] + [("2024-01-01 00:10:00", "t", 1, "n", "RunCompleted", None, None, None, None, None, None, 0)]
    schema = reports.EVENTS.replace("at timestamp", "at string")
    spark.createDataFrame(rows, schema).coalesce(1).write.json(str(tmp_path / "events"))
    out = run_available(monitor.per_second(monitor.read_events(spark, str(tmp_path / "events"))), "per_second", str(tmp_path / "checkpoint"))
    done = {str(r.second)[-2:]: (r.n_events, r.n_rows) for r in out.where("type = 'RangeCompleted'").collect()}
    assert done == {"01": (1, 10), "02": (1, 10), "03": (1, 10)}


def test_bounds_and_work_lists(spark):
    assert ranges.resolve_bounds("murmur3") == (-(1 << 63), (1 << 63) - 1)
    assert ranges.resolve_bounds("random", low=5) == (5, (1 << 127) - 1)
    assert ranges.resolve_bounds("ordered", 1, 2) == (1, 2)
    for wrong in (("ordered", 1, None), ("murmur3", 5, 4)):
        with pytest.raises(ValueError):
            ranges.resolve_bounds(*wrong)
    make = lambda rows: spark.createDataFrame(rows, "min long, max long")
    assert listed(ranges.from_work_list(make([(0, 5), (6, 9)]))) == [(0, 5), (6, 9)]
    for rows in ([], [(0, 5), (5, 9)], [(4, 3)]):
        with pytest.raises(ValueError):
            ranges.from_work_list(make(rows))


def plan_of(spark, pairs):
    return spark.createDataFrame([(n, a, b) for n, (a, b) in enumerate(pairs)], "range_id long, min long, max long").select("range_id", *(F.col(c).cast("decimal(38,0)") for c in ("min", "max")))


def uneven():
    """Four ranges over all 64 bits, one of them cut in 3,000 within a span of 2 to the 20, and some of those in single tokens."""
    low, high, at = -(1 << 63), (1 << 63) - 1, 12_345
    dense = [(at + 300 * n, at + 300 * n + 299) for n in range(3000)]
    dense = dense[:-2] + [(a, a) for a in range(dense[-2][0], dense[-1][1] + 1)]
    return [(low, -1), *dense, (dense[-1][1] + 1, 1 << 62), ((1 << 62) + 10, high - 1), (high, high)]


def test_uneven_plans_compare_a_token_with_few_ranges(spark):
    pairs = uneven()
    named = plan_of(spark, pairs).select("range_id", F.col("min").cast("long").alias("_r_min"), F.col("max").cast("long").alias("_r_max"))
    root, levels, leaves = ranges.grids(named, pairs[0][0], pairs[-1][1], len(pairs))
    assert levels and leaves.groupBy("_node", "_cell").count().agg(F.max("count")).first()[0] <= ranges.LEAF_RANGES
    assert leaves.count() < 8 * len(pairs)
    rng = random.Random(9)
    tokens = [rng.choice([rng.randint(12_000, 1_000_000), rng.randint(-(1 << 63), (1 << 63) - 1)]) for _ in range(2000)] + [x for pair in pairs[-700:] for x in pair] + [(1 << 62) + 5, None]
    got = ranges.assigned(spark.createDataFrame([(t,) for t in tokens], "token long"), "token", plan_of(spark, pairs))
    assert got.columns == ["token", "range_id"]
    import bisect

    starts = [a for a, _ in pairs]
    want = [(t, n) for t in tokens if t is not None for n in [bisect.bisect_right(starts, t) - 1] if n >= 0 and t <= pairs[n][1]]
    assert sorted(map(tuple, got.collect())) == sorted(want)


def test_an_even_plan_has_one_grid(spark):
    pairs = [(n * 1000, n * 1000 + 999) for n in range(500)]
    named = plan_of(spark, pairs).select("range_id", F.col("min").cast("long").alias("_r_min"), F.col("max").cast("long").alias("_r_max"))
    assert ranges.grids(named, 0, 499_999, 500)[1] == []


def test_order_and_conflicts_in_cells_of_equal_depth(spark, monkeypatch):
    monkeypatch.setattr(ranges, "CELL_RANGES", 100)
    pairs = uneven()
    plan = plan_of(spark, random.Random(1).sample(pairs, len(pairs)))
    got = {int(r["min"]): r.work_order for r in ranges.ring_order(plan).collect()}
    assert got == {a: n for n, (a, _) in enumerate(pairs)}
    assert ranges.in_cells(plan).groupBy("_cell").count().agg(F.max("count")).first()[0] < 400
    assert ranges.conflicts(plan).count() == 0
    wrong = plan.withColumn("max", F.when(F.col("min") == 12_345, F.col("max") + 1).otherwise(F.col("max")).cast("decimal(38,0)"))
    assert [int(r.next_min) for r in ranges.conflicts(wrong).collect()] == [12_645]
