"""What users add: work by range, several records of a row, and options that a summary names by their hash."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators import metrics
from tidemark.plans import jobs, tracking
from tidemark.spec import JobSpec, TableSpec


def plan_of(spark):
    return spark.createDataFrame([(0, 9), (10, 19), (20, 29), (30, 39)], "token_min long, token_max long")


def test_a_range_that_raises_fails_alone(spark, tmp_path):
    registry = jobs.JobRegistry()

    @registry.range_job("halves", ["EVEN", "ODD"])
    def halves(low, high, batches, counts):
        for batch in batches:
            for n in batch.column("token").to_pylist():
                assert low <= n <= high
                if n == 15:
                    raise RuntimeError("no fifteen")
                counts.add("ODD" if n % 2 else "EVEN")

    log = tracking.RunLog(spark, str(tmp_path / "log"))
    rows = spark.range(30).selectExpr("id as token", "concat('v', id) as v")  # the last range has no rows
    done = registry.run_ranges("halves", log, "t", 1, plan_of(spark), rows.orderBy("token"), "token")
    got = {r.token_min: (r.status, r.run_info) for r in tracking.latest_ranges(done).collect()}
    assert {k: v[0] for k, v in got.items()} == {0: "PASS", 10: "FAIL", 20: "PASS", 30: "PASS"}
    assert got[0][1] == "Read: 10; Even: 5; Odd: 5; Error: 0; Partitions Passed: 1; Partitions Failed: 0"
    counted = {k: int(v) for k, v in (x.split(": ") for x in got[10][1].split("; "))}
    assert counted["Read"] == 10 and counted["Even"] + counted["Odd"] + counted["Error"] == 10 and counted["Error"] > 0
    total = tracking.latest_runs(log.info()).first().run_info
    assert "Read: 30" in total and "Partitions Passed: 3; Partitions Failed: 1" in total
    assert [r.token_min for r in tracking.pending(log.details(), "t", 1).collect()] == [10]
    jobs.resume(log, "t", 1, 2, 5, False, lambda part: registry.run_ranges("halves", log, "t", 2, part, rows.where("token <> 15"), "token", 1))
    assert {r.status for r in tracking.latest_ranges(tracking.of_run(log.details(), "t", 2)).collect()} == {"PASS"}


def test_jobs_by_range_are_checked(spark, tmp_path):
    registry = jobs.JobRegistry()
    registry.range_job("odd ones", ["ODD"])(lambda low, high, batches, counts: counts.add("EVEN"))
    with pytest.raises(ValueError, match="already"):
        registry.range_job("odd ones", ["ODD"])
    with pytest.raises(ValueError, match="already"):
        registry.range_job("migrate", [])
    with pytest.raises(ValueError, match="counters of odd ones"):
        metrics.register("odd ones", ["OTHER"])
    with pytest.raises(ValueError, match="no job x"):
        registry.run_ranges("x", None, "t", 1, None, None, "token")
    done = jobs.run_ranges(spark.range(5).withColumnRenamed("id", "token"), "token", plan_of(spark), registry.runners["odd ones"], ["READ", "ODD"]).collect()
    assert [(r.token_min, r.failed, r.n_read, r.n_odd, r.error[:9]) for r in done] == [(0, True, 5, 0, "KeyError:")]


def test_several_records_of_a_row(spark):
    rows = spark.createDataFrame([(1, "a b"), (2, ""), (3, "c"), (4, None)], "k int, words string")
    spec = TableSpec("t", T._parse_datatype_string("k int, n int, words string"), ("k",), ("n",))
    words = F.transform(F.array_remove(F.split("words", " "), ""), lambda w, n: F.struct(n.alias("n"), w.alias("words")))
    own = jobs.Extensions(records=words)
    done = jobs.migrate(rows, spec, spec, JobSpec(where="k < 4"), extensions=own)
    assert tuple(done.counters().first()) == (4, 3, 2, 0)
    assert tuple(done.counters(flushed=False).first()) == (4, 0, 2, 0, 3)
    target = done.merged(spark.createDataFrame([], spec.schema))
    assert sorted(map(tuple, target.collect())) == [(1, 0, "a"), (1, 1, "b"), (3, 0, "c")]
    checked, after = jobs.autocorrect(rows, target.where("words <> 'b'"), spec, spec, JobSpec(autocorrect_missing=True), extensions=own)
    assert sorted((r.k, r.n, r.outcome) for r in checked.collect()) == [(1, 0, "VALID"), (1, 1, "MISSING"), (3, 0, "VALID")]
    assert after.count() == 3

    @F.udf("array<struct<n:int,words:string>>")
    def by_hand(text):
        return list(enumerate((text or "").split()))

    assert jobs.migrate(rows, spec, spec, JobSpec(), extensions=jobs.Extensions(records=by_hand("words"))).writes.count() == 3


def test_options_have_one_hash(spark):
    one = JobSpec(codecs=frozenset({"B", "A"}), renames=[("a", "b")])
    assert one.config_hash() == JobSpec(renames=[("a", "b")], codecs=frozenset({"A", "B"})).config_hash() != JobSpec().config_hash()
    assert JobSpec(batches="odd").violations()[0].rule == "batches"
