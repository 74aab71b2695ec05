"""The run monitor over events that come late, again, and in several batches."""

import json

from pyspark.sql import functions as F

from tidemark.sources import reports
from tidemark.streaming import monitor


def log_of(spark, path, batches):
    for n, rows in enumerate(batches):
        frame = spark.createDataFrame(rows, "s long, table_name string, run_id long, type string, token_min long, status string, kind string, key string, rows long")
        reports.events(frame.select("*"), at=F.timestamp_seconds("s"), **{c: F.col(c) for c in ("table_name", "run_id", "type", "token_min", "status", "kind", "key", "rows")}).coalesce(1).write.mode("append").json(str(path))
    return str(path)


def ended(s, run, token, status, rows):
    return (s, "t", run, "RangeCompleted", token, status, None, None, rows)


def found(s, run, kind, key):
    return (s, "t", run, "Discrepancy", None, None, kind, key, 1)


def batches():
    first = [ended(1000, 1, 0, "PASS", 10), ended(1001, 1, 5, "STARTED", 3), ended(1002, 1, 9, "DIFF", 7)] + [found(1003, 1, "mismatch", f"k{n}") for n in range(25)]
    hour = [ended(4600, 1, 0, "PASS", 10), ended(4601, 1, 5, "FAIL", 20), *[found(4602, 1, "missing", f"k{n}") for n in range(50)], *[found(4603, 1, "mismatch", f"k{n}") for n in range(25)]]
    late = [ended(1002, 1, 9, "DIFF", 7), ended(1004, 1, 11, "PASS", 1), ended(4605, 2, 0, "PASS", 2)]
    return [first, hour, late]


def test_events_count_once_however_late(spark, tmp_path):
    path = log_of(spark, tmp_path / "log", batches())
    got = monitor.run_to_files(monitor.once(monitor.read_events(spark, path, 1)), str(tmp_path / "once"))
    counted = {(r.run_id, r.type, r.what): (r.n, r.rows) for r in got.groupBy("run_id", "type", F.coalesce("status", "kind").alias("what")).agg(F.count("*").alias("n"), F.sum("rows").alias("rows")).collect()}
    assert counted == {(1, "RangeCompleted", "PASS"): (2, 11), (1, "RangeCompleted", "DIFF"): (1, 7), (1, "RangeCompleted", "FAIL"): (1, 20), (2, "RangeCompleted", "PASS"): (1, 2), (1, "Discrepancy", "mismatch"): (25, 25), (1, "Discrepancy", "missing"): (50, 50)}


def test_the_earliest_of_a_batch_counts(spark, tmp_path):
    """The repeats lie in the larger file, which is read first, in one batch with the first ends."""
    first = [ended(1000, run, token, "PASS", 10) for run in (1, 2) for token in range(40)] + [found(1000, 1, "missing", None)]
    again = [ended(4600, run, token, "DIFF_CORRECTED", 123456) for run in (1, 2) for token in range(40)] * 3 + [found(4600, 1, "missing", None)]
    path = log_of(spark, tmp_path / "log", [again, first])
    got = monitor.run_to_files(monitor.once(monitor.read_events(spark, path)), str(tmp_path / "once"))
    assert got.count() == 81 and {(r.s, r.status, r.rows) for r in got.select(F.unix_seconds("at").alias("s"), "status", "rows").collect()} == {(1000, "PASS", 10), (1000, None, 1)}


def test_progress_adds_up_over_batches(spark, tmp_path):
    path = log_of(spark, tmp_path / "log", batches())
    rows = monitor.run_to_files(monitor.progress(monitor.read_events(spark, path, 1), shards=3), str(tmp_path / "progress"))
    assert rows.agg(F.max("batch")).first()[0] > 1
    got = {r.run_id: r for r in monitor.latest_progress(rows).collect()}
    assert got[1].tallies == {"RangeCompleted:PASS": 2, "RangeCompleted:DIFF": 1, "RangeCompleted:FAIL": 1, "Discrepancy:mismatch": 25, "Discrepancy:missing": 50}
    assert (got[1].n_rows, got[2].n_rows) == (38, 2)
    assert got[1].rows_per_second == 2.0  # the 20 rows of the last ten seconds of its events
    assert got[2].rows_per_second == 0.2


def test_rates_do_not_depend_on_shards(spark, tmp_path):
    """Shards' rates as doubles don't add up to the run's, and shards whose last event is older look back further than the run."""
    rows = [ended(1000, 1, token, "PASS", token % 7 + 1) for token in range(200)] + [ended(1012, 1, 1000, "PASS", 3)] + [ended(1010, 2, token, "PASS", 1) for token in range(203)]
    path = log_of(spark, tmp_path / "log", [rows])
    got = {r.run_id: r.rows_per_second for r in monitor.latest_progress(monitor.run_to_files(monitor.progress(monitor.read_events(spark, path)), str(tmp_path / "progress"))).collect()}
    assert got == {1: 0.3, 2: 20.3}


def test_json_arrays_with_shared_keys(spark):
    rows = spark.createDataFrame([("k", 1), ("k", 1), ("k", 2), ("j", 1), ("j", 1)], "key string, n int")
    for part, want in ((rows, 5), (rows.limit(1), 1), (rows.limit(0), 0)):
        assert len(json.loads("\n".join(r.value for r in reports.json_array(part).collect()))) == want
