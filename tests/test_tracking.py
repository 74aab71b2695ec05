"""Run tracking: chains of any depth, and runs of several tables in one log."""

import pytest

from tidemark.plans import catalog, jobs, tracking
from tidemark.spec import JobSpec, TableSpec


def test_chains_of_any_depth(spark):
    runs = [("t", n, n - 1) for n in range(1, 3001)] + [("t", a, b) for a, b in ((4001, 0), (4002, 4001), (5001, 5002), (5002, 5001), (6001, 6000), (6002, 6001))]
    other = [("u", 1, 0), ("u", 3, 1), ("u", 2, 4002)]  # the run that would go on stands in the other table
    found = tracking.chain(spark.createDataFrame(runs + other + [("t", 2, 1)], "table_name string, run_id long, prev_run_id long")).collect()
    want = [("t", n, 1, n - 1) for n in range(1, 3001)] + [("t", 4001, 4001, 0), ("t", 4002, 4001, 1), ("u", 1, 1, 0), ("u", 3, 1, 1)]
    assert sorted(map(tuple, found)) == want  # neither those in a circle nor those after an unknown run


def test_links_do_not_pass_through_the_driver(spark):
    """No round broadcasts: Spark is told to refuse broadcasts of any size."""
    rows = spark.range(1, 1001).selectExpr("'t' as table_name", "id as run_id", "greatest(id - 7, 0) as prev_run_id")
    spark.conf.set("spark.sql.maxBroadcastTableSize", "1b")
    try:
        found = tracking.chain(rows).collect()
    finally:
        spark.conf.unset("spark.sql.maxBroadcastTableSize")
    assert sorted(map(tuple, found)) == [("t", n, (n - 1) % 7 + 1, (n - 1) // 7) for n in range(1, 1001)]


def test_chains_of_all_runs_without_broadcasts(spark, data):
    spark.conf.set("spark.sql.maxBroadcastTableSize", "1b")
    try:
        found = catalog.queries()["resume_chain_all"](spark, data).collect()
    finally:
        spark.conf.unset("spark.sql.maxBroadcastTableSize")
    assert len(found) == 35 and sum(r.n_runs for r in found) == spark.read.parquet(f"{data}/customer.parquet").count()


def test_runs_of_two_tables_share_ids(spark, tmp_path):
    log = tracking.RunLog(spark, str(tmp_path / "log"))
    plan = spark.createDataFrame([(0, 9), (10, 19), (20, 29)], "token_min long, token_max long")
    rows = spark.range(30).selectExpr("id as k", "id as token", "id % 5 as v")
    for name, broken in (("a", 3), ("b", 12)):
        spec = TableSpec.of(rows, name, ["k"])
        target = rows.where(f"k <> {broken}")
        jobs.recorded_validate(log, 1, plan, rows, "token", target, spec, spec, JobSpec())
    details, info = log.details(), log.info()
    by = {(r.table_name, r.status): r.n_ranges for r in tracking.by_status(details).collect()}
    assert by == {(t, s): n for t in "ab" for s, n in (("PASS", 2), ("DIFF", 1))}
    assert [(t, r.token_min) for t in "ab" for r in tracking.pending(details, t, 1).collect()] == [("a", 0), ("b", 10)]
    assert sorted(r.token_min for r in tracking.outstanding(plan, details, "b", 1).collect()) == [10]
    assert tracking.pending_sample(details, "a", 1).first().n_pending == 1
    assert {(r.table_name, r.counter): r.n for r in tracking.totals(details).where("counter = 'Missing'").collect()} == {("a", "Missing"): 1, ("b", "Missing"): 1}
    weights = spark.createDataFrame([(t, a, 10) for t in "ab" for a in (0, 10, 20)], "table_name string, token_min long, weight long")
    assert [(r.table_name, r.n_ranges, r.weight) for r in tracking.progress(details, weights).orderBy("table_name").collect()] == [("a", 3, 30), ("b", 3, 30)]
    with pytest.raises(ValueError, match="no run 1 of c"):
        tracking.check_resumable(info, details, "c", 1)
    redone = []
    jobs.resume(log, "b", 1, 2, 1, False, lambda part: redone.extend(r.token_min for r in part.collect()))
    assert redone == [10]
