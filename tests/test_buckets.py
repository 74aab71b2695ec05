"""Repairs of bucketed targets, and jobs that read each side once."""

import os

import pytest
from pyspark.errors import SparkRuntimeException
from pyspark.sql import functions as F

from tidemark.operators import merge
from tidemark.plans import jobs
from tidemark.sources.tables import BucketedTable
from tidemark.spec import JobSpec, TableSpec


def files(root):
    return {os.path.join(d, f) for d, _, names in os.walk(root) for f in names if f.endswith(".parquet")}


def test_a_repair_rewrites_the_buckets_that_hold_its_rows(spark, tmp_path):
    rows = spark.range(4000).selectExpr("id as k", "concat('v', id) as v")
    spec = TableSpec.of(rows, "t", ["k"])
    store = BucketedTable(spark, str(tmp_path / "t"), ["k"], 400)
    store.create(rows.where("k <> 17").withColumn("v", F.expr("if(k in (5, 99), 'x', v)")))
    before = files(tmp_path / "t")
    writes, touched = jobs.repair(rows, store, spec, spec, JobSpec(autocorrect_missing=True, autocorrect_mismatch=True))
    after = files(tmp_path / "t")
    assert sorted(r.k for r in writes.collect()) == [5, 17, 99] and len(touched) <= 3  # 0.1 % of the rows, 0.75 % of the buckets
    assert len(after - before) == len(before - after) == len(touched) and len(before) > 390
    assert sorted(map(tuple, store.read().collect())) == sorted(map(tuple, rows.collect()))
    assert jobs.repair(rows, store, spec, spec, JobSpec(autocorrect_missing=True))[1] == [] and files(tmp_path / "t") == after


def test_a_dry_repair_writes_nothing(spark, tmp_path):
    rows = spark.range(50).selectExpr("id as k", "id as v")
    spec = TableSpec.of(rows, "t", ["k"])
    store = BucketedTable(spark, str(tmp_path / "t"), ["k"], 5)
    store.create(rows.where("k > 0"))
    before = files(tmp_path / "t")
    writes, touched = jobs.repair(rows, store, spec, spec, JobSpec(autocorrect_missing=True, dry_run=True))
    assert (writes.count(), touched) == (1, []) and files(tmp_path / "t") == before


def scans(df):
    return df._jdf.queryExecution().executedPlan().toString().count("FileScan parquet")


def test_each_side_is_scanned_and_shuffled_once(spark, tmp_path):
    rows = spark.range(300).selectExpr("id as k", "id % 7 as v")
    rows.write.parquet(str(tmp_path / "o"))
    rows.where("k > 3").write.parquet(str(tmp_path / "t"))
    o, t = spark.read.parquet(str(tmp_path / "o")), spark.read.parquet(str(tmp_path / "t"))
    spec = TableSpec.of(o, "t", ["k"])
    job = JobSpec(autocorrect_missing=True, autocorrect_mismatch=True)
    checked, after = jobs.autocorrect(o, t, spec, spec, job)
    for df in (checked, after, jobs.validate(o, t, spec, spec, job), jobs.migrate(o, spec, spec, job).merged(t)):
        assert scans(df) == 2
        assert df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") <= 2
        assert df.count() in (300,)
    assert scans(jobs.migrate(o, spec, spec, job).writes) == 1


def test_shared_keys_end_the_job_and_rows_with_errors_may_share(spark):
    rows = spark.createDataFrame([(1, "a", True), (1, "b", False), (2, "c", True)], "k int, v string, ok boolean")
    with pytest.raises(SparkRuntimeException, match="twice"):
        merge.unshared(rows, ["k"], "twice").collect()
    assert merge.unshared(rows, ["k"], "twice", F.col("ok")).count() == 3
    assert merge.unshared(rows.where("ok"), ["k"], "twice").columns == ["k", "v", "ok"]
