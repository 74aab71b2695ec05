"""Small end-to-end cases: mapping, merge, counters, autocorrect, guardrail and resume."""

import pytest
from pyspark.errors import SparkRuntimeException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators import merge, reconcile
from tidemark.operators.mapping import Mapping
from tidemark.plans import jobs, tracking
from tidemark.spec import Explode, Extract, JobSpec, SpecError, TableSpec


def rows(df, *columns):
    return sorted(tuple(r) for r in (df.select(*columns) if columns else df).collect())


def test_plain_table_is_copied_and_valid(spark):
    o = spark.createDataFrame([("k1", "a"), ("k2", "b")], "key string, value string")
    spec = TableSpec.of(o, "kvp", ["key"])
    m = jobs.migrate(o, spec, spec, JobSpec())
    assert rows(m.counters()) == [(2, 2, 0, 0)]
    target = m.merged(o.limit(0))
    assert rows(target) == rows(o)
    assert rows(jobs.validate(o, target, spec, spec, JobSpec()).groupBy("outcome").count()) == [("VALID", 2)]


def test_missing_and_differing_rows_are_repaired(spark):
    o = spark.createDataFrame([("key1", "a"), ("key2", "b"), ("key3", "c")], "key string, value string")
    t = spark.createDataFrame([("key1", "a"), ("key3", "x")], "key string, value string")
    spec = TableSpec.of(o, "kvp", ["key"])
    job = JobSpec(autocorrect_missing=True, autocorrect_mismatch=True)
    checked, fixed = jobs.autocorrect(o, t, spec, spec, job)
    n = jobs.validation_counters(checked, [], job).first()
    assert (n.n_read, n.n_valid, n.n_missing, n.n_mismatch, n.n_corrected_missing, n.n_corrected_mismatch, n.verdict) == (3, 1, 1, 1, 1, 1, "DIFF_CORRECTED")
    assert rows(fixed) == rows(o)


def test_newer_cells_stay_and_unset_cells_are_left_alone(spark):
    o = spark.createDataFrame([("a", "new", 50), ("b", "new", 50), ("c", None, 50)], "key string, v string, v__wt long")
    t = spark.createDataFrame([("a", "old", 10), ("b", "newest", 90), ("c", "kept", 10)], "key string, v string, v__wt long")
    spec = TableSpec("t", T._parse_datatype_string("key string, v string"), ("key",))
    out = jobs.migrate(o, TableSpec.of(o, "o", ["key"]), spec, JobSpec()).merged(t)
    assert rows(out, "key", "v", "v__wt") == [("a", "new", 50), ("b", "newest", 90), ("c", "kept", 10)]


def test_counters_are_corrected_by_difference(spark):
    o = spark.createDataFrame([("r1", 10, None), ("r2", 20, 5), ("r3", 7, 7)], "key string, c1 long, c2 long")
    t = spark.createDataFrame([("r1", 4, 1), ("r2", 20, 5)], "key string, c1 long, c2 long")
    spec = TableSpec.of(o, "counters", ["key"], counters={"c1", "c2"})
    job = JobSpec(autocorrect_missing=True, autocorrect_mismatch=True)
    assert rows(jobs.autocorrect(o, t, spec, spec, job)[1]) == [("r1", 10, 1), ("r2", 20, 5)]
    forced = JobSpec(autocorrect_missing=True, autocorrect_mismatch=True, autocorrect_missing_counter=True)
    assert rows(jobs.autocorrect(o, t, spec, spec, forced)[1]) == [("r1", 10, 1), ("r2", 20, 5), ("r3", 7, 7)]


def test_map_entries_with_constants_and_conversion(spark):
    o = spark.createDataFrame([("k1", "1000", {"apple": 3, "pear": 4}), ("k2", "2000", {}), ("k3", "x", {"fig": 1})], "key string, time string, fruits map<string,int>")
    target = TableSpec("t", T._parse_datatype_string("const1 string, const2 int, key string, fruit string, time timestamp, fruit_qty int"), ("const1", "const2", "key"), ("fruit",))
    job = JobSpec(constants={"const1": "'abcd'", "const2": "1234"}, explode=Explode("fruits", "fruit", "fruit_qty"), codecs=frozenset({"TIMESTAMP_STRING_MILLIS"}))
    m = jobs.migrate(o, TableSpec.of(o, "o", ["key"]), target, job)
    assert rows(m.counters()) == [(3, 2, 1, 1)]
    assert [(r.const1, r.const2, r.key, r.fruit, r.ms, r.fruit_qty) for r in m.writes.withColumn("ms", F.unix_millis("time")).orderBy("fruit").collect()] == [("abcd", 1234, "k1", "apple", 1000, 3), ("abcd", 1234, "k1", "pear", 1000, 4)]


def test_reserved_and_odd_names(spark):
    o = spark.createDataFrame([("a", "b", 1)], ["col1", "order", "fruit-map.x"])
    spec = TableSpec.of(o, "reserved", ["col1"])
    assert rows(jobs.migrate(o, spec, spec, JobSpec()).merged(o.limit(0))) == rows(o)


def test_null_timestamp_in_key(spark):
    o = spark.createDataFrame([("k", None, "v")], "key string, ts timestamp, value string")
    spec = TableSpec.of(o, "t", ["key"], ["ts"])
    assert jobs.migrate(o, spec, spec, JobSpec()).counters().first().n_error == 1
    m = jobs.migrate(o, spec, spec, JobSpec(missing_key_timestamp_ms=1685577600000))
    assert [r.ms for r in m.writes.select(F.unix_millis("ts").alias("ms")).collect()] == [1685577600000]


def test_dropped_key_columns_are_reported_before_rows_merge(spark):
    o = spark.createDataFrame([(1, "a", "x"), (1, "b", "y")], "key_a int, key_b string, val string")
    target = TableSpec("t", T._parse_datatype_string("key_a int, val string"), ("key_a",))
    m = jobs.migrate(o, TableSpec.of(o, "o", ["key_a"], ["key_b"]), target, JobSpec())
    with pytest.raises(SparkRuntimeException, match="rows of o share keys of t"):
        m.merged(spark.createDataFrame([], "key_a int, val string")).collect()
    assert m.merged(spark.createDataFrame([], "key_a int, val string"), on_duplicate="latest").count() == 1


def test_vectors_lists_sets_and_structs(spark):
    o = spark.createDataFrame([(1, [1.0, 2.0, 3.0], ["b", "a", "b"], {"k": 1}, (1, "t"))], "id int, e array<float>, s array<string>, m map<string,int>, u struct<a:int,b:string>")
    fields = [T.StructField("id", T.IntegerType()), T.StructField("e", T.ArrayType(T.FloatType()), metadata={"dimensions": 3}), T.StructField("s", T.ArrayType(T.StringType()), metadata={"set": True}), T.StructField("m", T.MapType(T.StringType(), T.IntegerType())), T.StructField("u", T._parse_datatype_string("b:string,a:int"))]
    target = TableSpec("t", T.StructType(fields), ("id",))
    m = jobs.migrate(o, TableSpec.of(o, "o", ["id"]), target, JobSpec())
    row = m.writes.first()
    assert row.s == ["a", "b"] and (row.u.a, row.u.b) == (1, "t")
    short = o.withColumn("e", F.slice("e", 1, 2))
    assert jobs.migrate(short, TableSpec.of(o, "o", ["id"]), target, JobSpec()).counters().first().n_error == 1


def test_json_states(spark):
    o = spark.createDataFrame([(1, '{"a": {"b": 1}}'), (2, '{"a": null}'), (3, "{}"), (4, "{"), (5, None), (6, '{"a": "x"}')], "id int, doc string")
    target = TableSpec("t", T._parse_datatype_string("id int, a string"), ("id",))
    got = jobs.migrate(o, TableSpec.of(o, "o", ["id"]), target, JobSpec(extract=Extract("doc", "a", "a"))).rows
    assert rows(got, "id", "a", "outcome") == [(1, '{"b":1}', "WRITE"), (2, None, "WRITE"), (3, None, "WRITE"), (4, None, "ERROR"), (5, None, "WRITE"), (6, "x", "WRITE")]


def test_empty_collections_compare_as_null_unless_strict(spark):
    o = spark.createDataFrame([(1, [])], "id int, x array<int>")
    t = spark.createDataFrame([(1, None)], "id int, x array<int>")
    assert reconcile.validate(o, t, ["id"]).first().outcome == "VALID"
    assert reconcile.validate(o, t, ["id"], strict_empty=True).first().outcome == "MISMATCH"


def test_all_violations_at_once(spark):
    o = TableSpec("o", T._parse_datatype_string("a int, b string"), ("a",))
    with pytest.raises(SpecError) as e:
        Mapping.resolve(o, o, JobSpec(parts=0, skip=["a", "z"], renames=[("q", "b")], coverage=0))
    assert len(e.value.violations) >= 5
    with pytest.raises(SpecError):
        JobSpec.parse_rename("a:b:c")
    with pytest.raises(SpecError):
        JobSpec.constants_of("a,b", "1")


def test_rename_keeps_the_same_name_too(spark):
    o = TableSpec("o", T._parse_datatype_string("k int, a string"), ("k",))
    t = TableSpec("t", T._parse_datatype_string("k int, a string, b string"), ("k",))
    assert {s.target: s.origin for s in Mapping.resolve(o, t, JobSpec(renames=[("a", "b")])).sources} == {"k": "k", "a": "a", "b": "a"}


def test_resume_refuses_and_quarantines(spark):
    info = spark.createDataFrame([("t", 1, "MIGRATE", 0, None, None, "", "NOT_STARTED")], tracking.RUN_INFO)
    details = spark.createDataFrame([], tracking.RUN_DETAILS)
    with pytest.raises(ValueError):
        tracking.check_resumable(info, details, "t", 1)
    with pytest.raises(ValueError):
        tracking.check_resumable(info, details, "t", 2)


def test_times_without_zone_are_compared_and_measured(spark):
    o = spark.sql("SELECT 1 AS id, timestamp_ntz'2024-01-01 00:00:00.123456' AS at")
    t = spark.sql("SELECT 1 AS id, timestamp_ntz'2024-01-01 00:00:00.123999' AS at")
    assert reconcile.validate(o, t, ["id"]).first().outcome == "VALID"
    assert jobs.profile(o, TableSpec.of(o, "o", ["id"])).first().n_bytes == 12


def test_targets_with_shared_keys_are_refused(spark):
    o = spark.createDataFrame([(1, "a")], "k int, v string")
    t = spark.createDataFrame([(1, "a"), (1, "b")], "k int, v string")
    spec = TableSpec.of(o, "t", ["k"])
    with pytest.raises(SparkRuntimeException, match="rows of t share its key"):
        jobs.validate(o, t, spec, spec, JobSpec()).collect()
    for frame in jobs.autocorrect(o, t, spec, spec, JobSpec(autocorrect_missing=True)):
        with pytest.raises(SparkRuntimeException, match="rows of t share its key"):
            frame.collect()
    for frame in jobs.autocorrect(t, o, spec, spec, JobSpec(autocorrect_missing=True)):
        with pytest.raises(SparkRuntimeException, match="rows of t share keys of t"):
            frame.collect()


def test_autocorrect_without_repairs_changes_nothing(spark):
    o = spark.createDataFrame([("a", "x"), ("b", "y")], "k string, v string")
    t = spark.createDataFrame([("b", "z"), ("c", "w")], "k string, v string")
    spec = TableSpec.of(o, "t", ["k"])
    checked, after = jobs.autocorrect(o, t, spec, spec, JobSpec())
    assert rows(checked, "k", "outcome") == [("a", "MISSING"), ("b", "MISMATCH")] and rows(after) == rows(t)
    _, after = jobs.autocorrect(o, t, spec, spec, JobSpec(autocorrect_mismatch=True))
    assert rows(after) == [("b", "y"), ("c", "w")]


def test_null_map_values_are_stripped_if_asked_for(spark):
    o = spark.sql("SELECT 1 AS k, map('a', 1, 'b', null) AS m")
    spec = TableSpec.of(o, "t", ["k"])
    assert [jobs.migrate(o, spec, spec, JobSpec(strip_null_map_values=on)).writes.first().m for on in (False, True)] == [{"a": 1, "b": None}, {"a": 1}]


def test_names_with_backticks_are_merged_and_compared(spark):
    o = spark.createDataFrame([(1, "a")], "k int, v string").toDF("k`1", "v.`x")
    spec = TableSpec.of(o, "t", ["k`1"])
    job = JobSpec(autocorrect_missing=True)
    assert rows(jobs.migrate(o, spec, spec, job).merged(o.limit(0))) == [(1, "a")]
    checked, after = jobs.autocorrect(o, o.limit(0), spec, spec, job)
    assert [r.outcome for r in checked.collect()] == ["MISSING"] and rows(after) == [(1, "a")]
    assert [r.outcome for r in reconcile.keys_only(o, o, ["k`1"]).collect()] == ["VALID"]
    assert reconcile.snapshot_diff(o, o, ["k`1"]).count() == 0


def test_rows_are_batched_as_they_arrive(spark):
    got = merge.arrival_batches(spark.range(10).coalesce(1), 4).groupBy("batch_no").count().orderBy("batch_no").collect()
    assert [r["count"] for r in got] == [4, 4, 2]


def test_filters_that_cannot_decide_give_errors(spark):
    o = spark.createDataFrame([(1, "5"), (2, "x"), (3, "50")], "k int, v string")
    spec = TableSpec.of(o, "t", ["k"])
    number = F.col("v").try_cast("int")
    own = jobs.Extensions(filters=[("small", number < 10, number.isNull())])
    done = jobs.migrate(o, spec, spec, JobSpec(), extensions=own)
    assert rows(done.counters()) == [(3, 1, 1, 1)] and rows(done.every, "k", "outcome") == [(1, "WRITE"), (2, "ERROR"), (3, "SKIPPED")]


def test_guardrail_modes(spark):
    o = spark.createDataFrame([(1, "x" * 20), (2, "y")], "k int, v string")
    spec = TableSpec.of(o, "t", ["k"])
    for mode, written in (("check", 2), ("warn", 2), ("block", 1)):
        done = jobs.migrate(o, spec, spec, JobSpec(guardrail_kb=0.01, guardrail_mode=mode))
        assert done.counters().first().n_write == written and rows(done.diagnostics()) == [(1, mode == "block", "Large columns (KB): v(0.02)")]


def test_deeply_nested_values_are_converted(spark):
    o = spark.sql("SELECT 1 AS k, map('1', array(array('1', '2'), array('3'))) AS m UNION ALL SELECT 2, map('1', array(array('x'))) UNION ALL SELECT 3, map('1', null, '01', null)")
    target = TableSpec("t", T._parse_datatype_string("k int, m map<int,array<array<int>>>"), ("k",))
    done = jobs.migrate(o, TableSpec.of(o, "o", ["k"]), target, JobSpec(codecs=frozenset({"INT_STRING"})))
    assert rows(done.rows, "k", "outcome") == [(1, "WRITE"), (2, "ERROR"), (3, "ERROR")] and done.writes.first().m == {1: [[1, 2], [3]]}


def test_registered_jobs_are_run(spark):
    registry = jobs.JobRegistry()

    @registry.job("count")
    def count(spark, job, extensions, n):
        return extensions.transformed(spark.range(n)).count()

    registry.transform(lambda df: df.where("id > 1"))
    assert registry.run("count", spark, JobSpec(), n=5) == 3
    with pytest.raises(ValueError):
        registry.run("nothing", spark, JobSpec())


@pytest.fixture
def tokens(spark):
    o = spark.createDataFrame([(n, f"v{n}", n * 10) for n in range(40)], "k int, v string, token long")
    plan = spark.createDataFrame([(0, 99), (100, 199), (200, 299), (300, 499)], "token_min long, token_max long")
    return o, plan, TableSpec("t", T._parse_datatype_string("k int, v string"), ("k",)), TableSpec.of(o, "o", ["k"])


def test_runs_are_recorded_and_resumed(spark, tokens, tmp_path):
    o, plan, spec, origin = tokens
    log = tracking.RunLog(spark, str(tmp_path / "log"))
    assert log.info().count() == 0
    target = o.select("k", "v").where("k <> 12")
    check = lambda run_id, prev=0: lambda part: jobs.recorded_validate(log, run_id, part, o, "token", target, origin, spec, JobSpec(), prev)
    check(1)(plan)
    assert [(r.token_min, r.status) for r in tracking.latest_ranges(log.details()).orderBy("token_min").collect()] == [(0, "PASS"), (100, "DIFF"), (200, "PASS"), (300, "PASS")]
    assert log.details().count() == 12  # each range: not started, started, ended
    with pytest.raises(ValueError):
        check(1)(plan)
    assert jobs.resume(log, "t", 1, 2, 2, False, check(2, 1)).count() == 0
    assert [(r.token_min, r.token_max, r.status) for r in tracking.latest_ranges(log.details().where("run_id = 2")).orderBy("token_min").collect()] == [(100, 149, "DIFF"), (150, 199, "PASS")]
    run = tracking.latest_runs(log.info()).first()
    assert (run.run_id, run.prev_run_id, run.status, run.run_type) == (2, 1, "ENDED", "VALIDATE") and "Read: 10; Mismatch: 0; Corrected Mismatch: 0; Missing: 1;" in run.run_info
    held_back = jobs.resume(log, "t", 1, 3, 1, True, lambda part: None)
    assert [(r.token_min, r.state) for r in held_back.collect()] == [(100, "quarantined")]


def test_recorded_migrations_and_failed_ranges(spark, tokens, tmp_path):
    o, plan, spec, origin = tokens
    log = tracking.RunLog(spark, str(tmp_path / "log"))
    done, ended = jobs.recorded_migrate(log, 1, plan, o, "token", origin, spec, JobSpec(where="k % 2 = 0"))
    assert done.writes.count() == 20 and {r.status for r in ended.collect()} == {"PASS"}
    assert tracking.latest_runs(log.info()).first().run_info == "Read: 40; Write: 20; Skipped: 20; Error: 0; Partitions Passed: 4; Partitions Failed: 0"
    failed = spark.createDataFrame([(100,)], "token_min long")
    half = done.counters(["token_min"]).withColumn("n_write", F.when(F.col("token_min") == 100, 2).otherwise(F.col("n_write")))
    got = {r.token_min: (r.status, r.run_info) for r in jobs.recorded(log, "t", 2, "migrate", plan, half, 1, failed).collect()}
    assert got[100] == ("FAIL", "Read: 10; Write: 2; Skipped: 5; Error: 3; Partitions Passed: 0; Partitions Failed: 1") and got[0][0] == "PASS"
    assert [r.run_id for r in tracking.to_adopt(log.info()).collect()] == [2]
    large = jobs.recorded_guardrail(log, 3, plan, o.withColumn("v", F.when(F.col("k") == 5, F.repeat(F.lit("x"), 100)).otherwise(F.col("v"))), "token", origin, 0.05)
    assert {r.token_min: r.status for r in large.collect()} == {0: "DIFF", 100: "PASS", 200: "PASS", 300: "PASS"}


def test_ends_of_ranges_count_over_starts(spark):
    details = spark.createDataFrame([("t", 1, None, 5, 9, s, "") for s in ("STARTED", "PASS", "NOT_STARTED")], tracking.RUN_DETAILS)
    assert tracking.latest_ranges(details).first().status == "PASS"
    assert tracking.pending(details, "t", 1).count() == 0
