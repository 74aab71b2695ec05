"""Run tracking as two append-only tables, resume and rerun.

``run_info``: table_name, run_id, run_type, prev_run_id, start_time, end_time, run_info, status.
``run_details``: table_name, run_id, start_time, token_min, token_max, status, run_info.
A run is named by its table and id: runs of other tables may have the same id. A change of status is a further row; the latest row of a key counts: the one with the latest start_time, and of those with one
start_time, as the rows of one attempt have, the one with the status that comes last in a run's life.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.operators.metrics import column, metrics_string, parsed, stored_counters, title
from tidemark.session import remove, scratch_path

#: The statuses and the columns of the tracking tables.
STATUSES = ("NOT_STARTED", "STARTED", "PASS", "FAIL", "DIFF", "DIFF_CORRECTED", "ENDED", "INTERRUPTED", "ABORTED")
RUN_INFO = "table_name string, run_id long, run_type string, prev_run_id long, start_time timestamp, end_time timestamp, run_info string, status string"
RUN_DETAILS = "table_name string, run_id long, start_time timestamp, token_min long, token_max long, status string, run_info string"
PENDING = ("NOT_STARTED", "STARTED", "FAIL", "DIFF")
DONE = ("PASS", "DIFF_CORRECTED")
PENDING_SAMPLE = 20


def latest(log: DataFrame, key: list[str], order: list[Column]) -> DataFrame:
    """The last row of each key."""
    w = Window.partitionBy(*key).orderBy(*(c.desc() for c in order))
    return log.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def life(status: Column) -> Column:
    """The place of a status in the life of a range or run."""
    return F.coalesce(*(F.when(status == s, F.lit(n)) for n, s in enumerate(STATUSES)), F.lit(-1))


def latest_ranges(details: DataFrame) -> DataFrame:
    return latest(details, ["table_name", "run_id", "token_min"], [F.col("start_time"), life(F.col("status"))])


def latest_runs(info: DataFrame) -> DataFrame:
    """The newest run of each table and kind."""
    return latest(info, ["table_name", "run_type"], [F.col("run_id"), F.col("start_time"), life(F.col("status"))])


def of_run(log: DataFrame, table: str, run_id: int) -> DataFrame:
    """The rows of one run in either tracking table."""
    return log.where((F.col("table_name") == table) & (F.col("run_id") == run_id))


def by_status(details: DataFrame) -> DataFrame:
    return latest_ranges(details).groupBy("table_name", "run_id", "status").agg(F.count("*").alias("n_ranges"))


def pending(details: DataFrame, table: str, run_id: int, writes_counters: bool = False) -> DataFrame:
    """Ranges of the run that are to be done again (state pending), or that can't be because counters would be added twice
    (state quarantined)."""
    rows = latest_ranges(of_run(details, table, run_id)).where(F.col("status").isin(*PENDING))
    state = F.when(F.col("status") == "NOT_STARTED", "pending").otherwise("quarantined") if writes_counters else F.lit("pending")
    return rows.select("token_min", "token_max", "status", state.alias("state"))


def check_resumable(info: DataFrame, details: DataFrame, table: str, run_id: int) -> None:
    run = latest(of_run(info, table, run_id), ["table_name", "run_id"], [F.col("start_time"), life(F.col("status"))]).first()
    if run is None:
        raise ValueError(f"there is no run {run_id} of {table}")
    if run["status"] == "NOT_STARTED":
        raise ValueError(f"run {run_id} of {table} hasn't started")
    if of_run(details, table, run_id).isEmpty():
        raise ValueError(f"run {run_id} of {table} has no ranges")


def outstanding(planned: DataFrame, details: DataFrame, table: str, run_id: int) -> DataFrame:
    """Planned ranges (token_min, token_max) that the run hasn't finished."""
    done = latest_ranges(of_run(details, table, run_id)).where(F.col("status").isin(*DONE))
    return planned.join(done.select("token_min"), "token_min", "left_anti")


def to_adopt(info: DataFrame) -> DataFrame:
    """The latest runs that a rerun takes up: those that haven't ended, or ended with failed ranges (an unreadable number counts)."""
    failed = F.regexp_extract("run_info", r"Partitions Failed:\s*([^;]*)", 1)
    some = (failed != "") & (F.coalesce(F.trim(failed).try_cast("bigint"), F.lit(1)) > 0)
    return latest_runs(info).where((F.col("status") != "ENDED") | F.coalesce(some, F.lit(False)))


def pending_sample(details: DataFrame, table: str, run_id: int) -> DataFrame:
    """The first pending ranges, with the number of all of them."""
    rows = pending(details, table, run_id)
    total = rows.agg(F.lit(1).alias("_one"), F.count("*").alias("n_pending"))
    return rows.orderBy("token_min").limit(PENDING_SAMPLE).withColumn("_one", F.lit(1)).join(total, "_one").drop("_one")


def chain(info: DataFrame) -> DataFrame:
    """Each run with the first run of its chain of resumes, within its table, and its depth. Runs that lead to no first run are left
    out.

    By pointer doubling: in each round a run's link is joined to its ancestor's, so that links double in length. Every round is a
    table in the shared folder, and the round before it is removed. The join is by sorted shuffles whatever its size: a broadcast would
    pass all links through the driver in every round."""
    spark = info.sparkSession
    made: list[str] = []

    def stored(df: DataFrame) -> DataFrame:
        made.append(scratch_path(spark, "chain"))
        df.write.parquet(made[-1])
        for path in made[:-1]:
            remove(spark, path)
        del made[:-1]
        return spark.read.schema(df.schema).parquet(made[-1])

    first = F.col("prev_run_id") == 0
    runs = info.select("table_name", "run_id", "prev_run_id").where("table_name is not null and run_id is not null and prev_run_id is not null").distinct()
    links = stored(runs.select("table_name", "run_id", F.when(first, F.col("run_id")).otherwise(F.col("prev_run_id")).alias("up"), F.when(first, 0).otherwise(1).alias("depth"), first.alias("done")))
    # a link longer than there are runs goes round in a circle
    for _ in range(links.count().bit_length()):
        if links.where("not done").isEmpty():
            break
        upper = links.select(F.col("table_name").alias("_table"), F.col("run_id").alias("_run"), F.col("up").alias("_up"), F.col("depth").alias("_depth"), F.col("done").alias("_done")).hint("merge")
        longer = links.where("not done").join(upper, (F.col("table_name") == F.col("_table")) & (F.col("up") == F.col("_run")))
        links = stored(links.where("done").unionByName(longer.select("table_name", "run_id", F.col("_up").alias("up"), (F.col("depth") + F.col("_depth")).alias("depth"), F.col("_done").alias("done"))))
    return links.where("done").select("table_name", "run_id", F.col("up").alias("first_run_id"), "depth")


def totals(details: DataFrame) -> DataFrame:
    """Counters of the runs, added up from the metric strings of their ranges."""
    rows = latest_ranges(details).select("table_name", "run_id", F.explode(parsed(F.col("run_info"))).alias("counter", "n"))
    return rows.groupBy("table_name", "run_id", "counter").agg(F.sum("n").cast("long").alias("n"))


def progress(details: DataFrame, weights: DataFrame, elapsed: DataFrame | None = None) -> DataFrame:
    """Per run: ranges and weight in all, done and pending, the fraction done, and the seconds left (from 2 % and 16 ranges on).

    ``weights``: table_name, token_min, weight; a range without one gets the mean weight by token, at least 1. ``elapsed``:
    table_name, run_id, elapsed_s."""
    run = ["table_name", "run_id"]
    span = F.col("token_max").cast("decimal(38,0)") - F.col("token_min").cast("decimal(38,0)") + 1
    rows = latest_ranges(details).join(weights, ["table_name", "token_min"], "left").withColumn("_span", span.cast("double"))
    density = rows.groupBy(*run).agg((F.sum("weight") / F.sum(F.when(F.col("weight").isNotNull(), F.col("_span")))).alias("_density"))
    rows = rows.join(density, run)
    rows = rows.withColumn("_weight", F.coalesce(F.col("weight").cast("double"), F.greatest(F.floor(F.col("_span") * F.col("_density")).cast("double"), F.lit(1.0)), F.lit(1.0)))
    ended = ~F.col("status").isin("NOT_STARTED", "STARTED")
    out = rows.groupBy(*run).agg(
        F.count("*").alias("n_ranges"),
        F.count_if(ended).alias("n_done"),
        F.count_if(F.col("status") == "NOT_STARTED").alias("n_pending"),
        F.count_if(F.col("status") == "STARTED").alias("n_in_flight"),
        F.sum("_weight").cast("long").alias("weight"),
        F.coalesce(F.sum(F.when(ended, F.col("_weight"))), F.lit(0.0)).cast("long").alias("weight_done"),
    )
    if elapsed is None:
        return out
    fraction = F.col("weight_done") / F.col("weight")
    left = F.when((fraction >= 0.02) & (F.col("n_done") >= 16), F.floor(F.col("elapsed_s") * (1 - fraction) / fraction)).cast("long")
    return out.join(elapsed, run).withColumn("seconds_left", left).drop("elapsed_s")


def cancelled(info: DataFrame, table: str, run_id: int, at: Column) -> DataFrame:
    """The row that cancels a run, for appending; its metric string stays."""
    last = latest(of_run(info, table, run_id), ["table_name", "run_id"], [F.col("start_time"), life(F.col("status"))])
    return last.withColumn("status", F.lit("ABORTED")).withColumn("end_time", at)


def listed(info: DataFrame, run_type: str | None = None) -> DataFrame:
    rows = info if run_type is None else info.where(F.col("run_type") == run_type)
    return latest(rows, ["table_name", "run_id"], [F.col("start_time"), life(F.col("status")), F.col("end_time")]).orderBy(F.desc("run_id"))


class RunLog:
    """The two tracking tables under one folder, to which rows are only ever appended; both are made by the first run."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, root.rstrip("/")

    def _read(self, name: str, schema: str) -> DataFrame:
        empty = self.spark.createDataFrame([], schema)
        try:
            return self.spark.read.schema(schema).parquet(f"{self.root}/{name}")
        except AnalysisException:
            return empty

    def info(self) -> DataFrame:
        return self._read("run_info", RUN_INFO)

    def details(self) -> DataFrame:
        return self._read("run_details", RUN_DETAILS)

    def _append(self, rows: DataFrame, name: str, schema: str) -> None:
        kinds = [part.strip().split(" ") for part in schema.split(",")]
        rows.select(*(F.col(c).cast(kind).alias(c) for c, kind in kinds)).write.mode("append").parquet(f"{self.root}/{name}")

    def begin(self, table: str, run_id: int, kind: str, plan: DataFrame, prev_run_id: int = 0) -> None:
        """The run as started, its ranges (token_min, token_max) first as not started, then as started. A run id is used once."""
        if not of_run(self.info(), table, run_id).isEmpty():
            raise ValueError(f"there is a run {run_id} of {table} already")
        one = self.spark.range(1)
        self._append(one.select(F.lit(table).alias("table_name"), F.lit(run_id).alias("run_id"), F.lit(kind.upper()).alias("run_type"), F.lit(prev_run_id).alias("prev_run_id"), F.current_timestamp().alias("start_time"), F.lit(None).alias("end_time"), F.lit(None).alias("run_info"), F.lit("STARTED").alias("status")), "run_info", RUN_INFO)
        ranges = plan.select(F.lit(table).alias("table_name"), F.lit(run_id).alias("run_id"), "token_min", "token_max", F.lit(None).alias("run_info"))
        self._append(ranges.withColumn("start_time", F.lit(None)).withColumn("status", F.lit("NOT_STARTED")), "run_details", RUN_DETAILS)
        self._append(ranges.withColumn("start_time", F.current_timestamp()).withColumn("status", F.lit("STARTED")), "run_details", RUN_DETAILS)

    def end(self, table: str, run_id: int, kind: str, ranges: DataFrame, status: str = "ENDED") -> DataFrame:
        """The ranges' ends (token_min, token_max, status, n_...) and the run's, with the totals that the stored ranges give."""
        began = latest_ranges(of_run(self.details(), table, run_id)).select(F.col("token_min").alias("_at"), "start_time")
        ends = ranges.join(began, F.col("token_min") == F.col("_at")).select(F.lit(table).alias("table_name"), F.lit(run_id).alias("run_id"), "start_time", "token_min", "token_max", "status", metrics_string(kind).alias("run_info"))
        self._append(ends, "run_details", RUN_DETAILS)
        done = latest_ranges(of_run(self.details(), table, run_id))
        self._append(self._last(table, run_id).withColumn("_one", F.lit(1)).join(run_totals(done, kind).withColumn("_one", F.lit(1)), "_one").withColumn("end_time", F.current_timestamp()).withColumn("status", F.lit(status)), "run_info", RUN_INFO)
        return done

    def _last(self, table: str, run_id: int) -> DataFrame:
        mine = of_run(self.info(), table, run_id)
        return latest(mine, ["table_name", "run_id"], [F.col("start_time"), life(F.col("status"))]).drop("run_info", "end_time", "status")


def run_totals(ranges: DataFrame, kind: str) -> DataFrame:
    """One row: the metric string of a run, from those of its ranges."""
    names = stored_counters(kind)
    titles = [title(c) for c in names]
    rows = ranges.select(parsed(F.col("run_info")).alias("_n"))
    sums = rows.agg(*(F.coalesce(F.sum(F.try_element_at("_n", F.lit(t))), F.lit(0)).cast("long").alias(column(c)) for t, c in zip(titles, names, strict=True)))
    return sums.select(metrics_string(kind).alias("run_info"))
