"""Monitoring a run from its event log with Structured Streaming.

Two kinds of state are kept. ``once`` remembers what was counted: the identity of every event, so a range that completes again, be it
hours later, counts once, and so does a discrepancy that a retried task reports again. Of the events of one batch that have one
identity the earliest counts, whatever the order in which files and shuffles bring them. It has no watermark, so no event is too late for
it; its state grows with the plan's ranges and the discrepancies, and lies in the state store (RocksDB on disk if that is set).
``progress`` keeps a run's tallies, in shards, so that a run's events needn't meet in one task.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tidemark.sources.reports import EVENTS, IDENTITY

#: State stores that can hold the tallies' maps.
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: A run's events are dealt to so many tasks at most.
SHARDS = 32
#: A batch's events are dealt to so many groups by identity, each of which is in memory at once.
GROUPS = 4096
#: Seconds that a rate looks back.
TRAIL = 10


def read_events(spark: SparkSession, path: str, files_per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(EVENTS)
    return (reader.option("maxFilesPerTrigger", files_per_trigger) if files_per_trigger else reader).json(path)


def earliest(events: pa.Table) -> pa.Table:
    """Of the events of each identity the earliest; of a tie the least by the other columns."""
    events = events.drop_columns(["_group"])
    other = [c for c in events.column_names if c not in ("at", *IDENTITY)]
    ordered = events.take(pc.sort_indices(events, [(c, "ascending") for c in ("at", *other)]))
    ordered = ordered.append_column("_n", pa.array(range(len(ordered)), pa.int64()))
    first = ordered.group_by(IDENTITY).aggregate([("_n", "min")])["_n_min"]
    return ordered.drop_columns(["_n"]).take(first)


def once(events: DataFrame) -> DataFrame:
    """Each event once, however often and however late it comes again. A range's first end counts; one that was given up (not ended)
    is no end, and the range may still complete."""
    given_up = (F.col("type") == "RangeCompleted") & F.col("status").isin("STARTED", "NOT_STARTED")
    ends = events.where(~F.coalesce(given_up, F.lit(False)))
    group = F.pmod(F.xxhash64(*IDENTITY), F.lit(GROUPS)).alias("_group")
    return ends.select("*", group).groupBy("_group").applyInArrow(earliest, events.schema).dropDuplicates(IDENTITY)


def per_second(events: DataFrame, late: str = "10 seconds") -> DataFrame:
    """Events and rows by second, table, run and type. ``late``: how long a second stays open for events that haven't come yet."""
    rows = F.coalesce(F.sum("rows"), F.lit(0)).alias("n_rows")
    counted = once(events).withWatermark("at", late).groupBy(F.window("at", "1 second"), "table_name", "run_id", "type").agg(F.count("*").alias("n_events"), rows)
    return counted.select(F.col("window.start").alias("second"), "table_name", "run_id", "type", "n_events", "n_rows")


def statuses(events: DataFrame, late: str = "10 seconds", every: str = "1 minute") -> DataFrame:
    """Completed ranges by status and discrepancies by kind, and their rows, by window."""
    rows = F.coalesce(F.sum("rows"), F.lit(0)).alias("n_rows")
    counted = once(events).withWatermark("at", late).groupBy(F.window("at", every), "table_name", "run_id", "type", "status", "kind").agg(F.count("*").alias("n_events"), rows)
    return counted.select(F.col("window.start").alias("at"), "table_name", "run_id", "type", "status", "kind", "n_events", "n_rows")


#: What ``progress`` gives: running numbers of a shard of a run after each batch that touched it.
PROGRESS = "table_name string, run_id long, shard int, batch long, at timestamp, tallies map<string,long>, n_rows long, rows_per_second double, recent map<long,long>"


class Tallies(StatefulProcessor):
    """Counts a shard's events by what they say, and keeps the rows of its last seconds."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.counts = handle.getMapState("counts", "what string", "n long")
        self.seconds = handle.getMapState("seconds", "second long", "n long")
        self.batches = handle.getValueState("batches", "n long")

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues: object) -> Iterator[pd.DataFrame]:
        new, seconds, last = defaultdict(int), defaultdict(int), 0
        for part in rows:
            for what, n in part["what"].value_counts().items():
                new[what] += int(n)
            read = part[part["what"].str.startswith("RangeCompleted")]
            new["rows"] += int(read["rows"].sum())
            for second, n in read.groupby("second")["rows"].sum().items():
                seconds[int(second)] += int(n)
            last = max(last, int(part["second"].max()))
        counts = {k[0]: int(v[0]) for k, v in self.counts.iterator()}
        for what, n in new.items():
            counts[what] = counts.get(what, 0) + n
            self.counts.updateValue((what,), (counts[what],))
        kept = {int(k[0]): int(v[0]) for k, v in self.seconds.iterator()}
        last = max([last, *kept])
        for second, n in seconds.items():
            kept[second] = kept.get(second, 0) + n
        for second, n in kept.items():
            if second > last - TRAIL:
                self.seconds.updateValue((second,), (n,))
            elif self.seconds.containsKey((second,)):
                self.seconds.removeKey((second,))
        recent = {second: n for second, n in kept.items() if second > last - TRAIL}
        batch = int(self.batches.get()[0]) + 1 if self.batches.exists() else 1
        self.batches.update((batch,))
        n_rows = counts.pop("rows", 0)
        yield pd.DataFrame({"table_name": [key[0]], "run_id": [key[1]], "shard": [key[2]], "batch": [batch], "at": [pd.Timestamp(last, unit="s")], "tallies": [counts], "n_rows": [n_rows], "rows_per_second": [sum(recent.values()) / TRAIL], "recent": [recent]})

    def close(self) -> None:
        pass


def progress(events: DataFrame, shards: int = SHARDS) -> DataFrame:
    """Running numbers of the runs: events by type and by status or kind, rows read, and rows a second over the last TRAIL seconds of
    event time; a row for each shard that a batch of events touched. The session's state store becomes the one on disk."""
    spark = events.sparkSession
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    what = F.concat_ws(":", "type", F.coalesce("status", "kind", F.lit("")))
    shard = F.pmod(F.xxhash64("type", "kind", "token_min", "key"), F.lit(shards)).cast("int")
    rows = once(events).select("table_name", "run_id", shard.alias("shard"), what.alias("what"), F.unix_seconds("at").alias("second"), F.coalesce("rows", F.lit(0).cast("long")).alias("rows"))
    return rows.groupBy("table_name", "run_id", "shard").transformWithStateInPandas(Tallies(), PROGRESS, "Append", "None")


def latest_progress(rows: DataFrame) -> DataFrame:
    """The last numbers of each run: those of its shards, added up. The rate is of the rows of all shards in the run's last TRAIL
    seconds, added up as whole numbers, so that it doesn't depend on the shards."""
    last = rows.groupBy("table_name", "run_id", "shard").agg(F.max_by(F.struct("at", "tallies", "n_rows", "recent"), "batch").alias("s"))
    ends = last.groupBy("table_name", "run_id").agg(F.max("s.at").alias("at"), F.sum("s.n_rows").cast("long").alias("n_rows"))
    seconds = last.join(ends.select(F.col("table_name").alias("_t"), F.col("run_id").alias("_r"), F.col("at").alias("_at")), F.col("table_name").eqNullSafe(F.col("_t")) & F.col("run_id").eqNullSafe(F.col("_r"))).select("table_name", "run_id", "_at", F.explode_outer("s.recent").alias("second", "n"))
    recent = F.coalesce(F.sum(F.when(F.col("second") > F.unix_seconds("_at") - TRAIL, F.col("n"))), F.lit(0))
    rate = seconds.groupBy("table_name", "run_id").agg((recent / TRAIL).alias("rows_per_second"))
    counts = last.select("table_name", "run_id", F.explode("s.tallies").alias("what", "n")).groupBy("table_name", "run_id", "what").agg(F.sum("n").cast("long").alias("n"))
    tallies = counts.groupBy("table_name", "run_id").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("what", "n")))).alias("tallies"))
    return ends.join(tallies, ["table_name", "run_id"], "left").join(rate, ["table_name", "run_id"], "left")


def run_to_files(df: DataFrame, path: str, mode: str = "append") -> DataFrame:
    """Processes what is there into Parquet files under ``path``, with its checkpoint beside them, and reads them."""
    query = df.writeStream.format("parquet").option("path", f"{path}/rows").outputMode(mode).option("checkpointLocation", f"{path}/checkpoint").trigger(availableNow=True).start()
    query.awaitTermination()
    return df.sparkSession.read.schema(df.schema).parquet(f"{path}/rows")
