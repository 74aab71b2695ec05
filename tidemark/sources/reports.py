"""Reports of a validate job: discrepancies as records, as rows of a CSV, as log lines, and as events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.mapping import quoted
from tidemark.operators.metrics import parsed, title
from tidemark.operators.reconcile import ERROR, MISMATCH, MISSING, detail
from tidemark.spec import JobSpec


#: The beginnings of log lines, which tools that read the log look for.
MISSING_LINE = "Missing target row found for key: "
MISMATCH_LINE = "Mismatch row found for key: "
INSERTED_LINE = "Inserted missing row in target: "
CORRECTED_LINE = "Corrected mismatch row in target: "
SKIPPED_COUNTER_LINE = "autocorrect.missing is true, but not Inserting as autocorrect.missing_counter is not enabled; key : "


def key_text(key: list[str]) -> Column:
    return F.concat_ws(" %% ", *(F.coalesce(quoted(k).cast("string"), F.lit("null")) for k in key))


def hashed(value: Column) -> Column:
    return F.when(value.isNull(), "null").otherwise(F.concat(F.lit("xxh64:"), F.lower(F.hex(F.xxhash64(value)))))


def discrepancies(validated: DataFrame, key: list[str], run_id: int, redact: bool = True, low: str | None = None, high: str | None = None) -> DataFrame:
    """One record per missing or differing row: run_id, range, key, kind, values_redacted, columns."""
    form = hashed if redact else (lambda v: F.coalesce(v, F.lit("null")))
    columns = F.transform("differences", lambda d: F.struct(d["column"].alias("column"), form(d["origin"]).alias("origin"), form(d["target"]).alias("target"), d["error"].alias("error")))
    bounds = F.struct((quoted(low) if low else F.lit(None).cast("string")).alias("min"), (quoted(high) if high else F.lit(None).cast("string")).alias("max"))
    return validated.where(F.col("outcome").isin(MISSING, MISMATCH)).select(F.lit(run_id).cast("long").alias("run_id"), bounds.alias("range"), key_text(key).alias("key"), F.lower("outcome").alias("kind"), F.lit(redact).alias("values_redacted"), columns.alias("columns"))


def csv_rows(records: DataFrame) -> DataFrame:
    """One row per differing column, and one for a missing row."""
    return records.select("run_id", "range.min", "range.max", "key", "kind", F.explode_outer("columns").alias("c")).select("run_id", "min", "max", "key", "kind", "c.column", "c.origin", "c.target", "c.error")


def log_lines(validated: DataFrame, key: list[str], corrected_missing: bool = False, corrected_mismatch: bool = False, skipped_counters: bool = False) -> DataFrame:
    """The key and the lines that a row gives: what was found, then what was done about it. ``skipped_counters``: missing rows of a
    counter table, which autocorrect leaves out unless it is told not to."""
    text = key_text(key)
    found = F.when(F.col("outcome") == MISSING, F.concat(F.lit(MISSING_LINE), text)).when(F.col("outcome") == MISMATCH, F.concat(F.lit(MISMATCH_LINE), text, F.lit(" Mismatch: "), detail(F.col("differences"))))
    done = F.when((F.col("outcome") == MISSING) & F.lit(skipped_counters), F.concat(F.lit(SKIPPED_COUNTER_LINE), text)).when((F.col("outcome") == MISSING) & F.lit(corrected_missing), F.concat(F.lit(INSERTED_LINE), text)).when((F.col("outcome") == MISMATCH) & F.lit(corrected_mismatch), F.concat(F.lit(CORRECTED_LINE), text))
    return validated.where(F.col("outcome").isin(MISSING, MISMATCH)).select(*map(quoted, key), F.posexplode(F.array_compact(F.array(found, done))).alias("n", "line"))


def json_array(records: DataFrame) -> DataFrame:
    """The records as the lines of one JSON array, in the order of their keys; part files one after another hold the array.

    A comma stands before each record but the first, which is taken off once (``exceptAll``), so that records that share a key, or
    are equal, keep their commas."""
    lines = records.select("key", F.to_json(F.struct(*records.columns)).alias("value"))
    first = lines.orderBy("key", "value").limit(1)
    rest = lines.exceptAll(first).select(F.lit(2).alias("_part"), "key", F.concat(F.lit(","), "value").alias("value"))
    edges = records.sparkSession.range(2).select((F.col("id") * 3).cast("int").alias("_part"), F.lit(None).cast("string").alias("key"), F.when(F.col("id") == 0, "[").otherwise("]").alias("value"))
    return edges.unionByName(first.select(F.lit(1).alias("_part"), "key", "value")).unionByName(rest).orderBy("_part", "key", "value").select("value")


def write(records: DataFrame, path: str, form: str = "json") -> None:
    if form == "json_array":
        json_array(records).write.text(path)
    elif form == "csv":
        csv_rows(records).write.option("header", True).csv(path)
    elif form in ("json", "ndjson"):
        records.write.json(path)
    else:
        records.write.format(form).save(path)


#: Run events: the schema in which they are written and read.
EVENTS = "at timestamp, table_name string, run_id long, node_id string, type string, token_min long, token_max long, status string, kind string, key string, message string, rows long"
#: What names an event among those of its run: a repeat has the same. A range ends once, whatever the status; other events are told
#: apart by the key of their row.
IDENTITY = ["table_name", "run_id", "type", "kind", "token_min", "key"]


def range_events(details: DataFrame, node: str = "spark") -> DataFrame:
    """RangeStarted and RangeCompleted events of a run's ranges; a completed one has the rows that were read."""
    kind = F.when(F.col("status") == "STARTED", "RangeStarted").otherwise("RangeCompleted")
    read = F.when(kind == "RangeCompleted", F.try_element_at(parsed(F.col("run_info")), F.lit(title("READ"))))
    return events(details.where("status <> 'NOT_STARTED'"), node, at=F.col("start_time"), table_name=F.col("table_name"), run_id=F.col("run_id"), type=kind, token_min=F.col("token_min"), token_max=F.col("token_max"), status=F.col("status"), rows=read)


def events(frame: DataFrame, node: str = "spark", /, **known: Column) -> DataFrame:
    """Events of the rows: the columns given, and null for the others of EVENTS."""
    kinds = [part.strip().split(" ") for part in EVENTS.split(",")]
    known = {"node_id": F.lit(node)} | known
    return frame.select(*(known.get(c, F.lit(None)).cast(kind).alias(c) for c, kind in kinds))


def run_events(info: DataFrame, node: str = "spark") -> DataFrame:
    """RunStarted and RunCompleted events of the tracked runs."""
    started = F.col("status") == "STARTED"
    at = F.when(started, F.col("start_time")).otherwise(F.coalesce("end_time", "start_time"))
    return events(info.where("status <> 'NOT_STARTED'"), node, at=at, table_name=F.col("table_name"), run_id=F.col("run_id"), type=F.when(started, "RunStarted").otherwise("RunCompleted"), status=F.col("status"), message=F.col("run_info"))


def discrepancy_events(validated: DataFrame, key: list[str], run_id: int, at: Column, node: str = "spark", table: str | None = None) -> DataFrame:
    """A Discrepancy event for each missing or differing row, and an Error event for each row that couldn't be compared."""
    rows = validated.where(F.col("outcome").isin(MISSING, MISMATCH, ERROR))
    wrong = F.col("outcome") == ERROR
    return events(rows, node, at=at, table_name=F.lit(table), run_id=F.lit(run_id), type=F.when(wrong, "Error").otherwise("Discrepancy"), kind=F.when(~wrong, F.lower("outcome")), key=key_text(key), message=F.concat(key_text(key), F.lit(" "), detail(F.col("differences"))), rows=F.lit(1))


def warning_events(diagnostics: DataFrame, key: list[str], run_id: int, at: Column, node: str = "spark", table: str | None = None) -> DataFrame:
    """A Warning event for each row in which the guardrail found something."""
    return events(diagnostics, node, at=at, table_name=F.lit(table), run_id=F.lit(run_id), type=F.lit("Warning"), key=key_text(key), message=F.concat(key_text(key), F.lit(" "), F.col("report")), rows=F.lit(1))


def summary(totals: DataFrame, plan: DataFrame, job: JobSpec, log: DataFrame | None = None) -> DataFrame:
    """One row: counters, plan, discrepancies (found, corrected, outstanding), and a hash of all the job's options; with the run's
    events (``log``) also its timing (started, ended, seconds) and its nodes, with the ranges and rows that each completed."""
    left = (F.col("n_missing") - F.col("n_corrected_missing")) + (F.col("n_mismatch") - F.col("n_corrected_mismatch"))
    found = F.struct(*(F.col(f"n_{c}").alias(c) for c in ("missing", "mismatch", "corrected_missing", "corrected_mismatch")), left.alias("outstanding"))
    counters = F.struct(*(c for c in totals.columns if c.startswith("n_")))
    one = totals.select(F.lit(1).alias("_one"), F.lit(job.config_hash()).alias("config_hash"), counters.alias("counters"), found.alias("discrepancies"), left.alias("outstanding"))
    out = one.join(plan.select(F.lit(1).alias("_one"), F.struct(*plan.columns).alias("plan")), "_one")
    if log is not None:
        by_node = log.groupBy("node_id").agg(F.min("at").alias("started"), F.max("at").alias("ended"), F.count_if(F.col("type") == "RangeCompleted").alias("n_ranges"), F.coalesce(F.sum(F.when(F.col("type") == "RangeCompleted", F.col("rows"))), F.lit(0)).cast("long").alias("n_rows"))
        span = F.struct(F.min("started").alias("started"), F.max("ended").alias("ended"), (F.unix_seconds(F.max("ended")) - F.unix_seconds(F.min("started"))).alias("seconds"))
        timed = by_node.agg(F.lit(1).alias("_one"), span.alias("timing"), F.array_sort(F.collect_list(F.struct("node_id", "n_ranges", "n_rows"))).alias("nodes"))
        out = out.join(timed, "_one")
    return out.drop("_one")
