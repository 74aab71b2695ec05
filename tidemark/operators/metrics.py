"""Counters by range and run, verdicts, metric strings, histograms and rates."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: The counters of each job and their titles, in the order in which stored metric strings hold them.
REGISTERED = {
    "migrate": ["READ", "WRITE", "SKIPPED", "ERROR", "UNFLUSHED", "PASSED", "FAILED"],
    "validate": ["READ", "MISMATCH", "CORRECTED_MISMATCH", "MISSING", "CORRECTED_MISSING", "VALID", "SKIPPED", "ERROR", "PASSED", "FAILED"],
    "guardrail": ["READ", "VALID", "SKIPPED", "LARGE", "PASSED", "FAILED"],
}
TITLES = {"PASSED": "Partitions Passed", "FAILED": "Partitions Failed"}
#: A counter of what isn't written yet, which stored strings and final lines leave out.
INTERIM = "UNFLUSHED"


def register(kind: str, counters: list[str]) -> None:
    """Names the counters of a user's kind of job; READ, ERROR and those of the ranges are added. A kind is registered once."""
    own = [c for c in counters if c not in ("READ", "ERROR", *TITLES)]
    if REGISTERED.get(kind, names := ["READ", *own, "ERROR", *TITLES]) != names:
        raise ValueError(f"the counters of {kind} are {', '.join(REGISTERED[kind])}")
    REGISTERED[kind] = names


def stored_counters(kind: str) -> list[str]:
    return [c for c in REGISTERED[kind] if c != INTERIM]


def title(counter: str) -> str:
    return TITLES.get(counter, counter.replace("_", " ").title())


def column(counter: str) -> str:
    return "n_" + counter.lower()


def counters(rows: DataFrame, by: list[str], outcomes: list[str], outcome: str = "outcome") -> DataFrame:
    """n_read and a column for each outcome, by group."""
    counted = [F.count_if(F.col(outcome) == o).alias(column(o)) for o in outcomes]
    return rows.groupBy(*by).agg(F.count("*").alias("n_read"), *counted)


def totals(by_range: DataFrame) -> DataFrame:
    names = [c for c in by_range.columns if c.startswith("n_")]
    return by_range.agg(*(F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(c) for c in names))


def lost(job: str) -> Column:
    """What a failed range left uncounted, which goes to its errors."""
    done = ("valid", "missing", "mismatch", "skipped") if job == "validate" else [c.lower() for c in stored_counters(job) if c not in ("READ", *TITLES)]
    rest = F.col("n_read")
    for c in done:
        rest = rest - F.col(f"n_{c}")
    return F.greatest(rest, F.lit(0))


def verdict(missing: Column, mismatch: Column, corrected_missing: Column, corrected_mismatch: Column, failed: Column | None = None) -> Column:
    failed = F.lit(False) if failed is None else failed
    return (
        F.when(failed, "FAIL")
        .when((missing == 0) & (mismatch == 0), "PASS")
        .when((missing == corrected_missing) & (mismatch == corrected_mismatch), "DIFF_CORRECTED")
        .otherwise("DIFF")
    )


def range_status(job: str, failed: Column) -> Column:
    """How a range ends."""
    if job == "validate":
        none = F.lit(0)
        return verdict(F.col("n_missing"), F.col("n_mismatch"), F.coalesce("n_corrected_missing", none), F.coalesce("n_corrected_mismatch", none), failed)
    found = F.col("n_large") > 0 if job == "guardrail" else F.lit(False)
    return F.when(failed, "FAIL").when(found, "DIFF").otherwise("PASS")


def run_status(interrupted: Column, failed: Column, outstanding_or_large: Column) -> Column:
    """How a run ends, from its totals: what a user looks at first."""
    return F.when(interrupted, "INTERRUPTED").when(failed > 0, "FAIL").when(outstanding_or_large > 0, "DIFF").otherwise("PASS")


def exit_code(status: Column, failed: Column, outstanding: Column, large: Column) -> Column:
    return F.when(status == "INTERRUPTED", 4).when((failed > 0) | (outstanding > 0) | (large > 0), 1).otherwise(0)


def outstanding() -> Column:
    return (F.col("n_missing") - F.col("n_corrected_missing")) + (F.col("n_mismatch") - F.col("n_corrected_mismatch"))


def metrics_string(job: str) -> Column:
    """``Read: 10; Write: 9; ...`` over the counters' columns."""
    return F.concat_ws("; ", *(F.concat(F.lit(f"{title(c)}: "), F.col(column(c)).cast("string")) for c in stored_counters(job)))


def final_lines(job: str, run_id: Column | None = None) -> Column:
    rule = F.lit("#" * 81)
    lines = [rule] + ([F.concat(F.lit("RunId: "), run_id.cast("string"))] if run_id is not None else [])
    for c in stored_counters(job):
        name = f"Final {title(c)}" + ("" if c in TITLES else " Record Count")
        lines.append(F.concat(F.lit(f"{name}: "), F.col(column(c)).cast("string")))
    return F.array(*lines, rule)


def parsed(text: Column) -> Column:
    """A metric string as map of counter title to number; what isn't a number or a counter is left out."""
    known = sorted({title(c) for names in REGISTERED.values() for c in names})
    entries = F.transform(F.split(text, ";"), lambda e: F.struct(F.trim(F.regexp_extract(e, r"^(.*):[^:]*$", 1)).alias("key"), F.trim(F.regexp_extract(e, r"^.*:([^:]*)$", 1)).try_cast("bigint").alias("value")))
    good = F.filter(entries, lambda e: e["value"].isNotNull() & (e["value"] >= 0) & e["key"].isin(*known))
    return F.map_from_entries(good)


def compare_blocks(a: DataFrame, b: DataFrame) -> DataFrame:
    """Counters (run's columns counter, n) of two runs: counter, kind (missing, extra, different), a, b."""
    both = a.select("counter", F.col("n").alias("a")).join(b.select("counter", F.col("n").alias("b")), "counter", "full_outer")
    kind = F.when(F.col("b").isNull(), "missing").when(F.col("a").isNull(), "extra").when(F.col("a") != F.col("b"), "different")
    return both.withColumn("kind", kind).where("kind is not null")


def unpivoted(df: DataFrame) -> DataFrame:
    names = [c for c in df.columns if c.startswith("n_")]
    return df.select(F.explode(F.array(*(F.struct(F.lit(c[2:].upper()).alias("counter"), F.col(c).cast("long").alias("n")) for c in names))).alias("e")).select("e.*")


def bucket_bound(value: Column) -> Column:
    """The upper bound of a value's bucket: exact below 16 (negative values are 0, as a histogram holds them), else 16 buckets for
    each power of two."""
    value = F.greatest(value, F.lit(0).cast("long"))
    power = F.length(F.bin(value)) - 1
    step = F.pow(F.lit(2.0), power - 4).cast("long")
    return F.when(value < 16, value).otherwise((F.floor(value / step) + 1) * step - 1).cast("long")


def percentiles(df: DataFrame, value: Column, by: list[str], at: dict[str, float]) -> DataFrame:
    """Percentiles by bucket bounds, at most 6.25 % above the exact ones; the buckets, not the rows, are ordered."""
    buckets = df.where(value.isNotNull()).groupBy(*by, bucket_bound(value).alias("_bound")).agg(F.count("*").alias("_n"))
    w = Window.partitionBy(*by).orderBy("_bound")
    ranked = buckets.withColumn("_upto", F.sum("_n").over(w)).withColumn("_all", F.sum("_n").over(Window.partitionBy(*by)))
    picked = [F.min(F.when(F.col("_upto") >= F.greatest(F.ceil(F.col("_all") * q), F.lit(1)), F.col("_bound"))).alias(name) for name, q in at.items()]
    return ranked.groupBy(*by).agg(F.sum("_n").cast("long").alias("n"), *picked)


def ticks_of(events: DataFrame, at: str, n: Column) -> DataFrame:
    return events.groupBy(F.unix_seconds(F.date_trunc("second", F.col(at))).alias("second")).agg(F.sum(n).cast("long").alias("marks"))


def rates(events: DataFrame, at: str, n: Column, spans: tuple[int, ...] = (1, 10, 60)) -> DataFrame:
    """Marks by second, and their trailing means over so many seconds; seconds without events have no row.

    Days are worked on apart, each with the last seconds before it."""
    ticks = ticks_of(events, at, n)
    day = lambda second: F.floor(second / 86_400)
    ticks = ticks.withColumn("_day", F.explode(F.sequence(day(F.col("second")), day(F.col("second") + max(spans) - 1))))
    w = lambda s: Window.partitionBy("_day").orderBy("second").rangeBetween(1 - s, 0)
    means = ticks.select("second", "marks", "_day", *((F.sum("marks").over(w(s)) / s).alias(f"mean_{s}s") for s in spans))
    return means.where(F.col("_day") == day(F.col("second"))).drop("_day")


#: An average's memory in spans: what is older weighs less than a double can tell.
MEMORY = 40


def smoothed(events: DataFrame, at: str, n: Column, spans: tuple[int, ...] = (1, 10, 60)) -> DataFrame:
    """Marks by second, and their exponentially weighted averages with the factor 1 - exp(-1 / span) for each second, of which those
    without events count as 0; the first second with events begins all averages.

    An average is a weighted sum over the last seconds. For each span, time is cut into slots of ``MEMORY`` spans; a second stands in
    its slot and the next one, so a slot holds all that counts for its own seconds, and slots are worked on apart."""
    ticks = ticks_of(events, at, n)
    first = ticks.agg(F.lit(1).alias("_one"), F.min("second").alias("_begin"))
    out = ticks
    for span in spans:
        size = MEMORY * span
        slot = F.floor(F.col("second") / size)
        alpha = 1 - math.exp(-1 / span)
        own = ticks.withColumn("_one", F.lit(1)).join(F.broadcast(first), "_one").select("second", F.when(F.col("second") == F.col("_begin"), F.lit(1.0)).otherwise(alpha).alias("_part"), "marks", F.explode(F.array(slot, slot + 1)).alias("_slot"))
        age = (F.col("second") - F.col("_slot") * size) / F.lit(float(span))
        w = Window.partitionBy("_slot").orderBy("second")
        summed = F.sum(F.col("marks") * F.col("_part") * F.exp(age)).over(w) * F.exp(-age)
        averages = own.withColumn(f"ewma_{span}s", summed).where(F.col("_slot") == slot).select(F.col("second").alias("_second"), f"ewma_{span}s")
        out = out.join(averages, F.col("second") == F.col("_second")).drop("_second")
    return out


def throughput(events: DataFrame, at: str, n: Column) -> DataFrame:
    """All marks, the seconds from the first to the last event (1 at least), and the mean by second."""
    second = F.unix_seconds(F.col(at))
    return events.agg(F.sum(n).cast("long").alias("total"), F.greatest(F.max(second) - F.min(second), F.lit(1)).alias("seconds")).withColumn("mean_per_second", F.col("total") / F.col("seconds"))
