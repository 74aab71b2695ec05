"""Keyed writes: upserts in which the later write wins cell by cell, and counter updates by differences."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.mapping import quoted


def duplicate_keys(df: DataFrame, key: list[str]) -> DataFrame:
    """Keys that stand more than once, with their number of rows; a keyed job is refused when there are any."""
    return df.groupBy(*map(quoted, key)).agg(F.count("*").alias("n")).where("n > 1")


def unshared(df: DataFrame, key: list[str], message: str, counted: Column | None = None) -> DataFrame:
    """The rows as they are; a key's second row (of those ``counted``) ends the job with ``message``. The rows are numbered within
    their key, by the shuffle and the sort that a join by key needs anyhow, so the check costs no scan and no shuffle of its own."""
    within = Window.partitionBy(*map(quoted, key)).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    nth = F.count("*") if counted is None else F.count_if(counted)
    fine = F.when(F.col("_nth") > 1, F.raise_error(F.lit(message)).cast("boolean")).otherwise(F.lit(True))
    return df.withColumn("_nth", nth.over(within)).where(fine).drop("_nth")


def keyed(df: DataFrame, key: list[str], order: Column | None = None) -> DataFrame:
    """One row per key, the one that ``order`` puts last (ties: the greatest row)."""
    columns = [quoted(c) for c in df.columns]
    last = F.max_by(F.struct(*columns), order if order is not None else F.struct(*columns))
    return df.groupBy(*map(quoted, key)).agg(last.alias("_row")).select("_row.*")


def of(side: str, name: str) -> Column:
    """A column of one side of a join, whatever characters its name has."""
    return F.col(f"{side}.`" + name.replace("`", "``") + "`")


def same_keys(key: list[str], left: str, right: str) -> Column:
    found = F.lit(True)
    for k in key:
        found = found & (of(left, k) == of(right, k))
    return found


def with_defaults(writes: DataFrame) -> DataFrame:
    """Writes with all of ``_unset``, ``_writetime`` and ``_ttl``."""
    for name, default in (("_unset", F.array().cast("array<string>")), ("_writetime", F.lit(None).cast("long")), ("_ttl", F.lit(None).cast("int"))):
        if name not in writes.columns:
            writes = writes.withColumn(name, default)
    return writes


def upsert(target: DataFrame, writes: DataFrame, key: list[str], columns: list[str], fill_only: list[str] | None = None) -> DataFrame:
    """The target after the writes. ``writes`` holds key and columns, and may hold ``_unset`` (names of cells to leave alone),
    ``_writetime`` and ``_ttl``. With side columns c__wt in the target, the later write wins a cell, and the greater value of a tie.
    Columns in ``fill_only`` are written only where the target has null."""
    w = with_defaults(writes).withColumn("_written", F.lit(True))
    both = target.alias("t").join(w.alias("w"), same_keys(key, "t", "w"), "full_outer")
    return both.select(*merged_cells(target.columns, key, columns, F.col("w._written").isNotNull(), fill_only))


def merged_cells(stored: list[str], key: list[str], columns: list[str], written: Column, fill_only: list[str] | None = None) -> list[Column]:
    """Key and cells of a target row t (with columns ``stored``) after the write w, if ``written``."""
    out = [F.coalesce(of("w", k), of("t", k)).alias(k) for k in key]
    for c in columns:
        old, new = of("t", c), of("w", c)
        keep = ~written | F.array_contains(F.col("w._unset"), c)
        if c in (fill_only or []):
            keep = keep | old.isNotNull()
        has_time = f"{c}__wt" in stored
        if has_time:
            before, now = of("t", f"{c}__wt"), F.col("w._writetime")
            older = F.coalesce(before > now, F.lit(False))
            tie = F.coalesce((before == now) & (old > new), F.lit(False))
            keep = keep | older | tie
        out.append(F.when(keep, old).otherwise(new).alias(c))
        if has_time:
            out.append(F.when(keep, before).otherwise(now).alias(f"{c}__wt"))
        if f"{c}__ttl" in stored:
            out.append(F.when(keep, of("t", f"{c}__ttl")).otherwise(F.col("w._ttl")).alias(f"{c}__ttl"))
    return out


def counter_updates(origin: DataFrame, target: DataFrame, key: list[str], counters: list[str]) -> DataFrame:
    """Per origin row the key, and for each counter c: c__delta (null: nothing to add) and c (the target's new value); ``_error``
    if a difference doesn't fit 64 bits."""
    both = origin.alias("o").join(target.alias("t"), same_keys(key, "o", "t"), "left")
    out, errors = [of("o", k).alias(k) for k in key], F.lit(False)
    for c in counters:
        wanted, stored = of("o", c), of("t", c)
        now = F.coalesce(stored, F.lit(0).cast("long"))
        delta = F.try_subtract(wanted, now)
        out += [delta.alias(f"{c}__delta"), F.when(delta.isNull(), stored).otherwise(F.try_add(now, delta)).alias(c)]
        errors = errors | (wanted.isNotNull() & delta.isNull())
    return both.select(*out, errors.alias("_error"))


def arrival_batches(df: DataFrame, size: int) -> DataFrame:
    """``batch_no`` in the order in which rows arrive, by task, whatever their partition keys: no shuffle; a number holds the task's
    in its upper 31 bits."""
    number = F.monotonically_increasing_id()
    within = number.bitwiseAND(F.lit((1 << 33) - 1))
    return df.withColumn("batch_no", F.shiftleft(F.shiftright(number, 33), 33) + F.floor(within / size).cast("long"))


def batches(df: DataFrame, partition_key: list[str], order: list[str], size: int) -> DataFrame:
    """``batch_no`` within the partition key, from 1; a batch never mixes partition keys."""
    number = F.row_number().over(Window.partitionBy(*map(quoted, partition_key)).orderBy(*map(quoted, order)))
    return df.withColumn("batch_no", F.ceil(number / size).cast("long"))
