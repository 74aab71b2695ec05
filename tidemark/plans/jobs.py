"""The jobs a user calls: migrate, validate (with autocorrect), guardrail, convert, profile, and resume.

Each job is one lazy plan over whole tables, which reads each side once; counters come from an outcome column of the same plan. Rows
that share a key end the job when it runs, with a message that names the table.
"""

from __future__ import annotations

import itertools
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field, replace

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.convert import builtin, convert
from tidemark.operators import filters, guardrail, metrics, ranges, reconcile
from tidemark.operators.mapping import Mapping, quoted, row_ttl, row_writetime
from tidemark.operators.merge import arrival_batches, batches, counter_updates, keyed, merged_cells, of, unshared, upsert
from tidemark.plans import tracking
from tidemark.session import stored
from tidemark.sources.tables import BucketedTable
from tidemark.spec import JobSpec, TableSpec


@dataclass
class Extensions:
    """What users add to a job: conversions (name, from, to, build), filters (name, accepts, fails or None), transforms of origin
    rows (a frame to a frame), guardrails (name, predicate for rows that are fine) and, by column, tests for being equal.

    ``records`` makes several records of one origin row, or none: a column of array<struct>, built of Spark's functions or a user's
    (Arrow) function, whose structs' fields take the place of the origin's columns of their names, or are added to them."""

    codecs: list[tuple] = field(default_factory=list)
    filters: list[tuple] = field(default_factory=list)
    transforms: list[Callable[[DataFrame], DataFrame]] = field(default_factory=list)
    guardrails: list[tuple[str, Column]] = field(default_factory=list)
    compare: dict[str, Callable[[Column, Column], Column]] = field(default_factory=dict)
    records: Column | None = None

    def transformed(self, df: DataFrame) -> DataFrame:
        for f in self.transforms:
            df = df.transform(f)
        return df

    def every_record(self, df: DataFrame, wanted: Column, mapping: Mapping) -> DataFrame:
        """One row per record (or map entry) of the wanted rows, and one for each other row, with ``_first`` and ``_entry`` as
        ``Mapping.every_entry`` sets them."""
        if self.records is None:
            return mapping.every_entry(df, wanted)
        if mapping.job.explode:
            raise ValueError("a job either explodes a map or makes records")
        out = df.select("*", F.posexplode_outer(F.when(wanted, self.records)).alias("_place", "_record"))
        names = out.schema["_record"].dataType.names
        rest = [quoted(c) for c in df.columns if c not in names]
        first, entry = F.coalesce(F.col("_place") == 0, F.lit(True)), F.col("_place").isNotNull()
        return out.select(*rest, *(F.col("_record")[n].alias(n) for n in names), first.alias("_first"), entry.alias("_entry"))


@dataclass
class Migration:
    """``every``: one row for each origin row that a filter keeps back or that has no map entry, and for each target row to be
    (tried to be) written, with ``outcome`` (WRITE, SKIPPED, ERROR), ``_errors``, ``_unset``, ``_writetime``, ``_ttl``, ``_large``."""

    mapping: Mapping
    every: DataFrame

    @property
    def rows(self) -> DataFrame:
        """The target rows to be written, and those that can't be."""
        return self.every.where("_tried").drop("_tried", "_first", "_rejected_by", "_large")

    @property
    def writes(self) -> DataFrame:
        return self.rows.where("outcome = 'WRITE'").drop("outcome", "_errors")

    def counters(self, by: list[str] | None = None, flushed: bool = True) -> DataFrame:
        """READ counts origin rows; the others count target rows. All from one pass, by group if asked for (columns that were kept).
        Before the target's new version is in place (not ``flushed``), what is to be written counts as UNFLUSHED, not as WRITE."""
        counted = [F.count_if("_first").alias("n_read")] + [F.count_if((F.col("outcome") == o) & F.lit(flushed or o != "WRITE")).alias(f"n_{o.lower()}") for o in ("WRITE", "SKIPPED", "ERROR")]
        if not flushed:
            counted.append(F.count_if(F.col("outcome") == "WRITE").alias("n_unflushed"))
        return self.every.groupBy(*map(quoted, by or [])).agg(*counted)

    def diagnostics(self) -> DataFrame:
        """What the guardrail found, in any mode: the target key, whether the row is held back, and the findings."""
        found = self.every.where(F.col("_first") & (F.size("_large") > 0))
        return found.select(*map(quoted, self.mapping.target.key), (F.col("outcome") == "SKIPPED").alias("held_back"), guardrail.report(F.col("_large")).alias("report"))

    def merged(self, target: DataFrame, on_duplicate: str = "fail") -> DataFrame:
        """The target after the job (a dry run leaves it as it is). Rows that share a target key are refused, or the latest of them is
        taken."""
        if self.mapping.job.dry_run:
            return target
        key, columns = list(self.mapping.target.key), [s.target for s in self.mapping.sources if s.target not in self.mapping.target.key]
        writes = self.writes
        if on_duplicate == "latest":
            writes = keyed(writes, key, F.struct(F.col("_writetime"), F.xxhash64(*map(quoted, columns)) if columns else F.lit(0)))
        else:
            writes = unshared(writes, key, f"rows of {self.mapping.origin.name} share keys of {self.mapping.target.name}")
        return upsert(target, writes, key, columns, backfilled(self.mapping.job))

    def batched(self) -> DataFrame:
        """The rows to write, numbered in batches: within their partition key, or as they arrive if the job says so."""
        if self.mapping.job.batches == "arrival":
            return arrival_batches(self.writes, self.mapping.job.effective_batch(self.mapping.target))
        return batches(self.writes, list(self.mapping.target.partition_key), list(self.mapping.target.clustering_key or self.mapping.target.key), self.mapping.job.effective_batch(self.mapping.target))


def backfilled(job: JobSpec) -> list[str]:
    """Columns that are written only where the target has none: those extracted without overwriting."""
    return [job.extract.target] if job.extract and not job.extract.overwrite else []


def filter_chain(origin: DataFrame, spec: TableSpec, job: JobSpec, token: Column | None = None, writetime: bool = True, extensions: Extensions | None = None) -> filters.FilterChain:
    chain = filters.FilterChain()
    if job.where:
        chain.add("where", filters.condition(job.where))
    if job.token_bounds and token is not None:
        chain.add("token bounds", filters.in_bounds(token, *job.token_bounds))
    if writetime and job.writetime_window:
        chain.add("writetime window", filters.written_within(row_writetime(spec, job), *job.writetime_window))
    if job.exclude_value:
        chain.add("column value", filters.value_differs(*job.exclude_value))
    for own in extensions.filters if extensions else []:
        chain.add(*own)
    if job.guardrail_mode == "block" and (job.guardrail_kb > 0 or extensions and extensions.guardrails):
        chain.add("guardrail", F.size(large_cells(origin, job, extensions)) == 0)
    return chain


def large_cells(origin: DataFrame, job: JobSpec, extensions: Extensions | None = None) -> Column:
    """The guardrail's findings in a row: oversized cells, and the users' guardrails that it fails (with 0 bytes)."""
    kind = "array<struct<column:string,bytes:bigint>>"
    found = guardrail.oversized(origin, job.guardrail_kb) if job.guardrail_kb > 0 else F.array().cast(kind)
    own = [F.when(~F.coalesce(fine, F.lit(False)), F.struct(F.lit(name).alias("column"), F.lit(0).cast("long").alias("bytes"))) for name, fine in (extensions.guardrails if extensions else [])]
    return F.concat(found.cast(kind), F.array_compact(F.array(*own)).cast(kind)) if own else found.cast(kind)


def migrate(origin: DataFrame, origin_spec: TableSpec, target_spec: TableSpec, job: JobSpec, token: Column | None = None, keep: list[str] | None = None, extensions: Extensions | None = None) -> Migration:
    """One lazy plan: filters, guardrail (check and warn let rows pass, block holds them back), map entries, conversions."""
    extensions = extensions or Extensions()
    mapping = Mapping.resolve(origin_spec, target_spec, job, extensions.codecs)
    origin = extensions.transformed(origin)
    read = filter_chain(origin, origin_spec, job, token, extensions=extensions).mark(origin)
    read = read.withColumn("_large", large_cells(origin, job, extensions)).withColumn("_writetime", row_writetime(origin_spec, job)).withColumn("_ttl", row_ttl(origin_spec, job))
    every = extensions.every_record(read, F.col("_outcome").isNull(), mapping).withColumn("_tried", F.col("_outcome").isNull() & F.col("_entry"))
    rows = mapping.apply(every, ["_writetime", "_ttl", "_outcome", "_rejected_by", "_large", "_first", "_tried", *(keep or [])], exploded=True)
    outcome = F.when(F.col("_outcome").isNotNull(), F.col("_outcome")).when(~F.col("_tried"), "SKIPPED").when(F.size("_errors") > 0, "ERROR").otherwise("WRITE")
    return Migration(mapping, rows.withColumn("outcome", outcome).drop("_outcome"))


def compared_columns(mapping: Mapping) -> list[str]:
    return [s.target for s in mapping.sources if s.target not in mapping.target.key and s.kind not in ("constant", "absent")]


def validate(origin: DataFrame, target: DataFrame, origin_spec: TableSpec, target_spec: TableSpec, job: JobSpec, token: Column | None = None, keep: list[str] | None = None, extensions: Extensions | None = None, check_keys: bool = True) -> DataFrame:
    """Every mapped origin row with its outcome and differences; the writetime window isn't applied here. A target with rows that
    share a key is refused (``check_keys``), as such rows would be counted more than once."""
    extensions = extensions or Extensions()
    mapping = Mapping.resolve(origin_spec, target_spec, job, extensions.codecs)
    origin = extensions.transformed(origin)
    read = filter_chain(origin, origin_spec, job, token, writetime=False, extensions=extensions).mark(origin).where("_outcome is null")
    key = list(target_spec.key)
    if check_keys:
        target = unshared(target.select(*map(quoted, dict.fromkeys([*key, *compared_columns(mapping)]))), key, f"rows of {target_spec.name} share its key")
    if extensions.records is None:
        rows = mapping.apply(read, keep)
    else:
        rows = mapping.apply(extensions.every_record(read, F.lit(True), mapping).where("_entry"), keep, exploded=True)
    return reconcile.validate(rows, target, key, compared_columns(mapping), keep=keep, only_if_target_null=backfilled(job), strict_empty=job.strict_empty, hooks=extensions.compare)


def autocorrect(origin: DataFrame, target: DataFrame, origin_spec: TableSpec, target_spec: TableSpec, job: JobSpec, extensions: Extensions | None = None) -> tuple[DataFrame, DataFrame]:
    """The validated rows, and the target after missing and differing rows were written again. One full outer join by key gives both
    the outcomes and the repaired rows; rows that share a key on either side are refused. A dry run leaves the target as it is."""
    extensions = extensions or Extensions()
    if job.dry_run:
        return validate(origin, target, origin_spec, target_spec, job, extensions=extensions), target
    key = list(target_spec.key)
    missing = job.autocorrect_missing and (not target_spec.counters or job.autocorrect_missing_counter)
    if target_spec.counters:
        checked = validate(origin, target, origin_spec, target_spec, job, extensions=extensions)
        written = migrate(origin, origin_spec, target_spec, job, extensions=extensions)
        wanted = reconcile.corrections(written.writes, checked, key, missing, job.autocorrect_mismatch)
        new = counter_updates(wanted, target, key, sorted(target_spec.counters)).where(~F.col("_error")).select(*map(quoted, key), *map(quoted, sorted(target_spec.counters)))
        return checked, upsert(target, new, key, sorted(target_spec.counters))
    job_rows = migrate(origin, origin_spec, target_spec, replace(job, writetime_window=None), extensions=extensions)
    rows, mapping = job_rows.rows.drop("outcome"), job_rows.mapping
    rows = unshared(rows, key, f"rows of {origin_spec.name} share keys of {target_spec.name}", F.size("_errors") == 0)
    target = unshared(target, key, f"rows of {target_spec.name} share its key")
    both = reconcile.compared(rows, target, key, compared_columns(mapping), None, backfilled(job), job.strict_empty, extensions.compare, "full_outer")
    repaired = [o for o, on in ((reconcile.MISSING, missing), (reconcile.MISMATCH, job.autocorrect_mismatch)) if on]
    written = F.coalesce(F.col("outcome").isin(*repaired), F.lit(False)) if repaired else F.lit(False)
    columns = [s.target for s in mapping.sources if s.target not in key]
    after = both.where(F.col("t._found").isNotNull() | written).select(*merged_cells(target.columns, key, columns, written, backfilled(job)))
    return reconcile.validated(both, key), after


def repair(origin: DataFrame, store: BucketedTable, origin_spec: TableSpec, target_spec: TableSpec, job: JobSpec, extensions: Extensions | None = None) -> tuple[DataFrame, list[int]]:
    """Autocorrect of a bucketed target in place: one left join by key finds the rows to write again, which are stored, and only the
    buckets that hold such rows are read again and rewritten. Gives the rows written and the numbers of those buckets."""
    key = list(target_spec.key)
    job_rows = migrate(origin, origin_spec, target_spec, replace(job, writetime_window=None), extensions=extensions)
    rows = unshared(job_rows.rows.drop("outcome"), key, f"rows of {origin_spec.name} share keys of {target_spec.name}", F.size("_errors") == 0)
    columns = [s.target for s in job_rows.mapping.sources if s.target not in key]
    target = store.read()
    seen = unshared(target.select(*map(quoted, dict.fromkeys([*key, *compared_columns(job_rows.mapping)]))), key, f"rows of {target_spec.name} share its key")
    both = reconcile.compared(rows, seen, key, compared_columns(job_rows.mapping), None, backfilled(job), job.strict_empty, (extensions or Extensions()).compare)
    repaired = [o for o, on in ((reconcile.MISSING, job.autocorrect_missing), (reconcile.MISMATCH, job.autocorrect_mismatch)) if on]
    wanted = both.where(F.col("outcome").isin(*repaired)).select(*(of("w", c).alias(c) for c in [*key, *columns, "_unset", "_writetime", "_ttl"]))
    writes = stored(wanted, "repairs")
    return writes, [] if job.dry_run else store.upsert(writes, columns, backfilled(job))


def validation_counters(checked: DataFrame, by: list[str], job: JobSpec, counter_table: bool = False) -> DataFrame:
    """The counters of a validate job by group, with verdicts; what autocorrect is asked for counts as corrected."""
    out = metrics.counters(checked, by, ["MISSING", "MISMATCH", "VALID", "ERROR"])
    fix = job.autocorrect_missing and (not counter_table or job.autocorrect_missing_counter)
    out = out.withColumn("n_corrected_missing", F.col("n_missing") if fix else F.lit(0).cast("long"))
    out = out.withColumn("n_corrected_mismatch", F.col("n_mismatch") if job.autocorrect_mismatch else F.lit(0).cast("long"))
    return out.withColumn("verdict", metrics.verdict(*(F.col(f"n_{c}") for c in ("missing", "mismatch", "corrected_missing", "corrected_mismatch"))))


def convert_table(df: DataFrame, target: T.StructType, codecs: frozenset[str], key: list[str], **options: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The converted rows, the errors (key, column, reason, value), and errors counted by column."""
    known = builtin(codecs, **options)
    done = {f.name: convert(quoted(f.name), df.schema[f.name].dataType, f.dataType, known, f.metadata) for f in target.fields}
    flags = [F.when(F.coalesce(c.failed, F.lit(False)), F.struct(F.lit(n).alias("column"), F.lit(c.rule).alias("reason"), quoted(n).cast("string").alias("value"))) for n, c in done.items() if c.failed is not None]
    errors = F.array_compact(F.array(*flags)) if flags else F.array().cast("array<struct<column:string,reason:string,value:string>>")
    marked = df.withColumn("_errors", errors)
    ok = marked.where(F.size("_errors") == 0).select(*(c.value.alias(n) for n, c in done.items()))
    bad = marked.select(*map(quoted, key), F.explode("_errors").alias("e")).select(*map(quoted, key), "e.column", "e.reason", "e.value")
    return ok, bad, bad.groupBy("column").agg(F.count("*").alias("n_errors"))


def profile(df: DataFrame, spec: TableSpec, large_text: int = 8000) -> DataFrame:
    """Rows, bytes and the largest text of a table, with advice for parts, batch size, fetch size and rate."""
    sizes = [F.coalesce(guardrail.stored_bytes(quoted(f.name), f.dataType, f.metadata), F.lit(0).cast("long")) for f in df.schema.fields]
    texts = [F.coalesce(F.octet_length(quoted(f.name)), F.lit(0)) for f in df.schema.fields if isinstance(f.dataType, T.StringType | T.BinaryType)]
    largest = texts[0] if len(texts) == 1 else F.greatest(*texts) if texts else F.lit(0)
    out = df.agg(F.count("*").alias("n_rows"), F.coalesce(F.sum(sum(sizes[1:], sizes[0])), F.lit(0)).cast("long").alias("n_bytes"), F.coalesce(F.max(largest), F.lit(0)).cast("long").alias("largest_text"))
    gb = F.col("n_bytes") / F.lit(float(1 << 30))
    lob = F.col("largest_text") > large_text
    mean = F.col("n_bytes") / F.greatest(F.col("n_rows"), F.lit(1)) / 1024
    parts = F.greatest(F.ceil(gb * 1024 / 10), F.lit(1000))
    alone = F.lit(not spec.clustering_key)
    return out.select(
        "n_rows",
        "n_bytes",
        "largest_text",
        F.when(F.col("n_rows") > 100_000_000, F.greatest(parts, F.lit(50_000))).otherwise(parts).cast("long").alias("num_parts"),
        F.when(alone | lob | (mean > 20), 1).when(mean < 1, 20).otherwise(5).cast("long").alias("batch_size"),
        F.when(lob, 100).when(mean > 100, 200).otherwise(1000).cast("long").alias("fetch_size"),
        F.when(lob, 5000).when((F.col("n_rows") > 500_000_000) | (gb > 500), 40_000).otherwise(20_000).cast("long").alias("rate_limit"),
    )


def plan(df: DataFrame, token: str, parts: int, coverage: int = 100) -> DataFrame:
    """Ranges over the tokens that a table has."""
    return ranges.split(df.agg(F.min(token).alias("min"), F.max(token).alias("max")), parts, coverage)


def resumed(origin: DataFrame, token: str, pending: DataFrame) -> DataFrame:
    """The origin rows whose token lies in a pending range (token_min, token_max)."""
    work = pending.where("state = 'pending'").select(F.col("token_min").alias("range_id"), F.col("token_min").alias("min"), F.col("token_max").alias("max"))
    return ranges.assigned(origin, token, work)


def ranged(rows: DataFrame, token: str, plan: DataFrame) -> DataFrame:
    """The rows that lie in ranges of the plan (token_min, token_max), with both ends."""
    named = plan.select(F.col("token_min").alias("range_id"), F.col("token_min").alias("min"), F.col("token_max").alias("max"))
    met = ranges.assigned(rows, token, named).withColumnRenamed("range_id", "token_min")
    return met


def recorded(log: tracking.RunLog, table: str, run_id: int, kind: str, plan: DataFrame, by_range: DataFrame, prev_run_id: int = 0, failed: DataFrame | None = None) -> DataFrame:
    """A job on record: the run and its ranges (token_min, token_max) are written as not started, started, and ended with the counters
    of ``by_range`` (token_min, n_...), and the run with their totals. Ranges without rows end with zeros. ``failed``: token_min of
    ranges whose work failed; what they left uncounted goes to their errors. Gives the ended ranges."""
    log.begin(table, run_id, kind, plan, prev_run_id)
    names = [metrics.column(c) for c in metrics.stored_counters(kind) if c not in metrics.TITLES]
    zero = F.lit(0).cast("long")
    known = by_range.select("token_min", *((F.col(c) if c in by_range.columns else zero).cast("long").alias(c) for c in names))
    rows = plan.select("token_min", "token_max").join(known, "token_min", "left").select("token_min", "token_max", *(F.coalesce(c, zero).alias(c) for c in names))
    bad = F.lit(False)
    if failed is not None:
        rows = rows.join(failed.select("token_min", F.lit(True).alias("_bad")), "token_min", "left")
        bad = F.coalesce("_bad", F.lit(False))
    if "n_error" in names:
        rows = rows.withColumn("n_error", F.when(bad, F.col("n_error") + metrics.lost(kind)).otherwise(F.col("n_error")))
    rows = rows.withColumn("status", metrics.range_status(kind, bad))
    rows = rows.withColumn("n_passed", F.when(bad, 0).otherwise(1).cast("long")).withColumn("n_failed", F.when(bad, 1).otherwise(0).cast("long"))
    return log.end(table, run_id, kind, rows)


def recorded_validate(log: tracking.RunLog, run_id: int, plan: DataFrame, origin: DataFrame, token: str, target: DataFrame, origin_spec: TableSpec, target_spec: TableSpec, job: JobSpec, prev_run_id: int = 0) -> DataFrame:
    """Validates the origin's rows in the plan's ranges, on record. ``token`` is a column of the origin."""
    checked = validate(ranged(origin, token, plan), target, origin_spec, target_spec, job, keep=["token_min"])
    return recorded(log, target_spec.name, run_id, "validate", plan, validation_counters(checked, ["token_min"], job, bool(target_spec.counters)), prev_run_id)


def recorded_migrate(log: tracking.RunLog, run_id: int, plan: DataFrame, origin: DataFrame, token: str, origin_spec: TableSpec, target_spec: TableSpec, job: JobSpec, prev_run_id: int = 0) -> tuple[Migration, DataFrame]:
    """The migration of the origin's rows in the plan's ranges, and its ended ranges."""
    done = migrate(ranged(origin, token, plan), origin_spec, target_spec, job, keep=["token_min"])
    return done, recorded(log, target_spec.name, run_id, "migrate", plan, done.counters(["token_min"]), prev_run_id)


def recorded_guardrail(log: tracking.RunLog, run_id: int, plan: DataFrame, origin: DataFrame, token: str, spec: TableSpec, limit_kb: float, prev_run_id: int = 0) -> DataFrame:
    """The guardrail over the origin's rows in the plan's ranges, on record."""
    own = ranged(origin, token, plan)
    large = F.size(guardrail.oversized(own, limit_kb, list(spec.columns))) > 0
    by = own.groupBy("token_min").agg(F.count("*").alias("n_read"), F.count_if(large).alias("n_large"), F.count_if(~large).alias("n_valid"))
    return recorded(log, spec.name, run_id, "guardrail", plan, by, prev_run_id)


def resume(log: tracking.RunLog, table: str, prev_run_id: int, run_id: int, multiplier: int, writes_counters: bool, rerun: Callable[[DataFrame], object]) -> DataFrame:
    """Resumes a run: it is checked, its pending ranges are subdivided, and ``rerun`` (a recorded job with the plan left open) is
    called with them. Gives the ranges that were held back because counters would be added twice."""
    tracking.check_resumable(log.info(), log.details(), table, prev_run_id)
    work = tracking.pending(log.details(), table, prev_run_id, writes_counters)
    held_back = work.where("state = 'quarantined'")
    left = work.where("state = 'pending'").select(F.col("token_min").alias("min"), F.col("token_max").alias("max"))
    parts = ranges.subdivided(left, multiplier) if multiplier > 1 else left
    rerun(parts.select(F.col("min").cast("long").alias("token_min"), F.col("max").cast("long").alias("token_max")))
    return held_back


class Counts:
    """What a user's job counts while it works on a range; what it counted before it failed stays."""

    def __init__(self, names: list[str]) -> None:
        self.n = dict.fromkeys(names, 0)

    def add(self, counter: str, n: int = 1) -> None:
        if counter not in self.n:
            raise KeyError(f"{counter} is no counter of this job; there are: {', '.join(self.n)}")
        self.n[counter] += n


#: A user's work on a range: its ends, its rows in Arrow batches, and the counters.
RangeRunner = Callable[[int, int, Iterator[pa.RecordBatch], Counts], None]


def run_ranges(rows: DataFrame, token: str, plan: DataFrame, runner: RangeRunner, counters: list[str]) -> DataFrame:
    """Runs a user's work on each range of a plan (token_min, token_max): one row per range that has rows, with ``failed``,
    ``error`` and its counters (n_...).

    Ranges are Spark's groups, each in one task; a range's rows come as a stream of batches, so memory follows the batch, not the
    range. READ counts the range's rows, also those that the runner left unread. An exception ends its range only. A task that is
    lost is run again from the range's beginning, so what a runner does outside must bear repetition. The result is stored before it
    is returned, so that the work isn't done again for each reader."""
    own = [c for c in counters if c not in ("READ", *metrics.TITLES)]
    names = [f.name for f in rows.schema.fields]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, read, first = Counts(own), 0, next(batches)
        low, high = first.column("_low")[0].as_py(), first.column("_high")[0].as_py()

        def seen() -> Iterator[pa.RecordBatch]:
            nonlocal read
            for batch in itertools.chain([first], batches):
                read += batch.num_rows
                yield batch.select(names)

        stream, error = seen(), None
        try:
            runner(low, high, stream, counts)
        except Exception as e:  # whatever a user's code raises is the range's failure
            error = f"{type(e).__name__}: {e}"
        for _ in stream:
            pass
        columns = {"token_min": pa.array([low], pa.int64()), "failed": pa.array([error is not None]), "error": pa.array([error], pa.string()), "n_read": pa.array([read], pa.int64())}
        columns |= {metrics.column(c): pa.array([n], pa.int64()) for c, n in counts.n.items()}
        yield pa.RecordBatch.from_pydict(columns)

    dealt = ranged(rows, token, plan.select("token_min", "token_max")).join(small_plan(plan), "token_min")
    kept = dealt.select(*map(quoted, names), F.col("token_min").alias("_low"), F.col("_token_max").alias("_high"))
    schema = "token_min long, failed boolean, error string, n_read long" + "".join(f", {metrics.column(c)} long" for c in own)
    return stored(kept.groupBy("_low").applyInArrow(work, schema), "ranges")


def small_plan(plan: DataFrame) -> DataFrame:
    return ranges.small(plan.select("token_min", F.col("token_max").alias("_token_max")))


def recorded_ranges(log: tracking.RunLog, table: str, run_id: int, kind: str, plan: DataFrame, rows: DataFrame, token: str, runner: RangeRunner, prev_run_id: int = 0) -> DataFrame:
    """A user's job on record, range by range: a range whose work raises ends as FAIL, with its uncounted rows in ERROR, and the
    others end as they do. Gives the ended ranges."""
    done = run_ranges(rows, token, plan, runner, metrics.stored_counters(kind))
    return recorded(log, table, run_id, kind, plan, done, prev_run_id, done.where("failed").select("token_min"))


class JobRegistry:
    """Jobs that users add, by name: ``run(spark, job, extensions, **arguments)``, or work by range with counters of its own; and
    what they add to the built-in ones."""

    def __init__(self) -> None:
        self.jobs: dict[str, Callable] = {}
        self.runners: dict[str, RangeRunner] = {}
        self.extensions = Extensions()

    def job(self, name: str):
        def add(f):
            if name in self.jobs:
                raise ValueError(f"there is a job {name} already")
            self.jobs[name] = f
            return f

        return add

    def range_job(self, name: str, counters: list[str]):
        """Registers a kind of job whose work is done range by range (``run_ranges``)."""
        if name in self.runners or name in ("migrate", "validate", "guardrail"):
            raise ValueError(f"there is a job {name} already")
        metrics.register(name, counters)

        def add(f: RangeRunner) -> RangeRunner:
            self.runners[name] = f
            return f

        return add

    def run_ranges(self, name: str, log: tracking.RunLog, table: str, run_id: int, plan: DataFrame, rows: DataFrame, token: str, prev_run_id: int = 0) -> DataFrame:
        if name not in self.runners:
            raise ValueError(f"there is no job {name}; there are: {', '.join(sorted(self.runners))}")
        return recorded_ranges(log, table, run_id, name, plan, rows, token, self.runners[name], prev_run_id)

    def transform(self, f):
        self.extensions.transforms.append(f)
        return f

    def run(self, name: str, spark, job: JobSpec, **arguments):
        if name not in self.jobs:
            raise ValueError(f"there is no job {name}; there are: {', '.join(sorted(self.jobs))}")
        return self.jobs[name](spark, job, self.extensions, **arguments)
