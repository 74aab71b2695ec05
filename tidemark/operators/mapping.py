"""Column mapping: from an origin table to the columns, the key, the unset flags and the errors of target rows.

For every target column the first of these gives its source: exploded key, exploded value, extracted JSON, constant, rename, the
column of the same name. All of it is compiled once to Spark columns.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.convert import Converted, builtin, convert, literal
from tidemark.spec import JobSpec, SpecError, TableSpec, Violation, check_tables

ENTRY_KEY, ENTRY_VALUE = "_entry_key", "_entry_value"


def quoted(name: str) -> Column:
    """A column by its exact name, whatever characters that has."""
    return F.col("`" + name.replace("`", "``") + "`")


@dataclass
class Source:
    target: str
    kind: str  # exploded key, exploded value, extracted, constant, renamed, same, absent
    origin: str | None
    origin_type: str | None
    target_type: str
    converted: Converted | None


@dataclass
class Mapping:
    origin: TableSpec
    target: TableSpec
    job: JobSpec
    sources: list[Source]

    @classmethod
    def resolve(cls, origin: TableSpec, target: TableSpec, job: JobSpec, extra: list[tuple] | None = None) -> Mapping:
        """Compiles the mapping; all that is wrong is reported at once. ``extra``: a user's conversions (name, from, to, build)."""
        wrong = job.violations()
        wrong += check_tables(origin, target, job)[0]
        if wrong:
            raise SpecError(wrong)
        codecs = builtin(job.codecs, job.timestamp_format, job.timestamp_zone)
        for own in extra or []:
            codecs.add(*own)
        renamed = {t: o for o, t in job.renames}
        sources, kept = [], [c for c in origin.columns if c not in job.skip]
        for name in target.columns:
            field = target.schema[name]
            kind, column, origin_name, origin_type = "absent", None, None, None
            if job.explode and name == job.explode.key:
                kind, column, origin_name, origin_type = "exploded key", F.col(ENTRY_KEY), job.explode.column, origin.type_of(job.explode.column).keyType
            elif job.explode and name == job.explode.value:
                kind, column, origin_name, origin_type = "exploded value", F.col(ENTRY_VALUE), job.explode.column, origin.type_of(job.explode.column).valueType
            elif job.extract and name == job.extract.target:
                kind, origin_name, origin_type = "extracted", job.extract.column, T.StringType()
            elif name in job.constants:
                kind, origin_type = "constant", field.dataType
                try:
                    column = literal(job.constants[name], field.dataType)
                except ValueError as e:
                    wrong.append(Violation("constants", str(e)))
                    continue
            elif name in renamed and renamed[name] in kept:
                kind, origin_name = "renamed", renamed[name]
            elif name in kept:
                kind, origin_name = "same", name
            if kind in ("renamed", "same"):
                column, origin_type = quoted(origin_name), origin.type_of(origin_name)
            converted = None
            try:
                if kind == "extracted":
                    converted = extracted(quoted(origin_name), job.extract.json_path, field.dataType)
                elif column is not None:
                    converted = convert(column, origin_type, field.dataType, codecs, field.metadata)
            except TypeError as e:
                wrong.append(Violation("types", f"{name}: {e}"))
                continue
            sources.append(Source(name, kind, origin_name, origin_type.simpleString() if origin_type is not None else None, field.dataType.simpleString(), converted))
        for s in sources:
            if s.kind == "absent" and s.target in target.key:
                wrong.append(Violation("keys", f"nothing gives the target key column {s.target}"))
        if wrong:
            raise SpecError(wrong)
        if job.extract and job.extract.exclusive:
            sources = [s for s in sources if s.target in target.key or s.kind == "extracted"]
        return cls(origin, target, job, sources)

    def of_kind(self, *kinds: str) -> list[str]:
        return [s.target for s in self.sources if s.kind in kinds]

    @property
    def origin_only(self) -> list[str]:
        used = {s.origin for s in self.sources}
        return [c for c in self.origin.columns if c not in used]

    def table(self, df: DataFrame) -> DataFrame:
        """The mapping as rows: target, target_type, source, kind, origin_type, conversion."""
        rows = [(s.target, s.target_type, s.origin, s.kind, s.origin_type, s.converted.rule if s.converted else None) for s in self.sources]
        rows += [(None, None, c, "origin only", self.origin.type_of(c).simpleString(), None) for c in self.origin_only]
        return df.sparkSession.createDataFrame(rows, "target string, target_type string, source string, kind string, origin_type string, conversion string")

    def exploded(self, df: DataFrame) -> DataFrame:
        """One row per map entry; rows without entries are left out (they count as skipped)."""
        return df if self.job.explode is None else df.select("*", F.explode(quoted(self.job.explode.column)).alias(ENTRY_KEY, ENTRY_VALUE))

    def every_entry(self, df: DataFrame, wanted: Column) -> DataFrame:
        """One row per map entry of the wanted rows, and one for each other row. ``_first`` marks one row of each origin row, and
        ``_entry`` those that hold an entry (all, if nothing is exploded)."""
        if self.job.explode is None:
            return df.withColumn("_first", F.lit(True)).withColumn("_entry", F.lit(True))
        out = df.select("*", F.posexplode_outer(F.when(wanted, quoted(self.job.explode.column))).alias("_place", ENTRY_KEY, ENTRY_VALUE))
        return out.withColumn("_first", F.coalesce(F.col("_place") == 0, F.lit(True))).withColumn("_entry", F.col("_place").isNotNull()).drop("_place")

    def apply(self, df: DataFrame, keep: list[str] | None = None, exploded: bool = False) -> DataFrame:
        """Target columns, with ``_errors`` (array of column and reason), ``_unset`` (names of cells left alone) and ``keep``."""
        df = df if exploded else self.exploded(df)
        values, errors, unset = [], [], []
        for s in self.sources:
            field = self.target.schema[s.target]
            if s.converted is None:
                values.append(F.lit(None).cast(field.dataType).alias(s.target))
                unset.append(F.lit(s.target))
                continue
            value = s.converted.value
            if s.converted.failed is not None:
                errors.append(F.when(F.coalesce(s.converted.failed, F.lit(False)), F.struct(F.lit(s.target).alias("column"), F.lit(s.converted.rule).alias("reason"))))
            if isinstance(field.dataType, T.MapType) and self.job.strip_null_map_values:
                value = F.map_filter(value, lambda _, v: v.isNotNull())
            if s.target in self.target.key:
                missing = value.isNull() if s.converted.failed is None else value.isNull() & ~F.coalesce(s.converted.failed, F.lit(False))
                value = substituted(value, field.dataType, self.job.missing_key_timestamp_ms)
                bad = missing & value.isNull()
                if isinstance(field.dataType, T.ArrayType | T.MapType):
                    bad = bad | (F.size(value) == 0)
                errors.append(F.when(bad, F.struct(F.lit(s.target).alias("column"), F.lit("null in key").alias("reason"))))
            else:
                unset.append(F.when(is_unset(value, field.dataType), F.lit(s.target)))
            values.append(value.alias(s.target))
        listed = lambda items, kind: F.array_compact(F.array(*items)) if items else F.array().cast(kind)
        return df.select(*(quoted(k) for k in keep or []), *values, listed(errors, "array<struct<column:string,reason:string>>").alias("_errors"), listed(unset, "array<string>").alias("_unset"))


def extracted(document: Column, path: str, target: T.DataType) -> Converted:
    """The JSON value at the path. Blank document or absent path: nothing; JSON null: null; malformed: an error."""
    blank = document.isNull() | (F.trim(document) == "")
    parsed = F.try_parse_json(F.when(~blank, document))
    found = F.try_variant_get(parsed, path, "variant")
    if isinstance(target, T.StringType):
        raw = F.to_json(found)
        value = F.when(F.is_variant_null(found), None).when(raw.startswith('"'), F.try_variant_get(parsed, path, "string")).otherwise(raw)
        failed = ~blank & parsed.isNull()
    else:
        text = F.try_variant_get(parsed, path, "string")
        value = F.when(text.isNotNull(), text.try_cast(target))
        failed = (~blank & parsed.isNull()) | (found.isNotNull() & ~F.coalesce(F.is_variant_null(found), F.lit(False)) & value.isNull())
    return Converted(value, F.coalesce(failed, F.lit(False)), "json")


def substituted(key: Column, kind: T.DataType, timestamp_ms: int | None) -> Column:
    """What stands for a null in a target key: an empty text, the configured time, or nothing (an error)."""
    if isinstance(kind, T.StringType):
        return F.coalesce(key, F.lit(""))
    if isinstance(kind, T.TimestampType) and timestamp_ms is not None:
        return F.coalesce(key, F.timestamp_millis(F.lit(timestamp_ms)))
    return key


def is_unset(value: Column, kind: T.DataType) -> Column:
    """Nulls and empty collections leave the target's cell alone."""
    return value.isNull() | (F.size(value) == 0) if isinstance(kind, T.ArrayType | T.MapType) else value.isNull()


# Writetime and TTL, which stand in side columns c__wt and c__ttl


def eligible(origin: TableSpec, job: JobSpec, suffix: str) -> list[str]:
    """The columns whose writetime (or TTL) counts: named ones, else values that aren't unfrozen collections."""
    named = job.writetime_columns if suffix == "__wt" else job.ttl_columns
    if origin.counters:
        return []
    plain = [c for c in origin.values if not c.endswith(("__wt", "__ttl")) and c + suffix in origin.columns]
    if named is not None:
        return [c for c in named if c in plain]
    whole = lambda c: not isinstance(origin.type_of(c), T.ArrayType | T.MapType) or origin.schema[c].metadata.get("frozen")
    return [c for c in plain if whole(c) or job.collection_writetimes]


def largest(columns: list[Column]) -> Column:
    return columns[0] if len(columns) == 1 else F.greatest(*columns)


def side(origin: TableSpec, names: list[str], suffix: str) -> list[Column]:
    return [F.array_max(quoted(c + suffix)) if isinstance(origin.type_of(c + suffix), T.ArrayType) else quoted(c + suffix) for c in names]


def row_writetime(origin: TableSpec, job: JobSpec) -> Column:
    if job.custom_writetime > 0:
        return F.lit(job.custom_writetime).cast("long")
    names = eligible(origin, job, "__wt")
    return largest(side(origin, names, "__wt")) + F.lit(job.writetime_increment) if names else F.lit(None).cast("long")


def row_ttl(origin: TableSpec, job: JobSpec) -> Column:
    if job.custom_ttl > 0:
        return F.lit(job.custom_ttl)
    names = eligible(origin, job, "__ttl")
    return F.coalesce(largest(side(origin, names, "__ttl")), F.lit(0)) if names else F.lit(None).cast("int")
