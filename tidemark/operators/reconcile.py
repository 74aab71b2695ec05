"""Comparing tables: origin rows with their target rows, and two snapshots with each other."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.convert import Codecs, convert
from tidemark.operators.mapping import quoted
from tidemark.operators.merge import of, same_keys

#: The outcomes, and the words of the mismatch texts in ``detail``, which tools that read the log look for.
REDACTED = "<redacted>"
VALID, MISSING, MISMATCH, SKIPPED, ERROR = "VALID", "MISSING", "MISMATCH", "SKIPPED", "ERROR"


def canonical(c: Column, kind: T.DataType, metadata: dict | None = None, strict_empty: bool = False) -> Column:
    """A form in which equal values are equal: map entries and sets sorted, times in milliseconds, empty collections as null."""
    if isinstance(kind, T.MapType):
        c = F.array_sort(F.map_entries(c))
    elif isinstance(kind, T.ArrayType) and (metadata or {}).get("set"):
        c = F.array_sort(F.array_distinct(c))
    elif isinstance(kind, T.TimestampType | T.TimestampNTZType):
        c = F.unix_millis(c.cast("timestamp"))
    if isinstance(kind, T.ArrayType | T.MapType) and not strict_empty:
        c = F.when(F.size(c) > 0, c)
    return c


def shown(c: Column, kind: T.DataType) -> Column:
    if isinstance(kind, T.StringType):
        return c
    if isinstance(kind, T.BinaryType):
        return F.hex(c)
    return F.to_json(c) if isinstance(kind, T.ArrayType | T.MapType | T.StructType) else c.cast("string")


def difference(name: str, origin: Column, target: Column, origin_field: T.StructField, target_field: T.StructField, codecs: Codecs | None = None, strict_empty: bool = False, hook: Callable[[Column, Column], Column] | None = None) -> Column:
    """struct(column, origin, target, error), or null if the values are equal. The target is converted, not the origin."""
    back = convert(target, target_field.dataType, origin_field.dataType, codecs or Codecs(), origin_field.metadata)
    failed = F.lit(False) if back.failed is None else F.coalesce(back.failed, F.lit(False))
    form = lambda c: canonical(c, origin_field.dataType, origin_field.metadata, strict_empty)
    equal = form(origin).eqNullSafe(form(back.value)) if hook is None else F.coalesce(hook(origin, target), F.lit(False))
    differs = failed | ~equal
    return F.when(
        differs,
        F.struct(F.lit(name).alias("column"), shown(origin, origin_field.dataType).alias("origin"), shown(target, target_field.dataType).alias("target"), F.when(failed, F.lit(back.rule)).alias("error")),
    )


NO_DIFFERENCES = "array<struct<column:string,origin:string,target:string,error:string>>"


def compared(origin: DataFrame, target: DataFrame, key: list[str], columns: list[str], codecs: Codecs | None = None, only_if_target_null: list[str] | None = None, strict_empty: bool = False, hooks: dict[str, Callable[[Column, Column], Column]] | None = None, how: str = "left") -> DataFrame:
    """Origin rows w joined to target rows t by key, with ``outcome`` (null: the target only) and ``_listed``, the differences.

    ``hooks``: by column, a user's test of (origin, target) for being equal."""
    w = origin.withColumn("_read", F.lit(True))
    both = w.alias("w").join(target.withColumn("_found", F.lit(True)).alias("t"), same_keys(key, "w", "t"), how)
    found = []
    for c in columns:
        d = difference(c, of("w", c), of("t", c), origin.schema[c], target.schema[c], codecs, strict_empty, (hooks or {}).get(c))
        found.append(F.when(of("t", c).isNull(), d) if c in (only_if_target_null or []) else d)
    listed = F.array_compact(F.array(*found)) if found else F.array().cast(NO_DIFFERENCES)
    failed = F.size("w._errors") > 0 if "_errors" in origin.columns else F.lit(False)
    outcome = F.when(F.col("w._read").isNull(), F.lit(None)).when(failed, ERROR).when(F.col("t._found").isNull(), MISSING).when(F.size("_listed") > 0, MISMATCH).otherwise(VALID)
    return both.withColumn("_listed", listed).withColumn("outcome", outcome)


def validated(both: DataFrame, key: list[str], keep: list[str] | None = None) -> DataFrame:
    """The origin rows of a comparison: key, ``keep``, outcome and differences."""
    names = list(dict.fromkeys([*key, *(keep or [])]))
    rows = both.where("outcome is not null").select(*(of("w", k).alias(k) for k in names), "outcome", "_listed")
    return rows.select(*map(quoted, names), "outcome", F.when(F.col("outcome") == MISMATCH, F.col("_listed")).otherwise(F.array().cast(NO_DIFFERENCES)).alias("differences"))


def validate(origin: DataFrame, target: DataFrame, key: list[str], columns: list[str] | None = None, codecs: Codecs | None = None, keep: list[str] | None = None, only_if_target_null: list[str] | None = None, strict_empty: bool = False, hooks: dict[str, Callable[[Column, Column], Column]] | None = None) -> DataFrame:
    """Origin rows with ``outcome`` (VALID, MISSING, MISMATCH, ERROR if ``_errors`` has any) and ``differences``.

    Each side's columns are read once; rows that stand in the target only aren't reported. The target's keys must be unique, as a
    keyed table's are (the jobs check it)."""
    columns = [c for c in target.columns if c in origin.columns and c not in key] if columns is None else columns
    own = origin.select(*map(quoted, dict.fromkeys([*key, *columns, *(keep or []), *(["_errors"] if "_errors" in origin.columns else [])])))
    return validated(compared(own, target.select(*map(quoted, [*key, *columns])), key, columns, codecs, only_if_target_null, strict_empty, hooks), key, keep)


def keys_only(origin: DataFrame, target: DataFrame, key: list[str]) -> DataFrame:
    """Key and outcome VALID or MISSING; only key columns are read, and each side once."""
    o, t = origin.select(*map(quoted, key)), target.select(*map(quoted, key)).distinct().withColumn("_found", F.lit(True))
    both = o.alias("o").join(t.alias("t"), same_keys(key, "o", "t"), "left")
    return both.select(*(of("o", k).alias(k) for k in key), F.when(F.col("t._found").isNull(), MISSING).otherwise(VALID).alias("outcome"))


def detail(differences: Column) -> Column:
    """The mismatch text, values redacted, in column order."""
    def one(d: Column) -> Column:
        return (
            F.when(d["error"].isNotNull(), F.format_string("Target column:%s Exception %s; ", d["column"], d["error"]))
            .when(d["origin"].isNull(), F.format_string(f"Target column:%s origin is null, target is {REDACTED}; ", d["column"]))
            .when(d["target"].isNull(), F.format_string(f"Target column:%s-origin[{REDACTED}]-target[null]; ", d["column"]))
            .otherwise(F.format_string(f"Target column:%s-origin[{REDACTED}]-target[{REDACTED}]; ", d["column"]))
        )

    return F.array_join(F.transform(differences, one), "")


def snapshot_diff(a: DataFrame, b: DataFrame, key: list[str], columns: list[str] | None = None, exclude: list[str] | None = None, ttl_within: int = 0) -> DataFrame:
    """One row per difference of two snapshots: key, kind (only_in_a, only_in_b, value, writetime, ttl), column, a, b.

    Rows that one side lacks give one row; side columns c__wt and c__ttl are compared as such, TTLs with a tolerance."""
    shared = [c for c in a.columns if c in b.columns and c not in key and c not in (exclude or [])]
    columns = shared if columns is None else columns
    both = a.withColumn("_in", F.lit(True)).alias("a").join(b.withColumn("_in", F.lit(True)).alias("b"), same_keys(key, "a", "b"), "full_outer")
    found = []
    for c in columns:
        x, y = of("a", c), of("b", c)
        kind = "writetime" if c.endswith("__wt") else "ttl" if c.endswith("__ttl") else "value"
        if kind == "ttl":
            differs = (x.isNull() != y.isNull()) | F.coalesce(F.abs(x - y) > ttl_within, F.lit(False))
        else:
            differs = ~canonical(x, a.schema[c].dataType, a.schema[c].metadata, True).eqNullSafe(canonical(y, b.schema[c].dataType, b.schema[c].metadata, True))
        found.append(F.when(differs, F.struct(F.lit(kind).alias("kind"), F.lit(c).alias("column"), shown(x, a.schema[c].dataType).alias("a"), shown(y, b.schema[c].dataType).alias("b"))))
    lone = lambda kind: F.array(F.struct(F.lit(kind).alias("kind"), F.lit(None).cast("string").alias("column"), F.lit(None).cast("string").alias("a"), F.lit(None).cast("string").alias("b")))
    listed = F.when(F.col("b._in").isNull(), lone("only_in_a")).when(F.col("a._in").isNull(), lone("only_in_b")).otherwise(F.array_compact(F.array(*found)))
    keyed = both.select(*(F.coalesce(of("a", k), of("b", k)).alias(k) for k in key), F.explode(listed).alias("d"))
    return keyed.select(*map(quoted, key), "d.kind", "d.column", "d.a", "d.b")


def corrections(origin: DataFrame, validated: DataFrame, key: list[str], missing: bool, mismatch: bool) -> DataFrame:
    """The origin rows to write again: those that are missing or that differ. Nothing is ever deleted."""
    wanted = [o for o, on in ((MISSING, missing), (MISMATCH, mismatch)) if on]
    return origin.join(validated.where(F.col("outcome").isin(*wanted)).select(*map(quoted, key)), key, "left_semi")


def all_keys(a: DataFrame, b: DataFrame, key: list[str]) -> DataFrame:
    """The keys of both snapshots, each with where it stands."""
    columns = list(map(quoted, key))
    both = a.select(*columns, F.lit(1).alias("_side")).unionByName(b.select(*columns, F.lit(2).alias("_side")))
    return both.groupBy(*columns).agg(F.bit_or("_side").alias("_sides")).select(*columns, (F.col("_sides").bitwiseAND(1) > 0).alias("in_a"), (F.col("_sides").bitwiseAND(2) > 0).alias("in_b"))


def capped(differences: DataFrame, key: list[str], most: int = 100) -> DataFrame:
    """The first differences by key and column, each with the number of all. Only ``most`` rows of each task meet in one."""
    total = differences.agg(F.lit(1).alias("_one"), F.count("*").alias("n_differences"))
    shown_rows = differences.orderBy(*map(quoted, key), "column").limit(most).withColumn("_one", F.lit(1))
    return shown_rows.join(total, "_one").drop("_one")


def complete(counted: Column, expected: Column, stored: Column) -> Column:
    """Whether a job's own count, the expected one and an independent count of the target agree."""
    return (counted == expected) & (expected == stored)
