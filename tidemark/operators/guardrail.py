"""Guardrails: cells whose stored length lies above a limit."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.mapping import quoted

WIDTH = {"boolean": 1, "tinyint": 1, "smallint": 2, "int": 4, "float": 4, "date": 4, "bigint": 8, "double": 8, "timestamp": 8, "timestamp_ntz": 8}


def stored_bytes(c: Column, kind: T.DataType, metadata: dict | None = None) -> Column:
    """The length in which a cell is stored; null has none. Collections carry a count and the length of each element."""
    if isinstance(kind, T.StringType | T.BinaryType):
        return F.octet_length(c).cast("long")
    if isinstance(kind, T.DecimalType):
        digits = F.length(F.regexp_replace(F.abs(c).cast("string"), r"[.]|^0+", ""))
        body = F.greatest(F.ceil((digits * 3.3219280948873626 + 1) / 8), F.lit(1)).cast("long")
        return F.when(c.isNotNull(), body + (4 if kind.scale else 0))
    if isinstance(kind, T.ArrayType):
        if (metadata or {}).get("dimensions"):
            return F.when(c.isNotNull(), F.lit(metadata["dimensions"] * WIDTH[kind.elementType.simpleString()]).cast("long"))
        each = lambda x, e: x + 4 + F.coalesce(stored_bytes(e, kind.elementType), F.lit(0).cast("long"))
        return F.aggregate(c, F.lit(4).cast("long"), each)
    if isinstance(kind, T.MapType):
        each = lambda x, e: x + 8 + F.coalesce(stored_bytes(e["key"], kind.keyType), F.lit(0).cast("long")) + F.coalesce(stored_bytes(e["value"], kind.valueType), F.lit(0).cast("long"))
        return F.aggregate(F.map_entries(c), F.lit(4).cast("long"), each)
    if isinstance(kind, T.StructType):
        parts = [4 + F.coalesce(stored_bytes(c[f.name], f.dataType), F.lit(0).cast("long")) for f in kind.fields]
        return F.when(c.isNotNull(), sum(parts[1:], parts[0]))
    return F.when(c.isNotNull(), F.lit(WIDTH[kind.simpleString()]).cast("long"))


def kilobytes(n: Column) -> Column:
    """Thousands of bytes with up to three digits, trailing zeros dropped."""
    text = F.concat(F.floor(n / 1000).cast("string"), F.lit("."), F.lpad((n % 1000).cast("string"), 3, "0"))
    return F.when(n % 1000 == 0, F.floor(n / 1000).cast("string")).otherwise(F.regexp_replace(text, "0+$", ""))


def oversized(df: DataFrame, limit_kb: float, columns: list[str] | None = None) -> Column:
    """array<struct<column, bytes>> of the cells above the limit (1000 bytes a kilobyte)."""
    if limit_kb <= 0:
        raise ValueError("the guardrail job needs a limit above 0")
    columns = df.columns if columns is None else columns
    sizes = F.array(*(F.struct(F.lit(c).alias("column"), stored_bytes(quoted(c), df.schema[c].dataType, df.schema[c].metadata).alias("bytes")) for c in columns))
    return F.filter(sizes, lambda s: F.coalesce(s["bytes"] > limit_kb * 1000, F.lit(False)))


def report(found: Column) -> Column:
    """The text about oversized cells."""
    return F.concat(F.lit("Large columns (KB): "), F.array_join(F.transform(found, lambda s: F.concat(s["column"], F.lit("("), kilobytes(s["bytes"]), F.lit(")"))), ","))


def findings(df: DataFrame, key: list[str], limit_kb: float) -> DataFrame:
    """Key, outcome (LARGE or VALID), report text, the largest column and its bytes."""
    found = df.select(*map(quoted, key), oversized(df, limit_kb).alias("_found"))
    text = report(F.col("_found"))
    top = F.array_max(F.transform("_found", lambda s: F.struct(s["bytes"].alias("bytes"), s["column"].alias("column"))))
    large = F.size("_found") > 0
    return found.select(*map(quoted, key), F.when(large, "LARGE").otherwise("VALID").alias("outcome"), F.when(large, text).alias("report"), top["column"].alias("largest"), top["bytes"].alias("bytes"))
