"""Seeded rows for any schema: the same seed gives the same rows on any cluster."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.tokens import hashed


def value(kind: T.DataType, seed: Column, name: str, most: int = 4) -> Column:
    """A value of the type from the seed column; collections have up to ``most`` elements."""
    h = hashed(seed, F.lit(name))
    if isinstance(kind, T.StringType):
        return F.substring(F.md5(h.cast("string")), 1, F.pmod(h, F.lit(24)).cast("int") + 1)
    if isinstance(kind, T.BinaryType):
        return F.encode(F.substring(F.md5(h.cast("string")), 1, 12), "UTF-8")
    if isinstance(kind, T.BooleanType):
        return F.pmod(h, F.lit(2)) == 1
    if isinstance(kind, T.IntegralType):
        bits = {"tinyint": 7, "smallint": 15, "int": 31, "bigint": 62}[kind.simpleString()]
        return (F.pmod(h, F.lit(1 << min(bits + 1, 62))) - F.lit(1 << min(bits, 61))).cast(kind)
    if isinstance(kind, T.DecimalType):
        return (F.pmod(h, F.lit(10 ** min(kind.precision, 15))) / F.lit(10**kind.scale)).cast(kind)
    if isinstance(kind, T.FractionalType):
        return ((h / F.lit(float(1 << 60)) - 0.5) * 1e6).cast(kind)
    if isinstance(kind, T.TimestampType):
        return F.timestamp_millis(F.pmod(h, F.lit(4_102_444_800_000)))
    if isinstance(kind, T.DateType):
        return F.date_add(F.lit("1970-01-01").cast("date"), F.pmod(h, F.lit(40_000)).cast("int"))
    places = F.sequence(F.lit(1), F.lit(most))
    if isinstance(kind, T.ArrayType):
        return F.slice(F.transform(places, lambda n: value(kind.elementType, hashed(h, n), "element", most)), F.lit(1), F.pmod(h, F.lit(most + 1)).cast("int"))
    if isinstance(kind, T.MapType):
        entries = F.transform(places, lambda n: F.struct(value(kind.keyType, hashed(h, n), "key", most).alias("key"), value(kind.valueType, hashed(h, n), "value", most).alias("value")))
        distinct = F.filter(F.transform(entries, lambda e, n: F.when(~F.exists(F.slice(entries, F.lit(1), n), lambda f: f["key"] == e["key"]), e)), lambda e: e.isNotNull())
        return F.map_from_entries(distinct)
    if isinstance(kind, T.StructType):
        return F.struct(*(value(f.dataType, h, f.name, most).alias(f.name) for f in kind.fields))
    raise TypeError(f"no generator for {kind.simpleString()}")


def rows(ids: DataFrame, id_col: str, schema: T.StructType, key: list[str], seed: int = 0, null_percent: int = 10, most: int = 4) -> DataFrame:
    """One row per id. Key columns are never null; others are in ``null_percent`` of the rows."""
    base = hashed(F.col(id_col), F.lit(seed))
    out = []
    for f in schema.fields:
        v = value(f.dataType, base, f.name, most)
        if f.name not in key:
            v = F.when(F.pmod(hashed(base, F.lit(f.name + "?")), F.lit(100)) >= null_percent, v)
        out.append(v.cast(f.dataType).alias(f.name))
    return ids.select(*out)


def edges(df: DataFrame, schema: T.StructType, key: list[str]) -> DataFrame:
    """The rows with one whose other columns are null and one whose texts and collections are empty (keys from two first rows)."""
    two = df.select(*key).orderBy(*key).limit(2).withColumn("_n", F.monotonically_increasing_id())
    empty = {"string": F.lit(""), "binary": F.lit(b"")}
    null_row = two.where("_n = 0").select(*(F.col(f.name) if f.name in key else F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields))
    blank = lambda f: F.array().cast(f.dataType) if isinstance(f.dataType, T.ArrayType) else F.create_map().cast(f.dataType) if isinstance(f.dataType, T.MapType) else empty.get(f.dataType.simpleString(), F.lit(None).cast(f.dataType))
    empty_row = two.where("_n = 1").select(*(F.col(f.name) if f.name in key else blank(f).alias(f.name) for f in schema.fields))
    return df.unionByName(null_row).unionByName(empty_row)


#: Values at the edges of the types: the ends, the neighbours of zero, what engines write or read in ways of their own.
EDGES = {
    "boolean": [True, False],
    "tinyint": [-128, -1, 0, 1, 127],
    "smallint": [-32768, -1, 0, 1, 32767],
    "int": [-(1 << 31), -1, 0, 1, (1 << 31) - 1],
    "bigint": [-(1 << 63), -1, 0, 1, (1 << 53) + 1, (1 << 63) - 1],
    "float": [0.0, -1.5, 3.4028234663852886e38, float("nan"), float("inf")],
    "double": [0.0, -0.1, 1.7976931348623157e308, 5e-324, float("nan"), float("-inf")],
    "string": ["", " ", "\u00e9", "\U0001f600", "a'b\"c", "x\ty\nz", "NULL", "0"],
    "binary": [b"", b"\x00", b"\xff\xfe", b"text"],
    "timestamp": ["1970-01-01 00:00:00", "0001-01-01 00:00:00", "9999-12-31 23:59:59.999", "2024-02-29 12:00:00.001"],
    "date": ["1970-01-01", "0001-01-01", "9999-12-31", "2024-02-29"],
}


def edge(kind: T.DataType, number: Column) -> Column:
    """The edge value of this number (counted round) of a type; of nested types, values that hold their parts' edges."""
    if isinstance(kind, T.DecimalType):
        nines = "9" * (kind.precision - kind.scale) + ("." + "9" * kind.scale if kind.scale else "")
        values = [F.lit(x).cast(kind) for x in (nines, "-" + nines, "0", "1")]
    elif isinstance(kind, T.ArrayType):
        values = [F.array().cast(kind), F.array(edge(kind.elementType, number)).cast(kind), F.array(edge(kind.elementType, number), edge(kind.elementType, number + 1)).cast(kind)]
    elif isinstance(kind, T.MapType):
        values = [F.create_map().cast(kind), F.create_map(edge(kind.keyType, number), edge(kind.valueType, number + 1)).cast(kind)]
    elif isinstance(kind, T.StructType):
        return F.struct(*(edge(f.dataType, number).alias(f.name) for f in kind.fields))
    else:
        values = [F.lit(v).cast(kind) for v in EDGES[kind.simpleString()]]
    return F.get(F.array(*values), F.pmod(number, F.lit(len(values))).cast("int"))


def edge_rows(ids: DataFrame, id_col: str, schema: T.StructType, key: list[str]) -> DataFrame:
    """One row per id, in which every column but the key's holds the edge value of the id's number; the key holds the id."""
    number = F.col(id_col).cast("long")
    return ids.select(*((F.col(id_col) if f.name in key else edge(f.dataType, number)).cast(f.dataType).alias(f.name) for f in schema.fields))
