"""Column conversions between two schemas.

A conversion is planned once for a pair of types and becomes one Spark expression with an error flag: a value that can't be
converted is an error of its row, never a silent null. Numbers in text aren't trimmed, except for doubles.
"""

from __future__ import annotations

import decimal
import ipaddress
import re
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

INTEGER = r"^[+-]?[0-9]+$"
DECIMAL = r"^[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]+)?$"


@dataclass
class Converted:
    """A converted column: its value, whether it failed (None: it can't), and the rule's name."""

    value: Column
    failed: Column | None
    rule: str
    both: Column | None = None  # struct(v, f) of value and failed, where they come of one expression

    def packed(self) -> Column:
        false = F.lit(False)
        return self.both if self.both is not None else F.struct(self.value.alias("v"), (false if self.failed is None else F.coalesce(self.failed, false)).alias("f"))

    @classmethod
    def unpacked(cls, both: Column, rule: str) -> Converted:
        return cls(both["v"], both["f"], rule, both)


def bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is worked out once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


Builder = Callable[[Column], Column]


class Codecs:
    """Conversions by (from, to) type and name; users add their own, and two for one pair are an error."""

    def __init__(self) -> None:
        self.builders: dict[tuple[str, str], tuple[str, Builder]] = {}

    def add(self, name: str, source: str, target: str, build: Builder) -> None:
        if (source, target) in self.builders:
            raise ValueError(f"{self.builders[source, target][0]} and {name} both convert {source} to {target}")
        self.builders[source, target] = name, build

    def find(self, source: T.DataType, target: T.DataType) -> tuple[str, Builder] | None:
        kind = lambda t: "decimal" if isinstance(t, T.DecimalType) else t.simpleString()
        return self.builders.get((kind(source), kind(target)))


def guarded(pattern: str, cast: str) -> Builder:
    return lambda c: F.when(c.rlike(pattern), c.try_cast(cast))


def shortest(c: Column) -> Column:
    """The shortest decimal that reads back as the double, with an exponent where it has one.

    Java up to 18 may write digits too many (5.903020000000001E20 for 5.90302e20), so 15 digits are tried first, then 16. Of
    several decimals of 16 digits that all read back, Java's choice stays."""
    rounded = (F.call_function("format_number", c, F.lit(f"0.{'#' * digits}E0")) for digits in (14, 15))
    return F.coalesce(*(F.when(text.try_cast("double") == c, text) for text in rounded), c.cast("string"))


def double_text(c: Column) -> Column:
    """Up to 9 fraction digits, rounded towards minus infinity, without grouping or exponent."""

    def digits(text: Column) -> Column:
        # a double has 17 digits at most: each of these types holds them all
        exact = F.when(F.abs(c) < 1, F.floor(text.try_cast("decimal(38,25)"), F.lit(9))).otherwise(F.floor(text.try_cast("decimal(38,18)"), F.lit(9)))
        plain = F.regexp_replace(F.regexp_replace(exact.cast("string"), r"(\.[0-9]*?)0+$", "$1"), r"\.$", "")
        places = F.regexp_extract(text, r"E([0-9]+)$", 1).cast("int") + 1
        large = F.concat(F.when(c < 0, "-").otherwise(""), F.rpad(F.regexp_replace(F.regexp_replace(text, "E.*", ""), r"[-.]", ""), places, "0"))
        return F.when(F.abs(c) >= 1e19, large).otherwise(plain)

    return (
        F.when(F.isnan(c), "NaN")
        .when(c == float("inf"), "∞")
        .when(c == float("-inf"), "-∞")
        .when((c == 0.0) & c.cast("string").startswith("-"), "-0")
        .when((c < 0) & (c > -1e-9), "-0.000000001")
        .when((c >= 0) & (c < 1e-9), "0")
        .otherwise(bound(shortest(c), digits))
    )


def text_double(c: Column) -> Column:
    text = F.trim(c)
    return F.when(text == "NaN", F.lit(float("nan"))).when(text == "∞", F.lit(float("inf"))).when(text == "-∞", F.lit(float("-inf"))).when(text.rlike(DECIMAL), text.try_cast("double"))


def low_64_bits(c: Column) -> Column:
    """The low 64 bits of a wide integer, as a signed number."""
    span = F.lit("18446744073709551616").cast("decimal(38,0)")
    rest = F.pmod(c, span)
    return F.when(rest >= F.lit("9223372036854775808").cast("decimal(38,0)"), rest - span).otherwise(rest).cast("long")


def pattern_problem(pattern: str) -> str | None:
    """Why a date pattern can't be used, or None."""
    plain = re.sub(r"'[^']*'", "", pattern)
    if not pattern:
        return "the timestamp format is empty"
    if bad := sorted(set(re.findall(r"[A-Za-z]", plain)) - set("yuMdHhmsSa")):
        return f"the timestamp format has unknown letters: {''.join(bad)}"
    return "months are written in digits only" if "MMM" in plain else None


def builtin(names: frozenset[str], timestamp_format: str | None = None, zone: str = "UTC") -> Codecs:
    """The conversions of these names: INT_STRING, BIGINT_STRING, DOUBLE_STRING, DECIMAL_STRING, BIGINT_BIGINTEGER, STRING_BLOB,
    ASCII_BLOB, TIMESTAMP_STRING_MILLIS, TIMESTAMP_STRING_FORMAT."""
    found = Codecs()
    text: Builder = lambda c: c.cast("string")
    if "INT_STRING" in names:
        found.add("INT_STRING", "int", "string", text)
        found.add("INT_STRING", "string", "int", guarded(INTEGER, "int"))
    if "BIGINT_STRING" in names:
        found.add("BIGINT_STRING", "bigint", "string", text)
        found.add("BIGINT_STRING", "string", "bigint", guarded(INTEGER, "bigint"))
    if "DOUBLE_STRING" in names:
        found.add("DOUBLE_STRING", "double", "string", double_text)
        found.add("DOUBLE_STRING", "string", "double", text_double)
    if "DECIMAL_STRING" in names:
        found.add("DECIMAL_STRING", "decimal", "string", text)
        found.add("DECIMAL_STRING", "string", "decimal", guarded(DECIMAL, "decimal(38,18)"))
    if "BIGINT_BIGINTEGER" in names:
        found.add("BIGINT_BIGINTEGER", "bigint", "decimal", lambda c: c.cast("decimal(38,0)"))
        found.add("BIGINT_BIGINTEGER", "decimal", "bigint", low_64_bits)
    if "STRING_BLOB" in names:
        found.add("STRING_BLOB", "string", "binary", lambda c: F.encode(c, "UTF-8"))
        found.add("STRING_BLOB", "binary", "string", lambda c: F.try_validate_utf8(c.cast("string")))
    elif "ASCII_BLOB" in names:
        found.add("ASCII_BLOB", "string", "binary", lambda c: F.encode(c, "UTF-8"))
        found.add("ASCII_BLOB", "binary", "string", lambda c: F.when(F.try_validate_utf8(c.cast("string")).rlike(r"\A[\x00-\x7F]*\z"), c.cast("string")))
    if "TIMESTAMP_STRING_MILLIS" in names:
        found.add("TIMESTAMP_STRING_MILLIS", "timestamp", "string", lambda c: F.unix_millis(c).cast("string"))
        found.add("TIMESTAMP_STRING_MILLIS", "string", "timestamp", lambda c: F.timestamp_millis(F.when(c.rlike(INTEGER), c.try_cast("bigint"))))
    if "TIMESTAMP_STRING_FORMAT" in names:
        if problem := pattern_problem(timestamp_format or ""):
            raise ValueError(problem)
        found.add("TIMESTAMP_STRING_FORMAT", "timestamp", "string", lambda c: F.date_format(F.from_utc_timestamp(c, zone), timestamp_format))
        found.add("TIMESTAMP_STRING_FORMAT", "string", "timestamp", lambda c: F.to_utc_timestamp(F.try_to_timestamp(c, F.lit(timestamp_format)), zone))
    return found


def same(a: T.DataType, b: T.DataType) -> bool:
    """Equal but for nullability and field metadata."""
    if isinstance(a, T.ArrayType) and isinstance(b, T.ArrayType):
        return same(a.elementType, b.elementType)
    if isinstance(a, T.MapType) and isinstance(b, T.MapType):
        return same(a.keyType, b.keyType) and same(a.valueType, b.valueType)
    if isinstance(a, T.StructType) and isinstance(b, T.StructType):
        return len(a) == len(b) and all(x.name == y.name and same(x.dataType, y.dataType) for x, y in zip(a, b, strict=True))
    return a == b


def positional(t: T.StructType) -> bool:
    return all(f.name == f"_{n}" for n, f in enumerate(t.fields, 1))


def convert(c: Column, source: T.DataType, target: T.DataType, codecs: Codecs, metadata: dict | None = None, unsupported: str = "error") -> Converted:
    """The column as the target type. ``metadata``: the target field's (set, dimensions). ``unsupported``: error, or cast."""
    metadata = metadata or {}
    if metadata.get("dimensions") and isinstance(target, T.ArrayType):
        inner = convert_array(c, source, target, codecs, False, unsupported)
        wrong = c.isNotNull() & (F.size(c) != metadata["dimensions"])
        return Converted(inner.value, wrong if inner.failed is None else inner.failed | wrong, "vector")
    if metadata.get("set") and isinstance(source, T.ArrayType) and isinstance(target, T.ArrayType):
        return convert_array(c, source, target, codecs, True, unsupported)
    if same(source, target):
        return Converted(c, None, "passthrough")
    if found := codecs.find(source, target):
        name, build = found
        value = build(c)
        value = value.try_cast(target) if isinstance(target, T.DecimalType) else value
        return Converted(value, c.isNotNull() & value.isNull(), name)
    if isinstance(source, T.ArrayType) and isinstance(target, T.ArrayType):
        return convert_array(c, source, target, codecs, False, unsupported)
    if isinstance(source, T.MapType) and isinstance(target, T.MapType):
        k = lambda e: convert(e["key"], source.keyType, target.keyType, codecs, unsupported=unsupported).packed()
        v = lambda e: convert(e["value"], source.valueType, target.valueType, codecs, unsupported=unsupported).packed()

        def collected(entries: Column) -> Column:
            keys = F.transform(entries, lambda e: e["k"]["v"])
            # keys that become equal, or null, are an error of the row
            bad = F.exists(entries, lambda e: e["k"]["f"] | e["v"]["f"]) | F.exists(keys, lambda x: x.isNull()) | (F.size(F.array_distinct(keys)) < F.size(keys))
            return bound(F.coalesce(bad, F.lit(False)), lambda b: F.struct(F.when(~b, F.map_from_entries(F.transform(entries, lambda e: F.struct(e["k"]["v"].alias("key"), e["v"]["v"].alias("value"))))).alias("v"), b.alias("f")))

        return Converted.unpacked(bound(F.transform(F.map_entries(c), lambda e: F.struct(k(e).alias("k"), v(e).alias("v"))), collected), "map")
    if isinstance(source, T.StructType) and isinstance(target, T.StructType) and len(source) == len(target):
        by_name = set(source.names) == set(target.names) and not positional(target)
        own = [source[f.name] if by_name else source.fields[n] for n, f in enumerate(target.fields)]
        fields = lambda x: F.struct(x.isNull().alias("none"), *(convert(x[o.name], o.dataType, f.dataType, codecs, unsupported=unsupported).packed().alias(f"p{n}") for n, (o, f) in enumerate(zip(own, target.fields, strict=True))))

        def rebuilt(p: Column) -> Column:
            value = F.when(~p["none"], F.struct(*(p[f"p{n}"]["v"].alias(f.name) for n, f in enumerate(target.fields))))
            return F.struct(value.alias("v"), any_of(*(p[f"p{n}"]["f"] for n in range(len(own)))).alias("f"))

        return Converted.unpacked(bound(bound(c, fields), rebuilt), "struct")
    if unsupported == "cast":
        value = c.try_cast(target)
        return Converted(value, c.isNotNull() & value.isNull(), "cast")
    raise TypeError(f"no conversion from {source.simpleString()} to {target.simpleString()}")


def any_of(*flags: Column | None) -> Column:
    found = F.lit(False)
    for flag in flags:
        if flag is not None:
            found = found | F.coalesce(flag, F.lit(False))
    return found


def convert_array(c: Column, source: T.ArrayType, target: T.ArrayType, codecs: Codecs, distinct: bool, unsupported: str) -> Converted:
    rule = "set" if distinct else "list"
    if same(source.elementType, target.elementType):
        return Converted(F.array_sort(F.array_distinct(c)) if distinct else c, None, rule)
    each = lambda e: convert(e, source.elementType, target.elementType, codecs, unsupported=unsupported).packed()

    def collected(p: Column) -> Column:
        value = F.transform(p, lambda e: e["v"])
        return F.struct((F.array_sort(F.array_distinct(value)) if distinct else value).alias("v"), F.coalesce(F.exists(p, lambda e: e["f"]), F.lit(False)).alias("f"))

    return Converted.unpacked(bound(F.transform(c, each), collected), rule)


# Dates and times of a range, by precision


UNITS = ("year", "month", "day", "hour", "minute", "second", "millisecond")
BOUND = r"^(-?\d{4,})(?:-(\d\d)(?:-(\d\d)(?:T(\d\d)(?::(\d\d)(?::(\d\d)(?:\.(\d{1,3}))?)?)?)?)?)?Z?$"
BETWEEN = r"^\[(\S+) TO (\S+)\]$"


def range_bounds(texts: Column) -> Column:
    """For each text such as 2024, 2024-02 or 2024-02-03T04:05:06.789Z: its first and last millisecond and the number of its unit
    (0: year). Each step is bound to a name by ``transform``, so that no expression is written out twice."""

    def start(p: Column) -> Column:
        number = lambda n, default: F.coalesce(F.nullif(p[n], F.lit("")).try_cast("int"), F.lit(default))
        unit = F.size(F.filter(F.slice(p, 2, 6), lambda x: x != ""))
        at = F.try_make_timestamp_ltz(number(0, 1970), number(1, 1), number(2, 1), number(3, 0), number(4, 0), number(5, 0).cast("decimal(8,6)"))
        millis = F.coalesce(F.rpad(F.nullif(p[6], F.lit("")), 3, "0").try_cast("int"), F.lit(0))
        return F.struct(F.when(p[0] != "", F.unix_millis(at) + millis).alias("first"), unit.alias("unit"))

    def whole(b: Column) -> Column:
        month = F.add_months(F.timestamp_millis(b["first"]), F.when(b["unit"] == 0, 12).otherwise(1))
        step = F.element_at(F.array(*map(F.lit, (86_400_000, 3_600_000, 60_000, 1000, 1))), F.greatest(b["unit"] - 1, F.lit(1)))
        after = F.when(b["unit"] <= 1, F.unix_millis(F.trunc(month, "month").cast("timestamp"))).otherwise(b["first"] + step)
        return F.struct(b["first"].alias("first"), (after - 1).alias("last"), F.element_at(F.array(*map(F.lit, UNITS)), b["unit"] + 1).alias("unit"))

    parts = F.transform(texts, lambda t: F.array(*(F.regexp_extract(t, BOUND, n) for n in range(1, 8))))
    return F.transform(F.transform(parts, start), whole)


def date_range(text: Column) -> Column:
    """A date range as struct(kind, lower_ms, lower_prec, upper_ms, upper_prec); null if the text is none.

    Kinds: single date, closed, open at the top, open at the bottom, single open (*), open on both sides."""
    low, high = F.regexp_extract(text, BETWEEN, 1), F.regexp_extract(text, BETWEEN, 2)
    texts = F.array(F.when(low == "", text).otherwise(low), high)

    def build(x: Column) -> Column:
        lower, upper = x["bounds"][0], x["bounds"][1]
        closed, low_open, high_open = x["texts"][1] != "", x["texts"][0] == "*", x["texts"][1] == "*"
        has_low, has_high = lower["first"].isNotNull(), upper["first"].isNotNull()
        kind = (
            F.when(~closed & low_open, "single_open")
            .when(~closed & has_low, "single")
            .when(closed & low_open & high_open, "open")
            .when(closed & low_open & has_high, "open_low")
            .when(closed & high_open & has_low, "open_high")
            .when(closed & has_low & has_high, "closed")
        )
        return F.struct(kind.alias("kind"), lower["first"].alias("lower_ms"), F.when(has_low, lower["unit"]).alias("lower_prec"), F.when(has_high, upper["last"]).alias("upper_ms"), F.when(has_high, upper["unit"]).alias("upper_prec"))

    bound = F.transform(F.array(texts), lambda t: F.struct(t.alias("texts"), range_bounds(t).alias("bounds")))
    return F.get(F.filter(F.transform(bound, build), lambda r: r["kind"].isNotNull()), F.lit(0))


#: How a bound of each precision is written.
FORMS = {"year": "yyyy", "month": "yyyy-MM", "day": "yyyy-MM-dd", "hour": "yyyy-MM-dd'T'HH'Z'", "minute": "yyyy-MM-dd'T'HH:mm'Z'", "second": "yyyy-MM-dd'T'HH:mm:ss'Z'", "millisecond": "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"}


def date_range_text(r: Column) -> Column:
    """The text of a date range as ``date_range`` gives it."""
    def written(ms: Column, unit: Column) -> Column:
        return F.coalesce(*(F.when(unit == name, F.date_format(F.timestamp_millis(ms), form)) for name, form in FORMS.items()), F.lit("*"))

    def text(r: Column) -> Column:
        low, high = written(r["lower_ms"], r["lower_prec"]), written(r["upper_ms"], r["upper_prec"])
        return F.when(r["kind"].isin("single", "single_open"), low).when(r["kind"].isNotNull(), F.concat(F.lit("["), low, F.lit(" TO "), high, F.lit("]")))

    return bound(r, text)


# Literals of constant columns, parsed on the driver, one per job


def literal(text: str, target: T.DataType) -> Column:
    """A constant column's value: strings in single quotes (UUIDs, addresses and times of day without), blobs as 0x..., collections in brackets; ``null``; else by type."""
    text = text.strip()
    return F.lit(None).cast(target) if text.lower() == "null" else _literal(text, target).cast(target)


def _split(text: str) -> list[str]:
    parts, depth, quoted, last = [], 0, False, 0
    for n, c in enumerate(text):
        quoted ^= c == "'"
        if not quoted:
            depth += (c in "[{(") - (c in "]})")
            if c == "," and depth == 0:
                parts.append(text[last:n])
                last = n + 1
    parts.append(text[last:])
    return [p.strip() for p in parts if p.strip()]


def is_address(text: str) -> bool:
    try:
        ipaddress.ip_address(text)
    except ValueError:
        return False
    return True


def _literal(text: str, target: T.DataType) -> Column:
    quoted = len(text) > 1 and text[0] == text[-1] == "'"
    if isinstance(target, T.StringType):
        if not quoted and (time := re.fullmatch(r"(\d\d):(\d\d):(\d\d)(\.\d{1,9})?", text)):
            if int(time[1]) > 23 or int(time[2]) > 59 or int(time[3]) > 59:
                raise ValueError(f"not a time of day: {text}")
            return F.lit(text)
        if not quoted and is_address(text):
            return F.lit(str(ipaddress.ip_address(text)))
        if not quoted and not re.fullmatch(r"[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}", text):
            raise ValueError(f"text constants stand in single quotes: {text}")
        return F.lit(text[1:-1].replace("''", "'") if quoted else text.lower())
    if isinstance(target, T.BinaryType):
        if not re.fullmatch(r"0[xX]([0-9a-fA-F]{2})*", text):
            raise ValueError(f"not a blob: {text}")
        return F.lit(bytes.fromhex(text[2:]))
    if isinstance(target, T.BooleanType):
        if text.lower() not in ("true", "false"):
            raise ValueError(f"not a boolean: {text}")
        return F.lit(text.lower() == "true")
    if isinstance(target, T.IntegralType | T.DecimalType):
        if not re.fullmatch(INTEGER if isinstance(target, T.IntegralType) else DECIMAL, text):
            raise ValueError(f"not a {target.simpleString()}: {text}")
        limits = {"tinyint": 7, "smallint": 15, "int": 31, "bigint": 63}
        if (bits := limits.get(target.simpleString())) and not -(1 << bits) <= int(text) < 1 << bits:
            raise ValueError(f"{text} is out of range for {target.simpleString()}")
        if isinstance(target, T.DecimalType) and abs(int(decimal.Decimal(text))) >= 10 ** (target.precision - target.scale):
            raise ValueError(f"{text} is out of range for {target.simpleString()}")
        return F.lit(text)
    if isinstance(target, T.FractionalType):
        return F.lit(float(text))
    if isinstance(target, T.TimestampType):
        if re.fullmatch(INTEGER, text):
            return F.timestamp_millis(F.lit(int(text)))
        return F.lit(text.strip("'"))
    if isinstance(target, T.DateType):
        return F.lit(text.strip("'"))
    body = text[1:-1]
    if isinstance(target, T.ArrayType) and text[:1] + text[-1:] in ("[]", "{}"):
        return F.array(*(_literal(p, target.elementType).cast(target.elementType) for p in _split(body)))
    if isinstance(target, T.MapType) and text[:1] + text[-1:] == "{}":
        pairs = [re.match(r"('(?:[^']|'')*'|[^:]+):(.*)", p).groups() for p in _split(body)]
        return F.create_map(*(x for k, v in pairs for x in (_literal(k.strip(), target.keyType).cast(target.keyType), _literal(v.strip(), target.valueType).cast(target.valueType))))
    if isinstance(target, T.StructType) and text[:1] + text[-1:] == "()":
        parts = _split(body)
        if len(parts) > len(target):
            raise ValueError(f"too many elements: {text}")
        return F.struct(*((_literal(parts[n], f.dataType) if n < len(parts) else F.lit(None)).cast(f.dataType).alias(f.name) for n, f in enumerate(target.fields)))
    raise ValueError(f"constants of type {target.simpleString()} are not supported")
