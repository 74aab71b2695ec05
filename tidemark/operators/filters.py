"""Row filters. A rejected row is kept with its outcome until it is counted."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.mapping import quoted


def condition(text: str) -> Column:
    """A predicate in SQL; a leading AND is tolerated."""
    words = text.strip().split(None, 1)
    return F.expr(words[1] if len(words) == 2 and words[0].upper() == "AND" else text)


def in_bounds(token: Column, low: int, high: int) -> Column:
    return token.between(low, high)


def covered(token: Column, low: Column, high: Column, percent: int) -> Column:
    """Whether the token lies in the lowest part of its range; the same rows each time."""
    percent = percent if 1 <= percent <= 100 else 100
    width = high.cast("decimal(38,0)") - low.cast("decimal(38,0)")
    quotient = F.floor(width / 100)
    return token <= low.cast("decimal(38,0)") + quotient * percent + F.floor((width - quotient * 100) * percent / 100)


def written_within(writetime: Column, low: int, high: int) -> Column:
    """Rows without a writetime are kept."""
    return writetime.isNull() | writetime.between(low, high)


#: The characters of white space.
WHITE = " \t\n\x0b\x0c\r\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"


def value_differs(column: str, value: str) -> Column:
    return ~F.coalesce(F.lower(F.btrim(quoted(column), F.lit(WHITE))) == value.strip(WHITE).lower(), F.lit(False))


Filter = tuple[str, Column, Column | None]


class FilterChain:
    """Filters in order; the first that rejects a row decides. Users add predicates of their own, each with a second predicate, if
    they like, for rows that it can't decide: these become errors."""

    def __init__(self, filters: list[Filter] | None = None) -> None:
        self.filters = list(filters or [])

    def add(self, name: str, accepts: Column | Callable[[], Column], fails: Column | None = None) -> FilterChain:
        self.filters.append((name, accepts if isinstance(accepts, Column) else accepts(), fails))
        return self

    def mark(self, df: DataFrame, error: Column | None = None) -> DataFrame:
        """``_outcome`` (ERROR, SKIPPED or null) and ``_rejected_by``."""
        false = F.lit(False)
        verdicts = []
        for name, accepts, fails in self.filters:
            error_here = F.coalesce(fails, false) if fails is not None else false
            verdicts.append(F.when(error_here, F.struct(F.lit("ERROR").alias("outcome"), F.lit(name).alias("by"))).when(~F.coalesce(accepts, false), F.struct(F.lit("SKIPPED").alias("outcome"), F.lit(name).alias("by"))))
        first = F.coalesce(*verdicts, F.lit(None).cast("struct<outcome:string,by:string>"))
        failed = F.coalesce(error, false) if error is not None else false
        marked = df.withColumn("_verdict", first)
        return marked.withColumn("_rejected_by", F.col("_verdict.by")).withColumn("_outcome", F.when(failed, "ERROR").otherwise(F.col("_verdict.outcome"))).drop("_verdict")
