"""Mixing sources to target weights, with DataFrame functions only.

Temperature mixing: the sources' token shares p are raised to an exponent a in [0, 1] and normalised. The exponent is found by
bisection: the largest at which the mixture's entropy reaches the target (a part of the highest possible, the log of the number of
sources) or at which the most repeated source reaches the repetition limit, whichever comes first; if the shares themselves reach
the target, a = 1. The least repeated source, the largest, is read once, so no document is left out, and a source of share p is
read (p / p_max) ** (a - 1) times.

These budgets are realised as block permutations: every pass over a source is its own permutation (by a hash of seed, pass and
id), the last pass stops at the source's token budget, and the stream is dealt into blocks in which every source has its share of
tokens, in an order that again is a permutation.

The cumulative sums along a permutation are taken in two levels: sums by ranges of the hash, then within a range. So a source that
holds most rows is spread over ``RANGES`` groups. Rows are placed by their ids' hash or, where a source has an id more than once
(null ids included), by a number of their own in a table, so equal ids neither meet in one group nor go beyond a budget together.
What is broadcast is a table by source, whose row count is checked; beyond ``BROADCAST_SOURCES`` it is joined by a shuffle.

A document's size is its number of words between white space, which stands for its tokens: encoding by a tokenizer's file has no
form in DataFrame functions. The sources' totals are one row; sources are as many as a catalogue's entries, not as documents. A
very long text is one value in one task and is only counted. Null texts have none; a null source is a source of its own.
Documents without words, and sources without any, are read in every full pass. Repeated rows are read as often as they stand.
Input columns other than id, text and source are ignored by ``schedule``, whatever their names, and kept by ``mixed``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import materialise, numbered, quoted, renamed, text_or_empty

RANGES = 4096
HASH_BITS = 60
BROADCAST_SOURCES = 10_000
STEPS = 50


def small(frame: DataFrame) -> DataFrame:
    """The table by source with a broadcast hint if it is small enough."""
    return F.broadcast(frame) if frame.count() <= BROADCAST_SOURCES else frame


def order_hash(seed: str | Column, turn: Column, key: Column) -> Column:
    text = F.concat_ws(":", F.lit(seed), turn.cast("string"), F.coalesce(key.cast("string"), F.lit("null")))
    return F.conv(F.substring(F.md5(text), 1, HASH_BITS // 4), 16, 10).cast("long")


def sized(docs: DataFrame, id_col: str, text_col: str, source_col: str) -> DataFrame:
    # words are what stands between runs of white space, which become one space each
    spaced = docs.select(quoted(id_col).alias("doc_id"), quoted(source_col).cast("string").alias("source"), F.trim(F.regexp_replace(text_or_empty(text_col), r"[\x20\x09-\x0D]+", " ")).alias("spaced"))
    words = F.length("spaced") - F.length(F.replace("spaced", F.lit(" "))) + 1
    return spaced.select("doc_id", "source", F.when(F.col("spaced") == "", 0).otherwise(words).cast("long").alias("n_tokens"))


def ids_repeat(rows: DataFrame, id_col: str = "doc_id", source_col: str = "source") -> bool:
    """Whether a source has an id more than once."""
    return not rows.groupBy(source_col, id_col).count().where("count > 1").isEmpty()


def exponent(shares: Column, target_entropy: float, most_repeats: float) -> Column:
    """The exponent for an array of shares that are positive and sum to 1."""
    total = lambda values: F.aggregate(values, F.lit(0.0), lambda x, y: x + y)
    ratio = F.array_max(shares) / F.array_min(shares)

    def enough(a: Column) -> Column:
        powers = total(F.transform(shares, lambda p: F.pow(p, a)))
        entropy = F.log(powers) - a * total(F.transform(shares, lambda p: F.pow(p, a) * F.log(p))) / powers
        return (entropy >= target_entropy * F.log(F.size(shares).cast("double")) - 1e-12) | (F.pow(ratio, 1 - a) >= most_repeats)

    def halve(held: Column, _: Column) -> Column:
        middle = (held["low"] + held["high"]) / 2
        return F.struct(F.when(enough(middle), middle).otherwise(held["low"]).alias("low"), F.when(enough(middle), held["high"]).otherwise(middle).alias("high"))

    bounds = F.aggregate(F.sequence(F.lit(1), F.lit(STEPS)), F.struct(F.lit(0.0).alias("low"), F.lit(1.0).alias("high")), halve)
    return F.when(enough(F.lit(1.0)), F.lit(1.0)).otherwise(bounds["low"])


def plan(rows: DataFrame, target_entropy: float = 0.9, most_repeats: float = 2.0, block_tokens: int = 1_000_000) -> DataFrame:
    """One row per source: its tokens, weight, passes (how often it is read), full passes, the last pass's token budget, the
    number of blocks and its tokens in each."""
    totals = rows.groupBy("source").agg(F.sum("n_tokens").alias("tokens"))
    all_sources = totals.agg(F.array_sort(F.collect_list(F.struct("source", "tokens"))).alias("sources"))
    positive = F.filter("sources", lambda s: s["tokens"] > 0)
    whole = all_sources.withColumn("_all", F.aggregate("sources", F.lit(0).cast("long"), lambda x, s: x + s["tokens"]))
    shares = F.transform(positive, lambda s: s["tokens"] / F.col("_all"))
    whole = whole.withColumn("_shares", shares)
    whole = whole.withColumn("exponent", F.when(F.size("_shares") > 0, exponent(F.col("_shares"), target_entropy, most_repeats)).otherwise(F.lit(1.0)))
    # passes are kept to nine decimals, so that engines whose powers differ in the last bit plan alike
    passes = lambda s: F.when(s["tokens"] > 0, F.floor(F.pow(s["tokens"] / F.col("_all") / F.array_max("_shares"), F.col("exponent") - 1) * 1e9 + 0.5) / 1e9).otherwise(F.lit(1.0))
    out = whole.select("exponent", F.inline(F.transform("sources", lambda s: F.struct(s["source"].alias("source"), s["tokens"].alias("tokens"), passes(s).alias("passes")))))
    every = Window.partitionBy("exponent")
    budget = F.sum(F.col("tokens") * F.col("passes")).over(every)
    return out.select(
        "source",
        "tokens",
        "exponent",
        "passes",
        (F.col("tokens") * F.col("passes") / F.greatest(budget, F.lit(1.0))).alias("weight"),
        F.floor("passes").cast("long").alias("full"),
        F.floor((F.col("passes") - F.floor("passes")) * F.col("tokens")).cast("long").alias("rest"),
        F.greatest(F.ceil(budget / block_tokens), F.lit(1)).cast("long").alias("blocks"),
    ).withColumn("quota", F.col("tokens") * F.col("passes") / F.col("blocks"))


def passes_of(rows: DataFrame, planned: DataFrame, seed: str) -> DataFrame:
    """Every reading of every document, named by ``_key``: pass, hash, and the source's tokens before it in the pass's permutation."""
    copies = rows.join(planned, F.col("source").eqNullSafe(F.col("_source"))).withColumn("pass", F.explode(F.sequence(F.lit(0).cast("long"), F.col("full") - F.when(F.col("rest") > 0, 0).otherwise(1))))
    copies = copies.withColumn("_hash", order_hash(seed, F.col("pass"), F.col("_key"))).withColumn("_range", F.shiftright("_hash", HASH_BITS - 12))
    group = ["source", "pass", "_range"]
    sums = copies.groupBy(*group).agg(F.sum("n_tokens").alias("_sum"))
    before = F.coalesce(F.sum("_sum").over(Window.partitionBy("source", "pass").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = sums.select(*(F.col(g).alias(f"{g}_2") for g in group), before.alias("_before"))
    met = copies.join(starts, F.col("source").eqNullSafe(F.col("source_2")) & (F.col("pass") == F.col("pass_2")) & (F.col("_range") == F.col("_range_2")))
    inside = F.sum("n_tokens").over(Window.partitionBy(*group).orderBy("_hash", "_key", "n_tokens").rowsBetween(Window.unboundedPreceding, 0))
    ended = met.withColumn("_end", F.col("_before") + inside)
    return ended.where((F.col("pass") < F.col("full")) | (F.col("_end") <= F.col("rest")))


def schedule(docs: DataFrame, target_entropy: float = 0.9, most_repeats: float = 2.0, block_tokens: int = 1_000_000, seed: str = "mix", id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """One row per reading: doc_id, source, n_tokens, pass, block, place (from 0 in the block)."""
    rows = materialise(sized(docs, id_col, text_col, source_col).withColumn("_row", F.monotonically_increasing_id()), "mixing-sizes")
    rows = rows.withColumn("_key", F.col("_row" if ids_repeat(rows) else "doc_id"))
    planned = materialise(plan(rows, target_entropy, most_repeats, block_tokens), "mixing-plan").withColumnRenamed("source", "_source")
    read = passes_of(rows, small(planned), seed)
    place = F.col("pass") * F.col("tokens") + F.col("_end") - F.col("n_tokens")
    order = order_hash(f"{seed}-block", F.col("pass"), F.col("_key"))
    block = F.when(F.col("quota") > 0, F.least(F.floor(place / F.col("quota")), F.col("blocks") - 1)).otherwise(order % F.col("blocks")).cast("long")
    dealt = read.select("doc_id", "source", "n_tokens", "pass", block.alias("block"), order.alias("_order"), "_key")
    ranked = F.row_number().over(Window.partitionBy("block").orderBy("_order", "_key", "pass", "n_tokens", "source")) - 1
    return dealt.select("doc_id", "source", "n_tokens", "pass", "block", ranked.cast("long").alias("place"))


def mixed(docs: DataFrame, target_entropy: float = 0.9, most_repeats: float = 2.0, seed: str = "mix", id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The documents, each as often as the mixture reads it, with all their columns; texts aren't shuffled.

    The last pass of a source is a beginning of its permutation, so the last of it, by hash and id, tells which documents it holds.
    Where a source has an id more than once, its rows are numbered in a table in the shared folder, and the numbers are the ids."""
    names, docs = docs.columns, numbered(docs)
    id_col, text_col, source_col = (f"c{names.index(c)}" for c in (id_col, text_col, source_col))
    if ids_repeat(docs, id_col, source_col):
        docs = materialise(docs.withColumn("_row", F.monotonically_increasing_id()), "mixing-rows")
        id_col = "_row"
    rows = materialise(sized(docs, id_col, text_col, source_col), "mixing-sizes").withColumn("_key", F.col("doc_id"))
    planned = materialise(plan(rows, target_entropy, most_repeats), "mixing-plan").withColumnRenamed("source", "_source")
    last = passes_of(rows, small(planned.where("rest > 0")), seed).where(F.col("pass") == F.col("full")).groupBy("source").agg(F.max(F.struct("_hash", "_key")).alias("_cut"))
    bounds = planned.join(last, F.col("_source").eqNullSafe(F.col("source")), "left").select("_source", F.col("full").alias("_full"), "_cut")
    out = docs.join(small(materialise(bounds, "mixing-bounds")), F.col(source_col).cast("string").eqNullSafe(F.col("_source")))
    own = F.struct(order_hash(seed, F.col("_full"), F.col(id_col)).alias("_hash"), F.col(id_col).alias("_key"))
    copies = F.col("_full") + F.when(F.coalesce(own <= F.col("_cut"), F.lit(False)), 1).otherwise(0)
    return renamed(out.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), copies))), names)
