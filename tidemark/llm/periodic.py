"""Periodic runs of words: maximal repetitions of a text's words, found through Lyndon arrays by grouping of suffixes.

A run is a stretch of consecutive words with smallest period q, at least ``shortest`` words and ``exponent`` times q long, that no
neighbouring word extends while it keeps period q. The runs of a text are found in these steps:

1. Words become numbers. A run's words all lie in windows of shortest // exponent words that occur twice in the text (each window
   within it but the last period's recurs one period on), so only the stretches that such windows cover are looked at; a window's
   hash that meets another's by chance makes a stretch longer and changes no result.
2. The first phase of the grouping suffix sorter gives a stretch's Lyndon array (the length of the longest Lyndon word that begins
   at each place) without sorting: groups of suffixes, one for each word at first, are taken from the highest down; each suffix of
   a group hands the group's context to the nearest place before it that lies in a lower group, and the places that got the
   context equally often move from their group to a new one right above it. A group's length of context is its places' Lyndon
   length in the end. This is done under the order of the words' numbers and under the reverse one.
3. Each run has a Lyndon root in one of the two arrays: the longest Lyndon word at its places that begin a period in the right
   order. Every root that is followed by itself is extended to both sides by longest common extensions, compared in growing steps.

Null and empty texts have no words and no runs. Repeated rows give the same result each. Rows of null id are kept. Other columns are
ignored, whatever their names. An empty table gives an empty result. A text is handled whole in one task: some 150 bytes for each of
its words, and some 500 for each word of a stretch whose windows recur. Work is linear in the words, but for sorting window hashes.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import SLICE_BYTES, quoted, row_slices, text_or_empty, tidy

SPACE = r"[\x20\x09-\x0D]+"
RUN = "struct<start: bigint, length: bigint, period: bigint>"
_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
#: Words compared by the first step of an extension; each later step takes twice as many.
STEP = 32


def lyndon_lengths(codes: list[int]) -> list[int]:
    """The length of the longest Lyndon word that begins at each place; ``codes`` are 0 to m - 1, each of them present."""
    n, m = len(codes), max(codes, default=-1) + 1
    members: list[list[int]] = [[] for _ in range(m)]
    for i, c in enumerate(codes):
        members[c].append(i)
    group, alive, context = list(codes), [len(x) for x in members], [1] * m
    below, above = list(range(-1, m - 1)), list(range(1, m + 1))
    left, closed = list(range(-1, n - 1)), bytearray(n)
    g = m - 1
    while g >= 0:
        now = [i for i in members[g] if group[i] == g]
        members[g] = []
        for i in now:
            closed[i] = 1
        given: dict[int, int] = {}
        for i in now:
            j = left[i]
            if j >= 0 and closed[j]:
                while j >= 0 and closed[j]:
                    j = left[j]
                k = i
                while (after := left[k]) != j:
                    left[k] = j
                    k = after
            if j >= 0:
                given[j] = given.get(j, 0) + 1
        if given:
            moved: dict[tuple[int, int], list[int]] = {}
            for j, times in given.items():
                moved.setdefault((times, group[j]), []).append(j)
            for times, old in sorted(moved, reverse=True) if len(moved) > 1 else moved:
                places, gain = moved[times, old], times * context[g]
                if alive[old] == len(places):  # all that is left of the group: it stands where the new one would
                    context[old] += gain
                    continue
                new = len(context)
                alive[old] -= len(places)
                alive.append(len(places))
                context.append(context[old] + gain)
                members.append(places)
                below.append(old)
                above.append(above[old])
                below[above[old]] = new
                above[old] = new
                for j in places:
                    group[j] = new
        g = below[g]
    return [context[x] for x in group]


def _agreeing(ids: np.ndarray, a: int, b: int, forward: bool) -> int:
    """The longest common extension of the places a < b: to the right from them, or to the left from before them."""
    most, done, step = len(ids) - b if forward else a, 0, STEP
    while done < most:
        k = min(step, most - done)
        x, y = (a + done, b + done) if forward else (a - done - k, b - done - k)
        differ = np.flatnonzero(ids[x : x + k] != ids[y : y + k])
        if len(differ):
            return done + int(differ[0] if forward else k - 1 - differ[-1])
        done, step = done + k, 2 * step
    return most


def stretches(ids: np.ndarray, width: int, shortest: int) -> Iterator[tuple[int, int]]:
    """The longest stretches covered by windows of ``width`` words that occur twice or more, ``shortest`` words or longer."""
    n = len(ids) - width + 1
    value = ids.astype("u8") * np.uint64(0x9E3779B97F4A7C15) + np.uint64(0xD1B54A32D192ED03)
    value ^= value >> np.uint64(29)
    hashes = np.zeros(n, "u8")
    for k in range(width):
        hashes = hashes * np.uint64(0xD6E8FEB86659FD93) + value[k : k + n]
    order = np.argsort(hashes)
    equal = hashes[order[1:]] == hashes[order[:-1]]
    if not equal.any():
        return
    edge = np.zeros(len(ids) + 1, "i4")
    twice = np.zeros(n, bool)
    twice[order[1:][equal]] = twice[order[:-1][equal]] = True
    at = np.flatnonzero(twice)
    edge[at] += 1
    edge[at + width] -= 1
    covered = np.concatenate([[0], (np.cumsum(edge[:-1]) > 0).astype("i1"), [0]])
    bounds = np.flatnonzero(np.diff(covered))
    for a, b in zip(bounds[::2].tolist(), bounds[1::2].tolist(), strict=True):
        if b - a >= shortest:
            yield a, b


def _roots(codes: np.ndarray, place: np.ndarray, period: np.ndarray, exponent: int) -> np.ndarray:
    """The places whose Lyndon words may be roots of runs. With three periods one root is followed by itself; with two only, the word
    after a root or the one before it goes on with its period."""
    if exponent > 2:
        at = place[place + 2 * period <= len(codes)]
        p = period[at]
        return at[(codes[at] == codes[at + p]) & (codes[at + p - 1] == codes[at + 2 * p - 1])]
    padded = np.concatenate([[-1], codes, [-2]])
    return place[(codes == padded[place + period + 1]) | (padded[place] == codes[place + period - 1])]


def runs_of(ids: np.ndarray, shortest: int = 24, exponent: int = 3) -> list[tuple[int, int, int]]:
    """All runs (start, length, period) of a sequence of numbers, by start, then period."""
    found: set[tuple[int, int, int]] = set()
    if len(ids) < shortest:
        return []
    for first, end in stretches(ids, shortest // exponent, shortest):
        part = ids[first:end]
        codes = np.unique(part, return_inverse=True)[1]
        place = np.arange(len(part))
        for order in (codes, codes.max() - codes):
            period = np.array(lyndon_lengths(order.tolist()))
            at = _roots(codes, place, period, exponent)
            seen: dict[int, int] = {}  # by period, where the last extension ended
            for i, q in zip(at.tolist(), period[at].tolist(), strict=True):
                if i + q <= seen.get(q, 0):
                    continue
                stop = i + q + _agreeing(codes, i, i + q, True)
                start = i - _agreeing(codes, i, i + q, False)
                seen[q] = stop
                if stop - start >= max(shortest, exponent * q):
                    found.add((first + start, stop - start, q))
    return sorted(found, key=lambda r: (r[0], r[2]))


def strongest(runs: list[tuple[int, int, int]]) -> tuple[int, int, int] | None:
    """The run of the greatest length / period; of ties the first, then that of the shortest period."""
    return max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=None)


def collapse(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words joined by one space, without those that a run holds after its first period."""
    if not runs:
        return b" ".join(words)
    edge = np.zeros(len(words) + 1, "i4")
    for start, length, period in runs:
        edge[start + period] += 1
        edge[start + length] -= 1
    return b" ".join([words[i] for i in np.flatnonzero(np.cumsum(edge[:-1]) == 0).tolist()])


def periodic_runs(docs: DataFrame, shortest: int = 24, exponent: int = 3) -> DataFrame:
    """doc_id, all runs by start, then period, the strongest run (or null), and the text's words joined by one space without those
    that a run holds after its first period. ``exponent`` is a whole number of at least 2, ``shortest`` at least as large."""
    if exponent < 2 or shortest < exponent:
        raise ValueError("exponent must be 2 or more, and shortest no less than it")

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, end in row_slices(batch.column(1), SLICE_BYTES):
                runs, best, kept = [], [], []
                for text in batch.column(1).slice(first, end - first):
                    words = text.as_buffer().to_pybytes().split()  # bytes are split at these six characters only
                    number: dict[bytes, int] = {}
                    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), "i8", len(words))
                    got = runs_of(ids, shortest, exponent)
                    runs.append([{"start": s, "length": n, "period": p} for s, n, p in got])
                    best.append(dict(zip(("start", "length", "period"), one, strict=True)) if (one := strongest(got)) else None)
                    kept.append(collapse(words, got))
                yield pa.record_batch([batch.column(0).slice(first, end - first), pa.array(runs, pa.list_(_RUN)), pa.array(best, _RUN), pa.array(kept, pa.binary())], ["doc_id", "runs", "strongest", "collapsed"])

    kind = docs.select(quoted("doc_id")).schema[0].dataType.simpleString()
    rows = docs.select(quoted("doc_id").alias("doc_id"), text_or_empty().cast("binary").alias("text"))
    found = rows.mapInArrow(tidy(find), f"doc_id {kind}, runs array<{RUN}>, strongest {RUN}, collapsed binary")
    return found.withColumn("collapsed", F.col("collapsed").cast("string"))


def made_periodic(docs: DataFrame) -> DataFrame:
    """doc_id and text, where a tenth of the documents (by the crc32 h of the id in decimals) repeat a part of their words to their
    end: with n words and g = h div 10, the p = 1 + (n - a) div (3 + g % 8) words from place a = g % n on. Null ids are left alone."""
    h = F.crc32(quoted("doc_id").cast("string").cast("binary"))
    rows = docs.select(quoted("doc_id").alias("doc_id"), text_or_empty().alias("text"), h.alias("h"))
    chosen = F.col("h") % 10 == 0
    words: Column = F.when(chosen, F.array_remove(F.split("text", SPACE), ""))
    g = F.expr("h div 10")
    rows = rows.withColumn("words", words).withColumn("n", F.size("words")).withColumn("a", F.when(F.col("n") > 0, (g % F.col("n")).cast("int")))
    rows = rows.withColumn("p", F.expr("cast(1 + (n - a) div (3 + (h div 10) % 8) as int)"))
    again = F.expr("concat(slice(words, 1, a), slice(flatten(array_repeat(slice(words, a + 1, p), cast(1 + (n - a) div p as int))), 1, n - a))")
    return rows.select("doc_id", F.when(F.col("a").isNotNull(), F.array_join(again, " ")).otherwise(F.col("text")).alias("text"))


def run_digests(found: DataFrame) -> DataFrame:
    """One row per document: the number of runs, the strongest run, and digests of all runs and of the words kept."""
    listed = F.array_join(F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])), "\n")
    listed = F.when(F.size("runs") > 0, F.concat(listed, F.lit("\n"))).otherwise("")
    best = F.col("strongest")
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        best["start"].alias("start"),
        best["length"].alias("length"),
        best["period"].alias("period"),
        F.expr("1000 * strongest.length div strongest.period").alias("exponent_milli"),
        F.sha2(listed, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
