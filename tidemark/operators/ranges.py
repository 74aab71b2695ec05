"""Token ranges as tables: splitting a ring, clipping, estimating, planning and ordering work. Bounds are DECIMAL(38,0)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.session import stored

WIDE = "decimal(38,0)"
#: What a fixed split falls back to when the ring is narrower than the number of parts.
FALLBACK_SIZE = 100_000
MOST_PARTS = 50_000_000
#: Ranges that may be broadcast: a plan is bounded by MOST_PARTS, a broadcast by this.
BROADCAST_RANGES = 1_000_000
#: Ranges that a cell of equal depth holds, about.
CELL_RANGES = 5_000
#: Ranges that a token is compared with at most, where a plan's ranges don't overlap.
LEAF_RANGES = 32


def wide(x: Column | int) -> Column:
    return (x if isinstance(x, Column) else F.lit(str(x))).cast(WIDE)


def whole(a: Column, b: Column) -> Column:
    """The whole part of a / b for numbers that aren't negative."""
    return ((a - a % b) / b).cast(WIDE)


def part_size(low: Column, high: Column, parts: Column) -> Column:
    size = whole(high - low, parts)
    return F.when(size == 0, wide(FALLBACK_SIZE)).otherwise(size)


def split(bounds: DataFrame, parts: int, coverage: int = 100) -> DataFrame:
    """Every row's [min, max] in ranges of one size, the last one cut off; coverage keeps the lower part of each."""
    if not 1 <= parts <= MOST_PARTS:
        raise ValueError(f"parts must be from 1 to {MOST_PARTS}")
    low, high = wide(F.col("min")), wide(F.col("max"))
    sized = bounds.select(low.alias("_low"), high.alias("_high"), part_size(low, high, wide(parts)).alias("_size"))
    counted = sized.withColumn("_n", whole(F.col("_high") - F.col("_low"), F.col("_size") + 1) + 1)
    out = counted.withColumn("range_id", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_n").cast("long") - 1)))
    start = (F.col("_low") + F.col("range_id").cast(WIDE) * (F.col("_size") + 1)).cast(WIDE)
    out = out.withColumn("min", start).withColumn("max", F.least(F.col("min") + F.col("_size"), F.col("_high")).cast(WIDE))
    return out.select("range_id", "min", shrunk(F.col("min"), F.col("max"), coverage).alias("max"))


def shrunk(low: Column, high: Column, percent: int) -> Column:
    percent = percent if 1 <= percent <= 100 else 100
    if percent == 100:
        return high
    width = high - low
    quotient, rest = whole(width, wide(100)), width % wide(100)
    return (low + quotient * percent + whole(rest * percent, wide(100))).cast(WIDE)


def range_of(token: Column, low: int | Column, high: int | Column, parts: int) -> Column:
    """The number of the range of a fixed split that holds the token; no join is needed."""
    low, high = wide(low), wide(high)
    return whole(wide(token) - low, part_size(low, high, wide(parts)) + 1).cast("long")


def equal_parts(ranges: DataFrame, parts: Column) -> DataFrame:
    """Every range in ``parts`` parts as equal as can be, never more than it has tokens; the first ones are one longer."""
    size = wide(F.col("max")) - wide(F.col("min")) + 1
    out = ranges.withColumn("_k", F.greatest(F.least(wide(parts), size), wide(1))).withColumn("_size", size)
    out = out.withColumn("_base", whole(F.col("_size"), F.col("_k"))).withColumn("_rest", F.col("_size") % F.col("_k"))
    out = out.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_k").cast("long") - 1)))
    i = wide(F.col("part"))
    start = (wide(F.col("min")) + i * F.col("_base") + F.least(i, F.col("_rest"))).cast(WIDE)
    length = F.col("_base") + F.when(i < F.col("_rest"), 1).otherwise(0)
    names = [c for c in ranges.columns if c not in ("min", "max")]
    return out.select(*names, "part", start.alias("min"), (start + length - 1).cast(WIDE).alias("max"))


def subdivided(ranges: DataFrame, multiplier: int) -> DataFrame:
    """Every range by the rule of the fixed split, so narrow ranges stay whole."""
    low, high = wide(F.col("min")), wide(F.col("max"))
    out = ranges.withColumn("_size", part_size(low, high, wide(multiplier)))
    out = out.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), whole(high - low, F.col("_size") + 1).cast("long"))))
    start = (low + wide(F.col("part")) * (F.col("_size") + 1)).cast(WIDE)
    names = [c for c in ranges.columns if c not in ("min", "max")]
    return out.select(*names, "part", start.alias("min"), F.least(start + F.col("_size"), high).cast(WIDE).alias("max"))


def clamped(ranges: DataFrame, low: int, high: int) -> DataFrame:
    """Ranges cut to the bounds; those outside are left out."""
    if low > high:
        raise ValueError("the lower bound lies above the upper one")
    inside = ranges.where((F.col("max") >= wide(low)) & (F.col("min") <= wide(high)))
    return inside.withColumn("min", F.greatest("min", wide(low))).withColumn("max", F.least("max", wide(high)))


def overlaps(left: DataFrame, right: DataFrame) -> DataFrame:
    """Pairs of ranges that overlap (left min, max; right r_min, r_max), with the common part lo, hi.

    Both sides are cut into a grid of cells as fine as the right side has ranges; ranges meet by equal cells, in the first that
    both have, so no range is compared with all others."""
    bounds = right.agg(F.min("r_min").alias("lo"), F.max("r_max").alias("hi"), F.count("*").alias("n")).first()
    if not bounds["n"]:
        return left.join(right, F.lit(False)).withColumn("lo", wide(0)).withColumn("hi", wide(0))
    step = max(1, (int(bounds["hi"]) - int(bounds["lo"])) // bounds["n"] + 1)
    cell = lambda x: F.floor((wide(x) - wide(int(bounds["lo"]))) / wide(step)).cast("long")
    last = cell(wide(int(bounds["hi"])))
    cells = lambda low, high: F.explode(F.sequence(F.greatest(cell(F.col(low)), F.lit(0).cast("long")), F.least(cell(F.col(high)), last)))
    inside = left.where((F.col("max") >= wide(int(bounds["lo"]))) & (F.col("min") <= wide(int(bounds["hi"]))))
    cut = inside.withColumn("_cell", cells("min", "max"))
    r = right.withColumn("_r_cell", cells("r_min", "r_max"))
    met = cut.join(r, (F.col("_cell") == F.col("_r_cell")) & (F.col("min") <= F.col("r_max")) & (F.col("r_min") <= F.col("max")))
    lo, hi = F.greatest("min", "r_min"), F.least("max", "r_max")
    first = F.greatest(cell(lo), F.lit(0).cast("long"))
    return met.where(F.col("_cell") == first).drop("_cell", "_r_cell").withColumn("lo", lo).withColumn("hi", hi)


def ring_aware(bounds: tuple[int, int], segments: DataFrame, parts: int) -> DataFrame:
    """Segments (min, max, and others such as replicas) cut to the bounds, each with its share of the parts, at least one."""
    inside = clamped(segments, *bounds)
    size = F.col("max") - F.col("min") + 1
    total = inside.agg(F.lit(1).alias("_one"), F.sum(size).alias("_total"))
    shared = inside.withColumn("_one", F.lit(1)).join(F.broadcast(total), "_one").drop("_one")  # one row
    k = F.greatest(whole(wide(parts) * size, F.col("_total")), wide(1))
    return equal_parts(shared.withColumn("_parts", k), F.col("_parts")).drop("_parts", "_total")


def estimated(ranges: DataFrame, estimates: DataFrame, count: str = "partitions") -> DataFrame:
    """Ranges with ``estimate``: the estimates' counts in proportion to the overlap, rounded down each."""
    e = estimates.select(F.col("min").alias("r_min"), F.col("max").alias("r_max"), F.col(count).alias("_count"))
    met = overlaps(ranges, e)
    share = F.floor(wide(F.col("_count")) * (F.col("hi") - F.col("lo") + 1) / (F.col("r_max") - F.col("r_min") + 1))
    sums = met.groupBy("min", "max").agg(F.sum(share).cast("long").alias("estimate"))
    return ranges.join(sums, ["min", "max"], "left").withColumn("estimate", F.coalesce("estimate", F.lit(0).cast("long")))


def adaptive(ranges: DataFrame, estimates: DataFrame, most_rows: int) -> DataFrame:
    """Each range in as many equal parts as keep its estimated rows at ``most_rows``."""
    sized = estimated(ranges, estimates)
    return equal_parts(sized.withColumn("_k", F.greatest(F.ceil(F.col("estimate") / most_rows), F.lit(1))), F.col("_k")).drop("_k")


def in_cells(ranges: DataFrame) -> DataFrame:
    """The ranges with ``_cell``, ascending by their ends: cells of about CELL_RANGES ranges each, wherever the ranges crowd. The
    bounds between cells come from a sample, so the result is stored, and every reader sees the same cells."""
    cells = max(1, ranges.count() // CELL_RANGES)
    dealt = ranges.repartitionByRange(cells, "min", "max").withColumn("_cell", F.spark_partition_id()) if cells > 1 else ranges.withColumn("_cell", F.lit(0))
    return stored(dealt, "cells")


def conflicts(ranges: DataFrame) -> DataFrame:
    """Neighbours of a work list that overlap. Neighbours are found within cells of equal depth; a cell's last range is compared with
    the first of the next cell that has any, so that no task reads all ranges."""
    own = in_cells(ranges.select("min", "max"))
    firsts = own.groupBy("_cell").agg(F.min("min").alias("_first"))
    after = firsts.withColumn("_next", F.lead("_first").over(Window.orderBy("_cell"))).select("_cell", "_next")  # one row a cell
    w = Window.partitionBy("_cell").orderBy("min", "max")
    linked = own.withColumn("_lead", F.lead("min").over(w)).join(after, "_cell").withColumn("next_min", F.coalesce("_lead", "_next"))
    return linked.where(F.col("next_min") <= F.col("max")).select("min", "max", "next_min")


def floor_by(x: Column, step: Column) -> Column:
    """floor(x / step) of 64-bit integers, exactly and without overflow."""
    return F.call_function("div", x, step) - F.when(x % step < 0, 1).otherwise(0)


def grids(ranges: DataFrame, low: int, high: int, n: int) -> tuple[int, list[DataFrame], DataFrame]:
    """A tree of grids over ranges (range_id, _r_min, _r_max) of 64 bits: the root's step, the crowded cells of each level, and the
    leaves.

    The root has about as many cells as there are ranges. A cell with more than LEAF_RANGES gets a grid of its own, with as many
    cells as ranges, and so on, so a plan that is even has the root only, and one that is dense somewhere gets a level or two more
    there. Crowded cells: _node, _cell, and the node and step of their grid; leaves: _node, _cell, range_id, _r_min, _r_max."""
    root = min(max(1, (high - low) // n + 1), (1 << 63) - 1)
    step = F.col("_step")
    spread = lambda lo, hi: F.explode(F.sequence(floor_by(lo, step), floor_by(hi, step)))
    ends = [F.col("_r_min"), F.col("_r_max")]
    cells = stored(ranges.select("*", F.lit(0).cast("long").alias("_node"), F.lit(root).cast("long").alias("_step"), *(e.alias(a) for e, a in zip(ends, ("_lo", "_hi"), strict=True))).withColumn("_cell", spread(*ends)), "grid")
    levels, leaves = [], []
    while True:
        sizes = cells.groupBy("_node", "_cell", "_step").agg(F.count("*").alias("_n"))
        crowded = sizes.where((F.col("_n") > LEAF_RANGES) & (step > 1))
        child = crowded.select("_node", "_cell", F.xxhash64("_node", "_cell", "_step").alias("_child"), F.greatest(F.call_function("div", step, F.col("_n")) + 1, F.lit(1).cast("long")).alias("_child_step"))
        child = stored(child, "crowded")
        if child.isEmpty():
            leaves.append(cells)
            break
        levels.append(child)
        leaves.append(cells.join(child.select("_node", "_cell"), ["_node", "_cell"], "left_anti"))
        inner = cells.join(child, ["_node", "_cell"])
        # a range's part in the cell; in decimals, as a cell's ends may lie beyond 64 bits
        first = wide(F.col("_cell")) * wide(step)
        inner = inner.withColumn("_lo", F.greatest(wide(F.col("_lo")), first).cast("long")).withColumn("_hi", F.least(wide(F.col("_hi")), first + wide(step) - 1).cast("long"))
        inner = inner.select("range_id", "_r_min", "_r_max", F.col("_child").alias("_node"), F.col("_child_step").alias("_step"), "_lo", "_hi")
        cells = stored(inner.withColumn("_cell", spread(F.col("_lo"), F.col("_hi"))), "grid")
    all_leaves = leaves[0]
    for more in leaves[1:]:
        all_leaves = all_leaves.unionByName(more)
    return root, levels, all_leaves.select("_node", "_cell", "range_id", "_r_min", "_r_max")


def small(df: DataFrame) -> DataFrame:
    """The frame, to be broadcast if it was counted and has at most BROADCAST_RANGES rows."""
    return F.broadcast(df) if df.count() <= BROADCAST_RANGES else df


def assigned(rows: DataFrame, token: str, ranges: DataFrame) -> DataFrame:
    """Rows with the range (of any plan) that holds their token; rows outside are left out.

    Ranges lie in a tree of grids (``grids``): a row's cell is computed, looked up among the crowded cells of each level, which are
    few or none, and then compared with the LEAF_RANGES ranges of its leaf at most, however uneven the plan. Rows aren't repeated,
    nor shuffled with up to BROADCAST_RANGES ranges in leaves. Tokens beyond 64 bits take the way of ``overlaps``."""
    bounds = ranges.agg(F.min("min").alias("lo"), F.max("max").alias("hi"), F.count("*").alias("n")).first()
    fits = bounds["n"] and -(1 << 63) <= int(bounds["lo"]) and int(bounds["hi"]) < 1 << 63
    if fits and isinstance(rows.schema[token].dataType, T.IntegralType):
        named = ranges.select("range_id", F.col("min").cast("long").alias("_r_min"), F.col("max").cast("long").alias("_r_max"))
        root, levels, leaves = grids(named, int(bounds["lo"]), int(bounds["hi"]), bounds["n"])
        at = F.col("`" + token.replace("`", "``") + "`").cast("long")
        met = rows.withColumn("_at_node", F.lit(0).cast("long")).withColumn("_at_cell", floor_by(at, F.lit(root).cast("long")))
        same = (F.col("_at_node") == F.col("_node")) & (F.col("_at_cell") == F.col("_cell"))
        for level in levels:
            met = met.join(small(level), same, "left").withColumn("_at_cell", F.when(F.col("_child").isNotNull(), floor_by(at, F.col("_child_step"))).otherwise(F.col("_at_cell")))
            met = met.withColumn("_at_node", F.coalesce("_child", "_at_node")).drop("_node", "_cell", "_child", "_child_step")
        met = met.join(small(leaves), same & (at >= F.col("_r_min")) & (at <= F.col("_r_max")))
        return met.drop("_at_node", "_at_cell", "_node", "_cell", "_r_min", "_r_max")
    points = rows.withColumn("min", wide(F.col(token))).withColumn("max", wide(F.col(token)))
    named = ranges.select(F.col("range_id").alias("range_id"), F.col("min").alias("r_min"), F.col("max").alias("r_max"))
    return overlaps(points, named).drop("min", "max", "lo", "hi", "r_min", "r_max")


def work_order(ranges: DataFrame, run_id: int) -> DataFrame:
    """A permutation of the plan that a run id gives again; ``work_order`` from 0."""
    text = F.concat_ws(":", F.col("min").cast("string"), F.lit(str(run_id)))
    # by the first digits of the hash: 65,536 groups, each with the number of ranges before it
    hashed = ranges.withColumn("_hash", F.md5(text)).withColumn("_group", F.substring("_hash", 1, 4))
    sizes = hashed.groupBy("_group").agg(F.count("*").alias("_n"))
    before = sizes.select("_group", (F.sum("_n").over(Window.orderBy("_group")) - F.col("_n")).alias("_before"))
    number = F.row_number().over(Window.partitionBy("_group").orderBy("_hash", "min")) - 1
    return hashed.join(before, "_group").withColumn("work_order", (F.col("_before") + number).cast("long")).drop("_hash", "_group", "_before")


def ring_order(ranges: DataFrame) -> DataFrame:
    """The plan in the order of the ring; ``work_order`` from 0, by lower ends, numbered within cells of equal depth."""
    own = in_cells(ranges)
    sizes = own.groupBy("_cell").agg(F.count("*").alias("_n"))
    before = sizes.select("_cell", (F.sum("_n").over(Window.orderBy("_cell")) - F.col("_n")).alias("_before"))  # one row a cell
    number = F.row_number().over(Window.partitionBy("_cell").orderBy("min", "max")) - 1
    return own.join(before, "_cell").withColumn("work_order", (F.col("_before") + number).cast("long")).drop("_cell", "_before")


def span_histogram(ranges: DataFrame) -> DataFrame:
    """Ranges by the power of two of their token counts."""
    size = (F.col("max") - F.col("min") + 1).cast(WIDE)
    powers = F.array(*(wide(1 << k) for k in range(127)))
    power = F.size(F.filter(powers, lambda p: p <= size)) - 1
    return ranges.groupBy(power.alias("power")).agg(F.count("*").alias("n_ranges"))


def plan_report(ranges: DataFrame, estimate: Column, rows_per_second: int) -> DataFrame:
    tokens = F.sum(F.col("max") - F.col("min") + 1)
    rows = F.coalesce(F.sum(estimate), F.lit(0)).cast("long")
    return ranges.agg(F.count("*").alias("n_ranges"), tokens.cast("string").alias("planned_tokens"), rows.alias("estimated_rows"), F.ceil(rows / rows_per_second).cast("long").alias("seconds"))


def measured(rows: DataFrame, token: str, row_bytes: Column, cell: int) -> DataFrame:
    """Estimates of a table by cells of the ring, as a cluster's statistics would give them: min, max, partitions, mean_bytes."""
    number = F.floor(F.col(token) / F.lit(cell).cast("decimal(20,0)")).cast("long")
    counted = rows.groupBy(number.alias("_cell")).agg(F.count("*").alias("partitions"), F.floor(F.avg(row_bytes)).cast("long").alias("mean_bytes"))
    start = (wide(F.col("_cell")) * wide(cell)).cast(WIDE)
    return counted.select(start.alias("min"), (start + wide(cell) - 1).cast(WIDE).alias("max"), "partitions", "mean_bytes")


def mean_row_bytes(estimates: DataFrame) -> DataFrame:
    """Mean size weighted by partitions, whole number; null without any."""
    total = F.sum("partitions")
    return estimates.agg(F.when(total > 0, F.floor(F.sum(F.col("partitions") * F.col("mean_bytes")) / total)).cast("long").alias("mean_row_bytes"))


def ring(spark: SparkSession, low: int, high: int) -> DataFrame:
    return spark.range(1).select(wide(low).alias("min"), wide(high).alias("max"))


#: The rings of partitioners, both ends included; an ordered one has none, so both bounds must be given.
RINGS = {"murmur3": (-(1 << 63), (1 << 63) - 1), "random": (0, (1 << 127) - 1), "xxhash64": (-(1 << 63), (1 << 63) - 1), "md5_60": (0, (1 << 60) - 1), "ordered": None}


def resolve_bounds(partitioner: str, low: int | None = None, high: int | None = None) -> tuple[int, int]:
    """The bounds to plan between: each side as given, else the ring's."""
    ring_ends = RINGS[partitioner]
    if ring_ends is None and (low is None or high is None):
        raise ValueError("an ordered partitioner needs both bounds")
    found = (ring_ends[0] if low is None else low, ring_ends[1] if high is None else high)
    if found[0] > found[1]:
        raise ValueError("the lower bound lies above the upper one")
    return found


def from_work_list(ranges: DataFrame) -> DataFrame:
    """A plan from given ranges (min, max): there must be some, at most MOST_PARTS, and none may overlap."""
    n = ranges.count()
    if not 1 <= n <= MOST_PARTS:
        raise ValueError(f"a work list holds from 1 to {MOST_PARTS} ranges, not {n}")
    wide_ranges = ranges.select(wide(F.col("min")).alias("min"), wide(F.col("max")).alias("max"))
    if not wide_ranges.where(F.col("min") > F.col("max")).isEmpty() or not conflicts(wide_ranges).isEmpty():
        raise ValueError("ranges of a work list overlap or are inverted")
    return wide_ranges.withColumn("coverage", F.lit(100))
