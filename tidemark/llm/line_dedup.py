"""Removal of lines that many documents share, with DataFrame functions only, over levelled sorted runs of line hashes.

A line's key is the line without white space at its ends and with A to Z in lower case. The keys of ``least`` code points and more
that ``copies`` documents or more hold lose all their lines, except in the document with the largest id among those.

``LineRuns`` is the index: each batch of lines adds a run, a table bucketed and sorted by the 128-bit hash of the line's key.

* A new batch is summed by hash, dealt to the same buckets once, and merge-anti-joined with the runs, one after the other, without
  any shuffle of a run. What is left are the batch's new hashes; they make its run, with their number of documents and the largest
  id. So each hash stands in one run, with the document that keeps the line, as batches come in descending order of ids.
* The batch's other hashes, known from earlier runs, add their numbers of documents to a run of repeats of the same form.
* When a level has ``fanout`` runs, they are compacted into one run of the next level, bucket by bucket. So there are only as many runs
  as the logarithm of the number of batches, times ``fanout``, and each row is written as often as there are levels.

``without_repeated_lines`` makes batches by ranges of ids and then takes the frequent hashes from the index. It reads texts twice:
once for the hashes of lines, which are written with the lines' places, and once to cut out the places that go. Hash groups are
summed in two steps, so a line that many documents share costs one row per task; only the join with frequent hashes meets such a
line's rows again, one side with one row per hash, where adaptive execution splits the other.

Null texts are one empty line. A document is a row; rows that agree in id and text are one document, with the same result each. Rows
that agree in the id only are several documents; if theirs is the largest id with a line, all of them keep it. A null id is below
all others. Other columns are ignored, whatever their names. An empty table gives an empty result. A text is one value in one task,
of which its lines are another copy; work is linear in the text. Keys are taken as equal by 128 bits of hash: at 10 to the 13
different lines, two are taken for one with a chance below 10 to the -12.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import discard, materialise, quoted, text_or_empty
from tidemark.session import remove, scratch_path

WHITE = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
HASH = ["h1", "h2"]


def line_key(line: Column) -> Column:
    """The line without white space at its ends, with A to Z in lower case."""
    bare = F.btrim(line, F.lit(WHITE))
    return F.when(F.octet_length(bare) == F.length(bare), F.lower(bare)).otherwise(F.translate(bare, UPPER, LOWER))


class LineRuns:
    """An index of line hashes in levelled sorted runs. Rows of a batch are h1, h2 (a hash) and doc_id, one for each document."""

    def __init__(self, spark: SparkSession, buckets: int | None = None, fanout: int = 3) -> None:
        if fanout < 2:
            raise ValueError("fanout must be 2 or more")
        self.spark, self.fanout = spark, fanout
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.runs: list[list[str]] = []  # by level, names of tables: h1, h2, n, keeper; each hash stands in one of them
        self.repeats: list[list[str]] = []  # the same form; keeper is null
        self.paths: dict[str, str] = {}

    def _write(self, rows: DataFrame) -> str:
        path = scratch_path(self.spark, "run")
        name = "tidemark_" + path[-32:]
        (rows.select(*HASH, "n", "keeper").repartition(self.buckets, *HASH).write.format("parquet").option("compression", "zstd")
            .option("path", path).bucketBy(self.buckets, *HASH).sortBy(*HASH).saveAsTable(name))
        self.paths[name] = path
        return name

    def _drop(self, *names: str) -> None:
        for name in names:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")
            remove(self.spark, self.paths.pop(name))

    def fresh(self, batch: DataFrame) -> DataFrame:
        """The rows of the batch whose hashes stand in no run."""
        for run in (name for level in self.runs for name in level):
            batch = batch.join(self.spark.table(run).select(*HASH), HASH, "left_anti")
        return batch

    def add(self, batch: DataFrame) -> None:
        """Adds the hashes of a batch: new ones with the number of the batch's documents that hold them and the largest id of these."""
        came = self._write(batch.groupBy(*HASH).agg(F.count("*").alias("n"), F.max("doc_id").alias("keeper")))
        if any(self.runs):
            known = self.spark.table(came)
            new = self._write(self.fresh(known))
            again = self._write(known.join(self.spark.table(new).select(*HASH), HASH, "left_anti").withColumn("keeper", F.lit(None).cast(known.schema["keeper"].dataType)))
            self._drop(came)
            self._push(self.repeats, again)
        else:
            new = came
        self._push(self.runs, new)

    def _push(self, levels: list[list[str]], name: str, level: int = 0) -> None:
        """Puts a run on its level, and merges the level's runs into one of the next level when it is full."""
        if level == len(levels):
            levels.append([])
        levels[level].append(name)
        if len(levels[level]) < self.fanout:
            return
        full, levels[level] = levels[level], []
        merged = self._rows(full)
        if levels is self.repeats:
            merged = merged.groupBy(*HASH).agg(F.sum("n").alias("n"), F.max("keeper").alias("keeper"))
        self._push(levels, self._write(merged), level + 1)
        self._drop(*full)

    def _rows(self, names: list[str]) -> DataFrame:
        """All rows of some runs, read as plain files: a union of bucketed scans may take its rows for dealt when they aren't."""
        return self.spark.read.schema(self.spark.table(names[0]).schema).parquet(*(self.paths[name] for name in names))

    def totals(self) -> DataFrame:
        """h1, h2, n (documents in all batches) and keeper (the largest id of the first batch that had the hash)."""
        names = [name for levels in (self.runs, self.repeats) for level in levels for name in level]
        return self._rows(names).groupBy(*HASH).agg(F.sum("n").alias("n"), F.max("keeper").alias("keeper"))

    def close(self) -> None:
        """Deletes the index's tables."""
        self._drop(*list(self.paths))


def line_hashes(docs: DataFrame, least: int) -> DataFrame:
    """doc_id, t1, t2 (a hash of the text), place, h1, h2: each line of ``least`` code points or more, without white space."""
    rows = docs.select(quoted("doc_id").alias("doc_id"), text_or_empty().alias("text"))
    lines = rows.select("doc_id", *_text_hash(), F.posexplode(F.split("text", "\n")).alias("place", "line")).where(F.length("line") >= least)
    keys = lines.select("doc_id", "t1", "t2", "place", line_key(F.col("line")).alias("key")).where(F.length("key") >= least)
    return keys.select("doc_id", "t1", "t2", "place", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(0x7DE), F.col("key")).alias("h2"))


def _text_hash() -> list[Column]:
    return [F.xxhash64("text").alias("t1"), F.xxhash64(F.lit(0x7DE), F.col("text")).alias("t2")]


def without_repeated_lines(docs: DataFrame, least: int = 40, copies: int = 5, batches: int = 4, fanout: int = 3) -> DataFrame:
    """doc_id, the text without repeated lines, n_lines (before) and n_dropped, one row per document."""
    spark = docs.sparkSession
    held = line_hashes(docs, least)
    # one row for each hash and document: a document counts once, however often it holds a line
    held = materialise(held.groupBy("doc_id", "t1", "t2", *HASH).agg(F.collect_set("place").alias("places")), "lines")
    cuts = held.stat.approxQuantile("doc_id", [k / batches for k in range(1, batches)], 0.01) if held.schema["doc_id"].dataType.typeName() in ("long", "integer", "short", "byte") else []
    index = LineRuns(spark, fanout=fanout)
    for part in id_ranges(held, sorted(set(map(int, cuts)), reverse=True)):
        index.add(part.select(*HASH, "doc_id"))
    frequent = materialise(index.totals().where(F.col("n") >= copies).select(*HASH, "keeper"), "frequent-lines")
    index.close()
    dropped = held.join(frequent, HASH).where(~F.col("doc_id").eqNullSafe(F.col("keeper")))
    # in a row's result there is one place at most for each of its lines
    places = dropped.groupBy("doc_id", "t1", "t2").agg(F.array_sort(F.flatten(F.collect_list("places"))).alias("places"))
    places = materialise(places.withColumnsRenamed({"doc_id": "_doc_id", "t1": "_t1", "t2": "_t2"}), "dropped-lines")
    discard(held, frequent)
    rows = docs.select(quoted("doc_id").alias("doc_id"), text_or_empty().alias("text")).select("doc_id", "text", *_text_hash())
    same = F.col("doc_id").eqNullSafe(F.col("_doc_id")) & (F.col("t1") == F.col("_t1")) & (F.col("t2") == F.col("_t2"))
    joined = rows.join(places, same, "left").select("doc_id", "text", "places", F.when(F.col("places").isNotNull(), F.split("text", "\n")).alias("lines"))
    n_lines = F.length("text") - F.length(F.replace("text", F.lit("\n"), F.lit(""))) + 1
    return joined.select(
        "doc_id",
        F.when(F.col("places").isNull(), F.col("text")).otherwise(F.array_join(_kept(), "\n")).alias("text"),
        n_lines.cast("long").alias("n_lines"),
        F.when(F.col("places").isNull(), 0).otherwise(F.size("places")).cast("long").alias("n_dropped"),
    )


def id_ranges(rows: DataFrame, cuts: list[int]) -> list[DataFrame]:
    """The rows in ranges of doc_id, the largest first; null ids are in the last."""
    if not cuts:
        return [rows]
    parts = [rows.where(F.col("doc_id") > cuts[0])]
    parts += [rows.where((F.col("doc_id") > low) & (F.col("doc_id") <= high)) for high, low in zip(cuts, cuts[1:])]
    return [*parts, rows.where((F.col("doc_id") <= cuts[-1]) | F.col("doc_id").isNull())]


def _kept() -> Column:
    """The lines between the places that go, as one list: a slice before each place and one after the last."""
    def between(k: Column) -> Column:
        first = F.when(k == 0, 0).otherwise(F.get("places", k - 1) + 1)
        end = F.when(k == F.size("places"), F.size("lines")).otherwise(F.get("places", k))
        return F.slice("lines", first + 1, end - first)

    return F.flatten(F.transform(F.sequence(F.lit(0), F.size("places")), between))
