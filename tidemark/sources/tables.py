"""Origin and target tables: reading by token range or by keys, and writing versions of a target."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.filters import condition
from tidemark.functions.tokens import token60
from tidemark.operators.mapping import quoted
from tidemark.operators.merge import upsert


def read(spark: SparkSession, place: str, form: str = "parquet", **options: str) -> DataFrame:
    """A table of the catalog (form "table") or files of any of Spark's formats."""
    return spark.table(place) if form == "table" else spark.read.format(form).options(**options).load(place)


def range_scan(df: DataFrame, token: Column, low: int, high: int, columns: list[str] | None = None, where: str | None = None) -> DataFrame:
    """Rows whose token lies in [low, high], with ``token``."""
    rows = df.where(condition(where)) if where else df
    return rows.select(*(quoted(c) for c in columns or df.columns), token.alias("token")).where(F.col("token").between(low, high))


def rows_of(df: DataFrame, keys: DataFrame, key: list[str]) -> DataFrame:
    return df.join(keys.select(*map(quoted, key)), key, "left_semi")


def write_version(df: DataFrame, root: str, version: int, partition_key: list[str] | None = None, files: int | None = None, most_rows: int | None = None) -> str:
    """Writes the table's next version beside the others; readers switch when its path is recorded."""
    path = f"{root.rstrip('/')}/v={version}"
    out = df
    if partition_key:
        columns = [quoted(c) for c in partition_key]
        out = df.repartition(files, *columns) if files else df.repartition(*columns)
    writer = out.write
    if most_rows:
        writer = writer.option("maxRecordsPerFile", most_rows)
    writer.parquet(path)
    return path


class BucketedTable:
    """A keyed target as Parquet files in buckets by token: a folder ``_bucket=n`` for each. A write reads and replaces the buckets
    that hold its keys, by dynamic partition overwrite, whose files take the old ones' place when the job commits; other buckets are
    neither read nor written. Bucket sizes follow the table, so ``buckets`` is to grow with it: a bucket is one file, and the unit
    that a changed row rewrites."""

    def __init__(self, spark: SparkSession, root: str, key: list[str], buckets: int) -> None:
        self.spark, self.root, self.key, self.buckets = spark, root.rstrip("/"), key, buckets

    def _bucketed(self, df: DataFrame) -> DataFrame:
        """The rows with their bucket; a bucket's rows are in one task, which may have several buckets."""
        numbered = df.withColumn("_bucket", (token60(*self.key) % self.buckets).cast("int"))
        return numbered.repartition("_bucket")

    def create(self, df: DataFrame) -> None:
        self._bucketed(df).write.partitionBy("_bucket").parquet(self.root)

    def read(self) -> DataFrame:
        return self.spark.read.parquet(self.root).drop("_bucket")

    def files(self) -> DataFrame:
        """The table's files and their rows."""
        return self.spark.read.parquet(self.root).groupBy(F.input_file_name().alias("file")).agg(F.count("*").alias("n_rows"))

    def upsert(self, writes: DataFrame, columns: list[str], fill_only: list[str] | None = None) -> list[int]:
        """Applies the writes (see ``merge.upsert``), which are read twice and whose keys have the table's types; gives the buckets
        rewritten, which are at most ``buckets`` numbers."""
        touched = sorted(r[0] for r in writes.select((token60(*self.key) % self.buckets).cast("int")).distinct().collect())
        if touched:
            before = self.spark.read.parquet(self.root).where(F.col("_bucket").isin(*touched)).drop("_bucket")
            after = self._bucketed(upsert(before, writes, self.key, columns, fill_only))
            after.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("_bucket").parquet(self.root)
        return touched
