"""Users' row sources and sinks as Spark data sources.

A ``RangeSource`` gives rows by token range; ``register_source`` makes it a format of ``spark.read``. Each range is one of Spark's
partitions. Bounds of the token are options of the scan (``range_rows``): ranges outside them are never opened, and those across are
cut. They aren't taken from Spark's own filter pushdown, which in Spark 4.1 keeps one query's bounds for the next query on the same
frame that has none, and so loses its rows.

A ``RangeSink`` takes the rows of tasks; ``register_sink`` makes it a format of ``df.write``. Each attempt of a task writes beside all
others and names what it wrote; only when all tasks have ended are the names of the attempts that counted published, in one step, so
an attempt that was lost or repeated leaves no row. ``ManifestSink`` and ``ManifestSource`` keep such a table as Parquet files and
manifests in a folder of any file system that pyarrow knows.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import datasource as D
from pyspark.sql.types import StructType


class RangeSource:
    """What a user writes to read rows: the schema (DDL), the name of the token column, ranges, and the rows of a range."""

    schema: str
    token: str

    def ranges(self) -> list[tuple[int, int]]:
        """Ranges (both ends included) that hold all rows, one for each task; they don't overlap."""
        raise NotImplementedError

    def open(self, low: int, high: int) -> Iterator[pa.RecordBatch]:
        """The rows whose token lies in [low, high], in the schema's columns."""
        raise NotImplementedError


class RangeSink:
    """What a user writes to store rows."""

    def write(self, attempt: str, batches: Iterator[pa.RecordBatch]) -> str | None:
        """Stores the rows of one attempt of a task where no reader looks, under names that hold ``attempt``; gives a name for them
        (None: there were no rows)."""
        raise NotImplementedError

    def publish(self, names: list[str]) -> None:
        """Makes what these names stand for part of the table, all at once."""
        raise NotImplementedError

    def discard(self, names: list[str]) -> None:
        """Removes what these names stand for; the write was given up."""


@dataclass
class TokenRange(D.InputPartition):
    low: int
    high: int


class RangeReader(D.DataSourceReader):
    def __init__(self, source: RangeSource, low: int | None, high: int | None) -> None:
        self.source, self.low, self.high = source, low, high

    def partitions(self) -> list[TokenRange]:
        cut = [(low if self.low is None else max(low, self.low), high if self.high is None else min(high, self.high)) for low, high in self.source.ranges()]
        return [TokenRange(low, high) for low, high in cut if low <= high] or [TokenRange(0, -1)]

    def read(self, partition: TokenRange) -> Iterator[pa.RecordBatch]:
        if partition.low <= partition.high:
            yield from self.source.open(partition.low, partition.high)


@dataclass
class Written(D.WriterCommitMessage):
    name: str | None


class SinkWriter(D.DataSourceArrowWriter):
    def __init__(self, sink: RangeSink) -> None:
        self.sink = sink

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        return Written(self.sink.write(uuid.uuid4().hex, iterator))

    def commit(self, messages: list[Written | None]) -> None:
        self.sink.publish([m.name for m in messages if m and m.name])

    def abort(self, messages: list[Written | None]) -> None:
        self.sink.discard([m.name for m in messages if m and m.name])


def register_source(spark: SparkSession, form: str, source: RangeSource) -> None:
    """Makes the source a format: ``spark.read.format(form).load()``, with the options low and high for a part of the ring."""

    class Source(D.DataSource):
        @classmethod
        def name(cls) -> str:
            return form

        def schema(self) -> str:
            return source.schema

        def reader(self, schema: StructType) -> RangeReader:
            low, high = (int(self.options[n]) if n in self.options else None for n in ("low", "high"))
            return RangeReader(source, low, high)

    spark.dataSource.register(Source)


def range_rows(spark: SparkSession, form: str, low: int | None = None, high: int | None = None) -> DataFrame:
    """The source's rows whose token lies in [low, high]."""
    bounds = {n: str(x) for n, x in (("low", low), ("high", high)) if x is not None}
    return spark.read.format(form).options(**bounds).load()


def register_sink(spark: SparkSession, form: str, sink: RangeSink) -> None:
    """Makes the sink a format: ``df.write.format(form).mode("append").save()``."""

    class Sink(D.DataSource):
        @classmethod
        def name(cls) -> str:
            return form

        def writer(self, schema: StructType, overwrite: bool) -> SinkWriter:
            if overwrite:
                raise ValueError("rows can only be appended")
            return SinkWriter(sink)

    spark.dataSource.register(Sink)


def _place(root: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(root if "://" in root else "file://" + root.removeprefix("file:"))


class ManifestSink(RangeSink):
    """Parquet files of a table in a folder, each a range of a token column, listed by manifests: one for each write."""

    def __init__(self, root: str, token: str) -> None:
        self.root, self.token = root, token

    def write(self, attempt: str, batches: Iterator[pa.RecordBatch]) -> str | None:
        files, root = _place(self.root)
        name, writer, low, high, n = f"{attempt}.parquet", None, None, None, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            if writer is None:
                files.create_dir(root, recursive=True)
                writer = pq.ParquetWriter(files.open_output_stream(f"{root}/{name}"), batch.schema)
            ends = pc.min_max(batch.column(self.token))
            low = ends["min"].as_py() if low is None else min(low, ends["min"].as_py())
            high = ends["max"].as_py() if high is None else max(high, ends["max"].as_py())
            n += batch.num_rows
            writer.write_batch(batch)
        if writer is None:
            return None
        writer.close()
        return json.dumps({"file": name, "low": low, "high": high, "rows": n})

    def publish(self, names: list[str]) -> None:
        files, root = _place(self.root)
        files.create_dir(f"{root}/manifests", recursive=True)
        part = f"{root}/manifests/.{uuid.uuid4().hex}"
        with files.open_output_stream(part) as out:
            out.write(("\n".join(names)).encode())
        files.move(part, part.replace("/.", "/m-"))  # what readers see appears in one step

    def discard(self, names: list[str]) -> None:
        files, root = _place(self.root)
        for name in names:
            files.delete_file(f"{root}/{json.loads(name)['file']}")


class ManifestSource(RangeSource):
    """Reads what ``ManifestSink`` has published: tasks by ranges of ``step`` tokens, of which each opens the files that meet it."""

    def __init__(self, root: str, token: str, schema: str, step: int) -> None:
        self.root, self.token, self.schema, self.step = root, token, schema, step

    def listed(self) -> list[dict]:
        files, root = _place(self.root)
        found = files.get_file_info(fs.FileSelector(f"{root}/manifests", allow_not_found=True))
        lines = [files.open_input_stream(f.path).read().decode().split("\n") for f in found if f.base_name.startswith("m-")]
        return [json.loads(x) for part in lines for x in part if x]

    def ranges(self) -> list[tuple[int, int]]:
        listed = self.listed()
        if not listed:
            return []
        low, high = min(x["low"] for x in listed), max(x["high"] for x in listed)
        return [(a, min(a + self.step - 1, high)) for a in range(low, high + 1, self.step)]

    def open(self, low: int, high: int) -> Iterator[pa.RecordBatch]:
        files, root = _place(self.root)
        for x in self.listed():
            if x["low"] <= high and x["high"] >= low:
                for batch in pq.ParquetFile(files.open_input_file(f"{root}/{x['file']}")).iter_batches():
                    at = batch.column(self.token)
                    kept = batch.filter(pc.and_(pc.greater_equal(at, low), pc.less_equal(at, high)))
                    if kept.num_rows:
                        yield kept
