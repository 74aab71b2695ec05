"""Users' sources and sinks: ranges that are opened, and writes that leave no row twice."""

import os

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidemark.session import importable
from tidemark.sources import plugin


def squares(notes):
    """A user's source, which workers get by value."""

    class Squares(plugin.RangeSource):
        """The squares of 0 to 999 in ranges of 100, which notes each range that it opens."""

        schema, token = "token long, square long", "token"

        def __init__(self, notes):
            self.notes = notes

        def ranges(self):
            return [(a, a + 99) for a in range(0, 1000, 100)]

        def open(self, low, high):
            open(os.path.join(self.notes, f"{low}-{high}"), "w").close()
            n = range(low, high + 1)
            yield pa.RecordBatch.from_pydict({"token": pa.array(n, pa.int64()), "square": pa.array([x * x for x in n], pa.int64())})

    return Squares(notes)


def test_only_the_ranges_asked_for_are_opened(spark, tmp_path):
    plugin.register_source(importable(spark), "squares", squares(str(tmp_path)))
    for low, high, opened in ((250, 419, {"250-299", "300-399", "400-419"}), (7, 7, {"7-7"}), (5000, None, set()), (None, 120, {"0-99", "100-120"})):
        for f in os.listdir(tmp_path):
            os.remove(tmp_path / f)
        want = [n for n in range(1000) if (low is None or n >= low) and (high is None or n <= high)]
        assert sorted(r.token for r in plugin.range_rows(spark, "squares", low, high).collect()) == want
        assert set(os.listdir(tmp_path)) == opened
    read = plugin.range_rows(spark, "squares")
    assert read.where("token < 10").count() == 10 and read.count() == 1000


def test_attempts_that_were_lost_leave_no_row(spark, tmp_path):
    sink = plugin.ManifestSink(str(tmp_path / "t"), "token")
    source = plugin.ManifestSource(str(tmp_path / "t"), "token", "token long", 10)
    batch = lambda *n: iter([pa.RecordBatch.from_pydict({"token": pa.array(n, pa.int64())})])
    read = lambda: sorted(x for low, high in source.ranges() for b in source.open(low, high) for x in b.column(0).to_pylist())
    writer = plugin.SinkWriter(sink)
    lost, done, other = writer.write(batch(1, 2, 30)), writer.write(batch(1, 2, 30)), writer.write(batch(4))
    assert read() == []  # nothing is seen before the commit
    writer.commit([done, other, None, writer.write(iter([]))])
    assert read() == [1, 2, 4, 30]
    writer.abort([writer.write(batch(5))])
    assert read() == [1, 2, 4, 30] and lost.name != done.name


def test_a_table_goes_through_a_sink_and_back(spark, tmp_path):
    sink = plugin.ManifestSink(str(tmp_path / "t"), "token")
    plugin.register_sink(importable(spark), "kept", sink)
    plugin.register_source(spark, "kept_rows", plugin.ManifestSource(str(tmp_path / "t"), "token", "token long, v string", 25))
    rows = spark.range(100).selectExpr("id as token", "concat('v', id) as v").repartition(5)
    rows.write.format("kept").mode("append").save()
    with pytest.raises(Exception, match="token 50"):
        rows.withColumn("token", F.expr("if(token = 50, cast(raise_error('token 50') as long), token)")).write.format("kept").mode("append").save()
    got = spark.read.format("kept_rows").load()
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, rows.collect()))
    assert plugin.range_rows(spark, "kept_rows", 30, 40).count() == 11
