"""Geometries against a plain encoder, and texts and bytes that are none."""

import math
import random
import struct

import pyarrow as pa

from tidemark.functions import geometry

BAD = ["", "POINT", "POINT ()", "POINT (1)", "POINT (1 2 3)", "POINT (1 2, 3 4)", "POINT (1 2) x", "POINT (a b)", "POINT (1,2)", "LINESTRING ()", "LINESTRING (1 2,)", "POLYGON ()", "POLYGON (garbage)", "POLYGON ((0 0, 1 1) junk (2 2))", "POLYGON ((0 0, 1 1), )", "POLYGON ((0 0, 1 1)", "POLYGON (0 0, 1 1)", "CIRCLE (1 2)", "POINT (1e 2)", "POINT (1 2"]


def encoded(kind, rings, order="<"):
    body = struct.pack(order + "BI" if order == "<" else order + "BI", 1 if order == "<" else 0, kind)
    if kind == 3:
        body += struct.pack(order + "I", len(rings))
    for ring in rings:
        body += (b"" if kind == 1 else struct.pack(order + "I", len(ring))) + b"".join(struct.pack(order + "2d", *p) for p in ring)
    return body


def drawn(draw):
    kind = draw.randint(1, 3)
    x = lambda: draw.choice([0.0, -0.0, 1.0, -2.5, 0.1, 123456789.125, draw.uniform(-180, 180), 1e-7])
    ring = lambda n: [(x(), x()) for _ in range(n)]
    return kind, [ring(1)] if kind == 1 else [ring(draw.randint(1, 6))] if kind == 2 else [ring(draw.randint(1, 6)) for _ in range(draw.randint(1, 4))]


def number(x):
    return ("-0" if math.copysign(1, x) < 0 else "0") if x == 0 else str(int(x)) if x == int(x) else repr(x)


def written(kind, rings):
    text = ["(" + ", ".join(f"{number(x)} {number(y)}" for x, y in ring) + ")" for ring in rings]
    return geometry.KINDS[kind] + " " + (text[0] if kind < 3 else "(" + ", ".join(text) + ")")


def test_round_trips_of_both_byte_orders():
    draw = random.Random(3)
    shapes = [drawn(draw) for _ in range(300)]
    texts = geometry.to_wkt(pa.array([encoded(*s, order=draw.choice("<>")) for s in shapes])).to_pylist()
    back = geometry.to_wkb(pa.array(texts)).to_pylist()
    assert back == [encoded(*s) for s in shapes]
    plain = [t for t, s in zip(texts, shapes) if not any(abs(x) < 1e-4 and x for r in s[1] for p in r for x in p)]
    assert plain == [written(*s) for s in shapes if not any(abs(x) < 1e-4 and x for r in s[1] for p in r for x in p)]
    assert geometry.to_wkb(pa.array(["  point( -0   +1.50 ) ", "'LineString (1 2,\n3 .5)'"])).to_pylist() == [encoded(1, [[(-0.0, 1.5)]]), encoded(2, [[(1.0, 2.0), (3.0, 0.5)]])]


def test_what_is_none_gives_null():
    assert geometry.to_wkb(pa.array([*BAD, None, "POINT (1 2)"])).to_pylist() == [None] * (len(BAD) + 1) + [encoded(1, [[(1.0, 2.0)]])]
    whole = [encoded(*drawn(random.Random(n))) for n in range(60)]
    assert geometry.to_wkt(pa.array([w[:-1] for w in whole] + [b"", b"\x01", encoded(4, [[(1.0, 2.0)]]), b"\x01\x03\x00\x00\x00\xff\xff\xff\xff", b"\x01\x02\x00\x00\x00\xff\xff\xff\xff" + b"\x00" * 64, None])).to_pylist() == [None] * 66
    for f, kind in ((geometry.to_wkt, pa.binary()), (geometry.to_wkb, pa.string())):
        assert f(pa.array([], kind)).to_pylist() == [] and f(pa.array([None], kind)).to_pylist() == [None]
        assert len(f(pa.array([None, None, None], kind)[1:])) == 2


def test_a_malformed_text_is_an_error_of_its_row(spark):
    from pyspark.sql import functions as F

    rows = spark.createDataFrame([(1, "POINT (1 -0)"), (2, "POLYGON (garbage)"), (3, None)], "k int, t string")
    got = rows.select("k", geometry.wkb("t").alias("b")).select("k", geometry.wkt("b").alias("t"), F.octet_length("b").alias("n")).orderBy("k").collect()
    assert [tuple(r) for r in got] == [(1, "POINT (1 -0)", 21), (2, None, None), (3, None, None)]
