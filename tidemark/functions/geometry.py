"""Points, lines and polygons between WKB and WKT, by numpy and Arrow kernels over whole columns.

WKB of either byte order is read, and little-endian WKB written. A text is read strictly: a keyword, parentheses, and pairs of numbers
apart by white space, points and rings by commas; quotes around it are allowed. Anything else, and a WKB that ends early or is of
another kind, gives null, which the conversion turns into an error of its row. Numbers keep their sign, that of -0 too.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql.functions import arrow_udf
from pyspark.sql.types import BinaryType, StringType

KINDS = {1: "POINT", 2: "LINESTRING", 3: "POLYGON"}
_NUMBER = r"[+-]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?|[+-]?(?i:nan|inf)"
_PAIR = rf"\s*(?:{_NUMBER})\s+(?:{_NUMBER})\s*"
_POINTS = rf"{_PAIR}(?:,{_PAIR})*"
_RING = rf"\s*\({_POINTS}\)\s*"
#: What a text of each kind looks like, without white space and quotes at its ends.
_FORMS = {1: rf"^(?i:point)\s*\({_PAIR}\)$", 2: rf"^(?i:linestring)\s*\({_POINTS}\)$", 3: rf"^(?i:polygon)\s*\({_RING}(?:,{_RING})*\)$"}


def _integers(data: np.ndarray, at: np.ndarray, big: np.ndarray) -> np.ndarray:
    """Unsigned 32-bit integers at these places of the bytes."""
    four = data[at[:, None] + np.arange(4)]
    four = np.where(big[:, None], four[:, ::-1], four)
    return np.ascontiguousarray(four).view("<u4").ravel().astype("i8")


def _ranged(starts: np.ndarray, counts: np.ndarray, step: int) -> np.ndarray:
    """start, start + step, ... for each start, ``counts`` of them."""
    total = np.cumsum(counts) - counts
    return np.repeat(starts - total * step, counts) + step * np.arange(int(counts.sum()))


def _rings(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of each row its kind (0: none) and byte order; of all rings their rows, ascending, first bytes and numbers of points."""
    size = ends - starts
    data = np.concatenate([data, np.zeros(16, "u1")])
    usable = size >= 5
    at = np.where(usable, starts, 0)
    big = data[at] != 1
    kind = np.where(usable, _integers(data, at + 1, big), 0)
    kind[(kind > 3) | ((kind == 1) & (size < 21)) | ((kind > 1) & (size < 9))] = 0
    place = np.where(kind == 3, starts + 9, starts + 5)
    left = np.where(kind == 3, _integers(data, np.where(kind == 3, starts + 5, 0), big), (kind > 0).astype("i8"))
    kind[(kind == 3) & (left > (size - 9) // 4)] = 0
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    turn = 0
    while len(rows := np.flatnonzero((kind > 0) & (left > turn))):  # the rows that have a ring of this number
        point = kind[rows] == 1
        room = ends[rows] - place[rows]
        fits = point | (room >= 4)
        n = np.where(point, 1, _integers(data, np.where(fits & ~point, place[rows], 0), big[rows]))
        first = place[rows] + np.where(point, 0, 4)
        fits &= n <= (ends[rows] - first) // 16
        kind[rows[~fits]] = 0
        found.append((rows[fits], first[fits], n[fits]))
        place[rows] = np.where(fits, first + 16 * n, ends[rows])
        turn += 1
    if not found:
        none = np.zeros(0, "i8")
        return kind, big, none, none, none
    rows, first, n = (np.concatenate(part) for part in zip(*found, strict=True))
    order = np.argsort(rows, kind="stable")
    order = order[kind[rows[order]] > 0]
    return kind, big, rows[order], first[order], n[order]


def _offsets(counts: np.ndarray) -> pa.Array:
    return pa.array(np.concatenate([[0], np.cumsum(counts)]).astype("i4"))


def to_wkt(column: pa.Array) -> pa.Array:
    """The texts of a binary column."""
    column = column.cast(pa.large_binary())
    filled = pc.fill_null(column, b"")
    offsets, data = np.frombuffer(filled.buffers()[1], "i8")[filled.offset : filled.offset + len(filled) + 1], filled.buffers()[2]
    data = np.frombuffer(data, "u1") if data is not None else np.zeros(0, "u1")
    kind, big, rows, first, n = _rings(data, offsets[:-1].astype("i8"), offsets[1:].astype("i8"))
    at = _ranged(first, n, 16)
    raw = data[at[:, None] + np.arange(16)].reshape(-1, 2, 8) if len(at) else np.zeros((0, 2, 8), "u1")
    raw = np.where(np.repeat(big[rows], n)[:, None, None], raw[:, :, ::-1], raw)
    numbers = pa.array(np.ascontiguousarray(raw).view("<f8").reshape(-1, 2).ravel()).cast(pa.string())
    pairs = pc.binary_join_element_wise(numbers.take(pa.array(np.arange(0, len(numbers), 2))), numbers.take(pa.array(np.arange(1, len(numbers), 2))), " ")
    rings = pc.binary_join(pa.ListArray.from_arrays(_offsets(n), pairs), ", ")
    rings = pc.binary_join_element_wise("(", rings, ")", "")
    bodies = pc.binary_join(pa.ListArray.from_arrays(_offsets(np.bincount(rows, minlength=len(kind))), rings), ", ")
    bodies = pc.if_else(pa.array(kind == 3), pc.binary_join_element_wise("(", bodies, ")", ""), bodies)
    names = pa.array([None, *KINDS.values()]).take(pa.array(kind))
    return pc.if_else(pc.and_(column.is_valid(), pa.array(kind > 0)), pc.binary_join_element_wise(names, bodies, " "), pa.scalar(None, pa.string()))


def to_wkb(column: pa.Array) -> pa.Array:
    """The little-endian WKB of a column of texts."""
    texts = pc.utf8_trim(pc.utf8_trim(pc.utf8_trim_whitespace(pc.fill_null(column.cast(pa.string()), "")), "'"), " \t\r\n")
    kind = np.zeros(len(texts), "i8")
    for k, form in _FORMS.items():
        kind[pc.match_substring_regex(texts, form).to_numpy(zero_copy_only=False)] = k
    good = np.flatnonzero(kind)
    bodies = pc.replace_substring_regex(texts.take(pa.array(good)), r"^\w+[\s(]*|[\s)]*$", "")
    ring_lists = pc.split_pattern_regex(bodies, r"\)\s*,\s*\(")
    point_lists = pc.split_pattern(ring_lists.flatten(), ",")
    points = pc.utf8_trim_whitespace(point_lists.flatten())
    numbers = pc.split_pattern_regex(points, r"\s+").flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)
    n_rings = ring_lists.value_lengths().to_numpy(zero_copy_only=False).astype("i8")
    n = point_lists.value_lengths().to_numpy(zero_copy_only=False).astype("i8")
    kinds = kind[good]
    of_ring = np.repeat(np.arange(len(good)), n_rings)
    head = np.where(kinds[of_ring] == 1, 0, 4)
    ring_size = head + 16 * n
    sizes = np.zeros(len(texts), "i8")
    sizes[good] = 5 + 4 * (kinds == 3) + np.bincount(of_ring, ring_size, len(good)).astype("i8")
    starts = np.concatenate([[0], np.cumsum(sizes)])
    out = np.zeros(int(starts[-1]), "u1")
    begin = starts[good]
    put = lambda at, values: out.__setitem__(at[:, None] + np.arange(4), values.astype("<u4").reshape(-1, 1).view("u1"))
    out[begin] = 1
    put(begin + 1, kinds)
    put(begin[kinds == 3] + 5, n_rings[kinds == 3])
    before = np.cumsum(ring_size) - ring_size
    first_ring = np.cumsum(n_rings) - n_rings
    ring_at = begin[of_ring] + 5 + 4 * (kinds[of_ring] == 3) + before - (before[first_ring][of_ring] if len(good) else 0)
    put(ring_at[head > 0], n[head > 0])
    out[_ranged(ring_at + head, n, 16)[:, None] + np.arange(16)] = numbers.astype("<f8").reshape(-1, 2).view("u1").reshape(-1, 16)
    valid = pc.and_(column.is_valid(), pa.array(kind > 0))
    whole = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(texts), [None, pa.py_buffer(starts.astype("i8").tobytes()), pa.py_buffer(out.tobytes())])
    return pc.if_else(valid, whole, pa.scalar(None, pa.large_binary())).cast(pa.binary())


@arrow_udf(StringType())
def wkt(column: pa.Array) -> pa.Array:
    return to_wkt(column)


@arrow_udf(BinaryType())
def wkb(column: pa.Array) -> pa.Array:
    return to_wkb(column)
