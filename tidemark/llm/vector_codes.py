"""Compression of vectors to codes of a few bits: a codebook for each part of the vectors, made by ball k-means in whole numbers.

Each component x becomes floor(scale * x). Vectors are cut into equal consecutive parts; each part position has a codebook, which
starts as that part of the vectors with the smallest ids. A round gives every part to the nearest entry of its codebook (squared
Euclidean distance, ties to the lower index) and then replaces each entry by its parts' mean, rounded down by component; an entry
without parts stays. After the rounds the parts are given once more.

The vectors are kept in blocks, one row each, in a table of the shared folder; with them stand their codes of the round before. In
each round a block's parts of one entry form a ball about that entry, whose radius is the distance of the farthest:

* An entry whose distance from the ball's centre is over twice the radius can't be nearest to any part of the ball; the others are
  the ball's neighbours. Without neighbours all parts stay.
* Parts nearer to the centre than half the way to the nearest neighbour are the stable core, and stay without looking elsewhere.
* The other parts lie in rings between the half ways to the neighbours, in the order of their distance. A part is compared with
  the neighbours whose half way is no farther than itself, and no others.

All comparisons are of whole numbers, and a bound that is just met counts as a candidate, so the codes are those of comparing every
part with every entry. A block's sums of parts by entry stand in a column of their own; only that column is read to make the next
codebooks, which are all that reaches the driver: parts x entries x components numbers, whatever the input.

Left out are vectors that are null, empty, hold null or non-finite components, have a length that isn't a multiple of ``parts`` or
differs from the length of the vector with the smallest id, or hold a component so large that sums of squares would leave 64 bits
(at 64 components from 32,768 on with a scale of 4,096). Null ids come after all others; vectors that share an id are taken in the
order of their components. Repeated rows count each. With fewer vectors than entries, a codebook has as many entries as there are
vectors. Other columns are ignored, whatever their names. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import discard, materialise, quoted, tidy

#: Vectors in a block at most.
BLOCK = 8192
Books = np.ndarray  # part, entry, component


def assign_by_balls(x: np.ndarray, book: np.ndarray, codes: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    """The nearest entry of each row of ``x`` and the squared distance. ``codes``: an entry for each row to start from, near ones
    save work; without them every row is compared with all entries."""
    if codes is None:
        best = np.zeros(len(x), "u1")
        least = ((x - book[0]) ** 2).sum(1)
        for n in range(1, len(book)):
            distance = ((x - book[n]) ** 2).sum(1)
            nearer = distance < least
            best[nearer], least[nearer] = n, distance[nearer]
        return best, least
    least = ((x - book[codes]) ** 2).sum(1)
    best = codes.copy()
    # an entry can only be as near as the centre if its distance from the centre is at most twice the part's: in squares, four times
    halfway = (((book[:, None] - book[None]) ** 2).sum(2) + 3) // 4
    order = np.argsort(codes, kind="stable")
    bounds = np.searchsorted(codes[order], np.arange(len(book) + 1))
    for centre in range(len(book)):
        ball = order[bounds[centre] : bounds[centre + 1]]
        if not len(ball):
            continue
        own = least[ball]
        radius = own.max()
        neighbours = np.array([n for n in np.argsort(halfway[centre], kind="stable") if n != centre and halfway[centre, n] <= radius], "i8")
        rings = np.searchsorted(halfway[centre, neighbours], own, "right")  # how many neighbours each part is compared with; 0: stable core
        for k, n in enumerate(neighbours.tolist()):
            near = ball[rings > k]
            distance = ((x[near] - book[n]) ** 2).sum(1)
            nearer = (distance < least[near]) | ((distance == least[near]) & (n < best[near]))
            best[near[nearer]], least[near[nearer]] = n, distance[nearer]
    return best, least


def _wide(raw: pa.Scalar, kind: str, *shape: int) -> np.ndarray:
    return np.frombuffer(raw.as_buffer(), kind).reshape(shape)


def _encode(vectors: np.ndarray, books: Books, codes: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    """Codes (rows x parts) and errors (rows) of a block (rows x parts x components)."""
    found = np.empty(vectors.shape[:2], "u1")
    error = np.zeros(len(vectors), "i8")
    for part in range(vectors.shape[1]):
        best, least = assign_by_balls(vectors[:, part].astype("i8"), books[part], None if codes is None else codes[:, part])
        found[:, part] = best
        error += least
    return found, error


def _sums(vectors: np.ndarray, codes: np.ndarray, entries: int) -> np.ndarray:
    """By part and entry, the sums of the components, and in the last place the number of parts."""
    rows, parts, size = vectors.shape
    out = np.zeros((parts, entries, size + 1), "i8")
    for part in range(parts):
        order = np.argsort(codes[:, part], kind="stable")
        key = codes[order, part]
        first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if rows else np.zeros(0, "i8")
        if rows:
            out[part, key[first], :size] = np.add.reduceat(vectors[order, part].astype("i8"), first, axis=0)
            out[part, key[first], size] = np.diff(np.append(first, rows))
    return out


def scaled(vectors: DataFrame, column: str, scale: int) -> DataFrame:
    """vec_id, label and whole components of the vectors that are kept by themselves: finite, and neither empty nor too large."""
    v = quoted(column)
    most = F.floor(F.sqrt(F.lit(float(1 << 60)) / F.size(v)))
    finite = F.forall(v, lambda x: F.coalesce(~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) * scale < most), F.lit(False)))
    rows = vectors.where(v.isNotNull() & (F.size(v) > 0)).where(finite)
    return rows.select(quoted("vec_id").alias("vec_id"), quoted("label").alias("label"), F.transform(v, lambda x: F.floor(x.cast("double") * scale).cast("long")).alias("q"))


def _blocks(rows: DataFrame) -> DataFrame:
    """The rows of each task in blocks: ids and labels as lists, components as one binary value."""
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, BLOCK):
                part = batch.slice(first, BLOCK)
                flat = part.column(2).flatten().to_numpy(zero_copy_only=False).astype("<i4")
                lists = [pa.ListArray.from_arrays(pa.array([0, part.num_rows], "i4"), pa.concat_arrays([part.column(k)])) for k in (0, 1)]
                yield pa.record_batch([*lists, pa.array([flat.tobytes()], pa.binary()), pa.array([None], pa.binary()), pa.array([None], pa.binary())], ["ids", "labels", "vectors", "codes", "sums"])

    return rows.mapInArrow(tidy(gather), f"ids array<{kinds['vec_id']}>, labels array<{kinds['label']}>, vectors binary, codes binary, sums binary")


def _round(blocks: DataFrame, books: Books) -> DataFrame:
    """The blocks with their codes by these codebooks, and the sums for the next ones."""
    parts, entries, size = books.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for n in range(batch.num_rows):
                vectors = _wide(batch.column(2)[n], "<i4", -1, parts, size)
                before = batch.column(3)[n]
                codes, _ = _encode(vectors, books, _wide(before, "u1", -1, parts) if before.is_valid else None)
                made = [pa.array([codes.tobytes()], pa.binary()), pa.array([_sums(vectors, codes, entries).astype("<i8").tobytes()], pa.binary())]
                yield pa.record_batch([*(batch.column(k).slice(n, 1) for k in range(3)), *made], batch.schema.names)

    return blocks.mapInArrow(tidy(run), blocks.schema)


def _next_books(blocks: DataFrame, books: Books) -> Books:
    """The means of each entry's parts, rounded down; entries without parts as they were."""
    parts, entries, size = books.shape

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(parts * entries * (size + 1), "i8")
        for batch in batches:
            for raw in batch.column(0):
                total += _wide(raw, "<i8", -1)
        yield pa.record_batch([pa.array(np.arange(len(total))), pa.array(total)], ["at", "total"])

    summed = blocks.select("sums").mapInArrow(tidy(add), "at long, total long").groupBy("at").agg(F.sum("total").alias("total"))
    total = np.zeros(parts * entries * (size + 1), "i8")
    for row in summed.collect():
        total[row.at] = row.total
    total = total.reshape(parts, entries, size + 1)
    count = total[:, :, size:]
    return np.where(count > 0, total[:, :, :size] // np.maximum(count, 1), books)


def _coded(blocks: DataFrame, books: Books, kinds: dict[str, str]) -> DataFrame:
    """One row per vector: its id, label, codes as a binary value and error."""
    parts, _, size = books.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for n in range(batch.num_rows):
                before = batch.column(3)[n]
                codes, error = _encode(_wide(batch.column(2)[n], "<i4", -1, parts, size), books, _wide(before, "u1", -1, parts) if before.is_valid else None)
                packed = pa.FixedSizeBinaryArray.from_buffers(pa.binary(parts), len(codes), [None, pa.py_buffer(codes.tobytes())])
                yield pa.record_batch([batch.column(0)[n].values, batch.column(1)[n].values, packed.cast(pa.binary()), pa.array(error)], ["vec_id", "label", "codes", "error"])

    return blocks.mapInArrow(tidy(run), f"vec_id {kinds['vec_id']}, label {kinds['label']}, codes binary, error long")


def codebooks_text(books: Books) -> str:
    """All components in decimals, by part, entry and place, joined by commas."""
    return ",".join(map(str, books.ravel().tolist()))


def compress(vectors: DataFrame, column: str = "embedding", parts: int = 8, entries: int = 16, rounds: int = 6, scale: int = 4096) -> tuple[DataFrame, Books | None]:
    """One row per vector kept (vec_id, label, codes: one byte a part, error), and the codebooks (part, entry, component), or None
    without vectors. ``entries`` are at most 256."""
    if not 0 < entries <= 256:
        raise ValueError("a code is one byte: entries must be 1 to 256")
    rows = scaled(vectors, column, scale).where(F.size("q") % parts == 0)
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}
    order: list[Column] = [F.col("vec_id").asc_nulls_last(), F.col("q")]
    least = rows.orderBy(*order).select(F.size("q").alias("width")).limit(1).collect()
    if not least:
        return vectors.sparkSession.createDataFrame([], f"vec_id {kinds['vec_id']}, label {kinds['label']}, codes binary, error long"), None
    width = least[0].width
    rows = rows.where(F.size("q") == width)
    first = [r.q for r in rows.orderBy(*order).limit(entries).collect()]
    books = np.array(first, "i8").reshape(len(first), parts, width // parts).swapaxes(0, 1).copy()
    blocks = materialise(_blocks(rows), "vectors")
    for n in range(rounds):
        before, blocks = blocks, materialise(_round(blocks, books), f"vectors-{n}")
        discard(before)
        books = _next_books(blocks, books)
    return _coded(blocks, books, kinds), books


def code_report(vectors: DataFrame, column: str = "embedding", **options: int) -> DataFrame:
    """One row per vector: its code in hexadecimals, its error, the sum of errors over its label, and a digest of the codebooks."""
    coded, books = compress(vectors, column, **options)
    digest = hashlib.sha256(codebooks_text(books).encode() if books is not None else b"").hexdigest()
    coded = materialise(coded, "codes")
    sums = coded.groupBy("label").agg(F.sum("error").alias("label_error")).withColumnRenamed("label", "_label")
    joined = coded.join(sums, F.col("label").eqNullSafe(F.col("_label")))
    return joined.select("vec_id", F.lower(F.hex("codes")).alias("code"), "error", "label_error", F.lit(digest).alias("codebooks_sha256"))
