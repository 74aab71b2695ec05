"""Media columns: TIFF files in a binary column.

``tiff_pages`` walks the image directories of every file, decodes strips and tiles (none, PackBits, LZW, deflate), undoes the
predictors (horizontal differences, floating point), unpacks samples of 1, 2 and 4 bits to bytes, and gives one row per page.
``store_bytes`` writes payloads as 8-bit grey images, 64 samples wide, losslessly; ``stored_digests`` takes their page rows and
gives a row per file.

A null or empty file, or one that isn't a TIFF, gives one row with page null and an error text; what can't be decoded in a page
gives the page's row with an error text. Null texts are empty (one block of zeros). Repeated rows give repeated rows. Other
columns are ignored, whatever their names. An empty table gives an empty result.

Very long texts become pages of 4 MiB, each a row; texts are stored in slices of about ``SLICE_BYTES``, and a longer one by itself.
A file is one value, so its bytes and one page are in memory at a time.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import SLICE_BYTES, quoted, row_slices, text_or_empty, tidy

NONE, LZW, DEFLATE, DEFLATE_OLD, PACKBITS = 1, 5, 8, 32946, 32773
WIDTH = 64
#: Rows of 64 samples in one strip (64 KiB) and in one page (4 MiB).
STRIP_ROWS, PAGE_ROWS = 1024, 65536
#: Sizes of the format's field types, by number.
TYPE_SIZE = {1: 1, 2: 1, 3: 2, 4: 4, 5: 8, 6: 1, 7: 1, 8: 2, 9: 4, 10: 8, 11: 4, 12: 8}


def unpack_packbits(data: bytes) -> bytes:
    out, at = bytearray(), 0
    while at < len(data):
        n = data[at]
        if n < 128:
            out += data[at + 1 : at + 2 + n]
            at += n + 2
        else:
            if n > 128:
                out += data[at + 1 : at + 2] * (257 - n)
            at += 2 if n > 128 else 1
    return bytes(out)


def pack_packbits(data: bytes) -> bytes:
    out, at, literal = bytearray(), 0, bytearray()

    def flush() -> None:
        if literal:
            out.append(len(literal) - 1)
            out.extend(literal)
            literal.clear()

    while at < len(data):
        run = 1
        while run < 128 and at + run < len(data) and data[at + run] == data[at]:
            run += 1
        if run > 2:
            flush()
            out += bytes([257 - run, data[at]])
            at += run
        else:
            literal.append(data[at])
            at += 1
            if len(literal) == 128:
                flush()
    flush()
    return bytes(out)


def unpack_lzw(data: bytes) -> bytes:
    """Codes of 9 to 12 bits, high bit first; 256 clears the table, 257 ends."""
    base = [bytes([n]) for n in range(256)] + [b"", b""]
    table, width, held, bits, last = list(base), 9, 0, 0, None
    out = []
    for byte in data:
        held = held << 8 | byte
        bits += 8
        if bits < width:
            continue
        bits -= width
        code = held >> bits
        held &= (1 << bits) - 1
        if code == 257:
            break
        if code == 256:
            table, width, last = list(base), 9, None
            continue
        if last is None:
            entry = table[code]
        else:
            entry = table[code] if code < len(table) else last + last[:1]
            table.append(last + entry[:1])
        out.append(entry)
        last = entry
        width = 9 if len(table) < 511 else 10 if len(table) < 1023 else 11 if len(table) < 2047 else 12
    return b"".join(out)


def pack_lzw(data: bytes) -> bytes:
    out, held, bits = bytearray(), 0, 0
    table: dict[bytes, int] = {}
    width, following, word = 9, 258, b""

    def put(code: int) -> None:
        nonlocal held, bits
        held = held << width | code
        bits += width
        while bits >= 8:
            bits -= 8
            out.append(held >> bits & 255)
        held &= (1 << bits) - 1

    put(256)
    for n in range(len(data)):
        longer = word + data[n : n + 1]
        if len(longer) == 1 or longer in table:
            word = longer
            continue
        put(table[word] if len(word) > 1 else word[0])
        table[longer] = following
        following += 1
        if following == 4094:
            put(256)
            table, width, following = {}, 9, 258
        else:
            width = 9 if following < 512 else 10 if following < 1024 else 11 if following < 2048 else 12
        word = data[n : n + 1]
    if word:
        put(table[word] if len(word) > 1 else word[0])
        following += 1
        width = 9 if following < 512 else 10 if following < 1024 else 11 if following < 2048 else 12
    put(257)
    if bits:
        out.append(held << (8 - bits) & 255)
    return bytes(out)


def decompress(data: bytes, kind: int) -> bytes:
    if kind == NONE:
        return data
    if kind in (DEFLATE, DEFLATE_OLD):
        return zlib.decompress(data)
    if kind == PACKBITS:
        return unpack_packbits(data)
    if kind == LZW:
        return unpack_lzw(data)
    raise ValueError(f"compression {kind} is not supported")


def compress(data: bytes, kind: int) -> bytes:
    return {NONE: bytes, DEFLATE: lambda d: zlib.compress(d, 6), PACKBITS: pack_packbits, LZW: pack_lzw}[kind](data)


@dataclass
class Page:
    number: int
    width: int
    height: int
    bits: int
    samples: int
    compression: int
    pixels: np.ndarray | None
    error: str | None = None


def field_values(data: bytes, order: str, at: int) -> tuple[int, list]:
    tag, kind, n = struct.unpack_from(order + "HHI", data, at)
    size = TYPE_SIZE.get(kind, 1) * n
    start = at + 8 if size <= 4 else struct.unpack_from(order + "I", data, at + 8)[0]
    if start + size > len(data):
        raise ValueError(f"tag {tag} lies outside the file")
    letter = {1: "B", 3: "H", 4: "I", 6: "b", 8: "h", 9: "i", 11: "f", 12: "d"}.get(kind)
    return tag, list(struct.unpack_from(f"{order}{n}{letter}", data, start)) if letter else [data[start : start + size]]


def unpack_samples(data: bytes, bits: int, rows: int, samples: int) -> np.ndarray:
    """Samples of fewer than 8 bits as bytes, high bits first; every row begins with a byte of its own."""
    width = -(-samples * bits // 8)
    packed = np.frombuffer(data, "u1", rows * width).reshape(rows, width)
    flags = np.unpackbits(packed, axis=1).reshape(rows, width * 8 // bits, bits)
    return (flags << np.arange(bits - 1, -1, -1, dtype="u1")).sum(axis=2, dtype="u1")[:, :samples]


def undo_predictor(block: np.ndarray, predictor: int, order: str) -> np.ndarray:
    """block: rows x columns x samples of the stored type."""
    if predictor == 2:
        return np.cumsum(block, axis=1, dtype=block.dtype)
    if predictor == 3:
        rows, columns, samples = block.shape
        size = block.dtype.itemsize
        raw = np.cumsum(block.view("u1").reshape(rows, -1, samples), axis=1, dtype="u1").reshape(rows, size, columns * samples)
        return np.ascontiguousarray(raw.transpose(0, 2, 1)).view(f">f{size}").reshape(rows, columns, samples)
    return block


def read_page(data: bytes, order: str, at: int, number: int) -> tuple[Page, int]:
    count = struct.unpack_from(order + "H", data, at)[0]
    tags = dict(field_values(data, order, at + 2 + 12 * k) for k in range(count))
    following = struct.unpack_from(order + "I", data, at + 2 + 12 * count)[0]
    one = lambda tag, default: tags.get(tag, [default])[0]
    width, height = int(one(256, 0)), int(one(257, 0))
    bits, samples = int(one(258, 1)), int(one(277, 1))
    kind, predictor, planar = int(one(259, 1)), int(one(317, 1)), int(one(284, 1))
    page = Page(number, width, height, bits, samples, kind, None)
    try:
        form = {1: "u", 2: "i", 3: "f"}[int(one(339, 1))]
        if bits not in (1, 2, 4, 8, 16, 32, 64):
            raise ValueError(f"{bits} bits a sample are not supported")
        if bits < 8 and (predictor != 1 or form != "u"):
            raise ValueError(f"predictor {predictor} with {bits} bits a sample is not supported")
        dtype = np.dtype(f"{order}{form}{max(bits, 8) // 8}")
        tiled = 322 in tags
        across, down = (int(one(322, 0)), int(one(323, 0))) if tiled else (width, min(int(one(278, height)), height) or height)
        offsets, sizes = (tags[324], tags[325]) if tiled else (tags[273], tags[279])
        columns = -(-width // across) if tiled else 1
        rows = -(-height // down)
        planes = samples if planar == 2 else 1
        depth = 1 if planar == 2 else samples
        pixels = np.zeros((height, width, samples), dtype.newbyteorder("="))
        for k in range(rows * columns * planes):
            plane, place = divmod(k, rows * columns)
            row, column = divmod(place, columns)
            tall = down if tiled else min(down, height - row * down)
            raw = decompress(data[offsets[k] : offsets[k] + sizes[k]], kind)
            stored = unpack_samples(raw, bits, tall, across * depth) if bits < 8 else np.frombuffer(raw, dtype, tall * across * depth)
            block = undo_predictor(stored.reshape(tall, across, depth), predictor, order)
            y, x = row * down, column * across
            part = block[: height - y, : width - x]
            pixels[y : y + part.shape[0], x : x + part.shape[1], plane : plane + depth] = part
        page.pixels = pixels
    except (ValueError, KeyError, IndexError, zlib.error, struct.error) as e:
        page.error = str(e) or type(e).__name__
    return page, following


def read_tiff(data: bytes) -> Iterator[Page]:
    order = {b"II": "<", b"MM": ">"}.get(bytes(data[:2]))
    if order is None or len(data) < 8 or struct.unpack_from(order + "H", data, 2)[0] != 42:
        raise ValueError("not a TIFF file")
    at, seen = struct.unpack_from(order + "I", data, 4)[0], set()
    while at and at not in seen:
        seen.add(at)
        page, at = read_page(data, order, at, len(seen) - 1)
        yield page


def write_tiff(pages: list[np.ndarray], compression: int = DEFLATE, predictor: int = 1, strip_rows: int = STRIP_ROWS, tile: int | None = None) -> bytes:
    """Grey 8-bit pages (rows x columns), in strips or in square tiles."""
    out = bytearray(b"II*\0\0\0\0\0")
    link = 4
    for pixels in pages:
        height, width = pixels.shape
        if tile:
            padded = np.zeros((-(-height // tile) * tile, -(-width // tile) * tile), "u1")
            padded[:height, :width] = pixels
            blocks = [padded[y : y + tile, x : x + tile] for y in range(0, height, tile) for x in range(0, width, tile)]
        else:
            blocks = [pixels[y : y + strip_rows] for y in range(0, height, strip_rows)]
        offsets, sizes = [], []
        for block in blocks:
            if predictor == 2:
                block = np.diff(block, axis=1, prepend=np.zeros((len(block), 1), "u1")).astype("u1")
            raw = compress(np.ascontiguousarray(block).tobytes(), compression)
            offsets.append(len(out))
            sizes.append(len(raw))
            out += raw
        tags = [(256, 4, [width]), (257, 4, [height]), (258, 3, [8]), (259, 3, [compression]), (262, 3, [1]), (277, 3, [1]), (317, 3, [predictor])]
        tags += [(322, 4, [tile]), (323, 4, [tile]), (324, 4, offsets), (325, 4, sizes)] if tile else [(273, 4, offsets), (278, 4, [strip_rows]), (279, 4, sizes)]
        fields = []
        for tag, kind, values in sorted(tags):
            raw = struct.pack(f"<{len(values)}{'H' if kind == 3 else 'I'}", *values)
            if len(raw) > 4:
                out += b"\0" * (len(out) % 2)
                fields.append(struct.pack("<HHII", tag, kind, len(values), len(out)))
                out += raw
            else:
                fields.append(struct.pack("<HHI4s", tag, kind, len(values), raw))
        out += b"\0" * (len(out) % 2)
        struct.pack_into("<I", out, link, len(out))
        out += struct.pack("<H", len(fields)) + b"".join(fields)
        link = len(out)
        out += b"\0\0\0\0"
    return bytes(out)


class FeatureSums:
    """The feature of an image that is seen page by page: 64 bits in hex, one for each column of samples: whether its mean lies
    above the mean of all; then mean and spread."""

    def __init__(self) -> None:
        self.columns, self.bins, self.size = np.zeros(WIDTH, "i8"), np.zeros(16, "i8"), 0

    def add(self, samples: np.ndarray) -> None:
        grey = samples.reshape(-1, WIDTH) if samples.size % WIDTH == 0 else np.zeros((0, WIDTH), "u1")
        self.columns += grey.sum(axis=0, dtype="i8")
        self.bins += np.bincount(grey.ravel() >> 4, minlength=16)
        self.size += grey.size

    def text(self) -> str:
        size = max(self.size, 1)
        bits = np.packbits((self.columns * WIDTH > self.columns.sum()).astype("u1")).tobytes().hex()
        spread = int(self.bins.max() * 1000 // size) if self.size else 1000
        return f"{bits}-{int(self.columns.sum() // size):03d}-{spread:04d}"


def feature(pixels: np.ndarray) -> str:
    sums = FeatureSums()
    sums.add(pixels.ravel())
    return sums.text()


def payload_of(text: str) -> bytes:
    raw = text.encode("utf-8", "surrogatepass")
    return raw + b"\0" * (-len(raw) % WIDTH or (WIDTH if not raw else 0))


def payload_tiff(payload: bytes, compression: int = DEFLATE, predictor: int = 2) -> bytes:
    image = np.frombuffer(payload, "u1").reshape(-1, WIDTH)
    return write_tiff([image[k : k + PAGE_ROWS] for k in range(0, len(image), PAGE_ROWS)], compression, predictor)


def store_bytes(docs: DataFrame, compression: int = DEFLATE, predictor: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_bytes, media): every text's bytes, filled up with zeros, as a TIFF file."""
    kind = dict(docs.dtypes)[id_col]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, end in row_slices(batch.column(1)):
                part = batch.slice(first, end - first)
                texts = part.column(1).to_pylist()
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([len(t.encode("utf-8", "surrogatepass")) for t in texts], pa.int64()), pa.array([payload_tiff(payload_of(t), compression, predictor) for t in texts], pa.binary())],
                    ["id", "n_bytes", "media"],
                )

    stored = docs.select(quoted(id_col).alias("id"), text_or_empty(text_col).alias("text")).mapInArrow(tidy(run), f"id {kind}, n_bytes long, media binary")
    return stored.withColumnRenamed("id", id_col)


def tiff_pages(files: DataFrame, id_col: str = "doc_id", media_col: str = "media", keep: list[str] | None = None) -> DataFrame:
    """One row per page: id, page, width, height, bits, samples, compression, pixels (rows in turn), feature, error, the file's
    columns in ``keep``, ``n_pages`` and, in the row of its last page, ``media_bytes`` and ``media_sha256``. A file's rows stand
    together in the order of its pages."""
    keep = keep or []
    names = ["page", "width", "height", "bits", "samples", "compression", "pixels", "feature", "error", "n_pages", "media_bytes", "media_sha256"]
    kinds = [pa.int32()] * 6 + [pa.binary(), pa.string(), pa.string(), pa.int32(), pa.int64(), pa.string()]
    frame = files.select(quoted(id_col), quoted(media_col), *map(quoted, keep))
    kept = [f"k{n}" for n in range(len(keep))]
    kept_kinds = "".join(f", {k} {kind}" for k, (_, kind) in zip(kept, frame.dtypes[2:], strict=True))
    schema = f"id {frame.dtypes[0][1]}, page int, width int, height int, bits int, samples int, compression int, pixels binary, feature string, error string, n_pages int, media_bytes long, media_sha256 string{kept_kinds}"

    def rows(media: bytes | None) -> Iterator[tuple]:
        data = media or b""
        last = None
        try:
            for p in read_tiff(data):
                if last is not None:
                    yield (*last, None, None, None)
                eight = p.pixels is not None and p.pixels.dtype == np.uint8
                last = p.number, p.width, p.height, p.bits, p.samples, p.compression, None if p.pixels is None else p.pixels.tobytes(), feature(p.pixels) if eight else None, p.error
        except (ValueError, struct.error) as e:
            if last is not None:
                yield (*last, None, None, None)
            last = (None,) * 8 + (str(e),)
        if last is not None:
            yield (*last, None if last[0] is None else last[0] + 1, len(data), hashlib.sha256(data).hexdigest())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held, size = [], 0

            def out() -> pa.RecordBatch:
                of = pa.array([n for n, _ in held])
                columns = [pa.array(c, k) for c, k in zip(zip(*(row for _, row in held), strict=True), kinds, strict=True)]
                return pa.RecordBatch.from_arrays([batch.column(0).take(of), *columns, *(c.take(of) for c in batch.columns[2:])], ["id", *names, *kept])

            for n in range(batch.num_rows):
                for row in rows(batch.column(1)[n].as_py()):
                    held.append((n, row))
                    size += len(row[6] or b"")
                    if size > SLICE_BYTES:
                        yield out()
                        held, size = [], 0
            if held:
                yield out()

    return frame.toDF("id", "media", *kept).mapInArrow(tidy(run), schema).withColumnRenamed("id", id_col).withColumnsRenamed(dict(zip(kept, keep, strict=True)))


def stored_digests(stored: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Per stored file (id, n_bytes, media): its pages, read back, and their digests."""
    return page_digests(tiff_pages(stored, id_col, keep=["n_bytes"]), id_col)


def page_digests(pages: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Per stored file, from its page rows (``tiff_pages`` with n_bytes kept): sizes, digests of the bytes read back, the feature.

    A file's pages stand together, so its digests run on from page to page, and no file is put together again."""
    kind = dict(pages.dtypes)[id_col]
    schema = f"id {kind}, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string, n_pages int"
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int32()]
    names = ["n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature", "n_pages"]
    columns = ["page", "pixels", "n_bytes", "n_pages", "media_bytes", "media_sha256", "error"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest, size, tail, sums = hashlib.sha256(), 0, b"", FeatureSums()
        for batch in batches:
            found, of = [], []
            for n, (page, pixels, n_bytes, n_pages, media_bytes, media_sha256, error) in enumerate(zip(*(batch.column(c).to_pylist() for c in columns), strict=True)):
                if error:
                    raise ValueError(f"a stored file can't be read back: {error}")
                digest.update(pixels)
                size += len(pixels)
                tail = (tail + pixels[-WIDTH:])[-WIDTH:]
                sums.add(np.frombuffer(pixels, "u1"))
                if n_pages is not None:
                    found.append((n_bytes, size, digest.hexdigest(), zlib.crc32(tail), media_bytes, media_sha256, sums.text(), n_pages))
                    of.append(n)
                    digest, size, tail, sums = hashlib.sha256(), 0, b"", FeatureSums()
            if found:
                yield pa.RecordBatch.from_arrays([batch.column("id").take(pa.array(of)), *(pa.array(c, k) for c, k in zip(zip(*found, strict=True), kinds, strict=True))], ["id", *names])

    return pages.select(quoted(id_col).alias("id"), *columns).mapInArrow(tidy(run), schema).withColumnRenamed("id", id_col)
