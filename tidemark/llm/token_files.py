"""Token ids in fixed-width bit-packed files.

``write_token_files`` tokenizes a table, puts its rows in ascending id order over the files and stores every token id in the
fewest bits that hold the vocabulary. A file holds blocks of ``BLOCK`` ids, the blocks' offsets, the rows' ids and starts, and a
footer; any row's ids are unpacked by numpy from the blocks that it lies in. ``read_tokens`` gives the rows back as a Spark table, and ``TokenFile`` reads
single rows of one file.

Both are a Spark data source ("tidemark_tokens"): tasks write files of their own, and the manifest that the commit writes names
those of the attempts that succeeded, so that lost or repeated tasks leave nothing that is read.

The number of files follows the table's size and the cluster's cores, and stays below ``MOST_FILES`` (files then grow), so that
neither the bounds of the ranges nor the manifest grow beyond some megabytes. Paths are those of Arrow's file systems (local, s3,
gs, abfs, hdfs; s3a and dbfs are read as s3 and as the /dbfs mount).

Null texts are empty (the end id alone). Null ids come first; how many of a file's rows have one stands in its footer. Rows with the
same id stay apart, in table order. Other columns are ignored, whatever their names. An empty table gives a manifest without files.
Very long texts are tokenized in parts of about ``SLICE_BYTES`` and written as they come; a row's ids are one value when read.
"""

from __future__ import annotations

import io
import json
import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import asdict, dataclass

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage

from tidemark.llm.common import IdCoder, coder, give_back, quoted, row_slices, text_or_empty

MAGIC = b"TDMKTOK1"
BLOCK = 4096
#: Bytes of text that one file should get at most, unless that made more than MOST_FILES, and at least, if cores stand idle.
FILE_TEXT_BYTES, SMALL_FILE_TEXT_BYTES = 32_000_000, 2_000_000
MOST_FILES = 50_000


def bits_for(vocab_size: int) -> int:
    return max(1, int(vocab_size - 1).bit_length())


def pack_bits(ids: np.ndarray, bits: int) -> bytes:
    """Most significant bit first; the last byte is filled up with zeros."""
    if bits in (8, 16, 32):
        return ids.astype(f">u{bits // 8}").tobytes()
    shifts = np.arange(bits - 1, -1, -1, dtype="u4")
    return np.packbits(((ids.astype("u4")[:, None] >> shifts) & 1).astype("u1")).tobytes()


def unpack_bits(data: bytes, bits: int, n: int) -> np.ndarray:
    if bits in (8, 16, 32):
        return np.frombuffer(data, f">u{bits // 8}", n).astype("<u4")
    flags = np.unpackbits(np.frombuffer(data, "u1"), count=n * bits).reshape(n, bits)
    return (flags.astype("u4") << np.arange(bits - 1, -1, -1, dtype="u4")).sum(axis=1, dtype="u4")


def open_fs(path: str) -> tuple[pafs.FileSystem, str]:
    for ours, theirs in (("s3a://", "s3://"), ("s3n://", "s3://"), ("abfss://", "abfs://"), ("dbfs:/", "/dbfs/")):
        if path.startswith(ours):
            path = theirs + path[len(ours) :]
    return pafs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (pafs.LocalFileSystem(), path)


class TokenFile:
    """One file: its rows and their ids, each by itself or all in turn."""

    def __init__(self, source: io.RawIOBase | pa.NativeFile) -> None:
        self.source = source
        size = source.seek(0, 2)
        source.seek(size - 16)
        length, magic = struct.unpack("<q8s", source.read(16))
        if magic != MAGIC:
            raise ValueError("not a token file")
        source.seek(size - 16 - length)
        self.footer = json.loads(source.read(length))
        self.bits = self.footer["bits"]
        source.seek(self.footer["index_at"])
        rows = self.footer["rows"]
        self.block_at = np.frombuffer(source.read(8 * (self.footer["blocks"] + 1)), "<i8")
        self.doc_ids = np.frombuffer(source.read(8 * rows), "<i8")
        self.starts = np.frombuffer(source.read(8 * (rows + 1)), "<i8")

    def block(self, first: int, last: int) -> np.ndarray:
        """The ids of blocks first to last, that one left out."""
        n = min(last * BLOCK, self.footer["tokens"]) - first * BLOCK
        self.source.seek(int(self.block_at[first]))
        return unpack_bits(self.source.read(int(self.block_at[last] - self.block_at[first])), self.bits, n)

    def ids(self, row: int) -> np.ndarray:
        a, b = int(self.starts[row]), int(self.starts[row + 1])
        first = a // BLOCK
        return self.block(first, max(first, -(-b // BLOCK)))[a - first * BLOCK : b - first * BLOCK] if b > a else np.zeros(0, "<u4")

    def batches(self, tokens: int = 1_000_000) -> Iterator[tuple[int, int, np.ndarray]]:
        """Runs of rows (first, end, ids) of about so many tokens; a single row may hold more."""
        row, rows = 0, len(self.doc_ids)
        while row < rows:
            end = max(row + 1, int(np.searchsorted(self.starts, self.starts[row] + tokens, "right")) - 1)
            end = min(end, rows)
            a, b = int(self.starts[row]), int(self.starts[end])
            first = a // BLOCK
            yield row, end, self.block(first, -(-b // BLOCK))[a - first * BLOCK : b - first * BLOCK]
            row = end


@dataclass
class Written(WriterCommitMessage):
    name: str
    part: int
    rows: int
    tokens: int


class TokenWriter(DataSourceArrowWriter):
    """Tokenizes (doc_id, text) and writes the ids in the order in which the rows come."""

    def __init__(self, path: str, vocabulary: str, bits: int, end_id: int | None) -> None:
        self.path, self.vocabulary, self.bits, self.end_id = path, vocabulary, bits, end_id

    def encoded(self, batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, int, np.ndarray, np.ndarray]]:
        """Row ids, how many of them are null (these come first), row lengths and token ids of slices of rows."""
        encode = coder(IdCoder, self.vocabulary)
        for batch in batches:
            column = batch.column("doc_id").cast(pa.int64())
            ids, none = column.fill_null(0).to_numpy(zero_copy_only=False), column.is_null().to_numpy(zero_copy_only=False)
            for first, end in row_slices(batch.column("text")):
                codes, at = encode(batch.column("text").slice(first, end - first))
                if self.end_id is not None:
                    codes, at = np.insert(codes.astype("<u4"), at[1:], self.end_id), at + np.arange(len(at))
                yield ids[first:end], int(none[first:end].sum()), np.diff(at), codes

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        fs, root = open_fs(self.path)
        fs.create_dir(root, recursive=True)
        part = TaskContext.get().partitionId()
        name = f"part-{part:06d}-{uuid.uuid4().hex}.tok"
        doc_ids, lengths, rest = [np.zeros(0, "<i8")], [np.zeros(0, "<i8")], np.zeros(0, "<u4")
        tokens = nulls = 0
        with fs.open_output_stream(f"{root}/{name}") as out:
            out.write(MAGIC)
            for row_ids, none, sizes, codes in self.encoded(iterator):
                doc_ids.append(row_ids)
                nulls += none
                lengths.append(sizes)
                ids = np.concatenate([rest, codes])
                whole = len(ids) // BLOCK * BLOCK
                out.write(pack_bits(ids[:whole], self.bits))
                rest = ids[whole:]
                tokens += whole
            out.write(pack_bits(rest, self.bits))
            tokens += len(rest)
            index_at = len(MAGIC) + -(-tokens * self.bits // 8)
            sizes = np.concatenate(lengths)
            blocks = -(-tokens // BLOCK)
            out.write(np.minimum(len(MAGIC) + np.arange(blocks + 1) * (BLOCK * self.bits // 8), index_at).astype("<i8").tobytes())
            out.write(np.concatenate(doc_ids).astype("<i8").tobytes())
            out.write(np.concatenate([[0], np.cumsum(sizes)]).astype("<i8").tobytes())
            footer = json.dumps({"bits": self.bits, "block": BLOCK, "blocks": blocks, "rows": len(sizes), "null_rows": nulls, "tokens": tokens, "index_at": index_at}).encode()
            out.write(footer + struct.pack("<q8s", len(footer), MAGIC))
        if not len(sizes):
            fs.delete_file(f"{root}/{name}")
        give_back()
        return Written(name, part, len(sizes), tokens)

    def commit(self, messages: list[Written | None]) -> None:
        fs, root = open_fs(self.path)
        fs.create_dir(root, recursive=True)
        files = [asdict(m) for m in sorted((m for m in messages if m and m.rows), key=lambda m: m.part)]
        with fs.open_output_stream(f"{root}/_manifest.tmp") as out:
            out.write(json.dumps({"bits": self.bits, "block": BLOCK, "files": files}).encode())
        fs.move(f"{root}/_manifest.tmp", f"{root}/_manifest.json")

    def abort(self, messages: list[Written | None]) -> None:
        fs, root = open_fs(self.path)
        for m in messages:
            if m and m.rows:
                fs.delete_file(f"{root}/{m.name}")


@dataclass
class FilePart(InputPartition):
    name: str
    base: int


class TokenReader(DataSourceReader):
    def __init__(self, path: str, checksums: bool) -> None:
        self.path, self.checksums = path, checksums

    def partitions(self) -> list[FilePart]:
        fs, root = open_fs(self.path)
        with fs.open_input_stream(f"{root}/_manifest.json") as source:
            files = json.loads(source.read())["files"]
        bases = np.concatenate([[0], np.cumsum([f["tokens"] for f in files])]).astype(int).tolist()
        return [FilePart(f["name"], base) for f, base in zip(files, bases, strict=False)] or [FilePart("", 0)]

    def read(self, partition: FilePart) -> Iterator[pa.RecordBatch]:
        if not partition.name:
            return
        fs, root = open_fs(self.path)
        with fs.open_input_file(f"{root}/{partition.name}") as source:
            file = TokenFile(source)
            for first, end, ids in file.batches():
                doc_ids, starts = file.doc_ids[first:end], file.starts[first : end + 1]
                offsets = (starts - starts[0]) * 4
                raw = memoryview(ids.astype("<u4").tobytes())
                if self.checksums:
                    last = pa.array([zlib.crc32(raw[a:b]) for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)], pa.int64())
                else:
                    last = pa.Array.from_buffers(pa.binary(), end - first, [None, pa.py_buffer(offsets.astype("i4").tobytes()), pa.py_buffer(raw)])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(doc_ids, pa.int64(), mask=np.arange(first, end) < file.footer["null_rows"]), pa.array(starts[:-1] + partition.base, pa.int64()), pa.array(np.diff(starts), pa.int64()), last],
                    ["doc_id", "start", "n_tokens", "ids_crc32" if self.checksums else "ids"],
                )


class TokenSource(DataSource):
    """``df.write.format("tidemark_tokens").options(vocabulary=..., bits=...).save(path)`` and ``spark.read.format("tidemark_tokens").load(path)``."""

    @classmethod
    def name(cls) -> str:
        return "tidemark_tokens"

    def schema(self) -> str:
        return "doc_id long, start long, n_tokens long, " + ("ids_crc32 long" if self.options.get("ids") == "crc32" else "ids binary")

    def reader(self, schema) -> TokenReader:
        return TokenReader(self.options["path"], self.options.get("ids") == "crc32")

    def writer(self, schema, overwrite: bool) -> TokenWriter:
        end_id = self.options.get("end_id")
        return TokenWriter(self.options["path"], self.options["vocabulary"], int(self.options["bits"]), None if end_id is None else int(end_id))


def files_of(size: int, cores: int) -> int:
    """Into how many files a table of so many bytes of text goes."""
    wanted = max(-(-size // FILE_TEXT_BYTES), min(cores, size // SMALL_FILE_TEXT_BYTES))
    return max(1, min(wanted, MOST_FILES))


def write_token_files(docs: DataFrame, out: str, path: str, end_id: int | None = None, id_col: str = "doc_id", text_col: str = "text") -> None:
    """The texts' ids, in ascending id order over the files. Rows are ordered by ranges of (id, place in the table), so that many
    rows of one id don't meet in one task; the texts are shuffled once and tokenized where they arrive."""
    spark = docs.sparkSession
    spark.dataSource.register(TokenSource)
    size = docs.select(F.sum(F.octet_length(quoted(text_col).cast("string"))).alias("n")).first()["n"] or 0
    bits = bits_for(max(coder(IdCoder, path).vocab_size, (end_id or 0) + 1))
    rows = docs.select(quoted(id_col).cast("long").alias("doc_id"), text_or_empty(text_col).alias("text"), F.monotonically_increasing_id().alias("place"))
    ordered = rows.repartitionByRange(files_of(size, spark.sparkContext.defaultParallelism), "doc_id", "place").sortWithinPartitions("doc_id", "place")
    named = {"path": out, "vocabulary": path, "bits": bits} | ({} if end_id is None else {"end_id": end_id})
    ordered.select("doc_id", "text").write.format(TokenSource.name()).options(**named).mode("append").save()


def read_tokens(spark: SparkSession, path: str, ids: str = "ids") -> DataFrame:
    """Rows (doc_id, start: ids of all rows before, n_tokens) with ids (little-endian unsigned 32-bit integers), or with their
    checksum when ids = "crc32"."""
    spark.dataSource.register(TokenSource)
    return spark.read.format(TokenSource.name()).option("path", path).option("ids", ids).load()
