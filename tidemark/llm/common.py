"""What the operators of this subpackage share: scratch tables, null handling and a segment-wise tokenizer."""

from __future__ import annotations

import contextlib
import ctypes
import os
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import remove, scratch_path

#: Under this name a frame of ``materialise`` holds its table's path.
SCRATCH = "_tidemark_scratch"
#: Texts are handed to Python code in slices of about so many bytes, so that a task's memory doesn't follow the batch.
SLICE_BYTES = 500_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def quoted(name: str) -> Column:
    """A column by its exact name, whatever characters that has."""
    return F.col("`" + name.replace("`", "``") + "`")


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(quoted(name).cast("string"), F.lit(""))


def materialise(df: DataFrame, label: str) -> DataFrame:
    """The frame as a table in the shared folder, read back: lineage ends there, so a lost executor costs its tasks only."""
    path = scratch_path(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    stored = df.sparkSession.read.schema(df.schema).parquet(path)
    stored.__dict__[SCRATCH] = path
    return stored


def discard(*frames: DataFrame) -> None:
    """Deletes the tables of ``materialise`` that nothing reads any more; frames of other kinds are left alone."""
    for frame in frames:
        if path := frame.__dict__.get(SCRATCH):
            remove(frame.sparkSession, path)


def numbered(docs: DataFrame) -> DataFrame:
    """The table with columns c0, c1, ... so that no name of its own can clash with an operator's."""
    return docs.toDF(*(f"c{n}" for n in range(len(docs.columns))))


def renamed(numbered_docs: DataFrame, names: list[str]) -> DataFrame:
    """The columns c0, c1, ... under their own names again."""
    return numbered_docs.select(*(F.col(f"c{n}") for n in range(len(names)))).toDF(*names)


def tidy(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The function, giving memory back to the system when its partition is done: workers stay for the tasks of later stages."""

    def wrapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        give_back()

    return wrapped


def give_back() -> None:
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL(None).malloc_trim(0)


def row_slices(array: pa.Array, size: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Runs of rows (first, end) of a string or binary array, of about ``size`` bytes each."""
    offsets, _ = raw_bytes(array)
    first = 0
    while first < len(array):
        end = max(first + 1, int(np.searchsorted(offsets, offsets[first] + size, "right")) - 1)
        yield first, end
        first = end


def raw_bytes(array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets (from 0) and bytes of a string or binary array without nulls."""
    wide = pa.types.is_large_string(array.type) or pa.types.is_large_binary(array.type)
    _, offsets, data = array.buffers()
    if not len(array):
        return np.zeros(1, "i8"), np.zeros(0, "u1")
    at = np.frombuffer(offsets, "i8" if wide else "i4")[array.offset : array.offset + len(array) + 1].astype("i8")
    return at - at[0], (np.frombuffer(data, "u1") if data and data.size else np.zeros(0, "u1"))[at[0] : at[-1]]


# Where a text may be cut so that both vocabularies give the parts the tokens that the whole gives: before a space that follows a
# non-space, around a lone line break, and before a full stop or comma that follows a Latin letter or digit. What stands before is
# read from its last bytes; characters of the blocks that hold white space count as such.
_KIND = np.zeros(256, "u1")
_KIND[ord(" ")], _KIND[ord(".")], _KIND[ord(",")], _KIND[ord("\n")] = 1, 2, 2, 3
_SOLID = np.zeros(256, bool)
_SOLID[33:127] = True
_ALNUM = np.array([chr(b).isascii() and chr(b).isalnum() for b in range(256)])
_LEADS = np.zeros(256, bool)
_LEADS[0xC3:0xE0] = _LEADS[0xE4:0xF5] = True


def cut_places(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Ascending places at which segments begin. ``starts``: where rows begin."""
    at = np.flatnonzero(_KIND[data])
    at = at[at > 0]
    kind = _KIND[data[at]]
    back = [data[np.maximum(at - k, 0)] for k in range(1, 5)]
    inner = [(b & 0xC0) == 0x80 for b in back]
    pair, three = inner[0] & ~inner[1], inner[0] & inner[1] & ~inner[2]
    solid = _SOLID[back[0]] | (pair & _LEADS[back[1]]) | (three & _LEADS[back[2]]) | (inner[0] & inner[1] & inner[2] & _LEADS[back[3]])
    latin = _ALNUM[back[0]] | (pair & (back[1] >= 0xC3) & (back[1] <= 0xC8) & ~((back[1] == 0xC3) & ((back[0] == 0x97) | (back[0] == 0xB7))) & ~((back[1] == 0xC4) & (back[0] == 0xB0)))
    following = data[np.minimum(at + 1, len(data) - 1)]
    lone = (kind == 3) & solid & (at + 1 < len(data)) & (_SOLID[following] | _LEADS[following])
    flag = np.zeros(len(data) + 2, bool)
    flag[at[((kind == 1) & solid) | ((kind == 2) & latin) | lone]] = True
    flag[at[lone] + 1] = True
    flag[starts] = True
    return np.flatnonzero(flag[: len(data)])


_RANDOM = np.random.default_rng(0x7DE)
_BYTE_VALUE = _RANDOM.integers(1, 1 << 63, 256, "u8") * np.uint64(2) + np.uint64(1)
_STEP = np.uint64(0xD6E8FEB86659FD93)
_BACK = np.uint64(pow(int(_STEP), -1, 1 << 64))


class Powers:
    """The powers of the hash's step and of its inverse, modulo 2 to the 64, as far as they were needed."""

    up = down = np.ones(1, "u8")

    @classmethod
    def to(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(cls.up) < n:
            size = max(n, 1 << 20)
            cls.up, cls.down = (np.concatenate([[np.uint64(1)], np.cumprod(np.full(size - 1, step, "u8"))]).astype("u8") for step in (_STEP, _BACK))
        return cls.up[:n], cls.down[:n]


def segment_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes, never 0, of the segments' bytes and lengths."""
    up, down = Powers.to(len(data))
    sums = np.concatenate([[np.uint64(0)], np.cumsum(_BYTE_VALUE[data] * up, dtype="u8")])
    h = (sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype("u8") * np.uint64(0x9E3779B97F4A7C15)
    h ^= h >> np.uint64(31)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(29)
    return h | np.uint64(1)


_WEIGHTS = _RANDOM.integers(1, 1 << 32, 256, "u4")


def second_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """32-bit hashes of the segments' bytes by another rule: sums of random weights, and the first and last bytes by their places."""
    sums = np.concatenate([[np.uint32(0)], np.cumsum(_WEIGHTS[data], dtype="u4")])
    return (sums[ends] - sums[starts]) * np.uint32(0x9E3779B1) ^ data[starts].astype("u4") << np.uint32(11) ^ data[ends - 1].astype("u4") << np.uint32(21)


class SegmentCoder:
    """Maps texts to the concatenated codes of their segments (token ids, or token-count steps), by numpy over whole slices.

    Codes of segments are kept in a table of ``slots`` places, found by a 64-bit hash of the segment; the first segment of a
    place stays, others are coded anew for each slice. The memory is bounded by ``slots`` and ``most_units``. A segment is taken
    for the one that holds its place if all 64 bits of their hashes and a second hash of 32 bits are equal: by chance once in 2 to
    the 74 looks at a place, which is less than once in a thousand million runs over a hundred terabytes.
    """

    dtype = np.dtype("u1")

    def __init__(self, slots: int = 1 << 21, most_units: int = 8_000_000) -> None:
        self.slots, self.most_units = slots, most_units
        self.keys = np.zeros(slots, "u8")
        self.checks = np.zeros(slots, "u4")
        self.places = np.zeros(slots, "i4")
        self.sizes = np.zeros(slots, "u1")
        self.flat = np.zeros(1 << 20, self.dtype)
        self.used = 0

    def encode_segments(self, segments: list[str]) -> list[np.ndarray]:
        raise NotImplementedError

    def __call__(self, array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Codes of all rows, and where each row's begin (one more than rows)."""
        offsets, data = raw_bytes(array)
        codes, starts = [], [np.zeros(1, "i8")]
        done = 0
        for first, end in row_slices(array):
            a, b = int(offsets[first]), int(offsets[end])
            if end == first + 1 and b - a > 2 * SLICE_BYTES:
                parts = [self._run(data[x:y], np.zeros(1, "i8"))[0] for x, y in self._parts(data, a, b)]
                got, at = np.concatenate(parts), np.array([sum(map(len, parts))])
            else:
                got, at = self._run(data[a:b], offsets[first:end] - a)
            codes.append(got)
            starts.append(at + done)
            done += len(got)
        return np.concatenate([np.zeros(0, self.dtype), *codes]), np.concatenate(starts)

    def _parts(self, data: np.ndarray, a: int, b: int) -> Iterator[tuple[int, int]]:
        """A long text as parts of about a slice each, cut where segments begin."""
        while b - a > 2 * SLICE_BYTES:
            window = 1 << 12
            while True:
                cuts = cut_places(data[a + SLICE_BYTES : min(b, a + SLICE_BYTES + window)], np.zeros(0, "i8"))
                cuts = cuts[cuts >= 4]
                if len(cuts) or a + SLICE_BYTES + window >= b:
                    break
                window *= 4
            if not len(cuts):
                break
            yield a, a + SLICE_BYTES + int(cuts[0])
            a += SLICE_BYTES + int(cuts[0])
        yield a, b

    def _run(self, data: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Codes of the bytes, and where the codes of each row end. ``rows``: where rows begin."""
        if not len(data):
            return np.zeros(0, self.dtype), np.zeros(len(rows), "i8")
        starts = cut_places(data, rows[rows < len(data)])
        ends = np.append(starts[1:], len(data))
        hashes = segment_hashes(data, starts, ends)
        check = second_hashes(data, starts, ends)
        slot = (hashes >> np.uint64(30)).astype("i8") & (self.slots - 1)
        hit = (self.keys[slot] == hashes) & (self.checks[slot] == check)
        place, size = self.places[slot].astype("i8"), self.sizes[slot].astype("i8")
        flat = self.flat
        if not hit.all():
            new, first, back = np.unique(hashes[~hit], return_index=True, return_inverse=True)
            where = np.flatnonzero(~hit)[first]
            raw = data.tobytes()
            coded = self.encode_segments([raw[a:b].decode() for a, b in zip(starts[where].tolist(), ends[where].tolist(), strict=True)])
            sizes = np.array([len(c) for c in coded], "i8")
            more = np.concatenate(coded)
            at = self.used + np.cumsum(sizes) - sizes
            while len(flat) < self.used + len(more):
                flat = np.concatenate([flat, np.zeros(len(flat), self.dtype)])
            flat[self.used : self.used + len(more)] = more
            self.flat = flat
            place[~hit], size[~hit] = at[back], sizes[back]
            if self.used + len(more) <= self.most_units:
                slots = slot[where]
                free = (self.keys[slots] == 0) & (sizes < 256)
                self.keys[slots[free]] = new[free]
                # of two new segments for one place the later one wins, in all columns alike
                self.checks[slots[free]] = check[where][free]
                self.places[slots[free]] = at[free]
                self.sizes[slots[free]] = sizes[free]
                self.used += len(more)
        total = np.cumsum(size)
        codes = flat[np.repeat(place - (total - size), size) + np.arange(total[-1])]
        return codes, np.concatenate([[0], total])[np.searchsorted(starts, np.append(rows[1:], len(data)))]


_WORD = re.compile(r" ?[A-Za-zÀ-ÖØ-öø-įı-ɏ]{1,200}")


class IdCoder(SegmentCoder):
    """Token ids of a ``tokenizers`` file, as 16-bit integers, or 32-bit for large vocabularies."""

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.vocab_size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.dtype = np.dtype("<u2" if self.vocab_size <= 1 << 16 else "<u4")
        super().__init__()
        # A segment of Latin letters is one pre-token, so the library's model takes it directly, in the form that its steps give.
        letters = [*range(33, 127), *range(161, 173), *range(174, 256)]
        letter = {b: chr(b) for b in letters} | {b: chr(256 + n) for n, b in enumerate(b for b in range(256) if b not in set(letters))}
        self.letters = {ord(c): "".join(letter[b] for b in c.encode()) for c in map(chr, [32, *range(0xC0, 0x250)])}
        forms = (lambda s: s.translate(self.letters), lambda s: s.strip(" ").lower().translate(self.letters))
        probes = [" The", "Was", " \u00c9t\u00e9", "stra\u00dfe", " tHINgs"]
        self.form = next((f for f in forms if all([t.id for t in self.tokenizer.model.tokenize(f(p))] == self.tokenizer.encode(p, add_special_tokens=False).ids for p in probes)), None)

    def encode_segments(self, segments: list[str]) -> list[np.ndarray]:
        out: list = [None] * len(segments)
        rest = []
        tokenize, form, plain = self.tokenizer.model.tokenize, self.form, _WORD.fullmatch
        for n, segment in enumerate(segments):
            if form and plain(segment):
                out[n] = [t.id for t in tokenize(form(segment))]
            else:
                rest.append(n)
        for at in range(0, len(rest), 20_000):
            part = rest[at : at + 20_000]
            for n, e in zip(part, self.tokenizer.encode_batch_fast([segments[n] for n in part], add_special_tokens=False), strict=True):
                out[n] = e.ids
        return [np.array(ids, self.dtype) for ids in out]


_CODERS: dict[tuple, SegmentCoder] = {}


def coder(kind: type, path: str) -> SegmentCoder:
    """One coder per worker process and file; it outlives the task, as the worker does."""
    if (kind, path) not in _CODERS:
        _CODERS[kind, path] = kind(path)
    return _CODERS[kind, path]
