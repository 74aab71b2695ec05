"""N-gram Jaccard self-join by T-occurrence search over inverted lists (DivideSkip), exact, and its connected components.

A text's set holds hashes (64 bit) of its n-word shingles. Equal sets are one node. Nodes link when their sets' Jaccard
similarity reaches ``percent`` / 100. Two linked sets of m and n shingles have an overlap of at least
T = ceil(percent * (m + n) / (100 + percent)), so each of them has one of the other's among its rarest ones: of the inverted lists
of a set, all but the longest T - COMMON are enough to find every partner that stands in COMMON of them.

1. One pass gives every row its node and counts shingles in a sketch of buckets, which orders them, rarest first. Any order that
   all sets share gives the same links; the counts only make the lists short.
2. One pass writes the inverted lists of each set's rarest shingles, with the shingle's rank in its set. The shingles before the
   first common one are missing in the other set, which bounds the overlap, and so the other's size (``cap``).
3. Lists of at most SHORT sets are short. Every set that stands in short lists is a query: its short lists come together and are
   merged by a heap of their fronts, which skips what can't stand in as many of them as the query's long lists leave over (T less
   their number). A candidate that stands in too few short lists alone is looked for in the query's long lists, each by a binary
   search in the sorted list; those go on that stand in as many lists of both kinds as an overlap of T needs.
4. Sets that share no short list are found through long ones. There the set with the lowest rank (of each size class) is a hub
   that the others are compared with, which links the members of large groups of near copies without their pairs.
5. Candidates are verified by binary probes of the smaller set in the larger. Sets are recomputed from the texts of the
   candidates, only.
6. After the components of these links are known, those long lists are searched again that hold several components: each set outside
   a list's most frequent component looks, by a binary search in the list sorted by size, for the sets whose sizes and ranks allow
   a link; pairs within a component need no look. A pair leaves the task only if it may reach its T: the sets' occurrence counts
   (how many shingles fall into each of a set's buckets, about an eighth as many as shingles) stand in the list beside them, and
   the overlap is at most the sum of the lesser counts. What is left is verified too, so no link that joins anything is lost.

Long lists are kept in parts (about the square root of their length, over LIST_ROWS, is their number), which all have the list's
hubs, and every step above is dealt by parts, not by shingles: a passage that a third of all documents hold is the work of many tasks.

Nulls and texts without words have empty sets and link with nothing. Rows with equal sets (repeated rows, exact copies) share a
component. Rows with a null id are linked like others, and a component's id is its smallest id that isn't null. Other columns are
ignored, whatever their names. An empty table gives an empty result. Sets are told apart by 64 bits: among a thousand million
different texts two would be taken as equal with a probability of 3 %.

Very long texts: words are hashed in pieces of ``PIECE`` bytes; of a whole text its words' and shingles' hashes are held, some five
times its size.
"""

from __future__ import annotations

import heapq
import zlib
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import discard, materialise, numbered, quoted, raw_bytes, renamed, row_slices, segment_hashes, text_or_empty, tidy
from tidemark.llm.components import components

SHORT = 12
COMMON = 3
#: A list that should have more rows than this, by the sketch, is split into parts, as many as the square root of the ratio.
LIST_ROWS = 100
CHUNK = 1 << 16
#: The fewest and the most buckets in which a set's shingles are counted. With more than some 200,000 shingles the most are too few to
#: tell sets apart that share little; the bound holds all the same.
LEAST_WIDTH, MOST_WIDTH = 64, 4096
#: Bytes of text whose words are hashed at a time.
PIECE = 1 << 21
#: Ids of candidate rows that may be broadcast (about 16 MB).
BROADCAST_IDS = 1_000_000
_MIX = np.uint64(0xFF51AFD7ED558CCD)
_MIX2 = np.uint64(0xC4CEB9FE1A85EC53)


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(33))) * _MIX
    h = (h ^ (h >> np.uint64(33))) * _MIX2
    return h ^ (h >> np.uint64(33))


_LOWER = np.arange(256, dtype="u1")
_LOWER[65:91] += 32
_BLANK = np.zeros(256, bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where words begin, and their hashes; words end at blanks and at the rows' ends. Goes in pieces that end at blanks or rows."""
    found = [(np.zeros(0, "i8"), np.zeros(0, "u8"))]
    a = 0
    while a < len(data):
        b, window = a + PIECE, 1 << 12
        while b < len(data) and not (blanks := np.flatnonzero(_BLANK[data[b : b + window]])).size:
            b, window = b + window, window * 2
        b = b + int(blanks[0]) if b < len(data) else len(data)
        part = _LOWER[data[a:b]]
        solid = ~_BLANK[part]
        edge = np.zeros(len(part) + 1, bool)
        edge[offsets[(offsets >= a) & (offsets <= b)] - a] = True
        edge[0] = edge[-1] = True
        starts = np.flatnonzero(solid & (~np.concatenate([[False], solid[:-1]]) | edge[:-1]))
        ends = np.flatnonzero(solid & (~np.concatenate([solid[1:], [False]]) | edge[1:])) + 1
        if len(starts):
            found.append((starts + a, segment_hashes(part, starts, ends)))
        a = b
    return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])


def shingle_sets(array: pa.Array, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Where each row's set begins (one more than rows), and the sets' hashes, ascending within a row."""
    offsets, data = raw_bytes(array)
    rows = len(offsets) - 1
    if not len(data):
        return np.zeros(rows + 1, "i8"), np.zeros(0, "u8")
    starts, h = word_hashes(data, offsets)
    first = np.searchsorted(starts, offsets)  # number of words before each row
    count = np.diff(first)
    grams = mixed(h)
    for k in range(1, words):
        grams[: len(h) - k] = mixed(grams[: len(h) - k] + h[k:] * np.uint64(2 * k + 1))
    sets, sizes = [], np.zeros(rows, "i8")
    for n, (a, c) in enumerate(zip(first.tolist(), count.tolist(), strict=False)):
        if c >= words:
            own = grams[a : a + c - words + 1].copy()
            own.sort()
            own = own[np.concatenate([[True], own[1:] != own[:-1]])]
        elif c:
            own = np.full(1, c, "u8")
            for k in range(a, a + c):
                own = mixed(own + h[k : k + 1])
        else:
            continue
        sets.append(own)
        sizes[n] = len(own)
    return np.concatenate([[0], np.cumsum(sizes)]), np.concatenate([np.zeros(0, "u8"), *sets])


def node_ids(at: np.ndarray, sets: np.ndarray) -> np.ndarray:
    """64-bit ids of the sets, as signed integers."""
    sums = np.concatenate([[np.uint64(0)], np.cumsum(mixed(sets ^ np.uint64(0x5851F42D4C957F2D)), dtype="u8")])
    return mixed((sums[at[1:]] - sums[at[:-1]]) + np.diff(at).astype("u8") * _MIX2).view("i8")


@dataclass(frozen=True)
class Join:
    words: int = 4
    percent: int = 85

    def need(self, n):
        """The least overlap of a set of n with any set that it links with."""
        return -(-self.percent * n // 100)

    def cap(self, n: np.ndarray, rank: np.ndarray) -> np.ndarray:
        """The largest set with which a set of n may link when their first common shingle has this rank in it: the shingles before
        it are missing in the other, and a set of n may miss n - T. Without a rank this bounds the sizes alone."""
        return (100 * n - (100 + self.percent) * rank) // self.percent

    def allowed(self, m: str, a: str, n: str, b: str) -> Column:
        """The same as a condition on both sets' sizes and ranks."""
        reach = lambda x, r: 100 * F.col(x).cast("long") - (100 + self.percent) * F.col(r).cast("long")
        return (self.percent * F.col(n).cast("long") <= reach(m, a)) & (self.percent * F.col(m).cast("long") <= reach(n, b))

    def near(self, m, n):
        return (100 * m >= self.percent * n) & (100 * n >= self.percent * m)

    def least(self, m, n):
        """In how many lists of both kinds sets of m and n that link stand together. Of the rarest n - need + COMMON shingles of the
        set that ends first in the order, those that aren't shared are missing in the other, and a set may miss at most n - T."""
        overlap = self.overlap(m, n)
        return np.maximum(np.minimum(overlap - self.need(m), overlap - self.need(n)), 0) + np.minimum(COMMON, np.minimum(self.need(m), self.need(n)))

    def overlap(self, m, n):
        """T, the least overlap with which sets of m and n link."""
        return -(-self.percent * (m + n) // (100 + self.percent))

    def size_class(self, n: np.ndarray) -> np.ndarray:
        return np.floor(np.log(n) / np.log(100 / self.percent) + 1e-9).astype("i4")


def widths(n: np.ndarray) -> np.ndarray:
    """The number of buckets of a set of n shingles: a power of two, an eighth of n or more, from LEAST_WIDTH to MOST_WIDTH."""
    return np.clip(1 << np.ceil(np.log2(np.maximum(n, 8) / 8)).astype("i8"), LEAST_WIDTH, MOST_WIDTH)


def occurrence_counts(at: np.ndarray, sets: np.ndarray) -> pa.Array:
    """How many shingles of each set fall into each of its buckets, a byte each (255: so many or more). A shingle's bucket of 2 w
    is one of two that make up its bucket of w, so counts of different widths can be compared. Empty sets have no bytes."""
    n = np.diff(at)
    width = np.where(n > 0, widths(n), 0)
    begin = np.cumsum(width) - width
    bucket = ((sets * _MIX2) >> np.uint64(40)).astype("i8") & np.repeat(width - 1, n)
    counts = np.minimum(np.bincount(bucket + np.repeat(begin, n), minlength=int(width.sum())), 255).astype("u1")
    return pa.Array.from_buffers(pa.binary(), len(n), [None, pa.py_buffer(np.append(begin, width.sum()).astype("i4").tobytes()), pa.py_buffer(counts.tobytes())])


class Occurrences:
    """The occurrence counts of some sets, for bounds on the overlaps of many pairs of them."""

    def __init__(self, counts: list[bytes]) -> None:
        self.width = np.array([len(c) for c in counts], "i8")
        self.at = np.zeros(len(counts), "i8")
        self.table: dict[int, np.ndarray] = {}
        for w in np.unique(self.width).tolist():
            own = np.flatnonzero(self.width == w)
            self.table[w] = np.frombuffer(b"".join(counts[k] for k in own.tolist()), "u1").reshape(len(own), w)
            self.at[own] = np.arange(len(own))

    def rows(self, sets: np.ndarray, width: int) -> np.ndarray:
        """The sets' counts in this many buckets, which none of them has fewer of."""
        out = np.empty((len(sets), width), "u1")
        for w in np.unique(self.width[sets]).tolist():
            own = np.flatnonzero(self.width[sets] == w)
            counts = self.table[w][self.at[sets[own]]]
            while counts.shape[1] > width:
                half = counts.shape[1] // 2
                counts = np.minimum(counts[:, :half].astype("u2") + counts[:, half:], 255).astype("u1")
            out[own] = counts
        return out

    def bound(self, a: np.ndarray, b: np.ndarray, m: np.ndarray, n: np.ndarray) -> np.ndarray:
        """What the overlaps of the pairs can be at most; m and n are the sets' sizes. A difference between two counts, even of cut
        ones, stands for as many shingles that only one of the sets has."""
        out = np.empty(len(a), "i8")
        narrow = np.minimum(self.width[a], self.width[b])
        for w in np.unique(narrow).tolist():
            pairs = np.flatnonzero(narrow == w)
            step = max(1, (1 << 22) // w)
            for k in range(0, len(pairs), step):
                some = pairs[k : k + step]
                x, y = self.rows(a[some], w), self.rows(b[some], w)
                apart = (np.maximum(x, y) - np.minimum(x, y)).sum(axis=1, dtype="i8")
                out[some] = (m[some] + n[some] - apart) // 2
        return out


def first_pass(docs: DataFrame, join: Join, buckets: int) -> DataFrame:
    """Rows of kind 0: id, size, node, occurrence counts; of kind 1: a chunk of the shingle counts of one task."""
    kind = dict(docs.dtypes)["doc_id"]
    frame = docs.select("doc_id", text_or_empty().alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(buckets, "i4")
        names = ["kind", "doc_id", "n", "node", "part", "counts", "occurs"]
        kind_of_id = None
        for batch in batches:
            kind_of_id = batch.schema.field(0).type
            for first, end in row_slices(batch.column(1)):
                at, sets = shingle_sets(batch.column(1).slice(first, end - first), join.words)
                counts += np.bincount((sets & np.uint64(buckets - 1)).astype("i8"), minlength=buckets).astype("i4")
                n = end - first
                yield pa.RecordBatch.from_arrays([pa.array(np.zeros(n, "i4")), batch.column(0).slice(first, n), pa.array(np.diff(at)), pa.array(node_ids(at, sets)), pa.nulls(n, pa.int32()), pa.nulls(n, pa.binary()), occurrence_counts(at, sets)], names)
        if kind_of_id is not None:
            chunks = [zlib.compress(counts[k : k + CHUNK].astype("<i8").tobytes(), 1) for k in range(0, buckets, CHUNK)]
            n = len(chunks)
            yield pa.RecordBatch.from_arrays([pa.array(np.ones(n, "i4")), pa.nulls(n, kind_of_id), pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64()), pa.array(np.arange(n, dtype="i4")), pa.array(chunks, pa.binary()), pa.nulls(n, pa.binary())], names)

    return frame.mapInArrow(tidy(run), f"kind int, doc_id {kind}, n long, node long, part int, counts binary, occurs binary")


def bucket_levels(first: DataFrame, buckets: int) -> tuple[np.ndarray, int]:
    """The counts of all tasks added up, as ranks of 0 to 255 by their logarithm, one byte a bucket; and what to add to a rank to
    have 16 times the logarithm. A chunk of buckets is added up in two steps, so that no task reads those of all tasks."""
    parts = -(-buckets // CHUNK)

    def add(last: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held: dict[int, np.ndarray] = {}
            for batch in batches:
                for part, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                    counts = np.frombuffer(zlib.decompress(raw), "<i8")
                    held[part] = held[part] + counts if part in held else counts
            for part, counts in held.items():
                # only what stands out from a bucket's usual count matters, and small differences don't
                out = np.minimum(np.round(16 * np.log2(counts + 1.0)), 65535).astype("<u2") if last else counts
                yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([zlib.compress(out.tobytes(), 1)], pa.binary())], ["part", "level" if last else "counts"])

        return tidy(run)

    chunks = first.where("kind = 1").select("part", "counts")
    slots = int((chunks.count() / parts) ** 0.5)
    if slots > 8:
        slot = F.pmod(F.xxhash64("counts"), F.lit(slots))
        chunks = chunks.withColumn("slot", slot).repartition("part", "slot").select("part", "counts").mapInArrow(add(False), "part int, counts binary")
    merged = chunks.repartition(parts, "part").mapInArrow(add(True), "part int, level binary")
    levels = np.zeros(buckets, "<u2")
    for row in merged.toLocalIterator():
        part = np.frombuffer(zlib.decompress(row["level"]), "<u2")
        levels[row["part"] * CHUNK : row["part"] * CHUNK + len(part)] = part
    base = int(np.median(levels)) if len(levels) else 0
    return np.clip(levels.astype("i4") - base + 64, 0, 255).astype("u1"), base - 64


def list_ids(tokens: np.ndarray, part: np.ndarray) -> np.ndarray:
    return (tokens.view("u8") + part.astype("u8") * _MIX).view("i8")


def inverted_lists(docs: DataFrame, join: Join, levels, buckets: int) -> DataFrame:
    """(token, list, parts, node, n, rank) for the rarest shingles of each set, as many as any link leaves, and COMMON - 1 more.
    ``list`` is the token, or for a frequent token (several parts) the part of its list that the node falls in."""
    list_rows = LIST_ROWS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        level, base = levels.value
        parts_of = np.maximum(np.sqrt(2.0 ** ((np.arange(256) + base) / 16) / list_rows), 1).astype("i8")
        done: set[int] = set()
        for batch in batches:
            for first, end in row_slices(batch.column(0)):
                at, sets = shingle_sets(batch.column(0).slice(first, end - first), join.words)
                nodes, sizes = node_ids(at, sets), np.diff(at)
                rank_of = level[(sets & np.uint64(buckets - 1)).astype("i8")]
                token, node, size, rank, parts = [], [], [], [], []
                for n in np.flatnonzero(sizes):
                    if int(nodes[n]) in done:
                        continue
                    if len(done) < 500_000:
                        done.add(int(nodes[n]))
                    m = int(sizes[n])
                    own = slice(int(at[n]), int(at[n + 1]))
                    some = min(m, m - join.need(m) + COMMON)
                    order = np.argsort(rank_of[own], kind="stable")[:some]  # the sets are ascending, so ties stand in hash order
                    token.append(sets[own][order])
                    node.append(np.full(some, nodes[n]))
                    size.append(np.full(some, m, "i4"))
                    rank.append(np.arange(some, dtype="i4"))
                    parts.append(parts_of[rank_of[own][order]])
                if token:
                    tokens, members, k = np.concatenate(token), np.concatenate(node), np.concatenate(parts)
                    part = members.view("u8") % k.astype("u8")
                    columns = [tokens.view("i8"), list_ids(tokens, part), k.astype("i4"), members, np.concatenate(size), np.concatenate(rank)]
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["token", "list", "parts", "node", "n", "rank"])

    return docs.select(text_or_empty().alias("text")).mapInArrow(tidy(run), "token long, list long, parts int, node long, n int, rank int")


def grouped(batches: Iterator[pa.RecordBatch], key: str = "list") -> Iterator[dict[str, np.ndarray]]:
    """Sorted batches as runs of whole groups."""
    held: dict[str, np.ndarray] | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        own = {f.name: batch.column(k).to_numpy(zero_copy_only=False) for k, f in enumerate(batch.schema)}
        if held is not None:
            own = {c: np.concatenate([held[c], own[c]]) for c in own}
        last = int(np.searchsorted(own[key], own[key][-1], "left"))
        held = {c: v[last:] for c, v in own.items()}
        if last:
            yield {c: v[:last] for c, v in own.items()}
    if held is not None and len(held[key]):
        yield held


#: What a short list holds of a set: its node, its size, and whether the ranks in this list allow a link with the query.
RECORD = np.dtype([("node", "<i8"), ("n", "<i4"), ("allowed", "<i4")])
MERGED = "kind int, token long, list long, parts int, node long, other long, n int, rank int, records binary"
SHORT_LIST, HUB_PAIR, LONG_ROW, PART_HUB = range(4)


def merged_rows(kind: int, rows: int, records: pa.Array | None = None, **columns: np.ndarray) -> pa.RecordBatch:
    kinds = {"kind": "i4", "token": "i8", "list": "i8", "parts": "i4", "node": "i8", "other": "i8", "n": "i4", "rank": "i4"}
    arrays = [pa.array((columns[c] if c in columns else np.full(rows, kind if c == "kind" else 0)).astype(k)) for c, k in kinds.items()]
    return pa.RecordBatch.from_arrays([*arrays, pa.nulls(rows, pa.binary()) if records is None else records], [*kinds, "records"])


def divided_lists(lists: DataFrame, join: Join) -> DataFrame:
    """Short lists (one row for each query, with the sets of smaller nodes in the list), rows of long lists (with the size class in
    ``other``), pairs of a hub and another set of a long list, and of lists in several parts the first set of each part and class."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for g in grouped(batches):
            part, token, parts, node, n, rank = g["list"], g["token"], g["parts"], g["node"], g["n"].astype("i8"), g["rank"].astype("i8")
            keep = np.concatenate([[True], (part[1:] != part[:-1]) | (node[1:] != node[:-1])])
            part, token, parts, node, n, rank = (x[keep] for x in (part, token, parts, node, n, rank))
            begin = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]]))
            length = np.diff(np.append(begin, len(part)))
            of = np.repeat(np.arange(len(begin)), length)
            long = (length[of] > SHORT) | (parts > 1)
            cap = join.cap(n, rank)
            # short lists: rows are in the order of nodes, so a query's list is what stands before it
            query, other = [np.zeros(0, "i8")], [np.zeros(0, "i8")]
            for d in range(1, SHORT):
                j = np.flatnonzero((np.arange(len(part)) - d >= begin[of]) & ~long)
                ok = join.near(n[j], n[j - d])
                query.append(j[ok])
                other.append(j[ok] - d)
            query, other = np.concatenate(query), np.concatenate(other)
            if len(query):
                order = np.lexsort((other, query))
                query, other = query[order], other[order]
                records = np.empty(len(query), RECORD)
                records["node"], records["n"] = node[other], n[other]
                records["allowed"] = (n[query] <= cap[other]) & (n[other] <= cap[query])
                head = np.flatnonzero(np.concatenate([[True], query[1:] != query[:-1]]))
                at = np.append(head, len(query)) * RECORD.itemsize
                held = pa.Array.from_buffers(pa.binary(), len(head), [None, pa.py_buffer(at.astype("i4").tobytes()), pa.py_buffer(records.tobytes())])
                yield merged_rows(SHORT_LIST, len(head), held, node=node[query[head]], n=n[query[head]])
            rows = np.flatnonzero(long)
            if len(rows):
                yield merged_rows(LONG_ROW, len(rows), token=token[rows], list=part[rows], parts=parts[rows], node=node[rows], n=n[rows], rank=rank[rows], other=join.size_class(n[rows]))
                group = of[rows].astype("i8") * 1000 + join.size_class(n[rows])
                order = np.lexsort((-n[rows], rank[rows], group))
                rows, group = rows[order], group[order]
                head = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
                hub = rows[np.repeat(head, np.diff(np.append(head, len(rows))))]
                far = rows[head][parts[rows[head]] > 1]
                if len(far):
                    yield merged_rows(PART_HUB, len(far), token=token[far], parts=parts[far], node=node[far], n=n[far], rank=rank[far], other=join.size_class(n[far]))
                ok = (hub != rows) & (parts[rows] == 1) & (n[hub] <= cap[rows]) & (n[rows] <= cap[hub])
                yield merged_rows(HUB_PAIR, int(ok.sum()), node=node[hub[ok]], other=node[rows[ok]])

    # sorted by node within a list, so that copies of one set stand together
    return lists.repartition("list").sortWithinPartitions("list", "node").mapInArrow(tidy(run), MERGED)


def merge_skip(lists: list[list[int]], least: int) -> list[tuple[int, int]]:
    """The values that stand in ``least`` of the ascending lists or more, with the number of lists: by a heap of the lists' fronts.

    When too few lists have the smallest value at their fronts, least - 1 lists are taken off the heap and go on, by a binary
    search, to the next front: what lies between can't stand in enough of them."""
    at = [0] * len(lists)
    heap = [(values[0], k) for k, values in enumerate(lists)]
    heapq.heapify(heap)
    found = []
    while len(heap) >= least:
        value, taken = heap[0][0], []
        while heap and heap[0][0] == value:
            taken.append(heapq.heappop(heap)[1])
        if len(taken) >= least:
            found.append((value, len(taken)))
            for k in taken:
                at[k] += 1
        else:
            while heap and len(taken) < least - 1:
                taken.append(heapq.heappop(heap)[1])
            if not heap:
                break
            for k in taken:
                at[k] = bisect_left(lists[k], heap[0][0], at[k])
        for k in taken:
            if at[k] < len(lists[k]):
                heapq.heappush(heap, (lists[k][at[k]], k))
    return found


CANDIDATES = "a long, b long, list long, missing int"


def merge_short(merged: DataFrame, join: Join) -> DataFrame:
    """The short lists of every query, merged. Pairs (a: the query, b) that stand together in enough of them have ``missing`` 0; the
    others give a row for each long list of the query in which b is to be looked for, with the number that is missing."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for g in grouped(batches, "node"):
            node, kind, n = g["node"], g["kind"], g["n"]
            begin = np.append(np.flatnonzero(np.concatenate([[True], node[1:] != node[:-1]])), len(node)).tolist()
            pairs = ([], [], [], [])
            for first, end in zip(begin, begin[1:], strict=False):
                # rows of short lists come before those of long ones
                short = first + int((kind[first:end] == SHORT_LIST).sum())
                if short == first:
                    continue
                records = [np.frombuffer(r, RECORD) for r in g["records"][first:short]]
                every = np.concatenate(records)
                size = int(n[first])
                least = max(1, int(min(COMMON, join.need(size), join.need(int(every["n"].min())))) - (end - short))
                if len(records) == 1:
                    hits = [(v, 1) for v in records[0]["node"].tolist()] if least == 1 else []
                else:
                    hits = merge_skip([r["node"].tolist() for r in records], least)
                if not hits:
                    continue
                # ranks allow a link in some list only if they do in the first common one
                allowed = every[every["allowed"] > 0]
                sizes = dict(zip(allowed["node"].tolist(), allowed["n"].tolist(), strict=True))
                hits = [(b, together) for b, together in hits if b in sizes]
                if not hits:
                    continue
                b, together = (np.array(x, "i8") for x in zip(*hits, strict=True))
                missing = np.maximum(join.least(np.array([sizes[x] for x, _ in hits], "i8"), size) - together, 0)
                enough = missing == 0
                pairs[0].append(np.full(int(enough.sum()), node[first]))
                pairs[1].append(b[enough])
                pairs[2].append(np.zeros(int(enough.sum()), "i8"))
                pairs[3].append(missing[enough])
                weak = np.flatnonzero((missing > 0) & (missing <= end - short))
                if len(weak):
                    tokens, parts = np.tile(g["token"][short:end], len(weak)), np.tile(g["parts"][short:end], len(weak))
                    probed = np.repeat(b[weak], end - short)
                    pairs[0].append(np.full(len(probed), node[first]))
                    pairs[1].append(probed)
                    pairs[2].append(list_ids(tokens, probed.view("u8") % parts.astype("u8")))
                    pairs[3].append(np.repeat(missing[weak], end - short))
            if pairs[0]:
                columns = [np.concatenate(p) for p in pairs]
                yield pa.RecordBatch.from_arrays([*(pa.array(c.astype("i8")) for c in columns[:3]), pa.array(columns[3].astype("i4"))], ["a", "b", "list", "missing"])

    rows = merged.where(F.col("kind").isin(SHORT_LIST, LONG_ROW)).select("kind", "token", "parts", "node", "n", "records")
    return rows.repartition("node").sortWithinPartitions("node", "kind").mapInArrow(tidy(run), CANDIDATES)


def probe_long(merged: DataFrame, weak: DataFrame) -> DataFrame:
    """The pairs (a, b) whose b stands in as many of the lists it is looked for in as are missing, by binary searches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for g in grouped(batches):
            order = np.lexsort((g["b"], g["list"]))
            part, a, b, missing = (g[c][order] for c in ("list", "a", "b", "missing"))
            begin = np.append(np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]])), len(part)).tolist()
            found = []
            for first, end in zip(begin, begin[1:], strict=False):
                probes = first + np.flatnonzero(missing[first:end] > 0)
                held = b[first:end][missing[first:end] == 0]
                if len(probes) and len(held):
                    at = np.minimum(np.searchsorted(held, b[probes]), len(held) - 1)
                    found.append(probes[held[at] == b[probes]])
            if found:
                hit = np.concatenate(found)
                yield pa.RecordBatch.from_arrays([pa.array(a[hit]), pa.array(b[hit]), pa.array(missing[hit])], ["a", "b", "missing"])

    lists = merged.where(F.col("kind") == LONG_ROW).select("list", F.lit(0).cast("long").alias("a"), F.col("node").alias("b"), F.lit(0).alias("missing"))
    both = lists.unionByName(weak).repartition("list").sortWithinPartitions("list")
    hits = both.mapInArrow(tidy(run), "a long, b long, missing int")
    return hits.groupBy("a", "b").agg(F.count("*").alias("hits"), F.max("missing").alias("missing")).where("hits >= missing").select("a", "b")


def candidates(merged: DataFrame, join: Join) -> DataFrame:
    """Pairs that may link: those that the short lists and the probed long lists give, and the hubs' of long lists."""
    short = materialise(merge_short(merged, join), "jaccard-short")
    weak = short.where("missing > 0")
    found = [short.where("missing = 0").select("a", "b"), merged.where(F.col("kind") == HUB_PAIR).select(F.col("node").alias("a"), F.col("other").alias("b"))]
    if not weak.isEmpty():
        found.append(probe_long(merged, weak))
    # a list in several parts has one hub for each class, which all its parts are compared with
    firsts = merged.where(F.col("kind") == PART_HUB).groupBy("token", "other").agg(F.max("parts").alias("parts"), F.min(F.struct("rank", "n", "node")).alias("top"))
    hubs = firsts.select("token", "parts", F.col("other").alias("class"), F.col("top.node").alias("hub"), F.col("top.n").alias("hub_n"), F.col("top.rank").alias("hub_rank"))
    hubs = hubs.mapInArrow(tiles("list", "token"), "list long, token long, parts int, class long, hub long, hub_n int, hub_rank int").select(F.col("list").alias("_list"), "class", "hub", "hub_n", "hub_rank")
    rows = merged.where((F.col("kind") == LONG_ROW) & (F.col("parts") > 1))
    met = rows.join(hubs, (F.col("list") == F.col("_list")) & (F.col("other") == F.col("class"))).where((F.col("node") != F.col("hub")) & join.allowed("n", "rank", "hub_n", "hub_rank"))
    found.append(met.select(F.col("node").alias("a"), F.col("hub").alias("b")))
    every = found[0]
    for more in found[1:]:
        every = every.unionByName(more)
    pairs = materialise(every.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "jaccard-pairs")
    discard(short)
    return pairs


def sets_of(docs: DataFrame, first: DataFrame, nodes: DataFrame, join: Join) -> DataFrame:
    """(node, members) for the given nodes, recomputed from the text of one row each; one row a node.

    The rows' ids are broadcast up to BROADCAST_IDS, and the texts joined by a shuffle beyond."""
    rows = first.where("kind = 0").join(nodes, "node", "left_semi").groupBy("node").agg(F.min("doc_id").alias("_wanted"))
    ids = ids_table = materialise(rows.select("_wanted").distinct(), "jaccard-ids")
    if ids.count() <= BROADCAST_IDS:
        ids = F.broadcast(ids)
    texts = docs.join(ids, F.col("doc_id").eqNullSafe(F.col("_wanted")), "left_semi").select(text_or_empty().alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first_row, end in row_slices(batch.column(0)):
                at, sets = shingle_sets(batch.column(0).slice(first_row, end - first_row), join.words)
                filled = np.flatnonzero(np.diff(at))
                if len(filled):
                    yield pa.RecordBatch.from_arrays([pa.array(node_ids(at, sets)[filled]), pa.array([sets[at[n] : at[n + 1]].tobytes() for n in filled.tolist()], pa.binary())], ["node", "members"])

    found = texts.mapInArrow(tidy(run), "node long, members binary").join(nodes, "node", "left_semi")
    sets = materialise(found.groupBy("node").agg(F.first("members").alias("members")), "jaccard-sets")
    discard(ids_table)
    return sets


def verified(pairs: DataFrame, docs: DataFrame, first: DataFrame, join: Join) -> DataFrame:
    """The pairs (a, b) whose sets' similarity reaches the limit, with their overlap. ``pairs`` is a table of its own."""
    if pairs.isEmpty():
        return pairs.withColumn("overlap", F.lit(0).cast("long"))
    nodes = materialise(pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct(), "jaccard-nodes")
    sets = sets_of(docs, first, nodes, join)
    side = lambda s: sets.select(F.col("node").alias(s), F.col("members").alias(f"set_{s}"))
    both = pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "set_a", "set_b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a_at, a_raw = raw_bytes(batch.column("set_a"))
            b_at, b_raw = raw_bytes(batch.column("set_b"))
            common = np.zeros(batch.num_rows, "i8")
            linked = np.zeros(batch.num_rows, bool)
            for n in range(batch.num_rows):
                x, y = a_raw[a_at[n] : a_at[n + 1]].view("u8"), b_raw[b_at[n] : b_at[n + 1]].view("u8")
                x, y = (x, y) if len(x) <= len(y) else (y, x)
                place = np.minimum(np.searchsorted(y, x), len(y) - 1)
                common[n] = int((y[place] == x).sum())
                linked[n] = 100 * common[n] >= join.percent * (len(x) + len(y) - common[n])
            keep = np.flatnonzero(linked)
            yield pa.RecordBatch.from_arrays([batch.column("a").take(pa.array(keep)), batch.column("b").take(pa.array(keep)), pa.array(common[keep])], ["a", "b", "overlap"])

    links = materialise(both.mapInArrow(tidy(run), "a long, b long, overlap long"), "jaccard-links")
    discard(pairs, nodes, sets)
    return links


def tiles(name: str, by: str):
    """A function that gives every row once for each part of its token's list, with the row number ``name``: of the list of that
    part (``by`` token), or of a tile. A tile is what a part's sets and one part of those that look into it meet in: a set of the
    list (``by`` list) goes to all tiles of its part, and one that looks (``by`` node) to one tile of each part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = batch.column("parts").to_numpy().astype("i8")
            ends = np.cumsum(parts)
            first = 0
            while first < len(parts):
                end = max(first + 1, int(np.searchsorted(ends, (ends[first - 1] if first else 0) + 200_000, "right")))
                n = parts[first:end]
                row = np.repeat(np.arange(first, end), n)
                part = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
                taken = batch.take(pa.array(row))
                column = lambda c: taken.column(c).to_numpy()  # noqa: B023, E731
                lists = list_ids(column("list"), part) if by == "list" else list_ids(column("token"), part)
                if by == "node":
                    lists = list_ids(lists, column("node").view("u8") % column("parts").astype("u8"))
                yield pa.RecordBatch.from_arrays([pa.array(lists), *taken.columns], [name, *taken.schema.names])
                first = end

    return tidy(run)


def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of a list's sets for all tiles that they meet others in (``flag`` 0), and of those outside the list's main component
    for the tiles in which they look for others (1)."""
    for batch in batches:
        away = batch.filter(pc.not_equal(batch.column("root"), batch.column("main")))
        for rows, by, flag in ((batch, "list", 0), (away, "node", 1)):
            for out in tiles("tile", by)(iter([rows])):
                columns = [out.column(c) for c in ("tile", "node", "n", "reach", "root", "occurs")]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(np.full(out.num_rows, flag, "i4"))], ["tile", "node", "n", "reach", "root", "occurs", "flag"])


def apart(merged: DataFrame, roots: DataFrame, first: DataFrame, join: Join) -> DataFrame:
    """Pairs of sets in a long list that have different components, sizes and ranks that allow a link, and occurrence counts with
    which the overlap may reach T.

    A list's sets outside its most frequent component are sent to each of its parts (in tiles), and look there, by binary searches over the
    sets in the order of their sizes, for those that they may link with; members of one large group aren't paired."""
    rows = merged.where(F.col("kind") == LONG_ROW).select("token", "list", "parts", "node", "n", "rank")
    rows = rows.join(roots.withColumnRenamed("node", "_node"), F.col("node") == F.col("_node"), "left").select("token", "list", "parts", "node", "n", "rank", F.coalesce("root", "node").alias("root"))
    rows = materialise(rows.withColumn("reach", F.floor((100 * F.col("n").cast("long") - (100 + join.percent) * F.col("rank")) / join.percent).cast("int")), "jaccard-long")
    by_root = rows.groupBy("token", "root").agg(F.count("*").alias("_rows"), F.max("parts").alias("parts"))
    lists = by_root.groupBy("token").agg(F.max_by("root", F.struct("_rows", "root")).alias("main"), F.count("*").alias("_roots"), F.max("parts").alias("parts")).where("_roots > 1").drop("_roots")
    mains = lists.mapInArrow(tiles("list", "token"), "list long, token long, main long, parts int").select("list", "main")
    able = materialise(rows.where(100 * F.col("reach") >= join.percent * F.col("n")).join(mains, "list").select("token", "list", "parts", "node", "n", "reach", "root", "main"), "jaccard-able")
    occurs = first.where("kind = 0").join(able.select("node").distinct(), "node", "left_semi").groupBy("node").agg(F.first("occurs").alias("occurs"))
    both = able.join(occurs, "node").mapInArrow(tidy(dealt), "tile long, node long, n int, reach int, root long, occurs binary, flag int")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for g in grouped(batches, "tile"):
            order = np.lexsort((g["n"], g["flag"], g["tile"]))
            part, flag, node, n, reach, root, counts = (g[c][order] for c in ("tile", "flag", "node", "n", "reach", "root", "occurs"))
            begin = np.append(np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]])), len(part)).tolist()
            for first, end in zip(begin, begin[1:], strict=False):
                middle = first + int((flag[first:end] == 0).sum())
                sizes = n[first:middle]
                probes = np.arange(middle, end)
                low = np.searchsorted(sizes, join.need(n[probes]), "left")
                count = np.maximum(np.searchsorted(sizes, reach[probes], "right") - low, 0)
                if not count.any():
                    continue
                occurrences = Occurrences(counts[first:end].tolist())
                ends = np.cumsum(count)
                k = 0
                while k < len(probes):
                    stop = max(k + 1, int(np.searchsorted(ends, (ends[k - 1] if k else 0) + 500_000, "right")))
                    some = count[k:stop]
                    i = np.repeat(probes[k:stop], some)
                    j = first + np.repeat(low[k:stop], some) + np.arange(len(i)) - np.repeat(np.cumsum(some) - some, some)
                    ok = (root[i] != root[j]) & (n[i] <= reach[j])
                    i, j = i[ok], j[ok]
                    sizes_i, sizes_j = n[i].astype("i8"), n[j].astype("i8")
                    ok = occurrences.bound(i - first, j - first, sizes_i, sizes_j) >= join.overlap(sizes_i, sizes_j)
                    i, j = i[ok], j[ok]
                    if len(i):
                        yield pa.RecordBatch.from_arrays([pa.array(np.minimum(node[i], node[j])), pa.array(np.maximum(node[i], node[j]))], ["a", "b"])
                    k = stop

    met = both.repartition("tile").sortWithinPartitions("tile").mapInArrow(tidy(run), "a long, b long")
    pairs = materialise(met.distinct(), "jaccard-pairs")
    discard(rows, able)
    return pairs


def similarity_components(docs: DataFrame, words: int = 4, percent: int = 85, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, n_shingles, component_id."""
    spark = docs.sparkSession
    join = Join(words, percent)
    docs = docs.select(quoted(id_col).alias("doc_id"), quoted(text_col).cast("string").alias("text"))
    size = docs.select(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0
    buckets = 1 << min(24, max(16, int(size / 6 / 128).bit_length()))
    first = materialise(first_pass(docs, join, buckets), "jaccard-first")
    levels = spark.sparkContext.broadcast(bucket_levels(first, buckets))
    merged = materialise(divided_lists(inverted_lists(docs, join, levels, buckets), join), "jaccard-merged")
    links = verified(candidates(merged, join), docs, first, join).select("a", "b")
    roots = components(links)
    more = verified(apart(merged, roots, first, join), docs, first, join).select("a", "b")
    if not more.isEmpty():
        old, roots = roots, components(links.unionByName(more))
        discard(old)
    discard(merged)
    rows = first.where("kind = 0").select("doc_id", F.col("n").alias("n_shingles"), "node")
    least = rows.where("n_shingles > 0").groupBy("node").agg(F.min("doc_id").alias("_least"))
    named = least.join(roots.withColumnRenamed("node", "_node"), F.col("node") == F.col("_node"), "left").select("node", F.coalesce("root", "node").alias("_root"), "_least")
    of_root = named.groupBy("_root").agg(F.min("_least").alias("component"))
    labels = named.join(of_root.withColumnRenamed("_root", "_r"), F.col("_root") == F.col("_r")).select(F.col("node").alias("_node"), "component")
    return rows.join(labels, (F.col("node") == F.col("_node")) & (F.col("n_shingles") > 0), "left").select("doc_id", "n_shingles", F.when(F.col("n_shingles") > 0, F.col("component")).otherwise(F.col("doc_id")).alias("component_id"))


def one_of_each(docs: DataFrame, words: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text", broadcast_rows: int = 1_000_000) -> DataFrame:
    """The documents with all their columns, of each component one row with the smallest id (null comes last).

    Every row is a document. Where ids repeat, null included, the rows are numbered in a table in the shared folder, and components
    are those of the numbers; rows with one id stay apart unless their texts link."""
    names, docs = docs.columns, numbered(docs)
    own_id, text_col = (f"c{names.index(c)}" for c in (id_col, text_col))
    repeated = not docs.groupBy(own_id).count().where("count > 1").isEmpty()
    key = own_id
    if repeated:
        key = "_row"
        docs = materialise(docs.withColumn(key, F.monotonically_increasing_id()), "jaccard-rows")
    named = materialise(similarity_components(docs, words, percent, key, text_col).select("doc_id", "component_id"), "jaccard-components")
    if repeated:
        ids = docs.select(F.col(key).alias("doc_id"), F.col(own_id).alias("_id"))
        first = named.join(ids, "doc_id").groupBy("component_id").agg(F.min(F.struct(F.col("_id").isNull().alias("none"), "_id", "doc_id")).alias("_first"))
        gone = named.join(first.select(F.col("_first.doc_id").alias("doc_id")), "doc_id", "left_anti").select(F.col("doc_id").alias("_gone"))
    else:
        gone = named.where(~F.col("doc_id").eqNullSafe(F.col("component_id"))).select(F.col("doc_id").alias("_gone"))
    if gone.count() <= broadcast_rows:
        gone = F.broadcast(gone)
    return renamed(docs.join(gone, F.col(key).eqNullSafe(F.col("_gone")), "left_anti"), names)
