"""Mixture-controlled packing of token streams into sequences of fixed length.

Deficit round-robin over source queues. Every source has a queue of its documents' tokens, in table order, and a target share.
One round fills one sequence of ``seq_len`` tokens: each source is credited its share of the window, sends the whole tokens (or
grains of ``grain`` tokens) nearest to its credit, and carries the rest, its deficit, into the next round, so that every round
sends exactly ``seq_len`` tokens. A source whose queue is empty leaves, and its credit goes to the others in proportion. Within a
sequence, sources stand one after another. Only the last sequence is padded.

The credit is dealt down a tree over the sources, split in halves of about equal share down to groups of at most GROUP sources. Of
the tokens that a node sends, one half sends the number nearest to its credit and the other half the rest, each carrying its
deficit; a group sends what is due at the virtual time, found by bisection, at which its tokens are due. A node's numbers follow
from its own count alone, so how much a source has sent after round k, and where any token stands in the stream, takes one walk
down the tree (the logarithm of the number of sources) and no round's state. A group stays within a token or two of its credit,
however many there are (a half's deficit is half a token, and its part of its parent's), and a source of it within half a token
more, and its part of the group of half a token for each of the group's sources.

Spark needs one pass to tokenize, a sum per (partition, source) that carries the queues' ends from one partition to the next, and
one pass that writes the pieces: no row is shuffled but those sums. The driver and every task hold the name, length and share of
each source, some 100 bytes a source, and a task the nodes of the tree on the way to its own sources.

Null texts are empty documents (the end id alone); a null source is a queue of its own. Repeated rows are packed as often as
they stand. Other columns are ignored, whatever their names. An empty table gives no piece. Very long texts are tokenized in parts
of about ``SLICE_BYTES``; a document's ids are one value.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import IdCoder, coder, materialise, quoted, raw_bytes, row_slices, text_or_empty, tidy

#: The queues' ends by partition are broadcast up to so many rows (about 40 MB), and joined by a shuffle beyond.
BROADCAST_ROWS = 500_000
#: So many sources are dealt to at once, and the most counts (rounds by sources) worked out at a time.
GROUP, CELLS = 32, 1_000_000

PIECES = "doc_id {id}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, source string"


def scaled(d: np.ndarray, a: np.ndarray, g: np.ndarray) -> np.ndarray:
    """d * a / g to the nearest whole number, exactly, for 0 <= d, a <= g < 2 ** 50: an estimate, mended by its remainder, which is
    right though the products wrap around."""
    q = (d.astype("f8") * a / g).astype("i8")
    return q + (d * a - q * g + g // 2) // g


@dataclass
class Rounds:
    """The rounds of deficit round-robin over queues of given lengths (tokens) and shares."""

    lengths: np.ndarray
    shares: np.ndarray
    seq_len: int
    grain: int = 1

    def __post_init__(self) -> None:
        self.lengths = np.asarray(self.lengths, "i8")
        shares = np.asarray(self.shares, "f8")
        self.shares = shares / shares.sum() if shares.sum() > 0 else shares
        # By virtual time v a source has been credited min(share * v, length); credit in all is piecewise linear in v.
        self.empties = np.where(self.shares > 0, self.lengths / np.where(self.shares > 0, self.shares, 1), 0.0)
        self.share_ends = np.concatenate([[0.0], np.cumsum(self.shares)])
        self.token_ends = np.concatenate([[0], np.cumsum(self.lengths)])
        self.knots = np.concatenate([[0.0], np.sort(self.empties)])
        self.credit = self.credited(0, len(self.lengths), self.knots)
        self.total = int(self.lengths.sum())
        self.last = -(-self.total // self.seq_len)
        self.nodes: dict[tuple[int, int], tuple[int, np.ndarray, np.ndarray]] = {}

    def credited(self, a: int, b: int, v: np.ndarray) -> np.ndarray:
        """The credit of the sources a to b by these virtual times."""
        order = np.argsort(self.empties[a:b])
        gone = np.searchsorted(self.empties[a:b][order], v, "right")
        spent = np.concatenate([[0], np.cumsum(self.lengths[a:b][order])])
        rate = np.concatenate([np.cumsum(self.shares[a:b][order][::-1])[::-1], [0.0]])
        return np.maximum.accumulate(spent[gone] + v * rate[gone])

    def node(self, a: int, b: int) -> tuple[int, np.ndarray, np.ndarray]:
        """Where the node of the sources a to b is split, and between which of its grains sent (knots) its first half sends at an
        even rate, with the grains that this half has sent there. Made when first asked for."""
        if (a, b) not in self.nodes:
            half = (self.share_ends[a] + self.share_ends[b]) / 2
            m = min(max(a + int(np.searchsorted(self.share_ends[a : b + 1], half)), a + 1), b - 1)
            if m - 1 > a and half - self.share_ends[m - 1] < self.share_ends[m] - half:
                m -= 1
            v = np.concatenate([[0.0], np.sort(self.empties[a:b])])
            first, rest = (np.floor(self.credited(*ends, v) / self.grain + 0.5).astype("i8") for ends in ((a, m), (m, b)))
            self.nodes[a, b] = m, first + rest, first
        return self.nodes[a, b]

    def halved(self, a: int, b: int, sent: np.ndarray) -> tuple[int, np.ndarray]:
        """Where the node is split, and how many of the tokens it has sent its first half has. Of one more token, one half sends it
        and the other doesn't; a half sends no more than it holds."""
        m, knots, first = self.node(a, b)

        def grains(q: np.ndarray) -> np.ndarray:
            j = np.minimum(np.searchsorted(knots, q, "right") - 1, len(knots) - 2)
            g = np.maximum(knots[j + 1] - knots[j], 1)
            return first[j] + scaled(np.minimum(q - knots[j], g), first[j + 1] - first[j], g)

        q, r = np.divmod(sent, self.grain)
        own = grains(q)
        if self.grain > 1:
            own = own * self.grain + np.where(grains(q + 1) > own, r, 0)
        held, others = (int(self.token_ends[y] - self.token_ends[x]) for x, y in ((a, m), (m, b)))
        return m, np.maximum(np.minimum(own, held), sent - others)

    def due(self, a: int, b: int, v: np.ndarray) -> np.ndarray:
        """By virtual time (rows) and source of a to b (columns): the whole grains nearest to the credit, in tokens. Never falls with v."""
        credit, lengths = v[:, None] * self.shares[a:b], self.lengths[a:b].astype("f8")
        return np.where(credit >= lengths, lengths, np.minimum(np.floor(credit / self.grain + 0.5) * self.grain, lengths))

    def dealt(self, a: int, b: int, goal: np.ndarray) -> np.ndarray:
        """Tokens sent by each source of the group a to b (columns) when they have sent ``goal`` tokens together (rows).

        It is what is due at the virtual time at which that many tokens are due. Where several sources come due at once, the
        first ones are served first."""
        knots = np.concatenate([[0.0], np.sort(self.empties[a:b])])
        credit = self.credited(a, b, knots)
        lengths, total = self.lengths[a:b].astype("f8"), int(self.token_ends[b] - self.token_ends[a])
        slack = ((b - a) / 2 + 1) * self.grain
        low, high = (np.interp(np.clip(goal + d, 0, credit[-1]), credit, knots) for d in (-slack, slack))
        low[self.due(a, b, low).sum(axis=1) >= goal] = 0.0
        high[self.due(a, b, high).sum(axis=1) < goal] = 2 * knots[-1] + 1
        out = np.where(goal[:, None] > 0, lengths, 0.0)
        open_ = np.flatnonzero((goal > 0) & (goal < total))
        while len(open_):
            middle = (low[open_] + high[open_]) / 2
            due = self.due(a, b, middle)
            sent = due.sum(axis=1)
            met = sent == goal[open_]
            out[open_[met]] = due[met]
            closed = ~met & ((middle <= low[open_]) | (middle >= high[open_]))
            ends = open_[closed]
            if len(ends):
                before = self.due(a, b, low[ends])
                steps = self.due(a, b, high[ends]) - before
                left = (goal[ends] - before.sum(axis=1))[:, None] - (np.cumsum(steps, axis=1) - steps)
                out[ends] = before + np.clip(left, 0, steps)
            below = sent < goal[open_]
            low[open_[below]] = middle[below]
            high[open_[~below]] = middle[~below]
            open_ = open_[~met & ~closed]
        return out.astype("i8")

    def upto(self, k: np.ndarray, source: int) -> tuple[np.ndarray, np.ndarray]:
        """When k rounds are over: the tokens sent by the source, and by all sources before it."""
        sent = np.minimum(np.asarray(k, "i8") * self.seq_len, self.total)
        before = np.zeros_like(sent)
        a, b = 0, len(self.lengths)
        while b - a > GROUP:
            m, first = self.halved(a, b, sent)
            if source < m:
                sent, b = first, m
            else:
                sent, before, a = sent - first, before + first, m
        if b - a > 1:
            rows = CELLS // (b - a)
            parts = [self.dealt(a, b, sent[n : n + rows])[:, : source - a + 1] for n in range(0, len(sent), rows)]
            before = before + np.concatenate([p[:, :-1].sum(axis=1) for p in parts])
            sent = np.concatenate([p[:, -1] for p in parts])
        return sent, before

    def sent(self, k: np.ndarray, source: int) -> np.ndarray:
        """Tokens that the source has sent when k rounds are over."""
        return self.upto(k, source)[0]

    def counts(self, k: np.ndarray) -> np.ndarray:
        """Tokens sent when k rounds are over (rows) by source (columns); a row adds up to k windows, or to all tokens."""
        return np.stack([self.sent(k, s) for s in range(len(self.lengths))], axis=1)

    def near(self, token: np.ndarray, source: int) -> np.ndarray:
        """About the round in which the source sends its token of this number."""
        v = (token + 0.5) / self.shares[source]
        return np.clip(np.interp(v, self.knots, self.credit) // self.seq_len, 0, self.last - 1).astype("i8")

    def rounds_near(self, first: np.ndarray, length: np.ndarray, source: int) -> np.ndarray:
        """The ends of all rounds in which documents of one source may be sent: those between their first and last tokens, or
        those about every token where tokens are fewer."""
        filled = length > 0
        first, length = first[filled], length[filled]
        a, b = self.near(first, source), self.near(first + length - 1, source)
        by_token = b - a + 1 > length
        begin, size = np.where(by_token, first, a), np.where(by_token, length, b - a + 1)
        n = np.repeat(np.arange(len(first)), size)
        points = begin[n] + np.arange(len(n)) - np.repeat(np.cumsum(size) - size, size)
        sparse = np.unique(self.near(points[by_token[n]], source))  # rounds that prove to lie between these are searched by halves
        points = np.unique(points[~by_token[n]])
        off = (GROUP // 2 + 2) * self.grain // self.seq_len + 1
        around = np.unique(np.concatenate([sparse, sparse + 1, *(points + d for d in range(-off, off + 2))]))
        return np.unique(np.concatenate([[0], around[(around > 0) & (around < self.last)], [self.last]]))

    def pieces(self, first: np.ndarray, length: np.ndarray, source: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """For documents of one source that begin at ``first`` in its queue: of each piece, the document's number here, the start
        within it, the length, and the place in the stream."""
        k = self.rounds_near(first, length, source)
        edge, before = self.upto(k, source)
        while True:
            a = np.searchsorted(edge, first, "right") - 1
            n_rounds = np.where(length > 0, np.searchsorted(edge, first + length - 1, "right") - a, 0)
            doc = np.repeat(np.arange(len(first)), n_rounds)
            at = a[doc] + np.arange(len(doc)) - np.repeat(np.cumsum(n_rounds) - n_rounds, n_rounds)
            begin = np.maximum(first[doc], edge[at])
            end = np.minimum(first[doc] + length[doc], edge[at + 1])
            some = end > begin
            doc, at, begin, end = doc[some], at[some], begin[some], end[some]
            wide = np.unique(at[k[at + 1] - k[at] > 1])
            if not len(wide):
                break
            middle = (k[wide] + k[wide + 1]) // 2  # a round lies farther off than expected
            order = np.argsort(np.concatenate([k, middle]), kind="stable")
            k, edge, before = (np.concatenate(x)[order] for x in zip((k, edge, before), (middle, *self.upto(middle, source)), strict=True))
        place = k[at] * self.seq_len + before[at + 1] - before[at] + begin - edge[at]
        return doc, begin - first[doc], end - begin, place


def queue_key(source: Column) -> Column:
    """A name for the source's queue: the source itself after a letter (null: the letter n alone)."""
    return F.coalesce(F.concat(F.lit("s"), source), F.lit("n"))


def tokenized(docs: DataFrame, path: str, end_id: int) -> DataFrame:
    """Ids of every document with the end id, and where they begin in their queue within the partition."""
    kind = dict(docs.dtypes)["doc_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = coder(IdCoder, path)
        part = TaskContext.get().partitionId()
        queued: dict[str, int] = {}
        for batch in batches:
            for first, end in row_slices(batch.column(1)):
                rows = batch.slice(first, end - first)
                codes, at = encode(rows.column(1))
                ids = np.insert(codes, at[1:], end_id)
                at = at + np.arange(len(at))
                sizes = np.diff(at)
                starts = []
                for queue, size in zip(rows.column(2).to_pylist(), sizes.tolist(), strict=True):
                    starts.append(queued.get(queue, 0))
                    queued[queue] = starts[-1] + size
                held = pa.Array.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer((at * ids.itemsize).astype("i4").tobytes()), pa.py_buffer(ids.tobytes())])
                yield pa.RecordBatch.from_arrays([rows.column(0), rows.column(3), rows.column(2), pa.array([part] * len(sizes), pa.int32()), pa.array(starts, pa.int64()), pa.array(sizes, pa.int64()), held], ["doc_id", "source", "queue", "part", "queue_start", "doc_tokens", "ids"])

    frame = docs.select("doc_id", text_or_empty().alias("text"), queue_key(F.col("source")).alias("queue"), "source")
    return frame.mapInArrow(tidy(run), f"doc_id {kind}, source string, queue string, part int, queue_start long, doc_tokens long, ids binary")


def wanted_shares(spark, names: list[str], lengths: list[int], shares: dict[str | None, float] | None, temper: float) -> list[float]:
    """The queues' target shares: as given by source, or by their tokens to the power of ``temper``."""
    if shares is None:
        return [float(n) ** temper if n else 0.0 for n in lengths]
    given = spark.createDataFrame([*shares.items()], "source string, share double").groupBy(queue_key(F.col("source")).alias("queue")).agg(F.sum("share").alias("share"))
    by_queue = {r["queue"]: r["share"] for r in given.collect()}
    return [by_queue.get(n, 0.0) for n in names]


def pack(docs: DataFrame, path: str, end_id: int = 0, seq_len: int = 1024, grain: int = 1, shares: dict[str | None, float] | None = None, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", temper: float = 1.0) -> DataFrame:
    """One row per piece. ``shares``: target token proportions by source; without them, the sources' tokens to the power of
    ``temper`` (1: their shares of all tokens, so that all queues empty together; 0: equal shares). Sources without a share follow
    when the others are empty."""
    spark = docs.sparkSession
    width = np.dtype(coder(IdCoder, path).dtype).itemsize
    kind = dict(docs.dtypes)[id_col]
    docs = docs.select(quoted(id_col).alias("doc_id"), quoted(text_col).alias("text"), quoted(source_col).cast("string").alias("source"))
    stored = materialise(tokenized(docs, path, end_id), "packing-ids")
    held = stored.groupBy("queue", "part").agg(F.sum("doc_tokens").alias("tokens"))
    ends = materialise(held.withColumn("base", F.sum("tokens").over(Window.partitionBy("queue").orderBy("part")) - F.col("tokens")), "packing-ends")
    totals = ends.groupBy("queue").agg(F.sum("tokens").alias("tokens")).orderBy("queue").collect()
    names = [r["queue"] for r in totals]
    lengths = [r["tokens"] for r in totals]
    wanted = wanted_shares(spark, names, lengths, shares, temper)
    least = 1e-9 * max([w for w in wanted if w > 0], default=1.0)
    plan = Rounds(np.array(lengths), np.array([max(w, least) for w in wanted]), seq_len, grain) if names else None
    number = {n: k for k, n in enumerate(names)}
    dtype = "<u2" if width == 2 else "<u4"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            at, raw = raw_bytes(batch.column("ids"))
            ids = memoryview(raw.view(dtype).astype("<u4")).cast("B")
            at = at // np.dtype(dtype).itemsize
            queued = batch.column("queue").dictionary_encode()
            which = queued.indices.to_numpy()
            first, length = (batch.column(c).to_numpy() for c in ("first", "doc_tokens"))
            found = []
            by_queue = np.split(np.argsort(which, kind="stable"), np.cumsum(np.bincount(which))[:-1])
            for rows, queue in zip(by_queue, queued.dictionary.to_pylist(), strict=True):
                doc, *rest = plan.pieces(first[rows], length[rows], number[queue])
                found.append((rows[doc], *rest))
            row, start, size, place = (np.concatenate(x) for x in zip(*found, strict=True))
            begin = (at[row] + start) * 4
            crc = [zlib.crc32(ids[a:b]) for a, b in zip(begin.tolist(), (begin + size * 4).tolist(), strict=True)]
            taken = pa.array(row)
            columns = [start, size, crc, length[row], place // seq_len, place % seq_len]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").take(taken), *(pa.array(c, pa.int64()) for c in columns), batch.column("source").take(taken)], ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "source"])

    small = ends.select("queue", "part", "base")
    if ends.count() <= BROADCAST_ROWS:
        small = F.broadcast(small)
    placed = stored.join(small, ["queue", "part"]).select("doc_id", "source", "queue", (F.col("base") + F.col("queue_start")).alias("first"), "doc_tokens", "ids")
    return placed.mapInArrow(tidy(run), PIECES.format(id=kind))
