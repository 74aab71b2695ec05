"""Toxicity: a linear classifier on character n-grams whose features are scaled by naive Bayes log-count ratios.

Fitting takes a bounded sample of labelled rows (``max_rows`` of the lowest hash). Spark counts, for every n-gram, the texts of
each class that hold it; the ``max_features`` n-grams that tell the classes apart best (chi square) become features, each with
its log ratio r = log((toxic + a) / all toxic) - log((clean + a) / all clean). A logistic regression is then fitted on the rows
x_i = r_i [text has n-gram i], and scores any text by its distinct n-grams. Both bounds are parameters and don't follow the
input; what is broadcast is the model (under 200 kB). Whole texts are read, lower-cased.

Null texts are empty; a text without any feature has the score of the intercept. Rows without a label, or with a null one, are
scored but not learned from. Repeated rows are scored alike. A label that a document has twice counts once, as the larger. Other
columns are ignored, whatever their names. Of a labelled id with several texts the least one is learned from. Without labelled rows
of both classes, every score is 0. An empty table gives an empty result.

Very long texts: a text is one value in one task; its n-grams are looked up in pieces of ``PIECE`` characters, so beside the text
and its lower-cased form the memory is bounded.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import numbered, quoted, renamed, text_or_empty, tidy

ORDERS = (3, 4, 5, 6)
#: Characters whose n-grams are worked out at a time.
PIECE = 1 << 18
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def gram_hashes(text: str, orders: tuple[int, ...] = ORDERS) -> Iterator[np.ndarray]:
    """64-bit hashes of the character n-grams of each order, of all places, over the lower-cased text between two spaces.

    Line breaks and tabs count as spaces, so that a word begins alike wherever it stands."""
    lowered = f" {text.lower()} "
    for begin in range(0, len(lowered), PIECE):
        # pieces overlap by what the longest n-grams reach over
        points = np.frombuffer(lowered[begin : begin + PIECE + max(orders) - 1].encode("utf-32-le", "surrogatepass"), "<u4").astype("u8")
        points[(points >= 9) & (points <= 13)] = 32
        h = np.zeros(len(points), "u8")
        for n in range(1, min(max(orders), len(points)) + 1):
            h = (h[: len(points) - n + 1] + points[n - 1 :]) * _MULTIPLIER
            h ^= h >> np.uint64(29)
            if n in orders:
                yield h


@dataclass
class Model:
    """Hashes of the features in ascending order, their weights (ratio times coefficient), and the intercept."""

    hashes: np.ndarray
    weights: np.ndarray
    intercept: float

    def __post_init__(self) -> None:
        self.seen = np.zeros(1 << 18, bool)
        self.seen[(self.hashes >> np.uint64(46)).astype("i8")] = True

    def features(self, text: str) -> np.ndarray:
        """The numbers of the features that the text has."""
        has = np.zeros(len(self.hashes), bool)
        for h in gram_hashes(text):
            maybe = h[self.seen[(h >> np.uint64(46)).astype("i8")]]
            if len(maybe) and len(self.hashes):
                at = np.minimum(np.searchsorted(self.hashes, maybe), len(self.hashes) - 1)
                has[at[self.hashes[at] == maybe]] = True
        return np.flatnonzero(has)

    def score(self, text: str) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.intercept + self.weights[self.features(text)].sum(), -40, 40))))


def logistic(rows: list[np.ndarray], labels: np.ndarray, ratios: np.ndarray, penalty: float = 0.02, steps: int = 300, toxic_weight: float = 3.0) -> tuple[np.ndarray, float]:
    """Coefficients of the scaled features and the intercept, by gradient steps with per-coordinate rates on the whole sample.

    Toxic rows are rarer and weigh ``toxic_weight`` times as much."""
    weight = np.where(labels > 0, toxic_weight, 1.0)
    index = np.concatenate(rows) if rows else np.zeros(0, "i8")
    row = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    value = ratios[index]
    w, b = np.zeros(len(ratios) + 1), float(np.log((labels.sum() + 1) / (len(labels) - labels.sum() + 1)))
    w[-1] = b
    first, second = np.zeros_like(w), np.zeros_like(w)
    for step in range(1, steps + 1):
        z = w[-1] + np.bincount(row, value * w[index], len(rows))
        error = 1 / (1 + np.exp(-np.clip(z, -40, 40))) - labels
        error *= weight
        grad = np.append(np.bincount(index, value * error[row], len(ratios)), error.sum()) / len(rows)
        grad[:-1] += penalty / len(ratios) * w[:-1]
        first, second = 0.9 * first + 0.1 * grad, 0.99 * second + 0.01 * grad * grad
        w -= 0.05 * first / (1 - 0.9**step) / (np.sqrt(second / (1 - 0.99**step)) + 1e-8)
    return w[:-1], float(w[-1])


def sample_of(docs: DataFrame, labels: DataFrame, label: Column, max_rows: int, id_col: str, text_col: str, may_learn: Column) -> DataFrame:
    """(text, label) of at most ``max_rows`` labelled documents, those of the lowest hash of the id; the ids are chosen first. Of
    an id with several texts the least one counts, so that a task that is run again gives the same rows."""
    spark = docs.sparkSession
    known = labels.where(label.isNotNull() & quoted(id_col).isNotNull() & may_learn).groupBy(quoted(id_col).alias("_id")).agg(F.max(label.cast("int")).alias("_label"))
    rows = known.orderBy(F.md5(F.col("_id").cast("string")), "_id").limit(max_rows).collect()
    chosen = spark.createDataFrame(rows, known.schema) if rows else known.limit(0)
    texts = docs.select(quoted(id_col).alias("_id"), text_or_empty(text_col).alias("text")).join(F.broadcast(chosen), "_id")
    return texts.groupBy("_id", "_label").agg(F.min("text").alias("text")).select("text", F.col("_label").alias("label"))


def fit(sample: DataFrame, max_features: int = 4096, least_texts: int = 5, smooth: float = 1.0) -> Model:
    sample = sample.persist()
    try:
        totals = {r["label"]: r["count"] for r in sample.groupBy("label").count().collect()}
        n1, n0 = totals.get(1, 0), totals.get(0, 0)
        if not n1 or not n0:
            return Model(np.zeros(0, "u8"), np.zeros(0), -40.0)

        def grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for text, label in zip(batch.column("text").to_pylist(), batch.column("label").to_pylist(), strict=True):
                    found = np.unique(np.concatenate([*gram_hashes(text), np.zeros(0, "u8")])).view("i8")
                    if len(found):
                        yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(np.full(len(found), label, "i4"))], ["gram", "label"])

        counts = sample.mapInArrow(tidy(grams), "gram long, label int").groupBy("gram").agg(F.sum("label").alias("toxic"), F.count("*").alias("texts")).where(F.col("texts") >= least_texts)
        a, n = F.col("toxic").cast("double"), F.col("texts").cast("double")
        expected = n * F.lit(n1 / (n0 + n1))
        gain = (a - expected) * (a - expected) / (expected * (1 - n / (n0 + n1)) + 1e-9)
        best = counts.orderBy(gain.desc(), "gram").limit(max_features).collect()
        hashes = np.array([r["gram"] for r in best], "i8").view("u8")
        toxic = np.array([r["toxic"] for r in best], "f8")
        clean = np.array([r["texts"] for r in best], "f8") - toxic
        order = np.argsort(hashes)
        hashes, toxic, clean = hashes[order], toxic[order], clean[order]
        ratios = np.log((toxic + smooth) / (n1 + 2 * smooth)) - np.log((clean + smooth) / (n0 + 2 * smooth))
        plain = Model(hashes, ratios, 0.0)

        def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                yield pa.RecordBatch.from_arrays([pa.array([plain.features(t).astype("<i4").tobytes() for t in batch.column("text").to_pylist()], pa.binary()), batch.column("label")], ["found", "label"])

        rows = sample.mapInArrow(tidy(vectors), "found binary, label int").collect()
        coefficients, intercept = logistic([np.frombuffer(r["found"], "<i4").astype("i8") for r in rows], np.array([r["label"] for r in rows], "f8"), ratios)
        return Model(hashes, ratios * coefficients, intercept)
    finally:
        sample.unpersist()


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The id (or the columns in ``keep``, of which none is named score) with the score of the whole text."""
    names = keep or [id_col]
    place = names.index(text_col) if text_col in names else len(names)
    frame = docs.select(*map(quoted, names), *([] if text_col in names else [quoted(text_col)]))
    schema = ", ".join(f"c{n} {kind}" for n, (_, kind) in enumerate(frame.dtypes[: len(names)])) + ", score double"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = pa.array([model.score(t.as_py() or "") for t in batch.column(place)], pa.float64())
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(names)], scores], [*(f"c{n}" for n in range(len(names))), "score"])

    return numbered(frame).mapInArrow(tidy(run), schema).toDF(*names, "score")


def held_out(id_col: str = "doc_id") -> Column:
    """Whether crc32 of the id as text leaves no remainder by 5; such rows aren't learned from."""
    return F.coalesce(F.crc32(quoted(id_col).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, max_rows: int = 4000, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> Model:
    return fit(sample_of(docs, labels, quoted(label_col), max_rows, id_col, text_col, ~held_out(id_col)))


def toxicity(docs: DataFrame, labels: DataFrame, max_rows: int = 4000, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, held_out, score, predicted."""
    scored = score(docs, train(docs, labels, max_rows, id_col, text_col), id_col, text_col)
    return scored.select(quoted(id_col), held_out(id_col).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def without_toxic(docs: DataFrame, labels: DataFrame, max_rows: int = 4000, id_col: str = "doc_id", text_col: str = "text", limit: float = 0.5) -> DataFrame:
    """The documents whose score is below the limit, with all their columns."""
    plain = numbered(docs)
    scored = score(plain, train(docs, labels, max_rows, id_col, text_col), text_col=f"c{docs.columns.index(text_col)}", keep=plain.columns)
    return renamed(scored.where(F.col("score") < limit), docs.columns)
