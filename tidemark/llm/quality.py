"""Quality rules: a decision list learned by sequential covering.

Text statistics of labelled documents (a bounded sample) are split into a part to grow on and a part to prune on. Rules for bad
documents are learned one after another: a rule grows by the threshold condition with the largest information gain until it
covers no good document, then loses the final conditions whose removal does not harm it on the other part; it stays only if it is
precise enough there, and what it covers is taken away before the next. The list becomes one ordered Spark conditional
expression over the statistics' columns: the first rule that holds names the verdict, and a document that none covers is kept.

Null texts are empty (no words, so the base rule rejects them). Repeated rows get the same verdict. Other columns are ignored,
whatever their names. Without labelled rows of both classes the list is empty and only the base rule decides. An empty table gives
an empty result.

Very long texts: a text is one value in one task, and its words are held as a list, so the counting takes some twenty times the
text's size in memory, for one text at a time.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import numbered, quoted, renamed, tidy
from tidemark.llm.toxicity import sample_of

SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\r\x0b\x0c"
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_marks", "n_distinct_words", "n_digits")
_UPPER = bytes(range(ord("A"), ord("Z") + 1))
_DIGITS = b"0123456789"


def repeated(words: list[bytes]) -> int:
    """Words that stand in a 3-word window that the text has twice or more."""
    if len(words) < 4:
        return 0
    number: dict[bytes, int] = {}
    ids = np.array([number.setdefault(w, len(number)) for w in words], "i8")
    if len(number) < 2_000_000:
        windows = (ids[:-2] * len(number) + ids[1:-1]) * len(number) + ids[2:]
    else:
        _, pairs = np.unique(ids[:-1] * len(number) + ids[1:], return_inverse=True)
        windows = pairs[:-1] * len(number) + ids[2:]
    order = np.argsort(windows, kind="stable")
    same = windows[order[1:]] == windows[order[:-1]]
    if not same.any():
        return 0
    twice = np.zeros(len(words), bool)
    hit = np.zeros(len(windows), bool)
    hit[order[1:][same]] = True
    hit[order[:-1][same]] = True
    for k in range(3):
        twice[k : len(windows) + k] |= hit
    return int(twice.sum())


def text_stats(text: str) -> tuple[int, ...]:
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()
    lines = [line for line in text.split("\n") if line.strip(SPACES)]
    return (
        len(words),
        len(text) - sum(map(text.count, SPACES)),
        sum(map(text.count, SYMBOLS)),
        len(lines) - len(set(lines)),
        repeated(words),
        len(lines),
        len(raw) - len(raw.translate(None, _UPPER)),
        text.count("!") + text.count("?"),
        len(set(words)),
        len(raw) - len(raw.translate(None, _DIGITS)),
    )


def with_stats(docs: DataFrame, keep: list[str], text_col: str = "text") -> DataFrame:
    """The columns in ``keep`` as c0, c1, ..., and the counts of the whole text, each as ``_s_<name>``."""
    place = keep.index(text_col) if text_col in keep else len(keep)
    frame = docs.select(*map(quoted, keep), *([] if text_col in keep else [quoted(text_col)]))
    kept, names = [f"c{n}" for n in range(len(keep))], [f"_s_{c}" for c in COUNTS]
    schema = ", ".join([f"{c} {kind}" for c, (_, kind) in zip(kept, frame.dtypes, strict=False)] + [f"{n} long" for n in names])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            stats = zip(*(text_stats(t.as_py() or "") for t in batch.column(place)), strict=True)
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], *(pa.array(s, pa.int64()) for s in stats)], [*kept, *names])

    return numbered(frame).mapInArrow(tidy(run), schema)


def measures(prefix: str = "_s_") -> dict[str, Column]:
    """The statistics that rules speak of, as Spark expressions over the counts."""
    c = {n: F.col(prefix + n).cast("double") for n in COUNTS}
    words, chars, lines = (F.greatest(c[n], F.lit(1.0)) for n in ("n_words", "word_chars", "n_lines"))
    return {
        "symbols_per_word": c["n_symbols"] / words,
        "marks_per_word": c["n_marks"] / words,
        "upper_share": c["n_upper"] / chars,
        "dup_line_share": c["n_dup_lines"] / lines,
        "repeat_share": c["n_repeat_words"] / words,
        "distinct_share": c["n_distinct_words"] / words,
        "mean_word_chars": c["word_chars"] / words,
        "words_per_line": c["n_words"] / lines,
        "digit_share": c["n_digits"] / chars,
        "words": c["n_words"],
    }


@dataclass(frozen=True)
class Condition:
    measure: str
    above: bool
    threshold: float

    def holds(self, x: np.ndarray, names: list[str]) -> np.ndarray:
        v = x[:, names.index(self.measure)]
        return v >= self.threshold if self.above else v < self.threshold

    def column(self, columns: dict[str, Column]) -> Column:
        return columns[self.measure] >= F.lit(self.threshold) if self.above else columns[self.measure] < F.lit(self.threshold)

    def __str__(self) -> str:
        return f"{self.measure} {'>=' if self.above else '<'} {self.threshold:.6g}"


Rule = tuple[Condition, ...]


def covers(rule: Rule, x: np.ndarray, names: list[str]) -> np.ndarray:
    held = np.ones(len(x), bool)
    for condition in rule:
        held &= condition.holds(x, names)
    return held


def grow(x: np.ndarray, bad: np.ndarray, names: list[str], cuts: int = 64, most: int = 5) -> Rule:
    rule: Rule = ()
    inside = np.ones(len(x), bool)
    while len(rule) < most and (inside & ~bad).any():
        p, n = (inside & bad).sum(), (inside & ~bad).sum()
        best, gain = None, 1e-9
        for k, name in enumerate(names):
            v, y = x[inside, k], bad[inside]
            order = np.argsort(v, kind="stable")
            values, tops = v[order], np.concatenate([[0], np.cumsum(y[order])])
            places = np.flatnonzero(values[1:] > values[:-1]) + 1
            if len(places) > cuts * 16:
                places = places[:: len(places) // (cuts * 16) + 1]
            for above in (True, False):
                pos = (tops[-1] - tops[places] if above else tops[places]).astype("f8")
                neg = (len(v) - places if above else places) - pos
                with np.errstate(divide="ignore", invalid="ignore"):
                    g = np.where(pos > 0, pos * (np.log2(pos / (pos + neg)) - np.log2(p / (p + n))), 0)
                if len(g) and g.max() > gain:
                    at = places[int(g.argmax())]
                    best, gain = Condition(name, above, float((values[at - 1] + values[at]) / 2)), float(g.max())
        if best is None:
            break
        rule += (best,)
        inside &= best.holds(x, names)
    return rule


def prune(rule: Rule, x: np.ndarray, bad: np.ndarray, names: list[str]) -> Rule:
    """The beginning of the rule that is worth most on the part kept for pruning: (bad - good) / (bad + good)."""
    def worth(r: Rule) -> float:
        held = covers(r, x, names)
        p, n = (held & bad).sum(), (held & ~bad).sum()
        return (p - n) / (p + n) if p + n else -1.0

    return max((rule[:k] for k in range(len(rule), 0, -1)), key=worth, default=())


def learn(x: np.ndarray, bad: np.ndarray, names: list[str], least_precision: float = 0.9, most_rules: int = 12, seed: int = 7) -> list[Rule]:
    """Rules for bad documents, in the order in which they apply."""
    order = np.random.default_rng(seed).permutation(len(x))
    x, bad = x[order], bad[order]
    rules: list[Rule] = []
    while bad.any() and (~bad).any() and len(rules) < most_rules:
        cut = np.arange(len(x)) % 3 < 2
        rule = prune(grow(x[cut], bad[cut], names), x[~cut], bad[~cut], names)
        held = covers(rule, x, names)
        checked = held & ~cut
        if not rule or held[bad].sum() < 5 or checked.sum() < 2 or bad[checked].mean() < least_precision or bad[held].mean() < least_precision:
            break
        rules.append(rule)
        x, bad = x[~held], bad[~held]
    return rules


def verdict(rules: list[Rule], columns: dict[str, Column]) -> Column:
    """The number of the first rule that holds (from 1), or 0."""
    chain = None
    for n, rule in enumerate(rules, 1):
        held = rule[0].column(columns)
        for condition in rule[1:]:
            held = held & condition.column(columns)
        chain = F.when(held, F.lit(n)) if chain is None else chain.when(held, F.lit(n))
    return F.lit(0) if chain is None else chain.otherwise(F.lit(0))


def base_failed(prefix: str = "_s_") -> Column:
    return (F.col(prefix + "n_words") < 50) | (100 * F.col(prefix + "n_repeat_words") > 50 * F.col(prefix + "n_words"))


def train(docs: DataFrame, labels: DataFrame, max_rows: int = 4000, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> list[Rule]:
    """A list learned from at most ``max_rows`` labelled documents that pass the base rule."""
    sample = sample_of(docs, labels, quoted(label_col), max_rows, id_col, text_col, F.lit(True))
    named = measures()
    rows = with_stats(sample, ["label"]).where(~base_failed()).select(F.col("c0").alias("label"), *(m.alias(n) for n, m in named.items())).orderBy("label", *named).collect()
    if not rows:
        return []
    x = np.array([[r[n] for n in named] for r in rows], "f8")
    return learn(x, np.array([r["label"] == 0 for r in rows]), list(named))


def quality(docs: DataFrame, labels: DataFrame, max_rows: int = 4000, id_col: str = "doc_id", text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The id (or the columns in ``keep``), the counts, base_failed, rule (0: none) and kept."""
    rules = train(docs, labels, max_rows, id_col, text_col)
    named = keep or [id_col]
    frame = with_stats(docs, named, text_col)
    base, rule = base_failed(), verdict(rules, measures())
    return frame.select(*(F.col(f"c{n}").alias(c) for n, c in enumerate(named)), *(F.col(f"_s_{c}").alias(c) for c in COUNTS[:5]), base.alias("base_failed"), rule.alias("rule"), (~base & (rule == 0)).alias("kept"))


def passing(docs: DataFrame, labels: DataFrame, max_rows: int = 4000, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents that are kept, with all their columns."""
    rules = train(docs, labels, max_rows, id_col, text_col)
    plain = numbered(docs)
    stats = with_stats(plain, plain.columns, f"c{docs.columns.index(text_col)}")
    return renamed(stats.where(~base_failed() & (verdict(rules, measures()) == 0)), docs.columns)
