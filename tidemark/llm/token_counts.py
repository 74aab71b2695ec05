"""Token counts by prefix dynamic programming.

For a byte-pair vocabulary the encoding of a prefix ends in exactly one token t, and what stands before t is the encoding of the
prefix without it; t is the one candidate that may follow that encoding's last token, i.e. for which the pair encodes to itself.
Going through a word from left to right therefore gives the exact count at every prefix with one look at each candidate. The
counts of a text are kept as steps, one signed byte for each character: their running sum is the token count of each prefix, so
truncation and budget questions need no further encoding.

Nulls count as empty texts (0 tokens). Repeated rows give repeated results. Input columns other than the id and the text are
ignored, whatever their names. An empty table gives an empty result.

Very long texts are counted in parts of about ``SLICE_BYTES``, cut where no token can reach across; a part that can't be cut, such
as one word, is counted in one go, in linear time. What is kept of words and pairs of tokens is bounded.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tidemark.llm.common import SegmentCoder, coder, quoted, raw_bytes, row_slices, text_or_empty, tidy

#: Prefix tables are kept for the first so many letters of a word.
HEAD = 6
#: Words of more letters are counted by the tokens that begin at each place, others by those that end there.
LONG = 64
#: Counts of pre-tokens of more characters are kept for a moment, as the end of a text may be split anew several times.
HUGE = 256
#: Pairs of tokens of which it is kept whether the second may follow the first.
MOST_PAIRS = 2_000_000
_ASCII = re.compile(r" ?[A-Za-z]+")
_PLAIN = re.compile(r" ?(?:[A-Za-zÀ-ÖØ-öø-ɏ]+|[0-9]+)|[.,\n]")


class PrefixCounter(SegmentCoder):
    """Count steps for a byte-level BPE file of the ``tokenizers`` library, as its default settings count."""

    dtype = np.dtype("i1")

    def __init__(self, path: str) -> None:
        super().__init__()
        from tokenizers import Tokenizer

        model = json.load(open(path, encoding="utf-8"))
        self.vocab: dict[str, int] = model["model"]["vocab"]
        merges = (tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["model"]["merges"])
        self.ranks = {pair: rank for rank, pair in enumerate(merges)}
        self.longest = max(map(len, self.vocab))
        self.special = [t["content"] for t in model["added_tokens"]]
        self.pre_tokenizer = Tokenizer.from_file(path).pre_tokenizer
        letters = [*range(33, 127), *range(161, 173), *range(174, 256)]
        self.letter = {b: chr(b) for b in letters} | {b: chr(256 + n) for n, b in enumerate(b for b in range(256) if b not in set(letters))}
        self.states: dict[str, tuple[str, dict[str, bool]]] = {}
        self.heads: dict[str, tuple[list, list[int]]] = {}
        self.whole: dict[str, bool] = {}
        self.beginnings: dict[str, bool] = {}  # beginnings of tokens, and whether they are tokens; made when a long word comes
        self.recent: tuple[str, list[int]] = ("", [])
        self.pairs = 0
        self.special_pattern = re.compile("|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) or r"(?!)")

    def merged(self, word: str) -> list[str]:
        """The word's tokens by the merges themselves; only pairs of tokens are asked for."""
        parts = list(word)
        while len(parts) > 1:
            rank, at = min((self.ranks.get((a, b), 1 << 60), n) for n, (a, b) in enumerate(zip(parts, parts[1:], strict=False)))
            if rank == 1 << 60:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def state(self, token: str) -> tuple[str, dict[str, bool]]:
        """A last token, with what is known of the tokens that may follow it."""
        if (known := self.states.get(token)) is None:
            known = self.states[token] = (token, {})
        return known

    def alone(self, token: str) -> bool:
        if (known := self.whole.get(token)) is None:
            known = self.whole[token] = self.merged(token) == [token]
        return known

    def counts(self, word: str) -> list[int]:
        """The token counts of the prefixes of a pre-token that is written in the vocabulary's byte letters.

        The first letters' part of the table is kept, as many words share it."""
        vocab, longest, size = self.vocab, self.longest, len(word)
        if size > LONG:
            return self.long_counts(word)
        if size > HEAD and (head := self.heads.get(word[:HEAD])):
            last, count, done = [*head[0]], [*head[1]], HEAD
        else:
            last, count, done = [None], [0], 0
        for end in range(done + 1, size + 1):
            for start in range(end - longest if end > longest else 0, end):
                token = word[start:end]
                if token in vocab:
                    if start == 0:
                        fits = self.alone(token)
                    else:
                        before, follows = last[start]
                        fits = follows.get(token)
                        if fits is None:
                            fits = follows[token] = self.merged(before + token) == [before, token]
                            self.pairs += 1
                    if fits:
                        last.append(self.state(token))
                        count.append(count[start] + 1)
                        break
            else:
                raise ValueError(f"the vocabulary has no token for {word[end - 1 : end]!r}")
        if self.pairs > MOST_PAIRS:
            self.states.clear()
            self.heads.clear()
            self.pairs = 0
        if not done and size > HEAD:
            if len(self.heads) > 100_000:
                self.heads.clear()
            self.heads[word[:HEAD]] = last[: HEAD + 1], count[: HEAD + 1]
        return count[1:]

    def fits(self, before: tuple[str, dict[str, bool]] | None, token: str) -> bool:
        """Whether the token may follow this last token (None: begin a word)."""
        if before is None:
            return self.alone(token)
        found = before[1].get(token)
        if found is None:
            found = before[1][token] = self.merged(before[0] + token) == [before[0], token]
            self.pairs += 1
        return found

    def long_counts(self, word: str) -> list[int]:
        """The same as ``counts``. From each place the letters are followed as long as a token begins with them, which is a few
        letters in any script; so no place is looked at with all the lengths that tokens can have."""
        if not self.beginnings:
            for token in self.vocab:
                for n in range(1, len(token)):
                    self.beginnings.setdefault(token[:n], False)
                self.beginnings[token] = True
        size, begins = len(word), self.beginnings
        last: list = [None] * (size + 1)
        count = [0] * (size + 1)
        ending: list[list[int] | None] = [[] for _ in range(size + 1)]
        for place in range(size + 1):
            if place:
                start = next((s for s in ending[place] if self.fits(last[s] if s else None, word[s:place])), None)
                if start is None:
                    raise ValueError(f"the vocabulary has no token for {word[place - 1 : place]!r}")
                last[place], count[place] = self.state(word[start:place]), count[start] + 1
                ending[place] = None
            for stop in range(place + 1, size + 1):
                if (whole := begins.get(word[place:stop])) is None:
                    break
                if whole:
                    ending[stop].append(place)
        if self.pairs > MOST_PAIRS:
            self.states.clear()
            self.heads.clear()
            self.pairs = 0
        return count[1:]

    def piece_counts(self, piece: str) -> list[int]:
        """The same by characters of a pre-token of ordinary text."""
        if len(piece) > HUGE:
            if self.recent[0] != piece:
                self.recent = (piece, self.character_counts(piece))
            return self.recent[1]
        return self.character_counts(piece)

    def character_counts(self, piece: str) -> list[int]:
        if piece.isascii():
            return self.counts(piece.translate(self.letter))
        raw = piece.encode("utf-8", "surrogatepass")
        counts = self.counts("".join(map(self.letter.__getitem__, raw)))
        return [c for c, b in zip(counts, [*raw[1:], 0], strict=True) if b & 0xC0 != 0x80]

    def text_counts(self, text: str) -> list[int]:
        """Counts at every prefix of a segment of any form. Special tokens part it; what ends within one is counted as plain text."""
        out: list[int] = []
        base = last = 0
        for found in self.special_pattern.finditer(text):
            head = text[last : found.start()]
            counts = self.plain_counts(head)
            out += [base + c for c in counts]
            # what follows can't change the pre-tokens of the head but its last two, so only these are split again
            cut = ([a for _, (a, _) in self.pre_tokenizer.pre_tokenize_str(head)][-2:] or [0])[0] if head else 0
            settled = base + (counts[cut - 1] if cut else 0)
            out += [settled + self.ending(head[cut:] + found[0][:n]) for n in range(1, len(found[0]))]
            base += (counts[-1] if counts else 0) + 1
            out.append(base)
            last = found.end()
        return [*out, *(base + c for c in self.plain_counts(text[last:]))]

    def plain_counts(self, text: str) -> list[int]:
        """Counts at every prefix of a segment without special tokens.

        Cutting a text leaves its pre-tokens as they are but for the last, with two exceptions, for which the end is split anew: a
        contraction that isn't complete, and white space whose last character would have led the next word."""
        pieces = [text[a:b] for _, (a, b) in self.pre_tokenizer.pre_tokenize_str(text)] if text else []
        out: list[int] = []
        base, before = 0, 0
        for n, piece in enumerate(pieces):
            counts = self.piece_counts(piece)
            for k in range(1, len(piece) + 1):
                if n and k == 1 and piece[0].isspace() and pieces[n - 1].isspace():
                    out.append(before + self.ending(pieces[n - 1] + piece[0]))
                elif piece[0] == "'" and 1 < k < len(piece) and piece[1].isalpha():
                    out.append(base + self.ending(piece[:k]))
                else:
                    out.append(base + counts[k - 1])
            before, base = base, base + counts[-1]
        return out

    def ending(self, text: str) -> int:
        return sum(self.piece_counts(text[a:b])[-1] for _, (a, b) in self.pre_tokenizer.pre_tokenize_str(text))

    def encode_segments(self, segments: list[str]) -> list[np.ndarray]:
        out = []
        plain, ascii_plain = _PLAIN.fullmatch, _ASCII.fullmatch
        for segment in segments:
            if ascii_plain(segment):
                counts = self.counts("Ġ" + segment[1:] if segment[0] == " " else segment)
            else:
                counts = self.piece_counts(segment) if plain(segment) else self.text_counts(segment)
            out.append(np.diff(counts, prepend=0).astype("i1") if len(counts) > 32 else np.array([b - a for a, b in zip([0, *counts], counts, strict=False)], "i1"))
        return out


def tokens_at(steps: bytes, n_chars: int) -> int:
    """The token count of the first ``n_chars`` characters."""
    return int(np.frombuffer(steps, "i1")[:n_chars].sum(dtype="i8"))


def longest_prefix(steps: bytes, budget: int) -> int:
    """The most characters that a prefix of at most ``budget`` tokens has."""
    counts = np.frombuffer(steps, "i1").cumsum(dtype="i4")
    fits = np.flatnonzero(counts <= budget)
    return int(fits[-1]) + 1 if len(fits) else 0


def token_counts(docs: DataFrame, path: str, limit: int = 1024, id_col: str = "doc_id", text_col: str = "text", keep_steps: bool = False) -> DataFrame:
    """Per row: the id, n_bytes, n_tokens, over_limit, fits_chars (the longest prefix within the limit) and, if asked for, the steps."""
    kind = dict(docs.dtypes)[id_col]
    schema = f"id {kind}, n_bytes long, n_tokens long, over_limit boolean, fits_chars long" + ", token_steps binary" * keep_steps

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = coder(PrefixCounter, path)
        for batch in batches:
            for first, end in row_slices(batch.column(1)):
                rows = batch.slice(first, end - first)
                steps, at = encode(rows.column(1))
                totals = np.concatenate([[0], np.cumsum(steps, dtype="i8")])
                n_tokens = totals[at[1:]] - totals[at[:-1]]
                fits = np.diff(at)
                for n in np.flatnonzero(n_tokens > limit):
                    fits[n] = longest_prefix(steps[at[n] : at[n + 1]], limit)
                n_bytes = np.diff(raw_bytes(rows.column(1))[0])
                columns = [rows.column(0), pa.array(n_bytes), pa.array(n_tokens), pa.array(n_tokens > limit), pa.array(fits)]
                names = ["id", "n_bytes", "n_tokens", "over_limit", "fits_chars"]
                if keep_steps:
                    columns.append(pa.Array.from_buffers(pa.binary(), len(fits), [None, pa.py_buffer(at.astype("i4").tobytes()), pa.py_buffer(steps.tobytes())]))
                    names.append("token_steps")
                yield pa.RecordBatch.from_arrays(columns, names)

    found = docs.select(quoted(id_col).alias("id"), text_or_empty(text_col).alias("text")).mapInArrow(tidy(run), schema)
    return found.withColumnRenamed("id", id_col)
