"""Line removal, periodic runs and vector codes against brute force, on odd rows too."""

import hashlib
import random
import re
import struct
import time
import zlib
from collections import defaultdict
from fractions import Fraction

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidemark.llm import jaccard_join, line_dedup, line_dedup_sql, mixing, packing, periodic, queries, token_counts, vector_codes, vector_codes_sql

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, h1 string, places string, runs int"
SPACE = re.compile("[\x20\x09-\x0d]+")


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "en", None, 1, "x", "y", 3) for i, t in rows], SCHEMA)


# ---- lines

LONG = "This line is long enough to be a key of its own, number %s"


def lines_by_hand(rows, least, copies):
    white = " \t\n\x0b\x0c\r"
    key = lambda line: "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(white))
    holders = defaultdict(set)
    for i, t in set(rows):
        for line in (t or "").split("\n"):
            holders[key(line)].add((i, t))
    low = lambda i: (i is not None, i or 0)
    frequent = {k: max((i for i, _ in h), key=low) for k, h in holders.items() if len(k) >= least and len(h) >= copies}
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if key(x) not in frequent or frequent[key(x)] == i]
        out.append((i, "\n".join(kept), len(lines), len(lines) - len(kept)))
    return sorted(out, key=str)


def test_lines_against_brute_force(spark):
    draw = random.Random(5)
    rows = []
    for n in range(120):
        lines = [draw.choice(["", " ", "short", LONG % draw.randrange(25), ("\t" + LONG % draw.randrange(25) + " \x0b").upper(), "É" + LONG % draw.randrange(3), "é" + LONG % draw.randrange(3)]) for _ in range(draw.randrange(12))]
        rows.append((n * 7 % 120, "\n".join(lines)))
    rows += [(None, LONG % 1), (None, LONG % 1), (None, LONG % 2), (500, None), (501, ""), (502, "\n"), (503, LONG % 3), (503, LONG % 3 + "\n" + LONG % 3), (504, LONG % 4 + "\n" + LONG % 4), (504, LONG % 4 + "\n" + LONG % 4)]
    rows += [(-5, (LONG % 5 + "\n") * 5000)]
    got = line_dedup.without_repeated_lines(frame(spark, rows), least=40, copies=5, batches=5, fanout=2)
    assert got.columns == ["doc_id", "text", "n_lines", "n_dropped"]
    assert sorted(map(tuple, got.collect()), key=str) == lines_by_hand(rows, 40, 5)
    assert line_dedup.without_repeated_lines(frame(spark, [])).count() == 0


def test_line_runs_hold_each_hash_once_on_levels(spark):
    index = line_dedup.LineRuns(spark, buckets=4, fanout=2)
    batches = [[(k % m, k, 100 - b) for k in range(0, 40, step)] for b, (m, step) in enumerate([(7, 1), (7, 2), (9, 3), (11, 1), (5, 4)])]
    for rows in batches:
        index.add(spark.createDataFrame(rows, "h1 long, h2 long, doc_id long"))
    assert all(len(level) < 2 for level in index.runs) and len(index.runs) == 3
    held = [tuple(r) for level in index.runs for name in level for r in spark.table(name).select("h1", "h2").collect()]
    assert len(held) == len(set(held))
    n, keeper = defaultdict(int), {}
    for rows in batches:
        for a, b, i in rows:
            n[a, b] += 1
            keeper.setdefault((a, b), i)
    assert {(r.h1, r.h2): (r.n, r.keeper) for r in index.totals().collect()} == {k: (n[k], keeper[k]) for k in n}
    assert {tuple(r) for r in index.fresh(spark.createDataFrame([(3, 3), (3, 4)], "h1 long, h2 long")).collect()} == {(3, 4)}
    plan = index.fresh(spark.table(index.runs[-1][0]))._jdf.queryExecution().executedPlan().toString()
    assert "LeftAnti" in plan and "Exchange" not in plan.replace("BroadcastExchange", "")
    index.close()
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("tidemark_")]


# ---- runs


def runs_by_hand(s, shortest, exponent):
    found = set()
    for p in range(1, len(s) // exponent + 1):
        i = 0
        while i + p < len(s):
            j = i
            while j + p < len(s) and s[j] == s[j + p]:
                j += 1
            length = j - i + p
            stretch = s[i : i + length]
            if j > i and length >= max(shortest, exponent * p) and not any(all(stretch[x] == stretch[x + q] for x in range(length - q)) for q in range(1, p)):
                found.add((i, length, p))
            i = j + 1
    return sorted(found, key=lambda r: (r[0], r[2]))


def pieces(draw, n, letters):
    out = []
    while len(out) < n:
        unit = [draw.randrange(letters) for _ in range(draw.randint(1, 9))]
        out += (unit * draw.randint(1, 6))[: draw.randint(1, 60)]
    return out


def test_lyndon_lengths_are_those_of_the_longest_lyndon_words():
    draw = random.Random(1)
    for _ in range(800):
        s = np.unique([draw.randrange(draw.randint(1, 3)) for _ in range(draw.randint(1, 14))], return_inverse=True)[1].tolist()
        n = len(s)
        want = [max(k for k in range(1, n - i + 1) if all(s[i : i + k] < s[i + x : i + k] for x in range(1, k))) for i in range(n)]
        assert periodic.lyndon_lengths(s) == want, s
    assert periodic.lyndon_lengths([]) == []


def test_runs_against_brute_force():
    draw = random.Random(2)
    for _ in range(400):
        s = pieces(draw, draw.randint(0, 120), draw.randint(1, 5))
        for shortest, exponent in ((24, 3), (6, 3), (4, 2), (2, 2), (12, 4)):
            assert periodic.runs_of(np.array(s, "i8"), shortest, exponent) == runs_by_hand(s, shortest, exponent), s


def digests_by_hand(doc_id, text):
    words = [w for w in SPACE.split(text or "") if w]
    n, h = len(words), zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
    runs = runs_by_hand(words, 24, 3)
    best = max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=None)
    kept = [w for i, w in enumerate(words) if not any(s + q <= i < s + size for s, size, q in runs)]
    digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return (doc_id, len(runs), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None, digest("".join(f"{s},{size},{q}\n" for s, size, q in runs)), digest(" ".join(kept)))


def test_run_digests_against_brute_force(spark, data):
    draw = random.Random(3)
    rows = [(n, " ".join(f"w{x}" for x in pieces(draw, draw.randint(0, 150), 3))) for n in range(150)]
    rows += [(200, None), (201, ""), (202, " \t\n"), (203, "same\x0bsame\x0csame " * 10), (204, "  é " * 30), (None, "a b " * 20), (203, "x " * 24), (203, "x " * 24), (205, "one two three " * 900), (206, "ü" * 3000)]
    rows += [(r.doc_id, r.text) for r in spark.read.parquet(f"{data}/documents.parquet").limit(25).collect()]
    got = periodic.run_digests(periodic.periodic_runs(periodic.made_periodic(frame(spark, rows))))
    assert sorted(map(tuple, got.collect()), key=str) == sorted((digests_by_hand(*r) for r in rows), key=str)
    assert periodic.run_digests(periodic.periodic_runs(periodic.made_periodic(frame(spark, [])))).count() == 0
    with pytest.raises(ValueError, match="exponent"):
        periodic.periodic_runs(frame(spark, []), exponent=1)


# ---- vector codes


def codes_by_hand(rows, parts, entries, rounds, scale):
    """The codes, errors and codebooks with every part compared with every entry; rows: (vec_id, vector, label), all to be kept."""
    vectors = [[int(np.floor(np.float64(x) * scale)) for x in v] for _, v, _ in rows]
    size = len(vectors[0]) // parts
    cut = lambda v, p: v[p * size : (p + 1) * size]
    first = sorted(range(len(rows)), key=lambda n: (rows[n][0] is None, rows[n][0] or 0, vectors[n]))[:entries]
    books = [[cut(vectors[n], p) for n in first] for p in range(parts)]
    far = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    nearest = lambda v, p: min((far(cut(v, p), e), n) for n, e in enumerate(books[p]))
    for _ in range(rounds):
        given = [[nearest(v, p)[1] for p in range(parts)] for v in vectors]
        for p in range(parts):
            for e in range(len(books[p])):
                own = [cut(v, p) for v, g in zip(vectors, given) if g[p] == e]
                if own:
                    books[p][e] = [sum(c) // len(own) for c in zip(*own)]
    last = [[nearest(v, p) for p in range(parts)] for v in vectors]
    error = [sum(d for d, _ in x) for x in last]
    by_label = defaultdict(int)
    for (_, _, label), e in zip(rows, error):
        by_label[label] += e
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    return sorted(((r[0], "".join(f"{n:02x}" for _, n in x), e, by_label[r[2]], digest) for r, x, e in zip(rows, last, error)), key=str)


KIND = "vec_id long, embedding array<float>, label int, codes string, q int"


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, k, "x", 1) for i, v, k in rows], KIND)


@pytest.mark.parametrize("spread", [1.0, 0.001])  # so small a spread gives many ties
def test_vector_codes_against_brute_force(spark, spread, monkeypatch):
    monkeypatch.setattr(vector_codes, "BLOCK", 37)
    draw = random.Random(7)
    f = lambda x: struct.unpack("f", struct.pack("f", x))[0]
    rows = [(n * 13 % 150, [f(draw.gauss(draw.choice([-2, 0, 2]), 0.5) * spread) for _ in range(8)], draw.choice([None, 1, 2])) for n in range(150)]
    rows += [(3, rows[0][1], 1), (3, rows[0][1], 1), (None, rows[1][1], None)]
    bad = [(-1, None, 1), (-2, [], 1), (-3, [0.0] * 7 + [None], 1), (-4, [float("nan")] * 8, 1), (-5, [float("inf")] + [0.0] * 7, 1), (-6, [-3e38] * 8, 2), (900, [1.0] * 12, 2)]
    got = vector_codes.code_report(vectors(spark, rows + bad), parts=4, entries=5, rounds=4, scale=4096)
    assert sorted(map(tuple, got.collect()), key=str) == codes_by_hand(rows, 4, 5, 4, 4096)


def test_few_or_no_vectors(spark):
    rows = [(1, [0.5, -0.5], 1), (2, [0.25, 1.0], None)]
    got = vector_codes.code_report(vectors(spark, rows), parts=2, entries=16, rounds=2)
    assert sorted(map(tuple, got.collect()), key=str) == codes_by_hand(rows, 2, 16, 2, 4096)
    assert vector_codes.code_report(vectors(spark, [])).count() == 0
    assert vector_codes.code_report(vectors(spark, [(1, None, 1)])).columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]


def test_balls_give_the_nearest_entries_and_spare_comparisons():
    draw = np.random.default_rng(4)
    book = draw.integers(-1000, 1000, (16, 4))
    x = book[draw.integers(0, 16, 5000)] + draw.integers(-60, 60, (5000, 4))
    x[:64] = (book[:, None] + book[None, :4]).reshape(-1, 4) // 2  # half way between entries
    best, least = vector_codes.assign_by_balls(x, book, None)
    for start in (best, np.zeros(5000, "u1"), draw.integers(0, 16, 5000).astype("u1")):
        got, distance = vector_codes.assign_by_balls(x, book, start)
        assert (got == best).all() and (distance == least).all()


# ---- all


@pytest.mark.parametrize("name", ["op11_line_dedup", "op13_vector_codes"])
def test_twins(spark, data, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{data}/{t}.parquet'")
    got = queries.queries()[name](spark, data)
    twin = con.execute({"op11_line_dedup": line_dedup_sql.ORACLE, "op13_vector_codes": vector_codes_sql.ORACLE}[name])
    names = [c[0] for c in twin.description]
    assert sorted(names) == sorted(got.columns)
    assert sorted(tuple(r[n] for n in names) for r in got.collect()) == sorted(twin.fetchall())


def test_line_removal_uses_no_python_workers(spark, data):
    plan = queries.op11_line_dedup(spark, data)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


@pytest.mark.parametrize("ids", ["null", "one", "some", "own"])
def test_mixtures_keep_budgets_whatever_the_ids(spark, ids):
    """A small source of 100 documents beside a large one; the small one is read one and a half times."""
    name = lambda n: {"null": None, "one": 7, "some": n % 9, "own": n}[ids]
    rows = [(name(n), "w " * (n % 3 + 1), "small") for n in range(100)] + [(1000 + n, "w " * 10, "large") for n in range(400)] + [(None, "", None)] * 3
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    read = lambda df, key: sorted(((r[key[0]], r[key[1]]) for r in df.collect()), key=str)
    planned = mixing.schedule(docs, target_entropy=1.0, most_repeats=1.5)
    got = mixing.mixed(docs, target_entropy=1.0, most_repeats=1.5)
    size = F.size(F.array_remove(F.split("text", " "), "")).cast("long")
    assert read(got.select("source", size.alias("n")), ("source", "n")) == read(planned, ("source", "n_tokens"))
    words = {r.source: r.n for r in got.groupBy("source").agg(F.sum(size).alias("n")).collect()}
    total = sum(n % 3 + 1 for n in range(100))
    assert words["large"] == 4000 and abs(words["small"] - total * 1.5) <= 3 and got.where("source is null").count() == 3


def test_counts_of_texts_without_spaces():
    """Long words of any script, with special tokens among them: exact, and linear in their length."""
    draw = random.Random(8)
    library = Tokenizer.from_file(queries.BYTE_BPE)
    count = token_counts.PrefixCounter(queries.BYTE_BPE)
    scripts = ["".join(chr(draw.randrange(a, b)) for _ in range(6000)) for a, b in ((0x4E00, 0x9FA5), (0x0E01, 0x0E2F), (97, 123), (0x1F600, 0x1F640))] + ["the" * 2000, "a" * 3000]
    for text in [*scripts, "<|endoftext|>".join(s[:700] for s in scripts), "x  <|endoftext|> 's<|endoftext|>", "<|endoftext|>"]:
        counts = count.text_counts(text)
        assert len(counts) == len(text)
        for n in {*(draw.randrange(len(text)) for _ in range(25)), len(text) - 1, *(m.start() + k for m in re.finditer("<", text) for k in (0, 3, 11))} - {len(text)}:
            assert counts[n] == len(library.encode(text[: n + 1], add_special_tokens=False).ids), (text[:9], n)
    began = time.process_time()
    count.text_counts(scripts[0] * 5 + "<|endoftext|>")
    assert time.process_time() - began < 4  # 30,000 characters, 90,000 bytes; some 0.3 seconds


def test_occurrence_counts_bound_overlaps(monkeypatch):
    rng = np.random.default_rng(8)
    for most in (4096, 64):
        monkeypatch.setattr(jaccard_join, "MOST_WIDTH", most)
        sizes = [1, 3, 60, 500, 560, 900, 1000, 1100, 4000, 30_000, 33_000]
        pool = rng.integers(0, 1 << 63, 40_000).astype("u8")
        sets = [np.sort(rng.choice(pool[: 2 * n], n, replace=False)) for n in sizes]
        at = np.concatenate([[0], np.cumsum(sizes)])
        occurrences = jaccard_join.Occurrences(jaccard_join.occurrence_counts(at, np.concatenate(sets)).to_pylist())
        a, b = (x.ravel() for x in np.meshgrid(np.arange(len(sets)), np.arange(len(sets))))
        bound = occurrences.bound(a, b, np.array(sizes)[a], np.array(sizes)[b])
        both = np.array([len(np.intersect1d(sets[x], sets[y])) for x, y in zip(a, b, strict=True)])
        assert (bound >= both).all() and (bound[a == b] == np.array(sizes)[a[a == b]]).all()


def test_few_different_words_give_few_candidates(spark, monkeypatch):
    seen = []
    kept = jaccard_join.verified
    monkeypatch.setattr(jaccard_join, "verified", lambda pairs, *more: (seen.append(pairs.count()), kept(pairs, *more))[1])
    rng = np.random.default_rng(3)
    words = [f"w{n}" for n in range(7)]
    by_size = []
    for n in (300, 600, 1200):
        seen.clear()
        rows = [" ".join(rng.choice(words, int(rng.integers(300, 420)))) for _ in range(n)]
        rows[1] = rows[0] + " w1"
        df = spark.createDataFrame([(k, t) for k, t in enumerate(rows)], "doc_id long, text string").repartition(3)
        got = {r.doc_id: r.component_id for r in jaccard_join.similarity_components(df).collect()}
        assert got == {k: 0 if k == 1 else k for k in range(n)}
        by_size.append(tuple(seen))
    assert all(later <= 8 for _, later in by_size)  # sets in long lists only: their pairs don't grow with the table's square
    assert by_size[2][0] <= 5 * by_size[0][0]


@pytest.mark.parametrize("seed, sources, grain", [(1, 200, 1), (2, 150, 8), (3, 70, 1), (4, 33, 5)])
def test_sources_dealt_by_a_tree(seed, sources, grain):
    rng = np.random.default_rng(seed)
    lengths = np.maximum(rng.pareto(0.7, sources) * 50, 0).astype("i8") % 40_000
    shares = np.maximum(lengths.astype("f8") ** 0.5, 1e-6) if seed % 2 else rng.random(sources) + 1e-6
    rounds = packing.Rounds(lengths, shares, 256, grain)
    k = np.arange(rounds.last + 1)
    sent = rounds.counts(k)
    assert (np.diff(sent, axis=0) >= 0).all() and (sent[-1] == lengths).all()
    assert (sent.sum(axis=1) == np.minimum(k * 256, lengths.sum())).all()
    credit = np.interp(np.minimum(k * 256, lengths.sum()), rounds.credit, rounds.knots)[:, None] * rounds.shares
    off = np.abs(sent - np.minimum(credit, lengths))
    assert off.max() <= grain * (2 + packing.GROUP / 2) and off.mean() < grain  # in all, not by source
    taken = []
    for s, n in enumerate(lengths.tolist()):
        first = np.arange(0, n, 90)
        doc, start, size, place = rounds.pieces(first, np.minimum(90, n - first), s)
        assert (place // 256 == (place + size - 1) // 256).all() and size.sum() == n
        taken += [np.arange(p, p + z) for p, z in zip(place, size, strict=True)]
    assert (np.sort(np.concatenate(taken)) == np.arange(lengths.sum())).all()


def test_whole_products_are_exact():
    rng = np.random.default_rng(2)
    g = rng.integers(1, 1 << 49, 2000)
    d, a = (np.array([int(rng.integers(0, x + 1)) for x in g]) for _ in range(2))
    assert packing.scaled(d, a, g).tolist() == [(x * y + z // 2) // z for x, y, z in zip(d.tolist(), a.tolist(), g.tolist(), strict=True)]


def test_a_hundred_thousand_sources_cost_no_more_by_piece():
    took = {}
    for sources in (100, 100_000):
        rng = np.random.default_rng(7)
        lengths = rng.integers(1, 3000, sources)
        rounds = packing.Rounds(lengths, np.sqrt(lengths), 1024)
        rounds.pieces(np.array([0]), lengths[:1], 0)  # the tree's upper nodes are made
        some = rng.integers(0, sources, 100)
        began, pieces = time.perf_counter(), 0
        for s in some.tolist():
            _, _, size, _ = rounds.pieces(np.array([0]), lengths[s : s + 1], s)
            assert size.sum() == lengths[s]
            pieces += len(size)
        took[sources] = (time.perf_counter() - began) / pieces
    print(took)
    assert took[100_000] < 10 * took[100]
