"""The operators of the llm subpackage against brute force, round trips and planted cases; nulls, empty, tied and repeated rows."""

import hashlib
import re
import struct
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidemark.llm import chat, common, jaccard_join, licenses, media, mixing, packing, quality, token_counts, token_files, toxicity
from tidemark.llm.components import components

BYTE = public_tokenizers.path("byte_bpe_50k.json")
WORD = public_tokenizers.path("word_bpe_49k.json")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, n_tokens long, score double, source_2 string"
ODD = [
    "a  b", "a   b", "\n  b", "a\n \nb", " x", "  ", "", "foo ", "foo\n ", "a \nb", "x<|endoftext|> y <|endoftext|>z", "don't 're we'll  's it've", "é  ü  x　 y", "a\t b\r\n c",
    "日本語 テスト \U0001f600 x", " \n a", "'''re 'x'vé", "\n\n\n x", "x)., (y)...", "İs. x", "Ω. ΑΣ. ΣΑΣ ", "a\x1c b\x85 c\x85.d", "…\n“x”\n—y", "é. x\ń b", "×.a ÷,b",
]


@pytest.fixture(scope="module")
def documents(spark, data):
    """The documents with odd texts, a null text, a null source, a null id, repeated rows and clashing columns."""
    base = spark.read.parquet(f"{data}/documents.parquet").limit(60)
    more = [(10_000 + n, t, "en", "odd", len(t)) for n, t in enumerate(ODD)] + [(20_000, None, None, None, None), (20_001, "one", "en", None, 3), (20_002, "same text here now", "en", "odd", 1), (20_002, "same text here now", "en", "odd", 1), (20_003, "long " * 30_000, "en", "odd", 1)]
    both = base.unionByName(spark.createDataFrame(more, "doc_id long, text string, lang string, source string, n_chars long"))
    return both.withColumn("n_tokens", F.lit(1).cast("long")).withColumn("score", F.lit(0.5)).withColumn("ids", F.lit("x"))


@pytest.fixture(scope="module")
def texts(documents):
    return [(r.doc_id, r.text or "") for r in documents.select("doc_id", "text").collect()]


def empty(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")


def test_segments_give_the_librarys_ids():
    for path in (BYTE, WORD):
        library = Tokenizer.from_file(path)
        code = common.IdCoder(path)
        ids, at = code(pa.array(ODD))
        for n, text in enumerate(ODD):
            assert list(ids[at[n] : at[n + 1]]) == library.encode(text, add_special_tokens=False).ids, text


def test_long_texts_are_cut_where_segments_begin(monkeypatch):
    monkeypatch.setattr(common, "SLICE_BYTES", 500)
    text = "word, Word. é ünd\nso on " * 200
    ids, _ = common.IdCoder(BYTE)(pa.array([text, "x"]))
    library = Tokenizer.from_file(BYTE)
    assert list(ids) == library.encode(text, add_special_tokens=False).ids + library.encode("x", add_special_tokens=False).ids


def test_every_prefix_is_counted_exactly():
    library, counter = Tokenizer.from_file(BYTE), token_counts.PrefixCounter(BYTE)
    steps, at = counter(pa.array(ODD))
    for n, text in enumerate(ODD):
        own = steps[at[n] : at[n + 1]]
        assert len(own) == len(text)
        for k in range(1, len(text) + 1):
            assert token_counts.tokens_at(own.tobytes(), k) == len(library.encode(text[:k], add_special_tokens=False).ids), text[:k]


def test_token_counts(documents, texts):
    library = Tokenizer.from_file(BYTE)
    got = token_counts.token_counts(documents, BYTE, limit=100, keep_steps=True).collect()
    want = sorted((i, len(t.encode()), len(library.encode(t, add_special_tokens=False).ids)) for i, t in texts)
    assert sorted((r.doc_id, r.n_bytes, r.n_tokens) for r in got) == want
    by = dict(texts)
    for r in got:
        assert r.over_limit == (r.n_tokens > 100)
        if r.over_limit and r.doc_id < 20_000:
            assert len(library.encode(by[r.doc_id][: r.fits_chars], add_special_tokens=False).ids) <= 100
            assert all(token_counts.tokens_at(r.token_steps, k) > 100 for k in range(r.fits_chars + 1, len(by[r.doc_id]) + 1))


@pytest.mark.parametrize("shares", [None, {"src0": 0.5, "src1": 0.25, "odd": 0.25}])
def test_pieces_hold_every_id_once(documents, texts, shares):
    library = Tokenizer.from_file(BYTE)
    got = packing.pack(documents, BYTE, end_id=0, seq_len=256, grain=32, shares=shares).collect()
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in got:
        pieces[r.doc_id].append(r)
        sequences[r.sequence_id].append((r.offset, r.length))
    want = defaultdict(list)
    for i, t in texts:
        want[i].append(np.array([*library.encode(t, add_special_tokens=False).ids, 0], "<u4"))
    for i, copies in want.items():
        ids = copies[0]
        own = sorted(pieces[i], key=lambda r: r.start)
        assert sum(r.length for r in own) == len(ids) * len(copies)
        for r in own:
            assert r.doc_tokens == len(ids) and r.ids_crc32 == zlib.crc32(ids[r.start : r.start + r.length].tobytes())
    for n, spans in sequences.items():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at == 256 or n == max(sequences)


def test_windows_hold_the_target_shares():
    rounds = packing.Rounds(np.array([50_000, 20_000, 30_000]), np.array([0.2, 0.3, 0.5]), 1000, 50)
    k = np.arange(0, 50)
    for s, share in enumerate((0.2, 0.3, 0.5)):
        sent = rounds.sent(k, s)
        assert (np.abs(sent - share * 1000 * k) < 50).all()  # the deficit stays below a grain while all queues hold tokens
    assert sum(rounds.sent(np.array([rounds.last]), s)[0] for s in range(3)) == 100_000


@pytest.mark.parametrize("lengths", [[5_000 + 7 * n for n in range(20)], [5_000] * 20, [50_000] + [5_000] * 20, [300_000, 1, 0, 40, 9_000]])
def test_every_sequence_holds_the_target_shares(lengths):
    lengths = np.array(lengths)
    share = lengths / lengths.sum()
    rounds = packing.Rounds(lengths, share, 1024)
    held = np.zeros((rounds.last, len(lengths)), "i8")
    taken = []
    for s, n in enumerate(lengths):
        first = np.arange(0, n, 700)
        doc, start, size, place = rounds.pieces(first, np.minimum(700, n - first), s)
        assert (place // 1024 == (place + size - 1) // 1024).all()
        np.add.at(held, (place // 1024, s), size)
        taken += [np.arange(p, p + z) for p, z in zip(place, size, strict=True)]
        assert (np.diff(place[np.argsort(first[doc] + start)]) > 0).all()  # a queue keeps its order
    assert (np.sort(np.concatenate(taken)) == np.arange(lengths.sum())).all()  # every place is taken once
    whole = held[: lengths.sum() // 1024]
    off = 0.5 + share * len(lengths) / 2
    assert (np.abs(whole - 1024 * share) <= 2 * off).all()
    assert (np.abs(np.cumsum(whole, axis=0) - 1024 * share * np.arange(1, len(whole) + 1)[:, None]) <= off).all()
    assert np.abs(whole / 1024 - share).sum(axis=1).max() / 2 < 0.01


def test_rare_and_unwanted_sources_are_packed_too():
    lengths = np.array([200_000, 30, 5_000, 2_000])
    rounds = packing.Rounds(lengths, np.array([0.9, 0.00001, 0.09999, 1e-9]), 1000)
    sent = rounds.counts(np.arange(rounds.last + 1))
    assert (np.diff(sent, axis=0) >= 0).all() and (sent[-1] == lengths).all()
    assert (sent.sum(axis=1) == np.minimum(np.arange(rounds.last + 1) * 1000, lengths.sum())).all()
    places = [p + np.arange(z) for s, n in enumerate(lengths) for _, _, z, p in [rounds.pieces(np.array([0]), np.array([n]), s)] for p, z in zip(p, z, strict=True)]
    assert (np.sort(np.concatenate(places)) == np.arange(lengths.sum())).all()


def test_packing_nothing(spark):
    assert packing.pack(empty(spark), BYTE).count() == 0


@pytest.mark.parametrize("bits", [1, 3, 8, 13, 16, 17, 32])
def test_bits_round_trip(bits):
    ids = np.random.default_rng(bits).integers(0, 1 << bits, 5000).astype("<u4")
    assert (token_files.unpack_bits(token_files.pack_bits(ids, bits), bits, 5000) == ids).all()


def test_token_files_round_trip(spark, documents, texts, tmp_path):
    library = Tokenizer.from_file(WORD)
    token_files.write_token_files(documents, str(tmp_path / "tokens"), WORD, end_id=2)
    got = token_files.read_tokens(spark, str(tmp_path / "tokens")).collect()
    start, want = 0, []
    for i, t in sorted(texts, key=lambda x: x[0]):
        ids = np.array([*library.encode(t, add_special_tokens=False).ids, 2], "<u4")
        want.append((i, start, len(ids), ids.tobytes()))
        start += len(ids)
    assert [(r.doc_id, r.start, r.n_tokens, bytes(r.ids)) for r in sorted(got, key=lambda r: r.start)] == want
    file = next((tmp_path / "tokens").glob("*.tok"))
    with pa.OSFile(str(file)) as source:
        one = token_files.TokenFile(source)
        assert one.ids(3).tobytes() == want[[w[0] for w in want].index(int(one.doc_ids[3]))][3]


def test_empty_token_files(spark, tmp_path):
    token_files.write_token_files(empty(spark), str(tmp_path / "none"), WORD, end_id=2)
    assert token_files.read_tokens(spark, str(tmp_path / "none")).count() == 0


def test_chats_read_back(spark):
    turns = [(1, 0, "user", "a < b \\1 \\0 </turn>\n"), (1, 1, "assistant", "<turn:user>\nx\\"), (2, 0, "assistant", "first"), (3, 0, "system", None), (3, 1, "user", ""), (3, 2, "assistant", "é\U0001f600"), (4, 0, None, "x"), (5, 1, "user", "b"), (5, 1, "user", "a"), (None, 0, "user", "n"), (6, 0, "we>ird", "y")]
    df = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string").withColumn("formatted", F.lit(1)).withColumn("loss", F.lit(2))
    chats = chat.format_chats(df)
    got = {r.conv_id: r for r in chat.read_back(chats).collect()}
    by = defaultdict(list)
    for c, n, role, text in sorted(turns, key=lambda x: (x[0] is not None, x[0] or 0, x[1], x[2] or "", x[3] or "")):
        by[c].append((role or "", text or ""))
    for c, own in by.items():
        assert got[c].n_turns == len(own)
        assert got[c].turns_sha256 == hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in own).encode()).hexdigest()
        loss = "".join(t for r, t in own if r == "assistant")
        assert (got[c].loss_chars, got[c].loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
    assert got[1].valid and got[3].valid and not got[2].valid and got[2].refused_turn == 0 and got[5].refused_turn == 1
    for r in chats.collect():
        assert "".join(s.text for s in r.segments) == r.formatted


def test_license_base_phrases_match_brute_force(documents, texts, spark):
    more = [(1, "CC-BY cc by, CC.BY x cc by"), (2, "All  rights\nreserved. GNU General Public License"), (3, "cc by " * 500), (4, "éall rights reserved all rights reserved")]
    df = documents.select("doc_id", "text").where("doc_id > 100").unionByName(spark.createDataFrame(more, "doc_id long, text string"))
    words = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    by = dict(texts) | dict(more)
    for r in licenses.licenses(df).collect():
        own = words.findall(by[r.doc_id].translate(lower))
        starts, labels = [], set()
        for phrase, label in licenses.BASE.items():
            p = phrase.split()
            hits = [n for n in range(len(own)) if own[n : n + len(p)] == p]
            starts += hits
            labels |= {label} if hits else set()
        assert (r.n_words, r.n_base, r.first_word, r.last_word) == (len(own), len(starts), min(starts, default=None), max(starts, default=None))
        assert r.base_labels == ",".join(sorted(labels)) and labels <= set(r.labels.split(",")) | {""} and 0 <= r.score <= 1


def test_license_containment(spark):
    df = spark.createDataFrame([(1, "Licensed under the Apache License, Version 2.0 (the License)"), (2, "This is licensed under the MIT License and in the public domain"), (3, "nothing here")], "doc_id long, text string")
    got = {r.doc_id: r.labels for r in licenses.licenses(df).collect()}
    assert got == {1: "apache-2.0", 2: "mit,public-domain", 3: ""}


def examples(parsed, most):
    """Texts that match a parsed expression, each alternative in one of them at least; optional parts stand if ``most``."""
    found = [""]
    for op, value in parsed:
        name = str(op)
        if name == "LITERAL":
            tails = [chr(value)]
        elif name == "IN":
            tails = [chr(v) if str(o) == "LITERAL" else chr(v[0]) if str(o) == "RANGE" else "9" if str(v) == "CATEGORY_DIGIT" else "q" for o, v in value]
        elif name == "ANY":
            tails = ["e"]
        elif name == "SUBPATTERN":
            tails = examples(value[-1], most)
        elif name == "BRANCH":
            tails = [t for way in value[1] for t in examples(way, most)]
        else:
            assert name in ("MAX_REPEAT", "POSSESSIVE_REPEAT")
            tails = [t * max(value[0], int(most)) for t in examples(value[2], most)]
        n = max(len(found), len(tails))
        found = [found[k % len(found)] + tails[k % len(tails)] for k in range(n)]
    return found


def test_license_gates_lose_no_match(spark):
    rules = licenses.rules()
    texts = []
    for r in rules:
        whole, parsed = re.compile(r.pattern), licenses._parser.parse(r.pattern)
        for text in {t for most in (False, True) for t in examples(parsed, most)}:
            assert whole.fullmatch(text), (r.pattern, text)
            gate = licenses.gated(r)
            assert gate.keyword and gate.keyword in text.replace(" ", "\n") and gate.name in text, (r.pattern, text)
        texts += [text.replace(" ", end) for end in ("\n", "  ", "-")]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(8)
    gates, none = ({r.doc_id: r.asDict(True) for r in licenses.scan(df, gates=g).collect()} for g in (True, False))
    assert gates == none and all(r["kept"] for r in gates.values())
    wrapped = [(1, "Released\nunder the MIT license"), (2, "in the public\ndomain"), (3, "Without warranties"), (4, "May not be reproduced"), (5, "See the license for details"), (6, "unauthorised copying is strictly prohibited")]
    found = {r.doc_id: r.labels for r in licenses.licenses(spark.createDataFrame(wrapped, "doc_id long, text string")).collect()}
    assert found == {1: "mit", 2: "public-domain", 3: "warranty-disclaimer", 4: "proprietary", 5: "license-reference", 6: "proprietary"}
    spans = licenses.license_spans(df).collect()
    for a in spans:
        assert not any(a != b and a.doc_id == b.doc_id and b.start_word <= a.start_word and a.end_word <= b.end_word and b.priority >= a.priority for b in spans)
    assert len(licenses.rules()) > 300


def brute_components(rows, words, percent):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    sets = {}
    for i, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(lower))
        sets[i] = {tuple(w[k : k + words]) for k in range(len(w) - words + 1)} or ({tuple(w)} if w else set())
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = list(sets)
    for n, a in enumerate(ids):
        for b in ids[:n]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {i: (len(sets[i]), find(i)) for i in sets}


@pytest.mark.parametrize("words, percent, list_rows", [(4, 85, 50_000), (5, 80, 50_000), (4, 85, 3)])
def test_jaccard_components_match_brute_force(spark, monkeypatch, words, percent, list_rows):
    monkeypatch.setattr(jaccard_join, "LIST_ROWS", list_rows)  # few rows: lists are split
    rng = np.random.default_rng(5)
    vocabulary = [f"w{n}" for n in range(400)]
    passage = [f"p{n}" for n in range(50)]
    rows = []
    for group in range(12):
        base = list(rng.choice(vocabulary, 120))
        for _ in range(int(rng.integers(1, 40))):
            own = list(base)
            for _ in range(int(rng.integers(0, 9))):
                own[int(rng.integers(0, len(own)))] = f"x{rng.integers(0, 10_000)}"
            rows.append(own + passage if group % 3 == 0 else own)
    rows += [list(rng.choice(vocabulary, n)) for n in rng.integers(1, 60, 60)] + [["a"], ["a"], ["A"], ["a", "b"], ["a", "b", "c", "d"], []]
    rows = [(n * 3, " ".join(r)) for n, r in enumerate(rows)] + [(100_001, None), (100_002, " \n ")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5).withColumn("node", F.lit(1)).withColumn("n", F.lit("x"))
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.similarity_components(df, words, percent).collect()}
    assert got == brute_components(rows, words, percent)
    left = {r.doc_id for r in jaccard_join.one_of_each(df, words, percent).collect()}
    assert left == {i for i, (_, c) in got.items() if i == c}


def test_jaccard_of_nothing_and_of_repeats(spark):
    assert jaccard_join.similarity_components(empty(spark)).count() == 0
    df = spark.createDataFrame([(7, "a b c d e"), (7, "a b c d e"), (3, "A b  c d e"), (None, "a b c d e")], "doc_id long, text string")
    assert {(r.doc_id, r.component_id) for r in jaccard_join.similarity_components(df).collect()} == {(7, 3), (3, 3), (None, 3)}
    assert [r.doc_id for r in jaccard_join.one_of_each(df).collect()] == [3]


def test_rows_with_null_or_repeated_ids_are_documents_of_their_own(spark):
    a, b, c, d = (" ".join(f"{x}{n}" for n in range(40)) for x in "abcd")
    rows = [(None, a), (None, b), (7, a + " more"), (8, c), (8, d), (8, d), (9, d), (3, "short"), (3, "brief"), (None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("_row", F.lit("x"))
    left = jaccard_join.one_of_each(df)
    assert left.columns == df.columns
    got = sorted(((r.doc_id or 0, r.text or "") for r in left.collect()))
    assert got == sorted([(0, b), (7, a + " more"), (8, c), (8, d), (3, "short"), (3, "brief"), (0, "")])


def test_components_of_a_path_a_star_and_a_loop(spark):
    links = [(n, n + 1) for n in range(1, 40)] + [(100, 100 + n) for n in range(1, 30)] + [(500, 501), (501, 502), (502, 500), (600, 600)]
    got = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert len({got[n] for n in range(1, 41)}) == 1 and len({got[n] for n in range(100, 130)}) == 1 and len({got[n] for n in (500, 501, 502)}) == 1
    assert len(set(got.values())) == 3


def test_toxicity_learns_and_holds_out(spark, data):
    docs, labels = spark.read.parquet(f"{data}/documents.parquet"), spark.read.parquet(f"{data}/labels.parquet")
    more = spark.createDataFrame([(-1, None), (-2, ""), (-3, "the " * 5000)], "doc_id long, text string")
    got = {r.doc_id: r for r in toxicity.toxicity(docs.select("doc_id", "text").unionByName(more).withColumn("score", F.lit(9)), labels).collect()}
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got.values())
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) for i, r in got.items())
    known = {r.doc_id: r.toxic for r in labels.collect()}
    clean = [got[i].predicted for i, t in known.items() if not t]
    assert sum(clean) <= 0.05 * len(clean)
    seen = [got[i].predicted for i, t in known.items() if t and not got[i].held_out]
    assert sum(seen) >= 0.8 * len(seen)
    assert got[-1].score == got[-2].score < 0.5


def test_toxicity_without_labels(spark):
    docs = spark.createDataFrame([(1, "x y"), (2, None)], "doc_id long, text string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert {r.predicted for r in toxicity.toxicity(docs, labels).collect()} == {0}
    assert toxicity.without_toxic(docs, labels).count() == 2
    assert {r.kept for r in quality.quality(docs, labels).collect()} == {False}


def brute_stats(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = defaultdict(list)
    for n in range(len(words) - 2):
        windows[tuple(words[n : n + 3])].append(n)
    twice = {n + k for places in windows.values() if len(places) > 1 for n in places for k in range(3)}
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(twice)


def test_quality_counts_match_brute_force(spark, documents, texts):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    more = [(1, "a b c a b c"), (2, "x x x x"), (3, "l1 q\nl1 q\n \n\n"), (4, "a\x1cb c d")]
    df = documents.select("doc_id", "text").where("doc_id > 100").unionByName(spark.createDataFrame(more, "doc_id long, text string"))
    by = dict(texts) | dict(more)
    for r in quality.quality(df, labels).collect():
        want = brute_stats(by[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        assert r.base_failed == (want[0] < 50 or 100 * want[4] > 50 * want[0]) and (not r.kept or not r.base_failed)


def test_decision_list_finds_planted_rules():
    rng = np.random.default_rng(2)
    x = rng.random((3000, 3))
    bad = (x[:, 0] > 0.8) & (x[:, 1] < 0.5) | (x[:, 2] > 0.95)
    rules = quality.learn(x, bad, ["a", "b", "c"])
    held = np.zeros(3000, bool)
    for rule in rules:
        held |= quality.covers(rule, x, ["a", "b", "c"])
    assert (held == bad).mean() > 0.98
    assert quality.learn(x, np.zeros(3000, bool), ["a", "b", "c"]) == []


def test_mixture_reaches_its_target(spark):
    rows = [(n, "w " * 50, "big" if n < 700 else f"s{n % 6}", 0) for n in range(1000)] + [(5000, None, None, 0), (5001, "", "none", 0), (5000, None, None, 0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, pass int")
    planned = mixing.plan(mixing.sized(df, "doc_id", "text", "source"), 0.9, 2.0, 5000).collect()
    weights = [r.weight for r in planned if r.tokens]
    shares = np.array([r.tokens for r in planned if r.tokens]) / 50_000
    a = planned[0].exponent
    want = shares**a / (shares**a).sum()
    assert np.allclose(sorted(weights), sorted(want), atol=1e-6)
    entropy = -(want * np.log(want)).sum() / np.log(len(want))
    assert max(r.passes for r in planned) <= 2.0 + 1e-6 and (entropy >= 0.9 - 1e-6 or abs(max(r.passes for r in planned) - 2.0) < 1e-6)
    got = mixing.schedule(df, 0.9, 2.0, 5000).collect()
    read = defaultdict(int)
    for r in got:
        read[r.source] += r.n_tokens
    for r in planned:
        assert abs(read[r.source] - r.tokens * r.passes) <= 51
    assert {r.doc_id for r in got} == {r[0] for r in rows} and sum(r.doc_id == 5000 for r in got) == 2
    blocks = defaultdict(lambda: defaultdict(int))
    places = defaultdict(list)
    for r in got:
        blocks[r.block][r.source] += r.n_tokens
        places[r.block].append(r.place)
    assert all(sorted(p) == list(range(len(p))) for p in places.values())
    quota = {r.source: r.quota for r in planned}
    assert all(abs(n - quota[s]) <= 100 for b, own in blocks.items() if b < max(blocks) for s, n in own.items())
    copies = defaultdict(int)
    for r in mixing.mixed(df, 0.9, 2.0).collect():
        copies[r.doc_id] += 1
    want_copies = defaultdict(int)
    for r in got:
        want_copies[r.doc_id] += 1
    assert copies == want_copies and mixing.mixed(df).columns == df.columns


def test_mixing_nothing(spark):
    assert mixing.schedule(empty(spark)).count() == 0 and mixing.mixed(empty(spark)).count() == 0


@pytest.mark.parametrize("kind", [media.NONE, media.LZW, media.DEFLATE, media.PACKBITS])
@pytest.mark.parametrize("predictor", [1, 2])
@pytest.mark.parametrize("tile", [None, 16])
def test_tiff_round_trip(kind, predictor, tile):
    rng = np.random.default_rng(kind)
    for shape in ((1, 64), (700, 64), (17, 33)):
        image = (rng.integers(0, 6, shape) ** 2).astype("u1")
        noise = rng.integers(0, 256, shape).astype("u1")
        pages = list(media.read_tiff(media.write_tiff([image, noise], kind, predictor, 50, tile)))
        assert [p.error for p in pages] == [None, None]
        assert (pages[0].pixels[:, :, 0] == image).all() and (pages[1].pixels[:, :, 0] == noise).all()


def test_lzw_of_the_specification():
    codes, bits = [256, 7, 258, 8, 8, 258, 6, 6, 257], 0
    for c in codes:
        bits = bits << 9 | c
    n = 9 * len(codes)
    raw = (bits << (-n % 8)).to_bytes(-(-n // 8), "big")
    assert media.unpack_lzw(raw) == bytes([7, 7, 7, 8, 8, 7, 7, 6, 6])
    assert media.unpack_packbits(bytes([0xFE, 0xAA, 0x02, 0x80, 0x00, 0x2A, 0xFD, 0xAA, 0x03, 0x80, 0x00, 0x2A, 0x22, 0xF7, 0xAA])) == bytes.fromhex("aaaaaa80002aaaaaaaaa80002a22aaaaaaaaaaaaaaaaaaaa")


def test_big_endian_sixteen_bit_and_float_pages():
    def tiff(bits, form, predictor, raw, width, height):
        tags = [(256, 4, width), (257, 4, height), (258, 3, bits), (259, 3, 1), (273, 4, 8), (277, 3, 1), (278, 4, height), (279, 4, len(raw)), (317, 3, predictor), (339, 3, form)]
        entries = b"".join(struct.pack(">HHI", t, k, 1) + (struct.pack(">HH", v, 0) if k == 3 else struct.pack(">I", v)) for t, k, v in tags)
        return b"MM\0*" + struct.pack(">I", 8 + len(raw)) + raw + struct.pack(">H", len(tags)) + entries + b"\0\0\0\0"

    values = np.array([[5, 6, 300, 2], [1, 1, 1, 60000]], ">u2")
    stored = np.diff(values.astype("i8"), axis=1, prepend=0).astype(">u2")
    page = next(media.read_tiff(tiff(16, 1, 2, stored.tobytes(), 4, 2)))
    assert page.error is None and (page.pixels[:, :, 0] == values).all()
    floats = np.array([[1.5, -2.25, 1e9]], ">f4")
    planes = floats.view("u1").reshape(3, 4).T.reshape(-1)
    stored = np.diff(planes.astype("i4"), prepend=0).astype("u1")
    page = next(media.read_tiff(tiff(32, 3, 3, stored.tobytes(), 3, 1)))
    assert page.error is None and (page.pixels[:, :, 0] == floats).all()


def test_stored_texts_and_pages(spark, documents, texts, monkeypatch):
    by = dict(texts)
    got = media.stored_digests(media.store_bytes(documents)).collect()
    assert len(got) == len(texts)
    for r in got:
        raw = by[r.doc_id].encode()
        payload = raw + b"\0" * (-len(raw) % 64 or (0 if raw else 64))
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) == (len(raw), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-64:]))
    pages = media.tiff_pages(spark.createDataFrame([(1, media.write_tiff([np.zeros((2, 64), "u1")] * 3)), (2, b"nothing"), (3, None)], "doc_id long, media binary")).collect()
    assert sorted((r.doc_id, r.page if r.page is not None else -1, r.error is None) for r in pages) == [(1, 0, True), (1, 1, True), (1, 2, True), (2, -1, False), (3, -1, False)]


def test_pipeline(spark, data):
    import corpus_pipeline

    labels = {r.doc_id: r for r in spark.read.parquet(f"{data}/labels.parquet").collect()}
    docs = spark.read.parquet(f"{data}/documents.parquet")
    columns, sizes = docs.columns, [docs.count()]
    for n, (_, stage) in enumerate(corpus_pipeline.STAGES):
        docs = common.materialise(stage(spark, docs, data), "test")
        if n < 4:
            assert docs.columns == columns
            sizes.append(docs.count())
        if n == 0:
            toxic = [r.doc_id for r in docs.collect() if r.doc_id in labels and labels[r.doc_id].toxic]
            assert len(toxic) <= 3
        if n == 2:
            texts = [r.text for r in docs.collect()]
            assert len(texts) == len(set(texts))
    assert sizes[0] > sizes[1] > sizes[2] >= sizes[3] <= sizes[4]
    assert docs.count() > 0


def test_native_plans_hold_no_python(spark, data):
    from tidemark.llm import queries

    for name in ("op3_chat_format", "op4_license_scan", "op8_temperature_mixing"):
        plan = queries.queries()[name](spark, data)._jdf.queryExecution().executedPlan().toString()
        assert not re.search("Python|Pandas|Arrow", plan), name


LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute_licenses(text):
    """Every rule on every text in plain Python: n_words, base starts, labels, score."""
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))
    line = " " + " ".join(words) + " "
    found = []
    for r in licenses.rules():
        for m in re.finditer(f"(?<= )(?:{r.pattern})(?= )", line, re.ASCII):
            start = line.count(" ", 0, m.start()) - 1
            found.append((start, start + m[0].count(" "), r.priority, r.label, r.base))
    order = sorted(found, key=lambda d: (d[0], -d[1], -d[2], d[3], d[4]))
    kept = [d for n, d in enumerate(order) if not any(e[1] >= d[1] and e[2] >= d[2] for e in order[:n])]
    base = [d for d in order if d[4]]
    labels = sorted({d[3] for d in kept + base})
    return len(words), [d[0] for d in base], ",".join(labels), max([licenses.WEIGHT[d[2]] for d in kept + base], default=0.0)


def test_licenses_match_brute_force(spark, documents, texts):
    parts = ["Copyright 2001 2004 2009", "licensed under the MIT License", "All rights reserved", "this is in the public domain", "cc-by", "CC BY SA 4.0", "no warranty", "Kopyright 2001", "GNU General Public License version 2", "see the license file", "İSC license", "do", "not", "without any warranty of any kind", "© 2020 2021 Some Body all rights reserved", "unauthorized copying or copying is strictly prohibited"]
    rng = np.random.default_rng(3)
    more = [(n, " ".join(rng.choice(parts, int(rng.integers(1, 30))))) for n in range(100)]
    more += [(100, "cc by " * 700), (101, "copyright 2001 " * 300 + "all rights reserved"), (102, None), (103, "")]
    df = documents.select("doc_id", "text").where("doc_id > 200").unionByName(spark.createDataFrame(more, "doc_id long, text string")).withColumn("words", F.lit(1)).withColumn("a.b", F.lit(2))
    by = dict(texts) | dict(more)
    for r in licenses.licenses(df).collect():
        n, starts, labels, score = brute_licenses(by[r.doc_id])
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.labels, r.score) == (n, len(starts), min(starts, default=None), max(starts, default=None), labels, score), by[r.doc_id][:200]


def test_long_repeats_are_scanned(spark):
    rows = [(1, "copyright" + " 2001" * 1_000_000, "copyright"), (2, "unauthorized copying" + " copying" * 1_000_000 + " is strictly prohibited", "proprietary"), (3, "in no event shall the " + "authors or copyright holders " * 100_000 + "be liable", "warranty-disclaimer"), (4, "neither the name of " * 100_000, ""), (5, "cc by " * 100_000, "cc-by"), (6, "x" * 5_000_000, "")]
    got = {r.doc_id: r for r in licenses.licenses(spark.createDataFrame(rows, "doc_id long, text string, label string").repartition(4)).collect()}
    assert {i: got[i].labels for i, _, _ in rows} == {i: label for i, _, label in rows}
    assert got[5].n_base == 100_000 and got[5].last_word == 199_998


def test_many_special_tokens_are_counted():
    library, counter = Tokenizer.from_file(BYTE), token_counts.PrefixCounter(BYTE)
    for text in ("<|endoftext|>" * 100_000, "x y" + "<|endoftext|>a' b" * 2000, "<|endoftext" * 500):
        steps, at = counter(pa.array([text]))
        assert int(steps.sum(dtype="i8")) == len(library.encode(text, add_special_tokens=False).ids)
    text = "a'<|endoftext|> 's<|endoftext|><|end  <|endoftext|>"
    for k in range(1, len(text) + 1):
        assert counter.text_counts(text)[k - 1] == len(library.encode(text[:k], add_special_tokens=False).ids), text[:k]


CLASHES = ["scratch", "tile", "list", "queue", "c0", "c1", "id", "text_2", "_wanted", "_gone", "_s_n_words", "_source", "_full", "_cut", "_copy", "_id", "_label", "a.b", "score", "label", "words", "root", "node", "kept", "base", "key", "count"]


def clashing(docs):
    return docs.select("*", *(F.lit(n).alias(c) for n, c in enumerate(CLASHES)))


def test_columns_with_clashing_names(spark, data):
    docs, labels = spark.read.parquet(f"{data}/documents.parquet").limit(80), spark.read.parquet(f"{data}/labels.parquet")
    both, labels = clashing(docs), clashing(labels)
    for f in (lambda d: licenses.licenses(d), lambda d: token_counts.token_counts(d, BYTE), lambda d: toxicity.toxicity(d, labels), lambda d: quality.quality(d, labels), lambda d: mixing.schedule(d), lambda d: jaccard_join.similarity_components(d), lambda d: packing.pack(d, BYTE), lambda d: media.stored_digests(media.store_bytes(d))):
        one, two = (sorted(map(str, f(d).collect())) for d in (docs, both))
        assert one == two
    for f in (lambda d: toxicity.without_toxic(d, labels), lambda d: quality.passing(d, labels), jaccard_join.one_of_each, mixing.mixed):
        assert f(both).columns == both.columns
        assert sorted(map(str, f(both).select(*docs.columns).collect())) == sorted(map(str, f(docs).collect()))


def test_empty_tables(spark, data):
    none, labels = empty(spark), spark.read.parquet(f"{data}/labels.parquet")
    for got in (licenses.licenses(none), token_counts.token_counts(none, BYTE), toxicity.toxicity(none, labels), quality.quality(none, labels), media.tiff_pages(media.store_bytes(none)), media.stored_digests(media.store_bytes(none)), toxicity.without_toxic(none, labels), quality.passing(none, labels), jaccard_join.one_of_each(none)):
        assert got.count() == 0
    turns = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat.read_back(chat.format_chats(turns)).count() == 0


def test_a_labelled_id_with_several_texts_is_learned_from_alike(spark):
    rows = [(n % 50, f"{'bad wicked' if n % 50 < 20 else 'kind gentle'} word{n} here") for n in range(400)]
    labels = spark.createDataFrame([(n, int(n < 20), int(n < 20)) for n in range(50)], "doc_id long, quality int, toxic int")
    df = spark.createDataFrame(rows, "doc_id long, text string")
    one, two = (sorted(map(str, toxicity.sample_of(df.repartition(k), labels, F.col("toxic"), 100, "doc_id", "text", F.lit(True)).collect())) for k in (1, 7))
    assert one == two and len(one) == 50


def test_toxicity_scores_match_plain_python(spark):
    rng = np.random.default_rng(8)
    texts = [" ".join(rng.choice(["vile", "Rotten", "kind", "day", "Ärger", "tree\n"], 12)) for _ in range(300)] + ["", "a", "vile " * 100_000]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    labels = spark.createDataFrame([(n, int("vile" in t)) for n, t in enumerate(texts[:250])], "doc_id long, toxic int")
    model = toxicity.train(docs, labels)
    weights = dict(zip(model.hashes.tolist(), model.weights.tolist(), strict=True))

    def plain(text):
        points = [32, *map(ord, text.lower()), 32]
        points = [32 if 9 <= p <= 13 else p for p in points]
        grams = set()
        for n in range(len(points)):
            h = 0
            for k, p in enumerate(points[n : n + max(toxicity.ORDERS)], 1):
                h = (h + p) * 0x9E3779B97F4A7C15 % (1 << 64)
                h ^= h >> 29
                if k in toxicity.ORDERS:
                    grams.add(h)
        z = model.intercept + sum(weights.get(g, 0.0) for g in grams)
        return 1 / (1 + np.exp(-min(max(z, -40), 40)))

    got = {r.doc_id: r.score for r in toxicity.score(docs, model).collect()}
    assert all(abs(got[n] - plain(t)) < 1e-9 for n, t in enumerate(texts))


def test_quality_verdict_is_the_rules(spark, data):
    docs, labels = spark.read.parquet(f"{data}/documents.parquet"), spark.read.parquet(f"{data}/labels.parquet")
    rules = quality.train(docs, labels)
    names = list(quality.measures())
    rows = quality.with_stats(docs, ["doc_id"]).select("c0", *(m.alias(n) for n, m in quality.measures().items())).collect()
    x = np.array([[r[n] for n in names] for r in rows], "f8")
    want = np.zeros(len(rows), "i8")
    for n, rule in reversed([*enumerate(rules, 1)]):
        want[quality.covers(rule, x, names)] = n
    got = {r.doc_id: r.rule for r in quality.quality(docs, labels).collect()}
    assert [got[r.c0] for r in rows] == want.tolist()


def test_heap_merge_counts_lists():
    rng = np.random.default_rng(4)
    for _ in range(200):
        lists = [sorted(rng.choice(40, int(rng.integers(1, 20)), replace=False).tolist()) for _ in range(int(rng.integers(1, 9)))]
        for least in (1, 2, 3, 5):
            held = defaultdict(int)
            for values in lists:
                for v in values:
                    held[v] += 1
            assert jaccard_join.merge_skip(lists, least) == sorted((v, n) for v, n in held.items() if n >= least)


@pytest.mark.parametrize("list_rows, short", [(200, 12), (2, 2), (5, 1)])
def test_links_through_short_and_long_lists(spark, monkeypatch, list_rows, short):
    monkeypatch.setattr(jaccard_join, "LIST_ROWS", list_rows)
    monkeypatch.setattr(jaccard_join, "SHORT", short)  # few sets: lists are long, and candidates are probed for
    rng = np.random.default_rng(list_rows)
    rows = []
    for group in range(25):
        base = [f"g{group % 7}w{n}" for n in range(30)] + [f"h{group}w{n}" for n in range(int(rng.integers(5, 60)))]
        for _ in range(int(rng.integers(2, 9))):
            own = list(base)
            for _ in range(int(rng.integers(0, 4))):
                own[int(rng.integers(0, len(own)))] = f"x{rng.integers(0, 30)}"
            rows.append(" ".join(own))
    df = spark.createDataFrame([(n, t) for n, t in enumerate(rows)], "doc_id long, text string").repartition(3)
    for words, percent in ((4, 85), (1, 70)):
        got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.similarity_components(df, words, percent).collect()}
        assert got == brute_components(list(enumerate(rows)), words, percent)


def test_words_are_hashed_in_pieces(monkeypatch):
    texts = pa.array(["A b  c\td\ne f g " * 50, "", "x" * 300 + " y", "one two three four five"])
    whole = jaccard_join.shingle_sets(texts, 4)
    monkeypatch.setattr(jaccard_join, "PIECE", 16)
    parts = jaccard_join.shingle_sets(texts, 4)
    assert all((a == b).all() for a, b in zip(whole, parts, strict=True))


def test_a_long_path_is_one_component(spark):
    links = [(n, n + 1) for n in range(400)] + [(1000 + n, 999 + n) for n in range(1, 200)]
    got = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert len({got[n] for n in range(401)}) == 1 and len(set(got.values())) == 2


def simulated_round_robin(lengths, shares, seq_len):
    """Deficit round-robin by hand: each round credits every open queue its share of the window and sends whole tokens, the largest
    deficits first; what an empty queue can't use goes to the others."""
    lengths, shares = np.array(lengths), np.array(shares, "f8") / sum(shares)
    sent, credit = np.zeros(len(lengths), "i8"), np.zeros(len(lengths))
    rounds = []
    while sent.sum() < lengths.sum():
        window = min(seq_len, int((lengths - sent).sum()))
        left = float(window)
        while left > 1e-9:
            open_ = credit < lengths - 1e-9
            weight = np.where(open_, shares, 0.0)
            step = np.minimum(left * weight / weight.sum(), lengths - credit)
            credit += step
            left -= step.sum()
        due = np.minimum(np.floor(credit + 1e-9), lengths).astype("i8")
        due = np.maximum(due, sent)
        rest = np.where(due < lengths, credit - due, -1)
        short = window - int((due - sent).sum())
        for k in np.argsort(-rest, kind="stable")[: max(short, 0)]:
            due[k] += 1
        rounds.append(due - sent)
        sent = due
    return np.array(rounds)


@pytest.mark.parametrize("lengths, shares", [([30_000, 2_000, 9_000], [0.2, 0.3, 0.5]), ([5_000] * 12, [1.0] * 12), ([40_000, 300, 10, 7_000], [200, 17.3, 3.1, 83.7])])
def test_rounds_follow_a_simulated_round_robin(lengths, shares):
    want = np.cumsum(simulated_round_robin(lengths, shares, 1024), axis=0)
    rounds = packing.Rounds(np.array(lengths), np.array(shares), 1024)
    got = rounds.counts(np.arange(1, rounds.last + 1))
    assert got.shape == want.shape and (got[-1] == want[-1]).all()
    assert (np.abs(got - want) <= 1).all()  # whole tokens are dealt within one of the simulation's


def test_tempered_shares_fill_the_windows(spark):
    rows = [(n, "one two three four five " * 40, "big" if n < 160 else f"s{n % 4}") for n in range(200)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(3)
    held = defaultdict(lambda: defaultdict(int))
    for r in packing.pack(df, BYTE, seq_len=512, temper=0.5).collect():
        held[r.sequence_id][r.source] += r.length
    weight = {"big": 4.0} | {f"s{k}": 1.0 for k in range(4)}  # 16 times the tokens, 4 times the share
    for n in range(10):
        assert all(abs(held[n][s] - 512 * w / 8) <= 4 for s, w in weight.items())


def test_many_small_sources(spark):
    rows = [(n, f"text number {n}", f"s{n}" if n % 7 else None) for n in range(200)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(3)
    got = packing.pack(df, BYTE, seq_len=64, shares={"s1": 2.0, None: 1.0}).collect()
    library = Tokenizer.from_file(BYTE)
    assert {r.doc_id for r in got} == set(range(200)) and {(r.doc_id, r.source) for r in got} == {(n, s) for n, _, s in rows}
    assert sum(r.length for r in got) == sum(len(library.encode(t, add_special_tokens=False).ids) + 1 for _, t, _ in rows)


def test_token_files_with_null_ids_and_few_bits(spark, tmp_path):
    rows = [(None, "a"), (-(1 << 63), "b"), (None, "c d"), (5, None), (5, "e " * 9000)]
    token_files.write_token_files(spark.createDataFrame(rows, "doc_id long, text string"), str(tmp_path / "t"), WORD, end_id=2)
    got = sorted(token_files.read_tokens(spark, str(tmp_path / "t")).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in got] == [None, None, -(1 << 63), 5, 5] and [r.n_tokens for r in got][:4] == [2, 3, 2, 1]
    assert token_files.files_of(100 * 10**12, 8000) == token_files.MOST_FILES and token_files.files_of(25_000_000, 8) == 8 and token_files.files_of(0, 8) == 1
    file = next((tmp_path / "t").glob("*.tok"))
    with pa.OSFile(str(file)) as source:
        one = token_files.TokenFile(source)
        assert len(one.block_at) == one.footer["blocks"] + 1 and (np.diff(one.block_at)[:-1] == token_files.BLOCK * one.bits // 8).all()


def test_pages_of_few_bits():
    rng = np.random.default_rng(1)
    for bits in (1, 2, 4):
        samples = rng.integers(0, 1 << bits, (5, 13)).astype("u1")
        flags = np.unpackbits(samples[:, :, None], axis=2)[:, :, 8 - bits :].reshape(5, -1)
        raw = media.pack_packbits(np.packbits(flags, axis=1).tobytes())
        tags = [(256, 4, 13), (257, 4, 5), (258, 3, bits), (259, 3, media.PACKBITS), (273, 4, 8), (277, 3, 1), (278, 4, 5), (279, 4, len(raw))]
        entries = b"".join(struct.pack("<HHI", t, k, 1) + (struct.pack("<HH", v, 0) if k == 3 else struct.pack("<I", v)) for t, k, v in tags)
        page = next(media.read_tiff(b"II*\0" + struct.pack("<I", 8 + len(raw)) + raw + struct.pack("<H", len(tags)) + entries + b"\0\0\0\0"))
        assert page.error is None and (page.pixels[:, :, 0] == samples).all()


def test_long_texts_are_stored_as_pages(spark, monkeypatch):
    monkeypatch.setattr(media, "PAGE_ROWS", 10)
    text = "abc \u00e9" * 3000
    got = media.stored_digests(media.store_bytes(spark.createDataFrame([(1, text), (1, text), (2, "x")], "doc_id long, text string").coalesce(1))).collect()
    payload = media.payload_of(text)
    assert [r.payload_sha256 for r in got if r.doc_id == 1] == [hashlib.sha256(payload).hexdigest()] * 2
    assert len({(r.feature, r.media_sha256, r.n_bytes) for r in got if r.doc_id == 1}) == 1 and len(got) == 3


def test_scratch_tables_are_removed(spark, tmp_path):
    df = spark.createDataFrame([(1, "x")], "a int, scratch string")
    stored = common.materialise(df, "test")
    path = stored.__dict__[common.SCRATCH].removeprefix("file:").replace("//", "/")
    import os

    assert os.path.isdir(path)
    common.discard(df, stored)
    assert not os.path.exists(path)


def test_turns_without_a_conversation_stand_alone(spark):
    df = spark.createDataFrame([(None, 0, "user", "a"), (None, 0, "user", "a"), (None, 1, "assistant", "b"), (1, 0, "user", "x" * 3_000_000)], "conv_id long, turn long, role string, text string")
    got = chat.read_back(chat.format_chats(df)).collect()
    assert sorted((r.conv_id or 0, r.n_turns, r.loss_chars) for r in got) == [(0, 1, 0), (0, 1, 0), (0, 1, 1), (1, 1, 0)]
