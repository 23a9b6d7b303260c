"""Operators 11 to 13 against brute force, with nulls, ties, repeated rows, long texts and hot groups."""
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from strata.llm import collocations, packing, queries, spelling
from strata.llm.common import cut


def odd_columns(df):
    """Columns that clash with the operators' own names."""
    return df.selectExpr("*", "1 AS word", "2 AS n", "'x' AS `a b`", "3 AS __text", "4 AS piece", "5 AS size", "6 AS __lane", "'y' AS key")


# --- 11 spelling ----------------------------------------------------------------

def variants_by_hand(rows):
    """The contract, word by word and pair by pair."""
    n = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % 199 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            n[run] += 1
    n = {w: k for w, k in n.items() if len(w) >= 6 and k >= 5}

    def near(a, b):
        if a == b or abs(len(a) - len(b)) > 1:
            return False
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b)) == 1
        short, long = sorted((a, b), key=len)
        return any(long[:i] + long[i + 1:] == short for i in range(len(long)))

    close = {w: [v for v in n if near(w, v)] for w in n}
    best = {w: min(close[w], key=lambda v: (-n[v], v), default=None) for w in n}
    form = {w: best[w] if best[w] and n[best[w]] >= 5 * n[w] else None for w in n}

    def root(w):
        while form[w]:
            w = form[w]
        return w

    return {w: (form[w], root(w), n[w], len(close[w]), n[form[w]] if form[w] else None) for w in n}


def found_variants(spark, df):
    got = spelling.variants(spark, spelling.corpus_words(df)).collect()
    assert len({r.word for r in got}) == len(got)
    return {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in got}


def test_variants_equal_brute_force(spark):
    rng = np.random.default_rng(11)
    letters, words = list("abcde") + ["é", "ß"], []
    for _ in range(60):
        word = "".join(rng.choice(letters, rng.integers(6, 10)))
        words += [word] * int(rng.integers(1, 200))
        for _ in range(6):
            at, kind = int(rng.integers(0, len(word))), int(rng.integers(0, 3))
            edited = word[:at] + ("", str(rng.choice(letters)), str(rng.choice(letters)) + word[at])[kind] + word[at + 1:]
            words += [edited.capitalize()] * int(rng.integers(1, 30))
    rng.shuffle(words)
    rows = [(i, " ".join(words[i::40]) + "; ABC 123x") for i in range(40)]
    rows += [(None, None), (None, ""), (None, "abcdea " * 7), (3, rows[3][1]), (99, "Abcdéf" * 4000 + " - " + "xyzxyz×÷ " * 30)]
    expected = variants_by_hand(rows)
    assert sum(v[3] for v in expected.values()) > 300 and sum(v[0] is not None for v in expected.values()) > 40
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    assert found_variants(spark, frame) == expected
    assert found_variants(spark, odd_columns(frame).repartition(13)) == expected


def test_hot_blocks_are_cut_and_lose_no_pair(spark, monkeypatch):
    """Hundreds of words with one beginning and one end; tiles of four words."""
    monkeypatch.setattr(spelling, "TILE", 4)
    rows = [(1, " ".join(f"pre{a}{b}{c}{x}post" for x in ("", "q") for a in "abcdef" for b in "abcdef" for c in "abcdef" for _ in range(5 + 30 * (a == b == c))))]
    expected = variants_by_hand(rows)
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    assert found_variants(spark, frame) == expected
    blocks = spelling.leaf_blocks(spark, cut(spark, spelling.corpus_words(frame), "test-words"))
    assert len(blocks) > 1
    leaves = [b.filter("size <= 4 OR hi - lo <= 1") for b in blocks]
    assert max(b.agg(F.max("size")).first()[0] or 0 for b in leaves) <= 6 * 6 + 6     # one free place, or two in the longer words: bounded by the alphabet


def test_ties_chains_and_empty_tables(spark):
    text = " ".join(["aaaaaa"] * 5 + ["aaaaab"] * 25 + ["aaaabb"] * 130 + ["caaaaa"] * 25 + ["zzzzzz"] * 5 + ["yzzzzz"] * 24)
    got = found_variants(spark, spark.createDataFrame([(7, text)], "doc_id long, text string"))
    assert got == variants_by_hand([(7, text)])
    assert got["aaaaaa"][:2] == ("aaaaab", "aaaabb") and got["zzzzzz"][0] is None      # ties to the smallest, 24 is under 5 * 5
    assert found_variants(spark, spark.createDataFrame([], "doc_id long, text string")) == {}


# --- 12 phrases ---------------------------------------------------------------------

def phrases_by_sql(rows):
    import pandas as pd
    con = duckdb.connect()
    con.register("documents", pd.DataFrame({"lang": pd.Series([r[0] for r in rows], dtype="string"), "text": pd.Series([r[1] for r in rows], dtype="string")}))
    names = [d[0] for d in con.execute(queries.ORACLES["op12_phrases"]).description]
    return sorted((tuple(r) for r in con.fetchall()), key=str), names


PHRASE_ROWS = (
    [("en", "The quick  brown\tfox. jumps over the lazy dog! And the quick brown fox runs; " * 7)] * 4 + [("de", "Der schnelle Fuchs, der schnelle Fuchs\nder Fuchs")] * 33
    + [(None, "a b a b a b a b a b")] * 20 + [("und", "a b a b. ÄB cd ÄB cd? äB cd")] * 12 + [("en", None), ("en", ""), ("en", " \t.,;"), (None, None), ("fr", "x " * 3000)]
    + [("es", f"uno dos tres w{i} cuatro") for i in range(64)] + [("es", " ".join(["uno"] + ["w" * 70000]) * 2)] * 30)


def test_phrases_equal_sql(spark):
    want, names = phrases_by_sql(PHRASE_ROWS)
    frame = spark.createDataFrame(PHRASE_ROWS, "lang string, text string")
    got = collocations.phrases(spark, frame)
    assert sorted(got.columns) == sorted(names) and len(want) > 5
    assert sorted((tuple(r) for r in got.select(*names).collect()), key=str) == want
    again = collocations.phrases(spark, odd_columns(frame.repartition(17)))
    assert sorted((tuple(r) for r in again.select(*names).collect()), key=str) == want


def test_counts_of_all_lengths_come_from_the_flow(spark, monkeypatch):
    """Small held counts and many buckets; every count against a plain count of windows."""
    monkeypatch.setattr(collocations, "HELD", 500)
    monkeypatch.setattr(collocations, "WALKED", 300)
    monkeypatch.setattr(collocations, "BUCKET_CHARS", 2000)
    rng = np.random.default_rng(12)
    rows = [(["en", "de"][i % 2], " ".join(f"w{int(x)}" + ("," if rng.random() < 0.2 else "") for x in rng.zipf(1.3, 80) if x < 300)) for i in range(120)]
    plain = Counter()
    for lang, text in rows:
        for piece in re.split("[.,;:!?\x0a-\x0d]", text):
            ws = piece.split()
            for k in range(1, 5):
                plain.update((lang, k, " ".join(ws[i:i + k])) for i in range(len(ws) - k + 1))
    found = collocations.counts(spark.createDataFrame(rows, "lang string, text string").repartition(5), least=2).collect()
    assert {(r.lang, r.size, r.phrase): r.f for r in found if r.size} == {k: f for k, f in plain.items() if f >= 2}
    for lang in ("en", "de"):
        assert sum(r.f for r in found if r.size == 0 and r.lang == lang) == sum(f for (g, k, _), f in plain.items() if g == lang and k == 1)


def test_grams_are_summed_and_shortened_as_bytes(monkeypatch):
    """Blanks of any length, letters of several bytes, and gathering a few grams at a time."""
    monkeypatch.setattr(collocations, "GATHERED", 3)
    many, found = collocations.walk(["Ä b\t\tC  d e, \x00f", "", " .x y", "a B c d e"])
    got = Counter((size, gram) for size, lines in found for gram in collocations._listed(lines))
    assert many == 13 and got == Counter({(4, "Ä b c d".encode()): 1, (4, b"b c d e"): 2, (4, b"a b c d"): 1, (3, b"c d e"): 2, (2, b"d e"): 2, (1, b"e"): 2,
                                          (1, b"\x00f"): 1, (2, b"x y"): 1, (1, b"y"): 1})
    part = collocations._lines(np.frombuffer("Ä b c\na b c\nÄ b d\n".encode(), np.uint8))
    assert collocations._listed(collocations._shorter(part, 3)) == ["Ä b".encode(), b"a b", "Ä b".encode()]
    assert collocations._listed(collocations._shorter(part[1:], 3)) == [b"a b", "Ä b".encode()]
    large = 2**53 + 1
    lines, counts = collocations._summed([(part, np.array([1, large, 2])), (part[:1], np.array([4]))])
    want = {"Ä b c".encode(): 5, b"a b c": large, "Ä b d".encode(): 2}
    assert dict(zip(collocations._listed(lines), counts.tolist())) == want
    rows = [(r[0], *collocations._unpacked({"grams": r[4], "counts": r[5]})) for r in collocations._packed("x", 3, (lines, counts), 2)]
    back = {gram: (bucket, n) for bucket, some, counts in rows for gram, n in zip(collocations._listed(some), counts.tolist())}
    assert back == {gram: (zlib.crc32(gram) % 2, n) for gram, n in want.items()}


def test_large_counts_are_exact(spark):
    found = spark.createDataFrame([("x", 1, "a", 10**13 + 1), ("x", 1, "b", 10**13), ("x", 2, "a b", 9 * 10**12 + 7)], "lang string, size int, phrase string, f long")
    row = collocations.scored(found).first()
    assert row.score == 2_000_000 * (9 * 10**12 + 7) // (2 * 10**13 + 1)


def test_paths_are_compacted_and_rings_stand_alone(spark):
    chain = "a b c d e f g".split()
    edges = [("x", " ".join(chain[i:i + 4])) for i in range(4)] + [("x", "r s r s"), ("x", "s r s r"), ("x", "z z z z"), ("y", "a b c d"), ("x", "q e f g")]
    got = {(r.lang, r.phrase): (r.path, r.place) for r in collocations.paths(spark, spark.createDataFrame(edges, "lang string, phrase string")).collect()}
    assert got[("x", "a b c d")] == ("a b c d e f g", 0) and got[("x", "d e f g")] == ("a b c d e f g", 3)
    assert got[("y", "a b c d")] == ("a b c d", 0) and got[("x", "q e f g")] == ("q e f g", 0)
    assert got[("x", "r s r s")] == ("r s r s", 0) and got[("x", "s r s r")] == ("s r s r", 0) and got[("x", "z z z z")] == ("z z z z", 0)
    assert collocations.phrases(spark, spark.createDataFrame([], "lang string, text string")).count() == 0


# --- 13 packing -----------------------------------------------------------------------

PATH = public_tokenizers.path("byte_bpe_50k.json")


def library():
    tokenizer = Tokenizer.from_file(PATH)
    tokenizer.encode_special_tokens = True
    return tokenizer


def check_packing(rows, pieces, capacity):
    """Every document's ids are there, pieces are cut as told, sequences are gapless and not too long."""
    tokenizer = library()
    want = Counter()
    for doc, text in rows:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [0]
        first = len(ids) % capacity or capacity
        parts = [ids[:first]] + [ids[i:i + capacity] for i in range(first, len(ids), capacity)]
        start = 0
        for k, part in enumerate(parts):
            want[(doc, k, start, len(part), zlib.crc32(np.array(part, "<u4").tobytes()), tuple(part))] += 1
            start += len(part)
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32, tuple(r.ids)) for r in pieces) == want
    sequences = {}
    for r in pieces:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in sequences.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= capacity
    return len(sequences), -(-sum(r.length for r in pieces) // capacity)


@pytest.mark.parametrize("capacity", [64, 2048])
def test_packing_against_the_library(spark, capacity):
    rng = np.random.default_rng(13)
    rows = [(i, " ".join("".join(rng.choice(list("abcdeé漢 \n'"), rng.integers(1, 9))) for _ in range(int(rng.integers(0, 90))))) for i in range(150)]
    rows += [(None, None), (None, None), (5, ""), (5, ""), (6, "<|endoftext|>"), (7, "word " * 9000), (8, "x" * 30000)] + [(9, "one hot text")] * 400
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    pieces = cut(spark, packing.token_pieces(odd_columns(frame.repartition(7)), PATH, capacity=capacity), "test-pieces")
    placed = packing.pack(spark, pieces, capacity=capacity)
    many, least = check_packing(rows, placed.collect(), capacity)
    assert many <= least * 1.02 + 1
    whole = packing.sequences(cut(spark, placed, "test-placed")).collect()
    assert len(whole) == many and all(len(r.ids) == sum(r.lengths) <= capacity for r in whole)
    assert sum(len(r.ids) for r in whole) == sum(len(library().encode(t or "", add_special_tokens=False).ids) + 1 for _, t in rows)


def test_the_plan_is_best_fit_decreasing():
    """The plan over counts fills sequences as best fit, item by item, does."""
    rng = np.random.default_rng(1)
    for _ in range(40):
        capacity = int(rng.integers(5, 60))
        histogram = {int(k): int(rng.integers(1, 40)) for k in rng.integers(1, capacity + 1, 12)}
        free = []
        for length in sorted(histogram, reverse=True):
            for _ in range(histogram[length]):
                fits = [f for f in free if f >= length]
                best = min(fits) if fits else capacity
                if fits:
                    free.remove(best)
                free.append(best - length)
        used = Counter()
        ranks = Counter()
        for s in packing.plan(histogram, capacity):
            assert s.first == ranks[s.length]
            ranks[s.length] = s.last + 1
            for rank in range(s.first, s.last + 1):
                used[s.sequence + (rank - s.first) // s.each] += s.length
        assert ranks == histogram and sorted(capacity - u for u in used.values()) == sorted(free)


def test_the_plan_follows_lengths_not_documents():
    small, large = ({k: n for k in range(1, 2049)} for n in (10, 10**9))
    assert len(packing.plan(large)) <= 4 * len(packing.plan(small)) and sum(s.last - s.first + 1 for s in packing.plan(large)) == 2048 * 10**9


def test_an_empty_table_has_no_pieces(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert packing.pack(spark, cut(spark, packing.token_pieces(empty, PATH), "test-pieces")).count() == 0


def test_encoding_equals_the_library_on_odd_texts():
    encoder, tokenizer = packing.Encoder(PATH), library()
    rng = np.random.default_rng(4)
    parts = [" ", "  ", "\n", "\t", "\r", "a", "the", "don't", "'s", "'ll", "é", "漢", "123", "٣", "<|endoftext|>", "!!", " ", " ", "\x1c", "​", "😀"]
    for _ in range(2000):
        text = "".join(rng.choice(parts, rng.integers(0, 14)))
        assert np.frombuffer(encoder.ids(text), "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids, repr(text)
