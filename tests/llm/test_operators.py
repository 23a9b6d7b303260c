"""The training-data operators against brute force, exact round trips and awkward rows."""
from __future__ import annotations

import hashlib
import re
import tracemalloc
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from strata.llm import bpe, covertree, html, licenses, lm, minhash, mixing, quality, quotes, toxicity
from strata.llm.common import batch_rows, cut, pack

WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
ROWS = [
    (1, "one two three four five six seven eight nine ten", "en", "a", 10),
    (2, "one two three four five six seven eight nine ten", "en", "a", 10),
    (3, None, None, None, None),
    (4, "", "en", "b", 0),
    (None, "a text without an id, which is a row like any other one", None, "a", 1),
    (5, "word " * 30_000, "de", None, 1),
    (6, " \t\n ", "fr", "b", 4),
    (1, "one two three four five six seven eight nine ten", "en", "a", 10),
]


@pytest.fixture(scope="module")
def docs(spark):
    # extra columns whose names an operator uses itself
    return spark.createDataFrame(ROWS, DOCS).select("*", F.lit("x").alias("score"), F.lit(1).alias("n_words"), F.lit(2).alias("key"), F.lit(3).alias("target"))


@pytest.fixture(scope="module")
def empty(docs):
    return docs.filter("false")


# --- 5 byte-level BPE ---------------------------------------------------------

tiktoken = pytest.importorskip("tiktoken")
public_tokenizers = pytest.importorskip("public_tokenizers")
RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.load_ranks(RANKS), special_tokens={})


def test_bpe_equals_the_library(library):
    rng = np.random.default_rng(5)
    texts = ["", " ", "a" * 4000, "ab" * 900 + "é" * 300, "".join(rng.choice(list("abcdefgh"), 3000)), " " * 2000, "日本語テキスト🙂 ok\n\n\tx",
             "<|endoftext|>\x00", "don't I'll we've 12345 --- ...", "Straße über çà et là, ñandú"]
    texts += ["".join(rng.choice(list(" \nabcdeéßñ🙂.,'0123"), int(n))) for n in rng.integers(1, 300, 80)]
    coder = bpe.Coder(bpe.load_ranks(RANKS), public_tokenizers.PATTERN)
    for text, (n, ids_hash, back_hash, ids) in zip(texts, coder.encode_texts(texts, True), strict=True):
        expected = library.encode_ordinary(text)
        assert ids.tolist() == expected and n == len(expected)
        assert ids_hash == hashlib.sha256(",".join(map(str, expected)).encode()).hexdigest()
        assert back_hash == hashlib.sha256(text.encode()).hexdigest()
        assert coder.decode(expected) == text.encode()


def test_bpe_rows(docs, empty, library):
    got = bpe.encode(docs, RANKS, public_tokenizers.PATTERN).collect()
    assert len(got) == len(ROWS)
    assert Counter((r.doc_id, tuple(r.ids)) for r in got) == Counter((d, tuple(library.encode_ordinary(t or ""))) for d, t, *_ in ROWS)
    assert bpe.encode(empty, RANKS, public_tokenizers.PATTERN).count() == 0


# --- 8 quality rules ----------------------------------------------------------

def counted(text):
    words = WORD.findall(text or "")
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    windows = defaultdict(list)
    for i in range(len(words) - 7):
        windows[tuple(words[i:i + 8])].append(i)
    covered = {k for at in windows.values() if len(at) > 1 for i in at for k in range(i, i + 8)}
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered)


def test_quality_statistics(spark, docs):
    rng = np.random.default_rng(8)
    more = [("".join(rng.choice(["ab ", "c ", "d\n", "#| ", "é  ", "\n\n"], int(n))),) for n in rng.integers(0, 120, 120)]
    texts = docs.select("text").union(spark.createDataFrame(more, "text string"))
    for row in quality.statistics(texts).select("text", "__stats.*").collect():
        assert tuple(row[c] for c in quality.BASE) == counted(row.text)
        assert row.base_failed == (row.n_words < 20 or 100 * row.n_repeat_words > 30 * row.n_words)


def test_quality_verdict_keeps_clean_and_rejects_junk(spark, docs, empty):
    rng = np.random.default_rng(9)
    vocabulary = ["".join(rng.choice(list("abcdefghij"), int(k))) for k in rng.integers(2, 9, 500)]
    clean = [(i, " ".join(rng.choice(vocabulary, int(n))), "en", "s", 0) for i, n in enumerate(rng.integers(30, 400, 300))]
    junk = [(1000 + i, " | ".join(rng.choice(vocabulary, 60)), "en", "s", 0) for i in range(20)]
    judged = {r.doc_id: r for r in quality.judge(spark, spark.createDataFrame(clean + junk, DOCS)).select("doc_id", "__quality.*").collect()}
    assert all(judged[i].kept for i in range(300)) and not any(judged[1000 + i].kept for i in range(20))
    odd = quality.judge(spark, docs)
    assert odd.columns == [*docs.columns, "__quality"] and odd.count() == len(ROWS)
    assert not odd.filter("__quality.kept and (text is null or text = '')").count()
    assert quality.judge(spark, empty).count() == 0


def test_quality_statistics_reject_alone_and_small_sources_are_judged(spark):
    rng = np.random.default_rng(81)
    vocabulary = ["".join(rng.choice(list("abcdefghij"), int(k))) for k in rng.integers(2, 9, 500)]
    body = lambda n: list(rng.choice(vocabulary, n))
    clean = [(i, " ".join(body(int(n))), "en", "s", 0) for i, n in enumerate(rng.integers(60, 400, 200))]
    again = [" ".join(w + w[:12]) for w in (body(100) for _ in range(6))]
    repeated = [(1000 + i, t, "en", "s", 0) for i, t in enumerate(again)]
    junk = " | ".join(body(60))
    small = [(2000, junk, "en", "tiny", 0), (2001, " ".join(body(100)), "en", "tiny", 0), (2002, junk, "xx", "other", 0), (2003, " ".join(body(100)), "xx", None, 0)]
    judged = {r.doc_id: r for r in quality.judge(spark, spark.createDataFrame(clean + repeated + small, DOCS)).select("doc_id", "__quality.*").collect()}
    assert all(judged[i].kept for i in range(200)) and not any(judged[1000 + i].base_failed or judged[1000 + i].kept for i in range(6))
    assert [judged[i].kept for i in (2000, 2001, 2002, 2003)] == [False, True, False, True]
    assert all(r.base_failed or r.distance is not None for r in judged.values())


def test_quality_plan_is_native(spark, docs):
    plan = quality.statistics(docs)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


# --- 4 toxicity ---------------------------------------------------------------

def test_grammar_scopes():
    machine = toxicity.Machine(toxicity.Grammar())
    kind = lambda text: dict(zip(toxicity.KINDS, machine.sums(text), strict=True))
    assert kind("What an idiot. Calm.")["insult"] == 1
    assert kind("you are an idiot")["insult_at_target"] == 1
    assert kind("you are not an idiot")["negated"] == 1
    assert kind("She said the man is an idiot")["reported"] == 1
    assert kind("Watch out: I will find you")["threat"] == 1
    assert kind("not here. idiot")["insult"] == 1            # a clause ends the scope
    assert not any(machine.sums("idiotic people in a clownfish tank")) and not any(machine.sums(None))


def test_toxicity_learns_stems_and_scores(spark, docs, empty):
    rng = np.random.default_rng(4)
    vocabulary = ["".join(rng.choice(list("abcdefgh"), 5)) for _ in range(400)]
    texts = []
    for i in range(300):
        words = list(rng.choice(vocabulary, 60))
        if i % 6 == 0:
            words[10], words[30] = "xulmo" + rng.choice(["ra", "ti", "zen"]), "xulmo" + rng.choice(["ra", "bi", "non"])
        texts.append((" ".join(words), int(i % 6 == 0)))
    grammar = toxicity.fit(spark.createDataFrame(texts, "text string, toxic int"))
    assert any("xulmora".startswith(s) for s in grammar.stems)
    got = toxicity.score(spark.createDataFrame([(1, "a xulmogu thing and xulmora"), (2, "a plain thing"), (3, None)], "doc_id long, text string"), grammar)
    by = {r.doc_id: r for r in got.collect()}
    assert by[1].predicted == 1 and by[2].predicted == 0 and by[3].score == by[2].score
    assert toxicity.score(pack(docs, __text="text"), grammar, text="__text", keys=("__row",)).count() == len(ROWS)
    apart = toxicity.score(pack(docs, __text="text"), grammar, text="__text", keys=("__row",)).collect()
    within = toxicity.score(pack(docs), grammar, keys=("__row",), within="__row").collect()
    assert sorted(map(repr, within)) == sorted(map(repr, apart)) and len(within) == len(ROWS)
    assert toxicity.score(empty, grammar).count() == 0
    assert toxicity.fit(spark.createDataFrame([], "text string, toxic int")).weights == tuple(toxicity.START_WEIGHTS)


# --- 7 near-duplicates --------------------------------------------------------

def multiset(text):
    words = [w for w in WORD.findall((text or "").lower())]
    return Counter(tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))) if words else Counter()


def test_signatures_estimate_weighted_jaccard():
    rng = np.random.default_rng(7)
    error = []
    for _ in range(80):
        keys = rng.integers(0, 2**63, 120).astype(np.uint64)
        keys.sort()
        one, two = rng.integers(1, 7, 120), rng.integers(1, 7, 120)
        two[:60] = one[:60]
        s = minhash.signatures([(keys, one), (keys, two)])
        error.append((s[0] == s[1]).mean() - np.minimum(one, two).sum() / np.maximum(one, two).sum())
    assert abs(np.mean(error)) < 0.015


def test_signing_takes_memory_by_groups_of_texts():
    rng = np.random.default_rng(72)
    words = [rng.integers(-2**62, 2**62, int(n)) for n in [*rng.integers(0, 800, 1500), 90_000]]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(words))), pa.array([b"k"] * len(words)), pa.array(words, pa.list_(pa.int64()))],
                                       names=["doc_id", "key", "text"])
    tracemalloc.start()
    try:
        sketches, most = [], 0
        for out in minhash._signature_batches(iter([batch])):
            sketches += out.column(3).to_pylist()
        most = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert most < 40e6  # groups of 600,000 words took 95 MB
    alone = minhash.signatures([minhash.shingles(w) for w in words])  # groups change nothing
    assert sketches == [(minhash._mix(n ^ minhash.GOLD) & np.uint64(255)).astype(np.uint8).tobytes() if len(w) else None
                        for n, w in zip(alone, words, strict=True)]


def test_batches_to_python_hold_few_rows(spark):
    setting = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(setting)

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows])], names=["n"])

    rows = spark.range(0, 250, 1, 1).mapInArrow(sizes, "n long")
    with pytest.raises(ValueError):
        with batch_rows(spark, 100):
            assert [r.n for r in rows.collect()] == [100, 100, 50]
            with batch_rows(spark, 200):  # never more than was set
                assert max(r.n for r in spark.range(0, 250, 1, 1).mapInArrow(sizes, "n long").collect()) == 100
            raise ValueError
    assert spark.conf.get(setting) == before


def test_classes_equal_brute_force(spark, docs, empty):
    rng = np.random.default_rng(70)
    vocabulary = [f"w{k}" for k in range(300)]
    texts = []
    for _ in range(12):
        base = list(rng.choice(vocabulary, 80))
        for _ in range(8):  # a drifting chain of copies
            texts.append(" ".join(base))
            base = list(base)
            base[rng.integers(0, 80)] = rng.choice(vocabulary)
    rows = [(i, t, "en", "s", 0) for i, t in enumerate(texts)] + [(200, texts[0], "en", "s", 0), (201, None, "en", "s", 0), (202, "", "en", "s", 0), (203, "hi", "en", "s", 0), (204, "Hi", "en", "s", 0)]
    bags = {r[0]: multiset(r[1]) for r in rows}
    expected = {i: i for i in bags}
    changed = True
    while changed:
        changed = False
        for a in bags:
            for b in bags:
                if a < b and bags[a] and sum((bags[a] & bags[b]).values()) >= 0.8 * sum((bags[a] | bags[b]).values()) and expected[a] != expected[b]:
                    expected[a] = expected[b] = min(expected[a], expected[b])
                    changed = True
    got = {r.doc_id: r.class_id for r in minhash.classes(spark, spark.createDataFrame(rows, DOCS)).collect()}
    assert got == expected
    one_each = minhash.representatives(spark, docs)
    assert one_each.columns == docs.columns
    assert Counter(r.doc_id for r in one_each.collect()) == Counter({1: 1, 3: 1, 4: 1, None: 1, 5: 1, 6: 1})
    assert minhash.classes(spark, empty).count() == 0 and minhash.representatives(spark, empty).count() == 0


def test_classes_are_not_told_by_their_ids(spark, tmp_path):
    from strata.llm import queries

    rng = np.random.default_rng(71)
    vocabulary = [f"w{k}" for k in range(300)]
    texts = [" ".join(rng.choice(vocabulary, 60)) for _ in range(9)]
    near = texts[8] + " end"
    rows = [(None, t, "en", "s", 0) for t in texts[:4]]                # several different texts without an id
    rows += [(7, t, "en", "s", 0) for t in texts[4:7]]                 # an id over different texts
    rows += [(None, texts[7], "en", "s", 0), (9, texts[7], "en", "s", 0), (None, near, "en", "s", 0), (None, texts[8], "en", "s", 0)]
    frame = spark.createDataFrame(rows, DOCS)
    stay = minhash.representatives(spark, frame).collect()
    one = {(r.doc_id, r.text) for r in stay}
    assert len(stay) == 9 and len(one & {(None, near), (None, texts[8])}) == 1
    assert one - {(None, near), (None, texts[8])} == {(None, t) for t in texts[:4]} | {(7, t) for t in texts[4:7]} | {(9, texts[7])}
    frame.write.parquet(f"{tmp_path}/documents.parquet")
    got = queries.op7_minhash_near_dedup(spark, str(tmp_path)).collect()
    assert len({r.class_key for r in got}) == 9 and sum(r.kept for r in got) == 9


# --- 6 mixing -----------------------------------------------------------------

def test_targets_and_split():
    target = mixing.allot(np.array([100, 1000, 1000, 0]), np.array([5.0, 2.0, 1.0, 5.0]))
    assert target[0] == 200 and target[3] == 0 and abs(target.sum() - 3150) < 1e-6 and target[1] == 2 * target[2] or target[1] == 2000
    quotas = np.array([5, 0, 17, 1000])
    parts = mixing.hypergeometric_split(quotas, 6, np.random.default_rng(0))
    assert (parts.sum(axis=0) == quotas).all() and (parts >= 0).all() and parts.sum(axis=1).max() - parts.sum(axis=1).min() <= 2


def test_mix_comes_near_targets(spark, docs, empty):
    rng = np.random.default_rng(6)
    rows = [(i, "w " * int(rng.integers(1, 200)), "en", f"s{i % 5}" if i % 7 else None, 0) for i in range(900)]
    frame = spark.createDataFrame(rows, DOCS)
    sizes = cut(spark, mixing.sized(frame).select("__row.doc_id", "__key", "__source", "__size"), "test-sizes")
    drawn = mixing.draw(spark, sizes)
    got = drawn.groupBy("__source", "target").agg(F.sum("taken").alias("taken")).collect()
    assert all(abs(r.taken - r.target) <= 0.02 * r.target for r in got) and len(got) == 6
    assert drawn.groupBy("doc_id").count().agg(F.max("count")).first()[0] <= 2
    first, second = (sorted(r.doc_id for r in mixing.mix(spark, frame).collect()) for _ in range(2))
    assert first == second
    assert mixing.mix(spark, docs).columns == docs.columns
    assert mixing.mix(spark, empty).count() == 0


def test_mixing_query_deals_the_shards(spark, tmp_path):
    from strata.llm import queries

    rng = np.random.default_rng(61)
    rows = [(i, f"d{i} " + "w " * int(rng.integers(1, 200)), "en", f"s{i % 3}", 0) for i in range(900)]
    spark.createDataFrame(rows, DOCS).write.parquet(f"{tmp_path}/documents.parquet")
    got = queries.op6_mixing(spark, str(tmp_path)).collect()
    assert len(got) == 900 and all(r.taken == r["size"] * len(r.shards) == r["size"] * len(r.positions) for r in got)
    at = defaultdict(list)
    for r in got:
        for shard, position in zip(r.shards, r.positions, strict=True):
            at[shard].append((position, r.doc_id))
    assert set(at) == set(range(mixing.SHARDS))
    for placed in at.values():  # each shard is a shuffled line without holes
        assert sorted(p for p, _ in placed) == list(range(len(placed)))
        ids = [d for _, d in sorted(placed)]
        assert ids != sorted(ids)
    frame = spark.read.parquet(f"{tmp_path}/documents.parquet")
    assert Counter(d for placed in at.values() for _, d in placed) == Counter(r.doc_id for r in mixing.mix(spark, frame).collect())


# --- 3 embeddings -------------------------------------------------------------

def test_cover_tree_pairs_are_exact():
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(12, 16))
    x = centres[rng.integers(0, 12, 700)] + rng.normal(size=(700, 16)) * 0.12
    x /= np.linalg.norm(x, axis=1)[:, None]
    tree = covertree.CoverTree(x)
    i, j = covertree.dual_pairs(tree, tree, same=True)
    assert set(zip(i.tolist(), j.tolist(), strict=True)) == set(zip(*(a.tolist() for a in np.nonzero(np.triu(x @ x.T >= 0.98, 1))), strict=True))


def test_cover_tree_pairs_along_a_curve():
    for n in (400, 1500):  # inner nodes beside each other: over LEAF points per child
        angle = np.linspace(0, 2 * np.pi, n, endpoint=False)
        x = np.stack([np.cos(angle), np.sin(angle)], axis=1)
        tree = covertree.CoverTree(x)
        i, j = covertree.dual_pairs(tree, tree, 0.98, same=True)
        assert set(zip(i.tolist(), j.tolist(), strict=True)) == set(zip(*(a.tolist() for a in np.nonzero(np.triu(x @ x.T >= 0.98, 1))), strict=True))


def test_embedding_classes(spark):
    rng = np.random.default_rng(33)
    base = rng.normal(size=(6, 8))
    rows = [(k, (base[k % 6] + rng.normal(size=8) * 0.05).tolist(), k % 2) for k in range(60)]
    rows += [(100, rows[0][1], 0), (101, [3.0 * v for v in rows[0][1]], 0), (102, None, 0), (103, [0.0] * 8, 0), (104, [float("nan")] * 8, 0), (105, rows[0][1], None),
             (106, [None] + [1.0] * 7, 0), (107, [], 0), (108, [1.0], 0)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = {r.vec_id: r for r in covertree.classes(spark, frame).collect()}
    good = {k: np.array(v) / np.linalg.norm(v) for k, v, lab in rows if v and None not in v and np.isfinite(v).all() and np.linalg.norm(v) > 0 and lab is not None}
    label = {k: lab for k, _, lab in rows}
    linked = {a: {b for b in good if b != a and label[a] == label[b] and len(good[a]) == len(good[b]) and good[a] @ good[b] >= 0.98} for a in good}
    for k in got:
        assert got[k].n_links == len(linked.get(k, ()))
        seen, todo = {k}, [k]
        while todo:
            for b in linked.get(todo.pop(), ()):
                if b not in seen:
                    seen.add(b)
                    todo.append(b)
        assert got[k].component_id == min(seen)
    assert covertree.classes(spark, frame.filter("false")).count() == 0


# --- 2 web pages --------------------------------------------------------------

PAGES = [
    ("<html><head><title>T</title></head><body><nav><a href=x>menu</a></nav><article><h1>Head</h1><p>One &amp; two<p>Three<br>four</article><footer>c</footer>", "Head\n\nOne & two\n\nThree four"),
    ("<article><p>a</p><div class='ad'>buy</div><aside>side</aside><p>b</p><form>f</form></article><section id=comments><p>bad</p></section>", "a\n\nb"),
    ("<div id=cookie-notice>We use cookies on this site</div><div><p>" + "word " * 30 + "</p><p>Short.</p></div><script>var a='<p>no</p>'</script>", ("word " * 30).strip() + "\n\nShort."),
    ("<article><p>cut off in the mid", "cut off in the mid"),
    ("", ""), (None, ""), ("<!-- <p>no</p> --><style>p{}</style>", ""),
]


def test_main_text(spark):
    rows = [(i, "u", p) for i, (p, _) in enumerate(PAGES)]
    got = {r.page_id: r for r in html.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    for i, (_, text) in enumerate(PAGES):
        assert got[i].text == text and got[i].n_chars == len(text)


def test_text_beside_hidden_elements_stays():
    long, end = ("word " * 1000).strip(), ("closing " * 35).strip()
    for hidden in ("<div class='ad'>buy</div>", "<aside>side</aside>", "<div class='newsletter-box'>join</div>" * 3):
        assert html.main_text(f"<body><div><p>{long}</p>{hidden}<p>{end}</p>{hidden}<p>End.</p></div></body>") == f"{long}\n\n{end}\n\nEnd."
    for mention in ("layout has-sidebar", "no-sidebar", "content-with-ads"):
        assert html.main_text(f"<div class='{mention}'><article><p>a</p></article></div>") == "a"
    for mark in ("sidebar", "site-footer", "x cookie-notice", "ad_slot_2"):
        assert html.main_text(f"<article><p>a</p><div class='{mark}'>bad</div></article>") == "a"
    assert html.main_text("<article><figure><img src=x><figcaption>seen</figcaption></figure><p>a</p></article>") == "seen\n\na"
    assert html.main_text("<article><header><p>" + "lead " * 100 + "</p><h1>Head</h1></header><p>a</p></article>").endswith("lead\n\nHead\n\na")
    assert html.main_text("<article><header><p>no heading</p></header><h1>Head</h1></article>") == "Head"


# --- 9 licences ---------------------------------------------------------------

def test_licence_scan(spark):
    rng = np.random.default_rng(90)
    vocabulary = ["".join(rng.choice(list("abcdefgh"), 5)) for _ in range(300)]
    filler = [" ".join(rng.choice(vocabulary, 12)) for _ in range(60)]
    notices = {"Apache": "Licensed under the Apache License, Version 2.0.", "MIT": "Released under the MIT License.",
               "GPL": "This work is licensed under the GNU General Public License, version 2.", "CC-BY-NC": "Licensed under CC BY-NC 3.0."}
    rows = [(i, t) for i, t in enumerate(filler)] + [(100 + i, f"{filler[i]}\n{n}\n{filler[i + 1]}") for i, n in enumerate(notices.values())]
    rows += [(200, "The licence of the driver was copied without permission by the public"), (201, None), (202, "")]
    got = licenses.scan(spark, spark.createDataFrame(rows, "doc_id long, text string")).collect()
    found = {r.doc_id: (r.family, r.paragraph) for r in got if r.confirmed}
    assert found == {100 + i: (f, 1) for i, f in enumerate(notices)}


def test_wrapped_licence_notices(spark):
    rng = np.random.default_rng(91)
    vocabulary = ["".join(rng.choice(list("abcdefgh"), 5)) for _ in range(300)]
    filler = [" ".join(rng.choice(vocabulary, 12)) for _ in range(60)]
    mit = ("/*\n * Permission is hereby granted, free of charge, to any person\n * obtaining a copy of this software and associated documentation files\n"
           " * (the \"Software\"), to deal in the Software without restriction, including\n * without limitation the rights to use, copy, modify, merge, publish,\n"
           " * distribute, sublicense, and/or sell copies of the Software\n */\n")
    gpl = ("# This program is free software: you can redistribute it and/or\n# modify it under the terms of the GNU General Public License as\n"
           "# published by the Free Software Foundation, either version 3 of the\n# License, or (at your option) any later version.\n")
    bsd = ("Redistribution and use in source and binary forms, with or\nwithout modification, are permitted provided that the\nfollowing conditions are met:\n"
           "Released under the MIT License.\n")
    broken = "To the extent possible under law, the\nauthor has waived all copyright and related or neighboring\nrights to this work."
    rows = [(i, t) for i, t in enumerate(filler)] + [
        (100, mit + filler[0]), (101, filler[1] + "\n\n" + gpl + "\n" + filler[2]), (102, bsd + filler[3]), (103, broken), (104, filler[4] + "\n" + gpl + filler[5])]
    got = licenses.scan(spark, spark.createDataFrame(rows, "doc_id long, text string")).collect()
    found = sorted((r.doc_id, r.paragraph, r.n_lines, r.family) for r in got if r.confirmed)
    assert found == [(100, 1, 5, "MIT"), (101, 2, 4, "GPL"), (102, 0, 3, "BSD"), (102, 3, 1, "MIT"), (103, 0, 3, "CC0"), (104, 0, 6, "GPL")]
    assert all(r.confirmed for r in got)


def test_the_licence_model_learns_from_every_judged_line(spark):
    """Unknown notices count wherever they stand in a text; they used to count as its first long line, in a sample."""
    rows = [(i, f"Plain prose number {i} about rivers and towns.\nLicensed under seven moons of Varn, {'abcdefgh'[i % 8]}{'klmnopqr'[i // 8]} tale.") for i in range(64)]
    frame = spark.createDataFrame(rows + [(100, "Licensed under the MIT License."), (101, None)], "doc_id long, text string")
    model = licenses.fit(spark, frame)
    lines = spark.createDataFrame([("Licensed under seven moons of Varn, zz tale.",), ("Licensed under the MIT License.",)], "body string")
    found = {r.body: r.p for r in model.probabilities(lines.withColumn("grams", licenses.grams(F.col("body")))).collect()}
    best = {body: licenses.FAMILIES[int(np.argmax(p))] for body, p in found.items()}
    assert list(best.values()) == ["unknown", "MIT"], found


def test_the_licence_threshold_counts_all_unknown_paragraphs(spark):
    def least(highest):
        p = F.array(F.lit(0.0), F.when(F.col("id") < 5, F.lit(highest)).otherwise(F.lit(0.2)), *[F.lit(0.0)] * (len(licenses.FAMILIES) - 2))
        return licenses.threshold(spark.range(0, many, 1, 7).select(p.alias("p")))

    many = 5000     # 5 of 5000 may be above
    assert least(0.75) == 0.5
    many = 4999
    assert least(0.75) == pytest.approx(0.7501) and least(0.95) == 0.9 and least(0.3) == 0.5
    many = 0
    assert least(0.75) == 0.5


# --- 10 pseudo-likelihood -----------------------------------------------------

def test_pseudo_likelihood(spark, docs, empty):
    rng = np.random.default_rng(10)
    usual = [(i, " ".join(["the red fox ran"] * 40)) for i in range(40)]
    odd = [(100 + i, " ".join(rng.permutation(["the", "red", "fox", "ran"] * 40))) for i in range(5)]
    scored = lm.score(spark, spark.createDataFrame(usual + odd + [(200, None), (201, "")], "doc_id long, text string"))
    got = {r.doc_id: r for r in scored.collect()}
    assert got[0].n_tokens == 160 and abs(got[0].log_likelihood / 160 - got[0].mean_log_probability) < 1e-9
    assert min(got[i].mean_log_probability for i in range(40)) > max(got[100 + i].mean_log_probability for i in range(5))
    assert got[200].n_tokens == 0 and got[200].log_likelihood == 0 and got[200].mean_log_probability is None
    assert lm.score(spark, docs).count() == len(ROWS) and lm.score(spark, empty).count() == 0


KNOWN = 32 * 31     # words with tokens of their own while there are few distinct words


@pytest.mark.parametrize("mapped", [1 << 18, KNOWN + KNOWN // 2 + 10])
def test_rare_words_have_probabilities_of_their_own(spark, monkeypatch, mapped):
    # twice as many words as have tokens; their counts tell those of one shared token apart, in the map or joined
    monkeypatch.setattr(lm, "MAPPED", mapped)
    common = [(i, " ".join(f"c{k}" for k in range(KNOWN))) for i in range(6)]
    rare = [(100 + k, f"w{k} w{k} w{k}" if k % 2 else f"w{k}") for k in range(KNOWN)]
    frame = spark.createDataFrame(common + rare, "doc_id long, text string")
    hashed = frame.select(F.col("doc_id").alias("__key"), lm.token_hashes(F.col("text")).alias("h"))
    hashes = {r["__key"]: r.h[0] for r in hashed.filter("__key >= 100").collect()}
    count = {100 + k: 3 if k % 2 else 1 for k in range(KNOWN)}
    total = Counter()
    for doc, n in count.items():
        total[(hashes[doc] >> 32) & 31] += n
    counts = cut(spark, lm.word_counts(hashed), "test-counts")
    assert counts.count() == 2 * KNOWN and lm.side(2 * KNOWN) == 32
    known = lm.frequent_words(counts, 32)
    assert known.totals.tolist() == [total[t] for t in range(32)]
    read = {r["__key"]: r for r in lm.tokenized(spark, hashed, known).collect()}
    joined = sum(len(r.others) for r in read.values())
    assert joined == (0 if mapped > 2 * KNOWN else KNOWN // 2)   # the words met once are joined
    got = {r.doc_id: r for r in lm.score(spark, frame).collect()}
    for doc, n in count.items():   # what is left without a word's own cost is the same for the words of one shared token and length
        own = n * np.log(n / total[hashes[doc] >> 32 & 31])
        if not read[doc].others:
            assert abs(read[doc].mapped / lm.UNITS - own) < 1e-6
        got[doc] = got[doc].log_likelihood - own
    for token in range(32):
        for n in (1, 3):
            alike = [got[d] for d in count if count[d] == n and (hashes[d] >> 32) & 31 == token]
            assert not alike or max(alike) - min(alike) < 1e-3


@pytest.mark.parametrize("partitions", [1, 4, 200])
def test_scores_do_not_depend_on_the_layout(spark, monkeypatch, partitions):
    monkeypatch.setattr(lm, "LANE_WORDS", 3000)     # several lanes
    rng = np.random.default_rng(3)
    rows = [(i if i % 7 else None, " ".join(f"w{int(w)}" for w in rng.zipf(1.5, int(rng.integers(0, 60))) if w < 5000)) for i in range(300)] * 2
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    key = lambda r: (r.doc_id is None, r.doc_id, r.n_tokens, r.log_likelihood)
    base = sorted(lm.score(spark, frame.coalesce(2)).collect(), key=key)
    other = sorted(lm.score(spark, frame.repartition(partitions, F.rand(partitions))).collect(), key=key)
    assert [(r.doc_id, r.n_tokens) for r in base] == [(r.doc_id, r.n_tokens) for r in other]
    assert max(abs(a.log_likelihood - b.log_likelihood) for a, b in zip(base, other)) < 2e-4   # the last rounded digit


def test_counting_words_hashes_them_once(spark):
    frame = spark.createDataFrame([("a b a",), (None,), ("",), ("b c",)], "text string")
    counts = lm.word_counts(frame.select(lm.token_hashes(F.col("text")).alias("h")))
    assert sorted(r.n for r in counts.collect()) == [1, 2, 2]
    plan = counts._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("xxhash64") == 1


@pytest.mark.parametrize("width", [1, 5, 24, 32, 256])
def test_softmax_of_one_column_equals_that_of_all(width):
    x = np.random.default_rng(width).normal(0, 5, (3000, width)).astype(np.float32)
    at = np.arange(3000) % width
    plain = x - x.max(axis=1, keepdims=True)
    plain -= np.log(np.exp(plain).sum(axis=1, keepdims=True))
    assert (lm.highest(x)[:, 0] == x.max(axis=1)).all()
    assert (lm.log_softmax_at(x.copy(), at) == plain[np.arange(3000), at]).all()    # to the last bit


def test_the_network_grows_with_the_corpus():
    assert [lm.side(n) for n in (0, 10, 10**6, 2**24, 2**28, 2**40)] == [32, 32, 32, 64, 128, 256]


@pytest.mark.parametrize("classes", [4, 32])
def test_network_gradient_against_finite_differences(classes):
    rng = np.random.default_rng(11)
    ids = rng.integers(0, classes * classes, 50).astype(np.int32)
    network = lm.Network(classes, dtype=np.float64)
    edge = classes * classes
    context = network.contexts(ids, np.array([20, 0, 30]))
    assert (context[:, 0] == [edge, edge, ids[1], ids[2]]).all() and context[2, 19] == edge
    found = lm.Network(classes, np.zeros(len(network.flat)), np.float64)
    for name, rows, gradient in network.gradients(ids, context):
        getattr(found, name)[rows] += gradient

    def loss():
        log = network._log_softmax(network.hidden(context) @ network.classes + network.class_bias)[np.arange(50), ids // classes]
        inner = [network._log_softmax((network.hidden(context)[[i]] @ network.members[c] + network.member_bias[c]))[0, ids[i] % classes]
                 for i, c in enumerate(ids // classes)]
        return -(log + inner).mean()

    touched = np.nonzero(found.flat)[0]
    for at in [*rng.choice(touched, 60, replace=False), *rng.integers(0, len(network.flat), 20)]:
        was = network.flat[at]
        network.flat[at] = was + 1e-5
        up = loss()
        network.flat[at] = was - 1e-5
        down = loss()
        network.flat[at] = was
        assert abs((up - down) / 2e-5 - found.flat[at]) < 1e-7, at


# --- 1 quotations -------------------------------------------------------------

def test_quotations(spark):
    rows = [(1, 0, "user", "Hello there\nhow are you?"), (1, 1, "assistant", "> how are you?\n\nFine"), (1, 2, "user", "unrelated"),
            (1, 3, "user", "On Monday X wrote:\n>> how are you?\n> Fine\nGreat"), (2, 0, "u", "> Unrelated\nyes"), (None, None, None, None), (1, 2, "user", "unrelated")]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = quotes.conversations(spark, frame).collect()
    assert len(got) == len(rows)
    by = {(r.conv_id, r.turn): r for r in got}
    assert [(r.turn, r.text) for r in sorted((r for r in got if r.conv_id == 1), key=lambda r: r.position)] == [
        (0, "Hello there\nhow are you?"), (1, "Fine"), (3, "Great"), (2, "unrelated"), (2, "unrelated")]
    assert (by[1, 1].reply_to_turn, by[1, 3].reply_to_turn, by[2, 0].reply_to_conv, by[2, 0].reply_to_turn) == (0, 1, 1, 2)
    assert quotes.conversations(spark, frame.filter("false")).count() == 0


def test_every_passage_has_its_original(spark):
    rows = [(1, 0, "user", "first question\nmore of it"), (1, 1, "assistant", "an answer"), (1, 2, "user", "another remark"),
            (1, 3, "assistant", "> first question\nyes\n> an answer\n> nobody wrote this\nno\n>> another remark\n> unheard of\nend"),
            (1, 3, "assistant", "> another remark\nsame turn")]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {r.text: r for r in quotes.conversations(spark, frame).collect()}
    passages = [(p.level, p.text, p.to_conv, p.to_turn) for p in got["yes\nno\nend"].passages]
    assert passages == [(1, "first question", 1, 0), (1, "an answer\nnobody wrote this", 1, 1), (2, "another remark", 1, 2), (1, "unheard of", None, None)]
    assert got["yes\nno\nend"].reply_to_turn == 0 and got["same turn"].reply_to_turn == 2
    assert [(p.to_conv, p.to_turn) for p in got["same turn"].passages] == [(1, 2)] and got["an answer"].passages == []


# --- the pipeline -------------------------------------------------------------

def test_pipeline_stages(spark, tmp_path):
    import corpus_pipeline

    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality rules", "toxicity", "near-duplicates", "mixing sources", "byte-level BPE"]
    rng = np.random.default_rng(1)
    vocabulary = ["".join(rng.choice(list("abcdefghij"), int(k))) for k in rng.integers(2, 9, 400)]
    rows = [(i, " ".join(rng.choice(vocabulary, int(n))), "en", f"s{i % 3}", 0) for i, n in enumerate(rng.integers(30, 200, 150))]
    rows += [(300, rows[0][1], "en", "s0", 0), (301, rows[1][1] + " end", "en", "s1", 0), (302, "short", "en", "s1", 0),
             (303, "you idiot " + rows[2][1] + " you stupid moron", "en", "s2", 0), (304, None, None, None, None)]
    spark.createDataFrame(rows, DOCS).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(0, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:3]:
        docs = cut(spark, stage(spark, docs, str(tmp_path)), "test-stage")
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    assert {r.doc_id for r in docs.collect()} == set(range(150))
    out = corpus_pipeline.run(spark, str(tmp_path))
    assert {r.doc_id for r in out.select("doc_id").collect()} <= set(range(150)) and out.filter("n_tokens != size(ids)").count() == 0


# --- column names that clash, empty tables, repeated rows, through every stage --------------------

ODD_NAMES = ("a b", "a:b", "x-y", "__stats", "__quality", "__row", "size", "row")


def test_pipeline_stages_take_any_column_names(spark, docs, tmp_path, monkeypatch):
    import corpus_pipeline
    frame = docs.select("*", *[F.lit(i).alias(n) for i, n in enumerate(ODD_NAMES)])
    frame = frame.unionByName(frame)
    labels = spark.createDataFrame([(1, 1, 1), (2, 0, 0)], "doc_id long, quality int, toxic int")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    for table in (frame, frame.limit(0)):
        now = table
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, cut(spark, now, "test-stage"), str(tmp_path))
            if name != corpus_pipeline.STAGES[-1][0]:
                assert out.columns == frame.columns, name
                now = out
            out.count()


def test_one_row_of_a_class_is_kept_whatever_its_ids(spark):
    text = " ".join(f"word{i}" for i in range(40))
    rows = [(1, text), (1, text), (2, text), (None, text + " more"), (None, "other " * 9), (None, "other " * 9), (7, None), (7, "")]
    found = minhash.classes(spark, spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert Counter(r.root for r in found if r.kept and r.root) == {r.root: 1 for r in found if r.root}
    assert sum(r.kept for r in found) == 2 + 2 and all(r.kept for r in found if r.root is None)


# --- 2 and 9 ------------------------------------------------------------------------------------

@pytest.mark.parametrize("mark", ["user-comments", "commentlist", "reader-reply", "cookieBanner", "AdBox"])
def test_parts_beside_the_article_go_by_their_marks(mark):
    prose = "<p>" + "Real prose here. " * 20 + "</p>"
    page = f"<body><article><h1>T</h1>{prose}<div class='{mark}'><p>GO AWAY</p></div><p>end</p></article></body>"
    assert html.main_text(page) == "T\n\n" + ("Real prose here. " * 20).strip() + "\n\nend"


def test_other_articles_go():
    prose = "<p>" + "Real prose here. " * 20 + "</p>"
    whole = ("Real prose here. " * 20).strip()
    assert html.main_text(f"<article><h2>Teaser</h2><p>other</p></article><article>{prose}<p>short</p></article>") == whole + "\n\nshort"
    assert html.main_text(f"<main><h1>T</h1><article>{prose}<article><p>a reader</p></article></article><p>after</p></main>") == f"T\n\n{whole}\n\nafter"


def test_extraction_takes_empty_tables_repeats_and_long_pages(spark):
    long = "<article>" + "<p>Some words of prose.</p>" * 50_000 + "</article>"
    rows = [(1, "u", long), (2, "u", None), (2, "u", None), (3, None, "")]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit("x")).withColumn("a b", F.lit(1))
    got = html.extract(frame).collect()
    assert sorted((r.page_id, r.n_chars) for r in got) == [(1, 50_000 * 22 - 2), (2, 0), (2, 0), (3, 0)]
    assert html.extract(frame.limit(0)).count() == 0


def test_licences_of_other_names_are_never_a_wrong_family(spark):
    notices = {
        "Licensed under the Boost Software License, Version 1.0.": ("Boost", "unknown"),
        "Licensed under the Eclipse Public License, Version 2.0.": ("EPL", "unknown"),
        "This work is licensed under the Open Government Licence, version 3.": ("unknown",),
        "Licensed under the Sleepycat License, Version 2.0.": ("unknown",),
        "This is free and unencumbered software released into the public domain.": ("Unlicense", "unknown"),
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
        "provided that the above copyright notice and this permission notice appear in all copies.": ("ISC", "unknown"),
        'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF '
        "MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.": ("MIT",),
        "Licensed under the Apache License, Version 2.0.": ("Apache",),
        "Licensed under the MIT License.": ("MIT",),
        "This work is licensed under the GNU General Public License, version 3.": ("GPL",)}
    rows = [(i, text) for i, text in enumerate(notices)] + [(100 + i, f"Plain prose number {i} about rivers and towns, without any notice.") for i in range(60)]
    frame = spark.createDataFrame(rows + rows[:1], "doc_id long, text string")
    model = licenses.fit(spark, frame)
    found = {}
    for r in licenses.scan(spark, frame, model=model).collect():
        found[r.doc_id] = r.family
    for i, families in enumerate(notices.values()):
        assert found[i] in families, (rows[i], found[i])
    assert licenses.scan(spark, frame.limit(0), model=model).count() == 0


# --- 4 toxicity, held out -------------------------------------------------------------------------

def test_toxicity_on_rows_that_were_never_learned_from(spark):
    """Labelled documents of sf0.01 whose labels the query does not read: ranking, toxic ones found, clean ones left alone."""
    from strata.llm import queries
    sf = "/root/testdata/sf0.01"
    scored = queries.op4_toxicity(spark, sf).filter("held_out")
    labels = spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", "toxic").filter("toxic IS NOT NULL")
    rows = scored.join(labels, "doc_id").select("score", "predicted", "toxic").collect()
    good, bad = [r.score for r in rows if r.toxic == 0], [r.score for r in rows if r.toxic == 1]
    assert len(good) > 50 and len(bad) > 10
    auc = np.mean([(b > g) + 0.5 * (b == g) for b in bad for g in good])
    assert auc >= 0.85
    assert np.mean([r.predicted for r in rows if r.toxic == 1]) >= 0.7
    assert np.mean([r.predicted for r in rows if r.toxic == 0]) <= 0.02
