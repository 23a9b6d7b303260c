"""Operator 4: toxicity by a weighted finite-state pattern grammar.

A text is cut into clauses; each clause runs through a composition of five
small transducers over its words:

* INSULT and THREAT map words to marks with weights (word forms and stems);
* TARGET maps second-person words and copulas, and raises the next mark;
* NEGATION and REPORT map their words and open a scope of ``SCOPE`` words, in
  which a mark comes out as negated or reported instead of plain.

The composed machine is a table (state, word class) -> (state, output), where
the state holds the remaining scopes.  A matched clause gives the sum of its
mark weights per kind of output; the document score is a logistic function of
the kinds' sums over all clauses, so isolated words outside the grammar count
nothing and long texts are not diluted.

What is learned: insult words and stems that the fixed list lacks, from the
labelled training texts (``learn_terms``), and the weights of the kinds (``fit``).
Both use at most ``MAX_ROWS`` labelled rows, the first by a hash of the id;
that bound is a parameter and the only sample.  Scoring reads whole texts.
Score inputs are the text alone: label, language, source and id are not.

Defined results: a null or empty text scores like a text without a match; a
repeated row gets a repeated score; labels that are null are not trained on, a
text with several labels counts with each; without any training rows, or with one
class only, the fixed lists and start weights are used.
"""
from __future__ import annotations

import math
import re
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, StructField, StructType

MAX_ROWS = 20_000       # labelled rows used for learning
MAX_TERMS = 2_000       # candidate terms that may reach the driver
EVIDENCE = 14.0         # a term's log likelihood ratio against chance: one in a million
STEM = (4, 8)           # lengths of stems that are tried
SCOPE = 4               # words that a negation or a reporting verb governs
THRESHOLD = 0.7

# Fixed word lists (common public vocabulary), by language.
INSULTS = ("idiot", "idiots", "moron", "morons", "stupid", "loser", "losers", "scum", "trash", "clown", "pathetic",
           "worthless", "disgusting", "imbecile", "scumbag", "dumbass", "bastard", "asshole",
           "dummkopf", "trottel", "arschloch", "abschaum", "widerlich", "erbärmlich", "wertlos", "versager", "schwachkopf",
           "imbécile", "connard", "connasse", "crétin", "ordure", "minable", "abruti", "salaud", "dégoûtant",
           "idiota", "imbécil", "estúpido", "estúpida", "basura", "payaso", "escoria", "patético", "inútil", "asqueroso")
THREATS = ("i will kill you", "i will hurt you", "i will find you", "kill yourself", "you will die", "you will regret", "watch your back",
           "ich bringe dich um", "ich töte dich", "bring dich um", "je vais te tuer", "je te tuerai", "va mourir",
           "te voy a matar", "te mataré", "vas a morir", "muérete")
TARGETS = ("you", "your", "you're", "youre", "u", "du", "dich", "dir", "dein", "deine", "ihr", "euch", "tu", "toi", "te", "vous", "votre", "ton",
           "tú", "ti", "usted", "ustedes", "vosotros", "su")
NEGATIONS = ("not", "never", "isn't", "aren't", "wasn't", "nobody", "nicht", "kein", "keine", "keiner", "nie", "pas", "jamais", "aucun",
             "nunca", "ningún", "jamás", "tampoco")
REPORTS = ("said", "says", "wrote", "claimed", "quoted", "reported", "called", "sagte", "schrieb", "behauptete", "nannte",
           "disait", "écrit", "prétend", "appelé", "dijo", "escribió", "afirmó", "llamó")

CLAUSE = re.compile(r"[^.!?;:\n]+")
TOKEN = re.compile(r"[\w']+")
KINDS = ("insult", "insult_at_target", "threat", "negated", "reported")
START_WEIGHTS = np.array([3.0, 3.5, 4.0, 0.5, 0.8, -4.0])  # the kinds, then the constant
OTHER, INSULT, THREAT, TARGET, NEGATION, REPORT = range(6)


@dataclass(frozen=True)
class Grammar:
    """Weighted terms by class; stems match any word that begins with them."""

    words: dict[str, float] = field(default_factory=lambda: dict.fromkeys(INSULTS, 1.0))
    stems: dict[str, float] = field(default_factory=dict)
    weights: tuple[float, ...] = tuple(START_WEIGHTS)


def compose() -> dict[tuple[tuple[int, int, int], int], tuple[tuple[int, int, int], str | None]]:
    """The composed transducer: ((negation, report, target scopes), word class) -> (next scopes, output kind)."""
    table = {}
    for negated in range(SCOPE + 1):
        for reported in range(2):  # a reporting verb governs the rest of its clause
            for target in range(SCOPE + 1):
                for word in range(6):
                    after = (SCOPE if word == NEGATION else max(negated - 1, 0), 1 if word == REPORT else reported,
                             SCOPE if word == TARGET else max(target - 1, 0))
                    kind = None
                    if word in (INSULT, THREAT):
                        kind = ("reported" if reported else "negated" if negated else "threat" if word == THREAT
                                else "insult_at_target" if target else "insult")
                    table[(negated, reported, target), word] = (after, kind)
    return table


class Machine:
    """A grammar made ready for whole texts: an automaton finds clauses with a mark, the transducer runs over those."""

    def __init__(self, grammar: Grammar):
        self.grammar = grammar
        self.table = compose()
        self.classes = {**dict.fromkeys(TARGETS, TARGET), **dict.fromkeys(NEGATIONS, NEGATION), **dict.fromkeys(REPORTS, REPORT)}
        self.threats = {tuple(TOKEN.findall(t)) for t in THREATS}
        self.find = ahocorasick.Automaton()
        for term in {*grammar.words, *grammar.stems, *(t.split()[0] for t in THREATS)}:
            self.find.add_word(term, term)
        self.find.make_automaton()
        self.known: dict[str, tuple[int, float]] = {}

    def classify(self, word: str) -> tuple[int, float]:
        got = self.known.get(word)
        if got is None:
            weight = self.grammar.words.get(word)
            if weight is None:
                weight = next((self.grammar.stems[word[:n]] for n in range(STEM[1], STEM[0] - 1, -1) if word[:n] in self.grammar.stems), None)
            got = (self.classes.get(word, OTHER), 0.0) if weight is None else (INSULT, weight)
            if len(self.known) > 100_000:
                self.known.clear()
            self.known[word] = got
        return got

    def clause(self, text: str, sums: list[float]) -> None:
        tokens, state = TOKEN.findall(text), (0, 0, 0)
        skip = 0
        for i, token in enumerate(tokens):
            word, weight = self.classify(token)
            if skip:
                skip -= 1
                continue
            for threat in self.threats:
                if threat[0] == token and tuple(tokens[i:i + len(threat)]) == threat:
                    word, weight, skip = THREAT, 1.0, len(threat) - 1
                    break
            state, kind = self.table[state, word]
            if kind:
                sums[KINDS.index(kind)] += weight

    def sums(self, text: str | None) -> list[float]:
        """Weights per kind over all matched clauses of a whole text."""
        out = [0.0] * len(KINDS)
        if not text:
            return out
        text = text.lower()
        done = -1
        for end, _ in self.find.iter(text):
            if end <= done:
                continue
            begin = max(text.rfind(c, 0, end + 1) for c in ".!?;:\n") + 1
            match = CLAUSE.match(text, begin)
            if match and match.end() > end:
                done = match.end() - 1
                self.clause(match.group(), out)
        return out

    def score(self, sums: list[float]) -> float:
        w = self.grammar.weights
        x = sum(a * math.log1p(b) for a, b in zip(w, sums, strict=False)) + w[-1]
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, x))))


def sample(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS) -> DataFrame:
    """(text, toxic) of at most ``max_rows`` rows of ``labels`` (doc_id, toxic), those of the smallest id hashes.

    The chosen label rows are few by that bound, so the join broadcasts them and
    the texts stay where they are.
    """
    labels = labels.filter(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull())
    n = labels.count()
    span = 1 << 32
    share = span if n <= max_rows else int(span * 0.95 * max_rows / n)
    few = labels.filter(F.pmod(F.xxhash64("doc_id"), F.lit(span)) < share).select("doc_id", "toxic").limit(max_rows)
    return docs.filter(F.col("text").isNotNull()).join(F.broadcast(few), "doc_id").select("text", F.col("toxic").cast("int").alias("toxic"))


def _stem(n: int):
    return lambda w: F.struct(F.substring(w, 1, n).alias("term"), F.lit(True).alias("stem"))


def learn_terms(texts: DataFrame, max_terms: int = MAX_TERMS) -> tuple[dict[str, float], dict[str, float]]:
    """Insult words and stems that mark toxic texts far beyond chance and are needed to explain them.

    Texts that share the smallest hash of their words (near copies mostly do)
    count as one.  Candidates are counted by Spark; of those that pass
    ``EVIDENCE`` a greedy cover keeps the ones that explain toxic texts which
    no stronger term has explained twice.
    """
    tokens = texts.select("toxic", F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(r"([\p{L}']{3,})"), F.lit(1))).alias("t"))
    tokens = tokens.filter(F.size("t") > 0).withColumn("group", F.array_min(F.transform("t", lambda w: F.xxhash64(w))))
    tokens = tokens.dropDuplicates(["group", "toxic"])
    vocabulary = tokens.select("toxic", F.explode("t").alias("word")).groupBy("word").agg(
        F.sum("toxic").alias("a"), F.sum(1 - F.col("toxic")).alias("b"))
    base = tokens.agg(F.sum("toxic").alias("a"), F.sum(1 - F.col("toxic")).alias("b")).first()
    if not base.a or not base.b:
        return {}, {}
    forms = [F.array(F.struct(F.col("word").alias("term"), F.lit(False).alias("stem")))] + [
        F.when(F.length("word") > n, F.array(_stem(n)(F.col("word")))).otherwise(F.array().cast("array<struct<term:string,stem:boolean>>"))
        for n in range(STEM[0], STEM[1] + 1)]
    counted = vocabulary.select("a", "b", F.explode(F.concat(*forms)).alias("x")).groupBy("x.term", "x.stem").agg(
        F.sum("a").alias("a"), F.sum("b").alias("b"))
    prior = base.a / (base.a + base.b)
    share = F.col("a") / (F.col("a") + F.col("b"))
    gain = F.col("a") * F.log(share / prior) + F.when(F.col("b") > 0, F.col("b") * F.log((1 - share) / (1 - prior))).otherwise(0.0)
    strong = counted.filter(F.col("a") > 0).filter(share > 0.8).withColumn("gain", gain).filter(F.col("gain") >= EVIDENCE)
    chosen = strong.orderBy(F.col("gain").desc(), F.length("term").desc(), "term", "stem").limit(max_terms).collect()
    if not chosen:
        return {}, {}
    # which toxic texts each candidate occurs in (the sample is bounded, and so is this)
    where = defaultdict(set)
    names = {(c.term, c.stem): c for c in chosen}
    for n, row in enumerate(tokens.filter("toxic = 1").select("t").toLocalIterator()):
        for word in row.t:
            if (word, False) in names:
                where[word, False].add(n)
            for size in range(STEM[0], min(STEM[1], len(word) - 1) + 1):
                if (word[:size], True) in names:
                    where[word[:size], True].add(n)
    def evidence(key: tuple[str, bool]) -> float:  # with texts counted once, however many of their words a stem matches
        a, b = len(where[key]), names[key].b
        return a * math.log(a / (a + b) / prior) + (b * math.log(b / (a + b) / (1 - prior)) if b else 0.0)

    left = {k: rows for k, rows in where.items() if evidence(k) >= EVIDENCE}
    # texts with a word of the fixed list are explained already
    need, kept = defaultdict(lambda: 1, {i: 0 for word in INSULTS for i in where.get((word, False), ())}), []
    while left:
        value = {k: sum(need[i] > 0 for i in rows) for k, rows in left.items()}
        best = max(left, key=lambda k: (value[k], len(k[0]), k))
        if value[best] < 3:
            break
        kept.append(best)
        for i in left.pop(best):
            need[i] = max(0, need[i] - 1)
    return ({t: 1.0 for t, stem in kept if not stem}, {t: 1.0 for t, stem in kept if stem})


def fit(texts: DataFrame) -> Grammar:
    """Terms and kind weights from the (text, toxic) rows of a bounded sample, which is read several times."""
    words, stems = learn_terms(texts)
    grammar = Grammar(words=dict.fromkeys(INSULTS, 1.0) | words, stems=stems)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = Machine(grammar)
        for batch in batches:
            found = [machine.sums(t) for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.list_(pa.float64())), batch.column(1)], names=["sums", "toxic"])

    rows = texts.select("text", "toxic").mapInArrow(run, "sums array<double>, toxic int").collect()
    y = np.array([r.toxic for r in rows], dtype=float)
    if not len(y) or y.min() == y.max():
        return grammar
    x = np.column_stack([np.log1p(np.array([r.sums for r in rows])), np.ones(len(y))])
    weight = np.where(y == 1, 0.5 / y.sum(), 0.5 / (len(y) - y.sum())) * len(y)
    w = START_WEIGHTS.copy()
    for _ in range(300):  # damped Newton steps of logistic regression, drawn towards the start weights
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (weight * (p - y)) + 1.0 * (w - START_WEIGHTS)
        hessian = (x * (weight * p * (1 - p))[:, None]).T @ x + 1.0 * np.eye(len(w))
        step = np.linalg.solve(hessian, gradient)
        w -= step * min(1.0, 2.0 / max(1e-9, np.abs(step).max()))
        if np.abs(step).max() < 1e-6:
            break
    w[:-1] = np.maximum(w[:-1], 0.0)
    return Grammar(grammar.words, grammar.stems, tuple(float(v) for v in w))


def score(df: DataFrame, grammar: Grammar, text: str = "text", keys: tuple[str, ...] = ("doc_id",), within: str | None = None) -> DataFrame:
    """The key columns, then score, predicted and the sums per kind, for every row.

    ``within`` names the key, a whole row in a struct, whose field ``text`` is read; the text is then sent to Python once.
    """
    rows = df.select(*[F.col(f"`{k}`").alias(f"__{i}") for i, k in enumerate(keys)], *([] if within else [F.col(f"`{text}`").alias("__text")]))
    at = keys.index(within) if within else len(keys)
    part = [f.lower() for f in df.schema[within].dataType.names].index(text.lower()) if within else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = Machine(grammar)
        for whole in batches:
            for start in range(0, whole.num_rows, 512):  # what goes back is held in the JVM a batch at a time
                batch = whole.slice(start, 512)
                texts = batch.column(at) if part is None else batch.column(at).field(part)
                found = [machine.sums(t.as_py()) for t in texts]
                scores = [machine.score(f) for f in found]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(i) for i in range(len(keys))]
                    + [pa.array(scores, pa.float64()), pa.array([int(s >= THRESHOLD) for s in scores], pa.int32()),
                       pa.array(found, pa.list_(pa.float64()))],
                    names=[f"__{i}" for i in range(len(keys))] + ["score", "predicted", "kind_sums"])

    schema = StructType([StructField(f"__{i}", df.schema[k].dataType) for i, k in enumerate(keys)] + [
        StructField("score", DoubleType()), StructField("predicted", IntegerType()), StructField("kind_sums", ArrayType(DoubleType()))])
    out = rows.mapInArrow(run, schema)
    return out.select(*[F.col(f"__{i}").alias(k) for i, k in enumerate(keys)], "score", "predicted", "kind_sums")
