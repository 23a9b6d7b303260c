"""Operator 10: masked pseudo-likelihood by a bidirectional window network trained in numpy.

Every token is predicted from the ``WINDOW`` tokens on either side, itself left
out; a document's score is the sum of the conditional log-probabilities of all
its tokens.  The network has one embedding table per context place, a hidden
layer, and an output in two steps (class of the token, token in its class), so a
token costs 2 * sqrt(V) outputs instead of V.

Everything learned comes from the whole corpus, and grows with it:

* ``word_counts``: every word counted over all documents, a Spark table with a
  row per distinct word;
* ``vocabulary``: the most frequent words get a token of the network each, all
  others share one class of tokens by hash; the number of classes, and of tokens
  in a class, grows with the fourth root of the distinct words (``side``, 32 to 256);
* a word without a token of its own costs the log-probability of its shared
  token plus log(count of the word / count of all words that share the token), so
  every distinct word has a probability of its own and those of a shared token's
  words sum to the token's.  The ``MAPPED`` most frequent words carry their costs
  into the tasks; what is rarer is joined to the table of counts by word;
* ``train``: documents are dealt by hash into lanes of about ``LANE_WORDS`` words
  and ordered by hash within a lane.  In each of ``ROUNDS`` rounds every lane
  takes Adagrad steps over its documents of that round, starting from the common
  weights; the lanes' weights are averaged by tokens seen, piece by piece and in
  two levels, so no task and not the driver gets all lanes' weights.  Each
  document trains exactly once.  Lanes come from the data alone, so scores are
  the same for any layout of the table and any number of tasks.

Only the weights, the vocabulary, the mapped words and the counts of the shared
tokens (of bounded size) reach the driver and go out again.

Defined results: null and empty texts have no tokens, log-likelihood 0 and a
null mean; repeated rows get equal scores; with an empty table, or without any
word, the weights stay as they began.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import ArrayType, BinaryType, DoubleType, LongType, StructField, StructType

from strata.llm.common import cut, words

WINDOW = 2
HIDDEN = 16
ROUNDS = 2
BATCH = 8192
RATE = 0.1
PIECE = 4096                   # weights of a piece when they are averaged
PLACES = 2 * WINDOW
LANE_WORDS = 2_000_000         # words of the documents that one lane trains on
MAPPED = 1 << 18               # most frequent words whose costs tasks hold
UNITS = 1 << 32                # rare words' costs are summed in whole units, so that no order of rows shows in a score
DIGITS = 4                     # of a document's log-likelihood; matrix products differ in the last bits with their shapes


def token_hashes(text: F.Column) -> F.Column:
    """64-bit hashes of the lower-cased words of a text."""
    return F.transform(words(F.lower(text)), lambda w: F.xxhash64(w))


def word_counts(hashed: DataFrame) -> DataFrame:
    """(word, n): how often each distinct word occurs over all rows of ``hashed`` (column h)."""
    each = hashed.select(F.explode_outer("h").alias("word")).filter("word IS NOT NULL")  # a plain explode would hash all words once more, to filter by
    return each.groupBy("word").agg(F.count(F.lit(1)).alias("n"))


def side(distinct: int) -> int:
    """Classes, and tokens per class: a power of two about the fourth root of the distinct words, 32 to 256."""
    return 1 << min(8, max(5, (max(1, distinct).bit_length() - 1) // 4))


def shared_token(word: F.Column, classes: int) -> F.Column:
    """Which token of the last class a word outside the vocabulary has, as in ``Lookup.ids``."""
    return F.shiftright(word, 32).bitwiseAND(F.lit(classes - 1)).cast("int")


class Words:
    """What tasks need of the corpus' words: tokens of the vocabulary, costs of the mapped words."""

    def __init__(self, frequent: np.ndarray, counts: np.ndarray, totals: np.ndarray, classes: int):
        known = classes * (classes - 1)
        self.totals = totals
        self.lookup = Lookup(frequent[:known], classes)
        order = np.argsort(frequent, kind="stable")
        self.mapped = frequent[order]
        token = (frequent >> 32) & (classes - 1)
        cost = np.log(counts / np.maximum(1, totals)[token]) if len(frequent) else np.empty(0)
        self.costs = np.where(np.arange(len(frequent)) < known, 0, np.round(cost * UNITS)).astype(np.int64)[order]

    def read(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Token ids, costs in UNITS (0 for words with a token of their own), and which words are not mapped."""
        ids = self.lookup.ids(hashes)
        costs, others = np.zeros(len(hashes), np.int64), np.zeros(len(hashes), bool)
        rare = np.nonzero(ids >= self.lookup.classes * (self.lookup.classes - 1))[0]  # words with a token of their own cost nothing more
        others[rare] = True
        if len(self.mapped):
            wanted = hashes[rare]
            at = np.minimum(np.searchsorted(self.mapped, wanted), len(self.mapped) - 1)
            hit = self.mapped[at] == wanted
            costs[rare[hit]], others[rare[hit]] = self.costs[at[hit]], False
        return ids, costs, others


def frequent_words(counts: DataFrame, classes: int) -> Words:
    """From the table of counts: at most MAPPED rows and one per shared token reach the driver.

    Words are mapped by classes of about equal counts, the most frequent classes first, as far as whole classes fit;
    where those hold fewer words than the network has tokens for, the next ones by count and hash complete them.
    """
    rank = F.floor(F.log2("n") * 16)
    sizes = counts.groupBy(rank.alias("rank")).agg(F.count(F.lit(1)).alias("many")).orderBy(F.desc("rank")).collect()  # at most 1,024 classes
    held, least = 0, None
    for r in sizes:
        if held + r.many > MAPPED:
            break
        held, least = held + r.many, r["rank"]
    known = classes * (classes - 1)
    some = counts.filter(rank >= least) if least is not None else counts.limit(0)
    if held < known:  # equal counts throughout
        some = counts.orderBy(F.col("n").desc(), "word").limit(known)
    rows = some.toPandas().sort_values(["n", "word"], ascending=[False, True])
    frequent, n = rows["word"].to_numpy(np.int64), rows["n"].to_numpy(np.int64)
    totals = np.zeros(classes, np.int64)
    for r in counts.groupBy(shared_token(F.col("word"), classes).alias("token")).agg(F.sum("n").alias("total")).collect():
        totals[r.token] = r.total
    own = frequent[:classes * (classes - 1)]
    np.subtract.at(totals, (own >> 32) & (classes - 1), n[:len(own)])  # words of the vocabulary share no token
    return Words(frequent, n, totals, classes)


class Lookup:
    """Word hashes to token ids through a table without collisions."""

    def __init__(self, known: np.ndarray, classes: int):
        self.known, self.classes = known, classes
        bits = 12
        while len(np.unique(known & ((1 << bits) - 1))) < len(known):
            bits += 1
        self.mask = (1 << bits) - 1
        self.table = np.zeros(1 << bits, dtype=np.int32)
        self.table[known & self.mask] = np.arange(len(known), dtype=np.int32)

    def ids(self, hashes: np.ndarray) -> np.ndarray:
        other = (self.classes * (self.classes - 1) + ((hashes >> 32) & (self.classes - 1))).astype(np.int32)
        if not len(self.known):
            return other
        found = self.table[hashes & self.mask]
        return np.where(self.known[found] == hashes, found, other)


def highest(x: np.ndarray) -> np.ndarray:
    """The largest value of each row as a column, by halves: numpy is slow at many short rows."""
    while x.shape[1] > 1 and x.shape[1] % 2 == 0:
        half = x.shape[1] // 2
        x = np.maximum(x[:, :half], x[:, half:])
    return x.max(axis=1, keepdims=True)


def log_softmax_at(x: np.ndarray, columns: np.ndarray) -> np.ndarray:
    """One column of each row's log-softmax; overwrites ``x``."""
    x -= highest(x)
    own = x[np.arange(len(x)), columns]
    return own - np.log(np.exp(x, out=x).sum(axis=1))


class Network:
    """Weights: one table per place (a further row for the text's edge), hidden bias, class outputs, outputs per class."""

    def __init__(self, classes: int, flat: np.ndarray | None = None, dtype=np.float32):
        self.classes_n, tokens = classes, classes * classes
        self.edge = tokens
        shapes = (("tables", (PLACES, tokens + 1, HIDDEN)), ("bias", (HIDDEN,)), ("classes", (HIDDEN, classes)), ("class_bias", (classes,)),
                  ("members", (classes, HIDDEN, classes)), ("member_bias", (classes, classes)))
        sizes = [int(np.prod(shape)) for _, shape in shapes]
        if flat is None:
            rng = np.random.default_rng(10)
            flat = rng.normal(0, 0.1, sum(sizes))
        self.flat = np.array(flat, dtype=dtype)
        at = 0
        for (name, shape), size in zip(shapes, sizes, strict=True):
            setattr(self, name, self.flat[at:at + size].reshape(shape))
            at += size

    def contexts(self, ids: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """(PLACES, n) ids around each token; ``edge`` stands for beyond the text."""
        n = len(ids)
        doc = np.repeat(np.arange(len(lengths)), lengths)
        out = np.full((PLACES, n), self.edge, dtype=np.int32)
        for place, shift in enumerate([*range(-WINDOW, 0), *range(1, WINDOW + 1)]):
            k = abs(shift)
            if n <= k:
                continue
            same = doc[k:] == doc[:-k]
            if shift < 0:
                out[place, k:][same] = ids[:-k][same]
            else:
                out[place, :-k][same] = ids[k:][same]
        return out

    def hidden(self, context: np.ndarray) -> np.ndarray:
        total = self.tables[0][context[0]]
        for place in range(1, PLACES):
            total += self.tables[place][context[place]]
        total += self.bias
        return np.tanh(total, out=total)

    @staticmethod
    def _log_softmax(x: np.ndarray) -> np.ndarray:
        x -= highest(x)
        x -= np.log(np.exp(x).sum(axis=1, keepdims=True))
        return x

    def log_probabilities(self, ids: np.ndarray, context: np.ndarray) -> np.ndarray:
        out = np.empty(len(ids), dtype=np.float32)
        for at in range(0, len(ids), 65536):
            own = ids[at:at + 65536]
            h = self.hidden(context[:, at:at + 65536])
            cls = own // self.classes_n
            part = log_softmax_at(h @ self.classes + self.class_bias, cls)
            order = np.argsort(cls.astype(np.int16), kind="stable")
            ends = np.searchsorted(cls[order], np.arange(self.classes_n + 1))
            for c in range(self.classes_n):
                rows = order[ends[c]:ends[c + 1]]
                if len(rows):
                    part[rows] += log_softmax_at(h[rows] @ self.members[c] + self.member_bias[c], own[rows] % self.classes_n)
            out[at:at + 65536] = part
        return out

    def step(self, ids: np.ndarray, context: np.ndarray, grown: "Network") -> None:
        """One Adagrad step on the mean log-loss of the given tokens; ``grown`` holds the squared gradients."""
        for name, rows, gradient in self.gradients(ids, context):
            self._move(name, rows, gradient, grown)

    def gradients(self, ids: np.ndarray, context: np.ndarray) -> list[tuple[str, object, np.ndarray]]:
        """(weights, index into them, gradient) of the mean log-loss, for all weights that the tokens touch."""
        n = len(ids)
        h = self.hidden(context)
        cls = ids // self.classes_n
        line = np.arange(n)
        d = np.exp(self._log_softmax(h @ self.classes + self.class_bias))
        d[line, cls] -= 1
        d /= n
        back = d @ self.classes.T
        moves = [("classes", ..., h.T @ d), ("class_bias", ..., d.sum(axis=0))]
        order = np.argsort(cls.astype(np.int16), kind="stable")
        ends = np.searchsorted(cls[order], np.arange(self.classes_n + 1))
        members, member_bias = np.zeros_like(self.members), np.zeros_like(self.member_bias)
        for c in range(self.classes_n):
            rows = order[ends[c]:ends[c + 1]]
            if len(rows):
                own = h[rows]
                e = np.exp(self._log_softmax(own @ self.members[c] + self.member_bias[c]))
                e[np.arange(len(rows)), ids[rows] % self.classes_n] -= 1
                e /= n
                back[rows] += e @ self.members[c].T
                members[c], member_bias[c] = own.T @ e, e.sum(axis=0)
        back *= 1 - h * h
        moves += [("members", ..., members), ("member_bias", ..., member_bias), ("bias", ..., back.sum(axis=0))]
        for place in range(PLACES):
            at = np.argsort(context[place].astype(np.uint16 if self.edge < 1 << 16 else np.int32), kind="stable")
            sorted_ids = context[place][at]
            starts = np.nonzero(np.concatenate([[True], sorted_ids[1:] != sorted_ids[:-1]]))[0]
            rows = sorted_ids[starts]
            moves.append(("tables", (place, rows), np.add.reduceat(back[at], starts, axis=0)))
        return moves

    def _move(self, name: str, rows, gradient: np.ndarray, grown: "Network") -> None:
        squared, weights = getattr(grown, name), getattr(self, name)
        squared[rows] += gradient * gradient
        weights[rows] -= RATE * gradient / np.sqrt(squared[rows])


def _runs(tokens: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of rows with at most about a million tokens: (first row, rows, ids, lengths)."""
    sizes = np.fromiter((len(t) // 2 for t in tokens.to_pylist()), np.int64, len(tokens))
    at = 0
    while at < len(sizes):
        size = max(1, int(np.searchsorted(np.cumsum(sizes[at:]), 1 << 20)))
        ids = np.frombuffer(b"".join(tokens.slice(at, size).to_pylist()), "<u2").astype(np.int32)
        yield at, size, ids, sizes[at:at + size]
        at += size


def _average(pdf: pd.DataFrame) -> pd.DataFrame:
    pdf = pdf.sort_values("lane")  # sums of floats depend on their order
    weight = pdf["tokens"].to_numpy(dtype=np.float64)
    mean = np.average(np.stack(pdf["w"].to_numpy()).astype(np.float64), axis=0, weights=weight)
    return pd.DataFrame({"piece": [pdf["piece"].iloc[0]], "lane": [pdf["lane"].iloc[0]], "tokens": [float(weight.sum())], "w": [mean]})


def train(spark: SparkSession, rows: DataFrame, classes: int, lanes: int) -> np.ndarray:
    """Weights after ROUNDS rounds over all rows (place, tokens); ``place`` is a hash of the row."""
    flat = Network(classes).flat
    schema = "piece int, lane long, tokens double, w array<double>"
    for turn in range(ROUNDS):
        sent = spark.sparkContext.broadcast(flat)  # the model, of bounded size

        def run(key: tuple[pa.Scalar, ...], lane: pa.Table) -> pa.Table:
            lane = lane.sort_by([("place", "ascending"), ("tokens", "ascending")]).combine_chunks()
            network, grown = Network(classes, sent.value), Network(classes, np.full(len(sent.value), 1e-8))
            seen = 0
            for _, _, ids, lengths in _runs(lane.column("tokens").combine_chunks()):
                context = network.contexts(ids, lengths)
                for at in range(0, len(ids), BATCH):
                    network.step(ids[at:at + BATCH], context[:, at:at + BATCH], grown)
                seen += len(ids)
            parts = [network.flat[k:k + PIECE].astype(np.float64) for k in range(0, len(network.flat), PIECE)] if seen else []
            return pa.table({"piece": pa.array(range(len(parts)), pa.int32()), "lane": pa.array([key[0].as_py()] * len(parts), pa.int64()),
                             "tokens": pa.array([float(seen)] * len(parts), pa.float64()), "w": pa.array(parts, pa.list_(pa.float64()))})

        mine = rows.filter(F.pmod(F.col("place"), F.lit(ROUNDS)) == turn)
        dealt = mine.withColumn("lane", F.pmod(F.shiftright("place", 8), F.lit(lanes)))
        trained = dealt.groupBy("lane").applyInArrow(run, schema)
        some = trained.groupBy("piece", F.shiftright("lane", 6)).applyInPandas(_average, schema)
        whole = some.groupBy("piece").applyInPandas(_average, schema).orderBy("piece").collect()  # the weights
        if whole:
            flat = np.concatenate([np.array(r.w) for r in whole]).astype(np.float32)
        sent.unpersist()
    return flat


def tokenized(spark: SparkSession, hashed: DataFrame, words_known: Words) -> DataFrame:
    """(__row, __key, place, tokens, n_tokens, mapped, others): token ids as 16-bit integers, costs of mapped words, hashes of the other rare ones."""
    sent = spark.sparkContext.broadcast(words_known)  # of bounded size
    kind = hashed.schema["__key"].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = sent.value
        for batch in batches:
            h = batch.column(2)
            ends = h.offsets.to_numpy()
            flat = h.values.to_numpy(zero_copy_only=False)[ends[0]:ends[-1]]
            ends = ends - ends[0]
            ids, costs, others = known.read(flat)
            data = ids.astype("<u2").tobytes()
            tokens = [data[2 * x:2 * y] for x, y in zip(ends[:-1].tolist(), ends[1:].tolist())]
            sums = np.concatenate([[0], np.cumsum(costs)])
            left = np.concatenate([[0], np.cumsum(others)])[ends]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(tokens, pa.binary()), pa.array(np.diff(ends).astype(np.int64)),
                 pa.array(sums[ends[1:]] - sums[ends[:-1]]), pa.ListArray.from_arrays(pa.array(left.astype(np.int32)), pa.array(flat[others]))],
                ["__key", "place", "tokens", "n_tokens", "mapped", "others"])

    schema = StructType([StructField("__key", kind), StructField("place", LongType()), StructField("tokens", BinaryType()),
                         StructField("n_tokens", LongType()), StructField("mapped", LongType()), StructField("others", ArrayType(LongType()))])
    out = hashed.select("__key", F.xxhash64("__key", "h").alias("place"), "h").mapInArrow(run, schema)
    return out.withColumn("__row", F.monotonically_increasing_id())


def score(spark: SparkSession, df: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(key, n_tokens, log_likelihood, mean_log_probability) for every row, by a network trained on all rows of ``df``."""
    hashed = df.select(F.col(f"`{key}`").alias("__key"), token_hashes(F.col(f"`{text}`")).alias("h"))
    counts = cut(spark, word_counts(hashed), "lm-counts")
    total, distinct = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    classes = side(distinct)
    known = frequent_words(counts, classes)
    rows = cut(spark, tokenized(spark, hashed, known), "lm-tokens")  # row numbers are now data and cannot change
    flat = train(spark, rows.filter("n_tokens > 0").select("place", "tokens"), classes, -(-total // LANE_WORDS) or 1)
    sent = spark.sparkContext.broadcast(flat)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        network = Network(classes, sent.value)
        for batch in batches:
            for at, size, ids, lengths in _runs(batch.column(4)):
                logs = network.log_probabilities(ids, network.contexts(ids, lengths)).astype(np.float64)
                ends = np.concatenate([[0], np.cumsum(lengths)]).tolist()
                # each text's own sum: differences of running sums would depend on the texts before it
                sums = np.array([logs[x:y].sum() for x, y in zip(ends[:-1], ends[1:])])
                yield pa.RecordBatch.from_arrays([batch.column(i).slice(at, size) for i in range(4)] + [pa.array(sums)],
                                                 names=["__key", "__row", "n_tokens", "mapped", "sums"])

    kind = df.schema[key].dataType
    schema = StructType([StructField("__key", kind), StructField("__row", LongType()), StructField("n_tokens", LongType()),
                         StructField("mapped", LongType()), StructField("sums", DoubleType())])
    scored = rows.select("__key", "__row", "n_tokens", "mapped", "tokens").mapInArrow(run, schema)
    other = rows.select("__row", F.explode("others").alias("word")).join(counts, "word")
    total_of = F.element_at(F.array(*[F.lit(int(t)) for t in known.totals]), shared_token(F.col("word"), classes) + 1)
    costs = other.select("__row", F.round(F.log(F.col("n") / total_of) * UNITS).cast("long").alias("cost")).groupBy("__row").agg(F.sum("cost").alias("joined"))
    units = F.col("mapped") + F.coalesce("joined", F.lit(0))
    whole = scored.join(costs, "__row", "left").withColumn("log_likelihood", F.round(F.col("sums") + units / F.lit(float(UNITS)), DIGITS))
    mean = F.when(F.col("n_tokens") > 0, F.col("log_likelihood") / F.col("n_tokens"))
    return whole.select(F.col("__key").alias(key), "n_tokens", "log_likelihood", mean.alias("mean_log_probability"))
