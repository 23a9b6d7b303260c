"""Operator 7: near-duplicates of word multisets by BagMinHash.

A text is the multiset of its five-word shingles (lower-cased words between
white space; shorter texts are one shingle).  Weights are the counts, taken
apart into levels 0, 1, 2, ...; the levels of a shingle lie in dyadic intervals
[0, 1), [1, 2), [2, 4), ..., and each (shingle, interval) is a Poisson process
over time whose points carry a signature component and a level inside the
interval, drawn by hierarchical splitting of the interval (the level's hash).  A
text takes the points whose level is below the shingle's count; component k is
the first point in time with mark k.  Equal components then have exactly the
probability of the multisets' weighted Jaccard similarity.  Points are made in
order of time and a process stops once its time passes the text's largest
component, so long texts need about one point per shingle.

Classes: exact copies collapse first (128-bit digest of the text).  ``BANDS``
bands of ``ROWS`` components put texts into buckets; each bucket links its
members to a leader, the member with the smallest key, after the multisets'
similarity has been computed (``SIMILARITY`` or more).  The leaders of a group
of near copies are the same in most bands, so a text meets a few of them only.
Buckets that then still hold several classes are compared in blocks: every
member outside the largest class against all members of other classes, by the
full signatures (a pair passes unless its estimate is ``SLACK`` standard
deviations short), and the multisets of what passes are compared on the spot.  So no cap limits a bucket, no
bucket is gathered whole, and no pairs within a class are listed.

Defined results: null and empty texts (no words) are in no class with others;
repeated rows are exact copies; the class id is the smallest doc_id of the
class (null if all are null); a null doc_id is an ordinary row of its class.
Ids may repeat over different texts, so the class itself is told by ``root``, a
text's digest, and never by ``class_id``.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import ArrayType, BinaryType, LongType, StructField, StructType

from strata.llm.common import BLANKS, again, batch_rows, cut, words
from strata.llm.components import components

SHINGLE = 5
SIMILARITY = 0.8
BANDS, ROWS = 24, 5
M = BANDS * ROWS
BLOCK = 1024
COMPARED_WORDS = 2_000_000  # of texts that are indexed together
SIGNED_TEXTS, SIGNED_WORDS = 256, 60_000  # signed together; signing holds some 200 bytes a word
BATCH_ROWS = 1000  # of texts that go to a Python worker at once
SLACK = 4.0
GOLD = np.uint64(0x9E3779B97F4A7C15)
LOW = np.uint64(2**40 - 1)


def _mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(text: F.Column) -> F.Column:
    """The 64-bit hashes of a text's lower-cased words; an empty array for null and for texts without words."""
    return F.transform(words(F.lower(text)), lambda w: F.xxhash64(w))


def shingles(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted 64-bit hashes of the shingles of a text (given as its words' hashes), and their counts."""
    size = min(SHINGLE, len(h))
    if not size:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    h = h.view(np.uint64)
    n = len(h) - size + 1
    out = h[:n] * GOLD  # so that a short text is no prefix of another
    out += np.uint64(size)
    for k in range(size):
        out *= GOLD
        out += h[k:k + n]
    out.sort()  # equal shingles become neighbours
    first = np.empty(n, dtype=bool)
    first[0] = True
    np.not_equal(out[1:], out[:-1], out=first[1:])
    if first.all():
        return out, np.ones(n, dtype=np.int64)
    at = np.nonzero(first)[0]
    return out[at], np.diff(at, append=n)


def overlap(one: tuple[np.ndarray, np.ndarray], two: tuple[np.ndarray, np.ndarray]) -> float:
    """Weighted Jaccard similarity of two multisets: sum of minima by sum of maxima."""
    total = int(one[1].sum() + two[1].sum())
    _, i, j = np.intersect1d(one[0], two[0], assume_unique=True, return_indices=True)
    both = int(np.minimum(one[1][i], two[1][j]).sum())
    return both / (total - both) if total else 0.0


def signatures(bags: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """(texts, M) identities of the first points; texts without shingles have a row of zeros."""
    n_docs = len(bags)
    doc = np.repeat(np.arange(n_docs), [len(b[0]) for b in bags])
    if not len(doc):
        return np.zeros((n_docs, M), dtype=np.uint64)
    element, count = np.concatenate([b[0] for b in bags]), np.concatenate([b[1] for b in bags])
    # one process per (shingle, dyadic interval that begins below the count)
    parts, low, j = [], 0, 0
    while True:
        held = np.nonzero(count > low)[0]
        if not len(held):
            break
        length = max(1, low)
        parts.append((doc[held], _mix(element[held] * GOLD + np.uint64(j + 1)), count[held],
                      np.full(len(held), low, np.int64), np.full(len(held), length, np.int64)))
        low, j = low + length, j + 1
    doc, seed, count, low, length = (np.concatenate(x) for x in zip(*parts, strict=True))
    rate, doc_at = -1.0 * M * length, doc * M
    best = np.full(n_docs * M, np.inf)
    name = np.zeros(n_docs * M, dtype=np.uint64)

    def points(at: np.ndarray, r: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Waiting times of the r-th points of the processes ``at``, and the points' identities."""
        ident = _mix(seed[at] + (r.astype(np.uint64) + np.uint64(1)) * GOLD)
        wait = np.log(((ident & LOW).astype(np.float64) + 0.5) * 2.0 ** -40) / rate[at]
        return wait, ident

    def offer(at: np.ndarray, time: np.ndarray, ident: np.ndarray) -> None:
        spot = doc_at[at] + (((ident >> np.uint64(40)) * np.uint64(M)) >> np.uint64(24)).astype(np.int64)
        wide = np.nonzero(length[at] > 1)[0]
        if len(wide):  # the level inside an interval of several
            mark = _mix(ident[wide] ^ np.uint64(0xD1B54A32D192ED03)) >> np.uint64(32)
            level = low[at[wide]] + ((mark * length[at[wide]].astype(np.uint64)) >> np.uint64(32)).astype(np.int64)
            taken = np.ones(len(at), dtype=bool)
            taken[wide] = level < count[at[wide]]
            spot, time, ident = spot[taken], time[taken], ident[taken]
        np.minimum.at(best, spot, time)
        first = best[spot] == time
        name[spot[first]] = ident[first]

    # first so many points of every process at once that all components of its text are likely met
    per_doc = np.bincount(doc, minlength=n_docs)
    many = np.maximum(1, np.ceil(0.6 * M * np.log(M) / np.maximum(per_doc, 1))).astype(np.int64)[doc]
    at = np.repeat(np.arange(len(doc)), many)
    starts = np.cumsum(many) - many
    r = np.arange(len(at)) - np.repeat(starts, many)
    wait, ident = points(at, r)
    time = np.cumsum(wait)
    time -= np.repeat(time[starts] - wait[starts], many)
    offer(at, time, ident)
    clock, r = time[starts + many - 1], many.copy()
    active = np.arange(len(doc))
    while True:
        top = best.reshape(n_docs, M).max(axis=1)
        active = active[clock[active] <= top[doc[active]]]
        if not len(active):
            break
        wait, ident = points(active, r[active])
        clock[active] += wait
        r[active] += 1
        offer(active, clock[active], ident)
    return name.reshape(n_docs, M)


def _signature_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    power = np.array([pow(0x9E3779B97F4A7C15, k + 1, 2**64) for k in range(ROWS)], dtype=np.uint64)
    for batch in batches:
        at, texts = 0, _arrays(batch.column(2))
        while at < batch.num_rows:
            size, length = 0, 0
            while at + size < batch.num_rows and size < SIGNED_TEXTS and length < SIGNED_WORDS:
                length += len(texts[at + size])
                size += 1
            bags = [shingles(h) for h in texts[at:at + size]]
            names = signatures(bags)
            banded = _mix((_mix(names).reshape(size, BANDS, ROWS) * power).sum(axis=2, dtype=np.uint64)).view(np.int64)
            sketch = (_mix(names ^ GOLD) & np.uint64(255)).astype(np.uint8)
            full = [len(b[0]) > 0 for b in bags]
            part = batch.slice(at, size)
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(1), pa.array([b if f else None for b, f in zip(banded, full, strict=True)], pa.list_(pa.int64())),
                 pa.array([s.tobytes() if f else None for s, f in zip(sketch, full, strict=True)], pa.binary())],
                names=["doc_id", "key", "bands", "sketch"])
            at += size


def _arrays(column: pa.Array) -> list[np.ndarray]:
    """The rows of an array<bigint> column as numpy views."""
    flat, ends = column.values.to_numpy(zero_copy_only=False), column.offsets.to_numpy()
    return [flat[a:b] for a, b in zip(ends[:-1], ends[1:], strict=True)]


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs (a, b, words of a, words of b) that reach SIMILARITY; the leader's multiset is kept between rows."""
    last, bag = None, None
    for batch in batches:
        a, b = batch.column(0), batch.column(1)
        one, two = _arrays(batch.column(2)), _arrays(batch.column(3))
        good = []
        for i in range(batch.num_rows):
            if b[i].as_py() != last:
                last, bag = b[i].as_py(), shingles(two[i])
            good.append(overlap(shingles(one[i]), bag) >= SIMILARITY)
        keep = pa.array(good, pa.bool_())
        yield pa.RecordBatch.from_arrays([a.filter(keep), b.filter(keep)], names=["a", "b"])


class _Postings:
    """Which of some multisets hold a shingle, and how often: one multiset is then compared with all of them at once."""

    def __init__(self, bags: list[tuple[np.ndarray, np.ndarray]]):
        elements, counts = np.concatenate([b[0] for b in bags]), np.concatenate([b[1] for b in bags])
        order = np.argsort(elements, kind="stable")
        self.owner, self.count = np.repeat(np.arange(len(bags)), [len(b[0]) for b in bags])[order], counts[order]
        self.elements, starts = np.unique(elements[order], return_index=True)
        self.ends = np.append(starts, len(elements))
        self.totals = np.array([int(b[1].sum()) for b in bags])

    def overlaps(self, bag: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
        """``overlap`` of ``bag`` with each multiset."""
        at = np.minimum(np.searchsorted(self.elements, bag[0]), len(self.elements) - 1)
        held = self.elements[at] == bag[0]
        at, own = at[held], bag[1][held]
        many = self.ends[at + 1] - self.ends[at]
        rows = np.repeat(self.ends[at] - (np.cumsum(many) - many), many) + np.arange(int(many.sum()))
        both = np.bincount(self.owner[rows], np.minimum(self.count[rows], np.repeat(own, many)), len(self.totals))
        return both / (self.totals + int(bag[1].sum()) - both)


def _compare(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
    """Links between two blocks of each bucket, or between the members of each of several small buckets."""
    out: list[tuple[bytes, bytes]] = []
    if len(left) and len(right):
        theirs = right.groupby(["band", "hash"], sort=False).indices
        for bucket, rows in left.groupby(["band", "hash"], sort=False).indices.items():
            if bucket in theirs:
                out += _links(bucket[0], left.iloc[rows], right.iloc[theirs[bucket]])
    return pd.DataFrame(out, columns=["a", "b"])


def _links(band: int, left: pd.DataFrame, right: pd.DataFrame) -> list[tuple[bytes, bytes]]:
    """Links between two blocks of one bucket across classes: signatures first, then the multisets themselves.

    A pair is looked at in the first band that its texts share, once if neither
    text is in the largest class; the links returned join the same classes as
    all links between the blocks do, without those inside a class already joined.
    """
    out = []
    one, two = (np.frombuffer(b"".join(x["sketch"]), np.uint8).reshape(-1, M) for x in (left, right))
    two = np.ascontiguousarray(two.T)
    shared, theirs = (np.array(x["bands"].tolist(), dtype=np.int64) for x in (left, right))
    front_l, front_r = (np.frombuffer(b"".join(k[:8] for k in x["key"]), ">u8") for x in (left, right))
    both_ways = (right["root"] == right["largest"]).to_numpy()
    labels = pd.factorize(pd.concat([left["root"], right["root"]]))[0]
    label_l, label_r = labels[:len(left)], labels[len(left):]
    least = M * (SIMILARITY - SLACK * (SIMILARITY * (1 - SIMILARITY) / M) ** 0.5)
    near: dict[int, np.ndarray] = {}
    for i in range(len(left)):
        alike = (two == one[i][:, None]).view(np.uint8).sum(axis=0, dtype=np.uint8)
        close = np.nonzero((alike >= least) & (label_r != label_l[i]) & (both_ways | (front_l[i] <= front_r)))[0]
        close = close[(theirs[close] == shared[i]).argmax(axis=1) == band]
        if len(close):
            near[i] = close
    needed = np.unique(np.concatenate(list(near.values()))) if near else np.empty(0, np.int64)
    lengths = np.cumsum([len(right["words"].iloc[k]) for k in needed])
    for part in np.split(needed, np.nonzero(np.diff(lengths // COMPARED_WORDS))[0] + 1) if len(needed) else []:
        index = _Postings([shingles(np.asarray(right["words"].iloc[k], dtype=np.int64)) for k in part])
        for i, close in near.items():
            close = close[np.isin(close, part, assume_unique=True)]
            close = close[label_r[close] != label_l[i]]
            if not len(close):
                continue
            alike = index.overlaps(shingles(np.asarray(left["words"].iloc[i], dtype=np.int64)))[np.searchsorted(part, close)]
            for k in close[alike >= SIMILARITY]:
                if label_r[k] != label_l[i]:
                    labels[labels == label_r[k]] = label_l[i]  # label_l and label_r are views
                    a, b = left["key"].iloc[i], right["key"].iloc[k]
                    out.append((max(a, b), min(a, b)))
    return out


def classes(spark: SparkSession, df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, key, class_id, root, lead, kept) for every row; key is the digest of the text (null without words).

    ``root`` is the key that names the class, ``lead`` the key of the text that stands for it: the
    smallest key under the smallest id (null if all ids are null).  Both are null without words.
    ``kept`` is true for one row of each class, also where rows are equal in id and text, and for rows without words.
    """
    body = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    rows = df.select(F.col(f"`{id_col}`").alias("doc_id"), F.unhex(F.md5(body)).alias("key"), word_hashes(body).alias("text"))
    schema = StructType([StructField("doc_id", df.schema[id_col].dataType), StructField("key", BinaryType()),
                         StructField("bands", ArrayType(LongType())), StructField("sketch", BinaryType())])
    signed = rows.mapInArrow(_signature_batches, schema).withColumn("row", F.monotonically_increasing_id())
    with batch_rows(spark, BATCH_ROWS):
        signed = cut(spark, signed, "minhash-signatures")  # row numbers are now data and cannot change
    distinct = signed.filter("bands is not null").groupBy("key").agg(F.first("bands").alias("bands"))
    banded = distinct.select("key", F.posexplode("bands").alias("band", "hash"))
    buckets = banded.groupBy("band", "hash").agg(F.count(F.lit(1)).alias("size"), F.min("key").alias("leader")).filter("size > 1")
    members = cut(spark, banded.join(buckets, ["band", "hash"]), "minhash-members")
    involved = members.select("key").distinct()
    texts = cut(spark, rows.join(involved, "key").groupBy("key").agg(F.first("text").alias("text")), "minhash-texts")

    def confirmed(pairs: DataFrame) -> DataFrame:
        one = texts.select(F.col("key").alias("a"), F.col("text").alias("text_a"))
        two = texts.select(F.col("key").alias("b"), F.col("text").alias("text_b"))
        return pairs.join(one, "a").join(two, "b").select("a", "b", "text_a", "text_b").mapInArrow(_verify, "a binary, b binary")

    stars = members.filter("key != leader").select(F.col("key").alias("a"), F.col("leader").alias("b")).distinct()
    with batch_rows(spark, BATCH_ROWS):
        roots = cut(spark, components(spark, confirmed(stars)), "minhash-roots")
    # buckets with several classes: all members of other classes than the largest against all members, in blocks
    labelled = members.select("band", "hash", "key").join(roots.withColumnRenamed("node", "key"), "key", "left").withColumn(
        "root", F.coalesce("root", "key"))
    per_class = labelled.groupBy("band", "hash", "root").agg(F.count(F.lit(1)).alias("n"))
    open_ = per_class.groupBy("band", "hash").agg(F.max(F.struct("n", "root"))["root"].alias("largest"), F.sum("n").alias("size"), F.count(F.lit(1)).alias("c")).filter("c > 1")
    open_keys = labelled.join(open_, ["band", "hash"]).select("key").distinct()
    details = signed.join(open_keys, "key").groupBy("key").agg(F.first(F.struct("sketch", "bands")).alias("d")).join(
        texts, "key").select("key", "d.*", F.col("text").alias("words"))
    rest = labelled.join(open_, ["band", "hash"]).join(details, "key")
    rest = cut(spark, rest.withColumn("n_blocks", F.ceil(F.col("size") / BLOCK)).withColumn("block", F.pmod(F.xxhash64("key"), "n_blocks")), "minhash-rest")
    # buckets of one block are dealt to lanes of about a block's rows, so that a task call is worth its cost
    lanes = -(-rest.filter("n_blocks = 1").count() // BLOCK) or 1
    single = F.col("n_blocks") == 1
    lane = [F.when(single, -1).otherwise(F.col("band")).alias("u"),
            F.when(single, F.pmod(F.xxhash64("band", "hash"), F.lit(lanes))).otherwise(F.col("hash")).alias("v")]
    every_block = F.explode(F.sequence(F.lit(0).cast("long"), F.col("n_blocks") - 1))
    asking = rest.filter("root != largest").withColumn("other", every_block)
    asked = again(spark, rest).withColumn("own", every_block)
    pairs = asking.groupBy(*lane, F.col("block").alias("x"), F.col("other").alias("y")).cogroup(
        asked.groupBy(*lane, F.col("own").alias("x"), F.col("block").alias("y"))).applyInPandas(_compare, "a binary, b binary")
    links = pairs.distinct()
    roots = cut(spark, components(spark, roots.select(F.col("node").alias("a"), F.col("root").alias("b")).union(links)), "minhash-roots")
    placed = signed.select("doc_id", "row", F.when(F.col("bands").isNotNull(), F.col("key")).alias("key")).join(
        roots.withColumnRenamed("node", "key"), "key", "left").withColumn("root", F.coalesce("root", "key"))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("absent"), "doc_id", "key", "row"))
    least = placed.filter("root is not null").groupBy("root").agg(first.alias("first"))
    least = least.select("root", F.col("first.doc_id").alias("class_id"), F.col("first.key").alias("lead"), F.col("first.row").alias("first_row"))
    return placed.join(least, "root", "left").select(
        F.col("doc_id").alias(id_col), "key", F.when(F.col("root").isNull(), F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"), "root", "lead",
        (F.col("root").isNull() | (F.col("row") == F.col("first_row"))).alias("kept"))


def representatives(spark: SparkSession, df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``df`` with one row of each class: one with the smallest id; rows without words all stay."""
    found = classes(spark, df, id_col, text_col).filter("key is not null")
    kept = found.select("root", F.col("lead").alias("__key"), F.col("class_id").alias("__first")).distinct()  # a row per class
    kept = cut(spark, kept.select("__key", "__first"), "minhash-kept")
    row = F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("__row")
    body = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    rows = df.select(row, F.unhex(F.md5(body)).alias("__key"), F.col(f"`{id_col}`").alias("__id"), (F.btrim(body, F.lit(BLANKS)) == "").alias("__empty"))
    worded = rows.filter(~F.col("__empty")).alias("r").join(kept.alias("k"), (F.col("r.__key") == F.col("k.__key")) & F.col("r.__id").eqNullSafe(F.col("k.__first")))
    one = worded.groupBy("r.__key").agg(F.first("r.__row").alias("__row"))
    return one.select("__row.*").union(rows.filter("__empty").select("__row.*"))
