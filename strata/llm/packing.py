"""Operator 13: best-fit packing planned over a histogram of lengths.

``token_pieces`` encodes every text, adds the end id and cuts what is longer
than a sequence.  ``plan`` packs the histogram of the pieces' lengths, at most
one count per length, by best fit with decreasing lengths: equal sequences are
kept as one class (first number, how many, free places), so placing a length
takes one step per class it meets and never one per document.  ``pack`` ranks
the pieces within their length and gives each the slot planned for its rank.

Ranks: pieces are dealt by hash into about sqrt(pieces) / 8 lanes, numbered
within (length, lane), and raised by the pieces of that length in earlier
lanes, so a length that holds a third of all pieces is ranked by many tasks.
Only the histogram (one row per possible length) reaches the driver, and only
the plan, whose size follows the number of lengths, is sent to the tasks.

Defined results: a null or empty text is the end id alone; repeated rows are
packed as often as they occur; a null id stays null; an empty table gives no
rows; columns that are not named are not read.  Pieces with equal ids and equal
keys may trade places.  Texts may be of any length.
"""
from __future__ import annotations

import os
import struct
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator
from itertools import islice
from math import isqrt
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession, Window, functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StructField, StructType

CAPACITY = 2048
END_ID = 0
CACHE = 1_000_000   # matches whose ids a Python worker remembers
WHOLE = 1 << 20     # characters of a text whose matches are listed at once
# Fixed value: the split of byte-level vocabularies, its commonest alternative first
SPLIT = r" ?\p{L}+| ?\p{N}+|'(?:[stmd]|re|ve|ll)| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


# -- tokens --------------------------------------------------------------
def byte_letters() -> dict[int, str]:
    """The letter that byte-level vocabularies write for each byte: itself where it prints, else the next one from 256 on."""
    prints = [*range(ord("!"), ord("~") + 1), *range(ord("\xa1"), ord("\xac") + 1), *range(ord("\xae"), 256)]
    others = (b for b in range(256) if b not in prints)
    return {b: chr(b) for b in prints} | {b: chr(256 + i) for i, b in enumerate(others)}


class Known(dict):
    """Match of the split -> its ids as little-endian unsigned 32-bit integers, found once and remembered."""

    def __init__(self, model):
        super().__init__()
        self.model, self.letters = model, byte_letters()

    def __missing__(self, match: str) -> bytes:
        ids = [t.id for t in self.model.tokenize(match.encode().decode("latin-1").translate(self.letters))]
        if len(self) >= CACHE:
            self.clear()
        self[match] = out = struct.pack(f"<{len(ids)}I", *ids)
        return out


class Encoder:
    """Ids by the tokenizers library; equal to encoding the whole text, but equal matches are encoded once.

    A byte-level file first splits a text by ``SPLIT`` and merges within a match;
    any other file encodes whole texts.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one core per task
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
        self.split = regex.compile(SPLIT)
        first = str(self.tokenizer.pre_tokenizer)
        self.byte_level = (self.tokenizer.normalizer is None and first.startswith("ByteLevel(")
                           and "add_prefix_space=False" in first and "use_regex=True" in first)
        self.ids_of = Known(self.tokenizer.model).__getitem__

    def ids(self, text: str) -> bytes:
        """The ids as little-endian unsigned 32-bit integers."""
        if not self.byte_level:
            ids = self.tokenizer.encode(text, add_special_tokens=False).ids
            return struct.pack(f"<{len(ids)}I", *ids)
        if len(text) <= WHOLE:
            return b"".join(map(self.ids_of, self.split.findall(text)))
        matches = (m.group() for m in self.split.finditer(text))
        return b"".join(iter(lambda: b"".join(map(self.ids_of, islice(matches, 1 << 16))), b""))


_ENCODERS: dict[str, Encoder] = {}  # one per Python worker and vocabulary


def encoder(path: str) -> Encoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def cuts(length: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces; only the first may be shorter than ``capacity`` when there are several."""
    first = length % capacity or capacity
    return [(0, first)] + [(start, capacity) for start in range(first, length, capacity)]


def token_pieces(docs: DataFrame, path: str, keys: tuple[str, ...] = ("doc_id",), text: str = "text",
                 capacity: int = CAPACITY, end_id: int = END_ID, with_ids: bool = True) -> DataFrame:
    """The keys and piece, start, length, ids_crc32 (and ids) of every piece of every text."""
    needed = docs.select(*[F.col(f"`{k}`") for k in keys], F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("__text"))
    end = np.array([end_id], dtype="<u4").tobytes()
    schema = StructType([*needed.schema.fields[:-1], StructField("piece", IntegerType()), StructField("start", LongType()),
                         StructField("length", LongType()), StructField("ids_crc32", LongType()),
                         *([StructField("ids", ArrayType(LongType()))] if with_ids else [])])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(path)
        names = [f.name for f in schema.fields]
        for batch in batches:
            rows, piece, start, length, crc, ids = [], [], [], [], [], []
            for row, value in enumerate(batch.column(batch.num_columns - 1)):
                data = coder.ids(value.as_py()) + end
                for i, (at, size) in enumerate(cuts(len(data) // 4, capacity)):
                    part = data[4 * at:4 * (at + size)]
                    rows.append(row)
                    piece.append(i)
                    start.append(at)
                    length.append(size)
                    crc.append(zlib.crc32(part))
                    if with_ids:
                        ids.append(np.frombuffer(part, dtype="<u4").astype(np.int64))
            own = [batch.column(c).take(pa.array(rows, pa.int64())) for c in range(batch.num_columns - 1)]
            made = [pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())]
            if with_ids:
                made.append(pa.array(ids, pa.list_(pa.int64())))
            yield pa.RecordBatch.from_arrays(own + made, names)

    return needed.mapInArrow(run, schema)


# -- plan ----------------------------------------------------------------
class Slots(NamedTuple):
    """Ranks ``first`` to ``last`` of a length: ``each`` of them in a row to a sequence, from ``sequence`` and ``offset`` on."""
    length: int
    first: int
    last: int
    each: int
    sequence: int
    offset: int


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> list[Slots]:
    """Best fit with decreasing lengths over the counts of lengths."""
    slots: list[Slots] = []
    open_classes: list[tuple[int, int, int]] = []  # (free, first sequence, how many), sorted
    sequences = 0
    for length in sorted(histogram, reverse=True):
        rank, left = 0, histogram[length]
        while left:
            at = bisect_left(open_classes, (length, -1, -1))
            if at < len(open_classes):
                free, base, many = open_classes.pop(at)  # the least room that is enough
            else:
                free, base, many = capacity, sequences, -(-left // (capacity // length))
                sequences += many
            each = min(free // length, left)
            used = min(many, left // each)
            if used < many:
                insort(open_classes, (free, base + used, many - used))
            slots.append(Slots(length, rank, rank + used * each - 1, each, base, capacity - free))
            if free > each * length:
                insort(open_classes, (free - each * length, base, used))
            rank += used * each
            left -= used * each
    return slots


# -- placement -----------------------------------------------------------
def pack(spark: SparkSession, pieces: DataFrame, keys: tuple[str, ...] = ("doc_id",), capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` (from ``token_pieces``, written out: it is read three times) with sequence_id and offset."""
    counts = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}  # at most ``capacity`` rows
    lanes = max(1, isqrt(sum(counts.values())) // 8)
    order = [*keys, "piece", "start", "ids_crc32"]
    dealt = pieces.withColumn("__lane", F.pmod(F.xxhash64(*order), F.lit(lanes)))
    per_lane = dealt.groupBy("length", "__lane").agg(F.count(F.lit(1)).alias("__many"))
    before = Window.partitionBy("length").orderBy("__lane").rowsBetween(Window.unboundedPreceding, -1)
    starts = per_lane.select("length", "__lane", F.coalesce(F.sum("__many").over(before), F.lit(0)).alias("__earlier"))
    within = F.row_number().over(Window.partitionBy("length", "__lane").orderBy(*order))
    ranked = dealt.withColumn("__within", within).join(starts, ["length", "__lane"]).withColumn(
        "__rank", F.col("__earlier") + F.col("__within") - 1)
    planned = spark.createDataFrame(plan(counts, capacity) or [Slots(0, 0, 0, 1, 0, 0)],
                                    "__length long, __first long, __last long, __each long, __sequence long, __offset long")
    step = F.col("__rank") - F.col("__first")
    meets = (F.col("length") == F.col("__length")) & F.col("__rank").between(F.col("__first"), F.col("__last"))
    placed = ranked.join(F.broadcast(planned), meets)  # the plan is bounded by the number of lengths
    return placed.select(*pieces.columns, (F.col("__sequence") + F.expr("(__rank - __first) div __each")).alias("sequence_id"),
                         (F.col("__offset") + step % F.col("__each") * F.col("length")).alias("offset"))


def sequences(placed: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """(sequence_id, ids, lengths): the pieces' ids in order; a sequence holds at most ``capacity`` of them."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "length", "ids")))
    return placed.groupBy("sequence_id").agg(parts.alias("p")).select(
        "sequence_id", F.flatten("p.ids").alias("ids"), F.col("p.length").alias("lengths"))
