"""Operator 1: quotation linking and reply-ordered conversations without quotes.

1. ``parse`` takes each message apart: lines that begin with quote marks belong
   to passages of their nesting level, lines that only introduce a quotation go,
   the rest is the message's own text.
2. Every quoted line and every line of own text is normalised (case, white
   space, quote marks) and hashed; a whole passage and a whole message are too.
3. ``link`` joins the hashes of quoted passages to original messages: first to
   the earliest message of the same conversation with that hash, else to the
   earliest of all.  A passage goes to the message that most of its lines name
   (a match of the whole passage outweighs them), at every level, and carries that
   original.  A message replies to the earlier message that most lines of its
   passages of level one name.
4. ``threads`` orders the messages of a conversation by thread (the message at
   the root of the replies), then turn: a reply always comes after its parent.
   ``position`` counts from 0 in that order.

Hashes are summed to one earliest message per key before they are joined, so a
line that thousands of messages share is one row.  Positions come from a range
partitioning and counts per partition, so a conversation with any share of the
rows is spread over many tasks.

Defined results: a null or empty text has an empty own text and no passages; a
message without a known original starts a thread of its own; messages without
conversation or turn are not linked and stand at the end of their conversation;
repeated rows are messages of their own with equal links; quotes of later
messages or of itself link nothing.
"""
from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from strata.llm.common import again, cut
from strata.llm.components import components

MARK = re.compile(r"^[ \t]*((?:>[ \t]?)+)(.*)$")
BLANK = re.compile(r"\s+")
# Lines that introduce a quotation, by language
INTRODUCES = re.compile(r"^\s*(?:(?:on|am|le|el)\b.{0,200}\b(?:wrote|writes|schrieb|a écrit|écrit|escribió)\s*:|.{0,80}\b(?:wrote|schrieb|a écrit|escribió)\s*:"
                        r"|-{2,}\s*(?:original message|ursprüngliche nachricht|message d'origine|mensaje original)\s*-{2,})\s*$", re.I)
WHOLE = 1000  # votes of a match of a whole passage


def normalised(text: str) -> str:
    return BLANK.sub(" ", text).strip().casefold()


def digest(text: str) -> int:
    return int.from_bytes(hashlib.blake2b(text.encode("utf-8"), digest_size=8).digest(), "big", signed=True)


def parse(text: str | None) -> tuple[str, list[tuple[int, str]]]:
    """(own text, [(level, passage)]) of a message; passages are runs of lines of one level."""
    own: list[str] = []
    passages: list[tuple[int, list[str]]] = []
    before = 0
    for line in (text or "").split("\n"):
        match = MARK.match(line)
        level = match.group(1).count(">") if match else 0
        if not level:
            own.append(line)
        else:
            while own and not before and (not own[-1].strip() or INTRODUCES.match(own[-1])) and any(INTRODUCES.match(x) for x in own[-2:]):
                own.pop()
            if level != before:
                passages.append((level, []))
            body = match.group(2).rstrip()
            if not INTRODUCES.match(body):
                passages[-1][1].append(body)
        before = level
    kept = [(level, "\n".join(lines).strip()) for level, lines in passages]
    return "\n".join(own).strip(), [(level, p) for level, p in kept if p]


def keys_of(text: str) -> list[tuple[int, int]]:
    """(hash, votes) of a text as a whole and of its lines."""
    lines = [n for n in map(normalised, text.split("\n")) if n]
    out = {digest(line): 1 for line in lines}
    if lines:
        out[digest(" ".join(lines))] = WHOLE
    return sorted(out.items())


def parsed(df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """conv_id, turn, role, own, passages (level, text), quoted (passage, level, hash, votes), lines (hash) and message of every row.

    ``passage`` is the number of a passage in its message; ``message`` tells texts of one turn apart.
    """
    rows = df.select(F.col(f"`{conv}`").cast("long").alias("conv_id"), F.col(f"`{turn}`").cast("long").alias("turn"),
                     F.col(f"`{role}`").cast("string").alias("role"), F.col(f"`{text}`").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        passage = pa.struct([("level", pa.int32()), ("text", pa.string())])
        quote = pa.struct([("passage", pa.int32()), ("level", pa.int32()), ("hash", pa.int64()), ("votes", pa.int32())])
        for batch in batches:
            texts = batch.column(3).to_pylist()
            done = [parse(t) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), batch.column(2), pa.array([own for own, _ in done], pa.string()),
                 pa.array([[{"level": level, "text": p} for level, p in found] for _, found in done], pa.list_(passage)),
                 pa.array([[{"passage": i, "level": level, "hash": h, "votes": v} for i, (level, p) in enumerate(found) for h, v in keys_of(p)]
                           for _, found in done], pa.list_(quote)),
                 pa.array([[h for h, _ in keys_of(own)] for own, _ in done], pa.list_(pa.int64())),
                 pa.array([digest(t or "") for t in texts], pa.int64())],
                names=["conv_id", "turn", "role", "own", "passages", "quoted", "lines", "message"])

    return rows.mapInArrow(run, "conv_id long, turn long, role string, own string, passages array<struct<level:int,text:string>>, "
                                "quoted array<struct<passage:int,level:int,hash:long,votes:int>>, lines array<long>, message long")


MESSAGE = ["conv_id", "turn", "message"]


def named(messages: DataFrame) -> DataFrame:
    """(conv_id, turn, message, passage, level, to, votes, inside): the messages that the lines of each passage name."""
    known = messages.filter(F.col("conv_id").isNotNull() & F.col("turn").isNotNull())
    lines = known.select("conv_id", "turn", F.explode("lines").alias("hash"))
    here = lines.groupBy("conv_id", "hash").agg(F.min("turn").alias("here_turn"))
    first = lines.groupBy("hash").agg(F.min(F.struct("conv_id", "turn")).alias("first"))
    quoted = known.select(*MESSAGE, F.explode("quoted").alias("q")).select(*MESSAGE, "q.*")
    joined = quoted.join(here, ["conv_id", "hash"], "left").join(first, "hash", "left")
    inside = F.col("here_turn") < F.col("turn")
    joined = joined.withColumn("to", F.when(inside, F.struct("conv_id", F.col("here_turn").alias("turn"))).when(
        F.col("first.conv_id") != F.col("conv_id"), F.col("first"))).filter("to is not null")
    return joined.groupBy(*MESSAGE, "passage", "level", "to").agg(F.sum("votes").alias("votes"), F.max(inside.cast("int")).alias("inside"))


def link(votes: DataFrame, *by: str) -> DataFrame:
    """(conv_id, turn, message, ``by``, to_conv, to_turn): the original message that most votes of ``named`` name."""
    summed = votes.groupBy(*MESSAGE, *by, "to").agg(F.sum("votes").alias("votes"), F.max("inside").alias("inside"))
    best = summed.groupBy(*MESSAGE, *by).agg(F.max_by("to", F.struct(
        "inside", "votes", -F.col("to.conv_id"), -F.col("to.turn"))).alias("to"))
    return best.select(*MESSAGE, *by, F.col("to.conv_id").alias("to_conv"), F.col("to.turn").alias("to_turn"))


def conversations(spark: SparkSession, df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """One row per message: conv_id, turn, role, own text without quotes, passages (each with its original, to_conv / to_turn), reply_to_conv / reply_to_turn, thread, position, formatted."""
    messages = cut(spark, parsed(df, conv, turn, role, text), "quotes-messages")
    votes = cut(spark, named(messages), "quotes-votes")
    direct = cut(spark, link(votes.filter("level = 1")), "quotes-links")
    originals = link(votes, "passage").groupBy(*MESSAGE).agg(F.map_from_entries(F.collect_list(
        F.struct("passage", F.struct("to_conv", "to_turn")))).alias("originals"))
    edges = direct.filter("to_conv = conv_id").select(F.struct("conv_id", "turn").alias("a"), F.struct(
        F.col("to_conv").alias("conv_id"), F.col("to_turn").alias("turn")).alias("b"))
    roots = components(spark, edges).select("node.conv_id", "node.turn", F.col("root.turn").alias("root_turn"))
    rows = messages.drop("quoted", "lines").join(direct, MESSAGE, "left").join(originals, MESSAGE, "left").join(roots, ["conv_id", "turn"], "left")
    original = lambda i: F.try_element_at("originals", i)
    rows = rows.withColumn("passages", F.transform("passages", lambda p, i: F.struct(
        p["level"].alias("level"), p["text"].alias("text"), original(i)["to_conv"].alias("to_conv"), original(i)["to_turn"].alias("to_turn"))))
    rows = rows.drop("originals", "message")
    rows = rows.withColumn("thread", F.coalesce("root_turn", "turn")).drop("root_turn").withColumn("__tie", F.xxhash64("role", "own"))
    order = [F.col("thread").asc_nulls_last(), F.col("turn").asc_nulls_last(), F.col("__tie")]
    dealt = rows.repartitionByRange(F.col("conv_id"), *order).withColumn("__part", F.spark_partition_id())
    dealt = cut(spark, dealt, "quotes-order")  # partition numbers are now data and cannot change
    counts = again(spark, dealt).groupBy("conv_id", "__part").agg(F.count(F.lit(1)).alias("__n"))
    before = counts.withColumn("__before", F.sum("__n").over(Window.partitionBy("conv_id").orderBy("__part")) - F.col("__n")).select(
        F.col("conv_id").alias("__conv"), F.col("__part").alias("__p"), "__before")
    inside = F.row_number().over(Window.partitionBy("conv_id", "__part").orderBy(*order)) - 1
    placed = dealt.withColumn("__inside", inside).join(before, F.col("conv_id").eqNullSafe(F.col("__conv")) & (F.col("__part") == F.col("__p")))
    formatted = F.concat(F.lit("<|"), F.coalesce("role", F.lit("")), F.lit("|>\n"), F.col("own"), F.lit("\n"))
    return placed.select("conv_id", "turn", "role", F.col("own").alias("text"), F.size("passages").cast("long").alias("n_passages"), "passages",
                         F.col("to_conv").alias("reply_to_conv"), F.col("to_turn").alias("reply_to_turn"), "thread",
                         (F.col("__before") + F.col("__inside")).cast("long").alias("position"), formatted.alias("formatted"))
