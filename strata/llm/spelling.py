"""Operator 11: spelling variants by dense prefix-suffix tiling.

``corpus_words`` counts the words of all texts.  ``near_words`` finds, for every
word, the other words that differ from it by one inserted, deleted or replaced
code point, and ``variants`` names each word's form (its most frequent near word,
if that is frequent enough) and root (where the forms end).

Two near words, the shorter of m code points, are equal before and after the
place of their edit.  Every word therefore goes, once as the shorter and once as the
longer one, into a block for each of ``SEGMENTS`` stretches of the m places:
its key is what lies before and after the stretch.  Near words share the block
of the stretch that holds their edit, and only that block reports them, so no
pair is found twice.  A block of over ``TILE`` words is cut into the blocks of
its stretch's halves, again and again; a stretch of one place ends this, where
the alphabet bounds what a block can hold.  Blocks are compared as padded
matrices of code points, stacked by size: lengths of common prefixes and
suffixes come from running ANDs over equal columns, and two words are near when
prefix plus suffix reach the longer length minus one.

Skew: words are summed map-side, sizes of blocks too, and a hot block is cut
before any task holds it.  What a task keeps is a batch of rows and one block.

Defined results: a null or empty text has no words; a null id counts as the
empty text; repeated rows count again; an empty table gives no rows; columns
other than the two named are not read.  Texts may be of any length.  Ties
between near words of one count go to the smallest in code-point order.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from strata.llm.common import again, cut, drop_cut

RUN = r"[A-Za-zÀ-ÿ]"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
MIN_LENGTH, MIN_COUNT, RATIO = 6, 5, 5
THIN = 199        # one (document, run) pair in so many loses a code point
SEGMENTS = 3      # stretches per word at first
TILE = 64         # words of a block that are compared without cutting it further
CELLS = 1 << 23   # bytes of one comparison
NEAR = "word string, near long, best struct<less: long, word: string>"


def corpus_words(docs: DataFrame, id_column: str = "doc_id", text: str = "text", min_length: int = MIN_LENGTH,
                 min_count: int = MIN_COUNT, thin: int = THIN) -> DataFrame:
    """(word, n) for all words of at least ``min_length`` code points and ``min_count`` occurrences."""
    run = f"{RUN}{{{min_length},}}"  # greedy: whole runs; a shorter run has no word that is long enough
    found = docs.select(F.coalesce(F.col(f"`{id_column}`").cast("string"), F.lit("")).alias("id"),
                        F.explode(F.regexp_extract_all(F.col(f"`{text}`"), F.lit(run), F.lit(0))).alias("run"))
    found = found.select("id", F.translate("run", UPPER, LOWER).alias("run"))
    found = found.withColumn("h", F.crc32(F.concat_ws(":", "id", "run").cast("binary")))
    at = (F.col("h") % F.length("run")).cast("int")
    cut_run = F.concat(F.col("run").substr(F.lit(1), at), F.col("run").substr(at + 2, F.length("run")))
    word = F.when(F.col("h") % thin == 0, cut_run).otherwise(F.col("run"))
    return found.select(word.alias("word")).filter(F.length("word") >= min_length).groupBy("word").agg(
        F.count(F.lit(1)).alias("n")).filter(F.col("n") >= min_count)


# -- blocks --------------------------------------------------------------
def _keyed(rows: DataFrame) -> DataFrame:
    """``key``: the number m, the stretch, and what is before and after it."""
    tail = F.col("m") - F.col("hi")
    return rows.withColumn("key", F.concat_ws(
        " ", "m", "lo", "hi", F.col("word").substr(F.lit(1), F.col("lo")), F.col("word").substr(F.length("word") - tail + 1, tail)))


def _first_blocks(words: DataFrame) -> DataFrame:
    rows = words.select("word", "n", F.explode(F.array(F.length("word"), F.length("word") - 1)).alias("m"))
    rows = rows.withColumn("s", F.explode(F.array(*[F.lit(s) for s in range(SEGMENTS)])))
    return _keyed(rows.select("word", "n", "m", F.floor(F.col("m") * F.col("s") / SEGMENTS).cast("int").alias("lo"),
                              F.floor(F.col("m") * (F.col("s") + 1) / SEGMENTS).cast("int").alias("hi")).filter("lo < hi"))


def _halved(rows: DataFrame) -> DataFrame:
    middle = F.floor((F.col("lo") + F.col("hi")) / 2).cast("int")
    parts = F.array(F.struct(F.col("lo"), middle.alias("hi")), F.struct(middle.alias("lo"), F.col("hi")))
    return _keyed(rows.select("word", "n", "m", F.explode(parts).alias("part")).select("word", "n", "m", "part.lo", "part.hi"))


def leaf_blocks(spark: SparkSession, words: DataFrame) -> list[DataFrame]:
    """Copies of the rows (word, n, m, lo, hi, key) of all blocks with two words or more."""
    rows, leaves = _first_blocks(words), []
    while True:
        sizes = rows.groupBy("key").agg(F.count(F.lit(1)).alias("size")).filter("size > 1")
        blocks = cut(spark, rows.join(sizes, "key"), "spelling-blocks")
        leaves.append(blocks)
        hot = blocks.filter(f"size > {TILE} AND hi - lo > 1")
        if hot.isEmpty():
            return leaves
        rows = _halved(hot)


# -- dense comparison ----------------------------------------------------
def near_pairs(words: np.ndarray, m: np.ndarray, lo: np.ndarray, hi: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs of near words that lie in one block; block b holds rows starts[b] to starts[b + 1]."""
    width = words.dtype.itemsize // 4
    codes = np.ascontiguousarray(words).view(np.uint32).reshape(len(words), width)
    sizes = (codes != 0).sum(1)
    back = sizes[:, None] - 1 - np.arange(width)
    ends = np.where(back >= 0, np.take_along_axis(codes, np.maximum(back, 0), 1), 0)
    left, right = [], []
    counts = np.diff(starts)
    rank = np.ceil(np.log2(np.maximum(counts, 2))).astype(int)
    for power in np.unique(rank[counts > 1]):
        side = 1 << int(power)
        blocks = np.nonzero((rank == power) & (counts > 1))[0]
        tile = min(side, TILE)
        step = max(1, CELLS // (tile * tile * width))
        for at in range(0, len(blocks), step):
            some = blocks[at:at + step]
            slots = starts[some][:, None] + np.arange(side)
            slots = np.where(np.arange(side) < counts[some][:, None], slots, -1)
            for i in range(0, side, tile):          # block pairs: tile i against tile j
                for j in range(i, side, tile):
                    a, b = slots[:, i:i + tile], slots[:, j:j + tile]
                    x, y = _near(codes, ends, sizes, m, lo, hi, a, b)
                    left.append(x)
                    right.append(y)
    if not left:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return np.concatenate(left), np.concatenate(right)


def _near(codes, ends, sizes, m, lo, hi, a, b):
    short = np.minimum(sizes[a][:, :, None], sizes[b][:, None, :])
    long = np.maximum(sizes[a][:, :, None], sizes[b][:, None, :])
    same_head = np.logical_and.accumulate(codes[a][:, :, None, :] == codes[b][:, None, :, :], axis=-1).sum(-1)
    same_tail = np.logical_and.accumulate(ends[a][:, :, None, :] == ends[b][:, None, :, :], axis=-1).sum(-1)
    head, tail = np.minimum(same_head, short), np.minimum(same_tail, short)
    base = m[a][:, :, None]
    place = np.where(short == long, head, short - tail)  # of the edit, in the shorter word
    first, last = lo[a][:, :, None], hi[a][:, :, None]
    here = (place >= first) & ((place < last) | ((place == base) & (last == base)))
    good = (a[:, :, None] >= 0) & (b[:, None, :] >= 0) & (a[:, :, None] < b[:, None, :])
    good &= (short == base) & (long - short <= 1) & (head + tail >= long - 1) & here
    block, i, j = np.nonzero(good)
    return a[block, i], b[block, j]


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by key -> for each word of a run of blocks the number of near words and the best one."""
    rest: pa.Table | None = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        rest = table if rest is None else pa.concat_tables([rest, table])
        keys = rest.column("key").combine_chunks()
        whole = _first_of_last(keys)
        if whole:
            yield from _near_rows(rest.slice(0, whole))
            rest = rest.slice(whole)
    if rest is not None and len(rest):
        yield from _near_rows(rest)


def _first_of_last(keys: pa.Array) -> int:
    """Where the last key, whose block may go on in the next batch, begins."""
    at, last = len(keys) - 1, keys[-1]
    while at > 0 and keys[at - 1] == last:
        at -= 1
    return at


def _near_rows(rows: pa.Table) -> Iterator[pa.RecordBatch]:
    keys = rows.column("key").to_numpy(zero_copy_only=False)
    words = np.array(rows.column("word").to_pylist(), dtype=str)
    n, m, lo, hi = (rows.column(c).to_numpy() for c in ("n", "m", "lo", "hi"))
    starts = np.concatenate([[0], np.nonzero(keys[1:] != keys[:-1])[0] + 1, [len(keys)]])
    x, y = near_pairs(words, m, lo, hi, starts)
    if not len(x):
        return
    _, who = np.unique(words, return_inverse=True)  # a word stands in several blocks
    of, near = np.concatenate([x, y]), np.concatenate([y, x])
    order = np.lexsort((who[near], -n[near], who[of]))
    of, near = of[order], near[order]
    first = np.nonzero(np.concatenate([[True], who[of][1:] != who[of][:-1]]))[0]
    best = pa.StructArray.from_arrays([pa.array(-n[near[first]]), pa.array(words[near[first]].tolist(), pa.string())], ["less", "word"])
    yield pa.RecordBatch.from_arrays([
        pa.array(words[of[first]].tolist(), pa.string()), pa.array(np.diff(np.append(first, len(of))).astype(np.int64)), best],
        ["word", "near", "best"])


def near_words(blocks: list[DataFrame]) -> DataFrame:
    """(word, near, best.less = minus the count of the best near word, best.word) for words that have near ones."""
    found = None
    for block in blocks:
        leaves = block.filter(f"size <= {TILE} OR hi - lo <= 1").select("word", "n", "m", "lo", "hi", "key")
        rows = leaves.repartition("key").sortWithinPartitions("key").mapInArrow(_compare, NEAR)
        found = rows if found is None else found.unionAll(rows)
    return found.groupBy("word").agg(F.sum("near").alias("near"), F.min("best").alias("best"))


# -- forms and roots -----------------------------------------------------
def _roots(spark: SparkSession, forms: DataFrame) -> DataFrame:
    """(word, root) by following ``form`` twice as far each round; forms grow in count, so there is no ring."""
    now = cut(spark, forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        ahead = again(spark, now).select(F.col("word").alias("root"), F.col("root").alias("further"))
        joined = now.join(ahead, "root", "left")
        after = cut(spark, joined.select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "spelling-roots")
        drop_cut(spark, now)
        if after.filter("moved").isEmpty():
            return after.select("word", "root")
        path = after._cut_path
        now = after.select("word", "root")
        now._cut_path = path


def variants(spark: SparkSession, words: DataFrame, ratio: int = RATIO) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for every row of ``words`` (word, n), whose words are distinct."""
    words = cut(spark, words, "spelling-words")
    blocks = leaf_blocks(spark, words)
    joined = words.join(near_words(blocks), "word", "left")
    form_n = -F.col("best.less")
    enough = form_n >= F.col("n") * ratio
    judged = cut(spark, joined.select(
        "word", F.when(enough, F.col("best.word")).alias("form"), "n", F.coalesce("near", F.lit(0).cast("bigint")).alias("n_near"),
        F.when(enough, form_n).alias("form_n")), "spelling-forms")
    drop_cut(spark, words, *blocks)
    roots = _roots(spark, judged.filter("form IS NOT NULL"))
    return judged.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
