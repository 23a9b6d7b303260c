"""Operator 3: exact threshold pairs of embeddings by cover trees and dual traversal.

Vectors are compared only within a label, by cosine in double precision; on unit
vectors cosine >= c is distance <= sqrt(2 - 2c).  Equal vectors of a label
collapse into one point with a multiplicity.  The points of a label are dealt
into cells around centres (the upper levels of a cover tree: a net of a bounded
sample whose radius halves until it has ``CENTRES`` centres), large cells by
hash into blocks of at most about ``BLOCK`` points.  Two blocks meet only if
their covering radii let points of theirs come within the distance; each such
pair of blocks is one small job that any executor can run:

* ``CoverTree``: nested levels with halving radii over the points of a block;
  a node covers its subtree within a radius that is measured, not assumed;
* ``dual_pairs``: starting from both roots, pairs of nodes are dropped when the
  distance of their points less both covering radii exceeds the limit, else the
  wider node of each is opened; leaf pairs are decided by the cosine itself.

The traversal computes the distances of all children of two nodes as one product.  Bounds keep a
margin above rounding, so that can only open too many pairs, never lose one.

Defined results: vectors that are null, empty, zero or hold null or non-finite
components, and vectors without a label, link with nothing and are their own
class; vectors of different length never meet; repeated rows are linked like
any equal vectors.
"""
from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from strata.llm.common import again, cut
from strata.llm.components import components

COSINE = 0.98
CENTRES = 32       # most centres of a label
SAMPLE = 1024      # points of a label that centres are chosen from
BLOCK = 2048       # points of a block, about
LEAF = 64
MARGIN = 1e-9
BOUND = 1e-7       # added to every limit: a distance from a rounded product is off by less


class CoverTree:
    """Nodes in arrays: ``point`` (index of the node's own point), ``radius`` (greatest distance to a point below),
    ``first`` / ``last`` (range of children) and ``begin`` / ``end`` (range of ``order`` with the points below)."""

    def __init__(self, points: np.ndarray):
        self.points = points
        n = len(points)
        self.order = np.arange(n)
        point, radius, first, last, begin, end = [0], [float(_distances(points, points[0]).max(initial=0.0))], [0], [0], [0], [n]
        queue = [0]
        while queue:
            node = queue.pop()
            a, b = begin[node], end[node]
            if b - a <= LEAF or radius[node] <= MARGIN:
                continue
            # the next level: a net at half the radius, every point goes to the first centre that covers it
            span = self.order[a:b].copy()
            between = _matrix(points[span], points[span])
            half, left = radius[node] / 2, np.ones(b - a, dtype=bool)
            centre, parts = int(np.nonzero(span == point[node])[0][0]), []
            while True:
                own = np.nonzero(left & (between[centre] <= half))[0]
                own = own if len(own) else np.array([centre])  # a centre covers itself, whatever rounding says
                parts.append((centre, own, float(between[centre][own].max())))
                left[own] = False
                left[centre] = False
                if not left.any():
                    break
                centre = int(left.argmax())
            self.order[a:b] = span[np.concatenate([own for _, own, _ in parts])]
            first[node] = len(point)
            for centre, own, reach in parts:
                point.append(int(span[centre]))
                radius.append(reach if len(own) > 1 else 0.0)
                first.append(0)
                last.append(0)
                begin.append(a)
                end.append(a + len(own))
                a += len(own)
                queue.append(len(point) - 1)
            last[node] = len(point)
        self.point, self.first, self.last = np.array(point), np.array(first), np.array(last)
        self.begin, self.end, self.radius = np.array(begin), np.array(end), np.array(radius)

    def below(self, node: int) -> np.ndarray:
        return self.order[self.begin[node]:self.end[node]]

    def children(self, node: int) -> np.ndarray:
        """The next level below a node; a leaf stands for itself."""
        return np.arange(self.first[node], self.last[node]) if self.first[node] < self.last[node] else np.array([node])


def _distances(points: np.ndarray, one: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(0.0, ((points - one) ** 2).sum(axis=1)))


def _matrix(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Distances of unit vectors; rounding of the product is below MARGIN squared root wise, see ``dual_pairs``."""
    return np.sqrt(np.maximum(0.0, 2.0 - 2.0 * (x @ y.T)))


def dual_pairs(one: CoverTree, two: CoverTree, cosine: float = COSINE, same: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Indices (i into one, j into two) of all pairs with at least that cosine; ``same``: each pair once, i < j."""
    limit = np.sqrt(2 - 2 * cosine) + BOUND
    found_i: list[np.ndarray] = []
    found_j: list[np.ndarray] = []
    stack = [(0, 0)]
    while stack:
        a, b = stack.pop()
        if one.first[a] == one.last[a] and two.first[b] == two.last[b]:  # two leaves: the cosines decide
            p, q = one.below(a), two.below(b)
            i, j = np.nonzero(one.points[p] @ two.points[q].T >= cosine)
            found_i.append(p[i])
            found_j.append(q[j])
            continue
        left, right = one.children(a), two.children(b)
        for at in range(0, len(left), 2048):
            part = left[at:at + 2048]
            gap = _matrix(one.points[one.point[part]], two.points[two.point[right]])
            i, j = np.nonzero(gap <= limit + one.radius[part][:, None] + two.radius[right][None, :])
            x, y = part[i], right[j]
            if same and a == b:  # the pair (y, x) is met as well; below two different nodes it is not
                x, y = x[x <= y], y[x <= y]
            single = (one.end[x] - one.begin[x] == 1) & (two.end[y] - two.begin[y] == 1)
            p, q = one.point[x[single]], two.point[y[single]]
            good = np.einsum("ij,ij->i", one.points[p], two.points[q]) >= cosine
            found_i.append(p[good])
            found_j.append(q[good])
            stack.extend(zip(x[~single].tolist(), y[~single].tolist(), strict=True))
    i, j = (np.concatenate(f) if f else np.empty(0, np.int64) for f in (found_i, found_j))
    if not same:
        return i, j
    i, j = np.minimum(i, j), np.maximum(i, j)
    i, j = i[i != j], j[i != j]
    once = np.unique(i * len(one.points) + j)
    return once // len(one.points), once % len(one.points)


def unit(vector: list | None) -> np.ndarray | None:
    """The vector in double precision, scaled to length one; null if it is null, zero or not finite throughout."""
    if vector is None or not len(vector):
        return None
    out = np.array([np.nan if x is None else x for x in vector], dtype=np.float64)
    top = np.abs(out).max()
    if not np.isfinite(top) or top == 0.0 or np.isnan(out).any():
        return None
    out /= top  # first by the largest component, so that squares neither overflow nor vanish
    return out / np.sqrt(out @ out)


def _prepare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, label, vector) to (id, label, key, unit vector); key is the digest of label and unit vector, null if the row links with nothing."""
    for batch in batches:
        labels = batch.column(1).to_pylist()
        units = [unit(v) if label is not None else None for label, v in zip(labels, batch.column(2).to_pylist(), strict=True)]
        keys = [None if v is None else hashlib.md5(f"{label}|{len(v)}|".encode() + (v + 0.0).tobytes()).digest()
                for label, v in zip(labels, units, strict=True)]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(keys, pa.binary()),
                                          pa.array([None if v is None else v for v in units], pa.list_(pa.float64()))],
                                         names=["id", "label", "key", "v"])


def centres(points: DataFrame) -> DataFrame:
    """(label, dims, centre, v): per label a net of a bounded sample; its radius is halved until it has CENTRES centres."""
    ordered = points.select("label", "dims", "node", "v", F.xxhash64("node").alias("o"))
    sample = ordered.groupBy("label", "dims").agg(F.count(F.lit(1)).alias("n"))
    few = ordered.join(sample, ["label", "dims"]).filter(
        F.pmod("o", F.lit(1 << 32)) < F.least(F.lit(1.0), F.lit(SAMPLE) / F.col("n")) * float(1 << 32)).select("label", "dims", "n", "v")

    def run(key, pdf: pd.DataFrame) -> pd.DataFrame:
        v = np.array(pdf["v"].tolist())
        want = min(CENTRES, max(1, int(np.ceil(pdf["n"].iloc[0] / BLOCK))))
        radius, chosen = 2.0, [0]
        nearest = _distances(v, v[0])
        while len(chosen) < want and nearest.max() > 1e-6:
            radius /= 2
            while len(chosen) < want and nearest.max() > radius:
                far = int(nearest.argmax())
                chosen.append(far)
                nearest = np.minimum(nearest, _distances(v, v[far]))
        return pd.DataFrame({"label": key[0], "dims": key[1], "centre": range(len(chosen)), "c": [v[i] for i in chosen]})

    return few.groupBy("label", "dims").applyInPandas(run, "label string, dims int, centre int, c array<double>")


def links(spark: SparkSession, points: DataFrame, cosine: float = COSINE) -> DataFrame:
    """(a, b) node ids of all linked pairs of different points, each once; ``points`` has label, dims, node, v and is read twice."""
    def pairs(own: pd.DataFrame, its: pd.DataFrame, i: np.ndarray, j: np.ndarray, same: bool) -> pd.DataFrame:
        return pd.DataFrame({"a": own["node"].to_numpy()[i], "b": its["node"].to_numpy()[j]})

    return _met(spark, points.withColumn("copies", F.lit(1).cast("long")), cosine, pairs, "a long, b long")


def neighbours(spark: SparkSession, points: DataFrame, cosine: float = COSINE) -> DataFrame:
    """(node, to, others): per block pair and linked point, a point that stands for all it is joined to there, and how many
    rows its links have there; ``points`` has copies, too.  A group of linked points gives a row per point, not per pair."""
    def told(own: pd.DataFrame, its: pd.DataFrame, i: np.ndarray, j: np.ndarray, same: bool) -> pd.DataFrame:
        node = own["node"].to_numpy() if same else np.concatenate([own["node"].to_numpy(), its["node"].to_numpy()])
        copies = own["copies"].to_numpy() if same else np.concatenate([own["copies"].to_numpy(), its["copies"].to_numpy()])
        j = j if same else j + len(own)
        others = np.zeros(len(node), np.int64)
        np.add.at(others, i, copies[j])
        np.add.at(others, j, copies[i])
        linked = np.unique(np.concatenate([i, j]))
        return pd.DataFrame({"node": node[linked], "to": node[_joined(len(node), i, j)[linked]], "others": others[linked]})

    return _met(spark, points, cosine, told, "node long, to long, others long")


def _joined(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The smallest index that links reach from each of n points."""
    to = np.arange(n)
    while True:
        low = np.minimum(to[i], to[j])
        after = to.copy()
        np.minimum.at(after, i, low)
        np.minimum.at(after, j, low)
        np.minimum.at(after, to[i], low)
        np.minimum.at(after, to[j], low)
        after = after[after]
        if (after == to).all():
            return to
        to = after


def _met(spark: SparkSession, points: DataFrame, cosine: float, told, schema: str) -> DataFrame:
    """What ``told`` makes of the links of every pair of blocks that may hold some."""
    net = cut(spark, centres(points), "cover-centres")
    table = net.groupBy("label", "dims").agg(F.collect_list(F.struct("centre", "c")).alias("net"))  # at most CENTRES a label
    by = points.join(table, ["label", "dims"])

    def deal(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if not len(batch):
                continue
            out = []
            for _, part in batch.groupby(["label", "dims"]):
                c = np.array([x["c"] for x in part["net"].iloc[0]])
                number = np.array([x["centre"] for x in part["net"].iloc[0]])
                v = np.array(part["v"].tolist())
                gap = np.stack([_distances(v, one) for one in c], axis=1)
                nearest = gap.argmin(axis=1)
                out.append(part.assign(cell=number[nearest], reach=gap[np.arange(len(v)), nearest])[["label", "dims", "node", "copies", "v", "cell", "reach"]])
            yield pd.concat(out)

    dealt = cut(spark, by.mapInPandas(deal, "label string, dims int, node long, copies long, v array<double>, cell int, reach double"), "cover-cells")
    cells = dealt.groupBy("label", "dims", "cell").agg(F.count(F.lit(1)).alias("n"), F.max("reach").alias("radius"))
    cells = cut(spark, cells.withColumn("blocks", F.ceil(F.col("n") / BLOCK).cast("int")).join(
        net.withColumnRenamed("centre", "cell"), ["label", "dims", "cell"]), "cover-sizes")
    one = cells.select("label", "dims", *[F.col(c).alias(f"{c}1") for c in ("cell", "radius", "blocks", "c")])
    gap = F.sqrt(F.aggregate(F.zip_with("c1", "c2", lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda s, x: s + x))
    limit = float(np.sqrt(2 - 2 * cosine)) + MARGIN
    two = again(spark, cells).select("label", "dims", *[F.col(c).alias(f"{c}2") for c in ("cell", "radius", "blocks", "c")])
    meets = one.join(two, ["label", "dims"]).filter((F.col("cell1") <= F.col("cell2")) & (gap <= F.col("radius1") + F.col("radius2") + limit))
    # blocks of cells that may hold linked points; each pair once
    jobs = meets.select("label", "dims", "cell1", "cell2", F.explode(F.sequence(F.lit(0), F.col("blocks1") - 1)).alias("block1"), "blocks2")
    jobs = jobs.select("label", "dims", "cell1", "cell2", "block1", F.explode(F.sequence(F.lit(0), F.col("blocks2") - 1)).alias("block2"))
    jobs = cut(spark, jobs.filter((F.col("cell1") < F.col("cell2")) | (F.col("block1") <= F.col("block2"))), "cover-jobs")
    blocked = cut(spark, dealt.join(cells.select("label", "dims", "cell", "blocks"), ["label", "dims", "cell"]).withColumn(
        "block", F.pmod(F.xxhash64(F.lit(7), "node"), F.col("blocks")).cast("int")).select("label", "dims", "cell", "block", "node", "copies", "v"), "cover-blocks")
    place = ["label", "dims", "cell1", "block1", "cell2", "block2"]
    left = blocked.withColumnsRenamed({"cell": "cell1", "block": "block1"}).join(jobs, ["label", "dims", "cell1", "block1"])
    right = again(spark, blocked).withColumnsRenamed({"cell": "cell2", "block": "block2"}).join(
        again(spark, jobs).filter((F.col("cell1") != F.col("cell2")) | (F.col("block1") != F.col("block2"))), ["label", "dims", "cell2", "block2"])

    def meet(key, x: pd.DataFrame, y: pd.DataFrame) -> pd.DataFrame:
        same = key[2] == key[4] and key[3] == key[5]
        if not len(x) or (not same and not len(y)):
            return told(x, x, np.empty(0, np.int64), np.empty(0, np.int64), True)
        tree = CoverTree(np.array(x["v"].tolist()))
        other = tree if same else CoverTree(np.array(y["v"].tolist()))
        return told(x, x if same else y, *dual_pairs(tree, other, cosine, same), same)

    return left.groupBy(*place).cogroup(right.groupBy(*place)).applyInPandas(meet, schema)


def classes(spark: SparkSession, df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
            cosine: float = COSINE) -> DataFrame:
    """(id, n_links, component_id) for every row of ``df``."""
    rows = df.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{label_col}`").cast("string").alias("label"), F.col(f"`{vector_col}`").alias("v"))
    kind = df.schema[id_col].dataType.simpleString()
    rows = cut(spark, rows.mapInArrow(_prepare, f"id {kind}, label string, key binary, v array<double>"), "cover-vectors")
    # one point per different vector of a label; nodes are numbered by the smallest id, or by the digest where ids repeat
    points = rows.filter("key is not null").groupBy("key").agg(
        F.first("label").alias("label"), F.first("v").alias("v"), F.min("id").alias("least"), F.count(F.lit(1)).alias("copies"))
    points = cut(spark, points.withColumn("node", F.xxhash64("key")).withColumn("dims", F.size("v")), "cover-points")
    met = cut(spark, neighbours(spark, points.select("label", "dims", "node", "copies", "v"), cosine), "cover-links")
    others = met.groupBy("node").agg(F.sum("others").alias("others"))
    roots = cut(spark, components(spark, met.select(F.col("node").alias("a"), F.col("to").alias("b"))), "cover-roots")
    placed = points.select("key", "node", "least", "copies").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    least = placed.groupBy("root").agg(F.min("least").alias("component_id"))
    placed = placed.join(least, "root").join(others, "node", "left")
    placed = placed.select("key", "component_id", (F.col("copies") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"))
    return rows.select("id", "key").join(placed, "key", "left").select(
        F.col("id").alias(id_col), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.when(F.col("key").isNull(), F.col("id")).otherwise(F.col("component_id")).alias("component_id"))
