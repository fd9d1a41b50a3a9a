"""Hard negatives of anchors: rows of another label whose score lies in a window below a positive's.

Vectors become integers, a row's score is its inner product with the anchor, and all results
are exact.  Rows are sorted by label and first coordinate and cut into trees of equally many
rows, however many have the same label; a tree's task packs its rows sort-tile-recursively
into an R-tree.  A box of the tree bounds every coordinate, so it gives an interval of inner
products for an anchor: the sum of the lesser, and of the greater, of the two products per
coordinate.  A best-first queue visits boxes by their greatest possible score and skips a box
when its interval misses all windows of an anchor or stays strictly below the kth score found
there.  Anchors of a tree come as a stream of rows in blocks, and the best of every tree are
merged by a ranked window.

Rows without id, label or vector, or with a null or non-finite component, take no part.
Vectors of different lengths are filled with zeros; an empty vector scores 0 with every other.
Components are cut to +-2**26 after scaling, which keeps sums exact for up to 2,048 of them.
Equal scores are ordered by id.  Repeated rows count one by one: each is an anchor of its own,
and its repeat is another row.  Other columns, whatever their names, are not read.  An empty
table, or one without anchors, gives an empty result.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tracklab.llm.common import slots
from tracklab.operators.small import checked_broadcast, literal_table
from tracklab.sources.staging import stage

# Rows of a tree at most; smaller trees where these would not fill the task slots.
TREE_ROWS, LEAST_TREE_ROWS = 1 << 16, 1 << 9
# Rows of a leaf, children of a box, anchors that share a queue.
LEAF, FANOUT, BLOCK = 256, 8, 128
# Greatest component, and the sum up to which double arithmetic is exact.
COMPONENT, EXACT = 1 << 26, 1 << 53
LEAST, MOST = -(1 << 62), 1 << 62

_RESULT = ("anchor_id long, positive_rank int, positive_id long, positive_score long, rank int, negative_id long, "
           "negative_score long")
_FOUND = "vec_id long, label long, print long, window int, score long, found_id long, twin boolean"


def scaled(df: DataFrame, scale: int = 256, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label") -> DataFrame:
    """(vec_id, label, v) of the rows that take part, ``v`` the floors of the scaled components."""
    v, inf = F.col(f"`{vector}`"), float("inf")
    odd = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == inf))
    sound = F.col(f"`{vec_id}`").isNotNull() & F.col(f"`{label}`").isNotNull() & v.isNotNull() & ~odd

    def whole(x: Column) -> Column:
        return F.least(F.greatest(F.floor(x.cast("double") * float(scale)), F.lit(-COMPONENT)), F.lit(COMPONENT)).cast("int")

    return df.filter(sound).select(F.col(f"`{vec_id}`").cast("long").alias("vec_id"),
                                   F.col(f"`{label}`").cast("long").alias("label"), F.transform(v, whole).alias("v"))


def matrix(lists: pa.ListArray, width: int = 0) -> np.ndarray:
    """Rows of a list array as int64, filled with zeros to the longest (``width`` at least)."""
    lengths = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
    width = max(width, int(lengths.max(initial=0)))
    flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    if len(flat) == len(lists) * width:
        return flat.reshape(len(lists), width)
    out = np.zeros((len(lists), width), np.int64)
    out[np.arange(width)[None, :] < lengths[:, None]] = flat
    return out


def widened(a: np.ndarray, width: int) -> np.ndarray:
    return a if a.shape[1] >= width else np.pad(a, ((0, 0), (0, width - a.shape[1])))


class RTree:
    """Boxes over rows that are packed by sorting, tiling and going on within the tiles.

    One subtree per label; every tile is cut along the coordinate in which it is widest.
    """

    def __init__(self, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray):
        self.order: list[np.ndarray] = []
        self.low, self.high, self.label, self.children, self.rows = [], [], [], [], []
        self.roots = []
        self._filled = 0
        by_label = np.argsort(labels, kind="stable")
        cuts = np.flatnonzero(np.diff(labels[by_label])) + 1
        for rows in np.split(by_label, cuts):
            if len(rows):
                self.roots.append(self._pack(rows, ids, int(labels[rows[0]]), vectors))
        order = np.concatenate(self.order) if self.order else np.empty(0, np.int64)
        self.ids, self.vectors = ids[order], vectors[order]
        self.low, self.high = np.array(self.low), np.array(self.high)
        self.peak = int(np.abs(vectors).max(initial=0))

    def _pack(self, rows: np.ndarray, ids: np.ndarray, label: int, vectors: np.ndarray) -> int:
        node, low, high = len(self.label), vectors[rows].min(axis=0), vectors[rows].max(axis=0)
        self.low.append(low)
        self.high.append(high)
        self.label.append(label)
        self.children.append(())
        self.rows.append((0, 0))
        if len(rows) <= LEAF:
            self.order.append(rows[np.argsort(ids[rows], kind="stable")])
            self.rows[node] = (self._filled, self._filled + len(rows))
            self._filled += len(rows)
            return node
        if len(low):
            rows = rows[np.argsort(vectors[rows, int(np.argmax(high - low))], kind="stable")]
        leaves = math.ceil(len(rows) / LEAF)
        tile = math.ceil(leaves / FANOUT) * LEAF
        self.children[node] = tuple(self._pack(rows[i:i + tile], ids, label, vectors) for i in range(0, len(rows), tile))
        return node


class Search:
    """The ``k`` best rows in every window, for a block of anchors that share a best-first queue."""

    def __init__(self, tree: RTree, ids, labels, vectors, low, high, same: bool, k: int):
        self.tree, self.k, self.same, self.labels, self.anchor_ids = tree, k, same, labels, ids
        width = max(tree.vectors.shape[1], vectors.shape[1])
        peak = int(np.abs(vectors).max(initial=0)) * tree.peak * max(width, 1)
        self.number = np.float64 if peak < EXACT else np.int64
        self.q = widened(vectors, width).astype(self.number)
        self.plus, self.minus = np.maximum(self.q, 0), np.minimum(self.q, 0)
        self.width = width
        self.low, self.high = low, high
        shape = (*low.shape, k)
        self.score, self.row = np.full(shape, LEAST, np.int64), np.full(shape, -1, np.int64)
        self.id = np.full(shape, MOST, np.int64)
        self.visited = 0

    def _at(self, a: np.ndarray) -> np.ndarray:
        return widened(a, self.width).astype(self.number)

    def _least(self) -> np.ndarray:
        """Score below which a row is of no use, per anchor and window."""
        return np.maximum(self.low, self.score[:, :, -1])

    def _push(self, queue: list, nodes) -> None:
        nodes = [n for n in nodes if ((self.labels == self.tree.label[n]) == self.same).any()]
        if not nodes:
            return
        low, high = self._at(self.tree.low[nodes]).T, self._at(self.tree.high[nodes]).T
        top, bottom = self.plus @ high + self.minus @ low, self.plus @ low + self.minus @ high
        for i, node in enumerate(nodes):
            use = self._useful(node, top[:, i], bottom[:, i])
            if use.any():
                heapq.heappush(queue, (-int(top[use, i].max()), node, top[:, i], bottom[:, i]))

    def _useful(self, node: int, top: np.ndarray, bottom: np.ndarray) -> np.ndarray:
        fits = (top[:, None] >= self._least()) & (bottom[:, None] <= self.high)
        return fits.any(axis=1) & ((self.labels == self.tree.label[node]) == self.same)

    def run(self) -> "Search":
        queue: list = []
        self._push(queue, self.tree.roots)
        while queue:
            _, node, top, bottom = heapq.heappop(queue)
            use = self._useful(node, top, bottom)
            if not use.any():
                continue
            if self.tree.children[node]:
                self._push(queue, self.tree.children[node])
            else:
                self._score(np.flatnonzero(use), *self.tree.rows[node])
        return self

    def _score(self, some: np.ndarray, a: int, b: int) -> None:
        self.visited += len(some) * (b - a)
        scores = (self.q[some] @ self._at(self.tree.vectors[a:b]).T).astype(np.int64)
        least = self._least()
        for w in range(self.low.shape[1]):
            fit = (scores >= least[some, w, None]) & (scores <= self.high[some, w, None])
            hit = np.flatnonzero(fit.any(axis=1))
            if not len(hit):
                continue
            masked = np.where(fit[hit], scores[hit], LEAST)
            best = np.argsort(-masked, axis=1, kind="stable")[:, :self.k]  # rows of a leaf are in order of id
            new, at = np.take_along_axis(masked, best, 1), some[hit]
            row = np.where(new > LEAST, best + a, -1)
            ids = np.where(row >= 0, self.tree.ids[row], MOST)
            score = np.concatenate([self.score[at, w], new], 1)
            ids, row = np.concatenate([self.id[at, w], ids], 1), np.concatenate([self.row[at, w], row], 1)
            keep = np.lexsort((ids, -score), axis=1)[:, :self.k]
            self.score[at, w] = np.take_along_axis(score, keep, 1)
            self.id[at, w], self.row[at, w] = np.take_along_axis(ids, keep, 1), np.take_along_axis(row, keep, 1)

    def found(self) -> tuple[np.ndarray, ...]:
        """(anchor, window, score, id, is it a row equal to the anchor) of all found rows."""
        a, w, i = np.nonzero(self.row >= 0)
        row = self.row[a, w, i]
        twin = self.tree.ids[row] == self.anchor_ids[a]
        if twin.any():
            twin[twin] = (self._at(self.tree.vectors[row[twin]]) == self.q[a[twin]]).all(axis=1)
        return a, w, self.score[a, w, i], self.id[a, w, i], twin


def _answers(same: bool, k: int):
    """Task function: rows of a tree, then its anchors, in a stream of both -> found rows."""
    names = [f.strip().split(" ")[0] for f in _FOUND.split(",")]
    types = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.bool_()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, parts, tree = None, [], None
        for batch in batches:
            trees, kinds = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("tree", "kind"))
            cuts = np.flatnonzero((np.diff(trees) != 0) | (np.diff(kinds) != 0)) + 1
            for a, b in zip([0, *cuts], [*cuts, len(trees)]):
                if a == b:
                    continue
                part = batch.slice(int(a), int(b - a))
                if trees[a] != current:
                    current, parts, tree = trees[a], [], None
                ids, labels = (part.column(c).to_numpy(zero_copy_only=False) for c in ("vec_id", "label"))
                if kinds[a] == 0:
                    parts.append((ids, labels, matrix(part.column("v"))))
                    continue
                if tree is None:
                    width = max(p[2].shape[1] for p in parts)
                    tree = RTree(np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts]),
                                 np.concatenate([widened(p[2], width) for p in parts]))
                    parts = []
                vectors, prints = matrix(part.column("v")), part.column("print").to_numpy(zero_copy_only=False)
                low, high = part.column("low"), part.column("high")
                windows = pc.list_value_length(low).to_numpy(zero_copy_only=False)
                width = int(windows.max(initial=0))
                lows, highs = np.full((len(ids), width), MOST, np.int64), np.full((len(ids), width), LEAST, np.int64)
                there = np.arange(width)[None, :] < windows[:, None]
                lows[there], highs[there] = low.flatten().to_numpy(zero_copy_only=False), high.flatten().to_numpy(zero_copy_only=False)
                for i in range(0, len(ids), BLOCK):
                    s = slice(i, i + BLOCK)
                    n, w, score, found, twin = Search(tree, ids[s], labels[s], vectors[s], lows[s], highs[s], same, k).run().found()
                    columns = [ids[s][n], labels[s][n], prints[s][n], w, score, found, twin]
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)

    return run


def planted(rows: DataFrame) -> tuple[DataFrame, int]:
    """Rows with the number of their tree, and the number of trees.

    A global sort by label, first coordinate and id is staged with a running number within
    its partitions; rows per partition, one number each, turn it into a global place.
    """
    key = ["label", F.coalesce(F.try_element_at("v", F.lit(1)), F.lit(0)), "vec_id"]
    placed = rows.repartitionByRange(*key).sortWithinPartitions(*key).withColumn("place", F.monotonically_increasing_id())
    placed = stage(placed, "mining-rows")
    part = F.shiftright("place", 33)
    counts = sorted((r["part"], r["count"]) for r in placed.groupBy(part.alias("part")).count().collect())
    total, before = 0, []
    for number, count in counts:
        before.append((number, total))
        total += count
    size = min(TREE_ROWS, max(LEAST_TREE_ROWS, math.ceil(total / (2 * slots(rows)))))
    starts = literal_table(rows.sparkSession, before, "part long, before long")
    place = F.col("before") + F.col("place") - F.shiftleft("part", 33)
    trees = (placed.withColumn("part", part).join(F.broadcast(starts), "part")
             .select("vec_id", "label", "v", F.floor(place / size).cast("long").alias("tree")))
    return trees, math.ceil(total / size)


def _searched(trees: DataFrame, count: int, anchors: DataFrame, same: bool, k: int) -> DataFrame:
    """The ``k`` best of every window, over the trees that ``anchors`` (exploded to them) name."""
    columns = ["tree", "kind", "vec_id", "label", "v", "print", "low", "high"]
    none = F.lit(None)
    rows = trees.select("tree", F.lit(0).alias("kind"), "vec_id", "label", "v", none.cast("long").alias("print"),
                        none.cast("array<long>").alias("low"), none.cast("array<long>").alias("high"))
    both = rows.unionByName(anchors.withColumn("kind", F.lit(1)).select(*columns))
    found = (both.repartition(min(4 * count, 20_000), "tree").sortWithinPartitions("tree", "kind", "label")
             .mapInArrow(_answers(same, k), _FOUND))
    order = Window.partitionBy("vec_id", "label", "print", "window").orderBy(F.desc("score"), "found_id", "twin")
    return found.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= k)


def mine(df: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 3, window: tuple[int, int] = (50, 95)) -> DataFrame:
    """Positives and hard negatives of the anchors of a (vec_id, label, v) table.

    A positive is one of an anchor's first ``positives`` other rows of its label.  Its negatives
    are the first ``negatives`` rows of another label whose score times 100 lies between the two
    percentages of ``window`` of the positive's score.  Gives (anchor_id, positive_rank, positive_id,
    positive_score, rank, negative_id, negative_score), a row per negative.
    """
    spark = df.sparkSession
    rows = stage(df.select("vec_id", "label", "v"), "mining-vectors")
    trees, count = planted(rows)
    if not count:
        return literal_table(spark, [], _RESULT)
    trees = stage(trees, "mining-trees")
    key = ["vec_id", "label", "print"]
    anchors = rows.filter(is_anchor).withColumn("print", F.xxhash64("v")).groupBy(*key).agg(
        F.first("v").alias("v"), F.count("*").alias("repeats"))
    anchors = stage(anchors, "mining-anchors")

    span = checked_broadcast(trees.groupBy("label").agg(F.min("tree").alias("a"), F.max("tree").alias("b")))
    whole = anchors.join(span, "label").withColumn("tree", F.explode(F.sequence("a", "b"))).withColumn(
        "low", F.array(F.lit(LEAST))).withColumn("high", F.array(F.lit(MOST)))
    best = _searched(trees, count, whole, True, positives + 1)
    # The anchor itself is one of the rows equal to it; equal rows are alike, so the first one goes.
    own = F.col("twin") & (F.row_number().over(Window.partitionBy(*key, "twin").orderBy("place")) == 1)
    rank = F.row_number().over(Window.partitionBy(*key).orderBy("place"))
    good = stage(best.withColumn("own", own).filter(~F.col("own")).withColumn("positive_rank", rank).filter(F.col("positive_rank") <= positives)
                 .select(*key, "positive_rank", F.col("found_id").alias("positive_id"), F.col("score").alias("positive_score")),
                 "mining-positives")

    low, high = window
    bounds = F.expr(f"transform(p, x -> -((-{low} * x.positive_score - pmod(-{low} * x.positive_score, 100L)) div 100))")
    tops = F.expr(f"transform(p, x -> ({high} * x.positive_score - pmod({high} * x.positive_score, 100L)) div 100)")
    windows = (good.groupBy(*key).agg(F.sort_array(F.collect_list(F.struct("positive_rank", "positive_score"))).alias("p"))
               .withColumn("low", bounds).withColumn("high", tops))
    asked = anchors.join(windows, key).withColumn("tree", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(count - 1).cast("long"))))
    near = _searched(trees, count, asked, False, negatives).select(
        *key, (F.col("window") + 1).alias("positive_rank"), F.col("place").alias("rank"), F.col("found_id").alias("negative_id"),
        F.col("score").alias("negative_score"))
    out = good.join(near, [*key, "positive_rank"]).join(anchors.select(*key, "repeats"), key)
    out = out.withColumn("repeat", F.explode(F.sequence(F.lit(1).cast("long"), "repeats")))
    return out.select(F.col("vec_id").alias("anchor_id"), "positive_rank", "positive_id", "positive_score", "rank",
                      "negative_id", "negative_score")
