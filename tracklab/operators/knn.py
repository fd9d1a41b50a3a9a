"""Exact k-nearest-neighbour vote (M9).

A training side of checked size is broadcast as one matrix and queries are scored in
a map-only pass.  A larger one is joined through cells: training rows belong to the nearest of
some pivots, and the distances to the pivots bound the distance of a query to every row of a
cell.  A query first meets the nearest cells that hold k rows; then only the cells whose bound is
not above the kth distance found there.  No row that could be among the k best is skipped.
Queries of near cells are a group of bounded size, which one task keeps with its k best so far; the
blocks of the cells that the group needs go through it.  So a training row is sent once per group
and not a query once per block, and a group gives k rows per query.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle, keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasFeaturesCol, HasLabelCol, HasPredictionCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.window import Window as W

from tracklab.operators.learning import Stored, matrix
from tracklab.operators.small import checked_broadcast, literal_table
from tracklab.sources.staging import stage

# Executors need not have this package installed: its functions travel with the tasks.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

BROADCAST_CELLS = 16_000_000   # rows x dimensions of a training side kept on every executor
BLOCK_ROWS = 5_000
PART_ROWS = 20_000             # queries of a group, which one task answers
SHORT_ROWS = 2_000             # queries whose distances to all pivots are held at a time
MOST_PIVOTS = 1_000
CHUNK_CELLS = 4_000_000
SPARE = 8                      # candidates measured exactly beyond the k best rough ones


def _nearest(queries: np.ndarray, points: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Point indices and squared distances of the k nearest (or of all points), ties by point order.

    A matrix product finds some more candidates than asked for and these are measured exactly.
    Its rounding error is far below the slack allowed: where the roughly last candidate is not
    farther than the kth by more than that, the query is measured against all points.
    """
    k, m = min(k, len(points)), min(k + SPARE, len(points))
    index, distance = np.empty((len(queries), k), np.int64), np.empty((len(queries), k))
    norms = np.einsum("pd,pd->p", points, points)
    step = max(1, CHUNK_CELLS // max(len(points), m * points.shape[1] if len(points) else 1, 1))
    for start in range(0, len(queries) if k else 0, step):
        chunk = queries[start:start + step]
        own = np.einsum("qd,qd->q", chunk, chunk)
        rough = own[:, None] + norms[None, :] - 2 * chunk @ points.T
        if m < len(points):
            near = np.argpartition(rough, m - 1, axis=1)[:, :m]
            last = np.take_along_axis(rough, near, 1).max(axis=1)
        else:
            near, last = np.broadcast_to(np.arange(m), (len(chunk), m)), np.full(len(chunk), np.inf)
        diff = points[near] - chunk[:, None, :]
        exact = np.einsum("qmd,qmd->qm", diff, diff)
        order = np.lexsort((near, exact), axis=1)[:, :k]
        found, far = np.take_along_axis(near, order, 1), np.take_along_axis(exact, order, 1)
        slack = 1e-9 * (1 + own + norms.max())
        for i in np.flatnonzero(last <= far[:, -1] + slack):
            diff = points - chunk[i]
            whole = np.einsum("pd,pd->p", diff, diff)
            found[i] = np.argsort(whole, kind="stable")[:k]
            far[i] = whole[found[i]]
        index[start:start + step], distance[start:start + step] = found, far
    return index, distance


def _first_others(other: np.ndarray, k: int) -> np.ndarray:
    """Of the places marked in ``other``, the first k of every row."""
    return other & (np.cumsum(other, axis=1) <= k)


def _vote(labels: np.ndarray, use: np.ndarray) -> np.ndarray:
    """Most frequent label of the places in use, the lowest of equally frequent ones; NaN without any."""
    values, codes = np.unique(labels, return_inverse=True)
    codes = codes.reshape(labels.shape)
    rows = np.broadcast_to(np.arange(len(labels))[:, None], labels.shape)
    counts = np.bincount((rows * len(values) + codes)[use], minlength=len(labels) * len(values)).reshape(len(labels), -1)
    return np.where(use.any(axis=1), values[counts.argmax(axis=1)], np.nan) if len(values) else np.full(len(labels), np.nan)


def knn_vote(queries: DataFrame, train: DataFrame, k: int = 7, leave_one_out: bool = False,
             broadcast_cells: int = BROADCAST_CELLS, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(id, prediction): majority label of the k nearest training rows, ties to the lowest label.

    ``queries`` has (id, x array<double>), ``train`` has (id, x, label).  With
    ``leave_one_out`` a row is not its own neighbour.
    """
    table = _small_side(train, broadcast_cells)
    if table is None:
        return _vote_of(neighbours(queries, train, k, leave_one_out, block_rows))
    vote = _broadcast_vote(queries.sparkSession, table, k, leave_one_out)
    return queries.select("id", vote("x", "id" if leave_one_out else F.lit(0)).alias("prediction"))


def _small_side(train: DataFrame, broadcast_cells: int):
    """The training rows as an Arrow table if they fit the bound, else None."""
    head = train.select("x").first()
    limit = max(1, broadcast_cells // max(len(head["x"]) if head else 1, 1))
    if train.count() > limit:
        return None
    return train.select("id", F.col("label").cast("double").alias("label"), "x").toArrow()


def _broadcast_vote(spark, table, k: int, leave_one_out: bool):
    """Column function (x, id) -> voted label against a broadcast training matrix."""
    side = table.to_pandas().sort_values("id")
    ids, labels = side["id"].to_numpy(), side["label"].to_numpy()
    shared = spark.sparkContext.broadcast((ids, labels, np.array(side["x"].tolist(), dtype=float)))

    @F.pandas_udf("double")
    def vote(x: pd.Series, own: pd.Series) -> pd.Series:
        point_ids, point_labels, points = shared.value
        rows = np.array(x.tolist(), dtype=float).reshape(len(x), -1)
        near, _ = _nearest(rows, points, k + leave_one_out)
        other = point_ids[near] != own.to_numpy()[:, None] if leave_one_out else np.ones(near.shape, bool)
        return pd.Series(_vote(point_labels[near], _first_others(other, k)))

    return vote


class _Pivots:
    """Pivots with what is known of their cells: rows, least and greatest distance to the pivot."""

    def __init__(self, points: np.ndarray):
        self.points = points
        self.apart = np.stack([np.sqrt(((points - p) ** 2).sum(axis=1)) for p in points]) if len(points) else np.zeros((0, 0))
        self.rows = self.least = self.most = np.zeros(len(points))

    def distances(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.sqrt(((x - p) ** 2).sum(axis=1)) for p in self.points], axis=1)

    def chain(self) -> list[int]:
        """The pivots in an order in which each follows one that is near."""
        if not len(self.points):
            return []
        left, out = np.ones(len(self.points), bool), [0]
        left[0] = False
        while left.any():
            out.append(int(np.where(left, self.apart[out[-1]], np.inf).argmin()) if np.isfinite(self.apart[out[-1]][left]).any() else int(left.argmax()))
            left[out[-1]] = False
        return out

    def needed(self, x: np.ndarray, kth: np.ndarray, need: int, further: bool) -> np.ndarray:
        """Which cells a query is to meet: first the home cells, ``further`` those that may hold a row at most ``kth`` (squared) away."""
        out = np.zeros((len(x), len(self.points)), bool)
        for a in range(0, len(x), SHORT_ROWS):
            some = slice(a, a + SHORT_ROWS)
            homes = self.home(x[some], need)
            for i, cells in enumerate(homes):
                out[a + i, cells] = True
            if further:
                out[some] = self.within(x[some], np.sqrt(kth[some])) & ~out[some]
        return out

    def home(self, x: np.ndarray, need: int) -> list[list[int]]:
        """The nearest cells that hold ``need`` rows together."""
        order = np.argsort(self.distances(x), axis=1, kind="stable")
        upto = np.cumsum(self.rows[order], axis=1)
        return [o[:int(np.searchsorted(u, need)) + 1].tolist() for o, u in zip(order, upto)]

    def within(self, x: np.ndarray, kth: np.ndarray) -> np.ndarray:
        """Cells that may hold a row at most ``kth`` away, by the rings around and the planes between pivots."""
        d = self.distances(x)
        nearest = d.argmin(axis=1)
        apart = self.apart[nearest]
        # Of pivots that are close together the plane between them says too little to be exact.
        clear = apart > 1e-6 * (1 + d.max(axis=1, initial=0.0))[:, None]
        plane = np.where(clear, (d * d - (d.min(axis=1) ** 2)[:, None]) / (2 * np.where(clear, apart, 1.0)), 0.0)
        bound = np.maximum(np.maximum(d - self.most, self.least - d), plane)
        slack = 1e-9 * (1 + d.max(axis=1, initial=0.0) + kth)
        return (bound <= (kth + slack)[:, None]) & (self.rows > 0)


def neighbours(queries: DataFrame, train: DataFrame, k: int, leave_one_out: bool = False, block_rows: int = BLOCK_ROWS,
               pivots: int | None = None, course: dict | None = None) -> DataFrame:
    """(id, neighbour, label, distance): the k nearest training rows of every query, squared distances.

    Ties go to the lower training id.  ``course`` receives how many pairs of a query and a row were
    compared, and how many there are.
    """
    spark = queries.sparkSession
    rows = stage(train.select(F.col("id").alias("neighbour"), "x", F.col("label").cast("double").alias("label")), "neighbour-rows")
    asked = stage(queries.select("id", "x"), "neighbour-queries")
    total = rows.count()
    if not total:
        none = F.lit(None)
        return asked.limit(0).select("id", none.cast(rows.schema["neighbour"].dataType).alias("neighbour"),
                                     *[none.cast("double").alias(c) for c in ("label", "distance")])
    wanted = min(MOST_PIVOTS, max(1, math.isqrt(total))) if pivots is None else pivots
    sample = rows.select("x").distinct().orderBy(F.xxhash64("x"), "x").limit(wanted).collect()
    known = _Pivots(np.array([r["x"] for r in sample], dtype=float).reshape(len(sample), -1))
    shared = spark.sparkContext.broadcast(vars(known))

    def restored(values: dict) -> _Pivots:
        out = object.__new__(_Pivots)
        vars(out).update(values)
        return out

    @F.pandas_udf("cell int, radius double")
    def placed(x: pd.Series) -> pd.DataFrame:
        d = restored(shared.value).distances(np.array(x.tolist(), dtype=float).reshape(len(x), -1))
        return pd.DataFrame({"cell": d.argmin(axis=1).astype("int32"), "radius": d.min(axis=1)})

    rows = stage(rows.withColumn("p", placed("x")).select("neighbour", "x", "label", "p.cell", "p.radius"), "neighbour-cells")
    known.rows, known.least, known.most = np.zeros(len(sample)), np.zeros(len(sample)), np.zeros(len(sample))
    for r in rows.groupBy("cell").agg(F.count("*").alias("n"), F.min("radius").alias("a"), F.max("radius").alias("b")).collect():
        known.rows[r["cell"]], known.least[r["cell"]], known.most[r["cell"]] = r["n"], r["a"], r["b"]
    full = spark.sparkContext.broadcast(vars(known))
    need = k + leave_one_out

    @F.pandas_udf("array<int>")
    def cells(x: pd.Series, kth: pd.Series, further: pd.Series) -> pd.Series:
        use = restored(full.value).needed(np.array(x.tolist(), dtype=float).reshape(len(x), -1), kth.fillna(np.inf).to_numpy(float), need, bool(further.any()))
        return pd.Series([np.flatnonzero(u).tolist() for u in use], dtype=object)

    asked = stage(asked.withColumn("p", placed("x")).select("id", "x", "p.cell"), "neighbour-asked")
    per_cell = {r["cell"]: r["n"] for r in asked.groupBy("cell").agg(F.count("*").alias("n")).collect()}
    groups = literal_table(spark, _groups(known.chain(), per_cell, 4 * spark.sparkContext.defaultParallelism), "cell int, group int, parts int")
    asked = asked.join(F.broadcast(groups), "cell").withColumn("group", F.col("group") + F.pmod(F.xxhash64("id", "x"), F.col("parts")).cast("int"))
    unknown = asked.select("id", "x", "group", F.lit(None).cast("double").alias("kth"))
    no, yes = F.lit(False), F.lit(True)
    blocks = [math.ceil(n / block_rows) for n in known.rows]

    def met(asked: DataFrame, further: bool) -> DataFrame:
        return _meet(asked, rows, asked.select("group", F.explode(cells("x", "kth", yes if further else no)).alias("cell")).distinct(),
                     lambda: restored(full.value), blocks, need, leave_one_out, further)

    found = stage(met(unknown, False), "neighbour-found")
    by_distance = W.partitionBy("id").orderBy("distance", "neighbour")
    kth = found.withColumn("place", F.row_number().over(by_distance)).filter(F.col("place") == k).select("id", F.col("distance").alias("kth"))
    later = stage(unknown.drop("kth").join(kth, "id", "left"), "neighbour-further")
    if course is not None:
        sizes = literal_table(spark, [(c, int(n)) for c, n in enumerate(known.rows)], "cell int, n long")
        visits = later.select(F.explode(cells("x", "kth", yes)).alias("cell")).unionAll(unknown.select(F.explode(cells("x", "kth", no)).alias("cell")))
        course["compared"] = visits.join(sizes, "cell").agg(F.sum("n")).first()[0] or 0
        course["pairs"] = total * asked.count()
    best = found.unionByName(met(later, True)).withColumn("place", F.row_number().over(by_distance))
    return best.filter(F.col("place") <= k).drop("place")


def _groups(chain: list[int], per_cell: dict[int, int], least: int) -> list[tuple[int, int, int]]:
    """(cell, first group, groups) of the cells that have queries: groups of near cells, and a cell of many queries has several."""
    target = max(1, min(PART_ROWS, math.ceil(sum(per_cell.values()) / least)))
    out, number, held = [], 0, 0
    for cell in chain:
        n = per_cell.get(cell, 0)
        if not n:
            continue
        parts = math.ceil(n / target)
        if held and held + n > target:
            number, held = number + 1, 0
        out.append((cell, number, parts))
        number, held = (number + parts, 0) if parts > 1 else (number, held + n)
    return out


def _meet(asked: DataFrame, rows: DataFrame, wanted: DataFrame, pivots, blocks: list[int], k: int, leave_one_out: bool, further: bool) -> DataFrame:
    """The k nearest rows (others, when left out itself) of every query in the cells that it needs.

    ``wanted`` has the cells of each group.  Where a kth distance is known, rows beyond it are not given.
    """
    spark = asked.sparkSession
    id_type, row_type = asked.schema["id"].dataType, rows.schema["neighbour"].dataType
    cuts = literal_table(spark, [(c, n) for c, n in enumerate(blocks) if n], "cell int, blocks int")
    left = asked.select(
        "group", F.lit(-1).alias("cell"), F.lit(0).alias("block"), "id", F.lit(None).cast(row_type).alias("neighbour"), F.lit(None).cast("double").alias("label"), "x", "kth")
    right = rows.join(F.broadcast(cuts), "cell").join(checked_broadcast(wanted), "cell").select(
        "group", "cell", F.pmod(F.xxhash64("neighbour"), F.col("blocks")).cast("int").alias("block"), F.lit(None).cast(id_type).alias("id"), "neighbour", "label", "x",
        F.lit(None).cast("double").alias("kth"))
    struct = T.StructType([T.StructField("id", id_type), T.StructField("neighbour", row_type), T.StructField("label", T.DoubleType()),
                           T.StructField("distance", T.DoubleType())])
    arrow = to_arrow_schema(struct)
    keep = k - 1 if leave_one_out else k

    def answered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, asking, block, best = None, [], [], None
        for batch in batches:
            key = np.stack([batch.column(i).to_numpy(zero_copy_only=False) for i in range(3)], axis=1)
            cuts = np.flatnonzero((np.diff(key, axis=0) != 0).any(axis=1)) + 1
            for a, b in zip([0, *cuts], [*cuts, len(key)]):
                if a == b:
                    continue
                part, now = batch.slice(int(a), int(b - a)), tuple(key[a])
                if now != at and block:
                    best.meet(at[1], block)
                    block = []
                if at is None or now[0] != at[0]:
                    if best is not None:
                        yield best.rows(arrow)
                    best, asking = None, []
                at = now
                if now[1] < 0:
                    asking.append(part)
                    continue
                if best is None:
                    best = _Best(asking, pivots(), k, keep, leave_one_out, further, arrow)
                block.append(part)
        if block:
            best.meet(at[1], block)
        if best is not None:
            yield best.rows(arrow)

    both = left.unionByName(right).repartition("group").sortWithinPartitions("group", "cell", "block")
    return both.mapInArrow(answered, struct)


class _Best:
    """The queries of a group with their best rows so far."""

    def __init__(self, asking: list[pa.RecordBatch], pivots: _Pivots, k: int, keep: int, leave_one_out: bool, further: bool, arrow: pa.Schema):
        table = pa.Table.from_batches(asking)
        self.id, self.x = table.column("id").combine_chunks(), matrix(table.column("x").combine_chunks())
        self.own = self.id.to_numpy(zero_copy_only=False)
        kth = table.column("kth").to_numpy().astype(float)
        self.limit = np.where(np.isnan(kth), np.inf, kth)
        self.use = pivots.needed(self.x, self.limit, k, further)
        self.k, self.keep, self.leave_one_out = k, keep, leave_one_out
        self.distance = np.full((len(self.x), keep), np.inf)
        self.place = np.full((len(self.x), keep), -1)
        self.ids, self.labels = pa.array([], arrow.types[1]), np.empty(0)

    def meet(self, cell: int, block: list[pa.RecordBatch]) -> None:
        who = np.flatnonzero(self.use[:, cell])
        if not len(who):
            return
        ids = pa.chunked_array([p.column("neighbour") for p in block]).combine_chunks()
        order = np.argsort(ids.to_numpy(zero_copy_only=False), kind="stable")
        ids = ids.take(pa.array(order))
        points, labels = (np.concatenate([f(p) for p in block])[order] for f in (lambda p: matrix(p.column("x")), lambda p: p.column("label").to_numpy(zero_copy_only=False)))
        names = ids.to_numpy(zero_copy_only=False)
        near, distance = _nearest(self.x[who], points, self.k)
        if self.leave_one_out:
            use = _first_others(names[near] != self.own[who][:, None], self.keep)
        else:
            use = np.ones(near.shape, bool)
        use &= ~(distance > np.minimum(self.limit[who], self.distance[who, -1])[:, None])
        some = use.any(axis=1)
        if not some.any():
            return
        who, near, distance, use = who[some], near[some], distance[some], use[some]
        # Rows of this block that are among someone's best are kept; ties go to the lower id.
        hit, code = np.unique(near[use], return_inverse=True)
        first = len(self.ids)
        self.ids, self.labels = pa.concat_arrays([self.ids, ids.take(pa.array(hit))]), np.concatenate([self.labels, labels[hit]])
        place = np.full(near.shape, -1)
        place[use] = first + code
        place = np.concatenate([self.place[who], place], axis=1)
        distance = np.concatenate([self.distance[who], np.where(use, distance, np.inf)], axis=1)
        rank = np.empty(len(self.ids) + 1, np.int64)
        rank[np.argsort(self.ids.to_numpy(zero_copy_only=False), kind="stable")] = np.arange(len(self.ids))
        rank[-1] = len(self.ids)
        order = np.lexsort((rank[place], distance), axis=1)[:, :self.keep]
        self.place[who], self.distance[who] = np.take_along_axis(place, order, 1), np.take_along_axis(distance, order, 1)
        if len(self.ids) > 4 * self.place.size + 1_000_000:
            self.drop_unused()

    def drop_unused(self) -> None:
        held, code = np.unique(self.place, return_inverse=True)
        code = code.reshape(self.place.shape)
        if held[0] < 0:
            held, code = held[1:], code - 1
        self.ids, self.labels, self.place = self.ids.take(pa.array(held)), self.labels[held], code

    def rows(self, arrow: pa.Schema) -> pa.RecordBatch:
        i, j = np.nonzero(self.place >= 0)
        hit = self.place[i, j]
        return pa.RecordBatch.from_arrays([self.id.take(pa.array(i)), self.ids.take(pa.array(hit)), pa.array(self.labels[hit], pa.float64()),
                                           pa.array(self.distance[i, j])], schema=arrow)


def _vote_of(found: DataFrame) -> DataFrame:
    votes = found.groupBy("id", "label").agg(F.count("*").alias("_votes"))
    best = F.max_by("label", F.struct("_votes", -F.col("label")))
    return votes.groupBy("id").agg(best.alias("prediction"))


class KnnClassifier(Estimator, HasFeaturesCol, HasLabelCol, HasPredictionCol,
                    DefaultParamsReadable, DefaultParamsWritable):
    """k-nearest-neighbour classifier; fitting keeps the training rows."""

    k = Param(Params._dummy(), "k", "neighbours that vote", TypeConverters.toInt)

    @keyword_only
    def __init__(self, *, k=7, featuresCol="features", labelCol="label", predictionCol="prediction"):
        super().__init__()
        self._setDefault(k=7)
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> "KnnModel":
        train = dataset.select(
            vector_to_array(self.getFeaturesCol()).alias("x"), F.col(self.getLabelCol()).alias("label"),
        ).withColumn("id", F.xxhash64("x", "label"))  # ties do not depend on the order of the rows
        model = KnnModel(k=self.getOrDefault(self.k), featuresCol=self.getFeaturesCol(),
                         predictionCol=self.getPredictionCol())
        model.train = train
        return model


class KnnModel(Stored, Model, HasFeaturesCol, HasPredictionCol):
    k = Param(Params._dummy(), "k", "neighbours that vote", TypeConverters.toInt)

    @keyword_only
    def __init__(self, *, k=7, featuresCol="features", predictionCol="prediction"):
        super().__init__()
        self._set(**self._input_kwargs)
        self.train: DataFrame | None = None

    def _transform(self, dataset: DataFrame) -> DataFrame:
        x, k = vector_to_array(self.getFeaturesCol()), self.getOrDefault(self.k)
        table = _small_side(self.train, BROADCAST_CELLS)
        if table is not None:
            vote = _broadcast_vote(dataset.sparkSession, table, k, leave_one_out=False)
            return dataset.withColumn(self.getPredictionCol(), vote(x, F.lit(0)))
        # Equal feature vectors get equal votes, so the vector itself is the join key.
        queries = dataset.select(x.alias("x")).distinct().select(F.to_json("x").alias("id"), "x")
        votes = _vote_of(neighbours(queries, self.train, k)).withColumnsRenamed(
            {"id": "_id", "prediction": self.getPredictionCol()})
        return dataset.withColumn("_id", F.to_json(x)).join(votes, "_id").drop("_id")

    def state(self) -> dict:
        return {}

    def restore(self, state: dict) -> None:
        pass

    def save_tables(self, spark: SparkSession, path: str) -> None:
        self.train.write.parquet(f"{path}/train")

    def load_tables(self, spark: SparkSession, path: str) -> None:
        self.train = spark.read.parquet(f"{path}/train")
