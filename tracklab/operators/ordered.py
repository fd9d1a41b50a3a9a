"""Order statistics and running totals that never sort a whole group in one task.

A plain ``sum(...) over (partition by k order by x)`` puts all of ``k`` in one task,
and ``percentile`` keeps all distinct values in one aggregation buffer.  Here a group
is first cut into value ranges by approximate splitters.  The splitters only balance
the work: counts per range turn positions inside a range into exact positions in the
group, so results do not depend on how good the approximation was.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from tracklab import schema as S
from tracklab.operators.small import checked_broadcast, literal_table, melt, small_rows
from tracklab.sources.staging import stage

# Up to this many rows the built-in percentile aggregate is used as it is.
PERCENTILE_ROWS = 2_000_000
# Rank error of a splitter is at most rows / SKETCH_ACCURACY.
SKETCH_ACCURACY = 10_000
RANGES = 256
# Up to this many rows in all, a key is sorted as a whole.
PLAIN_WINDOW_ROWS = 4_000_000
# Beyond this many rows splitters come from a sample of about as many: they only balance the ranges.
SPLIT_ROWS = 4_000_000
# Rows of a task that sorts ranges: more rows get more tasks.
TASK_ROWS = 1_000_000
# Ranges of a task: of many small ones every task gets about as many rows.
TASK_RANGES = 8
# Ranges of all keys together, beyond RANGES for each.
ALL_RANGES = 100_000
# Keys whose splitters travel with the tasks as arrays.
PLACED_KEYS = 1_000


def range_of(splits: Column, value: Column, max_splits: int = RANGES) -> Column:
    """Number of ``splits`` (sorted array) that are <= ``value``, by binary search."""
    steps = [2 ** i for i in reversed(range(max_splits.bit_length()))]
    return F.aggregate(
        F.array(*[F.lit(s) for s in steps]),
        F.lit(0),
        lambda pos, step: F.when(F.get(splits, pos + step - 1) <= value, pos + step).otherwise(pos),
    )


def literal_range_of(edges: Sequence[float], value: Column) -> Column:
    """``range_of`` for a few known edges: a balanced tree of comparisons in generated code."""
    def search(low: int, high: int) -> Column:
        if low == high:
            return F.lit(low)
        middle = (low + high) // 2
        return F.when(value >= F.lit(edges[middle]), search(middle + 1, high)).otherwise(search(low, middle))

    return search(0, len(edges))


def splitters(df: DataFrame, keys: Sequence[str], order: str, ranges: int = RANGES) -> DataFrame:
    """One row per key with the array of values that cut its rows into even ranges."""
    probs = [i / ranges for i in range(1, ranges)]
    return checked_broadcast(
        df.groupBy(*keys).agg(
            F.percentile_approx(order, probs, SKETCH_ACCURACY).alias("_splits")
        ),
        max_rows=20_000,
    )


def ranges_for(df: DataFrame, keys: Sequence[str]) -> int:
    """Ranges per key, by the rows of the largest one: a range stays as small as it is while tables grow."""
    size = df.groupBy(*keys).count().agg(F.max("count").alias("largest"), F.count("*").alias("keys")).first()
    wanted = math.ceil(TASK_RANGES * (size["largest"] or 0) / TASK_ROWS)
    return max(RANGES, min(wanted, SKETCH_ACCURACY // 2, ALL_RANGES // max(size["keys"], 1)))


def with_range(df: DataFrame, splits: DataFrame | None, keys: Sequence[str], order: str,
               out: str = "_range", ranges: int = RANGES) -> DataFrame:
    """Tag rows with the range of their key they fall into; map-only for a small ``splits``.

    Without ``splits`` every key is one range.
    """
    if splits is None:
        return df.withColumn(out, F.lit(0))
    return (
        df.join(splits, list(keys), "left")
        .withColumn(out, range_of(F.col("_splits"), F.col(order), ranges))
        .drop("_splits")
    )


def placed(df: DataFrame, splits: DataFrame, keys: Sequence[str], order: str, out: str = "_range", ranges: int = RANGES) -> DataFrame:
    """``with_range`` by array searches over whole batches, for few keys and a double order; a key without splits is one range."""
    rows = splits.take(PLACED_KEYS + 1)
    if len(rows) > PLACED_KEYS or df.schema[order].dataType.simpleString() != "double":
        return with_range(df, splits, keys, order, out, ranges)
    edges = [np.array(r["_splits"] or [], np.float64) for r in rows]

    @F.pandas_udf("int")
    def place(group: pd.Series, value: pd.Series) -> pd.Series:
        groups, values = group.to_numpy(), value.to_numpy(np.float64)
        found = np.zeros(len(values), np.int32)
        for g in np.unique(groups[groups >= 0]):
            found[groups == g] = np.searchsorted(edges[g], values[groups == g], side="right")
        return pd.Series(found)

    kinds = ", ".join(f"`{k}` {df.schema[k].dataType.simpleString()}" for k in keys)
    numbers = literal_table(df.sparkSession, [(*[r[k] for k in keys], i) for i, r in enumerate(rows)], f"{kinds}, _group int")
    where = F.when(F.col(order).isNull(), F.lit(0)).otherwise(place(F.coalesce("_group", F.lit(-1)), order))
    return df.join(F.broadcast(numbers), list(keys), "left").withColumn(out, where).drop("_group")


def running_totals(df: DataFrame, keys: Sequence[str], order: str, totals: dict[str, str],
                   plain_rows: int | None = None, sums: Sequence[str] = ()) -> DataFrame:
    """Exact running sums of ``totals`` (output name -> column) per key in ``order``.

    Rows should be unique in (keys, order): aggregate ties first, so that no single
    value can fill a range, or name the columns to be summed over ties as ``sums``: the exchange that
    deals out the ranges then brings ties together too.  ``df`` is read several times; pass a staged table.
    """
    return _running(df, keys, order, totals, F.sum,
                    lambda own, earlier: own + F.coalesce(earlier, F.lit(0)), plain_rows, sums)


def running_max(df: DataFrame, keys: Sequence[str], order: str, maxima: dict[str, str],
                plain_rows: int | None = None) -> DataFrame:
    """Exact running maximum of ``maxima`` (output name -> column) per key in ``order``."""
    return _running(df, keys, order, maxima, F.max, F.greatest, plain_rows)


def _running(df, keys, order, outputs, total, combine, plain_rows, sums=()):
    keys, rows = list(keys), df.count()
    upto = W.orderBy(order).rowsBetween(W.unboundedPreceding, 0)

    def united(df, *more):
        return df.groupBy(*keys, *more, order).agg(*[F.sum(c).alias(c) for c in sums]) if sums else df

    if rows <= (PLAIN_WINDOW_ROWS if plain_rows is None else plain_rows):
        return united(df).select("*", *[
            total(c).over(upto.partitionBy(*keys)).alias(out) for out, c in outputs.items()])
    some = df if rows <= SPLIT_ROWS else df.sample(SPLIT_ROWS / rows, S.SEED)
    ranges = ranges_for(df, keys)
    ranged = placed(df, splitters(some, keys, order, ranges), keys, order, ranges=ranges)
    before = W.partitionBy(*keys).orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    offsets = checked_broadcast(
        ranged.groupBy(*keys, "_range")
        .agg(*[total(c).alias(f"_t_{out}") for out, c in outputs.items()])
        .select(*keys, "_range", *[total(f"_t_{out}").over(before).alias(f"_o_{out}") for out in outputs])
    )
    tasks = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), math.ceil(rows / TASK_ROWS))
    dealt = united(ranged.repartition(tasks, *keys, "_range"), "_range")
    inside = upto.partitionBy(*keys, "_range")
    return dealt.join(offsets, [*keys, "_range"]).select(
        *[c for c in dealt.columns if c != "_range"],
        *[combine(total(c).over(inside), F.col(f"_o_{out}")).alias(out) for out, c in outputs.items()],
    )


def quantiles(df: DataFrame, columns: Sequence[str], probs: Sequence[float],
              by: Sequence[str] = (), percentile_rows: int = PERCENTILE_ROWS) -> DataFrame:
    """Exact linear-interpolation quantiles as rows (by..., feature, prob, value).

    Nulls are ignored.  Inputs of at most ``percentile_rows`` rows use the built-in
    ``percentile``; larger ones only ever sort the values around the wanted ranks.
    """
    if df.count() <= percentile_rows:
        return _buffered_quantiles(df, columns, probs, list(by))
    return _ranged_quantiles(df, columns, probs, list(by))


def _buffered_quantiles(df, columns, probs, by):
    """One aggregation buffer per (group, feature), so features are finished in parallel."""
    keys = [*by, "feature"]
    values = melt(df, columns, keep=by).groupBy(*keys).agg(F.percentile("value", list(probs)).alias("_q"))
    rows = F.array(*[
        F.struct(F.lit(float(p)).alias("prob"), F.get("_q", F.lit(i)).alias("value")) for i, p in enumerate(probs)
    ])
    return values.select(*keys, F.inline(rows))


def _ranged_quantiles(df, columns, probs, by):
    keys = [*by, "feature"]
    rows = melt(df, columns, keep=by).filter(F.col("value").isNotNull())
    margin = 2 / SKETCH_ACCURACY
    brackets = sorted({min(max(p + d, 0.0), 1.0) for p in probs for d in (-margin, margin)})
    stats = checked_broadcast(
        rows.groupBy(*keys).agg(
            F.count("*").alias("_n"),
            F.percentile_approx("value", brackets, SKETCH_ACCURACY).alias("_splits"),
        )
    )
    known = {} if by else {r["feature"]: r["_splits"] for r in small_rows(stats.select("feature", "_splits"))}
    if known:  # columns as a whole: brackets are compared in generated code, before a row is melted
        cells = {c: F.col(c).cast("double") for c in columns if c in known}
        ranged = df.select(F.inline(F.array(*[
            F.struct(F.lit(c).alias("feature"), x.alias("value"), literal_range_of(known[c], x).alias("_bracket")) for c, x in cells.items()
        ]))).filter(F.col("value").isNotNull())
    else:
        ranged = (
            rows.join(stats.drop("_n"), keys)
            .withColumn("_bracket", range_of(F.col("_splits"), F.col("value"), len(brackets)))
            .drop("_splits")
        )
    before = W.partitionBy(*keys).orderBy("_bracket").rowsBetween(W.unboundedPreceding, -1)
    counts = ranged.groupBy(*keys, "_bracket").agg(F.count("*").alias("_c")).withColumn(
        "_before", F.coalesce(F.sum("_c").over(before), F.lit(0))
    )
    # Both neighbours of every wanted position, with the bracket that holds each.
    position = (F.col("_n") - 1) * F.col("prob")
    wanted = (
        stats.drop("_splits")
        .withColumn("prob", F.explode(F.array(*[F.lit(float(p)) for p in probs])))
        .withColumn("_side", F.explode(F.array(F.lit("lo"), F.lit("hi"))))
        .withColumn("_rank", F.when(F.col("_side") == "lo", F.floor(position)).otherwise(F.ceil(position)))
        .join(counts, keys)
        .filter((F.col("_rank") >= F.col("_before")) & (F.col("_rank") < F.col("_before") + F.col("_c")))
        .withColumn("_weight", position - F.floor(position))
        .select(*keys, "prob", "_side", "_rank", "_bracket", "_before", "_weight")
    )
    small = checked_broadcast(wanted)
    hit = small.select(*keys, "_bracket").distinct()
    if small is not wanted:  # no larger than the frame that was proven small
        hit = F.broadcast(hit)
    wanted = small
    candidates = stage(
        ranged.join(hit, [*keys, "_bracket"], "left_semi")
        .groupBy(*keys, "_bracket", "value").agg(F.count("*").alias("_c")),
        "quantile-candidates",
    )
    sorted_candidates = running_totals(candidates, [*keys, "_bracket"], "value", {"_upto": "_c"})
    ends = sorted_candidates.join(wanted, [*keys, "_bracket"]).filter(
        (F.col("_rank") < F.col("_before") + F.col("_upto"))
        & (F.col("_rank") >= F.col("_before") + F.col("_upto") - F.col("_c"))
    )
    lo = F.max(F.when(F.col("_side") == "lo", F.col("value")))
    hi = F.max(F.when(F.col("_side") == "hi", F.col("value")))
    weight = F.max("_weight")
    return ends.groupBy(*keys, "prob").agg((lo * (1 - weight) + hi * weight).alias("value")).select(
        *keys, "prob", "value"
    )

