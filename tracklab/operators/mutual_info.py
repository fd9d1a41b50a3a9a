"""Mutual information between features and a class.

The nearest-neighbour estimator follows Ross (2014), in one dimension per feature:
the k-th neighbour inside the class gives a radius, and the points of any class
strictly inside that radius are counted.  Both steps work on value ranges of a
(feature, class) group, so a class or feature never has to be sorted in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from tracklab.operators import ordered
from tracklab.operators.ordered import literal_range_of, quantiles, splitters, with_range
from tracklab.operators.small import checked_broadcast, melt, small_rows
from tracklab.sources.staging import settle, stage

NEIGHBOURS = 3
EULER_GAMMA = 0.5772156649015329


def digamma(n: Column) -> Column:
    """Digamma of a positive integer: exact sums up to 10, the asymptotic series above."""
    small = [-EULER_GAMMA]
    for i in range(1, 10):
        small.append(small[-1] + 1.0 / i)
    x = n.cast("double")
    inv2 = 1.0 / (x * x)
    series = F.ln(x) - 0.5 / x - inv2 * (
        F.lit(1 / 12) - inv2 * (F.lit(1 / 120) - inv2 * (F.lit(1 / 252) - inv2 * F.lit(1 / 240)))
    )
    return F.when(n <= 10, F.get(F.array(*[F.lit(v) for v in small]), n.cast("int") - 1)).otherwise(series)


def discrete_mi(df: DataFrame, columns: Sequence[str], label: str) -> DataFrame:
    """(feature, mutual_info) in nats from the table of value and class counts."""
    cells = _class_rows(df, columns, label)
    joint = settle(cells.groupBy("feature", "value", "_class").agg(F.count("*").alias("_xy")), "mi-counts")
    values = joint.groupBy("feature", "value").agg(F.sum("_xy").alias("_x"))
    classes = checked_broadcast(joint.groupBy("feature", "_class").agg(F.sum("_xy").alias("_y")))
    totals = checked_broadcast(joint.groupBy("feature").agg(F.sum("_xy").alias("_n")))
    n, xy = F.col("_n").cast("double"), F.col("_xy").cast("double")
    term = xy / n * F.ln(xy * n / (F.col("_x").cast("double") * F.col("_y")))
    return _ranked(
        joint.join(values, ["feature", "value"]).join(classes, ["feature", "_class"])
        .join(totals, "feature").groupBy("feature").agg(F.sum(term).alias("mutual_info"))
    )


def binned_mi(df: DataFrame, columns: Sequence[str], label: str, bins: int = 16) -> DataFrame:
    """Mutual information after cutting every feature at its exact quantiles."""
    probs = [i / bins for i in range(1, bins)]
    edges = quantiles(df, columns, probs).groupBy("feature").agg(
        F.sort_array(F.collect_list("value")).alias("edges")
    )
    cuts = {r["feature"]: r["edges"] for r in small_rows(edges)}
    binned = df.select(F.col(label), *[
        F.when(F.col(c).isNotNull(), literal_range_of(cuts.get(c, []), F.col(c).cast("double"))).alias(c)
        for c in columns
    ])
    return discrete_mi(binned, columns, label)


def knn_mi(df: DataFrame, columns: Sequence[str], label: str, k: int = NEIGHBOURS,
           plain_rows: int | None = None) -> DataFrame:
    """(feature, mutual_info) in nats, nearest-neighbour estimate floored at 0."""
    counted = stage(
        _class_rows(df, columns, label).groupBy("feature", "_class", "value").agg(F.count("*").alias("_c")),
        "mi-points",
    )
    plain = counted.count() <= (ordered.PLAIN_WINDOW_ROWS if plain_rows is None else plain_rows)
    sizes = counted.groupBy("feature", "_class").agg(F.sum("_c").alias("_size")).filter("_size > 1")
    sizes = checked_broadcast(sizes)
    points = counted.join(sizes, ["feature", "_class"]).withColumn(
        "_k", F.least(F.lit(k).cast("long"), F.col("_size") - 1)
    )
    radii = stage(_radii(points, k, plain), "mi-radii")
    inside = _inside(radii, plain)
    weight = F.col("_c")
    total = F.sum(weight)

    def mean(column):
        return F.sum(weight * digamma(column)) / total

    estimate = (
        digamma(total) + mean(F.col("_k")) - mean(F.col("_size")) - mean(F.col("_m"))
    )
    return _ranked(inside.groupBy("feature").agg(F.greatest(estimate, F.lit(0.0)).alias("mutual_info")))


def mixed_mi(df: DataFrame, continuous: Sequence[str], discrete: Sequence[str], label: str) -> DataFrame:
    """Codes by their count table, measurements by nearest neighbours."""
    return _ranked(knn_mi(df, continuous, label).unionByName(discrete_mi(df, discrete, label)))


def top_features(scores: DataFrame, n: int = 4) -> DataFrame:
    return _ranked(scores).limit(n)


def _class_rows(df, columns, label):
    rows = df.select(F.col(label).cast("string").alias("_class"), *columns).filter("_class is not null")
    return melt(rows, columns, keep=["_class"]).filter("value is not null")


def _ranked(scores):
    return scores.orderBy(F.desc("mutual_info"), "feature")


def _radii(points: DataFrame, k: int, plain: bool) -> DataFrame:
    """Distance of every distinct (feature, class, value) to its k-th neighbour in the class."""
    keys = ["feature", "_class"]
    # More than k copies of a value are not needed: its radius is 0 already.
    copies = points.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.least(F.col("_c"), F.lit(k + 1)))))
    ranged = with_range(copies, None if plain else splitters(points, keys, "value"), keys, "value")
    group = W.partitionBy(*keys, "_range")
    order = [F.col("value"), F.col("_copy")]
    inside = group.orderBy(*order)
    placed = (
        ranged.withColumn("_pos", F.row_number().over(inside))
        .withColumn("_rows", F.count("*").over(group))
        .withColumns({f"_l{i}": F.lag("value", i).over(inside) for i in range(1, k + 1)})
        .withColumns({f"_r{i}": F.lead("value", i).over(inside) for i in range(1, k + 1)})
    )
    # The k values on either side of a range, from the first and last k rows of all ranges.
    edges = ranged.withColumn("_pos", F.row_number().over(inside)).withColumn(
        "_rows", F.count("*").over(group)
    ).filter((F.col("_pos") <= k) | (F.col("_pos") > F.col("_rows") - k))
    along = W.partitionBy(*keys).orderBy(*order)
    spot = F.struct("value", "_copy")
    around = checked_broadcast(
        edges.withColumns({
            "_before": F.array(*[F.lag("value", i).over(along) for i in range(1, k + 1)]),
            "_after": F.array(*[F.lead("value", i).over(along) for i in range(1, k + 1)]),
        }).groupBy(*keys, "_range").agg(
            F.min_by("_before", spot).alias("_before"), F.max_by("_after", spot).alias("_after")
        )
    )
    gaps = []
    for i in range(1, k + 1):
        left = F.coalesce(F.col(f"_l{i}"), F.get("_before", F.lit(i) - F.col("_pos")))
        after_end = F.lit(i - 1) - (F.col("_rows") - F.col("_pos"))
        right = F.coalesce(F.col(f"_r{i}"), F.get("_after", after_end.cast("int")))
        gaps += [F.col("value") - left, right - F.col("value")]
    nearest = F.sort_array(F.array_compact(F.array(*gaps)))
    return (
        placed.filter("_copy = 1")
        .join(around, [*keys, "_range"])
        .select(*keys, "value", "_c", "_size", "_k",
                F.get(nearest, (F.col("_k") - 1).cast("int")).alias("_d"))
    )


def _end(x: Column, d: Column, side: int) -> Column:
    """(_x, _lo, _even): the exact end of the points whose computed distance from ``x`` is below ``d``.

    A distance rounds up to ``d`` from half a unit below it, so the end is x + side * (d - unit / 2),
    given as a sum of two doubles.  A distance right at the half unit rounds to the even one.
    """
    power = F.pow(F.lit(2.0), F.floor(F.log2(d)))
    power = F.when(power > d, power / 2).when(power * 2 <= d, power * 2).otherwise(power)
    unit = power * 2.0 ** -52
    half = F.when(power == d, unit / 4).otherwise(unit / 2)
    step = d * side
    total = x + step
    back = total - x
    rest = (x - (total - back)) + (step - back) - half * side
    high = total + rest
    zero = d == 0
    return F.struct(
        F.when(zero, x).otherwise(high).alias("x"), F.when(zero, 0.0).otherwise(rest - (high - total)).alias("lo"),
        (F.pmod(d / unit, F.lit(2.0)) == 0).alias("even"))


def _inside(radii: DataFrame, plain: bool) -> DataFrame:
    """Adds ``_m``: points of any class nearer than the radius; with radius 0, those of equal value.

    Interval ends are merged with the points in value order; a running count at both
    ends gives the points between them.  The ends are exact, so that the points are those
    whose distance, as computed, is below the radius.
    """
    x, d = F.col("value"), F.col("_d")
    point = ["feature", "_class", "value"]
    data = radii.groupBy("feature", "value").agg(F.sum("_c").alias("_w")).select(
        "feature", F.lit(None).cast("string").alias("_class"), F.col("value"),
        F.col("value").alias("_x"), F.lit(0.0).alias("_lo"), F.lit(1).alias("_ord"), "_w",
    )
    # Order at one place: ends that leave the points there out of the sum (0), the points (1), ends that take them in (2).
    zero = F.col("_d") == 0
    placed = radii.withColumns({"_up": _end(x, d, 1), "_down": _end(x, d, -1)})
    ends = placed.select(*point, F.inline(F.array(
        F.struct(F.col("_up.x").alias("_x"), F.col("_up.lo").alias("_lo"),
                 F.when(zero | ~F.col("_up.even"), 2).otherwise(0).alias("_ord"), F.lit(1).alias("_sign")),
        F.struct(F.col("_down.x").alias("_x"), F.col("_down.lo").alias("_lo"),
                 F.when(zero | ~F.col("_down.even"), 0).otherwise(2).alias("_ord"), F.lit(-1).alias("_sign")),
    )))
    both = data.withColumn("_sign", F.lit(0)).unionByName(
        ends.withColumn("_w", F.lit(0).cast("long"))
    )
    ranged = with_range(both, None if plain else splitters(data, ["feature"], "_x"), ["feature"], "_x")
    before = W.partitionBy("feature").orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    offsets = checked_broadcast(
        ranged.groupBy("feature", "_range").agg(F.sum("_w").alias("_t"))
        .select("feature", "_range", F.coalesce(F.sum("_t").over(before), F.lit(0)).alias("_o"))
    )
    upto = W.partitionBy("feature", "_range").orderBy("_x", "_lo", "_ord").rangeBetween(
        W.unboundedPreceding, W.currentRow)
    counts = (
        ranged.withColumn("_seen", F.sum("_w").over(upto))
        .filter("_sign <> 0")
        .join(offsets, ["feature", "_range"])
        .groupBy(*point)
        .agg(F.sum(F.col("_sign") * (F.col("_seen") + F.col("_o"))).alias("_m"))
    )
    return radii.join(counts, point)
