"""Mixing sources to target weights by capped water-filling.

A source's target is its weighted share of the mix; a target above ``max_epochs`` times the
source's size stops there and the excess goes to the other sources in proportion to their
weights, until no target is above its bound.  A source is then taken in whole repetitions
and one seeded fraction: its documents in the order of a keyed hash, up to the exact word.
"""

from __future__ import annotations

from fractions import Fraction

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from tracklab.llm.common import sheltered, word_count
from tracklab.sources.staging import stage

WEIGHTS = (5, 2, 1)
SHARE = Fraction(3, 2)
MAX_EPOCHS = 2
SEED = "mix-1"
# The leading hex digits of the order key make the ranges in which the cut is searched first.
RANGE_DIGITS = 4


def order_key(doc_id: Column, text: Column, seed: str = SEED) -> Column:
    """Seeded order of documents: equal for equal rows only, the same in every run."""
    return F.md5(F.concat(F.lit(f"{seed}|"), F.coalesce(doc_id.cast("string"), F.lit("")), F.lit("|"),
                          F.coalesce(text, F.lit(""))).cast("binary"))


def sized(df: DataFrame, doc_id: str = "doc_id", text: str = "text", seed: str = SEED) -> DataFrame:
    """``df`` with ``size`` (words of the text, null has none) and ``order_key``."""
    return df.withColumns({"size": word_count(F.col(text)), "order_key": order_key(F.col(doc_id), F.col(text), seed)})


def fill(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: Fraction = SHARE,
         max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """Targets of a table (source, source_size), one row per source.

    Weights repeat over the sources by code point, null last.  Every round clamps the
    targets above their bound; only the totals of a round reach the driver.
    """
    rank = F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (rank % len(weights) + 1).cast("int"))
    table = stage(sources.select("source", "source_size", weight.cast("long").alias("weight")), "mix-sources")
    big = "decimal(38,0)"
    num, den = share.numerator, share.denominator
    bound = F.col("source_size") * max_epochs
    total = table.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0]
    left, weight_left, rounds = num * total, None, [F.lit(False)]
    while True:
        # A source stays clamped once a round has clamped it: the level only rises.
        clamped = rounds[-1]
        got = table.agg(
            F.sum(F.when(clamped, bound).otherwise(0)).alias("given"),
            F.sum(F.when(clamped, 0).otherwise(F.col("weight"))).alias("weight"),
            F.sum(clamped.cast("long")).alias("n"),
        ).first()
        left = num * total - den * int(got["given"] or 0)
        weight_left = int(got["weight"] or 0)
        if not weight_left:
            break
        above = F.lit(left).cast(big) * F.col("weight").cast(big) > bound.cast(big) * F.lit(den * weight_left).cast(big)
        more = table.agg(F.sum((clamped | above).cast("long"))).first()[0] or 0
        if more == (got["n"] or 0):
            break
        rounds.append(above)
    level = F.lit(float(left)) * F.col("weight") / F.lit(float(den * max(weight_left, 1)))
    target = F.when(rounds[-1], bound.cast("double")).otherwise(level)
    words = F.floor("target").cast("long")
    copies = F.when(F.col("source_size") > 0, F.floor(words / F.col("source_size"))).otherwise(0).cast("long")
    return (
        table.withColumn("target", target).withColumn("copies", copies)
        .withColumn("rest", F.when(F.col("source_size") > 0, words - F.col("copies") * F.col("source_size")).otherwise(F.lit(0).cast("long")))
        .drop("weight")
    )


@sheltered("_source", "_range", "_s", "_c", "_cut", "_before", "copies", "rest", "_extra")
def mix(df: DataFrame, source: str = "source", weights: tuple[int, ...] = WEIGHTS, share: Fraction = SHARE,
        max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """Rows of a ``sized`` table with ``source_size``, ``target`` and ``taken``.

    ``taken`` counts the words that the mix takes of a row, repetitions included: the whole
    repetitions of its source, one more for rows before the source's cut, and the words up to
    the cut of the row that holds it.  It never exceeds ``max_epochs`` times the row's size,
    and a source's rows sum to its target rounded down.  Null sources are one source; empty
    texts are taken 0 times; repeated rows are taken separately; an empty table gives none.
    Columns of the input with a result's name are replaced.

    A source is never gathered: its totals per range of keys find the range of the cut, and
    only rows of that range are put in order.
    """
    base = df.drop("source_size", "target", "taken").withColumns({
        "_source": F.col(source).cast("string"), "_range": F.substring("order_key", 1, RANGE_DIGITS),
    })
    ranges = stage(base.groupBy("_source", "_range").agg(F.sum("size").alias("words")), "mix-ranges")
    targets = fill(
        ranges.groupBy(F.col("_source").alias("source")).agg(F.sum("words").alias("source_size")),
        weights, share, max_epochs,
    ).withColumnRenamed("source", "_s")
    # One row per source and key range: at most 16 ** RANGE_DIGITS in a window.
    running = ranges.withColumn("upto", F.sum("words").over(
        W.partitionBy("_source").orderBy("_range").rowsBetween(W.unboundedPreceding, 0)))
    cuts = running.join(targets, F.col("_source").eqNullSafe(F.col("_s"))).filter(
        (F.col("upto") > F.col("rest")) & (F.col("upto") - F.col("words") <= F.col("rest"))
    ).groupBy("_s").agg(
        F.min("_range").alias("_cut"), F.min(F.col("upto") - F.col("words")).alias("_before"))
    cuts = cuts.withColumnRenamed("_s", "_c")
    plan = stage(targets.join(cuts, F.col("_s").eqNullSafe(F.col("_c")), "left").drop("_c"), "mix-plan")
    rows = base.join(plan, F.col("_source").eqNullSafe(F.col("_s")))
    # A source without a cut has only empty texts.
    whole = F.when(F.col("_range") < F.col("_cut"), F.col("size")).otherwise(F.lit(0).cast("long"))
    at_cut = F.coalesce(F.col("_range") == F.col("_cut"), F.lit(False))
    order = W.partitionBy("_source").orderBy("order_key").rowsBetween(W.unboundedPreceding, 0)
    room = F.col("rest") - F.col("_before") - (F.sum("size").over(order) - F.col("size"))
    extra = F.greatest(F.least(room, F.col("size")), F.lit(0).cast("long"))
    both = rows.filter(~at_cut).withColumn("_extra", whole).unionByName(
        rows.filter(at_cut).withColumn("_extra", extra))
    return both.withColumn("taken", F.col("copies") * F.col("size") + F.col("_extra")).drop(
        "_source", "_range", "_s", "_cut", "_before", "copies", "rest", "_extra")
