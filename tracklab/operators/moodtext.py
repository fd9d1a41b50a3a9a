"""Text to class by counting distinct keywords found as substrings (L1-L3)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracklab import schema as S
from tracklab.functions.features import first_argmax

GENRES = list(S.MOOD_KEYWORDS)


def _hits(text: Column, keywords: Sequence[str]) -> Column:
    found = [text.contains(k).cast("int") for k in keywords]
    return sum(found[1:], found[0])


def mood(df: DataFrame, text: str = "text") -> DataFrame:
    """Adds ``mood`` and one ``share_<class>`` column per class; map-only, whole texts.

    Null text counts as empty.  Without any keyword every share is 1/6 and the mood is
    the default class.
    """
    lowered = df.withColumn("_text", F.lower(F.coalesce(F.col(text), F.lit(""))))
    counted = lowered.withColumns(
        {f"_n_{g}": _hits(F.col("_text"), S.MOOD_KEYWORDS[g]) for g in GENRES}
    ).drop("_text")
    hits = [F.col(f"_n_{g}") for g in GENRES]
    total = sum(hits[1:], hits[0])
    none = total == 0
    return counted.withColumns({
        "mood": F.when(none, F.lit(S.MOOD_DEFAULT)).otherwise(first_argmax(GENRES, hits)),
        **{f"share_{g}": F.when(none, F.lit(1.0 / len(GENRES))).otherwise(
            F.try_divide(F.col(f"_n_{g}").cast("double"), total.cast("double"))) for g in GENRES},
    }).drop(*[f"_n_{g}" for g in GENRES])


def mood_scores(df: DataFrame, keep: Sequence[str], text: str = "text") -> DataFrame:
    """Long form: ``keep`` columns, mood, genre, share."""
    return mood(df, text).select(*keep, "mood", F.inline(F.array(*[
        F.struct(F.lit(g).alias("genre"), F.col(f"share_{g}").alias("share")) for g in GENRES
    ])))


def active_text(free: Column, quick: Column) -> Column:
    """Free text wins over the quick choice unless it is empty (L2)."""
    return F.coalesce(F.nullif(free, F.lit("")), quick)
