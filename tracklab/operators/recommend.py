"""Playlists, taglines and top tracks for predicted classes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from tracklab import schema as S
from tracklab.functions.features import search_url, track_url
from tracklab.operators.small import literal_table


def playlists(spark: SparkSession) -> DataFrame:
    """(genre, pos, name, desc, query, url)."""
    rows = [(g, i, *p) for g, ps in S.PLAYLISTS.items() for i, p in enumerate(ps, 1)]
    table = literal_table(spark, rows, "genre string, pos int, name string, desc string, query string")
    return table.withColumn("url", search_url(F.col("query")))


def taglines(spark: SparkSession) -> DataFrame:
    return literal_table(spark, S.TAGLINES.items(), "genre string, tagline string")


def recommend_playlists(df: DataFrame, genre: str) -> DataFrame:
    """One row per input row and playlist of its class; no rows for unknown classes.

    Looked up, not joined: a join would test ``genre`` for nulls below it and so score every row twice.
    """
    fields = ("name", "desc", "query")
    found = [F.lit(g) if i == 0 else F.array(*[
        F.struct(F.lit(pos).alias("pos"), *[F.lit(v).alias(f) for f, v in zip(fields, p)], search_url(F.lit(p[2])).alias("url"))
        for pos, p in enumerate(ps, 1)]) for g, ps in S.PLAYLISTS.items() for i in range(2)]
    place = "_playlist"
    while place in df.columns:
        place += "_"
    listed = df.select("*", F.explode_outer(F.try_element_at(F.create_map(*found), F.col(genre))).alias(place))
    return listed.filter(F.col(place).isNotNull()).select(*df.columns, f"{place}.*")


def with_tagline(df: DataFrame, genre: str) -> DataFrame:
    """Adds the class tagline; an unknown class is an error."""
    t = taglines(df.sparkSession).withColumnRenamed("genre", "_genre")
    joined = df.join(F.broadcast(t), F.col(genre) == F.col("_genre"), "left")
    return joined.withColumn("tagline", F.when(F.col("_genre").isNotNull(), F.col("tagline")).otherwise(
        F.raise_error(F.concat(F.lit("unknown class: "), F.coalesce(genre, F.lit("null")))))
    ).drop("_genre")


def top_tracks(df: DataFrame, label: str = S.TARGET, k: int = 5, id_column: str = "track_id") -> DataFrame:
    """The k most popular rows of every label with their link; ties by id.

    The rank filter is pushed below the shuffle by Spark (window group limit), so a
    label ships at most k rows per task.  Without a popularity column the id decides.
    """
    order = [F.desc("popularity")] if "popularity" in df.columns else []
    rank = F.row_number().over(W.partitionBy(label).orderBy(*order, id_column))
    return (
        df.filter(F.col(label).isNotNull()).withColumn("rank", rank).filter(F.col("rank") <= k)
        .withColumn("spotify_url", track_url(F.col(id_column)))
    )


def top_classes(df: DataFrame, probabilities: dict[str, str], keep: Sequence[str],
                k: int = S.TOP_CLASSES) -> DataFrame:
    """(keep..., rank, class, probability): the k best classes per row, ties by class name."""
    pairs = F.array(*[
        F.struct((-F.col(p)).alias("_neg"), F.lit(c).alias("class"), F.col(p).alias("probability"))
        for c, p in sorted(probabilities.items())
    ])
    best = F.slice(F.sort_array(pairs), 1, k)
    return df.select(*keep, F.posexplode(best).alias("_pos", "_best")).select(
        *keep, (F.col("_pos") + 1).alias("rank"),
        F.col("_best.class").alias("class"), F.col("_best.probability").alias("probability"),
    )
