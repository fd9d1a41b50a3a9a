"""Table scans and the track-shaped views the queries run on."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracklab import schema as S
from tracklab.operators.small import SMALL_ROWS, literal_table
from tracklab.sources.artefacts import files_print, kept
from tracklab.sources.staging import spread

# Rows of a dimension of keys and numbers up to which it is broadcast.
LOOKUP_ROWS = 2_000_000


def table(spark: SparkSession, directory: str, name: str) -> DataFrame:
    """One parquet table of a data directory."""
    return spark.read.parquet(f"{directory.rstrip('/')}/{name}.parquet")


def taxonomy(spark: SparkSession) -> DataFrame:
    """(raw_label, super_genre), one row per known raw label."""
    return literal_table(spark, sorted(S.RAW_TO_CLASS.items()), "raw_label string, super_genre string")


def genre_dim_rows() -> list[tuple[int, str]]:
    """Numbered raw labels used to give the sample tables a label column."""
    labels = sorted(S.RAW_TO_CLASS)
    return [*enumerate(labels), (len(labels), "unmapped-genre")]


def odd_orders(spark: SparkSession, directory: str) -> DataFrame:
    """(key, matches) of the order keys in lineitem that have no order or several.

    Found from keys alone, once per state of the files.
    """
    def make(folder):
        known = table(spark, directory, "orders").groupBy(F.col("o_orderkey").alias("key")).agg(F.count("*").alias("matches"))
        used = table(spark, directory, "lineitem").select(F.col("l_orderkey").alias("key")).filter("key is not null").distinct()
        used.join(known, "key", "left").select("key", F.coalesce("matches", F.lit(0)).alias("matches")).filter("matches <> 1").write.parquet(folder)

    files = [f"{directory.rstrip('/')}/{name}.parquet" for name in ("lineitem", "orders")]
    return spark.read.schema("key long, matches long").parquet(kept(spark, "odd-orders", [files_print(spark, files)], make))


def _is_small(df: DataFrame) -> bool:
    return df.count() <= LOOKUP_ROWS


def joins_in_place(spark: SparkSession, directory: str) -> bool:
    """Whether the narrow view shuffles no row, so that it can be read again instead of written."""
    return _is_small(table(spark, directory, "part")) and (
        _is_small(table(spark, directory, "orders")) or odd_orders(spark, directory).count() <= SMALL_ROWS)


def _with_orders(spark: SparkSession, directory: str, line: DataFrame) -> DataFrame:
    """Rows of ``line`` as an inner join with the orders gives them when no column of these is wanted.

    Beyond ``LOOKUP_ROWS`` orders only the keys meet: a row stays as it is unless its key is an odd one.
    """
    orders = table(spark, directory, "orders").select("o_orderkey")
    if _is_small(orders):
        return line.join(F.broadcast(orders), F.expr("l_orderkey = o_orderkey"))
    odd = odd_orders(spark, directory)
    n = odd.count()
    if n > SMALL_ROWS:
        return line.join(orders, F.expr("l_orderkey = o_orderkey"))
    line = line.filter("l_orderkey is not null")
    if not n:
        return line
    times = F.explode(F.array_repeat(F.lit(1), F.coalesce("matches", F.lit(1)).cast("int")))
    return line.join(F.broadcast(odd), F.expr("l_orderkey = key"), "left").withColumn("_time", times).drop("key", "matches", "_time")


def tracks(spark: SparkSession, directory: str, busy: bool = False, narrow: bool = False) -> DataFrame:
    """The track-shaped view over lineitem, part and orders.

    One label number has no row in the dimension, so some targets are null, and one
    label is outside the taxonomy.  ``busy`` announces heavy work per row: an input of
    a few splits is then spread over all task slots.  ``narrow`` leaves out ``track_name``
    and ``artist_key``, so that the rows can stay where they are while the dimensions are joined.
    """
    line = table(spark, directory, "lineitem")
    if busy:
        line = spread(line)
    part = table(spark, directory, "part").select("p_partkey", *([] if narrow else ["p_name"]), "p_size")
    if narrow:
        part = F.broadcast(part) if _is_small(part) else part
        joined = _with_orders(spark, directory, line.join(part, F.expr("l_partkey = p_partkey")))
    else:
        orders = table(spark, directory, "orders").select("o_orderkey", "o_custkey")
        joined = line.join(part, F.expr("l_partkey = p_partkey")).join(
            orders, F.expr("l_orderkey = o_orderkey")
        )
    genres = literal_table(spark, genre_dim_rows(), "gid long, track_genre string")
    base = joined.selectExpr(
        "concat_ws('-', cast(l_orderkey as string), cast(l_linenumber as string), "
        "cast(l_partkey as string), cast(l_suppkey as string), "
        "cast(cast(floor(l_extendedprice*100) as bigint) as string)) as track_id",
        *([] if narrow else ["o_custkey as artist_key"]),
        "l_partkey % 116 as gid",
        *([] if narrow else ["p_name as track_name"]),
        "cast(floor(l_quantity*2) as int) as popularity",
        "cast(floor(l_extendedprice*4*(case when l_orderkey % 97 = 0 then 20 else 1 end)) as bigint) as duration_ms",
        "(l_linestatus = 'F') as explicit",
        "l_discount*10 as danceability",
        "p_size/50 as energy",
        "cast(l_partkey % 12 as int) as key",
        "0 - l_extendedprice/2000 as loudness",
        "cast(l_suppkey % 2 as int) as mode",
        "l_tax*5 as speechiness",
        "(l_orderkey % 101)/100 as acousticness",
        "l_discount*l_tax*100 as instrumentalness",
        "(l_partkey % 37)/36 as liveness",
        "(l_suppkey % 53)/52 as valence",
        "40 + l_quantity*4 as tempo",
        "cast(3 + l_linenumber % 3 as int) as time_signature",
    )
    labelled = base.join(genres, "gid", "left")
    signal = F.expr(
        "case when acousticness >= cast(0.7 as double) then 'acoustic' "
        "when speechiness >= cast(0.33 as double) then 'vocal' "
        "when energy >= cast(0.8 as double) and loudness < -20 then 'heavy' "
        "when energy >= cast(0.6 as double) then 'electronic' "
        "when danceability >= cast(0.6 as double) then 'dance' else 'alternative' end"
    )
    return labelled.withColumn("signal_genre", signal)


def predictions(spark: SparkSession, directory: str, busy: bool = False) -> DataFrame:
    """Hand-made class scores per track: y_true, y_pred, top1 and one p_<class> column each."""
    t = tracks(spark, directory, busy, narrow=True)
    scores = {
        "acoustic": F.col("acousticness"),
        "alternative": F.expr("cast(35 as double)/100"),
        "dance": F.expr("danceability*7/10"),
        "electronic": F.expr("energy*8/10"),
        "heavy": F.expr("energy*(0 - loudness)/50"),
        "vocal": F.expr("speechiness*2"),
    }
    raw = t.select(
        "track_id", F.col("signal_genre").alias("y_true"),
        *[score.alias(f"s_{c}") for c, score in scores.items()],
    )
    total = sum((F.col(f"s_{c}") for c in S.CLASSES[1:]), F.col(f"s_{S.CLASSES[0]}"))
    shares = raw.select(
        "track_id", "y_true", *[(F.col(f"s_{c}") / total).alias(f"p_{c}") for c in S.CLASSES]
    )
    topped = shares.withColumn("top1", F.greatest(*[F.col(f"p_{c}") for c in S.CLASSES]))
    pred = F.lit(S.CLASSES[-1])
    for c in reversed(S.CLASSES[:-1]):
        pred = F.when(F.col(f"p_{c}") == F.col("top1"), F.lit(c)).otherwise(pred)
    return topped.withColumn("y_pred", pred)


def probability_columns() -> dict[str, str]:
    """Class -> name of its probability column in the predictions view."""
    return {c: f"p_{c}" for c in S.CLASSES}
