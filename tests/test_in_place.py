"""The narrow track view joins its dimensions where the rows are; large tables are read again, not written."""

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tracklab.operators import ordered
from tracklab.plans import queries_train
from tracklab.sources import staging, tables
from tracklab.sources.tables import tracks


def rows(df):
    return sorted(map(tuple, df.select("track_id", "popularity", "energy", "signal_genre", "track_genre").collect()), key=str)


def shuffles(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan.count("Exchange ") - plan.count("BroadcastExchange ")


def folder(spark, tmp_path):
    """Lines of an order that is not there, of one that is there twice, and without an order."""
    line = spark.createDataFrame(
        [(o, 1, 1, 1, 2.0, 100.0, 0.5, 0.1, "N", "F") for o in (1, 2, 2, 3, None)],
        "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, "
        "l_tax double, l_returnflag string, l_linestatus string")
    line.write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.createDataFrame([(1, 7), (2, 8), (2, 9), (4, 7)], "o_orderkey long, o_custkey long").write.parquet(f"{tmp_path}/orders.parquet")
    spark.createDataFrame([(1, "a", 3)], "p_partkey long, p_name string, p_size int").write.parquet(f"{tmp_path}/part.parquet")
    return str(tmp_path)


def test_only_keys_of_lines_and_orders_meet(spark, tmp_path, monkeypatch):
    sf = folder(spark, tmp_path)
    monkeypatch.setattr(tables, "LOOKUP_ROWS", 2)  # a part, but four orders
    narrow = tracks(spark, sf, narrow=True)
    assert len(rows(narrow)) == 5
    assert rows(narrow) == rows(tracks(spark, sf))
    assert shuffles(narrow) == 0
    assert tables.joins_in_place(spark, sf)
    monkeypatch.setattr(tables, "SMALL_ROWS", 1)  # too many odd orders: an ordinary join
    assert not tables.joins_in_place(spark, sf)
    assert rows(tracks(spark, sf, narrow=True)) == rows(tracks(spark, sf))


def test_narrow_view_of_the_tables(spark, sf, monkeypatch):
    wide = rows(tracks(spark, sf))
    for most in (0, 500, 10 ** 6):  # no dimension is small, the parts are, both are
        monkeypatch.setattr(tables, "LOOKUP_ROWS", most)
        assert rows(tracks(spark, sf, narrow=True)) == wide


def test_large_tables_are_prepared_without_writing_rows(spark, sf, monkeypatch, tmp_path):
    def prepared(at):
        def made(spark, purpose, key, make):
            path = f"{tmp_path}/{at}-{purpose}"
            make(path)
            return path

        monkeypatch.setattr(queries_train, "kept", made)
        return queries_train._prepared(spark, sf)

    written = prepared("small")
    monkeypatch.setattr(queries_train, "WRITTEN_ROWS", 10)
    again = prepared("large")
    assert (tmp_path / "small-prepared/rows").exists() and not (tmp_path / "large-prepared/rows").exists()
    assert shuffles(again.rows) == 0
    x = F.transform(vector_to_array("features"), lambda v: F.round(v, 6) + 0.0)  # sums differ in their last digits

    def cells(made):
        return sorted(map(str, made.rows.select("track_id", "split", "label", x.alias("x")).collect()))

    assert cells(again) == cells(written)


def test_large_inputs_are_not_dealt_anew(spark, sf, monkeypatch):
    line = tables.table(spark, sf, "lineitem")
    assert staging.spread(line) is not line
    monkeypatch.setattr(staging, "SPREAD_BYTES", 1)
    assert staging.spread(line) is line


def test_ranges_grow_with_the_rows_of_a_key(spark, monkeypatch):
    df = spark.range(1000).select((F.col("id") % 2).alias("k"), F.col("id").cast("double").alias("x"), F.lit(1).alias("n"))
    assert ordered.ranges_for(df, ["k"]) == ordered.RANGES
    monkeypatch.setattr(ordered, "RANGES", 4)
    monkeypatch.setattr(ordered, "TASK_ROWS", 100)
    assert ordered.ranges_for(df, ["k"]) == 40
    got = ordered.running_totals(df, ["k"], "x", {"upto": "n"}, plain_rows=0)
    assert [r["upto"] for r in got.orderBy("k", "x").collect()] == [*range(1, 501), *range(1, 501)]
