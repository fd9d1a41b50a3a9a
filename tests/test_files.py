"""CSV sources and sinks, and the row-local operators on a file stream."""

import pytest
from pyspark.sql import functions as F

from tracklab import schema as S
from tracklab.operators.cleaning import cast_bool, handle_row_cap
from tracklab.operators.moodtext import mood
from tracklab.operators.small import literal_table
from tracklab.session import scratch_dir
from tracklab.sources import files

HEADER = ",".join(["", *[f.name for f in S.TRACK_SCHEMA]])
LINES = [
    '0,id0,"Duo, The","An ""album""",song,73,230666,False,0.676,0.461,1,-6.746,0,0.143,0.0322,1.01e-06,0.358,0.715,87.917,4,acoustic',
    "1,id1,,,,55,149610,True,0.42,0.166,1,-17.235,1,0.0763,0.924,5.56e-06,0.101,NaN,77.489,4,",
]


@pytest.fixture
def folder(tmp_path):
    (tmp_path / "b.csv").write_text("\n".join([HEADER, *LINES]) + "\n")
    return tmp_path


def test_one_csv_or_a_written_folder(spark, folder):
    assert files.find_csv(spark, str(folder)).endswith("/b.csv")
    (folder / "a.csv").write_text(HEADER + "\n")
    with pytest.raises(ValueError, match="2 CSV files"):
        files.find_csv(spark, str(folder))


def test_a_written_folder_comes_back_whole(spark, tmp_path):
    columns = [F.col("id").cast("string").alias("track_id") if f.name == "track_id" else F.lit(None).cast(f.dataType).alias(f.name)
               for f in S.TRACK_SCHEMA]
    files.write_csv(spark.range(1000).repartition(4).select(*columns), str(tmp_path / "out"))
    back = files.read_tracks_csv(spark, files.find_csv(spark, str(tmp_path / "out")), indexed=False)
    assert sorted(int(r.track_id) for r in back.select("track_id").collect()) == list(range(1000))


def test_no_csv(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        files.find_csv(spark, str(tmp_path))
    with pytest.raises(FileNotFoundError):
        files.find_csv(spark, str(tmp_path / "missing"))


def test_indexed_scan(spark, folder):
    df = files.load_tracks(spark, directory=str(folder))
    assert df.schema == S.TRACK_SCHEMA
    a, b = df.orderBy("track_id").collect()
    assert (a["artists"], a["album_name"], a["explicit"], a["duration_ms"]) == ("Duo, The", 'An "album"', False, 230666)
    assert (b["artists"], b["valence"], b["track_genre"]) == (None, None, None)


def test_upload_scan_keeps_index_and_unknown_columns(spark, tmp_path):
    (tmp_path / "u.csv").write_text(",popularity,energy,mine\n0,12,0.5,x\n1,bad,,y\n")
    df = files.read_upload_csv(spark, str(tmp_path / "u.csv"))
    assert df.columns == ["Unnamed: 0", "popularity", "energy", "mine"]
    assert [tuple(r) for r in df.collect()] == [("0", 12, 0.5, "x"), ("1", None, None, "y")]


def test_column_pruning_reaches_the_scan(spark, folder):
    df = files.load_tracks(spark, directory=str(folder)).select("popularity")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<popularity:int>" in plan


def test_split_folders_prune(spark, tmp_path):
    df = literal_table(spark, [(1, "train"), (2, "val"), (3, "test")], "id int, split string")
    files.write_splits(df, str(tmp_path / "s"))
    read = files.read_split(spark, str(tmp_path / "s"), ["train", "val"])
    assert sorted(r["id"] for r in read.collect()) == [1, 2]
    assert "PartitionFilters: [split" in read._jdf.queryExecution().executedPlan().toString()


def test_row_cap_is_optional(spark):
    df = spark.range(1000)
    assert handle_row_cap(df, "id").count() == 1000
    assert [r["id"] for r in handle_row_cap(df, "id", 3).orderBy("id").collect()] == [0, 1, 2]


class _Session:
    """The two things scratch_dir asks of a session."""

    def __init__(self, master, settings):
        self.sparkContext = type("Context", (), {"master": master})()
        self.conf = settings


def test_scratch_folder_comes_from_the_session():
    shared = _Session("spark://host:7077", {"spark.checkpoint.dir": "hdfs://shared/"})
    assert scratch_dir(shared, "x").startswith("hdfs://shared/x-")
    with pytest.raises(RuntimeError):
        scratch_dir(_Session("spark://host:7077", {}), "x")


def test_row_local_operators_on_a_stream(spark, tmp_path):
    texts = literal_table(spark, [(1, True, "calm piano"), (2, False, "techno club")], "id int, explicit boolean, text string")
    texts.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(texts.schema).parquet(str(tmp_path / "in"))
    query = (cast_bool(mood(stream)).select("id", "explicit", "mood").writeStream.format("memory")
             .queryName("moods").trigger(availableNow=True).option("checkpointLocation", str(tmp_path / "cp")).start())
    query.awaitTermination(60)
    assert sorted(map(tuple, spark.table("moods").collect())) == [(1, 1, "acoustic"), (2, 0, "electronic")]
