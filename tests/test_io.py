from datetime import datetime

import pytest
from conftest import rows
from pyspark.errors import AnalysisException
from pyspark.ml.recommendation import ALSModel

from cadenza.operators import plays
from cadenza.sources import readers, sinks
from cadenza.sources.schemas import PLAYS, TRACKS, USERS

HEADER = "user_id,track_id,timestamp,play_duration_ms,skipped,hour_of_day,day_of_week"
LINES = [
    HEADER,
    "U1,T1,2023-01-02 08:00:00,200000,0,8,0",
    "U1,T2,2023-01-02 09:00:00,10000,1,9,0",
    "",
    "U2,T1,2023-01-03 08:00:00",
    "U2,T1,2023-01-03 08:00:00,180000,2,8,1",
    "U2,,2023-01-03 08:00:00,180000,0,8,1",
    "U2,T2,2023-01-03 08:00:00,many,0,8,1",
    "U3,T3,2023-02-03 08:00:00,180000,0,8,4",
]
PROBLEMS = {"malformed line": 2, "bad skip flag": 1, "missing key": 1}


@pytest.fixture
def play_file(tmp_path):
    path = tmp_path / "plays.csv"
    path.write_text("\n".join(LINES) + "\n")
    return str(path)


def test_plays_and_quarantine(spark, play_file):
    for got in (readers.read_plays(spark, play_file), readers.read_play_lines(spark, play_file)):
        assert rows(got.valid, "user_id", "track_id", "ts", "skipped") == [
            ("U1", "T1", datetime(2023, 1, 2, 8), 0), ("U1", "T2", datetime(2023, 1, 2, 9), 1),
            ("U3", "T3", datetime(2023, 2, 3, 8), 0),
        ]
        assert dict(rows(got.rejected.groupBy("problem").count())) == PROBLEMS


def test_lines_are_trimmed(spark):
    lines = spark.createDataFrame([("  U1,T1,2023-01-02 08:00:00,5,0,8,0 ",), ("   ",), (HEADER,)], "value string")
    got = readers.parse_play_lines(lines)
    assert got.valid.count() == 1 and got.rejected.count() == 0


def test_quoted_commas_and_schema(spark, tmp_path):
    (tmp_path / "t.csv").write_text(
        ",".join(f.name for f in TRACKS) + '\nT1,"Slow, Blue",A1,Ann,pop,200000,50,2001,120.5,0.1,0.2,0.3,0.4,0.5,-7.25,0.6\n'
    )
    got = readers.read_tracks(spark, str(tmp_path / "t.csv"))
    assert got.schema == TRACKS
    one = got.first()
    assert (one["name"], one["tempo"], one["loudness"], one["speechiness"]) == ("Slow, Blue", 120.5, -7.25, 0.6)
    (tmp_path / "u.csv").write_text(",".join(f.name for f in USERS) + "\nU1,Ann,30,NB,DE,free,pop|rock,2015\n")
    assert readers.read_users(spark, str(tmp_path / "u.csv")).first()["preferred_genres"] == "pop|rock"


def test_missing_path_is_an_error(spark, tmp_path):
    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        readers.read_plays(spark, str(tmp_path / "none.csv"))


def test_csv_and_tsv_sinks(spark, tmp_path, play_table):
    counts = plays.play_counts(play_table)
    for _ in range(2):  # the second write replaces the first
        sinks.write_csv(counts, str(tmp_path / "csv"))
        sinks.write_tsv(counts, str(tmp_path / "tsv"))
        sinks.write_parquet(counts, str(tmp_path / "parquet"))
    back = spark.read.csv(str(tmp_path / "csv"), header=True, schema="track_id string, play_count bigint")
    assert rows(back) == rows(counts) == rows(spark.read.parquet(str(tmp_path / "parquet")))
    lines = sorted(r[0] for r in spark.read.text(str(tmp_path / "tsv")).collect())
    assert lines == ["t1\t2", "t2\t2", "tX\t1"]


def test_plays_by_month_are_pruned(spark, tmp_path, play_table):
    sinks.write_plays_parquet(play_table, str(tmp_path / "p"))
    back = readers.read_plays_parquet(spark, str(tmp_path / "p"))
    assert rows(back, *play_table.columns) == rows(play_table)
    plan = back.where("year_month = '2023-01'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year_month" in plan


def test_views_answer_sql(spark, play_table, track_table, user_table):
    readers.register_views(play_table, track_table, user_table)
    got = spark.sql("""
        SELECT substring(h.timestamp, 1, 7) AS month, count(*) AS n FROM history h
        JOIN tracks t ON h.track_id = t.track_id JOIN users u ON u.user_id = h.user_id
        WHERE h.skipped = 0 GROUP BY 1""")
    assert rows(got) == [("2023-01", 2), ("2023-02", 2)]


def test_model_sink_overwrites(spark, tmp_path):
    from pyspark.ml.recommendation import ALS

    ratings = spark.createDataFrame([(0, 0, 1.0), (0, 1, 2.0), (1, 1, 1.0)], "user int, item int, rating double")
    model = ALS(rank=2, maxIter=1, seed=1).fit(ratings)
    for _ in range(2):
        sinks.write_model(model, str(tmp_path / "als"))
    assert ALSModel.load(str(tmp_path / "als")).rank == 2


def test_preview_and_client(capsys, play_table):
    sinks.preview(play_table, 2)
    assert "user_id" in capsys.readouterr().out
    assert len(sinks.to_client(play_table.orderBy("user_id"), 3)) == 3


def test_play_schema_order():
    assert [f.name for f in PLAYS] == HEADER.split(",")
