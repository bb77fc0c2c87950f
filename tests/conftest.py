import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
sys.path.insert(0, str(Path(__file__).resolve().parent))

from cadenza.session import local_session, release  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session("cadenza-tests", cpus=4, memory="4g")
    session.conf.set("spark.sql.shuffle.partitions", "4")
    yield session
    release(session)
    session.stop()


@pytest.fixture(scope="session")
def small():
    return "/root/testdata/sf0.001"


# user, track, time, duration, skipped, hour, weekday.  u3 plays only an unknown
# track; weekday 9 is out of range; t1 and t2 tie; u4 never plays.
PLAY_ROWS = [
    ("u1", "t1", "2023-01-02 08:00:00", 200000, 0, 8, 0),
    ("u1", "t1", "2023-01-02 09:00:00", 10000, 1, 9, 0),
    ("u1", "t2", "2023-01-03 08:00:00", 180000, 0, 8, 1),
    ("u2", "t2", "2023-02-01 22:00:00", 150000, 0, 22, 2),
    ("u2", "t1", "2023-02-01 23:00:00", 190000, 0, 23, 2),
    ("u2", "t3", "2023-02-05 23:00:00", 5000, 1, 23, 6),
    ("u3", "tX", "2023-02-05 23:30:00", 100000, 0, 23, 6),
    ("u2", "t2", "2023-02-06 08:00:00", 6000, 1, 8, 9),
]
TRACK_ROWS = [
    ("t1", "One", "a1", "Ann", "pop", 50),
    ("t2", "Two", "a1", "Ann", "pop", 70),
    ("t3", "Three", "a2", "Ann", "rock", 10),
    ("t4", "Four", "a3", "Bob", "", 5),
]
USER_ROWS = [
    ("u1", 30, "premium", "pop|rock"),
    ("u2", 40, "free", "rock|jazz"),
    ("u3", 50, "free", "pop"),
    ("u4", 20, "premium", "pop|none"),
]


@pytest.fixture(scope="session")
def play_table(spark):
    from pyspark.sql import functions as F

    names = "user_id string, track_id string, ts string, play_duration_ms bigint, skipped int, hour_of_day int, day_of_week int"
    return spark.createDataFrame(PLAY_ROWS, names).withColumn("ts", F.to_timestamp("ts")).cache()


@pytest.fixture(scope="session")
def track_table(spark):
    names = "track_id string, name string, artist_id string, artist_name string, genre string, popularity int"
    return spark.createDataFrame(TRACK_ROWS, names).cache()


@pytest.fixture(scope="session")
def user_table(spark):
    names = "user_id string, age int, subscription_type string, preferred_genres string"
    return spark.createDataFrame(USER_ROWS, names).cache()


def rows(df, *columns):
    return sorted(tuple(r) for r in (df.select(*columns) if columns else df).collect())
