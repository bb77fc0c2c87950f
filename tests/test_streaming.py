from datetime import datetime, timedelta

import pytest
from conftest import rows
from pyspark.sql import functions as F

from cadenza.operators import plays
from cadenza.sources import bindings as B
from cadenza.streaming import activity, upserts

KEYS = ("user_id", "track_id", "implicit_rating")


def test_stream_equals_batch_up_to_the_watermark(spark, small, tmp_path):
    batch = B.event_plays(spark, small).withColumn("ts", F.col("ts").cast("timestamp"))
    batch.repartition(3).write.parquet(str(tmp_path / "in"))
    for name, measure in (("counts", activity.play_counts_by_window), ("hours", activity.activity_by_hour)):
        out = str(tmp_path / name)
        for _ in range(2):  # the second run finds nothing new and adds nothing
            stream = activity.play_stream(spark, str(tmp_path / "in"), batch.schema)
            query = activity.append_to_parquet(measure(stream), out, str(tmp_path / f"{name}-state"))
            assert query.awaitTermination(120)
        got = spark.read.parquet(out)
        assert got.count() > 0
        last = got.agg(F.max("window_start")).first()[0]
        done = batch.where(F.date_trunc("hour", "ts") <= F.lit(last))
        if name == "counts":
            want = plays.completed(done).groupBy(F.date_trunc("hour", "ts").alias("w"), "track_id").count()
        else:
            want = done.groupBy(
                F.date_trunc("hour", "ts").alias("w"), "hour_of_day", "day_of_week"
            ).agg(F.first(F.date_format("ts", "EEEE")).alias("day_name"), F.count(F.lit(1)).alias("count"))
        assert rows(got, *got.columns) == rows(want, *want.columns)


def _events(rows):
    """Plays as (user, minutes after a start, duration, skipped)."""
    start = datetime(2024, 3, 1, 8)
    return [(u, 1, start + timedelta(minutes=m), d, s) for u, m, d, s in rows]


KINDS = "user_id bigint, track_id bigint, ts timestamp, play_duration_ms bigint, skipped int"


def test_sessions_close_once_and_late_plays_do_not_reopen_them(spark, tmp_path):
    source, folder = str(tmp_path / "in"), str(tmp_path / "out")
    write = lambda rows: spark.createDataFrame(_events(rows), KINDS).coalesce(1).write.mode("append").parquet(source)
    run = lambda: rows(activity.closed(activity.sessions(activity.play_stream(spark, source, batch), "30 minutes", "10 minutes"), folder),
                       "user_id", "plays", "skips", "listened_ms", F.unix_seconds("session_end") % 86400)
    batch = spark.createDataFrame([], KINDS).schema
    write([(1, 0, 10, 0), (1, 29, 20, 1), (1, 60, 5, 0), (2, 0, 7, 0), (2, 100, 1, 0)])
    # The watermark is minute 90: user 1 has a session up to minute 29 + 30, one from 60 (31 minutes later: another) to 90.
    first = [(1, 1, 0, 5, 8 * 3600 + 90 * 60), (1, 2, 1, 30, 8 * 3600 + 59 * 60), (2, 1, 0, 7, 8 * 3600 + 30 * 60)]
    assert run() == first
    assert run() == first
    # A late play of a closed session is dropped; one within the open session of user 2 extends it.
    write([(2, 10, 1000, 0), (2, 120, 2, 1), (3, 400, 1, 0)])
    assert run() == sorted([*first, (2, 2, 1, 3, 8 * 3600 + 150 * 60)])
    assert run() == sorted([*first, (2, 2, 1, 3, 8 * 3600 + 150 * 60)])


def test_restart_gives_no_row_twice(spark, small, tmp_path):
    from cadenza.plans import oracle
    from check_queries import differences, duck

    folder = str(tmp_path / "hours")
    for _ in range(3):
        got = activity.closed(activity.activity_by_hour(B.event_play_stream(spark, small)), folder)
    got = got.withColumn("window_start", F.unix_micros("window_start"))
    assert differences(got, duck(small), oracle.oracle_sql()["stream_activity"]) == []


@pytest.mark.parametrize("every", [1, 2, 100])
def test_replayed_batches_count_once(spark, small, tmp_path, every):
    p = B.event_plays(spark, small)
    parts = [p.where(F.pmod(F.hash("ts"), F.lit(5)) == i) for i in range(5)]
    path = str(tmp_path / "ratings")
    assert upserts.current(spark, path).count() == 0
    for i, part in enumerate(parts):
        upserts.merge(part, i, path, every)
        for again in (i, max(0, i - 1), 0):
            upserts.merge(parts[again], again, path, every)
    assert rows(upserts.current(spark, path), *KEYS) == rows(plays.implicit_ratings(p), *KEYS)


def test_cut_off_writes_do_not_count(spark, small, tmp_path):
    p = B.event_plays(spark, small)
    path = str(tmp_path / "ratings")
    upserts.merge(p, 0, path)
    # An attempt at a base and one at the next batch that never finished.
    for name in ("upto=0", "batch=1"):
        plays.implicit_ratings(p).write.parquet(f"{path}/{name}")
        (tmp_path / "ratings" / name / "_SUCCESS").unlink()
    assert rows(upserts.current(spark, path), *KEYS) == rows(plays.implicit_ratings(p), *KEYS)


def test_a_stream_goes_on_where_it_was(spark, small, tmp_path):
    p = B.event_plays(spark, small).select("user_id", "track_id", "skipped")
    source, path = str(tmp_path / "in"), str(tmp_path / "ratings")
    for day in range(2):
        p.where(F.pmod("track_id", F.lit(2)) == day).repartition(2).write.mode("append").parquet(source)
        stream = spark.readStream.schema(p.schema).option("maxFilesPerTrigger", 1).parquet(source)
        assert upserts.upsert(stream, path, f"{path}/checkpoint").awaitTermination(120)
    assert rows(upserts.current(spark, path), *KEYS) == rows(plays.implicit_ratings(p), *KEYS)
