from conftest import rows
from pyspark.sql import functions as F

from cadenza.functions import scalars as S
from cadenza.operators import boards, eda, plays


def test_play_counts_leave_out_skips(play_table):
    assert rows(plays.play_counts(play_table)) == [("t1", 2), ("t2", 2), ("tX", 1)]


def test_engagement_weights(play_table):
    assert rows(plays.track_engagement(play_table)) == [
        ("t1", 2, 1, 5), ("t2", 2, 1, 5), ("t3", 0, 1, 1), ("tX", 1, 0, 2)
    ]
    heavier = plays.track_engagement(play_table, 5, 0)
    assert rows(heavier, "track_id", "score")[0] == ("t1", 10)


def test_affinity_ranks_and_drops_unknown_tracks(play_table, track_table):
    assert rows(plays.genre_affinity(play_table, track_table)) == [("u1", "pop", 2, 1), ("u2", "pop", 2, 1)]


def test_affinity_is_the_same_on_the_shuffled_path(play_table, track_table, monkeypatch):
    broadcast = rows(plays.genre_affinity(play_table, track_table))
    monkeypatch.setattr("cadenza.operators.joins.fits_broadcast", lambda *a, **k: False)
    monkeypatch.setattr("cadenza.operators.plays.fits_broadcast", lambda *a, **k: False)
    assert rows(plays.genre_affinity(play_table, track_table)) == broadcast


def test_activity_names_days(play_table):
    got = {(r["hour_of_day"], r["day_of_week"]): (r["event_count"], r["day_name"]) for r in plays.hourly_activity(play_table).collect()}
    assert got[23, 6] == (2, "Sunday")
    assert got[8, 9] == (1, "Unknown")
    assert sum(n for n, _ in got.values()) == 8


def test_top_tracks_break_ties_by_id(play_table, track_table):
    top = plays.top_tracks(play_table, track_table, 2).collect()
    assert [r["track_id"] for r in top] == ["t1", "t2"]
    assert top[0]["completion_rate_pct"] == 66.7


def test_measures_agree_with_each_other(play_table, track_table):
    counts = dict(rows(plays.play_counts(play_table)))
    engagement = {r["track_id"]: r for r in plays.track_engagement(play_table).collect()}
    assert counts == {t: r["completed"] for t, r in engagement.items() if r["completed"]}
    ratings = plays.implicit_ratings(play_table).groupBy("track_id").agg(F.sum("implicit_rating").alias("s"))
    assert dict(rows(ratings)) == {t: r["score"] for t, r in engagement.items()}
    union = plays.weighted_union(play_table)
    weighted = plays.with_weight(play_table)
    assert rows(union, *sorted(union.columns)) == rows(weighted, *sorted(weighted.columns))
    known = plays.genre_affinity(play_table, track_table).agg(F.sum("plays")).first()[0]
    assert known == sum(n for t, n in counts.items() if t in {"t1", "t2", "t3"})


def test_outcomes(play_table):
    marked = plays.with_outcome(play_table)
    assert dict(rows(marked.groupBy("outcome").count())) == {"C": 5, "S": 3}


def test_coverage_keeps_unknown_tracks(play_table, track_table):
    got = {r["genre"]: (r["total_plays"], r["listeners"]) for r in plays.known_track_coverage(play_table, track_table).collect()}
    assert got == {"pop": (6, 2), "rock": (1, 1), None: (1, 1)}


def test_genre_popularity(play_table, track_table):
    got = {r["genre"]: r for r in boards.genre_popularity(play_table, track_table).collect()}
    assert got["pop"].asDict() == {
        "genre": "pop", "total_plays": 6, "unique_listeners": 2, "unique_tracks": 2,
        "avg_completion_pct": 66.7, "play_share_pct": 75.0,
    }
    assert "" not in got


def test_artist_boards(play_table, track_table):
    board = rows(boards.artist_leaderboard(play_table, track_table))
    assert board == [("a1", "Ann", "pop", 4, 2, 2)]
    assert rows(boards.artist_names(play_table, track_table)) == [("Ann", 4)]


def test_null_genres_form_a_group(spark, play_table, track_table):
    unnamed = track_table.withColumn("genre", F.when(F.col("track_id") != "t3", F.col("genre")))
    got = {r["genre"]: r["unique_listeners"] for r in boards.genre_popularity(play_table, unnamed).collect()}
    assert got == {"pop": 2, None: 1}


def test_cohorts(play_table, user_table):
    got = {r["subscription_type"]: r for r in boards.cohort_subscription(play_table, user_table).collect()}
    assert (got["free"]["total_plays"], got["free"]["users"], got["free"]["avg_plays_per_user"]) == (5, 2, 2.5)
    assert got["premium"]["skip_rate_pct"] == 33.3
    gap = boards.cohort_gap(play_table, user_table).first()
    assert (gap["first_plays_per_user"], gap["second_plays_per_user"], gap["skip_gap_pct"]) == (3.0, 2.5, 6.7)


def test_monthly_trend(play_table):
    assert rows(plays.monthly_trend(play_table), "year_month", "total_plays", "active_users") == [
        ("2023-01", 3, 1), ("2023-02", 5, 2)
    ]


def test_top_lists_and_restriction(play_table):
    top = plays.most_active(play_table, "user_id", 1)
    assert rows(top) == [("u2", 4)]
    assert plays.restricted_to(play_table, top, "user_id").count() == 4
    assert plays.plays_of_user(play_table, "u1").count() == 3


def test_user_sample_does_not_depend_on_partitions(play_table):
    one = rows(plays.sample_users(play_table, 2))
    assert one == rows(plays.sample_users(play_table.repartition(7), 2))
    assert len(one) == 2


def test_peaks(play_table):
    peaks = eda.peak_and_low(play_table).first()
    assert (peaks["peak_hour"], peaks["low_hour"], peaks["most_active_day"]) == (8, 9, 0)
    best = {r["day_of_week"]: r["hour_of_day"] for r in eda.peak_hour_per_day(play_table).collect()}
    assert best[0] == 8 and best[2] == 22


def test_pivots(play_table, track_table):
    days = {r["day_of_week"]: r for r in eda.pivot_hour_day(play_table).collect()}
    assert sorted(days) == list(range(7)) and days[6]["h23"] == 2 and days[3]["h00"] == 0
    table = rows(eda.pivot_user_genre(play_table, track_table))
    assert table == [("u1", 2, 0), ("u2", 2, 0)]


def test_labels_take_one_row_per_track(play_table, track_table):
    doubled = track_table.unionByName(track_table.withColumn("name", F.lit("Zed")))
    got = eda.track_labels(play_table, doubled, 1).first()
    assert (got["track_id"], got["label"], got["play_count"]) == ("t1", "One — Ann", 2)


def test_histogram_of_one_value_and_empty_bins(spark):
    flat = spark.range(5).select(F.lit(3.0).alias("x"))
    got = eda.histogram(flat, "x", 4).orderBy("bin").collect()
    assert [r["n"] for r in got] == [0, 0, 5, 0] and got[0]["bin_low"] == 2.5
    ends = spark.createDataFrame([(0.0,), (10.0,), (None,)], "x double")
    assert [r["n"] for r in eda.histogram(ends, "x", 5).orderBy("bin").collect()] == [1, 0, 0, 0, 1]


def test_scalars(spark):
    one = spark.createDataFrame([(60.0, -40.0, "a|b||c", " 12 ", "x1", 7, 0)], "tempo double, loudness double, g string, i string, bad string, d int, z int")
    got = one.select(
        S.tempo_norm(), S.loudness_norm(), S.split_list("g"), S.int_or_null(F.col("i")), S.int_or_null(F.col("bad")),
        S.day_name("d"), S.day_name(F.lit(-1)), S.ratio(F.col("d"), F.col("z")),
        S.cosine([F.lit(3.0), F.lit(4.0)], [F.lit(6.0), F.lit(8.0)]), S.cosine([F.lit(0.0)], [F.lit(1.0)]),
    ).first()
    assert list(got) == [0.0, 0.0, ["a", "b", "c"], 12, None, "Unknown", "Unknown", None, 1.0, None]


def test_kpis(play_table, track_table, user_table):
    k = eda.kpis(play_table, track_table, user_table).first()
    assert (k["total_events"], k["distinct_users"], k["distinct_tracks"], k["peak_hour"]) == (8, 3, 4, 8)
    assert (k["premium_pct"], k["top_genre"], k["top_genre_share_pct"]) == (50.0, "pop", 85.7)


def test_replicates_draw_like_poisson(spark):
    from cadenza.operators import evaluation

    units = spark.range(20_000).select(F.col("id").alias("u"))
    for replicate in (0, 1, 199):
        got = {r["w"]: r["count"] for r in units.groupBy(evaluation.poisson_weight(F.col("u"), F.lit(replicate)).alias("w")).count().collect()}
        want = [0.36788, 0.36788, 0.18394, 0.06131, 0.01533]
        assert all(abs(got[n] / 20_000 - p) < 0.015 for n, p in enumerate(want))


def test_intervals_narrow_with_the_units(spark):
    from cadenza.operators import evaluation

    widths = []
    for n in (50, 5000):
        rows_ = spark.range(4 * n).select(
            (F.col("id") % n).alias("user_id"), (1 + F.col("id") % 7).alias("implicit_rating"), F.lit(3.0).alias("prediction")
        )
        got = {r["metric"]: r for r in evaluation.rating_error_intervals(rows_).collect()}
        for r in evaluation.rating_errors(rows_).collect():
            own = got[r["metric"]]
            assert abs(own["value"] - r["value"]) < 1e-9 and own["low"] <= own["value"] <= own["high"]
        widths.append(got["MAE"]["high"] - got["MAE"]["low"])
    assert widths[1] < widths[0] / 4


def test_sketches_of_months_tell_the_years_listeners(spark):
    from cadenza.operators import plays

    rows_ = spark.range(60_000).select(
        (F.col("id") % 8_999).alias("user_id"), F.expr("timestamp '2023-11-01' + make_interval(0, id % 5)").alias("ts")
    )
    months = plays.listener_sketches(rows_)
    got = {r["year"]: r["estimate"] for r in plays.listeners_by_year(months).collect()}
    want = {str(r["y"]): r["n"] for r in rows_.groupBy(F.year("ts").alias("y")).agg(F.countDistinct("user_id").alias("n")).collect()}
    assert set(got) == set(want) and all(abs(got[y] - n) <= plays.SKETCH_ERROR * n for y, n in want.items())
    assert months.agg(F.sum("listeners")).first()[0] > sum(want.values())
