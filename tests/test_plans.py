"""The physical plans are the ones the operators are written for."""

import pytest

from cadenza.operators import boards, eda
from cadenza.plans import catalog
from cadenza.session import stored

NO_PYTHON = [
    "top_tracks", "user_genre_affinity", "genre_popularity", "artist_leaderboard", "cohort_subscription",
    "monthly_trend", "taste_profiles", "kpis", "pivot_hour_day", "implicit_ratings", "seed_genre_recs", "ingest_check",
]


def plan(spark, small, name):
    return catalog.queries()[name](spark, small)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", NO_PYTHON)
def test_stays_in_the_jvm(spark, small, name):
    text = plan(spark, small, name)
    assert "Python" not in text and "MapInArrow" not in text and "MapInPandas" not in text
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_top_lists_do_not_sort_everything(spark, small):
    for name in ("top_tracks", "artist_names", "active_users", "track_labels"):
        assert "TakeOrderedAndProject" in plan(spark, small, name)


def test_ranked_lists_cut_before_the_shuffle(spark, small):
    for name in ("content_recs", "hybrid_recs"):
        text = plan(spark, small, name)
        assert text.count("WindowGroupLimit") >= 2
        assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_scans_read_only_their_columns(spark, small):
    text = plan(spark, small, "play_counts")
    assert "ReadSchema: struct<l_partkey:bigint,l_returnflag:string>" in text
    assert "orders" not in text


def test_filters_reach_the_scan(spark, small):
    text = plan(spark, small, "user_plays")
    assert "PushedFilters: [IsNotNull(user_id), EqualTo(user_id,7)]" in text


def test_plays_per_track_are_summed_before_the_join(spark, small):
    text = plan(spark, small, "top_tracks")
    assert text.index("BroadcastHashJoin") < text.index("HashAggregate")


@pytest.mark.parametrize("name, fact, module", [
    ("genre_popularity", "lineitem", boards), ("genre_skips", "lineitem", boards), ("artist_leaderboard", "lineitem", boards),
    ("kpis", "events", eda),
])
def test_plays_are_scanned_once(spark, small, monkeypatch, name, fact, module):
    scans = []

    def watched(df):
        scans.append(df._jdf.queryExecution().executedPlan().toString().count(f"{fact}.parquet"))
        return stored(df)

    monkeypatch.setattr(module, "stored", watched)
    assert plan(spark, small, name).count(f"{fact}.parquet") == 0
    assert sum(scans) == 1
