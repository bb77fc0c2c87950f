"""Every measure by name, over a folder of the driver tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cadenza.functions import scalars as S
from cadenza.operators import (
    boards, clusters, content, eda, evaluation, factors, features, hybrid, ids, plays, quantiles,
)
from cadenza.session import own_path, stored
from cadenza.sources import bindings as B
from cadenza.sources import readers, sinks
from cadenza.sources.schemas import AUDIO_FEATURES, EMBEDDED_FEATURES, PLAYS, TRACK_FEATURES
from cadenza.streaming import activity, upserts

Query = Callable[[SparkSession, str], DataFrame]

# Values of the driver tables that stand for the two subscription types.
PREMIUM, FREE = "BUILDING", "MACHINERY"


def _rounded(df: DataFrame, columns: list[str], digits: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})


def _tracks(s: SparkSession, d: str) -> DataFrame:
    return features.with_fixed_ranges(B.embedding_tracks(s, d))


def _minmax(s: SparkSession, d: str) -> DataFrame:
    columns = features.CONTENT_FEATURES
    return _rounded(features.content_features(B.embedding_tracks(s, d)), columns)


def _standardised(s: SparkSession, d: str) -> DataFrame:
    scaled = features.standardised(B.embedding_tracks(s, d).select("track_id", *TRACK_FEATURES), TRACK_FEATURES)
    return _rounded(scaled, TRACK_FEATURES)


def _profiles(s: SparkSession, d: str) -> DataFrame:
    vectors = features.content_features(B.embedding_tracks(s, d))
    ratings = plays.implicit_ratings(B.event_plays(s, d))
    return _rounded(features.taste_profiles(ratings, vectors, features.CONTENT_FEATURES), features.CONTENT_FEATURES)


def _coded(s: SparkSession, d: str) -> DataFrame:
    ratings = stored(plays.implicit_ratings(B.event_plays(s, d)))
    users = ids.dense_ids(ratings, "user_id", "user_idx")
    tracks = ids.dense_ids(ratings, "track_id", "track_idx")
    return ids.encode(ratings, users, tracks)


def _split(s: SparkSession, d: str) -> DataFrame:
    coded = _coded(s, d)
    train, test = ids.hash_split(coded)
    return train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test")))


def _strongest(s: SparkSession, d: str) -> DataFrame:
    """Ratings between the most active users and the most played tracks."""
    p = B.line_plays(s, d)
    kept = plays.restricted_to(p, plays.most_active(p, "user_id", 3000), "user_id")
    kept = plays.restricted_to(kept, plays.most_active(p, "track_id", 2000), "track_id")
    return plays.implicit_ratings(kept)


def _by_mean_rating(s: SparkSession, d: str) -> DataFrame:
    """Each rating predicted by its track's mean rating."""
    ratings = plays.implicit_ratings(B.event_plays(s, d))
    means = ratings.groupBy("track_id").agg(F.avg("implicit_rating").alias("prediction"))
    return ratings.join(means, "track_id")


def _mean_rating_errors(s: SparkSession, d: str) -> DataFrame:
    return _rounded(evaluation.rating_errors(_by_mean_rating(s, d)), ["value"])


def _mean_rating_intervals(s: SparkSession, d: str) -> DataFrame:
    return _rounded(evaluation.rating_error_intervals(_by_mean_rating(s, d)), ["value", "low", "high"])


def _yearly_listeners(s: SparkSession, d: str) -> DataFrame:
    """Exact listeners of each year, and whether the stored months' sketches tell them within their bound."""
    p = B.line_plays(s, d)
    exact = p.groupBy(F.date_format("ts", "yyyy").alias("year")).agg(F.countDistinct("user_id").alias("listeners"))
    told = plays.listeners_by_year(stored(plays.listener_sketches(p)))
    near = F.abs(F.col("estimate") - F.col("listeners")) <= plays.SKETCH_ERROR * F.col("listeners")
    return exact.join(told, "year").select("year", "listeners", near.alias("within_bound"))


def _popularity_ranking(s: SparkSession, d: str) -> DataFrame:
    """Ranking quality, on the held-out pairs, of the most played tracks of the training pairs."""
    train, test = ids.hash_split(_coded(s, d))
    order = W.orderBy(F.desc("n"), "track_id")
    top = train.groupBy("track_id").agg(F.sum("implicit_rating").alias("n")).orderBy(F.desc("n"), "track_id").limit(10)
    ranked = F.broadcast(top.select("track_id", F.row_number().over(order).alias("rank")))
    # The list is the same for all users, so a held-out pair is a hit where its track is listed.
    recs = test.join(ranked, "track_id").select("user_id", "track_id", "rank")
    return _rounded(evaluation.ranking_metrics(recs, test, 10), ["value"])


def _flawed_lines(s: SparkSession, d: str) -> DataFrame:
    """Events as text lines of plays, some of them damaged by event number."""
    kind = F.col("event_id") % 50
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    p = B.table(s, d, "events").select(
        "event_id",
        "user_id",
        F.get_json_object("props", "$.k").alias("track_id"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("ts"),
        F.round(F.col("value") * 1000).cast("bigint").alias("ms"),
        F.when(F.col("event_type") == "error", 1).otherwise(0).alias("skipped"),
        F.hour("ts").alias("hour"),
        F.weekday("ts").alias("day"),
    )
    whole = F.concat_ws(",", *[text(c) for c in ("user_id", "track_id", "ts", "ms", "skipped", "hour", "day")])
    line = (
        F.when(kind == 1, F.concat_ws(",", text("user_id"), text("track_id")))
        .when(kind == 2, F.concat_ws(",", text("user_id"), text("track_id"), text("ts"), text("ms"), F.lit("2"), text("hour"), text("day")))
        .when(kind == 3, F.lit("   "))
        .when(kind == 4, F.lit("user_id,track_id,timestamp,play_duration_ms,skipped,hour_of_day,day_of_week"))
        .when(kind == 5, F.concat_ws(",", text("user_id"), text("track_id"), text("ts"), F.lit("abc"), text("skipped"), text("hour"), text("day")))
        .otherwise(F.concat(F.lit(" "), whole, F.lit(" ")))
    )
    return p.select(line.alias("value"))


def _ingest_check(s: SparkSession, d: str) -> DataFrame:
    got = readers.parse_play_lines(_flawed_lines(s, d))
    rows = got.valid.withColumn("problem", F.lit("none")).select("problem", "play_duration_ms", "skipped").unionByName(
        got.rejected.select("problem", F.lit(None).cast("bigint").alias("play_duration_ms"),
                            F.lit(None).cast("int").alias("skipped"))
    )
    return rows.groupBy("problem").agg(
        F.count(F.lit(1)).alias("lines"),
        F.coalesce(F.sum("play_duration_ms"), F.lit(0)).cast("bigint").alias("total_ms"),
        F.coalesce(F.sum("skipped"), F.lit(0)).cast("bigint").alias("skips"),
    )


def _preferred_genres(s: SparkSession, d: str) -> DataFrame:
    wanted = B.customer_users(s, d).select(F.explode(S.split_list("preferred_genres")).alias("genre"))
    return eda.value_counts(wanted, "genre")


def _outcomes(s: SparkSession, d: str) -> DataFrame:
    marked = plays.with_outcome(plays.with_weight(B.event_plays(s, d)))
    return marked.select("user_id", "track_id", "play_duration_ms", "outcome", "weight")


def _als_recs(s: SparkSession, d: str, unheard: bool) -> DataFrame:
    fit = factors.fit_als(B.event_plays(s, d))
    heard = fit.train.unionByName(fit.test) if unheard else None
    return factors.factor_recommendations(fit, B.embedding_tracks(s, d), exclude=heard)


def _als_metrics(s: SparkSession, d: str) -> DataFrame:
    return evaluation.rating_errors(factors.fit_als(B.event_plays(s, d)).predictions)


def _als_ranking(s: SparkSession, d: str) -> DataFrame:
    fit = factors.fit_als(B.event_plays(s, d))
    recs = factors.factor_recommendations(fit, B.embedding_tracks(s, d), exclude=fit.train)
    return evaluation.ranking_metrics(recs, fit.test)


def _svd_recs(s: SparkSession, d: str) -> DataFrame:
    fit = factors.fit_svd(B.event_plays(s, d))
    return factors.factor_recommendations(fit, B.embedding_tracks(s, d), exclude=fit.train.unionByName(fit.test))


def _svd_metrics(s: SparkSession, d: str) -> DataFrame:
    return evaluation.rating_errors(factors.fit_svd(B.event_plays(s, d)).predictions)


def _hybrid_als(s: SparkSession, d: str) -> DataFrame:
    p = B.event_plays(s, d)
    fit = factors.fit_als(p)
    return hybrid.hybrid_recommendations(p, B.embedding_tracks(s, d), factors=(fit.users, fit.tracks))


def _clustered(measure, features=EMBEDDED_FEATURES) -> Query:
    def run(s: SparkSession, d: str) -> DataFrame:
        vectors = clusters.feature_vectors(B.embedding_tracks(s, d), features)
        return measure(vectors, clusters.fit_clusters(vectors))

    return run


def _list_checks(recs: DataFrame, score: str, heard: DataFrame) -> DataFrame:
    """What must hold of ranked lists whatever the model: one row of counts, the last three 0."""
    order = W.partitionBy("user_id").orderBy("rank")
    steps = stored(recs.select(
        "user_id", "track_id", (F.col("rank") != F.row_number().over(order)).cast("int").alias("gap"),
        (F.col(score) > F.lag(score).over(order) + 1e-9).cast("int").alias("rise"),
    ))
    known = steps.join(heard.select("user_id", "track_id").distinct(), ["user_id", "track_id"]).agg(F.count(F.lit(1)).alias("heard_rows"))
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("bigint")
    one = steps.agg(
        F.countDistinct("user_id").alias("users"), F.count(F.lit(1)).alias("listed"),
        total("gap").alias("rank_gaps"), total("rise").alias("rises"),
    )
    return one.select("*", known.scalar().alias("heard_rows"))


def _als_list_checks(s: SparkSession, d: str) -> DataFrame:
    fit = factors.fit_als(B.event_plays(s, d))
    heard = fit.train.unionByName(fit.test)
    recs = factors.factor_recommendations(fit, B.embedding_tracks(s, d), exclude=heard)
    return _list_checks(recs, "predicted_score", heard)


def _svd_list_checks(s: SparkSession, d: str) -> DataFrame:
    fit = factors.fit_svd(B.event_plays(s, d))
    heard = fit.train.unionByName(fit.test)
    recs = factors.factor_recommendations(fit, B.embedding_tracks(s, d), exclude=heard)
    return _list_checks(recs, "predicted_score", heard)


def _newcomers(s: SparkSession, d: str) -> tuple[factors.Factorisation, DataFrame, DataFrame]:
    """A fit on the users whose id 5 does not divide, the ratings of the others, and the tracks."""
    p = B.event_plays(s, d)
    new = F.col("user_id") % 5 == 0
    return factors.fit_als(p.where(~new)), stored(plays.implicit_ratings(p.where(new))), B.embedding_tracks(s, d)


def _fold_in_recs(s: SparkSession, d: str) -> DataFrame:
    return factors.fold_in_recommendations(*_newcomers(s, d))


def _fold_in_checks(s: SparkSession, d: str) -> DataFrame:
    fit, ratings, tracks = _newcomers(s, d)
    return _list_checks(factors.fold_in_recommendations(fit, ratings, tracks), "predicted_score", ratings)


def _hybrid_als_checks(s: SparkSession, d: str) -> DataFrame:
    return _list_checks(_hybrid_als(s, d), "hybrid_score", plays.heard_pairs(B.event_plays(s, d)))


def _prediction_checks(s: SparkSession, d: str) -> DataFrame:
    """Held-out pairs that each factor model predicts: those whose user and track it was trained on."""
    p = B.event_plays(s, d)
    fit = factors.fit_als(p)
    trained = fit.test.join(fit.train.select("user_id").distinct(), "user_id").join(fit.train.select("track_id").distinct(), "track_id")
    svd = factors.fit_svd(p)
    known = svd.predictions.join(svd.train.select("user_id").distinct(), "user_id")
    rows = [("als", fit.predictions.select("prediction")), ("svd", known.select("prediction"))]
    out = [
        df.agg(F.count("prediction").alias("predicted"), F.count_if(F.isnan("prediction")).alias("not_numbers")).select(F.lit(name).alias("model"), "*")
        for name, df in rows
    ]
    return out[0].unionByName(out[1]).withColumn("expected", trained.agg(F.count(F.lit(1))).scalar())


def _cluster_checks(s: SparkSession, d: str) -> DataFrame:
    """Clusters are a partition of the tracks, the profile counts them, the elbow falls (within 2 %)."""
    vectors = _vectors(s, d)
    model = clusters.fit_clusters(vectors)
    assigned = clusters.track_clusters(vectors, model)
    profile = clusters.cluster_profile(vectors, model)
    costs = clusters.elbow(vectors)
    rises = costs.select((F.col("inertia") > 1.02 * F.lag("inertia").over(W.orderBy("k"))).cast("int").alias("rise"))
    quality = clusters.silhouette(vectors, model).select((~F.col("silhouette").between(-1, 1)).cast("bigint"))
    labels = clusters.cluster_labels(model, vectors, EMBEDDED_FEATURES).agg(F.count("label"))
    return assigned.agg(F.count(F.lit(1)).alias("tracks"), F.count_if(~F.col("cluster").between(0, 5)).alias("bad_ids")).select(
        "*", profile.agg(F.sum("track_count").cast("bigint")).scalar().alias("profiled"),
        rises.agg(F.coalesce(F.sum("rise"), F.lit(0)).cast("bigint")).scalar().alias("rises"),
        quality.scalar().alias("bad_silhouettes"), labels.scalar().alias("labels"),
    )


def _pca_checks(s: SparkSession, d: str) -> DataFrame:
    """Scores are centred and uncorrelated; explained shares are their variances over the whole variance."""
    vectors = _vectors(s, d)
    scores, variance = clusters.principal_components(vectors)
    x = F.posexplode(vector_to_array("features"))
    whole = vectors.select(x.alias("place", "v")).groupBy("place").agg(F.var_samp("v").alias("v")).agg(F.sum("v"))
    off = lambda c: (F.abs(c) > 1e-9).cast("bigint")
    share = lambda i: variance.where(f"component = {i}").select("explained_variance").scalar()
    return scores.agg(
        F.count(F.lit(1)).alias("tracks"), off(F.covar_samp("pc1", "pc2")).alias("correlated"),
        (off(F.avg("pc1")) + off(F.avg("pc2"))).alias("not_centred"), F.var_samp("pc1").alias("v1"), F.var_samp("pc2").alias("v2"),
    ).select(
        "tracks", "correlated", "not_centred",
        (off(F.col("v1") / whole.scalar() - share(1)) + off(F.col("v2") / whole.scalar() - share(2))).alias("wrong_shares"),
    )


def _vectors(s: SparkSession, d: str) -> DataFrame:
    """Tracks with all their dimensions as one scaled vector."""
    return clusters.feature_vectors(B.embedding_tracks(s, d), EMBEDDED_FEATURES)


def _cluster_residuals(s: SparkSession, d: str) -> DataFrame:
    """Tracks, those whose centre is not the nearest one, and whether clusters explain part of the squares."""
    vectors = _vectors(s, d)
    model = clusters.fit_clusters(vectors)
    centres = F.array(*[F.array(*[F.lit(float(v)) for v in c]) for c in model.clusterCenters()])
    gap = lambda c: F.aggregate(F.zip_with("v", c, lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda t, x: t + x)
    # The features are standardised, so their squares are the distances from the mean.
    whole = F.aggregate("v", F.lit(0.0), lambda t, x: t + x * x)
    away = model.transform(vectors).select("cluster", vector_to_array("features").alias("v")).select(
        F.transform(centres, gap).alias("away"), "cluster", whole.alias("square")
    ).withColumn("own", F.element_at("away", F.col("cluster") + 1))
    return away.agg(
        F.count(F.lit(1)).alias("tracks"), F.count_if(F.col("own") > F.array_min("away") + 1e-9).alias("not_nearest"),
        (F.sum("own") < F.sum("square")).alias("explains"),
    )


def _als_residuals(s: SparkSession, d: str) -> DataFrame:
    """Listeners of the fit, and those whose vector does not solve their normal equation against the track vectors."""
    fit = factors.fit_als(B.event_plays(s, d))
    solved = factors.fold_in(fit.tracks, fit.train.select("user_id", "track_id", "implicit_rating"))
    size = lambda v: F.sqrt(F.aggregate(v, F.lit(0.0), lambda t, x: t + x * x))
    both = fit.users.join(solved.select("user_id", F.col("vector").alias("exact")), "user_id", "left")
    off = size(F.zip_with("vector", "exact", lambda a, b: a - b)) / size("exact")
    # The fit holds its vectors in single precision.
    return both.agg(
        F.count(F.lit(1)).alias("users"), F.count_if(F.col("exact").isNull() | (off > 1e-2)).alias("unsolved")
    )


def _round_trips(s: SparkSession, d: str) -> DataFrame:
    """Rows and a sum of what each writer wrote, as its reader reads it."""
    p, folder = B.event_plays(s, d), own_path(s, "round-trips")
    ratings, counts = plays.implicit_ratings(p), plays.play_counts(p)
    sinks.write_csv(ratings, f"{folder}/csv")
    sinks.write_tsv(counts, f"{folder}/tsv")
    sinks.write_parquet(ratings, f"{folder}/parquet")
    sinks.write_plays_parquet(p, f"{folder}/months")
    times = p.withColumn("timestamp", F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
    sinks.write_csv(times.select(*PLAYS.names), f"{folder}/plays")
    months = readers.read_plays_parquet(s, f"{folder}/months")
    readers.register_views(months, B.embedding_tracks(s, d), B.customer_users(s, d))
    read = {
        "csv": readers.read_csv(s, f"{folder}/csv", ratings.schema).select("implicit_rating"),
        "tsv": s.read.schema(counts.schema).csv(f"{folder}/tsv", sep="\t").select("play_count"),
        "parquet": s.read.parquet(f"{folder}/parquet").select("implicit_rating"),
        "plays": readers.read_plays(s, f"{folder}/plays").valid.select("play_duration_ms"),
        "lines": readers.read_play_lines(s, f"{folder}/plays").valid.select("play_duration_ms"),
        "months": months.select("play_duration_ms"),
        "view": s.sql("SELECT play_duration_ms FROM history JOIN tracks USING (track_id) JOIN users USING (user_id)"),
    }
    for view in ("history", "tracks", "users"):
        s.catalog.dropTempView(view)
    rows = [
        df.toDF("value").agg(F.count(F.lit(1)).alias("n_rows"), F.sum("value").alias("total")).select(F.lit(name).alias("written"), "*")
        for name, df in read.items()
    ]
    return reduce(DataFrame.unionByName, rows)


def _streamed(measure, *times: str) -> Query:
    """The measure over the events as a stream, closed rows only; ``times`` as microseconds.

    All files are one batch, so no row of the backfill is late.
    """

    def run(s: SparkSession, d: str) -> DataFrame:
        rows = activity.closed(measure(B.event_play_stream(s, d)), own_path(s, "stream"))
        return rows.withColumns({t: F.unix_micros(t) for t in times})

    return run


def _streamed_ratings(s: SparkSession, d: str) -> DataFrame:
    """The ratings from the events in four micro-batches, each of them merged twice."""
    folder, target = own_path(s, "plays"), own_path(s, "ratings")
    p = B.event_plays(s, d).select("user_id", "track_id", "skipped")
    p.repartition(4).write.parquet(folder)
    stream = s.readStream.schema(p.schema).option("maxFilesPerTrigger", 1).parquet(folder)

    def twice(batch: DataFrame, batch_id: int) -> None:
        for _ in range(2):
            upserts.merge(batch, batch_id, target)

    query = upserts.upsert(stream, target, f"{target}/checkpoint", twice)
    query.awaitTermination()
    return upserts.current(s, target)


def queries() -> dict[str, Query]:
    E, T, U = B.event_plays, B.embedding_tracks, B.customer_users
    L, P = B.line_plays, B.part_tracks
    no_users = lambda s, d: L(s, d, users=False)
    described = ["play_duration_ms", "skipped", "hour_of_day", "day_of_week"]
    track_stats = ["popularity", "tempo", "energy", "danceability", "valence", "acousticness"]
    return {
        "top_tracks": lambda s, d: plays.top_tracks(no_users(s, d), P(s, d)),
        "play_counts": lambda s, d: plays.play_counts(no_users(s, d)),
        "track_leaderboard": lambda s, d: plays.play_counts_with_tracks(no_users(s, d), P(s, d)),
        "user_genre_affinity": lambda s, d: plays.genre_affinity(L(s, d), P(s, d)),
        "track_engagement": lambda s, d: plays.track_engagement(no_users(s, d)),
        "engagement_leaderboard": lambda s, d: plays.engagement_with_tracks(E(s, d), T(s, d)),
        "hourly_activity": lambda s, d: plays.hourly_activity(E(s, d)),
        "genre_popularity": lambda s, d: boards.genre_popularity(L(s, d), P(s, d)),
        "genre_skips": lambda s, d: boards.genre_skips(L(s, d), P(s, d)),
        "known_track_coverage": lambda s, d: plays.known_track_coverage(L(s, d), T(s, d)),
        "artist_leaderboard": lambda s, d: boards.artist_leaderboard(L(s, d), P(s, d)),
        "artist_names": lambda s, d: boards.artist_names(no_users(s, d), P(s, d)),
        "cohort_subscription": lambda s, d: boards.cohort_subscription(L(s, d), U(s, d)),
        "cohort_gap": lambda s, d: boards.cohort_gap(L(s, d), U(s, d), PREMIUM, FREE),
        "monthly_trend": lambda s, d: plays.monthly_trend(L(s, d)),
        "implicit_ratings": lambda s, d: plays.implicit_ratings(E(s, d)),
        "strongest_ratings": _strongest,
        "heard_pairs": lambda s, d: plays.heard_pairs(E(s, d)),
        "weighted_union": lambda s, d: plays.weighted_union(E(s, d)).select(
            "user_id", "track_id", "play_duration_ms", "skipped", "weight"
        ),
        "play_outcomes": _outcomes,
        "user_plays": lambda s, d: plays.plays_of_user(E(s, d), 7).select(
            "user_id", "track_id", "play_duration_ms", "skipped", "hour_of_day", "day_of_week"
        ),
        "active_users": lambda s, d: plays.most_active(L(s, d), "user_id", 500),
        "user_sample": lambda s, d: plays.sample_users(E(s, d), 5),
        "ingest_check": _ingest_check,
        "kpis": lambda s, d: eda.kpis(E(s, d), T(s, d), U(s, d), PREMIUM),
        "value_counts_genre": lambda s, d: eda.value_counts(T(s, d), "genre"),
        "value_counts_subscription": lambda s, d: eda.value_counts(U(s, d), "subscription_type"),
        "value_counts_country": lambda s, d: eda.value_counts(U(s, d), "country", 10),
        "preferred_genre_counts": _preferred_genres,
        "describe_plays": lambda s, d: quantiles.describe(E(s, d), described, 2),
        "describe_tracks": lambda s, d: quantiles.describe(T(s, d), track_stats, 3),
        "histogram_duration": lambda s, d: eda.histogram(E(s, d), "play_duration_ms", 40),
        "histogram_energy": lambda s, d: eda.histogram(T(s, d), "energy", 40),
        "histogram_age": lambda s, d: eda.histogram(U(s, d), "age", 30),
        "feature_correlation": lambda s, d: eda.correlations(
            T(s, d), [*AUDIO_FEATURES, "tempo", "loudness", "popularity"]
        ),
        "feature_means": lambda s, d: eda.feature_means(T(s, d), AUDIO_FEATURES),
        "popularity_corr": lambda s, d: eda.popularity_correlation(no_users(s, d), P(s, d)),
        "pivot_hour_day": lambda s, d: eda.pivot_hour_day(E(s, d)),
        "pivot_user_genre": lambda s, d: eda.pivot_user_genre(E(s, d), T(s, d)),
        "peak_hour_per_day": lambda s, d: eda.peak_hour_per_day(E(s, d)),
        "peak_low_hour": lambda s, d: eda.peak_and_low(E(s, d)),
        "track_labels": lambda s, d: eda.track_labels(no_users(s, d), P(s, d)),
        "fixed_range_features": lambda s, d: _rounded(
            _tracks(s, d).select("track_id", "tempo_norm", "loudness_norm"), ["tempo_norm", "loudness_norm"]
        ),
        "minmax_features": _minmax,
        "standardised_features": _standardised,
        "taste_profiles": _profiles,
        "content_recs": lambda s, d: content.content_recommendations(E(s, d), T(s, d)),
        "content_recs_audio": lambda s, d: content.content_recommendations(
            E(s, d), T(s, d), features=AUDIO_FEATURES, digits=4
        ),
        "hybrid_recs": lambda s, d: hybrid.hybrid_recommendations(E(s, d), T(s, d)),
        "hybrid_als_recs": _hybrid_als,
        "cold_start_recs": lambda s, d: hybrid.cold_start_recommendations(E(s, d), T(s, d), U(s, d)),
        "seed_genre_recs": lambda s, d: hybrid.seed_genre_recommendations(E(s, d), T(s, d), U(s, d)),
        "recs_for_all": lambda s, d: hybrid.recommendations_for_all(E(s, d), T(s, d), U(s, d)),
        "dense_track_ids": lambda s, d: ids.dense_ids(E(s, d), "track_id", "track_idx"),
        "hash_split": _split,
        "mean_rating_errors": _mean_rating_errors,
        "mean_rating_intervals": _mean_rating_intervals,
        "listeners_by_year": _yearly_listeners,
        "popularity_ranking": _popularity_ranking,
        "als_recs": lambda s, d: _als_recs(s, d, unheard=False),
        "als_recs_unheard": lambda s, d: _als_recs(s, d, unheard=True),
        "als_metrics": _als_metrics,
        "als_ranking_metrics": _als_ranking,
        "svd_recs": _svd_recs,
        "svd_metrics": _svd_metrics,
        "als_list_checks": _als_list_checks,
        "svd_list_checks": _svd_list_checks,
        "fold_in_recs": _fold_in_recs,
        "fold_in_checks": _fold_in_checks,
        "hybrid_als_checks": _hybrid_als_checks,
        "prediction_checks": _prediction_checks,
        "cluster_checks": _cluster_checks,
        "cluster_residuals": _cluster_residuals,
        "als_residuals": _als_residuals,
        "round_trips": _round_trips,
        "pca_checks": _pca_checks,
        "kmeans_clusters": _clustered(clusters.track_clusters),
        "cluster_profile": _clustered(clusters.cluster_profile, TRACK_FEATURES),
        "cluster_labels": _clustered(lambda v, m: clusters.cluster_labels(m, v), TRACK_FEATURES),
        "silhouette": _clustered(clusters.silhouette),
        "elbow": lambda s, d: clusters.elbow(_vectors(s, d)),
        "pca2": lambda s, d: clusters.principal_components(_vectors(s, d))[0],
        "stream_play_counts": _streamed(activity.play_counts_by_window, "window_start"),
        "stream_activity": _streamed(activity.activity_by_hour, "window_start"),
        "stream_sessions": _streamed(lambda p: activity.sessions(p, "6 hours"), "session_start", "session_end"),
        "stream_ratings": _streamed_ratings,
        "pca_variance": lambda s, d: clusters.principal_components(_vectors(s, d))[1],
    }
