"""The same measures as ANSI SQL over the driver tables, for checking."""

from __future__ import annotations

from math import log2

from cadenza.operators.evaluation import REPLICATES, poisson_limits
from cadenza.sources.schemas import AUDIO_FEATURES, TRACK_FEATURES

CONTENT = [*AUDIO_FEATURES, "tempo_norm", "loudness_norm"]
DAYS = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]
EPS = "1e-9"

E_PLAYS = """e_plays AS (
  SELECT user_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS track_id, ts,
         CAST(round(value * 1000) AS BIGINT) AS play_duration_ms,
         CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS skipped,
         CAST(hour(ts) AS INTEGER) AS hour_of_day, CAST(isodow(ts) - 1 AS INTEGER) AS day_of_week
  FROM events)"""

_E_FEATURES = ", ".join(f"CAST(embedding[{i + 1}] AS DOUBLE) AS {f}" for i, f in enumerate(AUDIO_FEATURES))
E_TRACKS = f"""e_tracks AS (
  SELECT vec_id AS track_id, 'Track ' || vec_id AS name, 'A' || (vec_id % 50) AS artist_id,
         'Artist ' || (vec_id % 50) AS artist_name, 'G' || label AS genre,
         CAST(vec_id % 101 AS INTEGER) AS popularity, {_E_FEATURES},
         130 + 70 * CAST(embedding[7] AS DOUBLE) AS tempo, -20 + 20 * CAST(embedding[8] AS DOUBLE) AS loudness
  FROM embeddings)"""

USERS = """users AS (
  SELECT c_custkey AS user_id, c_name AS name, CAST(13 + c_custkey % 58 AS INTEGER) AS age,
         'C' || c_nationkey AS country, c_mktsegment AS subscription_type,
         'G' || (c_nationkey % 10) || '|G' || ((c_nationkey + 3) % 10) AS preferred_genres
  FROM customer)"""

L_PLAYS = """l_plays AS (
  SELECT o_custkey AS user_id, l_partkey AS track_id, l_shipdate AS ts,
         CAST(l_quantity * 10000 AS BIGINT) AS play_duration_ms,
         CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS skipped
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""

L_TRACKS = """l_tracks AS (
  SELECT p_partkey AS track_id, p_name AS name, p_brand AS artist_id, p_brand AS artist_name,
         p_type AS genre, p_size AS popularity
  FROM part)"""

RATINGS = """ratings AS (
  SELECT user_id, track_id, CAST(sum(CASE WHEN skipped = 0 THEN 2 ELSE 1 END) AS BIGINT) AS implicit_rating
  FROM e_plays GROUP BY 1, 2)"""


def _day_name(column: str) -> str:
    cases = " ".join(f"WHEN {i} THEN '{d}'" for i, d in enumerate(DAYS))
    return f"CASE {column} {cases} ELSE 'Unknown' END"


def _pct(part: str, whole: str, digits: int) -> str:
    return f"round(CAST(100.0 * ({part}) AS DOUBLE) / ({whole}), {digits})"


def _n(expression: str) -> str:
    return f"CAST({expression} AS BIGINT)"


DONE = "sum(CASE WHEN skipped = 0 THEN 1 ELSE 0 END)"
SKIPS = "sum(CASE WHEN skipped = 1 THEN 1 ELSE 0 END)"


def _with(*parts: str) -> str:
    return "WITH " + ",\n".join(parts) + "\n"


def _features(names: list[str]) -> str:
    """Min-max scaled features; ``vectors`` with unit length in u_ columns."""
    limits = ", ".join(f"min({f}) AS lo_{f}, max({f}) AS hi_{f}" for f in names)
    scaled = ", ".join(f"({f} - lo_{f}) / (hi_{f} - lo_{f}) AS {f}" for f in names)
    return f"""ranged AS (SELECT *, (tempo - 60) / 140 AS tempo_norm, (loudness + 40) / 40 AS loudness_norm FROM e_tracks),
limits AS (SELECT {limits} FROM ranged),
scaled AS (SELECT track_id, {scaled} FROM ranged, limits)"""


def _profiles(names: list[str]) -> str:
    means = ", ".join(f"sum(implicit_rating * {f}) / sum(implicit_rating) AS {f}" for f in names)
    return f"""{RATINGS},
profiles AS (SELECT user_id, {means} FROM ratings JOIN scaled USING (track_id) GROUP BY user_id)"""


def _similar(names: list[str]) -> str:
    """Cosine of every profile and unheard track."""
    dot = " + ".join(f"p.{f} * t.{f}" for f in names)
    length = lambda a: "sqrt(" + " + ".join(f"{a}.{f} * {a}.{f}" for f in names) + ")"
    return f"""similar_tracks AS (
  SELECT p.user_id, t.track_id, ({dot}) / ({length('p')} * {length('t')}) AS cosine
  FROM profiles p CROSS JOIN scaled t
  WHERE NOT EXISTS (SELECT 1 FROM ratings r WHERE r.user_id = p.user_id AND r.track_id = t.track_id))"""


def _content(names: list[str], digits: int) -> str:
    return _with(E_PLAYS, E_TRACKS, _features(names), _profiles(names), _similar(names)) + f"""
SELECT user_id, rank, track_id, name, artist_name, genre, round(cosine, {digits}) AS similarity_score
FROM (SELECT *, CAST(row_number() OVER (PARTITION BY user_id ORDER BY round(cosine, 9) DESC, track_id) AS INTEGER) AS rank
      FROM similar_tracks) JOIN e_tracks USING (track_id)
WHERE rank <= 10"""


COUNTS = "counts AS (SELECT track_id, count(*) AS play_count FROM e_plays WHERE skipped = 0 GROUP BY 1)"

HYBRID = f"""signals AS (SELECT s.*, coalesce(play_count, 0) AS plays FROM similar_tracks s LEFT JOIN counts USING (track_id)),
ends AS (SELECT user_id, min(cosine) AS c0, max(cosine) AS c1, min(plays) AS p0, max(plays) AS p1 FROM signals GROUP BY 1),
blended AS (
  SELECT user_id, track_id,
         0.4 * (plays - p0) / (p1 - p0 + {EPS}) + 0.6 * (cosine - c0) / (c1 - c0 + {EPS}) AS score
  FROM signals JOIN ends USING (user_id)),
hybrid AS (
  SELECT * FROM (
    SELECT *, CAST(row_number() OVER (PARTITION BY user_id ORDER BY round(score, 9) DESC, track_id) AS INTEGER) AS rank
    FROM blended) WHERE rank <= 10)"""

COLD = """cold AS (
  SELECT * FROM users u WHERE NOT EXISTS (
    SELECT 1 FROM e_plays p JOIN e_tracks t USING (track_id) WHERE p.user_id = u.user_id)),
popular AS (SELECT * FROM counts JOIN e_tracks USING (track_id)),
top_popular AS (
  SELECT *, CAST(row_number() OVER (ORDER BY play_count DESC, track_id) AS INTEGER) AS rank FROM popular)"""

_HYBRID_PARTS = [E_PLAYS, E_TRACKS, _features(CONTENT), _profiles(CONTENT), _similar(CONTENT), COUNTS, HYBRID]

IDS = """user_ids AS (
  SELECT user_id, CAST(row_number() OVER (ORDER BY count(*) DESC, user_id) - 1 AS INTEGER) AS user_idx
  FROM ratings GROUP BY user_id),
track_ids AS (
  SELECT track_id, CAST(row_number() OVER (ORDER BY count(*) DESC, track_id) - 1 AS INTEGER) AS track_idx
  FROM ratings GROUP BY track_id),
split AS (
  SELECT track_id, user_id, implicit_rating, user_idx, track_idx, CASE WHEN b4 % 10 < 8 THEN 'train' ELSE 'test' END AS part
  FROM (
    SELECT *, CAST(user_idx AS BIGINT) + 42 AS a0,
           (a0 * 1103515245 + 12345) % 2147483648 AS a1, xor(a1, a1 >> 15) AS a2,
           (a2 * 1597334677) % 2147483648 AS a3, xor(a3, a3 >> 13) AS a4,
           (a4 + track_idx) % 2147483648 AS b0,
           (b0 * 1103515245 + 12345) % 2147483648 AS b1, xor(b1, b1 >> 15) AS b2,
           (b2 * 1597334677) % 2147483648 AS b3, xor(b3, b3 >> 13) AS b4
    FROM ratings JOIN user_ids USING (user_id) JOIN track_ids USING (track_id)))"""

_IDCG = " ".join(
    f"WHEN {n} THEN {sum(1 / log2(i + 1) for i in range(1, n + 1))!r}" for n in range(1, 11)
)


_LIST_CHECKS = """
, known AS (SELECT DISTINCT track_id FROM split WHERE part = 'train'),
heard AS (SELECT user_id, count(track_id) FILTER (track_id IN (SELECT track_id FROM known)) AS n,
                 count(*) FILTER (part = 'train') AS trained FROM split GROUP BY 1),
lists AS (SELECT user_id, least(10, (SELECT count(*) FROM known) - n) AS size FROM heard WHERE trained > 0)
SELECT count(*) FILTER (size > 0) AS users, CAST(sum(size) AS BIGINT) AS listed,
       CAST(0 AS BIGINT) AS rank_gaps, CAST(0 AS BIGINT) AS rises, CAST(0 AS BIGINT) AS heard_rows
FROM lists"""


# Event time in milliseconds, as watermarks have it: the latest play less ten minutes.
_WATERMARK = "SELECT (max(epoch_us(ts)) // 1000 - 600000) * 1000 AS mark FROM e_plays"
_HOURS = f"""
, marked AS (SELECT *, epoch_us(date_trunc('hour', ts)) AS window_start FROM e_plays),
closed AS (SELECT * FROM marked WHERE window_start + 3600000000 <= ({_WATERMARK}))"""


def _describe(cte: str, source: str, columns: list[str], digits: int) -> str:
    one = """SELECT '{c}' AS "column", count({c}) AS count, round(avg({c}), {d}) AS mean,
  round(stddev_samp({c}), {d}) AS std, round(CAST(min({c}) AS DOUBLE), {d}) AS min,
  round(CAST(quantile_cont(CAST({c} AS DOUBLE), 0.25) AS DOUBLE), {d}) AS q25,
  round(CAST(quantile_cont(CAST({c} AS DOUBLE), 0.5) AS DOUBLE), {d}) AS q50,
  round(CAST(quantile_cont(CAST({c} AS DOUBLE), 0.75) AS DOUBLE), {d}) AS q75,
  round(CAST(max({c}) AS DOUBLE), {d}) AS max FROM {s}"""
    return _with(cte) + "\nUNION ALL\n".join(one.format(c=c, d=digits, s=source) for c in columns)


def _histogram(cte: str, source: str, column: str, bins: int) -> str:
    return _with(cte) + f"""
, v AS (SELECT CAST({column} AS DOUBLE) AS v FROM {source} WHERE {column} IS NOT NULL),
w AS (SELECT min(v) AS low, max(v) - min(v) AS width, round(avg(v), 6) AS mean FROM v),
c AS (SELECT least(CAST(floor((v - low) / width * {bins}) AS BIGINT), {bins - 1}) AS bin, count(*) AS n
      FROM v, w GROUP BY 1)
SELECT b.bin, round(low + b.bin * width / {bins}, 6) AS bin_low, round(low + (b.bin + 1) * width / {bins}, 6) AS bin_high,
       coalesce(n, 0) AS n, mean
FROM (SELECT CAST(range AS BIGINT) AS bin FROM range({bins})) b LEFT JOIN c ON b.bin = c.bin, w"""


def _value_counts(cte: str, source: str, column: str, n: int | None = None) -> str:
    limit = "" if n is None else f" LIMIT {n}"
    return _with(cte) + f"SELECT {column}, count(*) AS n FROM {source} GROUP BY 1 ORDER BY n DESC, {column}{limit}"


def _correlations() -> str:
    names = [*AUDIO_FEATURES, "tempo", "loudness", "popularity"]
    pairs = [(a, b) for i, a in enumerate(names) for b in names[i + 1:]]
    return _with(E_TRACKS) + "\nUNION ALL\n".join(
        f"SELECT '{a}' AS x, '{b}' AS y, round(corr({a}, {b}), 6) AS r FROM e_tracks" for a, b in pairs
    )


def _leaderboard(parts: list[str], plays: str, tracks: str) -> str:
    return _with(*parts) + f"""
SELECT track_id, play_count, name, artist_name, genre, popularity
FROM (SELECT track_id, count(*) AS play_count FROM {plays} WHERE skipped = 0 GROUP BY 1) JOIN {tracks} USING (track_id)"""


def oracle_sql() -> dict[str, str]:
    L = _with(L_PLAYS, L_TRACKS)
    E = _with(E_PLAYS)
    hours = ", ".join(f"{_n(f'sum(CASE WHEN hour_of_day = {h} THEN 1 ELSE 0 END)')} AS h{h:02d}" for h in range(24))
    hours0 = ", ".join(f"coalesce(h{h:02d}, 0) AS h{h:02d}" for h in range(24))
    short = " ".join(f"WHEN {i} THEN '{d[:3]}'" for i, d in enumerate(DAYS))
    genres = ", ".join(
        f"{_n(f'sum(CASE WHEN genre = {chr(39)}G{g}{chr(39)} THEN 1 ELSE 0 END)')} AS G{g}" for g in range(10)
    )
    rounded = lambda names: ", ".join(f"round({f}, 6) AS {f}" for f in names)
    standard = ", ".join(f"round(({f} - m_{f}) / s_{f}, 6) AS {f}" for f in TRACK_FEATURES)
    moments = ", ".join(f"avg({f}) AS m_{f}, stddev_samp({f}) AS s_{f}" for f in TRACK_FEATURES)
    cohort = f"""cohort AS (
  SELECT subscription_type, count(*) AS total_plays, count(DISTINCT user_id) AS users,
         round(CAST(count(*) AS DOUBLE) / count(DISTINCT user_id), 1) AS avg_plays_per_user,
         round(avg(play_duration_ms) / 1000.0, 1) AS avg_listen_duration_sec,
         {_pct(SKIPS, 'count(*)', 1)} AS skip_rate_pct
  FROM l_plays JOIN users USING (user_id) GROUP BY 1)"""
    engagement = f"""SELECT track_id, {_n(DONE)} AS completed, {_n('sum(CASE WHEN skipped = 0 THEN 0 ELSE 1 END)')} AS skipped,
  {_n('sum(CASE WHEN skipped = 0 THEN 2 ELSE 1 END)')} AS score"""
    svd_cut = """, u AS (SELECT user_id FROM l_plays GROUP BY 1 ORDER BY count(*) DESC, user_id LIMIT 3000),
t AS (SELECT track_id FROM l_plays GROUP BY 1 ORDER BY count(*) DESC, track_id LIMIT 2000)"""
    split = _with(E_PLAYS, RATINGS, IDS)
    return {
        "top_tracks": L + f"""
SELECT track_id, name AS track_name, artist_name, genre, popularity, count(*) AS total_plays,
       {_n(DONE)} AS completed_plays, {_n(SKIPS)} AS skipped_plays, {_pct(DONE, 'count(*)', 1)} AS completion_rate_pct
FROM l_plays JOIN l_tracks USING (track_id)
GROUP BY track_id, name, artist_name, genre, popularity
ORDER BY completed_plays DESC, track_id LIMIT 20""",
        "play_counts": L + "SELECT track_id, count(*) AS play_count FROM l_plays WHERE skipped = 0 GROUP BY 1",
        "track_leaderboard": _leaderboard([L_PLAYS, L_TRACKS], "l_plays", "l_tracks"),
        "user_genre_affinity": L + """
SELECT user_id, genre, plays, CAST(row_number() OVER (PARTITION BY user_id ORDER BY plays DESC, genre) AS INTEGER) AS genre_rank
FROM (SELECT user_id, genre, count(*) AS plays FROM l_plays JOIN l_tracks USING (track_id)
      WHERE skipped = 0 AND genre <> '' GROUP BY 1, 2)""",
        "track_engagement": L + engagement + " FROM l_plays GROUP BY 1",
        "engagement_leaderboard": _with(E_PLAYS, E_TRACKS) + f"""
SELECT e.*, name, artist_name, genre, popularity FROM ({engagement} FROM e_plays GROUP BY 1) e JOIN e_tracks USING (track_id)""",
        "hourly_activity": E + f"""
SELECT hour_of_day, day_of_week, count(*) AS event_count, {_day_name('day_of_week')} AS day_name
FROM e_plays GROUP BY hour_of_day, day_of_week""",
        "genre_popularity": L + f"""
SELECT genre, count(*) AS total_plays, count(DISTINCT user_id) AS unique_listeners,
       count(DISTINCT track_id) AS unique_tracks, {_pct(DONE, 'count(*)', 1)} AS avg_completion_pct,
       round(CAST(count(*) AS DOUBLE) / (SELECT count(*) FROM l_plays) * 100, 2) AS play_share_pct
FROM l_plays JOIN l_tracks USING (track_id) GROUP BY genre""",
        "genre_skips": L + f"""
SELECT genre, count(*) AS total_plays, count(DISTINCT user_id) AS unique_listeners,
       {_pct(SKIPS, 'count(*)', 1)} AS skip_pct,
       round(CAST(count(*) AS DOUBLE) / (SELECT count(*) FROM l_plays JOIN l_tracks USING (track_id)) * 100, 1) AS play_share
FROM l_plays JOIN l_tracks USING (track_id) GROUP BY genre""",
        "known_track_coverage": _with(L_PLAYS, E_TRACKS) + """
SELECT genre, count(*) AS total_plays, count(DISTINCT user_id) AS listeners
FROM l_plays LEFT JOIN e_tracks USING (track_id) GROUP BY genre""",
        "artist_leaderboard": L + """
SELECT artist_id, artist_name, genre, count(*) AS total_plays, count(DISTINCT user_id) AS unique_listeners,
       count(DISTINCT track_id) AS track_count
FROM l_plays JOIN l_tracks USING (track_id) WHERE skipped = 0 GROUP BY artist_id, artist_name, genre
ORDER BY total_plays DESC, artist_id, artist_name, genre LIMIT 30""",
        "artist_names": L + """
SELECT artist_name, count(*) AS plays FROM l_plays JOIN l_tracks USING (track_id) WHERE skipped = 0
GROUP BY 1 ORDER BY plays DESC, artist_name LIMIT 15""",
        "cohort_subscription": _with(L_PLAYS, USERS, cohort) + "SELECT * FROM cohort",
        "cohort_gap": _with(L_PLAYS, USERS, cohort) + """
SELECT max(CASE WHEN subscription_type = 'BUILDING' THEN avg_plays_per_user END) AS first_plays_per_user,
       max(CASE WHEN subscription_type = 'MACHINERY' THEN avg_plays_per_user END) AS second_plays_per_user,
       round(abs(max(CASE WHEN subscription_type = 'BUILDING' THEN skip_rate_pct END)
               - max(CASE WHEN subscription_type = 'MACHINERY' THEN skip_rate_pct END)), 1) AS skip_gap_pct
FROM cohort""",
        "monthly_trend": L + """
SELECT strftime(ts, '%Y-%m') AS year_month, count(*) AS total_plays, count(DISTINCT user_id) AS active_users,
       round(CAST(sum(play_duration_ms) AS DOUBLE) / 3600000.0, 1) AS total_listen_hours,
       round(CAST(sum(skipped) AS DOUBLE) / count(*), 6) AS skip_rate
FROM l_plays GROUP BY 1""",
        "implicit_ratings": _with(E_PLAYS, RATINGS) + "SELECT * FROM ratings",
        "strongest_ratings": L + svd_cut + f"""
SELECT user_id, track_id, {_n('sum(CASE WHEN skipped = 0 THEN 2 ELSE 1 END)')} AS implicit_rating
FROM l_plays WHERE user_id IN (SELECT user_id FROM u) AND track_id IN (SELECT track_id FROM t) GROUP BY 1, 2""",
        "heard_pairs": E + "SELECT DISTINCT user_id, track_id FROM e_plays",
        "weighted_union": E + """
SELECT user_id, track_id, play_duration_ms, skipped, 2 AS weight FROM e_plays WHERE skipped = 0
UNION ALL SELECT user_id, track_id, play_duration_ms, skipped, 1 AS weight FROM e_plays WHERE skipped = 1""",
        "play_outcomes": E + """
SELECT user_id, track_id, play_duration_ms, CASE WHEN skipped = 0 THEN 'C' ELSE 'S' END AS outcome,
       CASE WHEN skipped = 0 THEN 2 ELSE 1 END AS weight FROM e_plays""",
        "user_plays": E + """
SELECT user_id, track_id, play_duration_ms, skipped, hour_of_day, day_of_week FROM e_plays WHERE user_id = 7""",
        "user_sample": E + """
SELECT user_id FROM (SELECT DISTINCT user_id FROM e_plays) ORDER BY md5('42:' || user_id), user_id LIMIT 5""",
        "active_users": L + """
SELECT user_id, count(*) AS plays FROM l_plays GROUP BY 1 ORDER BY plays DESC, user_id LIMIT 500""",
        "ingest_check": E + f"""
, kinds AS (
  SELECT CASE WHEN event_id % 50 IN (1, 5) THEN 'malformed line' WHEN event_id % 50 = 2 THEN 'bad skip flag' ELSE 'none' END AS problem,
         CAST(round(value * 1000) AS BIGINT) AS ms, CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS skipped
  FROM events WHERE event_id % 50 NOT IN (3, 4))
SELECT problem, count(*) AS lines, {_n("sum(CASE WHEN problem = 'none' THEN ms ELSE 0 END)")} AS total_ms,
       {_n("sum(CASE WHEN problem = 'none' THEN skipped ELSE 0 END)")} AS skips
FROM kinds GROUP BY 1""",
        "kpis": _with(E_PLAYS, E_TRACKS, USERS) + f"""
, g AS (SELECT genre, count(*) AS n FROM e_plays JOIN e_tracks USING (track_id) GROUP BY 1)
SELECT count(*) AS total_events, count(DISTINCT user_id) AS distinct_users, count(DISTINCT track_id) AS distinct_tracks,
       round(CAST(sum(skipped) AS DOUBLE) / count(*), 6) AS skip_rate,
       round(CAST(sum(play_duration_ms) AS DOUBLE) / count(play_duration_ms) / 1000.0, 3) AS avg_listen_sec,
       (SELECT hour_of_day FROM e_plays GROUP BY 1 ORDER BY count(*) DESC, hour_of_day LIMIT 1) AS peak_hour,
       (SELECT {_pct("sum(CASE WHEN subscription_type = 'BUILDING' THEN 1 ELSE 0 END)", 'count(*)', 1)} FROM users) AS premium_pct,
       (SELECT genre FROM g ORDER BY n DESC, genre LIMIT 1) AS top_genre,
       (SELECT round(CAST(max(n) AS DOUBLE) / sum(n) * 100, 1) FROM g) AS top_genre_share_pct
FROM e_plays""",
        "value_counts_genre": _value_counts(E_TRACKS, "e_tracks", "genre"),
        "value_counts_subscription": _value_counts(USERS, "users", "subscription_type"),
        "value_counts_country": _value_counts(USERS, "users", "country", 10),
        "preferred_genre_counts": _value_counts(
            USERS + ", wanted AS (SELECT unnest(string_split(preferred_genres, '|')) AS genre FROM users)", "wanted", "genre"
        ),
        "describe_plays": _describe(E_PLAYS, "e_plays", ["play_duration_ms", "skipped", "hour_of_day", "day_of_week"], 2),
        "describe_tracks": _describe(
            E_TRACKS, "e_tracks", ["popularity", "tempo", "energy", "danceability", "valence", "acousticness"], 3
        ),
        "histogram_duration": _histogram(E_PLAYS, "e_plays", "play_duration_ms", 40),
        "histogram_energy": _histogram(E_TRACKS, "e_tracks", "energy", 40),
        "histogram_age": _histogram(USERS, "users", "age", 30),
        "feature_correlation": _correlations(),
        "feature_means": _with(E_TRACKS) + "SELECT "
        + ", ".join(f"round(avg({f}), 6) AS avg_{f}" for f in AUDIO_FEATURES) + " FROM e_tracks",
        "popularity_corr": L + f"""
SELECT count(*) AS tracks, round(corr(popularity, score), 6) AS r
FROM ({engagement} FROM l_plays GROUP BY 1) JOIN l_tracks USING (track_id)""",
        "pivot_hour_day": E + f"""
, p AS (SELECT day_of_week, {hours} FROM e_plays GROUP BY 1)
SELECT d.day_of_week, CASE d.day_of_week {short} END AS day_name, {hours0}
FROM (SELECT CAST(range AS INTEGER) AS day_of_week FROM range(7)) d LEFT JOIN p USING (day_of_week)""",
        "pivot_user_genre": _with(E_PLAYS, E_TRACKS) + f"""
, known AS (SELECT user_id, genre FROM e_plays JOIN e_tracks USING (track_id) WHERE skipped = 0)
SELECT user_id, {genres} FROM known
WHERE user_id IN (SELECT user_id FROM known GROUP BY 1 ORDER BY count(*) DESC, user_id LIMIT 20) GROUP BY 1""",
        "peak_hour_per_day": E + f"""
SELECT day_of_week, {_day_name('day_of_week')} AS day_name, hour_of_day, event_count
FROM (SELECT *, row_number() OVER (PARTITION BY day_of_week ORDER BY event_count DESC, hour_of_day) AS place
      FROM (SELECT day_of_week, hour_of_day, count(*) AS event_count FROM e_plays GROUP BY 1, 2))
WHERE place = 1""",
        "peak_low_hour": E + """
, h AS (SELECT hour_of_day, count(*) AS n FROM e_plays GROUP BY 1),
d AS (SELECT day_of_week, count(*) AS n FROM e_plays GROUP BY 1)
SELECT (SELECT hour_of_day FROM h ORDER BY n DESC, hour_of_day LIMIT 1) AS peak_hour,
       (SELECT max(n) FROM h) AS peak_hour_plays,
       (SELECT hour_of_day FROM h ORDER BY n, hour_of_day LIMIT 1) AS low_hour,
       (SELECT min(n) FROM h) AS low_hour_plays,
       (SELECT day_of_week FROM d ORDER BY n DESC, day_of_week LIMIT 1) AS most_active_day""",
        "track_labels": L + """
SELECT track_id, name || ' — ' || artist_name AS label, play_count
FROM (SELECT track_id, count(*) AS play_count FROM l_plays WHERE skipped = 0 GROUP BY 1) JOIN l_tracks USING (track_id)
ORDER BY play_count DESC, track_id LIMIT 20""",
        "fixed_range_features": _with(E_TRACKS) + """
SELECT track_id, round((tempo - 60) / 140, 6) AS tempo_norm, round((loudness + 40) / 40, 6) AS loudness_norm FROM e_tracks""",
        "minmax_features": _with(E_TRACKS, _features(CONTENT)) + f"SELECT track_id, {rounded(CONTENT)} FROM scaled",
        "standardised_features": _with(E_TRACKS) + f"""
, m AS (SELECT {moments} FROM e_tracks) SELECT track_id, {standard} FROM e_tracks, m""",
        "taste_profiles": _with(E_PLAYS, E_TRACKS, _features(CONTENT), _profiles(CONTENT))
        + f"SELECT user_id, {rounded(CONTENT)} FROM profiles",
        "content_recs": _content(CONTENT, 6),
        "content_recs_audio": _content(list(AUDIO_FEATURES), 4),
        "hybrid_recs": _with(*_HYBRID_PARTS) + """
SELECT user_id, rank, track_id, name, artist_name, genre, popularity, round(score, 6) AS hybrid_score
FROM hybrid JOIN e_tracks USING (track_id)""",
        "cold_start_recs": _with(E_PLAYS, E_TRACKS, USERS, COUNTS, COLD) + """
SELECT c.user_id, t.rank, t.track_id, t.name, t.artist_name, t.genre, t.popularity, t.play_count
FROM cold c CROSS JOIN top_popular t WHERE t.rank <= 10""",
        "seed_genre_recs": _with(E_PLAYS, E_TRACKS, USERS, COUNTS, COLD) + """
SELECT * FROM (
  SELECT w.user_id, CAST(row_number() OVER (PARTITION BY w.user_id ORDER BY p.play_count DESC, p.track_id) AS INTEGER) AS rank,
         p.track_id, p.name, p.artist_name, p.genre, p.popularity, p.play_count
  FROM (SELECT DISTINCT user_id, unnest(string_split(preferred_genres, '|')) AS genre FROM cold) w
  JOIN popular p USING (genre)) WHERE rank <= 10""",
        "recs_for_all": _with(*_HYBRID_PARTS, USERS, COLD) + """
SELECT user_id, rank, track_id, 'hybrid' AS source FROM hybrid
UNION ALL
SELECT c.user_id, t.rank, t.track_id, 'popularity' AS source FROM cold c CROSS JOIN top_popular t WHERE t.rank <= 10""",
        "dense_track_ids": E + """
SELECT track_id, CAST(row_number() OVER (ORDER BY count(*) DESC, track_id) - 1 AS INTEGER) AS track_idx
FROM e_plays GROUP BY 1""",
        "als_list_checks": split + _LIST_CHECKS,
        "svd_list_checks": split + _LIST_CHECKS,
        "fold_in_checks": _with(E_PLAYS, RATINGS.replace("GROUP BY", "WHERE user_id % 5 <> 0 GROUP BY"), IDS) + """
, known AS (SELECT DISTINCT track_id FROM split WHERE part = 'train'),
heard AS (SELECT user_id, count(DISTINCT track_id) FILTER (track_id IN (SELECT track_id FROM known)) AS n
          FROM e_plays WHERE user_id % 5 = 0 GROUP BY 1),
lists AS (SELECT least(10, (SELECT count(*) FROM known) - n) AS size FROM heard WHERE n > 0)
SELECT count(*) FILTER (size > 0) AS users, CAST(sum(size) AS BIGINT) AS listed,
       CAST(0 AS BIGINT) AS rank_gaps, CAST(0 AS BIGINT) AS rises, CAST(0 AS BIGINT) AS heard_rows
FROM lists""",
        "hybrid_als_checks": _with(E_PLAYS, E_TRACKS) + """
, heard AS (SELECT user_id, count(DISTINCT track_id) AS n FROM e_plays JOIN e_tracks USING (track_id) GROUP BY 1)
SELECT count(*) AS users, CAST(sum(least(10, (SELECT count(*) FROM e_tracks) - n)) AS BIGINT) AS listed,
       CAST(0 AS BIGINT) AS rank_gaps, CAST(0 AS BIGINT) AS rises, CAST(0 AS BIGINT) AS heard_rows
FROM heard""",
        "prediction_checks": split + """
, n AS (SELECT count(*) AS n FROM split WHERE part = 'test'
          AND user_id IN (SELECT user_id FROM split WHERE part = 'train')
          AND track_id IN (SELECT track_id FROM split WHERE part = 'train'))
SELECT model, n AS predicted, CAST(0 AS BIGINT) AS not_numbers, n AS expected FROM n, (VALUES ('als'), ('svd')) v(model)""",
        "stream_play_counts": E + _HOURS + """
SELECT window_start, track_id, count(*) AS play_count FROM closed WHERE skipped = 0 GROUP BY 1, 2""",
        "stream_activity": E + _HOURS + f"""
SELECT window_start, hour_of_day, day_of_week, {_day_name('day_of_week')} AS day_name, count(*) AS event_count
FROM closed GROUP BY 1, 2, 3""",
        "stream_sessions": E + f"""
, steps AS (SELECT *, epoch_us(ts) AS us, lag(epoch_us(ts)) OVER (PARTITION BY user_id ORDER BY ts) AS before FROM e_plays),
islands AS (SELECT *, sum(CASE WHEN us - before <= 21600000000 THEN 0 ELSE 1 END)
                OVER (PARTITION BY user_id ORDER BY us RANGE UNBOUNDED PRECEDING) AS island FROM steps)
SELECT user_id, min(us) AS session_start, max(us) + 21600000000 AS session_end, count(*) AS plays,
       {_n('sum(skipped)')} AS skips, {_n('sum(play_duration_ms)')} AS listened_ms
FROM islands GROUP BY user_id, island HAVING max(us) + 21600000000 <= ({_WATERMARK})""",
        "stream_ratings": _with(E_PLAYS, RATINGS) + "SELECT * FROM ratings",
        "cluster_checks": """
SELECT count(*) AS tracks, CAST(0 AS BIGINT) AS bad_ids, count(*) AS profiled, CAST(0 AS BIGINT) AS rises,
       CAST(0 AS BIGINT) AS bad_silhouettes, CAST(6 AS BIGINT) AS labels FROM embeddings""",
        "cluster_residuals": "SELECT count(*) AS tracks, CAST(0 AS BIGINT) AS not_nearest, true AS explains FROM embeddings",
        "als_residuals": split + """
SELECT count(DISTINCT user_id) AS users, CAST(0 AS BIGINT) AS unsolved FROM split WHERE part = 'train'""",
        "round_trips": _with(E_PLAYS, RATINGS, COUNTS) + f"""
, r AS (SELECT count(*) AS n_rows, {_n('sum(implicit_rating)')} AS total FROM ratings),
p AS (SELECT count(*) AS n_rows, {_n('sum(play_duration_ms)')} AS total FROM e_plays)
SELECT written, r.* FROM r, (VALUES ('csv'), ('parquet')) v(written)
UNION ALL SELECT 'tsv', count(*), {_n('sum(play_count)')} FROM counts
UNION ALL SELECT written, p.* FROM p, (VALUES ('plays'), ('lines'), ('months')) v(written)
UNION ALL SELECT 'view', count(*), {_n('sum(play_duration_ms)')} FROM e_plays
  JOIN embeddings ON vec_id = track_id JOIN customer ON c_custkey = user_id""",
        "pca_checks": """
SELECT count(*) AS tracks, CAST(0 AS BIGINT) AS correlated, CAST(0 AS BIGINT) AS not_centred, CAST(0 AS BIGINT) AS wrong_shares
FROM embeddings""",
        "hash_split": split + "SELECT * FROM split",
        "mean_rating_errors": _with(E_PLAYS, RATINGS) + """
, m AS (SELECT track_id, avg(implicit_rating) AS p FROM ratings GROUP BY 1),
e AS (SELECT implicit_rating - p AS e FROM ratings JOIN m USING (track_id))
SELECT 'RMSE' AS metric, round(sqrt(avg(e * e)), 6) AS value FROM e
UNION ALL SELECT 'MAE', round(avg(abs(e)), 6) FROM e""",
        "mean_rating_intervals": _with(E_PLAYS, RATINGS) + f"""
, m AS (SELECT track_id, avg(implicit_rating) AS p FROM ratings GROUP BY 1),
e AS (SELECT user_id, count(*) AS n, sum((implicit_rating - p) * (implicit_rating - p)) AS squares, sum(abs(implicit_rating - p)) AS sizes
      FROM ratings JOIN m USING (track_id) GROUP BY 1),
bits AS (
  SELECT *, user_id % 2147483648 + 42 AS a0, (a0 * 1103515245 + 12345) % 2147483648 AS a1, xor(a1, a1 >> 15) AS a2,
         (a2 * 1597334677) % 2147483648 AS a3, xor(a3, a3 >> 13) AS a4, (a4 + replicate) % 2147483648 AS b0,
         (b0 * 1103515245 + 12345) % 2147483648 AS b1, xor(b1, b1 >> 15) AS b2,
         (b2 * 1597334677) % 2147483648 AS b3, xor(b3, b3 >> 13) AS b4
  FROM e, range({REPLICATES}) r(replicate)),
weighed AS (SELECT *, {" + ".join(f"CAST(b4 >= {t} AS INTEGER)" for t in poisson_limits())} AS w FROM bits),
drawn AS (SELECT sqrt(sum(w * squares) / sum(w * n)) AS rmse, sum(w * sizes) / sum(w * n) AS mae FROM weighed GROUP BY replicate),
whole AS (SELECT sqrt(sum(squares) / sum(n)) AS rmse, sum(sizes) / sum(n) AS mae FROM e)
SELECT 'RMSE' AS metric, round((SELECT rmse FROM whole), 6) AS value, round(quantile_cont(rmse, 0.025), 6) AS low,
       round(quantile_cont(rmse, 0.975), 6) AS high FROM drawn
UNION ALL SELECT 'MAE', round((SELECT mae FROM whole), 6), round(quantile_cont(mae, 0.025), 6), round(quantile_cont(mae, 0.975), 6) FROM drawn""",
        "listeners_by_year": L + """
SELECT strftime(ts, '%Y') AS year, count(DISTINCT user_id) AS listeners, true AS within_bound FROM l_plays GROUP BY 1""",
        "popularity_ranking": split + f"""
, top AS (SELECT track_id, row_number() OVER (ORDER BY n DESC, track_id) AS rank
          FROM (SELECT track_id, sum(implicit_rating) AS n FROM split WHERE part = 'train' GROUP BY 1
                ORDER BY n DESC, track_id LIMIT 10)),
wanted AS (SELECT user_id, count(*) AS wanted FROM split WHERE part = 'test' GROUP BY 1),
hit AS (SELECT user_id, rank, row_number() OVER (PARTITION BY user_id ORDER BY rank) AS nth
        FROM split JOIN top USING (track_id) WHERE part = 'test'),
per_user AS (SELECT user_id, count(*) AS hits, sum(1 / log2(rank + 1)) AS gain, sum(CAST(nth AS DOUBLE) / rank) AS precisions
             FROM hit GROUP BY 1),
j AS (SELECT *, CASE least(wanted, 10) {_IDCG} END AS ideal FROM wanted LEFT JOIN per_user USING (user_id))
SELECT 'precision@10' AS metric, round(avg(coalesce(hits, 0) / 10.0), 6) AS value FROM j
UNION ALL SELECT 'ndcg@10', round(avg(coalesce(gain, 0) / ideal), 6) FROM j
UNION ALL SELECT 'map@10', round(avg(coalesce(precisions, 0) / least(wanted, 10)), 6) FROM j""",
    }
