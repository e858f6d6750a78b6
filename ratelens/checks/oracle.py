"""DuckDB SQL for the registered queries, over the same retail tables."""

from __future__ import annotations

from ratelens.checks.registry import (
    CLASS_FEATURES,
    LOAD_DATE,
    MIN_RATINGS,
    QUANTILE_COLUMNS,
    QUANTILE_FRACTIONS,
    REPLICATES,
    SCALED,
    TREES,
    USER_SAMPLE,
)
from ratelens.functions.text import feature_name
from ratelens.functions.vocabulary import (
    AGE_RATINGS,
    COMPACT_VOCABULARY,
    FULL_VOCABULARY,
    GENRES,
    SOURCES,
    STUDIOS,
    TYPES,
)
from ratelens.operators.behaviour import PROFILE_COLUMNS, SCALED_COLUMNS
from ratelens.operators.bootstrap import DRAWS, poisson_cuts
from ratelens.plans import features as feature_plans
from ratelens.plans.runner import BATCHES


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _list(values) -> str:
    return "[" + ", ".join(_text(v) for v in values) + "]"


RAW = f"""
raw_users AS (
  SELECT c_custkey AS user_id, c_name AS username,
    CASE WHEN c_mktsegment IN ('BUILDING', 'AUTOMOBILE') THEN 'Female'
         WHEN c_mktsegment IN ('MACHINERY', 'FURNITURE') THEN 'Male' END AS gender,
    CASE WHEN c_custkey % 10 <> 9 THEN DATE '1970-01-01' + CAST(c_custkey % 9000 AS INTEGER) END AS birthday,
    CASE WHEN n_name = 'NATION_3' THEN 'Canada' WHEN n_name = 'NATION_4' THEN 'USA'
         WHEN n_name <> 'NATION_7' THEN n_name END AS location,
    (SELECT CAST(min(o_orderdate) AS DATE) FROM orders WHERE o_custkey = c_custkey) AS joined,
    CASE WHEN c_custkey % 50 <> 0 THEN c_acctbal / 1000.0::DOUBLE END AS mean_score,
    CAST(floor(abs(c_acctbal)) AS INTEGER) AS completed,
    CAST(c_custkey % 20 AS INTEGER) AS watching, CAST(c_custkey % 7 AS INTEGER) AS on_hold,
    CAST(c_custkey % 11 AS INTEGER) AS dropped, CAST(c_custkey % 50 AS INTEGER) AS plan_to_watch,
    CAST(CASE WHEN c_custkey % 97 = 0 THEN 0
              ELSE floor(abs(c_acctbal)) + c_custkey % 20 + c_custkey % 11 END AS INTEGER) AS total_entries,
    CAST(c_custkey % 5 AS INTEGER) AS rewatched,
    CAST(floor(abs(c_acctbal)) AS INTEGER) / 60.0::DOUBLE AS days_watched,
    CAST(floor(abs(c_acctbal)) AS INTEGER) * 12 AS episodes_watched
  FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey
), part_numbers AS (
  SELECT *, CAST(substr(p_brand, 7) AS INTEGER) AS brand, {_list(GENRES)} AS genre_words,
    {_list(STUDIOS)} AS studio_words
  FROM part
), raw_titles AS (
  SELECT p_partkey AS anime_id, p_name AS name, upper(p_name) AS english_name,
    CASE WHEN p_partkey % 10 <> 3 THEN CASE p_type WHEN 'ECONOMY' THEN 'TV' WHEN 'LARGE' THEN 'Movie'
      WHEN 'MEDIUM' THEN 'OVA' WHEN 'PROMO' THEN 'ONA' WHEN 'SMALL' THEN 'Special'
      WHEN 'STANDARD' THEN 'Music' END END AS type,
    ({_list(SOURCES)})[p_partkey % 10 + 1] AS source,
    genre_words[p_partkey % 30 + 1] || ', ' || genre_words[p_size % 29 + 1] || ', '
      || genre_words[p_size % 7 + 1] AS genres,
    CASE WHEN brand % 5 = 0 THEN studio_words[brand % 20 + 1] || ', ' || studio_words[(brand + 3) % 20 + 1]
         WHEN brand % 11 <> 1 THEN studio_words[brand % 20 + 1] END AS studios,
    p_brand AS producers,
    CASE WHEN p_partkey % 17 <> 0 THEN round((p_retailprice - 900.0::DOUBLE) / 10.0::DOUBLE, 2) END AS score,
    CASE WHEN p_partkey % 23 <> 0 THEN CAST(p_partkey % 997 + 1 AS INTEGER) END AS popularity,
    CASE WHEN p_partkey % 13 <> 0 THEN p_size END AS episodes,
    ({_list((*AGE_RATINGS, "24 min per ep", "UNKNOWN"))})[p_partkey % 8 + 1] AS rating,
    CAST(p_partkey + 1 AS INTEGER) AS rank, p_size * 100 AS members, p_size * 7 AS favorites,
    CAST(p_partkey % 500 AS INTEGER) * 3 AS scored_by,
    CASE WHEN p_partkey % 9 <> 0 THEN 'Apr 3, ' || (p_partkey % 30 + 1980) || ' to Jun 24, '
      || (p_partkey % 30 + 1981) ELSE 'Not available' END AS aired,
    'spring ' || (p_partkey % 30 + 1980) AS premiered, 'Finished Airing' AS status,
    CASE p_partkey % 5 WHEN 0 THEN '1 hr ' || p_size || ' min per ep' WHEN 1 THEN p_size || ' min per ep'
      WHEN 2 THEN '2 hr per ep' WHEN 3 THEN p_size || ' sec per ep' ELSE 'Unknown' END AS duration,
    CASE WHEN p_partkey % 19 <> 0 THEN p_size * 11 END AS watching,
    CASE WHEN p_partkey % 29 <> 0 THEN CAST(p_partkey % 700 AS INTEGER) END AS completed,
    CAST(p_partkey % 13 AS INTEGER) AS on_hold, CAST(p_partkey % 7 AS INTEGER) AS dropped
  FROM part_numbers
), raw_ratings AS (
  SELECT o_custkey AS user_id, l_partkey AS anime_id, CAST((l_quantity - 1) % 10 + 1 AS INTEGER) AS rating,
    CAST(o_orderdate AS DATE) AS rated_on
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
)"""

STAR = f"""{RAW}, dim_user AS (
  SELECT row_number() OVER (ORDER BY user_id) AS User_SK, user_id AS User_ID, username AS Username,
    gender AS Gender, birthday AS Birthday, location AS Location, joined AS Joined_Date,
    mean_score AS User_Mean_Score, completed AS User_Total_Completed, watching AS User_Watching,
    on_hold AS User_On_Hold, dropped AS User_Dropped, plan_to_watch AS User_Plan_to_Watch,
    total_entries AS User_Total_Entries, days_watched AS User_Days_Watched,
    episodes_watched AS User_Episodes_Watched
  FROM raw_users
), dim_anime AS (
  SELECT row_number() OVER (ORDER BY anime_id) AS Anime_SK, anime_id AS Anime_ID, name AS Name,
    english_name AS English_Name, type AS Type, source AS Source, genres AS Genres, studios AS Studios,
    producers AS Producers, score AS Avg_Score, popularity AS Popularity_Rank,
    CAST(episodes AS DOUBLE) AS Episodes, rating AS Age_Rating, CAST(rank AS DOUBLE) AS Rank,
    CAST(members AS DOUBLE) AS Members, CAST(favorites AS DOUBLE) AS Favorites,
    CAST(scored_by AS DOUBLE) AS Scored_By, aired AS Aired, premiered AS Premiered, status AS Status,
    duration AS Duration
  FROM raw_titles
), dim_date AS (
  SELECT CAST(year(d) * 10000 + month(d) * 100 + day(d) AS INTEGER) AS Date_SK, d AS Full_Date,
    CAST(year(d) AS INTEGER) AS Year, CAST(quarter(d) AS INTEGER) AS Quarter, CAST(month(d) AS INTEGER) AS Month,
    monthname(d) AS Month_Name, dayname(d) AS Day_of_Week, dayofweek(d) IN (0, 6) AS Is_Weekend
  FROM (SELECT CAST(unnest(generate_series(min(rated_on), max(rated_on), INTERVAL 1 DAY)) AS DATE) AS d
        FROM raw_ratings)
), fact AS (
  SELECT User_SK, Anime_SK, Date_SK, r.rating AS User_Rating, r.rating - Avg_Score AS Rating_Deviation,
    CASE WHEN r.rating > Avg_Score THEN 1 ELSE 0 END AS Is_Above_Average,
    CASE WHEN r.rating >= 8 THEN 1 ELSE 0 END AS Is_High_Rating,
    CASE WHEN r.rating <= 4 THEN 1 ELSE 0 END AS Is_Low_Rating, 1 AS Rating_Count
  FROM raw_ratings r JOIN dim_user u ON r.user_id = u.User_ID JOIN dim_anime a ON r.anime_id = a.Anime_ID
    LEFT JOIN dim_date d ON r.rated_on = d.Full_Date
)"""


def _star(query: str) -> str:
    return f"WITH {STAR}\n{query}"


def _raw(query: str, more: str = "") -> str:
    return f"WITH {RAW}{more}\n{query}"


_DIM_USER = """SELECT User_SK, User_ID, Username, Gender, CAST(Birthday AS VARCHAR) AS Birthday, Location,
  CAST(Joined_Date AS VARCHAR) AS Joined_Date,
  round(User_Mean_Score, 6) AS User_Mean_Score, User_Total_Completed, User_Watching, User_On_Hold,
  User_Dropped, User_Plan_to_Watch, User_Total_Entries, round(User_Days_Watched, 6) AS User_Days_Watched,
  User_Episodes_Watched FROM dim_user"""

_NEVER_LOW = """SELECT User_SK, User_ID, Username, round(User_Mean_Score, 6) AS User_Mean_Score FROM dim_user u
WHERE EXISTS (SELECT 1 FROM fact f WHERE f.User_SK = u.User_SK)
  AND NOT EXISTS (SELECT 1 FROM fact f WHERE f.User_SK = u.User_SK AND f.User_Rating <= 1)"""

_QUINTILES = """SELECT User_SK, User_ID, Username, User_Total_Completed,
  CAST(ntile(5) OVER (ORDER BY User_Total_Completed DESC, User_SK) AS INTEGER) AS quintile FROM dim_user"""

BUSINESS = {
    "low_ratings_niche": """SELECT count(*) AS total_low_ratings FROM fact JOIN dim_anime USING (Anime_SK)
WHERE Is_Low_Rating = 1 AND Members < 1000""",
    "users_never_low": _NEVER_LOW,
    "users_never_low_anti": _NEVER_LOW,
    "top_locations_fans": """SELECT Location, CAST(sum(Is_Above_Average) AS BIGINT) AS total_fan_ratings
FROM fact JOIN dim_user USING (User_SK) WHERE Location IS NOT NULL
GROUP BY Location ORDER BY total_fan_ratings DESC, Location LIMIT 5""",
    "rating_vs_user_mean": """SELECT User_SK, Anime_SK, User_Rating, round(User_Mean_Score, 6) AS User_Mean_Score,
  round(avg(User_Rating) OVER (PARTITION BY User_SK), 6) AS avg_user_rating,
  round(User_Rating - User_Mean_Score, 6) AS deviation_from_user_mean,
  round(User_Rating - avg(User_Rating) OVER (PARTITION BY User_SK), 6) AS deviation_from_avg_rating
FROM fact JOIN dim_user USING (User_SK)""",
    "popularity_gap": """SELECT *, next_popularity_rank - Popularity_Rank AS popularity_gap FROM (
  SELECT Anime_SK, Anime_ID, Name, Popularity_Rank,
    lead(Popularity_Rank) OVER (ORDER BY Popularity_Rank, Anime_SK) AS next_popularity_rank
  FROM dim_anime WHERE Popularity_Rank IS NOT NULL)""",
    "user_rating_count_window": """SELECT User_SK, Username, Anime_SK, User_Rating,
  count(*) OVER (PARTITION BY User_SK) AS total_user_ratings FROM fact JOIN dim_user USING (User_SK)""",
    "source_not_type": """SELECT Anime_SK, Anime_ID, Name, Type, Source, Avg_Score FROM dim_anime
WHERE Source = 'Manga' AND Type <> 'TV'""",
    "titles_rated_one_by_group": """SELECT DISTINCT Name, Anime_ID, Type, Avg_Score
FROM fact JOIN dim_user USING (User_SK) JOIN dim_anime USING (Anime_SK) WHERE User_Rating = 1 AND Gender = 'Female'""",
    "fan_ratings_of_type": """SELECT User_SK, Anime_SK, Name, User_Rating, Is_Above_Average, Type, Avg_Score
FROM fact JOIN dim_anime USING (Anime_SK) WHERE Is_Above_Average = 1 AND Type = 'Movie'""",
    "high_raters_by_location_studio": """SELECT DISTINCT Username, User_ID, Location, Name, Studios, User_Rating
FROM fact JOIN dim_user USING (User_SK) JOIN dim_anime USING (Anime_SK)
WHERE Is_High_Rating = 1 AND Location = 'Canada' AND contains(Studios, 'Production I.G')""",
    "high_rating_share_by_source": """SELECT Source, CAST(sum(Is_High_Rating) AS BIGINT) AS total_high_ratings,
  count(*) AS total_ratings, round(sum(Is_High_Rating) / count(*)::DOUBLE * 100, 6) AS high_rating_percentage
FROM fact JOIN dim_anime USING (Anime_SK) WHERE Source IS NOT NULL GROUP BY Source""",
    "top3_per_studio": """SELECT * FROM (SELECT Studios, Name, Anime_ID, Type, Avg_Score, Popularity_Rank,
    CAST(row_number() OVER (PARTITION BY Studios ORDER BY Avg_Score DESC, Anime_ID) AS INTEGER) AS rank
  FROM dim_anime WHERE Studios IS NOT NULL AND Avg_Score IS NOT NULL) WHERE rank <= 3""",
    "harsh_active_users": """SELECT User_SK, User_ID, Username, round(User_Mean_Score, 6) AS User_Mean_Score,
  User_Total_Completed FROM dim_user WHERE User_Mean_Score < 6 AND User_Total_Completed > 50""",
    "critic_ratings_of_user": """SELECT Username, Anime_ID, Name, English_Name, User_Rating,
  round(Rating_Deviation, 6) AS Rating_Deviation, Avg_Score
FROM fact JOIN dim_user USING (User_SK) JOIN dim_anime USING (Anime_SK)
WHERE Username = 'Customer#000000007' AND User_Rating < 7""",
    "avg_episodes_by_age_rating": f"""SELECT Age_Rating, round(avg(Episodes), 6) AS avg_episodes FROM dim_anime
WHERE Age_Rating IN ({", ".join(_text(r) for r in (*AGE_RATINGS, "UNKNOWN"))}) AND Episodes IS NOT NULL
GROUP BY Age_Rating""",
    "avg_deviation_by_studio": """SELECT Studios, round(avg(Rating_Deviation), 6) AS avg_rating_deviation
FROM fact JOIN dim_anime USING (Anime_SK)
WHERE Studios IS NOT NULL AND NOT regexp_matches(Studios, '^https?://') AND length(Studios) < 150
  AND (length(Studios) <= 100 OR contains(Studios, ','))
GROUP BY Studios ORDER BY avg(Rating_Deviation) DESC NULLS LAST, Studios LIMIT 20""",
    "rating_count_by_group": """SELECT Gender, count(Rating_Count) AS total_ratings
FROM fact JOIN dim_user USING (User_SK) WHERE Gender IS NOT NULL GROUP BY Gender""",
    "user_quintiles": _QUINTILES,
    "user_quintile_stats": f"""SELECT quintile, count(*) AS users_count,
  round(avg(User_Total_Completed), 6) AS avg_completed, CAST(sum(User_Total_Completed) AS BIGINT) AS total_completed
FROM ({_QUINTILES}) GROUP BY quintile""",
    "user_quintiles_approx": """SELECT User_SK, User_ID, Username, User_Total_Completed,
  CASE WHEN User_Total_Completed >= cuts[4] THEN 1 WHEN User_Total_Completed >= cuts[3] THEN 2
       WHEN User_Total_Completed >= cuts[2] THEN 3 WHEN User_Total_Completed >= cuts[1] THEN 4 ELSE 5 END AS quintile
FROM dim_user, (SELECT quantile_disc(User_Total_Completed, [0.2, 0.4, 0.6, 0.8]) AS cuts FROM dim_user)""",
    "studio_high_score": """SELECT Anime_SK, Anime_ID, Name, Type, Studios, Avg_Score, Popularity_Rank FROM dim_anime
WHERE contains(Studios, 'Sunrise') AND Avg_Score > 8.5""",
    "recent_users_in_location": """SELECT User_SK, User_ID, Username, CAST(Joined_Date AS VARCHAR) AS Joined_Date, Location FROM dim_user
WHERE Location = 'USA' AND Joined_Date > DATE '1995-06-01'""",
    "count_category_short": """SELECT count(*) AS total_anime_r17_lt10 FROM dim_anime
WHERE starts_with(Age_Rating, 'R - 17+') AND Episodes < 10""",
    "perfect_raters_of_title": """SELECT DISTINCT User_SK, User_ID, Username, Anime_ID, Name, User_Rating
FROM fact JOIN dim_user USING (User_SK) JOIN dim_anime USING (Anime_SK) WHERE Name = 'hot ring' AND User_Rating = 10""",
    "avg_rating_by_genre": """SELECT genre, round(avg(User_Rating), 6) AS avg_user_rating, count(*) AS rated_count
FROM (SELECT User_Rating, trim(unnest(string_split(Genres, ','))) AS genre FROM fact JOIN dim_anime USING (Anime_SK))
WHERE length(genre) > 0 GROUP BY genre""",
    "rank_within_type": """SELECT Type, Anime_SK, Anime_ID, Name, Avg_Score,
  row_number() OVER (PARTITION BY Type ORDER BY Avg_Score DESC, Anime_ID) AS type_rank
FROM dim_anime WHERE Type IS NOT NULL AND Avg_Score IS NOT NULL""",
}

# Column name and Spark type of the profiled dimensions.
_ANIME_TYPES = (
    [("Anime_SK", "bigint"), ("Anime_ID", "bigint")]
    + [(c, "string") for c in ("Name", "English_Name", "Type", "Source", "Genres", "Studios", "Producers")]
    + [("Avg_Score", "double"), ("Popularity_Rank", "int"), ("Episodes", "double"), ("Age_Rating", "string")]
    + [(c, "double") for c in ("Rank", "Members", "Favorites", "Scored_By")]
    + [(c, "string") for c in ("Aired", "Premiered", "Status", "Duration")]
)
_USER_TYPES = (
    [("User_SK", "bigint"), ("User_ID", "bigint"), ("Username", "string"), ("Gender", "string"), ("Birthday", "date")]
    + [("Location", "string"), ("Joined_Date", "date"), ("User_Mean_Score", "double")]
    + [(f"User_{c}", "int") for c in ("Total_Completed", "Watching", "On_Hold", "Dropped", "Plan_to_Watch")]
    + [("User_Total_Entries", "int"), ("User_Days_Watched", "double"), ("User_Episodes_Watched", "int")]
)
_FACT_NUMBERS = (
    "User_SK", "Anime_SK", "Date_SK", "User_Rating", "Rating_Deviation", "Is_Above_Average", "Is_High_Rating",
    "Is_Low_Rating", "Rating_Count",
)


def _info(table: str, types, share: bool) -> str:
    extra = f", round((count(*) - count({{c}})) * 100.0::DOUBLE / count(*), 6) AS null_percentage" if share else ""
    return "\nUNION ALL ".join(
        f"SELECT {i} AS position, '{c}' AS column_name, '{kind}' AS data_type, true AS nullable, "
        f"count(*) AS row_count, {len(types)} AS column_count, count(*) - count({c}) AS null_count"
        f"{extra.format(c=c)} FROM {table}"
        for i, (c, kind) in enumerate(types, 1)
    )


def _statistics(table: str, columns) -> str:
    return "\nUNION ALL ".join(
        f"SELECT '{c}' AS column_name, count({c}) AS count, avg({c}) AS mean, stddev_samp({c}) AS stddev, "
        f"CAST(min({c}) AS DOUBLE) AS min, CAST(max({c}) AS DOUBLE) AS max, count(*) - count({c}) AS null_count, "
        f"(count(*) - count({c})) * 100.0::DOUBLE / count(*) AS null_percentage FROM {table}"
        for c in columns
    )


def _round(names, digits: int = 6) -> str:
    return ", ".join(f"round({n}, {digits}) AS {n}" for n in names)


_NUMERIC_STATS = f"""SELECT column_name, count, {_round(["mean", "stddev", "min", "max"])}, null_count,
  {_round(["null_percentage"])} FROM ({_statistics("fact", _FACT_NUMBERS)})"""

_ASSESSMENT = f"""SELECT column_name, {_round(["null_percentage"])},
  CASE WHEN null_percentage = 0 THEN 'excellent' WHEN null_percentage < 5 THEN 'good'
       WHEN null_percentage < 20 THEN 'acceptable' ELSE 'poor' END AS quality,
  {_round(["coefficient_of_variation"])},
  CASE WHEN coefficient_of_variation < 15 THEN 'low' WHEN coefficient_of_variation < 35 THEN 'moderate'
       WHEN coefficient_of_variation IS NOT NULL THEN 'high' END AS spread,
  {_round(["min", "max"])}, round(max - min, 6) AS value_range
FROM (SELECT *, CASE WHEN stddev > 0 THEN stddev / nullif(mean, 0) * 100 END AS coefficient_of_variation
      FROM ({_statistics("dim_anime", [c for c, kind in _ANIME_TYPES if kind != "string"])}))"""


def _flag(condition: str, name: str) -> str:
    return f"CASE WHEN {condition} THEN 1 ELSE 0 END AS {name}"


def _contains(column: str, labels, prefix: str, ignore_case: bool = False) -> list[str]:
    text = (lambda t: f"lower({t})") if ignore_case else (lambda t: t)
    return [_flag(f"contains({text(column)}, {text(_text(g))})", feature_name(prefix, g)) for g in labels]


def _equals(column: str, labels, prefix: str) -> list[str]:
    return [_flag(f"{column} = {_text(v)}", feature_name(prefix, v)) for v in labels]


def _titles(columns: list[str]) -> str:
    return _raw(f"SELECT anime_id, {', '.join(columns)} FROM raw_titles")


_EXACT_GENRES = [
    _flag(f"list_contains(list_transform(string_split(genres, ','), lambda x: trim(x)), {_text(g)})",
          feature_name("genre", g))
    for g in GENRES
]
_DURATION = """CASE WHEN hours IS NOT NULL OR minutes IS NOT NULL
  THEN coalesce(hours, 0) * 60 + coalesce(minutes, 0) END"""
_NUMBERS = f""", timed AS (
  SELECT *, try_cast(regexp_extract(duration, '(\\d+)\\s*hr', 1) AS INTEGER) AS hours,
    try_cast(regexp_extract(duration, '(\\d+)\\s*min', 1) AS INTEGER) AS minutes FROM raw_titles
), numbers AS (
  SELECT anime_id, name, score, genres, type, source, rating, studios, episodes AS episodes_clean,
    {_DURATION} AS duration_minutes,
    try_cast(regexp_extract(aired, '.*(\\d{{4}})', 1) AS INTEGER) AS release_year,
    CAST(members AS DOUBLE) AS members, CAST(favorites AS DOUBLE) AS favorites,
    CAST(popularity AS DOUBLE) AS popularity, CAST(watching AS DOUBLE) AS watching,
    CAST(completed AS DOUBLE) AS completed, CAST(on_hold AS DOUBLE) AS on_hold, CAST(dropped AS DOUBLE) AS dropped
  FROM timed WHERE score > 0
)"""
_IMPUTED = {
    "episodes_clean": "episodes_clean", "duration_minutes": "duration_minutes", "release_year": "release_year",
    "Members": "members", "Favorites": "favorites", "Popularity": "popularity", "Watching": "watching",
    "Completed": "completed", '"On-Hold"': "on_hold", "Dropped": "dropped",
}
_FILLED = f"""{_NUMBERS}, filled AS (
  SELECT * REPLACE ({", ".join(f"coalesce(n.{c}, m.{c}) AS {c}" for c in _IMPUTED.values())})
  FROM numbers n, (SELECT {", ".join(f"quantile_disc({c}, 0.5) AS {c}" for c in _IMPUTED.values())} FROM numbers) m
)"""
_FILLED = _FILLED.replace("SELECT * REPLACE", "SELECT n.* REPLACE")


def _scaled(column: str, name: str) -> str:
    low, high = f"min({column}) OVER ()", f"max({column}) OVER ()"
    return (
        f"CASE WHEN {high} = {low} THEN CASE WHEN {column} IS NOT NULL THEN 0.0::DOUBLE END "
        f"ELSE ({column} - {low}) / ({high} - {low})::DOUBLE END AS {name}"
    )


def _train_scaled(column: str) -> str:
    low, high = f"low_{column}", f"high_{column}"
    return (
        f"CASE WHEN {high} = {low} THEN CASE WHEN {column} IS NOT NULL THEN 0.0::DOUBLE END "
        f"ELSE ({column} - {low}) / ({high} - {low})::DOUBLE END"
    )


_REGRESSION = f"""SELECT anime_id, name AS Name, score AS Score, episodes_clean, duration_minutes, release_year,
  {", ".join(_scaled(c.lower(), f"{c.lower()}_normalized") for c in SCALED)},
  {", ".join(_contains("genres", GENRES, "genre") + _equals("type", TYPES, "type")
             + _equals("source", SOURCES, "source") + _equals("rating", AGE_RATINGS, "rating")
             + _contains("studios", STUDIOS, "studio"))}
FROM filled"""
_REGRESSION_NORMALIZED = [f"{c.lower()}_normalized" for c in SCALED]
_REGRESSION_FEATURES = [
    "episodes_clean", "duration_minutes", "release_year", *_REGRESSION_NORMALIZED, *feature_plans.INDICATOR_COLUMNS,
]


def _behaviour(vocabulary) -> str:
    genre = _contains("genres", vocabulary.genres, "g", vocabulary.ignore_case)
    kinds = _equals("type", vocabulary.types, "t")
    sums = [
        f"CAST(sum({feature_name('g', g)}) AS BIGINT) AS {feature_name('genre_count', g)}" for g in vocabulary.genres
    ] + [f"CAST(sum({feature_name('t', t)}) AS BIGINT) AS {feature_name('type_count', t)}" for t in vocabulary.types]
    averages = [
        f"avg(score_given) FILTER (WHERE type = '{t}') AS {feature_name('avg_rating', t)}" for t in vocabulary.types
    ]
    return f"""SELECT user_id, count(*) AS total_ratings, avg(score_given) AS avg_rating,
    stddev_samp(score_given) AS rating_std, min(score_given) AS min_rating, max(score_given) AS max_rating,
    count(DISTINCT anime_id) AS unique_anime_count, {", ".join(sums + averages)}
  FROM (SELECT r.user_id, r.anime_id, r.rating AS score_given, t.type, {", ".join(genre + kinds)}
        FROM raw_ratings r LEFT JOIN raw_titles t USING (anime_id)) GROUP BY user_id"""


def _behaviour_query(vocabulary) -> str:
    doubles = ["avg_rating", "rating_std", *[feature_name("avg_rating", t) for t in vocabulary.types]]
    rounds = ", ".join(f"round({c}, 6) AS {c}" for c in doubles)
    return _raw(f"SELECT * REPLACE ({rounds}) FROM ({_behaviour(vocabulary)})")


_PROFILE_SQL = {
    "days_watched": "days_watched", "user_mean_score": "mean_score", "user_completed": "completed",
    "user_dropped": "dropped", "user_plan_to_watch": "plan_to_watch", "user_total_entries": "total_entries",
    "user_rewatched": "rewatched", "user_episodes_watched": "episodes_watched",
}
_COUNTS = [feature_name("genre_count", g) for g in GENRES]
_SHARES = [feature_name("genre_pct", g) for g in GENRES]
_NULLABLE = ["rating_std", *[feature_name("avg_rating", t) for t in TYPES], *[n for _, n in PROFILE_COLUMNS]]
_CLASSIFICATION = f""", behaviour AS ({_behaviour(FULL_VOCABULARY)}
), profiled AS (
  SELECT b.*, gender AS Gender, {", ".join(f"CAST({c} AS DOUBLE) AS {n}" for n, c in _PROFILE_SQL.items())}
  FROM behaviour b JOIN raw_users u USING (user_id)
  WHERE gender IN ('Male', 'Female') AND total_ratings >= {MIN_RATINGS}
), derived AS (
  SELECT *, CASE WHEN Gender = 'Male' THEN 0 ELSE 1 END AS gender_encoded,
    {" + ".join(f"CASE WHEN {c} > 0 THEN 1 ELSE 0 END" for c in _COUNTS)} AS genre_diversity,
    CASE WHEN avg_rating > 0 THEN coalesce(rating_std, 0) / avg_rating ELSE 0 END AS rating_consistency,
    (max_rating - min_rating) / 9.0::DOUBLE AS preference_intensity,
    CASE WHEN user_total_entries > 0 THEN coalesce(user_dropped / user_total_entries, 0) ELSE 0 END AS drop_rate,
    {", ".join(f"{c} / total_ratings::DOUBLE AS {s}" for c, s in zip(_COUNTS, _SHARES))},
    {", ".join(_scaled(c, f"{c}_normalized") for c in SCALED_COLUMNS)}
  FROM profiled
), classification AS (
  SELECT * REPLACE ({", ".join(f"coalesce({c}, 0) AS {c}" for c in _NULLABLE)},
    {", ".join(f"coalesce({c}_normalized, 0) AS {c}_normalized" for c in SCALED_COLUMNS)}) FROM derived
)"""
_CLASS_DOUBLES = [
    "avg_rating", "rating_std", *[feature_name("avg_rating", t) for t in TYPES], *[n for _, n in PROFILE_COLUMNS],
    "rating_consistency", "preference_intensity", "drop_rate", *_SHARES, *[f"{c}_normalized" for c in SCALED_COLUMNS],
]

def _tree_levels(levels: int = 2) -> str:
    """Bounds, cut and gain of each node: every level from the rows that the one above it has placed."""
    values = ", ".join(f"coalesce({c}, 0)::DOUBLE" for c in _REGRESSION_FEATURES)
    parts = [
        f"""titled AS MATERIALIZED (SELECT [{values}] AS x, round(Score / 0.000001::DOUBLE)::BIGINT AS y FROM ({_REGRESSION}))""",
        f"placed1 AS MATERIALIZED (SELECT tree::INTEGER AS tree, 1::BIGINT AS node, x, y FROM titled, range({TREES}) t(tree))",
    ]
    for k in range(1, levels + 1):
        parts += [
            f"""cuts{k} AS (SELECT *, low + (high - low) * (('0x' || substr(md5('42:' || tree || ':' || node || ':' || feature), 1, 8))::BIGINT
    / 4294967296.0::DOUBLE) AS cut FROM (SELECT tree, node, feature, min(v) AS low, max(v) AS high FROM (
      SELECT tree, node, unnest(x) AS v, generate_subscripts(x, 1) - 1 AS feature FROM placed{k}) GROUP BY ALL) WHERE low < high)""",
            f"""best{k} AS MATERIALIZED (SELECT *, (l::DOUBLE * l::DOUBLE) / n_left::DOUBLE + ((t - l)::DOUBLE * (t - l)::DOUBLE) / (n - n_left)::DOUBLE AS gain
  FROM (SELECT c.tree, c.node, c.feature, c.cut, c.low, c.high, count(*) AS n, sum(y)::BIGINT AS t,
      count(*) FILTER (WHERE x[feature + 1] <= cut) AS n_left, sum(y) FILTER (WHERE x[feature + 1] <= cut)::BIGINT AS l
    FROM placed{k} p JOIN cuts{k} c ON p.tree = c.tree AND p.node = c.node WHERE cut < high GROUP BY ALL)
  WHERE n_left > 0 AND n_left < n QUALIFY row_number() OVER (PARTITION BY tree, node ORDER BY gain DESC, feature) = 1)""",
            f"""placed{k + 1} AS MATERIALIZED (SELECT p.tree, 2 * p.node + CASE WHEN x[feature + 1] <= cut THEN 0 ELSE 1 END AS node, x, y
  FROM placed{k} p JOIN best{k} b ON p.tree = b.tree AND p.node = b.node)""",
        ]
    rows = "\nUNION ALL ".join(
        f"SELECT tree, node, ({_list(_REGRESSION_FEATURES)})[feature + 1] AS feature, cut, low, high, n, n_left, gain FROM best{k}"
        for k in range(1, levels + 1)
    )
    return _raw(rows, _FILLED + ", " + ",\n".join(parts))


_QUARANTINE = ''', lines AS (
  SELECT anime_id, name || ', "so"' AS name, anime_id % 11 AS kind, members, anime_id || ',"' || name || ', ""so""",'
    || CASE WHEN anime_id % 11 = 3 THEN 'many' ELSE members::VARCHAR END AS line
  FROM raw_titles
)'''


_HASH = "('0x' || substr(md5('42:' || user_id), 1, 8))::BIGINT"
_RANDOM = f"""SELECT user_id, gender AS Gender, CASE WHEN share < 0.70::DOUBLE THEN 'train'
  WHEN share < 0.85::DOUBLE THEN 'validation' ELSE 'test' END AS split
FROM (SELECT *, {_HASH} / 4294967296.0::DOUBLE AS share FROM raw_users)"""
_STRATIFIED = f"""SELECT user_id, Gender, CASE WHEN rn <= floor(n * 0.70::DOUBLE) THEN 'train'
  WHEN rn <= floor(n * 0.85::DOUBLE) THEN 'validation' ELSE 'test' END AS split
FROM (SELECT user_id, gender AS Gender, count(*) OVER (PARTITION BY gender) AS n,
        row_number() OVER (PARTITION BY gender ORDER BY {_HASH}, user_id) AS rn
      FROM raw_users WHERE gender IS NOT NULL)"""

_BY_RULE = """, guessed AS (
  SELECT user_id, CAST(gender = 'Female' AS INTEGER) AS actual, CAST(completed >= 5000 AS INTEGER) AS predicted
  FROM raw_users WHERE gender IN ('Male', 'Female')
)"""
_REPORT = f"""{_BY_RULE}, per_class AS (
  SELECT class, coalesce(hits / nullif(said, 0)::DOUBLE, 0) AS "precision",
    coalesce(hits / nullif(support, 0)::DOUBLE, 0) AS recall,
    coalesce(2.0::DOUBLE * hits / nullif(said + support, 0), 0) AS f1, support, hits
  FROM (SELECT name AS class, count(*) FILTER (WHERE actual = id AND predicted = id) AS hits,
          count(*) FILTER (WHERE predicted = id) AS said, count(*) FILTER (WHERE actual = id) AS support
        FROM guessed, (VALUES (0, 'Male'), (1, 'Female')) c(id, name) GROUP BY name)
), total AS (SELECT CAST(sum(support) AS BIGINT) AS n, sum(hits) / sum(support)::DOUBLE AS accuracy FROM per_class)"""
_CELLS = ("user_id", "anime_id", "rating", "rated_on", "Type", "Genres")
_EMPTY = " + ".join(f"CASE WHEN {c} IS NULL THEN 1 ELSE 0 END" for c in _CELLS)
_RULES = r"""SELECT anime_id,
  coalesce(NOT regexp_matches(age, '^\d+(\.\d+)?$|^https?://|min|hr|^(fall|spring|summer|winter)|^(Bandai|Madhouse|Bee Train|Trans Arts|ORADA|ADV)')
    AND (starts_with(age, 'G - All Ages') OR starts_with(age, 'PG - Children') OR starts_with(age, 'PG-13 - Teens')
      OR starts_with(age, 'R - 17+') OR starts_with(age, 'R+ - Mild') OR starts_with(age, 'Rx - Hentai')
      OR age IN ('UNKNOWN', 'Unknown', 'None')) AND length(age) < 50, false) AS age_rating_valid,
  coalesce(NOT regexp_matches(studio, '^https?://') AND length(studio) < 150
    AND (length(studio) <= 100 OR contains(studio, ',')), false) AS studio_valid
FROM (SELECT anime_id,
    CASE anime_id % 8 WHEN 1 THEN '7.5' WHEN 2 THEN 'https://a.example/' WHEN 3 THEN 'R - 17+ 24 min'
      WHEN 4 THEN 'G - All Ages' || repeat('x', 60) WHEN 5 THEN 'spring 1999' WHEN 6 THEN 'Madhouse'
      ELSE rating END AS age,
    CASE anime_id % 5 WHEN 1 THEN 'https://s.example/' || anime_id WHEN 2 THEN repeat('a', 120)
      WHEN 3 THEN repeat('a', 60) || ',' || repeat('b', 60) WHEN 4 THEN repeat('a', 80) || ',' || repeat('b', 80)
      ELSE studios END AS studio
  FROM raw_titles)"""

_DAY = "CAST(rated_on AS VARCHAR) AS rated_on"
_LEFT_TITLES = """SELECT r.* REPLACE (CAST(r.rated_on AS VARCHAR) AS rated_on), t.type AS Type, t.genres AS Genres
FROM raw_ratings r LEFT JOIN (SELECT * FROM raw_titles WHERE type IS NOT NULL) t USING (anime_id)"""


def _intervals(rows: str, sums: dict[str, str], metrics: dict[str, str]) -> str:
    """Poisson bootstrap of ``rows``, which have a column ``key``: weights from the draws of each block's digest."""
    weight = " + ".join(f"CAST(draw >= {cut} AS INTEGER)" for cut in poisson_cuts())
    weighted = ", ".join(f"sum(w * ({value})) AS {name}" for name, value in sums.items())
    each = "\nUNION ALL ".join(
        f"""SELECT '{name}' AS metric, round(max(v) FILTER (WHERE replicate = 0), 6) AS estimate,
  round(quantile_cont(v, 0.025) FILTER (WHERE replicate > 0), 6) AS low,
  round(quantile_cont(v, 0.975) FILTER (WHERE replicate > 0), 6) AS high,
  count(v) FILTER (WHERE replicate > 0) AS replicates FROM (SELECT replicate, {value} AS v FROM summed)"""
        for name, value in metrics.items()
    )
    return f""", drawn AS (
  SELECT *, block * {DRAWS} + j + 1 AS replicate, ('0x' || substr(digest, CAST(1 + 8 * j AS BIGINT), 8))::BIGINT AS draw
  FROM (SELECT *, md5('42:' || block || ':' || key) AS digest FROM ({rows}), range({-(-REPLICATES // DRAWS)}) b(block)),
    range({DRAWS}) r(j)
), weighted AS (
  SELECT * EXCLUDE (draw), {weight} AS w FROM drawn WHERE replicate <= {REPLICATES}
  UNION ALL SELECT * EXCLUDE (draw) REPLACE (0 AS replicate), 1 AS w FROM drawn WHERE replicate = 1
), summed AS (SELECT replicate, sum(w)::DOUBLE AS n, {weighted} FROM weighted GROUP BY replicate)
{each}"""


def oracles() -> dict[str, str]:
    """SQL by query key; model training has none."""
    sql = {name: _star(query) for name, query in BUSINESS.items()}
    sql |= {
        "dim_user": _star(_DIM_USER),
        "dim_item": _star("SELECT * FROM dim_anime"),
        "dim_date": _star("SELECT * REPLACE (CAST(Full_Date AS VARCHAR) AS Full_Date) FROM dim_date"),
        "fact_rating": _star("SELECT * REPLACE (round(Rating_Deviation, 6) AS Rating_Deviation) FROM fact"),
        "csv_roundtrip": _raw(
            "SELECT anime_id, name AS Name, genres AS Genres, score AS Score, members AS Members FROM raw_titles"
        ),
        "parquet_roundtrip": _raw(f"SELECT * REPLACE ({_DAY}) FROM raw_ratings"),
        "ratings_of_known_users": _raw(
            f"SELECT * REPLACE ({_DAY}) FROM raw_ratings "
            "WHERE user_id IN (SELECT user_id FROM raw_users WHERE gender = 'Female')"
        ),
        "ratings_left_items": _raw(_LEFT_TITLES),
        "dataset_info": _star(_info("dim_anime", _ANIME_TYPES, False)),
        "dataset_description": _star(_info("dim_user", _USER_TYPES, True)),
        "dataset_sample": _star(f"{_DIM_USER} ORDER BY User_SK LIMIT 3"),
        "numeric_stats": _star(_NUMERIC_STATS),
        "numeric_assessment": _star(_ASSESSMENT),
        "written_dataset_info": _star(_info("dim_user", _USER_TYPES, True)),
        "written_statistics": _star(_NUMERIC_STATS),
        "written_assessment": _star(_ASSESSMENT),
        "batch_status": _star(
            "\nUNION ALL ".join(
                f"SELECT '{batch}' AS batch, '{name}' AS query, 'ok' AS status, count(*) AS row_count FROM ({BUSINESS[name]})"
                for batch, names in BATCHES.items()
                for name in names
            )
        ),
        "ratings_renamed": _raw(f"SELECT * REPLACE ({_DAY}) FROM raw_ratings"),
        "quality_report": _raw(f"""SELECT CAST(sum(n) AS BIGINT) AS row_count,
  CAST(sum(n - 1) AS BIGINT) AS duplicate_rows, CAST(sum(({_EMPTY}) * n) AS BIGINT) AS null_cells,
  round(sum(({_EMPTY}) * n) * 100.0::DOUBLE / (sum(n) * {len(_CELLS)}), 6) AS null_percentage
FROM (SELECT {", ".join(_CELLS)}, count(*) AS n FROM ({_LEFT_TITLES}) GROUP BY ALL)"""),
        "csv_quoted_roundtrip": _raw("""SELECT anime_id, name AS Name, type AS Type, source AS Source, genres AS Genres,
  studios AS Studios, producers AS Producers, aired AS Aired, duration AS Duration,
  name || chr(10) || 'said "' || genres || '", twice' AS Synopsis, true AS well_formed FROM raw_titles"""),
        "csv_split": _raw(f"SELECT * REPLACE ({_DAY}) FROM raw_ratings"),
        "category_rules": _raw(_RULES),
        "fact_undated": _star(f"""SELECT * REPLACE (round(Rating_Deviation, 6) AS Rating_Deviation,
    {int(LOAD_DATE.replace("-", ""))}::INTEGER AS Date_SK), '{LOAD_DATE}' AS Full_Date FROM fact"""),
        "quintile_cut_errors": _star("""SELECT share, count(*) AS users, true AS within_bound
FROM dim_user, (SELECT unnest([0.2, 0.4, 0.6, 0.8])::DOUBLE AS share)
WHERE User_Total_Completed IS NOT NULL GROUP BY share"""),
        "regression_metrics": _raw(
            """SELECT round(sqrt(avg(power(score - r.rating, 2))), 6) AS rmse, round(avg(abs(score - r.rating)), 6) AS mae,
  round(1 - avg(power(score - r.rating, 2)) / nullif(var_pop(score), 0), 6) AS r2
FROM raw_ratings r JOIN numbers USING (anime_id)""",
            _NUMBERS,
        ),
        "regression_intervals": _raw(
            _intervals(
                "SELECT user_id || ':' || anime_id AS key, score AS y, score - r.rating AS e "
                "FROM raw_ratings r JOIN numbers USING (anime_id) WHERE score IS NOT NULL",
                {"squared": "e * e", "size": "abs(e)", "y": "y", "yy": "y * y"},
                {"rmse": "sqrt(squared / n)", "mae": "size / n", "r2": "1 - squared / nullif(yy - y * y / n, 0)"},
            ),
            _NUMBERS,
        ),
        "classification_intervals": _raw(
            _intervals(
                "SELECT CAST(user_id AS VARCHAR) AS key, actual, predicted FROM guessed",
                {
                    "good": "CAST(actual = predicted AS INTEGER)::DOUBLE",
                    "found": "(actual * predicted)::DOUBLE",
                    "total": "(actual + predicted)::DOUBLE",
                },
                {"accuracy": "good / n", "f1": "coalesce(found * 2 / nullif(total, 0), 0)"},
            ),
            _BY_RULE,
        ),
        "class_confusion": _raw("SELECT actual, predicted, count(*) AS n FROM guessed GROUP BY ALL", _BY_RULE),
        "classification_metrics": _raw(
            """SELECT round(avg(CAST(actual = predicted AS INTEGER)), 6) AS accuracy,
  round(coalesce(2.0::DOUBLE * sum(actual * predicted) / nullif(sum(actual) + sum(predicted), 0), 0), 6) AS f1
FROM guessed""",
            _BY_RULE,
        ),
        "class_report_by_rule": _raw(
            f"""SELECT class, {_round(['"precision"', "recall", "f1"])}, support FROM (
  SELECT class, "precision", recall, f1, support FROM per_class
  UNION ALL SELECT 'accuracy', accuracy, accuracy, accuracy, n FROM total
  UNION ALL SELECT 'macro avg', avg("precision"), avg(recall), avg(f1), any_value(n) FROM per_class, total
  UNION ALL SELECT 'weighted avg', sum("precision" * support) / any_value(n), sum(recall * support) / any_value(n),
    sum(f1 * support) / any_value(n), any_value(n) FROM per_class, total)""",
            _REPORT,
        ),
        "genre_indicators": _titles(_contains("genres", GENRES, "genre")),
        "genre_indicators_exact": _titles(_EXACT_GENRES),
        "studio_indicators": _titles(_contains("studios", STUDIOS, "studio")),
        "category_onehot": _titles(
            _equals("type", TYPES, "type") + _equals("source", SOURCES, "source")
            + _equals("rating", AGE_RATINGS, "rating")
        ),
        "duration_minutes": _raw(f"""SELECT anime_id, {_DURATION} AS duration_minutes FROM (
  SELECT anime_id, try_cast(regexp_extract(duration, '(\\d+)\\s*hr', 1) AS INTEGER) AS hours,
    try_cast(regexp_extract(duration, '(\\d+)\\s*min', 1) AS INTEGER) AS minutes FROM raw_titles)"""),
        "release_year": _raw("""SELECT anime_id, try_cast(regexp_extract(aired, '.*(\\d{4})', 1) AS INTEGER) AS last_year,
  try_cast(regexp_extract(aired, '(\\d{4})', 1) AS INTEGER) AS first_year FROM raw_titles"""),
        "episodes_clean": _raw("SELECT anime_id, episodes AS episodes_clean FROM raw_titles"),
        "median_impute": _raw(
            f"SELECT anime_id, {', '.join(f'{c} AS {n}' for n, c in _IMPUTED.items())} FROM filled", _FILLED
        ),
        "exact_quantiles": _raw(
            "\nUNION ALL ".join(
                f"""SELECT '{c}' AS "column", {f}::DOUBLE AS fraction, quantile_disc(CAST({c} AS DOUBLE), {f}) AS value FROM raw_ratings"""
                for c in QUANTILE_COLUMNS
                for f in QUANTILE_FRACTIONS
            )
        ),
        "minmax_scale": _raw(
            f"SELECT anime_id, {_round(_REGRESSION_NORMALIZED)} FROM (SELECT anime_id, "
            + ", ".join(_scaled(c.lower(), f"{c.lower()}_normalized") for c in SCALED)
            + " FROM raw_titles)"
        ),
        "regression_features": _raw(
            f"SELECT * REPLACE ({_round(_REGRESSION_NORMALIZED)}) FROM ({_REGRESSION})", _FILLED
        ),
        "user_features": _behaviour_query(FULL_VOCABULARY),
        "user_features_compact": _behaviour_query(COMPACT_VOCABULARY),
        "user_features_derived": _raw(
            f"SELECT * REPLACE ({_round(_CLASS_DOUBLES)}) FROM classification", _CLASSIFICATION
        ),
        "classification_scaled_train_fit": _raw(
            f"SELECT user_id, Gender, split, {_round([f'{c}_normalized' for c in SCALED_COLUMNS])} FROM ("
            f"SELECT user_id, Gender, split, {', '.join(f'coalesce({_train_scaled(c)}, 0) AS {c}_normalized' for c in SCALED_COLUMNS)}"
            " FROM parts JOIN derived USING (user_id), bounds)",
            f"""{_CLASSIFICATION}, parts AS MATERIALIZED (
  SELECT user_id, CASE WHEN rn <= floor(n * 0.70::DOUBLE) THEN 'train' WHEN rn <= floor(n * 0.85::DOUBLE) THEN 'validation'
    ELSE 'test' END AS split
  FROM (SELECT user_id, count(*) OVER (PARTITION BY gender_encoded) AS n,
    row_number() OVER (PARTITION BY gender_encoded ORDER BY {_HASH}, user_id) AS rn FROM derived)
), bounds AS (SELECT {", ".join(f"min({c}) AS low_{c}, max({c}) AS high_{c}" for c in SCALED_COLUMNS)}
  FROM derived JOIN parts USING (user_id) WHERE split = 'train')""",
        ),
        "extra_tree_levels": _tree_levels(),
        "csv_quarantine": _raw(
            """SELECT anime_id, name AS Name, CASE WHEN kind <> 3 THEN members END AS Members, 'x' AS Last,
  'kept' AS fault, NULL::VARCHAR AS record FROM lines WHERE kind NOT IN (1, 2)
UNION ALL SELECT NULL, NULL, NULL, NULL, CASE kind WHEN 1 THEN 'short' WHEN 2 THEN 'long' ELSE 'unparsable' END,
  CASE kind WHEN 1 THEN line WHEN 2 THEN line || ',x,y' ELSE line || ',x' END FROM lines WHERE kind IN (1, 2, 3)""",
            _QUARANTINE,
        ),
        "user_sample": _raw(
            f"SELECT user_id, gender AS Gender FROM raw_users ORDER BY {_HASH}, user_id LIMIT {USER_SAMPLE}"
        ),
        "split_random": _raw(_RANDOM),
        "split_stratified": _raw(_STRATIFIED),
        "split_report": _raw(f"""SELECT split, count(*) AS row_count,
  round(count(*) / (sum(count(*)) OVER ())::DOUBLE, 6) AS share FROM ({_RANDOM}) GROUP BY split"""),
        "class_balance": _raw(f"SELECT split, Gender, count(*) AS row_count FROM ({_STRATIFIED}) GROUP BY ALL"),
        "feature_target_corr": _raw(
            "\nUNION ALL ".join(
                f"SELECT '{c}' AS feature, round(covar_pop({c}, Score) / nullif(stddev_pop({c}) * stddev_pop(Score), 0), 6)"
                " AS correlation FROM features"
                for c in _REGRESSION_FEATURES
            ),
            f"{_FILLED}, features AS MATERIALIZED ({_REGRESSION})",
        ),
        "target_distribution": _raw(
            """SELECT count(score) AS count, round(avg(score), 6) AS mean, round(quantile_disc(score, 0.5), 6) AS median,
  round(stddev_samp(score), 6) AS stddev, round(min(score), 6) AS min, round(max(score), 6) AS max,
  round(max(score) - min(score), 6) AS value_range,
  round(avg(power(score - m, 3)) / power(var_pop(score), 1.5), 6) AS skewness
FROM numbers, (SELECT avg(score) AS m FROM numbers)""",
            _NUMBERS,
        ),
        "class_feature_means": _raw(
            "SELECT feature, round(mean_first, 5) AS mean_first, round(mean_second, 5) AS mean_second,\n"
            "  round(mean_second / nullif(mean_first, 0), 5) AS ratio FROM ("
            + "\nUNION ALL ".join(
                f"SELECT '{c}' AS feature, avg({c}) FILTER (WHERE Gender = 'Male') AS mean_first, "
                f"avg({c}) FILTER (WHERE Gender = 'Female') AS mean_second FROM stored"
                for c in CLASS_FEATURES
            )
            + ")",
            f"{_CLASSIFICATION}, stored AS MATERIALIZED (SELECT * FROM classification)",
        ),
        "title_collapse": _raw("""SELECT anime_id, any_value(name) AS Name, any_value(type) AS Type,
  CASE WHEN any_value(score) IS NULL THEN 'UNKNOWN' ELSE CAST(any_value(score) AS VARCHAR) END AS Score,
  count(*) AS user_ratings_count FROM raw_ratings r JOIN raw_titles t USING (anime_id) GROUP BY anime_id"""),
    }
    return sql
