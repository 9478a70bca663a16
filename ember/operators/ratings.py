"""Rating analytics: mean and count by key, lists, pivots, argmax, by year.

Every aggregate here decomposes into (sum, count).  Where a dimension is only
needed after grouping (titles, genres, occupation names) rating rows are
reduced by key *before* they meet it: partial aggregation runs map-side (a hot
key costs one row per task, not a third of the data in one task) and the join
sees one row per key instead of one per rating.  The user-attribute operators
(gender, age group) must join raw ratings to users first; there AQE's skew
split handles a hot user, or ``hot_split=True`` the explicit hot-key join.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ember.functions import AGE_LABELS, GENDER_CODES, age_group, split_list
from ember.operators.skew import hot_key_join


def union_all(*dfs: DataFrame) -> DataFrame:
    """Bag union by column name (duplicates kept, like UNION ALL)."""
    out = dfs[0]
    for df in dfs[1:]:
        out = out.unionByName(df)
    return out


def sum_count_by(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Partial state (keys..., s, n) of a mean: sum and count of ``value``."""
    return df.groupBy(*keys).agg(
        F.sum(value).alias("_s"), F.count(value).alias("_n"), F.count(F.lit(1)).alias("_rows"))


def mean_count_by(
    df: DataFrame,
    keys: Sequence[str],
    value: str = "rating",
    avg_name: str = "avg_rating",
    count_name: str = "total_ratings",
    digits: int | None = 2,
) -> DataFrame:
    """Mean and row count of ``value`` per key."""
    mean = F.avg(value)
    if digits is not None:
        mean = F.round(mean, digits)
    return df.groupBy(*keys).agg(mean.alias(avg_name), F.count(F.lit(1)).alias(count_name))


def with_dimension(stats: DataFrame, dim: DataFrame, key: str) -> DataFrame:
    """Inner equi-join of aggregated stats with a dimension.

    Joined by name so the key appears once.  The planner picks broadcast or
    sort-merge from the runtime size (AQE); nothing is broadcast blindly.
    """
    return stats.join(dim, on=key, how="inner")


def movie_stats(ratings: DataFrame, movies: DataFrame) -> DataFrame:
    """(movie_id, title, avg_rating, total_ratings)."""
    stats = mean_count_by(ratings, ["movie_id"])
    return with_dimension(stats, movies, "movie_id").select(
        "movie_id", "title", "avg_rating", "total_ratings")


def movies_min_count(ratings: DataFrame, movies: DataFrame, min_count: int) -> DataFrame:
    """movies with at least ``min_count`` ratings (HAVING after the agg)."""
    counts = ratings.groupBy("movie_id").agg(F.count(F.lit(1)).alias("total_ratings"))
    return (
        counts.where(F.col("total_ratings") >= min_count)
        .join(movies.select("movie_id"), "movie_id")
        .select("movie_id", "total_ratings")
    )


def _rounded(mean: Column, digits: int | None) -> Column:
    return mean if digits is None else F.round(mean, digits)


def top_by_mean(ratings: DataFrame, movies: DataFrame, min_count: int = 5, n: int = 1, digits: int | None = 2) -> DataFrame:
    """A10: best mean among movies with >= ``min_count`` ratings.

    The count threshold applies before the max (T3); ties go to the smaller
    key (T4); no qualifying movie gives zero rows.  ``orderBy().limit()`` is
    planned as a per-partition top-n followed by a merge of n rows per task.
    """
    stats = (
        ratings.groupBy("movie_id")
        .agg(F.avg("rating").alias("_mean"), F.count(F.lit(1)).alias("total_ratings"))
        .where(F.col("total_ratings") >= min_count)
    )
    return (
        with_dimension(stats, movies, "movie_id")
        .orderBy(F.desc("_mean"), F.asc("movie_id"))
        .limit(n)
        .select("movie_id", "title", _rounded(F.col("_mean"), digits).alias("avg_rating"), "total_ratings")
    )


def explode_list(df: DataFrame, col: str, sep: str, out: str) -> DataFrame:
    """One row per element of a separator-joined list (split is literal)."""
    keep = [c for c in df.columns if c not in (col, out)]
    return df.select(*keep, F.explode(split_list(col, sep)).alias(out))


def genre_stats(ratings: DataFrame, movies: DataFrame, genre_col: str = "title", sep: str = " ",
                digits: int | None = 2) -> DataFrame:
    """Mean and count per genre.

    Ratings are first reduced to (movie, sum, count); only that small result
    is joined to the genre lists and exploded, then the partial states are
    merged per genre.  Same numbers as exploding every rating.
    """
    per_movie = sum_count_by(ratings, ["movie_id"], "rating")
    genres = movies.select("movie_id", F.explode(split_list(genre_col, sep)).alias("genre"))
    return (
        per_movie.join(genres, "movie_id")
        .groupBy("genre")
        .agg(
            _rounded(F.sum("_s") / F.sum("_n"), digits).alias("avg_rating"),
            F.sum("_rows").alias("total_ratings"),
        )
    )


def with_user_attr(ratings: DataFrame, users: DataFrame, attr: str, hot_split: bool = False) -> DataFrame:
    """Attach one user attribute to every rating (inner join on user).

    Raw ratings meet the user table here, so a user with a large share of the
    ratings is a hot join key.  By default AQE's skew-join split handles it at
    run time (no extra pass); ``hot_split=True`` uses ``hot_key_join``, which
    salts the bounded set of hot users (an extra counting pass).
    """
    dim = users.select("user_id", attr)
    if hot_split:
        return hot_key_join(ratings, dim, "user_id")
    return ratings.join(dim, "user_id")


def mean_by_pair(ratings: DataFrame, users: DataFrame, attr: str, hot_split: bool = False) -> DataFrame:
    """A3/A4: mean rating per (movie, user attribute), long form."""
    joined = with_user_attr(ratings, users, attr, hot_split)
    return mean_count_by(joined, ["movie_id", attr]).drop("total_ratings")


def with_age_group(users: DataFrame, age_col: str = "age", out: str = "age_group") -> DataFrame:
    """Right-closed age bucket column."""
    return users.withColumn(out, age_group(age_col))


def attr_list(ratings: DataFrame, users: DataFrame, attr: str, out: str, hot_split: bool = False) -> DataFrame:
    """The distinct attribute values seen per movie, as sorted text.

    ``collect_set`` is aggregated map-side first, so a partial state holds at
    most the number of distinct attribute values, never the raw ratings, and
    one shuffle suffices.  Meant for low-cardinality attributes (gender, age
    group), whose list per movie is bounded by the attribute's domain.
    """
    pairs = with_user_attr(ratings, users, attr, hot_split).select("movie_id", attr)
    return pairs.groupBy("movie_id").agg(
        F.array_join(F.array_sort(F.collect_set(attr)), ",").alias(out))


def attr_mean_list(ratings: DataFrame, users: DataFrame, attr: str) -> DataFrame:
    """(movie_id, pairs): the (value, mean) of every attribute value seen for a movie, sorted by value.

    The pairs are collected from one pre-aggregated row each, so a list holds
    at most the attribute's distinct values.
    """
    long = with_user_attr(ratings, users, attr).groupBy("movie_id", attr).agg(F.avg("rating").alias("_mean"))
    return long.groupBy("movie_id").agg(F.array_sort(F.collect_list(
        F.struct(F.col(attr).alias("value"), F.col("_mean").alias("mean")))).alias("pairs"))


def pivot_mean(
    ratings: DataFrame,
    users: DataFrame,
    attr: str,
    values: Sequence[str],
    names: Sequence[str],
    digits: int | None = 2,
    hot_split: bool = False,
) -> DataFrame:
    """Long -> wide mean per movie with fixed columns.

    One conditional mean per listed value in a single aggregation (one
    shuffle, map-side partial state of two numbers per column), rather than
    ``pivot()``, which plans a second aggregation and shuffle.  Codes outside
    the list are dropped (T6); a group with no rating is NULL (T7).
    """
    joined = with_user_attr(ratings, users, attr, hot_split)
    aggs = []
    for v, name in zip(values, names):
        mean = F.avg(F.when(F.col(attr) == v, F.col("rating")))
        aggs.append((F.round(mean, digits) if digits is not None else mean).alias(name))
    return joined.groupBy("movie_id").agg(*aggs)


def gender_pivot(ratings: DataFrame, users: DataFrame, movies: DataFrame, digits: int | None = 2) -> DataFrame:
    """(movie_id, title, male_avg, female_avg)."""
    wide = pivot_mean(ratings, users, "gender", GENDER_CODES, ("male_avg", "female_avg"), digits)
    return with_dimension(wide, movies, "movie_id").select("movie_id", "title", "male_avg", "female_avg")


AGE_COLUMNS = ("age_0_18", "age_18_35", "age_35_50", "age_50_plus")


def age_pivot(ratings: DataFrame, users: DataFrame, movies: DataFrame, digits: int | None = 2) -> DataFrame:
    """C4: (movie_id, title, one column per age group in bucket order)."""
    wide = pivot_mean(ratings, with_age_group(users), "age_group", AGE_LABELS, AGE_COLUMNS, digits)
    return with_dimension(wide, movies, "movie_id").select("movie_id", "title", *AGE_COLUMNS)


def occupation_stats(ratings: DataFrame, users: DataFrame, occupations: DataFrame, digits: int | None = 2) -> DataFrame:
    """Mean and count per occupation.

    Reduced per user first, so the join with users carries one row per user
    (a user with a third of all ratings is still one row), then per
    occupation, then named through the occupation table.
    """
    per_user = sum_count_by(ratings, ["user_id"], "rating")
    per_occ = (
        per_user.join(users.select("user_id", "occ_id"), "user_id")
        .groupBy("occ_id")
        .agg(F.sum("_s").alias("_s"), F.sum("_n").alias("_n"), F.sum("_rows").alias("total_ratings"))
    )
    return with_dimension(per_occ, occupations, "occ_id").select(
        "occupation", _rounded(F.col("_s") / F.col("_n"), digits).alias("avg_rating"), "total_ratings")


def by_year(ratings: DataFrame, ts_col: str = "ts", epoch_seconds: bool = False) -> DataFrame:
    """(year, total_ratings, avg_rating) per calendar year."""
    src = F.timestamp_seconds(F.col(ts_col)) if epoch_seconds else F.col(ts_col)
    return (
        ratings.withColumn("year", F.year(src).cast("bigint"))
        .groupBy("year")
        .agg(F.count(F.lit(1)).alias("total_ratings"), F.round(F.avg("rating"), 2).alias("avg_rating"))
    )


def rating_multiplicity(ratings: DataFrame) -> DataFrame:
    """U1 check: how many times each (user, movie, rating) occurs in the union."""
    return ratings.groupBy("user_id", "movie_id", "rating").agg(F.count(F.lit(1)).alias("n"))
