"""Text report lines (K4), built as a column so nothing is printed on the driver."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ember.functions import AGE_LABELS, or_na, split_list, two_decimals
from ember.operators import ratings as R


def report_line(*parts: Column | str) -> Column:
    """Concatenate literal text and columns; plain ``str`` parts are literals."""
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


def movie_report(ratings: DataFrame, movies: DataFrame) -> DataFrame:
    """``{title} AverageRating: {avg:.2f} (TotalRatings: {n})`` per movie."""
    stats = ratings.groupBy("movie_id").agg(
        F.avg("rating").alias("_avg"), F.count(F.lit(1)).alias("_n"))
    return R.with_dimension(stats, movies, "movie_id").select(
        "movie_id",
        report_line(F.col("title"), " AverageRating: ", two_decimals("_avg"),
                    " (TotalRatings: ", F.col("_n"), ")").alias("report_line"),
    )


def best_movie_report(ratings: DataFrame, movies: DataFrame, min_count: int = 5) -> DataFrame:
    """The closing sentence of C1 (zero rows when no movie qualifies)."""
    best = R.top_by_mean(ratings, movies, min_count, digits=None)
    return best.select(
        "movie_id",
        report_line(F.col("title"), " is the highest rated movie with an average rating of ",
                    two_decimals("avg_rating"), " among movies with at least ", str(min_count),
                    " ratings.").alias("report_line"),
    )


def genre_report(ratings: DataFrame, movies: DataFrame, genre_col: str = "title", sep: str = " ") -> DataFrame:
    """``{genre} - AverageRating: {avg:.2f} (TotalRatings: {n})`` per genre."""
    g = R.genre_stats(ratings, movies, genre_col, sep, digits=None)
    return g.select("genre", report_line(F.col("genre"), " - AverageRating: ", two_decimals("avg_rating"),
                                         " (TotalRatings: ", F.col("total_ratings"), ")").alias("report_line"))


def gender_report(ratings: DataFrame, users: DataFrame, movies: DataFrame) -> DataFrame:
    """``{title} - Male_Avg: x, Female_Avg: y`` with ``NA`` for a missing group."""
    wide = R.gender_pivot(ratings, users, movies, digits=None)
    return wide.select(
        "movie_id",
        report_line(F.col("title"), " - Male_Avg: ", or_na(two_decimals("male_avg")),
                    ", Female_Avg: ", or_na(two_decimals("female_avg"))).alias("report_line"),
    )


def age_report(ratings: DataFrame, users: DataFrame, movies: DataFrame) -> DataFrame:
    """``{title} - [0-18: a, 18-35: b, 35-50: c, 50+: d]``."""
    wide = R.age_pivot(ratings, users, movies, digits=None)
    parts: list = [F.col("title"), " - ["]
    for i, (label, col) in enumerate(zip(AGE_LABELS, R.AGE_COLUMNS)):
        parts += [("" if i == 0 else ", ") + f"{label}: ", or_na(two_decimals(col))]
    parts.append("]")
    return wide.select("movie_id", report_line(*parts).alias("report_line"))


def occupation_report(ratings: DataFrame, users: DataFrame, occupations: DataFrame) -> DataFrame:
    return R.occupation_stats(ratings, users, occupations, digits=None).select(
        "occupation",
        report_line(F.col("occupation"), " - AverageRating: ", two_decimals("avg_rating"),
                    " (TotalRatings: ", F.col("total_ratings"), ")").alias("report_line"))


def year_report(ratings: DataFrame, ts_col: str = "ts") -> DataFrame:
    y = ratings.groupBy(F.year(ts_col).cast("bigint").alias("year")).agg(
        F.count(F.lit(1)).alias("_n"), F.avg("rating").alias("_avg"))
    return y.select("year", report_line(F.col("year"), " - TotalRatings: ", F.col("_n"),
                                        ", AverageRating: ", two_decimals("_avg")).alias("report_line"))
