"""Ratings operators on hand-made rows checked against plain Python."""

from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from ember.operators import ratings as R
from ember.operators import report as RP

MOVIES = [("m1", "Toy Story"), ("m2", "Heat"), ("m3", "Solo"), ("m4", "Alien"), ("m5", "Up")]
USERS = [("u1", "M", 18, "o1"), ("u2", "F", 19, "o2"), ("u3", "X", 35, "o1"), ("u4", "M", 51, "o3"),
         ("u5", "F", 36, "o2"), ("u6", "M", 50, "o1")]
OCC = [("o1", "artist"), ("o2", "doctor")]
# m1: 6 ratings, m2: 5 ratings, m3: 4 ratings, m4: rated by a female only; unknown movie and user.
RATINGS = [
    ("u1", "m1", 4.0, 978307199), ("u2", "m1", 5.0, 978307200), ("u3", "m1", 3.0, 978307200),
    ("u4", "m1", 4.0, 978307200), ("u5", "m1", 2.0, 978307200), ("u6", "m1", 5.0, 978307200),
    ("u1", "m2", 4.0, 978307200), ("u2", "m2", 4.0, 978307200), ("u3", "m2", 3.0, 978307200),
    ("u4", "m2", 5.0, 978307200), ("u6", "m2", 4.0, 978307200),
    ("u1", "m3", 5.0, 0), ("u2", "m3", 5.0, 0), ("u3", "m3", 5.0, 0), ("u4", "m3", 5.0, 0),
    ("u5", "m4", 1.0, 0),
    ("u1", "m9", 3.0, 0), ("u9", "m1", 1.0, 0),
]


@pytest.fixture(scope="module")
def data(spark):
    movies = spark.createDataFrame(MOVIES, "movie_id string, title string")
    users = spark.createDataFrame(USERS, "user_id string, gender string, age int, occ_id string")
    occ = spark.createDataFrame(OCC, "occ_id string, occupation string")
    schema = "user_id string, movie_id string, rating double, ts bigint"
    r1 = spark.createDataFrame(RATINGS[:9], schema)
    r2 = spark.createDataFrame(RATINGS[9:] + [RATINGS[0]], schema)   # one row in both files
    return movies, users, occ, R.union_all(r1, r2)


def all_ratings():
    return RATINGS + [RATINGS[0]]


def test_union_keeps_duplicates(data):  # U1
    ratings = data[3]
    assert ratings.count() == len(RATINGS) + 1
    mult = {(r[0], r[1], r[2]): r[3] for r in R.rating_multiplicity(ratings).collect()}
    assert mult[("u1", "m1", 4.0)] == 2


def test_movie_stats_inner_join_drops_unknown_movie(data):  # T10
    movies, _, _, ratings = data
    got = {r["movie_id"]: (r["avg_rating"], r["total_ratings"]) for r in R.movie_stats(ratings, movies).collect()}
    sums = defaultdict(list)
    for u, m, v, _ in all_ratings():
        sums[m].append(v)
    want = {m: (round(sum(v) / len(v), 2), len(v)) for m, v in sums.items() if m in dict(MOVIES)}
    assert got == want


def test_top_by_mean_counts_before_max_and_ties(spark, data):  # T3, T4
    movies, _, _, ratings = data
    best = R.top_by_mean(ratings, movies, min_count=5).collect()
    # m3 has the best mean but only 4 ratings; m2 (4.0) beats m1 (~3.43)
    assert [(r["movie_id"], r["total_ratings"]) for r in best] == [("m2", 5)]
    assert R.top_by_mean(ratings, movies, min_count=100).count() == 0
    tie = spark.createDataFrame([("a", "mB", 5.0, 0), ("a", "mA", 5.0, 0)], "user_id string, movie_id string, "
                                "rating double, ts bigint")
    mv = spark.createDataFrame([("mA", "A"), ("mB", "B")], "movie_id string, title string")
    assert R.top_by_mean(tie, mv, min_count=1).first()["movie_id"] == "mA"


def test_gender_pivot_drops_other_codes_and_keeps_missing_as_null(data):  # T6, T7
    movies, users, _, ratings = data
    got = {r["movie_id"]: (r["male_avg"], r["female_avg"]) for r in R.gender_pivot(ratings, users, movies).collect()}
    assert got["m4"] == (None, 1.0)
    # m1: male u1 (4, twice), u4 4, u6 5; female u2 5, u5 2; u3 is 'X' (dropped); u9 unknown (dropped)
    assert got["m1"] == (round((4 + 4 + 4 + 5) / 4, 2), 3.5)
    lines = {r["movie_id"]: r["report_line"] for r in RP.gender_report(ratings, users, movies).collect()}
    assert lines["m4"] == "Alien - Male_Avg: NA, Female_Avg: 1.00"


def test_age_pivot_right_closed_buckets(data):  # T5
    movies, users, _, ratings = data
    got = {r["movie_id"]: r for r in R.age_pivot(ratings, users, movies).collect()}
    m1 = got["m1"]
    # ages: u1 18 -> 0-18 (4,4); u2 19, u3 35 -> 18-35 (5,3); u5 36, u6 50 -> 35-50 (2,5); u4 51 -> 50+ (4)
    assert (m1["age_0_18"], m1["age_18_35"], m1["age_35_50"], m1["age_50_plus"]) == (4.0, 4.0, 3.5, 4.0)
    lines = {r["movie_id"]: r["report_line"] for r in RP.age_report(ratings, users, movies).collect()}
    assert lines["m4"] == "Alien - [0-18: NA, 18-35: NA, 35-50: 1.00, 50+: NA]"


def test_occupation_stats_matches_python(data):
    _, users, occ, ratings = data
    got = {r["occupation"]: (r["avg_rating"], r["total_ratings"])
           for r in R.occupation_stats(ratings, users, occ).collect()}
    occ_of = {u: o for u, _, _, o in USERS}
    names = dict(OCC)
    acc = defaultdict(list)
    for u, m, v, _ in all_ratings():
        if u in occ_of and occ_of[u] in names:
            acc[names[occ_of[u]]].append(v)
    assert got == {k: (round(sum(v) / len(v), 2), len(v)) for k, v in acc.items()}


def test_by_year_epoch_seconds_utc(data):  # T8
    ratings = data[3]
    got = {r["year"]: r["total_ratings"] for r in R.by_year(ratings, "ts", epoch_seconds=True).collect()}
    assert got == {1970: 7, 2000: 2, 2001: 10}


def test_genre_stats_equals_exploding_every_rating(spark, data):  # A2, P8
    _, _, _, ratings = data
    movies = spark.createDataFrame([("m1", "Animation|Comedy"), ("m2", "Action"), ("m3", "Comedy|Drama")],
                                   "movie_id string, genres string")
    got = {r["genre"]: (r["avg_rating"], r["total_ratings"])
           for r in R.genre_stats(ratings, movies, "genres", "|").collect()}
    g = dict(movies.collect())
    acc = defaultdict(list)
    for u, m, v, _ in all_ratings():
        for genre in g.get(m, "").split("|") if m in g else []:
            acc[genre].append(v)
    assert got == {k: (round(sum(v) / len(v), 2), len(v)) for k, v in acc.items()}


def test_report_two_decimals(spark):  # T9
    movies = spark.createDataFrame([("m1", "A")], "movie_id string, title string")
    ratings = spark.createDataFrame([("u", "m1", 0.0, 0), ("u", "m1", 0.25, 0)],
                                    "user_id string, movie_id string, rating double, ts bigint")
    line = RP.movie_report(ratings, movies).first()["report_line"]
    assert line == f"A AverageRating: {0.125:.2f} (TotalRatings: 2)"
    best = RP.best_movie_report(ratings, movies, 2).first()["report_line"]
    assert best == "A is the highest rated movie with an average rating of 0.12 among movies with at least 2 ratings."


def test_other_report_lines(spark, data):  # K4
    movies, users, occ, ratings = data
    genres = spark.createDataFrame([("m2", "Heat Wave")], "movie_id string, title string")
    g = {r["genre"]: r["report_line"] for r in RP.genre_report(ratings, genres).collect()}
    assert g["Heat"] == "Heat - AverageRating: 4.00 (TotalRatings: 5)"
    o = {r["occupation"]: r["report_line"] for r in RP.occupation_report(ratings, users, occ).collect()}
    assert o["doctor"] == "doctor - AverageRating: 3.40 (TotalRatings: 5)"
    y = {r["year"]: r["report_line"]
         for r in RP.year_report(ratings.withColumn("ts", F.timestamp_seconds("ts"))).collect()}
    assert y[2000] == "2000 - TotalRatings: 2, AverageRating: 4.00"
