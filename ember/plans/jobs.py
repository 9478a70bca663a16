"""The reference's three programs as job functions over their own inputs.

``ratings_answers`` takes the five comma text files of the ratings data set,
``retail_answers`` the five ``;`` CSV files of the retail data set, and
``start_frame_job`` a Kafka topic of frame packets.  Each returns DataFrames
(or the running query); nothing is printed or collected.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ember import streaming as S
from ember.operators import ratings as R
from ember.operators import report as RP
from ember.operators import retail as RT
from ember.sources import files as SRC
from ember.streaming import frames as SF

# Parameters of the reference's questions.
BEST_MIN_RATINGS = 5
REVENUE_YEAR = 2024
TOP_PRODUCTS = 10
GENRE_SEP = "|"


def ratings_answers(
    spark: SparkSession, movies: str, ratings: Sequence[str], users: str, occupations: str,
    *, strict: bool = False,
) -> dict[str, DataFrame]:
    """C1-C6 from the text files.

    ``quarantine`` holds every line some question could not read: a rating
    without a time counts in all questions but the one by year, a user
    without an age in all but the one by age group.
    """
    mv, mv_bad = SRC.read_movies(spark, movies, strict=strict)
    rt, _ = SRC.read_ratings(spark, list(ratings), strict=strict)
    timed, rt_bad = SRC.read_ratings(spark, list(ratings), strict=strict, required=SRC.TIMED_RATING)
    us, _ = SRC.read_users(spark, users, strict=strict)
    aged, us_bad = SRC.read_users(spark, users, strict=strict, required=SRC.AGED_USER)
    oc, oc_bad = SRC.read_occupations(spark, occupations, strict=strict)
    titles = mv.select("movie_id", "title")
    genres = mv.select("movie_id", "genres")
    timed = timed.withColumn("ts", F.timestamp_seconds("ts"))
    quarantine = R.union_all(*[b.withColumn("source", F.lit(n)) for n, b in
                               (("movies", mv_bad), ("ratings", rt_bad), ("users", us_bad), ("occupations", oc_bad))])
    return {
        "movie_stats": R.movie_stats(rt, titles),
        "movie_report": RP.movie_report(rt, titles),
        "best_movie": RP.best_movie_report(rt, titles, BEST_MIN_RATINGS),
        "genre_stats": R.genre_stats(rt, genres, "genres", GENRE_SEP),
        "genre_report": RP.genre_report(rt, genres, "genres", GENRE_SEP),
        "gender_report": RP.gender_report(rt, us, titles),
        "age_pivot": R.age_pivot(rt, aged, titles),
        "age_report": RP.age_report(rt, aged, titles),
        "occupation_stats": R.occupation_stats(rt, us, oc),
        "occupation_report": RP.occupation_report(rt, us, oc),
        "year_stats": R.by_year(timed, "ts").orderBy("year"),
        "year_report": RP.year_report(timed, "ts").orderBy("year"),
        "quarantine": quarantine,
    }


# Declared layouts of the retail CSV files (the columns the questions read).
ORDERS = "Order_ID string, Customer_Trx_ID string, Order_Purchase_Timestamp string"
PRODUCTS = "Product_ID string, Product_Category_Name string"
ORDER_ITEMS = "Order_ID string, Product_ID string, Seller_ID string, Price double, Freight_Value double"
CUSTOMERS = "Customer_Trx_ID string, Customer_Country string"
REVIEWS = "Order_ID string, Review_Score string"


def _csv(spark: SparkSession, path: str, layout: str, infer: bool) -> DataFrame:
    if infer:
        return SRC.read_csv(spark, path, header=True, infer_schema=True)
    # Only the declared columns are read, by header name, whatever else the file holds.
    wanted = [c.split()[0] for c in layout.split(",")]
    raw = SRC.read_csv(spark, path, header=True)
    cols = {c.lower(): c for c in raw.columns}
    types = dict(c.strip().split() for c in layout.split(","))
    return raw.select(*[F.col(cols[w.lower()]).try_cast(types[w]).alias(w) for w in wanted])


def retail_answers(
    spark: SparkSession, orders: str, products: str, items: str, customers: str, reviews: str,
    *, year: int = REVENUE_YEAR, infer_schema: bool = False,
) -> dict[str, DataFrame]:
    """C7-C12 from the CSV files (``;``, header); text timestamps are parsed
    with ``try_to_timestamp``, review scores cleaned as text."""
    o = _csv(spark, orders, ORDERS, infer_schema)
    p = _csv(spark, products, PRODUCTS, infer_schema)
    i = _csv(spark, items, ORDER_ITEMS, infer_schema)
    c = _csv(spark, customers, CUSTOMERS, infer_schema)
    r = _csv(spark, reviews, REVIEWS, infer_schema)
    ts = "Order_Purchase_Timestamp"
    o_ts = o.withColumn(ts, F.try_to_timestamp(F.col(ts).cast("string")))
    clean = RT.keep_valid(r, "Review_Score")
    scores = RT.product_scores(i, r, o, item_order_key="Order_ID", item_product_key="Product_ID",
                               review_order_key="Order_ID", score="Review_Score", order_key="Order_ID")
    return {
        "entity_counts": RT.entity_counts(o, c, i, "Customer_Trx_ID", "Seller_ID"),
        "orders_by_country": RT.orders_by_country(c, o, customer_key="Customer_Trx_ID",
                                                  order_customer_key="Customer_Trx_ID", country="Customer_Country"),
        "orders_by_month": RT.orders_by_month(o_ts, ts),
        "score_hist_raw": RT.count_by(r, ["Review_Score"], "count"),
        "score_clean": clean,
        "score_distinct": RT.distinct_values(clean, "Review_Score"),
        "score_avg": RT.mean_of_int(clean, "Review_Score"),
        "score_hist_clean": RT.count_by(clean, ["Review_Score"], "count").orderBy("Review_Score"),
        "revenue_by_category": RT.revenue_by_category(
            p, i, o_ts, year=year, product_key="Product_ID", category="Product_Category_Name",
            item_product_key="Product_ID", item_order_key="Order_ID", price="Price", freight="Freight_Value",
            order_key="Order_ID", order_ts=ts, name=f"total_revenue_{year}"),
        "product_scores": scores.orderBy(F.desc("total_sold"), "product_id"),
        "top_products": RT.top_n(scores, [F.desc("total_sold"), F.asc("product_id")], TOP_PRODUCTS),
    }


def start_frame_job(
    spark: SparkSession, servers: str, topic: str, root: str, *,
    make_segmenter: Callable | None = None, trigger: str = S.DEFAULT_TRIGGER,
    max_offsets_per_trigger: int | None = None, min_partitions: int | None = None,
):
    """C13 on Kafka: packets -> background removal -> ``root/out|dead|counts``,
    checkpoint in ``root/checkpoint``; returns the running query.

    ``min_partitions`` defaults to the session's parallelism, so a topic
    partition with one busy camera is read by several tasks.
    """
    msgs = S.kafka_source(spark, servers, topic, max_offsets_per_trigger=max_offsets_per_trigger,
                          min_partitions=min_partitions or spark.sparkContext.defaultParallelism)
    msgs = msgs.select(F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value"),
                       "partition")
    return SF.run_frame_stream(spark, msgs, root, make_segmenter=make_segmenter, trigger=trigger)
