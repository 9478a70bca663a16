"""Queries that go through the reference's own file layouts.

Spark writes the stand-in tables as the reference's inputs -- comma text
without a header for movies and the two rating files, ``;`` CSV with a
header for orders and customers -- under the shared folder, then the file
readers load them and the usual operators answer the question.  The answers
equal those of the parquet-based queries.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ember.operators import ratings as R
from ember.operators import retail as RT
from ember.session import shared_dir
from ember.sources import files as SRC
from ember.sources import testdata as TD


# Injected lines that do not parse, one for every n-th part, order or customer (fixed values of the oracle).
BAD_RATING_EVERY, BAD_TIME_EVERY, BAD_AGE_EVERY, BAD_ORDER_TIME_EVERY = 50, 70, 40, 23


def _lines(df: DataFrame, cols: list) -> DataFrame:
    """Comma lines; a NULL is an empty field, so later fields keep their places."""
    return df.select(F.concat_ws(",", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in cols]).alias("value"))


def write_ratings_text(spark: SparkSession, sf_dir: str, root: str, faults: bool = False) -> dict[str, list[str] | str]:
    """The five files in their positional layouts, with bad lines when ``faults``."""
    paths: dict[str, list[str] | str] = {"ratings": []}
    part = TD.table(spark, sf_dir, "part").select("p_partkey")
    for i, r in enumerate(TD.rating_files(spark, sf_dir), start=1):
        # The wall-clock time as the session sees it, so the year read back is the year written.
        r = r.withColumn("ts", F.unix_seconds(F.col("ts").cast("timestamp")))
        lines = _lines(r, ["user_id", "movie_id", "rating", "ts"])
        if faults and i == 1:
            lines = lines.unionByName(part.where(F.col("p_partkey") % BAD_RATING_EVERY == 0).select(
                F.format_string("1,%d,many,0", "p_partkey").alias("value")))
            lines = lines.unionByName(part.where(F.col("p_partkey") % BAD_TIME_EVERY == 0).select(
                F.format_string("1,%d,3.0,noon", "p_partkey").alias("value")))
        lines.write.text(f"{root}/ratings_{i}.txt")
        paths["ratings"].append(f"{root}/ratings_{i}.txt")
    movies = TD.movies(spark, sf_dir).withColumn("genres", F.regexp_replace("title", " ", "|"))
    users = _lines(TD.users(spark, sf_dir), ["user_id", "gender", "age", "occ_id"])
    if faults:
        users = users.unionByName(TD.table(spark, sf_dir, "customer").where(F.col("c_custkey") % BAD_AGE_EVERY == 0).select(
            F.format_string("u%d,M,old,0", "c_custkey").alias("value")))
    for name, lines in (("movies", _lines(movies, ["movie_id", "title", "genres"])), ("users", users),
                        ("occupation", _lines(TD.occupations(spark, sf_dir), ["occ_id", "occupation"]))):
        lines.write.text(f"{root}/{name}.txt")
        paths[name] = f"{root}/{name}.txt"
    return paths


def movie_stats_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C1 from text files: both rating files read as one bag (U1), parsed
    positionally (S1-S4), bad lines quarantined, then mean and count per movie."""
    paths = write_ratings_text(spark, sf_dir, shared_dir(spark, "text"))
    ratings, _ = SRC.read_ratings(spark, paths["ratings"])
    movies, _ = SRC.read_movies(spark, paths["movies"])
    out = R.movie_stats(ratings, movies.select("movie_id", "title"))
    return out.withColumn("movie_id", F.col("movie_id").cast("bigint"))


def _answers(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The ratings job over the five staged files, bad lines among them."""
    from ember.plans.jobs import ratings_answers

    paths = write_ratings_text(spark, sf_dir, shared_dir(spark, "text"), faults=True)
    return ratings_answers(spark, paths["movies"], paths["ratings"], paths["users"], paths["occupation"])


def genre_stats_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _answers(spark, sf_dir)["genre_stats"]


def age_pivot_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _answers(spark, sf_dir)["age_pivot"].withColumn("movie_id", F.col("movie_id").cast("bigint"))


def occupation_stats_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _answers(spark, sf_dir)["occupation_stats"]


def year_stats_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _answers(spark, sf_dir)["year_stats"]


def ratings_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line a question could not read, with its file and reason."""
    return _answers(spark, sf_dir)["quarantine"].select("source", "value", "reason")


def orders_by_country_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C8 from ``;`` CSV files with headers (S10), read with declared schemas."""
    root = shared_dir(spark, "csv")
    orders = TD.table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("Order_ID"), F.col("o_custkey").alias("Customer_Trx_ID"),
        F.col("o_orderdate").alias("Order_Purchase_Timestamp"))
    customers = TD.table(spark, sf_dir, "customer").join(
        TD.table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.col("c_custkey").alias("Customer_Trx_ID"), F.col("n_name").alias("Customer_Country"))
    orders.write.option("sep", ";").option("header", "true").csv(f"{root}/Orders.csv")
    customers.write.option("sep", ";").option("header", "true").csv(f"{root}/Customer_List.csv")
    o = SRC.read_csv(spark, f"{root}/Orders.csv",
                     "Order_ID bigint, Customer_Trx_ID bigint, Order_Purchase_Timestamp timestamp_ntz")
    c = SRC.read_csv(spark, f"{root}/Customer_List.csv", "Customer_Trx_ID bigint, Customer_Country string")
    return RT.orders_by_country(c, o, customer_key="Customer_Trx_ID", order_customer_key="Customer_Trx_ID",
                                country="Customer_Country")


def _retail_csv(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Orders (text timestamps, some unparsable), products and items staged as ``;`` CSV and read with inference."""
    root = shared_dir(spark, "csv")
    key = F.col("o_orderkey")
    frames = {
        "Orders": TD.table(spark, sf_dir, "orders").select(
            key.alias("Order_ID"), F.when(key % BAD_ORDER_TIME_EVERY == 0, F.lit("n/a")).otherwise(
                F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss")).alias("Order_Purchase_Timestamp")),
        "Products": TD.table(spark, sf_dir, "part").select(
            F.col("p_partkey").alias("Product_ID"), F.col("p_type").alias("Product_Category_Name")),
        "Order_Items": TD.table(spark, sf_dir, "lineitem").select(
            F.col("l_orderkey").alias("Order_ID"), F.col("l_partkey").alias("Product_ID"),
            F.col("l_extendedprice").alias("Price"), F.col("l_tax").alias("Freight_Value")),
    }
    out = []
    for name, df in frames.items():
        df.write.option("sep", ";").option("header", "true").csv(f"{root}/{name}.csv")
        out.append(SRC.read_csv(spark, f"{root}/{name}.csv", header="True", infer_schema="True"))
    orders = out[0].withColumn("Order_Purchase_Timestamp", F.try_to_timestamp(F.col("Order_Purchase_Timestamp").cast("string")))
    return orders, out[1], out[2]


def orders_by_month_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C9 from text timestamps (X11); those that do not parse count in the NULL month."""
    return RT.orders_by_month(_retail_csv(spark, sf_dir)[0], "Order_Purchase_Timestamp")


def revenue_by_category_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C11 from text timestamps (P12); orders without a time are in no year."""
    orders, products, items = _retail_csv(spark, sf_dir)
    return RT.revenue_by_category(
        products, items, orders, year=2000, product_key="Product_ID", category="Product_Category_Name",
        item_product_key="Product_ID", item_order_key="Order_ID", price="Price", freight="Freight_Value",
        order_key="Order_ID", order_ts="Order_Purchase_Timestamp")
