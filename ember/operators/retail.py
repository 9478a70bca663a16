"""Retail analytics: counts, cleaning, revenue by category, product scores.

Column names are parameters so the same operators run on the CSV layout
(``Order_ID`` ...) and on the parquet stand-ins (``o_orderkey`` ...).
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ember.functions import VALID_SCORES, money, to_int


def distinct_count(df: DataFrame, col: str) -> DataFrame:
    """``select(col).distinct().count()`` as a one-row DataFrame.

    NULL counts as a value, as ``distinct().count()`` does (``count_distinct``
    would skip it).
    """
    return df.select(col).distinct().agg(F.count(F.lit(1)).alias("n"))


def entity_counts(
    orders: DataFrame, customers: DataFrame, items: DataFrame,
    customer_key: str, seller_key: str,
) -> DataFrame:
    """One row (total_orders, total_customers, total_sellers).

    The two distinct counts are scalar subqueries of the order count, so the
    three numbers come from three independent aggregations, no join.
    """
    n_customers = distinct_count(customers, customer_key).scalar()
    n_sellers = distinct_count(items, seller_key).scalar()
    return orders.agg(F.count(F.lit(1)).alias("total_orders")).select(
        "total_orders", n_customers.alias("total_customers"), n_sellers.alias("total_sellers"))


def count_by(df: DataFrame, keys: Sequence[str], name: str = "count") -> DataFrame:
    """Row count per key; NULL and dirty keys stay as groups."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def orders_by_country(
    customers: DataFrame, orders: DataFrame, *,
    customer_key: str, order_customer_key: str, country: str, name: str = "cnt",
) -> DataFrame:
    """Orders per customer country, most first (ties by country).

    Orders are counted per customer before the join, so the customer join
    sees one row per customer rather than one per order.
    """
    per_customer = orders.groupBy(F.col(order_customer_key).alias("_ck")).agg(
        F.count(F.lit(1)).alias("_n"))
    joined = per_customer.join(
        customers.select(F.col(customer_key).alias("_ck"), F.col(country).alias("country")), "_ck")
    return (
        joined.groupBy("country").agg(F.sum("_n").alias(name))
        .orderBy(F.desc(name), F.asc("country"))
    )


def orders_by_month(orders: DataFrame, ts_col: str, name: str = "cnt") -> DataFrame:
    """Orders per (year, month), year ascending and month descending."""
    ts = F.col(ts_col)
    return (
        orders.select(F.year(ts).cast("bigint").alias("order_year"),
                      F.month(ts).cast("bigint").alias("order_month"))
        .groupBy("order_year", "order_month").agg(F.count(F.lit(1)).alias(name))
        .orderBy(F.asc("order_year"), F.desc("order_month"))
    )


def keep_valid(df: DataFrame, col: str, allowed: Sequence[str] = VALID_SCORES) -> DataFrame:
    """keep rows whose value, compared as text, is in ``allowed``.

    Comparing as text keeps exactly '1'..'5': '1.0', ' 1' and NULL go, and an
    integer list can not fail on a dirty string column under ANSI (T13).
    """
    return df.where(F.col(col).cast("string").isin(list(allowed)))


def distinct_values(df: DataFrame, col: str) -> DataFrame:
    """Distinct values of one column."""
    return df.select(col).distinct()


def mean_of_int(df: DataFrame, col: str, name: str = "avg_score") -> DataFrame:
    """Global mean of a text column read as int (after cleaning), and rows."""
    return df.agg(F.avg(to_int(col)).alias(name), F.count(F.lit(1)).alias("n"))


def total_value(items: DataFrame, price: str, freight: str, name: str = "total_value") -> Column:
    """P10: price + freight as exact decimal money, returned as double."""
    return (money(price) + money(freight)).cast("double").alias(name)


def _ts_bound(col_type: T.DataType, day: dt.date) -> Column:
    lit = F.lit(day)
    if isinstance(col_type, T.TimestampNTZType):
        return lit.cast("timestamp_ntz")
    if isinstance(col_type, T.DateType):
        return lit
    return lit.cast("timestamp")


def year_range(df: DataFrame, ts_col: str, year: int) -> Column:
    """``year(ts) == year`` as a half-open range the Parquet scan can push.

    ``year(x) = c`` reaches the scan only as ``IsNotNull``; ``>= start AND <
    end`` is pushed as two comparison filters.
    """
    ctype = df.schema[ts_col].dataType
    ts = F.col(ts_col)
    return (ts >= _ts_bound(ctype, dt.date(year, 1, 1))) & (ts < _ts_bound(ctype, dt.date(year + 1, 1, 1)))


def on_or_after(df: DataFrame, ts_col: str, day: dt.date) -> Column:
    """``ts >= day`` with the bound typed like the column (pushed to the scan)."""
    return F.col(ts_col) >= _ts_bound(df.schema[ts_col].dataType, day)


def product_order_join(
    products: DataFrame, items: DataFrame, orders: DataFrame, *,
    product_key: str, item_product_key: str, item_order_key: str, order_key: str,
) -> DataFrame:
    """Products x items x orders, inner, by key equality."""
    return (
        products.join(items, F.col(product_key) == F.col(item_product_key))
        .join(orders, F.col(item_order_key) == F.col(order_key))
    )


def revenue_by_category(
    products: DataFrame, items: DataFrame, orders: DataFrame, *, year: int,
    product_key: str, category: str, item_product_key: str, item_order_key: str,
    price: str, freight: str, order_key: str, order_ts: str, name: str = "total_revenue",
) -> DataFrame:
    """C11: sum of price + freight per category for orders of one year.

    Plan: the year range is pushed into the orders scan; items are joined to
    those orders and summed per product *before* the product join (the join
    then carries one row per product), and the partial sums are merged per
    category.  Sums are DECIMAL, so the result does not depend on order.
    """
    if isinstance(orders.schema[order_ts].dataType, T.StringType):
        orders = orders.withColumn(order_ts, F.try_to_timestamp(F.col(order_ts)))
    in_year = orders.where(year_range(orders, order_ts, year)).select(F.col(order_key).alias("_ok"))
    per_product = (
        items.select(F.col(item_order_key).alias("_ok"), F.col(item_product_key).alias("_pk"),
                     (money(price) + money(freight)).alias("_v"))
        .join(in_year, "_ok")
        .groupBy("_pk").agg(F.sum("_v").alias("_v"))
    )
    cats = products.select(F.col(product_key).alias("_pk"), F.col(category).alias("category"))
    return (
        per_product.join(cats, "_pk")
        .groupBy("category").agg(F.sum("_v").cast("double").alias(name))
        .orderBy(F.desc(name), "category")
    )


def product_scores(
    items: DataFrame, reviews: DataFrame, orders: DataFrame, *,
    item_order_key: str, item_product_key: str, review_order_key: str, score: str, order_key: str,
    product_name: str = "product_id",
) -> DataFrame:
    """Units sold and mean review score per product (order with ``top_n``).

    Same numbers as items JOIN reviews JOIN orders with fan-out (two reviews
    on an order count each item twice, T11), without materialising the
    fan-out: reviews are reduced to (order, score sum, review count) and
    orders to (order, multiplicity); each item row then carries the weight
    reviews x orders of its order.  A hot order therefore never becomes a
    product of rows in one task.
    """
    weighted = weighted_items(
        items, reviews, orders, item_order_key=item_order_key, item_product_key=item_product_key,
        review_order_key=review_order_key, score=score, order_key=order_key)
    return scores_of_items(weighted, product_name)


def weighted_items(
    items: DataFrame, reviews: DataFrame, orders: DataFrame, *,
    item_order_key: str, item_product_key: str, review_order_key: str, score: str, order_key: str,
) -> DataFrame:
    """(_ok, _pk, _s, _r, _m): each reviewed item with its order's score sum, reviews and multiplicity.

    Every row needs the rows of one order only.
    """
    clean = keep_valid(reviews, score)
    per_order = clean.groupBy(F.col(review_order_key).alias("_ok")).agg(
        F.sum(to_int(score)).alias("_s"), F.count(F.lit(1)).alias("_r"))
    order_mult = orders.groupBy(F.col(order_key).alias("_ok")).agg(F.count(F.lit(1)).alias("_m"))
    return (
        items.select(F.col(item_order_key).alias("_ok"), F.col(item_product_key).alias("_pk"))
        .join(per_order, "_ok")
        .join(order_mult, "_ok")
    )


def scores_of_items(weighted: DataFrame, product_name: str = "product_id") -> DataFrame:
    """Units sold and mean review score per product of ``weighted_items`` rows."""
    return (
        weighted.groupBy(F.col("_pk").alias(product_name))
        .agg(
            F.sum(F.when(F.col("_pk").isNotNull(), F.col("_r") * F.col("_m")).otherwise(0)).alias("total_sold"),
            F.round(F.sum(F.col("_s") * F.col("_m")) / F.sum(F.col("_r") * F.col("_m")), 2).alias("avg_score"),
        )
    )


def top_n(df: DataFrame, order: Sequence[Column], n: int) -> DataFrame:
    """First ``n`` rows of a total order (``TakeOrderedAndProject``)."""
    return df.orderBy(*order).limit(n)
