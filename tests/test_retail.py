"""Retail operators on hand-made rows: fan-out (T11), cleaning (T13, T14), year range."""

import datetime as dt
from collections import defaultdict

from pyspark.sql import functions as F

from ember.operators import retail as RT


def test_product_scores_equals_fanout_join(spark):  # T11, J8
    items = spark.createDataFrame(
        [("o1", "p1"), ("o1", "p2"), ("o2", "p1"), ("o3", "p3"), ("o4", "p1"), ("o5", "p2")],
        "Order_ID string, Product_ID string")
    reviews = spark.createDataFrame(
        [("o1", "5"), ("o1", "4"), ("o2", "1.0"), ("o3", "3"), ("o4", None), ("o5", "2"), ("o5", "x")],
        "Order_ID string, Review_Score string")
    orders = spark.createDataFrame([("o1",), ("o2",), ("o3",), ("o5",), ("o5",)], "Order_ID string")
    got = {r["product_id"]: (r["total_sold"], r["avg_score"]) for r in RT.product_scores(
        items, reviews, orders, item_order_key="Order_ID", item_product_key="Product_ID",
        review_order_key="Order_ID", score="Review_Score", order_key="Order_ID").collect()}
    # naive: items JOIN clean reviews JOIN orders, all inner, with duplicates
    clean = [(o, s) for o, s in reviews.collect() if s in ("1", "2", "3", "4", "5")]
    acc = defaultdict(list)
    for o, p in items.collect():
        for ro, s in clean:
            for (oo,) in orders.collect():
                if ro == o and oo == o:
                    acc[p].append(int(s))
    want = {p: (len(v), round(sum(v) / len(v), 2)) for p, v in acc.items()}
    assert got == want
    assert got["p2"] == (4, 3.25)  # o1 two reviews (5, 4) + o5 one review x two order rows (2, 2)


def test_keep_valid_and_mean(spark):  # T13, T14
    df = spark.createDataFrame([(s,) for s in ["1", "2", "5", "0", "6", "1.0", "x", None, ""]], "s string")
    clean = RT.keep_valid(df, "s")
    assert sorted(r[0] for r in clean.collect()) == ["1", "2", "5"]
    row = RT.mean_of_int(clean, "s").first()
    assert row["avg_score"] == 8 / 3 and row["n"] == 3
    ints = spark.createDataFrame([(1,), (7,)], "s int")
    assert RT.keep_valid(ints, "s").count() == 1


def test_entity_counts_counts_null_as_a_value(spark):  # A11, A12
    orders = spark.createDataFrame([(1,), (2,), (3,)], "o int")
    cust = spark.createDataFrame([("a",), ("a",), (None,)], "c string")
    items = spark.createDataFrame([("s1",), ("s2",), ("s2",)], "seller_id string")
    r = RT.entity_counts(orders, cust, items, "c", "seller_id").first()
    assert (r["total_orders"], r["total_customers"], r["total_sellers"]) == (3, 2, 2)


def test_revenue_by_category_year_range_on_text_timestamps(spark):  # C11, T15, F3
    products = spark.createDataFrame([("p1", "toys"), ("p2", "books"), ("p3", "toys")],
                                     "Product_ID string, Product_Category_Name string")
    items = spark.createDataFrame([("o1", "p1", 10.10, 1.01), ("o2", "p2", 5.0, 0.5), ("o3", "p3", 1.0, 0.0),
                                   ("o4", "p1", 100.0, 0.0), ("o5", "p2", 7.0, 0.0)],
                                  "Order_ID string, Product_ID string, Price double, Freight_Value double")
    orders = spark.createDataFrame([("o1", "2024-01-01 00:00:00"), ("o2", "2024-12-31 23:59:59"),
                                    ("o3", "2025-01-01 00:00:00"), ("o4", "garbage"), ("o5", None)],
                                   "Order_ID string, Order_Purchase_Timestamp string")
    out = RT.revenue_by_category(
        products, items, orders, year=2024, product_key="Product_ID", category="Product_Category_Name",
        item_product_key="Product_ID", item_order_key="Order_ID", price="Price", freight="Freight_Value",
        order_key="Order_ID", order_ts="Order_Purchase_Timestamp").collect()
    assert [(r[0], r[1]) for r in out] == [("toys", 11.11), ("books", 5.5)]


def test_orders_by_month_and_country_order(spark):  # O1, O2
    orders = spark.createDataFrame(
        [(1, "c1", dt.datetime(2020, 1, 5)), (2, "c1", dt.datetime(2020, 3, 5)), (3, "c2", dt.datetime(2019, 2, 1)),
         (4, "c3", dt.datetime(2020, 3, 9))], "oid int, cid string, ts timestamp")
    m = [tuple(r) for r in RT.orders_by_month(orders, "ts").collect()]
    assert m == [(2019, 2, 1), (2020, 3, 2), (2020, 1, 1)]
    cust = spark.createDataFrame([("c1", "VN"), ("c2", "BR"), ("c3", "AR")], "cid string, country string")
    c = [tuple(r) for r in RT.orders_by_country(cust, orders, customer_key="cid", order_customer_key="cid",
                                                country="country").collect()]
    assert c == [("VN", 2), ("AR", 1), ("BR", 1)]


def test_year_range_is_pushed_to_parquet(spark, tmp_dir):  # F3 plan
    df = spark.createDataFrame([(1, dt.datetime(2024, 5, 1))], "k int, ts timestamp_ntz")
    df.write.parquet(f"{tmp_dir}/t")
    t = spark.read.parquet(f"{tmp_dir}/t")
    plan = t.where(RT.year_range(t, "ts", 2024))._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(ts" in plan and "LessThan(ts" in plan


def test_top_n_is_take_ordered(spark):  # O5
    df = spark.range(100).withColumn("v", F.col("id") % 7)
    top = RT.top_n(df, [F.desc("v"), F.asc("id")], 3)
    assert [r["id"] for r in top.collect()] == [6, 13, 20]
    assert "TakeOrderedAndProject" in top._jdf.queryExecution().executedPlan().toString()


def test_product_scores_property_vs_fanout_join(spark):  # T11, randomized
    import random

    rnd = random.Random(11)
    for _ in range(3):
        orders_keys = [rnd.randint(0, 12) for _ in range(rnd.randint(0, 15))]          # duplicates allowed
        items = [(rnd.choice([None] + list(range(15))), rnd.choice([None, "p1", "p2", "p3"]))
                 for _ in range(rnd.randint(1, 40))]
        reviews = [(rnd.choice([None] + list(range(15))), rnd.choice(["1", "2", "3", "4", "5", "0", "x", None, "1.0"]))
                   for _ in range(rnd.randint(0, 30))]
        i_df = spark.createDataFrame(items, "o long, p string")
        r_df = spark.createDataFrame(reviews, "o long, s string")
        o_df = spark.createDataFrame([(k,) for k in orders_keys], "o long")
        got = {r["product_id"]: (r["total_sold"], r["avg_score"]) for r in RT.product_scores(
            i_df, r_df, o_df, item_order_key="o", item_product_key="p", review_order_key="o", score="s",
            order_key="o").collect()}
        acc = defaultdict(list)
        for io, p in items:
            for ro, s in reviews:
                for ok in orders_keys:
                    if io is not None and io == ro == ok and s in ("1", "2", "3", "4", "5"):
                        acc[p].append(int(s))
        want = {p: (sum(1 for _ in v if p is not None), round(sum(v) / len(v), 2)) for p, v in acc.items()}
        assert got == want
