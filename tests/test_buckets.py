"""Tables dealt by a key: same answers as the plain tables, no exchange where keys meet, hot and null keys apart."""

import contextlib
import io
from collections import Counter

import pytest
from pyspark.sql import functions as F

from ember.buckets import deal
from ember.operators import retail as RT
from ember.plans.catalog import dealt_retail
from tests.conftest import SMALL


def plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="formatted")
    return buf.getvalue().split("\n\n")[0]             # the tree, without the nodes' details


@pytest.fixture
def no_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def rows_of(df):
    return Counter(tuple(r) for r in df.collect())


def test_joins_and_groupings_on_the_key_have_no_exchange(spark, no_broadcast):
    dealt = dealt_retail(spark, SMALL)
    t = dealt.cold
    joined = plan(t["items"].join(t["orders"], "order_id"))
    assert "SortMergeJoin" in joined and "Exchange" not in joined
    weighted = plan(RT.weighted_items(
        t["items"], t["reviews"], t["orders"], item_order_key="order_id", item_product_key="l_partkey",
        review_order_key="order_id", score="review_score", order_key="order_id"))
    assert weighted.count("SortMergeJoin") == 2 and "Exchange" not in weighted
    assert "Exchange" not in plan(t["items"].groupBy("order_id").count())
    dealt.drop()


def test_lookup_reads_one_bucket(spark):
    df = spark.range(1000).withColumnRenamed("id", "k")
    dealt = deal({"a": df}, "k", buckets=8)
    spark.conf.set("spark.sql.sources.bucketing.autoBucketedScan.enabled", "false")      # else the plan does not name them
    buf = io.StringIO()
    try:
        with contextlib.redirect_stdout(buf):
            dealt.lookup("a", 77).explain(mode="formatted")
    finally:
        spark.conf.unset("spark.sql.sources.bucketing.autoBucketedScan.enabled")
    assert "SelectedBucketsCount: 1 out of 8" in buf.getvalue()
    assert rows_of(dealt.lookup("a", 77)) == Counter([(77,)])
    dealt.drop()


@pytest.fixture
def skewed(spark):
    """A key with a third of all rows in one table, another one hot only in the other table, nulls, equal rows."""
    items = [(7, i) for i in range(400)] + [(k, k) for k in range(700)] + [(None, i) for i in range(100)] + [(3, 3)] * 4
    orders = [(k, f"o{k}") for k in range(0, 700, 2)] + [(7, "again"), (7, "again"), (None, "x")] + [(12, f"m{i}") for i in range(300)]
    return (spark.createDataFrame(items, "k long, v long").repartition(5),
            spark.createDataFrame(orders, "k long, note string").repartition(3))


def test_hot_and_null_keys_lie_apart_and_nothing_is_lost(spark, skewed):
    items, orders = skewed
    dealt = deal({"items": items, "orders": orders}, "k", buckets=8)
    assert rows_of(dealt.table("items")) == rows_of(items)
    assert rows_of(dealt.table("orders")) == rows_of(orders)
    apart = {r[0] for n in ("items", "orders") for r in dealt.apart[n].select("k").distinct().collect()}
    assert apart == {7, 12, None}
    assert not dealt.cold["items"].where(F.col("k").isNull() | F.col("k").isin(7, 12)).count()
    got = dealt.within_keys(lambda t: t["items"].join(t["orders"], "k"))
    assert rows_of(got) == rows_of(items.join(orders, "k"))
    dealt.drop()


def test_grouping_by_key_equals_the_plain_one(spark, skewed):
    items, _ = skewed
    dealt = deal({"items": items}, "k", buckets=4)
    got = dealt.within_keys(lambda t: t["items"].groupBy("k").agg(F.count("*").alias("n"), F.sum("v").alias("s")))
    assert rows_of(got) == rows_of(items.groupBy("k").agg(F.count("*").alias("n"), F.sum("v").alias("s")))
    dealt.drop()


def test_one_file_a_bucket(spark):
    dealt = deal({"a": spark.range(10_000).withColumnRenamed("id", "k").repartition(16)}, "k", buckets=6)
    assert dealt.cold["a"].select(F.input_file_name()).distinct().count() == 6
    dealt.drop()


def test_empty_tables_and_other_key_types(spark):
    empty = spark.createDataFrame([], "k long, v string")
    some = spark.createDataFrame([(1, "a"), (None, "b")], "k long, w string")
    dealt = deal({"empty": empty, "some": some}, "k", buckets=4)
    assert dealt.table("empty").columns == ["k", "v"] and dealt.table("empty").count() == 0
    assert rows_of(dealt.table("some")) == rows_of(some)
    assert dealt.within_keys(lambda t: t["some"].join(t["empty"], "k")).collect() == []
    dealt.drop()
    with pytest.raises(ValueError, match="different types"):
        deal({"a": some, "b": some.withColumn("k", F.col("k").cast("string"))}, "k")
