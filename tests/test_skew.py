"""Hot-key split join: same rows as the plain join, hot keys never shuffled."""

import contextlib
import io

from pyspark.sql import functions as F

from ember.operators.skew import hot_key_join, hot_keys


def test_hot_key_join_equals_plain_join(spark):
    # key 0 holds a third of the fact rows; key 7 is hot but missing from dim;
    # key 5 is hot with two dimension rows (stays on the shuffled path)
    n = 30000
    fact = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, 0).when(F.col("id") % 7 == 1, 7).when(F.col("id") % 11 == 2, 5)
        .otherwise(F.col("id") % 500 + 10).alias("k"), F.col("id").alias("v"))
    dim = spark.range(600).where(F.col("id") != 7).select(F.col("id").alias("k"), (F.col("id") * 2).alias("w"))
    dim = dim.unionByName(spark.createDataFrame([(5, -1)], "k long, w long"))
    got = sorted(tuple(r) for r in hot_key_join(fact, dim, "k", max_hot=50).select("k", "v", "w").collect())
    want = sorted(tuple(r) for r in fact.join(dim, "k").select("k", "v", "w").collect())
    assert got == want
    assert sorted(r[0] for r in hot_keys(fact, "k", 50).collect()) == [0, 5, 7]


def test_hot_keys_are_spread_over_salts(spark):
    fact = spark.range(1000).select((F.col("id") % 2).alias("k"), F.col("id").alias("v"))
    dim = spark.range(10).select(F.col("id").alias("k"), F.lit(1).alias("w"))
    joined = hot_key_join(fact, dim, "k", max_hot=4)
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        joined.explain()
    assert "_salt" in buf.getvalue() and joined.count() == 1000


def test_user_attr_paths_agree_with_and_without_split(spark):
    from ember.operators import ratings as R

    ratings = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") % 40 + 2).alias("user_id"),
        (F.col("id") % 17).alias("movie_id"), (F.col("id") % 5 + 1).cast("double").alias("rating"))
    users = spark.range(1, 45).select(F.col("id").alias("user_id"),
                                      F.when(F.col("id") % 2 == 0, "M").otherwise("F").alias("gender"))
    a = sorted(tuple(r) for r in R.mean_by_pair(ratings, users, "gender").collect())
    b = sorted(tuple(r) for r in R.mean_by_pair(ratings, users, "gender", hot_split=True).collect())
    assert a == b


def test_aqe_splits_a_hot_user_in_the_default_path(spark):
    """One user holds a third of the ratings: the final plan's join is split."""
    from ember.operators import ratings as R

    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
            "spark.sql.adaptive.coalescePartitions.enabled": "false",
            "spark.sql.shuffle.partitions": "16"}
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        n = 60000
        ratings = spark.range(n).select(
            F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 997 + 100).alias("user_id"),
            (F.col("id") % 211).alias("movie_id"), (F.col("id") % 5 + 1).cast("double").alias("rating"))
        users = spark.range(2000).select(F.col("id").alias("user_id"),
                                         F.when(F.col("id") % 2 == 0, "M").otherwise("F").alias("gender"))
        df = R.mean_by_pair(ratings, users, "gender")
        df.collect()
        final = df._jdf.queryExecution().executedPlan().toString()
        assert "isFinalPlan=true" in final and "skew=true" in final
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_hot_key_join_randomized(spark):
    import random

    rnd = random.Random(5)
    for _ in range(3):
        hot = rnd.randint(0, 5)
        fact = [(hot if rnd.random() < 0.4 else rnd.choice([None] + list(range(40))), i) for i in range(400)]
        dim = [(k, rnd.randint(0, 9)) for k in range(0, 40, rnd.choice([1, 2]))]
        dim += [(rnd.randint(0, 40), 99) for _ in range(rnd.randint(0, 5))]        # some keys twice
        f_df = spark.createDataFrame(fact, "k long, v long")
        d_df = spark.createDataFrame(dim, "k long, w long")
        got = sorted(tuple(r) for r in hot_key_join(f_df, d_df, "k", max_hot=5).select("k", "v", "w").collect())
        want = sorted(tuple(r) for r in f_df.join(d_df, "k").select("k", "v", "w").collect())
        assert got == want


def test_aqe_splits_a_hot_order_in_the_product_scores(spark):
    """A third of the items on one order: the join that sees raw items is split, with the same rows."""
    from ember.operators import retail as RT
    from ember.session import DEFAULT_CONF

    assert DEFAULT_CONF["spark.sql.adaptive.forceOptimizeSkewedJoin"] == "true"
    n = 60000
    items = spark.range(n).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 9973 + 100).alias("order"),
                                  (F.xxhash64("id") % 5000).alias("product"))
    orders = spark.range(12000).select(F.col("id").alias("o"))
    reviews = spark.range(12000).select(F.col("id").alias("r"), (F.col("id") % 5 + 1).cast("string").alias("score"))

    def scores():
        return RT.product_scores(items, reviews, orders, item_order_key="order", item_product_key="product",
                                 review_order_key="r", score="score", order_key="o")

    plain = sorted(tuple(r) for r in scores().collect())
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
            "spark.sql.adaptive.coalescePartitions.enabled": "false",
            "spark.sql.shuffle.partitions": "16"}
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        df = scores()
        assert sorted(tuple(r) for r in df.collect()) == plain
        final = df._jdf.queryExecution().executedPlan().toString()
        assert "isFinalPlan=true" in final and "skew=true" in final
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
