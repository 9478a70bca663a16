import random

import pytest
from pyspark.sql import functions as F

from ember.llm.substring_dedup import substring_dedup
from tests.conftest import SMALL
from tests.llm import brute

COLS = ["doc_id", "n_words", "n_removed", "kept_sha256"]
KEY = lambda r: tuple((x is None, x) for x in r)


def check(spark, rows, **kw):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = [tuple(r) for r in substring_dedup(df, **kw).select(COLS).collect()]
    assert sorted(got, key=KEY) == sorted(brute.substring_dedup(rows, kw.get("window", 13)), key=KEY)
    return got


@pytest.mark.parametrize("home_bytes", [1 << 20, 20_000])
def test_whole_documents_match_the_definition(spark, home_bytes):
    rows = [tuple(r) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()]
    got = check(spark, rows, home_bytes=home_bytes, bucket_prints=1000)
    assert any(r[2] for r in got) and any(r[1] and not r[2] for r in got)


def test_every_alignment_of_a_thirteen_word_match_is_found(spark):
    rnd = random.Random(5)
    fresh = lambda n: [f"w{rnd.getrandbits(40)}" for _ in range(n)]
    shared = fresh(13)
    rows = [(i, " ".join(fresh(i) + shared + fresh(7))) for i in range(15)]
    got = check(spark, rows, home_bytes=200)
    assert {r[0]: r[2] for r in got} == {i: 13 if i else 0 for i in range(15)}


def test_twelve_common_words_stay(spark):
    common = " ".join(f"c{i}" for i in range(12))
    got = check(spark, [(1, f"a {common} b"), (2, f"x {common} y")])
    assert all(r[2] == 0 for r in got)


def test_repeats_inside_small_vocabulary(spark):
    rnd = random.Random(7)
    rows = [(rnd.randrange(40), " ".join(rnd.choice("ab") for _ in range(rnd.randrange(60)))) for _ in range(60)]
    check(spark, rows, window=8, home_bytes=300, bucket_prints=50)


def test_edges(spark):
    long = " ".join(f"v{i}" for i in range(60_000))
    rows = [(3, None), (4, ""), (5, " \t\n"), (None, long), (7, long), (8, long), (8, long), (9, "é ü " * 20),
            (10, "é ü " * 20), (None, None), (11, "x" * 100_000)]
    got = check(spark, rows, home_bytes=10_000)
    assert (8, 60_000, 60_000) in [r[:3] for r in got]


def test_empty_table_and_extra_columns(spark):
    assert check(spark, []) == []
    df = spark.createDataFrame([(1, "a b", 7, "z")], "doc_id long, text string, home int, bucket string")
    assert substring_dedup(df).select("doc_id", "n_words").collect() == [(1, 2)]


def test_text_may_live_in_another_integer_type(spark):
    df = spark.createDataFrame([(1, "a b")], "doc_id int, text string").withColumn("n", F.lit(1))
    assert substring_dedup(df).count() == 1
