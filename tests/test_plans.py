"""Plan shape of the registered queries, read from ``explain("formatted")``."""

import contextlib
import io

import pytest

import __spark_entry__ as E
from tests.conftest import SMALL

STREAMING = {"stream_ingest", "stream_resume", "stream_batch_counts", "frame_stream", "frame_stream_faults", "frame_resend"}
from ember.plans.catalog import QUERIES  # noqa: E402


def plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="formatted")
    return buf.getvalue()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - STREAMING))
def test_no_pair_explosion_and_no_row_udf(spark, name):
    p = plan(QUERIES[name](spark, SMALL))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython"):
        assert bad not in p, f"{name}: {bad}"
    assert "ReadSchema" in p


def test_ratings_aggregate_before_title_join(spark):
    p = plan(QUERIES["movie_stats"](spark, SMALL))
    assert "partial_avg(rating" in p
    # the lineitem scan reads only the four columns the ratings need
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint,l_linenumber:int,l_quantity:double>" in p
    join_at = p.index("HashJoin") if "HashJoin" in p else p.index("SortMergeJoin")
    assert p.index("HashAggregate") > join_at      # the aggregate sits below the title join


def test_year_filter_reaches_the_scan(spark):
    p = plan(QUERIES["revenue_by_category"](spark, SMALL))
    assert "GreaterThanOrEqual(o_orderdate,2000-01-01T00:00)" in p
    assert "LessThan(o_orderdate,2001-01-01T00:00)" in p


def test_product_scores_reduce_reviews_per_order(spark):
    p = plan(QUERIES["product_sales_score"](spark, SMALL))
    # reviews and orders are reduced per order key before meeting the items
    assert "Keys [1]: [order_id" in p and "partial_sum(try_cast(review_score" in p
    assert "Keys [1]: [o_orderkey" in p


def test_decode_reads_only_needed_columns(spark):
    p = plan(QUERIES["packet_decode"](spark, SMALL))
    assert "ReadSchema: struct<event_id:bigint,event_type:string,props:string>" in p


def test_top_n_is_not_a_global_sort(spark):
    p = plan(QUERIES["top_products"](spark, SMALL))
    assert "TakeOrderedAndProject" in p


def test_frame_kernels_are_arrow_batched(spark):
    p = plan(QUERIES["mask_dilate"](spark, SMALL))
    assert "MapInPandas" in p or "MapInArrow" in p
