"""Every registered query: ``(spark, sf_dir) -> DataFrame`` over the driver's tables.

Each entry wires the stand-in tables of ``ember.sources.testdata`` into one
library operator (or a composite question of the reference).  Column names
and types match ``ember.plans.oracle``.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ember.buckets import deal
from ember.functions import age_group, b64decode, b64encode_text, epoch_millis, frame_filename, two_decimals
from ember.operators import frames as FR
from ember.operators import maintained as MT
from ember.operators import metrics as M
from ember.operators import packets as P
from ember.operators import quality as Q
from ember.operators import ratings as R
from ember.operators import report as RP
from ember.operators import retail as RT
from ember.session import session_for, shared_dir
from ember.sources import testdata as TD
from ember.sources.frame_files import read_output_files, write_frame_files
from ember.plans import streams as ST
from ember.plans import textfiles as TF

Query = Callable[[SparkSession, str], DataFrame]

# Parameters of the registered queries (as in SURVEY Appendix A).
MIN_COUNT_FILTER = 30      # movies_min_count: makes the HAVING bite on the fixture
MIN_COUNT_BEST = 5         # top_rated_movie: the reference's threshold
REVENUE_YEAR = 2000
TOP_N = 10
MISSING_SINCE_YEAR = 2001
EXPECTED_FRAMES = 2000     # duration x fps stand-in
LATENCY_BOUNDS = (1, 10, 50, 100)


def _ratings(spark: SparkSession, d: str) -> DataFrame:
    # The count comes from the footers of the files; joins with other tables run in the ratings' session.
    r1, r2 = TD.rating_files(session_for(spark, TD.table(spark, d, "lineitem").count()), d)
    return R.union_all(r1, r2)


# ------------------------------------------------------------------ ratings

def movie_stats(spark, d):
    return R.movie_stats(_ratings(spark, d), TD.movies(spark, d))


def movies_min_count(spark, d):
    return R.movies_min_count(_ratings(spark, d), TD.movies(spark, d), MIN_COUNT_FILTER)


def top_rated_movie(spark, d):
    return R.top_by_mean(_ratings(spark, d), TD.movies(spark, d), MIN_COUNT_BEST)


def movie_report(spark, d):
    return RP.movie_report(_ratings(spark, d), TD.movies(spark, d))


def genre_explode(spark, d):
    return R.explode_list(TD.movies(spark, d), "title", " ", "genre")


def genre_stats(spark, d):
    return R.genre_stats(_ratings(spark, d), TD.movies(spark, d))


def gender_avg_long(spark, d):
    return R.mean_by_pair(_ratings(spark, d), TD.users(spark, d), "gender")


def gender_avg_long_hot_split(spark, d):
    """A3 with the explicit hot-key split join (same answer, skew-proof plan)."""
    return R.mean_by_pair(_ratings(spark, d), TD.users(spark, d), "gender", hot_split=True)


def gender_list(spark, d):
    return R.attr_list(_ratings(spark, d), TD.users(spark, d), "gender", "genders")


def gender_pivot(spark, d):
    return R.gender_pivot(_ratings(spark, d), TD.users(spark, d), TD.movies(spark, d))


def gender_report(spark, d):
    return RP.gender_report(_ratings(spark, d), TD.users(spark, d), TD.movies(spark, d))


def age_report(spark, d):
    return RP.age_report(_ratings(spark, d), TD.users(spark, d), TD.movies(spark, d))


def genre_report(spark, d):
    return RP.genre_report(_ratings(spark, d), TD.movies(spark, d))


def occupation_report(spark, d):
    return RP.occupation_report(_ratings(spark, d), TD.users(spark, d), TD.occupations(spark, d))


def year_report(spark, d):
    return RP.year_report(_ratings(spark, d), "ts")


def best_movie_report(spark, d):
    return RP.best_movie_report(_ratings(spark, d), TD.movies(spark, d), MIN_COUNT_BEST)


def gender_avg_list(spark, d):
    """The sorted (gender, mean) pairs of every movie as text."""
    pairs = R.attr_mean_list(_ratings(spark, d), TD.users(spark, d), "gender")
    text = F.transform("pairs", lambda p: F.concat(p["value"], F.lit(":"), two_decimals(p["mean"])))
    return pairs.select("movie_id", F.array_join(text, ",").alias("genders"))


def age_bucket(spark, d):
    return TD.users(spark, d).select("user_id", age_group("age").alias("age_group"))


def age_avg_long(spark, d):
    return R.mean_by_pair(_ratings(spark, d), R.with_age_group(TD.users(spark, d)), "age_group")


def age_pivot(spark, d):
    return R.age_pivot(_ratings(spark, d), TD.users(spark, d), TD.movies(spark, d))


def occupation_stats(spark, d):
    return R.occupation_stats(_ratings(spark, d), TD.users(spark, d), TD.occupations(spark, d))


def year_stats(spark, d):
    return R.by_year(_ratings(spark, d), "ts")


def ratings_union(spark, d):
    return R.rating_multiplicity(_ratings(spark, d))


# ------------------------------------------------------------------- retail

def _customers_with_country(spark, d):
    return TD.table(spark, d, "customer").join(
        TD.table(spark, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))


def entity_counts(spark, d):
    return RT.entity_counts(TD.table(spark, d, "orders"), TD.table(spark, d, "customer"),
                            TD.table(spark, d, "lineitem"), "c_custkey", "l_suppkey")


def orders_by_country(spark, d):
    return RT.orders_by_country(_customers_with_country(spark, d), TD.table(spark, d, "orders"),
                                customer_key="c_custkey", order_customer_key="o_custkey", country="n_name")


def orders_by_month(spark, d):
    return RT.orders_by_month(TD.table(spark, d, "orders"), "o_orderdate")


def score_hist_raw(spark, d):
    return RT.count_by(TD.reviews(spark, d), ["review_score"], "cnt")


def score_clean(spark, d):
    return RT.keep_valid(TD.reviews(spark, d), "review_score")


def score_distinct(spark, d):
    return RT.distinct_values(RT.keep_valid(TD.reviews(spark, d), "review_score"), "review_score")


def score_hist_clean(spark, d):
    clean = RT.keep_valid(TD.reviews(spark, d), "review_score")
    return RT.count_by(clean, ["review_score"], "cnt").orderBy("review_score")


def score_avg(spark, d):
    return RT.mean_of_int(RT.keep_valid(TD.reviews(spark, d), "review_score"), "review_score")


def item_total_value(spark, d):
    li = TD.table(spark, d, "lineitem")
    return li.select("l_orderkey", "l_linenumber", "l_partkey",
                     RT.total_value(li, "l_extendedprice", "l_tax"))


def product_order_join(spark, d):
    j = RT.product_order_join(
        TD.table(spark, d, "part"), TD.table(spark, d, "lineitem"), TD.table(spark, d, "orders"),
        product_key="p_partkey", item_product_key="l_partkey", item_order_key="l_orderkey",
        order_key="o_orderkey")
    return j.select("p_partkey", "p_type", "l_orderkey", "l_linenumber", "o_custkey")


def revenue_by_category(spark, d):
    return RT.revenue_by_category(
        TD.table(spark, d, "part"), TD.table(spark, d, "lineitem"), TD.table(spark, d, "orders"),
        year=REVENUE_YEAR, product_key="p_partkey", category="p_type", item_product_key="l_partkey",
        item_order_key="l_orderkey", price="l_extendedprice", freight="l_tax", order_key="o_orderkey",
        order_ts="o_orderdate")


def product_sales_score(spark, d):
    return RT.product_scores(
        TD.table(spark, d, "lineitem"), TD.reviews(spark, d), TD.table(spark, d, "orders"),
        item_order_key="l_orderkey", item_product_key="l_partkey", review_order_key="order_id",
        score="review_score", order_key="o_orderkey")


def top_products(spark, d):
    return RT.top_n(product_sales_score(spark, d), [F.desc("total_sold"), F.asc("product_id")], TOP_N)


def dealt_retail(spark, d):
    """Items, reviews and orders dealt by the order, their join columns named alike."""
    return deal({
        "items": TD.table(spark, d, "lineitem").select(F.col("l_orderkey").alias("order_id"), "l_linenumber", "l_partkey"),
        "reviews": TD.reviews(spark, d),
        "orders": TD.table(spark, d, "orders").select(F.col("o_orderkey").alias("order_id"), "o_custkey")}, "order_id")


def product_sales_score_dealt(spark, d):
    """C12 over dealt tables: only the sums per product are exchanged."""
    return RT.scores_of_items(dealt_retail(spark, d).within_keys(lambda t: RT.weighted_items(
        t["items"], t["reviews"], t["orders"], item_order_key="order_id", item_product_key="l_partkey",
        review_order_key="order_id", score="review_score", order_key="order_id")))


def product_order_join_dealt(spark, d):
    """J7 with items and orders joined where they lie; the product join follows."""
    lines = dealt_retail(spark, d).within_keys(lambda t: t["items"].join(t["orders"], "order_id"))
    parts = TD.table(spark, d, "part").select("p_partkey", "p_type")
    return parts.join(lines, F.col("p_partkey") == F.col("l_partkey")).select(
        "p_partkey", "p_type", F.col("order_id").alias("l_orderkey"), "l_linenumber", "o_custkey")


# ------------------------------------------------------------------ packets

def _camera_frames(spark, d):
    """events as frames: camera = event_type, frame number = event_id."""
    return TD.table(spark, d, "events").select(
        "event_id", F.col("event_type").alias("camera_id"), "ts", "user_id", "value", "props")


def packet_encode(spark, d):
    ev = TD.table(spark, d, "events")
    frames = ev.select(
        F.col("event_type").alias("camera_id"),
        epoch_millis("ts").alias("timestamp_ms"),
        F.col("event_id").alias("frame_number"))
    return P.encode_packets(frames, "camera_id")


def packet_encode_full(spark, d):
    """C14: the whole nine-field packet, the event's properties as payload and its time as clock."""
    ev = TD.table(spark, d, "events").select(
        F.col("event_type").alias("camera_id"), F.col("event_id").alias("frame_number"), F.lit(480).alias("height"),
        F.lit(640).alias("width"), F.encode("props", "UTF-8").alias("data"), epoch_millis("ts").alias("ms"), "ts")
    return P.frames_to_packets(ev, ts_col="ms", created_col="ts")


def packet_decode(spark, d):
    ev = _camera_frames(spark, d)
    dec = P.decode_packets(ev, "props", ST.PROPS_SCHEMA, keep=("event_id", "camera_id"))
    return dec.select("event_id", "camera_id", "k")


def payload_base64(spark, d):
    return TD.table(spark, d, "documents").select("doc_id", b64encode_text("text").alias("frame_data"))


def payload_roundtrip(spark, d):
    docs = TD.table(spark, d, "documents")
    return docs.select("doc_id", F.octet_length(b64decode(b64encode_text("text"))).cast("bigint").alias("n_bytes"))


def frame_filename_q(spark, d):
    ev = TD.table(spark, d, "events")
    return ev.select("event_id", frame_filename("event_type", "event_id").alias("filename"))


def frame_dedup_last(spark, d):
    ev = TD.table(spark, d, "events").select(
        F.col("event_type").alias("camera_id"), F.col("user_id").alias("frame_number"), "ts", "event_id")
    return P.latest_frames(ev, ("camera_id", "frame_number"), ("ts", "event_id"), "event_id")


# Fault injection of the packet-validity fixture (fixed values of the oracle).
MISSING_CAMERA_EVERY, BAD_QUALITY_EVERY, ZERO_WIDTH_EVERY, BAD_BASE64_EVERY = 11, 13, 17, 19


def _dangling(b64):
    """Corrupt a base64 text: padding removed, data padded with 'A' to one
    character more than a multiple of four, which no decoder accepts."""
    data = F.rtrim(b64, F.lit("="))
    return F.concat(data, F.repeat(F.lit("A"), (F.lit(5) - F.length(data) % 4) % 4))


def validity_packets(spark, d):
    """One JSON packet per document, the document text as the payload, with
    faults injected by document id."""
    docs = TD.table(spark, d, "documents")
    k = F.col("doc_id")
    payload = b64encode_text("text")
    pk = docs.select(
        "doc_id",
        F.when(k % MISSING_CAMERA_EVERY != 0, F.col("source")).alias("camera_id"),
        (k * 1000).alias("timestamp_ms"),
        k.cast("int").alias("frame_number"),
        F.when(k % ZERO_WIDTH_EVERY == 0, 0).otherwise(640).alias("width"),
        F.lit(480).alias("height"),
        F.lit("JPEG").alias("encoding"),
        F.when(k % BAD_BASE64_EVERY == 0, _dangling(payload)).otherwise(payload).alias("frame_data"),
        F.when(k % BAD_QUALITY_EVERY == 0, 101).otherwise(85).alias("quality"),
    )
    return pk.select("doc_id", F.to_json(P.packet_struct(pk)).alias("value"))


def packet_validity(spark, d):
    return Q.validate_packets(validity_packets(spark, d), "value", keep=("doc_id",)).select("doc_id", "message")


def missing_outputs(spark, d):
    cust = TD.table(spark, d, "customer").select("c_custkey")
    orders = TD.table(spark, d, "orders")
    recent = orders.where(RT.on_or_after(orders, "o_orderdate", dt.date(MISSING_SINCE_YEAR, 1, 1)))
    return Q.missing_outputs(cust, recent, "c_custkey", "o_custkey")


def frame_count_check(spark, d):
    return Q.frame_count_check(TD.table(spark, d, "events"), "event_type", EXPECTED_FRAMES, "camera_id")


# ------------------------------------------------------------------ metrics

def camera_throughput(spark, d):
    return M.throughput_by(TD.table(spark, d, "events"), "event_type", "ts", "camera_id")


def stage_latency(spark, d):
    return M.latency_summary(TD.table(spark, d, "events"), "event_type", "value")


def frame_total_latency(spark, d):
    return M.total_latency(TD.table(spark, d, "events"), "user_id", "value")


def latency_histogram(spark, d):
    return M.latency_histogram(TD.table(spark, d, "events"), "event_type", "value", LATENCY_BOUNDS)


def message_volume(spark, d):
    return M.message_volume(TD.table(spark, d, "documents"), "text")


# ------------------------------------------------------------------- frames

def alpha_threshold(spark, d):
    masks = FR.alpha_threshold(TD.category_masks(spark, d), "scores")
    w = F.col("width").cast("bigint")
    return masks.select("frame_id", "width", F.posexplode("alpha").alias("_i", "alpha")).select(
        "frame_id", (F.col("_i") / w).cast("bigint").alias("y"), (F.col("_i") % w).cast("bigint").alias("x"),
        "alpha")


def mask_dilate(spark, d):
    return FR.pixels(FR.map_masks(TD.quadrant_masks(spark, d), FR.dilate), ("frame_id",))


def mask_erode(spark, d):
    return FR.pixels(FR.map_masks(TD.quadrant_masks(spark, d), FR.erode), ("frame_id",))


def chroma_mask(spark, d):
    return FR.pixels(FR.chroma_mask(TD.embedding_frames(spark, d)), ("frame_id",))


def chroma_key_alpha(spark, d):
    """I7 per pixel: the alpha channel of the chroma-keyed frames."""
    keyed = FR.chroma_key_frames(TD.embedding_frames(spark, d))
    return FR.pixels(keyed, ("frame_id",), value="alpha", channels=4, channel=3)


def _channel_sums(frames):
    """Key columns and the sum of every channel of BGRA frames."""
    values = frames.withColumn("values", TD.binary_to_ints(F.col("data")))         # once for all channels
    sums = [TD.channel_sum(F.col("values"), c).alias(f"sum_{n}") for c, n in enumerate("bgra")]
    return values.select("frame_id", "height", "width", "nChannels", "status", *sums)


def chroma_key_frames(spark, d):
    return _channel_sums(FR.chroma_key_frames(TD.embedding_frames(spark, d)))


def _weighted_segmenter():
    """Stand-in for a segmentation model: a score that tells the channels apart."""
    def fn(rgb: np.ndarray) -> np.ndarray:
        r, g, b = (rgb[..., c].astype(np.float64) for c in range(3))
        return (5 * r + 3 * g + 2 * b) / 2550.0 - 0.45
    return fn


def segment_alpha(spark, d):
    """I8/I9 per pixel: the alpha channel after the pluggable segmenter."""
    seg = FR.segment_frames(TD.embedding_frames(spark, d), _weighted_segmenter)
    return FR.pixels(seg, ("frame_id",), value="alpha", channels=4, channel=3)


def segment_frames(spark, d):
    return _channel_sums(FR.segment_frames(TD.embedding_frames(spark, d), _weighted_segmenter))


# ------------------------------------------------- kept up to date by merging

INCREMENTS = 4             # the ratings arrive as so many files


def _maintained_ratings(spark, d) -> MT.MaintainedRatings:
    kept = MT.MaintainedRatings(spark, shared_dir(spark, "kept-ratings"))
    rows = _ratings(spark, d)
    for i in (*range(INCREMENTS), 1):                                # the second file is sent twice
        kept.add(f"ratings-{i}", rows.filter(F.pmod("user_id", F.lit(INCREMENTS)) == i))
    return kept


def movie_stats_maintained(spark, d):
    return _maintained_ratings(spark, d).movie_stats(TD.movies(spark, d))


def genre_stats_maintained(spark, d):
    return _maintained_ratings(spark, d).genre_stats(TD.movies(spark, d))


def occupation_stats_maintained(spark, d):
    return _maintained_ratings(spark, d).occupation_stats(TD.users(spark, d), TD.occupations(spark, d))


def entity_counts_maintained(spark, d):
    """C7 from bitmaps; the items come in two inputs, one of them twice."""
    kept = MT.DistinctIds(spark, shared_dir(spark, "kept-ids"))
    items = TD.table(spark, d, "lineitem")
    early = F.col("l_linenumber") <= TD.RATING_FILE_SPLIT_LINE
    for name, rows, col in (("orders", TD.table(spark, d, "orders"), "o_orderkey"),
                            ("customers", TD.table(spark, d, "customer"), "c_custkey"),
                            ("sellers", items.filter(early), "l_suppkey"), ("sellers-late", items.filter(~early), "l_suppkey"),
                            ("sellers", items.filter(early), "l_suppkey")):
        kept.add(name, rows, {name.split("-")[0]: col})
    return kept.one_row({"total_orders": "orders", "total_customers": "customers", "total_sellers": "sellers"})


# ------------------------------------------------------- frames and their files

def frame_gaps(spark, d):
    """V4: the frame numbers each camera lacks, from 0 to its last one."""
    return Q.frame_gaps(TD.table(spark, d, "events"), "event_type", "event_id", first=0)


def frames_in_order(spark, d):
    """Every frame's place in its camera's order."""
    events = TD.table(spark, d, "events").select(F.col("event_type").alias("camera_id"), F.col("event_id").alias("frame_number"))
    return P.camera_positions(events)


def output_check(spark, d):
    """V2, V3: the check of an output folder that lacks every fifth frame and holds the ones after those without alpha."""
    raw = TD.embedding_frames(spark, d, with_camera=True).withColumn("filename", frame_filename("camera_id", "frame_id"))
    keyed = FR.chroma_key_frames(raw, ("frame_id", "filename"))
    rest = F.col("frame_id") % 5
    path = f"{shared_dir(spark, 'outputs')}/png"
    cols = ["filename", "height", "width", "nChannels", "data"]
    write_frame_files(keyed.filter(rest > 1).select(cols).unionByName(raw.filter(rest == 1).select(cols)), path)
    return Q.validate_output_files(raw.select("filename"), read_output_files(spark, path), TD.FRAME_SIDE, TD.FRAME_SIDE)


QUERIES: dict[str, Query] = {
    "movie_stats": movie_stats,
    "movie_stats_text": TF.movie_stats_text,
    "movies_min_count": movies_min_count,
    "top_rated_movie": top_rated_movie,
    "movie_report": movie_report,
    "genre_explode": genre_explode,
    "genre_stats": genre_stats,
    "gender_avg_long": gender_avg_long,
    "gender_avg_long_hot_split": gender_avg_long_hot_split,
    "gender_list": gender_list,
    "gender_pivot": gender_pivot,
    "gender_report": gender_report,
    "age_report": age_report,
    "genre_report": genre_report,
    "occupation_report": occupation_report,
    "year_report": year_report,
    "best_movie_report": best_movie_report,
    "gender_avg_list": gender_avg_list,
    "genre_stats_text": TF.genre_stats_text,
    "age_pivot_text": TF.age_pivot_text,
    "occupation_stats_text": TF.occupation_stats_text,
    "year_stats_text": TF.year_stats_text,
    "ratings_quarantine": TF.ratings_quarantine,
    "orders_by_month_csv": TF.orders_by_month_csv,
    "revenue_by_category_csv": TF.revenue_by_category_csv,
    "age_bucket": age_bucket,
    "age_avg_long": age_avg_long,
    "age_pivot": age_pivot,
    "occupation_stats": occupation_stats,
    "year_stats": year_stats,
    "ratings_union": ratings_union,
    "entity_counts": entity_counts,
    "orders_by_country": orders_by_country,
    "orders_by_country_csv": TF.orders_by_country_csv,
    "orders_by_month": orders_by_month,
    "score_hist_raw": score_hist_raw,
    "score_clean": score_clean,
    "score_distinct": score_distinct,
    "score_hist_clean": score_hist_clean,
    "score_avg": score_avg,
    "item_total_value": item_total_value,
    "product_order_join": product_order_join,
    "revenue_by_category": revenue_by_category,
    "product_sales_score": product_sales_score,
    "product_sales_score_dealt": product_sales_score_dealt,
    "product_order_join_dealt": product_order_join_dealt,
    "top_products": top_products,
    "packet_encode": packet_encode,
    "packet_encode_full": packet_encode_full,
    "packet_decode": packet_decode,
    "stream_ingest": ST.stream_ingest,
    "stream_resume": ST.stream_resume,
    "stream_batch_counts": ST.stream_batch_counts,
    "payload_base64": payload_base64,
    "payload_roundtrip": payload_roundtrip,
    "frame_filename": frame_filename_q,
    "frame_dedup_last": frame_dedup_last,
    "packet_validity": packet_validity,
    "missing_outputs": missing_outputs,
    "frame_count_check": frame_count_check,
    "camera_throughput": camera_throughput,
    "stage_latency": stage_latency,
    "frame_total_latency": frame_total_latency,
    "latency_histogram": latency_histogram,
    "message_volume": message_volume,
    "alpha_threshold": alpha_threshold,
    "mask_dilate": mask_dilate,
    "mask_erode": mask_erode,
    "chroma_mask": chroma_mask,
    "chroma_key_alpha": chroma_key_alpha,
    "chroma_key_frames": chroma_key_frames,
    "frame_stream": ST.frame_stream,
    "frame_stream_faults": ST.frame_stream_faults,
    "frame_resend": ST.frame_resend,
    "stream_ingest_log": ST.stream_ingest_log,
    "stream_log_batches": ST.stream_log_batches,
    "stream_log_latest": ST.stream_log_latest,
    "frame_latest_state": ST.frame_latest_state,
    "frame_files": ST.frame_files,
    "output_check": output_check,
    "frame_gaps": frame_gaps,
    "frames_in_order": frames_in_order,
    "movie_stats_maintained": movie_stats_maintained,
    "genre_stats_maintained": genre_stats_maintained,
    "occupation_stats_maintained": occupation_stats_maintained,
    "entity_counts_maintained": entity_counts_maintained,
    "stream_throughput": ST.stream_throughput,
    "stream_histogram": ST.stream_histogram,
    "stream_silent_cameras": ST.stream_silent_cameras,
    "segment_alpha": segment_alpha,
    "segment_frames": segment_frames,
}
