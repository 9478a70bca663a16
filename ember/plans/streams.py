"""The streaming queries: stage messages, run the stream, read the output.

Messages are staged by Spark from ``events`` (or, for ``frame_stream``, from
embedding-derived frames) in the Kafka layout (key = camera id, value = JSON,
one folder per source partition), then consumed by a file stream -- uncapped,
or one file per trigger where the per-batch counts are the point -- decoded
with the batch decoder and written by the idempotent ``foreachBatch`` writer.
Everything lives in a fresh folder under the shared checkpoint directory.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ember.functions import epoch_millis
from ember.images import png_header
from ember.operators.maintained import RunningCounters
from ember.operators.packets import decode_packets, frames_to_packets
from ember.session import shared_dir
from ember.sources import testdata as TD
from ember.sources.frame_files import read_output_files
from ember.sources.message_log import append_messages, message_log_source
from ember import streaming as S
from ember.streaming import frames as SF

# Source partitions of the staged topic; a message goes to event_id % N.
STAGE_PARTITIONS = 5

# What the stream consumer parses from an event message (ts is not read).
EVENT_MESSAGE = T.StructType([
    T.StructField("event_id", T.LongType()),
    T.StructField("camera_id", T.StringType()),
    T.StructField("props", T.StringType()),
])
PROPS_SCHEMA = T.StructType([T.StructField("k", T.IntegerType())])


def event_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events -> (key, value, partition) rows, value = the event as JSON."""
    ev = TD.table(spark, sf_dir, "events")
    body = F.struct("event_id", F.col("event_type").alias("camera_id"), "ts", "props")
    return ev.select(
        F.col("event_type").alias("key"),
        F.to_json(body).alias("value"),
        (F.col("event_id") % STAGE_PARTITIONS).cast("int").alias("partition"),
    )


def stage(messages: DataFrame, path: str, partitions: list[int] | None = None) -> None:
    """Write messages as JSON lines in one folder per source partition.

    The write keeps the input's parallelism (each task writes its own file
    per partition folder); with the single-file test tables that is one file
    per source partition, so a one-file rate cap gives one batch per partition.
    """
    if partitions is not None:
        messages = messages.where(F.col("partition").isin(partitions))
    messages.write.mode("append").partitionBy("partition").json(path)


def _process(decoded: DataFrame) -> DataFrame:
    """Per-batch work: unpack the payload JSON of each event."""
    return decode_packets(decoded, "props", PROPS_SCHEMA, keep=("event_id", "camera_id", "partition")) \
        .withColumn("status", F.lit("ok"))


def _run(spark: SparkSession, staged: str, root: str, max_files: int | None = None) -> list[dict]:
    msgs = S.file_message_source(spark, staged, max_files_per_trigger=max_files)
    decoded = S.observe_ingest(S.decode_stream(msgs, EVENT_MESSAGE, keep=("partition",)))
    writer = S.ingest_writer(f"{root}/out", f"{root}/dead", f"{root}/counts", _process)
    q = S.run_stream(decoded, writer, f"{root}/checkpoint", available_now=True)
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    return S.batch_progress(q)


# Progress records of the last ingest run (batch id, rows, observed counts,
# trigger time), kept for reporting; metadata only, a few entries per run.
LAST_PROGRESS: list[dict] = []


def _ingest(spark: SparkSession, sf_dir: str, resume: bool, max_files: int | None = None) -> str:
    root = shared_dir(spark, "stream")
    staged = f"{root}/staged"
    msgs = event_messages(spark, sf_dir)
    progress = []
    if resume:
        first = list(range(STAGE_PARTITIONS // 2 + 1))
        stage(msgs, staged, first)
        progress += _run(spark, staged, root, max_files)
        stage(msgs, staged, [p for p in range(STAGE_PARTITIONS) if p not in first])
        progress += _run(spark, staged, root, max_files)
    else:
        stage(msgs, staged)
        progress += _run(spark, staged, root, max_files)
    LAST_PROGRESS[:] = progress
    return root


def _read_out(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.parquet(f"{root}/out").select("event_id", "camera_id", "k")


def stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _read_out(spark, _ingest(spark, sf_dir, resume=False))


def stream_resume(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _read_out(spark, _ingest(spark, sf_dir, resume=True))


def stream_batch_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What every micro-batch recorded: per source partition, its batches and the rows of each.

    One staged file per trigger (the rate cap) makes a micro-batch of each
    staged file, that is of each source partition.
    """
    root = _ingest(spark, sf_dir, resume=False, max_files=1)
    per_batch = S.batch_counts(spark, f"{root}/counts")
    part = spark.read.parquet(f"{root}/counts").select("batch_id", F.col("partition").cast("bigint").alias("part")).distinct()
    return per_batch.join(part, "batch_id").groupBy("part").agg(
        F.count("*").alias("batches"), F.sum("processed").alias("processed"))


def frame_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One packet message per embedding's frame, keyed by camera (label)."""
    frames = TD.embedding_frames(spark, sf_dir, with_camera=True).withColumnRenamed("frame_id", "frame_number")
    # As a keyed producer does: the partition is a hash of the key, so one
    # camera's frames stay in one partition, in order.
    return frames_to_packets(frames, ts_col="frame_number").withColumn(
        "partition", F.pmod(F.hash("key"), F.lit(STAGE_PARTITIONS)).cast("int"))


def _run_frames(spark: SparkSession, root: str) -> None:
    q = SF.run_frame_stream(spark, S.file_message_source(spark, f"{root}/staged"), root, available_now=True)
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))


def frame_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Packets -> stream -> chroma key -> keyed BGRA frames; one row per
    frame written (key, file name, status, sum of the alpha channel)."""
    root = shared_dir(spark, "frames")
    stage(frame_messages(spark, sf_dir), f"{root}/staged")
    _run_frames(spark, root)
    return spark.read.parquet(f"{root}/out").select(
        "camera_id", "frame_number", "filename", "status", TD.channel_sum(TD.binary_to_ints(F.col("data")), 3).alias("alpha_sum"))


# Faults of ``frame_stream_faults`` by the frame number's rest modulo 7 (fixed values of the oracle).
FAULT_CYCLE = 7


def frame_stream_faults(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C13 under faults: every message's fate (key of a written frame, status, or the dead letter's reason).

    Rest 1: dangling base64; 2: no height; 3: an empty array; 4: no value.
    """
    root = shared_dir(spark, "faults")
    msgs = frame_messages(spark, sf_dir).withColumn("n", F.get_json_object("value", "$.frame_number").cast("bigint") % FAULT_CYCLE)
    value = (F.when(F.col("n") == 1, F.regexp_replace("value", '"frame_data":"[^"]*"', '"frame_data":"A"'))
             .when(F.col("n") == 2, F.regexp_replace("value", '"height":[0-9]+,', ""))
             .when(F.col("n") == 3, F.lit("[]")).when(F.col("n") == 4, F.lit(None).cast("string")).otherwise(F.col("value")))
    stage(msgs.withColumn("value", value).drop("n"), f"{root}/staged")
    _run_frames(spark, root)
    out = spark.read.parquet(f"{root}/out").select(
        "camera_id", F.col("frame_number").cast("bigint").alias("frame_number"), "status", F.lit(None).cast("string").alias("reason"))
    dead = spark.read.parquet(f"{root}/dead").select(
        F.lit(None).cast("string").alias("camera_id"), F.lit(None).cast("bigint").alias("frame_number"),
        F.lit("dead").alias("status"), F.col("_corrupt_reason").alias("reason"))
    return out.unionByName(dead)


def frame_resend(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Frames sent again in a later batch, a second later, replace the first ones."""
    root = shared_dir(spark, "resend")
    msgs = frame_messages(spark, sf_dir)
    stage(msgs, f"{root}/staged")
    _run_frames(spark, root)
    number = F.get_json_object("value", "$.frame_number").cast("bigint")
    stage(msgs.where(number % 3 == 0).withColumn("value", F.regexp_replace(
        "value", '"timestamp_ms":[0-9]+', F.concat(F.lit('"timestamp_ms":'), (number + 1000).cast("string")))), f"{root}/staged")
    _run_frames(spark, root)
    return SF.latest_output(spark, root).select(
        "camera_id", "filename", "timestamp_ms", F.col("batch_id").cast("bigint").alias("batch_id"))


# ------------------------------------------------------------- message log

# The registered queries read their log in so many batches: the row cap follows from the size of the table.
LOG_BATCHES = 8


def _log_cap(messages: DataFrame) -> int:
    return max(1, -(-messages.count() // LOG_BATCHES))


def _run_log(spark: SparkSession, root: str, starting: str, cap: int | None) -> None:
    msgs = message_log_source(spark, f"{root}/log", starting_offsets=starting, max_rows_per_trigger=cap)
    decoded = S.observe_ingest(S.decode_stream(msgs, EVENT_MESSAGE, keep=("partition",)))
    writer = S.ingest_writer(f"{root}/out", f"{root}/dead", f"{root}/counts", _process)
    S.drain(S.run_stream(decoded, writer, f"{root}/checkpoint", trigger="0 seconds"))


def _early(messages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Messages of the first source partitions, and the others, which are sent later."""
    first = F.col("partition") <= STAGE_PARTITIONS // 2
    return messages.filter(first), messages.filter(~first)


def stream_ingest_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events through the message log, so many rows a batch, with a restart between two appends."""
    root = shared_dir(spark, "log-stream")
    msgs = event_messages(spark, sf_dir)
    cap = _log_cap(msgs)
    for part in _early(msgs):
        append_messages(part, f"{root}/log")
        _run_log(spark, root, "earliest", cap)
    return _read_out(spark, root)


def stream_log_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of every micro-batch under the row cap."""
    root = shared_dir(spark, "log-stream")
    msgs = event_messages(spark, sf_dir)
    append_messages(msgs, f"{root}/log")
    _run_log(spark, root, "earliest", _log_cap(msgs))
    return S.batch_counts(spark, f"{root}/counts").withColumn("batch_id", F.col("batch_id").cast("bigint"))


def stream_log_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stream that starts at ``latest`` skips what was there, and what it skipped stays skipped after a restart."""
    root = shared_dir(spark, "log-stream")
    for part in _early(event_messages(spark, sf_dir)):
        append_messages(part, f"{root}/log")
        _run_log(spark, root, "latest", None)
    return _read_out(spark, root)


# -------------------------------------------------------- running counters

COUNTER_MESSAGE = T.StructType([
    T.StructField("camera_id", T.StringType()),
    T.StructField("timestamp_ms", T.LongType()),
    T.StructField("value", T.DoubleType()),
])
LATENCY_BOUNDS = (1, 10, 50, 100)
SILENT_MS = 60_000


def _counters(spark: SparkSession, sf_dir: str) -> RunningCounters:
    """Counters of a stream over all events, with a restart in the middle."""
    root = shared_dir(spark, "counters")
    body = F.struct(F.col("event_type").alias("camera_id"), epoch_millis("ts", True).alias("timestamp_ms"), "value")
    msgs = TD.table(spark, sf_dir, "events").select(
        F.col("event_type").alias("key"), F.to_json(body).alias("value"),
        (F.col("event_id") % STAGE_PARTITIONS).cast("int").alias("partition"))
    counters = RunningCounters(spark, root, LATENCY_BOUNDS)
    cap = -(-_log_cap(msgs) * LOG_BATCHES // 4)
    for part in _early(msgs):
        append_messages(part, f"{root}/log")
        source = message_log_source(spark, f"{root}/log", starting_offsets="earliest", max_rows_per_trigger=cap)
        decoded = decode_packets(source, "value", COUNTER_MESSAGE)
        q = S.run_stream(decoded, lambda df, i: counters.add_batch(df, i, stage="camera_id", value="value"),
                         f"{root}/checkpoint", trigger="0 seconds")
        S.drain(q)
    return counters


def stream_throughput(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A19, W8 on the stream."""
    return _counters(spark, sf_dir).throughput()


def stream_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W11 on the stream."""
    return _counters(spark, sf_dir).histogram.read()


def stream_silent_cameras(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cameras without a frame for a minute when the last one of all came."""
    counters = _counters(spark, sf_dir)
    now = counters.rates.read().agg(F.max("last_ms")).first()[0]
    return counters.silent(now or 0, SILENT_MS)


# ------------------------------------------------------------ frame output

def frame_latest_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W9 as a kept state: frames sent again later replace the first ones; a batch that runs again changes nothing."""
    root = shared_dir(spark, "latest")
    latest = SF.LatestFrames(spark, f"{root}/latest", least_rows=100)
    msgs = frame_messages(spark, sf_dir)
    number = F.get_json_object("value", "$.frame_number").cast("bigint")
    again = msgs.where(number % 3 == 0).withColumn("value", F.regexp_replace(
        "value", '"timestamp_ms":[0-9]+', F.concat(F.lit('"timestamp_ms":'), (number + 1000).cast("string"))))
    for part in (msgs, again):
        stage(part, f"{root}/staged")
        _run_latest(spark, root, root, latest)
    _run_latest(spark, root, f"{root}/replay", latest)
    return latest.read().select("camera_id", "filename", "timestamp_ms", "batch_id")


def _run_latest(spark: SparkSession, root: str, run: str, latest: SF.LatestFrames) -> None:
    q = SF.run_frame_stream(spark, S.file_message_source(spark, f"{root}/staged"), run, available_now=True, store=latest.store)
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))


def frame_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K6: the stream's frames as one file each, told from the files' own headers."""
    root = shared_dir(spark, "frame-files")
    stage(frame_messages(spark, sf_dir), f"{root}/staged")
    q = SF.run_frame_stream(spark, S.file_message_source(spark, f"{root}/staged"), root, available_now=True,
                            store=SF.frame_file_store(f"{root}/png"))
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    files = read_output_files(spark, f"{root}/png")
    head = png_header(F.col("content"))
    return files.select(F.regexp_extract("path", r"([^/]+)$", 1).alias("filename"), head.alias("h")).select(
        "filename", "h.width", "h.height", "h.channels")
