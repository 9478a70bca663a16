"""Structured Streaming: packet sources, foreachBatch sinks, resume, counts.

The decode step is the same function as in batch (``decode_packets``), so a
stream and a batch over the same messages give the same rows.  Sinks write one
folder per ``batch_id`` with overwrite: Spark's foreachBatch is at-least-once,
and a replayed batch replaces its own output instead of adding to it.
"""

from __future__ import annotations

import logging
from collections import deque
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQueryListener
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ember.operators.packets import decode_packets
from ember.schemas import MESSAGE, PACKET_CONSUMER

# Fixed values of the reference job: trigger interval, rate cap per trigger
# and start position.  The cap (4 messages a second) is an option here, not
# the default: a faster topic would only grow a backlog behind it.
DEFAULT_TRIGGER = "5 seconds"
REFERENCE_MAX_PER_TRIGGER = 20
DEFAULT_STARTING_OFFSETS = "latest"
_LOG = logging.getLogger("ember.streaming")

# Row statuses that count as processed (frame operators set these).
OK_STATUSES = ("ok", "segmented", "chroma_key")


def kafka_source_options(
    servers: str, topic: str, *,
    starting_offsets: str = DEFAULT_STARTING_OFFSETS,
    max_offsets_per_trigger: int | None = None,
    min_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> dict[str, str]:
    """Subscribe to one topic from ``latest`` (data before the first
    start is skipped; a restart resumes from the checkpoint), at most
    ``max_offsets_per_trigger`` messages per micro-batch when given.

    Spark reads one Kafka partition with one task; ``min_partitions`` (set it
    to at least the executor cores) lets Spark cut a large partition -- e.g. a
    camera key carrying a third of the traffic -- into several tasks."""
    opts = {"kafka.bootstrap.servers": servers, "subscribe": topic, "startingOffsets": starting_offsets}
    if max_offsets_per_trigger:
        opts["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    if min_partitions:
        opts["minPartitions"] = str(min_partitions)
    opts.update(extra or {})
    return opts


def kafka_source(spark: SparkSession, servers: str, topic: str, **kw) -> DataFrame:
    """Kafka messages (needs the spark-sql-kafka connector on the classpath,
    e.g. ``build_session(packages=[KAFKA_PACKAGE])``)."""
    return spark.readStream.format("kafka").options(**kafka_source_options(servers, topic, **kw)).load()


def file_message_source(
    spark: SparkSession, path: str, *, max_files_per_trigger: int | None = None,
    schema: T.StructType = MESSAGE, fmt: str = "json",
) -> DataFrame:
    """Kafka-shaped messages (key, value, partition) from files, for tests and
    replays; ``maxFilesPerTrigger`` plays the rate cap."""
    reader = spark.readStream.format(fmt).schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.load(path)


def kafka_writer_options(servers: str, topic: str, *, compression: str = "gzip", batch_size: int = 16384,
                         linger_ms: int = 10, acks: str = "all", retries: int = 3) -> dict[str, str]:
    """K8: the producer's delivery settings as Kafka sink options."""
    return {
        "kafka.bootstrap.servers": servers,
        "topic": topic,
        "kafka.compression.type": compression,
        "kafka.batch.size": str(batch_size),
        "kafka.linger.ms": str(linger_ms),
        "kafka.acks": acks,
        "kafka.retries": str(retries),
    }


def write_messages(df: DataFrame, options: dict[str, str]) -> None:
    """K7: write (key, value) rows to Kafka in one batch job."""
    df.select("key", "value").write.format("kafka").options(**options).save()


def decode_stream(messages: DataFrame, schema: T.StructType = PACKET_CONSUMER,
                  keep: tuple[str, ...] = ("partition",)) -> DataFrame:
    """Message value -> packet columns, with the raw text of bad messages kept
    in ``_corrupt`` and the reason in ``_corrupt_reason`` for dead-lettering."""
    keep = tuple(k for k in keep if k in messages.columns)
    return decode_packets(messages, "value", schema, keep=keep, corrupt_col="_corrupt")


def observe_ingest(decoded: DataFrame, name: str = "ingest") -> DataFrame:
    """Per-batch counts of messages and malformed messages as observed
    metrics -- computed inside the batch's own job, read from the progress."""
    return decoded.observe(name, F.count(F.lit(1)).alias("messages"),
                           F.count_if(F.col("_corrupt_reason").isNotNull()).alias("malformed"))


def batch_counts(spark: SparkSession, counts_path: str) -> DataFrame:
    """Processed rows of every finished micro-batch, as the batches recorded them."""
    return spark.read.parquet(counts_path).groupBy("batch_id").agg(F.sum("processed").alias("processed"))


def batch_progress(query, name: str = "ingest") -> list[dict]:
    """One small record per recent micro-batch (id, input rows, observed
    counts, duration) from the query's progress reports, of which Spark keeps
    the last ``spark.sql.streaming.numRecentProgressUpdates``; ``batch_counts``
    has every batch."""
    out = []
    for p in query.recentProgress:
        get = (lambda k, p=p: p[k]) if isinstance(p, dict) else (lambda k, p=p: getattr(p, k))
        metrics = get("observedMetrics") or {}
        obs = metrics.get(name)
        obs = obs.asDict() if hasattr(obs, "asDict") else (dict(obs) if obs else {})
        dur = get("durationMs") or {}
        out.append({"batch_id": get("batchId"), "input_rows": get("numInputRows"),
                    "trigger_ms": dur.get("triggerExecution"), **obs})
    return out


class BatchLineListener(StreamingQueryListener):
    """One result line per finished micro-batch, from progress events.

    Register with ``spark.streams.addListener(BatchLineListener())``; each
    batch of a query that used ``observe_ingest`` adds a line
    ``Batch <id> finished. Processed <rows> items (<malformed> malformed).``
    to ``lines`` (the last ``keep`` ones) and to the ``ember.streaming``
    logger.  Only progress metadata reaches the driver.
    """

    def __init__(self, name: str = "ingest", keep: int = 1000):
        self.name = name
        self.lines: deque[str] = deque(maxlen=keep)

    def onQueryStarted(self, event):
        pass

    def onQueryProgress(self, event):
        p = event.progress
        obs = (p.observedMetrics or {}).get(self.name)
        if obs is None:
            return
        line = (f"Batch {p.batchId} finished. Processed {obs['messages'] - obs['malformed']} items "
                f"({obs['malformed']} malformed).")
        self.lines.append(line)
        _LOG.info(line)

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        pass


def ingest_writer(out_path: str, dead_letter_path: str, counts_path: str,
                  process: Callable[[DataFrame], DataFrame] | None = None,
                  count_by: tuple[str, ...] = ("partition",),
                  store: Callable[[DataFrame, int], None] | None = None) -> Callable[[DataFrame, int], None]:
    """The per-batch function for ``foreachBatch``.

    Per batch: good rows (optionally through ``process``) to
    ``out/batch_id=N``, malformed ones (if any) to ``dead/batch_id=N``, and
    the count of processed rows per source partition to ``counts/batch_id=N``.  Every
    write overwrites its batch folder, so a replay is idempotent.  ``store``
    takes the good rows of a batch elsewhere (a ``MergeTable``, frame files) and
    has to bear a replay of the same batch id itself.  An error is
    raised, not swallowed: the batch is then not committed and is retried,
    where the reference lost it (T19).
    """

    def run(batch_df: DataFrame, batch_id: int) -> None:
        # Persist first: the probe, the writes and the counts then read each
        # source row once (observed metrics count it once too).  One probe job
        # gives both the emptiness check and the number of malformed rows.
        batch_df = batch_df.persist()
        try:
            probe = batch_df.agg(F.count(F.lit(1)).alias("n"),
                                 F.count_if(F.col("_corrupt_reason").isNotNull()).alias("bad")).first()
            if probe["n"] == 0:  # F5
                return
            good = batch_df.where(F.col("_corrupt_reason").isNull()).drop("_corrupt", "_corrupt_reason")
            bad = batch_df.where(F.col("_corrupt_reason").isNotNull()).select("_corrupt", "_corrupt_reason", *[
                c for c in count_by if c in batch_df.columns])
            if process is not None:
                good = process(good)
            good = good.persist()
            if store is not None:
                store(good, batch_id)
            else:
                good.write.mode("overwrite").parquet(f"{out_path}/batch_id={batch_id}")
            if probe["bad"]:
                bad.write.mode("overwrite").parquet(f"{dead_letter_path}/batch_id={batch_id}")
            keys = [c for c in count_by if c in good.columns]
            ok = F.col("status").isin(*OK_STATUSES) if "status" in good.columns else F.lit(True)
            (good.groupBy(*keys).agg(F.count_if(ok).alias("processed"))
             .write.mode("overwrite").parquet(f"{counts_path}/batch_id={batch_id}"))
            good.unpersist()
        finally:
            batch_df.unpersist()

    return run


def run_stream(
    df: DataFrame, on_batch: Callable[[DataFrame, int], None], checkpoint: str, *,
    trigger: str | None = None, available_now: bool = False, name: str | None = None,
):
    """Start ``foreachBatch`` with a checkpoint and a trigger.

    ``available_now=True`` drains what is there (respecting the rate cap, so
    several batches) and stops -- the mode for tests and backfills; otherwise
    a processing-time trigger (``DEFAULT_TRIGGER``) runs until stopped.
    """
    w = df.writeStream.foreachBatch(on_batch).option("checkpointLocation", checkpoint)
    if name:
        w = w.queryName(name)
    if available_now:
        w = w.trigger(availableNow=True)
    else:
        w = w.trigger(processingTime=trigger or DEFAULT_TRIGGER)
    return w.start()


def drain(query) -> None:
    """Run a started query until its source has nothing new, stop it, and raise what it failed with.

    Unlike ``available_now`` this obeys the row cap of any source: as many batches as it takes.
    """
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    if query.exception() is not None:
        raise RuntimeError(str(query.exception()))
