"""A partitioned message log on shared storage, and a stream reader for it.

*Log.*  ``append_messages`` writes (key, value, partition) rows with Spark, one
folder of Parquet segments a commit, and then publishes a commit record: every
segment's partition, first offset and rows, and the end offsets after it.  A
partition's offsets run from 0 without a gap.  Rows of a failed append are never
published.  One appender at a time.

*Stream.*  ``format("message_log")`` reads it with offsets (partition -> next
offset) that Spark keeps in the query's checkpoint: a restart goes on where the
last batch ended, whatever the start position.  ``startingOffsets`` is ``latest``
(what is there at the first start is skipped) or ``earliest``;
``maxRowsPerTrigger`` admits so many rows a batch, shared among partitions as
evenly as their backlogs allow; ``rowsPerTask`` cuts the batch's offset ranges
into tasks, so a partition with most of the messages is read by many tasks.

The driver handles commit records only; rows go from segments to tasks.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from ember.session import ship_package
from ember.storage import files_below, names, opened, read_json, write_json

FORMAT = "message_log"
LOG_SCHEMA = "key string, value string, partition int, offset long"
ROWS_PER_TASK = 100_000
_COLUMNS = ["key", "value"]


def _record(root: str, version: int) -> dict:
    return read_json(f"{root}/commits/{version:020d}.json")


def last_version(root: str) -> int:
    """Number of the last commit; -1 for an empty log."""
    found = [n for n in names(f"{root}/commits") if n.endswith(".json") and not n.startswith(".")]
    return int(found[-1].removesuffix(".json")) if found else -1


def end_offsets(root: str) -> dict[str, int]:
    """Next offset of every partition."""
    version = last_version(root)
    return _record(root, version)["ends"] if version >= 0 else {}


def append_messages(messages: DataFrame, root: str) -> dict[str, int]:
    """Append ``messages(key, value, partition)``; the end offsets after it.

    A null partition is partition 0.  Segments keep the rows' order within a task, tasks follow each other.
    """
    spark = messages.sparkSession
    folder = f"{root}/segments/{uuid.uuid4().hex[:12]}"
    part = F.coalesce(F.col("partition").cast("int"), F.lit(0)).alias("partition")
    messages.select(F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value"), part) \
        .write.partitionBy("partition").parquet(folder)
    version = last_version(root)
    ends = dict(_record(root, version)["ends"]) if version >= 0 else {}
    segments = []
    if files_below(folder, ".parquet"):
        # One row a segment file.
        counted = spark.read.parquet(folder).groupBy("partition", F.input_file_name().alias("file")).count()
        for r in sorted(counted.collect(), key=lambda r: (r["partition"], r["file"])):
            p = str(r["partition"])
            first = ends.get(p, 0)
            segments.append({"partition": r["partition"], "file": r["file"], "first": first, "rows": r["count"]})
            ends[p] = first + r["count"]
    write_json(f"{root}/commits/{version + 1:020d}.json", {"segments": segments, "ends": ends})
    return ends


def admitted(start: dict[str, int], ends: dict[str, int], most: int | None) -> dict[str, int]:
    """End offsets of the next batch: all there is, or ``most`` rows shared evenly as far as backlogs reach."""
    backlog = {p: e - start.get(p, 0) for p, e in ends.items()}
    if most is None or sum(backlog.values()) <= most:
        return {p: max(e, start.get(p, 0)) for p, e in {**start, **ends}.items()}
    left, out = most, dict(start)
    waiting = sorted(backlog, key=lambda p: (backlog[p], int(p)))
    for i, p in enumerate(waiting):
        # The smallest backlogs first: what they leave of their share goes to the larger ones.
        take = min(backlog[p], -(-left // (len(waiting) - i)))
        out[p] = start.get(p, 0) + take
        left -= take
    return out


class OffsetRange(InputPartition):
    """Rows ``first`` to ``first + rows`` of one segment file."""

    def __init__(self, file: str, partition: int, skip: int, rows: int, offset: int):
        self.file, self.partition, self.skip, self.rows, self.offset = file, partition, skip, rows, offset


class MessageLogReader(DataSourceStreamReader):
    def __init__(self, options):
        self.root = options["path"].rstrip("/")
        self.starting = options.get("startingOffsets", "latest")
        if self.starting not in ("latest", "earliest"):
            raise ValueError("startingOffsets is latest or earliest")
        cap = options.get("maxRowsPerTrigger")
        self.cap = int(cap) if cap else None
        if self.cap is not None and self.cap < 1:
            raise ValueError("maxRowsPerTrigger is 1 or more")
        self.per_task = int(options.get("rowsPerTask", ROWS_PER_TASK))
        self.at: dict[str, int] | None = None         # end of the last batch that was planned or admitted
        self.first: dict[str, int] | None = None

    def initialOffset(self) -> dict:
        if self.first is None:
            # Partitions without an entry start at 0: those that appear later are read whole.
            self.first = end_offsets(self.root) if self.starting == "latest" else {}
        return self.first

    def latestOffset(self) -> dict:
        start = self.at if self.at is not None else self.initialOffset()
        self.at = admitted(start, end_offsets(self.root), self.cap)
        return self.at

    def partitions(self, start: dict, end: dict) -> Sequence[InputPartition]:
        # Spark plans the range it has in its log when a query restarts, an empty one too: the place to go on from.
        self.at = dict(end)
        out: list[InputPartition] = []
        version = last_version(self.root)
        while version >= 0:
            record = _record(self.root, version)
            for s in record["segments"]:
                p = str(s["partition"])
                lo = max(s["first"], start.get(p, 0))
                hi = min(s["first"] + s["rows"], end.get(p, 0))
                for a in range(lo, hi, self.per_task):
                    out.append(OffsetRange(s["file"], s["partition"], a - s["first"], min(self.per_task, hi - a), a))
            version -= 1
            # Everything before this commit was read before ``start``.
            firsts: dict[str, int] = {}
            for s in record["segments"]:
                p = str(s["partition"])
                firsts[p] = min(s["first"], firsts.get(p, s["first"]))
            if all(firsts.get(p, e) <= start.get(p, 0) for p, e in record["ends"].items()):
                break
        return out

    def read(self, partition: OffsetRange) -> Iterator[pa.RecordBatch]:
        where, path = opened(partition.file)
        with where.open_input_file(path) as source:
            file = pq.ParquetFile(source)
            skip, left, offset = partition.skip, partition.rows, partition.offset
            groups = []
            for g in range(file.num_row_groups):
                n = file.metadata.row_group(g).num_rows
                if skip >= n and not groups:
                    skip -= n
                    continue
                groups.append(g)
            for batch in file.iter_batches(batch_size=4096, row_groups=groups, columns=_COLUMNS):
                part = batch.slice(skip, left) if skip else batch.slice(0, left)
                skip = max(0, skip - batch.num_rows)
                n = part.num_rows
                if n:
                    yield pa.RecordBatch.from_arrays(
                        [part.column("key"), part.column("value"), pa.array([partition.partition] * n, pa.int32()),
                         pa.array(range(offset, offset + n), pa.int64())], names=["key", "value", "partition", "offset"])
                left, offset = left - n, offset + n
                if left <= 0:
                    return


class MessageLogSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return LOG_SCHEMA

    def streamReader(self, schema) -> MessageLogReader:
        return MessageLogReader(self.options)


def message_log_source(spark: SparkSession, root: str, *, starting_offsets: str = "latest",
                       max_rows_per_trigger: int | None = None, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """The log as a stream of (key, value, partition, offset)."""
    ship_package(spark)
    spark.dataSource.register(MessageLogSource)
    reader = spark.readStream.format(FORMAT).option("startingOffsets", starting_offsets).option("rowsPerTask", rows_per_task)
    if max_rows_per_trigger:
        reader = reader.option("maxRowsPerTrigger", max_rows_per_trigger)
    return reader.load(root)
