"""K6: one PNG file a frame, published only when the whole job has succeeded.

``format("frame_files")`` takes rows with ``filename``, ``height``, ``width``,
``nChannels`` and ``data``.  Tasks write into a staging folder of their own; a
task that dies or runs twice leaves files that nobody sees.  The job's commit
first records which task attempts won, then moves their files to
``path/<filename>``, replacing files of that name, and drops the staging folder.
A driver lost between record and moves is made good by ``finish_commits``; an
aborted job leaves nothing.

Rows without pixels are passed over.  A slash in a name becomes ``%2F``.  Of rows
with one name in one write any one wins: reduce them first (``sinks.last_writes``).
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from ember.images import encode_png
from ember.session import ship_package
from ember.storage import delete_file, delete_folder, names, opened, read_json, write_json

FORMAT = "frame_files"
FRAME_FILE_SCHEMA = "filename string, height int, width int, nChannels int, data binary"
MOVES_AT_ONCE = 16


@dataclass
class WrittenFrames(WriterCommitMessage):
    folder: str
    files: int


class FrameFileWriter(DataSourceArrowWriter):
    def __init__(self, root: str):
        self.root = root.rstrip("/")
        self.job = uuid.uuid4().hex[:16]

    def write(self, iterator: Iterator) -> WrittenFrames:
        folder = f"{self.root}/_staging/{self.job}/{uuid.uuid4().hex[:12]}"
        where, path = opened(folder)
        files = 0
        for batch in iterator:
            for row in batch.select(["filename", "height", "width", "nChannels", "data"]).to_pylist():
                if row["data"] is None or row["filename"] is None:
                    continue
                if not files:
                    where.create_dir(path, recursive=True)
                name = row["filename"].replace("/", "%2F")
                with where.open_output_stream(f"{path}/{name}") as out:
                    out.write(encode_png(row["data"], row["height"], row["width"], row["nChannels"]))
                files += 1
        return WrittenFrames(folder, files)

    def commit(self, messages: list[WrittenFrames | None]) -> None:
        won = [m.folder for m in messages if m is not None and m.files]
        write_json(f"{self.root}/_commits/{self.job}.json", won)
        _publish(self.root, self.job)

    def abort(self, messages: list[WrittenFrames | None]) -> None:
        delete_folder(f"{self.root}/_staging/{self.job}")


def _publish(root: str, job: str) -> None:
    """Move a recorded job's files into place; files that were moved before are passed over."""
    record = f"{root}/_commits/{job}.json"
    where, path = opened(root)
    with ThreadPoolExecutor(MOVES_AT_ONCE) as pool:
        for folder in read_json(record) or []:                   # one task's names at a time
            source = opened(folder)[1]
            list(pool.map(lambda name: where.move(f"{source}/{name}", f"{path}/{name}"), names(folder)))
    delete_folder(f"{root}/_staging/{job}")
    delete_file(record)


def finish_commits(root: str) -> int:
    """Publish what committed jobs left unfinished; the number of such jobs.  Not while a job is committing."""
    waiting = [n.removesuffix(".json") for n in names(f"{root}/_commits") if not n.startswith(".")]
    for job in waiting:
        _publish(root, job)
    return len(waiting)


class FrameFileSink(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return FRAME_FILE_SCHEMA

    def writer(self, schema, overwrite: bool) -> FrameFileWriter:
        return FrameFileWriter(self.options["path"])


def write_frame_files(frames: DataFrame, path: str) -> None:
    """One file a row of ``frames`` under ``path``."""
    spark: SparkSession = frames.sparkSession
    ship_package(spark)
    spark.dataSource.register(FrameFileSink)
    frames.selectExpr("filename", "cast(height as int) height", "cast(width as int) width", "cast(nChannels as int) nChannels",
                      "data").write.format(FORMAT).mode("append").save(path)


def read_output_files(spark: SparkSession, path: str) -> DataFrame:
    """``binaryFile`` rows of the published files; staging folders and records are not seen."""
    schema = "path string, modificationTime timestamp, length long, content binary"
    return spark.read.format("binaryFile").schema(schema).option("pathGlobFilter", "*.png").load(path)
