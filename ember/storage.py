"""Small files on the cluster's shared storage: commit records, listings, atomic publication.

Data goes through Spark's readers and writers; only records of a few kilobytes
(which files belong to a log, a table, a batch) are read and written here, by
the URI of the shared folder, with ``pyarrow.fs``.
"""

from __future__ import annotations

import json
import uuid

from pyarrow import fs
from pyspark.sql import DataFrame

from ember.session import shared_dir


def opened(uri: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a URI; Hadoop writes ``file:/x`` where others write ``file:///x``."""
    if uri.startswith("file:/") and not uri.startswith("file://"):
        uri = "file://" + uri[len("file:"):]
    return fs.FileSystem.from_uri(uri)


def names(uri: str) -> list[str]:
    """Names of the files in a folder, sorted; none if there is no folder."""
    where, path = opened(uri)
    found = where.get_file_info(fs.FileSelector(path, allow_not_found=True))
    return sorted(f.base_name for f in found if f.type == fs.FileType.File)


def read_json(uri: str):
    """The record, or None if there is none."""
    where, path = opened(uri)
    if where.get_file_info(path).type != fs.FileType.File:
        return None
    with where.open_input_file(path) as f:
        return json.loads(f.read())


def write_json(uri: str, record) -> None:
    """Write under a name of its own and move into place: a reader sees the old record or the whole new one."""
    where, path = opened(uri)
    folder, _, name = path.rpartition("/")
    where.create_dir(folder, recursive=True)
    part = f"{folder}/.{name}.{uuid.uuid4().hex[:12]}"
    with where.open_output_stream(part) as f:
        f.write(json.dumps(record).encode())
    where.move(part, path)


def folders(uri: str) -> list[str]:
    """Names of the folders in a folder, sorted."""
    where, path = opened(uri)
    found = where.get_file_info(fs.FileSelector(path, allow_not_found=True))
    return sorted(f.base_name for f in found if f.type == fs.FileType.Directory)


def files_below(uri: str, ending: str) -> list[str]:
    """Paths, at any depth, of the files whose name has this ending."""
    where, path = opened(uri)
    found = where.get_file_info(fs.FileSelector(path, recursive=True, allow_not_found=True))
    return sorted(f.path for f in found if f.type == fs.FileType.File and f.base_name.endswith(ending))


def delete_folder(uri: str) -> None:
    where, path = opened(uri)
    if where.get_file_info(path).type == fs.FileType.Directory:
        where.delete_dir(path)


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a fresh shared folder and read it back: later passes do not compute it again."""
    path = shared_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def delete_file(uri: str) -> None:
    where, path = opened(uri)
    if where.get_file_info(path).is_file:
        where.delete_file(path)
