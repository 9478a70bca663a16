"""A table kept up to date by merging: partial results in, one row a key out.

Every input (a rating file, a micro-batch) is added once under its own id as a
small Parquet *delta*; reading merges the base with the deltas since.  When the
deltas outgrow a share of the base they are folded into a new base, so a read
costs no more than the live keys and that share of them, however many inputs
there were, and folding costs each row a few rewrites in all.

``merge`` is any function that reduces rows to one a key and may be applied to
its own results: sums, counts, minima, bitmaps, the last write of a key.

The record ``table.json`` names the current files and replaces its predecessor in
one move: a reader sees the table before or after an input, never between.  An id
that was added before is passed over, so a replayed micro-batch or file counts
once; ids of folded inputs stay in a ledger of one small file each.  One writer
at a time.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ember.storage import delete_folder, folders, read_json, write_json

SLACK = 0.5                    # deltas are folded when they have so many rows a row of the base
LEAST_ROWS = 10_000            # ... and this many at least


class MergeTable:
    def __init__(self, spark: SparkSession, root: str, schema: str, merge: Callable[[DataFrame], DataFrame], *,
                 slack: float = SLACK, least_rows: int = LEAST_ROWS):
        self.spark, self.root, self.schema, self.merge = spark, root.rstrip("/"), schema, merge
        self.slack, self.least_rows = slack, least_rows

    def _record(self) -> dict:
        return read_json(f"{self.root}/table.json") or {"base": None, "base_rows": 0, "deltas": []}

    def _ledger(self, input_id: str) -> str:
        return f"{self.root}/ledger/{hashlib.sha256(input_id.encode()).hexdigest()}.json"

    def knows(self, input_id: str) -> bool:
        return any(d["input"] == input_id for d in self._record()["deltas"]) or read_json(self._ledger(input_id)) is not None

    def _write(self, rows: DataFrame, kind: str) -> tuple[str, int]:
        path = f"{self.root}/{kind}/{uuid.uuid4().hex[:16]}"
        names = self.spark.createDataFrame([], self.schema).columns
        self.merge(rows.select(*names)).select(*names).write.parquet(path)
        return path, self.spark.read.schema(self.schema).parquet(path).count()

    def add(self, input_id: str, rows: DataFrame) -> bool:
        """Merge ``rows`` in; False if an input of this id is in already."""
        if self.knows(input_id):
            return False
        path, n = self._write(rows, "delta")
        record = self._record()
        record["deltas"].append({"input": input_id, "path": path, "rows": n})
        write_json(f"{self.root}/table.json", record)
        if sum(d["rows"] for d in record["deltas"]) > max(self.least_rows, self.slack * record["base_rows"]):
            self.fold()
        return True

    def _parts(self) -> DataFrame:
        record = self._record()
        paths = [p for p in [record["base"], *(d["path"] for d in record["deltas"])] if p]
        if not paths:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*paths)

    def read(self) -> DataFrame:
        """One row a key."""
        return self.merge(self._parts())

    def fold(self) -> None:
        """Make base and deltas a new base; the old files stay for readers that began before, until ``vacuum``."""
        record = self._record()
        path, n = self._write(self._parts(), "base")
        for d in record["deltas"]:
            write_json(self._ledger(d["input"]), {"input": d["input"]})
        write_json(f"{self.root}/table.json", {"base": path, "base_rows": n, "deltas": []})

    def vacuum(self) -> int:
        """Delete files that the current record does not name; only when nothing reads an older state."""
        record = self._record()
        used = {p.rsplit("/", 1)[-1] for p in [record["base"], *(d["path"] for d in record["deltas"])] if p}
        gone = 0
        for kind in ("base", "delta"):
            for name in folders(f"{self.root}/{kind}"):
                if name not in used:
                    delete_folder(f"{self.root}/{kind}/{name}")
                    gone += 1
        return gone
