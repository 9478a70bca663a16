"""Session set-up and the shared scratch location.

``build_session`` is what tests and ``bench.py`` use; library functions never
create a session themselves, they take the caller's one.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job of this library relies on.  They are plain Spark
# settings; a cluster may override the sizes, not the semantics.
DEFAULT_CONF: dict[str, str] = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Spark 4.1 wraps base64 output every 76 characters unless told not to.
    "spark.sql.chunkBase64String.enabled": "false",
    # A hot join key is split even where an aggregation above relies on the join's partitioning.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Arrow batches are bounded by bytes: many small rows or a few VGA frames.
    "spark.sql.execution.arrow.maxBytesPerBatch": "64m",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # Worker-side numpy must not oversubscribe executor cores.
    "spark.executorEnv.OMP_NUM_THREADS": "1",
    "spark.executorEnv.MKL_NUM_THREADS": "1",
    "spark.executorEnv.OPENBLAS_NUM_THREADS": "1",
}


MiB = 1 << 20
GiB = 1 << 30


def cluster_conf(input_bytes: int, *, cores: int | None = None, target_partition_bytes: int = 256 * MiB) -> dict[str, str]:
    """Sizing for a large run: shuffle partitions from the input size.

    Each shuffle starts with about one partition per ``target_partition_bytes``
    of input (never fewer than 2x the cores), and AQE coalesces small ones to
    the same advisory size, so a partition fits an executor task at any scale
    instead of Spark's fixed default of 200.  Scans split files at 256 MiB.
    """
    parts = max(200, -(-input_bytes // target_partition_bytes))
    if cores:
        parts = max(parts, 2 * cores)
    return {
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(parts),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.files.maxPartitionBytes": str(256 * MiB),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * target_partition_bytes),
    }


ROWS_PER_TASK = 1 << 19        # rows that one task sorts for a join and pre-aggregates, about 150 MB


def session_for(spark: SparkSession, rows: int) -> SparkSession:
    """``spark``, or a session with its settings and more shuffle partitions if ``rows`` need them.

    Spark merges shuffle partitions into as few as there are cores, so a
    task's sorts and hash tables would grow with the input.  Beyond
    ``ROWS_PER_TASK`` rows for each of those, the work gets a session of its
    own with a partition for as many rows and without that merging; skewed
    joins are split as before.  ``rows`` sets the number of tasks only.
    """
    tasks = -(-rows // ROWS_PER_TASK)
    planned = int(spark.conf.get("spark.sql.shuffle.partitions"))
    if tasks <= min(planned, spark.sparkContext.defaultParallelism):
        return spark
    sized = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if sized.conf.isModifiable(key):
            sized.conf.set(key, value)
    sized.conf.set("spark.sql.shuffle.partitions", str(max(tasks, planned)))
    sized.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    return sized


# Maven coordinate of Spark's Kafka connector for this Spark line (Scala 2.13).
KAFKA_PACKAGE = "org.apache.spark:spark-sql-kafka-0-10_2.13:4.1.0"


def build_session(
    app_name: str = "ember",
    master: str | None = None,
    conf: dict[str, str] | None = None,
    *,
    packages: list[str] | None = None,
    log_level: str = "WARN",
) -> SparkSession:
    """Create (or return) a session with the library defaults applied.

    ``packages`` adds Maven coordinates (e.g. ``[KAFKA_PACKAGE]`` for the Kafka
    source and sink); ``conf`` overrides any default, e.g. memory sizes or
    ``cluster_conf(...)``.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    merged = dict(DEFAULT_CONF)
    if packages:
        merged["spark.jars.packages"] = ",".join(packages)
    merged.update(conf or {})
    for key, value in merged.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel(log_level)
    return spark


def local_test_session(cores: int | str = "*", shuffle_partitions: int = 8,
                       conf: dict[str, str] | None = None) -> SparkSession:
    """Session for tests and local benchmarks (``local[N]``)."""
    merged = {
        "spark.sql.shuffle.partitions": str(shuffle_partitions),
        "spark.driver.memory": os.environ.get("EMBER_DRIVER_MEMORY", "16g"),
    }
    merged.update(conf or {})
    return build_session(master=f"local[{cores}]", conf=merged)


def shared_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder under the cluster's shared checkpoint directory.

    The location comes from ``spark.checkpoint.dir`` (or the context's
    checkpoint dir).  Only when neither is set and the master is local -- a
    test session -- do we create one under the system temp folder and
    register it, so later calls and ``DataFrame.checkpoint()`` use the same
    place; on a cluster a missing setting is an error, never a local folder.
    """
    base = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not base:
        base = spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach "
                               "(HDFS, S3, ...): stream checkpoints and staged data live there")
        base = tempfile.mkdtemp(prefix="ember-ckpt-")
        spark.sparkContext.setCheckpointDir(base)
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``ember`` importable in Python workers (the ``--py-files`` way).

    Operators that run Python on executors (``mapInPandas``) pickle functions
    of this package by reference, so workers must be able to import it.  The
    package is zipped once per application and added with ``addPyFile``;
    Spark then serves it to every executor, including ones started later.
    """
    import zipfile

    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 -- e.g. a Spark Connect session: ship the package with the job instead
        return
    app = sc.applicationId
    if app in _SHIPPED:
        return
    pkg = os.path.dirname(os.path.abspath(__file__))
    root = os.path.dirname(pkg)
    out = os.path.join(tempfile.mkdtemp(prefix="ember-pyfiles-"), "ember.zip")
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as zf:
        for dirpath, _, files in os.walk(pkg):
            for name in files:
                if name.endswith(".py"):
                    full = os.path.join(dirpath, name)
                    zf.write(full, os.path.relpath(full, root))
    sc.addPyFile(out)
    _SHIPPED.add(app)
