"""Tables kept dealt by a key, so that joins and groupings on it move no rows.

Facts that are joined on the same key again and again (items, reviews and
orders on the order) are written once as Parquet tables of equally many
buckets of that key.  A join or a grouping by the key then reads bucket by
bucket: Spark plans it without an exchange, and a look-up of one key reads
one bucket.

A bucket is never larger than its keys are, and a bucketed scan is not split
at run time.  So keys that hold a bucket's fair share of any table (rows /
buckets or more: at most ``buckets`` keys a table) and null keys are kept
apart, in plain tables with the same columns.  The same keys are apart in all
tables, so work that stays within a key is done on both parts and unioned
(``within_keys``); the apart rows take Spark's ordinary joins, which may split
them.

Defined cases: null keys are kept and, as in any equality join, match nothing;
equal rows are kept; an empty table stays empty with its columns; keys of
different types are refused, because they would be dealt differently.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ember.session import shared_dir
from ember.storage import written


class DealtTables:
    """Tables of one key: ``cold`` bucketed, ``apart`` plain."""

    def __init__(self, spark: SparkSession, key: str, buckets: int):
        self.spark, self.key, self.buckets = spark, key, buckets
        self.cold: dict[str, DataFrame] = {}
        self.apart: dict[str, DataFrame] = {}
        self.names: dict[str, str] = {}

    def table(self, name: str) -> DataFrame:
        """All rows of a table."""
        return self.cold[name].unionByName(self.apart[name])

    def within_keys(self, work: Callable[[Mapping[str, DataFrame]], DataFrame]) -> DataFrame:
        """``work`` on the tables, where no result row needs rows of two keys."""
        return work(self.cold).unionByName(work(self.apart))

    def lookup(self, name: str, value) -> DataFrame:
        """Rows of one key: one bucket and the rows apart are read."""
        return self.table(name).where(F.col(self.key) == F.lit(value))

    def drop(self) -> None:
        """Forget the tables; their files stay in the shared folder."""
        for name in self.names.values():
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")


def hot_keys(tables: Mapping[str, DataFrame], key: str, buckets: int) -> DataFrame:
    """Keys with a bucket's fair share of the rows of any table."""
    found = None
    for rows in tables.values():
        counts = rows.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
        total = counts.agg(F.sum("_n")).scalar()
        hot = counts.where(F.col(key).isNotNull() & (F.col("_n") > 1)
                           & (F.col("_n") * F.lit(buckets) >= total)).select(key)
        found = hot if found is None else found.unionByName(hot)
    return found.distinct()


def deal(tables: Mapping[str, DataFrame], key: str, *, buckets: int | None = None) -> DealtTables:
    """Write ``tables``, which all have the column ``key``, dealt by it.

    ``buckets`` is the session's number of shuffle partitions unless given, so
    it follows the input size that the session was set up for.
    """
    types = {name: rows.schema[key].dataType for name, rows in tables.items()}
    if len(set(types.values())) != 1:
        raise ValueError(f"keys of different types: {types}")
    spark = next(iter(tables.values())).sparkSession
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = DealtTables(spark, key, buckets)
    hot = written(hot_keys(tables, key, buckets), "dealt-hot")
    for name, rows in tables.items():
        dealt.names[name] = f"dealt_{name}_{uuid.uuid4().hex[:12]}"
        (rows.where(F.col(key).isNotNull()).join(hot, key, "left_anti").select(rows.columns)
         .repartition(buckets, key)                               # one file a bucket
         .write.format("parquet").bucketBy(buckets, key).sortBy(key)
         .option("path", shared_dir(spark, f"dealt-{name}")).saveAsTable(dealt.names[name]))
        dealt.cold[name] = spark.table(dealt.names[name])
        dealt.apart[name] = written(
            rows.join(hot, key, "left_semi").select(rows.columns).unionByName(rows.where(F.col(key).isNull())),
            f"apart-{name}")
    return dealt
