"""Answers that are kept up to date: partial results per input, merged in a ``MergeTable``.

A mean is kept as (sum, count), a distinct count as bitmaps of integer ids, a
rate as (first, last, count), a histogram as counts per bound.  All of them merge
with themselves, so a new file or micro-batch costs its own size, a replayed one
nothing, and reading costs one row a key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ember.functions import split_list
from ember.merge_table import MergeTable

# ------------------------------------------------------------ ratings means

PARTIALS = "kind string, key long, total double, n long, rows long"      # n: ratings that are not null


def _merged_partials(parts: DataFrame) -> DataFrame:
    return parts.groupBy("kind", "key").agg(*_sums())


def _sums() -> list[Column]:
    return [F.sum(c).alias(c) for c in ("total", "n", "rows")]


def rating_partials(ratings: DataFrame) -> DataFrame:
    """Sum and count of ``ratings(user_id, movie_id, rating)`` per movie and per user, in one pass over the rows."""
    each = F.explode(F.array(F.struct(F.lit("movie").alias("kind"), F.col("movie_id").cast("long").alias("key")),
                             F.struct(F.lit("user").alias("kind"), F.col("user_id").cast("long").alias("key"))))
    return ratings.select(each.alias("k"), F.col("rating").cast("double").alias("rating")).groupBy("k.kind", "k.key").agg(
        F.sum("rating").alias("total"), F.count("rating").alias("n"), F.count(F.lit(1)).alias("rows"))


class MaintainedRatings:
    """C1, C2 and C5 over all rating files added so far."""

    def __init__(self, spark: SparkSession, root: str):
        self.table = MergeTable(spark, root, PARTIALS, _merged_partials)

    def add(self, file_id: str, ratings: DataFrame) -> bool:
        """Merge a rating file in; False if it is in already."""
        return self.table.add(file_id, rating_partials(ratings))

    def _partials(self, kind: str, key: str) -> DataFrame:
        return self.table.read().filter(F.col("kind") == kind).select(F.col("key").alias(key), "total", "n", "rows")

    @staticmethod
    def _means(parts: DataFrame, *keys: str) -> DataFrame:
        return parts.groupBy(*keys).agg(*_sums()).select(
            *keys, F.round(F.try_divide("total", "n"), 2).alias("avg_rating"), F.col("rows").alias("total_ratings"))

    def movie_stats(self, movies: DataFrame) -> DataFrame:
        return self._means(self._partials("movie", "movie_id").join(movies, "movie_id"), "movie_id", "title")

    def genre_stats(self, movies: DataFrame, genre_col: str = "title", sep: str = " ") -> DataFrame:
        genres = movies.select("movie_id", F.explode(split_list(genre_col, sep)).alias("genre"))
        return self._means(self._partials("movie", "movie_id").join(genres, "movie_id"), "genre")

    def occupation_stats(self, users: DataFrame, occupations: DataFrame) -> DataFrame:
        per = self._partials("user", "user_id").join(users.select("user_id", "occ_id"), "user_id")
        per = per.groupBy("occ_id").agg(*_sums())
        return self._means(per.join(occupations, "occ_id"), "occ_id", "occupation").drop("occ_id")


# ---------------------------------------------------------- distinct counts

BITMAPS = "entity string, bucket long, ids binary, nulls long"


def _merged_bitmaps(parts: DataFrame) -> DataFrame:
    return parts.groupBy("entity", "bucket").agg(F.bitmap_or_agg("ids").alias("ids"), F.max("nulls").alias("nulls"))


def id_bitmaps(rows: DataFrame, col: str, entity: str) -> DataFrame:
    """The distinct ids of a column as bitmaps, one a bucket of 32,768 ids; a null is a value of its own (bucket null).

    Partial aggregation builds the bitmaps in the tasks: an id that holds a third of the rows is one bit in each.
    """
    v = F.col(col).cast("long")
    return rows.groupBy(F.bitmap_bucket_number(v).alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(v)).alias("ids"), F.max(v.isNull().cast("long")).alias("nulls")).select(
        F.lit(entity).alias("entity"), "bucket", "ids", "nulls")


class DistinctIds:
    """Exact distinct counts of integer ids over all inputs added so far."""

    def __init__(self, spark: SparkSession, root: str):
        self.table = MergeTable(spark, root, BITMAPS, _merged_bitmaps)

    def add(self, input_id: str, rows: DataFrame, columns: dict[str, str]) -> bool:
        """Merge the ids of ``columns`` (entity -> column of ``rows``) in; False if this input is in already."""
        parts = None
        for entity, col in columns.items():
            one = id_bitmaps(rows, col, entity)
            parts = one if parts is None else parts.unionByName(one)
        return self.table.add(input_id, parts)

    def counts(self) -> DataFrame:
        """(entity, n): distinct ids, null counted as one of them, as ``distinct().count()`` does."""
        return self.table.read().groupBy("entity").agg(
            F.sum(F.when(F.col("bucket").isNull(), F.col("nulls")).otherwise(F.bitmap_count("ids"))).alias("n"))

    def one_row(self, names: dict[str, str]) -> DataFrame:
        """One row with a column for each entity (column name -> entity); 0 where nothing was added."""
        n: list[Column] = [F.coalesce(F.max(F.when(F.col("entity") == e, F.col("n"))), F.lit(0)).cast("long").alias(c)
                           for c, e in names.items()]
        return self.counts().agg(*n)


# --------------------------------------------------------- running counters

RATES = "camera_id string, frames long, first_ms long, last_ms long"


def _merged_rates(parts: DataFrame) -> DataFrame:
    return parts.groupBy("camera_id").agg(
        F.sum("frames").alias("frames"), F.min("first_ms").alias("first_ms"), F.max("last_ms").alias("last_ms"))


def _bound(b: float) -> str:
    return "le_" + (str(int(b)) if float(b).is_integer() else str(b).replace(".", "_"))


class RunningCounters:
    """A19, W8, W11 of a running stream: frames per second by camera, silent cameras, latency histogram by stage.

    ``add_batch`` belongs into ``foreachBatch``; a batch that Spark runs again counts once.
    """

    def __init__(self, spark: SparkSession, root: str, bounds: Sequence[float] = ()):
        self.bounds = tuple(bounds)
        le = [_bound(b) for b in self.bounds]
        self.rates = MergeTable(spark, f"{root}/rates", RATES, _merged_rates)
        self.histogram = MergeTable(
            spark, f"{root}/histogram", "stage string, " + "".join(f"{c} long, " for c in le) + "le_inf long",
            lambda parts: parts.groupBy("stage").agg(*[F.sum(c).alias(c) for c in [*le, "le_inf"]]))

    def add_batch(self, batch: DataFrame, batch_id: int, *, camera: str = "camera_id", ms: str = "timestamp_ms",
                  stage: str | None = None, value: str | None = None) -> None:
        self.rates.add(f"batch-{batch_id}", batch.groupBy(F.col(camera).alias("camera_id")).agg(
            F.count(F.lit(1)).alias("frames"), F.min(ms).cast("long").alias("first_ms"), F.max(ms).cast("long").alias("last_ms")))
        if stage and value:
            self.histogram.add(f"batch-{batch_id}", batch.groupBy(F.col(stage).alias("stage")).agg(
                *[F.count_if(F.col(value) <= b).alias(_bound(b)) for b in self.bounds], F.count(F.lit(1)).alias("le_inf")))

    def throughput(self, digits: int = 6) -> DataFrame:
        """(camera_id, frames, fps) between each camera's first and last frame so far."""
        fps = F.try_divide(F.col("frames") * F.lit(1000.0), (F.col("last_ms") - F.col("first_ms")).cast("double"))
        return self.rates.read().select("camera_id", "frames", F.round(fps, digits).alias("fps"))

    def silent(self, now_ms: int | Column, for_ms: int) -> DataFrame:
        """Cameras whose last frame is more than ``for_ms`` before ``now_ms``, and for how long."""
        idle = F.lit(now_ms) - F.col("last_ms") if isinstance(now_ms, int) else now_ms - F.col("last_ms")
        return self.rates.read().select("camera_id", "last_ms", idle.alias("idle_ms")).filter(F.col("idle_ms") > for_ms)
