"""File sources: delimited text with quarantine, CSV, image frames.

All readers take declared layouts, so no inference pass runs over the data
unless asked for, and every parse is a JVM expression (``split``/``get``/
``try_cast``) rather than a Python function per line.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ember.schemas import MOVIE_FIELDS, OCCUPATION_FIELDS, RATING_FIELDS, USER_FIELDS


class QuarantineError(ValueError):
    """Raised by ``strict=True`` readers when a line does not parse."""


def _parts(sep: str) -> Column:
    return F.split(F.col("value"), re.escape(sep), -1)


def read_delimited_text(
    spark: SparkSession,
    paths: str | Sequence[str],
    fields: Sequence[tuple[str, str]],
    *,
    sep: str = ",",
    required: Sequence[str] | None = None,
    strict: bool = False,
    quoted: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """Lines -> typed columns, plus a quarantine of lines that do not parse.

    ``fields`` is ``[(name, spark_type), ...]`` by position.  The line is split
    on every separator with no quoting (T1): a separator inside a value shifts
    the later fields, and fields past the last declared one are ignored.  A
    short line gives NULL (``get``, T16) and a bad number gives NULL
    (``try_cast``); a line whose ``required`` field is NULL goes to the
    quarantine with a reason instead of failing the job (T2).
    ``strict=True`` raises when the quarantine is not empty.
    ``quoted=True`` uses the CSV reader, which honours double quotes.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    required = list(required) if required is not None else [n for n, _ in fields]
    if quoted:
        schema = T.StructType([T.StructField(n, T.StringType()) for n, _ in fields])
        raw = (spark.read.schema(schema).option("sep", sep).option("header", "false")
               .option("mode", "PERMISSIVE").csv(paths))
        raw = raw.withColumn("value", F.concat_ws(sep, *[F.coalesce(F.col(n), F.lit("")) for n, _ in fields]))
        typed = raw.select("value", *[F.col(n).try_cast(t).alias(n) for n, t in fields])
    else:
        raw = spark.read.text(paths)
        parts = _parts(sep)
        typed = raw.select("value", *[F.get(parts, i).try_cast(t).alias(n) for i, (n, t) in enumerate(fields)])

    reason = None
    for n in required:
        cond = F.col(n).isNull()
        text = F.lit(f"bad or missing field: {n}")
        reason = F.when(cond, text) if reason is None else reason.when(cond, text)
    if reason is None:
        reason = F.lit(None).cast("string")
    typed = typed.withColumn("_reason", reason)
    good = typed.where(F.col("_reason").isNull()).drop("_reason", "value")
    bad = typed.where(F.col("_reason").isNotNull()).select("value", F.col("_reason").alias("reason"))
    if strict and not bad.isEmpty():
        first = bad.first()
        raise QuarantineError(f"{first['reason']}: {first['value']!r}")
    return good, bad


# Positional layouts of the ratings data set (types as the reference applies them).
MOVIE_LAYOUT = list(zip(MOVIE_FIELDS, ("string", "string", "string")))
RATING_LAYOUT = list(zip(RATING_FIELDS, ("string", "string", "double", "bigint")))
USER_LAYOUT = list(zip(USER_FIELDS, ("string", "string", "int", "string")))
OCCUPATION_LAYOUT = list(zip(OCCUPATION_FIELDS, ("string", "string")))


def read_movies(spark, paths, **kw):
    """movies: (movie_id, title, genres); only the id is required unless ``required`` says more."""
    return read_delimited_text(spark, paths, MOVIE_LAYOUT, **{"required": ["movie_id"], **kw})


def read_ratings(spark, paths, **kw):
    """ratings: a question that reads the time adds ``ts`` to ``required``."""
    return read_delimited_text(spark, paths, RATING_LAYOUT, **{"required": ["user_id", "movie_id", "rating"], **kw})


def read_users(spark, paths, **kw):
    """users: a question that reads the age adds ``age`` to ``required``."""
    return read_delimited_text(spark, paths, USER_LAYOUT, **{"required": ["user_id"], **kw})


# What the questions about years and about ages cannot do without.
TIMED_RATING = ["user_id", "movie_id", "rating", "ts"]
AGED_USER = ["user_id", "age"]


def read_occupations(spark, paths, **kw):
    return read_delimited_text(spark, paths, OCCUPATION_LAYOUT, **kw)


def read_csv(
    spark: SparkSession,
    paths: str | Sequence[str],
    schema: T.StructType | str | None = None,
    *,
    sep: str = ";",
    header: bool | str = True,
    infer_schema: bool | str = False,
    corrupt_col: str | None = None,
) -> DataFrame:
    """Delimited file with a header.

    An explicit ``schema`` (recommended) skips the inference pass; string
    option values such as ``"True"`` are accepted as the reference passes
    them.  With ``corrupt_col`` malformed lines are kept there (PERMISSIVE).
    """
    reader = spark.read.option("sep", sep).option("header", str(header).lower())
    if schema is not None:
        if corrupt_col:
            st = schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)
            schema = T.StructType(list(st.fields) + [T.StructField(corrupt_col, T.StringType())])
            reader = reader.option("columnNameOfCorruptRecord", corrupt_col).option("mode", "PERMISSIVE")
        reader = reader.schema(schema)
    else:
        reader = reader.option("inferSchema", str(infer_schema).lower())
    return reader.csv(paths if isinstance(paths, str) else list(paths))


# Frame files: ``<camera>_<frame number>.<ext>``.
FRAME_NAME = r"([^/]+)_(\d+)\.[A-Za-z0-9]+$"


def read_frames(spark: SparkSession, path: str, *, drop_invalid: bool = False) -> DataFrame:
    """Image files of one or more sources, one row per frame.

    Decoding is Spark's ``image`` source (JVM ImageIO), giving BGR(A) bytes
    row-wise.  Undecodable files stay as rows with ``height = -1`` unless
    ``drop_invalid`` (F4 can then filter or count them).  Camera and frame
    number come from the file name; order frames by ``frame_number``.
    """
    img = spark.read.format("image").option("dropInvalid", str(drop_invalid).lower()).load(path)
    i = F.col("image")
    return img.select(
        i["origin"].alias("origin"),
        F.regexp_extract(i["origin"], FRAME_NAME, 1).alias("camera_id"),
        F.regexp_extract(i["origin"], FRAME_NAME, 2).try_cast("int").alias("frame_number"),
        i["height"].alias("height"), i["width"].alias("width"),
        i["nChannels"].alias("nChannels"), i["mode"].alias("mode"), i["data"].alias("data"),
    )


def image_rows(spark: SparkSession, path: str) -> DataFrame:
    """Raw ``image`` struct rows (for ``validate_images``)."""
    return spark.read.format("image").option("dropInvalid", "false").load(path)
