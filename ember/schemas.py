"""Declared schemas (no inference pass over the data)."""

from pyspark.sql import types as T

# Frame packet as the producer writes it: nine fields, one nested.
PACKET_FULL = T.StructType([
    T.StructField("camera_id", T.StringType()),
    T.StructField("timestamp_ms", T.LongType()),
    T.StructField("frame_number", T.IntegerType()),
    T.StructField("width", T.IntegerType()),
    T.StructField("height", T.IntegerType()),
    T.StructField("encoding", T.StringType()),
    T.StructField("frame_data", T.StringType()),
    T.StructField("quality", T.IntegerType()),
    T.StructField("metadata", T.StructType([
        T.StructField("source", T.StringType()),
        T.StructField("created_at", T.StringType()),
    ])),
])

# The consumer reads only four of the nine fields (column pruning in from_json).
PACKET_CONSUMER = T.StructType([
    T.StructField("camera_id", T.StringType()),
    T.StructField("timestamp_ms", T.LongType()),
    T.StructField("frame_number", T.IntegerType()),
    T.StructField("frame_data", T.StringType()),
])

# Fields a valid packet must carry, in the order they are checked.
REQUIRED_PACKET_FIELDS = (
    "camera_id", "timestamp_ms", "frame_number", "width", "height", "encoding", "frame_data", "quality",
)

# Kafka-shaped message rows (what the Kafka source yields, minus metadata).
MESSAGE = T.StructType([
    T.StructField("key", T.StringType()),
    T.StructField("value", T.StringType()),
    T.StructField("partition", T.IntegerType()),
])

# Text-file layouts of the ratings data set (comma separated, no header).
MOVIE_FIELDS = ("movie_id", "title", "genres")
RATING_FIELDS = ("user_id", "movie_id", "rating", "ts")
USER_FIELDS = ("user_id", "gender", "age", "occ_id")
OCCUPATION_FIELDS = ("occ_id", "occupation")

# Spark's image source schema, the frame representation of this library.
IMAGE = T.StructType([
    T.StructField("origin", T.StringType()),
    T.StructField("height", T.IntegerType()),
    T.StructField("width", T.IntegerType()),
    T.StructField("nChannels", T.IntegerType()),
    T.StructField("mode", T.IntegerType()),
    T.StructField("data", T.BinaryType()),
])
