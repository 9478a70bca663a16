"""Packets: encode/decode, malformed input (T18), validator rules (V1), latest per key."""

import base64
import json


from ember.operators import packets as P
from ember.operators import quality as Q
from ember.schemas import PACKET_CONSUMER, PACKET_FULL


def good_packet(**over):
    pk = {
        "camera_id": "cam1", "timestamp_ms": 1700000000000, "frame_number": 3, "width": 640, "height": 480,
        "encoding": "JPEG", "frame_data": base64.b64encode(b"x" * 100).decode(), "quality": 85,
        "metadata": {"source": "camera_simulation", "created_at": "2024-01-01T00:00:00"},
    }
    pk.update(over)
    return pk


def test_encode_then_decode_roundtrip(spark):
    rows = [("cam1", 1700000000000, 1, 640, 480, "JPEG", bytes(range(100)), 85)]
    df = spark.createDataFrame(
        rows, "camera_id string, timestamp_ms bigint, frame_number int, width int, height int, "
              "encoding string, frame_bytes binary, quality int")
    enc = P.encode_packets(df)
    k, v = enc.first()
    assert k == "cam1"
    obj = json.loads(v)
    assert list(obj)[:3] == ["camera_id", "timestamp_ms", "frame_number"]
    assert base64.b64decode(obj["frame_data"]) == bytes(range(100))
    dec = P.decode_packets(enc, "value", PACKET_FULL).first()
    assert dec["frame_number"] == 1 and dec["quality"] == 85


def test_decode_malformed_and_partial(spark):  # T18
    values = [
        json.dumps(good_packet()),
        "{not json",
        json.dumps(good_packet(frame_number="seven")),
        json.dumps(dict(good_packet(), extra_field=1)),
        None,
    ]
    df = spark.createDataFrame([(v,) for v in values], "value string")
    out = P.decode_packets(df, "value", PACKET_CONSUMER, corrupt_col="_corrupt").collect()
    assert out[0]["camera_id"] == "cam1" and out[0]["_corrupt"] is None
    assert out[1]["camera_id"] is None and out[1]["_corrupt"] == "{not json"
    assert out[2]["frame_number"] is None and out[2]["camera_id"] == "cam1"
    assert out[3]["frame_number"] == 3
    assert out[4]["camera_id"] is None


def test_validator_rules_in_order(spark):  # V1
    required = ["camera_id", "timestamp_ms", "frame_number", "width", "height", "encoding", "frame_data", "quality"]
    cases = []
    for f in required:
        pk = good_packet()
        del pk[f]
        cases.append((pk, f"Missing field: {f}"))
    two_missing = good_packet()
    del two_missing["height"], two_missing["camera_id"]
    cases += [
        (two_missing, "Missing field: camera_id"),
        (good_packet(timestamp_ms=1.5), "timestamp_ms must be integer"),
        (good_packet(timestamp_ms="1700000000000"), "timestamp_ms must be integer"),
        (good_packet(quality=-1), "quality must be 0-100"),
        (good_packet(quality=0), "Valid packet"),
        (good_packet(quality=100), "Valid packet"),
        (good_packet(quality=101), "quality must be 0-100"),
        (good_packet(width=0), "Invalid frame dimensions"),
        (good_packet(height=-3), "Invalid frame dimensions"),
        (good_packet(frame_data="abc"), "frame_data is not valid base64"),
        (good_packet(frame_data="aGVs*bG8="), "Valid packet"),
        (good_packet(frame_data=12), "frame_data is not valid base64"),
        (good_packet(camera_id=None), "Valid packet"),
        (good_packet(), "Valid packet"),
    ]
    df = spark.createDataFrame([(i, json.dumps(pk)) for i, (pk, _) in enumerate(cases)], "i int, value string")
    got = {r["i"]: r["message"] for r in Q.validate_packets(df, "value", keep=("i",)).collect()}
    for i, (_, msg) in enumerate(cases):
        assert got[i] == msg, (i, cases[i][0], got[i])


def test_validator_malformed_json_is_missing_first_field(spark):
    df = spark.createDataFrame([("{oops",), ("[1,2]",)], "value string")
    got = [r["message"] for r in Q.validate_packets(df).collect()]
    assert got == ["Missing field: camera_id", "Missing field: camera_id"]


def test_latest_frames_last_write_wins(spark):  # W9, T21
    rows = [("cam1", 1, 100, 10), ("cam1", 1, 200, 11), ("cam1", 2, 150, 12), ("cam2", 1, 100, 13),
            ("cam1", 1, 200, 9)]
    df = spark.createDataFrame(rows, "camera_id string, frame_number int, ts bigint, event_id bigint")
    got = {(r[0], r[1]): r[2] for r in P.latest_frames(df).collect()}
    assert got == {("cam1", 1): 11, ("cam1", 2): 12, ("cam2", 1): 13}


def test_kafka_writer_options():  # K8
    from ember.streaming import kafka_writer_options

    opts = kafka_writer_options("b1:9092,b2:9092", "frames")
    assert opts["kafka.compression.type"] == "gzip" and opts["kafka.acks"] == "all"
    assert opts["kafka.batch.size"] == "16384" and opts["kafka.linger.ms"] == "10"
    assert opts["kafka.retries"] == "3" and opts["topic"] == "frames"


def test_frames_to_packets_roundtrip(spark):  # C14, X19, X20
    import numpy as np

    from ember.streaming.frames import FRAME_PACKET, packet_frames

    frame = np.arange(2 * 3 * 3, dtype=np.uint8).reshape(2, 3, 3)
    df = spark.createDataFrame([("cam1", 4, 2, 3, frame.tobytes())],
                               "camera_id string, frame_number int, height int, width int, data binary")
    msg = P.frames_to_packets(df).first()
    obj = json.loads(msg["value"])
    assert msg["key"] == "cam1" and list(obj) == [
        "camera_id", "timestamp_ms", "frame_number", "width", "height", "encoding", "frame_data", "quality", "metadata"]
    assert obj["metadata"]["source"] == "camera_simulation" and "T" in obj["metadata"]["created_at"]
    assert isinstance(obj["timestamp_ms"], int) and obj["quality"] == 85
    back = packet_frames(P.decode_packets(spark.createDataFrame([msg]), "value", FRAME_PACKET)).first()
    assert bytes(back["data"]) == frame.tobytes() and (back["height"], back["width"]) == (2, 3)
    assert Q.validate_packets(spark.createDataFrame([msg])).first()["message"] == "Valid packet"


def test_in_camera_order(spark):  # W7
    rows = [("b", 2), ("a", 3), ("b", 1), ("a", 1), ("a", 2)]
    df = spark.createDataFrame(rows, "camera_id string, frame_number int")
    parts = P.in_camera_order(df).rdd.glom().collect()
    assert [tuple(r) for p in parts for r in p] == sorted(rows)


def test_in_camera_order_cuts_a_busy_camera(spark):  # W7
    df = spark.range(4000).selectExpr("CASE WHEN id % 3 = 0 THEN 'busy' ELSE concat('c', id % 50) END AS camera_id",
                                      "cast(id as int) AS frame_number").repartition(5)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        parts = [p for p in P.in_camera_order(df).rdd.glom().collect() if p]
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    flat = [tuple(r) for p in parts for r in p]
    assert flat == sorted(flat) and len(flat) == 4000
    assert sum(any(r["camera_id"] == "busy" for r in p) for p in parts) > 1


def test_a_packet_of_any_size_is_read(spark):  # X15, V1
    big = good_packet(frame_data="QUJD" * 8_500_000)
    df = spark.createDataFrame([(json.dumps(big),)], "value string")
    out = P.decode_packets(df, "value", PACKET_CONSUMER, corrupt_col="_corrupt").selectExpr(
        "camera_id", "length(frame_data) AS n", "_corrupt_reason").first()
    assert tuple(out) == ("cam1", 34_000_000, None)
    assert Q.validate_packets(df).first()["message"] == "Valid packet"


def test_corrupt_values_have_a_reason(spark):  # W1
    values = [None, "[]", "123", "null", '"text"', "{broken", '{"camera_id":"a"', "{}", '{"camera_id": null}', json.dumps(good_packet())]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, value string")
    out = P.decode_packets(df, "value", PACKET_CONSUMER, keep=("i",), corrupt_col="_corrupt").orderBy("i").collect()
    assert [r["_corrupt_reason"] for r in out] == ["no value", *["not an object"] * 4, *["malformed"] * 2, None, None, None]
    assert [r["_corrupt"] for r in out] == [*values[:7], None, None, None]


def test_kafka_source_options():  # S11, W3, W4
    from ember.streaming import kafka_source_options

    opts = kafka_source_options("b1:9092", "image-frames")
    assert opts == {"kafka.bootstrap.servers": "b1:9092", "subscribe": "image-frames",
                    "startingOffsets": "latest"}
    uncapped = kafka_source_options("b1:9092", "t", max_offsets_per_trigger=None, starting_offsets="earliest")
    assert "maxOffsetsPerTrigger" not in uncapped and uncapped["startingOffsets"] == "earliest"
    assert kafka_source_options("b", "t", min_partitions=64)["minPartitions"] == "64"
