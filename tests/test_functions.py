"""Scalar expressions: the semantic traps of SURVEY 1.4 that live in one column."""

import base64
import datetime as dt

from pyspark.sql import functions as F

from ember import functions as X


def one(spark, expr, rows, schema):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(expr).collect()]


def test_age_group_boundaries(spark):  # T5
    ages = [0, 18, 19, 35, 36, 50, 51, None]
    got = one(spark, X.age_group("a"), [(a,) for a in ages], "a int")
    assert got == ["0-18", "0-18", "18-35", "18-35", "35-50", "35-50", "50+", None]


def test_two_decimals_rounds_binary_value(spark):  # T9
    vals = [0.125, 2.675, 1.005, 0.375, 3.0, 12345.678]
    got = one(spark, X.two_decimals("x"), [(v,) for v in vals], "x double")
    assert got == [f"{v:.2f}" for v in vals]


def test_or_na(spark):  # T7
    got = one(spark, X.or_na(X.two_decimals("x")), [(None,), (1.5,)], "x double")
    assert got == ["NA", "1.50"]


def test_field_past_end_is_null_and_pipe_is_literal(spark):  # T16, T17
    rows = [("1,Toy Story,Animation|Comedy",), ("2,Short",)]
    df = spark.createDataFrame(rows, "value string")
    got = df.select(X.field("value", 2), X.split_list(X.field("value", 2), "|")).collect()
    assert got[0][0] == "Animation|Comedy" and got[0][1] == ["Animation", "Comedy"]
    assert got[1][0] is None and got[1][1] is None


def test_epoch_seconds_year_utc(spark):  # T8
    got = one(spark, X.epoch_seconds_to_year("s"), [(978307199,), (978307200,)], "s bigint")
    assert got == [2000, 2001]


def test_epoch_millis_ntz_truncates(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, 0, 0, 7, 179575),)], "t timestamp_ntz")
    assert df.select(X.epoch_millis("t")).first()[0] == 1704067207179


def test_frame_filename_pads_and_keeps_long_numbers(spark):  # T21
    got = one(spark, X.frame_filename("c", "n"), [("cam1", 7), ("cam1", 1000000)], "c string, n int")
    assert got == ["cam1_000007.png", "cam1_1000000.png"]


def test_base64_encode_has_no_line_breaks(spark):  # T24
    payload = bytes(range(200))
    got = one(spark, X.b64encode("b"), [(payload,)], "b binary")[0]
    assert got == base64.b64encode(payload).decode()


def test_base64_validity_matches_lenient_decoder(spark):  # T23
    import binascii

    cases = ["aGVsbG8=", "aGVsbG8", "abc", "aGVs\nbG8=", "aGVs*bG8=", "", "aGVsbG8==", "ab=c",
             "aGVsbG8=aGVs", "a===", "ab==cd==", "aGVsbG8=x", "=aGVs", "a=GVs", "ab=cd", "abc=d",
             "ab c=", "====", "abcd====", "YQ", "YQ=", "YQ==", "Y", "Zm9v\r\nYmFy",
             "aGV*bG8=", "aGVzbG8*", "aGV=bG8=", "a*bc", "ab*=", "abc\n", "Zm9vYmFy", "Zm9vYg==", "Zm9vYmE=",
             "Zm9v YmFy", "Zm9=", "Zg=="]

    def lenient(s):
        try:
            base64.b64decode(s)
            return True
        except (binascii.Error, ValueError):
            return False

    got = one(spark, X.is_valid_base64("s"), [(c,) for c in cases] + [(None,)], "s string")
    assert got == [lenient(c) for c in cases] + [False]


def test_parse_timestamp_tolerates_garbage(spark):  # T15
    got = one(spark, X.parse_timestamp("s"), [("2024-03-01 10:00:00",), ("not a date",), (None,)], "s string")
    assert got[0] == dt.datetime(2024, 3, 1, 10, 0) and got[1] is None and got[2] is None


def test_to_int_is_ansi_safe(spark):  # T14
    got = one(spark, X.to_int("s"), [("4",), ("1.0",), ("x",), (None,)], "s string")
    assert got == [4, None, None, None]


def test_octets_counts_utf8_bytes(spark):
    got = one(spark, X.octets("s"), [("héllo",), ("",)], "s string")
    assert got == [6, 0]


def test_base64_validity_property(spark):  # T23, randomized against Python's decoder
    import binascii

    from hypothesis import given, settings
    from hypothesis import strategies as st

    alphabet = st.sampled_from(list("AZaz09+/") + ["=", "=", "*", "\n", " ", "-"])
    strings = st.lists(st.text(alphabet=alphabet, max_size=14), min_size=200, max_size=200)

    def lenient(s):
        try:
            base64.b64decode(s)
            return True
        except (binascii.Error, ValueError):
            return False

    @settings(max_examples=3, deadline=None)
    @given(strings)
    def check(batch):
        got = one(spark, X.is_valid_base64("s"), [(c,) for c in batch], "s string")
        assert got == [lenient(c) for c in batch]

    check()
