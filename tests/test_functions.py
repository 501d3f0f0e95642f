import pytest
from pyspark.sql import functions as F

from ledgerlens.functions import (
    hex_byte_count,
    is_int_text,
    is_truthy_text,
    label_to_ym,
    month_label,
    squash_spaces,
    strict_int,
    truncate_to_long,
    wei,
)


def one(spark, col, value, dtype="string"):
    return spark.createDataFrame([(value,)], f"x {dtype}").select(col(F.col("x")).alias("r")).first()["r"]


@pytest.mark.parametrize(
    "text,ok",
    [
        ("100", True), (" 1_03 ", True), ("+7", True), ("-3", True), ("007", True),
        ("5.0", False), ("1e3", False), ("12x", False), ("", False), ("1__0", False),
        ("_1", False), ("1_", False), (None, False), ("block_number", False),
    ],
)
def test_integer_probe_matches_python_int(spark, text, ok):
    assert one(spark, is_int_text, text) is ok
    if text is not None:
        try:
            int(text)
            py_ok = True
        except ValueError:
            py_ok = False
        assert py_ok is ok


def test_strict_int_parses_and_fails_loud(spark):
    assert one(spark, lambda c: strict_int(c, "bigint"), " 1_03 ") == 103
    assert str(one(spark, wei, "84155363699941767867374641")) == "84155363699941767867374641"
    with pytest.raises(Exception, match="malformed"):
        one(spark, lambda c: strict_int(c, "bigint", "gas"), "21000.9")


def test_float_text_truncates_like_int_of_float(spark):
    assert one(spark, lambda c: truncate_to_long(c.cast("double")), "21000.9") == 21000
    assert one(spark, lambda c: truncate_to_long(c.cast("double")), "-2.7") == -2


@pytest.mark.parametrize(
    "ts,label",
    [(1438918233, "08-2015"), (1441065599, "08-2015"), (1441065600, "09-2015"), (-1, "12-1969")],
)
def test_month_label_is_utc(spark, ts, label):
    assert one(spark, month_label, ts, "bigint") == label


def test_month_label_ignores_session_zone(spark):
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
        assert one(spark, month_label, 1441065600, "bigint") == "09-2015"
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_label_reformat(spark):
    assert one(spark, label_to_ym, "02-2018") == "2018-02"


@pytest.mark.parametrize("h,b", [("0x" + "ab" * 32, 32.0), ("0x", 0.0), ("", -1.0), ("0x" + "c" * 512, 256.0)])
def test_hex_byte_count(spark, h, b):
    assert one(spark, hex_byte_count, h) == b


def test_text_helpers(spark):
    assert one(spark, squash_spaces, "Fake ICO") == "FakeICO"
    assert one(spark, is_truthy_text, "") is False
    assert one(spark, is_truthy_text, None) is False
    assert one(spark, is_truthy_text, "Phishing") is True
