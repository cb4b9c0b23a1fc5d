import datetime

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from tessera.functions import scalar as S


def java_hash(s: str) -> int:
    h = 0
    b = s.encode("utf-16-be")
    for i in range(0, len(b), 2):
        h = (h * 31 + int.from_bytes(b[i:i + 2], "big")) & 0xFFFFFFFF
    return h - (1 << 32) if h >= (1 << 31) else h


def java_salted(s: str, n: int) -> str:
    h = java_hash(s)
    r = abs(int(h - n * int(h / n)))  # Java remainder keeps the dividend's sign
    salt = str(r)
    return (salt if len(salt) >= 4 else salt.rjust(4, "0")) + ":" + s


@settings(max_examples=10, deadline=None)
@given(st.lists(st.text(max_size=12), min_size=1, max_size=20))
def test_java_hash_matches_jvm_rule(spark, words):
    df = spark.createDataFrame([(w,) for w in words], "w string")
    got = [r[0] for r in df.select(S.java_string_hash("w")).collect()]
    assert got == [java_hash(w) for w in words]


def test_java_hash_known_values(spark):
    df = spark.createDataFrame([("abc",), ("",), ("é",), ("😀x",), (None,)], "w string")
    got = [r[0] for r in df.select(S.java_string_hash("w")).collect()]
    assert got == [96354, 0, 233, 54959989, None]


@pytest.mark.parametrize("n", [1, 6, 7, 12345])
def test_salted_row_key(spark, n):
    words = ["1", "12", "Customer#000000001", "zz top", "ß"]
    df = spark.createDataFrame([(w,) for w in words], "w string")
    got = [r[0] for r in df.select(S.salted_row_key("w", n)).collect()]
    assert got == [java_salted(w, n) for w in words]


def test_salt_zero_means_no_salt(spark):
    df = spark.createDataFrame([("42",)], "w string")
    assert df.select(S.salted_row_key("w", 0)).first()[0] == "42"


def test_jvm_trim_strips_control_characters(spark):
    df = spark.createDataFrame([("\t\n Cuba \x01",), ("  ",), (None,)], "w string")
    got = [r[0] for r in df.select(S.jvm_trim("w")).collect()]
    assert got == ["Cuba", "", None]


def test_time_patterns(spark):
    df = spark.createDataFrame([(datetime.datetime(2024, 3, 5, 7, 8, 9),)], "ts timestamp_ntz")
    r = df.select(S.ts_to_int("ts", "YYYYMM"), S.history_key(F.lit(12), "ts"),
                  S.parse_date(F.lit("2024-03-05"), "yyyy-MM-dd")).first()
    assert r[0] == 202403
    assert r[1] == "12:20240305070809"
    assert r[2] == datetime.datetime(2024, 3, 5)


def test_parse_date_raises_on_bad_text(spark):
    df = spark.createDataFrame([("not a date",)], "t string")
    with pytest.raises(Exception):
        df.select(S.parse_date("t", "yyyy-MM-dd")).collect()


def test_equals_ignore_case_and_nulls(spark):
    df = spark.createDataFrame([("Abc", "aBC"), ("a", None), ("x", "y")], "a string, b string")
    assert [r[0] for r in df.select(S.equals_ignore_case("a", "b")).collect()] == [True, False, False]


def test_split_names():
    assert S.split_names("a, b,,null") == ["a", "b", "null"]
    assert S.split_names(None) is None
    assert S.split_names("") is None


@pytest.mark.parametrize(("old", "want"), [
    ("YYYY-MM-dd", "2024-03-05"), ("yy", "24"), ("G", "AD"), ("GGGG", "AD"), ("M MM MMM MMMM MMMMMM", "3 03 Mar March March"),
    ("E EEE EEEE", "Tue Tue Tuesday"), ("d dd", "5 05"), ("D DDD", "65 065"), ("a aaa", "PM PM"), ("K h H k", "2 2 14 14"),
    ("HH:mm:ss.SSS", "14:07:09.120"), ("Z ZZ", "+0000 +00:00"), ("ZZZ", "UTC"), ("z", "UTC"), ("''", "'"), ("''''", "''"),
    ("h 'o''clock' a", "2 o'clock PM"), ("'at'HH", "at14"), ("''HH''", "'14'"), ("[yyyy]{MM}#dd", "[2024]{03}#05"),
    ("'a'[dd", "a[05"), ("yyyy年MM月", "2024年03月"), ("'Y'YYYY", "Y2024"),
])
def test_date_patterns_by_letter(spark, old, want):
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    try:
        at = F.to_timestamp(F.lit("2024-03-05 14:07:09.12"))
        assert spark.range(1).select(F.date_format(at, S.translate_joda_pattern(old))).first()[0] == want
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


@pytest.mark.parametrize("old", ["C", "xxxx", "ww", "e", "ddd", "HHH", "DDDD", "S" * 10, "yyyyyyy", "Q", "V", "b", "'open", "yyyy''' x"])
def test_date_patterns_without_counterpart(old):
    with pytest.raises(ValueError):
        S.translate_joda_pattern(old)


def test_dates_parse_by_old_patterns(spark):
    df = spark.createDataFrame([("2024-03-05T14:07 [x]",)], "t string")
    assert df.select(S.parse_date("t", "YYYY-MM-dd'T'HH:mm ['x']")).first()[0] == datetime.datetime(2024, 3, 5, 14, 7)
