from datetime import datetime

import pytest
from pyspark.sql import functions as F

from fleetgauge.functions import ranking, text, timing


def one(spark, column, **values):
    """The value of a column expression over one row of zone-free times or plain values."""
    rows = {k: F.lit(v.isoformat(sep=" ")).cast("timestamp_ntz") if isinstance(v, datetime) else F.lit(v)
            for k, v in values.items()}
    return spark.range(1).select(*(c.alias(k) for k, c in rows.items())).select(column.alias("r")).first().r


@pytest.mark.parametrize("start, end, hours, minutes, seconds", [
    (datetime(2024, 1, 1, 10, 59), datetime(2024, 1, 1, 11, 1), 1, 2, 120),
    (datetime(2024, 1, 1, 10, 0), datetime(2024, 1, 1, 10, 59, 59), 0, 59, 3599),
    (datetime(2023, 12, 31, 23, 59, 59), datetime(2024, 1, 1), 1, 1, 1),
    (datetime(2024, 3, 10, 1, 30), datetime(2024, 3, 10, 3, 30), 2, 120, 7200),
    (datetime(2024, 1, 2), datetime(2024, 1, 1, 23, 59, 59), -1, -1, -1),
])
def test_differences_count_boundaries(spark, start, end, hours, minutes, seconds):
    a, b = F.col("a"), F.col("b")
    assert one(spark, timing.hours_crossed(a, b), a=start, b=end) == hours
    assert one(spark, timing.minutes_crossed(a, b), a=start, b=end) == minutes
    assert one(spark, timing.seconds_crossed(a, b), a=start, b=end) == seconds


def test_millisecond_difference(spark):
    value = timing.millis_crossed(F.col("a"), F.col("b"))
    assert one(spark, value, a=datetime(2024, 1, 1, 0, 0, 59, 999000), b=datetime(2024, 1, 1, 0, 1, 0, 1999)) == 2


def test_times_do_not_depend_on_the_session_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        night = dict(a=datetime(2024, 3, 10, 0), b=datetime(2024, 3, 11, 0))
        assert one(spark, timing.hours_crossed(F.col("a"), F.col("b")), **night) == 24
        # 02:30 does not exist on this day in this zone.
        gap = datetime(2024, 3, 10, 2, 30, 7, 999999)
        assert one(spark, timing.to_second(F.col("a")), a=gap) == gap.replace(microsecond=0)
        assert one(spark, text.moment_text(F.col("a")), a=gap) == "03/10/2024 02:30:07"
        assert one(spark, text.moment_text(F.col("a").cast("timestamp_ntz")), a=None) is None
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


@pytest.mark.parametrize("date, time, expected", [
    (20240229, 235959, datetime(2024, 2, 29, 23, 59, 59)), (20240101, 5, datetime(2024, 1, 1, 0, 0, 5)),
    (20230229, 0, None), (0, 0, None), (20240101, 240000, None), (20240101, 6000, None), (20240101, 60, None),
    (None, 0, None), (20240101, None, None), (20241301, 0, None),
])
def test_integer_dates(spark, date, time, expected):
    value = timing.decode_date_time(F.col("d").cast("int"), F.col("t").cast("int"))
    assert one(spark, value, d=date, t=time) == expected


@pytest.mark.parametrize("encoded, seconds", [(0, 0), (59, 59), (100, 60), (10000, 3600), (1234559, 123 * 3600 + 45 * 60 + 59)])
def test_integer_durations(spark, encoded, seconds):
    assert one(spark, timing.decode_duration(F.col("d")), d=encoded) == seconds


def test_blank_texts_take_the_default(spark):
    for blank in (None, "", "  ", "\n\t "):
        assert one(spark, text.or_default(F.col("t").cast("string"), "(none)"), t=blank) == "(none)"
    assert one(spark, text.or_default(F.col("t"), "(none)"), t=" a ") == " a "


def test_statement_on_one_line_and_signature(spark):
    assert one(spark, text.one_line(F.col("t"), 5), t="a\r\nbcd") == "a  bc"
    assert one(spark, text.one_line(F.col("t"), None), t="a\nb" * 3000) == "a b" * 3000
    # SHA-1 of the bytes 61 00.
    assert one(spark, text.signature(F.col("t")), t="a") == "0A04B971B03DA607CE6C455184037B660CA89F78"


@pytest.mark.parametrize("value, shown", [("0", "0"), ("12.345", "12.345"), ("12.300", "12.3"), ("100", "100")])
def test_numbers_without_trailing_zeros(spark, value, shown):
    assert one(spark, text.plain_number(F.col("v").cast("decimal(20,3)"), 3), v=value) == shown


def test_details_show_labels_values_and_placeholders(spark):
    body = text.details([("A", F.col("a")), ("B", F.col("b").cast("string")), ("C", F.col("c"), "(unknown)")])
    assert one(spark, body, a=1, b=None, c="") == "A: 1\nB: \nC: (unknown)"


def test_top_per_key_is_the_same_for_any_number_of_slices(spark):
    # One key holds most rows, values are full of ties.
    rows = spark.range(5000).select(
        F.when(F.col("id") % 10 < 8, 0).otherwise(F.col("id") % 7).alias("k"), (F.col("id") * 31 % 50).alias("v"), "id")
    expected = {}
    for r in rows.collect():
        expected.setdefault(r.k, []).append((-r.v, r.id))
    expected = {(k, n, i) for k, values in expected.items() for n, (_, i) in enumerate(sorted(values)[:25], 1)}
    for slices in (1, 4, 32):
        top = ranking.top_per(rows, ["k"], [F.col("v").desc()], ["id"], 25, slices)
        assert {(r.k, r.rn, r.id) for r in top.collect()} == expected


def test_top_overall_keeps_order(spark):
    rows = spark.range(3000).select((F.col("id") * 17 % 40).alias("v"), "id")
    found = [(r.v, r.id) for r in ranking.top_overall(rows, [F.col("v").desc()], ["id"], 130).collect()]
    assert found == sorted(((i * 17 % 40, i) for i in range(3000)), key=lambda x: (-x[0], x[1]))[:130]


def test_rankings_are_cut_before_the_shuffle(spark):
    rows = spark.range(100).select((F.col("id") % 3).alias("k"), (F.col("id") % 7).alias("v"), "id")
    for df, cuts in ((ranking.top_per(rows, ["k"], [F.col("v").desc()], ["id"], 5), 2), (ranking.newest_per(rows, ["k"], [F.col("v").desc()]), 1)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert sum("WindowGroupLimit" in line and "Partial" in line for line in plan.splitlines()) == cuts
