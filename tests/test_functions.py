"""Column functions on literal rows."""

from datetime import date, datetime
from decimal import Decimal

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tripmill.functions import calendar, labels, metrics, parse
from tripmill.functions.keys import surrogate_key
from tripmill.functions.rounding import mean, percent


def values(spark, function, texts, kind="string"):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], f"i int, t {kind}")
    rows = df.select("i", function(F.col("t")).alias("v")).orderBy("i").collect()
    return dict(zip(texts, [r.v for r in rows]))


TEXTS = [
    None, "", " ", "1", " 1 ", "1.0", "1.5", "-1", "+1", "1e3", ".5", "12.", "12.345", "-2.345",
    "NaN", "x", "12\n", "\t12", "007", "2.000", " 5.00", "1.", "--1", "1.2.3",
]


def test_int_or_null(spark):
    got = {t: v for t, v in values(spark, parse.int_or_null, TEXTS).items() if v is not None}
    assert got == {"1": 1, " 1 ": 1, "1.0": 1, "007": 7, "2.000": 2, " 5.00": 5}


def test_decimal_or_null_trims_before_the_test(spark):
    got = {t: v for t, v in values(spark, parse.decimal_or_null, TEXTS).items() if v is not None}
    assert {t: str(v) for t, v in got.items()} == {
        "1": "1.00", " 1 ": "1.00", "1.0": "1.00", "1.5": "1.50", "-1": "-1.00",
        "12.345": "12.35", "-2.345": "-2.35", "007": "7.00", "2.000": "2.00", " 5.00": "5.00",
    }


def test_strict_decimal_does_not_trim(spark):
    loose = values(spark, parse.decimal_or_null, TEXTS)
    strict = values(spark, parse.strict_decimal_or_null, TEXTS)
    differing = {t for t in TEXTS if loose[t] != strict[t]}
    assert differing == {" 1 ", " 5.00"}
    assert strict[" 1 "] is None and strict[" 5.00"] is None


def test_overflow_is_an_error(spark):
    for function, text in [
        (parse.int_or_null, "99999999999"),
        (parse.strict_decimal_or_null, "123456789.99"),
    ]:
        with pytest.raises(Exception, match="OVERFLOW|OUT_OF_RANGE|CAST_INVALID_INPUT"):
            values(spark, function, [text])


def test_timestamp(spark):
    texts = [
        "2024-01-01T10:00:00.000",
        "2024-01-01 10:00:00",
        "2024-01-01T10:00:00Z",
        "2024-01-01",
    ]
    got = list(values(spark, parse.timestamp, texts).values())
    assert got == [datetime(2024, 1, 1, 10)] * 3 + [datetime(2024, 1, 1)]
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        values(spark, parse.timestamp, ["31/12/2023"])
    assert values(spark, parse.timestamp_or_null, ["31/12/2023"]) == {"31/12/2023": None}


def test_trimmed_takes_spaces_only(spark):
    got = values(spark, parse.trimmed, [" Y ", "\tY", None])
    assert got == {" Y ": "Y", "\tY": "\tY", None: None}


def test_payment_label_reads_the_text(spark):
    got = values(spark, labels.payment_label, ["1", " 2 ", "3", "4", "5", "6", "1.0", "9", None])
    assert got == {
        "1": "Credit Card", " 2 ": "Cash", "3": "No Charge", "4": "Dispute", "5": "Unknown",
        "6": "Voided Trip", "1.0": "Other", "9": "Other", None: "Other",
    }


def test_vendor_name(spark):
    got = values(spark, labels.vendor_name, [1, 2, 3, None], "int")
    assert got == {
        1: "Creative Mobile Technologies", 2: "VeriFone Inc.", 3: "Unknown Vendor",
        None: "Unknown Vendor",
    }


def test_calendar_names_are_padded(spark):
    days = [date(2024, 5, 5), date(2024, 9, 7), date(2024, 5, 8)]
    assert list(values(spark, calendar.day_name, days, "date").values()) == [
        "Sunday   ", "Saturday ", "Wednesday",
    ]
    assert list(values(spark, calendar.month_name, days, "date").values()) == [
        "May      ", "September", "May      ",
    ]
    assert list(values(spark, calendar.weekday_number, days, "date").values()) == [0, 6, 3]


def one(spark, **columns):
    return spark.range(1).select(*[c.alias(n) for n, c in columns.items()]).first()


def ts(text):
    return F.lit(text).cast("timestamp_ntz")


def money(text):
    return F.lit(text).cast("decimal(10,2)")


def test_metrics(spark):
    start, end = ts("2024-01-01 10:00:00"), ts("2024-01-01 10:20:00")
    got = one(
        spark,
        mins=metrics.duration_mins(start, end),
        part=metrics.duration_mins(start, ts("2024-01-01 10:00:10")),
        mph=metrics.speed_mph(money("7"), start, end),
        still=metrics.speed_mph(money("7"), start, start),
        nowhere=metrics.speed_mph(money("0"), start, end),
        cost=metrics.cost_per_mile(money("10"), money("3")),
        no_cost=metrics.cost_per_mile(money("10"), money("0")),
        tip=metrics.tip_ratio(money("1"), money("3")),
        no_total=metrics.tip_ratio(money("1"), money("0")),
        no_tip=metrics.tip_ratio(F.lit(None).cast("decimal(10,2)"), money("3")),
    )
    assert got.mins == 20
    assert got.part == Decimal("0.1666666666666667")
    assert got.mph == 21
    assert got.still is None and got.nowhere is None
    assert got.cost == Decimal("3.3333333333333333")
    assert got.no_cost is None
    assert got.tip == Decimal("0.3333333333333333")
    assert got.no_total == 0 and got.no_tip is None


def test_duration_is_wall_clock_in_any_session_zone(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        # Through the hour that does not exist there.
        gap = metrics.duration_mins(ts("2024-03-10 01:30:00"), ts("2024-03-10 02:30:00"))
        name = calendar.day_name(F.to_date(ts("2024-03-10 02:30:00")))
        got = one(spark, gap=gap, hour=calendar.hour(ts("2024-03-10 02:30:00")), name=name)
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert (got.gap, got.hour, got.name) == (60, 2, "Sunday   ")


def test_surrogate_key(spark):
    import hashlib

    key = surrogate_key(ts("2024-01-01 10:00:00"), F.lit(None).cast("int"), money("12"))
    text = "2024-01-01 10:00:00-_dbt_utils_surrogate_key_null_-12.00"
    assert one(spark, k=key).k == hashlib.md5(text.encode()).hexdigest()


def test_mean_rounds_half_away_from_zero(spark):
    got = one(
        spark,
        tie=mean(F.lit("71.85").cast("decimal(20,2)"), F.lit(2), 2),
        other=mean(F.lit("119.57").cast("decimal(20,2)"), F.lit(2), 2),
        negative=mean(F.lit("-71.85").cast("decimal(20,2)"), F.lit(2), 2),
        none=mean(F.lit("0").cast("decimal(20,2)"), F.lit(0), 2),
    )
    assert (got.tie, got.other, got.negative) == (
        Decimal("35.93"), Decimal("59.79"), Decimal("-35.93"),
    )
    assert got.none is None


def test_percent(spark):
    got = one(spark, third=percent(F.lit(1), F.lit(3)), none=percent(F.lit(1), F.lit(0)))
    assert got.third == Decimal("33.33") and got.none is None


@settings(max_examples=10, deadline=None)
@given(
    st.lists(
        st.text(alphabet="0123456789.-+ eN\n\t", max_size=7), min_size=20, max_size=60, unique=True
    )
)
def test_parsers_agree_with_their_patterns(spark, texts):
    import re

    def whole(t):
        bare = t.strip(" ")
        return int(float(bare)) if re.fullmatch(r"[0-9]+(\.0+)?", bare) else None

    def well_formed(t):
        return re.fullmatch(r"-?[0-9]+(\.?[0-9]+)?", t) is not None

    ints = values(spark, parse.int_or_null, texts)
    strict = values(spark, parse.strict_decimal_or_null, texts)
    loose = values(spark, parse.decimal_or_null, texts)
    for t in texts:
        assert ints[t] == whole(t)
        assert (strict[t] is not None) == well_formed(t)
        assert (loose[t] is not None) == well_formed(t.strip(" "))
