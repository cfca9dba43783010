from datetime import datetime

import pytest
from pyspark.sql import functions as F

from furrow.functions import fuzzy
from furrow.functions import scalars as X


def value(spark, column):
    return spark.range(1).select(column.alias("v")).first().v


@pytest.mark.parametrize(
    ("text", "day"),
    [("2026-07-09", "2026-07-09"), ("2026-07-09T18:30:00Z", "2026-07-09"), ("20260709", "2026-07-09"), ("09/07/2026", "2026-07-09"), ("07/28/2026", "2026-07-28"), ("9 Jul 2026", "2026-07-09"), ("2026-13-40", None), ("20261340", None), ("", None), (None, None), ("soon", None)],
)
def test_parse_date(spark, text, day):
    assert value(spark, F.date_format(X.parse_date(F.lit(text).cast("string")), "yyyy-MM-dd")) == day


def test_free_dates_against_dateutil(spark):
    """Numbers and month names in all orders, short years, ordinals, times and missing parts."""
    import itertools
    import random

    dateutil = pytest.importorskip("dateutil.parser")
    r = random.Random(6)
    texts = ["Jul 2026", "July 9, 2026", "9 July, 2026", "2026/07/09", "2026/07/28", "09-Jul-26", "9/7/26", "9th Jul 2026", "09/07/2026 06:30 PM", "Thu, 9 Jul 2026", "9 Jul", "1st Sept 1999", "31/02/2026", "Feb 2026", "12/31/99", "1.2.2003", "5 May 68", "5 May 80", "13/13/2026", "9 Jul 2026 12:05 am", "July 9 2026 23:59:58", "2026 Jul 09", "2026-7-9", "Smarch 5, 2026", "09 / 07 / 2026"]
    for day, month, year in itertools.product((1, 9, 12, 13, 28), (2, 7, 11), (1994, 2026, 2003)):
        name = ["February", "July", "November"][(2, 7, 11).index(month)]
        m = r.choice([str(month), f"{month:02d}", name, name[:3], name[:3].upper()])
        y, sep = r.choice([str(year), f"{year % 100:02d}"]), r.choice("/-. ")
        parts = r.choice([(day, m, y), (m, day, year), (year, m, day)])
        text = sep.join(map(str, parts)) if not m[0].isalpha() or sep != "." else " ".join(map(str, parts))
        texts.append(text + r.choice(["", "", " 10:30", " 4:05 PM"]))
    today = datetime(2026, 8, 31)
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string").select("i", X.parse_date(F.col("t"), F.lit("2026-08-31")).alias("d"))
    got = {x.i: x.d for x in df.collect()}
    wrong = []
    for i, t in enumerate(texts):
        iso = t[:10] if t[4:5] == "-" and t[7:8] == "-" and len(t) >= 10 and t[:4].isdigit() else None
        try:
            want = datetime.strptime(iso, "%Y-%m-%d") if iso else dateutil.parse(t, dayfirst=True, yearfirst=False, default=today)
        except (ValueError, OverflowError):
            want = None
        if got[i] != want:
            wrong.append((t, got[i], want))
    assert wrong == []


def test_numbers_as_general_text(spark):
    numbers = [0.0, 1.0, -2600.0, 0.1, 1 / 3, 123456.0, 999999.4, 999999.5, 1e6, 1234567.0, 1.5e9, 0.0001, 0.00012345678, 0.00009999, 1e-7, -3.25e-9, 2450.255, 1e22, 12345.65, 1e100, 100000.0, 0.5, 200000.5, 200001.5, -12345.75, 1.000005, 0.001234565, 999999.5, 9999995.0, 12345650.0, 12345750.0, 99999.95, *(k / 1000 + 0.0005 for k in range(100000, 100400)), *(k + 0.65 for k in range(10000, 10400)), *(k * 1e-9 + 5e-10 for k in range(123000, 123200))]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(numbers)], "i int, x double").select("i", X.number_text(F.col("x")).alias("t"))
    assert {r.i: r.t for r in df.collect()} == {i: f"{x:g}" for i, x in enumerate(numbers)}


def test_day_first_keeps_time(spark):
    assert value(spark, X.parse_date(F.lit("09/07/2026 18:30"))) == datetime(2026, 7, 9, 18, 30)


@pytest.mark.parametrize(("day", "swapped"), [("2026-09-07", "2026-07-09"), ("2026-07-22", "2026-07-22")])
def test_swap(spark, day, swapped):
    assert str(value(spark, X.swap_day_month(F.lit(day).cast("date")))) == swapped


@pytest.mark.parametrize(("day", "future"), [("2026-09-07", True), ("2026-08-11", False), ("2026-08-13", False), (None, False)])
def test_future(spark, day, future):
    assert value(spark, X.is_future(F.lit(day).cast("date"), F.lit("2026-08-13").cast("date"))) is future


@pytest.mark.parametrize(
    ("text", "strict", "compat"),
    [("Rs 5500 / Quintal", 5500.0, 5500.0), ("Rs. 5500 / Quintal", 5500.0, 0.55), ("1,200", 1200.0, 1200.0), ("12-15", None, None), ("1e3", 13.0, 13.0), ("५५००", 5500.0, 5500.0), ("₹2,450.50", 2450.5, 2450.5), ("N/A", None, None), ("-", None, None), ("", None, None), ("true", None, None)],
)
def test_price(spark, text, strict, compat):
    assert value(spark, X.to_price(F.lit(text))) == strict
    assert value(spark, X.to_price(F.lit(text), strict=False)) == pytest.approx(compat) if compat else value(spark, X.to_price(F.lit(text), strict=False)) is None


@pytest.mark.parametrize(("text", "asked"), [("2026-07-28", "28/07/2026"), ("28/07/2026", "28/07/2026"), (None, "31/10/2026")])
def test_feed_date(spark, text, asked):
    assert value(spark, X.feed_date(F.lit(text).cast("string"), F.lit("2026-10-31").cast("date"))) == asked


@pytest.mark.parametrize(("seconds", "text"), [(None, "N/A"), (42.34, "42.3s"), (125.5, "2m 5.5s")])
def test_duration(spark, seconds, text):
    assert value(spark, X.duration_text(F.lit(seconds).cast("double"))) == text


@pytest.mark.parametrize(("number", "text"), [(2600.0, "2600"), (0.0, "0"), (-1.5, "-1.5"), (2450.25, "2450.25"), (100.0, "100")])
def test_number_text(spark, number, text):
    assert value(spark, X.number_text(F.lit(number))) == text


def test_keys_keep_positions(spark):
    a = X.composite_key(F.lit("a"), F.lit(None).cast("string"), F.lit("b"))
    b = X.composite_key(F.lit("a"), F.lit("b"), F.lit(None).cast("string"))
    assert value(spark, a != b)


def test_names(spark):
    assert value(spark, X.without_suffix(F.lit("supermarket"))) == "super"
    assert value(spark, X.lower_strip(F.lit("  "))) == ""
    assert value(spark, X.lower_strip(F.lit(""))) is None
    row = value(spark, X.market_names(F.lit("old yard/kolar apmc, / kolar pmy")))
    assert (row.name, row.aliases) == ("Kolar APMC,", ["Old Yard", "Kolar PMY"])
    assert value(spark, X.recipients(F.lit("a@x.org; b@x.org,,"))) == ["a@x.org", "b@x.org"]


def test_fuzzy():
    assert fuzzy.ratio("paddy", "paddy") == 1.0
    assert fuzzy.ratio("paddy (common)", "paddy common") == 0.99
    assert fuzzy.ratio("tomato", "tomato local") >= 0.88
    assert fuzzy.candidates("Green Gram/Moong (Whole)")[:3] == ["green gram/moong (whole)", "greengrammoongwhole", "green gram"]
    assert fuzzy.best_ratio(None, ["x"]) == 0.0
