from datetime import date

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from panelwatch.functions import calendar, clean, measures
from panelwatch.functions.sql import register_functions


def values(spark, column_type, items, expression):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(items)], f"i int, x {column_type}")
    return [r[0] for r in df.orderBy("i").select(expression(F.col("x"))).collect()]


def test_age_separator_and_gender(spark):
    assert values(spark, "string", ["0~2", "30-34"], clean.age_canon) == ["0-2", "30-34"]
    assert values(spark, "string", ["M", "F", "X", "", None], clean.norm_gender) == ["M", "F", "U", "U", "U"]


@pytest.mark.parametrize(
    "label, bounds",
    [("30-34", (30, 34)), ("65+", (65, None)), ("0", (0, 0)), ("不詳", (None, None)), (None, (None, None))],
)
def test_age_bounds(spark, label, bounds):
    df = spark.createDataFrame([(label,)], "x string")
    assert tuple(df.select(*clean.age_bounds(F.col("x"))).first()) == bounds


@pytest.mark.parametrize("label", ["-", "4歲-", "a+", "1\n-"])
def test_malformed_age_band_fails(spark, label):
    df = spark.createDataFrame([(label,)], "x string")
    with pytest.raises(PySparkException, match="malformed"):
        df.select(*clean.age_bounds(F.col("x"))).collect()


def test_digits_only_rejects_trailing_newline(spark):
    assert values(spark, "string", ["12", "12\n", "", "1a"], lambda x: x.rlike(clean.DIGITS_ONLY)) == [
        True, False, False, False,
    ]


def test_lenient_numbers(spark):
    assert values(spark, "string", ["12", " 12 ", "abc", "", None], clean.lenient_int) == [12, 12, None, None, None]
    texts = ["1.5", "-1.5", "2.4", "1e3", "99999999999", "1,5", "-7"]
    assert values(spark, "string", texts, clean.lenient_int) == [2, -2, 2, 1000, None, None, -7]
    assert values(spark, "string", ["120.21", "", "x"], clean.lenient_double) == [120.21, None, None]


def test_slash_dates(spark):
    day = date(2015, 9, 1)
    assert values(spark, "string", ["2015/09/01", "2015/9/1", "2015/9/1 ", None], clean.strict_slash_date) == [
        day, day, day, None,
    ]
    assert values(spark, "string", ["", "2015/09/01"], clean.optional_slash_date) == [None, day]


@pytest.mark.parametrize("ansi", ["true", "false"])
@pytest.mark.parametrize("text", ["bad", "", "2015-09-01", "2015/13/01", "2015/9"])
def test_malformed_date_fails_in_both_modes(spark, text, ansi):
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        with pytest.raises(PySparkException, match="malformed"):
            values(spark, "string", [text], clean.strict_slash_date)
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)


def test_strict_cast_fails_on_text_and_overflow(spark):
    assert values(spark, "string", ["7", None], lambda x: clean.strict_cast(x, "tinyint")) == [7, None]
    for text in ("300", "x", ""):
        with pytest.raises(PySparkException, match="malformed"):
            values(spark, "string", [text], lambda x: clean.strict_cast(x, "tinyint"))


def test_sql_functions(spark):
    register_functions(spark)
    register_functions(spark)
    got = spark.sql("SELECT age_canon(a), norm_gender(g) FROM VALUES ('0~2', 'M'), ('65+', 'X'), (NULL, NULL) AS t(a, g)")
    assert [tuple(r) for r in got.collect()] == [("0-2", "M"), ("65+", "U"), (None, "U")]


def test_blank_and_flag(spark):
    assert values(spark, "string", ["", "a", None], clean.blank_to_null) == [None, "a", None]
    assert values(spark, "string", ["", "a", None], clean.is_blank) == [True, False, True]
    assert values(spark, "string", ["是", "否", None], lambda x: clean.flag(x, "是")) == [True, False, None]


def test_iso_week_monday(spark):
    weeks = [(2015, 1), (2015, 53), (2021, 1), (2014, 53)]
    df = spark.createDataFrame(weeks, "y int, w int")
    mondays = [r[0] for r in df.select(calendar.iso_week_monday(F.col("y"), F.col("w"))).collect()]
    # 2014 has 52 weeks: its week 53 is the first one of 2015.
    assert mondays == [date(2014, 12, 29), date(2015, 12, 28), date(2021, 1, 4), date(2014, 12, 29)]


def test_iso_calendar_matches_python(spark):
    days = [date(y, m, d) for y in range(1998, 2027) for m, d in ((1, 1), (1, 4), (6, 15), (12, 28), (12, 31))]
    df = spark.createDataFrame([(d,) for d in days], "d date")
    got = df.select(
        "d", calendar.iso_year(F.col("d")), calendar.iso_week(F.col("d")), calendar.week_start(F.col("d"))
    ).collect()
    for day, year, week, monday in got:
        assert (year, week) == tuple(day.isocalendar())[:2]
        assert monday.weekday() == 0 and 0 <= (day - monday).days < 7


def test_date_keys(spark):
    assert values(spark, "date", [date(2022, 4, 9), None], calendar.date_key) == [20220409, None]
    assert values(spark, "int", [20220409, 19981231, None], calendar.key_date) == [
        date(2022, 4, 9), date(1998, 12, 31), None,
    ]
    df = spark.createDataFrame([(2022, 4)], "y int, m int")
    assert df.select(calendar.month_key(F.col("y"), F.col("m"))).first()[0] == 20220401


def test_rounding_is_on_the_binary_value(spark):
    ratios = [23 / 320, 0.25, 0.35, -12.25, 0.0, 1234567.05]
    rounded = [round_in_c(x, 5) for x in ratios]
    assert values(spark, "double", ratios, lambda x: measures.round_half_away(x, 5)) == rounded
    assert values(spark, "double", [0.25, -0.25, 2.35], lambda x: measures.round_half_away(x, 1)) == [0.3, -0.3, 2.4]
    assert values(spark, "double", [1e300, -1e17, None], lambda x: measures.round_half_away(x, 5)) == [1e300, -1e17, None]


def round_in_c(x, digits):
    """round() of the C library, half away from zero."""
    import math

    scaled = abs(x) * 10.0**digits
    whole = math.floor(scaled + 0.5)
    return math.copysign(whole / 10.0**digits, x) if x else 0.0


def test_ratios_without_base_are_null(spark):
    df = spark.createDataFrame([(5, 0), (5, None), (5, 20)], "a long, b long")
    assert [r[0] for r in df.select(measures.rate(F.col("a"), F.col("b"))).collect()] == [None, None, 0.25]
    assert [r[0] for r in df.select(measures.percent(F.col("a"), F.col("b"))).collect()] == [None, None, 25.0]
    assert [r[0] for r in df.select(measures.growth_percent(F.col("a"), F.col("b"))).collect()] == [None, None, -75.0]
