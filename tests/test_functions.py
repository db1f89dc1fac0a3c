"""Truth tables of the column functions."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from tierloom.functions import dates, flags, labels, numbers, text
from tierloom.functions import fixed_values as fixed

col = F.col


def d(value):
    return value if value is None else date.fromisoformat(value)


TEXT_CASES = {
    "date in either format": (
        lambda: dates.parse_date_multi(col("x")),
        ["04/10/2017", "2022-03-26", " 2022-03-26 ", "02/29/2024", "02/30/2024", "2024-02-30",
         "2/3/2024", "2024", "13/01/2024", "ab/cd/efgh", "2024-02-1T", "", "  ", None],
        [d("2017-04-10"), d("2022-03-26"), d("2022-03-26"), d("2024-02-29"), *[None] * 10],
    ),
    "money": (
        lambda: numbers.parse_money(col("x")),
        ["$12.50", "N/A", "na", "N.A.", "", "7", "abc", " 8 ", " $5", "$", None, "$" + "1" * 60],
        [12.5, None, None, None, None, 7.0, None, 8.0, None, None, None, float("1" * 60)],
    ),
    "rounded quantity": (
        lambda: numbers.round_long(col("x")),
        ["2.5", "-2.5", "3.4", "1.0", "x", "1e30", None, "3000000000", "9007199254740993", "2999999999.5"],
        [3, -3, 3, 1, None, None, None, 3000000000, 9007199254740993, 3000000000],
    ),
    "numbers that do not fit": (
        lambda: numbers.misfit(col("x"), numbers.safe_long(col("x"))),
        ["7", "9223372036854775808", "1.5", "x", "", None], [None, "9223372036854775808", None, None, None, None],
    ),
    "budget": (
        lambda: numbers.absolute_amount(col("x")), ["", "-50.5", "10", "12d", "NaN", None],
        [0.0, 50.5, 10.0, 0.0, 0.0, 0.0],
    ),
    "whole number": (
        lambda: numbers.safe_int(col("x")), ["12", " 12 ", "-3", "+4", "12.5", "9999999999", "", None],
        [12, 12, -3, 4, None, None, None, None],
    ),
    "id": (
        lambda: numbers.safe_long(col("x")), ["12", "9999999999", "99999999999999999999", "x", None],
        [12, 9999999999, None, None, None],
    ),
    "number": (
        lambda: numbers.safe_double(col("x")), ["1e3", ".5", "5.", "12d", "NaN", "Infinity", "0x1", ""],
        [1000.0, 0.5, 5.0, None, None, None, None, None],
    ),
    "stock floor": (
        lambda: numbers.floor_at(numbers.safe_int(col("x")), 0), ["-3", "0", "4", "x"], [0, 0, 4, None],
    ),
    "customer id": (
        lambda: numbers.null_if_sentinel(col("x"), fixed.UNKNOWN_CUSTOMER_ID),
        ["", "999999", "11000", "abc", None, "9999999999"], [None, None, 11000, None, None, 9999999999],
    ),
    "employee id": (
        lambda: text.null_if_suffix_above(col("x"), 4, fixed.LAST_EMPLOYEE_NUMBER),
        ["EMP300", "EMP301", " EMP007 ", "EMPX", "EMP", "", None, "EMP00000000000301", "EMP9999999999", "EMP00000000000300", "EMP" + "9" * 40],
        ["EMP300", None, "EMP007", "EMPX", "EMP", None, None, None, None, "EMP00000000000300", None],
    ),
    "product key": (
        lambda: text.repair_key(col("x"), fixed.TICKET_PRODUCT_PREFIX),
        ["PRD-HL-U509", "HL_U509", "PRD-A_B", "HL-U509 ", " PRD-A_B", "PRD-X ", "", None],
        ["HL-U509", "HL-U509", "A_B", "HL-U509", "PRD-A-B", "X", None, None],
    ),
    "category of a key": (lambda: text.category_part(col("x")), ["AC-HE-HL-U509-R"], ["AC_HE"]),
    "product of a key": (lambda: text.product_part(col("x")), ["AC-HE-HL-U509-R"], ["HL-U509-R"]),
    "id prefix": (
        lambda: text.strip_prefix(col("x"), "NAS"), ["NASAWC00011000", "AWC00011000", None],
        ["AWC00011000", "AWC00011000", None],
    ),
    "removed delimiter": (
        lambda: text.swap_delimiter(col("x"), "-", ""), ["AW-00-1", None], ["AW001", None],
    ),
    "channel": (
        lambda: labels.canonicalize(col("x"), fixed.CAMPAIGN_CHANNEL, fixed.OTHER),
        ["E-mail", "e_mail", "SocialMedia", "DM", "TV Ad", "in person", " text ", "fax", None],
        ["Email", "Email", "Social Media", "Direct Mail", "TV", "Events", "SMS", "Other", "Other"],
    ),
    "role": (
        lambda: labels.canonicalize(col("x"), fixed.JOB_ROLE, None),
        ["Analst", "T.Lead", "Dir.", "team lead", "Pilot ", None],
        ["Analyst", "Team Lead", "Director", "Team Lead", "Pilot", None],
    ),
    "vendor country": (
        lambda: labels.canonicalize(col("x"), fixed.VENDOR_COUNTRY, None),
        ["england", "FRA", "us", "Peru "], ["United Kingdom", "France", "United States", "Peru"],
    ),
    "gender": (
        lambda: labels.canonicalize(col("x"), fixed.ERP_GENDER, "n/a"), ["F", "female", "MALE", "", None],
        ["Female", "Female", "Male", "n/a", "n/a"],
    ),
    "ticket status": (
        lambda: labels.canonicalize(col("x"), fixed.TICKET_STATUS, "Unknown"),
        ["o", "Clsd", "Rsolvd", "In Progress", "in_progress", "gone"],
        ["Open", "Closed", "Resolved", "Pending", "Pending", "Unknown"],
    ),
    "product line": (
        lambda: labels.map_codes(col("x"), fixed.PRODUCT_LINE, "n/a"), ["M", "r ", "S", "T", "", None],
        ["Mountain", "Road", "Other Sales", "Touring", "n/a", "n/a"],
    ),
    "region of a country": (
        lambda: labels.group_label(col("x"), fixed.VENDOR_REGION, "Other"),
        ["Canada", "Spain", "India", "Peru", "canada", None],
        ["North America", "Europe", "Asia-Pacific", "Other", "Other", "Other"],
    ),
    "name": (
        lambda: text.default_text(col("x"), "N/A"), [" Donald", "", "  ", None],
        ["Donald", "N/A", "N/A", "N/A"],
    ),
    "blank": (lambda: text.blank_to_null(col("x")), [" a ", "", "  ", None], ["a", None, None, None]),
    "code": (lambda: text.upper_code(col("x")), [" warehouse a ", None], ["WAREHOUSE A", None]),
    "trimmed": (lambda: text.clean_text(col("x")), ["  a b ", None], ["a b", None]),
}


@pytest.mark.parametrize("case", TEXT_CASES)
def test_text_columns(evaluate, case):
    expression, given, expected = TEXT_CASES[case]
    assert evaluate("x string", [(v,) for v in given], expression()) == expected


def test_date_from_number(evaluate):
    given = [20121228, 20240229, 20230229, 19000229, 20000229, 20130431, 20130431 + 9, 0, 2012,
             20131301, 20130100, 20130132, -2012122, 201212281, None]
    expected = [d("2012-12-28"), d("2024-02-29"), None, None, d("2000-02-29"), *[None] * 10]
    assert evaluate("x int", [(v,) for v in given], dates.parse_yyyymmdd(col("x"))) == expected


def test_every_day_from_number(spark):
    """Each number with a day of these years is read, each other one of eight digits is NULL."""
    years = (1000, 1900, 2000, 2023, 2024, 9999)
    numbered = spark.range(10000).select(F.explode(F.array(*map(F.lit, years))).alias("y"), "id")
    read = numbered.select((F.col("y") * 10000 + F.col("id")).cast("int").alias("x")).select("x", dates.parse_yyyymmdd(col("x")).alias("day"))
    found = {row.x: row.day for row in read.where("day IS NOT NULL").collect()}
    days = (date.fromordinal(n) for y in years for n in range(date(y, 1, 1).toordinal(), date(y, 12, 31).toordinal() + 1))
    assert found == {day.year * 10000 + day.month * 100 + day.day: day for day in days}


def test_date_from_number_makes_no_text(spark, plan_of):
    """Text of a number and parsing it again took most of the time of cleansing order lines."""
    numbers_ = spark.range(1).select(col("id").cast("int").alias("x"))
    assert "as string" not in plan_of(numbers_.select(dates.parse_yyyymmdd(col("x"))))


def test_strict_date_from_number(evaluate):
    strict = dates.parse_yyyymmdd(col("x"), strict=True)
    assert evaluate("x int", [(20121228,), (0,), (2012,)], strict) == [d("2012-12-28"), None, None]
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        evaluate("x int", [(20130231,)], strict)


LINES = [(None, 2, 5), (0, 2, 5), (11, 2, 5), (10, 2, -5), (10, 3, None), (10, 0, None), (-7, 2, 0)]


def test_amount_repair(evaluate):
    got = evaluate("a int, q int, p int", LINES, numbers.repair_amount(col("a"), col("q"), col("p")))
    assert got == [10, 10, 10, 10, 10, 10, 0]


def test_price_repair_uses_the_amount_as_landed(evaluate):
    got = evaluate("a int, q int, p int", LINES, numbers.repair_price(col("a"), col("q"), col("p")))
    assert got == [5, 5, 5, 5, 3, None, -3]


def test_amounts_do_not_overflow(evaluate):
    got = evaluate(
        "a int, q int, p int", [(None, 2_000_000_000, 2_000_000_000)],
        numbers.repair_amount(col("a"), col("q"), col("p")),
    )
    assert got == [4_000_000_000_000_000_000]


def test_measures(evaluate):
    rows = [(3, 10, 2), (3, 10, None), (None, 10, 2)]
    schema = "stock int, level int, cost int"
    assert evaluate(schema, rows, numbers.stock_gap(col("stock"), col("level"))) == [-7, -7, None]
    assert evaluate(schema, rows, numbers.stock_value(col("stock"), col("cost"))) == [6, 0, None]
    total = numbers.derived_total(col("stock"), col("cost").cast("double"))
    assert evaluate(schema, rows, total) == [6.0, None, None]


def test_flags(evaluate):
    rows = [("2024-01-01", "2023-12-31"), ("2024-01-01", "2024-01-01"), ("2024-01-01", None)]
    got = evaluate("a string, b string", rows, flags.flag_range(col("a"), col("b")))
    assert got == [1, 0, 0]
    assert evaluate("a int, b int", [(1, 2), (2, 2), (None, 2)], flags.flag_below(col("a"), col("b"))) == [1, 0, 0]


def test_overdue(evaluate):
    rows = [("Closed", 60), ("Resolved", 60), ("Open", 30), ("Open", 31), (None, 60)]
    opened = F.date_sub(dates.as_of_date("2024-06-30"), col("age"))
    got = evaluate(
        "status string, age int", rows, flags.flag_overdue(col("status"), opened, "2024-06-30", 30)
    )
    assert got == [0, 1, 0, 1, 0]


def test_years_and_bands(evaluate):
    hired = [("2020-12-31",), ("2019-06-01",), ("2016-01-01",), ("2011-12-31",), (None,)]
    years = dates.years_crossed(col("x").cast("date"), dates.as_of_date("2021-01-01"))
    assert evaluate("x string", hired, years) == [1, 2, 5, 10, None]
    banded = labels.band(years, fixed.SENIORITY_CUTS, fixed.SENIORITY_LABELS)
    assert evaluate("x string", hired, banded) == [
        "Junior", "Mid-Level", "Senior", "Veteran", "Veteran",
    ]
    with pytest.raises(ValueError):
        labels.band(years, (1, 2), ("one", "two"))


def test_days(evaluate):
    rows = [("2024-01-01", "2024-01-31"), ("2024-01-01", None), (None, "2024-01-01")]
    opened, closed = col("a").cast("date"), col("b").cast("date")
    assert evaluate("a string, b string", rows, dates.days_open(opened, closed, "2024-03-01")) == [
        30, 60, None,
    ]
    assert evaluate("a string, b string", rows, dates.days_between(opened, closed)) == [30, None, None]


def test_future_dates(evaluate):
    rows = [("2024-06-30",), ("2024-07-01",), (None,)]
    got = evaluate("x string", rows, dates.null_if_after(col("x").cast("date"), date(2024, 6, 30)))
    assert got == [d("2024-06-30"), None, None]


def test_preferred_source(evaluate):
    rows = [("Male", "Female"), ("n/a", "Female"), ("n/a", None), (None, "Male"), (None, None)]
    got = evaluate("a string, b string", rows, labels.prefer(col("a"), col("b"), "n/a"))
    assert got == ["Male", "Female", "n/a", "Male", "n/a"]


def test_full_name(evaluate):
    rows = [("Ann", "Lee"), (None, "Lee"), ("Ann", None), (None, None)]
    got = evaluate("a string, b string", rows, text.full_name(col("a"), col("b")))
    assert got == ["Ann Lee", " Lee", "Ann ", " "]


def test_no_python_in_the_plans(spark, plan_of):
    df = spark.createDataFrame([("a",)], "x string")
    for expression, _, _ in TEXT_CASES.values():
        plan = plan_of(df.select(expression()))
        assert "Python" not in plan
        assert "Join" not in plan
