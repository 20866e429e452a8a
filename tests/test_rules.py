"""Column rules against every kind of defect, under ANSI mode."""

import random
from datetime import date
from decimal import Decimal as D, ROUND_HALF_UP

import pytest
from pyspark.sql import functions as F

from tillwright.functions import dates, measures, numbers, text


def test_ansi_is_on(spark):
    assert spark.conf.get("spark.sql.ansi.enabled") == "true"


CASES = [
    (text.blank_to_null, [" a ", "", "   ", None, "\tb", "null"], ["a", None, None, None, "\tb", "null"]),
    (text.tokens_to_null, [" NULL ", "null", "", "nullable", None, " x "], [None, None, None, "nullable", None, "x"]),
    (
        lambda c: text.tokens_to_null(c, text.NUMBER_PLACEHOLDERS),
        ["N/A", "na", "None", "?", "??", "12"], [None, None, None, None, "??", "12"],
    ),
    (
        text.email_address,
        ["A.b+c@Shop.Example.COM", "no-at.example.com", "two@@example.com", "a@b", "a@b.c", "a b@c.de", None],
        ["a.b+c@shop.example.com", None, None, None, None, None, None],
    ),
    (
        text.phone_number,
        ["(612)555-2222", "+1 612 555 8888", "abc123", "123456789", "1" * 15, "1" * 16, None],
        ["6125552222", "16125558888", None, None, "1" * 15, None, None],
    ),
    (
        text.canonical,
        ["usa", "U.S.A.", "United States", "US", "CANADA", "mexico", "Peru", "peru", None],
        ["USA", "USA", "USA", "USA", "Canada", "Mexico", "Peru", "peru", None],
    ),
    (text.upper_code, [" mn ", "Minnesota", None], ["MN", "MINNESOTA", None]),
    (text.yes_no, ["TRUE", "Yes", "y", "False", "NO", "n", "1", "0", "maybe", None], [True] * 3 + [False] * 3 + [None] * 4),
    (text.matches, ["P0001", "P123", "P12345", "p0001", "XP0001", None], [True, False, False, False, False, None]),
    (numbers.numeric_id, ["7", "007", "-7", "+7", "7.0", "BADID", "", "1234567890123456789012345", None, "123456789012"], [7, 7] + [None] * 7 + [123456789012]),
    (numbers.whole_number, ["5", "-3", "0", "five", "", "5.7", "99999999999", None], [5, -3, 0] + [None] * 5),
    (
        numbers.list_price,
        ["14.99", "$14.99", "399,99", "-399,99", "1,234.5", "1,234", "14.99$", "$$1", ".5", "12345678901", "abc", None],
        [D("14.99"), D("14.99"), D("399.99"), D("-399.99")] + [None] * 4 + [D("0.50")] + [None] * 3,
    ),
    (
        numbers.order_price,
        ["14.99", "$14.99", "14$.99", "399,99", "-120", "", None],
        [D("14.99"), D("14.99"), D("14.99"), None, D("-120.00"), None, None],
    ),
    (numbers.plain_money, ["71.20", "$71.20", "1.005", "n/a", None], [D("71.20"), None, D("1.01"), None, None]),
    (numbers.percentage, ["10", "10%", "150", "1000", "abc", None], [D("10.00"), D("10.00"), D("150.00"), None, None, None]),
    (
        dates.standard_date,
        ["2023-01-15", "2023/01/15", "01-15-2023", "2023-1-5", "2023-02-30", "2023-13-01", "bad-date", "", None],
        [date(2023, 1, 15)] * 2 + [None] * 7,
    ),
    (
        lambda c: dates.standard_date(c, (dates.ISO_DAY, dates.US_DAY)),
        ["2023-07-03", "07-03-2023", "07/03/2023", "13-03-2023", "2024-02-29", "02-29-2023", "7-3-2023", "20230703"],
        [date(2023, 7, 3)] * 3 + [None, date(2024, 2, 29), None, None, None],
    ),
]


@pytest.mark.parametrize("rule, given, expected", CASES)
def test_rule(column, rule, given, expected):
    assert column(rule, given) == expected


def test_clamp_keeps_null(column):
    assert column(numbers.at_least_zero, [-10, 0, 999999, None], "int") == [0, 0, 999999, None]


def test_money_reads_like_decimal_arithmetic(column):
    """Well-formed amounts read as a decimal reader would read them, rounded half up."""
    rng = random.Random(7)
    given = [f"{rng.choice(['', '$'])}{rng.randint(0, 10**6)}.{rng.randint(0, 9999):04d}" for _ in range(300)]
    expected = [D(value.lstrip("$")).quantize(D("0.01"), ROUND_HALF_UP) for value in given]
    assert column(numbers.list_price, given) == expected
    assert column(numbers.order_price, given) == expected


def test_line_arithmetic_is_exact(spark):
    rng = random.Random(11)
    rows = [(rng.randint(1, 2_000_000_000), D(rng.randint(0, 10**10 - 1)) / 100, D(rng.randint(0, 10000)) / 100) for _ in range(300)]
    rows += [(5, D("34.78"), D("15.00")), (1, D("10.00"), D("100.00"))]
    df = spark.createDataFrame(rows, "quantity int, price decimal(10,2), discount decimal(5,2)")
    total = measures.line_total(F.col("quantity"), F.col("price"), F.col("discount"))
    out = df.select("*", total.alias("total")).select(
        "*",
        measures.line_profit(F.col("total"), F.col("quantity"), F.col("price")).alias("profit"),
    ).select("*", measures.line_margin(F.col("profit"), F.col("total")).alias("margin"))
    assert dict(out.dtypes)["total"] == "decimal(27,2)"
    assert dict(out.dtypes)["profit"] == "decimal(29,2)"
    assert dict(out.dtypes)["margin"] == "decimal(35,2)"
    for row in out.collect():
        exact = (row.quantity * row.price * (100 - row.discount) / 100).quantize(D("0.01"), ROUND_HALF_UP)
        assert row.total == exact
        assert row.profit == exact - row.quantity * row.price
        assert (row.margin is None) == (exact == 0)
    assert out.filter("quantity = 5").first().total == D("147.82")


def test_calendar(spark):
    df = spark.sql("select date'2024-03-03' as d union all select date'2023-12-30'").select(
        *[part.alias(name) for name, part in dates.calendar(F.col("d")).items()]
    )
    first, second = df.orderBy("date_key").collect()
    assert tuple(first) == (20231230, date(2023, 12, 30), 2023, 4, 12, "Dec", 30, 6, "Sat")
    assert tuple(second) == (20240303, date(2024, 3, 3), 2024, 1, 3, "Mar", 3, 0, "Sun")


def test_ratios_guard_zero(spark):
    df = spark.sql("select cast(1 as decimal(38,2)) p, cast(0 as decimal(38,2)) r, 0L n")
    row = df.select(measures.margin_pct(F.col("p"), F.col("r")), measures.per_order(F.col("p"), F.col("n"))).first()
    assert tuple(row) == (None, None)
