import datetime as dt
from decimal import Decimal

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from condoflow.functions import dates, money, pii, text


def column(spark, values, kind, expression):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}")
    return [r[1] for r in df.select("i", expression(F.col("x")).alias("y")).orderBy("i").collect()]


@pytest.mark.parametrize("given_text, expected", [
    ("22,648.59", 2264859), ("33.706,04", 3370604), ("0,00", 0), ("127,080,00", 12708000), ("1.234", 123400),
    ("12,5", 1250), ("7", 700), (" 10.00 ", 1000), ("-3,50", -350), ("abc", None), ("", None), (None, None),
    ("1e5", None), ("$5", None), (".", None),
])
def test_clean_cents(spark, given_text, expected):
    assert column(spark, [given_text], "string", text.clean_cents) == [expected]


def test_clean_number_by_the_plain_local_rule(spark):
    rule = lambda c: text.clean_number(c, comma_decimals_only=True)
    assert column(spark, ["22,648.59", "33.706,04", "127,080,00"], "string", rule) == [
        Decimal("22.65"), Decimal("33706.04"), None,
    ]


def test_money_sign(spark):
    assert column(spark, ["$ 12500.00", "12.5", "$x", None], "string", text.money_sign_cents) == [1250000, 1250, None, None]


@settings(max_examples=25, deadline=None)
@given(num=st.integers(-10**12, 10**12), den=st.integers(1, 10**6))
def test_div_round_is_half_away_from_zero(spark, num, den):
    got = spark.range(1).select(money.div_round(F.lit(num), F.lit(den))).first()[0]
    whole, rest = divmod(abs(num), den)
    expected = whole + (1 if 2 * rest >= den else 0)
    assert got == (expected if num >= 0 else -expected)


@pytest.mark.parametrize("value, weight, total", [
    (100, 1, 3), (12345678, 999, 7777), (10**13, 10**12 + 1, 3 * 10**12), (10**14 - 1, 10**15, 10**15 + 7), (5, -2, 7), (-5, 2, 7), (10, 3, 0), (10, 3, -4), (0, 0, 5),
])
def test_weighted_part_in_millionths(spark, value, weight, total):
    got = spark.range(1).select(money.weighted_part(F.lit(value), F.lit(weight), F.lit(total))).first()[0]
    if total <= 0:
        assert got == 0
        return
    exact = abs(value * weight) * 10000
    expected = (2 * exact + total) // (2 * total)
    assert got == (expected if value * weight >= 0 else -expected)


def test_amount_text(spark):
    assert column(spark, [0, 5, 123456789, -150], "bigint", money.amount_text) == ["0.00", "0.05", "1,234,567.89", "-1.50"]


def test_cents_of_doubles(spark):
    assert column(spark, [1.15, 1001.91, -0.07, 2.675], "double", money.cents) == [115, 100191, -7, 268]


@pytest.mark.parametrize("day, week", [
    ("2025-01-01", 1), ("2025-01-04", 1), ("2025-01-05", 2), ("2023-01-01", 1), ("2023-01-07", 1), ("2023-01-08", 2),
    ("2024-12-31", 53), ("2000-12-31", 54),
])
def test_us_week(spark, day, week):
    assert column(spark, [day], "string", lambda c: dates.us_week(c.cast("date"))) == [week]


def test_nth_business_day(spark):
    def days(year, month, n):
        df = spark.range(1)
        return df.select(dates.nth_business_day(F.lit(year), F.lit(month), F.lit(n))).first()[0]

    assert days(2025, 6, 1) == dt.date(2025, 6, 2)
    assert days(2025, 6, 21) == dt.date(2025, 6, 30)
    assert days(2025, 6, 22) is None
    assert days(2025, 6, 0) == dt.date(2025, 6, 1)


def test_spanish_months(spark):
    assert column(spark, ["mayo ", " ENERO", "Diciembre", "smarch", None], "string", dates.spanish_month_number) == [
        5, 1, 12, None, None,
    ]


def test_periods(spark):
    day = lambda c: c.cast("date")
    assert column(spark, ["2025-01-31"], "string", lambda c: dates.shift_period(dates.period_of(day(c)), -1)) == [
        dt.date(2024, 12, 1)
    ]
    inside = lambda c: dates.in_period(day(c), 2024, 12)
    assert column(spark, ["2024-11-30", "2024-12-01", "2024-12-31", "2025-01-01"], "string", inside) == [
        False, True, True, False,
    ]


def test_categories(spark):
    given_types = ["GASTOS BANCARIOS", "gastos de limpieza x", "Seguros", "SERVICIOS PUBLICOS", "otros"]
    assert column(spark, given_types, "string", text.normalize_category) == [
        "BANCARIOS", "LIMPIEZA", "SEGUROS", "SERVICIOS PUBLICOS", "OTROS",
    ]
    assert column(spark, ["AYSA ", "edenor", "OTRA"], "string", text.utility_category) == [
        "SERVICIOS PUBLICOS", "SERVICIOS PUBLICOS", None,
    ]


@pytest.mark.parametrize("cell, extra, company, detail", [
    ("BANCO UNO - Comision", "", "BANCO UNO", "Comision"),
    ("AYSA ", "Cuenta 1", "AYSA", "Cuenta 1"),
    ("EDENOR", None, "EDENOR", "EDENOR"),
    ("A - b - c", " ", "A", "b - c"),
    ("SOLO -", "", "SOLO", None),
])
def test_company_and_detail(spark, cell, extra, company, detail):
    df = spark.createDataFrame([(cell, extra)], "c string, e string")
    row = df.select(text.company_name(F.col("c")), text.cost_detail(F.col("c"), F.col("e"))).first()
    assert tuple(row) == (company, detail)


def test_invoice_number(spark):
    df = spark.createDataFrame([(7, dt.date(2025, 5, 1), 12), (1234, dt.date(2025, 12, 1), 10999)], "b long, d date, s long")
    numbers = [r[0] for r in df.select(text.invoice_number(F.col("b"), F.col("d"), F.col("s"))).collect()]
    assert numbers == ["0072505012", "2342512999"]


def test_choice_by_hash_is_repeatable_and_uses_every_option(spark):
    options = ("a", "b", "c", "d", "e")
    df = spark.range(500).select("id", text.choose_by_hash(F.col("id"), options).alias("o"))
    assert {r.o for r in df.collect()} == set(options)
    assert df.collect() == df.collect()


def test_encryption_round_trip_and_row_binding(spark):
    key = "k" * 16
    df = spark.createDataFrame([(1, "11111111"), (2, None)], "id long, dni string")
    secret = pii.encrypt_columns(df, ("dni",), "id", key)
    assert "dni" not in secret.columns
    assert sorted(tuple(r) for r in pii.decrypt_columns(secret, ("dni",), "id", key).select("id", "dni").collect()) == [
        (1, "11111111"), (2, None),
    ]
    moved = secret.withColumn("id", F.col("id") + 1)
    with pytest.raises(Exception):
        pii.decrypt_columns(moved, ("dni",), "id", key).collect()


def test_plans_do_not_show_the_key(spark):
    key = "secret-key-16-by"
    df = spark.createDataFrame([(1, "11111111")], "id long, dni string")
    secret = pii.encrypt_columns(df, ("dni",), "id", key)
    for frame in (secret, pii.decrypt_columns(secret, ("dni",), "id", key), pii.encryption_facts(df, ("dni",), "id", key)):
        frame.collect()
        shown = frame._jdf.queryExecution().toString()
        for text_of_key in (key, key.encode().hex(), key.encode().hex().upper(), ", ".join(str(b) for b in key.encode())):
            assert text_of_key not in shown


def test_facts_of_encrypted_columns(spark, rows):
    df = spark.createDataFrame([(1, "11111111"), (2, None), (3, "ñandú")], "id long, dni string")
    assert rows(pii.encryption_facts(df, ("dni",), "id", "k" * 16)) == [(1, 36, True, True), (2, None, None, None), (3, 35, True, True)]


def test_session_key_is_required(spark):
    with pytest.raises(ValueError):
        pii.session_key(spark)


def test_exact_shares(spark):
    """Whole and half units of either sign, against fractions."""
    from fractions import Fraction

    cases = [(v, n, d) for v in (0, 1, 5, -5, 7, -7, 10**13 + 1, -(10**13) - 1) for n, d in ((0, 1), (1, 2), (3, 4), (1, 1), (7, 4 * 10**11))]
    df = spark.createDataFrame(cases, "v long, n long, d long")
    got = df.select("*", money.fraction_of(F.col("v"), F.col("n"), F.col("d")).alias("x")).collect()
    for r in got:
        exact = abs(Fraction(r.v * r.n, r.d))
        assert r.x == (-1 if r.v < 0 else 1) * int(exact + Fraction(1, 2)), r
    assert len(got) == len(cases)
