"""Column helpers on hand tables."""

import random
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from sitecharge.functions import numeric
from sitecharge.functions.charges import FILL_TYPES
from sitecharge.functions.dates import closed_months, coerce_datetimes, datetime_text
from sitecharge.functions.names import upper_names
from sitecharge.operators.impute import (
    add_fill_flags,
    add_imputed_charge,
    add_modified_quantity,
)
from sitecharge.operators.periods import Period, year_to_date

INF = float("inf")
NAN = float("nan")


def values(spark, data, kind, make):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(data)], f"i int, x {kind}")
    return [r.y for r in df.select("i", make(F.col("x")).alias("y")).orderBy("i").collect()]


def test_cents_as_formatting_rounds(spark):
    r = random.Random(3)
    data = [2.675, 1.005, 0.125, -0.125, 0.0, 1e12 / 3, 1234567.895, INF, -INF, None]
    data += [r.uniform(-1, 1) * 10 ** r.randrange(0, 9) for _ in range(5000)]
    data += [r.randrange(10**7) / 1000 for _ in range(5000)]
    expected = [v if v is None or abs(v) == INF else float(f"{v:.2f}") for v in data]
    assert values(spark, data, "double", numeric.round_cents) == expected
    texts = [None if v is None else f"${v:,.2f}" for v in data]
    assert values(spark, data, "double", numeric.money_text) == texts
    shares = [None if v is None else f"{v:,.2%}" for v in data]
    assert values(spark, data, "double", numeric.percent_text) == shares


def test_division(spark):
    pairs = [(1.0, 4.0), (1.0, 0.0), (-1.0, 0.0), (0.0, 0.0), (None, 0.0), (1.0, None), (INF, INF)]
    df = spark.createDataFrame(pairs, "a double, b double")
    found = df.select(numeric.float_divide(F.col("a"), F.col("b")).alias("y")).collect()
    assert [r.y for r in found] == [0.25, INF, -INF, None, None, None, None]


def test_parse_numbers(spark):
    money = ["$1,234.50", "$-5.00", "12", "$inf", "", "abc", "1d", "$nan", None]
    assert values(spark, money, "string", numeric.parse_money) == [
        1234.5, -5.0, 12.0, INF, None, None, None, None, None]
    shares = ["12.50%", "1,234.57%", "-3.00%%", "inf%", "x%", "7", None]
    assert values(spark, shares, "string", numeric.parse_percent) == [
        12.5, None, -3.0, INF, None, 7.0, None]


def test_coerce_numbers_spares_ids(spark):
    df = spark.createDataFrame([("A1", "2.5", "x")], "SITE_ID string, a string, b string")
    (row,) = numeric.coerce_numbers(df, spare=("SITE_ID",)).collect()
    assert tuple(row) == ("A1", 2.5, None)


def test_datetimes(spark):
    rows = [("2000-01-02", 946782000123456789, date(2000, 1, 2)),
            ("2000-01-02 03:04:05", -1, None), ("n/a", None, None), (None, 0, None)]
    df = spark.createDataFrame(rows, "t string, n bigint, d date")
    found = coerce_datetimes(df, ["t", "n", "d"]).collect()
    assert [r.t for r in found] == [datetime(2000, 1, 2), datetime(2000, 1, 2, 3, 4, 5), None, None]
    assert [r.n for r in found] == [
        datetime(2000, 1, 2, 3, 0, 0, 123456),
        datetime(1969, 12, 31, 23, 59, 59, 999999), None, datetime(1970, 1, 1)]
    assert [r.d for r in found] == [datetime(2000, 1, 2), None, None, None]
    text = coerce_datetimes(df, ["t"]).select(datetime_text(F.col("t")).alias("s")).collect()
    assert [r.s for r in text] == ["2000-01-02 00:00:00", "2000-01-02 03:04:05", None, None]


@pytest.mark.parametrize("as_of", [date(2000, 1, 31), date(2000, 2, 1), date(2001, 12, 5),
                                   date(2000, 7, 15)])
def test_closed_months(spark, as_of):
    months = year_to_date(as_of)
    assert len(months) == as_of.month - 1
    (found,) = values(spark, [as_of], "date", closed_months)
    assert [Period(m.start_date, m.end_date) for m in found] == months
    if as_of.month > 2 and as_of.year == 2000:
        assert months[1].end == date(2000, 2, 29)


CHARGES = ("final_charge_per_unit double, overridden_charge_per_unit double,"
           " labour_charge_per_unit double, materials_charge_per_unit double,"
           " overhead_charge_per_unit double, custom_sum_charge_per_unit double")


@pytest.mark.parametrize(
    "parts, charge, fill",
    [
        ((5.0, 9.0, 1.0, 1.0, 1.0, 1.0), 5.0, "fcpu"),
        ((0.0, 9.0, 1.0, 1.0, 1.0, 1.0), 9.0, "overridden"),
        ((None, None, 1.0, 2.0, 3.0, 4.0), 10.0, "sum_scenario"),
        ((None, 0.0, 1.0, 2.0, 3.0, None), 6.0, "sum_scenario_wo_custom"),
        ((None, 0.0, 1.0, 2.0, 3.0, -6.0), 6.0, "sum_scenario_wo_custom"),
        ((-1.0, None, None, 2.0, 3.0, 4.0), 0.0, "no_charge"),
        ((None, None, 0.0, 0.0, 0.0, 0.0), 0.0, "no_charge"),
    ],
)
def test_waterfall(spark, parts, charge, fill):
    (row,) = add_fill_flags(add_imputed_charge(spark.createDataFrame([parts], CHARGES))).collect()
    assert (row.imputed_charge_per_unit, row.fill_type) == (charge, fill)
    assert {t: row[f"{t}_fill"] for t in FILL_TYPES} == {t: int(t == fill) for t in FILL_TYPES}


@pytest.mark.parametrize(
    "produced, scenario, ratio, expected",
    [(1, 2, 4.0, 2.0), (2, 2, 4.0, 8.0), (1, None, 4.0, 8.0), (None, 2, 4.0, 2.0),
     (None, None, 4.0, 8.0), (1, 2, None, None), (1, 2, 0.0, INF)],
)
def test_unit_conversion(spark, produced, scenario, ratio, expected):
    df = spark.createDataFrame(
        [(8.0, produced, scenario, ratio)],
        "produced_quantity double, uom_produced int, scen_uom int, case_ratio double",
    )
    assert add_modified_quantity(df).first().modified_quantity == expected


def test_upper_names(spark):
    assert upper_names(spark.range(1).toDF("site_id")).columns == ["SITE_ID"]
