from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tallywright.functions import dates, money, rules, text


def values(spark, fn, inputs, kind):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(inputs)], f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(fn(F.col("v"))).collect()]


def test_title_case_breaks_on_punctuation_but_not_apostrophes(spark):
    names = ["mary-ann o'NEIL", "  jean\tLUC ", "a.b/c d", None, "", "élan vital", "x y"]
    assert values(spark, text.title_case, names, "string") == [
        "Mary-Ann O'neil", "Jean\tLuc", "A.B/C D", None, "", "Élan Vital", "X Y"]


def test_blank_to_null_knows_all_white_space(spark):
    raw = ["", "  ", "\t\n", " ", " x　", " a b ", None]
    assert values(spark, text.blank_to_null, raw, "string") == [None, None, None, None, "x", "a b", None]


def test_money_rounds_half_away_from_zero(spark):
    got = values(spark, money.money, [1.005, 2.675, -1.005, 59.990001678466797, None], "double")
    assert got == [Decimal("1.01"), Decimal("2.68"), Decimal("-1.01"), Decimal("59.99"), None]


def test_ratio_is_exact_on_ties_and_null_on_zero(spark):
    df = spark.sql("select cast(100.01 as decimal(18,2)) a, cast(2 as bigint) b, cast(0 as bigint) z")
    row = df.select(
        money.ratio(F.col("a"), F.col("b"), 2), money.ratio(F.col("a"), F.col("z"), 2), money.ratio(-F.col("a"), F.col("b"), 2)
    ).first()
    assert [str(v) for v in row] == ["50.01", "None", "-50.01"]


def test_total_is_exact(spark):
    df = spark.sql("select cast(0.1 as decimal(18,2)) a from range(1001)")
    assert df.agg(money.total(F.col("a"))).first()[0] == Decimal("100.10")


def test_net_revenue_is_zero_for_other_and_unknown_status(spark):
    df = spark.sql("select * from values (1, 'Shipped'), (2, 'Returned'), (3, null) t(i, s)").orderBy("i")
    price = F.lit(5).cast("decimal(18,2)")
    got = [float(r[0]) for r in df.select(money.net_revenue(price, F.col("s"), ("Shipped",))).collect()]
    assert got == [5.0, 0.0, 0.0]


def test_day_diff_counts_calendar_days(spark):
    df = spark.sql("select timestamp'2024-03-01 00:00:01' a, timestamp'2024-02-29 23:59:59' b")
    assert df.select(dates.day_diff(F.col("a"), F.col("b"))).first()[0] == 1


def test_month_diff_may_be_negative(spark):
    df = spark.sql("select date'2023-11-01' a, date'2024-01-31' b")
    assert df.select(dates.month_diff(F.col("a"), F.col("b")), dates.month_diff(F.col("b"), F.col("a"))).first()[:] == (-2, 2)


def test_week_start_and_weekend(spark):
    df = spark.sql("select date'2024-06-02' d")  # a Sunday
    row = df.select(
        dates.week_of(F.col("d")), dates.week_of(F.col("d"), "sunday"), dates.is_weekend(F.col("d")), dates.day_name(F.col("d"))
    ).first()
    assert row[:] == (date(2024, 5, 27), date(2024, 6, 2), True, "Sunday")
    with pytest.raises(ValueError):
        dates.week_of(F.col("d"), "friday")
    with pytest.raises(ValueError):
        dates.truncate(F.col("d"), "decade")


def test_last_band_takes_nulls(spark):
    assert values(spark, rules.age_band, [24, 25, 64, 65, None], "int") == ["18-24", "25-34", "55-64", "65+", "65+"]
    assert values(spark, rules.price_tier, [24.99, 25.0, 199.99, 200.0, None], "double") == [
        "Budget (<$25)", "Mid ($25-$75)", "Premium ($75-$200)", "Luxury ($200+)", "Luxury ($200+)"]


def test_customer_status_rules(spark):
    df = spark.sql(
        "select * from values (1, 0, null), (2, null, null), (3, 1, 90), (4, 2, 90), (5, 1, 91), (6, 9, 365), (7, 9, 366) "
        "t(i, n, idle)"
    ).orderBy("i")
    got = [r[0] for r in df.select(rules.customer_status(F.col("n"), F.col("idle"), 90, 365)).collect()]
    assert got == ["Never purchased"] * 2 + ["Active - new", "Active - repeat", "Lapsing", "Lapsing", "Churned"]
