"""Checks, labels, top lists and shares on hand-made rows."""

import pytest
from helpers import money, rows

from procurelens.functions import text
from procurelens.operators import quality, ranking
from procurelens.schemas import VENDOR_INVOICE
from pyspark.sql import functions as F


def names(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "vendorname string")


def one(spark, expression):
    return spark.range(1).select(expression.alias("x")).first().x


@pytest.mark.parametrize("amount,label", [
    (999.99, "999.99"), (1000.0, "1.00K"), (1_000_000.0, "1.00M"), (-52002.78, "-52002.78"), (0.0, "0.0"),
    (123.0, "123.0"), (2_345_678.0, "2.35M"), (999_999.99, "1000.00K"), (-12_345_678.9, "-12345678.9"),
    (-20_000_000.0, "-20000000.0"), (None, None), (1005.0, "1.00K"), (1015.0, "1.01K"), (1125.0, "1.12K"),
    (2675.0, "2.67K"), (1_005_000.0, "1.00M"), (-12_345_678.12345, "-12345678.12345")])
def test_money_labels(spark, amount, label):
    assert one(spark, text.money_label(F.lit(amount))) == label


def test_strip_and_trim(spark):
    padded = "\t\xa0 Acme  Ltd  \x1f\n"
    assert one(spark, text.strip(F.lit(padded))) == padded.strip() == "Acme  Ltd"
    assert one(spark, text.trim_spaces(F.lit("  a\t "))) == "a\t"


def test_whitespace_reports(spark):
    df = names(spark, " a b ", "clean", "tail ", None, "\tx")
    assert rows(quality.untrimmed(df)) == [
        {"vendorname": " a b ", "original_length": 5, "trimmed_length": 3},
        {"vendorname": "tail ", "original_length": 5, "trimmed_length": 4}]
    assert [r.visible_whitespace for r in quality.visible_spaces(df).collect()] == ["•a•b•", "tail•"]
    assert {r.visualized for r in quality.still_padded(df).collect()} == {"> a b <", ">tail <"}


def test_duplicate_orders_ignore_missing_numbers(spark):
    df = spark.createDataFrame(
        [(1, None, money("1.00")), (1, None, money("1.00")), (1, 5, None), (2, 5, None), (1, 6, None)], VENDOR_INVOICE)
    assert rows(quality.duplicate_orders(df)) == [{"ponumber": 5, "count_of_duplicates": 2}]
    assert quality.duplicate_orders(df, ["vendornumber", "ponumber"]).count() == 0


def test_key_violations(spark):
    df = spark.createDataFrame([(1, 1), (1, 1), (None, 2), (3, 3)], "a int, b int")
    assert rows(quality.key_violations(df, ["a", "b"])) == [
        {"a": 1, "b": 1, "rows": 2, "violation": "duplicate key"},
        {"a": None, "b": 2, "rows": 1, "violation": "null key"}]
    with pytest.raises(quality.KeyViolation, match="duplicate key"):
        quality.require_key(df.where("a = 1"), ["a", "b"])
    quality.require_key(df.where("a = 3"), ["a", "b"])


def test_profiles(spark):
    df = spark.createDataFrame([(1, None), (None, None), (3, "x")], "a int, b string")
    assert quality.null_profile(df).first().asDict() == {"a_nulls": 1, "b_nulls": 2}
    assert [tuple(r) for r in quality.column_profile(df).collect()] == [(1, "a", "int", True, 1), (2, "b", "string", True, 2)]


def test_top_rows_break_ties_by_name(spark):
    df = spark.createDataFrame([("d", 1), ("b", 2), ("a", 1), ("c", 1)], "n string, v int")
    assert [r.n for r in ranking.top_rows(df, "v", "n", 3).collect()] == ["b", "a", "c"]
    assert [r.n for r in ranking.top_rows(df, "v", "n", 2, largest=False).collect()] == ["a", "c"]


def vendors(spark, amounts):
    data = [(f"V{i:02d}", float(a), 1.0, float(a) + 1, 1, 5.0) for i, a in enumerate(amounts)]
    return spark.createDataFrame(data, """vendorname string, total_purchase_dollars double, gross_profit double,
        total_sales_dollars double, total_sales_quantity int, profit_margin double""")


def test_shares_and_pareto(spark):
    df = vendors(spark, range(1, 13))
    pareto = ranking.vendor_pareto(df).collect()
    shares = [round(a / 78 * 100, 2) for a in range(12, 2, -1)]
    assert [r.purchase_contribution for r in pareto] == shares
    assert pareto[-1].cumulative_contribution == pytest.approx(sum(shares))
    assert pareto[0].total_purchase_dollars == "12.0"
    rest = {r.vendorname: r.purchase_contribution for r in ranking.purchase_share_with_rest(df).collect()}
    assert rest["Other Vendors"] == pytest.approx(100 - sum(shares))
    assert sum(rest.values()) == pytest.approx(100)
    assert ranking.top_concentration(df).first()[0] == round(sum(shares), 2)


def test_share_of_a_zero_total_is_null(spark):
    df = spark.createDataFrame([("a", 0.0)], "n string, v double")
    assert ranking.with_share(df, "v", "s").first().s is None


def test_frequency(spark):
    df = names(spark, *("b" * 3 + "a" * 3 + "c"))
    assert [(r.value, r["rows"]) for r in ranking.frequency_top(df, "vendorname", 2).collect()] == [("a", 3), ("b", 3)]
