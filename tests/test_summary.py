"""Joins, sums and cleaning on hand-made rows."""

from decimal import Decimal

import pytest
from helpers import raw_tables, rows, summary

from procurelens.operators import quality
from procurelens.operators.joins import spread_join
from procurelens.plans.build import build_summary
from procurelens.plans.cleaning import clean_lenient, clean_strict
from procurelens.plans.summary import freight_by_vendor, join_summary, purchase_totals, sales_totals, vendor_summary
from procurelens.schemas import METRIC_COLUMNS, SUMMARY_COLUMNS, SUMMARY_KEY
from procurelens.session import work_dir
from procurelens.sources import star
from procurelens.sources.tables import read_path

GIN = (1, "Acme", 10, "Gin", "2.00", 3, "6.00")


def test_price_fan_out_repeats_purchases(spark):
    prices = [(1, 10, "3.00", "750"), (2, 10, "3.00", "750"), (3, 10, "4.00", "750")]
    tables = raw_tables(spark, [GIN, GIN], prices)
    got = rows(purchase_totals(tables["purchases"], tables["purchase_prices"]))
    # Two equal price rows double the sums; the third makes a row of its own.
    assert [(str(r["actual_price"]), r["total_purchase_quantity"], str(r["total_purchase_dollars"])) for r in got] == [
        ("3.00", 12, "24.00"), ("4.00", 6, "12.00")]
    assert quality.key_violations(tables["purchase_prices"], ["brand"]).count() == 1
    assert quality.duplicate_keys(vendor_summary(tables), SUMMARY_KEY).count() == 1


def test_fan_out_equals_join_then_group(spark):
    purchases = [GIN, (1, "Acme", 10, "Gin", "2.50", 1, "2.50"), (2, None, 10, "Gin", "2.00", None, None),
                 (3, "Free", 11, "Gift", "0.00", 9, "0.00"), (4, "Lone", 12, "Rum", "5.00", 1, "5.00")]
    prices = [(1, 10, "3.00", "750"), (1, 10, "3.00", "750"), (1, 10, None, None), (1, 11, "1.00", "5")]
    t = raw_tables(spark, purchases, prices)
    got = purchase_totals(t["purchases"], t["purchase_prices"])
    t["purchases"].createOrReplaceTempView("p")
    t["purchase_prices"].createOrReplaceTempView("pp")
    want = spark.sql(
        """SELECT p.vendornumber, vendorname, p.brand, description, purchaseprice, price AS actual_price, volume,
                  sum(quantity) AS total_purchase_quantity, sum(dollars) AS total_purchase_dollars
           FROM p JOIN pp ON p.brand = pp.brand WHERE purchaseprice > 0 GROUP BY ALL"""
    )
    assert rows(got) == rows(want.select(*got.columns))
    assert got.schema["total_purchase_dollars"].dataType == want.schema["total_purchase_dollars"].dataType


def test_pairs_without_sales_or_freight_stay(spark):
    t = raw_tables(spark, [GIN, (2, "Bolt", 10, "Gin", "2.00", 1, "2.00")], [(1, 10, "3.00", "750")],
                   sales=[(1, 10, 1, "4.00", "4.00", "0.10"), (1, 10, 2, "8.00", "4.00", "0.20")],
                   invoices=[(1, 7, "1.50"), (1, 8, "2.50")])
    acme, bolt = vendor_summary(t).collect()
    assert list(vendor_summary(t).columns) == SUMMARY_COLUMNS
    assert (acme.vendornumber, acme.total_sales_quantity, acme.total_sales_price, acme.freight_cost) == (
        1, 3, Decimal("8.00"), Decimal("4.00"))
    assert (bolt.total_sales_dollars, bolt.total_sales_quantity, bolt.freight_cost) == (None, None, None)


def test_freight_of_many_vendors_is_spread(spark):
    t = raw_tables(spark, [GIN, (2, "Bolt", 10, "Gin", "2.00", 1, "2.00"), (None, "Nil", 10, "Gin", "1.00", 1, "1.00")],
                   [(1, 10, "3.00", "750")], invoices=[(1, 7, "1.50"), (3, 8, "2.50"), (None, 9, "4.00")])
    sold = sales_totals(t["sales"]).withColumnRenamed("vendorno", "vendornumber")
    parts = purchase_totals(t["purchases"], t["purchase_prices"]), sold, freight_by_vendor(t["vendor_invoice"])
    few, many = join_summary(*parts), join_summary(*parts, broadcast_vendors=1)
    assert rows(few) == rows(many) and few.schema == many.schema
    assert {r.vendornumber: r.freight_cost for r in few.collect()} == {1: Decimal("1.50"), 2: None, None: None}


def test_only_the_sales_move_the_wide_pairs(spark, tmp_path):
    lines = [(1, 10, 1, 2.0, 8.0, 0.0, 0.1, "O"), (2, 10, 1, 1.0, 4.0, 0.0, 0.1, "F")]
    star_rows = {"lineitem": lines, "part": [(10, "gin", 5, 900.0)], "supplier": [(1, "Acme")]}
    for name, data in star_rows.items():
        spark.createDataFrame(data, star.STAR_SCHEMAS[name]).write.parquet(f"{tmp_path}/{name}.parquet")
    kept = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k) for k in kept}
    try:
        for k, v in kept.items():
            spark.conf.set(k, v)
        got = vendor_summary(star.load(spark, str(tmp_path)), ordered=False)
        plan = got._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    dealt = [line.split("hashpartitioning(")[1] for line in plan.splitlines() if "Exchange hashpartitioning(" in line]
    # Lines and suppliers, lines and parts, prices grouped and dealt by brand, pairs and sales.
    assert len(dealt) == 8, dealt
    assert not [x for x in dealt if "vendorname" in x or "_part#" in x]
    assert got.count() == 1


def test_two_purchase_prices_break_the_key(spark):
    t = raw_tables(spark, [GIN, (1, "Acme", 10, "Gin", "2.50", 1, "2.50")], [(1, 10, "3.00", "750")])
    assert vendor_summary(t).count() == 2
    path = work_dir(spark, "strict")
    good = raw_tables(spark, [GIN], [(1, 10, "3.00", "750")])
    build_summary(spark, good, path, mode="strict")
    with pytest.raises(quality.KeyViolation):
        build_summary(spark, t, path, mode="strict")
    assert read_path(spark, path).count() == 1  # the good table is still there


def test_spread_join_keeps_every_row_of_a_hot_key(spark):
    facts = spark.range(3000).selectExpr("if(id % 3 = 0, 1, id) AS k", "id AS row")
    lookup = spark.range(0, 3000, 2).selectExpr("id AS k", "id * 10 AS v").unionByName(
        spark.createDataFrame([(1, 10)], "k bigint, v bigint"))
    plain = facts.join(lookup, "k", "left")
    assert rows(spread_join(facts, lookup, "k", ["row"])) == rows(plain.select("k", "row", "v"))


def test_lenient_fills_strips_and_adds_metrics(spark):
    raw = summary(spark, vendorname=None, description="\t Gin \x1f", volume="Unknown", total_sales_quantity=None,
                  total_sales_dollars=None, total_sales_price=None, total_excise_tax=None, freight_cost=None)
    row = clean_lenient(raw).first()
    assert (row.vendorname, row.description, row.volume, row.freight_cost) == ("0", "Gin", 0.0, 0.0)
    assert (row.gross_profit, row.profit_margin, row.stock_turnover, row.sales_to_purchase_ratio) == (-20.0, 0, 0, 0)


@pytest.mark.parametrize("text,number", [
    ("750", 750.0), (" 7.5 ", 7.5), ("1e3", 1000.0), ("-2", -2.0), ("750mL", 0.0), ("1d", 0.0), ("2.5f", 0.0),
    ("0x1p3", 0.0), ("", 0.0), (None, 0.0), ("nan", 0.0)])
def test_lenient_volume(spark, text, number):
    assert clean_lenient(summary(spark, volume=text)).first().volume == number


def test_lenient_guards_zero_purchases(spark):
    row = clean_lenient(summary(spark, total_purchase_quantity=0, total_purchase_dollars="0.00")).first()
    assert (row.stock_turnover, row.sales_to_purchase_ratio) == (0.0, 0.0)


def test_lenient_is_idempotent(spark):
    once = clean_lenient(summary(spark, vendorname="  Acme ", volume="x", freight_cost=None))
    assert rows(clean_lenient(once)) == rows(once)


def test_strict_trims_only_names_and_spaces(spark):
    row = clean_strict(summary(spark, vendorname=" Acme\t ", description=" Gin ")).first()
    assert (row.vendorname, row.description) == ("Acme\t", " Gin ")


def test_strict_keeps_other_gaps(spark):
    row = clean_strict(summary(spark, vendorname=None, freight_cost=None, total_sales_dollars=None,
                               total_sales_quantity=None)).first()
    assert (row.vendorname, row.freight_cost, row.gross_profit) == (None, None, Decimal("-20.00"))
    assert (row.profit_margin, row.stock_turnover) == (Decimal("0.00"), Decimal("0.00"))


def test_strict_rounds_in_two_steps(spark):
    # 0.14455 stores as 0.1446 and narrows to 0.14; 1.00495 stores as 1.0050 and narrows to 1.01.
    first = clean_strict(summary(spark, total_sales_quantity=14455, total_purchase_quantity=100000)).first()
    second = clean_strict(summary(spark, total_sales_quantity=100495, total_purchase_quantity=100000)).first()
    assert (first.stock_turnover, second.stock_turnover) == (Decimal("0.14"), Decimal("1.01"))


def test_strict_types(spark):
    types = {f.name: f.dataType.simpleString() for f in clean_strict(summary(spark)).schema.fields}
    assert (types["vendornumber"], types["volume"], types["profit_margin"]) == ("int", "decimal(10,2)", "decimal(15,2)")
    assert list(types) == SUMMARY_COLUMNS + METRIC_COLUMNS
    assert types["total_sales_quantity"] == "bigint"


@pytest.mark.parametrize("change", [{"volume": "Unknown"}, {"description": "x" * 101}, {"brand": 2**31}])
def test_strict_fails_on_bad_values(spark, change):
    with pytest.raises(Exception, match="(?i)CAST|longer than 100|overflow"):
        clean_strict(summary(spark, **change)).collect()


def test_strict_can_null_a_bad_volume(spark):
    assert clean_strict(summary(spark, volume="Unknown"), strict_volume=False).first().volume is None


def test_both_modes_agree_on_clean_input(spark):
    raw = summary(spark, total_sales_dollars="33.33", total_purchase_quantity=7)
    lenient, strict = clean_lenient(raw).first(), clean_strict(raw).first()
    for c in METRIC_COLUMNS:
        assert float(strict[c]) == pytest.approx(lenient[c], abs=0.0051)
