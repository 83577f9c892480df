"""Stored partial sums and the summary from them."""

import pytest
from helpers import money, raw_tables, rows
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from procurelens.plans import incremental as inc
from procurelens.plans.build import build_summary
from procurelens.plans.summary import vendor_summary
from procurelens.sources import snapshots

GIN = (1, "Acme", 10, "Gin", "2.00", 3, "6.00")
RUM = (1, "Acme", 11, "Rum", "5.00", None, None)
PRICES = [(1, 10, "3.00", "750"), (2, 10, "3.00", "750"), (1, 11, None, None)]


def tables(spark, *purchases, sales=(), invoices=(), prices=()):
    return raw_tables(spark, list(purchases), list(prices), list(sales), list(invoices))


def test_chunks_give_the_full_build(spark, tmp_path):
    path = str(tmp_path / "sums")
    sold, freight = (1, 10, 2, "9.00", "4.50", "0.10"), (1, 7, "1.50")
    inc.add_chunk(spark, path, "a", tables(spark, GIN, RUM, prices=PRICES, sales=[sold], invoices=[freight, (2, 8, None)]))
    inc.add_chunk(spark, path, "b", tables(spark, GIN, (2, None, 10, "Gin", "2.00", None, None), sales=[sold, (1, 10, None, None, None, None)]))
    inc.add_chunk(spark, path, "c", {"vendor_invoice": tables(spark, invoices=[(1, 9, "0.25")])["vendor_invoice"]})
    whole = tables(
        spark, GIN, RUM, GIN, (2, None, 10, "Gin", "2.00", None, None), prices=PRICES,
        sales=[sold, sold, (1, 10, None, None, None, None)], invoices=[freight, (2, 8, None), (1, 9, "0.25")],
    )
    want, got = vendor_summary(whole), inc.incremental_summary(spark, path)
    assert rows(got) == rows(want) and got.schema.simpleString() == want.schema.simpleString()
    inc.compact(spark, path)
    assert rows(inc.incremental_summary(spark, path)) == rows(want)
    assert len(snapshots.current(spark, path).parts) == 1 and inc.known_chunks(spark, path).count() == 9
    for mode in ("lenient",):
        built = inc.build_incremental(spark, path, str(tmp_path / mode), mode)
        assert rows(built) == rows(build_summary(spark, whole, str(tmp_path / f"full-{mode}"), mode))


def test_a_repeated_chunk_adds_nothing(spark, tmp_path):
    path = str(tmp_path / "sums")
    first = tables(spark, GIN, prices=PRICES)
    assert set(inc.add_chunk(spark, path, "a", first).values()) == {"added"}
    before, number = rows(inc.incremental_summary(spark, path)), snapshots.current(spark, path).number
    assert set(inc.add_chunk(spark, path, "a", {t: df.repartition(3) for t, df in first.items()}).values()) == {"known"}
    assert snapshots.current(spark, path).number == number and rows(inc.incremental_summary(spark, path)) == before
    with pytest.raises(inc.ChunkConflict, match="purchases"):
        inc.add_chunk(spark, path, "a", tables(spark, GIN, GIN, prices=PRICES))
    # Equal rows under another name are a chunk of their own.
    assert inc.add_chunk(spark, path, "b", {"purchases": first["purchases"]}) == {"purchases": "added"}
    assert {r.total_purchase_quantity for r in inc.incremental_summary(spark, path).collect()} == {12}


def test_a_chunk_that_fails_leaves_the_sums(spark, tmp_path):
    path = str(tmp_path / "sums")
    inc.add_chunk(spark, path, "a", tables(spark, GIN, prices=PRICES))
    before = rows(inc.incremental_summary(spark, path))
    torn = tables(spark, GIN, invoices=[(1, 1, "1.00")])
    torn["sales"] = torn["vendor_invoice"].select(
        F.col("vendornumber").alias("vendorno"), F.lit(10).cast("long").alias("brand"), F.lit(1).cast("long").alias("salesquantity"),
        *[F.raise_error(F.lit("torn")).cast("decimal(15,2)").alias(c) for c in ("salesdollars", "salesprice", "excisetax")],
    )
    with pytest.raises(PySparkException, match="torn"):
        inc.add_chunk(spark, path, "b", torn)
    assert rows(inc.incremental_summary(spark, path)) == before
    assert [r.chunk for r in inc.known_chunks(spark, path).select("chunk").distinct().collect()] == ["a"]


def test_many_chunks_are_compacted(spark, tmp_path):
    path = str(tmp_path / "sums")
    for i in range(5):
        inc.add_chunk(spark, path, f"c{i}", {"vendor_invoice": tables(spark, invoices=[(1, i, "0.50")])["vendor_invoice"]}, compact_after=3)
    assert len(snapshots.current(spark, path).parts) == 1
    assert [(r.freight_cost, r.rows) for r in inc.sums_of(spark, path, "vendor_invoice").collect()] == [(money("2.50"), 5)]
    assert inc.known_chunks(spark, path).count() == 5
    assert inc.incremental_summary(spark, str(tmp_path / "nothing")).count() == 0
