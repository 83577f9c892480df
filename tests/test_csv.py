"""CSV folder loads."""

from decimal import Decimal

import pytest
from pyspark.sql import types as T
from helpers import rows

from procurelens.plans import reports
from procurelens.session import work_dir
from procurelens.schemas import VENDOR_INVOICE
from procurelens.sources import csv_folder, naming, star, tables
from procurelens.streaming.csv_chunks import load_in_chunks


def write(folder, **files):
    folder.mkdir(exist_ok=True)
    for name, text in files.items():
        (folder / name.replace("__", " ")).write_bytes(text.encode())


@pytest.mark.parametrize("name,clean", [
    ("Purchase-Prices.csv", "purchase_prices"), ("Vendor Invoice.csv", "vendor_invoice"),
    ("a.b.CSV", "a_b"), ("Été 2.csv", "été_2")])
def test_table_names(name, clean):
    assert naming.table_name(name) == clean


def test_colliding_columns_are_an_error():
    with pytest.raises(naming.NameCollision, match="vendor_no"):
        naming.clean_names(["Vendor No", "vendor-no"])


def test_missing_and_empty_folders_load_nothing(spark, tmp_path):
    assert csv_folder.load_folder(spark, str(tmp_path / "none"), str(tmp_path / "out")).count() == 0
    (tmp_path / "empty").mkdir()
    assert csv_folder.load_folder(spark, str(tmp_path / "empty"), str(tmp_path / "out")).count() == 0


def test_folder_load(spark, tmp_path):
    source, target = tmp_path / "in", str(tmp_path / "out")
    write(source, **{
        "Purchase-Prices.csv": 'VendorNumber,Brand,Price,Volume\n1,10,3.50,750\n2,11,4.25,Unknown\n',
        "Vendor__Invoice.CSV": "VendorNumber,PONumber,Freight,Note\n1,7,1.50,\"late, heavy\"\n1,8,,NA\n",
        "stock.Csv": "Id,Qty,Share,Flag,Name,Gap\n1,5,0.5,True,x,\n2,NA,2,False,\"say \"\"hi\"\"\",\n",
        "bad.csv": "Vendor No,vendor-no\n1,2\n",
        "sales.csv": "VendorNo,Brand,SalesQuantity,SalesDollars,SalesPrice,ExciseTax\n1,10,oops,1,1,1\n",
        "twin one.csv": "a\n1\n", "twin-one.csv": "a\n2\n",
        "notes.txt": "not,a,table\n",
    })
    (source / "nested").mkdir()
    (source / "nested" / "deep.csv").write_text("a\n1\n")
    audit = {r.file: r for r in csv_folder.load_folder(spark, str(source), target).collect()}
    assert set(audit) == {"Purchase-Prices.csv", "Vendor Invoice.CSV", "stock.Csv", "bad.csv", "sales.csv",
                          "twin one.csv", "twin-one.csv"}
    status = {f: (r.table, r.rows, r.status) for f, r in audit.items()}
    assert status["Purchase-Prices.csv"] == ("purchase_prices", 2, "loaded")
    assert status["Vendor Invoice.CSV"] == ("vendor_invoice", 2, "loaded")
    for failed in ("bad.csv", "sales.csv", "twin one.csv", "twin-one.csv"):
        assert audit[failed].status == "failed" and audit[failed].error
    invoice = csv_folder.loaded_tables(spark, target, ["vendor_invoice"])["vendor_invoice"]
    assert rows(invoice) == [
        {"vendornumber": 1, "ponumber": 7, "freight": Decimal("1.50"), "note": "late, heavy"},
        {"vendornumber": 1, "ponumber": 8, "freight": None, "note": None}]
    stock = tables.read_path(spark, f"{target}/stock")
    assert {f.name: f.dataType.simpleString() for f in stock.schema.fields} == {
        "id": "bigint", "qty": "double", "share": "double", "flag": "boolean", "name": "string", "gap": "double"}
    assert stock.where("id = 2").first().name == 'say "hi"'
    assert spark.read.parquet(f"{target}/_load_audit").count() == len(audit)


def test_money_is_never_cut(spark, tmp_path):
    source, target = tmp_path / "in", str(tmp_path / "out")
    write(source, **{"vendor_invoice.csv": "vendornumber,ponumber,freight\n1,1,1.005\n"})
    (failed,) = csv_folder.load_folder(spark, str(source), target).collect()
    assert failed.status == "failed" and "does not fit" in failed.error
    (loaded,) = csv_folder.load_folder(spark, str(source), target, schemas={}).collect()
    assert loaded.status == "loaded" and tables.read_path(spark, f"{target}/vendor_invoice").first().freight == 1.005


def test_reload_replaces(spark, tmp_path):
    source, target = tmp_path / "in", str(tmp_path / "out")
    write(source, **{"t.csv": "a\n1\n2\n3\n"})
    csv_folder.load_folder(spark, str(source), target)
    write(source, **{"t.csv": "a\n9\n"})
    csv_folder.load_folder(spark, str(source), target)
    assert [r.a for r in tables.read_path(spark, f"{target}/t").collect()] == [9]


def test_line_breaks_inside_quotes(spark, tmp_path):
    (tmp_path / "m.csv").write_text('a,b\n1,"two\nlines"\n')
    assert csv_folder.read_csv(spark, str(tmp_path / "m.csv"), multi_line=True).first().b == "two\nlines"


def test_table_sinks_replace(spark):
    path = work_dir(spark, "sink")
    tables.replace_table(spark.range(5), "procurelens_sink_test", path)
    tables.replace_table(spark.range(3), "procurelens_sink_test", path)
    assert tables.read_table(spark, "procurelens_sink_test").count() == 3
    assert tables.read_table(spark, "procurelens_sink_test", "id > 0").count() == 2
    spark.sql("DROP VIEW procurelens_sink_test")


def test_chunked_load_replaces_then_adds(spark, tmp_path):
    source, target = tmp_path / "parts", str(tmp_path / "table")
    head = "vendornumber,ponumber,freight\n"
    write(source, **{f"p{i}.csv": f"{head}{i},7,1.50\n{i},,NA\n" for i in range(5)})
    table = load_in_chunks(spark, str(source), target, VENDOR_INVOICE, files_per_chunk=2)
    assert table.columns == [f.name for f in VENDOR_INVOICE.fields]
    assert spark.read.parquet(target).select("chunk").distinct().count() == 3
    assert spark.read.parquet(f"{target}/_load_audit").first().rows == 10
    assert table.count() == 10 and table.where("freight IS NULL AND ponumber IS NULL").count() == 5
    again = tmp_path / "again"
    write(again, **{"one.csv": f"{head}9,9,9.00\n"})
    assert [r.vendornumber for r in load_in_chunks(spark, str(again), target, VENDOR_INVOICE).collect()] == [9]


def test_chunked_load_of_many_files_takes_few_chunks(spark, tmp_path):
    source, target = tmp_path / "parts", str(tmp_path / "table")
    write(source, **{f"p{i}.csv": f"vendornumber,ponumber,freight\n{i},7,1.50\n" for i in range(12)})
    table = load_in_chunks(spark, str(source), target, VENDOR_INVOICE, files_per_chunk=2, most_chunks=3)
    assert spark.read.parquet(target).select("chunk").distinct().count() == 3
    assert sorted(r.vendornumber for r in table.collect()) == list(range(12))


def test_exact_cast_counts_digits_of_long_numbers_only(spark):
    cast = csv_folder.exact_cast("x", T.DecimalType(15, 2))
    good = ["1.50", "-3", "+4.", "1.500", " 2.10 ", "25e-1", "1e2", None]
    got = spark.createDataFrame([(x,) for x in good], "x string").select(cast).collect()
    assert [None if r[0] is None else str(r[0]) for r in got] == ["1.50", "-3.00", "4.00", "1.50", "2.10", "2.50", "100.00", None]
    for bad in ("1.505", "15e-3", "-0.001"):
        with pytest.raises(Exception, match="does not fit"):
            spark.createDataFrame([(bad,)], "x string").select(cast).collect()


def test_quoted_breaks_are_written_by_several_tasks(spark, tmp_path, monkeypatch):
    schemas = star.STAR_SCHEMAS
    for i in range(3):
        line = spark.createDataFrame([(i, 10 + i, 1, 2.0 + i, 8.0, 0.0, 0.1, "O")] * 2, schemas["lineitem"])
        line.coalesce(1).write.mode("append").parquet(f"{tmp_path}/lineitem.parquet")
    spark.createDataFrame([(10 + i, "gin", 5, 900.0) for i in range(3)], schemas["part"]).write.parquet(f"{tmp_path}/part.parquet")
    spark.createDataFrame([(1, "Acme")], schemas["supplier"]).write.parquet(f"{tmp_path}/supplier.parquet")
    monkeypatch.setattr(reports, "work_dir", lambda _, name: f"{tmp_path}/{name}")
    got = reports.csv_quoted_breaks(spark, str(tmp_path)).collect()
    assert [(r.vendornumber, r.rows, r.quantity) for r in got] == [(1, 6, 18)]
    assert got[0].characters == 6 * len('gin 10\n"Acme"')
    assert len(list((tmp_path / "csv-breaks").glob("part-*.csv"))) > 1


def test_chunked_load_goes_on_from_its_checkpoint(spark, tmp_path):
    source, target, checkpoint = tmp_path / "parts", str(tmp_path / "table"), str(tmp_path / "state")
    head = "vendornumber,ponumber,freight\n"
    write(source, **{"a.csv": f"{head}1,1,1.00\n"})
    load_in_chunks(spark, str(source), target, VENDOR_INVOICE, checkpoint=checkpoint)
    write(source, **{"b.csv": f"{head}2,2,2.00\n"})
    table = load_in_chunks(spark, str(source), target, VENDOR_INVOICE, checkpoint=checkpoint)
    assert sorted(r.vendornumber for r in table.collect()) == [1, 2]


def test_chunked_load_cleans_headers_and_empties_the_table(spark, tmp_path):
    source, target = tmp_path / "parts", str(tmp_path / "table")
    kinds = [f.dataType for f in VENDOR_INVOICE.fields]
    schema = T.StructType([T.StructField(n, k) for n, k in zip(["vendor_no", "po_number", "freight"], kinds)])
    write(source, **{"a.csv": "PO Number,Vendor No,Freight\n7,1,1.00\n"})
    assert tuple(load_in_chunks(spark, str(source), target, schema).first())[:2] == (1, 7)
    nothing = tmp_path / "nothing"
    nothing.mkdir()
    assert load_in_chunks(spark, str(nothing), target, schema).count() == 0
    write(source, **{"a.csv": "Vendor No,Freight\n1,1.00\n"})
    with pytest.raises(csv_folder.UnusableFile, match="po_number"):
        load_in_chunks(spark, str(source), target, schema)


def test_every_file_is_in_the_audit_without_loss(spark, tmp_path):
    source, target = tmp_path / "in", str(tmp_path / "out")
    head = "vendornumber,ponumber,freight\n"
    write(source, **{
        "empty.csv": "", "header only.csv": "a,b\n", "Vendor Invoice.csv": f"{head}1,2,1.0000000000004\n",
        "sales.csv": "Vendor No,brand\n1,2\n", "good.csv": "a,b\n1,x\n", f"{'n' * 140}.csv": "a\n1\n",
    })
    schemas = {**csv_folder.RAW_SCHEMAS, "vendor_invoice": VENDOR_INVOICE}
    audit = {r.file: r for r in csv_folder.load_folder(spark, str(source), target, schemas).collect()}
    assert {f: r.status for f, r in audit.items()} == {
        "empty.csv": "failed", "header only.csv": "loaded", "Vendor Invoice.csv": "failed", "sales.csv": "failed",
        "good.csv": "loaded", f"{'n' * 140}.csv": "failed",
    }
    assert audit["empty.csv"].condition == "UnusableFile" and audit["header only.csv"].rows == 0
    assert "1.0000000000004" in audit["Vendor Invoice.csv"].error
    assert "salesquantity" in audit["sales.csv"].error and "vendorno" in audit["sales.csv"].error


@pytest.mark.parametrize("text,places", [
    ("1.5000000000000004", 16), ("1.50", 1), ("-0.00", 0), ("12", 0), ("1e-3", 3), ("1.25E2", 0), ("1.255e1", 2),
    ("1000e-2", 0), (".5", 1), ("x", None), ("", None)])
def test_fraction_digits(spark, text, places):
    from pyspark.sql import functions as F

    assert spark.range(1).select(csv_folder.fraction_digits(F.lit(text)).alias("n")).first().n == places


def test_names_that_a_catalog_refuses():
    assert naming.clean_names(["Vendor No", "Übung-1"]) == ["vendor_no", "übung_1"]
    for bad in ("", "x" * 129):
        with pytest.raises(naming.UnusableName):
            naming.clean_name(bad)
