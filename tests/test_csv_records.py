"""Records over byte ranges, and records that are no rows."""

import csv
import io
import random

import pytest

from procurelens.schemas import VENDOR_INVOICE
from procurelens.sources import csv_folder, csv_records, snapshots, tables

TEXTS = ["plain", "two\nlines", 'say "hi"\n\n', " x, y", "", "é\n" * 9, '""', "\n", "a" * 50, 'x",\n"y']


@pytest.fixture
def ranges_of(spark):
    """Files are read in ranges of so many bytes."""
    keys = ["spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes"]
    old = {k: spark.conf.get(k) for k in keys}
    yield lambda n: [spark.conf.set(k, v) for k, v in zip(keys, (f"{n}b", "0"), strict=True)]
    for k, v in old.items():
        spark.conf.set(k, v)


def write_rows(path, rows, end="\n", tail=True):
    out = io.StringIO()
    csv.writer(out, lineterminator=end).writerows(rows)
    path.write_bytes(out.getvalue().removesuffix("" if tail else end).encode())


@pytest.mark.parametrize("size", [37, 200, 4000, 1_000_000])
@pytest.mark.parametrize("end,tail", [("\n", True), ("\r\n", False)])
def test_many_ranges_give_the_rows_of_one_task(spark, tmp_path, ranges_of, size, end, tail):
    rng = random.Random(size)
    rows = [[i, rng.choice(TEXTS), i * 2] for i in range(300 if size < 1000 else 2000)]
    write_rows(tmp_path / "m.csv", [["Id", "Some Text", "Twice"], *rows], end, tail)
    (tmp_path / "m.csv").chmod(0o644)
    whole = spark.read.options(header=True, quote='"', escape='"', multiLine=True).csv(str(tmp_path / "m.csv"))
    want = sorted((int(r[0]), r[1] or None, int(r[2])) for r in whole.collect())
    ranges_of(size)
    got = csv_folder.read_csv(spark, str(tmp_path / "m.csv"))
    assert got.columns == ["id", "some_text", "twice"] and got.schema["id"].dataType.simpleString() == "bigint"
    assert sorted(map(tuple, got.collect())) == want
    if size < 1000:
        assert csv_records.range_parities(csv_records.lines(spark, str(tmp_path / "m.csv"))).count() > 10


def test_records_that_cover_several_ranges(spark, tmp_path, ranges_of):
    long = "".join(f"line {i}\n" for i in range(200))
    write_rows(tmp_path / "m.csv", [["a", "b"], [1, long], [2, "x"], [3, long + '"'], [4, None]])
    ranges_of(64)
    got = csv_folder.read_csv(spark, str(tmp_path / "m.csv"))
    assert sorted(map(tuple, got.collect())) == [(1, long), (2, "x"), (3, long + '"'), (4, None)]


def test_part_files_of_one_table(spark, tmp_path, ranges_of):
    folder = tmp_path / "parts.csv"
    folder.mkdir()
    for k in range(3):
        write_rows(folder / f"p{k}.csv", [["a", "b"], *[[10 * k + i, "u\nv" * i] for i in range(5)]])
    ranges_of(30)
    got = csv_folder.read_csv(spark, str(folder))
    assert sorted(r.a for r in got.collect()) == [0, 1, 2, 3, 4, 10, 11, 12, 13, 14, 20, 21, 22, 23, 24]
    write_rows(folder / "p9.csv", [["a", "c"], [1, "u\nv"]])
    with pytest.raises(ValueError, match="headers"):
        csv_folder.read_csv(spark, str(folder))


def test_short_records_are_filled_and_long_ones_fail(spark, tmp_path):
    (tmp_path / "s.csv").write_text('a,b,c\n1,x\n2\n\n3,"y, z",w\n')
    assert sorted(map(tuple, csv_folder.read_csv(spark, str(tmp_path / "s.csv")).collect())) == [
        (1, "x", None), (2, None, None), (3, "y, z", "w")]
    for text in ("a,b\n1,2,3\n", 'a,b\n1,"x\ny",3\n', 'a,b\n1,5" pipe\n2,"x\ny"\n'):
        (tmp_path / "l.csv").write_text(text)
        with pytest.raises(Exception, match="fields instead of 2|quote marks"):
            csv_folder.read_csv(spark, str(tmp_path / "l.csv")).collect()


HEAD = "vendornumber,ponumber,freight,text\n"


def load(spark, folder, target, text, most):
    folder.mkdir(exist_ok=True)
    (folder / "Vendor Invoice.csv").write_text(text)
    (row,) = csv_folder.load_folder(spark, str(folder), target, max_rejects=most).collect()
    return row


def test_rejects_have_a_table_and_a_reason(spark, tmp_path):
    target = str(tmp_path / "out")
    text = HEAD + '1,7,1.50,ok\n1,x,2.00,bad number\n2,8,1.005,lost digits\n3,9,1.00,a,b\n4,10\n5,11,2.25,"two\nlines"\n6,12,0.50,5" pipe "x\n'
    got = load(spark, tmp_path / "in", target, text, 4)
    assert (got.status, got.rows, got.rejected) == ("loaded", 3, 4)
    rows = tables.read_path(spark, f"{target}/vendor_invoice").collect()
    assert sorted((r.vendornumber, str(r.freight), r.text) for r in rows) == [(1, "1.50", "ok"), (4, "None", None), (5, "2.25", "two\nlines")]
    bad = tables.read_path(spark, csv_folder.rejects_path(target, "vendor_invoice"))
    assert bad.columns == ["file", "block", "nth", "text", "reason"]
    assert sorted((r.nth, r.text.split(",")[0], r.reason) for r in bad.collect()) == [
        (2, "1", "ponumber does not fit bigint: x"), (3, "2", "freight does not fit decimal(15,2): 1.005"),
        (4, "3", "5 fields instead of 4"), (7, "6", "quote marks inside a field")]


def test_too_many_rejects_leave_the_old_table(spark, tmp_path):
    target = str(tmp_path / "out")
    assert load(spark, tmp_path / "in", target, HEAD + "1,7,1.50,a\n", 1).rejected == 0
    got = load(spark, tmp_path / "in", target, HEAD + "1,7,1.50,a\nx,7,1.50,a\ny,7,1.50,a\n", 1)
    assert (got.status, got.condition, got.rejected, got.rows) == ("failed", "TooManyRejects", 2, None)
    assert tables.read_path(spark, f"{target}/vendor_invoice").count() == 1
    assert tables.read_path(spark, csv_folder.rejects_path(target, "vendor_invoice")).count() == 2
    assert len(snapshots.versions(spark, f"{target}/vendor_invoice")) == 1
    assert VENDOR_INVOICE.names == tables.read_path(spark, f"{target}/vendor_invoice").columns[:3]
