"""Load every CSV of a folder as one Parquet table, with an audit of the run."""

from __future__ import annotations

import re
import time
from concurrent.futures import ThreadPoolExecutor
from dataclasses import astuple, dataclass
from urllib.parse import unquote

from pyspark import inheritable_thread_target
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from procurelens.functions.numbers import lenient_double
from procurelens.schemas import RAW_SCHEMAS
from procurelens.sources import csv_records
from procurelens.sources.naming import UnusableName, clean_names, table_name
from procurelens.sources.tables import read_path, replace_path

# Texts that stand for a missing value in a CSV field (fixed values).
MISSING = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]

# Fixed values of the format: header row, quotes doubled inside quotes, no broken records.
CSV_OPTIONS = {"header": True, "quote": '"', "escape": '"', "mode": "FAILFAST", "enforceSchema": False}

AUDIT_SCHEMA = (
    "file string, table string, rows bigint, rejected bigint, status string, condition string, error string, seconds double"
)


@dataclass
class Load:
    file: str
    table: str | None
    rows: int | None
    rejected: int | None
    status: str
    condition: str | None
    error: str | None
    seconds: float


class UnusableFile(ValueError):
    """A file without a header, or without columns that its schema names."""


class TooManyRejects(ValueError):
    """A file with more records that are no rows than allowed."""


def list_csv(spark: SparkSession, folder: str) -> list[str]:
    """Names in the folder that end in .csv in any case: files, or folders of part files.

    Only the listing is read, never the content, so a file of zero bytes is named as well. A
    folder that is missing or has no CSV gives an empty list.
    """
    root = folder.rstrip("/")
    try:
        paths = spark.read.format("binaryFile").load(f"{root}/*.[cC][sS][vV]").inputFiles()
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return []
        raise
    base = re.escape(root.split("/")[-1])
    # The entry is the path part that follows the folder.
    entry = re.compile(rf"/{base}/([^/]+\.csv)(/[^/]+)?$", re.IGNORECASE)
    found = (entry.search(unquote(path)) for path in paths)
    return sorted({match[1] for match in found if match})


def present(name: str) -> Column:
    """The text of a field, NULL where it stands for a missing value."""
    return F.when(~F.col(name).isin(MISSING), F.col(name))


def _about(field: str) -> Column:
    return F.col(f"`{csv_records.ABOUT}`.{field}")


def _named(names: list[str], schema: T.StructType | None) -> list[str]:
    """Cleaned column names of a file; an error if it lacks columns of the schema."""
    if not names:
        raise UnusableFile("the file has no header")
    cleaned = clean_names(names)
    absent = [f.name for f in schema.fields if f.name not in cleaned] if schema else []
    if absent:
        raise UnusableFile(f"the file lacks the columns {absent}")
    return cleaned


def _lines_as_rows(spark: SparkSession, path: str, schema: T.StructType | None) -> DataFrame:
    """Text columns of a CSV whose records are single lines; a record with too many fields is an error."""
    given = spark.read.options(**CSV_OPTIONS).csv(path).columns
    names, broken = _named(given, schema), "_broken"
    while broken in names or broken in given:
        broken += "_"
    texts = T.StructType([T.StructField(n, T.StringType()) for n in [*given, broken]])
    options = {**CSV_OPTIONS, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": broken}
    rows = spark.read.schema(texts).options(**options).csv(path).toDF(*names, broken)
    count = csv_records.field_count(F.col(broken))
    wrong = F.raise_error(F.concat(count.cast("string"), F.lit(f" fields instead of {len(names)}: "), F.col(broken)))
    first = F.when(F.col(broken).isNotNull() & (count > len(names)), wrong).otherwise(F.col(names[0]))
    return rows.select(first.alias(names[0]), *names[1:])


def _joined_rows(spark: SparkSession, path: str, schema: T.StructType | None) -> DataFrame:
    """``csv_records.ABOUT`` of the records of a path and their fields as text columns."""
    names, body = csv_records.split_header(csv_records.records(spark, path))
    return csv_records.parsed(body, _named(names, schema))


def read_csv(
    spark: SparkSession, path: str, schema: T.StructType | None = None, multi_line: bool | None = None
) -> DataFrame:
    """A comma CSV with a header row, its column names cleaned.

    With a schema, columns are matched by their cleaned names and cast strictly, without loss
    of decimals; a file must have all of them, and columns the schema does not know keep an
    inferred type. Fields that a record lacks at its end are NULL, too many are an error.

    Records may hold line breaks inside quotes (``csv_records``); ``multi_line`` says so, by default
    a pass over the text finds out. Either way a file is split over tasks.
    """
    if csv_records.has_line_breaks(spark, path) if multi_line is None else multi_line:
        rows = _joined_rows(spark, path, schema)
        names = rows.columns[1:]
        wrong = F.raise_error(F.concat(_about("reason"), F.lit(": "), _about("text")))
        text = rows.select(F.when(_about("reason").isNotNull(), wrong).otherwise(F.col(names[0])).alias(names[0]), *names[1:])
    else:
        text = _lines_as_rows(spark, path, schema)
    text = text.select(*[present(c).alias(c) for c in text.columns])
    known = {f.name: f.dataType for f in schema.fields} if schema else {}
    types = infer_types(text.select(*[c for c in text.columns if c not in known]))
    return text.select(
        *[exact_cast(c, known[c]).alias(c) if c in known else _typed(c, types[c]) for c in text.columns]
    )


def read_judged(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Every record of a CSV: where it is, its text and reason in ``csv_records.ABOUT``, and its typed fields.

    ``reason`` is NULL for rows; for the others it says why the record is none: broken quotes, too
    many fields, or the first field that does not fit its type.
    """
    rows = _joined_rows(spark, path, schema)
    names = rows.columns[1:]
    rows = rows.select(f"`{csv_records.ABOUT}`", *[present(c).alias(c) for c in names])
    known = {f.name: f.dataType for f in schema.fields} if schema else {}
    types = infer_types(rows.where(_about("reason").isNull()).select(*[c for c in names if c not in known]))
    misfits = [
        F.when(misfit(c, known[c]), F.concat(F.lit(f"{c} does not fit {known[c].simpleString()}: "), F.col(c))) for c in names if c in known
    ]
    reason = F.coalesce(_about("reason"), *misfits)
    typed = [F.col(c).try_cast(known[c]).alias(c) if c in known else _typed(c, types[c]) for c in names]
    return rows.select(F.col(f"`{csv_records.ABOUT}`").withField("reason", reason).alias(csv_records.ABOUT), *typed)


def misfit(name: str, kind: T.DataType) -> Column:
    """Whether a text is there but no value of the type, or would lose digits as a decimal."""
    text = F.col(name)
    lost = text.isNotNull() & text.try_cast(kind).isNull()
    return lost | F.coalesce(fraction_digits(text) > kind.scale, F.lit(False)) if isinstance(kind, T.DecimalType) else lost


def fraction_digits(text: Column) -> Column:
    """Decimal places that a number as text needs, exponent counted in; NULL for other texts."""
    part = lambda i: F.regexp_extract(text, r"^\s*[+-]?(\d*)\.?(\d*)(?:[eE]([+-]?\d+))?\s*$", i)
    digits = F.concat(part(1), part(2))
    short = F.regexp_replace(digits, "0+$", "")
    places = F.length(part(2)) - F.coalesce(part(3).try_cast("int"), F.lit(0)) - (F.length(digits) - F.length(short))
    return F.when(digits == "", None).when(short == "", 0).otherwise(F.greatest(places, F.lit(0)))


def exact_cast(name: str, kind: T.DataType) -> Column:
    """A strict cast; a decimal that would lose digits is an error as well."""
    text = F.col(name)
    if not isinstance(kind, T.DecimalType):
        return text.cast(kind)
    lossy = F.concat(F.lit(f"{name} does not fit {kind.simpleString()}: "), text)
    # Most numbers are plain and short enough as they stand; one match spares counting their digits.
    short = text.rlike(rf"^[+-]?\d+(\.\d{{0,{kind.scale}}})?$")
    return F.when(~short & (fraction_digits(text) > kind.scale), F.raise_error(lossy)).otherwise(text.cast(kind))


def _typed(name: str, kind: str) -> Column:
    column = F.col(name)
    if kind == "double":
        return lenient_double(column).alias(name)
    return column.cast(kind).alias(name)


def infer_types(text: DataFrame) -> dict[str, str]:
    """The narrowest of bigint, double, boolean and string that fits all values of a column.

    One aggregate over the whole table, so no type depends on which rows come first. Whole
    numbers with gaps are doubles.
    """
    if not text.columns:
        return {}
    measures = []
    for c in text.columns:
        column = F.col(c)
        measures.append(
            F.struct(
                F.count("*").alias("rows"),
                F.count(column).alias("present"),
                F.count(F.when(column.rlike(r"^\s*[+-]?\d+\s*$"), column.try_cast("bigint"))).alias("whole"),
                F.count(lenient_double(column)).alias("number"),
                F.count(F.when(column.isin("True", "TRUE", "true", "False", "FALSE", "false"), 1)).alias("truth"),
            ).alias(c)
        )
    row = text.agg(*measures).first()

    def kind(m) -> str:
        if m.present == 0:
            return "double" if m.rows else "string"
        if m.whole == m.rows:
            return "bigint"
        if m.number == m.present:
            return "double"
        return "boolean" if m.truth == m.rows else "string"

    return {c: kind(row[c]) for c in text.columns}


def load_file(
    spark: SparkSession, folder: str, file: str, target: str, schema: T.StructType | None, multi_line: bool | None,
    max_rejects: int = 0,
) -> Load:
    """One file to one table, replaced as a whole; an error is reported, not raised."""
    table, start, rejected = table_name(file), time.time(), 0
    source, path = f"{folder.rstrip('/')}/{file}", f"{target.rstrip('/')}/{table}"
    try:
        observed = Observation(f"rows of {table}")
        if max_rejects:
            rejected = _load_judged(spark, read_judged(spark, source, schema), path, rejects_path(target, table), max_rejects, observed)
        else:
            replace_path(read_csv(spark, source, schema, multi_line).observe(observed, F.count(F.lit(1)).alias("rows")), path)
        return Load(file, table, observed.get["rows"], rejected, "loaded", None, None, time.time() - start)
    except Exception as error:
        condition = getattr(error, "getCondition", lambda: None)() or type(error).__name__
        return Load(file, table, None, getattr(error, "rejected", None), "failed", condition, str(error), time.time() - start)


def rejects_path(target: str, table: str) -> str:
    """Where the records of a load lie that are no rows: (file, block, nth, text, reason)."""
    return f"{target.rstrip('/')}/_rejects/{table}"


def _load_judged(spark: SparkSession, judged: DataFrame, path: str, rejects: str, most: int, observed: Observation) -> int:
    """Put the rows in force if at most ``most`` records are none; counts come from the write itself."""
    reason = _about("reason")
    counts = F.count_if(reason.isNull()).alias("rows"), F.count(reason).alias("rejected")
    rows = judged.observe(observed, *counts).where(reason.isNull()).drop(csv_records.ABOUT)
    bad = judged.where(reason.isNotNull()).select(F.expr(f"`{csv_records.ABOUT}`.*"))

    def few(_: DataFrame) -> None:
        n = observed.get["rejected"]
        if n:
            replace_path(bad, rejects)
        if n > most:
            error = TooManyRejects(f"{n} records are no rows, {most} are allowed; {rejects} has them")
            error.rejected = n
            raise error

    replace_path(rows, path, few)
    if not observed.get["rejected"]:
        replace_path(spark.createDataFrame([], bad.schema), rejects)
    return observed.get["rejected"]


def load_folder(
    spark: SparkSession,
    folder: str,
    target: str,
    schemas: dict[str, T.StructType] | None = None,
    parallel: int = 4,
    multi_line: bool | None = None,
    max_rejects: int = 0,
) -> DataFrame:
    """Load all CSVs of a folder into Parquet tables under ``target``; return the audit.

    A file that fails leaves the others alone, and the table that it would have replaced. With
    ``max_rejects`` up to that many records of a file may be no rows; they go to a table of their own
    (``rejects_path``) with the reason, and more than that fail the file. Files whose names give the same table are all
    reported as failed, for one would silently replace the other. The audit is also written
    to ``target/_load_audit``, a name that table listings skip.
    """
    schemas = RAW_SCHEMAS if schemas is None else schemas
    files = list_csv(spark, folder)
    named: dict[str, str | UnusableName] = {}
    for file in files:
        try:
            named[file] = table_name(file)
        except UnusableName as error:
            named[file] = error
    tables = list(named.values())

    def load(file: str) -> Load:
        table = named[file]
        if isinstance(table, UnusableName):
            return Load(file, None, None, None, "failed", "UnusableName", str(table), 0.0)
        if tables.count(table) > 1:
            return Load(file, table, None, None, "failed", "NameCollision", f"several files give the table {table}", 0.0)
        return load_file(spark, folder, file, target, schemas.get(table), multi_line, max_rejects)

    with ThreadPoolExecutor(max(1, parallel)) as pool:
        loads = list(pool.map(inheritable_thread_target(spark)(load), files))
    audit = spark.createDataFrame([astuple(one) for one in loads], AUDIT_SCHEMA)
    if loads:
        audit.write.mode("overwrite").parquet(f"{target.rstrip('/')}/_load_audit")
    return audit


def loaded_tables(spark: SparkSession, target: str, names: list[str]) -> dict[str, DataFrame]:
    return {n: read_path(spark, f"{target.rstrip('/')}/{n}") for n in names}
