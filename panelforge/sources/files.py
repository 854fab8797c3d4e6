"""File sources and sinks: validated CSV tables (S1-S8), extract unions (S9),
CSV / JSON / parquet sinks (S10, S11).

Schemas are explicit ``StructType``s; each file's header is checked against the
required names before the typed read, so a wrong file fails fast with the
missing names rather than with NULL columns.
"""

from __future__ import annotations

import csv
import os
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from ..schema import DATE_COLUMNS, DOMAIN_SCHEMAS, FILE_NAMES, OPTIONAL_NUMBERS, OPTIONAL_REQUIRED


class InvalidTableError(ValueError):
    """A source that was read lacks required columns, or has no rows."""


class MissingDataError(FileNotFoundError):
    """A required data file is absent."""


@contextmanager
def _existing(path: str):
    """Spark's own answer decides whether a path exists, on any file system."""
    try:
        yield
    except AnalysisException as exc:
        if exc.getCondition() == "PATH_NOT_FOUND":
            raise MissingDataError(f"data not found: {path}") from exc
        raise


#: Files whose first lines are fetched at a time.
HEADER_THREADS = 16


def _first_line(spark: SparkSession, file: str) -> str | None:
    """The first line of a file on any file system; None if it is empty."""
    jvm = spark._jvm
    path = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(file))
    stream = path.getFileSystem(spark._jsc.hadoopConfiguration()).open(path)
    reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(stream, "UTF-8"))
    try:
        return reader.readLine()
    finally:
        reader.close()


def _headers(spark: SparkSession, path: str) -> dict[tuple[str, ...], list[str]]:
    """The files under ``path`` by their header; empty files are left out."""
    with _existing(path):
        files = sorted(spark.read.text(path).inputFiles())
    with ThreadPoolExecutor(HEADER_THREADS) as pool:
        lines = list(pool.map(lambda f: _first_line(spark, f), files))
    found: dict[tuple[str, ...], list[str]] = {}
    for file, line in zip(files, lines, strict=True):
        if line is not None:
            names = next(csv.reader([line.removeprefix("\ufeff")]), [])
            found.setdefault(tuple(c.strip() for c in names), []).append(file)
    return found


def read_validated_csv(spark: SparkSession, path: str, schema: StructType, required: Sequence[str],
                       date_columns: Sequence[str] = (), multiline: bool = True) -> DataFrame:
    """Header + UTF-8 BOM CSV; required columns checked (extras allowed);
    empty table rejected; bad dates become NULL; text 'NaN' in numbers -> NULL.

    ``path`` is a file or a folder. Each file is read by its own header, so
    columns may stand in another order from file to file, and one that only some
    files have is NULL in the others. Quotes inside quotes are doubled, and a
    quoted field may hold line breaks; ``multiline=False`` gives that up, so that
    large files can be split among tasks."""
    headers = _headers(spark, path)
    for header, files in headers.items() or [((), [path])]:
        missing = [c for c in required if c not in header]
        if missing:
            raise InvalidTableError(f"{os.path.basename(files[0])}: missing expected columns {missing}")
        if len(set(header)) < len(header):
            raise InvalidTableError(f"{os.path.basename(files[0])}: columns that occur twice {sorted({c for c in header if header.count(c) > 1})}")
    options = {"header": True, "encoding": "UTF-8", "escape": '"', "multiLine": multiline}
    parts = []
    for header, files in headers.items():
        # every present column as text in header order, typed afterwards
        text_schema = StructType([StructField(c, StringType(), True) for c in header])
        parts.append(spark.read.options(**options).schema(text_schema).csv(files))
    raw = union_extracts(parts)
    known = {f.name: f for f in schema.fields}
    cols = []
    for c in raw.columns:
        name = F.col(f"`{c}`")
        f = known.get(c)
        if f is None:
            cols.append(name)
        elif c in date_columns:
            cols.append(F.try_to_date(name, "yyyy-MM-dd").alias(c))
        else:
            typed = name.try_cast(f.dataType)
            if isinstance(f.dataType, DoubleType):
                typed = F.nanvl(typed, F.lit(None).cast("double"))
            cols.append(typed.alias(c))
    df = raw.select(*cols)
    if df.isEmpty():
        raise InvalidTableError(f"{os.path.basename(path)}: the file has no rows")
    return df


def load_table(spark: SparkSession, name: str, data_dir: str) -> DataFrame:
    """One of pacientes, consumo, donaciones, items, capturas_ia."""
    if name not in DOMAIN_SCHEMAS:
        raise KeyError(f"unknown table {name!r}")
    schema = DOMAIN_SCHEMAS[name]
    return read_validated_csv(spark, os.path.join(data_dir, FILE_NAMES[name]), schema,
                              [f.name for f in schema.fields], DATE_COLUMNS.get(name, ()))


def load_all(spark: SparkSession, data_dir: str) -> dict[str, DataFrame]:
    """The five domain tables (lazy after the header checks)."""
    return {name: load_table(spark, name, data_dir) for name in DOMAIN_SCHEMAS}


def load_optional(spark: SparkSession, name: str, path: str) -> DataFrame:
    """Triage / discharge extracts. Number columns are doubles (text that
    is no number becomes NULL), the others text; extra columns are allowed."""
    numbers = StructType([StructField(c, DoubleType(), True) for c in OPTIONAL_NUMBERS[name]])
    return read_validated_csv(spark, path, numbers, OPTIONAL_REQUIRED[name])


def union_extracts(frames: Sequence[DataFrame]) -> DataFrame:
    """Row concatenation by column name; absent columns become NULL."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def filter_tag_extract(df: DataFrame, predicate: Column, year: int | Column, col: str = "anio_alta") -> DataFrame:
    """Keep the rows of interest of one yearly extract and tag their year."""
    return df.where(predicate).withColumn(col, year if isinstance(year, Column) else F.lit(year))


def save_table(df: DataFrame, path: str, fmt: str = "parquet", partition_by: Sequence[str] = ()) -> None:
    """Overwrite a directory sink (parquet default; csv with header; json lines)."""
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    if fmt == "csv":
        w.option("header", True).csv(path)
    elif fmt == "json":
        w.json(path)
    else:
        w.parquet(path)


def load_json(spark: SparkSession, path: str, schema: StructType | None = None, multiline: bool = True) -> DataFrame:
    """JSON file (an object or a list of objects); missing -> error."""
    r = spark.read.option("multiLine", multiline)
    if schema is not None:
        r = r.schema(schema)
    with _existing(path):
        return r.json(path)


def load_requests(spark: SparkSession, path: str) -> DataFrame:
    """Request files, each holding one JSON object or a list of objects.

    Every file is one body (``wholetext``), keyed by its path; the bodies go
    through ``operators.validation.explode_bodies``.
    """
    with _existing(path):
        raw = spark.read.text(path, wholetext=True)
    return raw.select(F.input_file_name().alias("request_id"), F.col("value").alias("body"))


def contract_violations(df: DataFrame, contract: StructType) -> DataFrame:
    """Per contract column, rows that break it: NULL in a NOT NULL column
    or a value that does not cast to the contract type. One aggregate."""
    aggs = []
    for f in contract.fields:
        if f.name not in df.columns:
            aggs.append(F.count(F.lit(1)).alias(f.name))
            continue
        c = F.col(f.name)
        bad_type = c.isNotNull() & c.try_cast(f.dataType).isNull()
        bad_null = c.isNull() if not f.nullable else F.lit(False)
        aggs.append(F.sum((bad_type | bad_null).cast("long")).alias(f.name))
    one = df.agg(*aggs)
    rows = [F.struct(F.lit(f.name).alias("columna"), F.coalesce(F.col(f.name), F.lit(0)).alias("violaciones")) for f in contract.fields]
    return one.select(F.explode(F.array(*rows)).alias("_r")).select("_r.*")
