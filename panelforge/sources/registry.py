"""Model registry as a table.

Entries are rows with arrays, maps and a metrics map, stored as JSON lines.
Upsert keeps old entries and replaces retrained ones by name (left anti join +
union), never a driver-side dict merge of data.

A registry is never changed in place. Each write makes a folder of its own
under ``versions`` and then commits it: a marker ``commits/<number>`` that names
the folder is written aside and renamed to its place, which fails if another
writer took the number. That writer's version is then read, the new entries
are merged into it, and the next number is tried. Readers take the version of
the highest marker, so a write that stops half-way is never seen, and of two
trainers none loses entries. The rename must not replace a file (so on HDFS).
A folder of JSON lines without ``commits``, as earlier releases wrote it, is
read as it is and becomes the base of the first commit.
"""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, LongType, MapType, StringType, StructField, StructType

from ..functions.exprs import drop_null_entries

REGISTRY_SCHEMA = StructType([
    StructField("name", StringType(), False),
    StructField("task", StringType(), False),
    StructField("description", StringType(), True),
    StructField("split", StringType(), True),
    StructField("selection_metric", StringType(), False),
    StructField("selected_algorithm", StringType(), False),
    StructField("all_algorithms", MapType(StringType(), MapType(StringType(), DoubleType())), True),
    StructField("best_hyperparameters", StringType(), True),
    StructField("metrics", MapType(StringType(), DoubleType()), False),
    StructField("numeric_features", ArrayType(StringType()), False),
    StructField("categorical_features", ArrayType(StringType()), False),
    StructField("categorical_values", MapType(StringType(), ArrayType(StringType())), True),
    StructField("class_labels", ArrayType(StringType()), True),
    StructField("n_train", LongType(), True),
    StructField("n_test", LongType(), True),
    StructField("trained_at", StringType(), True),
])
REQUIRED = ["name", "task", "selection_metric", "selected_algorithm", "metrics", "numeric_features", "categorical_features"]


class RegistryError(ValueError):
    """Registry missing, empty or malformed."""


class RegistryMissing(RegistryError):
    """Nothing lies at the registry's path."""


def entries_frame(spark: SparkSession, entries: list[dict]) -> DataFrame:
    """Rows of the registry; metrics without a value are left out."""
    return spark.createDataFrame(entries, REGISTRY_SCHEMA).withColumn("metrics", drop_null_entries("metrics"))


def upsert(old: DataFrame | None, new: DataFrame) -> DataFrame:
    """Keep old entries not retrained, replace the rest by name."""
    if old is None:
        return new
    return old.join(new.select("name"), "name", "left_anti").unionByName(new)


def _at(spark: SparkSession, *parts: str):
    """(file context, path) of a place in the registry."""
    path = spark._jvm.org.apache.hadoop.fs.Path("/".join(parts))
    uri = path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(path)
    return spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(uri.toUri(), spark._jsc.hadoopConfiguration()), uri


def committed(spark: SparkSession, path: str) -> tuple[int, str | None]:
    """Number and folder of the last committed version; (0, None) if there is none."""
    files, at = _at(spark, path, "commits")
    if not files.util().exists(at):
        return 0, None
    names = [s.getPath().getName() for s in files.util().listStatus(at)]
    last = max((n for n in names if n.isdigit()), default=None)
    if last is None:
        return 0, None
    stream = files.open(_at(spark, path, "commits", last)[1])
    reader = spark._jvm.java.io.BufferedReader(spark._jvm.java.io.InputStreamReader(stream, "UTF-8"))
    try:
        return int(last), f"{path}/versions/{reader.readLine()}"
    finally:
        reader.close()


def _commit(spark: SparkSession, path: str, number: int, folder: str) -> bool:
    """Makes ``folder`` the version ``number``; False if there is one already."""
    files, place = _at(spark, path, "commits", f"{number:012d}")
    fs = place.getFileSystem(spark._jsc.hadoopConfiguration())
    aside = _at(spark, path, "commits", f".{folder}")[1]
    out = fs.create(aside, True)
    out.write(bytearray(folder.encode()))
    out.close()
    try:
        files.rename(aside, place, spark.sparkContext._gateway.new_array(spark._jvm.org.apache.hadoop.fs.Options.Rename, 0))
    except Py4JJavaError as e:
        if "FileAlreadyExistsException" not in e.java_exception.getClass().getName():
            raise
        fs.delete(aside, False)
        return False
    return True


def _write_version(df: DataFrame, path: str) -> str:
    folder = uuid.uuid4().hex
    df.coalesce(1).write.mode("errorifexists").json(f"{path}/versions/{folder}")
    return folder


def write_registry(df: DataFrame, path: str) -> None:
    """``df`` as the whole registry, whatever was there before."""
    spark, folder = df.sparkSession, _write_version(df, path)
    while not _commit(spark, path, committed(spark, path)[0] + 1, folder):
        pass  # another writer was faster; the numbers only grow


def commit_entries(new: DataFrame, path: str) -> DataFrame:
    """``new`` merged into the registry (by name) and committed; returns
    the registry as committed. A writer that comes second merges again."""
    spark = new.sparkSession
    while True:
        number, base = committed(spark, path)
        try:
            old = _read(spark, path, base)
        except RegistryMissing:
            old = None  # the first training run
        folder = _write_version(upsert(old, new), path)
        if _commit(spark, path, number + 1, folder):
            return spark.read.schema(REGISTRY_SCHEMA).json(f"{path}/versions/{folder}")


def read_registry(spark: SparkSession, path: str) -> DataFrame:
    """Typed read of the last committed version; missing or empty registry
    and missing fields are errors."""
    return _read(spark, path, committed(spark, path)[1])


def _only_uncommitted(spark: SparkSession, path: str) -> bool:
    """Nothing lies there but versions of writes that did not end."""
    files, at = _at(spark, path)
    if not files.util().exists(at):
        return False
    names = {s.getPath().getName() for s in files.util().listStatus(at)}
    return bool(names) and names <= {"versions", "commits"}


def _read(spark: SparkSession, path: str, folder: str | None) -> DataFrame:
    try:
        if not folder and _only_uncommitted(spark, path):
            raise RegistryMissing(f"registry has no committed version: {path}")
        df = spark.read.schema(REGISTRY_SCHEMA).json(folder or path)
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            raise RegistryMissing(f"registry not found: {path}") from e
        raise
    if df.isEmpty():
        raise RegistryError("registry has no models")
    bad = df.where(" OR ".join(f"{c} IS NULL" for c in REQUIRED)).limit(1).collect()
    if bad:
        raise RegistryError(f"registry entry {bad[0]['name']!r} lacks required fields {REQUIRED}")
    return df


def overview(registry: DataFrame) -> DataFrame:
    """Name, task, algorithm, selection metric and its value
    (3 decimals for classification, 2 for regression)."""
    value = F.element_at("metrics", F.col("selection_metric"))
    shown = F.when(F.col("task") == "classification", F.format_number(value, 3)).otherwise(F.format_number(value, 2))
    return registry.select("name", "task", "selected_algorithm", "selection_metric", value.alias("value"), shown.alias("value_text"))


def lookup(registry: DataFrame, name: str) -> dict:
    """One entry by name; unknown names raise with the known list."""
    rows = registry.where(F.col("name") == name).limit(2).collect()
    if len(rows) > 1:
        raise RegistryError(f"registry has more than one entry {name!r}")
    if not rows:
        known = [r["name"] for r in registry.select("name").collect()]
        raise KeyError(f"unknown model {name!r}; available: {known}")
    return rows[0].asDict(recursive=True)
