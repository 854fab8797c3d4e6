"""Small helpers shared by the corpus operators."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import checkpoint_dir

#: What stands between words: space and the controls 0x09-0x0D.
BLANKS = r"[\x20\x09-\x0D]+"

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def ascii_lower(c: Column) -> Column:
    """Lower-cases A-Z only; every other character stays."""
    ascii_only = F.octet_length(c) == F.char_length(c)
    return F.when(ascii_only, F.lower(c)).otherwise(F.translate(c, _UPPER, _UPPER.lower()))


def words(text: Column, between: str = BLANKS) -> Column:
    """The longest runs free of ``between``; a null text has none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), between), "")


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once per row.

    A column used several times inside a lambda is pasted into the lambda by
    the optimizer and computed again for each element; a lambda variable is
    not.
    """
    return F.transform(F.array(value), body)[0]


def upto(n: Column) -> Column:
    """0, 1, ..., n - 1; empty when n is 0 or less."""
    return F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))


_made: ContextVar[list[str] | None] = ContextVar("made", default=None)


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new place in the folder that all executors share."""
    path = f"{checkpoint_dir(spark).rstrip('/')}/corpus-{name}-{uuid.uuid4().hex}"
    if (made := _made.get()) is not None:
        made.append(path)
    return path


@contextmanager
def intermediate(spark: SparkSession) -> Iterator[None]:
    """Folders made inside are removed at the end. What is still needed then
    must be written outside, or before in full: tables are read lazily."""
    token = _made.set([])
    try:
        yield
    finally:
        made = _made.get()
        _made.reset(token)
        for folder in made:
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


_ARROW_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def shared(df: DataFrame, name: str, arrow_rows: int | None = None) -> DataFrame:
    """``df`` written as Parquet in the folder that all executors share, and read back.

    Cuts the lineage: a lost executor costs no recomputation of what came
    before, and a table that is read several times is computed once.
    ``arrow_rows``: rows that go to a Python worker at once while this table
    is written (the session's setting is put back).
    """
    spark = df.sparkSession
    path = shared_folder(spark, name)
    usual = spark.conf.get(_ARROW_ROWS)
    try:
        if arrow_rows:
            spark.conf.set(_ARROW_ROWS, str(arrow_rows))
        df.write.parquet(path)
    finally:
        spark.conf.set(_ARROW_ROWS, usual)
    return spark.read.schema(df.schema).parquet(path)


#: A side of at most so many rows of a few numbers (some tens of MB) may be broadcast.
BROADCAST_ROWS = 500_000


def small(df: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` with a broadcast hint if it has at most ``limit`` rows, else as
    it is (the join then shuffles). ``df`` should be a written table: its
    rows are counted first, ``limit + 1`` at most."""
    return F.broadcast(df) if df.limit(limit + 1).count() <= limit else df


def unused(name: str, *tables: DataFrame) -> str:
    """``name``, or the next like it that no column of the ``tables`` has."""
    taken = {c.lower() for t in tables for c in t.columns}
    while name.lower() in taken:
        name += "_"
    return name
