"""Small helpers shared by the operators: words, table reads, intermediate tables."""

from __future__ import annotations

import contextlib
import gc
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from postwise.session import scratch_path
from postwise.sources.tables import read_table, spread

#: The characters between words: space and U+0009 to U+000D.
BLANKS = " \t\n\x0b\x0c\r"
BLANK_RE = "[\\x20\\x09-\\x0D]+"


def words(text: Column) -> Column:
    """Array of the words of a text (maximal runs of non-blank characters); empty for null."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), BLANK_RE), "")


def bind(value: Column, body) -> Column:
    """``body`` of a value that is evaluated once.

    A column captured by a lambda may be replaced by its expression when projections are
    merged or filters pushed down, and then be evaluated for every element; a lambda's own
    argument is not.
    """
    return F.get(F.transform(F.array(value), body), 0)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(read_table(spark, sf_dir, "documents"))


def materialise(df: DataFrame, name: str, **options: str) -> DataFrame:
    """Write a table to the shared checkpoint folder and read it back.

    Cuts the lineage (a lost executor re-reads files instead of recomputing)
    and fixes the rows, so that later stages see one and the same numbering. ``options`` are the Parquet writer's.
    """
    path = scratch_path(df.sparkSession, "postwise-llm", f"{name}-{uuid.uuid4().hex}")
    df.write.options(compression="zstd", **options).parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.written_to = path
    return out


@contextlib.contextmanager
def rows_at_a_time(spark: SparkSession, n: int):
    """Within this, actions send ``n`` rows to Python at a time: for rows of some megabytes each."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(n))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def discard(*tables: DataFrame) -> None:
    """Delete tables of :func:`materialise` that nothing reads any more."""
    for t in tables:
        jvm = t.sparkSession.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(t.written_to)
        path.getFileSystem(t.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def sweep(spark: SparkSession) -> None:
    """Have the shuffle files of finished steps removed from the executors' disks.

    Spark removes them once the driver's JVM has collected the plans that made them; a driver with
    free memory may not do so for many steps.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def with_row_id(df: DataFrame, name: str = "_rid") -> DataFrame:
    """A number per input row that differs for every row, also where ids repeat or are null.

    The number follows from the file split and the row's place in it; use it within one
    plan, or after :func:`materialise`.
    """
    return df.withColumn(name, F.monotonically_increasing_id())
