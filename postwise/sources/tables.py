"""Reading the given parquet tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One driver table; Catalyst prunes columns and pushes filters into the scan."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def spread(df: DataFrame, min_partitions: int | None = None) -> DataFrame:
    """Give heavy per-row work at least one partition per core.

    A source with fewer partitions than the cluster's default parallelism
    (a small file, or a file of one Parquet row group) would run all
    downstream per-row work in that many tasks; it is round-robin
    repartitioned (to at most ``spark.sql.shuffle.partitions`` tasks, so a
    small file does not become thousands of tiny tasks on a big cluster).
    Sources already split into enough partitions (the normal case on a
    cluster) are left alone, so this adds no shuffle there.
    """
    spark = df.sparkSession
    try:
        target = min_partitions or min(spark.sparkContext.defaultParallelism,
                                       int(spark.conf.get("spark.sql.shuffle.partitions")))
        current = df.rdd.getNumPartitions()
    except Exception:  # noqa: BLE001 - sessions without RDD access: leave as is
        return df
    if current < target:
        return df.repartition(target)
    return df
