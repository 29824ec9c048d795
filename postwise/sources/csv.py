"""Delimited posting files.

Read with an explicit all-string schema (no inference): header line, ``"``
quoting with doubled quotes, blanks after a delimiter skipped, UTF-8,
PERMISSIVE. Short rows are padded with NULLs (as pandas does); over-long
rows put their extra field into ``_overflow`` and go to the rejects.
``multiLine`` stays off by default so large files split across tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Header names of the source file and our column names (fixed values).
CSV_HEADER: list[tuple[str, str]] = [
    ("Job Title", "job_title"), ("Company Name", "company_name"), ("Industry", "industry"),
    ("Location", "location"), ("Salary", "salary"), ("Job Type", "job_type"),
    ("Experience Level", "experience_level"), ("Education Level", "education_level"),
    ("Posting Date", "posting_date"), ("Source Agency", "source_agency"),
]

# pandas' default missing-value tokens (read_csv na_values defaults).
NULL_TOKENS: list[str] = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]


def csv_schema(header: list[tuple[str, str]] = CSV_HEADER) -> T.StructType:
    fields = [T.StructField(name, T.StringType(), True) for _, name in header]
    return T.StructType(fields + [T.StructField("_overflow", T.StringType(), True)])


def read_postings_csv(spark: SparkSession, path: str, multiline: bool = False,
                      header: list[tuple[str, str]] = CSV_HEADER) -> DataFrame:
    """Postings CSV -> DataFrame (snake_case string columns, ``_overflow``,
    ``source_file``)."""
    df = (spark.read.schema(csv_schema(header))
          .option("header", True).option("quote", '"').option("escape", '"')
          .option("ignoreLeadingWhiteSpace", True).option("mode", "PERMISSIVE")
          .option("encoding", "UTF-8").option("multiLine", multiline)
          .option("enforceSchema", True)
          .csv(path))
    return df.select("*", F.col("_metadata.file_path").alias("source_file"))


def null_tokens(df: DataFrame, columns: list[str] | None = None, tokens: list[str] = NULL_TOKENS) -> DataFrame:
    """Values equal to a missing-value token become NULL."""
    columns = columns or [name for _, name in CSV_HEADER if name in df.columns]
    return df.select(*[F.when(F.col(c).isin(tokens), F.lit(None).cast("string")).otherwise(F.col(c)).alias(c)
                       if c in columns else F.col(c) for c in df.columns])


def split_overlong(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """F5/DQ4: (rows of the right width, over-long rows)."""
    return df.where(F.col("_overflow").isNull()).drop("_overflow"), df.where(F.col("_overflow").isNotNull())


def land_raw(df: DataFrame, run_ts: str, mapped: list[str] | None = None) -> DataFrame:
    """S3: raw landing shape: lineage (source file, load time) and every
    column outside ``mapped`` folded into an ``extra`` JSON object."""
    mapped = mapped or [name for _, name in CSV_HEADER]
    extra_cols = [c for c in df.columns if c not in mapped and c not in ("source_file", "_overflow")]
    extra = F.to_json(F.struct(*extra_cols)) if extra_cols else F.lit(None).cast("string")
    src = F.col("source_file") if "source_file" in df.columns else F.lit(None).cast("string")
    return df.select(
        src.alias("source_file"), F.lit(run_ts).cast("timestamp_ntz").alias("load_timestamp"),
        F.lit(None).cast("timestamp_ntz").alias("timestamp_collected"),
        F.col("job_title"), F.col("company_name"), F.col("industry"), F.col("location").alias("location_raw"),
        F.col("salary").alias("salary_raw"), F.col("job_type"), F.col("experience_level"),
        F.col("education_level"), F.col("posting_date").alias("posting_date_raw"), F.col("source_agency"),
        extra.alias("extra"))


def write_postings_csv(df: DataFrame, path: str, header: list[tuple[str, str]] = CSV_HEADER) -> None:
    """Write postings as a headed CSV (used to produce test inputs from tables)."""
    out = df.select(*[F.col(name).alias(h) for h, name in header])
    out.write.mode("overwrite").option("header", True).option("quote", '"').option("escape", '"').csv(path)


def jdbc_options(url: str, table: str, user_env: str = "DB_USER", password_env: str = "DB_PASSWORD",
                 **extra) -> dict:
    """Connection options with credentials taken from the environment."""
    import os

    opts = {"url": url, "dbtable": table}
    if os.environ.get(user_env):
        opts["user"] = os.environ[user_env]
    if os.environ.get(password_env):
        opts["password"] = os.environ[password_env]
    opts.update({k: str(v) for k, v in extra.items()})
    return opts


def write_jdbc(df: DataFrame, options: dict, mode: str = "append", batchsize: int = 1000,
               num_partitions: int | None = None) -> None:
    """Write through a JDBC connector (parallel, batched inserts).
    Needs the driver jar on the classpath; not exercised by the tests."""
    w = df.write.format("jdbc").options(**options).option("batchsize", batchsize)
    if num_partitions:
        w = w.option("numPartitions", num_partitions)
    w.mode(mode).save()


def read_jdbc(spark: SparkSession, options: dict, partition_column: str | None = None, lower: int = 0,
              upper: int = 0, num_partitions: int = 1) -> DataFrame:
    """Read a table through JDBC, range-partitioned when a column is given."""
    r = spark.read.format("jdbc").options(**options)
    if partition_column:
        r = r.option("partitionColumn", partition_column).option("lowerBound", lower) \
            .option("upperBound", upper).option("numPartitions", num_partitions)
    return r.load()

