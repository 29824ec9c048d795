"""Building the star from the posting fixture and reading it back.

``build_warehouse`` stages the cleaned postings, merges the six dimensions,
builds the fact and writes every table as Parquet under the shared
checkpoint folder (``spark.checkpoint.dir``). Reading the written tables
cuts lineage, so the OLAP queries plan against plain Parquet scans and a
lost executor only recomputes a scan. Results are memoised per session and
input folder.
"""

from __future__ import annotations

import hashlib
import os
import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postwise import rules as R
from postwise.operators.clean import clean_basic, clean_standard
from postwise.operators.dimensions import STAR_A, merge_one_a
from postwise.operators.fact import build_fact, key_lookup
from postwise.session import scratch_path
from postwise.sources.fixture import raw_postings

_ROOTS: dict[tuple, str] = {}                      # per SparkContext: written tables
_TABLES: dict[tuple, dict[str, DataFrame]] = {}    # per SparkSession: DataFrames over them
_LOCK = threading.Lock()                           # one build per root, even from threads

STAR_A_TABLES = ["staging", *STAR_A.keys(), "fact"]


def _root(spark: SparkSession, sf_dir: str, run_date: str, tag: str) -> str:
    h = hashlib.sha1(f"{os.path.abspath(sf_dir)}|{run_date}|{tag}".encode()).hexdigest()[:12]
    return scratch_path(spark, "postwise-warehouse", h)


def _write(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """Overwrite ``path``; a partitioned table is rebalanced on its partition
    columns first (AQE merges small and splits skewed partitions), so each
    month gets few files and a hot month is still spread over tasks."""
    w = df.write.mode("overwrite")
    if partition_by:
        w = df.hint("rebalance", *partition_by).write.mode("overwrite").partitionBy(*partition_by)
    w.parquet(path)


def build_warehouse(spark: SparkSession, sf_dir: str, run_date: str = R.DEFAULT_RUN_DATE,
                    rules: R.Rules = R.DEFAULT_RULES) -> str:
    """Stage + dimensions + fact (star A) for the fixture; returns the root."""
    root = _root(spark, sf_dir, run_date, repr(rules))
    staging = clean_basic(raw_postings(spark, sf_dir), rules, run_date)
    _write(staging, f"{root}/staging")
    staging = spark.read.parquet(f"{root}/staging")
    run_ts = f"{run_date} 00:00:00"

    def one(name: str):
        # merge -> write -> key lookup, per dimension, as concurrent jobs
        _write(merge_one_a(staging, {}, name, run_ts, rules=rules), f"{root}/{name}")
        dim = spark.read.parquet(f"{root}/{name}")
        return dim, key_lookup(staging, {name: dim}, name)

    from concurrent.futures import ThreadPoolExecutor

    with ThreadPoolExecutor(max_workers=len(STAR_A)) as pool:
        done = {name: f.result() for name, f in {n: pool.submit(one, n) for n in STAR_A}.items()}
    dims = {name: d for name, (d, _) in done.items()}
    fact = build_fact(staging, dims, run_ts=run_ts, lookups={name: lk for name, (_, lk) in done.items()})
    _write(fact, f"{root}/fact", ["posting_year", "posting_month"])
    return root


def warehouse(spark: SparkSession, sf_dir: str, run_date: str = R.DEFAULT_RUN_DATE,
              rules: R.Rules = R.DEFAULT_RULES) -> dict[str, DataFrame]:
    """The star-A tables for ``sf_dir`` (built once per session)."""
    try:
        app, session = spark.sparkContext.applicationId, spark._jsparkSession.sessionUUID()
    except Exception:  # noqa: BLE001 - sessions without JVM handles
        app = session = spark.conf.get("spark.app.id", None) or str(id(spark))
    build_key = (app, os.path.abspath(sf_dir), run_date, repr(rules))
    session_key = (session,) + build_key
    with _LOCK:
        tables = _TABLES.get(session_key)
        if tables is None:
            root = _ROOTS.get(build_key)
            if root is None:
                root = build_warehouse(spark, sf_dir, run_date, rules)
                _ROOTS[build_key] = root
            tables = {name: spark.read.parquet(f"{root}/{name}") for name in STAR_A_TABLES}
            _TABLES[session_key] = tables
    return dict(tables)


def cleaned_standard(spark: SparkSession, sf_dir: str, rules: R.Rules = R.DEFAULT_RULES) -> DataFrame:
    """The standard-profile cleaned postings of the fixture (lazy)."""
    return clean_standard(raw_postings(spark, sf_dir), rules)


STAR_B_TABLES = ["dim_time", "dim_company", "dim_job", "dim_industry", "dim_location", "dim_source_agency", "fact"]


def warehouse_b(spark: SparkSession, sf_dir: str, run_date: str = R.DEFAULT_RUN_DATE) -> dict[str, DataFrame]:
    """The star-B tables for ``sf_dir``, written once per application."""
    from postwise.operators.star_b import build_star_b
    key = (spark.sparkContext.applicationId, os.path.abspath(sf_dir), run_date, "star B")
    with _LOCK:
        root = _ROOTS.get(key)
        if root is None:
            root = _root(spark, sf_dir, run_date, "star B")
            for name, df in build_star_b(cleaned_standard(spark, sf_dir), run_ts=f"{run_date} 00:00:00").items():
                _write(df, f"{root}/{name}")
            _ROOTS[key] = root
    return {name: spark.read.parquet(f"{root}/{name}") for name in STAR_B_TABLES}
