"""Cases found in review: late and over-long stream rows, layouts, first appends, load numbers,
enrichment, blanks, date-times, shared folders. Expected values are literal."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from postwise.functions.dates import parse_date_or
from postwise.functions.salary import salary_range
from postwise.operators.dimensions import enrich_dimension
from postwise.plans.incremental import Warehouse, next_load_seq, run_pipeline
from postwise.sources.fixture import raw_postings
from postwise.streaming.ingest import run_ingest, start_distinct
from tests.conftest import SF_SMALL


def _line(header, **values):
    return ",".join(values.get(c, "") for c in header)


def test_stream_keeps_old_rows_and_rejects_long_ones(spark):
    from postwise.sources.csv import csv_schema
    header = [c for c in csv_schema().names if c != "_overflow"]
    d = tempfile.mkdtemp(prefix="pw-late-", dir="/tmp")
    os.makedirs(d + "/in")

    def write(name, rows, extra=""):
        with open(f"{d}/in/{name}.csv", "w") as f:
            f.write(",".join(header) + "\n" + "\n".join(_line(header, **r) + extra for r in rows) + "\n")

    write("one", [{"job_title": "Undated", "company_name": "A"},
                  {"job_title": "Dated", "company_name": "B", "posting_date": "2024-01-05"}])
    run_ingest(spark, d + "/in", d + "/wh", d + "/ckpt").awaitTermination()
    write("two", [{"job_title": f"Old {i}", "company_name": "C", "posting_date": f"2024-01-0{i}"} for i in (1, 2, 3)])
    write("three", [{"job_title": "Long", "company_name": "D"}], ",surplus,more")
    run_ingest(spark, d + "/in", d + "/wh", d + "/ckpt").awaitTermination()
    staged = spark.read.parquet(d + "/wh/staging")
    assert sorted(r[0] for r in staged.select("job_title").collect()) == ["Dated", "Old 1", "Old 2", "Old 3", "Undated"]
    assert spark.read.parquet(d + "/wh/rejects").count() == 1


@pytest.mark.parametrize("files", [1, 10])
def test_distinct_stream_does_not_depend_on_batches(spark, files):
    d = tempfile.mkdtemp(prefix="pw-distinct-", dir="/tmp")
    events = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    events.repartitionByRange(files, "ts").write.parquet(d + "/in")
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(d + "/in")
    start_distinct(stream, ["user_id", "event_type"], d + "/out", d + "/ckpt").awaitTermination()
    got = spark.read.parquet(d + "/out").select("user_id", "event_type")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, events.select("user_id", "event_type").distinct().collect()))



def test_first_append_keeps_one_row_of_a_key(spark):
    d = tempfile.mkdtemp(prefix="pw-first-", dir="/tmp")
    one = raw_postings(spark, SF_SMALL).limit(1).checkpoint()
    two = one.unionByName(one.withColumn("posting_id", F.col("posting_id") + 1_000_000))
    run_pipeline(spark, two, d + "/wh", "b1", "2025-01-01 00:00:00", mode="append")
    assert Warehouse(spark, d + "/wh").read("fact").count() == 1


def test_rerun_does_not_make_a_later_load_lose(spark):
    d = tempfile.mkdtemp(prefix="pw-seq-", dir="/tmp")
    ts = "2025-01-01 00:00:00"
    one = raw_postings(spark, SF_SMALL).limit(1).checkpoint()
    low = one.withColumn("salary", F.lit("USD 400 - 600")).withColumn("posting_id", F.lit(9).cast("bigint"))
    high = one.withColumn("salary", F.lit("USD 700 - 900")).withColumn("posting_id", F.lit(1).cast("bigint"))
    for batch, rows in (("b1", low), ("b1", low), ("b2", high)):
        run_pipeline(spark, rows, d + "/wh", batch, ts)
    wh = Warehouse(spark, d + "/wh")
    assert [(int(r.salary_min), int(r.salary_max)) for r in wh.read("fact").collect()] == [(700, 900)]
    assert next_load_seq(wh) == 4


def test_enrichment_keeps_stored_values_and_members(spark):
    dim = spark.createDataFrame([(1, "CamHR", "board"), (2, "Other", "agency"), (3, "New", None)],
                                "source_id long, agency_name string, platform_type string")
    lookup = spark.createDataFrame([("camhr", "x", "u1"), ("CAMHR", "y", "u2"), ("new", "site", None)],
                                   "agency_name string, platform_type string, url string")
    got = sorted(map(tuple, enrich_dimension(dim, lookup, "agency_name").collect()))
    assert got == [(1, "CamHR", "board", "u2"), (2, "Other", "agency", None), (3, "New", "site", None)]


def test_salary_with_no_break_blanks(spark):
    df = spark.createDataFrame([("USD 800 - 1,200",), ("USD 800 -　900",)], "s string")
    for mode, want in (("fixed", [(800, 1200), (800, 900)]),):
        r = df.select(salary_range("s", mode).alias("x")).collect()
        assert [(int(x.x.salary_min), int(x.x.salary_max)) for x in r] == want


def test_iso_date_times(spark):
    df = spark.createDataFrame([("2024-01-05 10:20:30",), ("2024-01-05T10:20",), ("2024-01-05 99:00",)], "s string")
    r = [x.x for x in df.select(parse_date_or("s", "2030-01-01").alias("x")).collect()]
    assert [(str(x.posting_date), x.date_defaulted) for x in r] == [
        ("2024-01-05", False), ("2024-01-05", False), ("2030-01-01", True)]


def test_cluster_without_shared_folder_is_an_error(monkeypatch):
    from postwise import session

    class Conf:
        def get(self, key, default=None):
            return default

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

        def getConf(self):
            return Conf()

    class Session:
        sparkContext, conf = Context(), Conf()

    with pytest.raises(ValueError):
        session.ensure_checkpoint_dir(Session())
