"""Streaming ingest into the incremental load (E2) and dimension enrichment (K7)."""

import os
import shutil
import tempfile

from pyspark.sql import functions as F

from postwise.operators.dimensions import enrich_dimension
from postwise.plans.incremental import Warehouse, tables
from postwise.sources.csv import write_postings_csv
from postwise.sources.fixture import raw_postings
from postwise.streaming.ingest import run_ingest
from tests.conftest import SF_SMALL


def test_stream_ingest_drops_repeats(spark):
    d = tempfile.mkdtemp(prefix="pw-stream-", dir="/tmp")
    raw = raw_postings(spark, SF_SMALL).drop("posting_id")
    write_postings_csv(raw, d + "/one")
    os.makedirs(d + "/in")
    for i, f in enumerate(x for x in os.listdir(d + "/one") if x.endswith(".csv")):
        shutil.copy(os.path.join(d, "one", f), os.path.join(d, "in", f"a{i}.csv"))
        shutil.copy(os.path.join(d, "one", f), os.path.join(d, "in", f"b{i}.csv"))  # every row twice
    q = run_ingest(spark, d + "/in", d + "/wh", d + "/ckpt")
    q.awaitTermination()
    wh = Warehouse(spark, d + "/wh")
    fact = tables(wh)["fact"]
    # Every distinct record hash lands once; the copies are dropped.
    from postwise.operators.clean import clean_standard
    distinct_hashes = clean_standard(raw_postings(spark, SF_SMALL)).select("hash_dedup").distinct().count()
    staged = spark.read.parquet(d + "/wh/staging")
    assert staged.count() == distinct_hashes
    assert fact.count() > 0
    assert wh.read("processed_batches").count() >= 1


def test_enrich_dimension(spark):
    dim = spark.createDataFrame([(1, "Finance"), (2, "Retail"), (3, "Other")], "industry_id long, industry_name string")
    lookup = spark.createDataFrame([("finance", "Services"), ("RETAIL", "Trade")], "industry_name string, sector string")
    out = {r["industry_name"]: r["sector"] for r in enrich_dimension(dim, lookup, "industry_name").collect()}
    assert out == {"Finance": "Services", "Retail": "Trade", "Other": None}
