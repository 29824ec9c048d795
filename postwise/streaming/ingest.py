"""Streaming ingest with duplicate removal bounded by a watermark.

New posting files are picked up by a file stream, duplicates (same record
hash) arriving within ``time_window_days`` of each other are dropped with
``dropDuplicatesWithinWatermark`` (state is bounded by the watermark). The
event time is the time of arrival, which never runs backwards, so no row is
late, however old its posting date. Over-long rows go to ``rejects``, and
each micro-batch is loaded through the incremental batch load in ``foreachBatch``
(idempotent per batch id, so a replayed micro-batch changes nothing).
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postwise import rules as R
from postwise.operators.clean import clean_standard
from postwise.session import scratch_path
from postwise.sources.csv import csv_schema, null_tokens
from postwise.sources.fixture import POSTING_COLUMNS


def dedup_stream(stream: DataFrame, key_cols: list[str], event_time: str,
                 days: int = R.TIME_WINDOW_DAYS) -> DataFrame:
    """Drop rows whose key repeats within ``days`` of event time."""
    return stream.withWatermark(event_time, f"{days} days").dropDuplicatesWithinWatermark(key_cols)


def postings_stream(spark: SparkSession, src_dir: str, max_files: int | None = None) -> DataFrame:
    """Raw postings from CSV files landing in ``src_dir`` with the record
    hash and the time of arrival; over-long rows keep ``_overflow``."""
    reader = spark.readStream.schema(csv_schema()).option("header", True).option("quote", '"') \
        .option("escape", '"').option("ignoreLeadingWhiteSpace", True).option("enforceSchema", True)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    raw = null_tokens(reader.csv(src_dir))
    # Carry the raw text through the cleaning projections under aliases:
    # one projection chain, no join of the stream with itself.
    carried = raw.select("*", *[F.col(c).alias(f"_raw_{c}") for c in POSTING_COLUMNS])
    cleaned = clean_standard(carried)
    # An over-long row is another record than the good row of the same fields.
    key = F.when(F.col("_overflow").isNull(), F.col("hash_dedup")).otherwise(
        F.sha2(F.concat_ws("\u0001", "hash_dedup", "_overflow"), 256))
    return cleaned.select(*[F.col(f"_raw_{c}").alias(c) for c in POSTING_COLUMNS], "_overflow",
                          key.alias("hash_dedup"), F.current_timestamp().alias("_event_time"))


def run_ingest(spark: SparkSession, src_dir: str, root: str, checkpoint: str, rules: R.Rules = R.DEFAULT_RULES,
               available_now: bool = True):
    """Start the ingest: dedup within the window, then ``run_pipeline`` per
    micro-batch (batch id = ``stream-<epoch>``)."""
    from postwise.plans.incremental import Warehouse, run_pipeline

    deduped = dedup_stream(postings_stream(spark, src_dir), ["hash_dedup"], "_event_time", rules.time_window_days)

    def load(batch: DataFrame, epoch: int) -> None:
        rows = batch.drop("hash_dedup", "_event_time")
        # One folder per micro-batch, overwritten by a replay.
        rows.where("_overflow IS NOT NULL").write.mode("overwrite").parquet(
            Warehouse(batch.sparkSession, root).path(f"rejects/epoch={epoch}"))
        run_pipeline(batch.sparkSession, rows.where("_overflow IS NULL").drop("_overflow"), root, f"stream-{epoch}",
                     rules=rules)

    w = deduped.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()


def start_distinct(stream: DataFrame, key_cols: list[str], sink: str, checkpoint: str):
    """Append each key to ``sink`` once, whatever micro-batches its rows come in.

    Each micro-batch writes the keys that no earlier one has stored into a folder of
    its own (``epoch=N``), which a replay overwrites with the same keys.
    """
    stored_schema = stream.select(*key_cols).schema.add("epoch", "long")

    def write(batch: DataFrame, epoch: int) -> None:
        new = batch.select(*key_cols).distinct()
        if epoch:
            stored = batch.sparkSession.read.schema(stored_schema).parquet(sink)
            same = [new[c].eqNullSafe(stored[c]) for c in key_cols]
            new = new.join(stored.where(F.col("epoch") < epoch), same, "left_anti")
        new.write.mode("overwrite").parquet(f"{sink}/epoch={epoch}")

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint) \
        .trigger(availableNow=True).start()


def stream_distinct_events(spark: SparkSession, sf_dir: str, key_cols=("user_id", "event_type")) -> DataFrame:
    """The ``events`` table replayed as a stream: each key once, written to a
    Parquet sink and read back."""
    path = f"{sf_dir.rstrip('/')}/events.parquet"
    schema = spark.read.parquet(path).schema
    stream = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet") \
        .parquet(sf_dir).withColumn("ts", F.col("ts").cast("timestamp"))
    out = stream.select(*key_cols)
    run = uuid.uuid4().hex[:12]
    sink, ckpt = scratch_path(spark, "stream", run, "out"), scratch_path(spark, "stream", run, "ckpt")
    start_distinct(out, list(key_cols), sink, ckpt).awaitTermination()
    return spark.read.schema(out.schema).parquet(sink).select(*key_cols)
