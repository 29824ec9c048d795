"""The incremental load (K5) and its table maintenance.

One run: purge unprocessed staging batches -> stage the new batch -> merge
the six dimensions (only new members are appended; stored members never
change) -> build the fact rows -> append or upsert them -> mark the batch
processed -> log the run -> summary. Re-running a batch changes
nothing (dimensions are insert-if-absent, the fact is upserted on its
six-key), and a run that fails before the mark leaves the batch
unprocessed, so the next run purges and redoes it.

With ``screen=True`` the batch is screened between cleaning and staging: one
pass tells every row's standing (accepted; rejected, with reasons from the
declared schema and the quality checks; duplicate, of a row of the batch or of
one loaded before; near_duplicate, by the fuzzy rule, if asked for). Only
accepted rows are staged, the others are kept in ``screened``, and the four
counts add up to the input.

Tables are Parquet folders under a warehouse root on shared storage. A table,
or a partition of one, is replaced by writing a sibling folder, setting the old
one aside and renaming the new one; a run that stops anywhere in between loses
nothing, as the next run completes or undoes what it finds
(:meth:`Warehouse.repair`). The fact is partitioned by posting year/month and an
upsert rewrites only the touched partitions. Rows with a unique key are appended
by the first characters of its hash, so an append reads only the prefixes that
the batch touches.
"""

from __future__ import annotations

import datetime as _dt
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postwise import rules as R
from postwise import schemas
from postwise.operators.clean import clean_basic, hash_fields
from postwise.operators.dedup import fuzzy_duplicates
from postwise.operators.dimensions import STAR_A, merge_one_a
from postwise.operators.fact import FACT_KEYS, append_conflicts, build_fact, key_lookup, upsert_fact
from postwise.operators.quality import staging_checks
from postwise.plans import olap
from postwise.session import ensure_checkpoint_dir, written


#: Says that a folder was written whole.
WHOLE = "_WHOLE"
#: Hex characters of a hash that name its partition.
PREFIX = 2


class Warehouse:
    """Parquet tables under ``root`` (any Hadoop-compatible file system)."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        jvm = spark.sparkContext._jvm
        self._Path = jvm.org.apache.hadoop.fs.Path
        conf = spark.sparkContext._jsc.hadoopConfiguration()
        self._fs = self._Path(self.root).getFileSystem(conf)

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def exists(self, name: str) -> bool:
        return self._fs.exists(self._Path(self.path(name)))

    def read(self, name: str) -> DataFrame | None:
        return self.spark.read.parquet(self.path(name)) if self.exists(name) else None

    def replace(self, name: str, df: DataFrame, partition_by: list[str] | None = None) -> None:
        tmp = self.path(f"_{name}.next")
        w = df.write.mode("overwrite")
        if partition_by:
            w = df.hint("rebalance", *partition_by).write.mode("overwrite").partitionBy(*partition_by)
        w.parquet(tmp)
        self._mark(f"_{name}.next")
        self._swap(name)

    def _mark(self, rel: str) -> None:
        """Say that a folder is written whole."""
        self._fs.create(self._Path(f"{self.path(rel)}/{WHOLE}"), True).close()

    def _move(self, rel: str, to: str) -> None:
        parent = self._Path(self.path(to)).getParent()
        self._fs.mkdirs(parent)
        if not self._fs.rename(self._Path(self.path(rel)), self._Path(self.path(to))):
            raise OSError(f"could not rename {self.path(rel)} to {self.path(to)}")

    def _swap(self, name: str) -> None:
        """The whole folder ``_name.next`` takes the table's place."""
        if self.exists(name):
            self._move(name, f"_{name}.old")
        self._move(f"_{name}.next", name)
        self.delete(f"{name}/{WHOLE}")
        self.delete(f"_{name}.old")

    def replace_partitions(self, name: str, df: DataFrame, partition_by: list[str]) -> None:
        """Replace the table's partitions that ``df`` has rows for (it may read the table)."""
        df.hint("rebalance", *partition_by).write.mode("overwrite").partitionBy(*partition_by).parquet(self.path(f"_{name}.parts"))
        self._mark(f"_{name}.parts")
        self._swap_partitions(name)

    def _swap_partitions(self, name: str) -> None:
        for part in self._leaves(f"_{name}.parts"):
            if self.exists(f"{name}/{part}"):
                self._move(f"{name}/{part}", f"_{name}.parts.old/{part}")
            self._move(f"_{name}.parts/{part}", f"{name}/{part}")
        self.delete(f"_{name}.parts")
        self.delete(f"_{name}.parts.old")

    def _leaves(self, rel: str) -> list[str]:
        """The partition folders below a folder that hold files, by their names from there on."""
        out, below = [], [""]
        while below:
            at = below.pop()
            inside = self._fs.listStatus(self._Path(self.path(f"{rel}/{at}".rstrip("/"))))
            below += [f"{at}/{st.getPath().getName()}".lstrip("/") for st in inside if st.isDirectory() and "=" in st.getPath().getName()]
            if at and any(st.isFile() for st in inside):
                out.append(at)
        return out

    def repair(self) -> list[str]:
        """Complete, or undo, replacements that a run broke off; the names of the tables concerned."""
        names = {d[1:].split(".")[0] for d in self.list_dirs("") if d.startswith("_") and d.endswith((".next", ".old", ".parts"))}
        for name in sorted(names):
            if self.exists(f"_{name}.parts/{WHOLE}"):
                self._swap_partitions(name)
            elif self.exists(name):
                pass  # the old table stands, or the new one already does
            elif self.exists(f"_{name}.next/{WHOLE}"):
                self._swap(name)
            elif self.exists(f"_{name}.old"):
                self._move(f"_{name}.old", name)
            self.delete(f"{name}/{WHOLE}")
            for rest in ("next", "old", "parts", "parts.old"):
                self.delete(f"_{name}.{rest}")
        return sorted(names)

    def append(self, name: str, df: DataFrame, partition_by: list[str] | None = None) -> None:
        w = df.write.mode("append")
        if partition_by:
            w = df.hint("rebalance", *partition_by).write.mode("append").partitionBy(*partition_by)
        w.parquet(self.path(name))

    def list_dirs(self, name: str) -> list[str]:
        if not self.exists(name):
            return []
        return [st.getPath().getName() for st in self._fs.listStatus(self._Path(self.path(name))) if st.isDirectory()]

    def delete(self, rel: str) -> None:
        self._fs.delete(self._Path(self.path(rel)), True)

    def read_or_empty(self, name: str) -> DataFrame:
        """The table, or one of its declared columns without rows."""
        found = self.read(name)
        return schemas.empty(self.spark, name) if found is None else found

    def append_unique(self, name: str, rows: DataFrame, key: str = "hash_dedup", order: str = "posting_id") -> None:
        """Append the rows whose key (a hex digest) is not stored yet, one a key (the least ``order``).

        The table is partitioned by the key's first PREFIX characters; only the partitions that the new keys
        fall into are read. Rows without a key are left out.
        """
        # Read for the first row of each key and again for these rows: written, so that they are made once.
        rows = written(rows.where(F.col(key).isNotNull()), f"{name}-rows")
        first = rows.groupBy(key).agg(F.min(order).alias(order))
        prefix = F.substring(key, 1, PREFIX)
        if self.exists(name):
            first = written(first.withColumn("hash_prefix", prefix), f"{name}-keys")
            touched = [r[0] for r in first.select("hash_prefix").distinct().collect()]  # at most 16^PREFIX
            stored = self.read(name).where(F.col("hash_prefix").isin(touched)).select("hash_prefix", key)
            first = first.join(stored, ["hash_prefix", key], "left_anti").drop("hash_prefix")
        new = rows.join(first, [key, order], "left_semi").dropDuplicates([key, order]).withColumn("hash_prefix", prefix)
        self.append(name, new, ["hash_prefix"])


def _runs(wh: Warehouse) -> DataFrame:
    """batch_id, started, done: how often each batch was begun and marked."""
    empty = wh.spark.createDataFrame([], "batch_id string")
    begun, done = (wh.read(n) for n in ("started_batches", "processed_batches"))
    both = (empty if begun is None else begun.select("batch_id")).withColumn("b", F.lit(1)).withColumn("d", F.lit(0)).unionByName(
        (empty if done is None else done.select("batch_id")).withColumn("b", F.lit(0)).withColumn("d", F.lit(1)))
    return both.groupBy("batch_id").agg(F.sum("b").alias("started"), F.sum("d").alias("done"))


def processed_batches(wh: Warehouse) -> DataFrame:
    """batch_id of the batches whose last run came to its end."""
    return _runs(wh).where("done > 0 AND done >= started").select("batch_id")


def purge_unprocessed(wh: Warehouse) -> list[str]:
    """Drop staging batches that were never marked processed (whole
    batch folders; never a rewrite of the staging table)."""
    staged = [(d.split("=", 1)[1],) for d in wh.list_dirs("staging") if d.startswith("batch_id=")]
    open_ones = wh.spark.createDataFrame(staged, "batch_id string").join(processed_batches(wh), "batch_id", "left_anti")
    dropped = [f"batch_id={r[0]}" for r in open_ones.orderBy("batch_id").collect()]
    for d in dropped:
        wh.delete(f"staging/{d}")
        wh.delete(f"screened/{d}")
    return dropped


def screen_rows(staged: DataFrame, rules: R.Rules = R.DEFAULT_RULES, run_date: str = R.DEFAULT_RUN_DATE,
                stored: DataFrame | None = None, near: bool = False) -> DataFrame:
    """DQ1-DQ4, D1, D2 on a cleaned batch: every row with ``hash_dedup``, ``reasons`` and ``status``.

    status is accepted, rejected (``reasons``: what the declared schema or a quality check refuses),
    duplicate (same record hash over the rules' fields as a row of the batch with a smaller id,
    or as one in ``stored``), or near_duplicate (``near``: an accepted row that the fuzzy rule finds
    beside an earlier one). Rejected rows make no duplicates. Only (hash, id) is shuffled to find them.
    """
    checks = staging_checks(run_date, rules)
    broken = F.filter(F.array(*[F.when(~c, F.lit(n)) for n, c in checks.items()]), lambda x: x.isNotNull())
    tagged = staged.withColumn("hash_dedup", hash_fields(staged, rules.dedup_fields, rules.nfkc)) \
        .withColumn("reasons", F.array_distinct(F.concat(schemas.violations(staged, "staging"), broken))) \
        .withColumn("_row", F.monotonically_increasing_id())
    tagged = written(tagged, "screened")
    sound = tagged.where(F.size("reasons") == 0)
    status = F.when(F.size("reasons") > 0, "rejected")
    if not rules.dedup_enabled:
        return tagged.withColumn("status", F.coalesce(status, F.lit("accepted"))).drop("_row")
    # Rows of one id and hash are copies too, so the row's own number decides last.
    first = sound.groupBy("hash_dedup").agg(F.min(F.struct("posting_id", "_row")).alias("_f")).select("hash_dedup", "_f._row")
    if stored is not None:
        first = first.join(stored.select("hash_dedup").distinct(), "hash_dedup", "left_anti")
    kept = first.select("_row", F.lit(True).alias("_first"))
    if near:
        company, text = F.lower("company_name"), F.lower(F.concat_ws("|", "job_title", "location"))
        rows = sound.join(kept, "_row").select("posting_id", "_row", company.alias("_co"), text.alias("_s"), F.col("posting_date").alias("_d"))
        again = fuzzy_duplicates(rows, rules.similarity_threshold, rules.time_window_days).distinct()
        again = rows.select("posting_id", "_row").join(again, "posting_id").select("_row", F.lit(True).alias("_near"))
        kept = kept.join(again, "_row", "left")
    else:
        kept = kept.withColumn("_near", F.lit(None).cast("boolean"))
    return tagged.join(kept, "_row", "left").withColumn("status", status.when(F.col("_first").isNull(), "duplicate").when(
        F.col("_near"), "near_duplicate").otherwise("accepted")).drop("_first", "_near", "_row")


def screen(wh: Warehouse, staged: DataFrame, batch_id: str, run_ts: str, rules: R.Rules, near: bool) -> DataFrame:
    """Write the screened batch, stage its accepted rows, and return (status, rows)."""
    rows = screen_rows(staged, rules, run_ts[:10], wh.read("loaded_hashes"), near)
    path = wh.path(f"screened/batch_id={batch_id}")
    rows.write.mode("overwrite").partitionBy("status").parquet(path)
    done = wh.spark.read.schema(rows.schema).parquet(path)
    done.where("status = 'accepted'").select(*staged.columns).write.mode("overwrite").parquet(wh.path(f"staging/batch_id={batch_id}"))
    return done.groupBy("status").agg(F.count("*").alias("rows"))


def stage(wh: Warehouse, postings: DataFrame, batch_id: str, run_ts: str, rules: R.Rules = R.DEFAULT_RULES,
          screened: bool = False, near: bool = False) -> DataFrame:
    """Clean a batch (basic profile) into ``staging/batch_id=...``, all of it or what passes the screening."""
    df = postings
    if "posting_id" not in df.columns:
        text = [c for c in df.columns if c not in ("_overflow",)]
        df = df.withColumn("posting_id", F.xxhash64(F.lit(batch_id), *[F.col(c) for c in text]))
    staged = clean_basic(df, rules, run_ts[:10]).withColumn("timestamp_col", F.lit(run_ts).cast("timestamp"))
    if screened:
        screen(wh, staged, batch_id, run_ts, rules, near)
    else:
        staged.write.mode("overwrite").parquet(wh.path(f"staging/batch_id={batch_id}"))
    return wh.spark.read.parquet(wh.path(f"staging/batch_id={batch_id}"))


def mark_processed(wh: Warehouse, batch_id: str, run_ts: str) -> None:
    """Record the batch as processed (append-only)."""
    row = wh.spark.createDataFrame([(batch_id, run_ts)], "batch_id string, processed_at string") \
        .withColumn("processed_at", F.col("processed_at").cast("timestamp"))
    wh.append("processed_batches", row)


def log_run(wh: Warehouse, process: str, count: int, status: str, start: _dt.datetime, end: _dt.datetime,
            error: str | None = None) -> None:
    """One row in ``etl_logs`` (type, process, count, status, start,
    end, whole seconds)."""
    row = wh.spark.createDataFrame(
        [("INFO" if status == "COMPLETED" else "ERROR", process, int(count), status, error, start, end)],
        "log_type string, process_name string, record_count int, status string, error_message string, "
        "start_time timestamp, end_time timestamp")
    row = row.withColumn("duration_seconds", F.timestamp_diff("SECOND", "start_time", "end_time").cast("int")) \
        .withColumn("created_at", F.col("end_time"))
    wh.append("etl_logs", row)


def _first_of_key(new: DataFrame) -> DataFrame:
    """One row per six-key: the one with the least posting id."""
    return new.groupBy(*FACT_KEYS).agg(F.min_by(F.struct(*new.columns), "posting_id").alias("_r")).select("_r.*")


def next_load_seq(wh: Warehouse) -> int:
    """A number above those of all loads before, repeated and broken-off ones included."""
    marks, fact = wh.read("processed_batches"), wh.read("fact")
    done = 0 if marks is None else marks.count()
    stored = None if fact is None else fact.agg(F.max("load_seq")).first()[0]
    return max(done, stored or 0) + 1


def load_fact(wh: Warehouse, new: DataFrame, mode: str = "upsert") -> int:
    """Append the new fact rows, or upsert them on the six-key
    rewriting only the touched (year, month) partitions. Returns the number of
    rows in append mode whose six-key is stored already or repeated, else 0."""
    part = ["posting_year", "posting_month"]
    old = wh.read("fact")
    if old is None:
        wh.replace("fact", upsert_fact(None, new.withColumnRenamed("load_seq", "_batch"),
                                       order_cols=("_batch", "posting_id")).withColumnRenamed("_batch", "load_seq")
                   if mode == "upsert" else _first_of_key(new), part)
        return append_conflicts(new.limit(0), new).count() if mode == "append" else 0
    if mode == "append":
        conflicts = append_conflicts(old, new).count()
        # A unique key keeps one row per six-key: the first (smallest id) of
        # the batch, and none whose key is already stored.
        wh.append("fact", _first_of_key(new).join(old.select(*FACT_KEYS).distinct(), FACT_KEYS, "left_anti"), part)
        return conflicts
    touched = [(r[0], r[1]) for r in new.select(*part).distinct().collect()]  # bounded by months
    cond = F.lit(False)
    for y, m in touched:
        cond = cond | ((F.col("posting_year") == y) & (F.col("posting_month") == m))
    old_part = old.where(cond)
    merged = upsert_fact(old_part.withColumnRenamed("load_seq", "_batch"), new.withColumnRenamed("load_seq", "_batch"),
                         order_cols=("_batch", "posting_id")).withColumnRenamed("_batch", "load_seq")
    wh.replace_partitions("fact", merged, part)
    return 0


def run_pipeline(spark: SparkSession, postings: DataFrame, root: str, batch_id: str,
                 run_ts: str | None = None, rules: R.Rules = R.DEFAULT_RULES, mode: str = "upsert",
                 screen: bool = False, near: bool = False) -> DataFrame:
    """K5: load one batch of raw postings into the star; returns the run
    summary (metric, label, value). ``screen`` sets rejected and duplicate rows
    aside before they are staged, ``near`` near duplicates too."""
    ensure_checkpoint_dir(spark)
    start = _dt.datetime.now().replace(microsecond=0)
    run_ts = run_ts or start.isoformat(sep=" ")
    wh = Warehouse(spark, root)
    try:
        wh.repair()
        purge_unprocessed(wh)
        seq = next_load_seq(wh)
        wh.append("started_batches", spark.createDataFrame([(batch_id, run_ts)], "batch_id string, started_at string"))
        staging = stage(wh, postings, batch_id, run_ts, rules, screen, near)
        current = {name: wh.read(name) for name in STAR_A}

        def one(name: str):
            # merge -> store -> key lookup, per dimension, as concurrent jobs
            df = merge_one_a(staging, current, name, run_ts, new_only=True, rules=rules)
            if current[name] is None:
                wh.replace(name, df)      # first load: seeds + members
            else:
                wh.append(name, df)       # later loads: new members only
            dim = wh.read(name)
            return dim, key_lookup(staging, {name: dim}, name)

        with ThreadPoolExecutor(max_workers=len(STAR_A)) as pool:
            done = {name: f.result() for name, f in {n: pool.submit(one, n) for n in STAR_A}.items()}
        dims = {name: d for name, (d, _) in done.items()}
        fact = build_fact(staging, dims, run_ts=run_ts, lookups={name: lk for name, (_, lk) in done.items()}) \
            .withColumn("load_seq", F.lit(seq))
        fact = written(fact, "fact-rows")
        loaded = fact.count()
        load_fact(wh, fact, mode)
        if screen:
            accepted = wh.read(f"screened/batch_id={batch_id}").where("status = 'accepted'")
            wh.append_unique("loaded_hashes", accepted.select("hash_dedup", "posting_id"))
        mark_processed(wh, batch_id, run_ts)
        log_run(wh, "ETL Pipeline", loaded, "COMPLETED", start, _dt.datetime.now().replace(microsecond=0))
    except Exception as e:  # noqa: BLE001 - logged, then re-raised
        log_run(wh, "ETL Pipeline", 0, "FAILED", start, _dt.datetime.now().replace(microsecond=0), str(e)[:1000])
        raise
    return olap.run_summary(tables(wh))


def tables(wh: Warehouse) -> dict[str, DataFrame]:
    out = {name: wh.read(name) for name in STAR_A}
    out["fact"] = wh.read("fact")
    return out


def register_views(spark: SparkSession, root: str) -> list[str]:
    """Temp views over the warehouse tables and the named views."""
    wh = Warehouse(spark, root)
    t = tables(wh)
    names = []
    for name, df in t.items():
        if df is not None:
            df.createOrReplaceTempView(name)
            names.append(name)
    if t.get("fact") is not None:
        olap.job_summary(t).createOrReplaceTempView("vw_job_summary")
        olap.industry_analysis(t).createOrReplaceTempView("vw_industry_analysis")
        names += ["vw_job_summary", "vw_industry_analysis"]
    return names
