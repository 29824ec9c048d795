"""Fact build and maintenance.

Key lookup resolves each distinct spelling to a member id first (a small
table per dimension), so the fact join is six plain equi-joins on the
staging columns. Each lookup is materialised and counted: one within
``BROADCAST_ROWS`` is broadcast (the staging rows are then never shuffled
for that dimension), a larger one stays a shuffle join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postwise.functions.salary import has_salary, salary_avg
from postwise.operators.dimensions import STAR_A
from postwise.operators.keys import broadcast_if_small, resolve_members

FACT_KEYS = ["time_id", "company_id", "job_id", "industry_id", "location_id", "source_id"]


def key_lookup(staging: DataFrame, dims: dict[str, DataFrame], name: str,
               max_broadcast_rows: int | None = None) -> DataFrame:
    """The (staging spelling(s) -> member id) table of one dimension, sized
    and marked for broadcast when small enough."""
    spec = STAR_A[name]
    src_cols = list(spec["src"].values())
    if name == "dim_time":
        return dims[name].select(F.col("posting_date"), F.col(spec["id"]))
    dim_cols = ["city"] if name == "dim_location" else list(spec["src"].keys())
    values = staging.select(*[F.col(s).alias(f"_v{i}") for i, s in enumerate(src_cols)])
    mapping = resolve_members(values, dims[name], [f"_v{i}" for i in range(len(src_cols))], spec["id"], dim_cols)
    mapping = mapping.select(*[F.col(f"_v{i}").alias(s) for i, s in enumerate(src_cols)], spec["id"])
    kw = {} if max_broadcast_rows is None else {"max_rows": max_broadcast_rows}
    return broadcast_if_small(mapping, **kw)[0]


def resolve_keys(staging: DataFrame, dims: dict[str, DataFrame], max_broadcast_rows: int | None = None,
                 lookups: dict[str, DataFrame] | None = None) -> DataFrame:
    """Staging rows with the six member ids (inner joins, one row each).

    The job key uses all four job attributes and the location key matches
    the city null-safely, so a staging row maps to exactly one fact row.
    The lookups are independent and are prepared as concurrent Spark jobs.
    """
    if lookups is None:
        from concurrent.futures import ThreadPoolExecutor

        with ThreadPoolExecutor(max_workers=len(STAR_A)) as pool:
            futures = {name: pool.submit(key_lookup, staging, dims, name, max_broadcast_rows) for name in STAR_A}
            lookups = {name: f.result() for name, f in futures.items()}
    out = staging
    for name, spec in STAR_A.items():
        out = out.join(lookups[name], list(spec["src"].values()), "inner")
    return out


def build_fact(staging: DataFrame, dims: dict[str, DataFrame], run_ts=None,
               max_broadcast_rows: int | None = None, lookups: dict[str, DataFrame] | None = None) -> DataFrame:
    """K3: fact rows for a staging batch (job_count 1, stored salary_avg and
    has_salary, load timestamp, posting year/month for partitioning)."""
    r = resolve_keys(staging, dims, max_broadcast_rows, lookups)
    ts = F.lit(run_ts).cast("timestamp") if run_ts is not None else F.lit(None).cast("timestamp")
    return r.select(
        "posting_id", *FACT_KEYS,
        F.lit(1).alias("job_count"),
        "salary_min", "salary_max",
        salary_avg("salary_min", "salary_max").alias("salary_avg"),
        has_salary("salary_min").alias("has_salary"),
        ts.alias("load_date"),
        F.year("posting_date").alias("posting_year"),
        F.month("posting_date").alias("posting_month"),
    )


def upsert_fact(old: DataFrame | None, new: DataFrame, key_cols: list[str] = FACT_KEYS,
                order_cols: tuple[str, ...] = ("_batch", "posting_id"),
                update_cols: tuple[str, ...] = ("salary_min", "salary_max")) -> DataFrame:
    """K4: one row per ``key_cols``; the latest row (by ``order_cols``) wins.

    Done as an aggregate with ``max_by`` so map-side partial aggregation
    keeps one row per key per task; a key holding a third of the rows never
    lands whole in one task. The surviving row takes the winner's salaries
    (``ON DUPLICATE KEY UPDATE salary_min, salary_max``); the other columns
    keep the first-loaded row's values. Rows need a ``_batch`` column.
    """
    both = new if old is None else old.unionByName(new, allowMissingColumns=True)
    rest = [c for c in both.columns if c not in key_cols and c not in update_cols and c != "_batch"]
    order = F.struct(*[F.col(c) for c in order_cols])
    agg = both.groupBy(*key_cols).agg(
        F.max_by(F.struct(*[F.col(c) for c in update_cols]), order).alias("_upd"),
        F.min_by(F.struct(*[F.col(c) for c in rest]), order).alias("_first"),
        F.max("_batch").alias("_batch"),
    )
    out = agg.select(*key_cols, *[F.col("_first")[c].alias(c) for c in rest],
                     *[F.col("_upd")[c].alias(c) for c in update_cols], "_batch")
    if "salary_avg" in out.columns:
        out = out.withColumn("salary_avg", salary_avg("salary_min", "salary_max")) \
                 .withColumn("has_salary", has_salary("salary_min"))
    return out.select(*[c for c in both.columns if c in out.columns])


def append_conflicts(old: DataFrame, new: DataFrame, key_cols: list[str] = FACT_KEYS) -> DataFrame:
    """Append mode: rows of ``new`` whose six-key is already stored or repeats
    within ``new`` (the rows a unique key would refuse)."""
    stored = new.join(old.select(*key_cols).distinct(), key_cols, "left_semi")
    dup_keys = new.groupBy(*key_cols).count().filter("count > 1").select(*key_cols)
    return stored.unionByName(new.join(dup_keys, key_cols, "left_semi")).distinct()
