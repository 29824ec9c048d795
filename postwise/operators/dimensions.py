"""Dimension maintenance.

``merge_dimension`` is an idempotent insert-if-absent: members of the source
not yet stored (under the matching equality) get fresh dense ids after the
current maximum; stored members keep their id and spelling.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from postwise import rules as R
from postwise.functions.dates import TIME_ATTRIBUTE_NAMES, time_attributes
from postwise.operators.clean import map_column
from postwise.operators.keys import assign_dense_ids, distinct_members, new_members


def _max_id(df: DataFrame | None, id_col: str) -> int:
    if df is None:
        return 0
    return df.agg(F.max(id_col)).collect()[0][0] or 0


def merge_dimension(old: DataFrame | None, src: DataFrame, key_cols: list[str], id_col: str,
                    attrs: dict[str, Column] | None = None, match_cols: list[str] | None = None,
                    collated: bool = True, new_only: bool = False) -> DataFrame:
    """K2: stored members plus new members of ``src`` with dense ids.

    ``key_cols`` name the member columns in ``src``; ``match_cols`` (default
    all keys) decide whether a member is already stored. ``attrs`` adds
    attribute columns computed from the keys (defaults, dates parts, ...).
    ``collated=False`` uses exact binary equality instead of the original
    server's case/accent-insensitive one. ``new_only=True`` returns just the
    new members (stored members never change, so a table can be appended).
    """
    match_cols = match_cols or key_cols
    if collated:
        members = distinct_members(src, match_cols)
        if match_cols != key_cols:
            members = members.select(*match_cols, *[
                (F.lit(None).cast(src.schema[c].dataType) if c in src.columns else F.lit(None).cast("string")).alias(c)
                for c in key_cols if c not in match_cols])
    else:
        members = src.select(*key_cols).distinct()
    if old is not None:
        if collated:
            members = new_members(members, old, match_cols)
        else:
            stored = old.select(*match_cols)
            cond = [members[c].eqNullSafe(stored[c]) for c in match_cols]
            members = members.join(stored, cond, "left_anti")
    start = _max_id(old, id_col) + 1
    fresh = assign_dense_ids(members.select(*key_cols), key_cols, id_col, start)
    extra = [col.alias(name) for name, col in (attrs or {}).items()]
    fresh = fresh.select(id_col, *key_cols, *extra)
    if old is None or new_only:
        return fresh
    return old.unionByName(fresh, allowMissingColumns=True)


def seed_dimension(spark: SparkSession, name: str, rules: R.Rules = R.DEFAULT_RULES) -> DataFrame:
    """The seeded members of a dimension, ids 1..n in seed order.

    Seeded location cities go through the location mapping too, so a seed
    and a mapped posting meet in one member (Preah Sihanouk -> Sihanoukville).
    """
    if name == "dim_source_agency":
        rows = [(i + 1, a, p) for i, (a, p) in enumerate(R.SEED_AGENCIES)]
        return spark.createDataFrame(rows, "source_id long, agency_name string, platform_type string")
    if name == "dim_location":
        rows = [(i + 1, c, p) for i, (c, p) in enumerate(R.SEED_LOCATIONS)]
        df = spark.createDataFrame(rows, "location_id long, city string, province string")
        return df.select("location_id", map_column("city", rules.location_mapping).alias("city"), "province",
                         F.lit(R.DEFAULT_COUNTRY).alias("country"))
    raise KeyError(name)


# Star A: one spec per dimension: id, member columns, source column of each
# member column in the staging table, attributes, match columns.
STAR_A = {
    "dim_time": dict(id="time_id", keys=["posting_date"], src={"posting_date": "posting_date"}),
    "dim_company": dict(id="company_id", keys=["company_name"], src={"company_name": "company_name"}),
    "dim_job": dict(id="job_id", keys=["job_title", "job_type", "experience_level", "education_level"],
                    src={c: c for c in ["job_title", "job_type", "experience_level", "education_level"]}),
    "dim_industry": dict(id="industry_id", keys=["industry_name"], src={"industry_name": "industry"}),
    "dim_location": dict(id="location_id", keys=["city", "province"], match=["city"], src={"city": "location"}),
    "dim_source_agency": dict(id="source_id", keys=["agency_name"], src={"agency_name": "source_agency"}),
}


def _attrs_a(name: str, run_ts) -> dict[str, Column]:
    ts = F.lit(run_ts).cast("timestamp") if run_ts is not None else F.lit(None).cast("timestamp")
    if name == "dim_time":
        return {name: col for name, col in zip(TIME_ATTRIBUTE_NAMES, time_attributes("posting_date"))}
    if name == "dim_company":
        return {"company_type": F.lit(R.DEFAULT_COMPANY_TYPE), "created_at": ts}
    if name == "dim_location":
        return {"country": F.lit(R.DEFAULT_COUNTRY), "region": F.lit(None).cast("string"),
                "lat": F.lit(None).cast("decimal(9,6)"), "lon": F.lit(None).cast("decimal(9,6)"), "created_at": ts}
    if name == "dim_source_agency":
        return {"platform_type": F.lit(None).cast("string"), "created_at": ts}
    return {"created_at": ts}


def staging_members(staging: DataFrame, name: str) -> DataFrame:
    spec = STAR_A[name]
    return staging.select(*[F.col(s).alias(k) for k, s in spec["src"].items()])


def merge_one_a(staging: DataFrame, current: dict[str, DataFrame | None], name: str, run_ts=None,
                seeds: bool = True, new_only: bool = False, rules: R.Rules = R.DEFAULT_RULES) -> DataFrame:
    """One star-A dimension merged from a staging batch (see merge_star_a)."""
    spec = STAR_A[name]
    old = current.get(name)
    if old is None and seeds and name in ("dim_location", "dim_source_agency"):
        old = seed_dimension(staging.sparkSession, name, rules)
    src = staging_members(staging, name)
    return merge_dimension(old, src, spec["keys"], spec["id"], _attrs_a(name, run_ts),
                           match_cols=spec.get("match"), collated=name != "dim_time",
                           new_only=new_only and current.get(name) is not None)


def merge_star_a(staging: DataFrame, current: dict[str, DataFrame | None], run_ts=None,
                 seeds: bool = True, parallel: bool = True, new_only: bool = False,
                 rules: R.Rules = R.DEFAULT_RULES) -> dict[str, DataFrame]:
    """Load the six star-A dimensions from a staging batch (insert-if-absent).

    The six merges are independent, so with ``parallel`` they are submitted
    from driver threads as concurrent Spark jobs and share the executors.
    With ``new_only`` a dimension already stored returns only its new
    members; a dimension not stored yet returns everything (seeds included).
    """
    def one(name: str) -> DataFrame:
        return merge_one_a(staging, current, name, run_ts, seeds, new_only, rules)

    if not parallel:
        return {name: one(name) for name in STAR_A}
    from concurrent.futures import ThreadPoolExecutor

    with ThreadPoolExecutor(max_workers=len(STAR_A)) as pool:
        futures = {name: pool.submit(one, name) for name in STAR_A}
        return {name: f.result() for name, f in futures.items()}


def enrich_dimension(dim: DataFrame, lookup: DataFrame, key: str, collated: bool = True) -> DataFrame:
    """K7: fill descriptive attributes from a lookup table on the member key.

    A stored attribute stays; only NULLs are filled, and what the lookup does
    not have stays NULL. Spellings of one key in the lookup are reduced to
    the least one first, so no member is repeated. The lookup joins on the
    conformed key; its size is not assumed, so the planner (AQE) picks a
    broadcast only when the runtime size allows it.
    """
    fill = [c for c in lookup.columns if c != key]

    def match(c):
        return F.collate(c, R.MATCH_COLLATION) if collated else c

    lookup = lookup.withColumn(key, F.collate(F.col(key), "UTF8_BINARY"))
    if collated:
        # One spelling of each matching key, found without carrying the attributes: the least one, which has them.
        lookup = lookup.join(distinct_members(lookup.select(key).where(F.col(key).isNotNull()), [key]), key, "left_semi")
    lk = lookup.groupBy(F.col(key).alias("_k")).agg(F.min_by(F.struct(*fill), F.col(key)).alias("_fill")) \
        .select(match(F.col("_k")).alias("_lk"), "_fill")
    joined = dim.join(lk, match(dim[key]) == lk["_lk"], "left")
    return joined.select(*[F.coalesce(dim[c], F.col("_fill")[c]).alias(c) if c in fill else dim[c] for c in dim.columns],
                         *[F.col("_fill")[c].alias(c) for c in fill if c not in dim.columns])
