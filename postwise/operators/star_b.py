"""Star B: the standard-profile star (cleaned, hash-unique postings).

Six dimensions (time, company, job, industry, location, source), each with the raw
spelling beside the standard one, and the fact with all of its keys. Members use
exact (binary) equality, like the unique constraints of that schema; of several raw
spellings a member keeps the least one it was first loaded with. The columns that
nothing fills (group, headquarters, category, sector, region, coordinates, url) are
there as NULL, for :func:`postwise.operators.dimensions.enrich_dimension`. Rows without a
posting date cannot load (``posting_date`` and ``time_key`` are NOT NULL there) and
stay out of the fact.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from postwise import rules as R
from postwise import schemas
from postwise.functions.dates import TIME_ATTRIBUTE_NAMES, time_attributes
from postwise.operators.dedup import dedup_exact
from postwise.operators.keys import assign_dense_ids, broadcast_if_small
from postwise.session import written

#: Dimension -> its key, the columns that make a member, and its raw columns by their source.
MEMBERS = {
    "dim_company": ("company_key", ["company_name_std"], {"company_name": "company_name_raw"}),
    "dim_job": ("job_key", ["job_title_std", "experience_band", "education_band"], {"job_title_raw": "job_title_raw"}),
    "dim_industry": ("industry_key", ["industry_name_std"], {"industry_name_raw": "industry_raw"}),
    "dim_location": ("location_key", ["country", "province", "city"], {}),
    "dim_source_agency": ("source_key", ["source_name_std"], {"source_name_raw": "source_agency_raw"}),
}


def time_members(dates: DataFrame, old: DataFrame | None = None) -> DataFrame:
    """dim_time rows of the dates (``time_key``) that ``old`` does not have yet, with all attributes."""
    new = dates.select("time_key").distinct()
    if old is not None:
        new = new.join(old.select("time_key"), "time_key", "left_anti")
    named = {n: c for n, c in zip(TIME_ATTRIBUTE_NAMES, time_attributes("time_key"))}
    full = {"time_key": F.col("time_key"), "full_date": F.col("time_key"), **named}
    return new.select(*[full[f.name].alias(f.name) for f in schemas.schema("b_dim_time")])


def new_members(rows: DataFrame, name: str, old: DataFrame | None, created_at: Column) -> DataFrame:
    """The members of ``rows`` that the dimension does not have yet, with dense keys after its last one."""
    key, own, raw = MEMBERS[name]
    members = rows.groupBy(*own).agg(*[F.min(c).alias(n) for n, c in raw.items()]) if raw else rows.select(*own).distinct()
    start = 1
    if old is not None:
        members = members.join(old.select(*own), [members[c].eqNullSafe(old[c]) for c in own], "left_anti")
        start += old.agg(F.max(key)).first()[0] or 0
    return schemas.fit(assign_dense_ids(members, own, key, start).withColumn("created_at", created_at), f"b_{name}")


def build_star_b(cleaned: DataFrame, existing: dict[str, DataFrame] | None = None, run_ts: str | None = None) -> dict[str, DataFrame]:
    """The dimensions (stored and new members) and the fact rows of a cleaned batch. Of a batch loaded after others,
    rows whose hash the stored fact (``existing["fact"]``) has are left out."""
    existing = existing or {}
    stored = existing.get("fact")
    rows = dedup_exact(cleaned, existing=stored).where(F.col("posting_date").isNotNull())
    rows = rows.withColumn("industry_name_std", F.coalesce("industry_std", F.lit(""))) \
        .withColumn("country", F.lit(R.DEFAULT_COUNTRY)) \
        .withColumn("source_name_std", F.coalesce("source_agency_std", F.lit(""))) \
        .withColumn("time_key", F.col("posting_date")) \
        .withColumnsRenamed({"experience_level_std": "experience_band", "education_level_std": "education_band"})
    # Six dimension merges and the fact read these rows: materialise them
    # once in the shared checkpoint folder instead of re-cleaning each time.
    rows = written(rows, "star-b-rows")
    ts = F.lit(run_ts).cast("timestamp")
    dims = {"dim_time": _together(existing.get("dim_time"), time_members(rows, existing.get("dim_time")))}
    fact = rows
    for name, (key, own, _) in MEMBERS.items():
        dims[name] = _together(existing.get(name), new_members(rows, name, existing.get(name), ts))
        # Broadcast a dimension only after measuring it (see broadcast_if_small).
        d, _ = broadcast_if_small(dims[name].select(key, *own))
        fact = fact.join(d, [fact[k].eqNullSafe(d[k]) for k in own], "inner").drop(*[d[k] for k in own])
    fact = fact.withColumns({"job_count": F.lit(1), "experience_level": F.col("experience_band"),
                             "education_level": F.col("education_band"), "collected_at": ts,
                             "source_record_id": F.col("posting_id").cast("string")})
    return {**dims, "fact": schemas.fit(fact, "b_fact")}


def _together(old: DataFrame | None, new: DataFrame) -> DataFrame:
    return new if old is None else old.unionByName(new, allowMissingColumns=True)


def register_views_b(spark: SparkSession, star: dict[str, DataFrame]) -> list[str]:
    """Temp views over star B's tables (``dw_job_`` before their names) and its two named views."""
    names = {f"dw_job_{n}": df for n, df in star.items()}
    names |= {"vw_salary_distribution": salary_distribution(star), "vw_job_demand_by_province": demand_by_province(star)}
    for name, df in names.items():
        df.createOrReplaceTempView(name)
    return list(names)


def salary_distribution(star: dict[str, DataFrame]) -> DataFrame:
    """Per standard industry: average USD min/max and postings, over
    postings with both figures."""
    f = star["fact"].where(F.col("salary_min_usd").isNotNull() & F.col("salary_max_usd").isNotNull())
    per = f.groupBy("industry_key").agg(F.sum("salary_min_usd").alias("_smin"), F.sum("salary_max_usd").alias("_smax"),
                                        F.count("*").alias("postings"))
    return per.join(star["dim_industry"].select("industry_key", "industry_name_std"), "industry_key").select(
        "industry_name_std",
        F.round(F.col("_smin").cast("double") / F.col("postings"), 6).alias("avg_salary_min_usd"),
        F.round(F.col("_smax").cast("double") / F.col("postings"), 6).alias("avg_salary_max_usd"),
        "postings")


def demand_by_province(star: dict[str, DataFrame]) -> DataFrame:
    """A10: postings per province."""
    per = star["fact"].groupBy("location_key").agg(F.count("*").alias("_n"))
    return per.join(star["dim_location"].select("location_key", "province"), "location_key") \
        .groupBy("province").agg(F.sum("_n").alias("job_count"))
