"""Registered queries: name -> (spark, sf_dir) -> DataFrame.

Every query reads the driver tables (through the posting fixture, the
built warehouse, or the tables directly), so its work grows with them.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postwise import rules as R
from postwise.functions import dates as D
from postwise.functions import salary as S
from postwise.functions import text as T
from postwise.operators.clean import clean_basic, clean_standard, map_column, record_hash
from postwise.plans import olap
from postwise.plans.warehouse import warehouse
from postwise.session import written
from postwise.sources.fixture import raw_postings

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(name: str):
    def deco(fn):
        QUERIES[name] = fn
        return fn
    return deco


def _raw(spark, sf):
    return raw_postings(spark, sf)


# ---- cleaning profiles and column functions -------------------------------

@query("clean_basic")
def q_clean_basic(spark, sf):
    return clean_basic(_raw(spark, sf))


@query("clean_standard")
def q_clean_standard(spark, sf):
    return clean_standard(_raw(spark, sf))


@query("title_case")
def q_title_case(spark, sf):
    r = _raw(spark, sf)
    return r.select("posting_id", T.title_case("job_title").alias("job_title_title"),
                    T.title_case("company_name").alias("company_title"))


@query("salary_range")
def q_salary_range(spark, sf):
    r = S.with_salary_range(_raw(spark, sf).select("posting_id", "salary"), "salary", "fixed")
    r = r.withColumnsRenamed({"salary_min": "_fmin", "salary_max": "_fmax"})
    r = S.with_salary_range(r, "salary", "reference")
    return r.select("posting_id", F.col("_fmin").alias("salary_min"), F.col("_fmax").alias("salary_max"),
                    F.col("salary_min").alias("salary_min_ref"), F.col("salary_max").alias("salary_max_ref"))


@query("parse_salary")
def q_parse_salary(spark, sf):
    return S.with_parsed_salary(_raw(spark, sf).select("posting_id", "salary"), "salary").drop("salary")


@query("parse_salary_reference")
def q_parse_salary_reference(spark, sf):
    return S.with_parsed_salary(_raw(spark, sf).select("posting_id", "salary"), "salary",
                                mode="reference").drop("salary")


@query("to_usd")
def q_to_usd(spark, sf):
    from postwise.sources.tables import read_table
    o = read_table(spark, sf, "orders")
    cur = F.when(F.col("o_orderkey") % 3 == 0, "USD").when(F.col("o_orderkey") % 3 == 1, "KHR").otherwise("EUR")
    return o.select("o_orderkey", cur.alias("currency"),
                    S.to_usd(F.col("o_totalprice").cast("decimal(20,4)"), cur).alias("amount_usd"))


def _mapped(name, col, mapping):
    @query(name)
    def fn(spark, sf):
        return _raw(spark, sf).select("posting_id", map_column(T.blank_strip(col), mapping).alias(col))
    return fn


_mapped("map_industry", "industry", R.INDUSTRY_MAPPING)
_mapped("map_location", "location", R.LOCATION_MAPPING)
_mapped("map_experience", "experience_level", R.EXPERIENCE_MAPPING)
_mapped("map_education", "education_level", R.EDUCATION_MAPPING)


@query("standardize_company")
def q_std_company(spark, sf):
    return _raw(spark, sf).select("posting_id", T.standardize_company("company_name").alias("company_name_std"),
                                  T.standardize_company("company_name", mode="reference").alias("company_name_ref"))


@query("standardize_title")
def q_std_title(spark, sf):
    fx, ref = T.standardize_title("job_title"), T.standardize_title("job_title", mode="reference")
    return _raw(spark, sf).select("posting_id", fx["raw"].alias("job_title_raw"), fx["std"].alias("job_title_std"),
                                  ref["std"].alias("job_title_ref"))


@query("split_location")
def q_split_location(spark, sf):
    loc = T.split_location("location")
    return _raw(spark, sf).select("posting_id", loc["province"].alias("province"), loc["city"].alias("city"))


@query("experience_band")
def q_experience_band(spark, sf):
    return _raw(spark, sf).select("posting_id", T.experience_band("experience_level").alias("experience_band"),
                                  T.experience_band("experience_level", mode="reference").alias("experience_ref"))


@query("education_band")
def q_education_band(spark, sf):
    return _raw(spark, sf).select("posting_id", T.education_band("education_level").alias("education_band"))


@query("parse_date")
def q_parse_date(spark, sf):
    p = D.parse_date_or("posting_date", R.DEFAULT_RUN_DATE)
    return _raw(spark, sf).select("posting_id", D.parse_date("posting_date").alias("posting_date"),
                                  p["posting_date"].alias("posting_date_or_run"),
                                  p["date_defaulted"].alias("date_defaulted"))


@query("week_mode1")
def q_week_mode1(spark, sf):
    from postwise.sources.tables import read_table
    d = read_table(spark, sf, "lineitem").select(F.col("l_shipdate").cast("date").alias("d")).distinct()
    return d.select("d", D.week_mode1("d").alias("week_mode1"), F.dayofweek("d").isin(1, 7).alias("is_weekend"))


@query("record_hash")
def q_record_hash(spark, sf):
    c = clean_standard(_raw(spark, sf))
    return c.select("posting_id", "hash_dedup",
                    record_hash("job_title_raw", "company_name_raw", "city").alias("hash_raw_fields"))


# ---- star A: dimensions, fact ------------------------------------------------

@query("time_dimension")
def q_time_dimension(spark, sf):
    return warehouse(spark, sf)["dim_time"].drop("time_key")


@query("dim_time")
def q_dim_time(spark, sf):
    return warehouse(spark, sf)["dim_time"].select("time_id", "posting_date", "year", "quarter", "month")


@query("dim_company")
def q_dim_company(spark, sf):
    return warehouse(spark, sf)["dim_company"].select("company_id", "company_name", "company_type")


@query("dim_job")
def q_dim_job(spark, sf):
    return warehouse(spark, sf)["dim_job"].select("job_id", "job_title", "job_type", "experience_level",
                                                  "education_level")


@query("dim_industry")
def q_dim_industry(spark, sf):
    return warehouse(spark, sf)["dim_industry"].select("industry_id", "industry_name")


@query("dim_location")
def q_dim_location(spark, sf):
    return warehouse(spark, sf)["dim_location"].select("location_id", "city", "province", "country")


@query("dim_source")
def q_dim_source(spark, sf):
    return warehouse(spark, sf)["dim_source_agency"].select("source_id", "agency_name", "platform_type")


@query("fact_postings")
def q_fact(spark, sf):
    return warehouse(spark, sf)["fact"].select("posting_id", "time_id", "company_id", "job_id", "industry_id",
                                               "location_id", "source_id", "job_count", "salary_min", "salary_max",
                                               "salary_avg", "has_salary")


# ---- OLAP --------------------------------------------------------------------

for _name in ["jobs_by_industry", "jobs_by_location", "top_companies", "salary_trend_monthly", "postings_by_week",
              "jobs_by_agency", "job_summary", "industry_analysis", "run_summary", "rollup_time",
              "rollup_location", "trend_mom"]:
    def _mk(fn_name):
        def fn(spark, sf):
            return getattr(olap, fn_name)(warehouse(spark, sf))
        fn.__name__ = fn_name
        return fn
    QUERIES[_name] = _mk(_name)


# ---- quality -----------------------------------------------------------------

from postwise.operators import quality as Q  # noqa: E402
from postwise.operators.dedup import dedup_exact, dedup_fuzzy  # noqa: E402
from postwise.operators.star_b import build_star_b, demand_by_province, salary_distribution  # noqa: E402
from postwise.plans import star_bench  # noqa: E402


@query("quality_report")
def q_quality_report(spark, sf):
    return Q.quality_report(warehouse(spark, sf)["staging"], Q.staging_checks())


@query("rejects")
def q_rejects(spark, sf):
    _, rej = Q.split_valid(warehouse(spark, sf)["staging"], Q.staging_checks())
    return rej.select("posting_id", F.array_join("reasons", ",").alias("reasons"))


@query("reference_check")
def q_reference_check(spark, sf):
    w = warehouse(spark, sf)
    dims = {"time": (w["dim_time"], "time_id"), "company": (w["dim_company"], "company_id"),
            "job": (w["dim_job"], "job_id"), "industry": (w["dim_industry"], "industry_id"),
            "location": (w["dim_location"], "location_id"), "source": (w["dim_source_agency"], "source_id")}
    return Q.check_references(w["fact"], dims)


@query("fanout_audit")
def q_fanout_audit(spark, sf):
    w = warehouse(spark, sf)
    return Q.check_fanout(w["staging"], w["fact"])


@query("constraint_check")
def q_constraint_check(spark, sf):
    w = warehouse(spark, sf)
    from postwise.operators.fact import FACT_KEYS
    parts = [Q.check_unique(w["dim_company"], ["company_name"], "dim_company"),
             Q.check_unique(w["dim_time"], ["posting_date"], "dim_time"),
             Q.check_unique(w["dim_industry"], ["industry_name"], "dim_industry"),
             Q.check_unique(w["dim_source_agency"], ["agency_name"], "dim_source_agency"),
             Q.check_unique(w["fact"], FACT_KEYS, "fact")]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


# ---- dedup ---------------------------------------------------------------------

@query("dedup_exact")
def q_dedup_exact(spark, sf):
    return dedup_exact(clean_standard(_raw(spark, sf))).select("posting_id", "hash_dedup")


@query("dedup_fuzzy")
def q_dedup_fuzzy(spark, sf):
    return dedup_fuzzy(clean_standard(_raw(spark, sf))).select("posting_id")


# ---- star B views ----------------------------------------------------------------

@query("salary_distribution")
def q_salary_distribution(spark, sf):
    return salary_distribution(_star_b(spark, sf))


@query("demand_by_province")
def q_demand_by_province(spark, sf):
    return demand_by_province(_star_b(spark, sf))


# ---- incremental loads ---------------------------------------------------------

BATCH_SPLIT_DATE = "1996-01-01"


def _two_batches(spark, sf):
    """The staging rows as two load batches: postings dated before
    ``BATCH_SPLIT_DATE`` first, the rest second. Both batches are loaded,
    so every row is processed."""
    st = warehouse(spark, sf)["staging"]
    early = F.col("posting_date") < F.lit(BATCH_SPLIT_DATE).cast("date")
    return st.where(early), st.where(~early)


@query("merge_dimension_incremental")
def q_merge_incremental(spark, sf):
    from postwise.operators.dimensions import merge_dimension
    b1, b2 = _two_batches(spark, sf)
    d1 = merge_dimension(None, b1.select("company_name"), ["company_name"], "company_id")
    d1 = d1.checkpoint(eager=True)
    d2 = merge_dimension(d1, b2.select("company_name"), ["company_name"], "company_id")
    return d2


@query("fact_upsert")
def q_fact_upsert(spark, sf):
    from postwise.operators.fact import build_fact, upsert_fact
    w = warehouse(spark, sf)
    dims = {k: w[k] for k in w if k.startswith("dim_")}
    # The first load has three quarters of the postings; the second the other quarter and
    # again a quarter, at raised salaries, so half of its keys are updates.
    st = w["staging"]
    b1 = st.where("posting_id % 4 <> 0")
    b2 = st.where("posting_id % 2 = 0").withColumns(
        {c: (F.col(c) + 100).cast(st.schema[c].dataType) for c in ("salary_min", "salary_max")})
    f1 = build_fact(b1, dims).withColumn("_batch", F.lit(1))
    f2 = build_fact(b2, dims).withColumn("_batch", F.lit(2))
    up = upsert_fact(f1, f2)
    return up.select("time_id", "company_id", "job_id", "industry_id", "location_id", "source_id",
                     "posting_id", "salary_min", "salary_max", "salary_avg")


# ---- star aggregates on the order tables -------------------------------------------

for _name, _fn in [("star_bench_by_nation", star_bench.by_nation), ("star_bench_top_suppliers", star_bench.top_suppliers),
                   ("star_bench_monthly", star_bench.monthly_price), ("star_bench_weekly", star_bench.weekly_lines),
                   ("star_bench_by_segment", star_bench.by_segment)]:
    QUERIES[_name] = _fn


@query("dedup_documents")
def q_dedup_documents(spark, sf):
    from postwise.operators.docdedup import dedup_documents
    from postwise.sources.tables import read_table, spread
    return dedup_documents(spread(read_table(spark, sf, "documents").select("doc_id", "text")))


@query("stream_distinct_events")
def q_stream_distinct_events(spark, sf):
    from postwise.streaming.ingest import stream_distinct_events
    return stream_distinct_events(spark, sf)


@query("land_raw")
def q_land_raw(spark, sf):
    from postwise.sources.csv import land_raw
    r = _raw(spark, sf).withColumn("posting_ref", F.col("posting_id").cast("string"))
    out = land_raw(r, "2025-01-01 00:00:00")
    return out.select("load_timestamp", "job_title", "company_name", "location_raw", "salary_raw",
                      "posting_date_raw", "source_agency", "extra")


@query("not_null_check")
def q_not_null_check(spark, sf):
    from postwise.operators.fact import FACT_KEYS
    w = warehouse(spark, sf)
    return Q.check_not_null({
        "dim_time": (w["dim_time"], ["time_id", "posting_date"]),
        "dim_company": (w["dim_company"], ["company_id", "company_name"]),
        "dim_job": (w["dim_job"], ["job_id", "job_title"]),
        "dim_industry": (w["dim_industry"], ["industry_id", "industry_name"]),
        "dim_location": (w["dim_location"], ["location_id", "city"]),
        "dim_source_agency": (w["dim_source_agency"], ["source_id", "agency_name"]),
        "fact": (w["fact"], FACT_KEYS),
    })


# ---- rule files, screening, loads -------------------------------------------------------

RULE_FILE = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "rule_sets", "regional.json")


@query("clean_with_rule_file")
def q_rule_file(spark, sf, path: str = RULE_FILE):
    """Both profiles under the rules of a file."""
    from postwise.rulefile import load_rules
    rules = load_rules(spark, path)
    basic = clean_basic(_raw(spark, sf), rules)
    checked = basic.select("posting_id", "industry", *[c.alias(n) for n, c in Q.staging_checks(rules=rules).items()
                                                       if n in ("required_fields", "salary_valid")])
    std = clean_standard(_raw(spark, sf), rules).select(
        "posting_id", "company_name_std", "job_title_std", "experience_level_std", "education_level_std", "salary_currency",
        "salary_min_usd", "posting_date")
    return checked.join(std, "posting_id")


def _scratch_warehouse(spark, name):
    from postwise.plans.incremental import Warehouse
    from postwise.session import scratch_path
    return Warehouse(spark, scratch_path(spark, "postwise-loads", f"{name}-{uuid.uuid4().hex}"))


@query("load_screen")
def q_load_screen(spark, sf):
    """Two batches screened, the second (all postings) after the first (the odd ones): rows by status and reasons."""
    from postwise.plans.incremental import screen_rows
    st = warehouse(spark, sf)["staging"]
    one = screen_rows(st.where("posting_id % 2 = 1"))
    two = screen_rows(st, stored=one.where("status = 'accepted'"))
    rows = one.withColumn("batch", F.lit(1)).unionByName(two.withColumn("batch", F.lit(2)))
    return rows.groupBy("batch", "status", F.array_join("reasons", ",").alias("reasons")).agg(F.count("*").alias("rows"))


@query("load_screened")
def q_load_screened(spark, sf):
    """One screened load of all postings: what each table holds after it."""
    from postwise.plans.incremental import processed_batches, run_pipeline
    wh = _scratch_warehouse(spark, "screened")
    run_pipeline(spark, _raw(spark, sf), wh.root, "all", f"{R.DEFAULT_RUN_DATE} 00:00:00", screen=True)
    screened = wh.read("screened/batch_id=all").groupBy(F.col("status").alias("metric")).agg(F.count("*").alias("rows"))
    for name, df in [("staged", wh.read("staging")), ("fact", wh.read("fact")), ("hashes", wh.read("loaded_hashes")),
                     ("processed", processed_batches(wh)), ("logged", wh.read("etl_logs").where("status = 'COMPLETED'"))]:
        screened = screened.unionByName(df.agg(F.count("*").alias("rows")).select(F.lit(name).alias("metric"), "rows"))
    return screened


@query("cleaned_table")
def q_cleaned_table(spark, sf):
    """The cleaned table after two batches, the second (all postings) after the first (ids not divisible by 3)."""
    wh = _scratch_warehouse(spark, "cleaned")
    c = written(clean_standard(_raw(spark, sf)), "cleaned")
    wh.append_unique("postings_cleaned", c.where("posting_id % 3 <> 0").withColumn("batch", F.lit(1)))
    wh.append_unique("postings_cleaned", c.withColumn("batch", F.lit(2)))
    return wh.read("postings_cleaned").select("hash_dedup", "posting_id", "batch", "hash_prefix")


# ---- star B in full -----------------------------------------------------------------------

def _star_b(spark, sf):
    from postwise.plans.warehouse import warehouse_b
    return warehouse_b(spark, sf)


@query("star_b_fact")
def q_star_b_fact(spark, sf):
    return _star_b(spark, sf)["fact"].drop("collected_at")


@query("star_b_dim_job")
def q_star_b_dim_job(spark, sf):
    return _star_b(spark, sf)["dim_job"].select("job_key", "job_title_raw", "job_title_std", "experience_band", "education_band")


@query("star_b_dim_company")
def q_star_b_dim_company(spark, sf):
    return _star_b(spark, sf)["dim_company"].select("company_key", "company_name", "company_name_std")


@query("star_b_dim_time")
def q_star_b_dim_time(spark, sf):
    return _star_b(spark, sf)["dim_time"]


@query("star_b_incremental")
def q_star_b_incremental(spark, sf):
    """Star B of two batches, the second (all postings) after the first (ids not divisible by 3), through its views."""
    from postwise.operators.star_b import register_views_b
    c = clean_standard(_raw(spark, sf))
    one = {n: t.checkpoint(eager=True) for n, t in build_star_b(c.where("posting_id % 3 <> 0")).items()}
    two = build_star_b(c, existing=one)
    register_views_b(spark, {**two, "fact": one["fact"].unionByName(two["fact"])})
    return spark.table("vw_job_demand_by_province").join(
        spark.sql("""SELECT l.province, count(DISTINCT f.job_key) AS jobs, count(DISTINCT f.company_key) AS companies,
            max(t.week_of_year) AS last_week FROM dw_job_fact f JOIN dw_job_dim_location l USING (location_key)
            JOIN dw_job_dim_time t USING (time_key) GROUP BY l.province"""), "province")


# ---- unique keys, widths, mergeable distinct counts -----------------------------------------

@query("unique_keys_check")
def q_unique_keys(spark, sf):
    """All unique keys of both stars; facts hold every 50th row twice, dim_company every 7th name twice."""
    from postwise import schemas
    a, b = dict(warehouse(spark, sf)), _star_b(spark, sf)
    a["fact"] = a["fact"].unionByName(a["fact"].where("posting_id % 50 = 0"))
    b["fact"] = b["fact"].unionByName(b["fact"].where("CAST(source_record_id AS BIGINT) % 50 = 0"))
    again = a["dim_company"].where("company_id % 7 = 0").withColumn("company_id", F.col("company_id") + 1_000_000_000)
    a["dim_company"] = a["dim_company"].unionByName(again)
    tables = {n: (t, schemas.UNIQUE[n]) for n, t in a.items() if n in schemas.UNIQUE and n != "fact"}
    tables["fact"] = (a["fact"], [("posting_id",)])
    return Q.check_unique_keys(tables | {f"b_{n}": (t, schemas.UNIQUE[f"b_{n}"]) for n, t in b.items()})


@query("schema_check")
def q_schema_check(spark, sf):
    """Reasons why rows do not fit the declared staging table: every 9th location is too wide, every 11th id null,
    every 13th date no date."""
    from postwise import schemas
    st = warehouse(spark, sf)["staging"].withColumn("_id", F.col("posting_id"))
    bad = st.withColumns({
        "location": F.when(F.col("_id") % 9 == 0, F.repeat(F.lit("x"), 101)).otherwise(F.col("location")),
        "posting_id": F.when(F.col("_id") % 11 != 0, F.col("_id")),
        "posting_date": F.when(F.col("_id") % 13 == 0, "soon").otherwise(F.col("posting_date").cast("string"))})
    good, rejected = schemas.split_fitting(bad, "staging")
    counts = rejected.select(F.explode("reasons").alias("reason")).groupBy("reason").agg(F.count("*").alias("rows"))
    return counts.unionByName(good.agg(F.count("*").alias("rows")).select(F.lit("fits").alias("reason"), "rows"))


@query("companies_rollup")
def q_companies_rollup(spark, sf):
    """Distinct companies per industry and year, counted, with whether merged monthly sketches come within 5 %."""
    w = warehouse(spark, sf)
    exact = w["fact"].groupBy("industry_id", "posting_year").agg(F.count_distinct("company_id").alias("companies"))
    est = olap.companies_from_sketches(olap.company_sketches(w["fact"]), ["industry_id", "posting_year"])
    both = exact.join(est.withColumnRenamed("companies", "_est"), ["industry_id", "posting_year"])
    return both.withColumn("near", F.abs(F.col("_est") - F.col("companies")) <= F.greatest(0.05 * F.col("companies"), F.lit(1.0))) \
        .join(w["dim_industry"].select("industry_id", "industry_name"), "industry_id") \
        .select("industry_name", "posting_year", "companies", "near")


# ---- planted defects, appends, enrichment ----------------------------------------------------

@query("reference_defects")
def q_reference_defects(spark, sf):
    """The reference check against dimensions that lack members."""
    w = warehouse(spark, sf)
    dims = {"company": (w["dim_company"].where("company_id % 10 <> 3"), "company_id"), "job": (w["dim_job"], "job_id"),
            "location": (w["dim_location"].where("location_id <> 1"), "location_id"), "time": (w["dim_time"].where("time_id > 40"), "time_id")}
    return Q.check_references(w["fact"], dims)


@query("fact_append")
def q_fact_append(spark, sf):
    """Two batches appended, the second (all rows) after the first (odd ids): conflicts told and rows kept."""
    from postwise.operators.fact import FACT_KEYS
    from postwise.plans.incremental import load_fact
    wh, fact = _scratch_warehouse(spark, "append"), warehouse(spark, sf)["fact"]
    told = [load_fact(wh, fact.where(c).withColumn("load_seq", F.lit(n)), mode="append")
            for n, c in enumerate(["posting_id % 2 = 1", "posting_id >= 0"], 1)]
    kept = wh.read("fact")
    rows = kept.groupBy("load_seq").agg(F.count("*").alias("rows"), F.count_distinct(*FACT_KEYS).alias("keys"))
    conflicts = F.when(F.col("load_seq") == 1, told[0]).otherwise(told[1]).cast("long")
    return rows.withColumn("conflicts", conflicts)


@query("enrich_dimension")
def q_enrich_dimension(spark, sf):
    """Companies with the segment of the customer of that name, where the name is spelt as in the customer table."""
    from postwise.operators.dimensions import enrich_dimension
    from postwise.sources.tables import read_table
    c = read_table(spark, sf, "customer").select(F.col("c_name").alias("company_name"), F.col("c_mktsegment").alias("sector"))
    return enrich_dimension(warehouse(spark, sf)["dim_company"].select("company_id", "company_name"), c, "company_name")
