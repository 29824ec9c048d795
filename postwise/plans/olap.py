"""OLAP queries over the star.

Shape of every query: aggregate the fact by member id first (partial
aggregation runs map-side), then attach the member names. Aggregates are at
most dimension-sized, so the joins after them are cheap; the planner (AQE)
broadcasts them when their measured size allows. Averages are returned as
DOUBLE rounded to 6 digits: ``round(double(sum) / count, 6)``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from postwise.functions.dates import week_mode1


def _avg(c) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.round(F.sum(c).cast("double") / F.count(c), 6)


def fact_by(fact: DataFrame, dim: DataFrame, id_col: str, name_col: str, alias: str,
            count_alias: str = "job_postings") -> DataFrame:
    """Postings per member name (aggregate by id, then join the name)."""
    per_id = fact.groupBy(id_col).agg(F.count("*").alias("_n"))
    named = per_id.join(dim.select(id_col, name_col), id_col)
    return named.groupBy(F.col(name_col).alias(alias)).agg(F.sum("_n").alias(count_alias))


def top_n(df: DataFrame, n: int, by: str, name: str) -> DataFrame:
    """First ``n`` rows by ``by`` descending, ties broken by ``name``."""
    return df.orderBy(F.col(by).desc(), F.col(name).asc()).limit(n)


def jobs_by_industry(w: dict) -> DataFrame:
    """A1: postings by industry, most first."""
    return fact_by(w["fact"], w["dim_industry"], "industry_id", "industry_name", "industry") \
        .orderBy(F.desc("job_postings"), "industry")


def jobs_by_location(w: dict) -> DataFrame:
    """A2: postings by city."""
    return fact_by(w["fact"], w["dim_location"], "location_id", "city", "location") \
        .orderBy(F.desc("job_postings"), "location")


def top_companies(w: dict, n: int = 20) -> DataFrame:
    """A3: the ``n`` companies with most postings."""
    return top_n(fact_by(w["fact"], w["dim_company"], "company_id", "company_name", "company"), n,
                 "job_postings", "company")


def jobs_by_agency(w: dict) -> DataFrame:
    """Postings by source agency."""
    return fact_by(w["fact"], w["dim_source_agency"], "source_id", "agency_name", "agency") \
        .orderBy(F.desc("job_postings"), "agency")


def salary_trend_monthly(w: dict) -> DataFrame:
    """A4: monthly average min/max salary per industry (both present)."""
    f = w["fact"].where(F.col("salary_min").isNotNull() & F.col("salary_max").isNotNull())
    per = f.groupBy("time_id", "industry_id").agg(F.sum("salary_min").alias("_smin"),
                                                   F.sum("salary_max").alias("_smax"),
                                                   F.count("*").alias("_n"))
    t = w["dim_time"].select("time_id", "year", "month")
    i = w["dim_industry"].select("industry_id", "industry_name")
    g = per.join(t, "time_id").join(i, "industry_id").groupBy("year", "month", "industry_name").agg(
        F.round(F.sum("_smin").cast("double") / F.sum("_n"), 6).alias("avg_salary_min"),
        F.round(F.sum("_smax").cast("double") / F.sum("_n"), 6).alias("avg_salary_max"))
    return g.orderBy("year", "month", "industry_name")


def postings_by_week(w: dict) -> DataFrame:
    """A5: postings per (year, MySQL WEEK(date, 1))."""
    per = w["fact"].groupBy("time_id").agg(F.count("*").alias("_n"))
    t = w["dim_time"].select("time_id", "year", week_mode1("posting_date").alias("week_of_year"))
    return per.join(t, "time_id").groupBy("year", "week_of_year").agg(F.sum("_n").alias("job_postings")) \
        .orderBy("year", "week_of_year")


def industry_analysis(w: dict, approx: bool = False) -> DataFrame:
    """Per industry: postings, postings with salary, average salary_avg,
    distinct companies (exact; ``approx=True`` uses a HyperLogLog++ sketch,
    which keeps one small sketch per group instead of every company id)."""
    companies = F.approx_count_distinct("company_id", 0.02) if approx else F.count_distinct("company_id")
    per = w["fact"].groupBy("industry_id").agg(
        F.count("*").alias("total_jobs"),
        F.sum(F.when(F.col("salary_min").isNotNull(), 1).otherwise(0)).alias("jobs_with_salary"),
        _avg("salary_avg").alias("avg_salary"),
        companies.alias("unique_companies"),
    )
    return per.join(w["dim_industry"].select("industry_id", "industry_name"), "industry_id") \
        .select("industry_name", "total_jobs", "jobs_with_salary", "avg_salary", "unique_companies")


def job_summary(w: dict) -> DataFrame:
    """The denormalised star view (one row per fact row)."""
    f, d = w["fact"], w
    return (f.join(d["dim_job"].select("job_id", "job_title", "experience_level", "education_level"), "job_id")
            .join(d["dim_company"].select("company_id", "company_name"), "company_id")
            .join(d["dim_industry"].select("industry_id", "industry_name"), "industry_id")
            .join(d["dim_location"].select("location_id", "city"), "location_id")
            .join(d["dim_time"].select("time_id", "posting_date"), "time_id")
            .join(d["dim_source_agency"].select("source_id", "agency_name"), "source_id")
            .select("job_title", "company_name", "industry_name", "city", "posting_date", "salary_min",
                    "salary_max", "salary_avg", "agency_name", "experience_level", "education_level"))


def run_summary(w: dict) -> DataFrame:
    """(metric, label, value): totals in one pass plus the top
    industry and top location with their names (ties -> smaller name)."""
    f = w["fact"]
    totals = f.agg(F.count("*").alias("total"), F.count_if(F.col("salary_min").isNotNull()).alias("with_salary"),
                   F.count_distinct("company_id").alias("companies"))
    rows = totals.select(F.explode(F.array(
        F.struct(F.lit("Total Jobs").alias("metric"), F.lit(None).cast("string").alias("label"),
                 F.col("total").alias("value")),
        F.struct(F.lit("Jobs with Salary").alias("metric"), F.lit(None).cast("string").alias("label"),
                 F.col("with_salary").alias("value")),
        F.struct(F.lit("Unique Companies").alias("metric"), F.lit(None).cast("string").alias("label"),
                 F.col("companies").alias("value")),
    )).alias("r")).select("r.*")
    ind = top_n(fact_by(f, w["dim_industry"], "industry_id", "industry_name", "label", "value"), 1, "value", "label")
    loc = top_n(fact_by(f, w["dim_location"], "location_id", "city", "label", "value"), 1, "value", "label")
    return rows.unionByName(ind.select(F.lit("Top Industry").alias("metric"), "label", "value")) \
        .unionByName(loc.select(F.lit("Top Location").alias("metric"), "label", "value"))


def rollup_time(w: dict) -> DataFrame:
    """Postings rolled up year -> quarter -> month (``grouping_level`` is
    the grouping id: 0 month rows, 1 quarter totals, 3 year totals, 7 all)."""
    per = w["fact"].groupBy("time_id").agg(F.count("*").alias("_n"))
    t = w["dim_time"].select("time_id", "year", "quarter", "month")
    return per.join(t, "time_id").rollup("year", "quarter", "month").agg(
        F.grouping_id().alias("grouping_level"), F.sum("_n").alias("job_postings"))


def rollup_location(w: dict) -> DataFrame:
    """Postings rolled up province -> city."""
    per = w["fact"].groupBy("location_id").agg(F.count("*").alias("_n"))
    loc = w["dim_location"].select("location_id", "province", "city")
    return per.join(loc, "location_id").rollup("province", "city").agg(
        F.grouping_id().alias("grouping_level"), F.sum("_n").alias("job_postings"))


def trend_mom(w: dict) -> DataFrame:
    """Monthly postings per industry and the change from the industry's
    previous month with postings. The window runs on the monthly aggregate
    (industries x months rows), partitioned by industry."""
    per = w["fact"].groupBy("time_id", "industry_id").agg(F.count("*").alias("_n"))
    t = w["dim_time"].select("time_id", "year", "month")
    i = w["dim_industry"].select("industry_id", "industry_name")
    m = per.join(t, "time_id").join(i, "industry_id").groupBy("industry_name", "year", "month") \
        .agg(F.sum("_n").alias("job_postings"))
    win = Window.partitionBy("industry_name").orderBy("year", "month")
    prev = F.lag("job_postings").over(win)
    return m.select("industry_name", "year", "month", "job_postings", prev.alias("prev_postings"),
                    (F.col("job_postings") - prev).alias("mom_change"))


#: Precision of the stored sketches: relative error about 1.04 / sqrt(2^SKETCH_BITS).
SKETCH_BITS = 12


def company_sketches(fact: DataFrame, bits: int = SKETCH_BITS) -> DataFrame:
    """One sketch of the companies per (industry_id, posting_year, posting_month), to be stored beside the fact.
    A new batch adds sketches of its own; the fact is not read again."""
    return fact.groupBy("industry_id", "posting_year", "posting_month").agg(
        F.hll_sketch_agg("company_id", F.lit(bits)).alias("companies"))


def companies_from_sketches(sketches: DataFrame, by: list[str]) -> DataFrame:
    """Estimated distinct companies per ``by`` (columns of the sketches; none: overall), by merging them."""
    return sketches.groupBy(*by).agg(F.hll_sketch_estimate(F.hll_union_agg("companies")).alias("companies"))
