"""Warehouse invariants on the built star at sf0.001."""

from pyspark.sql import functions as F

from postwise.plans import olap
from postwise.plans.warehouse import warehouse
from tests.conftest import SF_SMALL


def test_breakdowns_sum_to_total(spark):
    w = warehouse(spark, SF_SMALL)
    total = w["fact"].count()
    assert total == w["staging"].count()
    for q in (olap.jobs_by_industry, olap.jobs_by_location, olap.jobs_by_agency):
        assert q(w).agg(F.sum("job_postings")).collect()[0][0] == total
    summary = {r["metric"]: r["value"] for r in olap.run_summary(w).collect()}
    assert summary["Total Jobs"] == total
    assert w["fact"].agg(F.sum("job_count")).collect()[0][0] == total
    roll = olap.rollup_time(w).where("grouping_level = 7").collect()[0]["job_postings"]
    assert roll == total


def test_dimension_keys_dense_and_unique(spark):
    w = warehouse(spark, SF_SMALL)
    for name, key in [("dim_company", "company_id"), ("dim_job", "job_id"), ("dim_time", "time_id"),
                      ("dim_industry", "industry_id"), ("dim_location", "location_id"),
                      ("dim_source_agency", "source_id")]:
        r = w[name].agg(F.min(key).alias("lo"), F.max(key).alias("hi"), F.count("*").alias("n"),
                        F.count_distinct(key).alias("d")).collect()[0]
        assert (r["lo"], r["hi"], r["d"]) == (1, r["n"], r["n"]), name


def test_approx_distinct_close(spark):
    w = warehouse(spark, SF_SMALL)
    exact = {r["industry_name"]: r["unique_companies"] for r in olap.industry_analysis(w).collect()}
    approx = {r["industry_name"]: r["unique_companies"] for r in olap.industry_analysis(w, approx=True).collect()}
    assert exact.keys() == approx.keys()
    for k in exact:
        assert abs(approx[k] - exact[k]) <= max(2, 0.06 * exact[k])
