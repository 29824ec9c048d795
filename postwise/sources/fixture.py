"""The shared posting fixture ``raw_postings``.

Postings are derived from ``orders`` joined to ``customer`` by one SQL text
that both Spark and DuckDB run, so every query's work grows with the tables.
It covers every parse branch, NULL, blank, padding, mixed case, en dash and
Khmer digits. ``posting_id`` (the order key) is unique.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from postwise.sources.tables import read_table, spread

POSTING_COLUMNS = ["job_title", "company_name", "industry", "location", "salary", "job_type",
                   "experience_level", "education_level", "posting_date", "source_agency"]

_FIXTURE_SQL = """SELECT o.o_orderkey AS posting_id,
  CASE o.o_orderkey % 11 WHEN 0 THEN 'Senior UI/UX designer' WHEN 1 THEN '  software developer ' WHEN 2 THEN 'civil  engineer'
    WHEN 3 THEN 'HR OFFICER' WHEN 4 THEN 'branch manager' WHEN 5 THEN 'luxury goods seller' WHEN 6 THEN 'UX researcher'
    WHEN 7 THEN 'accountant' WHEN 8 THEN 'it''s 3rd-line support' WHEN 9 THEN NULL ELSE '' END AS job_title,
  CASE o.o_orderkey % 5 WHEN 0 THEN c.c_name WHEN 1 THEN upper(c.c_name) WHEN 2 THEN c.c_name || ' Co., Ltd'
    WHEN 3 THEN c.c_name || ' PLC' ELSE '  ' || c.c_name || ' (Cambodia) ' END AS company_name,
  CASE o.o_orderkey % 13 WHEN 0 THEN 'Banking & Finance' WHEN 1 THEN 'Information Technology' WHEN 2 THEN 'Retail & Wholesale'
    WHEN 3 THEN 'Catering' WHEN 4 THEN 'Foods and drinks' WHEN 5 THEN 'Clothing' WHEN 6 THEN 'Casino' WHEN 7 THEN 'Mechanical'
    WHEN 8 THEN 'NGO / INGO' WHEN 9 THEN 'catering' WHEN 10 THEN ' Education ' WHEN 11 THEN NULL ELSE 'Marine Science' END AS industry,
  CASE o.o_orderkey % 7 WHEN 0 THEN 'Phnom Penh' WHEN 1 THEN 'Preah Sihanouk' WHEN 2 THEN 'Chamkar Mon, Phnom Penh'
    WHEN 3 THEN ' siem reap' WHEN 4 THEN 'Kandal' WHEN 5 THEN 'A, B, c' ELSE NULL END AS location,
  CASE o.o_orderkey % 17 WHEN 0 THEN 'USD 800 – 1,200' WHEN 1 THEN 'USD 300 - 500' WHEN 2 THEN '300-500 USD' WHEN 3 THEN 'USD 800 - 1500'
    WHEN 4 THEN 'USD 1500 – 2000' WHEN 5 THEN 'Negotiable' WHEN 6 THEN 'Not disclosed' WHEN 7 THEN '$500-1000' WHEN 8 THEN 'KHR 400,000 - 800,000'
    WHEN 9 THEN '$700' WHEN 10 THEN 'from 500' WHEN 11 THEN '' WHEN 12 THEN NULL WHEN 13 THEN 'USD ៥០០ - ៨០០' WHEN 14 THEN 'USD 9000 - 50'
    WHEN 15 THEN 'not disclosed' ELSE 'USD ' || CAST(CAST(floor(o.o_totalprice / 100) AS BIGINT) AS STRING) || ' - ' || CAST(CAST(floor(o.o_totalprice / 50) AS BIGINT) AS STRING) END AS salary,
  CASE o.o_orderstatus WHEN 'F' THEN 'Full-time' WHEN 'O' THEN ' Part-time' ELSE NULL END AS job_type,
  CASE o.o_orderpriority WHEN '1-URGENT' THEN 'No experience' WHEN '2-HIGH' THEN 'Junior Level (1–2 years)' WHEN '3-MEDIUM' THEN 'Mid Level (2–5 years)'
    WHEN '5-LOW' THEN 'senior staff' ELSE 'Other' END AS experience_level,
  CASE o.o_orderkey % 19 WHEN 0 THEN 'Bachelor''s Degree' WHEN 1 THEN 'Associate Degree' WHEN 2 THEN 'High School' WHEN 3 THEN 'Any education level'
    WHEN 4 THEN 'No education level' WHEN 5 THEN NULL WHEN 6 THEN 'Professional Certificate' ELSE 'PhD' END AS education_level,
  CASE o.o_orderkey % 4 WHEN 0 THEN CAST(month(o.o_orderdate) AS STRING) || '/' || CAST(day(o.o_orderdate) AS STRING) || '/' || CAST(year(o.o_orderdate) AS STRING)
    WHEN 1 THEN lpad(CAST(month(o.o_orderdate) AS STRING), 2, '0') || '/' || lpad(CAST(day(o.o_orderdate) AS STRING), 2, '0') || '/' || CAST(year(o.o_orderdate) AS STRING) || ' 10:20:30'
    WHEN 2 THEN CAST(day(o.o_orderdate) AS STRING) || '/' || CAST(month(o.o_orderdate) AS STRING) || '/' || CAST(year(o.o_orderdate) AS STRING)
    ELSE CASE WHEN o.o_orderkey % 8 = 3 THEN '13/13/2024' ELSE NULL END END AS posting_date,
  CASE o.o_orderkey % 6 WHEN 0 THEN 'Facebook Page' WHEN 1 THEN 'Jobify Cambodia' WHEN 2 THEN 'LinkedIn Cambodia' WHEN 3 THEN 'CamHR' WHEN 4 THEN 'BongThom' ELSE 'khmer24 jobs' END AS source_agency
FROM {orders} o JOIN {customer} c ON o.o_custkey = c.c_custkey"""

# The same text for DuckDB, where ``orders`` and ``customer`` are views.
FIXTURE_SQL_DUCKDB = _FIXTURE_SQL.replace("{orders}", "orders").replace("{customer}", "customer")


def raw_postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Postings derived from orders x customer (one row per order)."""
    orders = spread(read_table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"))
    customer = read_table(spark, sf_dir, "customer")
    return spark.sql(_FIXTURE_SQL, orders=orders, customer=customer)
