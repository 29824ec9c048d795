"""name -> DuckDB SQL for the registered queries (see ``postwise.oracle``).

Types are cast where DuckDB's defaults differ from Spark's (``year()`` and
``sum()`` widths), so schema and values compare one to one.
"""

from __future__ import annotations

from postwise import oracle as O
from postwise import rules as R

ORACLE: dict[str, str] = {}

A, B, RAW = O.BASE_A, O.BASE_B, O.with_(O.RAW)
q, norm, strip, title = O.q, O.norm, O.strip, O.title

# ---- cleaning profiles and column functions ----------------------------------

ORACLE["clean_basic"] = A + "SELECT * FROM staging"
ORACLE["clean_standard"] = B + "SELECT * FROM cleaned"
ORACLE["title_case"] = RAW + f"SELECT posting_id, {title('job_title')} AS job_title_title, {title('company_name')} AS company_title FROM raw"
ORACLE["salary_range"] = RAW + f"""SELECT posting_id,
  {O.salary_range_sql(O.khmer('salary'), 1, R.SALARY_PATTERNS_FIXED)} AS salary_min,
  {O.salary_range_sql(O.khmer('salary'), 2, R.SALARY_PATTERNS_FIXED)} AS salary_max,
  {O.salary_range_sql(O.khmer('salary'), 1, R.SALARY_PATTERNS_REFERENCE)} AS salary_min_ref,
  {O.salary_range_sql(O.khmer('salary'), 2, R.SALARY_PATTERNS_REFERENCE)} AS salary_max_ref
FROM raw"""
ORACLE["parse_salary"] = O.with_(O.RAW, O.SAL1, O.SAL2, O.SAL) + \
    "SELECT posting_id, salary_min_usd, salary_max_usd, salary_currency, salary_type FROM sal"

_RR, _RS = R.SALARY_RANGE_PATTERN_REFERENCE, R.SALARY_SINGLE_PATTERN_REFERENCE
_ref_rates = " ".join(f"WHEN {q(k)} THEN CAST({v} AS DECIMAL(12,6))" for k, v in R.CURRENCY_RATES.items())
ORACLE["parse_salary_reference"] = RAW + f"""SELECT posting_id,
  CASE WHEN ok THEN TRY_CAST(lo * (CASE cur {_ref_rates} ELSE CAST(1.0 AS DECIMAL(12,6)) END) AS DECIMAL(12,2)) END AS salary_min_usd,
  CASE WHEN ok THEN TRY_CAST(hi * (CASE cur {_ref_rates} ELSE CAST(1.0 AS DECIMAL(12,6)) END) AS DECIMAL(12,2)) END AS salary_max_usd,
  CASE WHEN ok THEN cur ELSE 'USD' END AS salary_currency, salary_type
FROM (
  SELECT posting_id, ok, lo, hi, cur,
    CASE WHEN t = '' THEN 'undisclosed' WHEN contains(lower(t), 'negotiable') THEN 'negotiable'
      WHEN contains(lower(t), 'not disclosed') THEN 'undisclosed'
      WHEN ok THEN CASE WHEN is_range THEN 'range' ELSE 'fixed' END ELSE 'undisclosed' END AS salary_type,
    t
  FROM (
    SELECT posting_id, t, is_range, lo, hi,
      (is_range OR is_single) AND lo IS NOT NULL AND hi IS NOT NULL AS ok,
      replace(upper(coalesce(nullif(raw_cur, ''), 'USD')), '$', 'USD') AS cur
    FROM (
      SELECT posting_id, t, regexp_matches(t, {q(_RR)}) AS is_range, regexp_matches(t, {q(_RS)}) AS is_single,
        CASE WHEN regexp_matches(t, {q(_RR)}) THEN regexp_extract(t, {q(_RR)}, 1) ELSE regexp_extract(t, {q(_RS)}, 1) END AS raw_cur,
        TRY_CAST(replace(CASE WHEN regexp_matches(t, {q(_RR)}) THEN regexp_extract(t, {q(_RR)}, 2) ELSE regexp_extract(t, {q(_RS)}, 2) END, ',', '') AS DECIMAL(20,4)) AS lo,
        TRY_CAST(replace(CASE WHEN regexp_matches(t, {q(_RR)}) THEN regexp_extract(t, {q(_RR)}, 3) ELSE regexp_extract(t, {q(_RS)}, 2) END, ',', '') AS DECIMAL(20,4)) AS hi
      FROM (SELECT posting_id, {O.khmer(norm('salary'))} AS t FROM raw))))"""

ORACLE["to_usd"] = f"""SELECT o_orderkey, cur AS currency,
  TRY_CAST(CAST(o_totalprice AS DECIMAL(20,4)) * (CASE cur {_ref_rates} ELSE CAST(1.0 AS DECIMAL(12,6)) END) AS DECIMAL(12,2)) AS amount_usd
FROM (SELECT o_orderkey, o_totalprice, CASE o_orderkey % 3 WHEN 0 THEN 'USD' WHEN 1 THEN 'KHR' ELSE 'EUR' END AS cur FROM orders)"""

for _n, _c, _m in [("map_industry", "industry", R.INDUSTRY_MAPPING), ("map_location", "location", R.LOCATION_MAPPING),
                   ("map_experience", "experience_level", R.EXPERIENCE_MAPPING),
                   ("map_education", "education_level", R.EDUCATION_MAPPING)]:
    ORACLE[_n] = RAW + f"SELECT posting_id, {O.mapping(strip(_c), _m)} AS {_c} FROM raw"


def _company_ref(x: str) -> str:
    v = f"lower({norm(x)})"
    for s in R.COMPANY_SUFFIXES:
        v = f"replace({v}, {q(s)}, '')"
    return title(norm(v))


ORACLE["standardize_company"] = RAW + f"SELECT posting_id, {O.company_std('company_name')} AS company_name_std, {_company_ref('company_name')} AS company_name_ref FROM raw"
ORACLE["standardize_title"] = RAW + f"""SELECT posting_id, {norm('job_title')} AS job_title_raw,
  {O.keyword_chain(norm('job_title'), R.TITLE_KEYWORDS, {'ux'}, norm('job_title'))} AS job_title_std,
  {O.keyword_chain(norm('job_title'), R.TITLE_KEYWORDS, set(), norm('job_title'), reference=True)} AS job_title_ref
FROM raw"""
ORACLE["split_location"] = B + "SELECT posting_id, province, city FROM cleaned"
ORACLE["experience_band"] = RAW + f"""SELECT posting_id,
  {O.keyword_chain(f"lower({norm('experience_level')})", R.EXPERIENCE_KEYWORDS, {'mid'}, norm('experience_level'))} AS experience_band,
  {O.keyword_chain(f"lower({norm('experience_level')})", R.EXPERIENCE_KEYWORDS, set(), norm('experience_level'), reference=True)} AS experience_ref
FROM raw"""
ORACLE["education_band"] = B + "SELECT posting_id, education_level_std AS education_band FROM cleaned"
ORACLE["parse_date"] = RAW + f"""SELECT posting_id, {O.dt('posting_date', R.DATE_FORMATS)} AS posting_date,
  coalesce({O.dt(strip('posting_date'), R.BASIC_DATE_FORMATS)}, DATE {q(R.DEFAULT_RUN_DATE)}) AS posting_date_or_run,
  {O.dt(strip('posting_date'), R.BASIC_DATE_FORMATS)} IS NULL AS date_defaulted
FROM raw"""

WEEK1 = "CAST(CASE WHEN month({d}) = 1 AND weekofyear({d}) >= 52 THEN 0 WHEN month({d}) = 12 AND weekofyear({d}) = 1 THEN 53 ELSE weekofyear({d}) END AS INTEGER)"
ORACLE["week_mode1"] = f"""SELECT d, {WEEK1.format(d='d')} AS week_mode1, dayofweek(d) IN (0, 6) AS is_weekend
FROM (SELECT DISTINCT CAST(l_shipdate AS DATE) AS d FROM lineitem)"""
ORACLE["record_hash"] = B + """SELECT posting_id, hash_dedup,
  sha256(concat_ws('||', coalesce(job_title_raw, ''), coalesce(company_name_raw, ''), coalesce(city, ''))) AS hash_raw_fields
FROM cleaned"""

# ---- star A ------------------------------------------------------------------

_I = "CAST({} AS INTEGER)"
ORACLE["time_dimension"] = A + f"""SELECT time_id, posting_date,
  {_I.format('day(posting_date)')} AS posting_day, {_I.format('month(posting_date)')} AS posting_month,
  {_I.format('quarter(posting_date)')} AS posting_quarter, {_I.format('year(posting_date)')} AS posting_year,
  dayname(posting_date) AS posting_weekday, dayofweek(posting_date) IN (0, 6) AS is_weekend,
  {_I.format('day(posting_date)')} AS day, {_I.format('month(posting_date)')} AS month, monthname(posting_date) AS month_name,
  {_I.format('quarter(posting_date)')} AS quarter, {_I.format('year(posting_date)')} AS year,
  {_I.format('weekofyear(posting_date)')} AS week_of_year, {_I.format('dayofweek(posting_date) + 1')} AS day_of_week,
  dayname(posting_date) AS day_name
FROM dim_time"""
ORACLE["dim_time"] = A + f"SELECT time_id, posting_date, {_I.format('year')} AS year, {_I.format('quarter')} AS quarter, {_I.format('month')} AS month FROM dim_time"
ORACLE["dim_company"] = A + f"SELECT company_id, company_name, {q(R.DEFAULT_COMPANY_TYPE)} AS company_type FROM dim_company"
ORACLE["dim_job"] = A + "SELECT * FROM dim_job"
ORACLE["dim_industry"] = A + "SELECT * FROM dim_industry"
ORACLE["dim_location"] = A + f"SELECT location_id, city, province, {q(R.DEFAULT_COUNTRY)} AS country FROM dim_location"
ORACLE["dim_source"] = A + "SELECT source_id, agency_name, platform_type FROM dim_source_agency"
ORACLE["fact_postings"] = A + """SELECT posting_id, time_id, company_id, job_id, industry_id, location_id, source_id,
  job_count, salary_min, salary_max, salary_avg, has_salary FROM fact"""

# ---- OLAP ----------------------------------------------------------------------

_B = "CAST({} AS BIGINT)"
ORACLE["jobs_by_industry"] = A + "SELECT i.industry_name AS industry, count(*) AS job_postings FROM fact f JOIN dim_industry i ON f.industry_id = i.industry_id GROUP BY 1"
ORACLE["jobs_by_location"] = A + "SELECT l.city AS location, count(*) AS job_postings FROM fact f JOIN dim_location l ON f.location_id = l.location_id GROUP BY 1"
ORACLE["top_companies"] = A + "SELECT c.company_name AS company, count(*) AS job_postings FROM fact f JOIN dim_company c ON f.company_id = c.company_id GROUP BY 1 ORDER BY job_postings DESC, company LIMIT 20"
ORACLE["jobs_by_agency"] = A + "SELECT s.agency_name AS agency, count(*) AS job_postings FROM fact f JOIN dim_source_agency s ON f.source_id = s.source_id GROUP BY 1"
ORACLE["salary_trend_monthly"] = A + f"""SELECT {_I.format('t.year')} AS year, {_I.format('t.month')} AS month, i.industry_name,
  round(CAST(sum(f.salary_min) AS DOUBLE) / count(*), 6) AS avg_salary_min,
  round(CAST(sum(f.salary_max) AS DOUBLE) / count(*), 6) AS avg_salary_max
FROM fact f JOIN dim_time t ON f.time_id = t.time_id JOIN dim_industry i ON f.industry_id = i.industry_id
WHERE f.salary_min IS NOT NULL AND f.salary_max IS NOT NULL GROUP BY 1, 2, 3"""
ORACLE["postings_by_week"] = A + f"""SELECT {_I.format('t.year')} AS year, {WEEK1.format(d='t.posting_date')} AS week_of_year, count(*) AS job_postings
FROM fact f JOIN dim_time t ON f.time_id = t.time_id GROUP BY 1, 2"""
ORACLE["industry_analysis"] = A + """SELECT i.industry_name, count(*) AS total_jobs,
  CAST(sum(CASE WHEN f.salary_min IS NOT NULL THEN 1 ELSE 0 END) AS BIGINT) AS jobs_with_salary,
  round(CAST(sum(f.salary_avg) AS DOUBLE) / count(f.salary_avg), 6) AS avg_salary,
  count(DISTINCT c.company_id) AS unique_companies
FROM fact f JOIN dim_industry i ON f.industry_id = i.industry_id JOIN dim_company c ON f.company_id = c.company_id
GROUP BY i.industry_name"""
ORACLE["job_summary"] = A + """SELECT j.job_title, c.company_name, i.industry_name, l.city, t.posting_date, f.salary_min, f.salary_max,
  f.salary_avg, s.agency_name, j.experience_level, j.education_level
FROM fact f JOIN dim_job j ON f.job_id = j.job_id JOIN dim_company c ON f.company_id = c.company_id
JOIN dim_industry i ON f.industry_id = i.industry_id JOIN dim_location l ON f.location_id = l.location_id
JOIN dim_time t ON f.time_id = t.time_id JOIN dim_source_agency s ON f.source_id = s.source_id"""
ORACLE["run_summary"] = A + """SELECT 'Total Jobs' AS metric, CAST(NULL AS VARCHAR) AS label, count(*) AS value FROM fact
UNION ALL SELECT 'Jobs with Salary', NULL, count(*) FROM fact WHERE salary_min IS NOT NULL
UNION ALL SELECT 'Unique Companies', NULL, count(DISTINCT company_id) FROM fact
UNION ALL (SELECT 'Top Industry', i.industry_name, count(*) AS n FROM fact f JOIN dim_industry i ON f.industry_id = i.industry_id
  GROUP BY i.industry_name ORDER BY n DESC, i.industry_name LIMIT 1)
UNION ALL (SELECT 'Top Location', l.city, count(*) AS n FROM fact f JOIN dim_location l ON f.location_id = l.location_id
  GROUP BY l.city ORDER BY n DESC, l.city LIMIT 1)"""
ORACLE["rollup_time"] = A + f"""SELECT {_I.format('t.year')} AS year, {_I.format('t.quarter')} AS quarter, {_I.format('t.month')} AS month,
  GROUPING(t.year, t.quarter, t.month) AS grouping_level, count(*) AS job_postings
FROM fact f JOIN dim_time t ON f.time_id = t.time_id GROUP BY ROLLUP (t.year, t.quarter, t.month)"""
ORACLE["rollup_location"] = A + """SELECT l.province, l.city, GROUPING(l.province, l.city) AS grouping_level, count(*) AS job_postings
FROM fact f JOIN dim_location l ON f.location_id = l.location_id GROUP BY ROLLUP (l.province, l.city)"""
ORACLE["trend_mom"] = A + f"""SELECT industry_name, year, month, job_postings,
  lag(job_postings) OVER (PARTITION BY industry_name ORDER BY year, month) AS prev_postings,
  job_postings - lag(job_postings) OVER (PARTITION BY industry_name ORDER BY year, month) AS mom_change
FROM (SELECT i.industry_name, {_I.format('t.year')} AS year, {_I.format('t.month')} AS month, count(*) AS job_postings
  FROM fact f JOIN dim_time t ON f.time_id = t.time_id JOIN dim_industry i ON f.industry_id = i.industry_id GROUP BY 1, 2, 3)"""

# ---- quality -------------------------------------------------------------------

_REQ = " AND ".join(f"trim({f}) <> ''" for f in R.REQUIRED_FIELDS)
_DATE = f"(NOT date_defaulted AND posting_date <= DATE {q(R.DEFAULT_RUN_DATE)})"
_SAL = f"((salary_min IS NULL AND salary_max IS NULL) OR coalesce(salary_min <= salary_max AND salary_min >= {R.MIN_SALARY} AND salary_max <= {R.MAX_SALARY}, false))"
_LEN = " AND ".join(f"coalesce(length({c}) <= {n}, true)" for c, n in R.STAGING_LENGTHS.items())
_CHECKS = {"required_fields": f"({_REQ})", "date_valid": _DATE, "salary_valid": _SAL, "length_valid": f"({_LEN})"}
ORACLE["quality_report"] = A + " UNION ALL ".join(
    f"SELECT {q(n)} AS \"check\", CAST(sum(CASE WHEN {c} THEN 0 ELSE 1 END) AS BIGINT) AS failed, count(*) AS total FROM staging"
    for n, c in _CHECKS.items())
ORACLE["rejects"] = A + "SELECT posting_id, concat_ws(',', " + ", ".join(
    f"CASE WHEN NOT {c} THEN {q(n)} END" for n, c in _CHECKS.items()) + ") AS reasons FROM staging WHERE NOT (" + \
    " AND ".join(_CHECKS.values()) + ")"
ORACLE["reference_check"] = A + " UNION ALL ".join(
    f"SELECT {q(n)} AS dimension, count(*) AS missing FROM fact f WHERE NOT EXISTS (SELECT 1 FROM {d} d WHERE d.{k} = f.{k})"
    for n, d, k in [("time", "dim_time", "time_id"), ("company", "dim_company", "company_id"), ("job", "dim_job", "job_id"),
                    ("industry", "dim_industry", "industry_id"), ("location", "dim_location", "location_id"),
                    ("source", "dim_source_agency", "source_id")])
ORACLE["fanout_audit"] = A + """SELECT coalesce(n, 0) AS fact_rows, count(*) AS staging_rows
FROM staging s LEFT JOIN (SELECT posting_id, count(*) AS n FROM fact GROUP BY 1) f ON s.posting_id = f.posting_id GROUP BY 1"""
ORACLE["constraint_check"] = A + " UNION ALL ".join(
    f"SELECT {q(t)} AS \"table\", count(*) AS duplicate_keys, CAST(coalesce(sum(n), 0) AS BIGINT) AS duplicate_rows "
    f"FROM (SELECT count(*) AS n FROM {t} GROUP BY {k} HAVING count(*) > 1)"
    for t, k in [("dim_company", "company_name"), ("dim_time", "posting_date"), ("dim_industry", "industry_name"),
                 ("dim_source_agency", "agency_name"),
                 ("fact", "time_id, company_id, job_id, industry_id, location_id, source_id")])

# ---- dedup -----------------------------------------------------------------------

_DEDUP = "deduped AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY hash_dedup ORDER BY posting_id) AS rn FROM cleaned) WHERE rn = 1)"
BASE_B_DEDUP = B.rstrip("\n") + ",\n" + _DEDUP + "\n"
ORACLE["dedup_exact"] = BASE_B_DEDUP + "SELECT posting_id, hash_dedup FROM deduped"
ORACLE["dedup_fuzzy"] = B.rstrip("\n") + f""",
fz AS (SELECT posting_id, company_name_std AS co, lower(concat_ws('|', job_title_raw, province, coalesce(city, ''))) AS s,
  posting_date AS d FROM cleaned)
SELECT r.posting_id FROM fz r
WHERE NOT (r.d IS NOT NULL AND EXISTS (
  SELECT 1 FROM fz x WHERE x.co = r.co AND x.d IS NOT NULL
    AND (x.d < r.d OR (x.d = r.d AND x.posting_id < r.posting_id)) AND date_diff('day', x.d, r.d) <= {R.TIME_WINDOW_DAYS}
    AND (CASE WHEN greatest(length(x.s), length(r.s)) = 0 THEN 1.0
         ELSE 1.0 - levenshtein(x.s, r.s) / greatest(length(x.s), length(r.s)) END) >= {R.SIMILARITY_THRESHOLD}))"""

# ---- star B views ------------------------------------------------------------------

_BF = BASE_B_DEDUP.rstrip("\n") + ",\nbf AS (SELECT * FROM deduped WHERE posting_date IS NOT NULL)\n"
ORACLE["salary_distribution"] = _BF + """SELECT coalesce(industry_std, '') AS industry_name_std,
  round(CAST(sum(salary_min_usd) AS DOUBLE) / count(*), 6) AS avg_salary_min_usd,
  round(CAST(sum(salary_max_usd) AS DOUBLE) / count(*), 6) AS avg_salary_max_usd, count(*) AS postings
FROM bf WHERE salary_min_usd IS NOT NULL AND salary_max_usd IS NOT NULL GROUP BY 1"""
ORACLE["demand_by_province"] = _BF + "SELECT province, count(*) AS job_count FROM bf GROUP BY province"

# ---- incremental loads -------------------------------------------------------------

_SPLIT = "DATE '1996-01-01'"
ORACLE["merge_dimension_incremental"] = A.rstrip("\n") + f""",
b1 AS (SELECT min(company_name) AS company_name, {O.mk('company_name')} AS k FROM staging WHERE posting_date < {_SPLIT} GROUP BY 2),
b2 AS (SELECT min(company_name) AS company_name FROM staging WHERE posting_date >= {_SPLIT}
       AND {O.mk('company_name')} NOT IN (SELECT k FROM b1) GROUP BY {O.mk('company_name')})
SELECT row_number() OVER (ORDER BY company_name) AS company_id, company_name FROM b1
UNION ALL
SELECT (SELECT count(*) FROM b1) + row_number() OVER (ORDER BY company_name), company_name FROM b2"""
ORACLE["fact_upsert"] = A + f"""SELECT time_id, company_id, job_id, industry_id, location_id, source_id,
  (array_agg(posting_id ORDER BY batch, posting_id))[1] AS posting_id,
  (array_agg(salary_min ORDER BY batch DESC, posting_id DESC))[1] AS salary_min,
  (array_agg(salary_max ORDER BY batch DESC, posting_id DESC))[1] AS salary_max,
  CAST(((array_agg(salary_min ORDER BY batch DESC, posting_id DESC))[1]
        + (array_agg(salary_max ORDER BY batch DESC, posting_id DESC))[1]) / 2 AS DECIMAL(10,2)) AS salary_avg
FROM (SELECT *, 1 AS batch FROM fact WHERE posting_id % 4 <> 0
      UNION ALL
      SELECT * REPLACE (CAST(salary_min + 100 AS DECIMAL(10,2)) AS salary_min,
                        CAST(salary_max + 100 AS DECIMAL(10,2)) AS salary_max), 2 AS batch
      FROM fact WHERE posting_id % 2 = 0)
GROUP BY time_id, company_id, job_id, industry_id, location_id, source_id"""

# ---- star aggregates on the order tables -----------------------------------------------

ORACLE["star_bench_by_nation"] = """SELECT n_name AS nation, count(*) AS line_count,
  round(sum(l_extendedprice * (1 - l_discount)), 2) AS revenue
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name"""
ORACLE["star_bench_top_suppliers"] = """SELECT s_name AS supplier, count(*) AS line_count
FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY s_name ORDER BY line_count DESC, supplier LIMIT 20"""
ORACLE["star_bench_monthly"] = """SELECT CAST(year(l_shipdate) AS INTEGER) AS year, CAST(month(l_shipdate) AS INTEGER) AS month,
  l_returnflag, round(avg(l_extendedprice), 6) AS avg_price, round(avg(l_discount), 6) AS avg_discount, count(*) AS line_count
FROM lineitem GROUP BY 1, 2, 3"""
ORACLE["star_bench_weekly"] = f"""SELECT CAST(year(d) AS INTEGER) AS year, {WEEK1.format(d='d')} AS week_of_year, count(*) AS line_count
FROM (SELECT CAST(l_shipdate AS DATE) AS d FROM lineitem) GROUP BY 1, 2"""
ORACLE["star_bench_by_segment"] = """SELECT c_mktsegment AS segment, count(*) AS order_count, round(sum(o_totalprice), 2) AS order_value
FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1"""

# ---- streaming ----------------------------------------------------------------------

ORACLE["stream_distinct_events"] = "SELECT DISTINCT user_id, event_type FROM events"

# ---- raw landing ------------------------------------------------------------------------

ORACLE["land_raw"] = RAW + """SELECT TIMESTAMP '2025-01-01 00:00:00' AS load_timestamp, job_title, company_name,
  location AS location_raw, salary AS salary_raw, posting_date AS posting_date_raw, source_agency,
  '{"posting_id":' || CAST(posting_id AS VARCHAR) || ',"posting_ref":"' || CAST(posting_id AS VARCHAR) || '"}' AS extra
FROM raw"""

# ---- NOT NULL audit ----------------------------------------------------------------------

_NN = [("dim_time", ["time_id", "posting_date"]), ("dim_company", ["company_id", "company_name"]),
       ("dim_job", ["job_id", "job_title"]), ("dim_industry", ["industry_id", "industry_name"]),
       ("dim_location", ["location_id", "city"]), ("dim_source_agency", ["source_id", "agency_name"]),
       ("fact", ["time_id", "company_id", "job_id", "industry_id", "location_id", "source_id"])]
ORACLE["not_null_check"] = A + " UNION ALL ".join(
    f"SELECT {q(t)} AS \"table\", {q(c)} AS \"column\", count(*) FILTER (WHERE {c} IS NULL) AS nulls FROM {t}"
    for t, cols in _NN for c in cols)

# ---- near-duplicate documents ----------------------------------------------------

ORACLE["dedup_documents"] = r"""WITH w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(lower(text), '[ \t\n\x0B\f\r]+'), lambda x: x <> '') AS w FROM documents),
s AS (
  SELECT DISTINCT doc_id, unnest(list_transform(range(1, greatest(len(w) - 3, 2)),
    lambda i: array_to_string(list_slice(w, i, i + 4), ' '))) AS h
  FROM w WHERE len(w) > 0),
k AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id, b.doc_id AS other, count(*) AS common FROM s a JOIN s b ON a.h = b.h AND b.doc_id < a.doc_id GROUP BY ALL),
near AS (
  SELECT p.doc_id, min(other) AS duplicate_of FROM p JOIN k x ON x.doc_id = p.doc_id JOIN k y ON y.doc_id = p.other
  WHERE common >= 0.8 * (x.n + y.n - common) GROUP BY p.doc_id)
SELECT d.doc_id, near.duplicate_of FROM documents d LEFT JOIN near ON near.doc_id = d.doc_id"""

# ---- rule files, screening, loads: the values of the file are stated here anew ------------

_FILE_MAP = {"Catering": "Restaurants", "Casino": "Gaming", "NGO / INGO": "Non-profit", "Marine Science": "Research"}
_FILE_CO = f"lower({norm('r.company_name')})"
for _s in ("plc", "(cambodia)"):
    _FILE_CO = f"replace({_FILE_CO}, {q(_s)}, '')"
_FILE_CO = title(rf"regexp_replace({norm(_FILE_CO)}, '[\s.,;:]+$', '')")
ORACLE["clean_with_rule_file"] = O.with_(O.RAW, O.STAGING, O.SAL1, O.SAL2.replace("'USD')", "'KHR')")) + f"""
SELECT r.posting_id, {O.mapping('s.industry_raw', _FILE_MAP)} AS industry,
  trim(s.job_title) <> '' AND trim(s.company_name) <> '' AS required_fields,
  (s.salary_min IS NULL AND s.salary_max IS NULL)
    OR coalesce(s.salary_min <= s.salary_max AND s.salary_min >= 300 AND s.salary_max <= 1500, false) AS salary_valid,
  {_FILE_CO} AS company_name_std,
  {O.keyword_chain(norm('r.job_title'), [('support', 'Support'), ('designer', 'Designer'), ('engineer', 'Engineering')], set(), norm('r.job_title'))} AS job_title_std,
  {O.keyword_chain(f"lower({norm('r.experience_level')})", [('junior', 'Starter'), ('senior', 'Lead')], set(), norm('r.experience_level'))} AS experience_level_std,
  CASE WHEN {norm('r.education_level')} = '' THEN 'Unknown' ELSE {norm('r.education_level')} END AS education_level_std,
  CASE WHEN l.salary_type IN ('range', 'fixed') THEN l.cur ELSE 'KHR' END AS salary_currency,
  CASE WHEN l.salary_type IN ('range', 'fixed') THEN TRY_CAST(l.lo * (CASE l.cur WHEN 'KHR' THEN CAST(0.00025 AS DECIMAL(12,6))
    ELSE CAST(1.0 AS DECIMAL(12,6)) END) AS DECIMAL(12,2)) END AS salary_min_usd,
  {O.dt('r.posting_date', ['d/M/yyyy', 'M/d/yyyy'])} AS posting_date
FROM raw r JOIN (SELECT st.*, {strip('ra.industry')} AS industry_raw FROM staging st JOIN raw ra ON ra.posting_id = st.posting_id) s
  ON s.posting_id = r.posting_id JOIN sal2 l ON l.posting_id = r.posting_id"""

_HASHED = A.rstrip("\n") + f""",
hashed AS (SELECT *, sha256(concat_ws('||', {norm('job_title')}, {norm('company_name')}, {norm('location')},
    coalesce(strftime(posting_date, '%Y-%m-%d'), ''))) AS h,
  concat_ws(',', {", ".join(f"CASE WHEN NOT {c} THEN {q(n)} END" for n, c in _CHECKS.items())}) AS reasons FROM staging),
"""
ORACLE["load_screen"] = _HASHED + """one AS (SELECT *, CASE WHEN reasons <> '' THEN 'rejected'
    WHEN posting_id = min(posting_id) FILTER (WHERE reasons = '') OVER (PARTITION BY h) THEN 'accepted' ELSE 'duplicate' END AS status
  FROM hashed WHERE posting_id % 2 = 1),
two AS (SELECT *, CASE WHEN reasons <> '' THEN 'rejected' WHEN h IN (SELECT h FROM one WHERE status = 'accepted') THEN 'duplicate'
    WHEN posting_id = min(posting_id) FILTER (WHERE reasons = '') OVER (PARTITION BY h) THEN 'accepted' ELSE 'duplicate' END AS status
  FROM hashed)
SELECT 1 AS batch, status, reasons, count(*) AS rows FROM one GROUP BY ALL
UNION ALL SELECT 2, status, reasons, count(*) FROM two GROUP BY ALL"""
ORACLE["load_screened"] = _HASHED + f"""one AS (SELECT *, CASE WHEN reasons <> '' THEN 'rejected'
    WHEN posting_id = min(posting_id) FILTER (WHERE reasons = '') OVER (PARTITION BY h) THEN 'accepted' ELSE 'duplicate' END AS status
  FROM hashed),
ok AS (SELECT * FROM one WHERE status = 'accepted')
SELECT status AS metric, count(*) AS rows FROM one GROUP BY status
UNION ALL SELECT 'staged', count(*) FROM ok
UNION ALL SELECT 'hashes', count(*) FROM ok
UNION ALL SELECT 'fact', count(*) FROM (SELECT DISTINCT posting_date, {O.mk('company_name')}, {O.mk('job_title')}, {O.mk('job_type')},
  {O.mk('experience_level')}, {O.mk('education_level')}, {O.mk('industry')}, {O.mk('location')}, {O.mk('source_agency')} FROM ok)
UNION ALL SELECT 'processed', 1
UNION ALL SELECT 'logged', 1"""
ORACLE["cleaned_table"] = B.rstrip("\n") + """,
one AS (SELECT hash_dedup, min(posting_id) AS posting_id FROM cleaned WHERE posting_id % 3 <> 0 GROUP BY 1),
two AS (SELECT hash_dedup, min(posting_id) AS posting_id FROM cleaned WHERE hash_dedup NOT IN (SELECT hash_dedup FROM one) GROUP BY 1)
SELECT hash_dedup, posting_id, 1 AS batch, substr(hash_dedup, 1, 2) AS hash_prefix FROM one
UNION ALL SELECT hash_dedup, posting_id, 2, substr(hash_dedup, 1, 2) FROM two"""

# ---- star B in full -----------------------------------------------------------------------

_SB = _BF.rstrip() + f""",
b AS (SELECT *, coalesce(industry_std, '') AS industry_name_std, coalesce(source_agency_std, '') AS source_name_std FROM bf),
dc AS (SELECT row_number() OVER (ORDER BY company_name_std) AS company_key, * FROM (SELECT company_name_std, min(company_name_raw) AS company_name
  FROM b GROUP BY 1)),
dj AS (SELECT row_number() OVER (ORDER BY job_title_std, experience_band, education_band) AS job_key, * FROM (
  SELECT job_title_std, experience_level_std AS experience_band, education_level_std AS education_band, min(job_title_raw) AS job_title_raw
  FROM b GROUP BY 1, 2, 3)),
di AS (SELECT row_number() OVER (ORDER BY industry_name_std) AS industry_key, industry_name_std FROM (SELECT DISTINCT industry_name_std FROM b)),
dl AS (SELECT row_number() OVER (ORDER BY province NULLS FIRST, city NULLS FIRST) AS location_key, province, city
  FROM (SELECT DISTINCT province, city FROM b)),
ds AS (SELECT row_number() OVER (ORDER BY source_name_std) AS source_key, source_name_std FROM (SELECT DISTINCT source_name_std FROM b))
"""
ORACLE["star_b_fact"] = _SB + """SELECT posting_date AS time_key, company_key, job_key, industry_key, location_key, source_key, 1 AS job_count,
  salary_min_usd, salary_max_usd, salary_currency, salary_type, employment_type, experience_level_std AS experience_level,
  education_level_std AS education_level, posting_date, CAST(posting_id AS VARCHAR) AS source_record_id, hash_dedup
FROM b JOIN dc USING (company_name_std) JOIN di USING (industry_name_std) JOIN ds USING (source_name_std)
  JOIN dj ON dj.job_title_std = b.job_title_std AND dj.experience_band = b.experience_level_std AND dj.education_band = b.education_level_std
  JOIN dl ON dl.province IS NOT DISTINCT FROM b.province AND dl.city IS NOT DISTINCT FROM b.city"""
ORACLE["star_b_dim_job"] = _SB + "SELECT job_key, job_title_raw, job_title_std, experience_band, education_band FROM dj"
ORACLE["star_b_dim_company"] = _SB + "SELECT company_key, company_name, company_name_std FROM dc"
ORACLE["star_b_dim_time"] = _SB + f"""SELECT d AS time_key, d AS full_date, {_I.format('day(d)')} AS day, {_I.format('month(d)')} AS month,
  monthname(d) AS month_name, {_I.format('quarter(d)')} AS quarter, {_I.format('year(d)')} AS year, {_I.format('weekofyear(d)')} AS week_of_year,
  {_I.format('dayofweek(d) + 1')} AS day_of_week, dayname(d) AS day_name, dayofweek(d) IN (0, 6) AS is_weekend
FROM (SELECT DISTINCT posting_date AS d FROM b)"""
ORACLE["star_b_incremental"] = B.rstrip("\n") + f""",
one AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY hash_dedup ORDER BY posting_id) AS rn FROM cleaned WHERE posting_id % 3 <> 0)
  WHERE rn = 1 AND posting_date IS NOT NULL),
two AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY hash_dedup ORDER BY posting_id) AS rn FROM cleaned
  WHERE hash_dedup NOT IN (SELECT hash_dedup FROM one)) WHERE rn = 1 AND posting_date IS NOT NULL),
b AS (SELECT * FROM one UNION ALL SELECT * FROM two)
SELECT province, count(*) AS job_count, count(DISTINCT (job_title_std, experience_level_std, education_level_std)) AS jobs,
  count(DISTINCT company_name_std) AS companies, {_I.format('max(weekofyear(posting_date))')} AS last_week
FROM b GROUP BY province"""

# ---- unique keys, widths, mergeable distinct counts -----------------------------------------

_NONE = [("dim_time", "time_id"), ("dim_time", "posting_date"), ("dim_company", "company_id"), ("dim_job", "job_id"),
         ("dim_job", "job_title,job_type,experience_level,education_level"), ("dim_industry", "industry_id"),
         ("dim_industry", "industry_name"), ("dim_location", "location_id"), ("dim_location", "city,province"),
         ("dim_source_agency", "source_id"), ("dim_source_agency", "agency_name"), ("b_dim_time", "time_key"),
         ("b_dim_company", "company_key"), ("b_dim_company", "company_name_std"), ("b_dim_job", "job_key"),
         ("b_dim_job", "job_title_std,experience_band,education_band"), ("b_dim_industry", "industry_key"),
         ("b_dim_industry", "industry_name_std"), ("b_dim_location", "location_key"), ("b_dim_location", "country,province,city"),
         ("b_dim_source_agency", "source_key"), ("b_dim_source_agency", "source_name_std")]
ORACLE["unique_keys_check"] = O.with_(O.RAW, O.STAGING, O.DIMS, O.SAL1, O.SAL2, O.SAL, O.CLEANED0, O.CLEANED, _DEDUP) + " UNION ALL ".join([
    *[f"SELECT {q(t)} AS \"table\", {q(k)} AS \"key\", CAST(0 AS BIGINT) AS duplicate_keys, CAST(0 AS BIGINT) AS duplicate_rows" for t, k in _NONE],
    "SELECT 'dim_company', 'company_name', count(*), 2 * count(*) FROM dim_company WHERE company_id % 7 = 0",
    "SELECT 'fact', 'posting_id', count(*), 2 * count(*) FROM staging WHERE posting_id % 50 = 0",
    "SELECT 'b_fact', 'hash_dedup', count(*), 2 * count(*) FROM deduped WHERE posting_date IS NOT NULL AND posting_id % 50 = 0"])
ORACLE["schema_check"] = A + """SELECT 'location: longer than 100' AS reason, count(*) AS rows FROM staging WHERE posting_id % 9 = 0
UNION ALL SELECT 'posting_id: null', count(*) FROM staging WHERE posting_id % 11 = 0
UNION ALL SELECT 'posting_date: not a date', count(*) FROM staging WHERE posting_id % 13 = 0
UNION ALL SELECT 'fits', count(*) FROM staging WHERE posting_id % 9 <> 0 AND posting_id % 11 <> 0 AND posting_id % 13 <> 0"""
ORACLE["companies_rollup"] = A + f"""SELECT industry_name, {_I.format('year(posting_date)')} AS posting_year,
  count(DISTINCT company_id) AS companies, true AS near FROM fact JOIN dim_industry USING (industry_id) GROUP BY 1, 2"""

# ---- planted defects, appends, enrichment ----------------------------------------------------

ORACLE["reference_defects"] = A + """SELECT 'company' AS dimension, count(*) FILTER (WHERE company_id % 10 = 3) AS missing FROM fact
UNION ALL SELECT 'job', 0 UNION ALL SELECT 'location', count(*) FILTER (WHERE location_id = 1) FROM fact
UNION ALL SELECT 'time', count(*) FILTER (WHERE time_id <= 40) FROM fact"""
_SIX = "time_id, company_id, job_id, industry_id, location_id, source_id"
ORACLE["fact_append"] = A.rstrip("\n") + f""",
one AS (SELECT {_SIX}, count(*) AS n FROM fact WHERE posting_id % 2 = 1 GROUP BY ALL),
two AS (SELECT {_SIX}, count(*) AS n FROM fact GROUP BY ALL),
new AS (SELECT * FROM two ANTI JOIN one USING ({_SIX}))
SELECT CAST(1 AS INTEGER) AS load_seq, count(*) AS rows, count(*) AS keys, CAST(coalesce(sum(n) FILTER (WHERE n > 1), 0) AS BIGINT) AS conflicts FROM one
UNION ALL SELECT 2, (SELECT count(*) FROM new), (SELECT count(*) FROM new),
  CAST((SELECT coalesce(sum(n), 0) FROM two SEMI JOIN one USING ({_SIX})) + (SELECT coalesce(sum(n) FILTER (WHERE n > 1), 0) FROM new) AS BIGINT)"""
ORACLE["enrich_dimension"] = A + f"""SELECT company_id, company_name, sector FROM dim_company d
LEFT JOIN (SELECT {O.mk('c_name')} AS k, arg_min(c_mktsegment, c_name) AS sector FROM customer GROUP BY 1) c ON c.k = {O.mk('d.company_name')}"""
