"""DuckDB SQL equivalents of the registered queries (the correctness oracle).

Written independently of the Spark code: plain SQL over the driver tables.
Text equality of the original server (case/accent-insensitive, trailing
blanks ignored) is ``strip_accents(lower(rtrim(x)))`` here. Dense ids are
``row_number()`` over the member's spelling, the order the Spark build uses.
"""

from __future__ import annotations

from postwise import rules as R
from postwise.sources.fixture import FIXTURE_SQL_DUCKDB

RUN_DATE = R.DEFAULT_RUN_DATE


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def strip(x: str) -> str:
    return rf"regexp_replace(coalesce({x}, ''), '^\s+|\s+$', '', 'g')"


def norm(x: str) -> str:
    return rf"regexp_replace(regexp_replace(replace(coalesce({x}, ''), chr(160), ' '), '^\s+|\s+$', '', 'g'), '\s+', ' ', 'g')"


def title(x: str) -> str:
    runs = rf"regexp_extract_all({x}, '[\p{{Lu}}\p{{Ll}}\p{{Lt}}]+|[^\p{{Lu}}\p{{Ll}}\p{{Lt}}]+')"
    return (f"CASE WHEN {x} IS NULL THEN NULL ELSE coalesce(array_to_string(list_transform({runs}, "
            f"lambda t: upper(substring(t, 1, 1)) || lower(substring(t, 2))), ''), '') END")


def mapping(x: str, m: dict) -> str:
    whens = " ".join(f"WHEN {x} = {q(k)} THEN {q(v)}" for k, v in m.items())
    return f"CASE {whens} ELSE {x} END"


def mk(x: str) -> str:
    return f"strip_accents(lower(rtrim({x})))"


def khmer(x: str) -> str:
    return f"translate({x}, {q(R.KHMER_DIGITS)}, '0123456789')"


def dt(x: str, fmts: list[str]) -> str:
    py = {"M/d/yyyy": "%m/%d/%Y", "M/d/yyyy H:m:s": "%m/%d/%Y %H:%M:%S", "d/M/yyyy": "%d/%m/%Y",
          "yyyy-MM-dd": "%Y-%m-%d"}
    return "CAST(coalesce(" + ", ".join(f"try_strptime({x}, {q(py[f])})" for f in fmts) + ") AS DATE)"


def salary_range_sql(t: str, which: int, patterns: list[str]) -> str:
    skip = " OR ".join(f"contains({t}, {q(s)})" for s in R.SALARY_SKIP_TOKENS)
    whens = " ".join(
        f"WHEN regexp_matches({t}, {q(p)}) THEN TRY_CAST(replace(regexp_extract({t}, {q(p)}, {which}), ',', '') AS DECIMAL(10,2))"
        for p in patterns)
    return f"CASE WHEN {t} IS NULL OR {skip} THEN NULL {whens} ELSE NULL END"


def keyword_chain(t: str, kws, whole: set, otherwise: str, reference: bool = False) -> str:
    import re

    parts = []
    for kw, val in kws:
        if reference:
            cond = f"contains(lower({t}), {q(kw.lower())})"
        else:
            pat = r"(?i)\b" + re.escape(kw).replace("\\ ", " ") + (r"\b" if kw in whole else "")
            cond = f"regexp_matches({t}, {q(pat)})"
        parts.append(f"WHEN {cond} THEN {q(val)}")
    return "CASE " + " ".join(parts) + f" ELSE {otherwise} END"


def company_std(x: str) -> str:
    v = f"lower({norm(x)})"
    for s in R.COMPANY_SUFFIXES:
        v = f"replace({v}, {q(s)}, '')"
    v = norm(v)
    v = rf"regexp_replace({v}, '[\s.,;:]+$', '')"
    return title(v)


# --------------------------------------------------------------------------
# CTE building blocks
# --------------------------------------------------------------------------

RAW = f"raw AS ({FIXTURE_SQL_DUCKDB})"

STAGING = f"""staging AS (
  SELECT posting_id,
    {title(strip('job_title'))} AS job_title,
    {strip('company_name')} AS company_name,
    {mapping(strip('industry'), R.INDUSTRY_MAPPING)} AS industry,
    {mapping(strip('location'), R.LOCATION_MAPPING)} AS location,
    {strip('salary')} AS salary_range,
    {strip('job_type')} AS job_type,
    {strip('experience_level')} AS experience_level,
    {strip('education_level')} AS education_level,
    coalesce({dt(strip('posting_date'), R.BASIC_DATE_FORMATS)}, DATE {q(RUN_DATE)}) AS posting_date,
    {dt(strip('posting_date'), R.BASIC_DATE_FORMATS)} IS NULL AS date_defaulted,
    {strip('source_agency')} AS source_agency,
    {salary_range_sql(khmer('salary'), 1, R.SALARY_PATTERNS_FIXED)} AS salary_min,
    {salary_range_sql(khmer('salary'), 2, R.SALARY_PATTERNS_FIXED)} AS salary_max
  FROM raw)"""

_RNG, _SGL = R.SALARY_RANGE_PATTERN_FIXED, R.SALARY_SINGLE_PATTERN_FIXED
_rates = " ".join(f"WHEN {q(k)} THEN CAST({v} AS DECIMAL(12,6))" for k, v in R.CURRENCY_RATES.items())


def _usd(amount: str, cur: str) -> str:
    return f"TRY_CAST({amount} * (CASE {cur} {_rates} ELSE CAST(1.0 AS DECIMAL(12,6)) END) AS DECIMAL(12,2))"


SAL1 = f"""sal1 AS (
  SELECT posting_id, t,
    regexp_matches(t, {q(_RNG)}) AS is_range, regexp_matches(t, {q(_SGL)}) AS is_single,
    CASE WHEN regexp_matches(t, {q(_RNG)})
      THEN coalesce(nullif(regexp_extract(t, {q(_RNG)}, 1), ''), nullif(regexp_extract(t, {q(_RNG)}, 5), ''), regexp_extract(t, {q(_RNG)}, 3))
      ELSE coalesce(nullif(regexp_extract(t, {q(_SGL)}, 1), ''), regexp_extract(t, {q(_SGL)}, 3)) END AS raw_cur,
    CASE WHEN regexp_matches(t, {q(_RNG)}) THEN TRY_CAST(replace(regexp_extract(t, {q(_RNG)}, 2), ',', '') AS DECIMAL(20,4))
      ELSE TRY_CAST(replace(regexp_extract(t, {q(_SGL)}, 2), ',', '') AS DECIMAL(20,4)) END AS lo,
    CASE WHEN regexp_matches(t, {q(_RNG)}) THEN TRY_CAST(replace(regexp_extract(t, {q(_RNG)}, 4), ',', '') AS DECIMAL(20,4))
      ELSE TRY_CAST(replace(regexp_extract(t, {q(_SGL)}, 2), ',', '') AS DECIMAL(20,4)) END AS hi
  FROM (SELECT posting_id, {khmer(norm('salary'))} AS t FROM raw))"""

SAL2 = f"""sal2 AS (
  SELECT posting_id, t, is_range, is_single, lo, hi,
    CASE upper(coalesce(nullif(raw_cur, ''), 'USD')) WHEN '$' THEN 'USD' WHEN 'US$' THEN 'USD' WHEN '៛' THEN 'KHR'
      ELSE upper(coalesce(nullif(raw_cur, ''), 'USD')) END AS cur,
    CASE WHEN t = '' THEN 'undisclosed'
      WHEN contains(lower(t), 'negotiable') THEN 'negotiable'
      WHEN contains(lower(t), 'not disclosed') THEN 'undisclosed'
      WHEN (is_range OR is_single) AND lo IS NOT NULL AND hi IS NOT NULL THEN CASE WHEN is_range THEN 'range' ELSE 'fixed' END
      ELSE 'undisclosed' END AS salary_type
  FROM sal1)"""

SAL = f"""sal AS (
  SELECT posting_id, salary_type,
    CASE WHEN salary_type IN ('range', 'fixed') THEN cur ELSE 'USD' END AS salary_currency,
    CASE WHEN salary_type IN ('range', 'fixed') THEN {_usd('lo', 'cur')} END AS salary_min_usd,
    CASE WHEN salary_type IN ('range', 'fixed') THEN {_usd('hi', 'cur')} END AS salary_max_usd
  FROM sal2)"""

_loc = norm("location")
CLEANED0 = f"""cleaned0 AS (
  SELECT r.posting_id,
    {norm('job_title')} AS job_title_raw,
    {keyword_chain(norm('job_title'), R.TITLE_KEYWORDS, {'ux'}, norm('job_title'))} AS job_title_std,
    {norm('company_name')} AS company_name_raw,
    {company_std('company_name')} AS company_name_std,
    {norm('industry')} AS industry_raw,
    {title('industry')} AS industry_std,
    CASE WHEN strpos({_loc}, ',') > 0 THEN {title(strip(f"substring({_loc}, strpos({_loc}, ',') + 1)"))} ELSE {title(_loc)} END AS province,
    CASE WHEN strpos({_loc}, ',') > 0 THEN {title(strip(f"split_part({_loc}, ',', 1)"))} END AS city,
    s.salary_type, s.salary_currency, s.salary_min_usd, s.salary_max_usd,
    {norm('job_type')} AS employment_type,
    {keyword_chain(f"lower({norm('experience_level')})", R.EXPERIENCE_KEYWORDS, {'mid'}, norm('experience_level'))} AS experience_level_std,
    CASE WHEN {norm('education_level')} = '' THEN {q(R.EDUCATION_DEFAULT)} ELSE {norm('education_level')} END AS education_level_std,
    {dt('posting_date', R.DATE_FORMATS)} AS posting_date,
    {norm('source_agency')} AS source_agency_raw,
    {title('source_agency')} AS source_agency_std
  FROM raw r JOIN sal s ON r.posting_id = s.posting_id)"""

CLEANED = """cleaned AS (
  SELECT *, sha256(concat_ws('||', coalesce(job_title_std, ''), coalesce(company_name_std, ''), coalesce(province, ''),
    coalesce(strftime(posting_date, '%Y-%m-%d'), ''))) AS hash_dedup
  FROM cleaned0)"""

_seed_loc = ", ".join(f"({i + 1}, {q(R.LOCATION_MAPPING.get(c, c))}, {q(p)})" for i, (c, p) in enumerate(R.SEED_LOCATIONS))
_seed_ag = ", ".join(f"({i + 1}, {q(a)}, {q(p)})" for i, (a, p) in enumerate(R.SEED_AGENCIES))

DIMS = f"""dim_time AS (
  SELECT row_number() OVER (ORDER BY posting_date) AS time_id, posting_date,
    year(posting_date) AS year, quarter(posting_date) AS quarter, month(posting_date) AS month
  FROM (SELECT DISTINCT posting_date FROM staging)),
dim_company AS (
  SELECT row_number() OVER (ORDER BY company_name) AS company_id, company_name
  FROM (SELECT min(company_name) AS company_name FROM staging GROUP BY {mk('company_name')})),
dim_job AS (
  SELECT row_number() OVER (ORDER BY job_title, job_type, experience_level, education_level) AS job_id,
    job_title, job_type, experience_level, education_level
  FROM (SELECT min(job_title) AS job_title, min(job_type) AS job_type, min(experience_level) AS experience_level,
      min(education_level) AS education_level
    FROM staging GROUP BY {mk('job_title')}, {mk('job_type')}, {mk('experience_level')}, {mk('education_level')})),
dim_industry AS (
  SELECT row_number() OVER (ORDER BY industry_name) AS industry_id, industry_name
  FROM (SELECT min(industry) AS industry_name FROM staging GROUP BY {mk('industry')})),
seed_location AS (SELECT * FROM (VALUES {_seed_loc}) AS v(location_id, city, province)),
dim_location AS (
  SELECT location_id, city, province FROM seed_location
  UNION ALL
  SELECT 6 + row_number() OVER (ORDER BY city), city, CAST(NULL AS VARCHAR)
  FROM (SELECT min(location) AS city FROM staging
        WHERE {mk('location')} NOT IN (SELECT {mk('city')} FROM seed_location) GROUP BY {mk('location')})),
seed_agency AS (SELECT * FROM (VALUES {_seed_ag}) AS v(source_id, agency_name, platform_type)),
dim_source_agency AS (
  SELECT source_id, agency_name, platform_type FROM seed_agency
  UNION ALL
  SELECT 6 + row_number() OVER (ORDER BY agency_name), agency_name, CAST(NULL AS VARCHAR)
  FROM (SELECT min(source_agency) AS agency_name FROM staging
        WHERE {mk('source_agency')} NOT IN (SELECT {mk('agency_name')} FROM seed_agency) GROUP BY {mk('source_agency')})),
fact AS (
  SELECT st.posting_id, t.time_id, c.company_id, j.job_id, i.industry_id, l.location_id, s.source_id,
    1 AS job_count, st.salary_min, st.salary_max,
    CAST((st.salary_min + st.salary_max) / 2 AS DECIMAL(10,2)) AS salary_avg,
    st.salary_min IS NOT NULL AS has_salary, st.posting_date
  FROM staging st
  JOIN dim_time t ON st.posting_date = t.posting_date
  JOIN dim_company c ON {mk('st.company_name')} = {mk('c.company_name')}
  JOIN dim_job j ON {mk('st.job_title')} = {mk('j.job_title')} AND {mk('st.job_type')} = {mk('j.job_type')}
    AND {mk('st.experience_level')} = {mk('j.experience_level')} AND {mk('st.education_level')} = {mk('j.education_level')}
  JOIN dim_industry i ON {mk('st.industry')} = {mk('i.industry_name')}
  JOIN (SELECT {mk('city')} AS k, min(location_id) AS location_id FROM dim_location GROUP BY 1) l ON {mk('st.location')} = l.k
  JOIN dim_source_agency s ON {mk('st.source_agency')} = {mk('s.agency_name')})"""


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


BASE_A = with_(RAW, STAGING, DIMS)
BASE_B = with_(RAW, SAL1, SAL2, SAL, CLEANED0, CLEANED)
