"""Declared table schemas (S15): types, widths, NOT NULL and unique keys.

``DDL`` states every table in Spark's own column syntax; widths and nullability are
checked when rows are written, in one projection without a shuffle: a row that does not
fit is set aside with its reasons (:func:`split_fitting`), never cut or changed.
Unique keys are counted over any number of tables in one shuffle
(:func:`postwise.operators.quality.check_unique_keys`).

Defined results: a column that the rows lack counts as null; a column that is not
declared is dropped by :func:`fit`; text in a column of another type is cast, and a value
that cannot be cast is a reason of its own; no rows fit a table trivially.
"""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# --- FIXED VALUES: columns, widths and keys of the original tables -------------------------
# (ids are bigint here; ``posting_id``, ``date_defaulted`` and ``load_seq`` are ours)

DDL: dict[str, str] = {
    # landing and cleaned tables
    "postings_raw": """source_file varchar(255), load_timestamp timestamp_ntz, timestamp_collected timestamp_ntz,
        job_title varchar(255), company_name varchar(255), industry varchar(255), location_raw varchar(255),
        salary_raw varchar(255), job_type varchar(100), experience_level varchar(100), education_level varchar(100),
        posting_date_raw varchar(50), source_agency varchar(150), extra string""",
    "postings_cleaned": """source_file varchar(255), load_timestamp timestamp_ntz, job_title_raw varchar(255),
        job_title_std varchar(255), company_name_raw varchar(255), company_name_std varchar(255), industry_raw varchar(255),
        industry_std varchar(255), province varchar(100), city varchar(100), salary_type varchar(50),
        salary_currency varchar(10), salary_min_usd decimal(12,2), salary_max_usd decimal(12,2),
        employment_type varchar(50), experience_level_std varchar(100), education_level_std varchar(100),
        posting_date date, source_agency_raw varchar(150), source_agency_std varchar(150), hash_dedup varchar(64) not null""",
    # star A
    "staging": """posting_id bigint not null, timestamp_col timestamp, job_title varchar(255), company_name varchar(255),
        industry varchar(255), location varchar(100), salary_range varchar(100), job_type varchar(50),
        experience_level varchar(50), education_level varchar(100), posting_date date, date_defaulted boolean,
        source_agency varchar(100), salary_min decimal(10,2), salary_max decimal(10,2)""",
    "dim_time": """time_id bigint not null, posting_date date not null, posting_day int, posting_month int,
        posting_quarter int, posting_year int, posting_weekday varchar(20), is_weekend boolean""",
    "dim_company": """company_id bigint not null, company_name varchar(255) not null, company_type varchar(100),
        created_at timestamp""",
    "dim_job": """job_id bigint not null, job_title varchar(255) not null, job_type varchar(50),
        experience_level varchar(50), education_level varchar(100), created_at timestamp""",
    "dim_industry": "industry_id bigint not null, industry_name varchar(255) not null, created_at timestamp",
    "dim_location": "location_id bigint not null, city varchar(100) not null, province varchar(100)",
    "dim_source_agency": "source_id bigint not null, agency_name varchar(100) not null, platform_type varchar(50), created_at timestamp",
    "fact": """posting_id bigint, time_id bigint not null, company_id bigint not null, job_id bigint not null,
        industry_id bigint not null, location_id bigint not null, source_id bigint not null, job_count int,
        salary_min decimal(10,2), salary_max decimal(10,2), salary_avg decimal(10,2), has_salary boolean,
        load_date timestamp""",
    "etl_logs": """log_type varchar(50), process_name varchar(100), record_count int, status varchar(20),
        error_message string, start_time timestamp, end_time timestamp, duration_seconds int, created_at timestamp""",
    # star B
    "b_dim_time": """time_key date not null, full_date date not null, day int not null, month int not null,
        month_name varchar(20) not null, quarter int not null, year int not null, week_of_year int not null,
        day_of_week int not null, day_name varchar(20) not null, is_weekend boolean not null""",
    "b_dim_company": """company_key bigint not null, company_name varchar(255) not null, company_name_std varchar(255) not null,
        company_group varchar(255), industry_key bigint, headquarters varchar(255), created_at timestamp""",
    "b_dim_job": """job_key bigint not null, job_title_raw varchar(255) not null, job_title_std varchar(255) not null,
        job_category varchar(100), job_function varchar(100), experience_band varchar(100), education_band varchar(100),
        created_at timestamp""",
    "b_dim_industry": """industry_key bigint not null, industry_name_raw varchar(150) not null,
        industry_name_std varchar(150) not null, sector varchar(150), created_at timestamp""",
    "b_dim_location": """location_key bigint not null, country varchar(100), province varchar(100) not null, city varchar(100),
        region varchar(100), lat decimal(9,6), lon decimal(9,6), created_at timestamp""",
    "b_dim_source_agency": """source_key bigint not null, source_name_raw varchar(150) not null,
        source_name_std varchar(150) not null, source_type varchar(100), url varchar(255), created_at timestamp""",
    "b_fact": """time_key date not null, company_key bigint not null, job_key bigint not null, industry_key bigint not null,
        location_key bigint not null, source_key bigint not null, job_count int, salary_min_usd decimal(12,2),
        salary_max_usd decimal(12,2), salary_currency varchar(10), salary_type varchar(50), employment_type varchar(50),
        experience_level varchar(100), education_level varchar(100), posting_date date not null, collected_at timestamp,
        source_record_id varchar(255), hash_dedup varchar(64) not null""",
}

#: Unique keys, one tuple of columns each.
UNIQUE: dict[str, list[tuple[str, ...]]] = {
    "postings_cleaned": [("hash_dedup",)],
    "dim_time": [("time_id",), ("posting_date",)],
    "dim_company": [("company_id",), ("company_name",)],
    "dim_job": [("job_id",), ("job_title", "job_type", "experience_level", "education_level")],
    "dim_industry": [("industry_id",), ("industry_name",)],
    "dim_location": [("location_id",), ("city", "province")],
    "dim_source_agency": [("source_id",), ("agency_name",)],
    "fact": [("time_id", "company_id", "job_id", "industry_id", "location_id", "source_id")],
    "b_dim_time": [("time_key",)],
    "b_dim_company": [("company_key",), ("company_name_std",)],
    "b_dim_job": [("job_key",), ("job_title_std", "experience_band", "education_band")],
    "b_dim_industry": [("industry_key",), ("industry_name_std",)],
    "b_dim_location": [("location_key",), ("country", "province", "city")],
    "b_dim_source_agency": [("source_key",), ("source_name_std",)],
    "b_fact": [("hash_dedup",)],
}


@lru_cache(maxsize=None)
def schema(table: str) -> T.StructType:
    """The declared schema; texts with a width are varchar. Needs a running session."""
    return T.StructType.fromDDL(" ".join(DDL[table].split()))


def plain_type(t: T.DataType) -> T.DataType:
    return T.StringType() if isinstance(t, (T.VarcharType, T.CharType)) else t


def empty(spark: SparkSession, table: str) -> DataFrame:
    """A table of the declared columns without rows."""
    return spark.createDataFrame([], T.StructType([T.StructField(f.name, plain_type(f.dataType)) for f in schema(table)]))


def _value(df: DataFrame, f: T.StructField) -> Column:
    if f.name not in df.columns:
        return F.lit(None).cast(plain_type(f.dataType))
    c = F.col(f"`{f.name}`")
    return c if df.schema[f.name].dataType == plain_type(f.dataType) else c.try_cast(plain_type(f.dataType))


def fit(df: DataFrame, table: str) -> DataFrame:
    """The declared columns in their order and types; what cannot be cast becomes null."""
    return df.select(*[_value(df, f).alias(f.name) for f in schema(table)])


def violations(df: DataFrame, table: str) -> Column:
    """Array of the reasons why a row does not fit the table (empty if it does)."""
    reasons = []
    for f in schema(table):
        value, kind = _value(df, f), plain_type(f.dataType)
        if f.name in df.columns and df.schema[f.name].dataType != kind:
            raw = F.col(f"`{f.name}`")
            reasons.append(F.when(raw.isNotNull() & value.isNull(), F.lit(f"{f.name}: not a {kind.simpleString()}")))
            missing = raw.isNull()
        else:
            missing = value.isNull()
        if not f.nullable:
            reasons.append(F.when(missing, F.lit(f"{f.name}: null")))
        if isinstance(f.dataType, (T.VarcharType, T.CharType)):
            reasons.append(F.when(F.length(value) > f.dataType.length, F.lit(f"{f.name}: longer than {f.dataType.length}")))
    if not reasons:
        return F.array().cast("array<string>")
    return F.array_compact(F.array(*reasons))


def split_fitting(df: DataFrame, table: str) -> tuple[DataFrame, DataFrame]:
    """(rows that fit, as the table has them; the other rows as they are, with ``reasons``)."""
    tagged = df.withColumn("reasons", violations(df, table))
    return fit(tagged.where(F.size("reasons") == 0), table), tagged.where(F.size("reasons") > 0)
