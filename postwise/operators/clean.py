"""Record cleaning (P7, P8, P23, P25): both profiles as one ``select``.

``profile="basic"`` reproduces the staging load: strip, title-case the job
title, value mappings, salary range, date with a run-date default.
``profile="standard"`` produces the cleaned table: normalised raw and
standardised columns, USD salary, bands and a record hash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postwise import rules as R
from postwise.functions import dates as D
from postwise.functions import salary as S
from postwise.functions import text as T


def map_column(c, mapping: dict) -> Column:
    """Exact-value replacement (``DataFrame.replace`` semantics) as CASE."""
    c = T._col(c)
    if not mapping:
        return c
    out = c
    for k, v in reversed(list(mapping.items())):
        out = F.when(c == F.lit(k), F.lit(v)).otherwise(out)
    return out


def map_values(df: DataFrame, column: str, mapping: dict) -> DataFrame:
    """Replace exact values of ``column`` using ``mapping``.

    Small mappings become an inline CASE; larger ones a join with the mapping
    table (:func:`map_values_table`).
    """
    if len(mapping) <= R.INLINE_MAPPING_LIMIT:
        return df.withColumn(column, map_column(column, mapping))
    return map_values_table(df, column, df.sparkSession.createDataFrame(list(mapping.items()), "from string, to string"))


#: Bytes of a rule table up to which it is sent to every task.
RULE_TABLE_BYTES = 32 << 20


def map_values_table(df: DataFrame, column: str, table: DataFrame, limit: int = RULE_TABLE_BYTES) -> DataFrame:
    """Replace exact values of ``column`` by a table (from, to) of any size.

    Its texts are measured first; up to ``limit`` bytes the table is broadcast, beyond that
    the distinct values of the column are looked up by a shuffle join, so a value that holds
    many rows is joined once, and the rows take the result by their value. A value with
    several targets takes the least one; a null target leaves the value as it is.
    """
    names = [c for c in df.columns]
    rules = table.where(F.col("from").isNotNull() & F.col("to").isNotNull()).groupBy(F.col("from").alias("_from")).agg(
        F.min("to").alias("_to"))
    size = rules.agg(F.sum(F.octet_length("_from") + F.octet_length("_to") + 32)).first()[0] or 0
    if size > limit:
        rules = df.select(F.col(column).alias("_from")).distinct().join(rules, "_from")
    joined = df.join(F.broadcast(rules) if size <= limit else rules, df[column] == rules["_from"], "left")
    return joined.select(*[F.coalesce(rules["_to"], df[c]).alias(c) if c == column else df[c] for c in names])


#: Fields of the record hash of a standard-profile row.
HASH_FIELDS = ("job_title_std", "company_name_std", "province", "posting_date")


def hash_fields(df: DataFrame, fields=HASH_FIELDS, use_nfkc: bool = True) -> Column:
    """The record hash of chosen fields, each normalised: texts as by :func:`normalize_text`, dates as ISO
    dates, anything else as its text; missing -> ''."""
    def one(c):
        kind = df.schema[c].dataType.typeName()
        if kind == "string":
            return T.normalize_text(c, use_nfkc)
        if kind in ("date", "timestamp", "timestamp_ntz"):
            return F.date_format(c, "yyyy-MM-dd")
        return F.col(c).cast("string")
    return record_hash(*[one(c) for c in fields])


def record_hash(*cols) -> Column:
    """sha256 hex of the fields joined by '||' (missing -> '')."""
    return F.sha2(F.concat_ws("||", *[F.coalesce(T._col(c).cast("string"), F.lit("")) for c in cols]), 256)


def clean_basic(df: DataFrame, rules: R.Rules = R.DEFAULT_RULES, run_date: str = R.DEFAULT_RUN_DATE) -> DataFrame:
    """Basic profile: the staging shape.

    Missing text -> '', Unicode strip, job title title-cased, industry and
    location mapped by exact value, salary range parsed from the raw text,
    bad or missing dates -> ``run_date`` with ``date_defaulted`` set.
    """
    posted = D.parse_date_or("posting_date", run_date, list(rules.basic_date_formats))
    df = S.with_salary_range(df, "salary", mode=rules.mode)
    keep = [c for c in df.columns if c not in _POSTING_TEXT and c not in ("salary_min", "salary_max")]
    return df.select(
        *keep,
        T.title_case(T.blank_strip("job_title")).alias("job_title"),
        T.blank_strip("company_name").alias("company_name"),
        map_column(T.blank_strip("industry"), rules.industry_mapping).alias("industry"),
        map_column(T.blank_strip("location"), rules.location_mapping).alias("location"),
        T.blank_strip("salary").alias("salary_range"),
        T.blank_strip("job_type").alias("job_type"),
        T.blank_strip("experience_level").alias("experience_level"),
        T.blank_strip("education_level").alias("education_level"),
        posted["posting_date"].alias("posting_date"),
        posted["date_defaulted"].alias("date_defaulted"),
        T.blank_strip("source_agency").alias("source_agency"),
        "salary_min",
        "salary_max",
    )


_POSTING_TEXT = {"job_title", "company_name", "industry", "location", "salary", "job_type",
                 "experience_level", "education_level", "posting_date", "source_agency"}

CLEANED_COLUMNS = [
    "job_title_raw", "job_title_std", "company_name_raw", "company_name_std", "industry_raw",
    "industry_std", "province", "city", "salary_type", "salary_currency", "salary_min_usd",
    "salary_max_usd", "employment_type", "experience_level_std", "education_level_std",
    "posting_date", "source_agency_raw", "source_agency_std", "hash_dedup",
]


def clean_standard(df: DataFrame, rules: R.Rules = R.DEFAULT_RULES, fields=HASH_FIELDS) -> DataFrame:
    """Standard profile: the cleaned table (19 derived columns).

    ``fields`` are the derived columns that the record hash is made of.

    ``hash_dedup`` = sha256 of standard title || standard company ||
    province || ISO posting date ('' when unparsed).

    Two projections: the first normalises each text field once (NFKC runs
    on the JVM and only for non-ASCII values); the second derives every
    standard column from those, so no normalisation is repeated per row.
    """
    nf = rules.nfkc
    keep = [c for c in df.columns if c not in _POSTING_TEXT]
    norm_cols = ["job_title", "company_name", "industry", "location", "salary", "job_type",
                 "experience_level", "education_level", "source_agency"]
    base = df.select(*keep, *[T.normalize_text(c, nf).alias(f"_n_{c}") for c in norm_cols],
                     F.col("industry").alias("_industry"), F.col("source_agency").alias("_agency"),
                     F.col("posting_date").alias("_posting_date"))
    title = T.standardize_title("_n_job_title", mode=rules.mode, use_nfkc=False, keywords=rules.title_keywords)
    loc = T.split_location("_n_location", use_nfkc=False)
    base = S.with_parsed_salary(base, "_n_salary", rules.currency_default, rules.salary_keywords,
                                mode=rules.mode, rates=rules.currency_rates, normalized=True)
    out = base.select(
        *keep,
        title["raw"].alias("job_title_raw"),
        title["std"].alias("job_title_std"),
        F.col("_n_company_name").alias("company_name_raw"),
        T.standardize_company("_n_company_name", mode=rules.mode, use_nfkc=False,
                              suffixes=rules.company_suffixes).alias("company_name_std"),
        F.col("_n_industry").alias("industry_raw"),
        T.title_case("_industry").alias("industry_std"),
        loc["province"].alias("province"),
        loc["city"].alias("city"),
        "salary_type",
        "salary_currency",
        "salary_min_usd",
        "salary_max_usd",
        F.col("_n_job_type").alias("employment_type"),
        T.experience_band("_n_experience_level", mode=rules.mode, use_nfkc=False,
                          keywords=rules.experience_keywords).alias("experience_level_std"),
        T.education_band("_n_education_level", use_nfkc=False, default=rules.education_default).alias("education_level_std"),
        D.parse_date("_posting_date", list(rules.date_formats)).alias("posting_date"),
        F.col("_n_source_agency").alias("source_agency_raw"),
        T.title_case("_agency").alias("source_agency_std"),
    )
    return out.withColumn(
        "hash_dedup",
        record_hash(*[F.date_format(c, "yyyy-MM-dd") if c == "posting_date" else c for c in fields]),
    )


def clean_postings(df: DataFrame, rules: R.Rules = R.DEFAULT_RULES, profile: str = "standard",
                   run_date: str = R.DEFAULT_RUN_DATE) -> DataFrame:
    """P25: whole-record standardisation, ``profile`` = "basic" or "standard"."""
    if profile == "basic":
        return clean_basic(df, rules, run_date)
    return clean_standard(df, rules)
