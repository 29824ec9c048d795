"""Data-quality checks (DQ1-DQ7), the quality report and the reject split.

A check is a boolean Column that is true when the row passes. All checks
are folded into one aggregation pass (``sum(when(not check))``), so the
report costs one scan whatever the number of checks.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postwise import rules as R


def check_required(fields=R.REQUIRED_FIELDS) -> Column:
    """DQ1: every required field present and not blank."""
    return reduce(lambda a, b: a & b, [F.coalesce(F.trim(F.col(f)) != "", F.lit(False)) for f in fields])


def check_date(date_col: str = "posting_date", defaulted_col: str | None = "date_defaulted",
               run_date: str = R.DEFAULT_RUN_DATE) -> Column:
    """DQ2: the date parsed (not defaulted) and is not after the run date."""
    ok = F.col(date_col).isNotNull() & (F.col(date_col) <= F.lit(run_date).cast("date"))
    if defaulted_col:
        ok = ok & ~F.col(defaulted_col)
    return F.coalesce(ok, F.lit(False))


def check_salary(lo: str = "salary_min", hi: str = "salary_max", min_salary=R.MIN_SALARY,
                 max_salary=R.MAX_SALARY) -> Column:
    """DQ3: no salary, or min <= max with both inside [min_salary, max_salary]."""
    lo_c, hi_c = F.col(lo), F.col(hi)
    none = lo_c.isNull() & hi_c.isNull()
    good = (lo_c <= hi_c) & (lo_c >= min_salary) & (hi_c <= max_salary)
    return none | F.coalesce(good, F.lit(False))


def check_lengths(limits: dict[str, int] = R.STAGING_LENGTHS) -> Column:
    """DQ6: no text longer than its declared width."""
    return reduce(lambda a, b: a & b,
                  [F.coalesce(F.length(F.col(c)) <= n, F.lit(True)) for c, n in limits.items()])


def staging_checks(run_date: str = R.DEFAULT_RUN_DATE, rules: R.Rules = R.DEFAULT_RULES) -> dict[str, Column]:
    """The checks for a staging (basic profile) table, by name."""
    checks = {"required_fields": check_required(rules.required_fields)}
    if rules.date_validation:
        checks["date_valid"] = check_date("posting_date", "date_defaulted", run_date)
    if rules.salary_validation:
        checks["salary_valid"] = check_salary("salary_min", "salary_max", rules.min_salary, rules.max_salary)
    return {**checks, "length_valid": check_lengths()}


def quality_report(df: DataFrame, checks: dict[str, Column]) -> DataFrame:
    """(check, failed, total) for every check, in one aggregation pass."""
    aggs = [F.sum(F.when(c, 0).otherwise(1)).cast("long").alias(n) for n, c in checks.items()]
    one = df.agg(F.count("*").alias("_total"), *aggs)
    rows = F.explode(F.array(*[F.struct(F.lit(n).alias("check"), F.coalesce(F.col(n), F.lit(0)).alias("failed"))
                               for n in checks]))
    return one.select(rows.alias("r"), "_total").select("r.check", "r.failed", F.col("_total").alias("total"))


def split_valid(df: DataFrame, checks: dict[str, Column]) -> tuple[DataFrame, DataFrame]:
    """(valid rows, rejected rows + ``reasons`` array of failed check names)."""
    reasons = F.filter(F.array(*[F.when(~c, F.lit(n)) for n, c in checks.items()]), lambda x: x.isNotNull())
    tagged = df.withColumn("reasons", reasons)
    return tagged.where(F.size("reasons") == 0).drop("reasons"), tagged.where(F.size("reasons") > 0)


def check_references(fact: DataFrame, dims: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """DQ5: (dimension, missing) = fact rows whose key has no member (a null key has none).

    The fact is read once: its rows are counted by (dimension, key), with partial sums before the shuffle, so
    only distinct keys meet the dimensions, all of them in one join. A dimension without missing keys has 0.
    """
    pairs = F.explode(F.array(*[F.struct(F.lit(n).alias("dimension"), F.col(k).cast("string").alias("key"))
                                for n, (_, k) in dims.items()])).alias("_p")
    used = fact.select(pairs).groupBy("_p.dimension", "_p.key").agg(F.count("*").alias("_n"))
    members = reduce(lambda a, b: a.unionByName(b), [
        dim.select(F.lit(n).alias("dimension"), F.col(k).cast("string").alias("key")).where("key IS NOT NULL").distinct()
        for n, (dim, k) in dims.items()]).withColumn("_member", F.lit(True))
    judged = used.join(members, ["dimension", "key"], "left")
    missing = F.coalesce(F.sum(F.when(F.col("_member").isNull(), F.col("_n"))), F.lit(0)).alias("missing")
    names = fact.sparkSession.createDataFrame([(n,) for n in dims], "dimension string")
    return names.join(judged.groupBy("dimension").agg(missing), "dimension", "left").select(
        "dimension", F.coalesce("missing", F.lit(0)).alias("missing"))


def check_unique(df: DataFrame, key_cols: list[str], name: str) -> DataFrame:
    """DQ6: (table, duplicate_keys, duplicate_rows) for a declared unique key."""
    dup = df.groupBy(*key_cols).agg(F.count("*").alias("n")).where("n > 1")
    return dup.agg(F.count("*").alias("duplicate_keys"), F.coalesce(F.sum("n"), F.lit(0)).alias("duplicate_rows")) \
        .select(F.lit(name).alias("table"), "duplicate_keys", "duplicate_rows")


def check_unique_keys(tables: dict[str, tuple[DataFrame, list[tuple[str, ...]]]]) -> DataFrame:
    """DQ6: (table, key, duplicate_keys, duplicate_rows) for every unique key of every table, in one shuffle.

    All tables' rows are counted together by (rule, key) with partial sums before the shuffle, so a key that
    holds many rows is no hot key. A null in a key counts as a value. A table without rows has no duplicates.
    """
    rules, parts = [], []
    for name, (df, keys) in tables.items():
        for cols in keys:
            number = len(rules)
            rules.append((number, name, ",".join(cols)))
            key = F.to_json(F.struct(*[F.col(c) for c in cols]), {"ignoreNullFields": "false"})
            parts.append(df.select(F.lit(number).alias("_rule"), key.alias("_key")))
    counted = reduce(lambda a, b: a.unionByName(b), parts).groupBy("_rule", "_key").agg(F.count("*").alias("_n"))
    found = counted.where("_n > 1").groupBy("_rule").agg(F.count("*").alias("keys"), F.sum("_n").alias("rows"))
    spark = parts[0].sparkSession
    named = spark.createDataFrame(rules, "_rule int, table string, key string")
    zero = F.lit(0).cast("long")
    return named.join(found, "_rule", "left").select("table", "key", F.coalesce("keys", zero).alias("duplicate_keys"),
                                                     F.coalesce("rows", zero).alias("duplicate_rows"))


def check_fanout(staging: DataFrame, fact: DataFrame, id_col: str = "posting_id") -> DataFrame:
    """DQ7: (fact_rows, staging_rows): how many staging rows produced 0, 1,
    2, ... fact rows. A clean load has one line, fact_rows = 1."""
    per = fact.groupBy(id_col).agg(F.count("*").alias("fact_rows"))
    joined = staging.select(id_col).join(per, id_col, "left")
    return joined.groupBy(F.coalesce(F.col("fact_rows"), F.lit(0)).alias("fact_rows")) \
        .agg(F.count("*").alias("staging_rows"))


def check_not_null(tables: dict[str, tuple[DataFrame, list[str]]]) -> DataFrame:
    """DQ6: (table, column, nulls) for every declared NOT NULL column, one
    aggregation pass per table."""
    parts = []
    for name, (df, cols) in tables.items():
        counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
        rows = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("nulls")) for c in cols]))
        parts.append(counts.select(rows.alias("r")).select(F.lit(name).alias("table"), "r.column", "r.nulls"))
    return reduce(lambda a, b: a.unionByName(b), parts)
