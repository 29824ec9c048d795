"""Star aggregates on the order tables (the scale benchmark).

lineitem -> orders -> customer -> nation, each step aggregated before the
next join: the big lineitem x orders join carries one row per order, not
per line, and the customer/nation joins see one row per customer / nation.
Catalyst does not push aggregates below joins by itself, so the plans are
written that way.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postwise.functions.dates import week_mode1
from postwise.sources.tables import read_table

def _revenue():
    return F.col("l_extendedprice") * (F.lit(1) - F.col("l_discount"))


def _t(spark, sf, name):
    return read_table(spark, sf, name)


def by_nation(spark: SparkSession, sf: str) -> DataFrame:
    """A1/A2 shape: lines and revenue by customer nation."""
    li = _t(spark, sf, "lineitem").groupBy("l_orderkey").agg(F.count("*").alias("_n"), F.sum(_revenue()).alias("_rev"))
    o = _t(spark, sf, "orders").select("o_orderkey", "o_custkey")
    per_cust = li.join(o, li.l_orderkey == o.o_orderkey).groupBy("o_custkey").agg(
        F.sum("_n").alias("_n"), F.sum("_rev").alias("_rev"))
    c = _t(spark, sf, "customer").select("c_custkey", "c_nationkey")
    per_nat = per_cust.join(c, per_cust.o_custkey == c.c_custkey).groupBy("c_nationkey").agg(
        F.sum("_n").alias("line_count"), F.sum("_rev").alias("_rev"))
    n = _t(spark, sf, "nation").select("n_nationkey", "n_name")
    return per_nat.join(n, per_nat.c_nationkey == n.n_nationkey).select(
        F.col("n_name").alias("nation"), "line_count", F.round("_rev", 2).alias("revenue"))


def top_suppliers(spark: SparkSession, sf: str, k: int = 20) -> DataFrame:
    """A3 shape: the ``k`` suppliers with most lines (ties by name)."""
    li = _t(spark, sf, "lineitem").groupBy("l_suppkey").agg(F.count("*").alias("line_count"))
    s = _t(spark, sf, "supplier").select("s_suppkey", "s_name")
    return li.join(s, li.l_suppkey == s.s_suppkey).select(F.col("s_name").alias("supplier"), "line_count") \
        .orderBy(F.desc("line_count"), "supplier").limit(k)


def monthly_price(spark: SparkSession, sf: str) -> DataFrame:
    """A4 shape: monthly average price and discount per return flag."""
    li = _t(spark, sf, "lineitem")
    g = li.groupBy(F.year("l_shipdate").alias("year"), F.month("l_shipdate").alias("month"), "l_returnflag").agg(
        F.round(F.avg("l_extendedprice"), 6).alias("avg_price"), F.round(F.avg("l_discount"), 6).alias("avg_discount"),
        F.count("*").alias("line_count"))
    return g


def weekly_lines(spark: SparkSession, sf: str) -> DataFrame:
    """A5 shape: lines per (year, WEEK(shipdate, 1))."""
    li = _t(spark, sf, "lineitem").select(F.col("l_shipdate").cast("date").alias("d"))
    per_day = li.groupBy("d").agg(F.count("*").alias("_n"))
    return per_day.groupBy(F.year("d").alias("year"), week_mode1("d").alias("week_of_year")) \
        .agg(F.sum("_n").alias("line_count"))


def by_segment(spark: SparkSession, sf: str) -> DataFrame:
    """A7 shape: orders and order value by market segment."""
    o = _t(spark, sf, "orders").groupBy("o_custkey").agg(F.count("*").alias("_n"), F.sum("o_totalprice").alias("_v"))
    c = _t(spark, sf, "customer").select("c_custkey", "c_mktsegment")
    return o.join(c, o.o_custkey == c.c_custkey).groupBy(F.col("c_mktsegment").alias("segment")).agg(
        F.sum("_n").alias("order_count"), F.round(F.sum("_v"), 2).alias("order_value"))
