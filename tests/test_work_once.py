"""Steps that read what they make more than once make it once, and costly comparisons are left to the rows that need them."""

import pytest
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postwise.operators.dimensions import enrich_dimension
from postwise.operators.keys import distinct_members, match_key
from postwise.plans.incremental import Warehouse, screen_rows

SPELLINGS = ["Acme", "ACME ", "acme", "Café", "cafe", "CAFE  ", "a-b", "ab", "a b", " acme", "", " ", None, "Straße",
             "strasse", "ﬁrm", "firm", "x\u0000y", "xy", "ក", "tab\t", "tab", "'A'", "a"]


def test_append_unique_makes_its_rows_once(spark, tmp_path):
    wh, made = Warehouse(spark, str(tmp_path)), spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            made.add(len(b))
            yield b

    rows = spark.range(40).select(F.sha2((F.col("id") % 30).cast("string"), 256).alias("hash_dedup"), F.col("id").alias("posting_id"))
    rows = rows.mapInPandas(count, rows.schema)
    for _ in range(2):
        wh.append_unique("t", rows)
    assert made.value == 80
    assert sorted(r[0] for r in wh.read("t").select("posting_id").collect()) == list(range(30))


def test_screen_rows_writes_no_row_checkpoint(spark, monkeypatch):
    def refuse(*a, **kw):
        raise AssertionError("row checkpoint")

    monkeypatch.setattr(DataFrame, "checkpoint", refuse)
    row = {"job_title": "Cook", "company_name": "A", "industry": "Food", "location": "B", "salary_range": "", "job_type": "",
           "experience_level": "", "education_level": "", "source_agency": ""}
    st = spark.createDataFrame([{"posting_id": i, **row} for i in range(3)]).withColumns({
        "posting_date": F.lit("2024-01-01").cast("date"), "date_defaulted": F.lit(False),
        "salary_min": F.lit(None).cast("decimal(10,2)"), "salary_max": F.lit(None).cast("decimal(10,2)")})
    found = {r["posting_id"]: r["status"] for r in screen_rows(st).collect()}
    assert found == {0: "accepted", 1: "duplicate", 2: "duplicate"}


@pytest.mark.parametrize("texts", [SPELLINGS, [s for s in SPELLINGS if s is None or s.isascii() and s.isprintable()]])
def test_members_are_the_groups_of_the_collation(spark, texts):
    df = spark.createDataFrame([(s, n) for s in texts for n in (1, 2)], "name string, n int")
    want = df.groupBy(match_key("name").alias("k"), "n").agg(F.min("name").alias("m"))
    got = distinct_members(df, ["name", "n"])
    key = lambda r: (r[0] is None, r[0] or "", r[1])
    assert sorted(map(tuple, got.collect()), key=key) == sorted(map(tuple, want.select("m", "n").collect()), key=key)


def test_ascii_members_are_not_compared_under_the_collation(spark):
    df = spark.createDataFrame([("Acme",), ("ACME ",), ("b",)], "name string")
    got = distinct_members(df, ["name"])
    assert "collate" not in got._jdf.queryExecution().toString().lower()
    assert sorted(r[0] for r in got.collect()) == ["ACME ", "b"]


def test_every_pair_of_visible_characters(spark):
    chars = [chr(i) for i in range(32, 127)]
    df = spark.createDataFrame([(f"{a}{b}.",) for a in chars for b in chars], "name string")
    assert distinct_members(df, ["name"]).count() == df.select(match_key("name").alias("k")).distinct().count()


def test_enriched_by_the_least_spelling(spark):
    dim = spark.createDataFrame([(1, "acme"), (2, "Café"), (3, "none")], "id int, name string")
    lk = spark.createDataFrame([("acme", "low"), ("ACME ", "up"), ("cafe", "plain"), ("CAFÉ", "accent"), (None, "null")],
                               "name string, sector string")
    assert dict(enrich_dimension(dim, lk, "name").select("id", "sector").collect()) == {1: "up", 2: "accent", 3: None}


def test_line_bitmaps_are_no_row_objects(spark, monkeypatch):
    pytest.importorskip("xxhash")
    from postwise.llm.lines import dropped_lines

    def refuse(*a, **kw):
        raise AssertionError("rows as objects")

    monkeypatch.setattr(DataFrame, "toPandas", refuse)
    monkeypatch.setattr(type(spark.range(1)), "toPandas", refuse)
    line = "the quick brown fox jumps over the lazy dog near the river"
    docs = spark.createDataFrame([(1, line), (2, line.replace("river", "rivers"))], "doc_id long, text string")
    assert [r["dropped"] for r in dropped_lines(docs).collect()] == [[0]]
