"""Screened loads, safe replacement, the cleaned table, declared schemas, rule files, unique keys, star B in batches."""

import datetime as dt
import decimal
import json
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from postwise import rules as R
from postwise import schemas
from postwise.operators import clean, quality
from postwise.plans import incremental
from postwise.plans.incremental import Warehouse, processed_batches, run_pipeline, screen_rows
from postwise.rulefile import RuleError, load_rules, parse_rules, rules_from
from postwise.sources.fixture import raw_postings
from tests.conftest import SF_SMALL

TS = "2025-01-01 00:00:00"


def _root():
    return tempfile.mkdtemp(prefix="pw-load-", dir="/tmp")


# ---- replacement ---------------------------------------------------------------------------

class Stop(Exception):
    pass


def _break_after(wh, steps):
    """The warehouse stops before its step number ``steps`` (renames and deletes)."""
    left = [steps]

    def counted(fn):
        def run(*a):
            if left[0] == 0:
                raise Stop
            left[0] -= 1
            return fn(*a)
        return run

    wh._move, wh.delete, wh._mark = counted(wh._move), counted(wh.delete), counted(wh._mark)


@pytest.mark.parametrize("steps", range(6))
def test_a_broken_replacement_loses_nothing(spark, steps):
    root = _root()
    wh = Warehouse(spark, root)
    wh.replace("t", spark.range(5))
    _break_after(wh, steps)
    try:
        wh.replace("t", spark.range(100, 107))
        whole = True
    except Stop:
        whole = False
    wh = Warehouse(spark, root)
    wh.repair()
    rows = sorted(r[0] for r in wh.read("t").collect())
    assert rows in ([*range(5)], [*range(100, 107)])
    assert not whole or rows[0] == 100
    assert [d for d in wh.list_dirs("") if d.startswith("_")] == [] and wh.repair() == []
    wh.replace("t", spark.range(3))
    assert wh.read("t").count() == 3


@pytest.mark.parametrize("steps", range(8))
def test_broken_partitions_are_completed(spark, steps):
    """Once all new partitions are written, a broken-off swap is completed; before that nothing has changed."""
    root = _root()
    wh = Warehouse(spark, root)
    old = spark.range(12).select(F.col("id").alias("v"), (F.col("id") % 4).alias("y"), (F.col("id") % 2).alias("m"))
    wh.replace("t", old, ["y", "m"])
    new = wh.read("t").where("y < 2").withColumn("v", F.col("v") + 100).unionByName(
        spark.createDataFrame([(7, 9, 1)], "v long, y long, m long"))
    _break_after(wh, steps)
    try:
        wh.replace_partitions("t", new, ["y", "m"])
    except Stop:
        pass
    wh = Warehouse(spark, root)
    wh.repair()
    got = sorted((r.v, r.y, r.m) for r in wh.read("t").collect())
    before = sorted((i, i % 4, i % 2) for i in range(12))
    after = sorted([(i + 100 * (i % 4 < 2), i % 4, i % 2) for i in range(12)] + [(7, 9, 1)])
    assert got == (before if steps == 0 else after)
    assert [d for d in wh.list_dirs("") if d.startswith("_")] == []


# ---- screening -----------------------------------------------------------------------------

def _staged(spark, rows):
    base = dict(posting_id=1, job_title="Dev", company_name="Acme", industry="IT", location="Kandal", salary_range="", job_type="",
                experience_level="", education_level="", posting_date=dt.date(2024, 5, 1), date_defaulted=False, source_agency="",
                salary_min=None, salary_max=None)
    return spark.createDataFrame([tuple({**base, **r}.values()) for r in rows],
                                 "posting_id long, job_title string, company_name string, industry string, location string, "
                                 "salary_range string, job_type string, experience_level string, education_level string, "
                                 "posting_date date, date_defaulted boolean, source_agency string, salary_min decimal(10,2), salary_max decimal(10,2)")


def test_screening_tells_every_row(spark):
    money = decimal.Decimal
    rows = [dict(posting_id=1), dict(posting_id=2, company_name=" ACME "), dict(posting_id=3), dict(posting_id=3),
            dict(posting_id=0, job_title=" "), dict(posting_id=5, location="x" * 101), dict(posting_id=None, location="A"),
            dict(posting_id=7, location="B", salary_min=money(50), salary_max=money(20)), dict(posting_id=8, location="C", date_defaulted=True),
            dict(posting_id=9, location="Phnom Penh, Cambodia"), dict(posting_id=10, location="Phnom Penh, Cambodi", posting_date=dt.date(2024, 5, 6)),
            dict(posting_id=11, location="stored")]
    st = _staged(spark, rows)
    stored = screen_rows(st.where("posting_id = 11")).select("hash_dedup")
    got = {}
    for r in screen_rows(st, stored=stored, near=True).collect():
        got.setdefault(r.posting_id, []).append((r.status, tuple(r.reasons)))
    assert sum(map(len, got.values())) == len(rows)
    assert got[1] == [("accepted", ())] and got[2] == [("accepted", ())]
    assert got[3] == [("duplicate", ())] * 2 and got[11] == [("duplicate", ())]
    assert got[0] == [("rejected", ("required_fields",))]
    assert got[5] == [("rejected", ("location: longer than 100", "length_valid"))]
    assert got[None] == [("rejected", ("posting_id: null",))]
    assert got[7] == [("rejected", ("salary_valid",))] and got[8] == [("rejected", ("date_valid",))]
    assert got[9] == [("accepted", ())] and got[10] == [("near_duplicate", ())]
    assert screen_rows(st.limit(0), near=True).count() == 0
    off = R.DEFAULT_RULES.replace(dedup_enabled=False, date_validation=False, salary_validation=False)
    n = {r.status: r["count"] for r in screen_rows(st, off).groupBy("status").count().collect()}
    assert n == {"accepted": 9, "rejected": 3}


def test_screened_load_adds_up_and_finds_stored_rows(spark):
    root = _root()
    raw = raw_postings(spark, SF_SMALL)
    wh = Warehouse(spark, root)
    seen = {}
    for batch, df in [("b1", raw.where("posting_id % 2 = 1")), ("b2", raw)]:
        run_pipeline(spark, df, root, batch, TS, screen=True)
        n = {r.status: r["count"] for r in wh.read(f"screened/batch_id={batch}").groupBy("status").count().collect()}
        assert sum(n.values()) == df.count() and wh.read(f"staging/batch_id={batch}").count() == n.get("accepted", 0)
        seen[batch] = n
    assert min(seen["b1"].get(k, 0) for k in ("accepted", "rejected")) > 0 and seen["b2"]["duplicate"] >= seen["b1"]["accepted"]
    accepted = sum(n["accepted"] for n in seen.values())
    assert wh.read("loaded_hashes").count() == accepted == wh.read("loaded_hashes").select("hash_dedup").distinct().count()
    assert wh.read("fact").count() <= accepted


def test_a_repeated_batch_that_breaks_off_is_open_again(spark, monkeypatch):
    root = _root()
    raw = raw_postings(spark, SF_SMALL).limit(20)
    run_pipeline(spark, raw, root, "b1", TS)
    wh = Warehouse(spark, root)
    assert [r[0] for r in processed_batches(wh).collect()] == ["b1"]
    with monkeypatch.context() as m:
        m.setattr(incremental, "load_fact", lambda *a: (_ for _ in ()).throw(Stop()))
        with pytest.raises(Stop):
            run_pipeline(spark, raw, root, "b1", TS)
    assert processed_batches(wh).count() == 0
    assert incremental.purge_unprocessed(wh) == ["batch_id=b1"]
    run_pipeline(spark, raw, root, "b1", TS)
    assert wh.read("staging").count() == 20


def test_cleaned_table_reads_only_touched_prefixes(spark):
    wh = Warehouse(spark, _root())
    rows = [(f"{k:02x}{i:02x}", i) for i, k in enumerate(range(40))]
    df = spark.createDataFrame(rows + [("ff00", 90), ("ff00", 80), (None, 1), ("ff00", 80)], "hash_dedup string, posting_id long")
    wh.append_unique("postings_cleaned", df)
    assert wh.read("postings_cleaned").count() == 41
    read = []
    real = wh.read
    wh.read = lambda name: read.append(real(name)) or read[-1]
    plans = []
    append = wh.append
    wh.append = lambda name, new, parts: plans.append(new._jdf.queryExecution().executedPlan().toString()) or append(name, new, parts)
    wh.append_unique("postings_cleaned", spark.createDataFrame([("0000", 5), ("00ab", 6), ("ff00", 1)], "hash_dedup string, posting_id long"))
    assert "PartitionFilters: [hash_prefix" in plans[0] and "IN (00,ff)" in plans[0].replace("hash_prefix#", "").replace("ff,00", "00,ff")
    got = {r.hash_dedup: r.posting_id for r in real("postings_cleaned").collect()}
    assert len(got) == 42 and got["ff00"] == 80 and got["0000"] == 0 and got["00ab"] == 6


# ---- schemas, unique keys --------------------------------------------------------------------

def test_schemas(spark):
    for name in schemas.DDL:
        assert schemas.empty(spark, name).columns == schemas.schema(name).names
        assert all(set(k) <= set(schemas.schema(name).names) for k in schemas.UNIQUE.get(name, []))
    df = spark.createDataFrame([(1, "é" * 255, "2020-01-01", "5.5", 1), (2, "x" * 256, "2020-01-01", None, 1), (None, "a", "bad", "1e30", 1),
                                (3, None, None, None, 1)], "posting_id long, job_title string, posting_date string, salary_min string, reasons int")
    good, bad = schemas.split_fitting(df, "staging")
    assert sorted(r.posting_id for r in good.collect()) == [1, 3] and good.columns == schemas.schema("staging").names
    assert good.where("posting_id = 1").first().salary_min == decimal.Decimal("5.50")
    assert {r.posting_id: r.reasons for r in bad.collect()} == {
        2: ["job_title: longer than 255"], None: ["posting_id: null", "posting_date: not a date", "salary_min: not a decimal(10,2)"]}
    assert Warehouse(spark, _root()).read_or_empty("fact").count() == 0


def test_unique_keys_in_one_shuffle(spark):
    a = spark.createDataFrame([(1, "x", None), (1, "y", None), (2, "x", "z"), (2, "x", "z"), (None, "q", "q")], "id long, a string, b string")
    df = quality.check_unique_keys({"t": (a, [("id",), ("a", "b"), ("a",)]), "none": (a.limit(0), [("id",)])})
    assert sorted(tuple(r) for r in df.collect()) == [("none", "id", 0, 0), ("t", "a", 1, 3), ("t", "a,b", 1, 2), ("t", "id", 2, 4)]


# ---- rules -------------------------------------------------------------------------------------

def test_a_changed_rule_file_changes_the_query(spark):
    from postwise.plans.catalog import QUERIES, RULE_FILE
    content = json.load(open(RULE_FILE, encoding="utf-8"))
    content["cleaning_rules"]["industry_mapping"]["Casino"] = "Leisure"
    content["data_quality"]["max_salary"] = 10_000
    path = os.path.join(_root(), "rules.json")
    with open(path, "w", encoding="utf-8") as f:
        json.dump(content, f)
    one, two = (QUERIES["clean_with_rule_file"](spark, SF_SMALL, p).checkpoint() for p in (RULE_FILE, path))
    n = one.where("industry = 'Gaming'").count()
    assert n > 0 and two.where("industry = 'Leisure'").count() == n and two.where("industry = 'Gaming'").count() == 0
    assert two.where("salary_valid").count() > one.where("salary_valid").count()


def test_rule_files_are_checked(spark):
    bad = {"cleaning_rules": {"industry_mapping": ["x"], "colour": 1, "mode": "wild", "salary_extraction": {"currency": "USD", "x": 1}},
           "deduplication": {"similarity_threshold": 3, "time_window_days": 1.5, "enabled": "yes"}, "data_quality": {"required_fields": []},
           "more": {}, "etl": {"batch_size": 1}}
    with pytest.raises(RuleError) as e:
        rules_from(bad)
    assert len(e.value.problems) == 9 and any("colour" in p for p in e.value.problems)
    for text in ('{"a": 1, "a": 2}', "{", "[]"):
        with pytest.raises(RuleError):
            rules_from(parse_rules(text))
    with pytest.raises(RuleError):
        rules_from({"cleaning_rules": {"date_formats": ["no format!!"]}}, spark=spark)
    with pytest.raises(RuleError):
        rules_from({"data_quality": {"min_salary": 5, "max_salary": 2}})
    assert rules_from({}) == R.DEFAULT_RULES
    root = _root()
    with open(os.path.join(root, "r.yaml"), "w", encoding="utf-8") as f:
        f.write("deduplication:\n  time_window_days: 3\n  fields: [job_title]\ncleaning_rules:\n  title_keywords: {tester: QA}\n")
    pytest.importorskip("yaml")
    for path in (f"{root}/r.yaml", f"file://{root}/r.yaml"):
        r = load_rules(spark, path)
        assert (r.time_window_days, r.dedup_fields, r.title_keywords) == (3, ("job_title",), (("tester", "QA"),))


def test_rule_tables_by_measured_bytes(spark):
    df = spark.createDataFrame([(i, f"k{i % 7}" if i % 5 else None, "z") for i in range(60)], "id long, c string, _to string")
    table = spark.createDataFrame([(f"k{i}", f"v{i}") for i in range(5)] + [("k1", "w"), (None, "n"), ("k6", None)], "from string, to string")
    small, large = clean.map_values_table(df, "c", table), clean.map_values_table(df, "c", table, limit=0)
    want = sorted((i, None if i % 5 == 0 else (f"v{i % 7}" if i % 7 < 5 else f"k{i % 7}"), "z") for i in range(60))
    for got in (small, large):
        assert sorted(tuple(r) for r in got.collect()) == want and got.columns == df.columns


def test_hash_over_chosen_fields(spark):
    df = spark.createDataFrame([(1, " A  b ", dt.date(2024, 1, 2)), (2, "A b", dt.date(2024, 1, 2)), (3, None, None), (4, "", None)],
                               "i int, t string, d date")
    h = {r.i: r.h for r in df.select("i", clean.hash_fields(df, ["t", "d"]).alias("h")).collect()}
    assert h[1] == h[2] and h[3] == h[4] != h[1]
    std = clean.clean_standard(raw_postings(spark, SF_SMALL), fields=("job_title_raw", "city"))
    again = clean.clean_standard(raw_postings(spark, SF_SMALL))
    assert std.select("hash_dedup").distinct().count() < again.select("hash_dedup").distinct().count()


# ---- broadcasts ----------------------------------------------------------------------------------

def test_broadcast_by_bytes(spark):
    from postwise.operators.keys import broadcast_if_small, measured
    df = spark.createDataFrame([(i, "x" * 1000) for i in range(50)], "i long, t string")
    assert measured(df) == (50, 50 * (1000 + 8 + 16))
    assert broadcast_if_small(df)[1] and not broadcast_if_small(df, max_bytes=10_000)[1] and not broadcast_if_small(df, max_rows=10)[1]
