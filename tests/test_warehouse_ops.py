"""Multi-row goldens: dimensions, keys, upsert, fuzzy dedup, quality."""

import datetime as dt
from decimal import Decimal as Dm

from pyspark.sql import Window
from pyspark.sql import functions as F

from postwise.operators.dedup import dedup_exact, dedup_fuzzy
from postwise.operators.dimensions import merge_dimension, merge_star_a, seed_dimension
from postwise.operators.fact import FACT_KEYS, build_fact, upsert_fact
from postwise.operators.keys import assign_dense_ids
from postwise.operators import quality as Q


def test_dense_ids_match_row_number(spark):
    df = spark.range(0, 5000).select(((F.col("id") * 7919) % 5003).alias("k"))
    got = assign_dense_ids(df, ["k"], "rid", 10)
    chk = got.withColumn("rn", F.row_number().over(Window.orderBy("k")) + 9)
    assert chk.where("rn != rid").count() == 0
    assert got.count() == 5000


def test_company_collation_and_idempotent(spark):
    src = spark.createDataFrame([("ABC Ltd",), ("abc ltd ",), ("Ábc ltd",), ("XYZ",)], "company_name string")
    d1 = merge_dimension(None, src, ["company_name"], "company_id")
    assert sorted(r[0] for r in d1.select("company_name").collect()) == ["ABC Ltd", "XYZ"]
    d1 = d1.checkpoint(eager=True)
    d2 = merge_dimension(d1, src, ["company_name"], "company_id")
    assert d2.count() == 2
    more = spark.createDataFrame([("xyz",), ("New Co",)], "company_name string")
    d3 = merge_dimension(d1, more, ["company_name"], "company_id")
    assert sorted((r[0], r[1]) for r in d3.collect()) == [(1, "ABC Ltd"), (2, "XYZ"), (3, "New Co")]


def _staging(spark, rows):
    return spark.createDataFrame(rows, "posting_id long, job_title string, company_name string, industry string, "
                                       "location string, job_type string, experience_level string, "
                                       "education_level string, posting_date date, source_agency string, "
                                       "salary_min decimal(10,2), salary_max decimal(10,2)")


def test_star_a_no_fanout_and_seeds(spark):
    d = dt.date(2024, 1, 8)
    rows = [(1, "Dev", "A", "IT", "Phnom Penh", "Full-time", "Junior", "PhD", d, "CamHR", Dm("100"), Dm("200")),
            (2, "Dev", "A", "IT", "Phnom Penh", "Full-time", "Junior", "Bachelor", d, "CamHR", None, None),
            (3, "Dev", "a", "IT", "phnom penh", "Full-time", "Junior", "PhD", d, "camhr", None, None)]
    st = _staging(spark, rows)
    dims = merge_star_a(st, {})
    assert dims["dim_location"].where(F.lower("city") == "phnom penh").count() == 1
    assert dims["dim_source_agency"].count() == 6
    assert dims["dim_job"].count() == 2
    fact = build_fact(st, dims)
    assert sorted(r[0] for r in fact.select("posting_id").collect()) == [1, 2, 3]
    assert Q.check_fanout(st, fact).collect()[0].asDict() == {"fact_rows": 1, "staging_rows": 3}


def test_upsert_latest_salary_wins(spark):
    base = dict(time_id=1, company_id=1, job_id=1, industry_id=1, location_id=1, source_id=1)
    old = spark.createDataFrame([dict(base, posting_id=1, salary_min=Dm("100.00"), salary_max=Dm("200.00"), _batch=1)])
    new = spark.createDataFrame([dict(base, posting_id=7, salary_min=Dm("300.00"), salary_max=Dm("400.00"), _batch=2)])
    out = upsert_fact(old, new).collect()
    assert len(out) == 1 and out[0]["salary_min"] == Dm("300.00") and out[0]["posting_id"] == 1


def test_fuzzy_window(spark):
    rows = [(1, "Dev", "Acme", "Phnom Penh", None, dt.date(2024, 1, 1)),
            (2, "Dev", "Acme", "Phnom Penh", None, dt.date(2024, 1, 5)),
            (3, "Dev", "Acme", "Phnom Penh", None, dt.date(2024, 1, 24)),
            (4, "Devs", "Acme", "Phnom Penh", None, dt.date(2024, 1, 26)),
            (5, "Dev", "Other", "Phnom Penh", None, dt.date(2024, 1, 2))]
    df = spark.createDataFrame(rows, "posting_id long, job_title_raw string, company_name_std string, "
                                     "province string, city string, posting_date date")
    kept = sorted(r[0] for r in dedup_fuzzy(df).select("posting_id").collect())
    assert kept == [1, 3, 5]


def test_dedup_exact_keeps_earliest(spark):
    df = spark.createDataFrame([(3, "h"), (1, "h"), (2, "g")], "posting_id long, hash_dedup string")
    assert sorted((r["posting_id"], r["hash_dedup"]) for r in dedup_exact(df).collect()) == [(1, "h"), (2, "g")]


def test_quality_report_and_split(spark):
    d = dt.date(2024, 1, 8)
    rows = [(1, "Dev", "A", "IT", "X", "", "", "", d, "s", Dm("100"), Dm("200")),
            (2, "", "A", "IT", "X", "", "", "", d, "s", Dm("900"), Dm("200"))]
    st = _staging(spark, rows).withColumn("date_defaulted", F.lit(False)).withColumn("salary_range", F.lit(""))
    rep = {r["check"]: r["failed"] for r in Q.quality_report(st, Q.staging_checks()).collect()}
    assert rep == {"required_fields": 1, "date_valid": 0, "salary_valid": 1, "length_valid": 0}
    valid, rej = Q.split_valid(st, Q.staging_checks())
    assert valid.count() == 1 and rej.collect()[0]["reasons"] == ["required_fields", "salary_valid"]


def test_seed_location_mapped(spark):
    cities = [r["city"] for r in seed_dimension(spark, "dim_location").orderBy("location_id").collect()]
    assert "Sihanoukville" in cities and "Preah Sihanouk" not in cities


def _fuzzy_brute(rows, threshold=0.9, days=7):
    """Ids of (id, company, text, date) with an earlier row (by date, id) that is equal or similar enough."""
    def lev(a, b):
        prev = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            cur = [i]
            for j, y in enumerate(b, 1):
                cur.append(min(prev[j] + 1, cur[-1] + 1, prev[j - 1] + (x != y)))
            prev = cur
        return prev[-1]

    out, by = set(), {}
    for i, co, s, d in sorted((r for r in rows if None not in r), key=lambda r: (r[3], r[0])):
        for j, t, e in by.get(co, []):
            n = max(len(s), len(t))
            if (d - e).days <= days and (s == t or abs(len(s) - len(t)) <= n * (1 - threshold) + 1e-9
                                         and 1.0 - lev(s, t) / n >= threshold):
                out.add(i)
                break
        by.setdefault(co, []).append((i, s, d))
    return out


def test_fuzzy_equals_brute_force(spark):
    """On the fixture's cleaned postings and near copies of them: the same ids as comparing all pairs."""
    from postwise.operators.clean import clean_standard
    from postwise.operators.dedup import fuzzy_duplicates, fuzzy_text
    from postwise.sources.fixture import raw_postings
    from tests.conftest import SF_SMALL

    rows = fuzzy_text(clean_standard(raw_postings(spark, SF_SMALL)))
    # Make near-duplicates: the same rows with one character changed, 2 days later.
    near = rows.select((F.col("posting_id") + 10_000_000).alias("posting_id"), "_co",
                       F.concat(F.col("_s"), F.lit("x")).alias("_s"), F.date_add("_d", 2).alias("_d"))
    both = rows.unionByName(near)
    got = {r[0] for r in fuzzy_duplicates(both).collect()}
    assert got == _fuzzy_brute([tuple(r) for r in both.collect()])
    assert got == {r[0] for r in fuzzy_duplicates(both, one_list=0).collect()}
    assert len(got) > 100


def test_fuzzy_awkward_rows_equal_brute_force(spark):
    """Chains, one company with all rows, texts that share only common q-grams, equal dates, nulls, empty texts."""
    import random
    from postwise.operators.dedup import fuzzy_duplicates
    rng = random.Random(5)
    base = ["senior software developer|phnom penh|", "aaaaaaaaaaaaaaaaaaaaaa", "abababababababababababab", "", "x", "xy"]
    rows = []
    for i in range(400):
        s = list(rng.choice(base))
        for _ in range(rng.randrange(5)):
            if s:
                s[rng.randrange(len(s))] = rng.choice("abxyz ")
        rows.append((i, rng.choice(["c", "c", "c", "", None]), "".join(s) if i % 41 else None,
                     dt.date(2024, 1, 1) + dt.timedelta(days=rng.randrange(60)) if i % 37 else None))
    df = spark.createDataFrame(rows, "posting_id long, _co string, _s string, _d date")
    for threshold in (0.9, 0.7, 0.4):
        got = {r[0] for r in fuzzy_duplicates(df, threshold=threshold).collect()}
        assert got == _fuzzy_brute(rows, threshold)
        assert got == {r[0] for r in fuzzy_duplicates(df, threshold=threshold, one_list=10**6).collect()}
    assert fuzzy_duplicates(df.limit(0)).count() == 0


def test_fuzzy_low_threshold(spark):
    """At a low threshold two similar texts may share no q-gram."""
    from postwise.operators.dedup import fuzzy_duplicates
    rows = spark.createDataFrame(
        [(1, "c", "abcd", dt.date(2024, 1, 1)), (2, "c", "wxyz", dt.date(2024, 1, 2)),
         (3, "c", "abxy", dt.date(2024, 1, 3)), (4, "c", "zzzz", dt.date(2024, 1, 4))],
        "posting_id long, _co string, _s string, _d date")
    assert {r[0] for r in fuzzy_duplicates(rows, threshold=0.4).collect()} == {3}


def test_map_values_join_path_equals_case_path(spark):
    from postwise.operators.clean import map_column, map_values
    mapping = {f"k{i}": f"v{i}" for i in range(300)}  # over the inline limit -> join
    df = spark.createDataFrame([(i, f"k{i}" if i % 3 else f"other{i}") for i in range(400)], "id long, c string")
    joined = {r["id"]: r["c"] for r in map_values(df, "c", mapping).collect()}
    small = dict(list(mapping.items())[:150])
    inline = {r["id"]: r["c"] for r in df.select("id", map_column("c", mapping).alias("c")).collect()}
    assert joined == inline
    assert {r["id"]: r["c"] for r in map_values(df, "c", small).collect()} == \
        {r["id"]: r["c"] for r in df.select("id", map_column("c", small).alias("c")).collect()}
