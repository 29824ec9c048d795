"""The pipeline on the smallest tables: each stage does what it says to what it is given."""

from collections import Counter

import corpus_pipeline as P
from postwise.sources.tables import read_table

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages(spark):
    docs = read_table(spark, SF, "documents").cache()
    before = {r.doc_id: r for r in docs.collect()}
    kept = P.quality_stage(spark, docs, SF).cache()
    assert kept.columns == COLUMNS
    verdict = {r.doc_id for r in kept.collect()}
    labels = {r.doc_id: r.quality for r in read_table(spark, SF, "labels").collect()}
    words = {i: len((r.text or "").split()) for i, r in before.items()}
    good = [i for i, q in labels.items() if q and words[i] >= 60]
    assert sum(i in verdict for i in good) >= 0.95 * len(good)
    assert not any(words[i] < 50 for i in verdict)
    lined = P.line_stage(spark, kept, SF).cache()
    assert lined.columns == COLUMNS and {r.doc_id for r in lined.collect()} == verdict
    left = Counter(x.strip().lower() for r in lined.collect() for x in r.text.split("\n") if x.strip())
    assert max(left.values()) == 1
    single = P.near_stage(spark, lined, SF).cache()
    assert single.columns == COLUMNS
    assert Counter(r.text for r in single.collect()).most_common(1)[0][1] == 1
    mixed = P.mixing_stage(spark, single, SF).cache()
    assert mixed.columns == COLUMNS and {r.doc_id for r in mixed.collect()} == {r.doc_id for r in single.collect()}
    packed = P.packing_stage(spark, mixed, SF).collect()
    assert Counter(r.doc_id for r in packed if r.start == 0) == Counter(r.doc_id for r in mixed.collect())


def test_run_is_registered(spark):
    import __spark_entry__ as E
    names = E.queries()
    assert names["pipeline"] is P.run
    assert {f"op{n}" for n in range(1, 14)} == {k.split("_")[0] for k in names if k.startswith("op")}
    assert "pipeline" not in E.oracle_sql()
