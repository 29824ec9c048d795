"""Document dedup against brute-force Jaccard (sf0.001)."""

import itertools
import random

from postwise.operators.docdedup import dedup_documents
from postwise.sources.tables import read_table
from tests.conftest import SF_SMALL


def _shingles(text, n=5):
    w = [x for x in text.lower().split() if x]
    if len(w) < n:
        return {tuple(w)}
    return {tuple(w[i:i + n]) for i in range(len(w) - n + 1)}


def test_against_brute_force(spark):
    docs = read_table(spark, SF_SMALL, "documents").select("doc_id", "text")
    got = {r["doc_id"]: r["duplicate_of"] for r in dedup_documents(docs).collect()}
    texts = {r["doc_id"]: _shingles(r["text"] or "") for r in docs.collect()}
    assert set(got) == set(texts)  # every document is returned
    # Precision: every reported pair really is similar.
    for d, rep in got.items():
        if rep is not None:
            a, b = texts[d], texts[rep]
            assert rep < d and len(a & b) >= 0.8 * len(a | b)
    # Recall: documents with an earlier near-copy are found.
    truth = set()
    for x, y in itertools.combinations(sorted(texts), 2):
        a, b = texts[x], texts[y]
        if len(a & b) >= 0.8 * len(a | b):
            truth.add(y)
    found = {d for d, rep in got.items() if rep is not None}
    assert found <= truth
    assert len(found) >= 0.9 * len(truth)


def test_all_near_copies_are_found(spark):
    """Documents that are near copies only of each other, in buckets whose smallest id is like none of them."""
    rows, base = [], [f"w{i}" for i in range(400)]
    for k in range(60):
        ws, step = list(base), 30 if k < 45 else 100
        for at in range(k % 25, 400, step):
            ws[at] = f"x{k}_{at}"
        rows.append((k + 1, " ".join(ws)))
    rows += [(70, rows[50][1]), (71, rows[51][1].upper()), (72, None), (73, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    sets = {i: _shingles(t or "") for i, t in rows}
    near = {i: [j for j in sets if j < i and t is not None and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])] for i, t in rows}
    want = {i: min(js, default=None) for i, js in near.items()}
    got = {r.doc_id: r.duplicate_of for r in dedup_documents(df).collect()}
    want[72] = want[73] = got[72] = got[73] = None  # texts without words: whatever they were before
    assert got == want and sum(x is not None for x in want.values()) >= 10


def test_equals_brute_force_in_full(spark):
    docs = read_table(spark, SF_SMALL, "documents").select("doc_id", "text")
    texts = {r.doc_id: _shingles(r.text or "") for r in docs.collect()}
    want = dict.fromkeys(texts)
    for x, y in itertools.combinations(sorted(texts), 2):
        if want[y] is None and len(texts[x] & texts[y]) >= 0.8 * len(texts[x] | texts[y]):
            want[y] = x
    assert {r.doc_id: r.duplicate_of for r in dedup_documents(docs).collect()} == want


def test_families_cost_about_a_check_a_copy(spark):
    """Near copies of one text: each is compared about once, also with a text before them that holds their rare
    passage and is like none of them; the answers are those of brute force."""
    from postwise.operators import docdedup
    from postwise.operators.walks import walk
    rng = random.Random(3)
    base = [f"w{i}" for i in range(200)]
    rows = [(0, " ".join(base[:60] + [f"z{i}" for i in range(400)]))]
    for k in range(1, 301):
        ws = list(base)
        ws[rng.randrange(200)] = f"x{k}"
        rows.append((k, " ".join(ws)))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    checks = []

    def counted(*args, **kw):
        verify = args[4]

        def run(pairs):
            checks.append(pairs.count())
            return verify(pairs)
        return walk(*args[:4], run, *args[5:], **kw)

    docdedup.walk, before = counted, docdedup.walk
    try:
        got = {r.doc_id: r.duplicate_of for r in dedup_documents(df).collect()}
    finally:
        docdedup.walk = before
    sets = {i: _shingles(t) for i, t in rows}
    want = {i: next((j for j in range(i) if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])), None) for i in sets}
    assert got == want
    assert sum(checks) <= 4 * len(rows)


def test_awkward_documents(spark):
    rows = [(1, "a b c"), (2, "A  b\tc"), (None, "a b c"), (3, None), (4, ""), (5, " \n "), (6, "one"), (7, "one"), (7, "one"),
            (8, "y " * 5000), (9, "y " * 9000)]
    df = spark.createDataFrame([(*r, 1, "h") for r in rows], "doc_id long, text string, _c int, h string")
    got = sorted((r.doc_id or -1, r.duplicate_of) for r in dedup_documents(df).collect() if r.duplicate_of is not None)
    assert got == [(2, 1), (7, 6), (7, 6), (9, 8)]
    assert dedup_documents(df.limit(0)).count() == 0


def test_sets_are_dealt_once_and_moved_only_for_pairs(spark, tmp_path):
    """Shingles go to their counts and to the join with them in one shuffle; a comparison moves only the sets it asks for."""
    import re

    from postwise.operators import docdedup

    rows = [(i, 40, [7, 8, *range(100 * i, 100 * i + 38)]) for i in range(1, 60)]
    rows += [(60, 40, rows[10][2][:39] + [1]), (61, 40, rows[20][2][:39] + [2])]
    path = f"{tmp_path}/sets"
    spark.createDataFrame(rows, "_c long, _k int, _set array<long>").write.parquet(path)
    sets = spark.read.parquet(path)
    q = docdedup.prefixes(sets, 0.8)
    q.collect()
    final = q._jdf.queryExecution().executedPlan().toString()
    assert "ReusedExchange" in re.split("== Initial Plan ==", final)[0]
    asked, put = [], docdedup.written

    def kept(df, name):
        out = put(df, name)
        if name == "asked":
            asked.append(sorted(r[0] for r in out.select("_c").collect()))
        return out

    docdedup.written = kept
    try:
        got = {r["_c"]: r["match"] for r in docdedup.nearest_earlier(sets, 0.8).collect()}
    finally:
        docdedup.written = put
    assert got == {60: 11, 61: 21}
    assert asked and all(len(a) <= 4 for a in asked)
