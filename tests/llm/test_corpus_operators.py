"""Token files, phrases and hard negatives against brute force, on awkward rows: nulls, empty and very long texts,
ties, repeated rows, equal ids, empty tables, extra columns with the operators' own names."""

import itertools
import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from postwise.llm import hard_negatives as hn
from postwise.llm import phrases, token_files, tokens
from postwise.llm.common import rows_at_a_time
from postwise.session import scratch_path

# ---- 1 kept trees --------------------------------------------------------------------------

def test_kept_trees_equal_counting_anew(spark):
    """Three batches of edits on stored trees: the counts of the texts as they then are, little of them counted."""
    from postwise.llm import token_counts
    counts, _ = tokens.counter(tokens.tokenizer_path(tokens.RANKS))
    rows = [(1, "Some words, and don't stop. " * 400), (2, ""), (None, None), (3, "x"), (3, "x"), (4, "é \n\n  a" * 100)]
    df = spark.createDataFrame([(*r, 0) for r in rows], "doc_id long, text string, n_tokens int").repartition(2)
    path = scratch_path(spark, "test-trees", str(random.random()))
    token_counts.token_trees(df).write.parquet(path + "/0")
    for batch in range(3):
        kept = spark.read.parquet(f"{path}/{batch}")
        edited = token_counts.edit_trees(kept.withColumn("edits", token_counts.sample_edits(F.col("text"))))
        edited.write.parquet(f"{path}/{batch + 1}")
        got = spark.read.parquet(f"{path}/{batch + 1}").collect()
        assert len(got) == len(rows) and all(r.n_tokens == len(counts.encoding.encode_ordinary(r.text)) for r in got)
        assert all(sum(r.leaf_chars) == len(r.text) and sum(r.leaf_tokens) == r.n_tokens for r in got)
        assert next(r for r in got if r.doc_id == 1).n_recounted < 1000 < next(r for r in got if r.doc_id == 1).n_tokens


# ---- 11 token files ------------------------------------------------------------------------


def _awkward_ids(rng, n):
    kind = rng.integers(0, 7)
    if kind == 0:
        return rng.integers(0, 50_257, n)
    if kind == 1:
        return rng.integers(0, 4, n)
    if kind == 2:
        return np.zeros(n, int)
    if kind == 3:
        return np.where(rng.random(n) < 0.02, rng.integers(0, 2 ** 32, n), rng.integers(0, 30, n))
    if kind == 4:
        return rng.integers(0, 2 ** 32, n)
    if kind == 5:
        return np.full(n, 2 ** 32 - 1)
    return rng.choice([2 ** w - d for w in (1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30) for d in (0, 1, 2)], n).clip(0)


def test_frames_round_trip():
    rng = np.random.default_rng(1)
    for _ in range(120):
        ids = [_awkward_ids(rng, int(rng.integers(0, 9000))).astype(np.uint32) for _ in range(int(rng.integers(0, 12)))]
        docs = [None if rng.random() < 0.1 else int(rng.integers(-5, 2 ** 62)) for _ in ids]
        frame = token_files.Frame(token_files.encode_frame(docs, ids))
        whole = np.concatenate(ids) if ids else np.zeros(0, np.uint32)
        for at_once in (1, 3, 100):
            got = list(frame.documents(at_once))
            assert [g[0] for g in got] == docs and all(np.array_equal(a, g[1]) for a, g in zip(ids, got))
        assert np.array_equal(frame.decode(), whole)
        for b in range(frame.blocks):  # each block by itself, by its offsets
            assert np.array_equal(frame.decode(b, b + 1), whole[b * token_files.BLOCK:(b + 1) * token_files.BLOCK])


def test_words_are_simple_8b():
    """Every word is a selector of 4 bits and its slots; a rare wide id is an escape and does not widen the word."""
    data = token_files.encode_frame([1], [np.array([1] * 59 + [70_000] + [5] * 40, np.uint32)])
    frame = token_files.Frame(data)
    assert len(frame.escapes) >= 1 and 70_000 in frame.escapes
    assert 8 * len(frame.words) + 4 * len(frame.escapes) < 100
    with pytest.raises(ValueError):
        token_files.Frame(b"none" + data[4:])


def test_whole_texts_have_the_tokenizers_ids():
    path, ranks = tokens.tokenizer_path(tokens.TOKENIZER), tokens.tokenizer_path(tokens.RANKS)
    tokenizer = tokens._load(path)[0]
    rng = random.Random(2)
    texts = [None, "", " ", "\n\n \t", "a" * 50_000, " " * 20_000, "é" * 9000, "no blanks at all" * 2000 + "<|endoftext|> x", "<|endoftext|>",
             "I'll don't we've 123 4567 ³ ½ ١٢٣ ​﻿ ﬁ 한국어 漢字 😀👩‍👩‍👧 \r\n\x1c\x85\xa0x　y"]
    texts += ["x" + "".join(chr(c) + rng.choice(["", " ", "1", "'s"]) for c in range(a, a + 400) if not 0xD800 <= c < 0xE000)
              for a in range(0, 0x11000, 400)]
    texts += ["".join(chr(rng.randrange(0x20, 0x3100)) for _ in range(300)) for _ in range(100)]
    want = [tokenizer.encode(t or "", add_special_tokens=False).ids for t in texts]
    assert tokens.encode_whole(texts, path, ranks) == want


def test_ids_come_as_arrays_and_windows_are_summed_in_8_bits():
    path, ranks = tokens.tokenizer_path(tokens.TOKENIZER), tokens.tokenizer_path(tokens.RANKS)
    texts = [None, "", " ", "some words\n here", "ünï <|endoftext|>", "한국어 漢字 😀 \r\n\x85\xa0x　y", "x" * 3000]
    got = tokens.encode_arrays(texts, path, ranks)
    assert all(x.dtype == np.uint32 for x in got)
    assert [x.tolist() for x in got] == tokens.encode_whole(texts, path, ranks)
    x = (np.random.default_rng(3).random(700) < 0.8).astype(np.uint8)
    for n in (*range(1, 20), 30, 60, 120, 240, 255):
        sums = token_files._window_sums(x, n)
        assert sums.dtype == np.uint8
        assert sums.tolist() == np.convolve(x.astype(int), np.ones(n, int), "valid").tolist()


def test_token_files_of_rows(spark):
    rows = [(5, "some words here\n"), (None, "null id"), (3, None), (4, ""), (5, "another five"), (5, "some words here\n"),
            (-2, "first"), (9, "long text " * 60_000), (7, "ünï <|endoftext|>")]
    df = spark.createDataFrame([(*r, 1, 2, "s") for r in rows], "doc_id long, text string, rid long, start int, shard string").repartition(3)
    path = scratch_path(spark, "test-token-files", str(random.random()))
    token_files.write_ids(df, path)
    tokenizer = tokens._load(tokens.tokenizer_path(tokens.TOKENIZER))[0]

    def ids(t):
        return [*tokenizer.encode(t or "", add_special_tokens=False).ids, 0]

    got = sorted(token_files.read_ids(spark, path).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in got] == [None, -2, 3, 4, 5, 5, 5, 7, 9]
    assert Counter((r.doc_id, bytes(r.ids)) for r in got) == Counter((i, np.array(ids(t), "<u4").tobytes()) for i, t in rows)
    assert [r.start for r in got] == [0, *itertools.accumulate(r.n_tokens for r in got)][:-1]
    none = scratch_path(spark, "test-token-files", str(random.random()))
    token_files.write_ids(df.limit(0), none)
    assert token_files.read_ids(spark, none).count() == 0


# ---- 12 phrases ----------------------------------------------------------------------------

def _pieces(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for c in ".,;:!?\n\x0b\x0c\r":
        low = low.replace(c, "\n")
    return [[w for w in p.replace("\t", " ").split(" ") if w] for p in low.split("\n")]


def _brute_phrases(rows, max_words=3, min_count=10, share=50, top=2000):
    counts, total = {}, Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for ws in _pieces(text):
            total[lang] += len(ws)
            for n in range(1, max_words + 1):
                for k in range(len(ws) - n + 1):
                    counts.setdefault(lang, Counter())[tuple(ws[k:k + n])] += 1
    out = []
    for lang, f in counts.items():
        kept = []
        for p, a in f.items():
            if len(p) < 2 or a < min_count:
                continue
            score, k = min((1_000_000 * a * a // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
            longer = [q for q in f if len(q) > len(p) and f[q] >= min_count and any(q[i:i + len(p)] == p for i in range(len(q)))]
            if not any(100 * f[q] >= share * a for q in longer):
                kept.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]], k))
        for rank, (s, a, p, le, r, k) in enumerate(sorted(kept)[:top], 1):
            out.append((lang, rank, p.decode(), -a, le, r, total[lang], -s, k))
    return sorted(out)


def _texts(seed, n):
    rng = random.Random(seed)
    pool = ["a", "b", "New", "york", "CITY", "É", "ab\xa0c", "x\x1cy", "Ünï", "the", "of"]
    seps = [" ", " ", " ", "  ", "\t", ", ", ". ", "\n", "!?", "\r\n", "\x0b"]
    return ["".join(rng.choice(pool) + rng.choice(seps) for _ in range(rng.randrange(60))) for _ in range(n)]


@pytest.mark.parametrize("max_words", [2, 3, 4])
def test_phrases_equal_brute_force(spark, max_words):
    rows = [(random.Random(i).choice(["en", "de", None, ""]), t) for i, t in enumerate(_texts(max_words, 250))]
    rows += [("en", None), ("en", ""), ("en", " .. \t"), ("xx", "once only"), ("en", "new york city " * 400), (None, "w w w w w w w w w w w w")]
    rows += rows[:5]
    df = spark.createDataFrame([(*r, 9, "p") for r in rows], "lang string, text string, n int, phrase string").repartition(4)
    for shard_bytes in (300, 10 ** 6):
        index = phrases.build_index(df, max_words, shard_bytes)
        assert {r.lang: r.n for r in phrases.word_totals(index).collect()} == \
            {k: v for k, v in Counter(itertools.chain.from_iterable(["und" if la is None else la] * sum(map(len, _pieces(t))) for la, t in rows)).items()}
    got = sorted(tuple(r[c] for c in ("lang", "rank", "phrase", "a", "l", "r", "n", "score", "k"))
                 for r in phrases.collocations(df, max_words).collect())
    assert got == _brute_phrases(rows, max_words) and len(got) >= 10
    assert phrases.collocations(df.limit(0), max_words).count() == 0


def test_index_counts_and_neighbours(spark):
    """Counts over shards, and how often a word stands before and behind; backward search for any phrase."""
    rows = [("en", t) for t in _texts(7, 60)]
    df = spark.createDataFrame(rows, "lang string, text string").repartition(3)
    index = phrases.build_index(df, 3, 400)
    with rows_at_a_time(spark, 1):
        got = {r.phrase: (r.n, r.before, r.behind) for r in phrases.ngrams(index, 3, 1).collect()}
    want = {}
    for _, t in rows:
        for ws in _pieces(t):
            for n in (1, 2, 3):
                for k in range(len(ws) - n + 1):
                    a, b, c = want.get(" ".join(ws[k:k + n]), (0, 0, 0))
                    want[" ".join(ws[k:k + n])] = (a + 1, b + (k > 0), c + (k + n < len(ws)))
    assert got == want
    shards = [phrases.Shard(r.asDict()) for r in index.collect()]
    assert len(shards) > 5
    for p in random.Random(1).sample(sorted(want), 40) + ["no such", "new new new york"[:11]]:
        assert sum(s.count("en", p) for s in shards) == want.get(p, (0,))[0]
    assert sum(s.count("de", "a") for s in shards) == 0


def test_scores_are_exact(spark):
    """Products beyond 64 and 53 bits."""
    rows = [(10 ** 10 + 7, 10 ** 10 + 9, 10 ** 10 + 11), (3 * 10 ** 15, 4 * 10 ** 15, 3 * 10 ** 15 + 1), (10, 10, 10), (10, 3_000_001, 11)]
    got = spark.createDataFrame(rows, "a long, l long, r long").select(phrases.exact_score("a", "l", "r").alias("s")).collect()
    assert [r.s for r in got] == [10 ** 6 * a * a // (le * r) for a, le, r in rows]


# ---- 13 hard negatives -----------------------------------------------------------------------

def _brute_negatives(rows, every=100, k=5):
    ok = [(n, i, la, [math.floor(256 * x) for x in v]) for n, (i, la, v) in enumerate(rows)
          if i is not None and la is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]

    def dot(a, b):
        return sum(x * y for x, y in zip(a, b))

    out = []
    for n, i, la, v in ok:
        if i % every:
            continue
        scored = sorted((-dot(v, w), j, m, lb) for m, j, lb, w in ok if m != n)
        for s, j, _, _ in [x for x in scored if x[3] == la][:k]:
            p = -s
            neg = [x for x in scored if x[3] != la and 80 * p <= -100 * x[0] <= 100 * p][:k]
            out += [(i, j, rank, x[1], p, -x[0]) for rank, x in enumerate(neg, 1)]
    return sorted(out)


def _vectors(seed, n, dims):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(6, dims)) * 0.4
    rows = []
    for i in range(n):
        la = int(rng.integers(0, 6))
        v = (centres[(la + (rng.random() < 0.4)) % 6] + rng.normal(size=dims) * 0.2).astype(np.float32)
        rows.append((i, la, [float(x) for x in v]))
    return rows


def _run(spark, rows, every=100):
    df = spark.createDataFrame([(*r, 1, [1], 0) for r in rows],
                               "vec_id long, label int, embedding array<float>, rid int, windows array<int>, score int").repartition(3)
    got = hn.hard_negatives(hn.integer_rows(df), F.col("vec_id") % every == 0)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted(tuple(r) for r in got.collect())


def test_negatives_equal_brute_force(spark, monkeypatch):
    rows = _vectors(1, 700, 12)
    want = _brute_negatives(rows, 20)
    assert len(want) > 300
    assert _run(spark, rows, 20) == want
    monkeypatch.setattr(hn, "SHARD", 60)   # many shards and blocks
    monkeypatch.setattr(hn, "BLOCK", 7)
    assert _run(spark, rows, 20) == want


def test_negatives_of_awkward_rows(spark):
    rng = random.Random(4)
    rows = [(i, rng.choice([0, 1, 2]), [rng.choice([0.0, 0.25, 0.5, -0.25]) for _ in range(4)]) for i in range(300)]  # many ties
    rows += [(1000, None, [1.0] * 4), (1100, 1, None), (None, 1, [1.0] * 4), (1200, 1, [float("nan"), 1.0, 1.0, 1.0]),
             (1300, 1, [float("inf"), 0.0, 0.0, 0.0]), (1400, 1, [None, 1.0, 1.0, 1.0]), (1500, 2, [0.0] * 4), (1600, 2, [-1.0] * 4),
             (1700, 9, [1.0, 1.0, 1.0, 1.0]), (1800, 2, [0.5, 0.5]), (1900, 2, []), (2000, 2, [300.0, 1.0, -200.0, 4.0])]
    assert _run(spark, rows) == _brute_negatives(rows)
    assert _run(spark, []) == [] and _run(spark, rows[:1]) == []


def test_components_are_held(spark):
    df = spark.createDataFrame([(100, 1, [3e38, -3e38])], "vec_id long, label int, embedding array<float>")
    assert hn.integer_rows(df).collect()[0].v == [hn.LIMIT, -hn.LIMIT]


def test_search_stops_early_and_loses_no_ties():
    """The algorithm itself: what it returns is what scoring all rows returns, and it does not score all rows."""
    rng = np.random.default_rng(2)
    m = np.floor(rng.normal(size=(4000, 8)) ** 3 * 100).astype(np.int32)
    lists = hn.Lists(m)
    saved = 0
    for _ in range(40):
        a = np.floor(rng.normal(size=8) * 50).astype(np.int64)
        scores = m.astype(np.int64) @ a
        top = int(np.sort(scores)[-20])
        eligible = rng.random(4000) < 0.7
        windows = [(None, None), (top // 2, top), (top, top + 10 ** 6), (0, 0)]
        found, depth, scored = lists.search(a, eligible, windows[:3], 5)
        saved += scored < eligible.sum()
        for (low, high), best in zip(windows, found):
            ok = np.flatnonzero(eligible & (scores >= (-10 ** 18 if low is None else low)) & (scores <= (10 ** 18 if high is None else high)))
            ranked = sorted((-scores[r], r) for r in ok)
            want = [r for r in ranked if len(ranked) < 5 or -r[0] >= -ranked[min(4, len(ranked) - 1)][0]]
            assert sorted((-s, r) for r, s in best.tolist()) == [(int(s), int(r)) for s, r in want]
    assert saved > 30


def test_index_row_groups_hold_a_shard_or_two_each(spark):
    """Six shards of one task: no row group, which writers and readers hold whole, has more than two of them."""
    import pyarrow.parquet as pq

    rng = np.random.default_rng(3)
    rows = [(k, "en", " ".join(map(str, rng.integers(0, 100_000, 600_000)))) for k in range(6)]
    docs = spark.createDataFrame(rows, "doc_id long, lang string, text string").coalesce(1)
    files = spark.read.parquet(phrases.build_index(docs).written_to).inputFiles()
    groups = [pq.ParquetFile(f.removeprefix("file://")).metadata for f in files]
    sizes = [g.row_group(k).num_rows for g in groups for k in range(g.num_row_groups)]
    assert sum(sizes) >= 6 and max(sizes) <= 2


def test_phrases_of_a_shard_are_written_out_a_part_at_a_time(monkeypatch):
    """While the first rows of a shard are sent, the texts of the others are not held."""
    import pyarrow as pa

    rng = np.random.default_rng(4)
    row = phrases.build_row({"en": [" ".join(map(str, rng.integers(0, 1000, 100_000))).encode()]}, 3)
    monkeypatch.setattr(phrases, "ROWS", 1000)
    before = pa.total_allocated_bytes()
    out = phrases._shard_ngrams(phrases.Shard(row), 3, np.full((1 << phrases.BITS) // 8, 255, np.uint8))
    sizes = [next(out).num_rows]
    assert pa.total_allocated_bytes() - before < 500_000
    sizes += [b.num_rows for b in out]
    assert sum(sizes) > 90_000 and max(sizes) == 1000
