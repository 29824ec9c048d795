"""Quality rules: base rules per text, then a hashed n-gram log-likelihood ratio.

Base features come from the words ``[^\\x20\\x09-\\x0D]+`` and the ``\\n``-split
lines of the whole text. The model scores n-grams hashed into BUCKETS buckets:
word unigrams, unigrams and bigrams of word shapes (runs of lower-case letters
as ``a``, of capitals as ``A``, of digits as ``0``, all else as it stands). For a
bucket with count t in the trusted target and r in the raw corpus,

    llr = ln((t + PRIOR) / (r * T / R + PRIOR))

where T and R are the two totals, so that n-grams too rare to judge weigh
nothing. A document's score is the mean llr of its n-grams; it is kept if it
passes the base rules and its score is at least THRESHOLD.

The raw multinomial counts every document. The target multinomial counts the
documents of at most TARGET_ROWS labelled rows (quality 1, toxic 0; least hash of
the id first): a bounded sample of labels, so that their ids can be broadcast
and the texts are not shuffled. The model is at most BUCKETS rows, broadcast.

Defined results: a null text has no words and fails the base rules, as does an
empty text; the score of a text without words is null. Repeated rows and null
ids are kept as rows of their own; without target rows all llr tend to the
prior, and the base rules alone decide (the ratio is taken as 0).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postwise.llm.common import BLANKS, materialise, with_row_id, words

BUCKETS = 1 << 18
PRIOR = 20.0
THRESHOLD = -0.25
TARGET_ROWS = 100_000
SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
MAX_REPEATED = 50


def trigram_hashes(w: str) -> str:
    """SQL: the hash of each 3-word window of the word array ``w``, in order."""
    # Bound as a lambda's argument, the words are split once, whatever is merged into what.
    return (f"transform(array({w}), v -> transform(slice(v, 1, greatest(size(v) - 2, 0)),"
            f" (x, i) -> xxhash64(x, get(v, i + 1), get(v, i + 2))))[0]")


def repeat_words(w: str, h: str) -> str:
    """SQL: words covered by the 3-word windows that occur twice or more.

    ``h`` has one hash per window. The windows are sorted by (hash, place); those
    equal to a neighbour are the repeated ones; with their places sorted, each
    covers the words up to the next one's start, three at most.
    """
    by_hash = "sort_array(transform(g, (x, i) -> struct(x AS x, i AS i)))"
    places = (f"transform(array({by_hash}), s -> sort_array(transform(filter(s, (p, j) -> "
              f"get(s, j - 1).x <=> p.x OR get(s, j + 1).x <=> p.x), p -> p.i)))[0]")
    covered = (f"transform(array({places}), q -> aggregate(transform(q, (p, j) -> "
               f"least(3, coalesce(get(q, j + 1) - p, 3))), 0L, (a, x) -> a + x))[0]")
    return f"transform(array({h}), g -> CASE WHEN size(array_distinct(g)) = size(g) THEN 0L ELSE {covered} END)[0]"


def base_features(docs: DataFrame, text: str = "text") -> DataFrame:
    """Adds w (words) and the base columns: n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, base_failed."""
    t = F.coalesce(F.col(text), F.lit(""))
    lines = F.filter(F.split(t, "\n"), lambda x: F.btrim(x, F.lit(BLANKS)) != "")
    d = docs.withColumns({"w": words(t), "_lines": lines})
    d = d.withColumn("n_words", F.size("w").cast("bigint"))
    d = d.withColumn("_h", F.expr(trigram_hashes("w")))
    d = d.withColumns({
        "word_chars": F.char_length(F.translate(t, BLANKS, "")).cast("bigint"),
        "n_symbols": (F.char_length(t) - F.char_length(F.translate(t, SYMBOLS, ""))).cast("bigint"),
        "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("bigint"),
        "n_repeat_words": F.expr(repeat_words("w", "_h")).cast("bigint")})
    return d.withColumn("base_failed", (F.col("n_words") < MIN_WORDS)
                        | (100 * F.col("n_repeat_words") > MAX_REPEATED * F.col("n_words"))).drop("_lines", "_h")


def shapes(text: Column) -> Column:
    """The words' shapes, as many as there are words."""
    s = F.regexp_replace(F.coalesce(text, F.lit("")), r"\p{Ll}+", "a")
    return words(F.regexp_replace(F.regexp_replace(s, r"\p{Lu}+", "A"), r"\p{Nd}+", "0"))


def _bucket(*parts: str) -> str:
    return f"int(pmod(xxhash64({', '.join(parts)}), {BUCKETS}))"


#: SQL of the places of the words, from 0; none where there are no words.
PLACES = "slice(sequence(0, size(w)), 1, size(w))"
#: SQL of the buckets of the n-grams that begin at word i (words w, shapes s); null where there is none.
GRAMS = (f"CASE WHEN i >= 0 AND i < size(w) THEN {_bucket('1', 'get(w, i)')} END",
         f"CASE WHEN i >= 0 AND i < size(s) THEN {_bucket('2', 'get(s, i)')} END",
         f"CASE WHEN i >= 0 AND i + 1 < size(s) THEN {_bucket('3', 'get(s, i)', 'get(s, i + 1)')} END")


def target_ids(labels: DataFrame, rows: int = TARGET_ROWS) -> DataFrame:
    """Ids of the trusted target: a bounded sample of the labelled rows."""
    good = labels.filter("quality = 1 AND toxic = 0 AND doc_id IS NOT NULL").select("doc_id").distinct()
    return good.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)


def llr_model(docs: DataFrame, labels: DataFrame, target_rows: int = TARGET_ROWS, prior: float = PRIOR) -> DataFrame:
    """At most BUCKETS rows (bucket, llr)."""
    # The ids are at most target_rows numbers: a broadcast of proven size.
    ids = F.broadcast(target_ids(labels, target_rows).withColumn("_good", F.lit(1)))
    d = docs.select("doc_id", "text").join(ids, "doc_id", "left").select(
        words(F.col("text")).alias("w"), shapes(F.col("text")).alias("s"), F.coalesce("_good", F.lit(0)).alias("g"))
    d = d.select("w", "s", "g", F.explode(F.expr(PLACES)).alias("i"))
    c = d.select("g", F.explode(F.array(*map(F.expr, GRAMS))).alias("bucket")).filter("bucket IS NOT NULL") \
        .groupBy("bucket").agg(F.count("*").alias("r"), F.sum("g").alias("t"))
    c = materialise(c, "grams")  # read for the totals and for the ratios
    totals = c.agg(F.sum("r").alias("r"), F.sum("t").alias("t")).first()
    if not totals["t"]:
        return c.select("bucket", F.lit(0.0).alias("llr"))
    share = totals["t"] / totals["r"]
    return c.select("bucket", F.log((F.col("t") + prior) / (F.col("r") * share + prior)).alias("llr"))


def quality_rules(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD,
                  target_rows: int = TARGET_ROWS, row: str | None = None) -> DataFrame:
    """One row per document: _rid, doc_id, the base columns, score, kept.

    _rid is a number given to each row, or the values of the column ``row``, whose equal
    values must stand for rows of equal id and text. Any other column of the input is
    ignored, whatever its name.
    """
    model = F.broadcast(llr_model(docs, labels, target_rows))
    d = with_row_id(docs.select("doc_id", "text")) if row is None else docs.select(F.col(row).alias("_rid"), "doc_id", "text")
    d = base_features(d)
    meta = ["_rid", "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    d = d.withColumn("s", shapes(F.col("text"))).select(
        *meta, "w", "s", F.explode_outer(F.expr(PLACES)).alias("i"))
    g = d.select(*meta, *[F.expr(x).alias(f"g{k}") for k, x in enumerate(GRAMS)])
    for k in range(len(GRAMS)):
        g = g.join(model.select(F.col("bucket").alias(f"g{k}"), F.col("llr").alias(f"l{k}")), f"g{k}", "left")
    llr = sum((F.coalesce(f"l{k}", F.lit(0.0)) for k in range(1, len(GRAMS))), F.coalesce("l0", F.lit(0.0)))
    grams = sum((F.col(f"g{k}").isNotNull().cast("int") for k in range(1, len(GRAMS))), F.col("g0").isNotNull().cast("int"))
    # The verdict is an aggregate, so that a filter on it is not pushed below, where it would
    # compute the base features once more.
    out = g.groupBy(*meta).agg((F.sum(llr) / F.nullif(F.sum(grams), F.lit(0))).alias("score"),
                               F.bool_or("base_failed").alias("_failed"))
    out = out.withColumn("kept", ~F.col("_failed") & (F.coalesce("score", F.lit(0.0)) >= threshold))
    return out.select(*meta, "score", "kept")


def kept_documents(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The input columns of the documents that are kept.

    A verdict depends on the text alone, so it is joined by the text's digest, which is the same
    whenever it is computed.
    """
    digest = F.unhex(F.md5(F.coalesce("text", F.lit(""))))
    flat = docs.select(digest.alias("_rid"), "doc_id", "text")
    good = quality_rules(flat, labels, threshold, row="_rid").filter("kept").select(F.col("_rid").alias("_digest")).distinct()
    rows = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("_row"), digest.alias("_digest"))
    return rows.join(good, "_digest", "left_semi").select("_row.*")
