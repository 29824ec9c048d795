"""D3: near-duplicate removal over long texts (exact set join on word shingles).

1. Shingles: the set of word n-grams of the whole lower-cased text, hashed with
   ``xxhash64`` on the JVM, within the document's own row.
2. Documents of one shingle set are one class (its smallest id). Only a digest of
   128 bits a document is shuffled for that; only classes go on.
3. Prefix filter: two sets of at least ``threshold`` Jaccard similarity share one of
   the ``size - ceil(threshold * size) + 1`` shingles of each that are rarest over all
   classes. The classes that share such a shingle are a list; two of them are only
   compared if their sizes, and what is left behind the shared shingle in both orders,
   allow for the similarity. No similar pair is left out.
4. What is asked of a class is its smallest similar class. Lists are read from the
   smallest id on and only until that is found (:mod:`postwise.operators.walks`), and
   a shingle in very many classes is no hot key, as entries are joined by their place.
   Each pair that is read is verified by the exact similarity of its sets.

Defined results: null, empty and blank texts have no shingles and are never duplicates;
a text shorter than n words is one shingle; rows of equal id count as copies of one
document, of its least set; no rows give no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from postwise.operators.keys import broadcast_if_small
from postwise.operators.walks import numbered, walk
from postwise.session import ensure_checkpoint_dir, written

#: Keeps rounding from raising a bound.
_SLACK = 1e-9


def shingle_sets(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = 5) -> DataFrame:
    """(id, _set): hashed word n-grams of each text that has a word, sorted, each once."""
    words = F.filter(F.split(F.lower(F.col(text_col)), r"\s+"), lambda w: w != "")
    sized = df.select(F.col(id_col), words.alias("_w")).where(F.size("_w") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("_w") - n + 1, F.lit(1)))
    grams = F.transform(starts, lambda i: F.xxhash64(F.slice(F.col("_w"), i, n)))
    return sized.select(id_col, F.array_sort(F.array_distinct(grams)).alias("_set"))


def prefixes(sets: DataFrame, threshold: float) -> DataFrame:
    """(h, _c, _k, _p): the prefix of every set (_c, _k, _set) as far as other sets hold its shingles: set size, and the
    shingle's place in the set from its rarest on."""
    # Dealt by shingle once, for the counts (of _c, so that both read the same columns) and for the join with them.
    rows = sets.where("_c IS NOT NULL").select("_c", F.explode("_set").alias("h")).where("h IS NOT NULL").repartition("h")
    shared = rows.join(rows.groupBy("h").agg(F.count("_c").alias("_n")).where("_n > 1"), "h").join(sets.select("_c", "_k"), "_c")
    # Shingles of no other set come first in the order; they are counted, not carried.
    w = Window.partitionBy("_c")
    alone = F.col("_k") - F.count("*").over(w)
    ranked = shared.withColumn("_p", (alone + F.row_number().over(w.orderBy("_n", "h"))).cast("int"))
    least = F.ceil(F.col("_k") * threshold - _SLACK)
    return ranked.where(F.col("_p") <= F.col("_k") - least + 1).select("h", "_c", "_k", "_p")


def nearest_earlier(sets: DataFrame, threshold: float = 0.8) -> DataFrame:
    """(_c, match): the smallest similar class of every class (_c, _k, _set) that has one before it."""
    lists = written(numbered(prefixes(sets, threshold), ["h"], ["_c"]), "lists")

    def near(y, x):
        small, large = F.least(y("_k"), x("_k")), F.greatest(y("_k"), x("_k"))
        common = threshold / (1 + threshold) * (y("_k") + x("_k")) - _SLACK
        return (small >= large * threshold - _SLACK) & (1 + F.least(y("_k") - y("_p"), x("_k") - x("_p")) >= common)

    def verify(pairs):
        # Only the sets of these pairs are moved; a small list of classes goes to the sets.
        ids, _ = broadcast_if_small(pairs.select(F.explode(F.array("_y", "_x")).alias("_c")).distinct())
        asked = written(sets.select("_c", "_set").join(ids, "_c", "left_semi"), "asked")
        v = pairs.join(asked.select(F.col("_c").alias("_y"), F.col("_set").alias("_s")), "_y") \
            .join(asked.select(F.col("_c").alias("_x"), F.col("_set").alias("_t")), "_x")
        inter = F.size(F.array_intersect("_s", "_t"))
        return v.where(inter >= F.lit(threshold) * (F.size("_s") + F.size("_t") - inter))

    return walk(lists, "_c", ["_k", "_p"], near, verify, smallest=True)


def dedup_documents(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = 5,
                    threshold: float = 0.8) -> DataFrame:
    """Every document with ``duplicate_of``: the smallest id among its near-copies
    with a smaller id (NULL for documents kept). The search is exact."""
    ensure_checkpoint_dir(df.sparkSession)
    sets = shingle_sets(df, id_col, text_col, n)
    digest = F.struct(F.size("_set").alias("k"), F.xxhash64(F.lit(1), "_set").alias("a"), F.xxhash64(F.lit(2), "_set").alias("b"))
    of = sets.groupBy(id_col).agg(F.min(digest).alias("_d"))
    classes = of.groupBy("_d").agg(F.min(id_col).alias("_c"))
    of = written(of.join(classes, "_d").select(id_col, "_c"), "classes")
    first = of.where(F.col(id_col) == F.col("_c")).select("_c")
    own = sets.join(first, sets[id_col] == first["_c"], "left_semi").groupBy(F.col(id_col).alias("_c")).agg(
        F.min_by("_set", digest).alias("_set")).select("_c", F.size("_set").alias("_k"), "_set")
    near = nearest_earlier(written(own, "sets"), threshold)
    best = of.join(near, "_c", "left").withColumn("_best", F.least("_c", "match"))
    found = best.where(F.col("_best") < F.col(id_col)).select(id_col, F.col("_best").alias("duplicate_of"))
    return df.select(id_col).join(found, id_col, "left")
