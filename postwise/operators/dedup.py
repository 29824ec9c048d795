"""De-duplication.

D1 keeps the earliest row per record hash. D2 drops a row when an earlier
row of the same company, at most ``days`` days before it, is similar enough
(normalised Levenshtein on the compared text). "Earlier" orders by (date,
id); rows without a date are never compared, so they are always kept. It compares against all
earlier rows, not only against survivors, so chains A~B~C drop B and C even
when A and C are not similar.

Neither ever collects a group: D1 is an aggregate with map-side partial
combine (``min_by``), so a hash holding a third of the rows is reduced in
every task before the shuffle. D2 first collapses identical texts to one
line per (company, text, day), so a hot group costs one line per day;
lines of one company that share one of their rarest q-grams (exact, see
``_prefix_grams``) stand in a list by date, which each line reads backwards
until it meets a similar one or leaves the window
(:mod:`postwise.operators.walks`), so a block of near-identical titles costs
about one check a line.

Defined results of D2: rows with a null company or text are compared with none
and kept; the empty text is a text like any other; no rows give no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from postwise import rules as R
from postwise.operators.walks import numbered, walk
from postwise.session import ensure_checkpoint_dir


def dedup_exact(df: DataFrame, key: str = "hash_dedup", order: str = "posting_id",
                existing: DataFrame | None = None) -> DataFrame:
    """One row per ``key`` (smallest ``order`` wins), minus keys already
    stored in ``existing``."""
    cols = df.columns
    best = df.groupBy(key).agg(F.min_by(F.struct(*[F.col(c) for c in cols]), F.col(order)).alias("_r"))
    out = best.select("_r.*")
    if existing is not None:
        out = out.join(existing.select(key).distinct(), key, "left_anti")
    return out


def similarity(a, b):
    """1 - levenshtein(a, b) / max(len a, len b); two empty strings -> 1.0."""
    a = F.col(a) if isinstance(a, str) else a
    b = F.col(b) if isinstance(b, str) else b
    longest = F.greatest(F.length(a), F.length(b))
    return F.when(longest == 0, F.lit(1.0)).otherwise(
        F.lit(1.0) - F.levenshtein(a, b) / longest)


def fuzzy_text(df: DataFrame) -> DataFrame:
    """The compared fields of a standard-profile cleaned table: company,
    text = lower(title|province|city), date."""
    return df.select(
        "posting_id",
        F.col("company_name_std").alias("_co"),
        F.lower(F.concat_ws("|", F.col("job_title_raw"), F.col("province"), F.coalesce(F.col("city"), F.lit(""))))
        .alias("_s"),
        F.col("posting_date").alias("_d"),
    )


_Q = 2  # q-gram length
ONE_LIST = 64  # lines of a company up to which they all stand in one list


def _edits(length, threshold: float):
    """Edits that a text of this length may have to one at least this similar: (1 - t) * the longer one's length,
    which is at most length / t."""
    return F.floor(length * ((1.0 - threshold) / threshold) + 1e-9)


def _prefix_grams(lines: DataFrame, threshold: float, one_list: int) -> DataFrame:
    """The lines once for each list that they stand in: one of the company's rarest q-grams of the text, at its place.

    k edits leave all but q * k of a text's q-grams as they are, each moved by at most k places. So the
    first q * k + 1 q-grams, in an order that is one for the whole company, hold the rarest of those
    left, in both texts alike. Texts that may lose all their q-grams have the empty gram besides, and
    so have all that may be similar to one. The lines of a company with at most ``one_list`` of them
    stand in one list instead, without a cut into q-grams.
    """
    k = _edits(F.col("_len"), threshold)
    of = lines.groupBy("_co").agg(F.count("*").alias("_lines"))
    lines = lines.join(of.withColumn("_one", F.col("_lines") <= one_list).drop("_lines"), "_co")
    whole = lines.where("_one").select("*", F.lit("").alias("_gram"), F.lit(0).alias("_at"))
    lines = lines.where("NOT _one")
    texts = lines.select("_co", "_s", "_len").distinct().withColumn("_k", k)
    at = F.explode(F.sequence(F.lit(1), F.greatest(F.col("_len") - F.lit(_Q - 1), F.lit(1))))
    grams = texts.select("*", at.alias("_at")).withColumn("_gram", F.substring(F.col("_s"), F.col("_at"), _Q))
    freq = grams.groupBy("_co", "_gram").agg(F.count("*").alias("_f"))
    order = F.row_number().over(Window.partitionBy("_co", "_s").orderBy("_f", "_gram", "_at"))
    prefix = grams.join(freq, ["_co", "_gram"]).withColumn("_r", order).where(F.col("_r") <= _Q * F.col("_k") + 1)
    prefix = prefix.select("_co", "_s", "_gram", "_at")
    c = _Q * (1.0 - threshold) / threshold
    bare = F.col("_len") * threshold < 2.0 / (1.0 - c) if c < 1 else F.lit(True)
    short = texts.where(bare & (F.col("_k") > 0)).select("_co", "_s", F.lit("").alias("_gram"), F.lit(0).alias("_at"))
    return lines.join(prefix.unionByName(short), ["_co", "_s"]).unionByName(whole)


def fuzzy_duplicates(rows: DataFrame, threshold: float = R.SIMILARITY_THRESHOLD,
                     days: int = R.TIME_WINDOW_DAYS, one_list: int = ONE_LIST) -> DataFrame:
    """D2 core on (posting_id, _co, _s, _d): the ids that are duplicates (the same ones for any ``one_list``)."""
    ensure_checkpoint_dir(rows.sparkSession)
    # Read by several branches: written once instead of cleaned once per branch.
    dated = rows.where(F.col("_d").isNotNull()).checkpoint(eager=True)
    # One line per (company, text, day): its smallest id; the ids above it are duplicates.
    day = dated.groupBy("_co", "_s", "_d").agg(F.min("posting_id").alias("_min_id"))
    # Identical text: a day's first row is a duplicate when the same text
    # appeared on an earlier day at most `days` days before.
    w = Window.partitionBy("_co", "_s").orderBy("_d")
    day = day.withColumn("_prev_d", F.lag("_d").over(w)).withColumn(
        "_same", F.coalesce(F.datediff("_d", "_prev_d") <= days, F.lit(False))).withColumn("_len", F.length("_s"))
    lines = day.drop("_prev_d").where(F.col("_s").isNotNull()).withColumn("_line", F.monotonically_increasing_id()) \
        .checkpoint(eager=True)
    # Similar text: any earlier line (by date and id) of the company in the window will do.
    order = F.struct("_d", "_min_id", "_line", "_at")
    entries = _prefix_grams(lines, threshold, one_list).select("_co", "_gram", order.alias("_order"), "_line", "_d", "_len", "_at", "_same")
    lists = numbered(entries, ["_co", "_gram"], ["_order"]).drop("_order").checkpoint(eager=True)

    def within(y, x):
        return F.datediff(y("_d"), x("_d")) <= days

    def near(y, x):
        longest = F.greatest(y("_len"), x("_len"))
        k = F.floor(longest * (1.0 - threshold) + 1e-9)
        placed = (F.abs(y("_at") - x("_at")) <= k) | (y("_at") == 0)
        return within(y, x) & (F.abs(y("_len") - x("_len")) <= k) & placed & ~y("_same")

    def verify(pairs):
        texts = lines.select("_line", "_s")
        v = pairs.join(texts.select(F.col("_line").alias("_y"), F.col("_s").alias("_a")), "_y") \
            .join(texts.select(F.col("_line").alias("_x"), F.col("_s").alias("_b")), "_x")
        return v.where((F.col("_a") != F.col("_b")) & (similarity("_a", "_b") >= threshold))

    similar = walk(lists, "_line", ["_d", "_len", "_at", "_same"], near, verify, smallest=False, within=within, first=8)
    days_of = lines.join(similar.select("_line", F.lit(True).alias("_similar")), "_line", "left")
    tagged = dated.join(days_of.select("_co", "_s", "_d", "_min_id", "_same", "_similar"), ["_co", "_s", "_d"])
    dup = (F.col("posting_id") > F.col("_min_id")) | F.col("_same") | F.coalesce("_similar", F.lit(False))
    return tagged.where(dup).select("posting_id")


def dedup_fuzzy(df: DataFrame, threshold: float = R.SIMILARITY_THRESHOLD,
                days: int = R.TIME_WINDOW_DAYS) -> DataFrame:
    """``df`` (standard-profile cleaned) without its near duplicates."""
    dups = fuzzy_duplicates(fuzzy_text(df), threshold, days)
    return df.join(dups, "posting_id", "left_anti")
