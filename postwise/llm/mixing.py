"""Mixing sources by temperature.

A source's weight is its token share to the power alpha, normalised: alpha 1 keeps
the shares, alpha 0 gives every source the same. alpha is bisected, SPLIT points
at a time, each round one aggregate over the sources, until it meets a target
entropy (a share of ln(number of sources)) or a limit on repetition (the most
that any source may be read, relative to the least read one). Weights times a
token budget are the sources' targets.

A target is realised in blocks: each block is a permutation of the source's
documents (by a hash of block, source and id). Whole blocks are read as often as
the target has them; of the last one, documents are read in order as long as the
rest of the budget has room for them. So a document's copies follow from its
source's (blocks, cut) and its own hash: texts are never shuffled. The cut is
found from sums by slots of the hash, and running sums within the slot where
the budget ends, so no task holds a whole source.

Defined results: a null source counts as the empty name, a null text as no tokens;
sources without tokens get weight 0 and their documents one copy; rows of equal
id and source are read together or not at all; no rows give no rows.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from postwise.llm.common import materialise, words

SPLIT = 15
ROUNDS = 7
SLOT_BITS = 10
SEED = 17
#: Sources up to this many are broadcast to the documents (two numbers and a name each).
BROADCAST_SOURCES = 50_000


def source_name() -> Column:
    return F.coalesce("source", F.lit(""))


def n_tokens() -> Column:
    """Tokens of a text: its words."""
    return F.size(words(F.col("text"))).cast("bigint")


def order_key(block: Column | int) -> Column:
    """A document's place in a block's permutation of its source: a non-negative number."""
    b = F.lit(block) if isinstance(block, int) else block
    return F.shiftrightunsigned(F.xxhash64(F.lit(SEED), b.cast("bigint"), source_name(), F.col("doc_id")), 1)


def find_alpha(shares: DataFrame, target_entropy: float | None = None, max_repeats: float | None = None) -> float:
    """The largest alpha in [0, 1] whose entropy is at least target_entropy * ln(sources), or
    the least one at which no source is read more than max_repeats times as often as another.

    ``shares`` has a positive ``p`` per source. 0 (1) if no alpha in the range meets the target.
    """
    n = shares.count()
    if n < 2:
        return 1.0

    def ok(grid: list[float]) -> list[bool]:
        cols = []
        for k, a in enumerate(grid):
            x = F.pow("p", F.lit(a))
            ratio = F.pow("p", F.lit(a - 1.0))
            cols += [F.sum(x).alias(f"z{k}"), F.sum(x * F.log(x)).alias(f"s{k}"),
                     F.max(ratio).alias(f"h{k}"), F.min(ratio).alias(f"l{k}")]
        r = shares.agg(*cols).first()
        if target_entropy is not None:
            return [math.log(r[f"z{k}"]) - r[f"s{k}"] / r[f"z{k}"] >= target_entropy * math.log(n) - 1e-9
                    for k in range(len(grid))]
        return [r[f"h{k}"] / r[f"l{k}"] > max_repeats for k in range(len(grid))]

    # ok is true below the sought alpha and false above it.
    low, high = 0.0, 1.0
    ends = ok([low, high])
    if ends[1] or not ends[0]:
        return high if ends[1] else low
    for _ in range(ROUNDS):
        grid = [low + (high - low) * (i + 1) / (SPLIT + 1) for i in range(SPLIT)]
        held = [g for g, x in zip(grid, ok(grid)) if x]
        step = (high - low) / (SPLIT + 1)
        low = max(held, default=low)
        high = low + step
    return low if target_entropy is not None else high


def source_plan(narrow: DataFrame, target_entropy: float | None, max_repeats: float | None,
                budget: int | None) -> DataFrame:
    """One row per source: source, tokens, weight, target, blocks (whole ones), cut (order keys
    of the next block up to this are read; -1: none), alpha.

    ``narrow`` has source, key (order key in the block after the whole ones is taken from
    block 0's permutation) and tokens. Without a budget it is the least one that reads every
    document at least once.
    """
    total = narrow.groupBy("source").agg(F.sum("tokens").alias("tokens"))
    total = materialise(total, "sources")
    n = total.agg(F.sum("tokens")).first()[0] or 0
    some = total.filter("tokens > 0").withColumn("p", F.col("tokens") / n)
    alpha = find_alpha(some.select("p"), target_entropy, max_repeats) if n else 1.0
    some = some.withColumn("w", F.pow("p", F.lit(alpha)))
    z, most = some.agg(F.sum("w"), F.max(F.col("tokens") / F.col("w"))).first()
    size = float(budget) if budget is not None else (most or 0) * (z or 1)
    plan = some.withColumn("weight", F.col("w") / F.lit(z or 1.0)).withColumn("target", F.col("weight") * size)
    plan = plan.withColumn("blocks", F.floor(F.col("target") / F.col("tokens") + 1e-9)) \
        .withColumn("rest", F.col("target") - F.col("blocks") * F.col("tokens"))
    slot = F.shiftright("key", 63 - SLOT_BITS)
    slots = narrow.groupBy("source", slot.alias("slot")).agg(F.sum("tokens").alias("t"))
    w = Window.partitionBy("source").orderBy("slot")  # at most 2^SLOT_BITS rows of a source
    slots = slots.withColumn("upto", F.sum("t").over(w)).join(plan.select("source", "rest"), "source")
    # The first slot that does not fit as a whole: keys below it are read, those in it are summed up.
    ends = slots.filter("upto > rest").groupBy("source", "rest").agg(F.min(F.struct("slot", "t", "upto")).alias("e")) \
        .select("source", "rest", F.col("e.slot").alias("slot"), (F.col("e.upto") - F.col("e.t")).alias("before"))
    keyed = narrow.withColumn("slot", slot).join(ends, ["source", "slot"]).groupBy("source", "rest", "slot", "before", "key") \
        .agg(F.sum("tokens").alias("t"))
    w = Window.partitionBy("source").orderBy("key")
    keyed = keyed.withColumn("upto", F.col("before") + F.sum("t").over(w))
    least = F.shiftleft(F.col("slot").cast("bigint"), 63 - SLOT_BITS) - 1
    cut = keyed.groupBy("source").agg(F.coalesce(F.max(F.when(F.col("upto") <= F.col("rest"), F.col("key"))),
                                                 F.min(least)).alias("cut"))
    plan = plan.join(cut, "source", "left")
    return total.select("source").join(plan, "source", "left").select(
        "source", F.coalesce("tokens", F.lit(0)).alias("tokens"), F.coalesce("weight", F.lit(0.0)).alias("weight"),
        F.coalesce("target", F.lit(0.0)).alias("target"), F.coalesce("blocks", F.lit(1)).cast("bigint").alias("blocks"),
        F.coalesce("cut", F.lit(-1)).alias("cut"), F.lit(alpha).alias("alpha"))


def copies(docs: DataFrame, target_entropy: float | None = None, max_repeats: float | None = None,
           budget_share: float | None = None) -> DataFrame:
    """The input rows as a struct _row, with tokens, weight (of the source), alpha and copies
    (how often the document is read; 0 if the budget has no room for it).

    Set one of target_entropy and max_repeats. budget_share is the budget as a multiple of all
    tokens; without it every document is read at least once.
    """
    narrow = materialise(docs.select(source_name().alias("source"), order_key(0).alias("key"),
                                     n_tokens().alias("tokens")), "tokens")
    budget = None
    if budget_share is not None:
        budget = int((narrow.agg(F.sum("tokens")).first()[0] or 0) * budget_share)
    plan = materialise(source_plan(narrow, target_entropy, max_repeats, budget), "plan") \
        .select(F.col("source").alias("_source"), "weight", "alpha", "blocks", "cut")
    if plan.count() <= BROADCAST_SOURCES:
        plan = F.broadcast(plan)
    d = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("_row"), source_name().alias("_source"),
                    order_key(0).alias("_key"), n_tokens().alias("tokens"))
    return d.join(plan, "_source").withColumn(
        "copies", F.col("blocks") + (F.col("_key") <= F.col("cut")).cast("bigint")) \
        .select("_row", "_source", "tokens", "weight", "alpha", "copies", "blocks")


def places() -> Column:
    """Array of (block, order) of a row of :func:`copies`, one for each time that it is read: block from 0, order its
    place in the block's permutation. Whole block b has permutation b + 1; the last, partial block has permutation 0, the
    one that its cut was taken from."""
    def place(b):
        permutation = F.when(b < F.col("blocks"), b + 1).otherwise(F.lit(0)).cast("bigint")
        order = F.shiftrightunsigned(F.xxhash64(F.lit(SEED), permutation, F.col("_source"), F.col("_row.doc_id")), 1)
        return F.struct(b.cast("bigint").alias("block"), order.alias("order"))
    return F.transform(F.expr("CASE WHEN copies > 0 THEN sequence(0L, copies - 1) ELSE array() END"), place)


def schedule(mixed: DataFrame) -> DataFrame:
    """The rows of :func:`copies`, one for each copy, with block and order (:func:`places`)."""
    return mixed.select("*", F.explode(places()).alias("_p")).select(*mixed.columns, "_p.block", "_p.order")
