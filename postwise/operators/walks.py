"""Searching sorted lists for one earlier match (used by D2 and D3).

Items stand in lists (of the items that share a rare shingle or q-gram), each list
sorted; an item's candidates are the entries before its own. What is sought is one match
an item, the smallest or any, so candidates are read a few at a time and an item that has
its match reads no further: n near copies of one text cost about n checks, not n^2.

All entries of all lists have one dense place (:func:`numbered`), so a list is never
gathered in a task: reading its k-th entry is a join on a unique place, whatever the
size of the list. Each round reads STEP times as many entries as the one before, in a few
joins on what was written before.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postwise.operators.keys import assign_dense_ids
from postwise.session import written

STEP = 8


def numbered(entries: DataFrame, list_cols: list[str], order_cols: list[str]) -> DataFrame:
    """The entries of lists with two or more, with ``_g`` (place over all lists) and ``_start`` (that of the list's
    first entry). ``list_cols`` and ``order_cols`` together must be unique."""
    placed = assign_dense_ids(entries, [*list_cols, *order_cols], "_g", 0)
    starts = placed.groupBy(*list_cols).agg(F.min("_g").alias("_start"), F.count("*").alias("_n")).where("_n > 1")
    return placed.join(starts.drop("_n"), list_cols)


def walk(entries: DataFrame, item: str, carried: list[str], near: Callable[[Callable, Callable], Column],
         verify: Callable[[DataFrame], DataFrame], smallest: bool,
         within: Callable[[Callable, Callable], Column] | None = None, first: int = 1) -> DataFrame:
    """(item, match): an entry before the item's own, in a list of both, that ``verify`` confirms.

    ``entries`` come from :func:`numbered`, written. ``near(y, x)`` is a cheap necessary condition on the
    ``carried`` columns of an item and of an earlier entry (``y`` and ``x`` give them by name), ``verify`` keeps
    the true ones of distinct pairs (y, x).
    With ``smallest`` lists are read from their beginning and the match is the smallest item of all; else from
    the item's own place backwards, and the match is any; ``within(y, x)`` then says whether entries before x
    may still match. ``first`` entries are read in the first round.
    """
    def y(c):
        return F.col(f"_y_{c}")

    def x(c):
        return F.col(f"_x_{c}")

    other = entries.select(F.col("_g").alias("_at"), F.col(item).alias("_x"), *[F.col(c).alias(f"_x_{c}") for c in carried])
    active = entries.select(F.col(item).alias("_y"), *[F.col(c).alias(f"_y_{c}") for c in carried], "_g", "_start")
    best = checked = None
    low, width = 0, first
    while True:
        # Entries at ranks low to low + width - 1 of those before the item's own place.
        active = active.where(F.col("_g") - F.col("_start") > low)
        if low:
            # Who has a match that the next entry cannot better, or has passed the last entry in question, stops.
            place = F.col("_start") + low if smallest else F.col("_g") - 1 - low
            active = active.withColumn("_at", place).join(other.select("_at", "_x", *[f"_x_{c}" for c in carried]), "_at")
            active = active.join(best, "_y", "left")
            go = F.col("_best").isNull() | (F.col("_x") < F.col("_best")) if smallest else F.col("_best").isNull()
            if within is not None:
                go = go & within(y, x)
            active = active.where(go).select("_y", *[f"_y_{c}" for c in carried], "_g", "_start")
            active = written(active, "active")
        if active.isEmpty():
            break
        last = F.least(F.lit(low + width), F.col("_g") - F.col("_start")) - 1
        rank = F.explode(F.sequence(F.lit(low).cast("long"), last))
        at = F.col("_start") + F.col("_rank") if smallest else F.col("_g") - 1 - F.col("_rank")
        pairs = active.select("*", rank.alias("_rank")).withColumn("_at", at).join(other, "_at").where(near(y, x))
        if best is not None and smallest:
            pairs = pairs.join(best, "_y", "left").where(F.col("_best").isNull() | (F.col("_x") < F.col("_best")))
        pairs = pairs.select("_y", "_x").distinct()
        if checked is not None:
            pairs = pairs.join(checked, ["_y", "_x"], "left_anti")
        pairs = written(pairs, "pairs")
        checked = pairs if checked is None else checked.unionByName(pairs)
        found = verify(pairs).select("_y", F.col("_x").alias("_best"))
        if best is not None:
            found = found.unionByName(best)
        best = written(found.groupBy("_y").agg(F.min("_best").alias("_best")), "best")
        low, width = low + width, width * STEP
    if best is None:
        return entries.select(F.col(item), F.col(item).alias("match")).limit(0)
    return best.select(F.col("_y").alias(item), F.col("_best").alias("match"))
