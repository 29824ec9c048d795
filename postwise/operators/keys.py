"""Surrogate keys and text-equality matching.

Dense keys: rows are range-partitioned and sorted by the order columns,
tagged with (partition id, row number within the partition) and written to
the shared checkpoint folder; per-partition counts (one small row per
partition) give each partition its offset. No single-partition window, and
the ids are stable because they are computed on materialised data.

Member matching follows the original server's text equality (case- and
accent-insensitive, trailing blanks ignored) through a Spark collation, in
stages: a plain binary ``distinct`` of the values first (hash
aggregate, shrinks the data to distinct spellings), then grouping by a plain
fold (:func:`folded`) that is the matching equality of ASCII texts. Only texts
beyond ASCII, and what matches them, are grouped under the collation, whose
comparisons cost many times those of bytes. Collated columns never leave this module:
the outputs are plain strings, so later joins are ordinary equi-joins.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postwise import rules as R
from postwise.session import written

_ROW_BITS = 33  # monotonically_increasing_id() = partition << 33 | row


def match_key(c) -> Column:
    """The value under the matching collation (for grouping and joins)."""
    c = F.col(c) if isinstance(c, str) else c
    return F.collate(c, R.MATCH_COLLATION)


#: Texts of blanks and visible ASCII characters alone; under the collation they are equal if their folds are.
_PLAIN = "^[ -~]*$"


def folded(c) -> Column:
    """A text's binary key: lower case without trailing blanks if it is plain ASCII, else the text itself."""
    c = F.col(c) if isinstance(c, str) else c
    return F.when(c.rlike(_PLAIN), F.lower(F.rtrim(c))).otherwise(c)


def _is_text(df: DataFrame, c: str) -> bool:
    return df.schema[c].dataType.typeName() == "string"


def _key(df: DataFrame, c: str) -> Column:
    return match_key(df[c]) if _is_text(df, c) else df[c]


def assign_dense_ids(df: DataFrame, order_cols: list[str], id_col: str, start: int = 1,
                     num_partitions: int | None = None) -> DataFrame:
    """K1: ids ``start, start+1, ...`` in ``order_cols`` order (must be unique)."""
    spark = df.sparkSession
    # Without an explicit count AQE may merge adjacent small range
    # partitions (order is kept), so a small dimension uses few tasks.
    ranged = df.repartitionByRange(num_partitions, *order_cols) if num_partitions else df.repartitionByRange(*order_cols)
    ordered = ranged.sortWithinPartitions(*order_cols)
    tagged = written(ordered.select("*", F.spark_partition_id().alias("_pid"),
                                    F.monotonically_increasing_id().alias("_mid")), "ids")
    counts = sorted((r["_pid"], r["n"]) for r in tagged.groupBy("_pid").agg(F.count("*").alias("n")).collect())
    if not counts:
        return tagged.drop("_pid", "_mid").withColumn(id_col, F.lit(None).cast("long"))
    rows, acc = [], 0
    for pid, cnt in counts:
        rows.append((pid, acc))
        acc += cnt
    # One row per partition: a size bound known before the broadcast.
    offsets = F.broadcast(spark.createDataFrame(rows, "_pid int, _off long"))
    row_in_part = F.col("_mid") - F.shiftleft(F.col("_pid").cast("long"), _ROW_BITS)
    dense = F.lit(start).cast("long") + F.col("_off") + row_in_part
    return tagged.join(offsets, "_pid").select(dense.alias(id_col), *[c for c in df.columns])


def distinct_members(src: DataFrame, key_cols: list[str]) -> DataFrame:
    """Distinct members of ``src`` under the matching equality.

    The surviving spelling of a group is its binary minimum (deterministic;
    the original kept whichever row its scan met first).
    """
    variants = src.select(*key_cols).distinct()
    if not any(_is_text(variants, c) for c in key_cols):
        return variants
    text = [c for c in key_cols if _is_text(variants, c)]
    best = _least(variants, [folded(c) if c in text else F.col(c) for c in key_cols], key_cols)
    # Written, as it is read for the odd ones, for the rest and to find the ranges of the ids.
    plain = reduce(lambda a, b: a & b, [F.coalesce(F.col(c).rlike(_PLAIN), F.lit(True)) for c in text])
    best = written(best.withColumn("_plain", plain), "members")
    odd, rest = best.where("NOT _plain").drop("_plain"), best.where("_plain").drop("_plain")
    if odd.isEmpty():
        return rest
    other = odd.select(*[F.col(c).alias(f"_o{i}") for i, c in enumerate(key_cols)])
    met = _match_condition(rest, other, key_cols, other.columns)
    mixed = odd.unionByName(rest.join(other, met, "left_semi"))
    return rest.join(other, met, "left_anti").unionByName(_least(mixed, [_key(mixed, c) for c in key_cols], key_cols))


def _least(variants: DataFrame, groups: list[Column], key_cols: list[str]) -> DataFrame:
    """The binary minimum of each group of spellings."""
    best = variants.groupBy(*[g.alias(f"_k{i}") for i, g in enumerate(groups)]).agg(F.min(F.struct(*key_cols)).alias("_s"))
    return best.select(*[F.col("_s")[c].alias(c) for c in key_cols])


def _match_condition(left: DataFrame, right: DataFrame, key_cols: list[str], right_cols: list[str] | None = None):
    right_cols = right_cols or key_cols
    conds = [_key(left, lc).eqNullSafe(_key(right, rc)) for lc, rc in zip(key_cols, right_cols)]
    return reduce(lambda a, b: a & b, conds)


def new_members(members: DataFrame, existing: DataFrame | None, key_cols: list[str]) -> DataFrame:
    """Members not yet stored (``INSERT IGNORE`` against a unique key)."""
    if existing is None:
        return members
    ex = existing.select(*key_cols)
    return members.join(ex, _match_condition(members, ex, key_cols), "left_anti")


def resolve_members(values: DataFrame, dim: DataFrame, key_cols: list[str], id_col: str,
                    dim_cols: list[str] | None = None) -> DataFrame:
    """Map every distinct spelling in ``values`` to one member id.

    Returns (key_cols..., id_col) keyed by the plain spellings, so the fact
    join is a binary equi-join. Several matching members (possible when the
    match uses fewer columns than the dimension's key) resolve to the
    smallest id, so a row never fans out.
    """
    dim_cols = dim_cols or key_cols
    variants = values.select(*key_cols).distinct()
    d = dim.select(F.col(id_col).alias("_id"), *[F.col(c).alias(f"_d{i}") for i, c in enumerate(dim_cols)])
    cond = _match_condition(variants, d, key_cols, [f"_d{i}" for i in range(len(dim_cols))])
    return variants.join(d, cond, "inner").groupBy(*key_cols).agg(F.min("_id").alias(id_col))


# Largest lookup broadcast to every task once its size is known, in rows and in bytes.
BROADCAST_ROWS = 2_000_000
BROADCAST_BYTES = 64 << 20


def measured(df: DataFrame) -> tuple[int, int]:
    """(rows, bytes) of a written table, in one pass: the texts' own lengths, 8 bytes for any other value and 16 a row."""
    parts = [F.coalesce(F.octet_length(f.name), F.lit(0)) if f.dataType.typeName() in ("string", "binary") else F.lit(8)
             for f in df.schema.fields]
    r = df.agg(F.count("*").alias("n"), F.coalesce(F.sum(reduce(lambda a, b: a + b, parts, F.lit(16))), F.lit(0)).alias("b")).first()
    return r["n"], r["b"]


def broadcast_if_small(df: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES) -> tuple[DataFrame, bool]:
    """Materialise ``df`` in the checkpoint folder, measure it, and mark it for
    broadcast only when it has at most ``max_rows`` rows and ``max_bytes`` bytes;
    otherwise it stays a shuffle-join side. Returns (frame, broadcast?)."""
    m = written(df, "lookup")
    rows, size = measured(m)
    if rows <= max_rows and size <= max_bytes:
        return F.broadcast(m), True
    return m, False
