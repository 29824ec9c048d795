"""Hard negatives by Fagin's threshold algorithm.

Vectors are made integers, floor(SCALE * x), and scores are integer inner products, so all
of it is exact. Candidates are dealt into shards of about SHARD rows, neighbours by label,
anchors into blocks of about BLOCK; a unit of work is one shard and one block, both of
bounded size, and every unit is a group of its own. (The anchors are a stated query set
against all rows, in blocks.)

Within a unit each dimension has its list of the shard's rows, sorted by that component.
An anchor reads the lists in step, from the top where its own component is positive and
from the bottom where it is negative, DEPTH entries and then twice as many each round. Rows
that appear are scored in full (random access). What has not appeared scores at most the
threshold, the sum over all lists of the anchor's component times the last entry read. An
anchor stops when each of its windows (ranges of scores) either holds k scored rows whose
k-th score is strictly above the threshold, so ties are never lost, or has its lower end
above it; at the worst all lists are read to their ends.

Two passes: the k best rows of the anchor's own label (its positives), among the shards
that hold that label; then, for each positive, the k best rows of other labels with a
score in the window that the positive's score gives. The best of all shards are ranked in
windows of Spark, by at most k rows a shard.

Defined results: rows with a null id, label or vector, or with a null or non-finite
component take no part; components are held within +-2^27 as integers (|x| up to 524,288 at
the given scale), so that scores fit 64 bits up to 512 dimensions; of vectors of different
length the shorter one counts as ending in zeros; rows of equal vec_id are rows, and
anchors, of their own, ranked among equal scores by vec_id and then in the order of the
table; a positive without negatives gives no row; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from postwise.llm.common import materialise, with_row_id

SCALE = 256
LIMIT = 1 << 27
SHARD = 8192
BLOCK = 1024
DEPTH = 32
K = 5

#: Rows of a shard or of a block of anchors as little-endian arrays, with the range of their labels.
PACKED = "part long, low long, high long, n int, dims int, rid binary, vec_id binary, label binary, vectors binary, windows binary"


def integer_rows(df: DataFrame) -> DataFrame:
    """rid, vec_id, label, v (array of integers) of the rows of (vec_id, label, embedding) that take part."""
    d = with_row_id(df.select("vec_id", "label", "embedding"), "rid")
    x = F.col("embedding")
    finite = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
    held = F.transform(x, lambda c: F.floor(F.greatest(F.least(c.cast("double") * SCALE, F.lit(float(LIMIT))),
                                                       F.lit(-float(LIMIT)))).cast("int"))
    return d.filter(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & x.isNotNull() & finite).select(
        "rid", F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), held.alias("v"))


def _pack(part: pd.DataFrame, number: int, windows: bool) -> pd.DataFrame:
    dims = max(map(len, part["v"]))
    m = np.zeros((len(part), dims), "<i4")
    for k, v in enumerate(part["v"]):
        m[k, :len(v)] = v
    w = b""
    if windows:
        w = np.array([list(x) + [-1] * (K - len(x)) for x in part["windows"]], "<i8").tobytes()
    return pd.DataFrame({"part": [number], "low": [part["label"].min()], "high": [part["label"].max()], "n": [len(part)],
                         "dims": [dims], "rid": [part["rid"].to_numpy("<i8").tobytes()],
                         "vec_id": [part["vec_id"].to_numpy("<i8").tobytes()],
                         "label": [part["label"].to_numpy("<i8").tobytes()], "vectors": [m.tobytes()], "windows": [w]})


def packed(rows: DataFrame, size: int, name: str) -> DataFrame:
    """The rows dealt by label into parts of at most ``size``, a row each, numbered apart."""
    windows = "windows" in rows.columns
    parts = max(1, -(-rows.count() // size))

    def run(batches):
        from pyspark import TaskContext
        number, held, n = TaskContext.get().partitionId() << 32, [], 0
        for b in batches:
            while len(b):
                held.append(b.iloc[:size - n])
                b = b.iloc[size - n:]
                n += len(held[-1])
                if n == size:
                    yield _pack(pd.concat(held, ignore_index=True), number, windows)
                    number, held, n = number + 1, [], 0
        if n:
            yield _pack(pd.concat(held, ignore_index=True), number, windows)

    return materialise(rows.repartitionByRange(parts, "label", "rid").mapInPandas(run, PACKED), name)


class Lists:
    """A shard's rows and, per dimension, its rows sorted by that component, smallest first."""

    def __init__(self, vectors: np.ndarray):
        self.exact = vectors.astype(np.int64)
        self.most = int(np.abs(self.exact).max()) if self.exact.size else 0
        # Whole numbers below 2^53 are exact in floating point, whose products are faster.
        self.floats = vectors.astype(np.float64) if self.most * self.most * vectors.shape[1] < 1 << 53 else None
        self.order = np.ascontiguousarray(np.argsort(vectors, axis=0, kind="stable").T.astype(np.int32))
        self.sorted = np.take_along_axis(self.exact.T, self.order, axis=1)

    def scores(self, rows: np.ndarray, anchor: np.ndarray) -> np.ndarray:
        if self.floats is not None and int(np.abs(anchor).max(initial=0)) * self.most * len(anchor) < 1 << 53:
            return (self.floats[rows] @ anchor.astype(np.float64)).astype(np.int64)
        return self.exact[rows] @ anchor

    def search(self, anchor: np.ndarray, eligible: np.ndarray, windows: list[tuple[int | None, int | None]],
               k: int) -> tuple[list[np.ndarray], int, int]:
        """Per window (low, high; None: open), the eligible rows with a score in it that may be among its k best,
        as (row, score) sorted by score; with the depth reached and the number of rows scored."""
        n = len(self.exact)
        use = np.flatnonzero(anchor)
        if not len(use):
            use = np.arange(min(1, len(anchor)))
        a = anchor[use]
        up, down = use[a >= 0], use[a < 0]
        seen = np.zeros(n, bool)
        rows, values = np.zeros(0, np.int64), np.zeros(0, np.int64)
        total, scored, depth, step = int(np.count_nonzero(eligible)), 0, 0, DEPTH
        while depth < n:
            to = min(n, depth + step)
            met = np.zeros(n, bool)
            met[self.order[up, n - to:n - depth]] = True
            met[self.order[down, depth:to]] = True
            met &= ~seen
            seen |= met
            new = np.flatnonzero(met & eligible)
            scored += len(new)
            if len(new):
                rows = np.concatenate([rows, new])
                values = np.concatenate([values, self.scores(new, anchor)])
            depth, step = to, step * 2
            if depth == n or len(values) == total:
                break
            threshold = int(self.sorted[up, n - depth] @ anchor[up]) + int(self.sorted[down, depth - 1] @ anchor[down])
            if all(self._done(values, low, high, threshold, k) for low, high in windows):
                break
        if not len(anchor):  # vectors without components: every score is 0
            rows = np.flatnonzero(eligible)
            values = np.zeros(len(rows), np.int64)
        out = []
        for low, high in windows:
            inside = np.ones(len(values), bool)
            if low is not None:
                inside &= values >= low
            if high is not None:
                inside &= values <= high
            out.append(self._best(rows[inside], values[inside], k))
        return out, depth, scored

    @staticmethod
    def _done(values: np.ndarray, low: int | None, high: int | None, threshold: int, k: int) -> bool:
        if low is not None and threshold < low:
            return True
        inside = values if low is None and high is None else values[(values >= low) & (values <= high)]
        return len(inside) >= k and threshold < int(np.partition(inside, len(inside) - k)[len(inside) - k])

    @staticmethod
    def _best(rows: np.ndarray, values: np.ndarray, k: int) -> np.ndarray:
        """(row, score) of all rows that score no less than the k-th."""
        if len(values) > k:
            keep = values >= np.partition(values, len(values) - k)[len(values) - k]
            rows, values = rows[keep], values[keep]
        return np.stack([rows, values], axis=1)


def _array(row: pd.Series, name: str) -> np.ndarray:
    return np.frombuffer(row[name], "<i8")


def _matrix(row: pd.Series, dims: int) -> np.ndarray:
    m = np.zeros((row["n"], dims), np.int32)
    m[:, :row["dims"]] = np.frombuffer(row["vectors"], "<i4").reshape(row["n"], row["dims"])
    return m


def floor_of_window(positive: int, low: int, base: int) -> int:
    """The least score n with low * positive <= base * n."""
    return -((-low * positive) // base)


def _unit(k: int, low: int, base: int, group: pd.DataFrame) -> pd.DataFrame:
    """One shard against one block of anchors: of an anchor without windows, the best rows of its own label; of one
    with windows, those of other labels in each window."""
    block, shard = group[group["side"] == 0].iloc[0], group[group["side"] == 1].iloc[0]
    dims = max(int(block["dims"]), int(shard["dims"]))
    lists, anchors = Lists(_matrix(shard, dims)), _matrix(block, dims).astype(np.int64)
    rid, vec_id, label = (_array(shard, c) for c in ("rid", "vec_id", "label"))
    windows = _array(block, "windows").reshape(-1, K) if len(block["windows"]) else None
    out = []
    for at, (arid, own) in enumerate(zip(_array(block, "rid"), _array(block, "label"))):
        if windows is None:
            ranges = [(None, None)]
            eligible = (label == own) & (rid != arid)
        else:
            # The window of a positive with a score below 0 is empty.
            numbers = np.flatnonzero(windows[at] >= 0)
            ranges = [(floor_of_window(int(p), low, base), int(p)) for p in windows[at][numbers]]
            eligible = label != own
        if not eligible.any() or not ranges:
            continue
        found, _, _ = lists.search(anchors[at], eligible, ranges, k)
        for window, best in zip([0] if windows is None else numbers, found):
            if len(best):
                # Of equal scores the smaller ids: no more than k rows leave the unit.
                best = best[np.lexsort([rid[best[:, 0]], vec_id[best[:, 0]], -best[:, 1]])][:k]
                rows = best[:, 0]
                out.append(np.stack([np.full(len(rows), arid), np.full(len(rows), window), rid[rows], vec_id[rows], best[:, 1]], axis=1))
    table = np.concatenate(out) if out else np.zeros((0, 5), np.int64)
    return pd.DataFrame(table, columns=["anchor", "window", "rid", "vec_id", "score"])


def _against(shards: DataFrame, blocks: DataFrame, wanted: Column, k: int, low: int, base: int) -> DataFrame:
    """anchor (rid), window, rid, vec_id, score of the best rows of every shard for every block; ``wanted`` says which
    blocks (elements of the array _blocks) a shard meets."""
    ranges = blocks.select("part", "low", "high").orderBy("part").collect()  # a row per BLOCK anchors
    listed = F.array(*[F.struct(F.lit(r["part"]).alias("part"), F.lit(r["low"]).alias("low"), F.lit(r["high"]).alias("high"))
                       for r in ranges]) if ranges else F.expr("CAST(array() AS array<struct<part:bigint,low:bigint,high:bigint>>)")
    pairs = shards.withColumn("_block", F.explode(F.filter(listed, wanted))).withColumn("block", F.col("_block.part")) \
        .withColumn("shard", F.col("part")).drop("_block")
    met = materialise(pairs.select("block", "shard"), "pairs")
    columns = [F.col(c) for c in ("n", "dims", "rid", "vec_id", "label", "vectors", "windows")]
    left = met.join(blocks.withColumnRenamed("part", "block"), "block").select("block", "shard", F.lit(0).alias("side"), *columns)
    both = left.unionByName(pairs.select("block", "shard", F.lit(1).alias("side"), *columns))
    return both.groupBy("block", "shard").applyInPandas(
        lambda g: _unit(k, low, base, g), "anchor long, window long, rid long, vec_id long, score long")


def _ranked(found: DataFrame, k: int) -> DataFrame:
    w = Window.partitionBy("anchor", "window").orderBy(F.desc("score"), "vec_id", "rid")
    return found.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def hard_negatives(rows: DataFrame, anchors: Column, k: int = K, low: int = 80, base: int = 100) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``rows`` are those of :func:`integer_rows`; ``anchors`` says which of them are anchors. A negative's score
    is at least low / base of its positive's, and not above it. k is at most K.
    """
    rows = materialise(rows, "vectors")
    chosen = rows.filter(anchors)
    shards = packed(rows, SHARD, "shards")
    # A shard meets the blocks whose labels its own may hold; then those that hold another label than its only one.
    same = _against(shards, packed(chosen, BLOCK, "anchors"),
                    lambda b: (b["low"] <= F.col("high")) & (b["high"] >= F.col("low")), k, low, base)
    positives = materialise(_ranked(same, k), "positives")
    scores = positives.groupBy("anchor").agg(F.transform(F.array_sort(F.collect_list(F.struct("rank", "score"))),
                                                         lambda x: x["score"]).alias("windows"))
    with_windows = chosen.join(scores.withColumnRenamed("anchor", "rid"), "rid")
    other = _against(shards, packed(with_windows, BLOCK, "windows"),
                     lambda b: ~((b["low"] == b["high"]) & (F.col("low") == F.col("high")) & (b["low"] == F.col("low"))),
                     k, low, base)
    negatives = _ranked(other, k)
    p = positives.select("anchor", (F.col("rank") - 1).cast("long").alias("window"), F.col("vec_id").alias("positive_id"),
                         F.col("score").alias("positive_score"))
    ids = chosen.select(F.col("rid").alias("anchor"), F.col("vec_id").alias("anchor_id"))
    return negatives.select("anchor", "window", "rank", F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score")) \
        .join(p, ["anchor", "window"]).join(ids, "anchor") \
        .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
