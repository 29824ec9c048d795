"""Packing along a space-filling curve.

Every document's token ids (then an end id) are counted into a hashed vector,
which is projected to DIMS dimensions; its cell on a grid gives a Hilbert key, so
that similar documents get near keys. Documents are range-sorted by (key, row),
and their ids laid end to end along the curve; a sequence is every SIZE ids, so a
document is cut where a sequence ends, neighbours share sequences, and only the
last sequence needs padding, up to the next power of two.

The texts are read once. The global offset of a document is its range
partition's start (one number per partition, on the driver) plus a running sum
within the partition; equal keys are split by row number, so copies of one text
fill many partitions.

Defined results: a null text counts as empty and is the end id alone; repeated
rows and null ids are rows of their own; no rows give no pieces.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from postwise.llm.common import materialise, with_row_id
from postwise.llm.tokens import RANKS, TOKENIZER, encode_whole, id_type, tokenizer_path

SIZE = 2048
END_ID = 1
HASHED = 256
DIMS = 3
BITS = 16
SEED = 20240613


def projection(hashed: int = HASHED, dims: int = DIMS) -> np.ndarray:
    """A fixed Gaussian matrix from the hashed vector to the few dimensions."""
    return np.random.Generator(np.random.PCG64(SEED)).standard_normal((hashed, dims))


def hashed_vector(ids: np.ndarray, hashed: int = HASHED) -> np.ndarray:
    """Signed counts of the ids, hashed, of length 1."""
    h = (ids.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    h ^= h >> np.uint64(31)
    sign = 1.0 - 2.0 * ((h >> np.uint64(40)) & np.uint64(1)).astype(float)
    v = np.bincount((h % np.uint64(hashed)).astype(np.intp), sign, hashed)
    return v / max(1e-12, float(np.sqrt(v @ v)))


def cells(points: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Grid cells of points: a logistic squeeze to (0, 1), then 2^bits steps."""
    return np.minimum((1 / (1 + np.exp(-1.7 * points)) * (1 << bits)).astype(np.int64), (1 << bits) - 1)


def hilbert(cell: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Hilbert keys of grid cells (n, dims): the Gray-code walk, undone level by level."""
    x = cell.astype(np.int64).T.copy()
    dims = len(x)
    q = 1 << (bits - 1)
    while q > 1:
        p = q - 1
        for i in range(dims):
            flip = (x[i] & q) != 0
            t = np.where(flip, 0, (x[0] ^ x[i]) & p)
            x[0] = np.where(flip, x[0] ^ p, x[0] ^ t)
            if i:
                x[i] ^= t
        q >>= 1
    for i in range(1, dims):
        x[i] ^= x[i - 1]
    t = np.zeros_like(x[0])
    q = 1 << (bits - 1)
    while q > 1:
        t = np.where((x[dims - 1] & q) != 0, t ^ (q - 1), t)
        q >>= 1
    x ^= t
    key = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(dims):
            key = (key << 1) | ((x[i] >> b) & 1)
    return key


def _tokenised(path: str, ranks: str, batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    r = projection()
    dtype = id_type(path)
    for b in batches:
        for at in range(0, len(b), 256):
            part = b.iloc[at:at + 256]
            ids = [np.array([*x, END_ID], dtype) for x in encode_whole(list(part["text"]), path, ranks)]
            points = np.array([hashed_vector(x) for x in ids]) @ r
            yield pd.DataFrame({"rid": part["rid"], "doc_id": part["doc_id"].astype("Int64"), "ids": [x.tobytes() for x in ids],
                                "n": [len(x) for x in ids], "key": hilbert(cells(points))})


def _pieces(size: int, batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        for at in range(0, len(b), 500):
            part = b.iloc[at:at + 500]
            rows = []
            for doc, raw, n, place in zip(part["doc_id"], part["ids"], part["n"], part["place"]):
                ids = np.frombuffer(raw, f"<u{len(raw) // n}").astype("<u4")
                start = 0
                while start < n:
                    offset = (place + start) % size
                    length = min(n - start, size - offset)
                    rows.append((doc, start, length, ids[start:start + length].tobytes(), n,
                                 (place + start) // size, offset))
                    start += length
            yield pd.DataFrame(rows, columns=["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]) \
                .astype({"doc_id": "Int64"})


def pack(docs: DataFrame, size: int = SIZE, tokenizer: str | None = None, ranks: str | None = None) -> DataFrame:
    """Pieces of documents: doc_id, start, length, ids (little-endian 32-bit), doc_tokens,
    sequence_id, offset."""
    path, by_rank = tokenizer or tokenizer_path(TOKENIZER), ranks or tokenizer_path(RANKS)
    spark = docs.sparkSession
    d = with_row_id(docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text"), "rid")
    tokens = materialise(d.mapInPandas(lambda x: _tokenised(path, by_rank, x),
                                       "rid long, doc_id long, ids binary, n long, key long"), "tokens")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = materialise(tokens.select("rid", "key", "n").repartitionByRange(parts, "key", "rid")
                        .withColumn("part", F.spark_partition_id()), "order")
    # One number per range partition; the partitions stand in the order of the keys.
    totals = order.groupBy("part").agg(F.sum("n").alias("n")).orderBy("part").collect()
    start, starts = 0, []
    for t in totals:
        starts.append((t["part"], start))
        start += t["n"]
    begin = F.broadcast(spark.createDataFrame(starts, "part int, begin long"))
    w = Window.partitionBy("part").orderBy("key", "rid")
    place = order.join(begin, "part").select("rid", (F.col("begin") + F.sum("n").over(w) - F.col("n")).alias("place"))
    return tokens.select("rid", "doc_id", "ids", "n").join(place, "rid").select("doc_id", "ids", "n", "place").mapInPandas(
        lambda x: _pieces(size, x), "doc_id long, start long, length long, ids binary, doc_tokens long, "
                                    "sequence_id long, offset long")


def sequences(pieces: DataFrame, size: int = SIZE, pad: int = 0) -> DataFrame:
    """(sequence_id, length, ids): the packed sequences, padded to a power of two (``size`` but for the last)."""
    s = pieces.groupBy("sequence_id").agg(
        F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("p"), F.sum("length").alias("length"))
    full = F.least(F.lit(size), F.pow(F.lit(2), F.ceil(F.log2("length"))).cast("long"))
    hex_ids = F.concat(F.array_join(F.transform("p", lambda x: F.hex(x["ids"])), ""),
                       F.repeat(F.lit(pad.to_bytes(4, "little").hex().upper()), (full - F.col("length")).cast("int")))
    return s.select("sequence_id", "length", F.unhex(hex_ids).alias("ids"))
