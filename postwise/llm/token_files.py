"""Token-id files: Simple-8b, word-aligned coding of ids in blocks.

A 64-bit word holds a 4-bit selector and 60 bits of slots; the selector says how many
ids the word holds and how wide a slot is (COUNTS, WIDTHS; width 0: a run of zeros). A
slot of ones alone is an escape: the id stands in the block's list of escapes, in order.
Each word takes the selector with the fewest bits an id, escapes counted with 32 bits,
so one rare id among small ones does not widen the whole word.

A frame holds whole documents, FRAME ids or a little more (a longer document is a frame
of its own size). Its ids are cut into blocks of BLOCK ids; no word crosses a block, and
the frame's tables say where each block's words and escapes begin, so that any block is
decoded by itself and all words of one selector at once. Bytes of a frame, little-endian:

    magic "S8F1", u32 documents, u64 ids, u32 blocks
    u8 has_id[documents], i64 doc_id[documents], u64 length[documents]
    u64 word_offset[blocks + 1], u64 escape_offset[blocks + 1]
    u64 words[], u32 escapes[]

A file set is a folder: ``frames`` has one file per shard (a range of ids of documents, in
ascending order), whose rows are the frames with their place in the shard, written and
committed by Spark on whatever store it writes to, so a lost executor's file is written
anew; ``shards`` has, per shard, the number of ids before it.

Defined results: a null text counts as empty and is the end id alone; null ids of
documents come first; rows of equal doc_id stand in the order of their rows and are
documents of their own; no rows give no frames; other columns are ignored.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postwise.llm.common import with_row_id
from postwise.llm.tokens import RANKS, TOKENIZER, encode_arrays, tokenizer_path

END_ID = 0
BLOCK = 4096
FRAME = 65_536
MAGIC = b"S8F1"
#: Ids of a word and bits of a slot, by selector.
COUNTS = np.array([240, 120, 60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1])
WIDTHS = np.array([0, 0, 1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60])
ESCAPE_BITS = 32
#: Ids encoded at a time, so that a very long document needs no more memory for its tables.
AT_ONCE = 16 * BLOCK


def _costs() -> tuple[np.ndarray, list[np.ndarray]]:
    """All costs of a word, ascending: bits an id (in 1/64) above the selector's own number; and the places among
    them of each selector's costs, by the number of its escapes."""
    by_selector = []
    for k, (count, width) in enumerate(zip(COUNTS.tolist(), WIDTHS.tolist())):
        escapes = np.arange(count + 1 if width else 1)  # a run of zeros has none
        by_selector.append((64 + ESCAPE_BITS * escapes) * 64 // count << 4 | k)
    never = 1 << 32
    costs = np.unique(np.concatenate([*by_selector, [never]]))
    places = [np.full(256, len(costs) - 1, np.uint16) for _ in by_selector]
    for place, cost in zip(places, by_selector):
        place[:len(cost)] = np.searchsorted(costs, cost)
    return costs, places


_COSTS, _COST_OF = _costs()


def _window_sums(x: np.ndarray, count: int) -> np.ndarray:
    """Sums of every ``count`` (255 at most) neighbours in an array of zeros and ones of 8 bits, by doubling."""
    out, part, size, done = None, x, 1, 0
    while True:
        if count & 1:
            out = part if out is None else out[:len(part) - done] + part[done:]
            done += size
        count >>= 1
        if not count:
            return out
        part = part[:-size] + part[size:]
        size *= 2


def _encode_blocks(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words, escapes, and the number of each per block, of up to AT_ONCE ids."""
    n = len(ids)
    blocks = -(-n // BLOCK)
    pad = int(COUNTS[0])
    v = np.zeros((blocks, BLOCK + pad), np.uint32)
    full = np.zeros(blocks * BLOCK, np.uint32)
    full[:n] = ids
    v[:, :BLOCK] = full.reshape(blocks, BLOCK)
    best = np.full((blocks, BLOCK), len(_COSTS) - 1, np.uint16)
    flat = v.reshape(-1)
    sums = np.zeros(len(flat), np.uint8)
    for k, (count, width) in enumerate(zip(COUNTS.tolist(), WIDTHS.tolist())):
        if width < 32:
            wide = flat >= np.uint32((1 << width) - 1 or 1)
            if wide.size - np.count_nonzero(wide) - pad * blocks < count // 3:
                continue  # its words would be mostly escapes
            # A window that begins in a block ends in the zeros behind it.
            sums[:len(flat) - count + 1] = _window_sums(wide.view(np.uint8), count)
            np.minimum(best, _COST_OF[k].take(sums.reshape(v.shape)[:, :BLOCK]), out=best)
        else:
            np.minimum(best, _COST_OF[k][0], out=best)
    choice = (_COSTS[best] & 15).astype(np.uint8)
    words_at, words_in = [], np.zeros(blocks, np.int64)
    step = COUNTS[choice]
    for b in range(blocks):
        at, end, jumps = 0, min(BLOCK, n - b * BLOCK), step[b].tolist()
        before = len(words_at)
        base = b * (BLOCK + pad)
        while at < end:
            words_at.append(base + at)
            at += jumps[at]
        words_in[b] = len(words_at) - before
    at = np.array(words_at, np.int64)
    chosen = choice[at // (BLOCK + pad), at % (BLOCK + pad)]
    words = chosen.astype(np.uint64) << np.uint64(60)
    escaped = np.zeros(len(flat), bool)
    for k in np.unique(chosen):
        width = int(WIDTHS[k])
        if not width:
            continue
        which = np.flatnonzero(chosen == k)
        place = at[which][:, None] + np.arange(COUNTS[k])
        # Beyond the block's end all slots are empty, also where the next block's ids would stand.
        slot = flat[place].astype(np.uint64)
        out = slot >= np.uint64((1 << width) - 1)
        slot[out] = np.uint64((1 << width) - 1)
        escaped[place[out]] = True
        words[which] |= (slot << (np.arange(COUNTS[k], dtype=np.uint64) * np.uint64(width))).sum(axis=1, dtype=np.uint64)
    escapes_in = escaped.reshape(blocks, -1).sum(axis=1)
    return words, flat[escaped], words_in, escapes_in


def encode_frame(doc_ids: list[int | None], ids: list[np.ndarray]) -> bytes:
    """A frame of documents' ids (numbers from 0 to 2^32 - 1)."""
    lengths = np.array([len(x) for x in ids], "<u8")
    whole = np.concatenate([np.asarray(x, np.uint32) for x in ids]) if ids else np.zeros(0, np.uint32)
    parts = [_encode_blocks(whole[at:at + AT_ONCE]) for at in range(0, len(whole), AT_ONCE)]
    words = [p[0].astype("<u8").tobytes() for p in parts]
    escapes = [p[1].tobytes() for p in parts]
    offsets = [np.concatenate([[0], np.cumsum(np.concatenate([p[k] for p in parts] or [np.zeros(0, np.int64)]))]).astype("<u8")
               for k in (2, 3)]
    known = np.array([d is not None for d in doc_ids], "u1")
    head = MAGIC + struct.pack("<IQI", len(ids), len(whole), len(offsets[0]) - 1)
    return b"".join([head, known.tobytes(), np.array([d or 0 for d in doc_ids], "<i8").tobytes(), lengths.tobytes(),
                     offsets[0].tobytes(), offsets[1].tobytes(), *words, *escapes])


class Frame:
    """The tables of an encoded frame; blocks are decoded when asked for."""

    def __init__(self, data: bytes):
        if data[:4] != MAGIC:
            raise ValueError("not a frame of token ids")
        n_docs, self.n_ids, self.blocks = struct.unpack_from("<IQI", data, 4)
        at = 4 + struct.calcsize("<IQI")

        def table(dtype: str, n: int) -> np.ndarray:
            nonlocal at
            out = np.frombuffer(data, dtype, n, at)
            at += out.nbytes
            return out

        known = table("u1", n_docs)
        self.doc_ids = [int(d) if k else None for k, d in zip(known, table("<i8", n_docs))]
        self.lengths = table("<u8", n_docs).astype(np.int64)
        self.word_at = table("<u8", self.blocks + 1).astype(np.int64)
        self.escape_at = table("<u8", self.blocks + 1).astype(np.int64)
        self.words = table("<u8", int(self.word_at[-1]))
        self.escapes = table("<u4", int(self.escape_at[-1]))

    def decode(self, first: int = 0, last: int | None = None) -> np.ndarray:
        """The ids of blocks first to last - 1 (all of them: the whole frame)."""
        last = self.blocks if last is None else last
        words = self.words[self.word_at[first]:self.word_at[last]]
        escapes = self.escapes[self.escape_at[first]:self.escape_at[last]]
        selector = (words >> np.uint64(60)).astype(np.intp)
        end = np.cumsum(COUNTS[selector])
        start = end - COUNTS[selector]
        out = np.zeros(int(end[-1]) if len(end) else 0, np.uint32)
        escaped = np.zeros(len(out), bool)
        for k in np.unique(selector):
            width = int(WIDTHS[k])
            if not width:
                continue
            which = np.flatnonzero(selector == k)
            ones = np.uint64((1 << width) - 1)
            slot = (words[which][:, None] >> (np.arange(COUNTS[k], dtype=np.uint64) * np.uint64(width))) & ones
            place = start[which][:, None] + np.arange(COUNTS[k])
            out[place] = slot.astype(np.uint32)
            escaped[place[slot == ones]] = True
        out[escaped] = escapes
        # A block's last word may have empty slots behind its ids.
        per_block = self.word_at[first:last] - self.word_at[first]
        begin = start[per_block] if len(start) else np.zeros(0, np.int64)
        lengths = np.minimum(self.n_ids - np.arange(first, last) * BLOCK, BLOCK)
        if len(out) == lengths.sum():
            return out
        return np.concatenate([out[b:b + n] for b, n in zip(begin, lengths)])

    def documents(self, at_once: int = 256) -> Iterator[tuple[int | None, np.ndarray]]:
        """(doc_id, ids) of every document, decoding some blocks at a time."""
        rest, block, done = np.zeros(0, np.uint32), 0, 0
        for doc, n in zip(self.doc_ids, self.lengths):
            have = [rest]
            size = len(rest)
            while size < n:
                more = self.decode(block, min(block + at_once, self.blocks))
                block = min(block + at_once, self.blocks)
                have.append(more)
                size += len(more)
            joined = np.concatenate(have) if len(have) > 1 else rest
            yield doc, joined[:n]
            rest = joined[n:]


def _frames(path: str, ranks: str, end_id: int, batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    shard = TaskContext.get().partitionId()
    docs, ids, held, start, frame = [], [], 0, 0, 0

    def put() -> pd.DataFrame:
        return pd.DataFrame({"shard": [shard], "frame": [frame], "start": [start], "n_ids": [held],
                             "n_docs": [len(docs)], "data": [encode_frame(docs, ids)]})

    for b in batches:
        for at in range(0, len(b), 256):
            part = b.iloc[at:at + 256]
            encoded = encode_arrays(list(part["text"]), path, ranks)
            for doc, x in zip(part["doc_id"], encoded):
                docs.append(None if pd.isna(doc) else int(doc))
                ids.append(np.append(x, np.uint32(end_id)))
                held += len(x) + 1
                if held >= FRAME:
                    yield put()
                    start, frame = start + held, frame + 1
                    docs, ids, held = [], [], 0
    if docs:
        yield put()


def write_ids(docs: DataFrame, path: str, tokenizer: str | None = None, ranks: str | None = None,
              end_id: int = END_ID) -> None:
    """Encode ``text`` of (doc_id, text) and write the ids, an end id behind each document, to a new folder."""
    spark = docs.sparkSession
    vocabulary, by_rank = tokenizer or tokenizer_path(TOKENIZER), ranks or tokenizer_path(RANKS)
    d = with_row_id(docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text"), "rid")
    d = d.repartitionByRange(F.col("doc_id").asc_nulls_first(), "rid").sortWithinPartitions(
        F.col("doc_id").asc_nulls_first(), "rid")
    d.select("doc_id", "text").mapInPandas(
        lambda x: _frames(vocabulary, by_rank, end_id, x),
        "shard int, frame long, start long, n_ids long, n_docs long, data binary"
    ).write.option("compression", "none").parquet(f"{path}/frames")
    # One number per shard, that is, per range of the sort.
    totals = spark.read.parquet(f"{path}/frames").groupBy("shard").agg(F.sum("n_ids").alias("n")).orderBy("shard").collect()
    begin, rows = 0, []
    for t in totals:
        rows.append((t["shard"], begin, t["n"]))
        begin += t["n"]
    spark.createDataFrame(rows, "shard int, begin long, n_ids long").coalesce(1).write.parquet(f"{path}/shards")


def _documents(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        for start, data in zip(b["start"], b["data"]):
            rows, held = [], 0
            for doc, ids in Frame(data).documents():
                rows.append((doc, start, len(ids), ids.astype("<u4").tobytes()))
                start += len(ids)
                held += len(ids)
                if held >= FRAME:
                    yield _table(rows)
                    rows, held = [], 0
            if rows:
                yield _table(rows)


def _table(rows: list[tuple]) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=["doc_id", "start", "n_tokens", "ids"]).astype({"doc_id": "Int64"})


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """The documents of a file set: doc_id, start (ids of all documents before it), n_tokens, ids
    (little-endian 32-bit)."""
    frames = spark.read.parquet(f"{path}/frames").select("shard", "start", "data")
    shards = F.broadcast(spark.read.parquet(f"{path}/shards").select("shard", "begin"))  # a row per shard
    d = frames.join(shards, "shard").select((F.col("begin") + F.col("start")).alias("start"), "data")
    return d.mapInPandas(_documents, "doc_id long, start long, n_tokens long, ids binary")
