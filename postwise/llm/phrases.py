"""Collocations: counts of word n-grams from bidirectional FM-indexes.

Texts are cut into pieces and words; a shard is about SHARD_BYTES of a task's texts, its words
numbered by (language, word), with the number 0 between pieces. Its index is the
Burrows-Wheeler transform of those numbers and that of their reversal. Suffixes are sorted
by their first ``max_words`` words only, which is all that intervals of up to so many words
need. The n-grams of one length are all intervals of the index at that depth; one step of
backward search extends all of them to the left at once, and each interval of the index
has its twin in the reversed one, found from the symbols before it, which says what follows
on the right. So a shard gives each of its n-grams once, with its count and the number of
times that another word stands before and behind it in its piece; the numbers of all
shards are summed.

Nothing is pruned by a shard's own counts. A longer n-gram can only be frequent if what is
left without its first word and without its last word are, so the next length is enumerated
where a table of bits (a fixed 2^BITS, 4 MB, whatever the corpus) holds both; bits that
collide only let more rows through, and sums decide.

Defined results: a null text counts as empty, a null language as ``und``; repeated rows
count again; no rows give no phrases; other columns are ignored. Counts are exact.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from postwise.llm.common import materialise, rows_at_a_time

MAX_WORDS = 3
MIN_COUNT = 10
#: A candidate goes if a longer one around it has at least this share (in hundredths) of its occurrences.
SHARE = 50
TOP = 2000
NO_LANG = "und"
#: Bytes of a shard's text; its index is built within one task's memory (about 20 times as much).
SHARD_BYTES = 4_000_000
BITS = 25
#: Ends of pieces: . , ; : ! ? and U+000A to U+000D; blanks: space and U+0009; A-Z become a-z.
ENDS = b".,;:!?\n\x0b\x0c\r"
#: Stands for an end of a piece in cleaned bytes; no UTF-8 text holds it.
END = b"\xff"
CLEAN = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ\t" + ENDS, b"abcdefghijklmnopqrstuvwxyz " + END * len(ENDS))
#: Rows sent to Spark at a time.
ROWS = 100_000

#: A row group of the index holds a shard or a few, whatever the number of a task's shards, as its writer and its readers hold a whole one.
ROW_GROUPS = {"parquet.block.size": str(8 << 20), "parquet.page.size.row.check.min": "1"}
INDEX = "langs array<string>, lang_words array<long>, words binary, word_lang binary, bwt binary, reversed binary"
NGRAMS = "lang string, phrase string, n long, opens long, closes long"


def order(t: np.ndarray, depth: int) -> np.ndarray:
    """Positions of t sorted by the ``depth`` symbols that begin there (zeros beyond its end)."""
    bits = max(1, int(t.max()).bit_length()) if len(t) else 1
    padded = np.concatenate([t, np.zeros(depth, t.dtype)]).astype(np.int64)
    if bits * depth <= 63:
        key = padded[:len(t)].copy()
        for k in range(1, depth):
            key <<= bits
            key |= padded[k:k + len(t)]
        return np.argsort(key)
    return np.lexsort([padded[k:k + len(t)] for k in range(depth - 1, -1, -1)])


def tokens(text: bytes) -> pa.DictionaryArray:
    """The words of cleaned bytes, each end of a piece as a word of its own."""
    raw = np.frombuffer(b" " + text.replace(END, b" " + END + b" ") + b" ", np.uint8)
    inside = raw != 32
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    offsets = np.concatenate([[0], np.cumsum(edges[1::2] - edges[::2])]).astype(np.int32)
    data = raw[inside]
    return pa.Array.from_buffers(pa.binary(), len(offsets) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(data)]).dictionary_encode()


def build_row(texts: dict[str, list[bytes]], depth: int) -> dict:
    """The index of some cleaned texts by language."""
    words, lang_of, lang_words, ids = [], [], [], [np.zeros(1, np.uint32)]
    for lang, some in enumerate(texts.values()):
        found = tokens(END.join(some) + END)
        names = found.dictionary.to_pylist()
        # Ends of pieces are 0; the words of this language follow those of the ones before.
        number = np.zeros(len(names), np.uint32)
        mine = np.array([w != END for w in names], bool)
        number[mine] = np.arange(1, mine.sum() + 1) + len(words)
        t = number[found.indices.to_numpy(zero_copy_only=False)]
        words += [w for w in names if w != END]
        lang_of.append(np.full(int(mine.sum()), lang, np.uint32))
        lang_words.append(int(np.count_nonzero(t)))
        ids.append(t)
    t = np.concatenate(ids)
    t = t[np.concatenate([[True], (t[1:] != 0) | (t[:-1] != 0)])]
    back = t[::-1]
    return {"langs": list(texts), "lang_words": lang_words, "words": b"\n".join(words), "word_lang": np.concatenate(lang_of).tobytes(),
            "bwt": t[order(t, depth) - 1].tobytes(), "reversed": back[order(back, depth) - 1].tobytes()}


def _cuts(text: bytes, size: int) -> Iterator[bytes]:
    """A long text in parts of about a shard's size, cut where a piece ends (a longer piece stays whole)."""
    while len(text) > size:
        at = text.rfind(END, 0, size)
        at = text.find(END, size) if at < 0 else at
        if at < 0:
            break
        yield text[:at]
        text = text[at + 1:]
    yield text


def _shards(depth: int, size: int, batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    held: dict[str, list[bytes]] = {}
    n = 0
    for b in batches:
        for lang, text in zip(b["lang"], b["text"]):
            if not text:
                continue
            for part in _cuts(text.encode().translate(CLEAN), size):
                if n and n + len(part) > size:
                    yield pd.DataFrame([build_row(held, depth)])
                    held, n = {}, 0
                held.setdefault(lang, []).append(part)
                n += len(part)
    if held:
        yield pd.DataFrame([build_row(held, depth)])


def build_index(docs: DataFrame, max_words: int = MAX_WORDS, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """The indexes of (lang, text), a row per shard, written to the shared folder."""
    d = docs.select(F.coalesce("lang", F.lit(NO_LANG)).alias("lang"), "text")
    with rows_at_a_time(docs.sparkSession, 1000):
        return materialise(d.mapInPandas(lambda x: _shards(max_words, shard_bytes, x), INDEX), "phrases", **ROW_GROUPS)


class Intervals:
    """All n-grams of one length: where their intervals begin in both indexes, how long they are,
    their first word, and the numbers of the n-grams without the first and without the last word."""

    def __init__(self, low, size, low_back, first, rest, front, label):
        self.low, self.size, self.low_back = low, size, low_back
        self.first, self.rest, self.front, self.label = first, rest, front, label


class Shard:
    """A shard's bidirectional index."""

    def __init__(self, row: dict):
        self.langs = row["langs"]
        self.words = row["words"].split(b"\n") if row["word_lang"] else []
        self.word_lang = np.frombuffer(row["word_lang"], np.uint32)
        self.bwt = np.frombuffer(row["bwt"], np.uint32)
        counts = np.bincount(self.bwt, minlength=len(self.words) + 1)
        self.begin = np.concatenate([[0], np.cumsum(counts)])
        self.symbol = np.repeat(np.arange(len(counts), dtype=np.uint32), counts)
        #: How many ends of pieces stand before the rows up to each one, in both indexes.
        self.opens = self._ends(self.bwt)
        self.closes = self._ends(np.frombuffer(row["reversed"], np.uint32))

    @staticmethod
    def _ends(symbols: np.ndarray) -> np.ndarray:
        return np.concatenate([[0], np.cumsum(symbols == 0, dtype=np.int32)])

    @functools.cached_property
    def source(self) -> np.ndarray:
        """The row whose backward step leads to each row."""
        return np.argsort(self.bwt, kind="stable").astype(np.int32)

    def single(self) -> Intervals:
        """The intervals of single words: number w - 1 for word w."""
        low = self.begin[1:-1].astype(np.int32)
        n = np.arange(len(self.words), dtype=np.int32)
        return Intervals(low, np.diff(self.begin)[1:].astype(np.int32), low, n + 1, n, n, self.symbol.astype(np.int32) - 1)

    def extend(self, p: Intervals) -> Intervals:
        """All n-grams one word longer: each interval's step back over every word before it."""
        rest = p.label[self.source]
        valid = (self.symbol != 0) & (rest >= 0)
        new = valid.copy()
        new[1:] &= (rest[1:] != rest[:-1]) | (self.symbol[1:] != self.symbol[:-1])
        low = np.flatnonzero(new).astype(np.int32)
        label = np.cumsum(new, dtype=np.int32)
        label -= 1
        label[~valid] = -1
        size = np.bincount(label[valid], minlength=len(low)).astype(np.int32)
        first, rest = self.symbol[low].astype(np.int32), rest[low]
        del valid, new
        # In the reversed index an interval's rows are sorted by the word before it, ends of pieces first.
        by = np.lexsort([first, rest]).astype(np.int32)
        ordered = rest[by]
        opens = np.ones(len(by), bool)
        opens[1:] = ordered[1:] != ordered[:-1]
        del ordered
        upto = np.cumsum(size[by], dtype=np.int32)
        upto -= size[by]
        group = np.cumsum(opens, dtype=np.int32)
        group -= 1
        upto -= upto[opens][group]
        del opens, group
        back = np.empty(len(by), np.int32)
        back[by] = upto
        del by, upto
        back += p.low_back[rest]
        back += (self.opens[p.low + p.size] - self.opens[p.low])[rest]
        return Intervals(low, size, back, first, rest, p.label[low], label)

    def count(self, lang: str, phrase: str) -> int:
        """Occurrences of a phrase (up to the index's depth), by backward search."""
        if lang not in self.langs:
            return 0
        at = self.langs.index(lang)
        known = {w: k + 1 for k, w in enumerate(self.words) if self.word_lang[k] == at}
        low, high = 0, len(self.bwt)
        for w in reversed(phrase.encode().split(b" ")):
            c = known.get(w)
            if c is None:
                return 0
            ranks = [int(np.count_nonzero(self.bwt[:x] == c)) for x in (low, high)]
            low, high = int(self.begin[c]) + ranks[0], int(self.begin[c]) + ranks[1]
        return high - low

    def hashes(self) -> np.ndarray:
        """:func:`phrase_hash` of the words."""
        import xxhash
        seeds = [xxhash.xxh64_intdigest(x.encode(), 42) for x in self.langs]
        return np.fromiter((xxhash.xxh64_intdigest(w, seeds[k]) for k, w in zip(self.word_lang.tolist(), self.words)),
                           np.uint64, len(self.words))


def longer_hash(word: np.ndarray, rest: np.ndarray) -> np.ndarray:
    """Hashes of n-grams from those of the first word and of the words behind it."""
    return word ^ ((rest << np.uint64(23)) | (rest >> np.uint64(41)))


def phrase_hash(lang: str = "lang", phrase: str = "phrase") -> Column:
    """The same hash in Spark."""
    def turned(x):
        return F.shiftleft(x, 23).bitwiseOR(F.shiftrightunsigned(x, 41))
    words = F.reverse(F.split(phrase, " "))
    return F.aggregate(words, F.lit(0).cast("long"), lambda acc, w: F.xxhash64(F.col(lang), w).bitwiseXOR(turned(acc)))


def _ngrams(length: int, bits: np.ndarray | None, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The n-grams of ``length`` words whose two parts one word shorter have their bits set."""
    for b in batches:
        for k in range(b.num_rows):
            yield from _shard_ngrams(Shard(b.slice(k, 1).to_pylist()[0]), length, bits)
            pa.default_memory_pool().release_unused()


def _shard_ngrams(shard: Shard, length: int, bits: np.ndarray | None) -> Iterator[pa.RecordBatch]:
    """The n-grams are held as numbers; their phrases are written out for ROWS of them at a time."""
    names = pa.array(shard.langs, pa.string())
    words = pa.array(shard.words, pa.binary()).cast(pa.string())
    p = shard.single()
    keep = np.arange(len(p.size), dtype=np.int32)
    chain = []  # for each length, the first words and the numbers of the n-grams without them
    hashes = word_hash = shard.hashes() if length > 1 else None
    for n in range(2, length + 1):
        chain.append((p.first, p.rest))
        p = shard.extend(p)
        if n < length:
            hashes = longer_hash(word_hash[p.first - 1], hashes[p.rest])
            continue
        at = hashes >> np.uint64(64 - BITS)
        frequent = (bits[(at >> np.uint64(3)).astype(np.intp)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1
        keep = np.flatnonzero(frequent[p.rest] & frequent[p.front]).astype(np.int32)
        del at, frequent
    p.label = hashes = word_hash = None
    for start in range(0, len(keep), ROWS):
        some = keep[start:start + ROWS]
        first, rest = p.first[some] - 1, p.rest[some]
        parts = [words.take(pa.array(first))]
        for firsts, rests in reversed(chain):
            parts.append(words.take(pa.array(firsts[rest] - 1)))
            rest = rests[rest]
        low, size, back = p.low[some], p.size[some], p.low_back[some]
        columns = [names.take(pa.array(shard.word_lang[first])), pc.binary_join_element_wise(*parts, " ") if chain else parts[0],
                   pa.array(size.astype(np.int64)), pa.array((shard.opens[low + size] - shard.opens[low]).astype(np.int64)),
                   pa.array((shard.closes[back + size] - shard.closes[back]).astype(np.int64))]
        yield pa.RecordBatch.from_arrays(columns, ["lang", "phrase", "n", "opens", "closes"])


def _summed(index: DataFrame, length: int, bits: np.ndarray | None, min_count: int) -> DataFrame:
    rows = index.mapInArrow(lambda x: _ngrams(length, bits, x), NGRAMS)
    # A shard gives an n-gram once, so it is summed up before it is sent; a map-side aggregate would hold them all again.
    total = rows.repartition("lang", "phrase").groupBy("lang", "phrase").agg(*[F.sum(c).alias(c) for c in ("n", "opens", "closes")])
    with rows_at_a_time(index.sparkSession, 1):
        return materialise(total.filter(F.col("n") >= min_count), f"phrases{length}")


def _bits(frequent: DataFrame) -> np.ndarray:
    """A table of 2^BITS bits with those of the n-grams' hashes set (at most 2^BITS / 64 rows reach the driver)."""
    at = frequent.select(F.shiftrightunsigned(phrase_hash(), 64 - BITS).alias("at"))
    rows = at.groupBy(F.shiftright("at", 6).alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, CAST(at & 63 AS INT))")).alias("bits"))
    out = np.zeros((1 << BITS) // 64, "<i8")
    t = rows.toPandas()
    out[t["word"].to_numpy(np.int64)] = t["bits"].to_numpy(np.int64)
    return out.view(np.uint8)


def ngrams(index: DataFrame, max_words: int = MAX_WORDS, min_count: int = MIN_COUNT) -> DataFrame:
    """lang, words, phrase, n, before, behind: every n-gram of 1 to max_words words with at least min_count
    occurrences, and how many of these have a word before and behind them in their piece.

    max_words may not be above that of the index.
    """
    out = last = None
    for length in range(1, max_words + 1):
        last = _summed(index, length, None if last is None else _bits(last), min_count)
        rows = last.select("lang", F.lit(length).alias("words"), "phrase", "n", (F.col("n") - F.col("opens")).alias("before"),
                           (F.col("n") - F.col("closes")).alias("behind"))
        out = rows if out is None else out.unionByName(rows)
    return out


def word_totals(index: DataFrame) -> DataFrame:
    """lang, n: all word occurrences."""
    x = index.select(F.explode(F.arrays_zip("langs", "lang_words")).alias("x"))
    return x.groupBy(F.col("x.langs").alias("lang")).agg(F.sum("x.lang_words").alias("n"))


def extensions(grams: DataFrame) -> DataFrame:
    """lang, phrase, left, right: counts of the most frequent n-gram that has one word more before or behind."""
    longer = grams.filter("words > 1")
    words = F.split("phrase", " ")
    part = F.explode(F.array(
        F.struct(F.array_join(F.expr("slice(split(phrase, ' '), 2, words - 1)"), " ").alias("phrase"), F.col("n").alias("left"),
                 F.lit(0).cast("long").alias("right")),
        F.struct(F.array_join(F.slice(words, F.lit(1), F.col("words") - 1), " ").alias("phrase"), F.lit(0).cast("long").alias("left"),
                 F.col("n").alias("right"))))
    return longer.select("lang", part.alias("p")).groupBy("lang", F.col("p.phrase").alias("phrase")).agg(
        F.max("p.left").alias("left"), F.max("p.right").alias("right"))


def exact_score(a: str, left: str, right: str) -> Column:
    """floor(1000000 * a * a / (left * right)) in whole decimals of up to 38 digits (a below 10^16)."""
    def d(x):
        return f"CAST({x} AS DECIMAL(20, 0))"
    return F.expr(f"CAST({d(a)} * {d(a)} * 1000000 AS DECIMAL(38, 0)) div ({d(left)} * {d(right)})")


def scored(grams: DataFrame) -> DataFrame:
    """lang, phrase, words, a, k, l, r, score, before, behind of the n-grams of two or more words: the cut (k words
    first) with the lowest score, the smallest k of these."""
    c = grams.filter("words > 1").withColumnRenamed("n", "a")
    w = F.split("phrase", " ")
    cuts = c.select("*", F.explode(F.expr("sequence(1, words - 1)")).alias("k")).select(
        "*", F.array_join(F.slice(w, F.lit(1), F.col("k")), " ").alias("_first"),
        F.array_join(F.slice(w, F.col("k") + 1, F.col("words") - F.col("k")), " ").alias("_rest"))
    part = grams.select("lang", "phrase", "n")
    cuts = cuts.join(part.select("lang", F.col("phrase").alias("_first"), F.col("n").alias("l")), ["lang", "_first"]) \
        .join(part.select("lang", F.col("phrase").alias("_rest"), F.col("n").alias("r")), ["lang", "_rest"])
    best = F.min(F.struct(exact_score("a", "l", "r").alias("score"), "k", "l", "r")).alias("_b")
    return cuts.groupBy("lang", "phrase", "words", "a", "before", "behind").agg(best).select(
        "lang", "phrase", "words", "a", "_b.k", "_b.l", "_b.r", "_b.score", "before", "behind")


def collocations(docs: DataFrame, max_words: int = MAX_WORDS, min_count: int = MIN_COUNT, share: int = SHARE,
                 top: int = TOP) -> DataFrame:
    """Each language's first ``top`` phrases by score, a (both descending) and phrase: lang, rank, phrase, a, l, r,
    n, score, k, before, behind.

    A phrase goes if an n-gram around it has at least ``share`` hundredths of its occurrences; it is
    enough to ask those one word longer, which have no fewer than the longer ones around them.
    """
    index = build_index(docs, max_words)
    grams = materialise(ngrams(index, max_words, min_count), "ngrams")
    around = extensions(grams).withColumn("_most", F.greatest("left", "right"))
    kept = scored(grams).join(around, ["lang", "phrase"], "left").filter(
        F.coalesce(100 * F.col("_most") < share * F.col("a"), F.lit(True)))
    w = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = kept.withColumn("rank", F.row_number().over(w).cast("long")).filter(F.col("rank") <= top)
    return ranked.join(word_totals(index), "lang").select(
        "lang", "rank", "phrase", "a", "l", "r", "n", "score", F.col("k").cast("long").alias("k"), "before", "behind")
