"""Near-duplicate documents: BagMinHash signatures, bands, verified multiset overlap.

A document is the multiset of its five-word shingles. A shingle of weight w owns
Poisson processes over discretised weights: one process per weight interval
[0,1), [1,2), [2,4), [4,8), ..., seeded by (shingle, interval) alone, with rate
equal to the interval's width; each point carries a time, a register and a weight
cell, and counts if its cell lies below w. The signature is the earliest time in
each register. Two documents agree in a register with the probability of their
weighted Jaccard similarity. Points are drawn only up to a time horizon at which
all registers are expected to be filled, doubled for the documents where one is not:
about two points per shingle.

Exact copies are one class (by the SHA-256 of the text) before any pair is made.
Classes that share a band are compared: first each with the central class of its
group, then those that this left unconnected with a few others (links.py), then, whatever
the size of the group, all pairs that are still unconnected and can be similar: a join of
each text's rarest shingles finds them (:func:`first_shingles`), none is missed. Every pair is
verified on the whole texts by exact multiset
overlap, and the verified links make connected groups. Pairs whose counts of shingles by
hash class (:func:`sketch`) show that they cannot be similar are refused before their
texts are read. So a group of n copies of one original costs about n comparisons, also where
copies are too far from it and from each other; texts are compared beyond that if they
share shingles that are among the rarest of both.

Defined results: a null text counts as empty; texts without words form one group;
shorter texts have one shingle of all their words; repeated rows are copies; rows
with a null id are grouped like others and represent a group only if it has no id.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postwise.llm.common import discard, materialise, with_row_id
from postwise.llm.links import linked, shared_keys

SHINGLE = 5
SIMILARITY = 0.8
BANDS = 20
ROWS = 5
MASK = (1 << 64) - 1


def gold(k: int) -> np.uint64:
    """The k-th step of a Weyl sequence."""
    return np.uint64(0x9E3779B97F4A7C15 * k & MASK)


GOLD = gold(1)


def mix(z: np.ndarray) -> np.ndarray:
    """Finaliser of SplitMix64: a well-mixed 64-bit value of each 64-bit value."""
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return z ^ (z >> np.uint64(31))


def shingles(text: str | None, size: int = SHINGLE) -> np.ndarray:
    """Hashes of a text's word shingles, with repeats."""
    ws = (text or "").split()
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, ws), np.uint64, len(ws))
    n = max(1, len(ws) - size + 1)
    out = np.full(n, 17, np.uint64)
    for j in range(min(size, len(ws))):
        out = mix(out * np.uint64(31) + h[j:j + n] + GOLD)
    return out


def bag(text: str | None, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles in ascending order, and their counts."""
    return np.unique(shingles(text, size), return_counts=True)


def overlap(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Weighted Jaccard similarity of two bags: sum of least counts / sum of greatest."""
    _, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    least = int(np.minimum(a[1][i], b[1][j]).sum())
    return least / (int(a[1].sum()) + int(b[1].sum()) - least)


#: Hash classes of a sketch.
CLASSES = 512


def sketch(b: tuple[np.ndarray, np.ndarray]) -> bytes:
    """Number of shingles in each hash class, 255 at most."""
    n = np.bincount((b[0] % np.uint64(CLASSES)).astype(np.int64), b[1], CLASSES)
    return np.minimum(n, 255).astype(np.uint8).tobytes()


def _possible(similarity: float, batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The pairs whose sketches allow for the similarity: shingles that differ by class differ in the bags too."""
    for b in batches:
        if len(b):
            x, y = (np.frombuffer(b"".join(b[c]), np.uint8).reshape(len(b), CLASSES) for c in ("sa", "sb"))
            apart = (np.maximum(x, y) - np.minimum(x, y)).sum(axis=1, dtype=np.int64)
            both = b["wa"].to_numpy(np.int64) + b["wb"].to_numpy(np.int64)
            yield b.loc[both - apart >= similarity * (both + apart) - 1e-6, ["a", "b"]]


def _points(doc, term, count, horizon, m, out) -> None:
    """Draw the points of each weighted term up to its document's horizon; earliest times go to out."""
    level = 0
    low, width = 0, 1
    while len(doc):
        seed = mix(term + gold(2 * level + 1))
        at = np.zeros(len(doc))
        live = np.arange(len(doc))
        step = 0
        while len(live):
            step += 1
            z = mix(seed[live] + gold(step))
            u = ((z >> np.uint64(11)).astype(np.float64) + 0.5) / 9007199254740992.0
            t = at[live] - np.log(u) / (m * width)
            ok = t <= horizon[doc[live]]
            live, t, z = live[ok], t[ok], z[ok]
            at[live] = t
            z = mix(z ^ np.uint64(0x5851F42D4C957F2D))
            register = ((z >> np.uint64(32)) % np.uint64(m)).astype(np.int64)
            cell = low + ((z & np.uint64(0xFFFFFFFF)) % np.uint64(width)).astype(np.int64)
            hit = cell < count[live]
            np.minimum.at(out, doc[live][hit] * m + register[hit], t[hit])
        low, width = low + width, max(1, low + width)
        level += 1
        more = count > low
        doc, term, count = doc[more], term[more], count[more]


def signatures(bags: list[tuple[np.ndarray, np.ndarray]], m: int = BANDS * ROWS) -> np.ndarray:
    """BagMinHash signatures: (documents, m) earliest times."""
    n = len(bags)
    out = np.full(n * m, np.inf)
    weight = np.array([int(c.sum()) for _, c in bags], float)
    horizon = (np.log(m) + 4.0) / weight
    todo = np.arange(n)
    while len(todo):
        doc = np.repeat(todo, [len(bags[i][0]) for i in todo])
        _points(doc, np.concatenate([bags[i][0] for i in todo]),
                np.concatenate([bags[i][1] for i in todo]).astype(np.int64), horizon, m, out)
        todo = todo[np.isinf(out.reshape(n, m)[todo]).any(axis=1)]
        horizon[todo] *= 2
    return out.reshape(n, m)


def band_keys(sig: np.ndarray, bands: int = BANDS, rows: int = ROWS) -> np.ndarray:
    """(documents, bands) hashes of the bands' registers; different in each band."""
    bits = np.ascontiguousarray(sig).view(np.uint64).reshape(len(sig), bands, rows)
    key = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64), (len(sig), bands)).copy()
    for r in range(rows):
        key = mix(key * np.uint64(31) + bits[:, :, r] + GOLD)
    return key.view(np.int64)


#: Characters and texts that are signed at a time.
TOGETHER, TEXTS = 2_000_000, 2_000


def _parts(b: pd.DataFrame) -> Iterator[pd.DataFrame]:
    """Slices of a batch of about TOGETHER characters, TEXTS texts at most."""
    first = size = 0
    for i, t in enumerate(b["text"]):
        size += len(t or "")
        if size >= TOGETHER or i + 1 - first == TEXTS or i + 1 == len(b):
            yield b.iloc[first:i + 1]
            first, size = i + 1, 0


def _signed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """(id, _sha, w, keys) of every row; equal texts of a part are signed once."""
    for b in batches:
        for part in _parts(b):
            at, first = np.unique(part["_sha"].to_numpy(), return_index=True)
            bags = [bag(t) for t in part["text"].iloc[first]]
            of = np.searchsorted(at, part["_sha"].to_numpy())
            w = np.array([int(c.sum()) for _, c in bags])
            yield pd.DataFrame({"id": part["id"].to_numpy(), "_sha": part["_sha"].to_numpy(), "w": w[of],
                                "keys": list(band_keys(signatures(bags))[of])})


#: Bits of the bitmap of wanted texts that is sent to every task (4 MB, whatever the input).
BITMAP = 25


def _wanted(wanted, batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """(id, w, sketch, text) of the rows whose bit is set in the bitmap: all wanted ones, few others."""
    bits = wanted.value
    for b in batches:
        at = b["at"].to_numpy()
        b = b[(bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1]
        bags = [bag(t) for t in b["text"]]
        yield pd.DataFrame({"id": b["id"].to_numpy(), "w": np.array([int(c.sum()) for _, c in bags], np.int64),
                            "sketch": pd.Series([sketch(x) for x in bags], dtype=object), "text": b["text"].to_numpy()})


def _texts_of(only: DataFrame, ids: DataFrame) -> DataFrame:
    """(id, w, sketch, text) of the rows (id, text) with these ids; a bitmap of fixed size spares the shuffle of other texts."""
    at = F.pmod(F.xxhash64("id"), F.lit(1 << BITMAP))
    words = ids.select(at.alias("at")).groupBy(F.shiftright("at", 6).alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, CAST(at & 63 AS INT))")).alias("bits")).toArrow()  # at most 2^19 words of the bitmap
    bits = np.zeros(1 << (BITMAP - 6), "<i8")
    bits[words["word"].to_numpy()] = words["bits"].to_numpy()
    wanted = only.sparkSession.sparkContext.broadcast(bits.view(np.uint8))
    found = only.select("id", at.alias("at"), "text").mapInPandas(
        lambda x: _wanted(wanted, x), "id long, w long, sketch binary, text string")
    return found.join(ids, "id", "left_semi")


def _verified(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        if not len(b):
            continue
        seen: dict[int, tuple] = {}

        def known(i, t):
            if i not in seen:
                if len(seen) > 200:
                    seen.clear()
                seen[i] = bag(t)
            return seen[i]

        s = [overlap(known(x, tx), known(y, ty)) for x, y, tx, ty in zip(b["a"], b["b"], b["ta"], b["tb"])]
        yield pd.DataFrame({"a": b["a"].to_numpy(), "b": b["b"].to_numpy(), "similarity": s})


def _verify(pairs: DataFrame, texts: DataFrame, similarity: float) -> DataFrame:
    """The pairs (a, b) of at least this multiset overlap of the whole texts."""
    for x in "ab":
        pairs = pairs.join(texts.select(F.col("id").alias(x), F.col("w").alias(f"w{x}"), F.col("sketch").alias(f"s{x}")), x)
    pairs = materialise(pairs.mapInPandas(lambda x: _possible(similarity, x), "a long, b long"), "possible")
    some = texts.select("id", "text").join(pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct(), "id", "left_semi")
    t = pairs.join(some.select(F.col("id").alias("a"), F.col("text").alias("ta")), "a") \
        .join(some.select(F.col("id").alias("b"), F.col("text").alias("tb")), "b")
    return t.select("a", "b", "ta", "tb").mapInPandas(_verified, "a long, b long, similarity double") \
        .filter(F.col("similarity") >= similarity)


#: Sizes of texts within a class of sizes differ by less than this factor.
WIDTH = 1.03
#: Hash classes (a power of two) in which shingles are counted for their order (a byte each, whatever the input).
TABLE = 24


def _shingle_counts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """(at, n): in how many texts the shingles of a hash class are."""
    for b in batches:
        for part in _parts(b):
            at, n = np.unique(np.concatenate([bag(t)[0] for t in part["text"]]) >> np.uint64(64 - TABLE), return_counts=True)
            yield pd.DataFrame({"at": at.astype(np.int64), "n": n.astype(np.int64)})


def first_shingles(b: tuple[np.ndarray, np.ndarray], counts: np.ndarray, similarity: float) -> tuple[np.ndarray, np.ndarray]:
    """(keys, sides) of a bag's first shingles, rare ones first, for each class of sizes of a similar bag.

    Two bags of weights v and w are similar only if they share at least t (v + w) / (1 + t)
    shingles; all but one less of each are then too few to hold no shared one, whatever the order, if it
    is the same for both: here by ``counts`` of hash classes, then by hash. A key stands for a
    shingle and the two classes of sizes; two bags can be similar only if they have a common
    key, with sides 0 and 1, or both 2 (the same class). Shingles that no other text has are left out.
    """
    shingle, n = b
    w = int(n.sum())
    often = counts[(shingle >> np.uint64(64 - TABLE)).astype(np.intp)]
    order = np.lexsort((shingle, often))
    shingle, often, before = shingle[order], often[order], np.cumsum(n[order]) - n[order]
    size = lambda x: int(np.floor(np.log(max(x, 1.0)) / np.log(WIDTH) + 1e-9))
    own = size(w)
    # The classes next to the outermost similar ones are included, so that rounding loses none.
    other = np.arange(max(0, size(similarity * w) - 1), size(w / similarity) + 2)
    least = np.maximum(np.floor(WIDTH ** other), similarity * w)
    first = w - np.ceil(similarity / (1 + similarity) * (w + least) - 1e-6) + 1
    i, j = np.nonzero((before[None, :] < first[:, None]) & (often > 1)[None, :])
    low, high = np.minimum(own, other[i]), np.maximum(own, other[i])
    side = np.where(low == high, 2, np.where(low == own, 0, 1))
    return mix(shingle[j] ^ mix((low * 65_536 + high).astype(np.uint64) + GOLD)).view(np.int64), side.astype(np.int32)


def _first_shingles(counts, similarity: float, batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        for part in _parts(b):
            found = [first_shingles(bag(t), counts.value, similarity) for t in part["text"]]
            rows = np.repeat(np.arange(len(part)), [len(k) for k, _ in found])
            yield pd.DataFrame({"key": np.concatenate([k for k, _ in found]), "side": np.concatenate([x for _, x in found]),
                                **{c: part[c].to_numpy()[rows] for c in ("id", "r", "w")}})


def _unlinked(shared: DataFrame, roots: DataFrame, texts: DataFrame, similarity: float) -> DataFrame:
    """(a, b): all pairs that share a band, are not connected by ``roots`` and can be similar by their first shingles.

    Instead of all pairs of a band's members it joins the few rarest shingles of each (:func:`first_shingles`), so
    copies of one original with too many changes of their own meet nobody.
    """
    m = shared.select("key", "id").join(roots, "id", "left").withColumn("r", F.coalesce("root", "id"))
    several = m.groupBy("key").agg(F.min("r").alias("x"), F.max("r").alias("y")).filter("x <> y").select("key")
    m = materialise(m.join(several, "key").groupBy("id", "r").agg(F.collect_set("key").alias("bands")), "parts")
    t = materialise(texts.select("id", "w", "text").join(m.select("id", "r"), "id"), "members")
    n = t.select("text").mapInPandas(_shingle_counts, "at long, n long").groupBy("at").agg(F.sum("n").alias("n"))
    words = n.groupBy(F.shiftright("at", 3).alias("word")).agg(F.bit_or(
        F.expr("shiftleft(least(n, 255), CAST((at & 7) * 8 AS INT))")).alias("n")).toArrow()  # at most 2^21 words of counts
    counts = np.zeros(1 << (TABLE - 3), "<i8")
    counts[words["word"].to_numpy()] = words["n"].to_numpy()
    del words
    sent = t.sparkSession.sparkContext.broadcast(counts.view(np.uint8))
    keys = t.mapInPandas(lambda x: _first_shingles(sent, similarity, x), "key long, side int, id long, r long, w long")
    keys = materialise(keys, "shingles")
    met = keys.join(keys.select("key", *[F.col(c).alias(f"_{c}") for c in ("side", "id", "r", "w")]), "key").filter(
        "id < _id AND r <> _r AND (side + _side = 1 OR side = 2 AND _side = 2)").filter(
        F.least("w", "_w") >= F.greatest("w", "_w") * similarity)
    pairs = met.select(F.col("id").alias("a"), F.col("_id").alias("b")).distinct()
    for x in "ab":
        pairs = pairs.join(m.select(F.col("id").alias(x), F.col("bands").alias(f"k{x}")), x)
    pairs = materialise(pairs.filter(F.arrays_overlap("ka", "kb")).select("a", "b"), "unlinked")
    discard(m, t, keys)
    return pairs


def near_duplicates(docs: DataFrame, similarity: float = SIMILARITY) -> tuple[DataFrame, DataFrame]:
    """(rows, links): the input rows with group columns, and the verified links.

    rows: _row (struct of the input columns), _rid (a number per row), _class (_rid of the
    first row with the same text), _group (least _class of the connected group) and
    _links (verified links of the row's class); links: (a, b, similarity) between classes.
    """
    rows = with_row_id(docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("_row")))
    rows = materialise(rows.withColumn("_sha", F.unhex(F.sha2(F.coalesce("_row.text", F.lit("")), 256))), "docs")
    # Every row is signed where it is read; one row per different text goes on.
    only = rows.select(F.col("_rid").alias("id"), "_sha", F.col("_row.text").alias("text"))
    signed = only.mapInPandas(_signed, "id long, _sha binary, w long, keys array<long>")
    first = materialise(signed.groupBy("_sha").agg(F.min(F.struct("id", "w", "keys")).alias("c")).select("_sha", "c.*"), "classes")
    shared = materialise(shared_keys(first.select("id", "w", F.explode("keys").alias("key"))), "bands")
    texts = materialise(_texts_of(only.drop("_sha"), shared.select("id").distinct()), "texts")
    close = F.least("w", "_w") >= F.greatest("w", "_w") * similarity
    links, root = linked(shared, close, lambda x: _verify(x, texts, similarity), ("w",),
                         lambda x: _unlinked(shared, x, texts, similarity))
    degree = links.select(F.explode(F.array("a", "b")).alias("id")).groupBy("id").agg(F.count("*").alias("_links"))
    known = materialise(first.select("_sha", "id").join(root, "id", "left").join(degree, "id", "left").select(
        "_sha", F.col("id").alias("_class"), F.coalesce("root", "id").alias("_group"),
        F.coalesce("_links", F.lit(0)).cast("bigint").alias("_links")), "groups")
    discard(first, shared, texts)
    return rows.join(known, "_sha").drop("_sha"), links


def _first(doc_id: str):
    """Order of the rows of a group: by doc_id, null ids last, then by row number."""
    return F.min(F.struct(F.col(doc_id).isNull().alias("n"), F.col(doc_id).alias("d"), F.col("_rid").alias("r")))


def duplicate_groups(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """One row per document: doc_id, group_id (least doc_id of its group), class_id (least
    doc_id with the same text), n_links (links of its text that the spanning comparison
    verified, not the number of similar texts: what is connected already is not compared) and kept (true for
    one row of each group: the least doc_id, at equal ids the first row)."""
    rows, _ = near_duplicates(docs.select("doc_id", "text"), similarity)
    d = materialise(rows.select("_rid", F.col("_row.doc_id").alias("doc_id"), "_class", "_group", "_links"), "groups")
    group = d.groupBy("_group").agg(_first("doc_id").alias("g"))
    klass = d.groupBy("_class").agg(F.min("doc_id").alias("class_id"))
    return d.join(klass, "_class").join(group, "_group").select(
        "doc_id", F.col("g.d").alias("group_id"), "class_id", F.col("_links").alias("n_links"),
        (F.col("_rid") == F.col("g.r")).alias("kept"))


def keep_one(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """The input columns, with one row of each near-duplicate group (its least doc_id)."""
    rows, _ = near_duplicates(docs, similarity)
    narrow = rows.select("_rid", "_group", F.col("_row.doc_id").alias("doc_id"))
    first = narrow.groupBy("_group").agg(_first("doc_id").alias("g")).select(F.col("g.r").alias("_rid"))
    return rows.select("_rid", "_row").join(first, "_rid", "left_semi").select("_row.*")
