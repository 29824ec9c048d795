"""Edit-aware token counts: a segment tree of pre-tokens per document.

A text is cut into pre-tokens by the tokenizer's pattern; LEAF pre-tokens make a
leaf, which holds its characters and tokens, and inner nodes hold their
subtrees' sums. An edit replaces a range of code points. Only the leaves that it
touches, with CONTEXT characters before it, are cut and counted anew, from the
first touched leaf's beginning until a new pre-token boundary meets an old leaf
boundary behind the edit; from there on the pattern sees the same text as before.
The sums on the paths to the root are then updated. The pattern looks at most two
characters beyond a pre-token, so leaves that end CONTEXT or more characters
before the edit stay as they are.

Defined results: a null text counts as empty (0 tokens); an edit beyond the end
is clipped to the text; repeated rows and null ids are rows of their own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postwise.llm.tokens import RANKS, counter, tokenizer_path

LEAF = 32
CONTEXT = 3


class TokenTree:
    """Characters and tokens of a text, by leaves of pre-tokens, with subtree sums."""

    def __init__(self, text: str, counts, pattern):
        self.text, self.counts, self.pattern = text, counts, pattern
        pieces = pattern.findall(text)
        self.counted = len(pieces)
        n = max(1, -(-len(pieces) // LEAF))
        self.size = 1 << (n - 1).bit_length()
        self.sums = np.zeros((2 * self.size, 2), np.int64)
        if pieces:
            at = np.arange(0, len(pieces), LEAF)
            for column, values in enumerate((map(len, pieces), map(counts.__getitem__, pieces))):
                leaf = np.add.reduceat(np.fromiter(values, np.int64, len(pieces)), at)
                self.sums[self.size:self.size + n, column] = leaf
        level = self.size
        while level > 1:
            self.sums[level // 2:level] = self.sums[level:2 * level].reshape(-1, 2, 2).sum(axis=1)
            level //= 2

    @classmethod
    def from_leaves(cls, text: str, chars: np.ndarray, tokens: np.ndarray, counts, pattern) -> "TokenTree":
        """The tree of a text whose leaf sums were kept: nothing is cut or counted."""
        t = cls.__new__(cls)
        t.text, t.counts, t.pattern, t.counted = text, counts, pattern, 0
        t.size = 1 << (max(1, len(chars)) - 1).bit_length()
        t.sums = np.zeros((2 * t.size, 2), np.int64)
        t.sums[t.size:t.size + len(chars), 0], t.sums[t.size:t.size + len(chars), 1] = chars, tokens
        level = t.size
        while level > 1:
            t.sums[level // 2:level] = t.sums[level:2 * level].reshape(-1, 2, 2).sum(axis=1)
            level //= 2
        return t

    def leaves(self) -> np.ndarray:
        """(characters, tokens) of the leaves that have any."""
        leaf = self.sums[self.size:]
        return leaf[leaf[:, 0] > 0]

    @property
    def tokens(self) -> int:
        return int(self.sums[1, 1])

    def find(self, char: int) -> tuple[int, int]:
        """The leaf that holds a character (the last one with any, beyond the end), and where it begins."""
        node, start = 1, 0
        char = min(char, int(self.sums[1, 0]) - 1)
        while node < self.size:
            left = int(self.sums[2 * node, 0])
            go_right = char >= start + left and char >= 0
            node = 2 * node + go_right
            start += left if go_right else 0
        return node - self.size, start

    def edit(self, begin: int, end: int, new: str) -> int:
        """Replace text[begin:end]; returns the number of pre-tokens counted anew."""
        begin = min(max(begin, 0), len(self.text))
        end = min(max(end, begin), len(self.text))
        first, start = self.find(max(0, begin - CONTEXT))
        old_length = len(self.text)
        self.text = self.text[:begin] + new + self.text[end:]
        shift = len(self.text) - old_length
        # Old boundary behind the edit: where leaf `last` begins.
        last, bound = first, start
        pieces = []
        at = start
        for m in self.pattern.finditer(self.text, start):
            while last < self.size and (bound < end or bound + shift < at):
                bound += int(self.sums[self.size + last, 0])
                last += 1
                if bound >= old_length:
                    bound = old_length
            if bound >= end and at >= begin + len(new) and bound + shift == at and last > first:
                break
            pieces.append(m.group())
            at = m.end()
        else:
            last = self.size
        self._put(first, last, pieces)
        return len(pieces)

    def _put(self, first: int, last: int, pieces: list[str]) -> None:
        """Leaves first..last-1 become these pre-tokens."""
        slots = max(1, last - first)
        each = max(LEAF, -(-len(pieces) // slots))
        for k in range(slots):
            part = pieces[k * each:(k + 1) * each]
            self.sums[self.size + first + k] = (sum(map(len, part)), sum(map(self.counts.__getitem__, part)))
        low, high = self.size + first, self.size + first + slots - 1
        while low > 1:
            low, high = low // 2, high // 2
            self.sums[low:high + 1] = self.sums[2 * low:2 * high + 2].reshape(-1, 2, 2).sum(axis=1)


def _counted(ranks_path: str, batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    counts, pattern = counter(ranks_path)
    for b in batches:
        rows = []
        for doc, text, edits in zip(b["doc_id"], b["text"], b["edits"]):
            tree = TokenTree(text or "", counts, pattern)
            before, whole, chars = tree.tokens, tree.counted, len(tree.text)
            anew = 0
            for e in (edits if edits is not None else ()):
                anew += tree.edit(int(e["start"]), int(e["stop"]), e["new"] or "")
            rows.append((doc, chars, before, len(tree.text), tree.tokens, whole, anew))
        yield pd.DataFrame(rows, columns=["doc_id", "n_chars", "n_tokens", "edited_chars", "edited_tokens",
                                          "n_pretokens", "n_recounted"]).astype({"doc_id": "Int64"})


def count_with_edits(docs: DataFrame, ranks_path: str | None = None) -> DataFrame:
    """Token counts of ``text`` before and after its ``edits``.

    ``edits`` is an array<struct<start, stop, new>>, applied in order; each range is in
    code points of the text as the edits before it have left it. n_recounted is the
    number of pre-tokens that all edits together had counted anew.
    """
    path = ranks_path or tokenizer_path(RANKS)
    return docs.select("doc_id", "text", "edits").mapInPandas(
        lambda x: _counted(path, x), "doc_id long, n_chars long, n_tokens long, edited_chars long, "
                                     "edited_tokens long, n_pretokens long, n_recounted long")


#: Columns of kept trees.
TREES = "doc_id long, text string, n_tokens long, leaf_chars array<long>, leaf_tokens array<long>, n_recounted long"


def _trees(ranks_path: str, kept: bool, batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    counts, pattern = counter(ranks_path)
    for b in batches:
        rows = []
        for k in range(len(b)):
            text = b["text"].iloc[k] or ""
            if kept:
                tree = TokenTree.from_leaves(text, b["leaf_chars"].iloc[k], b["leaf_tokens"].iloc[k], counts, pattern)
                edits = b["edits"].iloc[k]
                anew = sum(tree.edit(int(e["start"]), int(e["stop"]), e["new"] or "") for e in (edits if edits is not None else ()))
            else:
                tree = TokenTree(text, counts, pattern)
                anew = tree.counted
            leaf = tree.leaves()
            rows.append((b["doc_id"].iloc[k], tree.text, tree.tokens, leaf[:, 0], leaf[:, 1], anew))
        yield pd.DataFrame(rows, columns=["doc_id", "text", "n_tokens", "leaf_chars", "leaf_tokens", "n_recounted"]) \
            .astype({"doc_id": "Int64"})


def token_trees(docs: DataFrame, ranks_path: str | None = None) -> DataFrame:
    """The tree of each (doc_id, text), to be kept: its text, token count and leaf sums (TREES)."""
    path = ranks_path or tokenizer_path(RANKS)
    return docs.select("doc_id", "text").mapInPandas(lambda x: _trees(path, False, x), TREES)


def edit_trees(trees: DataFrame, ranks_path: str | None = None) -> DataFrame:
    """Kept trees after a batch of ``edits`` (as for :func:`count_with_edits`), to be kept again: a text is not
    counted anew, whatever number of batches it has been through, but for the regions touched by this one."""
    path = ranks_path or tokenizer_path(RANKS)
    return trees.select("doc_id", "text", "leaf_chars", "leaf_tokens", "edits").mapInPandas(
        lambda x: _trees(path, True, x), TREES)


def sample_edits(text: Column) -> Column:
    """Three edits of a text: a word put in at one third, its first 40 characters copied
    behind the middle, and 25 characters removed before the end of the last fifth."""
    n = F.char_length(F.coalesce(text, F.lit("")))

    def edit(start, stop, new):
        return F.struct(start.cast("long").alias("start"), stop.cast("long").alias("stop"), new.alias("new"))

    third, half, fifth = F.floor(n / 3), F.floor(n / 2) + 3, F.floor(n * 4 / 5)
    return F.array(edit(third, third, F.lit("re-edited")), edit(half, half, F.coalesce(F.substring(text, 1, 40), F.lit(""))),
                   edit(fifth, fifth + 25, F.lit("")))
