"""Encoding texts with a public byte-level BPE, with a bounded cache per Python worker."""

from __future__ import annotations

import array
import base64
import itertools
import re
import sys
import types

import numpy as np

TOKENIZER = "byte_bpe_50k.json"
RANKS = "byte_bpe_50k.tiktoken"
#: Entries of a worker's cache; it is emptied when full.
CACHE = 1_000_000
#: White space after another character always begins a pre-token, so texts can be cut there.
PIECES = re.compile(r"\s*\S+|\s+")
#: A piece of an end of line, Latin letters (after a blank, or none) and marks: each of the three is cut off.
PLAIN = re.compile(r"(\n?)( ?[A-Za-zÀ-ÖØ-öø-ɏ]+)([!-&(-/:-@\[-`{-~]*)")


def tokenizer_path(name: str) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def worker_state() -> dict:
    """A dictionary that lives as long as the Python process, over all of its tasks."""
    module = sys.modules.setdefault("_postwise_llm_state", types.ModuleType("_postwise_llm_state"))
    return module.__dict__


def _load(path: str):
    state = worker_state()
    if ("tokenizer", path) not in state:
        import os

        from tokenizers import Tokenizer
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        t = Tokenizer.from_file(path)
        state["tokenizer", path] = (t, {}, "<u2" if t.get_vocab_size() <= 1 << 16 else "<u4")
    return state["tokenizer", path]


def encode(texts: list[str | None], path: str) -> tuple[list[bytes], str]:
    """The ids of each text as little-endian bytes, and their numpy type.

    The same as ``Tokenizer.encode(text, add_special_tokens=False).ids``: texts are
    cut where a pre-token always begins, and the pieces encoded once each.
    """
    from tokenizers.pre_tokenizers import ByteLevel
    tokenizer, cache, dtype = _load(path)
    code = "H" if dtype == "<u2" else "I"
    pieces = [PIECES.findall(t or "") for t in texts]
    # The pieces of these texts and their ids, so that the large cache is asked once for each.
    known = dict.fromkeys(itertools.chain.from_iterable(pieces))
    known = dict(zip(known, map(cache.get, known)))
    new = [p for p, ids in known.items() if ids is None]
    if len(cache) + 2 * len(new) > CACHE:
        cache.clear()
    plain = {p: m.groups() for p in new if (m := PLAIN.fullmatch(p))}
    rest = {p for p in new if p not in plain}
    for head, _, marks in plain.values():
        rest.add(head)
        rest.add(marks)
    rest.difference_update([p for p in rest if p in cache])
    rest = list(rest)
    for at in range(0, len(rest), 10_000):
        some = rest[at:at + 10_000]
        for p, e in zip(some, tokenizer.encode_batch_fast(some, add_special_tokens=False)):
            cache[p] = array.array(code, e.ids).tobytes()
    # A plain word is one pre-token: its bytes go to the tokenizer's model as they are.
    level, model = ByteLevel(add_prefix_space=False, use_regex=False), tokenizer.model
    for p, (head, word, marks) in plain.items():
        if word not in cache:
            raw = level.pre_tokenize_str(word)[0][0]
            cache[word] = array.array(code, [t.id for t in model.tokenize(raw)]).tobytes()
        cache[p] = cache[head] + cache[word] + cache[marks]
    known.update((p, cache[p]) for p in new)
    return [b"".join(map(known.__getitem__, ps)) for ps in pieces], dtype


class Counter(dict):
    """Number of tokens of a pre-token, counted when first asked for."""

    def __init__(self, ranks_path: str):
        super().__init__()
        import public_tokenizers
        import tiktoken
        with open(ranks_path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.pattern = public_tokenizers.PATTERN
        self.encoding = tiktoken.Encoding("byte_bpe_50k", pat_str=self.pattern, mergeable_ranks=ranks, special_tokens={})

    def __missing__(self, piece: str) -> int:
        if len(self) > CACHE:
            self.clear()
        n = self[piece] = len(self.encoding.encode_ordinary(piece))
        return n


def counter(ranks_path: str) -> tuple[Counter, object]:
    """The worker's counter and the compiled pre-token pattern."""
    state = worker_state()
    if ("counter", ranks_path) not in state:
        import regex
        c = Counter(ranks_path)
        state["counter", ranks_path] = (c, regex.compile(c.pattern))
    return state["counter", ranks_path]


def _whole(path: str, ranks_path: str):
    """The worker's whole-text encoder, the strings it must not see, and the tokenizer for texts that hold one."""
    state = worker_state()
    if ("whole", path, ranks_path) not in state:
        tokenizer = _load(path)[0]
        special = [t.content for t in tokenizer.get_added_tokens_decoder().values()]
        encoding = counter(ranks_path)[0].encoding
        if len(encoding._mergeable_ranks) + len(special) != tokenizer.get_vocab_size():
            raise ValueError(f"{ranks_path} does not hold the vocabulary of {path}")
        state["whole", path, ranks_path] = (encoding, special, tokenizer)
    return state["whole", path, ranks_path]


def id_type(path: str) -> str:
    """The smallest numpy type that holds the tokenizer's ids."""
    return _load(path)[2]


def encode_whole(texts: list[str | None], path: str, ranks_path: str) -> list[list[int]]:
    """The ids of each text, as ``Tokenizer.encode(text, add_special_tokens=False).ids`` has them.

    ``ranks_path`` holds the vocabulary of ``path`` as ranks, whose library encodes a whole text in a
    quarter of the time and gives equal ids (tested); texts that hold a special token's string go to
    the tokenizer itself.
    """
    encoding, special, tokenizer = _whole(path, ranks_path)
    out = []
    for t in texts:
        t = t or ""
        if any(s in t for s in special):
            out.append(tokenizer.encode(t, add_special_tokens=False).ids)
        else:
            out.append(encoding.encode_ordinary(t))
    return out


def encode_arrays(texts: list[str | None], path: str, ranks_path: str) -> list[np.ndarray]:
    """The ids of :func:`encode_whole` as arrays of 32 bits, which the library fills without a list of numbers."""
    encoding, special, tokenizer = _whole(path, ranks_path)
    out = []
    for t in texts:
        t = t or ""
        if any(s in t for s in special):
            out.append(np.array(tokenizer.encode(t, add_special_tokens=False).ids, np.uint32))
        else:
            out.append(encoding.encode_to_numpy(t, disallowed_special=()))
    return out
