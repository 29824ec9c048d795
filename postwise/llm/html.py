"""Leaf blocks of an HTML page: their texts and tag paths."""

from __future__ import annotations

import html as _html
import re

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:\"[^\"]*\"|'[^']*'|[^>\"'])*)>|<[!?][^>]*>|[^<]+|<", re.S)
ATTRIBUTE = re.compile(r"\b(class|id|role|type)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
WORD = re.compile(r"[a-zA-Z]+|\d+")
#: Elements whose text is never part of a page's visible text.
HIDDEN = frozenset("script style noscript template svg math head title iframe object canvas audio video "
                   "select option textarea button datalist".split())
RAW = frozenset(("script", "style", "textarea", "title", "noscript", "iframe"))
BLOCK = frozenset("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset "
                  "figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol "
                  "p pre section summary table tbody td tfoot th thead tr ul".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: An opening tag on the left ends an open element on the right.
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
          "th": {"td", "th"}, "option": {"option"}}


class Block:
    """A run of text without a block tag in it: text, tag path, characters within links."""

    __slots__ = ("path", "text", "linked")

    def __init__(self, text: str, path: tuple[str, ...], linked: int):
        self.text, self.path, self.linked = text, path, linked


def blocks(page: str | None) -> list[Block]:
    """The leaf blocks of a page in order, with character references decoded and white space
    turned into single spaces. Unclosed and stray tags are borne with."""
    page = page or ""
    out: list[Block] = []
    stack: list[tuple[str, str]] = []  # (tag, its path entry)
    parts: list[str] = []
    linked = hidden = links = 0
    at, n = 0, len(page)

    def flush() -> None:
        nonlocal linked
        if parts:
            text = " ".join(_html.unescape("".join(parts)).split())
            if text:
                out.append(Block(text, tuple(x for _, x in stack), linked))
            parts.clear()
        linked = 0

    def pop_to(k: int) -> None:
        nonlocal hidden, links
        for tag, _ in stack[k:]:
            hidden -= tag in HIDDEN
            links -= tag == "a"
        del stack[k:]

    while at < n:
        m = TOKEN.match(page, at)
        at = m.end()
        tag = m.group(2)
        if tag is None:
            raw = m.group()
            if raw[0] != "<" or raw == "<":
                if not hidden:
                    parts.append(raw)
                    linked += len(raw) if links else 0
            continue
        tag = tag.lower()
        if m.group(1):
            k = next((k for k in range(len(stack) - 1, -1, -1) if stack[k][0] == tag), None)
            if tag in BLOCK:
                flush()
            if k is not None:
                if tag not in BLOCK and any(t in BLOCK for t, _ in stack[k:]):
                    continue  # an inline end tag does not close blocks
                if tag not in HIDDEN and tag == "p" and any(t in BLOCK and t != "p" for t, _ in stack[k + 1:]):
                    continue
                pop_to(k)
            continue
        if tag == "body":
            pop_to(next((k for k, (t, _) in enumerate(stack) if t in HIDDEN), len(stack)))
        if tag in BLOCK:
            flush()
            for k in range(len(stack) - 1, -1, -1):
                t = stack[k][0]
                if t == "p" or t in CLOSES.get(tag, ()):
                    pop_to(k)
                    break
                if t in BLOCK:
                    break
        elif tag == "br":
            parts.append(" ")
        if tag in VOID or m.group(3).endswith("/"):
            continue
        entry = tag
        if m.group(3):
            entry = " ".join([tag, *(f"{a.lower()}={v1 or v2 or v3}" for a, v1, v2, v3 in ATTRIBUTE.findall(m.group(3)))])
        stack.append((tag, entry))
        hidden += tag in HIDDEN
        links += tag == "a"
        if tag in RAW:
            end = re.compile(rf"</{tag}\b", re.I).search(page, at)
            at = end.start() if end else n
    flush()
    return out
