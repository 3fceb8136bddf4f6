"""Web pages as sequences of leaf blocks: text runs between block-level tags, with their tag path."""

from __future__ import annotations

import html
import re
from dataclasses import dataclass

_TAG = re.compile(r"""<(?:!--.*?(?:-->|\Z)|(/?)([a-zA-Z][^\s/>]*)((?:"[^"]*"|'[^']*'|[^'">])*)>|[!?][^>]*(?:>|\Z))""", re.S)
_LOOSE = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)")
_NAMES = re.compile(r"""(?:class|id|role|aria-label|itemprop)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_WORD = re.compile(r"[a-z]+")

# Elements whose content is not text to read (fixed values of the markup language).
HIDDEN = frozenset("script style noscript template iframe object svg canvas audio video textarea select button "
                   "option title head datalist annotation".split())
# Of these, the ones that only their own end tag ends, and those that may close themselves.
RAW, FOREIGN = frozenset("script style textarea title iframe noscript".split()), frozenset(["svg", "annotation"])
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark meter output q s "
                   "samp small span strike strong sub sup time tt u var img wbr math semantics mrow mi mn mo ms mtext "
                   "mfrac msqrt mroot msub msup msubsup munder mover munderover mstyle mspace".split())
# A start tag of the key closes an open element of the value.
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
          "th": {"td", "th"}}


@dataclass
class Block:
    text: str
    path: tuple[str, ...]   # tags and name words of the enclosing elements, outermost first
    tag: str                # the innermost block-level tag
    linked: float           # share of characters inside links
    words: int


def blocks(page: str | None) -> list[Block]:
    """The leaf blocks of a page in order; broken or cut markup is read as far as it goes."""
    out: list[Block] = []
    stack: list[tuple[str, tuple[str, ...]]] = []
    pieces: list[str] = []
    links = linked = 0
    hidden: str | None = None
    page = page or ""
    at, size = 0, len(page)

    def flush():
        nonlocal linked
        if pieces:
            text = " ".join("".join(pieces).split())
            if text:
                path = tuple(t for _, names in stack for t in names)
                tag = next((t for t, _ in reversed(stack) if t not in INLINE), "")
                out.append(Block(text, path, tag, min(1.0, linked / len(text)), text.count(" ") + 1))
            pieces.clear()
        linked = 0

    while at < size:
        left = page.find("<", at)
        if left < 0:
            left = size
        if left > at and hidden is None:
            piece = page[at:left]
            if "&" in piece:
                piece = html.unescape(piece)
            pieces.append(piece)
            if links:
                linked += len(piece)
        if left == size:
            break
        found = _TAG.match(page, left) or _LOOSE.match(page, left)
        if not found:
            if hidden is None:
                pieces.append("<")
            at = left + 1
            continue
        at = found.end()
        if not found.group(2):
            continue
        tag, closing = found.group(2).lower(), bool(found.group(1))
        if hidden is not None:
            if closing and tag == hidden:
                hidden = None
            elif hidden in RAW:
                at = left + 1      # markup inside raw text is text
            elif hidden == "head" and tag == "body":
                hidden = None
            elif closing and any(t == tag for t, _ in stack) or tag == "select" and closing:
                hidden = None      # an element without an end tag ends with its parent
                if tag != "select":
                    flush()
                    for k in range(len(stack) - 1, -1, -1):
                        if stack[k][0] == tag:
                            del stack[k:]
                            break
                continue
            else:
                continue
            if tag != "body" or closing:
                continue
        if tag in HIDDEN and not closing:
            if not (tag in FOREIGN and found.group(3).rstrip().endswith("/")):
                hidden = tag
            continue
        if tag not in INLINE:
            flush()
        if tag == "a":
            links = max(0, links + (-1 if closing else 1))
        if tag in VOID:
            continue
        if closing:
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == tag:
                    del stack[k:]
                    break
        else:
            if tag not in INLINE:
                shut = CLOSES.get(tag, ()) if tag != "p" else ("p",)
                for k in range(len(stack) - 1, -1, -1):
                    if stack[k][0] in shut or stack[k][0] == "p":
                        del stack[k:]
                        break
                    if stack[k][0] not in INLINE and stack[k][0] not in ("b",):
                        break
            names = [tag] if tag not in INLINE else []
            attributes = found.group(3)
            if attributes and ("=" in attributes):
                for m in _NAMES.finditer(attributes):
                    names += ["." + w for w in _WORD.findall((m.group(1) or m.group(2) or m.group(3) or "").lower())]
            stack.append((tag, tuple(names)))
    flush()
    return out
