"""Blocks of an HTML page: its texts between block-level tags, with what the page says about them.

A forgiving reader for one page at a time: it never fails on broken, cut or unbalanced markup.  It is
one pass over the tags and keeps a stack of the open containers only.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass
from html import unescape

# Quoted values may hold ">"; a quote that is never closed does not count.  Groups are atomic, so that
# no page makes the search go back.
_TAG = re.compile(
    r"<!--.*?(?:--!?>|\Z)"
    r"|<(?P<close>/?)(?P<name>[a-zA-Z][^\s/>]*+)(?P<attrs>(?>=\s*+\"[^\"]*+\"|=\s*+'[^']*+'|[^>])*+)(?:>|\Z)"
    r"|<[!?/][^>]*+(?:>|\Z)", re.S)
_ATTR = re.compile(r"([^\s=\"'/]++)(?>\s*+=\s*+(?>\"([^\"]*+)\"|'([^']*+)'|([^\s>]++)))?+")
_TOKEN = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[0-9]+")

#: their content is text up to their own end tag, whatever it looks like
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp "
                   "small span strike strong sub sup time tt u var wbr img".split())
#: never part of an article, and no article begins inside
HARD = frozenset("head script style noscript template nav footer aside button select option textarea dialog menu iframe "
                 "object applet svg canvas audio video map title xmp noembed noframes".split())
#: not part of an article, unless one begins inside
SOFT = frozenset("form header fieldset".split())
REGION = frozenset("article main".split())
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar tablist toolbar".split())
#: words of a class or id that name something beside the article
HINTS = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense banner sponsor sponsored promo promoted promotion "
    "nav navbar navigation menu menubar breadcrumb breadcrumbs crumbs pager pagination skip skiplink "
    "header masthead topbar footer colophon copyright legal sidebar rail widget widgets related recommended "
    "recommendations teaser teasers cookie cookies consent gdpr notice notices alert popup modal overlay paywall newsletter "
    "subscribe subscription signup login signin register search searchbox form share sharing social follow comment "
    "comments commentlist disqus reply replies respond responses discussion".split())
#: of these, what an article itself may be named by without being the article of the page
REGION_HINTS = frozenset("ad ads advert advertisement sponsored promo related teaser comment reply".split())
#: words that name a part of an article when they stand inside of one
INSIDE = frozenset("header legal alert".split())
#: a name that begins so tells what a container has beside it, not what it is
BESIDE_IT = frozenset("has with no without".split())
#: names of an article; a header of one is its own
OWN = frozenset("article entry post story content".split())


@dataclass(slots=True)
class Block:
    """One block: its text, the code points of it inside links, whether it is a heading, the number of
    the article it stands in (0: none), and whether it lies beside the article by its container."""
    text: str
    linked: int
    heading: bool
    region: int
    beside: bool


def _side(name: str, attrs: str, region: int) -> str:
    """What a start tag opens: "hard", "soft", "region" or ""."""
    if name in HARD:
        return "hard"
    values = {}
    if attrs.strip(" \t\r\n\f/"):
        for key, a, b, c in _ATTR.findall(attrs):
            values.setdefault(key.lower(), unescape(a or b or c))
    if "hidden" in values or "display:none" in values.get("style", "").replace(" ", "").lower():
        return "hard"
    words = set()
    for full in f"{values.get('class', '')} {values.get('id', '')}".split():
        found = [w.lower() for w in _TOKEN.findall(full)]
        if found and found[0] not in BESIDE_IT:
            words.update(w for w in found if w not in INSIDE) if OWN & set(found) else words.update(found)
    role = values.get("role", "").strip().lower()
    if name in REGION or role in REGION:
        return "soft" if words & REGION_HINTS else "region"
    if name in ("html", "body"):
        return ""
    if role in ROLES or words & (HINTS - INSIDE if region else HINTS):
        return "soft"
    return "soft" if name in SOFT and not (region and name == "header") else ""


def page_blocks(html: str) -> list[Block]:
    """The blocks of a page in order, without empty ones.

    Scripts, styles, comments and tags are no text.  Character references are decoded, white
    space becomes one space, two line breaks in a row end a block."""
    out: list[Block] = []
    parts: list[str] = []
    linked, links, depth, heading, breaks = 0, 0, 0, False, 0
    stack: list[tuple[str, str]] = []                # (name, what it opens)
    open_, sides = Counter(), Counter()              # open names; open "hard" and "soft" ones
    regions: list[tuple[int, int]] = []              # (number, soft containers open around it)
    made = 0

    def flush():
        nonlocal linked, heading, breaks
        text = " ".join("".join(parts).split()) if parts else ""
        parts.clear()
        if text:
            number, around = regions[-1] if regions else (0, 0)
            out.append(Block(text, min(linked, len(text)), heading, number, sides["hard"] > 0 or sides["soft"] > around))
        linked, heading, breaks = 0, False, 0

    def pop():
        nonlocal links
        name, side = stack.pop()
        if len(stack) < depth:                       # a link left open ends with its container
            links = 0
        open_[name] -= 1
        if side == "region":
            regions.pop()
        elif side:
            sides[side] -= 1

    def text(piece: str):
        nonlocal linked, breaks, heading
        if piece:
            piece = unescape(piece)
            parts.append(piece)
            solid = len("".join(piece.split())) if links else len(piece.strip())
            if solid:
                breaks = 0
                heading = heading or bool(open_ and any(open_[h] for h in ("h1", "h2", "h3", "h4", "h5", "h6")))
                linked += len(" ".join(piece.split())) if links else 0

    at, search = 0, _TAG.search
    while True:
        m = search(html, at)
        if m is None:
            text(html[at:])
            break
        text(html[at:m.start()])
        at = m.end()
        name = m["name"]
        if name is None:
            continue
        name = name.lower()
        if m["close"]:
            if name == "a":
                links = 0
            if name in INLINE:
                continue
            flush()
            if open_[name]:
                while stack[-1][0] != name:
                    pop()
                pop()
            continue
        if name == "br":
            breaks += 1
            parts.append(" ")
            if breaks > 1:
                flush()
            continue
        if name == "a" and "href" in m["attrs"].lower():
            links, depth = 1, len(stack)
        if name in RAW:                              # skipped up to its end tag, or all the rest
            end = re.compile(f"</{name}(?=[\\s/>]|\\Z)", re.I).search(html, at)
            at = end.start() if end else len(html)
            if name != "xmp":
                continue
        if name in VOID:
            if name == "hr":
                flush()
            continue
        side = _side(name, m["attrs"] or "", regions[-1][0] if regions else 0)
        if name in INLINE and not side:
            continue
        flush()
        if name in ("p", "li", "dt", "dd", "tr", "td", "th", "option") and stack and stack[-1][0] == name:
            pop()                                    # the one before it ends here
        elif name not in INLINE and stack and stack[-1][0] == "p":
            pop()
        if side == "region":
            made += 1
            regions.append((made, sides["soft"]))
        elif side:
            sides[side] += 1
        stack.append((name, side))
        open_[name] += 1
    flush()
    return out
