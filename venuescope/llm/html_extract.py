"""Main text of web pages by two passes of block rules.

First pass: each block is decided by link density, length and the share of stop words of the page's
language, or stays open when it is too short or too poor in stop words to tell.  Second pass: an
open block takes the label of its nearest decided neighbours.  Containers that a page names as
menu, footer, advert and so on are decided at once, and where a page marks its article, only blocks
in it can be part of the text, and the neighbours of a block are those of its article.

Pages are independent of each other: one pass over the table, no shuffle.
"""

from __future__ import annotations

import re
from collections.abc import Mapping

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import row_slices
from .html_blocks import Block, page_blocks

#: frequent function words of four languages
STOP_WORDS: Mapping[str, frozenset[str]] = {k: frozenset(v.split()) for k, v in {
    "en": "a an and are as at be been but by can for from had has have he her his i if in into is it its not of on or our "
          "she so than that the their them then there these they this to was we were what when which who will with would you",
    "de": "aber als am an auch auf aus bei bin bis da das dass dem den der des die doch durch ein eine einem einen einer es "
          "für hat ich ihr im in ist mit nach nicht noch nur oder sich sie sind so über um und von vor war wie wir zu zum zur",
    "fr": "au aux avec ce ces cette comme dans de des du elle en est et eux il ils je la le les leur lui ma mais me même "
          "ne nos notre nous on ou où par pas pour qu que qui sa se ses son sont sur ta te un une vous à été",
    "es": "a al como con cuando de del desde donde e el ella en entre era es esta este ha hasta la las le les lo los "
          "más me mi muy no o para pero por porque que qué se ser si sin sobre son su sus también un una y ya",
}.items()}
_WORD = re.compile(r"[^\W\d_]+")

GOOD, BAD, OPEN = 1, 0, None


def page_language(blocks: list[Block], stop_words: Mapping[str, frozenset[str]]) -> str | None:
    """The language whose stop words fill most of the page's words (the first of the mapping at a tie)."""
    hits = dict.fromkeys(stop_words, 0)
    for b in blocks:
        if not b.beside:
            for w in _WORD.findall(b.text.lower()):
                for lang, words in stop_words.items():
                    if w in words:
                        hits[lang] += 1
    return max(hits, key=hits.get) if hits else None


def first_pass(b: Block, stop: frozenset[str], marked: bool, min_length: int, stop_share: float, max_links: float):
    """GOOD, BAD or OPEN by the block alone.  marked: the page marks its article."""
    if b.beside or marked and not b.region:
        return BAD
    if b.linked > max_links * len(b.text):
        return BAD
    if b.text.startswith("©") and not b.region:
        return BAD
    words = _WORD.findall(b.text.lower())
    if b.heading or len(b.text) < min_length or not words:
        return OPEN
    if sum(w in stop for w in words) >= stop_share * len(words):
        return GOOD
    return OPEN if b.region else BAD


def second_pass(blocks: list[Block], labels: list[int | None]) -> list[int]:
    """Open blocks take the label of the nearest decided block before or after them in the same article (or
    both outside of any).  At equal distance a heading goes with what follows it, and any other
    block is GOOD if one of the two is.  Without a decided neighbour a block is GOOD."""
    n = len(blocks)
    left, right, seen = [None] * n, [None] * n, {}
    for i in range(n):
        left[i] = seen.get(blocks[i].region)
        if labels[i] is not OPEN:
            seen[blocks[i].region] = i
    seen = {}
    for i in range(n - 1, -1, -1):
        right[i] = seen.get(blocks[i].region)
        if labels[i] is not OPEN:
            seen[blocks[i].region] = i
    out = []
    for i, (b, label) in enumerate(zip(blocks, labels)):
        if label is OPEN:
            before, after = left[i], right[i]
            if b.region and not b.beside:
                # what a page marks as its article and no rule decides against is part of it
                near = [labels[j] for j in (before, after) if j is not None and not blocks[j].beside]
                label = GOOD if not near or GOOD in near else BAD
            elif before is None and after is None:
                label = GOOD
            elif before is None or after is None:
                label = labels[after if before is None else before]
            elif b.heading:
                label = labels[after]
            elif i - before == after - i:
                label = max(labels[before], labels[after])
            else:
                label = labels[before] if i - before < after - i else labels[after]
        out.append(label)
    return out


def main_text(html: str | None, stop_words: Mapping[str, frozenset[str]] = STOP_WORDS, min_length: int = 40,
              stop_share: float = 0.1, max_links: float = 0.5) -> str:
    """The blocks of a page's article, joined by an empty line ("" for null, empty and textless pages)."""
    blocks = page_blocks(html or "")
    lang = page_language(blocks, stop_words)
    stop = stop_words[lang] if lang else frozenset()
    marked = any(b.region and not b.beside for b in blocks)
    labels = [first_pass(b, stop, marked, min_length, stop_share, max_links) for b in blocks]
    return "\n\n".join(b.text for b, label in zip(blocks, second_pass(blocks, labels)) if label)


def extract(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html",
            stop_words: Mapping[str, frozenset[str]] = STOP_WORDS, min_length: int = 40, stop_share: float = 0.1,
            max_links: float = 0.5) -> DataFrame:
    """(page_id, url, text, n_chars), one row per input row.

    Null and empty pages, and pages without text, have an empty text.  Ids and urls are passed through, null or
    repeated; pages are read whole, however long.  Other columns are not read."""
    def run(batches):
        for batch in batches:
            for part in row_slices(batch, "h", 4 << 20):
                texts = [main_text(h, stop_words, min_length, stop_share, max_links) for h in part.column("h").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column("p"), part.column("u"), pa.array(texts, pa.string()), pa.array(list(map(len, texts)), pa.int64())],
                    ["p", "u", "t", "n"])

    kinds = [pages.schema[c].dataType.simpleString() for c in (page_id, url)]
    out = pages.select(F.col(page_id).alias("p"), F.col(url).alias("u"), F.col(html).alias("h")).mapInArrow(
        run, f"p {kinds[0]}, u {kinds[1]}, t string, n long")
    return out.select(F.col("p").alias(page_id), F.col("u").alias(url), F.col("t").alias("text"), F.col("n").alias("n_chars"))
