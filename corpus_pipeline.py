"""The corpus pipeline: from raw documents to packed training sequences.

Each stage is a function (spark, docs, sf_dir) -> DataFrame over all that the stage before it
kept.  All but the last return the columns of ``documents``; where a stage rewrites the text, n_chars
follows it.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from venuescope.llm import line_dedup, minhash, packing, quality_rules, suffix_dedup
from venuescope.llm.common import stage, table


def _columns(docs, like):
    """The columns of ``like`` with n_chars, if there is one, counted anew."""
    return docs.select(*[F.char_length("text").cast(like.schema[c].dataType).alias(c) if c == "n_chars" else c for c in like.columns])


def quality(spark, docs, sf_dir):
    """Documents that fail the base check or that a learned rule rejects go.

    Null, empty and blank texts have too few words and go; repeated rows share a verdict and stay or go
    together; a null id is judged by its text alone; without labels only the base check decides; an empty table stays
    empty; other columns pass through."""
    return quality_rules.keep_good(docs, table(spark, sf_dir, "labels"))


def lines(spark, docs, sf_dir):
    """Lines that many documents share stay in one of them, that of the largest id (all rows of it).

    A null text becomes empty; rows without an id keep their lines and do not count; repeated rows count each;
    a text that loses all lines stays as an empty one; other columns pass through."""
    return _columns(line_dedup.dedup_lines(docs), docs)


def near_duplicates(spark, docs, sf_dir):
    """One document of each group of near-duplicates stays, that of the smallest id.

    Null and empty texts are no duplicates of anything and stay; so do rows without an id; rows that repeat an id with another
    text are judged by that text; of rows that repeat id and text one stays; other columns pass through."""
    return minhash.drop_near_duplicates(docs)


def passages(spark, docs, sf_dir):
    """Bytes of strings that repeat in the corpus go, in every place where they stand.

    A null text becomes empty; repeated rows are copies of each other and lose what they share; a character cut through
    goes whole; other columns pass through."""
    return _columns(suffix_dedup.remove_repeats(docs, rewrite=True), docs)


def pack(spark, docs, sf_dir, capacity: int = 2048):
    """Token pieces and their places in sequences.

    Null and empty texts are a document of one end token; repeated rows and null ids are packed each; an empty
    table gives no pieces."""
    import public_tokenizers

    pieces = packing.token_pieces(docs, public_tokenizers.path("word_bpe_49k.json"), capacity)
    return packing.pack(pieces.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32")), capacity)


STAGES = [("quality rules", quality), ("line dedup", lines), ("near-duplicates", near_duplicates),
          ("passage dedup", passages), ("packing", pack)]

#: the first stage learns from data and the last plans by counts: no SQL
ORACLE_SQL = None


def run(spark, sf_dir):
    """Apply the stages to the documents of ``sf_dir``."""
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return docs
