"""Registered queries of this package: opN_<name> over the whole input tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from .common import table
from .oracle import SQL


def _tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_minhash(spark, sf_dir):
    from .minhash import near_duplicates

    return near_duplicates(table(spark, sf_dir, "documents"))


def op2_token_counts(spark, sf_dir):
    from .token_counts import count_tokens

    return count_tokens(table(spark, sf_dir, "documents"), _tokenizer("piece_bpe_32k.model"))


def op3_line_dedup(spark, sf_dir):
    from .line_dedup import dedup_lines

    out = dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2(F.encode("text", "UTF-8"), 256).alias("kept_sha256"))


def op4_packing(spark, sf_dir):
    from .packing import pack, token_pieces

    pieces = token_pieces(table(spark, sf_dir, "documents"), _tokenizer("word_bpe_49k.json"))
    return pack(pieces.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32")))


def op5_language_id(spark, sf_dir):
    from .language_id import identify_with_folds

    return identify_with_folds(table(spark, sf_dir, "documents"))


def op6_byte_bpe(spark, sf_dir):
    import public_tokenizers

    from .byte_bpe import encode

    out = encode(table(spark, sf_dir, "documents"), _tokenizer("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, decoded=True)
    ids = F.concat_ws(" ", F.col("ids").cast("array<string>"))
    return out.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                      F.sha2(F.encode(ids, "UTF-8"), 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op7_quality_rules(spark, sf_dir):
    from .quality_rules import judge_quality

    return judge_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_suffix_dedup(spark, sf_dir):
    from .suffix_dedup import remove_repeats

    out = remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op9_lm_scoring(spark, sf_dir):
    from .lm_scoring import score_texts

    return score_texts(table(spark, sf_dir, "documents"))


def op10_embedding_dedup(spark, sf_dir):
    from .embedding_dedup import near_duplicates

    return near_duplicates(table(spark, sf_dir, "embeddings"))


def op11_phrases(spark, sf_dir):
    from .phrases import collocations

    return collocations(table(spark, sf_dir, "documents"))


def op12_spelling(spark, sf_dir):
    from .spelling import group_variants

    return group_variants(table(spark, sf_dir, "documents"))


def op13_html_extract(spark, sf_dir):
    from .html_extract import extract

    return extract(table(spark, sf_dir, "pages"))


QUERIES = {f.__name__: f for f in (op1_minhash, op2_token_counts, op3_line_dedup, op4_packing, op5_language_id,
                               op6_byte_bpe, op7_quality_rules, op8_suffix_dedup, op9_lm_scoring,
                               op10_embedding_dedup, op11_phrases, op12_spelling, op13_html_extract)}
ORACLE: dict[str, str] = SQL
