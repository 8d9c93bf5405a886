"""The registered queries of the training-data operators, and their DuckDB SQL.

Each reads its whole table.  Queries without SQL are held against
brute-force versions in ``tests/llm``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from kestrel.llm import (
    alignment, conversations, licenses, mixing, neardup, neighbours, oracle, quality, secret_scan, sentences, suffixes, tiling,
    warc, wavelet)
from kestrel.llm.common import read

TOKENIZER = "byte_bpe_50k.json"
PIECES = "piece_bpe_32k.model"


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def op1_wavelet_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wavelet.tokenized(read(spark, sf_dir, "documents"), tokenizer_path())


def op2_license_sentences(spark, sf_dir):
    return licenses.license_report(read(spark, sf_dir, "documents"))


def op3_minhash_postings(spark, sf_dir):
    return neardup.near_duplicates(read(spark, sf_dir, "documents")).select(
        "doc_id", "n_shingles", "component_id", "kept")


def op4_sainte_lague_mix(spark, sf_dir):
    return mixing.mixed(read(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken")


def op5_block_neighbours(spark, sf_dir):
    return neighbours.search_multiples(read(spark, sf_dir, "embeddings"), 50)


def op6_string_tiling(spark, sf_dir):
    return tiling.contaminated(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark")).select(
        "doc_id", "item_id", "tiles", "matched_words", "item_words", "coverage")


def op7_induced_suffixes(spark, sf_dir):
    return suffixes.without_repeats(read(spark, sf_dir, "documents")).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op8_secret_entropy(spark, sf_dir):
    return secret_scan.secret_report(read(spark, sf_dir, "documents"))


def op9_quality_scores(spark, sf_dir):
    return quality.quality_report(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op10_warc_archives(spark, sf_dir):
    return warc.archived_pages(read(spark, sf_dir, "pages"))


def op11_conversation_repair(spark, sf_dir):
    rows = read(spark, sf_dir, "conversations")
    return conversations.repair_report(conversations.damaged(rows), rows)


def op12_sentence_pieces(spark, sf_dir):
    return sentences.encoding_report(read(spark, sf_dir, "documents"), tokenizer_path(PIECES))


def op13_token_alignment(spark, sf_dir):
    return alignment.alignment_report(read(spark, sf_dir, "documents"), tokenizer_path(), tokenizer_path(PIECES))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (
    op1_wavelet_tokens, op2_license_sentences, op3_minhash_postings, op4_sainte_lague_mix,
    op5_block_neighbours, op6_string_tiling, op7_induced_suffixes, op8_secret_entropy,
    op9_quality_scores, op10_warc_archives, op11_conversation_repair, op12_sentence_pieces,
    op13_token_alignment)}

ORACLE_SQL: dict[str, str] = {
    "op2_license_sentences": oracle.license_sql(), "op3_minhash_postings": neardup.ORACLE,
    "op8_secret_entropy": oracle.secret_sql(), "op10_warc_archives": warc.ORACLE}
