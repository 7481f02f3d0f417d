"""Documents to tokens: quality, language, near copies, benchmark passages, pieces."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from foliary.llm import crossparse, pieces, pigeonring, quality, tiling
from foliary.llm.frames import without, write_and_read
from foliary.llm.queries import read, tokenizer_file


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    return quality.keep_good(docs, read(spark, sf_dir, "labels"))


def in_known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a letter; each is given one of the languages that label them."""
    return crossparse.keep_known(docs)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by fingerprints of 4-word shingles that differ in 4 bits or fewer."""
    return pigeonring.keep_one(docs)


def unseen(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return tiling.keep_clean(docs, read(spark, sf_dir, "benchmark"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of the pieces, where each piece ends in the text's bytes, and digests."""
    plain = without(docs, "n_tokens", "ids_sha256", "decoded_sha256", "n_bytes", "spans_crc32", "ids", "span_ends", "decoded")
    return pieces.encode_documents(plain, tokenizer_file("piece_bpe_32k.model"), keep=["doc_id"], lists=False)


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
STAGES: list[tuple[str, Stage]] = [
    ("quality classifier", good), ("language ID", in_known_language), ("SimHash near-dedup", one_of_each),
    ("benchmark decontamination", unseen), ("SentencePiece encoding and decoding", tokens),
]
#: A learned classifier and a language model of text cannot be said in SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written down before the next."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = write_and_read(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
