"""The registered queries: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tablegate.llm import alignment, bpe, chunks, embeddings, fingerprints, jaccard, language, mixing, pieces, pii, toxicity, warc, whitening
from tablegate.llm.frames import find_package

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(f):
    QUERIES[f.__name__] = f
    return f


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    find_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_mix_sources(spark, sf_dir):
    """All documents mixed to three sizes of sources, 150 % of their words in all."""
    return mixing.mixed(_table(spark, sf_dir, "documents"))


@query
def op2_bpe(spark, sf_dir):
    """Every document encoded and decoded."""
    return bpe.token_digests(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@query
def op3_embedding_links(spark, sf_dir):
    """Every vector with its links of cosine 0.93 or more to vectors of its label, and its component."""
    return embeddings.near_duplicates(_table(spark, sf_dir, "embeddings"))


@query
def op4_repeated_passages(spark, sf_dir):
    """Passages of documents that stand in other documents too."""
    return chunks.repeated_passages(_table(spark, sf_dir, "documents"))


@query
def op5_warc(spark, sf_dir):
    """All pages written to WARC archives and read back."""
    return warc.archived(_table(spark, sf_dir, "pages")).drop("url")


@query
def op6_toxicity(spark, sf_dir):
    """The toxicity of every document, learned from two thirds of the labelled ones."""
    return toxicity.toxicity(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")).drop("spans")


@query
def op7_fingerprints(spark, sf_dir):
    """Fingerprints of every document, of its edited text, and their likeness."""
    return fingerprints.compared_with_edits(_table(spark, sf_dir, "documents"))


@query
def op8_ngram_jaccard(spark, sf_dir):
    """Documents grouped by the Jaccard similarity of their five-word shingles."""
    return jaccard.jaccard_groups(_table(spark, sf_dir, "documents"))


@query
def op9_language(spark, sf_dir):
    """The language of every document, learned from four fifths of the labelled ones."""
    return language.languages(_table(spark, sf_dir, "documents"))


@query
def op10_pii(spark, sf_dir):
    """Personal data in every document."""
    return pii.detected(_table(spark, sf_dir, "documents"))


@query
def op12_sentencepiece(spark, sf_dir):
    """Every document encoded by merges of pieces and decoded, each batch checked against the library."""
    return pieces.token_digests(_table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"), check=True)


@query
def op13_align_tokens(spark, sf_dir):
    """The tokens of two vocabularies aligned by bytes in every document."""
    paths = [public_tokenizers.path(x) for x in ("byte_bpe_50k.json", "piece_bpe_32k.model")]
    return alignment.aligned(_table(spark, sf_dir, "documents"), *paths)


@query
def op11_whitening(spark, sf_dir):
    """Every embedding in up to 32 uncorrelated components of variance one."""
    return whitening.whitened(_table(spark, sf_dir, "embeddings"))
