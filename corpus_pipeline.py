"""Documents to training sequences: good texts in known languages, one of each group, without private data, packed.

Each stage is given all that the one before kept. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tripmart.llm import jaccard, languages, packing, privacy, quality
from tripmart.llm.queries import SURROGATE_KEY
from tripmart.llm.tables import prepared, read, written

#: Pieces of texts whose ids a worker keeps while it packs: the stages before have filled an executor's memory.
KNOWN_PIECES = 200_000


def good_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the votes of their nearest labelled texts don't call bad."""
    return quality.keep_good(docs, read(spark, sf_dir, "labels"))


def known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is known."""
    return languages.keep_known(docs, languages.fit_text(docs))


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by sets of five-word shingles that are alike to 0.8 or more."""
    return jaccard.keep_one(docs, width=5, threshold=jaccard.Threshold(80, 100))


def without_private_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with surrogates in the place of personal data and secrets."""
    return privacy.replaced_rows(docs, SURROGATE_KEY).select("whole.*")


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents with their places in sequences of at most 4096 tokens."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), capacity=4096, end=1, known=KNOWN_PIECES)


STAGES = [
    ("quality_votes", good_texts),
    ("language_fusion", known_languages),
    ("parity_join", one_of_each),
    ("surrogates", without_private_data),
    ("best_fit_packing", sequences),
]

#: The classifier, the language model and the tokenizer aren't expressible in SQL; tests hold the stages against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``; each stage's result is written, and read by the next."""
    docs = read(prepared(spark), sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
