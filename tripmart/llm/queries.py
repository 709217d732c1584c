"""The operators over the given tables, as registered queries, and SQL where SQL can state them."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tripmart.llm import bitplanes, bpe, divergence, jaccard, languages, licenses, neighbours, packing, prefix_trie, privacy, quality, spotsigs, warc
from tripmart.llm.tables import read

#: Whoever holds the key can tell which surrogate belongs to an entity; a deployment gives its own.
SURROGATE_KEY = "tripmart"
#: Words to a shingle, and the threshold of the registered join.
OP7 = 3, jaccard.Threshold(90, 100)


def op1_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return bpe.round_trip(read(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN, whole=False)


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("word_bpe_49k.json")
    packed = packing.pack(read(spark, sf_dir, "documents"), path, capacity=4096, end=1)
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op3_neighbour_votes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op4_bit_planes(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.json")
    return bitplanes.round_trip(read(spark, sf_dir, "documents"), path, end=0)


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(read(spark, sf_dir, "documents"))


def op6_language_fusion(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = languages.fit_text(read(spark, sf_dir, "documents"))
    return languages.of_pages(read(spark, sf_dir, "pages"), model)


def op7_parity_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.join(read(spark, sf_dir, "documents"), *OP7)


def op8_spot_signatures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spotsigs.edited(read(spark, sf_dir, "documents"), whole=False)


def op9_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    replaced = privacy.replace(read(spark, sf_dir, "documents"), key=SURROGATE_KEY)
    return replaced.select("doc_id", "text", "n_entities", "entity_kinds")


def op10_vantage_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest_of(read(spark, sf_dir, "embeddings"), every=50, k=5, factor=1.0)


def op11_warc_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(read(spark, sf_dir, "pages"))


def op12_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.trie(read(spark, sf_dir, "conversations"))


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(read(spark, sf_dir, "documents"))


QUERIES = {
    "op1_byte_bpe": op1_byte_bpe,
    "op2_best_fit_packing": op2_best_fit_packing,
    "op3_neighbour_votes": op3_neighbour_votes,
    "op4_bit_planes": op4_bit_planes,
    "op5_license_scan": op5_license_scan,
    "op6_language_fusion": op6_language_fusion,
    "op7_parity_join": op7_parity_join,
    "op8_spot_signatures": op8_spot_signatures,
    "op9_surrogates": op9_surrogates,
    "op10_vantage_trees": op10_vantage_trees,
    "op11_warc_ranges": op11_warc_ranges,
    "op12_conversation_trie": op12_conversation_trie,
    "op13_source_divergence": op13_source_divergence,
}

ORACLES = {
    "op5_license_scan": licenses.SQL,
    "op7_parity_join": jaccard.sql(*OP7),
    "op11_warc_ranges": warc.SQL,
    "op12_conversation_trie": prefix_trie.SQL,
    "op13_source_divergence": divergence.SQL,
}
