"""The ``opN_*`` queries: thin digests over the operators of this package."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tradecast.llm import align, bpe, chat, jaccard, langid, lm, mixing, nearest, quality, search, shard, sketch, toxicity
from tradecast.llm.common import table


def op1_minimax_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard.minimax_shards(table(spark, sf_dir, "documents"), 8)


def op2_zstd_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_attention_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score(table(spark, sf_dir, "documents"))


def op4_scaled_sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sketch.fingerprints(table(spark, sf_dir, "documents"))


def op5_sainte_lague_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_counts(table(spark, sf_dir, "documents"))


def op6_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = jaccard.join_components(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_shingles", "component_id", "n_links")


def op7_toxicity_gbt(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_projected_knn(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest.nearest(table(spark, sf_dir, "embeddings"))


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(table(spark, sf_dir, "documents"))


def op10_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as a, open(public_tokenizers.path("piece_bpe_32k.model"), "rb") as b:
        return align.alignments(table(spark, sf_dir, "documents"), a.read(), b.read())


def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.digests(table(spark, sf_dir, "conversations"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_minimax_shards, op2_zstd_quality, op3_attention_lm, op4_scaled_sketch, op5_sainte_lague_mix, op6_ngram_jaccard_join, op7_toxicity_gbt, op8_projected_knn, op9_language_id, op10_byte_bpe,
                                     op11_token_alignment, op12_ranked_search, op13_chat_format)}


def oracle_sql() -> dict[str, str]:
    return {"op12_ranked_search": search.SQL, "op13_chat_format": chat.SQL}
