"""The words that the byte-pair encoder folds in advance."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from tradecast.llm import bpe


def test_the_table_counts_the_words_of_all_documents(spark, monkeypatch):
    """F8: no document is left out of the counts, however many there are."""
    n = 45_000
    word = F.translate(F.col("id").cast("string"), "0123456789", "abcdefghij")
    rare = F.when(F.col("id") >= n - 3, F.lit(" rare")).otherwise(F.lit(""))
    docs = spark.range(n).select(F.col("id").alias("doc_id"), F.concat(F.lit("zz "), word, rare).alias("text"))
    words = {r["word"] for r in bpe.frequent_words(docs, public_tokenizers.PATTERN).collect()}
    assert len(words) == n + 2
    for most, want in ((1, ["zz"]), (2, [" rare", "zz"]), (4, [" a", " b", " rare", "zz"])):
        monkeypatch.setattr(bpe, "TABLE_WORDS", most)
        assert sorted(r["word"] for r in bpe.frequent_words(docs, public_tokenizers.PATTERN).collect()) == want
    assert bpe.frequent_words(docs.where("false"), public_tokenizers.PATTERN).collect() == []
