"""The training-data pipeline: five operators of ``tradecast.llm`` in a row.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir)
and returns a DataFrame, which is written as Parquet and read again as the
docs of the next.  All but the last return the columns of ``documents``.
Null ids and texts, repeated rows, extra columns and empty tables pass; what
becomes of them is said at each operator.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradecast.llm import bpe, jaccard, langid, mixing, toxicity
from tradecast.llm.common import fold_of, saved, shielded, table

UNDETERMINED = 0.4  # least share of the likelihood of the winning language
TOXIC = 0.5         # calibrated score from which a document goes


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents without a language that can be told: no letters, or no
    language clearly ahead."""
    model = langid.fit(docs.where(fold_of(F.col("doc_id"), 3) != 1))
    rows, back = shielded(docs, ("text",))
    told = langid.predict(rows, model)
    return back(told.where((F.col("lang_pred") != "und") & (F.col("score") >= UNDETERMINED)))


def civility(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects toxic documents; none, if the labels to learn from (all but fold 0)
    are not of both classes."""
    labels = table(spark, sf_dir, "labels")
    toxic = F.col("toxic") > 0
    seen = labels.where(fold_of(F.col("doc_id"), 5) != 0).agg(F.min(toxic), F.max(toxic)).first()
    if tuple(seen) != (False, True):
        return docs
    rows, back = shielded(docs, ("doc_id", "text"))
    scored = toxicity.score(rows, labels, keep_text=True)
    return back(scored.where(F.col("score") < TOXIC))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document, the one of smallest id, of each group that n-gram
    Jaccard links join; repeated rows once.  Of rows of one id and text that
    differ elsewhere it keeps the one whose other columns come first as strings."""
    found = jaccard.join_components(docs)
    no_id = F.lit((1 << 63) - 1)  # a plain join key: rows and kept pairs are dealt once, by the same two columns
    kept = found.where("representative").select(F.coalesce("doc_id", no_id).alias("_id"), F.col("text_hash").alias("_hash")).distinct()
    rows, back = shielded(docs, ("doc_id", "text"))
    first = F.struct(F.col("text").isNull(), *[F.col(c).cast("string") for c in rows.columns if c != "text"])
    once = rows.groupBy(F.coalesce(F.col("doc_id").cast("long"), no_id).alias("_id"),
                        F.xxhash64(F.coalesce(F.col("text"), F.lit(""))).alias("_hash")).agg(
        F.min_by(F.struct(*rows.columns), first).alias("_row"))
    return back(once.join(kept, ["_id", "_hash"], "left_semi").select("_row.*"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeats or drops documents, so that each source has its target share."""
    return mixing.mix_documents(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, source, n_tokens, ids and the bytes' digest after decoding them."""
    ranks = bpe.load_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    coded = bpe.encode(docs.select("doc_id", "source", "text"), ranks, public_tokenizers.PATTERN, keep_text=False)
    return coded.select("doc_id", "source", F.size("ids").cast("long").alias("n_tokens"), "ids",
                        F.sha2(bpe.decode(F.col("ids"), ranks), 256).alias("decoded_sha256"))


STAGES = [
    ("language ID", language),
    ("toxicity", civility),
    ("n-gram Jaccard join", near_duplicates),
    ("mixing sources to target weights", mix),
    ("byte-level BPE encoding and decoding", tokens),
]

#: Trained models and seeded selection are beyond SQL; see tests/llm.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies the stages to ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = saved(docs, f"pipeline-{i}")
    return docs
