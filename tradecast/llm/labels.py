"""Labelled rows for the classifiers of this package."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradecast.llm.common import fold_of, saved

FOLDS = 5


def training_labels(labels: DataFrame, column: str, most: int, name: str) -> DataFrame:
    """(``doc_id``, ``label`` 0/1, ``fold``) of the rows in folds 1 to 4 whose
    label is not null, one for each id (1 if its labels disagree); about
    ``most`` of them, chosen by a hash of the id.  Fold 0 is held out."""
    rows = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), (F.col(column) > 0).cast("int").alias("label"))
            .where(F.col("doc_id").isNotNull() & F.col("label").isNotNull() & (fold_of(F.col("doc_id"), FOLDS) != 0))
            .groupBy("doc_id").agg(F.max("label").alias("label")).withColumn("fold", fold_of(F.col("doc_id"), FOLDS)))
    rows = saved(rows, name)
    n = rows.count()
    if n <= most:
        return rows
    return rows.where((F.xxhash64(F.lit(column), "doc_id") / F.lit(2.0 ** 64) + 0.5) < most / n)
