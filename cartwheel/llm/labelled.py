"""Labelled rows for the classifiers: the training fold and its bounded sample."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwheel.llm.common import is_held_out


def training_sample(docs: DataFrame, labels: DataFrame, label_col: str, rows: int,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``text, label`` of at most ``rows`` labelled documents outside the
    held-out fold, chosen by a hash of the id. Rows without id, label or a 0/1
    label are left out; a document labelled repeatedly gets its mean label,
    rounded (ties to 1). The id table has at most ``rows`` rows, which bounds
    the broadcast."""
    label = F.col(label_col).cast("int")
    known = labels.where(F.col(id_col).isNotNull() & label.isin(0, 1) & ~is_held_out(F.col(id_col)))
    chosen = known.groupBy(F.col(id_col).alias("_lb_id")).agg(F.avg(label).alias("_lb_mean")) \
        .orderBy(F.xxhash64("_lb_id"), "_lb_id").limit(rows) \
        .select("_lb_id", (F.col("_lb_mean") >= 0.5).cast("int").alias("label"))
    return docs.join(F.broadcast(chosen), F.col(id_col) == F.col("_lb_id")) \
        .select(F.col(text_col).cast("string").alias("text"), "label")
