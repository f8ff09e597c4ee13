"""One document of each group of near copies.

A row is known by a hash of its id and text, so repeated and null ids keep rows
apart: of a group (shingle sets that link, and whatever they link) the row of
the smallest id stays, nulls last, ties by that hash. Rows of equal id and text are
one document: one of them stays. Null, empty or blank texts link with nothing and
all stay, repeated ones too. Other columns stay as they are; an empty table gives
an empty table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwheel.llm.common import staged
from cartwheel.llm.ngram_join import join_ngrams
from cartwheel.session import drop_staged

ROW = "_nc_row"


def drop_near_copies(docs: DataFrame, width: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with its columns."""
    plain = [F.col(f"`{c}`") for c in docs.columns]
    keyed = docs.select(*plain, F.xxhash64(F.col(f"`{id_col}`"), F.col(f"`{text_col}`")).alias(ROW))
    ids = keyed.select(ROW, F.col(f"`{id_col}`").alias("_nc_id"), F.col(f"`{text_col}`").alias("_nc_text"))
    joined = join_ngrams(ids, width, percent, ROW, "_nc_text").where(F.col("n_shingles") > 0)
    rows = staged(joined.groupBy(ROW).agg(F.first("component_id").alias("group"), F.count(F.lit(1)).alias("copies")), "near-copies")
    named = rows.join(ids.select(ROW, "_nc_id").distinct(), ROW)
    first = staged(named.groupBy("group").agg(F.min(F.struct(F.col("_nc_id").isNull(), F.col("_nc_id"), F.col(ROW))).alias("first"))
                   .select("group", F.col("first." + ROW).alias("stays")), "near-copies-first")
    gone = staged(rows.join(first, "group").where(F.col(ROW) != F.col("stays")).select(ROW), "near-copies-gone")
    repeated = staged(rows.where(F.col("copies") > 1).select(ROW).join(gone, ROW, "left_anti"), "near-copies-repeated")
    drop_staged(rows, first)
    kept = keyed.join(gone, ROW, "left_anti")
    once = kept.join(repeated, ROW, "left_semi").groupBy(ROW).agg(F.min(F.struct(*plain)).alias("row"))
    return kept.join(repeated, ROW, "left_anti").select(*plain).unionByName(once.select(*[F.col(f"row.`{c}`") for c in docs.columns]))
