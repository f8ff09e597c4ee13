"""Line dedup across documents, with built-in functions only.

Lines are exploded with their position, normalised (ASCII white space stripped
at both ends, A-Z lower-cased) and hashed to 128 bits; documents are counted
per hash with partial aggregation; positions of lines whose hash is in at least
``min_docs`` documents are gathered per text and cut out of the line array, so
the text is reassembled by position.

Shuffles: (hash, document) pairs once, then partial counts; the texts
themselves move at most once, and not at all while the tables of frequent
hashes and of dropped positions stay below Spark's broadcast threshold. Both
are staged tables, so their size is known before the join, and a line or a
text that holds a third of all rows is split by the skew-join rule.

Defined results: null text counts as empty (one empty line); an empty key is
never dropped; documents are told apart by ``doc_id`` when counting, all rows
with a null id counting as one document; every row of a repeated text is
treated alike and none is dropped; input columns named like an added column
are replaced; an empty table gives an empty table. Two keys are taken as equal
when their 128-bit hashes are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartwheel.llm.common import A_TO_Z_LOWER, A_TO_Z_UPPER, hash_pair, staged, without

BLANKS = " \t\n\x0b\x0c\r"
ADDED = ("n_lines", "n_dropped", "kept_text")


def line_key(line: Column) -> Column:
    return F.translate(F.btrim(line, F.lit(BLANKS)), A_TO_Z_UPPER, A_TO_Z_LOWER)


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def _keyed_lines(docs: DataFrame, text: Column, ids: list[Column], min_chars: int) -> DataFrame:
    """One row per line with a countable key: ids, position, 128-bit key hash."""
    rows = docs.select(*ids, F.posexplode(_lines(text)).alias("_ld_pos", "_ld_line"))
    key = line_key(F.col("_ld_line"))
    h1, h2 = hash_pair(key)
    return rows.where(F.char_length(key) >= min_chars) \
        .select(*[c for c in rows.columns if c not in ("_ld_line",)], h1.alias("_ld_h1"), h2.alias("_ld_h2"))


def dedup_lines(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id",
                min_docs: int = 10, min_chars: int = 1) -> DataFrame:
    """All rows and columns of ``docs`` plus ``n_lines`` (before dropping),
    ``n_dropped`` and ``kept_text`` (the other lines joined by a newline)."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    t1, t2 = hash_pair(text)

    per_doc = _keyed_lines(docs, text, [F.col(id_col).alias("_ld_id")], min_chars) \
        .select("_ld_h1", "_ld_h2", "_ld_id").distinct()
    frequent = staged(per_doc.groupBy("_ld_h1", "_ld_h2").agg(F.count(F.lit(1)).alias("_ld_n"))
                      .where(F.col("_ld_n") >= min_docs).select("_ld_h1", "_ld_h2"), "frequent-lines")

    hits = _keyed_lines(docs, text, [t1.alias("_ld_t1"), t2.alias("_ld_t2")], min_chars) \
        .join(frequent, ["_ld_h1", "_ld_h2"])
    drops = staged(hits.groupBy("_ld_t1", "_ld_t2").agg(F.collect_set("_ld_pos").alias("_ld_drop")), "dropped-positions")

    joined = docs.withColumn("_ld_t1", t1).withColumn("_ld_t2", t2).join(drops, ["_ld_t1", "_ld_t2"], "left")
    split = joined.select(*without(docs, ADDED), text.alias("_ld_text"), _lines(text).alias("_ld_lines"), "_ld_drop")
    n = F.size("_ld_lines")
    kept = F.transform(F.array_except(F.sequence(F.lit(0), n - 1), F.col("_ld_drop")),
                       lambda p: F.get(F.col("_ld_lines"), p))
    return split.select(
        *without(docs, ADDED), n.cast("long").alias("n_lines"),
        F.when(F.col("_ld_drop").isNull(), F.lit(0)).otherwise(F.size("_ld_drop")).cast("long").alias("n_dropped"),
        F.when(F.col("_ld_drop").isNull(), F.col("_ld_text")).otherwise(F.array_join(kept, "\n")).alias("kept_text"))
