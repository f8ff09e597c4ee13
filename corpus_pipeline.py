"""The training-data pipeline: documents that are neither toxic, boilerplate,
near copies of one another nor benchmark leaks, mixed to source weights.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last
return the columns of ``docs``. Rows keep their other columns untouched. Null and
repeated ids, null texts, ties and empty tables are handled as the operators of
the stages state; a document is never dropped for its id."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwheel.llm import decontaminate, line_dedup, near_copies, pfair_mix, toxicity
from cartwheel.llm.common import staged
from cartwheel.llm.queries import MIX_BLOCK_ROWS, MIX_OTHER_SHARE, MIX_SHARES
from cartwheel.session import drop_staged
from cartwheel.sources.tables import read_table


def _columns(docs: DataFrame) -> list[str]:
    return [f"`{c}`" for c in docs.columns]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose predicted probability of being toxic is below one half."""
    model = toxicity.train_model(docs, read_table(spark, sf_dir, "labels"), "toxic")
    return toxicity.score_toxicity(docs, model, out_col="_toxicity").where(F.col("_toxicity") < 0.5) \
        .select(*_columns(docs))


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, its text without lines found in ten or more documents."""
    out = line_dedup.dedup_lines(docs, min_docs=10, min_chars=1)
    changed = {"text": F.col("kept_text"), "n_chars": F.char_length("kept_text").cast("long")}
    kept = F.col("n_dropped") == 0
    return out.select(*[F.when(kept, F.col(f"`{c}`")).otherwise(changed[c]).alias(c) if c in changed else F.col(f"`{c}`")
                        for c in docs.columns])


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies (five-word shingles, Jaccard 0.8 or more, and
    whatever they link) the document of the smallest id."""
    return near_copies.drop_near_copies(docs, width=5, percent=80)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any ten-word window of a benchmark item."""
    found = decontaminate.find_contamination(docs, read_table(spark, sf_dir, "benchmark"), window=10)
    return found.where(F.col("n_hit") == 0).select(*_columns(docs))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document with its place in the mix, files in the order of the mix."""
    mixed = pfair_mix.mix_sources(docs, MIX_SHARES, MIX_OTHER_SHARE, MIX_BLOCK_ROWS)
    return mixed.repartitionByRange("mix_position").sortWithinPartitions("mix_position")


STAGES = [
    ("toxicity", drop_toxic),
    ("line dedup", drop_repeated_lines),
    ("n-gram Jaccard join", drop_near_copies),
    ("benchmark decontamination", drop_leaks),
    ("mixing sources to target weights", mix),
]

# A trained classifier decides the first stage, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``, writing each stage's result as
    Parquet below the shared checkpoint folder and reading it for the next."""
    docs = read_table(spark, sf_dir, "documents")
    before = None
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
        if before is not None:
            drop_staged(before)
        before = docs
    return docs
