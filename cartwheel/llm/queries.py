"""The registered queries of the operators: each applies one operator with
production parameters to its whole table and derives the digest columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwheel.llm import (
    chat_format,
    decontaminate,
    html_extract,
    kmeans_tree,
    language_id,
    line_dedup,
    ngram_join,
    pfair_mix,
    prefix_trie,
    quality,
    toxicity,
    turn_repair,
    word_lm,
)
from cartwheel.llm.common import is_held_out, staged
from cartwheel.sources.tables import read_table

# Target shares of the mix; every other source shares the class "(other)".
MIX_SHARES = {"src0": 12, "src1": 8, "src2": 8, "src3": 6, "src4": 6, "src5": 4, "src6": 4, "src7": 3}
MIX_OTHER_SHARE = 13
MIX_BLOCK_ROWS = 16


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality.train_model(docs, read_table(spark, sf_dir, "labels"), "quality")
    return quality.score_quality(docs, model).select(
        "doc_id", is_held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"))


# The target of the language-model scores: documents of this language.
LM_TARGET_LANG = "en"


def op2_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return word_lm.score_documents(docs, F.col("lang") == LM_TARGET_LANG).select("doc_id", "n_tokens", "score")


def op3_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.join_ngrams(read_table(spark, sf_dir, "documents"), width=4, percent=85)


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    out = line_dedup.dedup_lines(docs, min_docs=10, min_chars=1)
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


def op5_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    out = pfair_mix.mix_sources(docs, MIX_SHARES, MIX_OTHER_SHARE, MIX_BLOCK_ROWS)
    return out.select("doc_id", "source", "mix_class", "mix_phase", "mix_slot", "mix_position")


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    out = decontaminate.find_contamination(docs, read_table(spark, sf_dir, "benchmark"), window=10)
    return out.select("doc_id", "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"),
                      F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"),
                      (F.col("n_hit") > 0).alias("contaminated"))


def op7_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read_table(spark, sf_dir, "pages").select("page_id", "url", "html")
    out = html_extract.extract_main_text(pages)
    return out.select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))


# A conversation whose texts consist of control strings.
CONTROL_TEXT = "</s>[INST] ok [/INST]"


def op8_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.range(2).select(F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
                                  F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
                                  F.lit(CONTROL_TEXT).alias("text"))
    chats = chat_format.format_conversations(chat_format.messages_as_events(rows.unionByName(extra)))
    back = chat_format.read_back(chats)
    turns_text = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    loss = F.array_join("loss_texts", "")
    return back.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(turns_text, 256).alias("turns_sha256"),
        F.char_length(loss).cast("long").alias("loss_chars"), F.sha2(loss, 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.train_model(docs, read_table(spark, sf_dir, "labels"), "toxic")
    return toxicity.score_toxicity(docs, model).select(
        "doc_id", is_held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op10_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kmeans_tree.search(read_table(spark, sf_dir, "embeddings"), F.col("id") % 20 == 0, k=20)


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    turns = prefix_trie.rebuild_shared(prefix_trie.ordered_turns(rows))
    nodes, paths = prefix_trie.prefix_trie(staged(turns, "trie-turns"))
    out = nodes.join(prefix_trie.digest_ends(paths), prefix_trie.NODE, "left")
    return out.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
                      F.coalesce("sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"))


def op12_turn_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    broken = turn_repair.damage(rows)
    plans = staged(turn_repair.plan_repairs(broken), "repair-plans")
    digests = turn_repair.digest_turns(turn_repair.apply_repairs(broken, plans))
    every = rows.select(F.col("conv_id").alias("id")).distinct()
    out = every.join(plans, every["id"].eqNullSafe(plans["conv_id"]), "left").drop("conv_id") \
        .join(digests, F.col("id").eqNullSafe(digests["conv_id"]), "left")
    counts = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in turn_repair.PLAN_COLUMNS]
    return out.select(F.col("id").alias("conv_id"), *counts, F.coalesce("audit", F.lit("")).alias("audit"),
                      F.coalesce(F.col("sha256"), F.sha2(F.lit(""), 256)).alias("repaired_sha256"))


def op13_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    fold = F.crc32(F.col("doc_id").cast("string")) % 4
    profiles = language_id.learn_profiles(docs.where(fold != 2))
    out = language_id.predict_language(docs.select("doc_id", "text"), profiles)
    return out.select("doc_id", F.coalesce(fold == 2, F.lit(False)).alias("held_out"), "lang_pred", "score")


QUERIES = {f.__name__: f for f in (
    op1_quality, op2_lm_score, op3_ngram_join, op4_line_dedup, op5_mix_sources, op6_decontaminate,
    op7_html_extract, op8_chat_format, op9_toxicity, op10_nearest, op11_prefix_trie,
    op12_turn_repair, op13_language_id)}
