"""The operators as queries over the test tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rankwright.llm import bpe, chat, fingerprints, html, katz, middle, minhash, packing, quality, sharding, spans, topk, trie
from rankwright.llm.common import table, whole_text, word_bpe_path
from rankwright.llm.neighbours import with_next

Query = Callable[[SparkSession, str], DataFrame]


def op1_sum_of_squares_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack_documents(table(spark, sf_dir, "documents"), word_bpe_path())
    return pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


def op2_katz_backoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    trained = F.crc32(F.col("doc_id").cast("string")) % 5 != 1
    return katz.score_documents(table(spark, sf_dir, "documents"), trained)


def op3_prefix_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = bpe.encode_texts(table(spark, sf_dir, "documents"), word_bpe_path())
    return encoded.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op4_no_random_access(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), "vec_id % 50 = 0", k=5)


def op5_sentence_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = spans.remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return cleaned.select(
        "doc_id",
        F.col("clean_text").alias("text"),
        F.size("removed").cast("long").alias("n_ranges"),
        F.aggregate("removed", F.lit(0).cast("long"), lambda n, x: n + x["end"] - x["start"]).alias("removed_chars"),
        "removed",
    )


def op6_line_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return quality.judge_documents(docs).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "kept_words"
    )


def op7_line_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extract_pages(table(spark, sf_dir, "pages"))


def op8_fast_similarity_sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), width=3, percent=85)


def op9_rendezvous_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.shard_records(table(spark, sf_dir, "documents"), "doc_id", [1.0] * 40, added=[1.0])
    return placed.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")


def op10_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    sample = "\\### Assistant: </turn> ok"
    extra = spark.createDataFrame(
        [(-7, 0, "user", sample), (-7, 1, "assistant", sample)], "conv_id long, turn long, role string, text string"
    )
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    formatted = chat.format_chats(turns).withColumn("_read", chat.read_turns(F.col("formatted")))
    learned = chat.read_learned(F.col("segments"))
    return formatted.withColumn("_learned", learned).select(
        "conv_id",
        F.size("_read").cast("long").alias("n_turns"),
        F.sha2(
            F.array_join(F.transform("_read", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), ""), 256
        ).alias("turns_sha256"),
        F.length("_learned").cast("long").alias("loss_chars"),
        F.sha2("_learned", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
        "valid",
    )


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.prefix_trie(table(spark, sf_dir, "conversations"), every=20, most=3)


def op12_invertible_bloom_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", whole_text().alias("text"))
    paired = with_next(docs, "doc_id", "text", "next").withColumn("n_chars", F.length("text"))
    quarter = F.floor(F.col("n_chars") / 4).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), F.col("n_chars") - quarter), F.substring("next", F.lit(1), quarter))
    versions = paired.withColumn("edited", edited).withColumns(
        {"edited_sha256": F.sha2("edited", 256), "n_chars": F.col("n_chars").cast("long")}
    )
    compared = fingerprints.compare_versions(versions, ["doc_id", "n_chars", "edited_sha256"], "text", ["edited", "next"])
    return compared.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        "fingerprint",
        "edited_fingerprint",
        F.col("edited_likeness").alias("near_edited"),
        F.col("next_likeness").alias("near_next"),
        "n_paragraphs",
        F.size("edited_lost").cast("long").alias("n_lost"),
        F.size("edited_gained").cast("long").alias("n_gained"),
        "edited_cells",
        "next_cells",
    )


def op13_swar_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    moved = middle.fill_in_middle(table(spark, sf_dir, "documents"))
    restored = middle.restore_text(F.col("output"), F.col("form"))
    return moved.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        F.sha2("output", 256).alias("output_sha256"), F.sha2(restored, 256).alias("restored_sha256"),
    )


def queries() -> dict[str, Query]:
    return {
        "op1_sum_of_squares_packing": op1_sum_of_squares_packing,
        "op2_katz_backoff": op2_katz_backoff,
        "op3_prefix_bpe": op3_prefix_bpe,
        "op4_no_random_access": op4_no_random_access,
        "op5_sentence_spans": op5_sentence_spans,
        "op6_line_rules": op6_line_rules,
        "op7_line_blocks": op7_line_blocks,
        "op8_fast_similarity_sketch": op8_fast_similarity_sketch,
        "op9_rendezvous_sharding": op9_rendezvous_sharding,
        "op10_chat_format": op10_chat_format,
        "op11_prefix_trie": op11_prefix_trie,
        "op12_invertible_bloom_fingerprints": op12_invertible_bloom_fingerprints,
        "op13_swar_fill_in_middle": op13_swar_fill_in_middle,
    }
