"""Queries of the subpackage by name, with production parameters, and the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from tillroll.llm import bpe, chat, exact, fingerprints, html_content, jaccard, lattice, packing, quality, repair, runs, sharding, sql, toxicity

Query = Callable[[SparkSession, str], DataFrame]

MULTI_RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
#: The vocabulary of byte_bpe_50k.json as ranks: the same ids.
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
CAPACITY = 2048
SHARDS = [f"shard-{i:02}" for i in range(32)]


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    return quality.assess(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op2_sharding(spark: SparkSession, folder: str) -> DataFrame:
    return sharding.place(table(spark, folder, "documents").select("doc_id"), SHARDS)


def op3_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.assess(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op4_ngram_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard.similar_documents(table(spark, folder, "documents"))


def op5_chat_formatting(spark: SparkSession, folder: str) -> DataFrame:
    conversations = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    own = spark.createDataFrame(
        [(-1, turn, role, "</s>[INST] ok [/INST]") for turn, role in enumerate(("user", "assistant"))], conversations.schema
    )
    return chat.read_back(chat.chat_examples(conversations.unionByName(own)))


def op6_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return bpe.bpe_round_trip(table(spark, folder, "documents"), MULTI_RANKS, public_tokenizers.PATTERN)


def op7_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    return fingerprints.edited_fingerprints(table(spark, folder, "documents"))


def op8_embedding_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return lattice.similar_vectors(table(spark, folder, "embeddings"))


def op9_html_extraction(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages").select("page_id", "url", "html")
    texts = html_content.extract_main_text(pages, html_content.train(pages))
    return texts.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op10_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    return pack(table(spark, folder, "documents"))


def pack(documents: DataFrame) -> DataFrame:
    return packing.pack_documents(documents, RANKS, public_tokenizers.PATTERN, CAPACITY, special=packing.special_strings(VOCABULARY))


def op11_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact.exact_groups(table(spark, folder, "documents"))


def repeated(documents: DataFrame) -> DataFrame:
    """doc_id and text, some of them (crc32 of doc_id divisible by 10) with a tail that repeats a period of words.

    With g the tenth of the hash, word i >= a becomes word a + (i - a) % p of
    the text: a = g % n, p = 1 + (n - a) div (3 + g % 8). A null doc_id counts as
    an empty text.
    """
    hashed = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    words = F.when(hashed % 10 == 0, F.regexp_extract_all(F.col("text"), F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0)))
    n, g = F.col("n"), F.call_function("div", F.col("h"), F.lit(10))
    rows = documents.select("doc_id", "text", hashed.alias("h"), words.alias("words")).withColumn("n", F.size("words").cast("long"))
    some = n > 0
    rows = rows.withColumn("a", F.when(some, g % n)).withColumn("p", 1 + F.call_function("div", n - F.col("a"), 3 + g % 8))
    tail = F.transform(F.sequence(F.lit(0).cast("long"), n - F.col("a") - 1), lambda i: F.get("words", (F.col("a") + i % F.col("p")).cast("int")))
    joined = F.array_join(F.concat(F.slice("words", F.lit(1), F.col("a").cast("int")), tail), " ")
    return rows.select("doc_id", F.when(some, joined).otherwise(F.col("text")).alias("text"))


def run_digests(found: DataFrame) -> DataFrame:
    """The runs of find_runs as numbers and digests: the longest run, and hashes of all runs and of the words that are left."""
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"], -r["start"], -r["period"], r["start"].alias("start"), r["period"].alias("period"))))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", *(r[x].cast("string") for x in ("start", "length", "period"))), F.lit("\n")))
    rows = found.withColumns({"best": best, "lines": F.array_join(lines, "")})
    return rows.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        F.col("best.start").alias("start"),
        F.col("best.length").alias("length"),
        F.col("best.period").alias("period"),
        F.call_function("div", 1000 * F.col("best.length"), F.col("best.period")).alias("exponent_milli"),
        F.sha2("lines", 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op12_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    return run_digests(runs.find_runs(repeated(table(spark, folder, "documents"))))


def damaged(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role and text with faults by crc32 of `conv_id:turn`, modulo 20.

    0: the row goes; 1: no text; 2: no . ! ?; 3: the row twice; 4: the role is
    user. Null roles and texts, and null numbers in the hashed text, are one space.
    """
    space = F.lit(" ")
    number = lambda name: F.coalesce(F.col(name).cast("string"), space)
    fault, text = F.crc32(F.concat(number("conv_id"), F.lit(":"), number("turn"))) % 20, F.coalesce("text", space)
    rows = conversations.select("conv_id", "turn", F.coalesce("role", space).alias("role"), text.alias("text"), fault.alias("fault")).where("fault > 0")
    fault = F.col("fault")
    changed = rows.withColumns(
        {
            "text": F.when(fault == 1, "").when(fault == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")),
            "role": F.when(fault == 4, "user").otherwise(F.col("role")),
        }
    )
    times = F.explode(F.when(fault == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    return changed.select("conv_id", "turn", "role", "text", times.alias("copy")).drop("copy")


def repair_digests(edits: DataFrame, summary: DataFrame) -> DataFrame:
    """The summary and a hash of each conversation's repaired turns, which are one text for the purpose."""
    line = F.concat("role", F.lit(":"), "text")
    turns = edits.where("edit <> 'D'").groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("id", "step", line.alias("line")))).alias("turns"))
    repaired = F.array_join(F.transform("turns", lambda x: x["line"]), "\n")
    hashed = turns.select(F.col("conv_id").alias("conv"), F.sha2(repaired, 256).alias("repaired_sha256"))
    joined = summary.join(hashed, summary["conv_id"].eqNullSafe(hashed["conv"]), "left").drop("conv")
    return joined.withColumn("repaired_sha256", F.coalesce("repaired_sha256", F.sha2(F.lit("").cast("binary"), 256)))


def op13_conversation_repair(spark: SparkSession, folder: str) -> DataFrame:
    conversations = table(spark, folder, "conversations")
    return repair_digests(*repair.repairs(damaged(conversations), every=conversations))


QUERIES: dict[str, Query] = {
    "op1_quality_classifier": op1_quality_classifier,
    "op2_sharding": op2_sharding,
    "op3_toxicity": op3_toxicity,
    "op4_ngram_jaccard_join": op4_ngram_jaccard_join,
    "op5_chat_formatting": op5_chat_formatting,
    "op6_byte_bpe": op6_byte_bpe,
    "op7_fingerprints": op7_fingerprints,
    "op8_embedding_near_dedup": op8_embedding_near_dedup,
    "op9_html_extraction": op9_html_extraction,
    "op10_best_fit_packing": op10_best_fit_packing,
    "op11_exact_dedup": op11_exact_dedup,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_conversation_repair": op13_conversation_repair,
}

SQL: dict[str, str] = {
    "op2_sharding": sql.SHARDING,
    "op5_chat_formatting": sql.CHAT,
    "op11_exact_dedup": sql.EXACT,
    "op13_conversation_repair": sql.REPAIR,
}
