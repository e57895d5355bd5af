"""The thin registered queries of the operators; each applies its operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.llm import langid, toxicity
from riskloom.llm.bm25_packing import pack
from riskloom.llm.conversation_trie import prefix_trie, sequences, with_shared_heads
from riskloom.llm.decontaminate import find_hits
from riskloom.llm.frames import table
from riskloom.llm.licenses import scan
from riskloom.llm.quality import assess
from riskloom.llm.ranked_search import rank
from riskloom.llm.simhash import near_duplicates
from riskloom.llm.suffix_dedup import dedup
from riskloom.llm.token_counts import count_edited
from riskloom.llm.token_files import read_documents, write_sequences
from riskloom.llm.warc import read_archives, resolve, write_archives


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = find_hits(docs, table(spark, sf_dir, "benchmark"), n=10)
    hit = F.aggregate(F.transform("hits.runs", lambda r: r["words"]), F.lit(0).cast("long"), lambda a, b: a + b)
    return found.select(
        "doc_id", F.col("hits.n_words").alias("n_words"), hit.alias("n_hit"),
        F.size("hits.items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.sort_array("hits.items"), ","), 256).alias("items_sha256"),
        (F.size("hits.runs") > 0).alias("contaminated"))


def op2_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "licenses.*")


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    found = count_edited(table(spark, sf_dir, "documents").select("doc_id", "text"), vocabulary("byte_bpe_50k.json"),
                         public_tokenizers.PATTERN)
    return found.select("doc_id", "counts.*")


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = assess(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "quality_rules.*")


def vocabulary(name: str) -> str:
    """Path of a public vocabulary file."""
    import public_tokenizers
    return public_tokenizers.path(name)


def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = write_sequences(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"), end_id=0)
    return read_documents(manifest).select("doc_id", "start", "n_tokens", "ids_crc32")


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents"), max_bits=3, words_per_shingle=3)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = dedup(table(spark, sf_dir, "documents").select("doc_id", "text"), length=400, with_text=False)
    return found.select("doc_id", "dedup.n_bytes", "dedup.n_removed", "dedup.n_spans", "dedup.kept_sha256",
                        (F.col("dedup.n_removed") > 0).alias("repeated"))


def op8_bm25_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = pack(table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"), end_id=1, with_ids=False)
    return pieces.drop("ids")


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = write_archives(resolve(table(spark, sf_dir, "pages")))
    return read_archives(manifest, with_payload=False).select(
        F.col("key").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to")


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model).select(
        "doc_id", (toxicity.fold("doc_id") == toxicity.HELD_OUT).alias("held_out"), "toxicity.score", "toxicity.predicted")


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = rank(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=50)
    return found.select(F.col("item").alias("item_id"), "rank", F.col("document").alias("doc_id"), "score")


def op12_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(with_shared_heads(sequences(table(spark, sf_dir, "conversations")), group=5, heads=9))


def op13_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    fold = langid.fold("doc_id")
    filters = langid.fit(docs, fold != langid.HELD_OUT)
    found = langid.identify(docs, filters, keep=["doc_id"])
    return found.select("doc_id", F.coalesce(fold == langid.HELD_OUT, F.lit(False)).alias("held_out"),
                        "language.lang_pred", "language.score")


def all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {"op1_decontaminate": op1_decontaminate, "op2_licenses": op2_licenses, "op3_token_counts": op3_token_counts,
            "op4_quality_rules": op4_quality_rules, "op5_token_files": op5_token_files,
            "op6_simhash": op6_simhash,
            "op7_suffix_dedup": op7_suffix_dedup, "op8_bm25_packing": op8_bm25_packing, "op9_warc": op9_warc,
            "op10_toxicity": op10_toxicity, "op11_ranked_search": op11_ranked_search,
            "op12_conversation_trie": op12_conversation_trie, "op13_language_id": op13_language_id}
