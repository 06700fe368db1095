"""The registered queries of this subpackage and their SQL counterparts.

Each reads its whole tables. The digest columns come from the operators' results.
"""

import public_tokenizers
from pyspark.sql import functions as F

from gaugeflow.llm import language_id, quality_classifier
from gaugeflow.llm.decontamination import leaked_items
from gaugeflow.llm.near_dedup import near_duplicates
from gaugeflow.llm.oracles import ORACLES  # noqa: F401
from gaugeflow.llm.packing import pack_documents
from gaugeflow.llm.prefix_trie import prefix_trie
from gaugeflow.llm.quality_rules import quality_rules
from gaugeflow.llm.secrets import secret_digest
from gaugeflow.llm.substring_dedup import drop_repeats
from gaugeflow.llm.token_counts import token_counts
from gaugeflow.llm.token_files import read_token_files, write_token_files
from gaugeflow.llm.warc import page_id_of, read_archives, write_archives
from gaugeflow.llm.whitening import quantised, whiten
from gaugeflow.plans.inputs import table
from gaugeflow.session import scratch_path


def op1_token_counts(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return token_counts(docs, public_tokenizers.path("piece_bpe_32k.model"))


def op2_substring_dedup(spark, sf_dir):
    kept = drop_repeats(table(spark, sf_dir, "documents"))
    digest = F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256")
    return kept.select("doc_id", "n_words", "n_removed", digest)


def op3_minhash_near_dedup(spark, sf_dir):
    return near_duplicates(table(spark, sf_dir, "documents"), threshold=0.85)


def op4_benchmark_decontamination(spark, sf_dir):
    return leaked_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op5_quality_classifier(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return quality_classifier.score(docs, table(spark, sf_dir, "labels"))


def op6_warc(spark, sf_dir):
    archives = scratch_path(spark, "archives")
    write_archives(table(spark, sf_dir, "pages"), archives)
    read = read_archives(spark, archives, keep_payload=False).where("reason IS NULL")
    return read.select(
        page_id_of("record_id").alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        page_id_of("refers_to").alias("refers_to"),
    )


def op7_best_fit_packing(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"), end_id=2)


def op8_quality_rules(spark, sf_dir):
    return quality_rules(table(spark, sf_dir, "documents"))


def op9_language_id(spark, sf_dir):
    return language_id.identify(table(spark, sf_dir, "documents"))


def op10_secret_scan(spark, sf_dir):
    return secret_digest(table(spark, sf_dir, "documents"))


def op11_prefix_trie(spark, sf_dir):
    return prefix_trie(table(spark, sf_dir, "conversations"))


def op12_embedding_whitening(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings")
    return whiten(quantised(vectors, "embedding", scale=1024, shift=100_000), components=8)


def op13_token_files(spark, sf_dir):
    files = scratch_path(spark, "token-files")
    docs, model = table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json")
    write_token_files(docs, files, model, end_id=1)
    return read_token_files(spark, files, keep_ids=False)


QUERIES = {
    "op1_token_counts": op1_token_counts,
    "op2_substring_dedup": op2_substring_dedup,
    "op3_minhash_near_dedup": op3_minhash_near_dedup,
    "op4_benchmark_decontamination": op4_benchmark_decontamination,
    "op5_quality_classifier": op5_quality_classifier,
    "op6_warc": op6_warc,
    "op7_best_fit_packing": op7_best_fit_packing,
    "op8_quality_rules": op8_quality_rules,
    "op9_language_id": op9_language_id,
    "op10_secret_scan": op10_secret_scan,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_embedding_whitening": op12_embedding_whitening,
    "op13_token_files": op13_token_files,
}
