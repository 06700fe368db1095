"""Documents to packed training sequences: five stages, each written and read again.

Every stage but the last takes and returns the columns of `documents`.
"""

import public_tokenizers

from gaugeflow.llm import decontamination, language_id, near_dedup, packing, secrets
from gaugeflow.plans.inputs import table
from gaugeflow.session import scratch_path

LEAST_LANGUAGE_SCORE = 0.5
NEAR_THRESHOLD = 0.8
END_ID = 2


def known_language(spark, docs, sf_dir):
    """Documents whose language is recognised; null, letterless and doubtful texts go."""
    return language_id.accepted(docs, LEAST_LANGUAGE_SCORE)


def one_per_group(spark, docs, sf_dir):
    """One document of each group of near duplicates."""
    return near_dedup.one_of_each(docs, threshold=NEAR_THRESHOLD)


def without_benchmark(spark, docs, sf_dir):
    """Documents that hold no item of the benchmark."""
    return decontamination.without_leaks(docs, table(spark, sf_dir, "benchmark"))


def without_secrets(spark, docs, sf_dir):
    """All documents, secrets masked in the text."""
    return secrets.mask_secrets(docs)


def packed(spark, docs, sf_dir):
    """Where every piece of every document goes in the training sequences."""
    return packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"), END_ID)


STAGES = [
    ("language_id", known_language),
    ("near_dedup", one_per_group),
    ("decontamination", without_benchmark),
    ("secret_scan", without_secrets),
    ("packing", packed),
]

# Trained and hashed stages have no SQL form; the tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark, sf_dir):
    """The result of all stages over the documents."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
