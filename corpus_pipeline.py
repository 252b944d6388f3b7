"""Raw documents to token ids: the stages of a training corpus, each over what the one before kept."""

import public_tokenizers
from pyspark.sql import functions as F

from shelfmark.llm.bpe import encode
from shelfmark.llm.decontaminate import keep_clean
from shelfmark.llm.near_dup import keep_one
from shelfmark.llm.quality import keep_good
from shelfmark.llm.scratch import stored
from shelfmark.llm.secrets import example_findings, redact, train

TOKENIZER = "byte_bpe_50k.json"


def quality(spark, docs, sf_dir):
    """Documents that break no quality rule."""
    return keep_good(docs)


def near_duplicates(spark, docs, sf_dir):
    """One document of each group of near-equal ones: that with the smallest id."""
    return keep_one(docs, size=5, percent=80)


def decontamination(spark, docs, sf_dir):
    """Documents without a passage of the benchmark."""
    return keep_clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def secrets(spark, docs, sf_dir):
    """All documents, with secrets in their texts replaced and `n_chars` as the text then has."""
    clean = redact(docs, train(example_findings(spark)))
    return clean.withColumn("n_chars", F.length("text").cast("bigint"))


def tokens(spark, docs, sf_dir):
    """Token ids in place of the text, and their number."""
    path = public_tokenizers.path(TOKENIZER)
    return encode(docs, path).withColumn("n_tokens", F.size("ids").cast("bigint")).drop("text")


STAGES = [
    ("quality", quality),
    ("near-duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("secrets", secrets),
    ("tokens", tokens),
]

# BPE and near-duplicate groups cannot be said in SQL; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark, sf_dir):
    """All stages over `documents`; each is written and read again before the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
