"""From raw documents to packed training windows, in five stages.

run() writes each stage as Parquet to the cluster's shared folder and reads it again, so a lost executor
costs at most the stage at hand, and a stage's decisions are made once.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import langid, mixing, packing, secretscan, simhash
from tidemark.llm.common import cut, drop_dir, fresh_dir, table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents go that have no letters (null and empty texts with them), or that lie mainly in a language without labelled
    documents (where there are no labels, in one that the model can't name) or in letters too unlike the labelled
    documents of their language. Repeated rows and rows that tie stay or go together; a null doc_id or lang does no
    harm; very long texts are judged whole; clashing names stay as they are; an empty table gives no rows."""
    few = langid.sample(docs)
    model = langid.train(docs, given=few)
    named = list(model.langs)
    return langid.keep_known(docs, model, named or None, least=langid.least_scores(docs, model, given=few))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of exact and near copies stays, the one with the least doc_id; of rows that repeat
    a doc_id one. Rows with null text or doc_id stay. Empty texts are copies of each other. Very long texts count
    whole; clashing names stay as they are; an empty table gives no rows."""
    return simhash.keep_one(docs)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are masked; every document stays, null and empty texts as they are, repeated rows masked alike, tokens
    that tie in p-value masked together. Very long texts are read whole; clashing names stay as they are; an empty
    table gives no rows."""
    return secretscan.redact(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeat, or drop out, by a Poisson count at their source's rate, in global random order. A null source
    is one of its own; null and empty texts count at their source's rate; repeated rows repeat equally often and tie
    in the order; very long texts weigh by their bytes; clashing names stay as they are; an empty table gives no rows."""
    return mixing.mix_sources(docs, keep_order_columns=False)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every byte of every text gets its place in a window, with the bytes themselves (content). Null and empty texts
    have none; repeated rows and null doc_ids are packed each; sizes that tie go by a hash; very long texts fill many
    windows; other columns are left behind; an empty table gives no rows."""
    packed = cut(packing.pack_documents(docs))
    return packing.with_bytes(packed, docs)


STAGES: list[tuple[str, Stage]] = [
    ("language ID", language_id),
    ("SimHash near-dedup", near_dedup),
    ("secret scan", secret_scan),
    ("mixing to target weights", mix),
    ("best-fit packing", pack),
]

#: The language model, fingerprints and token tests have no SQL; tests/llm/test_brute.py holds run() against plain Python.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, last = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        out = fresh_dir(spark, "stage-" + name.replace(" ", "-").lower())
        stage(spark, docs, sf_dir).write.parquet(out)
        docs = spark.read.parquet(out)
        if last:
            drop_dir(spark, last)
        last = out
    return docs
