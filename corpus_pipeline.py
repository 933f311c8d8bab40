"""A corpus cleaned in five stages, each written as Parquet and read again by the next.

Rules of quality drop documents and boilerplate lines, near-duplicates leave one
document per group, personal data becomes pseudonyms, sampling draws the mixture
to its target weights, and what is left is encoded and decoded again.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from broadsheet.llm import bpe, mixing, near_texts, pseudonyms, quality
from broadsheet.llm.common import table, tune
from broadsheet.llm.settings import MIX, PSEUDONYM_KEY
from broadsheet.session import scratch_path


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the rules, without lines that too many documents of their host hold."""
    return quality.apply_rules(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near copies: SimHash trees, links of five-word similarity 0.8."""
    return near_texts.keep_one(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with personal data replaced; an address or a date may change its length, and ``n_chars`` follows."""
    out = pseudonyms.pseudonymise(docs, PSEUDONYM_KEY)
    if "n_chars" not in docs.columns:
        return out
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def target_weights(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents drawn by calibrated probabilities."""
    return mixing.sample(docs, MIX)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of ids and decoded texts."""
    path = public_tokenizers.path("word_bpe_49k.json")
    return bpe.round_trip(docs, path)


STAGES = [
    ("quality rules", quality_rules),
    ("near-duplicates", near_duplicates),
    ("personal data", personal_data),
    ("target weights", target_weights),
    ("token ids", token_ids),
]

# fingerprints, keyed permutations and merges have no SQL form; tests compare with plain Python
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over ``documents``; every stage's result lies in the shared folder."""
    tune(spark)
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        path = scratch_path(spark, f"pipeline-{k}")
        out = stage(spark, docs, sf_dir)
        out.write.parquet(path)
        docs = spark.read.schema(out.schema).parquet(path)
    return docs
