"""The training-data pipeline: stages over `documents`, each one operator of ``ticketlens.llm``.

Every stage gets all rows its predecessor kept, written as Parquet and read again; all but the last
return the columns of `documents`, whatever further columns there are.

Defined cases: null, empty and blank texts are documents like others for every stage (the classifier
scores them, they are no near copies of each other, they hold no benchmark item, the mix never takes
them); very long texts pass whole; of rows that repeat id and text one stays after the second stage; null ids
and sources are values; an empty table gives an empty result; columns of any name come along up to
the last stage.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from ticketlens.llm import chosen_path_join, fair_mix, quality_gam, simple8b, template_decontam
from ticketlens.llm.cluster import ship_code
from ticketlens.llm.queries import crc_mod, table, tokenizer_path
from ticketlens.session import checkpoint_dir, scratch_path


def drop_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go; held-out labels aren't learnt from."""
    model = quality_gam.train(docs, table(spark, sf_dir, "labels"), learn_from=lambda c: crc_mod(c, 5) != 0)
    return quality_gam.keep_good(docs, model)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates stays, the one with the least id."""
    ship_code(spark)
    return chosen_path_join.keep_one(docs)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item, verbatim or re-parameterised, go."""
    return template_decontam.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the weighted mix of their sources takes them."""
    ship_code(spark)
    return fair_mix.mix(docs)


def write_token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids in files; per document its place, length and checksum, read back from them."""
    ship_code(spark)
    folder = scratch_path(spark, "token-ids")
    simple8b.write_documents(docs, folder, tokenizer_path())
    return simple8b.read_documents(spark, folder, with_ids=False)


STAGES = [
    ("quality_classifier", drop_low_quality),
    ("ngram_jaccard_join", drop_near_copies),
    ("benchmark_decontamination", drop_benchmark_leaks),
    ("mixing_to_target_weights", mix_sources),
    ("token_id_output", write_token_ids),
]
ORACLE_SQL = None  # fitted models, hashes and token ids: tested against brute-force versions instead


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; the last stage's result."""
    docs = table(spark, sf_dir, "documents")
    folder = f"{checkpoint_dir(spark).rstrip('/')}/pipeline/{uuid.uuid4().hex}"
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs.write.parquet(f"{folder}/{k}")
            docs = spark.read.parquet(f"{folder}/{k}")
    return docs
