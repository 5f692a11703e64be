"""The corpus pipeline: quality, near-duplicates, benchmark leaks, private data, encoding.

Every stage takes the documents the one before kept, whatever further columns they have, and all but
the last return the columns of ``documents``.  A stage is judged on its own input; rows that a stage
rejects go, all others stay.
"""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from tillwarden.llm import merge_dropout, near_duplicates, pseudonyms, quality_rules, templates
from tillwarden.llm.shared import table, tokenizer_file, unused, written

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

KEEP_FROM = 0.3  # least quality score of a document that stays
SHINGLE, SIMILAR_PERCENT = 5, 80
DROPOUT, SEED = 0.1, 1
KEY_VARIABLE = "TILLWARDEN_PSEUDONYM_KEY"
TRIAL_KEY = "trial-key-of-the-registered-queries"


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose predicted quality is at least KEEP_FROM."""
    model = quality_rules.fit(docs, table(spark, sf_dir, "labels"), "quality")
    score = unused(docs, "score")
    return quality_rules.scored(docs, model, score).filter(F.col(score) >= KEEP_FROM).drop(score)


def near_duplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of equal or similar texts: that of least doc_id.

    Rows are told apart by an id of the stage's own, drawn and written once, so that different texts under one
    doc_id are different documents.  Rows of one doc_id and one text are one, wordless ones too.  Rows
    without a doc_id are not linked and stay.
    """
    row = unused(docs, "row")
    drawn = written(docs.withColumn(row, F.monotonically_increasing_id()), "drawn-rows")
    linked = drawn.filter("doc_id is not null")
    found = near_duplicates.near_duplicates(
        linked.select(F.col(row).alias("doc_id"), "text"), SHINGLE, SIMILAR_PERCENT
    ).select(F.col("doc_id").alias("__row"), "n_shingles", "component_id")
    known = linked.select(F.col(row).alias("__row"), "doc_id", F.sha2(F.col("text").cast("string"), 256).alias("digest"))
    placed = written(found.join(known, "__row"), "placed-rows")
    # texts without shingles are in no group: those of one doc_id and one text are
    worded = F.col("n_shingles") > 0
    group = [F.when(worded, F.col("component_id")), F.when(~worded, F.col("doc_id")), F.when(~worded, F.col("digest"))]
    least = placed.groupBy(*(g.alias(f"__g{i}") for i, g in enumerate(group))).agg(
        F.min(F.struct("doc_id", "digest", "__row")).alias("least")
    )
    kept = unused(drawn, "kept_row")
    stays = least.select(F.col("least.__row").alias(kept))
    rest = drawn.join(stays, F.col(row) == F.col(kept), "left_semi").drop(row)
    return rest.unionByName(drawn.filter("doc_id is null").drop(row))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of the benchmark."""
    leaks = templates.leaks(docs.select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
    leaked_id = unused(docs, "leaked_id")
    leaked = leaks.select(F.col("doc_id").alias(leaked_id)).distinct()
    return docs.join(leaked, F.col("doc_id") == F.col(leaked_id), "left_anti")


def with_pseudonyms(docs: DataFrame, key: str) -> DataFrame:
    """All documents, personal data replaced by pseudonyms and n_chars brought up to date."""
    found = unused(docs, "found")
    rewritten = pseudonyms.pseudonymised(docs, key, found).drop(found)
    if "n_chars" not in rewritten.columns:
        return rewritten
    return rewritten.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def private_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``with_pseudonyms`` under the secret of KEY_VARIABLE; without it the stage stops."""
    key = os.environ.get(KEY_VARIABLE)
    if not key:
        raise RuntimeError(f"set {KEY_VARIABLE} to the secret that pseudonyms are drawn with")
    return with_pseudonyms(docs, key)


def trial_private_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The stage of the registered query, over synthetic tables: a fixed key keeps its results comparable."""
    return with_pseudonyms(docs, TRIAL_KEY)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_ids, ids and lossless of every document."""
    return merge_dropout.encoded(docs, tokenizer_file("piece_bpe_32k.model"), DROPOUT, SEED)


REAL_STAGES: list[tuple[str, Stage]] = [
    ("quality", quality),
    ("near_duplicates", near_duplicate),
    ("decontamination", decontamination),
    ("private_data", private_data),
    ("encoding", encoding),
]
STAGES = [(name, trial_private_data if stage is private_data else stage) for name, stage in REAL_STAGES]

# forest, MinHash tables and piece merges have no SQL; tests/llm compares the stages with plain versions
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str, stages: list[tuple[str, Stage]] | None = None) -> DataFrame:
    """The registered query; a real run passes REAL_STAGES."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in stages or STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
