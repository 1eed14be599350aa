"""Training-data pipeline over ``documents``: quality, near duplicates, benchmark
decontamination, secrets, tokens.

Each stage takes (spark, docs, sf_dir), works on all that the one before kept,
and returns documents (the last one: token counts and digests).  ``run``
applies them; what a stage returns is written to the shared folder and read
again, so a lost executor repeats one stage at most, and the copy that the stage
before left is deleted.

Defined cases, for every stage: a null or empty text is scored as an empty text, is linked
with nothing, contaminated with nothing, holds no secret and has no tokens; a null id is kept
(and never a partner); repeated rows are judged alike and all stay or go, but for the
near-duplicate stage, where rows of one id stay unless their text is linked with that of a
smaller id; columns beside those of documents, whatever their names, are carried along up to
the last stage; an empty table gives an empty result.
"""

from __future__ import annotations

import public_tokenizers as tokenizers
from pyspark.sql import DataFrame, SparkSession

from funnelspark.llm import bpe, decontaminate, jaccard, quality, secret_scan
from funnelspark.llm.common import Workspace, prepare, table

RANKS = "byte_bpe_multi_50k.tiktoken"


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 1: documents that the quality classifier rejects go."""
    prepare(spark)
    return quality.accepted(docs, table(spark, sf_dir, "labels"))


def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 5: one document of each group of linked ones stays, that of the smallest id."""
    prepare(spark)
    return jaccard.one_of_each_group(docs)


def without_contamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 6: documents contaminated with benchmark items go."""
    prepare(spark)
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 2: secrets are replaced in the texts; all documents stay."""
    prepare(spark)
    return secret_scan.redact(docs, length_col="n_chars")


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 3: token count and digests of the ids and of their decoding."""
    prepare(spark)
    return bpe.round_trip_digests(docs, tokenizers.path(RANKS), tokenizers.PATTERN)


STAGES = [
    ("quality", good_quality),
    ("near_duplicates", without_near_duplicates),
    ("decontamination", without_contamination),
    ("secrets", without_secrets),
    ("tokens", tokens),
]

#: SQL cannot express the classifier, the forest and the merges.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to ``documents``."""
    prepare(spark)
    docs, before = table(spark, sf_dir, "documents"), None
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            now = Workspace(spark)
            docs = now.save(docs, f"pipeline-{name}")
            if before is not None:
                before.close()
            before = now
    return docs
