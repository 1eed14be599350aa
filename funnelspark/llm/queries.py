"""Queries of the training-data operators: one for each operator over its whole
table, and the pipeline.  ``ORACLES`` has the DuckDB SQL where SQL can express
the operator."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers as tokenizers
from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from funnelspark.llm import (bpe, decontaminate, hard_negatives, html_text, jaccard, lexical, line_dedup,
                             neighbours, quality, repeats, secret_scan, token_counts, toxicity)
from funnelspark.llm.common import materialize, prepare, table
from funnelspark.llm.oracle import (DECONTAMINATION_SQL, HARD_NEGATIVES_SQL, JACCARD_SQL, LEXICAL_SQL,
                                    LINES_SQL, REPEATS_SQL)

Query = Callable[[SparkSession, str], DataFrame]

#: Rank file of the public tokenizers.
RANKS = "byte_bpe_multi_50k.tiktoken"

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            prepare(spark)
            return fn(spark, sf_dir)
        run.__name__, run.__doc__ = fn.__name__, fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return run
    return deco


@register("op6_decontamination", DECONTAMINATION_SQL)
def op6_decontamination(spark, sf_dir):
    """Wu-Manber search of all benchmark windows in all documents."""
    return decontaminate.contamination_report(table(spark, sf_dir, "documents"),
                                              table(spark, sf_dir, "benchmark"))


@register("op1_quality")
def op1_quality(spark, sf_dir):
    """Quality scores of all documents, learned from labels.quality."""
    return quality.quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@register("op3_byte_bpe")
def op3_byte_bpe(spark, sf_dir):
    """Byte-level BPE ids of all documents, decoded again."""
    return bpe.round_trip_digests(table(spark, sf_dir, "documents"), tokenizers.path(RANKS),
                                  tokenizers.PATTERN)


@register("op9_neighbours")
def op9_neighbours(spark, sf_dir):
    """The 20 nearest of every 20th embedding among all others."""
    return neighbours.nearest(table(spark, sf_dir, "embeddings"))


@register("op8_token_counts")
def op8_token_counts(spark, sf_dir):
    """Token counts of all documents before and after redaction edits."""
    docs = token_counts.redaction_edits(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return token_counts.edited_counts(docs, None, tokenizers.path(RANKS), tokenizers.PATTERN,
                                      edits_col="edits")


@register("op10_toxicity")
def op10_toxicity(spark, sf_dir):
    """Expected severity of all documents, learned from labels.toxic."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    grades = materialize(toxicity.graded_labels(docs, labels), "toxicity-grades")
    return toxicity.severity(docs, toxicity.fit(docs, grades))


@register("op2_secrets")
def op2_secrets(spark, sf_dir):
    """Secrets of all documents, told from other long strings by a random forest."""
    return secret_scan.secret_report(table(spark, sf_dir, "documents"))


@register("op5_jaccard_join", JACCARD_SQL)
def op5_jaccard_join(spark, sf_dir):
    """Components of documents whose 5-word shingle sets are 80 % alike."""
    return jaccard.link_components(table(spark, sf_dir, "documents"))


@register("op4_html_text")
def op4_html_text(spark, sf_dir):
    """Main text of all pages."""
    return html_text.extract(table(spark, sf_dir, "pages"))


@register("op7_repeats", REPEATS_SQL)
def op7_repeats(spark, sf_dir):
    """Every byte of all documents under a 200-byte string that starts twice is removed."""
    return repeats.remove_repeats(table(spark, sf_dir, "documents")).drop("kept")


@register("op11_lexical_search", LEXICAL_SQL)
def op11_lexical_search(spark, sf_dir):
    """The 20 highest-scoring documents of every benchmark item."""
    return lexical.rank_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@register("op12_hard_negatives", HARD_NEGATIVES_SQL)
def op12_hard_negatives(spark, sf_dir):
    """Rows of other labels that score almost as high as an anchor's nearest rows of its label."""
    return hard_negatives.mine(table(spark, sf_dir, "embeddings"),
                               label_col=hard_negatives.shifted_label())


@register("op13_line_dedup", LINES_SQL)
def op13_line_dedup(spark, sf_dir):
    """All documents without the lines that ten or more documents hold."""
    return line_dedup.line_report(table(spark, sf_dir, "documents"))


QUERIES["pipeline"] = corpus_pipeline.run
if corpus_pipeline.ORACLE_SQL is not None:
    ORACLES["pipeline"] = corpus_pipeline.ORACLE_SQL
