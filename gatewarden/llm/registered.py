"""The corpus queries: each takes (spark, sf_dir) and runs an operator over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from gatewarden.llm import corpus_sql
from gatewarden.llm.conversation_trie import op12_sequence_collapse_trie
from gatewarden.llm.embedding_dedup import op6_embedding_dedup
from gatewarden.llm.html_wrapper import op10_html_wrapper
from gatewarden.llm.language_id import op4_language_id
from gatewarden.llm.minhash_dedup import op1_prob_minhash
from gatewarden.llm.packing import op8_best_fit_packing
from gatewarden.llm.quality_classifier import op2_quality_classifier
from gatewarden.llm.quality_rules import op9_quality_rules
from gatewarden.llm.secret_scan import op3_secret_scan
from gatewarden.llm.sentencepiece_scan import op5_sentencepiece
from gatewarden.llm.spelling_variants import op13_permuterm_variants
from gatewarden.llm.warc_archive import op7_warc_archive
from gatewarden.llm.word_bpe import op11_pair_index_bpe

Query = Callable[[SparkSession, str], DataFrame]


def over(operator: Callable[..., DataFrame], *tables: str) -> Query:
    """A query that gives the operator the named tables, in order."""
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return operator(*(spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in tables))

    return query


def queries() -> dict[str, Query]:
    return {
        "op1_prob_minhash": over(op1_prob_minhash, "documents"),
        "op2_quality_classifier": over(op2_quality_classifier, "documents", "labels"),
        "op3_secret_scan": over(op3_secret_scan, "documents"),
        "op4_language_id": over(op4_language_id, "documents"),
        "op5_sentencepiece": over(op5_sentencepiece, "documents"),
        "op6_embedding_dedup": over(op6_embedding_dedup, "embeddings"),
        "op7_warc_archive": over(op7_warc_archive, "pages"),
        "op8_best_fit_packing": over(op8_best_fit_packing, "documents"),
        "op9_quality_rules": over(op9_quality_rules, "documents", "labels"),
        "op10_html_wrapper": over(op10_html_wrapper, "pages"),
        "op11_pair_index_bpe": over(op11_pair_index_bpe, "documents"),
        "op12_sequence_collapse_trie": over(op12_sequence_collapse_trie, "conversations"),
        "op13_permuterm_variants": over(op13_permuterm_variants, "documents"),
        "pipeline": corpus_pipeline.run,
    }


def oracle_sql() -> dict[str, str]:
    """The others learn, iterate or read positions that SQL has no words for."""
    found = {
        "op12_sequence_collapse_trie": corpus_sql.TRIE,
        "op13_permuterm_variants": corpus_sql.VARIANTS,
    }
    return found | ({"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {})
