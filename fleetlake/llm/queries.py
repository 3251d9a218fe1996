"""The registered queries of the text operators: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from fleetlake.llm.common import table
from fleetlake.llm.decontaminate import decontaminate
from fleetlake.llm.lexical_search import lexical_search
from fleetlake.llm.lexical_search import oracle_sql as search_sql
from fleetlake.llm.lm_score import lm_score
from fleetlake.llm.mixing import mix
from fleetlake.llm.mixing import oracle_sql as mix_sql
from fleetlake.llm.pii import pii
from fleetlake.llm.quality_classifier import quality_classifier
from fleetlake.llm.quality_rules import quality_rules
from fleetlake.llm.repeats import oracle_sql as repeats_sql
from fleetlake.llm.repeats import remove_repeats
from fleetlake.llm.secret_scan import secret_scan
from fleetlake.llm.sentence_pieces import sentence_pieces
from fleetlake.llm.simhash import simhash_components
from fleetlake.llm.spelling import oracle_sql as spelling_sql
from fleetlake.llm.spelling import spelling_variants
from fleetlake.llm.token_counts import token_counts


def vocabulary(name: str) -> str:
    """Path of a public vocabulary file of the machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_classifier(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.tiktoken"))


def op3_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_score(table(spark, sf_dir, "documents"))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(table(spark, sf_dir, "documents"))


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_components(table(spark, sf_dir, "documents"))


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"))


def op8_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents")).drop("positions")


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii(table(spark, sf_dir, "documents"))


def op10_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents"))


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(table(spark, sf_dir, "documents"))


def op12_sentence_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentence_pieces(table(spark, sf_dir, "documents"), vocabulary("piece_bpe_32k.model"))


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_quality_classifier, op2_secret_scan, op3_lm_score, op4_quality_rules, op5_simhash, op6_decontaminate, op7_token_counts, op8_mix, op9_pii, op10_repeats,
        op11_spelling_variants, op12_sentence_pieces, op13_lexical_search,
    )
}

#: SQL for the queries that SQL can express; the others are tested against brute force.
ORACLES: dict[str, str] = {"op8_mix": mix_sql(), "op10_repeats": repeats_sql(), "op11_spelling_variants": spelling_sql(), "op13_lexical_search": search_sql()}
