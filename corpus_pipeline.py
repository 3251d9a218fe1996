"""The corpus pipeline: five stages over ``documents``, each writing what it keeps for the next.

A stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of
``documents``. Every stage works on all that its predecessor kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from fleetlake.llm import decontaminate, mixing, pii, quality_classifier, simhash
from fleetlake.llm.common import table
from fleetlake.session import materialise


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier accepts (operator 1)."""
    model = quality_classifier.fit(docs, table(spark, sf_dir, "labels"))
    return quality_classifier.accepted(docs, model)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (operator 5): three-word shingles, at most three differing bits."""
    return simhash.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without benchmark items (operator 6)."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data masked in the text and n_chars counted anew (operator 9)."""
    return pii.mask(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mix takes, in training order, with the words taken and their positions (operator 8)."""
    return mixing.mix(docs, keep=("text", "lang", "n_chars")).where("taken > 0")


STAGES = [
    ("quality classifier", quality),
    ("SimHash near-dedup", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("PII", personal_data),
    ("mixing sources to target weights", mix),
]

#: A classifier, fingerprints and a random field are beyond SQL; the tests run the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages; between them the documents are written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = materialise(docs, f"pipeline-{i}")
    return docs
