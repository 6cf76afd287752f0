"""Clean, deduplicate, mask, mix and pack `documents`, stage by stage.

Every stage but the last returns the columns of its input; each is written and read
again before the next one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tapeloom.llm import common, jaccard, mixing, outliers, packing, pii


def sound(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Quality rules: documents that fail the base rule or lie far from their group go."""
    return outliers.keep(docs)


def single(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """N-gram Jaccard join: of every group of near copies the document with the least id stays.

    Near copies share 80 of 100 shingles of five words; op8 links at 90 of three words.
    """
    return jaccard.keep_one(docs, percent=80, width=5)


def masked(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data: every span gives way to the name of its kind."""
    return pii.mask(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Mixing to target weights: a document as often as it is taken, the last one of a source cut at its budget."""
    return mixing.repeat(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packing: the pieces of all documents with their token ids and their places in sequences."""
    return packing.pack(docs, with_ids=True)


#: (name, function of spark, docs and the folder of the tables).
STAGES = [("quality", sound), ("near copies", single), ("personal data", masked), ("mix", mixed), ("pack", packed)]

#: Covariance estimates, a fitted field and token ids are beyond SQL; see tests/llm/test_llm_pipeline.py.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows over the whole of `documents`."""
    docs = common.table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = common.stored(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
