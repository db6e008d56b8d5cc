"""The corpus pipeline: from raw documents to a weighted, clean training mix.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor
kept; all but the last return the columns of ``docs``. ``run`` writes the
result of a stage to the shared folder and reads it back for the next, so a
lost executor costs tasks of one stage only.

All stages take nulls in any column, texts of any length (read whole), repeated rows and ids, columns
beside those of documents whatever their names, and an empty table, which stays empty. What that
means for each is said at the stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from threadsift.llm import decontaminate, entry, nbsvm, pii, simhash
from threadsift.llm.tables import read, written


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go.

    A null text is scored like an empty one; equal texts have equal scores, so copies go or stay
    together. Without labels of both classes every text scores the smoothed share of good labels.
    """
    return nbsvm.keep_good(docs, nbsvm.fit(docs, read(spark, sf_dir, "labels", "doc_id", "quality")))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays: the smallest id, a null id only if all are null.

    Null and blank texts are one group. Of repeated rows with that id one stays.
    """
    return simhash.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold benchmark passages go: one in twenty of their words, or more, stands in such a passage.

    A text without words holds none; equal texts are judged alike, and rows are not merged.
    """
    return decontaminate.drop_contaminated(docs, read(spark, sf_dir, "benchmark", "item_id", "text"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced by its kind, and ``n_chars`` follows the text.

    A null text stays null; overlapping spans become one, named after the first. No row goes.
    """
    return pii.redact(docs, pii.fit(docs))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are taken, some more than once, to meet the target weights.

    A null source or language is a name of its own (the empty one); texts without words are never
    taken; rows equal in id and text are taken in any order among themselves.
    """
    return entry.mixed(docs)[0]


STAGES = [
    ("quality_classifier", quality),
    ("simhash_near_dedup", near_dedup),
    ("benchmark_decontamination", decontamination),
    ("pii", personal_data),
    ("source_mixing", mixture),
]

#: Learned models and seeded hashes are not expressible in SQL; tests/llm checks every stage.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents of ``sf_dir`` after all stages."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
