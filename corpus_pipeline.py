"""From raw documents to a mix of sources, stage by stage.

Each stage takes what its predecessor kept, written and read again, so a lost
executor costs no more than the stage it works on.  Stages take further columns
along under any name; what they do with nulls, ties and repeated rows stands with each.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from refreshguard.llm import decontam, jaccard, mixing, pii, toxicity
from refreshguard.llm.common import table
from refreshguard.sources.shared import stored


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents below the cut of the toxicity score.

    A null or empty text has nothing toxic and stays if clean texts do; repeated rows share their
    decision; without labels nothing is learnt and all rows stay; an empty table stays empty.
    """
    return toxicity.drop_toxic(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, and all without words.

    The least id of a group stays, a null id only where it has no other; of rows with the
    same id and text one stays; null and empty texts are no duplicates of each other.
    """
    return jaccard.one_of_each_group(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark.

    Null and empty texts, and rows of an empty benchmark, have no passage; repeated rows share
    their decision.
    """
    return decontam.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by the name of its kind.

    No row goes; a null text stays null, ``n_chars`` follows the text.
    """
    return pii.redact(docs, pii.train(docs))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mix takes, how often, and for which shards.

    A null source is a source of its own; documents without words are not taken; an empty
    table gives no rows.
    """
    return mixing.mixed(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("personal_data", redact_personal_data),
    ("mix", mix_sources),
]

#: Trained models decide in the first and fourth stage, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = stored(docs, name)
    return docs
