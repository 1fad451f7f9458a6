"""From raw documents to sharded training data, stage by stage.

Each stage gets all that the one before kept, written and read again as Parquet. All but the
last return the columns of ``documents``; the last adds the shard and the slot in it.

Defined results, in every stage: null, empty and word-less texts stay unless a stage below says otherwise; very long
texts are read whole; repeated rows are rows of their own until near duplicates go; columns beyond those of
``documents`` come through, whatever their names; an empty table gives an empty one.
"""

from pyspark.sql import DataFrame, SparkSession

from ledgerloom.llm.decontaminate import drop_contaminated
from ledgerloom.llm.mixing import mix
from ledgerloom.llm.scratch import stored
from ledgerloom.llm.sharding import shard
from ledgerloom.llm.simhash import keep_one_per_component
from ledgerloom.llm.toxicity import drop_toxic, train


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score as toxic go. A text without words has the score of clean ones and stays; without labels of
    both kinds nothing is learned, and all stay unless every labelled document is toxic."""
    return drop_toxic(docs, train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays, that with the smallest id (null last; then the smallest
    hash of text and row). Texts without words are one group."""
    return keep_one_per_component(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which a benchmark window occurs go; those without words have none and stay."""
    return drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources by weight, null being one; a document comes as often as the mix takes it, 0 to 2 times. One without
    words weighs nothing, and comes as often as its place in the queue allows."""
    return mix(docs)


def assign_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A shard and a slot for every row; equal rows get slots of their own."""
    return shard(docs)


STAGES = [
    ("toxicity", toxicity),
    ("simhash_near_dedup", simhash_near_dedup),
    ("decontaminate", decontaminate),
    ("mix_sources", mix_sources),
    ("assign_shards", assign_shards),
]

#: SQL cannot express the first stages; tests/llm/test_pipeline.py checks by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
