"""From raw documents to sharded training text: one stage per operator, each over all that the stage before kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from watchtide.llm.decontaminate import decontaminated
from watchtide.llm.mixing import Mix, repeated
from watchtide.llm.neardup import NearDup, deduplicated
from watchtide.llm.quality import fit, with_scores
from watchtide.llm.sharding import grown, planned, with_shards, with_slots
from watchtide.storage import stored


def _given(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the compression classifier, fitted on all labels, takes for good."""
    model = fit(docs, _given(spark, sf_dir, "labels"))
    return with_scores(docs, model).filter("predicted = 1").select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of copies and near copies: that of the least id."""
    return deduplicated(docs, NearDup())


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item, in whatever order its sentences come."""
    return decontaminated(docs, _given(spark, sf_dir, "benchmark"))


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Whole documents, as often as the mix of their source takes them."""
    return repeated(docs, Mix(whole=True))


def sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with their shard of 16 and their place in it."""
    tree = planned(16)
    return with_slots(with_shards(docs, tree, grown(tree)))


STAGES = [
    ("quality classifier", quality_classifier),
    ("MinHash near-dedup", near_dedup),
    ("benchmark decontamination", benchmark_decontamination),
    ("mixing sources to target weights", source_mixing),
    ("sharding", sharding),
]

#: The classifier is beyond SQL; ``tests/llm/test_pipeline.py`` holds every stage against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what one returns is written and read again by the next."""
    docs = _given(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
