"""A training corpus from ``documents`` in five stages, each one of the corpus operators.

``run`` applies the stages in order; every stage's result is written as
Parquet into the session's shared folder and read again as the next one's
documents.  All stages but the last return the columns they were given.

Null, empty and repeated rows have the results that the operators define;
near-duplicate removal keeps one of several rows with equal id and text.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adlens.llm.common import clear_of, shared_folder, table, written
from adlens.llm.decontaminate import find_items
from adlens.llm.mixing import ADDED, COUNTED, cells_of, fit_topics, mixed, tempered, with_cells, with_counts
from adlens.llm.near_dedup import keep_one_of_each
from adlens.llm.sharding import shard_documents
from adlens.llm.toxicity import fit, score_toxicity

#: Documents scored at least this toxic go.
TOXIC_FROM = 0.5
#: Per cent of Jaccard from which documents are near-duplicates.
NEAR_DUPLICATE = 80
#: Powers of the observed token shares that make the mixing targets: levelled a little for sources
#: and languages; topics keep their shares.
MIX_POWERS = {"_source": 0.9, "_lang": 0.95, "_topic": 1.0}
#: Bounds of a value's target over its share and of a cell's factor, so that most documents stay.
MIX_UPLIFT, MIX_MOST = 1.1, 1.25
SHARDS, SHARD_SEED = 8, 2024


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 10: documents that the model, learned from ``labels``, calls toxic go."""
    docs, back = clear_of(docs, ["_toxicity"])
    model = fit(docs, table(spark, sf_dir, "labels"))
    return back(score_toxicity(docs, model, score="_toxicity").where(F.col("_toxicity") < TOXIC_FROM))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 1: of each group of near-duplicates the document with the smallest id stays."""
    return keep_one_of_each(docs, NEAR_DUPLICATE)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 7: documents that contain a benchmark item within its error budget go."""
    docs, back = clear_of(docs, ["_hits"])
    return back(find_items(docs, table(spark, sf_dir, "benchmark"), hits="_hits").where(F.size("_hits") == 0))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 2: documents sampled so that sources, languages and topics meet their target token shares."""
    docs, back = clear_of(docs, [*ADDED, *COUNTED])
    counted = written(with_counts(docs))                                   # the texts are tokenised once
    celled = with_cells(counted, topics=fit_topics(counted))
    cells = cells_of(celled)
    return back(mixed(celled, cells, tempered(cells, MIX_POWERS, MIX_UPLIFT), most=MIX_MOST).where("_kept"))


def sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 4: shard and slot of each remaining document by a Feistel permutation."""
    return shard_documents(docs, SHARDS, SHARD_SEED).drop("row_no", "grown_shard")


STAGES = [("toxicity", toxicity), ("near_duplicates", near_duplicates), ("decontamination", decontamination),
          ("mixing", mixing), ("sharding", sharding)]

#: Learned models, signatures and edit distances are beyond SQL; tests/llm holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage over all of ``documents``."""
    docs = table(spark, sf_dir, "documents")
    folder = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
