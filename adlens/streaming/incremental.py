"""The fact cube maintained by Structured Streaming as fact files arrive.

Daily ad rows usually land as new files.  Instead of re-running the whole
data step, the same GROUPING SETS aggregate (``segments.fact_cube``) runs as
a streaming aggregation: the state store keeps one row per date and per
segment value (bounded by calendar x segment cardinality, not by row count),
and each trigger publishes the complete, updated cube.  Late or corrected
rows for old dates simply update their keys (no watermark is needed because
state does not grow with time beyond one row per date).

Downstream steps (summary, trends, hypotheses, evidence) read the published
cube exactly as they read the batch one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from adlens.operators.segments import fact_cube
from adlens.session import remove_folder


def fact_stream(spark: SparkSession, source_dir: str, schema, max_files_per_trigger: int | None = None
                ) -> DataFrame:
    """Streaming fact rows from parquet files appearing under ``source_dir``."""
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", int(max_files_per_trigger))
    return reader.parquet(source_dir)


def streaming_cube(facts: DataFrame, moments: bool = True) -> DataFrame:
    """The cube over a streaming fact frame (same columns as the batch cube)."""
    return fact_cube(facts, moments=moments, include_daily=True)


#: Epochs that stay: the last one, and the one that a reader may still be reading.
KEPT_EPOCHS = 2


def publish_cube(cube: DataFrame, target_dir: str, checkpoint_location: str,
                 trigger_once: bool = False) -> StreamingQuery:
    """Run the streaming cube; every micro-batch writes the full cube as ``target_dir/epoch=N``.

    ``complete`` output mode + ``foreachBatch``.  An epoch has a folder of its
    own, so a reader of an earlier one (``latest_cube``) never sees a table
    that is being replaced; a retried epoch overwrites only itself.  Epochs
    before the last ``KEPT_EPOCHS`` are removed.  The query's own state and offsets live in ``checkpoint_location`` (a shared
    folder on a cluster).
    """
    def write(batch: DataFrame, epoch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{target_dir}/epoch={epoch_id}")
        if epoch_id >= KEPT_EPOCHS:
            remove_folder(batch.sparkSession, f"{target_dir}/epoch={epoch_id - KEPT_EPOCHS}")

    w = (cube.writeStream.outputMode("complete")
         .option("checkpointLocation", checkpoint_location)
         .foreachBatch(write))
    if trigger_once:
        w = w.trigger(availableNow=True)
    return w.start()


def latest_cube(spark: SparkSession, target_dir: str) -> DataFrame:
    """The cube of the last published epoch; only its folder is read."""
    cubes = spark.read.parquet(target_dir)
    last = cubes.select(F.max("epoch")).first()[0]
    return cubes.where(F.col("epoch") == last).drop("epoch")
