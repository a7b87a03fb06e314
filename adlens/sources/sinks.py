"""JSON sinks for the result tables and the to_json/from_json round trip."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from adlens.sources.commits import Commits

RECOMMENDATION_SCHEMA = (
    "campaign string, current_ctr double, current_creative_type string, current_message string, "
    "new_creatives array<struct<creative_id:string,creative_type:string,creative_message:string,audience_type:string,"
    "rationale:string,confidence_score:double,expected_ctr_improvement:double>>")


def evidence_struct(validated: DataFrame) -> DataFrame:
    """Validated rows with a nested ``evidence`` document (metrics + optional test)."""
    sig = F.when(F.col("has_test"), F.struct(
        F.col("p_value").alias("p_value"),
        F.array(F.col("ci_lower"), F.col("ci_upper")).alias("confidence_interval")))
    return validated.select(
        "hypothesis_id", "hypothesis_text", "validation_status",
        F.struct(F.col("evidence_metrics").alias("metrics"), sig.alias("statistical_significance")).alias("evidence"),
        "adjusted_confidence_score", "validation_reasoning", "rank")


def write_insights(validated: DataFrame, top: DataFrame, path: str, query: str, dataset: str,
                   timestamp: str) -> None:
    """Validated hypotheses (+ metadata columns) and top insights as JSON folders."""
    meta = [F.lit(query).alias("query"), F.lit(timestamp).alias("timestamp"), F.lit(dataset).alias("dataset")]
    evidence_struct(validated).select("*", *meta).write.mode("overwrite").json(f"{path}/validated_hypotheses")
    top.select("*", *meta).write.mode("overwrite").json(f"{path}/top_insights")


def write_recommendations(spark: SparkSession, recs: DataFrame | None, path: str, threshold: float, query: str,
                          dataset: str, timestamp: str) -> None:
    """Recommendations in ``creatives`` and the run's metadata in ``creatives_metadata``.

    ``recs`` of None (not requested by the workflow) writes an empty
    ``creatives`` folder, and metadata with a note instead of the threshold.
    """
    meta = {"query": query, "timestamp": timestamp}
    if recs is None:
        recs = spark.createDataFrame([], RECOMMENDATION_SCHEMA)
        meta["note"] = "Creative generation not requested for this workflow"
    else:
        meta |= {"dataset": dataset, "low_ctr_threshold": float(threshold)}
    recs.write.mode("overwrite").json(f"{path}/creatives")
    row = spark.range(1).select(*[F.lit(v).alias(k) for k, v in meta.items()])
    row.coalesce(1).write.mode("overwrite").json(f"{path}/creatives_metadata")


def read_recommendations(spark: SparkSession, path: str) -> DataFrame:
    """What ``write_recommendations`` wrote, with its schema also where it is empty."""
    return spark.read.schema(RECOMMENDATION_SCHEMA).json(f"{path}/creatives")


def publish_insights(validated: DataFrame, top: DataFrame, root: str, query: str, dataset: str, timestamp: str) -> str:
    """``write_insights`` all or nothing: readers of ``root`` see the former insights until both folders are complete."""
    def tables(folder: str) -> dict:
        write_insights(validated, top, folder, query, dataset, timestamp)
        return {"query": query, "dataset": dataset, "timestamp": timestamp,
                "validated_hypotheses": evidence_struct(validated).schema.json(), "top_insights": top.schema.json()}
    return Commits(validated.sparkSession, root).write("insights", tables)[0]


def publish_recommendations(spark: SparkSession, recs: DataFrame | None, root: str, threshold: float, query: str,
                            dataset: str, timestamp: str) -> str:
    """``write_recommendations`` all or nothing."""
    def tables(folder: str) -> dict:
        write_recommendations(spark, recs, folder, threshold, query, dataset, timestamp)
        return {"query": query, "dataset": dataset, "timestamp": timestamp, "requested": recs is not None}
    return Commits(spark, root).write("recommendations", tables)[0]


def published_insights(spark: SparkSession, root: str) -> tuple[DataFrame, DataFrame, dict] | None:
    """(validated hypotheses, top insights, metadata) of the newest publication; None before the first."""
    if (found := Commits(spark, root).latest("insights")) is None:
        return None
    folder, about = found
    meta = {k: about[k] for k in ("query", "dataset", "timestamp")}
    return *(spark.read.schema(_with_meta(about[n])).json(f"{folder}/{n}") for n in ("validated_hypotheses", "top_insights")), meta


def published_recommendations(spark: SparkSession, root: str) -> tuple[DataFrame, dict] | None:
    """(recommendations, metadata) of the newest publication; None before the first."""
    if (found := Commits(spark, root).latest("recommendations")) is None:
        return None
    folder, about = found
    return read_recommendations(spark, folder), spark.read.json(f"{folder}/creatives_metadata").first().asDict() | {
        "requested": about["requested"]}


def _with_meta(schema: str) -> StructType:
    kind = StructType.fromJson(json.loads(schema))
    for name in ("query", "timestamp", "dataset"):
        kind = kind.add(name, "string")
    return kind


def json_round_trip(df: DataFrame) -> DataFrame:
    """Serialise every row to JSON text and parse it back with the frame's schema."""
    schema = df.schema
    return (df.select(F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns])).alias("j"))
            .select(F.from_json("j", schema).alias("r")).select("r.*"))
