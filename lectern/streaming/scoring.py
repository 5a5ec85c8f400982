"""Scoring completions as they arrive.

The evaluation scores each completion when the model returns it.  Here the
completions are a file stream (JSON lines: id, model, completion) joined to
the static record table (stream-static join, J10), matched (F7, O4), and
reduced to a running points-weighted accuracy per model (A7) kept in
streaming state.  Progress and state live under the session's checkpoint
folder, so a restarted query resumes where it stopped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from lectern.operators.scoring import score
from lectern.schemas import COMPLETIONS
from lectern.session import ensure_checkpoint_dir


def scored_stream(spark: SparkSession, completions_dir: str, records: DataFrame,
                  location: str = "end", ignore_case: bool = True) -> DataFrame:
    """A streaming frame of scores: one row per arriving completion whose id
    is in ``records`` (id, target or targets, points, ...).  A completion that
    arrives again for the same record and model counts once (state: one key
    per completion)."""
    comp = spark.readStream.schema(COMPLETIONS).json(completions_dir).dropDuplicates(["id", "model"])
    return score(records, comp, location, ignore_case)


def running_accuracy(scores: DataFrame) -> DataFrame:
    """A7 per model over everything seen so far (streaming aggregation)."""
    return scores.groupBy("model").agg(
        F.count(F.lit(1)).alias("questions"),
        F.sum("value").cast("double").alias("value"), F.sum("points").cast("double").alias("points"),
    ).withColumn("weighted_accuracy", F.try_divide(F.col("value"), F.col("points")))


def start_accuracy(spark: SparkSession, completions_dir: str, records: DataFrame, out_path: str,
                   name: str, once: bool = True, **score_args) -> StreamingQuery:
    """Each micro-batch writes the accuracy table, from the aggregation state,
    as a version of its own under ``out_path``; a repeated batch replaces its
    version, and readers (:func:`latest_accuracy`) never see one half written
    over another."""
    ckpt = f"{ensure_checkpoint_dir(spark).rstrip('/')}/stream-{name}"
    acc = running_accuracy(scored_stream(spark, completions_dir, records, **score_args))

    def write(batch: DataFrame, epoch: int) -> None:
        (batch.withColumn("version", F.lit(epoch)).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy("version").parquet(out_path))

    w = (acc.writeStream.outputMode("complete").option("checkpointLocation", ckpt).foreachBatch(write))
    w = w.trigger(availableNow=True) if once else w.trigger(processingTime="30 seconds")
    return w.start()


def latest_accuracy(spark: SparkSession, out_path: str) -> DataFrame:
    """The accuracy table of the newest version."""
    t = spark.read.parquet(out_path)
    newest = t.agg(F.max("version")).first()[0]
    return t.where(F.col("version") == newest).drop("version")
