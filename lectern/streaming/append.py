"""Streaming form of the row-local operators and the append sink (K1).

The source has no streaming operator: no watermark, window or state.  What
does carry over is that every row-local text operator is a plain column
expression, and that the data set is append-only.  So a stream of question
rows can be normalised and appended as it arrives; the stateful steps
(segmentation, attribution, placement) stay batch jobs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from lectern.functions.text import normalise_question
from lectern.session import ensure_checkpoint_dir


def normalised_questions(stream: DataFrame, text_col: str = "text") -> DataFrame:
    """F4 on every arriving row; works on batch and streaming frames alike."""
    return stream.withColumn(text_col, normalise_question(F.col(text_col)))


def append_stream(spark: SparkSession, source_dir: str, schema, sink_dir: str, name: str,
                  text_col: str = "text", once: bool = True) -> StreamingQuery:
    """Read Parquet files of question rows as they land in ``source_dir``,
    normalise them and append JSON lines to ``sink_dir``.  Progress is kept
    under the session's checkpoint folder, so a restarted job resumes
    without writing a row twice."""
    ckpt = f"{ensure_checkpoint_dir(spark).rstrip('/')}/stream-{name}"
    src = spark.readStream.schema(schema).parquet(source_dir)
    w = (normalised_questions(src, text_col).writeStream.format("json").outputMode("append")
         .option("path", sink_dir).option("checkpointLocation", ckpt))
    w = w.trigger(availableNow=True) if once else w.trigger(processingTime="30 seconds")
    return w.start()
