"""The same column rules over files that keep arriving."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventloom.operators.quality import route_answers

FILES_PER_TRIGGER = 1000


def stream_jsonl(spark: SparkSession, path: str, schema: T.StructType, files_per_trigger: int = FILES_PER_TRIGGER):
    """Follow a folder of JSON-lines files."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).json(path)


def route_stream(records: DataFrame, out: str, checkpoint: str):
    """Route records as they arrive, one output folder per route, until the input is used up."""
    return (
        route_answers(records)
        .writeStream.format("parquet")
        .partitionBy("route")
        .option("path", out)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def count_errors_stream(errors: DataFrame, out: str, checkpoint: str):
    """Keep error counts per class; each batch writes the whole small table to a folder of its own.

    A batch that is run again after a failure writes the same folder again.
    """
    counts = errors.groupBy("error_type").agg(F.count(F.lit(1)).alias("n"))

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.withColumn("batch_id", F.lit(batch_id).cast("bigint")).write.mode("overwrite").parquet(
            f"{out}/batch={batch_id}"
        )

    return (
        counts.writeStream.outputMode("complete")
        .foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def latest_counts(spark: SparkSession, out: str) -> DataFrame:
    """The counts as of the last batch."""
    batches = spark.read.parquet(f"{out}/batch=*")
    newest = batches.agg(F.max("batch_id")).scalar()
    return batches.where(F.col("batch_id") == newest).select("error_type", "n")
