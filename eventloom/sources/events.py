"""Reading and laying out the event table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventloom.vocab import EVENT_COLUMNS

EVENTS_SCHEMA = T.StructType(
    [
        T.StructField("_ID", T.LongType()),
        T.StructField("EVENT", T.StringType()),
        T.StructField("STATE", T.StringType()),
        T.StructField("STATUS", T.StringType()),
        T.StructField("JOB_ID", T.StringType()),
        T.StructField("TIME", T.DoubleType()),
        T.StructField("METADATA", T.StringType()),
    ]
)


def read_events(spark: SparkSession, path: str) -> DataFrame:
    """The event table from Parquet files, columns in their order."""
    return spark.read.schema(EVENTS_SCHEMA).parquet(path).select(*EVENT_COLUMNS)


def write_events(events: DataFrame, path: str, mode: str = "overwrite", rows_per_file: int = 20_000_000) -> None:
    """Lay the table out by EVENT, so that a query about one type reads only its files.

    Ids spread the rows of one type over many tasks; there are only five types.
    """
    slices = F.floor(F.col("_ID") / F.lit(rows_per_file))
    events.withColumn("_slice", slices).repartition("EVENT", "_slice").drop("_slice").write.mode(mode).partitionBy(
        "EVENT"
    ).parquet(path)


def read_database(
    spark: SparkSession, url: str, lowest_id: int, highest_id: int, slices: int, driver: str, table: str = "EVENTS"
) -> DataFrame:
    """The event table from a database over JDBC, in slices of its id (the driver's jar is the user's)."""
    rows = spark.read.jdbc(
        url, table, column="_ID", lowerBound=lowest_id, upperBound=highest_id, numPartitions=slices,
        properties={"driver": driver},
    )
    return rows.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in EVENTS_SCHEMA.fields])
