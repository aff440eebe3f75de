"""Questions answered over the event table: groups, ranks, conditions, subqueries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventloom.functions.metadata import flat, meta, meta_number, successful
from eventloom.operators.filters import of_event, sent_from


def group_stats(events: DataFrame, by: list[str], key: str) -> DataFrame:
    """Count, mean, least and greatest of a numeric field per group."""
    return (
        events.select(*by, meta_number(key).alias("_x"))
        .groupBy(*by)
        .agg(
            F.count(F.lit(1)).alias("n_events"),
            F.count("_x").alias("n_values"),
            F.round(F.avg("_x"), 6).alias("avg_value"),
            F.min("_x").alias("min_value"),
            F.max("_x").alias("max_value"),
        )
    )


def distinct_meta(events: DataFrame, event: str, key: str) -> DataFrame:
    """Distinct values of a field per job."""
    return (
        of_event(events, event)
        .select("JOB_ID", meta(key).alias("value"))
        .where(F.col("value").isNotNull())
        .distinct()
    )


def distinct_jobs(events: DataFrame, event: str) -> DataFrame:
    """Distinct jobs per site for one event type."""
    return of_event(events, event).select(meta("site").alias("site"), "JOB_ID").distinct()


def conditional_counts(events: DataFrame) -> DataFrame:
    """Per event type: finished, started, successful and long-lasting events."""
    return events.groupBy("EVENT").agg(
        F.count(F.lit(1)).alias("n_events"),
        F.count_if(F.col("STATE") == "Finished").alias("n_finished"),
        F.count_if(F.col("STATE") == "Started").alias("n_started"),
        F.count_if(successful()).alias("n_successful"),
        F.count_if(meta_number("duration") > 10).alias("n_long"),
    )


def transfer_rate(events: DataFrame, site: str) -> DataFrame:
    """Mean rate of a job's successful transfers from one site, in both readings:
    the mean of the single rates, and all bytes over all time."""
    moved = sent_from(events, site).where(successful()).select(
        "JOB_ID", meta_number("size").alias("size"), meta_number("duration").alias("duration")
    )
    return moved.groupBy("JOB_ID").agg(
        F.count(F.lit(1)).alias("n_transfers"),
        F.round(F.avg(F.try_divide("size", "duration")), 3).alias("mean_rate"),
        F.round(F.try_divide(F.sum("size"), F.sum("duration")), 3).alias("overall_rate"),
    )


def rank_sites_read(events: DataFrame) -> DataFrame:
    """Sites by the bytes successfully read there, most first."""
    return (
        of_event(events, "FileRead")
        .where(successful())
        .select(meta("site").alias("site"), meta_number("size").alias("size"))
        .groupBy("site")
        .agg(F.sum("size").alias("total_size"), F.count(F.lit(1)).alias("n_reads"))
        .orderBy(F.desc("total_size"), "site")
    )


def job_queue_time(events: DataFrame) -> DataFrame:
    """Queue time of each job's executions."""
    return (
        of_event(events, "JobExecution")
        .select("JOB_ID", meta_number("total_queue_time").alias("_q"))
        .groupBy("JOB_ID")
        .agg(F.sum("_q").alias("total_queue_time"), F.max("_q").alias("longest_queue_time"))
    )


def job_time_breakdown(events: DataFrame) -> DataFrame:
    """Where each job's time goes, and the stage that takes most of it.

    On equal times the stage named first wins: execution, queue, read, write, transfer.
    """
    timed = events.select("EVENT", "JOB_ID", flat("METADATA", "duration", "total_queue_time").alias("m")).select(
        "EVENT", "JOB_ID", F.col("m.duration").alias("duration"), F.col("m.total_queue_time").alias("queue")
    )

    def spent(event: str, column: str = "duration"):
        total = F.sum(F.when(F.col("EVENT") == event, F.col(column)))
        return F.round(F.coalesce(total, F.lit(0.0)), 6)

    stages = {
        "execution": spent("JobExecution"),
        "queue": spent("JobExecution", "queue"),
        "read": spent("FileRead"),
        "write": spent("FileWrite"),
        "transfer": spent("FileTransfer"),
    }
    times = timed.groupBy("JOB_ID").agg(*[total.alias(f"{stage}_time") for stage, total in stages.items()])
    longest = F.greatest(*[F.col(f"{stage}_time") for stage in stages])
    dominant = F.coalesce(*[F.when(F.col(f"{stage}_time") == longest, F.lit(stage)) for stage in stages])
    return times.withColumn("dominant_stage", dominant)


def site_frequencies(events: DataFrame) -> DataFrame:
    """How often each site occurs among the allocations: the weights of a fair draw."""
    return (
        of_event(events, "JobAllocation").groupBy(meta("site").alias("site")).agg(F.count(F.lit(1)).alias("n_events"))
    )


def top_by(events: DataFrame, event: str, key: str, k: int = 10) -> DataFrame:
    """The k successful events with the greatest value, value shown, ties by id."""
    return (
        of_event(events, event)
        .where(successful())
        .select("_ID", "JOB_ID", meta_number(key).alias(key))
        .where(F.col(key).isNotNull())
        .orderBy(F.desc(key), "_ID")
        .limit(k)
    )


def events_of_jobs(events: DataFrame, jobs: DataFrame) -> DataFrame:
    """Events whose job occurs in another result."""
    return events.join(jobs.select("JOB_ID"), "JOB_ID", "left_semi")


def jobs_with(events: DataFrame, event: str, key: str, above: float) -> DataFrame:
    return of_event(events, event).where(meta_number(key) > above).select("JOB_ID")
