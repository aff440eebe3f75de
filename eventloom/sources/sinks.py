"""Writers for routed records, error logs and reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventloom.sources.appends import append_once


def write_split(rows: DataFrame, path: str, run_id: str, column: str = "route") -> bool:
    """Append a run to all outputs in one pass, one folder per value of a column: routes, decisions, splits.

    The same run twice leaves one copy; False if it was there already.
    """
    return append_once(rows, path, run_id, by=column)


def write_error_log(errors: DataFrame, path: str, run_id: str) -> bool:
    """Append the failed conversations of a run with their messages, one folder per error class.

    The same run twice leaves one copy; False if it was there already.
    """
    return append_once(errors, path, run_id, by="error_type")


def report_lines(summary: DataFrame, breakdown: DataFrame, source: str | None = None, errors_path: str | None = None) -> DataFrame:
    """The benchmark report as ordered lines, built from its two small tables.

    ``source`` names the test cases and adds headings, ``errors_path`` says where the failed conversations were written.
    """

    def text(name: str):
        return F.col(name).cast("string")

    rate = F.format_string("Success rate: (%.2f ± %.2f)%%", F.col("success_rate") * 100, F.col("standard_error") * 100)
    figures = [
        *([F.lit("BENCHMARK SUMMARY"), F.lit(f"Test cases: {source}")] if source else []),
        F.concat(F.lit("Total: "), text("n_total")),
        F.concat(F.lit("Success: "), text("n_success")),
        rate,
        F.concat(F.lit("Mean time of successes: "), F.coalesce(text("mean_seconds"), F.lit("none")), F.lit(" s")),
        F.concat(F.lit("Failed: "), text("n_failed")),
        *([F.lit("Errors by class:")] if source else []),
    ]
    head = summary.select(F.posexplode(F.array(*figures)).alias("place", "line")).select(
        "place", F.lit(0).cast("bigint").alias("rank"), "line"
    )
    errors = breakdown.select(
        F.lit(len(figures)).alias("place"),
        (-F.col("n")).alias("rank"),
        F.concat(F.lit("  "), "error_type", F.lit(": "), text("n")).alias("line"),
    )
    lines = head.unionByName(errors)
    if errors_path:
        last = summary.select(F.lit(len(figures) + 1).alias("place"), F.lit(0).cast("bigint").alias("rank"), F.lit(f"Errors written to: {errors_path}").alias("line"))
        lines = lines.unionByName(last)
    return lines.orderBy("place", "rank", "line").select("line")


def write_report(summary: DataFrame, breakdown: DataFrame, path: str, source: str | None = None, errors_path: str | None = None) -> None:
    """The report has one line per error class, so one file is right for it."""
    report_lines(summary, breakdown, source, errors_path).coalesce(1).write.mode("overwrite").text(path)
