"""Appends that may be repeated: a run that is written again replaces itself, an unfinished one is never seen.

Each append names its run. Its rows go to a folder of that run, and when they are all there the run is
entered in a manifest beside them. Readers follow the manifest. So a driver that lost its connection
may write the same run again, and what a killed run left behind is overwritten or never read.
"""

from __future__ import annotations

import re

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ROWS, MANIFEST = "rows", "manifest"
RUN = "run_id"


def finished_runs(spark: SparkSession, path: str) -> list[str]:
    """The runs entered so far: one name for each append."""
    try:
        entered = spark.read.schema(f"{RUN} string").json(f"{path}/{MANIFEST}/*")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return []
    return sorted(r[0] for r in entered.distinct().collect())


def append_once(rows: DataFrame, path: str, run_id: str, by: str | None = None, kind: str = "json") -> bool:
    """Append the rows of a run, in one folder per value of ``by`` if given; False if the run is there already."""
    if not re.fullmatch(r"[A-Za-z0-9_.-]+", run_id):
        raise ValueError(f"a run is named by letters, digits, _ . and -: {run_id}")
    spark = rows.sparkSession
    if run_id in finished_runs(spark, path):
        return False
    writer = rows.write.mode("overwrite").format(kind)
    if kind == "json":
        writer = writer.option("ignoreNullFields", "false")
    (writer.partitionBy(by) if by else writer).save(f"{path}/{ROWS}/{RUN}={run_id}")
    entry = spark.range(1).select(F.lit(run_id).alias(RUN)).coalesce(1)
    entry.write.mode("overwrite").json(f"{path}/{MANIFEST}/{run_id}")
    return True


def read_appended(spark: SparkSession, path: str, schema: str, kind: str = "json") -> DataFrame:
    """All rows of finished runs, with their ``run_id``."""
    runs = finished_runs(spark, path)
    if not runs:
        return spark.createDataFrame([], f"{schema}, {RUN} string")
    folders = [f"{path}/{ROWS}/{RUN}={run}" for run in runs]
    return spark.read.schema(f"{schema}, {RUN} string").format(kind).option("basePath", f"{path}/{ROWS}").load(folders)
