"""Session settings, shared work folders and the SQL helper function."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_SETTING = "spark.checkpoint.dir"


def build_session(app_name: str = "eventloom", master: str | None = None, **settings) -> SparkSession:
    """Return a session with the settings every job relies on."""
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.ui.enabled", "false")
    )
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def run_dir(spark: SparkSession, purpose: str) -> str:
    """A new folder for one run, below the folder the cluster names for checkpoints.

    Only a local session may fall back to a temporary folder: executors on other
    machines would not see it.
    """
    base = spark.conf.get(CHECKPOINT_SETTING, None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"set {CHECKPOINT_SETTING} to a folder all executors share")
        base = tempfile.mkdtemp(prefix="eventloom-")
        spark.conf.set(CHECKPOINT_SETTING, base)
    return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def register_json_extract(spark: SparkSession) -> None:
    """Make ``json_extract(text, path)`` usable in SQL written for other engines."""
    spark.sql(
        "CREATE OR REPLACE TEMPORARY FUNCTION json_extract(document STRING, path STRING) "
        "RETURNS STRING RETURN get_json_object(document, CASE WHEN startswith(path, '$') THEN path "
        "ELSE raise_error('a JSON path starts with $') END)"
    )


def written(rows: DataFrame, purpose: str) -> DataFrame:
    """Write a result that later steps read several times and go on from the files.

    The files outlive lost executors, and what led to them is computed only once. They stay
    until the folder is cleared, so they are packed closer than by default.
    """
    path = run_dir(rows.sparkSession, purpose)
    rows.write.parquet(path, compression="zstd")
    return rows.sparkSession.read.parquet(path)
