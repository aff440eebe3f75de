"""JSON-lines in and out, with line numbers where a job needs them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventloom.functions.text import as_column, is_json_object, strip

CORRUPT = "_corrupt_record"


def with_corrupt_column(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])


def read_jsonl(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """One object per line; lines that do not parse keep their text in ``_corrupt_record``."""
    return (
        spark.read.schema(with_corrupt_column(schema))
        .option("columnNameOfCorruptRecord", CORRUPT)
        .json(path)
    )


def write_jsonl(rows: DataFrame, path: str, mode: str = "append") -> None:
    """One object per line, characters kept as they are; ``mode`` is append or overwrite."""
    rows.write.mode(mode).option("ignoreNullFields", "false").json(path)


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """Text lines with their 1-based number in their file: (file, line_no, line).

    Files are read in splits. A line is numbered inside its split, and the lines of the
    earlier splits of the file are added; splits are small, so no file is put in order
    by one task.
    """
    lines = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("split_start"),
        F.monotonically_increasing_id().alias("read_order"),
        F.col("value").alias("line"),
    )
    inside = Window.partitionBy("file", "split_start").orderBy("read_order")
    earlier = Window.partitionBy("file").orderBy("split_start").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        lines.groupBy("file", "split_start")
        .agg(F.count(F.lit(1)).alias("n"))
        .select("file", "split_start", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("lines_before"))
    )
    return (
        lines.withColumn("position", F.row_number().over(inside))
        .join(offsets, ["file", "split_start"])
        .select("file", (F.col("lines_before") + F.col("position")).alias("line_no"), "line")
    )


def load_testcases(lines: DataFrame) -> DataFrame:
    """Test questions from numbered lines; blank lines are dropped.

    A line that is no JSON object or has no question keeps a reason in ``reject_reason``
    instead of ending the job.
    """
    text = strip("line")
    question = F.get_json_object("record", "$.user_question")
    reason = (
        F.when(~is_json_object("record"), F.lit("bad_json"))
        .when(F.coalesce(question, F.lit("")) == "", F.lit("missing_question"))
    )
    return (
        lines.select("line_no", text.alias("record"))
        .where(F.col("record") != "")
        .select(
            "line_no",
            F.when(reason.isNull(), question).alias("user_question"),
            "record",
            reason.alias("reject_reason"),
        )
    )


def resume_from(records: DataFrame, start_row: int, answered: DataFrame | None = None, id_column: str = "qa_id"):
    """Records from a 1-based line on, without those already answered."""
    rest = records.where(as_column("line_no") >= start_row)
    if answered is not None:
        rest = rest.join(answered.select(id_column), id_column, "left_anti")
    return rest
