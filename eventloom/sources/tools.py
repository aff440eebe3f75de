"""The catalogue of tools a model may call."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventloom.vocab import CHECK_ALL, CHECK_TOOLS, NO_INPUT, SQL_TOOL

_TEXT = T.StringType()
TOOLS_SCHEMA = T.StructType(
    [
        T.StructField(
            "tools",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField("type", _TEXT),
                        T.StructField(
                            "function",
                            T.StructType(
                                [
                                    T.StructField("name", _TEXT),
                                    T.StructField("description", _TEXT),
                                    T.StructField(
                                        "parameters",
                                        T.StructType(
                                            [
                                                T.StructField("type", _TEXT),
                                                T.StructField("properties", T.MapType(_TEXT, _TEXT)),
                                                T.StructField("required", T.ArrayType(_TEXT)),
                                                T.StructField("additionalProperties", T.BooleanType()),
                                            ]
                                        ),
                                    ),
                                ]
                            ),
                        ),
                    ]
                )
            ),
        )
    ]
)


def _spec(name: str, description: str, argument: str, argument_spec: dict) -> dict:
    parameters = {
        "type": "object",
        "properties": {argument: argument_spec},
        "required": [argument],
        "additionalProperties": False,
    }
    return {"type": "function", "function": {"name": name, "description": description, "parameters": parameters}}


def default_tools() -> list[dict]:
    """Specifications of the six check tools and of ``execute_sql``."""
    specs = []
    for name, fields in CHECK_TOOLS.items():
        what = "every event type" if name == CHECK_ALL else f"{fields[0]} events"
        specs.append(
            _spec(name, f"Show random rows of {what} with their columns.", "input", {"type": "string", "enum": [NO_INPUT]})
        )
    specs.append(
        _spec(SQL_TOOL, "Run a SELECT over the EVENTS table and return its rows.", "sql", {"type": "string"})
    )
    return specs


def tools_json() -> str:
    return json.dumps(default_tools(), ensure_ascii=False)


def read_tools(spark: SparkSession, path: str) -> DataFrame:
    """One row per tool of a file whose lines carry a ``tools`` array."""
    return _per_tool(spark.read.schema(TOOLS_SCHEMA).json(path))


def tool_catalog(spark: SparkSession) -> DataFrame:
    """The default catalogue as a table of seven rows."""
    line = '{"tools": ' + tools_json() + "}"
    return _per_tool(spark.range(1).select(F.from_json(F.lit(line), TOOLS_SCHEMA).alias("r")).select("r.*"))


def _per_tool(lines: DataFrame) -> DataFrame:
    call = F.col("tool.function")
    return lines.select(F.explode("tools").alias("tool")).select(
        call["name"].alias("tool_name"),
        call["description"].alias("description"),
        F.array_join(F.map_keys(call["parameters"]["properties"]), ",").alias("arguments"),
    )


def tool_usage(catalog: DataFrame, records: DataFrame) -> DataFrame:
    """The catalogue with the number of records that name each tool."""
    used = records.groupBy(F.col("check_tool").alias("tool_name")).agg(F.count(F.lit(1)).alias("n"))
    return catalog.join(used, "tool_name", "left").select(
        "tool_name", "arguments", F.coalesce("n", F.lit(0)).alias("n_records")
    )
