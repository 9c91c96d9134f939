"""Scenario identity: what a results path and its parameters file say."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed format: full-<folder>/<model version>/<provider>/<scenario>/<run time>/, with
# the aggregates and params.json under aggregated-<folder>/ and the same rest.
FULL_PREFIX = "full-"
AGGREGATED_PREFIX = "aggregated-"
PARAMS_FILE = "params.json"
#: What is read of a parameters file; a year may be a number or text.
PARAMS = "start_year STRING, _broken STRING"
_PARTS = ("model_version", "provider", "scenario_name", "scenario_runtime")


def aggregated_path(path: str) -> str:
    """The aggregates' folder of a results path; only the leading folder differs."""
    if not path.startswith(FULL_PREFIX):
        raise ValueError(f"a results path starts with {FULL_PREFIX!r}, got {path!r}")
    return AGGREGATED_PREFIX + path.removeprefix(FULL_PREFIX)


def scenario_keys(scenarios: DataFrame, *kept: str) -> DataFrame:
    """Identity columns of ``(path, params)`` rows, ``params`` being the JSON text.

    Adds model version, provider, scenario name and run time from the path, the start
    year as ``fyear`` (text or number in the file) and ``aggregated_path``; ``kept``
    columns are passed on.
    """
    return _identity(scenarios, F.get_json_object("params", "$.start_year").cast("int"), *kept)


def _identity(scenarios: DataFrame, fyear: Column, *kept: str) -> DataFrame:
    parts = F.split("path", "/")
    return scenarios.select(
        "path",
        *kept,
        *[F.get(parts, index).alias(name) for index, name in enumerate(_PARTS, start=1)],
        fyear.alias("fyear"),
        F.regexp_replace("path", f"^{FULL_PREFIX}", AGGREGATED_PREFIX).alias("aggregated_path"),
    )


def scenario_params(scenarios: DataFrame, *kept: str) -> DataFrame:
    """``scenario_keys`` with the parameters read by a declared schema, and what is wrong with them.

    ``problem`` is NULL where a start year was found (a number, or a number as text) and else says what a file
    lacks; ``fyear`` is NULL there. A file that is no JSON object names itself and ends no other's read.
    """
    text = F.trim("params", F.lit(" \t\r\n"))
    parsed = F.from_json("params", PARAMS, {"columnNameOfCorruptRecord": "_broken"})
    year = F.when(F.col("_params.start_year").rlike("^[0-9]{1,9}$"), F.col("_params.start_year")).cast("int")
    broken = F.col("_params").isNull() | F.col("_params._broken").isNotNull()
    problem = (
        F.when(F.col("params").isNull() | (text == ""), "no parameters")
        .when(broken, F.concat(F.lit("no JSON object: "), F.substring(text, 1, 60)))
        .when(F.col("_params.start_year").isNull(), "no start year")
        .when(year.isNull(), F.concat(F.lit("no start year: "), F.substring("_params.start_year", 1, 60)))
    )
    read = scenarios.withColumn("_params", parsed).withColumn("problem", problem)
    return _identity(read, F.when(F.col("problem").isNull(), year), *kept, "problem")


def decoded(location: Column) -> Column:
    """A location in file metadata as plain text; they are percent-encoded, but a plus sign is one."""
    return F.url_decode(F.replace(location, F.lit("+"), F.lit("%2B")))


def read_scenarios(spark: SparkSession, results_root: str, paths: Sequence[str]) -> DataFrame:
    """``(path, params, location)`` of the given results paths, one row per scenario.

    ``location`` is the results folder as file metadata spell it, percent-encoded. Spark
    lists and reads the parameter files, or folders of one file; a path that does not exist fails the read.
    """
    root = results_root.rstrip("/")
    files = [f"{root}/{aggregated_path(path).rstrip('/')}/{PARAMS_FILE}" for path in paths]
    pattern = rf"^(.*/){AGGREGATED_PREFIX}([^/]+(?:/[^/]+){{4}})/{PARAMS_FILE}(?:/[^/]+)?$"
    file = F.col("_metadata.file_path")
    relative = F.concat(F.lit(FULL_PREFIX), F.regexp_extract(file, pattern, 2))
    return spark.read.text(files, wholetext=True).select(
        F.concat(decoded(relative), F.lit("/")).alias("path"),
        F.col("value").alias("params"),
        F.concat(F.regexp_extract(file, pattern, 1), relative).alias("location"),
    )
