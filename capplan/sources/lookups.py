"""The specialty and theatre time lookups, from raw tables or CSV exports."""

from __future__ import annotations

import csv

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Headings of the theatre time export, and its columns here.
THEATRE_HEADINGS = {
    "Dominant Procedure (OPCS Code)": "opcs_code",
    "Dominant Procedure (OPCS Description)": "opcs_description",
    "Avg Theatre Time (in minutes, where Theatre time recorded)": "theatre_time",
}
THEATRE_HEADER_LINE = 8

# Decimal text, or an infinity; Spark's own cast would also take "12d" and hexadecimals.
_NUMBER = r"(?i)^\s*[+-]?(\d+\.?\d*(e[+-]?\d+)?|\.\d+(e[+-]?\d+)?|inf(inity)?)\s*$"


def specialty_lookup(raw: DataFrame, type_column: str | None = None) -> DataFrame:
    """``(tretspef, tretspef_type)`` from a raw code list.

    The type is in ``type_column``, by default the column whose heading ends in
    "categorisation". A code that is no number, or occurs twice, fails the query that
    uses the lookup: it would lose or multiply spells.
    """
    if type_column is None:
        matches = [name for name in raw.columns if name.lower().endswith("categorisation")]
        if len(matches) != 1:
            raise ValueError(f"expected one categorisation column, found {matches}")
        type_column = matches[0]
    code = F.col("tretspef").cast("bigint")
    return (
        raw.select(code.alias("tretspef"), F.col(f"`{type_column}`").alias("tretspef_type"))
        .groupBy("tretspef")
        .agg(F.count(F.lit(1)).alias("rows"), F.max("tretspef_type").alias("tretspef_type"))
        .select(
            "tretspef",
            F.when(
                F.col("rows") > 1,
                F.raise_error(
                    F.concat(F.lit("specialty listed twice: "), F.col("tretspef").cast("string"))
                ),
            )
            .otherwise(F.col("tretspef_type"))
            .alias("tretspef_type"),
        )
    )


def clean_theatre_times(raw: DataFrame) -> DataFrame:
    """``(opcs_code, opcs_description, theatre_time)`` with numeric times only.

    Text that is no number becomes NULL, and rows with any NULL or NaN are dropped.
    """
    time = F.col("theatre_time")
    if isinstance(raw.schema["theatre_time"].dataType, T.StringType):
        time = F.when(time.rlike(_NUMBER), time.try_cast("double"))
    return raw.select(
        "opcs_code", "opcs_description", time.cast("double").alias("theatre_time")
    ).dropna()


def _read_table(spark: SparkSession, path: str) -> DataFrame:
    if path.rstrip("/").endswith(".csv"):
        return spark.read.csv(path, header=True)
    return spark.read.parquet(path)


def read_specialty_lookup(
    spark: SparkSession, path: str, type_column: str | None = None
) -> DataFrame:
    """The specialty lookup from a CSV export or a parquet table."""
    return specialty_lookup(_read_table(spark, path), type_column)


def read_theatre_times(
    spark: SparkSession, path: str, header_line: int = THEATRE_HEADER_LINE
) -> DataFrame:
    """Theatre times from the CSV export, whose headings follow a preface, or parquet.

    Only the lines up to the headings come to the driver. Preface and heading rows have
    no number in the time column, so cleaning drops them.
    """
    if not path.rstrip("/").endswith(".csv"):
        raw = spark.read.parquet(path)
        if "opcs_code" not in raw.columns:
            raw = raw.withColumnsRenamed(THEATRE_HEADINGS)
        return clean_theatre_times(raw)
    top = [row["value"] for row in spark.read.text(path).head(header_line)]
    headings = next(csv.reader(top[-1:]), [])
    missing = [heading for heading in THEATRE_HEADINGS if heading not in headings]
    if missing:
        raise ValueError(f"line {header_line} of {path} lacks the headings {missing}")
    positions = T.StructType(
        [T.StructField(f"_c{index}", T.StringType()) for index in range(len(headings))]
    )
    raw = spark.read.schema(positions).csv(path)
    return clean_theatre_times(
        raw.select(
            *[
                F.col(f"_c{headings.index(heading)}").alias(name)
                for heading, name in THEATRE_HEADINGS.items()
            ]
        )
    )
