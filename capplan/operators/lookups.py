"""Joins of inpatient spells to the two reference lookups.

Neither join carries a broadcast hint: Spark broadcasts a lookup by its own size
check, and where a lookup is too large for that, adaptive execution splits the skewed
spell side of a left join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def add_specialty_type(spells: DataFrame, lookup: DataFrame) -> DataFrame:
    """Add ``tretspef_type``; the text code of a spell equals the number in the lookup.

    A code that is no number has no type. (A plain comparison of text and number would
    fail on such codes under ANSI mode.)
    """
    types = lookup.select(F.col("tretspef").alias("_specialty"), "tretspef_type")
    code = F.col("tretspef").try_cast("bigint")
    return spells.join(types, code == F.col("_specialty"), "left").drop("_specialty")


def add_theatre_time(spells: DataFrame, theatre_times: DataFrame) -> DataFrame:
    """Add the lookup's columns by the full procedure code; one row per lookup match."""
    return spells.join(theatre_times, F.col("primary_procedure") == F.col("opcs_code"), "left")


def add_theatre_total(spells: DataFrame, theatre_times: DataFrame) -> DataFrame:
    """Add ``theatre_rows`` and ``theatre_time`` without ever multiplying spells.

    A procedure listed k times in the lookup counts a spell k times in theatre totals;
    here that is a weight of k and the sum of the k times, so the same spells can feed
    the other areas in the same pass. A procedure whose times are all NULL keeps its weight
    and has an unknown time; one with known and unknown times fails the query, as a spell
    would belong to two labels.
    """
    known, rows = F.count("theatre_time"), F.count(F.lit(1))
    code = F.coalesce(F.col("primary_procedure"), F.lit("NULL"))
    mixed = F.raise_error(F.concat(F.lit("theatre times partly unknown: "), code))
    per_code = (
        theatre_times.groupBy(F.col("opcs_code").alias("primary_procedure"))
        .agg(
            known.alias("_known"),
            rows.alias("_rows"),
            F.sum("theatre_time").alias("theatre_time"),
        )
        .select(
            "primary_procedure",
            F.when(F.col("_known").isin(0, F.col("_rows")), F.col("_rows"))
            .otherwise(mixed)
            .alias("theatre_rows"),
            "theatre_time",
        )
    )
    return spells.join(per_code, "primary_procedure", "left").withColumn(
        "theatre_rows", F.coalesce("theatre_rows", F.lit(1))
    )
