"""Aggregations per run, site and label, before densification."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from capplan.functions.vocabulary import predicate
from capplan.operators.overlay import NullRun, simulated
from capplan.plans.areas import EMERGENCY, KEYS, OUTPATIENT_SUMS, Area


def label_rows(df: DataFrame, area: Area) -> DataFrame:
    """``df`` with the area's label column."""
    return df.withColumn(area.label_column, area.label())


def _measure(name: str, area: Area) -> Column:
    if area is EMERGENCY:
        return F.sum("arrivals")
    if name == "beddays":
        return F.sum("speldur")
    if name == "total_theatre_time":
        return F.coalesce(F.sum("theatre_time"), F.lit(0))
    return F.count("rn")


def label_totals(df: DataFrame, area: Area, by: Sequence[str] = ()) -> DataFrame:
    """The area's measures per run, site and label of record-level rows."""
    return (
        label_rows(df, area)
        .groupBy(*by, *KEYS, area.label_column)
        .agg(*[_measure(name, area).alias(name) for name in area.measures])
    )


def theatre_scope(spells: DataFrame) -> DataFrame:
    """Spells with a procedure, outside maternity; an unknown group is out of scope."""
    return spells.where(predicate("in_theatre_scope"))


def outpatient_values() -> list[Column]:
    """One column per outpatient label: what a row adds to it."""
    return [
        (F.col(measure) if name is None else F.when(predicate(name), F.col(measure))).alias(label)
        for label, (measure, name) in OUTPATIENT_SUMS.items()
    ]


def outpatient_totals(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """The four outpatient sums per run and site, one column each."""
    keys = [*by, *KEYS]
    return (
        df.select(*keys, *outpatient_values())
        .groupBy(*keys)
        .agg(*[F.sum(label).alias(label) for label in OUTPATIENT_SUMS])
    )


def unpivot_totals(wide: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Columns of sums to rows ``(grouping, total)``; NULL sums stay as rows."""
    return wide.unpivot([*by, *KEYS], list(OUTPATIENT_SUMS), "grouping", "total")


def converted_rows(
    conversion: DataFrame,
    measure: str,
    *,
    by: Sequence[str] = (),
    fill_site: str | None = None,
    null_run: NullRun = "keep",
) -> DataFrame:
    """Run, site and ``measure`` of activity moved out of inpatient care.

    A converted row without a site stays without one, and so adds nothing to required
    labels, unless ``fill_site`` names a site for it.
    """
    rows = simulated(conversion.select(*by, *KEYS, measure))
    if null_run == "drop":
        rows = rows.where(F.col("model_run").isNotNull())
    return rows if fill_site is None else rows.fillna({"sitetret": fill_site})


def converted_totals(
    conversion: DataFrame,
    measure: str,
    label: str,
    *,
    by: Sequence[str] = (),
    fill_site: str | None = None,
) -> DataFrame:
    """Converted activity summed per run and site, all under one label."""
    return (
        converted_rows(conversion, measure, by=by, fill_site=fill_site)
        .groupBy(*by, *KEYS, F.lit(label).alias("grouping"))
        .agg(F.sum(measure).alias("total"))
    )


