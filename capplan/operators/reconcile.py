"""Comparison of area totals with the simulation's own aggregates, by run and at finer levels."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def reconcile_runs(
    ours: DataFrame,
    theirs: DataFrame,
    our_measure: str = "total",
    their_measure: str = "value",
) -> DataFrame:
    """``(model_run, ours, theirs, difference)`` for every simulated run of either side.

    Both sides are summed by run before they meet. The baseline and the rows of records
    in no run have no counterpart in the aggregates and are left out.
    """
    run = F.col("model_run")
    left = ours.where(run != 0).groupBy("model_run").agg(F.sum(our_measure).alias("ours"))
    right = theirs.where(run != 0).groupBy("model_run").agg(F.sum(their_measure).alias("theirs"))
    return left.join(right, "model_run", "full").select(
        "model_run",
        "ours",
        "theirs",
        (F.coalesce("ours", F.lit(0)) - F.coalesce("theirs", F.lit(0))).alias("difference"),
    )


def reconcile_levels(
    ours: DataFrame,
    theirs: DataFrame,
    levels: Sequence[Sequence[str]] = ((), ("sitetret",)),
    *,
    converted: DataFrame | None = None,
    our_measure: str = "total",
    their_measure: str = "value",
    converted_measure: str = "value",
) -> DataFrame:
    """Comparison at several levels in one pass: ``(level, model_run, keys, ours, converted, theirs, difference)``.

    A level is the run and some more key columns, which all tables have. ``converted`` is activity that ours holds and
    theirs does not; it has a column of its own, so a right run shows a difference of zero. All rows are added up by one
    aggregate over the levels' keys, with map-side combine; columns that a level does not use are NULL in it. The
    baseline and records in no run are left out.
    """
    keys = list(dict.fromkeys(key for level in levels for key in level))
    sides = {"ours": (ours, our_measure), "theirs": (theirs, their_measure)}
    if converted is not None:
        sides["converted"] = (converted, converted_measure)
    names = ("ours", "converted", "theirs")
    rows = None
    for side, (table, measure) in sides.items():
        values = [F.col(measure).cast("double").alias(n) if n == side else F.lit(None).cast("double").alias(n) for n in names]
        part = table.where(F.col("model_run") != 0).select("model_run", *keys, *values)
        rows = part if rows is None else rows.unionByName(part)
    used = [F.when(F.grouping(key) == 0, F.lit(key)) for key in keys]
    sums = rows.groupingSets([["model_run", *level] for level in levels], "model_run", *keys).agg(
        F.concat_ws(",", F.lit("model_run"), *used).alias("level"),
        *[F.coalesce(F.sum(n), F.lit(0.0)).alias(n) for n in names],
    )
    return sums.select(
        "level", "model_run", *keys, *names, (F.col("ours") - F.col("converted") - F.col("theirs")).alias("difference")
    )
