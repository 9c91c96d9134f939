"""Emergency attendances: labels are decided by the baseline, arrivals by the run."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from capplan.operators.densify import dense_totals, label_list
from capplan.operators.overlay import NullRun, Shared, base_keys, replay
from capplan.operators.totals import converted_rows
from capplan.plans.areas import EMERGENCY, KEYS, SDEC_LABEL


def emergency_areas(
    baseline: DataFrame,
    results: DataFrame,
    conversion: DataFrame,
    *,
    by: Sequence[str] = (),
    null_run: NullRun = "keep",
    fill_conversion_site: str | None = None,
    broadcast: bool | None = None,
    shared: Shared | None = None,
) -> DataFrame:
    """``(model_run, sitetret, grouping, total)`` for baseline and runs.

    ``conversion`` is activity moved from inpatients to same-day emergency care; it is
    added to that label run by run.
    """
    labelled = baseline.select(
        *base_keys(by, shared), "rn", *KEYS, "arrivals", EMERGENCY.label().alias(EMERGENCY.label_column)
    )
    attendances = replay(
        labelled, results, sums=["arrivals"], by=by, null_run=null_run, broadcast=broadcast, shared=shared
    )
    converted = converted_rows(
        conversion, "arrivals", by=by, fill_site=fill_conversion_site, null_run=null_run
    ).withColumn(EMERGENCY.label_column, F.lit(SDEC_LABEL))
    columns = [*by, *KEYS, EMERGENCY.label_column, F.col("arrivals").alias("total")]
    rows = attendances.select(columns).unionByName(converted.select(columns))
    return dense_totals(
        rows, label_list(EMERGENCY.required), EMERGENCY.measures, EMERGENCY.label_column, by=by
    )
