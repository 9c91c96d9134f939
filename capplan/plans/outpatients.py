"""Outpatient attendances: four sums per run and site, turned into rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from capplan.operators.overlay import NullRun, Shared, base_keys, replay
from capplan.operators.totals import converted_rows, outpatient_values, unpivot_totals
from capplan.plans.areas import KEYS, OP_CONVERTED_LABEL, OUTPATIENT_SUMS


def outpatient_areas(
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

    ``conversion`` is activity moved from inpatients to outpatient procedures. The four
    labels are columns of one aggregation, so every run and site has all of them and the
    output is dense by construction.
    """
    keys = [*by, *KEYS]
    counted = ["attendances", "tele_attendances"]
    records = baseline.select(*base_keys(by, shared), "rn", *KEYS, "has_procedures", "is_first", *counted)
    visits = replay(
        records, results, sums=counted, by=by, null_run=null_run, broadcast=broadcast, shared=shared
    )
    converted = converted_rows(
        conversion, "attendances", by=by, fill_site=fill_conversion_site, null_run=null_run
    )
    rows = visits.select(*keys, *outpatient_values()).unionByName(
        converted.withColumnRenamed("attendances", OP_CONVERTED_LABEL), allowMissingColumns=True
    )
    # a NULL run or site equals no key of the dense output: zero there
    keyed = F.col("model_run").isNotNull() & F.col("sitetret").isNotNull()
    wide = (
        rows.groupBy(*keys)
        .agg(*[F.sum(label).alias(label) for label in OUTPATIENT_SUMS])
        .select(
            *keys,
            *[
                F.coalesce(F.when(keyed, F.col(label)), F.lit(0)).alias(label)
                for label in OUTPATIENT_SUMS
            ],
        )
    )
    return unpivot_totals(wide, by)
