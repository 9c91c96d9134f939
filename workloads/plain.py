"""The areas in their straightforward form, as a yardstick for results and time.

Baseline left join results, one aggregation for the runs and one for the baseline, and
a distinct key skeleton joined back for the zero rows. Nothing is shared or broadcast
on purpose.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

import capplan as cp
from capplan.plans.areas import KEYS, OP_CONVERTED_LABEL, OUTPATIENT_SUMS, SDEC_LABEL, Area
from workloads.queries import Inputs


def left_overlay(base: DataFrame, results: DataFrame, replaced: list[str]) -> DataFrame:
    return base.drop("model_run", *replaced).join(results, "rn", "left")


def merge_converted(totals: DataFrame, converted: DataFrame) -> DataFrame:
    return (
        totals.unionByName(converted)
        .groupBy(*KEYS, "grouping")
        .agg(F.sum("total").alias("total"))
    )


def emergency(baseline: DataFrame, results: DataFrame, conversion: DataFrame) -> DataFrame:
    runs = cp.label_totals(left_overlay(baseline, results, ["arrivals"]), cp.EMERGENCY)
    merged = merge_converted(runs, cp.converted_totals(conversion, "arrivals", SDEC_LABEL))
    return cp.fill_missing_labels(
        merged.unionByName(cp.label_totals(baseline, cp.EMERGENCY)), cp.EMERGENCY.required
    )


def outpatients(baseline: DataFrame, results: DataFrame, conversion: DataFrame) -> DataFrame:
    def long(rows: DataFrame) -> DataFrame:
        return cp.unpivot_totals(cp.outpatient_totals(rows))

    runs = long(left_overlay(baseline, results, ["attendances", "tele_attendances"]))
    converted = cp.converted_totals(conversion, "attendances", OP_CONVERTED_LABEL)
    return cp.fill_missing_labels(
        merge_converted(runs, converted).unionByName(long(baseline)), list(OUTPATIENT_SUMS)
    )


def inpatients(
    area: Area, spells: DataFrame, results: DataFrame, theatre_times: DataFrame | None = None
) -> DataFrame:
    if area is cp.PROCEDURES:
        spells = cp.add_theatre_time(cp.theatre_scope(spells), theatre_times)
    runs = left_overlay(spells, results, ["speldur", "classpat"])
    totals = cp.label_totals(runs, area).unionByName(cp.label_totals(spells, area))
    return cp.fill_missing_labels(totals, area.required, area.label_column)


AREAS: dict[str, Callable[[Inputs], DataFrame]] = {
    "aae_areas": lambda i: emergency(*i.emergency),
    "op_areas": lambda i: outpatients(*i.outpatients),
    "ip_daycase": lambda i: inpatients(cp.DAYCASE, *i.inpatients),
    "ip_maternity": lambda i: inpatients(cp.MATERNITY, *i.inpatients),
    "ip_wards": lambda i: inpatients(cp.WARDS, *i.inpatients),
    "ip_procedures_and_theatres": lambda i: inpatients(
        cp.PROCEDURES, *i.inpatients, i.theatre_times
    ),
}
