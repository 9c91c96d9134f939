"""Inpatient areas: day cases, maternity, wards, procedures and theatres.

The four areas are independent views of the same spells, and all depend on the length
of stay and patient class of the run. ``inpatient_areas`` produces any subset of them
from one read of the results and one overlay: each spell row gets one label per area,
rows are summed per run, site and label combination, and only that small table is
taken apart by area.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from capplan.functions.labelling import atoms_of, facts, holds
from capplan.functions.vocabulary import RUN_ATOMS
from capplan.operators.densify import dense_totals, label_list
from capplan.operators.lookups import add_theatre_total
from capplan.operators.overlay import NullRun, Shared, base_keys, replay, result_keys
from capplan.operators.totals import theatre_scope
from capplan.plans.areas import (
    DAYCASE,
    INPATIENT_AREAS,
    KEYS,
    MATERNITY,
    PROCEDURES,
    WARDS,
    Area,
)

_SUMS = ("spells", "beddays")
_SCOPE = "in_theatre_scope"


def _atoms(areas: Sequence[Area]) -> tuple[tuple[str, ...], tuple[str, ...]]:
    """Atoms the areas need, those fixed by the baseline and those that vary by run."""
    needed = atoms_of(rule for area in areas for _, rule in area.rules)
    if PROCEDURES in areas:
        needed = atoms_of([(atom,) for atom in needed] + [(_SCOPE,)])
    fixed = tuple(atom for atom in needed if atom not in RUN_ATOMS)
    return fixed, tuple(atom for atom in needed if atom in RUN_ATOMS)


def _varying(run_atoms: Sequence[str]) -> list[Column]:
    """What a run, or the baseline itself, says about one spell.

    The facts of a run tell apart a dozen combinations of patient class and length of
    stay at most, which bounds what one record can hold per run after merging.
    """
    return [
        facts(run_atoms).alias("run_facts"),
        F.lit(1).cast("bigint").alias("spells"),
        F.col("speldur").alias("beddays"),
    ]


def _spell_rows(
    baseline: DataFrame,
    results: DataFrame,
    theatre_times: DataFrame | None,
    areas: Sequence[Area],
    by: Sequence[str],
    null_run: NullRun,
    broadcast: bool | None,
    shared: Shared | None,
) -> DataFrame:
    """Weighted spell rows of the baseline and of every run, each with its facts."""
    fixed_atoms, run_atoms = _atoms(areas)
    fixed = [*base_keys(by, shared), "rn", "sitetret", facts(fixed_atoms).alias("facts")]
    spells = baseline
    if areas == [PROCEDURES]:
        spells = theatre_scope(spells)
    if PROCEDURES in areas:
        if theatre_times is None:
            raise ValueError("procedures and theatres need theatre_times")
        spells = add_theatre_total(spells, theatre_times)
        fixed += ["theatre_rows", "theatre_time"]
    rows = replay(
        spells.select(*fixed, "model_run", *_varying(run_atoms)),
        results.select(*result_keys(by, shared), "rn", "model_run", *_varying(run_atoms)),
        classes=["run_facts"],
        sums=_SUMS,
        by=by,
        null_run=null_run,
        broadcast=broadcast,
        shared=shared,
    )
    # a baseline record in no run is one spell of unknown class and stay
    weight = F.when(F.col("rn").isNull(), 0).otherwise(F.coalesce("spells", F.lit(1)))
    rows = rows.withColumns(
        {
            "spells": weight.cast("bigint"),
            "facts": F.col("facts").bitwiseOR(F.coalesce("run_facts", F.lit(0).cast("bigint"))),
        }
    )
    if PROCEDURES in areas:
        rows = rows.withColumns(
            {
                "theatre_spells": F.col("spells") * F.col("theatre_rows"),
                "theatre_time": F.col("spells") * F.col("theatre_time"),
            }
        )
    return rows


def _values(area: Area) -> dict[str, Column]:
    """What a row of summed spells adds to each measure of the area."""
    if area is PROCEDURES:
        return {"spells": F.col("theatre_spells"), "total_theatre_time": F.col("theatre_time")}
    if area is DAYCASE:
        return {"total": F.col("spells")}
    return {"spells": F.col("spells"), "beddays": F.col("beddays")}


def _single_area(
    area: Area,
    baseline: DataFrame,
    results: DataFrame,
    theatre_times: DataFrame | None = None,
    *,
    required: Sequence[str] | None = None,
    by: Sequence[str] = (),
    null_run: NullRun = "keep",
    broadcast: bool | None = None,
    shared: Shared | None = None,
) -> DataFrame:
    rows = _spell_rows(baseline, results, theatre_times, [area], by, null_run, broadcast, shared)
    labelled = rows.withColumn(area.label_column, area.label_of("facts"))
    values = [value.alias(name) for name, value in _values(area).items()]
    return dense_totals(
        labelled.select(*by, *KEYS, area.label_column, *values),
        label_list(required or area.required),
        area.measures,
        area.label_column,
        by=by,
    )


def daycase_areas(baseline: DataFrame, results: DataFrame, **options) -> DataFrame:
    """``(model_run, sitetret, grouping, total)``: day case spells.

    Options of this and the other area functions: ``by`` (further key columns),
    ``null_run`` ("keep" or "drop" baseline records in no run), ``broadcast`` (skip
    the size check of the baseline and decide it here) and ``shared`` (datasets whose
    baseline several scenarios share).
    """
    return _single_area(DAYCASE, baseline, results, **options)


def maternity_areas(baseline: DataFrame, results: DataFrame, **options) -> DataFrame:
    """``(model_run, sitetret, grouping, spells, beddays)``: maternity spells."""
    return _single_area(MATERNITY, baseline, results, **options)


def ward_areas(baseline: DataFrame, results: DataFrame, **options) -> DataFrame:
    """``(model_run, sitetret, grouping, spells, beddays)``: ward spells and bed days."""
    return _single_area(WARDS, baseline, results, **options)


def procedure_areas(
    baseline: DataFrame,
    results: DataFrame,
    theatre_times: DataFrame,
    *,
    dense_all: bool = False,
    **options,
) -> DataFrame:
    """``(model_run, sitetret, procedure_grouping, spells, total_theatre_time)``.

    ``dense_all`` also gives the labels with a known time, and unknown procedures, to
    every run and site.
    """
    required = PROCEDURES.labels if dense_all else PROCEDURES.required
    return _single_area(PROCEDURES, baseline, results, theatre_times, required=required, **options)


def inpatient_areas(
    baseline: DataFrame,
    results: DataFrame,
    theatre_times: DataFrame | None = None,
    *,
    areas: Sequence[str] = tuple(INPATIENT_AREAS),
    by: Sequence[str] = (),
    null_run: NullRun = "keep",
    broadcast: bool | None = None,
    shared: Shared | None = None,
) -> DataFrame:
    """Several inpatient areas in one pass, as rows of one table.

    ``(area, model_run, sitetret, grouping, spells, beddays, total_theatre_time)``;
    measures an area does not have are NULL. ``area_table`` gives a single area's table.
    """
    chosen = [INPATIENT_AREAS[name] for name in areas]
    rows = _spell_rows(baseline, results, theatre_times, chosen, by, null_run, broadcast, shared)
    labels = {area.name: area.label_of("facts") for area in chosen}
    measures = list(_SUMS)
    if PROCEDURES in chosen:
        labels[_SCOPE] = holds("facts", _SCOPE)
        measures += ["theatre_spells", "theatre_time"]
    combined = rows.withColumns(labels).groupBy(*by, *KEYS, *labels).agg(
        *[F.sum(name).alias(name) for name in measures]
    )

    days = combined.schema["beddays"].dataType
    nothing = F.lit(None)

    def entry(area: Area) -> Column:
        values = _values(area)
        time = values.get("total_theatre_time", nothing).cast("double")
        return F.struct(
            F.lit(area.name).alias("area"),
            F.col(area.name).alias("grouping"),
            values.get("spells", values.get("total")).alias("spells"),
            values.get("beddays", nothing).cast(days).alias("beddays"),
            time.alias("total_theatre_time"),
        )

    entries = [
        F.when(F.col(_SCOPE), entry(area)) if area is PROCEDURES else entry(area)
        for area in chosen
    ]
    long = combined.select(*by, *KEYS, F.inline(F.array_compact(F.array(*entries))))
    required = F
    for area in chosen:
        required = required.when(F.col("area") == area.name, label_list(area.required))
    dense = dense_totals(
        long, required, ["spells", "beddays", "total_theatre_time"], by=[*by, "area"]
    )
    has_days = F.col("area").isin(*[a.name for a in chosen if "beddays" in a.measures])
    has_time = F.col("area") == PROCEDURES.name
    return dense.select(
        *by,
        "area",
        *KEYS,
        "grouping",
        "spells",
        F.when(has_days, F.col("beddays")).alias("beddays"),
        F.when(has_time, F.col("total_theatre_time")).alias("total_theatre_time"),
    )


def area_table(combined: DataFrame, name: str, by: Sequence[str] = ()) -> DataFrame:
    """One area's own table out of the result of ``inpatient_areas``."""
    area = INPATIENT_AREAS[name]
    source = {"total": "spells"}
    return combined.where(F.col("area") == name).select(
        *by,
        *KEYS,
        F.col("grouping").alias(area.label_column),
        *[F.col(source.get(measure, measure)).alias(measure) for measure in area.measures],
    )
