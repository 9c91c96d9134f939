"""Hospital capacity analytics on Spark: simulated activity to areas of care."""

from capplan.functions import PREDICATES, label, predicate
from capplan.operators.densify import dense_totals, fill_missing_labels, run_site_universe
from capplan.operators.lookups import add_specialty_type, add_theatre_time
from capplan.operators.overlay import Shared, overlay, replay
from capplan.operators.reconcile import reconcile_levels, reconcile_runs
from capplan.operators.totals import (
    converted_totals,
    label_rows,
    label_totals,
    outpatient_totals,
    theatre_scope,
    unpivot_totals,
)
from capplan.operators.versions import resolve_versions
from capplan.plans.areas import DAYCASE, EMERGENCY, MATERNITY, PROCEDURES, WARDS, Area
from capplan.plans.batch import batch_tables, scenario_problems
from capplan.plans.emergency import emergency_areas
from capplan.plans.inpatients import (
    area_table,
    daycase_areas,
    inpatient_areas,
    maternity_areas,
    procedure_areas,
    ward_areas,
)
from capplan.plans.outpatients import outpatient_areas
from capplan.plans.scenario import Roots, run_scenario, scenario_tables

__all__ = [
    "DAYCASE", "EMERGENCY", "MATERNITY", "PREDICATES", "PROCEDURES", "WARDS", "Area", "Roots",
    "Shared", "add_specialty_type", "add_theatre_time", "area_table", "batch_tables", "converted_totals",
    "daycase_areas", "dense_totals", "emergency_areas", "fill_missing_labels",
    "inpatient_areas", "label", "label_rows", "label_totals", "maternity_areas",
    "outpatient_areas", "outpatient_totals", "overlay", "predicate", "procedure_areas",
    "reconcile_levels", "reconcile_runs", "replay", "resolve_versions", "run_scenario", "run_site_universe",
    "scenario_problems", "scenario_tables", "theatre_scope", "unpivot_totals", "ward_areas",
]
