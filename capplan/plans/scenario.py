"""One scenario end to end: read, build the six tables, write them, list them."""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

from capplan.operators.lookups import add_specialty_type
from capplan.operators.versions import resolve_versions
from capplan.plans.areas import EMERGENCY, INPATIENT_AREAS
from capplan.plans.emergency import emergency_areas
from capplan.plans.inpatients import area_table, inpatient_areas
from capplan.plans.outpatients import outpatient_areas
from capplan.sinks.tables import append_manifest, write_area
from capplan.sources import activity, scenarios

OUTPATIENT_NAME = "op"


@dataclass(frozen=True)
class Roots:
    """Where simulation data lies and output goes; every root is shared storage."""

    model_data: str
    results: str
    output: str

    @property
    def manifest(self) -> str:
        return f"{self.output.rstrip('/')}/manifest"


def _materialised(spark: SparkSession, table: DataFrame, output: str) -> DataFrame:
    """``table`` stored reliably, so that its four readers do not build it four times."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(
            spark.conf.get("spark.checkpoint.dir", None) or f"{output.rstrip('/')}/_checkpoints"
        )
    return table.checkpoint()


def scenario_tables(
    spark: SparkSession,
    path: str,
    roots: Roots,
    data_versions: DataFrame,
    specialties: DataFrame,
    theatre_times: DataFrame,
) -> tuple[dict[str, DataFrame], dict]:
    """The six area tables of the scenario at ``path``, and its identity.

    ``path`` is relative to the results root; ``data_versions`` lists the folders under
    the model data root in a column ``name``. The inpatient areas are computed here, in
    one pass; the other two tables are lazy.
    """
    keys = resolve_versions(
        scenarios.scenario_keys(scenarios.read_scenarios(spark, roots.results, [path])),
        data_versions,
    ).first()
    where = f"{roots.results.rstrip('/')}/{path.strip('/')}"

    def baseline(kind: str) -> DataFrame:
        return activity.read_baseline(
            spark, roots.model_data, keys["data_version"], kind, keys["fyear"], keys["provider"]
        )

    tables = {
        EMERGENCY.name: emergency_areas(
            baseline("aae"),
            activity.read_results(spark, where, "aae"),
            activity.read_sdec_conversion(spark, where),
        ),
        OUTPATIENT_NAME: outpatient_areas(
            baseline("op"),
            activity.read_results(spark, where, "op"),
            activity.read_outpatient_conversion(spark, where),
        ),
    }
    inpatients = _materialised(
        spark,
        inpatient_areas(
            add_specialty_type(baseline("ip"), specialties),
            activity.read_results(spark, where, "ip"),
            theatre_times,
        ),
        roots.output,
    )
    tables |= {name: area_table(inpatients, name) for name in INPATIENT_AREAS}
    return tables, keys.asDict()


def run_scenario(
    spark: SparkSession,
    path: str,
    roots: Roots,
    data_versions: DataFrame,
    specialties: DataFrame,
    theatre_times: DataFrame,
    capacity_version: str = "dev",
    run_id: str | None = None,
) -> dict[str, str]:
    """Build and write the scenario's six tables and append it to the manifest.

    Returns the manifest entry. The entry is written last: a run that fails on the way
    is not listed, and repeating it under the same id replaces what it left.
    """
    started = datetime.now().strftime("%Y%m%d-%H%M%S")
    run_id = run_id or str(uuid.uuid4())
    tables, keys = scenario_tables(
        spark, path, roots, data_versions, specialties, theatre_times
    )
    for name, table in tables.items():
        write_area(table, roots.output, capacity_version, run_id, name)
    entry = {
        "capacity_version": capacity_version,
        "run_id": run_id,
        "app_version": keys["model_version"],
        "scenario_name": keys["scenario_name"],
        "scenario_runtime": keys["scenario_runtime"],
        "dataset": keys["provider"],
        "mapping_runtime": started,
        "results_path": path,
    }
    append_manifest(entry, roots.manifest)
    return entry
