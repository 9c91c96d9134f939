"""Every operator as a query over the whole derived inputs."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import capplan as cp
from capplan.functions.vocabulary import PREDICATES, predicate
from capplan.operators.presence import bitmaps, occurs
from capplan.operators.versions import resolve_versions
from capplan.plans.areas import KEYS, OP_CONVERTED_LABEL, SDEC_LABEL, Area
from capplan.schemas import RESULTS
from capplan.sinks.publish import publish_areas, read_area, write_attempt
from capplan.sinks.tables import by_run, check_entries, positions
from capplan.sources.activity import as_baseline, baseline_folder, simulated_defaults
from capplan.sources.layouts import read_runs
from capplan.sources.lookups import clean_theatre_times, specialty_lookup
from capplan.sources.scenarios import aggregated_path, scenario_keys, scenario_params
from workloads.fixtures import derived

Query = Callable[[SparkSession, str], DataFrame]

EMERGENCY_PREDICATES = (
    "adult", "child", "emergency_department", "resus", "major", "minor", "sdec",
    "adult_minor", "adult_major", "child_minor", "child_major",
)
OUTPATIENT_PREDICATES = ("op_procedure", "op_first", "op_follow_up")
INPATIENT_PREDICATES = tuple(
    name
    for name in PREDICATES
    if name not in (*EMERGENCY_PREDICATES[2:], *OUTPATIENT_PREDICATES)
)  # adult and child are in both lists


class Inputs:
    """The derived inputs of one scale folder, as the library's users would hold them."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark, self._dir = spark, sf_dir

    def __getitem__(self, name: str) -> DataFrame:
        return derived(self.spark, self._dir, name)

    @property
    def specialties(self) -> DataFrame:
        return specialty_lookup(self["tretspef_lookup_raw"])

    @property
    def theatre_times(self) -> DataFrame:
        return clean_theatre_times(self["theatre_times_raw"])

    @property
    def spells(self) -> DataFrame:
        return cp.add_specialty_type(self["ip_baseline"], self.specialties)

    @property
    def theatre_spells(self) -> DataFrame:
        return cp.add_theatre_time(cp.theatre_scope(self.spells), self.theatre_times)

    @property
    def emergency(self) -> tuple[DataFrame, DataFrame, DataFrame]:
        return self["aae_baseline"], self["aae_results"], self["sdec_conversion"]

    @property
    def outpatients(self) -> tuple[DataFrame, DataFrame, DataFrame]:
        return self["op_baseline"], self["op_results"], self["op_conversion"]

    @property
    def inpatients(self) -> tuple[DataFrame, DataFrame]:
        return self.spells, self["ip_results"]

    def area_totals(self, area: Area) -> DataFrame:
        """Totals of all runs and the baseline, not yet dense."""
        spells = self.theatre_spells if area is cp.PROCEDURES else self.spells
        runs = cp.overlay(spells, self["ip_results"], ["speldur", "classpat"])
        return cp.label_totals(runs, area).unionByName(cp.label_totals(spells, area))


def _truth(rows: DataFrame, names: tuple[str, ...]) -> DataFrame:
    return rows.select("rn", *[predicate(name).alias(name) for name in names])


def _labels(rows: DataFrame, area: Area) -> DataFrame:
    return cp.label_rows(rows, area).select("rn", area.label_column)


def _emergency_totals(rows: DataFrame) -> DataFrame:
    return cp.label_totals(rows, cp.EMERGENCY)


def _emergency_runs(i: Inputs) -> DataFrame:
    return _emergency_totals(cp.overlay(i["aae_baseline"], i["aae_results"], ["arrivals"]))


def _emergency_with_sdec(i: Inputs) -> DataFrame:
    converted = cp.converted_totals(i["sdec_conversion"], "arrivals", SDEC_LABEL)
    return (
        _emergency_runs(i)
        .unionByName(converted)
        .groupBy(*KEYS, "grouping")
        .agg(F.sum("total").alias("total"))
    )


def _default_comparison(i: Inputs) -> DataFrame:
    return cp.reconcile_runs(
        cp.emergency_areas(*i.emergency), simulated_defaults(i["default_results"], "aae")
    )


def _wards_by_scenario(i: Inputs) -> DataFrame:
    """Three scenarios on one baseline, told apart by a further key."""
    return cp.ward_areas(
        i.spells.withColumn("scenario", F.explode(F.array(*map(F.lit, range(3))))),
        i["scenario_results"],
        by=["scenario"],
    )


def _reconciled_visits(i: Inputs) -> DataFrame:
    """Outpatients by run, by site and by kind; activity converted from inpatient care is a column of its own."""
    kind = F.when(F.col("grouping") == OP_CONVERTED_LABEL, "procedure").otherwise("other")
    ours = cp.outpatient_areas(*i.outpatients).where(~F.col("grouping").contains("virtual"))
    converted = i["op_conversion"].select("*", F.lit("procedure").alias("kind"))
    return cp.reconcile_levels(
        ours.withColumn("kind", kind),
        i["default_visits"],
        [(), ("sitetret",), ("kind",)],
        converted=converted,
        converted_measure="attendances",
    )


def _reconciled_spells(i: Inputs) -> DataFrame:
    """Inpatient spells by run and by site."""
    ours = cp.overlay(i["ip_baseline"], i["ip_results"], ["speldur", "classpat"], null_run="drop")
    return cp.reconcile_levels(ours.groupBy(*KEYS).agg(F.count("rn").alias("total")), i["default_spells"])


def _wards_by_dataset(i: Inputs) -> DataFrame:
    """The same three scenarios as members of two datasets, each joined once."""
    dataset = F.expr("cast(scenario div 2 AS int) AS dataset")
    results = i["scenario_results"].select("*", dataset)
    members = results.select("scenario", "dataset").distinct()
    spells = i.spells.withColumn("dataset", F.explode(F.array(F.lit(0), F.lit(1))))
    return cp.ward_areas(spells, results, by=["scenario"], shared=cp.Shared(("dataset",), members))


def _shared(spark: SparkSession, name: str) -> str:
    """A new folder that driver and executors share: below the session's checkpoint folder where it names one."""
    root = spark.conf.get("spark.checkpoint.dir", None) or tempfile.gettempdir()
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4()}"


def _store_results(i: Inputs, folder: str) -> list[str]:
    """Inpatient results with odd runs as folders and the others as a column; the two places they lie in."""
    results, places = i["ip_results"], [f"{folder}/ip/folders", f"{folder}/ip/columns"]
    results.where("model_run % 2 = 1").write.partitionBy("model_run").parquet(places[0])
    results.where("model_run % 2 = 0").select("model_run", "classpat", "rn", "speldur").write.parquet(places[1])
    return places


def _results_of_two_layouts(i: Inputs) -> DataFrame:
    places = _store_results(i, _shared(i.spark, "layouts"))
    return read_runs(i.spark, places, RESULTS["ip"]).drop("_location")


def _published(i: Inputs) -> DataFrame:
    """Wards as a reader sees them after an earlier commit was replaced and a further attempt not committed."""
    where = (_shared(i.spark, "published"), "dev", "run-1")
    wards = cp.ward_areas(*i.inpatients)
    publish_areas({"ip_wards": wards.where("model_run = 1")}, *where)
    publish_areas({"ip_wards": wards}, *where)
    write_attempt({"ip_wards": wards.where("model_run = 2")}, *where)
    return read_area(i.spark, *where, "ip_wards")


def _batch_from_folders(i: Inputs) -> DataFrame:
    """Emergency areas of two scenarios from stored baselines, results of either layout, conversions and parameters."""
    root = _shared(i.spark, "batch")
    roots = cp.Roots(f"{root}/data", f"{root}/results", f"{root}/output")
    names = {"aae": "aae_results", "op": "op_results", "ip": "ip_results", "sdec_conversion": "sdec_conversion", "op_conversion": "op_conversion"}
    for kind in ("aae", "op", "ip"):
        raw = i[f"{kind}_baseline"].drop("model_run").withColumnRenamed("rn", "index")
        raw.write.parquet(f"{roots.model_data}/v4.0.2/{baseline_folder('', kind, 2023, 'R01').strip('/')}")
    paths = [f"full-model-results/v4.1/R01/plan-{n}/2025/" for n in (1, 2)]
    for path in paths:
        for folder, name in names.items():
            writer = i[name].write
            if path == paths[0] and name.endswith("_results"):
                writer = writer.partitionBy("model_run")
            writer.parquet(f"{roots.results}/{path}{folder}")
    params = i.spark.createDataFrame([('{"start_year": "2023"}',)], "value string").coalesce(1)
    for path in paths:
        params.write.text(f"{roots.results}/{aggregated_path(path)}params.json")
    versions = i.spark.createDataFrame([("v4.0.2",), ("v9.0.0",)], "name string")
    return cp.batch_tables(i.spark, paths, roots, versions, i.specialties, i.theatre_times)["aae"]


def _records_without_run(i: Inputs) -> DataFrame:
    """Baseline records that no run has, found through bitmaps of record numbers."""
    marked = occurs(i["ip_baseline"].select("rn", "sitetret"), bitmaps(i["ip_results"], "rn"), "rn")
    return marked.where(~F.col("_seen")).drop("_seen")


QUERIES: dict[str, Callable[[Inputs], DataFrame]] = {
    # sources
    "baseline_load": lambda i: as_baseline(i["ip_raw"], index="record_index"),
    "specialty_lookup": lambda i: i.specialties,
    "theatre_times_clean": lambda i: i.theatre_times,
    "default_results_filter": lambda i: simulated_defaults(i["default_results"], "aae"),
    "results_two_layouts": _results_of_two_layouts,
    "batch_from_folders": _batch_from_folders,
    "scenario_params": lambda i: scenario_params(i["scenario_params"]),
    "scenario_keys": lambda i: scenario_keys(i["scenario_paths"]),
    "version_asof": lambda i: resolve_versions(i["version_requests"], i["version_catalogue"]),
    "version_asof_prereleases": lambda i: resolve_versions(i["version_requests"], i["version_prereleases"]),
    # predicates
    "predicates_emergency": lambda i: _truth(i["aae_baseline"], EMERGENCY_PREDICATES),
    "predicates_outpatient": lambda i: _truth(i["op_baseline"], OUTPATIENT_PREDICATES),
    "predicates_inpatient": lambda i: _truth(
        cp.add_theatre_time(i.spells, i.theatre_times), INPATIENT_PREDICATES
    ),
    # labels
    "aae_label_baseline": lambda i: _labels(i["aae_baseline"], cp.EMERGENCY),
    "daycase_label": lambda i: _labels(i.spells, cp.DAYCASE),
    "maternity_label": lambda i: _labels(i.spells, cp.MATERNITY),
    "ward_label": lambda i: _labels(i.spells, cp.WARDS),
    "procedures_label": lambda i: _labels(i.theatre_spells, cp.PROCEDURES),
    # joins
    "tretspef_join": lambda i: i.spells.select("rn", "tretspef", "tretspef_type"),
    "theatre_join": lambda i: i.theatre_spells.select(
        "rn", "primary_procedure", "opcs_description", "theatre_time"
    ),
    "aae_run_overlay": lambda i: cp.overlay(
        i["aae_baseline"], i["aae_results"], ["arrivals"]
    ).select("rn", *KEYS, "arrivals"),
    "op_run_overlay": lambda i: cp.overlay(
        i["op_baseline"], i["op_results"], ["attendances", "tele_attendances"]
    ).select("rn", *KEYS, "attendances", "tele_attendances"),
    "ip_run_overlay": lambda i: cp.overlay(
        i["ip_baseline"], i["ip_results"], ["speldur", "classpat"]
    ).select("rn", *KEYS, "speldur", "classpat", "admimeth"),
    # aggregations before densification
    "aae_baseline_agg": lambda i: _emergency_totals(i["aae_baseline"]),
    "aae_overlay_runs": _emergency_runs,
    "sdec_conversion_agg": lambda i: cp.converted_totals(
        i["sdec_conversion"], "arrivals", SDEC_LABEL
    ),
    "aae_merge_sdec": _emergency_with_sdec,
    "op_wide_agg": lambda i: cp.outpatient_totals(i["op_baseline"]),
    "op_unpivot": lambda i: cp.unpivot_totals(cp.outpatient_totals(i["op_baseline"])),
    "op_conversion_agg": lambda i: cp.converted_totals(
        i["op_conversion"], "attendances", OP_CONVERTED_LABEL
    ),
    "daycase_totals": lambda i: i.area_totals(cp.DAYCASE),
    "maternity_totals": lambda i: i.area_totals(cp.MATERNITY),
    "ward_totals": lambda i: i.area_totals(cp.WARDS),
    "procedure_totals": lambda i: i.area_totals(cp.PROCEDURES),
    # densification
    "run_site_universe": lambda i: cp.run_site_universe(i.area_totals(cp.WARDS)),
    "densify_zero_fill": lambda i: cp.fill_missing_labels(
        i.area_totals(cp.WARDS), cp.WARDS.required
    ),
    "non_required_passthrough": lambda i: cp.fill_missing_labels(
        i.area_totals(cp.PROCEDURES), cp.PROCEDURES.required, "procedure_grouping"
    ).where(~F.col("procedure_grouping").isin(*cp.PROCEDURES.required)),
    # areas
    "aae_areas": lambda i: cp.emergency_areas(*i.emergency),
    "op_areas": lambda i: cp.outpatient_areas(*i.outpatients),
    "ip_daycase": lambda i: cp.daycase_areas(*i.inpatients),
    "ip_maternity": lambda i: cp.maternity_areas(*i.inpatients),
    "ip_wards": lambda i: cp.ward_areas(*i.inpatients),
    "ip_procedures_and_theatres": lambda i: cp.procedure_areas(*i.inpatients, i.theatre_times),
    "ip_all_areas_one_pass": lambda i: cp.inpatient_areas(*i.inpatients, i.theatre_times),
    # the same areas for a baseline too large to broadcast
    "aae_areas_large_baseline": lambda i: cp.emergency_areas(*i.emergency, broadcast=False),
    "op_areas_large_baseline": lambda i: cp.outpatient_areas(*i.outpatients, broadcast=False),
    "ip_all_areas_large_baseline": lambda i: cp.inpatient_areas(
        *i.inpatients, i.theatre_times, broadcast=False
    ),
    # options
    "aae_areas_site_filled": lambda i: cp.emergency_areas(
        *i.emergency, fill_conversion_site="unknown"
    ),
    "ip_wards_matched_only": lambda i: cp.ward_areas(*i.inpatients, null_run="drop"),
    "ip_procedures_dense_all": lambda i: cp.procedure_areas(
        *i.inpatients, i.theatre_times, dense_all=True
    ),
    "ip_wards_by_scenario": _wards_by_scenario,
    "ip_wards_by_dataset": _wards_by_dataset,
    "records_without_run": _records_without_run,
    # output and checks
    "sorted_by_run": lambda i: by_run(cp.ward_areas(*i.inpatients)),
    "published_area": _published,
    "area_positions": lambda i: positions(cp.ward_areas(*i.inpatients)),
    "manifest_append_check": lambda i: check_entries(i["manifest_entries"], i["manifest"]),
    "reconcile_runs": _default_comparison,
    "reconcile_op_levels": _reconciled_visits,
    "reconcile_ip_levels": _reconciled_spells,
}


def queries() -> dict[str, Query]:
    def bind(build: Callable[[Inputs], DataFrame]) -> Query:
        return lambda spark, sf_dir: build(Inputs(spark, sf_dir))

    return {name: bind(build) for name, build in QUERIES.items()}
