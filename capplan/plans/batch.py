"""Many scenarios in one job: the area tables with the scenario's path as a leading key.

Scenarios differ in size, so running them one after the other leaves a cluster idle at
the end of each. Here all of them are one set of files. The folder a row was read from
is turned into the number of its scenario by a hash lookup, and that number is one more
key of every grouping; the path itself is put back on the small results. Scenarios of
one data version, year and provider share a dataset, whose baseline is read and joined
once (``Shared``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from capplan import schemas
from capplan.operators.lookups import add_specialty_type
from capplan.operators.overlay import Shared
from capplan.operators.versions import NO_VERSION, resolve_versions
from capplan.plans.areas import EMERGENCY
from capplan.plans.emergency import emergency_areas
from capplan.plans.inpatients import inpatient_areas
from capplan.plans.outpatients import outpatient_areas
from capplan.plans.scenario import OUTPATIENT_NAME, Roots
from capplan.sources import scenarios
from capplan.sources.activity import as_baseline, baseline_folder
from capplan.sources.layouts import read_files, read_runs
from capplan.sources.scenarios import decoded

SCENARIO = "scenario"
INPATIENT_NAME = "ip"
DATASET = "dataset"
_DATASET_PARTS = ["data_version", "fyear", "provider"]


def _folder_above(folder: str) -> Column:
    """Location up to the last ``/folder/`` in it."""
    below = F.length(F.substring_index("_location", f"/{folder}/", -1))
    return F.left("_location", F.length("_location") - below - F.lit(len(folder) + 2))


def _runs(
    spark: SparkSession,
    roots: Roots,
    keys: DataFrame,
    paths: Sequence[str],
    folder: str,
    schema: T.StructType,
) -> DataFrame:
    root = roots.results.rstrip("/")
    rows = read_runs(spark, [f"{root}/{path.strip('/')}/{folder}" for path in paths], schema, folder)
    numbers = keys.select(SCENARIO, DATASET, F.col("location").alias("_folder"))
    numbered = _matched(rows.withColumn("_folder", _folder_above(folder)), numbers, "_folder", SCENARIO)
    return numbered.select(SCENARIO, DATASET, *schema.names)


def _matched(rows: DataFrame, numbers: DataFrame, folder: str, number: str) -> DataFrame:
    """``rows`` with the number of their folder; a folder without one fails the query."""
    lost = F.raise_error(F.concat(F.lit(f"no {number} has the folder "), F.col(folder)))
    found = rows.join(numbers, folder, "left")
    return found.withColumn(number, F.coalesce(F.col(number), lost.cast("int")))


def _baselines(spark: SparkSession, roots: Roots, keys: DataFrame, kind: str) -> DataFrame:
    """The baseline of every dataset, read once however many scenarios share it."""
    root = roots.model_data.rstrip("/")
    named = keys.select(DATASET, *_DATASET_PARTS).distinct().collect()
    folders = {row[DATASET]: baseline_folder(row["data_version"], kind, row["fyear"], row["provider"]) for row in named}
    rows = as_baseline(read_files(spark, [f"{root}/{f}" for f in sorted(folders.values())]))
    # data version, kind, year and provider: the last four folders above the file
    # (cut off before they are decoded: this runs for every row)
    folder = F.left("_location", F.length("_location") - F.length(F.substring_index("_location", "/", -1)) - 1)
    place = decoded(F.substring_index(folder, "/", -4))
    numbers = spark.createDataFrame(list(folders.items()), f"{DATASET} int, _folder string")
    numbered = _matched(rows.withColumn("_folder", place), numbers, "_folder", DATASET)
    return schemas.require(numbered.drop("_folder", "_location"), schemas.BASELINES[kind], kind)


def scenario_problems(
    spark: SparkSession, paths: Sequence[str], roots: Roots, data_versions: DataFrame
) -> DataFrame:
    """``path`` and ``problem`` of the given paths that cannot be built: what is wrong with their parameters,
    or that no data version fits. A path left out of ``paths`` for it does not end a batch of the others."""
    given = scenarios.read_scenarios(spark, roots.results, paths)
    checked = resolve_versions(scenarios.scenario_params(given), data_versions)
    unfit = F.when(F.col("data_version") == NO_VERSION, F.concat(F.lit("no data version fits "), "model_version"))
    found = checked.select("path", F.coalesce("problem", unfit).alias("problem"))
    return found.where(F.col("problem").isNotNull())


def _scenario_keys(
    spark: SparkSession, paths: Sequence[str], roots: Roots, data_versions: DataFrame
) -> DataFrame:
    """Number, path, dataset (and its number) and encoded results folder of every given path."""
    plain = [path.strip("/") for path in paths]
    twice = sorted({path for path in plain if plain.count(path) > 1})
    if twice:
        raise ValueError(f"listed more than once: {twice}")
    given = scenarios.read_scenarios(spark, roots.results, paths)
    found = resolve_versions(scenarios.scenario_params(given, "location"), data_versions).collect()
    broken = {row["path"]: row["problem"] for row in found if row["problem"] is not None}
    if broken:
        raise ValueError(f"parameters that cannot be used: {broken}")
    unresolved = [row["path"] for row in found if row["data_version"] == NO_VERSION]
    if unresolved:
        raise ValueError(f"no data version fits the model version of {unresolved}")
    columns = ["path", "location", *_DATASET_PARTS]
    datasets: dict[tuple, int] = {}
    of = [datasets.setdefault(tuple(row[name] for name in _DATASET_PARTS), len(datasets)) for row in found]
    return spark.createDataFrame(
        [(number, of[number], *(row[name] for name in columns)) for number, row in enumerate(found)],
        "scenario int, dataset int, path string, location string, data_version string, fyear int, provider string",
    )


def batch_tables(
    spark: SparkSession,
    paths: Sequence[str],
    roots: Roots,
    data_versions: DataFrame,
    specialties: DataFrame,
    theatre_times: DataFrame,
) -> dict[str, DataFrame]:
    """Tables ``aae``, ``op`` and ``ip`` of all scenarios, each led by ``path``.

    ``ip`` is the table of ``inpatient_areas``; ``area_table(ip, name, by=["path"])``
    gives a single area of it. The scenarios' parameters are read, and the baselines measured, before
    the tables are returned; the tables themselves are lazy.
    """
    keys = _scenario_keys(spark, paths, roots, data_versions)

    def runs(folder: str, schema: T.StructType) -> DataFrame:
        return _runs(spark, roots, keys, paths, folder, schema)

    by, shared = [SCENARIO], Shared((DATASET,), keys.select(SCENARIO, DATASET))
    tables = {
        EMERGENCY.name: emergency_areas(
            _baselines(spark, roots, keys, "aae"),
            runs("aae", schemas.EMERGENCY_RESULTS),
            runs("sdec_conversion", schemas.SDEC_CONVERSION),
            by=by,
            shared=shared,
        ),
        OUTPATIENT_NAME: outpatient_areas(
            _baselines(spark, roots, keys, "op"),
            runs("op", schemas.OUTPATIENT_RESULTS),
            runs("op_conversion", schemas.OUTPATIENT_CONVERSION),
            by=by,
            shared=shared,
        ),
        INPATIENT_NAME: inpatient_areas(
            add_specialty_type(_baselines(spark, roots, keys, "ip"), specialties),
            runs("ip", schemas.INPATIENT_RESULTS),
            theatre_times,
            by=by,
            shared=shared,
        ),
    }
    names = keys.select(SCENARIO, "path")
    return {
        name: table.join(names, SCENARIO).select(
            "path", *[column for column in table.columns if column != SCENARIO]
        )
        for name, table in tables.items()
    }
