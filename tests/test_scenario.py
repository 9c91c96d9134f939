"""A whole scenario from folders to written tables and the manifest."""

import pytest
from pyspark.sql import functions as F

import capplan as cp
from capplan import schemas
from capplan.plans import batch
from capplan.sinks.tables import append_manifest, area_path, positions, read_manifest
from capplan.sources.activity import baseline_folder
from capplan.sources.scenarios import aggregated_path
from tests.builders import bag
from workloads.queries import Inputs

SF = "/root/testdata/sf0.001"
PATH = "full-model-results/v4.1/R01/full-plan/20250101-120000/"


@pytest.fixture(scope="module")
def inputs(spark):
    return Inputs(spark, SF)


@pytest.fixture(scope="module")
def roots(inputs, tmp_path_factory):
    root = tmp_path_factory.mktemp("scenario")
    roots = cp.Roots(f"{root}/data", f"{root}/results", f"{root}/output")
    for kind in ("aae", "op", "ip"):
        leaf = f"{roots.model_data}/v4.0.2/{kind}/fyear=2023/dataset=R01"
        raw = inputs[f"{kind}_baseline"].drop("model_run").withColumnRenamed("rn", "index")
        raw.write.parquet(leaf)
        inputs[f"{kind}_results"].write.partitionBy("model_run").parquet(f"{roots.results}/{PATH}{kind}")
    for name in ("sdec_conversion", "op_conversion"):
        inputs[name].write.parquet(f"{roots.results}/{PATH}{name}")
    params = root / "results" / aggregated_path(PATH)
    params.mkdir(parents=True)
    (params / "params.json").write_text('{"start_year": "2023"}')
    return roots


@pytest.fixture(scope="module")
def entry(spark, inputs, roots):
    return cp.run_scenario(
        spark, PATH, roots, versions(spark), inputs.specialties, inputs.theatre_times, "dev", "run-1"
    )


def versions(spark):
    return spark.createDataFrame([("v3.9.9",), ("v4.0.1",), ("v4.0.2",), ("dev",)], "name string")


def test_six_tables_are_written(spark, inputs, roots, entry):
    expected = {
        "aae": cp.emergency_areas(*inputs.emergency),
        "op": cp.outpatient_areas(*inputs.outpatients),
        "ip_daycase": cp.daycase_areas(*inputs.inpatients),
        "ip_maternity": cp.maternity_areas(*inputs.inpatients),
        "ip_wards": cp.ward_areas(*inputs.inpatients),
        "ip_procedures_and_theatres": cp.procedure_areas(*inputs.inpatients, inputs.theatre_times),
    }
    for name, table in expected.items():
        written = spark.read.parquet(area_path(roots.output, "dev", "run-1", name))
        assert written.columns == table.columns
        assert bag(written) == bag(table), name


def test_files_are_in_order_of_run(spark, roots, entry):
    written = spark.read.parquet(area_path(roots.output, "dev", "run-1", "ip_wards"))
    ranges = (
        written.selectExpr("_metadata.file_name AS file", "coalesce(model_run, 999) AS run")
        .groupBy("file")
        .agg({"run": "min", "*": "count"})
        .orderBy("file")
        .collect()
    )
    starts = [row["min(run)"] for row in ranges]
    assert starts == sorted(starts)


def test_the_manifest_lists_the_run(spark, roots, entry):
    listed = read_manifest(spark, roots.manifest).collect()
    assert [row.asDict() for row in listed] == [entry]
    assert entry["app_version"] == "v4.1" and entry["dataset"] == "R01"
    assert entry["scenario_name"] == "full-plan" and entry["results_path"] == PATH


def test_a_listed_run_is_refused(spark, roots, entry):
    with pytest.raises(ValueError, match="already lists"):
        append_manifest(entry, roots.manifest)
    append_manifest(entry | {"run_id": "run-2"}, roots.manifest)
    assert read_manifest(spark, roots.manifest).count() == 2
    with pytest.raises(ValueError, match="unknown fields"):
        append_manifest({"run_id": "run-3"}, roots.manifest)


def test_no_fitting_version_is_an_error(spark, inputs, roots):
    late = spark.createDataFrame([("v9.0.0",)], "name string")
    with pytest.raises(ValueError, match="no data version"):
        cp.scenario_tables(spark, PATH, roots, late, inputs.specialties, inputs.theatre_times)


def test_a_batch_gives_each_scenario_its_tables(spark, inputs, tmp_path):
    """Two scenarios on one baseline, one of them with a third of the results."""
    roots = cp.Roots(f"{tmp_path}/data", f"{tmp_path}/results", f"{tmp_path}/output")
    paths = [f"full-model-results/v4.0/R01/full plan+{n}/2025/" for n in (1, 2)]
    for kind in ("aae", "op", "ip"):
        raw = inputs[f"{kind}_baseline"].drop("model_run").withColumnRenamed("rn", "index")
        raw.write.parquet(f"{roots.model_data}/v4.0.2/{kind}/fyear=2023/dataset=R01")
    sources = {
        "aae": "aae_results",
        "op": "op_results",
        "ip": "ip_results",
        "sdec_conversion": "sdec_conversion",
        "op_conversion": "op_conversion",
    }
    for path, share in zip(paths, ("true", "model_run = 1")):
        for folder, name in sources.items():
            rows = inputs[name].where(share)
            writer = rows.write.partitionBy("model_run") if "conversion" not in name else rows.write
            writer.parquet(f"{roots.results}/{path}{folder}")
        params = tmp_path / "results" / aggregated_path(path)
        params.mkdir(parents=True)
        (params / "params.json").write_text('{"start_year": 2023}')
    lookups = (versions(spark), inputs.specialties, inputs.theatre_times)
    batch = cp.batch_tables(spark, paths, roots, *lookups)
    assert set(batch) == {"aae", "op", "ip"}
    for path in paths:
        alone, _ = cp.scenario_tables(spark, path, roots, *lookups)
        mine = {name: table.where(table["path"] == path).drop("path") for name, table in batch.items()}
        assert bag(mine["aae"]) == bag(alone["aae"])
        assert bag(mine["op"]) == bag(alone["op"])
        for name in ("ip_daycase", "ip_maternity", "ip_wards", "ip_procedures_and_theatres"):
            assert bag(cp.area_table(mine["ip"], name)) == bag(alone[name]), name
    with pytest.raises(ValueError, match="no data version"):
        late = spark.createDataFrame([("v9.0.0",)], "name string")
        cp.batch_tables(spark, paths, roots, late, inputs.specialties, inputs.theatre_times)


def test_no_provider_loses_its_baseline(spark, inputs, tmp_path):
    """Providers with a plus sign, a space or only digits, each in a scenario of its own."""
    roots = cp.Roots(f"{tmp_path}/data", f"{tmp_path}/results", f"{tmp_path}/output")
    providers = ("A+B", "R 1", "007")
    paths = [f"full-model-results/v4.0/{provider}/plan/2025/" for provider in providers]
    inputs_of = {"aae": "aae", "op": "op", "ip": "ip"}
    for provider, path in zip(providers, paths, strict=True):
        for kind in inputs_of:
            raw = inputs[f"{kind}_baseline"].drop("model_run").withColumnRenamed("rn", "index")
            raw.coalesce(1).write.parquet(f"{roots.model_data}/v4.0.2/{kind}/fyear=2023/dataset={provider}")
            inputs[f"{kind}_results"].coalesce(1).write.parquet(f"{roots.results}/{path}{kind}")
        for name in ("sdec_conversion", "op_conversion"):
            inputs[name].coalesce(1).write.parquet(f"{roots.results}/{path}{name}")
        params = tmp_path / "results" / aggregated_path(path)
        params.mkdir(parents=True)
        (params / "params.json").write_text('{"start_year": 2023}')
    lookups = (versions(spark), inputs.specialties, inputs.theatre_times)
    batch = cp.batch_tables(spark, paths, roots, *lookups)["aae"]
    expected = bag(cp.emergency_areas(*inputs.emergency))
    for path in paths:
        assert bag(batch.where(batch["path"] == path).drop("path")) == expected, path
    one, _ = cp.scenario_tables(spark, paths[2], roots, *lookups)
    assert bag(one["aae"]) == expected
    with pytest.raises(ValueError, match="more than once"):
        cp.batch_tables(spark, [paths[0], paths[0].rstrip("/")], roots, *lookups)


def test_of_writers_with_one_key_the_first_is_kept(spark, entry, tmp_path):
    path = f"{tmp_path}/manifest"
    assert read_manifest(spark, path).count() == 0
    append_manifest(entry | {"run_id": "a/b c", "dataset": "first"}, path)
    with pytest.raises(ValueError, match="already lists"):
        append_manifest(entry | {"run_id": "a/b c", "dataset": "second"}, path)
    append_manifest(entry | {"run_id": "a", "dataset": "third"}, path)
    assert sorted((r.run_id, r.dataset) for r in read_manifest(spark, path).collect()) == [("a", "third"), ("a/b c", "first")]


def test_positions_follow_the_order_of_runs(spark):
    rows = [(r, s, n) for r in (2, None, 0, 10, 1) for s in ("B", None, "A") for n in range(3)]
    frame = spark.createDataFrame(rows, "model_run int, sitetret string, total int").repartition(5)
    table = positions(frame)
    found = [(r.model_run, r.sitetret, r.total) for r in table.orderBy("position").collect()]
    assert found == sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1] is not None, r[1] or "", r[2]))
    assert sorted(r.position for r in table.collect()) == list(range(1, len(rows) + 1))
    plan = table._jdf.queryExecution().executedPlan().toString()
    assert "Window" in plan and "Exchange SinglePartition" not in plan.split("Window")[1].split("Sort")[0]


def test_a_batch_finds_its_datasets_by_cutting_locations(spark, tmp_path):
    """A pattern over the whole location was searched for every row; odd names of providers are found without one."""
    kinds = {f.name: f.dataType.simpleString() for f in schemas.BASELINES["aae"].fields if f.name not in ("rn", "model_run")}
    named = [(0, 0, "v4.0.2", 2023, "R0 1+%x"), (1, 1, "v4.0.2", 2024, "R0/2")]
    for dataset, _, version, year, provider in named:
        folder = tmp_path / "data" / baseline_folder(version, "aae", year, provider)
        columns = [F.lit("S" if c == "sitetret" else None).cast(t).alias(c) for c, t in kinds.items()]
        spark.range(3 + dataset).select(F.col("id").alias("index"), *columns).write.parquet(str(folder))
    keys = spark.createDataFrame(named, "scenario int, dataset int, data_version string, fyear int, provider string")
    roots = cp.Roots(str(tmp_path / "data"), str(tmp_path), str(tmp_path))
    found = batch._baselines(spark, roots, keys, "aae")
    assert {r["dataset"]: r["count"] for r in found.groupBy("dataset").count().collect()} == {0: 3, 1: 4}
    assert "regexp" not in found._jdf.queryExecution().toString()
