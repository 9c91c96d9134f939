"""Files of two layouts, parameters that name what is wrong with them, tables that appear together."""

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

import capplan as cp
from capplan import schemas
from capplan.sinks import publish
from capplan.sources.layouts import read_runs
from capplan.sources.scenarios import aggregated_path, read_scenarios, scenario_params
from tests.builders import bag

RESULTS = "rn bigint, model_run int, speldur int, classpat string"
ROWS = [(n, 1 + n % 4, None if n == 7 else n % 3, "1") for n in range(20)]


@pytest.fixture
def results(spark):
    return spark.createDataFrame(ROWS, RESULTS)


def test_both_layouts_side_by_side(spark, results, tmp_path):
    results.where("model_run < 3").write.partitionBy("model_run").parquet(f"{tmp_path}/a/ip")
    # the other order of columns, another width and a further column
    results.where("model_run >= 3").selectExpr(
        "classpat", "rn", "speldur", "cast(model_run AS int) AS model_run", "'x' AS more"
    ).write.parquet(f"{tmp_path}/b/ip")
    for folders in (["a/ip", "b/ip"], ["b/ip", "a/ip"]):
        read = read_runs(spark, [f"{tmp_path}/{f}" for f in folders], schemas.INPATIENT_RESULTS)
        assert read.drop("_location").dtypes == results.dtypes
        assert bag(read.drop("_location")) == bag(results)
    assert not [s for s in ("Exchange", "Python") if s in read._jdf.queryExecution().toString()]


def test_a_column_and_a_folder_that_agree(spark, results, tmp_path):
    results.where("model_run = 2").write.parquet(f"{tmp_path}/ip/model_run=2")
    read = read_runs(spark, [f"{tmp_path}/ip"], schemas.INPATIENT_RESULTS)
    assert bag(read.drop("_location")) == bag(results.where("model_run = 2"))
    results.where("model_run = 2").write.parquet(f"{tmp_path}/ip/model_run=3")
    with pytest.raises(PySparkException, match="differs from the folder's"):
        read_runs(spark, [f"{tmp_path}/ip"], schemas.INPATIENT_RESULTS).collect()


def test_other_differences_end_the_read(spark, results, tmp_path):
    results.drop("model_run").write.parquet(f"{tmp_path}/none")
    with pytest.raises(PySparkException, match="no model_run in column or folder"):
        read_runs(spark, [f"{tmp_path}/none"], schemas.INPATIENT_RESULTS).collect()
    results.write.parquet(f"{tmp_path}/kind/1")
    results.withColumn("speldur", F.col("speldur").cast("string")).write.parquet(f"{tmp_path}/kind/2")
    with pytest.raises((PySparkException, Py4JJavaError), match="(?i)merg"):
        read_runs(spark, [f"{tmp_path}/kind"], schemas.INPATIENT_RESULTS).collect()
    results.drop("classpat").write.parquet(f"{tmp_path}/lacking")
    with pytest.raises(ValueError, match="classpat: missing"):
        read_runs(spark, [f"{tmp_path}/lacking"], schemas.INPATIENT_RESULTS)


@pytest.mark.parametrize(
    ("text", "fyear", "problem"),
    [
        ('{"start_year": 2023}', 2023, None),
        ('{"start_year": "2023", "more": {"x": [1]}}', 2023, None),
        ('{\n "start_year": 2023\n}\n', 2023, None),
        ('{"start_year": 2023', None, 'no JSON object: {"start_year": 2023'),
        ("not json", None, "no JSON object: not json"),
        ('[{"start_year": 2023}]', None, 'no JSON object: [{"start_year": 2023}]'),
        ("{}", None, "no start year"),
        ('{"start_year": null}', None, "no start year"),
        ('{"start_year": "MMXXIII"}', None, "no start year: MMXXIII"),
        ('{"start_year": 2023.5}', None, "no start year: 2023.5"),
        ("", None, "no parameters"),
        (" \n", None, "no parameters"),
        (None, None, "no parameters"),
    ],
)
def test_parameters_say_what_is_wrong(spark, text, fyear, problem):
    path = "full-model-results/v4.1/R01/full-plan/20250101-120000/"
    rows = spark.createDataFrame([(path, text), (path, '{"start_year": 2020}')], "path string, params string")
    found = scenario_params(rows).collect()
    assert [(r["fyear"], r["problem"]) for r in found] == [(fyear, problem), (2020, None)]
    assert found[0]["provider"] == "R01" and found[0]["aggregated_path"] == aggregated_path(path)


def test_a_broken_file_names_itself(spark, tmp_path):
    roots = cp.Roots(f"{tmp_path}/data", f"{tmp_path}/results", f"{tmp_path}/output")
    paths = [f"full-model-results/v4.{n}/R01/plan/2025/" for n in range(3)]
    for path, text in zip(paths, ['{"start_year": 2023}', '{"start_year"', '{"start_year": 2022}'], strict=True):
        folder = tmp_path / "results" / aggregated_path(path)
        folder.mkdir(parents=True)
        (folder / "params.json").write_text(text)
    assert scenario_params(read_scenarios(spark, roots.results, paths)).where("problem is null").count() == 2
    versions = spark.createDataFrame([("v4.1.0",)], "name string")
    problems = dict(cp.scenario_problems(spark, paths, roots, versions).collect())
    assert problems == {paths[0]: "no data version fits v4.0", paths[1]: 'no JSON object: {"start_year"'}
    with pytest.raises(ValueError, match="v4.1/R01"):
        cp.batch_tables(spark, paths, roots, versions, None, None)


def _table(spark, *totals):
    return spark.createDataFrame([(n, "A", "resus", t) for n, t in enumerate(totals)], "model_run int, sitetret string, grouping string, total int")


def test_readers_see_the_old_tables_until_the_commit(spark, tmp_path):
    where = (str(tmp_path), "dev", "run-1")
    old, new = {"aae": _table(spark, 1, 2), "op": _table(spark, 5)}, {"aae": _table(spark, 3), "op": _table(spark, 6)}
    with pytest.raises(ValueError, match="not published"):
        publish.read_area(spark, *where, "aae")
    assert publish.publish_areas(old, *where) == 1
    before = publish.read_area(spark, *where, "aae")
    attempt = publish.write_attempt(new, *where)
    assert all(bag(publish.read_area(spark, *where, name)) == bag(old[name]) for name in old)
    assert publish.commit_attempt(spark, attempt, list(new), *where) == 2
    assert all(bag(publish.read_area(spark, *where, name)) == bag(new[name]) for name in new)
    # what a reader holds does not change under it
    assert bag(before) == bag(old["aae"])
    with pytest.raises(ValueError, match="not published"):
        publish.read_area(spark, *where, "ip_wards")


def test_a_failed_attempt_is_not_seen(spark, tmp_path):
    where = (str(tmp_path), "dev", "run-1")
    publish.publish_areas({"aae": _table(spark, 1), "op": _table(spark, 2)}, *where)
    failing = _table(spark, 1, 2).withColumn("total", F.when(F.col("total") > 1, F.raise_error(F.lit("lost")).cast("int")))
    with pytest.raises(PySparkException):
        publish.publish_areas({"aae": _table(spark, 9), "op": failing}, *where)
    assert bag(publish.read_area(spark, *where, "aae")) == bag(_table(spark, 1))
    assert publish.commits(spark, *where).count() == 1
    with pytest.raises(ValueError, match="no tables"):
        publish.publish_areas({}, *where)
