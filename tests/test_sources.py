"""Readers: lookups, versions, scenario identity, partition folders, contracts."""

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

import capplan as cp
from capplan import schemas
from capplan.operators.versions import resolve_versions
from capplan.sources import activity, lookups, scenarios
from tests.builders import TIMES, bag, spells

RAW_TIMES = "opcs_code string, opcs_description string, theatre_time string"


def test_specialty_codes_match_by_number(spark):
    base = spells(spark, *[{"tretspef": t} for t in ("361", "&", None, "0361", "361x", "362")])
    lookup = spark.createDataFrame([(361, "Medical/Other")], "tretspef bigint, tretspef_type string")
    typed = cp.add_specialty_type(base.drop("tretspef_type"), lookup).orderBy("rn")
    assert [row["tretspef_type"] for row in typed.collect()] == [
        "Medical/Other", None, None, "Medical/Other", None, None,
    ]


def test_specialty_lookup_finds_its_column(spark):
    raw = spark.createDataFrame(
        [("100", "Surgical", "x"), ("300", "Medical/Other", "y")],
        "tretspef string, `Own categorisation` string, note string",
    )
    expected = [(100, "Surgical"), (300, "Medical/Other")]
    assert bag(lookups.specialty_lookup(raw)) == expected
    renamed = raw.withColumnRenamed("Own categorisation", "kind")
    assert bag(lookups.specialty_lookup(renamed, "kind")) == expected
    with pytest.raises(ValueError, match="categorisation"):
        lookups.specialty_lookup(renamed)


def test_specialty_lookup_refuses_repeats_and_text(spark):
    schema = "tretspef string, categorisation string"
    twice = spark.createDataFrame([("100", "Surgical"), ("100", "Surgical")], schema)
    with pytest.raises(PySparkException, match="listed twice: 100"):
        lookups.specialty_lookup(twice).collect()
    text = spark.createDataFrame([("abc", "Surgical")], schema)
    with pytest.raises(PySparkException):
        lookups.specialty_lookup(text).collect()


@pytest.mark.parametrize(
    ("text", "value"),
    [
        ("35.5", 35.5), (" 12.5 ", 12.5), ("inf", float("inf")), ("-Infinity", float("-inf")),
        ("1e2", 100.0), (".5", 0.5), ("7.", 7.0),
        ("*", None), ("NaN", None), ("", None), ("12d", None), ("3f", None), ("0x1p3", None), (None, None),
    ],
)
def test_theatre_time_text(spark, text, value):
    raw = spark.createDataFrame([("A11", "x", text)], RAW_TIMES)
    found = [row["theatre_time"] for row in lookups.clean_theatre_times(raw).collect()]
    assert found == ([] if value is None else [value])


def test_theatre_times_need_all_columns(spark):
    raw = spark.createDataFrame([("A11", None, "1"), (None, "x", "1"), ("B", "y", "2")], RAW_TIMES)
    assert bag(lookups.clean_theatre_times(raw)) == [("B", "y", 2.0)]
    numbers = spark.createDataFrame([("A", "x", float("nan")), ("B", "y", 2.0)], TIMES)
    assert bag(lookups.clean_theatre_times(numbers)) == [("B", "y", 2.0)]


def test_theatre_times_from_a_csv_with_a_preface(spark, tmp_path):
    code, text, time = lookups.THEATRE_HEADINGS
    preface = ["Theatre times", "", '"Produced, 2024"', "7,8,9", "", "Notes", ""]
    lines = [
        *preface,
        f'Chapter,"{code}","{text}",Spells,"{time}"',
        "W,W371,Total hip,100,92.5",
        'G,G451,"Endoscopy, upper",50,*',
        "R,R171,,10,47",
        "X,X998,Other,1,12",
    ]
    path = tmp_path / "times.csv"
    path.write_text("\n".join(lines) + "\n")
    assert bag(lookups.read_theatre_times(spark, str(path))) == [
        ("W371", "Total hip", 92.5),
        ("X998", "Other", 12.0),
    ]
    with pytest.raises(ValueError, match="lacks the headings"):
        lookups.read_theatre_times(spark, str(path), header_line=7)


def test_lookups_from_parquet(spark, tmp_path):
    spark.createDataFrame(
        [("W371", "hip", "92"), ("X", "y", "*")],
        ", ".join(f"`{heading}` string" for heading in lookups.THEATRE_HEADINGS),
    ).write.parquet(f"{tmp_path}/times")
    assert bag(lookups.read_theatre_times(spark, f"{tmp_path}/times")) == [("W371", "hip", 92.0)]
    (tmp_path / "types.csv").write_text("tretspef,Own categorisation\n100,Surgical\n")
    assert bag(lookups.read_specialty_lookup(spark, f"{tmp_path}/types.csv")) == [(100, "Surgical")]


CATALOGUE = ["v3.5.0", "v3.5.2", "v3.6.0", "v4.0.1", "v4.0.10", "v4.2.0", "dev", "v4.2", "v5.1.0rc"]


@pytest.mark.parametrize(
    ("request_", "expected"),
    [
        ("v4.0", "v4.0.10"), ("v4.1", "v4.0.10"), ("v3.4", "N/A"), ("v5.0", "v4.2.0"),
        ("v3.5", "v3.5.2"), ("4.2", "v4.2.0"), ("v3.9", "v3.6.0"), ("v4", "v4.0.10"), ("dev", "N/A"),
    ],
)
def test_versions(spark, request_, expected):
    catalogue = spark.createDataFrame([(name,) for name in CATALOGUE], "name string")
    requests = spark.createDataFrame([(1, request_), (2, request_)], "id int, model_version string")
    resolved = resolve_versions(requests, catalogue).collect()
    assert [(row["id"], row["data_version"]) for row in resolved] == [(1, expected), (2, expected)]


def test_versions_of_an_empty_catalogue(spark):
    catalogue = spark.createDataFrame([], "name string")
    requests = spark.createDataFrame([("v4.0",), (None,)], "model_version string")
    assert {row[1] for row in resolve_versions(requests, catalogue).collect()} == {"N/A"}


def test_scenario_identity(spark):
    path = "full-model-results/v4.1/R01/full-plan/20250101-120000/"
    rows = spark.createDataFrame([(path, '{"start_year": "2023"}')], "path string, params string")
    found = scenarios.scenario_keys(rows).first().asDict()
    assert found == {
        "path": path,
        "model_version": "v4.1",
        "provider": "R01",
        "scenario_name": "full-plan",
        "scenario_runtime": "20250101-120000",
        "fyear": 2023,
        "aggregated_path": "aggregated-model-results/v4.1/R01/full-plan/20250101-120000/",
    }
    assert scenarios.aggregated_path(path) == found["aggregated_path"]
    with pytest.raises(ValueError):
        scenarios.aggregated_path("model-results/v4.1/")


def test_parameters_are_read_from_the_aggregates_folder(spark, tmp_path):
    paths = [f"full-model-results/v4.{n}/R 1/full-plan+x/2025/" for n in (0, 1)]
    for number, path in enumerate(paths):
        folder = tmp_path / scenarios.aggregated_path(path)
        folder.mkdir(parents=True)
        (folder / "params.json").write_text('{\n "start_year": %d\n}' % (2020 + number))
    rows = scenarios.scenario_keys(scenarios.read_scenarios(spark, str(tmp_path), paths))
    found = {row["path"]: row["fyear"] for row in rows.collect()}
    assert found == {paths[0]: 2020, paths[1]: 2021}
    with pytest.raises(PySparkException):
        scenarios.read_scenarios(spark, str(tmp_path), ["full-model-results/v9/x/y/z/"]).collect()


def test_baseline_of_one_provider_and_year(spark, tmp_path):
    raw = spark.createDataFrame(
        [(n, None if n % 2 else "S", 30, "01", "urgent", 1, 2023 + n % 2, f"R{n % 3}") for n in range(12)],
        "index bigint, sitetret string, age int, aedepttype string, acuity string, arrivals int, fyear int, dataset string",
    )
    raw.write.partitionBy("fyear", "dataset").parquet(f"{tmp_path}/v4.0.1/aae")
    df = activity.read_baseline(spark, str(tmp_path), "v4.0.1", "aae", 2024, "R1")
    assert set(df.columns) == {"rn", "model_run", *raw.columns} - {"index", "fyear", "dataset"}
    assert [(row["rn"], row["model_run"], row["sitetret"]) for row in df.orderBy("rn").collect()] == [
        (1, 0, "unknown"),
        (7, 0, "unknown"),
    ]
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "fyear" in plan.split("PartitionFilters: ")[1].split("]")[0]
    with pytest.raises(ValueError, match="no data version"):
        activity.read_baseline(spark, str(tmp_path), "N/A", "aae", 2024, "R1")
    with pytest.raises(ValueError, match="has_procedure: missing"):
        activity.read_baseline(spark, str(tmp_path), "v4.0.1", "aae", 2024, "R1").transform(
            lambda found: schemas.require(found, schemas.INPATIENT_BASELINE)
        )


def test_default_results(spark, tmp_path):
    rows = [("aae_type-01", 0, 5), ("aae_type-01", 1, 6), ("ip_x", 1, 7), ("xaae", 1, 8)]
    df = spark.createDataFrame(rows, "pod string, model_run int, value bigint")
    df.write.parquet(f"{tmp_path}/default.parquet")
    found = activity.read_default_results(spark, str(tmp_path), "aae")
    assert bag(found) == [(1, "aae_type-01", 6)]


def test_contracts(spark):
    good = spark.createDataFrame([(1, 1, 2.5)], "rn int, model_run bigint, arrivals double")
    assert schemas.require(good, schemas.EMERGENCY_RESULTS) is good
    bad = good.withColumn("arrivals", F.lit("x")).drop("rn")
    with pytest.raises(ValueError, match="rn: missing; arrivals: string, not double"):
        schemas.require(bad, schemas.EMERGENCY_RESULTS, "results")


def test_baseline_needs_a_text_site(spark):
    numbers = spark.createDataFrame([(1, 5)], "index bigint, sitetret int")
    with pytest.raises(ValueError, match="sitetret"):
        activity.as_baseline(numbers)
    with pytest.raises(ValueError, match="sitetret"):
        activity.as_baseline(numbers.drop("sitetret"))


def test_reconciliation_shows_both_sides(spark):
    ours = spark.createDataFrame([(0, 9), (1, 5), (1, 6), (None, 7), (2, 1)], "model_run int, total bigint")
    theirs = spark.createDataFrame([(0, 1), (1, 11), (3, 4)], "model_run int, value bigint")
    found = {row["model_run"]: tuple(row)[1:] for row in cp.reconcile_runs(ours, theirs).collect()}
    assert found == {1: (11, 11, 0), 2: (1, None, 1), 3: (None, 4, -4)}


def test_versions_are_ordered_like_releases(spark):
    """From oldest to newest, in several spellings."""
    from capplan.operators.versions import release_order

    names = [
        "v3.9.9", "4.1.0dev1", "v4.1.0a1", "4.1.0-alpha2", "4.1.0b1", "v4.1.0rc1", "4.1.0-RC_2", "v4.1.0", "4.1.0-1", "4.1.0post2",
        "4.1.1dev3", "v4.1.1", "4.1.10", "v4.10.0", "1!2.0.0",
    ]
    frame = spark.createDataFrame([(n,) for n in names[::-1]], "name string")
    assert [r.name for r in frame.orderBy(release_order("name")).collect()] == names
    odd = spark.createDataFrame([("dev",), ("v",), ("4.1.x",), (None,)], "name string")
    assert odd.where(release_order("name").isNotNull()).count() == 0


@pytest.mark.parametrize(
    "request_, expected",
    [("v4.1", "v4.1.0rc2"), ("v4.2", "v4.2.0"), ("v4.5", "v4.2.0"), ("v5.0", "v5.0.0a1"), ("v3.0", "N/A"), ("v9.9", "v5.0.0a1")],
)
def test_pre_releases_count_as_versions(spark, request_, expected):
    names = ["v4.1.0rc1", "v4.1.0rc2", "v4.2.0", "v4.2.0rc9", "v5.0.0a1", "4.9.0.dev1", "dev"]
    catalogue = spark.createDataFrame([(n,) for n in names], "name string")
    (found,) = resolve_versions(spark.createDataFrame([(request_,)], "model_version string"), catalogue).collect()
    assert found.data_version == expected
