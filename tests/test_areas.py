"""Area plans against their plain composition, on inputs full of odd cases."""

import random

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

import capplan as cp
from capplan.operators.sizing import fits_broadcast
from capplan.plans.inpatients import INPATIENT_AREAS
from tests.builders import (
    SPELL_RUN,
    TIMES,
    attendances,
    bag,
    random_runs,
    random_spell,
    spells,
    visits,
)
from workloads import plain

RECORDS = 150
PLANS = [True, False]


@pytest.fixture(scope="module")
def inpatient_inputs(spark):
    r = random.Random(3)
    base = spells(spark, *[random_spell(r) for _ in range(RECORDS)]).cache()
    results = spark.createDataFrame(random_runs(r, RECORDS, 400), SPELL_RUN).cache()
    # two codes are listed twice, which counts their spells twice in theatre totals
    times = spark.createDataFrame(
        [("R241", "a", 30.5), ("W371", "b", 90.0), ("W371", "c", 10.25), ("G451", "d", 12.0), ("Q9", "e", 1.0)],
        TIMES,
    ).cache()
    return base, results, times


@pytest.fixture(scope="module")
def emergency_inputs(spark):
    r = random.Random(4)
    base = attendances(
        spark,
        *[
            dict(
                sitetret=r.choice(["A", "B", None]),
                age=r.choice([0, 17, 18, 60, None]),
                aedepttype=r.choice(["01", "01", "02", "05", None]),
                acuity=r.choice(["standard", "very-urgent", "immediate-resuscitation", "x", None]),
                arrivals=r.choice([1, 2, None]),
            )
            for _ in range(RECORDS)
        ],
    ).cache()
    results = spark.createDataFrame(
        [(r.randrange(RECORDS + 2), r.choice([1, 2]), r.choice([0, 1, 3, None])) for _ in range(500)]
        + [(5, 1, 1)] * 300,
        "rn bigint, model_run int, arrivals int",
    ).cache()
    conversion = spark.createDataFrame(
        [(1, "A", 5), (1, "Z", 2), (2, None, 4), (2, "A", None)],
        "model_run int, sitetret string, arrivals int",
    )
    return base, results, conversion


@pytest.fixture(scope="module")
def outpatient_inputs(spark):
    r = random.Random(5)
    base = visits(
        spark,
        *[
            dict(
                sitetret=r.choice(["A", "B", None]),
                has_procedures=r.choice([True, False, None]),
                is_first=r.choice([True, False, None]),
                attendances=r.choice([0, 1, 2, None]),
                tele_attendances=r.choice([0, 1, None]),
            )
            for _ in range(RECORDS)
        ],
    ).cache()
    results = spark.createDataFrame(
        [(r.randrange(RECORDS + 2), r.choice([1, 2]), r.choice([0, 1, None]), r.choice([0, 2, None])) for _ in range(500)],
        "rn bigint, model_run int, attendances int, tele_attendances int",
    ).cache()
    conversion = spark.createDataFrame(
        [(1, "A", 5), (1, "Z", 2), (2, None, 4)],
        "model_run int, sitetret string, attendances int",
    )
    return base, results, conversion


@pytest.mark.parametrize("broadcast", PLANS)
def test_emergency(emergency_inputs, broadcast):
    expected = bag(plain.emergency(*emergency_inputs))
    assert bag(cp.emergency_areas(*emergency_inputs, broadcast=broadcast)) == expected


@pytest.mark.parametrize("broadcast", PLANS)
def test_outpatients(outpatient_inputs, broadcast):
    expected = bag(plain.outpatients(*outpatient_inputs))
    assert bag(cp.outpatient_areas(*outpatient_inputs, broadcast=broadcast)) == expected


def inpatient_area(name, inputs, **options):
    base, results, times = inputs
    return {
        "ip_daycase": lambda: cp.daycase_areas(base, results, **options),
        "ip_maternity": lambda: cp.maternity_areas(base, results, **options),
        "ip_wards": lambda: cp.ward_areas(base, results, **options),
        "ip_procedures_and_theatres": lambda: cp.procedure_areas(base, results, times, **options),
    }[name]()


@pytest.mark.parametrize("broadcast", PLANS)
@pytest.mark.parametrize("name", list(INPATIENT_AREAS))
def test_inpatients(inpatient_inputs, name, broadcast):
    expected = bag(plain.inpatients(INPATIENT_AREAS[name], *inpatient_inputs))
    assert bag(inpatient_area(name, inpatient_inputs, broadcast=broadcast)) == expected


@pytest.mark.parametrize("broadcast", PLANS)
def test_one_pass_equals_the_single_areas(inpatient_inputs, broadcast):
    combined = cp.inpatient_areas(*inpatient_inputs, broadcast=broadcast).cache()
    for name, area in INPATIENT_AREAS.items():
        table = cp.area_table(combined, name)
        assert table.columns == ["model_run", "sitetret", area.label_column, *area.measures]
        assert bag(table) == bag(plain.inpatients(area, *inpatient_inputs))


def test_one_pass_of_some_areas(inpatient_inputs):
    base, results, _ = inpatient_inputs
    combined = cp.inpatient_areas(base, results, areas=["ip_wards", "ip_daycase"], broadcast=True)
    assert bag(cp.area_table(combined, "ip_wards")) == bag(
        cp.ward_areas(base, results, broadcast=True)
    )
    assert {row[0] for row in combined.select("area").distinct().collect()} == {
        "ip_wards",
        "ip_daycase",
    }


@pytest.mark.parametrize("broadcast", PLANS)
@pytest.mark.parametrize("name", list(INPATIENT_AREAS))
def test_records_in_no_run_can_be_dropped(inpatient_inputs, name, broadcast):
    kept = inpatient_area(name, inpatient_inputs, broadcast=broadcast)
    dropped = inpatient_area(name, inpatient_inputs, broadcast=broadcast, null_run="drop")
    assert bag(kept.where("model_run IS NULL"))
    assert bag(dropped) == bag(kept.where("model_run IS NOT NULL"))


@pytest.mark.parametrize("broadcast", PLANS)
def test_dropping_covers_results_and_conversions_without_a_run(
    spark, emergency_inputs, outpatient_inputs, broadcast
):
    for plan, (base, results, conversion) in (
        (cp.emergency_areas, emergency_inputs),
        (cp.outpatient_areas, outpatient_inputs),
    ):
        runless = [
            df.unionByName(df.limit(3).withColumn("model_run", F.lit(None).cast("int")))
            for df in (results, conversion)
        ]
        dropped = plan(base, *runless, null_run="drop", broadcast=broadcast)
        kept = plan(base, results, conversion, broadcast=broadcast)
        assert bag(dropped) == bag(kept.where("model_run IS NOT NULL"))


def test_sites_of_conversions_can_be_filled(emergency_inputs):
    base, results, conversion = emergency_inputs
    filled = cp.emergency_areas(
        base, results, conversion, fill_conversion_site="unknown", broadcast=True
    )
    expected = plain.emergency(base, results, conversion.fillna({"sitetret": "unknown"}))
    assert bag(filled) == bag(expected)


def test_all_procedure_labels_on_request(inpatient_inputs):
    dense = cp.procedure_areas(*inpatient_inputs, dense_all=True, broadcast=True)
    per_key = dense.groupBy("model_run", "sitetret").count().select("count").distinct().collect()
    assert [row[0] for row in per_key] == [15]


@pytest.mark.parametrize("broadcast", PLANS)
def test_overlay_is_the_left_join(inpatient_inputs, broadcast):
    base, results, _ = inpatient_inputs
    replaced = ["speldur", "classpat"]
    expected = plain.left_overlay(base, results, replaced)
    got = cp.overlay(base, results, replaced, broadcast=broadcast)
    assert bag(got.select(expected.columns)) == bag(expected)


def test_several_scenarios_at_once(inpatient_inputs, emergency_inputs):
    """A further key gives each scenario the table it has on its own."""
    base, results, times = inpatient_inputs
    aae, aae_results, conversion = emergency_inputs

    def twice(df, changed):
        return df.withColumn("scenario", F.lit("s1")).unionByName(
            changed.withColumn("scenario", F.lit("s2"))
        )

    some = results.where("rn % 4 != 0")
    for broadcast in PLANS:
        options = dict(by=["scenario"], broadcast=broadcast)
        both = cp.inpatient_areas(twice(base, base), twice(results, some), times, **options)
        attended = cp.emergency_areas(
            twice(aae, aae), twice(aae_results, aae_results.limit(50)), twice(conversion, conversion), **options
        )
        for scenario, runs in (("s1", results), ("s2", some)):
            alone = cp.inpatient_areas(base, runs, times, broadcast=True)
            assert bag(both.where(F.col("scenario") == scenario).drop("scenario")) == bag(alone)
        alone = cp.emergency_areas(aae, aae_results, conversion, broadcast=True)
        assert bag(attended.where("scenario = 's1'").drop("scenario")) == bag(alone)


def test_measures_may_be_decimal_numbers(emergency_inputs):
    base, results, conversion = emergency_inputs
    halves = [df.withColumn("arrivals", F.col("arrivals") / 2) for df in emergency_inputs]
    whole = cp.emergency_areas(base, results, conversion, broadcast=False)
    half = cp.emergency_areas(*halves, broadcast=False)
    assert dict(half.dtypes)["total"] == "double"
    assert bag(half.withColumn("total", (F.col("total") * 2).cast("bigint"))) == bag(whole)


@pytest.mark.parametrize("broadcast", PLANS)
def test_run_zero_in_results_is_refused(emergency_inputs, broadcast):
    base, results, conversion = emergency_inputs
    zero = results.withColumn("model_run", F.lit(0))
    with pytest.raises(PySparkException, match="run 0 is the baseline"):
        cp.emergency_areas(base, zero, conversion, broadcast=broadcast).collect()
    with pytest.raises(PySparkException, match="run 0 is the baseline"):
        cp.emergency_areas(
            base, results, conversion.withColumn("model_run", F.lit(0)), broadcast=broadcast
        ).collect()


def test_unknown_option_is_refused(emergency_inputs):
    with pytest.raises(ValueError, match="null_run"):
        cp.emergency_areas(*emergency_inputs, null_run="keep?")


def test_known_times_only(spark):
    """A required label of unknown time is zero; other plain labels stay away."""
    base = spells(spark, {"primary_procedure": "W371"})
    results = spark.createDataFrame([(0, 1, 0, "1")], SPELL_RUN)
    times = spark.createDataFrame([("W371", "x", 92.0)], TIMES)
    table = cp.procedure_areas(base, results, times, broadcast=True).where("model_run = 1")
    found = {row["procedure_grouping"]: (row["spells"], row["total_theatre_time"]) for row in table.collect()}
    assert found.pop("adult_elective_surgical_procedures") == (1, 92.0)
    assert found == dict.fromkeys(cp.PROCEDURES.required, (0, 0.0))


def test_invariants(inpatient_inputs):
    base, results, _ = inpatient_inputs
    wards = cp.ward_areas(base, results).cache()
    keys = wards.groupBy("model_run", "sitetret", "grouping").count()
    assert keys.where("count > 1").count() == 0
    assert wards.count() == 16 * wards.select("model_run", "sitetret").distinct().count()
    assert wards.where("grouping LIKE '%\\_zerolos' AND beddays != 0").count() == 0
    assert wards.where("grouping LIKE '%nonzerolos' AND beddays < spells").count() == 0


def test_size_check(spark):
    df = spark.range(1000).withColumn("text", F.lit("x" * 100))
    assert fits_broadcast(df, 200_000)
    assert not fits_broadcast(df, 100_000)
    assert fits_broadcast(df.limit(0), 0)
