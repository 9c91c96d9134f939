"""Dense output, in particular where run, site or label are unknown."""

import pytest

import capplan as cp
from capplan.operators.densify import label_list
from capplan.operators.lookups import add_theatre_total
from tests.builders import bag

SCHEMA = "model_run int, sitetret string, grouping string, total bigint"
REQUIRED = ["x", "y"]


def both(spark, data):
    totals = spark.createDataFrame(data, SCHEMA)
    filled = cp.fill_missing_labels(totals, REQUIRED)
    dense = cp.dense_totals(totals, label_list(REQUIRED), ["total"])
    return bag(filled.select(dense.columns)), bag(dense)


@pytest.mark.parametrize(
    ("data", "expected"),
    [
        ([(1, "A", "x", 5), (1, "A", None, 3)], {(1, "A", "x", 5), (1, "A", "y", 0)}),
        (
            [(None, "A", "x", 7), (None, "A", "z", 9)],
            {(None, "A", "x", 0), (None, "A", "y", 0), (None, "A", "z", 9)},
        ),
        (
            [(1, None, "x", 4), (1, None, "z", 2)],
            {(1, None, "x", 0), (1, None, "y", 0), (1, None, "z", 2)},
        ),
        ([(1, "A", None, 3)], {(1, "A", "x", 0), (1, "A", "y", 0)}),
        ([(1, "A", "y", None)], {(1, "A", "x", 0), (1, "A", "y", 0)}),
        (
            [(1, "A", "x", 1), (2, "B", "z", 1)],
            {(1, "A", "x", 1), (1, "A", "y", 0), (2, "B", "x", 0), (2, "B", "y", 0), (2, "B", "z", 1)},
        ),
    ],
)
def test_cases(spark, data, expected):
    filled, dense = both(spark, data)
    wanted = sorted(((g, m, s, t) for m, s, g, t in expected), key=repr)
    assert filled == dense == wanted


def test_empty_input(spark):
    assert both(spark, []) == ([], [])


def test_filling_keeps_repeated_keys(spark):
    totals = spark.createDataFrame([(0, "A", "x", 1), (0, "A", "x", 2)], SCHEMA)
    assert bag(cp.fill_missing_labels(totals, REQUIRED)) == [
        ("x", 0, "A", 1),
        ("x", 0, "A", 2),
        ("y", 0, "A", 0),
    ]


def test_dense_totals_sums_rows(spark):
    rows = spark.createDataFrame([(1, "A", "x", 1), (1, "A", "x", 2), (1, "A", None, 9)], SCHEMA)
    dense = cp.dense_totals(rows, label_list(REQUIRED), ["total"])
    assert bag(dense) == [("x", 1, "A", 3), ("y", 1, "A", 0)]


def test_types_stay(spark):
    rows = spark.createDataFrame([(1, "A", "x", 1)], SCHEMA)
    assert dict(cp.dense_totals(rows, label_list(REQUIRED), ["total"]).dtypes)["total"] == "bigint"


def test_a_procedure_without_any_time_keeps_its_spells(spark):
    spells = spark.createDataFrame([("W01",), ("W01",), ("X02",)], "primary_procedure string")
    times = spark.createDataFrame(
        [("W01", None), ("X02", 3.0)], "opcs_code string, theatre_time double"
    )
    rows = add_theatre_total(spells, times).select("primary_procedure", "theatre_rows", "theatre_time")
    assert bag(rows) == [("W01", 1, None), ("W01", 1, None), ("X02", 1, 3.0)]
    mixed = times.union(spark.createDataFrame([("W01", 2.0)], times.schema))
    with pytest.raises(Exception, match="partly unknown"):
        add_theatre_total(spells, mixed).collect()
