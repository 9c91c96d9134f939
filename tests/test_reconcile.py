"""Comparison with the simulation's own aggregates at several levels."""

import capplan as cp


def test_levels_and_columns(spark):
    columns = "model_run int, sitetret string, total int"
    ours = spark.createDataFrame([(0, "A", 9), (1, "A", 5), (1, "B", 2), (2, "A", 1), (None, "A", 3)], columns)
    theirs = spark.createDataFrame([(1, "A", 4), (1, "B", 2), (3, "C", 7)], "model_run int, sitetret string, value int")
    moved = spark.createDataFrame([(1, "A", 1), (2, "A", 1)], "model_run int, sitetret string, value int")
    found = cp.reconcile_levels(ours, theirs, converted=moved)
    rows = {(r.level, r.model_run, r.sitetret): (r.ours, r.converted, r.theirs, r.difference) for r in found.collect()}
    assert rows == {
        ("model_run", 1, None): (7, 1, 6, 0), ("model_run", 2, None): (1, 1, 0, 0), ("model_run", 3, None): (0, 0, 7, -7),
        ("model_run,sitetret", 1, "A"): (5, 1, 4, 0), ("model_run,sitetret", 1, "B"): (2, 0, 2, 0),
        ("model_run,sitetret", 2, "A"): (1, 1, 0, 0), ("model_run,sitetret", 3, "C"): (0, 0, 7, -7),
    }


def test_a_right_run_shows_zero(spark):
    from workloads.queries import QUERIES, Inputs

    for name in ("reconcile_op_levels", "reconcile_ip_levels"):
        found = QUERIES[name](Inputs(spark, "/root/testdata/sf0.001")).collect()
        assert found and {r.difference for r in found} == {0}, name
