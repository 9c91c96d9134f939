"""Bitmaps of record numbers, and baselines that scenarios share."""

import json
import os
import random
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

import capplan as cp
from capplan.operators.overlay import replay
from capplan.operators.presence import bitmaps, lacking, occurs
from capplan.operators.sizing import fits_broadcast
from tests.builders import SPELL_RUN, VISIT, bag, random_runs, random_spell, spells

NUMBERS = [0, 1, 2, 7, 8, 32767, 32768, 32769, 65536, -1, -5, -32767, -32768, -32769, 1 << 40, -(1 << 40), 10**15]


def numbers(spark, values, **more):
    frame = spark.createDataFrame([(v,) for v in values], "rn bigint")
    return frame.withColumns({k: F.lit(v) for k, v in more.items()})


def test_sparse_and_negative_numbers(spark):
    seen = NUMBERS[::2]
    found = occurs(numbers(spark, [*NUMBERS, None]), bitmaps(numbers(spark, [*seen, *seen, None]), "rn"), "rn")
    assert {r.rn: r._seen for r in found.collect()} == {n: n in seen for n in [*NUMBERS, None]}


def test_numbers_of_each_key_apart(spark):
    rows = spark.createDataFrame([(k, n) for k in range(3) for n in range(k, 90_000, 7)], "k int, rn bigint")
    asked = spark.createDataFrame([(k, n) for k in range(4) for n in range(0, 90_000, 11)], "k int, rn bigint")
    found = {(r.k, r.rn): r._seen for r in occurs(asked, bitmaps(rows, "rn", ["k"]), "rn", ["k"]).collect()}
    assert found == {(k, n): k < 3 and n >= k and (n - k) % 7 == 0 for k in range(4) for n in range(0, 90_000, 11)}


def test_lacking_numbers(spark):
    r = random.Random(2)
    whole = NUMBERS + r.sample(range(100_000), 5_000)
    seen = {k: set(r.sample(whole, len(whole) - 40 * k)) | {3, 99_999_999} for k in (0, 1, 5)}
    rows = spark.createDataFrame([(k, n) for k, own in seen.items() for n in own], "k int, rn bigint")
    members = spark.createDataFrame([(0,), (1,), (5,), (9,)], "k int")
    all_ = members.join(bitmaps(numbers(spark, whole), "rn"))
    found = lacking(all_, bitmaps(rows, "rn", ["k"]), ["k"], "rn")
    assert sorted(map(tuple, found.collect())) == sorted((k, n) for k in (0, 1, 5, 9) for n in set(whole) - seen.get(k, set()))


def test_the_limit_is_the_sessions(spark):
    frame = numbers(spark, range(5000))
    assert fits_broadcast(frame) and not fits_broadcast(frame, 1000)
    spark.conf.set("capplan.broadcastBytes", "1000")
    try:
        assert not fits_broadcast(frame)
    finally:
        spark.conf.unset("capplan.broadcastBytes")


@pytest.mark.parametrize("broadcast", [True, False])
def test_both_ways_agree(spark, broadcast):
    r = random.Random(4)
    base = spark.createDataFrame([(r.randrange(-9, 99) if k % 9 else None, 0, k % 3, k) for k in range(60)], "rn bigint, model_run int, c int, n int")
    results = spark.createDataFrame(
        [(r.randrange(-9, 99) if k % 7 else None, 1 + k % 2, k % 3, k) for k in range(90)], "rn bigint, model_run int, c int, n int"
    )
    rows = replay(base, results, classes=["c"], sums=["n"], broadcast=broadcast)
    left = base.select("rn").join(results, "rn", "left").unionByName(base)
    assert bag(rows) == bag(left)


def scenarios(spark, n, seed=1):
    """Two datasets, n scenarios on them, random results of each."""
    r = random.Random(seed)
    bases = [spells(spark, *[{"rn": k if k % 13 else None, **random_spell(r)} for k in range(40)]).withColumn("dataset", F.lit(d)) for d in range(2)]
    of = {s: s % 2 if s else 0 for s in range(n)}
    rows = [(s, of[s], *row) for s in range(n) for row in random_runs(r, 40, 0 if s == 3 else 25)]
    results = spark.createDataFrame(rows, "scenario int, dataset int, " + SPELL_RUN.replace("bigint", "long"))
    members = spark.createDataFrame(list(of.items()), "scenario int, dataset int")
    return bases[0].unionByName(bases[1]), results, members


@pytest.mark.parametrize("null_run", ["keep", "drop"])
@pytest.mark.parametrize("broadcast", [True, False])
def test_shared_baselines_give_what_repeated_ones_do(spark, null_run, broadcast):
    base, results, members = scenarios(spark, 7)
    times = spark.createDataFrame([("G451", "x", 1.5), ("X123", "y", 2.0)], "opcs_code string, opcs_description string, theatre_time double")
    options = {"by": ["scenario"], "null_run": null_run, "broadcast": broadcast}
    shared = cp.inpatient_areas(base, results, times, shared=cp.Shared(("dataset",), members), **options)
    repeated = base.join(members, "dataset").drop("dataset")
    assert bag(shared) == bag(cp.inpatient_areas(repeated, results.drop("dataset"), times, **options))


def test_shared_outpatient_and_emergency_baselines(spark):
    members = spark.createDataFrame([(s, 0) for s in range(4)], "scenario int, dataset int")
    visits = spark.createDataFrame([(k, 0, "AB"[k % 2], k % 3 == 0, k % 2 == 0, k % 4, k % 3) for k in range(30)], VISIT)
    runs = spark.createDataFrame([(s, 0, k, 1 + k % 2, k % 5, 1) for s in range(3) for k in range(s, 30, 2)],
                                 "scenario int, dataset int, rn bigint, model_run int, attendances int, tele_attendances int")
    moved = spark.createDataFrame([(0, 1, "A", 2)], "scenario int, model_run int, sitetret string, attendances int")
    base = visits.withColumn("dataset", F.lit(0))
    shared = cp.outpatient_areas(base, runs, moved, by=["scenario"], shared=cp.Shared(("dataset",), members))
    repeated = cp.outpatient_areas(base.join(members, "dataset").drop("dataset"), runs.drop("dataset"), moved, by=["scenario"])
    assert bag(shared) == bag(repeated)
    people = spark.createDataFrame([(0, k, 0, "AB"[k % 2], k, "01", "urgent", 1) for k in range(30)],
                                   "dataset int, rn bigint, model_run int, sitetret string, age int, aedepttype string, acuity string, arrivals int")
    came = runs.select("scenario", "dataset", "rn", "model_run", F.col("attendances").alias("arrivals"))
    sdec = moved.withColumnRenamed("attendances", "arrivals")
    shared = cp.emergency_areas(people, came, sdec, by=["scenario"], shared=cp.Shared(("dataset",), members))
    repeated = cp.emergency_areas(people.join(members, "dataset").drop("dataset"), came.drop("dataset"), sdec, by=["scenario"])
    assert bag(shared) == bag(repeated)


_MEASURED = """
import sys
from pyspark.sql import SparkSession, functions as F
import capplan as cp
kind, root = sys.argv[1:]
spark = (SparkSession.builder.master("local[4]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "4")
         .config("spark.eventLog.enabled", "true").config("spark.eventLog.dir", root).config("spark.eventLog.compress", "false")
         .config("spark.eventLog.rolling.enabled", "false").getOrCreate())
spark.sparkContext.setLogLevel("ERROR")
n = 50_000
spells = spark.range(0, n, 1, 4).selectExpr("id AS rn", "0 AS model_run", "concat('S', id % 3) AS sitetret", "cast(id % 90 AS int) AS age",
    "'11' AS admimeth", "'1' AS classpat", "1 AS speldur", "'100' AS tretspef", "'elective' AS group", "'X123' AS primary_procedure",
    "true AS has_procedure", "false AS maternity_delivery_in_spell", "'Surgical' AS tretspef_type")
if kind == "results":
    runs = spark.range(0, 4 * n, 1, 4).selectExpr(f"id % {n} AS rn", f"cast(1 + id div {n} AS int) AS model_run", "cast(id % 5 AS int) AS speldur", "'1' AS classpat")
    runs.write.parquet(root + "/in-results")
    table = cp.ward_areas(spells, spark.read.parquet(root + "/in-results"), broadcast=True)
else:
    scenarios = int(kind)
    members = spark.range(scenarios).selectExpr("cast(id AS int) AS scenario", "0 AS dataset")
    runs = spark.range(0, 10 * scenarios, 1, 4).selectExpr(f"cast(id % {scenarios} AS int) AS scenario", "0 AS dataset", "id AS rn", "1 AS model_run", "1 AS speldur", "'1' AS classpat")
    runs = runs.unionByName(spells.select("rn").join(members).selectExpr("scenario", "dataset", "rn", "2 AS model_run", "2 AS speldur", "'1' AS classpat"))
    spells = spells.withColumn("dataset", F.lit(0))
    table = cp.ward_areas(spells, runs, by=["scenario"], shared=cp.Shared(("dataset",), members), broadcast=True)
rows = table.collect()
spark.stop()
"""


def records_written(folder):
    """Shuffle records that the tasks of all jobs wrote, from an event log."""
    (name,) = [n for n in os.listdir(folder) if n.startswith("local")]
    total = 0
    with open(os.path.join(folder, name)) as log:
        for line in log:
            event = json.loads(line)
            if event["Event"] == "SparkListenerTaskEnd" and event.get("Task Metrics"):
                total += event["Task Metrics"]["Shuffle Write Metrics"]["Shuffle Records Written"]
    return total


def measured(tmp_path, kind):
    folder = tmp_path / kind
    folder.mkdir()
    here = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    subprocess.run([sys.executable, "-c", _MEASURED, kind, str(folder)], check=True, cwd=here, timeout=300, capture_output=True)
    return records_written(folder)


def test_no_result_row_is_shuffled(tmp_path):
    """200,000 results of 50,000 records: what is written to shuffles is far below either."""
    assert measured(tmp_path, "results") < 60_000


def test_baseline_rows_do_not_grow_with_scenarios(tmp_path):
    few, many = measured(tmp_path, "2"), measured(tmp_path, "10")
    assert many - few < 8 * 50_000 / 4  # words of 64 numbers, not rows
