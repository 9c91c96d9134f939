"""Distributed writes of area tables and the run manifest."""

from __future__ import annotations

from collections.abc import Sequence
from urllib.parse import quote

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.errors import AnalysisException

AREA_FOLDER = "functional-aggregations"
MANIFEST_KEYS = ("capacity_version", "run_id")

MANIFEST = T.StructType(
    [
        T.StructField(name, T.StringType(), True)
        for name in (
            *MANIFEST_KEYS,
            "app_version",
            "scenario_name",
            "scenario_runtime",
            "dataset",
            "mapping_runtime",
            "results_path",
        )
    ]
)


def by_run(table: DataFrame) -> DataFrame:
    """Rows in order of run, a NULL run last, then by the other key columns.

    The sort is by ranges over all keys, so a run with many rows spans several tasks.
    """
    rest = [f.name for f in table.schema.fields if isinstance(f.dataType, T.StringType)]
    return table.orderBy(F.col("model_run").asc_nulls_last(), *rest)


def positions(table: DataFrame, name: str = "position") -> DataFrame:
    """``table`` with each row's place (from 1) in the order of ``by_run``; equal keys go by the other columns.

    Rows are numbered within their run, and runs are offset by the rows before them, so no task sees more than a
    run; what is brought together are the runs' counts, one row per run.
    """
    keys = [f.name for f in table.schema.fields if isinstance(f.dataType, T.StringType)]
    rest = [c for c in table.columns if c != "model_run" and c not in keys]
    within = Window.partitionBy("model_run").orderBy(*keys, *rest)
    counts = table.groupBy("model_run").count().select(
        F.struct(F.col("model_run").isNull().alias("last"), "model_run", "count").alias("one")
    )
    ordered = counts.agg(F.sort_array(F.collect_list("one")).alias("runs"))
    before = "aggregate(slice(runs, 1, place), 0L, (total, one) -> total + one.count)"
    offsets = ordered.select("runs", F.posexplode("runs").alias("place", "run")).select(
        F.col("run.model_run").alias("_run"), F.expr(before).alias("_before")
    )
    numbered = table.withColumn(name, F.row_number().over(within).cast("bigint"))
    both = numbered.join(offsets, numbered["model_run"].eqNullSafe(F.col("_run")))
    return both.select(*table.columns, (F.col(name) + F.col("_before")).alias(name))


def area_path(root: str, capacity_version: str, run_id: str, name: str) -> str:
    return f"{root.rstrip('/')}/{AREA_FOLDER}/{capacity_version}/{run_id}/{name}.parquet"


def write_area(table: DataFrame, root: str, capacity_version: str, run_id: str, name: str) -> str:
    """Write one output table in order of run, replacing an earlier one; returns its path."""
    path = area_path(root, capacity_version, run_id, name)
    by_run(table).write.mode("overwrite").parquet(path)
    return path


def check_entries(
    entries: DataFrame, manifest: DataFrame, keys: Sequence[str] = MANIFEST_KEYS
) -> DataFrame:
    """``entries`` with ``accepted``: false where the manifest has the key already."""
    taken = manifest.select(*keys).distinct().withColumn("_taken", F.lit(True))
    return entries.join(taken, [*keys], "left").withColumn(
        "accepted", F.col("_taken").isNull()
    ).drop("_taken")


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """All runs of the manifest; none where nothing was written yet."""
    try:
        return spark.read.schema(MANIFEST).option("recursiveFileLookup", "true").parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], MANIFEST)


def entry_path(entry: dict[str, str], path: str) -> str:
    """Where the entry of a key lies: one folder per key."""
    return "/".join([path.rstrip("/"), *[f"{key}={quote(entry[key], safe='')}" for key in MANIFEST_KEYS]])


def append_manifest(entry: dict[str, str], path: str) -> None:
    """Add one run to the manifest; refuses a key that is there already.

    An entry is a file of its own at a path made of its key, written only if the path does not exist,
    so no run reads the manifest and the second writer of a key is refused.
    """
    unknown = set(entry) ^ set(MANIFEST.names)
    if unknown:
        raise ValueError(f"manifest entry has missing or unknown fields: {sorted(unknown)}")
    new = SparkSession.active().createDataFrame([entry], MANIFEST).coalesce(1)
    try:
        new.write.mode("errorifexists").parquet(entry_path(entry, path))
    except AnalysisException as error:
        if error.getCondition() != "PATH_ALREADY_EXISTS":
            raise
        raise ValueError(f"manifest already lists {[entry[key] for key in MANIFEST_KEYS]}") from error
