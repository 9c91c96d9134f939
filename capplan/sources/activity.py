"""Baselines, simulated results, converted activity and the simulation's aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from capplan import schemas
from capplan.operators.versions import NO_VERSION

UNKNOWN_SITE = "unknown"


def as_baseline(records: DataFrame, index: str = "index") -> DataFrame:
    """Raw records as run 0: the index becomes ``rn``, an empty site ``"unknown"``."""
    kind = dict(records.dtypes).get("sitetret")
    if kind != "string":
        raise ValueError(f"sitetret must be a string column, found {kind}")
    return (
        records.withColumnRenamed(index, "rn")
        .withColumn("model_run", F.lit(0))
        .fillna({"sitetret": UNKNOWN_SITE})
    )


# The characters Spark writes as %XX in the name of a partition folder.
_ESCAPED = frozenset("\"#%'*/:=?\\{[]^\x7f") | frozenset(map(chr, range(1, 32)))


def partition_folder(name: str, value: object) -> str:
    """The folder ``name=value`` as Spark writes it."""
    return f"{name}=" + "".join(f"%{ord(c):02X}" if c in _ESCAPED else c for c in str(value))


def baseline_folder(version: str, activity: str, fyear: int, provider: str) -> str:
    """The folder of one provider and year below the model data root."""
    year, dataset = partition_folder("fyear", fyear), partition_folder("dataset", provider)
    return f"{version}/{activity}/{year}/{dataset}"


def read_baseline(
    spark: SparkSession, data_root: str, version: str, activity: str, fyear: int, provider: str
) -> DataFrame:
    """Baseline of one provider and year.

    Only its own folder is listed, and the provider is not compared: below a common root Spark
    takes providers that look like numbers for numbers.
    """
    if version == NO_VERSION:
        raise ValueError("no data version fits the model version of this scenario")
    folder = baseline_folder(version, activity, fyear, provider)
    root = data_root.rstrip("/")
    records = (
        spark.read.option("basePath", f"{root}/{version}/{activity}")
        .parquet(f"{root}/{folder}")
        .where(F.col("fyear") == fyear)
        .drop("fyear", "dataset")
    )
    return schemas.require(as_baseline(records), schemas.BASELINES[activity], f"{activity} baseline")


def read_results(spark: SparkSession, results_path: str, activity: str) -> DataFrame:
    """Full results of one scenario for ``aae``, ``op`` or ``ip``."""
    results = spark.read.parquet(f"{results_path.rstrip('/')}/{activity}")
    return schemas.require(results, schemas.RESULTS[activity], f"{activity} results")


def _read_conversion(
    spark: SparkSession, results_path: str, folder: str, schema: T.StructType
) -> DataFrame:
    rows = spark.read.parquet(f"{results_path.rstrip('/')}/{folder}")
    return schemas.require(rows, schema, folder)


def read_sdec_conversion(spark: SparkSession, results_path: str) -> DataFrame:
    """Activity moved from inpatients to same-day emergency care."""
    return _read_conversion(spark, results_path, "sdec_conversion", schemas.SDEC_CONVERSION)


def read_outpatient_conversion(spark: SparkSession, results_path: str) -> DataFrame:
    """Activity moved from inpatients to outpatient procedures."""
    return _read_conversion(spark, results_path, "op_conversion", schemas.OUTPATIENT_CONVERSION)


def simulated_defaults(defaults: DataFrame, activity: str) -> DataFrame:
    """Aggregated results of one activity type (a prefix of ``pod``), baseline left out."""
    return defaults.where(F.col("pod").startswith(activity) & (F.col("model_run") != 0))


def read_default_results(spark: SparkSession, aggregated_path: str, activity: str) -> DataFrame:
    """The simulation's own aggregates, to check ours against."""
    defaults = spark.read.parquet(f"{aggregated_path.rstrip('/')}/default.parquet")
    return simulated_defaults(defaults, activity)
