"""Area tables that appear together: written under an attempt's name, made visible by one commit record.

``write_area`` replaces a folder, and readers find none while it is written. Here every attempt has a folder
of its own and nothing is replaced. Readers follow the last commit record of a run, a file that appears in one
rename; until then they see the tables of the attempt before, and of a failed attempt they see nothing.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from capplan.sinks.tables import AREA_FOLDER, by_run

COMMIT = "number bigint, attempt string, tables array<string>, committed timestamp"


def run_path(root: str, capacity_version: str, run_id: str) -> str:
    return f"{root.rstrip('/')}/{AREA_FOLDER}/{capacity_version}/{run_id}/published"


def commits(spark: SparkSession, root: str, capacity_version: str, run_id: str) -> DataFrame:
    """The commit records of a run, a few small rows; none where nothing was published."""
    try:
        return spark.read.schema(COMMIT).parquet(f"{run_path(root, capacity_version, run_id)}/commits")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], COMMIT)


def last_commit(spark: SparkSession, root: str, capacity_version: str, run_id: str) -> dict | None:
    """The record that readers follow: the highest number, of equal numbers the later, then the larger name.

    Two writers that publish at the same moment may take one number; all readers then still agree.
    """
    records = commits(spark, root, capacity_version, run_id)
    last = records.agg(F.max(F.struct("number", "committed", "attempt", "tables")).alias("last")).first()["last"]
    return None if last is None else last.asDict()


def write_attempt(tables: dict[str, DataFrame], root: str, capacity_version: str, run_id: str) -> str:
    """Write the tables of one attempt, each in order of run; returns the attempt's name. No reader sees them yet."""
    attempt = str(uuid.uuid4())
    for name, table in tables.items():
        path = f"{run_path(root, capacity_version, run_id)}/attempts/{attempt}/{name}.parquet"
        by_run(table).write.mode("errorifexists").parquet(path)
    return attempt


def commit_attempt(
    spark: SparkSession, attempt: str, tables: list[str], root: str, capacity_version: str, run_id: str
) -> int:
    """Make an attempt's tables the ones that readers see, all at once; returns the number of the commit."""
    last = last_commit(spark, root, capacity_version, run_id)
    number = 1 if last is None else last["number"] + 1
    record = spark.createDataFrame([(number, attempt, sorted(tables))], "number bigint, attempt string, tables array<string>")
    path = f"{run_path(root, capacity_version, run_id)}/commits"
    record.withColumn("committed", F.current_timestamp()).coalesce(1).write.mode("append").parquet(path)
    return number


def publish_areas(tables: dict[str, DataFrame], root: str, capacity_version: str, run_id: str) -> int:
    """Write the tables and make them visible together; a failure on the way leaves readers what they had."""
    if not tables:
        raise ValueError("no tables to publish")
    spark = next(iter(tables.values())).sparkSession
    attempt = write_attempt(tables, root, capacity_version, run_id)
    return commit_attempt(spark, attempt, list(tables), root, capacity_version, run_id)


def read_area(spark: SparkSession, root: str, capacity_version: str, run_id: str, name: str) -> DataFrame:
    """A table of the run's last commit. The attempt is settled here: a later commit does not change this DataFrame."""
    last = last_commit(spark, root, capacity_version, run_id)
    if last is None or name not in last["tables"]:
        raise ValueError(f"{name} of {capacity_version} {run_id} was not published")
    path = f"{run_path(root, capacity_version, run_id)}/attempts/{last['attempt']}/{name}.parquet"
    return spark.read.parquet(path)
