"""Results of many runs from files of two layouts: the run as a column, or as the folder a file lies in."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from capplan import schemas

LOCATION = "_location"
RUN = "model_run"


def read_files(spark: SparkSession, folders: Sequence[str], merged: bool = False) -> DataFrame:
    """Rows of all folders, with the location each came from.

    Folder partitioning is read from the location, because Spark infers it only below a
    single root. ``merged`` takes the columns from all files, read by Spark's tasks, and not from one of them.
    """
    reader = spark.read.option("recursiveFileLookup", "true").option("mergeSchema", str(merged).lower())
    return reader.parquet(*folders).withColumn(LOCATION, F.col("_metadata.file_path"))


def folder_value(name: str) -> Column:
    """Value of a ``name=value`` folder in the location, NULL without such a folder."""
    value = F.substring_index(F.substring_index(LOCATION, f"/{name}=", -1), "/", 1)
    return F.when(F.contains(LOCATION, F.lit(f"/{name}=")), value)


def read_runs(spark: SparkSession, folders: Sequence[str], schema: T.StructType, what: str = "results") -> DataFrame:
    """Columns of ``schema`` and ``_location`` of all files below ``folders``, whatever their layout.

    A file may hold its run as the column ``model_run`` or lie in a folder ``model_run=<run>``; both may occur side
    by side. Columns go by name and get the declared types. No schema is taken from one file: a column whose type
    differs between files, that no file has, or that has another type than declared ends the read; a row without
    a run, or with one that contradicts its folder, fails the query and names the file. A value column that only
    some files have is NULL in the others.
    """
    rows = read_files(spark, folders, merged=True)
    folder = F.try_to_number(folder_value(RUN), F.lit("999999999")).cast("int")
    if RUN not in rows.columns:
        rows = rows.withColumn(RUN, F.lit(None).cast("int"))
    schemas.require(rows, schema, what)

    def failing(text: str) -> Column:
        return F.raise_error(F.concat(F.lit(f"{text}: "), F.col(LOCATION))).cast("int")

    run = (
        F.when(F.col(RUN).isNull() & folder.isNull(), failing("no model_run in column or folder"))
        .when(F.col(RUN) != folder, failing("model_run differs from the folder's"))
        .otherwise(F.coalesce(F.col(RUN).cast("int"), folder))
    )
    typed = [run.alias(RUN) if f.name == RUN else F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields]
    return rows.select(*typed, LOCATION)
