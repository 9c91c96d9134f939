"""Dense output: every required label for every run and site, zero if nothing matched.

``fill_missing_labels`` completes a finished aggregate, and ``dense_totals`` aggregates rows first.
Either refers to its input once: the labels a run and site has are brought together, and required
labels are looked up among them, so no key skeleton is built separately and joined back.

A NULL run or site equals nothing, so required labels are zero there whatever the
rows hold; a NULL label never reaches the output, but its row still counts as proof
that its run and site exist.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from capplan.plans.areas import KEYS


def label_list(labels: Sequence[str]) -> Column:
    return F.expr("array(" + ", ".join(f"'{name}'" for name in labels) + ")")


def run_site_universe(totals: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """The distinct runs and sites an aggregate mentions under any label, NULL included."""
    return totals.select(*by, *KEYS).distinct()


def fill_missing_labels(
    totals: DataFrame,
    required: Sequence[str] | Column,
    label_column: str = "grouping",
    *,
    by: Sequence[str] = (),
) -> DataFrame:
    """Complete ``totals`` with zero rows for required labels its runs and sites lack.

    Labels outside ``required`` pass through unchanged, and keys that occur twice stay twice.
    ``required`` may be an array column that depends on the ``by`` columns. What is brought
    together for a run and site is its rows in an aggregate, one per distinct label.
    """
    keys = [*by, *KEYS]
    measures = [f for f in totals.schema.fields if f.name not in (*keys, label_column)]
    wanted = required if isinstance(required, Column) else label_list(required)
    row = F.struct(F.col(label_column), *[F.col(f.name) for f in measures])
    labelled = F.when(F.col(label_column).isNotNull(), row)
    found = (
        totals.groupBy(*keys)
        .agg(F.collect_list(labelled).alias("_rows"))
        .withColumn("_required", wanted)
    )
    keyed = F.col("model_run").isNotNull() & F.col("sitetret").isNotNull()

    def needed(label: Column) -> Column:
        return F.array_contains("_required", label)

    def filled(entry: Column) -> Column:
        values = [
            F.when(needed(entry[label_column]), F.coalesce(entry[f.name], F.lit(0).cast(f.dataType)))
            .otherwise(entry[f.name])
            .alias(f.name)
            for f in measures
        ]
        return F.struct(entry[label_column].alias(label_column), *values)

    def zero(label: Column) -> Column:
        return F.struct(
            label.alias(label_column), *[F.lit(0).cast(f.dataType).alias(f.name) for f in measures]
        )

    present = F.filter("_rows", lambda entry: keyed | ~needed(entry[label_column]))
    lacking = F.filter(
        "_required", lambda label: ~keyed | ~F.array_contains(F.col(f"_rows.{label_column}"), label)
    )
    return found.select(
        *keys, F.inline(F.concat(F.transform(present, filled), F.transform(lacking, zero)))
    )


def dense_totals(
    rows: DataFrame,
    required: Column,
    measures: Sequence[str],
    label_column: str = "grouping",
    *,
    by: Sequence[str] = (),
) -> DataFrame:
    """Sum ``measures`` per run, site and label, and complete the required labels.

    The aggregation combines map-side, so a hot run or site costs one partial row per task.
    """
    sums = [F.coalesce(F.sum(name), F.lit(0)).alias(name) for name in measures]
    totals = rows.groupBy(*by, *KEYS, label_column).agg(*sums)
    return fill_missing_labels(totals, required, label_column, by=by)
