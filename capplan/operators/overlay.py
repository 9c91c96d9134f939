"""Replay of simulated runs on the baseline: the join on the record number.

A simulation result carries only ``rn``, ``model_run`` and the values that vary by
run; everything else about a record comes from its baseline row. Baseline records
that occur in no run are kept with a NULL run (``null_run="keep"``), as the run and
site keys of the dense output are built from them too; ``null_run="drop"`` leaves
them out.

Results hold about (number of runs) x (baseline) rows, so the plans below are chosen
to move results as little as possible:

* baseline measured small enough to broadcast: results are joined where they were
  read and never shuffled;
* otherwise: results and baseline are exchanged once, on the record number, and what
  the join gives is summed before it moves again. It hashes the baseline's share of a
  partition, and adaptive execution deals the partition of a hot record over tasks,
  each with a copy of the baseline's share (an inner join allows that, a left join
  from the baseline does not).

Baseline records without any run are found through bitmaps of the record numbers in
results: results are reduced to bitmaps where they are read, in one more scan of one
column.

Scenarios on one dataset can share its baseline (``Shared``): it is read, broadcast and
joined once per dataset, and its own rows are summed before they are repeated for
each scenario.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from typing import Literal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from capplan.operators.presence import bitmaps, lacking, occurs
from capplan.operators.sizing import fits_broadcast

NullRun = Literal["keep", "drop"]
RECORD = "rn"
RUN = "model_run"


@dataclass(frozen=True)
class Shared:
    """Datasets that several scenarios share: the keys of a dataset, and ``members``, the
    dataset of each scenario (the columns of ``by`` and these keys, one row per scenario)."""

    keys: tuple[str, ...]
    members: DataFrame


def base_keys(by: Sequence[str], shared: Shared | None) -> list[str]:
    """Leading key columns of the baseline."""
    return list(by if shared is None else shared.keys)


def result_keys(by: Sequence[str], shared: Shared | None) -> list[str]:
    """Leading key columns of results."""
    return [*by] if shared is None else [*by, *shared.keys]


def simulated(df: DataFrame) -> DataFrame:
    """``df`` with a run-time check that no row claims run 0, the baseline's number."""
    return df.withColumn(
        RUN,
        F.when(
            F.col(RUN) == 0, F.raise_error(F.lit("run 0 is the baseline; it cannot be simulated"))
        ).otherwise(F.col(RUN)),
    )


def _runs(results: DataFrame, columns: list[str], null_run: NullRun) -> DataFrame:
    runs = simulated(results.select(*columns))
    return runs.where(F.col(RUN).isNotNull()) if null_run == "drop" else runs


def _check(null_run: str) -> None:
    if null_run not in ("keep", "drop"):
        raise ValueError(f"null_run must be 'keep' or 'drop', not {null_run!r}")


def _marked(base: DataFrame, runs: DataFrame, by: Sequence[str]) -> DataFrame:
    """``base`` with ``_seen``: whether a run has the record."""
    return occurs(base, bitmaps(runs, RECORD, by), RECORD, by)


def _joined(runs: DataFrame, fixed: DataFrame, keys: Sequence[str], broadcast: bool) -> DataFrame:
    return runs.join(fixed.hint("broadcast" if broadcast else "shuffle_hash"), list(keys))


def overlay(
    base: DataFrame,
    results: DataFrame,
    replaced: Sequence[str],
    *,
    by: Sequence[str] = (),
    null_run: NullRun = "keep",
    broadcast: bool | None = None,
) -> DataFrame:
    """Baseline rows with ``replaced`` columns and the run number taken from results.

    One row per result row of a known record. ``by`` names further key columns both
    sides share, such as a scenario id.
    """
    _check(null_run)
    keys = [*by, RECORD]
    fixed = base.drop(RUN, *replaced)
    runs = _runs(results, [*keys, RUN, *replaced], null_run)
    broadcast = fits_broadcast(fixed) if broadcast is None else broadcast
    matched = _joined(runs, fixed, keys, broadcast)
    if null_run == "drop":
        return matched
    unmatched = _marked(fixed, runs, by).where(~F.col("_seen")).drop("_seen")
    return matched.unionByName(unmatched, allowMissingColumns=True)


def replay(
    base: DataFrame,
    results: DataFrame,
    *,
    classes: Sequence[str] = (),
    sums: Sequence[str],
    by: Sequence[str] = (),
    null_run: NullRun = "keep",
    broadcast: bool | None = None,
    shared: Shared | None = None,
) -> DataFrame:
    """Baseline and all its runs as rows to be aggregated.

    ``base`` holds its own ``model_run``, ``classes`` and ``sums``, which runs replace.
    ``classes`` decide labels and must have few values; ``sums`` are additive. Rows of
    one record and run that agree in all classes may come merged: sums of ``sums`` over
    any grouping of the other columns are those of the plain overlay and the baseline.
    With ``shared``, ``base`` has the keys of its dataset in place of ``by``, and results have both.
    """
    _check(null_run)
    keys = [*base_keys(by, shared), RECORD]
    varying = [RUN, *classes, *sums]
    fixed = base.drop(*varying)
    runs = _runs(results, [*result_keys(by, shared), RECORD, *varying], null_run)
    broadcast = fits_broadcast(fixed) if broadcast is None else broadcast
    matched = _joined(runs, fixed, keys, broadcast)
    types = {field.name: field.dataType for field in base.schema.fields}
    nothing = [F.lit(None).cast(types[name]).alias(name) for name in varying]
    if shared is not None:
        return _shared(base, fixed, matched, runs, nothing, sums, by, null_run, shared)
    if null_run == "drop":
        return matched.unionByName(base)
    # one read of the baseline gives both its own row and, if no run has the record,
    # the row without a run
    rows = F.array(F.struct(*varying), F.when(~F.col("_seen"), F.struct(*nothing)))
    rest = _marked(base, runs, by).select(*fixed.columns, F.inline(F.array_compact(rows)))
    return matched.unionByName(rest)


def _shared(base, fixed, matched, runs, nothing, sums, by, null_run, shared) -> DataFrame:
    """The rows of all scenarios on shared baselines.

    The baselines' own rows are summed over records and then repeated per scenario. The
    records without a run come from comparing bitmaps, so no baseline row is repeated for a
    scenario except those that the scenario lacks.
    """
    known = F.when(F.col(RECORD).isNotNull(), F.lit(0).cast("bigint")).alias(RECORD)
    classes = [c for c in base.columns if c not in (RECORD, *sums)]
    own = base.select(known, *classes, *sums).groupBy(RECORD, *classes).agg(*[F.sum(s).alias(s) for s in sums])
    columns = [c for c in [*by, *base.columns] if c not in shared.keys]
    out = matched.select(*columns).unionByName(own.join(shared.members, [*shared.keys]).select(*columns))
    if null_run == "drop":
        return out
    whole = bitmaps(base, RECORD, shared.keys).join(shared.members, [*shared.keys])
    missing = lacking(whole, bitmaps(runs, RECORD, by), by, RECORD)
    unmatched = missing.join(fixed, [*shared.keys, RECORD])
    unnumbered = fixed.where(F.col(RECORD).isNull()).join(shared.members, [*shared.keys])
    for rows in (unmatched, unnumbered):
        out = out.unionByName(rows.select("*", *nothing).select(*columns))
    return out
