"""Small hand-made inputs; every column can be overridden per row."""

import random

from pyspark.sql import types as T

from capplan import schemas

SPELL = T.StructType(schemas.INPATIENT_BASELINE.fields + [T.StructField("tretspef_type", T.StringType())])

SPELL_DEFAULTS = dict(
    model_run=0, sitetret="A", age=40, admimeth="11", classpat="1", speldur=0, tretspef="100",
    group="elective", primary_procedure="X123", has_procedure=True,
    maternity_delivery_in_spell=False, tretspef_type="Surgical",
)
ATTENDANCE_DEFAULTS = dict(model_run=0, sitetret="A", age=40, aedepttype="01", acuity=None, arrivals=1)
VISIT_DEFAULTS = dict(
    model_run=0, sitetret="A", has_procedures=False, is_first=False, attendances=1,
    tele_attendances=0,
)

ATTENDANCE = "rn bigint, model_run int, sitetret string, age int, aedepttype string, acuity string, arrivals int"
VISIT = (
    "rn bigint, model_run int, sitetret string, has_procedures boolean, is_first boolean, "
    "attendances int, tele_attendances int"
)
SPELL_RUN = "rn bigint, model_run int, speldur int, classpat string"
TIMES = "opcs_code string, opcs_description string, theatre_time double"


def rows(spark, schema, defaults, overrides):
    names = schema.names if isinstance(schema, T.StructType) else [
        column.split()[0] for column in schema.split(", ")
    ]
    data = []
    for number, override in enumerate(overrides):
        row = {"rn": number, **defaults, **override}
        data.append(tuple(row[name] for name in names))
    return spark.createDataFrame(data, schema)


def spells(spark, *overrides):
    return rows(spark, SPELL, SPELL_DEFAULTS, overrides)


def attendances(spark, *overrides):
    return rows(spark, ATTENDANCE, ATTENDANCE_DEFAULTS, overrides)


def visits(spark, *overrides):
    return rows(spark, VISIT, VISIT_DEFAULTS, overrides)


def bag(df):
    columns = sorted(df.columns)
    return sorted((tuple(row[c] for c in columns) for row in df.collect()), key=repr)


def random_spell(r: random.Random) -> dict:
    pick = r.choice
    return dict(
        sitetret=pick(["A", "B", "C", None]),
        age=pick([0, 17, 18, 90, None]),
        admimeth=pick(["11", "12", "13", "1X", "21", "2A", "31", "", None]),
        classpat=pick(["1", "2", "3", "4", "5", None]),
        speldur=pick([-1, 0, 1, 7, None]),
        tretspef=pick(["361", "303", "320", "811", "100", "&", None]),
        group=pick(["maternity", "elective", "non-elective", None]),
        primary_procedure=pick(
            ["R241", "R182", "R17", "R211", "G451", "K631", "W371", "E49", "G4", "", None]
        ),
        has_procedure=pick([True, True, False, None]),
        maternity_delivery_in_spell=pick([True, False, None]),
        tretspef_type=pick(["Medical/Other", "Surgical", "Other", None]),
    )


def random_runs(r: random.Random, records: int, rows: int) -> list[tuple]:
    """Results with repeated records, records in no run, and records nobody knows."""
    return [
        (
            r.randrange(records + 3) if r.random() < 0.7 else 1,
            r.choice([1, 2, 3]),
            r.choice([-1, 0, 0, 1, 5, None]),
            r.choice(["1", "1", "2", "3", "4", "5", None]),
        )
        for _ in range(rows)
    ]
