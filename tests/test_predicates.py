"""Predicates and labels: membership, unknown values, priority, and facts as bits."""

import random

import pytest
from pyspark.sql import functions as F

import capplan as cp
from capplan.functions import codes
from capplan.functions.labelling import atoms_of, facts, holds
from capplan.functions.vocabulary import ATOMS, PREDICATES, predicate
from tests.builders import attendances, random_spell, spells, visits


def truth(df, name):
    return [row[0] for row in df.orderBy("rn").select(predicate(name)).collect()]


@pytest.mark.parametrize(
    ("name", "column", "cases"),
    [
        ("adult", "age", {18: True, 17: False, None: None}),
        ("child", "age", {18: False, 17: True, None: None}),
        ("zero_los", "speldur", {0: True, 1: False, -1: False, None: None}),
        ("non_zero_los", "speldur", {0: False, 1: True, -1: False, None: None}),
        ("regular_day_night", "classpat", {"3": True, "4": True, "1": False, None: None}),
        ("elective_route", "admimeth", {"11": True, "1": True, "21": False, "": False, None: None}),
        ("planned_route", "admimeth", {"13": True, "14": False, "1": False, None: None}),
        ("renal", "tretspef", {"361": True, "0361": False, None: None}),
        ("haem_onc", "tretspef", dict.fromkeys(codes.HAEMATOLOGY_ONCOLOGY, True) | {"254": False}),
        ("cardiology", "tretspef", {"320": True, "321": True, "322": False}),
        ("interventional_radiology", "tretspef", {"811": True, "280": True, "28": False}),
        ("medical", "tretspef_type", {"Medical/Other": True, "Surgical": False, None: None}),
        ("surgical", "tretspef_type", {"Surgical": True, "surgical": False, None: None}),
        ("maternity", "group", {"maternity": True, "elective": False, None: None}),
        ("not_maternity", "group", {"maternity": False, "elective": True, None: None}),
        ("normal_birth", "primary_procedure", {"R241": True, "R24": True, "R2": False, None: None}),
        ("assisted_birth", "primary_procedure", {"R191": True, "R239": True, "R241": False}),
        ("non_elective_section", "primary_procedure", {"R18": True, "R17": False}),
        ("elective_section", "primary_procedure", {"R17": True, "R18": False}),
        (
            "endoscopy",
            "primary_procedure",
            {f"{code}1": True for code in codes.ENDOSCOPY}
            | {"G21": False, "H29": False, "J46": False, "E52": False, "G4": False, None: None},
        ),
        (
            "cardiac_catheter",
            "primary_procedure",
            {f"{code}.": True for code in codes.CARDIAC_CATHETER} | {"K64": False},
        ),
        ("has_procedure", "has_procedure", {True: True, False: False, None: None}),
        ("birth_event", "maternity_delivery_in_spell", {True: True, False: False, None: None}),
        ("no_birth_event", "maternity_delivery_in_spell", {True: False, False: True, None: None}),
    ],
)
def test_single_conditions(spark, name, column, cases):
    df = spells(spark, *[{column: value} for value in cases])
    assert truth(df, name) == list(cases.values())


def test_fixed_lists():
    assert len(codes.ENDOSCOPY) == len(set(codes.ENDOSCOPY)) == 44
    assert all(len(code) == 3 for code in (*codes.ENDOSCOPY, *codes.CARDIAC_CATHETER))


def test_non_elective_needs_a_known_group(spark):
    df = spells(
        spark,
        {"admimeth": "21", "group": "other"},
        {"admimeth": "21", "group": "maternity"},
        {"admimeth": "21", "group": None},
        {"admimeth": "21", "group": "other", "classpat": "2"},
    )
    assert truth(df, "non_elective") == [True, False, None, False]
    assert truth(spells(spark, {"group": "maternity"}), "elective") == [True]


def test_emergency_conditions(spark):
    df = attendances(
        spark,
        *[{"acuity": a} for a in ("standard", "non-urgent", "urgent", None, "very-urgent", "x")],
    )
    assert truth(df, "minor") == [True, True, True, True, False, False]
    assert truth(df, "adult_major") == [False, False, False, None, True, False]


def test_outpatient_conditions(spark):
    df = visits(
        spark,
        {"has_procedures": False, "is_first": True},
        {"has_procedures": False, "is_first": False},
        {"has_procedures": True, "is_first": True},
        {"has_procedures": None, "is_first": True},
    )
    assert truth(df, "op_first") == [True, False, False, None]
    assert truth(df, "op_follow_up") == [False, True, False, False]


def test_unknown_exclusion_does_not_exclude(spark):
    df = spells(
        spark,
        {"classpat": "2", "tretspef": None, "primary_procedure": None},
        {"classpat": "2", "primary_procedure": "G451"},
    )
    assert truth(df, "specialty_daycase") == [None, True]
    assert truth(df, "adult_surgical_daycase") == [True, False]


def test_unknown_predicate_is_an_error():
    with pytest.raises(KeyError):
        atoms_of([("no_such_predicate",)])


def test_facts_agree_with_conditions(spark):
    """A mask holds exactly where the condition is true, whatever is unknown."""
    r = random.Random(7)
    df = spells(spark, *[random_spell(r) for _ in range(400)]).withColumn(
        "theatre_time", F.when(F.col("rn") % 2 == 0, 1.5)
    )
    outside = {"aedepttype", "acuity", "has_procedures"}
    names = [
        name
        for name, sql in PREDICATES.items()
        if not any(column in sql for column in outside) and "coalesce" not in sql
    ]
    usable = [atom for atom in ATOMS if not any(c in ATOMS[atom] for c in outside)]
    word = df.withColumn("word", facts(usable))
    checks = word.select(
        *[
            F.sum((F.coalesce(predicate(n), F.lit(False)) != holds("word", n)).cast("int")).alias(n)
            for n in names
        ]
    ).first()
    assert len(names) > 40
    assert {name: count for name, count in checks.asDict().items() if count} == {}


def test_facts_label_as_columns_do(spark):
    r = random.Random(11)
    df = spells(spark, *[random_spell(r) for _ in range(400)]).withColumn(
        "theatre_time", F.when(F.col("rn") % 3 == 0, 20.0)
    )
    for area in (cp.DAYCASE, cp.MATERNITY, cp.WARDS, cp.PROCEDURES):
        both = df.withColumn("word", facts(area.atoms)).select(
            area.label().alias("a"), area.label_of("word").alias("b")
        )
        assert both.where(~F.col("a").eqNullSafe(F.col("b"))).count() == 0
        assert both.where(F.col("a").isNotNull()).count() > 0


def label_of(df, area):
    return df.select(area.label()).first()[0]


@pytest.mark.parametrize(
    ("record", "expected"),
    [
        ({"aedepttype": "02", "acuity": "immediate-resuscitation"}, "resus_attendances"),
        ({"aedepttype": "05", "acuity": "immediate-resuscitation"}, "sdec_attendances"),
        ({"age": 18, "acuity": None}, "adult_minor_attendances"),
        ({"age": 17, "acuity": "very-urgent"}, "child_major_attendances"),
        ({"aedepttype": "02", "acuity": None}, None),
        ({"age": None, "acuity": None}, None),
    ],
)
def test_emergency_priority(spark, record, expected):
    assert label_of(attendances(spark, record), cp.EMERGENCY) == expected


@pytest.mark.parametrize(
    ("area", "record", "expected"),
    [
        (cp.DAYCASE, {"tretspef": "361"}, "daycase_renal_spells"),
        (cp.DAYCASE, {"tretspef": "361", "classpat": "3", "admimeth": "82"}, "daycase_renal_spells"),
        (cp.DAYCASE, {"tretspef": "303", "classpat": "2", "primary_procedure": "G451"}, "daycase_haem_onc_spells"),
        (cp.DAYCASE, {"classpat": "2", "primary_procedure": "G451"}, "daycase_endoscopy_spells"),
        (cp.DAYCASE, {"classpat": "2"}, "daycase_adult_surgical_spells"),
        (cp.DAYCASE, {"classpat": "2", "age": 3, "tretspef_type": "Medical/Other"}, "daycase_child_medical_spells"),
        (cp.DAYCASE, {"tretspef": "361", "speldur": 1}, None),
        (cp.WARDS, {"group": None, "admimeth": "21"}, None),
        (cp.WARDS, {"group": "maternity"}, "adult_elective_surgical_zerolos"),
        (cp.WARDS, {"age": 1, "admimeth": "2A", "speldur": 4, "tretspef_type": "Medical/Other"}, "paediatric_nonelective_medical_nonzerolos"),
        (cp.WARDS, {"speldur": -1}, None),
        (cp.WARDS, {"speldur": None}, None),
        (cp.MATERNITY, {"group": "maternity", "speldur": 0}, "maternity_assessment"),
        (cp.MATERNITY, {"group": "maternity", "speldur": 2}, "maternity_overnight_no_birth"),
        (cp.MATERNITY, {"group": "maternity", "speldur": -1}, None),
        (cp.MATERNITY, {"group": "maternity", "maternity_delivery_in_spell": True, "primary_procedure": "R241"}, "maternity_normal_delivery_zerolos"),
        (cp.MATERNITY, {"group": "maternity", "maternity_delivery_in_spell": True, "primary_procedure": "R2"}, None),
        (cp.MATERNITY, {"group": "maternity", "maternity_delivery_in_spell": True, "primary_procedure": "R18", "speldur": 3}, "maternity_nonelective_csection_nonzerolos"),
    ],
)
def test_inpatient_priority(spark, area, record, expected):
    assert label_of(spells(spark, record), area) == expected


@pytest.mark.parametrize(
    ("record", "time", "expected"),
    [
        ({"tretspef": "811", "primary_procedure": "K631"}, 5.0, "interventional_radiology_procedure"),
        ({"tretspef": "321"}, None, "cardiac_catheter_procedure"),
        ({"primary_procedure": "K631"}, None, "cardiac_catheter_procedure"),
        ({}, None, "adult_elective_surgical_procedures_unknown_time"),
        ({}, 5.0, "adult_elective_surgical_procedures"),
        ({"age": 5, "classpat": "2", "tretspef_type": None}, 5.0, "paediatric_daycase_procedures"),
        ({"age": None}, 5.0, "unknown_procedure"),
    ],
)
def test_procedure_priority(spark, record, time, expected):
    df = spells(spark, record).withColumn("theatre_time", F.lit(time).cast("double"))
    assert label_of(df, cp.PROCEDURES) == expected


def test_label_lists():
    assert len(cp.WARDS.required) == 16 and len(cp.MATERNITY.required) == 10
    assert len(cp.DAYCASE.required) == 7 and len(cp.EMERGENCY.required) == 6
    assert len(cp.PROCEDURES.required) == 8 and len(cp.PROCEDURES.labels) == 15
    for area in (cp.WARDS, cp.MATERNITY, cp.DAYCASE, cp.EMERGENCY):
        assert set(area.required) == set(area.labels)
