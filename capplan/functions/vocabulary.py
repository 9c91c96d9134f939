"""Named predicates over hospital records.

An atom is one Spark SQL condition that reads either only baseline columns or only the
columns a simulated run replaces. A composite is a choice of conjunctions of atoms.
Both are text, so the module can be imported without a session and every predicate can
be used from the DataFrame API (``predicate(name)``) and from SQL (``condition(name)``).

SQL's three-valued logic applies: a condition on a NULL value is NULL, so a row can
match neither a predicate nor its complement.
"""

from __future__ import annotations

from collections.abc import Iterable
from itertools import product

from pyspark.sql import Column
from pyspark.sql import functions as F

from capplan.functions import codes


def _among(values: Iterable[str]) -> str:
    return "IN (" + ", ".join(f"'{value}'" for value in values) + ")"


_PREFIX = "substr(primary_procedure, 1, 3)"

ATOMS: dict[str, str] = {
    # any record
    "adult": f"age >= {codes.ADULT_AGE}",
    "child": f"age < {codes.ADULT_AGE}",
    # emergency care
    "emergency_department": f"aedepttype = '{codes.MAJOR_DEPARTMENT}'",
    "resus": f"acuity = '{codes.RESUS_ACUITY}'",
    "major": f"acuity = '{codes.MAJOR_ACUITY}'",
    "minor": f"acuity {_among(codes.MINOR_ACUITY)} OR acuity IS NULL",
    "sdec": f"aedepttype = '{codes.SAME_DAY_EMERGENCY_CARE}'",
    # outpatients
    "op_procedure": "has_procedures",
    "op_first": "NOT has_procedures AND is_first",
    "op_follow_up": "NOT has_procedures AND NOT is_first",
    # inpatients: admission route
    "elective_route": "startswith(admimeth, '1')",
    "planned_route": f"admimeth {_among(codes.PLANNED_ADMISSION)}",
    "emergency_route": f"startswith(admimeth, '2') AND `group` != '{codes.MATERNITY_GROUP}'",
    # inpatients: specialty
    "medical": f"tretspef_type = '{codes.MEDICAL}'",
    "surgical": f"tretspef_type = '{codes.SURGICAL}'",
    "renal": f"tretspef {_among(codes.RENAL)}",
    "haem_onc": f"tretspef {_among(codes.HAEMATOLOGY_ONCOLOGY)}",
    "cardiology": f"tretspef {_among(codes.CARDIOLOGY)}",
    "interventional_radiology": f"tretspef {_among(codes.INTERVENTIONAL_RADIOLOGY)}",
    # inpatients: procedure
    "has_procedure": "has_procedure",
    "endoscopy": f"{_PREFIX} {_among(codes.ENDOSCOPY)}",
    "cardiac_catheter": f"{_PREFIX} {_among(codes.CARDIAC_CATHETER)}",
    "unknown_time": "theatre_time IS NULL",
    # inpatients: maternity
    "maternity": f"`group` = '{codes.MATERNITY_GROUP}'",
    "not_maternity": f"NOT (`group` = '{codes.MATERNITY_GROUP}')",
    "birth_event": "maternity_delivery_in_spell",
    "no_birth_event": "NOT maternity_delivery_in_spell",
    "normal_birth": f"{_PREFIX} {_among(codes.NORMAL_BIRTH)}",
    "assisted_birth": f"{_PREFIX} {_among(codes.ASSISTED_BIRTH)}",
    "non_elective_section": f"{_PREFIX} {_among(codes.NON_ELECTIVE_SECTION)}",
    "elective_section": f"{_PREFIX} {_among(codes.ELECTIVE_SECTION)}",
    # inpatients: replaced by every run
    "ordinary": f"classpat = '{codes.ORDINARY}'",
    "day_patient": f"classpat = '{codes.DAY_CASE}'",
    "regular_day_night": f"classpat {_among(codes.REGULAR_ATTENDER)}",
    "zero_los": "speldur = 0",
    "non_zero_los": "speldur > 0",
}

RUN_ATOMS = ("ordinary", "day_patient", "regular_day_night", "zero_los", "non_zero_los")
"""Inpatient atoms on the columns a run replaces; the others hold for a record in all runs."""

Conjunction = tuple[str, ...]
_COMPOSITES: dict[str, tuple[Conjunction, ...]] = {}


def alternatives(*names: str) -> tuple[Conjunction, ...]:
    """The conjunctions of atoms, any of which makes all the named predicates hold."""
    unknown = [name for name in names if name not in ATOMS and name not in _COMPOSITES]
    if unknown or not names:
        raise KeyError(f"unknown predicates {unknown}")
    choices = [_COMPOSITES.get(name, ((name,),)) for name in names]
    return tuple(
        tuple(dict.fromkeys(atom for part in choice for atom in part)) for choice in product(*choices)
    )


def _define(name: str, *needed: Conjunction) -> None:
    _COMPOSITES[name] = tuple(way for names in needed for way in alternatives(*names))


# admission, by route and patient class
_define("elective", ("elective_route", "ordinary"))
_define("non_elective", ("emergency_route", "ordinary"))
_define("daycase", ("planned_route", "day_patient"))

# emergency care: age and acuity count at type-01 departments only
for _age in ("adult", "child"):
    for _acuity in ("minor", "major"):
        _define(f"{_age}_{_acuity}", ("emergency_department", _age, _acuity))

# day cases: the specialty ones, then the remainder by age and specialty type
_define("renal_elective", ("renal", "elective", "zero_los"))
_define("renal_regular_day_night", ("renal", "regular_day_night"))
_define("renal_daycase", ("renal_elective",), ("renal_regular_day_night",))
_define("haem_onc_daycase", ("daycase", "haem_onc", "has_procedure"))
_define("endoscopy_daycase", ("daycase", "endoscopy"))
_define("specialty_daycase", ("renal_daycase",), ("haem_onc_daycase",), ("endoscopy_daycase",))

# maternity: each kind of delivery by length of stay, then stays without a delivery
for _los in ("zero_los", "non_zero_los"):
    for _birth in ("normal_birth", "assisted_birth", "non_elective_section", "elective_section"):
        _define(f"{_birth}_{_los}", ("maternity", "birth_event", _birth, _los))
_define("maternity_assessment", ("maternity", "zero_los", "no_birth_event"))
_define("maternity_overnight", ("maternity", "non_zero_los", "no_birth_event"))

# procedures
_define("cardiology_procedure", ("cardiology", "has_procedure"))
_define("catheter_procedure", ("has_procedure", "cardiac_catheter"))
_define("cardiac_catheter_procedure", ("cardiology_procedure",), ("catheter_procedure",))
_define("interventional_radiology_procedure", ("interventional_radiology", "has_procedure"))
for _route in ("elective", "non_elective", "daycase"):
    _define(f"adult_{_route}_surgery", ("adult", _route, "has_procedure", "surgical"))
    _define(f"child_{_route}_procedure", ("child", _route, "has_procedure"))
# theatre time is shown for spells with a procedure outside maternity
_define("in_theatre_scope", ("has_procedure", "not_maternity"))


def condition(*names: str) -> str:
    """Spark SQL text of the conjunction of the named predicates."""
    return " OR ".join(
        "(" + " AND ".join(f"({ATOMS[atom]})" for atom in way) + ")" for way in alternatives(*names)
    )


PREDICATES: dict[str, str] = {name: condition(name) for name in (*ATOMS, *_COMPOSITES)}
"""Predicate name -> Spark SQL condition."""

# The remainder of day cases excludes the specialty ones; an unknown exclusion does not
# exclude. Ordered rules need no such exclusion, as the specialty rules come first.
for _age in ("adult", "child"):
    for _type in ("medical", "surgical"):
        PREDICATES[f"{_age}_{_type}_daycase"] = (
            f"{condition('daycase', _age, _type)}"
            f" AND NOT coalesce({PREDICATES['specialty_daycase']}, false)"
        )


def predicate(name: str) -> Column:
    """Boolean column of a named predicate."""
    return F.expr(PREDICATES[name])
