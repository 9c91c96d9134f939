"""The six areas of care as data: ordered rules, measures and required labels."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column

from capplan.functions.labelling import Rule, atoms_of, label, label_of_facts, product_rules

KEYS = ("model_run", "sitetret")


@dataclass(frozen=True)
class Area:
    """One output table.

    ``required`` labels are present for every run and site, zero if nothing matched;
    other labels are present only where records carry them.
    """

    name: str
    rules: tuple[Rule, ...]
    required: tuple[str, ...]
    measures: tuple[str, ...]
    otherwise: str | None = None
    label_column: str = "grouping"

    @property
    def labels(self) -> tuple[str, ...]:
        """Every label the rules can give, in rule order."""
        rest = () if self.otherwise is None else (self.otherwise,)
        return tuple(name for name, _ in self.rules) + rest

    @property
    def atoms(self) -> tuple[str, ...]:
        """The atoms the rules depend on."""
        return atoms_of(needed for _, needed in self.rules)

    def label(self) -> Column:
        """Label of a record, from its columns."""
        return label(self.rules, self.otherwise)

    def label_of(self, word: str) -> Column:
        """Label of a record, from the word of facts in column ``word``."""
        return label_of_facts(word, self.rules, self.otherwise)


# Label names below are fixed values of the output tables.

_EMERGENCY_RULES: tuple[Rule, ...] = (
    ("sdec_attendances", ("sdec",)),
    ("resus_attendances", ("resus",)),
    ("adult_minor_attendances", ("adult_minor",)),
    ("adult_major_attendances", ("adult_major",)),
    ("child_minor_attendances", ("child_minor",)),
    ("child_major_attendances", ("child_major",)),
)

EMERGENCY = Area(
    name="aae",
    rules=_EMERGENCY_RULES,
    required=tuple(name for name, _ in _EMERGENCY_RULES),
    measures=("total",),
)
SDEC_LABEL = "sdec_attendances"

# Outpatient labels overlap (a virtual visit may include a procedure), so they are
# sums of one measure each, not rules: label -> (measure, predicate or None for all).
OUTPATIENT_SUMS: dict[str, tuple[str, str | None]] = {
    "op_procedures": ("attendances", "op_procedure"),
    "op_first_attendances": ("attendances", "op_first"),
    "op_follow_up_attendances": ("attendances", "op_follow_up"),
    "op_virtual_attendances": ("tele_attendances", None),
}
OP_CONVERTED_LABEL = "op_procedures"

_DAYCASE_RULES: tuple[Rule, ...] = (
    ("daycase_renal_spells", ("renal_daycase",)),
    ("daycase_haem_onc_spells", ("haem_onc_daycase",)),
    ("daycase_endoscopy_spells", ("endoscopy_daycase",)),
    # the remainder: no specialty day case gets this far
    ("daycase_adult_medical_spells", ("daycase", "adult", "medical")),
    ("daycase_adult_surgical_spells", ("daycase", "adult", "surgical")),
    ("daycase_child_medical_spells", ("daycase", "child", "medical")),
    ("daycase_child_surgical_spells", ("daycase", "child", "surgical")),
)

DAYCASE = Area(
    name="ip_daycase",
    rules=_DAYCASE_RULES,
    required=tuple(name for name, _ in _DAYCASE_RULES),
    measures=("total",),
)

_MATERNITY_RULES: tuple[Rule, ...] = (
    ("maternity_normal_delivery_zerolos", ("normal_birth_zero_los",)),
    ("maternity_normal_delivery_nonzerolos", ("normal_birth_non_zero_los",)),
    ("maternity_assisted_delivery_zerolos", ("assisted_birth_zero_los",)),
    ("maternity_assisted_delivery_nonzerolos", ("assisted_birth_non_zero_los",)),
    ("maternity_assessment", ("maternity_assessment",)),
    ("maternity_nonelective_csection_zerolos", ("non_elective_section_zero_los",)),
    ("maternity_nonelective_csection_nonzerolos", ("non_elective_section_non_zero_los",)),
    ("maternity_elective_csection_zerolos", ("elective_section_zero_los",)),
    ("maternity_elective_csection_nonzerolos", ("elective_section_non_zero_los",)),
    ("maternity_overnight_no_birth", ("maternity_overnight",)),
)

MATERNITY = Area(
    name="ip_maternity",
    rules=_MATERNITY_RULES,
    required=tuple(name for name, _ in _MATERNITY_RULES),
    measures=("spells", "beddays"),
)

_WARD_RULES = product_rules(
    (
        {"adult": "adult", "paediatric": "child"},
        {"elective": "elective", "nonelective": "non_elective"},
        {"medical": "medical", "surgical": "surgical"},
        {"nonzerolos": "non_zero_los", "zerolos": "zero_los"},
    )
)

WARDS = Area(
    name="ip_wards",
    rules=_WARD_RULES,
    required=tuple(name for name, _ in _WARD_RULES),
    measures=("spells", "beddays"),
)

# theatre label -> predicate; each is split by whether the theatre time is known
_THEATRE_LABELS: dict[str, str] = {
    "adult_elective_surgical_procedures": "adult_elective_surgery",
    "adult_nonelective_surgical_procedures": "adult_non_elective_surgery",
    "adult_surgical_daycase_procedures": "adult_daycase_surgery",
    "paediatric_elective_procedures": "child_elective_procedure",
    "paediatric_nonelective_procedures": "child_non_elective_procedure",
    "paediatric_daycase_procedures": "child_daycase_procedure",
}
_PROCEDURE_ROOM_LABELS = ("interventional_radiology_procedure", "cardiac_catheter_procedure")
_UNKNOWN_TIME = tuple(f"{name}_unknown_time" for name in _THEATRE_LABELS)

PROCEDURES = Area(
    name="ip_procedures_and_theatres",
    rules=tuple((name, (name,)) for name in _PROCEDURE_ROOM_LABELS)
    + tuple(
        rule
        for name, needed in _THEATRE_LABELS.items()
        for rule in ((f"{name}_unknown_time", (needed, "unknown_time")), (name, (needed,)))
    ),
    otherwise="unknown_procedure",
    # As defined for this table, the six labels with a known time are not required.
    required=_UNKNOWN_TIME + _PROCEDURE_ROOM_LABELS,
    measures=("spells", "total_theatre_time"),
    label_column="procedure_grouping",
)

INPATIENT_AREAS: dict[str, Area] = {
    area.name: area for area in (DAYCASE, MATERNITY, WARDS, PROCEDURES)
}
